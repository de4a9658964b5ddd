"""Training-data operators: quality rules, tokenisation, mixing, fingerprints,
near, exact and exact substring dedup, token files, URL lists, WARC, toxicity,
vector codes and hard negatives.

Nothing else in the library imports this subpackage. Operators take and return
DataFrames; ``queries`` holds one thin ``opN_<name>`` query for each.
"""
