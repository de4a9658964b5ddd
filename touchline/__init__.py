"""touchline: a Spark-native lakehouse for league match results.

Landed per-league, per-season CSV files become a bronze table (all text, with
provenance), a typed silver match table, and gold team-season and
league-season tables, plus SQL views, catalog tables and an outcome model.
Every step is a ``DataFrame -> DataFrame`` function on Spark built-ins.
"""

__version__ = "0.1.0"
