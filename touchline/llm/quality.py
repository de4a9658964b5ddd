"""Quality rules at host level (operator 1), in DataFrame functions only.

Each document is measured on its whole text and judged by base rules. Rule
failures are counted per host (the ``source`` column stands for the domain); a
host's raw failure rate is shrunk with a beta prior fitted to all hosts by the
method of moments, so a host with few documents is pulled towards the overall
rate and is not judged on three bad pages. A host whose shrunk rate of any rule
exceeds ``max_rate`` is rejected, and its verdict is joined back to its
documents.

Counts are summed in the tasks before they are shuffled, so a host with a third
of all documents sends one row a task. The join back carries measures only, not
texts, and its hot hosts are split by adaptive skew handling.

Defined results: null text has no words and fails; a null source is one host
of its own, never rejected as a host; repeated rows count and come back once
per row; one host, or hosts that do not differ, get a prior of ``FLAT`` pseudo
documents at the overall rate; an empty table gives an empty result; columns
besides doc_id, text and source are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_GAPS, cut, let, table

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 10  # symbols per 100 word characters, host rule only
MAX_DUP_LINE_PERCENT = 30  # repeated lines per 100 lines with a word, host rule only
WINDOW_WORDS = 3
#: Shrunk rate of a rule's failures at which a host is rejected.
MAX_RATE = 0.5
FLAT = 10.0
RULES = ("short", "repeats", "symbols", "dup_lines")


def repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, first occurrence included.

    Windows are sorted with their place, equal neighbours are the repeated
    ones; the union of their words is summed over the sorted places.
    """
    n = WINDOW_WORDS

    def places(keyed: Column) -> Column:
        # the neighbours of entry i of the sorted windows
        shifted = F.arrays_zip(keyed.alias("own"),
                               F.concat(F.array(F.lit(None).cast("struct<h:bigint,g:int,at:int>")), keyed).alias("prev"),
                               F.concat(F.slice(keyed, 2, F.greatest(F.size(keyed) - 1, F.lit(0))),
                                        F.array(F.lit(None).cast("struct<h:bigint,g:int,at:int>"))).alias("next"))
        same = lambda a, b: F.coalesce((a["h"] == b["h"]) & (a["g"] == b["g"]), F.lit(False))
        return F.array_sort(F.transform(
            F.filter(shifted, lambda z: z["own"].isNotNull() & (same(z["own"], z["prev"]) | same(z["own"], z["next"]))),
            lambda z: z["own"]["at"]))

    def keyed_windows(w: Column) -> Column:
        # two independent hashes of the window's words make a key of 96 bits
        return F.array_sort(F.transform(
            F.sequence(F.lit(1), F.size(w) - (n - 1)),
            lambda i: F.struct(F.xxhash64(*[F.get(w, i + (k - 1)) for k in range(n)]).alias("h"),
                               F.hash(*[F.get(w, i + (k - 1)) for k in range(n)]).alias("g"), i.alias("at"))))

    def covered(at: Column) -> Column:
        state = F.aggregate(
            at, F.struct(F.lit(-n).alias("last"), F.lit(0).cast("long").alias("total")),
            lambda s, p: F.struct(p.alias("last"),
                                  (s["total"] + F.least(F.lit(n), p - s["last"])).alias("total")))
        return state["total"]

    counted = let(keyed_windows(words), lambda k: let(places(k), covered))
    return F.when(F.size(words) >= n, counted).otherwise(F.lit(0).cast("long"))


def measured(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words)``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    gaps = F.translate(text, WORD_GAPS, " " * len(WORD_GAPS))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, WORD_GAPS, "") != F.lit(""))
    rows = docs.select("doc_id", "source", text.alias("text"),
                       F.filter(F.split(gaps, " "), lambda w: w != F.lit("")).alias("words"),
                       let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                                     F.size(F.array_distinct(x)).cast("long").alias("own"))).alias("lines"))
    return rows.select(
        "doc_id", "source", F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", WORD_GAPS, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.col("lines.n").alias("n_lines"), (F.col("lines.n") - F.col("lines.own")).alias("n_dup_lines"), repeat_words(F.col("words")).alias("n_repeat_words"))


def failures() -> dict[str, Column]:
    """Rule name -> whether a measured document fails it."""
    return {
        "short": F.col("n_words") < MIN_WORDS,
        "repeats": F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT,
        "symbols": F.col("n_symbols") * 100 > F.col("word_chars") * MAX_SYMBOL_PERCENT,
        "dup_lines": F.col("n_dup_lines") * 100 > F.col("n_lines") * MAX_DUP_LINE_PERCENT,
    }


def beta_prior(all_hosts, rule: str) -> tuple[float, float]:
    """(mean, strength) of a rule's prior from the sums over all hosts; the corpus rate
    and ``FLAT`` where the hosts' rates have no variance that a beta could have."""
    mean = all_hosts[f"sum_{rule}"] / all_hosts.hosts / 1e6
    variance = float(all_hosts[f"sq_{rule}"]) / all_hosts.hosts / 1e12 - mean * mean
    spread = mean * (1.0 - mean)
    if variance > 1e-12 and spread > variance:
        return mean, spread / variance - 1.0
    return all_hosts[f"all_{rule}"] / all_hosts.docs, FLAT


def host_verdicts(measures: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """``(host, n_docs, rate_<rule> ..., host_failed)``, a row per host.

    The beta prior of a rule has the mean and variance of the hosts' raw rates
    (method of moments); its strength is mean (1 - mean) / variance - 1. The
    moments are one aggregate over the hosts, summed in the tasks first; its
    single row reaches the driver.
    """
    fails = failures()
    hosts = measures.groupBy(F.col("source").alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.sum(fails[r].cast("long")).alias(f"fails_{r}") for r in RULES])
    n = F.col("n_docs")
    # moments are taken over integers (rates in millionths), so their sums do not depend on row order
    hosts = cut(hosts.withColumns({f"ppm_{r}": F.floor(F.col(f"fails_{r}") * 1_000_000 / n) for r in RULES}), "hosts")
    all_hosts = hosts.agg(F.count(F.lit(1)).alias("hosts"), F.sum(n).alias("docs"), *[
        part for r in RULES for part in (
            F.sum(f"fails_{r}").alias(f"all_{r}"), F.sum(f"ppm_{r}").alias(f"sum_{r}"),
            F.sum((F.col(f"ppm_{r}") * F.col(f"ppm_{r}")).cast("decimal(38,0)")).alias(f"sq_{r}"))]).first()
    shrunk = []
    for r in RULES:
        centre, strength = beta_prior(all_hosts, r) if all_hosts.hosts else (0.0, FLAT)
        shrunk.append(((F.col(f"fails_{r}") + F.lit(centre * strength)) / (n + F.lit(strength))).alias(f"rate_{r}"))
    hosts = hosts.select("host", "n_docs", *shrunk)
    worst = F.greatest(*[F.col(f"rate_{r}") for r in RULES])
    return hosts.withColumn("host_failed", F.col("host").isNotNull() & (worst > max_rate))


def judged(docs: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """Measures, ``base_failed``, the host's shrunk rates and ``kept``, a row per document."""
    measures = cut(measured(docs), "quality")
    verdicts = host_verdicts(measures, max_rate)
    fails = failures()
    rows = measures.withColumn("base_failed", fails["short"] | fails["repeats"])
    joined = rows.join(verdicts, F.col("source").eqNullSafe(F.col("host")))
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))


def op1_host_rules(spark, sf_dir):
    return judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "host_failed", "kept")


def _host_sql() -> str:
    fails = {
        "short": f"n_words < {MIN_WORDS}",
        "repeats": f"n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT}",
        "symbols": f"n_symbols * 100 > word_chars * {MAX_SYMBOL_PERCENT}",
        "dup_lines": f"n_dup_lines * 100 > n_lines * {MAX_DUP_LINE_PERCENT}",
    }
    sums = ", ".join(f"sum(CAST({fails[r]} AS BIGINT)) AS fails_{r}" for r in RULES)
    ppm = ", ".join(f"CAST(floor(fails_{r} * 1000000 / n_docs) AS BIGINT) AS ppm_{r}" for r in RULES)
    alls = ", ".join(f"sum(fails_{r}) OVER () AS all_{r}, sum(ppm_{r}) OVER () AS sum_{r}, "
                     f"sum(ppm_{r} * ppm_{r}) OVER () AS sq_{r}" for r in RULES)
    means = ", ".join(f"CAST(sum_{r} AS DOUBLE) / hosts / 1e6 AS mean_{r}, "
                      f"CAST(sq_{r} AS DOUBLE) / hosts / 1e12 - (CAST(sum_{r} AS DOUBLE) / hosts / 1e6) * (CAST(sum_{r} AS DOUBLE) / hosts / 1e6) AS var_{r}"
                      for r in RULES)
    ok = {r: f"var_{r} > 1e-12 AND mean_{r} * (1 - mean_{r}) > var_{r}" for r in RULES}
    strengths = ", ".join(
        f"CASE WHEN {ok[r]} THEN mean_{r} * (1 - mean_{r}) / var_{r} - 1 ELSE {FLAT} END AS k_{r}, "
        f"CASE WHEN {ok[r]} THEN mean_{r} ELSE CAST(all_{r} AS DOUBLE) / docs END AS c_{r}" for r in RULES)
    rates = ", ".join(f"(fails_{r} + c_{r} * k_{r}) / (n_docs + k_{r})" for r in RULES)
    return f"""
hosts AS (SELECT source AS host, count(*) AS n_docs, {sums} FROM m GROUP BY source),
ppms AS (SELECT *, {ppm} FROM hosts),
totals AS (SELECT *, count(*) OVER () AS hosts, sum(n_docs) OVER () AS docs, {alls} FROM ppms),
moments AS (SELECT *, {means} FROM totals),
priors AS (SELECT *, {strengths} FROM moments),
verdicts AS (SELECT host, host IS NOT NULL AND greatest({rates}) > {MAX_RATE} AS host_failed FROM priors)"""


OP1_SQL = f"""
WITH t AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]'), lambda w: w <> '') AS words
  FROM documents),
numbered AS (SELECT row_number() OVER () AS rid, * FROM t),
windows AS (
  SELECT rid, pos, words[pos] || chr(10) || words[pos + 1] || chr(10) || words[pos + 2] AS three
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS pos FROM numbered WHERE len(words) >= 3)),
repeated AS (SELECT rid, pos FROM (SELECT *, count(*) OVER (PARTITION BY rid, three) AS n FROM windows) WHERE n >= 2),
covered AS (
  SELECT rid, sum(add) AS n FROM (
    SELECT rid, least(3, pos - lag(pos, 1, -2) OVER (PARTITION BY rid ORDER BY pos)) AS add FROM repeated) GROUP BY rid),
lines AS (
  SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM numbered),
m AS (
  SELECT n.doc_id, n.source, CAST(len(n.words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(n.text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(n.text) - length(regexp_replace(n.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l.lines) AS BIGINT) AS n_lines, CAST(len(l.lines) - len(list_distinct(l.lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM numbered n JOIN lines l USING (rid) LEFT JOIN covered c USING (rid)),
{_host_sql()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed, host_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND NOT host_failed AS kept
FROM m JOIN verdicts v ON m.source IS NOT DISTINCT FROM v.host
"""
