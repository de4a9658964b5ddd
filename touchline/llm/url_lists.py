"""URL filters by dated lists (operator 8).

A list log holds dated entries: at ``at``, ``pattern`` is added to or removed
from the list ``label``. A pattern is a host (``example.org``, which covers its
subdomains; a top-level domain covers all hosts in it) or a host with a path
(``example.org/en``, which covers everything below, at any depth). Per (label, pattern) the log becomes validity intervals
``[valid_from, valid_to)``; a capture is rejected if an entry of any label that
covers its URL was active when it was fetched.

As-of join: a capture's URL gives the few patterns that can cover it (host and
parent domains, host with each leading path, as deep as the log's deepest
entry). Intervals are cut at the ends of ``BUCKET_DAYS``-day buckets and stand
in those buckets that hold captures, so captures and intervals meet by equality
on (pattern, bucket) and only then compare times. A pattern with a long history
does not meet all its captures with all its intervals, and a popular pattern's
captures are spread over buckets; what remains hot is split by adaptive
execution, as both sides of the join are plain shuffles.

Defined results: a URL without a host is covered by nothing; a capture without
a fetch time is kept and has no matches; log rows with a null pattern, label,
action or date are ignored; of entries with one date for a (label, pattern)
pair ``remove`` wins; repeated log rows count once; repeated captures come back
once per row; empty tables give an empty result or no matches; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table

BUCKET_DAYS = 32
FOREVER = "9999-12-31"


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without user, port and a leading ``www.``; null if there is none."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", F.regexp_replace(found, r"^www\.", ""))


def path_of(url: Column) -> Column:
    """Path of a URL without its first slash."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)", 1)


def patterns_of(host: Column, path: Column, deepest: int) -> Column:
    """The patterns that can cover a URL: the host, its parent domains, and the host
    with its leading path parts, up to the ``deepest`` that any entry has."""
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.filter(F.split(path, "/"), lambda p: p != F.lit(""))
    depth = F.least(F.size(parts), F.lit(deepest))
    paths = F.when(depth > 0, F.transform(F.sequence(F.lit(1), F.greatest(depth, F.lit(1))),
                                          lambda i: F.concat_ws("/", host, F.array_join(F.slice(parts, 1, i), "/"))))
    return F.array_distinct(F.concat(domains, F.coalesce(paths, F.array().cast("array<string>"))))


def intervals(log: DataFrame) -> DataFrame:
    """``(label, pattern, valid_from, valid_to)`` from ``(label, pattern, action, at)`` with dates."""
    known = log.where(F.col("label").isNotNull() & F.col("pattern").isNotNull() & F.col("at").isNotNull()
                      & F.col("action").isin("add", "remove"))
    # one state a day: remove wins
    days = known.groupBy("label", "pattern", "at").agg((F.max("action") == "add").alias("active"))
    history = Window.partitionBy("label", "pattern").orderBy("at")
    ends = F.coalesce(F.lead("at").over(history), F.to_date(F.lit(FOREVER)))
    return days.select("label", "pattern", F.col("at").alias("valid_from"), ends.alias("valid_to"), "active").where(
        "active").drop("active")


def _bucket(day: Column) -> Column:
    return F.floor(F.unix_date(day) / BUCKET_DAYS)


def judged(captures: DataFrame, log: DataFrame) -> DataFrame:
    """``(page_id, host, n_matches, labels, rejected)`` of captures ``(page_id, url, fetched)``,
    a row per capture; ``labels`` are the active ones, sorted and joined by commas."""
    rows = captures.select("page_id", "fetched", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                           F.monotonically_increasing_id().alias("row"))
    rows = cut(rows, "captures")
    entries = intervals(log)
    deepest = entries.agg(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 0
    probes = rows.where(F.col("host").isNotNull() & F.col("fetched").isNotNull()).select(
        F.col("row").alias("of_row"), "fetched", _bucket(F.col("fetched")).alias("probe_bucket"),
        F.explode(patterns_of(F.col("host"), F.col("path"), deepest)).alias("probe"))
    # an interval stands in each bucket it touches that holds captures; dates up to 9999 have 114,000 buckets at most
    held = sorted(r.bucket for r in rows.where("fetched IS NOT NULL").select(_bucket(F.col("fetched")).alias("bucket")).distinct().collect())
    begin, end = _bucket(F.col("valid_from")), _bucket(F.date_sub("valid_to", 1))
    buckets = F.filter(F.array(*map(F.lit, held)).cast("array<bigint>"), lambda b: (b >= begin) & (b <= end))
    entries = entries.where(F.col("valid_from") < F.col("valid_to")).select(
        "label", "pattern", "valid_from", "valid_to", F.explode(buckets).alias("bucket"))
    met = probes.join(entries, (F.col("probe") == F.col("pattern")) & (F.col("probe_bucket") == F.col("bucket"))
                      & (F.col("fetched") >= F.col("valid_from")) & (F.col("fetched") < F.col("valid_to")))
    matches = met.groupBy("of_row").agg(F.count(F.lit(1)).alias("n"),
                                        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"))
    joined = rows.join(matches, F.col("row") == F.col("of_row"), "left")
    return joined.select("page_id", "host", F.coalesce("n", F.lit(0)).cast("long").alias("n_matches"),
                         F.coalesce("labels", F.lit("")).alias("labels"), F.col("n").isNotNull().alias("rejected"))


def _draw(value: Column, salt: str, n: int) -> Column:
    """A repeatable number below ``n`` for a value."""
    return F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(salt), value)), 1, 8), 16, 10).cast("long"), F.lit(n))


def fetched_pages(pages: DataFrame) -> DataFrame:
    """Captures: the pages table has no dates, so a page's fetch day is drawn from its page_id over three years."""
    day = F.date_add(F.to_date(F.lit("2021-01-01")), _draw(F.col("page_id").cast("string"), "day", 1096).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched"))


def drawn_log(pages: DataFrame) -> DataFrame:
    """A list log over the hosts of all pages: about a third of the hosts, and a
    seventh of their first path parts, are added on a drawn day; half of those
    are removed later, and some of these added again."""
    base = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).where("host IS NOT NULL")
    hosts = base.select(F.col("host").alias("pattern"), F.lit(3).alias("one_in")).distinct()
    paths = base.select(F.concat_ws("/", "host", F.substring_index("path", "/", 1)).alias("pattern"), F.lit(7).alias("one_in")).where(
        "path <> ''").distinct()
    p = F.col("pattern")
    chosen = hosts.union(paths).where(_draw(p, "in", 21) % F.col("one_in") == 0)
    start = F.date_add(F.to_date(F.lit("2021-01-01")), _draw(p, "start", 700).cast("int"))
    gone = F.date_add(start, (_draw(p, "gone", 300) + 1).cast("int"))
    back = F.date_add(gone, (_draw(p, "back", 200) + 1).cast("int"))
    label = F.element_at(F.array(F.lit("adult"), F.lit("malware"), F.lit("spam")), (_draw(p, "label", 3) + 1).cast("int"))
    none = F.lit(None).cast("date")
    events = F.array(F.struct(F.lit("add").alias("action"), start.alias("at")),
                     F.struct(F.lit("remove").alias("action"), F.when(_draw(p, "ends", 2) == 0, gone).otherwise(none).alias("at")),
                     F.struct(F.lit("add").alias("action"), F.when(_draw(p, "ends", 4) == 0, back).otherwise(none).alias("at")))
    return chosen.select(label.alias("label"), "pattern", F.explode(events).alias("e")).select("label", "pattern", "e.action", "e.at")


def op8_url_lists(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return judged(fetched_pages(pages), cut(drawn_log(pages), "list-log"))


def _draw_sql(value: str, salt: str, n: int) -> str:
    return f"(CAST('0x' || substr(md5('{salt}' || {value}), 1, 8) AS BIGINT) % {n})"


OP8_SQL = f"""
WITH base AS (
  SELECT page_id, url,
    nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '^www\\.', ''), '') AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)', 1) AS path,
    DATE '2021-01-01' + CAST({_draw_sql('CAST(page_id AS VARCHAR)', 'day', 1096)} AS INTEGER) AS fetched
  FROM pages),
pats AS (
  SELECT DISTINCT host AS pattern, 3 AS one_in FROM base WHERE host IS NOT NULL
  UNION ALL
  SELECT DISTINCT host || '/' || split_part(path, '/', 1), 7 FROM base WHERE host IS NOT NULL AND path <> ''),
chosen AS (
  SELECT pattern,
    ['adult', 'malware', 'spam'][CAST({_draw_sql('pattern', 'label', 3)} + 1 AS INTEGER)] AS label,
    DATE '2021-01-01' + CAST({_draw_sql('pattern', 'start', 700)} AS INTEGER) AS s,
    CAST({_draw_sql('pattern', 'gone', 300)} + 1 AS INTEGER) AS g, CAST({_draw_sql('pattern', 'back', 200)} + 1 AS INTEGER) AS b,
    {_draw_sql('pattern', 'ends', 2)} = 0 AS ends, {_draw_sql('pattern', 'ends', 4)} = 0 AS again
  FROM pats WHERE {_draw_sql('pattern', 'in', 21)} % one_in = 0),
active AS (
  SELECT DISTINCT label, pattern, s AS f, CASE WHEN ends THEN s + g ELSE DATE '9999-12-31' END AS t FROM chosen
  UNION
  SELECT DISTINCT label, pattern, s + g + b, DATE '9999-12-31' FROM chosen WHERE again),
rows AS (SELECT row_number() OVER () AS rid, * FROM base),
hits AS (
  SELECT r.rid, a.label FROM rows r JOIN active a
  ON r.fetched >= a.f AND r.fetched < a.t
 AND (r.host = a.pattern OR ends_with(r.host, '.' || a.pattern)
      OR starts_with(r.host || '/' || rtrim(regexp_replace(r.path, '/+', '/', 'g'), '/') || '/', a.pattern || '/') AND contains(a.pattern, '/'))),
per AS (SELECT rid, count(*) AS n, array_to_string(list_sort(list_distinct(list(label))), ',') AS labels FROM hits GROUP BY rid)
SELECT r.page_id, r.host, coalesce(p.n, 0) AS n_matches, coalesce(p.labels, '') AS labels, p.n IS NOT NULL AS rejected
FROM rows r LEFT JOIN per p USING (rid)
"""
