"""Mixing sources to target weights along a time-varying curriculum (operator 3).

Targets: the sources share ``share`` of all words by weight; a source stops at
``max_repeats`` times its own size and the excess is reshared by weight until
none is above. With sources in order of (limit / weight), the stopped ones are
a prefix, found from running sums.

Curriculum: each source's weight changes over training time t in [0, 1] as
``1 + tilt * (2 t - 1)``. Its integral times the target is the source's
cumulative demand for words by time t; a document copy is needed when the
demand reaches the words that stand before it in its source, so its training
position is the inverse of the demand there (closed form). Rows are
range-sorted by position.

The order within a source is by a hash of doc_id (and of the text, for
repeated ids), so reruns agree. Words before a document are summed in two
levels: per (source, hash bucket), then within the bucket. A source that holds
a third of all rows is thus spread over all its buckets; only bucket totals are
summed per source.

The first ``max_repeats - 1`` passes and the last take documents whole up to
the target; the document that crosses the target is taken in part (``taken``
counts words), so a source's taken words are its target rounded down.

Defined results: null text has size 0; a null source is a source of its own,
last in order; sources without words have target 0; documents not taken have a
null position; repeated rows are separate documents; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_GAPS, before_each, cut, numbered, table

#: Source weights and weight tilts over training time, by place of the source, repeating.
WEIGHTS = (3, 1, 2)
TILTS = (0.5, 0.0, -0.5)
SHARE_NUMERATOR, SHARE_DENOMINATOR = 3, 2  # 150 % of all words
MAX_REPEATS = 2
#: Hash buckets of a source, in hex digits of the hash: 4,096.
BUCKET_DIGITS = 3


def n_words(text):
    """Words of a text column: maximal runs of characters other than space and U+0009 to U+000D."""
    plain = F.translate(F.coalesce(text, F.lit("")), WORD_GAPS, " " * len(WORD_GAPS))
    return F.size(F.filter(F.split(plain, " "), lambda w: w != F.lit(""))).cast("long")


def cycled(values, place):
    """``values[place % len(values)]`` as a column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (place % len(values) + 1).cast("int"))


def targets(sizes: DataFrame, weights=WEIGHTS, tilts=TILTS) -> DataFrame:
    """``(source, source_size, weight, tilt, target)``, a row per source.

    Sources are dealt by range, once by name and once by limit, with running
    sums over the ranges; three totals over all of them reach the driver.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = before_each(per, [F.col("source").isNull(), F.hex(F.encode("source", "UTF-8"))], {})
    placed = (placed.withColumn("weight", cycled(weights, F.col("place")).cast("long"))
              .withColumn("tilt", cycled(tilts, F.col("place")))
              .withColumn("stop", F.col("source_size") * MAX_REPEATS).withColumnRenamed("place", "name_place"))
    ratio = F.col("stop") / F.col("weight").cast("double")
    running = cut(before_each(placed, [ratio, F.col("name_place")], {"stop_before": F.col("stop"), "weight_before": F.col("weight")}),
                  "mix-levels")
    words, weight = running.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted = (words or 0) * SHARE_NUMERATOR / SHARE_DENOMINATOR
    running = running.withColumn("level", (F.lit(wanted) - F.col("stop_before")) / (F.lit(weight or 0) - F.col("weight_before")))
    # level of the first source that does not stop: below it all stop, from it on none does
    free = running.where(F.col("level") * F.col("weight") <= F.col("stop")).agg(
        F.min(F.struct(F.col("place"), F.col("level"))).alias("first")).first().first
    stop = F.col("stop").cast("double")
    share = F.lit(free.level) * F.col("weight") if free else stop
    return running.select("source", "source_size", "weight", "tilt", F.when(share >= stop, stop).otherwise(share).alias("target"))


def ordered_key(id_column, text_column):
    """Pseudo-random but repeatable order of the documents of a source."""
    return F.md5(F.concat_ws("|", id_column.cast("string"), F.substring(F.md5(F.coalesce(text_column, F.lit(""))), 1, 8)))


def position(before, tilt, target):
    """Training time at which a source's cumulative demand reaches ``before`` words.

    Demand: target * (tilt t^2 + (1 - tilt) t); its inverse at u = before / target
    is 2 u / ((1 - tilt) + sqrt((1 - tilt)^2 + 4 tilt u)).
    """
    u = before / target
    flat = F.lit(1.0) - tilt
    return 2.0 * u / (flat + F.sqrt(flat * flat + 4.0 * tilt * u))


def mixed(docs: DataFrame, weights=WEIGHTS, tilts=TILTS, carried: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, size, source, source_size, target, taken, copies, before, tilt, key, position)`` and
    the ``carried`` columns, a row per document. Documents that the order leaves
    equal follow each other by the ``carried`` columns."""
    sizes = cut(docs.select("doc_id", F.col("source").alias("source"), n_words(F.col("text")).alias("size"),
                            ordered_key(F.col("doc_id"), F.col("text")).alias("key"), *carried), "mix-sizes")
    shares = cut(targets(sizes, weights, tilts), "mix-targets").withColumnRenamed("source", "of_source")
    rows = sizes.withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    # words of the source in buckets before this one: one row per source and bucket
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = F.sum("bucket_size").over(Window.partitionBy("source").orderBy("bucket")
                                        .rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(F.col("source").alias("of_source"), F.col("bucket").alias("of_bucket"),
                       F.coalesce(earlier, F.lit(0)).alias("earlier"))
    sums = (sums.alias("a").join(shares.alias("b"), F.col("a.of_source").eqNullSafe(F.col("b.of_source")))
            .select("a.of_source", "of_bucket", "earlier", "source_size", "tilt", "target"))
    inside = F.sum("size").over(Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", *carried)
                                .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("inside", F.coalesce(inside, F.lit(0)))
    rows = (rows.join(sums, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("bucket") == F.col("of_bucket")))
            .withColumn("before", F.col("earlier") + F.col("inside")))
    wanted = F.floor(F.col("target"))
    taken = sum((F.least(F.greatest(wanted - F.col("source_size") * k - F.col("before"), F.lit(0)), F.col("size"))
                 for k in range(MAX_REPEATS)), F.lit(0).cast("long"))
    # whole copies for consumers that never cut a document: a part of half or more counts as one
    copies = sum(((F.col("size") > 0) & ((wanted - F.col("source_size") * k - F.col("before")) * 2 >= F.col("size"))).cast("int")
                 for k in range(MAX_REPEATS))
    out = rows.withColumn("taken", taken).withColumn("copies", copies)
    return out.select("doc_id", "size", "source", "source_size", "target", "taken", "copies", "before", "tilt", "key", *carried,
                      F.when(F.col("taken") > 0, position(F.col("before"), F.col("tilt"), F.col("target"))).alias("position"))


def training_order(mix: DataFrame) -> DataFrame:
    """Rows range-sorted by position; ties and documents not taken by doc_id."""
    return mix.orderBy(F.col("position").asc_nulls_last(), "doc_id", "size")


def mixed_rows(docs: DataFrame, weights=WEIGHTS, tilts=TILTS) -> DataFrame:
    """The documents of the mix in training order, all columns of ``docs``.

    A document comes back once per whole copy taken (a part of half its words
    or more counts as a copy), each at its own training position. Texts are
    never cut. Documents without words are not taken. Rows are told apart by
    their number in the table, so each comes back with its own columns.
    """
    rows = numbered(docs)
    hashed = rows.select("whole.doc_id", "whole.source", "whole.text", F.xxhash64("whole.text").alias("mix_hash"),
                         F.col("row").alias("mix_row"))
    mix = mixed(hashed, weights, tilts, ("mix_hash", "mix_row"))
    times = F.filter(F.array(*[F.struct(F.lit(k).alias("k"), (F.col("copies") > k).alias("taken"))
                               for k in range(MAX_REPEATS)]), lambda c: c["taken"])
    slots = mix.select(F.col("mix_row").alias("of_row"), F.col("key").alias("mix_key"), F.explode(times).alias("c"),
                       "before", "source_size", "tilt", "target")
    slots = slots.select("of_row", "mix_key", position(
        F.col("before") + F.col("c.k") * F.col("source_size"), F.col("tilt"),
        F.greatest(F.col("target"), F.lit(1.0))).alias("mix_position"))
    joined = rows.join(slots, F.col("row") == F.col("of_row"))
    return joined.orderBy("mix_position", "mix_key", "row").select("whole.*")


def op3_curriculum_mix(spark, sf_dir):
    mix = training_order(mixed(table(spark, sf_dir, "documents")))
    return mix.select("doc_id", "size", "source_size", "target", "taken", F.col("position"))


def _cycle_sql(values, place: str) -> str:
    arms = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE ({place}) % {len(values)} {arms} END"


OP3_SQL = f"""
WITH s AS (
  SELECT doc_id, source,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]'), lambda w: w <> '')) AS size,
         md5(concat_ws('|', CAST(doc_id AS VARCHAR), substr(md5(coalesce(text, '')), 1, 8))) AS key
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM s GROUP BY source),
placed AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, hex(encode(source))) - 1 AS place FROM per),
weighted AS (
  SELECT *, {_cycle_sql(WEIGHTS, 'place')} AS weight, CAST({_cycle_sql(TILTS, 'place')} AS DOUBLE) AS tilt,
         source_size * {MAX_REPEATS} AS stop,
         CAST(sum(source_size) OVER () * {SHARE_NUMERATOR} AS DOUBLE) / {SHARE_DENOMINATOR} AS wanted
  FROM placed),
levels AS (
  SELECT *, (wanted - coalesce(sum(stop) OVER (ORDER BY CAST(stop AS DOUBLE) / weight, place
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY CAST(stop AS DOUBLE) / weight, place
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
final AS (
  SELECT *, first_value(CASE WHEN level * weight <= stop THEN level END IGNORE NULLS)
            OVER (ORDER BY CAST(stop AS DOUBLE) / weight, place
                  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS final FROM levels),
shares AS (
  SELECT source, source_size, tilt,
         CASE WHEN final IS NULL OR final * weight >= stop THEN CAST(stop AS DOUBLE) ELSE final * weight END AS target
  FROM final),
ordered AS (
  SELECT s.doc_id, s.size, h.source_size, h.target, h.tilt,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM s JOIN shares h ON s.source IS NOT DISTINCT FROM h.source),
taken AS (
  SELECT *, CAST(least(greatest(floor(target) - before, 0), size)
               + least(greatest(floor(target) - source_size - before, 0), size) AS BIGINT) AS taken FROM ordered)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, taken,
       CASE WHEN taken > 0 THEN 2.0::DOUBLE * (before / target)
         / ((1.0::DOUBLE - tilt) + sqrt((1.0::DOUBLE - tilt) * (1.0::DOUBLE - tilt) + 4.0::DOUBLE * tilt * (before / target)))
       END AS position
FROM taken
"""
