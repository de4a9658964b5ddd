"""Exact dedup by content hash with a byte comparison inside groups (operator 11).

Rows with equal texts form a class; one row of each class stays, the one with
the smallest (or, as asked, the largest) doc_id.

1. One narrow row per document is written: doc_id, the 128-bit hash of the
   text, its SHA-256, a row number and a salt. Later steps read these rows, so
   numbers are given once, whatever tasks a later job has.
2. Bytes are compared by grouping on (hash, text): a hash with two texts is a
   collision. Equal texts of a task are folded before the shuffle, so a class
   of any size sends one text per task. Rows of colliding hashes alone are
   looked up again by their text and get the place of the text within its hash.
3. Classes are counted in two levels, by (hash, place, salt) and then by (hash,
   place), and handed back to the rows by (hash, place, salt). A class with a
   third of all rows is dealt over all salts, on the way in and on the way out.

Defined results: null text is the empty text; a null doc_id comes after all
others (it is the class's id only where no member has an id, and keep_id is
then null); of rows that share the kept doc_id, the first by row number stays;
repeated rows are separate documents; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, is_empty, salt, shared_totals, table

#: Places that follow each other in the order of texts within a colliding hash.
CLASS = ("content", "place")


def content_hash(text: Column) -> Column:
    """128 bits of a text: MD5 of its UTF-8 bytes."""
    return F.unhex(F.md5(text))


def hashed_rows(docs: DataFrame, hash_of=content_hash) -> DataFrame:
    """``(doc_id, content, text_sha256, row, salt)`` per row, written once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", hash_of(text).alias("content"), F.sha2(text, 256).alias("text_sha256"),
                       F.monotonically_increasing_id().alias("row"))
    return cut(rows.withColumn("salt", salt("doc_id", "row")), "exact-rows")


def collisions(docs: DataFrame, hash_of=content_hash) -> DataFrame:
    """``(content, body, place)``: the texts of every hash that has more than one, compared byte by byte."""
    texts = (docs.select(F.coalesce(F.col("text"), F.lit("")).alias("body"))
             .select(hash_of(F.col("body")).alias("content"), "body").distinct())
    several = cut(texts.groupBy("content").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1"), "exact-collisions")
    if is_empty(several):
        return several.select("content", F.lit("").alias("body"), F.lit(0).alias("place"))
    clash = texts.join(several, "content", "left_semi")
    by_bytes = Window.partitionBy("content").orderBy(F.encode("body", "UTF-8"))
    return clash.select("content", "body", (F.row_number().over(by_bytes) - 1).alias("place"))


def placed_rows(docs: DataFrame, hash_of=content_hash) -> DataFrame:
    """The rows of :func:`hashed_rows` and ``place``, which tells the texts of one hash apart.

    Rows of a hash with one text keep their row. Those of a colliding hash are
    read again with their texts, and numbered below zero, as they are other rows.
    """
    rows = hashed_rows(docs, hash_of)
    found = collisions(docs, hash_of)
    if is_empty(found):
        return rows.withColumn("place", F.lit(0))
    found = cut(found, "exact-places")
    text = F.coalesce(F.col("text"), F.lit(""))
    named = docs.select("doc_id", text.alias("body"), hash_of(text).alias("content"))
    again = (named.join(found, ["content", "body"])
             .select("doc_id", "content", F.sha2("body", 256).alias("text_sha256"),
                     (-1 - F.monotonically_increasing_id()).alias("row"), "place"))
    again = again.withColumn("salt", salt("doc_id", "row"))
    sole = rows.join(found.select("content").distinct(), "content", "left_anti").withColumn("place", F.lit(0))
    return cut(sole.unionByName(again), "exact-placed")


def classes(docs: DataFrame, keep: str = "smallest", hash_of=content_hash) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, a row per document."""
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep: smallest or largest, not {keep}")
    # the kept row is the least of these: rows with an id first, then by id, then by row number
    order = F.col("doc_id") if keep == "smallest" else -1 - F.col("doc_id")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), order.alias("order"), "row", "doc_id")
    rows = placed_rows(docs, hash_of).withColumn("rank", rank)
    out = shared_totals(rows, CLASS, {
        "group_size": (F.count(F.lit(1)), F.sum("group_size")),
        "first": (F.min("rank"), F.min("first")),
    })
    return out.select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
                      (F.col("rank.row") == F.col("first.row")).alias("kept"), "text_sha256")


def op11_exact_dedup(spark, sf_dir):
    return classes(table(spark, sf_dir, "documents"), keep="largest")


OP11_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
k AS (
  SELECT doc_id, body, max(doc_id) OVER (PARTITION BY body) AS keep_id,
         count(*) OVER (PARTITION BY body) AS group_size,
         row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) AS place
  FROM t)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM k
"""
