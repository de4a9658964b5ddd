"""SimHash near-dedup by meet-in-the-middle ball hashing (operator 5).

A document's fingerprint is 64 bits: a bit is 1 where it is set in more than
half of the XXH64 hashes of its word shingles. Two fingerprints that differ in
at most ``max_bits`` bits have a common value within half that distance of
each. So every distinct fingerprint emits all variants within half the radius,
equal variants meet in one shuffle, and each member of a variant's group is
linked to the smallest fingerprint of the group after its distance is verified.

A group holds distinct fingerprints only, all within half the radius of the
variant, so its size is bounded by the ball (65 for two bits), however many
copies a text has: copies fold into one fingerprint before anything is emitted.
A star of links per group keeps every component without listing pairs.

Defined results: null and empty texts (and texts of separators only) have
fingerprint zero and are linked like any other; a text shorter than the
shingle is hashed whole; repeated rows come back once per row; a null doc_id
is never a component's id (a component of null ids only has a null id); an
empty table gives an empty result; columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, cut, numbered

BITS = 64
SEED = 42
HASHES_AT_ONCE = 1 << 16


def shingle_hashes(text: bytes, words: int) -> list[int]:
    """XXH64 of each shingle of the lower-cased (A-Z) words, repeats included."""
    parts = text.lower().split()  # bytes.split parts at space and 0x09-0x0D only
    if not parts:
        return []
    joined = b" ".join(parts)
    if len(parts) <= words:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = np.concatenate(([0], ends[:-1]))[: len(parts) - words + 1].tolist()
    stops = (ends[words - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s:e], SEED) for s, e in zip(starts, stops)]


def fingerprint(text: bytes, words: int) -> int:
    """The fingerprint as an unsigned number."""
    hashes = np.array(shingle_hashes(text, words), dtype="<u8")
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        some = hashes[at:at + HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, carried: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, simhash)`` with the fingerprint as a signed long, then the ``carried``
    columns of longs, a row per document."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = np.array([fingerprint(t.as_py() or b"", words) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]],
                                             ["doc_id", "simhash", *carried])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carried)
    return rows.mapInArrow(per_batch, ", ".join(f"{c} long" for c in ("doc_id", "simhash", *carried)))


def flips(radius: int) -> list[int]:
    """The masks of at most ``radius`` set bits, as signed longs."""
    masks = [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(BITS), k)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Star links ``(a, b)`` between distinct fingerprints (column ``simhash``).

    Each fingerprint emits its ball of the larger half of ``max_bits``; those
    variants within the smaller half are marked as bases. A member and a base
    of one variant differ by at most ``max_bits``, and two fingerprints that
    close always meet as member and base of some variant.
    """
    small, large = max_bits // 2, max_bits - max_bits // 2
    bases = len(flips(small))
    masks = F.array(*[F.struct(F.lit(m).alias("mask"), F.lit(i < bases).alias("base"))
                      for i, m in enumerate(flips(large))])
    balls = (prints.select("simhash").distinct().select("simhash", F.explode(masks).alias("m"))
             .select("simhash", F.col("simhash").bitwiseXOR(F.col("m.mask")).alias("variant"), "m.base"))
    lowest = F.min(F.when(F.col("base"), F.col("simhash"))).over(Window.partitionBy("variant"))
    stars = balls.select("simhash", lowest.alias("low")).where(F.col("low") != F.col("simhash"))
    stars = stars.where(F.bit_count(F.col("simhash").bitwiseXOR(F.col("low"))) <= max_bits)
    return stars.select(F.col("low").alias("a"), F.col("simhash").alias("b")).distinct()


def named_prints(prints: DataFrame, max_bits: int) -> DataFrame:
    """``(key, root, component_id)``: a row per distinct fingerprint of ``prints``;
    ``root`` is a fingerprint that its component has alone."""
    classes = prints.groupBy("simhash").agg(F.min("doc_id").alias("first_doc"))
    found = components(links(prints, max_bits))
    rooted = cut(classes.join(found, classes.simhash == found.node, "left")
                 .select("simhash", "first_doc", F.coalesce("root", "simhash").alias("root")), "rooted")
    lowest = rooted.groupBy(F.col("root").alias("of")).agg(F.min("first_doc").alias("component_id"))
    return cut(rooted.join(lowest, rooted.root == lowest.of)
               .select(F.col("simhash").alias("key"), "root", "component_id"), "named")


def simhash_groups(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """``(doc_id, simhash, component_id)``: a row per row of ``docs``."""
    prints = cut(fingerprints(docs, words), "simhash")
    named = named_prints(prints, max_bits).select("key", "component_id")
    return prints.join(named, prints.simhash == named.key).select("doc_id", "simhash", "component_id")


def keep_one_per_group(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of each component, all columns: the smallest by doc_id (nulls last), hash of the text and row number.

    Rows are told apart by their number in the table, so rows that share a
    doc_id, or have none, are judged each by its own text.
    """
    rows = numbered(docs)
    hashed = rows.select(F.col("whole.doc_id").cast("long").alias("doc_id"), F.col("whole.text").alias("text"), "row",
                         F.xxhash64(F.coalesce(F.col("whole.text").cast("string"), F.lit(""))).alias("hash"))
    prints = cut(fingerprints(hashed, words, ("hash", "row")), "simhash")
    named = named_prints(prints, max_bits)
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash", "row")
    kept = (prints.join(named, prints.simhash == named.key).groupBy("root").agg(F.min(rank).alias("first"))
            .select(F.col("first.row").alias("kept_row")))
    return rows.join(kept, rows.row == kept.kept_row, "left_semi").select("whole.*")


def op5_simhash_ball(spark, sf_dir):
    from .common import table

    groups = simhash_groups(table(spark, sf_dir, "documents"), words=3, max_bits=2)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")
