"""Hard-negative mining over integer inner products (operator 13).

Vectors become integers (``floor(scale * x)``). An anchor's positives are the
rows of its label with the highest inner products; its hard negatives, for each
positive, are the rows of other labels with the highest products between
``LOW`` and ``HIGH`` hundredths of the positive's.

All anchors (a stated part of the rows) meet all rows in blocks. Rows are
written once as files of about ``RANGE_ROWS`` rows, ordered by vec_id inside;
anchors as files of about ``BLOCK_ROWS``. A work item is one anchor file and one
candidate file, read from the shared folder by the task that has it, so neither
side is shuffled, broadcast or held whole. The products of a tile of anchors
and candidates are one matrix product of int64 tiles by Strassen's recursion:
odd sides are padded with zeros, quadrants are added and subtracted as exact
integers, and seven products replace eight until a side reaches ``LEAF``.

Heaps hold the best few of a file per anchor (or per anchor and positive), by
score and then vec_id. Heaps merge: files of a task into the task's, tasks' by a
window in Spark whose input is those few rows. A work item holds one anchor
file, one tile of scores and its heaps. The first pass finds the positives, the
second the windows they open.

Defined results: rows with a null label, a null vector, or a null or non-finite
component take no part; a null vec_id is never an anchor, and comes after all
others of equal score; rows of equal vec_id are rows of their own (each one an
anchor, each the other's positive); anchors without positives or without rows in
the window have no result; vectors of no components have score 0; an empty
table gives an empty result; other columns are ignored. Labels are integers.
Vectors of different lengths, or components whose products leave 62 bits, are
an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import MOST_TASKS, cut, table
from .vector_codes import usable

SCALE, ANCHOR_EVERY, POSITIVES, NEGATIVES = 256, 50, 5, 3
LOW, HIGH = 50, 95  # hundredths of the positive's score
RANGE_ROWS, BLOCK_ROWS, TILE_ROWS, LEAF = 1 << 14, 512, 2048, 16
EXACT = 1 << 53
#: Score of a place that is not taken; every real score is above.
VACANT = -(1 << 62)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of int64 matrices; through float64 where its size proves that exact."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Product of int64 matrices by Strassen's recursion (exact modulo 2^64)."""
    rows, inner, columns = *a.shape, b.shape[1]
    if min(rows, inner, columns) <= leaf:
        return product(a, b)
    a = np.pad(a, ((0, rows % 2), (0, inner % 2)))
    b = np.pad(b, ((0, inner % 2), (0, columns % 2)))
    up, left, over = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:up, :left], a[:up, left:], a[up:, :left], a[up:, left:]
    b11, b12, b21, b22 = b[:left, :over], b[:left, over:], b[left:, :over], b[left:, over:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * up, 2 * over), dtype=np.int64)
    out[:up, :over] = p1 + p4 - p5 + p7
    out[:up, over:] = p3 + p5
    out[up:, :over] = p2 + p4
    out[up:, over:] = p1 - p2 + p3 + p6
    return out[:rows, :columns]


class Heaps:
    """The best ``k`` of each of many rows, by score (highest first), then vec_id (nulls last)."""

    def __init__(self, rows: int, k: int):
        self.k = k
        self.score = np.full((rows, k), VACANT, dtype=np.int64)
        self.id = np.zeros((rows, k), dtype=np.int64)
        self.null = np.zeros((rows, k), dtype=bool)

    def merge(self, other: Heaps) -> None:
        score, ids, null = (np.concatenate(pair, axis=1) for pair in
                            ((self.score, other.score), (self.id, other.id), (self.null, other.null)))
        order = np.lexsort((ids, null, -score), axis=1)[:, :self.k]
        self.score, self.id, self.null = (np.take_along_axis(x, order, axis=1) for x in (score, ids, null))

    def offer(self, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """Add a tile's allowed scores. Tiles come in the order of vec_id, so a later equal score stays out."""
        allowed = allowed & (scores > self.score[:, -1:])
        if np.count_nonzero(allowed) > 16 * self.k * len(scores) and scores.shape[1] > self.k:
            held = np.where(allowed, scores, VACANT)
            least = np.partition(held, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k]
            allowed &= scores >= least[:, None]
        row, column = np.nonzero(allowed)
        if not len(row):
            return
        score = scores[row, column]
        order = np.lexsort((column, -score, row))
        row, column, score = row[order], column[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best = place < self.k
        row, column, score, place = row[best], column[best], score[best], place[best]
        found = Heaps(len(scores), self.k)
        found.score[row, place], found.id[row, place], found.null[row, place] = score, ids[column], null[column]
        self.merge(found)


@dataclass
class Block:
    """Rows of a file as arrays."""

    row: np.ndarray
    id: np.ndarray
    null: np.ndarray
    label: np.ndarray
    vector: np.ndarray
    table: pa.Table

    @classmethod
    def read(cls, path: str) -> Block:
        store, at = fs.FileSystem.from_uri(path)
        with store.open_input_file(at) as file:
            found = pq.read_table(file).combine_chunks()
        ids = found.column("vec_id")
        flat = np.concatenate([np.zeros(0, dtype=np.int64), *[c.flatten().to_numpy() for c in found.column("vector").chunks]])
        return cls(found.column("row").to_numpy(), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(),
                   found.column("label").to_numpy(), flat.reshape(len(found), -1) if len(found) else flat.reshape(0, 0), found)

    def __len__(self) -> int:
        return len(self.row)


class Positives:
    """Heaps of the highest products within the anchor's label."""

    FIELDS = "anchor long, anchor_id long, positive_score long, positive_id long"

    def __init__(self, anchors: Block, k: int):
        self.anchors, self.k, self.total = anchors, k, Heaps(len(anchors), k)

    def start(self) -> None:
        self.of_file = Heaps(len(self.anchors), self.k)

    def offer(self, scores: np.ndarray, block: Block, part: slice) -> None:
        allowed = ((self.anchors.label[:, None] == block.label[part]) & (self.anchors.row[:, None] != block.row[part])
                   & (scores >= self.total.score[:, -1:]))
        self.of_file.offer(scores, allowed, block.id[part], block.null[part])

    def end(self) -> None:
        self.total.merge(self.of_file)

    def rows(self) -> pa.RecordBatch:
        row, place = np.nonzero(self.total.score > VACANT)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.anchors.row[row]), pa.array(self.anchors.id[row]), pa.array(self.total.score[row, place]),
             pa.array(self.total.id[row, place], mask=self.total.null[row, place])],
            ["anchor", "anchor_id", "positive_score", "positive_id"])


class Negatives:
    """Heaps of the highest products of other labels in the window of each positive (``scores``: its score, by place)."""

    FIELDS = "anchor long, place int, negative_score long, negative_id long"

    def __init__(self, anchors: Block, k: int, low: int, high: int):
        self.anchors, self.k = anchors, k
        lists = anchors.table.column("scores").to_pylist()
        self.places = max(map(len, lists), default=0)
        self.windows = []
        for place in range(self.places):
            has = np.array([len(x) > place for x in lists])
            score = np.array([x[place] if len(x) > place else 0 for x in lists], dtype=np.int64)
            # integers s with low * score <= 100 * s <= high * score
            self.windows.append((has, -((-low * score) // 100), (high * score) // 100))
        self.total = [Heaps(len(anchors), k) for _ in range(self.places)]

    def start(self) -> None:
        self.of_file = [Heaps(len(self.anchors), self.k) for _ in range(self.places)]

    def offer(self, scores: np.ndarray, block: Block, part: slice) -> None:
        other = self.anchors.label[:, None] != block.label[part]
        for (has, least, most), total, heaps in zip(self.windows, self.total, self.of_file):
            least = np.maximum(least, total.score[:, -1])
            allowed = other & has[:, None] & (scores >= least[:, None]) & (scores <= most[:, None])
            heaps.offer(scores, allowed, block.id[part], block.null[part])

    def end(self) -> None:
        for total, heaps in zip(self.total, self.of_file):
            total.merge(heaps)

    def rows(self) -> pa.RecordBatch:
        found = [(place, *np.nonzero(heaps.score > VACANT)) for place, heaps in enumerate(self.total)]
        out = [(self.anchors.row[row], np.full(len(row), place), self.total[place].score[row, at],
                pa.array(self.total[place].id[row, at], mask=self.total[place].null[row, at])) for place, row, at in found]
        names = ["anchor", "place", "negative_score", "negative_id"]
        if not out:
            return pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64())], names)
        anchor, place, score, ids = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(anchor)), pa.array(np.concatenate(place), pa.int32()),
                                           pa.array(np.concatenate(score)), pa.concat_arrays(ids)], names)


def mined(anchors: DataFrame, candidates: DataFrame, heaps_of, fields: str) -> DataFrame:
    """The rows of the heaps that ``heaps_of(anchor block)`` fills from all candidates, a set per anchor block and task."""
    spark = anchors.sparkSession
    # a path per file: what Spark's own file index holds on the driver for a scan of the two tables
    files = spark.sparkContext.broadcast((sorted(anchors.inputFiles()), sorted(candidates.inputFiles())))
    blocks, ranges = map(len, files.value)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor_files, candidate_files = files.value
        items = (item for batch in batches for item in batch.column("id").to_pylist())
        for block, of_block in groupby(items, key=lambda item: item // ranges):
            anchor_block = Block.read(anchor_files[block])
            if not len(anchor_block):
                continue
            heaps = heaps_of(anchor_block)
            for item in of_block:
                block_rows = Block.read(candidate_files[item % ranges])
                heaps.start()
                for at in range(0, len(block_rows), TILE_ROWS):
                    part = slice(at, at + TILE_ROWS)
                    scores = strassen(anchor_block.vector, np.ascontiguousarray(block_rows.vector[part].T))
                    heaps.offer(scores, block_rows, part)
                heaps.end()
            yield heaps.rows()

    items = spark.range(0, blocks * ranges, 1, max(1, min(blocks * ranges, MOST_TASKS)))
    return items.mapInArrow(step, fields)


def mine(vectors: DataFrame, is_anchor: Column, scale: int = SCALE, positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of all anchors."""
    kept = vectors.select("vec_id", F.col("label").cast("long").alias("label"),
                          F.col("embedding").cast("array<double>").alias("vector"))
    kept = kept.where(F.col("label").isNotNull() & usable(F.col("vector")))
    kept = kept.withColumn("vector", F.transform("vector", lambda x: F.floor(x * scale).cast("long")))
    size = F.size("vector")
    n, short, long, most = kept.agg(F.count(F.lit(1)), F.min(size), F.max(size),
                                    F.max(F.array_max(F.transform("vector", lambda x: F.greatest(x, -1 - x))))).first()
    empty = vectors.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                                     "positive_score long, negative_score long")
    if not n:
        return empty
    if short != long:
        raise ValueError(f"vectors of {short} to {long} components")
    if max(1, long) * ((most or 0) + 1) ** 2 * 100 >= 1 << 62:
        raise ValueError("components too large: inner products leave 62 bits")
    ranged = kept.repartition(-(-n // RANGE_ROWS)).sortWithinPartitions(F.col("vec_id").asc_nulls_last())
    candidates = cut(ranged.withColumn("row", F.monotonically_increasing_id()), "candidates")
    chosen = candidates.where(F.coalesce(is_anchor, F.lit(False)))
    n_anchors = chosen.count()
    if not n_anchors:
        return empty
    blocks = -(-n_anchors // BLOCK_ROWS)
    anchors = cut(chosen.repartition(blocks), "anchors")

    best = Window.partitionBy("anchor").orderBy(F.col("positive_score").desc(), F.col("positive_id").asc_nulls_last())
    found = mined(anchors, candidates, lambda block: Positives(block, positives), Positives.FIELDS)
    places = cut(found.withColumn("place", F.row_number().over(best) - 1).where(F.col("place") < positives), "positives")
    # at most ``positives`` scores an anchor
    scores = places.groupBy(F.col("anchor").alias("row")).agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("s"))
    scores = scores.select("row", F.col("s.positive_score").alias("scores"))
    asking = cut(anchors.join(scores, "row").repartition(blocks), "asking")

    found = mined(asking, candidates, lambda block: Negatives(block, negatives, low, high), Negatives.FIELDS)
    hardest = Window.partitionBy("anchor", "place").orderBy(F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(hardest)).where(F.col("rank") <= negatives)
    return ranked.join(places, ["anchor", "place"]).select("anchor_id", "positive_id", "rank", "negative_id",
                                                           "positive_score", "negative_score")


def op13_hard_negatives(spark, sf_dir):
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", relabelled)
    return mine(vectors, F.col("vec_id") % ANCHOR_EVERY == 0)


OP13_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % {ANCHOR_EVERY} = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES})
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INT) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND {LOW} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= {NEGATIVES}
"""
