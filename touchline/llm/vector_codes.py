"""Vector codes: product quantisation with norm-of-sum bounds (operator 12).

Vectors become integers (``floor(scale * x)``) and are cut into equal parts,
each with a codebook of its own. A round gives every part the nearest entry of
its codebook (squared Euclidean distance, ties to the lower index) and moves
each entry to the floored mean of its parts; entries without parts stay.

The nearest entry is found without looking at most entries again. A part keeps
an upper bound of the distance to its entry and, for each group of entries, a
lower bound of the distance to the group's other entries. Every bound holds for
the codebook of the round it is stamped with. The codebooks of all rounds are
kept, so in a later round the bound is moved by the entry's *net* displacement
since its stamp, the norm of the summed moves; that is never more, and mostly
far less, than the sum of the norms which accumulated drifts would take. Only
parts whose bounds meet are measured: first their own entry, then the groups
that still come near. Measured bounds get the new stamp, all others keep theirs.

Distances are exact integers. Bounds are rounded outwards, and an entry is
passed over only where its bound is strictly farther, so codes equal those of
a full search, ties included.

The vectors and their bounds are one Parquet table a round, written and read
back, so a lost executor costs the tasks it held; the table before it is then
removed. The codebooks (``parts * entries`` rows, a parameter) are summed up in
each task, then in Spark, and are all that reaches the driver.

Defined results: rows with a null vector, or one that holds a null or
non-finite component, are dropped; vectors of no components have distance 0
everywhere; fewer rows than entries give a smaller codebook; a null vec_id
comes after all others among the first entries; rows of equal vec_id are
separate vectors; null labels are one label; an empty table gives an empty
result; other columns are ignored. Vectors of different lengths, of a length
that the parts do not divide, or with components whose squared distances leave
64 bits are an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, discard, salt, shared_totals, table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Groups of entries with a lower bound each.
GROUPS = 8
#: Outward rounding of bounds; far above what a few float64 steps lose.
SLACK = 1e-9
EXACT = 1 << 53
#: Distances measured at once by integer differences (components too large for exact float64 products).
AT_ONCE = 1 << 22


def usable(vector: Column) -> Column:
    """Not null, without null, NaN or infinite components."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(whole, F.lit(False))


def integer_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """``(vec_id, label, vector, salt)`` of the usable rows; components floored, as doubles (exact below 2^53)."""
    kept = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector"))
    kept = kept.where(usable(F.col("vector")))
    floored = F.transform("vector", lambda x: F.floor(x * scale).cast("long"))
    return kept.select("vec_id", "label", floored.alias("vector"), salt("vec_id", "vector").alias("salt"))


@dataclass
class Shape:
    """What the tasks need to know of the vectors."""

    parts: int
    width: int
    most: int  # largest absolute component

    @property
    def as_floats(self) -> bool:
        """Whether float64 products of these vectors are exact."""
        return max(1, self.width) * (2 * self.most) ** 2 < EXACT


def shape_of(rows: DataFrame, parts: int) -> Shape | None:
    """One aggregate over the rows; None for an empty table."""
    size = F.size("vector")
    most = F.array_max(F.transform("vector", lambda x: F.greatest(x, -1 - x)))
    low, high, most = rows.agg(F.min(size), F.max(size), F.max(most)).first()
    if low is None:
        return None
    if low != high or low % parts:
        raise ValueError(f"vectors of {low} to {high} components cannot be cut into {parts} equal parts")
    shape = Shape(parts, low // parts, (most or 0) + 1)
    if max(1, shape.width) * (2 * shape.most) ** 2 >= 1 << 62:
        raise ValueError("components too large: squared distances leave 64 bits")
    return shape


def distances(x: np.ndarray, entries: np.ndarray, shape: Shape) -> np.ndarray:
    """Exact squared distances of int64 vectors to int64 entries."""
    if shape.as_floats:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return (np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b) - 2 * (a @ b.T)).astype(np.int64)
    out = np.empty((len(x), len(entries)), dtype=np.int64)
    step = max(1, AT_ONCE // max(1, entries.size))
    for at in range(0, len(x), step):
        apart = x[at:at + step, None, :] - entries
        out[at:at + step] = np.einsum("ijk,ijk->ij", apart, apart)
    return out


def own_distances(x: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Exact squared distance of each vector to its own entry."""
    apart = x - own
    return np.einsum("ij,ij->i", apart, apart)


def below(squares: np.ndarray) -> np.ndarray:
    """Distances rounded down to float32."""
    return np.nextafter((np.sqrt(squares.astype(np.float64)) * (1 - SLACK)).astype(np.float32), np.float32(-1))


def above(squares: np.ndarray) -> np.ndarray:
    """Distances rounded up to float32."""
    return np.nextafter((np.sqrt(squares.astype(np.float64)) * (1 + SLACK)).astype(np.float32), np.float32(np.inf))


def state_type(groups: int) -> np.dtype:
    """A part's state: its entry, the bounds, and the round each bound holds for."""
    return np.dtype([("entry", "<i4"), ("upper", "<f4"), ("upper_at", "u1"),
                     ("lower", "<f4", (groups,)), ("lower_at", "u1", (groups,))])


def group_slices(entries: int) -> list[slice]:
    edges = [len(x) for x in np.array_split(np.arange(entries), min(GROUPS, entries))]
    ends = np.cumsum(edges)
    return [slice(int(end - n), int(end)) for n, end in zip(edges, ends)]


class Bounds:
    """One part's bounds against the newest codebook, over the history of its codebooks."""

    def __init__(self, history: np.ndarray, shape: Shape):
        self.shape, self.entries, self.now = shape, history[-1], len(history) - 1
        self.groups = group_slices(len(self.entries))
        self.group_of = np.concatenate([np.full(g.stop - g.start, i) for i, g in enumerate(self.groups)])
        # net displacement of every entry since each round, and the largest of each group
        moved = (history - history[-1]).astype(np.float64)
        self.net = np.sqrt(np.einsum("tij,tij->ti", moved, moved)) * (1 + SLACK)
        self.net_most = np.stack([self.net[:, g].max(axis=1) for g in self.groups], axis=1)

    def first(self, x: np.ndarray) -> np.ndarray:
        """States of parts that have none: every entry is measured."""
        state = np.zeros(len(x), dtype=state_type(len(self.groups)))
        squares = distances(x, self.entries, self.shape)
        state["entry"] = squares.argmin(axis=1)
        every = np.arange(len(x))
        state["upper"] = above(squares[every, state["entry"]])
        squares[every, state["entry"]] = np.iinfo(np.int64).max
        for i, g in enumerate(self.groups):
            state["lower"][:, i] = below(squares[:, g].min(axis=1))
        return state

    def again(self, x: np.ndarray, state: np.ndarray) -> int:
        """Bring states to the newest codebook, measuring only where moved bounds meet. Returns the distances measured."""
        upper = (state["upper"] + self.net[state["upper_at"], state["entry"]]) * (1 + SLACK)
        lower = state["lower"] - self.net_most[state["lower_at"], np.arange(len(self.groups))]
        lower = np.where(lower > 0, lower * (1 - SLACK), lower)
        doubt = np.flatnonzero((lower <= upper[:, None]).any(axis=1))
        if not len(doubt):
            return 0
        # their own entry first: a tight upper bound settles many
        x, lower, before = x[doubt], lower[doubt], state["entry"][doubt].astype(np.int64)
        best = own_distances(x, self.entries[before])
        best_entry, own = before.copy(), best.copy()
        near = lower <= above(best)[:, None]
        taken = len(doubt)
        least = np.zeros(near.shape, dtype=np.int64)
        second = np.zeros(near.shape, dtype=np.int64)
        least_entry = np.zeros(near.shape, dtype=np.int64)
        for i, g in enumerate(self.groups):
            rows = np.flatnonzero(near[:, i])
            if not len(rows):
                continue
            squares = distances(x[rows], self.entries[g], self.shape)
            taken += squares.size
            at = squares.argmin(axis=1)
            every = np.arange(len(rows))
            least[rows, i], least_entry[rows, i] = squares[every, at], at + g.start
            squares[every, at] = np.iinfo(np.int64).max
            second[rows, i] = squares.min(axis=1)
            found, entry = least[rows, i], least_entry[rows, i]
            closer = (found < best[rows]) | ((found == best[rows]) & (entry < best_entry[rows]))
            best[rows[closer]], best_entry[rows[closer]] = found[closer], entry[closer]
        state["entry"][doubt], state["upper"][doubt], state["upper_at"][doubt] = best_entry, above(best), self.now
        for i in range(len(self.groups)):
            rows = np.flatnonzero(near[:, i])
            others = np.where(least_entry[rows, i] == best_entry[rows], second[rows, i], least[rows, i])
            state["lower"][doubt[rows], i], state["lower_at"][doubt[rows], i] = below(others), self.now
        # the entry that was left counts among the others of its group, if that was not measured
        left = np.flatnonzero((best_entry != before) & ~near[np.arange(len(doubt)), self.group_of[before]])
        group = self.group_of[before[left]]
        held = np.minimum(lower[left, group], below(own[left]))
        state["lower"][doubt[left], group] = np.nextafter(held.astype(np.float32), np.float32(-np.inf))
        state["lower_at"][doubt[left], group] = self.now
        return taken


def as_matrix(column: pa.Array, shape: Shape) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.int64).reshape(len(column), shape.parts, shape.width)


def assign(rows: DataFrame, history: np.ndarray, shape: Shape) -> DataFrame:
    """``rows`` with the state of every part against the newest codebook (``history``: rounds, parts, entries, width)."""
    kind = state_type(len(group_slices(history.shape[2])))
    books = rows.sparkSession.sparkContext.broadcast(history)  # rounds * parts * entries vectors, by parameters

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = [Bounds(books.value[:, p], shape) for p in range(shape.parts)]
        for batch in batches:
            x = as_matrix(batch.column("vector"), shape)
            if "state" not in batch.schema.names:
                states = np.stack([b.first(x[:, p]) for p, b in enumerate(bounds)], axis=1)
            else:
                packed = b"".join(batch.column("state").to_pylist())
                states = np.frombuffer(packed, dtype=kind).reshape(len(x), shape.parts).copy()
                for p, b in enumerate(bounds):
                    of_part = states[:, p].copy()
                    b.again(x[:, p], of_part)
                    states[:, p] = of_part
            blob = [row.tobytes() for row in states]
            columns = [batch.column(name) for name in ("vec_id", "label", "vector", "salt")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(blob, pa.binary())],
                                             ["vec_id", "label", "vector", "salt", "state"])

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "state"]
    return cut(rows.mapInArrow(step, ", ".join([*fields, "state binary"])), "vector-codes")


def entry_sums(rows: DataFrame, entries: int, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Count and componentwise sum of the parts of every entry: summed in each task, then in Spark."""
    kind = state_type(len(group_slices(entries)))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((shape.parts, entries), dtype=np.int64)
        sums = np.zeros((shape.parts, entries, shape.width), dtype=np.int64)
        for batch in batches:
            x = as_matrix(batch.column("vector"), shape)
            states = np.frombuffer(b"".join(batch.column("state").to_pylist()), dtype=kind).reshape(len(x), shape.parts)
            for p in range(shape.parts):
                counts[p] += np.bincount(states["entry"][:, p], minlength=entries)
                np.add.at(sums[p], states["entry"][:, p], x[:, p])
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]),
             pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    partial = rows.select("vector", "state").mapInArrow(step, "part int, entry int, n long, sums array<long>")
    total = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(shape.width)]).alias("sums"))
    counts = np.zeros((shape.parts, entries), dtype=np.int64)
    sums = np.zeros((shape.parts, entries, shape.width), dtype=np.int64)
    for row in total.collect():  # parts * entries rows
        counts[row.part, row.entry] = row.n
        sums[row.part, row.entry] = row.sums
    return counts, sums


def first_entries(rows: DataFrame, entries: int, shape: Shape) -> np.ndarray:
    """The parts of the smallest vec_ids, ascending: the first codebooks."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    values = np.array([r.vector for r in first], dtype=np.int64).reshape(len(first), shape.parts, shape.width)
    return values.transpose(1, 0, 2)


@dataclass
class Compressed:
    """``rows``: ``(vec_id, label, salt, vector, state)``; ``codebooks``: parts, entries, width."""

    rows: DataFrame
    history: np.ndarray
    shape: Shape

    @property
    def codebooks(self) -> np.ndarray:
        return self.history[-1]

    def digest(self) -> str:
        """SHA-256 of all entries' components in decimal, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()

    def codes(self) -> DataFrame:
        """``(vec_id, label, salt, code, error)``: an index of two hex digits a part, and the summed squared distances."""
        kind, shape, books = state_type(len(group_slices(self.history.shape[2]))), self.shape, self.codebooks
        digits = max(2, len(f"{books.shape[1] - 1:x}"))

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = as_matrix(batch.column("vector"), shape)
                packed = b"".join(batch.column("state").to_pylist())
                entry = np.frombuffer(packed, dtype=kind).reshape(len(x), shape.parts)["entry"]
                error = sum(own_distances(x[:, p], books[p][entry[:, p]]) for p in range(shape.parts))
                code = ["".join(f"{e:0{digits}x}" for e in row) for row in entry.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("label"), batch.column("salt"), pa.array(code, pa.string()),
                     pa.array(error, pa.int64())], ["vec_id", "label", "salt", "code", "error"])

        fields = [f"{f.name} {f.dataType.simpleString()}" for f in self.rows.schema.fields
                  if f.name in ("vec_id", "label", "salt")]
        return self.rows.mapInArrow(step, ", ".join([*fields, "code string", "error long"]))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> Compressed | None:
    """Train codebooks over all vectors and give every part its code; None for an empty table."""
    rows = cut(integer_vectors(vectors, scale), "vector-integers")
    shape = shape_of(rows, parts)
    if shape is None:
        return None
    history = [first_entries(rows, entries, shape)]
    for turn in range(rounds + 1):
        before, rows = rows, assign(rows, np.stack(history), shape)
        discard(before)
        if turn < rounds:
            counts, sums = entry_sums(rows, history[-1].shape[1], shape)
            means = sums // np.maximum(counts, 1)[:, :, None]
            history.append(np.where(counts[:, :, None] > 0, means, history[-1]))
    return Compressed(rows, np.stack(history), shape)


def op12_vector_codes(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    found = compress(vectors)
    if found is None:
        return vectors.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                              F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256")).limit(0)
    codes = cut(found.codes(), "vector-errors")
    summed = shared_totals(codes, ("label",), {"label_error": (F.sum("error"), F.sum("label_error"))})
    return summed.select("vec_id", "code", "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256"))


def _round_sql(t: int) -> str:
    """The assignment to the codebooks of round ``t`` and the codebooks after it."""
    return f"""
a{t} AS MATERIALIZED (
  SELECT x.rn, x.p, any_value(x.x) AS x, min(CAST(list_dot_product(x.x, x.x) + list_dot_product(c.c, c.c)
         - 2 * list_dot_product(x.x, c.c) AS BIGINT) * {ENTRIES} + c.e) AS best
  FROM x JOIN c{t} c ON x.p = c.p GROUP BY x.rn, x.p),
m{t} AS (
  SELECT p, e, list(v ORDER BY i) AS c FROM (
    SELECT p, best % {ENTRIES} AS e, i, floor(sum(x[i]) / count(*)) AS v
    FROM a{t}, range(1, (SELECT max(len(x)) FROM x) + 1) r(i) GROUP BY p, best % {ENTRIES}, i)
  GROUP BY p, e),
c{t + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.c, c.c) AS c FROM c{t} c LEFT JOIN m{t} m ON c.p = m.p AND c.e = m.e)"""


OP12_SQL = f"""
WITH k AS (
  SELECT vec_id, label, list_transform(embedding, lambda v: floor({SCALE} * CAST(v AS DOUBLE))) AS v,
         row_number() OVER (ORDER BY vec_id) - 1 AS rn
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
x AS MATERIALIZED (
  SELECT rn, p, list_slice(v, p * (len(v) // {PARTS}) + 1, (p + 1) * (len(v) // {PARTS})) AS x FROM k, range({PARTS}) r(p)),
c0 AS MATERIALIZED (SELECT p, rn AS e, x AS c FROM x WHERE rn < {ENTRIES}),{",".join(_round_sql(t) for t in range(ROUNDS))},
last AS (
  SELECT x.rn, x.p, min(CAST(list_dot_product(x.x, x.x) + list_dot_product(c.c, c.c)
         - 2 * list_dot_product(x.x, c.c) AS BIGINT) * {ENTRIES} + c.e) AS best
  FROM x JOIN c{ROUNDS} c ON x.p = c.p GROUP BY x.rn, x.p),
coded AS (
  SELECT rn, string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY p) AS code,
         CAST(sum(best // {ENTRIES}) AS BIGINT) AS error FROM last GROUP BY rn),
book AS (
  SELECT sha256(string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS digest
  FROM (SELECT p, e, unnest(c) AS v, generate_subscripts(c, 1) AS i FROM c{ROUNDS}))
SELECT k.vec_id, d.code, d.error, CAST(sum(d.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
       book.digest AS codebooks_sha256
FROM k JOIN coded d ON k.rn = d.rn CROSS JOIN book
"""
