"""Operators 11 to 13 against brute force: edge cases of the tables, ties, repeated rows and hot keys."""

from __future__ import annotations

import hashlib
import math
import os
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm import exact_dedup, hard_negatives, queries, vector_codes
from touchline.llm.common import cut

SF = "/root/testdata/sf0.001"
LONG = "a very long text " * 100_000


# --- operator 11

DOCS = [(1, "one"), (2, "two"), (3, "one"), (7, "one"), (4, None), (5, ""), (None, "two"), (None, "no id"), (None, "no id"),
        (9, LONG), (10, LONG), (11, LONG + "x"), (12, "One"), (13, "one "), (2, "two"), (-4, "two"), (14, "é"), (15, "é")]
DOC_COLUMNS = "doc_id long, text string, source string, row long, content string, place int, salt int, body string"


def doc_table(spark, rows):
    return cut(spark.createDataFrame([(d, t, None, 1, "c", 2, 3, "b") for d, t in rows], DOC_COLUMNS), "docs11")


def exact_by_hand(rows, keep):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        first = (min if keep == "smallest" else max)(known) if known else None
        kept = False
        for doc_id in ids:
            stays = doc_id == first and not kept
            kept |= stays
            out.append((doc_id, first, len(ids), stays, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def plain(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_classes_equal_brute_force(spark, keep):
    assert plain(exact_dedup.classes(doc_table(spark, DOCS), keep)) == exact_by_hand(DOCS, keep)


@pytest.mark.parametrize("digits", [0, 1])
def test_colliding_hashes_are_told_apart_by_their_bytes(spark, digits):
    """With a hash of 0 or 4 bits nearly all texts collide; the classes stay those of the bytes."""
    weak = lambda text: F.substring(F.md5(text), 1, digits)
    assert plain(exact_dedup.classes(doc_table(spark, DOCS), "largest", weak)) == exact_by_hand(DOCS, "largest")


def test_exact_classes_of_a_hot_text(spark):
    rows = [(i, "copy" if i % 3 else f"text {i}") for i in range(3000)] + [(None, "copy")] * 50
    assert plain(exact_dedup.classes(doc_table(spark, rows), "smallest")) == exact_by_hand(rows, "smallest")


def test_exact_classes_do_not_depend_on_how_later_jobs_are_split(spark):
    docs = doc_table(spark, DOCS).repartition(5)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    rows = exact_dedup.placed_rows(docs)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
        assert len({r.row for r in rows.collect()}) == len(DOCS)
        assert plain(exact_dedup.classes(docs, "largest")) == exact_by_hand(DOCS, "largest")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_exact_classes_of_an_empty_table(spark):
    assert exact_dedup.classes(doc_table(spark, [])).collect() == []


def test_exact_dedup_has_no_python_in_its_plan(spark):
    plan = queries.REGISTRY["op11_exact_dedup"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- vectors

VECTOR_COLUMNS = "vec_id long, embedding array<float>, label int, vector string, state string, place int, row long"


def vector_table(spark, rows):
    return cut(spark.createDataFrame([(i, v, label, "x", "y", 1, 2) for i, v, label in rows], VECTOR_COLUMNS), "vectors")


def drawn_vectors(n, width, seed, labels=4):
    """Clustered vectors with ties, copies, nulls and non-finite components."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (12, width))
    rows = []
    for i in range(n):
        vector = (centres[rng.integers(12)] + rng.normal(0, 0.05, width)).astype(np.float32).tolist()
        label = int(rng.integers(labels)) if i % 17 else None
        if i % 23 == 5:
            vector = [0.25] * width  # ties
        if i % 29 == 7 and rows and rows[-1][1]:
            vector = list(rows[-1][1])  # copies
        if i % 31 == 3:
            vector = None
        elif i % 37 == 4:
            vector[0] = [None, math.nan, math.inf, -math.inf][i % 4]
        rows.append((i, vector, label))
    rows += [(None, rows[0][1], 1), (2, rows[2][1], 2), (2, rows[2][1], 2), (50, rows[1][1], 0)]
    return rows


def finite(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def floored(vector, scale):
    return [math.floor(scale * float(np.float32(x))) for x in vector]


def by_id(value):
    return (value is None, value or 0)


# --- operator 12

def codes_by_hand(rows, parts, entries, rounds, scale):
    kept = sorted(((i, floored(v, scale), label) for i, v, label in rows if finite(v)), key=lambda r: (by_id(r[0]), r[1]))
    if not kept:
        return [], None
    width = len(kept[0][1]) // parts
    cut_up = np.array([v for _, v, _ in kept], dtype=np.int64).reshape(len(kept), parts, width)
    books = [cut_up[:entries, p].copy() for p in range(parts)]

    def nearest():
        squares = [((cut_up[:, p, None, :] - books[p]) ** 2).sum(axis=2) for p in range(parts)]
        return [s.argmin(axis=1) for s in squares], [s.min(axis=1) for s in squares]

    for _ in range(rounds):
        at, _ = nearest()
        for p in range(parts):
            for e in range(len(books[p])):
                members = cut_up[at[p] == e, p]
                if len(members):
                    books[p][e] = members.sum(axis=0) // len(members)
    at, squares = nearest()
    total = sum(squares)
    per_label = defaultdict(int)
    for (_, _, label), error in zip(kept, total):
        per_label[label] += int(error)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e.tolist()).encode()).hexdigest()
    out = [(i, "".join(f"{at[p][n]:02x}" for p in range(parts)), int(total[n]), per_label[label], digest)
           for n, (i, _, label) in enumerate(kept)]
    return sorted(out, key=repr), books


def codes_of(found):
    rows = found.codes().collect()
    per_label = defaultdict(int)
    for r in rows:
        per_label[r.label] += r.error
    return sorted(((r.vec_id, r.code, r.error, per_label[r.label], found.digest()) for r in rows), key=repr)


@pytest.mark.parametrize("n, width, entries, rounds", [(900, 16, 64, 4), (900, 8, 32, 6), (40, 8, 256, 4), (120, 4, 1, 3), (300, 16, 9, 0)])
def test_codes_equal_a_full_search(spark, n, width, entries, rounds):
    rows = drawn_vectors(n, width, seed=n + width)
    found = vector_codes.compress(vector_table(spark, rows).repartition(3), 4, entries, rounds)
    assert codes_of(found) == codes_by_hand(rows, 4, entries, rounds, 1024)[0]


def test_large_components_take_the_integer_path(spark):
    rows = [(i, [x * 60_000 if x is not None else None for x in v] if v else v, label)
            for i, v, label in drawn_vectors(200, 8, seed=3)]
    found = vector_codes.compress(vector_table(spark, rows), 4, 16, 3)
    assert not found.shape.as_floats
    assert codes_of(found) == codes_by_hand(rows, 4, 16, 3, 1024)[0]


def test_too_large_components_are_an_error(spark):
    with pytest.raises(ValueError, match="64 bits"):
        vector_codes.compress(vector_table(spark, [(1, [1e30] * 4, 1)]))


def test_vectors_that_cannot_be_cut_are_an_error(spark):
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.compress(vector_table(spark, [(1, [1.0] * 4, 1), (2, [1.0] * 8, 1)]))


def test_no_usable_vectors(spark, tmp_path):
    assert vector_codes.compress(vector_table(spark, [(1, None, 1), (2, [None] * 4, 1)])) is None
    vector_table(spark, []).write.parquet(f"{tmp_path}/embeddings.parquet")
    for name in ("op12_vector_codes", "op13_hard_negatives"):
        found = queries.REGISTRY[name](spark, str(tmp_path))
        assert found.collect() == [] and [f.simpleString() for f in found.schema] == [
            f.simpleString() for f in queries.REGISTRY[name](spark, SF).schema]


def test_vectors_of_no_components(spark):
    found = vector_codes.compress(vector_table(spark, [(1, [], 1), (2, [], None), (3, None, 1)]))
    assert [(r.vec_id, r.code, r.error) for r in sorted(found.codes().collect())] == [(1, "00000000", 0), (2, "00000000", 0)]


def test_bounds_save_distances_and_net_displacement_is_tighter():
    """Later rounds measure a part of all distances; moving entries to and fro leaves the net bound where it was."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-900, 900, (64, 16))
    x = centres[rng.integers(64, size=4000)] + rng.integers(-20, 21, (4000, 16))
    shape = vector_codes.Shape(1, 16, 1000)
    history = [x[:64].copy()]
    state = vector_codes.Bounds(np.stack(history), shape).first(x)
    taken = []
    for _ in range(4):
        moved = np.stack([x[state["entry"] == e].sum(axis=0) // max(1, (state["entry"] == e).sum()) for e in range(64)])
        history.append(moved)
        taken.append(vector_codes.Bounds(np.stack(history), shape).again(x, state))
        squares = vector_codes.distances(x, moved, shape)
        assert (state["entry"] == squares.argmin(axis=1)).all()
        own = np.sqrt(squares[np.arange(len(x)), state["entry"]])
        net = vector_codes.Bounds(np.stack(history), shape)
        assert (state["upper"] + net.net[state["upper_at"], state["entry"]] >= own).all()
    assert taken[-1] < 4000 * 64 // 4
    there_and_back = np.stack([history[0], history[0] + 50, history[0]])
    assert vector_codes.Bounds(there_and_back, shape).net[0].max() == 0


def test_codes_reach_the_sql_on_sf0001(spark):
    assert_equals_sql(spark, "op12_vector_codes")


# --- operator 13

def negatives_by_hand(rows, scale, every, k, m, low, high):
    kept = [(i, label, floored(v, scale)) for i, v, label in rows if label is not None and finite(v)]
    out = []
    for n, (anchor, label, x) in enumerate(kept):
        if anchor is None or anchor % every:
            continue
        others = [(sum(a * b for a, b in zip(x, y)), i, same) for j, (i, same, y) in enumerate(kept) if j != n]
        order = sorted(others, key=lambda o: (-o[0], by_id(o[1])))
        for score, positive, _ in [o for o in order if o[2] == label][:k]:
            window = [o for o in order if o[2] != label and low * score <= 100 * o[0] <= high * score]
            out += [(anchor, positive, rank, o[1], score, o[0]) for rank, o in enumerate(window[:m], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("width, tile, ranged, block", [(16, 2048, 1 << 14, 512), (7, 32, 100, 5), (33, 50, 64, 1)])
def test_negatives_equal_brute_force(spark, monkeypatch, width, tile, ranged, block):
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", tile)
    monkeypatch.setattr(hard_negatives, "RANGE_ROWS", ranged)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    rows = drawn_vectors(400, width, seed=width)
    found = hard_negatives.mine(vector_table(spark, rows).repartition(3), F.col("vec_id") % 10 == 0)
    assert plain(found) == negatives_by_hand(rows, 256, 10, 5, 3, 50, 95)


def test_negatives_among_ties_and_a_hot_label(spark, monkeypatch):
    """All vectors equal: the smallest ids win; a label with nearly all rows gives its anchors few negatives."""
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 16)
    monkeypatch.setattr(hard_negatives, "RANGE_ROWS", 40)
    rows = [(i, [1.0, 1.0] if i % 2 else [0.75, 1.0], 0 if i % 50 != 7 else 1) for i in range(300)]
    rows += [(None, [0.75, 0.75], 1), (100, [1.0, 1.0], 0)]
    found = hard_negatives.mine(vector_table(spark, rows), F.col("vec_id") % 50 == 0)
    assert plain(found) == negatives_by_hand(rows, 256, 50, 5, 3, 50, 95)


def test_no_anchors_and_no_rows(spark):
    rows = [(1, [1.0], 1), (2, [1.0], None), (3, None, 1)]
    assert hard_negatives.mine(vector_table(spark, rows), F.col("vec_id") % 50 == 0).collect() == []
    assert hard_negatives.mine(vector_table(spark, rows[1:]), F.col("vec_id") % 50 == 0).collect() == []


@pytest.mark.parametrize("shape", [(1, 1, 1), (2, 3, 4), (17, 33, 65), (40, 64, 100), (64, 64, 64), (0, 5, 3), (3, 0, 4)])
@pytest.mark.parametrize("most", [300, 1 << 27])
def test_strassen_equals_the_plain_product(shape, most):
    rng = np.random.default_rng(sum(shape))
    a, b = rng.integers(-most, most, shape[:2]), rng.integers(-most, most, shape[1:])
    for leaf in (1, 4, 16):
        assert (hard_negatives.strassen(a, b, leaf) == a @ b).all()


def test_negatives_reach_the_sql_on_sf0001(spark):
    assert_equals_sql(spark, "op13_hard_negatives")
    assert_equals_sql(spark, "op11_exact_dedup")


def assert_equals_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    found = queries.REGISTRY[name](spark, SF)
    columns = sorted(found.columns)
    wanted = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE[name]})").fetchall()
    assert plain(found.select(*columns)) == sorted(map(tuple, wanted), key=repr)
