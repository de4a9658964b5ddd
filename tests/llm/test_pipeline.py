"""The corpus pipeline against its stages done by hand, and its edge cases."""

from __future__ import annotations

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from touchline.llm import common, mixing, queries, simhash, suffix_dedup, toxicity
from touchline.llm.common import cut, table
from test_operators import PASSAGE, SF, TEXTS, brute_components, brute_dedup, brute_fingerprint


def test_stages_are_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "substring_dedup", "mix", "encode"]
    assert "pipeline" in entry.queries() and all(n in entry.queries() for n in queries.REGISTRY)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.REGISTRY) == list(range(1, 14))


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), {"in": table(spark, SF, "documents")}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = cut(stage(spark, docs, SF), f"test-{name}")
    return out


def test_each_stage_on_its_own_input(spark, stages):
    columns = stages["in"].columns
    for name in ("toxicity", "near_dedup", "substring_dedup", "mix"):
        assert stages[name].columns == columns and stages[name].dtypes == stages["in"].dtypes
    toxic = {r.doc_id for r in toxicity.scored(stages["in"], toxicity.fitted(spark, SF)).where("predicted = 1").collect()}
    before = {r.doc_id: r.text for r in stages["in"].collect()}
    clean = {r.doc_id: r.text for r in stages["toxicity"].collect()}
    assert clean == {d: t for d, t in before.items() if d not in toxic}
    prints = [(d, brute_fingerprint(t)) for d, t in clean.items()]
    kept = {r.doc_id for r in stages["near_dedup"].collect()}
    assert kept == {c for _, c in brute_components(prints, 2)}
    cutout = {r.doc_id: r for r in stages["substring_dedup"].collect()}
    assert set(cutout) == kept
    want = brute_dedup(sorted((d, clean[d]) for d in kept))
    for d, n_bytes, n_removed, _, _ in want:
        text = cutout[d].text
        assert cutout[d].n_chars == len(text)
        assert n_bytes - n_removed - 8 <= len(text.encode()) <= n_bytes - n_removed
    mixed = Counter((r.doc_id, r.text) for r in stages["mix"].collect())
    assert all(n <= 2 and cutout[d].text == t for (d, t), n in mixed.items())
    encoded = Counter((r.doc_id, r.decoded_sha256) for r in stages["encode"].collect())
    digests = Counter((r.doc_id, r.d) for r in stages["mix"].select("doc_id", F.sha2(F.encode("text", "UTF-8"), 256).alias("d")).collect())
    assert encoded == digests


def test_run_equals_the_stages(spark, stages):
    assert Counter(r.ids_sha256 for r in corpus_pipeline.run(spark, SF).collect()) == Counter(
        r.ids_sha256 for r in stages["encode"].collect())


def test_edge_cases(spark, tmp_dir):
    rows = [(d, t, "en", s, len(t or "")) for d, t, s in TEXTS] + [(90, "x" + PASSAGE, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, data in (("some", rows), ("none", [])):
        folder = os.path.join(tmp_dir, name)
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        got = corpus_pipeline.run(spark, folder).collect()
        assert bool(got) == bool(data)


def test_near_dedup_judges_rows_of_one_id_each_by_its_text(spark):
    rows = [(3, "one text that is there twice", 0), (7, "one text that is there twice", 1), (7, "words of its own in here", 2),
            (7, "some quite different line again", 3), (7, "some quite different line again", 4)]
    for order in (rows, rows[::-1]):
        docs = cut(spark.createDataFrame(order, "doc_id long, text string, n int"), "shared-ids")
        kept = simhash.keep_one_per_group(docs)
        assert kept.columns == docs.columns
        assert sorted((r.doc_id, r.text) for r in kept.collect()) == [rows[0][:2], rows[3][:2], rows[2][:2]]


def test_near_dedup_judges_rows_without_an_id(spark):
    """A row without an id goes where a copy has one; of copies without ids one stays."""
    docs = cut(spark.createDataFrame([(None, "a b c d", "x"), (1, "a b c d", "x"), (2, "a b c d", "y"), (3, "other words here now", "y"),
                                      (None, "nobody named these words", "p"), (None, "nobody named these words", "q")],
                                     "doc_id long, text string, simhash string"), "ids")
    kept = simhash.keep_one_per_group(docs)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == [
        (1, "a b c d"), (3, "other words here now"), (None, "nobody named these words")]


HELPERS = ("row", "whole", "of_row", "near_row", "mix_row", "mix_key", "mix_hash", "dedup_row", "dedup_spans", "spans", "key", "size",
           "position", "taken", "before", "simhash", "hash", "root", "part", "place", "anchor", "_metadata", "kept_row", "target", "tilt")


def stage_results(spark, docs):
    ordered = lambda frame: sorted(map(repr, (tuple(r) for r in frame.collect())))
    return {"near_dedup": ordered(simhash.keep_one_per_group(docs)), "substring_dedup": ordered(suffix_dedup.with_kept_text(docs)),
            "mix": ordered(mixing.mixed_rows(docs)), "op6": ordered(suffix_dedup.deduped(docs).drop("row"))}


def test_stages_keep_columns_of_any_name(spark):
    rows = [(d, t, s, *[f"{h} of {n}" for h in HELPERS]) for n, (d, t, s) in enumerate(TEXTS)]
    docs = cut(spark.createDataFrame(rows, ["doc_id", "text", "source", *HELPERS]), "clashing")
    wanted = {r[:2] + r[3:]: r[2] for r in rows}
    for stage in (simhash.keep_one_per_group, suffix_dedup.with_kept_text, mixing.mixed_rows):
        kept = stage(docs)
        assert kept.columns == docs.columns
        found = [tuple(r) for r in kept.collect()]
        assert found and all(r[3:] in {w[2:] for w in wanted} for r in found)


def test_rows_keep_their_numbers_when_executors_come_and_go(spark, monkeypatch, tmp_path):
    """Scans are split by the cores at hand when a job is planned; no result may depend on that."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(150).unionByName(
        spark.createDataFrame([(d, t, "en", s, 1) for d, t, s in TEXTS], "doc_id long, text string, lang string, source string, n_chars long"))
    docs.repartition(16).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    wanted = stage_results(spark, docs)
    key, jobs = "spark.sql.leafNodeDefaultParallelism", []

    def shaken(frame, name, plain=common.cut):
        jobs.append(name)
        spark.conf.set(key, str((2, 16, 1, 7)[len(jobs) % 4]))
        return plain(frame, name)

    try:
        for module in (common, simhash, suffix_dedup, mixing):
            monkeypatch.setattr(module, "cut", shaken)
        assert stage_results(spark, docs) == wanted
    finally:
        spark.conf.unset(key)
    assert len(jobs) > 10


def test_numbers_name_file_and_place(spark, tmp_path):
    frame = spark.range(5000).withColumn("_metadata", F.lit("mine")).repartition(9)
    frame.write.parquet(f"{tmp_path}/n")
    rows = common.numbered(spark.read.parquet(f"{tmp_path}/n"))
    assert rows.select("row").distinct().count() == 5000 and rows.where("row < 0").count() == 0
    assert rows.select("whole.*").columns == ["id", "_metadata"]
    # the codes that are told apart on the driver are those the tasks compute
    paths = spark.read.parquet(f"{tmp_path}/n").inputFiles()
    bits = max(31, 2 * len(paths).bit_length() + 2)
    assert {r.row >> (63 - bits) for r in rows.collect()} == {common._file_code("0", p, bits) for p in paths}
    derived = common.numbered(spark.read.parquet(f"{tmp_path}/n").select(F.explode(F.array("id", "id")).alias("id")))
    assert derived.select("row").distinct().count() == 10000
    assert common.numbered(spark.read.schema("doc_id long").parquet(f"{tmp_path}/n").where("false")).collect() == []
