"""The numbered operators against brute force, on edge cases and on sf0.001.

Edge cases are the same for all: nulls in any column, empty and long texts,
ties and repeated rows, an empty table, extra columns with clashing names.
"""

from __future__ import annotations

import base64
import hashlib
import io
import random
import tempfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from touchline.llm import bpe, bwt, mixing, multiset_hash, quality, queries, simhash, suffix_dedup, token_files, toxicity
from touchline.llm import common, url_lists, warc
from touchline.llm.common import components, cut

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LONG = " ".join(f"word{i % 997}" for i in range(6000))
PASSAGE = "It was a bright cold day and the clocks were striking; nobody on the stairs looked up at the passing stranger."
TEXTS = [
    (1, "One two three four five. " + PASSAGE + "\nA second line here.", "a"),
    (2, "Other words before. " + PASSAGE + " Other words after it.", "b"),
    (3, None, "a"), (4, "", None), (5, "   \n\t ", "b"), (None, "No id but a text, " + PASSAGE, "a"),
    (6, LONG, "c"), (7, LONG, "c"), (8, LONG + " end", "c"), (9, "x" * 500, "a"), (10, "ab" * 300, "b"),
    (11, "é日本😀ß " * 60, "a"), (1, "One two three four five. " + PASSAGE + "\nA second line here.", "a"),
    (12, "tiny", "d"), (13, "same line\nsame line\n\nsame line\nother", "d"), (-5, "negative id \x0b\x0c\r words # * $", None),
]
COLUMNS = "doc_id long, text string, source string, lang string, n_chars long, row long, anchor string, id int, target string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, s, None, len(t) if t is not None else None, 3, "x", 4, "y") for d, t, s in TEXTS]
    return cut(spark.createDataFrame(rows, COLUMNS), "docs")


@pytest.fixture(scope="module")
def empty(spark):
    return cut(spark.createDataFrame([], COLUMNS), "empty")


def words(text):
    return (text or "").encode().split()


# --- operator 1

def brute_quality(text):
    text = text or ""
    w = words(text)
    windows = defaultdict(list)
    for i in range(len(w) - 2):
        windows[tuple(w[i:i + 3])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_quality_measures(docs, empty):
    rows = quality.judged(docs).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert got == Counter((d, *brute_quality(t)) for d, t, _ in TEXTS)
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert quality.judged(empty).count() == 0


def test_bad_host_is_rejected_and_small_host_is_shrunk(spark):
    good = " ".join(f"w{i}" for i in range(80))
    rows = [(i, "bad words", "bad") for i in range(90)] + [(i, good, "bad") for i in range(90, 100)]
    for h in range(8):
        rows += [(1000 + h * 100 + i, good if i > 3 else "few", f"fine{h}") for i in range(100)]
    rows += [(5000, "few", "tiny")]
    verdicts = {r.host: r for r in quality.host_verdicts(quality.measured(
        spark.createDataFrame(rows, "doc_id long, text string, source string"))).collect()}
    assert verdicts["bad"].host_failed and not verdicts["fine0"].host_failed
    assert verdicts["tiny"].rate_short < 1.0  # one failing page of one: pulled towards the prior


def test_host_of_repeated_lines_is_rejected(spark):
    def page(i, copies):
        own = [" ".join(f"w{i}x{k}x{j}" for j in range(8)) for k in range(100 - copies)]
        return "\n".join(own + ["eight words that stand on many lines here"] * copies)

    rows = [(i, page(i, 46), "listy") for i in range(40)] + [(100 + i, page(i, 2), f"fine{i % 4}") for i in range(40)]
    got = quality.judged(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert not any(r.base_failed for r in got)
    assert all(r.n_lines == 100 and (r.n_dup_lines, r.kept) == ((45, False) if r.source == "listy" else (1, True)) for r in got)


def host_tables():
    """A host that one rule alone rejects, beside clean ones; all its pages pass the base rules of a page."""
    own = lambda i, n: " ".join(f"w{i}x{k}" for k in range(n))
    bad = {
        "symbols": lambda i: own(i, 60) + " " + " ".join("#" * 20 for _ in range(3)),
        "dup_lines": lambda i: "\n".join([own(f"{i}y{k}", 8) for k in range(60)] + ["eight words that stand on many lines here"] * 40),
        "short": lambda i: own(i, 5),
        "repeats": lambda i: " ".join([own(i, 10)] * 6),
    }
    for rule, page in bad.items():
        yield rule, ([(i, page(i), "bad") for i in range(40)] + [(40 + i, own(i, 80), "bad") for i in range(3)]
                     + [(100 + i, own(i, 70 + i % 9), f"fine{i % 4}") for i in range(400)] + [(900, None, "fine1"), (901, own(901, 60), None)])


@pytest.mark.parametrize("rule, rows", list(host_tables()))
def test_hosts_rejected_by_one_rule_alone_equal_the_sql(spark, rule, rows):
    import duckdb
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    judged = quality.judged(docs)
    rates = {r.source: r for r in judged.select("source", *[f"rate_{r}" for r in quality.RULES], "host_failed").distinct().collect()}
    assert rates["bad"].host_failed and not rates["fine0"].host_failed
    assert [r for r in quality.RULES if rates["bad"][f"rate_{r}"] > quality.MAX_RATE] == [rule]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "source"]))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_failed", "kept"]
    wanted = con.execute(f"SELECT {', '.join(names)} FROM ({quality.OP1_SQL})").fetchall()
    assert sorted(map(tuple, judged.select(*names).collect())) == sorted(wanted)
    assert {r.kept for r in judged.where("source = 'bad' AND NOT base_failed").collect()} == {False}


# --- operator 2

@pytest.fixture(scope="module")
def reference_encoding():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(reference_encoding):
    own = bpe.codec(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(3)
    pool = [chr(i) for i in range(0x250)] + list("\x1c\x85\xa0　​日本😀١½") + ["'s", "'ll", " the", "\n\n"]
    for _ in range(500):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 60)))
        ids = own.encode(text)
        assert ids == reference_encoding.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_perfect_hash_is_minimal_and_refuses_strangers():
    keys = {f"key{i}".encode(): i for i in range(500)}
    table = bpe.PerfectHash(keys)
    assert sorted(table.values) == list(range(500)) and None not in table.keys
    assert all(table.get(k) == v for k, v in keys.items())
    assert all(table.get(f"other{i}".encode()) is None for i in range(500))


def test_bpe_operator(docs, empty, reference_encoding):
    def digest(text):
        ids = reference_encoding.encode_ordinary(text or "")
        return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())

    got = Counter(tuple(r) for r in bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect())
    assert got == Counter((d, *digest(t)) for d, t, _ in TEXTS)
    again = bpe.decoded(bpe.encoded(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert Counter((r.doc_id, bytes(r.text)) for r in again.collect()) == Counter((d, (t or "").encode()) for d, t, _ in TEXTS)
    assert bpe.digests(empty, RANKS, public_tokenizers.PATTERN).count() == 0


# --- operator 3

def brute_targets(sizes):
    """Share 150 % by weight; stop at twice the size; reshare until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in stopped]
        level = (total - sum(stopped.values())) / (sum(weight[s] for s in free) or 1)
        over = [s for s in free if weight[s] * level > 2 * sizes[s]]
        if not over:
            return {s: stopped.get(s, weight[s] * level) for s in order}
        stopped.update({s: 2 * sizes[s] for s in over})


def test_mix_targets_and_takes(docs, empty):
    rows = mixing.mixed(docs).collect()
    sizes = Counter()
    for _, t, s in TEXTS:
        sizes[s] += len(words(t))
    want, taken = brute_targets(sizes), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        assert (r.position is None) == (r.taken == 0) and (r.position is None or 0 <= r.position <= 1)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert Counter(tuple(r) for r in mixing.mixed(docs).collect()) == Counter(tuple(r) for r in rows)
    assert mixing.mixed(empty).count() == 0 and mixing.mixed_rows(empty).count() == 0


def test_mixed_rows_are_whole_documents_in_training_order(docs):
    mix = {}
    for r in mixing.mixed(docs).collect():
        mix.setdefault(r.doc_id, []).append(r.copies)
    rows = mixing.mixed_rows(docs).collect()
    assert mixing.mixed_rows(docs).columns == docs.columns
    known = {(d, t) for d, t, _ in TEXTS}
    assert all((r.doc_id, r.text) in known for r in rows)
    assert Counter(r.doc_id for r in rows) == Counter({d: sum(c) for d, c in mix.items() if sum(c)})


def test_mixed_rows_of_equal_keys_come_back_each_as_itself(spark):
    seen, twins = {}, None
    for i in range(1_000_000):
        text = f"text number {i}"
        twins = seen.setdefault(hashlib.md5(text.encode()).hexdigest()[:8], text), text
        if twins[0] != text:
            break
    rows = [(None, twins[0], "a", 1), (None, twins[1], "a", 2), (5, "the same words", "a", 3), (5, "the same words", "b", 4),
            (5, "the same words", "b", 5)]
    docs = cut(spark.createDataFrame(rows, "doc_id long, text string, source string, n int"), "twins")
    numbered = docs.withColumn("own", F.col("n").cast("long"))
    want = {r.own: r.copies for r in mixing.mixed(numbered, carried=("own",)).collect()}
    got = mixing.mixed_rows(docs).collect()
    by_source = {s: sum(c for n, c in want.items() if rows[n - 1][2] == s) for s in "ab"}
    assert all(tuple(r) in rows for r in got) and Counter(r.source for r in got) == by_source
    assert {r.n for r in got} == {1, 2, 3, 4, 5} and max(Counter(r.n for r in got).values()) <= 2


def test_position_inverts_the_demand(spark):
    rows = spark.range(0, 101).select((F.col("id") / 100.0).alias("u")).collect()
    for tilt in mixing.TILTS:
        got = spark.createDataFrame(rows).select("u", mixing.position(F.col("u"), F.lit(tilt), F.lit(1.0)).alias("t")).collect()
        assert all(abs(tilt * r.t ** 2 + (1 - tilt) * r.t - r.u) < 1e-9 for r in got)


# --- operator 4

def test_multiset_hash_is_homomorphic_and_order_free(spark):
    row = spark.createDataFrame([("a b. c d\ne f\na b. c d", "a b. c d\na b. c d\ne f", "e f\na b. c d", "a b. c d", "e f\nA b. c d")], list("xypqr"))
    v = {c: multiset_hash.vector(F.col(c)) for c in "xypqr"}
    assert row.select(multiset_hash.as_text(v["x"]) == multiset_hash.as_text(v["y"])).first()[0]
    assert row.select(multiset_hash.plus(v["p"], v["q"]) == v["x"]).first()[0]
    assert row.select(multiset_hash.minus(v["x"], v["q"]) == v["p"]).first()[0]
    assert not row.select(multiset_hash.as_text(v["p"]) == multiset_hash.as_text(v["r"])).first()[0]
    assert row.select(multiset_hash.likeness(v["x"], v["y"])).first()[0] == 1.0


def test_vector_equals_brute_force(spark):
    texts = ["One line, with clauses; and more.\nSecond line | x\n\nSecond line | x", "no separators at all " * 20,
             "日本語の文章" * 60 + " and " + "x" * 200, "", LONG[:3000]]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], ["i", "t"])
    for i, got in rows.select("i", multiset_hash.vector(F.col("t"))).collect():
        assert got == brute_vector(texts[i])


def brute_paragraphs(text):
    def cut_after(part):
        return xxhash.xxh64_intdigest(part.encode(), 42) % multiset_hash.ONE_IN == 0

    def pieces(clause):
        if len(clause) <= multiset_hash.LONG_CLAUSE:
            return [clause]
        out = ""
        for w in clause.split(" "):
            if len(w) > multiset_hash.LONG_WORD:
                out += "".join(c + ("\n" if cut_after(c) else "") for c in w) + " "
            else:
                out += w + ("\n" if cut_after(w) else " ")
        return out.split("\n")

    lines = text.split("\n")
    clauses = [c for line in lines for c in __import__("re").split(r"(?<=[.!?;:,|])\s", line)]
    return ["\n" + x for x in lines if x] + [p for c in clauses for p in pieces(c) if p]


def brute_vector(text):
    lanes, wide = [0] * 64, [0, 0]
    parts = brute_paragraphs(text)
    for p in parts:
        hs = []
        for s in multiset_hash.SEEDS:
            seed = xxhash.xxh64_intdigest(s.to_bytes(4, "little"), 42)
            hs.append(xxhash.xxh64_intdigest(p.encode(), seed))
        for k, h in enumerate(hs):
            for b in range(32):
                lanes[32 * k + b] += (h >> b) & 0x0000000100000001
        for k in range(multiset_hash.WIDE):
            h = xxhash.xxh64_intdigest((1000 + k).to_bytes(4, "little"), 42)
            for own in hs:
                h = xxhash.xxh64_intdigest(own.to_bytes(8, "little"), h)
            wide[k] = (wide[k] + h) % 2 ** 64
    signed = lambda x: x - 2 ** 64 if x >= 2 ** 63 else x
    return [len(parts), *map(signed, lanes), *map(signed, wide)]


def brute_likeness(a, b):
    def lanes(v):
        ones = [x for w in v[1:65] for x in (w & 0xFFFFFFFF, (w >> 32) & 0xFFFFFFFF)]
        return [2 * x - v[0] for x in ones]
    p, q = lanes(a), lanes(b)
    both = sum(x * x for x in p + q)
    return max(0.0, 1 - sum((x - y) ** 2 for x, y in zip(p, q)) / both) if both else 1.0


def test_likeness_equals_brute_force_and_long_clauses_have_many_parts(spark):
    words = [f"w{i * 7919 % 1000}" for i in range(600)]
    plain = " ".join(words)
    edited = " ".join(words[:450] + [f"z{i}" for i in range(150)])
    han = "".join(chr(0x4E00 + i * 37 % 5000) for i in range(1200))
    pairs = [(plain, edited), (han, han[:900] + "".join(chr(0x6000 + i * 91 % 3000) for i in range(300))), ("a, b", "a, c"), ("", "")]
    rows = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in rows.select(multiset_hash.likeness(multiset_hash.vector(F.col("a")), multiset_hash.vector(F.col("b")))).collect()]
    assert got == pytest.approx([brute_likeness(brute_vector(a), brute_vector(b)) for a, b in pairs])
    assert got[0] > 0.5 and got[1] > 0.5  # three quarters are equal, without any punctuation


def test_rows_without_ids_take_the_start_of_the_first_document(spark):
    for rows in ([(None, "some text of a nameless row"), (None, "another such text"), (None, "b"), (4, "the first of all"), (9, "the last one here")],
                 [(None, "only nameless rows"), (None, "are in this table")], [(1, "one"), (2, "two")]):
        found = multiset_hash.compared(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        order = sorted({d for d, _ in rows}, key=lambda d: (d is None, d or 0))
        first = {d: min(t for x, t in rows if x == d) for d in order}
        after = {d: order[(i + 1) % len(order)] for i, d in enumerate(order)}
        want = Counter((d, hashlib.sha256((t[:len(t) - len(t) // 4] + first[after[d]][:len(t) // 4]).encode()).hexdigest()) for d, t in rows)
        assert Counter((r.doc_id, r.edited_sha256) for r in found) == want


def test_fingerprints_of_edited_texts(docs, empty):
    rows = multiset_hash.compared(docs).collect()
    order = sorted({d for d, _, _ in TEXTS}, key=lambda d: (d is None, d or 0))
    first = {d: min((t or "") for x, t, _ in TEXTS if x == d) for d in order}
    after = {d: order[(i + 1) % len(order)] for i, d in enumerate(order)}
    want = Counter()
    for d, t, _ in TEXTS:
        t = t or ""
        k = len(t) // 4
        want[d, len(t), hashlib.sha256((t[:len(t) - k] + first[after[d]][:k]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    by_text = defaultdict(set)
    texts = {d: t or "" for d, t, _ in TEXTS}
    for r in rows:
        by_text[texts[r.doc_id]].add(r.fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    assert multiset_hash.compared(empty).count() == 0


# --- operator 5

def brute_fingerprint(text, n=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_components(prints, bits):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j, (_, b) in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= bits:
                root[find(i)] = find(j)
    out = defaultdict(list)
    for i, (d, _) in enumerate(prints):
        out[find(i)].append(d)
    return [(d, min((x for x in out[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(prints)]


def test_simhash_groups(docs, empty):
    prints = [(d, brute_fingerprint(t)) for d, t, _ in TEXTS]
    got = Counter((r.doc_id, r.simhash % (1 << 64), r.component_id) for r in simhash.simhash_groups(docs).collect())
    assert got == Counter((d, f, c) for (d, f), (_, c) in zip(prints, brute_components(prints, 2)))
    assert simhash.simhash_groups(empty).count() == 0
    assert simhash.keep_one_per_group(empty).count() == 0


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_ball_links_find_all_components(spark, bits):
    rng = random.Random(bits)
    values = [rng.getrandbits(64) for _ in range(12)]
    for _ in range(60):
        v = rng.choice(values)
        for _ in range(rng.randint(1, 3)):
            v ^= 1 << rng.randrange(64)
        values.append(v)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in set(values)]
    edges = simhash.links(spark.createDataFrame(signed, "simhash long"), bits)
    assert all((r.a ^ r.b).bit_count() <= bits if r.a ^ r.b >= 0 else ((r.a ^ r.b) % (1 << 64)).bit_count() <= bits for r in edges.collect())
    roots = {r.node: r.root for r in components(edges).collect()}
    groups = defaultdict(set)
    for (v,) in signed:
        groups[roots.get(v, v)].add(v)
    want = defaultdict(set)
    listed = [(v, v % (1 << 64)) for (v,) in signed]
    for (v, _), (_, c) in zip(listed, brute_components(listed, bits)):
        want[c].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001)], "a long, b long")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert set(roots.values()) == {0, 1000} and roots[200] == 0


# --- operator 6

def brute_dedup(rows, width=100):
    seen, out = set(), []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            w = b[i:i + width]
            if w in seen:
                gone[i:i + width] = b"\1" * width
            seen.add(w)
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def test_column_wise_transform_groups_equal_windows():
    rng = random.Random(5)
    for _ in range(60):
        width = rng.choice([1, 2, 3, 5])
        strings = [bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 9))]
        with tempfile.TemporaryDirectory() as folder:
            found = list(zip(*bwt.windows(strings, width, folder)))
        groups = defaultdict(set)
        for s, o, g in found:
            groups[strings[s][o:o + width]].add(g)
        assert len(found) == sum(max(0, len(s) - width + 1) for s in strings)
        assert all(len(g) == 1 for g in groups.values()) and len(set.union(set(), *groups.values())) == len(groups)


def test_segments_of_joined_texts_are_those_of_each_text():
    """Neighbours in one array change nothing; all windows of a text are covered once, and
    segments not marked ``twice`` have no two equal windows."""
    rng = random.Random(3)
    texts = [(t or "").encode() for _, t, _ in TEXTS] + [b"x" * n for n in (0, 99, 100, 101)] + [b"abc def " * 70]
    texts += [bytes(rng.choice(b"abcdefgh ") for _ in range(rng.randint(0, 400))) for _ in range(40)]
    begins = np.cumsum([0, *map(len, texts)])
    text, anchor, starts, counts, twice = suffix_dedup.segments(texts, b"".join(texts))
    for i, own in enumerate(texts):
        mine = text == i
        alone = suffix_dedup.segments([own], own)
        assert all(np.array_equal(a, b) for a, b in zip((anchor[mine], starts[mine] - begins[i], counts[mine], twice[mine]), alone[1:]))
        covered = [w for s, n in zip(alone[2], alone[3]) for w in range(s, s + n)]
        assert covered == list(range(max(0, len(own) - suffix_dedup.WIDTH + 1)))
        for s, n, again in zip(*alone[2:]):
            assert again or len({own[w:w + suffix_dedup.WIDTH] for w in range(s, s + n)}) == n
    assert list(suffix_dedup._groups([2, 0, 1], np.array([suffix_dedup.GROUP_BYTES, 7, 5]))) == [[2], [0], [1]]


@pytest.mark.parametrize("most_members, batch", [(2000, 10000), (1, 7)])
def test_substring_dedup(spark, docs, empty, most_members, batch):
    rng = random.Random(9)
    edges = ["".join(rng.choice("klmnop ") for _ in range(rng.randint(5, 60))) for _ in range(24)]
    rows = [(100 + i, edges[i] + PASSAGE + edges[-i - 1], None) for i in range(12)]
    rows += [(d, t, None) for d, t, _ in TEXTS]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        for table in (spark.createDataFrame(rows, "doc_id long, text string, anchor string").coalesce(1),):
            table = cut(table, "dedup-in")
            order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
            kept = suffix_dedup.deduped(table, most_members)
            got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in kept.collect()]
            assert Counter(got) == Counter(brute_dedup([(d, t) for d, t, _ in order]))
        assert suffix_dedup.deduped(empty).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_hot_anchors_are_dealt_by_window_from_the_start(spark):
    """Every anchor counts as hot, or those of a passage that many documents quote: the spans cover the same bytes."""
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(40)) + PASSAGE + " ".join(f"v{rng.randrange(400)}" for _ in range(40)))
            for i in range(60)]
    docs = suffix_dedup.as_bytes(common.numbered(cut(spark.createDataFrame(rows, "doc_id long, text string"), "hot")))

    def covered(hot):
        out = defaultdict(set)
        for r in suffix_dedup.repeated_spans(docs, hot=hot).collect():
            out[r.row].update(range(r.start, r.start + r.windows))
        return out

    wanted = covered((10 ** 9, 1))
    assert wanted and covered((1, 1)) == wanted and covered((30, 1)) == wanted
    found = cut(suffix_dedup.all_segments(docs), "found")
    assert suffix_dedup.hot_anchors(found, 30, 1).count() > 0 and suffix_dedup.hot_anchors(found, 10 ** 6, 1).count() == 0


def test_substring_dedup_of_sf(spark):
    rows = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")
    got = Counter(tuple(r) for r in queries.REGISTRY["op6_suffix_dedup"](spark, SF).collect())
    assert got == Counter(brute_dedup(list(zip(rows.doc_id, rows.text))))


# --- operator 7

def test_token_coder_round_trips_and_finds_damage():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 2047, 2048, 2049, 9000):
        ids = rng.integers(0, 65536 if n % 2 else 3, n)
        assert (token_files.unpacked(token_files.packed(ids)) == ids).all()
    data = bytearray(token_files.packed(np.arange(5000) % 700))
    data[40] ^= 1
    with pytest.raises(ValueError):
        token_files.unpacked(bytes(data))


def test_ids_without_a_context_are_coded_by_how_often_they_are_seen():
    rng = np.random.default_rng(2)
    ids = rng.choice(rng.integers(0, 65536, 64), 30_000)  # 6 bits an id, and none tells of the next
    data = token_files.packed(ids)
    assert (token_files.unpacked(data) == ids).all()
    assert len(data) * 8 < len(ids) * 8


def test_coder_settles_carries_that_run_on():
    """Symbols at the very top of the range leave words of ones; a carry then runs through all of them."""
    coder, of = token_files.Encoder(2), np.arange(2)
    narrow = lambda c, each, below: c.narrow(of, each, below, np.ones(2, np.int64))
    marks = [np.array([65535, 0])] * 5 + [np.array([65535, 65535])] * 3
    for below in marks:
        narrow(coder, coder.range[of] >> 16, below)
    coder.low[0] += coder.range[0] - 1  # the end of the range: the greatest value that decodes alike
    over = coder.low[0] >= token_files.FULL
    if over:
        coder.out[0, coder.at[0] - 1] += 1
        coder.low[0] -= token_files.FULL
    coder.finish()
    assert coder.out.max() <= 65535
    decoder = token_files.Decoder(coder.out)
    for below in marks:
        each = decoder.range[of] >> 16
        assert ((decoder.value[of] // each) == below).all()
        narrow(decoder, each, below)


def test_ids_of_every_kind_round_trip_in_one_call():
    rng = np.random.default_rng(9)
    block = token_files.BLOCK
    parts = [np.zeros(block), np.full(block, 65535), rng.integers(0, 65536, block), np.arange(block) % 3, rng.integers(65000, 65536, block),
             np.repeat(rng.integers(0, 50000, 32), block // 32), rng.zipf(1.3, block) % 50000, np.arange(17)]
    ids = np.concatenate(parts).astype(np.int64)
    assert (token_files.unpacked(token_files.packed(ids)) == ids).all()
    data = token_files.packed(ids)
    for at in range(20, len(data), len(data) // 40):
        broken = bytearray(data)
        broken[at] ^= 0x55
        try:
            found = token_files.unpacked(bytes(broken))
        except (ValueError, __import__("struct").error):
            continue
        assert (found == ids).all()  # the last words of a block may hold bits that say nothing


def test_lanes_of_a_block_share_its_model():
    rng = np.random.default_rng(4)
    ids = rng.choice(rng.integers(0, 65536, 4096), 300_000)  # 12 bits an id; a fresh model every 2,048 ids never learns them
    data = token_files.packed(ids)
    assert (token_files.unpacked(data) == ids).all()
    assert len(data) * 8 < len(ids) * 13.5


def test_a_damaged_block_harms_no_other(monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 3000)
    ids = np.random.default_rng(5).zipf(1.4, 10_000) % 50_000
    first, rest = token_files.packed(ids[:3000]), token_files.packed(ids[3000:])
    assert token_files.packed(ids) == first + rest
    for at in (4, 8, 12, 60, len(first) - 40):
        broken = bytearray(first)
        broken[at] ^= 0x41
        with pytest.raises(ValueError):
            token_files.unpacked(bytes(broken) + rest)
    assert (token_files.unpacked(rest) == ids[3000:]).all()


def library_ids(texts):
    own = token_files.tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    return [[*got.ids, 0] for got in own.encode_batch(texts, add_special_tokens=False)]


def test_words_are_encoded_as_in_their_texts():
    rng = np.random.default_rng(6)
    plain = ["a", "foo", "'s", "don't", "I'll", "'", " ", " ", " ", "  ", "\n", "\n\n", " \n", ".", ",", "12", "é", "ción", "中文", "😀",
             "<|endoftext|>", "Ġ", "Ċ"]
    odd = ["\t", "\r\n", "\u00a0", "\u2003", "\x0b", "\x1c", "\x85", "\u200b"]
    for parts in (plain, plain + odd):
        own = token_files.Words(public_tokenizers.path("byte_bpe_50k.json"))
        own.MOST = 500  # words are forgotten now and then
        for _ in range(20):
            texts = ["".join(rng.choice(parts, rng.integers(0, 14))) for _ in range(300)]
            ids, counts = own.encode(pa.array(texts))
            want = library_ids(texts)
            assert counts.tolist() == list(map(len, want))
            assert ids.tolist() == [i for one in want for i in one]


def test_the_library_is_asked_once_for_a_word_that_returns(monkeypatch):
    own = token_files.Words(public_tokenizers.path("byte_bpe_50k.json"))
    asked = []
    monkeypatch.setattr(own, "asked", lambda texts, ask=own.asked: asked.extend(texts) or ask(texts))
    texts = ["one two three\none two", "two three one one  two", "two\n\nthree", ""] * 50
    for _ in range(2):
        assert own.encode(pa.array(texts))[0].tolist() == [i for one in library_ids(texts) for i in one]
    assert sum(map(len, asked)) < 60
    own.encode(pa.array(["one   two"]))
    assert asked[-1] == "one   two"  # three blanks: the text goes whole
    own.LETTERS = 10
    own.encode(pa.array(["x"]))
    assert len(own.places) == 1


def test_words_met_last_are_not_asked_for_again(monkeypatch):
    own = token_files.Words(public_tokenizers.path("byte_bpe_50k.json"))
    own.MOST = 100
    asked = []
    monkeypatch.setattr(own, "asked", lambda texts, ask=own.asked: asked.extend(texts) or ask(texts))
    for k in range(20):
        texts = ["it is often seen", " ".join(f"w{k}x{i}" for i in range(30))]
        assert own.encode(pa.array(texts))[0].tolist() == [i for one in library_ids(texts) for i in one]
        assert len(own.places) <= 135  # of 622 words
    assert "".join(asked).count("often") == 1


def test_words_of_one_hash_and_long_words_keep_their_ids():
    rng = np.random.default_rng(8)
    own = token_files.Words(public_tokenizers.path("byte_bpe_50k.json"))
    own.POWERS = np.ones_like(own.POWERS)  # words of the same letters have one hash
    for _ in range(5):
        texts = [" ".join("".join(rng.permutation(list("abcd"))) for _ in range(20)) for _ in range(30)] + ["y" * 300 + " a " + "é" * 200, "y" * 256, ""]
        ids, counts = own.encode(pa.array(texts))
        want = library_ids(texts)
        assert counts.tolist() == list(map(len, want))
        assert ids.tolist() == [i for one in want for i in one]


def brute_tokens(rows):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    start, out = 0, []
    for d, t in rows:
        ids = [*own.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files(spark, docs, empty, tmp_dir):
    order = sorted(((d, t or "") for d, t, _ in TEXTS), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = token_files.read_back(token_files.written(docs, path, f"file://{tmp_dir}/a")).collect()
    assert Counter(tuple(r) for r in got) == Counter(brute_tokens(order))
    assert token_files.read_back(token_files.written(empty, path, f"file://{tmp_dir}/b")).count() == 0
    rows = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")
    got = queries.REGISTRY["op7_token_files"](spark, SF).collect()
    assert sorted(map(tuple, got)) == brute_tokens(zip(rows.doc_id, rows.text))


# --- operator 8

def test_url_lists_as_of(spark):
    day = lambda s: pd.Timestamp(s).date()
    log = [("spam", "bad.org", "add", day("2021-01-10")), ("spam", "bad.org", "remove", day("2021-03-01")),
           ("spam", "bad.org", "add", day("2022-01-01")), ("adult", "x.net/a", "add", day("2021-02-01")),
           ("spam", "bad.org", "add", day("2021-01-10")), (None, "bad.org", "add", day("2020-01-01")),
           ("spam", None, "add", day("2020-01-01")), ("spam", "tie.org", "add", day("2021-01-01")),
           ("spam", "tie.org", "remove", day("2021-01-01"))]
    pages = [(1, "http://www.bad.org/p", "2021-01-09", ""), (2, "http://bad.org", "2021-01-10", "spam"),
             (3, "https://sub.bad.org:80/q", "2021-02-28", "spam"), (4, "http://bad.org", "2021-03-01", ""),
             (5, "http://bad.org/z?x", "2023-01-01", "spam"), (6, "http://x.net/a/b", "2021-02-01", "adult"),
             (7, "http://x.net/ab", "2021-02-02", ""), (8, None, "2021-02-02", ""), (9, "not a url", "2021-02-02", ""),
             (10, "http://bad.org", None, ""), (None, "http://bad.org", "2022-05-05", "spam"), (11, "http://tie.org", "2021-01-02", ""),
             (2, "http://bad.org", "2021-01-10", "spam"), (12, "http://notbad.org", "2021-01-10", "")]
    captures = spark.createDataFrame([(i, u, day(f) if f else None, "x") for i, u, f, _ in pages], "page_id long, url string, fetched date, row string")
    lists = spark.createDataFrame(log, "label string, pattern string, action string, at date")
    got = Counter((r.page_id, r.labels, r.rejected) for r in url_lists.judged(captures, lists).collect())
    assert got == Counter((i, want, bool(want)) for i, _, _, want in pages)
    assert url_lists.judged(captures, lists.limit(0)).where("rejected").count() == 0
    assert url_lists.judged(captures.limit(0), lists).count() == 0


def test_url_entries_of_any_depth_and_any_domain(spark):
    day = lambda s: pd.Timestamp(s).date()
    deep = "example.org/a/b/c/d/e/f"
    lists = spark.createDataFrame([("deep", deep, "add", day("2021-01-01")), ("all", "com", "add", day("2021-01-01")),
                                   ("all", "com", "remove", day("2021-06-01"))], "label string, pattern string, action string, at date")
    pages = [(1, f"http://{deep}", "2021-05-01", "deep"), (2, f"http://{deep}/g?h", "2021-05-01", "deep"),
             (3, "http://example.org/a/b/c/d/e", "2021-05-01", ""), (4, "http://x.com", "2021-05-01", "all"),
             (5, "http://a.b.c.com/q", "2021-05-31", "all"), (6, "http://x.com", "2021-06-01", ""), (7, "http://com", "2021-02-01", "all"),
             (8, f"http://{deep}", "9999-12-30", "deep"), (9, "http://xcom", "2021-02-01", ""), (10, f"http://{deep}", "0001-01-01", "")]
    captures = spark.createDataFrame([(i, u, day(f) if not f.startswith(("0", "9")) else __import__("datetime").date.fromisoformat(f))
                                      for i, u, f, _ in pages], "page_id long, url string, fetched date")
    got = {r.page_id: (r.labels, r.rejected) for r in url_lists.judged(captures, lists).collect()}
    assert got == {i: (want, bool(want)) for i, _, _, want in pages}


# --- operator 9

def test_revisits_name_the_record_id_of_their_response(spark, tmp_path):
    rows = [(1, "http://a", "same"), (2, "http://b", "same"), (3, "http://c", "other"), (5, None, "same"), (None, "http://d", "same"), (7, "http://e", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)

    def records(name):
        manifest = warc.written(warc.with_references(pages), f"file://{tmp_path}/{name}")
        found = {}
        for row in manifest.collect():
            with open(row.path.removeprefix("file://"), "rb") as file:
                for _, got in warc.records_in(file, 0, row.length):
                    found[got["fields"]["warc-record-id"]] = got
        return found

    found = records("one")
    assert len(found) == len(rows)
    revisits = [r for r in found.values() if r["fields"]["warc-type"] == "revisit"]
    assert len(revisits) == 3
    for r in revisits:
        response = found[r["fields"]["warc-refers-to"]]
        assert response["fields"]["warc-type"] == "response" and response["block"] == b"same" and response["fields"]["warc-page-id"] == "1"
        assert response["fields"]["warc-payload-digest"] == r["fields"]["warc-payload-digest"]
    assert records("two") == found  # a rerun writes the same records


def test_warc_ranges_own_each_record_once():
    rng = random.Random(4)
    payloads = [bytes(rng.randrange(256) for _ in range(rng.randint(0, 3000))) + (b"\x1f\x8b\x08\0" * (i % 3)) for i in range(40)]
    data = b"".join(warc.record(i, f"http://h/{i}", p, warc.digest(p), None) for i, p in enumerate(payloads))
    for size in (1, 97, 1000, len(data)):
        if size == 1:
            ranges = [(0, 1), (1, len(data))]
        else:
            ranges = [(a, min(a + size, len(data))) for a in range(0, len(data), size)]
        got = [r for a, b in ranges for _, r in warc.records_in(io.BytesIO(data), a, b)]
        assert [r["block"] for r in got] == payloads


def test_warc_pages(spark, tmp_dir):
    html = [(1, "u", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u", None), (4, "u\r\nEvil: 1", ""), (None, "u", "<p>x</p>"),
            (5, "u", "é日" * 50000), (6, "u", "only"), (1, "u", "<p>x</p>"), (0, "u", "<p>y</p>\r\n\r\nWARC/1.1")]
    pages = spark.createDataFrame([(*r, "z", 1) for r in html], "page_id long, url string, html string, payload string, first int")
    folder = f"file://{tmp_dir}/warc"
    manifest = warc.written(warc.with_references(pages), folder)
    got = Counter(tuple(r) for r in warc.resolved(warc.read_archives(manifest, 1000)).collect())
    first = {}
    for i, _, h in html:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = Counter()
    for i, _, h in html:
        p = (h or "").encode()
        revisit = (h or "") in first and i != first[h or ""]
        want[i, len(p), warc.digest(p), "revisit" if revisit else "response", first[h or ""] if revisit else None] += 1
    assert got == want
    none = warc.written(warc.with_references(pages.limit(0)), f"file://{tmp_dir}/none")
    assert warc.read_archives(none).count() == 0


# --- operator 10

def test_folding():
    assert toxicity.fold("ST0PID st00pid $tupid 2024 иdіоt") == ["stopid", "stoopid", "stupid", "2024", "иdiot"]


def test_exception_phrases_do_not_count():
    lexicon = toxicity.Lexicon({" trash ": 5.0, " lowe": 4.0}, ["trash can"], base=-3.0, slope=3.0)
    machine = lexicon.automaton()
    assert toxicity.weigh("take the trash can out", machine) == 0
    assert toxicity.weigh("you trash", machine) > 0 and toxicity.weigh("loweihr", machine) > 0
    assert toxicity.weigh("TR4SH " + "word " * 500, machine) < toxicity.weigh("TR4SH word", machine)
    assert lexicon.score(0.0) < 0.5 <= lexicon.score(toxicity.weigh("you trash", machine))


def test_toxicity_is_learned(spark, docs, empty):
    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    rows, labels = [], []
    for i in range(1200):
        toxic = int(i % 6 == 0)
        text = [rng.choice(vocabulary) for _ in range(rng.randint(5, 200))]
        for _ in range(rng.randint(1, 3) * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(["Moron!", "sc0m", "grubling", "grubster"]))
        rows.append((i, " ".join(text)))
        labels.append((i, toxic))
    labels += [(None, 1), (5, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = toxicity.learn(table, known, ~toxicity.held_out())
    got = {r.doc_id: r for r in toxicity.scored(table, lexicon).collect()}
    held = [i for i in range(1200) if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum(got[i].predicted == labels[i][1] for i in held)
    assert right >= 0.97 * len(held)
    edge = toxicity.scored(docs, lexicon).collect()
    assert len(edge) == len(TEXTS) and all(0 <= r.score <= 1 for r in edge)
    assert toxicity.without_toxic(docs, lexicon).columns == docs.columns
    assert toxicity.scored(empty, lexicon).count() == 0
    blank = toxicity.learn(empty, known.limit(0), ~toxicity.held_out())
    assert not blank.weights and {r.predicted for r in toxicity.scored(docs, blank).collect()} == {0}


def test_folding_of_compatibility_forms_and_marks():
    assert toxicity.fold("Ｓｔｕｐｉｄ 𝓼𝓽𝓾𝓹𝓲𝓭 stüpïd s̶t̶u̶p̶i̶d̶ ﬁne") == ["stupid", "stupid", "stupid", "stupid", "fine"]
    assert toxicity.fold("日本 한국 привет") == toxicity.fold("日本 한국 привет".upper())


def brute_weight(text, lexicon):
    """Every entry tried at every place."""
    words = toxicity.fold(text or "")
    joined = f" {' '.join(words)} "
    best = {}
    for at in range(len(joined)):
        for entry, weight in lexicon.weights.items():
            if joined.startswith(entry, at):
                best[at] = max(weight, best.get(at, 0.0))
    for phrase in lexicon.exceptions:
        for at in range(len(joined)):
            if joined.startswith(f" {phrase} ", at):
                best = {k: w for k, w in best.items() if not at <= k < at + len(phrase) + 1}
    total = sum(best[k] for k in sorted(best))
    return (total / (1.0 + np.log1p(len(words) / 100.0))) ** 0.5 if words or text else 0.0


def test_scores_equal_a_naive_scorer(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lexicon = toxicity.Lexicon({" idiot ": 3.0, " idi": 1.5, " the ": 0.25, " and ": 0.5, " s": 0.1, " stup": 2.0},
                               ["of the", "the clocks", "and then", "idiot box"], base=-2.0, slope=1.5)
    rng = random.Random(3)
    vocabulary = ["idiot", "1d10t", "idiom", "box", "the", "clocks", "and", "then", "of", "stupid", "STÜPID", "plain", "ѕtupid", "x"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(60))) for _ in range(300)] + [None, "", "the", "idiot box idiot box idiot"]
    texts += [r.text for r in docs.select("text").limit(60).collect()]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.scored(rows, lexicon).collect()}
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx(lexicon.score(brute_weight(text, lexicon)), abs=1e-12)


def test_lexicon_has_no_cap(spark):
    """2,500 words stand in four toxic texts each and in no clean one, ten of them always together:
    each of the 250 sets gives an entry, so every toxic text is found."""
    code = lambda k: "".join("bcdfghjklmnpqrstvwxz"[(k // 20 ** p) % 20] for p in (2, 1, 0))
    rng = random.Random(1)
    neutral = [str(k) for k in range(1000)]
    mixed = lambda words: " ".join(rng.sample(words, len(words)))  # noqa: E731 - near copies would count once
    rows = [(n, mixed([code(n // 4 * 10 + j) for j in range(10)] + rng.choices(neutral, k=25)), 1) for n in range(1000)]
    rows += [(n, " ".join(rng.choices(neutral, k=15)), 0) for n in range(1000, 7000)]
    docs = cut(spark.createDataFrame(rows, "doc_id long, text string, toxic int"), "uncapped")
    lexicon = toxicity.learn(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), F.lit(True))
    assert len(lexicon.weights) == 250
    wrong = toxicity.scored(docs, lexicon).join(docs.select("doc_id", "toxic"), "doc_id").where("predicted <> toxic")
    assert wrong.count() == 0
