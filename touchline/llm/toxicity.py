"""Toxicity by a weighted lexicon (operator 10).

Texts are folded first: compatibility forms (full-width, mathematical, ligatures)
become plain letters, marks and accents go, then lower case; look-alike letters
of other scripts and digits or signs standing for letters inside a word become
the plain letter. An
Aho-Corasick automaton then finds the lexicon's entries (whole words, or word
beginnings) in one pass over the folded text. A word counts with the highest
weight among its entries, words inside an exception phrase do not count, and
the sum is normalised by text length before a logistic curve makes it a score.

The lexicon is learned in Spark from labelled rows: entries are whole words and
word beginnings whose document counts differ between the labels far beyond
chance (log-likelihood ratio), weighted by their log odds. Copies of one toxic
text would lend their innocent words that ratio too, so near copies count once,
and entries are picked greedily: the strongest first, each pick halving the
weight of the toxic texts it explains, until none stands out. Exception phrases
are pairs of neighbouring words around an entry that only clean texts hold.

One bound, a parameter: at most ``SAMPLE_PER_LABEL`` labelled rows a label are
used to fit (chosen by a hash of the doc_id; near copies count once). It bounds
the candidate entries and exception phrases too, which are all kept: they reach
the driver with which sampled rows hold them. Scoring covers every whole text
and needs no shuffle.

Defined results: null text is the empty text and gets the score of a text
without findings; without labelled rows of both kinds the lexicon is empty and
all scores are 0; rows with a null label or doc_id are not learned from;
repeated rows come back once per row; an empty table gives an empty result;
columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import let_workers_import
from .common import cut, table

SAMPLE_PER_LABEL = 6000
#: Log-likelihood ratio an entry needs; chance alone exceeds it about once in 10,000 entries.
MIN_RATIO = 15.0
MIN_TOXIC = 3
#: Times as frequent an entry must be in toxic texts as in clean ones.
MIN_LIFT = 50
MIN_EXCEPTION = 5
#: Entries are whole words, or their first 3 to 8 letters.
BEGINNINGS = range(3, 9)

# Letters of other scripts, signs and digits that look like a Latin letter.
LOOK_ALIKE = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s", "ј": "j", "к": "k",
    "м": "m", "т": "t", "в": "b", "н": "h", "α": "a", "ε": "e", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "ι": "i",
    "κ": "k", "ν": "v", "ı": "i", "ɡ": "g", "ⅼ": "l",
}
DIGIT_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

_ALIKE = str.maketrans(LOOK_ALIKE)
_DIGITS = str.maketrans(DIGIT_FOR)
_WORD = re.compile(r"[\w@$]+")
_MARKS = re.compile("[\u0300-\u036f\u0483-\u0489\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]+")
_SUBSTITUTED = re.compile(r"[0-9@$]")


def fold(text: str) -> list[str]:
    """The folded words of a text. Digits and signs are read as letters only in words that also hold a letter."""
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
    words = _WORD.findall(text.lower().translate(_ALIKE))
    if not _SUBSTITUTED.search(text):
        return words
    return [w.translate(_DIGITS).strip("@$") or w if _SUBSTITUTED.search(w) and not w.isdecimal() else w
            for w in words]


def entries_of(words: set[str]) -> set[str]:
    """The entries that a set of words holds: `` word `` for whole words, `` begin`` for beginnings."""
    found = {f" {w} " for w in words}
    for n in BEGINNINGS:
        found.update(f" {w[:n]}" for w in words if len(w) > n)
    return found


@dataclass
class Lexicon:
    """Weighted entries, exception phrases and the curve from weight to score."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    base: float = -20.0
    slope: float = 0.0

    def automaton(self) -> ahocorasick.Automaton | None:
        if not self.weights:
            return None
        machine = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            machine.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            machine.add_word(f" {phrase} ", (len(phrase) + 2, None))
        machine.make_automaton()
        return machine

    def score(self, weight: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, self.base + self.slope * weight))))


def hits(words: list[str], machine: ahocorasick.Automaton) -> tuple[str, dict[int, float]]:
    """The joined text, and the highest weight by start of each word found, exception phrases taken out."""
    joined = f" {' '.join(words)} "
    found: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    for last, (length, weight) in machine.iter(joined):
        start = last - length + 1
        if weight is None:
            excused.append((start, last))
        elif weight > found.get(start, 0.0):
            found[start] = weight
    places = sorted(found) if excused else []
    for start, last in excused:
        for at in places[bisect_left(places, start):bisect_left(places, last)]:
            found.pop(at, None)
    return joined, found


def weigh(text: str, machine: ahocorasick.Automaton | None) -> float:
    """Summed weight over the text, normalised by its length: the sum is divided by
    one plus the logarithm of the length in hundreds of words, and its square
    root tempers repeats."""
    if machine is None or not text:
        return 0.0
    words = fold(text)
    _, found = hits(words, machine)
    return math.sqrt(sum(found.values()) / (1.0 + math.log1p(len(words) / 100.0)))


def training_rows(docs: DataFrame, labels: DataFrame, learn_from) -> DataFrame:
    """``(text, toxic)``: a bounded number of labelled rows a label. Of texts
    with an equal smallest shingle hash, under either of two seeds, one stays."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & learn_from).select(
        F.col("doc_id").alias("id"), (F.col("toxic") > 0).cast("int").alias("toxic")).distinct()
    known = cut(known, "labels")
    some = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_PER_LABEL) for k in (0, 1)]
    chosen = cut(some[0].union(some[1]), "toxic-ids")
    texts = docs.select(F.col("doc_id").alias("doc"), F.col("text").cast("string").alias("text"))
    # at most 2 * SAMPLE_PER_LABEL rows of 12 bytes: a proven bound, so no text is shuffled to meet them
    joined = texts.join(F.broadcast(chosen), F.col("doc") == F.col("id")).where(F.col("text").isNotNull())

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            smallest = [_smallest(t.as_py().encode()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([a for a, _ in smallest], pa.int64()),
                 pa.array([b for _, b in smallest], pa.int64())], ["text", "toxic", "near", "near2"])

    rows = joined.select("text", "toxic").mapInArrow(signed, "text string, toxic int, near long, near2 long")
    for key in ("near", "near2"):
        rows = rows.groupBy(F.col(key).alias("key")).agg(F.min(F.struct("near", "near2", "toxic", "text")).alias("r"))
        rows = rows.select("r.*")
    return rows.select("text", "toxic")


def _smallest(text: bytes) -> tuple[int, int]:
    """The smallest hashes of the text's three-word shingles, under two seeds."""
    parts = text.lower().split()
    shingles = {b" ".join(parts[i:i + 3]) for i in range(max(1, len(parts) - 2))}
    return tuple(min(xxhash.xxh64_intdigest(x, seed) for x in shingles) >> 1 for seed in (1, 2))


def _counted(rows: DataFrame, of_text) -> DataFrame:
    """``(entry, toxic, clean)`` document counts of what ``of_text`` finds; summed in the tasks first."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = (Counter(), Counter())
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[toxic].update(of_text(text))
            entries = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(entries, pa.string()), pa.array([counts[1][e] for e in entries], pa.int64()),
                 pa.array([counts[0][e] for e in entries], pa.int64())], ["entry", "toxic", "clean"])

    parts = rows.select("text", "toxic").mapInArrow(per_batch, "entry string, toxic long, clean long")
    return parts.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn(docs: DataFrame, labels: DataFrame, learn_from) -> Lexicon:
    """The lexicon of the labelled rows that meet the condition ``learn_from`` (over ``labels``)."""
    rows = cut(training_rows(docs, labels, learn_from), "toxic-sample")
    totals = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon()

    def entries(text: str) -> set[str]:
        return entries_of(set(fold(text)))

    t, c = F.col("toxic").cast("double"), F.col("clean").cast("double")
    # bounded by the sample: a candidate stands in MIN_TOXIC of its toxic rows or more
    candidates = (_counted(rows, entries).where((t >= MIN_TOXIC) & (t * n_clean >= c * n_toxic * MIN_LIFT))
                  .select("entry", "toxic", "clean").collect())
    odds = {r.entry: math.log((r.toxic + 0.5) / (n_toxic + 1)) - math.log((r.clean + 0.5) / (n_clean + 1))
            for r in candidates}
    picked = _picked(rows, {r.entry: r.clean for r in candidates}, n_clean)
    lexicon = Lexicon({e: odds[e] for e in picked if odds[e] > 0})
    if not lexicon.weights:
        return lexicon
    lexicon.exceptions = _exceptions(rows, lexicon)
    _fit(rows, lexicon, n_toxic, n_clean)
    return lexicon


def _picked(rows: DataFrame, clean: dict[str, int], n_clean: int) -> list[str]:
    """The candidates picked greedily, the longest among equals; a pick halves the weight of the texts it explains."""
    names = sorted(clean)
    number = {e: i for i, e in enumerate(names)}

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [sorted(number[e] for e in entries_of(set(fold(t.as_py()))) if e in number)
                     for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32()))], ["held"])

    toxic = rows.where(F.col("toxic") == 1).select("text").mapInArrow(held, "held array<int>").collect()
    if not names or not toxic:
        return []
    # (text, entry) pairs as two arrays, by entry
    text = np.repeat(np.arange(len(toxic)), [len(row.held) for row in toxic])
    entry = np.concatenate([np.array(row.held, dtype=np.int64) for row in toxic])
    by_entry = np.argsort(entry, kind="stable")
    text, entry = text[by_entry], entry[by_entry]
    ends = np.cumsum(np.bincount(entry, minlength=len(names)))
    texts_of = [text[a:b] for a, b in zip(np.concatenate(([0], ends[:-1])), ends)]
    # entries of the same texts (the beginnings of one word): all but the one picked add nothing
    twins: dict[bytes, list[int]] = {}
    for e, on in enumerate(texts_of):
        twins.setdefault(on.tobytes(), []).append(e)
    order = np.array(sorted(range(len(names)), key=lambda e: (len(names[e]), names[e]), reverse=True))
    in_clean = np.array([clean[e] for e in names], dtype=float)
    weight, open_, out = np.ones(len(toxic)), np.ones(len(names), dtype=bool), []
    while open_.any():
        # weights are powers of two, so equal sums are equal to the last bit
        t = np.bincount(entry, weight[text], minlength=len(names))
        share = weight.sum() / (weight.sum() + n_clean)
        n = t + in_clean
        able = open_ & (t >= MIN_TOXIC) & (t > n * share)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = 2 * (t * np.log(t / (n * share)) + np.where(in_clean > 0, in_clean * np.log(in_clean / (n * (1 - share))), 0.0))
        ratio = np.where(able, ratio, 0.0)
        best = order[np.argmax(ratio[order])]  # the longest among equals
        if ratio[best] < MIN_RATIO:
            break
        out.append(names[best])
        weight[texts_of[best]] /= 2
        open_[twins[texts_of[best].tobytes()]] = False
    return out


def _exceptions(rows: DataFrame, lexicon: Lexicon) -> list[str]:
    """Pairs of neighbouring words, one of them an entry, that clean texts hold and toxic ones do not."""
    built: list[ahocorasick.Automaton] = []

    def pairs(text: str) -> set[str]:
        if not built:
            built.append(lexicon.automaton())
        joined, found = hits(fold(text), built[0])
        out = set()
        for start in found:
            end = joined.index(" ", start + 1)
            word = joined[start + 1:end]
            before = joined[:start].rpartition(" ")[2]
            after = joined[end + 1:].partition(" ")[0]
            out.update(p for p in (f"{before} {word}" if before else "", f"{word} {after}" if after else "") if p)
        return out

    only_clean = _counted(rows, pairs).where((F.col("toxic") == 0) & (F.col("clean") >= MIN_EXCEPTION))
    return sorted(r.entry for r in only_clean.collect())  # bounded by the sample


def _fit(rows: DataFrame, lexicon: Lexicon, n_toxic: int, n_clean: int) -> None:
    """Logistic curve over the sample's weights, both labels weighing the same, with a small ridge."""
    got = _weighed(rows.select(F.col("toxic").cast("long").alias("doc_id"), "text"), lexicon).collect()
    x = np.array([r.weight for r in got])
    y = np.array([r.doc_id for r in got], dtype=float)
    share = np.where(y > 0, 0.5 / n_toxic, 0.5 / n_clean)
    design = np.stack([np.ones_like(x), x], axis=1)
    theta = np.zeros(2)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ theta, -30, 30)))
        slope = design.T @ (share * (p - y)) + 1e-4 * theta
        curve = (design * (share * p * (1 - p))[:, None]).T @ design + 1e-4 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        theta -= step
        if np.abs(step).max() < 1e-9:
            break
    lexicon.base, lexicon.slope = float(theta[0]), float(theta[1])


def _weighed(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``(doc_id, weight, score)``, a row per document."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = lexicon.automaton()
        for batch in batches:
            weights = [weigh(t.as_py() or "", machine) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(weights, pa.float64()),
                 pa.array([lexicon.score(w) for w in weights], pa.float64())], ["doc_id", "weight", "score"])

    let_workers_import(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(per_batch, "doc_id long, weight double, score double")


def scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``(doc_id, score, predicted)``, a row per document."""
    return _weighed(docs, lexicon).select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below 0.5."""
    let_workers_import(docs.sparkSession)
    schema = docs.schema
    at = docs.columns.index("text")

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = lexicon.automaton()
        for batch in batches:
            clean = [lexicon.score(weigh(t.as_py() or "", machine)) < 0.5 for t in batch.column(at)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(per_batch, schema)


def held_out():
    """True where a row is kept out of the fit: crc32 of the doc_id as text, modulo 5, is 0."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def fitted(spark, sf_dir: str) -> Lexicon:
    """The lexicon of a data folder's labelled documents that are not held out."""
    return learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out())


def op10_toxicity(spark, sf_dir):
    lexicon = fitted(spark, sf_dir)
    return scored(table(spark, sf_dir, "documents"), lexicon).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")
