"""Document fingerprints by a homomorphic multiset hash (operator 4), in
DataFrame functions only.

A text is a multiset of paragraphs (lines; a line's clauses, cut after
``. ! ? ; : , |``, count as paragraphs too, and clauses of over ``LONG_CLAUSE``
characters are cut again where the words say so, so that any long text has many
parts). Each paragraph is hashed to a wide vector: a count lane,
``LANES`` lanes of one bit each, and two lanes of 64 bits. A text's fingerprint
is the sum of its paragraphs' vectors, the narrow lanes modulo 2^32 and the wide
ones modulo 2^64. So equal multisets have equal fingerprints in any order, and a
paragraph is inserted or deleted by adding or subtracting its vector
(:func:`plus`, :func:`minus`).

The bit lanes read as +1 and -1 make the difference of two fingerprints a
random projection of the difference of the multisets: the squared length over
``LANES`` estimates how many paragraphs differ. The likeness of two
fingerprints is ``1 - |a - b|^2 / (|a|^2 + |b|^2)``, clipped to 0..1.

Two narrow lanes share a long (32 bits each). Sums of bits cannot carry into
the other lane below 2^32 paragraphs; subtraction is done lane by lane.

Defined results: null text is the empty text, whose fingerprint is all zeros;
two empty fingerprints have likeness 1; the next document of a row is that with
the next larger doc_id (of several rows with that id, the one with the smallest
text), after the last the first; a null doc_id sorts after all others; a single
document is its own next; repeated rows come back once per row; an empty table
gives an empty result; columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, let, table

HASHES = 2                 # 64-bit hashes a paragraph
LANES = 64 * HASHES
WORDS = 32 * HASHES        # longs that hold the narrow lanes, two lanes each
LOW_BITS = 0x0000000100000001
MASK32 = 0xFFFFFFFF
SEEDS = (7, 42)            # salts of the paragraph hashes
WIDE = 2
#: Characters of a clause that is cut again, letters of a word that is, and how many parts a piece has on average.
LONG_CLAUSE, LONG_WORD, ONE_IN = 160, 40, 8
AFTER_ALL = Decimal(10 ** 19)  # above every long: stands for a null id


def pieces(clause: Column) -> Column:
    """A clause of over ``LONG_CLAUSE`` characters cut again: after the words, and inside words of
    over ``LONG_WORD`` letters after the letters, whose hash is divisible by ``ONE_IN``. Where it is
    cut follows from what stands there alone, so an edit changes the pieces around it only."""

    def marked(part: Column, gap: str) -> Column:
        return F.concat(part, F.when(F.pmod(F.xxhash64(part), F.lit(ONE_IN)) == 0, "\n").otherwise(gap))

    def word(w: Column) -> Column:
        letters = F.array_join(F.transform(F.split(w, ""), lambda c: marked(c, "")), "")
        return F.when(F.length(w) > LONG_WORD, F.concat(letters, F.lit(" "))).otherwise(marked(w, " "))

    cut_up = F.split(F.array_join(F.transform(F.split(clause, " "), word), ""), "\n")
    return F.when(F.length(clause) > LONG_CLAUSE, cut_up).otherwise(F.array(clause))


def paragraphs(text: Column) -> Column:
    """The text's lines and the clauses of lines that have several, long clauses in pieces."""
    lines = F.split(text, "\n")
    clauses = F.flatten(F.transform(lines, lambda x: F.split(x, r"(?<=[.!?;:,|])\s")))
    return F.filter(F.concat(F.transform(lines, lambda x: F.concat(F.lit("\n"), x)), F.flatten(F.transform(clauses, pieces))),
                    lambda p: (p != F.lit("")) & (p != F.lit("\n")))


def vector(text: Column) -> Column:
    """The fingerprint of a text column as an array of longs: the count, the narrow
    lanes two to a long, the wide lanes."""
    hashed = F.transform(paragraphs(text), lambda p: F.struct(*[F.xxhash64(F.lit(s), p).alias(f"h{s}") for s in SEEDS]))

    def lane_sum(hs: Column, lane) -> Column:
        return F.aggregate(hs, F.lit(0).cast("long"), lambda total, h: total + lane(h))

    def two_bits(seed: int, bit: int):
        return lambda h: F.shiftrightunsigned(h[f"h{seed}"], bit).bitwiseAND(F.lit(LOW_BITS))

    def half_word(k: int, half: int):
        return lambda h: F.shiftrightunsigned(F.xxhash64(F.lit(1000 + k), *[h[f"h{s}"] for s in SEEDS]),
                                              half).bitwiseAND(F.lit(MASK32))

    def wide(hs: Column, k: int) -> Column:
        # modulo 2^64 by halves, as sums of longs must not overflow
        low, high = lane_sum(hs, half_word(k, 0)), lane_sum(hs, half_word(k, 32))
        return let(low, lambda x: F.shiftleft((high + F.shiftright(x, 32)).bitwiseAND(F.lit(MASK32)), 32)
                   .bitwiseOR(x.bitwiseAND(F.lit(MASK32))))

    def sums(hs: Column) -> Column:
        return F.array(F.size(hs).cast("long"), *[lane_sum(hs, two_bits(s, b)) for s in SEEDS for b in range(32)],
                       *[wide(hs, k) for k in range(WIDE)])

    return let(hashed, sums)


def _lanewise(a: Column, b: Column, sign: int) -> Column:
    def word(x: Column, y: Column) -> Column:
        low = (x.bitwiseAND(F.lit(MASK32)) + sign * y.bitwiseAND(F.lit(MASK32))).bitwiseAND(F.lit(MASK32))
        high = (F.shiftrightunsigned(x, 32) + sign * F.shiftrightunsigned(y, 32)).bitwiseAND(F.lit(MASK32))
        return F.shiftleft(high, 32).bitwiseOR(low)

    def wide(x: Column, y: Column) -> Column:
        low = x.bitwiseAND(F.lit(MASK32)) + sign * y.bitwiseAND(F.lit(MASK32))
        high = (F.shiftrightunsigned(x, 32) + sign * F.shiftrightunsigned(y, 32) + F.shiftright(low, 32)).bitwiseAND(F.lit(MASK32))
        return F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(F.lit(MASK32)))

    narrow = F.zip_with(F.slice(a, 1, WORDS + 1), F.slice(b, 1, WORDS + 1), word)
    return F.concat(narrow, F.zip_with(F.slice(a, WORDS + 2, WIDE), F.slice(b, WORDS + 2, WIDE), wide))


def plus(a: Column, b: Column) -> Column:
    """The fingerprint of two multisets together."""
    return _lanewise(a, b, 1)


def minus(a: Column, b: Column) -> Column:
    """The fingerprint of ``a`` without the paragraphs of ``b``."""
    return _lanewise(a, b, -1)


def as_text(fp: Column) -> Column:
    """Hex digits of all lanes in order."""
    return F.lower(F.array_join(F.transform(fp, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints, 0 to 1, from their signed lanes ``2 * ones - count``."""

    def signed(n: Column, w: Column) -> list[Column]:
        return [w.bitwiseAND(F.lit(MASK32)) * 2 - n, F.shiftrightunsigned(w, 32) * 2 - n]

    na, nb = F.get(a, 0), F.get(b, 0)

    def pair(x: Column, y: Column) -> Column:
        (p, q), (r, s) = signed(na, x), signed(nb, y)
        d, e = (p - r).cast("double"), (q - s).cast("double")
        p, q, r, s = (c.cast("double") for c in (p, q, r, s))
        return F.struct((d * d + e * e).alias("apart"), (p * p + q * q + r * r + s * s).alias("both"))

    terms = F.zip_with(F.slice(a, 2, WORDS), F.slice(b, 2, WORDS), pair)
    total = F.aggregate(terms, F.struct(F.lit(0.0).alias("apart"), F.lit(0.0).alias("both")),
                        lambda s, t: F.struct((s["apart"] + t["apart"]).alias("apart"), (s["both"] + t["both"]).alias("both")))
    return let(total, lambda t: F.when(t["both"] == 0, F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.0), F.lit(1.0) - t["apart"] / t["both"])))


def next_ids(ids: DataFrame) -> DataFrame:
    """``(id, next_id)`` over the distinct values of column ``id`` in ascending
    order; the last is followed by the first.

    Ids are range-partitioned; a window inside each partition finds the next id,
    and the last id of a partition is followed by the first of the next, found
    from one row per partition.
    """
    dealt = cut(ids.select("id").distinct().repartitionByRange("id").withColumn("part", F.spark_partition_id()), "ranges")
    rows = dealt.select("id", "part", F.lead("id").over(Window.partitionBy("part").orderBy("id")).alias("next"))
    over = Window.partitionBy(F.lit(0)).orderBy("part")
    firsts = dealt.groupBy("part").agg(F.min("id").alias("first")).select(
        F.col("part").alias("of_part"), F.lead("first").over(over).alias("after"),
        F.first("first").over(over).alias("lowest"))
    return rows.join(firsts, F.col("part") == F.col("of_part")).select(
        "id", F.coalesce("next", "after", "lowest").alias("next_id"))


def sortable(doc_id: Column) -> Column:
    """The doc_id as a key that is never null; null sorts after every long."""
    return F.coalesce(doc_id.cast("decimal(20,0)"), F.lit(AFTER_ALL).cast("decimal(20,0)"))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """``(id, text, n_chars, fp)``, a row per document."""
    rows = docs.select(sortable(F.col("doc_id")).alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.select("id", "text", F.length("text").cast("long").alias("n_chars"), vector(F.col("text")).alias("fp"))


def _smallest_text(rows: DataFrame) -> DataFrame:
    """The row with the smallest text: a minimum that is combined in the tasks."""
    return rows.agg(F.min(F.struct("text", "id", "n_chars", "fp")).alias("least")).select("least.*")


def compared(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and their likenesses.

    Edited text: the last quarter of the code points replaced by the first as
    many of the next document. Texts are fingerprinted at the scan and shuffled
    once by id (both uses read one exchange); a document sends its predecessor
    only the characters asked for. Rows without an id, which all have one
    follower, are not shuffled: they meet its start in the tasks that read them.
    """
    known, nameless = (fingerprinted(docs.where(c)) for c in (F.col("doc_id").isNotNull(), F.col("doc_id").isNull()))
    lengths = cut(docs.select(sortable(F.col("doc_id")).alias("id"),
                              F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("n")), "lengths")
    order = next_ids(lengths).withColumnRenamed("id", "taker")
    # the most characters that rows of the id before want
    wants = lengths.groupBy("id").agg(F.max(F.floor(F.col("n") / 4)).alias("want"))
    wants = cut(wants.join(order, F.col("id") == F.col("taker"))
                .select(F.col("next_id").alias("giver"), "taker", "want"), "wants")
    smallest = F.lag(F.lit(1)).over(Window.partitionBy("id").orderBy("text")).isNull()
    givers = known.withColumn("smallest", smallest).where("smallest").drop("smallest")
    given = lambda some, asked: some.join(asked, F.col("id") == F.col("giver")).select(
        "taker", F.substring("text", F.lit(1), F.least("want", "n_chars").cast("int")).alias("start"), F.col("fp").alias("next_fp"))
    gifts = given(givers, wants)
    nameless_want = wants.where(F.col("taker") == AFTER_ALL).first()
    if nameless_want:
        last = _smallest_text(nameless)
        gifts = gifts.unionByName(given(last, wants))
        first = last if nameless_want.giver == AFTER_ALL else _smallest_text(
            fingerprinted(docs.where(F.col("doc_id") == int(nameless_want.giver))))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - quarter),
                      F.substring("start", F.lit(1), quarter))
    rows = known.join(gifts, F.col("id") == F.col("taker"))
    if nameless_want:
        to_nameless = F.broadcast(given(first, wants.where(F.col("taker") == AFTER_ALL)))  # one row
        rows = rows.unionByName(nameless.join(to_nameless, F.col("id") == F.col("taker")))
    rows = rows.select("id", "n_chars", "fp", "next_fp", F.sha2(edited, 256).alias("edited_sha256"),
                       vector(edited).alias("edited_fp"))
    return rows.select(F.when(F.col("id") < AFTER_ALL, F.col("id").cast("long")).alias("doc_id"), "n_chars",
                       "edited_sha256", as_text(F.col("fp")).alias("fingerprint"),
                       as_text(F.col("edited_fp")).alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                       likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))


def op4_multiset_hash(spark, sf_dir):
    return compared(table(spark, sf_dir, "documents"))
