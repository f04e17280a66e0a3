"""Document fingerprints by a homomorphic multiset hash.

A text is the multiset of its paragraphs (lines), and each paragraph is hashed to a wide vector: four numbers of 30 bits
from its digest, and 96 signs for each of its phrases, summed. Phrases are the parts of a paragraph between words that
end in certain letters or punctuation, so their edges depend on nothing but nearby text. The fingerprint is the sum of the
paragraphs' vectors, the numbers modulo 2^30 and the sums of signs modulo 2^16: the order of paragraphs doesn't matter, and a
paragraph is inserted or deleted by adding or subtracting its vector (`combined`).

Likeness of two fingerprints: each sum of signs estimates how many phrases two texts have apart (the expected square of the
difference), as in a tug-of-war sketch; likeness is one minus that over the two texts' own squares, within 0 and 1, and 1 for
equal fingerprints.

DataFrame functions only. Every phrase is one row that is summed up where it is made, before the shuffle; a text of very many
phrases is summed in pieces. Texts are shuffled once by a key of their row, and the part that the document before needs once more.

Defined results: null is the empty text, which is one empty paragraph; of several rows of one id the order is that of a hash of
their texts, and exact repeats of a row get the same result, the row after them being their next; a null id comes
first; a single document is its own next; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import in_order
from .tables import stored

#: Fixed value: the ends of words after which a phrase ends.
PHRASE_END = r"([.,!?esn]) "
PIECE = 30_000
SHIFTS, FIELD = 12, 16
MASK = sum(1 << (FIELD * i) for i in range(4))
_PARTS = (("h1", 1), ("h2", 16))
_SUMS = [f"{h}_{i}" for h, _ in _PARTS for i in range(SHIFTS)]
LANES = len(_SUMS) * 4


def _hex(text: Column, start: int, n: int) -> Column:
    return F.conv(F.substring(text, start, n), 16, 10).cast("long")


def phrase_signs(texts: DataFrame, key: list[str], kinds: int = 1) -> DataFrame:
    """key, s0, s1, ...: for each kind of text (column `kind`, from 0) the sums of signs over its phrases, modulo 2^16.

    What is shuffled are sums, four to a number; they become one value a lane only where a key's pieces are together."""
    phrases = texts.select(*key, "kind", F.posexplode(F.split(F.regexp_replace("text", PHRASE_END, "$1\n"), "\n")).alias("pos", "unit"))
    digest = F.md5("unit")
    units = phrases.select(*key, "kind", (F.col("pos") / PIECE).cast("int").alias("piece"), *[_hex(digest, at, 15).alias(h) for h, at in _PARTS])
    # Four counts a number; each piece is short enough for its counts not to run over.
    packed = units.groupBy(*key, "kind", "piece").agg(F.count("*").alias("n"), *[
        F.sum(F.shiftright(h, i).bitwiseAND(F.lit(MASK))).alias(f"{h}_{i}") for h, _ in _PARTS for i in range(SHIFTS)])
    pieces = packed.groupBy(*key).agg(F.collect_list(F.struct("kind", "n", F.array(*_SUMS).alias("sums"))).alias("pieces"))

    def lanes(piece: Column) -> Column:
        fields = F.flatten(F.transform(piece["sums"], lambda s: F.array(*[F.shiftright(s, FIELD * j).bitwiseAND(F.lit((1 << FIELD) - 1)) for j in range(4)])))
        return F.transform(fields, lambda c: 2 * c - piece["n"])

    def total(kind: int) -> Column:
        own = F.transform(F.filter("pieces", lambda p: p["kind"] == kind), lanes)
        return F.aggregate(own, F.array_repeat(F.lit(0).cast("long"), LANES), lambda s, x: F.zip_with(s, x, lambda p, q: p + q))

    return pieces.select(*key, *[signed(total(i)).alias(f"s{i}") for i in range(kinds)])


def signed(values: Column) -> Column:
    """Values modulo 2^16 as numbers of two bytes, from -2^15 on."""
    half = 1 << (FIELD - 1)
    return F.transform(values, lambda x: (F.pmod(x + half, F.lit(1 << FIELD)) - half).cast("smallint"))


def paragraph_numbers(text: Column) -> Column:
    """Four sums over the paragraphs' digests, modulo 2^30."""
    digests = F.transform(F.split(text, "\n"), F.md5)
    part = lambda i: F.aggregate(digests, F.lit(0).cast("long"), lambda s, d: s + _hex(d, 1 + 8 * i, 8).bitwiseAND(F.lit((1 << 30) - 1)))
    return modulo(F.array(*[part(i) for i in range(4)]), 30)


def modulo(values: Column, bits: int) -> Column:
    return F.transform(values, lambda x: F.pmod(x, F.lit(1 << bits)))


def combined(a: tuple[Column, Column], b: tuple[Column, Column], sign: int = 1) -> tuple[Column, Column]:
    """Numbers and signs of a multiset with another one added (sign 1) or taken away (sign -1)."""
    added = [F.zip_with(x, y, lambda p, q: p.cast("long") + sign * q) for x, y in zip(a, b, strict=True)]
    return modulo(added[0], 30), signed(added[1])


def text_of(numbers: Column, signs: Column) -> Column:
    """The fingerprint as a string of hexadecimal digits."""
    return F.concat_ws("", F.transform(numbers, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")),
                       F.transform(modulo(signs, FIELD), lambda x: F.lpad(F.lower(F.hex(x)), 4, "0")))


def likeness(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """0 to 1: how much two fingerprints' texts have in common."""
    def square(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x)

    apart = square(signed(F.zip_with(a[1], b[1], lambda x, y: x.cast("long") - y)))
    own = square(a[1]) + square(b[1])
    equal = (a[0] == b[0]) & (a[1] == b[1])
    return F.when(equal, 1.0).when(own == 0, 0.0).otherwise(F.greatest(F.lit(0.0), 1 - apart.cast("double") / own))


_KEY = ["k1", "k2"]


def _keyed(documents: DataFrame) -> DataFrame:
    """A 128-bit key of each row's id and text."""
    text = F.coalesce("text", F.lit(""))
    return documents.select("doc_id", text.alias("text"), F.xxhash64("doc_id", text).alias("k1"), F.xxhash64(F.lit(7), text, "doc_id").alias("k2"))


def _on(right: str) -> list[Column]:
    return [F.col(k) == F.col(f"{right}{k}") for k in _KEY]


def next_of_each(keyed: DataFrame) -> DataFrame:
    """k1, k2, next_k1, next_k2 and needed, half the characters, of each distinct row; narrow and stored."""
    narrow = keyed.select("doc_id", *_KEY, F.length("text").cast("long").alias("n_chars")).distinct()
    order = [F.asc_nulls_first("doc_id"), F.asc("k1"), F.asc("k2")]
    ordered = in_order(narrow, order, "ids")
    first = ordered.groupBy("__part").agg(F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id", *_KEY)).alias("first"))
    # One row per partition; after the last comes the first.
    parts = Window.orderBy("__part")
    everywhere = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = first.select(F.col("__part").alias("__p"), *[
        F.coalesce(F.lead(f"first.{k}").over(parts), F.first(f"first.{k}").over(everywhere)).alias(f"after_{k}") for k in _KEY])
    inside = Window.partitionBy("__part").orderBy(*order)
    linked = ordered.withColumns({f"next_{k}": F.lead(k).over(inside) for k in _KEY}).join(F.broadcast(after), F.col("__part") == F.col("__p"))
    return stored(linked.select(*_KEY, *[F.coalesce(f"next_{k}", f"after_{k}").alias(f"next_{k}") for k in _KEY], F.floor(F.col("n_chars") / 2).alias("needed")), "links")


def with_next(keyed: DataFrame, links: DataFrame) -> DataFrame:
    """Each distinct row once: keys, those of the row before, text, and edited, the text whose last half is replaced by
    the next one's beginning."""
    texts = keyed.dropDuplicates(_KEY)
    to_me = links.select(*[F.col(f"next_{k}").alias(f"to_{k}") for k in _KEY], *[F.col(k).alias(f"for_{k}") for k in _KEY], "needed")
    heads = texts.join(to_me, _on("to_")).select("for_k1", "for_k2", F.expr("left(text, cast(needed as int))").alias("head"))
    before = links.select(*[F.col(f"next_{k}").alias(f"of_{k}") for k in _KEY], *[F.col(k).alias(f"before_{k}") for k in _KEY])
    mine = links.select(*[F.col(k).alias(f"my_{k}") for k in _KEY], "needed").join(before, [F.col(f"my_{k}") == F.col(f"of_{k}") for k in _KEY])
    own = texts.join(mine, _on("my_"))
    return own.join(heads, _on("for_")).select(
        *_KEY, "before_k1", "before_k2", "text", F.concat(F.expr("left(text, cast(length(text) - needed as int))"), "head").alias("edited"))


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document."""
    keyed = _keyed(documents)
    pairs = with_next(keyed, next_of_each(keyed))
    facts = pairs.select(*_KEY, "before_k1", "before_k2", F.sha2("edited", 256).alias("edited_sha256"),
                         paragraph_numbers(F.col("text")).alias("n0"), paragraph_numbers(F.col("edited")).alias("n1"))
    kinds = F.explode(F.array(*[F.struct(F.lit(i).alias("kind"), F.col(x).alias("text")) for i, x in enumerate(("text", "edited"))]))
    signs = phrase_signs(pairs.select(*_KEY, kinds.alias("x")).select(*_KEY, "x.kind", "x.text"), _KEY, 2)
    wide = signs.select(*[F.col(k).alias(f"of_{k}") for k in _KEY], "s0", "s1")
    known = stored(facts.join(wide, _on("of_")).drop("of_k1", "of_k2"), "fingerprints")
    following = known.select(*[F.col(f"before_{k}").alias(f"at_{k}") for k in _KEY], F.col("n0").alias("n2"), F.col("s0").alias("s2"))
    rows = keyed.select("doc_id", *[F.col(k).alias(f"row_{k}") for k in _KEY], F.length("text").cast("long").alias("n_chars"))
    own, new, after = ((F.col(f"n{i}"), F.col(f"s{i}")) for i in range(3))
    # All three sides meet by the row's key, so what is long isn't moved again.
    together = known.drop("before_k1", "before_k2").join(following, _on("at_")).join(rows, _on("row_"))
    return together.select("doc_id", "n_chars", "edited_sha256", text_of(*own).alias("fingerprint"), text_of(*new).alias("edited_fingerprint"),
                           likeness(own, new).alias("near_edited"), likeness(own, after).alias("near_next"))
