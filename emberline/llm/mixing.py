"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

A document's tokens are its words. Sources in code-point order (null last) weigh 1, 2, 3, 1, ... and
share the corpus's tokens by weight; no target is above three times the source's tokens, and the
excess is shared again by weight among the others. The tokens are dealt as blocks of `block` tokens:
a source's number of blocks is the number of its quotients target / (2k + 1) among the highest. Each
source is cut into shards of about `shard_words` tokens by a hash of the id, and its blocks are dealt to
them in the same way by their sizes. In a shard the documents lie in a seeded order on a line of
blocks; whole rounds take every block, and the rest are consecutive blocks from a seeded start. What a
document gives is what its part of the line has in common with the blocks taken.

All DataFrame functions. Texts are read once for their sizes; what is ordered, joined and stored are
narrow rows. A source of a third of all rows is many shards, and no window holds more than one shard.

Defined results: null text has size 0 and gives nothing; a null source is a source of its own, the
last; repeated rows count each for themselves; null ids are ordered as an empty id; without any
token all targets are 0; columns beside doc_id, text and source are not read (`apply` hands all through).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import numbered
from .tables import stored

WORD = r"[^\x20\x09-\x0D]+"
BLOCK, SHARD_WORDS, SEED, MOST = 64, 1 << 18, "mix-1", 3
WEIGHTS = (1, 2, 3)


def _number(*parts: Column) -> Column:
    """A number below 2^32 drawn from the parts and the seed."""
    text = F.concat_ws("|", *[F.coalesce(x.cast("string"), F.lit("")) for x in parts], F.lit(SEED))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, rank, target. One row per source is stored; a round of sharing reads that table."""
    ranked = stored(numbered(sources, [F.asc_nulls_last("source")], "rank", "sources")
                    .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))), "weights")
    share, before, cap = 0.0, None, F.col("source_size") * most
    over = lambda share: F.col("weight") * F.lit(share) > cap
    capped: Column = F.lit(False)
    while True:
        n, total, full, weight = ranked.agg(
            F.count_if(capped), F.sum("source_size"), F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("weight")))).first()
        if n == before or not weight:
            break
        before, share = n, float(total - (full or 0)) / float(weight)
        capped = over(share)
    target = F.when(capped, cap.cast("double")).otherwise(F.col("weight") * F.lit(share))
    return ranked.select("source", "source_size", "rank", target.alias("target"))


def quotas(claims: DataFrame, group: list[str], claim: str, house: Column, order: Column, name: str) -> DataFrame:
    """Adds `blocks`: Sainte-Lague seats of each row, `house` in each group, ties in the given order.

    Bounds on the final divisor give each row all seats but the last few, so only about two quotients a
    row are ranked. All groups' quotients are ranked in one order of range partitions; a quotient's place in its group is
    its place there less that of the group's first, so no window holds a group."""
    named = {x: f"__in_{x}" for x in group}
    same = [F.col(x).eqNullSafe(F.col(y)) for x, y in named.items()]
    if group:
        claims = stored(claims, f"{name}_claims")
        sums = claims.groupBy(*group).agg(F.count("*").alias("__n"), F.sum(claim).alias("__all")).withColumnsRenamed(named)
        known = claims.join(sums, same).drop(*named.values())
    else:
        known = claims.join(F.broadcast(claims.agg(F.count("*").alias("__n"), F.sum(claim).alias("__all"))))
    bound = lambda sign: F.floor(F.coalesce(F.col(claim) * (house + sign * F.col("__n") / 2) / F.expr("nullif(`__all`, 0)"), F.lit(0.0)) + 0.5)
    known = stored(known.withColumns({"__low": F.greatest(F.lit(0), bound(-1) - 1).cast("long"), "__house": house.cast("long")})
                   .withColumn("__high", F.greatest(F.col("__low"), bound(1) + 1).cast("long")), name)
    tried = known.where(f"{claim} > 0").withColumn("__k", F.explode(F.sequence("__low", "__high"))).withColumn("__quotient", F.col(claim) / (2 * F.col("__k") + 1))
    by = [F.desc("__quotient"), order, F.asc("__k")]
    if group:
        missing = known.groupBy(*group).agg((F.first("__house") - F.sum("__low")).alias("__missing"))
        ranked = stored(numbered(tried, [*group, *by], "__at", name), f"{name}_ranked")
        first = ranked.groupBy(*group).agg(F.min("__at").alias("__first"))
        offsets = missing.join(first.withColumnsRenamed(named), same).drop(*named.values()).withColumnsRenamed(named)
        placed = ranked.join(offsets, same).withColumn("__place", F.col("__at") - F.col("__first"))
    else:
        missing = known.agg((F.first("__house") - F.sum("__low")).alias("__missing"))
        placed = numbered(tried, by, "__place", name).join(F.broadcast(missing))
    key = claims.columns
    won = placed.where("__place < __missing").groupBy(*[F.col(x).alias(f"__key_{x}") for x in (*group, "rank")]).agg(F.count("*").alias("__won"))
    joined = known.join(won, [F.col(x).eqNullSafe(F.col(f"__key_{x}")) for x in (*group, "rank")], "left")
    return joined.select(*key, (F.col("__low") + F.coalesce("__won", F.lit(0))).alias("blocks"))


def takes(rows: DataFrame, block: int = BLOCK, shard_words: int = SHARD_WORDS) -> DataFrame:
    """rows: doc_id, source, size and any more columns, stored. Adds source_size, target, taken, and where the
    document lies and what is taken: __rounds of all, and of its words [__a, __b) and [0, __c)."""
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    seats = stored(quotas(sources, [], "target", F.round(F.col("__all") / block), F.asc("rank"), "seats"), "seats")
    shards_of = seats.withColumn("__shards", F.ceil((F.col("source_size") + 1) / shard_words)).select(
        F.col("source").alias("__source"), "source_size", "target", F.col("rank").alias("__rank"), "blocks", "__shards")
    dealt = rows.join(shards_of, F.col("source").eqNullSafe(F.col("__source")))
    dealt = dealt.withColumn("__shard", _number(F.col("doc_id")) % F.col("__shards"))
    sizes = (dealt.groupBy("__rank", "__shard").agg(F.sum("size").alias("__size"), F.first("blocks").alias("__seats"))
             .withColumn("rank", F.col("__shard")))
    shard_quotas = quotas(sizes, ["__rank"], "__size", F.col("__seats"), F.asc("rank"), "shards").select(
        F.col("__rank").alias("__r"), F.col("__shard").alias("__s"), F.col("__size"), F.col("blocks").alias("__quota"))
    line = Window.partitionBy("__rank", "__shard").orderBy(_number(F.col("doc_id"), F.lit("order")), "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (dealt.withColumn("__off", F.coalesce(F.sum("size").over(line), F.lit(0)))
              .join(shard_quotas, (F.col("__rank") == F.col("__r")) & (F.col("__shard") == F.col("__s"))))
    n = F.greatest(F.lit(1), F.ceil(F.col("__size") / block))
    placed = (placed.withColumn("__n", n).withColumn("__rounds", F.expr("__quota div __n")).withColumn("__rest", F.col("__quota") % F.col("__n"))
              .withColumn("__start", _number(F.col("__rank"), F.col("__shard"), F.lit("start")) % F.col("__n")))
    end = F.col("__start") + F.col("__rest")
    inside = lambda x: F.greatest(F.lit(0), F.least("size", x - F.col("__off")))
    placed = placed.withColumns({
        "__a": inside(F.col("__start") * block), "__b": inside(end * block),
        "__c": inside(F.greatest(F.lit(0), end - F.col("__n")) * block)})
    taken = F.col("__rounds") * F.col("size") + (F.col("__b") - F.col("__a")) + F.col("__c")
    return placed.withColumn("taken", F.least(taken, MOST * F.col("size"))).select(
        *rows.columns, "source_size", "target", "taken", "__rounds", "__a", "__b", "__c")


def _sized(documents: DataFrame) -> DataFrame:
    return documents.withColumn("size", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long"))


def mix(documents: DataFrame, **parameters) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    rows = stored(_sized(documents.select("doc_id", "source", "text")).select("doc_id", "source", "size"), "sizes")
    return takes(rows, **parameters).select("doc_id", "size", "source_size", "target", "taken")


def apply(documents: DataFrame, **parameters) -> DataFrame:
    """The documents as the mix takes them, columns unchanged: a text taken several times stands that often in
    its row, a text that a block's edge cuts is left with the words taken, and one not taken goes.
    n_chars, if there, is counted anew."""
    given = documents.select(F.struct(*documents.columns).alias("__given"), "doc_id", "source", "text", F.monotonically_increasing_id().alias("__row"))
    every = stored(_sized(given), "mixed")
    taken = takes(every.select("__row", "doc_id", "source", "size"), **parameters).where("taken > 0").select(
        F.col("__row").alias("__r"), "__rounds", "__a", "__b", "__c")
    words = lambda a, b: F.array_join(F.slice("__words", F.col(a) + 1 if isinstance(a, str) else F.lit(1), b), " ")
    part = lambda n, cut: F.when(n <= 0, F.lit(None)).when(n >= F.col("size"), F.col("text")).otherwise(cut)
    n = F.col("__b") - F.col("__a")
    pieces = F.concat(F.array_repeat(F.col("text"), F.col("__rounds").cast("int")),
                      F.array(part(n, words("__a", n.cast("int"))), part(F.col("__c"), words(0, F.col("__c").cast("int")))))
    cut = ((n > 0) & (n < F.col("size"))) | ((F.col("__c") > 0) & (F.col("__c") < F.col("size")))
    out = (every.join(taken, F.col("__row") == F.col("__r"))
           .withColumn("__words", F.when(cut, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
           .withColumn("text", F.array_join(F.array_compact(pieces), "\n")))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*[new[c].cast(f.dataType).alias(c) if (c := f.name) in new else F.col("__given").getField(c).alias(c) for f in documents.schema])
