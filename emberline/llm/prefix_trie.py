"""Prefix trie of conversations, as a burst trie: heads over containers of suffixes, which are sorted and swept into nodes.

A conversation is a sequence of turn ids (hashes of role and text); each of its prefixes has a 128-bit id, the exclusive
or of hashes of its turns and their places, so a running aggregate gives all prefixes. Equal conversations are one class
with a number of members. At first all classes hang below the root. A container (the classes that share a head prefix) of
more than `burst` classes bursts: its head becomes a trie node, and its classes go to the containers of their next turn
ids. What remains is sorted by head, from the deepest turn up, and swept once: the nodes of one depth hand their
counts to their parents at the depth above, so a sweep holds two depths of one container, at most 2 x `burst` nodes.
Containers of one class need no sweep: their nodes follow from running sums. Burst heads take their counts from
their children, level by level from the deepest.

Scale. No row holds a conversation, and no window or array its turns: turns are put in global order by range
partitions, places and prefixes are running aggregates within a partition plus what earlier partitions hold of the
conversation that crosses the edge (at most one row per partition). Heads of many classes are joined with salted keys.
Members that end at a node are listed in segments by range partition, and the segments are hashed as a stream, so the
digest of a node in which a third of all conversations end holds one segment in memory. There is one burst round for
each depth at which more than `burst` different conversations still share a prefix.

Defined results: rows without conv_id are in no conversation; turns that tie are ordered by role and text; null role
and text are empty; repeated rows are turns of their own; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored

GROUP, SHARED, BURST, SALTS, SEGMENT = 100, 6, 64, 16, 2000
PART_BITS = 33  # of monotonically_increasing_id


def _ordered(rows: DataFrame, order: list[Column], keep: list, name: str) -> DataFrame:
    """Stores the columns `keep` in global order; `seq` grows with it and names the range partition in its high bits."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranged.select(*keep, F.monotonically_increasing_id().alias("seq")), name).withColumn("part", F.shiftright("seq", PART_BITS))


def _running(rows: DataFrame, by: dict[str, tuple]) -> DataFrame:
    """Adds running aggregates over each conversation's rows up to the row. `by`: name to (aggregate, how two results add up).

    A conversation that crosses the edge of a range partition gets what the partitions before hold of it."""
    totals = rows.groupBy("c", "part").agg(*[f.alias(x) for x, (f, _, _) in by.items()])
    earlier = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # At most the first conversation of each partition is left.
    before = (totals.select("c", "part", *[again(F.col(x)).over(earlier).alias(f"__{x}") for x, (_, again, _) in by.items()])
              .where(" or ".join(f"__{x} is not null" for x in by)))
    inside = Window.partitionBy("part", "c").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.select("*", *[f.over(inside).alias(x) for x, (f, _, _) in by.items()]).join(F.broadcast(before), ["c", "part"], "left")
    return out.withColumns({x: add(F.col(x), F.coalesce(F.col(f"__{x}"), F.lit(0))) for x, (_, _, add) in by.items()}).drop(*[f"__{x}" for x in by])


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def rebuilt_turns(conversations: DataFrame, group: int = GROUP, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """c, d, t1, t2, chars, seq, part: the turns of every rebuilt conversation in order; and c: all conversations.

    Conversation c begins with the first crc32(c) % `shared` turns of conversation c - c % `group`, and goes on with its
    own turns after as many."""
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    own = _ordered(turns, [F.col("c"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")],
                   ["c", F.xxhash64("role", "text").alias("t1"), F.xxhash64(F.lit(7), "text", "role").alias("t2"), F.length("text").alias("chars")], "turns")
    placed = stored(_running(own, {"pos": (F.count("*"), F.sum, _plus)}).select("c", "pos", "t1", "t2", "chars"), "placed-turns")
    taken = (F.crc32(F.col("c").cast("string").cast("binary")) % shared).alias("h")
    ids = stored(placed.select("c").distinct(), "conversation-ids")
    heads = placed.where((F.col("c") % group == 0) & (F.col("pos") < shared)).withColumnRenamed("c", "base")
    lent = (ids.select("c", (F.col("c") - F.col("c") % group).alias("base"), taken).join(heads, "base").where("pos <= h")
            .select("c", F.col("pos").alias("place"), "t1", "t2", "chars"))
    rest = placed.where(F.col("pos") > taken).select("c", (F.col("pos") + shared).alias("place"), "t1", "t2", "chars")
    whole = _ordered(lent.unionByName(rest), [F.col("c"), F.col("place")], ["c", "t1", "t2", "chars"], "rebuilt-turns")
    return stored(_running(whole, {"d": (F.count("*"), F.sum, _plus)}), "rebuilt-places"), ids


def prefixes(turns: DataFrame) -> DataFrame:
    """c, d, p1, p2 (the prefix of d turns), q1, q2 (that of d - 1), chars, and cum, the code points up to here. The root is 0, 0."""
    mixed = turns.withColumns({"x1": F.xxhash64("t1", "t2", "d"), "x2": F.xxhash64(F.lit(3), "d", "t2", "t1")})
    out = _running(mixed, {"p1": (F.bit_xor("x1"), F.bit_xor, _xor), "p2": (F.bit_xor("x2"), F.bit_xor, _xor), "cum": (F.sum("chars"), F.sum, _plus)})
    return out.select("c", "d", "p1", "p2", F.col("p1").bitwiseXOR(F.col("x1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("x2")).alias("q2"), "chars", "cum")


def _stream(batches: Iterator[pa.RecordBatch], step: int = 4096) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield from zip(*(column.to_pylist() for column in batch.slice(at, step).columns), strict=True)


def ends_digests(ends: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """p1, p2, ends_sha256: the digest of the conversations that end at a node, in order; nodes in which none ends are left out."""
    order = ["e1", "e2", "c"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for e1, e2, c, seq in _stream(batches):
            if not rows or rows[-1][:2] != (e1, e2) or len(rows[-1][3]) == segment:
                if size > 4 * segment:
                    yield _segments(rows)
                    rows, size = [], 0
                rows.append((e1, e2, seq, []))
            rows[-1][3].append(str(c))
            size += 1
        yield _segments(rows)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, key, state = [], None, None
        for e1, e2, _, ids in _stream(batches, 64):
            if key != (e1, e2):
                if key:
                    found.append((*key, state.hexdigest()))
                key, state = (e1, e2), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
            if len(found) == 4096:
                yield _table(found, ("p1", "p2", "ends_sha256"), (pa.int64(), pa.int64(), pa.string()))
                found = []
        if key:
            found.append((*key, state.hexdigest()))
        yield _table(found, ("p1", "p2", "ends_sha256"), (pa.int64(), pa.int64(), pa.string()))

    lists = (ends.repartitionByRange(*order).sortWithinPartitions(*order).select(*order, F.monotonically_increasing_id().alias("seq"))
             .mapInArrow(cut, "p1 long, p2 long, seq long, ids string"))
    return lists.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "seq").mapInArrow(digest, "p1 long, p2 long, ends_sha256 string")


def _table(rows: list[tuple], names: tuple, types: tuple) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], list(names))


def _segments(rows: list[tuple]) -> pa.RecordBatch:
    return _table([(*row[:3], ",".join(row[3])) for row in rows], ("p1", "p2", "seq", "ids"), (pa.int64(), pa.int64(), pa.int64(), pa.string()))


def burst_heads(classes: DataFrame, skeleton: DataFrame, burst: int, salts: int) -> tuple[list[DataFrame], DataFrame]:
    """The burst nodes of each depth, from the root down; and the containers that are left: rep, k, h1, h2, up of each class.

    h1, h2 is the head, k its depth, up the smallest member of the node above it."""
    state = classes.select("rep", "m", "len", F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"),
                           F.lit(None).cast("long").alias("up"), F.lit(0).cast("long").alias("chars"), F.lit(0).cast("long").alias("q1"), F.lit(0).cast("long").alias("q2"))
    levels, left = [], []
    while True:
        k = len(levels)
        heads = state.groupBy("h1", "h2").agg(F.count("*").alias("n_classes"), F.sum("m").alias("n_convs"), F.min("rep").alias("conv_id"), F.first("up").alias("parent_conv_id"),
                                              F.first("chars").alias("chars"), F.first("q1").alias("q1"), F.first("q2").alias("q2"))
        # The root always bursts, so every container has a head of at least one turn.
        over = stored(heads.where(F.col("n_classes") > (burst if k else 0)).withColumn("depth", F.lit(k).cast("long")), "burst-heads")
        if over.isEmpty():
            return levels, _union([*left, state.select("rep", F.lit(k).alias("k"), "h1", "h2", "up")])
        levels.append(over)
        right = over.select(F.col("h1").alias("o1"), F.col("h2").alias("o2"), F.col("conv_id").alias("top"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("o3"))
        met = state.join(right, (F.col("h1") == F.col("o1")) & (F.col("h2") == F.col("o2")) & (F.pmod(F.xxhash64("rep"), F.lit(salts)) == F.col("o3")), "left")
        met = stored(met.drop("o1", "o2", "o3"), "burst-classes")
        left.append(met.where("top is null").select("rep", F.lit(k).alias("k"), "h1", "h2", "up"))
        following = skeleton.where(F.col("d") == k + 1).select("rep", F.col("p1").alias("h1"), F.col("p2").alias("h2"), F.col("chars").cast("long").alias("chars"), "q1", "q2")
        state = stored(met.where((F.col("top").isNotNull()) & (F.col("len") > k)).select("rep", "m", "len", F.col("top").alias("up")).join(following, "rep")
                       .select("rep", "m", "len", "h1", "h2", "up", "chars", "q1", "q2"), "next-classes")


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


NODES = ("p1 long, p2 long, q1 long, q2 long, top boolean, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long")
_NODE_NAMES = tuple(x.split()[0] for x in NODES.split(", "))
_NODE_TYPES = tuple(pa.bool_() if x.endswith("boolean") else pa.int64() for x in NODES.split(", "))


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers whose rows come sorted by head, from the deepest turn up, and by prefix.

    Rows: h1, h2, d, p1, p2, q1, q2, rep, m, chars, k, up. Sums of a depth wait for their parents at the depth above."""
    out: list[tuple] = []
    head = place = None
    below: dict[tuple, list] = {}  # children of the depth above, by parent: [nodes, leaves, saved]
    ready: dict[tuple, list] = {}  # children of this depth
    node: list | None = None  # d, p, q, smallest, members, chars, k, up

    def close() -> None:
        d, p, q, least, n, chars, k, up = node
        children, leaves, saved = ready.pop(p, ([], 1, 0))
        saved += (n - 1) * chars
        out.extend((*child[:7], least, *child[7:]) for child in children)
        record = (*p, *q, d == k, least, d, n, len(children), leaves, saved)
        if d == k:
            out.append((*record[:7], up, *record[7:]))
        else:
            into = below.setdefault(q, [[], 0, 0])
            into[0].append(record)
            into[1] += leaves
            into[2] += saved

    for h1, h2, d, p1, p2, q1, q2, rep, m, chars, k, up in _stream(batches):
        if node and (head != (h1, h2) or place != d or node[1] != (p1, p2)):
            close()
            node = None
            if head != (h1, h2) or place != d:
                ready, below = below, {}
            if head != (h1, h2):
                ready = {}
            if len(out) >= 4096:
                yield _table(out, _NODE_NAMES, _NODE_TYPES)
                out = []
        head, place = (h1, h2), d
        if node:
            node[3], node[4] = min(node[3], rep), node[4] + m
        else:
            node = [d, (p1, p2), (q1, q2), rep, m, chars, k, up]
    if node:
        close()
    yield _table(out, _NODE_NAMES, _NODE_TYPES)


def trie(conversations: DataFrame, group: int = GROUP, shared: int = SHARED, burst: int = BURST, salts: int = SALTS, segment: int = SEGMENT) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    turns, ids = rebuilt_turns(conversations, group, shared)
    steps = stored(prefixes(turns), "prefixes")
    last = steps.groupBy("c").agg(F.max("d").alias("len"), F.max_by(F.struct("p1", "p2"), "d").alias("e"), F.sum("chars").alias("total"))
    ends = stored(ids.join(last, "c", "left").select("c", *[F.coalesce(x, F.lit(0)).cast("long").alias(y) for x, y in (("len", "len"), ("e.p1", "e1"), ("e.p2", "e2"), ("total", "total"))]), "ends")
    classes = stored(ends.groupBy("e1", "e2").agg(F.min("c").alias("rep"), F.count("*").alias("m"), F.first("len").alias("len"), F.first("total").alias("total")), "classes")
    skeleton = stored(steps.join(classes.select(F.col("rep").alias("c"), F.col("rep"), "m", "len", "total"), "c").drop("c"), "skeleton")
    levels, containers = burst_heads(classes, skeleton, burst, salts)
    # A container holds at most `burst` classes, so counting and joining by head meets no frequent key.
    containers = stored(containers.join(containers.groupBy("h1", "h2").agg(F.count("*").alias("n_classes")), ["h1", "h2"]), "containers")
    inside = containers.join(skeleton, "rep").where("d >= k")
    lone = inside.where("n_classes = 1").select(
        "p1", "p2", "q1", "q2", (F.col("d") == F.col("k")).alias("top"), F.col("rep").alias("conv_id"), F.col("d").alias("depth"),
        F.when(F.col("d") == F.col("k"), F.col("up")).otherwise(F.col("rep")).alias("parent_conv_id"), F.col("m").alias("n_convs"),
        F.when(F.col("d") < F.col("len"), 1).otherwise(0).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("m") - 1) * (F.col("total") - F.col("cum") + F.col("chars"))).cast("long").alias("saved_tokens"))
    swept = (inside.where("n_classes > 1").select("h1", "h2", "d", "p1", "p2", "q1", "q2", "rep", "m", F.col("chars").cast("long").alias("chars"), F.col("k").cast("long").alias("k"), "up")
             .repartition("h1", "h2").sortWithinPartitions("h1", "h2", F.desc("d"), "p1", "p2").mapInArrow(sweep, NODES))
    low = stored(lone.unionByName(swept), "trie-nodes")
    found = [low.select("p1", "p2", *_NODE_NAMES[5:])]
    children = low.where("top").select("q1", "q2", "depth", "n_leaves", "saved_tokens")
    for k in reversed(range(len(levels))):
        sums = (children.where(F.col("depth") == k + 1).groupBy("q1", "q2").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("__leaves"), F.sum("saved_tokens").alias("__saved"))
                .withColumnsRenamed({"q1": "h1", "q2": "h2"}))
        nodes = stored(levels[k].join(sums, ["h1", "h2"], "left").select(
            F.col("h1").alias("p1"), F.col("h2").alias("p2"), "q1", "q2", "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.coalesce("__leaves", F.lit(1)).alias("n_leaves"), (F.coalesce("__saved", F.lit(0)) + (F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")), "head-nodes")
        found.append(nodes.drop("q1", "q2"))
        children = children.unionByName(nodes.select("q1", "q2", "depth", "n_leaves", "saved_tokens"))
    digests = ends_digests(ends.select("e1", "e2", "c"), segment)
    empty = hashlib.sha256(b"").hexdigest()
    return _union(found).join(digests, ["p1", "p2"], "left").select(*_NODE_NAMES[5:], F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))
