"""Operator 13: the prefix trie of conversations, rolled up by centroid decomposition.

Conversations are put in order and rebuilt, and every turn gets the key of the sequence that
ends with it: the exclusive-or, over all turns so far, of 128-bit hashes of position, role
and text. Positions and keys are running values within a conversation. They are computed in
two levels over range-sorted rows: within each range first, then from the totals of the ranges
before, of which at most one conversation per range needs any; so a conversation of any length
is spread over tasks. Equal keys are one node; a node is named by its smallest member and depth.

Sums over subtrees come from a recursive centroid decomposition of the forest below the
textless root. A component's centroid is the lowest node with at least half of the component's
weight below it; a node's weight counts the turns its members have from there on, which is the
number of members summed over its subtree and needs no recursion. Each round

* finds the centroids and which nodes lie below them, by looking up the turn at the centroid's
  depth in the conversation that names the node;
* adds the total below each centroid to all nodes on the path from it to its component's top;
* makes a component of each child's subtree and of what is left above.

So every node is added once to every node above it, in the round that parts the two. Weights
halve: rounds grow with the logarithm of the largest component, however deep it is. Components
of at most ``LIMIT`` nodes are summed within a task.

The digest of the members that end at a node is made from a sorted stream: pieces of joined
ids first, one range after the other, then one stream of pieces per node.

Defined cases: rows of equal turn follow each other in the order of a hash of role and text,
repeated rows are turns of their own; rows without conv_id take no part; a conversation whose
turns are all replaced by those of an absent one is turnless and a member of the root only;
an empty table gives no rows, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import written
from .common import table
from .registry import query

HEAD, BLOCK_OF = 6, 100
LIMIT = 1000
PIECE = 50_000


def _running(keep: list[str], sums: list[str]):
    """Of rows sorted by conv: their place in it and running exclusive-ors, within a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, place, held = TaskContext.get().partitionId(), None, 0, [np.int64(0)] * len(sums)
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv").to_numpy()
            new = np.concatenate([[conv[0] != last], conv[1:] != conv[:-1]])
            begins = np.maximum.accumulate(np.where(new, np.arange(len(conv)), -1))
            goes_on = begins < 0
            places = np.arange(1, len(conv) + 1) + np.where(goes_on, place, -begins)
            columns = []
            for i, name in enumerate(sums):
                whole = np.bitwise_xor.accumulate(batch.column(name).to_numpy())
                before = np.concatenate([[np.int64(0)], whole])[np.maximum(begins, 0)]
                own = whole ^ np.where(goes_on, held[i], before)
                columns.append(pa.array(own))
                held[i] = own[-1]
            last, place = conv[-1], int(places[-1])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(np.full(len(conv), part, np.int32)), pa.array(places), *columns],
                names=[*keep, "part", "place", *(f"run_{s}" for s in sums)],
            )

    return run


def running(rows: DataFrame, order: list, sums: list[str], name: str) -> DataFrame:
    """Rows with their place within conv (from 1) and running exclusive-ors ``run_*`` of columns.

    ``order`` holds the columns that sort the rows of a conv. Rows are range-sorted, so that a
    conv with any number of rows is spread; what earlier ranges hold of it is added after.
    """
    keep = rows.columns
    kinds = ", ".join(f"{n} {t}" for n, t in [*rows.dtypes, ("part", "int"), ("place", "long")])
    kinds += "".join(f", run_{s} long" for s in sums)
    dealt = rows.repartitionByRange("conv", *order).sortWithinPartitions("conv", *order)
    local = written(dealt.mapInArrow(_running(keep, sums), kinds), name)
    own = [F.max("place").alias("c"), *(F.max_by(f"run_{s}", "place").alias(f"c_{s}") for s in sums)]
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = local.groupBy("conv", "part").agg(*own)
    carried = totals.select(
        "conv", "part", F.sum("c").over(before).alias("c"), *(F.bit_xor(f"c_{s}").over(before).alias(f"c_{s}") for s in sums)
    )
    # Only the first conv of a range can have rows in ranges before it: a row per range at most.
    carried = F.broadcast(carried.filter("c > 0"))
    joined = local.join(carried, ["conv", "part"], "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        *keep,
        (F.col("place") + F.coalesce("c", zero)).alias("place"),
        *(F.col(f"run_{s}").bitwiseXOR(F.coalesce(f"c_{s}", zero)).alias(f"run_{s}") for s in sums),
    )


def ordered(conversations: DataFrame) -> DataFrame:
    """(conv, e1, e2, chars, place) of every turn; e1 and e2 hash role and text."""
    text, role = (F.coalesce(F.col(c), F.lit("")) for c in ("text", "role"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("e1"),
        F.xxhash64(F.lit(1), role, text).alias("e2"),
        F.char_length(text).cast("long").alias("chars"),
    )
    return running(turns, [F.col("turn").asc_nulls_first(), "e1", "e2"], [], "turns").drop("turn")


def rebuilt(turns: DataFrame, head: int = HEAD, block: int = BLOCK_OF) -> tuple[DataFrame, DataFrame]:
    """(conv, len) of every conversation, and the turns (conv, d, e1, e2, chars, len) it gets."""
    convs = turns.groupBy("conv").agg(F.max("place").alias("m"))
    first = F.col("conv") - F.col("conv") % block
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(head))
    firsts = convs.filter(F.col("conv") % block == 0).select(F.col("conv").alias("first"), F.col("m").alias("there"))
    got = F.least("h", F.coalesce("there", F.lit(0)))
    left = F.greatest(F.col("m") - F.col("h"), F.lit(0))
    convs = convs.withColumn("first", first).withColumn("h", h).join(firsts, "first", "left")
    convs = convs.withColumn("got", got).withColumn("len", F.col("got") + left)
    convs = written(convs.select("conv", "first", "h", "got", "len"), "convs")
    values = ["e1", "e2", "chars", "len"]
    starts = turns.filter((F.col("place") < head) & (F.col("conv") % block == 0)).withColumnRenamed("conv", "first")
    begun = starts.join(convs, "first").filter("place <= h").select("conv", F.col("place").alias("d"), *values)
    own = turns.join(convs, "conv").filter("place > h")
    own = own.select("conv", (F.col("place") - F.col("h") + F.col("got")).alias("d"), *values)
    return convs.select("conv", "len"), begun.union(own)


def _sum_small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subtree sums of whole components, whose rows come deepest first."""

    def sums() -> pa.RecordBatch:
        rows = [(*node, a, b) for node, (a, b) in out.items()]
        columns = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["conv", "d", "s1", "s2"])

    names = ["tc", "td", "conv", "d", "up", "v1", "v2", "s1", "s2"]
    top, below, out = None, {}, {}
    for batch in batches:
        for tc, td, conv, d, up, v1, v2, s1, s2 in zip(*(batch.column(c).to_pylist() for c in names)):
            if (tc, td) != top:
                top, below = (tc, td), {}
            a, b = below.pop((conv, d), (0, 0))
            a, b = a + v1, b + v2
            out[conv, d] = (s1 + a, s2 + b)
            over = below.get((up, d - 1), (0, 0))
            below[up, d - 1] = (over[0] + a, over[1] + b)
        yield sums()
        out = {}


_ACTIVE = ["tc", "td", "conv", "d", "up", "w", "v1", "v2", "s1", "s2"]


def _split(active: DataFrame, large: DataFrame, paths: DataFrame) -> DataFrame:
    """One round: centroids out of large components, their totals added to all nodes above."""
    comp, node = ["tc", "td"], ["conv", "d"]
    heavy = active.join(large, comp).filter(F.col("w") * 2 >= F.col("all"))
    lowest = heavy.groupBy(*comp).agg(F.min(F.struct("w", "conv", "d")).alias("c"))
    centroids = written(
        lowest.select(*comp, F.col("c.conv").alias("cc"), F.col("c.d").alias("cd"), F.col("c.w").alias("cw")), "centroids"
    )
    near = active.join(centroids, comp)
    # The turn one below the centroid's depth in the conversation that names a node.
    turn = paths.select(F.col("conv"), (F.col("d") - 1).alias("cd"), F.col("rep").alias("child"), F.col("up").alias("over"))
    looked = near.join(turn, ["conv", "cd"], "left")
    is_own = (F.col("conv") == F.col("cc")) & (F.col("d") == F.col("cd"))
    is_below = (F.col("d") > F.col("cd")) & (F.col("over") == F.col("cc"))
    marked = written(
        looked.select(
            *_ACTIVE, "cc", "cd", "cw", "child", is_own.alias("own"), F.coalesce(is_below, F.lit(False)).alias("below")
        ),
        "marked",
    )
    totals = marked.filter("own OR below").groupBy(*comp).agg(F.sum("v1").alias("t1"), F.sum("v2").alias("t2"))
    to_top = centroids.join(totals, comp).select(
        F.col("cc").alias("conv"), F.explode(F.sequence("td", "cd")).alias("d"), "t1", "t2"
    )
    to_top = to_top.join(paths, node).select(F.col("rep").alias("conv"), "d", "t1", "t2")
    zero = F.lit(0).cast("long")
    above = F.col("t1").isNotNull()
    return marked.join(to_top, node, "left").select(
        F.when(F.col("below"), F.col("child")).otherwise(F.col("tc")).alias("tc"),
        F.when(F.col("below"), F.col("cd") + 1).otherwise(F.col("td")).alias("td"),
        *node,
        "up",
        F.when(above, F.col("w") - F.col("cw")).otherwise(F.col("w")).alias("w"),
        "v1",
        "v2",
        (F.col("s1") + F.coalesce("t1", zero)).alias("s1"),
        (F.col("s2") + F.coalesce("t2", zero)).alias("s2"),
        "own",
    )


def rollup(nodes: DataFrame, paths: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(conv, d, s1, s2): sums of v1 and v2 over the subtree of every node.

    ``nodes`` has (conv, d, up, w, v1, v2): a node's name, the smallest member of its parent,
    its weight and values. ``paths`` has (conv, d, rep, up) for all turns of the conversations
    that name nodes: the node a turn ends and that node's parent.
    """
    tops = paths.filter("d = 1").select("conv", F.col("rep").alias("tc"))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    active = nodes.join(tops, "conv").withColumns({"td": one, "s1": zero, "s2": zero}).select(*_ACTIVE)
    active, out = written(active, "active"), []
    while True:
        sizes = active.groupBy("tc", "td").agg(F.count(F.lit(1)).alias("n"), F.max("w").alias("all"))
        sizes = written(sizes, "sizes")
        large = sizes.filter(F.col("n") > limit).drop("n")
        none = large.isEmpty()
        small = active if none else active.join(large, ["tc", "td"], "left_anti")
        dealt = small.repartition("tc", "td").sortWithinPartitions("tc", "td", F.col("d").desc())
        out.append(written(dealt.mapInArrow(_sum_small, "conv long, d long, s1 long, s2 long"), "summed"))
        if none:
            break
        split = written(_split(active.join(large, ["tc", "td"], "left_semi"), large, paths), "split")
        out.append(split.filter("own").select("conv", "d", "s1", "s2"))
        active = split.filter("NOT own").select(*_ACTIVE)
    whole = out[0]
    for part in out[1:]:
        whole = whole.union(part)
    return whole


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids joined by commas, a piece per node and partition, or more."""

    def joined(ends: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([e[i] for e in ends], kind) for i, kind in enumerate([pa.int64()] * 3 + [pa.string()])]
        return pa.RecordBatch.from_arrays(columns, names=["conv", "d", "at", "ids"])

    key, held = None, []
    for batch in batches:
        done = []
        for conv, d, member in zip(*(batch.column(c).to_pylist() for c in ("conv", "d", "member"))):
            if (conv, d) != key or len(held) >= PIECE:
                if held:
                    done.append((*key, held[0], ",".join(map(str, held))))
                key, held = (conv, d), []
            held.append(member)
        yield joined(done)
    if held:
        yield joined([(*key, held[0], ",".join(map(str, held)))])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def digests(done: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([e[i] for e in done], kind) for i, kind in enumerate([pa.int64()] * 2 + [pa.string()])]
        return pa.RecordBatch.from_arrays(columns, names=["conv", "d", "ends_sha256"])

    key, state = None, None
    for batch in batches:
        done = []
        for conv, d, ids in zip(*(batch.column(c).to_pylist() for c in ("conv", "d", "ids"))):
            if (conv, d) == key:
                state.update(b",")
            else:
                if key:
                    done.append((*key, state.hexdigest()))
                key, state = (conv, d), hashlib.sha256()
            state.update(ids.encode())
        yield digests(done)
    if key:
        yield digests([(*key, state.hexdigest())])


def end_digests(ends: DataFrame) -> DataFrame:
    """(conv, d, ends_sha256) from (conv, d, member): SHA-256 of a node's members in order."""
    order = ["conv", "d", "member"]
    sorted_ends = ends.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = sorted_ends.mapInArrow(_pieces, "conv long, d long, at long, ids string")
    dealt = pieces.repartition("conv", "d").sortWithinPartitions("conv", "d", "at")
    return dealt.mapInArrow(_digest, "conv long, d long, ends_sha256 string")


def trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """A row per node of the prefix trie, the textless root included."""
    turns = written(ordered(conversations), "ordered")
    convs, rows = rebuilt(turns)
    hashed = rows.select(
        "conv", "d", F.xxhash64("d", "e1").alias("f1"), F.xxhash64("d", F.lit(1), "e2").alias("f2"), "chars", "len"
    )
    keyed = running(hashed, ["d"], ["f1", "f2"], "keyed").drop("place")
    keyed = keyed.withColumnsRenamed({"run_f1": "k1", "run_f2": "k2"})
    keyed = keyed.withColumns({f"p{i}": F.col(f"k{i}").bitwiseXOR(F.col(f"f{i}")) for i in (1, 2)})
    key = ["d", "k1", "k2"]
    grouped = keyed.groupBy(*key).agg(
        F.min("conv").alias("rep"),
        F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("len") - F.col("d") + 1).alias("w"),
        *(F.min(c).alias(c) for c in ("p1", "p2", "chars")),
    )
    grouped = written(grouped, "nodes")
    over = grouped.select((F.col("d") + 1).alias("d"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("rep").alias("up"))
    # First turns have no parent here; theirs is the root.
    linked = written(grouped.join(over, ["d", "p1", "p2"], "left"), "linked")
    paths = keyed.select("conv", "len", *key).join(linked.select(*key, "rep", "up"), key).select("conv", "d", "len", "rep", "up")
    paths = written(paths, "paths")
    children = linked.filter("d > 1").groupBy(F.col("up").alias("rep"), (F.col("d") - 1).alias("d"))
    valued = linked.join(children.agg(F.count(F.lit(1)).alias("n_children")), ["rep", "d"], "left").select(
        F.col("rep").alias("conv"), "d", "up", "w", "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("v1"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("v2"),
    )
    valued = written(valued, "valued")
    sums = rollup(valued.drop("n_convs", "n_children"), paths.drop("len"), limit)
    # The root: all conversations are its members, those without turns end there.
    least, n_convs = convs.agg(F.min("conv"), F.count(F.lit(1))).first()
    tops, leaves, saved = valued.agg(F.count_if(F.col("d") == 1), F.sum("v1"), F.sum("v2")).first()
    columns = "conv long, d long, parent long, n_convs long, n_children long, s1 long, s2 long"
    root = [(least, 0, None, n_convs, tops, leaves or 1, saved or 0)] if n_convs else []
    root = conversations.sparkSession.createDataFrame(root, columns)
    parent = F.when(F.col("d") == 1, F.lit(least)).otherwise(F.col("up")).alias("parent")
    inner = valued.join(sums, ["conv", "d"]).select("conv", "d", parent, "n_convs", "n_children", "s1", "s2")
    none = convs.filter("len = 0").select(
        F.lit(least).cast("long").alias("conv"), F.lit(0).cast("long").alias("d"), F.col("conv").alias("member")
    )
    ends = paths.filter("d = len").select(F.col("rep").alias("conv"), "d", F.col("conv").alias("member"))
    digests = end_digests(ends.union(none))
    return root.union(inner).join(digests, ["conv", "d"], "left").select(
        F.col("conv").alias("conv_id"),
        F.col("d").alias("depth"),
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.col("s1").alias("n_leaves"),
        F.col("s2").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


@query("op13_prefix_trie")
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))
