"""Conversation prefix trie by the Euler-tour technique.

Every distinct sequence of first turns is a node. Nodes are named by sums of 128 hash
bits over (position, role, text) of their turns, so that prefixes of one conversation
are running sums, whatever its length. Each node gives an enter and an exit arc; the
arcs form one tour, which is ranked as a linked list. What lies between the two arcs of
a node is its subtree: leaves and savings are differences of the sums at both arcs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from parceltide.llm import list_rank
from parceltide.operators.ranking import running_totals
from parceltide.session import shuffle_width, stage

WORD = r"[^\x20\x09-\x0D]+"
HEAD_GROUP, MOST_HEAD = 20, 4
PIECE = 1 << 20  # characters of a joined id list in one row
_LANES = 4


def turns_of(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv, pos, key, words) of every row: its place in its conversation from 0, the MD5 of role and text, word count.

    Rows are ordered by turn, null first; equal turns by MD5. Null role or text is empty. Rows without a
    conversation id take no part; repeated rows are turns of their own. Other columns are not read.
    """
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = stage(conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.md5(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, said).cast("binary")).alias("key"),
        F.regexp_count(said, F.lit(WORD)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("tie"), F.lit(1).alias("one"),
    ), "turns")  # the texts are read once, not again for the borders of the ranges
    placed = running_totals(rows, [F.col("turn").asc_nulls_first(), F.col("key"), F.col("tie")], {"upto": "one"}, ["conv"])
    return placed.select("conv", (F.col("upto") - 1).cast("long").alias("pos"), "key", "words")


def with_shared_heads(turns: DataFrame, group: int = HEAD_GROUP, most_head: int = MOST_HEAD) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: (rows with conv, depth, length, key, words; table of conv, length).

    The first h turns of conversation c come from conversation c - c % group, h = crc32(decimal c) % most_head;
    its own turns after its first h follow. A conversation may end up without turns.
    """
    sizes = turns.groupBy("conv").agg((F.max("pos") + 1).alias("n"))
    heads = sizes.select(
        "conv", "n", (F.col("conv") - F.col("conv") % group).alias("base"),
        (F.crc32(F.col("conv").cast("string").cast("binary")) % most_head).alias("h"),
    )
    given = sizes.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    plan = stage(heads.join(given, "base", "left").withColumn(
        "lent", F.least(F.coalesce("n_base", F.lit(0)), "h")
    ).select(
        "conv", "base", "h", "lent", (F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")
    ), "heads")
    own = turns.join(plan, "conv").where("pos >= h").select(
        "conv", (F.col("pos") - F.col("h") + F.col("lent") + 1).alias("depth"), "length", "key", "words"
    )
    # at most most_head - 1 rows of a base, for at most 2 * group - 1 conversations
    lent = turns.where(F.col("pos") < most_head - 1).select(F.col("conv").alias("base"), "pos", "key", "words").join(
        plan, "base"
    ).where("pos < h").select("conv", (F.col("pos") + 1).alias("depth"), "length", "key", "words")
    return own.union(lent), plan.select("conv", "length")


def as_they_are(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations as given, in the form of ``with_shared_heads``."""
    sizes = turns.groupBy("conv").agg((F.max("pos") + 1).alias("length"))
    rows = turns.join(sizes, "conv").select("conv", (F.col("pos") + 1).alias("depth"), "length", "key", "words")
    return rows, sizes


def _pair(lanes: list[Column]) -> list[Column]:
    """Two 64-bit halves of the name from the running sums of four 32-bit lanes."""
    low = [lane % (1 << 32) for lane in lanes]
    return [F.shiftleft(low[k], 32).bitwiseOR(low[k + 1]) for k in (0, 2)]


def _prefixes(rows: DataFrame) -> DataFrame:
    """(conv, depth, length, words, a, b, parent_a, parent_b): the node of every row and the one above."""
    halves = [F.xxhash64(F.lit(k), "depth", "key") for k in (1, 2)]
    lanes = [lane for x in halves for lane in (F.shiftrightunsigned(x, 32), x.bitwiseAND(0xFFFFFFFF))]
    keyed = rows.select("conv", "depth", "length", "words", *[lane.alias(f"l{k}") for k, lane in enumerate(lanes)])
    summed = running_totals(keyed, [F.col("depth")], {f"s{k}": f"l{k}" for k in range(_LANES)}, ["conv"])
    a, b = _pair([F.col(f"s{k}") for k in range(_LANES)])
    up_a, up_b = _pair([F.col(f"s{k}") - F.col(f"l{k}") for k in range(_LANES)])
    return summed.select(
        "conv", "depth", "length", "words", a.alias("a"), b.alias("b"), up_a.alias("parent_a"), up_b.alias("parent_b")
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined ids of sorted (a, b, conv) rows, in rows of bounded length."""
    node, first, held, size = None, None, [], 0

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([node[0]]), pa.array([node[1]]), pa.array([first]), pa.array([",".join(held)])], ["a", "b", "first", "ids"]
        )

    for batch in batches:
        for a, b, conv in zip(*[batch.column(k).to_pylist() for k in range(3)]):
            if node is not None and (node != (a, b) or size >= PIECE):
                yield piece()
                held, size = [], 0
            if not held:
                node, first = (a, b), conv
            held.append(str(conv))
            size += len(held[-1]) + 1
    if held:
        yield piece()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each node, which come sorted: a stream in constant memory."""
    node, state = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([node[0]]), pa.array([node[1]]), pa.array([state.hexdigest()])], ["a", "b", "ends_sha256"]
        )

    for batch in batches:
        for a, b, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)):
            if node != (a, b):
                if node is not None:
                    yield row()
                node, state = (a, b), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.as_py().encode())
    if node is not None:
        yield row()


def end_digests(ends: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) of the conversations that end at each node, from (a, b, conv).

    Ids are sorted and joined in slices of their global order. A digest is sequential, so the joined pieces of
    one node pass one task, as a stream.
    """
    width = shuffle_width(ends.sparkSession)
    pieces = ends.repartitionByRange(width, "a", "b", "conv").sortWithinPartitions("a", "b", "conv").mapInArrow(
        _pieces, "a long, b long, first long, ids string"
    )
    return pieces.repartition(width, "a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(
        _digests, "a long, b long, ends_sha256 string"
    )


def _next_sibling(kids: DataFrame) -> DataFrame:
    """(num, sibling): the next child of the same parent by number, for parents of any size."""
    dealt = stage(
        kids.select("num", "parent").repartitionByRange(shuffle_width(kids.sparkSession), "parent", "num")
        .withColumn("slice", F.spark_partition_id()), "siblings",
    )
    local = dealt.select("num", "parent", "slice", F.lead("num").over(Window.partitionBy("parent", "slice").orderBy("num")).alias("near"))
    starts = dealt.groupBy("parent", "slice").agg(F.min("num").alias("start"))
    across = starts.select("parent", "slice", F.lead("start").over(Window.partitionBy("parent").orderBy("slice")).alias("far"))
    return local.join(across.where("far IS NOT NULL"), ["parent", "slice"], "left").select(
        "num", F.coalesce("near", "far").alias("sibling")
    )


def tour(nodes: DataFrame) -> DataFrame:
    """Enter (2 * num) and exit (2 * num + 1) arcs of (num, first, sibling, parent, saved), each with the next arc."""
    enter, leave = F.col("num") * 2, F.col("num") * 2 + 1
    arcs = F.array(
        F.struct(enter.alias("at"), F.coalesce(F.col("first") * 2, leave).alias("to"),
                 F.col("first").isNull().cast("long").alias("leaves"), F.col("saved").alias("saved")),
        F.struct(leave.alias("at"), F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1, F.lit(-1)).alias("to"),
                 F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved")),
    )
    return nodes.select(F.inline(arcs))


def prefix_trie(rows: DataFrame, sizes: DataFrame, **ranking) -> DataFrame:
    """One row per node of the trie: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``rows`` has (conv, depth, length, key, words) with depths 1 to ``length``, ``sizes`` (conv, length) of all
    conversations, those without turns included. A node is named by (conv_id, depth): its smallest member and its
    number of turns. ``n_leaves`` counts the childless nodes of its subtree, itself included; ``saved_tokens`` adds
    (members - 1) times the words of the last turn over its subtree. No conversation gives no node, not even a root.
    """
    width = shuffle_width(rows.sparkSession)
    prefixes = stage(_prefixes(rows), "prefixes")
    below = prefixes.groupBy("a", "b").agg(
        F.min("conv").alias("conv"), F.min("depth").alias("depth"), F.min("parent_a").alias("parent_a"),
        F.min("parent_b").alias("parent_b"), F.count("*").alias("n_convs"), F.min("words").alias("words"),
    )
    none = F.lit(0).cast("long")
    root = sizes.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        none.alias("a"), none.alias("b"), "conv", none.alias("depth"), F.lit(None).cast("long").alias("parent_a"),
        F.lit(None).cast("long").alias("parent_b"), "n_convs", none.alias("words"),
    )
    # numbers ascend with (conv, depth), so a conversation's path and the next sibling are mostly near
    nodes = stage(
        below.unionByName(root).repartitionByRange(width, "conv", "depth").sortWithinPartitions("conv", "depth")
        .withColumn("num", F.monotonically_increasing_id()), "nodes",
    )
    above = nodes.select(F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), F.col("num").alias("parent"),
                         F.col("conv").alias("parent_conv"))
    placed = stage(nodes.join(above, ["parent_a", "parent_b"], "left").drop("parent_a", "parent_b"), "placed")
    kids = placed.where("parent IS NOT NULL")
    families = kids.groupBy("parent").agg(F.min("num").alias("first"), F.count("*").alias("n_children"))
    linked = placed.join(families.withColumnRenamed("parent", "num"), "num", "left").join(_next_sibling(kids), "num", "left")
    arcs = tour(linked.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")))
    sums = list_rank.sums_to_end(stage(arcs, "arcs"), ["leaves", "saved"], **ranking)
    sign = F.when(F.col("at") % 2 == 0, 1).otherwise(-1)
    between = sums.groupBy(F.shiftright("at", 1).alias("num")).agg(
        F.sum(F.col("leaves") * sign).alias("n_leaves"), F.sum(F.col("saved") * sign).alias("saved_tokens")
    )
    ends = prefixes.where("depth = length").select("a", "b", "conv").union(
        sizes.where("length = 0").select(none.alias("a"), none.alias("b"), "conv")
    )
    return linked.join(between, "num").join(end_digests(ends), ["a", "b"], "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
