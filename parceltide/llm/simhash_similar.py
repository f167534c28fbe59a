"""Near-duplicate documents at a set similarity: MinHash bands propose, exact Jaccard decides.

A few bits of a SimHash only catch copies that are almost equal, and wider ones only
estimate. For pairs that share 0.8 of their five-word shingles:

* 160 minima over the set of shingles are cut into 32 bands of five. A pair of similarity
  s shares a band with probability 1 - (1 - s^5)^32: all but 3 of a million pairs at 0.8.
  All texts of a band are linked to its smallest, so no band is too crowded, and the
  components of these links, which hold every proposed pair, are the groups.
* Inside a group the exact Jaccard similarity of the shingle sets decides, for all pairs
  whose ends are not linked already.

A group above ``most_together`` is first compared with its smallest text. What is linked to
it is one component; the rest is compared slice by slice with itself and with all others,
each two slices in one bounded task. Only the rest counts twice in the cost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from parceltide.llm import simhash
from parceltide.llm.bytes_math import Joined, byte_table, lower_ascii, mixed, run_hashes, text_chunks, window_hashes
from parceltide.llm.components import components
from parceltide.session import stage

WORDS, SIMILARITY = 5, 0.8
BANDS, BAND_ROWS = 32, 5
MOST_TOGETHER, MOST_BYTES = 1024, 16 << 20
# A list of texts up to this length is sent to all tasks instead of shuffling all texts.
MOST_SENT = 1_000_000
_WORD_BYTES = byte_table((0x20, 0x20), (0x09, 0x0D))
_FACTORS = mixed(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def _bands(shingles: np.ndarray) -> np.ndarray:
    """One key per band for a set of 64-bit hashes; none for the empty set."""
    if not len(shingles):
        return np.zeros(0, dtype=np.int64)
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for low in range(0, len(shingles), 1 << 11):
        lanes = shingles[None, low : low + (1 << 11)] * _FACTORS[:, None]
        lanes ^= lanes >> np.uint64(32)
        lanes *= np.uint64(0x94D049BB133111EB)
        np.minimum(least, lanes.min(axis=1), out=least)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in least.reshape(BANDS, BAND_ROWS).T:
        key = mixed(key ^ row) + row
    return key.view(np.int64)


def _word_hashes(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, hashes of the words of each text) by chunks of a column."""
    for first, texts in text_chunks(column):
        joined = Joined(texts)
        joined.buffer = lower_ascii(joined.buffer)
        starts, ends = joined.runs(_WORD_BYTES)
        hashes = run_hashes(joined.buffer, starts, ends)
        cuts = np.searchsorted(joined.owner(starts), np.arange(len(texts) + 1))
        yield first, [hashes[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _shingles(own: np.ndarray, words: int) -> np.ndarray:
    return window_hashes(own, max(1, min(words, len(own))))


def _prints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _word_hashes(batch.column(2)):
                same, bands = [], []
                for own in texts:
                    shingles = _shingles(own, words)
                    same.append(int(np.add.reduce(mixed(shingles * np.arange(1, len(shingles) + 1, dtype=np.uint64))).view(np.int64)))
                    bands.append(_bands(np.unique(shingles)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), batch.column(1).slice(first, len(texts)),
                     pa.array(same, pa.int64()), pa.array([len(own) for own in texts], pa.int64()),
                     pa.array(bands, pa.list_(pa.int64()))],
                    ["id", "row", "same", "n_words", "bands"],
                )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _word_hashes(batch.column(2)):
                sets = pa.array([np.unique(_shingles(own, words)).tobytes() for own in texts], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), batch.column(1).slice(first, len(texts)), sets],
                    ["node", "root", "shingles"],
                )

    return run


def _alike(shared, sizes, similarity: float):
    """Whether sets with together ``sizes`` members, of which they share ``shared``, are that similar."""
    return shared >= similarity * (sizes - shared) - 1e-9


def forest(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Edges of similar sets that connect what all similar pairs connect; the sets are not empty."""
    sizes = np.array([len(s) for s in sets])
    names, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    marked = np.zeros(len(names), dtype=bool)
    left, flat_left, edges, reached = np.arange(len(sets)), flat, [], []
    while len(left):
        if reached:
            last = reached.pop()
        else:
            last = int(left[0])
            left, flat_left = left[1:], flat_left[sizes[last] :]
            if not len(left):
                break
        own = flat[ends[last] - sizes[last] : ends[last]]
        marked[own] = True
        starts = np.cumsum(sizes[left]) - sizes[left]
        shared = np.add.reduceat(marked[flat_left], starts, dtype=np.int64)
        marked[own] = False
        found = _alike(shared, sizes[left] + sizes[last], similarity)
        if found.any():
            edges += [(last, int(k)) for k in left[found]]
            reached += left[found].tolist()
            flat_left, left = flat_left[np.repeat(~found, sizes[left])], left[~found]
    return edges


def _forests(similarity: float):
    @F.pandas_udf("array<struct<a:long,b:long>>")
    def links(nodes: pd.Series) -> pd.Series:
        out = []
        for group in nodes:
            group = sorted(group, key=lambda r: r["node"])
            ids = [r["node"] for r in group]
            edges = forest([np.frombuffer(r["shingles"], np.uint64) for r in group], similarity)
            out.append([{"a": ids[k], "b": ids[s]} for k, s in edges])
        return pd.Series(out, dtype=object)

    return links


def _similar_sets(similarity: float):
    @F.pandas_udf(T.BooleanType())
    def similar(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for one, other in zip(a, b):
            one, other = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
            shared = len(np.intersect1d(one, other, assume_unique=True))
            out.append(bool(_alike(shared, len(one) + len(other), similarity)))
        return pd.Series(out, dtype=bool)

    return similar


def _groups(nodes: DataFrame) -> DataFrame:
    """(node, root) of the texts that share a band with others, directly or by a chain."""
    rows = nodes.select("node", F.explode("bands").alias("key"))
    least = rows.groupBy("key").agg(F.min("node").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    return components(rows.join(least, "key").where("node <> b").select(F.col("node").alias("a"), "b").distinct())


def _slices(count: Column, size: Column, most_together: int) -> Column:
    return F.ceil(F.greatest(count / most_together, size / MOST_BYTES)).cast("int")


def _links(sets: DataFrame, similarity: float, most_together: int) -> DataFrame:
    """Edges (a, b) of similar sets that connect what all similar pairs of each ``root`` connect."""
    member = F.collect_list(F.struct("node", "shingles")).alias("nodes")
    forests = _forests(similarity)
    size = F.sum(F.octet_length("shingles"))
    # counts and smallest members combine before their shuffle; a root of a third of all rows is a few numbers here
    sizes = sets.groupBy("root").agg(_slices(F.count("*"), size, most_together).alias("k"), F.min("node").alias("first"))
    small = sets.join(sizes.where("k = 1"), "root").groupBy("root").agg(member).select(F.inline(forests("nodes")))
    crowded = sizes.where("k > 1").select("root", F.col("first").alias("node"))
    if crowded.limit(1).count() == 0:
        return small
    hubs = sets.join(crowded, ["root", "node"]).select("root", F.struct("node", "shingles").alias("hub"))
    with_hub = sets.join(hubs, "root")  # only written next, so adaptive execution can split a hot root
    large = stage(with_hub.select(
        "root", "node", "shingles", F.col("hub.node").alias("hub"), _similar_sets(similarity)("shingles", "hub.shingles").alias("near")
    ), "large")
    # slices of the texts near the hub, and of the others; two near ones are never compared
    counts = large.groupBy("root").agg(*[
        F.coalesce(
            _slices(F.count_if(flag), F.coalesce(F.sum(F.when(flag, F.octet_length("shingles"))), F.lit(0)), most_together), F.lit(0)
        ).alias(name) for name, flag in (("k_near", F.col("near")), ("k_far", ~F.col("near")))
    ]).where("k_far > 0")
    own = lambda k: F.pmod(F.xxhash64("node"), k).cast("int")
    placed = large.join(counts, "root").withColumn("own", F.when(F.col("near"), own("k_near")).otherwise(own("k_far")))
    to = lambda k: F.sequence(F.lit(0), F.col(k) - 1)
    task = lambda near, i, j: F.struct(F.lit(near).alias("near"), i.alias("i"), j.alias("j"))
    near_tasks = F.transform(to("k_far"), lambda j: task(True, F.col("own"), j))
    far_tasks = F.concat(
        F.transform(to("k_near"), lambda i: task(True, i, F.col("own"))),
        F.transform(to("k_far"), lambda j: task(False, F.least("own", j), F.greatest("own", j))),
    )
    dealt = placed.select(
        "root", "node", "shingles", F.explode(F.when(F.col("near"), near_tasks).otherwise(far_tasks)).alias("task")
    )
    across = dealt.groupBy("root", "task").agg(member).select(F.inline(forests("nodes")))
    return small.union(large.where("near and node <> hub").select("node", "hub")).union(across)


def similar_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS,
    similarity: float = SIMILARITY, most_together: int = MOST_TOGETHER,
) -> DataFrame:
    """(id, row, component) of every row; ``row`` is a hash of the text.

    Texts with equal word sequences are one node. A text of fewer words than a
    shingle is one shingle; texts without words are copies of each other.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    text = F.coalesce(F.col(text_column), F.lit(""))
    prints = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("row"), text.alias("text")).mapInArrow(
        _prints(words), f"id {kind}, row long, same long, n_words long, bands array<long>"
    )
    stored = stage(prints.withColumn("node", F.xxhash64("same", "n_words")).drop("same", "n_words"), "prints")
    nodes = stored.groupBy("node").agg(F.min(F.struct("row", "bands")).alias("p")).select("node", "p.row", "p.bands")
    nodes = stage(nodes, "nodes")
    looked_at = stage(nodes.select("node", "row").join(_groups(nodes), "node"), "looked_at")
    few = looked_at.count() <= MOST_SENT
    texts = docs.select(F.xxhash64(text).alias("row"), text.alias("text")).join(F.broadcast(looked_at) if few else looked_at, "row")
    one_each = texts.groupBy("node", "root").agg(F.first("text").alias("text"))
    sets = stage(one_each.mapInArrow(_sets(words), "node long, root long, shingles binary"), "sets")
    roots = components(_links(sets, similarity, most_together))
    return stored.select("id", "row", "node").join(roots, "node", "left").select(
        "id", "row", F.coalesce("root", "node").alias("component")
    )


def _joined_by_fingerprint(found: DataFrame, docs: DataFrame, text_column: str, most_bits: int) -> DataFrame:
    """``found`` with components that SimHash links of at most ``most_bits`` bits connect as one."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    prints = stage(simhash.fingerprints(
        docs.select(F.xxhash64(text).alias("row"), text.alias("text")), "row", "text"
    ), "fingerprints")
    prints = prints.distinct()
    roots = components(simhash.close_links(prints.select("fp").distinct(), most_bits)).withColumnRenamed("node", "fp")
    named = prints.join(roots, "fp", "left").select("id", F.coalesce("root", "fp").alias("root"))
    found = stage(found, "found")
    both = found.join(named, found["row"] == named["id"]).select("component", "root").distinct()
    least = both.groupBy("root").agg(F.min("component").alias("b"))
    links = both.join(least, "root").select(F.col("component").alias("a"), "b")
    joined = components(links.distinct()).withColumnRenamed("root", "_joined")
    return found.join(joined, found["component"] == joined["node"], "left").select(
        found["id"], "row", F.coalesce("_joined", "component").alias("component")
    )


def keep_one(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", fingerprints: bool = False, **how
) -> DataFrame:
    """The rows of ``docs``, all columns, without all but one row of every component: the smallest id, null last.

    With ``fingerprints``, SimHash links of ``simhash.MOST_BITS`` bits join components too.
    """
    found = similar_documents(docs, id_column, text_column, **how)
    if fingerprints:
        found = _joined_by_fingerprint(found, docs, text_column, simhash.MOST_BITS)
    kept = found.groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("kept")).select(
        F.col("kept.id").alias("_kept_id"), F.col("kept.row").alias("_kept_row")
    )
    text = F.coalesce(F.col(text_column), F.lit(""))
    keyed = docs.withColumns({"_id": F.col(id_column), "_row": F.xxhash64(text)})
    joined = keyed.join(kept, F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_row") == F.col("_kept_row")))
    return joined.dropDuplicates(["_id", "_row"]).select(*[F.col(f"`{c}`") for c in docs.columns])
