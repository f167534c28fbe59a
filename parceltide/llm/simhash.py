"""SimHash near-dedup: pigeonhole blocks, then Hamming distance.

Fingerprints that differ in at most d bits agree on at least b - d of b blocks,
so every choice of b - d blocks is a join key and a close pair shares at least
one. Equal fingerprints are one node from the start. A key shared by more than
``most_together`` fingerprints is refined: the bits it leaves open are cut into
blocks again, until a group is small or leaves so few bits open that it must be. Within a group the
distances are verified and a spanning forest of the links is returned, never all
pairs; connected components join the forests.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from parceltide.llm.components import components
from parceltide.session import stage

SHINGLE_WORDS, MOST_BITS = 3, 3
MOST_TOGETHER = 1024
_FEW_BITS = 10  # a key that leaves no more bits open has at most 1024 fingerprints
_PIECE = 1 << 16  # shingles counted at once


def _fingerprint(text: bytes, words: int) -> int:
    """Signed 64-bit SimHash of the word shingles; without words zero."""
    parts = text.lower().split()  # bytes: ASCII letters and the six ASCII blanks only
    if not parts:
        return 0
    total, count = np.zeros(64, dtype=np.int64), max(1, len(parts) - words + 1)
    digest = xxhash.xxh64_intdigest
    for low in range(0, count, _PIECE):
        high = min(low + _PIECE, count)
        pieces = zip(*(parts[low + k : high + k] for k in range(words))) if len(parts) >= words else [parts]
        hashes = np.fromiter((digest(b" ".join(p), 42) for p in pieces), dtype=np.uint64, count=high - low)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * total > count, bitorder="little")
    return int(packed.view(np.int64)[0])


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_fingerprint((t.as_py() or "").encode(), words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["id", "fp"])

    return run


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp) of every row; null and empty texts have fingerprint zero."""
    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(
        _fingerprints(words), f"id {kind}, fp long"
    )


def hex_digits(fp: F.Column) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


@lru_cache(maxsize=1 << 14)
def finer_masks(mask: int, most_bits: int) -> tuple[int, ...]:
    """Masks of ``mask`` plus every choice of all but ``most_bits`` blocks of its open bits.

    Masks are signed 64-bit numbers, as Spark holds them.
    """
    fixed = mask & ((1 << 64) - 1)
    free = [k for k in range(64) if not fixed >> k & 1]
    blocks = min(2 * most_bits, len(free))
    cuts = np.array_split(np.array(free, dtype=np.int64), blocks) if blocks else []
    taken = blocks - most_bits
    if taken <= 0:
        return ()
    return tuple(
        _signed(fixed | sum(1 << int(k) for cut in chosen for k in cut)) for chosen in combinations(cuts, taken)
    )


def _forest(prints: np.ndarray, most_bits: int) -> list[tuple[int, int]]:
    """Links from every fingerprint to the smallest of its component, by verified distances."""
    n = len(prints)
    if n == 2:
        return [(int(prints[1]), int(prints[0]))] if int(prints[0] ^ prints[1]).bit_count() <= most_bits else []
    near = np.empty((n, n), dtype=bool)
    for low in range(0, n, 256):
        near[low : low + 256] = np.bitwise_count(prints[low : low + 256, None] ^ prints[None, :]) <= most_bits
    label, links = np.full(n, -1), []
    for start in range(n):
        if label[start] >= 0:
            continue
        front = np.array([start])
        label[start] = start
        while len(front):
            front = np.flatnonzero(near[front].any(axis=0) & (label < 0))
            label[front] = start
            links += [(int(prints[k]), int(prints[start])) for k in front]
    return links


def _forests(most_bits: int):
    @F.pandas_udf("array<struct<a:long,b:long>>")
    def links(groups: pd.Series) -> pd.Series:
        out = []
        for group in groups:
            prints = np.sort(np.asarray(group, dtype=np.int64)).view(np.uint64)
            found = [(np.uint64(a), np.uint64(b)) for a, b in _forest(prints, most_bits)]
            out.append([{"a": int(a.view(np.int64)), "b": int(b.view(np.int64))} for a, b in found])
        return pd.Series(out, dtype=object)

    return links


def _refined(rows: DataFrame, most_bits: int) -> DataFrame:
    @F.pandas_udf("array<long>")
    def masks(mask: pd.Series) -> pd.Series:
        return pd.Series([list(finer_masks(int(m), most_bits)) for m in mask], dtype=object)

    return rows.select("fp", F.explode(masks("mask")).alias("mask"))


def close_links(prints: DataFrame, most_bits: int = MOST_BITS, most_together: int = MOST_TOGETHER) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within ``most_bits``.

    ``prints`` has distinct fingerprints ``fp``.
    """
    if most_bits < 1:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    first = [F.lit(m).cast("long") for m in finer_masks(0, most_bits)]
    rows = prints.select("fp", F.explode(F.array(*first)).alias("mask"))
    solved = []
    while True:
        keyed = rows.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
        sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        shared = stage(keyed.join(sizes, ["mask", "key"]), "blocks")
        few = (F.col("n") <= most_together) | (F.bit_count("mask") >= 64 - _FEW_BITS)
        small = shared.where(few).groupBy("mask", "key").agg(F.collect_list("fp").alias("fps"))
        solved.append(small.select(F.inline(_forests(most_bits)("fps"))))
        large = shared.where(~few)
        if large.limit(1).count() == 0:
            break
        rows = stage(_refined(large, most_bits).distinct(), "blocks")
    out = solved[0]
    for more in solved[1:]:
        out = out.union(more)
    return out.distinct()


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = SHINGLE_WORDS,
    most_bits: int = MOST_BITS, most_together: int = MOST_TOGETHER,
) -> DataFrame:
    """(id, fp, component_id) of every row.

    ``component_id`` is the smallest id whose fingerprint can be reached over
    links of at most ``most_bits`` bits; null ids never name a component unless
    it has no other. Empty texts link like any other. Only id and text are read.
    """
    stored = stage(fingerprints(docs, id_column, text_column, words), "fingerprints")
    nodes = stored.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(close_links(nodes.select("fp"), most_bits, most_together)).withColumnRenamed("node", "fp")
    placed = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = placed.join(named, "root").select("fp", "component_id")
    return stored.join(by_print, "fp").select("id", "fp", "component_id")
