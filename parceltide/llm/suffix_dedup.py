"""Suffix-array dedup: byte stretches that occur twice, by merged Burrows-Wheeler transforms.

1. Every window of the repeat length belongs to one anchor (``repeat_anchors``).
   Runs of windows are counted by the hash of the bytes they share; anchors found
   once cannot hold a repeat and end here.
2. Where all runs of an anchor are equal, every one of them repeats. Else one
   segment of text per different run, with its count, is fetched from its document.
3. The segments of an anchor meet in one task: shards of them are transformed,
   merged by interleave refinement over blocks of 16 bytes, and the repeated
   intervals of the merged transform give the windows that may repeat. The bytes
   at both ends of the blocks decide.
4. Spans go back to all runs with the same segment, and to the documents.

An anchor with more than ``most_together`` different segments is not gathered:
its windows are counted one by one as rows, with the same result. Counts combine
before every shuffle, and a frequent segment travels once.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from parceltide.llm.bwt_merge import merge, transform
from parceltide.llm.bytes_math import found_twice, mixed, run_hashes, text_chunks
from parceltide.llm.repeat_anchors import BLOCK, Cut, window_runs
from parceltide.session import stage

LENGTH = 400
MOST_TOGETHER = 20_000
_BATCH, _SHARD = 4096, 512  # segments merged at once, unless one anchor has more; segments of a shard

_RUN = "seg_group long, segment long, doc long, place long"


def _doc(row_id: Column, text: Column) -> Column:
    """With ``_tag_of`` 79 hash bits of id and text; equal rows share them, and their result."""
    return F.xxhash64(row_id, text)


def _tag_of(text: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), text), F.lit(1 << 15))


# place: tag, first window start, anchor and last start relative to the first
def _tag() -> Column:
    return F.shiftright("place", 48)


def _first() -> Column:
    return F.shiftright("place", 16).bitwiseAND(F.lit((1 << 32) - 1))


def _last() -> Column:
    return _first() + F.col("place").bitwiseAND(F.lit(255))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _run_rows(cut: Cut):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at, texts in text_chunks(batch.column(2)):
                runs = window_runs(texts, cut)
                row = at + runs.owner
                place = tags[row] << 48 | runs.first << 16 | (runs.anchor - runs.first) << 8 | (runs.last - runs.first)
                yield pa.RecordBatch.from_arrays(
                    [_signed(runs.group), _signed(runs.segment), pa.array(docs[row]), pa.array(place)],
                    ["seg_group", "segment", "doc", "place"],
                )

    return run


def _segment_rows(cut: Cut):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, wanted in zip(batch.column(0).cast(pa.large_binary()), batch.column(1)):
                data, rows = text.as_py(), wanted.as_py()
                places = [r["place"] for r in rows]
                firsts = [p >> 16 & 0xFFFFFFFF for p in places]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["seg_group"] for r in rows], pa.int64()), pa.array([r["segment"] for r in rows], pa.int64()),
                     pa.array([r["n"] for r in rows], pa.int64()), pa.array([r["crowded"] for r in rows], pa.bool_()),
                     pa.array([p >> 8 & 255 for p in places], pa.int32()),
                     pa.array([data[f : f + (p & 255) + cut.length] for f, p in zip(firsts, places)], pa.binary())],
                    ["seg_group", "segment", "n", "crowded", "lead", "bytes"],
                )

    return run


class _Segments:
    """Segments laid out in a byte matrix with all anchors in one column."""

    def __init__(self, leads: np.ndarray, texts: list[bytes], cut: Cut):
        self.cut, self.count = cut, len(texts)
        width = cut.blocks * BLOCK
        self.bytes = np.zeros((self.count, width), dtype=np.uint8)
        self.low = cut.reach - leads
        self.high = np.minimum(self.low + np.array([len(t) for t in texts]), width)
        for i, text in enumerate(texts):
            self.bytes[i, self.low[i] : self.high[i]] = np.frombuffer(text, np.uint8)[: self.high[i] - self.low[i]]

    def symbols(self) -> np.ndarray:
        """Block numbers from 2 on, 1 where a block is not whole, and a closing 0."""
        flat = self.bytes.reshape(-1)
        at = np.arange(0, flat.size, BLOCK)
        hashes = run_hashes(flat, at, at + BLOCK).reshape(self.count, self.cut.blocks)
        edge = np.arange(self.cut.blocks) * BLOCK
        whole = (edge >= self.low[:, None]) & (edge + BLOCK <= self.high[:, None])
        rows = np.zeros((self.count, self.cut.blocks + 1), dtype=np.int64)
        rows[:, :-1][whole] = np.unique(hashes[whole], return_inverse=True)[1] + 2
        rows[:, :-1][~whole] = 1
        return rows

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(segment, column) of every window start."""
        column = np.arange(self.cut.reach + 1)
        return np.nonzero((column >= self.low[:, None]) & (column + self.cut.length <= self.high[:, None]))

    def window_hashes(self, segment: np.ndarray, column: np.ndarray) -> np.ndarray:
        at = segment * self.bytes.shape[1] + column
        return run_hashes(self.bytes.reshape(-1), at, at + self.cut.length)


def repeated_windows(counts: np.ndarray, leads: np.ndarray, texts: list[bytes], cut: Cut) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, column, lowest column) of the windows found twice among whole groups of segments."""
    segments = _Segments(leads, texts, cut)
    rows = segments.symbols()
    shards = [transform(rows[i : i + _SHARD]) for i in range(0, len(rows), _SHARD)]
    interval = merge(shards, rows.shape[1], cut.core).interval.reshape(rows.shape)
    sizes = np.bincount(interval.ravel(), weights=np.repeat(counts, rows.shape[1]))
    segment, column = segments.windows()
    within = interval[segment, -(-column // BLOCK)]
    maybe = sizes[within] >= 2
    segment, column, within = segment[maybe], column[maybe], within[maybe]
    twice = (counts[segment] >= 2) | found_twice(within, segments.window_hashes(segment, column))
    return segment[twice], column[twice], segments.low


def _runs_in(segment: np.ndarray, offset: np.ndarray, count: int) -> tuple[list[list[int]], list[list[int]]]:
    """First and last of every run of consecutive offsets, per segment."""
    lows: list[list[int]] = [[] for _ in range(count)]
    highs: list[list[int]] = [[] for _ in range(count)]
    if len(segment):
        new = np.flatnonzero(np.concatenate(([True], (segment[1:] != segment[:-1]) | (offset[1:] != offset[:-1] + 1))))
        stop = np.concatenate((new[1:] - 1, [len(segment) - 1]))
        for s, a, b in zip(segment[new].tolist(), offset[new].tolist(), offset[stop].tolist()):
            lows[s].append(a)
            highs[s].append(b)
    return lows, highs


def _merged_groups(cut: Cut):
    """Repeated windows of a partition that is sorted by group and segment."""

    def solved(rows: list[tuple]) -> pa.RecordBatch:
        counts, leads = np.array([r[2] for r in rows], np.int64), np.array([r[3] for r in rows], np.int64)
        segment, column, low = repeated_windows(counts, leads, [r[4] for r in rows], cut)
        lows, highs = _runs_in(segment, column - low[segment], len(rows))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array(lows, pa.list_(pa.int32())), pa.array(highs, pa.list_(pa.int32()))],
            ["seg_group", "segment", "lows", "highs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if held and row[:2] == held[-1][:2]:
                    continue  # the same segment from an equal row
                if len(held) >= _BATCH and row[0] != held[-1][0]:
                    yield solved(held)
                    held = []
                held.append(row)
        if held:
            yield solved(held)

    return run


def _window_rows(cut: Cut):
    """(seg_group, segment, n, offset, h1, h2) of every window of crowded groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leads, texts = batch.column(3).to_numpy(), batch.column(4).to_pylist()
            for i in range(0, len(texts), _SHARD):
                part = _Segments(leads[i : i + _SHARD].astype(np.int64), texts[i : i + _SHARD], cut)
                segment, column = part.windows()
                h1 = part.window_hashes(segment, column)
                digest = [hashlib.blake2b(part.bytes[s, c : c + cut.length].tobytes(), digest_size=8).digest() for s, c in zip(segment, column)]
                h2 = np.frombuffer(b"".join(digest), np.int64) if digest else np.zeros(0, np.int64)
                at = pa.array(segment + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), batch.column(2).take(at),
                     pa.array((column - part.low[segment]).astype(np.int32)), _signed(h1), pa.array(h2)],
                    ["seg_group", "segment", "n", "offset", "h1", "h2"],
                )

    return run


def _released(frame: DataFrame) -> DataFrame:
    """``frame``, after the driver has let go of the shuffle files of finished steps."""
    gc.collect()
    frame.sparkSession.sparkContext._jvm.System.gc()
    return frame


def _repeated_segments(keyed: DataFrame, runs: DataFrame, cut: Cut, most_together: int) -> DataFrame:
    """(seg_group, segment, lows, highs) of the segments of mixed groups; offsets from the first window."""
    mixed_runs = runs.where("not same")
    segments = stage(mixed_runs.groupBy("seg_group", "segment").agg(
        F.count("*").alias("n"), F.min(F.struct("doc", "place")).alias("held_by")
    ), "shapes")
    crowds = segments.groupBy("seg_group").agg(F.count("*").alias("shapes")).where(F.col("shapes") > most_together)
    crowds = stage(crowds.select("seg_group", F.lit(True).alias("crowded")), "crowds")
    wanted = segments.join(crowds, "seg_group", "left").withColumn("crowded", F.coalesce("crowded", F.lit(False))).select(
        F.col("held_by.doc").alias("doc"), F.shiftright("held_by.place", 48).alias("tag"),
        F.struct("seg_group", "segment", "n", "crowded", F.col("held_by.place").alias("place")).alias("run"),
    ).groupBy("doc", "tag").agg(F.collect_list("run").alias("runs"))
    fetched = stage(
        keyed.join(wanted, ["doc", "tag"]).select("text", "runs").mapInArrow(
            _segment_rows(cut), "seg_group long, segment long, n long, crowded boolean, lead int, bytes binary"
        ), "segments",
    )
    columns = ["seg_group", "segment", "n", "lead", "bytes"]
    found = fetched.where("not crowded").select(*columns).repartition("seg_group").sortWithinPartitions("seg_group", "segment")
    merged = found.mapInArrow(_merged_groups(cut), "seg_group long, segment long, lows array<int>, highs array<int>")
    windows = fetched.where("crowded").select(*columns).dropDuplicates(["seg_group", "segment"]).mapInArrow(
        _window_rows(cut), "seg_group long, segment long, n long, offset int, h1 long, h2 long"
    )
    twice = windows.groupBy("h1", "h2").agg(F.sum("n").alias("times")).where("times > 1")
    alone = windows.join(twice, ["h1", "h2"]).groupBy("seg_group", "segment").agg(
        F.array_sort(F.collect_list("offset")).alias("lows")
    )
    both = merged.where(F.size("lows") > 0).unionByName(alone.withColumn("highs", F.col("lows")))
    return stage(both, "repeats")


def repeated_spans(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH,
    most_together: int = MOST_TOGETHER,
) -> DataFrame:
    """(doc, tag, pieces): the repeated byte ranges of every row that has some, not yet merged."""
    cut = Cut(length)
    text = F.col(text_column)
    keyed = docs.where(F.octet_length(text) >= length).select(
        _doc(F.col(id_column), text).alias("doc"), _tag_of(text).alias("tag"), text.alias("text")
    )
    runs = keyed.mapInArrow(_run_rows(cut), _RUN)
    groups = runs.groupBy("seg_group").agg(
        F.count("*").alias("n"), (F.min("segment") == F.max("segment")).alias("same")
    ).where("n > 1").select("seg_group", "same")
    groups = stage(groups, "groups")  # read back, it is a join side that leaves the other one free to be split
    runs = _released(stage(runs.join(groups, "seg_group"), "runs"))
    found = _released(_repeated_segments(keyed, runs, cut, most_together))
    row = [F.col("doc"), _tag().alias("tag")]
    whole = runs.where("same").select(*row, _first().alias("low"), (_last() + length).alias("high"))
    partly = runs.where("not same").join(found, ["seg_group", "segment"]).select(
        *row, _first().alias("at"), F.explode(F.arrays_zip("lows", "highs")).alias("run")
    ).select("doc", "tag", (F.col("at") + F.col("run.lows")).alias("low"), (F.col("at") + F.col("run.highs") + length).alias("high"))
    return whole.unionByName(partly).groupBy("doc", "tag").agg(F.collect_set(F.struct("low", "high")).alias("pieces"))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, lows, highs = [], [], []
        for text, pieces in zip(batch.column(1).cast(pa.large_binary()), batch.column(2)):
            data, at, parts, low, high = text.as_py(), 0, [], [], []
            for piece in sorted((p["low"], p["high"]) for p in pieces.as_py() or ()):
                if high and piece[0] <= high[-1]:
                    high[-1] = max(high[-1], piece[1])
                else:
                    low.append(piece[0])
                    high.append(piece[1])
            for a, b in zip(low, high):
                parts.append(data[at:a])
                at = b
            kept.append(b"".join(parts) + data[at:])
            lows.append(low)
            highs.append(high)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(kept, pa.binary()),
             pa.array(lows, pa.list_(pa.int64())), pa.array(highs, pa.list_(pa.int64()))],
            ["id", "text", "kept", "span_starts", "span_ends"],
        )


def without_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH,
    most_together: int = MOST_TOGETHER,
) -> DataFrame:
    """(id, text, kept bytes, span_starts, span_ends) of every row.

    A byte goes if some ``length`` bytes around it start anywhere else too. Null
    texts are empty; texts shorter than ``length`` stay; equal rows repeat each
    other; ids may be null or repeated. Only id and text are read.
    """
    spans = repeated_spans(docs, id_column, text_column, length, most_together)
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    tagged = rows.withColumns({"doc": _doc(F.col("id"), F.col("text")), "tag": _tag_of(F.col("text"))})
    return tagged.join(spans, ["doc", "tag"], "left").select("id", "text", "pieces").mapInArrow(
        _without, f"id {kind}, text string, kept binary, span_starts array<long>, span_ends array<long>"
    )
