"""Benchmark decontamination with a broadcast set of normalised n-grams.

The windows of the benchmark are distinct rows of one Spark table. They are sent
to the tasks as a sorted hash array with the window words beside it, as long as
their number stays below ``most_windows``; a larger benchmark is sent in several
such portions, each of which scans the documents once. Every hash hit is
verified on the words themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parceltide.llm.bytes_math import (
    Joined, byte_table, covered, lower_ascii, run_hashes, text_chunks, window_hashes,
)
from parceltide.session import stage

# Bytes of a word after A-Z are lower-cased: digits, a-z and everything beyond ASCII.
WORD_BYTES = byte_table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
WINDOW_WORDS = 10
MOST_WINDOWS = 2_000_000  # one portion: some 150 MB of words and hashes


def _words(texts: list[bytes]):
    joined = Joined(texts)
    joined.buffer = lower_ascii(joined.buffer)
    starts, ends = joined.runs(WORD_BYTES)
    return joined, starts, ends


def _item_windows(size: int):
    """(item, n words, window hash, window words) rows of benchmark texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_chunks(batch.column(1)):
                joined, starts, ends = _words(texts)
                hashes, owner = run_hashes(joined.buffer, starts, ends), joined.owner(starts)
                raw = joined.buffer.tobytes()
                items, counts, keys, values = [], [], [], []
                for i in range(joined.count):
                    low, high = np.searchsorted(owner, (i, i + 1))
                    n = min(size, high - low)
                    if not n:
                        continue
                    words = [raw[a:b] for a, b in zip(starts[low:high], ends[low:high])]
                    found = window_hashes(hashes[low:high], n)
                    keys += found.view(np.int64).tolist()
                    values += [b" ".join(words[k : k + n]).decode() for k in range(len(found))]
                    items += batch.column(0).slice(first + i, 1).to_pylist() * len(found)
                    counts += [int(n)] * len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items, batch.column(0).type), pa.array(counts, pa.int32()),
                     pa.array(keys, pa.int64()), pa.array(values, pa.string())],
                    ["item", "n", "hash", "words"],
                )

    return run


def benchmark_windows(
    items: DataFrame, id_column: str = "item_id", text_column: str = "text", size: int = WINDOW_WORDS
) -> DataFrame:
    """Distinct windows: n, hash, words and the ids of the items that hold them.

    An item with fewer words than ``size`` is one window of its own length; an
    item without words has none. Null ids are kept as the text ``null``.
    """
    kind = items.schema[id_column].dataType.simpleString()
    rows = items.select(F.col(id_column).alias("item"), F.col(text_column).alias("text")).mapInArrow(
        _item_windows(size), f"item {kind}, n int, hash long, words string"
    )
    named = F.coalesce(F.col("item").cast("string"), F.lit("null"))
    return rows.groupBy("n", "hash", "words").agg(F.collect_set(named).alias("items"))


class WindowSet:
    """A portion of the windows as the tasks hold it."""

    def __init__(self, rows):
        rows = sorted(rows, key=lambda r: (r["n"], r["hash"]))
        self.items = sorted({i for r in rows for i in r["items"]})
        index = {item: k for k, item in enumerate(self.items)}
        self.words: dict[tuple[int, int], list[tuple[bytes, list[int]]]] = {}
        for r in rows:
            entry = (r["words"].encode(), [index[i] for i in r["items"]])
            self.words.setdefault((r["n"], r["hash"]), []).append(entry)
        self.hashes = {
            n: np.unique(np.array([r["hash"] for r in rows if r["n"] == n], dtype=np.int64).view(np.uint64))
            for n in {r["n"] for r in rows}
        }

    def hits(self, texts: list[bytes]):
        """Joined chunk, word borders, verified (first word, length, items) hits."""
        joined, starts, ends = _words(texts)
        words, owner = run_hashes(joined.buffer, starts, ends), joined.owner(starts)
        raw, found = None, []
        for n, wanted in self.hashes.items():
            windows = window_hashes(words, n)
            if not len(windows):
                continue
            at = np.searchsorted(wanted, windows)
            at[at == len(wanted)] = 0
            maybe = np.flatnonzero((wanted[at] == windows) & (owner[: len(windows)] == owner[n - 1 :]))
            raw = joined.buffer.tobytes() if raw is None and len(maybe) else raw
            for i in maybe.tolist():
                text = b" ".join(raw[a:b] for a, b in zip(starts[i : i + n], ends[i : i + n]))
                for known, items in self.words[n, int(windows[i : i + 1].view(np.int64)[0])]:
                    if known == text:
                        found.append((i, n, items))
        return joined, starts, ends, owner, found


_SCHEMA = "n_words long, item_ids array<string>, span_starts array<int>, span_ends array<int>, word_starts array<int>, word_ends array<int>"


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: WindowSet = shared.value
        for batch in batches:
            for first, texts in text_chunks(batch.column(1)):
                joined, starts, ends, owner, found = known.hits(texts)
                n_words = joined.per_text(owner)
                first_word = np.searchsorted(owner, np.arange(joined.count))
                items = [set() for _ in texts]
                for i, _, which in found:
                    items[owner[i]].update(which)
                hit = covered(
                    np.array([f[0] for f in found], np.int64), np.array([f[1] for f in found], np.int64), len(starts)
                )
                spans = [([], [], [], []) for _ in texts]
                flags = np.zeros(len(hit) + 2, np.int8)
                flags[1:-1] = hit
                steps = np.diff(flags)
                lows, highs = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
                for low, high in zip(lows.tolist(), highs.tolist()):
                    # a run of hit words may go on into the next text of the chunk
                    while low < high:
                        doc = int(owner[low])
                        stop = min(high, int(first_word[doc] + n_words[doc]))
                        base = joined.starts[doc]
                        for column, value in zip(spans[doc], (
                            starts[low] - base, ends[stop - 1] - base, low - first_word[doc], stop - first_word[doc],
                        )):
                            column.append(int(value))
                        low = stop
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), batch.column(1).slice(first, len(texts)),
                     pa.array(n_words),
                     pa.array([[known.items[k] for k in sorted(s)] for s in items], pa.list_(pa.string())),
                     *(pa.array([s[k] for s in spans], pa.list_(pa.int32())) for k in range(4))],
                    ["id", "text", *(f.split()[0] for f in _SCHEMA.split(", "))],
                )

    return run


def _portions(windows: DataFrame, most: int) -> list[list]:
    """The windows as row lists of at most about ``most`` entries, by hash range."""
    stored = stage(windows, "windows")
    count = stored.count()
    parts = max(1, -(-count // most))
    return [
        stored.where(F.pmod("hash", F.lit(parts)) == k).toLocalIterator() if parts > 1 else stored.collect()
        for k in range(parts)
    ]


def contamination(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_id: str = "item_id", item_text: str = "text", size: int = WINDOW_WORDS, most_windows: int = MOST_WINDOWS,
) -> DataFrame:
    """Per document: id, text, n_words, item_ids and the hit spans (bytes and words).

    Null texts have no words; repeated rows give one result each. Only id and
    text are read. An empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()
    narrow = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    windows = benchmark_windows(items, item_id, item_text, size)
    scans = []
    for rows in _portions(windows, most_windows):
        shared = spark.sparkContext.broadcast(WindowSet(rows))
        scans.append(narrow.mapInArrow(_scan(shared), f"id {kind}, text string, {_SCHEMA}"))
    if len(scans) == 1:
        return scans[0]
    return _merged(scans)


def _merged(scans: list[DataFrame]) -> DataFrame:
    """Union of the hits of several portions, per document row.

    Rows with equal id and text have equal hits, so they are merged as one and
    given back as often as they came.
    """
    key = ["id", "text", "n_words"]
    spans = F.arrays_zip("span_starts", "span_ends", "word_starts", "word_ends")
    rows = reduce(DataFrame.unionByName, [s.withColumn("part", F.lit(k)) for k, s in enumerate(scans)])
    merged = rows.groupBy(*key).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(spans)))).alias("spans"),
        F.count_if(F.col("part") == 0).alias("copies"),
    )
    # Overlapping or touching runs of hit words become one run again.
    joined = F.aggregate(
        "spans", F.array().cast("array<struct<span_starts:int,span_ends:int,word_starts:int,word_ends:int>>"),
        lambda out, s: F.when(
            (F.size(out) > 0) & (F.try_element_at(out, F.lit(-1))["word_ends"] >= s["word_starts"]),
            F.concat(
                F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0))),
                F.array(F.struct(
                    F.try_element_at(out, F.lit(-1))["span_starts"].alias("span_starts"),
                    F.greatest(F.try_element_at(out, F.lit(-1))["span_ends"], s["span_ends"]).alias("span_ends"),
                    F.try_element_at(out, F.lit(-1))["word_starts"].alias("word_starts"),
                    F.greatest(F.try_element_at(out, F.lit(-1))["word_ends"], s["word_ends"]).alias("word_ends"),
                )),
            ),
        ).otherwise(F.concat(out, F.array(s))),
    )
    return (
        merged.withColumn("spans", joined)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select(*key, "item_ids", *[F.col(f"spans.{c}").alias(c) for c in ("span_starts", "span_ends", "word_starts", "word_ends")])
    )


def n_hit_words() -> F.Column:
    return F.aggregate(
        F.zip_with("word_starts", "word_ends", lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x
    )


def without_contaminated(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no benchmark window.

    Decisions join back on (id, text hash), so null and repeated ids are safe.
    """
    id_column, text_column = names.get("id_column", "doc_id"), names.get("text_column", "text")
    bad = (
        contamination(docs, items, **names).where(F.size("item_ids") > 0)
        .select(F.col("id").alias("_bad_id"), F.xxhash64("text").alias("_bad_text")).distinct()
    )
    return docs.join(
        bad, docs[id_column].eqNullSafe(F.col("_bad_id")) & (F.xxhash64(docs[text_column]) == F.col("_bad_text")), "left_anti"
    )


def digest(ids: list[str]) -> str:
    return hashlib.sha256(",".join(ids).encode()).hexdigest()
