"""Compression bands: zstandard ratios reject repetitive or incompressible text.

Each whole document and each fixed chunk of it is compressed; the ratio
compressed / raw of the document, and the worst chunk ratios, must lie inside a
band that depends on the length. Short texts never compress well, so their
bands are wide; long texts have enough statistics for narrow ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from parceltide.llm.bytes_math import (
    Joined, byte_table, covered, found_twice, run_hashes, text_chunks, window_hashes,
)

WORD_BYTES = byte_table((0x20, 0x20), (0x09, 0x0D))
SYMBOL_BYTES = ~byte_table(*[(ord(c), ord(c)) for c in "#*$%&|<>"])
_HEAD = byte_table((0x80, 0xBF))  # every byte but UTF-8 continuations


@dataclass(frozen=True)
class Band:
    """Ratio limits for texts of at least ``least`` bytes."""

    least: int
    low: float
    high: float


# Whole documents: below ``low`` repetitive, above ``high`` incompressible.
DOCUMENT_BANDS = (
    Band(0, 0.0, 9.9), Band(64, 0.40, 1.2), Band(256, 0.42, 0.90), Band(1024, 0.40, 0.75), Band(4096, 0.36, 0.65),
    Band(16384, 0.30, 0.60),
)
# Fixed chunks, the last one ending with the text: all have one length. Prose chunks of sf0.1 lie between 0.40 and 0.49;
# random base64 has 0.76. Hex digits have 0.52, too close to prose to be told by their ratio.
CHUNK_BYTES = 4096
CHUNK_BAND = Band(CHUNK_BYTES, 0.25, 0.65)
MOST_BAD_CHUNKS = 0.0

_SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_bytes long, ratio double, worst_low double, worst_high double, n_chunks long, n_bad_chunks long"
)


def _counts(texts: list[bytes], window: int) -> dict[str, np.ndarray]:
    joined = Joined(texts)
    buffer = joined.buffer
    starts, ends = joined.runs(WORD_BYTES)
    owner = joined.owner(starts)
    is_word = WORD_BYTES[buffer]
    letters = np.flatnonzero(is_word & _HEAD[buffer])
    symbols = np.flatnonzero(SYMBOL_BYTES[buffer])

    line_ends = np.flatnonzero(buffer == 10)
    line_starts = np.concatenate(([0], line_ends[:-1] + 1))
    words_before = np.concatenate(([0], np.cumsum(is_word)))
    full = words_before[line_ends] > words_before[line_starts]
    line_starts, line_ends = line_starts[full], line_ends[full]
    line_owner = joined.owner(line_starts)
    hashes = run_hashes(buffer, line_starts, line_ends)
    _, first = np.unique(np.stack((line_owner.astype(np.uint64), hashes), axis=1), axis=0, return_index=True)
    later = np.ones(len(hashes), dtype=bool)
    later[first] = False

    words = run_hashes(buffer, starts, ends)
    windows = window_hashes(words, window)
    inside = np.flatnonzero(owner[: len(windows)] == owner[window - 1 :]) if len(windows) else np.zeros(0, np.int64)
    twice = found_twice(owner[inside], windows[inside])
    repeated = np.flatnonzero(covered(inside[twice], window, len(words)))
    return {
        "n_words": joined.per_text(owner),
        "word_chars": joined.per_text(joined.owner(letters)),
        "n_symbols": joined.per_text(joined.owner(symbols)),
        "n_dup_lines": joined.per_text(line_owner[later]),
        "n_repeat_words": joined.per_text(owner[repeated]),
    }


def _ratios(text: bytes, packer: zstandard.ZstdCompressor) -> tuple[float, float, float, int, int]:
    if not text:
        return 1.0, 1.0, 1.0, 0, 0
    whole = len(packer.compress(text)) / len(text)
    starts = list(range(0, len(text) - CHUNK_BYTES + 1, CHUNK_BYTES))
    if starts and len(text) % CHUNK_BYTES:
        starts.append(len(text) - CHUNK_BYTES)
    chunks = [len(packer.compress(text[i : i + CHUNK_BYTES])) / CHUNK_BYTES for i in starts]
    bad = sum(not CHUNK_BAND.low <= c <= CHUNK_BAND.high for c in chunks)
    return whole, min(chunks, default=whole), max(chunks, default=whole), len(chunks), bad


def _measure(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for first, texts in text_chunks(batch.column(1)):
                counts = _counts(texts, window)
                ratios = [_ratios(t, packer) for t in texts]
                arrays = [batch.column(0).slice(first, len(texts)), *map(pa.array, counts.values())]
                arrays.append(pa.array([len(t) for t in texts], pa.int64()))
                arrays += [pa.array([r[k] for r in ratios], pa.float64()) for k in range(3)]
                arrays += [pa.array([r[k] for r in ratios], pa.int64()) for k in (3, 4)]
                yield pa.RecordBatch.from_arrays(arrays, ["id", *(f.split()[0] for f in _SCHEMA.split(", "))])

    return run


def text_measures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = 8) -> DataFrame:
    """Word, symbol, repetition and compression measures of every row, as columns beside ``id``.

    Null and empty texts have zero counts and a ratio of 1. Rows are judged one
    by one, so repeated rows and null ids simply give one result each; other
    columns are not read.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(
        _measure(window), f"id {kind}, {_SCHEMA}"
    )


def in_band(length: F.Column, ratio: F.Column, bands: tuple[Band, ...] = DOCUMENT_BANDS):
    """Whether a ratio lies in the band of its length; bands ascend by ``least``."""
    verdict = F.lit(True)
    for band in bands:
        verdict = F.when(length >= band.least, ratio.between(band.low, band.high)).otherwise(verdict)
    return verdict


def quality_verdicts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``text_measures`` plus ``repetitive``, ``incompressible`` and ``band_ok``.

    A document fails when its own ratio leaves the band of its length or when
    more than the share ``MOST_BAD_CHUNKS`` of its chunks leaves the chunk band.
    """
    m = text_measures(docs, id_column, text_column)
    whole = in_band(F.col("n_bytes"), F.col("ratio"))
    chunks = F.col("n_bad_chunks") <= MOST_BAD_CHUNKS * F.col("n_chunks")
    return m.withColumn("band_ok", whole & chunks)
