"""Line dedup: sorted hash ranges, streamed once, give keep bitmaps.

Every long enough line becomes one row (key hash, document, position). The rows
are range-partitioned on all of these, so a line that fills a third of the table
is spread over many ranges, and sorted with the largest document first. Each
range is streamed: the first document of a key keeps its lines, a second one
waits, and from the third on lines are dropped. Only the first and the last key
of a range can go on in a neighbour; they are settled from a table with at most
two rows per range. The result is a compressed bitmap per changed document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from parceltide.session import shuffle_width, stage

LEAST_CHARS, LEAST_DOCS = 20, 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_DROPPED, _OPEN, _SUMMARY = 0, 1, 2


def line_rows(docs: DataFrame, id_column: str, text_column: str, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc, row, n_lines, pos, h1, h2): one row per line whose key is long enough.

    ``row`` tells rows of one id apart by their text; equal rows need no telling.
    """
    lines = docs.select(
        F.col(id_column).alias("doc"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    ).select("doc", F.xxhash64("text").alias("row"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    white = F.lit(" \t\n\x0b\f\r")
    key = F.translate(F.trim(F.col("line"), white), _UPPER, _LOWER)
    return lines.select("doc", "row", "pos", key.alias("key")).where(F.char_length("key") >= least_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "row", "pos"
    )


class _Stream:
    """Follows one sorted range and says which rows go."""

    def __init__(self, least_docs: int):
        self.least, self.key, self.doc = least_docs, None, None
        self.rank, self.first, self.runs = 0, None, 0
        self.waiting: list[tuple] = []

    def feed(self, h1, h2, docs, rows, positions, out: list[tuple]) -> None:
        for entry in zip(h1, h2, docs, rows, positions):
            key, doc = entry[:2], entry[2]
            if key != self.key:
                self.close(out, last=False)
                self.key, self.doc, self.first, self.rank = key, doc, doc, 1
            elif doc != self.doc:
                self.doc, self.rank = doc, self.rank + 1
                if self.rank == self.least:
                    out += [(_DROPPED, *w) for w in self.waiting]
                    self.waiting = []
            if self.runs == 1:  # the first key of the range: its earlier part may lie elsewhere
                out.append((_OPEN, *entry))
            elif self.rank >= self.least:
                out.append((_DROPPED, *entry))
            elif self.rank > 1:
                self.waiting.append(entry)

    def close(self, out: list[tuple], last: bool) -> None:
        if self.key is not None and (self.runs == 1 or last):
            out += [(_OPEN, *w) for w in self.waiting if self.runs > 1]
            out.append((_SUMMARY, *self.key, self.first, self.doc, self.rank))
        self.waiting = []
        self.runs += 1


def _stream(least_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, part, kind = _Stream(least_docs), TaskContext.get().partitionId(), pa.int64()

        def packed(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[]] * 6
            types = [pa.int32(), pa.int64(), pa.int64(), kind, pa.int64(), pa.int64()]
            # a summary carries the last document in ``row`` and the rank in ``pos``
            arrays = [pa.array([None if v is None else v for v in c], t) for c, t in zip(columns, types)]
            return pa.RecordBatch.from_arrays(
                [*arrays, pa.array([part] * len(out), pa.int32())], ["what", "h1", "h2", "doc", "row", "pos", "part"]
            )

        for batch in batches:
            out: list[tuple] = []
            state.feed(*(batch.column(k).to_pylist() for k in range(5)), out)
            yield packed(out)
        out = []
        state.close(out, last=True)
        yield packed(out)

    return run


def dropped_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """(doc, row, pos) of every line that goes.

    Ids are whole numbers; a null id counts as one document below all others,
    and rows of the same id are one document.
    """
    rows = stage(  # the texts are read once, not again for the borders of the ranges
        line_rows(docs, id_column, text_column, least_chars).withColumn("doc", F.col("doc").cast("long")), "linerows"
    )
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc_nulls_last(), F.col("row"), F.col("pos")]
    ranged = rows.repartitionByRange(shuffle_width(docs.sparkSession), *order).sortWithinPartitions(*order)
    seen = stage(ranged.mapInArrow(_stream(least_docs), "what int, h1 long, h2 long, doc long, row long, pos long, part int"), "lines")

    along = Window.partitionBy("h1", "h2").orderBy("part")
    borders = seen.where(F.col("what") == _SUMMARY).select("h1", "h2", "part", "doc", F.col("row").alias("last_doc"), "pos")
    # a document that ends one range and starts the next counts once
    again = F.lag("part").over(along).isNotNull() & F.lag("last_doc").over(along).eqNullSafe(F.col("doc"))
    settled = (
        borders.withColumn("n", F.col("pos") - F.when(again, 1).otherwise(0))
        .groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("doc").alias("keeper")).where(F.col("n") >= least_docs)
    )
    late = (
        seen.where(F.col("what") == _OPEN).join(F.broadcast(settled), ["h1", "h2"])  # at most two rows per range
        .where(~F.col("doc").eqNullSafe(F.col("keeper")))
    )
    gone = seen.where(F.col("what") == _DROPPED).unionByName(late.select(*seen.columns))
    return gone.select("doc", "row", F.col("pos").cast("int").alias("pos")).distinct()


@F.pandas_udf(T.BinaryType())
def packed_bitmap(n_lines: pd.Series, gone: pd.Series) -> pd.Series:
    """One bit per line, set where the line stays, deflated."""

    def pack(n, positions):
        keep = np.ones(int(n), dtype=bool)
        keep[np.asarray(positions, dtype=np.int64)] = False
        return zlib.compress(np.packbits(keep).tobytes(), 6)

    return pd.Series([pack(n, p) for n, p in zip(n_lines, gone)], dtype=object)


@F.pandas_udf(T.StringType())
def kept_text(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    """The lines whose bit is set, joined; without a bitmap the text itself."""

    def apply(value, bits):
        value = value or ""
        if bits is None:
            return value
        lines = value.split("\n")
        keep = np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8), count=len(lines))
        return "\n".join(line for line, k in zip(lines, keep) if k)

    return pd.Series([apply(t, b) for t, b in zip(text, bitmap)], dtype=object)


def with_bitmaps(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **limits) -> DataFrame:
    """``docs`` plus ``_n_lines``, ``_n_dropped`` and ``_keep`` (null: every line stays).

    Null and empty texts are one empty line. All columns of ``docs`` stay but those with the names of the new ones.
    """
    gone = dropped_lines(docs, id_column, text_column, **limits).groupBy("doc", "row").agg(F.collect_list("pos").alias("gone"))
    text = F.coalesce(F.col(text_column), F.lit(""))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("all"), F.col(id_column).cast("long").alias("id"),
        F.xxhash64(text).alias("hash"), F.size(F.split(text, "\n", -1)).cast("long").alias("n_lines"),
    )
    joined = keyed.join(gone, F.col("id").eqNullSafe(F.col("doc")) & (F.col("hash") == F.col("row")), "left")
    new = ("_n_lines", "_n_dropped", "_keep")
    return joined.select(
        *[F.col("all")[c].alias(c) for c in docs.columns if c not in new], F.col("n_lines").alias("_n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("_n_dropped"),
        F.when(F.col("gone").isNotNull(), packed_bitmap("n_lines", F.coalesce("gone", F.array().cast("array<int>")))).alias("_keep"),
    )
