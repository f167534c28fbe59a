"""List ranking: sums from every element of a linked list to its end, for lists of any length.

Slices of the list first walk the links that stay inside them: pointer doubling in
numpy joins every element to the end of its local chain. Only the chains' first
elements remain, linked to each other; they are ranked by pointer jumping over joins,
or in one task where they are few. Where links mostly lead to near numbers, that
remainder is a few rows per slice; where they do not, only the speed suffers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parceltide.session import shuffle_width, stage

SLICE_ROWS = 1 << 20  # elements in the memory of one task
MOST_TOGETHER = 200_000  # chains ranked in one task; more of them by joins


def local_chains(at: np.ndarray, to: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For elements ``at`` (ascending) linked to ``to`` (-1: none): last element of the local chain, sums up to it, and
    whether no other local element leads here. ``sums`` has one row per summed column."""
    n = len(at)
    place = np.searchsorted(at, to)
    place[place == n] = 0
    inside = (at[place] == to) & (to >= 0) if n else np.zeros(0, bool)
    jump = np.append(np.where(inside, place, n), n)
    first = np.ones(n + 1, bool)
    first[jump[:n]] = False
    last = np.append(np.arange(n), n)
    sums = np.concatenate((sums, np.zeros((len(sums), 1), sums.dtype)), axis=1)
    while (jump[:n] < n).any():
        going = jump < n
        last = np.where(going, last[jump], last)
        sums = sums + sums[:, jump]
        jump = jump[jump]
    return last[:n], sums[:, :n], first[:n]


def _walk(columns: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        held = pa.Table.from_batches(held)
        at, to, *values = [held.column(k).to_numpy() for k in range(2 + len(columns))]
        order = np.argsort(at, kind="stable")
        at, to = at[order], to[order]
        last, sums, first = local_chains(at, to, np.stack([v[order] for v in values]))
        for low in range(0, len(at), 1 << 16):
            part = slice(low, low + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[part]), pa.array(to[last[part]]), *[pa.array(s[part]) for s in sums], pa.array(first[part])],
                ["at", "to", *columns, "first"],
            )

    return run


def _schema(columns: Sequence[str]) -> str:
    return f"at long, to long, {', '.join(f'{c} long' for c in columns)}, first boolean"


def _jump(links: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Pointer jumping: every round each element adds what its successor has and links to the successor's successor."""
    while links.where("to >= 0").limit(1).count():
        ahead = links.select(F.col("at").alias("_at"), F.col("to").alias("_to"), *[F.col(c).alias(f"_{c}") for c in columns])
        links = stage(links.join(ahead, F.col("to") == F.col("_at"), "left").select(
            "at", F.coalesce("_to", F.lit(-1)).alias("to"),
            *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in columns],
        ), label)
    return links


def sums_to_end(
    links: DataFrame, columns: Sequence[str], slice_rows: int = SLICE_ROWS, most_together: int = MOST_TOGETHER
) -> DataFrame:
    """(at, *columns): the sum of every column from each element to the end of its list, itself included.

    ``links`` has (at, to, *columns) as whole numbers; ``to`` is -1 at an end. Every ``at`` occurs once, at most one
    element leads to it, and there are no circles; several lists are ranked side by side. An empty table gives an
    empty one.
    """
    spark = links.sparkSession
    columns = list(columns)
    slices = max(shuffle_width(spark), -(-links.count() // slice_rows))
    dealt = links.select("at", "to", *columns).repartitionByRange(slices, "at")
    walked = stage(dealt.mapInArrow(_walk(columns), _schema(columns)), "walked")
    chains = walked.where("first").drop("first")
    if chains.count() <= most_together:
        ranked = chains.coalesce(1).mapInArrow(_walk(columns), _schema(columns)).drop("first")
    else:
        ranked = _jump(chains, columns, "jumped")
    beyond = ranked.select(F.col("at").alias("_at"), *[F.col(c).alias(f"_{c}") for c in columns])
    return walked.join(beyond, F.col("to") == F.col("_at"), "left").select(
        "at", *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in columns]
    )
