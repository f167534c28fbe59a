"""Mixing sources to target weights by temperature.

Token shares of the sources are raised to an exponent and normalised. The
exponent is the largest one, at most 1, whose weights reach a target entropy, or
the smallest whose weights repeat no source more often than allowed. It is
bracketed again and again with a handful of exponents per pass, each pass one
aggregate over the table of sources. The weights are then realised: a source with
budget B reads its documents in permuted order, block after block, as often as B
asks for, and the last round stops at B.

All of it is DataFrame work. A source is cut into blocks by a hash of its rows,
so that a source with a third of all rows is many small permutations, and only
the table of blocks is summed up per source.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from parceltide.operators.ranking import running_totals
from parceltide.session import stage


@dataclass(frozen=True)
class Mix:
    """What the weights must meet.

    ``entropy``: at least this share of log(number of sources); ``most_repeats``:
    no source is read more often than this; ``keep_all``: the budget is what the
    most over-represented source needs to be read once, so no document is left
    out; else it is ``budget`` tokens, or the tokens there are.
    """

    entropy: float | None = None
    most_repeats: float | None = None
    keep_all: bool = False
    budget: float | None = None
    block_tokens: int = 1_000_000
    block_rows: int = 50_000
    seed: int = 17


_STEPS, _AT_ONCE = 7, 16  # the exponent is found to 16^-7


def token_count(text: Column) -> Column:
    """Words between ASCII blanks; null and empty texts have none."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).cast("long")


def source_shares(rows: DataFrame) -> DataFrame:
    """(source, tokens, share) of the sources that have tokens; a null source is one of its own."""
    sums = rows.groupBy("source").agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    stored = stage(sums, "sources")
    total = stored.agg(F.sum("tokens")).first()[0] or 1
    return stored.withColumn("share", F.col("tokens") / F.lit(float(total)))


def _figures(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """(entropy, largest weight / share, smallest weight / share) of the weights under each exponent."""
    columns = []
    for k, a in enumerate(exponents):
        p = F.pow("share", F.lit(a))
        columns += [F.sum(p).alias(f"z{k}"), F.sum(p * F.log(p)).alias(f"e{k}"),
                    F.max(p / F.col("share")).alias(f"h{k}"), F.min(p / F.col("share")).alias(f"l{k}")]
    row = shares.agg(*columns).first()
    return [
        (math.log(row[f"z{k}"]) - row[f"e{k}"] / row[f"z{k}"], row[f"h{k}"] / row[f"z{k}"], row[f"l{k}"] / row[f"z{k}"])
        for k in range(len(exponents))
    ]


def find_exponent(shares: DataFrame, mix: Mix) -> float:
    """The exponent in [0, 1]; entropy falls as it grows, and so do repetitions.

    With an entropy target, the largest exponent that reaches it; with a
    repetition limit, raised as far as that limit needs. 1 without either, and
    for tables of one source.
    """
    count, tokens = shares.agg(F.count("*"), F.sum("tokens")).first()
    if not count:
        return 1.0
    budget = mix.budget or float(tokens)

    def repeats(figure: tuple[float, float, float]) -> float:
        return figure[1] / figure[2] if mix.keep_all else figure[1] * budget / tokens

    def bracket(fits_above, low: float, high: float) -> tuple[float, float]:
        """Narrow [low, high] so that ``fits_above`` is false at low and true at high, by 16 inner points a pass."""
        for _ in range(_STEPS):
            points = [low + (high - low) * k / _AT_ONCE for k in range(_AT_ONCE + 1)]
            first = next((k for k, f in enumerate(_figures(shares, points)) if fits_above(f)), _AT_ONCE)
            low, high = points[max(0, first - 1)], points[first]
        return low, high

    exponent = 1.0
    if mix.entropy is not None:
        target = mix.entropy * math.log(count)
        if _figures(shares, [1.0])[0][0] < target:
            exponent = bracket(lambda f: f[0] < target, 0.0, 1.0)[0]
    if mix.most_repeats is not None:
        limit = mix.most_repeats * (1 + 1e-12)
        if repeats(_figures(shares, [exponent])[0]) > limit:
            exponent = bracket(lambda f: repeats(f) <= limit, exponent, 1.0)[1]
    return exponent


def source_plan(shares: DataFrame, mix: Mix) -> DataFrame:
    """(source, tokens, weight, budget): what each source is to give, in whole tokens."""
    exponent = find_exponent(shares, mix)
    count, tokens = shares.agg(F.count("*"), F.sum("tokens")).first()
    if not count:
        return shares.select("source", "tokens", F.col("share").alias("weight"), F.col("tokens").alias("budget"))
    raised = F.pow("share", F.lit(exponent))
    total, least = shares.agg(F.sum(raised), F.min(raised / F.col("share"))).first()
    budget = tokens * total / least if mix.keep_all else (mix.budget or float(tokens))
    weight = raised / F.lit(total)
    # Twelve digits hide the rounding of the sums, so that a budget equal to the tokens stays equal.
    return shares.select("source", "tokens", weight.alias("weight"), F.ceil(F.round(weight * F.lit(float(budget)), 6)).alias("budget"))


def mixed_rows(
    docs: DataFrame, mix: Mix, source_column: str = "source", id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs``, all columns, plus ``mix_round``, ``mix_block`` and ``mix_weight``: one row per reading.

    Reading order is (mix_round, mix_block, hash order in the block); a source
    stops with the document that reaches its budget. Equal rows are told apart by
    nothing but their place, so they count one by one. Documents without tokens,
    and sources without any, are read once. Columns of ``docs`` with the names of
    the three new ones are left out.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    key = F.xxhash64(F.col(source_column).isNull(), F.col(source_column))  # of the source; never null
    row_hash = F.xxhash64(F.col(id_column), F.col(text_column))
    base = docs.select(whole, key.alias("key"), row_hash.alias("hash"))
    narrow = docs.select(
        key.alias("key"), row_hash.alias("hash"), F.col(source_column).alias("source"), token_count(F.col(text_column)).alias("tokens")
    )
    lumps = stage(  # equal rows combine before the shuffle
        narrow.groupBy("key", "source", "hash").agg(F.max("tokens").alias("each"), F.count("*").alias("copies"))
        .withColumn("tokens", F.col("each") * F.col("copies")), "mixkeys",
    )
    plan = source_plan(source_shares(lumps), mix).select(
        F.xxhash64(F.col("source").isNull(), F.col("source")).alias("key"), F.col("tokens").alias("all"), "weight", "budget"
    )
    # stored, so that the planner knows its size and sends it to the rows instead of dealing these out by source
    numbers = stage(lumps.groupBy("key").agg(F.count("*").alias("n")).join(plan, "key", "left"), "mixsources")
    # a block holds about ``block_tokens`` and ``block_rows``; its place in the permutation is its hashed number
    many = F.greatest(
        F.ceil(F.coalesce("all", F.lit(0)) / F.lit(mix.block_tokens)), F.ceil(F.col("n") / F.lit(mix.block_rows)), F.lit(1)
    ).cast("long")
    placed = stage(
        lumps.drop("source").join(numbers, "key").withColumn("block", F.pmod(F.xxhash64(F.lit(mix.seed), "hash"), many)).drop("n"),
        "mixblocks",
    )
    sums = placed.groupBy("key", "block").agg(F.sum("tokens").alias("in_block"))
    starts = running_totals(
        sums.withColumn("turn", F.xxhash64(F.lit(mix.seed), "block")), [F.col("turn"), F.col("block")], {"upto": "in_block"}, ["key"]
    ).select("key", "block", (F.col("upto") - F.col("in_block")).alias("before"))
    inside = Window.partitionBy("key", "block").orderBy(F.xxhash64(F.lit(mix.seed + 1), "hash"), "hash").rowsBetween(
        Window.unboundedPreceding, -1
    )
    at = placed.withColumn("ahead", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(starts, ["key", "block"])
    # A copy is read in round r if the tokens before it, r whole passes included, are below the budget: the first
    # ``full`` copies of a lump come in ``rounds`` rounds, the others in one less.
    free = F.col("budget") - F.col("before") - F.col("ahead")
    once = (F.col("each") == 0) | F.col("budget").isNull()
    rounds = F.when(once, 1).otherwise(F.greatest(F.ceil(free / F.col("all")), F.lit(0))).cast("int")
    left = free - (F.col("rounds") - 1) * F.col("all")
    full = F.when(once, F.col("copies")).otherwise(F.least(F.ceil(left / F.col("each")), F.col("copies")))
    chosen = stage(at.withColumn("rounds", rounds).where("rounds > 0").withColumn("full", full.cast("long")).select(
        "key", "hash", "rounds", "full", "copies", F.col("block").alias("mix_block"), F.col("weight").alias("mix_weight")
    ), "mixchosen")
    cut = F.col("full") < F.col("copies")  # at most one lump per source
    found = base.join(chosen.where(~cut), ["key", "hash"]).select("row", "rounds", "mix_block", "mix_weight")
    if chosen.where(cut).limit(1).count():
        parts = stage(base.join(chosen.where(cut), ["key", "hash"]).withColumn("place", F.monotonically_increasing_id()), "mixcut")
        nth = running_totals(
            parts.select("key", "hash", "place", F.lit(1).alias("one")), [F.col("place")], {"nth": "one"}, ["key", "hash"]
        )
        counted = parts.join(nth.select("place", "nth"), "place").withColumn(
            "rounds", F.when(F.col("nth") <= F.col("full"), F.col("rounds")).otherwise(F.col("rounds") - 1)
        ).where("rounds > 0")
        found = found.unionByName(counted.select(*found.columns))
    new = ("mix_round", "mix_block", "mix_weight")
    return found.select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c not in new],
        F.explode(F.sequence(F.lit(0), F.col("rounds") - 1)).alias("mix_round"), "mix_block", "mix_weight",
    )
