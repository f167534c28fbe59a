"""Secret scans: fixed patterns and sliding-window entropy, as SQL expressions.

Positions come from splitting a text at a pattern: the lengths of the pieces and
of the matches, summed up, give every start. Candidate strings are then read once
per character class with a window whose letter counts, and the sum of c log2 c,
change by one letter in and one out; both are whole numbers, so results do not
depend on the order of the additions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

# Kinds in their order, pattern, counted group and its least length.
BASE_KINDS = (
    ("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
# The same matches with the failing ones left out by the pattern itself. A run of one character class ends where it
# ends, so a length asked of the pattern drops just the runs that are too short; ``assign`` has no such form.
_LONG_ENOUGH = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}
WINDOW = 20
_SCALE = 1_000_000


@dataclass(frozen=True)
class CharacterClass:
    """Candidates of one alphabet; a window counts at ``least_bits`` of entropy a character."""

    name: str
    alphabet: str
    least_bits: float


CLASSES = (
    CharacterClass("hex", "0123456789abcdefABCDEF", 2.9),
    CharacterClass("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.75),
)
# Candidates that fit one of these are never reported by their entropy: words, plain numbers, dotted or dashed names,
# paths, runs of the alphabet and marked examples.
ALLOW_LIST = (
    r"^[A-Za-z]+$", r"^[0-9+=/_-]+$", r"^[A-Za-z]+([-_/=+][A-Za-z]+)+$", r"(?i)example|placeholder|x{6}|dummy",
    r"(?i)abcdefghij|0123456789", r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
)
_SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"


def _spans(text: Column, pattern: str, kind: str, rank: int, group: int = 0, least: int = 0) -> Column:
    """All matches as (start, rank, kind, end), without those whose group is shorter than ``least``."""
    regex = F.lit(pattern)
    found = F.regexp_extract_all(text, regex, F.lit(0))
    tested = F.regexp_extract_all(text, regex, F.lit(group)) if group else found
    both = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("found"), tested.alias("tested"))
    empty = F.array().cast(_SPAN)

    def step(state: Column, m: Column) -> Column:
        start = state["at"] + F.char_length(m["gap"])
        end = start + F.coalesce(F.char_length(m["found"]), F.lit(0))
        fits = m["found"].isNotNull() & (F.char_length(m["tested"]) >= least)
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(fits, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

    folded = F.aggregate(both, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda s: s["out"])
    return F.when(F.size(found) > 0, folded).otherwise(empty)


def base_spans(text: Column) -> list[Column]:
    """One span array per base kind."""
    out = []
    for rank, (kind, pattern, group, least) in enumerate(BASE_KINDS):
        out.append(_spans(text, _LONG_ENOUGH.get(kind, pattern), kind, rank, group, least))
    return out


def _weight(count: int) -> int:
    return round(count * math.log2(count) * _SCALE) if count else 0


def high_entropy_runs(candidate: Column, alphabet: str, least_bits: float, window: int = WINDOW) -> Column:
    """Maximal (start, end) stretches of ``candidate`` covered by windows of enough entropy."""
    weights = F.array(*[F.lit(_weight(c)) for c in range(window + 1)])
    # entropy = log2(window) - sum(c log2 c) / window
    most = math.floor((math.log2(window) - least_bits) * window * _SCALE)
    letters = F.transform(F.filter(F.split(candidate, ""), lambda c: c != ""), lambda c: F.instr(F.lit(alphabet), c))
    none = F.array().cast("array<struct<start:int,end:int>>")
    start_state = F.struct(
        F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0).alias("weight"), none.alias("runs"),
        letters.alias("letters"),
    )

    def step(state: Column, at: Column) -> Column:
        new = F.element_at(state["letters"], at)
        old = F.when(at > window, F.element_at(state["letters"], F.greatest(at - window, F.lit(1)))).otherwise(F.lit(0))
        came = F.element_at(state["counts"], new)
        gone = F.when(old > 0, F.element_at(state["counts"], F.greatest(old, F.lit(1)))).otherwise(F.lit(0))
        change = F.when(new == old, F.lit(0)).otherwise(
            F.element_at(weights, came + 2) - F.element_at(weights, came + 1)
            + F.when(old > 0, F.element_at(weights, F.greatest(gone, F.lit(1))) - F.element_at(weights, gone + 1)).otherwise(0)
        )
        weight = state["weight"] + change
        counts = F.when(new == old, state["counts"]).otherwise(F.transform(
            state["counts"], lambda c, k: c + F.when(k == new - 1, 1).when(k == old - 1, -1).otherwise(0)
        ))
        fits = (at >= window) & (weight <= most)
        run = F.struct((at - window).alias("start"), at.alias("end"))
        last = F.try_element_at(state["runs"], F.lit(-1))
        longer = F.concat(
            F.slice(state["runs"], F.lit(1), F.greatest(F.size(state["runs"]) - 1, F.lit(0))),
            F.array(F.struct(last["start"].alias("start"), at.alias("end"))),
        )
        runs = F.when(~fits, state["runs"]).when(
            (F.size(state["runs"]) > 0) & (last["end"] >= at - window), longer
        ).otherwise(F.concat(state["runs"], F.array(run)))
        return F.struct(counts.alias("counts"), weight.alias("weight"), runs.alias("runs"), state["letters"].alias("letters"))

    return F.aggregate(F.sequence(F.lit(1), F.char_length(candidate)), start_state, step, lambda s: s["runs"])


def _entropy_part(text: Column, kind: CharacterClass, span: Column) -> Column:
    """The high-entropy stretches of one candidate, none if it is allow-listed."""
    rank = len(BASE_KINDS)
    candidate = F.substring(text, span["start"] + 1, span["end"] - span["start"])
    listed = F.lit(False)
    for allowed in ALLOW_LIST:
        listed = listed | candidate.rlike(allowed)
    stretches = F.transform(
        high_entropy_runs(candidate, kind.alphabet, kind.least_bits),
        lambda r: F.struct(
            (span["start"] + r["start"]).alias("start"), F.lit(rank).alias("rank"),
            F.lit("entropy").alias("kind"), (span["start"] + r["end"]).alias("end"),
        ),
    )
    return F.when(listed, F.array().cast(_SPAN)).otherwise(stretches)


def entropy_spans(text: Column) -> Column:
    """Spans of kind ``entropy``: high-entropy stretches of candidates outside the allow-list."""
    parts = []
    for kind in CLASSES:
        dash = "-" if "-" in kind.alphabet else ""  # last in a class, where it stands for itself
        pattern = f"[{kind.alphabet.replace('-', '')}{dash}]{{{WINDOW},}}"
        found = _spans(text, pattern, "entropy", len(BASE_KINDS))
        parts.append(F.flatten(F.transform(found, partial(_entropy_part, text, kind))))
    return F.array_distinct(F.concat(*parts))


def secret_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, assign, access, hex, entropy) span arrays of every row, in code points, ends exclusive.

    Null and empty texts have no spans. Rows are judged one by one; other columns
    are not read.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    kinds = [k for k, *_ in BASE_KINDS]
    return rows.select(
        "id", *[s.alias(k) for k, s in zip(kinds, base_spans(F.col("text")))], entropy_spans(F.col("text")).alias("entropy")
    )


def listed(*spans: Column) -> Column:
    """``kind:start:end`` of all spans by start, then kind, comma-joined."""
    every = F.array_sort(F.concat(*spans))
    return F.array_join(F.transform(every, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
