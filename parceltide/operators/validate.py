"""Rule engine: every rule is a count of violations, one aggregate per table.

All operators return rows ``(table, rule, column, violations)``; ``enforce``
turns a positive count into an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from parceltide import contracts as C
from parceltide.functions import parsing as P
from parceltide.operators.orders import is_eligible

VIOLATION_COLUMNS = ("table", "rule", "column", "violations")
Rule = tuple[str, str, Column]  # (rule, column, "this row violates it")


class ContractViolation(ValueError):
    """A validated frame breaks its contract."""


def count_violations(table: str, frame: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Evaluate all rules of one table in a single aggregate."""
    rules = list(rules)
    counts = frame.agg(*[F.count_if(bad).alias(f"r{i}") for i, (_, _, bad) in enumerate(rules)])
    rows = F.array(*[
        F.struct(
            F.lit(table).alias("table"), F.lit(rule).alias("rule"),
            F.lit(column).alias("column"), F.col(f"r{i}").alias("violations"),
        )
        for i, (rule, column, _) in enumerate(rules)
    ])
    return counts.select(F.inline(rows))


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def enforce(violations: DataFrame) -> None:
    """Raise when any rule is broken. One row per rule reaches the driver."""
    broken = violations.where(F.col("violations") > 0).collect()
    if broken:
        text = "; ".join(
            f"{r['table']}.{r['column']}: {r['rule']} ({r['violations']})" for r in broken
        )
        raise ContractViolation(text)


def require_columns(frame: DataFrame, columns: Iterable[str], table: str) -> None:
    missing = sorted(set(columns) - set(frame.columns))
    if missing:
        raise ContractViolation(f"{table} is missing required columns: {missing}")


def require_sources(sources: dict[str, DataFrame]) -> None:
    absent = sorted(set(C.SOURCE_FILES) - set(sources))
    if absent:
        raise ContractViolation(f"missing sources: {absent}")
    for name, columns in C.USED_COLUMNS.items():
        require_columns(sources[name], columns, name)


# -- row rules ---------------------------------------------------------------

def parse_rules(source: str) -> list[Rule]:
    """Text that is present but does not parse, per typed column of a text source."""
    kinds = (
        ("timestamp", C.TIMESTAMP_COLUMNS, P.timestamp_or_null),
        ("numeric", C.DECIMAL_NUMBER_COLUMNS, P.double_or_null),
        ("integer", C.WHOLE_NUMBER_COLUMNS, P.long_or_null),
    )
    return [
        (rule, c, P.is_unparseable(F.col(c), parser(F.col(c))))
        for rule, columns, parser in kinds
        for c in columns.get(source, ())
    ]


def value_rules(source: str) -> list[Rule]:
    """Non-missing, sign and coordinate rules of a typed source."""
    optional = C.NULLABLE_SOURCE_COLUMNS.get(source, ())
    rules: list[Rule] = [
        ("nonmissing", c, F.col(c).isNull()) for c in C.USED_COLUMNS[source] if c not in optional
    ]
    rules += [("nonnegative", c, F.col(c) < 0) for c in C.NONNEGATIVE_COLUMNS.get(source, ())]
    if source == "geolocation":
        rules += [
            ("world_bounds", "geolocation_lat", ~F.col("geolocation_lat").between(-90, 90)),
            ("world_bounds", "geolocation_lng", ~F.col("geolocation_lng").between(-180, 180)),
        ]
    return rules


def source_violations(sources: dict[str, DataFrame]) -> DataFrame:
    """All value rules of all typed sources."""
    return union_all(count_violations(n, sources[n], value_rules(n)) for n in C.SOURCE_FILES)


def parse_violations(raw: dict[str, DataFrame]) -> DataFrame:
    """All parse rules of all text sources that have typed columns."""
    return union_all(
        count_violations(n, raw[n], rules) for n in C.SOURCE_FILES if (rules := parse_rules(n))
    )


# -- keys and references -----------------------------------------------------

@dataclass(frozen=True)
class KeyRule:
    """A key of a table: unique or, with a ``parent`` (table, keys), present there. Rows outside ``where`` do not count."""

    label: str
    table: str
    keys: tuple[str, ...]
    parent: tuple[str, tuple[str, ...]] | None = None
    where: Column | None = None


def _key_text(keys: Sequence[str], kinds: dict[str, str]) -> Column:
    """One text per key, NULL where a part is; parts of several columns keep their lengths, so that none can be mistaken."""
    parts = [F.col(k).cast(kinds[k]).cast("string") for k in keys]
    if len(parts) == 1:
        return parts[0]
    return F.concat(*[x for p in parts for x in (F.char_length(p).cast("string"), F.lit(":"), p)])


def key_rule_violations(tables: dict[str, DataFrame], rules: Sequence[KeyRule]) -> DataFrame:
    """Violations of all key rules in one pass: each table is read once, and all rules share one shuffle.

    A row gives one entry (rule, side, key) for every rule it takes part in. Entries are counted per (rule, key), in
    part before the shuffle, so a key that owns most of the rows arrives as a few counts. Unique keys yield the rules
    ``missing_key`` (rows with a NULL part) and ``duplicate_key`` (all rows that share their key), references the rule
    ``unmatched``: child rows without a parent, NULL keys among them.
    """
    entries: dict[str, list[Column]] = {}

    def enter(table: str, number: int, keys: Sequence[str], kinds: dict[str, str], child: int, where: Column | None) -> None:
        entry = F.struct(F.lit(number).alias("rule"), _key_text(keys, kinds).alias("key"), F.lit(child).alias("child"))
        entries.setdefault(table, []).append(entry if where is None else F.when(where, entry))

    for number, rule in enumerate(rules):
        kinds = dict(tables[rule.table].dtypes)
        if rule.parent:
            parent, parent_keys = rule.parent
            theirs = dict(tables[parent].dtypes)
            enter(parent, number, parent_keys, theirs, 0, None)
            kinds = {k: theirs[p] for k, p in zip(rule.keys, parent_keys)}
        enter(rule.table, number, rule.keys, kinds, 1, rule.where)
    # A row outside ``where`` gives an entry without a rule; dropping it here keeps the fan-out compiled.
    streams = [tables[t].select(F.inline(F.array(*found))).where("rule IS NOT NULL") for t, found in entries.items()]
    keys = union_all(streams).groupBy("rule", "key").agg(
        F.sum("child").alias("n"), F.max(F.lit(1) - F.col("child")).alias("known")
    )
    no_key = F.col("key").isNull()
    counts, rows = [], []
    for number, rule in enumerate(rules):
        bad = {"unmatched": no_key | (F.col("known") == 0)} if rule.parent else {
            "missing_key": no_key, "duplicate_key": ~no_key & (F.col("n") > 1),
        }
        for name, condition in bad.items():
            column = f"{name}{number}"
            counts.append(F.coalesce(F.sum(F.when((F.col("rule") == number) & condition, F.col("n"))), F.lit(0)).alias(column))
            rows.append(F.struct(
                F.lit(rule.label).alias("table"), F.lit(name).alias("rule"), F.lit(",".join(rule.keys)).alias("column"),
                F.col(column).cast("bigint").alias("violations"),
            ))
    return keys.agg(*counts).select(F.inline(F.array(*rows)))


def key_violations(frame: DataFrame, keys: Iterable[str], table: str) -> DataFrame:
    """Rows with a NULL key part, and all rows that share their key with another row."""
    return key_rule_violations({table: frame}, [KeyRule(table, table, tuple(keys))])


def orphan_violations(
    child: DataFrame, parent: DataFrame, key: str, relation: str, parent_key: str | None = None
) -> DataFrame:
    """Child rows without a parent. NULL keys never match."""
    rule = KeyRule(relation, "child", (key,), ("parent", (parent_key or key,)))
    return key_rule_violations({"child": child, "parent": parent}, [rule])


UNIQUE_RULES = tuple(KeyRule(n, n, keys) for n, keys in C.UNIQUE_KEYS.items())
REFERENCE_RULES = tuple(
    KeyRule(f"{child}->{parent}", child, (key,), (parent, (parent_key,))) for child, parent, key, parent_key in C.REFERENCES
)


def itemless_rule() -> KeyRule:
    """Eligible orders own item rows."""
    return KeyRule("eligible->items", "orders", ("order_id",), ("items", ("order_id",)), is_eligible())


def assignment_rule() -> KeyRule:
    """A customer record belongs to one order."""
    return KeyRule("orders->customers", "orders", ("customer_id",), where=F.col("customer_id").isNotNull())


def customer_assignment_violations(sources: dict[str, DataFrame]) -> DataFrame:
    """Rows of customers with several orders."""
    return key_rule_violations(sources, [assignment_rule()])


_COPIES = "_copies"


def one_per_key(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with the number of rows it stands for; the key columns must not be NULL to match anything."""
    rest = [c for c in frame.columns if c not in keys]
    return frame.groupBy(*keys).agg(F.count("*").alias(_COPIES), *[F.first(c).alias(c) for c in rest])


def join_counted(left: DataFrame, counted: DataFrame, keys: Sequence[str], how: str = "left", name: str = "join") -> DataFrame:
    """Join with a side reduced by ``one_per_key``; reading a column of a repeated key that was met raises an error."""
    told = F.concat_ws(" ", F.lit(f"{name}: repeated key"), *[F.col(k).cast("string") for k in keys])
    rest = [c for c in counted.columns if c not in (*keys, _COPIES)]
    return left.join(counted, list(keys), how).select(
        *left.columns, *[F.when(F.col(_COPIES) > 1, F.raise_error(told)).otherwise(F.col(c)).alias(c) for c in rest]
    )


def join_checked(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "left",
    cardinality: str = "many_to_one", name: str = "join",
) -> DataFrame:
    """Join that proves the stated cardinality while it runs: many_to_one, one_to_one or one_to_many.

    The side that must be unique is reduced to a row and a count per key, by an aggregate that shares the partitioning
    of the join, and the count is judged where its columns are read: no extra job, no second look at the table.
    Repeated keys that nothing meets do no harm.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if cardinality == "many_to_one":
        return join_counted(left, one_per_key(right, keys), keys, how, name)
    swapped = {"left": "right", "right": "left"}.get(how, how)
    columns = [*left.columns, *[c for c in right.columns if c not in keys]]
    if cardinality == "one_to_many":
        return join_counted(right, one_per_key(left, keys), keys, swapped, name).select(*columns)
    if cardinality != "one_to_one":
        raise ValueError(f"unknown cardinality {cardinality}")
    first = one_per_key(left, keys).withColumnRenamed(_COPIES, "_left_copies")
    both = join_counted(first, one_per_key(right, keys), keys, how, name)
    told = F.concat_ws(" ", F.lit(f"{name}: repeated key"), *[F.col(k).cast("string") for k in keys])
    return both.select(*keys, *[
        F.when(F.col("_left_copies") > 1, F.raise_error(told)).otherwise(F.col(c)).alias(c) for c in columns if c not in keys
    ])


# -- feature rows ------------------------------------------------------------

def check_feature_layout(frame: DataFrame) -> None:
    """Exact columns and order; identifiers, target and leaks stay out of the inputs."""
    if tuple(frame.columns) != C.FEATURE_ROW:
        raise ContractViolation("feature columns or their order differ from the contract")
    inputs = set(C.MODEL_FEATURES)
    if inputs & C.FORBIDDEN_FEATURES or inputs & set(C.METADATA) or C.TARGET in inputs:
        raise ContractViolation("a forbidden column is among the model inputs")


def feature_violations(frame: DataFrame, target_values: bool = True) -> DataFrame:
    """Key, timestamp and target rules of the feature table."""
    target = F.col(C.TARGET)
    rules: list[Rule] = [("nonmissing", C.TARGET, target.isNull())]
    if target_values:
        rules += [
            ("nonmissing", C.PURCHASE_TIME, F.col(C.PURCHASE_TIME).isNull()),
            ("binary", C.TARGET, target.isNull() | ~target.isin(0, 1)),
        ]
    return count_violations("features", frame, rules).unionByName(
        key_violations(frame, [C.ORDER_KEY], "features")
    )


def check_known_metrics(summary: DataFrame, expected: dict[str, int]) -> None:
    """Compare a one-row summary with locked values."""
    row = summary.first().asDict()
    actual = {name: row[name] for name in expected}
    if actual != expected:
        raise ContractViolation(f"summary {actual} differs from the verified {expected}")


def check_split(summary: DataFrame) -> None:
    """Three non-empty splits, and both classes in the training split."""
    rows = {r["split"]: r for r in summary.collect()}
    if set(rows) != {"train", "validation", "test"}:
        raise ContractViolation("too few rows for the chronological split")
    if not rows["train"]["late"] or not rows["train"]["on_time"]:
        raise ContractViolation("training split must contain both target classes")


def validate_sources(
    sources: dict[str, DataFrame], one_order_per_customer: bool = True, row_rules: bool = True, items_of_eligible: bool = False
) -> None:
    """Key, reference and (unless already checked) row rules; one report, then raise."""
    require_sources(sources)
    rules = [*UNIQUE_RULES, *REFERENCE_RULES]
    if one_order_per_customer:
        rules.append(assignment_rule())
    if items_of_eligible:
        rules.append(itemless_rule())
    checks = [key_rule_violations(sources, rules)]
    if row_rules:
        checks.append(source_violations(sources))
    enforce(union_all(checks))
