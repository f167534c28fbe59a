"""Queries over parsing, rules, keys, references and contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from parceltide import contracts as C
from parceltide.functions import parsing as P
from parceltide.operators import scoring, validate as V
from registry.broken_sources import broken_features, broken_features_view, broken_sources, broken_view
from registry.common import feature_table, read_table, register
from registry.views import VIEWS, compose

_STAMP = "^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"


@register("parse_typed", f"""
SELECT count(*) FILTER (WHERE try_cast(CASE WHEN regexp_full_match(good_stamp, '{_STAMP}') THEN good_stamp END AS TIMESTAMP) IS NULL) AS bad_stamps,
  count(*) FILTER (WHERE try_cast(CASE WHEN regexp_full_match(short_stamp, '{_STAMP}') THEN short_stamp END AS TIMESTAMP) IS NULL) AS bad_short_stamps,
  max(try_cast(CASE WHEN regexp_full_match(good_stamp, '{_STAMP}') THEN good_stamp END AS TIMESTAMP)) AS last_stamp,
  count(*) FILTER (WHERE try_cast(price_text AS DOUBLE) IS NULL) AS bad_prices,
  max(try_cast(price_text AS DOUBLE)) AS top_price,
  count(*) FILTER (WHERE try_cast(flag_text AS DOUBLE) IS NULL) AS bad_flags,
  count(*) FILTER (WHERE try_cast(line_text AS DOUBLE) IS NULL OR try_cast(line_text AS DOUBLE) % 1 <> 0) AS bad_lines,
  sum(try_cast(line_text AS DOUBLE)::BIGINT)::BIGINT AS line_sum,
  count(*) FILTER (WHERE try_cast(discount_text AS DOUBLE) % 1 <> 0) AS bad_whole_discounts
FROM (SELECT strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS good_stamp, strftime(l_shipdate, '%Y-%m-%d') AS short_stamp,
  l_extendedprice::VARCHAR AS price_text, l_returnflag AS flag_text, l_linenumber::VARCHAR || '.0' AS line_text,
  l_discount::VARCHAR AS discount_text FROM lineitem)""")
def _(spark, folder):
    text = read_table(spark, folder, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("good_stamp"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("short_stamp"),
        F.col("l_extendedprice").cast("string").alias("price_text"),
        F.col("l_returnflag").alias("flag_text"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit(".0")).alias("line_text"),
        F.col("l_discount").cast("string").alias("discount_text"),
    )
    fails = lambda c, parser: F.count_if(P.is_unparseable(F.col(c), parser(F.col(c))))
    return text.agg(
        fails("good_stamp", P.timestamp_or_null).alias("bad_stamps"),
        fails("short_stamp", P.timestamp_or_null).alias("bad_short_stamps"),
        F.max(P.timestamp_or_null(F.col("good_stamp"))).alias("last_stamp"),
        fails("price_text", P.double_or_null).alias("bad_prices"),
        F.max(P.double_or_null(F.col("price_text"))).alias("top_price"),
        fails("flag_text", P.double_or_null).alias("bad_flags"),
        fails("line_text", P.long_or_null).alias("bad_lines"),
        F.sum(P.long_or_null(F.col("line_text"))).alias("line_sum"),
        fails("discount_text", P.long_or_null).alias("bad_whole_discounts"),
    )


def _row(table: str, rule: str, column: str, condition: str, view: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", '{rule}' AS rule, '{column}' AS \"column\", "
        f"count(*) FILTER (WHERE {condition}) AS violations FROM {view}"
    )


_VIEW = {n: f"b_{n}" for n in C.SOURCE_FILES}
# The sources with known bad rows, over the clean views.
_BROKEN = {f"b_{n}": broken_view(n, "v_geo" if n == "geolocation" else f"v_{n}") for n in C.SOURCE_FILES}
_BROKEN["b_eligible"] = VIEWS["eligible"].replace("v_orders", "b_orders")


def _rule_sql() -> str:
    rows = []
    for name in C.SOURCE_FILES:
        view, optional = _VIEW[name], C.NULLABLE_SOURCE_COLUMNS.get(name, ())
        rows += [_row(name, "nonmissing", c, f"{c} IS NULL", view) for c in C.USED_COLUMNS[name] if c not in optional]
        rows += [_row(name, "nonnegative", c, f"{c} < 0", view) for c in C.NONNEGATIVE_COLUMNS.get(name, ())]
    rows.append(_row("geolocation", "world_bounds", "geolocation_lat", "geolocation_lat NOT BETWEEN -90 AND 90", "b_geolocation"))
    rows.append(_row("geolocation", "world_bounds", "geolocation_lng", "geolocation_lng NOT BETWEEN -180 AND 180", "b_geolocation"))
    return compose(" UNION ALL ".join(rows), **_BROKEN)


@register("rule_violations", _rule_sql())
def _(spark, folder):
    return V.source_violations(broken_sources(spark, folder))


def _key_sql(table: str, keys: tuple[str, ...], view: str) -> str:
    columns, null_key = ", ".join(keys), " OR ".join(f"{k} IS NULL" for k in keys)
    groups = f"(SELECT {columns}, count(*) AS n FROM {view} GROUP BY {columns})"
    return (
        f"SELECT '{table}' AS \"table\", 'missing_key' AS rule, '{','.join(keys)}' AS \"column\", "
        f"coalesce(sum(n) FILTER (WHERE {null_key}), 0)::BIGINT AS violations FROM {groups} UNION ALL "
        f"SELECT '{table}', 'duplicate_key', '{','.join(keys)}', "
        f"coalesce(sum(n) FILTER (WHERE n > 1 AND NOT ({null_key})), 0)::BIGINT FROM {groups}"
    )


@register("duplicate_keys", compose(" UNION ALL ".join(
    [_key_sql(n, k, _VIEW[n]) for n, k in C.UNIQUE_KEYS.items()]
    + [_key_sql("lineitem", ("l_orderkey", "l_linenumber"), "lineitem")]
), **_BROKEN))
def _(spark, folder):
    tables = {**broken_sources(spark, folder), "lineitem": read_table(spark, folder, "lineitem")}
    raw = V.KeyRule("lineitem", "lineitem", ("l_orderkey", "l_linenumber"))
    return V.key_rule_violations(tables, [*V.UNIQUE_RULES, raw])


def _orphan_sql(relation: str, child: str, parent: str, key: str, parent_key: str) -> str:
    return (
        f"SELECT '{relation}' AS \"table\", 'unmatched' AS rule, '{key}' AS \"column\", count(*) AS violations "
        f"FROM {child} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{key})"
    )


@register("fk_orphans", compose(" UNION ALL ".join(
    [_orphan_sql(f"{c}->{p}", _VIEW[c], _VIEW[p], k, pk) for c, p, k, pk in C.REFERENCES]
    + [_orphan_sql("eligible->items", "b_eligible", "b_items", "order_id", "order_id"),
       _orphan_sql("customers->orders", "b_customers", "b_orders", "customer_id", "customer_id")]
), **_BROKEN))
def _(spark, folder):
    back = V.KeyRule("customers->orders", "customers", ("customer_id",), ("orders", ("customer_id",)))
    return V.key_rule_violations(broken_sources(spark, folder), [*V.REFERENCE_RULES, V.itemless_rule(), back])


@register("feature_contract", compose("""
SELECT 'features' AS "table", 'nonmissing' AS rule, 'delay_flag' AS "column",
  count(*) FILTER (WHERE delay_flag IS NULL) AS violations FROM b_features
UNION ALL SELECT 'features', 'nonmissing', 'order_purchase_timestamp',
  count(*) FILTER (WHERE order_purchase_timestamp IS NULL) FROM b_features
UNION ALL SELECT 'features', 'binary', 'delay_flag',
  count(*) FILTER (WHERE delay_flag IS NULL OR delay_flag NOT IN (0, 1)) FROM b_features
UNION ALL SELECT 'features', 'missing_key', 'order_id', count(*) FILTER (WHERE order_id IS NULL) FROM b_features
UNION ALL SELECT 'features', 'duplicate_key', 'order_id',
  (SELECT coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM b_features WHERE order_id IS NOT NULL GROUP BY order_id)
   WHERE n > 1)""", b_features=broken_features_view()))
def _(spark, folder):
    features = feature_table(spark, folder)
    V.check_feature_layout(features)
    return V.feature_violations(broken_features(features))


# Bounds of the registered request check: the years and state names of the retail tables.
BOUNDS = {"years": (1996, 2000), "state_pattern": "^NATION_[0-9]$"}


def _request_sql(broken: dict[str, str] = {}, extra: str = "", no_json: str = "false") -> str:
    """Reasons per order; ``broken`` maps ``field:problem`` to the rows that have it, ``extra`` and ``no_json`` likewise."""
    def rule(name, condition):
        return f"CASE WHEN {condition} THEN '{name}' END"

    cases = [rule(name, condition) for name, condition in broken.items()]
    if extra:
        cases.insert(0, rule("surprise:extra", extra))
    one = ("item_row_count", "distinct_product_count", "distinct_seller_count")
    ranges = {"purchase_year": BOUNDS["years"], "purchase_month": (1, 12), "purchase_day_of_week": (0, 6), "purchase_hour": (0, 23)}
    for c in C.MODEL_FEATURES:
        if c not in C.NULLABLE_FEATURES:
            cases.append(rule(f"{c}:required", f"{c} IS NULL"))
        if c in C.FLAG_FEATURES:
            continue
        if c.endswith("_state"):
            cases.append(rule(f"{c}:pattern", f"NOT regexp_full_match({c}, 'NATION_[0-9]')"))
        elif c in C.CATEGORICAL_FEATURES:
            cases.append(rule(f"{c}:empty", f"length({c}) < 1"))
        else:
            if C.FEATURE_TYPES[c] == "double":
                cases.append(rule(f"{c}:finite", f"NOT isfinite({c})"))
            low, high = ranges.get(c, (1 if c in one else 0, None))
            cases.append(rule(f"{c}:range", f"{c} < {low}" if high is None else f"{c} NOT BETWEEN {low} AND {high}"))
    return compose(
        "SELECT order_id, reasons = '' AS valid, reasons FROM "
        f"(SELECT order_id, CASE WHEN {no_json} THEN 'body:json' ELSE concat_ws(',', {', '.join(cases)}) END AS reasons FROM features)"
    )


@register("request_rules", _request_sql())
def _(spark, folder):
    requests = feature_table(spark, folder).drop(C.PURCHASE_TIME, C.TARGET)
    return scoring.judge_requests(requests, **BOUNDS).select(
        "order_id", "valid", F.array_join("reasons", ",").alias("reasons")
    )


# Rows with a bad body: a lost key, a flag given as text, a fraction where a whole number belongs, a strange key, cut JSON.
_BAD = {
    "payment_row_count:missing": "order_id % 31 = 1", "payment_data_missing:type": "order_id % 31 = 2",
    "distinct_payment_type_count:type": "order_id % 31 = 3",
}


@register("raw_requests", _request_sql(
    {k: _BAD[k] for k in ("payment_row_count:missing", "distinct_payment_type_count:type", "payment_data_missing:type")},
    "order_id % 31 = 4", "order_id % 31 = 5",
))
def _(spark, folder):
    """The feature rows as JSON requests, some of them damaged, each judged alone."""
    hit = lambda name: F.expr(_BAD[name])
    whole = F.struct(*[
        F.when(hit("distinct_payment_type_count:type"), 1.5).otherwise(F.col(c).cast("double")).alias(c)
        if c == "distinct_payment_type_count" else F.col(c) for c in C.MODEL_FEATURES
    ])
    body = F.to_json(whole, {"ignoreNullFields": "false"})
    body = F.when(hit("payment_row_count:missing"), F.regexp_replace(body, '"payment_row_count":[0-9]+,', "")).when(
        hit("payment_data_missing:type"), F.regexp_replace(body, '"payment_data_missing":(true|false)', '"payment_data_missing":"$1"')
    ).when(F.expr("order_id % 31 = 4"), F.regexp_replace(body, "^[{]", '{"surprise":1,')).when(
        F.expr("order_id % 31 = 5"), F.expr("substring(b, 1, length(b) - 1)")
    ).otherwise(body)
    bodies = feature_table(spark, folder).withColumn("b", F.to_json(whole, {"ignoreNullFields": "false"})).select(
        F.col("order_id").alias("request_id"), body.alias("body")
    )
    return scoring.judge_bodies(bodies, **BOUNDS).select(
        F.col("request_id").alias("order_id"), "valid", F.array_join("reasons", ",").alias("reasons")
    )
