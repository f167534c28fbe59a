"""Scoring contract, decisions and the risk report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parceltide import contracts as C
from parceltide.functions.display import distance_text, percent_text
from parceltide.functions.parsing import is_finite

# Bounds of the request contract.
YEARS = (2016, 2018)
STATE_PATTERN = "^[A-Z]{2}\\z"
_RANGES = {"purchase_month": (1, 12), "purchase_day_of_week": (0, 6), "purchase_hour": (0, 23)}
_AT_LEAST_ONE = ("item_row_count", "distinct_product_count", "distinct_seller_count")
_STATES = ("customer_state", "primary_seller_state")
_TEXTS = ("primary_product_category", "primary_payment_type")


def request_rules(years: tuple[int, int] = YEARS, state_pattern: str = STATE_PATTERN) -> dict[str, Column]:
    """Rule name -> "this request violates it", for every model feature."""
    rules: dict[str, Column] = {}
    for c in C.MODEL_FEATURES:
        value = F.col(c)
        if c not in C.NULLABLE_FEATURES:
            rules[f"{c}:required"] = value.isNull()
        if c in C.FLAG_FEATURES:
            continue
        if c in _STATES:
            rules[f"{c}:pattern"] = ~value.rlike(state_pattern)
        elif c in _TEXTS:
            rules[f"{c}:empty"] = F.length(value) < 1
        elif c in C.NUMERIC_FEATURES:
            if C.FEATURE_TYPES[c] == "double":
                rules[f"{c}:finite"] = ~is_finite(value)
            low, high = {"purchase_year": years, **_RANGES}.get(c, (1 if c in _AT_LEAST_ONE else 0, None))
            rules[f"{c}:range"] = (value < low) if high is None else ~value.between(low, high)
    return rules


def check_request_columns(requests: DataFrame) -> None:
    """Exactly the model features, plus an optional order id; nothing else."""
    extra = set(requests.columns) - set(C.MODEL_FEATURES) - {C.ORDER_KEY}
    missing = set(C.MODEL_FEATURES) - set(requests.columns)
    if extra or missing:
        raise ValueError(f"request columns: missing {sorted(missing)}, not allowed {sorted(extra)}")
    wrong = [c for c in C.FLAG_FEATURES if dict(requests.dtypes)[c] != "boolean"]
    if wrong:
        raise ValueError(f"request columns must be boolean: {wrong}")


def judge_requests(requests: DataFrame, **bounds) -> DataFrame:
    """Add ``reasons`` (broken rules, in contract order) and ``valid``."""
    check_request_columns(requests)
    reasons = F.array_compact(F.array(*[
        F.when(bad, F.lit(name)) for name, bad in request_rules(**bounds).items()
    ]))
    return requests.withColumn("reasons", reasons).withColumn("valid", F.size("reasons") == 0)


def _number(column: str) -> Column:
    """A number, or a text or boolean that reads as one, as a double."""
    kind = F.col(f"_kind_{column}")
    simple = kind.isin("STRING", "BOOLEAN", "BIGINT", "DOUBLE") | kind.startswith("DECIMAL")
    return F.when(simple, F.try_variant_get(f"_at_{column}", "$", "double"))


def _typed(column: str) -> Column:
    """Typed value of a field, null where it has another type.

    Flags must be booleans and texts strings. Numbers may also come as text that reads as a number or as a boolean,
    and whole numbers with a zero fraction.
    """
    wanted = C.FEATURE_TYPES.get(column, "string")
    if wanted in ("boolean", "string"):
        return F.when(F.col(f"_kind_{column}") == wanted.upper(), F.try_variant_get(f"_at_{column}", "$", wanted))
    number = F.col(f"_number_{column}")
    if wanted == "double":
        return number
    return F.when(number == F.floor(number), F.try_variant_get(f"_at_{column}", "$", "decimal(38,0)").try_cast(wanted))


def _mistyped(column: str) -> Column:
    """"This value has another type"; a JSON null is no type error."""
    kind, wanted = F.col(f"_kind_{column}"), C.FEATURE_TYPES.get(column, "string")
    other = kind != wanted.upper() if wanted in ("boolean", "string") else F.col(column).isNull()
    return kind.isNotNull() & (kind != "VOID") & other


def read_requests(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Typed model features, the order id and ``problems`` of JSON requests, each read on its own.

    ``problems`` lists, in this order, ``body:json`` for a text that is no JSON object, ``<key>:extra`` for keys beyond
    the contract, and per field ``<field>:missing`` or ``<field>:type``. Other columns of ``bodies`` stay in front.
    """
    fields = (C.ORDER_KEY, *C.MODEL_FEATURES)
    kept = [c for c in bodies.columns if c not in (body, *fields)]
    parsed = bodies.select(
        *[F.col(c) for c in kept], F.try_parse_json(F.col(body)).alias("_v"), F.json_object_keys(F.col(body)).alias("_keys")
    )
    is_object = F.col("_v").isNotNull() & F.col("_keys").isNotNull()
    found = parsed.select(
        *kept, F.when(is_object, F.col("_keys")).alias("_keys"),
        *[F.try_variant_get("_v", f"$.{c}", "variant").alias(f"_at_{c}") for c in fields],
    )
    extra = F.transform(
        F.array_sort(F.array_distinct(F.array_except("_keys", F.array(*map(F.lit, fields))))), lambda k: F.concat(k, F.lit(":extra"))
    )
    # Step by step, so that the kind and the number of a field are worked out once and not wherever they are looked at.
    numbers = [c for c in fields if C.FEATURE_TYPES.get(c, "string") not in ("boolean", "string")]
    step = found.select("*", *[F.schema_of_variant(f"_at_{c}").alias(f"_kind_{c}") for c in fields])
    step = step.select("*", *[_number(c).alias(f"_number_{c}") for c in numbers])
    step = step.select(*kept, "_keys", *[f"_kind_{c}" for c in fields], *[_typed(c).alias(c) for c in fields])
    problems = []
    for c in fields:
        if c != C.ORDER_KEY:
            problems.append(F.when(~F.array_contains("_keys", c), F.lit(f"{c}:missing")))
        problems.append(F.when(_mistyped(c), F.lit(f"{c}:type")))
    listed = F.concat(extra, F.array_compact(F.array(*problems)))
    return step.select(*kept, *fields, F.when(F.col("_keys").isNull(), F.array(F.lit("body:json"))).otherwise(listed).alias("problems"))


def judge_bodies(bodies: DataFrame, body: str = "body", **bounds) -> DataFrame:
    """``read_requests`` with ``reasons`` (problems, then broken rules of the fields that have none) and ``valid``."""
    typed = read_requests(bodies, body)

    def unread(field: str) -> Column:
        return F.exists("problems", lambda p: p.startswith(f"{field}:"))

    broken = [
        F.when(bad & ~unread(name.partition(":")[0]), F.lit(name)) for name, bad in request_rules(**bounds).items()
    ]
    no_json = F.array_contains("problems", "body:json")
    reasons = F.when(no_json, F.col("problems")).otherwise(F.concat("problems", F.array_compact(F.array(*broken))))
    return typed.withColumn("reasons", reasons).drop("problems").withColumn("valid", F.size("reasons") == 0)


def decisions(scored: DataFrame, threshold: float, model_name: str) -> DataFrame:
    """Response rows: score, threshold and the inclusive decision.

    A score that is missing, not finite or outside [0, 1] fails the job.
    """
    score = F.col("risk_score")
    usable = score.isNotNull() & is_finite(score) & score.between(0, 1)
    failure = F.raise_error(F.lit("the model returned an invalid risk score")).cast("double")
    return scored.withColumn("risk_score", F.when(usable, score).otherwise(failure)).select(
        C.ORDER_KEY, "risk_score", F.lit(float(threshold)).alias("decision_threshold"),
        (F.col("risk_score") >= F.lit(float(threshold))).alias("predicted_delay"),
        F.lit(model_name).alias("model_name"),
    )


def search_scores(decided: DataFrame, query: str = "", show: str = "all") -> DataFrame:
    """Case-insensitive substring search on the id, then the decision filter."""
    wanted = {"all": F.lit(True), "predicted": F.col("predicted_delay"), "notPredicted": ~F.col("predicted_delay")}
    text = query.strip().lower()
    hits = decided.where(F.lower(F.col(C.ORDER_KEY).cast("string")).contains(text)) if text else decided
    return hits.where(wanted[show])


def risk_report(decided: DataFrame, distance: str = "seller_customer_distance_km_max") -> DataFrame:
    """Display rows, riskiest first and then by id."""
    return decided.orderBy(F.col("risk_score").desc(), F.col(C.ORDER_KEY).asc()).select(
        C.ORDER_KEY, percent_text(F.col("risk_score")).alias("risk_text"),
        distance_text(F.col(distance)).alias("distance_text"), "predicted_delay",
    )


def risk_counts(requests: DataFrame, decided: DataFrame) -> DataFrame:
    """Submitted, scored and predicted-late counts."""
    return decided.agg(
        F.count("*").alias("scored_orders"), F.count_if("predicted_delay").alias("predicted_delays")
    ).withColumn("total_orders", requests.agg(F.count("*")).scalar())
