"""The retail sources with known bad rows, so that every rule has something to find.

Bad rows follow from the keys by arithmetic that Spark and the check SQL share:
where ``key % modulus`` hits the residue of a change, a column is replaced. Rows
with the residue ``TWICE`` come twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parceltide import contracts as C
from registry.common import retail_sources

_FAR = 1_000_000_000  # added to a key, it matches nothing

# Source -> (row number as an integer expression, modulus, residue of the first missing column, residue of repeated rows)
_ROWS = {
    "orders": ("order_id", 37, 0, 36),
    "customers": ("customer_id", 37, 0, 36),
    "items": ("(order_id * 5 + order_item_id)", 37, 0, 36),
    "products": ("product_id", 37, 0, 36),
    "sellers": ("seller_id", 7, 0, 6),
    "payments": ("(order_id * 3 + payment_sequential)", 37, 0, 36),
    "geolocation": ("CAST(geolocation_zip_code_prefix AS BIGINT)", 37, 0, 36),
    "translations": ("length(product_category_name)", 8, 5, 7),
}
_MORE = {
    "orders": {"customer_id": [(33, f"customer_id + {_FAR}")]},
    "customers": {"customer_id": [(34, f"customer_id + {_FAR}")]},
    "items": {
        "order_id": [(33, f"order_id + {_FAR}")], "product_id": [(32, f"product_id + {_FAR}")],
        "seller_id": [(31, f"seller_id + {_FAR}")],
    },
    "payments": {"order_id": [(33, f"order_id + {_FAR}")]},
    "geolocation": {
        "geolocation_lat": [(30, "CAST(95 AS DOUBLE)")], "geolocation_lng": [(31, "CAST(-200 AS DOUBLE)")],
    },
}


def _changes(source: str) -> dict[str, list[tuple[int, str]]]:
    _, _, residue, _ = _ROWS[source]
    out = {c: list(_MORE.get(source, {}).get(c, ())) for c in C.USED_COLUMNS[source]}
    for c in C.USED_COLUMNS[source]:
        if c not in C.NULLABLE_SOURCE_COLUMNS.get(source, ()):
            out[c].append((residue, "NULL"))
            residue += 1
    for i, c in enumerate(C.NONNEGATIVE_COLUMNS.get(source, ())):
        out[c].append((20 + i, f"-{c} - 1"))
    return out


def _columns(source: str) -> list[str]:
    row, modulus, *_ = _ROWS[source]
    cases = {
        c: " ".join(f"WHEN {row} % {modulus} = {r} THEN {value}" for r, value in changes)
        for c, changes in _changes(source).items()
    }
    return [f"CASE {case} ELSE {c} END AS {c}" if case else c for c, case in cases.items()]


def _twice(source: str) -> str:
    row, modulus, _, residue = _ROWS[source]
    return f"{row} % {modulus} = {residue}"


def broken_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The typed sources with their bad rows."""
    out = {}
    for name, frame in retail_sources(spark, folder).items():
        copies = f"explode(array_repeat(0, CASE WHEN {_twice(name)} THEN 2 ELSE 1 END)) AS copy"
        out[name] = frame.selectExpr("*", copies).selectExpr(*_columns(name))
    return out


def broken_view(source: str, view: str) -> str:
    """The same as SQL over the check's view of the source."""
    columns = ", ".join(_columns(source))
    return f"SELECT {columns} FROM {view} UNION ALL SELECT {columns} FROM {view} WHERE {_twice(source)}"


# The feature table and the scores, likewise.
BROKEN_FEATURES = {
    "order_id": "CASE WHEN order_id % 37 = 4 THEN NULL ELSE order_id END",
    "order_purchase_timestamp": "CASE WHEN order_id % 37 = 3 THEN NULL ELSE order_purchase_timestamp END",
    "delay_flag": "CASE WHEN order_id % 37 = 1 THEN NULL WHEN order_id % 37 = 2 THEN 2 ELSE delay_flag END",
}
BROKEN_SCORE = (
    "CASE WHEN order_id % 37 = 1 THEN NULL WHEN order_id % 37 = 2 THEN CAST('NaN' AS DOUBLE) "
    "WHEN order_id % 37 = 3 THEN CAST(1.5 AS DOUBLE) ELSE risk_score END"
)


def broken_features(features: DataFrame) -> DataFrame:
    changed = [f"{BROKEN_FEATURES[c]} AS {c}" if c in BROKEN_FEATURES else c for c in features.columns]
    return features.selectExpr(*changed).unionByName(features.where("order_id % 37 = 5").selectExpr(*changed))


def broken_features_view() -> str:
    columns = ", ".join(f"{e} AS {c}" for c, e in BROKEN_FEATURES.items())
    return f"SELECT {columns} FROM features UNION ALL SELECT {columns} FROM features WHERE order_id % 37 = 5"
