"""Item enrichment and the per-order item rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parceltide import contracts as C
from parceltide.functions import money
from parceltide.session import stage

_MEASURES = C.DECIMAL_NUMBER_COLUMNS["products"]


def product_profiles(products: DataFrame, translations: DataFrame) -> DataFrame:
    """Product dimension with its normalised category, volume and gap flags.

    Translating the dimension instead of the fact keeps one join off the items.
    A NULL category never matches a translation.
    """
    source, english = F.col("product_category_name"), F.col("product_category_name_english")
    any_gap = F.array_contains(F.array(*[F.col(c).isNull() for c in _MEASURES]), True)
    return products.join(translations, "product_category_name", "left").select(
        "product_id",
        F.when(source.isNull(), C.MISSING_CATEGORY)
        .when(english.isNull(), F.concat(F.lit(C.UNTRANSLATED_PREFIX), source))
        .otherwise(english).alias("normalized_product_category"),
        english.isNull().alias("product_category_fallback"),
        any_gap.alias("product_measurement_missing"),
        "product_weight_g",
        (F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm"))
        .alias("product_volume_cm3"),
    )


def enrich_items(
    items: DataFrame, products: DataFrame, translations: DataFrame, sellers: DataFrame
) -> DataFrame:
    """Item rows with product and seller attributes.

    No join is hinted: the dimensions are stored, so the planner knows their size. It broadcasts one
    only when that is small, and otherwise sort-merges with adaptive skew splitting on the item side.
    """
    profiles = stage(product_profiles(products, translations), "products")
    return items.join(profiles, "product_id", "left").join(stage(sellers, "sellers"), "seller_id", "left")


def primary_value(
    rows: DataFrame, key: str, amount: str, *, label: str, output: str, carry: str | None = None
) -> DataFrame:
    """Per order the key with most money, then most rows, then the smallest key.

    Two plain aggregates instead of a window: both combine before their
    shuffle, so an order with very many rows never becomes one sorted task.
    """
    payload = [carry] if carry else []
    totals = rows.where(F.col(key).isNotNull()).groupBy(label, key, *payload).agg(
        F.sum(money.exact(F.col(amount))).alias("amount"), F.count("*").alias("n")
    )
    best = F.min(F.struct(-F.col("amount"), -F.col("n"), F.col(key).alias("key"), *payload))
    return totals.groupBy(label).agg(best.alias("best")).select(
        label, F.col("best")[carry or "key"].alias(output)
    )


def primary_category(lines: DataFrame) -> DataFrame:
    return primary_value(
        lines, "normalized_product_category", "price",
        label="order_id", output="primary_product_category",
    )


def primary_seller_state(lines: DataFrame) -> DataFrame:
    return primary_value(
        lines, "seller_id", "price", label="order_id",
        output="primary_seller_state", carry="seller_state",
    )


PRODUCT, SELLER, CATEGORY = 0, 1, 2
_FACET_KEYS = ("product_id", "seller_id", "normalized_product_category")
_AMOUNT, _FREIGHT = ("amount", "amount_rest"), ("freight", "freight_rest")


def facet_subtotals(
    lines: DataFrame, of_order: tuple[str, ...] = (), of_seller: tuple[str, ...] = (), one_state: bool = False
) -> DataFrame:
    """Subtotals per (order, facet key): each line counts once per facet.

    Facets are the product, the seller and the category of a line. One pass
    yields the distinct counts and the ranking inputs of every facet, where
    separate aggregates would read and join the items again. A facet carries only what it
    is asked for: the product its key, the seller its money, the category all sums. ``of_order``
    columns are constant within an order; as keys they cost no aggregate of their own.
    ``of_seller`` columns are constant within a seller.

    With ``one_state`` a seller is known to have one state, which is then a key: all else is numbers, and
    the rows are hashed, never sorted. Otherwise the least state is taken, which is text, so the rows are
    aggregated by sorting. Lines that arrive sorted by order are almost in that order, and what is then
    grouped by the order and ``of_order``, or the first of them, needs no other sort.
    """
    amount, freight = money.split(F.col("price")), money.split(F.col("freight_value"))
    lines = lines.withColumns(dict(zip((*_AMOUNT, *_FREIGHT), (*amount, *freight))))
    kinds = dict(lines.dtypes)
    keys = ("order_id", *of_order, "facet", *_FACET_KEYS, *(["seller_state"] if one_state else []))
    of_seller = ("seller_state", *of_seller)
    sums = (*_FREIGHT, "product_measurement_missing", "product_category_fallback", "product_weight_g", "product_volume_cm3")
    fanned = (*_FACET_KEYS, *of_seller, *_AMOUNT, *sums)

    def facet(number: int, *kept: str) -> Column:
        return F.struct(F.lit(number).alias("facet"), *[
            (F.col(c) if c in kept else F.lit(None).cast(kinds[c])).alias(c) for c in fanned
        ])

    fan_out = F.inline(F.array(
        facet(PRODUCT, "product_id"), facet(SELLER, "seller_id", *of_seller, *_AMOUNT),
        facet(CATEGORY, "normalized_product_category", *_AMOUNT, *sums),
    ))
    return lines.select("order_id", *of_order, fan_out).groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[F.sum(c).alias(c) for c in (*_AMOUNT, *_FREIGHT)],
        F.count_if("product_measurement_missing").alias("gaps"),
        F.count_if("product_category_fallback").alias("fallbacks"),
        F.sum("product_weight_g").alias("weight"), F.count("product_weight_g").alias("weighed"),
        F.sum("product_volume_cm3").alias("volume"), F.count("product_volume_cm3").alias("sized"),
        *[F.min(c).alias(c) for c in of_seller if c not in keys],
    )


def facet_totals() -> list[Column]:
    """Per-order item features from facet subtotals.

    Rows and money stand in several facets; all other sums stand in the category alone.
    """
    facet = F.col("facet")
    total = lambda c: F.sum(F.when(facet == CATEGORY, F.col(c)))
    rows = total("n")

    def best(number: int, key: str, *more: str) -> Column:
        places = F.lit(10**10)
        rest = F.col("amount_rest") % places
        units = F.col("amount") + F.rint((F.col("amount_rest") - rest) / places).cast("bigint")
        rank = F.struct(-units, -rest, -F.col("n"), F.col(key).alias("key"), *more)
        return F.min(F.when((facet == number) & F.col(key).isNotNull(), rank))

    return [
        rows.alias("item_row_count"),
        F.count("product_id").alias("distinct_product_count"),
        F.count("seller_id").alias("distinct_seller_count"),
        money.rounded(money.joined(*map(total, _AMOUNT))).alias("item_price_total"),
        money.rounded(money.joined(*map(F.sum, _FREIGHT))).alias("freight_value_total"),
        F.sum("gaps").alias("product_measurement_missing_item_count"),
        F.sum("fallbacks").alias("product_category_fallback_item_count"),
        F.when(F.sum("weighed") == rows, F.sum("weight")).alias("product_weight_g_total"),
        F.when(F.sum("sized") == rows, F.sum("volume")).alias("product_volume_cm3_total"),
        best(CATEGORY, "normalized_product_category").getField("key").alias("primary_product_category"),
        best(SELLER, "seller_id", "seller_state").getField("seller_state").alias("primary_seller_state"),
    ]


def item_rollup(lines: DataFrame) -> DataFrame:
    """Totals plus primary category and primary seller state, one row per order.

    The lines move to their order before they fan out to facets, which triples them. They do so by a join with the
    order keys, since adaptive execution can split a hot order there.
    """
    orders = lines.select("order_id").distinct().withColumn("_known", F.lit(True))
    facets = facet_subtotals(lines.join(orders, "order_id", "left"), of_order=("_known",))
    return facets.groupBy("order_id", "_known").agg(*facet_totals()).drop("_known")


def seller_pairs(lines: DataFrame) -> DataFrame:
    """Distinct (order, seller) pairs with the seller's ZIP prefix."""
    return lines.select("order_id", "seller_id", "seller_zip_code_prefix").distinct()


def eligible_pairs(pairs: DataFrame, orders: DataFrame) -> DataFrame:
    return pairs.join(orders.select("order_id"), "order_id", "left_semi")
