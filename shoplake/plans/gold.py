"""Business tables over the silver tables.

``unique_lines=True`` may be given if the cart lines hold each product once per cart, as the
silver table does. Then lines are counted where carts are meant, which spares a distinct
count. It is not checked: over lines that repeat, counts come out too large.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.functions import coverage_ratio, demand_tier, exact, exact_mean, exact_sum
from shoplake.functions.numbers import ratio, rounded
from shoplake.functions.tiers import CRITICAL, HIGH, MEDIUM, risk_level
from shoplake.operators.ranking import first_per_group
from shoplake.plans.silver import with_audit


def count_carts(unique_lines: bool) -> Column:
    return F.count("cart_id") if unique_lines else F.count_distinct("cart_id")


# --- customers --------------------------------------------------------------------------


def cart_totals(items: DataFrame) -> DataFrame:
    """One row per user and cart: also the step that breaks up a user with very many lines."""
    paid = exact("line_discounted_total")
    return items.groupBy("user_id", "cart_id").agg(
        F.sum("quantity").alias("cart_quantity"),
        F.sum(paid).alias("cart_spend"),
        F.sum(exact("line_total") - paid).alias("cart_savings"),
        F.sum(exact("discount_percentage")).alias("discount_sum"),
        F.count("discount_percentage").alias("discount_lines"),
    )


def user_purchases(items: DataFrame) -> DataFrame:
    """All purchase figures of a user from one grouping of the lines."""
    return (
        cart_totals(items)
        .groupBy("user_id")
        .agg(
            F.count("cart_id").alias("total_carts"),
            F.sum("cart_quantity").alias("total_items_bought"),
            rounded(F.sum("cart_spend"), 2).alias("total_spend"),
            ratio(F.sum("cart_spend"), F.count("cart_spend"), 2).alias("avg_cart_value"),
            ratio(F.sum("cart_quantity"), F.count("cart_quantity"), 1).alias("avg_basket_size"),
            ratio(F.sum("discount_sum"), F.sum("discount_lines"), 2).alias(
                "avg_discount_captured_pct"
            ),
            rounded(F.sum("cart_savings"), 2).alias("total_savings"),
        )
    )


def user_cart_aggregate(items: DataFrame) -> DataFrame:
    return user_purchases(items).select(
        "user_id",
        "total_carts",
        "total_items_bought",
        "total_spend",
        "avg_cart_value",
        "avg_basket_size",
    )


def discount_aggregate(items: DataFrame) -> DataFrame:
    """Unweighted mean over lines, and total savings, per user."""
    saved = exact("line_total") - exact("line_discounted_total")
    return items.groupBy("user_id").agg(
        exact_mean("discount_percentage", 2).alias("avg_discount_captured_pct"),
        exact_sum(saved, 2).alias("total_savings"),
    )


def category_quantities(items: DataFrame, products: DataFrame) -> DataFrame:
    """Spark sends a small catalogue to the lines, so these move once, summed by task; with a
    large one adaptive execution splits products with very many lines."""
    categories = products.select(F.col("id").alias("product_id"), "category")
    return (
        items.join(categories, "product_id", "left")
        .groupBy("user_id", "category")
        .agg(F.sum("quantity").alias("qty_in_category"))
    )


def favourite_category(items: DataFrame, products: DataFrame) -> DataFrame:
    """Category with the most units per user; of equal ones the first by name."""
    order = [F.desc("qty_in_category"), F.asc_nulls_last("category")]
    return first_per_group(category_quantities(items, products), ["user_id"], order).select(
        "user_id", F.col("category").alias("favourite_category")
    )


def customer_360(
    users: DataFrame, items: DataFrame, products: DataFrame, run_ts: dt.datetime | None = None
) -> DataFrame:
    """One row per user. Counts and amounts are 0 for users without purchases; favourite
    category and average discount stay null."""
    spine = users.select(
        F.col("id").alias("user_id"),
        *["first_name", "last_name", "email", "gender", F.col("age_derived").alias("age")],
        *["address_city", "address_country", "company_department", "role"],
    )
    joined = spine.join(user_purchases(items), "user_id", "left").join(
        favourite_category(items, products), "user_id", "left"
    )
    zeros = "total_carts total_items_bought total_spend avg_cart_value avg_basket_size".split()
    result = joined.select(
        *spine.columns,
        *zeros,
        "favourite_category",
        "avg_discount_captured_pct",
        "total_savings",
    ).fillna(0, [*zeros, "total_savings"])
    return with_audit(result, "gold", run_ts, "silver")


# --- products ---------------------------------------------------------------------------


def _line_tallies() -> list[Column]:
    """What a product's figures are made of; all of it can be summed up further."""
    price, discount = exact("unit_price"), exact("discount_percentage")
    return [
        F.sum("quantity").alias("units"),
        F.sum(exact("line_discounted_total")).alias("revenue"),
        F.sum(price).alias("price_sum"),
        F.count(price).alias("prices"),
        F.sum(discount).alias("discount_sum"),
        F.count(discount).alias("discounts"),
    ]


def _line_figures() -> list[Column]:
    return [
        rounded(F.sum("revenue"), 2).alias("total_revenue"),
        ratio(F.sum("price_sum"), F.sum("prices"), 4).alias("avg_sold_price"),
        ratio(F.sum("discount_sum"), F.sum("discounts"), 2).alias("avg_discount_pct"),
    ]


def product_demand(items: DataFrame, unique_lines: bool = False) -> DataFrame:
    """Figures per product. Carts and buyers are counted apart, each combined by task before it
    moves; counted in one grouping Spark would write out every line once per count."""
    if unique_lines:
        return items.groupBy("product_id").agg(
            F.sum("quantity").alias("total_units_sold"),
            count_carts(unique_lines).alias("times_added_to_cart"),
            F.count_distinct("user_id").alias("unique_buyers"),
            exact_sum("line_discounted_total", 2).alias("total_revenue"),
            exact_mean("unit_price", 4).alias("avg_sold_price"),
            exact_mean("discount_percentage", 2).alias("avg_discount_pct"),
        )
    by_cart = items.groupBy("product_id", "cart_id").agg(*_line_tallies())
    sold = by_cart.groupBy("product_id").agg(
        F.sum("units").alias("total_units_sold"),
        F.count("cart_id").alias("times_added_to_cart"),
        *_line_figures(),
    )
    by_user = items.select(F.col("product_id").alias("bought"), "user_id").distinct()
    buyers = by_user.groupBy("bought").agg(F.count("user_id").alias("unique_buyers"))
    joined = sold.join(buyers, F.col("product_id").eqNullSafe(F.col("bought")))
    figures = "total_revenue avg_sold_price avg_discount_pct".split()
    return joined.select(
        "product_id", "total_units_sold", "times_added_to_cart", "unique_buyers", *figures
    )


# Distinct carts and buyers are estimated with a relative error of 1.04 / sqrt(2 ** 14): 0.8 %.
SKETCH_BITS = 14


def demand_sketches(items: DataFrame) -> DataFrame:
    """Per product what its figures are made of, with sketches in place of distinct counts.

    A row takes some 32 kilobytes at most, however many lines the product has. Lines move as
    sums and sketches of a task only. Tables of different lines can be merged.
    """
    return items.groupBy("product_id").agg(
        *_line_tallies(),
        F.hll_sketch_agg("cart_id", SKETCH_BITS).alias("cart_sketch"),
        F.hll_sketch_agg("user_id", SKETCH_BITS).alias("buyer_sketch"),
    )


def merged_sketches(*tables: DataFrame) -> DataFrame:
    """Sketches of all lines from those of parts of them, such as those of each run. A part
    that is in there twice counts twice in sums, and once in distinct counts."""
    both = tables[0]
    for table in tables[1:]:
        both = both.unionByName(table)
    sums = "units revenue price_sum prices discount_sum discounts".split()
    kinds = dict(both.dtypes)
    return both.groupBy("product_id").agg(
        *[F.sum(name).cast(kinds[name]).alias(name) for name in sums],
        *[F.hll_union_agg(name).alias(name) for name in ("cart_sketch", "buyer_sketch")],
    )


def sketched_demand(sketches: DataFrame) -> DataFrame:
    """The columns of ``product_demand``, with estimates of the carts and buyers."""
    return sketches.select(
        "product_id",
        F.col("units").alias("total_units_sold"),
        F.hll_sketch_estimate("cart_sketch").alias("times_added_to_cart"),
        F.hll_sketch_estimate("buyer_sketch").alias("unique_buyers"),
        F.round(F.col("revenue").cast("double"), 2).alias("total_revenue"),
        ratio(F.col("price_sum"), F.col("prices"), 4).alias("avg_sold_price"),
        ratio(F.col("discount_sum"), F.col("discounts"), 2).alias("avg_discount_pct"),
    )


def product_performance(
    products: DataFrame,
    items: DataFrame,
    run_ts: dt.datetime | None = None,
    unique_lines: bool = False,
    literal_tiers: bool = False,
) -> DataFrame:
    """One row per product. ``literal_tiers`` puts unsold products into the tier ``high``."""
    demand = product_demand(items, unique_lines).withColumnRenamed("product_id", "id")
    joined = products.join(demand, "id", "left")
    units = F.coalesce("total_units_sold", F.lit(0))
    result = joined.select(
        F.col("id").alias("product_id"),
        *["title", "category", "brand", "sku", F.col("price").alias("catalogue_price")],
        *["rating", "stock", "availability_status", "weight"],
        units.alias("total_units_sold"),
        F.coalesce("times_added_to_cart", F.lit(0)).alias("times_added_to_cart"),
        F.coalesce("unique_buyers", F.lit(0)).alias("unique_buyers"),
        F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"),
        "avg_sold_price",
        "avg_discount_pct",
        F.round(F.col("avg_sold_price") - F.col("price"), 4).alias("price_drift"),
        demand_tier(F.col("total_units_sold") if literal_tiers else units).alias("demand_tier"),
    )
    return with_audit(result, "gold", run_ts, "silver")


def customer_spend(users: DataFrame, items: DataFrame) -> DataFrame:
    """Name, address and total spend per user: what the customer panels show."""
    people = users.select(F.col("id").alias("user_id"), "first_name", "last_name", "email")
    spend = user_purchases(items).select("user_id", "total_spend")
    return people.join(spend, "user_id", "left").fillna(0, ["total_spend"])


def product_revenue(products: DataFrame, items: DataFrame) -> DataFrame:
    """Category and total revenue per product."""
    revenue = items.groupBy(F.col("product_id").alias("id")).agg(
        exact_sum("line_discounted_total", 2).alias("total_revenue")
    )
    joined = products.select("id", "category").join(revenue, "id", "left")
    return joined.select("category", F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"))


def pending_demand(items: DataFrame) -> DataFrame:
    return items.groupBy("product_id").agg(F.sum("quantity").alias("pending_demand"))


def stock_risk(
    products: DataFrame,
    items: DataFrame,
    run_ts: dt.datetime | None = None,
    critical: int = CRITICAL,
    high: int = HIGH,
    medium: int = MEDIUM,
) -> DataFrame:
    """One row per product: what is left of the stock once all carts are served."""
    catalogue = products.select(
        F.col("id").alias("product_id"),
        *["title", "category", "brand", "sku", "availability_status"],
        F.col("stock").alias("current_stock"),
    )
    known = catalogue.join(pending_demand(items), "product_id", "left")
    return _risk(known.fillna(0, ["pending_demand"]), run_ts, critical, high, medium)


def stock_risk_of(
    product_performance: DataFrame,
    run_ts: dt.datetime | None = None,
    critical: int = CRITICAL,
    high: int = HIGH,
    medium: int = MEDIUM,
) -> DataFrame:
    """The same table from ``product_performance``, which has summed up the lines already."""
    known = product_performance.select(
        *["product_id", "title", "category", "brand", "sku", "availability_status"],
        F.col("stock").alias("current_stock"),
        F.col("total_units_sold").alias("pending_demand"),
    )
    return _risk(known, run_ts, critical, high, medium)


def _risk(
    known: DataFrame, run_ts: dt.datetime | None, critical: int, high: int, medium: int
) -> DataFrame:
    stock, demand = F.col("current_stock"), F.col("pending_demand")
    result = known.withColumns(
        {"net_stock": stock - demand, "stock_coverage_ratio": coverage_ratio(stock, demand)}
    ).withColumn("risk_level", risk_level(F.col("net_stock"), critical, high, medium))
    return with_audit(result, "gold", run_ts, "silver")


def tier_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).count()
