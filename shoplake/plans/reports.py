"""Reports over the silver tables.

Lines are summed up per product or user before they meet the catalogue or the users where
the result allows it, so a product or user with very many lines joins as one row.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.functions import age_band, exact, exact_mean, exact_sum, full_name
from shoplake.functions.numbers import ratio
from shoplake.operators.quality import health_check
from shoplake.operators.ranking import top
from shoplake.plans.gold import cart_totals, count_carts, pending_demand, user_purchases


def bronze_counts(products: DataFrame, users: DataFrame, carts: DataFrame) -> DataFrame:
    """Raw records per entity, and the cart lines they hold."""

    def counted(df, name, value):
        return df.agg(value.alias("records")).select(F.lit(name).alias("entity"), "records")

    lines = F.coalesce(F.sum(F.coalesce(F.size("products"), F.lit(0))), F.lit(0))
    everything = F.count(F.lit(1))
    return (
        counted(products, "products", everything)
        .union(counted(users, "users", everything))
        .union(counted(carts, "carts", everything))
        .union(counted(carts, "cart_lines", lines))
    )


def products_audit(products: DataFrame) -> DataFrame:
    return products.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("brand") == "unknown").alias("unknown_brand"),
        F.count_if(F.col("stock") == 0).alias("out_of_stock"),
        F.count_if(F.col("rating") == 0).alias("unrated"),
        F.count_if(F.col("weight") == 0).alias("no_weight"),
    )


def category_distribution(products: DataFrame) -> DataFrame:
    return (
        products.groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            exact_mean("price", 2).alias("avg_price"),
            exact_mean("rating", 2).alias("avg_rating"),
            F.sum("stock").alias("total_stock"),
        )
        .orderBy(F.desc("product_count"), "category")
    )


def most_expensive(products: DataFrame, n: int = 5) -> DataFrame:
    columns = products.select("id", "title", "category", "price", "stock", "rating")
    return top(columns, n, F.desc("price"), F.asc("id"))


def age_discrepancies(users: DataFrame, tolerance: int = 1, n: int = 10) -> DataFrame:
    """Users whose stated age is furthest from the one their birth date gives."""
    gap = F.abs(F.col("age") - F.col("age_derived"))
    found = users.filter(gap > tolerance).select(
        "id",
        "first_name",
        F.col("age").alias("age_raw"),
        "age_derived",
        (F.col("age") - F.col("age_derived")).alias("discrepancy"),
    )
    return top(found, n, F.desc(F.abs("discrepancy")), F.asc("id"))


def frequency(df: DataFrame, column: str, alias: str = "count") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(alias))


def gender_distribution(users: DataFrame) -> DataFrame:
    return frequency(users, "gender").orderBy(F.desc("count"), "gender")


def role_distribution(users: DataFrame) -> DataFrame:
    return frequency(users, "role").orderBy(F.desc("count"), "role")


def top_countries(users: DataFrame, n: int = 10) -> DataFrame:
    counts = frequency(users, "address_country", "users")
    return top(counts, n, F.desc("users"), F.asc("address_country"))


def float_audit(items: DataFrame, tolerance: float = 0.001, n: int = 10) -> DataFrame:
    """Lines whose stated total is furthest from price times quantity."""
    gap = F.abs("line_total_discrepancy")
    found = items.filter(gap > tolerance).select(
        "cart_id",
        "product_id",
        "product_title",
        "line_total",
        "line_total_recomputed",
        "line_total_discrepancy",
    )
    return top(found, n, F.desc(gap), F.asc("cart_id"), F.asc("product_id"))


def top_products_sold(items: DataFrame, n: int = 10, unique_lines: bool = False) -> DataFrame:
    sold = items.groupBy("product_id", "product_title").agg(
        F.sum("quantity").alias("total_qty_sold"),
        count_carts(unique_lines).alias("carts_appeared_in"),
        exact_mean("unit_price", 2).alias("avg_unit_price"),
    )
    return top(sold, n, F.desc("total_qty_sold"), F.asc("product_id"), F.asc("product_title"))


def cart_overview(items: DataFrame, unique_lines: bool = False) -> DataFrame:
    """Averages over carts."""
    lines = F.count("product_id") if unique_lines else F.count_distinct("product_id")
    carts = items.groupBy("cart_id").agg(
        lines.alias("lines"),
        F.sum("quantity").alias("units"),
        F.sum(exact("line_total")).alias("total"),
        F.sum(exact("line_discounted_total")).alias("discounted_total"),
    )
    return carts.agg(
        F.count("cart_id").alias("total_carts"),
        ratio(F.sum("lines"), F.count("lines"), 1).alias("avg_products_per_cart"),
        ratio(F.sum("units"), F.count("units"), 1).alias("avg_quantity_per_cart"),
        ratio(F.sum("total"), F.count("total"), 2).alias("avg_cart_total"),
        ratio(F.sum("discounted_total"), F.count("discounted_total"), 2).alias(
            "avg_after_discount"
        ),
    )


def revenue_by_category(items: DataFrame, products: DataFrame) -> DataFrame:
    catalogue = products.select(F.col("id").alias("product_id"), "category", "rating")
    return (
        items.join(catalogue, "product_id")
        .groupBy("category")
        .agg(
            F.count_distinct("cart_id").alias("carts"),
            F.sum("quantity").alias("units_sold"),
            exact_sum("line_discounted_total", 2).alias("revenue"),
            exact_mean("rating", 2).alias("avg_product_rating"),
        )
        .orderBy(F.desc("revenue"), "category")
    )


def top_spenders(users: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    people = users.select(
        F.col("id").alias("user_id"),
        full_name("first_name", "last_name").alias("full_name"),
        "address_country",
    )
    figures = user_purchases(items).select(
        "user_id", "total_carts", "total_items_bought", "total_spend"
    )
    return top(people.join(figures, "user_id"), n, F.desc("total_spend"), F.asc("user_id"))


def basket_by_age_band(users: DataFrame, items: DataFrame) -> DataFrame:
    bands = users.select(
        F.col("id").alias("user_id"), age_band(F.col("age_derived")).alias("age_group")
    )
    return (
        cart_totals(items)
        .join(bands, "user_id")
        .groupBy("age_group")
        .agg(
            F.count_distinct("cart_id").alias("carts"),
            ratio(F.sum("cart_quantity"), F.count("cart_quantity"), 1).alias("avg_basket_size"),
            ratio(F.sum("cart_spend"), F.count("cart_spend"), 2).alias("avg_cart_value"),
        )
        .orderBy("age_group")
    )


def nearly_out_of_stock(products: DataFrame, items: DataFrame, below: int = 5) -> DataFrame:
    """Products in carts whose stock is nearly used up by them."""
    demand = pending_demand(items).withColumnRenamed("product_id", "id")
    return (
        products.select("id", "title", "category", "stock")
        .join(demand, "id")
        .withColumn("net_stock", F.col("stock") - F.col("pending_demand"))
        .filter(F.col("net_stock") < below)
        .orderBy("net_stock", "id")
    )


# Reports by name, each over the stored silver tables.
REPORTS = {
    "health_check": lambda t: health_check(t),
    "products_audit": lambda t: products_audit(t["products"]),
    "category_distribution": lambda t: category_distribution(t["products"]),
    "most_expensive": lambda t: most_expensive(t["products"]),
    "age_discrepancies": lambda t: age_discrepancies(t["users"]),
    "gender_distribution": lambda t: gender_distribution(t["users"]),
    "top_countries": lambda t: top_countries(t["users"]),
    "role_distribution": lambda t: role_distribution(t["users"]),
    "float_audit": lambda t: float_audit(t["cart_items"]),
    "top_products_sold": lambda t: top_products_sold(t["cart_items"], unique_lines=True),
    "cart_overview": lambda t: cart_overview(t["cart_items"], unique_lines=True),
    "revenue_by_category": lambda t: revenue_by_category(t["cart_items"], t["products"]),
    "top_spenders": lambda t: top_spenders(t["users"], t["cart_items"]),
    "basket_by_age_band": lambda t: basket_by_age_band(t["users"], t["cart_items"]),
    "nearly_out_of_stock": lambda t: nearly_out_of_stock(t["products"], t["cart_items"]),
}
