"""Plans: what is read, what is shuffled, and how skew is met."""

import re

import pytest
from pyspark.sql import functions as F

from shoplake.operators import quality
from shoplake.plans import dashboard, gold, reports
from shoplake.sources.tables import SILVER, read_layer, save_table, table_path


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Stored silver tables where one user and one product hold a third of the lines."""
    root = str(tmp_path_factory.mktemp("lake"))
    n = 60_000
    lines = spark.range(n).select(
        F.col("id").alias("cart_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("user_id"),
        F.when(F.col("id") % 3 == 1, 11).otherwise(F.col("id") % 200).alias("product_id"),
        F.lit("t").alias("product_title"),
        F.lit(2.5).alias("unit_price"),
        (F.col("id") % 5 + 1).cast("int").alias("quantity"),
        F.lit(2.5).alias("line_total"),
        F.lit(1.0).alias("discount_percentage"),
        F.lit(2.25).alias("line_discounted_total"),
        F.lit(2.5).alias("line_total_recomputed"),
        F.lit(0.0).alias("line_total_discrepancy"),
        F.current_timestamp().alias("silver_processed_at"),
        F.lit("bronze").alias("source_layer"),
    )
    products = spark.range(190).select(
        "id",
        *[F.lit("x").alias(c) for c in ("title", "description", "brand", "sku")],
        F.lit("in stock").alias("availability_status"),
        F.lit(3.0).alias("price"),
        F.lit(1.0).alias("discount_percentage"),
        F.lit(4.0).alias("rating"),
        F.lit(100).alias("stock"),
        F.lit(1.0).alias("weight"),
        F.concat(F.lit("c"), F.col("id") % 4).alias("category"),
        F.current_timestamp().alias("silver_processed_at"),
        F.lit("bronze").alias("source_layer"),
    )
    save_table(lines, table_path(root, "cart_items"))
    save_table(products, table_path(root, "products"), ["category"])
    return read_layer(spark, root, [n for n in SILVER if n in ("cart_items", "products")])


@pytest.fixture
def large_joins(spark):
    """Plan joins as for tables too large to broadcast, with partitions small enough to see
    adaptive execution at work."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_schemas(df):
    return " ".join(re.findall(r"ReadSchema: struct<([^>]*)", plan(df)))


def test_only_needed_columns_are_read(tables):
    columns = read_schemas(gold.pending_demand(tables["cart_items"]))
    assert columns == "product_id:bigint,quantity:int"


def test_filters_reach_the_files(tables):
    dear = tables["products"].filter("price > 100 and category = 'c1'").select("id")
    assert "GreaterThan(price,100.0)" in plan(dear)
    assert "PartitionFilters: [isnotnull(category" in plan(dear)


def test_sums_are_combined_before_the_shuffle(tables):
    for df in (
        gold.pending_demand(tables["cart_items"]),
        gold.discount_aggregate(tables["cart_items"]),
        gold.cart_totals(tables["cart_items"]),
    ):
        text = plan(df)
        assert text.count("Exchange") == 1 and "SortAggregate" not in text
        assert text.index("Exchange") < text.index("partial_sum")


def test_demand_needs_no_expansion(tables):
    text = plan(gold.product_demand(tables["cart_items"]))
    assert "Expand" not in text
    # Carts and buyers, each combined before it moves, and then by product.
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 4
    assert "Expand" not in plan(gold.product_demand(tables["cart_items"], unique_lines=True))


def test_favourite_category_takes_one_join(tables):
    text = plan(gold.favourite_category(tables["cart_items"], tables["products"]))
    assert len(re.findall(r"\w+Join\b", text)) == 1
    assert text.count("FileScan") == 2
    assert text.count("WindowGroupLimit") == 2


def test_top_k_does_not_sort_everything(tables):
    assert "TakeOrderedAndProject" in plan(reports.top_products_sold(tables["cart_items"]))
    assert "TakeOrderedAndProject" in plan(reports.most_expensive(tables["products"]))


def test_no_query_joins_without_a_key(tables):
    items, products = tables["cart_items"], tables["products"]
    for df in (
        gold.product_performance(products, items),
        gold.stock_risk(products, items),
        reports.revenue_by_category(items, products),
        reports.nearly_out_of_stock(products, items),
    ):
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_a_hot_product_is_split_in_the_join(tables, large_joins, rows):
    items, products = tables["cart_items"], tables["products"]
    df = gold.category_quantities(items.repartition(12), products)
    total = sum(r.qty_in_category for r in df.collect())
    assert total == items.agg(F.sum("quantity")).first()[0]
    assert "SortMergeJoin(skew=true)" in plan(df)


def test_risk_from_performance_reads_no_lines(tables):
    performance = gold.product_performance(tables["products"], tables["cart_items"])
    risk = gold.stock_risk_of(performance.select("*"))
    columns = gold.stock_risk(tables["products"], tables["cart_items"]).columns
    assert risk.columns == columns
    theirs = gold.stock_risk(tables["products"], tables["cart_items"]).drop("gold_processed_at")
    assert risk.drop("gold_processed_at").exceptAll(theirs).isEmpty()


def test_customer_panels_need_no_favourite_category(tables, spark):
    users = spark.range(500).select(
        "id", *[F.lit("x").alias(c) for c in ("first_name", "last_name", "email")]
    )
    text = plan(dashboard.top_customers_panel(gold.customer_spend(users, tables["cart_items"])))
    assert "category" not in text and "product_id" not in text
    assert len(re.findall(r"\w+Join\b", text)) == 1


def test_stage_counts_sort_no_structs(tables):
    counts = quality.stage_counts(
        tables["cart_items"], ["cart_id", "product_id"], {"sold": F.col("quantity") > 0}
    )
    assert "SortAggregate" not in plan(counts)


def test_a_hot_key_is_split_before_grouping_by_something_else(tables, large_joins, spark):
    items, products = tables["cart_items"].repartition(12), tables["products"]
    revenue = reports.revenue_by_category(items, products)
    units = sum(r.units_sold for r in revenue.collect())
    assert units == items.filter("product_id < 190").agg(F.sum("quantity")).first()[0]
    assert "SortMergeJoin(skew=true)" in plan(revenue)

    users = spark.range(500).select("id", (F.col("id") % 60 + 16).cast("int").alias("age_derived"))
    baskets = reports.basket_by_age_band(users, items)
    assert sum(r.carts for r in baskets.collect()) == 60_000
    assert "SortMergeJoin(skew=true)" in plan(baskets)


def test_hot_keys_reach_catalogue_joins_as_one_row(tables, large_joins):
    items, products = tables["cart_items"], tables["products"]
    text = plan(reports.nearly_out_of_stock(products, items))
    # The lines are summed up below the join.
    assert text.index("SortMergeJoin") < text.index("partial_sum")
    df = gold.stock_risk(products, items)
    demand = {r.product_id: r.pending_demand for r in df.collect()}
    expected = items.filter("product_id = 11").agg(F.sum("quantity")).first()[0]
    assert demand[11] == expected
