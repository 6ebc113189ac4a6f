import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F

from shoplake.operators import quality
from shoplake.plans import silver
from shoplake.sources.tables import read_reports, save_report

RUN_TS = dt.datetime(2025, 1, 1, 6)


def product_changes(samples):
    base = samples["products"]
    changes = [{}, {}, {"id": 2, "price": 0, "rating": 9}, {"id": None, "category": None}]
    changes += [{"id": 3, "stock": -1}, {"id": 4, "price": None}, {"id": 5}]
    return [base | change for change in changes]


EXPECTED = {
    ("steps", "01_after_bronze_read", 7),
    ("steps", "02_after_cleaning", 7),
    ("steps", "03_after_dedup", 6),
    ("steps", "04_after_quality_filters", 2),
    ("dropped", "duplicates", 1),
    ("dropped", "failed_quality_filters", 4),
    ("dropped", "total", 5),
    ("rejected", "id_present", 1),
    ("rejected", "price_positive", 2),
    ("rejected", "rating_0_to_5", 0),
    ("rejected", "stock_not_negative", 1),
    ("rejected", "discount_0_to_100", 0),
    ("rejected", "amounts_in_range", 0),
    ("nulls", "id", 1),
    ("nulls", "price", 1),
    ("nulls", "category", 1),
}


def test_counts_by_query_and_by_observation(raw, samples, tmp_path, spark):
    table = silver.PRODUCTS
    assessed = table.assess(silver.clean_products(raw("products", product_changes(samples))))
    metrics = quality.stage_metrics(table.rules(), table.watched)
    found = {tuple(r) for r in quality.as_rows(assessed.agg(*metrics)).collect()}
    assert found == EXPECTED
    cleaned = silver.clean_products(raw("products", product_changes(samples)))
    counts = quality.stage_counts(cleaned, table.keys, table.rules(), table.watched)
    assert {tuple(r) for r in quality.as_rows(counts).collect()} == EXPECTED

    seen = Observation()
    assessed.observe(seen, *metrics).write.format("noop").mode("overwrite").save()
    report = quality.report_frame(spark, RUN_TS, {"products_silver": seen.get})
    save_report(report, str(tmp_path))
    save_report(report, str(tmp_path))
    stored = read_reports(spark, str(tmp_path))
    assert stored.count() == len(EXPECTED)
    assert all(r.note for r in stored.collect())
    later = report.withColumn("run_ts", F.lit(RUN_TS + dt.timedelta(microseconds=1)))
    save_report(later, str(tmp_path))
    assert read_reports(spark, str(tmp_path)).count() == 2 * len(EXPECTED)
    assert {tuple(r) for r in stored.select("section", "name", "value").collect()} == EXPECTED
    assert stored.select("pipeline", "run_ts").distinct().collect() == [
        ("products_silver", RUN_TS)
    ]


def test_counts_add_up(raw, samples):
    table = silver.PRODUCTS
    assessed = table.assess(silver.clean_products(raw("products", product_changes(samples))))
    counts = assessed.agg(*quality.stage_metrics(table.rules())).first().asDict()
    rejected = sum(v for k, v in counts.items() if k.startswith("rejected/"))
    assert rejected == counts["dropped/failed_quality_filters"]
    assert (
        counts["steps/04_after_quality_filters"] + counts["dropped/total"]
        == counts["steps/01_after_bronze_read"]
    )


def test_nothing_to_count(raw):
    assessed = silver.PRODUCTS.assess(silver.clean_products(raw("products", [])))
    metrics = quality.stage_metrics(silver.product_rules(), silver.PRODUCTS.watched)
    values = {r.value for r in quality.as_rows(assessed.agg(*metrics)).collect()}
    assert values == {0}


def test_null_summary_names_columns_with_nulls(spark, rows):
    df = spark.createDataFrame([(1, None, "x"), (None, None, "y")], "a int, b int, c string")
    assert rows(quality.null_summary(df)) == [("a", 1), ("b", 2)]
    assert rows(quality.null_summary(df, ["a", "c"])) == [("a", 1)]


def test_health_and_schema(spark, rows):
    tables = {
        "one": spark.createDataFrame([(1, "a")], "x int, y string"),
        "two": spark.createDataFrame([], "z array<int>"),
    }
    assert rows(quality.health_check(tables)) == [("one", 1, 2), ("two", 0, 1)]
    assert rows(quality.schema_report(tables)) == [
        ("one", 1, "x", "int"),
        ("one", 2, "y", "string"),
        ("two", 1, "z", "array<int>"),
    ]
