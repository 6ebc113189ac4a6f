import datetime as dt
import json
import os
import time
from unittest import mock

import pytest
from pyspark.sql import functions as F

from harness import queries as harness_queries
from harness import views
from shoplake.plans import dashboard, gold, pipeline, reports
from shoplake.sources import bronze
from shoplake.sources.jdbc import jdbc_config, write_jdbc
from shoplake.sources.session import CLEANUP, scratch_dir, shuffles_dropped
from shoplake.sources import tables, versions
from shoplake.sources.tables import (
    lines_by_user,
    read_layer,
    read_table,
    register_views,
    save_lines_by_user,
    save_table,
    table_path,
    partitions_with,
    read_user_lines,
    user_bucket,
    with_user_bucket,
)
from shoplake.sources.versions import current, drop_old_versions

RUN_TS = dt.datetime(2025, 1, 1, 6)


def folders(spark, path):
    return sorted(name for name in os.listdir(current(spark, path)) if "=" in name)


# --- raw JSON ---------------------------------------------------------------------------


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_documents_in_several_files(spark, tmp_path, samples):
    for n in (1, 2):
        doc = {"products": [samples["products"] | {"id": n}, samples["products"]]}
        put(tmp_path / "in", f"{n}.json", json.dumps(doc, indent=2))
    put(tmp_path / "in", "none.json", '{"products": []}')
    put(tmp_path / "in", "null.json", '{"products": null}')
    assert bronze.read_records(spark, str(tmp_path / "in"), "products").count() == 4


def test_numbers_and_text_mix(raw, samples):
    records = [samples["products"] | {"id": i} for i in (1, "2", 3.0, "x", None)]
    found = {r.id for r in raw("products", records).select("id").collect()}
    assert found == {"1", "2", "3.0", "x", None}


def test_unknown_layout(spark):
    with pytest.raises(ValueError):
        bronze.read_records(spark, "/nowhere", "products", "csv")


def test_raw_counts(raw, samples, rows):
    line, cart = samples["line"], samples["carts"]
    carts = raw(
        "carts",
        [cart | {"products": [line, line]}, cart | {"products": []}, cart | {"products": None}],
    )
    counts = reports.bronze_counts(
        raw("products", [samples["products"]]), raw("users", [samples["users"]] * 2), carts
    )
    assert dict(rows(counts)) == {"products": 1, "users": 2, "carts": 3, "cart_lines": 2}
    empty = reports.bronze_counts(raw("products", []), raw("users", []), raw("carts", []))
    assert {r.records for r in empty.collect()} == {0}


@pytest.mark.parametrize("layout", ["documents", "lines"])
def test_landing_keeps_the_text_and_counts(spark, tmp_path, samples, layout):
    sources = {}
    for entity, n in (("products", 3), ("users", 2)):
        records = [samples[entity] | {"id": i, "extra": "kept é"} for i in range(n)]
        sources[entity] = str(tmp_path / "in" / entity)
        if layout == "documents":
            put(tmp_path / "in" / entity, "a.json", json.dumps({entity: records[:1]}, indent=1))
            put(tmp_path / "in" / entity, "b.json", json.dumps({entity: records[1:]}, indent=1))
        else:
            put(tmp_path / "in" / entity, "a.json", "\n".join(map(json.dumps, records)))
    root = str(tmp_path / "bronze")
    landed = bronze.land(spark, sources, root, layout, RUN_TS)
    found = {r.entity: r for r in landed.collect()}
    assert {e: (r.status, r.record_count, r.malformed_count) for e, r in found.items()} == {
        "products": ("ok", 3, 0),
        "users": ("ok", 2, 0),
    }
    assert found["users"].path == f"{root}/users" and found["users"].run_ts == RUN_TS
    before = sorted(spark.read.text(sources["products"]).toPandas().value)
    after = sorted(spark.read.text(f"{root}/products").toPandas().value)
    assert [t for t in after if t] == [t for t in before if t]
    records = bronze.read_records(spark, f"{root}/products", "products", layout)
    assert sorted(r.id for r in records.collect()) == ["0", "1", "2"]


def test_malformed_lines_are_counted(spark, tmp_path, samples):
    good = json.dumps(samples["products"])
    put(tmp_path / "in", "a.json", f'{good}\n{{"id": 5, \n\n{good}')
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    assert bronze.copy_raw(spark, source, target, "products", "lines") == (2, 1)
    put(tmp_path / "doc", "a.json", '{"products": [{"id": 1}]}')
    put(tmp_path / "doc", "b.json", '{"products": [')
    put(tmp_path / "doc", "c.json", '{"products": null}')
    assert bronze.copy_raw(spark, str(tmp_path / "doc"), target, "products") == (1, 1)
    with pytest.raises(ValueError):
        bronze.copy_raw(spark, source, target, "products", "csv")
    with pytest.raises(Exception, match="(?i)malformed|corrupt"):
        bronze.read_records(spark, source, "products", "lines").collect()
    with pytest.raises(ValueError):
        bronze.read_records(spark, source, "products", "lines", "skip")


@pytest.mark.parametrize("layout", ["documents", "lines"])
def test_malformed_input_stops_the_read_or_is_set_aside(spark, tmp_path, samples, layout):
    cart = json.dumps(samples["carts"])
    if layout == "lines":
        put(tmp_path / "in", "a.json", f"{cart}\n{cart[:-9]}\n{cart}\n{{")
    else:
        put(tmp_path / "in", "a.json", f'{{"carts": [{cart}, {cart}]}}')
        put(tmp_path / "in", "b.json", f'{{"carts": [{", ".join([cart] * 48)}'[:-20])
        put(tmp_path / "in", "c.json", "{")
    source, target = str(tmp_path / "in"), str(tmp_path / "aside")
    with pytest.raises(Exception, match="(?i)malformed|corrupt"):
        bronze.read_records(spark, source, "carts", layout).collect()
    read = bronze.read_records(spark, source, "carts", layout, "aside")
    assert read.count() == 2 and "_corrupt_record" not in read.columns
    assert {r.id for r in read.collect()} == {"1"}
    assert bronze.set_aside(spark, source, "carts", layout, target) == 2
    kept = " ".join(r.value for r in spark.read.text(target).collect())
    assert kept.count("discountedTotal") > 1
    landed = bronze.land(spark, {"carts": source}, str(tmp_path / "bronze"), layout, RUN_TS).first()
    assert (landed.status, landed.record_count, landed.malformed_count) == ("malformed", 2, 2)


def test_records_of_documents_are_spread(spark, raw, samples):
    found = raw("products", [samples["products"] | {"id": i} for i in range(9)])
    assert "REBALANCE_PARTITIONS_BY_NONE" in found._jdf.queryExecution().toString()


def test_a_document_is_read_once_or_so(spark, samples, tmp_path):
    """Not once more for each number in it, and also where Spark cuts the file into ranges."""
    records = [samples["products"] | {"id": i, "price": 1, "sku": "@"} for i in range(4000)]
    # Numbers keep the text they have.
    text = json.dumps({"products": records}).replace('"@"', "1.50")
    put(tmp_path / "in", "a.json", text)
    put(tmp_path / "in", "empty.json", "")
    found = bronze.read_records(spark, str(tmp_path / "in"), "products")
    files = spark._jvm.org.apache.hadoop.fs.FileSystem

    def read():
        return sum(s.getBytesRead() for s in files.getAllStatistics() if s.getScheme() == "file")

    before = read()
    rows = found.collect()
    assert read() - before < 3 * len(text)
    assert sorted(int(r.id) for r in rows) == list(range(4000)) and {r.sku for r in rows} == {"1.50"}
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    assert session.read.text(str(tmp_path / "in")).rdd.getNumPartitions() > 5
    cut = bronze.read_records(session, str(tmp_path / "in"), "products")
    assert sorted(cut.collect()) == sorted(rows)


def test_landed_lines_are_compressed(spark, tmp_path, samples):
    text = "\n".join(json.dumps(samples["carts"] | {"id": i}) for i in range(3000))
    put(tmp_path / "in", "a.json", text + '\n{"id": ')
    target = str(tmp_path / "out")
    assert bronze.copy_raw(spark, str(tmp_path / "in"), target, "carts", "lines") == (3000, 1)
    assert sum(os.path.getsize(f"{target}/{f}") for f in os.listdir(target)) < len(text) / 3
    found = bronze.read_records(spark, target, "carts", "lines", "aside")
    assert sorted(int(r.id) for r in found.select("id").collect()) == list(range(3000))
    assert [r.value for r in bronze.read_malformed(spark, target, "carts", "lines").collect()] == ['{"id": ']


@pytest.mark.parametrize("query", ["silver_products_from_json", "malformed_counts", "landing_manifest", "file_manifest", "incremental_landing"])
def test_queries_write_their_lines_compressed(spark, tmp_path, query, monkeypatch):
    monkeypatch.setattr(harness_queries, "scratch_dir", lambda _: str(tmp_path / "out"))
    harness_queries.queries()[query](spark, "/root/testdata/sf0.001").collect()
    folders = [d for d in (tmp_path / "out").rglob("*") if d.is_dir() and d.name != "ingestion_manifest"]
    lines = [f.name for d in folders for f in d.iterdir() if f.name.startswith("part-") and "parquet" not in f.name]
    assert lines and all(name.endswith(".gz") for name in lines)


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if "shuffle_" in found.apply(i).getName()}


def test_written_tables_leave_no_files_of_their_shuffles(spark, tmp_path, samples, raw):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP)
    records = [samples["products"] | {"id": i % 50} for i in range(200)]
    carts = [samples["carts"] | {"id": i} for i in range(90)]
    found = {"products": records, "users": [samples["users"]], "carts": carts}
    written = pipeline.write_silver({e: raw(e, r, "lines") for e, r in found.items()}, str(tmp_path), RUN_TS.date(), RUN_TS)
    assert written["products"]["dropped/duplicates"] == 150 and written["cart_items"]["steps/05_written"] == 90
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(CLEANUP) == setting
    assert read_layer(spark, str(tmp_path), ["products"])["products"].count() == 50


def test_shuffles_are_dropped_only_while_something_is_written(spark):
    session = spark.newSession()
    session.conf.set(CLEANUP, "false")
    with shuffles_dropped(session):
        with pytest.raises(KeyError), shuffles_dropped(session):
            raise KeyError
        assert session.conf.get(CLEANUP) == "true" and spark.conf.get(CLEANUP) == "false"
    assert session.conf.get(CLEANUP) == "false"


def test_documents_are_written_compressed_and_of_whole_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(harness_queries, "scratch_dir", lambda _: str(tmp_path / "out"))
    found = harness_queries.queries()["silver_cart_items_from_documents"](spark, "/root/testdata/sf0.001")
    files = [f for f in (tmp_path / "out" / "carts").iterdir() if f.name.startswith("part-")]
    assert files and all(f.name.endswith(".gz") for f in files)
    expected = harness_queries.queries()["silver_cart_items"](spark, "/root/testdata/sf0.001")
    assert sorted(found.collect()) == sorted(expected.collect())


def test_orders_and_lines_move_once_on_their_way_to_documents(spark, tmp_path):
    """Also those without an id, in whatever partitions they come, and each range is one document."""
    order = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
    keys = [*range(70), None, None]
    orders = [(k, i % 5, "O", 10.0 + i) for i, k in enumerate(keys)]
    spark.createDataFrame(orders, order).write.parquet(str(tmp_path / "orders.parquet"))
    names = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    names += "l_extendedprice double, l_discount double"
    lines = [(k, i, 1, i % 7 + 1, 2.0, 8.0 + i, 0.1) for i in range(300) for k in [keys[i % 72]]]
    spark.createDataFrame(lines, names).write.parquet(str(tmp_path / "lineitem.parquet"))
    for session in (spark, harness_queries._building(spark)):
        plain = views.bronze_carts(session, str(tmp_path))
        parts = views.bronze_carts(session, str(tmp_path), 10)
        assert sorted(map(str, parts.drop("part").collect())) == sorted(map(str, plain.collect()))
        grouped = parts.groupBy("part").agg(F.collect_list("id").alias("ids"))
        found = {r.part: r.ids for r in grouped.collect()}
        assert grouped.count() == len(found) and {p for p in found if p >= 0} == set(range(7))
        assert all(i // 10 == p for p, ids in found.items() if p >= 0 for i in ids)
    text = grouped._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "ObjectHashAggregate" in text and "ENSURE_REQUIREMENTS" not in text


def test_records_of_many_documents_stay_where_they_were_parsed(spark, tmp_path, samples):
    for i in range(3 * spark.sparkContext.defaultParallelism):
        put(tmp_path / "in", f"{i}.json", json.dumps({"products": [samples["products"] | {"id": i + 100}]}))
    found = bronze.read_records(spark, str(tmp_path / "in"), "products")
    assert "REBALANCE" not in found._jdf.queryExecution().toString()
    assert found.count() == 3 * spark.sparkContext.defaultParallelism
    put(tmp_path / "in", "large.json", json.dumps({"products": [samples["products"]] * 9}))
    found = bronze.read_records(spark, str(tmp_path / "in"), "products")
    assert "REBALANCE" in found._jdf.queryExecution().toString()


def test_a_failed_landing_is_recorded_and_raised(spark, tmp_path, samples):
    put(tmp_path / "in", "a.json", json.dumps({"products": [samples["products"]]}))
    sources = {"products": str(tmp_path / "in"), "users": str(tmp_path / "missing")}
    root = str(tmp_path / "bronze")
    with pytest.raises(Exception, match="missing"):
        bronze.land(spark, sources, root, run_ts=RUN_TS)
    found = {r.entity: r for r in bronze.read_manifest(spark, root).collect()}
    assert found["products"].status == "ok" and found["users"].status == "failed"
    assert "missing" in found["users"].error


# --- tables -----------------------------------------------------------------------------


def risk_rows(spark, n=40):
    levels = F.array(*[F.lit(x) for x in ("critical", "high", "medium", "healthy")])
    return spark.range(n).select(
        F.col("id").alias("product_id"),
        F.lit("t").alias("title"),
        F.when(F.col("id") % 2 == 0, "001").otherwise("7").alias("category"),
        *[F.lit("x").alias(c) for c in ("brand", "sku", "availability_status")],
        F.lit(1).alias("current_stock"),
        F.lit(2).cast("bigint").alias("pending_demand"),
        F.lit(-1).cast("bigint").alias("net_stock"),
        F.lit(0.5).alias("stock_coverage_ratio"),
        F.lit(RUN_TS).alias("gold_processed_at"),
        F.lit("silver").alias("source_layer"),
        levels[(F.col("id") % 4).cast("int")].alias("risk_level"),
    )


def test_round_trip_with_partitions(spark, tmp_path, rows):
    df, path = risk_rows(spark).repartition(4), str(tmp_path / "t")
    save_table(df, path, ["risk_level"])
    assert folders(spark, path) == [f"risk_level={x}" for x in ("critical", "healthy", "high", "medium")]
    assert rows(read_table(spark, path, "stock_risk").select(df.columns)) == rows(df)
    # Each partition value was gathered into one file.
    for folder in folders(spark, path):
        assert sum(f.endswith(".parquet") for f in os.listdir(f"{current(spark, path)}/{folder}")) == 1

    save_table(df.limit(3), path, ["risk_level"])
    assert read_table(spark, path, "stock_risk").count() == 3


def test_partition_values_are_not_retyped(spark, tmp_path):
    path = str(tmp_path / "t")
    save_table(risk_rows(spark), path, ["category"])
    found = read_table(spark, path, "stock_risk").select("category").distinct()
    assert sorted(r.category for r in found.collect()) == ["001", "7"]


def test_alert_panel_reads_two_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    save_table(risk_rows(spark), path, ["risk_level"])
    alert = dashboard.stock_alert_panel(read_table(spark, path, "stock_risk"))
    plan = alert._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [risk_level" in plan
    assert len(alert.inputFiles()) == 4 and alert.count() == 20
    files = alert.select(F.input_file_name().alias("f")).distinct().count()
    assert files == 2


def test_a_large_partition_value_is_split(spark, tmp_path):
    """One value with most rows is written by several tasks."""
    df = spark.range(400_000).select(
        F.when(F.col("id") % 10 < 9, "big").otherwise("small").alias("risk_level"),
        F.sha2(F.col("id").cast("string"), 256).alias("title"),
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        save_table(df, str(tmp_path / "t"), ["risk_level"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    found = current(spark, str(tmp_path / "t"))
    assert sum(f.endswith(".parquet") for f in os.listdir(f"{found}/risk_level=big")) > 2
    assert spark.read.parquet(found).count() == 400_000


def items(spark):
    return spark.range(100).select(
        F.col("id").alias("cart_id"),
        F.when(F.col("id") % 10 > 0, F.col("id") % 10).alias("user_id"),
        F.col("id").alias("product_id"),
        F.lit("t").alias("product_title"),
        *[F.lit(1.0).alias(c) for c in ("unit_price", "line_total", "discount_percentage")],
        F.lit(1).alias("quantity"),
        *[
            F.lit(1.0).alias(c)
            for c in (
                "line_discounted_total",
                "line_total_recomputed",
                "line_total_discrepancy",
            )
        ],
        F.lit(RUN_TS).alias("silver_processed_at"),
        F.lit("bronze").alias("source_layer"),
    )


def test_lines_by_bucket_or_by_user(spark, tmp_path, rows):
    df, columns = items(spark), ["cart_id", "user_id", "unit_price", "source_layer"]
    for name, frame, by in (
        ("bucket", with_user_bucket(df, user_bucket(4)), [user_bucket(4)]),
        ("user", df, ["user_id"]),
    ):
        path = str(tmp_path / name)
        save_table(frame, path, by)
        found = read_table(spark, path, "cart_items")
        assert sorted(found.columns) == sorted(df.columns)
        assert rows(found, *columns) == rows(df, *columns)
    assert len(folders(spark, str(tmp_path / "bucket"))) <= 5
    assert len(folders(spark, str(tmp_path / "user"))) == 10


@pytest.mark.parametrize("buckets", [1, 5])
def test_lines_of_a_user_come_from_one_bucket(spark, tmp_path, rows, buckets):
    df = items(spark)
    path = table_path(str(tmp_path), "cart_items")
    by = partitions_with(buckets)["cart_items"]
    save_table(with_user_bucket(df, *by), path, by)
    found = read_user_lines(spark, str(tmp_path), 7)
    assert sorted(found.columns) == sorted(df.columns)
    assert rows(found, "cart_id") == [(i,) for i in range(7, 100, 10)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({by[0]}" in plan
    assert read_user_lines(spark, str(tmp_path), 10**9).count() == 0


def test_views_answer_sql(spark, tmp_path, rows):
    save_table(items(spark), table_path(str(tmp_path), "cart_items"), [])
    spark.range(1).createOrReplaceTempView("cart_items")
    register_views(spark, str(tmp_path), ["cart_items"], "my_")
    assert spark.table("cart_items").columns == ["id"] and spark.table("my_cart_items").count() == 100
    register_views(spark, str(tmp_path), ["cart_items"])
    found = spark.sql(
        "select user_id, sum(quantity) as units from cart_items group by user_id having units > 5"
    )
    assert len(rows(found)) == 10
    described = {r.col_name: r.data_type for r in spark.sql("describe cart_items").collect()}
    assert described["user_id"] == "bigint" and described["quantity"] == "int"


def test_scratch_folder_is_the_shared_one(spark):
    one, two = scratch_dir(spark), scratch_dir(spark)
    assert one != two
    assert one.startswith(spark.conf.get("spark.checkpoint.dir"))


# --- database ---------------------------------------------------------------------------

ENV = {"POSTGRES_DB": "shop", "POSTGRES_USER": "me", "POSTGRES_PASSWORD": "p"}


def test_jdbc_config():
    assert jdbc_config(ENV) == {
        "url": "jdbc:postgresql://localhost:5432/shop",
        "user": "me",
        "password": "p",
        "driver": "org.postgresql.Driver",
    }
    env = ENV | {"POSTGRES_HOST": "h", "POSTGRES_PORT": "1", "POSTGRES_USER": "u"}
    assert jdbc_config(env)["url"] == "jdbc:postgresql://h:1/shop"
    assert jdbc_config(env)["user"] == "u"
    with pytest.raises(ValueError, match="POSTGRES_PASSWORD"):
        jdbc_config({"POSTGRES_DB": "shop"})


def test_jdbc_writer_settings():
    df = mock.MagicMock()
    writer = df.write.format.return_value
    writer.options.return_value = writer.option.return_value = writer
    writer.mode.return_value = writer
    write_jdbc(df, "gold_t", "append", jdbc_config(ENV), batch_size=500)
    df.write.format.assert_called_once_with("jdbc")
    writer.options.assert_called_once_with(**jdbc_config(ENV))
    options = {call.args[0]: call.args[1] for call in writer.option.call_args_list}
    assert options == {
        "dbtable": "gold_t",
        "batchsize": 500,
        "numPartitions": 8,
        "truncate": False,
    }
    writer.mode.assert_called_once_with("append")
    writer.save.assert_called_once_with()
    with pytest.raises(ValueError):
        write_jdbc(df, "gold_t", "ignore", jdbc_config(ENV))


# --- files ------------------------------------------------------------------------------


@pytest.mark.parametrize("layout", ["documents", "lines"])
def test_records_say_which_file_they_are_from(spark, tmp_path, samples, layout):
    def text(ids):
        records = [samples["products"] | {"id": i} for i in ids]
        return json.dumps({"products": records}) if layout == "documents" else "\n".join(map(json.dumps, records)) + "\n"

    for name, ids in (("a.json", [1, 2]), ("b.json", [3]), ("c.json", [])):
        put(tmp_path / "in", name, text(ids))
    found = bronze.read_records(spark, str(tmp_path / "in"), "products", layout, provenance=True).collect()
    assert {int(r.id): os.path.basename(r.source_file) for r in found} == {1: "a.json", 2: "a.json", 3: "b.json"}
    assert all(r.source_size == os.path.getsize(tmp_path / "in" / os.path.basename(r.source_file)) for r in found)
    files = bronze.file_manifest(spark, str(tmp_path / "in"), "products", layout).collect()
    counts = {os.path.basename(r.source_file): r.record_count for r in files}
    assert counts == {"a.json": 2, "b.json": 1, "c.json": 0} and all(r.source_time for r in files)


@pytest.mark.parametrize("layout", bronze.LAYOUTS)
def test_only_new_files_are_landed(spark, tmp_path, samples, layout):
    def text(ids):
        records = [samples["products"] | {"id": i} for i in ids]
        return "\n".join(map(json.dumps, records)) if layout == "lines" else json.dumps({"products": records})

    sources, root = {"products": str(tmp_path / "in")}, str(tmp_path / "bronze")

    def land(day):
        (row,) = bronze.land_new(spark, sources, root, layout, dt.datetime(2025, 1, day)).collect()
        return row.files, row.record_count

    put(tmp_path / "in", "a b.json", text([1, 2]))
    assert land(1) == (1, 2)
    assert land(2) == (0, 0)
    put(tmp_path / "in", "c.json", text([3]))
    put(tmp_path / "in", "d.json", text([4, 5]))
    assert land(3) == (2, 3)
    put(tmp_path / "in", "c.json", text([3, 6]))
    assert land(4) == (1, 2)
    assert bronze.read_landed(spark, root).count() == 4
    kept = "documents" if layout == "documents" else "lines"
    read = bronze.read_records(spark, f"{root}/products/*", "products", kept)
    assert sorted(int(r.id) for r in read.collect()) == [1, 2, 3, 3, 4, 5, 6]


# --- replacing a table ------------------------------------------------------------------


def test_a_write_that_ends_halfway_leaves_the_table(spark, tmp_path, rows, monkeypatch):
    path, df = str(tmp_path / "t"), risk_rows(spark)
    save_table(df, path, ["risk_level"])
    before = rows(read_table(spark, path, "stock_risk"))

    def killed(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(tables, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            save_table(df.limit(3), path, ["risk_level"])
    assert rows(read_table(spark, path, "stock_risk")) == before
    with pytest.raises(Exception):
        save_table(df.withColumn("stock", F.raise_error(F.lit("lost"))), path, ["risk_level"])
    assert rows(read_table(spark, path, "stock_risk")) == before

    reading = read_table(spark, path, "stock_risk")
    save_table(df.limit(3), path, ["risk_level"])
    assert rows(reading) == before  # by whoever began to read before
    assert read_table(spark, path, "stock_risk").count() == 3
    assert drop_old_versions(spark, path) >= 2
    assert drop_old_versions(spark, path) == 0
    assert read_table(spark, path, "stock_risk").count() == 3


def test_plain_files_are_a_table_too(spark, tmp_path):
    risk_rows(spark).write.parquet(str(tmp_path / "t"))
    assert read_table(spark, str(tmp_path / "t"), "stock_risk").count() == risk_rows(spark).count()


def test_fingerprints_see_new_and_changed_files(spark, tmp_path):
    put(tmp_path / "in", "a.json", "{}")
    found = [versions.fingerprint(spark, str(tmp_path / "in"))]
    assert versions.fingerprint(spark, str(tmp_path / "in")) == found[0]
    put(tmp_path / "in", "b.json", "{}")
    found.append(versions.fingerprint(spark, str(tmp_path / "in")))
    put(tmp_path / "in", "b.json", '{"a": 1}')
    found.append(versions.fingerprint(spark, str(tmp_path / "in")))
    assert len(set(found)) == 3


# --- lines by user ----------------------------------------------------------------------


def test_lines_in_buckets_do_not_move(spark, tmp_path, rows):
    df = items(spark)
    stored = save_lines_by_user(df, str(tmp_path), "own_lines", buckets=4)
    assert rows(stored.select(df.columns)) == rows(df)
    for found in (stored, lines_by_user(spark, str(tmp_path), "same_lines")):
        assert rows(gold.user_cart_aggregate(found)) == rows(gold.user_cart_aggregate(df))
        plan = gold.user_cart_aggregate(found)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
    products = spark.range(100).select("id", F.lit("c").alias("category"))
    users = spark.range(20).select(
        "id", F.lit(30).alias("age_derived"),
        *[F.lit("x").alias(c) for c in "first_name last_name email gender address_city address_country "
          "company_department role".split()],
    )
    table = gold.customer_360(users, stored, products, RUN_TS)
    assert rows(table) == rows(gold.customer_360(users, df, products, RUN_TS))
    plan = table._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # The lines stay where they are: what moves are the users, at most.
    assert len(moved) <= 1 and all("cart_id" not in line and "category" not in line for line in moved)


def test_lines_without_a_user_are_written_by_all_tasks(spark, tmp_path, rows):
    df = items(spark).where("cart_id < 20").crossJoin(spark.range(200).select(F.col("id").alias("n")))
    no_user = F.when(F.col("cart_id") % 10 > 4, F.col("user_id"))
    df = df.withColumns({"cart_id": F.col("cart_id") * 200 + F.col("n"), "user_id": no_user}).drop("n")
    stored = save_lines_by_user(df, str(tmp_path), "lines_without", buckets=4)
    assert rows(stored.select(df.columns)) == rows(df)
    place = F.col("_metadata.file_path").alias("file")
    files = stored.select(place, F.isnull("user_id").alias("loose")).groupBy("file").agg(
        F.count_if("loose").alias("loose"), F.count(F.lit(1)).alias("n")).collect()
    told = sorted(f.loose for f in files if f.loose)
    assert len(told) == 4 and told[-1] < sum(told) / 2
    # A task writes its bucket, and its part of the lines without a user.
    assert len(files) <= 8
    users = stored.where("user_id is not null").select(place, "user_id").distinct()
    assert users.count() == 5
    plan = gold.user_cart_aggregate(stored)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert rows(gold.user_cart_aggregate(stored)) == rows(gold.user_cart_aggregate(df))


def test_no_lines_by_user(spark, tmp_path):
    with pytest.raises(ValueError, match="no lines"):
        lines_by_user(spark, str(tmp_path))
