"""The registered queries: each takes a session and a folder of test tables."""

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harness import views
from shoplake.operators import quality
from shoplake.operators.rules import rejects_by_rule
from shoplake.plans import dashboard, gold, pipeline, reports, silver
from shoplake.sources import bronze
from shoplake.sources.session import scratch_dir, shuffles_dropped
from shoplake.sources.tables import (
    SILVER,
    read_layer,
    read_reports,
    read_user_lines,
    register_views,
    save_lines_by_user,
    save_report,
)
from shoplake.sources.versions import file_list

AS_OF = dt.date(2025, 1, 1)
RUN_TS = dt.datetime(2025, 1, 1, 6)
RANGE = 65_536  # bytes, for inputs of less than RANGES ranges; a part of a document in any case
RANGES, LARGEST_RANGE = 4096, 2_097_152
SPEND_BOUNDS = (1.0, 500_000.0, 1_000_000.1, 1_000_000.2, 2_000_000.0)

# Queries whose rows come in a fixed order.
ORDERED = [
    "category_distribution",
    "top5_price",
    "age_discrepancy",
    "gender_distribution",
    "country_top10",
    "role_distribution",
    "float_audit",
    "top10_products_sold",
    "revenue_by_category",
    "top10_spenders",
    "basket_by_age_band",
    "stock_risk_report",
    "panel_revenue",
    "panel_top10",
]

# Silver tables each gold table is made from.
NEEDS = {
    "customer_360": ("users", "cart_items", "products"),
    "product_performance": ("products", "cart_items"),
    "stock_risk": ("products", "cart_items"),
}

Query = Callable[[SparkSession, str], DataFrame]


class Shop:
    """Raw and silver frames over one folder of test tables; all of them lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @property
    def raw_products(self) -> DataFrame:
        return views.bronze_products(self.spark, self.sf_dir)

    @property
    def raw_users(self) -> DataFrame:
        return views.bronze_users(self.spark, self.sf_dir)

    @property
    def raw_carts(self) -> DataFrame:
        return views.bronze_carts(self.spark, self.sf_dir)

    @property
    def raw(self) -> dict[str, DataFrame]:
        return {"products": self.raw_products, "users": self.raw_users, "carts": self.raw_carts}

    @property
    def products(self) -> DataFrame:
        return silver.products(self.raw_products, RUN_TS)

    @property
    def users(self) -> DataFrame:
        return silver.users(self.raw_users, AS_OF, RUN_TS)

    @property
    def cart_summary(self) -> DataFrame:
        return silver.cart_summary(self.raw_carts, RUN_TS)

    @property
    def items(self) -> DataFrame:
        return silver.cart_items(self.raw_carts, RUN_TS)

    @property
    def customer_360(self) -> DataFrame:
        return gold.customer_360(self.users, self.items, self.products, RUN_TS)

    @property
    def product_performance(self) -> DataFrame:
        return gold.product_performance(self.products, self.items, RUN_TS, unique_lines=True)

    @property
    def stock_risk(self) -> DataFrame:
        return gold.stock_risk(self.products, self.items, RUN_TS)

    def stored(self, *names: str) -> str:
        """Write tables, and those they need, to a new folder; reads then go to the files."""
        root = scratch_dir(self.spark)
        needed = {name for wanted in names for name in (NEEDS.get(wanted, ()) or (wanted,))}
        for table in (silver.PRODUCTS, silver.USERS, silver.CART_SUMMARY, silver.CART_ITEMS):
            if table.name in needed:
                raw = getattr(self, f"raw_{table.entity}")
                pipeline.write_silver_table(table, raw, root, AS_OF, RUN_TS)
        tables = read_layer(self.spark, root, needed)
        for name in names:
            if name == "stock_risk":  # made from the stored performance
                pipeline.write_gold_table("product_performance", tables, root, RUN_TS)
            if name in NEEDS:
                pipeline.write_gold_table(name, tables, root, RUN_TS)
        return root


def _timeless(df: DataFrame) -> DataFrame:
    return df.drop("silver_processed_at", "gold_processed_at")


def _clean_tables(s: Shop) -> dict[str, tuple[silver.SilverTable, DataFrame]]:
    return {
        "products": (silver.PRODUCTS, silver.clean_products(s.raw_products)),
        "users": (silver.USERS, silver.clean_users(s.raw_users, AS_OF)),
        "cart_summary": (silver.CART_SUMMARY, silver.clean_cart_summary(s.raw_carts)),
        "cart_items": (silver.CART_ITEMS, silver.clean_cart_items(s.raw_carts)),
    }


def _labelled(frames: dict[str, DataFrame]) -> DataFrame:
    result = None
    for name, df in frames.items():
        part = df.select(F.lit(name).alias("table"), "*")
        result = part if result is None else result.unionByName(part)
    return result


def _stage_counts(s: Shop) -> DataFrame:
    return _labelled(
        {
            name: quality.as_rows(
                quality.stage_counts(cleaned, table.keys, table.rules(), table.watched)
            )
            for name, (table, cleaned) in _clean_tables(s).items()
        }
    )


def _rejects(s: Shop) -> DataFrame:
    return _labelled(
        {
            name: rejects_by_rule(silver.without_copies(cleaned, table.keys), table.rules())
            for name, (table, cleaned) in _clean_tables(s).items()
        }
    )


def _null_summary(s: Shop) -> DataFrame:
    return _labelled(
        {name: quality.null_summary(df) for name, (_, df) in _clean_tables(s).items()}
    )


def _removed_fields(s: Shop) -> DataFrame:
    return quality.removed_fields(s.raw_users, list(silver.USER_FIELDS.values()))




def _json_lines(s: Shop, entity: str) -> DataFrame:
    """Raw records written as JSON lines, landed and read back with the declared schema."""
    root = scratch_dir(s.spark)
    s.raw[entity].write.options(**bronze.LINES).json(f"{root}/incoming/{entity}")
    bronze.land(
        s.spark, {entity: f"{root}/incoming/{entity}"}, f"{root}/bronze", "lines", RUN_TS
    )
    return bronze.read_records(s.spark, f"{root}/bronze/{entity}", entity, "lines")


def _session(spark: SparkSession, **settings: str) -> SparkSession:
    """A session of its own with some settings, and as many partitions as the given one."""
    session = spark.newSession()
    shuffles = "spark.sql.shuffle.partitions"
    for key, value in {shuffles: spark.conf.get(shuffles), **settings}.items():
        session.conf.set(key, value)
    return session


def _building(spark: SparkSession) -> SparkSession:
    """For documents: rows that lie together by their part are joined and grouped where they are,
    and of the documents of a task one at a time is put together."""
    return _session(
        spark,
        **{
            "spark.sql.requireAllClusterKeysForCoPartition": "false",
            "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "1",
        },
    )


def _in_parts(s: Shop, entity: str) -> DataFrame:
    """Raw records after the ``part`` that is their document."""
    if entity == "carts":
        return views.bronze_carts(_building(s.spark), s.sf_dir, views.PER_DOCUMENT)
    fields = s.raw[entity]
    # Records without an id, of which there may be many, are spread over many documents.
    loose = -1 - F.pmod(F.xxhash64(*_scalars(fields)), F.lit(64))
    part = F.coalesce(F.floor(F.col("id") / views.PER_DOCUMENT), loose)
    return fields.select(part.alias("part"), "*")


def _document_files(s: Shop, entity: str, **options: str) -> str:
    """Raw records as documents that hold the records of a range of ids each."""
    root = scratch_dir(s.spark)
    fields = _in_parts(s, entity)
    record = F.struct(*fields.columns[1:])
    documents = fields.groupBy("part").agg(F.collect_list(record).alias(entity))
    text = documents.select(F.to_json(F.struct(entity)).alias("value"))
    with shuffles_dropped(text.sparkSession):
        text.write.options(**options).option("maxRecordsPerFile", 1).text(f"{root}/{entity}")
    return f"{root}/{entity}"


def _documents(s: Shop, entity: str) -> DataFrame:
    path = _document_files(s, entity, **bronze.COMPRESSED)
    return bronze.read_records(s.spark, path, entity, "documents")


def _ranges(s: Shop, entity: str) -> DataFrame:
    """The same documents, each read in ranges that are a small part of it."""
    path = _document_files(s, entity)
    size = file_list(s.spark, path).agg(F.sum("length")).first()[0] or 0
    length = min(max(RANGE, size // RANGES), LARGEST_RANGE)
    session = _session(s.spark, **{"spark.sql.files.maxPartitionBytes": str(length)})
    return bronze.read_records(session, path, entity, "ranges")


def _scalars(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if "<" not in kind]


def _malformed_counts(s: Shop) -> DataFrame:
    """Lines that are cut off, by key: as landed, as read, and as set aside."""
    root = scratch_dir(s.spark)
    sources = {entity: f"{root}/incoming/{entity}" for entity in s.raw}
    found = None
    for entity, df in s.raw.items():
        line = F.to_json(F.struct(*df.columns))
        cut_off = F.coalesce(F.col("id") % views.BROKEN[entity] == 0, F.lit(False))
        text = F.when(cut_off, F.left(line, F.length(line) - 3)).otherwise(line)
        df.select(text).write.options(**bronze.LINES).text(sources[entity])
    landed = bronze.land(s.spark, sources, f"{root}/bronze", "lines", RUN_TS)
    for entity in s.raw:
        path = f"{root}/bronze/{entity}"
        read = bronze.read_records(s.spark, path, entity, "lines", "aside")
        aside = bronze.read_malformed(s.spark, path, entity, "lines")
        counts = [
            df.agg(F.count(F.lit(1)).alias("records")).select(
                F.lit(entity).alias("entity"), F.lit(kind).alias("kind"), "records"
            )
            for df, kind in ((read, "read"), (aside, "aside"))
        ]
        both = counts[0].union(counts[1])
        found = both if found is None else found.union(both)
    pivoted = found.groupBy("entity").agg(
        F.sum(F.when(F.col("kind") == "read", F.col("records"))).alias("records_read"),
        F.sum(F.when(F.col("kind") == "aside", F.col("records"))).alias("set_aside"),
    )
    return landed.select("entity", "status", "record_count", "malformed_count").join(pivoted, "entity")


def _landing_manifest(s: Shop) -> DataFrame:
    root = scratch_dir(s.spark)
    sources = {entity: f"{root}/incoming/{entity}" for entity in s.raw}
    for entity, df in s.raw.items():
        df.write.options(**bronze.LINES).json(sources[entity])
    landed = bronze.land(s.spark, sources, f"{root}/bronze", "lines", RUN_TS)
    return landed.select("entity", "status", "record_count", "malformed_count")


def _file_manifest(s: Shop) -> DataFrame:
    """Records by the file they come from: files hold the lines of an odd or an even id."""
    root, found = scratch_dir(s.spark), None
    for entity, df in s.raw.items():
        half = F.coalesce(F.pmod(F.col("id"), F.lit(2)), F.lit(0)).cast("int")
        halves = df.withColumn("half", half).write.partitionBy("half").options(**bronze.LINES)
        halves.json(f"{root}/{entity}")
        for i in range(2):
            files = bronze.file_manifest(s.spark, f"{root}/{entity}/half={i}", entity, "lines")
            told = files.agg(
                F.lit(entity).alias("entity"),
                F.lit(i).alias("half"),
                F.sum("record_count").alias("record_count"),
                F.count_if(F.col("source_size") > 0).alias("files"),
            ).select("entity", "half", "record_count", (F.col("files") > 0).alias("has_files"))
            found = told if found is None else found.unionByName(told)
    return found


def _incremental_landing(s: Shop) -> DataFrame:
    """Lines that arrive in two parts: what each run lands, and what is read in the end."""
    root, landed = scratch_dir(s.spark), None
    sources = {entity: f"{root}/incoming/{entity}" for entity in s.raw}
    for run in range(3):
        if run < 2:
            for entity, df in s.raw.items():
                half = F.coalesce(F.pmod(F.col("id"), F.lit(2)), F.lit(0)) == run
                df.where(half).write.mode("append").options(**bronze.LINES).json(sources[entity])
        run_ts = RUN_TS + dt.timedelta(days=run)
        told = bronze.land_new(s.spark, sources, f"{root}/bronze", "lines", run_ts)
        told = told.select("entity", F.lit(run).alias("run"), "record_count")
        landed = told if landed is None else landed.unionByName(told)
    for entity in s.raw:
        read = bronze.read_records(s.spark, f"{root}/bronze/{entity}/*", entity, "lines")
        counts = read.agg(F.count(F.lit(1)).alias("record_count"))
        landed = landed.unionByName(
            counts.select(F.lit(entity).alias("entity"), F.lit(-1).alias("run"), "record_count")
        )
    return landed


def _quality_reports(s: Shop) -> DataFrame:
    """Counts observed while all tables were written, saved twice and read back."""
    root = scratch_dir(s.spark)
    reported = pipeline.silver_reports(pipeline.write_silver(s.raw, root, AS_OF, RUN_TS))
    tables = read_layer(s.spark, root, SILVER)
    reported |= pipeline.gold_reports(pipeline.write_gold(tables, root, RUN_TS))
    for _ in range(2):
        save_report(quality.report_frame(s.spark, RUN_TS, reported), root)
    return read_reports(s.spark, root).select("pipeline", "section", "name", "value")


def _stored(s: Shop, name: str) -> DataFrame:
    return read_layer(s.spark, s.stored(name), [name])[name]


def _stored_sql(s: Shop) -> DataFrame:
    """Plain SQL over views of three stored tables."""
    names = ("users", "products", "cart_items")
    register_views(s.spark, s.stored(*names), names, "stored_")
    return s.spark.sql(
        """select address_country as country, role, count(1) as lines,
            count(distinct brand) as brands
        from stored_cart_items lines join stored_users on user_id = stored_users.id
            left join stored_products on product_id = stored_products.id
        group by address_country, role"""
    )


def _stored_user_lines(s: Shop) -> DataFrame:
    return _timeless(read_user_lines(s.spark, s.stored("cart_items"), 4))


def _lines_by_user(s: Shop) -> DataFrame:
    """The lines as a table in buckets by user."""
    root = scratch_dir(s.spark)
    return save_lines_by_user(s.items, root, f"lines_{root[-8:]}".replace("-", "_"), buckets=16)


def _demand_by_parts(s: Shop) -> DataFrame:
    """Sketches of two halves of the lines, each stored, then merged."""
    root, half = scratch_dir(s.spark), F.pmod(F.xxhash64("cart_id", "product_id"), F.lit(2))
    parts = []
    for i in range(2):
        gold.demand_sketches(s.items.where(half == i)).write.parquet(f"{root}/{i}")
        parts.append(s.spark.read.parquet(f"{root}/{i}"))
    return gold.sketched_demand(gold.merged_sketches(*parts))


def _finite(df: DataFrame, *names: str) -> DataFrame:
    """NaN and infinity, which compare unlike in different engines, as null."""
    return df.withColumns({n: F.when(F.abs(F.col(n)) < float("inf"), F.col(n)) for n in names})


QUERIES: dict[str, Callable[[Shop], DataFrame]] = {
    # raw
    "bronze_counts": lambda s: reports.bronze_counts(s.raw_products, s.raw_users, s.raw_carts),
    "malformed_counts": _malformed_counts,
    "landing_manifest": _landing_manifest,
    "file_manifest": _file_manifest,
    "incremental_landing": _incremental_landing,
    # products
    "products_selected": lambda s: _finite(silver.select_products(s.raw_products), "price"),
    "products_typed": lambda s: silver.type_products(s.raw_products),
    "products_filled": lambda s: silver.clean_products(s.raw_products),
    "products_dedup": lambda s: silver.without_copies(
        silver.clean_products(s.raw_products), ["id"]
    ),
    "silver_products": lambda s: _timeless(s.products),
    "silver_products_from_json": lambda s: _timeless(
        silver.products(_json_lines(s, "products"), RUN_TS)
    ),
    "silver_products_from_ranges": lambda s: _timeless(
        silver.products(_ranges(s, "products"), RUN_TS)
    ),
    "silver_products_from_documents": lambda s: _timeless(
        silver.products(_documents(s, "products"), RUN_TS)
    ),
    # users
    "users_flat": lambda s: silver.flatten_users(s.raw_users),
    "users_age": lambda s: silver.clean_users(s.raw_users, AS_OF).select(
        "id", "email", "birth_date", "age_derived"
    ),
    "silver_users": lambda s: _timeless(s.users),
    "silver_users_from_json": lambda s: _timeless(
        silver.users(_json_lines(s, "users"), AS_OF, RUN_TS)
    ),
    "silver_users_from_ranges": lambda s: _timeless(
        silver.users(_ranges(s, "users"), AS_OF, RUN_TS)
    ),
    "silver_users_from_documents": lambda s: _timeless(
        silver.users(_documents(s, "users"), AS_OF, RUN_TS)
    ),
    # carts
    "carts_exploded": lambda s: _finite(
        silver.explode_carts(s.raw_carts), "price", "total", "discountedTotal"
    ),
    "silver_cart_summary": lambda s: _timeless(s.cart_summary),
    "silver_cart_items": lambda s: _timeless(s.items),
    "silver_cart_items_late": lambda s: _timeless(silver.cart_items(s.raw_carts, RUN_TS, late=True)),
    "silver_cart_items_from_json": lambda s: _timeless(
        silver.cart_items(_json_lines(s, "carts"), RUN_TS)
    ),
    "silver_cart_items_from_ranges": lambda s: _timeless(
        silver.cart_items(_ranges(s, "carts"), RUN_TS)
    ),
    "silver_cart_items_from_documents": lambda s: _timeless(
        silver.cart_items(_documents(s, "carts"), RUN_TS)
    ),
    # quality
    "rejects_by_rule": _rejects,
    "stage_counts": _stage_counts,
    "null_summary": _null_summary,
    "removed_fields": _removed_fields,
    "quality_report_round_trip": _quality_reports,
    "health_check": lambda s: quality.health_check(
        {"products": s.products, "users": s.users, "cart_items": s.items}
    ),
    # customers
    "user_cart_agg": lambda s: gold.user_cart_aggregate(s.items),
    "category_quantities": lambda s: gold.category_quantities(s.items, s.products),
    "favourite_category": lambda s: gold.favourite_category(s.items, s.products),
    "discount_agg": lambda s: gold.discount_aggregate(s.items),
    "customer_360": lambda s: _timeless(s.customer_360),
    # products
    "product_demand": lambda s: gold.product_demand(s.items),
    "product_demand_unique_lines": lambda s: gold.product_demand(s.items, unique_lines=True),
    "product_demand_sketched": _demand_by_parts,
    "product_performance": lambda s: _timeless(s.product_performance),
    "product_performance_literal": lambda s: _timeless(
        gold.product_performance(
            s.products, s.items, RUN_TS, unique_lines=True, literal_tiers=True
        )
    ),
    "pending_demand": lambda s: gold.pending_demand(s.items),
    "stock_risk": lambda s: _timeless(s.stock_risk),
    "stock_risk_thresholds": lambda s: _timeless(
        gold.stock_risk(s.products, s.items, RUN_TS, critical=-100, high=0, medium=100)
    ),
    "tier_counts": lambda s: gold.tier_counts(s.product_performance, "demand_tier"),
    "risk_counts": lambda s: gold.tier_counts(s.stock_risk, "risk_level"),
    # reports
    "products_audit": lambda s: reports.products_audit(s.products),
    "category_distribution": lambda s: reports.category_distribution(s.products),
    "top5_price": lambda s: reports.most_expensive(s.products),
    "age_discrepancy": lambda s: reports.age_discrepancies(s.users),
    "gender_distribution": lambda s: reports.gender_distribution(s.users),
    "country_top10": lambda s: reports.top_countries(s.users),
    "role_distribution": lambda s: reports.role_distribution(s.users),
    "float_audit": lambda s: reports.float_audit(s.items),
    "top10_products_sold": lambda s: reports.top_products_sold(s.items, unique_lines=True),
    "cart_summary_report": lambda s: reports.cart_overview(s.items, unique_lines=True),
    "revenue_by_category": lambda s: reports.revenue_by_category(s.items, s.products),
    "top10_spenders": lambda s: reports.top_spenders(s.users, s.items),
    "basket_by_age_band": lambda s: reports.basket_by_age_band(s.users, s.items),
    "stock_risk_report": lambda s: reports.nearly_out_of_stock(s.products, s.items),
    # dashboard
    "panel_revenue": lambda s: dashboard.revenue_panel(
        gold.product_revenue(s.products, s.items)
    ),
    "panel_spend_tiers": lambda s: dashboard.spend_tier_panel(
        gold.customer_spend(s.users, s.items), SPEND_BOUNDS
    ),
    "panel_stock_alert": lambda s: _timeless(dashboard.stock_alert_panel(s.stock_risk)),
    "panel_top10": lambda s: dashboard.top_customers_panel(
        gold.customer_spend(s.users, s.items)
    ),
    # stored tables
    "stored_users": lambda s: _timeless(_stored(s, "users")),
    "stored_customer_360": lambda s: _timeless(_stored(s, "customer_360")),
    "stored_product_performance": lambda s: _timeless(_stored(s, "product_performance")),
    "stored_stock_alert": lambda s: _timeless(
        dashboard.stock_alert_panel(_stored(s, "stock_risk"))
    ),
    "stored_user_lines": _stored_user_lines,
    "bucketed_user_cart_agg": lambda s: gold.user_cart_aggregate(_lines_by_user(s)),
    "bucketed_customer_360": lambda s: _timeless(
        gold.customer_360(s.users, _lines_by_user(s), s.products, RUN_TS)
    ),
    "stored_views_sql": _stored_sql,
}


def queries() -> dict[str, Query]:
    def bound(plan: Callable[[Shop], DataFrame]) -> Query:
        return lambda spark, sf_dir: plan(Shop(spark, sf_dir))

    return {name: bound(plan) for name, plan in QUERIES.items()}
