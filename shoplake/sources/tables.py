"""Parquet tables, quality reports and SQL views."""

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplake.schemas import TABLES
from shoplake.sources.session import shuffles_dropped
from shoplake.sources.versions import commit, current, mark, next_version

# Lines are spread over a fixed number of user buckets: a folder per user would mean as many
# folders as users. The column's name holds the number, so that a reader needs no telling.
USER_BUCKET = "user_bucket_of_"
BUCKETS = 64


def user_bucket(buckets: int = BUCKETS) -> str:
    return f"{USER_BUCKET}{buckets}"


# Partition columns per table.
PARTITIONS = {
    "products": ("category",),
    "users": ("address_country",),
    "cart_summary": (),
    "cart_items": (user_bucket(),),
    "customer_360": (),
    "product_performance": ("category",),
    "stock_risk": ("risk_level",),
}


def partitions_with(buckets: int) -> dict[str, tuple[str, ...]]:
    return PARTITIONS | {"cart_items": (user_bucket(buckets),)}


def bucket_of(user_id: Column, column: str) -> Column:
    buckets = int(column.removeprefix(USER_BUCKET))
    return F.pmod(F.xxhash64(user_id), F.lit(buckets)).cast("int")


def with_user_bucket(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, bucket_of(F.col("user_id"), column))


def read_user_lines(spark: SparkSession, root: str, user_id: int) -> DataFrame:
    """The stored lines of one user, from that user's bucket alone."""
    path = current(spark, table_path(root, "cart_items"))
    column = next(c for c in spark.read.parquet(path).columns if c.startswith(USER_BUCKET))
    schema = T.StructType.fromDDL(TABLES["cart_items"])
    stored = T.StructType([*schema, T.StructField(column, T.IntegerType())])
    wanted = F.lit(user_id).cast("bigint")
    found = spark.read.schema(stored).parquet(path)
    found = found.filter((F.col(column) == bucket_of(wanted, column)) & (F.col("user_id") == wanted))
    return found.select(*schema.names)


def gather(df: DataFrame, by: Iterable[str | Column]) -> DataFrame:
    """Bring rows of a partition value together before writing, so that each task writes few
    files. Adaptive execution splits values that are too large for one task."""
    columns = [F.col(c) if isinstance(c, str) else c for c in by]
    return df.hint("rebalance", *columns) if columns else df


def save_table(
    df: DataFrame,
    path: str,
    partition_by: Iterable[str] = (),
    gathered: bool = False,
    said: Mapping | None = None,
) -> None:
    """Replace a Parquet table: the old one stays readable until the new one is complete.

    ``gathered`` says that the rows were brought together; ``said`` is kept beside the table.
    """
    write_version(df, path, partition_by, gathered)(said)


def write_version(df: DataFrame, path: str, partition_by: Iterable[str] = (), gathered: bool = False):
    """Write the rows; the table changes when what is returned is called."""
    columns, target = list(partition_by), next_version(path)
    writer = (df if gathered else gather(df, columns)).write.option("compression", "zstd")
    if columns:
        writer = writer.partitionBy(*columns)
    with shuffles_dropped(df.sparkSession):
        writer.parquet(target)
    return lambda said=None: commit(df.sparkSession, path, target, said)


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A stored table with its declared types: partition values are not guessed."""
    schema = T.StructType.fromDDL(TABLES[name])
    return spark.read.schema(schema).parquet(current(spark, path)).select(*schema.names)


# --- lines by user ----------------------------------------------------------------------


def save_lines_by_user(
    df: DataFrame, root: str, name: str = "lines_by_user", buckets: int = BUCKETS
) -> DataFrame:
    """Keep cart lines as a catalog table in buckets by user, and read them from there.

    Spark knows which rows share a bucket: grouping by user, or by user and anything else, and
    joining with a table in the same buckets, moves no line. A bucket is one task's, so there
    should be many more of them than cores, and users of a like size. Lines without a user, which
    are all of one bucket, are written by all tasks.
    """
    spark, target = df.sparkSession, next_version(table_path(root, "cart_items") + "_by_user")
    # Spark's own rule for buckets, so that each of them is one task's to write.
    bucket = F.pmod(F.hash("user_id"), F.lit(buckets))
    spread = F.pmod(F.xxhash64("cart_id", "product_id"), F.lit(buckets)).cast("int")
    in_buckets = df.repartitionById(
        buckets, F.when(F.col("user_id").isNull(), spread).otherwise(bucket)
    )
    spark.sql(f"drop table if exists {name}")
    writer = in_buckets.write.bucketBy(buckets, "user_id").sortBy("user_id").option("path", target)
    writer.format("parquet").saveAsTable(name)
    commit(spark, table_path(root, "cart_items") + "_by_user", target, {"buckets": buckets})
    return spark.table(name)


def lines_by_user(spark: SparkSession, root: str, name: str = "lines_by_user") -> DataFrame:
    """The same table in another session, whose catalog may not know it."""
    path = table_path(root, "cart_items") + "_by_user"
    said = mark(spark, path)
    if said is None:
        raise ValueError(f"no lines by user below {root}")
    spark.sql(f"drop table if exists {name}")
    spark.sql(
        f"""create table {name} ({TABLES["cart_items"]}) using parquet
        clustered by (user_id) sorted by (user_id) into {said["buckets"]} buckets
        location '{path}/{said["version"]}'"""
    )
    return spark.table(name)


def table_path(root: str, name: str) -> str:
    layer = "silver" if name in SILVER else "gold"
    return f"{root.rstrip('/')}/{layer}/{name}"


SILVER = ("products", "users", "cart_summary", "cart_items")
GOLD = ("customer_360", "product_performance", "stock_risk")


def read_layer(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: read_table(spark, table_path(root, name), name) for name in names}


def register_views(
    spark: SparkSession, root: str, names: Iterable[str] = SILVER, prefix: str = ""
) -> dict[str, DataFrame]:
    """Make stored tables available to ``spark.sql`` under their names, after the prefix."""
    tables = read_layer(spark, root, names)
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
    return tables


def save_report(report: DataFrame, root: str) -> None:
    """Keep one run's metrics, in place of those of the same pipelines and run time."""
    path = f"{root.rstrip('/')}/quality_reports"
    run = F.date_format("run_ts", "yyyyMMdd'T'HHmmss.SSSSSS").alias("run")
    writer = report.select("*", run).coalesce(1).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("pipeline", "run").json(path)


def read_reports(spark: SparkSession, root: str) -> DataFrame:
    schema = """run_ts timestamp, section string, name string, value bigint, note string,
        pipeline string, run string"""
    return spark.read.schema(schema).json(f"{root.rstrip('/')}/quality_reports").drop("run")
