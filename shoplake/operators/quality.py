"""Data-quality metrics: counts per stage, drops by cause, nulls per column."""

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplake.operators.dedup import COPIES, keep_first, without_copies
from shoplake.operators.rules import FAILED_RULE, Rules, first_failure

_NULLS = "nulls_in_"


def assess(
    cleaned: DataFrame, keys: Sequence[str], rules: Rules, watched: Sequence[str] = ()
) -> DataFrame:
    """One row per key with the rule it fails, its copies and their nulls per watched column.

    Everything a quality report counts can be summed up from these rows, so the counts come
    out of the job that writes the table. Taken in its last stage, they also stay right when
    lost map tasks run again.
    """
    tallies = [F.count_if(F.col(c).isNull()).alias(_NULLS + c) for c in watched]
    return keep_first(cleaned, keys, tallies).withColumn(FAILED_RULE, first_failure(rules))


# The names of a report's steps, and what each stands for.
NOTES = {
    "steps/01_after_bronze_read": "records read",
    "steps/02_after_cleaning": "records with typed and cleaned fields",
    "steps/03_after_dedup": "one record per key",
    "steps/04_after_quality_filters": "records that pass all rules",
    "steps/05_written": "rows written to the table",
    "steps/02_cart_summary_ready": "carts that pass all rules",
    "steps/03_cart_items_ready": "lines that pass all rules",
    "steps/row_count": "rows written to the table",
    "dropped/duplicates": "further copies of a key",
    "dropped/failed_quality_filters": "records that fail a rule",
    "dropped/total": "all records that were read and not kept",
    "dropped/malformed": "documents or lines that could not be read, set aside",
}


def accepted(assessed: DataFrame, columns: Sequence[str]) -> DataFrame:
    return assessed.filter(F.col(FAILED_RULE).isNull()).select(*columns)


def only_counted(assessed: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The same rows, of which those that fail a rule keep nothing but the columns in ``by`` and
    what is counted: they are brought to the last stage for that alone."""
    if not by:
        return assessed
    kept = F.col(FAILED_RULE).isNull()
    return assessed.withColumns({c: F.when(kept, F.col(c)) for c in columns if c not in by})


def written() -> list[Column]:
    """Of the rows as they are written."""
    return [F.count(F.lit(1)).alias("steps/05_written")]


def stage_metrics(rules: Iterable[str], watched: Sequence[str] = ()) -> list[Column]:
    """Aggregates over assessed rows, for ``agg`` or ``observe``."""
    read, distinct = F.coalesce(F.sum(COPIES), F.lit(0)), F.count(F.lit(1))
    kept = F.count_if(F.col(FAILED_RULE).isNull())
    metrics = {
        "steps/01_after_bronze_read": read,
        "steps/02_after_cleaning": read,
        "steps/03_after_dedup": distinct,
        "steps/04_after_quality_filters": kept,
        "dropped/duplicates": read - distinct,
        "dropped/failed_quality_filters": distinct - kept,
        "dropped/total": read - kept,
    }
    metrics |= {f"rejected/{r}": F.count_if(F.col(FAILED_RULE) == r) for r in rules}
    metrics |= {f"nulls/{c}": F.coalesce(F.sum(_NULLS + c), F.lit(0)) for c in watched}
    return [value.cast("bigint").alias(name) for name, value in metrics.items()]


def stage_counts(
    cleaned: DataFrame, keys: Sequence[str], rules: Rules, watched: Sequence[str] = ()
) -> DataFrame:
    """The same metrics as one row, where reading twice is cheap: rows read and nulls are counted
    as they come, drops on one row per key, and no row is carried along to be sorted."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls/{c}") for c in watched]
    read = cleaned.agg(F.count(F.lit(1)).alias("read"), *nulls)
    failed = without_copies(cleaned, keys).select(first_failure(rules).alias(FAILED_RULE))
    rejected = [F.count_if(F.col(FAILED_RULE) == r).alias(f"rejected/{r}") for r in rules]
    kept = failed.agg(
        F.count(F.lit(1)).alias("distinct"),
        F.count_if(F.col(FAILED_RULE).isNull()).alias("kept"),
        *rejected,
    )
    # A row on either side.
    both = read.withColumn("one", F.lit(1)).join(kept.withColumn("one", F.lit(1)), "one")
    metrics = {
        "steps/01_after_bronze_read": F.col("read"),
        "steps/02_after_cleaning": F.col("read"),
        "steps/03_after_dedup": F.col("distinct"),
        "steps/04_after_quality_filters": F.col("kept"),
        "dropped/duplicates": F.col("read") - F.col("distinct"),
        "dropped/failed_quality_filters": F.col("distinct") - F.col("kept"),
        "dropped/total": F.col("read") - F.col("kept"),
    }
    names = [f"rejected/{r}" for r in rules] + [f"nulls/{c}" for c in watched]
    metrics |= {name: F.col(f"`{name}`") for name in names}
    return both.select([value.cast("bigint").alias(name) for name, value in metrics.items()])


def share_metrics(column: str, values: Sequence[str]) -> list[Column]:
    """Row count and rows per known value of a column."""
    return [F.count(F.lit(1)).alias("steps/row_count")] + [
        F.count_if(F.col(column) == value).alias(f"{column}/{value}") for value in values
    ]


def as_rows(metrics: DataFrame) -> DataFrame:
    """One row of metrics to rows (section, name, value); null counts of zero are left out."""
    names = [F.col(f"`{name}`") for name in metrics.columns]
    parts = F.split("metric", "/", 2)
    return (
        metrics.unpivot([], names, "metric", "value")
        .select(parts[0].alias("section"), parts[1].alias("name"), "value")
        .filter("section <> 'nulls' or value > 0")
    )


def report_frame(
    spark: SparkSession, run_ts: dt.datetime, reports: Mapping[str, Mapping[str, int]]
) -> DataFrame:
    """Metrics of one run, by pipeline, as a small frame; each with a note on what it is."""
    rows = [
        (pipeline, run_ts, *name.split("/", 1), value, note_on(name))
        for pipeline, observed in reports.items()
        for name, value in observed.items()
        if value or not name.startswith("nulls/")
    ]
    return spark.createDataFrame(
        rows,
        "pipeline string, run_ts timestamp, section string, name string, value bigint, note string",
    )


def note_on(name: str) -> str:
    section = name.split("/", 1)[0]
    sections = {
        "rejected": "records whose first failed rule this is",
        "nulls": "nulls before deduplication",
        "removed_fields": "field of the raw records that the table leaves out",
        "thresholds": "highest net stock of the level",
    }
    return NOTES.get(name) or sections.get(section, "rows with this value")


def null_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count of each column that has any, in one pass."""
    names = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return counts.unpivot([], names, "column", "nulls").filter("nulls > 0")


def leaf_fields(schema: T.StructType, prefix: str = "") -> list[str]:
    """Dotted names of all fields, looking into structs."""
    leaves = []
    for field in schema:
        name = prefix + field.name
        if isinstance(field.dataType, T.StructType):
            leaves += leaf_fields(field.dataType, name + ".")
        else:
            leaves.append(name)
    return leaves


def removed_fields(raw: DataFrame, kept: Sequence[str]) -> DataFrame:
    """Fields of the raw records that the clean table leaves out, with how many rows had them."""
    removed = [name for name in leaf_fields(raw.schema) if name not in kept]
    counts = raw.agg(*[F.count(name).alias(name) for name in removed])
    return counts.unpivot([], [F.col(f"`{name}`") for name in removed], "field", "records")


def health_check(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def schema_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name and type of every column."""
    rows = [
        (table, position, field.name, field.dataType.simpleString())
        for table, df in tables.items()
        for position, field in enumerate(df.schema, start=1)
    ]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "table string, position int, column string, type string")
