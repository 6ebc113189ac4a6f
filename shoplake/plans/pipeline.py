"""The whole flow: raw records to silver tables, then gold tables from the stored silver ones.

Each table is written once, and its counts are observed in the last stage of that write.
Later steps read what was written, so a lost executor costs a stage, not the run. A table is
kept with its counts and with what it was made from, so that a run that was stopped can be
taken up again: tables that are up to date are not written a second time.
"""

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shoplake.functions.tiers import CRITICAL, DEMAND_TIERS, HIGH, MEDIUM, RISK_LEVELS
from shoplake.operators.quality import (
    leaf_fields,
    only_counted,
    report_frame,
    share_metrics,
    stage_metrics,
    written,
)
from shoplake.plans import gold, silver
from shoplake.schemas import RECORDS
from shoplake.sources.bronze import read_records, set_aside
from shoplake.sources.jdbc import write_jdbc
from shoplake.sources.tables import (
    GOLD,
    PARTITIONS,
    SILVER,
    BUCKETS,
    USER_BUCKET,
    gather,
    partitions_with,
    read_layer,
    save_report,
    table_path,
    with_user_bucket,
    write_version,
)
from shoplake.sources.versions import fingerprint, mark

# The stored tables that a gold table is made from.
MADE_FROM = {
    "customer_360": ("users", "cart_items", "products"),
    "product_performance": ("products", "cart_items"),
    "stock_risk": ("product_performance",),
}


def _observe(df: DataFrame, metrics: list[Column]) -> tuple[DataFrame, Observation]:
    observation = Observation()
    return df.observe(observation, *metrics), observation


def _side_by_side(write: Callable, of: Sequence) -> list[dict]:
    """Run independent writes at the same time, so that the last tasks of one leave no cores
    idle. The first failure is raised once all have ended."""
    with ThreadPoolExecutor(len(of)) as pool:
        return list(pool.map(write, of))


def up_to_date(spark: SparkSession, path: str, inputs: str | None) -> dict[str, int] | None:
    """The counts of a table that was made from these inputs, nothing if it is another."""
    said = mark(spark, path)
    return said["counts"] if said and inputs and said.get("inputs") == inputs else None


def write_silver_table(
    table: silver.SilverTable,
    raw: DataFrame,
    root: str,
    as_of: dt.date | None = None,
    run_ts: dt.datetime | None = None,
    partitions: Mapping[str, tuple[str, ...]] = PARTITIONS,
    inputs: str | None = None,
    resume: bool = False,
) -> dict[str, int]:
    """Write one silver table from raw records; returns the observed counts. With ``resume`` it
    is left as it is if it was made from the same ``inputs``."""
    by, path = partitions[table.name], table_path(root, table.name)
    if resume and (known := up_to_date(raw.sparkSession, path, inputs)) is not None:
        return known
    cleaned = table.clean(raw, as_of) if table is silver.USERS else table.clean(raw)
    typed = table.typed(raw) if table.typed else cleaned
    assessed = table.assess(typed)
    for column in by:
        if column.startswith(USER_BUCKET):
            cleaned, assessed = (with_user_bucket(df, column) for df in (cleaned, assessed))
    moved = gather(only_counted(assessed, typed.columns, by), by)
    moved = table.derived(moved) if table.derived else moved
    assessed, counts = _observe(moved, stage_metrics(table.rules(), table.watched))
    kept, rows = _observe(table.accept(assessed, cleaned, run_ts), written())
    finish = write_version(kept, path, by, gathered=True)
    found = counts.get | rows.get
    finish({"inputs": inputs, "counts": found})
    return found


def write_silver(
    raw: Mapping[str, DataFrame],
    root: str,
    as_of: dt.date | None = None,
    run_ts: dt.datetime | None = None,
    partitions: Mapping[str, tuple[str, ...]] = PARTITIONS,
    inputs: Mapping[str, str] | None = None,
    resume: bool = False,
) -> dict[str, dict[str, int]]:
    """Write the four silver tables from the raw records of the three entities, which ``inputs``
    describes."""

    def write(table: silver.SilverTable) -> dict[str, int]:
        told = None
        if inputs is not None:
            day = (as_of or dt.date.today()) if table is silver.USERS else ""
            told = f"{inputs[table.entity]} {day} {partitions[table.name]}"
        return write_silver_table(
            table, raw[table.entity], root, as_of, run_ts, partitions, told, resume
        )

    tables = (silver.PRODUCTS, silver.USERS, silver.CART_SUMMARY, silver.CART_ITEMS)
    return dict(zip([table.name for table in tables], _side_by_side(write, tables)))


def write_gold_table(
    name: str,
    tables: Mapping[str, DataFrame],
    root: str,
    run_ts: dt.datetime | None = None,
    partitions: Mapping[str, tuple[str, ...]] = PARTITIONS,
    resume: bool = False,
) -> dict[str, int]:
    """Write one gold table from silver tables; returns the observed counts. With ``resume`` it
    is left as it is if it was made from the stored silver tables as they are now."""
    if name not in MADE_FROM:
        raise ValueError(f"no gold table {name}")
    products, items = tables["products"], tables["cart_items"]
    spark, path, by = products.sparkSession, table_path(root, name), partitions[name]
    marks = [mark(spark, table_path(root, used)) for used in MADE_FROM[name]]
    inputs = " ".join([m["version"] for m in marks] + [str(by)]) if all(marks) else None
    if resume and (known := up_to_date(spark, path, inputs)) is not None:
        return known
    if name == "customer_360":
        df = gold.customer_360(tables["users"], items, products, run_ts)
        metrics = [F.count(F.lit(1)).alias("steps/row_count")]
    elif name == "product_performance":
        df = gold.product_performance(products, items, run_ts, unique_lines=True)
        metrics = share_metrics("demand_tier", DEMAND_TIERS)
    else:
        # Lines are summed once: performance comes from them, risk from the stored performance.
        performance = read_layer(products.sparkSession, root, ["product_performance"])
        df = gold.stock_risk_of(performance["product_performance"], run_ts)
        metrics = share_metrics("risk_level", RISK_LEVELS)
    observed, counts = _observe(gather(df, by), metrics)
    finish = write_version(observed, path, by, gathered=True)
    finish({"inputs": inputs, "counts": counts.get})
    return counts.get


def write_gold(
    tables: Mapping[str, DataFrame],
    root: str,
    run_ts: dt.datetime | None = None,
    partitions: Mapping[str, tuple[str, ...]] = PARTITIONS,
    resume: bool = False,
) -> dict[str, dict[str, int]]:
    """Write the three gold tables from silver tables, stock risk after product performance."""

    def write(*names: str) -> dict[str, dict[str, int]]:
        return {
            name: write_gold_table(name, tables, root, run_ts, partitions, resume) for name in names
        }

    chains = (("customer_360",), ("product_performance", "stock_risk"))
    counts = {}
    for found in _side_by_side(lambda names: write(*names), chains):
        counts |= found
    return {name: counts[name] for name in GOLD}


def silver_reports(observed: Mapping[str, Mapping[str, int]]) -> dict[str, dict[str, int]]:
    """Counts per quality report. The two cart tables share one, with their drops added up."""
    summary, items = observed["cart_summary"], observed["cart_items"]
    carts = {
        "steps/01_after_bronze_read": summary["steps/01_after_bronze_read"],
        "steps/02_cart_summary_ready": summary["steps/04_after_quality_filters"],
        "steps/03_cart_items_ready": items["steps/04_after_quality_filters"],
        "steps/05_written": summary["steps/05_written"] + items["steps/05_written"],
    }
    for name in ("duplicates", "failed_quality_filters", "total"):
        key = f"dropped/{name}"
        carts[key] = summary[key] + items[key]
    for table, counts in (("cart_summary", summary), ("cart_items", items)):
        for key, value in counts.items():
            if key.startswith("rejected/"):
                carts[f"rejected/{table}.{key.removeprefix('rejected/')}"] = value
    left_out = [f for f in leaf_fields(RECORDS["users"]) if f not in silver.USER_FIELDS.values()]
    return {
        "products_silver": dict(observed["products"]),
        "users_silver": observed["users"] | {f"removed_fields/{name}": None for name in left_out},
        "carts_silver": carts,
    }


def gold_reports(observed: Mapping[str, Mapping[str, int]]) -> dict[str, dict[str, int]]:
    """Counts per gold table, and the bounds that the risk levels stand for."""
    found = {f"gold_{name}": dict(counts) for name, counts in observed.items()}
    bounds = {"critical": CRITICAL, "high": HIGH, "medium": MEDIUM}
    if "gold_stock_risk" in found:
        found["gold_stock_risk"] |= {f"thresholds/{name}": value for name, value in bounds.items()}
    return found


def run_all(
    spark: SparkSession,
    bronze_root: str,
    out_root: str,
    layout: str = "documents",
    as_of: dt.date | None = None,
    run_ts: dt.datetime | None = None,
    jdbc: Mapping[str, str] | None = None,
    malformed: str = "fail",
    user_buckets: int = BUCKETS,
    resume: bool = False,
) -> dict[str, dict[str, int]]:
    """Run everything in order and save the quality reports; returns their counts.

    Malformed input ends the run. With ``malformed="aside"`` it goes to ``malformed/`` below
    the raw files instead and is counted as such. Lines are stored in ``user_buckets`` folders.
    With ``jdbc`` options the gold tables are also loaded into a database, from their files.
    With ``resume`` tables stay that an earlier run has made from the same raw files (by name,
    size and time) with the same settings; their counts are those of that run.
    """
    run_ts = run_ts or dt.datetime.now(dt.UTC)
    root = bronze_root.rstrip("/")
    entities = ("products", "users", "carts")
    raw = {e: read_records(spark, f"{root}/{e}", e, layout, malformed) for e in entities}
    partitions = partitions_with(user_buckets)
    inputs = {e: f"{fingerprint(spark, f'{root}/{e}')} {layout} {malformed}" for e in entities}
    reports = silver_reports(
        write_silver(raw, out_root, as_of, run_ts, partitions, inputs, resume)
    )
    if malformed == "aside":
        for entity in entities:
            aside = set_aside(spark, f"{root}/{entity}", entity, layout, f"{root}/malformed/{entity}")
            reports[f"{entity}_silver"]["dropped/malformed"] = aside
    tables = read_layer(spark, out_root, SILVER)
    reports |= gold_reports(write_gold(tables, out_root, run_ts, partitions, resume))
    save_report(report_frame(spark, run_ts, reports), out_root)
    if jdbc is not None:
        for name, df in read_layer(spark, out_root, GOLD).items():
            write_jdbc(df, f"gold_{name}", config=jdbc)
    return reports
