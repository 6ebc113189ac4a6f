"""What the operators share: reading tables, cutting lineage, and cutting texts into words."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.sources.session import scratch_dir

# The letters that lower-casing changes, and the white space between words.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
WORD = r"[^\x20\x09-\x0D]+"
BATCH = "1m"  # of rows that a task hands to Python at a time, about
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The frame, computed and kept in the folder that all executors share."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """As ``cut``, as a compressed table; for what is read several times, or in part."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks(spark: SparkSession) -> int:
    """How many tasks a shuffle has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def short_batches(spark: SparkSession) -> None:
    """From now on the session hands rows to Python by their bytes, not only by their number:
    10,000 long texts at a time, held by Spark and by Python, are most of what a task needs. A
    size that the session has been given stays."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else unchanged."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: str | None) -> list[bytes]:
    """``bytes.split`` cuts at the six ASCII white-space characters and at nothing else."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def slices(texts: pa.Array, step: int) -> Iterator[tuple[slice, list[str | None]]]:
    """Texts in turn, about ``step`` bytes at a time; a longer one comes alone."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    at = 0
    while at < len(sizes):
        stop, size = at, 0
        while stop < len(sizes) and (stop == at or size + sizes[stop] <= step):
            size += sizes[stop]
            stop += 1
        yield slice(at, stop), texts[at:stop].to_pylist()
        at = stop


def gathered(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[pa.RecordBatch]:
    """Small batches put together until they have ``step`` bytes, about."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= step:
            yield pa.concat_batches(held) if held[1:] else batch
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = x ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
