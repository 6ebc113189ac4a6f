"""Relational sink."""

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame


def jdbc_config(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """Connection options from POSTGRES_HOST, _PORT, _DB, _USER and _PASSWORD.

    Only host and port have defaults.
    """
    env = os.environ if env is None else env
    needed = ("POSTGRES_DB", "POSTGRES_USER", "POSTGRES_PASSWORD")
    missing = [k for k in needed if not env.get(k)]
    if missing:
        raise ValueError(f"not set: {', '.join(missing)}")
    host, port = env.get("POSTGRES_HOST", "localhost"), env.get("POSTGRES_PORT", "5432")
    return {
        "url": f"jdbc:postgresql://{host}:{port}/{env['POSTGRES_DB']}",
        "user": env["POSTGRES_USER"],
        "password": env["POSTGRES_PASSWORD"],
        "driver": "org.postgresql.Driver",
    }


def write_jdbc(
    df: DataFrame,
    table: str,
    mode: str = "overwrite",
    config: Mapping[str, str] | None = None,
    batch_size: int = 1000,
    connections: int = 8,
    truncate: bool = False,
) -> None:
    """Write to a database table; ``connections`` bounds the parallel writers.

    A partition is one transaction. A task that committed and was then lost runs again and
    inserts its rows twice, so give target tables a key, or load into a fresh table and swap.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode}")
    (
        df.write.format("jdbc")
        .options(**(jdbc_config() if config is None else config))
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .option("numPartitions", connections)
        .option("truncate", truncate)
        .mode(mode)
        .save()
    )
