"""Session helpers."""

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Whether the files of a job's shuffles go as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_writing: dict[SparkSession, list] = {}  # writes under way, and the setting before


def create_spark(app_name: str = "shoplake", **settings: str) -> SparkSession:
    """A session in UTC with adaptive execution; on a cluster pass the cluster's own settings."""
    builder = SparkSession.builder.appName(app_name)
    defaults = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true"}
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no files of its shuffles, which otherwise stay until the
    driver happens to collect its garbage. For writes that are not run a second time; several may
    be under way at once. A setting of the user's stays, and is back afterwards."""
    with _lock:
        if spark not in _writing:
            before = spark.conf.get(CLEANUP) if spark.conf.isModifiable(CLEANUP) else None
            _writing[spark] = [0, before]
            if before is not None:
                spark.conf.set(CLEANUP, "true")
        _writing[spark][0] += 1
    try:
        yield
    finally:
        with _lock:
            _writing[spark][0] -= 1
            if not _writing[spark][0] and (before := _writing.pop(spark)[1]) is not None:
                spark.conf.set(CLEANUP, before)


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name below the one all executors share; local runs may fall back to /tmp."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/shoplake-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return os.path.join(tempfile.mkdtemp(prefix="run-"), "shoplake")
