"""Tables that are replaced in one step.

Every write goes to a new folder below the table's. A small file names the folder that counts;
it is swapped once all rows are there. A run that ends halfway leaves the table as it was, and
readers never see half of one. The file also says what the table was made from, so that a
later run can tell whether it is still up to date.
"""

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "_current"
PREFIX = "v-"


class Files:
    """The few things that are done to single files, in any store that Spark knows."""

    def __init__(self, spark: SparkSession, folder: str):
        self.context = spark.sparkContext
        self.hadoop = self.context._jvm.org.apache.hadoop.fs
        self.settings = self.context._jsc.hadoopConfiguration()
        self.folder = self.hadoop.Path(folder)
        self.system = self.folder.getFileSystem(self.settings)

    def at(self, name: str):
        return self.hadoop.Path(self.folder, name)

    def read(self, name: str) -> str | None:
        if not self.system.exists(self.at(name)):
            return None
        stream = self.system.open(self.at(name))
        try:
            return self.context._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """In one step where the store can rename in one."""
        new = self.at(f"{name}-{uuid.uuid4().hex}")
        stream = self.system.create(new)
        stream.write(bytearray(text.encode()))
        stream.close()
        found = self.hadoop.FileContext.getFileContext(self.folder.toUri(), self.settings)
        kind = self.hadoop.Options.Rename
        how = self.context._gateway.new_array(kind, 1)
        how[0] = kind.OVERWRITE
        found.rename(self.system.makeQualified(new), self.system.makeQualified(self.at(name)), how)

    def folders(self) -> list[str]:
        found = self.system.listStatus(self.folder) if self.system.exists(self.folder) else []
        return [f.getPath().getName() for f in found if f.isDirectory()]

    def drop(self, name: str) -> None:
        self.system.delete(self.at(name), True)


def mark(spark: SparkSession, path: str) -> dict | None:
    """What the last complete write of a table said; nothing if there was none."""
    text = Files(spark, path).read(POINTER)
    return None if text is None else json.loads(text)


def current(spark: SparkSession, path: str) -> str:
    """The folder that holds a table's rows: the table's own if it was written as plain files."""
    found = mark(spark, path)
    return path if found is None else f"{path.rstrip('/')}/{found['version']}"


def next_version(path: str) -> str:
    return f"{path.rstrip('/')}/{PREFIX}{uuid.uuid4().hex}"


def commit(spark: SparkSession, path: str, written: str, said: Mapping | None = None) -> None:
    """Let the table be what was written to this folder."""
    version = written.rsplit("/", 1)[1]
    Files(spark, path).replace(POINTER, json.dumps({**(said or {}), "version": version}))


def drop_old_versions(spark: SparkSession, path: str) -> int:
    """Delete what is not the table any more, or never was; returns how many folders. Not to be
    run while the table is read or written."""
    files, found = Files(spark, path), mark(spark, path)
    old = [f for f in files.folders() if f.startswith(PREFIX) and found and f != found["version"]]
    for name in old:
        files.drop(name)
    return len(old)


def file_list(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path, length, modificationTime`` of the files of a folder or list; their content is not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", "modificationTime")


def fingerprint(spark: SparkSession, path: str) -> str:
    """Changes when a file of a folder comes, goes or is written again."""
    own = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    found = file_list(spark, path).agg(F.count(F.lit(1)), F.sum(own)).first()
    return f"{found[0]}:{found[1]}"
