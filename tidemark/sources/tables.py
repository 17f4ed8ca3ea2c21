"""Parquet tables partitioned by part, rebuilt in whole parts."""

from __future__ import annotations

import hashlib
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import VERSION, stored


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, version: bool = False
) -> DataFrame:
    """A stored table in its declared columns, with ``row_version`` if asked for."""
    columns = schema.names + ([VERSION.name] if version else [])
    return spark.read.schema(stored(schema)).parquet(path).select(*columns)


def replace_parts(
    df: DataFrame,
    path: str,
    first: date,
    last: date,
    schema: T.StructType,
    key: list[str],
    part: str = "part_name",
) -> None:
    """Make parts ``first`` to ``last`` of a table hold exactly the rows of ``df`` in that range.

    Rerunning replaces the same parts and touches no others. A part without rows in ``df`` is emptied: the
    job itself reports which parts it wrote, and the folders of the others in the range go. Rows are
    gathered by part without forcing a large part into one task, and sorted by key so that row groups can
    be skipped; texts of the key get bloom filters, for those that lie between a row group's least and greatest.
    """
    texts = [c for c in key if isinstance(schema[c].dataType, T.StringType)]
    written = Observation()
    rows = in_parts(df.select(*schema.names), part, first, last).hint("rebalance", part)
    (
        stamped(rows, schema)
        .sortWithinPartitions(part, *[c for c in key if c != part])
        .observe(written, F.collect_set(part).alias("parts"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**{f"parquet.bloom.filter.enabled#{c}": True for c in texts})
        .partitionBy(part)
        .parquet(path)
    )
    drop_unwritten(df.sparkSession, path, part, first, last, written.get["parts"])


def in_parts(df: DataFrame, part: str, first: date, last: date) -> DataFrame:
    """Rows of parts ``first`` to ``last``."""
    return df.where(F.col(part).between(F.lit(first), F.lit(last)))


def stamped(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a table, with the version of rows written now."""
    return df.select(*schema.names).withColumn(VERSION.name, F.lit(datetime.now(timezone.utc)))


def drop_unwritten(
    spark: SparkSession, path: str, part: str, first: date, last: date, written: list[date]
) -> None:
    """Remove the folders of parts ``first`` to ``last`` that a job has not written."""
    kept = {f"{part}={day.isoformat()}" for day in written}
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.listStatus(folder):
        name = found.getPath().getName()
        key_name, _, value = name.partition("=")
        if key_name == part and name not in kept and first.isoformat() <= value <= last.isoformat():
            files.delete(found.getPath(), True)


def truncate(
    spark: SparkSession, path: str, schema: T.StructType, part: str = "part_name"
) -> None:
    """Drop all rows of a table; it still reads, as no rows of the same columns."""
    (
        spark.createDataFrame([], stored(schema))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(part)
        .parquet(path)
    )


def parts_state(spark: SparkSession, path: str, first: date, last: date, part: str = "part_name") -> str:
    """A digest of the files in parts ``first`` to ``last`` of a table; it changes with every rewrite of one.

    Names, sizes and times of the files are read from their folders, and nothing of their contents.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return ""
    found = []
    for folder in files.listStatus(root):
        key, _, value = folder.getPath().getName().partition("=")
        if key == part and first.isoformat() <= value <= last.isoformat():
            for f in files.listStatus(folder.getPath()):
                found.append(f"{value}/{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


class RunLog:
    """Finished runs, each in a small file of a folder, with the state of what they read and wrote."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.root = self._path(folder)
        self.files = self.root.getFileSystem(spark._jsc.hadoopConfiguration())

    def read(self, name: str) -> str | None:
        """What was noted of a run."""
        place = self._path(self.root, name)
        if not self.files.exists(place):
            return None
        stream = self.files.open(place)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, state: str) -> None:
        """Note a run; the note appears whole or not at all."""
        place, beside = self._path(self.root, name), self._path(self.root, f"_{name}")
        stream = self.files.create(beside, True)
        stream.write(state.encode())
        stream.close()
        self.files.delete(place, False)
        self.files.rename(beside, place)
