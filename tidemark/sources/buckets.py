"""Parquet tables partitioned by part and bucketed by symbol, so that joins and groups by symbol need no shuffle.

Each part lies in the same number of buckets, by the hash of the symbol. Two tables of the same number of buckets
meet on (symbol, part_name) bucket by bucket, if they are read with a session of ``joining_in_place``, and groups that
hold the symbol are built where their rows lie. A bucket of all parts in a query is one task: take enough buckets, and build long ranges in runs (``backfill`` does), where one
symbol has most of the rows. Tables without buckets deal by (symbol, part) instead, which spreads a symbol over its
parts, for the price of a shuffle.

The files are plain Parquet, and ``read_table`` reads them, too. The folder is the truth: sessions register it in their
catalog when they need it, from what the folder holds.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import VERSION, stored
from tidemark.sources.tables import RunLog, drop_unwritten, in_parts, stamped

NOTE = "_buckets"  # a file of the table's folder that tells how it is bucketed; readers skip its name


# A join on (symbol, part_name) may use rows that lie by symbol alone; by default Spark deals both sides anew.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def joining_in_place(spark: SparkSession) -> SparkSession:
    """A session like this one, to read tables with that are joined bucket by bucket; ``spark`` keeps its settings."""
    session = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    session.conf.set(ALL_KEYS, "false")
    return session


@dataclass(frozen=True)
class BucketedTable:
    """A table at ``path``: ``buckets`` files for each part (more once rows were appended), by the hash of ``by``."""

    path: str
    schema: T.StructType
    buckets: int
    part: str = "part_name"
    by: str = "symbol"

    @property
    def name(self) -> str:
        """What a session's catalog calls it, the same in every session."""
        layout = f"{self.path.rstrip('/')} {self.by} {self.buckets} {stored(self.schema).simpleString()}"
        return f"bucketed_{hashlib.sha256(layout.encode()).hexdigest()[:24]}"

    def register(self, spark: SparkSession) -> str:
        """Enter the table and its parts, as the folder holds them, in the session's catalog."""
        noted, layout = RunLog(spark, self.path), f"{self.by} {self.buckets}"
        found = noted.read(NOTE)
        if found is None:
            if noted.files.exists(noted.root) and noted.files.listStatus(noted.root):
                raise ValueError(f"{self.path} holds files that are not bucketed")
            noted.write(NOTE, layout)
        elif found != layout:
            raise ValueError(f"{self.path} is bucketed by {found}, not by {layout}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored(self.schema))
        location = self.path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (`{self.part}`) "
            f"CLUSTERED BY (`{self.by}`) INTO {self.buckets} BUCKETS LOCATION '{location}'"
        )
        self._refresh(spark)
        return self.name

    def _refresh(self, spark: SparkSession) -> None:
        spark.sql(f"MSCK REPAIR TABLE {self.name} SYNC PARTITIONS")

    def read(self, spark: SparkSession, version: bool = False) -> DataFrame:
        """The table in its declared columns, with ``row_version`` if asked for."""
        columns = self.schema.names + ([VERSION.name] if version else [])
        return spark.table(self.register(spark)).select(*columns)

    def replace(self, df: DataFrame, first: date, last: date) -> None:
        """Make parts ``first`` to ``last`` hold exactly the rows of ``df`` in that range, as ``replace_parts`` does."""
        spark, written = df.sparkSession, Observation()
        rows = self._dealt(in_parts(df, self.part, first, last))
        rows = rows.observe(written, F.collect_set(self.part).alias("parts"))
        name = self.register(spark)
        rows.write.mode("overwrite").insertInto(name)
        drop_unwritten(spark, self.path, self.part, first, last, written.get["parts"])
        self._refresh(spark)

    def append(self, df: DataFrame) -> None:
        """Add rows beside those that are there, as newer versions; ``latest_version`` finds the newest in place.

        A load that is repeated adds its rows again, as versions that are equal but for their time.
        """
        rows, name = self._dealt(df), self.register(df.sparkSession)
        rows.write.insertInto(name)
        self._refresh(df.sparkSession)

    def _dealt(self, df: DataFrame) -> DataFrame:
        """Rows as they are stored, in a task for each bucket, so that a part gets one file for each."""
        rows = stamped(df, self.schema)
        columns = [c for c in rows.columns if c != self.part] + [self.part]
        return rows.select(*columns).repartition(self.buckets, self.by)
