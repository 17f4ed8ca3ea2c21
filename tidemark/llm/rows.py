"""Small helpers on DataFrames that several operators share."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


CLEAR_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, or below the warehouse where that is not set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}")
    # a path without a scheme lies on the cluster's default file system, not on each worker's own disk
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()


def stored(df: DataFrame, batch_bytes: int | None = None) -> DataFrame:
    """The rows, written to a new shared folder and read back, so that lost executors cost no rework.

    Once they are written, the shuffle files behind them are of no more use and are cleared at once.
    Python workers get their rows in batches of about ``batch_bytes``, unless the session sets a size itself:
    10 000 rows, as many as Spark sends otherwise, may be texts of any size.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    before = spark.conf.get(CLEAR_SHUFFLES, "false")
    bounded = batch_bytes is not None and spark.conf.get(BATCH_BYTES, None) is None
    spark.conf.set(CLEAR_SHUFFLES, "true")
    if bounded:
        spark.conf.set(BATCH_BYTES, str(batch_bytes))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAR_SHUFFLES, before)
        if bounded:
            spark.conf.unset(BATCH_BYTES)
    held = spark.read.schema(df.schema).parquet(path)
    held.stored_folder = path
    return held


def discard(*frames: DataFrame) -> None:
    """Delete the folders of ``stored`` frames that nothing reads any more."""
    for held in frames:
        context = held.sparkSession.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(held.stored_folder)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def at_most(df: DataFrame, rows: int) -> DataFrame:
    """The frame, to be broadcast if it has no more than so many rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, so that their tasks can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp()) / f"{package.name}-{context.applicationId}.zip"
    with zipfile.ZipFile(archive, "w") as held:
        for file in sorted(package.rglob("*.py")):
            held.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The query, with the package sent to the executors before it runs."""

    @functools.wraps(query)
    def run(spark: SparkSession, *rest) -> DataFrame:
        ship(spark)
        return query(spark, *rest)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


Batches = Iterator[pa.RecordBatch]


def release() -> None:
    """Give memory that is free inside the process back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """For ``mapInArrow``: ``run``, with free memory given back after each batch.

    Workers live on between tasks and stages, and would each keep the most they ever used.
    """

    @functools.wraps(run)
    def released(batches: Batches) -> Batches:
        for made in run(batches):
            yield made
            del made
            release()

    return released


def by_batch(
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None],
) -> Callable[[Batches], Batches]:
    """For ``mapInArrow``: apply ``work`` to each batch."""

    @tidy
    def run(batches: Batches) -> Batches:
        for batch in batches:
            made = work(batch) if batch.num_rows else None
            if made is not None:
                yield made

    return run


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, bound: int, where: F.Column | None = None
) -> DataFrame:
    """doc_id, text and label (0 or 1) of at most ``bound`` labelled documents, drawn by a hash of the id.

    Rows without an id or a label are left out; of several labels of a document the largest counts, of
    several texts of an id the smallest. The drawn ids, at most ``bound``, are broadcast.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    if where is not None:
        known = known.where(where)
    drawn = known.groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    drawn = drawn.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = texts.join(F.broadcast(drawn), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
