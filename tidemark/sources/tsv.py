r"""Tab-separated text with a header row.

Tabs, line ends, NULs and backslashes inside values are written as ``\t``, ``\n``, ``\r``, ``\0`` and
``\\``, and a missing value as ``\N``, so every row is one line and files can be split between tasks.
Columns are found by the names in the header, in whatever order they stand.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Escapes of the text format.
ESCAPES = [("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"), ("\0", "\\0")]
MISSING = "\\N"
HEADER_FILES = 1000  # files whose headers the driver reads itself

_OPTIONS = {
    "sep": "\t",
    "header": True,
    "quote": "",
    "escape": "\0",
    "lineSep": "\n",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_tsv(df: DataFrame, path: str) -> None:
    """Write a frame of plain columns, replacing what is at ``path``.

    Readers skip blank lines, so an empty text in a frame of one column is refused.
    """
    columns = [_escaped(f) for f in df.schema]
    if len(columns) == 1:
        blank = F.raise_error(F.lit("an empty text in a single column would be lost"))
        columns = [F.when(columns[0] == "", blank).otherwise(columns[0])]
    rows = df.select([c.alias(f.name) for c, f in zip(columns, df.schema)])
    rows.write.mode("overwrite").options(**_OPTIONS).csv(path)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read what ``write_tsv`` wrote, in the declared types.

    Files of one header are read together and their columns found by name; headers may differ in order and in
    columns that are not declared. None of the declared ones may be missing in any file.
    """
    found = None
    for files in _by_header(spark, path).values():
        rows = _read_alike(spark, files, schema)
        found = rows if found is None else found.unionByName(rows)
    return spark.createDataFrame([], schema) if found is None else found


def _read_alike(spark: SparkSession, files: list[str], schema: T.StructType) -> DataFrame:
    """Files that all have the header of the first one."""
    names = spark.read.options(**_OPTIONS).csv(files[0]).columns
    missing = [f.name for f in schema if f.name not in names]
    if missing:
        raise ValueError(f"the header of {files[0]} lacks {', '.join(missing)}")
    texts = T.StructType([T.StructField(n, T.StringType()) for n in names])
    options = _OPTIONS | {"mode": "FAILFAST", "enforceSchema": False}
    rows = spark.read.schema(texts).options(**options).csv(files)
    return rows.select([_unescaped(f).alias(f.name) for f in schema])


def _by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files at a path, or in a folder, by their first lines; files without a line are left out."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    held = [f for f in fs.globStatus(root) or []]
    held = [f for found in held for f in (fs.listStatus(found.getPath()) if found.isDirectory() else [found])]
    files = [f.getPath().toString() for f in held if not f.getPath().getName().startswith(("_", "."))]
    if len(files) > HEADER_FILES:
        return _by_header_of_many(spark, files)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    groups: dict[str, list[str]] = {}
    for name in files:
        place = jvm.org.apache.hadoop.fs.Path(name)
        stream, codec = fs.open(place), codecs.getCodec(place)
        opened = codec.createInputStream(stream) if codec else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(opened, "UTF-8"))
        try:
            header = reader.readLine()
        finally:
            reader.close()
        if header is not None:
            groups.setdefault(header, []).append(name)
    return groups


def _by_header_of_many(spark: SparkSession, files: list[str]) -> dict[str, list[str]]:
    """The same of many files, found by the tasks that read them; a row for each file comes to the driver."""
    lines = spark.read.option("lineSep", "\n").text(files)
    lines = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("line")).alias("place"),
        "value",
    )
    first = lines.groupBy("file").agg(F.min_by("value", "place").alias("header"))
    groups: dict[str, list[str]] = {}
    for row in first.orderBy("file").collect():
        groups.setdefault(row["header"], []).append(unquote(row["file"]))
    return groups


def _is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType)


def _escaped(field: T.StructField) -> Column:
    value = F.col(field.name)
    if _is_text(field):
        for raw, written in ESCAPES:
            value = F.replace(value, F.lit(raw), F.lit(written))
    return F.coalesce(value.cast("string"), F.lit(MISSING))


def _undone(stretch: Column) -> Column:
    for raw, escaped in ESCAPES[1:]:
        stretch = F.replace(stretch, F.lit(escaped), F.lit(raw))
    return stretch


def _unescaped(field: T.StructField) -> Column:
    written = F.col(field.name)
    value = F.coalesce(written, F.lit(""))  # the reader takes an empty field for a missing one
    if _is_text(field):
        # a doubled backslash ends one stretch and begins the next; inside, the others are undone
        stretches = F.split(value, r"\\\\", -1)
        value = F.array_join(F.transform(stretches, _undone), "\\")
    return F.when(written.isNull() | (written != MISSING), value.cast(field.dataType))
