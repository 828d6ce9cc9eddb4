"""File readers: raw CSV, batch/stream result folders, raw archive.

Paths are checked through the Hadoop ``FileSystem`` of the session, so the same
code works for ``hdfs://``, ``s3a://``, ``file:`` and scheme-less paths.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.functions.time import lenient_date, lenient_timestamp
from eventflow.schemas import RAW_COLUMNS, RAW_SCHEMA


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hpath, fs = _hadoop_path(spark, path)
    return bool(fs.exists(hpath))


def list_children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """``(name, is_dir)`` of the direct children of a folder; empty if missing."""
    hpath, fs = _hadoop_path(spark, path)
    if not fs.exists(hpath):
        return []
    return [(st.getPath().getName(), bool(st.isDirectory())) for st in fs.listStatus(hpath)]


def path_size(spark: SparkSession, path: str) -> int:
    """Total bytes under a path (file or folder), from the file system's metadata."""
    hpath, fs = _hadoop_path(spark, path)
    return int(fs.getContentSummary(hpath).getLength())


def make_folder(spark: SparkSession, path: str) -> None:
    hpath, fs = _hadoop_path(spark, path)
    fs.mkdirs(hpath)


def create_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> bool:
    """Create a small text file; False if it is there already (unless ``overwrite``)."""
    hpath, fs = _hadoop_path(spark, path)
    try:
        out = fs.create(hpath, overwrite)
    except Exception:
        if not overwrite and fs.exists(hpath):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file as a whole."""
    hpath, fs = _hadoop_path(spark, path)
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete_path(spark: SparkSession, path: str) -> None:
    hpath, fs = _hadoop_path(spark, path)
    if fs.exists(hpath):
        fs.delete(hpath, True)


def resolve_input(spark: SparkSession, candidates: Iterable[str]) -> str:
    """First existing path of ``candidates`` (any scheme); fail loud otherwise.  A store
    that cannot be asked (no such scheme, no access, time-out) is an error, not a
    reason to take the next candidate."""
    tried = []
    for path in candidates:
        if not path:
            continue
        tried.append(path)
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(
        "no input found; tried: " + ", ".join(tried) + ". Place the raw events CSV "
        "(columns timestamp, visitorid, event, itemid, transactionid) at one of them."
    )


def read_events_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Raw clickstream CSV with header.

    Permissive: an unreadable number becomes NULL, a short row is padded with NULL,
    extra fields are dropped, an empty field is NULL.  ``enforceSchema=false``
    checks the header against the schema, so a file with reordered columns fails
    instead of being misread.
    """
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .schema(schema)
        .csv(path)
    )


def read_result_folder(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """A folder of ``part-*.csv`` files written by a snapshot sink, as one table.

    A missing folder, or one without part files, gives an empty DataFrame with the
    same schema.  A file that cannot be read, or whose header differs from the schema,
    is an error.  Values are read as text and typed leniently: a cell that does not
    parse becomes NULL.
    """
    if not any(name.startswith("part-") and name.endswith(".csv") for name, _ in list_children(spark, folder)):
        return spark.createDataFrame([], schema)
    return read_result_files(spark, [folder], schema)


def read_result_files(spark: SparkSession, folders: list[str], schema: T.StructType, **options) -> DataFrame:
    """The ``part-*.csv`` files of several folders as one table, typed like
    :func:`read_result_folder`; without folders an empty one."""
    if not folders:
        return spark.createDataFrame([], schema)
    text_schema = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    raw = (
        spark.read.option("header", True)
        .option("pathGlobFilter", "part-*.csv")
        .option("enforceSchema", False)
        .options(**options)
        .schema(text_schema)
        .csv(folders)
    )
    cols = []
    for f in schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(lenient_timestamp(f.name).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(lenient_date(f.name).alias(f.name))
        else:
            cols.append(raw[f.name].try_cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def read_latest_snapshot(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Newest complete ``batch=<id>`` version of a versioned snapshot folder
    (see ``sinks.files.write_versioned_snapshot``); plain folders are read as is."""
    versions = sorted(
        (int(name.split("=", 1)[1]) for name, is_dir in list_children(spark, folder)
         if is_dir and name.startswith("batch=") and name.split("=", 1)[1].isdigit()),
        reverse=True,
    )
    for version in versions:
        sub = f"{folder.rstrip('/')}/batch={version}"
        if path_exists(spark, f"{sub}/_SUCCESS"):
            return read_result_folder(spark, sub, schema)
    return read_result_folder(spark, folder, schema)


def read_archive(spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """Raw archive (parquet of the 7 message fields) replayed as raw clickstream rows,
    ready for the same batch operators as the CSV input.  The folder is that of the
    archive query or of the landing query.

    ``first_day`` / ``last_day`` (``YYYY-MM-DD``, inclusive) select days of an
    archive written with ``partition_by_date``; the filter is on the partition
    column, so other days' folders are never listed into the scan."""
    archive = spark.read.parquet(path)
    if "kind" in archive.columns:  # the folder of the landing query holds junk records too
        archive = archive.filter(F.col("kind") == "event")
    if (first_day or last_day) and "event_date" not in archive.columns:
        raise ValueError(f"{path} is not partitioned by event_date; a range of days needs an archive written by date")
    if first_day:
        archive = archive.filter(F.col("event_date") >= F.lit(first_day).cast("date"))
    if last_day:
        archive = archive.filter(F.col("event_date") <= F.lit(last_day).cast("date"))
    return archive.select(*RAW_COLUMNS)


def read_parquet_result(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet result written by ``sinks.files.write_parquet``; empty if missing."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
