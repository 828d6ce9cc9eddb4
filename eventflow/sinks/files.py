"""CSV and parquet writers for results and snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventflow.sources.files import delete_path, list_children


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite", order_by=()) -> None:
    """CSV with header, in the order ``order_by`` if given (over the part files in the
    order of their names).  ``single_file`` is for results of bounded size only (top-n,
    one row per day): it funnels all rows through one task."""
    if single_file:
        out = df.repartition(1)
        out = out.sortWithinPartitions(*order_by) if order_by else out
    else:
        out = df.orderBy(*order_by) if order_by else df
    out.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_versioned_snapshot(df: DataFrame, folder: str, version: int, keep: int = 2) -> None:
    """Write ``df`` as CSV to ``folder/batch=<version>`` and drop all but the newest
    ``keep`` versions.  A reader (``sources.files.read_latest_snapshot``) picks the
    newest version with a ``_SUCCESS`` marker, so it never sees a half-written or
    empty snapshot, unlike an in-place overwrite."""
    spark = df.sparkSession
    write_csv(df, f"{folder.rstrip('/')}/batch={version}")
    prune_versions(spark, folder, keep)


def prune_versions(spark: SparkSession, folder: str, keep: int) -> None:
    versions = sorted(
        int(name.split("=", 1)[1])
        for name, is_dir in list_children(spark, folder)
        if is_dir and name.startswith("batch=") and name.split("=", 1)[1].isdigit()
    )
    for version in versions[:-keep] if keep > 0 else versions:
        delete_path(spark, f"{folder.rstrip('/')}/batch={version}")
