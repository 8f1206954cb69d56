"""Parquet datasets: scans, partition inventories, listings (IO-01..06, IO-13)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from hourcast.schemas import NATIVE_VARIABLES
from hourcast.sources.store import folder_name, folder_value


def read_dataset(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """IO-01: scan a Hive-partitioned Parquet dataset (partition values stay strings
    when the schema says so; filters on partition columns prune directories)."""
    r = spark.read.option("basePath", root)
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(root)


def read_if_exists(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Like ``read_dataset``; a root that does not exist reads as empty, any other failure is raised."""
    try:
        return read_dataset(spark, root, schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_partitions(spark: SparkSession, root: str, column: str, values, schema=None) -> DataFrame:
    """IO-03: read only some partitions (pruned by Catalyst), values kept as a column."""
    df = read_dataset(spark, root, schema)
    vals = values if isinstance(values, (list, tuple)) else [values]
    return df.filter(F.col(column).isin(list(vals)))


def native_variables(df: DataFrame) -> DataFrame:
    """PF-01: keep the eight native variables (pushed into the Parquet scan)."""
    return df.filter(F.col("variable").isin(NATIVE_VARIABLES))


def listed_sites(df: DataFrame, sites: DataFrame) -> DataFrame:
    """PF-02: keep rows of listed sites (semi join; the planner broadcasts the list by its size in bytes)."""
    return df.join(sites.select("site_id").distinct(), "site_id", "left_semi")


def partition_values(df: DataFrame, column: str) -> DataFrame:
    """IO-05: distinct values of a partition column. On a partitioned scan this
    reads no data columns (ReadSchema is empty)."""
    return df.select(F.col(column).cast("string").alias(column)).distinct()


def positional_glob(root: str, names: list[str], values: dict | None = None) -> str:
    """Path glob for a positional layout root/<name1>/<name2>/.../file, fixing
    the given values (others are any but hidden names) so only matching folders are listed."""
    values = values or {}
    parts = [folder_name(values[n]) if n in values else "[^._]*" for n in names]
    return "/".join([root.rstrip("/")] + parts + ["[^._]*"])


def read_positional(spark: SparkSession, root: str, names: list[str], schema: T.StructType,
                    values: dict | None = None) -> DataFrame:
    """IO-02: scan a dataset whose folders carry values without ``name=``
    (e.g. cycle/start_date/site_id/part-0.parquet); the names become string
    columns taken from each row's file path, a folder for NULL included."""
    path = positional_glob(root, names, values)
    df = spark.read.schema(schema).parquet(path)
    parts = F.split(F.col("_metadata.file_path"), "/")
    n = len(names)
    # a folder is the bare value, or name=value when written by a Hive-style writer; the file path is a URI
    raw = [F.url_decode(F.replace(F.element_at(parts, -(n + 1) + i), F.lit("+"), F.lit("%2B"))) for i in range(n)]
    cols = [folder_value(r, nm).alias(nm) for r, nm in zip(raw, names, strict=True)]
    return df.select(*cols, *[F.col(c) for c in df.columns if c not in names])


def listing_days(listing: DataFrame, path_col: str = "path", prefix: str = "gefs.") -> DataFrame:
    """IO-06: top-level names of a listing and the day they encode (bad -> NULL).

    A name such as 'gefs.20240131' gives 2024-01-31; 'index.html' gives NULL.
    """
    top = F.element_at(F.split(F.col(path_col), "/"), 1)
    day = F.try_to_date(F.regexp_replace(top, "^" + prefix.replace(".", "\\.") + r"(\d{8})$", "$1"),
                        "yyyyMMdd")
    return listing.select(F.col(path_col), top.alias("name"), day.alias("day"))


def missing_partitions(src: DataFrame, dst: DataFrame, column: str) -> DataFrame:
    """IO-13 (inventory part): partition values present in src but not in dst."""
    have = partition_values(dst, column).withColumnRenamed(column, "_have")
    return partition_values(src, column).join(have, F.col(column).eqNullSafe(F.col("_have")), "left_anti")
