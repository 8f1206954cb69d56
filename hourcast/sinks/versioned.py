"""Published versions of a partitioned dataset: a reader sees a version whole, or the one before.

A version's new partitions lie below ``root/publication=<number>``; ``root/_manifest/v=<number>`` lists the folder of
every partition that belongs to the version, whichever version wrote it, with statistics of its rows. A version
exists once its manifest's ``_SUCCESS`` file does, which Spark's committer writes last. So a job that dies while it
writes changes nothing for readers; the next job writes over what it left. Partitions that are not written again are
carried over by their line in the manifest: what a job writes doesn't grow with the dataset.

One job at a time may publish to a root. Read with ``read_version``: a plain scan of the root would see all versions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from hourcast.sinks.util import materialize
from hourcast.sources.store import folder_value, list_folders, list_objects, segment

OWN = ["folder", "version", "n_files", "n_bytes"]


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published versions, ascending."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/_manifest/v=*/_SUCCESS")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(int(re.search(r"/v=(\d+)/_SUCCESS$", s.getPath().toString())[1]) for s in found or [])


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """Partitions of a version (the newest, if not given): the keys, ``folder`` below the root, ``version`` that wrote
    it, ``n_files``, ``n_bytes`` and the statistics it was published with. None if nothing is published."""
    known = versions(spark, root)
    if version is None:
        version = known[-1] if known else None
    elif version not in known:
        raise ValueError(f"version {version} is not published; there are {known}")
    return None if version is None else spark.read.parquet(f"{root.rstrip('/')}/_manifest/v={version}")


def read_version(spark: SparkSession, root: str, schema: T.StructType, version: int | None = None,
                 where: Column | None = None) -> DataFrame:
    """Rows of a version (the newest, if not given); ``schema`` includes the partition columns.

    ``where`` is a condition on the manifest. Only folders of partitions that meet it are listed and read. An
    unpublished dataset reads as empty.
    """
    lines = manifest(spark, root, version)
    if lines is None:
        return spark.createDataFrame([], schema)
    base = root.rstrip("/")
    # one path a wanted partition, as any scan of a partitioned dataset holds on the driver
    folders = [r["folder"] for r in (lines if where is None else lines.where(where)).select("folder").collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders]).select(*schema.names)


def publish(spark: SparkSession, root: str, rows: DataFrame, keys: list[str], carry: DataFrame | None = None,
            statistics: dict[str, Column] | None = None, sort_cols: list[str] | None = None) -> int:
    """Write ``rows`` as the partitions of a new version, beside those of ``carry``, and return its number.

    ``carry`` has manifest lines of the version before; lines of partitions that ``rows`` holds are
    replaced. ``statistics`` are aggregates of a partition's rows, kept in the manifest. Key values are read back as text.
    """
    base, known = root.rstrip("/"), versions(spark, root)
    number = (known[-1] if known else 0) + 1
    if "publication" in rows.columns:
        raise ValueError("the folders of a published dataset use the name publication")
    data = f"{base}/publication={number}"
    out = rows.hint("rebalance", *keys)
    if sort_cols:
        out = out.sortWithinPartitions(*keys, *sort_cols)
    # static: what a job that died left under this number goes
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*keys).parquet(data)
    folders = list_folders(list_objects(spark, data), len(keys))
    names = [folder_value(segment(F.col("path"), k + 1), key).alias(key) for k, key in enumerate(keys)]
    lines = folders.select(*names, F.concat(F.lit(f"publication={number}/"), "path").alias("folder"), F.lit(number).alias("version"), "n_files", "n_bytes")
    if statistics:
        text = T.StructType([T.StructField(f.name, T.StringType() if f.name in keys else f.dataType) for f in rows.schema])
        written = spark.read.schema(text).option("basePath", data).parquet(data) if folders.take(1) else spark.createDataFrame([], text)
        counts = written.groupBy(*keys).agg(*[c.alias(n) for n, c in statistics.items()])
        lines = _join(lines, counts, keys, "left")
    lines = materialize(lines, "manifest_lines")
    if carry is not None:
        lines = _join(carry, lines.select(*keys), keys, "left_anti").select(*lines.columns).unionByName(lines)
    (lines.coalesce(8).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{base}/_manifest/v={number}"))
    return number


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys that may be NULL; the left side's keys are kept."""
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(right, same, how).drop(*[f"_r_{k}" for k in keys])


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete all but the last ``keep`` versions: their manifests, and the folders that no kept version lists.

    Returns the number of folders deleted. Readers of a kept version are not disturbed.
    """
    base, known = root.rstrip("/"), versions(spark, root)
    old, kept = known[:-keep], known[-keep:]
    if not old:
        return 0
    lines = [manifest(spark, root, v).select("folder") for v in (*old, *kept)]
    used, all_lines = lines[len(old)], lines[0]
    for x in lines[len(old) + 1:]:
        used = used.unionByName(x)
    for x in lines[1:len(old)]:
        all_lines = all_lines.unionByName(x)
    dead = [r["folder"] for r in all_lines.distinct().join(used, "folder", "left_anti").collect()]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in [*(f"{base}/_manifest/v={v}" for v in old), *(f"{base}/{f}" for f in dead)]:  # manifests first: no version lists what is gone
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    return len(dead)
