"""Session settings the pipeline relies on."""

from __future__ import annotations

import functools
import os
import re
import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings every job needs, whatever the cluster size.
REQUIRED_CONF = {
    # All times are UTC; day-of-year, hour and dates must not follow a local zone.
    "spark.sql.session.timeZone": "UTC",
    # Partition values such as reference_datetime=2024-01-01 stay strings.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Rewrite only the partitions a job produces.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "hourcast",
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings in REQUIRED_CONF.

    On a cluster the master and sizes come from spark-submit; this helper is for
    tests, the bench and notebooks.
    """
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("HOURCAST_DRIVER_MEMORY", "16g")))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_conf(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings on an existing session (e.g. one the driver made)."""
    for k, v in REQUIRED_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a running session: keep what is there
            pass


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). Where neither
    is set a cluster has no folder that all executors share, so this fails; only a
    local master gets a folder under the system temp dir.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base and not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="hourcast-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES.get():
        _SCOPES.get()[-1].paths.append(path)
    return path


#: Open scopes of the running job, the innermost last.
_SCOPES: ContextVar[tuple["ScratchScope", ...]] = ContextVar("scratch_scopes", default=())


class ScratchScope:
    """IO-14: owns the scratch folders that are named while it is open, and deletes them when it closes, after failures too.

    A result that must outlive the scope is written by ``hand_over``; its folder belongs to the scope around, or to
    the caller if there is none.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def __enter__(self) -> "ScratchScope":
        self._around = _SCOPES.set((*_SCOPES.get(), self))
        return self

    def __exit__(self, *failure) -> None:
        _SCOPES.reset(self._around)
        for path in self.paths:
            drop_scratch(self.spark, path)

    def hand_over(self, df, name: str = "table"):
        """``df`` written to a folder that stays, and read back; everything in the scope may go then."""
        inner = _SCOPES.set(_SCOPES.get()[:-1])
        try:
            path = scratch_dir(self.spark, name)
        finally:
            _SCOPES.reset(inner)
        df.write.mode("overwrite").parquet(path)
        out = self.spark.read.parquet(path)
        out.scratch_path = path
        return out


def owns_scratch(job):
    """Decorator of a job (spark, ...) whose result needs none of the scratch folders it makes."""
    @functools.wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        with ScratchScope(spark):
            return job(spark, *args, **kwargs)
    return run


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_dir`` named, once a job no longer needs it."""
    if not re.search(r"/[^/]+-[0-9a-f]{12}$", path):
        raise ValueError(f"not a scratch folder: {path}")
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
