"""Object stores: listings without reading content, and streams for tasks that copy or write files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

LISTING = "path string, length long, modified timestamp"


def open_store(uri: str):
    """(pyarrow file system, path in it) of a root as Spark names it; works on the driver and in tasks."""
    from pyarrow.fs import FileSystem

    scheme, colon, rest = uri.partition(":")
    if colon and scheme in ("file", "s3a", "s3n"):
        uri = f"{'file' if scheme == 'file' else 's3'}://{'/' if scheme == 'file' else ''}{rest.lstrip('/')}"
    return FileSystem.from_uri(uri.rstrip("/"))


def qualified(spark: SparkSession, root: str) -> str:
    """``root`` with its scheme, as listings spell it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")


def list_objects(spark: SparkSession, root: str, folders: str = "") -> DataFrame:
    """IO-06: (path, length, modified) of every file below ``root``; ``path`` is relative to it.

    Only names and sizes are read, no file is opened. ``folders`` is a glob of folders below the root
    (``gefs.202401*``) that narrows the listing itself. Names that start with ``_`` or ``.``
    are markers and temporary files and are left out, as by every Spark reader; so are files of no bytes. A root that does not exist,
    or a glob that nothing matches, is an empty listing; any other failure is raised.
    """
    base = qualified(spark, root)
    target = f"{root.rstrip('/')}/{folders}" if folders else root
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(target)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING)
    return files.select(F.substring("path", F.lit(len(base) + 2), F.length("path")).alias("path"), "length",
                        F.col("modificationTime").alias("modified"))


def segment(path: Column, place: int) -> Column:
    """Folder or file name at a place of a listing's path (1: the first; -1: the last); NULL if there is none."""
    return F.try_element_at(F.split(path, "/"), F.lit(place))


def list_folders(listing: DataFrame, depth: int) -> DataFrame:
    """IO-05 / IO-06: (path, n_files, n_bytes, modified) of every folder ``depth`` levels below the root that holds a file.

    Files are counted before anything is shuffled: one row a folder and task.
    """
    parts = F.split("path", "/")
    inside = listing.where(F.size(parts) > depth)
    return inside.groupBy(F.array_join(F.slice(parts, 1, depth), "/").alias("path")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"), F.max("modified").alias("modified"))


def folder_values(listing: DataFrame, names: list[str]) -> DataFrame:
    """IO-05: (the names, n_files, n_bytes, modified): partitions of a dataset, from its folders alone.

    A folder is the bare value, or ``name=value``; both spell NULL and special characters as the writers here and Spark do.
    """
    found = list_folders(listing, len(names))
    return found.select(*[folder_value(segment(F.col("path"), k + 1), n).alias(n) for k, n in enumerate(names)],
                        "n_files", "n_bytes", "modified")


#: How a missing value is spelled as a folder: bare, and by Hive-style writers; and how the empty text is.
NULL_FOLDER, EMPTY_FOLDER = "%NULL", "%EMPTY"
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


def folder_value(name: Column, column: str) -> Column:
    """The value a folder stands for: bare or ``column=value``, escapes undone; NULL for the marks of a missing value."""
    bare = F.regexp_replace(name, f"^{column}=", "")
    plain = F.coalesce(F.try_url_decode(F.replace(bare, F.lit("+"), F.lit("%2B"))), bare)
    return F.when(bare == EMPTY_FOLDER, "").when(~bare.isin(NULL_FOLDER, HIVE_NULL), plain)


def folder_name(value) -> str:
    """A folder for a value: ``NULL_FOLDER`` for None; characters that stores or readers treat specially are escaped."""
    if value is None:
        return NULL_FOLDER
    text = str(value)
    special = {c for c in text if c in "/\\:*?\"<>|%={}[]^#'" or ord(c) < 32 or c == "\x7f"}
    out = "".join(f"%{ord(c):02X}" if c in special else c for c in text)
    if out[:1] in ("_", "."):
        out = f"%{ord(out[0]):02X}{out[1:]}"
    return out or EMPTY_FOLDER
