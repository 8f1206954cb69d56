"""IO-13, by object: copy the files that a source has and a destination lacks, byte for byte."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from hourcast.session import ScratchScope
from hourcast.sinks.util import materialize
from hourcast.sources.store import list_objects, open_store

#: Bytes that a task holds of a file it copies.
CHUNK = 8 << 20


def missing_objects(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """(path, length) of the files below ``src`` that ``dst`` does not have with the same path and size."""
    have = list_objects(spark, dst).select("path", "length")
    return list_objects(spark, src).select("path", "length").join(have, ["path", "length"], "left_anti")


def sync_objects(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """Copies what is missing and returns it: (path, length) of every file copied.

    Both roots are listed (names and sizes only) and compared file by file, so a folder that was copied
    in part is completed, one for a NULL value is a folder like any other, and files whose size
    differs are replaced. Other files of the destination stay. Tasks copy in chunks to a hidden folder of the job
    and move each file to its place when it is whole; what a killed task leaves there is
    deleted with that folder. A second run finds nothing to copy.
    """
    job = f"_sync-{uuid.uuid4().hex[:12]}"

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        (source, a), (target, b), attempt = open_store(src), open_store(dst), TaskContext.get().taskAttemptId()
        for batch in it:
            for n, path in enumerate(batch.column("path").to_pylist()):
                held, place = f"{b}/{job}/{attempt}", f"{b}/{path}"
                target.create_dir(held, recursive=True)
                with source.open_input_stream(f"{a}/{path}") as read, target.open_output_stream(f"{held}/{n}") as write:
                    while chunk := read.read(CHUNK):
                        write.write(chunk)
                target.create_dir(place.rsplit("/", 1)[0], recursive=True)
                target.move(f"{held}/{n}", place)
            yield batch

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        with ScratchScope(spark) as scratch:
            wanted = materialize(missing_objects(spark, src, dst), "missing_objects")
            return scratch.hand_over(wanted.repartition(parts, "path").mapInArrow(run, "path string, length long"), "copied_objects")
    finally:
        from pyarrow.fs import FileType

        target, b = open_store(dst)
        if target.get_file_info(f"{b}/{job}").type == FileType.Directory:
            target.delete_dir(f"{b}/{job}")
