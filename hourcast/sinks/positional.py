"""IO-09: one ``part-0.parquet`` a key, under folders that carry bare values (cycle/date/site/part-0.parquet)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from hourcast.sources.store import folder_name, open_store

FILE_NAME = "part-0.parquet"
#: Rows that a task holds before it writes a row group.
ROW_GROUP = 1 << 17


@dataclass
class Written(WriterCommitMessage):
    """Files of one task: (place within the job's folder, place below the root)."""

    files: list[tuple[str, str]]


class PositionalSink(DataSource):
    """``df.write.format("positional")`` with the options ``path`` and ``keys`` (names, by commas)."""

    @classmethod
    def name(cls) -> str:
        return "positional"

    def writer(self, schema, overwrite: bool) -> "PositionalWriter":
        return PositionalWriter(self.options["path"], self.options["keys"].split(","), uuid.uuid4().hex[:12])


class PositionalWriter(DataSourceArrowWriter):
    """Tasks write below a hidden folder of the job, one folder an attempt; the driver's commit moves the files of the
    attempts that count to their places. A failed attempt's files go with the job's folder, on commit and on abort."""

    def __init__(self, root: str, keys: list[str], job: str) -> None:
        self.root, self.keys, self.job = root, keys, f"_positional-{job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        store, root = open_store(self.root)
        attempt = str(TaskContext.get().taskAttemptId())
        files, out, held, rows, at = {}, None, [], 0, None

        def drain() -> None:
            nonlocal rows
            if held:
                out.write_table(pa.Table.from_batches(held))
                held.clear()
            rows = 0

        def close() -> None:
            if out:
                drain()
                out.close()

        for batch in iterator:
            for key, part in _runs(batch, self.keys):
                if out is None or key != at:
                    close()
                    place = "/".join([*map(folder_name, key), FILE_NAME])
                    if place in files:
                        raise ValueError(f"rows of {place} are not together")
                    files[place] = f"{attempt}/{len(files)}.parquet"
                    store.create_dir(f"{root}/{self.job}/{attempt}", recursive=True)
                    out, at = pq.ParquetWriter(f"{root}/{self.job}/{files[place]}", part.schema, filesystem=store), key
                held.append(part)
                rows += len(part)
                if rows >= ROW_GROUP:
                    drain()
        close()
        return Written([(temporary, place) for place, temporary in files.items()])

    def commit(self, messages: list[Written | None]) -> None:
        store, root = open_store(self.root)

        def move(pair: tuple[str, str]) -> None:
            temporary, place = pair
            store.create_dir(f"{root}/{place}".rsplit("/", 1)[0], recursive=True)
            store.move(f"{root}/{self.job}/{temporary}", f"{root}/{place}")

        with ThreadPoolExecutor(16) as pool:
            for _ in pool.map(move, [pair for m in messages if m for pair in m.files]):
                pass
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        from pyarrow.fs import FileType

        store, root = open_store(self.root)
        if store.get_file_info(f"{root}/{self.job}").type == FileType.Directory:
            store.delete_dir(f"{root}/{self.job}")


def _runs(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Neighbouring rows of equal keys, without the key columns."""
    values = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
    rest = batch.select([n for n in batch.schema.names if n not in keys])
    start = 0
    for i in range(1, len(values) + 1):
        if i == len(values) or values[i] != values[start]:
            yield values[start], rest.slice(start, i - start)
            start = i


def write_positional(df: DataFrame, root: str, keys: list[str], sort_cols: list[str] | None = None) -> None:
    """Write one file for each value of ``keys``, below ``root``; other columns go into the file.

    All rows of a key meet in one task, which writes them as they come, a row group at a time. A
    key's file is replaced whole; files of other keys stay. Keys are written as text; NULL is a value of its own. Without
    rows nothing is written.
    """
    spark = df.sparkSession
    spark.dataSource.register(PositionalSink)
    names = df.columns
    texts = df.select(*[df[c].cast("string").alias(c) if c in keys else df[c] for c in names])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = texts.repartition(parts, *keys).sortWithinPartitions(*keys, *(sort_cols or []))
    placed.write.format("positional").mode("append").option("path", root).option("keys", ",".join(keys)).save()
