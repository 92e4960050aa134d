"""A Spark sink that cuts its own JSON-lines files: each task writes what it is given, by lines and bytes, without a shuffle.

``df.write.format("tidemark_shards").mode("overwrite").save(folder)`` takes a string column ``line``; all other columns are the state of the rows and
are written beside the files as Parquet, in the same pass. A task tells the driver how many lines and bytes each of its files has, and the driver
writes these as one manifest table once all tasks are done: a file that is not in the manifest does not count.

File names follow from the number of the task, and a file appears whole or not at all, so a task that is made again
replaces its files and leaves no second one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from tidemark.constants import BYTES_PER_FILE, DOCS_PER_SHARD
from tidemark.sinks.storage import storage

FORMAT = "tidemark_shards"
LINE = "line"
TOO_LONG = "longer than a file may be"
MANIFEST = "uri string, docs long, bytes long"


@dataclass
class Written(WriterCommitMessage):
    """The files of one task: the n-th has ``docs[n]`` lines and ``sizes[n]`` bytes."""

    task: int
    docs: list[int]
    sizes: list[int]


def file_name(task: int, n: int) -> str:
    return f"part-{task:06d}-{n:06d}.json"


class _Files:
    """The files of one task, one open at a time."""

    def __init__(self, fs: pafs.FileSystem, folder: str, task: int, most_docs: int, most_bytes: int):
        self.fs, self.folder, self.task, self.most_docs, self.most_bytes = fs, folder, task, most_docs, most_bytes
        self.docs: list[int] = []
        self.sizes: list[int] = []
        self.out, self.hidden = None, ""

    def add(self, line: bytes) -> None:
        if len(line) + 1 > self.most_bytes:
            raise ValueError(f"a line of {len(line)} bytes is {TOO_LONG}: {line[:120].decode(errors='replace')}")
        if self.out is None or self.docs[-1] >= self.most_docs or self.sizes[-1] + len(line) + 1 > self.most_bytes:
            self.close()
            self.hidden = f"{self.folder}/.{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(self.hidden)
            self.docs.append(0)
            self.sizes.append(0)
        self.out.write(line + b"\n")
        self.docs[-1] += 1
        self.sizes[-1] += len(line) + 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.hidden, f"{self.folder}/{file_name(self.task, len(self.docs) - 1)}")
            self.out = None

    def drop(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.delete_file(self.hidden)
            self.out = None


class ShardWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, state: StructType, most_docs: int, most_bytes: int):
        self.folder, self.state, self.most_docs, self.most_bytes = folder, state, most_docs, most_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.write_task(TaskContext.get().partitionId(), iterator)

    def write_task(self, task: int, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, root = storage(self.folder)
        files = _Files(fs, f"{root}/files", task, self.most_docs, self.most_bytes)
        kept, schema = None, to_arrow_schema(self.state)
        hidden = f"{root}/state/.{uuid.uuid4().hex}"
        try:
            for batch in batches:
                for line in batch.column(LINE):
                    files.add(bytes(line.as_buffer()))
                if kept is None and self.state.fields:
                    kept = pq.ParquetWriter(hidden, schema, filesystem=fs)
                if kept is not None:
                    kept.write_batch(pa.RecordBatch.from_arrays([batch.column(f.name).cast(f.type) for f in schema], schema=schema))
            files.close()
        except BaseException:
            files.drop()
            if kept is not None:
                kept.close()
                fs.delete_file(hidden)
            raise
        if kept is not None:
            kept.close()
            fs.move(hidden, f"{root}/state/part-{task:06d}.parquet")
        return Written(task, files.docs, files.sizes)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = storage(self.folder)
        rows = [(f"{self.folder}/files/{file_name(m.task, n)}", *told) for m in messages if m for n, told in enumerate(zip(m.docs, m.sizes))]
        columns = [list(c) for c in zip(*rows)] or [[], [], []]
        table = pa.table({"uri": pa.array(columns[0], pa.string()), "docs": pa.array(columns[1], pa.int64()), "bytes": pa.array(columns[2], pa.int64())})
        hidden = f"{root}/manifest/.{uuid.uuid4().hex}"
        pq.write_table(table, hidden, filesystem=fs)
        fs.move(hidden, f"{root}/manifest/part-000000.parquet")

    def abort(self, messages: list[Written | None]) -> None:
        """Take back the files of the tasks that were done; without a manifest they would not count anyway."""
        fs, root = storage(self.folder)
        for m in messages:
            for n in range(len(m.docs) if m else 0):
                fs.delete_file(f"{root}/files/{file_name(m.task, n)}")


class ShardSink(DataSource):
    """Options: ``path``, ``docs_per_file``, ``bytes_per_file``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> ShardWriter:
        folder = self.options["path"].rstrip("/")
        fs, root = storage(folder)
        for part in ("files", "state", "manifest"):
            fs.create_dir(f"{root}/{part}", recursive=True)
            if overwrite:
                fs.delete_dir_contents(f"{root}/{part}")
        state = StructType([StructField(f.name, f.dataType) for f in schema.fields if f.name != LINE])
        return ShardWriter(folder, state, int(self.options.get("docs_per_file", DOCS_PER_SHARD)), int(self.options.get("bytes_per_file", BYTES_PER_FILE)))


def write_shards(rows: DataFrame, folder: str, docs_per_file: int = DOCS_PER_SHARD, bytes_per_file: int = BYTES_PER_FILE) -> DataFrame:
    """Write ``line`` into files and all other columns beside them (an action); the manifest: ``uri, docs, bytes``. No rows, no files.

    A line that is longer than a file may be is an error, and nothing is listed then.
    """
    spark = rows.sparkSession
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    spark.dataSource.register(ShardSink)
    try:
        rows.write.format(FORMAT).mode("overwrite").options(docs_per_file=docs_per_file, bytes_per_file=bytes_per_file).save(folder)
    except Exception as error:
        if TOO_LONG in str(error):
            raise ValueError(f"some documents are {TOO_LONG}") from error
        raise
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_state(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The columns written beside the lines."""
    return spark.read.schema(schema).parquet(f"{folder}/state")
