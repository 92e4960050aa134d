"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: A word, and what separates words.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: Texts handled at once inside a task: at most so many characters, or one text that has more.
BLOCK_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone; a NULL text counts as empty."""
    return docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def blocks(batch: pa.RecordBatch, limit: int = BLOCK_CHARS) -> Iterator[tuple[list, list[str]]]:
    """(first column, text column) of a batch in runs of bounded size."""
    keys, values = batch.column(0).to_pylist(), batch.column(1)
    begin, size = 0, 0
    lengths = [len(v) if v is not None else 0 for v in map(pa.StringScalar.as_buffer, values)]
    for i, n in enumerate(lengths):
        if i > begin and size + n > limit:
            yield keys[begin:i], values.slice(begin, i - begin).to_pylist()
            begin, size = i, 0
        size += n
    if begin < len(keys):
        yield keys[begin:], values.slice(begin).to_pylist()


def map_texts(docs: DataFrame, run: Callable[[list, list[str]], dict[str, list]], schema: str, limit: int = BLOCK_CHARS) -> DataFrame:
    """Apply ``run(ids, texts) -> columns`` to all texts, block by block, without a shuffle."""
    target = to_arrow_schema(StructType.fromDDL(schema))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, values in blocks(batch, limit):
                columns = run(ids, values)
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in target], schema=target)

    return texts(docs).mapInArrow(task, schema)


def span_list(kinds_first: list[str], spans: list[tuple[str, int, int]]) -> str:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    place = {k: i for i, k in enumerate(kinds_first)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], place[s[0]], s[2])))


def filter_texts(docs: DataFrame, keep: Callable[[list[str]], list[bool]]) -> DataFrame:
    """The rows whose text ``keep`` says to keep, with all columns as they are, block by block, without a shuffle."""
    place = docs.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            numbered = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows)), column.fill_null("")], names=["row", "text"])
            for rows, values in blocks(numbered):
                if rows:
                    yield batch.slice(rows[0], len(rows)).filter(pa.array(keep(values), pa.bool_()))

    return docs.mapInArrow(task, docs.schema)
