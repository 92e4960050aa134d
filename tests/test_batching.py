import pytest
from pyspark.sql import functions as F

from tidemark.sinks import batching as B
from tidemark.sinks import shards as S


@pytest.mark.parametrize("n, size", [(0, 10), (1, 10), (100, 10), (1037, 100)])
def test_batches_are_full_but_for_the_last(spark, n, size):
    got = [r["batch"] for r in B.numbered_batches(spark.range(n), "id", size).collect()]
    full, rest = divmod(n, size)
    counts = [got.count(b) for b in sorted(set(got))]
    assert counts == [size] * full + ([rest] if rest else [])


def test_index_is_dense(spark):
    got = sorted(r["idx"] for r in B.dense_index(spark.range(5000), "id").collect())
    assert got == list(range(5000))


def test_size_bound_holds(spark):
    rows = spark.range(3000).withColumn("n", (F.col("id") * 7919 % 500) + F.when(F.col("id") % 100 == 0, 600).otherwise(1))
    placed = B.size_bounded_batches(rows, "id", F.col("n"), max_rows=20, max_bytes=1000).collect()
    assert len(placed) == 3000
    batches = {}
    for r in placed:
        batches.setdefault(("solo", r["id"]) if r["solo"] else ("batch", r["batch"]), []).append(r["bytes"])
    assert all(len(b) <= 20 for b in batches.values())
    assert all(sum(b) <= 1000 or len(b) == 1 for b in batches.values())


def test_purge_filter(spark):
    got = B.purge_requests(spark.createDataFrame([("b",), ("a",)], "id string"), "id", 10).collect()
    assert [tuple(r) for r in got] == [(0, 2, 'id: ANY("a","b")')]


def test_shards_and_manifest(spark, tmp_path):
    folder = str(tmp_path / "shards")
    documents = spark.range(0, 250, numPartitions=2).select(
        F.concat(F.lit('quo"te '), "id").alias("id"),
        F.lit("line\nbreak é" * 40).alias("body"),
        F.lit("text/plain").alias("mime_type"),
        F.lit('{"title":"t"}').alias("metadata"),
        F.from_json(
            F.lit('[{"kind":"group","id":"g"},{"kind":"user","id":"u"},{"kind":"idp_wide"}]'),
            "array<struct<kind:string,id:string>>",
        ).alias("principals"),
    )
    S.write_jsonl(documents, folder, 50)
    shards = spark.read.text(folder).groupBy(F.input_file_name().alias("uri")).agg(F.count("*").alias("docs"))
    assert sorted(r["docs"] for r in shards.collect()) == [25, 25, 50, 50, 50, 50]
    back = S.read_jsonl(spark, folder).withColumn("body", F.decode("body", "UTF-8"))
    assert sorted(map(str, back.collect())) == sorted(map(str, documents.select(back.columns).collect()))
    requests = S.import_manifest(shards, "r", "FULL", per_request=4).orderBy("part").collect()
    assert [(r["part"], r["parts"], r["files"]) for r in requests] == [(0, 2, 4), (1, 2, 2)]
    assert sum(r["docs"] for r in requests) == 250
    assert S.import_manifest(shards.where("false"), "r", "FULL").count() == 0


def batches_of(lines, size=7):
    import pyarrow as pa

    for i in range(0, len(lines), size):
        part = lines[i : i + size]
        yield pa.RecordBatch.from_pydict({"line": part, "id": [line[:6] for line in part]})


def test_a_task_made_again_leaves_no_second_file(tmp_path):
    from pyspark.sql.types import StringType, StructField, StructType

    from tidemark.sinks.shard_writer import ShardSink, ShardWriter

    schema = StructType([StructField("line", StringType()), StructField("id", StringType())])
    folder = tmp_path / "out"
    writer = ShardSink({"path": f"file://{folder}", "docs_per_file": "10", "bytes_per_file": "400"}).writer(schema, True)
    assert isinstance(writer, ShardWriter)
    lines = [f"{i:06d}" + "x" * (i * 13 % 90) for i in range(60)]

    def dying():
        yield from list(batches_of(lines))[:5]
        raise OSError("lost")

    with pytest.raises(OSError):
        writer.write_task(3, dying())
    told = [writer.write_task(3, batches_of(lines)), writer.write_task(1, batches_of(lines[:4])), writer.write_task(3, batches_of(lines)), writer.write_task(2, iter(()))]
    writer.commit(told[1:])
    files = {f.name: f.read_text().splitlines() for f in (folder / "files").iterdir()}
    assert sum(f.startswith("part-000003") for f in files) == len(told[0].docs) == len(told[2].docs) and len(files) == len(told[0].docs) + 1
    assert sorted(x for f in files.values() for x in f) == sorted(lines + lines[:4])
    assert all(len(f) <= 10 and sum(len(x) + 1 for x in f) <= 400 for f in files.values())
    assert sorted(p.name for p in (folder / "state").iterdir()) == ["part-000001.parquet", "part-000003.parquet"]
    writer.abort(told[1:])
    assert not list((folder / "files").iterdir())


def test_shards_name_every_line_once(spark, tmp_path):
    from tidemark.sinks.shard_writer import read_state, write_shards

    rows = spark.range(500).select(F.concat(F.lit("line é "), "id").alias("line"), "id", F.timestamp_seconds("id").cast("timestamp_ntz").alias("at"))
    shards = write_shards(rows.repartition(3), str(tmp_path / "s"), docs_per_file=40)
    told = shards.collect()
    assert sum(r.docs for r in told) == 500 and max(r.docs for r in told) == 40
    lines = spark.read.text([r.uri for r in told])
    assert sorted(r.value for r in lines.collect()) == sorted(f"line é {i}" for i in range(500))
    assert sum(r.bytes for r in told) == sum(len(f"line é {i}".encode()) + 1 for i in range(500))
    state = read_state(spark, str(tmp_path / "s"), rows.drop("line").schema)
    assert sorted(map(tuple, state.collect())) == sorted(map(tuple, rows.drop("line").collect()))
    again = write_shards(rows.limit(5), str(tmp_path / "s"))
    assert [r.docs for r in again.collect()] == [5]
    none = write_shards(rows.where("false"), str(tmp_path / "none"))
    assert none.count() == 0 and read_state(spark, str(tmp_path / "none"), rows.drop("line").schema).count() == 0
    with pytest.raises(ValueError, match="longer than a file"):
        write_shards(rows, str(tmp_path / "t"), bytes_per_file=8)
