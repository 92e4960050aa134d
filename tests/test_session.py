"""Written steps: which of them stay."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.session import CLEANUP, cut_lineage, discard, settle, shared_folder


@pytest.fixture
def steps(spark):
    """Names of the step folders that are there now and were not before the test."""
    folder = Path(shared_folder(spark).removeprefix("file:")) / "tidemark"
    names = lambda: {p.name for p in folder.glob("step-*")}
    before = names()
    return lambda: names() - before


def test_settle_keeps_the_result_alone(spark, steps):
    def doubled(n):
        first = cut_lineage(spark.range(n))
        return cut_lineage(first.withColumn("twice", 2 * F.col("id"))).filter("twice > 2")

    done = settle(doubled, 4)
    assert sorted(map(tuple, done.collect())) == [(2, 4), (3, 6)] and len(steps()) == 1
    discard(done)
    assert not steps()


def test_settle_within_settle(spark, steps):
    seen = []

    def outer():
        inner = settle(lambda: cut_lineage(spark.range(3)))
        seen.append(len(steps()))
        return inner.union(inner)

    kept = cut_lineage(spark.range(1))
    assert settle(outer).count() == 6
    assert seen == [2] and len(steps()) == 2  # a step written outside stays
    assert kept.count() == 1


def test_discard_inside_settle(spark, steps):
    def loop():
        now = cut_lineage(spark.range(1))
        for _ in range(3):
            before, now = now, cut_lineage(now.select((F.col("id") + 1).alias("id")))
            discard(before)
        return now

    assert settle(loop).first().id == 3 and len(steps()) == 1


def test_failure_leaves_no_steps(spark, steps):
    def fails():
        cut_lineage(spark.range(1))
        raise ValueError

    with pytest.raises(ValueError):
        settle(fails)
    assert not steps()


def test_written_steps_leave_no_shuffle_files(spark):
    def shuffle_files():
        blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {blocks.apply(i).getName() for i in range(blocks.size()) if blocks.apply(i).getName().endswith(".data")}

    before, was = shuffle_files(), spark.conf.get(CLEANUP, None)
    step = cut_lineage(spark.range(1000).repartition(4, "id"))
    for _ in range(50):
        if shuffle_files() <= before:
            break
        time.sleep(0.1)
    assert shuffle_files() <= before and spark.conf.get(CLEANUP, None) == was
    assert step.count() == 1000
