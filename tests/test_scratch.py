"""Scratch tables: what settle keeps and what it deletes."""

import time

from permaway.operators import scratch


def test_settle_keeps_the_result_alone(spark):
    steps = []

    def make():
        first = scratch.cut(spark.range(10))
        steps.append(scratch._written[-1])
        inner = scratch.settle(lambda: scratch.cut(first.where("id > 2")).where("id > 3"))
        steps.append(scratch._written[-1])
        return inner.where("id < 8")

    before = len(scratch._written)
    out = scratch.settle(make)
    assert sorted(r.id for r in out.collect()) == [4, 5, 6, 7]
    assert len(scratch._written) == before + 1 and not set(steps) & set(scratch._written)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in steps:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        assert not p.getFileSystem(conf).exists(p)


def test_settle_has_the_shuffle_files_of_its_query_deleted(spark):
    """They stayed until the driver happened to collect its garbage."""
    files = lambda: {f.getName() for f in _shuffled(spark)}
    before = files()
    made = []

    def make():
        df = scratch.cut(spark.range(200_000).selectExpr("id % 50021 AS k", "id").groupBy("k").sum("id"))
        made.append(files() - before)
        return df

    assert scratch.settle(make).count() == 50021 and made[0]
    until = time.time() + 20
    while made[0] & files() and time.time() < until:
        time.sleep(0.2)
    assert not made[0] & files()


def test_settle_has_the_shuffle_files_of_its_result_deleted(spark):
    """The listeners' threads held the query that wrote the result until the next one ended."""
    files = lambda: {f.getName() for f in _shuffled(spark)}
    before = files()
    out = scratch.settle(lambda: spark.range(200_000).selectExpr("id % 50021 AS k", "id").groupBy("k").sum("id"))
    until = time.time() + 10
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and out.count() == 50021


def test_settle_without_loose_shuffles_collects_no_garbage(spark, monkeypatch):
    """Every settle had the driver collect all its garbage, which let its heap grow in the pipeline."""
    calls = []
    monkeypatch.setattr(scratch, "release", calls.append)
    df = spark.range(200_000).selectExpr("id % 50021 AS k", "id").groupBy("k").sum("id")
    before = {f.getName() for f in _shuffled(spark)}

    def make():
        out = scratch.cut_clean(df)
        assert not {f.getName() for f in _shuffled(spark)} - before
        return out.where("k > 0")

    assert scratch.settle(make).count() == 50020 and not calls
    assert spark.conf.get(scratch.CLEANUP) == "false"
    scratch.settle(lambda: scratch.cut(df).where("k > 0"))
    assert len(calls) == 1


def test_settle_has_freed_native_memory_given_back(spark, monkeypatch):
    """Freed memory stayed in malloc's arenas, 170 MB of the driver's in the pipeline."""
    assert scratch.trim(spark)
    calls = []
    monkeypatch.setattr(scratch, "trim", calls.append)
    assert scratch.settle(lambda: spark.range(5)).count() == 5 and calls == [spark]


def test_discard_deletes_one_table(spark):
    stays, goes = scratch.cut(spark.range(5)), scratch.cut(spark.range(7))
    path = scratch._written[-1]
    scratch.discard(goes)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert path not in scratch._written and not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    assert stays.count() == 5


def _shuffled(spark):
    """The shuffle files that lie in the folders of this process."""
    found = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles())
    return [f for f in found if f.getName().startswith("shuffle_")]
