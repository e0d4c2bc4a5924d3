import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from slotwise.operators.dedup import first_per_key
from slotwise.operators.dedup_store import KeyStore
from slotwise.sinks import published
from slotwise.sinks.files import read_in_order, write_ordered
from slotwise.streaming import compaction
from slotwise.streaming.words import process_batch

COUNTS = StructType([StructField("word", StringType()), StructField("cnt", LongType())])


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_a_failed_write_leaves_the_old_version(spark, tmp_dir):
    path = f"{tmp_dir}/p"
    assert published.current(spark, path) is None and published.folder(spark, path) is None
    published.publish(spark, path, lambda f: spark.range(5).write.parquet(f))

    def half(folder):
        spark.range(7).write.parquet(folder)
        raise RuntimeError("writer died")

    with pytest.raises(RuntimeError):
        published.publish(spark, path, half)
    assert len(published.versions(spark, path)) == 2                    # the unnamed one is still there
    assert spark.read.parquet(published.folder(spark, path)).count() == 5
    published.publish(spark, path, lambda f: spark.range(9).write.parquet(f), note="third")
    assert spark.read.parquet(published.folder(spark, path)).count() == 9
    assert published.current(spark, path)["note"] == "third" and len(published.versions(spark, path)) == 2


def test_a_reader_keeps_its_version_through_one_publication(spark, tmp_dir):
    path = f"{tmp_dir}/p"
    published.publish(spark, path, lambda f: spark.range(5).write.parquet(f))
    reader = spark.read.parquet(published.folder(spark, path))
    published.publish(spark, path, lambda f: spark.range(6).write.parquet(f))
    assert reader.count() == 5


def test_records_are_replaced_also_by_nothing(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1.0, "daily_sum")], "sa string, ds double, rec_type string")
    schema = df.drop("rec_type").schema
    read = lambda: published.read_published_records(spark, tmp_dir, schema, "daily_sum", "2024-01-19", 15)
    assert read().count() == 0
    for rows in (df, df.limit(0)):
        published.publish_records(rows, tmp_dir, "daily_sum", "2024-01-19", 15)
        assert [r.sa for r in read().collect()] == [r.sa for r in rows.collect()]


def test_files_by_name_are_in_order_and_a_hot_key_is_split(spark, tmp_dir):
    rng = random.Random(1)
    rows = [(rng.choice([None, "hot", "hot", "hot", f"k{rng.randint(0, 40)}"]), rng.randint(0, 9), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, n int, i long").repartition(6)
    write_ordered(df, tmp_dir, ["k", "n"], files=8)
    got = read_in_order(spark, tmp_dir, df.schema).orderBy("position").collect()
    assert [r.position for r in got] == list(range(1, 3001))
    assert [(r.k, r.n) for r in got] == sorted(((r[0], r[1]) for r in rows), key=lambda x: (x[0] is not None, x[0] or "", x[1]))
    files = [f for f in os.listdir(tmp_dir) if f.endswith(".json")]
    hot = [f for f in files if '"hot"' in open(f"{tmp_dir}/{f}").read()]
    assert len(files) == 8 and len(hot) >= 4


def _batches(spark, path, n=5):
    for b in range(n):
        df = spark.createDataFrame([(f"x y{b}",), (f"x x z{b % 2}",)] if b != 2 else [], "value string")
        process_batch(df, b, path)


def test_compaction_keeps_every_batch_once(spark, tmp_dir):
    _batches(spark, tmp_dir)
    path = f"{tmp_dir}/counts"
    want = _rows(compaction.read_batches(spark, path, COUNTS))
    assert compaction.compact(spark, path, COUNTS, through=1) == 2
    assert compaction.batch_ids(spark, path) == [2, 3, 4] and _rows(compaction.read_batches(spark, path, COUNTS)) == want
    assert compaction.compact(spark, path, COUNTS, through=3, files=2) == 2 and _rows(compaction.read_batches(spark, path, COUNTS)) == want
    assert compaction.compact(spark, path, COUNTS, through=3) == 0
    process_batch(spark.createDataFrame([("again",)], "value string"), 0, tmp_dir)       # a replay of a folded batch
    assert _rows(compaction.read_batches(spark, path, COUNTS)) == want


def test_a_killed_compaction_repeats_cleanly(spark, tmp_dir, monkeypatch):
    _batches(spark, tmp_dir)
    path = f"{tmp_dir}/counts"
    want = _rows(compaction.read_batches(spark, path, COUNTS))
    point = published.point
    monkeypatch.setattr(published, "point", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        compaction.compact(spark, path, COUNTS, through=4)
    assert _rows(compaction.read_batches(spark, path, COUNTS)) == want
    monkeypatch.setattr(published, "point", point)
    import slotwise.session as session
    remove, calls = session.remove_path, []

    def dies(s, p):
        calls.append(p)
        if p.endswith("batch_id=1"):
            raise RuntimeError("killed")
        remove(s, p)

    monkeypatch.setattr(session, "remove_path", dies)
    with pytest.raises(RuntimeError):
        compaction.compact(spark, path, COUNTS, through=4)               # named, folders partly left
    assert compaction.batch_ids(spark, path) and _rows(compaction.read_batches(spark, path, COUNTS)) == want
    monkeypatch.setattr(session, "remove_path", remove)
    assert compaction.compact(spark, path, COUNTS, through=4) == 0
    assert compaction.batch_ids(spark, path) == [] and _rows(compaction.read_batches(spark, path, COUNTS)) == want


def test_committed_batches_of_a_query(spark, tmp_dir):
    from slotwise.streaming.words import start_word_counts
    spark.createDataFrame([("a b",)], "value string").write.mode("overwrite").text(f"{tmp_dir}/in")
    stream = spark.readStream.schema("value string").text(f"{tmp_dir}/in")
    assert compaction.committed(spark, f"{tmp_dir}/ck") == -1
    start_word_counts(stream, f"{tmp_dir}/out", f"{tmp_dir}/ck", available_now=True).awaitTermination()
    assert compaction.committed(spark, f"{tmp_dir}/ck") == 0


def test_two_runs_equal_one(spark, tmp_dir):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(300)]), rng.choice("ab"), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, t string, i long")
    store = KeyStore(tmp_dir, ranges=4, bits=256)                       # small filters: many bits are shared
    kept = []
    for run, part in (("1", df.where("i < 700")), ("2", df.where("i >= 700 and i < 1500")), ("2", df.where("i >= 700")), ("3", df)):
        new = store.unseen(part, ["k", "t"], run, "i").collect()
        kept = [(r, x) for r, x in kept if r != run] + [(run, x) for x in new]
        store.add(spark.createDataFrame(new, df.schema), ["k", "t"], run)
    assert sorted(map(repr, (x for _, x in kept))) == _rows(first_per_key(df, ["k", "t"], "i"))
    assert [r for r, _ in kept].count("3") == 0


def test_most_new_keys_skip_the_join(spark, tmp_dir):
    store = KeyStore(tmp_dir, ranges=4, bits=1 << 15)
    store.add(spark.range(2000).selectExpr("id AS k"), "k", "1")
    fresh = spark.range(100_000, 104_000).selectExpr("id AS k")
    got = store.unseen(fresh, "k", "2")
    assert got.count() == 4000
    assert store.unseen(spark.range(1500, 2500).selectExpr("id AS k"), "k", "2").agg(F.min("k"), F.count("k")).first()[:] == (2000, 500)


def test_compaction_sorts_in_tasks_of_bounded_size(spark, tmp_dir, monkeypatch):
    from slotwise.sinks import published
    from slotwise.streaming import compaction
    monkeypatch.setattr(compaction, "FILE_BYTES", 4096, raising=False)
    rows = spark.range(600).selectExpr("concat('w', id) AS word", "id AS cnt")
    for b in range(3):
        rows.where(f"cnt % 3 = {b}").write.parquet(f"{tmp_dir}/batch_id={b}")
    assert compaction.compact(spark, tmp_dir, rows.schema, 2) == 3
    store = spark.read.parquet(published.folder(spark, f"{tmp_dir}/compacted"))
    assert len(store.inputFiles()) > 5
    got = compaction.read_batches(spark, tmp_dir, rows.schema).collect()
    assert sorted(map(tuple, got)) == sorted((f"w{i}", i, i % 3) for i in range(600))
