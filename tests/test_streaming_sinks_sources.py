"""Per-batch stream counts (T1-T5), sinks (K1-K5) and sources."""

import os

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from slotwise.plans.stream_job import run_files
from slotwise.sinks.files import as_view, read_records, write_records
from slotwise.sources.streams import kafka_options
from slotwise.sources.tables import columns_of, list_tables, read_lines, scan_sql


def _write(path, name, text):
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_per_batch_counts_not_running(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    _write(src, "f1.txt", "a b a\n")
    _write(src, "f2.txt", "b  c\n")
    _write(src, "f3.txt", "")
    for i, n in enumerate(("f1.txt", "f2.txt", "f3.txt")):
        os.utime(os.path.join(src, n), (1_000_000 + i, 1_000_000 + i))
    out = os.path.join(tmp_dir, "out")
    _, counts, totals = run_files(spark, src, max_files_per_trigger=1, out=out)
    by_batch = {}
    for r in counts.collect():
        by_batch.setdefault(r.batch_id, {})[r.word] = r.cnt
    assert sorted(by_batch.values(), key=len) == [{"a": 2, "b": 1}, {"b": 1, "": 1, "c": 1}]
    tot = sorted((r.batch_id, r.total) for r in totals.collect())
    assert [t for _, t in tot] == [3, 3, None]
    # restart from the same checkpoint: nothing new, nothing recounted
    _, counts2, totals2 = run_files(spark, src, max_files_per_trigger=1, out=out)
    assert counts2.count() == counts.count() and totals2.count() == 3
    # a new file is one more batch
    _write(src, "f4.txt", "d\n")
    _, counts3, totals3 = run_files(spark, src, max_files_per_trigger=1, out=out)
    assert totals3.count() == 4 and counts3.where("word = 'd'").count() == 1


def test_stream_queries_over_a_file_or_a_folder_of_files(spark, tmp_dir):
    import shutil
    from slotwise.plans.catalog import QUERIES
    rows = spark.createDataFrame([(1, "a b a"), (2, "b"), (3, None), (4, "c a")], "doc_id long, text string")
    rows.repartition(3, "doc_id").write.parquet(f"{tmp_dir}/many/documents.parquet")
    rows.coalesce(1).write.parquet(f"{tmp_dir}/one/pages.parquet")                  # a neighbour that is not read
    part = next(n for n in os.listdir(f"{tmp_dir}/one/pages.parquet") if n.endswith(".parquet"))
    shutil.copy(f"{tmp_dir}/one/pages.parquet/{part}", f"{tmp_dir}/one/documents.parquet")
    for base in ("many", "one"):
        words = QUERIES["stream_batch_words"](spark, f"{tmp_dir}/{base}").collect()
        assert sorted(map(tuple, words)) == [("a", 3, 0), ("b", 2, 0), ("c", 1, 0)]
        assert [tuple(r) for r in QUERIES["stream_batch_total"](spark, f"{tmp_dir}/{base}").collect()] == [(6, 0)]


def test_kafka_option_mapping():
    o = kafka_options("b1:9092,b2:9092", "meter", max_offsets_per_trigger=1000)
    assert o == {"kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "meter",
                 "startingOffsets": "latest", "maxOffsetsPerTrigger": "1000"}


def test_records_dynamic_overwrite(spark, tmp_dir):
    df = spark.createDataFrame([("1", "2", "20170301", "kd", 1.5, "15")], "sa string, sp string, rd string, uom string, ds double, im string")
    path = os.path.join(tmp_dir, "rec")
    write_records(df, path, "daily_sum", dt="2017-03-01", im=15)
    write_records(df.withColumn("ds", F.lit(2.5)), path, "daily_sum", dt="2017-03-02", im=15)
    write_records(df.withColumn("ds", F.lit(3.5)), path, "daily_sum", dt="2017-03-02", im=15, max_files=1)
    assert sorted(os.listdir(os.path.join(path, "rec_type=daily_sum"))) == ["dt=2017-03-01", "dt=2017-03-02"]
    schema = StructType([StructField(n, StringType()) for n in ("sa", "sp", "rd", "uom")]
                        + [StructField("ds", DoubleType())]
                        + [StructField(n, StringType()) for n in ("rec_type", "dt", "im")])
    back = {r.dt: r.ds for r in read_records(spark, path, schema, "daily_sum").collect()}
    assert back == {"2017-03-01": 1.5, "2017-03-02": 3.5}
    # reading date as partition (default when dt is not given)
    p2 = os.path.join(tmp_dir, "rec2")
    write_records(df, p2, "daily_sum", im=15)
    assert os.listdir(os.path.join(p2, "rec_type=daily_sum")) == ["dt=2017-03-01"]


def test_sql_scan_listing_lines(spark, tmp_dir):
    df = spark.createDataFrame([(1, "2017-03-01"), (2, "2017-03-05")], "id int, d string")
    as_view(df, "scan_t")
    got = scan_sql(spark, "scan_t", "id", "d BETWEEN :lo AND :hi", {"lo": "2017-03-01", "hi": "2017-03-02"})
    assert [r.id for r in got.collect()] == [1]
    assert "scan_t" in [r.tableName for r in list_tables(spark).collect()]
    assert columns_of(df) == ["id", "d"]
    _write(tmp_dir, "lines.txt", "3 1\n2\n")
    assert [r.value for r in read_lines(spark, os.path.join(tmp_dir, "lines.txt")).collect()] == ["3 1", "2"]


def test_console_and_batch_printout(spark, tmp_dir, capsys):
    from slotwise.sinks.files import console
    from slotwise.streaming.words import process_batch
    df = spark.createDataFrame([("a b a",)], "value string")
    console(df, 5, False)
    process_batch(df, 7, os.path.join(tmp_dir, "out"), show=True)
    printed = capsys.readouterr().out
    assert "a b a" in printed and "========= batch 7 =========" in printed and "total" in printed
    back = spark.read.parquet(os.path.join(tmp_dir, "out", "totals"))
    assert [(r.batch_id, r.total) for r in back.collect()] == [(7, 3)]
