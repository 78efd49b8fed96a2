"""Upserted tables: last write per key and column, deletes, repeated batches, other runs."""

import pytest

from tillstream.schemas import strings
from tillstream.sources import sinks
from tillstream.sources.keyed import DELETED, KeyedTable
from tillstream.streaming import run


def rows(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


@pytest.fixture
def table(spark, folder):
    return KeyedTable(spark, folder, "id", strings("id", "v"))


def put(spark, table, batch, *data, run="one"):
    df = spark.createDataFrame(list(data), "id string, v string, ts bigint, gone boolean")
    table.upsert(df.withColumnRenamed("gone", DELETED), batch, "ts", run)


def test_latest_wins_and_deletes_remove(spark, table):
    assert rows(table) == []
    put(spark, table, 0, ("a", "1", 10, False), ("a", "0", 9, False), ("b", "1", 1, False))
    put(spark, table, 1, ("a", "2", 1, False), ("b", None, 2, True))
    assert rows(table) == [("a", "2")]
    put(spark, table, 2, ("b", "back", 3, False))
    assert rows(table) == [("a", "2"), ("b", "back")]


def test_numbers_order_as_numbers(spark, table):
    put(spark, table, 0, ("a", "nine", 9, False), ("a", "ten", 10, False))
    assert rows(table) == [("a", "ten")]


def test_a_delete_and_an_insert_of_a_batch_go_by_their_order(spark, table):
    put(spark, table, 0, ("a", "old", 1, False), ("a", None, 2, True), ("a", "new", 3, False), ("b", "x", 1, False),
        ("b", None, 1, True), (None, "key", 1, False))
    assert rows(table) == [("a", "new"), (None, "key")]


def test_repeated_batch_replaces_itself(spark, table):
    for _ in range(2):
        put(spark, table, 5, ("a", "1", 1, False))
    assert rows(table) == [("a", "1")]
    put(spark, table, 5, ("c", "1", 1, False))
    assert rows(table) == [("c", "1")]


def test_another_run_loses_nothing(spark, table):
    """Batch 0 of a new checkpoint, or of a second writer, is another batch."""
    put(spark, table, 0, ("a", "1", 1, False), ("b", "1", 1, False))
    put(spark, table, 1, ("b", None, 2, True))
    put(spark, table, 0, ("c", "1", 1, False), run="two")
    put(spark, table, 1, ("a", "again", 1, False), run="two")
    put(spark, table, 2, ("d", "1", 1, False))
    assert rows(table) == [("a", "again"), ("c", "1"), ("d", "1")]


def test_streams_name_their_runs_by_their_checkpoints(spark, folder):
    table = KeyedTable(spark, f"{folder}/table", "id", strings("id", "v"))
    for k, checkpoint in enumerate(["c1", "c2", "c1"]):
        spark.createDataFrame([(f"{k}", checkpoint)], "id string, v string").write.mode("append").parquet(f"{folder}/in{checkpoint}")
        feed = spark.readStream.schema("id string, v string").parquet(f"{folder}/in{checkpoint}")
        run.drain(feed, f"{folder}/{checkpoint}", sinks.upsert_batch(table), timeout=120)
    assert rows(table) == [("0", "c1"), ("1", "c2"), ("2", "c1")]
    log = spark.read.parquet(f"{folder}/table")
    assert sorted(r[0] for r in log.groupBy("_run").count().select("count").collect()) == [1, 2]


def test_columns_a_change_lacks_keep_their_value(spark, folder):
    table = KeyedTable(spark, folder, "id", strings("id", "v", "w"))
    table.upsert(spark.createDataFrame([("a", "1", "1"), ("b", "1", "1")], "id string, v string, w string"), 0)
    table.upsert(spark.createDataFrame([("a", "2"), ("c", "2")], "id string, v string"), 1)
    table.upsert(spark.createDataFrame([("b", None)], "id string, w string"), 2)
    assert rows(table) == [("a", "2", "1"), ("b", "1", None), ("c", "2", None)]
    table.upsert(spark.createDataFrame([("a", True)], f"id string, {DELETED} boolean"), 3)
    table.upsert(spark.createDataFrame([("a", "4")], "id string, w string"), 4)
    assert rows(table) == [("a", None, "4"), ("b", "1", None), ("c", "2", None)]


def test_key_must_be_a_column(spark, folder):
    with pytest.raises(ValueError, match="key"):
        sinks.dimension_table(spark, folder, "dim_x", "name", "code")
    assert sinks.dimension_table(spark, folder, "dim_x", "id,name").key == "id"


def test_folders_of_batches_belong_to_a_run(spark, folder):
    """Appended topics and window files of a new checkpoint are added, not replaced."""
    df = spark.createDataFrame([("x",)], "value string")
    for name, writer in (("t", sinks.append_batch(f"{folder}/t")),
                         ("w", sinks.window_batch(["value"], "parquet", path=f"{folder}/w"))):
        for checkpoint in ("c1", "c2"):
            df.write.mode("overwrite").text(f"{folder}/in")
            run.drain(spark.readStream.text(f"{folder}/in"), f"{folder}/{name}{checkpoint}", writer, timeout=120)
    assert spark.read.text(f"{folder}/t").count() == 2 and spark.read.parquet(f"{folder}/w").count() == 2


def test_records_of_an_upserted_topic(spark):
    df = spark.createDataFrame([("a", "1", False), ("b", None, True), ("c", None, None)],
                               f"id string, v string, {DELETED} boolean")
    out = [tuple(r) for r in sinks.as_keyed_text(df, "id").collect()]
    assert out == [("a", '{"id":"a","v":"1"}'), ("b", None), ("c", '{"id":"c"}')]


def test_a_topic_stream_appends_texts_to_files(spark, folder):
    spark.createDataFrame([(1, "x")], "id int, v string").write.parquet(f"{folder}/in")
    feed = spark.readStream.schema("id int, v string").parquet(f"{folder}/in")
    query = sinks.topic_stream(feed, f"{folder}/c", "text", path=f"{folder}/out").trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    assert [r[0] for r in spark.read.text(f"{folder}/out").collect()] == ['{"id":1,"v":"x"}']
