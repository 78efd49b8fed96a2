"""The registered queries and the pipeline on the whole small tables."""

import os

import pytest

import __spark_entry__ as driver
import compare
import corpus_pipeline
from pyspark.sql import functions as F
from tillstream.llm import quality, queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WITH_SQL = list(queries.oracle_sql())


@pytest.mark.parametrize("name", WITH_SQL)
def test_against_sql(spark, name):
    df = driver.queries()[name](spark, SF)
    assert compare.difference(df, compare.connect(SF), queries.oracle_sql()[name]) is None


def test_all_operators_and_the_pipeline_are_registered():
    names = queries.queries()
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        from tillstream.llm.common import stored
        docs = stored(stage(spark, docs, SF), "stage")
        assert docs.columns == columns, name
        counts.append(docs.count())
        assert 0 < counts[-1] <= counts[-2], name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.collect()}


# Labelled bad documents that pass the base rule, and how many of them the posterior may keep.
@pytest.mark.parametrize("size, missed", [("0.001", 0), ("0.01", 0), ("0.1", 6)])
def test_quality_verdicts_hold_at_every_size(spark, size, missed):
    folder = f"/root/testdata/sf{size}"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    judged = quality.judge(docs).join(labels.select("doc_id", F.col("quality").alias("label")), "doc_id")
    rows = judged.where("not base_failed").groupBy("label", "kept").count().collect()
    found = {(r["label"], r["kept"]): r["count"] for r in rows}
    assert found.get((1, False), 0) == 0 and found.get((0, True), 0) <= missed < found[0, False]
    fitted = quality.fit(quality.measures(docs, []).select(quality.votes().alias("votes")))[1]
    assert all(w < 0 for w in fitted[0::3]) and all(w > 0 for w in fitted[2::3])


PLAIN = ["op1_pfair_mixing", "op3_quality_rules", "op6_license_scan"]


@pytest.mark.parametrize("name", [n for n in queries.queries() if n != "pipeline"])
def test_plans_have_no_cross_join_and_native_ones_no_python(spark, name):
    text = driver.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name in PLAIN:
        assert "Python" not in text and "ArrowEval" not in text and "InPandas" not in text
