import __spark_entry__ as contract
import corpus_pipeline
from clicklens.llm import queries, sql
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    names = list(contract.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(sql.ORACLE_SQL) <= set(queries.QUERIES)


def test_native_operator_runs_no_python(spark):
    plan = queries.op7_fingerprints(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InPandas" not in plan


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, before, SF)
        assert docs.columns == columns
        docs = corpus_pipeline.written(docs, "test")
        if name != "mixing":
            assert docs.join(before, columns, "left_anti").isEmpty()
            assert docs.count() == docs.select("doc_id").distinct().count()
        if name == "near dedup":
            assert docs.select(F.md5("text")).distinct().count() == docs.count()
        before = docs
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count() and last.where("NOT round_trip").isEmpty()
