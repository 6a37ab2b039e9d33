"""The named queries against their SQL, and the pipeline against its stages in plain Python."""

import pytest

import corpus_pipeline
import samples
from compare import connect, differences
from conftest import SMALL
from tallyflow.llm import decontaminate, mixing, near_dedup, quality_rules
from tallyflow.llm.oracle import ORACLE
from tallyflow.llm.queries import QUERIES, table


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, name):
    assert differences(spark, connect(SMALL), name, QUERIES[name], ORACLE[name], SMALL) == []


@pytest.mark.parametrize("name", ["op1_quality_rules", "op10_reply_trees", "op6_systematic_mix"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_of_the_pipeline(spark, tmp_path):
    docs = table(spark, SMALL, "documents")
    names = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(k)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(k)))
        assert docs.columns == names
        rows = [tuple(r) for r in before.select("doc_id", "text").collect()]
        ids = sorted(r.doc_id for r in docs.select("doc_id").collect())
        if k == 0:
            book = quality_rules.ledger(before)
            want = sorted(r.doc_id for r in book.where("fail_bits = 0").collect())
        elif k == 1:
            want = sorted(i for i, c in samples.near_classes(rows).items() if i == c)
        elif k == 2:
            items = [tuple(r) for r in table(spark, SMALL, "benchmark").collect()]
            want = sorted(r[0] for r, (n, hit, _) in zip(rows, samples.contamination(rows, items))
                          if not (hit and 20 * hit >= n))
        else:
            want = sorted(r.doc_id for r in mixing.copies(before).collect() for _ in range(r.n_copies))
        assert ids == want and ids
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert sorted(r.doc_id for r in last.collect()) == ids


def test_odd_rows_pass_through_the_pipeline(spark, tmp_path):
    folder = str(tmp_path)
    long = [(50 + k, samples.prose(90, 60 + k), "en", "a") for k in range(8)]
    samples.documents(spark, samples.odd_documents() + long, clash=True).write.parquet(f"{folder}/documents.parquet")
    table(spark, SMALL, "benchmark").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() > 0
    samples.documents(spark, []).write.parquet(f"{folder}/none/documents.parquet")
    table(spark, SMALL, "benchmark").write.parquet(f"{folder}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0


def test_stage_functions_keep_clashing_columns(spark):
    odd = samples.documents(spark, clash=True)
    for out in (quality_rules.keep(odd), near_dedup.keep_one(odd), mixing.mix(odd),
                decontaminate.clean(odd, table(spark, SMALL, "benchmark"))):
        assert out.columns == odd.columns and out.count() > 0
