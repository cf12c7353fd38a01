"""The registered queries against SQL, held-out accuracy, and the pipeline stage by stage."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from vidlake.checks.parity import compare, duckdb_connection
from vidlake.llm.queries import ORACLE, QUERIES


def test_all_operators_are_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
    assert set(ORACLE) <= set(entry.oracle_sql()) and set(QUERIES) <= set(names)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_small, name):
    res = compare(QUERIES[name](spark, sf_small), duckdb_connection(sf_small), ORACLE[name])
    assert res["ok"], res


def test_held_out_language_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    r = QUERIES["op6_language_id"](spark, sf).join(docs, "doc_id").filter("held_out and lang is not null").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert r[0] > 0.98 and r[1] > 200


def test_held_out_quality_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    r = QUERIES["op3_quality_model"](spark, sf).join(labels, "doc_id").filter("held_out").agg(
        F.avg((F.col("quality") == F.col("predicted")).cast("int")), F.count("*")).first()
    assert r[0] > 0.95 and r[1] > 50


def test_pipeline_stages(spark, sf_small, tmp_path):
    """Each stage on its predecessor's written rows, against what its operator's own tests verify."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select(
        "*", F.lit("x").alias("score"), F.lit(1).alias("_lang_prednot"))
    extra = spark.createDataFrame([(10**6, "123 ###", "en", "src0", 7), (10**6 + 1, None, None, None, None),
                                   (None, "only words without an id", "en", "src1", 1)],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.unionByName(extra, allowMissingColumns=True).unionByName(docs.filter("doc_id = 7"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_small)
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs
    ids = lambda n: sorted((r.doc_id for r in seen[n].select("doc_id").collect()), key=lambda x: (x is None, x))
    assert 10**6 not in ids("language_id") and 10**6 + 1 not in ids("language_id") and len(ids("language_id")) == 202
    assert ids("line_dedup") == ids("language_id")
    assert seen["line_dedup"].filter(F.char_length("text") != F.col("n_chars")).count() == 0
    kept = ids("near_dedup")
    assert len(set(kept)) == len(kept) and None in kept and 7 in kept and len(kept) < 202
    assert ids("source_mixing") == kept
    packed = seen["best_fit_packing"]
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(kept)
    filled = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.countDistinct("sequence_order").alias("o")).collect()
    assert max(r.n for r in filled) <= 1024 and {r.o for r in filled} == {1}


def test_pipeline_runs_whole(spark, sf_small):
    assert entry.queries()["pipeline"](spark, sf_small).count() > 200


def test_workers_need_no_copy_of_the_package(sf_small, tmp_path):
    """All queries of the operators, in a session whose Python workers cannot import it."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(entry.__file__))
    script = tmp_path / "elsewhere.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from vidlake.llm.queries import QUERIES
from vidlake.session import local_session
spark = local_session(4)
def missing(batches):
    import importlib.util
    import pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_pydict({{"there": [importlib.util.find_spec("vidlake") is not None]}})
assert not spark.range(1).mapInArrow(missing, "there boolean").first().there
for name in sorted(QUERIES):
    print(name, QUERIES[name](spark, {sf_small!r}).count())
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert len(done.stdout.split("\n")) - 1 >= len(QUERIES)
