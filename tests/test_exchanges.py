"""Whole rows are exchanged only where they must be (findings F1 to F27 of round 3)."""

import re

from pyspark.sql import functions as F

from vidlake.functions.clean import deduplicate, typed_columns
from vidlake.sources.adapter import load_bronze


def formatted(df):
    df.write.format("noop").mode("overwrite").save()
    return df.sparkSession.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def exchanged_columns(p):
    return re.findall(r"Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning", p)


def uploads(spark, scratch, n, shared):
    """``n`` keys, the first ``shared`` landed twice (the second copy with more views); some keys are null in part."""
    path = scratch("uploads")
    i = F.col("id")
    (spark.range(n).select("*", F.explode(F.sequence(F.lit(1), F.when(i < shared, 2).otherwise(1))).alias("copy"))
     .select(F.when(i % 10 != 3, F.concat(F.lit("v"), i)).alias("video_id"),
             F.when(i % 10 != 4, F.concat(F.lit("t"), i)).alias("publish_time"),
             (i + F.col("copy")).alias("views"), F.repeat(F.lit("text "), 50).alias("description"))
     .write.parquet(path))
    return spark.read.parquet(path)


def test_rows_that_landed_once_are_not_exchanged(spark, scratch):
    once = uploads(spark, scratch, 200, 0).filter("video_id is not null and publish_time is not null")
    assert not exchanged_columns(formatted(deduplicate(once)))
    several = uploads(spark, scratch, 200, 20)
    p = formatted(deduplicate(several))
    assert "LeftAnti" in p and "LeftSemi" in p and "SortMergeJoin" not in p
    assert len([c for c in exchanged_columns(p) if "_row" in c or "max" in c]) == 1


def test_survivors_are_the_same_however_many_keys_are_shared(spark, scratch):
    df = uploads(spark, scratch, 300, 60)
    want = {}
    for r in df.collect():
        k = (r.video_id, r.publish_time)
        want[k] = max(want.get(k, -1), r.views)
    for bound in (0, 1, 1000):
        got = deduplicate(df, max_shared=bound)
        assert got.columns == df.columns
        rows = got.collect()
        assert len(rows) == len(want) and {(r.video_id, r.publish_time): r.views for r in rows} == want


def test_bronze_dedup_equals_the_exchange_of_all_rows(spark, sf_small):
    typed = typed_columns(load_bronze(spark, sf_small))
    assert sorted(map(str, deduplicate(typed).collect())) == sorted(map(str, deduplicate(typed, max_shared=0).collect()))


def test_documents_are_joined_by_an_exchange_of_both_sides(spark, sf_small):
    p = formatted(load_bronze(spark, sf_small))
    assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p


def test_landings_are_gzipped_files_of_bounded_rows_that_jobs_and_the_stream_read(spark, sf_small, scratch, monkeypatch):
    from vidlake.plans import pipelines
    from vidlake.plans.silver import bronze_to_silver
    from vidlake.sources import sinks
    from vidlake.sources.files import hadoop_path, read_bronze_csv, read_table
    from vidlake.streaming.incremental import incremental_silver
    monkeypatch.setattr(pipelines, "LANDED_ROWS", 100)
    base = scratch("gzipped")
    bronze = load_bronze(spark, sf_small)
    landed = pipelines.ingest(bronze, f"{base}/landing", run_ts="1").outputs["landed"]
    fs, at = hadoop_path(spark, landed)
    files = [s.getPath().getName() for s in fs.listStatus(at) if s.getPath().getName().startswith("part-")]
    assert all(f.endswith(".csv.gz") for f in files) and len(files) >= 10
    plain, _ = sinks.write_bronze_csv(bronze, f"{base}/plain", run_ts="1")
    assert sorted(map(str, read_bronze_csv(spark, landed).collect())) == sorted(map(str, read_bronze_csv(spark, plain).collect()))
    incremental_silver(spark, f"{base}/landing", f"{base}/silver", f"{base}/ckpt", as_of="2024-01-31")
    want = bronze_to_silver(bronze, as_of="2024-01-31").select("video_id", "publish_time", "views", "description")
    got = read_table(spark, f"{base}/silver").select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_api_pages_are_cut_where_rows_are_and_landed_compressed(spark, sf_small, scratch):
    from vidlake.sources.api import bronze_to_api_responses, flatten_api_items, land_api_responses, read_api_responses
    from vidlake.sources.files import hadoop_path
    bronze = load_bronze(spark, sf_small)
    pages = bronze_to_api_responses(bronze, page_size=7)
    assert formatted(pages).count("Arguments: hashpartitioning") == 2 and "rangepartitioning" not in formatted(pages)     # the documents' join
    path = scratch("api_landed")
    land_api_responses(pages, path, pages_per_file=3)
    fs, at = hadoop_path(spark, path)
    files = [s.getPath().getName() for s in fs.listStatus(at) if s.getPath().getName().startswith("part-")]
    assert all(f.endswith(".json.gz") for f in files) and len(files) >= 1000 // 21
    back = read_api_responses(spark, path)
    assert sorted(map(str, back.collect())) == sorted(map(str, flatten_api_items(pages).collect()))
    assert sorted(back.select("video_id", "title", "description").collect()) == sorted(
        bronze.select("video_id", "title", "description").collect())


def test_landings_by_other_headers_are_gzipped_too(spark, sf_small, monkeypatch):
    from vidlake.plans import pipelines
    from vidlake.plans.catalog import QUERIES
    from vidlake.sources import sinks
    from vidlake.sources.files import hadoop_path
    landed, write = [], sinks.write_bronze_csv
    monkeypatch.setattr(sinks, "write_bronze_csv", lambda *a, **b: landed.append(write(*a, **b)) or landed[-1])
    monkeypatch.setattr(pipelines, "LANDED_ROWS", 100)
    n = QUERIES["src_csv_by_name"](spark, sf_small).count()
    fs, at = hadoop_path(spark, landed[0][0])
    files = [s.getPath().getName() for s in fs.listStatus(at) if s.getPath().getName().startswith("part-")]
    assert n == QUERIES["silver"](spark, sf_small).count() and len(files) >= 10 and all(f.endswith(".csv.gz") for f in files)


def test_whole_rows_are_regrouped_by_folder_without_an_exchange(spark, scratch):
    from vidlake.session import SHUFFLES_FREED
    from vidlake.sources import sinks
    from vidlake.sources.files import hadoop_path, leaf_folders, read_table
    i = F.col("id")
    df = spark.range(4000, numPartitions=8).select(
        i, F.repeat(F.lit("text "), 50).alias("description"), F.when(i % 3 > 0, i % 3).cast("int").alias("a"),
        F.concat(F.lit("k/"), i % 5).alias("b"))
    one, two = scratch("staged"), scratch("rebalanced")
    sinks.write_partitioned(df, two, ["a", "b"])
    sinks.write_staged(df, one, ["a", "b"])
    sinks.write_staged(df.filter("a = 1").withColumn("description", F.lit("new")), one, ["a", "b"])     # replaces its folders only
    want = read_table(spark, two).withColumn("description", F.expr("if(a = 1, 'new', description)"))
    assert sorted(map(str, read_table(spark, one).collect())) == sorted(map(str, want.collect()))
    folders = leaf_folders(spark, one)
    fs, _ = hadoop_path(spark, one)
    assert len(folders) == 15 and all(len([s for s in fs.listStatus(hadoop_path(spark, f)[1])
                                           if s.getPath().getName().endswith(".parquet")]) == 1 for f in folders)
    assert all(spark.conf.get(k, None) is None for k in [*SHUFFLES_FREED, *sinks.TASKS_KEPT])
    sinks.write_staged(df.limit(0), scratch("nothing"), ["a", "b"])


def test_the_silver_job_regroups_without_an_exchange(spark, sf_small, scratch, monkeypatch):
    from vidlake.plans import pipelines
    from vidlake.sources import sinks
    from vidlake.sources.files import read_table
    base = scratch("job")
    landed, _ = sinks.write_bronze_csv(load_bronze(spark, sf_small), f"{base}/landing", run_ts="1")
    pipelines.bronze_to_silver_job(spark, landed, f"{base}/silver", as_of="2024-01-31")
    sinks.write_silver(read_table(spark, f"{base}/silver"), f"{base}/again")
    monkeypatch.setattr(sinks, "write_partitioned", None)
    rep = pipelines.bronze_to_silver_job(spark, landed, f"{base}/other", as_of="2024-01-31")
    rows = lambda p: sorted(map(str, read_table(spark, p).drop("processed_timestamp").collect()))
    assert rows(f"{base}/other") == rows(f"{base}/again") and rep.counts["kept_rows"] == len(rows(f"{base}/other"))


def test_the_registered_table_is_written_without_an_exchange(spark, sf_small, monkeypatch):
    from vidlake.plans.catalog import QUERIES
    from vidlake.sources import sinks
    want = sorted(map(str, QUERIES["silver"](spark, sf_small).collect()))
    monkeypatch.setattr(sinks, "write_partitioned", None)
    got = QUERIES["pip_catalog_silver"](spark, sf_small)
    assert len(want) == got.count() and sorted(map(str, got.select(QUERIES["silver"](spark, sf_small).columns).collect())) == want


def test_batches_are_merged_by_rounds_of_buckets(spark, sf_small, scratch, monkeypatch):
    from vidlake.plans.silver import bronze_to_silver
    from vidlake.session import scratch_path
    from vidlake.sources.files import hadoop_path, path_exists, read_table
    from vidlake.streaming import incremental
    rounds, merge_round = [], incremental._merge_round
    monkeypatch.setattr(incremental, "MERGE_BYTES", 1)
    monkeypatch.setattr(incremental, "_merge_round", lambda rows, *a: rounds.append(rows.select("key_bucket").distinct().count())
                        or merge_round(rows, *a))
    top = scratch_path(spark, "any").rsplit("/", 1)[0]

    def aside():
        fs, at = hadoop_path(spark, top)
        names = [s.getPath().getName() for s in fs.listStatus(at)] if path_exists(spark, top) else []
        return {n for n in names if n.startswith(("stream_new-", "stream_merged-"))}

    before, path, bronze = aside(), scratch("rounds"), load_bronze(spark, sf_small)
    for part in ("video_id < 'vid_000600'", "video_id >= 'vid_000300'", "video_id < 'vid_000010'"):
        incremental.merge_batch(bronze.filter(part), path, as_of="2024-01-31", buckets=4)
    assert rounds[:8] == [1] * 8 and aside() == before          # a bucket a round, nothing left aside
    want = bronze_to_silver(bronze, as_of="2024-01-31").drop("processed_timestamp")
    got = read_table(spark, path).select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_the_streams_landings_are_gzipped(spark, sf_small, monkeypatch):
    from vidlake.plans.catalog import QUERIES
    from vidlake.sources import sinks
    landed, write = [], sinks.write_bronze_csv
    monkeypatch.setattr(sinks, "write_bronze_csv", lambda *a, **b: landed.append(b.get("compression")) or write(*a, **b))
    assert QUERIES["stream_incremental_silver"](spark, sf_small).count() > 0 and landed == ["gzip"] * 4
