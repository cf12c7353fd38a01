"""Landed files, API JSON, generator, writers, catalog registration."""

import json

import pytest

from pyspark.sql import functions as F

from vidlake.functions.quality import validation_report
from vidlake.plans.pipelines import bronze_to_silver_job, ingest
from vidlake.schemas import BRONZE_COLUMNS
from vidlake.sources import sinks
from vidlake.sources.api import read_api_responses
from vidlake.sources.files import peek, read_bronze_csv, read_table
from vidlake.sources.sample import sample_bronze


def test_csv_with_raw_headers_and_newlines(spark, scratch):
    path = scratch("raw_csv")
    df = spark.createDataFrame([("v1", "line1\nline2, with comma", " padded ")],
                               "`Video ID` string, description string, `publish-time` string")
    df.write.option("header", True).option("escape", '"').option("ignoreTrailingWhiteSpace", False) \
        .option("ignoreLeadingWhiteSpace", False).csv(path)
    back = read_bronze_csv(spark, path, schema=None, multi_line=True, escaped=False)
    assert back.columns == ["video_id", "description", "publish_time"]
    r = back.collect()[0]
    assert r.description == "line1\nline2, with comma" and r.publish_time == " padded "


def test_api_json_cases(spark, scratch):
    path = scratch("api")
    responses = [
        {"items": [{"id": "a", "snippet": {"title": "t", "channelTitle": "c", "categoryId": "28",
                                           "publishedAt": "2024-01-02T03:04:05Z", "tags": ["x", "y"],
                                           "thumbnails": {"default": {"url": "u"}}, "description": "d"},
                    "statistics": {"viewCount": "10", "likeCount": "2", "commentCount": "1"}},
                   {"id": "b", "snippet": {"title": "t2", "channelTitle": "c", "categoryId": "10",
                                           "publishedAt": "2024-01-02T03:04:05Z",
                                           "thumbnails": {"default": {"url": "u"}}, "description": ""},
                    "statistics": {"viewCount": "5"}}]},
        {"items": []},
    ]
    spark.createDataFrame([(json.dumps(r),) for r in responses], "value string").write.text(path)
    rows = {r.video_id: r for r in read_api_responses(spark, path).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"].tags == "x|y" and rows["a"].comments_disabled == "false"
    assert rows["b"].tags == "" and rows["b"].likes == "0" and rows["b"].comment_count == "0"
    assert rows["b"].comments_disabled == "true" and rows["b"].dislikes == "0"


def test_sample_generator_is_seeded_and_valid(spark):
    a = sample_bronze(spark, n=500, seed=7)
    assert a.columns == BRONZE_COLUMNS
    assert sorted(a.collect()) == sorted(sample_bronze(spark, n=500, seed=7).collect())
    assert validation_report(a).first()["is_valid"]
    stats = a.agg(F.count_distinct("channel_title").alias("ch"),
                  F.min(F.col("views").cast("long")).alias("mn")).first()
    assert stats.ch == 50 and stats.mn >= 0


def test_ingest_land_and_silver_job(spark, scratch):
    base = scratch("ingest")
    rep = ingest(sample_bronze(spark, n=300, seed=3), f"{base}/landing", run_ts="t1", source="generator")
    assert rep.counts["landed_rows"] == 300 and rep.counts["summary"]["total_records"] == 300
    manifest = spark.read.json(f"{base}/landing/_manifests/video_stats_t1").first()
    assert manifest.record_count == "300" and manifest.source == "generator"
    job = bronze_to_silver_job(spark, rep.outputs["landed"], f"{base}/silver", as_of="2024-12-31",
                               table="silver_test_tbl")
    assert job.counts["input_rows"] == 300 and 0 < job.counts["kept_rows"] <= 300
    assert spark.table("silver_test_tbl").count() == job.counts["kept_rows"]
    assert peek(spark.table("silver_test_tbl"), 10).count() == 10


def test_invalid_batch_is_not_landed(spark, scratch):
    bad = spark.createDataFrame([("v", "lots")], "video_id string, views string")
    rep = ingest(bad, scratch("bad"))
    assert "landed" not in rep.outputs and not rep.counts["validation"]["is_valid"]


def test_dynamic_partition_overwrite_keeps_other_partitions(spark, scratch):
    path = scratch("dyn")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    sinks.write_partitioned(df, path, ["k"])
    sinks.write_partitioned(spark.createDataFrame([(1, "z")], "k int, v string"), path, ["k"])
    assert sorted((r.k, r.v) for r in read_table(spark, path).collect()) == [(1, "z"), (2, "b")]


def _rows(spark, n=3, **extra):
    base = {c: f"{c}-{{}}" for c in BRONZE_COLUMNS}
    return spark.createDataFrame([tuple(v.format(i) for v in base.values()) for i in range(n)], BRONZE_COLUMNS)


def test_csv_columns_are_taken_by_name(spark, scratch):
    path = scratch("by_name")
    rows = _rows(spark)
    mixed = rows.select(F.col("video_id").alias("Video ID"), F.lit("24.01.01").alias("trending_date"),
                        *reversed([c for c in BRONZE_COLUMNS if c not in ("video_id", "thumbnail_link")]))
    sinks.write_bronze_csv(mixed, path, run_ts="1")
    sinks.write_bronze_csv(rows, path, run_ts="2")           # another landing with another header
    back = read_bronze_csv(spark, path)
    assert back.columns == BRONZE_COLUMNS and back.count() == 6
    first = back.filter("video_id = 'video_id-0'").orderBy(F.col("thumbnail_link").asc_nulls_first()).collect()
    assert first[0].title == first[1].title == "title-0" and first[0].views == "views-0"
    assert first[0].thumbnail_link is None and first[1].thumbnail_link == "thumbnail_link-0"


def test_csv_without_a_required_column_is_an_error(spark, scratch):
    path = scratch("lacking")
    sinks.write_bronze_csv(_rows(spark).drop("views"), path, run_ts="1")
    with pytest.raises(ValueError, match="views"):
        read_bronze_csv(spark, path)


def test_csv_round_trip_of_line_breaks_and_quotes(spark, scratch):
    path = scratch("breaks")
    texts = ["a\nb", "\\n literal", "\\\n", 'say "x", y', "\r\n", "\\", " padded ", "tab\tü日"]
    rows = _rows(spark, 1).drop("description").crossJoin(spark.createDataFrame([(t,) for t in texts], "description string"))
    sinks.write_bronze_csv(rows, path, run_ts="1")
    assert sorted(r.description for r in read_bronze_csv(spark, path).collect()) == sorted(texts)


def test_one_large_landed_file_splits_into_tasks(spark, scratch):
    path = scratch("large")
    wide = spark.range(3000).select(*(F.lit("1").alias(c) for c in BRONZE_COLUMNS if c != "description"),
                                    F.repeat(F.lit("text\n"), 200).alias("description")).coalesce(1)
    sinks.write_bronze_csv(wide.select(*BRONZE_COLUMNS), path, run_ts="1")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 18))
    try:
        back = read_bronze_csv(spark, path)
        assert back.rdd.getNumPartitions() > 4 and back.count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_table_name_is_not_moved_silently(spark, scratch):
    one, two = scratch("t1"), scratch("t2")
    for p in (one, two):
        sinks.write_partitioned(spark.createDataFrame([(1, "a")], "k int, v string"), p, ["k"])
    sinks.register_table(spark, "moved_tbl", one)
    sinks.register_table(spark, "moved_tbl", one)
    with pytest.raises(ValueError, match="moved_tbl"):
        sinks.register_table(spark, "moved_tbl", two)


def test_stream_month_and_category_changes(spark, scratch):
    from vidlake.streaming.incremental import incremental_silver
    base = scratch("stream_changes")
    row = lambda views, cat="10", title="t", time="2024-01-02T03:04:05Z": (
        "v1", title, "c", cat, time, None, views, "1", "0", "0", None, "false", "false", "false", "d")

    def land(ts, *rows):
        sinks.write_bronze_csv(spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in BRONZE_COLUMNS)),
                               f"{base}/landing", run_ts=ts)
        incremental_silver(spark, f"{base}/landing", f"{base}/silver", f"{base}/ckpt", as_of="2024-01-31")
        return sorted((r.category_id, r.views) for r in spark.read.parquet(f"{base}/silver").collect())

    assert land("1", row("100"), row("5", time="junk")) == [(10, 5), (10, 100)]
    assert land("2", row("900", cat="20"), row("5", time="junk")) == [(10, 5), (20, 900)]
    assert land("3", row("1000", title="")) == [(10, 5)]                  # the survivor fails the quality filter
    assert land("4", row("950")) == [(10, 5)]                             # and still survives a lesser copy
    assert land("5", row("2000")) == [(10, 5), (10, 2000)]


def test_a_batch_of_one_key_rewrites_one_folder(spark, scratch):
    from vidlake.sources.files import hadoop_path
    from vidlake.streaming.incremental import bucket_silver, layout, merge_batch
    path = scratch("bucketed")
    row = lambda k, views, cat="10": (f"v{k}", "t", "c", cat, f"2024-01-0{1 + k % 9}T03:04:05Z", None, str(views), "1", "0", "0",
                                      None, "false", "false", "false", "d")
    batch = lambda *rows: spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in BRONZE_COLUMNS))

    def files():
        fs, at = hadoop_path(spark, path)
        found, it = {}, fs.listFiles(at, True)
        while it.hasNext():
            f = it.next()
            if f.getPath().getName().endswith(".parquet"):
                found[f.getPath().toString()] = f.getModificationTime()
        return found

    def rows():
        return {(r.video_id, r.category_id, r.views) for r in spark.read.parquet(path).collect()}

    merge_batch(batch(*(row(k, 10, str(10 + k % 3)) for k in range(300))), path, as_of="2024-01-31", buckets=16)
    before, had = files(), rows()
    assert layout(spark, path) == 16 and len(before) >= 3 * 16 - 3 and len(had) == 300
    merge_batch(batch(row(7, 5000, "11")), path, as_of="2024-01-31")
    after = files()
    gone, new = set(before) - set(after), set(after) - set(before)
    assert 1 <= len(gone) <= 3 and len(new) <= 3          # one bucket of the month, in its three categories
    assert rows() == {r for r in had if r[0] != "v7"} | {("v7", 11, 5000)}
    with pytest.raises(ValueError, match="buckets"):
        layout(spark, path, 8)
    plain = scratch("plain")
    sinks.write_silver(spark.read.parquet(path).drop("key_bucket"), plain)
    with pytest.raises(ValueError, match="bucket_silver"):
        merge_batch(batch(row(1, 1)), plain)
    anew = scratch("anew")
    bucket_silver(spark.read.parquet(plain), anew, 4)
    merge_batch(batch(row(1, 77)), anew, as_of="2024-01-31")
    assert spark.read.parquet(anew).filter("video_id = 'v1'").first().views == 77 and spark.read.parquet(anew).count() == 300


def test_landings_of_one_header_are_one_scan(spark, scratch):
    base = scratch("landings")
    for k in range(6):
        sinks.write_bronze_csv(_rows(spark, 5), base, run_ts=str(k))
    df = read_bronze_csv(spark, base)
    assert df.count() == 30 and df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_api_pages_are_bounded_whatever_the_ids(spark):
    from vidlake.sources.api import bronze_to_api_responses
    rows = _rows(spark, 130).withColumn("video_id", F.lit("no digits"))
    pages = bronze_to_api_responses(rows, page_size=50).select(F.size("items").alias("n")).collect()
    assert sum(r.n for r in pages) == 130 and max(r.n for r in pages) <= 50
