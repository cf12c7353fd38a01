"""Job compositions PIP-2..PIP-5 end to end through files."""

from vidlake.plans import pipelines
from vidlake.plans.catalog import AS_OF
from vidlake.schemas import GOLD_PARTITION_KEYS
from vidlake.sources import sinks
from vidlake.sources.adapter import load_bronze
from vidlake.sources.files import read_table


def test_bronze_to_features_and_recommendations(spark, sf_small, scratch):
    base = scratch("pipes")
    landed, n = sinks.write_bronze_csv(load_bronze(spark, sf_small), f"{base}/landing", run_ts="r1")
    silver = pipelines.bronze_to_silver_job(spark, landed, f"{base}/silver", as_of=AS_OF)
    assert silver.counts["kept_rows"] == 953 and silver.counts["input_rows"] == 1000  # after de-duplication
    g = pipelines.silver_to_gold_job(spark, f"{base}/silver", f"{base}/gold", as_of=AS_OF)
    assert set(g.outputs) == set(GOLD_PARTITION_KEYS)
    posting = read_table(spark, g.outputs["posting_time_analysis"])
    assert posting.count() == 577
    assert read_table(spark, g.outputs["trending_videos"]).count() == 25
    f = pipelines.features_job(spark, f"{base}/silver", f"{base}/features")
    feats = read_table(spark, f.outputs["features"])
    assert feats.count() == 953 and {"publish_year", "publish_month"} <= set(feats.columns)
    r = pipelines.recommendations_job(spark, g.outputs["posting_time_analysis"], f"{base}/recs", run_ts="r1")
    recs = spark.read.json(r.outputs["recommendations"])
    assert recs.count() == 5
    row = recs.filter("category_id = 28").first()
    assert len(row.top_posting_times) == 5 and len(row.recommended_schedule) == 3
    # a rerun replaces partitions instead of duplicating them
    pipelines.bronze_to_silver_job(spark, landed, f"{base}/silver", as_of=AS_OF)
    assert read_table(spark, f"{base}/silver").count() == 953


def test_command_line_silver_and_gold(spark, sf_small, scratch, capsys):
    from vidlake.__main__ import main
    base = scratch("cli")
    landed, _ = sinks.write_bronze_csv(load_bronze(spark, sf_small), f"{base}/landing", run_ts="c1")
    main(["silver", "--bronze", landed, "--silver", f"{base}/silver", "--as-of", AS_OF])
    main(["gold", "--silver", f"{base}/silver", "--gold", f"{base}/gold", "--as-of", AS_OF])
    out = capsys.readouterr().out
    assert '"kept_rows": 953' in out and "posting_time_analysis" in out
