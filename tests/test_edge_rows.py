"""Hand-made rows (FIXTURES.md section 5): nulls, zero views, ties, gaps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vidlake.functions.clean import clean_and_standardize, deduplicate, standardize_column_names
from vidlake.operators import analytics, gold
from vidlake.operators.features import build_features, channel_history_features
from vidlake.operators.recommend import category_recommendations, strategy_comparison
from vidlake.plans.silver import bronze_to_silver
from vidlake.schemas import BRONZE_COLUMNS, BRONZE_SCHEMA

AS_OF = "2024-01-31"


def row(**kw):
    base = {"video_id": "v1", "title": "A title", "channel_title": "ch", "category_id": "24",
            "publish_time": "2024-01-10T10:00:00.000Z", "tags": "a|b", "views": "1000", "likes": "30",
            "dislikes": "1", "comment_count": "20", "thumbnail_link": "t", "comments_disabled": "false",
            "ratings_disabled": "false", "video_error_or_removed": "false", "description": "d"}
    base.update(kw)
    return tuple(base[c] for c in BRONZE_COLUMNS)


def bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


def test_dedup_survivor_is_max_views(spark):
    df = bronze(spark, [row(views="5"), row(views="900"), row(views=None), row(video_id="v2")])
    out = {r.video_id: r.views for r in deduplicate(df).collect()}
    assert out == {"v1": "900", "v2": "1000"}


def test_dedup_idempotent(spark):
    df = bronze(spark, [row(views=str(v)) for v in (3, 1, 2)] + [row(video_id="x")])
    once = deduplicate(df)
    assert sorted(once.collect()) == sorted(deduplicate(once).collect())


def test_header_normalisation_and_collision(spark):
    df = spark.createDataFrame([("a", "b")], "`Video ID` string, `publish-time` string")
    assert standardize_column_names(df).columns == ["video_id", "publish_time"]
    clash = spark.createDataFrame([("a", "b")], "`Video ID` string, `video_id` string")
    with pytest.raises(ValueError):
        standardize_column_names(clash)


def test_views_quality_ladder(spark):
    rows = [row(video_id="null", views=None), row(video_id="zero", views="0"), row(video_id="neg", views="-1"),
            row(video_id="text", views="lots"), row(video_id="ok")]
    c = {r.video_id: r for r in clean_and_standardize(bronze(spark, rows), as_of=AS_OF).collect()}
    assert c["null"].data_quality_score == 0.0 and c["neg"].data_quality_score == 0.0
    assert c["text"].views is None and c["text"].data_quality_score == 0.0
    assert c["zero"].data_quality_score == 1.0
    s = {r.video_id: r for r in bronze_to_silver(bronze(spark, rows), as_of=AS_OF).collect()}
    assert set(s) == {"zero", "ok"}
    assert s["zero"].engagement_rate == 0.0 and s["zero"].comment_ratio == 0.0


def test_publish_time_patterns(spark):
    rows = [row(video_id="ms", publish_time="2024-01-10T10:00:00.123Z"),
            row(video_id="s", publish_time="2024-01-10T10:00:00Z"),
            row(video_id="junk", publish_time="yesterday"), row(video_id="none", publish_time=None)]
    c = {r.video_id: r.publish_timestamp for r in clean_and_standardize(bronze(spark, rows), as_of=AS_OF).collect()}
    assert c["ms"] == dt.datetime(2024, 1, 10, 10, 0, 0, 123000)
    assert c["s"] == dt.datetime(2024, 1, 10, 10, 0, 0)
    assert c["junk"] is None and c["none"] is None


def test_titles_and_tags(spark):
    rows = [row(video_id="null", title=None, tags=None), row(video_id="blank", title="", tags=""),
            row(video_id="spaces", title="   ", tags="[none]"), row(video_id="caps", title="  BIG  NEWS ", tags="x|y")]
    c = {r.video_id: r for r in clean_and_standardize(bronze(spark, rows), as_of=AS_OF).collect()}
    assert c["null"].data_quality_score == 0.3 and c["null"].tag_count == 0
    assert c["blank"].data_quality_score == 0.3 and c["blank"].tag_count == 1
    assert c["spaces"].title == "" and c["spaces"].data_quality_score == 0.3 and c["spaces"].tag_count == 1
    assert c["caps"].title == "BIG  NEWS" and c["caps"].title_length == 9 and c["caps"].tag_count == 2
    f = build_features(bronze_to_silver(bronze(spark, rows), as_of=AS_OF)).collect()[0]
    assert f.title_word_count == 3  # single-space split counts the empty piece
    assert f.title_all_caps_ratio == pytest.approx(7 / 9)


def test_published_on_and_after_as_of(spark):
    rows = [row(video_id="on", publish_time="2024-01-31T05:00:00.000Z"),
            row(video_id="after", publish_time="2024-02-01T05:00:00.000Z")]
    s = {r.video_id: r for r in bronze_to_silver(bronze(spark, rows), as_of=AS_OF).collect()}
    assert s["on"].days_since_publish == 0 and s["on"].views_per_day == 1000.0
    assert s["on"].viral_score == pytest.approx(1000 * 0.05 / 1)
    assert s["after"].days_since_publish == -1 and s["after"].viral_score is None


def test_engagement_category_edges(spark):
    rows = [row(video_id="hi", likes="30", comment_count="20"),   # 0.05
            row(video_id="mid", likes="10", comment_count="10"),  # 0.02
            row(video_id="lo", likes="10", comment_count="9")]
    s = {r.video_id: r.engagement_category for r in bronze_to_silver(bronze(spark, rows), as_of=AS_OF).collect()}
    assert s == {"hi": "high", "mid": "medium", "lo": "low"}


def test_trending_rank_tie_break(spark):
    rows = [row(video_id=v, publish_time="2024-01-28T10:00:00.000Z") for v in ("b", "a", "c")]
    t = gold.trending_videos(bronze_to_silver(bronze(spark, rows), as_of=AS_OF))
    assert [(r.video_id, r.trending_rank_in_category) for r in t.orderBy("trending_rank_in_category").collect()] \
        == [("a", 1), ("b", 2), ("c", 3)]


def test_one_video_channel_consistency(spark):
    rows = [row(video_id=f"v{i}", publish_time=f"2024-01-{d:02d}T10:00:00.000Z")
            for i, d in enumerate([1, 1, 3, 10, 11, 12, 13, 14, 20, 21])]
    rows.append(row(video_id="solo", channel_title="solo"))
    s = bronze_to_silver(bronze(spark, rows), as_of=AS_OF)
    q8 = {r.channel_title: r for r in analytics.channel_consistency(s).collect()}
    assert set(q8) == {"ch"}
    gaps = [0, 2, 7, 1, 1, 1, 1, 6, 1]
    import statistics
    assert q8["ch"].avg_days_between_posts == pytest.approx(sum(gaps) / 9)
    assert q8["ch"].stddev_days_between_posts == pytest.approx(statistics.stdev(gaps))
    assert q8["ch"].posting_days == 9  # first day has a second upload, so it counts
    cp = {r.channel_title: r for r in gold.channel_performance(s, as_of=AS_OF).collect()}
    assert cp["solo"].days_active == 1 and cp["solo"].posting_frequency == 1.0


def test_row_frame_vs_day_frame_with_gaps(spark):
    days = [1, 2, 3, 10, 11, 20, 21, 22, 23]
    rows = [row(video_id=f"v{d}", views=str(d * 100), publish_time=f"2024-01-{d:02d}T10:00:00.000Z") for d in days]
    s = bronze_to_silver(bronze(spark, rows), as_of=AS_OF)
    ca = {r.publish_date.day: r.rolling_avg_views_7d for r in gold.category_analysis(s).collect()}
    # 7 rows back regardless of calendar gaps
    assert ca[22] == pytest.approx(sum(d * 100 for d in [2, 3, 10, 11, 20, 21, 22]) / 7)
    assert ca[23] == pytest.approx(sum(d * 100 for d in [3, 10, 11, 20, 21, 22, 23]) / 7)
    fe = {r.video_id: r.rolling_avg_views_7d for r in channel_history_features(s).collect()}
    # 7 calendar days before Jan 23: Jan 16..22 -> 20, 21, 22
    assert fe["v23"] == pytest.approx((2000 + 2100 + 2200) / 3)
    assert fe["v10"] == pytest.approx(300.0)  # Jan 3..9 holds only Jan 3
    assert fe["v1"] is None  # nothing before the first upload


def _slots(spark, rows):
    return spark.createDataFrame(rows, "publish_hour int, publish_day_of_week int, category_id int, "
                                       "video_count long, avg_views double, avg_engagement_rate double, "
                                       "avg_viral_score double")


def test_zero_max_metric_gives_null_part(spark):
    slots = _slots(spark, [(10, 2, 1, 3, 100.0, 0.0, 5.0), (11, 3, 1, 2, 50.0, 0.0, 10.0)])
    r = {x.hour: x.composite_score for x in category_recommendations(slots, top_n=5).collect()}
    assert r == {10: None, 11: None}  # engagement max is 0 -> that term is null


def test_strategy_zero_defaults(spark):
    night_weekdays = _slots(spark, [(1, 2, 1, 1, 10.0, 0.1, 1.0), (23, 4, 1, 1, 30.0, 0.3, 1.0)])
    r = strategy_comparison(night_weekdays).collect()[0]
    assert r.weekend_avg_views == 0.0 and r.weekend_avg_engagement == 0.0
    assert r.morning_avg_views == 0.0 and r.evening_avg_views == 0.0
    assert r.weekday_avg_views == pytest.approx(20.0)


def test_q1_rank_with_ties(spark):
    rows = [row(video_id=f"v{i}", views=str(v)) for i, v in enumerate([50, 100, 100, 70])]
    s = bronze_to_silver(bronze(spark, rows), as_of=AS_OF)
    r = [(x.views, x.view_rank) for x in analytics.top_videos_by_views(s, limit=3).orderBy("view_rank").collect()]
    assert r == [(100, 1), (100, 1), (70, 3)]


def test_holiday_calendar_table(spark):
    from vidlake.operators.features import holiday_flag
    rows = [row(video_id="ny", publish_time="2024-01-01T10:00:00.000Z"),
            row(video_id="cal", publish_time="2024-01-15T10:00:00.000Z"),
            row(video_id="no", publish_time="2024-01-16T10:00:00.000Z")]
    s = bronze_to_silver(bronze(spark, rows), as_of=AS_OF)
    default = {r.video_id: r.is_holiday for r in holiday_flag(s).collect()}
    assert default == {"ny": 1, "cal": 0, "no": 0}
    cal = spark.createDataFrame([("2024-01-15",), ("2024-01-15",)], "holiday_date string")
    table = {r.video_id: r.is_holiday for r in holiday_flag(s, cal).collect()}
    assert table == {"ny": 0, "cal": 1, "no": 0}
