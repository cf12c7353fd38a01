"""Queries write the columns of silver that they read; whole descriptions are neither exchanged nor written for them
(findings F2 to F23 of round 3)."""

import pytest

from vidlake.operators import ml
from vidlake.operators.features import build_features, text_features
from vidlake.plans import catalog
from vidlake.schemas import SILVER_SCHEMA

NAMED = ["dq_drift_report", "dq_quality_dimensions", "dq_retained_masked", "features", "gold_category_analysis",
         "gold_category_performance", "gold_channel_performance", "gold_daily_metrics", "gold_distinct_reach",
         "gold_driver_strength", "gold_posting_time_analysis", "gold_trending_videos", "ml_baseline_metrics",
         "ml_batch_scoring", "ml_conformal_scoring", "ml_logistic_newton", "ml_regressor_selection", "ml_retrain_decision",
         "ml_ridge_tuning", "pip_gold_category_analysis", "pip_gold_channel_performance"]


class Written(Exception):
    pass


@pytest.mark.parametrize("name", NAMED)
def test_queries_write_no_descriptions(spark, sf_small, monkeypatch, name):
    def record(df, path, *_):
        raise Written(df.columns)
    monkeypatch.setattr(catalog, "bronze_to_silver", lambda *_, **__: spark.createDataFrame([], SILVER_SCHEMA))
    monkeypatch.setattr(catalog, "write_silver", record)
    with pytest.raises(Written) as got:
        catalog.QUERIES[name](spark, sf_small)
    assert "description" not in got.value.args[0] and "thumbnail_link" not in got.value.args[0]


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_narrow_silver_gives_the_rows_features_and_model_inputs_of_whole_silver(spark, sf_small):
    whole = catalog.silver_of(spark, sf_small)
    assert {f.name for f in SILVER_SCHEMA.fields} == set(whole.columns)
    narrow = catalog.silver_of(spark, sf_small, catalog.READS["models"])
    assert rows(narrow) == rows(whole.select(*narrow.columns))
    assert rows(ml.training_frame(narrow)) == rows(ml.training_frame(whole))
    derived = catalog.silver_of(spark, sf_small, catalog.READS["features"], text_features)
    assert "title" not in derived.columns
    assert rows(catalog.round_doubles(build_features(derived))) == rows(catalog.round_doubles(build_features(whole)))
