"""A spread of registered queries against their SQL, and the contract of the entry module."""

import pytest

import __spark_entry__ as entry
import compare
from tests.conftest import DATA

SPREAD = ["gold_trending_daily", "gold_channel_performance", "gold_category_daily", "gold_video_velocity_hourly",
          "gold_video_lifecycle", "silver_transform", "upsert_snapshots", "idempotence_check", "funnel", "attribution",
          "basket_rules", "retention", "rfm_segments", "pit_features", "lexical_search", "knn_items", "psi", "rolling_auc",
          "slo_burn_rate", "heal_text"]


@pytest.fixture(scope="module")
def con():
    return compare.connect(DATA)


@pytest.mark.parametrize("name", SPREAD)
def test_query_matches_sql(spark, con, name):
    status, note, _ = compare.check(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], DATA)
    assert status == "ok", note


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert "velocity_rank" in entry.entry(spark).columns
