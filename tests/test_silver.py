"""Landed envelopes become typed snapshots: own cases, built from the contract of the columns."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.plans import silver
from tidemark.schemas import CATEGORY_ENVELOPE, SILVER_COLUMNS
from tidemark.sources import landing

DAY = "2031-02-27"


def clip(ident, counts=("640", "32", "16"), tags=(), category="7"):
    views, likes, comments = counts
    head = {"title": f"clip {ident}", "description": "", "channelId": "ch-" + str(ident), "channelTitle": "channel", "categoryId": category,
            "publishedAt": "2031-02-01T05:30:00Z", "tags": list(tags), "thumbnails": {"high": {"url": "https://i/x.jpg"}}}
    return {"id": ident, "snippet": head, "statistics": {"viewCount": views, "likeCount": likes, "commentCount": comments}}


@pytest.fixture
def land(spark, tmp_path):
    """Writes envelopes of one region and hour, and reads that hour back."""
    def run(*batches, hour=9, zone="+00:00", region="SG"):
        for minute, clips in batches:
            at = tmp_path / f"region={region}/date={DAY}/hour={hour:02d}"
            at.mkdir(parents=True, exist_ok=True)
            head = {"region": region, "logical_hour": f"{DAY}T{hour:02d}:00:00{zone}", "ingestion_id": f"{region}-{hour}-{minute}",
                    "ingested_at": f"{DAY}T{hour:02d}:{minute:02d}:00{zone}", "source": "test"}
            (at / f"{minute}-{len(list(at.iterdir()))}.json").write_text(json.dumps({"_metadata": head, "response": {"items": clips}}))
        return landing.read_documents(spark, landing.landing_paths(str(tmp_path), landing.hour_list(DAY, f"{hour:02d}")), base=str(tmp_path))

    return run


def test_one_clip_gives_one_row_of_the_contract(land):
    out = silver.to_silver(land((5, [clip("k", tags=["live", "vlog", "4k"])])))
    assert out.columns == SILVER_COLUMNS
    row = out.first().asDict()
    assert (row["views"], row["likes"], row["comment_count"]) == (640, 32, 16)
    assert (row["like_ratio"], row["engagement_rate"]) == (32 / 640, 48 / 640)
    assert (row["tags"], row["region"], row["ingestion_id"], row["category_id"]) == ("live,vlog,4k", "SG", "SG-9-5", "7")


def test_half_hour_offset_becomes_utc_and_hours_are_truncated(land):
    out = silver.to_silver(land((41, [clip("k")]), zone="+05:30", region="IN"))
    shown = out.select(*[F.date_format(c, "dd HH:mm") for c in ("captured_at", "ingested_at", "published_at")]).first()
    assert tuple(shown) == ("27 03:00", "27 04:11", "01 05:30")


@pytest.mark.parametrize("counts,want", [(("0", "4", "2"), (0, 4, 2, 0.0, 0.0)), ((None, None, None), (0, 0, 0, 0.0, 0.0)),
                                         (("8", None, "6"), (8, 0, 6, 0.0, 0.75))])
def test_no_views_or_missing_counts_give_no_ratio(land, counts, want):
    row = silver.to_silver(land((5, [clip("k", counts)]))).first()
    assert (row["views"], row["likes"], row["comment_count"], row["like_ratio"], row["engagement_rate"]) == want


def test_newest_ingest_of_an_hour_wins_and_a_tie_gives_one_row(land):
    found = silver.to_silver(land((3, [clip("k", ("11", "1", "1")), clip("m")]), (58, [clip("k", ("77", "1", "1"))]),
                                  (58, [clip("k", ("76", "1", "1"))]))).collect()
    views = {r["video_id"]: r["views"] for r in found}
    assert len(found) == 2 and views["m"] == 640 and views["k"] in (76, 77)
    again = silver.to_silver(land()).where("video_id = 'k'").first()["views"]
    assert again == views["k"]  # the tie is broken alike in every run


def test_clip_without_id_is_left_out(land):
    assert [r["video_id"] for r in silver.to_silver(land((5, [clip(None), clip("k")]))).collect()] == ["k"]


def test_envelopes_without_items_and_counts_that_are_no_numbers(land):
    envelopes = land((5, []), (6, None), (7, [clip("bad", ("12 k", "3", "x")), clip("k")]), region="AU")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver.to_silver(envelopes).collect()
    lenient = {r["video_id"]: (r["views"], r["likes"], r["comment_count"]) for r in silver.to_silver(envelopes, strict=False).collect()}
    assert lenient == {"bad": (0, 3, 0), "k": (640, 32, 16)}
    counted = silver.rejected_counts(envelopes).first()
    assert (counted["region"], counted["views"], counted["likes"]) == ("AU", 1, 0)


def test_hours_asked_for():
    first = datetime(2031, 2, 28, 20, tzinfo=timezone.utc)
    night = landing.hour_list(start_hour="2031-02-28T20", end_hour="2031-03-01T06")
    assert night == [first + timedelta(hours=i) for i in range(11)]
    assert landing.hour_list(start_hour="2031-02-28T20", end_hour="2031-02-28T20") == landing.hour_list("2031-02-28", "20") == [first]
    with pytest.raises(ValueError, match="no hour"):
        landing.hour_list(start_hour="2031-02-28T20", end_hour="2031-02-28T19")


def test_only_the_hours_asked_for_are_read(land):
    land((5, [clip("early")]), hour=8)
    land((5, [clip("elsewhere")]), region="KR")
    found = land((5, [clip("k")]))
    assert {f.rsplit("hour=", 1)[1][:2] for f in found.inputFiles()} == {"09"}
    assert {r["video_id"] for r in silver.to_silver(found).collect()} == {"k", "elsewhere"}


def test_nothing_landed_raises(land):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        land(hour=17)


def test_keys_name_region_and_logical_hour(spark):
    at = F.lit("2031-02-27 03:00:00").cast("timestamp")
    key = lambda *more: landing.landing_key(F.lit("root/raw"), F.lit("SG"), at, "f.json", *more)
    assert tuple(spark.range(1).select(key(), key(False)).first()) == (
        "root/raw/region=SG/date=2031-02-27/hour=03/f.json", "root/raw/region=SG/date=2031-02-27/f.json")


def test_category_documents(spark, tmp_path):
    items = [{"id": "3", "snippet": {"title": "Cooking"}}, {"id": "9", "snippet": {}}]
    (tmp_path / "c.json").write_text(json.dumps({"_metadata": {"region": "KR"}, "response": {"items": items}}))
    at = F.lit(DAY).cast("timestamp")
    found = landing.category_rows(landing.read_documents(spark, str(tmp_path / "c.json"), schema=CATEGORY_ENVELOPE), at)
    assert sorted((r["category_id"], r["region"], r["category_name"]) for r in found.collect()) == [("3", "KR", "Cooking"), ("9", "KR", None)]
