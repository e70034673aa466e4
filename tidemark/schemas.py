"""Explicit schemas and column contracts. Nothing in this package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


S, L, D, TS = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampType()

ENVELOPE = _struct(
    _metadata=_struct(region=S, logical_hour=S, ingestion_id=S, ingested_at=S, source=S),
    response=_struct(items=T.ArrayType(_struct(
        id=S,
        snippet=_struct(publishedAt=S, channelId=S, title=S, description=S,
                        thumbnails=_struct(high=_struct(url=S)),
                        channelTitle=S, tags=T.ArrayType(S), categoryId=S),
        statistics=_struct(viewCount=S, likeCount=S, commentCount=S),
        contentDetails=_struct(duration=S),
    ))),
)

CATEGORY_ENVELOPE = _struct(
    _metadata=_struct(region=S, logical_hour=S, ingestion_id=S, ingested_at=S, source=S),
    response=_struct(items=T.ArrayType(_struct(id=S, snippet=_struct(title=S)))),
)

SILVER = _struct(
    video_id=S, region=S, captured_at=TS, title=S, description=S, tags=S,
    channel_id=S, channel_title=S, category_id=S, published_at=TS,
    views=L, likes=L, comment_count=L, like_ratio=D, engagement_rate=D,
    thumbnail_url=S, ingestion_id=S, ingested_at=TS,
)
SILVER_COLUMNS = SILVER.fieldNames()
SILVER_KEY = ["video_id", "region", "captured_at"]

CATEGORIES = _struct(category_id=S, region=S, category_name=S, updated_at=TS)
CATEGORY_KEY = ["category_id", "region"]

# The regions the pipeline collects; the accepted-values check uses the same list.
REGIONS = ["TW", "JP", "KR", "HK", "US", "GB", "SG", "AU"]
SOURCE_NAME = "youtube_data_api_v3"
