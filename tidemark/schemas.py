"""Landing and output schemas. All instants are UTC; surrogate serial ids are not kept."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


TICKS_DDL = """
    symbol STRING, event_time TIMESTAMP, price DECIMAL(20,8), price_change_pct DECIMAL(10,4),
    volume_base DECIMAL(24,8), volume_quote DECIMAL(24,8), trades_count BIGINT,
    bid DECIMAL(20,8), ask DECIMAL(20,8), ingested_at TIMESTAMP
"""

MARKETS_DDL = """
    id STRING, symbol STRING, name STRING, image STRING, current_price DECIMAL(24,8), market_cap DECIMAL(30,2),
    market_cap_rank INT, fully_diluted_valuation DECIMAL(30,2), total_volume DECIMAL(30,2),
    high_24h DECIMAL(24,8), low_24h DECIMAL(24,8), price_change_24h DECIMAL(24,8),
    price_change_percentage_24h DECIMAL(12,4), price_change_percentage_1h_in_currency DECIMAL(12,4),
    price_change_percentage_24h_in_currency DECIMAL(12,4), price_change_percentage_7d_in_currency DECIMAL(12,4),
    market_cap_change_24h DECIMAL(30,2), market_cap_change_percentage_24h DECIMAL(12,4),
    circulating_supply DECIMAL(30,4), total_supply DECIMAL(30,4), max_supply DECIMAL(30,4),
    ath DECIMAL(24,8), ath_change_percentage DECIMAL(12,4), ath_date TIMESTAMP,
    atl DECIMAL(24,8), atl_change_percentage DECIMAL(12,4), atl_date TIMESTAMP,
    last_updated TIMESTAMP, ingested_at TIMESTAMP
"""

INDEX_DDL = """
    index_date TIMESTAMP, value INT, category STRING, time_until_update STRING, ingested_at TIMESTAMP
"""

POSTS_DDL = """
    id STRING, subreddit STRING, title STRING, selftext STRING, author STRING, score INT, upvote_ratio FLOAT,
    num_comments INT, created_utc TIMESTAMP, url STRING, is_self BOOLEAN, over_18 BOOLEAN, permalink STRING,
    ingested_at TIMESTAMP
"""

SENTIMENT_DDL = """
    post_id STRING, subreddit STRING, created_utc TIMESTAMP, compound DOUBLE, pos DOUBLE, neu DOUBLE, neg DOUBLE,
    sentiment_label STRING, text_length INT, model_version STRING, scored_at TIMESTAMP
"""

ANOMALIES_DDL = """
    symbol STRING, event_hour TIMESTAMP, close DOUBLE, hour_return DOUBLE, volume_base DOUBLE,
    return_zscore DOUBLE, is_anomaly_zscore BOOLEAN, zscore_threshold DOUBLE, iforest_score DOUBLE,
    is_anomaly_iforest BOOLEAN, is_anomaly_consensus BOOLEAN, model_version STRING, detected_at TIMESTAMP
"""

LEDGER_DDL = """
    alert_key STRING, symbol STRING, event_hour TIMESTAMP, severity DECIMAL(10,4), sent_at TIMESTAMP,
    response_ok BOOLEAN
"""

# One normalised ticker message, as published to the tick topic.
TICK_MESSAGE_DDL = """
    symbol STRING, event_time BIGINT, price DOUBLE, price_change DOUBLE, price_change_pct DOUBLE,
    volume_base DOUBLE, volume_quote DOUBLE, trades_count BIGINT, bid DOUBLE, ask DOUBLE,
    open DOUBLE, high DOUBLE, low DOUBLE
"""

# A raw ticker is read as a map: its one-letter field names differ only by case (p / P), which
# struct fields under Spark's case-insensitive resolution cannot tell apart.
TICKER_MAP_DDL = "MAP<STRING, STRING>"

INDEX_PAYLOAD_DDL = """
    data ARRAY<STRUCT<value: STRING, value_classification: STRING, timestamp: STRING, time_until_update: STRING>>
"""

POST_LISTING_DDL = """
    data STRUCT<children: ARRAY<STRUCT<data: STRUCT<
        id: STRING, title: STRING, selftext: STRING, author: STRING, score: BIGINT, upvote_ratio: DOUBLE,
        num_comments: BIGINT, created_utc: DOUBLE, url: STRING, is_self: BOOLEAN, over_18: BOOLEAN,
        permalink: STRING>>>>
"""

MARKET_PAYLOAD_DDL = """
    id STRING, symbol STRING, name STRING, image STRING, current_price DOUBLE, market_cap DOUBLE,
    market_cap_rank INT, fully_diluted_valuation DOUBLE, total_volume DOUBLE, high_24h DOUBLE, low_24h DOUBLE,
    price_change_24h DOUBLE, price_change_percentage_24h DOUBLE, price_change_percentage_1h_in_currency DOUBLE,
    price_change_percentage_24h_in_currency DOUBLE, price_change_percentage_7d_in_currency DOUBLE,
    market_cap_change_24h DOUBLE, market_cap_change_percentage_24h DOUBLE, circulating_supply DOUBLE,
    total_supply DOUBLE, max_supply DOUBLE, ath DOUBLE, ath_change_percentage DOUBLE, ath_date STRING,
    atl DOUBLE, atl_change_percentage DOUBLE, atl_date STRING, last_updated STRING
"""


def ticks() -> T.StructType:
    return _schema(TICKS_DDL)


def markets() -> T.StructType:
    return _schema(MARKETS_DDL)


def index() -> T.StructType:
    return _schema(INDEX_DDL)


def posts() -> T.StructType:
    return _schema(POSTS_DDL)


def sentiment() -> T.StructType:
    return _schema(SENTIMENT_DDL)


def anomalies() -> T.StructType:
    return _schema(ANOMALIES_DDL)


def ledger() -> T.StructType:
    return _schema(LEDGER_DDL)
