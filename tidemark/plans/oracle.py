"""SQL counterparts of the registered queries, for an independent engine over the same tables.

A statement is a query over named building blocks; :func:`statements` prepends the blocks it
needs as common table expressions.
"""

from __future__ import annotations

import re

from tidemark.functions import lexicon_rules as R
from tidemark.functions.columns import NULL_KEY_TOKEN
from tidemark.functions.terms import NOT_WORD_CHAR
from tidemark.plans.catalog import TIE_SHIFT
from tidemark.sources import fixtures as fx

NOW = f"TIMESTAMP '{fx.AS_OF}'"
MENTIONS = [f"mentions_{s.lower()}" for s in fx.TERMS]


def r(expr: str, digits: int = 6) -> str:
    return f"round(({expr})::DOUBLE + {TIE_SHIFT}, {digits})"


def dec(expr: str, digits: int) -> str:
    """A double cast to a decimal of ``digits`` places (half up), shown as double."""
    return f"round(({expr})::DOUBLE::DECIMAL(38,{digits + 6}), {digits})::DOUBLE"


def key(*parts: str) -> str:
    texts = [f"coalesce(({p})::VARCHAR, '{NULL_KEY_TOKEN}')" for p in parts]
    return "md5(" + " || '-' || ".join(texts) + ")"


def dkey(ts: str) -> str:
    return f"strftime({ts}, '%Y%m%d')::INTEGER"


def hits(text: str, words) -> str:
    body = "|".join(words)
    return f"regexp_matches({text}, '(?i)(^|{NOT_WORD_CHAR})({body})($|{NOT_WORD_CHAR})')"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


def _in(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


BLOCKS: dict[str, str] = {}

# ---- landing tables ---------------------------------------------------------------------------

BLOCKS["fx_events"] = r"""
    SELECT ts, user_id, event_id, event_type, value, regexp_extract(props, '"k": *([0-9]+)', 1)::DOUBLE AS k
    FROM events
"""
BLOCKS["fx_ticks"] = """
    SELECT upper(event_type) || 'USDT' AS symbol, ts AS event_time, price, value - 20 AS price_change_pct,
           k AS volume_base, price * k AS volume_quote, user_id AS trades_count,
           price * 0.998765432187::DOUBLE AS bid, price * 1.001234567891::DOUBLE AS ask, ts AS ingested_at
    FROM (SELECT *, value + 1000 AS price FROM fx_events)
"""
BLOCKS["fx_markets"] = """
    SELECT coin AS coin_id,
           upper(CASE WHEN klass = 0 THEN event_type ELSE coin END) AS symbol,
           'Coin ' || coin AS coin_name, 'img/' || coin AS image_url,
           value AS current_price, value * 1e6 AS market_cap,
           CASE WHEN k <> 0 THEN 1 + (event_id * 7) % 300 END::INTEGER AS market_cap_rank,
           value * 2e6 AS fdv, value * k * 1000 AS volume_24h, value * 1.25::DOUBLE AS high_24h,
           value * 0.75::DOUBLE AS low_24h, value / 4 AS price_change_24h,
           CASE WHEN k <> 99 THEN value - 20 END AS price_change_pct_24h,
           k / 4 - 12 AS price_change_pct_1h, value * 2 - 40 AS price_change_pct_7d,
           value * 1e4 AS market_cap_change_24h, k / 2 AS market_cap_change_pct_24h,
           user_id * 1000.0::DOUBLE AS circulating_supply, user_id * 2000.0::DOUBLE AS total_supply,
           CASE WHEN k > 50 THEN user_id * 3000.0::DOUBLE END AS max_supply,
           value * 4 AS ath, -75.0::DOUBLE AS ath_change_pct, ts AS ath_date,
           value / 4 AS atl, 300.0::DOUBLE AS atl_change_pct, ts AS atl_date,
           ts AS last_updated, ts AS ingested_at
    FROM (SELECT *, user_id % 30 AS klass, event_type || '-' || (user_id % 30) AS coin FROM fx_events)
"""
BLOCKS["fx_index"] = """
    SELECT first_ts AS index_date, value,
           CASE WHEN value <= 24 THEN 'Extreme Fear' WHEN value <= 54 THEN 'Neutral' ELSE 'Greed' END AS category,
           last_ts AS ingested_at
    FROM (SELECT least(100, sum(round(value * 100)::BIGINT)::BIGINT // (100 * count(*)))::INTEGER AS value,
                 min(ts) AS first_ts, max(ts) AS last_ts
          FROM fx_events GROUP BY date_trunc('day', ts), event_type)
"""
BLOCKS["fx_posts"] = r"""
    SELECT d.doc_id::VARCHAR AS id, upper(d.source) AS subreddit, split_part(d.text, chr(10), 1) AS title,
           substr(d.text, length(split_part(d.text, chr(10), 1)) + 2) AS selftext,
           d.source || '-' || d.lang AS author, (d.n_chars % 500 - 50)::INTEGER AS score,
           (d.n_chars % 64)::DOUBLE / 64 AS upvote_ratio, (d.doc_id % 37)::INTEGER AS num_comments,
           TIMESTAMP '2024-01-01' + to_minutes((d.doc_id * 41) % 43200) AS created_utc,
           'https://example.org/' || d.doc_id AS url, true AS is_self, coalesce(l.toxic = 1, false) AS over_18,
           '/p/' || d.doc_id AS permalink, d.lang
    FROM documents d LEFT JOIN labels l USING (doc_id)
"""

# ---- staging ----------------------------------------------------------------------------------

BLOCKS["s_ticks"] = """
    SELECT symbol, regexp_replace(symbol, 'USDT$', '') AS base_asset,
           CASE WHEN ends_with(symbol, 'USDT') THEN 'USDT' END AS quote_asset, event_time,
           time_bucket(INTERVAL 1 MINUTE, event_time) AS event_minute,
           date_trunc('hour', event_time) AS event_hour, event_time::DATE::TIMESTAMP AS event_date,
           price, price_change_pct, volume_base, volume_quote, trades_count, bid, ask, ingested_at,
           ask - bid AS spread, CASE WHEN bid > 0 THEN 100 * ((ask - bid) / bid) END AS spread_pct
    FROM fx_ticks WHERE price > 0 AND volume_base >= 0 AND symbol IS NOT NULL
"""
BLOCKS["s_markets"] = """
    SELECT *, date_trunc('hour', ingested_at) AS snapshot_hour, ingested_at::DATE::TIMESTAMP AS snapshot_date
    FROM fx_markets WHERE current_price IS NOT NULL
"""
BLOCKS["s_index"] = """
    SELECT index_date::DATE::TIMESTAMP AS index_date, value, lower(category) AS category,
           CASE WHEN value > 74 THEN 'extreme_greed' WHEN value > 54 THEN 'greed' WHEN value > 44 THEN 'neutral'
                WHEN value > 24 THEN 'fear' ELSE 'extreme_fear' END AS sentiment_bucket,
           round((value - 50) / 50.0::DOUBLE, 4) AS sentiment_score, ingested_at
    FROM fx_index
    QUALIFY ingested_at = max(ingested_at) OVER (PARTITION BY index_date::DATE)
"""
BLOCKS["s_posts"] = (
    """
    SELECT id, lower(subreddit) AS subreddit, title, substr(selftext, 1, 500) AS selftext_preview, author, score,
           upvote_ratio, num_comments, created_utc, url, is_self, over_18, permalink, created_utc AS ingested_at,
           date_trunc('hour', created_utc) AS created_hour, created_utc::DATE::TIMESTAMP AS created_date,
           length(full_text) AS text_length, md5(full_text) AS full_text, md5(selftext) AS selftext,
    """
    + ", ".join(f"{hits('full_text', words)} AS mentions_{s.lower()}" for s, words in fx.TERMS.items())
    + " FROM (SELECT *, title || ' ' || selftext AS full_text FROM fx_posts WHERE title IS NOT NULL AND NOT over_18)"
)

# ---- dimensions and facts ---------------------------------------------------------------------

BLOCKS["d_coin"] = f"""
    SELECT {key("coin_id")} AS coin_key, coin_id, symbol, coin_name, image_url, max_supply, circulating_supply,
           total_supply
    FROM s_markets
    QUALIFY row_number() OVER (PARTITION BY coin_id ORDER BY ingested_at DESC, symbol, coin_name) = 1
"""
BLOCKS["d_date"] = f"""
    SELECT {dkey("d")} AS date_key, d::DATE AS date_day, year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter,
           month(d)::INTEGER AS month, rpad(monthname(d), 9, ' ') AS month_name, day(d)::INTEGER AS day_of_month,
           dayofweek(d)::INTEGER AS day_of_week, rpad(dayname(d), 9, ' ') AS day_name, week(d)::INTEGER AS iso_week,
           dayofweek(d) IN (0, 6) AS is_weekend, d::DATE = {NOW}::DATE AS is_today,
           d::DATE = {NOW}::DATE - 1 AS is_yesterday, d::DATE >= {NOW}::DATE - 7 AS is_last_7_days,
           d::DATE >= {NOW}::DATE - 30 AS is_last_30_days
    FROM range(TIMESTAMP '2023-01-01', TIMESTAMP '2029-01-01', INTERVAL 1 DAY) AS t(d)
"""
BLOCKS["all_bars"] = """
    SELECT base_asset AS symbol, event_hour, min(price) AS low, max(price) AS high, count(*) AS ticks_count,
           sum(price * volume_base) / nullif(sum(volume_base), 0) AS vwap, avg(spread) AS avg_spread,
           max(price) FILTER (event_time = t0) AS open, max(price) FILTER (event_time = t1) AS close,
           max(volume_base) FILTER (event_time = t1) AS volume_base_24h,
           max(volume_quote) FILTER (event_time = t1) AS volume_quote_24h,
           max(trades_count) FILTER (event_time = t1) AS trades_count_24h
    FROM (SELECT *, min(event_time) OVER h AS t0, max(event_time) OVER h AS t1 FROM s_ticks
          WINDOW h AS (PARTITION BY base_asset, event_hour))
    GROUP BY base_asset, event_hour
"""
BLOCKS["bars"] = f"""
    SELECT *, volume_base_24h - lag(volume_base_24h) OVER s AS hour_volume_base_delta,
           trades_count_24h - lag(trades_count_24h) OVER s AS hour_trades_delta,
           close / nullif(lag(close) OVER s, 0) - 1 AS hour_return
    FROM all_bars WHERE ticks_count >= {fx.MIN_TICKS}
    WINDOW s AS (PARTITION BY symbol ORDER BY event_hour)
"""
BLOCKS["prices"] = f"""
    SELECT {key("coin_key", "strftime(event_hour, '%Y%m%d%H')")} AS price_hour_key, coin_key, coin_id, b.*,
           {dkey("event_hour")} AS date_key
    FROM bars b LEFT JOIN (SELECT coin_key, coin_id, symbol FROM d_coin) c USING (symbol)
"""
BLOCKS["snaps"] = f"""
    SELECT {key("coin_key", "strftime(snapshot_hour, '%Y%m%d%H')")} AS market_snapshot_key, coin_key, s.*,
           {dkey("snapshot_hour")} AS date_key
    FROM (SELECT * FROM s_markets
          QUALIFY row_number() OVER (PARTITION BY coin_id, snapshot_hour ORDER BY ingested_at DESC) = 1) s
    LEFT JOIN (SELECT coin_id, coin_key FROM d_coin) c USING (coin_id)
"""
BLOCKS["closing"] = """
    SELECT * FROM snaps QUALIFY row_number() OVER (PARTITION BY coin_id, date_key ORDER BY snapshot_hour DESC) = 1
"""
BLOCKS["posts_daily"] = (
    f"""
    SELECT created_utc::DATE AS date_day, count(*) AS reddit_posts_count,
           count(DISTINCT author) AS reddit_unique_authors, sum(score)::BIGINT AS reddit_total_score,
           {dec("avg(score)", 2)} AS reddit_avg_score, {dec("avg(upvote_ratio)", 4)} AS reddit_avg_upvote_ratio,
           sum(num_comments)::BIGINT AS reddit_total_comments,
    """
    + ", ".join(f"count(*) FILTER ({m}) AS {m}" for m in MENTIONS)
    + " FROM s_posts GROUP BY 1"
)
BLOCKS["daily"] = (
    f"""
    SELECT {dkey("date_day")} AS date_key, date_day, i.value AS fng_value, i.category AS fng_category,
           i.sentiment_bucket AS fng_bucket, i.sentiment_score AS fng_score,
           coalesce(reddit_posts_count, 0) AS reddit_posts_count,
           coalesce(reddit_unique_authors, 0) AS reddit_unique_authors,
           coalesce(reddit_total_score, 0) AS reddit_total_score, reddit_avg_score, reddit_avg_upvote_ratio,
           coalesce(reddit_total_comments, 0) AS reddit_total_comments,
    """
    + ", ".join(f"coalesce({m}, 0) AS {m}" for m in MENTIONS)
    + """
    FROM (SELECT index_date::DATE AS date_day FROM s_index UNION SELECT date_day FROM posts_daily)
    LEFT JOIN (SELECT *, index_date::DATE AS date_day FROM s_index) i USING (date_day)
    LEFT JOIN posts_daily USING (date_day)
    """
)

# ---- marts ------------------------------------------------------------------------------------

BLOCKS["movers"] = """
    SELECT date_key, coin_key, coin_id, symbol, market_cap, market_cap_rank, current_price, price_change_pct_24h,
           volume_24h,
           (rank() OVER (PARTITION BY date_key ORDER BY price_change_pct_24h DESC))::INTEGER AS rank_gainer,
           (rank() OVER (PARTITION BY date_key ORDER BY price_change_pct_24h))::INTEGER AS rank_loser
    FROM (SELECT * FROM snaps WHERE market_cap_rank <= 200
          QUALIFY row_number() OVER (PARTITION BY coin_id, date_key ORDER BY snapshot_hour DESC) = 1)
    WHERE price_change_pct_24h IS NOT NULL
"""
BLOCKS["mentions"] = f"""
    SELECT date_key, date_day, fng_value, fng_bucket, fng_score, upper(replace(m, 'mentions_', '')) AS symbol,
           mentions_count
    FROM (UNPIVOT (SELECT date_key, date_day, fng_value, fng_bucket, fng_score, {", ".join(MENTIONS)} FROM daily)
          ON {", ".join(MENTIONS)} INTO NAME m VALUE mentions_count)
"""
BLOCKS["social"] = """
    SELECT m.*, c.coin_key, c.coin_id, c.current_price, c.price_change_pct_24h, c.market_cap, c.market_cap_rank,
           lead(c.price_change_pct_24h) OVER (PARTITION BY m.symbol ORDER BY m.date_key) AS lead_1d_return
    FROM mentions m LEFT JOIN closing c ON c.date_key = m.date_key AND c.symbol = m.symbol
"""

# ---- sentiment --------------------------------------------------------------------------------

_SPACES = f"'{R.SPACES}'"
_PUNCT = "'" + R.PUNCTUATION.replace("'", "''") + "'"
BLOCKS["lexicon"] = f"SELECT * FROM (VALUES {_values(fx.LEXICON.items())}) t(entry, valence)"
BLOCKS["boosters"] = f"SELECT * FROM (VALUES {_values(fx.BOOSTERS.items())}) t(booster, step)"
BLOCKS["texts"] = rf"""
    SELECT id, subreddit, created_utc, text, length(text) AS text_length,
           list_transform(list_filter(regexp_split_to_array(text, '[{R.SPACE_CLASS}]+'), lambda t: t <> ''),
                          lambda t: CASE WHEN length(trim(t, {_PUNCT})) > {R.KEEP_SHORT}
                                         THEN trim(t, {_PUNCT}) ELSE t END) AS ws,
           length(text) - length(replace(text, '!', '')) AS bangs,
           length(text) - length(replace(text, '?', '')) AS asks
    FROM (SELECT *, trim(title || chr(10) || chr(10) || selftext, {_SPACES}) AS text FROM fx_posts)
"""
BLOCKS["text_facts"] = f"""
    SELECT *, len(ws) AS n_words, shouted > 0 AND shouted < len(ws) AS mixed_case,
           list_position(list_transform(ws, lambda w: lower(w)), 'but') AS but_at,
           least(bangs, {R.MAX_EXCLAMATIONS}) * {R.EXCLAMATION}::DOUBLE
             + CASE WHEN asks <= 1 THEN 0 WHEN asks <= {R.MAX_QUESTIONS} THEN asks * {R.QUESTION}::DOUBLE
                    ELSE {R.MANY_QUESTIONS}::DOUBLE END AS emphasis
    FROM (SELECT *, len(list_filter(ws, lambda w: regexp_matches(w, '^[^\\p{{Ll}}]*\\p{{Lu}}[^\\p{{Ll}}]*$'))) AS shouted FROM texts)
"""
BLOCKS["tokens"] = """
    SELECT *, lag(w, 1) OVER o AS b1, lag(w, 2) OVER o AS b2, lag(w, 3) OVER o AS b3, lower(w) AS l0,
           coalesce(lower(lag(w, 1) OVER o), '') AS l1, coalesce(lower(lag(w, 2) OVER o), '') AS l2, coalesce(lower(lag(w, 3) OVER o), '') AS l3,
           coalesce(lower(lead(w, 1) OVER o), '') AS n1, coalesce(lower(lead(w, 2) OVER o), '') AS n2
    FROM (SELECT id, mixed_case, but_at, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM text_facts)
    WINDOW o AS (PARTITION BY id ORDER BY pos)
"""


def _shout(word: str) -> str:
    return f"CASE WHEN mixed_case AND regexp_matches({word}, '^[^\\p{{Ll}}]*\\p{{Lu}}[^\\p{{Ll}}]*$') THEN {R.CAPS_BOOST} ELSE 0 END"


_PH = fx.PHRASES
_BASE = f"""
    SELECT t.*, CASE WHEN l1 = '{_PH.no}' OR l2 = '{_PH.no}' OR (l3 = '{_PH.no}' AND l1 IN {_in(_PH.no_over)}) THEN valence * {R.NEGATION_FACTOR}::DOUBLE
                     WHEN l0 = '{_PH.no}' AND n1 IN (SELECT entry FROM lexicon) THEN 0 ELSE valence END::DOUBLE AS base
    FROM tokens t JOIN lexicon ON entry = l0
    WHERE l0 NOT IN (SELECT booster FROM boosters) AND NOT (l0 = '{_PH.kind[0]}' AND n1 = '{_PH.kind[1]}')
"""
_STEPS = [f"SELECT t.*, base + sign(base) * {_shout('w')}::DOUBLE AS v0 FROM ({_BASE}) t"]


def _negated(d: int) -> str:
    between = [f"l{i}" for i in range(1, d)]
    cases = [
        f"WHEN l{d} = '{word}' AND ({' OR '.join(f'{b} IN {_in(by)}' for b in between)}) THEN {factor}"
        for rules, factor in ((_PH.strengthens, R.NEVER_FACTOR), (_PH.idle, 1))
        for word, by in rules.items()
        if between
    ]
    return f"CASE {' '.join(cases)} WHEN l{d} IN {_in(fx.NEGATIONS)} OR contains(l{d}, 'n''t') THEN {R.NEGATION_FACTOR} ELSE 1 END::DOUBLE"


for _d, _damp in enumerate(R.BOOSTER_DAMPING, start=1):
    _push = f"coalesce((SELECT step FROM boosters WHERE booster = l{_d}) + {_shout(f'b{_d}')}, 0)::DOUBLE * {_damp}"
    _STEPS.append(f"SELECT *, (v{_d - 1} + sign(v{_d - 1}) * {_push}) * {_negated(_d)} AS v{_d} FROM token_v{_d - 1}")


def _phrase_value(phrase: str, values) -> str:
    return f"CASE {phrase} " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in values.items()) + " END"


# The later of two phrases counts first: those that reach on, then those that reach back, the nearest one first.
_REACH = ["l0 || ' ' || n1 || ' ' || n2", "l0 || ' ' || n1", "l1 || ' ' || l0", "l2 || ' ' || l1 || ' ' || l0", "l2 || ' ' || l1",
          "l3 || ' ' || l2 || ' ' || l1", "l3 || ' ' || l2"]
_IDIOM = "coalesce(" + ", ".join(_phrase_value(x, _PH.idioms) for x in _REACH) + ", v3)"
_MORE = " + ".join(f"coalesce({_phrase_value(x, _PH.boosters)}, 0)" for x in (_REACH[5], _REACH[6], _REACH[4]))
_STEPS.append(f"SELECT *, CASE WHEN l3 <> '' AND l3 NOT IN (SELECT entry FROM lexicon) THEN {_IDIOM} + {_MORE} ELSE v3 END AS v4 FROM token_v3")
_STEPS.append(f"SELECT *, v4 * CASE WHEN l1 = '{_PH.least}' AND l2 NOT IN {_in(_PH.least_after)} THEN {R.NEGATION_FACTOR} ELSE 1 END::DOUBLE AS v5 FROM token_v4")
for _i, _sql in enumerate(_STEPS):
    BLOCKS[f"token_v{_i}"] = _sql
BLOCKS["post_sums"] = f"""
    SELECT id, sum(v) AS total, sum(CASE WHEN v > 0 THEN v + 1 ELSE 0 END) AS up,
           sum(CASE WHEN v < 0 THEN 1 - v ELSE 0 END) AS down, count(*) FILTER (v <> 0) AS hits
    FROM (SELECT id, v5 * CASE WHEN coalesce(but_at, 0) = 0 OR pos = but_at THEN 1 WHEN pos < but_at
                               THEN {R.BEFORE_BUT} ELSE {R.AFTER_BUT} END AS v FROM token_v5)
    GROUP BY id
"""
BLOCKS["scored"] = f"""
    SELECT id AS post_id, subreddit, created_utc, compound,
           coalesce(round(up / nullif(mass, 0), 3), 0) AS pos, coalesce(round(plain / nullif(mass, 0), 3), 0) AS neu,
           coalesce(round(down / nullif(mass, 0), 3), 0) AS neg,
           CASE WHEN compound >= {R.POSITIVE_FROM} THEN 'positive' WHEN compound <= {R.NEGATIVE_TO} THEN 'negative'
                ELSE 'neutral' END AS sentiment_label,
           text_length::INTEGER AS text_length, 'lexicon-rules-2' AS model_version, {NOW} AS scored_at
    FROM (SELECT *, up + down + plain AS mass, round(total / sqrt(total * total + {R.NORM}), 4) AS compound
          FROM (SELECT id, subreddit, created_utc, text_length, (n_words - h)::DOUBLE AS plain,
                       t + sign(t) * emphasis AS total,
                       CASE WHEN u > d THEN u + emphasis ELSE u END AS up,
                       CASE WHEN d > u THEN d + emphasis ELSE d END AS down
                FROM (SELECT f.*, coalesce(total, 0) AS t, coalesce(up, 0) AS u, coalesce(down, 0) AS d,
                             coalesce(hits, 0) AS h
                      FROM text_facts f LEFT JOIN post_sums USING (id))))
"""
BLOCKS["share_daily"] = f"""
    SELECT created_utc::DATE AS date_day, count(*) AS posts_scored, {dec("avg(compound)", 4)} AS vader_compound_avg,
           {dec("avg((sentiment_label = 'positive')::INTEGER)", 4)} AS vader_pct_positive,
           {dec("avg((sentiment_label = 'negative')::INTEGER)", 4)} AS vader_pct_negative
    FROM scored GROUP BY 1
"""

# ---- anomalies --------------------------------------------------------------------------------

BLOCKS["history"] = f"""
    SELECT symbol, event_hour, close, hour_return, hour_volume_base_delta AS volume_base, avg_spread, ticks_count
    FROM prices WHERE event_hour >= {NOW} - INTERVAL 720 HOUR
"""
BLOCKS["zscores"] = """
    SELECT *, CASE WHEN count(hour_return) OVER w = 24
                   THEN (hour_return - avg(hour_return) OVER w) / nullif(stddev_samp(hour_return) OVER w, 0) END AS z
    FROM history WINDOW w AS (PARTITION BY symbol ORDER BY event_hour ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
"""
BLOCKS["flags"] = """
    SELECT * EXCLUDE (z), round(z, 4) AS return_zscore, coalesce(abs(z) >= 3, false) AS is_anomaly_zscore,
           3.0::DOUBLE AS zscore_threshold
    FROM zscores
"""
BLOCKS["forest_nodes"] = "SELECT * FROM (VALUES " + _values(fx.FOREST_NODES) + ") x(tree, node, feature, threshold, low, high, path)"
BLOCKS["forest_points"] = """
    SELECT symbol, event_hour, close, count(*) OVER s AS points, [
               coalesce(hour_return, median(hour_return) OVER s, 0), coalesce(volume_base, median(volume_base) OVER s, 0),
               coalesce(avg_spread, median(avg_spread) OVER s, 0)] AS x
    FROM history WINDOW s AS (PARTITION BY symbol)
"""
# The trees are two cuts deep at most: root, child, leaf.
BLOCKS["forest_paths"] = """
    SELECT p.symbol, p.event_hour, sum(c.path) AS total, count(*) AS trees
    FROM forest_points p
    JOIN forest_nodes a ON a.node = 0
    JOIN forest_nodes b ON b.tree = a.tree AND b.node = CASE WHEN p.x[a.feature + 1] <= a.threshold THEN a.low ELSE a.high END
    JOIN forest_nodes c ON c.tree = b.tree AND c.node = CASE WHEN p.x[b.feature + 1] <= b.threshold THEN b.low ELSE b.high END
    WHERE p.points >= 48 GROUP BY 1, 2
"""
_SAMPLED = fx.FOREST_SAMPLED
BLOCKS["forest_decisions"] = f"""
    SELECT symbol, event_hour, score - quantile_cont(score, 0.05) OVER (PARTITION BY symbol) AS decision
    FROM (SELECT symbol, event_hour,
                 -pow(2.0::DOUBLE, -total / (trees * (2 * (ln({_SAMPLED - 1}::DOUBLE) + 0.5772156649015329) - 2 * {_SAMPLED - 1}::DOUBLE / {_SAMPLED}))) AS score
          FROM forest_paths)
"""
BLOCKS["detections"] = f"""
    SELECT symbol, event_hour, close, hour_return, volume_base, return_zscore, is_anomaly_zscore, zscore_threshold,
           round(decision, 6) AS iforest_score, coalesce(decision < 0, false) AS is_anomaly_iforest,
           is_anomaly_zscore AND coalesce(decision < 0, false) AS is_anomaly_consensus,
           'iforest-v1+zscore-w24' AS model_version, {NOW} AS detected_at
    FROM flags LEFT JOIN forest_decisions USING (symbol, event_hour)
"""
BLOCKS["alerts"] = (
    f"""
    SELECT a.symbol, a.event_hour, {dkey("a.event_hour")} AS date_key, p.coin_key, p.coin_id, p.open, p.high, p.low,
           p.close, p.vwap, p.hour_return, p.hour_volume_base_delta, p.avg_spread, p.ticks_count, a.return_zscore,
           a.zscore_threshold, a.is_anomaly_zscore, a.iforest_score, a.is_anomaly_iforest, a.is_anomaly_consensus,
           abs(coalesce(a.return_zscore, 0)) AS severity_score, m.market_cap, m.market_cap_rank,
           m.price_change_pct_24h, s.fng_value, s.fng_bucket,
           CASE a.symbol """
    + " ".join(f"WHEN '{s}' THEN s.mentions_{s.lower()}" for s in fx.TERMS)
    + f""" ELSE 0 END AS reddit_mentions_day,
           v.posts_scored AS reddit_scored_count, v.vader_compound_avg, v.vader_pct_positive, v.vader_pct_negative,
           a.model_version AS anomaly_model_version, a.detected_at
    FROM detections a
    LEFT JOIN prices p ON p.symbol = a.symbol AND p.event_hour = a.event_hour
    LEFT JOIN closing m ON m.symbol = a.symbol AND m.date_key = {dkey("a.event_hour")}
    LEFT JOIN daily s ON s.date_day = a.event_hour::DATE
    LEFT JOIN share_daily v ON v.date_day = a.event_hour::DATE
    WHERE a.is_anomaly_zscore OR a.is_anomaly_iforest
    """
)

# ---- reporting --------------------------------------------------------------------------------

BLOCKS["v_price"] = f"""
    SELECT event_hour AS ts_hour, date_key, p.symbol, coalesce(c.coin_name, p.symbol) AS coin_name, c.image_url,
           {dec("open", 8)} AS price_open, {dec("high", 8)} AS price_high, {dec("low", 8)} AS price_low,
           {dec("close", 8)} AS price_close, {dec("vwap", 8)} AS price_vwap, {dec("hour_return", 4)} AS hour_return_pct,
           ticks_count, {dec("avg_spread", 6)} AS avg_spread
    FROM prices p LEFT JOIN d_coin c USING (coin_key)
"""
BLOCKS["v_alerts"] = f"""
    SELECT event_hour AS ts_hour, date_key, a.symbol, coalesce(c.coin_name, a.coin_id, a.symbol) AS coin_name,
           c.image_url, {dec("close", 8)} AS price_close, {dec("hour_return", 4)} AS hour_return_pct, return_zscore,
           is_anomaly_zscore, is_anomaly_iforest, is_anomaly_consensus,
           CASE WHEN is_anomaly_consensus THEN 'Consensus' WHEN is_anomaly_iforest THEN 'IForest'
                WHEN is_anomaly_zscore THEN 'Z-score' ELSE 'Unknown' END AS detector_label,
           {dec("severity_score", 4)} AS severity,
           CASE WHEN severity_score < 1 THEN 'Low' WHEN severity_score < 3 THEN 'Medium'
                WHEN severity_score < 5 THEN 'High' ELSE 'Critical' END AS severity_bucket,
           market_cap_rank, fng_value, fng_bucket, reddit_mentions_day, vader_compound_avg, anomaly_model_version,
           detected_at
    FROM alerts a LEFT JOIN d_coin c USING (coin_id)
"""
BLOCKS["v_sentiment"] = """
    SELECT date_day, fng_value, fng_bucket, fng_score, reddit_posts_count, reddit_avg_upvote_ratio,
           reddit_total_score, posts_scored AS vader_posts_count, vader_compound_avg, vader_pct_positive,
           vader_pct_negative
    FROM daily LEFT JOIN share_daily USING (date_day)
"""
BLOCKS["v_market"] = f"""
    SELECT coin_id, s.symbol, coalesce(c.coin_name, s.symbol) AS coin_name, c.image_url,
           {dec("current_price", 8)} AS price, market_cap, market_cap_rank, volume_24h, high_24h, low_24h,
           {dec("price_change_pct_24h", 4)} AS change_24h_pct, {dec("price_change_pct_7d", 4)} AS change_7d_pct,
           {dec("price_change_pct_1h", 4)} AS change_1h_pct, snapshot_hour AS as_of
    FROM (SELECT * EXCLUDE (coin_name, image_url) FROM snaps
          QUALIFY snapshot_hour = max(snapshot_hour) OVER (PARTITION BY coin_id)) s
    LEFT JOIN d_coin c USING (coin_id)
"""
BLOCKS["v_kpi"] = f"""
    SELECT (SELECT count(DISTINCT symbol) FROM fx_ticks WHERE event_time >= {NOW} - INTERVAL 1 DAY)
             AS symbols_with_ticks_24h,
           t AS last_tick_at, round(epoch_us({NOW} - t) / 6e7, 2) AS minutes_since_last_tick,
           (SELECT count(*) FROM alerts WHERE event_hour >= {NOW} - INTERVAL 1 DAY) AS anomaly_events_24h,
           (SELECT count(*) FROM alerts WHERE is_anomaly_consensus AND event_hour >= {NOW} - INTERVAL 1 DAY)
             AS anomaly_events_consensus_24h,
           (SELECT max(severity_score) FROM alerts WHERE event_hour >= {NOW} - INTERVAL 1 DAY) AS max_severity_24h,
           (SELECT arg_max(fng_value, date_day) FROM daily WHERE fng_value IS NOT NULL) AS fng_value,
           (SELECT arg_max(fng_bucket, date_day) FROM daily WHERE fng_value IS NOT NULL) AS fng_bucket,
           (SELECT max(date_day) FROM daily WHERE fng_value IS NOT NULL) AS fng_as_of,
           (SELECT {dec("avg(compound)", 4)} FROM scored WHERE created_utc >= {NOW} - INTERVAL 1 DAY)
             AS vader_compound_avg_24h,
           (SELECT count(*) FROM scored WHERE created_utc >= {NOW} - INTERVAL 1 DAY) AS reddit_posts_scored_24h,
           (SELECT round(sum(market_cap), 2) FROM v_market) AS total_market_cap_tracked,
           {NOW} AS refreshed_at
    FROM (SELECT max(event_time) FILTER (event_time >= {NOW} - INTERVAL 1 DAY) AS t FROM fx_ticks)
"""
BLOCKS["pending"] = f"""
    SELECT symbol || '|' || strftime(ts_hour, '%Y%m%d%H%M') AS alert_key, symbol, coin_name, ts_hour AS event_hour,
           price_close, hour_return_pct, return_zscore, severity, severity_bucket, detector_label, fng_value,
           fng_bucket, reddit_mentions_day, vader_compound_avg
    FROM v_alerts
    WHERE is_anomaly_consensus AND severity >= 3 AND severity < 4 AND ts_hour >= {NOW} - INTERVAL 720 HOUR
"""

# ---- one statement per registered query -------------------------------------------------------


def cols(names: str, rounded: str = "") -> str:
    """Column list; names in ``rounded`` are rounded for comparison."""
    chosen = set(rounded.split())
    return ", ".join(f"{r(n)} AS {n}" if n in chosen else n for n in names.split())


BAR = "symbol event_hour low high ticks_count vwap avg_spread open close volume_base_24h volume_quote_24h trades_count_24h"
BAR_ROUNDED = "low high vwap avg_spread open close volume_base_24h volume_quote_24h"
DELTA = "hour_volume_base_delta hour_trades_delta hour_return"
SNAP = """current_price market_cap market_cap_rank fdv volume_24h high_24h low_24h price_change_24h price_change_pct_1h
    price_change_pct_24h price_change_pct_7d market_cap_change_24h market_cap_change_pct_24h circulating_supply
    total_supply max_supply ath ath_change_pct ath_date atl atl_change_pct atl_date"""
SNAP_ROUNDED = " ".join(c for c in SNAP.split() if c not in ("market_cap_rank", "ath_date", "atl_date"))
DAILY = """date_key date_day fng_value fng_category fng_bucket fng_score reddit_posts_count reddit_unique_authors
    reddit_total_score reddit_avg_score reddit_avg_upvote_ratio reddit_total_comments """ + " ".join(MENTIONS)
ALERT = """symbol event_hour date_key coin_key coin_id open high low close vwap hour_return hour_volume_base_delta
    avg_spread ticks_count return_zscore zscore_threshold is_anomaly_zscore iforest_score is_anomaly_iforest
    is_anomaly_consensus severity_score market_cap market_cap_rank price_change_pct_24h fng_value fng_bucket
    reddit_mentions_day reddit_scored_count vader_compound_avg vader_pct_positive vader_pct_negative
    anomaly_model_version detected_at"""
ALERT_ROUNDED = """open high low close vwap hour_return hour_volume_base_delta avg_spread return_zscore iforest_score
    severity_score market_cap price_change_pct_24h"""

Q: dict[str, str] = {}

Q["stg_ticks"] = "SELECT " + cols(
    "symbol base_asset quote_asset event_time event_minute event_hour event_date price price_change_pct volume_base "
    "volume_quote trades_count bid ask ingested_at spread spread_pct",
    "price price_change_pct volume_base volume_quote bid ask spread spread_pct",
) + " FROM s_ticks"
Q["stg_markets"] = "SELECT " + cols(
    f"coin_id symbol coin_name image_url {SNAP} last_updated ingested_at snapshot_hour snapshot_date", SNAP_ROUNDED
) + " FROM s_markets"
Q["stg_index"] = "SELECT * FROM s_index"
Q["stg_posts"] = "SELECT * REPLACE (text_length::INTEGER AS text_length) FROM s_posts"
Q["stg_sentiment"] = """
    SELECT post_id, subreddit, created_utc, created_utc::DATE AS created_date,
           date_trunc('hour', created_utc) AS created_hour, compound, pos, neu, neg, sentiment_label,
           ((sentiment_label = 'positive')::INTEGER - (sentiment_label = 'negative')::INTEGER)::INTEGER
             AS sentiment_score,
           text_length, model_version, scored_at
    FROM scored
"""
Q["stg_anomalies"] = f"""
    SELECT {cols("symbol event_hour close hour_return volume_base return_zscore is_anomaly_zscore zscore_threshold "
                 "iforest_score is_anomaly_iforest is_anomaly_consensus model_version detected_at",
                 "close hour_return volume_base")},
           event_hour::DATE AS event_date, {dkey("event_hour")} AS date_key,
           is_anomaly_zscore OR is_anomaly_iforest AS is_anomaly_any
    FROM detections
"""
Q["dim_coin"] = "SELECT * FROM d_coin"
Q["dim_date"] = f"""
    SELECT d_date.*, bars FROM d_date
    LEFT JOIN (SELECT {dkey("event_hour")} AS date_key, count(*) AS bars FROM bars GROUP BY 1) USING (date_key)
"""
Q["report_calendar"] = f"""
    SELECT ts_hour::DATE AS date, year(ts_hour)::INTEGER AS year, month(ts_hour)::INTEGER AS month,
           day(ts_hour)::INTEGER AS day, dayname(ts_hour) AS weekday, strftime(ts_hour, '%Y-%m') AS year_month,
           count(*) AS bars, max(price_high) AS high
    FROM v_price WHERE ts_hour::DATE >= DATE '2024-01-05' AND ts_hour::DATE < {NOW}::DATE + 30
    GROUP BY ALL
"""
Q["hourly_bars"] = f"SELECT {cols(BAR, BAR_ROUNDED)} FROM bars"
Q["hourly_bars_default_gate"] = f"SELECT {cols(BAR, BAR_ROUNDED)} FROM all_bars WHERE ticks_count >= 10"
Q["bar_deltas"] = f"SELECT {cols('symbol event_hour close ' + DELTA, 'close hour_volume_base_delta hour_return')} FROM bars"
Q["hourly_bars_keyed"] = (
    f"SELECT {cols(f'price_hour_key coin_key coin_id date_key {BAR} {DELTA}', BAR_ROUNDED + ' hour_volume_base_delta hour_return')} FROM prices"
)
Q["market_snapshot_hourly"] = (
    f"SELECT {cols(f'market_snapshot_key coin_key coin_id symbol snapshot_hour date_key {SNAP}', SNAP_ROUNDED)} FROM snaps"
)
Q["sentiment_daily"] = f"SELECT {cols(DAILY)} FROM daily"
Q["top_movers_daily"] = f"""
    SELECT {cols("date_key coin_key coin_id symbol market_cap market_cap_rank current_price price_change_pct_24h "
                 "volume_24h rank_gainer rank_loser", "market_cap current_price price_change_pct_24h volume_24h")},
           rank_gainer <= 10 AS is_top10_gainer, rank_loser <= 10 AS is_top10_loser
    FROM movers
"""
Q["social_vs_price"] = "SELECT " + cols(
    "date_key date_day coin_key coin_id symbol mentions_count current_price price_change_pct_24h lead_1d_return "
    "market_cap market_cap_rank fng_value fng_bucket fng_score",
    "current_price price_change_pct_24h lead_1d_return market_cap",
) + " FROM social"
Q["anomaly_alerts"] = f"SELECT {cols(ALERT, ALERT_ROUNDED)} FROM alerts"
Q["mentions_long"] = "SELECT * FROM mentions"
Q["mention_totals"] = (
    "SELECT count(*) AS posts, " + ", ".join(f"count(*) FILTER ({m}) AS {m}" for m in MENTIONS) + " FROM s_posts"
)

Q["price_history"] = "SELECT " + cols(
    "symbol event_hour close hour_return volume_base avg_spread ticks_count", "close hour_return volume_base avg_spread"
) + " FROM history"
Q["rolling_zscore"] = f"SELECT symbol, event_hour, {r('z')} AS z FROM zscores"
Q["zscore_flags"] = "SELECT " + cols(
    "symbol event_hour close hour_return volume_base avg_spread ticks_count return_zscore is_anomaly_zscore "
    "zscore_threshold",
    "close hour_return volume_base avg_spread",
) + " FROM flags"
Q["feature_median_impute"] = (
    "SELECT symbol, event_hour, "
    + ", ".join(
        f"{r(f'coalesce({n}, median({n}) OVER (PARTITION BY symbol), 0)')} AS x_{n}"
        for n in ("hour_return", "volume_base", "avg_spread")
    )
    + ", count(*) OVER (PARTITION BY symbol) AS points FROM history"
)
# A row is flagged below the exact 5 % quantile of its symbol's scores, so the number of flags needs no forest.
Q["forest_flag_counts"] = """
    SELECT symbol, n AS points, CASE WHEN n >= 48 THEN n ELSE 0 END AS scored,
           CASE WHEN n >= 48 THEN ceil((n - 1) * 0.05::DOUBLE)::BIGINT ELSE 0 END AS flagged
    FROM (SELECT symbol, count(*) AS n FROM history GROUP BY 1)
"""
Q["forest_scores_given_trees"] = "SELECT " + cols(
    "symbol event_hour close hour_return volume_base return_zscore is_anomaly_zscore zscore_threshold iforest_score "
    "is_anomaly_iforest is_anomaly_consensus model_version detected_at",
    "close hour_return volume_base iforest_score",
) + " FROM detections"
Q["detection_summary"] = """
    SELECT count(*) AS total, count(*) FILTER (is_anomaly_zscore) AS anom_zscore,
           count(*) FILTER (is_anomaly_iforest) AS anom_iforest,
           count(*) FILTER (is_anomaly_consensus) AS anom_consensus, count(DISTINCT symbol) AS symbols
    FROM detections
"""
Q["lexicon_sentiment"] = "SELECT * FROM scored"
Q["sentiment_label_summary"] = f"""
    SELECT sentiment_label, count(*) AS posts, {r("avg(compound)")} AS mean_compound FROM scored GROUP BY 1
"""
Q["sentiment_daily_share"] = "SELECT * FROM share_daily"
Q["unscored_posts"] = f"""
    SELECT id, subreddit, created_utc, md5(title) AS title, md5(selftext) AS body
    FROM fx_posts WHERE created_utc >= {NOW} - INTERVAL 20 DAY
      AND id NOT IN (SELECT post_id FROM scored WHERE sentiment_label = 'positive')
"""

Q["kpi_latest"] = "SELECT * FROM v_kpi"
Q["price_hourly_view"] = f"SELECT * REPLACE ({r('price_open')} AS price_open, {r('price_high')} AS price_high, {r('price_low')} AS price_low, {r('price_close')} AS price_close, {r('price_vwap')} AS price_vwap) FROM v_price"
Q["anomaly_view"] = f"SELECT * REPLACE ({r('price_close')} AS price_close) FROM v_alerts"
Q["sentiment_view"] = "SELECT * FROM v_sentiment"
Q["sentiment_shares_long"] = """
    UNPIVOT (SELECT date_day, vader_posts_count, vader_pct_positive AS positive,
                    round(1 - vader_pct_positive - vader_pct_negative, 4) AS neutral, vader_pct_negative AS negative
             FROM v_sentiment WHERE vader_posts_count IS NOT NULL)
    ON positive, neutral, negative INTO NAME sentiment_label VALUE share
"""
_MARKET = f"""coin_id, symbol, coin_name, image_url, {r("price")} AS price, {r("market_cap")} AS market_cap,
    volume_24h_r AS volume_24h, {r("high_24h")} AS high_24h, {r("low_24h")} AS low_24h, change_24h_pct, change_7d_pct,
    change_1h_pct, as_of""".replace("volume_24h_r", r("volume_24h"))
Q["market_latest_view"] = f"SELECT {_MARKET}, market_cap_rank FROM v_market"
Q["import_market"] = f"SELECT {_MARKET}, market_cap_rank::BIGINT AS market_cap_rank FROM v_market"
Q["import_price_hourly"] = Q["price_hourly_view"] + f" WHERE ts_hour >= {NOW} - INTERVAL 14 DAY"
Q["view_row_counts"] = " UNION ALL ".join(
    f"SELECT '{name}' AS view, count(*) AS rows FROM {block}"
    for name, block in {
        "kpi_latest": "v_kpi",
        "price_hourly": "v_price",
        "anomaly_view": "v_alerts",
        "sentiment_view": "v_sentiment",
        "market_latest": "v_market",
    }.items()
)

Q["measure_kpi_cards"] = """
    SELECT minutes_since_last_tick,
           CASE WHEN minutes_since_last_tick IS NULL THEN 'NO DATA' WHEN minutes_since_last_tick >= 15 THEN 'STALE'
                WHEN minutes_since_last_tick >= 5 THEN 'DEGRADED' ELSE 'HEALTHY' END AS stream_health_label,
           CASE WHEN minutes_since_last_tick IS NULL THEN '#6B7280' WHEN minutes_since_last_tick >= 15 THEN '#DC2626'
                WHEN minutes_since_last_tick >= 5 THEN '#F59E0B' ELSE '#16A34A' END AS stream_health_color,
           symbols_with_ticks_24h AS symbols_active_24h, anomaly_events_24h AS anomalies_24h,
           anomaly_events_consensus_24h AS anomalies_consensus_24h,
           coalesce(max_severity_24h, 0)::DOUBLE AS max_severity_24h,
           CASE WHEN coalesce(max_severity_24h, 0) < 1 THEN 'LOW' WHEN max_severity_24h < 3 THEN 'MEDIUM'
                WHEN max_severity_24h < 5 THEN 'HIGH' ELSE 'CRITICAL' END AS max_severity_label,
           fng_value AS fear_greed_latest, coalesce(fng_bucket, 'Unknown') AS fear_greed_label,
           coalesce(vader_compound_avg_24h, 0)::DOUBLE AS vader_compound_24h,
           reddit_posts_scored_24h AS reddit_posts_24h, coalesce(total_market_cap_tracked, 0) AS total_market_cap,
           CASE WHEN total_market_cap_tracked >= 1e12 THEN format('${:.2f}T', total_market_cap_tracked / 1e12)
                WHEN total_market_cap_tracked >= 1e9 THEN format('${:.2f}B', total_market_cap_tracked / 1e9)
                WHEN total_market_cap_tracked >= 1e6 THEN format('${:.2f}M', total_market_cap_tracked / 1e6)
                ELSE format('${:,}', round(coalesce(total_market_cap_tracked, 0))::BIGINT) END
             AS total_market_cap_formatted,
           refreshed_at, 'Ultima actualizacion: ' || strftime(refreshed_at, '%Y-%m-%d %H:%M') AS refreshed_at_label
    FROM v_kpi
"""


def _price_measures(by: str) -> str:
    lead = f"{by}, " if by else ""
    join = f"JOIN hours USING ({by})" if by else ", hours"
    return f"""
    WITH_HOURS hour_max AS (SELECT {lead}ts_hour, max(price_close) AS p, max(hour_return_pct) AS m FROM v_price
                            GROUP BY {lead}ts_hour),
    hours AS (SELECT {lead}arg_max(p, ts_hour) FILTER (p IS NOT NULL) AS price_close_latest,
                     arg_max(m, ts_hour) FILTER (m IS NOT NULL) AS last_return_pct,
                     (product(1 + coalesce(m, 0) / 100) - 1) * 100 AS cumulative_return_pct
              FROM hour_max {f"GROUP BY {by}" if by else ""}),
    row_level AS (SELECT {lead}stddev_pop(hour_return_pct) AS volatility_return_pct,
                         sum(price_vwap * ticks_count) / nullif(sum(ticks_count), 0) AS avg_vwap,
                         sum(ticks_count)::BIGINT AS total_ticks
                  FROM v_price {f"GROUP BY {by}" if by else ""})
    SELECT {lead}{cols("price_close_latest last_return_pct cumulative_return_pct volatility_return_pct avg_vwap total_ticks",
                       "price_close_latest last_return_pct cumulative_return_pct volatility_return_pct avg_vwap")}
    FROM row_level {join}
    """


Q["measure_prices"] = _price_measures("")
Q["measure_prices_by_symbol"] = _price_measures("symbol")
Q["measure_price_normalized"] = f"""
    SELECT coin_name, ts_hour, {r("100 * (max(price_close) / nullif(min(min(price_close)) OVER (PARTITION BY coin_name), 0))")}
             AS price_normalized
    FROM v_price GROUP BY coin_name, ts_hour
"""
_ALERT_COUNTS = f"""count(*) AS alerts_count, count(*) FILTER (detector_label = 'Consensus') AS alerts_consensus,
    count(*) FILTER (detector_label = 'Z-score') AS alerts_zscore_only,
    count(*) FILTER (detector_label = 'IForest') AS alerts_iforest_only, {r("avg(severity)")} AS avg_severity,
    count(*) FILTER (severity >= 5) AS critical_alerts FROM v_alerts"""
Q["measure_alert_counts"] = f"SELECT {_ALERT_COUNTS}"
Q["measure_alert_counts_by_symbol"] = f"SELECT symbol, {_ALERT_COUNTS} GROUP BY symbol"
Q["measure_sentiment"] = f"""
    SELECT {r("avg(vader_compound_avg)")} AS avg_vader_compound, sum(reddit_posts_count)::BIGINT AS total_reddit_posts,
           {r("avg(vader_pct_positive) * 100")} AS pct_positive_posts,
           {r("avg(vader_pct_negative) * 100")} AS pct_negative_posts, {r("avg(fng_value)")} AS avg_fear_greed
    FROM v_sentiment
"""
Q["measure_market"] = f"""
    SELECT {r("sum(market_cap)")} AS marketcap_filtered,
           {r("sum(market_cap * change_24h_pct) / nullif(sum(market_cap), 0)")} AS weighted_change_24h,
           count(*) FILTER (change_24h_pct > 0) AS coins_up_24h, count(*) FILTER (change_24h_pct < 0) AS coins_down_24h,
           (SELECT coin_name FROM v_market WHERE change_24h_pct IS NOT NULL
            ORDER BY change_24h_pct DESC, coin_name LIMIT 1) AS best_performer_24h,
           (SELECT coin_name FROM v_market WHERE change_24h_pct IS NOT NULL
            ORDER BY change_24h_pct, coin_name LIMIT 1) AS worst_performer_24h
    FROM v_market
"""
Q["measure_market_share"] = f"""
    SELECT coin_name, {r("market_cap")} AS market_cap, {r("market_cap / nullif(sum(market_cap) OVER (), 0)")} AS share
    FROM v_market
"""
Q["top_changes"] = f"""
    SELECT coin_name, {r("price")} AS price, change_24h_pct, change_7d_pct FROM v_market
    ORDER BY v_market.change_24h_pct DESC NULLS LAST, coin_name LIMIT 10
"""

Q["ticks_per_symbol"] = "SELECT symbol, count(*) AS ticks, max(event_time) AS last_seen FROM fx_ticks GROUP BY 1"
Q["symbol_health"] = f"""
    SELECT CASE WHEN m >= 15 THEN '🔴' WHEN m >= 5 THEN '🟡' ELSE '🟢' END AS status, symbol, ticks_total, last_tick_at,
           round(m, 2) AS minutes_since_last
    FROM (SELECT *, epoch_us({NOW} - last_tick_at) / 6e7 AS m
          FROM (SELECT symbol, count(*) AS ticks_total, max(event_time) AS last_tick_at FROM fx_ticks GROUP BY 1))
"""
Q["tick_tail"] = f"""
    SELECT {cols("symbol event_time price volume_base bid ask", "price volume_base bid ask")}
    FROM fx_ticks ORDER BY event_time DESC, symbol LIMIT 50
"""
Q["tick_freshness"] = f"""
    SELECT t AS last_tick, {r(f"epoch_us({NOW} - t) / 6e7")} AS minutes_since_last,
           CASE WHEN t IS NULL THEN 'empty' WHEN epoch_us({NOW} - t) > 6e8 THEN 'stale' ELSE 'ok' END AS status
    FROM (SELECT max(event_time) AS t FROM fx_ticks)
"""
Q["price_context"] = f"""
    SELECT symbol, ts_hour, {r("price_close")} AS price_close FROM v_price
    WHERE symbol = 'ERROR' AND ts_hour >= {NOW} - INTERVAL 48 HOUR
"""
Q["pending_alerts"] = f"SELECT * REPLACE ({r('price_close')} AS price_close) FROM pending"


def _fixed(expr: str, digits: int) -> str:
    return f"coalesce(({expr})::DECIMAL(28,{digits})::VARCHAR, 'n/a')"


Q["alert_text"] = f"""
    SELECT alert_key,
        '<b>' || CASE WHEN coalesce(hour_return_pct, 0) < 0 THEN '📉' ELSE '📈' END || ' Anomaly · ' || symbol || '</b>' || chr(10)
        || '<i>' || coalesce(coin_name, symbol) || '</i> · <b>' || coalesce(severity_bucket, '?') || '</b> (sev '
        || {_fixed("severity", 4)} || ')' || chr(10) || chr(10)
        || '• Hora: <code>' || strftime(event_hour, '%Y-%m-%d %H:%M:%S') || '+00:00</code>' || chr(10)
        || '• Precio close: <code>' || {_fixed("price_close", 8)} || '</code>' || chr(10)
        || '• Retorno hora: <code>' || coalesce((hour_return_pct)::DECIMAL(28,4)::VARCHAR || ' %', 'n/a') || '</code>' || chr(10)
        || '• Z-score: <code>' || {_fixed("return_zscore", 4)} || '</code>' || chr(10)
        || '• Detector: <code>' || coalesce(detector_label, 'n/a') || '</code>' || chr(10)
        || '• Fear &amp; Greed: <code>' || coalesce(fng_value::VARCHAR, 'n/a') || ' (' || coalesce(fng_bucket, 'n/a')
        || ')</code>' || chr(10)
        || '• Reddit mentions: <code>' || coalesce(reddit_mentions_day::VARCHAR, 'n/a') || '</code>' || chr(10)
        || '• VADER avg: <code>' || {_fixed("vader_compound_avg", 4)} || '</code>' || chr(10) AS message
    FROM pending
"""
Q["explainer_alerts"] = f"""
    SELECT ts_hour, symbol, coin_name, {dec("price_close", 4)} AS price_close, {dec("hour_return_pct", 3)} AS hour_return_pct,
           {dec("return_zscore", 3)} AS return_zscore, {dec("severity", 2)} AS severity, severity_bucket, detector_label,
           fng_bucket,
           symbol || ' · ' || strftime(ts_hour, '%Y-%m-%d %H:%M') || ' · z=' || coalesce(format('{{:.2f}}', return_zscore), 'n/a')
             || ' · sev=' || coalesce(format('{{:.2f}}', severity), 'n/a') AS label
    FROM (SELECT * FROM v_alerts ORDER BY ts_hour DESC, severity DESC NULLS LAST, symbol LIMIT 200)
    WHERE coalesce(severity, 0) >= 1
"""
Q["alert_ledger"] = f"""
    SELECT symbol || '|' || strftime(ts_hour, '%Y%m%d%H%M') AS alert_key, symbol, ts_hour AS event_hour, severity,
           {NOW} AS sent_at, true AS response_ok
    FROM v_alerts WHERE severity >= 4
    UNION ALL
    SELECT alert_key, symbol, event_hour, severity, {NOW}, fng_value < 50 FROM pending
"""

_POST = "id, subreddit, title, author, score, upvote_ratio, num_comments, created_utc"
_NEW_POSTS = f"SELECT 'new-' || {_POST} FROM fx_posts WHERE lang = 'de'"
Q["upsert_update"] = f"""
    SELECT id, subreddit, title, author, score + CASE WHEN lang = 'en' THEN 10 ELSE 0 END AS score, upvote_ratio,
           num_comments * CASE WHEN lang = 'en' THEN 2 ELSE 1 END AS num_comments, created_utc
    FROM fx_posts UNION ALL {_NEW_POSTS}
"""
Q["upsert_ignore"] = f"SELECT {_POST} FROM fx_posts UNION ALL {_NEW_POSTS}"
Q["upsert_append"] = f"""
    SELECT {_POST} FROM fx_posts UNION ALL {_NEW_POSTS} UNION ALL
    SELECT id, subreddit, 'changed', author, score + 10, upvote_ratio, num_comments * 2, created_utc
    FROM fx_posts WHERE lang = 'en'
"""
Q["warehouse_upsert"] = Q["upsert_update"]
Q["bronze_roundtrip"] = """
    SELECT strftime(index_date, '%Y-%m-%d') AS dt, strftime(index_date, '%H') AS hh, index_date,
           (value + CASE WHEN value >= 50 THEN 1000 ELSE 0 END)::INTEGER AS value, category
    FROM fx_index
    QUALIFY value >= 50 OR max(value) OVER (PARTITION BY date_trunc('hour', index_date)) < 50
"""
Q["landed_markets"] = f"""
    SELECT coin_id AS id, CASE WHEN coin_id LIKE '%-0' THEN split_part(coin_id, '-', 1) ELSE coin_id END AS symbol,
           {r("current_price")} AS current_price,
           CASE WHEN market_cap_rank IS NOT NULL THEN date_trunc('millisecond', last_updated) END AS last_updated,
           date_trunc('millisecond', last_updated) AS ath_date, NULL::TIMESTAMP AS atl_date, {NOW} AS ingested_at
    FROM fx_markets
"""
Q["landed_index"] = """
    SELECT date_trunc('second', index_date) AS index_date, value, category, '0' AS time_until_update, 'fng' AS _source FROM fx_index
"""
Q["landed_posts"] = f"""
    SELECT id, subreddit, md5(selftext) AS body, greatest(score, 0) AS score,
           coalesce(over_18, false) AS over_18, 'https://reddit.com' || permalink AS permalink, created_utc
    FROM fx_posts WHERE num_comments > 0
"""
Q["tracked_coins"] = """
    SELECT symbol AS pair, lower(replace(symbol, 'USDT', '')) || '-0' AS coin_id, count(*) AS ticks
    FROM fx_ticks WHERE symbol IN ('ERRORUSDT', 'CLICKUSDT', 'VIEWUSDT') GROUP BY symbol
"""
Q["ticker_json_roundtrip"] = f"""
    SELECT symbol, epoch_us(event_time) // 1000 AS event_time, {r("price")} AS price, {r("price_change_pct")} AS price_change_pct,
           volume_base, trades_count, {r("ask")} AS ask, 1.5::DOUBLE AS low
    FROM fx_ticks
"""
Q["dead_letters"] = """
    SELECT CASE k WHEN 0 THEN 'invalid_json' WHEN 1 THEN 'missing_field' ELSE 'bad_value' END AS reason,
           count(*) AS messages
    FROM fx_events WHERE k <= 2 GROUP BY 1
"""
Q["stream_dead_letters"] = Q["dead_letters"]
Q["stream_ticks_available_now"] = f"""
    SELECT symbol, date_trunc('millisecond', event_time) AS event_time,
           {", ".join(f"{r(f'round({c}, 8)')} AS {c}" for c in ("price", "volume_base", "volume_quote", "bid", "ask"))},
           {r("round(price_change_pct, 4)")} AS price_change_pct, trades_count, {NOW} AS ingested_at
    FROM fx_ticks WHERE volume_base > 2
"""
Q["latest_per_key"] = """
    SELECT user_id, event_id, ts, round(value, 6) AS value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""

# ---- quality: the expected verdict of every check, counted independently ----------------------


def _percent(bad: str) -> str:
    return f"{r(f'coalesce({bad} * 100.0::DOUBLE / nullif(count(*), 0), 0)')} AS unexpected_percent"


def _head(suite: str, kind: str, target: str) -> str:
    return f"'{suite}' AS suite, '{kind}' AS \"check\", '{target}' AS target"


def _check(suite: str, kind: str, target: str, table: str, bad: str, null_of: str = "") -> str:
    """Row-level check: rows where ``bad`` holds."""
    nulls = null_of or target.split(",")[0]
    return (
        f"SELECT {_head(suite, kind, target)}, count(*) FILTER ({bad}) = 0 AS success, "
        f"count(*) AS element_count, count(*) FILTER ({nulls} IS NULL) AS missing_count, "
        f"count(*) FILTER ({bad}) AS unexpected_count, {_percent(f'count(*) FILTER ({bad})')} FROM {table}"
    )


def _unique(suite: str, target: str, table: str) -> str:
    columns = target.split(",")
    full = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    inner = f"SELECT *, count(*) OVER (PARTITION BY {target}) AS copies FROM {table}"
    return (
        f"SELECT {_head(suite, 'unique', target)}, count(*) FILTER ({full} AND copies > 1) = 0 AS success, "
        f"count(*) AS element_count, count(*) FILTER (NOT ({full})) AS missing_count, "
        f"count(*) FILTER ({full} AND copies > 1) AS unexpected_count, {_percent(f'count(*) FILTER ({full} AND copies > 1)')} FROM ({inner})"
    )


def _fk(suite: str, column: str, table: str, parent: str, parent_key: str) -> str:
    bad = f"{column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} WHERE {parent_key} = c.{column})"
    inner = f"SELECT {column}, {bad} AS bad FROM {table} c"
    return (
        f"SELECT '{suite}', 'relationship', '{column}', count(*) FILTER (bad) = 0, count(*), "
        f"count(*) FILTER ({column} IS NULL), count(*) FILTER (bad), {_percent('count(*) FILTER (bad)')} FROM ({inner})"
    )


def _nulls(suite: str, table: str, columns: str) -> list[str]:
    return [_check(suite, "not_null", c, table, f"{c} IS NULL") for c in columns.split()]


def _present(suite: str, target: str) -> str:
    return (
        f"SELECT {_head(suite, 'columns_present', target)}, true AS success, 0::BIGINT AS element_count, "
        f"0::BIGINT AS missing_count, 0::BIGINT AS unexpected_count, {r('0')} AS unexpected_percent"
    )


def _all(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


BLOCKS["fact_bars"] = "SELECT * FROM prices"
Q["dq_orders_lineitem"] = _all(
    [
        *_nulls("lineitem", "lineitem", "l_orderkey l_quantity"),
        _unique("lineitem", "l_orderkey,l_linenumber", "lineitem"),
        _fk("lineitem", "l_orderkey", "lineitem", "orders", "o_orderkey"),
        _fk("lineitem", "l_partkey", "lineitem", "part", "p_partkey"),
        _fk("lineitem", "l_suppkey", "lineitem", "supplier", "s_suppkey"),
        _check("lineitem", "between", "l_discount", "lineitem", "l_discount < 0 OR l_discount > 0.05::DOUBLE"),
        _check("lineitem", "between", "l_quantity", "lineitem", "l_quantity <= 1 OR l_quantity > 50"),
        _check("lineitem", "accepted_values", "l_returnflag", "lineitem", "l_returnflag NOT IN ('A', 'N')"),
        _check("lineitem", "pair_at_least", "l_extendedprice,l_quantity", "lineitem", "l_extendedprice < l_quantity"),
        _unique("orders", "o_orderkey", "orders"),
        _unique("orders", "o_custkey", "orders"),
        _fk("orders", "o_custkey", "orders", "customer", "c_custkey"),
        _check("orders", "accepted_values", "o_orderstatus", "orders", "o_orderstatus NOT IN ('F', 'O')"),
        _check("orders", "not_accepted_values", "o_orderpriority", "orders", "o_orderpriority = '1-URGENT'"),
        _check("orders", "expression > 1000", "o_totalprice", "orders", "o_totalprice <= 1000"),
        _present("orders", "o_orderkey,o_totalprice"),
    ]
)
_PAIRS = _in([f"{s}USDT" for s in fx.TERMS if s != "VIEW"])
Q["dq_ticks"] = _all(
    [
        _present(
            "raw_ticks",
            "symbol,event_time,price,price_change_pct,volume_base,volume_quote,trades_count,bid,ask,ingested_at",
        ),
        *_nulls("raw_ticks", "fx_ticks", "symbol event_time price"),
        _check("raw_ticks", "between", "price", "fx_ticks", "price <= 0"),
        _check("raw_ticks", "between", "volume_base", "fx_ticks", "volume_base < 0"),
        _check("raw_ticks", "accepted_values", "symbol", "fx_ticks", f"symbol NOT IN {_PAIRS}"),
        *_nulls("stg_ticks", "s_ticks", "symbol base_asset event_time price"),
        _check("stg_ticks", "not_accepted_values", "symbol", "s_ticks", "trim(symbol) = ''"),
        _check("stg_ticks", "expression > 0", "price", "s_ticks", "price <= 0"),
        _check("stg_ticks", "expression >= 0", "spread", "s_ticks", "spread < 0"),
    ]
)
_BASES = _in(fx.TERMS)
Q["dq_bars"] = _all(
    [
        _unique("fact_prices_hourly", "symbol,event_hour", "prices"),
        *_nulls("fact_prices_hourly", "prices", "open close"),
        _check("fact_prices_hourly", "between", "open", "prices", "open <= 0"),
        _check("fact_prices_hourly", "between", "close", "prices", "close <= 0"),
        _check("fact_prices_hourly", "pair_at_least", "high,low", "prices", "high < low"),
        _check("fact_prices_hourly", "between", "ticks_count", "prices", "ticks_count < 1"),
        _check("fact_prices_hourly", "accepted_values", "symbol", "prices", f"symbol NOT IN {_BASES}"),
        *_nulls("fact_prices", "prices", "price_hour_key coin_key date_key event_hour open close"),
        _unique("fact_prices", "price_hour_key", "prices"),
        _fk("fact_prices", "coin_key", "prices", "d_coin", "coin_key"),
        _fk("fact_prices", "date_key", "prices", "d_date", "date_key"),
        _check("fact_prices", "expression > 0", "open", "prices", "open <= 0"),
        _check("fact_prices", "expression > 0", "close", "prices", "close <= 0"),
        _check("fact_prices", "expression >= low", "high", "prices", "high < low"),
        _check("fact_prices", "expression > 0", "low", "prices", "low <= 0"),
        _check("fact_prices", "expression >= 3", "ticks_count", "prices", "ticks_count < 3"),
        _unique("fact_prices", "coin_key,event_hour", "prices"),
    ]
)
_FORUMS = _in([f"src{i}" for i in range(12)])
Q["dq_posts"] = _all(
    [
        *_nulls("stg_posts", "s_posts", "id subreddit created_utc score"),
        _unique("stg_posts", "id", "s_posts"),
        _check("stg_posts", "accepted_values", "subreddit", "s_posts", f"subreddit NOT IN {_FORUMS}"),
        _check("stg_posts", "between", "upvote_ratio", "s_posts", "upvote_ratio < 0 OR upvote_ratio > 1"),
        _check("reddit_sentiment", "between", "compound", "scored", "abs(compound) > 1"),
        *[
            _check("reddit_sentiment", "between", c, "scored", f"{c} < 0 OR {c} > 1")
            for c in ("pos", "neu", "neg")
        ],
        _check(
            "reddit_sentiment", "accepted_values", "sentiment_label", "scored",
            "sentiment_label NOT IN ('positive', 'neutral', 'negative')",
        ),
        *_nulls("reddit_sentiment", "scored", "post_id model_version"),
    ]
)
Q["dq_marts"] = _all(
    [
        *_nulls("fact_market_snapshot", "snaps", "market_snapshot_key coin_key date_key current_price"),
        _unique("fact_market_snapshot", "market_snapshot_key", "snaps"),
        _fk("fact_market_snapshot", "coin_key", "snaps", "d_coin", "coin_key"),
        _fk("fact_market_snapshot", "date_key", "snaps", "d_date", "date_key"),
        _check("fact_market_snapshot", "expression > 0", "current_price", "snaps", "current_price <= 0"),
        _check("fact_market_snapshot", "between", "market_cap_rank", "snaps", "market_cap_rank NOT BETWEEN 1 AND 2000"),
        _unique("fact_market_snapshot", "coin_key,snapshot_hour", "snaps"),
        *_nulls("fact_sentiment_daily", "daily", "date_key reddit_posts_count"),
        _unique("fact_sentiment_daily", "date_key", "daily"),
        _fk("fact_sentiment_daily", "date_key", "daily", "d_date", "date_key"),
        _check("fact_sentiment_daily", "between", "fng_value", "daily", "fng_value NOT BETWEEN 0 AND 100"),
        _check("fact_sentiment_daily", "expression >= 0", "reddit_posts_count", "daily", "reddit_posts_count < 0"),
        *_nulls("mart_top_movers_daily", "movers", "date_key coin_key rank_gainer rank_loser"),
        _fk("mart_top_movers_daily", "coin_key", "movers", "d_coin", "coin_key"),
        _unique("mart_top_movers_daily", "date_key,coin_key", "movers"),
        *_nulls("mart_social_vs_price", "social", "date_key symbol mentions_count"),
        _check("mart_social_vs_price", "accepted_values", "symbol", "social", f"symbol NOT IN {_BASES}"),
        _check("mart_social_vs_price", "expression >= 0", "mentions_count", "social", "mentions_count < 0"),
        _unique("mart_social_vs_price", "date_key,symbol", "social"),
    ]
)
_AGES = {"ticks": ("event_time", "fx_ticks", 5, 30), "markets": ("ingested_at", "fx_markets", 120, 1440),
         "index": ("ingested_at", "fx_index", 1560, 2880), "posts": ("created_utc", "fx_posts", 120, 1440)}
Q["dq_freshness"] = _all(
    [
        f"SELECT '{name}' AS source, t AS newest, {r('m')} AS age_minutes, "
        f"CASE WHEN m > {error} THEN 'error' WHEN m > {warn} THEN 'warn' ELSE 'pass' END AS status "
        f"FROM (SELECT max({column}) AS t, epoch_us({NOW} - max({column})) / 6e7 AS m FROM {block})"
        for name, (column, block, warn, error) in _AGES.items()
    ]
    + ["SELECT 'no_posts', NULL::TIMESTAMP, NULL::DOUBLE, 'error'"]
)


_LABELS = "sentiment_label NOT IN ('positive', 'neutral', 'negative')"
Q["dq_sources"] = _all(
    [
        *_nulls("source.ticks", "fx_ticks", "symbol event_time price"),
        *_nulls("source.markets", "(SELECT *, coin_id AS id FROM fx_markets)", "id symbol ingested_at"),
        *_nulls("source.index", "fx_index", "index_date value"),
        _unique("source.index", "index_date", "fx_index"),
        *_nulls("source.posts", "fx_posts", "id subreddit created_utc"),
        _unique("source.posts", "id", "fx_posts"),
        *_nulls("source.sentiment", "scored", "post_id compound sentiment_label"),
        _unique("source.sentiment", "post_id", "scored"),
        _check("source.sentiment", "accepted_values", "sentiment_label", "scored", _LABELS),
        *_nulls("source.anomalies", "detections", "symbol event_hour is_anomaly_consensus"),
    ]
)
BLOCKS["s_sentiment"] = """
    SELECT *, (sentiment_label = 'positive')::INTEGER - (sentiment_label = 'negative')::INTEGER AS sentiment_score FROM scored
"""
_BUCKETS = "sentiment_bucket NOT IN ('extreme_fear', 'fear', 'neutral', 'greed', 'extreme_greed')"
Q["dq_staging_rest"] = _all(
    [
        *_nulls("stg_markets", "s_markets", "coin_id symbol current_price"),
        _check("stg_markets", "expression > 0", "current_price", "s_markets", "current_price <= 0"),
        _check("stg_markets", "between", "market_cap_rank", "s_markets", "market_cap_rank NOT BETWEEN 1 AND 1000"),
        *_nulls("stg_index", "s_index", "index_date value"),
        _unique("stg_index", "index_date", "s_index"),
        _check("stg_index", "between", "value", "s_index", "value NOT BETWEEN 0 AND 100"),
        _check("stg_index", "accepted_values", "sentiment_bucket", "s_index", _BUCKETS),
        _check("stg_index", "between", "sentiment_score", "s_index", "abs(sentiment_score) > 1"),
        *_nulls("stg_sentiment", "s_sentiment", "post_id compound sentiment_label sentiment_score"),
        _unique("stg_sentiment", "post_id", "s_sentiment"),
        _check("stg_sentiment", "between", "compound", "s_sentiment", "abs(compound) > 1"),
        *[_check("stg_sentiment", "between", c, "s_sentiment", f"{c} < 0 OR {c} > 1") for c in ("pos", "neu", "neg")],
        _check("stg_sentiment", "accepted_values", "sentiment_label", "s_sentiment", _LABELS),
        _check("stg_sentiment", "accepted_values", "sentiment_score", "s_sentiment", "abs(sentiment_score) > 1"),
        *_nulls("stg_anomalies", "detections", "symbol event_hour is_anomaly_zscore is_anomaly_iforest is_anomaly_consensus zscore_threshold"),
        _check("stg_anomalies", "expression > 0", "zscore_threshold", "detections", "zscore_threshold <= 0"),
        _unique("stg_anomalies", "symbol,event_hour", "detections"),
    ]
)
Q["dq_alerts"] = _all(
    [
        _check("mart_anomaly_alerts", "between", "severity_score", "alerts", "severity_score < 0"),
        *_nulls("mart_anomaly_alerts", "alerts", "is_anomaly_zscore is_anomaly_iforest is_anomaly_consensus anomaly_model_version detected_at"),
        _check("mart_anomaly_alerts", "accepted_values", "symbol", "alerts", f"symbol NOT IN {_BASES}"),
    ]
)
Q["dq_missing_table"] = """
    SELECT 'whole' AS suite, 'not_null' AS "check", 'o_orderkey' AS target, count(*) FILTER (o_orderkey IS NULL) = 0 AS success,
           count(*) AS element_count, count(*) FILTER (o_orderkey IS NULL) AS unexpected_count, NULL::VARCHAR AS error FROM orders
    UNION ALL
    SELECT 'whole', 'unique', 'o_orderkey', coalesce(sum(n) FILTER (n > 1 AND o_orderkey IS NOT NULL), 0) = 0, sum(n)::BIGINT,
           coalesce(sum(n) FILTER (n > 1 AND o_orderkey IS NOT NULL), 0)::BIGINT, NULL
    FROM (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY o_orderkey)
    UNION ALL SELECT 'empty', 'not_null', 'o_orderkey', true, 0, 0, NULL
    UNION ALL SELECT 'empty', 'unique', 'o_orderkey', true, 0, 0, NULL
    UNION ALL SELECT s, 'not_null', 'gone', false, 0, 1, 'missing columns: gone' FROM (VALUES ('whole'), ('empty')) t(s)
    UNION ALL SELECT 'absent', 'table_exists', 'nowhere', false, 0, 1, 'table nowhere not found'
"""
_FAILING = {
    ("between", "l_quantity"): "l_quantity < 1 OR l_quantity > 20", ("accepted_values", "l_returnflag"): "l_returnflag <> 'A'",
    ("not_accepted_values", "l_linenumber"): "l_linenumber IN (1, 2)", ("not_null", "l_orderkey"): "l_orderkey IS NULL",
}
# Of each sixteenth of the hashes the smallest failing value; of these the first ten.
Q["dq_failing_values"] = _all(
    [
        f"""SELECT '{kind}' AS "check", '{c}' AS target, coalesce((
            SELECT string_agg(v, '|' ORDER BY h) FROM (
                SELECT v, h FROM (SELECT {c}::VARCHAR AS v, md5({c}::VARCHAR) AS h FROM lineitem WHERE {bad})
                QUALIFY row_number() OVER (PARTITION BY h[1] ORDER BY h) = 1 ORDER BY h LIMIT 10)), '') AS samples"""
        for (kind, c), bad in _FAILING.items()
    ]
)

# ---- storage ----------------------------------------------------------------------------------

Q["import_anomaly"] = f"""
    SELECT * REPLACE ({r('price_close')} AS price_close, hour_return_pct::DOUBLE AS hour_return_pct,
                      return_zscore::DOUBLE AS return_zscore, severity::DOUBLE AS severity, fng_value::BIGINT AS fng_value,
                      reddit_mentions_day::BIGINT AS reddit_mentions_day) FROM v_alerts
"""
Q["import_sentiment"] = """
    SELECT * REPLACE (date_day::DATE AS date_day, fng_value::BIGINT AS fng_value, reddit_posts_count::BIGINT AS reddit_posts_count,
                      vader_posts_count::BIGINT AS vader_posts_count) FROM v_sentiment
"""
Q["import_kpi"] = "SELECT * FROM v_kpi"
Q["snapshot_append"] = f"SELECT coin_id AS id, 2 * count(*) AS stored, {r('max(current_price)')} AS highest FROM fx_markets GROUP BY coin_id"
Q["index_upsert"] = """
    SELECT index_date, (value - CASE WHEN value >= 50 THEN 10 ELSE 0 END)::INTEGER AS value,
           CASE WHEN value >= 50 THEN 'changed' ELSE category END AS category FROM fx_index
"""
Q["sentiment_upsert"] = """
    SELECT post_id, CASE WHEN sentiment_label = 'negative' THEN 0 ELSE compound END AS compound, sentiment_label, scored_at FROM scored
"""
Q["anomaly_upsert"] = """
    SELECT symbol, event_hour, CASE WHEN is_anomaly_zscore THEN 'again' ELSE model_version END AS model_version,
           is_anomaly_zscore, detected_at FROM detections
"""
Q["bronze_inventory"] = """
    SELECT DISTINCT strftime(index_date, '%Y-%m-%d') AS dt, strftime(index_date, '%H') AS hh, 1::BIGINT AS files FROM fx_index
"""
Q["truncated_and_counted"] = "SELECT count(*) AS loaded, count(*) AS before, 0::BIGINT AS after FROM fx_index"
Q["warehouse_views"] = f"""
    SELECT symbol, count(*) AS bars, count(*) FILTER (event_hour >= {NOW} - INTERVAL 7 DAY) AS recent FROM prices GROUP BY symbol
"""
Q["publish_roundtrip"] = """
    SELECT symbol AS "key", count(*) AS messages, 1::BIGINT AS partitions, count(*) AS placed, 1::BIGINT AS files, 0::BIGINT AS inversions
    FROM fx_ticks GROUP BY symbol
"""
Q["stream_counters"] = """
    SELECT count(*) AS consumed, count(*) FILTER (k > 2) AS inserted, count(*) FILTER (k <= 2) AS dead_letters FROM fx_events
"""
Q["stream_compacted"] = Q["stream_ticks_available_now"]
Q["bars_from_stream"] = Q["hourly_bars_keyed"]
# Blocks that stand for others in some statements: ticks as the stream delivers them.
INSTEAD = {
    "bars_from_stream": {
        "fx_ticks": f"""
            SELECT * REPLACE (date_trunc('millisecond', event_time) AS event_time, round(price, 8) AS price, round(volume_quote, 8) AS volume_quote,
                              round(bid, 8) AS bid, round(ask, 8) AS ask) FROM ({BLOCKS["fx_ticks"]}) WHERE volume_base > 2
        """
    }
}


def _needs(sql: str) -> list[str]:
    """Building blocks used by ``sql``, directly or not, in definition order."""
    wanted: set[str] = set()
    queue = [sql]
    while queue:
        for name in re.findall(r"\b[a-z_0-9]+\b", queue.pop()):
            if name in BLOCKS and name not in wanted:
                wanted.add(name)
                queue.append(BLOCKS[name])
    return [n for n in BLOCKS if n in wanted]


def statements() -> dict[str, str]:
    out = {}
    for name, sql in Q.items():
        sql = sql.strip()
        body = BLOCKS | INSTEAD.get(name, {})
        blocks = [f"{n} AS ({body[n].strip()})" for n in _needs(sql)]
        if sql.startswith("WITH_HOURS"):
            sql = sql.removeprefix("WITH_HOURS").strip()
            out[name] = f"WITH {', '.join(blocks)}, {sql}"
        else:
            out[name] = f"WITH {', '.join(blocks)} {sql}" if blocks else sql
    return out
