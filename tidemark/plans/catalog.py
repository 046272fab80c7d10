"""Registered queries: every operator over the generated test tables.

Each query reads whole tables through the adapters of :mod:`tidemark.sources.fixtures`, runs the
library operator and only then rounds and casts for comparison with the SQL of
:mod:`tidemark.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tidemark import schemas
from tidemark.functions import columns as C
from tidemark.functions.terms import mention_column
from tidemark.operators import alerts, anomalies, bars, dims, facts, forest, marts, monitoring, quality, sentiment, staging
from tidemark.operators.latest import latest_by
from tidemark.plans import jobs, measures, reporting, suites
from tidemark.session import pin_runtime, scratch_path, settle, ship_package
from tidemark.sources import bronze, fixtures as fx, landed
from tidemark.sources.warehouse import Warehouse, merge_rows
from tidemark.streaming import compaction, ticks as stream

AS_OF = fx.AS_OF
DIGITS = 6
# Sums of doubles depend on their order. Moving every value off exact halves keeps the last
# compared digit from depending on it too.
TIE_SHIFT = 3e-9
# Rows of a published file that are put in order at a time.
STRETCH_ROWS = 100_000
Query = Callable[["Frames"], DataFrame]


def tidy(df: DataFrame) -> DataFrame:
    """Comparable output: zone-free instants, doubles of six decimals."""

    def shown(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            return c.cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.DecimalType | T.DoubleType | T.FloatType):
            return F.round(c.cast("double") + TIE_SHIFT, DIGITS).alias(f.name)
        return c

    return df.select(*[shown(f) for f in df.schema.fields])


class Frames:
    """The fixture warehouse as lazy frames, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = ship_package(pin_runtime(spark))
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return fx.table(self.spark, self.sf_dir, name)

    @cached_property
    def ticks(self):
        return fx.ticks(self.spark, self.sf_dir)

    @cached_property
    def markets(self):
        return fx.markets(self.spark, self.sf_dir)

    @cached_property
    def index(self):
        return fx.index(self.spark, self.sf_dir)

    @cached_property
    def posts(self):
        return fx.posts(self.spark, self.sf_dir)

    @cached_property
    def stg_ticks(self):
        return staging.stg_ticks(self.ticks)

    @cached_property
    def stg_markets(self):
        return staging.stg_markets(self.markets)

    @cached_property
    def stg_index(self):
        return staging.stg_index(self.index)

    @cached_property
    def stg_posts(self):
        return staging.stg_posts(self.posts, fx.TERMS)

    @cached_property
    def dim_coin(self):
        return dims.dim_coin(self.stg_markets, AS_OF)

    @cached_property
    def dim_date(self):
        return dims.dim_date(self.spark, AS_OF)

    @cached_property
    def bars(self):
        return bars.with_bar_deltas(bars.hourly_bars(self.stg_ticks, fx.MIN_TICKS))

    @cached_property
    def prices(self):
        return facts.key_bars(self.bars, self.dim_coin, AS_OF)

    @cached_property
    def snapshots(self):
        return facts.fact_market_snapshot(self.stg_markets, self.dim_coin, AS_OF)

    @cached_property
    def daily(self):
        return facts.fact_sentiment_daily(self.stg_index, self.stg_posts, fx.TERMS, AS_OF)

    @cached_property
    def scored(self):
        scores = sentiment.score_posts(self.posts, fx.lexicon(self.spark), fx.NEGATIONS, fx.BOOSTERS, phrases=fx.PHRASES)
        return scores.withColumn("scored_at", C.as_of_ts(AS_OF))

    @cached_property
    def history(self):
        return anomalies.price_history(self.prices, as_of=AS_OF)

    @cached_property
    def stored_prices(self):
        """The hourly fact as production has it: written once, read by all that build on it."""
        return settle(self.prices, "prices")

    @cached_property
    def stored_scores(self):
        """Scores as production has them: posts are scored once, whoever reads the scores."""
        return settle(self.scored, "scores")

    @cached_property
    def stored_alerts(self):
        return settle(self.alerts, "alerts")

    @cached_property
    def detections(self):
        """The production detector with a small stored forest, which SQL can walk too, in place of a grown one."""
        history = anomalies.price_history(self.stored_prices, as_of=AS_OF)
        stored = forest.from_nodes(fx.stored_forest(self.stored_prices), "symbol")
        return settle(anomalies.detect_anomalies(history, as_of=AS_OF, stored_forest=stored), "detections")

    @cached_property
    def stg_anomalies(self):
        return staging.stg_anomalies(self.detections)

    @cached_property
    def alerts(self):
        return marts.anomaly_alerts(
            self.stg_anomalies, self.stored_prices, self.snapshots, self.daily, self.stored_scores, fx.TERMS, AS_OF
        )

    @cached_property
    def movers(self):
        return marts.top_movers_daily(self.snapshots, as_of=AS_OF)

    @cached_property
    def social(self):
        return marts.social_vs_price(self.daily, self.snapshots, fx.TERMS, AS_OF)

    @cached_property
    def v_price(self):
        return reporting.price_hourly(self.prices, self.dim_coin)

    @cached_property
    def v_alerts(self):
        return reporting.anomaly_view(self.stored_alerts, self.dim_coin)

    @cached_property
    def v_sentiment(self):
        return reporting.sentiment_view(self.daily, self.stored_scores)

    @cached_property
    def v_market(self):
        return reporting.market_latest(self.snapshots, self.dim_coin)

    @cached_property
    def v_kpi(self):
        # The row needs three figures of the last day's alerts, so the mart is not stored for it.
        return reporting.kpi_latest(self.ticks, self.alerts, self.daily, self.stored_scores, self.snapshots, AS_OF)

    @cached_property
    def ledger(self):
        """Alerts of severity 4 and more count as already sent."""
        sent = self.v_alerts.where("severity >= 4").select(
            alerts.alert_key().alias("alert_key"), "symbol", F.col("ts_hour").alias("event_hour"), "severity",
            F.lit(True).alias("response_ok"),
        )
        return alerts.ledger_rows(sent, AS_OF)

    @cached_property
    def pending(self):
        return alerts.pending_alerts(self.v_alerts, self.ledger, lookback_hours=720, as_of=AS_OF)


REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _no_load_time(df: DataFrame) -> DataFrame:
    return df.drop("dw_updated_at")


# ---- staging, dimensions, facts, marts -------------------------------------------------------


@query
def stg_ticks(f: Frames) -> DataFrame:
    return f.stg_ticks


@query
def stg_markets(f: Frames) -> DataFrame:
    return f.stg_markets


@query
def stg_index(f: Frames) -> DataFrame:
    return f.stg_index


@query
def stg_posts(f: Frames) -> DataFrame:
    # Whole texts are compared by their hashes.
    texts = {"text_length": F.length("full_text"), "full_text": F.md5("full_text"), "selftext": F.md5("selftext")}
    return f.stg_posts.withColumns(texts)


@query
def stg_sentiment(f: Frames) -> DataFrame:
    return staging.stg_sentiment(f.scored)


@query
def stg_anomalies(f: Frames) -> DataFrame:
    return f.stg_anomalies


@query
def dim_coin(f: Frames) -> DataFrame:
    return _no_load_time(f.dim_coin)


@query
def dim_date(f: Frames) -> DataFrame:
    """The calendar, with the bars of each day to relate it to the data."""
    per_day = f.bars.groupBy(C.date_key("event_hour").alias("date_key")).agg(F.count(F.lit(1)).alias("bars"))
    return f.dim_date.join(per_day, "date_key", "left")


@query
def report_calendar(f: Frames) -> DataFrame:
    """Prices related to the report calendar through their date."""
    calendar = dims.report_calendar(f.spark, AS_OF, start=date(2024, 1, 5))
    related = reporting.with_calendar(f.v_price, "ts_hour", calendar)
    return related.groupBy("date", "year", "month", "day", "weekday", "year_month").agg(
        F.count(F.lit(1)).alias("bars"), F.max("price_high").alias("high")
    )


@query
def hourly_bars(f: Frames) -> DataFrame:
    return bars.hourly_bars(f.stg_ticks, fx.MIN_TICKS)


@query
def bar_deltas(f: Frames) -> DataFrame:
    return f.bars.select(
        "symbol", "event_hour", "close", "hour_volume_base_delta", "hour_trades_delta", "hour_return"
    )


@query
def hourly_bars_keyed(f: Frames) -> DataFrame:
    return _no_load_time(f.prices)


@query
def hourly_bars_default_gate(f: Frames) -> DataFrame:
    return bars.hourly_bars(f.stg_ticks)


@query
def market_snapshot_hourly(f: Frames) -> DataFrame:
    return _no_load_time(f.snapshots)


@query
def sentiment_daily(f: Frames) -> DataFrame:
    return _no_load_time(f.daily)


@query
def top_movers_daily(f: Frames) -> DataFrame:
    return _no_load_time(f.movers)


@query
def social_vs_price(f: Frames) -> DataFrame:
    return _no_load_time(f.social)


@query
def anomaly_alerts(f: Frames) -> DataFrame:
    return _no_load_time(f.alerts)


# ---- models ----------------------------------------------------------------------------------


@query
def price_history(f: Frames) -> DataFrame:
    return f.history


@query
def rolling_zscore(f: Frames) -> DataFrame:
    return f.history.select("symbol", "event_hour", anomalies.rolling_zscore("hour_return").alias("z"))


@query
def zscore_flags(f: Frames) -> DataFrame:
    return anomalies.flag_zscore(f.history)


@query
def feature_median_impute(f: Frames) -> DataFrame:
    return anomalies.impute_features(f.history).select(
        "symbol", "event_hour", *[f"x_{n}" for n in anomalies.FEATURES], "points"
    )


@query
def price_anomalies(f: Frames) -> DataFrame:
    # As in production, detection reads the stored fact table.
    history = anomalies.price_history(f.stored_prices, as_of=AS_OF)
    return anomalies.detect_anomalies(history, as_of=AS_OF)


@query
def forest_flag_counts(f: Frames) -> DataFrame:
    """Points of each symbol, whether they reach the gate, and rows the real forest flags: an exact share of them."""
    history = anomalies.price_history(f.stored_prices, as_of=AS_OF)
    found = anomalies.detect_anomalies(history, as_of=AS_OF)
    return found.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("points"),
        F.count_if(F.col("iforest_score").isNotNull()).alias("scored"),
        F.count_if("is_anomaly_iforest").alias("flagged"),
    )


@query
def forest_scores_given_trees(f: Frames) -> DataFrame:
    """Both detectors and their consensus for every bar, the forest a stored one."""
    return f.detections


@query
def detection_summary(f: Frames) -> DataFrame:
    return anomalies.detection_summary(f.detections)


@query
def lexicon_sentiment(f: Frames) -> DataFrame:
    return f.scored


@query
def sentiment_label_summary(f: Frames) -> DataFrame:
    return sentiment.label_summary(f.scored)


@query
def sentiment_daily_share(f: Frames) -> DataFrame:
    return marts.sentiment_share_daily(f.scored)


@query
def unscored_posts(f: Frames) -> DataFrame:
    """Posts of the last 20 days that are not among the scored ones (here: those judged positive)."""
    already = f.scored.where("sentiment_label = 'positive'")
    todo = sentiment.posts_to_score(f.posts, already, lookback_days=20, as_of=AS_OF)
    return todo.select("id", "subreddit", "created_utc", F.md5("title").alias("title"), F.md5("selftext").alias("body"))


# ---- reporting -------------------------------------------------------------------------------


@query
def kpi_latest(f: Frames) -> DataFrame:
    return f.v_kpi


@query
def price_hourly_view(f: Frames) -> DataFrame:
    return f.v_price


@query
def anomaly_view(f: Frames) -> DataFrame:
    return f.v_alerts


@query
def sentiment_view(f: Frames) -> DataFrame:
    return f.v_sentiment


@query
def sentiment_shares_long(f: Frames) -> DataFrame:
    return reporting.sentiment_shares_long(f.v_sentiment)


@query
def market_latest_view(f: Frames) -> DataFrame:
    return f.v_market


@query
def import_price_hourly(f: Frames) -> DataFrame:
    return reporting.import_view("price_hourly", f.v_price, AS_OF)


@query
def import_market(f: Frames) -> DataFrame:
    return reporting.import_view("market_latest", f.v_market, AS_OF)


@query
def import_anomaly(f: Frames) -> DataFrame:
    return reporting.import_view("anomaly_view", f.v_alerts, AS_OF)


@query
def import_sentiment(f: Frames) -> DataFrame:
    return reporting.import_view("sentiment_view", f.v_sentiment, AS_OF)


@query
def import_kpi(f: Frames) -> DataFrame:
    return reporting.import_view("kpi_latest", f.v_kpi, AS_OF)


@query
def view_row_counts(f: Frames) -> DataFrame:
    return reporting.row_counts(
        {
            "kpi_latest": f.v_kpi,
            "price_hourly": f.v_price,
            "anomaly_view": f.v_alerts,
            "sentiment_view": f.v_sentiment,
            "market_latest": f.v_market,
        }
    )


# ---- measures --------------------------------------------------------------------------------


@query
def measure_kpi_cards(f: Frames) -> DataFrame:
    return measures.kpi_measures(f.v_kpi)


@query
def measure_prices(f: Frames) -> DataFrame:
    return measures.price_measures(f.v_price)


@query
def measure_prices_by_symbol(f: Frames) -> DataFrame:
    return measures.price_measures(f.v_price, ["symbol"])


@query
def measure_price_normalized(f: Frames) -> DataFrame:
    return measures.price_normalized(f.v_price)


@query
def measure_alert_counts(f: Frames) -> DataFrame:
    return measures.alert_measures(f.v_alerts)


@query
def measure_alert_counts_by_symbol(f: Frames) -> DataFrame:
    return measures.alert_measures(f.v_alerts, ["symbol"])


@query
def measure_sentiment(f: Frames) -> DataFrame:
    return measures.sentiment_measures(f.v_sentiment)


@query
def measure_market(f: Frames) -> DataFrame:
    return measures.market_measures(f.v_market)


@query
def measure_market_share(f: Frames) -> DataFrame:
    return measures.market_share(f.v_market)


@query
def top_changes(f: Frames) -> DataFrame:
    return measures.top_changes(f.v_market)


# ---- monitoring and alerts -------------------------------------------------------------------


@query
def ticks_per_symbol(f: Frames) -> DataFrame:
    return monitoring.ticks_per_symbol(f.ticks)


@query
def symbol_health(f: Frames) -> DataFrame:
    return monitoring.symbol_health(f.ticks, AS_OF)


@query
def tick_tail(f: Frames) -> DataFrame:
    return monitoring.tick_tail(f.ticks)


@query
def tick_freshness(f: Frames) -> DataFrame:
    return monitoring.tick_freshness(f.ticks, AS_OF)


@query
def price_context(f: Frames) -> DataFrame:
    return monitoring.price_context(f.v_price, "ERROR", as_of=AS_OF)


@query
def pending_alerts(f: Frames) -> DataFrame:
    return f.pending


@query
def alert_text(f: Frames) -> DataFrame:
    return f.pending.select("alert_key", alerts.alert_text().alias("message"))


@query
def explainer_alerts(f: Frames) -> DataFrame:
    return alerts.explainer_alerts(f.v_alerts, only_consensus=False, min_severity=1.0)


@query
def alert_ledger(f: Frames) -> DataFrame:
    """Ledger after the pending alerts were sent twice: nothing is entered a second time."""
    columns = schemas.ledger().fieldNames()
    entries = settle(alerts.ledger_rows(f.pending.withColumn("response_ok", F.col("fng_value") < 50), AS_OF), "entries")
    once = settle(merge_rows(f.ledger, entries, columns, key=["alert_key"]), "ledger")
    return merge_rows(once, entries, columns, key=["alert_key"])


# ---- sinks and sources -----------------------------------------------------------------------


def _post_updates(f: Frames) -> DataFrame:
    """English posts come again with new counters and another title; German ones appear under new ids."""
    lang = F.substring_index("author", "-", -1)
    seen = f.posts.withColumn("lang", lang)
    again = seen.where("lang = 'en'").withColumns(
        {"score": F.col("score") + 10, "title": F.lit("changed"), "num_comments": F.col("num_comments") * 2}
    )
    new = seen.where("lang = 'de'").withColumn("id", F.concat(F.lit("new-"), "id"))
    return again.unionByName(new).drop("lang")


_POST_COLUMNS = ["id", "subreddit", "title", "author", "score", "upvote_ratio", "num_comments", "created_utc"]


@query
def upsert_update(f: Frames) -> DataFrame:
    return merge_rows(
        f.posts, _post_updates(f), _POST_COLUMNS, ["id"], ["score", "upvote_ratio", "num_comments"]
    )


@query
def upsert_ignore(f: Frames) -> DataFrame:
    return merge_rows(f.posts, _post_updates(f), _POST_COLUMNS, ["id"])


@query
def upsert_append(f: Frames) -> DataFrame:
    return merge_rows(f.posts, _post_updates(f), _POST_COLUMNS)


@query
def warehouse_upsert(f: Frames) -> DataFrame:
    """The posts table after a first load and the update batch, through files."""
    warehouse = Warehouse(f.spark, scratch_path(f.spark, "warehouse"))
    warehouse.write_batch("posts", f.posts)
    warehouse.write_batch("posts", _post_updates(f))
    return warehouse.read("posts").select(*_POST_COLUMNS)


@query
def bronze_roundtrip(f: Frames) -> DataFrame:
    """Write all hour partitions, then write those of high readings again: only they are replaced."""
    root = scratch_path(f.spark, "bronze")
    bronze.write_bronze(f.index, root, "fx", "index", F.col("index_date"))
    again = f.index.where("value >= 50").withColumn("value", F.col("value") + 1000)
    bronze.write_bronze(again, root, "fx", "index", F.col("index_date"))
    return bronze.read_bronze(f.spark, root, "fx", "index").select("dt", "hh", "index_date", "value", "category")


def _market_payload(f: Frames) -> DataFrame:
    iso = F.date_format("last_updated", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return f.markets.drop("ingested_at").withColumns(
        {
            "last_updated": F.when(F.col("market_cap_rank").isNull(), "n/a").otherwise(iso),
            "ath_date": iso,
            "atl_date": F.lit(None).cast("string"),
        }
    )


@query
def landed_markets(f: Frames) -> DataFrame:
    """Market payload rows: dates as ISO text (unreadable where k = 0), lineage columns, landing schema."""
    rows = landed.to_landing(landed.market_rows(_market_payload(f), AS_OF), schemas.markets())
    return rows.select("id", "symbol", "current_price", "last_updated", "ath_date", "atl_date", "ingested_at")


@query
def landed_index(f: Frames) -> DataFrame:
    """Index payload documents (one per category, readings nested) back to rows."""
    reading = F.struct(
        F.col("value").cast("string").alias("value"),
        F.col("category").alias("value_classification"),
        F.unix_timestamp("index_date").cast("string").alias("timestamp"),
        "time_until_update",
    )
    payload = f.index.select(F.array(reading).alias("data"))
    return landed.index_rows(payload, AS_OF).select("index_date", "value", "category", "time_until_update", "_source")


@query
def landed_posts(f: Frames) -> DataFrame:
    """Post listings (one child each) back to rows; a post without comments comes without id and is skipped."""
    post = F.struct(
        F.when(F.col("num_comments") > 0, F.col("id")).alias("id"),
        "title",
        "selftext",
        "author",
        F.when(F.col("score") > 0, F.col("score")).cast("bigint").alias("score"),
        "upvote_ratio",
        F.col("num_comments").cast("bigint").alias("num_comments"),
        F.unix_timestamp("created_utc").cast("double").alias("created_utc"),
        "url",
        "is_self",
        "over_18",
        "permalink",
    )
    listing = f.posts.select(
        "subreddit", F.struct(F.array(F.struct(post.alias("data"))).alias("children")).alias("data")
    )
    rows = landed.post_rows(listing, F.col("subreddit"), AS_OF)
    return rows.select(
        "id", "subreddit", F.md5("selftext").alias("body"), "score", "over_18", "permalink", "created_utc"
    )


@query
def tracked_coins(f: Frames) -> DataFrame:
    """Ticks per tracked pair, pairs mapped to coin ids by a setting."""
    mapping = {"ERRORUSDT": "error-0", "CLICKUSDT": "click-0", "VIEWUSDT": "view-0"}
    tracked = landed.tracked_coins(f.spark, " errorusdt, CLICKUSDT,, nosuchusdt ,viewUSDT", mapping)
    counted = monitoring.ticks_per_symbol(f.ticks).select(F.col("symbol").alias("pair"), "ticks")
    return tracked.join(counted, "pair").select("pair", "coin_id", "ticks")


# ---- streaming -------------------------------------------------------------------------------


def _raw_tickers(f: Frames) -> DataFrame:
    """Exchange payloads of all ticks: numbers as text, wrapped in an envelope where volume is even."""
    values = {
        "s": F.col("symbol"),
        "E": F.unix_millis("event_time"),
        "n": F.col("trades_count"),
        **{
            short: F.col(name).cast("string")
            for short, name in {
                "c": "price", "P": "price_change_pct", "v": "volume_base", "q": "volume_quote", "b": "bid", "a": "ask",
            }.items()
        },
        **{short: F.lit("1.5") for short in ("p", "o", "h", "l")},
    }
    inner = F.to_json(F.struct(*[v.alias(k) for k, v in values.items()]))
    wrapped = F.concat(F.lit('{"stream":"x@ticker","data":'), inner, F.lit("}"))
    return f.ticks.select(F.when(F.col("volume_base") % 2 == 0, wrapped).otherwise(inner).alias("value"))


def _messages(f: Frames, half: int | None = None) -> DataFrame:
    """Topic records of all ticks, or of a half of them; where the volume is 0, 1 or 2 the record is damaged."""
    ticks = f.ticks if half is None else f.ticks.where(F.col("volume_base") % 2 == half)
    ticks = ticks.withColumn("event_time", F.unix_millis("event_time"))
    value = (
        F.when(F.col("volume_base") == 0, F.concat(F.lit("not json "), "key"))
        .when(F.col("volume_base") == 1, F.to_json(F.struct("symbol", "price")))
        .when(F.col("volume_base") == 2, F.regexp_replace("value", '"price":[^,]*', '"price":"x"'))
        .otherwise(F.col("value"))
    )
    return stream.to_messages(ticks, keep=["symbol", "price", "volume_base"]).select("key", value.alias("value"))


@query
def ticker_json_roundtrip(f: Frames) -> DataFrame:
    parsed = stream.normalize_tickers(_raw_tickers(f))
    return parsed.select("symbol", "event_time", "price", "price_change_pct", "volume_base", "trades_count", "ask", "low")


@query
def dead_letters(f: Frames) -> DataFrame:
    bad = stream.dead_letters(stream.decode(_messages(f), AS_OF))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


def _streamed(f: Frames) -> str:
    """Run the consumer over all records, delivered as the files of one write."""
    base = scratch_path(f.spark, "stream")
    _messages(f).select("value").write.text(f"{base}/topic")
    messages = stream.read_messages(f.spark, "text", {"path": f"{base}/topic", "maxFilesPerTrigger": "1000"})
    consumer = stream.ingest(messages, f"{base}/out", f"{base}/checkpoint", AS_OF, available_now=True)
    consumer.awaitTermination()
    return f"{base}/out"


@query
def stream_ticks_available_now(f: Frames) -> DataFrame:
    return stream.read_ticks(f.spark, _streamed(f))


@query
def stream_dead_letters(f: Frames) -> DataFrame:
    bad = stream.read_dead_letters(f.spark, _streamed(f))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


# ---- quality ---------------------------------------------------------------------------------


def _report(df: DataFrame) -> DataFrame:
    return df.select(
        "suite", "check", "target", "success", "element_count", "missing_count", "unexpected_count", "unexpected_percent"
    )


@query
def dq_orders_lineitem(f: Frames) -> DataFrame:
    tables = {n: f.table(n) for n in ("orders", "lineitem", "customer", "part", "supplier")}
    declared = {
        "lineitem": quality.Suite(
            "lineitem",
            (
                *quality.not_null("l_orderkey", "l_quantity"),
                quality.unique("l_orderkey", "l_linenumber"),
                quality.relationship("l_orderkey", "orders", "o_orderkey"),
                quality.relationship("l_partkey", "part", "p_partkey"),
                quality.relationship("l_suppkey", "supplier", "s_suppkey"),
                quality.between("l_discount", 0.0, 0.05),
                quality.between("l_quantity", 1, 50, strict_low=True),
                quality.accepted_values("l_returnflag", ["A", "N"]),
                quality.pair_at_least("l_extendedprice", "l_quantity"),
            ),
        ),
        "orders": quality.Suite(
            "orders",
            (
                quality.unique("o_orderkey"),
                quality.unique("o_custkey"),
                quality.relationship("o_custkey", "customer", "c_custkey"),
                quality.accepted_values("o_orderstatus", ["F", "O"]),
                quality.not_accepted_values("o_orderpriority", ["1-URGENT"]),
                quality.expression("o_totalprice", "> 1000"),
                quality.columns_present("o_orderkey", "o_totalprice"),
            ),
        ),
    }
    return _report(quality.run_suites(f.spark, declared, tables))


_FX_BASES = list(fx.TERMS)
_FX_PAIRS = [f"{b}USDT" for b in _FX_BASES if b != "VIEW"]


@query
def dq_ticks(f: Frames) -> DataFrame:
    declared = {
        "raw_ticks": suites.business_suites(pairs=_FX_PAIRS)["raw_ticks"],
        "stg_ticks": suites.staging_suites()["stg_ticks"],
    }
    return _report(quality.run_suites(f.spark, declared, {"ticks": f.ticks, "stg_ticks": f.stg_ticks}))


@query
def dq_bars(f: Frames) -> DataFrame:
    """All checks of the hourly fact; the coin check finds the symbols without a coin."""
    prices = f.stored_prices
    declared = {
        "fact_prices_hourly": suites.business_suites(bases=_FX_BASES)["fact_prices_hourly"],
        "fact_prices": suites.mart_suites(min_ticks=3)["fact_prices"],
    }
    tables = {"fact_prices_hourly": prices, "dim_coin": f.dim_coin, "dim_date": f.dim_date}
    return _report(quality.run_suites(f.spark, declared, tables))


@query
def dq_posts(f: Frames) -> DataFrame:
    declared = {
        "stg_posts": suites.staging_suites(forums=[f"src{i}" for i in range(12)])["stg_posts"],
        "reddit_sentiment": suites.business_suites()["reddit_sentiment"],
    }
    return _report(quality.run_suites(f.spark, declared, {"stg_posts": f.stg_posts, "sentiment": f.stored_scores}))


@query
def dq_marts(f: Frames) -> DataFrame:
    declared = {
        n: s
        for n, s in suites.mart_suites(mention_symbols=_FX_BASES).items()
        if n in ("fact_market_snapshot", "fact_sentiment_daily", "mart_top_movers_daily", "mart_social_vs_price")
    }
    snapshots, daily = settle(f.snapshots, "snapshots"), settle(f.daily, "daily")
    tables = {
        "fact_market_snapshot": snapshots,
        "fact_sentiment_daily": daily,
        "mart_top_movers_daily": marts.top_movers_daily(snapshots),
        "mart_social_vs_price": marts.social_vs_price(daily, snapshots, fx.TERMS),
        "dim_coin": f.dim_coin,
        "dim_date": f.dim_date,
    }
    return _report(quality.run_suites(f.spark, declared, tables))


@query
def dq_freshness(f: Frames) -> DataFrame:
    sources = {
        "ticks": f.ticks,
        "markets": f.markets,
        "index": f.index,
        "posts": f.posts,
        "no_posts": f.posts.where(F.lit(False)),  # a source without rows
    }
    rules = {**suites.FRESHNESS, "no_posts": suites.FRESHNESS["posts"]}
    return quality.freshness(sources, rules, AS_OF)


@query
def latest_per_key(f: Frames) -> DataFrame:
    """Newest event per user."""
    events = f.table("events")
    return latest_by(events, ["user_id"], [F.desc("ts"), F.desc("event_id")]).select(
        "user_id", "event_id", "ts", "value"
    )


@query
def mentions_long(f: Frames) -> DataFrame:
    return marts.mentions_long(f.daily, fx.TERMS)


@query
def mention_totals(f: Frames) -> DataFrame:
    """Posts and mentions over all staged posts."""
    return f.stg_posts.agg(
        F.count(F.lit(1)).alias("posts"),
        *[F.count_if(mention_column(s)).alias(mention_column(s)) for s in fx.TERMS],
    )


# ---- storage ---------------------------------------------------------------------------------


def _warehouse(f: Frames) -> Warehouse:
    return Warehouse(f.spark, scratch_path(f.spark, "warehouse"))


@query
def snapshot_append(f: Frames) -> DataFrame:
    """Market snapshots are appended: two loads give every row twice."""
    warehouse = _warehouse(f)
    for _ in range(2):
        warehouse.write_batch("markets", landed.to_landing(landed.market_rows(_market_payload(f), AS_OF), schemas.markets()))
    stored = warehouse.read("markets")
    return stored.groupBy("id").agg(F.count(F.lit(1)).alias("stored"), F.max("current_price").alias("highest"))


@query
def index_upsert(f: Frames) -> DataFrame:
    """Readings of 50 and more come again, lower by ten and renamed; the first write's other readings stay."""
    warehouse = _warehouse(f)
    warehouse.write_batch("index", f.index)
    again = f.index.where("value >= 50").withColumns({"value": F.col("value") - 10, "category": F.lit("changed")})
    warehouse.write_batch("index", again)
    return warehouse.read("index").select("index_date", "value", "category")


@query
def sentiment_upsert(f: Frames) -> DataFrame:
    """Negative posts are scored again: figures are replaced, the instant of the first score stays."""
    warehouse = _warehouse(f)
    scored = f.stored_scores
    warehouse.write_batch("sentiment", scored)
    again = scored.where("sentiment_label = 'negative'")
    again = again.withColumns({"compound": F.lit(0.0), "scored_at": F.col("scored_at") + F.expr("INTERVAL 1 DAY")})
    warehouse.write_batch("sentiment", again)
    return warehouse.read("sentiment").select("post_id", "compound", "sentiment_label", "scored_at")


@query
def anomaly_upsert(f: Frames) -> DataFrame:
    """Bars with a z-score flag are detected again by another model; the instant of the first detection stays."""
    warehouse = _warehouse(f)
    warehouse.write_batch("anomalies", f.detections)
    again = f.detections.where("is_anomaly_zscore").withColumns(
        {"model_version": F.lit("again"), "detected_at": F.col("detected_at") + F.expr("INTERVAL 1 DAY")}
    )
    warehouse.write_batch("anomalies", again)
    return warehouse.read("anomalies").select("symbol", "event_hour", "model_version", "is_anomaly_zscore", "detected_at")


@query
def bronze_inventory(f: Frames) -> DataFrame:
    """Files of each hour partition after a backfill of all hours: one."""
    path = bronze.write_bronze(f.index, scratch_path(f.spark, "bronze"), "fx", "index", F.col("index_date"))
    files = bronze.inventory(f.spark, path)
    place = [F.regexp_extract("key", f"{c}=([^/]+)", 1).alias(c) for c in ("dt", "hh")]
    sized = files.where("size_kb > 0 AND last_modified IS NOT NULL")
    return sized.select(*place).groupBy("dt", "hh").agg(F.count(F.lit(1)).alias("files"))


@query
def truncated_and_counted(f: Frames) -> DataFrame:
    """Rows of a maintained table before and after it is emptied."""
    warehouse = _warehouse(f)
    warehouse.write_batch("index", f.index)
    before = warehouse.count("index")
    warehouse.truncate("index")
    return f.index.agg(F.count(F.lit(1)).alias("loaded")).select(
        "loaded", F.lit(before).cast("bigint").alias("before"), F.lit(warehouse.count("index")).cast("bigint").alias("after")
    )


@query
def warehouse_views(f: Frames) -> DataFrame:
    """A stored table through its view and SQL, the look-back pruned by day."""
    warehouse = _warehouse(f)
    warehouse.write_mart("fact_prices_hourly", f.stored_prices)
    warehouse.create_views(["fact_prices_hourly"], prefix="tidemark_")
    week_ago = C.ago(AS_OF, 7, "days")
    recent = warehouse.read("fact_prices_hourly", week_ago).groupBy("symbol").agg(F.count(F.lit(1)).alias("recent"))
    every = f.spark.sql("SELECT symbol, count(*) AS bars FROM tidemark_fact_prices_hourly GROUP BY symbol")
    return every.join(recent, "symbol", "left").select("symbol", "bars", F.coalesce("recent", F.lit(0).cast("bigint")).alias("recent"))


@query
def publish_roundtrip(f: Frames) -> DataFrame:
    """Published records of each symbol: how many, in how many partitions and files, and how often one precedes an
    earlier one."""
    path = scratch_path(f.spark, "topic")
    messages = stream.to_messages(f.ticks.withColumn("event_time", F.unix_millis("event_time")), keep=["event_time"])
    stream.publish(messages, "parquet", {"path": path}, order=["event_time"])
    sent = f.spark.read.parquet(path).select(
        "key", "partition", F.get_json_object("value", "$.event_time").cast("bigint").alias("at"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
    )
    # Neighbours are met within stretches of a file, then the ends of the stretches.
    sent = sent.withColumn("stretch", F.floor(F.col("row") / STRETCH_ROWS))
    before = F.lag("at").over(Window.partitionBy("key", "file", "stretch").orderBy("row"))
    stretches = sent.withColumn("before", before).groupBy("key", "file", "stretch").agg(
        F.count(F.lit(1)).alias("messages"), F.collect_set("partition").alias("partitions"),
        F.count_if(F.col("partition").between(0, stream.TOPIC_PARTITIONS - 1)).alias("placed"),
        F.count_if(F.col("before") > F.col("at")).alias("inversions"),
        F.min_by("at", "row").alias("first"), F.max_by("at", "row").alias("last"),
    )
    last = F.lag("last").over(Window.partitionBy("key").orderBy("file", "stretch"))
    return stretches.withColumn("before", last).groupBy("key").agg(
        F.sum("messages").alias("messages"),
        F.size(F.array_distinct(F.flatten(F.collect_set("partitions")))).cast("long").alias("partitions"),
        F.sum("placed").alias("placed"), F.countDistinct("file").alias("files"),
        (F.sum("inversions") + F.count_if(F.col("before") > F.col("first"))).alias("inversions"),
    )


@query
def stream_counters(f: Frames) -> DataFrame:
    """Messages consumed, inserted and refused, summed over the commits of all batches."""
    per_batch = stream.batch_counters(f.spark, _streamed(f))
    return per_batch.agg(*[F.sum(c).alias(c) for c in ("consumed", "inserted", "dead_letters")])


@query
def stream_compacted(f: Frames) -> DataFrame:
    """All ticks after half of the days were moved into the warehouse, the move repeated and a late delivery."""
    base = scratch_path(f.spark, "stream")
    warehouse = Warehouse(f.spark, f"{base}/warehouse")
    for half in (0, 1):
        _deliver(f, base, half)
        for _ in range(2):
            compaction.compact(warehouse, f"{base}/out", "2024-01-15 00:00:00")
    return compaction.all_ticks(warehouse, f"{base}/out")


@query
def bars_from_stream(f: Frames) -> DataFrame:
    """The hourly fact as the incremental job keeps it: the second delivery has late ticks for hours of the first."""
    base = scratch_path(f.spark, "stream")
    warehouse = Warehouse(f.spark, f"{base}/warehouse")
    coins = settle(f.dim_coin, "coins")
    for half in (0, 1):
        _deliver(f, base, half)
        jobs.refresh_stream_bars(warehouse, f"{base}/out", coins, fx.MIN_TICKS, AS_OF)
    return _no_load_time(warehouse.read("fact_prices_hourly"))


def _deliver(f: Frames, base: str, half: int) -> None:
    """Half of the records arrive (by the volume of the tick) and are consumed."""
    messages = _messages(f, half)
    messages.select("value").write.mode("append").text(f"{base}/topic")
    arrived = stream.read_messages(f.spark, "text", {"path": f"{base}/topic", "maxFilesPerTrigger": "1000"})
    stream.ingest(arrived, f"{base}/out", f"{base}/checkpoint", AS_OF, available_now=True).awaitTermination()


@query
def dq_sources(f: Frames) -> DataFrame:
    tables = {
        "ticks": f.ticks, "markets": f.markets, "index": f.index, "posts": f.posts, "sentiment": f.stored_scores,
        "anomalies": f.detections,
    }
    return _report(quality.run_suites(f.spark, suites.source_suites(), tables))


@query
def dq_staging_rest(f: Frames) -> DataFrame:
    names = ("stg_markets", "stg_index", "stg_sentiment", "stg_anomalies")
    tables = {
        "stg_markets": f.stg_markets, "stg_index": f.stg_index, "stg_anomalies": f.stg_anomalies,
        "stg_sentiment": staging.stg_sentiment(f.stored_scores),
    }
    declared = suites.staging_suites()
    return _report(quality.run_suites(f.spark, {n: declared[n] for n in names}, tables))


@query
def dq_alerts(f: Frames) -> DataFrame:
    """The business checks of the alert mart."""
    declared = {"mart_anomaly_alerts": suites.business_suites(bases=_FX_BASES)["mart_anomaly_alerts"]}
    return _report(quality.run_suites(f.spark, declared, {"mart_anomaly_alerts": f.stored_alerts}))


@query
def dq_missing_table(f: Frames) -> DataFrame:
    """A table that is not there fails its suite, an empty one passes, and a checked column that is gone fails its check."""
    suite = quality.Suite("orders", (*quality.not_null("o_orderkey", "gone"), quality.unique("o_orderkey")))
    declared = {"whole": suite, "empty": quality.Suite("none", suite.checks), "absent": quality.Suite("nowhere", suite.checks)}
    orders = f.table("orders")
    found = quality.run_suites(f.spark, declared, {"orders": orders, "none": orders.where(F.lit(False))})
    return found.select("suite", "check", "target", "success", "element_count", "unexpected_count", "error")


@query
def dq_failing_values(f: Frames) -> DataFrame:
    """Up to ten failing values of each check over all line items, in one scan."""
    checks = [
        quality.between("l_quantity", 1, 20), quality.accepted_values("l_returnflag", ["A"]),
        quality.not_accepted_values("l_linenumber", [1, 2]), *quality.not_null("l_orderkey"),
    ]
    found = quality.failing_values(f.table("lineitem"), checks)
    return found.select("check", "target", F.array_join("samples", "|").alias("samples"))


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(REGISTRY[name](Frames(spark, sf_dir)))
