"""The query catalogue: the reference's programs run over the driver's tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` and reads whole tables.  The
reference's second-scale spans match nothing on ``events`` (a user's events are
about ten hours apart), so the catalogue passes wider parameters; the operator
defaults keep the reference's values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickstream.operators.matching import interval_join, one_slot_match, outer_match, payment_timeout, window_join
from clickstream.operators.pattern import Step, match_sequence
from clickstream.operators.sequence import (
    blocks, burst, consecutive, follow_distinct, n_in_span, threshold_then_next,
)
from clickstream.operators.quota import quota_filter
from clickstream.operators.visitors import bitmap_visitors, running_visitors, unique_visitors
from clickstream.operators.windows import window_count, window_measures, window_top_n, window_unique
from clickstream.sources.access_log import format_access_line, parse_access_log
from clickstream.sources.tables import behaviour_events, read_table

# Own labels for the six channels that an event's item key stands for.
CHANNELS = ["store", "search", "social", "mail", "partner", "direct"]


def _views(spark, sf_dir):
    return behaviour_events(spark, sf_dir).where(F.col("event_type") == "view")


def hot_item_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views per item in 1 h windows sliding by 5 min."""
    views = behaviour_events(spark, sf_dir).where(F.col("event_type") == "view")
    counts = window_count(views.withColumnRenamed("k", "item_id"), "ts", "1 hour", "5 minutes",
                          keys=["item_id"])
    return counts.select("window_end", "item_id", "cnt")


def hot_items_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 items per window of :func:`hot_item_counts` (the flagship query)."""
    views = behaviour_events(spark, sf_dir).where(F.col("event_type") == "view").withColumnRenamed("k", "item_id")
    ranked = window_top_n(views, "ts", "1 hour", "5 minutes", keys=["item_id"], n=3)
    return ranked.select("window_end", "rank", "item_id", "cnt")


def behaviour_counts_1h_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per behaviour in 1 h windows sliding by 10 s (360 windows per event)."""
    ev = behaviour_events(spark, sf_dir)
    return window_count(ev, "ts", "1 hour", "10 seconds", keys=["event_type"]).select(
        "window_end", "event_type", "cnt")


def behaviour_value_1h_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum, count, minimum and maximum of ``value`` per behaviour in 1 h windows sliding by 10 s."""
    out = window_measures(behaviour_events(spark, sf_dir), "ts", "1 hour", "10 seconds", keys=["event_type"],
                          measures={"amount": ("sum", "value"), "n": ("count", "value"), "least": ("min", "value"),
                                    "most": ("max", "value")})
    return out.select("window_end", "event_type", F.round("amount", 4).alias("amount"), "n", "least", "most")


def hot_urls_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 5 URLs per 10 min window sliding by 5 s."""
    hits = behaviour_events(spark, sf_dir).select(
        "ts", F.concat(F.lit("/item/"), F.col("k").cast("string")).alias("url"))
    return window_top_n(hits, "ts", "10 minutes", "5 seconds", keys=["url"], n=5).select(
        "window_end", "rank", "url", "cnt")


def hot_sale_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 books (k) by purchases per 600 s window sliding by 5 s.

    The reference windows on processing time; ``ts`` stands in for the ingest time.
    """
    sales = behaviour_events(spark, sf_dir).where(F.col("event_type") == "purchase").select(
        F.col("ts").alias("ingest_ts"), F.col("k").alias("book"))
    return window_top_n(sales, "ingest_ts", "600 seconds", "5 seconds", keys=["book"], n=3).select(
        "window_end", "rank", "book", "cnt")


def access_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every event as an access-log line and parse it back.

    Failed logins (``error``) are written without a user (``-``); purchases and
    signups are POSTs.
    """
    ev = behaviour_events(spark, sf_dir)
    u = F.col("user_id")
    ip = F.concat_ws(".", F.lit("10"), *[(F.floor(u / d) % 256).cast("string") for d in (65536, 256, 1)])
    line = format_access_line(
        ip, F.when(F.col("event_type") == "error", None).otherwise(u), F.col("ts"),
        F.when(F.col("event_type").isin("purchase", "signup"), "POST").otherwise("GET"),
        F.concat(F.lit("/item/"), F.col("k").cast("string")))
    parsed = parse_access_log(ev.select(line.alias("value")))
    good = parsed.where(F.col("_corrupt").isNull()).drop("_corrupt")
    return good.withColumn("user_id", F.col("user_id").try_cast("long"))


def page_views_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = window_count(_views(spark, sf_dir), "ts", "1 hour", count_col="pv")
    return counts.select("window_end", "pv")


def unique_visitors_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique_visitors(_views(spark, sf_dir), "ts", "user_id", "1 hour").select("window_end", "uv")


def unique_visitors_1h_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct users of page views per 1 h window sliding by 10 s."""
    return window_unique(_views(spark, sf_dir), "ts", "user_id", "1 hour", "10 seconds").select("window_end", "uv")


def unique_visitors_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitmap_visitors(_views(spark, sf_dir), "ts", "user_id", "1 hour").select("window_end", "uv")


def unique_visitors_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running_visitors(_views(spark, sf_dir), "ts", "user_id", "event_id", "1 hour")


def _marketing(spark, sf_dir):
    ev = behaviour_events(spark, sf_dir)
    names = F.array(*[F.lit(c) for c in CHANNELS])
    return ev.select("ts", F.element_at(names, (F.col("k") % len(CHANNELS)) + 1).alias("channel"),
                     F.col("event_type").alias("behavior"))


def marketing_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per (channel, behaviour), 1 h sliding by 1 min; uninstalls (errors) excluded."""
    m = _marketing(spark, sf_dir).where(~F.col("behavior").eqNullSafe("error"))
    return window_count(m, "ts", "1 hour", "1 minute", keys=["channel", "behavior"]).select(
        "window_start", "window_end", "channel", "behavior", "cnt")


def marketing_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, 1 h sliding by 1 min, no key (the sweep spreads it over time chunks)."""
    return window_count(_marketing(spark, sf_dir), "ts", "1 hour", "1 minute").select(
        "window_start", "window_end", "cnt")


AD_QUOTA = 1


def _ad_quota(spark, sf_dir):
    clicks = behaviour_events(spark, sf_dir).select("event_id", "ts", "user_id", F.col("k").alias("ad_id"))
    return quota_filter(clicks, ["user_id", "ad_id"], "ts", "event_id", max_count=AD_QUOTA)


def ad_quota_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, ad, day) triples that went over one click in a day (events are sparse here)."""
    return _ad_quota(spark, sf_dir).warnings.select("user_id", "ad_id", "day")


def ad_clicks_by_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks within quota per province (nation of ``user_id % 25``), 1 h sliding by 5 min."""
    kept = _ad_quota(spark, sf_dir).passed.withColumn("n_nationkey", (F.col("user_id") % 25).cast("int"))
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("province"))
    geo = kept.join(nation, "n_nationkey")
    return window_count(geo, "ts", "1 hour", "5 minutes", keys=["province"]).select(
        "window_end", "province", "cnt")


# ---------------------------------------------------------------- sequences

def _logins(spark, sf_dir):
    return behaviour_events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "value", "k")


def _fail():
    return F.col("event_type") == "error"


def login_fail_consecutive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A failure right after a failure of the same user, less than 12 h apart."""
    return consecutive(_logins(spark, sf_dir), "user_id", "ts", "event_id", _fail(), "12 hours")


def seq_adjacent_fails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern ``fail next fail within 2 h`` (no skip: overlapping pairs)."""
    return consecutive(_logins(spark, sf_dir), "user_id", "ts", "event_id", _fail(), "2 hours")


def login_fail_burst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of at least 2 failures opened by a failure and spanning 24 h, inside unbroken runs."""
    return burst(_logins(spark, sf_dir), "user_id", "ts", "event_id", _fail(), 2, "24 hours")


def seq_n_in_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any 3 events of a user within 6 h (overlapping)."""
    return n_in_span(_logins(spark, sf_dir), "user_id", "ts", "event_id", 3, "6 hours")


def seq_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-overlapping blocks of 6 events of a user within 36 h."""
    return blocks(_logins(spark, sf_dir), "user_id", "ts", "event_id", 6, "36 hours")


def seq_threshold_then_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event worth more than 100 points followed by the user's next event within 10 h."""
    return threshold_then_next(_logins(spark, sf_dir), "user_id", "ts", "event_id", "value", 100, "10 hours")


def seq_points_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's points of the last 2 days reach more than 300, followed by the user's next event."""
    return threshold_then_next(_logins(spark, sf_dir), "user_id", "ts", "event_id", "value", 300, "2 days",
                               mode="cumulative")


def _success():
    """Every event but ``error`` is a success."""
    return F.col("event_type") != "error"


def _accounts(spark, sf_dir, key, within, chain):
    m = follow_distinct(_logins(spark, sf_dir), key, "ts", "event_id", "user_id", 4, within, chain=chain, cond=_success())
    return m.withColumnRenamed("start_user_id", "start_user")


def seq_multi_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per item k: a success followed by 4 successes of other users than the first, within 1 day."""
    return _accounts(spark, sf_dir, "k", "1 day", False)


def seq_account_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per item k: five successes, each by another user than the one before, within 1 day."""
    return _accounts(spark, sf_dir, "k", "1 day", True)


def seq_multi_account_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`seq_multi_account` over all events without a key, within 15 min (the reference's form)."""
    return _accounts(spark, sf_dir, None, "15 minutes", False)


def seq_account_chain_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`seq_account_chain` over all events without a key, within 15 min (the reference's form)."""
    return _accounts(spark, sf_dir, None, "15 minutes", True)


def seq_pattern_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view, the user's next click worth more than that view, then a purchase of another item than the click, within 3 days."""
    kind = lambda k: F.col("event_type") == k
    steps = [Step("view", kind("view")), Step("click", kind("click"), where=[("value", ">", "view", "value")]),
             Step("purchase", kind("purchase"), where=[("k", "!=", "click", "k")])]
    return match_sequence(_logins(spark, sf_dir), "user_id", "ts", "event_id", steps, "3 days", {
        "view_id": ("view", "event_id"), "click_id": ("click", "event_id"), "purchase_id": ("purchase", "event_id"),
        "view_value": ("view", "value"), "click_value": ("click", "value"), "bought": ("purchase", "k")})


# ---------------------------------------------------------------- two streams

def _payments(spark, sf_dir):
    ev = behaviour_events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type")
    return payment_timeout(ev.where(F.col("event_type") == "signup"), ev.where(F.col("event_type") == "purchase"),
                           "user_id", "ts", "24 hours", keep=("event_id",))


def order_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups ("creates") paid by a purchase of the same user within 24 h."""
    return _payments(spark, sf_dir).paid


def order_payment_with_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`order_payment`, where a purchase counts only with a non-empty transaction id (a known item)."""
    ev = behaviour_events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type",
                                                F.when(F.col("k") % 2 == 0, F.col("k").cast("string")).otherwise("").alias("tx_id"))
    pays = ev.where((F.col("event_type") == "purchase") & (F.col("tx_id") != ""))
    return payment_timeout(ev.where(F.col("event_type") == "signup"), pays, "user_id", "ts", "24 hours").paid


def order_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups with no purchase within 24 h (open ones at the end of data included)."""
    return _payments(spark, sf_dir).timed_out


def _pay_receipt(spark, sf_dir):
    ev = behaviour_events(spark, sf_dir)
    pays = ev.where(F.col("event_type") == "view").select(
        "user_id", F.col("event_id").alias("pay_id"), F.col("ts").alias("pay_ts"))
    receipts = ev.where(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("receipt_id"), F.col("ts").alias("receipt_ts"))
    return pays, receipts


def tx_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views ("pays") and clicks ("receipts") of a user with click.ts in [view.ts - 3 h, view.ts + 5 h]."""
    pays, receipts = _pay_receipt(spark, sf_dir)
    return interval_join(pays, receipts, "user_id", "pay_ts", "receipt_ts", -3 * 3600, 5 * 3600).select(
        "user_id", "pay_id", "receipt_id", "pay_ts", "receipt_ts")


def tx_window_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views and clicks of a user in the same 1 h tumbling window."""
    pays, receipts = _pay_receipt(spark, sf_dir)
    return window_join(pays, receipts, "user_id", "pay_ts", "receipt_ts", "1 hour").select(
        "user_id", "pay_id", "receipt_id")


def tx_match_one_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views ("pays") and clicks ("receipts") matched one to one per user: one waiting slot a side, 5 h and 3 h."""
    ev = behaviour_events(spark, sf_dir).select("event_id", "user_id", "ts", "event_type")
    m = one_slot_match(ev.where(F.col("event_type") == "view"), ev.where(F.col("event_type") == "click"),
                       "user_id", "ts", "ts", "event_id", -3 * 3600, 5 * 3600,
                       left_only="unmatched_pay", right_only="unmatched_receipt")
    return m.withColumnsRenamed({"left_seq": "pay_id", "right_seq": "receipt_id"})


def tx_match_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders vs their first shipment: matched when shipped within [-15 d, +20 d] of the order."""
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderdate").alias("order_ts"))
    ships = (read_table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("order_key"))
             .agg(F.min("l_shipdate").alias("ship_ts")))
    m = outer_match(orders, ships, "order_key", "order_ts", "ship_ts", -15 * 86400, 20 * 86400,
                    left_only="unmatched_order", right_only="unmatched_shipment")
    return m.withColumnRenamed("left_ts", "order_ts").withColumnRenamed("right_ts", "ship_ts")


QUERIES = {
    "hot_item_counts": hot_item_counts,
    "hot_items_topn": hot_items_topn,
    "behaviour_counts_1h_10s": behaviour_counts_1h_10s,
    "behaviour_value_1h_10s": behaviour_value_1h_10s,
    "hot_urls_topn": hot_urls_topn,
    "hot_sale_topn": hot_sale_topn,
    "access_log_parse": access_log_parse,
    "page_views_hourly": page_views_hourly,
    "unique_visitors_hourly": unique_visitors_hourly,
    "unique_visitors_1h_10s": unique_visitors_1h_10s,
    "unique_visitors_bitmap": unique_visitors_bitmap,
    "unique_visitors_running": unique_visitors_running,
    "marketing_by_channel": marketing_by_channel,
    "marketing_total": marketing_total,
    "ad_quota_blacklist": ad_quota_blacklist,
    "ad_clicks_by_geo": ad_clicks_by_geo,
    "login_fail_consecutive": login_fail_consecutive,
    "login_fail_burst": login_fail_burst,
    "seq_adjacent_fails": seq_adjacent_fails,
    "seq_n_in_span": seq_n_in_span,
    "seq_blocks": seq_blocks,
    "seq_threshold_then_next": seq_threshold_then_next,
    "seq_points_cumulative": seq_points_cumulative,
    "seq_multi_account": seq_multi_account,
    "seq_account_chain": seq_account_chain,
    "seq_multi_account_all": seq_multi_account_all,
    "seq_account_chain_all": seq_account_chain_all,
    "seq_pattern_funnel": seq_pattern_funnel,
    "order_payment": order_payment,
    "order_payment_with_tx": order_payment_with_tx,
    "order_timeout": order_timeout,
    "tx_interval_join": tx_interval_join,
    "tx_match_outer": tx_match_outer,
    "tx_window_join": tx_window_join,
    "tx_match_one_slot": tx_match_one_slot,
}
