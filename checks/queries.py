"""The registered queries: each runs one operator or view over whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.config import FEATURES, RuleConfig, WindowConfig
from ringwatch.functions.scalars import unit_draw
from ringwatch.operators import evaluate as ev
from ringwatch.operators import forest as forests
from ringwatch.operators import store
from ringwatch.operators.activity import ActivityStore
from ringwatch.operators.enrich import build_context, enrich, graph_risk, structural_novelty
from ringwatch.operators.graph import louvain as lv
from ringwatch.operators.graph.betweenness import betweenness, sampled_betweenness
from ringwatch.operators.graph.fastrp import fastrp
from ringwatch.operators.graph.pagerank import pagerank, settled_ranks, update_ranks
from ringwatch.operators.graph.project import TransferGraph, collapse, distinct_pairs, node_set, sent_as_edges
from ringwatch.operators.graph.rings import find_rings, first_rings, ring_flags, with_new_rings
from ringwatch.operators.quantile import exact_quantile
from ringwatch.operators.rules import apply_rules, verdict, without_model
from ringwatch.operators.windows import pair_windows, pair_windows_by_pane
from ringwatch.plans import views
from ringwatch.plans.refresh import refresh_graph
from ringwatch.schema import TRANSFER
from ringwatch.session import cut, scratch_path
from ringwatch.sources import profiles, tables
from ringwatch.sources.transfers import decode, floor_amounts, read_stream, split_rejects, with_reject_reason
from ringwatch.streaming import detect

# The given events are about four minutes apart: windows and thresholds are scaled to them.
WINDOWS = WindowConfig(size="6 days", slide="1 day", watermark="60 days")
RULES = RuleConfig(large_amount=300.0, z_limit=2.0, z_min_samples=3, burst_count=8)
DAY = 86_400
FOREST = forests.ForestConfig(trees=50, rows_per_tree=256, height=8)
SPLIT_TIME = "2024-01-15 00:00:00"
PAGERANK_ROUNDS = 10
SETTLED_DAMPING = 0.5

_memo: dict[tuple, object] = {}


def _once(name: str, spark: SparkSession, sf_dir: str, make: Callable[[], object]):
    """Work that several queries share is done once per session and data folder."""
    key = (name, spark.sparkContext.applicationId, sf_dir)
    if key not in _memo:
        _memo[key] = make()
    return _memo[key]


def forget() -> None:
    _memo.clear()


def _text(column: str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(column, fmt).alias(column)


def _r(column, name: str | None = None, places: int = 6):
    expr = F.round(F.col(column) if isinstance(column, str) else column, places)
    return expr.alias(name or column)


# --- windows and rules -------------------------------------------------------------------------

def _judged(spark, d) -> DataFrame:
    return apply_rules(pair_windows(tables.event_transfers(spark, d), WINDOWS), RULES)


def _window_columns(df: DataFrame, *more) -> DataFrame:
    return df.select(
        "window_start", "wallet_address", "to_wallet", _r("mean_amount"), _r("stddev_amount"), "max_amount",
        _r("total_amount_usd", places=2), "tx_count", _r("avg_gas_fee"), "sample_tx_id", "true_label",
        _text("last_seen_ts"), *more)


def sliding_pair_stats(spark, d):
    return _window_columns(pair_windows(tables.event_transfers(spark, d), WINDOWS))


def sliding_pair_stats_by_pane(spark, d):
    return _window_columns(pair_windows_by_pane(tables.event_transfers(spark, d), 6 * DAY, DAY))


def rule_cascade(spark, d):
    return _window_columns(_judged(spark, d), _r("z_score"), "rule_reason")


def flagged_windows(spark, d):
    return rule_cascade(spark, d).filter("rule_reason IS NOT NULL")


def rule_reason_counts(spark, d):
    return views.value_counts(_judged(spark, d), "rule_reason")


# --- payloads, profiles, keys ------------------------------------------------------------------

def _payloads(spark, d) -> DataFrame:
    """Events as JSON messages; errors are cut short and sign-ups name no receiver."""
    t = tables.table(spark, d, "events")
    receiver = F.when(F.col("event_type") == "signup", "").otherwise(
        F.concat(F.lit('"to_wallet":"c_'), "event_type", F.lit('",')))
    end = F.when(F.col("event_type") == "error", "").otherwise("}")
    text = F.concat(
        F.lit('{"tx_id":"tx'), "event_id", F.lit('","wallet_address":"w'), "user_id", F.lit('",'), receiver,
        F.lit('"amount_usd":'), F.col("value").cast("string"),
        F.lit(',"gas_fee":'), F.get_json_object("props", "$.k"),
        F.lit(',"timestamp":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit('+00:00"'), end)
    return t.select(text.cast("binary").alias("value"))


def json_decode(spark, d):
    good, _ = split_rejects(decode(_payloads(spark, d), now=F.lit("1970-01-01").cast("timestamp")))
    return good.select(
        "tx_id", "wallet_address", "to_wallet", "amount_usd", "gas_fee",
        _text("timestamp", "yyyy-MM-dd HH:mm:ss.SSS"))


def floor_amounts_query(spark, d):
    return floor_amounts(tables.event_transfers(spark, d), 100.0).select("tx_id", "amount_usd")


def default_times(spark, d):
    """Messages without a time, which get the time of reading."""
    payloads = tables.table(spark, d, "events").select(F.concat(
        F.lit('{"tx_id":"tx'), "event_id", F.lit('","wallet_address":"w'), "user_id", F.lit('","to_wallet":"c"'),
        F.when(F.col("event_id") % 3 == 0, "").otherwise(F.concat(
            F.lit(',"timestamp":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit('+00:00"'))), F.lit("}")).alias("value"))
    decoded = decode(payloads)
    late = F.col("timestamp") > F.current_timestamp() - F.expr("INTERVAL 1 HOUR")
    return decoded.select("tx_id", F.when(late, "now").otherwise(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSS")).alias("timestamp"))


def reject_counts(spark, d):
    return views.value_counts(with_reject_reason(decode(_payloads(spark, d))), "reject_reason")


def profile_scan(spark, d):
    """Profiles written as header CSV and read back."""
    path = scratch_path(spark, "profiles")
    stamp = F.date_format("first_seen_ts", "yyyy-MM-dd HH:mm:ss'+00:00'").alias("first_seen_ts")
    tables.customer_profiles(spark, d).select(
        "wallet_address", stamp, "historical_tx_count", "historical_risk_tier").write.csv(path, header=True)
    return profiles.read_profiles(spark, path).withColumn("first_seen_ts", _text("first_seen_ts"))


def profile_upsert(spark, d):
    wallets = store.wallet_activity(tables.event_transfers(spark, d)).drop("last_seen_ts")
    merged = profiles.upsert_profiles(wallets, tables.customer_profiles(spark, d))
    return merged.select(
        "wallet_address", _text("first_seen_ts"), "historical_tx_count", "historical_risk_tier", "live_tx_count")


def wallet_activity(spark, d):
    return store.wallet_activity(tables.purchase_transfers(spark, d)).select(
        "wallet_address", _text("first_seen_ts"), _text("last_seen_ts"), "live_tx_count")


def wallet_activity_merged(spark, d):
    """The same from batches counted one by one: three months' sales, a batch that repeats a part of the first, and
    the second once more."""
    kept = ActivityStore(spark, scratch_path(spark, "activity"), buckets=8)
    transfers = cut(tables.purchase_transfers(spark, d).select("wallet_address", "to_wallet", "tx_id", "timestamp"))
    third = F.pmod(F.month("timestamp"), F.lit(3))
    batches = [transfers.filter(third == i) for i in range(3)]
    batches.append(batches[0].filter(F.dayofmonth("timestamp") <= 10))
    for batch_id in (0, 1, 2, 3, 1):
        kept.add(batches[batch_id], batch_id)
    return kept.activity().select("wallet_address", _text("first_seen_ts"), _text("last_seen_ts"), "live_tx_count")


def wallet_table(spark, d):
    activity = store.wallet_activity(tables.event_transfers(spark, d))
    return store.wallet_table(activity, tables.customer_profiles(spark, d)).select(
        "wallet_address", _text("first_seen_ts"), "historical_tx_count", "historical_risk_tier",
        "live_tx_count", _text("last_seen_ts"))


def missing_receivers(spark, d):
    """Profiles plus the receivers that have none."""
    known = tables.customer_profiles(spark, d)
    receivers = tables.event_transfers(spark, d).select(F.col("to_wallet").alias("wallet_address"))
    added = store.add_missing(known.withColumn("live_tx_count", F.lit(0).cast("long")), receivers)
    return added.select("wallet_address", "historical_tx_count", "historical_risk_tier", "live_tx_count")


def key_duplicates(spark, d):
    return profiles.duplicate_keys(tables.table(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


# --- stored edges and batches ------------------------------------------------------------------

def _versions(spark, d) -> DataFrame:
    """Two batches in update mode: all windows of the first half, then those that changed."""
    transfers = tables.event_transfers(spark, d)
    moment = F.lit(SPLIT_TIME).cast("timestamp")
    first = apply_rules(pair_windows(transfers.filter(F.col("timestamp") < moment), WINDOWS), RULES)
    both = apply_rules(pair_windows(transfers, WINDOWS), RULES)
    changed = both.filter(F.col("last_seen_ts") >= moment)
    return reduce(DataFrame.unionByName, [
        store.sent_rows(without_model(rows)).withColumn("batch_id", F.lit(i).cast("long"))
        for i, rows in enumerate([first, changed])])


def _edge_columns(df: DataFrame, *more) -> DataFrame:
    return df.select(
        "tx_id", "window_start", "wallet_address", "to_wallet", _r("amount_usd", places=2), _r("gas_fee"),
        "tx_count", _text("timestamp"), "true_label", _r("z_score"), "anomaly_reason", *more)


def edge_latest(spark, d):
    return _edge_columns(store.current_edges(_versions(spark, d)), "batch_id")


def batch_metrics(spark, d):
    return views.batch_metrics(_versions(spark, d))


def metrics_summary(spark, d):
    sent = _versions(spark, d)
    return views.metrics_summary(views.batch_metrics(sent), views.last_batch(sent)).drop("recent_records")


def metrics_recent_records(spark, d):
    """The rows that the summary lists, taken out of it."""
    sent = _versions(spark, d)
    summary = views.metrics_summary(views.batch_metrics(sent), views.last_batch(sent))
    return _edge_columns(summary.select(F.inline("recent_records")), "batch_id")


def recent_batch_rows(spark, d):
    return _edge_columns(views.recent_rows(_versions(spark, d)), "batch_id")


def _messages(spark, *parts: DataFrame) -> DataFrame:
    """Transfers as JSON messages, part after part in up to four files each, read as a stream of one file at a time.

    A stream takes files by the time they were written, so a file is written after those of earlier transfers;
    otherwise the watermark could pass transfers that are still to be read.
    """
    source = scratch_path(spark, "payloads")
    json = F.to_json(F.struct(*TRANSFER.fieldNames()), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    for part in parts:
        ranged = part.select("timestamp", json.alias("value")).repartitionByRange(4, "timestamp")
        messages = cut(ranged.select("value", F.spark_partition_id().alias("file")))
        for number in range(4):
            messages.filter(F.col("file") == number).select("value").coalesce(1).write.mode("append").text(source)
    return split_rejects(decode(read_stream(spark, "text", source, maxFilesPerTrigger="1")))[0]


def stream_detection(spark, d):
    """The streaming job itself on JSON messages, read in several micro-batches; latest edge versions."""
    good, root = _messages(spark, tables.event_transfers(spark, d)), scratch_path(spark, "detection")
    settings = detect.Settings(root, RULES, WINDOWS, trigger={"availableNow": True})
    query = detect.start_detection(good, settings)
    query.awaitTermination()
    return _edge_columns(store.current_edges(detect.stored_edges(spark, settings)))


def stream_detection_final(spark, d):
    """The streaming job that stores each window once, from panes. A last transfer two months on closes all windows."""
    t = cut(tables.event_transfers(spark, d))
    last = t.select(F.max("timestamp").alias("timestamp")).select(
        F.lit("end").alias("tx_id"), F.lit("end").alias("wallet_address"), F.lit("end").alias("to_wallet"),
        F.lit(0.0).alias("amount_usd"), F.lit(0.0).alias("gas_fee"), F.lit("normal").alias("true_label"),
        (F.col("timestamp") + F.expr("INTERVAL 130 DAYS")).alias("timestamp"))
    settings = detect.Settings(scratch_path(spark, "detection"), RULES, WINDOWS, trigger={"availableNow": True}, final_only=True)
    detect.start_detection(_messages(spark, t, last), settings).awaitTermination()
    return _edge_columns(detect.stored_edges(spark, settings).filter("wallet_address <> 'end'"))


def stream_detection_scored(spark, d):
    """The streaming job with context and model: what it stores of every window in the end."""
    root = scratch_path(spark, "detection")
    settings = detect.Settings(root, RULES, WINDOWS, graph_root=f"{root}/graph", trigger={"availableNow": True})
    store.save_snapshot(_context(spark, d), f"{root}/graph/context", 1)
    good = _messages(spark, tables.event_transfers(spark, d))
    detect.start_detection(good, settings, _model(spark, d)[1]).awaitTermination()
    edges = store.current_edges(detect.stored_edges(spark, settings))
    return edges.select(*store.EDGE_KEY, "tx_count", _r("ml_score", places=4), "ml_anomaly", "anomaly_reason")


def recent_edges(spark, d):
    sent = store.sent_rows(without_model(_judged(spark, d)))
    return views.recent_edges(sent).select(
        "from_wallet", "to_wallet", _r("amount_usd", places=2), "anomaly_reason", _text("timestamp"))


def transaction_listing(spark, d):
    sent = store.sent_rows(without_model(_judged(spark, d)))
    return views.transaction_listing(sent).select(
        "tx_id", "wallet_address", "to_wallet", _r("amount_usd", places=2), _r("gas_fee"), "anomaly_reason",
        _r("z_score"), "ml_score", "ml_anomaly", _text("timestamp"))


# --- context and scoring -----------------------------------------------------------------------

def _profile_wallets(spark, d) -> DataFrame:
    """Customers with stand-ins for graph results, so that the context can be checked on its own."""
    customers = tables.table(spark, d, "customer").select(
        F.concat(F.lit("w"), "c_custkey").alias("wallet_address"), "c_custkey", "c_nationkey", "c_acctbal")
    vectors = tables.table(spark, d, "embeddings").select(F.col("vec_id").alias("c_custkey"), "embedding")
    return (
        tables.customer_profiles(spark, d).join(customers, "wallet_address").join(vectors, "c_custkey", "left")
        .select(
            "wallet_address", "historical_tx_count", "historical_risk_tier",
            F.lit(None).cast("long").alias("live_tx_count"),
            (F.col("historical_tx_count") / 10.0).alias("pagerank"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("betweenness"),
            F.when(F.col("c_nationkey") > 0, F.col("c_nationkey")).alias("community_id"),
            F.when(F.col("historical_risk_tier") != "low", F.col("historical_risk_tier") == "high")
            .alias("in_wash_ring"),
            "embedding"))


def _context(spark, d) -> DataFrame:
    rounded = {c: F.round(c, 6) for c in ("graph_risk_score", "structural_novelty_score")}
    wallets = _once("profile_wallets", spark, d, lambda: cut(_profile_wallets(spark, d)))
    return build_context(wallets).withColumns(rounded)


def wallet_context(spark, d):
    return _context(spark, d)


def structural_novelty_query(spark, d):
    return structural_novelty(tables.table(spark, d, "embeddings")).select(
        "vec_id", _r("structural_novelty_score"))


def enrich_left(spark, d):
    joined = enrich(_judged(spark, d), _context(spark, d))
    return joined.select(
        "window_start", "wallet_address", "to_wallet", "tx_count", "historical_tx_count", "historical_risk_tier",
        "live_tx_count", "community_id", "in_wash_ring", "graph_risk_score", "structural_novelty_score")


def _features(spark, d, *keep: str) -> DataFrame:
    """Model inputs of all windows, rounded so that every engine trains on the same numbers."""
    sent = store.sent_rows(without_model(_judged(spark, d)))
    rows = forests.training_features(sent, _context(spark, d), keep=keep)
    return rows.withColumns({c: F.round(c, 6) for c in FEATURES})


def training_features(spark, d):
    return _features(spark, d)


def _model(spark, d) -> tuple[DataFrame, forests.Forest]:
    def make():
        rows = cut(_features(spark, d, "anomaly_reason"))
        return rows, forests.fit(rows, store.EDGE_KEY, FOREST)
    return _once("model", spark, d, make)


def _scored(spark, d) -> DataFrame:
    rows, forest = _model(spark, d)
    return _once("scored", spark, d, lambda: cut(forests.score(rows, forest)))


def _verdicts(spark, d) -> DataFrame:
    """All windows with the verdicts of rules and model. What the rules said has come along with the model's inputs;
    a window without a sender or a receiver is no edge."""
    edges = _scored(spark, d).dropna(subset=store.EDGE_KEY)
    return verdict(edges.withColumnRenamed("anomaly_reason", "rule_reason"))


def forest_nodes(spark, d):
    return _model(spark, d)[1].nodes.select("tree", "node", "feature", _r("split"), "size", "depth")


def forest_scores(spark, d):
    """Raw scores without the cut-off, per window."""
    offset = _model(spark, d)[1].offset
    return _scored(spark, d).select(*store.EDGE_KEY, _r(F.col("ml_score") + offset, "raw_score"))


def forest_reloaded(spark, d):
    """Raw scores of the model after it was saved and loaded."""
    rows, forest = _model(spark, d)
    path = scratch_path(spark, "model")
    forests.save(forest, path)
    again = forests.load(spark, path)
    return forests.score(rows, again).select(*store.EDGE_KEY, _r(F.col("ml_score") + again.offset, "raw_score"))


def score_cutoff(spark, d):
    """The exact quantile that the contamination share sets, by narrowing down to few values."""
    value = exact_quantile(tables.event_transfers(spark, d), "amount_usd", FOREST.contamination, small=500)
    return spark.range(1).select(F.round(F.lit(value), 6).alias("cutoff"))


def forest_summary(spark, d):
    s = forests.score_summary(_scored(spark, d))
    return s.select("n_rows", "n_flagged", *[_r(c) for c in ("flagged_share", "min_score", "max_score", "mean_score")])


def ml_verdict(spark, d):
    """Reasons after model and rules, counted."""
    return _verdicts(spark, d).groupBy("anomaly_reason", "ml_anomaly").agg(F.count(F.lit(1)).alias("n"))


# --- graph -------------------------------------------------------------------------------------

def _purchases(spark, d) -> DataFrame:
    return sent_as_edges(tables.purchase_transfers(spark, d)).withColumn("w", F.col("w").cast("decimal(18,2)"))


def edge_collapse(spark, d):
    return collapse(_purchases(spark, d)).select("src", "dst", _r("w", places=2), "n")


def edge_dedup(spark, d):
    return distinct_pairs(_purchases(spark, d))


def graph_nodes(spark, d):
    return node_set(_purchases(spark, d))


def _graph(spark, d) -> TransferGraph:
    return _once("graph", spark, d, lambda: TransferGraph(tables.lot_edges(spark, d)))


def _ranks(spark, d) -> DataFrame:
    return _once("ranks", spark, d, lambda: cut(pagerank(_graph(spark, d), rounds=PAGERANK_ROUNDS, tolerance=None)))


def pagerank_k(spark, d):
    return _ranks(spark, d).select("node", _r("pagerank"))


def pagerank_purchases(spark, d):
    """Ranks on the larger, two-sided graph of purchases, with the default stop rule."""
    return pagerank(TransferGraph(_purchases(spark, d))).select("node", _r("pagerank"))


def _rings(spark, d) -> DataFrame:
    return _once("rings", spark, d, lambda: cut(find_rings(_graph(spark, d).pairs, mode="simple")))


def rings_simple(spark, d):
    return _rings(spark, d).select("ring_id", "ring_key", "start_address", "ring_length")


def rings_trail(spark, d):
    return find_rings(_graph(spark, d).pairs, mode="trail").select(
        "ring_id", "ring_key", "start_address", "ring_length")


def rings_first_100(spark, d):
    return first_rings(find_rings(_graph(spark, d).pairs, mode="trail"), 100).select(
        "ring_id", "ring_key", "start_address", "ring_length")


def _flags(spark, d) -> DataFrame:
    return ring_flags(_graph(spark, d).nodes, _rings(spark, d))


def ring_flags_query(spark, d):
    return _flags(spark, d)


def _flagged_wallets(spark, d) -> DataFrame:
    """Customers with profile and ring flags; the nation stands in for the community."""
    nations = tables.table(spark, d, "customer").select(
        F.concat(F.lit("cu"), "c_custkey").alias("wallet_address"),
        F.col("c_nationkey").cast("long").alias("community_id"))
    flags = _flags(spark, d).withColumnRenamed("node", "wallet_address")
    return tables.customer_profiles(spark, d, "cu").join(nations, "wallet_address").join(flags, "wallet_address", "left")


def _graph_wallets(spark, d) -> DataFrame:
    """The same customers with their rank."""
    def make():
        ranks = _ranks(spark, d).withColumnRenamed("node", "wallet_address")
        return cut(_flagged_wallets(spark, d).join(ranks, "wallet_address", "left").withColumn("pagerank", F.round("pagerank", 6)))
    return _once("wallets", spark, d, make)


def wash_rings(spark, d):
    return views.wash_rings(_graph_wallets(spark, d)).withColumn("wallets", F.array_join("wallets", ","))


def top_risk_wallets(spark, d):
    return views.top_risk_wallets(_graph_wallets(spark, d))


def wallet_listing(spark, d):
    return views.wallet_listing(_graph_wallets(spark, d)).withColumn("first_seen_ts", _text("first_seen_ts"))


def tier_counts(spark, d):
    return views.tier_counts(_flagged_wallets(spark, d))


def graph_summary(spark, d):
    return views.graph_summary(cut(_flagged_wallets(spark, d)), tables.purchase_transfers(spark, d))


def _drawn_edges(spark, d):
    return views.recent_edges(store.sent_rows(without_model(_judged(spark, d))))


def draw_nodes(spark, d):
    wallets = _graph_wallets(spark, d)
    top, rings = views.top_risk_wallets(wallets, 15), views.wash_rings(wallets)
    return views.draw_nodes(top, rings, _drawn_edges(spark, d)).withColumn("size", F.round("size", 4))


def draw_edges(spark, d):
    """The newest edges as they are drawn; what the wallets are known for does not show on them."""
    return views.draw_edges(_drawn_edges(spark, d)).select(
        "from_wallet", "to_wallet", _text("timestamp"), _r("amount_usd", places=2), "edge_class", "width")


def graph_risk_query(spark, d):
    wallets = _ranks(spark, d).join(_flags(spark, d), "node").join(
        _graph(spark, d).nodes.select("node", F.col("out_degree").cast("double").alias("betweenness")), "node")
    return graph_risk(cut(wallets)).select("node", _r("graph_risk_score"))


def betweenness_query(spark, d):
    return betweenness(_graph(spark, d)).select("node", _r("betweenness", places=4))


def betweenness_bound(spark, d):
    """Whether the estimate from a part of the sources keeps its promise for each wallet."""
    exact = betweenness(_graph(spark, d)).withColumnRenamed("betweenness", "exact")
    return sampled_betweenness(_graph(spark, d), error=0.3).join(exact, "node").select(
        "node", _r("exact", "betweenness", 4), (F.abs(F.col("betweenness") - F.col("exact")) <= F.col("bound") + 1e-6).alias("within"))


def pagerank_updated(spark, d):
    """Ranks settled on most edges, then updated by the rest."""
    pairs = _graph(spark, d).pairs
    before = TransferGraph.of_pairs(pairs.filter(unit_draw(F.col("src"), F.col("dst"), "old") >= 0.01))
    state = settled_ranks(before, damping=SETTLED_DAMPING, least=1e-8)
    updated, _ = update_ranks(state, before.pairs, _graph(spark, d), damping=SETTLED_DAMPING, least=1e-8)
    return updated.select("node", _r("pagerank", places=4))


def rings_updated(spark, d):
    """Rings of most edges, and those that the rest closes."""
    pairs = _graph(spark, d).pairs
    old = unit_draw(F.col("src"), F.col("dst"), "old") >= 0.05
    before, added = pairs.filter(old), pairs.filter(~old)
    return with_new_rings(find_rings(before, "simple"), before, added, "simple").select(
        "ring_id", "ring_key", "start_address", "ring_length")


def refreshed_context(spark, d):
    """The whole refresh: all graph results on the stored transfers, published as a snapshot and read back."""
    root = scratch_path(spark, "refresh")
    sent = tables.lot_edges(spark, d).select(
        F.col("src").alias("wallet_address"), F.col("dst").alias("to_wallet"), F.col("w").alias("amount_usd"))
    wallets = tables.customer_profiles(spark, d, "cu").withColumn("live_tx_count", F.lit(None).cast("long"))
    refresh_graph(sent, wallets, root, version=1, ring_mode="simple")
    context, _ = store.current_snapshot(spark, f"{root}/context")
    return context.select(
        "wallet_address", "historical_tx_count", "historical_risk_tier", "live_tx_count", _r("pagerank"), _r("betweenness", places=4),
        (F.col("community_id") >= 0).alias("in_community"), "in_wash_ring", _r("graph_risk_score", places=5),
        _r("structural_novelty_score", places=5))


def fastrp_query(spark, d):
    e = fastrp(_graph(spark, d))
    return e.select("node", *[_r(F.get("embedding", F.lit(i)), f"e{i}") for i in range(8)])


def _two_rounds(spark, d) -> tuple[DataFrame, DataFrame]:
    def make():
        edges = cut(lv.symmetric(_graph(spark, d).pairs))
        two_m = edges.agg(F.sum("w")).first()[0]
        labels = cut(lv.first_labels(edges))
        for number in range(2):
            labels = cut(lv.move_round(edges, labels.select("node", "k", "community"), two_m, number))
        return edges, labels.select("node", "community")
    return _once("two_rounds", spark, d, make)


def louvain_two_rounds(spark, d):
    return _two_rounds(spark, d)[1]


def modularity(spark, d):
    return lv.modularity_frame(*_two_rounds(spark, d)).select(_r("modularity"))


def _communities(spark, d) -> tuple[DataFrame, DataFrame]:
    return _once("communities", spark, d, lambda: lv.communities(_graph(spark, d)))


def louvain(spark, d):
    return lv.numbered(_communities(spark, d)[0])


def louvain_faults(spark, d):
    """What must hold of the communities: none in pieces, no wallet better off elsewhere, no state worse than the one before."""
    return lv.faults(_graph(spark, d), *_communities(spark, d))


# --- evaluation --------------------------------------------------------------------------------

def _labelled(spark, d) -> DataFrame:
    """Document labels as a detection problem: length and quality stand in for the detectors."""
    docs = tables.table(spark, d, "documents").select("doc_id", "n_chars")
    return tables.table(spark, d, "labels").join(docs, "doc_id").select(
        F.col("toxic").alias("y_true"),
        F.when(F.col("n_chars") > 2000, 1).otherwise(0).alias("y_rule"),
        F.when(F.col("quality") == 0, 1).otherwise(0).alias("y_ml"),
        F.when((F.col("n_chars") > 2000) | (F.col("quality") == 0), 1).otherwise(0).alias("y_combined"))


_DETECTORS = {"rule_based": "y_rule", "isolation_forest": "y_ml", "combined": "y_combined"}


def confusion(spark, d):
    return ev.confusion(_labelled(spark, d), _DETECTORS)


def detector_report(spark, d):
    return ev.report(ev.confusion(_labelled(spark, d), _DETECTORS)).withColumn("value", F.round("value", 6))


def _window_edges(spark, d) -> DataFrame:
    return store.sent_rows(without_model(_judged(spark, d)))


def latest_labelled(spark, d):
    return ev.with_indicators(ev.latest_labelled(_window_edges(spark, d), limit=2000)).select(
        "window_start", "wallet_address", "to_wallet", "true_label", "y_true", "y_rule", "y_ml", "y_combined")


def window_report(spark, d):
    """Rules against the labels of all windows."""
    return ev.evaluate(_window_edges(spark, d), limit=None)[2].withColumn("value", F.round("value", 6))


def window_report_scored(spark, d):
    """Rules, model and both against the labels of all windows, with the verdicts of the grown forest."""
    # Labels are texts, which the windows' aggregate has to sort for; only this query needs them.
    labels = _judged(spark, d).select(*store.EDGE_KEY, "true_label")
    return ev.evaluate(_verdicts(spark, d).join(labels, store.EDGE_KEY))[2].withColumn("value", F.round("value", 6))


def report_written(spark, d):
    """The report with its label counts as it is read back from the JSON sink."""
    path = scratch_path(spark, "report")
    ev.write_report(_window_edges(spark, d), path)
    return spark.read.schema("detector string, class string, metric string, value double").json(path).withColumn(
        "value", F.round("value", 6))


def transfer_report(spark, d):
    """Rules, model and both against the labels of all transfers, each judged by the windows that cover it."""
    return ev.evaluate_transfers(tables.event_transfers(spark, d), _verdicts(spark, d), 6 * DAY, DAY).withColumn("value", F.round("value", 6))


def label_counts(spark, d):
    return ev.evaluate(_window_edges(spark, d), limit=None)[0]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sliding_pair_stats": sliding_pair_stats,
    "sliding_pair_stats_by_pane": sliding_pair_stats_by_pane,
    "rule_cascade": rule_cascade,
    "flagged_windows": flagged_windows,
    "rule_reason_counts": rule_reason_counts,
    "json_decode": json_decode,
    "floor_amounts": floor_amounts_query,
    "default_times": default_times,
    "reject_counts": reject_counts,
    "profile_scan": profile_scan,
    "profile_upsert": profile_upsert,
    "wallet_activity": wallet_activity,
    "wallet_activity_merged": wallet_activity_merged,
    "wallet_table": wallet_table,
    "missing_receivers": missing_receivers,
    "key_duplicates": key_duplicates,
    "edge_latest": edge_latest,
    "batch_metrics": batch_metrics,
    "metrics_summary": metrics_summary,
    "metrics_recent_records": metrics_recent_records,
    "recent_batch_rows": recent_batch_rows,
    "stream_detection": stream_detection,
    "stream_detection_final": stream_detection_final,
    "stream_detection_scored": stream_detection_scored,
    "recent_edges": recent_edges,
    "transaction_listing": transaction_listing,
    "wallet_context": wallet_context,
    "structural_novelty": structural_novelty_query,
    "enrich_left": enrich_left,
    "training_features": training_features,
    "forest_nodes": forest_nodes,
    "forest_scores": forest_scores,
    "forest_reloaded": forest_reloaded,
    "score_cutoff": score_cutoff,
    "forest_summary": forest_summary,
    "ml_verdict": ml_verdict,
    "edge_collapse": edge_collapse,
    "edge_dedup": edge_dedup,
    "graph_nodes": graph_nodes,
    "pagerank_k": pagerank_k,
    "pagerank_purchases": pagerank_purchases,
    "rings_simple": rings_simple,
    "rings_trail": rings_trail,
    "rings_first_100": rings_first_100,
    "ring_flags": ring_flags_query,
    "wash_rings": wash_rings,
    "top_risk_wallets": top_risk_wallets,
    "wallet_listing": wallet_listing,
    "tier_counts": tier_counts,
    "graph_summary": graph_summary,
    "draw_nodes": draw_nodes,
    "draw_edges": draw_edges,
    "graph_risk": graph_risk_query,
    "betweenness": betweenness_query,
    "betweenness_bound": betweenness_bound,
    "pagerank_updated": pagerank_updated,
    "rings_updated": rings_updated,
    "refreshed_context": refreshed_context,
    "fastrp": fastrp_query,
    "louvain_two_rounds": louvain_two_rounds,
    "modularity": modularity,
    "louvain": louvain,
    "louvain_faults": louvain_faults,
    "confusion": confusion,
    "detector_report": detector_report,
    "latest_labelled": latest_labelled,
    "window_report": window_report,
    "window_report_scored": window_report_scored,
    "report_written": report_written,
    "transfer_report": transfer_report,
    "label_counts": label_counts,
}
