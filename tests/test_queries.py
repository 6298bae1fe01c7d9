"""How queries get their rows: what moves, what is built, what is read first."""

import contextlib
import io
import pathlib

from checks import queries
from ringwatch.operators import activity
from ringwatch.operators.activity import ActivityStore
from ringwatch.session import cut
from ringwatch.sources import tables

DATA = "/root/testdata/sf0.001"


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_drawn_edges_build_no_graph(spark, monkeypatch):
    def never(*_):
        raise AssertionError("the edges to draw need no wallets")

    monkeypatch.setattr(queries, "_graph_wallets", never)
    assert queries.draw_edges(spark, DATA).count() == 150


def test_counts_of_wallets_need_no_ranks(spark, monkeypatch):
    def never(*_):
        raise AssertionError("no rank is shown")

    queries.forget()
    monkeypatch.setattr(queries, "_ranks", never)
    assert queries.graph_summary(spark, DATA).first()["wallet_count"] == sum(r["n"] for r in queries.tier_counts(spark, DATA).collect())


def test_verdicts_need_no_second_pass_over_transfers(spark):
    """What the rules said comes along with the model's inputs instead of being worked out and joined again."""
    queries.forget()
    text = plan(queries.ml_verdict(spark, DATA))
    assert "Join" not in text and "events.parquet" not in text
    # The transfers that are judged are read; the windows are not worked out of them again.
    assert plan(queries.transfer_report(spark, DATA)).count("events.parquet") == 1
    assert queries.training_features(spark, DATA).columns == [*queries.store.EDGE_KEY, *queries.FEATURES]


def test_a_batch_of_activity_moves_once(spark, fresh_dir, monkeypatch):
    joined = []
    monkeypatch.setattr(activity, "cut", lambda df: joined.append(plan(df)) or cut(df))
    rows = [(f"w{i % 3}", "c", f"t{i}", i) for i in range(20)]
    transfers = spark.createDataFrame(rows, "wallet_address string, to_wallet string, tx_id string, s long").selectExpr(
        "wallet_address", "to_wallet", "tx_id", "timestamp_seconds(s) AS timestamp")
    with_broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # The second store is told another number of buckets than the table has.
        ActivityStore(spark, f"{fresh_dir}/activity", buckets=4).add(transfers, 0)
        kept = ActivityStore(spark, f"{fresh_dir}/activity", buckets=8)
        kept.add(transfers, 1)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_broadcast)
    assert [p.count("Exchange hashpartitioning") for p in joined] == [1, 1]
    assert sorted((r["wallet_address"], r["live_tx_count"]) for r in kept.activity().collect()) == [
        ("c", 0), ("w0", 7), ("w1", 7), ("w2", 6)]


def test_items_are_brought_to_their_lot_once(spark):
    assert plan(tables.lot_edges(spark, DATA)).count("Exchange hashpartitioning(l_partkey") == 1


def test_messages_are_written_in_order_of_time(spark, monkeypatch):
    """A stream takes its files by the time they were written; here the first is the longest to write."""
    folder = []
    monkeypatch.setattr(queries, "read_stream", lambda _, kind, path, **__: folder.append(path) or spark.read.text(path))
    rows = spark.range(4000).selectExpr(
        "concat('t', id, repeat('x', if(id < 1000, 20000, 1))) AS tx_id", "'a' AS wallet_address", "'b' AS to_wallet", "1.0D AS amount_usd",
        "0.1D AS gas_fee", "'normal' AS true_label", "timestamp_seconds(id * 3600) AS timestamp")
    queries._messages(spark, rows)
    files = sorted(pathlib.Path(folder[0].removeprefix("file:")).glob("*.txt"), key=lambda f: f.stat().st_mtime_ns)
    times = [spark.read.json(str(f)).agg({"timestamp": "min"}).first()[0] for f in files]
    assert len(times) == 4 and times == sorted(times)
    assert sum(spark.read.text(str(f)).count() for f in files) == 4000
