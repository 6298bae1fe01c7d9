import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from ringwatch.config import RuleConfig, WindowConfig
from ringwatch.operators import evaluate, store
from ringwatch.operators.activity import ActivityStore
from ringwatch.operators.enrich import enrich
from ringwatch.operators.rules import apply_rules, without_model
from ringwatch.operators.windows import pair_windows
from ringwatch.plans import views
from ringwatch.schema import CONTEXT, PROFILE, TRANSFER
from ringwatch.sources.profiles import require_unique, upsert_profiles
from ringwatch.sources.transfers import decode, read_stream, split_rejects
from ringwatch.streaming import detect

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def payload(i, sender, receiver, amount, second):
    return json.dumps({
        "tx_id": f"t{i}", "wallet_address": sender, "to_wallet": receiver, "amount_usd": amount, "gas_fee": 0.01,
        "true_label": "normal", "timestamp": (T0 + dt.timedelta(seconds=second)).isoformat(timespec="milliseconds") + "+00:00"})


def write_files(folder, files):
    os.makedirs(folder)
    for n, lines in enumerate(files):
        path = f"{folder}/{n:03d}.txt"
        with open(path, "w") as f:
            f.write("\n".join(lines))
        os.utime(path, (time.time() - 1000 + n, time.time() - 1000 + n))


def run(query):
    query.awaitTermination()
    return query


FILES = [
    [payload(i, f"w{i % 3}", "c", 10.0 + i, i) for i in range(30)] + ["garbage"],
    [payload(100 + i, "w0", "c", 20.0, 31) for i in range(10)] + [payload(300, "w1", "c", 500_000.0, 35)],
    [payload(400 + i, f"w{i % 3}", "c", 5.0, 300 + i) for i in range(6)],
    [payload(450, "w1", "c", 6.0, 310)],  # rows are judged late by the watermark of the batch before
    [payload(500, "w2", "c", 7.0, 2)],
]


def test_stream_equals_batch_and_drops_late_rows(spark, fresh_dir):
    write_files(f"{fresh_dir}/in", FILES)
    settings = detect.Settings(f"{fresh_dir}/out", trigger={"availableNow": True})
    decoded = decode(read_stream(spark, "text", f"{fresh_dir}/in", maxFilesPerTrigger="1"))
    query = run(detect.start_detection(split_rejects(decoded)[0], settings))
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped == 6  # the last file is late for all of its six windows

    run(detect.start_archive(decoded, settings))
    archive = detect.stored_transfers(spark, settings).select(*TRANSFER.fieldNames())
    assert archive.count() == 49
    rejects = spark.read.parquet(settings.path("rejects"))
    assert [r["reject_reason"] for r in rejects.collect()] == ["malformed_payload"]

    on_time = archive.filter("tx_id <> 't500'")
    batch = store.sent_rows(without_model(apply_rules(pair_windows(on_time))))
    columns = [c for c in batch.columns if c not in ("amount_usd", "gas_fee", "z_score")] + [
        F.round(c, 8).alias(c) for c in ("amount_usd", "gas_fee", "z_score")]
    live = store.current_edges(detect.stored_edges(spark, settings)).select(*columns)
    expected = batch.select(*columns)
    assert live.count() == expected.count()
    assert live.exceptAll(expected).isEmpty()
    assert {"LARGE_SINGLE_TRANSACTION", "BOT_BURST_HIGH_FREQUENCY"} <= {
        r[0] for r in live.select("anomaly_reason").distinct().collect()}

    row = detect.summary(spark, settings).first()
    edges = detect.stored_edges(spark, settings)
    newest = edges.agg(F.max("batch_id")).first()[0]
    assert row["status"] == "active" and row["recent_batch_record_count"] == edges.filter(F.col("batch_id") == newest).count()
    assert row["total_processed"] == detect.stored_edges(spark, settings).count()


def judged(spark, n=12):
    rows = [(f"t{i}", f"w{i % 2}", "c", float(i), 0.1, "normal", T0 + dt.timedelta(seconds=i)) for i in range(n)]
    return apply_rules(pair_windows(spark.createDataFrame(rows, TRANSFER), WindowConfig()), RuleConfig())


def test_replayed_batch_replaces_itself_and_context_is_current(spark, fresh_dir):
    settings = detect.Settings(f"{fresh_dir}/out", graph_root=f"{fresh_dir}/graph")
    batch = judged(spark)
    for _ in range(2):
        detect.process_batch(batch, 7, settings, None)
    detect.process_batch(batch.limit(0), 8, settings, None)
    assert detect.stored_edges(spark, settings).count() == batch.count()
    metrics = detect.stored_metrics(spark, settings).collect()
    assert [(r["batch_id"], r["groups_updated"]) for r in metrics] == [(7, batch.count())]

    assert detect.score_batch(batch, settings, None).filter("pagerank IS NOT NULL").isEmpty()
    context = spark.createDataFrame([("w0", 1, "low", 2, 0.5, 0.0, 3, True, 0.9, 0.1)], CONTEXT)
    store.save_snapshot(context, f"{fresh_dir}/graph/context", 1)
    scored = detect.score_batch(batch, settings, None)
    assert {(r["wallet_address"], r["graph_risk_score"]) for r in scored.collect()} == {("w0", 0.9), ("w1", None)}
    assert "BroadcastHashJoin" in scored._jdf.queryExecution().executedPlan().toString()


def test_empty_stores_read_as_empty(spark, fresh_dir):
    settings = detect.Settings(f"{fresh_dir}/nothing")
    assert detect.stored_edges(spark, settings).isEmpty()
    row = detect.summary(spark, settings).first()
    assert (row["status"], row["total_processed"], row["last_batch_id"]) == ("initializing", 0, None)
    assert store.current_snapshot(spark, f"{fresh_dir}/nothing") is None


def test_compaction_keeps_the_latest_versions(spark, fresh_dir):
    rows = store.sent_rows(without_model(judged(spark)))
    for i in range(3):
        store.write_batch(rows.withColumn("tx_count", F.lit(i).cast("long")), f"{fresh_dir}/sent", i)
    store.compact(spark, f"{fresh_dir}/sent", f"{fresh_dir}/sent2", 1)
    after = store.read_batches(spark, f"{fresh_dir}/sent2")
    assert after.count() == 2 * rows.count()
    assert {r[0] for r in store.current_edges(after).select("tx_count").distinct().collect()} == {2}


def test_snapshots_switch_versions(spark, fresh_dir):
    for version in (1, 2):
        store.save_snapshot(spark.range(version).toDF("n"), f"{fresh_dir}/s", version)
    df, rows = store.current_snapshot(spark, f"{fresh_dir}/s")
    assert df.count() == rows == 2


def test_activity_counts_a_transfer_once(spark):
    rows = [("t1", "a", "b", 1.0, 0.0, None, T0), ("t1", "a", "b", 1.0, 0.0, None, T0),
            ("t2", "a", "c", 1.0, 0.0, None, T0 + dt.timedelta(hours=1))]
    got = {r["wallet_address"]: r for r in store.wallet_activity(spark.createDataFrame(rows, TRANSFER)).collect()}
    assert got["a"]["live_tx_count"] == 2 and got["a"]["last_seen_ts"] == T0 + dt.timedelta(hours=1)
    assert got["b"]["live_tx_count"] == 0 and got["b"]["first_seen_ts"] is None


def test_profiles_upsert_and_unique_keys(spark):
    wallets = spark.createDataFrame([("a", T0, 5, "low", 9), ("b", T0, 6, "low", 8)],
                                    "wallet_address string, first_seen_ts timestamp, historical_tx_count long,"
                                    "historical_risk_tier string, live_tx_count long")
    new = spark.createDataFrame([("a", None, 50, "high"), ("c", T0, 1, "medium")], PROFILE)
    got = {r["wallet_address"]: tuple(r)[1:] for r in upsert_profiles(wallets, new).collect()}
    assert got["a"] == (None, 50, "high", 9) and got["b"] == (T0, 6, "low", 8) and got["c"] == (T0, 1, "medium", None)
    with pytest.raises(ValueError):
        require_unique(new.union(new), "wallet_address")
    assert require_unique(new, "wallet_address") is new


def test_report_without_hits_divides_by_nothing(spark, fresh_dir):
    edges = spark.createDataFrame(
        [(T0, "normal", None, False)] * 3 + [(None, None, None, None)],
        "timestamp timestamp, true_label string, anomaly_reason string, ml_anomaly boolean").withColumns(
        {c: F.lit("k") for c in store.EDGE_KEY})
    labels, matrix, report = evaluate.evaluate(edges)
    assert {r["detector"]: (r["tn"], r["fp"], r["fn"], r["tp"]) for r in matrix.collect()} == {
        d: (3, 0, 0, 0) for d in ("rule_based", "isolation_forest", "combined")}
    values = {(r["class"], r["metric"]): r["value"] for r in report.filter("detector = 'combined'").collect()}
    assert values["anomaly", "precision"] == values["anomaly", "f1"] == 0 and values["normal", "f1"] == 1
    assert values["macro", "f1"] == 0.5 and values["weighted", "f1"] == values["all", "accuracy"] == 1
    evaluate.write_report(edges, f"{fresh_dir}/report")
    assert spark.read.json(f"{fresh_dir}/report").count() == 3 * 17 + 1


def test_json_rendering_and_labels(spark):
    df = spark.createDataFrame([(T0, "0x0123456789abcdef"), (None, None)], "t timestamp, a string")
    assert json.loads(views.as_json(df).first()["value"])["t"] == "2024-01-01T12:00:00.000Z"
    from ringwatch.functions.scalars import short_address
    assert [r[0] for r in df.select(short_address(F.col("a"))).collect()] == ["0x012345…cdef", "unknown"]


def test_a_broken_or_replaced_attempt_is_not_seen(spark, fresh_dir):
    rows = store.sent_rows(without_model(judged(spark)))
    root = f"{fresh_dir}/sent"
    store.write_batch(rows, root, 0)
    # An attempt that was broken off: files, but no record.
    rows.write.parquet(f"{root}/batch_id=0/attempt=9")
    assert store.read_batches(spark, root).count() == rows.count()
    store.write_batch(rows.limit(3), root, 0)
    assert store.read_batches(spark, root).count() == 3


def test_batches_written_during_a_compaction_stay(spark, fresh_dir, monkeypatch):
    rows, root = store.sent_rows(without_model(judged(spark))), f"{fresh_dir}/sent"
    n = rows.count()
    version = lambda i: rows.withColumn("tx_count", F.lit(i).cast("long"))
    for i in range(3):
        store.write_batch(version(i), root, i)
    plain = store._record

    def late(spark_, root_, row):
        # While the compaction is being written, batch 3 comes in and batch 1 is written again.
        monkeypatch.setattr(store, "_record", plain)
        store.write_batch(version(3), root, 3)
        store.write_batch(version(1), root, 1)
        plain(spark_, root_, row)

    monkeypatch.setattr(store, "_record", late)
    store.compact(spark, root, root, 2)
    after = store.read_batches(spark, root)
    assert {r[0] for r in after.select("batch_id").distinct().collect()} == {1, 2, 3}
    assert {r[0] for r in store.current_edges(after).select("tx_count").distinct().collect()} == {3}
    store.compact(spark, root, root, 3)
    assert store.read_batches(spark, root).count() == n
    store.write_batch(version(4), root, 4)
    assert {r[0] for r in store.current_edges(store.read_batches(spark, root)).select("tx_count").distinct().collect()} == {4}


def test_activity_of_batches_equals_that_of_all_transfers(spark, fresh_dir):
    hour = lambda h: T0 + dt.timedelta(hours=h)
    batches = [
        [("t1", "a", "b", 1.0, 0.0, None, hour(3)), ("t1", "a", "b", 1.0, 0.0, None, hour(3)), ("t2", "a", "c", 1.0, 0.0, None, hour(1))],
        [("t2", "a", "c", 1.0, 0.0, None, hour(1)), ("t3", "a", "b", 1.0, 0.0, None, hour(5)), (None, "d", "a", 1.0, 0.0, None, None)],
        [("t1", "c", "a", 1.0, 0.0, None, hour(0)), ("t4", "e", "e", 1.0, 0.0, None, hour(9))], []]
    frames = [spark.createDataFrame(b, TRANSFER) for b in batches]
    kept = ActivityStore(spark, f"{fresh_dir}/activity", buckets=3)
    assert kept.activity().isEmpty()
    for batch_id in (0, 1, 2, 1, 3, 0):  # two of them are replayed
        kept.add(frames[batch_id], batch_id)
    key = lambda r: str(r)
    whole = store.wallet_activity(frames[0].union(frames[1]).union(frames[2]))
    columns = ["wallet_address", "first_seen_ts", "last_seen_ts", "live_tx_count"]
    assert sorted(map(tuple, kept.activity().select(*columns).collect()), key=key) == sorted(
        map(tuple, whole.select(*columns).collect()), key=key)
    # A batch that comes again with less takes back what it had counted; the table is found by another session's store.
    spark.sql(f"DROP TABLE {kept._counted()}")
    ActivityStore(spark, f"{fresh_dir}/activity", buckets=3).add(frames[1].limit(0), 1)
    assert {r["wallet_address"]: r["live_tx_count"] for r in kept.activity().collect()}["a"] == 2


def test_counted_transfers_stay_in_their_buckets(spark, fresh_dir):
    kept = ActivityStore(spark, f"{fresh_dir}/activity", buckets=3)
    rows = spark.createDataFrame([("t1", "a", "b", 1.0, 0.0, None, T0)], TRANSFER)
    kept.add(rows, 0)
    table = spark.table(kept._counted())
    joined = rows.select("wallet_address", "tx_id").distinct().join(table.hint("merge"), ["wallet_address", "tx_id"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    stored = plan[plan.rindex("+- Sort"):]  # the right side of the join
    assert "SortMergeJoin" in plan and "SelectedBucketsCount: 3 out of 3" in stored and "Exchange" not in stored


def test_busy_senders_are_dealt_over_slots_beyond_the_broadcast(spark):
    batch = judged(spark, 40)
    context = spark.createDataFrame(
        [("w0", 1, "low", 9, 0.5, 0.0, 3, True, 0.9, 0.1), ("w1", 1, "low", 2, 0.4, 0.0, 3, True, 0.8, 0.1), ("x", 1, "low", 9, 0.5, 0.0, 3, True, 0.9, 0.1)],
        CONTEXT)
    known = enrich(batch, context)
    dealt = enrich(batch, context, max_rows=0, busy_from=5, slots=4)
    assert dealt.columns == known.columns and "_slot" in dealt._jdf.queryExecution().toString()
    assert sorted(map(str, dealt.collect())) == sorted(map(str, known.collect()))
    assert not enrich(batch, context.limit(0), max_rows=0).filter("graph_risk_score IS NOT NULL").count()


def test_final_windows_are_stored_once_and_equal_the_batch(spark, fresh_dir):
    write_files(f"{fresh_dir}/in", FILES)
    settings = detect.Settings(f"{fresh_dir}/out", trigger={"availableNow": True}, final_only=True)
    decoded = decode(read_stream(spark, "text", f"{fresh_dir}/in", maxFilesPerTrigger="1"))
    good = split_rejects(decoded)[0]
    query = run(detect.start_detection(good, settings))
    # The late transfer is dropped where it would touch its pane, once and not once for each window.
    assert sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]) == 1
    run(detect.start_archive(decoded, settings))
    on_time = detect.stored_transfers(spark, settings).select(*TRANSFER.fieldNames()).filter("tx_id <> 't500'")
    closed = F.col("window.end") <= F.lit(T0 + dt.timedelta(seconds=250))  # the last transfer on time, minus the watermark
    batch = store.sent_rows(without_model(apply_rules(pair_windows(on_time).filter(closed))))
    columns = [c for c in batch.columns if c not in ("amount_usd", "gas_fee", "z_score")] + [
        F.round(c, 8).alias(c) for c in ("amount_usd", "gas_fee", "z_score")]
    stored = detect.stored_edges(spark, settings).select(*columns)
    expected = batch.select(*columns)
    assert stored.count() == expected.count() > 0 and stored.exceptAll(expected).isEmpty()


def test_windows_in_progress_lie_on_disk_whatever_the_session_says(spark, fresh_dir):
    write_files(f"{fresh_dir}/in", FILES[:2])
    provider = "spark.sql.streaming.stateStore.providerClass"
    own = spark.conf.get(provider)
    heap = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(provider, heap)
    try:
        decoded = decode(read_stream(spark, "text", f"{fresh_dir}/in", maxFilesPerTrigger="1"))
        settings = detect.Settings(f"{fresh_dir}/out", trigger={"availableNow": True})
        query = run(detect.start_detection(split_rejects(decoded)[0], settings))
        assert spark.conf.get(provider) == heap
    finally:
        spark.conf.set(provider, own)
    states = [op for p in query.recentProgress for op in p["stateOperators"]]
    assert states and all(any("rocksdb" in name for name in op["customMetrics"]) for op in states)
    assert store.current_edges(detect.stored_edges(spark, settings)).filter("wallet_address = 'w1'").count() > 0
