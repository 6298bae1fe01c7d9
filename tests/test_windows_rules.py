import datetime as dt

import pytest
from pyspark.sql import functions as F

from ringwatch.config import RuleConfig, WindowConfig
from ringwatch.operators.rules import apply_rules, verdict, without_model
from ringwatch.operators.windows import pair_windows, pair_windows_by_pane
from ringwatch.schema import TRANSFER
from ringwatch.sources.transfers import decode, floor_amounts, split_rejects

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def transfers(spark, rows):
    """rows: (id, sender, receiver, amount, gas, label, seconds after T0)"""
    data = [(*r[:6], T0 + dt.timedelta(seconds=r[6])) for r in rows]
    return spark.createDataFrame(data, TRANSFER)


def window_rows(spark, rows):
    return spark.createDataFrame(rows, "max_amount double, mean_amount double, stddev_amount double, tx_count long")


@pytest.mark.parametrize("row,reason", [
    ((100_000.0, 100_000.0, None, 1), None),
    ((100_000.01, 100_000.01, None, 1), "LARGE_SINGLE_TRANSACTION"),
    ((13.0, 10.0, 1.0, 3), None),
    ((13.001, 10.0, 1.0, 3), "DYNAMIC_Z_SCORE_SPIKE"),
    ((13.001, 10.0, 1.0, 2), None),
    ((10.0, 10.0, 0.0, 8), None),
    ((10.0, 10.0, 0.0, 9), "BOT_BURST_HIGH_FREQUENCY"),
    ((13.001, 10.0, 1.0, 9), "DYNAMIC_Z_SCORE_SPIKE"),
    ((200_000.0, 10.0, 1.0, 9), "LARGE_SINGLE_TRANSACTION"),
])
def test_rules_at_their_limits(spark, row, reason):
    assert apply_rules(window_rows(spark, [row])).first()["rule_reason"] == reason


def test_missing_or_zero_spread_counts_as_one(spark):
    out = apply_rules(window_rows(spark, [(12.0, 10.0, None, 1), (12.0, 10.0, 0.0, 1), (12.0, 10.0, 4.0, 1)]))
    assert [r["z_score"] for r in out.collect()] == [2.0, 2.0, 0.5]


def test_rules_go_before_the_model(spark):
    rows = spark.createDataFrame(
        [("A", -0.1), (None, -0.1), (None, 0.0), (None, None)], "rule_reason string, ml_score double")
    got = [(r["ml_anomaly"], r["anomaly_reason"]) for r in verdict(rows).collect()]
    assert got == [(True, "A"), (True, "ML_ISOLATION_FOREST_ANOMALY"), (False, None), (False, None)]
    plain = without_model(rows.select("rule_reason")).collect()
    assert [(r["ml_score"], r["ml_anomaly"], r["anomaly_reason"]) for r in plain][0] == (None, False, "A")


def test_each_transfer_falls_into_six_windows(spark):
    out = pair_windows(transfers(spark, [("t1", "a", "b", 5.0, 0.1, "normal", 0)])).collect()
    assert len(out) == 6
    assert {r["window_start"] for r in out} == {f"2024-01-01 11:59:{s}" for s in (10, 20, 30, 40, 50)} | {
        "2024-01-01 12:00:00"}
    assert all(r["stddev_amount"] is None and r["sample_tx_id"] == "t1" for r in out)


def test_panes_give_the_same_rows(spark):
    rows = [(f"t{i}", f"w{i % 3}", f"c{i % 2}", [0.1, 0.1, 250.5, None, 7.25][i % 5] if i % 3 else 0.1,
             None if i % 7 == 0 else i / 100, ["normal", "bot_burst", None][i % 3 if i % 2 else 0], (i * 37) % 300)
            for i in range(200)]
    df = transfers(spark, rows)
    columns = ["window_start", "wallet_address", "to_wallet", "max_amount", "tx_count", "sample_tx_id",
               "true_label", "last_seen_ts", "window",
               *[F.round(c, 8).alias(c) for c in ("mean_amount", "stddev_amount", "total_amount_usd", "avg_gas_fee")]]
    direct = pair_windows(df, WindowConfig()).select(*columns)
    panes = pair_windows_by_pane(df, 60, 10).select(*columns)
    assert direct.count() == panes.count() > 0
    assert direct.exceptAll(panes).isEmpty() and panes.exceptAll(direct).isEmpty()
    with pytest.raises(ValueError):
        pair_windows_by_pane(df, 60, 7)


def test_any_odd_label_wins(spark):
    df = transfers(spark, [("t1", "a", "b", 5.0, 0.1, "normal", 0), ("t2", "a", "b", 5.0, 0.1, "flash_loan", 1)])
    assert {r["true_label"] for r in pair_windows(df).filter("tx_count = 2").collect()} == {"flash_loan"}


def test_decode_and_rejects(spark):
    texts = [
        '{"tx_id":"t1","wallet_address":"a","to_wallet":"b","amount_usd":1.5,"gas_fee":0.1,'
        '"true_label":"normal","timestamp":"2024-01-01T00:00:00.250+00:00","other":1}',
        '{"tx_id":"t2","wallet_address":"a","to_wallet":"b"}',
        '{"tx_id":"t3","to_wallet":"b"}', '{"tx_id":"t4","wallet_address":"a"}',
        '{"wallet_address":"a","to_wallet":"b"}', "garbage", None]
    df = spark.createDataFrame([(t.encode() if t else None,) for t in texts], "value binary")
    good, bad = split_rejects(decode(df, now=F.lit("2000-01-01").cast("timestamp")))
    rows = {r["tx_id"]: r for r in good.collect()}
    assert set(rows) == {"t1", "t2"}
    assert rows["t1"]["timestamp"] == dt.datetime(2024, 1, 1, 0, 0, 0, 250_000)
    assert rows["t2"]["timestamp"] == dt.datetime(2000, 1, 1) and rows["t2"]["amount_usd"] is None
    reasons = sorted(r["reject_reason"] for r in bad.collect())
    assert reasons == ["malformed_payload", "missing_receiver", "missing_sender", "missing_tx_id", "missing_tx_id"]


def test_amount_floor(spark):
    df = spark.createDataFrame([(0.2,), (3.0,)], "amount_usd double")
    assert [r[0] for r in floor_amounts(df).collect()] == [1.0, 3.0]


def test_transfers_are_judged_by_the_windows_that_cover_them(spark):
    """Against a walk over all windows of each transfer."""
    import datetime as dt
    import random

    from ringwatch.operators import evaluate

    rng, start = random.Random(4), dt.datetime(2024, 1, 1, 12, 0, 0)
    transfers = [(f"t{i}", f"w{rng.randrange(3)}", rng.choice(["c", "d"]), start + dt.timedelta(seconds=rng.randrange(300)),
                  rng.choice(["normal", "odd", None])) for i in range(150)] + [("edge", "w0", "c", start, "odd")]
    edges = {}
    for second in range(-60, 300, 10):
        for w in ("w0", "w1", "w2"):
            for c in ("c", "d"):
                reason = rng.choice([None] * 9 + ["A_RULE", "B_RULE", "ML_ISOLATION_FOREST_ANOMALY", ""])
                edges[w, c, start + dt.timedelta(seconds=second)] = (reason, reason is not None and reason.startswith("ML") or rng.random() < 0.05)
    rows = [(w, c, at.strftime("%Y-%m-%d %H:%M:%S"), *said) for (w, c, at), said in edges.items()]
    got = evaluate.transfer_verdicts(
        spark.createDataFrame(transfers, "tx_id string, wallet_address string, to_wallet string, timestamp timestamp, true_label string"),
        spark.createDataFrame(rows, "wallet_address string, to_wallet string, window_start string, anomaly_reason string, ml_anomaly boolean"),
        60, 10).collect()
    wanted = {}
    for tx, w, c, at, label in transfers:
        if label is None:
            continue
        over = [s for (x, y, begin), s in edges.items() if (x, y) == (w, c) and begin <= at < begin + dt.timedelta(seconds=60)]
        rules = sorted(r for r, _ in over if r and not r.startswith("ML"))
        model = any(m for _, m in over)
        wanted[tx] = (rules[0] if rules else "ML_ISOLATION_FOREST_ANOMALY" if model else None, model)
    assert {r["tx_id"]: (r["anomaly_reason"], r["ml_anomaly"]) for r in got} == wanted and len(got) == len(wanted)


def test_distinct_counts_by_bitmaps_merge(spark):
    from ringwatch.operators.distinct import bits_of, count_of, merged

    numbers = [None, 0, 1, 5, 5, 32_767, 32_768, 32_769, 10**12, 10**12 + 1]
    one = bits_of(spark.createDataFrame([(n,) for n in numbers], "n long"), "n")
    two = bits_of(spark.createDataFrame([(n,) for n in (5, 7, 10**12)], "n long"), "n")
    assert count_of(one).first()["n"] == 8 and count_of(merged(one, two)).first()["n"] == 9
    assert count_of(merged(one, one, two, two)).first()["n"] == 9 and count_of(one.limit(0)).first()["n"] == 0
