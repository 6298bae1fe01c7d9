import numpy as np
import pytest
from pyspark.sql import functions as F

from ringwatch.operators import forest as forests
from ringwatch.operators.quantile import exact_quantile
from ringwatch.operators.store import sent_rows
from ringwatch.operators.rules import without_model

FEATURES = ["x", "y", "flat"]
CFG = forests.ForestConfig(trees=40, rows_per_tree=64, height=6, contamination=0.05, features=FEATURES)


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    usual = rng.normal(0, 1, (580, 2))
    odd = rng.normal(9, 1, (20, 2))
    rows = [(f"k{i}", float(x), float(y) if i % 50 else None, 1.0)
            for i, (x, y) in enumerate(np.vstack([usual, odd]))]
    return spark.createDataFrame(rows, "id string, x double, y double, flat double")


@pytest.fixture(scope="module")
def model(points):
    return forests.fit(points, ["id"], CFG)


def test_flagged_share_is_the_contamination(points, model):
    scored = forests.score(points, model)
    summary = forests.score_summary(scored).first()
    assert summary["n_rows"] == 600 and summary["n_flagged"] == pytest.approx(30, abs=2)
    flagged = {r["id"] for r in scored.filter("ml_score < 0").collect()}
    assert len(flagged & {f"k{i}" for i in range(580, 600)}) >= 18


def test_trees_are_bounded_and_never_cut_a_flat_feature(model):
    nodes = model.nodes.toPandas()
    roots = nodes[nodes.node == 1]
    assert len(roots) == 40 and roots["size"].between(30, 110).all()
    assert nodes.depth.max() <= 6 and nodes.feature.isin([-1, 0, 1]).all()
    assert (nodes[nodes.depth == 6].feature == -1).all()
    leaves = nodes[nodes.feature == -1].groupby("tree")["size"].sum()
    assert leaves.to_numpy().tolist() == roots.set_index("tree")["size"].sort_index().to_numpy().tolist()


def test_scores_equal_a_plain_walk(spark, points, model):
    nodes = {(r["tree"], r["node"]): r for r in model.nodes.collect()}

    def c(n):
        return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    def walk(x):
        parts = []
        for t in range(40):
            at, root = 1, nodes[t, 1]["size"]
            while nodes[t, at]["feature"] >= 0:
                at = 2 * at + (x[nodes[t, at]["feature"]] > nodes[t, at]["split"])
            parts.append((nodes[t, at]["depth"] + c(nodes[t, at]["size"])) / c(root))
        return -(2 ** -np.mean(parts))

    for row in forests.score(points, model).limit(25).collect():
        raw = walk([row["x"], row["y"] or 0.0, row["flat"]])
        assert row["ml_score"] + model.offset == pytest.approx(raw)
        assert -1 < raw < 0


def test_small_inputs(spark, points):
    assert forests.fit(points.limit(1), ["id"], CFG) is None
    few = forests.fit(points.limit(10), ["id"], CFG)
    sizes = {r["size"] for r in few.nodes.filter("node = 1").collect()}
    assert sizes == {10}


def test_save_and_load(spark, points, model, fresh_dir):
    assert forests.load(spark, fresh_dir + "/none") is None
    forests.save(model, fresh_dir + "/model")
    again = forests.load(spark, fresh_dir + "/model")
    assert again.config == model.config and again.offset == model.offset
    left = [r["ml_score"] for r in forests.score(points, model).orderBy("id").collect()]
    assert left == [r["ml_score"] for r in forests.score(points, again).orderBy("id").collect()]


@pytest.mark.parametrize("q", [0.0, 0.02, 0.5, 0.731, 1.0])
def test_quantile_narrowing(spark, q):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.lognormal(0, 3, 3000), np.full(1500, 2.5), [1e9, -4.0]])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    assert exact_quantile(df, "v", q, small=40) == pytest.approx(np.quantile(values, q), rel=1e-12)
    assert exact_quantile(df.filter("v > 1e12"), "v", q) is None


def test_training_features_fill_gaps(spark):
    windows = spark.createDataFrame(
        [("t", "2024-01-01 00:00:00", "a", "b", 5.0, None, 3, None, None, None, None)],
        "sample_tx_id string, window_start string, wallet_address string, to_wallet string, total_amount_usd double,"
        "avg_gas_fee double, tx_count long, last_seen_ts timestamp, true_label string, z_score double, rule_reason string")
    context = spark.createDataFrame([("z", 1.0, 1.0)],
                                    "wallet_address string, graph_risk_score double, structural_novelty_score double")
    for max_rows in (10, 0):
        row = forests.training_features(sent_rows(without_model(windows)), context, max_rows).first()
        assert [row[c] for c in ("z_score", "tx_count", "avg_gas_fee", "graph_risk_score")] == [0.0, 3.0, 0.0, 0.0]


@pytest.mark.parametrize("name, values", [
    ("whole numbers", [float(i % 7) for i in range(900)]), ("one value", [3.0] * 500), ("two values", [1.0] * 300 + [2.0] * 299),
    ("far apart", [10.0 ** (i % 300) for i in range(1200)]), ("one row", [4.0]),
    ("nearly all equal", [5.0] * 2000 + [float(i) for i in range(60)])])
def test_quantile_on_any_skew(spark, name, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    for q in (0.0, 0.02, 0.5, 0.997, 1.0):
        for small in (50, 10_000):
            assert exact_quantile(df, "v", q, small) == pytest.approx(np.quantile(values, q), rel=1e-12), (name, q, small)


def test_quantile_scans_twice_where_few_rows_lie_near(spark, monkeypatch):
    scans = []
    plain = type(spark.range(1)).agg
    monkeypatch.setattr(type(spark.range(1)), "agg", lambda self, *a: scans.append(1) or plain(self, *a))
    df = spark.range(20_000).selectExpr("pow(1.001, id) as v")
    assert exact_quantile(df, "v", 0.3, small=2000) == pytest.approx(1.001 ** 5999.7, rel=1e-3)
    assert len(scans) <= 4  # sketch, count, the value behind the bracket; the ladder reads the bracket alone
