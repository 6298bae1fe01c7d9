"""Isolation Forest: trees grown as Spark windows, rows scored in Arrow batches."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ringwatch.config import FEATURES
from ringwatch.functions.scalars import draw, unit_draw
from ringwatch.operators.quantile import exact_quantile
from ringwatch.schema import FOREST
from ringwatch.session import cut, shuffle_width


@dataclass(frozen=True)
class ForestConfig:
    trees: int = 200
    rows_per_tree: int = 256
    height: int = 8
    contamination: float = 0.02
    seed: int = 42
    features: list[str] = field(default_factory=lambda: list(FEATURES))


@dataclass(frozen=True)
class Forest:
    """``nodes`` has at most trees * (2^(height+1) - 1) rows whatever the size of the training data."""

    nodes: DataFrame
    config: ForestConfig
    offset: float
    threshold: float = 0.0

    @cached_property
    def scorer(self):
        """The scoring function; the trees are read once, not per batch."""
        return scorer(self.nodes, self.config)


def feature_rows(rows: DataFrame, features: list[str]) -> DataFrame:
    """Model inputs as doubles; a missing value counts as 0."""
    return rows.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})


def training_features(sent: DataFrame, context: DataFrame, max_rows: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Model inputs taken off stored edges and the senders' context, keyed by the edge; columns to ``keep`` go along."""
    from ringwatch.operators.enrich import enrich
    from ringwatch.operators.store import EDGE_KEY

    scores = context.select("wallet_address", "graph_risk_score", "structural_novelty_score")
    joined = enrich(sent, scores) if max_rows is None else enrich(sent, scores, max_rows)
    named = joined.withColumnRenamed("gas_fee", "avg_gas_fee")
    return feature_rows(named, FEATURES).select(*EDGE_KEY, *FEATURES, *keep)


def sample_for_trees(rows: DataFrame, key: list[str], cfg: ForestConfig, n: int) -> DataFrame:
    """Give each tree about ``rows_per_tree`` of the ``n`` rows, none twice, in one scan.

    Trees fall into groups; within a group a row serves at most one tree. Large inputs need one
    group, so one draw per row; small inputs get more groups, up to one tree each.
    """
    groups = min(cfg.trees, max(1, math.ceil(cfg.trees * cfg.rows_per_tree / max(n, 1))))
    rate = min(1.0, cfg.trees * cfg.rows_per_tree / (max(n, 1) * groups))
    name = F.concat_ws("|", *key)
    g = F.col("_group")
    trees_in_group = F.floor((F.lit(cfg.trees - 1) - g) / F.lit(groups)) + 1
    copies = rows.withColumn("_key", name).withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    taken = copies.filter(unit_draw(F.col("_key"), g, cfg.seed) < rate)
    tree = g + F.lit(groups) * (draw(F.col("_key"), g, cfg.seed, "tree") % trees_in_group)
    return taken.withColumn("tree", tree.cast("long")).drop("_key", "_group")


def grow_trees(sample: DataFrame, cfg: ForestConfig) -> DataFrame:
    """Forest rows (tree, node, feature, split, size, depth); feature -1 marks a leaf.

    Rows are brought together by tree once; every level is a window over (tree, node) within that
    layout. Children of node i are 2i (values up to the split) and 2i + 1.
    """
    width = shuffle_width(sample.sparkSession)
    x = F.array(*[F.col(c) for c in cfg.features]).alias("x")
    state = sample.select("tree", x).repartition(width, "tree").select(
        "tree", "x", F.lit(1).cast("long").alias("node"), F.lit(True).alias("open"),
        F.array().cast("array<struct<node:bigint,feature:bigint,split:double,size:bigint,depth:bigint>>").alias("path"))
    here = Window.partitionBy("tree", "node")
    numbers = range(len(cfg.features))
    for depth in range(cfg.height + 1):
        bounds = state.select(
            "*", F.count(F.lit(1)).over(here).alias("size"),
            F.array(*[F.min(F.get("x", F.lit(i))).over(here) for i in numbers]).alias("low"),
            F.array(*[F.max(F.get("x", F.lit(i))).over(here) for i in numbers]).alias("high"))
        varied = F.filter(
            F.array(*[F.lit(i) for i in numbers]), lambda i: F.get("high", i) > F.get("low", i))
        usable = bounds.withColumn("varied", varied if depth < cfg.height else F.array().cast("array<int>"))
        pick = (draw(F.col("tree"), F.col("node"), "feature", cfg.seed)
                % F.greatest(F.size("varied"), F.lit(1))).cast("int")
        chosen = usable.withColumn("feature", F.get("varied", pick))
        low, high = F.get("low", F.col("feature")), F.get("high", F.col("feature"))
        cutting = chosen.withColumn(
            "split", low + unit_draw(F.col("tree"), F.col("node"), "split", cfg.seed) * (high - low))
        entry = F.struct(
            "node", F.coalesce(F.col("feature").cast("long"), F.lit(-1).cast("long")).alias("feature"),
            "split", "size", F.lit(depth).cast("long").alias("depth"))
        inner = F.col("open") & F.col("feature").isNotNull()
        right = (F.get("x", F.col("feature")) > F.col("split")).cast("long")
        state = cutting.select(
            "tree", "x",
            F.when(inner, 2 * F.col("node") + right).otherwise(F.col("node")).alias("node"),
            inner.alias("open"),
            F.when(F.col("open"), F.array_append("path", entry)).otherwise(F.col("path")).alias("path"))
    seen = state.select("tree", F.inline("path"))
    return seen.groupBy("tree", "node").agg(
        F.max("feature").alias("feature"), F.max("split").alias("split"),
        F.max("size").alias("size"), F.max("depth").alias("depth"))


def _expected_depth(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points."""
    m = np.maximum(n, 3).astype(float)
    # Fixed value: Euler's constant.
    long_form = 2.0 * (np.log(m - 1.0) + 0.5772156649) - 2.0 * (m - 1.0) / m
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, long_form))


def scorer(forest_nodes: DataFrame, cfg: ForestConfig):
    """A column function from the features to the raw score -2^(-mean relative depth).

    The bounded forest becomes three arrays that travel with the function.
    """
    pdf = forest_nodes.toPandas()
    slots = 2 ** (cfg.height + 1)
    tree, node = pdf["tree"].to_numpy(), pdf["node"].to_numpy()
    feature = np.full((cfg.trees, slots), -1, dtype=np.int16)
    split = np.zeros((cfg.trees, slots))
    depth = np.zeros((cfg.trees, slots))
    feature[tree, node] = pdf["feature"]
    split[tree, node] = pdf["split"].fillna(0.0)
    depth[tree, node] = pdf["depth"] + _expected_depth(pdf["size"].to_numpy())
    roots = np.zeros(cfg.trees)
    roots[tree[node == 1]] = _expected_depth(pdf["size"].to_numpy()[node == 1])
    grown = np.flatnonzero(roots > 0)
    height = cfg.height

    @F.pandas_udf("double")
    def raw_score(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        rows = np.arange(len(x))
        relative = np.zeros(len(x))
        for t in grown:
            at = np.ones(len(x), dtype=np.int64)
            for _ in range(height):
                f = feature[t, at]
                child = 2 * at + (x[rows, np.maximum(f, 0)] > split[t, at])
                at = np.where(f >= 0, child, at)
            relative += depth[t, at] / roots[t]
        return pd.Series(-np.exp2(-relative / max(len(grown), 1)))

    return raw_score


def fit(rows: DataFrame, key: list[str], cfg: ForestConfig = ForestConfig()) -> Forest | None:
    """Grow a forest on ``rows`` (key columns plus features) and set its cut-off so that the
    ``contamination`` share of them scores below 0. None when there are fewer than two rows."""
    ready = feature_rows(rows, cfg.features)
    n = ready.count()
    if n < 2:
        return None
    nodes = cut(grow_trees(sample_for_trees(ready, key, cfg, n), cfg))
    raw = scorer(nodes, cfg)
    scores = cut(ready.select(raw(*cfg.features).alias("s")))
    return Forest(nodes, cfg, exact_quantile(scores, "s", cfg.contamination))


def score(rows: DataFrame, forest: Forest) -> DataFrame:
    """Add ``ml_score``; lower is more anomalous and below 0 is beyond the cut-off."""
    raw = forest.scorer
    inputs = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in forest.config.features]
    return rows.withColumn("ml_score", raw(*inputs) - F.lit(forest.offset))


def score_summary(scored: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Rows, flagged rows and share, and the range and mean of ``ml_score``."""
    flagged = F.count_if(F.col("ml_score") < threshold)
    return scored.agg(
        F.count("ml_score").alias("n_rows"), flagged.alias("n_flagged"),
        F.try_divide(flagged, F.count("ml_score")).alias("flagged_share"),
        F.min("ml_score").alias("min_score"), F.max("ml_score").alias("max_score"),
        F.avg("ml_score").alias("mean_score"))


def save(forest: Forest, path: str) -> None:
    """Nodes first, metadata last: a model without metadata counts as absent."""
    spark = forest.nodes.sparkSession
    forest.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    cfg = forest.config
    text = json.dumps({
        "feature_cols": cfg.features, "contamination": cfg.contamination,
        "anomaly_score_threshold": forest.threshold, "offset": forest.offset, "trees": cfg.trees,
        "rows_per_tree": cfg.rows_per_tree, "height": cfg.height, "seed": cfg.seed})
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load(spark: SparkSession, path: str) -> Forest | None:
    """The saved model, or None so that callers go on with the rules alone."""
    try:
        meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
        nodes = spark.read.schema(FOREST).parquet(f"{path}/nodes")
    except (AnalysisException, TypeError):
        return None
    cfg = ForestConfig(
        trees=meta["trees"], rows_per_tree=meta["rows_per_tree"], height=meta["height"],
        contamination=meta["contamination"], seed=meta["seed"], features=meta["feature_cols"])
    return Forest(nodes, cfg, meta["offset"], meta["anomaly_score_threshold"])
