"""Detector evaluation against known labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.config import NORMAL_LABEL, REASON_ML


def latest_labelled(edges: DataFrame, limit: int | None = None) -> DataFrame:
    """The newest edges that carry a label; edges without a time come first, as in a descending
    sort where NULL is greatest. All of them, unless the caller sets a limit."""
    labelled = edges.filter(F.col("true_label").isNotNull())
    if limit is None:
        return labelled
    order = [F.desc_nulls_first("timestamp"), F.asc("wallet_address"), F.asc("to_wallet"), F.asc("window_start")]
    return labelled.orderBy(*order).limit(limit)


def with_indicators(edges: DataFrame) -> DataFrame:
    """Add 0/1 columns: truth, rules, model, and either one."""
    reason = F.col("anomaly_reason")
    return edges.withColumns({
        "y_true": F.when(F.col("true_label") == NORMAL_LABEL, 0).otherwise(1),
        "y_rule": F.when(reason.isNotNull() & (reason != "") & (reason != REASON_ML), 1).otherwise(0),
        "y_ml": F.when(F.col("ml_anomaly"), 1).otherwise(0),
        "y_combined": F.when(reason.isNotNull() & (reason != ""), 1).otherwise(0)})


def transfer_verdicts(transfers: DataFrame, edges: DataFrame, size_seconds: int, slide_seconds: int) -> DataFrame:
    """Every labelled transfer once, with the verdicts of all windows that cover it: (tx_id, wallet_address, to_wallet,
    timestamp, true_label, anomaly_reason, ml_anomaly), in the shape ``with_indicators`` takes.

    A transfer counts as found by the rules if any of its windows was, and as found by the model likewise; of
    several reasons a rule's goes first, by name. A window ends where a pane does, so windows and transfers
    meet on sender, receiver and pane by equality. Only windows with a verdict are spread over their panes,
    and their verdicts are put together per pane before the join, so a pair's busiest pane is one row there.
    """
    if size_seconds % slide_seconds:
        raise ValueError("size must be a multiple of slide")
    rule = F.col("anomaly_reason").isNotNull() & (F.col("anomaly_reason") != "") & (F.col("anomaly_reason") != REASON_ML)
    first = (F.unix_seconds(F.to_timestamp("window_start")) / F.lit(slide_seconds)).cast("long")
    said = edges.filter(rule | F.col("ml_anomaly")).select(
        "wallet_address", "to_wallet", F.explode(F.sequence(first, first + F.lit(size_seconds // slide_seconds - 1))).alias("_pane"),
        F.when(rule, F.col("anomaly_reason")).alias("_rule"), F.coalesce("ml_anomaly", F.lit(False)).alias("_ml"))
    panes = said.groupBy("wallet_address", "to_wallet", "_pane").agg(F.min("_rule").alias("_rule"), F.max("_ml").alias("_ml"))
    pane = F.floor(F.unix_seconds("timestamp") / F.lit(slide_seconds)).alias("_pane")
    labelled = transfers.filter(F.col("true_label").isNotNull()).select(
        "tx_id", "wallet_address", "to_wallet", "timestamp", "true_label", pane)
    met = labelled.join(panes, ["wallet_address", "to_wallet", "_pane"], "left")
    found = F.coalesce("_ml", F.lit(False))
    return met.select(
        "tx_id", "wallet_address", "to_wallet", "timestamp", "true_label",
        F.coalesce("_rule", F.when(found, REASON_ML)).alias("anomaly_reason"), found.alias("ml_anomaly"))


def evaluate_transfers(transfers: DataFrame, edges: DataFrame, size_seconds: int, slide_seconds: int) -> DataFrame:
    """The report per transfer: its support is the number of labelled transfers, not of windows."""
    marked = with_indicators(transfer_verdicts(transfers, edges, size_seconds, slide_seconds))
    return report(confusion(marked, {"rule_based": "y_rule", "isolation_forest": "y_ml", "combined": "y_combined"}))


def confusion(df: DataFrame, detectors: dict[str, str], truth: str = "y_true") -> DataFrame:
    """Per detector: tn, fp, fn, tp. All detectors are counted in one pass over the rows."""
    def cell(pred: str, actual: int, said: int) -> Column:
        return F.count_if((F.col(truth) == actual) & (F.col(pred) == said))

    # Fixed values: (actual, predicted) of the four cells.
    cells = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    one_row = df.agg(F.array(*[
        F.struct(F.lit(name).alias("detector"), *[cell(pred, *pair).alias(c) for c, pair in cells.items()])
        for name, pred in detectors.items()]).alias("rows"))
    return one_row.select(F.inline("rows"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / F.greatest(bottom, F.lit(1)))


def report(matrix: DataFrame) -> DataFrame:
    """Long form (detector, class, metric, value): per class precision, recall, F1 and support,
    accuracy, and macro and weighted averages. A division by zero gives 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    classes = {"normal": (tn, fn, fp), "anomaly": (tp, fp, fn)}  # hits, false alarms, misses
    wide = matrix
    for name, (hit, alarm, miss) in classes.items():
        p, r = F.col(f"{name}_precision"), F.col(f"{name}_recall")
        wide = wide.withColumns({
            f"{name}_precision": _ratio(hit, hit + alarm),
            f"{name}_recall": _ratio(hit, hit + miss),
            f"{name}_support": (hit + miss).cast("double")})
        wide = wide.withColumn(f"{name}_f1", F.when(p + r == 0, F.lit(0.0)).otherwise(
            2 * p * r / F.when(p + r == 0, F.lit(1.0)).otherwise(p + r)))
    total = F.col("normal_support") + F.col("anomaly_support")
    wide = wide.withColumns({
        "all_accuracy": _ratio(tn + tp, tn + fp + fn + tp),
        "macro_support": total, "weighted_support": total})
    for m in ("precision", "recall", "f1"):
        n, a = F.col(f"normal_{m}"), F.col(f"anomaly_{m}")
        wide = wide.withColumn(f"macro_{m}", (n + a) / 2).withColumn(
            f"weighted_{m}",
            _ratio(n * F.col("normal_support") + a * F.col("anomaly_support"), total))
    groups = ["normal", "anomaly", "macro", "weighted"]
    names = [(g, m) for g in groups for m in ("precision", "recall", "f1", "support")] + [("all", "accuracy")]
    rows = F.array(*[
        F.struct(F.lit(g).alias("class"), F.lit(m).alias("metric"), F.col(f"{g}_{m}").alias("value"))
        for g, m in names])
    return wide.select("detector", F.inline(rows))


def evaluate(edges: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Label counts, confusion matrices and the report for rules, model and both together."""
    marked = with_indicators(latest_labelled(edges, limit))
    labels = marked.groupBy("true_label").agg(F.count(F.lit(1)).alias("n"))
    matrix = confusion(
        marked, {"rule_based": "y_rule", "isolation_forest": "y_ml", "combined": "y_combined"})
    return labels, matrix, report(matrix)


def write_report(edges: DataFrame, out: str, limit: int | None = None) -> None:
    """Write the report and the label counts as JSON."""
    labels, _, long_report = evaluate(edges, limit)
    counts = labels.select(
        F.lit("truth").alias("detector"), F.col("true_label").alias("class"),
        F.lit("count").alias("metric"), F.col("n").cast("double").alias("value"))
    long_report.unionByName(counts).coalesce(1).write.mode("overwrite").json(out)
