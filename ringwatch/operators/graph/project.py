"""The transfer graph: collapsed edges laid out for repeated joins."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.config import SLOT_EDGES
from ringwatch.operators.enrich import fits_broadcast
from ringwatch.operators.numbering import number_rows
from ringwatch.session import cut, pin, shuffle_width


def collapse(transfers: DataFrame) -> DataFrame:
    """One edge per ordered pair: summed weight and number of transfers."""
    return transfers.groupBy("src", "dst").agg(
        F.sum("w").cast("double").alias("w"), F.count(F.lit(1)).alias("n"))


def distinct_pairs(transfers: DataFrame) -> DataFrame:
    return transfers.select("src", "dst").distinct()


def node_set(transfers: DataFrame) -> DataFrame:
    """Everyone who sends or receives."""
    return (
        transfers.select(F.explode(F.array("src", "dst")).alias("node")).distinct())


def sent_as_edges(sent: DataFrame) -> DataFrame:
    """Stored edges or raw transfers as (src, dst, w)."""
    return sent.select(
        F.col("wallet_address").alias("src"), F.col("to_wallet").alias("dst"), F.col("amount_usd").alias("w"))


@dataclass
class Layout:
    """Edges hash-partitioned and sorted by ``key``. Where some keys have very many edges, by (key, slot):
    the edges of such a key are split over several slots."""

    edges: DataFrame
    key: str
    hot: DataFrame | None  # (key, slots) of split keys only

    def meet(self, df: DataFrame) -> DataFrame:
        """Join ``df`` to the edges of its key. Only ``df`` moves; its rows of split keys are
        repeated once per slot."""
        if self.hot is None:
            return df.join(self.edges, self.key)
        slots = F.coalesce("slots", F.lit(1))
        spread = df.join(self.hot, self.key, "left").withColumn(
            "slot", F.explode(F.sequence(F.lit(0), slots - 1))).drop("slots")
        return spread.join(self.edges, [self.key, "slot"])


class TransferGraph:
    """Collapsed directed edges (src, dst, w, n) and the wallets they touch.

    Each result is computed once into the shared folder and joined from there.
    """

    def __init__(self, transfers: DataFrame, nodes: DataFrame | None = None, slot_edges: int = SLOT_EDGES):
        self._take(cut(collapse(transfers)), nodes, slot_edges)

    @classmethod
    def of_pairs(cls, pairs: DataFrame, nodes: DataFrame | None = None, slot_edges: int = SLOT_EDGES) -> TransferGraph:
        """A graph of edges (src, dst, w, n) that are collapsed already."""
        graph = cls.__new__(cls)
        graph._take(cut(pairs), nodes, slot_edges)
        return graph

    def _take(self, pairs: DataFrame, nodes: DataFrame | None, slot_edges: int) -> None:
        self.spark = pairs.sparkSession
        self.slot_edges = slot_edges
        self.pairs = pairs
        self._extra = nodes

    def _layout(self, key: str, other: str) -> Layout:
        width = shuffle_width(self.spark)
        slots = F.ceil(F.col("n_edges") / self.slot_edges).cast("int").alias("slots")
        hot = cut(
            self.pairs.groupBy(key).agg(F.count(F.lit(1)).alias("n_edges"))
            .filter(F.col("n_edges") > self.slot_edges).select(key, slots))
        if hot.isEmpty():
            return Layout(pin(self.pairs.repartition(width, key).sortWithinPartitions(key)), key, None)
        small = F.broadcast(hot) if fits_broadcast(hot) else hot
        placed = self.pairs.join(small, key, "left").withColumn(
            "slot", F.pmod(F.hash(other), F.coalesce("slots", F.lit(1)))).drop("slots")
        return Layout(pin(placed.repartition(width, key, "slot").sortWithinPartitions(key, "slot")), key, small)

    @cached_property
    def by_src(self) -> Layout:
        return self._layout("src", "dst")

    @cached_property
    def by_dst(self) -> Layout:
        return self._layout("dst", "src")

    @cached_property
    def nodes(self) -> DataFrame:
        """(node, out_w, out_degree), isolated wallets included when given."""
        sends = self.pairs.groupBy(F.col("src").alias("node")).agg(
            F.sum("w").alias("out_w"), F.count(F.lit(1)).alias("out_degree"))
        everyone = node_set(self.pairs)
        if self._extra is not None:
            everyone = everyone.union(self._extra.select("node")).distinct()
        filled = everyone.join(sends, "node", "left").withColumns({
            "out_w": F.coalesce("out_w", F.lit(0.0)), "out_degree": F.coalesce("out_degree", F.lit(0))})
        width = shuffle_width(self.spark)
        return pin(filled.repartition(width, "node").sortWithinPartitions("node"))

    @cached_property
    def numbers(self) -> DataFrame:
        """(node, id): consecutive numbers in name order."""
        return cut(number_rows(self.nodes.select("node"), "id", "node"))

    @cached_property
    def numbered(self) -> TransferGraph:
        """The same graph between numbers; rows keyed by wallets are then a fraction of the width."""
        a = self.numbers.select(F.col("node").alias("src"), F.col("id").alias("a"))
        b = self.numbers.select(F.col("node").alias("dst"), F.col("id").alias("b"))
        pairs = self.pairs.join(a, "src").join(b, "dst").select(
            F.col("a").alias("src"), F.col("b").alias("dst"), "w", "n")
        return TransferGraph.of_pairs(pairs, self.numbers.select(F.col("id").alias("node")), self.slot_edges)
