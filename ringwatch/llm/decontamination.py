"""Benchmark passages in documents: SimHash over windows of each item's own size.

Words are lower-cased (A-Z) and taken in shingles of ``width``, an item shorter than that in shingles of its own
length. For every item size, windows of that many words slide over each text; a window's fingerprint is
the bitwise majority of its shingle hashes. A text shorter than an item is one window of its own size. Only windows that
share enough shingles with the benchmark to reach the threshold are fingerprinted, which loses none. Their fingerprints are
compared with those of all items of the size: at a ``RADIUS`` wide enough for the threshold an index by blocks would list
almost half of the items anyway. Items within the radius are then compared exactly: the similarity is the sum of
the smaller shingle counts over the sum of the larger ones.

Items are worked through in blocks of bounded number and size, each sent to the tasks whole.

Cases: null and word-less texts and items match nothing; items with a null id are left out; rows
repeated in either table give one result per pair of ids; a text without an id is reported under null; ties go to
the first place; an empty table gives an empty result; further columns are not read; windows of
very long texts are taken in stretches of bounded size.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringwatch.llm.common import batch_of, folded, longs, mapped, passing, pick
from ringwatch.llm.simhash import shingle_hashes

#: Bits; at similarity 0.8 two fingerprints differ in about 10 of 64, with a deviation of 3.
RADIUS = 22
#: Items and letters of a block of the benchmark, and shingles of a stretch of text.
ITEM_BLOCK = 1000
CHAR_BLOCK = 4_000_000
STRETCH = 1 << 15


def _majority(counts: np.ndarray, total: int) -> np.ndarray:
    return np.packbits(2 * counts > total, axis=1, bitorder="little").view("<u8").ravel()


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


class Items:
    """The items of one size: ids, shingle counts and fingerprints."""

    def __init__(self, ids: list[int], hashes: list[np.ndarray]):
        self.ids, self.counts = ids, [Counter(h.tolist()) for h in hashes]
        self.prints = np.concatenate([_majority(_bits(h).sum(0, keepdims=True, dtype=np.int64), len(h)) for h in hashes])

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, item) within the radius."""
        step, found = max(1, (1 << 20) // len(self.ids)), []
        for at in range(0, len(prints), step):
            of, item = np.nonzero(np.bitwise_count(prints[at:at + step, None] ^ self.prints[None, :]) <= RADIUS)
            found.append((of + at, item))
        of, item = zip(*found) if found else ([np.zeros(0, np.int64)],) * 2
        return np.concatenate(of), np.concatenate(item)


class Benchmark:
    def __init__(self, items: list[tuple[int, str]], width: int):
        self.width, by_size = width, defaultdict(list)
        for item_id, text in items:
            if own := folded(text):
                by_size[len(own)].append((item_id, shingle_hashes(text, width)))
        self.sizes = {n: Items([i for i, _ in own], [h for _, h in own]) for n, own in sorted(by_size.items())}
        self.known = {
            k: np.unique(np.concatenate([np.array(list(c), np.uint64) for n, own in self.sizes.items()
                                         if min(n, width) == k for c in own.counts]))
            for k in {min(n, width) for n in self.sizes}}

    def matches(self, text: str | None, least: float) -> dict[int, tuple[float, int, int]]:
        """item_id: (similarity, first word, words) of the best window with at least ``least``."""
        best: dict[int, tuple[float, int, int]] = {}
        n_words = len(folded(text))
        for k, known in self.known.items():
            if n_words < k:
                continue
            hashes = shingle_hashes(text, k)
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            shared = np.nonzero(known[place] == hashes)[0]
            if not len(shared):
                continue
            self._shorter(hashes, len(shared), k, n_words, least, best)
            sizes = [n for n in self.sizes if min(n, self.width) == k and n <= n_words]
            widest = max(sizes, default=0)
            for a, b in _stretches(shared, widest, len(hashes)):
                self._stretch(hashes[a:b], np.isin(np.arange(a, b), shared, assume_unique=True), a, k, sizes, least, best)
        return best

    def _shorter(self, hashes: np.ndarray, shared: int, k: int, n_words: int, least: float, best: dict) -> None:
        """A text shorter than an item is one window, held against the items whose shingle count allows ``least``."""
        prints, counts = _majority(_bits(hashes).sum(0, keepdims=True, dtype=np.int64), len(hashes)), None
        for n, own in self.sizes.items():
            total = n - k + 1
            if min(n, self.width) != k or n <= n_words or len(hashes) < least * total or (
                    (1 + least) * shared < least * (len(hashes) + total) - 1e-9):
                continue
            counts = counts or Counter(hashes.tolist())
            for item in own.candidates(prints)[1].tolist():
                similarity = _similarity(counts, own.counts[item])
                if similarity >= least and (similarity, 0) > (lambda x: (x[0], -x[1]) if x else (0.0, 0))(best.get(own.ids[item])):
                    best[own.ids[item]] = (similarity, 0, n_words)

    def _stretch(self, hashes: np.ndarray, shared: np.ndarray, at: int, k: int, sizes: list[int], least: float, best: dict) -> None:
        sums = np.zeros((len(hashes) + 1, 64), np.int32)
        np.cumsum(_bits(hashes), axis=0, out=sums[1:])
        hits = np.concatenate([[0], np.cumsum(shared)])
        for n in sizes:
            span = n - k + 1  # shingles of a window
            if span > len(hashes):
                continue
            # Windows with too few shingles in common for the threshold are left out.
            starts = np.nonzero((1 + least) * (hits[span:] - hits[:-span]) >= 2 * span * least - 1e-9)[0]
            if not len(starts):
                continue
            prints, own = _majority(sums[starts + span] - sums[starts], span), self.sizes[n]
            distinct, back = np.unique(prints, return_inverse=True)
            of, items = own.candidates(distinct)
            if not len(of):
                continue
            order = np.argsort(back, kind="stable")
            begin = np.searchsorted(back[order], np.arange(len(distinct) + 1))
            for f, item in zip(of.tolist(), items.tolist()):
                for start in starts[np.sort(order[begin[f]:begin[f + 1]])].tolist():
                    similarity = _similarity(Counter(hashes[start:start + span].tolist()), own.counts[item])
                    found = (similarity, -(at + start))
                    if similarity >= least and found > (lambda x: (x[0], -x[1]) if x else (0.0, 0))(best.get(own.ids[item])):
                        best[own.ids[item]] = (similarity, at + start, n)


def _similarity(a: Counter, b: Counter) -> float:
    common = (a & b).total()
    return common / (a.total() + b.total() - common)


def _stretches(shared: np.ndarray, widest: int, n: int) -> Iterator[tuple[int, int]]:
    """Shingle ranges of bounded length that together hold every window around a shared shingle."""
    heads = np.nonzero(np.diff(shared, prepend=-4 * widest - 4) > 2 * widest)[0]
    tails = np.append(heads[1:], len(shared)) - 1
    for a, b in zip(shared[heads].tolist(), shared[tails].tolist()):
        a, b = max(0, a - widest), min(n, b + widest + 1)
        for at in range(a, b, STRETCH):
            yield at, min(b, at + STRETCH + widest)


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items, in blocks of bounded number and letters."""
    own = pick(benchmark, "item_id", "text").dropna().distinct()
    # Numbered by group first, so that no task has to number all items.
    group = F.pmod(F.xxhash64("item_id"), F.lit(max(1, own.count() // ITEM_BLOCK * 2))).cast("int")
    order = Window.partitionBy("group").orderBy("item_id", "text")
    sized = own.withColumn("group", group).withColumn("n", F.row_number().over(order)).withColumn(
        "chars", F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    blocked = sized.withColumn("block", F.greatest(
        F.floor((F.col("n") - 1) / ITEM_BLOCK), F.floor(F.coalesce("chars", F.lit(0)) / CHAR_BLOCK)))
    for g, b in sorted(tuple(r) for r in blocked.select("group", "block").distinct().collect()):
        rows = blocked.filter((F.col("group") == g) & (F.col("block") == b)).select("item_id", "text").collect()
        yield [tuple(r) for r in rows]


def find(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, width: int = 5) -> DataFrame:
    """doc_id, item_id, similarity, start (word), n_words of the best window for each pair that reaches ``least``."""
    results = []
    for block in _blocks(benchmark):
        known = Benchmark(block, width)

        def work(batches: Iterator[pa.RecordBatch], known: Benchmark = known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [
                    (d, i, *m) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                    for i, m in known.matches(t, least).items()]
                doc_id, item_id, similarity, start, n = zip(*rows) if rows else ((),) * 5
                yield batch_of(
                    doc_id=pa.array(doc_id, pa.int64()), item_id=longs(item_id), similarity=pa.array(similarity, pa.float64()),
                    start=longs(start), n_words=longs(n))

        results.append(mapped(
            pick(docs, "doc_id", "text"), work, "doc_id long, item_id long, similarity double, start long, n_words long"))
    if not results:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, similarity double, start long, n_words long")
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"), "n_words"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("m")).select(
        "doc_id", "item_id", F.col("m.similarity").alias("similarity"), (-F.col("m.s")).alias("start"),
        F.col("m.n_words").alias("n_words"))


def without_matches(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, width: int = 5) -> DataFrame:
    """The documents without any window that reaches ``least`` against an item."""
    for block in _blocks(benchmark):
        known = Benchmark(block, width)
        docs = passing(docs, lambda known=known: lambda texts: [not known.matches(t, least) for t in texts])
    return docs
