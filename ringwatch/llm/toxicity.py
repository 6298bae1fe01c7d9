"""Toxicity scores from subword-bag embeddings, averaged into a linear softmax.

A word's vector is the mean of the vectors of its letter n-grams and of the word as a whole, all hashed into
one table, so a misspelling shares most of its vector with the word it comes from. A text's vector is the
mean over its words. Table and softmax are trained together in numpy on a bounded sample of labelled
texts; scoring then needs one number per hashed n-gram, a table of fixed size, and one pass over the texts.

Cases: null and empty texts, and texts without letters, get the model's score of an empty bag; repeated
rows are scored each; without labels of both kinds every score is the share of label 1 (0 without any); labels
that contradict each other count as 1; null labels are left out; further columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.common import batch_of, mapped, passing, pick, sliced

#: Bounds of the training sample: labelled rows, and letters of a text that may be among them.
TRAIN_ROWS = 3000
TRAIN_CHARS = 20_000
BUCKETS = 1 << 17
#: Words remembered per worker; the memo starts anew beyond that.
MEMO_WORDS = 1_000_000
#: Words remembered from one slice of texts to the next while a stage filters.
FILTER_WORDS = 200_000

#: Words of one length, at most so long, whose n-grams are hashed together.
TOGETHER, LETTERS = 4096, 48

WORD = re.compile(r"[^\W\d_]+")
#: The remainders of the 256 bytes by which a CRC-32 goes on.
CRC = np.array([zlib.crc32(bytes([i])) ^ zlib.crc32(bytes([0])) for i in range(256)], np.uint32)


def buckets(word: str) -> list[int]:
    """Places of a word's n-grams of 3 to 5 letters and of the word in the hashed table."""
    marked = f"<{word}>"
    grams = {marked[i:i + n] for n in (3, 4, 5) for i in range(len(marked) - n + 1)} | {marked}
    return [zlib.crc32(g.encode()) % BUCKETS for g in sorted(grams)]


def _means(words: tuple[str, ...], weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean weight of the n-grams of words of one length, and for which words it is not right: those that hold one twice."""
    size = len(words[0]) + 2
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).reshape(len(words), size)
    known, rank = np.unique(codes, return_inverse=True)
    # Letters as numbers of 12 bits that order them, none being zero.
    if len(known) > 4000:
        return np.zeros(len(words)), np.ones(len(words), bool)
    rank = rank.reshape(codes.shape).astype(np.uint64) + np.uint64(1)
    n_bytes = 1 + (codes >= 0x80) + (codes >= 0x800).astype(np.int64) + (codes >= 0x10000)
    most = int(n_bytes.max())
    # The UTF-8 bytes of every letter; of the shorter ones those beyond their length are not used.
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0], np.uint32)[n_bytes]
    utf8 = [lead | codes >> (6 * (n_bytes - 1)).astype(np.uint32)] + [
        np.uint32(0x80) | codes >> (6 * np.maximum(n_bytes - 1 - q, 0)).astype(np.uint32) & np.uint32(63) for q in range(1, most)]
    keys, cells = [], []
    for n in {*(n for n in (3, 4, 5) if n <= size), size}:
        width = size - n + 1
        rest, key = np.full((len(words), width), 0xFFFFFFFF, np.uint32), np.zeros((len(words), width), np.uint64)
        for j in range(n):
            for q in range(most):
                gone_on = CRC[(rest ^ utf8[q][:, j:j + width]) & np.uint32(255)] ^ rest >> np.uint32(8)
                rest = np.where(n_bytes[:, j:j + width] > q, gone_on, rest) if q else gone_on
            if j < 5:
                key |= rank[:, j:j + width] << np.uint64(52 - 12 * j)
        # The word as a whole follows its own first five letters.
        keys.append(key + np.uint64(n > 5))
        cells.append(~rest % np.uint32(BUCKETS))
    key = np.concatenate(keys, 1)
    order = np.argsort(key, axis=1, kind="stable")
    key, cell = np.take_along_axis(key, order, 1), np.take_along_axis(np.concatenate(cells, 1), order, 1)
    return np.ascontiguousarray(weight[cell]).mean(axis=1), (key[:, 1:] == key[:, :-1]).any(1)


@dataclass(frozen=True)
class Model:
    weight: np.ndarray  # what a hashed n-gram adds to the difference of the two classes
    bias: float

    def word(self, word: str) -> float:
        return float(self.weight[buckets(word)].mean())

    def words(self, words: list[str]) -> list[float]:
        """As ``word`` for each, to the last bit: words of a length are hashed together, the few that are left one by one."""
        out: dict[str, float] = {}
        alike: dict[tuple[int, bool], list[str]] = {}
        for w in words:
            if len(w) <= LETTERS:
                alike.setdefault((len(w), w.isascii()), []).append(w)
        for group in alike.values():
            for some in batched(group, TOGETHER):
                values, twice = _means(some, self.weight)
                out.update(zip(some, values.tolist()))
                for i in np.flatnonzero(twice).tolist():
                    del out[some[i]]
        return [out[w] if w in out else self.word(w) for w in words]

    def score(self, values: list[float]) -> float:
        z = self.bias + (sum(values) / len(values) if values else 0.0)
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def train(texts: list[str], labels: list[int], size: int = 4, epochs: int = 4, rate: float = 0.3, scale: float = 30.0,
          batch_docs: int = 48, seed: int = 1, least_z: float = 4.0, calm: float = 1e-6, boost: float = 4.0) -> Model:
    """Embeddings and softmax by gradient steps of adaptive size; ``scale`` multiplies the mean vector.

    The first component of an n-gram starts from how far its share of texts with label 1 is off, in standard
    deviations beyond ``least_z``; n-grams within that start, and stay, at zero, so that the few texts that
    hold a rare one are not learned by heart. Texts with label 1 weigh up to ``boost`` times as much, to make up for being few.
    """
    y = np.array(labels, np.int64)
    share = float(y.mean()) if len(y) else 0.0
    if not len(y) or share in (0.0, 1.0):
        odds = min(max(share, 1e-9), 1 - 1e-9)
        return Model(np.zeros(BUCKETS, np.float32), math.log(odds / (1 - odds)))
    rng = np.random.default_rng(seed)
    bags = [Counter(WORD.findall(t.lower())) for t in texts]
    names = sorted({w for b in bags for w in b})
    number = {w: i for i, w in enumerate(names)}
    own = [buckets(w) for w in names]
    lengths = np.array([len(g) for g in own])
    grams, begin = np.array([g for o in own for g in o]), np.concatenate([[0], np.cumsum(lengths)])
    held = np.zeros((2, BUCKETS))
    for b, label in zip(bags, labels):
        held[label, list({g for w in b for g in own[number[w]]})] += 1
    expected = held.sum(0) * share
    spread = np.sqrt(expected * (1 - share) * (1 - held.sum(0) / len(y))) + 0.5
    z = (held[1] - expected) / spread
    z = np.sign(z) * np.maximum(np.abs(z) - least_z, 0)
    learned = z != 0
    docs = [(np.array([number[w] for w in b], np.int64), np.array(list(b.values()), np.float32) / max(1, b.total())) for b in bags]
    table = rng.normal(0, 0.1, (BUCKETS, size)).astype(np.float32) * learned[:, None]
    table[:, 0] = z
    soft = rng.normal(0, 0.1, (size, 2)).astype(np.float32)
    soft[0] = -0.5, 0.5
    bias = np.array([1.5, -1.5], np.float32)
    seen = [np.full(BUCKETS, calm, np.float32), np.full_like(soft, 1e-6), np.full_like(bias, 1e-6)]
    for epoch in range(epochs):
        step = rate * (1 - epoch / (epochs + 1))
        order = rng.permutation(len(docs))
        for at in range(0, len(order), batch_docs):
            chosen = order[at:at + batch_docs]
            ids = np.concatenate([docs[d][0] for d in chosen])
            if not len(ids):
                continue
            part = np.repeat(np.arange(len(chosen)), [len(docs[d][0]) for d in chosen])
            share_of = np.concatenate([docs[d][1] for d in chosen])
            # Each word of the batch once, with what it weighs in every text.
            word_ids, back = np.unique(ids, return_inverse=True)
            weighs = np.zeros((len(chosen), len(word_ids)), np.float32)
            weighs[part, back] = share_of
            n = lengths[word_ids]
            cells = grams[np.repeat(begin[word_ids] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())]
            heads = np.concatenate([[0], np.cumsum(n)[:-1]])
            vectors = np.add.reduceat(table[cells], heads, axis=0) / n[:, None]
            means = scale * (weighs @ vectors)
            logits = means @ soft + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(chosen)), y[chosen]] -= 1
            p *= np.where(y[chosen], min(boost, 1 / share - 1), 1.0)[:, None] / len(chosen)
            grad_soft, grad_bias = means.T @ p, p.sum(0)
            grad_words = scale * (weighs.T @ (p @ soft.T)) / n[:, None]
            cell, where = np.unique(cells, return_inverse=True)
            to = np.repeat(np.arange(len(word_ids)), n)
            grad = np.stack([np.bincount(where, grad_words[to, k], len(cell)) for k in range(size)], 1) * learned[cell, None]
            seen[0][cell] += (grad ** 2).mean(1)
            table[cell] -= step * grad / np.sqrt(seen[0][cell])[:, None]
            seen[1] += grad_soft ** 2
            soft -= step * grad_soft / np.sqrt(seen[1])
            seen[2] += grad_bias ** 2
            bias -= step * grad_bias / np.sqrt(seen[2])
    return Model(scale * (table @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model from at most ``rows`` labelled texts of the training folds, the first by hash of their id."""
    marked = pick(labels, "doc_id", "toxic").dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = pick(docs, "doc_id", "text").filter(
        ~held_out(F.col("doc_id")) & F.col("text").isNotNull() & (F.length("text") <= TRAIN_CHARS))
    # Ids are matched and chosen first, so that no text but those of the sample moves.
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.select("doc_id").join(marked, "doc_id").orderBy(*by_hash).limit(rows).distinct()
    sample = known.join(F.broadcast(chosen), "doc_id").orderBy(*by_hash, "text").limit(rows).toArrow()
    return train(sample.column("text").to_pylist(), [int(t > 0) for t in sample.column("toxic").to_pylist()])


def held_out(doc_id: object) -> object:
    """Rows never learned from: the checksum of the id, as text, leaves 1 when divided by 3 (a null id: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


class Scorer:
    """Scores texts with one number remembered per word; those of words not met before are worked out together."""

    def __init__(self, model: Model):
        self.model, self.memo = model, {}

    def __call__(self, texts: list[str | None]) -> list[float]:
        own, memo = [WORD.findall((t or "").lower()) for t in texts], self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        new = [w for w in set().union(*own) if w not in memo]
        memo.update(zip(new, self.model.words(new)))
        return [self.model.score([memo[w] for w in o]) for o in own]


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in sliced(batches):
            scores = scorer(batch.column("text").to_pylist())
            yield batch_of(
                doc_id=batch.column("doc_id"), held_out=batch.column("held_out"), score=pa.array(scores, pa.float64()),
                predicted=pa.array([int(s >= threshold) for s in scores], pa.int32()))

    return mapped(
        pick(docs, "doc_id", "text").withColumn("held_out", held_out(F.col("doc_id"))), work,
        "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The documents whose score stays below the threshold."""

    def make() -> Callable[[list[str | None]], list[bool]]:
        scorer = Scorer(model)

        def keep(texts: list[str | None]) -> list[bool]:
            if len(scorer.memo) > FILTER_WORDS:
                scorer.memo.clear()
            return [s < threshold for s in scorer(texts)]

        return keep

    return passing(docs, make)
