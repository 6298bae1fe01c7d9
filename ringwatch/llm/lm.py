"""Cross-entropy difference of two matched n-gram models.

Both models are interpolated trigram models over one vocabulary, the 256 bytes of UTF-8: one of target texts, one of the
background, which is every text of the corpus. They share order, vocabulary, smoothing and, by scaling the
background's counts to the target's total, the weight of their evidence. A document's score is the mean over
its tokens of the target's loss less the background's: the lower, the more it reads like the target.

All documents are counted, each task for itself, and the counts are added up by trigram; no more than
256^3 of them can exist, which bounds the tables sent to the scoring tasks.

Cases: null and empty texts have no tokens and score 0; repeated rows count and score each; without target texts
all scores are 0; contradicting labels count as target; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.common import batch_of, longs, mapped, pick

#: What an order trusts its own counts: n / (n + STRENGTH) of the weight, the rest goes to the order below.
STRENGTH = 32.0
#: Bytes counted at a time.
CHUNK = 1 << 22


def _trigrams(raw: bytes) -> np.ndarray:
    """Each byte with the two before it (0 before the text), as one number."""
    b = np.frombuffer(b"\0\0" + raw, np.uint8).astype(np.int32)
    return b[:-2] << 16 | b[1:-1] << 8 | b[2:]


def counts(docs: DataFrame) -> DataFrame:
    """trigram, target, background: how often each occurs, by ``is_target`` of its document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: dict[bool, list[np.ndarray]] = {True: [], False: []}
            sums: list[tuple[np.ndarray, np.ndarray, bool]] = []

            def close(kind: bool) -> None:
                if parts[kind]:
                    sums.append((*np.unique(np.concatenate(parts[kind]), return_counts=True), kind))
                    parts[kind].clear()

            for text, kind in zip(batch.column("text").to_pylist(), batch.column("is_target").to_pylist()):
                own = _trigrams((text or "").encode())
                for at in range(0, len(own), CHUNK):
                    parts[kind].append(own[at:at + CHUNK])
                    if sum(map(len, parts[kind])) > CHUNK:
                        close(kind)
            close(True)
            close(False)
            for values, n, kind in sums:
                yield batch_of(trigram=pa.array(values, pa.int32()), target=longs(n * kind), background=longs(n))

    own = mapped(docs, work, "trigram int, target long, background long")
    return own.groupBy("trigram").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))


def _log_losses(trigrams: np.ndarray, n: np.ndarray) -> np.ndarray:
    """-log2 P(byte | two bytes before) of each trigram."""
    one = np.bincount(trigrams & 0xFF, n, 256)
    p1 = (one + 0.5) / (one.sum() + 128)
    pair, back2 = np.unique(trigrams & 0xFFFF, return_inverse=True)
    n2 = np.bincount(back2, n)
    head2 = np.bincount(pair >> 8, n2, 256)[pair >> 8]
    p2 = (n2 + STRENGTH * p1[pair & 0xFF]) / (head2 + STRENGTH)
    head, back3 = np.unique(trigrams >> 8, return_inverse=True)
    n3 = np.bincount(back3, n)[back3]
    return -np.log2((n + STRENGTH * p2[back2]) / (n3 + STRENGTH))


def score(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score of every document; ``targets`` has the ids of target texts."""
    wanted = pick(targets, "doc_id").dropna().distinct().withColumn("__t", F.lit(True))
    own = pick(docs, "doc_id", "text")
    # The same join at every size: the ids may be as many as the documents.
    marked = own.join(wanted.hint("merge"), "doc_id", "left").select("text", F.coalesce("__t", F.lit(False)).alias("is_target"))
    found = counts(marked).orderBy("trigram").toArrow()  # at most 256^3 rows
    trigrams = found.column("trigram").to_numpy()
    target, background = (found.column(c).to_numpy().astype(np.float64) for c in ("target", "background"))
    if target.sum():
        background = background * (target.sum() / background.sum())
        tables = [_log_losses(trigrams, n).astype(np.float32) for n in (target, background)]
    else:
        tables = [np.zeros(len(trigrams), np.float32)] * 2
    shared = docs.sparkSession.sparkContext.broadcast((trigrams, *tables))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, of_target, of_background = shared.value
        place = np.zeros(1 << 24, np.int32)
        place[known] = np.arange(len(known))
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                raw, sums = (text or "").encode(), np.zeros(2)
                own = _trigrams(raw)
                for at in range(0, len(own), CHUNK):
                    cells = place[own[at:at + CHUNK]]
                    sums += of_target[cells].sum(dtype=np.float64), of_background[cells].sum(dtype=np.float64)
                rows.append((len(raw), *(sums / max(1, len(raw)))))
            n, a, b = (np.array(x) for x in zip(*rows)) if rows else (np.zeros(0),) * 3
            yield batch_of(
                doc_id=batch.column("doc_id"), n_tokens=longs(n), target_loss=pa.array(a, pa.float64()),
                background_loss=pa.array(b, pa.float64()), score=pa.array(a - b, pa.float64()))

    return mapped(own, work, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")
