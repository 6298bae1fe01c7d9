"""Documents packed into as few sequences of a fixed number of tokens as minimum bin slack finds.

Pieces of equal length are interchangeable, so the packing is decided on the histogram of lengths, which has
no more entries than a sequence has tokens, whatever the number of documents. Each step opens a
bin with the longest piece left and finds the fullest feasible rest by a subset-sum dynamic program over the
lengths still available, one bitset a step; the combination is repeated as often as its lengths last.
Each piece then finds its place from its rank among the pieces of its length: counts per written
part and length give the rank without sorting or collecting pieces.

Cases: a null text is packed as an empty one (just the closing id); repeated rows are packed each; an
empty table packs into nothing; a text of any length is cut into full pieces, the first taking what is
over; further columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringwatch.llm.common import batch_of, cut, longs, mapped, pick
from ringwatch.llm.tokens import byte_bpe

CAPACITY = 2048
#: Rows handed on at a time.
ROWS = 4096


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids (null unless kept); part and nth number the pieces of a length."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = byte_bpe(tokenizer), np.array([end_id], "<u4").tobytes()
        part, seen, rows = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64), []

        def flush() -> pa.RecordBatch:
            doc_id, piece, start, length, crc, nth, ids = zip(*rows)
            return batch_of(
                doc_id=pa.array(doc_id, pa.int64()), piece=pa.array(piece, pa.int32()), start=longs(start), length=longs(length),
                ids_crc32=longs(crc), part=longs([part] * len(rows)), nth=longs(nth), ids=pa.array(ids, pa.binary()))

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = tokens.ids(text or "") + end
                n = len(ids) // 4
                first = n % capacity or capacity
                edges = [0, *range(first, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    own = ids[4 * a:4 * b]
                    rows.append((doc_id, k, a, b - a, zlib.crc32(own), int(seen[b - a]), own if keep_ids else None))
                    seen[b - a] += 1
                if len(rows) >= ROWS:
                    yield flush()
                    rows = []
        if rows:
            yield flush()

    return mapped(
        pick(docs, "doc_id", "text"), work,
        "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long, ids binary")


def _fullest(counts: np.ndarray, room: int) -> Counter[int]:
    """The lengths, with repeats, that fill ``room`` best; larger lengths are tried first."""
    full, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in (np.nonzero(counts[1:room + 1])[0][::-1] + 1).tolist():
        left, take = min(int(counts[length]), room // length), 1
        while left:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & full
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, Counter()
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] += take
            at -= length * take
    return chosen


def minimum_slack(counts: np.ndarray) -> list[tuple[dict[int, int], int]]:
    """Bins as (pieces by length, how many bins hold just that); ``counts`` is indexed by length."""
    counts, capacity, bins = counts.copy(), len(counts) - 1, []
    for longest in range(capacity, 0, -1):
        while counts[longest]:
            counts[longest] -= 1
            chosen = _fullest(counts, capacity - longest)
            counts[longest] += 1
            chosen[longest] += 1
            times = min(int(counts[length]) // n for length, n in chosen.items())
            for length, n in chosen.items():
                counts[length] -= n * times
            bins.append((dict(chosen), times))
    return bins


def places(bins: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Per run of pieces of one length: length, first rank, pieces a bin, first bin, offset; sorted by the first two."""
    runs, taken, first_bin = [], Counter(), 0
    for chosen, times in bins:
        offset = 0
        for length, n in sorted(chosen.items(), reverse=True):
            runs.append((length, taken[length], n, first_bin, offset))
            taken[length] += n * times
            offset += n * length
        first_bin += times
    return np.array(sorted(runs), np.int64).reshape(-1, 5)


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset. ``cut_pieces`` must be a written table: it is read more than once."""
    counts = np.zeros(capacity + 1, np.int64)
    by_part = cut(cut_pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")))
    for row in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["n"]
    runs = places(minimum_slack(counts))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = cut_pieces.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    keys = runs[:, 0] << 44 | runs[:, 1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            run = runs[np.searchsorted(keys, length << 44 | rank, "right") - 1]
            nth = rank - run[:, 1]
            own = {c: batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            yield batch_of(
                **own, sequence_id=longs(run[:, 3] + nth // run[:, 2]),
                offset=longs(run[:, 4] + nth % run[:, 2] * length), ids=batch.column("ids"))

    return mapped(
        ranked, work,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, ids binary")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places; with ``keep_ids`` each carries its ids."""
    return pack(cut(pieces(docs, tokenizer, capacity, keep_ids=keep_ids)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, length, ids: the ids of each sequence in order, from pieces that carry theirs."""
    own = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))  # at most one sequence's tokens
    grouped = packed.groupBy("sequence_id").agg(own.alias("own"))
    # Pieces become text in hex, as arrays of binaries cannot be joined to one.
    joined = F.unhex(F.array_join(F.transform("own", lambda p: F.hex(p["ids"])), ""))
    total = F.aggregate("own", F.lit(0).cast("long"), lambda n, p: n + p["length"])
    return grouped.select("sequence_id", total.alias("length"), joined.alias("ids"))
