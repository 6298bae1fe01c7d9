"""Alignment of two tokenizers' tokens of the same text, at the bytes where tokens of both end.

Each text is tokenised as a whole by both sides. Where tokens of both end at the same byte and the next
token of both starts with a space, the text is cut; between such anchors lies a window of token ids, in
most cases one word. A window's alignment depends on nothing but its two id tuples, so it is worked out
once and remembered by them. Counts of linked ids are taken over the whole corpus and joined back.
"""

from __future__ import annotations

import gc
import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ringwatch.llm.common import batch_of, cut, longs, mapped, pick
from ringwatch.llm.tokens import byte_symbols

#: Windows remembered per worker, and bytes of ids up to which a window is: about a kilobyte each at the most.
MEMO_WINDOWS, LONG_WINDOW = 160_000, 128
#: Text bytes handled at a time.
CHUNK_BYTES = 256 << 10
#: Pairs of linked ids are broadcast only up to this number of them (16 bytes each, about 64 hashed).
BROADCAST_PAIRS = 1_000_000
SPACE_MARK = "▁"
NO_IDS = np.zeros(0, "<u4")


class Side:
    """One tokenizer: ids of a text, and for each id its bytes, their number and whether they start with a space."""

    #: Whether tokens are cut out of the text's bytes, so that they spell it if they are as long as it.
    lossless = False

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        self.texts = [str(i) for i in range(len(pieces))]
        self.lengths = [len(p) for p in pieces]
        self.length = np.array(self.lengths, np.int64)
        self.spaced = np.array([p[:1] == b" " for p in pieces])

    def spelled(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


class ByteSide(Side):
    """A byte-level BPE; strings of special tokens are plain text. It is given the space before the text."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        byte = {c: b for b, c in enumerate(byte_symbols())}
        entries = {i: bytes(byte[c] for c in t) for t, i in model["vocab"].items() if all(c in byte for c in t)}
        super().__init__([entries.get(i, b"") for i in range(max(entries) + 1)])
        order = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if order == sorted(order):
            # Ids stand in the order of the merges, so they are the ranks that a quicker library merges by.
            ranks = {piece: i for i, piece in entries.items()}
            self.lossless = True
            self.encode = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            library = Tokenizer.from_file(path)
            library.encode_special_tokens = True
            self.encode = lambda text: library.encode(text, add_special_tokens=False).ids


class PieceSide(Side):
    """A sentencepiece model, which puts the space before the text by itself."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = []
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            pieces.append(bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace(SPACE_MARK, " ").encode())
        super().__init__(pieces)

    def encode(self, text: str) -> list[int]:
        return self.library.encode(text)


@lru_cache(maxsize=2)
def aligner(a_path: str, a_pattern: str, b_path: str) -> Aligner:
    return Aligner(ByteSide(a_path, a_pattern), PieceSide(b_path))


class Aligner:
    """Alignments of texts, with a bounded memo of windows that is kept between batches of a worker."""

    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        self.memo: dict[tuple[bytes, bytes], tuple[str | None, bytes]] = {}
        self.older: dict[tuple[bytes, bytes], tuple[str | None, bytes]] = {}

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both sides, none where the text is empty or either side's tokens have not as many bytes as it.

        That A's tokens spell the text is settled here; that B's spell the same is checked window by window.
        """
        if text:
            spelled = (" " + text).encode()
            a, b = self.a.encode(" " + text), np.array(self.b.encode(text), "<u4")
            if (self.a.lossless or self.a.spelled(a) == spelled) and self.b.length[b].sum() == len(spelled):
                a = np.array(a, "<u4")
                if self.a.length[a].sum() == len(spelled):
                    return a, b
        return NO_IDS, NO_IDS

    def windows(self, a: np.ndarray, b: np.ndarray) -> tuple[list[tuple[bytes, bytes]], np.ndarray]:
        """The id tuples between anchors, as bytes, and the number of A's tokens up to the end of each.

        The texts of several documents may follow each other: each starts with a space on both sides, so an
        anchor lies between them.
        """
        a_ends, b_ends = np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b])
        a_free = np.flatnonzero(self.a.spaced[a[1:]])
        at = np.searchsorted(b_ends, a_ends[a_free])
        verified = (b_ends[at] == a_ends[a_free]) & self.b.spaced[b[np.minimum(at + 1, len(b) - 1)]]
        a_cuts = np.concatenate([a_free[verified] + 1, [len(a)]])
        b_cuts = np.concatenate([at[verified] + 1, [len(b)]])
        a_raw, b_raw = a.tobytes(), b.tobytes()
        a_at, b_at = [0, *(4 * a_cuts).tolist()], [0, *(4 * b_cuts).tolist()]
        return [(a_raw[i:j], b_raw[k:m]) for i, j, k, m in zip(a_at, a_at[1:], b_at, b_at[1:])], a_cuts

    def aligned(self, windows: list[tuple[bytes, bytes]]) -> list[tuple[str, bytes]]:
        """Each window's groups as text, and its links as 64-bit numbers with A's id in the upper half; no text where
        the two sides spell something else."""
        done = list(map(self.memo.get, windows))
        if None in done:
            missed = {w: None for w, d in zip(windows, done) if d is None}
            for w in missed:
                missed[w] = self.older.get(w)
            new = [w for w, d in missed.items() if d is None]
            missed.update(zip(new, self._learn(new)))
            done = [missed[w] if d is None else d for w, d in zip(windows, done)]
            self._remember(missed)
        return done

    def _remember(self, learned: dict[tuple[bytes, bytes], tuple[str, bytes]]) -> None:
        if len(self.memo) > MEMO_WINDOWS // 2:
            # What is still in use comes back from the older half; words that were met once go.
            self.older, self.memo = self.memo, {}
        self.memo.update([(w, d) for w, d in learned.items() if len(w[0]) + len(w[1]) <= LONG_WINDOW])

    def _learn(self, windows: list[tuple[bytes, bytes]]) -> list[tuple[str, bytes]]:
        """Alignments of windows that are not remembered, laid end to end: both sides of a window cover the same bytes.

        No token is empty, so one token of each side ends at a shared end, and a group is one link.
        """
        if not windows:
            return []
        a, b = np.frombuffer(b"".join([w[0] for w in windows]), "<u4"), np.frombuffer(b"".join([w[1] for w in windows]), "<u4")
        a_ends, b_ends = np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b])
        at = np.minimum(np.searchsorted(b_ends, a_ends), len(b_ends) - 1)
        i = np.flatnonzero(b_ends[at] == a_ends)
        j = at[i]
        pairs = ((a[i].astype("<i8") << 32) | b[j]).tobytes()
        a_text, b_text = list(map(self.a.texts.__getitem__, a.tolist())), list(map(self.b.texts.__getitem__, b.tolist()))
        a_to, b_to = (i + 1).tolist(), (j + 1).tolist()
        groups = [
            a_text[p] + "|" + b_text[q] if x - p == 1 == y - q else ",".join(a_text[p:x]) + "|" + ",".join(b_text[q:y])
            for p, x, q, y in zip([0, *a_to], a_to, [0, *b_to], b_to)]
        last = np.searchsorted(i, np.cumsum([len(w[0]) // 4 for w in windows]) - 1) + 1
        to = last.tolist()
        learned = [(";".join(groups[f:t]), pairs[8 * f:8 * t]) for f, t in zip([0, *to], to)]
        if self.a.spelled(a.tolist()) != self.b.spelled(b.tolist()):
            for k, (own_a, own_b) in enumerate(windows):
                if self.a.spelled(np.frombuffer(own_a, "<u4").tolist()) != self.b.spelled(np.frombuffer(own_b, "<u4").tolist()):
                    learned[k] = (None, b"")
        return learned

    def align(self, texts: list[str | None]) -> list[tuple[int, int, int, str, np.ndarray]]:
        """For each text: numbers of A's tokens, B's tokens and groups, the groups as text, and the links."""
        ids = [self.tokens(t) for t in texts]
        a, nothing = np.concatenate([one for one, _ in ids]), (0, 0, 0, "", np.zeros(0, np.int64))
        if not len(a):
            return [nothing] * len(texts)
        windows, a_cuts = self.windows(a, np.concatenate([one for _, one in ids]))
        done = self.aligned(windows)
        to = np.searchsorted(a_cuts, np.cumsum([len(one) for one, _ in ids]), side="right").tolist()
        out = []
        for (own_a, own_b), f, t in zip(ids, [0, *to], to):
            groups = [d[0] for d in done[f:t]]
            if None in groups:
                out.append(nothing)
                continue
            links = np.frombuffer(b"".join([d[1] for d in done[f:t]]), "<i8")
            out.append((len(own_a), len(own_b), len(links), ";".join(groups), links))
        return out


def align_documents(docs: DataFrame, a_path: str, a_pattern: str, b_path: str, with_groups: bool = False) -> DataFrame:
    """row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times (and groups): one row per document, written.

    ``pairs`` are the distinct links of the document, A's id * 2^32 + B's id, and ``times`` how often each
    occurs there. ``row`` tells equal ids and repeated rows apart. Null and empty texts, and texts that
    either side's tokens do not spell, have no tokens: zeros and an empty hash column.
    """
    rows = pick(docs, "doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, a_pattern, b_path)
        # Nothing here refers to itself; looking for such things would walk the memo over and over.
        gc.disable()
        try:
            for batch in batches:
                for at, upto in _chunks(batch.column(1)):
                    yield _aligned_batch(both, batch.slice(at, upto - at), with_groups)
        finally:
            gc.enable()

    schema = (f"row bigint, doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
              "pairs array<bigint>, times array<bigint>" + ", groups string" * with_groups)
    return cut(mapped(rows, work, schema))


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Spans of rows whose texts have about ``CHUNK_BYTES`` together; a longer text is a span of its own."""
    sizes = np.nan_to_num(pc.binary_length(texts).to_numpy(zero_copy_only=False)) + 1
    number = (np.cumsum(sizes) // CHUNK_BYTES).astype(np.int64)
    starts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist()]
    return zip(starts, [*starts[1:], len(texts)])


def _aligned_batch(both: Aligner, batch: pa.RecordBatch, with_groups: bool) -> pa.RecordBatch:
    sizes, hashes, texts, pairs, times = [], [], [], [], []
    for n_a, n_b, n_groups, groups, links in both.align(batch.column(1).to_pylist()):
        distinct, often = np.unique(links, return_counts=True)
        sizes.append((n_a, n_b, n_groups, len(links), len(distinct)))
        hashes.append(hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        pairs.append(distinct)
        times.append(often.astype(np.int64))
        if with_groups:
            texts.append(groups)
    n_a, n_b, n_groups, n_links, n_distinct = np.array(sizes, np.int64).T
    offsets = pa.array(np.concatenate([[0], np.cumsum(n_distinct)]).astype(np.int32))
    return batch_of(
        row=batch.column(2), doc_id=batch.column(0), n_a=longs(n_a), n_b=longs(n_b), n_groups=longs(n_groups), n_links=longs(n_links),
        groups_sha256=pa.array(hashes, pa.string()), pairs=pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(pairs))),
        times=pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(times))), **({"groups": pa.array(texts, pa.string())} if with_groups else {}))


def _occurrences(aligned: DataFrame, *more: str) -> DataFrame:
    return aligned.select(*more, F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times"))))


def link_counts(aligned: DataFrame) -> DataFrame:
    """pair, count, best: how many links of the corpus each pair of ids holds, and whether that is its B id's highest."""
    counts = cut(_occurrences(aligned).groupBy("pair").agg(F.sum("times").alias("count")).withColumn(
        "b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))))
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return cut(counts.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best")))


def scored(aligned: DataFrame, counts: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """The rows of ``align_documents`` with n_best and count_sum, without the links themselves.

    The counts are broadcast only when they are few; beyond that both sides are shuffled by pair, and Spark
    splits the frequent ones.
    """
    known = F.broadcast(counts) if counts.count() <= broadcast_pairs else counts
    sums = _occurrences(aligned, "row").join(known, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return aligned.drop("pairs", "times").join(sums, "row", "left").withColumns({
        "n_best": F.coalesce("n_best", zero), "count_sum": F.coalesce("count_sum", zero)}).drop("row")


def align(docs: DataFrame, a_path: str, a_pattern: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum for every document (doc_id, text).

    Tokens of no document are cut off, however long its text; equal texts and repeated rows count as often
    as they are there, null ids are kept, an empty table gives no rows and other columns are ignored.
    """
    aligned = align_documents(docs, a_path, a_pattern, b_path)
    return scored(aligned, link_counts(aligned))
