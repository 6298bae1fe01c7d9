"""Word runs that occur more than once, found among prefix-partitioned sorted suffixes.

A window is ``width`` consecutive words of a text. Each window has one anchor: the position in it whose
next ``PREFIX`` words hash lowest (the last of equals), so equal windows have equal anchors at equal places.
The suffixes at anchors are divided by their first words; a prefix that stands only once cannot lead to
a repeat and is dropped. The suffixes of the other prefixes are brought together with the words around
them, prefix by prefix; their windows of ``width`` words are sorted, and one that equals a neighbour is a repeat. No suffix tree
is built: common lengths and internal nodes of other depths are not computed. A prefix with more suffixes than fit
one group is settled by counting 128-bit hashes of its whole windows instead.

Texts stand for all their copies: a text that several rows hold repeats in every window.

Cases: null and empty texts have no words; texts shorter than a window never repeat; repeated rows are copies;
an empty table gives an empty result; ids may be null or repeat; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.config import BROADCAST_ROWS
from ringwatch.llm.common import batch_of, cut, longs, mapped, pick, sliced, words

WIDTH = 35
PREFIX = 8
#: Suffixes of one prefix that are put in one tree; more than that, and the prefix is extended.
GROUP_SUFFIXES = 4000

_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _key(text: object = "text") -> object:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def _anchors(own: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Position, hash of the prefix, first window and number of windows of each anchor."""
    n = len(own)
    if n < width:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, own), np.uint64, n)
    rolled = np.zeros(n - PREFIX + 1, np.uint64)
    for j in range(PREFIX):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashed[j:n - PREFIX + 1 + j]
    rolled ^= rolled >> np.uint64(29)
    rolled *= np.uint64(0xBF58476D1CE4E5B9)
    rolled ^= rolled >> np.uint64(32)
    # The least of every ``span`` neighbours: the hash above, the place below, later places first.
    low = rolled >> np.uint64(32) << np.uint64(32) | np.uint64(0xFFFFFFFF) - np.arange(len(rolled), dtype=np.uint64)
    span, reach = width - PREFIX + 1, 1
    while 2 * reach <= span:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < span:
        low = np.minimum(low[:len(low) - (span - reach)], low[span - reach:])
    at = 0xFFFFFFFF - (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    place, first, count = np.unique(at, return_index=True, return_counts=True)
    return place, rolled[place].view(np.int64), first, count


def _profiles(docs: DataFrame, width: int) -> DataFrame:
    """Per row: doc_id, key of the text, n_words, digest of all words, a row number, anchors."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for batch in sliced(batches):
            counts, digests, found = [], [], []
            for text in batch.column("text").to_pylist():
                own = words(text)
                counts.append(len(own))
                digests.append(hashlib.sha256(b" ".join(own)).hexdigest())
                found.append(_anchors(own, width))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(f[0]) for f in found])]), pa.int32())
            lists = [
                pa.ListArray.from_arrays(offsets, longs(np.concatenate([f[k] for f in found]) if found else []))
                for k in (1, 2, 3)]
            yield batch_of(
                doc_id=batch.column("doc_id"), key=batch.column("key"), n_words=longs(counts), digest=pa.array(digests, pa.string()),
                row=longs(np.arange(row, row + len(counts))), hashes=lists[0], firsts=lists[1], windows=lists[2])
            row += len(counts)

    return mapped(
        pick(docs, "doc_id", "text").withColumn("key", _key()), work,
        "doc_id long, key binary, n_words long, digest string, row long, "
        "hashes array<long>, firsts array<long>, windows array<long>")


def _runs(starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the word runs that windows at sorted ``starts`` cover."""
    heads = np.nonzero(np.diff(starts, prepend=-2 * width) > width)[0]
    tails = np.append(heads[1:], len(starts)) - 1
    return starts[heads], starts[tails] + width


def repeated_suffixes(suffixes: np.ndarray) -> np.ndarray:
    """Which rows of word numbers occur more than once: a neighbour in sorted order has the whole row in common."""
    if not len(suffixes):
        return np.zeros(0, bool)
    view = np.ascontiguousarray(suffixes.astype(">u4")).view(np.dtype((np.void, 4 * suffixes.shape[1]))).ravel()
    order = np.argsort(view, kind="stable")
    ordered = suffixes[order]
    deep = (ordered[1:] == ordered[:-1]).all(1)
    out = np.zeros(len(suffixes), bool)
    out[order[1:]] |= deep
    out[order[:-1]] |= deep
    return out


def _tree_spans(grouped: DataFrame, width: int) -> DataFrame:
    """key, start, stop of repeats, from suffixes with their words; rows of a prefix follow each other."""

    def solve(batch: pa.Table) -> pa.RecordBatch | None:
        numbers: dict[bytes, int] = {}
        flat, begins, firsts = [], [], batch.column("first").to_numpy()
        counts = np.zeros(len(batch), np.int64)
        for i, context in enumerate(batch.column("context").to_pylist()):
            own = context.split()
            begins.append(len(flat))
            counts[i] = len(own) - width + 1
            flat += [numbers.setdefault(w, len(numbers)) for w in own]
        of = np.repeat(np.arange(len(batch)), counts)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
        matrix = np.lib.stride_tricks.sliding_window_view(np.array(flat, np.uint32), width)[np.array(begins)[of] + nth]
        hit = repeated_suffixes(matrix)
        of, at = of[hit], firsts[of[hit]] + nth[hit]
        if not len(of):
            return None
        # Windows of one suffix that overlap or touch become one run.
        head = np.append(True, (of[1:] != of[:-1]) | (at[1:] - at[:-1] > width))
        tail = np.append(np.nonzero(head)[0][1:], len(of)) - 1
        return batch_of(
            key=pa.array(batch.column("key").take(pa.array(of[head])).to_pylist(), pa.binary()),
            start=longs(at[head]), stop=longs(at[tail] + width))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in sliced(batches):
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            prefix = rows.column("prefix").to_numpy()
            # The last prefix may go on in the next batch.
            last = int(np.nonzero(prefix != prefix[-1])[0][-1]) + 1 if (prefix != prefix[-1]).any() else 0
            same = held and held[-1].column("prefix")[0].as_py() == prefix[-1]
            if last or held and not same:
                done = solve(pa.concat_tables([*held, rows.slice(0, last)]))
                held = []
                if done is not None:
                    yield done
            held.append(rows.slice(last))
        if held and (done := solve(pa.concat_tables(held))) is not None:
            yield done

    return mapped(grouped, work, "key binary, start long, stop long")


def repeats(docs: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables: the profile of each row (doc_id, key, n_words, digest), copies (key, copies, lead: a row's id),
    and by text (key, text, spans) the runs of words that other windows repeat, for texts with any."""
    if not PREFIX < width:
        raise ValueError(f"a window has more than {PREFIX} words")
    rows = cut(_profiles(docs, width))
    copies = cut(rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("row", "doc_id")).alias("lead")).select(
        "key", "copies", F.col("lead.row").alias("row"), F.col("lead.doc_id").alias("lead")))
    # The lists of anchors stay where they are; only the numbers of the rows that are copies are brought to them.
    others = cut(rows.select("key", F.col("row").alias("own")).join(copies.filter("copies > 1"), "key").filter("own <> row").select(
        F.col("own").alias("row")))
    few = others.count() <= BROADCAST_ROWS
    leads = rows.filter(F.size("hashes") > 0).join(F.broadcast(others) if few else others, "row", "left_anti")
    # The key comes back for the anchors that are left; till then a row is its number.
    anchors = leads.select("row", F.explode(F.arrays_zip("hashes", "firsts", "windows")).alias("a")).select(
        "row", F.col("a.hashes").alias("prefix"), F.col("a.firsts").alias("first"), F.col("a.windows").alias("windows"))
    # Written, so that the join that follows can split a prefix with very many suffixes.
    shared = cut(anchors.groupBy("prefix").agg(F.count(F.lit(1)).alias("suffixes")).filter("suffixes > 1"))
    wanted = anchors.join(shared, "prefix").groupBy("row").agg(
        F.collect_list(F.struct("prefix", "first", "windows", "suffixes")).alias("anchors")).join(  # of one text
        copies.select("row", "key", "lead"), "row").drop("row")
    texts = pick(docs, "doc_id", "text").withColumn("key", _key())
    texts = cut(texts.join(wanted, "key").filter(F.col("doc_id").eqNullSafe(F.col("lead"))).select("key", "text", "anchors"))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for key, text, own in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "anchors"))):
                all_words = words(text)
                yield batch_of(
                    prefix=longs([a["prefix"] for a in own]), key=pa.array([key] * len(own), pa.binary()),
                    first=longs([a["first"] for a in own]),
                    context=pa.array([b" ".join(all_words[a["first"]:a["first"] + a["windows"] - 1 + width]) for a in own], pa.binary()))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for key, text, own in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "anchors"))):
                all_words = words(text)
                nodes: dict[bytes, list[int]] = {}
                for s in sorted(s for a in own for s in range(a["first"], a["first"] + a["windows"])):
                    nodes.setdefault(xxhash.xxh3_128_digest(b" ".join(all_words[s:s + width])), []).append(s)
                # One row per node and text, however often the text repeats itself.
                for part in batched(nodes.items(), 10_000):
                    runs = [_runs(np.array(starts), width) for _, starts in part]
                    yield batch_of(
                        node=pa.array([n for n, _ in part], pa.binary()), key=pa.array([key] * len(part), pa.binary()),
                        leaves=longs([len(starts) for _, starts in part]),
                        spans=pa.array([[{"start": x, "stop": y} for x, y in zip(*map(np.ndarray.tolist, r))] for r in runs], _SPANS))

    def some(condition: object) -> DataFrame:
        return texts.withColumn("anchors", F.filter("anchors", condition)).filter(F.size("anchors") > 0)

    short = mapped(some(lambda a: a["suffixes"] <= GROUP_SUFFIXES), contexts, "prefix long, key binary, first long, context binary")
    spans = _tree_spans(short.repartition("prefix").sortWithinPartitions("prefix"), width)
    spans = spans.select("key", F.array(F.struct("start", "stop")).alias("spans"))
    deep = cut(mapped(
        some(lambda a: a["suffixes"] > GROUP_SUFFIXES), windows,
        "node binary, key binary, leaves long, spans array<struct<start: long, stop: long>>"))
    nodes = cut(deep.groupBy("node").agg(F.sum("leaves").alias("leaves")).filter("leaves > 1").select("node"))
    spans = spans.unionByName(deep.join(nodes, "node").select("key", "spans"))
    by_text = spans.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"))  # of one text
    found = texts.select("key", "text").join(by_text, "key")
    return rows.select("doc_id", "key", "n_words", "digest"), copies.select("key", "copies"), found


def _covered(n: int, spans: list[dict]) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    for s in spans:
        edge[s["start"]] += 1
        edge[s["stop"]] -= 1
    return np.cumsum(edge[:-1]) > 0


def _kept(found: DataFrame) -> DataFrame:
    """key, removed, kept_digest, kept (text without the covered words, other white space as it was)."""
    word = re.compile(rb"[^\x20\x09-\x0d]+")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            removed, digests, kept = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                own, raw = words(text), text.encode()
                gone = _covered(len(own), spans)
                removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(b" ".join([w for w, g in zip(own, gone) if not g])).hexdigest())
                parts, at = [], 0
                for m, g in zip(word.finditer(raw), gone):
                    if g:
                        parts.append(raw[at:m.start()].rstrip(b" ") if parts or at else raw[at:m.start()])
                        at = m.end()
                parts.append(raw[at:])
                kept.append(b"".join(parts).decode().strip())
            yield batch_of(
                key=batch.column("key"), removed=longs(removed), kept_digest=pa.array(digests, pa.string()),
                kept=pa.array(kept, pa.string()))

    return mapped(found, work, "key binary, removed long, kept_digest string, kept string")


def removals(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: what is left of each row's words after all repeats go."""
    rows, copies, found = repeats(docs, width)
    own = _kept(found).select("key", "removed", "kept_digest").dropDuplicates(["key"])
    by_text = copies.filter("copies > 1").join(own, "key", "full")
    whole = (F.col("copies") > 1) & (F.col("n_words") >= width)
    return rows.join(by_text, "key", "left").select(
        "doc_id", "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_digest", "digest")).alias("kept_sha256"))


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents, each text without its repeated words; a text without any stays as it is (n_chars follows)."""
    names = list(docs.columns)
    _, copies, found = repeats(docs, width)
    own = _kept(found).select(F.col("key").alias("__key"), F.col("kept").alias("__kept")).dropDuplicates(["__key"])
    many = copies.filter("copies > 1").select(F.col("key").alias("__key"), F.lit(True).alias("__many"))
    numbered = docs.toDF(*[f"__c{i}" for i in range(len(names))])
    text = f"__c{names.index('text')}"
    joined = numbered.withColumn("__key", _key(text)).join(own.join(many, "__key", "full"), "__key", "left")
    n_words = F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    kept = F.when(F.col("__many") & (n_words >= width), F.lit("")).otherwise(F.coalesce("__kept", text))
    joined = joined.withColumn(text, kept)
    if "n_chars" in names:
        size = f"__c{names.index('n_chars')}"
        changed = F.col("__many").isNotNull() | F.col("__kept").isNotNull()
        joined = joined.withColumn(size, F.when(changed, F.length(text).cast("long")).otherwise(F.col(size)))
    return joined.select(*numbered.columns).toDF(*names)
