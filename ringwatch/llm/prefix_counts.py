"""Exact token counts of whole texts and of all their prefixes.

``tokens.PrefixCounter`` fills, per distinct word, the token count of each of its prefixes by dynamic
programming, so a text's table of prefix counts takes no further encoding, and questions on
truncation and budgets are answered from it.

Cases: a null text counts as empty (0 bytes, 0 tokens); repeated rows give a row each; an empty table gives
an empty result; a text of any length is one row and its memory is a few times its size; further
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ringwatch.llm.common import batch_of, longs, mapped, pick
from ringwatch.llm.tokens import prefix_counter


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, limit_chars: the letters of the longest prefix of at most
    ``limit`` tokens."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counter(tokenizer)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            counts = [counter.count(t) for t in texts]
            yield batch_of(
                doc_id=batch.column("doc_id"), n_bytes=longs([len(t.encode()) for t in texts]), n_tokens=longs(counts),
                over_limit=pa.array([n > limit for n in counts], pa.bool_()),
                limit_chars=longs([
                    len(t) if n <= limit else counter.longest_within(t, limit) for t, n in zip(texts, counts)]))

    return mapped(
        pick(docs, "doc_id", "text"), work,
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean, limit_chars long")


def prefix_table(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, prefix_tokens: the counts at the prefixes of 0, 1, … letters, as little-endian 32-bit integers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counter(tokenizer)
        for batch in batches:
            tables = [counter.prefixes(t or "").astype("<i4").tobytes() for t in batch.column("text").to_pylist()]
            yield batch_of(doc_id=batch.column("doc_id"), prefix_tokens=pa.array(tables, pa.binary()))

    return mapped(pick(docs, "doc_id", "text"), work, "doc_id long, prefix_tokens binary")


def cuts_within(tables: DataFrame, budgets: list[int]) -> DataFrame:
    """doc_id, budget, n_chars: from ``prefix_table`` rows, the longest prefix of at most ``budget`` tokens."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.repeat(np.arange(batch.num_rows), len(budgets))
            cuts = [
                int(np.nonzero(np.frombuffer(t, "<i4") <= b)[0][-1])
                for t in batch.column("prefix_tokens").to_pylist() for b in budgets]
            yield batch_of(
                doc_id=batch.column("doc_id").take(pa.array(ids)), budget=longs(budgets * batch.num_rows), n_chars=longs(cuts))

    return mapped(pick(tables, "doc_id", "prefix_tokens"), work, "doc_id long, budget long, n_chars long")
