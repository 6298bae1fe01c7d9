"""Uniform sharding against its laws and as a round trip."""

import binascii
import collections
import math

from pyspark.sql import functions as F

from ringwatch.llm import sharding

#: Null and repeated ids, null, empty and long texts, equal texts, whole repeated rows, columns that clash with the operator's.
ROWS = ([(i, f"text {i % 7}", i, "x") for i in range(90)] + [(None, None, 1, "y"), (5, "", 2, None), (6, "é" * 70_000, 3, "z")]
        + [(7, "copy", 4, "c")] * 40)
SCHEMA = "doc_id long, text string, shard int, bucket string"


def sharded(spark, shards=12, **options):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return sharding.shuffled(docs, shards, **options)


def test_every_row_lies_in_one_slot_with_all_its_columns(spark):
    rows = sharded(spark, bucket_bytes=500).collect()
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted((tuple(r["record"]) for r in rows), key=key) == sorted(ROWS, key=key)
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(12))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1


def test_digest_columns(spark):
    got = sharding.digest(sharded(spark)).collect()
    expected = collections.Counter(
        (i, len((t or "").encode()) + 16, binascii.crc32((t or "").encode()), "rows", None) for i, t, *_ in ROWS)
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in got) == expected


def test_few_rows_and_none(spark):
    docs = spark.createDataFrame(ROWS[:5], SCHEMA)
    rows = sharding.shuffled(docs, 40).collect()
    assert len({r["shard"] for r in rows}) == 5 and {r["slot"] for r in rows} == {0}
    assert sharding.digest(sharding.shuffled(docs.limit(0))).count() == 0


def test_order_depends_on_the_seed_and_is_uniform(spark):
    docs = spark.range(0, 4000, 1, 4).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    orders = []
    for seed in (1, 1, 2):
        rows = sharding.shuffled(docs, 1, seed, bucket_bytes=4000).collect()
        orders.append([r["record"]["doc_id"] for r in sorted(rows, key=lambda r: r["slot"])])
    assert orders[0] == orders[1] != orders[2]
    for order in orders[1:]:
        # Of a uniform order: about one fixed point, half of all neighbours ascend, ranks do not correlate.
        assert sum(i == x for i, x in enumerate(order)) < 10
        assert abs(sum(a < b for a, b in zip(order, order[1:])) - 2000) < 5 * math.sqrt(4000 / 12)
        mean = 1999.5
        correlation = sum((i - mean) * (x - mean) for i, x in enumerate(order)) / (4000 * (4000 ** 2 - 1) / 12)
        assert abs(correlation) < 0.08


def test_inside_a_bucket_every_order_is_as_likely(spark):
    docs = spark.range(0, 3, 1, 1).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    seen = collections.Counter()
    for seed in range(36):
        rows = sorted(sharding.shuffled(docs, 1, seed).select("slot", "record.doc_id").collect())
        seen[tuple(r["doc_id"] for r in rows)] += 1
    assert len(seen) == 6 and max(seen.values()) <= 16


def test_written_shards_are_read_back_in_slot_order(spark, fresh_dir):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    sharding.write_shards(docs, f"{fresh_dir}/shards", 6)
    back = spark.read.parquet(f"{fresh_dir}/shards")
    assert back.count() == len(ROWS)
    for shard in range(6):
        slots = [r["slot"] for r in spark.read.parquet(f"{fresh_dir}/shards/shard={shard}").coalesce(1).collect()]
        assert sorted(slots) == list(range(len(slots)))
