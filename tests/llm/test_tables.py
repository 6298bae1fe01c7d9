"""Top-k, URL rules and the pipeline on small fixtures."""

import math

import numpy as np
import pytest

from ringwatch.llm import topk, urls


@pytest.mark.parametrize("shard_rows", [10_000, 30])
def test_top_k_against_all_scores(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(topk, "LEAF_ROWS", 4)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(130)]
    rows += [(i, [0.5] * 6) for i in range(200, 220)] + [(300, None), (350, [1.0, None]), (400, [math.nan] * 6), (None, [1.0] * 6)]
    rows += [(450, [2.0, 1.0]), (500, [0.25] * 9), (501, []), (7, rows[7][1]), (50, rows[50][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    expected = set()
    for q, v in {(i, tuple(v)) for i, v in usable if i % 50 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q)
        expected |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])}
    assert {tuple(r) for r in topk.top_k(frame).collect()} == expected
    assert topk.top_k(frame.limit(0)).count() == 0


def test_url_rules(spark):
    rows = [
        (1, "http://A.Example.NET/en/x?q"), (2, "https://b.example.net/de/"), (3, "http://x.example.com/de/1#a"), (4, "http://o.org/fr/"),
        (5, None), (6, "no scheme"), (7, "http://www.cheap-pills.example.com/"), (8, "http://spam-farm.example.net/en/"),
        (9, "http://net"), (10, "http://xexample.com/de/"), (11, "http://e.com/?u=http://a.net/"), (1, "http://A.Example.NET/en/x?q")]
    got = [tuple(r) for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).drop("matched").collect()]
    assert sorted(got, key=str) == sorted([
        (1, "a.example.net", "/en/x", "example.net/en/", "allow"), (2, "b.example.net", "/de/", "net/", "block"),
        (3, "x.example.com", "/de/1", "example.com/de/", "block"), (4, "o.org", "/fr/", "org/fr/", "allow"),
        (5, "", "", None, "allow"), (6, "", "", None, "allow"), (7, "www.cheap-pills.example.com", "/", None, "block"),
        (8, "spam-farm.example.net", "/en/", "example.net/en/", "allow"), (9, "net", "", None, "allow"),
        (10, "xexample.com", "/de/", None, "allow"), (11, "e.com", "/", None, "allow"),
        (1, "a.example.net", "/en/x", "example.net/en/", "allow")], key=str)
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_rules_are_filed_under_whole_tokens():
    assert urls.Rule("ads.*/banner-*.js", "block").tokens == ["ads", "banner"]
    assert urls.Rule("a.b/c", "block").tokens == ["a", "b"]


def test_pipeline_stages_follow_each_other(spark):
    import corpus_pipeline

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "substring_dedup", "decontamination", "packing"]
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    ids = {r["doc_id"] for r in rows.collect()}
    assert ids and ids < {r["doc_id"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
