"""Operators on texts against brute force, with odd rows: nulls, empty and long texts, copies, clashing columns."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from ringwatch.llm import decontamination, licenses, lm, packing, prefix_counts, simhash, substrings, toxicity
from ringwatch.llm.common import folded, words
from ringwatch.llm.tokens import prefix_counter

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Component_ID string, fp string, key int"


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "té", "Run") for b in ("x", "yy", "zo.", "'s", "12", "")]
    own = lambda n: " ".join(rng.choice(vocabulary, n))
    passage, base = own(60), own(120)
    changed = base.split()
    changed[50] = "other"
    return [
        (1, base), (2, base), (3, " ".join(changed)), (4, own(80) + "\n" + passage + "\n" + own(30)), (5, passage + " " + own(50)),
        (6, None), (7, ""), (8, " \t\n"), (9, "one"), (10, "one two"), (11, own(6000)), (12, "so " * 200), (None, own(40)),
        (14, base), (14, base), (15, "<|endoftext|> it's <|startoftext|> x"), (16, "Ünï cödé  日本 ½²́e")]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "s", len(t or ""), "c", "f", 1) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_simhash_against_all_pairs(spark, docs, texts):
    def print_of(text):
        own = folded(text)
        hashes = [xxhash.xxh64_intdigest(b" ".join(own[k:k + 3]), 42) for k in range(max(1, len(own) - 2))] if own else []
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if own else 0

    prints = [print_of(t) for _, t in texts]
    group = list(range(len(texts)))
    for _ in group:
        for a in range(len(texts)):
            for b in range(len(texts)):
                if (prints[a] ^ prints[b]).bit_count() <= 3:
                    group[a] = group[b] = min(group[a], group[b])
    least = {}
    for (i, _), g in zip(texts, group):
        least[g] = min(x for x in (least.get(g), i, 1 << 60) if x is not None)
    expected = Counter((i, p, None if least[g] == 1 << 60 else least[g]) for (i, _), p, g in zip(texts, prints, group))
    got = simhash.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], int.from_bytes(r["fp"]), r["component_id"]) for r in got) == expected


def test_vantage_trees_find_every_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_POINTS", 64)
    monkeypatch.setattr(simhash, "LEAF_POINTS", 8)
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 2**63, 40, dtype=np.uint64)
    points = {int(p) for p in seeds}
    for p in seeds[:30]:
        for _ in range(12):
            points.add(int(p) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False)))
    points = sorted(points)
    frame = spark.createDataFrame([(p.to_bytes(8), 1) for p in points], "fp binary, size long").repartition(4)
    got = simhash.components(simhash.links(frame, 3)).collect()
    parent = {p: p for p in points}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in points:
        for b in points:
            if a < b and (a ^ b).bit_count() <= 3:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    tied = Counter(root(p) for p in points)
    expected = {(p, root(p)) for p in points if tied[root(p)] > 1}
    assert {(int.from_bytes(r["node"]), int.from_bytes(r["root"])) for r in got} == expected


def test_one_of_each_keeps_rows_and_columns(docs):
    kept = simhash.one_of_each(docs.filter("doc_id in (1, 2, 3, 14, 4, 11)"))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) in ([1, 3, 4, 11], [1, 4, 11])


def test_substrings_against_all_windows(docs, texts):
    seen = Counter()
    for _, t in texts:
        own = words(t)
        seen.update(b" ".join(own[k:k + 35]) for k in range(len(own) - 34))
    expected = Counter()
    for i, t in texts:
        own = words(t)
        gone = np.zeros(len(own), bool)
        for k in range(len(own) - 34):
            if seen[b" ".join(own[k:k + 35])] > 1:
                gone[k:k + 35] = True
        kept = b" ".join(w for w, g in zip(own, gone) if not g)
        expected[i, len(own), int(gone.sum()), hashlib.sha256(kept).hexdigest()] += 1
    assert Counter(tuple(r) for r in substrings.removals(docs).collect()) == expected
    left = {r["doc_id"]: r for r in substrings.without_repeats(docs).collect()}
    assert left[1]["text"] == "" and left[9]["text"] == "one" and left[6]["text"] is None
    assert left[4]["n_chars"] == len(left[4]["text"]) and substrings.without_repeats(docs).columns == docs.columns


def test_substrings_with_extended_prefixes(docs, monkeypatch):
    plain = Counter(tuple(r) for r in substrings.removals(docs).collect())
    monkeypatch.setattr(substrings, "GROUP_SUFFIXES", 1)
    assert Counter(tuple(r) for r in substrings.removals(docs).collect()) == plain


def test_token_counts_and_every_prefix(docs, texts):
    library = Tokenizer.from_file(WORD_BPE)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    got = Counter(tuple(r)[:4] for r in prefix_counts.count_tokens(docs, WORD_BPE).collect())
    assert got == Counter((i, len((t or "").encode()), count(t or ""), count(t or "") > 2048) for i, t in texts)
    counter = prefix_counter(WORD_BPE)
    for _, t in texts:
        t = (t or "")[:150]
        exact = [count(t[:k]) for k in range(len(t) + 1)]
        assert counter.prefixes(t).tolist() == exact
        for budget in (0, 1, 5, 40):
            assert counter.longest_within(t, budget) == max(k for k, n in enumerate(exact) if n <= budget)
    tables = prefix_counts.prefix_table(docs.filter("doc_id = 9"), WORD_BPE)
    assert prefix_counts.cuts_within(tables, [0, 9]).collect()[1]["n_chars"] == 3


def test_prefix_counts_around_special_strings_take_no_encoding_of_prefixes(monkeypatch):
    library = Tokenizer.from_file(WORD_BPE)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    counter, a, b = prefix_counter(WORD_BPE), "<|startoftext|>", "<|endoftext|>"
    texts = [f"it's{b}Ünï {a}{a} x", f"{b}", f"{b[:-3]}{b}s end{b}{a[:-1]}", f"one two {a}\n\u0338 é{b}e\u0301", f"'{b}s {b.upper()} {a} "]
    exact = [[count(t[:k]) for k in range(len(t) + 1)] for t in texts]
    long = ("some words and more " * 5000) + b + "tail of it " * 4000 + a
    whole = count(long)
    asked = []
    monkeypatch.setattr(counter, "count", lambda t: asked.append(t))
    for t, own in zip(texts, exact):
        assert counter.prefixes(t).tolist() == own
        for budget in range(max(own) + 2):
            assert counter.longest_within(t, budget) == max(k for k, n in enumerate(own) if n <= budget)
    cut = counter.longest_within(long, 20_005)
    assert not asked and count(long[:cut]) <= 20_005 < count(long[:cut + 1]) and counter.prefixes(long)[-1] == whole


def test_packing_holds_every_token(docs, texts):
    library = Tokenizer.from_file(BYTE_BPE)
    packed = packing.pack_documents(docs, BYTE_BPE, keep_ids=True)
    rows = [r.asDict() for r in packed.collect()]
    expected = Counter()
    for i, t in texts:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        for k, (a, b) in enumerate(zip([0, *range(first, len(ids), 2048)], range(first, len(ids) + 1, 2048))):
            expected[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in rows) == expected
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by_sequence.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1]] and sum(n for _, n in own) <= 2048
    assert {(r["sequence_id"], r["length"]) for r in packing.sequences(packed).collect()} == {
        (s, sum(n for _, n in own)) for s, own in by_sequence.items()}


def test_minimum_slack_is_full_where_it_can_be():
    counts = np.zeros(11, np.int64)
    counts[[7, 3, 6, 4, 5]] = 4, 4, 2, 2, 2
    assert sum(times for _, times in packing.minimum_slack(counts)) == 7


def test_decontamination_finds_edited_passages(spark, docs, texts):
    passage = dict(texts)[5].split()[:60]
    edited = [*passage[:30], "changed", *passage[31:]]
    items = [(1, " ".join(passage)), (2, " ".join(edited)), (3, None), (4, "zz yy xx ww vv uu"), (None, "one"), (5, "")]
    benchmark = spark.createDataFrame(items + items[:1], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontamination.find(docs, benchmark).collect()}
    assert set(got) == {(4, 1), (5, 1), (4, 2), (5, 2)}
    assert got[4, 1]["start"] == 80 and got[4, 1]["similarity"] == 1.0 and got[4, 2]["similarity"] == 51 / 61
    left = decontamination.without_matches(docs, benchmark)
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == sorted(i or 0 for i, _ in texts if i not in (4, 5))


def test_decontamination_compares_texts_shorter_than_the_item(spark):
    item = [f"w{i}" for i in range(50)]
    rows = [(1, " ".join(item[5:])), (2, " ".join(item[:45])), (3, " ".join(item[12:])), (4, " ".join(item[:3])), (5, "x y"),
            (6, " ".join(item[9:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, "w0 w1 w2 w3")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): tuple(r)[2:] for r in decontamination.find(docs, benchmark).collect()}
    assert got.pop((2, 2)) == (1.0, 0, 4)
    assert got == {(1, 1): (41 / 46, 0, 45), (2, 1): (41 / 46, 0, 45), (6, 1): (37 / 46, 0, 41)}
    assert sorted(r["doc_id"] for r in decontamination.without_matches(docs, benchmark).collect()) == [3, 4, 5]


def test_decontamination_recall_near_the_threshold():
    rng = np.random.default_rng(11)
    for size, places in ((50, (20,)), (60, (25,)), (100, (30, 70)), (14, (0,)), (400, tuple(range(10, 350, 46)))):
        found = total = 0
        for i in range(200):
            item = [f"w{x}" for x in rng.integers(0, 1 << 40, size)]
            edited = list(item)
            for at in places:
                edited[at] = "changed"
            own = [{tuple(x[k:k + 5]) for k in range(size - 4)} for x in (item, edited)]
            assert len(own[0] & own[1]) / len(own[0] | own[1]) >= 0.8
            text = " ".join([*(f"a{x}" for x in rng.integers(0, 1 << 40, 20)), *edited, "end"])
            found += i in decontamination.Benchmark([(i, " ".join(item))], 5).matches(text, 0.8)
            total += 1
        assert found == total, (size, found)


def test_licenses_by_sentence_sequences(spark):
    bsd = "\n".join(t for n, t in licenses.SENTENCES if n in ("BSDredist", "BSDsource", "BSDbinary"))
    rows = [(1, "Text. Released under the MIT  license."), (2, bsd), (3, "no licence here"), (4, None), (5, ""),
            (6, "Licensed under CC BY-NC 4.0.\nmore\nLicensed under CC BY-NC 4.0."), (7, "the MIT License")]
    got = {(r["doc_id"], r["license"], r["first_sentence"], r["n_found"])
           for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, "MIT", 1, 1), (2, "BSD-2-Clause", 0, 1), (6, "CC-BY-NC-4.0", 0, 2)}


def test_licenses_wrapped_over_lines(spark):
    import textwrap

    known = dict(licenses.SENTENCES)
    wrapped = lambda mark, *names: "\n".join(
        mark + line for line in textwrap.wrap(" ".join(known[n] for n in names), 72))
    rows = [
        (1, "Copyright 2024 Some One\n" + wrapped("", "MITperm") + "\n\n" + wrapped("", "MITnotice") + "\n\n" + wrapped("", "AsIs")),
        (2, "/*\n" + wrapped(" * ", "BSDredist") + "\n *\n" + wrapped(" * ", "BSDsource").replace(" * ", " * 1. ", 1) + "\n" + wrapped(" * ", "BSDbinary") + "\n */"),
        (3, wrapped("// ", "ISCperm").replace("\n", "\r\n")), (4, wrapped("# ", "GPLredist")), (5, wrapped("dnl ", "MPL2")),
        (6, wrapped("", "GPL2redist")), (7, "Released under\n\nthe MIT License."), (8, "Released under.\nthe MIT License."),
        (9, "Licensed under the Apache License, Version 2.0\nLicensed under CC BY 4.0\n")]
    got = {(r["doc_id"], r["license"], r["n_found"])
           for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {
        (1, "MIT", 1), (2, "BSD-2-Clause", 1), (3, "ISC", 1), (4, "GPL-3.0-or-later", 1), (5, "MPL-2.0", 1),
        (6, "GPL-2.0-or-later", 1), (9, "Apache-2.0", 1), (9, "CC-BY-4.0", 1)}


def test_lm_scores_against_plain_counts(spark):
    rows = [(1, "abab abab abab"), (2, "zzzz qqqq"), (3, "abab"), (4, None), (5, ""), (1, "abab abab abab")]
    targets = spark.createDataFrame([(1,), (1,), (None,)], "doc_id long")
    got = {r["doc_id"]: r for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string"), targets).collect()}
    assert got[3]["score"] < 0 < got[2]["score"] and got[4]["score"] == got[5]["score"] == 0 and got[3]["n_tokens"] == 4
    tri = Counter()
    for i, t in rows:
        if i == 1:
            raw = b"\0\0" + t.encode()
            tri.update(zip(raw, raw[1:], raw[2:]))
    n = sum(tri.values())
    one, two, head2, head3 = Counter(), Counter(), Counter(), Counter()
    for (x, y, z), c in tri.items():
        one[z] += c
        two[y, z] += c
        head2[y] += c
        head3[x, y] += c
    loss, raw = 0.0, b"\0\0abab"
    for x, y, z in zip(raw, raw[1:], raw[2:]):
        p = (one[z] + 0.5) / (n + 128)
        p = (two[y, z] + 32 * p) / (head2[y] + 32)
        loss -= np.log2((tri[x, y, z] + 32 * p) / (head3[x, y] + 32))
    assert got[3]["target_loss"] == pytest.approx(loss / 4, abs=1e-5)


def test_toxicity_learns_words_and_misspellings(spark):
    rng = np.random.default_rng(0)
    plain = [f"{a}{b}{c}" for a in "bcdf" for b in ("ara", "elo", "ini") for c in "kmps"]
    rows, labels = [], []
    for i in range(500):
        own, bad = list(rng.choice(plain, 60)), i % 5 == 0
        if bad:
            own[7] = own[33] = "vilewordish" if i % 2 else "awfulness"
        rows.append((i, " ".join(own)))
        labels.append((i, int(bad)))
    extra = [(1000, " ".join(rng.choice(plain, 60)) + " vileworddish awfullness vilewordisch"), (1001, None), (1002, ""), (None, "x")]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(3, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.fit(docs, marks)).collect()}
    held = [i for i, _ in rows if got[i]["held_out"]]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _ in rows)
    assert np.mean([got[i]["predicted"] == labels[i][1] for i in held]) > 0.97
    assert got[1000]["predicted"] == 1 and 0 <= got[1001]["score"] == got[1002]["score"] <= 1
    none = toxicity.fit(docs, marks.filter("toxic = 5"))
    assert toxicity.score(docs, none).filter("predicted = 1").count() == 0


def test_empty_tables(spark, docs):
    empty, benchmark = docs.limit(0), spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for result in (
            simhash.near_duplicates(empty), simhash.one_of_each(empty), substrings.removals(empty), substrings.without_repeats(empty),
            prefix_counts.count_tokens(empty, WORD_BPE), packing.pack_documents(empty, BYTE_BPE),
            decontamination.find(empty, benchmark), licenses.scan(empty), lm.score(empty, labels.select("doc_id")),
            toxicity.score(empty, toxicity.fit(empty, labels))):
        assert result.count() == 0


def test_toxicity_sample_is_the_first_rows_by_hash_of_id(spark, monkeypatch):
    from pyspark.sql import functions as F
    rows = [(i, f"text {i} {c}") for i in range(60) for c in range(1 + i % 3)] + [(None, "x"), (7, None), (8, "y" * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("toxic", F.lit(5))
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(4, 1), (6, None)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "train", lambda texts, marks: list(zip(texts, marks)))
    hashed = dict(spark.range(60).select("id", F.xxhash64("id")).collect())
    known = sorted(
        (hashed[i], i, t, int(i % 2 == 1 or i == 4)) for i, t in rows
        if i is not None and i < 50 and t is not None and len(t) <= toxicity.TRAIN_CHARS and zlib.crc32(str(i).encode()) % 3 != 1)
    for bound in (5, 13, 1000):
        assert toxicity.fit(docs, labels, bound) == [(t, y) for _, _, t, y in known[:bound]]


def test_words_scored_together_weigh_what_each_weighs_alone(monkeypatch):
    import random

    import numpy as np

    from ringwatch.llm import toxicity
    rng = random.Random(3)
    letters = "aäbcçdeéfghiłmnoñsßtuzжあ𝒷"
    words = list({"".join(rng.choice(letters[:rng.choice((6, len(letters)))]) for _ in range(rng.randrange(1, 14))) for _ in range(3000)})
    words += ["a", "aaaaaa", "banana", "x" * 60, "Ünder", "日本語", "b" * 48]
    model = toxicity.Model(np.random.default_rng(0).normal(0, 1, toxicity.BUCKETS).astype(np.float32), 0.1)
    expected, alone, plain = [model.word(w) for w in words], [], toxicity.Model.word
    monkeypatch.setattr(toxicity.Model, "word", lambda self, w: alone.append(w) or plain(self, w))
    assert model.words(words) == expected
    # Only words that hold an n-gram twice, or are very long, are left to be hashed one by one.
    assert 0 < len(alone) < len(words) / 10 and {"aaaaaa", "banana", "x" * 60} <= set(alone)
    texts = ["banana ünder banana", None, "", "日本語 x1y", "123"]
    scored = toxicity.Scorer(model)(texts)
    assert scored == [model.score([plain(model, w) for w in toxicity.WORD.findall(t or "")]) for t in texts]
