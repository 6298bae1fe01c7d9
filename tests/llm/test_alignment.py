"""Alignment of two tokenizers against a plain walk over byte offsets with the libraries' own tokens."""

import collections
import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ringwatch.llm import alignment
from ringwatch.llm.tokens import byte_symbols

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

TEXTS = ["the cat sat on the mat", "the cat sat on the mat", "the the the", None, "", " ", "  leading and   many    spaces ",
         "naïve café 東京 \U0001f600 end", "tab\tand\nlines\r\n\n next", "<|endoftext|> is <s> plain </s> text <unk>", "a▁b ▁c",
         "x" * 3000, "word " * 4000, "Größe straße 12345 don't it's", "ﬁ ligature ½ ① Å", "\x00\x01 control", "…—–", "unspaced東京都東京"]


@pytest.fixture(scope="module")
def plain():
    a, b = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    byte = {c: i for i, c in enumerate(byte_symbols())}

    def tokens(text):
        if not text:
            return [], []
        left = a.encode(" " + text, add_special_tokens=False).ids
        left = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in left]
        right = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
                 for i in b.encode(text) for p in [b.id_to_piece(i)]]
        whole = (" " + text).encode()
        if b"".join(t for _, t in left) != whole or b"".join(t for _, t in right) != whole:
            return [], []
        return left, right

    def aligned(text):
        left, right = tokens(text)
        ends = []
        for side in (left, right):
            at, done = 0, {}
            for n, (_, t) in enumerate(side):
                at += len(t)
                done[at] = n
            ends.append(done)
        groups, links, p, q = [], [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            i, j = ends[0][e], ends[1][e]
            groups.append(",".join(str(x) for x, _ in left[p:i + 1]) + "|" + ",".join(str(x) for x, _ in right[q:j + 1]))
            links.append((left[i][0], right[j][0]))
            p, q = i + 1, j + 1
        return len(left), len(right), ";".join(groups), links
    return aligned


def expected(plain, texts):
    done = [plain(t) for t in texts]
    counts = collections.Counter(x for _, _, _, links in done for x in links)
    highest = collections.defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [(n_a, n_b, len(links), len(links), hashlib.sha256(groups.encode()).hexdigest() if groups else "",
             sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links))
            for n_a, n_b, groups, links in done]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


@pytest.mark.parametrize("broadcast_pairs, chunk_bytes", [(alignment.BROADCAST_PAIRS, alignment.CHUNK_BYTES), (0, 100)])
def test_against_a_plain_walk(spark, plain, broadcast_pairs, chunk_bytes, monkeypatch):
    rows = [(i if i != 4 else None, t, 0, "clash") for i, t in enumerate(TEXTS)] + [(1, TEXTS[1], 0, "repeated")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int, pairs string").repartition(3)
    monkeypatch.setattr(alignment, "CHUNK_BYTES", chunk_bytes)
    aligned = alignment.align_documents(docs, A_PATH, public_tokenizers.PATTERN, B_PATH)
    got = alignment.scored(aligned, alignment.link_counts(aligned), broadcast_pairs).collect()
    wanted = [(r[0], *e) for r, e in zip(rows, expected(plain, [r[1] for r in rows]))]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r[c] for c in ["doc_id", *COLUMNS]) for r in got), key=key) == sorted(wanted, key=key)
    assert any(w[1] == 0 and t for w, t in zip(wanted, TEXTS))  # some text is not spelled by its tokens


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(docs, A_PATH, public_tokenizers.PATTERN, B_PATH).count() == 0


def test_groups_are_given_out_when_asked_for(spark, plain):
    docs = spark.createDataFrame([(1, TEXTS[0])], "doc_id long, text string")
    row = alignment.align_documents(docs, A_PATH, public_tokenizers.PATTERN, B_PATH, with_groups=True).first()
    assert row["groups"] == plain(TEXTS[0])[2]


def test_a_full_memo_starts_anew(plain, monkeypatch):
    monkeypatch.setattr(alignment, "MEMO_WINDOWS", 10)
    both = alignment.Aligner(alignment.ByteSide(A_PATH, public_tokenizers.PATTERN), alignment.PieceSide(B_PATH))
    for text in TEXTS * 2:
        assert both.align([text])[0][3] == plain(text)[2]
    assert [row[3] for row in both.align(TEXTS)] == [plain(t)[2] for t in TEXTS]
    assert both.older and len(both.older) < 60


@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet=st.sampled_from(list("abT '’.,\t\n\r  012éß東▁<>|s\x1c\x85\xa0 Ġ")), max_size=60))
def test_any_text(plain, text):
    both = alignment.aligner(A_PATH, public_tokenizers.PATTERN, B_PATH)
    n_a, n_b, n_groups, groups, links = both.align([text])[0]
    assert (n_a, n_b, groups) == plain(text)[:3]
    assert [(int(x) >> 32, int(x) & 0xFFFFFFFF) for x in links] == plain(text)[3]
