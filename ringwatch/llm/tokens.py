"""Token ids and token counts of public tokenizers, with each distinct word encoded once per worker.

A text is cut into the pieces that the tokenizer encodes independently of each other; the library
encodes a piece the first time it is seen, and a bounded memo answers for it afterwards. Texts that
hold a special token's string go to the library whole.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

#: Pieces remembered per worker; the memo starts anew beyond that.
MEMO_PIECES = 1_000_000


# White space as the tokenizers' files mean it, and the part of it in the first 256 characters.
SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
LATIN_SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0"


CONTRACTION = "'s|'t|'re|'ve|'m|'ll|'d"


def _latin(kind: str) -> str:
    """The first 256 characters of a Unicode category, as a character class."""
    return "".join(f"\\x{c:02x}" for c in range(256) if unicodedata.category(chr(c))[0] == kind)


class Cut:
    """A pattern's pieces of a text; \\p{L}, \\p{N} and \\s in it are spelled out for texts of the first 256
    characters, where that is several times as fast."""

    def __init__(self, pattern: str):
        self.general = regex.compile(pattern.replace("\\s", SPACE))
        self.latin = re.compile(
            pattern.replace("\\p{L}", _latin("L")).replace("\\p{N}", _latin("N")).replace("\\s", LATIN_SPACE))

    def pieces(self, text: str) -> list[str]:
        if text.isascii():
            return self.latin.findall(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.general.findall(text)
        return self.latin.findall(text)


@lru_cache(maxsize=4)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


class ByteBpe:
    """ids of a byte-level BPE whose pre-tokenizer is the usual one (contractions, letters, numbers, rest)."""

    CUT = Cut(CONTRACTION + r"| ?[\p{L}]+| ?[\p{N}]+| ?[^\s\p{L}\p{N}]+|[\s]+(?![^\s])|[\s]+")

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.memo: dict[str, bytes] = {}
        self.encode = self._piece_encoder(path)

    def _piece_encoder(self, path: str):
        """Ids of one piece: merging by rank where ids stand in the order of the merges, else the library."""
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, merged = model["vocab"], ["".join(m) for m in model["merges"]]
        ids = [vocab[t] for t in merged]
        if ids == sorted(ids) and len(vocab) == 256 + len(merged):
            byte = {c: b for b, c in enumerate(byte_symbols())}
            ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items()}
            core = tiktoken.Encoding("pieces", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
            return lambda piece: core._encode_single_piece(piece.encode())
        return lambda piece: self.library.encode(piece, add_special_tokens=False).ids

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids, as the library gives them for the whole text."""
        if any(s in text for s in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        pieces, memo = self.CUT.pieces(text), self.memo
        try:
            return b"".join([memo[p] for p in pieces])
        except KeyError:
            pass
        if len(memo) > MEMO_PIECES:
            memo.clear()
        for p in set(pieces):
            if p not in memo:
                memo[p] = array("I", self.encode(p)).tobytes()
        return b"".join([memo[p] for p in pieces])


def byte_symbols() -> list[str]:
    """The printable letter that stands for each byte: itself, or the next free one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=4)
def prefix_counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


class PrefixCounter:
    """Exact token count at every prefix of a text, for a BPE with word ends.

    A text's white-space-free chunks are encoded independently, so a prefix counts the chunks before it
    and a prefix of one chunk. Inside a piece the counts come from one pass over its symbols: the last
    token of the encoding of the first i symbols is the one token that ends there and is compatible with
    the last token of the encoding before it (encoding the two together gives them back), so
    count(i) = count(i - its length) + 1. A prefix ends its word, so each prefix has a second entry
    whose last token carries the word end.
    """

    CUT = Cut(CONTRACTION + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    CHUNKS = re.compile(f"[^{SPACE}]+")
    END = "</w>"

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special_strings = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        with open(path, encoding="utf-8") as f:
            merges = json.load(f)["model"]["merges"]
        self.rank = {tuple(m): i for i, m in enumerate(merges)}
        self.tokens = {a + b for a, b in self.rank}
        self.longest = max(len(t.removesuffix(self.END)) for t in self.tokens)
        self.symbol = byte_symbols()
        self.fits: dict[tuple[str, str], bool] = {}
        self.states: dict[str, tuple[str, int]] = {}
        self.totals: dict[str, int] = {}
        self.tables: dict[str, np.ndarray] = {}

    def _merged(self, symbols: list[str]) -> list[str]:
        """BPE of a short run of symbols: the pair of lowest rank first, from the left."""
        while len(symbols) > 1:
            ranked = [(self.rank.get(p, 1 << 30), i) for i, p in enumerate(zip(symbols, symbols[1:]))]
            best, i = min(ranked)
            if best == 1 << 30:
                break
            symbols = [*symbols[:i], symbols[i] + symbols[i + 1], *symbols[i + 2:]]
        return symbols

    def _letters(self, token: str) -> list[str]:
        body = token.removesuffix(self.END)
        letters = list(body)
        if body != token:
            letters[-1] += self.END
        return letters

    def _compatible(self, left: str, right: str) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) > 2_000_000:
                self.fits.clear()
            known = self.fits[left, right] = self._merged(self._letters(left) + self._letters(right)) == [left, right]
        return known

    def _ending(self, run: str, i: int, last: list[str], end: str) -> tuple[str, int]:
        """The last token of the encoding of run[:i] and its start."""
        tokens = self.tokens
        for start in range(max(0, i - self.longest), i):
            token = run[start:i] + end
            if (start == i - 1 or token in tokens) and (
                    self._whole(token) if not start else self._compatible(last[start], token)):
                return token, start
        raise AssertionError("every run of symbols has an encoding")

    def _whole(self, token: str) -> bool:
        known = self.fits.get(("", token))
        if known is None:
            known = self.fits["", token] = self._merged(self._letters(token)) == [token]
        return known

    def _run(self, run: str, ends: list[int]) -> list[int]:
        """Token counts of the words made of the first ``e`` symbols of a run, for each e in ``ends``."""
        last, count = [""], [0]
        for i in range(1, len(run) + 1):
            token, start = self._ending(run, i, last, "")
            last.append(token)
            count.append(count[start] + 1)
        return [count[self._ending(run, e, last, self.END)[1]] + 1 for e in ends]

    def _state(self, run: str, end: str = "") -> tuple[str, int]:
        """Last token and token count of a short run: the same pass, just over the prefixes it needs."""
        known = self.states.get(run + end)
        if known is None:
            n, tokens = len(run), self.tokens
            for start in range(max(0, n - self.longest), n):
                token = run[start:] + end
                if start == n - 1 or token in tokens:
                    before = self._state(run[:start]) if start else ("", 0)
                    if self._compatible(before[0], token) if start else self._whole(token):
                        known = (token, before[1] + 1)
                        break
            if not end:
                if len(self.states) > MEMO_PIECES:
                    self.states.clear()
                self.states[run] = known
        return known

    def _piece(self, piece: str) -> list[int]:
        """Token count of every non-empty prefix of a normalised piece."""
        if piece[0] == "'" and len(piece) > 1 and self.CUT.pieces(piece[:-1]) != [piece[:-1]]:
            # A contraction's shorter prefixes fall apart into other pieces.
            return [sum(self._piece(p)[-1] for p in self.CUT.pieces(piece[:k])) for k in range(1, len(piece))] + [
                self._word(piece)]
        run, ends = self._symbols(piece)
        return self._run(run, ends)

    def _symbols(self, piece: str) -> tuple[str, list[int]]:
        ends, run = [], ""
        for letter in piece:
            run += "".join(self.symbol[b] for b in letter.encode())
            ends.append(len(run))
        return run, ends

    def _word(self, piece: str) -> int:
        """Token count of a normalised piece."""
        known = self.totals.get(piece)
        if known is None:
            if len(self.totals) > MEMO_PIECES:
                self.totals.clear()
            run, ends = (piece, None) if piece.isascii() else self._symbols(piece)
            known = self._state(run, self.END)[1] if len(run) < 100 else self._run(run, [len(run)])[0]
            self.totals[piece] = known
        return known

    def _normal(self, chunk: str) -> str:
        return chunk.lower() if chunk.isascii() else self.library.normalizer.normalize_str(chunk)

    def total(self, text: str) -> int:
        """Token count of a text without special strings."""
        pieces, totals = self.CUT.pieces(self._normal(text)), self.totals
        try:
            return sum([totals[p] for p in pieces])
        except KeyError:
            return sum([self._word(p) for p in pieces])

    def table(self, chunk: str) -> np.ndarray:
        """Token counts of the prefixes of 0, 1, … letters of a chunk."""
        known = self.tables.get(chunk)
        if known is None:
            if len(self.tables) > MEMO_PIECES // 8:
                self.tables.clear()
            normal = self._normal(chunk)
            if chunk.isascii() or all(self._normal(c) == n for c, n in zip(chunk, normal)) and len(chunk) == len(normal):
                counts, before = [0], 0
                for p in self.CUT.pieces(normal):
                    inside = self._piece(p)
                    counts += [before + c for c in inside]
                    before += inside[-1]
            else:  # letters that normalise together: each prefix is normalised anew
                counts = [self.total(chunk[:k]) for k in range(len(chunk) + 1)]
            known = self.tables[chunk] = np.array(counts, np.int32)
        return known

    def count(self, text: str) -> int:
        if any(s in text for s in self.special):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        return self.total(text)

    def prefixes(self, text: str) -> np.ndarray:
        """Token counts of the prefixes of 0, 1, … letters of a text."""
        counts, at = np.zeros(len(text) + 1, np.int32), 0
        for start, stop in self._specials(text):
            # A prefix that ends inside the special string holds its first letters as plain text.
            counts[at:stop] = counts[at] + self.prefixes_plain(text[at:stop - 1])
            counts[stop] = counts[start] + 1
            at = stop
        counts[at:] = counts[at] + self.prefixes_plain(text[at:])
        return counts

    def _specials(self, text: str) -> list[tuple[int, int]]:
        """Start and end of each special string; the library encodes what lies between them by itself."""
        return [m.span() for m in self.special_strings.finditer(text)]

    def prefixes_plain(self, text: str) -> np.ndarray:
        counts, before, at = np.zeros(len(text) + 1, np.int32), 0, 0
        for m in self.CHUNKS.finditer(text):
            counts[at:m.start() + 1] = before
            inside = self.table(m.group())
            counts[m.start():m.end() + 1] = before + inside
            before += int(inside[-1])
            at = m.end()
        counts[at:] = before
        return counts

    def longest_within(self, text: str, budget: int) -> int:
        """Letters of the longest prefix of at most ``budget`` tokens, without a table of the whole text."""
        at = 0
        for start, stop in self._specials(text):
            whole = self.total(text[at:start]) + 1
            if whole > budget:
                return at + self._longest_plain(text[at:stop - 1], budget)
            budget -= whole
            at = stop
        return at + self._longest_plain(text[at:], budget)

    def _longest_plain(self, text: str, budget: int) -> int:
        before = 0
        for m in self.CHUNKS.finditer(text):
            whole = self.total(m.group())
            if before + whole > budget:
                return m.start() + int(np.nonzero(before + self.table(m.group()) <= budget)[0][-1])
            before += whole
        return len(text)
