"""Byte-pair encoding and decoding by a vocabulary file with word ends (NFC, lower case, white space dropped).

A text is cut at the strings of special tokens, normalised and split into words as the file says. Each word is merged in a
contiguous rank array: the boundaries of its parts, the token of each part and the rank of each pair of neighbours. The
smallest rank is looked for, the boundary inside that pair deleted, and the ranks on both sides refreshed, until no pair has
a rank. Words up to ``SHORT`` bytes are merged side by side, the arrays of many words as rows of one matrix; the few longer
ones, whose scans would be quadratic, take their smallest rank from a heap.

Words seen before in a task are remembered, ``REMEMBERED`` at the utmost; this changes no result.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from broadsheet.llm.rows import shared, with_struct

SHORT = 64
MATRIX_ROWS = 2048
AT_ONCE = 1 << 20  # bytes of text whose words are merged together
REMEMBERED = 1 << 18
NONE = np.iinfo(np.int64).max
#: Texts of these code points are their own NFC but for kinds of white space, and lower-cased alike by all Unicode versions.
PLAIN = [(0x00, 0x17F), (0x2000, 0x206F), (0x20A0, 0x20BF)]
#: Code points that the pattern language of the vocabulary files counts as white space.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F]


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself where it is visible Latin-1, else the
    next one from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(0x100 + hidden.index(b)) for b in range(256)]


def _ranges(points: list[int]) -> str:
    return "".join(f"\\u{p:04x}" for p in points)


def _plain_pattern() -> str:
    """The file's word pattern, spelt out for plain texts."""
    points = [p for a, b in PLAIN for p in range(a, b + 1)]
    letters = _ranges([p for p in points if unicodedata.category(chr(p))[0] == "L"])
    numbers = _ranges([p for p in points if unicodedata.category(chr(p))[0] == "N"])
    return f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{_ranges(WHITE)}{letters}{numbers}]+"


@dataclass
class Tokenizer:
    """What a vocabulary file says, as plain arrays and texts."""

    tokens: list[str]
    pairs: np.ndarray  # left token << 32 | right token, ascending
    ranks: np.ndarray  # of each pair
    merged: np.ndarray  # token that a rank makes
    inner: np.ndarray  # token of each byte inside a word
    last: np.ndarray  # token of each byte at a word's end
    special: dict[str, int]
    rules: str  # the file without its vocabulary, for texts that are not plain
    _heap_ranks: dict[int, int] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str) -> Tokenizer:
        """Reads a vocabulary file on the driver. Only byte-level BPE with word ends and without unknown tokens is taken."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        end = model.get("end_of_word_suffix")
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or not end or odd or spec.get("decoder") or spec.get("post_processor"):
            raise ValueError(f"{path}: not a byte-level BPE vocabulary with word ends")
        vocab = dict(model["vocab"])
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [""] * (1 + max([*vocab.values(), *special.values()]))
        for token, i in [*vocab.items(), *special.items()]:
            tokens[i] = token
        ranked = {vocab[a] << 32 | vocab[b]: (rank, vocab[a + b]) for rank, (a, b) in enumerate(model["merges"])}
        pairs = np.array(sorted(ranked), np.int64)
        ranks = np.array([ranked[p][0] for p in pairs.tolist()], np.int64)
        merged = np.zeros(len(model["merges"]), np.int64)
        merged[ranks] = [ranked[p][1] for p in pairs.tolist()]
        letters = byte_letters()
        rules = {**spec, "truncation": None, "padding": None, "added_tokens": [], "model": {**model, "vocab": {}, "merges": []}}
        return cls(
            tokens, pairs, ranks, merged, np.array([vocab[c] for c in letters], np.int64),
            np.array([vocab[c + end] for c in letters], np.int64), special, json.dumps(rules),
        )

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, ``NONE`` where there is none; tokens below 0 have none."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], NONE)

    def merge_short(self, words: list[bytes]) -> list[bytes]:
        """The tokens of words, as little-endian 32-bit numbers."""
        size = np.array([len(w) for w in words])
        n, width = len(words), int(size.max())
        text = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        starts = np.minimum(np.arange(width)[None, :], size[:, None])  # boundaries; those at a word's end bound nothing
        part = np.where(starts < size[:, None] - 1, self.inner[text], np.where(starts < size[:, None], self.last[text], -1))
        ranks = np.full((n, width), NONE)
        ranks[:, :-1] = self.rank(part[:, :-1], part[:, 1:])
        live, out = np.arange(n), [b""] * n
        while len(live):
            row, at = np.arange(len(live)), ranks.argmin(axis=1)
            best = ranks[row, at]
            done = best == NONE
            if done.any():
                count = (starts[done] < size[live[done], None]).sum(axis=1) * 4
                flat = part[done].astype("<u4")
                for i, r, c in zip(live[done].tolist(), flat, count.tolist(), strict=True):
                    out[i] = r.tobytes()[:c]
                live, starts, part, ranks, at, best = (x[~done] for x in (live, starts, part, ranks, at, best))
                row = np.arange(len(live))
                if not len(live):
                    break
            part[row, at] = self.merged[best]
            keep = np.ones(part.shape, bool)
            keep[row, at + 1] = False
            starts, part, ranks = (x[keep].reshape(len(live), -1) for x in (starts, part, ranks))
            wide = part.shape[1]
            right = np.where(at + 1 < wide, part[row, np.minimum(at + 1, wide - 1)], -1)
            ranks[row, at] = self.rank(part[row, at], right)
            has = np.flatnonzero(at > 0)
            ranks[has, at[has] - 1] = self.rank(part[has, at[has] - 1], part[has, at[has]])
        return out

    def merge_long(self, word: bytes) -> bytes:
        """The same for one word of any length, by a heap of ``(rank, boundary)`` and links between boundaries."""
        if not self._heap_ranks:
            self._heap_ranks.update(zip(self.pairs.tolist(), self.ranks.tolist(), strict=True))
        n = len(word)
        part = self.inner[np.frombuffer(word, np.uint8)].tolist()
        part[-1] = int(self.last[word[-1]])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        find = self._heap_ranks.get
        heap = [(r, i) for i in range(n - 1) if (r := find(part[i] << 32 | part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if part[i] < 0 or j >= n or find(part[i] << 32 | part[j]) != rank:
                continue  # one of the two has been merged meanwhile
            part[i], part[j] = int(self.merged[rank]), -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := find(part[i] << 32 | part[k])) is not None:
                    heapq.heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := find(part[h] << 32 | part[i])) is not None:
                heapq.heappush(heap, (r, h))
        return np.array([p for p in part if p >= 0], "<u4").tobytes()

    def merge(self, words: set[str]) -> dict[str, bytes]:
        """Tokens of words."""
        spelt = {w: w.encode() for w in words}
        short = sorted((w for w in words if len(spelt[w]) <= SHORT), key=lambda w: len(spelt[w]))
        made = {w: self.merge_long(spelt[w]) for w in words if len(spelt[w]) > SHORT}
        for a in range(0, len(short), MATRIX_ROWS):
            some = short[a : a + MATRIX_ROWS]
            made.update(zip(some, self.merge_short([spelt[w] for w in some]), strict=True))
        return made

    def splitter(self) -> Callable[[str], list[list[str] | int]]:
        """The words of a text: lists of words, between them the numbers of special tokens."""
        plain = re.compile(_plain_pattern()).findall
        not_plain = re.compile("[^" + "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in PLAIN) + "]").search
        cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")").split if self.special else None
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        loaded: list = []

        def by_rules(text: str) -> list[str]:
            if not loaded:
                import tokenizers

                loaded.append(tokenizers.Tokenizer.from_str(self.rules))
            words = loaded[0].pre_tokenizer.pre_tokenize_str(loaded[0].normalizer.normalize_str(text))
            return [bytes(byte_of[c] for c in w).decode() for w, _ in words]

        def words(text: str) -> list[str]:
            return by_rules(text) if not_plain(text) else plain(text.lower())

        def split(text: str) -> list[list[str] | int]:
            pieces = cut(text) if cut else [text]
            return [self.special[p] if i % 2 else words(p) for i, p in enumerate(pieces)]

        return split

    def encoder(self) -> Callable[[list[bytes]], list[bytes]]:
        """A function from texts in UTF-8 to their tokens; it remembers words."""
        split, known = self.splitter(), {}

        def some(texts: list[bytes]) -> list[bytes]:
            cut = [split(t.decode("utf-8", "replace")) for t in texts]
            if len(known) > REMEMBERED:
                known.clear()
            words = {w for pieces in cut for p in pieces if not isinstance(p, int) for w in p}
            known.update(self.merge(words.difference(known)))
            find = known.__getitem__
            return [b"".join([p.to_bytes(4, "little") if isinstance(p, int) else b"".join(map(find, p)) for p in pieces]) for pieces in cut]

        def encode(texts: list[bytes]) -> list[bytes]:
            out, a, size = [], 0, 0
            for b, text in enumerate(texts, 1):
                size += len(text)
                if size >= AT_ONCE or b == len(texts):
                    out += some(texts[a:b])
                    a, size = b, 0
            return out

        return encode

    def decode(self, ids: bytes) -> str:
        """The vocabulary's spellings, joined by blanks, as a file without a decoder asks."""
        known = self.tokens
        return " ".join([known[i] for i in np.frombuffer(ids, "<u4").tolist()])


def encode_texts(docs: DataFrame, tokenizer: Tokenizer, text: str = "text") -> tuple[DataFrame, str]:
    """All columns of ``docs`` and a struct with ``ids``, little-endian unsigned 32-bit numbers in one binary, and their number
    ``n_tokens``; the struct's name, which clashes with no column, is returned too.

    Whole texts of any length; strings of special tokens in a text become these. Null and empty texts have no tokens. No
    shuffle; equal rows stay apart.
    """
    get = shared(docs.sparkSession, tokenizer)
    made: list = []

    def run(texts: list[bytes]) -> list[list]:
        if not made:
            made.append(get().encoder())
        ids = made[0](texts)
        return [ids, [len(i) // 4 for i in ids]]

    return with_struct(docs, text, "struct<ids: binary, n_tokens: bigint>", run, "tokens")


def decode_ids(docs: DataFrame, tokenizer: Tokenizer, ids: str = "ids") -> tuple[DataFrame, str]:
    """All columns of ``docs`` and a struct with the ``text`` of packed ids, special tokens included; null counts as no ids."""
    get = shared(docs.sparkSession, tokenizer)

    def run(packed: list[bytes]) -> list[list]:
        decode = get().decode
        return [[decode(p) for p in packed]]

    return with_struct(docs, ids, "struct<text: string>", run, "decoded")
