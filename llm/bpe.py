"""BPE encoding and decoding by one pass of dynamic programming over prefixes.

Merging yields exactly one token sequence for each prefix of a word, so the last token of every prefix is unique. For each
end position the tokens that end there come from a suffix automaton over the vocabulary; the token that is compatible with
the last token of the prefix before it is the one to store. Back-pointers from the end of the word give the ids. No merge
loop runs, and the work is linear in the word's length.

Two tokens are compatible when merging the text of both gives just these two. That is decided from the merge tree: walk down
the touching edges of both, and see whether any pair on the way would have merged before the parts on either side did.

Words are independent, so each task keeps the ids of pieces between blanks it has met, in a table of bounded size.

Defined results: a null text counts as empty and has no ids; decoding no ids gives an empty text. Strings of special tokens
in a text give their ids, as in the library's own default. Rows stay one to one; other columns are kept as they are.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import ID, TEXT, clear, pick

KEPT_PIECES, KEPT_WORDS, KEPT_PAIRS = 250_000, 400_000, 1_000_000  # entries in a worker's tables of what it has met
# Fixed: Unicode White_Space, and the tokenizer's pattern.
_SPACE = "".join(map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_PIECE = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
_TAIL = "!#$%&*+,-./:;=?@^_|~)]}"  # marks that make one piece wherever they stand together behind letters
BEFORE = -1


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next free code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Tokenizer:
    """A byte-level BPE vocabulary with word ends, read from its published JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        model = described["model"]
        self.end = model["end_of_word_suffix"]
        ids: dict[str, int] = model["vocab"]
        special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.token = {i: t for t, i in ids.items()} | {i: t for t, i in special.items()}
        self.special = special
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
        symbols = byte_symbols()
        # One character stands for each symbol of a word: a byte, or a byte that ends the word.
        self.inner = [chr(b) for b in range(256)]
        self.last = [chr(0x100 + b) for b in range(256)]
        code = {s: c for s, c in zip(symbols, self.inner, strict=True)} | {s + self.end: c for s, c in zip(symbols, self.last, strict=True)}
        spelled = {t: (code[t] if t in code else None) for t in ids}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.pair: dict[tuple[int, int], int] = {}
        for order, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            whole = ids[a + b]
            if whole not in self.parts and spelled[a + b] is None:
                self.parts[whole] = (ids[a], ids[b])
                spelled[a + b] = spelled[a] + spelled[b]
                self.rank[whole] = order
            self.pair.setdefault((ids[a], ids[b]), order)
        self.suffixes = ahocorasick.Automaton()
        for t, i in ids.items():
            if spelled[t]:
                self.suffixes.add_word(spelled[t], (i, len(spelled[t]), {BEFORE: True}))
        self.suffixes.make_automaton()
        self.pairs_kept = 0
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether the texts of both, merged together, stay these two tokens."""
        # Descend from the younger of the two touching tokens. `bound`: the order at which the part that contains the
        # touching edge was itself merged; a pair that merges sooner breaks it (of equal pairs the left one goes first).
        none = len(self.pair) + 1
        bound = none
        while True:
            order = self.pair.get((left, right))
            if order is not None and order < bound:
                return False
            a, b = self.rank.get(left, -1), self.rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                bound, left = a, self.parts[left][1]  # a tie goes to the pair further left, which is the one inside
            else:
                bound, right = b + 1, self.parts[right][0]

    def word(self, text: str) -> bytes:
        """Ids of one word."""
        raw = text if text.isascii() else text.encode().decode("latin-1")
        symbols = raw[:-1] + self.last[ord(raw[-1])]
        # token[i]: the last token of the prefix that ends with symbol i; begin[i]: the place before that token.
        # Place -1 stands before the word, and is the list's own last place.
        token, begin = [None] * len(symbols) + [BEFORE], [0] * len(symbols)
        for end, (one, length, fits) in self.suffixes.iter(symbols):
            if token[end] is None:
                before = token[end - length]
                if before is not None:
                    fit = fits.get(before)
                    if fit is None:
                        fit = fits[before] = self.compatible(before, one)
                        self.pairs_kept += 1
                    if fit:
                        token[end], begin[end] = one, end - length
        if self.pairs_kept > KEPT_PAIRS:
            self.forget_pairs()
        out, at = [], len(symbols) - 1
        while at >= 0:
            out.append(token[at])
            at = begin[at]
        return struct.pack(f"<{len(out)}I", *out[::-1])

    def forget_pairs(self) -> None:
        for _, _, fits in self.suffixes.values():
            fits.clear()
            fits[BEFORE] = True
        self.pairs_kept = 0

    def word_ids(self, text: str) -> bytes:
        ids = self.words.get(text)
        if ids is None:
            ids = self.word(text)
            if len(text) <= 64:
                if len(self.words) >= KEPT_WORDS:
                    self.words.clear()
                self.words[text] = ids
        return ids

    def piece(self, text: str) -> bytes:
        """Ids of a text without blanks and line feeds; they don't depend on what stands beyond those."""
        body = text.rstrip(_TAIL)
        if body.isalpha() and "Σ" not in body and unicodedata.is_normalized("NFC", body):  # most pieces: a word, then marks
            lower = body.lower()
            if lower.isalpha():
                return self.word_ids(lower) + (self.word_ids(text[len(body) :]) if len(body) < len(text) else b"")
        ids = []
        for k, part in enumerate(self.split_special.split(text) if "<" in text else (text,)):
            if k % 2:
                ids.append(struct.pack("<I", self.special[part]))
                continue
            lower = part.lower() if part.isascii() else "".join(map(str.lower, unicodedata.normalize("NFC", part)))
            ids += map(self.word_ids, _PIECE.findall(lower))
        return b"".join(ids)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        pieces = text.replace("\n", " ").split(" ")
        known = self.pieces
        try:
            return b"".join([known[p] for p in pieces])
        except KeyError:
            pass
        out = []
        for p in pieces:
            ids = known.get(p)
            if ids is None:
                ids = self.piece(p)
                if len(p) <= 64:
                    if len(known) >= KEPT_PIECES:
                        known.clear()
                    known[p] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes | None) -> str:
        """Tokens joined by blanks: the file names no decoder, so word ends stay visible."""
        return " ".join(map(self.token.__getitem__, memoryview(ids).cast("I"))) if ids else ""


_LOADED: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    if path not in _LOADED:
        _LOADED[path] = Tokenizer(path)
    return _LOADED[path]


def slices(rows: pd.Series, size: int = 256) -> Iterator[pd.Series]:
    """Few rows at a time, so that results don't pile up to whole batches."""
    for k in range(0, len(rows), size):
        yield rows.iloc[k : k + size]


def encode(text: Column, path: str) -> Column:
    """Ids of a text, as the bytes of little-endian unsigned 32-bit integers. ``path``: of the vocabulary, on each machine."""

    @F.pandas_udf("binary")
    def encoded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = tokenizer(path)
        for texts in parts:
            for some in slices(texts):
                yield pd.Series([t.encode(x) for x in some], dtype=object)

    return encoded(text)


def decode(ids: Column, path: str) -> Column:
    """The text of such ids."""

    @F.pandas_udf("string")
    def decoded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = tokenizer(path)
        for column in parts:
            for some in slices(column):
                yield pd.Series([t.decode(x) for x in some], dtype=object)

    return decoded(ids)


def encode_documents(docs: DataFrame, path: str, text: str = TEXT) -> DataFrame:
    """``docs`` with ``token_ids`` (binary, see ``encode``) and ``n_tokens``; columns of these names are replaced."""
    docs = clear(docs, text)
    return docs.withColumn("token_ids", encode(F.col(text), path)).withColumn("n_tokens", (F.octet_length("token_ids") / 4).cast("long"))


def round_trip_report(docs: DataFrame, path: str) -> DataFrame:
    """Number of tokens, and digests of ids and of the decoded text, per document."""
    coded = encode_documents(pick(docs, ID, TEXT), path).withColumn("decoded", decode(F.col("token_ids"), path))
    return coded.select(
        ID, "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256")
    )
