"""Alignment of two tokenizers over the same texts.

A text is split by both tokenizers, and each token has a byte range. The cumulative ends of either side go into a dictionary from
end to index; the ends that both dictionaries have, in order, slice both lists of ids into groups. Within a group the tokens
whose ranges overlap are linked, by walking over both sides at once. Both tokenizers begin anew at a single blank between other
characters, and at a single line feed, so this is done for each stretch between such, once by a worker, and then reused.

How often a pair of ids is linked in the whole collection is counted by Spark. Documents keep their pairs and multiplicities as
two short binary columns, so texts are read and split once. The most frequent pairs (``HEAD`` at most, so of bounded size) are sent to
all workers, which resolve them on the spot; the rest are rare by definition and are resolved exactly by a join.

Defined results: null and empty texts, and those whose token bytes on one side aren't those of blank + text, have no tokens.
Rows stay one to one, equal ids and null ids included; other columns aren't read. Strings of special tokens are plain text.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.bpe import byte_symbols
from llm.common import ID, TEXT, pick, stored

HEAD = 1 << 20  # pairs that all workers know
KEPT_UNITS, KEPT_GROUPS = 400_000, 2_000_000  # stretches of text that a worker keeps (long ones count as several), and ids of groups
JOINED, NOTHING = -1, -2  # in place of a stretch's number
SEVERAL = 1 << 32
FLUSH = 2_000_000  # entries of pairs that are summed up at a time
# Fixed: the pattern of the byte-level tokenizer.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Scripts whose letters and digits no version of Unicode has changed of late; other texts, and those with long blanks, take the slower library.
_SINGLE = regex.compile(r"(?<=\S) (?=\S)")  # blanks at which both tokenizers begin anew
_HARD = regex.compile(r"[^\x00-ɏͰ-ϿЀ-ӿ -⁯぀-ヿ一-龥가-힣]|\s{200}")


class ByteTokenizer:
    """Byte-level BPE from its published JSON file."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.exact = Tokenizer.from_file(path)
        self.exact.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        byte = {s: b for b, s in enumerate(byte_symbols())}
        special = {t["id"] for t in described["added_tokens"]}
        ids = {t: i for t, i in described["model"]["vocab"].items() if i not in special}
        self.bytes = [b""] * (max([*ids.values(), *special]) + 1)
        for t, i in ids.items():
            self.bytes[i] = bytes(byte[c] for c in t)
        order = [ids["".join(m if isinstance(m, list) else m.split(" "))] for m in described["model"]["merges"]]
        plain = described["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        # ids that ascend in the order of merges are ranks, which the faster library works with
        self.fast = None
        if plain and described["normalizer"] is None and all(a < b for a, b in zip(order, order[1:])):
            self.fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks={self.bytes[i]: i for i in ids.values()}, special_tokens={})

        self.parts_at_blanks = plain and described["normalizer"] is None and described["model"].get("dropout") is None

    def encode(self, text: str) -> list[int]:
        if self.fast is None or _HARD.search(text):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class PieceTokenizer:
    """Piece BPE from its published model file; it puts a blank before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = ((i, self.model.id_to_piece(i)) for i in range(self.model.get_piece_size()))
        names = list(names)
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in names]
        # no piece goes on over a blank, and texts aren't changed before they are split
        same = all(self.model.normalize(t) == f"▁{t}".replace(" ", "▁") for t in ("a  ﬁ é\u0301", " Ａ\t\n b "))
        self.parts_at_blanks = same and not any("▁" in p.lstrip("▁") or "\n" in p for _, p in names)

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text)


class Grown:
    """An array that entries are put behind."""

    def __init__(self, kind: str):
        self.n, self.held = 0, np.zeros(3 << 10, kind)

    def extend(self, values) -> None:
        while self.n + len(values) > len(self.held):
            self.held = np.concatenate([self.held, np.zeros_like(self.held)])
        self.held[self.n : self.n + len(values)] = values
        self.n += len(values)


class Groups(dict):
    """Number of a group of several tokens by its ids on both sides; the sides and their links by number."""

    def __init__(self, a_sizes: list[int], b_sizes: list[int]):
        super().__init__()
        self.a_sizes, self.b_sizes = a_sizes, b_sizes
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.kept = 0
        self.sides: list[tuple[tuple[int, ...], tuple[int, ...]]] = []
        self.links: list[list[int]] = []

    def __missing__(self, group: tuple[tuple[int, ...], tuple[int, ...]]) -> int:
        self[group] = number = len(self.sides)
        self.sides.append(group)
        self.links.append(self._linked(*group))
        self.kept += len(group[0]) + len(group[1])
        return number

    def _linked(self, a: tuple[int, ...], b: tuple[int, ...]) -> list[int]:
        """Pairs whose byte ranges overlap: of the two current tokens the one that ends first makes way."""
        i = j = 0
        a_end, b_end, found = self.a_sizes[a[0]], self.b_sizes[b[0]], []
        while True:
            found.append(a[i] << 16 | b[j])
            if a_end < b_end:
                i += 1
                a_end += self.a_sizes[a[i]]
            elif b_end < a_end:
                j += 1
                b_end += self.b_sizes[b[j]]
            else:
                return found


class Written(dict):
    """Groups as text, by code: a << 16 | b for one token each, else ``SEVERAL`` + number."""

    def __init__(self, groups: Groups):
        super().__init__()
        self.groups = groups

    def __missing__(self, code: int) -> str:
        sides = ([code >> 16], [code & 0xFFFF]) if code < SEVERAL else self.groups.sides[code - SEVERAL]
        self[code] = text = "|".join(",".join(map(str, side)) for side in sides)
        return text


class Units(dict):
    """Number of a stretch of text, which both tokenizers split on its own; what is known of it, by number.

    Keys: a word stands for blank + word, a key that begins with a blank or a line feed for itself. No stretch ends with white
    space, and behind its first character there is none, so that tokens of either side end with it.
    """

    def __init__(self, a: ByteTokenizer, b: PieceTokenizer):
        super().__init__()
        self.a, self.b = a, b
        self.a_sizes, self.b_sizes = (np.array(list(map(len, t.bytes)), "i8") for t in (a, b))
        self.groups = Groups(self.a_sizes.tolist(), self.b_sizes.tolist())
        self.texts = Written(self.groups)
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.kept = 0
        self.sizes = Grown("i8")  # three a unit: tokens on both sides, groups
        self.written: list[str] = []
        self.links, self.ends = Grown("u4"), Grown("i8")
        self.ends.extend([0])

    def add_words(self, words: list[str]) -> None:
        """Take up words, and such behind line feeds, many at a time: as one text."""
        some, size = [], 0
        for word in words:
            body = word[1:] if word[:1] == "\n" else word
            if not body or body[0].isspace() or body[-1].isspace():
                self[word] = JOINED  # the white space before or behind may go with others
            elif len(word) > 200 or _HARD.search(word):
                self.add([word])
            else:
                some.append(word)
                size += len(word)
                if size > 20_000:
                    self.add(some)
                    some, size = [], 0
        if some:
            self.add(some)

    def add(self, keys: list[str]) -> None:
        """Take up stretches; NOTHING if the tokens' bytes aren't the stretch's own."""
        parts = [k if k[0] in " \n" else f" {k}" for k in keys]
        extra = parts[0][0] != " "  # a text stands behind a blank
        if extra:
            parts = [" a", *parts]
        raws = [t.encode() for t in parts]
        whole, raw = "".join(parts), b"".join(raws)
        a, b = self.a.encode(whole), self.b.encode(whole[1:])
        if b"".join(map(self.a.bytes.__getitem__, a)) != raw or b"".join(map(self.b.bytes.__getitem__, b)) != raw:
            if len(keys) == 1:
                self[keys[0]] = NOTHING
                self.kept += 1
            else:
                for key in keys:
                    self.add([key])
            return
        a_ids, b_ids = np.array(a, "i8"), np.array(b, "i8")
        a_ends, b_ends = np.cumsum(self.a_sizes[a_ids]).tolist(), np.cumsum(self.b_sizes[b_ids]).tolist()
        a_at, b_at = dict(zip(a_ends, range(1, len(a) + 1))), dict(zip(b_ends, range(1, len(b) + 1)))
        common = list(filter(b_at.__contains__, a_ends))  # ascending, as the ends themselves
        i, j = (np.fromiter(map(at.__getitem__, common), "i8", len(common)) for at in (a_at, b_at))
        i_from, j_from = (np.concatenate([[0], x[:-1]]) for x in (i, j))
        codes = a_ids[i_from] << 16 | b_ids[j_from]
        several = np.flatnonzero((i - i_from > 1) | (j - j_from > 1))
        numbers = [
            self.groups[tuple(a[p:q]), tuple(b[r:s])]
            for p, q, r, s in zip(*(x[several].tolist() for x in (i_from, i, j_from, j)))
        ]
        codes[several] = np.array(numbers, "i8") + SEVERAL
        told = list(map(self.texts.__getitem__, codes.tolist()))
        n_links = np.ones(len(codes), "i8")
        n_links[several] = list(map(len, map(self.groups.links.__getitem__, numbers)))
        last = np.cumsum(n_links)
        links = np.zeros(last[-1], "i8")
        links[last - 1] = codes
        for number, end in zip(numbers, last[several].tolist()):
            found = self.groups.links[number]
            links[end - len(found) : end] = found
        # where the stretches end: in groups, tokens and links
        ends = np.searchsorted(np.array(common), np.cumsum(list(map(len, raws)))) + 1
        marks = np.stack([i[ends - 1], j[ends - 1], ends, last[ends - 1]])
        begin = marks[:, :1] if extra else np.zeros((4, 1), "i8")
        marks = np.concatenate([begin, marks[:, int(extra) :]], axis=1)
        for key, p, q in zip(keys, marks[2, :-1].tolist(), marks[2, 1:].tolist()):
            self[key] = len(self.written)
            self.written.append(";".join(told[p:q]))
        self.sizes.extend(np.diff(marks[:3], axis=1).T.ravel())
        self.ends.extend(self.links.n + marks[3, 1:] - marks[3, 0])
        self.links.extend(links[marks[3, 0] :])
        self.kept += len(keys) + len(links) // 8
        if self.groups.kept > KEPT_GROUPS:
            self.groups.forget()
            self.texts.clear()


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        a, b = ByteTokenizer(a_path), PieceTokenizer(b_path)
        if max(len(a.bytes), len(b.bytes)) > 1 << 16:
            raise ValueError("a pair of ids has 32 bits")
        self.units = Units(a, b)
        self.by_words = a.parts_at_blanks and b.parts_at_blanks

    def align(self, texts: list[str | None]) -> list[np.ndarray]:
        """Numbers of each text's units, none for a text without tokens. They hold until ``forget``."""
        words = [t.replace("\n", " \n").split(" ") if t and self.by_words else [] for t in texts]
        self.units.add_words([w for w in set().union(*words) if w not in self.units])
        return [self._numbers(t, w) for t, w in zip(texts, words, strict=True)]

    def _numbers(self, text: str | None, words: list[str]) -> np.ndarray:
        if not text:
            return np.zeros(0, "i8")
        numbers = np.fromiter(map(self.units.__getitem__, words), "i8", len(words))
        if not words or text[0] == "\n" or (numbers == JOINED).any():
            parts = _SINGLE.split(text) if self.by_words else [text]
            numbers = np.fromiter((self._any(f" {p}") for p in parts), "i8", len(parts))
        return numbers[:0] if (numbers == NOTHING).any() else numbers

    def _any(self, key: str) -> int:
        if key not in self.units:
            self.units.add([key])
        return self.units[key]

    def counts(self, units: np.ndarray) -> tuple[int, int, int]:
        """Tokens on both sides, and groups."""
        return tuple(self.units.sizes.held.reshape(-1, 3)[units].sum(axis=0).tolist()) if len(units) else (0, 0, 0)

    def written(self, units: np.ndarray) -> str:
        return ";".join(map(self.units.written.__getitem__, units.tolist()))

    def linked(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs of ids (a << 16 | b), ascending, and how often each is linked."""
        distinct, times = np.unique(units, return_counts=True)
        begin = self.units.ends.held[distinct]
        size = self.units.ends.held[distinct + 1] - begin
        places = np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)
        return summed(self.units.links.held[places].astype("i8"), np.repeat(times, size))

    def forget(self) -> None:
        """Numbers that were given out are void then."""
        if self.units.kept > KEPT_UNITS:
            self.units.forget()


def summed(pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pairs, kind="stable")
    pairs, times = pairs[order], times[order]
    starts = np.flatnonzero(np.diff(pairs, prepend=-1))
    return pairs[starts], np.add.reduceat(times, starts) if len(starts) else times


_LOADED: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = Aligner(a_path, b_path)
    return _LOADED[a_path, b_path]


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = ID, text: str = TEXT, whole: bool = True) -> DataFrame:
    """Per row of ``docs``: row (a number), doc_id, n_a, n_b, n_groups, groups, pairs and times.

    ``groups``: ids as ``a1,a2|b1;a3|b2,b3``, or with ``whole`` off its SHA-256 in hexadecimal (empty without tokens).
    ``pairs``, ``times``: unsigned 32-bit integers, little-endian: distinct linked pairs (a << 16 | b) and how often they are.
    """

    def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use = aligner(a_path, b_path)
        for frame in frames:
            for at in range(0, len(frame), 256):  # results don't pile up to whole batches
                out, some = [], frame.iloc[at : at + 256]
                for row, doc_id, units in zip(some["row"], some["doc_id"], use.align(some["text"].tolist()), strict=True):
                    n_a, n_b, n_groups = use.counts(units)
                    told = use.written(units)
                    if not whole:
                        told = hashlib.sha256(told.encode()).hexdigest() if n_a else ""
                    pairs, times = use.linked(units)
                    out.append((row, doc_id, n_a, n_b, n_groups, told, pairs.astype("<u4").tobytes(), times.astype("<u4").tobytes()))
                use.forget()
                names = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups", "pairs", "times"]
                yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    rows = pick(docs, doc_id=id_col, text=text)
    rows = rows.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = "row long, doc_id long, n_a long, n_b long, n_groups long, groups string, pairs binary, times binary"
    return rows.mapInPandas(found, kind)


def _arrays(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(b"".join(frame[c]), "<u4").astype("i8") for c in ("pairs", "times"))


def link_counts(rows: DataFrame) -> DataFrame:
    """pair, count over all rows of ``aligned``, and whether it is the highest of the pair's second id."""

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for frame in frames:
            for at in range(0, len(frame), 1024):
                held.append(_arrays(frame.iloc[at : at + 1024]))
                if sum(len(p) for p, _ in held) > FLUSH:
                    held = [summed(*map(np.concatenate, zip(*held)))]
                    if len(held[0][0]) > FLUSH // 2:
                        yield pd.DataFrame({"pair": held[0][0], "count": held[0][1]})
                        held = []
        if held:
            pairs, times = summed(*map(np.concatenate, zip(*held)))
            yield pd.DataFrame({"pair": pairs, "count": times})

    parts = rows.select("pairs", "times").mapInPandas(partial, "pair long, count long")
    counts = stored(parts.groupBy("pair").agg(F.sum("count").alias("count")), "pairs")
    b = F.col("pair").bitwiseAND(F.lit(0xFFFF)).alias("b")
    highest = counts.groupBy(b).agg(F.max("count").alias("highest"))  # one row per entry of a vocabulary
    return stored(counts.withColumn("b", b).join(F.broadcast(highest), "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best")), "counts")


def _split(counts: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The most frequent pairs, ``most`` or fewer, and the others; cut by sixteenths of powers of two of the count."""
    step = F.floor(F.log2("count") * 16).alias("step")
    n, least = 0, math.inf
    for r in counts.groupBy(step).count().orderBy(F.desc("step")).collect():  # a thousand rows at most
        n += r["count"]
        if n > most:
            break
        least = r["step"]
    inside = step >= F.lit(float(least))
    return counts.filter(inside), counts.filter(~inside)


def link_scores(rows: DataFrame, counts: DataFrame, head: int = HEAD) -> DataFrame:
    """``rows`` of ``aligned`` (stored) with n_links, n_best and count_sum, by ``counts`` of all pairs."""
    frequent, rare = _split(counts, head)
    known = frequent.toArrow().sort_by("pair")
    sent = rows.sparkSession.sparkContext.broadcast(tuple(known[c].to_numpy() for c in ("pair", "count", "best")))

    def resolved(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, counted, best = sent.value
        for frame in frames:
            for at in range(0, len(frame), 256):
                out, some = [], frame.iloc[at : at + 256]
                for row, p, t in zip(some["row"], some["pairs"], some["times"], strict=True):
                    pairs, times = (np.frombuffer(x, "<u4").astype("i8") for x in (p, t))
                    place = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
                    hit = keys[place] == pairs if len(keys) else np.zeros(len(pairs), bool)
                    at_hit, n = place[hit], times[hit]
                    out.append((row, int(times.sum()), int(n[best[at_hit]].sum()), int((n * counted[at_hit]).sum()), pairs[~hit], times[~hit]))
                yield pd.DataFrame(out, columns=["row", "n_links", "best", "total", "pairs", "times"])

    sums = rows.select("row", "pairs", "times").mapInPandas(resolved, "row long, n_links long, best long, total long, pairs array<long>, times array<long>")
    sums = stored(sums, "sums")
    left = sums.select("row", F.explode(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("n"))).alias("x")).select("row", "x.*")
    met = left.toDF("row", "pair", "n").join(rare, "pair")
    more = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("b"), F.sum(F.col("n") * F.col("count")).alias("t"))
    whole = sums.select("row", "n_links", "best", "total").join(more, "row", "left")
    whole = whole.select("row", "n_links", (F.col("best") + F.coalesce("b", F.lit(0))).alias("n_best"), (F.col("total") + F.coalesce("t", F.lit(0))).alias("count_sum"))
    return rows.drop("pairs", "times").join(whole, "row")


def alignment_report(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    rows = stored(aligned(docs, a_path, b_path, whole=False), "aligned")
    scored = link_scores(rows, link_counts(rows))
    return scored.select(ID, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
