"""Removal of repeated passages: windows of words whose sequence also stands elsewhere, found by level-wise doubling.

Let W be the window's length and b a quarter of it. In every window the b-gram with the least hash is its anchor; equal windows
have equal anchors, and a run of windows shares one, so few b-grams are looked at. Anchors that occur once are dropped.
Those left are extended to 2b words, ahead or back, whichever lies within the window, and those that occur once are dropped
again. Only windows around what is left are compared at their full length. Each level is a count by hash
(combined before the shuffle) and a join back of the hashes that repeat; texts take no part in it.

Hashes have 64 bits on the lower levels, where a chance match only costs work, and 96 bits for windows.

Defined results: a null text has no words, keeps an empty text, and its kept_sha256 is that of the empty text. Texts shorter
than a window keep all words. Repeated rows are repeats of one another. White space between kept words becomes one space.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import ID, TEXT, discard, pick, stored

WINDOW = 35
AHEAD, BACK = 0, 1


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash per word; words part at the six ASCII white spaces."""
    words = text.encode().split() if text else []
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), "u8", len(words))


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    z = a * np.uint64(0x9E3779B97F4A7C15) + b
    z ^= z >> np.uint64(29)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    return z ^ (z >> np.uint64(32))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-grams, from those of half the length up."""
    if len(words) < n:
        return words[:0]
    if n == 1:
        return _joined(words, words)
    half = 1 << ((n - 1).bit_length() - 1)
    inner = gram_hashes(words, half)
    return _joined(inner[: len(words) - n + 1], inner[n - half :])


def anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor of each window, and whether the window is judged by the 2b-gram ahead of it or back from it."""
    b = window // 4
    grams = gram_hashes(words, b)
    width = window - b + 1
    first = np.arange(len(words) - window + 1)
    at = np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1) + first
    return at, np.where(at + 2 * b <= first + window, AHEAD, BACK)


def _repeating(rows: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key stands in more than one row, and the stored table of such keys, to be deleted after use.

    As both sides of the join are plain shuffles, Spark can split the rows of a key that very many rows have.
    """
    twice = stored(rows.groupBy(*keys).count().filter("count > 1").select(*keys), "repeated-keys")
    return rows.join(twice, list(keys)), twice


def _lists(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in frames:
        for k in range(0, len(part), 256):
            yield part.iloc[k : k + 256]


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Starts of the windows that repeat, per document key: k1, k2, starts. ``docs`` has k1, k2 and text."""
    if window < 4:
        raise ValueError("a window has four words at least")
    b = window // 4

    def find(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _lists(parts):
            out = []
            for k1, k2, text in zip(part["k1"], part["k2"], part["text"], strict=True):
                words = word_hashes(text)
                if len(words) >= window:
                    at, way = anchors(words, window)
                    double = gram_hashes(words, 2 * b) | np.uint64(1)  # 0: no window needs it
                    places = np.unique(at)
                    ahead, back = (np.zeros(len(places), "u8") for _ in "ab")
                    p = np.searchsorted(places, np.unique(at[way == AHEAD]))
                    ahead[p] = double[places[p]]
                    p = np.searchsorted(places, np.unique(at[way == BACK]))
                    back[p] = double[places[p] - b]
                    single = gram_hashes(words, b)[places]
                    out.append((k1, k2, places.astype("i4"), single.view("i8"), ahead.view("i8"), back.view("i8")))
            yield pd.DataFrame(out, columns=["k1", "k2", "at", "single", "ahead", "back"])

    listed = docs.mapInPandas(find, "k1 long, k2 long, at array<int>, single array<long>, ahead array<long>, back array<long>")
    listed = stored(listed, "anchors")
    rows = listed.select("k1", "k2", F.explode(F.arrays_zip("at", "single", "ahead", "back")).alias("a")).select("k1", "k2", "a.*")
    repeating, keys = _repeating(rows, "single")
    once = stored(repeating.drop("single"), "anchors-1")
    discard(listed, keys)
    ways = F.array(F.struct(F.lit(AHEAD).alias("way"), F.col("ahead").alias("double")), F.struct(F.lit(BACK).alias("way"), F.col("back").alias("double")))
    doubled = once.select("k1", "k2", "at", F.explode(ways).alias("w")).select("k1", "k2", "at", "w.*").filter("double <> 0")
    # The codes of a document are as many as it has words at most.
    repeating, keys = _repeating(doubled, "double")
    left = repeating.groupBy("k1", "k2").agg(F.collect_set(F.col("at") * 2 + F.col("way")).alias("codes"))

    def extend(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _lists(parts):
            out = []
            for k1, k2, text, codes in zip(part["k1"], part["k2"], part["text"], part["codes"], strict=True):
                words = word_hashes(text)
                at, way = anchors(words, window)
                starts = np.flatnonzero(np.isin(at * 2 + way, codes))
                hashes = gram_hashes(words, window)[starts]
                check = gram_hashes(words ^ np.uint64(0xD6E8FEB86659FD93), window)[starts]
                out.append((k1, k2, starts.astype("i4"), hashes.view("i8"), (check >> np.uint64(32)).astype("u4").view("i4")))
            yield pd.DataFrame(out, columns=["k1", "k2", "start", "hash", "check"])

    kept = docs.join(left, ["k1", "k2"]).select("k1", "k2", "text", "codes")
    wide = stored(kept.mapInPandas(extend, "k1 long, k2 long, start array<int>, hash array<long>, check array<int>"), "windows")
    discard(once, keys)
    full = wide.select("k1", "k2", F.explode(F.arrays_zip("start", "hash", "check")).alias("w")).select("k1", "k2", "w.*")
    repeating, keys = _repeating(full, "hash", "check")
    found = stored(repeating.groupBy("k1", "k2").agg(F.collect_set("start").alias("starts")), "repeated")
    discard(wide, keys)
    return found


_CLEANED = "doc_id long, n_words long, n_removed long, kept string"


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = ID, text: str = TEXT) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and the kept text."""
    plain = pick(docs, doc_id=id_col, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    keyed = plain.withColumns({"k1": F.xxhash64("doc_id", "text"), "k2": F.xxhash64("text", F.lit(1), "doc_id")})
    # equal rows have one key: each counts as an occurrence, and all get the same answer
    starts = repeated_windows(keyed.select("k1", "k2", "text"), window)

    def clean(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _lists(parts):
            out = []
            for has_id, doc, body, at in zip(part["has_id"], part["doc"], part["text"], part["starts"], strict=True):
                words = body.encode().split() if body else []
                total = len(words)
                if at is not None and len(at):
                    edges = np.zeros(total + 1, "i4")
                    np.add.at(edges, at, 1)
                    np.add.at(edges, np.asarray(at) + window, -1)
                    words = [words[k] for k in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
                out.append((int(doc) if has_id else None, total, total - len(words), b" ".join(words).decode()))
            frame = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"])
            yield frame.assign(doc_id=pd.array([r[0] for r in out], "Int64"))

    joined = keyed.join(starts, ["k1", "k2"], "left")
    has_id = F.col("doc_id").isNotNull().alias("has_id")
    return joined.select(has_id, F.coalesce("doc_id", F.lit(0)).alias("doc"), "text", "starts").mapInPandas(clean, _CLEANED)


def repeat_report(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select(ID, "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


