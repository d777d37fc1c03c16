"""Benchmark decontamination: one Aho-Corasick automaton over the words of all test items.

The automaton's symbols are word numbers, its patterns the windows of consecutive item words. Each text is normalised and
scanned once; the hits are word positions, which are mapped to code points of the original text for the texts that have any.

Defined results: a null or empty text has no words and no hits. An item without words never occurs. Items with a null id do
hit, under the id "". Items that share an id count once. Rows stay one to one, repeated ones too; other columns of the
documents are not read. An empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import ID, TEXT, clear, pick

WINDOW = 10
BLOCK_BYTES = 8 << 20  # of item text in one automaton; a larger set of items takes several automata

_UPPER = bytes(range(65, 91))
_WORD_BYTES = bytes(range(48, 58)) + _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_FOLD = bytes(b + 32 if b in _UPPER else b if b in _WORD_BYTES else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_RESULT = "n_words long, runs array<struct<first:int,last:int>>, items array<string>, spans array<struct<start:int,end:int>>"


def words(text: str | None) -> list[bytes]:
    """Words in UTF-8 with A-Z in lower case; no other character is folded."""
    return text.encode().translate(_FOLD).split() if text else []


class Automaton:
    """Windows of items over word numbers; number 0 is any word that no item has."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.number: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for name, text in items:
            ids = tuple(self.number.setdefault(w, len(self.number) + 1) for w in words(text))
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(ids[i : i + window], set()).add(name)
        self.found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for ids, names in owners.items():
            self.found.add_word(ids, (len(ids), names))
        self.empty = not owners
        if owners:
            self.found.make_automaton()

    def scan(self, text_words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged runs of hit words (first, last) and the items met."""
        if self.empty or not text_words:
            return [], set()
        runs: list[tuple[int, int]] = []
        met: set[str] = set()
        for end, (length, names) in self.found.iter(tuple(map(self.number.get, text_words, repeat(0)))):
            runs.append((end - length + 1, end))
            met |= names
        return merged(runs), met


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


_BUILT: dict[str, Automaton] = {}


def _automaton(key: str, items: list[tuple[str, str]], window: int) -> Automaton:
    if key not in _BUILT:
        _BUILT.clear()  # one at a time in a worker
        _BUILT[key] = Automaton(items, window)
    return _BUILT[key]


def _scanner(spark, items: list[tuple[str, str]], window: int):
    key = hashlib.sha256(repr((window, items)).encode()).hexdigest()
    sent = spark.sparkContext.broadcast(items)

    @F.pandas_udf(_RESULT)
    def scan(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, runs_before, items_before in parts:
            automaton = _automaton(key, sent.value, window)
            rows = []
            for text, runs, names in zip(texts, runs_before, items_before, strict=True):
                found = words(text)
                new, met = automaton.scan(found)
                if runs is not None and len(runs):
                    new = merged(new + [(r["first"], r["last"]) for r in runs])
                met |= set() if names is None else set(names)
                spans = []
                if new:
                    places = [m.span() for m in _WORD.finditer(text)]
                    spans = [{"start": places[a][0], "end": places[b][1]} for a, b in new]
                rows.append((len(found), [{"first": a, "last": b} for a, b in new], sorted(met), spans))
            yield pd.DataFrame(rows, columns=["n_words", "runs", "items", "spans"])

    return scan


def blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of bounded size, so neither driver nor task holds more than one block of a large set.

    Items that share a text fall to different blocks; equal rows are one.
    """
    items = benchmark.filter(F.length("text") > 0).select(F.coalesce("item", F.lit("")).alias("item"), "text").distinct()
    total = items.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    for k in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("text", "item"), F.lit(n)) == k)
        yield sorted((r.item, r.text) for r in part.collect())


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = TEXT, item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a struct ``contamination``: n_words, runs of hit words, items met, spans in the text (end exclusive)."""
    named = pick(benchmark, item=item_id, text=item_text).select(F.col("item").cast("string").alias("item"), "text")
    docs = clear(docs, text)
    found = F.from_json(F.lit(None).cast("string"), _RESULT)
    for items in blocks(named, block_bytes):
        found = _scanner(docs.sparkSession, items, window)(F.col(text), found["runs"], found["items"])
    return docs.withColumn("contamination", found)


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Counts and a digest per document."""
    found = F.col("contamination")
    hit = F.aggregate(found["runs"], F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    return find_contamination(pick(docs, ID, TEXT), benchmark).select(
        ID,
        found["n_words"].alias("n_words"),
        hit.alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(found["items"]), ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
