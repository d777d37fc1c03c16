"""Language identification, word first with a backoff to character n-grams.

A word met in training scores by its log frequency in each language. A word that was not is covered from each of its places by
the longest character n-gram that training has met there, then by shorter ones; its score is their mean. The language with the
highest sum wins; the score is its share of the likelihood, with the evidence counted as that of at most ``EVIDENCE`` words.

The model is fitted on a bounded number of labelled rows of each language (``MOST_DOCS``, all of smaller ones), chosen by a hash,
and holds a bounded number of words and n-grams of each (``MOST_ENTRIES`` over all, ``LEAST_ENTRIES`` of each language at least),
the most frequent ones in it. Relative frequencies are smoothed by one constant, so that a language with few rows is neither
favoured nor hidden. Everything is counted by Spark; only those tables reach the driver, without zeros.

``judge`` also tells how well a text fits its language: the mean over its words, where a word that at least two labelled rows of
the language have counts 1, and any other the share of its n-grams that such words have.

Defined results: a null text, or one without a letter, is ``und`` with score 0. Without any labelled row every text is
``und``. Equal sums go to the language that comes first by name. Rows with a null label, text or id don't train. Rows stay one to
one; columns named like the results are replaced.
"""

from __future__ import annotations

import gc
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import ID, TEXT, clear, discard, numbered, pick, stored

MOST_DOCS = 20_000  # labelled documents of each language that a model is fitted on
MOST_ENTRIES, LEAST_ENTRIES = 200_000, 5_000  # words, and as many n-grams: over all languages, but so many of each at least
LONGEST = 4
EVIDENCE = 20
KEPT = 400_000  # words of texts, and scores of unseen ones, that a worker keeps
UNDETERMINED = "und"
_LETTERS = regex.compile(r"\p{L}+")
# The same words, found faster: in lower-case text of ASCII alone, and in text up to U+FFFF, whose letters are listed by range.
_ASCII = re.compile("[a-z]+")
_BASIC = re.compile("[" + "".join(f"{run[0]}-{run[-1]}" for run in _LETTERS.findall("".join(map(chr, range(1 << 16))))) + "]+")
_BEYOND = re.compile("[\U00010000-\U0010ffff]")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    if not text:
        return []
    low = text.lower()
    if low.isascii():
        return _ASCII.findall(low)
    return (_LETTERS if _BEYOND.search(low) else _BASIC).findall(low)


class Table:
    """Log frequencies above the floor by language, and whether two documents have the entry; zeros are left out."""

    def __init__(self, rows: np.ndarray, n_rows: int, langs: np.ndarray, scores: np.ndarray, firm: np.ndarray):
        order = np.argsort(rows, kind="stable")
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n_rows))])
        self.langs, self.scores, self.firm = langs[order].astype("i4"), scores[order].astype("f4"), firm[order]

    def total(self, at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        """Sums over the rows ``at``, one for each of n languages."""
        begin, size = self.ends[at], self.ends[at + 1] - self.ends[at]
        places = np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)
        return np.bincount(self.langs[places], weights=values[places], minlength=n)

    def firm_in(self, lang: int) -> set[int]:
        """Rows that two documents of a language have."""
        return set((np.searchsorted(self.ends, np.flatnonzero(self.firm & (self.langs == lang)), side="right") - 1).tolist())


class Unseen:
    """Scores of words without a row of their own, by number from ``first`` on."""

    def __init__(self, first: int, width: int):
        self.first, self.n, self.scores = first, 0, np.zeros((1024, width), "f4")

    def add(self, scores: np.ndarray) -> int:
        if self.n == len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        self.scores[self.n] = scores
        self.n += 1
        return self.first + self.n - 1


class Rows(dict):
    """Row of a word that texts have. An unknown word is scored by its n-grams when it is first met; long ones aren't kept."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> int:
        row = self.model.known_words.get(word)
        if row is None:
            row = self.model.unseen.add(self.model.backed_off(word))
        if len(word) <= 64:
            self[word] = row
        return row


class Fits(dict):
    """How well a word fits one language: 1 if two documents have it, else the share of its n-grams that two have."""

    def __init__(self, model: Model, lang: int):
        super().__init__()
        self.words, self.grams = model.known_words, model.grams
        self.firm_words, self.firm_grams = model.words.firm_in(lang), model.pieces.firm_in(lang)

    def __missing__(self, word: str) -> float:
        if self.words.get(word) in self.firm_words:
            found = 1.0
        else:
            marked = f"^{word}$"
            pieces = [marked[i : i + LONGEST] for i in range(max(1, len(marked) - LONGEST + 1))]
            found = sum(self.grams.get(g) in self.firm_grams for g in pieces) / len(pieces)
        if len(word) <= 64:
            self[word] = found
        return found


class Model:
    """Scores by language of known words and n-grams."""

    def __init__(self, languages: list[str], words: dict[str, int], word_table: Table, grams: dict[str, int], gram_table: Table):
        self.languages, self.known_words, self.grams = languages, words, grams
        self.words, self.pieces = word_table, gram_table
        self.norms: dict[int, float] = {}  # median fit of labelled rows by language
        self.sent: Broadcast | None = None  # on the driver: workers that have it need no other copy
        self._forget()

    def __getstate__(self) -> dict:
        return {k: v for k, v in vars(self).items() if k not in ("rows", "unseen", "fits", "sent")}

    def __setstate__(self, state: dict) -> None:
        gc.collect()  # a worker's model before refers to itself by what it keeps of texts
        vars(self).update(state)
        self._forget()

    def _forget(self) -> None:
        """Drop what has been worked out from texts."""
        self.unseen = Unseen(len(self.known_words), len(self.languages))
        self.rows = Rows(self)
        self.fits: dict[int, Fits] = {}

    def backed_off(self, word: str) -> np.ndarray:
        marked, found = f"^{word}$", []
        for i in range(len(marked) - 1):
            for n in range(min(LONGEST, len(marked) - i), int(i == 0), -1):  # not the mark alone
                row = self.grams.get(marked[i : i + n])
                if row is not None:
                    found.append(row)
                    break
        n = len(self.languages)
        return self.pieces.total(np.array(found), self.pieces.scores, n) / len(found) if found else np.zeros(n)

    def predict(self, text: str | None) -> tuple[str, float]:
        return self._best(words_of(text))

    def _best(self, words: list[str]) -> tuple[str, float]:
        if not words or not self.languages:
            return UNDETERMINED, 0.0
        if len(self.rows) + self.unseen.n * len(self.languages) // 8 + sum(map(len, self.fits.values())) > KEPT:
            self._forget()
        at = np.fromiter(map(self.rows.__getitem__, words), "i8", len(words))
        seen = at < self.unseen.first
        total = self.words.total(at[seen], self.words.scores, len(self.languages))
        if not seen.all():
            total = total + self.unseen.scores[at[~seen] - self.unseen.first].sum(axis=0, dtype="f8")
        best = int(np.argmax(total))
        weight = min(len(words), EVIDENCE) / len(words)
        return self.languages[best], float(1 / np.exp((total - total[best]) * weight).sum())

    def judge(self, text: str | None) -> tuple[str, float, float, float]:
        """Language, score, fit, and the number of words; long ones count as several."""
        words = words_of(text)
        lang, score = self._best(words)
        if not words or not self.languages:
            return lang, score, 0.0, 0.0
        k = self.languages.index(lang)
        if k not in self.fits:
            self.fits[k] = Fits(self, k)
        fit = sum(map(self.fits[k].__getitem__, words)) / len(words)
        return lang, score, fit, max(len(words), sum(map(len, words)) / 8)

    def belongs(self, text: str | None) -> bool:
        """Has letters, speaks for one language more than for the others, and fits it. Without languages, has letters.

        A bad fit is one less than half as good as that of labelled rows, by more than two standard errors.
        """
        n = len(self.languages)
        if not n:
            return bool(text and _LETTERS.search(text))
        lang, score, fit, words = self.judge(text)
        if not words or (n > 1 and score <= (1 + 1e-6) / n):
            return False
        return fit >= self.norms.get(self.languages.index(lang), 0.0) / 2 - 1 / math.sqrt(words)


def _sampled(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows of each language, all of smaller ones."""
    sizes = rows.groupBy("lang").agg(F.count("*").alias("_n"))  # one row per language
    chance = F.least(F.lit(1.0), F.lit(float(most)) / F.col("_n")) * float(1 << 40)
    return rows.join(F.broadcast(sizes), "lang").filter(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 40)) < chance).drop("_n")


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The keys that are among the ``most`` frequent of some language; of equal counts at the edge, a share by hash.

    No language is ranked in one task: its edge is read off how many keys there are of each count.
    """
    cut, held = {}, {}
    for r in counts.groupBy("lang", "count").agg(F.count("*").alias("n")).orderBy("lang", F.desc("count")).collect():
        if r.lang not in cut:
            before = held.get(r.lang, 0)
            held[r.lang] = before + r.n
            if held[r.lang] > most:
                cut[r.lang] = (r["count"], (most - before) / r.n)
    if not cut:
        return counts
    edges = counts.sparkSession.createDataFrame([(k, c, share) for k, (c, share) in cut.items()], "lang string, _cut long, _share double")
    at = F.broadcast(edges)
    lot = F.pmod(F.xxhash64("key"), F.lit(1 << 40)) < F.col("_share") * float(1 << 40)
    top = counts.join(at, "lang", "left").filter(F.col("_cut").isNull() | (F.col("count") > F.col("_cut")) | ((F.col("count") == F.col("_cut")) & lot))
    return counts.join(top.select("key").distinct(), "key", "left_semi")


def fit(labelled: DataFrame, id_col: str = ID, text: str = TEXT, lang: str = "lang", most_docs: int = MOST_DOCS) -> Model:
    """Fit on rows that have id, text and label."""
    rows = pick(labelled, id=id_col, text=text, lang=lang).dropna()
    sample = _sampled(rows, most_docs).select("lang", F.xxhash64("id", "text").alias("doc"), F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"))).alias("key"))
    words = stored(sample.groupBy("lang", "key").agg(F.count("*").alias("count"), (F.min("doc") < F.max("doc")).alias("firm")), "words")
    marked = F.concat(F.lit("^"), "key", F.lit("$"))
    places = lambda k: F.transform(F.sequence(F.lit(1), F.greatest(F.length(marked) - k + 1, F.lit(1))), lambda i: marked.substr(i, F.lit(k)))
    pieces = words.select("lang", F.explode(F.concat(*[places(k) for k in range(1, LONGEST + 1)])).alias("key"), "count", "firm")
    grams = stored(pieces.groupBy("lang", "key").agg(F.sum("count").alias("count"), F.bool_or("firm").alias("firm")), "grams")
    totals = {r.lang: r.n for r in words.groupBy("lang").agg(F.sum("count").alias("n")).collect()}
    sums = {r.lang: r.n for r in grams.groupBy("lang").agg(F.sum("count").alias("n")).collect()}
    languages = sorted(totals)
    most = max(LEAST_ENTRIES, MOST_ENTRIES // max(1, len(languages)))

    def table(counts: DataFrame, whole: dict[str, int]) -> tuple[dict[str, int], Table]:
        found = _most_frequent(counts, most).toArrow()  # flat, since rows of Python objects take ten times the memory
        keys, names = (found[c].combine_chunks().dictionary_encode() for c in ("key", "lang"))
        number = {x: k for k, x in enumerate(languages)}
        langs = np.array([number[x] for x in names.dictionary.to_pylist()], dtype="i4")[names.indices.to_numpy()]
        floor = 0.5 / max(whole.values(), default=1)  # half an occurrence in the largest language
        scores = np.log1p(found["count"].to_numpy() / np.array([whole[x] for x in languages])[langs] / floor)
        held = {w: k for k, w in enumerate(keys.dictionary.to_pylist())}
        return held, Table(keys.indices.to_numpy(), len(held), langs, scores, found["firm"].to_numpy())

    model = Model(languages, *table(words, totals), *table(grams, sums))
    discard(words, grams)
    return model


def with_norms(model: Model, labelled: DataFrame, id_col: str = ID, text: str = TEXT, lang: str = "lang") -> Model:
    """The model, knowing how well labelled rows fit their languages: the exact (lower) median over all rows of each.

    Give rows that the model wasn't fitted on: its own fit it too well. A language without any has no lower bound.
    """
    rows = pick(labelled, id=id_col, text=text, lang=lang).dropna()
    sent = model.sent = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.StructType().add("lang_pred", "string").add("fit", "double"))
    def judged(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            yield pd.DataFrame([sent.value.judge(t)[::2] for t in texts], columns=["lang_pred", "fit"])

    fit = F.when(F.col("lang") == F.col("j.lang_pred"), F.col("j.fit"))
    fits = rows.select("lang", judged("text").alias("j")).select("lang", fit.alias("fit"), F.monotonically_increasing_id().alias("row"))
    fits = stored(fits, "fits", batch=500)  # each text is judged once
    # in order over all tasks, so that no language is put in order in one
    placed = numbered(fits.filter("fit is not null"), F.col("lang"), F.col("fit"), F.col("row"))
    spans = placed.groupBy("lang").agg(F.min("no").alias("first"), F.count("*").alias("n")).collect()  # one row per language
    middle = placed.filter(F.col("no").isin([r["first"] + (r.n - 1) // 2 for r in spans])).collect()
    model.norms = {model.languages.index(r.lang): r.fit for r in middle if r.lang in model.languages}
    discard(fits, placed)
    return model


def left_out(labelled: DataFrame, text: str = TEXT, lang: str = "lang") -> Column:
    """A tenth of all texts, equal ones alike, that can tell how well a model fits what it has not seen.

    Only of languages whose texts fall to several tenths, so that none is left out as a whole.
    """
    tenth = F.pmod(F.xxhash64(text), F.lit(10))
    several = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).groupBy(lang).agg(F.count_distinct(tenth).alias("n"))
    languages = [r[0] for r in several.filter("n >= 5").collect()]  # one row per language
    return F.coalesce((tenth == 0) & F.col(lang).isin(languages), F.lit(False))


def predict(docs: DataFrame, model: Model, text: str = TEXT) -> DataFrame:
    """``docs`` with lang_pred and score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded for each language
    kind = T.StructType().add("lang_pred", "string").add("score", "double")

    @F.pandas_udf(kind)
    def predicted(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        use = sent.value
        for texts in parts:
            yield pd.DataFrame([use.predict(t) for t in texts], columns=["lang_pred", "score"])

    found = clear(docs, text, reserved=["_found"]).withColumn("_found", predicted(text))
    return found.withColumns({"lang_pred": F.col("_found.lang_pred"), "score": F.col("_found.score")}).drop("_found")


def belonging(docs: DataFrame, model: Model, text: str = TEXT) -> DataFrame:
    """The rows whose text belongs to a language of the model, which needs ``with_norms``."""
    sent, norms = model.sent or docs.sparkSession.sparkContext.broadcast(model), model.norms

    @F.pandas_udf("boolean")
    def belongs(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        use = sent.value
        use.norms = norms  # found after it was sent
        for texts in parts:
            yield pd.Series([use.belongs(t) for t in texts], dtype=bool)

    return docs.filter(belongs(text))


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def language_report(docs: DataFrame) -> DataFrame:
    """Fit on four fifths of the documents' ids, predict all texts."""
    rows = pick(docs, ID, TEXT, "lang").withColumn("held_out", held_out(F.col(ID)))
    model = fit(rows.filter(~F.col("held_out")))
    return predict(rows.select(ID, TEXT, "held_out"), model).select(ID, "held_out", "lang_pred", "score")
