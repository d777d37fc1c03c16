"""Language identification: held-out accuracy and defined results."""

import zlib

import pytest

from llm import language
from llm.common import read

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def report(spark):
    docs = read(spark, FOLDER, "documents")
    labels = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    return language.language_report(docs).collect(), labels


def test_held_out_accuracy(report):
    rows, labels = report
    assert len(rows) == len(labels)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    tested = [r for r in rows if r.held_out and labels[r.doc_id]]
    assert sum(r.lang_pred == labels[r.doc_id] for r in tested) >= 0.95 * len(tested)
    assert all(0 <= r.score <= 1 for r in rows)


def test_words_come_first_then_shorter_grams(spark):
    rows = [(1, "the cat the cat sat", "en"), (2, "der hund der hund sitzt", "de"), (3, None, "en"), (4, "le chat", None), (None, "qqq", "de")]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en"] and "qqq" not in model.known_words and "chat" not in model.known_words
    assert model.predict("THE cat") [0] == "en"
    assert model.predict("hunde")[0] == "de"  # unseen, by its n-grams
    # from each place the longest known n-gram
    grams = [g for g in ("^hun", "hund", "und", "nd", "d", "e") if g in model.grams]
    assert {"^hun", "hund"} <= set(grams)
    assert model.predict("日本") == ("de", 0.5)  # a tie goes to the first by name
    assert model.predict("12 34") == model.predict(None) == model.predict("") == ("und", 0.0)


def test_defined_results(docs, spark):
    unlabelled = docs("a b", None).selectExpr("doc_id", "cast(null as string) as lang", "'abc' as text")
    assert [r.lang_pred for r in language.language_report(unlabelled).collect()] == ["und", "und"]
    assert language.language_report(unlabelled.limit(0)).collect() == []
    model = language.fit(spark.createDataFrame([(1, "the the", "en")], "doc_id long, text string, lang string"))
    out = language.predict(docs("the", None, "the " * 30_000).withColumnRenamed("n_words", "score"), model)
    assert out.columns == ["doc_id", "text", "TEXT_1", "size", "_range", "score", "lang_pred"]
    assert [r.lang_pred for r in out.orderBy("doc_id").collect()] == ["en", "und", "en"]


def test_the_sample_is_bounded(spark):
    rows = [(k, f"word{k % 7} text", "en") for k in range(3000)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most_docs=200)
    assert model.languages == ["en"] and len(model.known_words) <= 8


def test_rare_languages_are_learned(spark, monkeypatch):
    """A few rows of two languages, one in a script of its own, among many of a language with a large vocabulary."""
    monkeypatch.setattr(language, "MOST_ENTRIES", 600)
    monkeypatch.setattr(language, "LEAST_ENTRIES", 200)
    many = [(k, f"the cat{'abcdefghij'[k % 10]} sat on mat{'klmnopqrst'[k // 10 % 10]} and {'uvwxyz'[k % 6] * 3}{'abcdefghij'[k // 60 % 10]}", "en") for k in range(3000)]
    few = [(9000 + k, "minä olen täällä tänään", "fi") for k in range(3)] + [(9100 + k, "καλημέρα κόσμε", "el") for k in range(3)]
    model = language.fit(spark.createDataFrame(many + few, "doc_id long, text string, lang string"), most_docs=100)
    assert model.languages == ["el", "en", "fi"]
    assert model.predict("olen täällä")[0] == "fi" and model.predict("κόσμε")[0] == "el" and model.predict("κόσμος")[0] == "el"
    assert model.predict("the cata sat")[0] == "en"
    assert len(model.known_words) <= 700 and model.predict("κόσμος")[1] > 0.5


def test_the_usual_fit_is_taken_from_texts_left_out(spark):
    """Clean texts with many rare words stay, junk goes, and a language with one text alone is still learned."""
    words = ["house", "river", "stone", "table", "garden", "window", "market", "winter", "summer", "bridge", "castle", "forest"]
    rare = lambda k: " ".join(f"{words[(k * 7 + j) % 12]}{'abcdefghij'[(k + j) % 10]}{'klmnopqrst'[k % 10]}" for j in range(6))
    rows = [(k, f"the {rare(k)} and {rare(k + 5)} of the {words[k % 12]}", "en") for k in range(400)] + [(900 + k, "olen täällä", "fi") for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    apart = language.left_out(docs)
    assert docs.filter(apart).filter("lang = 'fi'").isEmpty() and 10 < docs.filter(apart).count() < 100
    model = language.with_norms(language.fit(docs.filter(~apart)), docs.filter(apart))
    assert model.languages == ["en", "fi"] and list(model.norms) == [0] and model.norms[0] > 0.5
    assert all(model.belongs(t) for _, t, _ in rows)
    assert model.belongs("the riverzq and of the gardenzq housezq the") and not model.belongs("zxq vwk jjq xkq zzq pqw vbn " * 6)


def test_the_usual_fit_is_the_median_over_all_rows(spark):
    """Of thousands of rows in different parts, with rows that come twice or speak for another language."""
    import random
    import statistics

    rnd = random.Random(5)
    known = ["house", "river", "stone", "table", "garden", "window"]
    fresh = lambda: "".join(rnd.choice("bcdfghjklmnpqrstvwxz") for _ in range(rnd.randint(1, 6)))
    say = lambda: " ".join(rnd.choice(known) + (fresh() if rnd.random() < 0.5 else "") for _ in range(rnd.randint(20, 40)))
    train = [(k, " ".join(known), "en") for k in range(9)] + [(20 + k, "hund katze haus und der", "de") for k in range(9)]
    schema = "doc_id long, text string, lang string"
    model = language.fit(spark.createDataFrame(train, schema))
    rows = [(k, say(), "en") for k in range(4000)] + [(k, say(), "de") for k in range(30)]
    rows += [(5000 + k, f"hund und der {fresh()} haus {fresh() * (k % 3)}", "de") for k in range(7)] + rows[:500] + [(9000, None, "en"), (9001, "house", None), (9002, "house", "xx")]
    language.with_norms(model, spark.createDataFrame(rows, schema).repartition(5))
    found = {}
    for _, text, lang in rows:
        if text and lang and (told := model.judge(text))[0] == lang:
            found.setdefault(model.languages.index(lang), []).append(told[2])
    assert len(found[1]) > 4000 and model.norms == {k: statistics.median_low(v) for k, v in found.items()}


def test_dropping_what_was_worked_out_changes_nothing(spark, monkeypatch):
    rows = [(k, f"the {'abcdefghij'[k % 10] * 3}er cat{'klm'[k % 3]} sat", "en") for k in range(60)] + [(100 + k, "der hund saß dort", "de") for k in range(9)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = [f"{w}{v} {v}{w} the hund {w * 30}" for w in ("ab", "xyz", "hun") for v in ("cat", "qq", "und")]
    first = [model.judge(t) for t in texts]
    monkeypatch.setattr(language, "KEPT", 4)
    assert [model.judge(t) for t in texts] == first and model.unseen.n <= 16


def plain_prediction(rows, text):
    """Language and score from counts alone, without tables of any kind."""
    import math
    import re

    words = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    counts = {}
    for _, t, lang in rows:
        for w in words(t):
            counts.setdefault(lang, {}).setdefault(w, 0)
            counts[lang][w] += 1
    grams = {
        lang: {} for lang in counts
    }
    for lang, held in counts.items():
        for w, n in held.items():
            marked = f"^{w}$"
            for k in range(1, 5):
                for i in range(max(1, len(marked) - k + 1)):
                    g = marked[i : i + k]
                    grams[lang][g] = grams[lang].get(g, 0) + n

    def scores(table, key):
        whole = {lang: sum(held.values()) for lang, held in table.items()}
        floor = 0.5 / max(whole.values())
        return {lang: math.log1p(held.get(key, 0) / whole[lang] / floor) for lang, held in table.items()}

    total = dict.fromkeys(counts, 0.0)
    found = words(text)
    for w in found:
        if any(w in held for held in counts.values()):
            parts = [scores(counts, w)]
        else:
            marked, parts = f"^{w}$", []
            for i in range(len(marked) - 1):
                for k in range(min(4, len(marked) - i), int(i == 0), -1):
                    if any(marked[i : i + k] in held for held in grams.values()):
                        parts.append(scores(grams, marked[i : i + k]))
                        break
        for lang in total:
            total[lang] += sum(p[lang] for p in parts) / max(1, len(parts))
    best = max(sorted(total), key=lambda x: total[x])
    weight = min(len(found), 20) / len(found)
    return best, 1 / sum(math.exp((v - total[best]) * weight) for v in total.values())


def test_equals_a_plain_computation(spark):
    import random

    rnd = random.Random(7)
    syllables = {"aa": ["ka", "mi", "to", "ér"], "bb": ["schn", "eu", "gen", "ka"], "cc": ["lli", "ño", "mi", "que"]}
    say = lambda lang, n: " ".join("".join(rnd.choice(syllables[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(n))
    rows = [(k, say(lang, rnd.randint(1, 12)), lang) for k in range(60) for lang in [rnd.choice(list(syllables))]]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    for _ in range(200):
        text = say(rnd.choice(list(syllables)), rnd.randint(1, 30)) + rnd.choice(["", " zzz", " x1y", " Kato"])
        lang, score = plain_prediction(rows, text)
        got = model.predict(text)
        assert got[0] == lang and got[1] == pytest.approx(score, rel=1e-4)


def test_words_are_runs_of_letters_in_any_text():
    letters = language._LETTERS
    every = "".join(chr(c) + (" " if c % 3 else "x") for c in range(0x20000) if not 0xD800 <= c < 0xE000)
    texts = [every, every[: 1 << 16], "Plain ASCII, it's 2 words_here", "Ünï½ ²x Ⅷ ét K İ", "a𝒜b 𐐀c 1", "123", ""]
    assert [language.words_of(t) for t in texts] == [letters.findall(t.lower()) for t in texts]
    assert language.words_of(None) == []
