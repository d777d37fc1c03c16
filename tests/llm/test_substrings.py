"""Removal of repeated passages against a direct count of windows."""

import hashlib
import random
import re
from collections import Counter

import pytest

from llm import substrings


def brute(texts, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {p for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for p in range(i, i + window)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((len(w), len(gone), kept))
    return out


@pytest.mark.parametrize("window", [4, 9, 35])
def test_equals_brute_force(docs, window):
    rnd = random.Random(window)
    say = lambda n: [rnd.choice(["a", "B", "é", "\U0001f642", "d", "e\xa0f", "g\x1ch"]) for _ in range(n)]
    shared = [say(rnd.randint(window - 2, 3 * window)) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [say(rnd.randint(0, 2 * window)), rnd.choice(shared)[rnd.randint(0, 3) :], say(rnd.randint(0, window))]
        texts.append(rnd.choice([" ", "\n", "\t "]).join(w for p in parts for w in p))
    texts += [None, "", " \n", "x " * 500, texts[0], texts[0], " ".join(say(window))]
    got = substrings.remove_repeats(docs(*texts), window).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute(texts, window)


def test_rows_that_are_equal_and_ids_that_are_null(docs):
    text = " ".join(f"w{k}" for k in range(40))
    frame = docs(text, text, text + " end", None, "short", ids=[1, 1, None, None, None])
    got = sorted((tuple(r) for r in substrings.repeat_report(frame).collect()), key=str)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(1, 40, 40, digest("")), (1, 40, 40, digest("")), (None, 41, 40, digest("end")), (None, 0, 0, digest("")), (None, 1, 0, digest("short"))]
    assert got == sorted(want, key=str)
    assert substrings.repeat_report(frame.limit(0)).collect() == []
    with pytest.raises(ValueError, match="four words"):
        substrings.remove_repeats(frame, 3)
