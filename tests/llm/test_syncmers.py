"""Fingerprints against a direct computation."""

import hashlib
import random
import re
import struct

import xxhash
from pyspark.sql import functions as F

from llm import syncmers
from llm.common import pick


def spark_hash(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<q", v), seed=seed)
    return seed - (1 << 64) if seed >> 63 else seed


def tokens_of(text):
    """Pieces of five characters, anew at each word, and in long stretches wherever the three characters before say so."""
    found = []
    for run in re.findall(r"[^ \t\n\x0b\f\r]+", text):
        starts = {0}
        if len(run) > 20:
            starts |= {i for i in range(3, len(run)) if spark_hash(run[i - 3 : i]) % 4 == 0}
        edges = [*sorted(starts), len(run)]
        for a, b in zip(edges, edges[1:]):
            found += [run[i : min(i + 5, b)] for i in range(a, b, 5)]
    return found


def brute(text, k=8, s=2):
    tokens = [-1] * (k - 1) + [spark_hash([t]) for t in tokens_of(text)]
    inner = [spark_hash(tokens[i : i + s]) for i in range(len(tokens) - s + 1)]
    codes = []
    for i in range(len(tokens) - k + 1):
        part = inner[i : i + k - s + 1]
        if i < k - 1 or min(part) in (part[0], part[-1]):
            codes.append(spark_hash(tokens[i : i + k]) & 0xFFFFFFFF)
    return codes


def dice(a, b):
    return 2 * len(set(a) & set(b)) / (len(set(a)) + len(set(b))) if a or b else 1.0


BLANKLESS = "".join(random.Random(9).choice("abcdefgh0123\u65e5\u672c\U0001f642") for _ in range(2000))


def follow(rows):
    """Ids descending, none last; rows of one id by a hash of their texts."""
    mark = lambda t: (spark_hash([t]) % 2**64) >> 11
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), mark(r[1] or ""), r[1] or ""))


def edited(text, after):
    third = len(text) // 3
    return text[: len(text) - third] + after[:third]


def plain_edits(rows):
    order = follow(rows)
    texts = [t or "" for _, t in order]
    return [(i, hashlib.sha256(edited(t, texts[(k + 1) % len(texts)]).encode()).hexdigest()) for k, ((i, _), t) in enumerate(zip(order, texts))]


def test_any_ids_hot_ids_and_many_without_an_id(docs, monkeypatch):
    """Ids at both ends of 64 bits and hashes; a third of rows with one id, a third without; many ranges."""
    monkeypatch.setattr(syncmers, "ROWS_PER_RANGE", 3)
    rnd = random.Random(2)
    ids = [rnd.randint(-(2**63), 2**63 - 1) for _ in range(60)] + [2**63 - 1, -(2**63), 0, 1, 2] + [77] * 60 + [None] * 60 + [2**63 - 1] * 20
    rows = [(i, f"text {rnd.randint(0, 10**6)} of its own {k % 9}" if k % 5 else None) for k, i in enumerate(ids)]
    got = syncmers.fingerprint_report(docs(*[t for _, t in rows], ids=ids)).collect()
    assert sorted(((r.doc_id, r.edited_sha256) for r in got), key=str) == sorted(plain_edits(rows), key=str)


def test_ids_of_thirty_million_documents_do_not_overflow(docs, monkeypatch):
    monkeypatch.setattr(syncmers, "ROWS_PER_RANGE", 1e-4)
    rnd = random.Random(4)
    ids = [rnd.randint(-(2**63), 2**63 - 1) for _ in range(300)]
    rows = [(i, f"t{k} x y") for k, i in enumerate(ids)]
    got = syncmers.fingerprint_report(docs(*[t for _, t in rows], ids=ids)).collect()
    assert sorted((r.doc_id, r.edited_sha256) for r in got) == sorted(plain_edits(rows))


def test_equals_brute_force(docs, monkeypatch):
    monkeypatch.setattr(syncmers, "ROWS_PER_RANGE", 1)
    texts = ["", None, "one", "one two three four five six seven eight nine ten " * 8, "é\U0001f642 x " * 30, "same", "same", "abc" * 3000, " \n", "a b", BLANKLESS, "see " + BLANKLESS[5:900]]
    ids = [5, 9, -4, 10**12, 7, 8, 6, 11, 12, None, 2**63 - 1, -(2**63)]
    got = {r.doc_id: r for r in syncmers.fingerprint_report(docs(*texts, ids=ids)).collect()}
    order = follow(zip(ids, texts, strict=True))
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        changed = edited(text, after)
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert r.fingerprint == "".join(f"{c:08X}" for c in brute(text))
        assert r.edited_fingerprint == "".join(f"{c:08X}" for c in brute(changed))
        assert (r.near_edited, r.near_next) == (dice(brute(text), brute(changed)), dice(brute(text), brute(after)))
    assert got[8].fingerprint == got[6].fingerprint


def test_small_tables(docs):
    assert syncmers.fingerprint_report(docs("a").limit(0)).collect() == []
    only = syncmers.fingerprint_report(docs("some words here")).first()
    assert only.near_next == 1.0
    twice = syncmers.fingerprint_report(docs("b b b", "a a a", ids=[1, 1])).collect()
    assert sorted(r.edited_sha256 for r in twice) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in ("a a b", "b b a"))
    assert len(syncmers.fingerprint_report(docs(None, "x", ids=[None, None])).collect()) == 2


def test_a_shifted_passage_without_blanks_keeps_its_anchors(docs):
    rnd = random.Random(5)
    for letters in ("".join(map(chr, range(0x4E00, 0x5200))), "abcdefghijklmnopqrstuvwxyz0123456789/+"):
        passage = "".join(rnd.choice(letters) for _ in range(3000))
        texts = [passage, letters[0] + passage, letters[:2] + passage, passage[:1500] + letters[7] + passage[1500:], "see " + passage[3:]]
        rows = pick(docs(*texts), "doc_id", "text").select("doc_id", syncmers.anchors(F.col("text")).alias("codes")).collect()
        whole, *others = [set(r.codes) for r in sorted(rows, key=lambda r: r.doc_id)]
        assert all(dice(whole, other) > 0.9 for other in others)
