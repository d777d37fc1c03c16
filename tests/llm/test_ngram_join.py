"""The Jaccard join against all pairs."""

import random
import re

import numpy as np
import pytest

from llm import ngram_join


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(ids, texts, k, percent):
    sets = [shingle_set(t, k) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for x, i in enumerate(ids):
        if i is not None:
            least[find(x)] = min(i, least.get(find(x), i))
    return [(i, len(s), least.get(find(x))) for x, (i, s) in enumerate(zip(ids, sets, strict=True))]


def _texts(seed, rnd_edit):
    rnd = random.Random(seed)
    say = lambda n: [f"w{rnd.randint(0, 400)}" for _ in range(n)]
    texts = []
    for size in (3, 5, 9, 10, 11, 20, 40, 60, 120, 300):
        for _ in range(3):
            base = say(size)
            texts.append(" ".join(base))
            for _ in range(6):
                copy = list(base)
                for _ in range(rnd.randint(0, rnd_edit)):
                    at = rnd.randrange(len(copy))
                    copy[at : at + 1] = rnd.choice([[], say(1), say(2)]) or ["X"]
                texts.append(" ".join(copy))
    return [*texts, None, "", " ", "One", "one", "a b", "A b", texts[5], texts[5]]


@pytest.mark.parametrize("k, percent, edits", [(3, 90, 3), (5, 80, 4), (1, 50, 6), (2, 100, 1)])
def test_equals_all_pairs(docs, monkeypatch, k, percent, edits):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)  # tiles of several blocks
    texts = _texts(k, edits)
    ids = [7 * i % 1000 for i in range(len(texts))]
    got = ngram_join.near_duplicate_classes(docs(*texts, ids=ids), k, percent).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute(ids, texts, k, percent))


def test_bitmaps_bound_the_difference_from_below():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rnd.integers(0, 2**63, rnd.integers(1, 300), dtype="u8"))
        b = np.unique(np.concatenate([a[: rnd.integers(0, len(a) + 1)], rnd.integers(0, 2**63, 5, dtype="u8")]))
        x, y = (np.frombuffer(ngram_join.bitmap(s), "u8") for s in (a, b))
        n = min(len(x), len(y))
        differ = int(np.bitwise_count(ngram_join.folded(x, n) ^ ngram_join.folded(y, n)).sum())
        assert differ <= len(np.setxor1d(a, b))


def test_defined_results(docs):
    frame = docs("a b c d", "A b c d", None, None, "", "z", ids=[None, 5, None, 3, 3, 3])
    got = sorted((tuple(r) for r in ngram_join.class_report(frame).collect()), key=str)
    assert got == sorted([(None, 2, 5), (5, 2, 5), (None, 0, None), (3, 0, 3), (3, 0, 3), (3, 1, 3)], key=str)
    assert ngram_join.class_report(frame.limit(0)).collect() == []


def test_one_tile_of_thousands_of_near_copies(spark, monkeypatch):
    """Connected by rows in proportion to the members: next to nothing is left for the blocks, whose rows grow faster."""
    rows_in_blocks = []
    blocks = ngram_join._blocks

    def counted(tiles, links):
        cut = blocks(tiles, links)
        rows_in_blocks.append((cut.count(), tiles.count()))
        return cut

    monkeypatch.setattr(ngram_join, "_blocks", counted)
    monkeypatch.setattr(ngram_join, "BLOCK", 64)
    base = " ".join(f"'w{k}'" for k in range(60))
    same = spark.range(20_000).selectExpr("id as doc_id", f"concat_ws(' ', {', '.join(base.split())}, 'end', cast(id as string)) as text")
    other = spark.range(20_000, 20_040).selectExpr("id as doc_id", f"concat_ws(' ', {', '.join(base.split()[:30])}, cast(id as string), 'x', cast(id * 7 as string)) as text")
    got = ngram_join.near_duplicate_classes(same.union(other), 3, 90).select("doc_id", "component_id").collect()
    assert {r.component_id for r in got if r.doc_id < 20_000} == {0}
    assert len({r.component_id for r in got if r.doc_id >= 20_000}) == len({r.component_id for r in got}) - 1
    assert len(got) == 20_040 and all(n <= 20_040 * 80 for n, _ in rows_in_blocks)


def test_blocks_take_bitmaps_a_few_sets_at_a_time(spark, monkeypatch):
    """Texts alike in most parts, but not enough: each stands in many blocks, which must not all hold its bitmap at once."""
    own = lambda k: [f"own{k}_{i}" for i in range(150)]
    shared = [f"w{i}" for i in range(400)]
    texts = [" ".join(shared + own(k)) for k in range(6)] + [" ".join([*shared, *own(0)[:-2], "x"])]
    rows, write = [], ngram_join.stored

    def counted(df, name, *batch):
        out = write(df, name, *batch)
        if name == "blocks" and "label" in out.columns:
            rows.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "stored", counted)
    monkeypatch.setattr(ngram_join, "FEW", 1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in ngram_join.near_duplicate_classes(docs, 1, 80).collect()}
    assert found == {**{k: k for k in range(6)}, 6: 0}
    # turns are dealt by a hash, so they are about equal
    assert len(rows) > 2 and max(rows) <= 3 * ngram_join.MOVED * len(texts)
