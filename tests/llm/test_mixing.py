from collections import defaultdict

import pytest

from llm import mixing
from llm.common import stored


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "size", "source_size", "target", "taken").collect()), key=str)


def levels(sizes, weights=(5, 2, 1), most=3, total=None):
    """Targets by filling: whoever is above its limit gets just that, the others share the rest."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_ones, out = sum(sizes.values()) if total is None else total, set(sizes), {}
    while open_ones:
        unit = left / sum(weight[s] for s in open_ones)
        above = {s for s in open_ones if most * sizes[s] < unit * weight[s]}
        if not above:
            return out | {s: unit * weight[s] for s in open_ones}
        for s in above:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ones -= above
    return out


@pytest.fixture
def table(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), "doc_id long, text string, source string, size int, SOURCE string, _edge int")

    return build


def rest(n=0):
    return (n, "clash", n)


def test_targets_limits_and_taken_words(table):
    rows = [(k, "w " * (1 + k % 7), "abcdefgh"[k % 8] if k % 3 else "a", *rest()) for k in range(400)]
    rows += [(1000, "only one", "tiny", *rest()), (1001, "x y z", None, *rest()), (1002, None, "void", *rest()), (1003, "", "", *rest())]
    sizes = defaultdict(int)
    for _, text, source, *_ in rows:
        sizes[source] += len((text or "").split())
    got = mixing.mix(table(*rows)).select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    want, taken, largest = levels(sizes), defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert r.taken <= 3 * r["size"] and (not r["size"] or r.taken % r["size"] == 0)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    assert len(got) == len(rows)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-9


def test_repeated_rows_at_the_threshold_are_taken_in_part(table):
    same = [(7, "one two three four", "a", *rest())] * 300
    got = rows_of(mixing.mix(table(*same, *[(k, "b " * 5, "b", *rest()) for k in range(40, 60)])))
    assert abs(sum(r[4] for r in got if r[0] == 7) - got[-1][3]) <= 2
    assert got == rows_of(mixing.mix(table(*same[::-1], *[(k, "b " * 5, "b", *rest()) for k in range(40, 60)])))
    no_ids = mixing.mix(table(*[(None, "w", "a", *rest())] * 50, *[(None, "v", "b", *rest())] * 50))
    assert sum(r.taken for r in no_ids.collect()) == pytest.approx(100, abs=1)


def test_a_smaller_mix_is_part_of_a_larger_one(table):
    docs = table(*[(k, "w " * (1 + k % 5), "abc"[k % 3], *rest()) for k in range(300)])
    small, large = ({r.doc_id: r.taken for r in mixing.mix(docs, total=t).collect()} for t in (200, 500))
    assert 0 < sum(small.values()) < sum(large.values())
    assert all(small[k] <= large[k] for k in small)
    assert sum(r.taken for r in mixing.mix(docs, total=10**6).collect()) == 3 * sum(1 + k % 5 for k in range(300))


def test_the_mix_holds_documents_as_often_as_taken(table):
    docs = table(*[(k, "w w", "ab"[k % 2], *rest(k)) for k in range(40)], (99, None, "a", *rest()))
    taken = sum(r.taken for r in mixing.mix(docs).collect())
    mixed = mixing.mixed_documents(docs)
    assert mixed.count() * 2 == taken
    assert mixed.columns[:3] == ["doc_id", "text", "source"] and len(mixed.columns) == 6


def test_empty_and_wordless_tables(table):
    assert mixing.mix(table()).collect() == []
    assert rows_of(mixing.mix(table((1, None, "a", *rest()), (2, " \n", None, *rest())))) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_many_equal_lots_settle_at_several_levels(spark):
    """Lots that differ in their last bits alone."""
    rows = spark.createDataFrame([("a", 1, (5 << 20) + k) for k in range(1000)] + [("b", 1, k << 45) for k in range(1000)], "source string, size long, _lot long")
    edges = mixing._edges(stored(rows, "rows"), spark.createDataFrame([("a", 300.5), ("b", 10.0), ("c", 1.0)], "_of string, _left double"))
    assert sorted((r[0], r[1], r[2], r[3]) for r in edges.collect()) == [("a", (5 << 20) + 300, 0.5, 1), ("b", 10 << 45, 0.0, 1)]
