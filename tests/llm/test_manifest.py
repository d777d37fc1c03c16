import hashlib
import random

import pytest
from pyspark.sql import functions as F

from llm import manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain(rows):
    """Leaf, subroot, root and proof of each row, by whole levels."""
    def leaf(row):
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])

    def tree(nodes):
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k, i in enumerate(at):
                paths[k] += [nodes[j] for j in range(i // 3 * 3, min(i // 3 * 3 + 3, len(nodes))) if j != i]
            nodes, at = [h(*nodes[k : k + 3]) for k in range(0, len(nodes), 3)], [i // 3 for i in at]
        return nodes[0], paths

    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees, out = {}, []
    for s in sources:
        mine = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = (mine, *tree([leaf(r) for r in mine]))
    root, above = tree([trees[s][1] for s in sources])
    for k, s in enumerate(sources):
        mine, subroot, paths = trees[s]
        out += [(r[0], leaf(r), subroot, root, h(*path, *above[k])) for r, path in zip(mine, paths)]
    return sorted(out, key=str)


@pytest.fixture
def table(spark):
    def build(rows):
        data = [(*r, "x", 3) for r in rows]
        return spark.createDataFrame(data, "doc_id long, source string, lang string, n_chars long, text string, TEXT string, idx int")

    return build


def report(df, **sizes):
    got = manifest.manifest_report(df, **sizes).collect()
    for r in got:
        assert r.verified == (r.folded_root == r.root)
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in got), key=str), got


@pytest.mark.parametrize("span, deep", [(4096, 6), (7, 2)])
def test_trees_and_proofs(table, span, deep):
    pick = random.Random(3)
    rows = [(k, pick.choice([None, "a", "a", "a", "é", "z", "", f"s{k % 11}"]), pick.choice([None, "en"]), k, f"text\n{k}") for k in range(150)]
    rows += [(None, "a", None, None, None), (None, "a", None, None, ""), (5, "a", "en", 1, "again"), (-(2**63), "z", None, None, "ü" * 5000)]
    rows += [(77, "dup", None, None, "same")] * 9  # repeated rows
    got, _ = report(table(rows), span=span, deep=deep)
    assert got == plain(rows)


def test_tampered_texts_are_found(table):
    rows = [(k, "a", "en", 1, "one\ntwo" if k % 3 else "one two") for k in range(60)] + [(100, "a", None, None, None)]
    _, got = report(table(rows))
    import zlib
    for r in got:
        text = next(x[4] for x in rows if x[0] == r.doc_id)
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 2 == 1 or "\n" not in (text or ""))


def test_one_row_and_no_rows(table):
    got, full = report(table([(1, None, None, None, "x")]))
    assert got == plain([(1, None, None, None, "x")])
    assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == h() and full[0].verified
    assert report(table([]))[0] == []


def test_proofs_of_some_leaves_fetch_few_nodes(table):
    rows = [(k, "ab"[k % 2], None, None, str(k)) for k in range(400)]
    made = manifest.build(table(rows))
    some = made.leaves.filter(F.col("id").isin(3, 4, 5, 399))
    got = manifest.prove(made, some).collect()
    assert len(got) == 4 and all(bytes(r.folded_root) == made.root for r in got)


def test_missing_nodes_are_the_fewest():
    """Against all nodes: what is listed can't be derived, and with it everything on the way up can."""
    pick = random.Random(5)
    for n in (1, 2, 3, 4, 9, 10, 28, 100):
        for _ in range(10):
            held = set(pick.sample(range(n), pick.randint(1, n)))
            listed = list(manifest.missing(held, n))
            assert len(listed) == len(set(listed))
            size, level, known = n, 0, set(held)
            while size > 1:
                need = {k for i in known for k in range(i // 3 * 3, min(i // 3 * 3 + 3, size))} - known
                assert need == {k for at, k in listed if at == level}
                known, size, level = {i // 3 for i in known}, -(-size // 3), level + 1
    assert list(manifest.missing(range(81), 81)) == []
