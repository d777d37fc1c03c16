"""Merkle manifest of a dataset, with proofs for all documents by octopus multiproofs.

Each row is a leaf, the digest of its fields. Leaves of a source stand in order of their ids, every ``FANOUT`` consecutive nodes
become one node of the level above, up to the source's root; the sources' roots are the leaves of one more tree, whose root is that of
the dataset. Digests are SHA-256; a node is that of its children's digests, written as hexadecimal text one after another.

Leaves are numbered by sorted ranges, never by one global sort in a task. The trees are built several levels at a time:
``FANOUT`` ** ``DEEP`` neighbouring nodes are one bounded row, folded by a task.

Proofs are made by partitions of ``SPAN`` consecutive leaves, whatever sources they belong to. A partition first finds the
coordinates of the nodes it lacks: it walks up from the leaves it has, level by level, and lists a node's siblings only where it
has neither them nor anything below them. That union is fetched in one join, a few nodes at either edge. Then the partition
derives the interior nodes its leaves share, once each, and writes out the proof of every leaf from them; what a proof says about
a node's ancestors is made once for the node and reused by all leaves below.

Defined results: null fields count as ``-``; null ids stand before others, null sources too. Equal ids follow one another in
order of their digests. Texts may be empty or of any length. An empty table has no leaves and no root. Columns other than the
fields are not read; of columns with equal names the first is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import ID, TEXT, numbered, pick, stored

FIELDS = (ID, "source", "lang", "n_chars", TEXT)
FANOUT = 3
DEEP = 6  # levels that a task folds at a time
SPAN = 4096  # leaves that are proven together
TOP = -1  # number of the tree over the sources
NODE = "tree long, level int, idx long, n long, digest binary"


def digest(children: Iterable[bytes]) -> bytes:
    return hashlib.sha256("".join([c.hex() for c in children]).encode()).digest()


def leaf(fields: Iterable[Column]) -> Column:
    """Digest of a row's fields: ``-`` for null, else number of UTF-8 bytes, colon, value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.when(field.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.unhex(F.sha2(F.concat(*parts), 256))


@dataclass
class Manifest:
    """``leaves``: tree, idx, n (leaves of the tree), digest, no (over all trees), the rows' id, source and carried columns.
    ``nodes``: all nodes of all levels, with the number of nodes on their level. ``root``: None without leaves."""

    leaves: DataFrame
    nodes: DataFrame
    root: bytes | None


def _folder(deep: int):
    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for tree, level, block, n, digests in frame.itertuples(index=False):
                first, row = block * FANOUT**deep, list(digests)
                for _ in range(deep):
                    if n == 1:
                        break
                    row = [digest(row[k : k + FANOUT]) for k in range(0, len(row), FANOUT)]
                    level, first, n = level + 1, first // FANOUT, -(-n // FANOUT)
                    out += [(tree, level, first + k, n, d) for k, d in enumerate(row)]
            yield pd.DataFrame(out, columns=["tree", "level", "idx", "n", "digest"])

    return fold


def grown(leaves: DataFrame, most: int, deep: int = DEEP) -> DataFrame:
    """All nodes (see ``NODE``) over the leaves of several trees, of which the largest has ``most``."""
    found = leaves.select("tree", F.lit(0).alias("level"), "idx", "n", "digest")
    open_nodes = found.filter("n > 1")
    while most > 1:
        block = F.expr(f"idx div {FANOUT**deep}").alias("block")
        row = F.sort_array(F.collect_list(F.struct("idx", "digest")))["digest"].alias("digests")  # bounded by the block
        blocks = open_nodes.groupBy("tree", "level", block, "n").agg(row).select("tree", "level", "block", "n", "digests")
        above = stored(blocks.mapInPandas(_folder(deep), NODE), "nodes")
        found = found.union(above)
        top = above.agg(F.max("level")).first()[0]
        open_nodes = above.filter((F.col("level") == top) & (F.col("n") > 1))
        most = -(-most // FANOUT**deep)
    return found


def build(
    docs: DataFrame, fields: Iterable[str] = FIELDS, id_col: str = ID, source: str = "source", carry: dict[str, Column] | None = None, deep: int = DEEP
) -> Manifest:
    """The manifest of all rows. ``carry``: further columns of the leaves, from the fields."""
    fields = list(fields)
    rows = pick(docs, *dict.fromkeys([*fields, id_col, source]))
    extra = [c.alias(name) for name, c in (carry or {}).items()]
    slim = rows.select(F.col(id_col).alias("id"), F.col(source).alias("of"), leaf(map(F.col, fields)).alias("digest"), *extra)
    slim = stored(slim.withColumn("row", F.monotonically_increasing_id()), "leaves")
    placed = numbered(slim, F.col("of").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("digest"), F.col("row"))
    sources = placed.groupBy("of").agg(F.min("no").alias("first"), F.count("*").alias("n"))
    sources = numbered(sources, F.col("of").asc_nulls_first(), name="tree").withColumnRenamed("of", "by")
    leaves = placed.join(sources, placed["of"].eqNullSafe(sources["by"])).withColumn("idx", F.col("no") - F.col("first"))
    leaves = leaves.select("tree", "idx", "n", "digest", "no", "id", F.col("of").alias("source"), *(carry or {}))
    n_sources, most = sources.agg(F.count("*"), F.max("n")).first()
    nodes = grown(leaves, most or 0, deep)
    subroots = nodes.filter("n = 1").select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(n_sources).alias("n"), "digest")
    over = grown(stored(subroots, "subroots"), n_sources, deep)
    root = over.filter("n = 1").first()
    return Manifest(leaves, nodes.union(over), bytes(root["digest"]) if root else None)


def _run(idx: int, n: int) -> range:
    """The nodes that are folded into one with this one."""
    first = idx // FANOUT * FANOUT
    return range(first, min(first + FANOUT, n))


def missing(held: Iterable[int], n: int) -> Iterator[tuple[int, int]]:
    """Level and number of the fewest further nodes from which, with the held leaves, a tree of n leaves can be folded."""
    level, held = 0, set(held)
    while n > 1:
        above = set()
        for idx in held:
            if idx // FANOUT not in above:
                above.add(idx // FANOUT)
                yield from ((level, k) for k in _run(idx, n) if k not in held)
        level, held, n = level + 1, above, -(-n // FANOUT)


class Tree:
    """The part of a tree that a partition knows: its own leaves and what it fetched."""

    def __init__(self, own: dict[int, bytes], n: int, fetched: dict[tuple[int, int], bytes]):
        self.sizes, self.levels, self.siblings = [n], [dict(own)], []
        own_now = list(own)
        while self.sizes[-1] > 1:
            level, n, known = len(self.levels) - 1, self.sizes[-1], self.levels[-1]
            above: dict[int, bytes] = {}
            for idx in own_now:
                if idx // FANOUT not in above:
                    for k in _run(idx, n):
                        if k not in known:
                            known[k] = fetched[level, k]
                    above[idx // FANOUT] = digest(known[k] for k in _run(idx, n))
            own_now = list(above)
            self.levels.append(above)
            self.sizes.append(-(-n // FANOUT))
        self.proofs: dict[tuple[int, int], list[bytes]] = {}

    def proof(self, idx: int, level: int = 0) -> list[bytes]:
        """Digests of a node's siblings and of its ancestors' siblings, from below, left to right."""
        if level == len(self.sizes) - 1:
            return []
        found = self.proofs.get((level, idx))
        if found is None:
            known = self.levels[level]
            found = [known[k] for k in _run(idx, self.sizes[level]) if k != idx] + self.proof(idx // FANOUT, level + 1)
            if level:  # a leaf's own proof is asked for once
                self.proofs[level, idx] = found
        return found


def folded(claimed: bytes, idx: int, n: int, proof: Iterator[bytes]) -> bytes:
    """The root that a leaf and the digests of a proof give."""
    while n > 1:
        claimed = digest([claimed if k == idx else next(proof) for k in _run(idx, n)])
        idx, n = idx // FANOUT, -(-n // FANOUT)
    return claimed


def _coordinates(frame: pd.DataFrame) -> pd.DataFrame:
    chunk, n_top = frame["chunk"].iat[0], int(frame["n_top"].iat[0])
    out = [(chunk, TOP, *c) for c in missing(frame["tree"].tolist(), n_top)]
    for tree, own in frame.groupby("tree"):
        out += [(chunk, tree, *c) for c in missing(own["idx"].tolist(), int(own["n"].iat[0]))]
    return pd.DataFrame(out, columns=["chunk", "tree", "level", "idx"])


def _expanded(leaves: pd.DataFrame, fetched: pd.DataFrame) -> pd.DataFrame:
    by_tree: dict[int, dict[tuple[int, int], bytes]] = {}
    for tree, level, idx, found in zip(fetched["tree"], fetched["level"], fetched["idx"], fetched["digest"], strict=True):
        by_tree.setdefault(tree, {})[level, idx] = found
    sizes = leaves.groupby("tree")["n"].first().to_dict()
    trees = {}
    for tree, own in leaves.groupby("tree"):
        trees[tree] = Tree(dict(zip(own["idx"].tolist(), own["digest"], strict=True)), int(sizes[tree]), by_tree.get(tree, {}))
    n_top = int(leaves["n_top"].iat[0]) if len(leaves) else 0
    top = Tree({tree: t.levels[-1][0] for tree, t in trees.items()}, n_top, by_tree.get(TOP, {}))
    above = {tree: top.proof(tree) for tree in trees}
    out = []
    for tree, idx, n, no, claimed in zip(leaves["tree"], leaves["idx"], leaves["n"], leaves["no"], leaves["claimed"], strict=True):
        siblings = trees[tree].proof(idx) + above[tree]
        rest = iter(siblings)
        root = folded(folded(claimed, idx, n, rest), tree, n_top, rest)
        out.append((no, trees[tree].levels[-1][0], b"".join(siblings), root))
    return pd.DataFrame(out, columns=["no", "subroot", "proof", "folded_root"])


def prove(manifest: Manifest, wanted: DataFrame | None = None, claimed: str = "digest", span: int = SPAN) -> DataFrame:
    """no, subroot, proof (siblings' digests of 32 bytes, one after another) and folded_root of each wanted leaf.

    ``wanted``: some rows of ``manifest.leaves``, all by default. ``claimed``: the column with the digest that the root is
    folded from; the rest of the proof is that of the manifest.
    """
    leaves = manifest.leaves if wanted is None else wanted
    n_top = manifest.nodes.filter(F.col("tree") == TOP).agg(F.max("n")).first()[0] or 0
    chunk = F.expr(f"no div {span}").alias("chunk")
    mine = leaves.select(chunk, "tree", "idx", "n", "no", "digest", F.col(claimed).alias("claimed"), F.lit(n_top).cast("long").alias("n_top"))
    lacking = mine.select("chunk", "tree", "idx", "n", "n_top").groupBy("chunk").applyInPandas(_coordinates, "chunk long, tree long, level int, idx long")
    fetched = stored(lacking.join(manifest.nodes.drop("n"), ["tree", "level", "idx"]).select("chunk", "tree", "level", "idx", "digest"), "fetched")
    pairs = mine.groupBy("chunk").cogroup(fetched.groupBy("chunk"))
    return pairs.applyInPandas(_expanded, "no long, subroot binary, proof binary, folded_root binary")


def manifest_report(docs: DataFrame, span: int = SPAN, deep: int = DEEP) -> DataFrame:
    """Proofs of all rows; the root folded anew from texts without line feeds where the id's checksum is even."""
    fields = dict.fromkeys(FIELDS)
    tampered = leaf([F.replace(F.col(TEXT), F.lit("\n"), F.lit("")) if c == TEXT else F.col(c) for c in fields])
    even = F.coalesce(F.crc32(F.col(ID).cast("string")) % 2 == 0, F.lit(False)) & F.col(TEXT).contains("\n")
    claimed = F.when(F.coalesce(even, F.lit(False)), tampered).otherwise(leaf(map(F.col, fields)))
    manifest = build(docs, carry={"claimed": claimed}, deep=deep)
    proofs = prove(manifest, claimed="claimed", span=span)
    low = lambda c: F.lower(F.hex(c))
    root = F.lit(manifest.root.hex() if manifest.root else None).cast("string")
    out = manifest.leaves.select("no", F.col("id").alias(ID), low("digest").alias("leaf")).join(proofs, "no")
    return out.select(
        ID, "leaf", low("subroot").alias("subroot"), root.alias("root"), F.sha2(low("proof"), 256).alias("proof_sha256"),
        low("folded_root").alias("folded_root"), (low("folded_root") == root).alias("verified"),
    )
