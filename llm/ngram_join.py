"""Exact Jaccard join of documents on word shingles, down to classes of documents that links connect.

Sets of two linked documents differ in at most d shingles, where d follows from the sizes and the similarity asked for. Sizes fall
into bands with an upper bound each. A document's hashed shingles are cut into d + 1 + s parts by ranges of the hash, with d
that of the band, so at least s + 1 parts agree whole between two linked documents. A document with more than s empty parts lists those too;
any other lists its filled parts, one of which must be among the agreeing ones. A document enters the band of its own size and
those of the larger partners it may have. A tile is the set of documents that list one part of one band; no other pairs are ever looked at.

Hashed bitmaps (one parity bit per hash value) bound the overlap of two sets from above: the bits that differ are at most the
shingles that differ. Pairs that pass are checked by exact intersection of the sorted arrays. First each tile pairs all of its
members with one of them, chosen by a hash, and again with others: that costs a row per member and connects nearly all copies. What then
isn't connected is compared in full: of the pairs that pass the bitmaps a tile gives only those that would connect something. A
tile that had a pair rejected is gone through again without it, and then gives several pairs for each connection it needs, eight
times as many in each round. So no group of n copies gives n * n pairs, and no link between classes is lost. Tiles with many
members are cut into blocks of all members by those outside of the tile's largest class, since others are connected already.

Keys are dealt out in slices, and every table is deleted once it is used up, so that little is on disk at a time.

Sets are told apart by 64-bit hashes of their 64-bit shingle hashes.

Defined results: null texts and texts without words have no shingles, link with nothing, and are classes of their own. A text of
fewer words than a shingle has its whole sequence as the one. Documents without an id belong to classes but give no class its
name; a class without any id has a null one. Documents that share an id are not thereby linked. Rows stay one to one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import ID, TEXT, discard, pick, stored

SHINGLE, PERCENT = 3, 90
BAND = 1.3  # ratio of a band's bounds
BLOCK = 1024  # most members of a tile that are looked at together
SLICES, PARTS = 4, 2  # parts of the keys, and of pairs, that are gone through one after another
MOVED, FEW = 4, 20_000  # bitmaps moved to blocks at a time, for each set in tiles, of which FEW are taken for that many
STARS = 2  # members of a tile that all others are compared with first
TEXTS = 500  # whole texts that a task holds at a time
SEEN = 100_000  # sets that a task remembers, to describe copies once

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles, A-Z in lower case."""
    words = text.encode().translate(_LOWER).split() if text else []
    if not words:
        return np.zeros(0, "u8")
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), "u8", len(words))
    n = min(k, len(h))
    z = np.full(len(h) - n + 1, n, "u8")
    for j in range(n):
        z = (z ^ h[j : len(h) - n + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
        z ^= z >> np.uint64(29)
        z *= np.uint64(0xBF58476D1CE4E5B9)
        z ^= z >> np.uint64(32)
    return np.unique(z)


def most_different(size: int, percent: int) -> int:
    """Most shingles in which two linked sets of at most this size differ."""
    return 2 * size * (100 - percent) // (100 + percent)


def band_of(size: int) -> tuple[int, int]:
    """Number of a size's band and the band's upper bound."""
    j, bound = 0, 4
    while bound < size:
        j, bound = j + 1, int(bound * BAND) + 1
    return j, bound


def parts(sorted_hashes: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the tiles a set belongs to. Sets so small that linked ones are equal belong to none."""
    n = len(sorted_hashes)
    if not n:
        return np.zeros(0, "i8")
    mixed = sorted_hashes * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    sums = np.concatenate([np.zeros(1, "u8"), np.cumsum(mixed)])
    keys = []
    for band in range(band_of(n)[0], band_of(n * 100 // percent)[0] + 1):
        bound = 4
        for _ in range(band):
            bound = int(bound * BAND) + 1
        d = most_different(bound, percent)
        if not d:
            continue
        spare = 2 + d // 16
        m = d + 1 + spare
        edges = np.searchsorted(sorted_hashes, (np.arange(1, m) * (2.0**64 / m)).astype("u8"))
        edges = np.concatenate([[0], edges, [n]])
        filled = edges[1:] > edges[:-1]
        listed = np.flatnonzero(filled) if m - filled.sum() <= spare else np.arange(m)
        z = sums[edges[listed + 1]] - sums[edges[listed]]
        z = (z ^ np.uint64(band << 32) ^ listed.astype("u8")) * np.uint64(0xFF51AFD7ED558CCD)
        keys.append(((z ^ (z >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)).view("i8"))
    return np.concatenate(keys) if keys else np.zeros(0, "i8")


def bitmap(sorted_hashes: np.ndarray) -> bytes:
    """Parity of the hashes that fall to each bit; eight bits or more for each hash, a power of two."""
    width = max(64, 1 << (8 * len(sorted_hashes) - 1).bit_length())
    bits = np.bincount((sorted_hashes & np.uint64(width - 1)).astype("i8"), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """A bitmap of half the width is that of the halves' parity."""
    while len(bits) > size:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


class Forest:
    """Which members of one block of a tile are connected."""

    def __init__(self, labels: Iterator[int]):
        self.root: dict[int, int] = {x: x for x in labels}

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.root[max(x, y)] = min(x, y)
        return x != y


def connecting_pairs(nodes, sizes, bitmaps, labels, rejected: set[tuple[int, int]], percent: int, layers: int = 1) -> list[tuple[int, int]]:
    """Pairs within a block that may be linked and connect different labels.

    As many as it takes to connect them, ``layers`` times over: pairs that one forest has no use for go to the next.
    """
    if len(nodes) < 2:
        return []
    narrow = min(map(len, bitmaps)) // 8
    bits = np.stack([folded(np.frombuffer(b, "u8"), narrow) for b in bitmaps])
    forests, found = [Forest(labels) for _ in range(layers)], []
    sizes = np.asarray(sizes, "i8")
    left = layers * (len(set(labels)) - 1)
    for i in range(len(nodes) - 1):
        if not left:
            break
        differ = np.bitwise_count(bits[i + 1 :] ^ bits[i]).sum(axis=1, dtype="i8")
        both = sizes[i + 1 :] + sizes[i]
        for j in np.flatnonzero(differ * (100 + percent) <= both * (100 - percent)) + i + 1:
            pair = (min(nodes[i], nodes[j]), max(nodes[i], nodes[j]))
            if labels[i] != labels[j] and pair not in rejected and any(f.join(labels[i], labels[j]) for f in forests):
                found.append(pair)
                left -= 1
    return found


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def describe(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Per row: node (hash of the set), n_shingles, keys and bitmap; these two are null where the task has given them before."""

    def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for frame in frames:
            for at in range(0, len(frame), 256):
                some, out = frame.iloc[at : at + 256], []
                for row, doc_id, text in zip(some["row"], some["doc_id"], some["text"], strict=True):
                    s = shingles(text, k)
                    node = xxhash.xxh3_64_intdigest(s.tobytes())
                    new = len(s) > 0 and node not in seen
                    out.append((row, doc_id, np.uint64(node).astype("i8"), len(s), parts(s, percent) if new else None, bitmap(s) if new else None))
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(node)
                yield pd.DataFrame(out, columns=["row", "doc_id", "node", "n_shingles", "keys", "bitmap"]).astype({"doc_id": "Int64"})

    return docs.mapInPandas(found, "row long, doc_id long, node long, n_shingles long, keys array<long>, bitmap binary")


def components(links: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Least node reachable by links, for nodes that have any. ``labels``: of earlier links, node and label, used up here."""
    known = links if labels is None else links.union(labels.filter("node <> label").select("node", "label"))
    a, b = known.columns
    both = stored(known.union(known.select(b, a)).toDF("a", "b").distinct(), "edges")
    at = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(at.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        lower = at.join(near, at.node == near.a).select("node", "label", F.least("label", "near").alias("next"))
        jump = at.select(F.col("node").alias("next"), F.col("label").alias("there"))
        moved = stored(lower.join(jump, "next").select("node", F.col("label").alias("was"), F.least("next", "there").alias("label")), "labels")
        discard(at)
        at = moved.select("node", "label")
        if moved.filter("was <> label").isEmpty():
            discard(both, *([] if labels is None else [labels]))
            return at


def _tiles(sets: DataFrame) -> DataFrame:
    """key and node of the tiles that have several members, tiles of the same members once; ``members``: how many."""
    met = []
    for part in range(SLICES):
        mine = F.filter("keys", lambda x: F.pmod(x, F.lit(SLICES)) == part)
        rows = sets.select(F.explode(mine).alias("key"), "node")
        shared = rows.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a < b").select("key")
        found = stored(rows.join(shared, "key"), "met")
        met.append(stored(found.distinct(), "met"))
        discard(found)
    every = reduce(DataFrame.union, met)
    members = every.groupBy("key").agg(
        F.count("*").alias("members"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y")
    )
    once = members.groupBy("members", "x", "y").agg(F.min("key").alias("key")).select("key", "members")
    tiles = stored(every.join(once, "key"), "tiles")
    discard(*met)
    return tiles


class Links:
    """What is known of pairs of sets: labels of connected ones, and pairs that turned out not to be linked."""

    def __init__(self, about: DataFrame, arrays: DataFrame, percent: int):
        self.about, self.arrays, self.percent = about, arrays, percent
        self.labels: DataFrame | None = None
        self.rejected: list[DataFrame] = []

    def with_label(self, rows: DataFrame) -> DataFrame:
        if self.labels is None:
            return rows.withColumn("label", F.col("node"))
        return rows.join(self.labels, "node", "left").withColumn("label", F.coalesce("label", "node"))

    def rejects(self) -> DataFrame:
        return reduce(DataFrame.union, self.rejected, self.about.sparkSession.createDataFrame([], "a long, b long"))

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs that the bitmaps don't rule out."""
        percent = self.percent

        def bounded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                yes = []
                for m, n, x, y in zip(frame["m"], frame["n"], frame["x"], frame["y"], strict=True):
                    size = min(len(x), len(y)) // 8
                    differ = int(np.bitwise_count(folded(np.frombuffer(x, "u8"), size) ^ folded(np.frombuffer(y, "u8"), size)).sum())
                    yes.append(differ * (100 + percent) <= (m + n) * (100 - percent))
                yield frame.loc[np.array(yes, dtype=bool), ["a", "b"]]

        x = self.about.select(F.col("node").alias("a"), F.col("n_shingles").alias("m"), F.col("bitmap").alias("x"))
        y = self.about.select(F.col("node").alias("b"), F.col("n_shingles").alias("n"), F.col("bitmap").alias("y"))
        return pairs.join(x, "a").join(y, "b").mapInPandas(bounded, "a long, b long")

    def judge(self, pairs: DataFrame, slices: int = 1) -> DataFrame:
        """Check pairs exactly and take up the links; those that are none. Many pairs may be gone through in slices."""
        percent = self.percent

        def exact(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                yes = [linked(np.asarray(x).view("u8"), np.asarray(y).view("u8"), percent) for x, y in zip(frame["x"], frame["y"], strict=True)]
                yield pd.DataFrame({"a": frame["a"], "b": frame["b"], "yes": np.array(yes, dtype=bool)})

        x = self.arrays.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
        y = self.arrays.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
        parts = []
        for part in range(slices):
            mine = F.pmod(F.xxhash64("a"), F.lit(slices)) == part
            both = pairs.filter(mine).join(x.filter(mine), "a").join(y, "b")
            parts.append(stored(both.mapInPandas(exact, "a long, b long, yes boolean"), "judged"))
        judged = reduce(DataFrame.union, parts)
        links = judged.filter("yes").select("a", "b")
        if not links.isEmpty():
            self.labels = components(links, self.labels)
        wrong = stored(judged.filter("not yes").select("a", "b").distinct(), "rejected")
        discard(judged)
        self.rejected.append(wrong)
        return wrong


def _stars(tiles: DataFrame, links: Links) -> DataFrame:
    """Compare all members of a tile with one, several times; what is left of the tiles then."""
    for turn in range(STARS):
        known = links.with_label(tiles.select("key", "node", "members"))
        one = F.min(F.struct(F.xxhash64(F.lit(turn), "node").alias("h"), F.col("node").alias("one"), F.col("label").alias("its"))).alias("o")
        mixed = known.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("m"), one).filter("l <> m").select("key", "o.one", "o.its")
        left = stored(known.join(mixed, "key"), "tiles")
        discard(tiles)
        tiles = left
        pairs = left.filter("label <> its").select(F.least("node", "one").alias("a"), F.greatest("node", "one").alias("b")).distinct()
        likely = stored(links.likely(pairs), "likely")
        links.judge(likely, PARTS)
        discard(likely)
    return tiles.select("key", "node", "members")


def _blocks(tiles: DataFrame, links: Links) -> DataFrame:
    """Tiles with unconnected members, cut up: block (p, q) has a p-th part of all members and a q-th of those outside the largest class."""
    known = stored(links.with_label(tiles), "tiles")
    sizes = known.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.max(F.struct("n", "label")).alias("top"), F.count("*").alias("classes")
    )
    mixed = known.join(sizes.filter("classes > 1").select("key", "top"), "key")
    outside = F.col("label") != F.col("top.label")
    across, down = (F.ceil(n / BLOCK).cast("int") for n in (F.col("members"), F.col("members") - F.col("top.n")))
    own, other = F.pmod(F.xxhash64(F.lit(2), "node"), across).cast("int"), F.pmod(F.xxhash64(F.lit(3), "node"), down).cast("int")
    place = lambda p, q: F.struct(p.alias("p"), q.alias("q"))
    in_all = F.transform(F.sequence(F.lit(0), down - 1), lambda q: place(own, q))
    in_other = F.transform(F.sequence(F.lit(0), across - 1), lambda p: place(p, other))
    places = F.when(outside, F.array_union(in_all, in_other)).otherwise(in_all)
    cut = stored(mixed.select("key", "node", F.explode(places).alias("at")).select("key", "at.p", "at.q", "node"), "blocks")
    discard(known)
    return cut


def set_classes(sets: DataFrame, arrays_of: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame | None:
    """node and label of the sets that are linked with others; None if there are none.

    ``sets``: a stored table, deleted here, of node, n_shingles, keys and bitmap, a node at least once. ``arrays_of`` gives node and sorted hashes for a table of nodes.
    """
    tiles = _tiles(sets)
    if tiles.isEmpty():
        discard(tiles, sets)
        return None
    nodes = stored(tiles.select("node").distinct(), "nodes")
    about = stored(sets.select("node", "n_shingles", "bitmap").join(nodes, "node").dropDuplicates(["node"]), "bitmaps")
    discard(sets)
    arrays = stored(arrays_of(nodes), "arrays", TEXTS)
    links = Links(about, arrays, percent)
    tiles = _stars(tiles, links)
    cut = _blocks(tiles, links)
    discard(tiles)

    def finder(layers: int):
        def candidates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                out = []
                for r in frame.itertuples(index=False):
                    order = np.lexsort((r.nodes, r.sizes))
                    nodes, sizes, labels = (np.asarray(x)[order].tolist() for x in (r.nodes, r.sizes, r.labels))
                    gone = set() if r.a is None else set(zip(r.a.tolist(), r.b.tolist(), strict=True))
                    pairs = connecting_pairs(nodes, sizes, [r.bitmaps[k] for k in order], labels, gone, percent, layers)
                    out += [(r.key, r.p, r.q, *pair) for pair in pairs]
                yield pd.DataFrame(out, columns=["key", "p", "q", "a", "b"])

        return candidates

    block = ["key", "p", "q"]
    # a set stands in many blocks, each of which takes its bitmap
    turns = max(1, -(-cut.count() // (MOVED * max(FEW, nodes.count()))))
    for turn in range(turns):
        open_blocks, layers, mine = cut.filter(F.pmod(F.xxhash64(F.lit(4), *block), F.lit(turns)) == turn), 1, []
        while not open_blocks.isEmpty():
            known = links.with_label(open_blocks)
            mixed = known.groupBy(*block).agg(F.min("label").alias("l"), F.max("label").alias("m")).filter("l <> m").select(*block)
            todo = stored(known.join(mixed, block), "blocks")
            a, b = (todo.toDF(*todo.columns).select(*[F.col(c).alias(c) for c in block], F.col("node").alias(x)) for x in "ab")
            # a rejected pair is known to every block that holds it
            gone = a.join(links.rejects().distinct(), "a").join(b, [*block, "b"])
            # a block's members are bounded, so they may stand in one row
            member = F.collect_list(F.struct("node", "n_shingles", "bitmap", "label")).alias("m")
            pairs = gone.toDF(*gone.columns).groupBy(*block).agg(F.collect_list(F.struct("a", "b")).alias("gone"))
            rows = todo.join(about, "node").groupBy(*block).agg(member).join(pairs, block, "left").select(
                *block, F.col("m.node").alias("nodes"), F.col("m.n_shingles").alias("sizes"), F.col("m.bitmap").alias("bitmaps"),
                F.col("m.label").alias("labels"), F.col("gone.a").alias("a"), F.col("gone.b").alias("b"),
            )
            found = stored(rows.mapInPandas(finder(layers), "key long, p int, q int, a long, b long"), "candidates")
            if found.isEmpty():  # nothing that would connect anything
                discard(todo, found)
                break
            wrong = links.judge(found.select("a", "b").distinct())
            open_blocks = stored(todo.join(found.join(wrong, ["a", "b"]).select(*block).distinct(), block).select(*block, "node"), "blocks")
            discard(todo, found, *mine)
            mine, layers = [open_blocks], layers * 8
        discard(*mine)
    discard(cut, nodes, about, arrays, *links.rejected)
    return links.labels


def near_duplicate_classes(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, id_col: str = ID, text: str = TEXT) -> DataFrame:
    """One row per row of ``docs``: doc_id, row (hash of id and text), n_shingles, class and component_id (its least doc_id)."""
    rows = pick(docs, doc_id=id_col, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text"))
    described = stored(describe(rows, k, percent), "described", TEXTS)
    flat = stored(described.select("row", "doc_id", "node", "n_shingles"), "sets")

    def arrays_of(nodes: DataFrame) -> DataFrame:
        wanted = flat.join(nodes, "node").groupBy("node").agg(F.min("row").alias("row"))

        def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for at in range(0, len(frame), 256):
                    some = frame.iloc[at : at + 256]
                    yield pd.DataFrame({"node": some["node"], "hashes": [shingles(t, k).view("i8") for t in some["text"]]})

        # equal rows have one key: a text of each is enough, and stands in its place already
        texts = rows.select("row", "text").join(wanted, "row").dropDuplicates(["row"])
        return texts.mapInPandas(found, "node long, hashes array<long>")

    labels = set_classes(described.filter("keys is not null").select("node", "n_shingles", "keys", "bitmap"), arrays_of, percent)
    flat = flat.withColumn("label", F.col("node")) if labels is None else flat.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    full = flat.filter("n_shingles > 0")
    least = full.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    empty = flat.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "row", "n_shingles", F.col("label").alias("class"), "component_id"]
    return reduce(DataFrame.union, [full.join(least, "label").select(columns), empty.select(columns)])


def class_report(docs: DataFrame) -> DataFrame:
    return near_duplicate_classes(docs).select(ID, "n_shingles", "component_id")
