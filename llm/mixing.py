"""Mixing sources to target weights by histograms of hash thresholds.

Every document has a lot, 60 bits of a hash of its id and text. A source's target is so many whole rounds over its documents, and
one more over those whose lot is below a threshold. The threshold is found without sorting: words are summed by source and the
first bits of the lot, the bucket in which the running sum passes the budget is the boundary, and only that bucket is summed
again by its next bits, down to one lot. Then one filter tells all documents. A larger budget has a higher threshold over the
same lots, so mixes are nested: what a smaller one takes, a larger one takes too.

Sources in order of their code points (null last) have the given weights in turn. Targets are the shares of the total by weight;
none is above ``most`` times its source's size, and the excess goes to the others by weight. That is one water level: each source
gets the lesser of its limit and level times weight. The level is found by Newton's steps, each one sum over the sources.

All is built-in expressions, and nothing grows on the driver: per step a flag or a sum. A source may hold most of the rows; sums
are combined before they are shuffled, and a source's histogram has 4096 buckets at most.

Defined results: a null text has size 0 and is taken with 0 words. Null is a source of its own. An empty table stays empty.
The document at the threshold is taken if that brings the source nearer to its target. Rows with equal id and text have one lot;
if it is the boundary, they are written down, numbered, and drawn by a hash of the number, so that part of them can be taken
(which of these equal rows are, doesn't matter). Other columns are kept; those named like the results get ``_1`` behind them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import ID, TEXT, clear, discard, numbered, pick, stored

WEIGHTS, MOST = (5, 2, 1), 3
SOURCE = "source"
BITS, LEVELS = 12, 5  # bits of the lot that one histogram looks at, and histograms at most
OWN = ["size", "source_size", "target", "taken", "_lot", "_rounds", "_rest", "_edge", "_left", "_of"]


def words(text: Column) -> Column:
    """Number of words between blanks."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def lot(row_id: Column, text: Column) -> Column:
    whole = F.concat(F.coalesce(row_id.cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, total: int | None = None) -> DataFrame:
    """``sizes`` (one row per source: source, source_size) with ``target``; ``total``: words wanted, all there are by default."""
    ranked = numbered(sizes, F.col(SOURCE).asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("no") % len(weights) + 1).cast("int"))
    limit = F.col("source_size").cast("double") * most
    ranked = stored(ranked.select(SOURCE, "source_size", limit.alias("_limit"), turn.alias("_weight")), "sources")
    wanted = float((ranked.agg(F.sum("source_size")).first()[0] or 0) if total is None else total)
    level = -1.0
    while True:
        full = F.col("_limit") < F.lit(level) * F.col("_weight")
        held, free = ranked.agg(
            F.coalesce(F.sum(F.when(full, F.col("_limit"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0.0))
        ).first()
        if not free:  # less in the sources than is wanted
            level = float("inf")
            break
        last, level = level, (wanted - held) / free
        if level <= last:
            break
    share = F.lit(level) * F.col("_weight")
    return ranked.select(SOURCE, "source_size", F.when(F.col("_limit") < share, F.col("_limit")).otherwise(share).alias("target"))


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a[SOURCE].eqNullSafe(b["_of"])


def _edges(rows: DataFrame, wants: DataFrame) -> DataFrame:
    """The boundary lot of each source: _of, _edge, _left (words still wanted there), _n (rows that have this lot).

    ``rows``: source, size, _lot. ``wants``: _of, _left. Sources whose documents are all within the budget are left out.
    """
    prefix = None
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        inside = rows.join(wants, _same(rows, wants))
        if prefix is not None:
            inside = inside.filter(F.shiftright("_lot", shift + BITS) == F.col("_bucket"))
        sums = inside.groupBy("_of", "_left", F.shiftright("_lot", shift).alias("_next")).agg(
            F.sum("size").alias("_words"), F.count("*").alias("_n"), F.min("_lot").alias("_edge"), F.max("_lot").alias("_high")
        )
        running = F.sum("_words").over(Window.partitionBy("_of").orderBy("_next"))  # over one row for each bucket
        found = sums.withColumn("_before", running - F.col("_words")).filter("_before <= _left and _left < _before + _words")
        left = (F.col("_left") - F.col("_before")).alias("_left")
        last, wants = wants, stored(found.select("_of", left, F.col("_next").alias("_bucket"), "_n", "_edge", "_high"), "edges")
        if prefix is not None:
            discard(last)
        prefix = True
        if wants.filter("_edge < _high").isEmpty():
            break
    return wants.select("_of", "_edge", "_left", "_n")


def _taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with ``taken``; ``plan`` has a row per source, whose boundary lot only one row has."""
    nearer = 2 * F.col("_left") >= F.col("size")
    once_more = F.when(F.col("_rest") <= 0, False).when(F.col("_edge").isNull() | (F.col("_lot") < F.col("_edge")), True)
    once_more = once_more.when(F.col("_lot") > F.col("_edge"), False).otherwise(nearer)
    met = rows.join(plan, _same(rows, plan))
    return met.withColumn("taken", F.col("size") * (F.col("_rounds") + once_more.cast("long")))


def draw(rows: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, total: int | None = None, slim: DataFrame | None = None) -> DataFrame:
    """``rows`` (source, size, _lot and any others) with source_size, target and taken.

    ``slim``: a stored table of their source, size and _lot, for the sums, if reading ``rows`` again and again is costly.
    """
    sums = rows if slim is None else slim
    names = [c for c in rows.columns if c != "_lot"] + ["source_size", "target", "taken"]
    aims = targets(sums.groupBy(SOURCE).agg(F.sum("size").alias("source_size")), weights, most, total)
    rounds = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0).cast("long")
    aims = aims.withColumn("_rounds", rounds).withColumn("_rest", F.col("target") - F.col("_rounds") * F.col("source_size"))
    aims = stored(aims.withColumnRenamed(SOURCE, "_of"), "targets")
    edges = _edges(sums, aims.filter("_rest > 0").select("_of", F.col("_rest").alias("_left")))
    plan = aims.join(edges.withColumnRenamed("_of", "_by"), F.col("_of").eqNullSafe(F.col("_by")), "left").drop("_by")
    plan = stored(plan, "plan")
    out = _taken(rows, plan).select(*names)
    tied = plan.filter("_n > 1")
    if tied.isEmpty():
        return out
    # several equal rows at a boundary: told apart by a number they get now
    at_edge = (F.col("_n") > 1) & (F.col("_lot") == F.col("_edge"))
    clear_cut = _taken(rows, plan).filter(~F.coalesce(at_edge, F.lit(False))).select(*names)
    equal = rows.join(tied, _same(rows, tied)).filter(at_edge).select(*rows.columns).withColumn("_lot", F.monotonically_increasing_id())
    equal = stored(equal, "equal-rows")
    number = F.conv(F.substring(F.md5(F.col("_lot").cast("string")), 1, 15), 16, 10).cast("long")
    equal = equal.withColumn("_lot", number)
    finer = _edges(equal, tied.select("_of", "_left")).withColumnRenamed("_of", "_by")
    fine = tied.drop("_edge", "_left", "_n").join(finer, F.col("_of").eqNullSafe(F.col("_by")), "left").drop("_by")
    return clear_cut.union(_taken(equal, fine).select(*names))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, total: int | None = None, id_col: str = ID, text: str = TEXT, source: str = SOURCE) -> DataFrame:
    """``docs`` with size, source_size, target and taken (words that the mix takes of the document, repeats counted)."""
    docs = clear(docs, id_col, text, source, reserved=[*OWN, *({SOURCE} - {source})])
    rows = docs.withColumnRenamed(source, SOURCE).withColumns({"size": words(F.col(text)), "_lot": lot(F.col(id_col), F.col(text))})
    slim = stored(rows.select(SOURCE, "size", "_lot"), "lots")
    return draw(rows, weights, most, total, slim).withColumnRenamed(SOURCE, source)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken."""
    mixed = mix(docs, **options)
    copies = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0).cast("int")
    names = [c for c in mixed.columns if c not in ("size", "source_size", "target", "taken")]
    return mixed.select(*names, F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy")).drop("_copy")


def mix_report(docs: DataFrame) -> DataFrame:
    rows = pick(docs, ID, TEXT, SOURCE)
    rows = stored(rows.select(ID, SOURCE, words(F.col(TEXT)).alias("size"), lot(F.col(ID), F.col(TEXT)).alias("_lot")), "lots")
    return draw(rows).select(ID, "size", "source_size", "target", "taken")
