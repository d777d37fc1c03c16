"""Grouped summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum.operators.joins import inner_lookup, left_lookup
from rostrum.sources.tables import kept_aside


def with_all_level(
    df: DataFrame,
    keys: Sequence[str],
    rolled: Sequence[str],
    measures: Mapping[str, Column],
    label: str = "All",
) -> DataFrame:
    """Measures by ``keys`` together with a coarser level where ``rolled`` keys read ``label``.

    One scan and one shuffle: both levels are grouping sets of the same pass. Rolled
    keys come out as strings.
    """
    kept = [k for k in keys if k not in rolled]
    marked = {f"__g_{k}": F.grouping(k) for k in rolled}
    grouped = df.groupingSets(
        [[F.col(k) for k in keys], [F.col(k) for k in kept]], *[F.col(k) for k in keys]
    ).agg(*[m.alias(n) for n, m in (dict(measures) | marked).items()])
    shown = [
        F.when(F.col(f"__g_{k}") == 1, F.lit(label)).otherwise(F.col(k).cast("string")).alias(k)
        if k in rolled
        else F.col(k)
        for k in keys
    ]
    return grouped.select(*shown, *measures)


def nested_history(df: DataFrame, keys: Sequence[str], fields: Sequence[str], name: str) -> DataFrame:
    """One row per key with an ordered array of structs, sorted by the fields from the left.

    The array is the result, so the rows per key must be bounded by their meaning
    (positions of a person, years of a history).
    """
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))


_POINTS = {"q1": 0.25, "median": 0.5, "q3": 0.75}
_SKETCH_ACCURACY = 10_000
_MARGIN = 2.0 / _SKETCH_ACCURACY
_PIECES = 200  # a slice that is still broad is cut by so many of its own quantiles
SMALL = 10_000  # most rows of a slice that are put in order in one row


def _located(rows: DataFrame, slices: DataFrame, keys: Sequence[str], edges: Sequence[float]) -> DataFrame:
    """Cut each slice at approximate quantiles of its own rows, and count how many rows lie in which piece.

    Pieces are the cut points themselves and the open stretches between them, so a value that very many rows have is soon a
    piece of its own. ``slices``: keys, __no and the bounds __lo, __hi; the result has the pieces' number, rows and bounds.
    """
    by = [*keys, "__no"]
    inside = inner_lookup(rows, slices, keys, null_safe=keys).filter(F.col("__v").between(F.col("__lo"), F.col("__hi"))).select(*by, "__v")
    cuts = inside.groupBy(*by).agg(F.percentile_approx("__v", [float(e) for e in edges], _SKETCH_ACCURACY).alias("__cuts"))
    below = F.size(F.filter("__cuts", lambda c: c < F.col("__v")))
    piece = (2 * below + F.array_contains("__cuts", F.col("__v")).cast("int")).alias("__piece")
    pieces = left_lookup(inside, cuts, by, null_safe=keys).select(*by, piece, "__v")
    return pieces.groupBy(*by, "__piece").agg(F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))


def _narrowed(wanted: DataFrame, pieces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``wanted`` ranks with the piece of their slice that each lies in: its bounds, rows and the rows before it."""
    by = [*keys, "__no"]
    running = Window.partitionBy(*by).orderBy("__piece")  # over a few hundred pieces at most
    placed = pieces.withColumn("__below", F.sum("__n").over(running) - F.col("__n"))
    rest = F.col("__rank") - F.col("__before")
    met = left_lookup(wanted.drop("__lo", "__hi", "__n"), placed, by, null_safe=keys)
    met = met.filter((rest >= F.col("__below")) & (rest < F.col("__below") + F.col("__n")))
    return met.withColumns({"__before": F.col("__before") + F.col("__below"), "__no": F.xxhash64("__lo", "__hi")}).drop("__below", "__piece")


def quartiles(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Exact count, min, quartiles (linearly interpolated) and max of a value per group.

    An exact percentile over a hot group would hold the group in one task. Here a mergeable sketch cuts each group into pieces
    that tightly enclose the quartiles, and counts tell in which piece a rank lies. While such a piece has more than ``SMALL``
    rows of different values, it is cut again by a sketch of its own. Only the last, small pieces are put in order. The cut
    points change the cost, never the result. Each round is one small table (a few rows per group), whose size decides on the next.
    """
    keys = list(keys)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    whole = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__total"), F.min("__v").alias("__min"), F.max("__v").alias("__max"),
        F.percentile_approx("__v", sorted(p + d for p in _POINTS.values() for d in (-_MARGIN, _MARGIN)), _SKETCH_ACCURACY).alias("__cuts"),
    )
    below = F.size(F.filter("__cuts", lambda c: c < F.col("__v")))
    piece = (2 * below + F.array_contains("__cuts", F.col("__v")).cast("int")).alias("__piece")
    cut = left_lookup(rows, whole, keys, null_safe=keys).select(*keys, F.lit(0).cast("bigint").alias("__no"), piece, "__v", "__total", "__min", "__max")
    pieces = cut.groupBy(*keys, "__no", "__piece").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"),
        *[F.first(c).alias(c) for c in ("__total", "__min", "__max")],
    )
    places = []
    for name, p in _POINTS.items():
        exact = p * (F.col("__total") - 1)
        for step in (0, 1):
            part = exact - F.floor(exact)
            places.append(
                F.struct(
                    F.lit(name).alias("__q"), F.least(F.floor(exact) + step, F.col("__total") - 1).alias("__rank"),
                    (part if step else 1 - part).alias("__weight"),
                )
            )
    running = Window.partitionBy(*keys).orderBy("__piece")  # over thirteen pieces at most
    placed = pieces.withColumn("__before", F.sum("__n").over(running) - F.col("__n")).drop("__piece")
    wanted = placed.select("*", F.inline(F.array(*places)))
    wanted = wanted.filter((F.col("__rank") >= F.col("__before")) & (F.col("__rank") < F.col("__before") + F.col("__n")))
    wanted = kept_aside(wanted.withColumn("__no", F.xxhash64("__lo", "__hi")))
    broad = (F.col("__n") > SMALL) & (F.col("__lo") < F.col("__hi"))
    while not wanted.filter(broad).isEmpty():
        slices = wanted.filter(broad).select(*keys, "__no", "__lo", "__hi").distinct()
        finer = _located(rows, slices, keys, [k / _PIECES for k in range(1, _PIECES)])
        wanted = kept_aside(wanted.filter(~broad).unionByName(_narrowed(wanted.filter(broad), finer, keys)))
    slices = wanted.filter("__lo < __hi").select(*keys, "__no", "__lo", "__hi").distinct()
    inside = inner_lookup(rows, slices, keys, null_safe=keys).filter(F.col("__v").between(F.col("__lo"), F.col("__hi")))
    ordered = inside.groupBy(*keys, "__no").agg(F.sort_array(F.collect_list("__v")).alias("__ordered"))  # SMALL at most
    found = F.when(F.col("__lo") == F.col("__hi"), F.col("__lo")).otherwise(F.get("__ordered", (F.col("__rank") - F.col("__before")).cast("int")))
    chosen = left_lookup(wanted, ordered, [*keys, "__no"], null_safe=keys).withColumn("__found", found * F.col("__weight"))
    return chosen.groupBy(*keys).agg(
        F.max("__total").alias("n"),
        F.max("__min").alias("min"),
        *[F.sum(F.when(F.col("__q") == q, F.col("__found"))).alias(q) for q in _POINTS],
        F.max("__max").alias("max"),
    )
