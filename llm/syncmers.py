"""Document fingerprints of closed syncmers. Anchors stand in order, but likeness doesn't match positions.

A text is read as tokens of up to five non-blank characters, begun anew at each word. In a stretch without blanks of more than
``LONG`` characters (Chinese, long addresses, encoded data) they also begin anew wherever the three characters before have
a hash that says so, one place in four, so that what stands before a passage shifts only its first tokens. A run of k tokens is an anchor if the least
of its inner runs of s tokens stands first or last in it. That depends on the run alone, so equal passages have equal anchors
wherever they stand, and every passage has one within a bounded distance. In front of a text stand k - 1 empty tokens; runs that
reach into them are anchors too, so that short texts have some. The fingerprint lists the anchors' 32-bit codes in order.
Likeness is the Dice coefficient of the distinct codes.

Everything is built-in expressions. The next document is found without a global sort: documents fall into many ranges of
doc_id, and the first of each range also stands behind the last of the range before. An id that very many documents have, and
documents without one, are ranges by a hash of the text. Ids may be any 64-bit integers.

Defined results: a null text counts as empty. An empty text has an empty fingerprint, which is like another empty one (1) and
unlike all others (0). Documents that share an id follow one another by a hash of their texts, those without an id come
last. A single document is its own next. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import ID, TEXT, pick

K, S = 8, 2
ROWS_PER_RANGE, MOST_RANGES, SEGMENTS = 1000, 1 << 16, 512
EMPTY = -1
LONG, ANEW = 20, 4


def _broken(run: Column) -> Column:
    """A run with blanks where tokens begin anew; by characters, since cutting a long string at many places takes squared time."""

    def cut(chars: Column) -> Column:
        anew = lambda i: (i >= 3) & (F.pmod(F.xxhash64(*[F.get(chars, i - j) for j in (3, 2, 1)]), F.lit(ANEW)) == 0)
        return F.array_join(F.transform(chars, lambda c, i: F.when(anew(i), F.concat(F.lit(" "), c)).otherwise(c)), "")

    return F.get(F.transform(F.array(F.split(run, "")), cut), F.lit(0))


def tokens_of(text: Column) -> Column:
    runs = F.transform(F.regexp_extract_all(text, F.lit(r"(\S+)")), lambda r: F.when(F.length(r) > LONG, _broken(r)).otherwise(r))
    broken = F.when(text.rlike(rf"(?<!\S)\S{{{LONG + 1}}}"), F.array_join(runs, " ")).otherwise(text)
    return F.regexp_extract_all(broken, F.lit(r"(\S{1,5})"))


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """Codes (of 32 bits) of a text's anchors, in order."""
    hashes = F.transform(tokens_of(text), lambda t: F.xxhash64(t))
    padded = F.concat(F.array_repeat(F.lit(EMPTY).cast("long"), k - 1), hashes)
    n = F.size(padded)

    def of(tokens: Column, inner: Column) -> Column:
        def is_anchor(i: Column) -> Column:
            first, last = F.get(inner, i), F.get(inner, i + (k - s))
            return (i < k - 1) | (F.array_min(F.slice(inner, i + 1, k - s + 1)) == F.least(first, last))

        starts = F.filter(F.sequence(F.lit(0), F.size(tokens) - k), is_anchor)
        return F.transform(starts, lambda i: F.xxhash64(F.slice(tokens, i + 1, k)).bitwiseAND(F.lit(0xFFFFFFFF)))

    runs = lambda t: F.transform(F.sequence(F.lit(0), F.size(t) - s), lambda i: F.xxhash64(*[F.get(t, i + j) for j in range(s)]))
    # one-element arrays stand for local names: tokens and inner runs are computed once and used by each position
    named = F.transform(F.array(padded), lambda t: F.get(F.transform(F.array(runs(t)), lambda inner: of(t, inner)), F.lit(0)))
    return F.when(n >= k, F.get(named, F.lit(0))).otherwise(F.array().cast("array<bigint>"))


def fingerprint(codes: Column) -> Column:
    return F.array_join(F.transform(codes, lambda c: F.lpad(F.hex(c), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of distinct codes that two fingerprints have in common, from 0 to 1."""
    both, sizes = F.size(F.array_intersect(a, b)), F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return F.when(sizes == 0, 1.0).otherwise(2.0 * both / sizes)


def with_next(docs: DataFrame, order: str, text: str, wanted: list[str]) -> DataFrame:
    """``docs`` with ``next_`` columns: the following row's, in descending order; the last row is followed by the first.

    Rows of one ``order`` value follow by a hash of ``text``, then by the text itself.
    """
    at = F.col(order)
    fractions = [k / SEGMENTS for k in range(1, SEGMENTS)]
    told = docs.agg(F.min(order), F.max(order), F.count("*"), F.count(order), F.percentile_approx(order, fractions, 10_000))
    least, last, n, with_id, cuts = told.first()
    cuts = cuts or []
    # segments by their least value, each with the rows it about has; a value that is several quantiles is one of its own
    segments: dict[int, tuple[int, bool]] = {}
    if last is not None:
        share = -(-with_id // SEGMENTS)
        segments[-(1 << 63)] = (share, False)
        for cut in sorted(set(cuts)):
            times = cuts.count(cut)
            segments[cut] = (share * times, times > 1)
            if times > 1 and cut < (1 << 63) - 1:
                segments.setdefault(cut + 1, (share, False))
    lows = sorted(segments)
    rows_in = [n - with_id, *[segments[low][0] for low in lows]]  # the first one: without an id
    scale = max(1.0, n / ROWS_PER_RANGE / MOST_RANGES)
    steps = [max(1, int(r / ROWS_PER_RANGE / scale)) for r in rows_in]
    before = [sum(steps[:k]) for k in range(len(steps))]
    by_hash = [True, *[segments[low][1] for low in lows]]
    ends = [0.0, *[float(x) for x in [*lows[1:], last or 0]]]
    begins = [0.0, *[float(x) for x in lows]]
    if lows:
        begins[1] = float(least)
    segment = F.coalesce(F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in lows]), lambda x: x <= at)), F.lit(0)) if lows else F.lit(0)
    segment = F.when(at.isNull(), 0).otherwise(segment)
    of = lambda values, kind: F.get(F.array(*[F.lit(v) for v in values]), F.col("_segment")).cast(kind)
    mark = F.xxhash64(text)
    from_top = F.shiftrightunsigned(mark, 11) / float(1 << 53)  # the least mark comes first, in the highest part
    low, high = of(begins, "double"), of(ends, "double")
    share_of = F.when(of(by_hash, "boolean"), 1.0 - from_top).otherwise(F.when(high > low, (at.cast("double") - low) / (high - low)).otherwise(0.0))
    part = F.least(F.greatest(F.floor(share_of * of(steps, "double")), F.lit(0)), of(steps, "long") - 1)
    ranged = docs.withColumn("_segment", segment).withColumn("_mark", F.shiftrightunsigned(mark, 11))
    ranged = ranged.withColumn("_range", of(before, "long") + part).drop("_segment")
    top = F.max(F.struct(F.col(order).alias("id"), (-F.col("_mark")).alias("mark")))
    found = sorted((r[0], r[1].id, r[1].mark) for r in ranged.groupBy("_range").agg(top).collect())  # MOST_RANGES rows, and SEGMENTS, at most
    # the first row of each range is shown once more behind the range above it; the very first behind the lowest
    shown = [(r, i, m, found[(k + 1) % len(found)][0]) for k, (r, i, m) in enumerate(found)]
    tops = docs.sparkSession.createDataFrame(shown, "_at long, _top long, _its long, _behind long")
    first = (F.col("_range") == F.col("_at")) & at.eqNullSafe(F.col("_top")) & (F.col("_mark") == -F.col("_its"))
    joined = ranged.join(F.broadcast(tops), first, "left")
    places = F.filter(F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("ghost")), F.struct(F.col("_behind").alias("r"), F.lit(True).alias("ghost"))), lambda p: p["r"].isNotNull())
    spread = joined.withColumn("_place", F.explode(places)).withColumns({"_range": F.col("_place.r"), "_ghost": F.col("_place.ghost")})
    down = Window.partitionBy("_range").orderBy("_ghost", F.desc_nulls_last(order), "_mark", text)
    led = spread.withColumns({f"next_{c}": F.lead(c).over(down) for c in wanted}).filter("not _ghost")
    return led.select(*docs.columns, *[f"next_{c}" for c in wanted])


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited form: the last third replaced by the beginning of the next document."""
    rows = pick(docs, ID, TEXT).withColumn(TEXT, F.coalesce(F.col(TEXT), F.lit("")))
    rows = rows.withColumn("codes", anchors(F.col(TEXT)))
    near = with_next(rows, ID, TEXT, [TEXT, "codes"])
    near = near.withColumn("n_chars", F.length(TEXT).cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    kept = F.col(TEXT).substr(F.lit(1), F.col("n_chars").cast("int") - third)
    near = near.withColumn("edited", F.concat(kept, F.col(f"next_{TEXT}").substr(F.lit(1), third)))
    near = near.withColumn("edited_codes", anchors(F.col("edited")))
    return near.select(
        ID, "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("codes")).alias("fingerprint"), fingerprint(F.col("edited_codes")).alias("edited_fingerprint"),
        likeness(F.col("codes"), F.col("edited_codes")).alias("near_edited"), likeness(F.col("codes"), F.col("next_codes")).alias("near_next"),
    )
