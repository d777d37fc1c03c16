"""Personal data and secrets in texts: fixed patterns, and spans that weakly supervised labelers agree on.

Base spans (email, ip, card, phone) come from their patterns, leftmost and non-overlapping per kind. The patterns below match
what the plain forms match, but start at the beginning of a run only and never give back, so long runs take linear time.

Further spans of kind ``secret`` come from candidates (runs with letters and digits outside base spans). Three labelers vote on
each: a pattern of known forms, a gazetteer of cue words in or before it, and its context (an assignment or quotes around it).
Expectation-maximisation over the counts of vote patterns, of which there are eight, estimates how reliable each labeler is.
The posterior of each candidate then trains the span classifier: naive Bayes over votes and shape. Counts cover all documents;
only the eight and the few dozen feature sums reach the driver. Everything on executors is built-in expressions.

Defined results: a null text counts as empty and has no spans. Without candidates, or when none gets a vote, no secret is added. Offsets are code
points, ends exclusive. Spans of different kinds may overlap; redaction merges them, named by the one that starts first. Rows
stay one to one; other columns are kept, those named like the results are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import ID, TEXT, clear, pick

KINDS = ["email", "ip", "card", "phone", "secret"]  # fixed: order among spans that start together
_LOCAL, _RUN = "A-Za-z0-9._%+-", "A-Za-z0-9+/_=.-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "secret": rf"(?:(?<![{_RUN}])|\G)(?=[A-Za-z+/_=.-]*+[0-9])[{_RUN}]{{8,}}+",
}
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
KNOWN_FORMS = r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk[-_][A-Za-z0-9_-]{20,}|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$|(?i:passw(?:or)?d|pwd|secret|token|api_?key)=."
CUES = r"(?i)passw(?:or)?d|passphrase|pwd|secret|token|api.?key|access.?key|akia|credential|bearer|login|auth"
LEFT = 24  # code points before a candidate that the gazetteer looks at
VOTES = ["form", "cue", "place"]

MATCHES = 512
_NONE = "cast(array() as array<struct<start:bigint,end:bigint,word:string>>)"
_NO_BLOCKS = "cast(array() as array<array<struct<start:bigint,end:bigint,word:string>>>)"


def located(text: str, pattern: str) -> Column:
    """Matches of a pattern with their places: the lengths of what stands between matches add up to them.

    Appending copies an array, so matches are gathered in blocks of ``MATCHES``, and blocks are put together at the end.
    """
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    pieces = f"arrays_zip(split({text}, '{quoted}', -1), regexp_extract_all({text}, '{quoted}', 0))"
    span = "named_struct('start', a.at + char_length(x.`0`), 'end', a.at + char_length(x.`0`) + char_length(x.`1`), 'word', x.`1`)"
    step = f"named_struct('at', a.at + char_length(x.`0`) + char_length(x.`1`), 'out', array_append(a.out, {span}))"
    inner = f"aggregate(block, named_struct('at', b.at, 'out', {_NONE}), (a, x) -> if(x.`1` is null, a, {step}))"
    # one-element arrays stand for local names
    more = f"get(transform(array({inner}), r -> named_struct('at', r.at, 'out', array_append(b.out, r.out))), 0)"
    blocks = f"transform(sequence(0, (size(p) - 1) div {MATCHES}), i -> slice(p, cast(i * {MATCHES} + 1 as int), {MATCHES}))"
    whole = f"flatten(aggregate({blocks}, named_struct('at', 0L, 'out', {_NO_BLOCKS}), (b, block) -> {more}, b -> b.out))"
    return F.expr(f"get(transform(array({pieces}), p -> {whole}), 0)")


def _digits(word: Column) -> Column:
    return F.regexp_replace(word, "[^0-9]", "")


def _holds(kind: str, word: Column) -> Column:
    n = F.length(_digits(word))
    if kind == "ip":
        return word.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return n.between(12, 19) & F.call_function("luhn_check", _digits(word))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _held(kind: str) -> Column:
    return F.filter(located("_text", PATTERNS[kind]), lambda s: _holds(kind, s["word"]))


OWN = ["_text", "_digit", "_base", "_runs", *[f"_{k}" for k in KINDS]]
_MARK = {"email": "@", "ip": ".", "card": "", "phone": "+"}


def base_spans(docs: DataFrame, text: str = TEXT) -> DataFrame:
    """``docs`` with ``_text`` (never null) and an array of spans for each base kind, ``_email`` to ``_phone``."""
    docs = clear(docs, text, reserved=OWN).withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    docs = docs.withColumn("_digit", F.col("_text").rlike("[0-9]"))
    columns = {}
    for kind in KINDS[:4]:
        worth = F.col("_text").contains(_MARK[kind]) if kind == "email" else F.col("_digit") & F.col("_text").contains(_MARK[kind])
        columns[f"_{kind}"] = F.when(worth, _held(kind)).otherwise(F.expr(_NONE))
    return docs.withColumns(columns)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def candidates(based: DataFrame) -> DataFrame:
    """With ``_secret``: candidates outside base spans, their votes and shape."""
    base = F.concat(*[F.col(f"_{k}") for k in KINDS[:4]])
    runs = F.when(F.col("_digit"), located("_text", PATTERNS["secret"])).otherwise(F.expr(_NONE))
    letters = F.filter(runs, lambda s: s["word"].rlike("[A-Za-z]"))
    based = based.withColumns({"_base": base, "_runs": letters})
    free = F.filter("_runs", lambda s: ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))

    def described(s: Column) -> Column:
        word = s["word"]
        before = F.col("_text").substr(F.greatest(s["start"] - LEFT + 1, F.lit(1)).cast("int"), F.least(s["start"], F.lit(LEFT)).cast("int"))
        after = F.col("_text").substr((s["end"] + 1).cast("int"), F.lit(1))
        n, digits = F.length(word), F.length(_digits(word))
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            _flag(word.rlike(KNOWN_FORMS)).alias("form"),
            _flag(F.concat(before, word).rlike(CUES)).alias("cue"),
            _flag(word.contains("=") | before.rlike("[=:]\\s*[\"']?$") | (before.rlike("[\"']$") & after.rlike("[\"']"))).alias("place"),
            F.least(F.floor(n / 8), F.lit(6)).cast("int").alias("length"),
            F.least(F.floor(digits * 5 / n), F.lit(4)).cast("int").alias("digits"),
            F.when(word.rlike("^[0-9a-f]+$"), 1).when(word.rlike("^[0-9A-Z]+$"), 2).when(word.rlike("^[A-Za-z0-9]+$"), 3).otherwise(4).alias("letters"),
        )

    return based.withColumn("_secret", F.transform(free, described))


SHAPE = ["length", "digits", "letters"]


@dataclass
class SpanModel:
    """Log odds of a secret: at the outset, and of each value of each feature."""

    prior: float
    odds: dict[str, dict[int, float]]
    reliability: dict[str, tuple[float, float]]


def agree(counts: dict[tuple[int, ...], int], rounds: int = 100) -> tuple[float, list[tuple[float, float]], dict[tuple[int, ...], float]]:
    """Expectation-maximisation for two classes: share of positives, rates of votes among positives and negatives, posteriors."""
    total, share, rates = sum(counts.values()), 0.2, [(0.8, 0.1)] * len(VOTES)
    posterior: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        for votes in counts:
            yes, no = share, 1 - share
            for vote, (p, q) in zip(votes, rates, strict=True):
                yes *= p if vote else 1 - p
                no *= q if vote else 1 - q
            posterior[votes] = yes / (yes + no)
        positive = sum(posterior[v] * n for v, n in counts.items())
        share = min(max(positive / total, 1e-6), 1 - 1e-6)
        rates = []
        for k in range(len(VOTES)):
            among = sum(posterior[v] * n for v, n in counts.items() if v[k])
            rest = sum((1 - posterior[v]) * n for v, n in counts.items() if v[k])
            rates.append(((among + 1) / (positive + 2), (rest + 1) / (total - positive + 2)))
    return share, rates, posterior


def fit(docs: DataFrame, text: str = TEXT) -> SpanModel | None:
    """Learn from all candidates of all documents; None if there is nothing to learn from."""
    found = candidates(base_spans(pick(docs, text=text))).select(F.inline("_secret"))
    table = found.groupBy(*VOTES, *SHAPE).count().collect()  # 8 vote patterns times 140 shapes at most
    counts: dict[tuple[int, ...], int] = {}
    for r in table:
        key = tuple(r[v] for v in VOTES)
        counts[key] = counts.get(key, 0) + r["count"]
    if not any(any(v) for v in counts):
        return None
    share, rates, posterior = agree(counts)
    odds: dict[str, dict[int, float]] = {}
    for name in [*VOTES, *SHAPE]:
        sums: dict[int, list[float]] = {}
        for r in table:
            p = posterior[tuple(r[v] for v in VOTES)]
            held = sums.setdefault(r[name], [1.0, 1.0])
            held[0] += p * r["count"]
            held[1] += (1 - p) * r["count"]
        yes, no = (sum(h[k] for h in sums.values()) for k in (0, 1))
        odds[name] = {value: math.log(h[0] / yes) - math.log(h[1] / no) for value, h in sums.items()}
    return SpanModel(math.log(share / (1 - share)), odds, dict(zip(VOTES, rates, strict=True)))


def find_spans(docs: DataFrame, model: SpanModel | None, text: str = TEXT) -> DataFrame:
    """``docs`` with ``pii``: an array of kind, start, end, in order of start, then of kind."""
    found = candidates(base_spans(docs, text))

    def accepted(s: Column) -> Column:
        log_odds = F.lit(model.prior)
        for name, values in model.odds.items():
            log_odds = log_odds + reduce(lambda c, v: c.when(s[name] == v[0], F.lit(v[1])), values.items(), F.when(F.lit(False), F.lit(0.0))).otherwise(0.0)
        return log_odds > 0

    if model is None:
        found = found.withColumn("_secret", F.filter("_secret", lambda s: F.lit(False)))
    else:
        found = found.withColumn("_secret", F.filter("_secret", accepted))
    ordered = lambda k: F.transform(f"_{KINDS[k]}", lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("rank"), s["end"].alias("end")))
    names = F.array(*[F.lit(k) for k in KINDS])
    all_spans = F.array_sort(F.concat(*[ordered(k) for k in range(len(KINDS))]))
    named = F.transform(all_spans, lambda s: F.struct(F.get(names, s["rank"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return found.withColumn("pii", named).drop(*OWN)


def redact(found: DataFrame, text: str = TEXT) -> DataFrame:
    """The text with each span replaced by its kind in angle brackets."""
    taken = F.aggregate(
        "pii", F.expr("named_struct('at', 0L, 'out', '')"),
        lambda a, s: F.when(s["start"] < a["at"], F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.concat(a["out"], F.col(text).substr((a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit("<"), s["kind"], F.lit(">")).alias("out"),
            )
        ),
        lambda a: F.concat(a["out"], F.col(text).substr((a["at"] + 1).cast("int"), F.length(text))),
    )
    return found.withColumn(text, F.when(F.size("pii") > 0, taken).otherwise(F.col(text)))


def span_report(docs: DataFrame) -> DataFrame:
    """Counts per base kind, a digest of base spans, all spans, and how many secrets and spans there are, per document."""
    docs = pick(docs, ID, TEXT)
    found = find_spans(docs, fit(docs)).select(ID, "pii")
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("pii", lambda s: s["kind"] != "secret")
    return found.select(ID, *[count(k) for k in KINDS[:4]], F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("pii")).alias("spans"), count("secret"), F.size("pii").cast("long").alias("n_spans"))
