"""Quotation linking: whom a message answers, told by the passages it quotes.

Lines that begin with ``>`` are quoted, at the level of how many such marks stand before them. Consecutive quoted lines of one
level are a passage. Passages are normalised (marks off, lower case, white space made one blank) and hashed as a whole, by
paragraph and by line. Every message's own text is hashed likewise: as a whole, by paragraph and by line. A passage belongs to the earliest
message of the conversation that has its hash, if that is an earlier one; the whole counts before paragraphs, and these before lines. A message's parent is the original of
its first passage of the least level that has one. Following parents leads to the message that began the exchange. In reply
order, exchanges stand by the turn that began them, and messages within one by their own turn.

Originals are reduced to one row per conversation and hash before the join, so frequent lines give no pairs of messages, and
no conversation is collected. Everything is built-in expressions.

Defined results: a null text is empty and quotes nothing. A message without a linked quote begins an exchange. A quote of what
nobody said before, or of a passage without letters or digits, links nothing. Messages without a conversation or turn link nothing. Messages that share conversation and turn
are one for links: their parents are the earliest found. Rows stay one to one; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import pick, stored

_MARKS = r"^\s*+(?:>\s?+)++"  # possessive: a long row of marks takes no stack
_LINES = "array<struct<level:int,body:string>>"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def parsed(messages: DataFrame, text: str) -> DataFrame:
    """With ``own`` (the text without quoted lines) and ``passages``: level and quoted lines, in order."""
    lines = F.transform(
        F.split(F.coalesce(F.col(text), F.lit("")), r"\r?\n"),
        lambda x: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(x, _MARKS, 0), r"[^>]", "")).alias("level"),
            F.regexp_replace(x, _MARKS, "").alias("body"),
        ),
    )
    messages = messages.withColumn("_lines", lines)
    own = F.transform(F.filter("_lines", lambda x: x["level"] == 0), lambda x: x["body"])
    # a passage starts where the level changes; it is cut out between this start and the next
    places = F.sequence(F.lit(0), F.size("_lines") - 1)
    level = lambda i: F.coalesce(F.get("_lines", i)["level"], F.lit(0))
    starts = F.filter(places, lambda i: (i == 0) | (level(i) != level(i - 1)))
    messages = messages.withColumns({"own": F.trim(F.array_join(own, "\n")), "_starts": starts})
    ends = F.concat(F.slice("_starts", 2, F.greatest(F.size("_starts"), F.lit(1))), F.array(F.size("_lines")))
    runs = F.zip_with("_starts", ends, lambda a, b: F.struct(level(a).alias("level"), F.transform(F.slice("_lines", a + 1, b - a), lambda x: x["body"]).alias("lines")))
    messages = messages.withColumn("passages", F.filter(runs, lambda r: r["level"] > 0))
    return messages.drop("_lines", "_starts")


def _hashes(texts: Column) -> Column:
    """Hashes of the normalised texts that have a letter or digit."""
    said = F.filter(F.transform(texts, normalised), lambda t: t.rlike(r"[\p{L}\p{N}]"))
    return F.transform(said, lambda t: F.xxhash64(t))


def link_quotes(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per message: conv_id, turn, role, text without quotes, n_quotes, parent_turn, root_turn, depth."""
    rows = parsed(pick(messages, conv_id=conv, turn=turn, role=role, text=text), "text")
    units = F.concat(F.array("own"), F.split("own", r"\n\s*\n"), F.split("own", r"\n"))
    said = rows.select("conv_id", F.col("turn").alias("said"), F.explode(F.array_distinct(_hashes(units))).alias("hash"))
    first = said.filter("conv_id is not null and said is not null").groupBy("conv_id", "hash").agg(F.min("said").alias("said"))

    passages = rows.filter(F.size("passages") > 0).select("conv_id", "turn", F.posexplode("passages").alias("at", "passage"))
    whole = _hashes(F.array(F.array_join("passage.lines", "\n")))
    paragraphs = _hashes(F.split(F.array_join("passage.lines", "\n"), r"\n\s*\n"))
    of_kind = lambda k, hashes: F.transform(hashes, lambda h: F.struct(F.lit(k).alias("kind"), h.alias("hash")))
    kinds = F.concat(of_kind(0, whole), of_kind(1, paragraphs), of_kind(2, _hashes(F.col("passage.lines"))))
    quoted = passages.select("conv_id", "turn", "at", F.col("passage.level").alias("level"), F.explode(kinds).alias("q")).select("conv_id", "turn", "at", "level", "q.*")
    met = quoted.join(first, ["conv_id", "hash"]).filter("said < turn")
    best = F.min_by("said", F.struct("level", "at", "kind", "said"))
    parents = stored(met.groupBy("conv_id", "turn").agg(best.alias("parent_turn")), "parents")

    # Follow parents by doubling the distance: after k rounds 2^k steps are done.
    roots = parents.select("conv_id", "turn", F.col("parent_turn").alias("root_turn"), F.lit(1).cast("long").alias("depth"))
    while True:
        beyond = roots.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("_next"), F.col("depth").alias("_more"))
        step = roots.join(beyond, ["conv_id", "root_turn"], "left")
        step = step.select("conv_id", "turn", F.coalesce("_next", "root_turn").alias("root_turn"), (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"), F.col("_next").isNotNull().alias("_moved"))
        step = stored(step, "roots")
        roots = step.drop("_moved")
        if step.filter("_moved").isEmpty():
            break
    linked = rows.join(parents, ["conv_id", "turn"], "left").join(roots, ["conv_id", "turn"], "left")
    return linked.select(
        "conv_id", "turn", "role", F.col("own").alias("text"), F.size("passages").cast("long").alias("n_quotes"), "parent_turn",
        F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    )


def in_reply_order(linked: DataFrame) -> DataFrame:
    """Sorted for writing: a long conversation may span several ranges."""
    return linked.repartitionByRange("conv_id", "root_turn", "turn").sortWithinPartitions("conv_id", "root_turn", "turn")


def chat_format(linked: DataFrame) -> DataFrame:
    """With ``message``: the text between role marks."""
    role = F.coalesce("role", F.lit("user"))
    return linked.withColumn("message", F.concat(F.lit("<|"), role, F.lit("|>\n"), "text", F.lit("\n<|end|>")))


def conversation_report(messages: DataFrame) -> DataFrame:
    return in_reply_order(chat_format(link_quotes(messages)))
