"""Text expressions. All are built-in column expressions, evaluated inside codegen."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from rostrum import fixed_values as fv

_EDGE_SPACE = r"^[\s\p{Z}]+|[\s\p{Z}]+$"
_REGEX_META = re.compile(r"[\\.^$*+?{}\[\]|()]")


def trim_ws(value: Column) -> Column:
    """Strip every kind of white space; Spark's ``trim`` strips the plain space only."""
    return F.regexp_replace(value, _EDGE_SPACE, "")


def replace_nbsp(value: Column) -> Column:
    return F.replace(value, F.lit("\u00a0"), F.lit(" "))


def contains_ci(value: Column, needle: str) -> Column:
    """Whether a text has a phrase, whatever the case and the form of its characters (wide, ligature, composed or not).

    Texts of ASCII alone need no more than lower case; others are compared by a collation that ignores both.
    """
    by_collation = F.contains(F.collate(value, "UNICODE_CI"), F.collate(F.lit(needle), "UNICODE_CI"))
    return F.when(value.rlike(r"[^\x00-\x7F]"), by_collation).otherwise(F.lower(value).contains(needle.lower()))


def contains_any(value: Column, needles: Sequence[str]) -> Column:
    return reduce(or_, [value.contains(n) for n in needles])


def like_any(value: Column, patterns: Sequence[str]) -> Column:
    return reduce(or_, [value.like(p) for p in patterns])


def extract_or_null(value: Column, pattern: str, group: int = 1, may_be_empty: bool = False) -> Column:
    """First match of a group, NULL when nothing matches.

    ``regexp_extract`` answers ``''`` for no match, so a group that cannot be empty
    needs one regex pass only; ``may_be_empty`` tells the two cases apart by a second.
    """
    found = F.regexp_extract(value, pattern, group)
    if may_be_empty:
        return F.when(value.rlike(pattern), found)
    return F.nullif(found, F.lit(""))


def classify_first_match(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Label of the first rule whose pattern occurs in the text, NULL when none does."""
    label = None
    for pattern, name in rules:
        hit = text.rlike(pattern) if _REGEX_META.search(pattern) else text.contains(pattern)
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return label


def canonicalise(
    value: Column,
    exact: Mapping[str, str],
    trimmed: Mapping[str, str] | None = None,
    prefix: Mapping[str, str] | None = None,
) -> Column:
    """Replace known variants; anything else is returned trimmed."""
    clean = trim_ws(value)
    cases = [(value == k, v) for k, v in exact.items()]
    cases += [(clean == k, v) for k, v in (trimmed or {}).items()]
    cases += [(value.startswith(k), v) for k, v in (prefix or {}).items()]
    return first_case(cases, clean)


def first_case(cases: Sequence[tuple[Column, str]], otherwise: Column) -> Column:
    """The value of the first condition that holds."""
    return reduce(lambda rest, c: F.when(c[0], c[1]).otherwise(rest), reversed(cases), otherwise)


def normalise_role(name: Column, original: Column) -> Column:
    """Presiding officers are recorded by role; everybody else by cleaned name."""
    return (
        F.when(original.contains("Chairman"), "Speaker")
        .when(name.contains("Deputy"), "Deputy Speaker")
        .when(name.contains("Speaker"), "Speaker")
        .otherwise(trim_ws(replace_nbsp(name)))
    )


def asks_a_minister(text: Column) -> Column:
    """The opening words ask, and the opening sentence names an addressee."""
    return contains_any(F.lower(F.left(text, F.lit(20))), fv.ASK_WORDS) & contains_any(
        F.lower(F.left(text, F.lit(100))), fv.ADDRESSEE_WORDS
    )


def stood_in_name(text: Column) -> Column:
    return F.lower(F.left(text, F.lit(100))).contains(fv.STOOD_IN_NAME)


def is_primary_question(section_type: Column, text: Column) -> Column:
    """A typed question that asks a minister, or any text standing in a member's name."""
    asked = section_type.isin(fv.PRIMARY_QUESTION_TYPES) & asks_a_minister(text)
    return F.coalesce(asked | stood_in_name(text), F.lit(False))


def extract_minister_for(text: Column) -> Column:
    """The words that name the addressed office."""
    words = extract_or_null(F.regexp_replace(text, fv.MINISTER_PUNCTUATION, ""), fv.MINISTER_PATTERN)
    prime = text.contains("Prime Minister") & ~text.contains("Deputy Prime Minister")
    return F.when(prime, "Prime Minister").otherwise(words)


def ministry_of(words: Column, ministries: Sequence[str] = fv.MINISTRIES) -> Column:
    return classify_first_match(words, [(m, m) for m in ministries])


def readability(words: Column, sentences: Column, syllables: Column) -> Column:
    """Flesch reading ease; NULL where a denominator is zero."""
    base, per_sentence, per_word = (F.lit(float(x)) for x in fv.FLESCH)
    return base - per_sentence * F.try_divide(words, sentences) - per_word * F.try_divide(syllables, words)


def count_characters(text: Column) -> Column:
    """Alphabetic characters."""
    return F.length(F.regexp_replace(text, r"\P{L}+", "")).cast("bigint")


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\s]+")).cast("bigint")


def count_sentences(text: Column) -> Column:
    """Blocks of text closed by a full stop, question or exclamation mark.

    Counts where a block meets its closing mark, which stays linear on long texts
    without any mark.
    """
    return F.regexp_count(text, F.lit(r"[^.?!][.?!]")).cast("bigint")


def count_syllables(text: Column) -> Column:
    """Groups of vowels: an approximation of spoken syllables."""
    return F.regexp_count(F.lower(text), F.lit(r"[aeiouy]+")).cast("bigint")
