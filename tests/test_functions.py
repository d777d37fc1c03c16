import pytest
from pyspark.sql import functions as F

from rostrum.functions import numeric as nm
from rostrum.functions import text as tx


@pytest.fixture
def value(spark):
    def evaluate(column, **named):
        df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in named.items()]) if named else spark.range(1)
        return df.select(column.alias("x")).first()["x"]

    return evaluate


def test_trim_strips_every_space(value):
    assert value(tx.trim_ws(F.lit(" \t Law Bill \t\n"))) == "Law Bill"


def test_nbsp_is_replaced(value):
    assert value(tx.replace_nbsp(F.lit("a b"))) == "a b"


def test_no_match_is_null(value):
    assert value(tx.extract_or_null(F.lit("abc"), r"(\d+)")) is None
    assert value(tx.extract_or_null(F.lit("p="), r"p=(\d*)", may_be_empty=True)) == ""
    assert value(tx.extract_or_null(F.lit("q"), r"p=(\d*)", may_be_empty=True)) is None


def test_contains_ignores_case(value):
    assert value(tx.contains_ci(F.lit("A Vernacular Speech."), "vernacular speech"))


@pytest.mark.parametrize(
    "kind, said, expected",
    [
        ("OA", "Mr A asked the Minister for Law whether", True),
        ("OA", "Mr A thanked the Minister for Law", False),
        ("WANA", "To ask the Parliamentary Secretary when", True),
        ("OS", "Mr A asked the Minister for Law whether", False),
        ("OS", "The following question stood in the name of Mr A", True),
        (None, "The following question stood in the name of Mr A", True),
        (None, "Mr A asked the Minister for Law", False),
        ("OA", None, False),
    ],
)
def test_primary_question(value, kind, said, expected):
    column = tx.is_primary_question(F.lit(kind).cast("string"), F.lit(said).cast("string"))
    assert value(column) is expected


@pytest.mark.parametrize(
    "said, words",
    [
        ("asked the Prime Minister whether", "Prime Minister"),
        ("asked the Deputy Prime Minister", None),
        ("asked the Minister for Culture, Community and Youth (a) how", "Culture Community and Youth a how"),
        ("asked the Minister for Law", "Law"),
        ("no office", None),
    ],
)
def test_addressed_office(value, said, words):
    assert value(tx.extract_minister_for(F.lit(said))) == words


def test_first_rule_wins(value):
    assert value(tx.ministry_of(F.lit("Health and Education"))) == "Education"
    assert value(tx.ministry_of(F.lit("Gardens"))) is None


@pytest.mark.parametrize(
    "name, original, role",
    [
        ("Mr X", "The Chairman", "Speaker"), ("Mr Deputy Speaker", "x", "Deputy Speaker"), ("Mdm Speaker", "x", "Speaker"),
        (" Ann Lee ", "x", "Ann Lee"), ("Mr Y", None, "Mr Y"),
    ],
)
def test_roles(value, name, original, role):
    assert value(tx.normalise_role(F.lit(name), F.lit(original).cast("string"))) == role


def test_canonical_titles(value):
    def clean(title):
        return value(tx.canonicalise(F.lit(title), {"A Bil": "A Bill"}, {"B BIll": "B Bill"}, {"C (FY2023)": "C (FY 2023)"}))

    assert [clean(t) for t in ("A Bil", "A Bil ", "B BIll \t", "C (FY2023) more", " D ")] == [
        "A Bill", "A Bil", "B Bill", "C (FY 2023)", "D",
    ]


def test_counts_of_text(value):
    said = F.lit("Why so? Yes! No end... Ok")
    assert [value(f(said)) for f in (tx.count_words, tx.count_sentences, tx.count_characters, tx.count_syllables)] == [6, 3, 15, 6]


def test_readability_without_sentences_is_null(value):
    assert value(tx.readability(F.lit(10), F.lit(0), F.lit(12))) is None
    assert value(tx.readability(F.lit(10), F.lit(2), F.lit(15))) == pytest.approx(206.835 - 1.015 * 5 - 84.6 * 1.5)


def test_ratios(value):
    null = F.lit(None).cast("bigint")
    assert value(nm.guarded_ratio(F.lit(3), F.lit(0), 2)) == 0
    assert value(nm.guarded_ratio(F.lit(1), F.lit(3), 2)) == 0.33
    assert value(nm.guarded_ratio(F.lit(3), null, 2)) is None
    assert value(nm.percent(F.lit(1), F.lit(3))) == 33.3
    assert value(nm.percent(F.lit(1), F.lit(0))) is None
    assert [value(nm.round_to_long(F.lit(x))) for x in (2.5, 3.5, -2.5)] == [3, 4, -3]
    assert value(nm.zero_unless(null != 0, F.lit(5))) == 0


def test_search_ignores_case_and_the_form_of_characters(spark):
    wide = "".join(chr(ord(c) + 0xFEE0) if c != " " else c for c in "VERNACULAR speech")
    said = ["VERNACULAR Speech", wide, "\u00e9 vernacular x", "a Caf\u00c9 b", "a cafe\u0301 b", "a cafe b", "of\ufb01ce \u00e9", "\ufb01", None, ""]
    df = spark.createDataFrame(list(enumerate(said)), "i int, t string")
    found = lambda needle: [r.i for r in df.filter(tx.contains_ci(df["t"], needle)).orderBy("i").collect()]
    assert found("vernacular SPEECH") == [0, 1]
    assert found("café") == found("CAFÉ") == [3, 4]
    assert found("cafe ") == [5]
    assert found("office") == [6]
