"""Each stage against a plain version on its own input, then all of them in a row."""

import hashlib
import re
import struct

import pytest
from pyspark.sql import functions as F
from test_decontaminate import brute as contamination
from test_ngram_join import brute as classes
from test_pii import brute as base_spans
from tokenizers import Tokenizer as Library

import corpus_pipeline as pipeline
from llm import language
from llm.common import read
from llm.queries import VOCABULARY

FOLDER = "/root/testdata/sf0.001"
STAGE = dict(pipeline.STAGES)


@pytest.fixture(scope="module")
def raw(spark):
    return read(spark, FOLDER, "documents")


def test_language_keeps_what_it_knows(spark, raw):
    odd = spark.createDataFrame([(9001, None), (9002, "123 .."), (9003, ""), (9004, "the and of"), (9005, "\u65e5\u672c")], "doc_id long, text string")
    docs = raw.unionByName(odd, allowMissingColumns=True)
    model = language.fit(docs)
    want = {r.doc_id for r in docs.collect() if (p := model.predict(r.text))[0] != "und" and p[1] > 0.2501}
    got = pipeline.identify_language(spark, docs, FOLDER)
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} == want and want >= {r.doc_id for r in raw.collect()} and 9004 in want


def test_foreign_and_junk_documents_go_and_short_ones_stay(spark, raw):
    polish = "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa"
    italian = "tutti gli esseri umani nascono liberi ed eguali in dignità e diritti essi sono dotati di ragione e di coscienza e devono agire gli uni verso gli altri in spirito di fratellanza"
    junk = " ".join("qzx vwk jjq xkcd zzq pqw vbn mxz qqk hjk wwx".split() * 3)
    bad = [(9001, polish, None), (9002, italian, None), (9003, junk, None), (9004, polish[::-1], "en"), (9005, "asdfkjhqweoiruzxcvmnb" * 10, "de")]
    clean = [r for r in raw.collect() if len(r.text.split()) > 8]
    short = [(9100 + k, " ".join(r.text.split()[:size]), None) for k, (r, size) in enumerate(zip(clean, [3, 5, 8] * 100, strict=False))]
    odd = spark.createDataFrame(bad + short, "doc_id long, text string, lang string")
    got = {r.doc_id for r in pipeline.identify_language(spark, raw.unionByName(odd, allowMissingColumns=True), FOLDER).collect()}
    assert not got & {i for i, _, _ in bad}
    assert got >= {r.doc_id for r in raw.collect()} | {i for i, t, _ in short if any(c.isalpha() for c in t)}


def test_one_document_of_each_class_stays(spark, raw):
    odd = spark.createDataFrame([(9001, None), (9002, " "), (9002, " "), (9003, "a b c d e f"), (9003, "a b c d e f"), (None, "a b c d e f")], "doc_id long, text string")
    docs = raw.select("doc_id", "text").union(odd)
    rows = docs.collect()
    found = classes([r.doc_id for r in rows], [r.text for r in rows], 5, 80)
    want = {least for _, n, least in found if n}
    got = pipeline.drop_near_duplicates(spark, docs, FOLDER).collect()
    assert sorted(r.doc_id for r in got if r.text and r.text.strip()) == sorted(want)
    assert sorted(r.doc_id for r in got if not (r.text and r.text.strip())) == [9001, 9002, 9002]


def test_contaminated_documents_go(spark, raw):
    items = [(r.item_id, r.text) for r in read(spark, FOLDER, "benchmark").collect()]
    short = [r for r in raw.collect() if len(r.text) < 1500]
    planted = [(9001, "see: " + items[0][1].upper()), (9002, " ".join(items[1][1].split()[:9])), (9003, None)]
    docs = spark.createDataFrame([(r.doc_id, r.text) for r in short] + planted, "doc_id long, text string")
    want = {i for i, t in [(r.doc_id, r.text) for r in short] + planted if not contamination(t, items)[4]}
    got = {r.doc_id for r in pipeline.decontaminated(spark, docs, FOLDER).collect()}
    assert got == want and 9001 not in got and {9002, 9003} <= got


def test_personal_data_is_gone_and_the_rest_is_left(spark, raw):
    before = {r.doc_id: r for r in raw.collect()}
    got = pipeline.redacted(spark, raw, FOLDER).collect()
    assert len(got) == len(before)
    for r in got:
        old = before[r.doc_id]
        assert base_spans(r.text) == "" and r.n_chars == (len(r.text) if r.text != old.text else old.n_chars)
        if not base_spans(old.text) and not re.search(r"[0-9]", old.text):
            assert r.text == old.text


def test_token_ids(spark, raw):
    library = Library.from_file(VOCABULARY)
    got = {r.doc_id: r for r in pipeline.encoded(spark, raw, FOLDER).collect()}
    for r in raw.limit(50).collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert bytes(got[r.doc_id].token_ids) == struct.pack(f"<{len(ids)}I", *ids) and got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_all_stages_in_a_row_and_clashing_columns(spark, docs):
    frame = docs("the and of the and of", None, "le la de le la", ids=[1, 2, 3]).withColumn("lang", F.lit("en")).withColumn("score", F.lit(1))
    empty = frame.limit(0)
    for _, stage in pipeline.STAGES:
        frame, empty = stage(spark, frame, FOLDER), stage(spark, empty, FOLDER)
        assert empty.collect() == []
        assert len({c.lower() for c in frame.columns}) == len(frame.columns)
    assert {r.doc_id for r in frame.collect()} == {1, 3} and "TEXT_1" in frame.columns
    assert [name for name, _ in pipeline.STAGES] == ["language identification", "n-gram Jaccard join", "benchmark decontamination", "PII", "BPE encoding and decoding"]


def test_run(spark):
    got = pipeline.run(spark, FOLDER)
    assert 0 < got.count() <= read(spark, FOLDER, "documents").count() and "text" not in got.columns
