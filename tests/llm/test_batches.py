"""How many whole texts a task holds at a time."""

import pandas as pd

from llm import ngram_join
from llm.common import stored


def test_stored_bounds_batches_and_leaves_the_session_as_it_was(spark):
    def lengths(frames):
        for frame in frames:
            yield pd.DataFrame({"n": [len(frame)]})

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    sizes = stored(spark.range(0, 1000, 1, 1).mapInPandas(lengths, "n long"), "sizes", 7)
    assert [r.n for r in sizes.agg({"n": "max"}).toDF("n").collect()] == [7] and sizes.agg({"n": "sum"}).first()[0] == 1000
    assert spark.conf.get(key) == before


def test_ngram_join_reads_texts_in_bounded_batches(spark, monkeypatch):
    asked, plain = {}, stored
    monkeypatch.setattr(ngram_join, "stored", lambda df, name, batch=None: asked.update({name: batch}) or plain(df, name, batch))
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, f"{text} x"), (3, None)], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in ngram_join.class_report(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3}
    assert asked["described"] == asked["arrays"] == ngram_join.TEXTS


def test_language_stage_reads_whole_texts_in_bounded_batches(spark, monkeypatch):
    import corpus_pipeline as pipeline

    asked, plain = {}, stored
    monkeypatch.setattr(pipeline, "stored", lambda df, name, batch=None: asked.update({name: batch}) or plain(df, name, batch))
    docs = spark.createDataFrame([(1, "the cat sat on the mat", "en"), (2, "123 ..", "en"), (3, None, "en")], "doc_id long, text string, lang string")
    assert pipeline.identify_language(spark, docs, "").count() <= 1
    assert asked["belonging"] <= 500


def test_language_model_is_sent_once(spark, monkeypatch):
    """A worker that has judged the norms needs no second copy of the model to filter texts."""
    import corpus_pipeline as pipeline
    from llm import language

    sent, plain = [], spark.sparkContext.broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, x: sent.append(type(x)) or plain(x))
    texts = [(i, f"the cat sat on the mat w{i}", "en") for i in range(60)] + [(99, "qzx vwk jjq xkcd zzq pqw vbn mxz qqk hjk wwx " * 3, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in pipeline.identify_language(spark, docs, "").collect()}
    assert kept == set(range(60))  # by the norms, which are told apart from the model
    assert sent.count(language.Model) == 1
