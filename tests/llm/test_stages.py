"""How the stages of the pipeline run."""

import hashlib

import corpus_pipeline
from llm.bpe import tokenizer
from llm.queries import VOCABULARY


def test_a_task_of_the_last_stage_runs_one_python_function(spark):
    """Each function in a task has a worker of its own, with a copy of the vocabulary."""
    docs = spark.createDataFrame([(1, "Some words.", 11), (2, None, None), (3, "", 0)], "doc_id long, text string, n_chars long")
    out = corpus_pipeline.encoded(spark, docs, "")
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert out.columns == ["doc_id", "n_chars", "n_tokens", "token_ids", "decoded_sha256"]
    t = tokenizer(VOCABULARY)
    for r in out.collect():
        ids = t.encode({1: "Some words."}.get(r.doc_id))
        assert bytes(r.token_ids) == ids and r.n_tokens == len(ids) // 4
        assert r.decoded_sha256 == hashlib.sha256(t.decode(ids).encode()).hexdigest()
