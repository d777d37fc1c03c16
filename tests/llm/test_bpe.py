"""Own BPE against the tokenizers library."""

import random
import struct

import pytest
from tokenizers import Tokenizer as Library

from llm import bpe
from llm.queries import VOCABULARY

SPECIAL = ["", " ", "\n\t", "a" * 30_000, "x<|endoftext|>y <|startoftext|>", "It's We'LL don't", "ΑΣ ΑΣΑ", "İ İ",
           "é é 日本 \U0001f642", "a b\x1cc d\x85e", "12345 !!! ?.!"]


@pytest.fixture(scope="module")
def library():
    return Library.from_file(VOCABULARY)


def _ids(raw):
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


def test_equals_the_library(library):
    rnd = random.Random(5)
    texts = [*SPECIAL]
    for alphabet in ("aabhtein", "ah!.", "aeinst' 0129\n!?#éΣİ́<|>"):
        texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 50))) for _ in range(1500)]
    own = bpe.tokenizer(VOCABULARY)
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        got = own.encode(text)
        assert _ids(got) == want, ascii(text)
        assert own.decode(got) == library.decode(want, skip_special_tokens=False)


def test_full_tables_change_nothing(library, monkeypatch):
    for name in ("KEPT_PIECES", "KEPT_WORDS", "KEPT_PAIRS"):
        monkeypatch.setattr(bpe, name, 3)
    own = bpe.Tokenizer(VOCABULARY)
    text = "some words here, and then some other words. " * 5
    assert _ids(own.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_documents(docs, library, spark):
    got = {r.doc_id: r for r in bpe.round_trip_report(docs(None, *SPECIAL, "same", "same"), VOCABULARY).collect()}
    assert len(got) == len(SPECIAL) + 3
    assert got[0].n_tokens == 0 and got[1].n_tokens == 0
    assert got[1].ids_sha256 == got[0].ids_sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert got[4].n_tokens == len(library.encode("a" * 30_000, add_special_tokens=False).ids)
    assert bpe.round_trip_report(docs("x").limit(0), VOCABULARY).collect() == []
    kept = bpe.encode_documents(docs("two words").withColumnRenamed("n_words", "n_tokens"), VOCABULARY)
    assert kept.first().n_tokens == 2 and "size" in kept.columns
