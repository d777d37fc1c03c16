"""Token files: round trip, random access, order."""

import random
import struct
import zlib

import numpy as np
from tokenizers import Tokenizer as Library

from llm import token_files
from llm.queries import VOCABULARY


def test_segment_round_trip_and_random_access():
    rnd = random.Random(1)
    for n in (0, 1, 7, 511, 512, 513, 3000):
        ids = np.array([rnd.choice([0, 1, 255, 256, 49407, 65536, 2**32 - 1]) for _ in range(n)], dtype="<u4")
        docs = [(5, ids[: n // 2].tobytes()), (None, ids[n // 2 :].tobytes())]
        segment = token_files.Segment(token_files.Segment.write(docs))
        assert segment.all().tolist() == ids.tolist()
        assert [segment.token(i) for i in range(n)] == ids.tolist()
        assert segment.has_id.tolist() == [1, 0] and segment.lengths.tolist() == [n // 2, n - n // 2]


def test_coder_equals_the_library(monkeypatch):
    library = Library.from_file(VOCABULARY)
    texts = ["Some words, SOME words!", "", "x<|endoftext|>y <|ENDOFTEXT|>", "ΑΣ İ é b", "it's 12", "a" * 5000, "'s !! ?"]
    monkeypatch.setattr(token_files, "KEPT_WORDS", 2)
    monkeypatch.setattr(token_files, "KEPT_FORMS", 2)
    coder = token_files.LibraryCoder(VOCABULARY)
    for _ in range(2):
        for text, raw in zip(texts, coder.encode(texts), strict=True):
            assert raw == struct.pack(f"<{len(raw) // 4}I", *library.encode(text, add_special_tokens=False).ids)


def test_documents(spark, docs, tmp_path):
    library = Library.from_file(VOCABULARY)
    texts = ["b b", None, "", "some text", "same", "same", "long " * 20_000, "no id"]
    ids = [9, 4, -3, 2**62 + 1, 8, 8, 5, None]
    frame = docs(*texts, ids=ids).repartition(3)
    got = token_files.file_report(frame, VOCABULARY).collect()
    order = sorted(zip(ids, texts, strict=True), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at, want = 0, []
    for i, text in order:
        coded = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((i, at, len(coded), zlib.crc32(struct.pack(f"<{len(coded)}I", *coded))))
        at += len(coded)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert token_files.file_report(docs("x").limit(0), VOCABULARY).collect() == []
    token_files.write_token_files(frame, VOCABULARY, str(tmp_path / "f"), segment_tokens=3)
    assert sorted(map(tuple, token_files.read_token_files(spark, str(tmp_path / "f")).select("doc_id", "start").collect()), key=lambda r: r[1]) == [w[:2] for w in want]
