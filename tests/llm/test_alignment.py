import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from llm import alignment
from llm.bpe import byte_symbols
from llm.common import stored

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "Hello world, this is a test of two tokenizers.", "don't  stop\n\n\tnow", "", None, " ", "\n", "日本語のテキスト 🙂🙂 ﬀ ꙮ", "x" * 5000, " " * 3000 + "end",
    "<|endoftext|> <s> </s> <0x41> <unk>", "a▁b is not kept", "Ünïcödé éèê naïve", "\x00\x01 control", "1234567890 12 345", "Hello world", "Hello world",
    "مرحبا بالعالم", "नमस्ते दुनिया", "é combined", "ẞ \U0001f9ff ͸ Ⱟ \U00011f00",
]


def brute_force(texts):
    """Every pair of tokens compared, through the libraries alone."""
    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    byte = {s: b for b, s in enumerate(byte_symbols())}

    def spans(ids, raws):
        out, at = [], 0
        for i, raw in zip(ids, raws):
            out.append((i, at, at + len(raw)))
            at += len(raw)
        return out

    docs, links = [], []
    for text in texts:
        a, b = [], []
        if text:
            ia, ib = one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)
            ra = [bytes(byte[c] for c in one.id_to_token(i)) for i in ia]
            rb = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in ib]
            if b"".join(ra) == b"".join(rb) == (" " + text).encode():
                a, b = spans(ia, ra), spans(ib, rb)
        found = [(i, k) for i, s, e in a for k, t, f in b if s < f and t < e]
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= end) for side in (a, b)))
            start = end
        docs.append((len(a), len(b), len(ends), ";".join(groups)))
        links.append(found)
    counts = Counter(x for found in links for x in found)
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [(*d, len(f), sum(counts[x] == highest[x[1]] for x in f), sum(counts[x] for x in f)) for d, f in zip(docs, links)]


@pytest.mark.parametrize("head", [alignment.HEAD, 20, 0])
def test_against_all_pairs(docs, head):
    rows = stored(alignment.aligned(docs(*TEXTS), A, B), "aligned")
    got = alignment.link_scores(rows, alignment.link_counts(rows), head).orderBy("doc_id").collect()
    want = brute_force(TEXTS)
    assert [(r.n_a, r.n_b, r.n_groups, r.groups, r.n_links, r.n_best, r.count_sum) for r in got] == want
    assert want[10][0] == 0 and want[0][0] > 0  # a text with the mark itself has no tokens


def test_report_digests_groups(docs):
    got = {r.doc_id: r for r in alignment.alignment_report(docs(*TEXTS[:4]), A, B).collect()}
    for k, want in enumerate(brute_force(TEXTS[:4])):
        assert got[k].groups_sha256 == (hashlib.sha256(want[3].encode()).hexdigest() if want[3] else "")
        assert (got[k].n_links, got[k].n_best, got[k].count_sum) == want[4:]


def test_null_and_equal_ids_keep_their_rows(docs):
    got = alignment.alignment_report(docs("a b", "a b", None, ids=[None, 4, 4]), A, B).collect()
    assert sorted(((r.doc_id, r.n_a) for r in got), key=str) == [(4, 0), (4, 2), (None, 2)]
    assert alignment.alignment_report(docs(), A, B).collect() == []


def test_random_text_of_any_script_splits_as_the_library_does():
    use, pick = alignment.ByteTokenizer(A), random.Random(1)
    ranges = [(0, 0x250), (0x370, 0x530), (0x2000, 0x2100), (0x3000, 0x3100), (0x4E00, 0x4F00), (0x1F600, 0x1F650), (0x1E00, 0x1F00), (0x10000, 0x10FFF)]
    fast = 0
    for _ in range(300):
        text = "".join(chr(pick.randint(*pick.choice(ranges[: pick.randint(1, 8)]))) for _ in range(pick.randint(1, 60)))
        fast += not alignment._HARD.search(text)
        assert use.encode(text) == use.exact.encode(text, add_special_tokens=False).ids
    assert use.fast is not None and 10 < fast < 300


def test_a_small_store_of_units_changes_nothing(monkeypatch):
    use = alignment.Aligner(A, B)
    first = [use.written(u) for u in use.align(TEXTS)]
    monkeypatch.setattr(alignment, "KEPT_UNITS", 3)
    for text, want in zip(TEXTS, first):
        assert use.written(use.align([text])[0]) == want
        use.forget()
    assert len(use.units) < 10


def test_stretches_between_blanks_are_split_as_in_the_whole_text():
    use, plain, pick = alignment.Aligner(A, B), alignment.Aligner(A, B), random.Random(6)
    assert use.by_words
    plain.by_words = False
    parts = ["word", "Wörter", "don't", "a.b", "3,5", "\n", "x\ny", "\t", "", " ", "\u00a0", "z\u00a0", "▁", "日本", "🙂", "'s", "...", "\r\n", "\u3000q", "\x1c", "\u200b", "q\x1cr"]
    texts = [pick.choice([" ", "\n", " "]).join(pick.choice(parts) for _ in range(pick.randint(1, 12))) for _ in range(500)]
    texts += ["\nfoo", "a\nfoo\nbar b", "foo\n", "a\n\nb", "a \nb", "a\n b", "\n", " \nfoo \nfoo", "x\r\ny\nz"]
    for text, a, b in zip(texts, use.align(texts), plain.align(texts)):
        assert (use.counts(a), use.written(a)) == (plain.counts(b), plain.written(b)), text
        assert [x.tolist() for x in use.linked(a)] == [x.tolist() for x in plain.linked(b)]
