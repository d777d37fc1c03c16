"""Base spans against Python's regular expressions, and the learned ones."""

import hashlib
import random
import re

from llm import pii

PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def holds(kind, word):
    digits = re.sub("[^0-9]", "", word)
    return {
        "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in word.split(".")),
        "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def brute(text):
    spans = [(m.start(), k, m.end(), name) for k, (name, p) in enumerate(PLAIN) for m in re.finditer(p.replace(r"[\x20-]", "[ -]"), text or "") if holds(name, m[0])]
    return ",".join(f"{name}:{a}:{b}" for a, _, b, name in sorted(spans))


def test_base_spans(docs):
    rnd = random.Random(3)
    texts = [None, "", "a" * 100_000, "1" * 100_000, "a@" + "b." * 30_000, "+1" + " " * 50_000, "1." * 20_000, "x 4111 1111-11111111 +1 (555) 555-1234"]
    for alphabet in ("ab@..--+1234567890 ()_%é\U0001f642=\n", "01.3-  +", "a@.a_", "25.6 "):
        texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 100))) for _ in range(250)]
    got = pii.span_report(docs(*texts)).orderBy("doc_id").collect()
    for text, r in zip(texts, got, strict=True):
        want = brute(text)
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), text
        assert set(want.split(",")) - {""} <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [want.count(f"{k}:") for k, _ in PLAIN]


def test_secrets_are_learned_and_plain_numbers_left(docs):
    secret = [f'say password=ab{k}c9d8e7f6a5 now "{hashlib.sha1(str(k).encode()).hexdigest()}" AKIA{k:02d}ABCDEFGHIJKLMN' for k in range(40)]
    plain = [f"chapter{k}section{k} and room2024b{k} stay, version-1.2.{k}-beta" for k in range(200)]
    frame = docs(*secret, *plain)
    model = pii.fit(frame)
    found = pii.redact(pii.find_spans(frame, model)).orderBy("doc_id").collect()
    assert found[0].text == 'say <secret> now "<secret>" <secret>'
    assert [r.text for r in found[40:]] == plain and all(not r.pii for r in found[40:])
    assert all(0 < q < p < 1 for p, q in model.reliability.values())


def test_defined_results(docs):
    assert pii.fit(docs("no digits", None)) is None
    out = pii.redact(pii.find_spans(docs("x a.b@c.de é +1 (555) 555-1234", None, ""), None)).orderBy("doc_id")
    assert [r[1] for r in out.collect()] == ["x <email> é <phone>", None, ""]
    assert out.columns == ["doc_id", "text", "TEXT_1", "size", "_range", "n_words", "pii"]
    assert pii.span_report(docs("x").limit(0)).collect() == []
    assert pii.redact(pii.find_spans(docs("1.2.3.4@a.bc"), None)).first()[1] == "<email>"  # the ip inside is covered


def test_very_many_matches_of_one_text(docs):
    """Far more matches than a block holds, in time that grows with them."""
    text = " ".join(f"1.2.3.{k % 256} x" for k in range(20_000))
    got = pii.span_report(docs(text, "1.2.3.4")).orderBy("doc_id").collect()
    assert got[0].n_ip == got[0].n_spans == 20_000 and got[0].base_sha256 == hashlib.sha256(brute(text).encode()).hexdigest()
    assert got[1].spans == "ip:0:7"


def test_recall_of_planted_personal_data_and_secrets(spark):
    """Of the given documents that hold any, nearly all are found; those without digits are left alone."""
    from llm.common import read

    rows = pii.span_report(read(spark, "/root/testdata/sf0.01", "documents")).collect()
    texts = {r.doc_id: r.text for r in read(spark, "/root/testdata/sf0.01", "documents").collect()}
    held = {i: bool(brute(t)) or bool(re.search(r'(?i)token = "[0-9a-f]{40}"', t or "")) for i, t in texts.items()}
    found = {r.doc_id: r.n_spans > 0 for r in rows}
    secret = {i for i, t in texts.items() if re.search(r'(?i)token = "[0-9a-f]{40}"', t or "")}
    assert sum(found[i] for i in held if held[i]) >= 0.95 * sum(held.values()) > 0
    assert sum(r.n_secret > 0 for r in rows if r.doc_id in secret) >= 0.95 * len(secret) > 0
    assert not any(found[i] for i, t in texts.items() if not re.search("[0-9]", t or ""))
