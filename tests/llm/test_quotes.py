"""Quotation linking on small conversations, against a direct computation, and on the given table."""

import random
import re

from llm import quotes

MESSAGES = "conv_id long, turn long, role string, text string, TURN string, own int"


def brute(rows):
    """parent by turn of one conversation"""
    norm = lambda t: re.sub(r"\s+", " ", t.lower()).strip()
    good = lambda t: re.search(r"\w", t)
    said, parents = {}, {}
    for turn, text in rows:
        own, passages = [], []
        before = 0
        for line in (text or "").split("\n"):
            marks = re.match(r"\s*(?:>\s?)+", line)
            level = marks[0].count(">") if marks else 0
            body = line[marks.end() :] if marks else line
            if not level:
                own.append(body)
            elif level == before:
                passages[-1][1].append(body)
            else:
                passages.append((level, [body]))
            before = level
        found = []
        for at, (level, lines) in enumerate(passages):
            whole = "\n".join(lines)
            for kind, unit in [(0, whole), *((1, x) for x in re.split(r"\n\s*\n", whole)), *((2, x) for x in lines)]:
                if good(norm(unit)) and norm(unit) in said:
                    found.append((level, at, kind, said[norm(unit)]))
        if found:
            parents[turn] = min(found)[3]
        whole = "\n".join(own).strip(" ")
        for unit in [whole, *re.split(r"\n\s*\n", whole), *whole.split("\n")]:
            if good(norm(unit)):
                said.setdefault(norm(unit), turn)
    return parents


def test_equals_brute_force(spark):
    rnd = random.Random(4)
    rows, want = [], {}
    for conv in range(15):
        texts = []
        for turn in range(12):
            lines = [" ".join(rnd.choice(["Yes", "no", "why", "it"]) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(1, 4))]
            lines[1:1] = [""] * rnd.randint(0, 1)
            for _ in range(rnd.randint(0, 2)):
                if texts and rnd.random() < 0.4:  # some paragraphs of a message, wrapped anew
                    parts = [x for x in re.split(r"\n\s*\n", re.sub(r"(?m)^[>\s]+", "", rnd.choice(texts))) if x.strip()]
                    picked = [re.sub(r"\s+", rnd.choice([" ", "\n> "]), x.strip()) for x in parts[rnd.randint(0, 1) : rnd.randint(1, 3)]]
                    lines[:0] = [f"> {x}" for x in "\n>\n> ".join(picked).split("\n> ")] if picked else []
                elif texts:
                    lines[:0] = [rnd.choice([">", "> ", ">> ", "> > "]) + x.upper() for x in rnd.choice(texts).split("\n")[: rnd.randint(1, 4)]]
            texts.append("\n".join(lines))
            rows.append((conv, turn, "user", texts[-1], "c", 1))
        want[conv] = brute(list(enumerate(texts)))
    got = quotes.link_quotes(spark.createDataFrame(rows, MESSAGES).repartition(3)).collect()
    assert len(got) == len(rows)
    for r in got:
        parents, turn, depth = want[r.conv_id], r.turn, 0
        assert r.parent_turn == parents.get(turn)
        while turn in parents:
            turn, depth = parents[turn], depth + 1
        assert (r.root_turn, r.depth) == (turn, depth)
        assert not re.search(r"^\s*>", r.text, re.M)


def test_defined_results(spark):
    rows = [(1, 0, "user", "Hi", "c", 1), (1, 1, None, "> hi\nyes", "c", 1), (1, 2, "user", None, "c", 1), (None, 3, "user", "> Hi", "c", 1), (1, None, "user", "> Hi", "c", 1),
            (1, 4, "user", "> new", "c", 1), (1, 5, "user", "> ...", "c", 1), (1, 1, None, "> hi\nyes", "c", 1), (2, 0, "user", "> yes", "c", 1), (1, 6, "user", ">" * 3000 + " hi\n" * 500, "c", 1)]
    frame = spark.createDataFrame(rows, MESSAGES)
    got = sorted((tuple(r) for r in quotes.link_quotes(frame).select("conv_id", "turn", "text", "parent_turn", "root_turn", "depth").collect()), key=str)
    tail = "\n".join([" hi"] * 499).strip(" ")
    want = [(1, 0, "Hi", None, 0, 0), (1, 1, "yes", 0, 0, 1), (1, 1, "yes", 0, 0, 1), (1, 2, "", None, 2, 0), (None, 3, "", None, 3, 0), (1, None, "", None, None, 0),
            (1, 4, "", None, 4, 0), (1, 5, "", None, 5, 0), (2, 0, "", None, 0, 0), (1, 6, tail, 0, 0, 1)]
    for a, b in zip(got, sorted(want, key=str), strict=True):
        assert (a[0], a[1], a[3:]) == (b[0], b[1], b[3:]) and a[2].split() == b[2].split()
    assert quotes.conversation_report(frame.limit(0)).collect() == []


def test_replies_stand_behind_what_they_answer(spark):
    rows = [(1, 0, "a", "one", "c", 1), (1, 1, "b", "two", "c", 1), (1, 2, "a", "> one\nre", "c", 1), (1, 3, "b", "> re\nmore", "c", 1), (1, 4, "a", "> two\nx", "c", 1)]
    got = quotes.conversation_report(spark.createDataFrame(rows, MESSAGES).repartition(4)).collect()
    assert [r.turn for r in got] == [0, 2, 3, 1, 4]
    assert got[1].message == "<|a|>\nre\n<|end|>"


def test_paragraphs_of_a_rewrapped_quote(spark):
    first = "One two three four.\n\nFive six seven eight nine ten.\n\nEleven twelve thirteen."
    reply = "> five six seven\n> eight nine ten.\n>\n> eleven\n> twelve thirteen.\nIndeed."
    rows = [(1, 0, "a", first, "c", 1), (1, 1, "b", "eleven", "c", 1), (1, 2, "b", reply, "c", 1)]
    got = {r.turn: r.parent_turn for r in quotes.link_quotes(spark.createDataFrame(rows, MESSAGES)).collect()}
    assert got == {0: None, 1: None, 2: 0}  # a paragraph counts before the line "eleven"
