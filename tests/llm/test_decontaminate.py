"""Contamination against a direct search."""

import hashlib
import random
import re

from llm import decontaminate


def brute(text, items, window=10):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, met = set(), set()
    for name, item in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), item or ""))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            part = w[i : i + window]
            for j in range(len(words) - len(part) + 1):
                if words[j : j + len(part)] == part:
                    hit |= set(range(j, j + len(part)))
                    met.add(str(name) if name is not None else "")
    ids = ",".join(sorted(met))
    return len(words), len(hit), len(met), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


def _items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, ITEM_ID string")


def test_equals_brute_force(spark, docs):
    rnd = random.Random(2)
    vocabulary = ["Ab", "cd", "Ée", "x1", "no"]
    say = lambda n: rnd.choice([" ", "-", "\n"]).join(rnd.choice(vocabulary) for _ in range(n))
    items = [(k, say(rnd.choice([1, 4, 9, 10, 11, 14])), "c") for k in range(12)] + [(3, "zz yy", "c"), (None, "qq rr", "c"), (50, None, "c"), (51, "..", "c")]
    texts = [say(rnd.randint(0, 60)) for _ in range(60)] + [None, "", "zz, yy QQ rr", "zz", "ab " * 5000, items[5][1]]
    got = decontaminate.contamination_report(docs(*texts), _items(spark, items)).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == [brute(t, [i[:2] for i in items]) for t in texts]


def test_many_blocks_give_the_same(spark, docs):
    items = [(k, f"one{k} two three four", "c") for k in range(20)]
    texts = ["x one3 two three four. One7 two three four", "one3 two", None]
    frame = _items(spark, items)
    whole = decontaminate.find_contamination(docs(*texts), frame).select("contamination").collect()
    cut = decontaminate.find_contamination(docs(*texts), frame, block_bytes=150).select("contamination").collect()
    assert whole == cut
    spans = whole[0].contamination.spans
    assert [texts[0][s.start : s.end] for s in spans] == [texts[0][2:]]  # runs that touch are one


def test_empty_tables(spark, docs):
    none = _items(spark, []).limit(0)
    assert [r.n_hit for r in decontaminate.contamination_report(docs("a b", None), none).collect()] == [0, 0]
    assert decontaminate.contamination_report(docs("a").limit(0), _items(spark, [(1, "a", "c")])).collect() == []


def test_one_text_under_many_ids_is_cut_into_blocks(spark):
    same = spark.range(100_000).selectExpr("cast(id as string) as item", "'one two three four five six seven' as text")
    found = list(decontaminate.blocks(same.union(same.limit(10)), 400_000))
    assert len(found) > 5 and sum(map(len, found)) == 100_000
    assert max(sum(len(i) + len(t) for i, t in block) for block in found) < 500_000
