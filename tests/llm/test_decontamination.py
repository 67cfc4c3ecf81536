"""Decontamination against a plain search and SQL."""

import random
import re

import numpy as np
from llm_helpers import AWKWARD, clash, frame
from oracle_compare import compare, duck
from tessera.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, window):
    w = words(text)
    hit, names, longest = set(), set(), 0
    for name, item in items:
        v = words(item)
        n = min(window, len(v))
        for p in range(len(v) - n + 1) if v else ():
            for d in range(len(w) - n + 1):
                if w[d:d + n] == v[p:p + n]:
                    hit.update(range(d, d + n))
                    names.add("" if name is None else str(name))
                    m = n
                    while d + m < len(w) and p + m < len(v) and w[d + m] == v[p + m]:
                        m += 1
                    longest = max(longest, m)
    return len(w), sorted(hit), sorted(names), longest


def sample(seed, n, least, most, letters):
    rng = random.Random(seed)
    return [" ".join(rng.choice(letters) for _ in range(rng.randrange(least, most))) for _ in range(n)]


def check(spark, texts, items, window, shard=D.SHARD, part_bytes=D.PART_BYTES):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in D.match_documents(clash(frame(spark, texts)), bench, window, shard, part_bytes).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        hit = [p for s in got[i].spans for p in range(s["start"], s["end"])]
        assert (got[i].n_words, hit, got[i].items, got[i].longest) == brute(text, items, window), text[:80]


def test_against_plain_search(spark):
    texts = sample(1, 40, 0, 60, "abC") + sample(2, 10, 0, 90, ["x", "Yé", "漢", "a,b", "-"])
    items = list(enumerate(sample(3, 12, 0, 12, "abc") + sample(4, 4, 1, 9, ["X", "yé", "漢", "a b"]) + ["", "a b a", "b"]))
    for window in (3, 5):
        check(spark, texts, items + [(3, "c c c c b"), (None, "a a a a a")], window)


def test_pieces_and_parts(spark):
    texts = sample(5, 6, 200, 400, "abcd") + ["a " * 300]
    items = list(enumerate(sample(6, 8, 4, 14, "abcd") + ["a a a a a a a a"]))
    check(spark, texts, items, 4, shard=40)
    check(spark, texts, items, 4, part_bytes=60)


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    for top, depth in ((2, 40), (300, 12), (70_000, 9)):
        x = np.concatenate([rng.integers(0, top + 1, 3000), np.ones(200, int), rng.integers(0, 3, 500)]).astype(np.int32)
        array = D.SuffixArray(x, top, depth)

        def suffix(p):
            part = x[p:p + depth].tolist()
            return part[:part.index(0)] if 0 in part else part

        keys = [suffix(p) for p in array.sa.tolist()]
        assert sorted(array.sa.tolist()) == np.flatnonzero(x).tolist()
        assert all(a <= b for a, b in zip(keys, keys[1:]))


def test_awkward_texts(spark):
    items = [(1, "word word word"), (2, "same text here"), (3, None), (4, ""), (2, "don't I'll we've"), (5, "x" * 50_000)]
    for window in (2, 10):
        bench = spark.createDataFrame(items, "item_id long, text string")
        got = {r.doc_id: r for r in D.match_documents(clash(frame(spark, AWKWARD)), bench, window).collect()}
        for i, text in enumerate(AWKWARD):
            if text and len(text) > 60_000:
                assert (got[i].n_words, len(got[i].spans), got[i].items) == (20_000, 1, ["1"])
                continue
            n, hit, names, longest = brute(text, items, window)
            assert (got[i].n_words, sum(s["end"] - s["start"] for s in got[i].spans), got[i].items, got[i].longest) == (
                n, len(hit), names, longest)


def test_affected_documents_go(spark):
    docs = clash(frame(spark, ["a b c d", "a b x d", None, "", "a b c d"], ids=[1, 1, None, 3, 4]))
    bench = spark.createDataFrame([(1, "b C d")], "item_id long, text string")
    kept = D.decontaminate(docs, bench, 3)
    assert kept.columns == docs.columns
    assert sorted(r.text or "" for r in kept.collect()) == ["", "", "a b x d"]
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.decontaminate(docs, none, 3).count() == 5
    assert D.contamination(docs.limit(0), bench).count() == 0


def test_query_against_sql(spark, sf):
    from tessera.llm.queries import ORACLE, QUERIES
    compare(QUERIES["op12_decontamination"](spark, sf), duck(sf), ORACLE["op12_decontamination"])
