import random
from collections import Counter, defaultdict

import numpy as np
import xxhash

import __spark_entry__ as E
from tessera.llm import simhash as S
from tessera.llm.components import connected_components
from llm_helpers import AWKWARD, clash, frame, texts_of


def plain_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64(g.encode(), 42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(nodes, linked):
    root = {}
    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if linked(a, b):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in nodes}


def brute(texts):
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    first = {}
    for i in sorted(fps):
        first.setdefault(fps[i], i)
    comp = plain_components(sorted(first.values()), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    return {i: (f"{fps[i]:016x}", comp[first[fps[i]]]) for i in fps}


def test_query_equals_brute_force(spark, sf):
    rows = E.queries()["op9_simhash"](spark, sf).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == brute(dict(texts_of(spark, sf)))


def test_covering_finds_every_pair():
    rng = random.Random(1)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randrange(1, 4)):
            y ^= 1 << b
        fp = np.array([x, y], np.uint64)
        at = defaultdict(set)
        for half, rows, word, home in S.anchors(fp):
            for r, w in zip(rows, word):
                at[half, int(w)].add((int(r), home))
        assert any((0, True) in v and any(r == 1 for r, _ in v) for v in at.values())
        sizes = Counter(len(v) for v in at.values())
        assert sum(n * k for n, k in sizes.items()) <= 2 * 34


def test_links_with_split_anchors(spark):
    rng = random.Random(2)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    fps = set()
    for s in seeds:
        for _ in range(60):
            x = s
            for b in rng.sample(range(64), rng.randrange(0, 4)):
                x ^= 1 << b
            fps.add(x)
    signed = [(int(np.uint64(x).astype(np.int64)),) for x in fps]
    want = plain_components(sorted(x for x, in signed), lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 3)
    for block in (3, 4096):
        edges = S.links(spark.createDataFrame(signed, "fp long"), block=block)
        got = {r.node: r.component for r in connected_components(edges).collect()}
        assert {x: got.get(x, x) for x, in signed} == want


def test_defined_cases(spark):
    texts = {i: t for i, t in enumerate(AWKWARD)}
    rows = S.simhash_documents(clash(frame(spark, AWKWARD))).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == brute(texts)
    df = frame(spark, ["a b c d", "a b c d", "a b c d", None], ids=[5, 3, 3, None])
    assert sorted((r.doc_id or -1, r.component_id) for r in S.simhash_documents(df).collect() if r.component_id) == [
        (3, 3), (3, 3), (5, 3)]
    assert S.simhash_documents(df.limit(0)).collect() == []
    kept = S.keep_one(clash(df))
    assert kept.columns == clash(df).columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 3]


def test_long_text_in_slices(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000))
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "_HASHES", 64)
    assert S.fingerprint(text) == whole == plain_fingerprint(text)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    ids = list(range(300))
    rng.shuffle(ids)
    edges = [(ids[i], ids[i + 1]) for i in range(99)] + [(ids[100], x) for x in ids[101:180]] + [(7, 7), (None, 1)]
    want = plain_components(range(300), lambda a, b: (a, b) in pairs or (b, a) in pairs) if (pairs := set(edges)) else {}
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {i: got.get(i, i) for i in range(300)} == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []
