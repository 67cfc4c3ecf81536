import zlib

import numpy as np

import __spark_entry__ as E
from tessera.llm import language_id as L
from llm_helpers import AWKWARD, clash, frame


def test_held_out_accuracy(spark, sf):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = E.queries()["op7_language_id"](spark, sf).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out and truth[r.doc_id]]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95


def test_matrix_equals_plain_count(spark):
    df = frame(spark, ["ab", "ba", "zz", None, "q"], langs=["x", "x", "y", "x", None])
    langs, logs = L.matrix(L.train(df, dims=64), dims=64)
    assert langs == ["x", "y"] and np.allclose(np.exp(logs).sum(0), 1)
    n = {r.lang: r.s for r in L.train(df, dims=64).groupBy("lang").agg({"n": "sum"}).withColumnRenamed("sum(n)", "s").collect()}
    assert n == {"x": 6, "y": 3}  # 2 + 1 grams per text of two characters


def test_slices_do_not_change_counts(monkeypatch):
    texts = ["abcdefghij" * 5, "", "xyz", "q"]
    def counts():
        out = np.zeros((4, 256), int)
        for p, r, s in L._slices(texts):
            for row, f in L._features(p, r, s, 256):
                np.add.at(out, (row, f), 1)
        return out
    whole = counts()
    monkeypatch.setattr(L, "SLICE", 7)
    assert (counts() == whole).all() and whole.sum() == 50 + 49 + 48 + 3 + 2 + 1 + 1


def test_defined_cases(spark):
    df = clash(frame(spark, AWKWARD, langs=["en", None] * 8))
    model = L.matrix(L.train(L.learned_rows(df)))
    rows = {r.doc_id: r for r in L.identify(df, model).collect()}
    assert len(rows) == len(AWKWARD)
    for i in (0, 1, 2, 3, 13):
        assert (rows[i].lang_pred, rows[i].score) == ("und", 0.0)
    empty = df.limit(0)
    nothing = L.matrix(L.train(empty))
    assert L.identify(empty, nothing).collect() == []
    assert {r.lang_pred for r in L.identify(df, nothing).collect()} == {"und"}
    kept = L.keep_identified(df)
    assert kept.columns == df.columns and 0 not in {r.doc_id for r in kept.collect()}


def plain_features(text, dims):
    """Hashed n-grams one by one, in plain integers."""
    mask, points = (1 << 32) - 1, [ord(c) for c in text.lower()]
    for i in range(len(points)):
        state = 0
        for n in (1, 2, 3):
            if i + n > len(points):
                break
            state = ((state ^ points[i + n - 1]) * int(L._MIX[n - 1])) & mask
            state ^= state >> 15
            yield (((state ^ (n * 0x27D4EB2F & mask)) * 0x165667B1) & mask) >> 8 & (dims - 1)


def plain_predictions(rows, dims):
    import collections
    import math
    counts = collections.defaultdict(collections.Counter)
    for doc, text, lang in rows:
        if zlib.crc32(str(doc).encode()) % 3 != 1 and text is not None and lang is not None:
            counts[lang].update(plain_features(text, dims))
    sizes = {k: sum(c.values()) + dims * L.SMOOTHING for k, c in counts.items()}
    out = {}
    for doc, text, _ in rows:
        if text is None or not any(c.isalpha() for c in text):
            out[doc] = ("und", 0.0)
            continue
        grams = list(plain_features(text, dims))
        sums = {k: sum(math.log((c[f] + L.SMOOTHING) / sizes[k]) for f in grams) for k, c in counts.items()}
        top = max(sums.values())
        out[doc] = ({k for k, v in sums.items() if v > top - 1e-9}, 1 / sum(math.exp(v - top) for v in sums.values()))
    return out


def assert_as_plain(got, rows, dims):
    want = plain_predictions(rows, dims)
    assert len(got) == len(rows)
    for r in got:
        langs, score = want[r.doc_id]
        assert abs(r.score - score) < 1e-9 and (r.lang_pred == langs or r.lang_pred in langs), r


def test_query_equals_plain_loop(spark, tmp_path):
    """The registered query, at its own dims, on a small table with nulls, ties and repeated texts."""
    import random
    rng = random.Random(2)
    words = {"en": ["the", "house", "with", "thing"], "de": ["das", "Haus", "mit", "Ding"], "xx": ["q", "zz", "漢字"]}
    rows = []
    for i in range(90):
        lang = rng.choice(list(words))
        rows.append((i, " ".join(rng.choices(words[lang], k=rng.randrange(1, 9))), lang if i % 7 else None))
    rows += [(90, None, "en"), (91, "", "de"), (92, "123 !", "en"), (93, "a", None), (94, rows[3][1], "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    assert_as_plain(E.queries()["op7_language_id"](spark, str(tmp_path)).collect(), rows, L.DIMS)


def test_labels_without_a_bound(spark, monkeypatch):
    """More labels than a block holds: all are learned, and the blocks' posteriors add up."""
    monkeypatch.setattr(L, "LANGUAGES", 8)
    rows = [(i, f"word{i % 30} of {'abcdefghij'[i % 10] * 4} {i % 30}", f"l{i % 30:02d}") for i in range(240)]
    rows += [(300, "1 2", "l01"), (301, None, "l02"), (302, "aaaa", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    several = list(L.blocks(L.train(L.learned_rows(df), dims=512), dims=512))
    assert len(several) > 2 and sorted(k for ks, _ in several for k in ks) == [f"l{i:02d}" for i in range(30)]
    assert_as_plain(L.identify(df, several).collect(), rows, 512)


def test_many_distinct_labels_do_not_raise(spark):
    df = frame(spark, [f"text {i}" for i in range(600)], langs=[f"dirty-{i}" for i in range(600)])
    rows = L.identify(df, L.blocks(L.train(L.learned_rows(df)))).collect()
    assert len(rows) == 600 and all(r.lang_pred.startswith("dirty-") for r in rows)
