import hashlib
import os
import random
import time
from collections import Counter

import pytest

import __spark_entry__ as E
from tessera.llm import repeats as R
from llm_helpers import AWKWARD, clash, frame, texts_of


def plain(texts, length):
    raws = [(t or "").encode() for t in texts]
    count = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if count[r[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def values(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_query_equals_window_count(spark, sf):
    rows = texts_of(spark, sf)
    got = values(E.queries()["op8_repeats"](spark, sf))
    assert got == dict(zip([i for i, _ in rows], plain([t for _, t in rows], 400)))
    assert any(v[1] for v in got.values())


@pytest.mark.parametrize("length,naming,fine", [(12, 5, 2), (20, 20, 4), (9, 2, 1)])
def test_short_lengths(spark, length, naming, fine):
    rng = random.Random(length)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(90))) for _ in range(60)]
    base = "".join(rng.choice("abcdefgé") for _ in range(300))
    for _ in range(20):
        x = list(base)
        for _ in range(rng.randrange(6)):
            x[rng.randrange(len(x))] = rng.choice("xyz")
        s = rng.randrange(100)
        texts.append("".join(x[s:s + rng.randrange(200)]))
    texts += ["a" * 50, "abc" * 30, "q" * 11, "xyzxyzxyzxyzxyz" * 2] + AWKWARD[:6] + AWKWARD[8:]
    got = values(R.remove_repeats(clash(frame(spark, texts)), length, naming, fine))
    assert got == dict(enumerate(plain(texts, length)))


def test_slices_and_defined_cases(spark, monkeypatch):
    text = "".join(chr(97 + i * i % 23) for i in range(3000))
    whole = {(int(n), int(a), int(b)) for n, lo, hi, *_ in R.runs_of(text.encode(), 40, 8) for n, a, b in zip(n, lo, hi)}
    assert min(a for _, a, _ in whole) == 0 and max(b for *_, b in whole) == 2960
    df = frame(spark, ["x" * 10 + "y" * 500, None, "same " * 100, "same " * 100], ids=[1, None, 7, 7])
    got = [(r.doc_id, r.n_removed) for r in R.remove_repeats(df).collect()]
    assert sorted(got, key=str) == sorted([(1, 500), (None, 0), (7, 500), (7, 500)], key=str)
    assert R.remove_repeats(df.limit(0)).collect() == []


def test_packed_spans_of_single_windows_differ_in_hash(spark):
    packed = [r[0] for r in spark.range(1000).select(R._span("id", "id")).collect()]
    assert [R._first_and_last(x) for x in sorted(packed)] == [(i, i) for i in range(1000)]
    # the hash of a long in Java, which the sets of collect_set use; it was 0 for all of them
    assert len({(x >> 32) ^ (x & 0xFFFFFFFF) for x in packed}) == 1000


def test_shuffles_of_staged_tables_go_with_the_write(spark):
    def shuffles():
        tops = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for top in tops for _, _, files in os.walk(top) for f in files if f.endswith(".data")}

    before = shuffles()
    rows = R.remove_repeats(frame(spark, ["same " * 300, "same " * 200, "other"]))
    end = time.time() + 20
    while (left := shuffles() - before) and time.time() < end:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert {r.doc_id: r.n_removed for r in rows.collect()} == {0: 1500, 1: 1000, 2: 0}


def test_spans_are_joined_before_they_meet_the_texts(spark, monkeypatch):
    staged, stage = {}, R.stage

    def recorded(df, name):
        staged[name] = stage(df, name)
        return staged[name]

    monkeypatch.setattr(R, "stage", recorded)
    rng = random.Random(1)
    base = "".join(rng.choice("abcdefgh") for _ in range(900))
    texts = [base[:k] + "x" + base[k + 1:] for k in range(0, 900, 50)]
    got = {r.doc_id: r for r in R.remove_repeats(frame(spark, texts), 40, 8, 2).collect()}
    kept = {r.doc: r.gone for r in staged["repeats"].collect()}
    assert {i: len(kept.get(i, [])) for i in got} == {i: r.n_spans for i, r in got.items()}
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in got.items()} == dict(enumerate(plain(texts, 40)))
