import hashlib
import random

import numpy as np

import __spark_entry__ as E
from tessera.llm import fingerprint as P
from llm_helpers import AWKWARD, clash, frame, texts_of


def plain(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    out = {}
    for i, (doc, text) in enumerate(rows):
        text, nxt = text or "", rows[(i + 1) % len(rows)][1] or ""
        n = len(text) // 4
        changed = text[:len(text) - n] + nxt[:n]
        out[doc] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), P.fingerprint(text),
                    P.fingerprint(changed), P.likeness(P.fingerprint(text), P.fingerprint(changed)),
                    P.likeness(P.fingerprint(text), P.fingerprint(nxt)))
    return out


def as_dict(df):
    return {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)
            for r in df.collect()}


def test_query_equals_sequential_walk(spark, sf):
    got = as_dict(E.queries()["op3_fingerprint"](spark, sf))
    assert got == plain(texts_of(spark, sf))
    near = np.array([v[4] for v in got.values()])
    assert np.median(near) > 0.6 and np.median([v[5] for v in got.values()]) < 0.2


def test_defined_cases(spark):
    df = clash(frame(spark, AWKWARD))
    got = as_dict(P.fingerprint_documents(df))
    assert got == plain(list(enumerate(AWKWARD)))
    assert got[0][2] == got[1][2] and got[9][2] == got[10][2] and got[9][5] == 1.0
    assert P.fingerprint_documents(df.limit(0)).collect() == []
    one = P.fingerprint_documents(frame(spark, ["alone here, all alone"])).collect()[0]
    assert one.near_next == 1.0 and one.n_chars == 21
    assert len(P.fingerprint_documents(frame(spark, ["b", "a", "c"], ids=[1, 1, None])).collect()) == 3


def test_edit_distance_equals_table():
    rng = random.Random(6)
    for _ in range(200):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(1, 20))) for _ in range(2))
        d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = d[i - 1][j - 1] if a[i - 1] == b[j - 1] else 1 + min(d[i - 1][j], d[i][j - 1])
        assert len(a) + len(b) - 2 * P._common_subsequence(a, b) == d[-1][-1]


def test_boundaries_are_local_and_slices_agree(monkeypatch):
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh ") for _ in range(20_000))
    assert P.likeness(P.fingerprint(text), P.fingerprint(text[:9000] + "inserted words" + text[9000:])) > 0.9
    whole = P.fingerprint(text)
    monkeypatch.setattr(P, "_SLICE", 777)
    assert P.fingerprint(text) == whole


def test_compatible_block_sizes():
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh ") for _ in range(9_000))
    a, b = P.fingerprint(text), P.fingerprint(text[:5_000])
    assert P.likeness(a, b) > 0.5 and P.likeness(a, P.fingerprint("short")) == 0.0


def test_short_near_copies_are_alike():
    """Texts of a few words: the edit distance alone decides, as three quarters stay."""
    texts = ["a short text of nine words in a row", "tiny note", "one two three four five six", "ab cd ef gh ij kl mn"]
    for t in texts:
        a, b = P.fingerprint(t), P.fingerprint(P.edited(t, "ZZZZZZZZZZZZZZZZZZZZ"))
        assert a == b or 0 < P.likeness(a, b) < 1
    one, two = "ABCDEFGHIJKLMNOP", "ABCDE1FGHIJ2KLMN"
    assert P.signature_likeness(one, two) > 0.8 and P.signature_likeness(one, one[::-1]) == 0.0
    assert P.signature_likeness(one[:15], two) > 0.7
