import hashlib
import base64
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest

import __spark_entry__ as E
from tessera.llm import byte_bpe, packing
from llm_helpers import AWKWARD, clash, frame, texts_of

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def digests(enc, text):
    ids = enc.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_query_equals_library(spark, sf, reference):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in E.queries()["op4_byte_bpe"](spark, sf).collect()}
    assert got == {i: digests(reference, t) for i, t in texts_of(spark, sf)}


def test_small_windows_and_awkward_texts(spark, reference):
    rng = random.Random(5)
    noise = ["".join(rng.choice("ab1 \n\t.'é漢s") for _ in range(rng.randrange(400))) for _ in range(60)]
    texts = AWKWARD + noise
    got = byte_bpe.encode_documents(clash(frame(spark, texts)), RANKS, P.PATTERN, chunk=50, overlap=12).collect()
    assert {r.doc_id: r.ids for r in got} == {i: reference.encode_ordinary(t or "") for i, t in enumerate(texts)}


def test_repeated_rows_and_empty_table(spark, reference):
    long = "some words, and 12 more. " * 30
    df = frame(spark, [long, long, "b"], ids=[7, 7, None])
    got = byte_bpe.encode_documents(df, RANKS, P.PATTERN, digest=True, chunk=100, overlap=20).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in got) == sorted(
        [(7, digests(reference, long)[0])] * 2 + [(-1, 1)])
    assert byte_bpe.encode_documents(df.limit(0), RANKS, P.PATTERN).collect() == []


def check_packing(rows, ids_of):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(ids_of)
    for doc, pieces in by_doc.items():
        ids, at = ids_of[doc], 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 2048 or at & (at - 1) == 0  # no padding at all


def test_packing_query(spark, sf):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = {i: t.encode(x or "", add_special_tokens=False).ids + [1] for i, x in texts_of(spark, sf)}
    check_packing(E.queries()["op10_packing"](spark, sf).collect(), ids)


def test_long_texts_are_encoded_in_parts(monkeypatch):
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_50k.json")
    plain, own = Tokenizer.from_file(path), packing.Ids(path)
    assert own.ranked
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab1 \n\t.'é漢s\x1c\x85\u3000") for _ in range(rng.randrange(300))) for _ in range(200)]
    for part in (1, 7, 50):
        monkeypatch.setattr(packing, "PART", part)
        for text, ids in zip(texts, own.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_packing_awkward(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    df = clash(frame(spark, AWKWARD))
    rows = packing.pack_documents(df, P.path("byte_bpe_50k.json")).collect()
    check_packing(rows, {i: t.encode(x or "", add_special_tokens=False).ids + [1] for i, x in enumerate(AWKWARD)})
    assert packing.pack_documents(df.limit(0), P.path("byte_bpe_50k.json")).collect() == []


def test_sum_of_squares_choice():
    """The vectorised choice equals trying every level."""
    rng = random.Random(3)
    p = packing.Packer(window=16, open_tokens=10**9)
    for n in range(600):
        s = rng.randrange(1, 16)
        costs = {}
        for h in range(0, 16 - s + 1):
            if h and not p.levels[h]:
                continue
            after = p.levels.copy()
            if h:
                after[h] -= 1
            if h + s < 16:
                after[h + s] += 1
            costs[h] = int((after ** 2).sum())
        assert costs[p.choose(s)] == min(costs.values())
        list(p.add(n, b"\0" * 4 * s))


def test_open_windows_are_bounded():
    p = packing.Packer(window=16, open_tokens=100)
    out = []
    for n in range(100):
        out += list(p.add(n, b"\0" * 4 * 9))  # two never share a window
        assert p.held <= 100
    out += list(p.flush())
    assert sum(x[2] for x in out) == 900
