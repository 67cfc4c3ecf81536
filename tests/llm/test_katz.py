import functools
import math
import zlib
from collections import Counter

import pytest

import __spark_entry__ as E
from pyspark.sql import functions as F
from tessera.llm import katz as K
from tessera.llm.common import words_of
from llm_helpers import AWKWARD, clash, frame, texts_of


def held(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 10 == 0


class Plain:
    """Recursive Katz model over plain dictionaries."""

    def __init__(self, texts, order):
        self.order, self.counts = order, [Counter() for _ in range(order + 1)]
        for t in texts:
            seq = ["<s>"] * (order - 1) + words_of(t or "") + ["</s>"]
            for i in range(order - 1, len(seq)):
                for n in range(1, order + 1):
                    self.counts[n][tuple(seq[i - n + 1:i + 1])] += 1
        self.d = [None] + [K.discounts(Counter(c.values())) for c in self.counts[1:]]
        self.after = {}
        for n in range(1, order + 1):
            for g, c in self.counts[n].items():
                self.after.setdefault(g[:-1], {})[g[-1]] = c

    @functools.cache
    def stats(self, ctx):
        seen, d = self.after[ctx], self.d[len(ctx) + 1]
        val = {x: c * (d[c - 1] if c <= K.TRUSTED else 1) for x, c in seen.items()}
        total, mass = sum(seen.values()), sum(val.values())
        total += mass >= total
        weight = 1 - mass / total
        if ctx:
            weight /= 1 - sum(self.p(ctx[1:], x) for x in seen)
        return val, total, weight

    @functools.cache
    def p(self, ctx, w):
        if ctx not in self.after:
            return self.p(ctx[1:], w) if ctx else 1.0
        val, total, weight = self.stats(ctx)
        if w in val:
            return val[w] / total
        return weight * self.p(ctx[1:], w) if ctx else weight

    def score(self, text):
        seq = ["<s>"] * (self.order - 1) + words_of(text or "") + ["</s>"]
        return sum(math.log10(self.p(tuple(seq[i - self.order + 1:i]), seq[i])) for i in range(self.order - 1, len(seq)))


def want(rows, order):
    train = [t for i, t in rows if not held(i)]
    model = Plain(train, order)
    uni = Counter({g[0]: c for g, c in model.counts[1].items()})
    n, v = sum(uni.values()), len(uni)
    for i, t in rows:
        toks = words_of(t or "") + ["</s>"]
        yield i, (held(i), len(toks), sum(uni[x] > 0 for x in toks), n,
                  sum(math.log10((uni[x] + 0.1) / (n + 0.1 * (v + 1))) for x in toks), model.score(t))


def check(df, rows, order):
    got = {r.doc_id: (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in df.collect()}
    expected = dict(want(rows, order))
    assert set(got) == set(expected)
    for i, e in expected.items():
        assert got[i][:4] == e[:4] and got[i][4:] == pytest.approx(e[4:], rel=1e-9, abs=1e-9)
    return got


def test_query_equals_recursive_model(spark, sf):
    rows = texts_of(spark, sf)
    got = check(E.queries()["op1_katz_score"](spark, sf), rows, K.ORDER)
    out = [g for g in got.values() if g[0]]
    assert sum(g[5] for g in out) > sum(g[4] for g in out)  # better than the base on held-out texts


@pytest.mark.parametrize("order", [1, 3])
def test_other_orders(spark, order):
    texts = ["a b c a b d", "a b c", "b c a b", "x a b y", "", None, "a a a a a a a a", "c b a"] * 3 + AWKWARD
    rows = list(enumerate(texts))
    check(K.score_documents(clash(frame(spark, texts)), order=order), rows, order)


def test_distributions_sum_to_one(spark):
    texts = ["a b c a b d", "a b c", "b c a b", "x a b y", "a a a"]
    m = K.KatzModel(frame(spark, texts).select(F.col("text").alias("_text")), 2)
    uni = {r.w: 10 ** r.lp for r in m.probabilities[1].collect()}
    assert sum(uni.values()) + 10 ** m.unknown == pytest.approx(1)
    seen = {}
    for r in m.probabilities[2].collect():
        seen.setdefault(r.ctx, {})[r.w] = 10 ** r.lp
    for r in m.weights[2].collect():
        rest = sum(q for w, q in uni.items() if w not in seen[r.ctx]) + 10 ** m.unknown
        assert sum(seen[r.ctx].values()) + 10 ** r.la * rest == pytest.approx(1)


def test_repeated_rows_and_empty_table(spark):
    df = frame(spark, ["a b", "a b", "c"], ids=[5, 5, None])
    out = K.score_documents(df).collect()
    assert len(out) == 3 and sorted(r.n_tokens for r in out) == [2, 3, 3]
    assert K.score_documents(df.limit(0)).collect() == []
