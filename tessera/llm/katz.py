"""Language-model scoring with Katz backoff.

Words are lower-cased (A-Z) runs between ASCII white space, and every text ends
with an end token; a word is known by its 64-bit hash, an n-gram by a 64-bit
hash of its words in order, and the context of an n-gram is the (n-1)-gram
before its last word.

Texts are packed into bundles of about ``PART`` tokens, written once.  A bundle
asks for each of its distinct n-grams once, as sorted and packed keys cut into
buckets by key range, with its own training counts: nothing is shuffled per
token, and a word or pair that fills the corpus is one key per bundle.  Tables,
written to the shared folder and partitioned by order:

* counts: per bucket, the keys and corpus counts of every training n-gram, the
  counts of counts, and per asking bundle the counts in the order of its
  request, marking the one bundle that speaks for an n-gram (``own``);
* weights: per bucket and context, the total and the backoff weight, log10 of
  the mass that Good-Turing discounts free (counts up to ``TRUSTED``), divided
  by the lower-order mass of the words not seen after the context.  That mass
  is summed exactly, each distinct n-gram once, by the bundle that speaks for
  it; so each distribution sums to one over the vocabulary and the unknown word.

Scoring is recursive per token: a token found at order n ends there; one that
is not adds its context's backoff weight and goes on at order n - 1, down to
the unigram or the unknown word.

Buckets are the session's shuffle partitions, or more where a bucket would
hold over ``PART`` tokens' keys; a task holds one bucket or one bundle.

Defined cases: a null text counts as empty and is its end token alone; a null
doc_id takes part in training like remainder 0 of the empty string; rows that
repeat id and text are scored each; without training rows every token is
unknown with probability one; where a count of counts is zero or a discount
leaves (0, 1), d(r) is r / (r + 1); a context no discount touches has one added
to its total, so something is left for unseen words; further columns are
ignored.
"""

from __future__ import annotations

import functools
import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import id_remainder, map_rows, stage, stage_dir, text_or_empty, words_of

ORDER = 2
TRUSTED = 5
PART = 1 << 21  # tokens of a bundle, unless one text is longer
_START = np.uint64(0x51A7)
_END = np.uint64(0xE4D)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TALLY = TRUSTED + 3  # counts of counts 1 .. TRUSTED + 1, tokens, types
_REPLY = "n int, bucket int, bundle long, keys binary, a binary, b binary, tally array<long>"


class _Words(dict):
    def __missing__(self, word):
        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _pack(values: np.ndarray) -> bytes:
    """64-bit values as compressed byte planes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(blob: bytes, kind=np.uint64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).reshape(-1).view(kind)


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(_unpack(blob), dtype=np.uint64)


def _cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where the key range of each bucket starts within sorted keys, and the end."""
    starts = np.array([(b << 64) // buckets for b in range(buckets)], np.uint64)
    return np.append(np.searchsorted(keys, starts), len(keys))


def _slices(n: int, bundle: int, keys: np.ndarray, buckets: int, **columns: np.ndarray) -> dict:
    """One row per bucket that some keys fall into."""
    cut = _cuts(keys, buckets)
    used = [b for b in range(buckets) if cut[b] < cut[b + 1]]
    return {"n": [n] * len(used), "bucket": used, "bundle": [bundle] * len(used),
            "keys": [_pack_sorted(keys[cut[b]:cut[b + 1]]) for b in used],
            **{c: [_pack(v[cut[b]:cut[b + 1]]) for b in used] for c, v in columns.items()}}


def _bundles(rows: DataFrame) -> DataFrame:
    """Bundles of ``rows(doc, train, _text)``: (bundle, tokens, docs, train, sizes, vocab, ids)."""
    def run(batches):
        words, made = _Words(), 0
        docs, train, parts, size = [], [], [], 0

        def bundle():
            # the commonest words get the smallest numbers, which pack best
            vocab, ids, k = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
            by = np.argsort(-k, kind="stable")
            rank = np.empty(len(by), np.uint64)
            rank[by] = np.arange(len(by), dtype=np.uint64)
            return {"bundle": [(TaskContext.get().partitionId() << 32) + made], "tokens": [size], "docs": [docs],
                    "train": [train], "sizes": [[len(p) for p in parts]],
                    "vocab": [_pack(vocab[by])], "ids": [_pack(rank[ids])]}

        for b in batches:
            for doc, learn, text in zip(b["doc"], b["train"], b["_text"]):
                w = words_of(text)
                h = np.empty(len(w) + 1, np.uint64)
                h[:-1] = np.fromiter(map(words.__getitem__, w), np.uint64, len(w))
                h[-1] = _END
                docs.append(doc)
                train.append(learn)
                parts.append(h)
                size += len(h)
                if size >= PART:
                    yield bundle()
                    made += 1
                    docs, train, parts, size = [], [], [], 0
        if docs:
            yield bundle()

    kind = rows.schema["doc"].dataType.simpleString()
    return map_rows(rows, run, f"bundle long, tokens long, docs array<{kind}>, train array<boolean>, "
                               "sizes array<long>, vocab binary, ids binary")


def _kept(method):
    """Keeps a method's results per order with its object (and no longer)."""
    @functools.wraps(method)
    def get(self, n):
        key = method.__name__, n
        if key not in self.kept:
            self.kept[key] = method(self, n)
        return self.kept[key]
    return get


class _Bundle:
    """Tokens of one bundle, and what was replied to it."""

    def __init__(self, row: dict, order: int, replies: list[dict] = ()):
        self.id, self.docs, self.kept = row["bundle"], row["docs"], {}
        sizes, pad = np.array(row["sizes"], np.int64), order - 1
        self.doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.train = np.array(row["train"], bool)[self.doc]
        self.at = np.arange(len(self.doc)) + pad * (self.doc + 1)
        self.seq = np.full(len(self.doc) + pad * len(sizes), _START, np.uint64)
        self.seq[self.at] = _unpack(row["vocab"])[_unpack(row["ids"])]
        self.replies = sorted(replies, key=lambda r: r["bucket"])

    def keys(self, at: np.ndarray, n: int) -> np.ndarray:
        h = np.zeros(len(at), np.uint64)
        for k in range(n - 1, -1, -1):
            h = (h ^ self.seq[at - k]) * _MIX
            h ^= h >> np.uint64(29)
        return h

    @_kept
    def grams(self, n: int):
        """Sorted distinct n-grams, the first token of each, the n-gram of each token."""
        keys, first, of = np.unique(self.keys(self.at, n), return_index=True, return_inverse=True)
        return keys, first.astype(np.int32), of.astype(np.int32)

    @_kept
    def contexts(self, n: int):
        """Sorted distinct contexts of order n, the context of each token."""
        keys, of = np.unique(self.keys(self.at - 1, n - 1), return_inverse=True)
        return keys, of.astype(np.int32)

    @_kept
    def counts(self, n: int):
        """(corpus count, own) of each distinct n-gram."""
        v = np.concatenate([_unpack(r["a"]) for r in self.replies if r["n"] == n and r["b"] is None])
        return (v >> np.uint64(1)).astype(np.float64), (v & np.uint64(1)).astype(bool)

    @_kept
    def weights(self, n: int):
        """(total, backoff weight) of each distinct context of order n."""
        own = [r for r in self.replies if r["n"] == n and r["b"] is not None]
        return tuple(np.concatenate([_unpack(r[c], np.float64) for r in own]) for c in "ab")

    def probability(self, n: int, tokens: np.ndarray, c: np.ndarray, model: _Numbers) -> np.ndarray:
        """Discounted probability of tokens whose n-gram has the count c > 0."""
        whole = model.whole if n == 1 else self.weights(n)[0][self.contexts(n)[1][tokens]]
        return model.discounted(c, n) / whole


class _Numbers:
    """What every task needs of a model: a few numbers per order."""

    def __init__(self, tally: dict[int, list[int]]):
        none = [0] * _TALLY
        self.discounts = {n: discounts(dict(enumerate(t[:TRUSTED + 1], 1))) for n, t in tally.items()}
        first = tally.get(1, none)
        self.tokens, self.vocabulary = first[-2], first[-1]
        freed = sum(r * k * (1 - d) for r, (k, d) in enumerate(zip(first, self.discounts.get(1, [])), 1))
        self.whole = float(self.tokens + (freed <= 0))
        self.unknown = math.log10((self.whole - self.tokens + freed) / self.whole)

    def discounted(self, c: np.ndarray, n: int) -> np.ndarray:
        d = np.ones(TRUSTED + 2)
        d[1:-1] = self.discounts[n]
        return c * d[np.minimum(c, TRUSTED + 1).astype(np.int64)]


def discounts(count_of: dict[int, int]) -> list[float]:
    """d(1) .. d(TRUSTED) from the counts of counts."""
    n = [count_of.get(r, 0) for r in range(TRUSTED + 2)]
    common = (TRUSTED + 1) * n[TRUSTED + 1] / n[1] if n[1] else 0.0
    out = []
    for r in range(1, TRUSTED + 1):
        d = None
        if n[r] and n[r + 1] and common != 1:
            d = ((r + 1) * n[r + 1] / (n[r] * r) - common) / (1 - common)
        out.append(d if d is not None and 0 < d < 1 else r / (r + 1))
    return out


def _rows_of(batches):
    for b in batches:
        for i in range(len(b["n"])):
            yield {c: v[i] for c, v in b.items()}


def _by_bucket(requests: DataFrame, buckets: int, answer) -> DataFrame:
    """Each bucket's requests of one order together: ``answer(rows)`` yields
    (reply columns) for them, one partition per bucket."""
    def run(batches):
        held = []
        for r in _rows_of(batches):
            if held and held[0]["n"] != r["n"]:
                yield answer(held)
                held = []
            held.append(r)
        if held:
            yield answer(held)

    dealt = requests.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("n")
    return map_rows(dealt, run, _REPLY)


def _merged(rows: list[dict]):
    """Distinct keys of some requests, the key of each entry, the ends of the requests."""
    keys = [_unpack_sorted(r["keys"]) for r in rows]
    ends = np.cumsum([0] + [len(k) for k in keys])
    return (*np.unique(np.concatenate(keys), return_inverse=True), ends)


def _reply(rows: list[dict], keys, a, b, tally, ends, a_out, b_out) -> dict:
    """The bucket's table row, then one reply per request."""
    m = len(rows)
    cut = list(zip(ends[:-1], ends[1:]))
    return {"n": [rows[0]["n"]] * (m + 1), "bucket": [rows[0]["bucket"]] * (m + 1),
            "bundle": [None] + [r["bundle"] for r in rows], "keys": [_pack_sorted(keys)] + [None] * m,
            "a": [_pack(a)] + [_pack(a_out[s:e]) for s, e in cut],
            "b": [None if b is None else _pack(b)] + [None if b is None else _pack(b_out[s:e]) for s, e in cut],
            "tally": [tally] + [None] * m}


def _count(rows: list[dict]) -> dict:
    keys, of, ends = _merged(rows)
    c = np.concatenate([_unpack(r["c"]) for r in rows])
    total = np.bincount(of, c, len(keys)).astype(np.uint64)
    learned = np.nonzero(c)[0][::-1]
    speaker = np.full(len(keys), -1)
    speaker[of[learned]] = learned  # the first request with the key stays
    own = np.zeros(len(of), np.uint64)
    own[speaker[speaker >= 0]] = 1
    seen = total > 0
    tally = np.bincount(np.minimum(total, TRUSTED + 2).astype(np.int64), minlength=TRUSTED + 3)[1:TRUSTED + 2]
    return _reply(rows, keys[seen], total[seen], None, [*tally.tolist(), int(total.sum()), int(seen.sum())],
                  ends, (total[of] << np.uint64(1)) | own, None)


def _weigh(rows: list[dict]) -> dict:
    keys, of, ends = _merged(rows)
    c, freed, lower = (np.bincount(of, np.concatenate([_unpack(r[x], np.float64) for r in rows]), len(keys))
                       for x in ("c", "freed", "lower"))
    total = c + (freed <= 0)
    la = np.log10((total - c + freed) / total / (1 - lower))
    seen = c > 0
    return _reply(rows, keys[seen], total[seen], la[seen], None, ends, total[of], la[of])


def _stage_by_order(df: DataFrame, name: str) -> DataFrame:
    path = stage_dir(df.sparkSession, name)
    df.write.partitionBy("n").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class KatzModel:
    """Model of ``rows(doc, train, _text)`` and the scores of their texts, or of
    ``rows(_text)``, all learned from.  ``counts`` and ``weights_of[n]`` are the
    packed tables; ``probabilities[n]`` and ``weights[n]`` their rows."""

    def __init__(self, rows: DataFrame, order: int = ORDER):
        self.order = order
        if "doc" not in rows.columns:
            rows = rows.select(F.lit(None).cast("long").alias("doc"), F.lit(True).alias("train"), "_text")
        self.kind = rows.schema["doc"].dataType.simpleString()
        self.bundles = stage(_bundles(rows), "bundles")
        tokens = self.bundles.agg(F.sum("tokens")).first()[0] or 0
        buckets = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-tokens // PART))

        def ask(batches):
            for b in batches:
                for i in range(len(b["bundle"])):
                    x = _Bundle({c: v[i] for c, v in b.items()}, order)
                    for n in range(1, order + 1):
                        keys, of = np.unique(x.keys(x.at, n), return_inverse=True)
                        c = np.bincount(of, x.train, len(keys)).astype(np.uint64)
                        yield _slices(n, x.id, keys, buckets, c=c)

        asked = map_rows(self.bundles, ask, "n int, bucket int, bundle long, keys binary, c binary")
        self.counts = _stage_by_order(_by_bucket(asked, buckets, _count), "ngram-counts")
        tables = self.counts.where("bundle IS NULL")
        tally = tables.groupBy("n").agg(*[F.sum(F.col("tally")[i]).alias(f"t{i}") for i in range(_TALLY)]).collect()
        self.numbers = numbers = _Numbers({r["n"]: list(r)[1:] for r in tally})
        self.tokens, self.vocabulary, self.unknown = numbers.tokens, numbers.vocabulary, numbers.unknown
        self.weights_of: dict[int, DataFrame] = {}
        for n in range(2, order + 1):
            asked = self._per_bundle(
                functools.partial(_context_sums, n=n, model=numbers, buckets=buckets),
                "n int, bucket int, bundle long, keys binary, c binary, freed binary, lower binary", n)
            self.weights_of[n] = _stage_by_order(_by_bucket(asked, buckets, _weigh), "backoff-weights")
        self.weights = {n: _unpacked(w.where("bundle IS NULL"), np.float64, "ctx long, total double, la double")
                        for n, w in self.weights_of.items()}
        log = [functools.partial(_probabilities, n=n, model=numbers) for n in range(2, order + 1)]
        one = _unpacked(tables.where("n = 1"), np.uint64, "w long, c double, la double")
        self.probabilities = {
            1: one.select("w", F.log10(self._discounted(1) / F.lit(numbers.whole)).alias("lp")),
            **{n: self._per_bundle(f, "ctx long, w long, lp double", n, n) for n, f in enumerate(log, 2)}}

    def _discounted(self, n: int):
        d = F.col("c")
        for r, x in enumerate(self.numbers.discounts.get(n, []), 1):
            d = F.when(F.col("c") == r, F.lit(r * x)).otherwise(d)
        return d

    def _per_bundle(self, fn, schema: str, n: int, weights: int | None = None) -> DataFrame:
        """``fn(bundle)`` yields columns for each bundle, with the counts replied
        up to order n and the weights up to order ``weights`` (default: below n)."""
        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import StructType

        columns, order = ["n", "bucket", "bundle", "a", "b"], self.order
        told = [self.counts.where(F.col("n") <= n)] + [
            self.weights_of[m] for m in range(2, (n - 1 if weights is None else weights) + 1)]
        replies = reduce(DataFrame.unionByName, [t.where("bundle IS NOT NULL").select(*columns) for t in told])
        arrow = to_arrow_schema(StructType.fromDDL(schema))

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            x = _Bundle(left.to_pylist()[0], order, right.to_pylist())
            parts = [pa.table([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow) for out in fn(x)]
            return pa.concat_tables(parts)

        return self.bundles.groupBy("bundle").cogroup(replies.groupBy("bundle")).applyInArrow(run, schema)

    def score(self) -> DataFrame:
        """(doc, n_tokens, n_known, base_score, score) of every row."""
        return self._per_bundle(
            functools.partial(_scores, order=self.order, model=self.numbers),
            f"doc {self.kind}, n_tokens long, n_known long, base_score double, score double", self.order, self.order)


def _owned(x: _Bundle, n: int):
    """A token of each n-gram the bundle speaks for, and its corpus count."""
    c, own = x.counts(n)
    return x.grams(n)[1][own], c[own]


def _context_sums(x: _Bundle, n: int, model: _Numbers, buckets: int):
    """Requests for the contexts of order n: what this bundle's own n-grams add."""
    keys, of = x.contexts(n)
    token, c = _owned(x, n)
    low = x.counts(n - 1)[0][x.grams(n - 1)[2][token]]
    q = x.probability(n - 1, token, low, model)
    c_, freed, lower = (np.bincount(of[token], v, len(keys)) for v in (c, c - model.discounted(c, n), q))
    yield _slices(n, x.id, keys, buckets, c=c_, freed=freed, lower=lower)


def _probabilities(x: _Bundle, n: int, model: _Numbers):
    token, c = _owned(x, n)
    keys, of = x.contexts(n)
    yield {"ctx": keys[of[token]].view(np.int64), "w": x.keys(x.at[token], 1).view(np.int64),
           "lp": np.log10(x.probability(n, token, c, model))}


def _scores(x: _Bundle, order: int, model: _Numbers):
    m = len(x.docs)
    score, left = np.zeros(len(x.doc)), np.arange(len(x.doc))
    for n in range(order, 0, -1):
        c = x.counts(n)[0][x.grams(n)[2][left]]
        found, rest = left[c > 0], left[c == 0]
        score[found] += np.log10(x.probability(n, found, c[c > 0], model))
        score[rest] += model.unknown if n == 1 else x.weights(n)[1][x.contexts(n)[1][rest]]
        left = rest
    c = x.counts(1)[0][x.grams(1)[2]]
    base = np.log10((c + 0.1) / (model.tokens + 0.1 * (model.vocabulary + 1)))
    yield {"doc": x.docs, "n_tokens": np.bincount(x.doc, minlength=m),
           "n_known": np.bincount(x.doc[c > 0], minlength=m),
           "base_score": np.bincount(x.doc, base, m), "score": np.bincount(x.doc, score, m)}


def _unpacked(table: DataFrame, kind, schema: str) -> DataFrame:
    """Rows of a packed table: key, first value, second value (or null)."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for b in batches:
            for key, v, w in zip(b["keys"], b["a"], b["b"]):
                k = _unpack_sorted(key).view(np.int64)
                yield dict(zip(names, (k, _unpack(v, kind).astype(np.float64),
                                       [None] * len(k) if w is None else _unpack(w, np.float64))))

    return map_rows(table.select("keys", "a", "b"), run, schema)


def score_documents(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select(F.col("doc_id").alias("doc"), (id_remainder(10) != 0).alias("train"),
                       text_or_empty().alias("_text"))
    model = KatzModel(rows, order)
    return model.score().select(
        F.col("doc").alias("doc_id"), (id_remainder(10, "doc") == 0).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
