"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed character 1- to 3-grams per language over all training
rows.  Every task sums its own rows into one vector per language and emits only
the non-zero (language, feature, count) cells, so the shuffle holds at most
tasks x languages x ``dims`` small rows however large the corpus is.  The
log-probability matrix is cut into blocks of about ``LANGUAGES`` languages, of
16384 cells each, which bounds a broadcast; as a rule there is one block.  With
more labels the texts pass the blocks in turn and carry the best language and
the sum of the posterior so far.  Scoring takes each document's
n-gram features, gathers matrix rows and sums them per document with
``np.add.reduceat``: a sparse batch product.

Texts are processed whole, in slices of at most ``SLICE`` characters with an
overlap of n-1, so one very long text needs no more memory than a batch.

Defined cases: a null text, or one without any letter, gets ``und`` with score
0; rows with a null label or text are not learned from; without any training
row every text is ``und``; equal scores go to the alphabetically first
language; repeated rows are each scored; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import free_name, id_remainder, map_rows, stage

DIMS = 1 << 14
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
SLICE = 1 << 18
#: Languages of a block of the matrix (about), and of a task's count vectors.
LANGUAGES = 256
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def _slices(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(code points, row of each, whether a gram may start there) of at most
    about ``SLICE`` characters; a slice repeats the 2 characters after it."""
    ahead = max(ORDERS) - 1
    parts, rows, owned, size = [], [], [], 0

    def flush():
        points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = [len(p) for p in parts]
        row = np.repeat(np.array(rows, np.int64), lengths)
        starts = np.zeros(len(points), bool)
        at = 0
        for n, own in zip(lengths, owned):
            starts[at:at + own] = True
            at += n
        return points, row, starts

    for i, text in enumerate(texts):
        text = text.lower()
        for s in range(0, len(text), SLICE):
            part = text[s:s + SLICE + ahead]
            parts.append(part)
            rows.append(i)
            owned.append(min(SLICE, len(part)))
            size += len(part)
            if size >= SLICE:
                yield flush()
                parts, rows, owned, size = [], [], [], 0
    if parts:
        yield flush()


def _features(points, row, starts, dims):
    """(row, feature) of every n-gram, rows ascending within each order."""
    state = np.zeros(len(points), np.uint32)
    for n in ORDERS:
        m = len(points) - n + 1
        if m <= 0:
            return
        state = (state[:m] ^ points[n - 1:]) * _MIX[(n - 1) % 3]
        state ^= state >> np.uint32(15)
        ok = starts[:m] & (row[:m] == row[n - 1:])
        feature = ((state ^ np.uint32(n * 0x27D4EB2F)) * np.uint32(0x165667B1)) >> np.uint32(8)
        yield row[:m][ok], (feature[ok] & np.uint32(dims - 1)).astype(np.int64)


def train(rows: DataFrame, text: str = "text", label: str = "lang", dims: int = DIMS) -> DataFrame:
    """(lang, feature, n): hashed n-gram counts per language, over all rows
    whose text and label are not null."""
    known = rows.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(
        F.col(text).alias("text"), F.col(label).cast("string").alias("lang"))

    def cells_of(total):
        for k, v in total.items():
            f = np.nonzero(v)[0]
            # a language whose texts are all empty is still known, through feature 0
            f = f if len(f) else np.zeros(1, np.int64)
            yield {"lang": [k] * len(f), "feature": f, "n": v[f]}

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            texts: dict[str, list[str]] = {}
            for k, t in zip(b["lang"], b["text"]):
                texts.setdefault(k, []).append(t)
            langs = sorted(texts)
            for s in range(0, len(langs), LANGUAGES):
                group = langs[s:s + LANGUAGES]
                if len(total.keys() | set(group)) > LANGUAGES:  # as many vectors as a task holds
                    yield from cells_of(total)
                    total = {}
                of = np.repeat(np.arange(len(group)), [len(texts[k]) for k in group])
                sums = np.zeros(len(group) * dims, np.int64)
                for points, row, starts in _slices([t for k in group for t in texts[k]]):
                    for r, f in _features(points, row, starts, dims):
                        sums += np.bincount(of[r] * dims + f, minlength=len(sums))
                for i, k in enumerate(group):
                    part = sums[i * dims:(i + 1) * dims]
                    total[k] = total[k] + part if k in total else part.copy()
        yield from cells_of(total)

    cells = map_rows(known, count, "lang string, feature long, n long")
    return cells.groupBy("lang", "feature").agg(F.sum("n").alias("n"))


def matrix(counts: DataFrame, dims: int = DIMS) -> tuple[list[str], np.ndarray]:
    """Languages in order and their log-probabilities, (dims, languages), of all
    the cells given."""
    cells = counts.groupBy("lang").agg(
        F.collect_list("feature").alias("f"), F.collect_list("n").alias("n")).toArrow()
    by = sorted(zip(*(cells[c].to_pylist() for c in ("lang", "f", "n"))))
    logs = np.zeros((dims, len(by)), np.float64)
    for i, (_, f, n) in enumerate(by):
        v = np.full(dims, SMOOTHING)
        v[np.array(f, np.int64)] += np.array(n, np.float64)
        logs[:, i] = np.log(v / v.sum())
    return [k for k, _, _ in by], logs


def blocks(counts: DataFrame, dims: int = DIMS) -> Iterator[tuple[list[str], np.ndarray]]:
    """The matrix in blocks of about ``LANGUAGES`` languages, dealt by a hash of
    their names and collected one at a time."""
    counts = stage(counts, "language-counts")
    n = max(1, -(-counts.select("lang").distinct().count() // LANGUAGES))
    for i in range(n):
        yield matrix(counts.where(F.pmod(F.xxhash64("lang"), F.lit(n)) == i), dims)


def predict(rows: DataFrame, model, text: str = "text",
            keep: tuple[str, ...] = ("doc_id",),
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``keep`` columns + two named ones: the most probable language under a
    flat prior and its posterior probability.  ``model`` is one block of the
    matrix or several."""
    slot, best, peak, mass = (free_name(n, (*keep, *names)) for n in ("_text", "_best", "_peak", "_mass"))
    kept = [F.col(f"`{c}`") for c in keep]
    state = rows.select(*kept, F.col(text).cast("string").alias(slot), F.lit(None).cast("string").alias(best),
                        F.lit(0.0).alias(peak), F.lit(0.0).alias(mass))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in state.schema)
    shared = None

    def scorer(langs, shared):
        def score(batches):
            logs = shared.value
            for b in batches:
                texts = [t if t is not None and _LETTER.search(t) else "" for t in b[slot]]
                sums = np.zeros((len(texts), len(langs)))
                for points, row, starts in _slices(texts):
                    for r, f in _features(points, row, starts, len(logs)):
                        if len(r):
                            first = np.concatenate([[0], np.nonzero(np.diff(r))[0] + 1])
                            sums[r[first]] += np.add.reduceat(logs[f], first, axis=0)
                here, top = sums.argmax(1), sums.max(1)
                share = np.exp(sums - top[:, None]).sum(1)
                out = [list(b[c]) for c in (best, peak, mass)]
                for i, t in enumerate(texts):
                    if not t:
                        continue
                    lang, p, m = langs[here[i]], float(top[i]), float(share[i])
                    if out[0][i] is not None:  # the posterior's sum over this block and those before
                        old = (-out[1][i], out[0][i])
                        high = max(p, out[1][i])
                        m = m * np.exp(p - high) + out[2][i] * np.exp(out[1][i] - high)
                        lang, p = min((-p, lang), old)[1], high
                    out[0][i], out[1][i], out[2][i] = lang, p, float(m)
                yield {**b, best: out[0], peak: out[1], mass: out[2]}
        return score

    for langs, logs in [model] if isinstance(model, tuple) else model:
        if not langs:
            continue
        if shared is not None:  # written, so that a worker holds one block at a time
            state = stage(state, "language-scores")
            shared.unpersist()
        shared = rows.sparkSession.sparkContext.broadcast(logs)
        state = map_rows(state, scorer(langs, shared), types)
    known = F.col(best).isNotNull()
    return state.select(*kept, F.when(known, F.col(best)).otherwise(UNDETERMINED).alias(names[0]),
                        F.when(known, 1 / F.col(mass)).otherwise(0.0).alias(names[1]))


def learned_rows(docs: DataFrame) -> DataFrame:
    """The labelled rows that may be learned from (crc32 of the id mod 3 is not 1)."""
    return docs.where(id_remainder(3) != 1)


def identify(docs: DataFrame, model) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    rows = docs.select("doc_id", (id_remainder(3) == 1).alias("held_out"), "text")
    return predict(rows, model, keep=("doc_id", "held_out"))


def keep_identified(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Documents whose language can be told: those without any letter, with a
    null text, or with a posterior below ``min_score`` go.  Columns stay."""
    model = blocks(train(learned_rows(docs)))
    names = docs.columns
    pred, score = free_name("lang_pred", names), free_name("score", names)
    # all columns travel through the scorer, so no join is needed afterwards
    scored = predict(docs, model, keep=tuple(names), names=(pred, score))
    return scored.where((F.col(pred) != UNDETERMINED) & (F.col(score) >= min_score)).select(*names)
