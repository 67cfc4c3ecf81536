"""Repeated byte strings: removal of every byte in a 400-byte repeat.

A full suffix array holds eight bytes per byte of text, and difference-cover
sorting moves two thirds of all positions per level; that is several times the
disk this operator may use.  Only equality of fixed-length prefixes matters
here, so the sample of the sort is chosen by content instead of by residue (a
string synchronising set), and the recursion stops at the first level:

* Sampled strings.  Within the positions of a window of ``LENGTH`` bytes, the
  substring of ``SEED`` bytes with the smallest hash names the window.  Equal
  windows have equal names.  Neighbouring windows with one name form a run, one
  row of (name, place, hash of the run's bytes).
* Sort by name.  A run whose name occurs nowhere else cannot repeat and drops
  out; this is nearly all text that does not repeat.
* Names of runs.  Runs with equal bytes repeat as a whole, and are settled
  without looking inside.
* Recursion.  Where runs of one name differ, they (and one representative of
  each settled run) are cut into finer runs, named by longer substrings, and
  settled in the same way; what is still open is compared window by window.

Equality of runs and windows rests on two 64-bit hashes, the name and their own.
Names are counted with map-side combining, and joins read plain written tables, so
Spark can split a name that a third of all rows share.

Defined cases: a null text counts as empty; texts under ``LENGTH`` bytes have
no window; repeats inside one text count, overlapping ones too; rows that
repeat id and text are other documents; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_rows, stage, text_or_empty

LENGTH = 400
NAMING = 96  # candidate positions per window; a name is a substring of LENGTH - NAMING + 1 bytes
FINE = 16  # the same within runs that are still open after the first round
SLICE = 1 << 18
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_TABLES = np.random.default_rng(42).integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def _powers(k: int, inverse: bool, n: int) -> np.ndarray:
    have = _POWERS.get((k, inverse))
    if have is None or len(have) < n:
        base = pow(_BASES[k], -1, 1 << 64) if inverse else _BASES[k]
        have = np.full(max(n, 1024), base, np.uint64)
        have[0] = 1
        _POWERS[k, inverse] = have = np.multiply.accumulate(have)
    return have[:n]


class _Prefix:
    """Hashes of any substring of some bytes, from prefix sums."""

    def __init__(self, data: np.ndarray, k: int):
        self.inverse = _powers(k, True, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLES[k][data] * _powers(k, False, len(data)), out=self.sums[1:])

    def hash(self, starts, ends) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ h >> np.uint64(29)


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours, from minima within blocks of w."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def _slices(raw: bytes, length: int):
    """(first window, bytes) of slices whose windows are those of the text, once each."""
    for s in range(0, len(raw) - length + 1, SLICE):
        yield s, np.frombuffer(raw[s:s + SLICE + length - 1], np.uint8)


def runs_of(raw: bytes, length: int, naming: int):
    """(name, first window, last window, hash, inner, hashes of windows a to b of
    the slice as a function) per run; ``inner`` is 1 where the naming substring
    occurs more than once in the run."""
    seed = length - naming + 1
    for s, data in _slices(raw, length):
        named, whole = _Prefix(data, 0), _Prefix(data, 1)
        at = np.arange(len(data) - seed + 1)
        seeds = named.hash(at, at + seed)
        low = _sliding_min(seeds, naming)
        lo = np.concatenate([[0], np.nonzero(low[1:] != low[:-1])[0] + 1])
        hi = np.concatenate([lo[1:], [len(low)]]) - 1
        inner = (hi - lo >= naming).astype(np.int32)
        for c in range(0, len(lo), 4096):  # occurrences of the name in [lo, hi + naming)
            near = lo[c:c + 4096, None] + np.arange(2 * naming)
            inside = near < np.minimum(hi[c:c + 4096] + naming, len(seeds))[:, None]
            same = seeds[np.minimum(near, len(seeds) - 1)] == low[lo[c:c + 4096]][:, None]
            inner[c:c + 4096] |= (same & inside).sum(1) > 1

        def windows(a, b, whole=whole):
            at = np.arange(a, b + 1)
            return whole.hash(at, at + length).view(np.int64)

        yield low[lo].view(np.int64), lo + s, hi + s, whole.hash(lo, hi + length).view(np.int64), inner, windows


def inner_runs_of(raw: bytes, spans: Iterable[tuple[int, int]], length: int, naming: int):
    """(name, first window, last window, hash, inner, hashes of its windows) of
    the runs inside each span (first, last window)."""
    for a, b in spans:
        part = raw[a:b + length]
        for name, lo, hi, h, inner, windows in runs_of(part, length, naming):
            first = int(lo[0])
            for j in range(len(lo)):
                yield (int(name[j]), a + int(lo[j]), a + int(hi[j]), int(h[j]), int(inner[j]),
                       windows(lo[j] - first, hi[j] - first).astype("<i8").tobytes())


def _span(a: str = "a", b: str = "b"):
    """First window of a span and the number of windows after it as one long, so
    that lists of them stay plain arrays.  With the last window in its lower half,
    all spans of one window would have the same hash in the sets that tasks collect."""
    return F.col(a).cast("long") * F.lit(1 << 32) + (F.col(b) - F.col(a))


def _first_and_last(span: int) -> tuple[int, int]:
    return span >> 32, (span >> 32) + (span & 0xFFFFFFFF)


def _joined_spans(spans: list[int], length: int) -> list[list[int]]:
    """(first byte, end) of the bytes that the spans' windows cover, joined where they meet."""
    packed = np.sort(np.array(spans, np.int64))
    starts = packed >> 32
    ends = np.maximum.accumulate(starts + (packed & 0xFFFFFFFF) + length)
    first = np.concatenate([[0], np.flatnonzero(starts[1:] > ends[:-1]) + 1])
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    return np.stack([starts[first], ends[last]], 1).tolist()


def _stage(df: DataFrame, name: str) -> DataFrame:
    """``stage``, with the shuffles of the write removed as it ends: each is a good
    part of the input, and they would else stay until the driver collects garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return stage(df, name)
    finally:
        conf.set(key, before)


def _settle(runs: DataFrame, carried: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(runs whose bytes occur again, runs still to look into).

    The second part has one run of each class of equal runs, for the names of
    which some run is on its own: as the name decides, only those can still
    share single windows.  A name with a single run can only if the name occurs
    twice within it.
    """
    key = ["name", "h", "len"]
    runs = runs.withColumn("len", F.col("b") - F.col("a"))
    one = F.min(F.struct("doc", "row", "a", "b", *carried)).alias("one")
    classes = _stage(runs.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), F.max("inner").alias("inner"), one), "run-classes")
    settled = runs.join(classes.where("n > 1").select(*key), key, "left_semi").select("doc", "row", "a", "b")
    mixed = _stage(classes.groupBy("name").agg(
        F.min("n").alias("least"), F.count(F.lit(1)).alias("kinds"), F.max("inner").alias("inner"))
        .where("least = 1 AND (kinds > 1 OR inner > 0)").select("name"), "open-names")
    return settled, classes.join(mixed, "name", "left_semi").select("name", "one.*")


def repeated_windows(rows: DataFrame, length: int = LENGTH, naming: int = NAMING, fine: int = FINE) -> DataFrame:
    """(doc, row, a, b): windows a to b of ``rows(doc, row, _text)`` occur at
    another place too."""
    kind = rows.schema["doc"].dataType.simpleString()

    def emit(batches):
        for b in batches:
            for doc, row, text in zip(b["doc"], b["row"], b["_text"]):
                for name, lo, hi, h, inner, _ in runs_of(text.encode(), length, naming):
                    yield {"doc": [doc] * len(lo), "row": [row] * len(lo), "name": name, "a": lo, "b": hi,
                           "h": h, "inner": inner}

    # written once: counting the names and looking them up both read it
    runs = _stage(map_rows(rows, emit, f"doc {kind}, row long, name long, a int, b int, h long, inner int"), "all-runs")
    # names seen twice; the count is combined within each task
    names = _stage(runs.groupBy("name").agg(F.sum(1 + F.col("inner")).alias("n")).where("n > 1").select("name"), "names")
    settled, opened = _settle(_stage(runs.join(names, "name", "left_semi"), "runs"))
    spans = _stage(opened.groupBy("doc", "row").agg(F.collect_list(_span()).alias("spans")), "open-spans")

    def emit_inner(batches):
        names = ("name", "a", "b", "h", "inner", "hashes")
        for b in batches:
            for doc, row, text, spans in zip(b["doc"], b["row"], b["_text"], b["spans"]):
                found = list(zip(*inner_runs_of(text.encode(), map(_first_and_last, spans), length, fine)))
                yield {"doc": [doc] * len(found[0]), "row": [row] * len(found[0]), **dict(zip(names, found))}

    same = [rows["doc"].eqNullSafe(F.col("s.doc")), rows["row"] == F.col("s.row")]
    inside = rows.join(spans.alias("s"), same).select(rows["doc"], rows["row"], "_text", "spans")
    inner = _stage(map_rows(inside, emit_inner, f"doc {kind}, row long, name long, a int, b int, h long, inner int, "
                                                "hashes binary"), "inner-runs")
    again, still = _settle(inner, ("hashes",))

    def explode(batches):
        for b in batches:
            for doc, row, name, a, raw in zip(b["doc"], b["row"], b["name"], b["a"], b["hashes"]):
                h = np.frombuffer(raw, "<i8")
                yield {"doc": [doc] * len(h), "row": [row] * len(h), "name": [name] * len(h), "h": h,
                       "a": np.arange(a, a + len(h))}

    single = _stage(map_rows(still, explode, f"doc {kind}, row long, name long, h long, a int"), "windows")
    twice = _stage(single.groupBy("name", "h").count().where("count > 1").select("name", "h"), "repeated-windows")
    found = single.join(twice, ["name", "h"], "left_semi").select("doc", "row", "a", F.col("a").alias("b"))
    return settled.unionByName(again).unionByName(found)


def remove_repeats(docs: DataFrame, length: int = LENGTH, naming: int = NAMING, fine: int = FINE) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept (bytes
    left) and spans (first byte, end) removed."""
    rows = docs.select(F.col("doc_id").alias("doc"), text_or_empty().alias("_text")).withColumn(
        "row", F.xxhash64("_text"))
    kind = rows.schema["doc"].dataType.simpleString()
    windows = repeated_windows(rows.where(F.octet_length("_text") >= length), length, naming, fine)
    per = windows.groupBy("doc", "row").agg(F.collect_set(_span()).alias("spans"))

    def join_spans(batches):
        for b in batches:
            yield {"doc": b["doc"], "row": b["row"], "gone": [
                [{"start": s, "end": e} for s, e in _joined_spans(spans, length)] for spans in b["spans"]]}

    # joined before they are written and meet the texts: a text can have as many single windows as bytes
    gone = "array<struct<start:long,end:long>>"
    per = _stage(map_rows(per, join_spans, f"doc {kind}, row long, gone {gone}"), "repeats")
    joined = rows.join(per.alias("s"), [rows["doc"].eqNullSafe(F.col("s.doc")), rows["row"] == F.col("s.row")], "left"
                       ).select(rows["doc"], "_text", F.coalesce("gone", F.array().cast(gone)).alias("gone"))

    def cut(batches):
        for b in batches:
            out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "n_kept", "spans")}
            for text, spans in zip(b["_text"], b["gone"]):
                raw = text.encode()
                digest, at = hashlib.sha256(), 0
                places = [(x["start"], x["end"]) for x in spans]
                for s, e in places:
                    digest.update(raw[at:s])
                    at = e
                digest.update(raw[at:])
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(sum(e - s for s, e in places))
                out["n_spans"].append(len(places))
                out["kept_sha256"].append(digest.hexdigest())
                out["n_kept"].append(out["n_bytes"][-1] - out["n_removed"][-1])
                out["spans"].append(spans)
            yield {"doc_id": b["doc"], **out}

    return map_rows(joined, cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                                 f"n_kept long, spans {gone}")
