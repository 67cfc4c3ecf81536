"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes marks piece boundaries: at block size 2^k a
piece ends wherever the hash has k trailing zero bits, so boundaries depend on
nearby bytes only and those of 2^(k+1) are a subset.  Each piece becomes one of
64 characters.  A fingerprint is ``k:signature at 2^k:signature at 2^(k+1)``;
k starts where about 64 pieces are expected and falls until there are at
least 32 (or k is 0).  Two fingerprints are compared at a block size both
have: the edit distance (insertions and deletions, from a bit-parallel longest
common subsequence) over their lengths.  Where both have 16 characters or more
they must also share a run of a third of the shorter one's, at most seven, as
chance alone makes signatures over 64 characters a fifth alike; shorter ones
are judged by the edit distance alone.

``fingerprint_documents`` also compares every document with an edited copy and
with the next one by id.  Rows are range partitioned and sorted by id, so the
next document is the next row; the first and last row of each partition are
set aside (two rows per partition) and joined afterwards.

Defined cases: a null text counts as empty and equals other empty ones; equal
texts have equal fingerprints and likeness 1; rows that repeat an id are
ordered by a hash of their text; a null id comes first; a single row is its
own next; further columns are ignored; texts are hashed whole, in slices.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_rows, stage, text_or_empty

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
WINDOW = 7
PIECES = 64
MIN_LEVEL = 0
RUN, SHORT = 7, 16
_SLICE = 1 << 20
_TABLE = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)


def _ends(data: np.ndarray, level: int) -> np.ndarray:
    """(2, n): ends of pieces at 2^level or more, and their own levels; only
    positions after a full window count."""
    ends, levels = [], []
    for s in range(0, max(0, len(data) - WINDOW + 1), _SLICE):
        part = _TABLE[data[s:s + _SLICE + WINDOW - 1]]
        n = len(part) - WINDOW + 1
        h = np.zeros(n, np.uint32)
        for j in range(WINDOW):
            h = h * np.uint32(0x01000193) + part[j:j + n]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        at = np.nonzero((h & np.uint32((1 << level) - 1)) == 0)[0]
        low = h[at]
        ends.append(at + s + WINDOW)
        levels.append(np.where(low == 0, 32, np.bitwise_count((low & (~low + np.uint32(1))) - np.uint32(1))))
    if not ends:
        return np.zeros((2, 0), np.int64)
    return np.stack([np.concatenate(ends), np.concatenate(levels).astype(np.int64)])


def _signature(raw: bytes, ends: list[int]) -> str:
    digest, out, at = xxhash.xxh32_intdigest, [], 0
    for e in ends:
        out.append(ALPHABET[digest(raw[at:e]) & 63])
        at = e
    if at < len(raw):
        out.append(ALPHABET[digest(raw[at:]) & 63])
    return "".join(out)


def fingerprint(text: str) -> str:
    raw = text.encode()
    start = max(MIN_LEVEL, (len(raw) // PIECES).bit_length() - 1)
    data = np.frombuffer(raw, np.uint8)
    k = start
    found = _ends(data, k)
    while k > MIN_LEVEL and found.shape[1] < PIECES // 2:
        k = max(MIN_LEVEL, k - 1)
        found = _ends(data, k)
    ends, levels = found
    return f"{k}:{_signature(raw, ends.tolist())}:{_signature(raw, ends[levels > k].tolist())}"


def _common_run(a: str, b: str) -> bool:
    shorter = min(len(a), len(b))
    if shorter < SHORT:
        return True
    n = min(RUN, shorter // 3)
    runs = {a[i:i + n] for i in range(len(a) - n + 1)}
    return any(b[i:i + n] in runs for i in range(len(b) - n + 1))


def _common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one bit of ``a`` per position."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    every = (1 << len(a)) - 1
    v = every
    for c in b:
        u = v & where.get(c, 0)
        v = (v + u | v - u) & every
    return len(a) - v.bit_count()


def signature_likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b or not _common_run(a, b):
        return 0.0
    total = len(a) + len(b)
    distance = total - 2 * _common_subsequence(a, b)
    return 1.0 - distance / total


def likeness(a: str, b: str) -> float:
    """0 to 1: the best over the block sizes both fingerprints have."""
    if a == b:
        return 1.0
    (ka, a1, a2), (kb, b1, b2) = (x.split(":") for x in (a, b))
    sizes_a = {int(ka): a1, int(ka) + 1: a2}
    sizes_b = {int(kb): b1, int(kb) + 1: b2}
    return max((signature_likeness(sizes_a[k], sizes_b[k]) for k in sizes_a.keys() & sizes_b.keys()), default=0.0)


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as many first characters of ``following``."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


_OUT = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def _compared(text: str, fp: str, next_text: str, next_fp: str) -> tuple:
    changed = edited(text, next_text)
    other = fp if changed == text else fingerprint(changed)
    return (len(text), hashlib.sha256(changed.encode()).hexdigest(), fp, other,
            likeness(fp, other), likeness(fp, next_fp))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    rows = docs.select("doc_id", text_or_empty().alias("_text")).withColumn("_tie", F.xxhash64("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    values = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
             "near_edited double, near_next double"
    ordered = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")

    def walk(batches) -> Iterator[dict]:
        part, before = TaskContext.get().partitionId(), None

        def out(ids, kinds, texts, results):
            cols = list(zip(*results)) if results else [()] * len(_OUT)
            return {"doc_id": ids, "_edge": kinds, "_part": [part] * len(ids), "_text": texts,
                    **dict(zip(_OUT, cols))}

        for b in batches:
            ids, results = [], []
            for doc, text in zip(b["doc_id"], b["_text"]):
                fp = fingerprint(text)
                if before is None:
                    yield out([doc], ["first"], [text], [(None, None, fp, None, None, None)])
                else:
                    ids.append(before[0])
                    results.append(_compared(before[1], before[2], text, fp))
                before = (doc, text, fp)
            if ids:
                yield out(ids, ["inner"] * len(ids), [None] * len(ids), results)
        if before is not None:
            yield out([before[0]], ["last"], [before[1]], [(None, None, before[2], None, None, None)])

    walked = stage(map_rows(ordered, walk, f"doc_id {kind}, _edge string, _part int, _text string, {values}"),
                   "fingerprints")
    first = walked.where("_edge = 'first'").select("_part", F.col("_text").alias("_next_text"),
                                                   F.col("fingerprint").alias("_next_fp"))
    # partition numbers only: as many as the sort has partitions
    parts = sorted(r[0] for r in first.select("_part").collect())
    follows = docs.sparkSession.createDataFrame(
        list(zip(parts, parts[1:] + parts[:1])), "_part int, _next int")
    last = (walked.where("_edge = 'last'").select("doc_id", "_part", "_text", F.col("fingerprint").alias("_fp"))
            .join(follows, "_part").drop("_part")
            .join(first.withColumnRenamed("_part", "_next"), "_next"))

    def finish(batches):
        for b in batches:
            done = [_compared(t, f, nt, nf) for t, f, nt, nf in
                    zip(b["_text"], b["_fp"], b["_next_text"], b["_next_fp"])]
            yield {"doc_id": b["doc_id"], **dict(zip(_OUT, zip(*done)))}

    inner = walked.where("_edge = 'inner'").select("doc_id", *_OUT)
    return inner.unionByName(map_rows(last, finish, f"doc_id {kind}, {values}"))
