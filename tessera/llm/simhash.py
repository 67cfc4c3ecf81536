"""SimHash near-duplicates, linked by anchor-point covering.

Fingerprints have 64 bits; two within 3 bits differ by at most one bit in one
of their 32-bit halves.  For each half the anchors are the words whose first
31 bits are codewords of the perfect Hamming code (covering radius 1) and
whose last bit is free, 2^27 in all.  A fingerprint's home is the anchor
nearest to it.  It is replicated to every anchor within covering radius plus
threshold (1 + 1): its home, the 15 codewords at distance two, and its home
with the free bit flipped, so a pair within one bit of each other in a half
always meets at either one's home.  At an anchor every home fingerprint is
compared with all that came there, on all 64 bits.

Equal fingerprints are one row from the start, and an anchor's links leave as
a spanning forest, so a large group of copies never becomes pairs.  Anchors
with many homes are split (``deal_groups``).

Defined cases: a null, empty or blank text has no shingle and fingerprint
zero, and links like any other; fewer words than the shingle length form one
shingle; a null doc_id takes part but never names a component unless all ids
there are null; repeated rows are fingerprinted each.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import deal_groups, groups_of, map_rows, stage, text_or_empty, words_of
from tessera.llm.components import connected_components

SEED = 42
SHINGLE = 3
MAX_BITS = 3
BLOCK = 4096
_HASHES = 1 << 18
#: Parity masks of the Hamming code over bit positions 1 to 31 (bit i of a word is position i + 1).
_CHECKS = [np.uint64(sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1)) for k in range(5)]
_FREE = np.uint64(1 << 31)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = words_of(text)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for s in range(0, n, _HASHES):  # long texts: a bounded number of hashes at once
        part = words[s:min(n, s + _HASHES) + shingle - 1]
        runs = map(b" ".join, zip(*(part[k:] for k in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        h = np.array([digest(r, SEED) for r in runs], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the 64 bits as a signed long."""
    rows = docs.select("doc_id", text_or_empty().alias("_text"))

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b["_text"]], np.uint64)
            yield {"doc_id": b["doc_id"], "fp": fp.view(np.int64)}

    return map_rows(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def _syndrome(word: np.ndarray) -> np.ndarray:
    s = np.zeros(len(word), np.int64)
    for k, mask in enumerate(_CHECKS):
        s |= (np.bitwise_count(word & mask) & 1).astype(np.int64) << k
    return s


def _bit(position: np.ndarray) -> np.ndarray:
    """The word with only this position set; none for position 0."""
    return np.where(position > 0, np.uint64(1) << np.maximum(position - 1, 0).astype(np.uint64), np.uint64(0))


def anchors(fp: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray, bool]]:
    """(half, rows, anchor words, home) for every anchor the fingerprints go to."""
    out, every = [], np.arange(len(fp))
    for half in (0, 1):
        word = (fp >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        s = _syndrome(word)
        near = word ^ _bit(s)
        out += [(half, every, near, True), (half, every, near ^ _FREE, False)]
        off = np.nonzero(s)[0]  # on a codeword there is no other within two bits
        for i in range(1, 32):
            j = s[off] ^ i
            r = off[j > i]  # each pair of positions once; j = 0 is the home
            out.append((half, r, word[r] ^ _bit(np.full(len(r), i)) ^ _bit(s[r] ^ i), False))
    return out


def _forest(fp: np.ndarray, home: np.ndarray, bits: int):
    """Spanning edges of the links between home fingerprints and all others."""
    todo_home, todo_rest = fp[home], np.setdiff1d(fp[~home], fp[home])
    while len(todo_home):
        front, todo_home = [(todo_home[0], True)], todo_home[1:]
        while front:
            x, is_home = front.pop()
            hit = np.bitwise_count(todo_home ^ x) <= bits
            for y in todo_home[hit]:
                yield x, y
                front.append((y, True))
            todo_home = todo_home[~hit]
            if is_home:
                hit = np.bitwise_count(todo_rest ^ x) <= bits
                for y in todo_rest[hit]:
                    yield x, y
                    front.append((y, False))
                todo_rest = todo_rest[~hit]


def links(fps: DataFrame, bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(u, v): links that connect all of ``fps(fp)`` (distinct) within ``bits`` <= 3."""
    if not 0 <= bits <= 3:
        raise ValueError("the covering handles up to 3 differing bits")

    def replicate(all_anchors):
        def run(batches):
            for b in batches:
                fp = np.array(b["fp"], np.int64).view(np.uint64)
                for half, rows, word, home in anchors(fp):
                    if len(rows) and (all_anchors or home):
                        yield {"anchor": (word | np.uint64(half << 32)).view(np.int64),
                               "fp": fp[rows].view(np.int64), "home": np.full(len(rows), home)}
        return run

    def compare(batches):
        for g in groups_of(batches, ("anchor", "_salt")):
            home = np.array(g["home"], bool)
            if not home.any():
                continue
            edges = list(_forest(np.array(g["fp"], np.int64).view(np.uint64), home, bits))
            if edges:
                e = np.array(edges, np.uint64).view(np.int64)
                yield {"u": e[:, 0], "v": e[:, 1]}

    schema = "anchor long, fp long, home boolean"
    dealt = deal_groups(map_rows(fps, replicate(True), schema),
                        map_rows(fps, replicate(False), schema), "anchor", "fp", block)
    return map_rows(dealt, compare, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """Per document: doc_id, fp (long) and component_id, the smallest doc_id
    reachable over fingerprints that differ in at most ``bits`` bits."""
    marked = stage(fingerprints(docs, shingle), "fingerprints")
    classes = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("lo")), "fingerprint-classes")
    found = stage(connected_components(links(classes.select("fp"), bits)), "components")
    named = classes.join(found, classes.fp == found.node, "left").select(
        "fp", "lo", F.coalesce("component", "fp").alias("root"))
    lowest = stage(named.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("lo").alias("component_id")),
                   "component-ids")
    of = stage(named.join(lowest, "root").select("fp", "component_id"), "component-of")
    return marked.join(of, "fp").select("doc_id", "fp", "component_id")


def simhash_documents(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id."""
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """Documents with the smallest doc_id of their group; columns stay.  Rows
    without an id stay, and of rows that repeat an id one stays."""
    kept = near_duplicates(docs).where(F.col("doc_id") == F.col("component_id")).select(
        F.col("doc_id").alias("_kept")).distinct()
    rows = docs.dropDuplicates(["doc_id"]) if "doc_id" in docs.columns else docs
    named = rows.where(F.col("doc_id").isNotNull()).join(kept, F.col("doc_id") == F.col("_kept"), "left_semi")
    return named.unionByName(docs.where(F.col("doc_id").isNull())).select(*docs.columns)
