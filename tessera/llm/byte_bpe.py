"""Byte-level BPE: overlapping chunk encoding, stitched at common boundaries.

A text of at most ``CHUNK`` characters is one chunk.  A longer one is cut into
windows that repeat ``OVERLAP`` characters of their neighbours; windows are
rows of their own, so one very long text is encoded by many tasks.  Every
window is pre-tokenised from its own first character.  That may start in the
middle of a pre-token, but the pattern has no look-behind: as soon as two
neighbouring windows share a boundary, they agree from there on.  Stitching
takes the first boundary common to both in the overlap (the last two
boundaries of a window do not count, as they depend on text behind it).  Where
two windows share none, the text from the last stitched point to the end of
the next window is pre-tokenised again in one go, so any text comes out right.

Pre-tokens are encoded through a bounded cache of piece -> ids; decoding looks
up each id's raw bytes and concatenates them.

Defined cases: a null text counts as empty and has no tokens; repeated rows
are encoded each; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_rows, text_or_empty

CHUNK = 32768
OVERLAP = 512
CACHE = 150_000
_LOADED: dict[tuple[str, str], "Codec"] = {}


class _Cache(dict):
    """piece -> its ids as little-endian uint32 bytes; emptied when full."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece):
        ids = np.array(self.encode(piece), "<u4").tobytes()
        if len(piece) <= 64:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """One rank file and split pattern, loaded once per Python worker."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.cache = _Cache(self.encoding._encode_single_piece)

    @classmethod
    def get(cls, ranks_path: str, pattern: str) -> "Codec":
        key = (ranks_path, pattern)
        if key not in _LOADED:
            _LOADED[key] = cls(*key)
        return _LOADED[key]

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def encode_pieces(self, pieces: list[str]) -> bytes:
        return b"".join(map(self.cache.__getitem__, pieces))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def stitch(windows: list[tuple[int, str, list[int], bytes, list[int]]], codec: Codec) -> bytes:
    """Ids of the text covered by consecutive windows (first character, text,
    ends of its pre-tokens near both edges, counted from there, ids, ids up to
    each of these ends)."""
    out: list[bytes] = []
    at, skip = 0, 0  # position from which the current window is right, and its ids before that
    for k, (lo, text, ends, ids, upto) in enumerate(windows):
        if k + 1 == len(windows):
            out.append(ids[4 * skip:])
            break
        nlo, ntext, nends, nids, nupto = windows[k + 1]
        mine = {lo + e: n for e, n in zip(ends[:-2], upto) if lo + e >= at}
        common = next(((nlo + e, n) for e, n in zip([0, *nends[:-2]], [0, *nupto])
                       if nlo + e in mine), None)
        if common is None:
            # no agreement in the overlap: redo both as one window
            joined = text[:nlo - lo] + ntext
            start = at - lo
            pieces = codec.pieces(joined[start:])
            ids2 = codec.encode_pieces(pieces)
            e2 = np.cumsum([len(p) for p in pieces], dtype=np.int64) + start
            u2 = np.cumsum([len(codec.cache[p]) // 4 for p in pieces], dtype=np.int64)
            windows[k + 1] = (lo, joined, e2.tolist(), ids2, u2.tolist())
            skip = 0
            continue
        out.append(ids[4 * skip:4 * mine[common[0]]])
        at, skip = common
    return b"".join(out)


def _digests(ids: bytes, codec: Codec) -> tuple[int, str, str]:
    numbers = np.frombuffer(ids, "<u4").tolist()
    return (len(numbers), hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest(),
            hashlib.sha256(codec.decode(numbers)).hexdigest())


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, digest: bool = False,
                     chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Per document: doc_id and its ids (array of int), or with ``digest``
    n_tokens, ids_sha256 and decoded_sha256 after decoding the ids again."""
    rows = docs.select("doc_id", text_or_empty().alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    result = f"doc_id {kind}, " + ("n_tokens long, ids_sha256 string, decoded_sha256 string"
                                   if digest else "ids array<int>")

    def finish(doc_ids, ids, codec):
        if not digest:
            return {"doc_id": doc_ids, "ids": [np.frombuffer(x, "<i4").tolist() for x in ids]}
        n, a, b = zip(*(_digests(x, codec) for x in ids))
        return {"doc_id": doc_ids, "n_tokens": n, "ids_sha256": a, "decoded_sha256": b}

    def whole(batches):
        codec = Codec.get(ranks_path, pattern)
        for b in batches:
            yield finish(b["doc_id"], [codec.encode_pieces(codec.pieces(t)) for t in b["_text"]], codec)

    short = map_rows(rows.where(F.length("_text") <= chunk), whole, result)

    # a long text: windows [i*chunk - overlap, (i+1)*chunk + overlap)
    long = rows.where(F.length("_text") > chunk)
    n = F.ceil(F.length("_text") / F.lit(float(chunk))).cast("int")
    windows = (long.select("doc_id", F.xxhash64("_text").alias("_key"), "_text",
                           F.explode(F.sequence(F.lit(0), n - 1)).alias("_i"))
               .select("doc_id", "_key", "_i",
                       F.greatest(F.lit(0), F.col("_i") * chunk - overlap).alias("_lo"),
                       F.expr(f"substring(_text, greatest(0, _i * {chunk} - {overlap}) + 1, "
                              f"(_i + 1) * {chunk} + {overlap} - greatest(0, _i * {chunk} - {overlap}))")
                       .alias("_window"))
               .repartition("doc_id", "_key", "_i"))

    def window(batches):
        codec = Codec.get(ranks_path, pattern)
        for b in batches:
            out = {"_ends": [], "_ids": [], "_upto": []}
            for text in b["_window"]:
                pieces = codec.pieces(text)
                parts = [codec.cache[p] for p in pieces]
                ends = np.cumsum([len(p) for p in pieces], dtype=np.int32)
                upto = np.cumsum([len(p) // 4 for p in parts], dtype=np.int32)
                # a neighbour shares 2 * overlap characters at most: no other boundary can be common
                shared = (ends <= 2 * overlap) | (ends >= len(text) - 2 * overlap)
                out["_ends"].append(ends[shared].tobytes())
                out["_upto"].append(upto[shared].tobytes())
                out["_ids"].append(b"".join(parts))
            yield {**{c: b[c] for c in ("doc_id", "_key", "_i", "_lo", "_window")}, **out}

    encoded = map_rows(windows, window, f"doc_id {kind}, _key long, _i int, _lo int, _window string, "
                                        "_ends binary, _upto binary, _ids binary")

    def join(group):
        import pandas as pd
        codec = Codec.get(ranks_path, pattern)
        group = group.sort_values("_i", kind="stable")
        copies = int((group["_i"] == 0).sum())  # repeated rows have repeated windows
        group = group.drop_duplicates("_i")
        ids = stitch([(int(lo), w, np.frombuffer(e, np.int32).tolist(), i, np.frombuffer(u, np.int32).tolist())
                      for lo, w, e, u, i in zip(group["_lo"], group["_window"], group["_ends"],
                                                group["_upto"], group["_ids"])], codec)
        first = group["doc_id"].iloc[0]
        return pd.DataFrame(finish([None if first is None or first != first else first] * copies,
                                   [ids] * copies, codec))

    stitched = encoded.groupBy("doc_id", "_key").applyInPandas(join, result)
    return short.unionByName(stitched)
