"""Packing: sum-of-squares online packing of token documents into windows.

Every task packs the documents of its own partition as they stream in, so
nothing is shuffled and no state is shared.  A document's ids are cut into
whole windows of ``WINDOW`` and one rest.  The rest goes to the fill level
that minimises the sum over levels of (open windows at that level) squared:
moving a window from level h to h + s changes that sum by
2 (N[h+s] - N[h] + 1), opening a new one by 2 N[s] + 1, and filling one up by
1 - 2 N[h].  The counts live in one level array, so a placement is one
vectorised pass over at most 2048 levels.

Open windows are bounded: when they hold more than ``OPEN_TOKENS`` tokens, and
at the end of the partition, they are emptied into full windows by cutting
their pieces end to end, and the last, partly filled window is cut into
sequences whose lengths are powers of two, which need no padding.

Defined cases: a null text counts as empty; an empty one is its end token
alone; repeated rows are packed each; further columns are ignored.  Sequence
ids are unique within one run: partition number x 2^33 + a counter.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tessera.llm.common import map_rows, text_or_empty

WINDOW = 2048
OPEN_TOKENS = 4 << 20
END_ID = 1
SPECIAL = "<|endoftext|>"
PART = 1 << 16
_BOUNDARY = re.compile(r"\S[ \n]")
_LOADED: dict[str, "Ids"] = {}


def _merge_ranks(model: dict) -> dict[bytes, int] | None:
    """token bytes -> id of a byte-level BPE file, if its ids follow its merges."""
    vocab, merges = model["model"]["vocab"], model["model"]["merges"]
    special = {t["content"] for t in model.get("added_tokens", [])}
    # the byte-level alphabet: printable Latin-1 stands for itself, other bytes for 256, 257, ...
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    byte_of = {chr(b): b for b in own}
    byte_of.update((chr(256 + i), b) for i, b in enumerate(b for b in range(256) if b not in own))
    joined = [m.replace(" ", "", 1) if isinstance(m, str) else "".join(m) for m in merges]
    order = [vocab.get(j, -1) for j in joined]
    if order != sorted(order) or -1 in order:
        return None
    return {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in special}


def _splits_by_default(model: dict) -> bool:
    """Whether the file splits texts by ``public_tokenizers.PATTERN`` and does nothing else to them."""
    split = model.get("pre_tokenizer") or {}
    plain = all(not model["model"].get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "unk_token"))
    return (plain and model.get("normalizer") is None and split.get("type") == "ByteLevel"
            and split.get("use_regex", True) and not split.get("add_prefix_space"))


class Ids:
    """Ids of a text under a byte-level BPE tokenizer file, as uint32 bytes.

    Where the file's ids follow its merges (then the lowest rank is the next
    merge) and it splits by the byte-level pattern, texts are encoded from its
    own merge ranks; other files, and texts that hold the special token's
    string, go to the tokenizer itself.  A boundary before a space or line feed
    that follows a non-space character is always a pre-token boundary, so long
    texts are encoded in parts of about ``PART`` characters.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        ranks = _merge_ranks(model) if _splits_by_default(model) else None
        self.ranked = ranks and tiktoken.Encoding(
            "ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def get(cls, path: str) -> "Ids":
        if path not in _LOADED:
            _LOADED[path] = cls(path)
        return _LOADED[path]

    @staticmethod
    def _parts(text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > PART:
            cut = _BOUNDARY.search(text, at + PART)
            if cut is None:
                break
            yield text[at:cut.start() + 1]
            at = cut.start() + 1
        yield text[at:] if at else text

    def _one(self, text: str) -> bytes:
        return b"".join(self.ranked.encode_to_numpy(p, disallowed_special=()).astype("<u4").tobytes()
                        for p in self._parts(text))

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = [t for t in texts if not self.ranked or SPECIAL in t]
        others = iter([np.array(e.ids, "<u4").tobytes()
                       for e in self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)])
        return [next(others) if not self.ranked or SPECIAL in t else self._one(t) for t in texts]


class Packer:
    """Online packer of one stream of documents."""

    def __init__(self, window: int = WINDOW, open_tokens: int = OPEN_TOKENS, first_id: int = 0):
        self.window, self.limit, self.next_id = window, open_tokens, first_id
        self.levels = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list]] = {}  # level -> windows, each a list of pieces
        self.held = 0

    def _emit(self, pieces) -> Iterator[tuple]:
        at = 0
        for doc, start, ids, total in pieces:
            yield doc, start, len(ids) // 4, zlib.crc32(ids), total, self.next_id, at
            at += len(ids) // 4
        self.next_id += 1

    def choose(self, s: int) -> int:
        """The level to place a rest of s tokens on; 0 opens a window."""
        n, w = self.levels, self.window
        cost = np.full(w - s + 1, np.iinfo(np.int64).max)
        here = n[1:w - s + 1]
        there = n[s + 1:w + 1].copy()
        if w - s >= 1:
            change = 2 * (there - here + 1)
            change[-1] = 1 - 2 * here[-1]  # the window is full and leaves the array
            cost[1:] = np.where(here > 0, change, cost[1:])
        cost[0] = 2 * n[s] + 1
        return int(len(cost) - 1 - cost[::-1].argmin())  # ties: the fullest window

    def add(self, doc, ids: bytes) -> Iterator[tuple]:
        """Place one document's ids; yields the pieces of finished sequences."""
        total, step = len(ids) // 4, 4 * self.window
        whole = len(ids) // step * step
        for k in range(0, whole, step):
            yield from self._emit([(doc, k // 4, ids[k:k + step], total)])
        rest = ids[whole:]
        s = len(rest) // 4
        if not s:
            return
        piece = (doc, whole // 4, rest, total)
        h = self.choose(s)
        if h:
            bin_ = self.open[h].pop()
            self.levels[h] -= 1
            self.held -= h
        else:
            bin_ = []
        bin_.append(piece)
        if h + s == self.window:
            yield from self._emit(bin_)
        else:
            self.levels[h + s] += 1
            self.open.setdefault(h + s, []).append(bin_)
            self.held += h + s
            if self.held > self.limit:
                yield from self.flush()

    def flush(self) -> Iterator[tuple]:
        """Empty all open windows into full ones and powers of two."""
        queue = [p for h in sorted(self.open, reverse=True) for b in self.open[h] for p in b]
        left = sum(len(p[2]) // 4 for p in queue)
        self.open.clear()
        self.levels[:] = 0
        self.held = 0
        current, room = [], 0
        for doc, start, ids, total in queue:
            while ids:
                if not room:
                    room = self.window if left >= self.window else 1 << (left.bit_length() - 1)
                    left -= room
                take = ids[:4 * room]
                current.append((doc, start, take, total))
                ids, start, room = ids[len(take):], start + len(take) // 4, room - len(take) // 4
                if not room:
                    yield from self._emit(current)
                    current = []


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = docs.select("doc_id", text_or_empty().alias("_text"))
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches):
        codec = Ids.get(tokenizer_path)
        context = TaskContext.get()
        packer = Packer(window, first_id=(context.partitionId() if context else 0) << 33)
        for b in batches:
            for k in range(0, len(b["_text"]), 500):
                texts, ids = b["_text"][k:k + 500], b["doc_id"][k:k + 500]
                done = [p for doc, x in zip(ids, codec.encode(texts)) for p in packer.add(doc, x + end)]
                if done:
                    yield dict(zip(names, zip(*done)))
        done = list(packer.flush())
        if done:
            yield dict(zip(names, zip(*done)))

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_rows(rows, run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                               "sequence_id long, offset long")
