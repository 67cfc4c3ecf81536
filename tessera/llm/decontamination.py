"""Benchmark decontamination with suffix arrays over the training texts.

Every slice of a task's documents (some 8 MB of text) is a shard.  A shard's
words become numbers of the benchmark's vocabulary, a word outside it ends any
match, and the shard's suffixes are sorted: by the packed first words, then by
doubling within the groups still equal, up to the longest benchmark item.  All
suffixes of all items are then searched at once: each keeps an interval of the
array, which two binary searches narrow by one word a step.  The interval at
the window's length locates every verbatim occurrence of the window, the last
one before it empties the longest match.  Shards need not meet, so nothing is
shuffled, and an executor's loss costs its own shards.

The benchmark is dealt into parts of about ``PART_BYTES`` of text; each part is
sent to the tasks for one pass over the documents, and with several parts the
passes follow each other through written tables.  An item is never cut.  A
text over ``SHARD`` words is searched in pieces that overlap by the longest
item less one word, so that no match is lost.

Words are maximal runs of ASCII letters (lower-cased), digits and non-ASCII
characters.  A window is ``window`` consecutive words of an item; an item of
fewer words is one window.

Defined cases: a null or empty text or item has no words; a null ``item_id`` is
the empty string; rows that repeat an ``item_id`` are one item in the list,
with all their windows; repeated documents each get the result; without items
nothing is hit; an empty table gives an empty table; further columns are
ignored (``decontaminate`` keeps them).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import free_name, map_rows, stage, text_or_empty

WINDOW = 10
SHARD = 1 << 21  # words of one text that are searched at once
PART_BYTES = 16 << 20
CHUNK = 4 << 20
_WORD = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
#: A-Z to a-z; everything that is not part of a word to a space
_PLAIN = bytes(b | 32 if 65 <= b <= 90 else b if b in _WORD else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_PLAIN).split()


def _chunks(raw: bytes) -> Iterator[bytes]:
    """The bytes, cut at spaces into pieces of about ``CHUNK``."""
    at = 0
    while len(raw) - at > CHUNK:
        cut = raw.rfind(b" ", at, at + CHUNK)
        cut = cut if cut > at else raw.find(b" ", at + CHUNK)
        if cut < 0:
            break
        yield raw[at:cut]
        at = cut
    yield raw[at:] if at else raw


class SuffixArray:
    """Sorted suffixes of ``x`` (numbers from 1, 0 ends a suffix), to ``depth`` words."""

    def __init__(self, x: np.ndarray, top: int, depth: int):
        bits = max(1, int(top).bit_length())
        k = max(1, min(63 // bits, depth))
        self.x = np.concatenate([x, np.zeros(max(depth, k) + 1, x.dtype)])
        at = np.flatnonzero(x)
        key, alive = np.zeros(len(at), np.int64), np.ones(len(at), bool)
        for j in range(k):
            word = self.x[at + j]
            alive &= word > 0
            key = key << bits | np.where(alive, word, 0)
        order = np.argsort(key)
        self.sa = at[order]
        key = key[order]
        first = np.ones(len(at), bool)
        first[1:] = key[1:] != key[:-1]
        place = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        rank = np.zeros(len(self.x) + depth, np.int64)  # 1 + where a suffix's group begins; 0 has ended
        rank[self.sa] = place + 1
        # places in the array whose suffix equals a neighbour's so far and goes on
        size = np.diff(np.append(np.flatnonzero(first), len(at)))
        todo = np.flatnonzero((np.repeat(size, size) > 1) & alive[order])
        done = k
        while done < depth and len(todo):
            here = self.sa[todo]
            group, then = rank[here], rank[here + done]
            by = np.lexsort((then, group))
            here, group, then = here[by], group[by], then[by]
            self.sa[todo] = here
            new = np.ones(len(todo), bool)
            new[1:] = (group[1:] != group[:-1]) | (then[1:] != then[:-1])
            start = np.maximum.accumulate(np.where(new, np.arange(len(todo)), 0))
            rank[here] = todo[start] + 1
            size = np.diff(np.append(np.flatnonzero(new), len(todo)))
            todo = todo[(np.repeat(size, size) > 1) & (then > 0)]
            done *= 2

    def narrow(self, lo: np.ndarray, hi: np.ndarray, depth: int, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The part of each interval whose suffixes have ``word`` at ``depth``."""
        ends = []
        for target in (word, word + 1):
            a, b = lo.copy(), hi.copy()
            while (open_ := a < b).any():
                mid = (a + b) >> 1
                less = open_.copy()
                less[open_] = self.x[self.sa[mid[open_]] + depth] < target[open_]
                a = np.where(less, mid + 1, a)
                b = np.where(open_ & ~less, mid, b)
            ends.append(a)
        return ends[0], ends[1]


class Tests:
    """Items to search for: ids, vocabulary, and the suffixes of all of them."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        items = [(name, words) for name, words in items if words]
        self.names = [name for name, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        numbers, item, length = [], [], []
        for i, (_, words) in enumerate(items):
            numbers += [number(w, len(self.vocabulary) + 1) for w in words] + [0]
            item += [i] * (len(words) + 1)
            length += [min(window, len(words))] * (len(words) + 1)
        self.text = np.array(numbers + [0], np.int32)
        self.item, self.length = np.array(item + [-1], np.int32), np.array(length + [0], np.int32)
        self.starts = np.flatnonzero(self.text)
        self.depth = max((len(words) for _, words in items), default=0)

    def numbers(self, raw: bytes) -> np.ndarray:
        """The words of ``raw`` (plain) as numbers, 0 outside the vocabulary."""
        get, parts = self.vocabulary.get, []
        for piece in _chunks(raw):
            words = piece.split()
            parts.append(np.fromiter((get(w, 0) for w in words), np.int32, len(words)))
        return np.concatenate(parts) if len(parts) > 1 else parts[0]

    def search(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
        """(places, window length, items, longest match at each place) for every
        interval of suffixes of ``x`` that some windows occur at."""
        array = SuffixArray(x, len(self.vocabulary), self.depth)
        sa, best = array.sa, np.zeros(len(array.sa), np.int32)
        which = self.starts
        lo, hi = np.zeros(len(which), np.int64), np.full(len(which), len(sa), np.int64)
        found: dict[tuple[int, int, int], set[int]] = {}
        for depth in range(self.depth + 1):
            word = self.text[which + depth]
            a, b = array.narrow(lo, hi, depth, word)
            a, b = np.where(word > 0, a, lo), np.where(word > 0, b, lo)
            # matches that end here or go on at fewer places only
            over = (depth >= self.length[which]) & ((a != lo) | (b != hi))
            for s, e in {*zip(lo[over].tolist(), hi[over].tolist())}:
                np.maximum(best[s:e], depth, out=best[s:e])
            live = a < b
            which, lo, hi = which[live], a[live], b[live]
            if not len(which):
                break
            whole = np.flatnonzero(self.length[which] == depth + 1)
            for s, e, i in zip(lo[whole].tolist(), hi[whole].tolist(), self.item[which[whole]].tolist()):
                found.setdefault((s, e, depth + 1), set()).add(i)
        for (s, e, n), items in found.items():
            yield sa[s:e], n, np.array(sorted(items)), best[s:e]

    def scan(self, texts: list[str], shard: int = SHARD) -> list[tuple]:
        """Per text: (number of words, hit spans of words, items, longest match)."""
        out = [[0, [], set(), 0] for _ in texts]
        pieces: list[tuple[int, int, np.ndarray]] = []  # (text, first word, numbers)
        held = 0
        for t, text in enumerate(texts):
            x = self.numbers(text.encode().translate(_PLAIN))
            out[t][0] = len(x)
            if not self.depth or not x.any():
                continue
            step = max(shard, 2 * self.depth)
            for s in range(0, len(x), step - self.depth + 1):
                part = x[s:s + step]
                if held + len(part) > step and pieces:
                    self._scan(pieces, out)
                    pieces, held = [], 0
                pieces.append((t, s, part))
                held += len(part)
                if s + step >= len(x):
                    break
        if pieces:
            self._scan(pieces, out)
        return [(n, _joined(spans), sorted(self.names[i] for i in items), longest) for n, spans, items, longest in out]

    def _scan(self, pieces: list[tuple[int, int, np.ndarray]], out: list[list]) -> None:
        gap = np.zeros(1, np.int32)
        x = np.concatenate([part for _, _, p in pieces for part in (p, gap)])
        first = np.cumsum([0] + [len(p) + 1 for _, _, p in pieces])
        hit = np.zeros(len(x) + 1, np.int64)
        for places, n, items, longest in self.search(x):
            np.add.at(hit, places, 1)
            np.add.at(hit, places + n, -1)
            piece = np.searchsorted(first, places, "right") - 1
            for p in np.unique(piece).tolist():
                out[pieces[p][0]][2].update(items.tolist())
            most = np.zeros(len(pieces), np.int32)
            np.maximum.at(most, piece, longest)
            for p in np.flatnonzero(most).tolist():
                entry = out[pieces[p][0]]
                entry[3] = max(entry[3], int(most[p]))
        covered = np.cumsum(hit) > 0
        edge = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0))
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
            p = int(np.searchsorted(first, s, "right")) - 1
            t, offset, _ = pieces[p]
            out[t][1].append((s - int(first[p]) + offset, e - int(first[p]) + offset))


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _parts(benchmark: DataFrame, window: int, part_bytes: int) -> Iterator[Tests]:
    """The items, in parts of about ``part_bytes`` of text."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                            text_or_empty().alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    count = max(1, math.ceil(size / part_bytes))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    for k in range(count):
        yield Tests(((r["item"], words_of(r["text"])) for r in rows.where(part == k).toLocalIterator()), window)


_FOUND = "n_words long, spans array<struct<start:long,end:long>>, items array<string>, longest long"


def match_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard: int = SHARD,
                    part_bytes: int = PART_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, spans of words hit by a window (first,
    end), the items that hit, sorted, and the longest match in words."""
    rows = docs.select("doc_id", text_or_empty().alias("_text")).withColumns({
        "spans": F.lit(None).cast("array<struct<start:long,end:long>>"), "items": F.lit(None).cast("array<string>"),
        "longest": F.lit(0).cast("long")})
    kind = docs.schema["doc_id"].dataType.simpleString()
    context = docs.sparkSession.sparkContext

    def passed(rows: DataFrame, tests: Tests) -> DataFrame:
        sent = context.broadcast(tests)

        def run(batches):
            for b in batches:
                found = sent.value.scan(b["_text"], shard)
                out = {k: [] for k in ("n_words", "spans", "items", "longest")}
                for (n, spans, items, longest), old, had, most in zip(found, b["spans"], b["items"], b["longest"]):
                    spans = _joined([(s["start"], s["end"]) for s in old or ()] + spans)
                    out["n_words"].append(n)
                    out["spans"].append([{"start": s, "end": e} for s, e in spans])
                    out["items"].append(sorted({*(had or ()), *items}))
                    out["longest"].append(max(most, longest))
                yield {"doc_id": b["doc_id"], "_text": b["_text"], **out}

        return map_rows(rows.select("doc_id", "_text", "spans", "items", "longest"), run,
                        f"doc_id {kind}, _text string, {_FOUND}")

    for k, tests in enumerate(_parts(benchmark, window, part_bytes)):
        rows = passed(stage(rows, "decontamination") if k else rows, tests)
    return rows.drop("_text")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document the digest of its matches."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return match_documents(docs, benchmark, window).select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
        F.col("longest").alias("longest_match"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents no window occurs in, with all their columns."""
    row = free_name("_row", docs.columns)
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    hit = match_documents(rows.select(F.col(row).alias("doc_id"), "text"), benchmark, window).where(
        F.size("spans") > 0).select(F.col("doc_id").alias(row))
    return rows.join(hit, row, "left_anti").select(*docs.columns)


#: DuckDB SQL of the query's rows (the longest match aside).
ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), sized AS (
  SELECT item, w, least(10, len(w)) AS n FROM i WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, n, array_to_string(w[p:p + n - 1], ' ') AS words
  FROM (SELECT item, n, w, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS p FROM sized)
), sizes AS (
  SELECT DISTINCT n FROM windows
), places AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS words
  FROM (SELECT doc_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS p FROM d, sizes WHERE len(w) >= n)
), found AS (
  SELECT doc_id, p, places.n, item FROM places JOIN windows ON places.n = windows.n AND places.words = windows.words
), hit AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS word FROM (SELECT DISTINCT doc_id, p, n FROM found)) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN named ON named.doc_id = d.doc_id
"""
