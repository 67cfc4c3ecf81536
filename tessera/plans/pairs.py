"""Skew-safe building blocks: pairs within groups, and per-group top-k.

``pairs_within_groups`` produces, for every group (e.g. a user), every
unordered pair of distinct members (e.g. two items the user rated).  The pairs
are the definition of a co-occurrence count, so they cannot be avoided, but a
hot group must not be handled by a single task: a group with ``m`` members is
cut into ``s = ceil(m / block)`` hash blocks and the pair work is spread over
the ``s * s`` (group, block_a, block_b) keys.  Each member row is replicated
``s`` times, each pair is produced exactly once.  Groups at or under ``block``
members (``s = 1``) are joined exactly like a plain self-join.

``top_k_per_group`` is ``row_number() <= k`` over a window; Spark plans it with
a partial WindowGroupLimit before the shuffle, so every map task forwards only
its own top k rows per group and a hot group never reaches one task whole.

``pair_counts`` counts in how many groups two members meet, without moving a
pair.  The members are dealt over buckets; a bucket gets, of each group, its own
members and the list of the members they meet there, once however many of its members the group
has.  Every pair of a member then lies in one bucket, where numpy counts
it, so what moves are the lists, packed for each bucket as bytes.  Two buckets meet in
one of them, which gives a pair both ways; where the nearest of each member are
wanted (``nearest_parts``) all pairs of a member meet in its own, a part of the
buckets at a time.  Only members of very many groups are counted by
a join and an aggregation, in which map-side combining works for them.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.iterate import checkpoint, written
from tessera.plans.skew import hot_join

# Members per hash block of a group; block^2 pairs per (group, block, block) key.
# A session can override it with the setting ``tessera.pairs.block``.
PAIR_BLOCK = 4096
# Members of a group beyond which ``pair_counts`` cuts its list (the same setting): a batch of lists is held by a task.
LIST_BLOCK = 1024
# List entries that a bucket of ``pair_counts`` gets, about (``tessera.pairs.bucket``).
BUCKET = 8_000_000
# Groups of a member beyond which it is counted by a join (``tessera.pairs.hot``).
HOT_MEMBER = 200_000
# List entries that move at once where pairs are counted part by part (``tessera.pairs.part``).
PART = 1 << 30
# Pairs held at once by a task.
CHUNK = 1 << 22


def pairs_within_groups(df: DataFrame, group: str, member: str, block: int | None = None,
                        left: str = "a", right: str = "b", carry: tuple[str, ...] = ()) -> DataFrame:
    """(group, a, b) for every pair of distinct members a < b of the same group.

    ``df`` must hold each (group, member) once.  Columns named in ``carry``
    come along from both sides, as ``<name>_l`` and ``<name>_r``.  Only groups
    of more than one block are listed (at most rows / block of them) and looked
    up, from a written table, so no join here holds a hot group in one task.
    """
    if block is None:
        block = int(df.sparkSession.conf.get("tessera.pairs.block", str(PAIR_BLOCK)))
    heavy = checkpoint(df.groupBy(group).agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") > block)
                       .select(group, F.ceil(F.col("_m") / F.lit(float(block))).cast("int").alias("_s")))
    rows = (df.join(heavy, group, "left").withColumn("_s", F.coalesce("_s", F.lit(1)))
            .withColumn("_blk", F.pmod(F.xxhash64(member), F.col("_s")).cast("int")))
    fan = F.explode(F.sequence(F.lit(0), F.col("_s") - 1))
    lhs = rows.select(group, F.col(member).alias(left), *[F.col(c).alias(f"{c}_l") for c in carry],
                      F.col("_blk").alias("_lb"), fan.alias("_rb"))
    rhs = rows.select(group, F.col(member).alias(right), *[F.col(c).alias(f"{c}_r") for c in carry],
                      F.col("_blk").alias("_rb"), fan.alias("_lb"))
    return (lhs.join(rhs, [group, "_lb", "_rb"])
            .where(F.col(left) < F.col(right))
            .select(group, left, right, *[f"{c}_{side}" for c in carry for side in "lr"]))


def _setting(df: DataFrame, name: str, default: int) -> int:
    return int(df.sparkSession.conf.get(f"tessera.pairs.{name}", str(default)))


def _flat(lists: list[pa.Array]) -> tuple[pa.ChunkedArray, np.ndarray]:
    """The values of list columns, and the length of each list."""
    lens = np.concatenate([pc.list_value_length(x).to_numpy(zero_copy_only=False) for x in lists])
    return pa.chunked_array([x.flatten() for x in lists]), lens.astype(np.int64)


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for every range, one after the other."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + length, length)


def _met(batches: list[pa.RecordBatch], limit: int | None = None) -> Iterator[tuple]:
    """(a, b, co, na, nb) arrays of a bucket's rows (a, an, b, bn), sorted by a;
    every a comes whole, about CHUNK pairs at a time.  With a ``limit`` the pairs
    with members of other buckets come both ways, but for those of more than
    ``limit`` groups."""
    b_values, b_len = _flat([x.column("b") for x in batches])
    coded = b_values.combine_chunks().dictionary_encode()
    names, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    a_values, a_len = _flat([x.column("a") for x in batches])
    a_codes = pc.index_in(a_values.combine_chunks(), value_set=names).to_numpy(zero_copy_only=False).astype(np.int64)
    of = np.zeros(len(names), np.int64)
    of[codes] = _flat([x.column("bn") for x in batches])[0].combine_chunks().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(a_len)), a_len)
    order = np.argsort(a_codes, kind="stable")
    a_codes, row = a_codes[order], row[order]
    mirrored = np.zeros(len(names), bool)
    if limit is not None:
        mirrored = of <= limit
        mirrored[a_codes] = False
    start, length = (np.cumsum(b_len) - b_len)[row], b_len[row]
    n = len(names)
    firsts = np.flatnonzero(np.r_[True, a_codes[1:] != a_codes[:-1]]) if len(a_codes) else np.zeros(0, np.int64)
    bounds = np.r_[firsts, len(a_codes)]
    before = np.r_[0, np.cumsum(length)]
    at = 0
    while at < len(firsts):
        # the next members with CHUNK pairs, one at least
        to = max(int(np.searchsorted(before[bounds], before[bounds[at]] + CHUNK, "right")) - 1, at + 1)
        lo, hi = bounds[at], bounds[to]
        if before[hi] - before[lo] <= CHUNK:
            key = np.sort(np.repeat(a_codes[lo:hi] * n, length[lo:hi]) + codes[_ranges(start[lo:hi], length[lo:hi])])
            new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            co, (a, b) = np.diff(np.r_[new, len(key)]), np.divmod(key[new], n)
        else:                       # one member of long or many lists, counted part by part
            total = np.zeros(n, np.int64)
            while lo < hi:
                mid = max(int(np.searchsorted(before, before[lo] + CHUNK, "right")) - 1, lo + 1)
                mid = min(mid, hi)
                np.add.at(total, *np.unique(codes[_ranges(start[lo:mid], length[lo:mid])], return_counts=True))
                lo = mid
            b = np.flatnonzero(total)
            a, co = np.full(len(b), a_codes[hi - 1]), total[b]
        other = a != b
        a, b, co = a[other], b[other], co[other]
        yield names.take(pa.array(a)), names.take(pa.array(b)), co, of[a], of[b]
        back = mirrored[b]
        if back.any():
            a, b, co = b[back], a[back], co[back]
            yield names.take(pa.array(a)), names.take(pa.array(b)), co, of[a], of[b]
        at = to


_ZSTD = pa.Codec("zstd", compression_level=1)


def _packed(numbers: list[np.ndarray]) -> bytes:
    """Whole numbers as bytes: each array from its least value on, byte by byte of all, compressed."""
    out = [struct.pack("<q", len(numbers))]
    for x in numbers:
        x = x.astype(np.int64)
        low = int(x.min()) if len(x) else 0
        x = x.view(np.uint64) - np.uint64(low & (1 << 64) - 1)
        width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
        planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T)
        body = _ZSTD.compress(planes.tobytes(), asbytes=True) if len(x) else b""
        out += [struct.pack("<qqqq", low, width, len(x), len(body)), body]
    return b"".join(out)


def _unpacked(data: bytes) -> list[np.ndarray]:
    out, at = [], 8
    for _ in range(struct.unpack_from("<q", data)[0]):
        low, width, n, size = struct.unpack_from("<qqqq", data, at)
        at += 32
        x = np.zeros((n, 8), np.uint8)
        if n:
            x[:, :width] = np.frombuffer(_ZSTD.decompress(data[at:at + size], n * width), np.uint8).reshape(width, n).T
        at += size
        out.append((x.view(np.uint64).reshape(-1) + np.uint64(low & (1 << 64) - 1)).view(np.int64))
    return out


def _blob(a: pa.Array, a_len: np.ndarray, b: pa.Array, b_len: np.ndarray, bn: np.ndarray) -> bytes:
    """Runs of one bucket: the members counted there and those they meet, as bytes."""
    if pa.types.is_signed_integer(b.type):
        return b"n" + _packed([a_len, b_len, bn, a.to_numpy(zero_copy_only=False), b.to_numpy(zero_copy_only=False)])
    sink = pa.BufferOutputStream()
    names = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (a, b)]
    batch = pa.RecordBatch.from_arrays(names, names=["a", "b"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    numbers = _packed([a_len, b_len, bn])
    return b"s" + struct.pack("<q", len(numbers)) + numbers + sink.getvalue().to_pybytes()


def _runs(blob: bytes, kind: pa.DataType) -> pa.RecordBatch:
    """Rows (a, b, bn) of lists."""
    if blob[:1] == b"n":
        a_len, b_len, bn, a, b = _unpacked(blob[1:])
        a, b = pa.array(a).cast(kind), pa.array(b).cast(kind)
    else:
        size = struct.unpack_from("<q", blob, 1)[0]
        a_len, b_len, bn = _unpacked(blob[9:9 + size])
        x = pa.ipc.open_stream(blob[9 + size:]).read_next_batch()
        a, b = x.column("a").flatten(), x.column("b").flatten()

    def lists(lens, values):
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lens)], pa.int32()), values)
    return pa.RecordBatch.from_arrays([lists(a_len, a), lists(b_len, b), lists(b_len, pa.array(bn))], names=["a", "b", "bn"])


def _dealt(buckets: int, half: bool, part: int, parts: int) -> tuple[Callable, Callable]:
    """For mapInArrow: lists ``l`` of (k, m, n) become (k, blob) for the buckets of
    ``part``.  Each member of bucket k meets its whole list, or by ``half`` those of its
    own bucket, of the buckets up to half way round from k, and of none (k null).
    The second function does so for lists of large groups: (k, a) meets each ``l``."""

    def entries(x: pa.RecordBatch):
        """Row, bucket (-1: none), m and n of the entries, by row and bucket."""
        lists = x.column("l")
        each = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        row, l = np.repeat(np.arange(len(each)), each), lists.flatten()
        k = pc.fill_null(pc.struct_field(l, "k"), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.lexsort((k, row))
        return (row[order], k[order], pc.struct_field(l, "m").take(pa.array(order)),
                pc.struct_field(l, "n").to_numpy(zero_copy_only=False)[order])

    def meets(row, k, of_row, of_k):
        """Starts and lengths of the up to three ranges of entries that runs (of_row, of_k) meet."""
        key = row * (buckets + 1) + k + 1

        def at(to, side):
            return np.searchsorted(key, of_row * (buckets + 1) + to + 1, side)
        first, last, none = at(-1, "left"), at(buckets - 1, "right"), np.zeros(len(of_k), np.int64)
        if not half:
            return np.stack([first, none, none], 1), np.stack([last - first, none, none], 1)
        # two buckets just half way round meet in the lower one
        to = of_k + buckets // 2 - ((buckets % 2 == 0) & (of_k >= buckets // 2))
        over = to >= buckets
        mine, some = at(of_k, "left"), at(-1, "right")
        end = np.where(over, last, at(np.minimum(to, buckets - 1), "right"))
        back = np.where(over, at(to - buckets, "right"), some)
        return np.stack([first, mine, some], 1), np.stack([some - first, end - mine, back - some], 1)

    def packed(ks, a, a_start, a_len, m, n, starts, lens):
        here = np.flatnonzero(ks % parts == part)
        total = np.cumsum(lens[here].sum(1))
        lo = 0
        while lo < len(here):
            hi = max(int(np.searchsorted(total, (total[lo - 1] if lo else 0) + CHUNK, "right")), lo + 1)
            runs = here[lo:hi]
            runs = runs[np.argsort(ks[runs], kind="stable")]
            idx, b_len = _ranges(starts[runs].ravel(), lens[runs].ravel()), lens[runs].sum(1)
            av = a.take(pa.array(_ranges(a_start[runs], a_len[runs])))
            bv, bn = m.take(pa.array(idx)), n[idx]
            cuts = np.r_[np.flatnonzero(np.r_[True, ks[runs][1:] != ks[runs][:-1]]), len(runs)]
            a_at, b_at = np.r_[0, np.cumsum(a_len[runs])], np.r_[0, np.cumsum(b_len)]
            blobs = [_blob(av.slice(a_at[s], a_at[e] - a_at[s]), a_len[runs][s:e], bv.slice(b_at[s], b_at[e] - b_at[s]),
                           b_len[s:e], bn[b_at[s]:b_at[e]]) for s, e in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(ks[runs][cuts[:-1]] // parts, pa.int32()), pa.array(blobs, pa.binary())],
                                             names=["k", "blob"])
            lo = hi

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            row, k, m, n = entries(x)
            start = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (k[1:] != k[:-1])]) if len(k) else np.zeros(0, np.int64)
            length = np.diff(np.r_[start, len(k)])
            start, length = start[k[start] >= 0], length[k[start] >= 0]
            yield from packed(k[start], m, start, length, m, n, *meets(row, k, row[start], k[start]))

    def large(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            row, k, m, n = entries(x)
            ks, a = x.column("k").to_numpy(zero_copy_only=False).astype(np.int64), x.column("a")
            a_len = pc.list_value_length(a).to_numpy(zero_copy_only=False).astype(np.int64)
            yield from packed(ks, a.flatten(), np.cumsum(a_len) - a_len, a_len, m, n, *meets(row, k, np.arange(len(ks)), ks))

    return small, large


class _Pairs:
    """What ``pair_counts`` and ``nearest_parts`` read: the lists of the groups, written once."""

    def __init__(self, df: DataFrame, group: str, member: str, a: str, b: str, value: str, normed: bool, block: int | None):
        self.a, self.b, self.value, self.normed = a, b, value, normed
        block = _setting(df, "block", LIST_BLOCK) if block is None else block
        df = df.where(F.col(group).isNotNull() & F.col(member).isNotNull()).select(
            F.col(group).alias("g"), F.col(member).alias("m"))
        self.type = df.schema["m"].dataType
        self.counts = written(df.groupBy("m").agg(F.count(F.lit(1)).alias("n")), "members")
        self.gm = gm = written(df.join(self.counts, "m"), "groups")
        sizes = gm.groupBy("g").agg(F.count(F.lit(1)).alias("_m"))
        entries, largest = sizes.agg(F.sum(F.col("_m").cast("double") * F.col("_m")), F.max("_m")).first()
        self.entries = entries or 0
        size, cores = _setting(df, "bucket", BUCKET), df.sparkSession.sparkContext.defaultParallelism
        # small inputs use the cores there are
        self.buckets = max(1, int(-(-self.entries // size)), int(min(cores, self.entries // (size / 16))))
        self.limit = _setting(df, "hot", HOT_MEMBER)
        self.hot = F.col("n") > self.limit
        bucket = F.when(~self.hot, F.pmod(F.xxhash64("m"), F.lit(self.buckets)).cast("int"))

        def lists(rows, *keys):
            return rows.groupBy(*keys).agg(F.collect_list(F.struct(bucket.alias("k"), "m", "n")).alias("l"))

        if (largest or 0) <= block:
            small, self.large = gm, None
        else:
            heavy = checkpoint(sizes.where(F.col("_m") > block).select(
                "g", F.ceil(F.col("_m") / F.lit(float(block))).cast("int").alias("_s")))
            small, large = gm.join(heavy, "g", "left_anti"), gm.join(heavy, "g")
            # a large group is cut into lists; its members of a bucket meet each of them
            fan = F.explode(F.sequence(F.lit(0), F.col("_s") - 1)).alias("_q")
            mine = (large.where(~self.hot).groupBy("g", "_s", bucket.alias("k")).agg(F.collect_list("m").alias("a"))
                    .select("g", "k", "a", fan))
            parts = lists(large, "g", F.pmod(F.xxhash64("m"), F.col("_s")).cast("int").alias("_q"))
            self.large = mine.join(parts, ["g", "_q"]).select("k", "a", "l")
        self.small = lists(small, "g").select("l")

    def counted(self, half: bool, part: int = 0, parts: int = 1, cut: Callable | None = None) -> DataFrame:
        """(a, b, value) of the members of the buckets of ``part``, each batch through ``cut``."""
        a, b, value, normed, limit = self.a, self.b, self.value, self.normed, self.limit if half else None
        small, large = _dealt(self.buckets, half, part, parts)
        runs = self.small.mapInArrow(small, "k int, blob binary")
        if self.large is not None:
            runs = runs.unionByName(self.large.mapInArrow(large, "k int, blob binary"))
        kind = self.type.simpleString()
        arrow = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64()}.get(kind)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [_runs(blob, arrow) for x in batches for blob in x.column("blob").to_pylist()]
            for x, y, co, na, nb in _met(held, limit) if held else ():
                v = co / np.sqrt((na * nb).astype(np.float64)) if normed else co
                out = pa.RecordBatch.from_arrays([x, y, pa.array(v)], names=[a, b, value])
                out = cut(out) if cut else out
                for i in range(0, out.num_rows, 1 << 16):
                    yield out.slice(i, 1 << 16)

        dealt = runs.repartitionById(math.ceil(self.buckets / parts), F.col("k")).select("blob")
        return dealt.mapInArrow(count, f"`{a}` {kind}, `{b}` {kind}, `{value}` {'double' if normed else 'bigint'}")

    def of_hot(self) -> DataFrame | None:
        """(a, b, value) of the members of very many groups."""
        if not self.counts.where(self.hot).limit(1).count():
            return None
        left = self.gm.select("g", F.col("m").alias("_b"), F.col("n").alias("_nb"))
        right = self.gm.where(self.hot).select("g", F.col("m").alias("_a"), F.col("n").alias("_na"))
        rest = (hot_join(left, right, "g", "_b").where("_a != _b")
                .groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("co"), F.max("_na").alias("_na"), F.max("_nb").alias("_nb")))
        v = F.col("co") / F.sqrt(F.col("_na") * F.col("_nb")) if self.normed else F.col("co")
        return rest.select(F.col("_a").alias(self.a), F.col("_b").alias(self.b), v.alias(self.value))


def pair_counts(df: DataFrame, group: str, member: str, a: str, b: str, value: str, normed: bool = False,
                block: int | None = None) -> DataFrame:
    """(a, b, value) for every ordered pair a != b of members that meet in a
    group: ``co``, the number of those groups, or if ``normed``
    co / sqrt(groups of a * groups of b).

    ``df`` must hold each (group, member) once and be cheap to read.
    """
    pairs = _Pairs(df, group, member, a, b, value, normed, block)
    got, hot = pairs.counted(half=True), pairs.of_hot()
    got = got if hot is None else got.unionByName(hot)
    got._pairs = pairs  # for nearest_parts
    return got


def nearest_parts(df: DataFrame, group: str, value: str, k: int, within: float) -> Iterator[DataFrame]:
    """The rows of ``df`` but for such as cannot be among the first ``k`` of
    ``group`` by ``value`` (see ``cut_to_nearest``), in parts that hold every group whole.

    A fresh table of ``pair_counts`` is counted part by part, all pairs of a member in
    its bucket and cut there, so that few pairs leave the tasks and the lists of one
    part move at a time.
    """
    pairs = getattr(df, "_pairs", None)
    if pairs is None or (pairs.a, pairs.value) != (group, value):
        yield cut_to_nearest(df, group, value, k, within)
        return
    parts = min(pairs.buckets, max(1, math.ceil(pairs.entries / _setting(df, "part", PART))))
    if parts > 1:
        pairs.small = written(pairs.small, "lists")
    for part in range(parts):
        yield pairs.counted(False, part, parts, lambda x: _nearest_rows(x, group, value, k, within))
    hot = pairs.of_hot()
    if hot is not None:
        yield cut_to_nearest(hot, group, value, k, within)


def _nearest_rows(x: pa.RecordBatch, group: str, value: str, k: int, within: float) -> pa.RecordBatch:
    v = x.column(value).to_numpy(zero_copy_only=False)
    g = x.column(group).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    order = np.lexsort((-v, g))
    g = g[order]
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    size = np.diff(np.r_[first, len(g)])
    last = np.repeat(v[order][first + np.minimum(size, k) - 1], size)
    keep = np.ones(len(v), bool)
    keep[order[v[order] < last - within]] = False
    return x.filter(pa.array(keep))


def cut_to_nearest(df: DataFrame, group: str, value: str, k: int, within: float) -> DataFrame:
    """Drop rows that cannot be among their group's first ``k`` by ``value``.

    Each batch keeps, per group, what is not below its own k-th value by more
    than ``within``.  That loses no row of any batch's first k, however rows
    lie; it leaves little where a group's rows lie together.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            yield _nearest_rows(x, group, value, k, within)

    return df.mapInArrow(cut, df.schema)


def top_k_per_group(df: DataFrame, group: str | list[str], order: list, k: int,
                    rank: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows of every group under ``order``; adds ``rank``."""
    w = Window.partitionBy(*([group] if isinstance(group, str) else group)).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def summed_lists(df: DataFrame, group: str, member: str, value: str, k: int, within: float, parts: int) -> DataFrame:
    """(group, member, value) from rows (group, _q, seen, w, m, s): ``value`` is the
    sum of w * s over the entries (m, s) of a group's lists, or of w where s is null.
    Members of a list with ``seen`` are left out, and so are, for each (group, _q), those that
    cannot be among its first ``k`` by ``value`` (see ``cut_to_nearest``).

    Only lists move, to ``parts`` partitions by (group, _q).  A task keeps one sum for each (group, member).
    """
    kinds = [df.schema[c].dataType.simpleString() for c in (group, "_q")] + [df.schema["m"].dataType.elementType.simpleString()]

    def summed(tables: list[pa.Table]) -> pa.Table:
        met = pa.concat_tables(tables).group_by([group, "_q", member], use_threads=False).aggregate(
            [(value, "sum"), ("seen", "any")])
        return met.rename_columns([{f"{value}_sum": value, "seen_any": "seen"}.get(c, c) for c in met.column_names])

    def entries(x: pa.RecordBatch) -> pa.Table:
        lists = x.column("m")
        row = pc.list_parent_indices(lists)
        v = x.column("w").take(row)
        if x.column("s").null_count < x.num_rows:
            v = pc.multiply(v, x.column("s").flatten())
        return pa.table({group: x.column(group).take(row), "_q": x.column("_q").take(row), member: lists.flatten(),
                         value: v, "seen": x.column("seen").take(row)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, most = [], 0, CHUNK
        for x in batches:
            # lists with values of their own, and lists without
            given = pc.is_valid(x.column("s"))
            for part in (x.filter(given), x.filter(pc.invert(given))):
                if part.num_rows:
                    held.append(entries(part))
                    n += held[-1].num_rows
            if n > most:
                held = [summed(held)]
                n = held[0].num_rows
                most = max(CHUNK, 2 * n)
        if not held:
            return
        met = summed(held)
        met = met.filter(pc.invert(met.column("seen"))).select([group, "_q", member, value]).combine_chunks()
        for x in met.to_batches():
            key = pa.StructArray.from_arrays([x.column(group), x.column("_q")], names=["g", "q"])
            codes = _codes(key)
            cut = _nearest_rows(pa.RecordBatch.from_arrays([codes, x.column(value), x.column(group), x.column(member)],
                                                           names=["_g", value, group, member]), "_g", value, k, within)
            cut = cut.select([group, member, value])
            for i in range(0, cut.num_rows, 1 << 16):
                yield cut.slice(i, 1 << 16)

    moved = df.select(group, "_q", "seen", "w", "m", "s").repartition(parts, group, "_q")
    return moved.mapInArrow(run, f"`{group}` {kinds[0]}, `{member}` {kinds[2]}, `{value}` double")


def _codes(key: pa.StructArray) -> pa.Array:
    """A number for each distinct (g, q)."""
    g = key.field("g").dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
    q = key.field("q").to_numpy(zero_copy_only=False).astype(np.int64)
    return pa.array(g * (int(q.max()) + 1 if len(q) else 1) + q)
