from collections import defaultdict
from itertools import combinations

from pyspark.sql import functions as F

from tessera.operators import recommend as C
from tessera.plans.pairs import pairs_within_groups

RATINGS = [(1, 10, 5.0), (1, 11, 3.0), (1, 12, 4.0), (2, 10, 4.0), (2, 11, 2.0),
           (3, 11, 5.0), (3, 12, 1.0), (3, 13, 2.0), (4, 13, 3.0), (4, 10, 1.0)]


def test_pairs_within_groups_split_equals_plain(spark):
    rows = [(g, m) for g in range(5) for m in range(g * 3, g * 3 + 7)]
    df = spark.createDataFrame(rows, "g INT, m INT")
    want = sorted((g, a, b) for g in range(5)
                  for a, b in combinations(sorted(m for gg, m in rows if gg == g), 2))
    for block in (1000, 2, 1):
        got = sorted(tuple(r) for r in pairs_within_groups(df, "g", "m", block=block).collect())
        assert got == want


def brute_item_cf(train, k, n):
    users = defaultdict(dict)
    for u, i, r in train:
        users[u][i] = r
    pop = defaultdict(int)
    co = defaultdict(int)
    for u, items in users.items():
        for i in items:
            pop[i] += 1
        for i in items:
            for j in items:
                if i != j:
                    co[(i, j)] += 1
    sim = defaultdict(dict)
    for (i, j), c in co.items():
        sim[i][j] = c / (pop[i] * pop[j]) ** 0.5
    recs = {}
    for u, watched in users.items():
        rank = defaultdict(float)
        for i, r in watched.items():
            nb = sorted(sim[i].items(), key=lambda x: (-round(x[1], 9), x[0]))[:k]
            for j, s in nb:
                if j not in watched:
                    rank[j] += s * r
        recs[u] = [j for j, _ in sorted(rank.items(), key=lambda x: (-round(x[1], 6), x[0]))[:n]]
    return sim, recs


def test_item_cf_matches_brute_force(spark):
    df = spark.createDataFrame(RATINGS, "user BIGINT, item BIGINT, rating DOUBLE")
    sim_want, recs_want = brute_item_cf(RATINGS, 2, 2)
    sim = C.item_similarity(df)
    got = {(r.i, r.j): r.sim for r in sim.collect()}
    assert got.keys() == {(i, j) for i in sim_want for j in sim_want[i]}
    for (i, j), s in got.items():
        assert abs(s - sim_want[i][j]) < 1e-12
        assert abs(s - got[(j, i)]) < 1e-15          # symmetric
    recs = C.item_cf_recommend(df, sim, k=2, n=2)
    got_recs = defaultdict(list)
    for r in recs.orderBy("user", "rank").collect():
        got_recs[r.user].append(r.item)
    assert {u: v for u, v in got_recs.items()} == {u: v for u, v in recs_want.items() if v}


def test_repeated_ratings_count_once(spark):
    # repeats with the same and with lower ratings change nothing; equal user sets give 1
    repeats = RATINGS + [(1, 10, 5.0), (1, 10, 2.0), (3, 13, 1.0), (4, 13, 3.0)]
    once, more = (spark.createDataFrame(r, "user BIGINT, item BIGINT, rating DOUBLE") for r in (RATINGS, repeats))

    def all_of(df):
        sim = C.item_similarity(df)
        return [sorted(tuple(r) for r in x.collect()) for x in (
            C.item_popularity(df), sim, C.user_similarity(df), C.item_cf_recommend(df, sim, k=2, n=2),
            C.item_cf_recommend_per_rating(df, sim, k=2, n=2))]
    assert all_of(more) == all_of(once)
    same = spark.createDataFrame([(1, 1, 1.0), (1, 1, 1.0), (1, 2, 1.0)], "user BIGINT, item BIGINT, rating DOUBLE")
    assert {r.sim for r in C.item_similarity(same).collect()} == {1.0}


def test_precision_recall_counts(spark):
    recs = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "user BIGINT, item BIGINT")
    train = spark.createDataFrame([(1, 1, 1.0), (2, 1, 1.0), (3, 1, 1.0)],
                                  "user BIGINT, item BIGINT, rating DOUBLE")
    test = spark.createDataFrame([(1, 10, 1.0), (2, 13, 1.0), (2, 14, 1.0), (9, 10, 1.0)],
                                 "user BIGINT, item BIGINT, rating DOUBLE")
    pr = C.precision_recall(C.rec_hits(recs, train, test, n=2)).first()
    assert (pr.hits, pr.rec_count, pr.test_count) == (1, 6, 3)
    assert abs(pr.precision - 1 / 6) < 1e-12 and abs(pr.recall - 1 / 3) < 1e-12


def test_top_n_uses_window_group_limit(spark):
    df = spark.createDataFrame(RATINGS, "user BIGINT, item BIGINT, rating DOUBLE")
    recs = C.item_cf_recommend(df, C.item_similarity(df), k=2, n=2)
    plan = recs._jdf.queryExecution().executedPlan().toString()
    recs.collect()
    plan = recs._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_hot_user_cooccurrence_split_is_exact(spark):
    # user 0 holds most of the rows; with block=4 its pairs are spread over
    # 13 x 13 (user, block, block) keys and must still be counted exactly
    rows = [(0, i, 1.0) for i in range(50)] + [(u, i, 1.0) for u in range(1, 6) for i in range(u, u + 4)]
    df = spark.createDataFrame(rows, "user BIGINT, item BIGINT, rating DOUBLE")
    want = defaultdict(int)
    users = defaultdict(set)
    for u, i, _ in rows:
        users[u].add(i)
    for items in users.values():
        for a in items:
            for b in items:
                if a != b:
                    want[(a, b)] += 1
    got = {(r.a, r.b): r.co for r in C.cooccurrence(df, "user", "item", block=4).collect()}
    assert got == dict(want)


def test_interactions_csv_with_and_without_header(spark, tmp_path):
    from tessera.sources import files as IO
    p = tmp_path / "h.csv"
    p.write_text("userId,movieId,rating,ts\n1,10,4.5,99\n2,11,3.0,98\n")
    got = sorted(tuple(r) for r in IO.read_interactions(spark, str(p), header=True).collect())
    assert got == [(1, 10, 4.5), (2, 11, 3.0)]
    df = spark.createDataFrame(got, "user BIGINT, item BIGINT, rating DOUBLE")
    IO.write_interactions(df, str(tmp_path / "o"), header=False)
    back = sorted(tuple(r) for r in IO.read_interactions(spark, str(tmp_path / "o")).collect())
    assert back == got


def test_one_hot(spark):
    from tessera.sources import files as IO
    df = spark.createDataFrame([(1, "e", "x", "?"), (2, "p", "y", "s")],
                               "row_id BIGINT, class STRING, a STRING, b STRING")
    x, y = IO.one_hot(df, "class", "e")
    assert sorted((r.row_id, r.feature) for r in x.collect()) == [(1, "a=x"), (2, "a=y"), (2, "b=s")]
    assert sorted((r.row_id, r.y) for r in y.collect()) == [(1, 1), (2, -1)]


def test_malformed_lines_fail_the_read(spark, tmp_path):
    import pytest
    from tessera.sources import files as IO
    for n, bad in enumerate(("x7,3,4.0", "2,2,abc", "1,2")):
        p = tmp_path / f"bad{n}"
        p.write_text(f"1,2,3.0\n{bad}\n")
        with pytest.raises(Exception, match="bad "):
            IO.read_interactions(spark, str(p)).collect()


def test_sample_first_cuts_sorted_partitions(spark):
    """Any n, ties and repeated rows included, without one task for the n rows."""
    rows = [((i * 7919) % 40, (i * 31) % 17, float(i % 5)) for i in range(600)]
    df = spark.createDataFrame(rows, "user BIGINT, item BIGINT, rating DOUBLE").repartition(5)
    for n in (0, 1, 37, 299, 600, 1000):
        s = C.sample_first(df, n)
        assert sorted(tuple(r) for r in s.collect()) == sorted(rows)[:n]
        plan = s._jdf.queryExecution().executedPlan().toString()
        assert "Limit" not in plan and "TakeOrdered" not in plan
    assert C.sample_first(df.limit(0), 5).collect() == []


def test_pair_counts_move_lists_and_split_hot_keys(spark):
    """Small buckets, large groups in parts, hot members and small chunks give
    the same counts; only lists are shuffled, never pairs."""
    from tessera.plans import pairs as P
    rows = sorted({(g, (g * 7 + i * i) % 23) for g in range(30) for i in range(g % 9 + 1)} | {(99, i) for i in range(23)})
    groups, n = defaultdict(set), defaultdict(int)
    for g, m in rows:
        groups[g].add(m)
        n[m] += 1
    want = defaultdict(int)
    for members in groups.values():
        for a in members:
            for b in members - {a}:
                want[a, b] += 1
    df = spark.createDataFrame(rows, "g INT, m BIGINT")
    text = df.selectExpr("g", "concat('m', m) AS m")
    for bucket, block, hot in ((10 ** 6, 4096, 10 ** 6), (40, 4, 10 ** 6), (40, 4, 8), (40, 4096, 0)):
        spark.conf.set("tessera.pairs.bucket", bucket)
        spark.conf.set("tessera.pairs.hot", hot)
        try:
            got = {(r.a, r.b): r.co for r in P.pair_counts(df, "g", "m", "a", "b", "co", block=block).collect()}
            sims = P.pair_counts(text, "g", "m", "a", "b", "sim", normed=True, block=block).collect()
        finally:
            spark.conf.unset("tessera.pairs.bucket")
            spark.conf.unset("tessera.pairs.hot")
        assert got == want
        assert {(int(r.a[1:]), int(r.b[1:])): r.sim for r in sims} == {
            (a, b): c / (n[a] * n[b]) ** 0.5 for (a, b), c in want.items()}
    plan = P.pair_counts(df, "g", "m", "a", "b", "co")._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in plan.splitlines() if "Exchange" in x]
    assert moved and "MapInArrow" in plan and "Join" not in plan


def test_pair_chunks_are_bounded_and_exact(monkeypatch):
    import pyarrow as pa
    from tessera.plans import pairs as P
    lists = [[1, 2, 3, 4], [2, 3], [1, 3, 5], [3]]
    batch = pa.RecordBatch.from_pydict({"a": [[1, 3], [3], [3, 5], [3]], "b": lists, "bn": [[7] * len(x) for x in lists]},
                                       pa.schema([("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64())), ("bn", pa.list_(pa.int64()))]))
    for chunk in (1 << 22, 9, 4, 1):
        monkeypatch.setattr(P, "CHUNK", chunk)
        got = [t for a, b, co, _, _ in P._met([batch]) for t in zip(a.to_pylist(), b.to_pylist(), co.tolist())]
        assert sorted(got) == [(1, 2, 1), (1, 3, 1), (1, 4, 1), (3, 1, 2), (3, 2, 2), (3, 4, 1), (3, 5, 1), (5, 1, 1), (5, 3, 1)]


def test_cut_to_nearest_keeps_each_first_k(spark):
    from tessera.plans.pairs import cut_to_nearest
    rows = [(a, b, ((a * 31 + b * 17) % 50) / 50) for a in range(6) for b in range(200)]
    df = spark.createDataFrame(rows, "i BIGINT, j BIGINT, sim DOUBLE").repartition(3)
    cut = cut_to_nearest(df, "i", "sim", 5, 2e-9)
    assert cut.count() < len(rows) / 4

    def first(d):
        from tessera.plans.pairs import top_k_per_group
        return sorted(tuple(r) for r in top_k_per_group(d, "i", [F.col("sim").desc(), F.col("j")], 5).collect())
    assert first(cut) == first(df)


def test_candidates_move_once_and_hot_users_split(spark):
    """One exchange by user serves sums, exclusion and ranking, without an anti
    join; a user with many ratings is dealt by item and gets the same list."""
    rows = [(u, (u * 3 + i * (u + 1)) % 17, float(i % 4 + 1)) for u in range(9) for i in range(6)]
    df = spark.createDataFrame(rows, "user BIGINT, item BIGINT, rating DOUBLE")

    def both():
        sim, near = C.item_similarity(df), C.user_similarity(df)
        return C.item_cf_recommend(df, sim, k=4, n=3), C.user_cf_recommend(df, near, k=4, n=3)
    want = [sorted((r.user, r.item, round(r.score, 9), r.rank) for r in x.collect()) for x in both()]
    assert all(want)
    for x in both():
        plan = x._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftAnti" not in plan
    spark.conf.set("tessera.cf.userRows", "2")
    try:
        assert [sorted((r.user, r.item, round(r.score, 9), r.rank) for r in x.collect()) for x in both()] == want
    finally:
        spark.conf.unset("tessera.cf.userRows")


def test_lists_per_rating_are_cut_before_anything_moves(spark):
    """Neighbours meet the ratings as one value an item; the only ranking that
    moves candidates is the one by user."""
    rows = [(u, (u * 3 + i * (u + 1)) % 17, float(i % 4 + 1)) for u in range(9) for i in range(6)]
    df = spark.createDataFrame(rows, "user BIGINT, item BIGINT, rating DOUBLE")
    sim = C.item_similarity(df)
    near, want = defaultdict(list), []
    for i, j, s in sorted(((r.i, r.j, r.sim) for r in sim.collect()), key=lambda x: (-round(x[2], 9), x[1])):
        near[i].append((j, s))
    lists = defaultdict(list)
    best = {}
    for u, i, r in rows:
        best[u, i] = max(r, best.get((u, i), 0.0))
    for (u, i), r in best.items():
        lists[u] += sorted(((-round(s * r, 6), j, i) for j, s in near[i][:4]))[:3]
    for u, x in lists.items():
        want += [(u, i, j, k + 1) for k, (_, j, i) in enumerate(sorted(x)[:3])]
    recs = C.item_cf_recommend_per_rating(df, sim, k=4, n=3)
    assert sorted((r.user, r.src_item, r.item, r["rank"]) for r in recs.collect()) == sorted(want)
    plan = recs._jdf.queryExecution().optimizedPlan().toString()
    assert sum(x.strip(" +-:").startswith("Window ") for x in plan.splitlines()) == 1


def test_pairs_of_buckets_meet_once_and_parts_hold_members_whole(spark, monkeypatch):
    """A list goes to half of the buckets; the nearest are counted in parts with the same result."""
    from tessera.plans import pairs as P
    rows = sorted({(g, (g * 7 + i * i) % 61) for g in range(80) for i in range(g % 9 + 2)} | {(99, i) for i in range(61)})
    df = spark.createDataFrame(rows, "g INT, m BIGINT")
    n = defaultdict(int)
    for _, m in rows:
        n[m] += 1
    for buckets in (1, 5, 8):
        moved = {}
        for half in (False, True):
            pairs = P._Pairs(df, "g", "m", "a", "b", "co", False, 4096)
            monkeypatch.setattr(pairs, "buckets", buckets)
            small, _ = P._dealt(buckets, half, 0, 1)
            pairs.small = spark.createDataFrame(
                [([(m * 31 % buckets, m, n[m]) for g, m in rows if g == at],) for at in sorted({g for g, _ in rows})],
                "l ARRAY<STRUCT<k: INT, m: BIGINT, n: BIGINT>>")
            blobs = [r.blob for r in pairs.small.mapInArrow(small, "k int, blob binary").collect()]
            moved[half] = sum(len(x) for b in blobs for x in P._runs(bytes(b), P.pa.int64()).column("b").to_pylist())
            got = {(r.a, r.b): r.co for r in pairs.counted(half).collect()}
            want = defaultdict(int)
            for g in {g for g, _ in rows}:
                for a in (of := [m for x, m in rows if x == g]):
                    for b in of:
                        want[a, b] += a != b
            assert got == {p: c for p, c in want.items() if c}
        assert buckets < 5 or moved[True] < 0.75 * moved[False]
    ratings = spark.createDataFrame([(g, m, float((g + m) % 5 + 1)) for g, m in rows], "user BIGINT, item BIGINT, rating DOUBLE")

    def results():
        sim, near = C.item_similarity(ratings), C.user_similarity(ratings)
        return [sorted((r.user, r.item, round(r.score, 9), r["rank"]) for r in x.collect()) for x in (
            C.item_cf_recommend(ratings, sim, 4, 3), C.item_cf_recommend_per_rating(ratings, C.item_similarity(ratings), 4, 3),
            C.user_cf_recommend(ratings, near, 4, 3))]
    want, calls = results(), []
    plain = P._Pairs.counted
    monkeypatch.setattr(P._Pairs, "counted", lambda self, half, *a: calls.append(a[:2]) or plain(self, half, *a))
    settings = {"tessera.pairs.part": "2000", "tessera.pairs.bucket": "1000", "tessera.cf.candidates": "2500", "tessera.pairs.hot": "40"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        assert results() == want
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert max(a[1] for a in calls if a) > 3


def test_a_written_table_leaves_no_shuffle(spark):
    import os
    import time
    from tessera.plans.iterate import written

    def files():
        local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in local for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_") and f.endswith(".data")}
    before = files()
    table = written(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "t")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and table.count() == 7
