"""Item-based and user-based collaborative filtering with evaluation metrics.

Everything stays in DataFrames: similarity matrices are (a, b, sim) tables that
are joined, never collected; per-key "sort and take K" is a ``row_number``
window (planned with a partial WindowGroupLimit); "skip what the user has
watched" is a left-anti join.  Co-occurrences are counted by ``pair_counts``,
which moves the users' (or items') lists, not their pairs, and splits hot ones.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.expr import hash_bucket
from tessera.plans.iterate import checkpoint, written, written_parts
from tessera.plans.pairs import nearest_parts, pair_counts, summed_lists, top_k_per_group
from tessera.plans.skew import hot_keys, salt, with_salts

N_SIM = 40   # neighbours per item / user (K)
N_REC = 10   # recommendations per user (N)


# ---------------------------------------------------------------- C2 split
def train_test_split(ratings: DataFrame, k: int = 4, user: str = "user", item: str = "item"):
    """75/25 split by md5(user|item) bucket: bucket 0 is test, the rest train.

    Reproducible across runs, partitionings and engines (``randomSplit`` is
    not: it depends on the partition layout).
    """
    key = F.concat(F.col(user).cast("string"), F.lit("|"), F.col(item).cast("string"))
    b = hash_bucket(key, k)
    return ratings.where(b != 0), ratings.where(b == 0)


def random_split(ratings: DataFrame, weights=(0.75, 0.25), seed: int = 0):
    """The reference's ``randomSplit`` form (depends on partitioning)."""
    return ratings.randomSplit(list(weights), seed=seed)


# ---------------------------------------------------------------- C3 C4 C5
def one_rating(train: DataFrame, user: str = "user", item: str = "item", rating: str = "rating") -> DataFrame:
    """One row per (user, item): of repeated ratings the highest stays."""
    return train.groupBy(user, item).agg(F.max(rating).alias(rating))


def item_popularity(train: DataFrame, item: str = "item", user: str = "user") -> DataFrame:
    """Number of users with a train interaction per item."""
    return train.groupBy(item).agg(F.countDistinct(user).alias("popularity"))


def _pair_counts(train: DataFrame, group: str, member: str, a: str, b: str, value: str,
                 block: int | None = None, normed: bool = False) -> DataFrame:
    """(group, member) is de-duplicated once, into a written table, and counted."""
    return pair_counts(written(train.select(group, member).distinct(), "interactions"), group, member, a, b, value, normed, block)


def cooccurrence(train: DataFrame, group: str, member: str, out=("a", "b"),
                 block: int | None = None) -> DataFrame:
    """Ordered pairs (a, b), a != b, with the number of groups holding both."""
    return _pair_counts(train, group, member, *out, "co", block)


def item_cooccurrence(train: DataFrame, user: str = "user", item: str = "item") -> DataFrame:
    """C4: C[i][j] = users who have both i and j."""
    return cooccurrence(train, user, item, out=("i", "j"))


def user_cooccurrence(train: DataFrame, user: str = "user", item: str = "item") -> DataFrame:
    """C[u][v] = items both u and v have."""
    return cooccurrence(train, item, user, out=("u", "v"))


def _similarity(train: DataFrame, group: str, member: str, a: str, b: str) -> DataFrame:
    return _pair_counts(train, group, member, a, b, "sim", normed=True)


def item_similarity(train: DataFrame, user: str = "user", item: str = "item") -> DataFrame:
    """sim(i, j) = C[i][j] / sqrt(N[i] * N[j]), N = users who have the item."""
    return _similarity(train, user, item, "i", "j")


def user_similarity(train: DataFrame, user: str = "user", item: str = "item") -> DataFrame:
    """sim(u, v) = C[u][v] / sqrt(N[u] * N[v]), N = train items of the user."""
    return _similarity(train, item, user, "u", "v")


def nearest(sim: DataFrame, a: str, b: str, k: int) -> Iterator[DataFrame]:
    """The ``k`` most similar b per a; ties by rounded similarity, then id; in
    parts that hold each a whole.

    Rows that rounding cannot bring back are dropped where they are counted or read, ahead
    of the sort and the shuffle.
    """
    for part in nearest_parts(sim, a, "sim", k, within=2e-9):
        yield top_k_per_group(part, a, [F.round("sim", 9).desc(), F.col(b).asc()], k, "nrank")


def _nearest_lists(sim: DataFrame, a: str, b: str, k: int) -> DataFrame:
    """(a, l): the ``k`` nearest of each a as one list of (b, sim), written part by part."""
    return written_parts((x.groupBy(a).agg(F.collect_list(F.struct(b, "sim")).alias("l")) for x in nearest(sim, a, b, k)),
                         "neighbours")


# ---------------------------------------------------------------- C6 C7 C11
#: Ratings of one user beyond which the user's candidates are dealt over tasks by item.
USER_ROWS = 100_000
#: Candidates that move at once (``tessera.cf.candidates``), that a task gets, and members of a list, about.
CANDIDATES, TASK_CANDIDATES, LIST = 400_000_000, 2_000_000, 256


def _user_parts(df: DataFrame, candidates: int) -> int:
    """Parts of the users whose ``candidates`` move at once."""
    most = int(df.sparkSession.conf.get("tessera.cf.candidates", str(CANDIDATES)))
    return max(1, math.ceil(candidates / most))


def _of_part(part: int, parts: int, user: str = "user"):
    """Whether a user is of a part, by another hash than the one that deals rows over tasks."""
    return F.pmod(F.xxhash64(F.lit("part"), F.col(user)), F.lit(parts)) == part if parts > 1 else F.lit(True)


def _unseen_top(lists: Callable, watched: DataFrame, n: int, candidates: int) -> DataFrame:
    """(user, item, score, rank): the ``n`` best per user of the candidates in
    ``lists(is_mine) -> (user, w, m, s)`` for the users that ``is_mine`` tells, by the sum of w * s (of w where s is
    null) over the entries (m, s), without the (user, item) of ``watched``.

    Lists move by user, with the watched items as marked ones, and are summed up and cut in the tasks; the
    users are taken in parts, so that about ``CANDIDATES`` entries lie on disk at a
    time.  Candidates of a user with very many ratings go by item, too.
    """
    spark = watched.sparkSession
    hot = hot_keys(watched, "user", int(spark.conf.get("tessera.cf.userRows", str(USER_ROWS))))
    parts = _user_parts(watched, candidates)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(candidates / parts / TASK_CANDIDATES))
    own = watched.where("user IS NOT NULL AND item IS NOT NULL").selectExpr(
        "user", "true AS seen", "0D AS w", "array(item) AS m", "CAST(NULL AS ARRAY<DOUBLE>) AS s")

    def scored(part: int) -> DataFrame:
        mine = _of_part(part, parts)
        rows = lists(mine).selectExpr("user", "false AS seen", "CAST(w AS DOUBLE) AS w", "m", "s").unionAll(own.where(mine))
        if not hot.n:
            dealt = rows.withColumn("_q", F.lit(0))
        else:
            rows = with_salts(rows, hot, "user")
            each = (rows.where("_salts > 1").selectExpr("user", "seen", "w", "_salts", "s IS NULL AS none",
                                                        "inline(arrays_zip(m, coalesce(s, transform(m, x -> 1D)))) AS (item, v)")
                    .withColumn("_q", salt("item"))
                    .selectExpr("user", "seen", "w", "array(item) AS m", "IF(none, NULL, array(v)) AS s", "_q"))
            dealt = rows.where("_salts = 1").drop("_salts").withColumn("_q", F.lit(0)).unionByName(each)
        return summed_lists(dealt, "user", "item", "score", n, 2e-6, tasks)

    best = written_parts((scored(part) for part in range(parts)), "scored")
    return top_k_per_group(best, "user", [F.round("score", 6).desc(), F.col("item").asc()], n)


def item_cf_recommend(train: DataFrame, sim: DataFrame, k: int = N_SIM, n: int = N_REC,
                      user: str = "user", item: str = "item",
                      rating: str = "rating") -> DataFrame:
    """For each watched item take its k nearest items, drop watched ones
    (after the cut), score = sum of sim * rating, keep the top n per user.

    Repeated ratings count once.  The neighbours are written before the join
    on the item, so that both its sides are plain reads and a hot item splits.
    Returns (user, item, score, rank).
    """
    nb = _nearest_lists(sim, "i", "j", k)
    watched = written(one_rating(train, user, item, rating).select(
        F.col(user).alias("user"), F.col(item).alias("item"), F.col(rating).alias("r")), "watched")

    def lists(mine):
        return watched.where(mine).join(nb, F.col("item") == F.col("i")).selectExpr("user", "r AS w", "l.j AS m", "l.sim AS s")
    return _unseen_top(lists, watched, n, watched.count() * k)


def item_cf_recommend_per_rating(train: DataFrame, sim: DataFrame, k: int = N_SIM,
                                 n: int = N_REC, user: str = "user", item: str = "item",
                                 rating: str = "rating") -> DataFrame:
    """Every rating (repeated ones count once) yields its own top-n list (k nearest items of the
    rated item, only the item itself skipped, score = sim * rating); a user's
    lists are concatenated and cut to n again.  The same item may occur twice
    and watched items are not removed.  Users whose lists are too many to move at once are taken in parts.

    Returns (user, src_item, item, score, rank).
    """
    # the at most k neighbours of an item are one value: a rating's list is cut in its row
    nb = _nearest_lists(sim, "i", "j", k)
    rows = one_rating(train, user, item, rating).select(F.col(user).alias("user"), F.col(item).alias("src_item"),
                        F.col(rating).alias("r"))

    def best(rows):
        per_row = (rows.join(nb, rows.src_item == nb.i)
                   .selectExpr("user", "src_item", "explode(slice(sort_array(transform(filter(l, x -> x.j <> src_item), "
                               f"x -> struct(-round(x.sim * r, 6) AS o, x.j AS item, x.sim * r AS score))), 1, {int(n)})) AS x")
                   .select("user", "src_item", "x.item", "x.score"))
        return top_k_per_group(per_row, "user",
                               [F.round("score", 6).desc(), F.col("item").asc(),
                                F.col("src_item").asc()], n)
    # an entry of these lists is a row, which takes about three times the room
    parts = _user_parts(train, 3 * n * train.count())
    if parts == 1:
        return best(rows)
    rows = written(rows, "watched")
    return written_parts((best(rows.where(_of_part(part, parts))) for part in range(parts)), "lists")


def user_cf_recommend(train: DataFrame, sim: DataFrame, k: int = N_SIM, n: int = N_REC,
                      user: str = "user", item: str = "item") -> DataFrame:
    """C11: the k most similar users; an unseen item scores the sum of the
    similarities of those neighbours who have it (ratings unused); top n.

    The items of a neighbour move as lists.  Returns (user, item, score, rank).
    """
    near = written_parts((x.select("u", "v", "sim") for x in nearest(sim, "u", "v", k)), "neighbours")
    watched = written(train.select(F.col(user).alias("user"), F.col(item).alias("item")).distinct(), "watched")
    # many items of one user make many lists
    sizes = written(watched.groupBy("user").agg(F.count(F.lit(1)).alias("_n")), "sizes")
    items = written(watched.join(sizes, "user").withColumn("_lists", F.ceil(F.col("_n") / F.lit(float(LIST))))
                    .groupBy(F.col("user").alias("v"), F.expr("pmod(xxhash64(item), _lists)").alias("_list"))
                    .agg(F.collect_list(F.struct("item")).alias("l")).select("v", "l"), "items")

    def lists(mine):
        of = near.select(F.col("u").alias("user"), "v", "sim").where(mine)
        return of.join(items, "v").selectExpr("user", "sim AS w", "l.item AS m", "CAST(NULL AS ARRAY<DOUBLE>) AS s")
    candidates = near.join(sizes.withColumnRenamed("user", "v"), "v").agg(F.sum("_n")).first()[0]
    return _unseen_top(lists, watched, n, candidates or 0)


# ---------------------------------------------------------------- C8
def item_user_index(train: DataFrame, user: str = "user", item: str = "item") -> DataFrame:
    """Inverted table item -> users, as distinct (item, user) rows.

    Neither a list value per item nor a physical clustering by item is built:
    both would put all users of a popular item into one task.  Joins on
    ``item`` use these rows directly.
    """
    return train.select(F.col(item).alias("item"), F.col(user).alias("user")).distinct()


# ---------------------------------------------------------------- C12 - C15
def rec_hits(recs: DataFrame, train: DataFrame, test: DataFrame, n: int = N_REC,
             users: DataFrame | None = None, user: str = "user",
             item: str = "item") -> DataFrame:
    """Per evaluated user: hits, rec_count (= n) and test_count.

    ``users`` defaults to every user with a train row; users present only in
    the test set are not evaluated.
    """
    if users is None:
        users = train.select(F.col(user).alias("user")).distinct()
    test_items = test.select(F.col(user).alias("user"), F.col(item).alias("item")).distinct()
    hits = (recs.select("user", "item")
            .join(test_items, ["user", "item"])
            .groupBy("user").agg(F.count(F.lit(1)).alias("hits")))
    tcount = test_items.groupBy("user").agg(F.count(F.lit(1)).alias("test_count"))
    return (users.join(hits, "user", "left").join(tcount, "user", "left")
            .select("user", F.coalesce("hits", F.lit(0)).alias("hits"),
                    F.lit(n).cast("bigint").alias("rec_count"),
                    F.coalesce("test_count", F.lit(0)).alias("test_count")))


def precision_recall(hits: DataFrame) -> DataFrame:
    """precision = sum hits / sum rec_count, recall = sum hits / sum test_count."""
    return hits.agg(
        F.sum("hits").alias("hits"), F.sum("rec_count").alias("rec_count"),
        F.sum("test_count").alias("test_count")).select(
        "hits", "rec_count", "test_count",
        F.try_divide(F.col("hits").cast("double"), F.col("rec_count")).alias("precision"),
        F.try_divide(F.col("hits").cast("double"), F.col("test_count")).alias("recall"))


def coverage(recs: DataFrame, train: DataFrame, item: str = "item") -> DataFrame:
    """C14: distinct recommended items / distinct train items."""
    a = recs.agg(F.countDistinct("item").alias("rec_items"))
    b = train.select(F.countDistinct(item)).scalar()
    return a.select(
        "rec_items", b.alias("train_items"),
        F.try_divide(F.col("rec_items").cast("double"), F.col("train_items")).alias("coverage"))


def mean_popularity(recs: DataFrame, train: DataFrame, n: int = N_REC, users: DataFrame | None = None,
                    user: str = "user", item: str = "item") -> DataFrame:
    """Sum of ln(1 + popularity) of recommended items / (n * evaluated users)."""
    if users is None:
        users = train.select(F.col(user).alias("user")).distinct()
    pop = item_popularity(train, item, user).withColumnRenamed(item, "item")
    s = (recs.select("item").join(pop, "item")
         .agg(F.sum(F.log1p(F.col("popularity"))).alias("pop_sum")))
    u = users.select(F.count(F.lit(1))).scalar()
    return s.withColumn("n_users", u).select(
        F.coalesce("pop_sum", F.lit(0.0)).alias("pop_sum"),
        (F.col("n_users") * F.lit(n)).alias("rec_count"),
        F.try_divide(F.coalesce("pop_sum", F.lit(0.0)),
                     (F.col("n_users") * F.lit(n)).cast("double")).alias("popularity"))


# ---------------------------------------------------------------- C16
def sample_first(ratings: DataFrame, n: int, order=("user", "item")) -> DataFrame:
    """The first n rows under an explicit order (a sampling operator).

    The rows are range partitioned and sorted, and written once; the row counts
    of the partitions tell in which one the n-th row lies and how many of its
    rows belong.  No task holds more than its own range, however large n is.
    Rows equal in ``order`` follow by their other columns.
    """
    rest = [c for c in ratings.columns if c not in order]
    rows = checkpoint(ratings.repartitionByRange(*order, *rest).sortWithinPartitions(*order, *rest))
    # position in the partition: the low 33 bits of Spark's per-partition counter
    placed = (rows.withColumn("_part", F.spark_partition_id())
              .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    # one number per partition
    sizes = sorted((r["_part"], r["count"]) for r in placed.groupBy("_part").count().collect())
    part, left = len(sizes) and sizes[-1][0] + 1, n
    for at, size in sizes:
        if size >= left:
            part = at
            break
        left -= size
    keep = (F.col("_part") < part) | ((F.col("_part") == part) & (F.col("_at") < left))
    return placed.where(keep).select(*ratings.columns)


def sample_fraction(ratings: DataFrame, fraction: float, key=("user", "item")) -> DataFrame:
    """A reproducible Bernoulli sample by md5 of the key."""
    from tessera.functions.expr import hash_unit
    k = F.concat_ws("|", *[F.col(c).cast("string") for c in key])
    return ratings.where(hash_unit(k) < F.lit(fraction))


def sample_random(ratings: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    """Spark's own Bernoulli sample (seeded, partition dependent)."""
    return ratings.sample(withReplacement=False, fraction=fraction, seed=seed)
