"""Named queries: each callable takes (spark, sf_dir) and returns a DataFrame.

This is the registry ``__spark_entry__.queries()`` exposes.  Every query reads
the whole test tables (or inputs Spark derives from them).  Floating-point
outputs are rounded (6 places; 9 for the small PageRank scores) so that an
engine summing in another order produces the same digits.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tessera.operators import text as T
from tessera.plans.iterate import written
from tessera.session import ensure_checkpoint_dir
from tessera.sources import tables as S

QUERIES = {}


def query(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


# ====================================================================== text
def _tokens(spark, d):
    return T.tokenize(S.documents(spark, d))


def _corpus_tfidf(spark, d):
    return T.corpus_tfidf(S.documents(spark, d))


@query("text_tokens")
def q_text_tokens(spark, d):
    return _tokens(spark, d)


@query("term_frequency")
def q_term_frequency(spark, d):
    return T.term_frequency(_tokens(spark, d))


@query("doc_term_frequency")
def q_doc_term_frequency(spark, d):
    return T.term_frequency(_tokens(spark, d), by=("doc_id",))


@query("inverse_document_frequency")
def q_idf(spark, d):
    return T.term_stats(S.documents(spark, d)).select("term", r6(F.col("idf")).alias("idf"))


@query("tfidf")
def q_tfidf(spark, d):
    return _corpus_tfidf(spark, d).select("term", "tf", r6(F.col("tfidf")).alias("tfidf"))


@query("top_terms_tf")
def q_top_terms_tf(spark, d):
    return T.top_terms(T.term_frequency(_tokens(spark, d)), "tf")


@query("top_terms_tfidf")
def q_top_terms_tfidf(spark, d):
    scores = _corpus_tfidf(spark, d).select("term", r6(F.col("tfidf")).alias("tfidf"))
    return T.top_terms(scores, "tfidf")


@query("cosine_similarity")
def q_cosine(spark, d):
    """Cosine between each language's TF-IDF profile and the whole corpus's."""
    sim = T.group_cosine_to_corpus(S.documents(spark, d), "lang")
    return sim.select("lang", r6(F.col("cosine")).alias("cosine"))


@query("scores_roundtrip")
def q_scores_roundtrip(spark, d):
    """Write the corpus TF-IDF scores as typed parquet and read them back."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, f"scores-{uuid.uuid4().hex}")
    T.write_scores(_corpus_tfidf(spark, d), path, val="tfidf")
    back = T.read_scores(spark, path)
    return back.select("term", r6(F.col("val")).alias("val"))


# ===================================================================== graph
from tessera.operators import graph as G  # noqa: E402


def r9(c):
    return F.round(c, 9)


@query("graph_out_edges")
def q_graph_out_edges(spark, d):
    return G.out_edges(S.link_edges(spark, d))


@query("graph_nodes")
def q_graph_nodes(spark, d):
    return G.graph_nodes(S.supply_edges(spark, d))


@query("graph_degree")
def q_graph_degree(spark, d):
    return G.degree(S.part_supplier(spark, d))


@query("pagerank")
def q_pagerank(spark, d):
    pr = G.pagerank(S.supply_edges(spark, d), mode="standard")
    return pr.select("node", r9(F.col("score")).alias("score"))


@query("pagerank_reference")
def q_pagerank_reference(spark, d):
    pr = G.pagerank(S.supply_edges(spark, d), mode="reference")
    return pr.select("node", r9(F.col("score")).alias("score"))


@query("pagerank_links")
def q_pagerank_links(spark, d):
    pr = G.pagerank(S.link_edges(spark, d), mode="standard")
    return pr.select("node", r9(F.col("score")).alias("score"))


@query("pagerank_nations")
def q_pagerank_nations(spark, d):
    """Parallel edges: every line item is one customer-nation -> supplier-nation edge."""
    pr = G.pagerank(S.nation_edges(spark, d), mode="reference")
    return pr.select("node", r9(F.col("score")).alias("score"))


@query("wl_coloring")
def q_wl_coloring(spark, d):
    return G.wl_coloring(S.place_tree(spark, d))


@query("wl_coloring_part_supplier")
def q_wl_coloring_ps(spark, d):
    return G.wl_coloring(S.part_supplier(spark, d))


@query("color_classes")
def q_color_classes(spark, d):
    e = S.part_supplier(spark, d)
    return G.color_classes(G.wl_coloring(e), G.wl_coloring(S.relabel(e)))


@query("isomorphism_relabelled")
def q_iso_relabelled(spark, d):
    e = S.part_supplier(spark, d)
    return G.isomorphism_test(G.wl_coloring(e), G.wl_coloring(S.relabel(e)))


@query("isomorphism_edge_removed")
def q_iso_edge_removed(spark, d):
    e = S.part_supplier(spark, d)
    return G.isomorphism_test(G.wl_coloring(e), G.wl_coloring(S.relabel(S.drop_one_edge(e))))


@query("isomorphism_tree")
def q_iso_tree(spark, d):
    e = S.place_tree(spark, d)
    return G.isomorphism_test(G.wl_coloring(e), G.wl_coloring(S.relabel(e)))


# ============================================================ recommenders
from tessera.operators import recommend as C  # noqa: E402
from tessera.sources import files as IO  # noqa: E402

ITEM_K, USER_K, TOP_N = 40, 20, 10


def _split(spark, d):
    """Train/test split of the ratings.  The ratings (a join and aggregation
    of the two largest tables) feed four to six branches of every CF plan,
    each pruned differently, so they are written once in the shared
    folder instead of being recomputed per branch."""
    return C.train_test_split(written(S.ratings(spark, d), "ratings"))


def _item_recs(spark, d):
    train, test = _split(spark, d)
    recs = C.item_cf_recommend(train, C.item_similarity(train), ITEM_K, TOP_N)
    return train, test, recs


def _user_recs(spark, d):
    train, test = _split(spark, d)
    recs = C.user_cf_recommend(train, C.user_similarity(train), USER_K, TOP_N)
    return train, test, recs


@query("read_interactions")
def q_read_interactions(spark, d):
    """Write the ratings as header-less CSV and read them back with a schema."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"ratings-{uuid.uuid4().hex}")
    IO.write_interactions(S.ratings(spark, d), path, header=False)
    back = IO.read_interactions(spark, path, header=False)
    return back.select("user", "item", r6(F.col("rating")).alias("rating"))


@query("train_test_split")
def q_train_test_split(spark, d):
    train, test = _split(spark, d)
    return (train.select("user", "item", F.lit("train").alias("part"))
            .unionByName(test.select("user", "item", F.lit("test").alias("part"))))


@query("item_popularity")
def q_item_popularity(spark, d):
    train, _ = _split(spark, d)
    return C.item_popularity(train)


@query("item_cooccurrence")
def q_item_cooccurrence(spark, d):
    train, _ = _split(spark, d)
    return C.item_cooccurrence(train)


@query("item_similarity")
def q_item_similarity(spark, d):
    train, _ = _split(spark, d)
    return C.item_similarity(train).select("i", "j", r6(F.col("sim")).alias("sim"))


@query("item_similarity_lines")
def q_item_similarity_lines(spark, d):
    """Item similarity over order lines as they are, repeated pairs included."""
    return C.item_similarity(S.rating_lines(spark, d)).select("i", "j", r6(F.col("sim")).alias("sim"))


@query("item_cf_recommend")
def q_item_cf_recommend(spark, d):
    _, _, recs = _item_recs(spark, d)
    return recs.select("user", "item", r6(F.col("score")).alias("score"), "rank")


@query("item_cf_hits")
def q_item_cf_hits(spark, d):
    train, test, recs = _item_recs(spark, d)
    return C.rec_hits(recs, train, test, TOP_N)


@query("item_cf_precision_recall")
def q_item_cf_pr(spark, d):
    train, test, recs = _item_recs(spark, d)
    pr = C.precision_recall(C.rec_hits(recs, train, test, TOP_N))
    return pr.select("hits", "rec_count", "test_count", r6(F.col("precision")).alias("precision"),
                     r6(F.col("recall")).alias("recall"))


@query("item_cf_coverage")
def q_item_cf_coverage(spark, d):
    train, _, recs = _item_recs(spark, d)
    cov = C.coverage(recs, train)
    return cov.select("rec_items", "train_items", r6(F.col("coverage")).alias("coverage"))


@query("item_cf_popularity")
def q_item_cf_popularity(spark, d):
    train, _, recs = _item_recs(spark, d)
    p = C.mean_popularity(recs, train, TOP_N)
    return p.select(r6(F.col("pop_sum")).alias("pop_sum"), "rec_count",
                    r6(F.col("popularity")).alias("popularity"))


@query("item_cf_per_rating")
def q_item_cf_per_rating(spark, d):
    """Per-rating top-N lists merged per user; totals of hits, recs and test items."""
    train, test = _split(spark, d)
    recs = C.item_cf_recommend_per_rating(train, C.item_similarity(train), ITEM_K, TOP_N)
    users = recs.select("user").distinct()
    pr = C.precision_recall(C.rec_hits(recs, train, test, TOP_N, users=users))
    return pr.select("hits", "rec_count", "test_count")


@query("item_user_index")
def q_item_user_index(spark, d):
    train, _ = _split(spark, d)
    return C.item_user_index(train)


@query("user_cooccurrence")
def q_user_cooccurrence(spark, d):
    train, _ = _split(spark, d)
    return C.user_cooccurrence(train)


@query("user_similarity")
def q_user_similarity(spark, d):
    train, _ = _split(spark, d)
    return C.user_similarity(train).select("u", "v", r6(F.col("sim")).alias("sim"))


@query("user_cf_recommend")
def q_user_cf_recommend(spark, d):
    _, _, recs = _user_recs(spark, d)
    return recs.select("user", "item", r6(F.col("score")).alias("score"), "rank")


@query("user_cf_precision_recall")
def q_user_cf_pr(spark, d):
    train, test, recs = _user_recs(spark, d)
    pr = C.precision_recall(C.rec_hits(recs, train, test, TOP_N))
    return pr.select("hits", "rec_count", "test_count", r6(F.col("precision")).alias("precision"),
                     r6(F.col("recall")).alias("recall"))


@query("user_cf_coverage")
def q_user_cf_coverage(spark, d):
    train, _, recs = _user_recs(spark, d)
    cov = C.coverage(recs, train)
    return cov.select("rec_items", "train_items", r6(F.col("coverage")).alias("coverage"))


@query("user_cf_popularity")
def q_user_cf_popularity(spark, d):
    train, _, recs = _user_recs(spark, d)
    p = C.mean_popularity(recs, train, TOP_N)
    return p.select(r6(F.col("pop_sum")).alias("pop_sum"), "rec_count",
                    r6(F.col("popularity")).alias("popularity"))


@query("sample_first")
def q_sample_first(spark, d):
    s = C.sample_first(S.ratings(spark, d), 20000)
    return s.select("user", "item", r6(F.col("rating")).alias("rating"))


@query("sample_fraction")
def q_sample_fraction(spark, d):
    s = C.sample_fraction(S.ratings(spark, d), 0.2)
    return s.select("user", "item", r6(F.col("rating")).alias("rating"))


# ===================================================================== ridge
from tessera.operators import ridge as R  # noqa: E402
from tessera.operators import logistic as L  # noqa: E402
from tessera.functions.expr import hash_bucket, hash_unit  # noqa: E402

RIDGE_BETA = [0.5, 0.1, -0.2]
RIDGE_LAM = 0.1


@query("read_dense")
def q_read_dense(spark, d):
    """Write the price rows as header-less CSV and read them back as (x, y)."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"dense-{uuid.uuid4().hex}")
    rows = S.price_rows(spark, d)
    rows.select(*[F.col("x")[i].alias(f"c{i}") for i in range(3)], "y").write.csv(path)
    back = IO.read_dense(spark, path, 4)
    # single IEEE operations, identical in every engine: compared unrounded
    return back.select(*[F.col("x")[i].alias(f"x{i}") for i in range(3)], "y")


@query("ridge_objective")
def q_ridge_objective(spark, d):
    o = R.ridge_objective(S.price_rows(spark, d), RIDGE_BETA, RIDGE_LAM)
    return o.select(r6(F.col("objective")).alias("objective"))


@query("ridge_gradient")
def q_ridge_gradient(spark, d):
    g = R.ridge_gradient(S.price_rows(spark, d), RIDGE_BETA, RIDGE_LAM)
    return g.select("idx", r6(F.col("grad")).alias("grad"))


@query("ridge_line_search")
def q_ridge_line_search(spark, d):
    data = S.price_rows(spark, d)
    g = [r["grad"] for r in R.ridge_gradient(data, RIDGE_BETA, RIDGE_LAM).orderBy("idx").collect()]
    t = R.ridge_line_search(data, RIDGE_BETA, g, RIDGE_LAM)
    return spark.createDataFrame([(round(t, 6),)], "step DOUBLE")


@query("ridge_train")
def q_ridge_train(spark, d):
    """Gradient descent from zeros, lambda 0.1, <= 100 steps, eps 0.01."""
    m = R.ridge_train_df(S.price_rows(spark, d), lam=RIDGE_LAM, max_iter=100, eps=0.01)
    return m.select("idx", r6(F.col("beta")).alias("beta"), r6(F.col("grad_norm")).alias("grad_norm"),
                    "iterations")


@query("ridge_predict")
def q_ridge_predict(spark, d):
    p = R.ridge_predict(S.price_rows(spark, d), RIDGE_BETA)
    return p.select("y", (F.col("yhat") + F.lit(0.0)).alias("yhat"))


@query("ridge_mse")
def q_ridge_mse(spark, d):
    return R.ridge_mse(S.price_rows(spark, d), RIDGE_BETA).select(r6(F.col("mse")).alias("mse"))


@query("ridge_gradient_check")
def q_ridge_gradient_check(spark, d):
    g = R.gradient_check(S.price_rows(spark, d), RIDGE_BETA, RIDGE_LAM)
    return g.select("idx", F.round("numeric", 4).alias("numeric"),
                    F.round("analytic", 4).alias("analytic"))


@query("ridge_model_roundtrip")
def q_ridge_model_roundtrip(spark, d):
    """Train on 3/4 of the line items (md5 of order|line), save beta as parquet,
    load it back and report the held-out MSE."""
    rows = S.price_rows_keyed(spark, d)
    held = hash_bucket(F.concat(F.col("l_orderkey").cast("string"), F.lit("|"),
                                F.col("l_linenumber").cast("string")), 4) == 0
    beta, _, _ = R.ridge_train(rows.where(~held), lam=RIDGE_LAM)
    path = os.path.join(ensure_checkpoint_dir(spark), f"beta-{uuid.uuid4().hex}")
    IO.save_dense_model(spark, beta, path)
    back = IO.load_dense_model(spark, path)
    return R.ridge_mse(rows.where(held), back).select(r6(F.col("mse")).alias("mse"))


# ================================================================== logistic
def _sparse(spark, d):
    return S.sparse_rows(spark, d)


def _beta_hash(x):
    f = L.feature_universe(x)
    return f.select("feature", ((hash_unit(F.col("feature")) - F.lit(0.5)) * F.lit(0.02))
                    .alias("value"))


LOGIT_LAM = 1.0


@query("read_sparse")
def q_read_sparse(spark, d):
    """Write the sparse rows as JSON lines and read them back in long form."""
    x, y = _sparse(spark, d)
    path = os.path.join(ensure_checkpoint_dir(spark), f"sparse-{uuid.uuid4().hex}")
    IO.write_sparse(x, y, path)
    bx, by = IO.read_sparse(spark, path)
    return bx.join(by, "row_id").select("y", "feature", "value")


@query("feature_universe")
def q_feature_universe(spark, d):
    x, _ = _sparse(spark, d)
    return L.feature_universe(x)


@query("sparse_dot")
def q_sparse_dot(spark, d):
    x, y = _sparse(spark, d)
    return L.sparse_dot(x, _beta_hash(x), y).select("row_id", r6(F.col("z")).alias("z"))


@query("sparse_combine")
def q_sparse_combine(spark, d):
    """beta - 0.001 * (feature totals over the positive rows)."""
    x, y = _sparse(spark, d)
    pos = (x.join(y.where(F.col("y") == 1), "row_id").groupBy("feature")
           .agg(F.sum("value").alias("value")))
    c = L.sparse_combine(_beta_hash(x), pos, "sub", 1.0, 0.001)
    return c.select("feature", r6(F.col("value")).alias("value"))


@query("logistic_loss")
def q_logistic_loss(spark, d):
    x, y = _sparse(spark, d)
    return L.logistic_loss(x, y, _beta_hash(x), LOGIT_LAM).select(r6(F.col("loss")).alias("loss"))


@query("logistic_gradient")
def q_logistic_gradient(spark, d):
    x, y = _sparse(spark, d)
    g = L.logistic_gradient(x, y, _beta_hash(x), LOGIT_LAM)
    return g.select("feature", r6(F.col("value")).alias("grad"))


@query("logistic_line_search")
def q_logistic_line_search(spark, d):
    x, y = _sparse(spark, d)
    x = written(x, "sparse")
    b = written(_beta_hash(x), "beta")
    t = L.logistic_line_search(x, y, b, L.logistic_gradient(x, y, b, LOGIT_LAM), LOGIT_LAM)
    return spark.createDataFrame([(round(t, 9),)], "step DOUBLE")


def _logistic_train(spark, d):
    """Train on 3/4 of the labelled documents, the others ride along as test rows."""
    x, y = _sparse(spark, d)
    x = written(x, "sparse")  # the training and the test rows are both taken from it
    is_test = hash_unit(F.col("row_id").cast("string")) < F.lit(0.25)
    return L.logistic_train(x, y.where(~is_test), lam=LOGIT_LAM, test=(x, y.where(is_test)))


def _share(part, whole):
    return round(part / whole, 6) if whole else None


@query("logistic_train")
def q_logistic_train(spark, d):
    """Train (lambda 1, up to 100 steps, eps 0.01); the test rows' metrics afterwards."""
    _, gnorm, k, history = _logistic_train(spark, d)
    tp, fp, tn, fn = history[-1][4:]
    return spark.createDataFrame(
        [(tp, fp, tn, fn, _share(tp + tn, tp + fp + tn + fn), k, round(gnorm, 6))],
        "tp LONG, fp LONG, tn LONG, fn LONG, accuracy DOUBLE, iterations INT, grad_norm DOUBLE")


@query("logistic_train_steps")
def q_logistic_train_steps(spark, d):
    """The same training step by step: loss and gradient norm before each step,
    its size, and accuracy, precision and recall of the test rows after it."""
    history = _logistic_train(spark, d)[3]
    return spark.createDataFrame(
        [(k, round(loss, 5), round(gnorm, 5), round(t, 9), _share(tp + tn, tp + fp + tn + fn), _share(tp, tp + fp),
          _share(tp, tp + fn)) for k, loss, gnorm, t, tp, fp, tn, fn in history],
        "k INT, loss DOUBLE, grad_norm DOUBLE, step DOUBLE, accuracy DOUBLE, precision DOUBLE, recall DOUBLE")


@query("classification_metrics")
def q_classification_metrics(spark, d):
    x, y = _sparse(spark, d)
    m = L.classification_metrics(x, y, _beta_hash(x))
    return m.select("tp", "fp", "tn", "fn", r6(F.col("accuracy")).alias("accuracy"),
                    r6(F.col("precision")).alias("precision"), r6(F.col("recall")).alias("recall"))


@query("logistic_gradient_check")
def q_logistic_gradient_check(spark, d):
    x, y = _sparse(spark, d)
    g = L.logistic_gradient_check(x, y, _beta_hash(x), LOGIT_LAM)
    return g.select("feature", F.round("numeric", 3).alias("numeric"),
                    F.round("analytic", 3).alias("analytic"))


# ============================================================ factorization
from tessera.operators import factorization as M  # noqa: E402

MF_D, MF_SEED = 10, 1234567


def _mf_ratings(spark, d):
    """Ratings scaled into unit range (divided by 50) for factorization."""
    return S.ratings(spark, d).select("user", "item", (F.col("rating") / 50.0).alias("rating"))


def _long(P, kind):
    return M.profiles_long(P, kind).select("kind", "id", "k", r9(F.col("value")).alias("value"))


@query("mf_read_ratings")
def q_mf_read_ratings(spark, d):
    path = os.path.join(ensure_checkpoint_dir(spark), f"mf-{uuid.uuid4().hex}")
    IO.write_interactions(_mf_ratings(spark, d), path)
    back = IO.read_ratings(spark, path)
    return back.select("user", "item", r9(F.col("rating")).alias("rating"))


@query("mf_init_profiles")
def q_mf_init_profiles(spark, d):
    r = written(_mf_ratings(spark, d), "mf-ratings")
    # profiles are written before their elements become rows: else each row draws its vector anew
    U, V = written(M.init_user_profiles(r, MF_D, MF_SEED), "users"), written(M.init_item_profiles(r, MF_D, MF_SEED), "items")
    return _long(U, "U").unionByName(_long(V, "V"))


@query("mf_predict")
def q_mf_predict(spark, d):
    r = _mf_ratings(spark, d)
    U, V = M.init_user_profiles(r, MF_D, MF_SEED), M.init_item_profiles(r, MF_D, MF_SEED)
    return M.predict_ratings(r, U, V).select("user", "item", r9(F.col("delta")).alias("delta"))


@query("mf_objective")
def q_mf_objective(spark, d):
    r = _mf_ratings(spark, d)
    U, V = M.init_user_profiles(r, MF_D, MF_SEED), M.init_item_profiles(r, MF_D, MF_SEED)
    j = M.predict_ratings(r, U, V)
    se, nu, nv = M.squared_error(j), M.profile_norm(U, 1.0), M.profile_norm(V, 1.0)
    return spark.range(1).select(r6(se).alias("se"), r6(nu).alias("norm_u"), r6(nv).alias("norm_v"),
                                 r6(se + nu + nv).alias("objective"))


@query("mf_adapt")
def q_mf_adapt(spark, d):
    """One update of U and V from the initial profiles (gain 0.001, lam = mu = 1)."""
    r = written(_mf_ratings(spark, d), "mf-ratings")
    U, V = written(M.init_user_profiles(r, MF_D, MF_SEED), "users"), written(M.init_item_profiles(r, MF_D, MF_SEED), "items")
    j = M.predict_ratings(r, U, V)
    return (_long(M.adapt_users(j, U, 0.001, 1.0, MF_D), "U")
            .unionByName(_long(M.adapt_items(j, V, 0.001, 1.0, MF_D), "V")))


@query("mf_train")
def q_mf_train(spark, d):
    """20 rounds on the whole ratings table (test = train): objective and RMSE per round."""
    _, _, hist = M.mf_train(_mf_ratings(spark, d), d=MF_D, seed=MF_SEED)
    return spark.createDataFrame([(i, round(o, 6), round(e, 6)) for i, o, e in hist],
                                 "iteration INT, objective DOUBLE, test_rmse DOUBLE")


@query("mf_cross_validate")
def q_mf_cross_validate(spark, d):
    """5 folds by md5(user|item), 20 rounds each: held-out RMSE per fold, and the mean."""
    cv = M.mf_cross_validate(_mf_ratings(spark, d), folds=5, d=MF_D, seed=MF_SEED)
    return cv.select("fold", r6(F.col("test_rmse")).alias("test_rmse"), r6(F.col("mean_rmse")).alias("mean_rmse"))


@query("mf_save_profiles")
def q_mf_save_profiles(spark, d):
    """Train on all ratings, save U and V as parquet, read them back."""
    U, V, _ = M.mf_train(_mf_ratings(spark, d), d=MF_D, seed=MF_SEED)
    base = os.path.join(ensure_checkpoint_dir(spark), f"profiles-{uuid.uuid4().hex}")
    IO.save_profiles(U, base + "_U")
    IO.save_profiles(V, base + "_V")
    U2, V2 = IO.load_profiles(spark, base + "_U"), IO.load_profiles(spark, base + "_V")
    return _long(U2, "U").unionByName(_long(V2, "V"))


# ======================================================== stored tables, files
def _scratch(spark, name):
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def _stored_profiles(spark, d, stats=None):
    """TF per language and IDF as stored tables, and the TF-IDF join of both."""
    docs = S.documents(spark, d)
    tf, idf = _scratch(spark, "tf"), _scratch(spark, "idf")
    T.term_frequency(T.tokenize(docs, keep=("lang",)), by=("lang",)).write.parquet(tf)
    T.write_scores(T.term_stats(docs) if stats is None else stats, idf, val="idf")
    return T.tfidf(spark.read.parquet(tf), T.read_scores(spark, idf).withColumnRenamed("val", "idf"))


@query("tfidf_tables")
def q_tfidf_tables(spark, d):
    """TF-IDF of every language from a stored TF table and a stored IDF table."""
    return _stored_profiles(spark, d).select("lang", "term", "tf", r6(F.col("tfidf")).alias("tfidf"))


@query("cosine_tables")
def q_cosine_tables(spark, d):
    """Cosine of each language's stored scores with the corpus's stored scores."""
    path = _scratch(spark, "scores")
    docs = S.documents(spark, d)
    stats = written(T.term_stats(docs), "stats")
    T.write_scores(T.corpus_tfidf(docs, stats=stats), path, val="tfidf")
    each = _stored_profiles(spark, d, stats).select("lang", "term", F.col("tfidf").alias("val"))
    sim = T.cosine_similarity(each, T.read_scores(spark, path), by=("lang",))
    return sim.select("lang", r6(F.col("cosine")).alias("cosine"))


@query("text_files")
def q_text_files(spark, d):
    """Write every document as a text file of its own, read the folder back as
    documents, and return their term counts."""
    path = _scratch(spark, "texts")
    IO.write_text_files(S.documents(spark, d).select("doc_id", F.coalesce("text", F.lit("")).alias("text")), path, "doc_id")
    back = IO.read_text_files(spark, path).select(
        F.regexp_extract("path", r"doc_id=(-?\d+)", 1).try_cast("bigint").alias("doc_id"), "text")
    return T.term_frequency(T.tokenize(back), by=("doc_id",))


@query("interactions_header")
def q_interactions_header(spark, d):
    """Write the ratings as CSV with a header line and read them back."""
    path = _scratch(spark, "ratings")
    IO.write_interactions(S.ratings(spark, d), path, header=True)
    back = IO.read_interactions(spark, path, header=True)
    return back.select("user", "item", r6(F.col("rating")).alias("rating"))


@query("item_cf_per_rating_lists")
def q_item_cf_per_rating_lists(spark, d):
    """The merged lists themselves: (user, src_item, item, score, rank)."""
    train, _ = _split(spark, d)
    recs = C.item_cf_recommend_per_rating(train, C.item_similarity(train), ITEM_K, TOP_N)
    return recs.select("user", "src_item", "item", r6(F.col("score")).alias("score"), "rank")


@query("node_color_join")
def q_node_color_join(spark, d):
    """Nodes with their colours in a graph and in the same graph without one edge."""
    e = S.part_supplier(spark, d)
    return G.node_color_join(G.wl_coloring(e), G.wl_coloring(S.drop_one_edge(e)))


@query("sparse_model_roundtrip")
def q_sparse_model_roundtrip(spark, d):
    """Margins of the labelled documents under a sparse model saved and loaded."""
    x, y = _sparse(spark, d)
    path = _scratch(spark, "sparse-beta")
    IO.save_sparse_model(_beta_hash(x), path)
    return L.sparse_dot(x, IO.load_sparse_model(spark, path), y).select("row_id", r6(F.col("z")).alias("z"))


@query("one_hot")
def q_one_hot(spark, d):
    """Customers' segment and nation as features, a positive balance as the label."""
    rows = S.table(spark, d, "customer").select(
        F.col("c_custkey").alias("row_id"), "c_mktsegment", "c_nationkey",
        F.when(F.col("c_acctbal") > 0, "credit").otherwise("debit").alias("balance"))
    x, y = IO.one_hot(rows, "balance", "credit")
    return x.join(y, "row_id").select("row_id", "feature", "value", "y")


@query("ridge_train_pass")
def q_ridge_train_pass(spark, d):
    """The same descent as ridge_train with two passes over the data a step."""
    m = R.ridge_train_df(S.price_rows(spark, d), lam=RIDGE_LAM, max_iter=100, eps=0.01, method="pass")
    return m.select("idx", r6(F.col("beta")).alias("beta"), r6(F.col("grad_norm")).alias("grad_norm"),
                    "iterations")
