import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import text as T


def test_tokenize_python_whitespace_and_letters(spark):
    txt = "Ba,Na:Na.123 banana x\x1cy --- Élan über 42"
    df = spark.createDataFrame([(1, txt)], "doc_id BIGINT, text STRING")
    got = [r.term for r in T.tokenize(df).collect()]
    want = []
    for w in txt.lower().split():
        w = "".join(c for c in w if c.isalpha())
        if w:
            want.append(w)
    assert got == want


def test_idf_of_term_in_every_document_is_zero(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a c"), (3, "a")], "doc_id BIGINT, text STRING")
    idf = {r.term: r.idf for r in T.inverse_document_frequency(docs, T.tokenize(docs)).collect()}
    assert idf["a"] == 0.0
    assert abs(idf["b"] - math.log(3)) < 1e-15
    empty = spark.createDataFrame([(1, "a"), (2, "")], "doc_id BIGINT, text STRING")
    idf2 = T.inverse_document_frequency(empty, T.tokenize(empty)).first()
    assert abs(idf2.idf - math.log(2)) < 1e-15   # empty documents still count in N


def test_cosine_self_is_one_and_zero_norm_is_null(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "term STRING, val DOUBLE")
    z = spark.createDataFrame([("x", 0.0)], "term STRING, val DOUBLE")
    assert abs(T.cosine_similarity(a, a).first()["cosine"] - 1.0) < 1e-12
    assert T.cosine_similarity(z, a).first()["cosine"] is None


def test_top_terms_ties_by_term(spark):
    s = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0)], "term STRING, val DOUBLE")
    assert [r.term for r in T.top_terms(s, "val", 2).collect()] == ["c", "a"]


def test_scores_roundtrip(spark, tmp_path):
    s = spark.createDataFrame([("a", 1.5)], "term STRING, val DOUBLE")
    T.write_scores(s, str(tmp_path / "s"))
    assert T.read_scores(spark, str(tmp_path / "s")).collect()[0].val == 1.5


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]


def test_corpus_statistics_take_one_shuffle_by_term(spark, sf):
    """Scalar N apart, the corpus is exchanged once, after map-side combining."""
    from tessera.sources import tables as S
    docs = S.documents(spark, sf)   # dealt to several tasks
    plan = _final_plan(T.corpus_tfidf(docs))
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan


def test_corpus_statistics_equal_plain_counts(spark):
    import collections
    texts = ["b a  a c", "", None, "a!! 'a b", "zz zz zz"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING")
    words = [["".join(c for c in w if c.isalpha()) for w in (t or "").split()] for t in texts]
    tf = collections.Counter(w for ws in words for w in ws)
    df = collections.Counter(w for ws in words for w in set(ws))
    got = {r.term: (r.tf, r.df, r.idf) for r in T.term_stats(docs).collect()}
    assert got == {w: (tf[w], df[w], math.log(5 / df[w])) for w in tf}
    assert T.term_stats(docs.limit(0)).collect() == []


def test_two_table_tfidf_drops_or_keeps_unknown_terms(spark):
    tf = spark.createDataFrame([("x", 2), ("y", 3)], "term STRING, tf BIGINT")
    idf = spark.createDataFrame([("x", 0.5)], "term STRING, idf DOUBLE")
    assert [(r.term, r.tfidf) for r in T.tfidf(tf, idf).collect()] == [("x", 1.0)]
    assert {r.term: r.tfidf for r in T.tfidf(tf, idf, strict=True).collect()} == {"x": 1.0, "y": None}


def test_text_files_are_documents(spark, tmp_path):
    from tessera.sources import files as IO
    (tmp_path / "in").mkdir()
    for name, text in (("a.txt", "one two\nthree\n"), ("in/b.txt", "four"), ("c.txt", " \n"), ("d.txt", "")):
        (tmp_path / name).write_text(text)
    got = {r.path.rsplit("/", 1)[1]: r.text for r in IO.read_text_files(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": "one two\nthree\n", "b.txt": "four", "c.txt": " \n"}


def test_folder_read_in_tasks_equals_the_text_source(spark, tmp_path):
    import gzip

    from tessera.sources import files as IO
    (tmp_path / "a b/%é/[x]").mkdir(parents=True)
    (tmp_path / "_hidden").mkdir()
    raw = {"a.txt": b"one\r\ntwo\n", "a b/c#d?.txt": b"\xff\xfe bad \xc3", "a b/%\u00e9/e.txt": "\ufeffé\0".encode(),
           "a b/%\u00e9/[x]/f{1}.txt": b" \n", "a b/empty": b"", "_no": b"x", ".no": b"x", "_k=1": b"yes", "_hidden/a": b"x",
           "b._COPYING_": b"x", "g.gz": gzip.compress(b"packed"), "a b/%\u00e9/[x]/h{1}.gz": gzip.compress(b"packed too")}
    for name, body in raw.items():
        (tmp_path / name).write_bytes(body)
    got, want = ({(r.path, bytes(r.b)) for r in IO.read_text_files(spark, p).selectExpr("path", "cast(text as binary) b").collect()}
                 for p in (f"file://{tmp_path}", str(tmp_path)))
    assert got == want and len(got) == 7
    (tmp_path / "none").mkdir()
    assert IO.read_text_files(spark, f"file:{tmp_path}/none").collect() == []


def test_written_text_files_share_folders_and_tasks(spark, tmp_path):
    from tessera.sources import files as IO
    rows = [(i, f"text {i}\n\u00e9") for i in range(-1, 400)] + [(7, "again"), (7, "again"), (None, "no id"), (500, "")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    IO.write_text_files(docs.repartition(2), f"file:{tmp_path}/t", "doc_id")
    # one folder for many documents: they had one each
    assert len([p for p in (tmp_path / "t").iterdir()]) == 2 and len(list((tmp_path / "t").rglob("*.txt"))) == len(rows)
    back = IO.read_text_files(spark, f"file:{tmp_path}/t")
    # a task opened 32 small files at most, so 405 files made more tasks than cores
    assert back.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    got = back.select(F.regexp_extract("path", r"doc_id=(-?\d+)", 1).try_cast("bigint"), "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, t + "\n") for i, t in rows), key=str)
    with pytest.raises(FileExistsError):
        IO.write_text_files(docs, f"file:{tmp_path}/t", "doc_id")


def test_text_stripped_as_a_whole_gives_the_words_stripped_one_by_one(spark):
    from pyspark.sql import functions as F

    from tessera.functions import expr
    texts = ["Ab-c  d1e\u00a0\u2003x_y\n\t9 \u00e9\u0301t\x1ca\x85b", "", None, " -- ", "\U0001d4d0b \U0001f600 c", "\u0130I"]
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    one_by_one = F.filter(F.transform(expr.split_words(F.col("text")), expr.letters_only), lambda w: w != "")
    for whole, each in df.select(expr.letter_words(F.col("text")), one_by_one).collect():
        assert whole == each


def test_stored_scores_share_one_pass_of_statistics(spark, sf, monkeypatch):
    import __spark_entry__ as E
    calls, real = [], T.term_stats
    monkeypatch.setattr(T, "term_stats", lambda *a, **k: calls.append(1) or real(*a, **k))
    assert E.queries()["cosine_tables"](spark, sf).count() and len(calls) == 1
