"""Text scoring: tokenize, TF, IDF, TF-IDF, top terms, cosine similarity.

Corpus statistics sort each document's words before they are exploded and mark
the first of equal ones, so that term and document frequency are two sums of
one aggregation by term.  All operators are narrow maps plus hash aggregations (partial aggregation on
the map side, so a frequent term never lands whole in one task) and equi-joins
on ``term``.  Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.expr import letter_words
from tessera.plans.iterate import checkpoint


def tokenize(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
             out: str = "term") -> DataFrame:
    """Lower-case, split on whitespace, strip non-letters, drop empties.

    Emits one row per token occurrence with the ``keep`` columns carried along.
    """
    return df.select(*keep, F.explode(letter_words(F.col(text))).alias(out))


def term_frequency(tokens: DataFrame, by: tuple[str, ...] = (), term: str = "term") -> DataFrame:
    """Raw count per term (optionally per ``by`` group, e.g. per document)."""
    return tokens.groupBy(*by, term).agg(F.count(F.lit(1)).alias("tf"))


def inverse_document_frequency(docs: DataFrame, tokens: DataFrame, doc: str = "doc_id",
                               term: str = "term") -> DataFrame:
    """idf = ln(N / df), N = number of documents (including empty ones).

    ``df`` counts each term once per document: the (doc, term) pairs are
    de-duplicated by a partial+final aggregation, then counted per term.  N is a
    scalar subquery, evaluated once and inlined as a value.
    """
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    dfreq = (tokens.select(doc, term).distinct()
             .groupBy(term).agg(F.count(F.lit(1)).alias("df")))
    return dfreq.select(term, F.log(n_docs / F.col("df")).alias("idf"))


def _marked_tokens(docs: DataFrame, text: str, keep: tuple[str, ...], term: str) -> DataFrame:
    """(keep..., term, _first): one row per token, ``_first`` is 1 for one of
    the equal tokens of a row and 0 for the others.  A map without a shuffle:
    the words of a row are sorted, and a word is new where the one before differs."""
    words = F.array_sort(letter_words(F.col(text)))
    rows = docs.select(*keep, words.alias("_words"))
    before = F.concat(F.array(F.lit("")), F.col("_words"))   # one longer: the last pair is cut off
    pairs = F.filter(F.arrays_zip(F.col("_words").alias("w"), before.alias("b")), lambda p: p["w"].isNotNull())
    return (rows.select(*keep, F.explode(pairs).alias("_p"))
            .select(*keep, F.col("_p.w").alias(term), (F.col("_p.w") != F.col("_p.b")).cast("int").alias("_first")))


def term_stats(docs: DataFrame, by: tuple[str, ...] = (), text: str = "text", term: str = "term") -> DataFrame:
    """T2 + T3 fused: (by..., term, tf, df, idf) from one tokenization and one shuffle.

    Every row of ``docs`` is a document.  ``by`` groups the statistics (e.g. per
    language); idf always uses N = all documents of ``docs``.
    """
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    return (_marked_tokens(docs, text, by, term).groupBy(*by, term)
            .agg(F.count(F.lit(1)).alias("tf"), F.sum("_first").alias("df"))
            .withColumn("idf", F.log(n_docs / F.col("df"))))


def corpus_tfidf(docs: DataFrame, text: str = "text", stats: DataFrame | None = None) -> DataFrame:
    """T4 over a whole corpus: (term, tf, idf, tfidf) with one shuffle; none if the
    ``term_stats`` of ``docs`` are given."""
    st = term_stats(docs, text=text) if stats is None else stats
    return st.select("term", "tf", "idf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def tfidf(tf: DataFrame, idf: DataFrame, term: str = "term", strict: bool = False) -> DataFrame:
    """T4: tf * idf per term (any grouping columns of ``tf`` are kept).

    The reference raises when a term has no idf; ``strict=True`` keeps such
    rows with a NULL score so a caller can detect them, the default drops them
    (inner join).  The join is planned by AQE from runtime sizes.
    """
    how = "left" if strict else "inner"
    return (tf.join(idf, term, how)
            .withColumn("tfidf", F.col("tf") * F.col("idf"))
            .drop("idf"))


def top_terms(scores: DataFrame, val: str, k: int = 20, term: str = "term") -> DataFrame:
    """T5: the k highest (term, val) pairs; ties broken by term ascending.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: every task keeps only
    its own top k, the driver merges k * tasks rows.
    """
    return scores.orderBy(F.col(val).desc(), F.col(term).asc()).limit(k)


def cosine_similarity(a: DataFrame, b: DataFrame, by: tuple[str, ...] = (),
                      term: str = "term", val: str = "val") -> DataFrame:
    """Cosine of two sparse (term, val) vectors, optionally per ``by`` group.

    ``a`` may carry grouping columns ``by`` (many vectors), ``b`` is one vector.
    Dot product over shared terms, norms over all terms of each side; a zero
    norm gives NULL instead of a division error.
    """
    dot = (a.join(b.select(term, F.col(val).alias("_b")), term)
           .groupBy(*by).agg(F.sum(F.col(val) * F.col("_b")).alias("dot")))
    na = a.groupBy(*by).agg(F.sum(F.col(val) * F.col(val)).alias("na"))
    nb = b.select(F.sum(F.col(val) * F.col(val))).scalar()
    if by:
        joined = na.join(dot, list(by), "left")
    else:
        joined = na.select("na", dot.select("dot").scalar().alias("dot"))
    return joined.select(*by, F.try_divide(F.coalesce(F.col("dot"), F.lit(0.0)),
                                           F.sqrt(F.col("na") * nb)).alias("cosine"))


def group_cosine_to_corpus(docs: DataFrame, group: str = "lang", text: str = "text") -> DataFrame:
    """T6 for every group of documents at once: cosine between the group's
    TF-IDF profile and the whole corpus's TF-IDF profile -> (group, cosine).

    One tokenization and one pipeline: counts per (group, term) carry df
    per group; a window over each term's rows (one row per group holding the
    term, so bounded by the number of groups) adds the corpus tf and df; one
    aggregation per group gives the dot product and the group norm, and the
    corpus norm is summed over the first row of each term in the same pass.
    The sums, one row per group, are written before the corpus norm is added up.
    """
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    per_group = (_marked_tokens(docs, text, (group,), "term").groupBy(group, "term")
                 .agg(F.count(F.lit(1)).alias("tf_g"), F.sum("_first").alias("df_g")))
    w = Window.partitionBy("term")
    idf = F.log(n_docs / F.sum("df_g").over(w))
    scored = per_group.select(
        group, (F.col("tf_g") * idf).alias("a"), (F.sum("tf_g").over(w) * idf).alias("b"),
        (F.row_number().over(w.orderBy(group)) == 1).alias("first"))
    agg = checkpoint(scored.groupBy(group).agg(
        F.sum(F.col("a") * F.col("b")).alias("dot"), F.sum(F.col("a") * F.col("a")).alias("na"),
        F.sum(F.when(F.col("first"), F.col("b") * F.col("b")).otherwise(0.0)).alias("_nb")))
    nb = agg.select(F.sum("_nb")).scalar()
    return agg.select(group, F.try_divide(F.col("dot"), F.sqrt(F.col("na") * nb)).alias("cosine"))


SCORE_SCHEMA = "term STRING, val DOUBLE"


def write_scores(scores: DataFrame, path: str, term: str = "term", val: str = "val") -> None:
    """Persist a (term, val) table as typed parquet."""
    (scores.select(F.col(term).cast("string").alias("term"),
                   F.col(val).cast("double").alias("val"))
     .write.mode("overwrite").parquet(path))


def read_scores(spark, path: str) -> DataFrame:
    """Read a (term, val) table back with its fixed schema."""
    return spark.read.schema(SCORE_SCHEMA).parquet(path)
