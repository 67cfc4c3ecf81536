"""Small inputs of the document operators' tests."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


def frame(spark, texts, ids=None, langs=None):
    ids = range(len(texts)) if ids is None else ids
    langs = ["en"] * len(texts) if langs is None else langs
    return spark.createDataFrame(
        [(i, t, l, "s", None if t is None else len(t)) for i, t, l in zip(ids, texts, langs)], SCHEMA)


def clash(df):
    """The same rows with further columns named like the operators' own."""
    from pyspark.sql import functions as F
    for name in ("score", "held_out", "component_id", "fingerprint", "start", "_text", "_key", "kind", "n",
                 "row", "key", "position", "vec", "label"):
        df = df.withColumn(name, F.lit("x"))
    return df


AWKWARD = ["", None, " ", "\n\n", "a", "a  b \n c\t\td ", "x" * 50_000, "word " * 20_000,
           "été ß Ñandú İstanbul 漢字仮名 🙂🙂", "same text here", "same text here", "   \x85x",
           "tab\there\r\nand there  \n", "1234567890 " * 3, "<|endoftext|> b", "don't I'll we've"]


def texts_of(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
