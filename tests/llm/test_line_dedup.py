import hashlib
from collections import defaultdict

import __spark_entry__ as E
from oracle_compare import compare, duck
from pyspark.sql import functions as F
from tessera.llm import line_dedup as L
from llm_helpers import AWKWARD, clash, frame

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def plain(texts, min_docs):
    docs = defaultdict(set)
    for i, t in enumerate(texts):
        for line in (t or "").split("\n"):
            docs[key(line)].add(i)
    out = {}
    for i, t in enumerate(texts):
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or len(docs[key(x)]) < min_docs]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_query_matches_sql(spark, sf):
    compare(E.queries()["op2_line_dedup"](spark, sf), duck(sf), E.oracle_sql()["op2_line_dedup"])


def test_awkward_lines(spark):
    texts = AWKWARD + ["A line \nb\n\n a LINE", "\ta line", "a line\r\nÉté", "été\nb", "b\n", "\n b\x0b\nx"] * 2
    got = L.dedup_lines(clash(frame(spark, texts)), min_docs=3, batches=5).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in got} == plain(texts, 3)
    assert any(r.n_dropped for r in got)
    assert L.dedup_lines(frame(spark, texts).limit(0)).collect() == []


def test_columns_stay_and_repeated_rows(spark):
    df = clash(frame(spark, ["x\nkeep 1", "x\nkeep 2", "x", "x", None], ids=[1, 2, 3, 3, None]))
    out = L.drop_common_lines(df, min_docs=3, batches=2)
    assert out.columns == df.columns
    assert sorted((r.doc_id or -1, r.text, r.n_chars) for r in out.collect() if r.text is not None) == [
        (1, "keep 1", 6), (2, "keep 2", 6), (3, "", 0), (3, "", 0)]


def test_runs_are_levelled_and_compacted(spark):
    runs = L.LineRuns(spark, fanout=2)
    batches = [L.line_table(frame(spark, [f"line {i}\nshared"], ids=[i])) for i in range(5)]
    for n, b in enumerate(batches):
        fresh = runs.unseen(b).count()
        assert fresh == (2 if n == 0 else 1)
        runs.add(b)
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert runs.common(5).count() == 1
    for run in runs.runs():
        rows = [(r.k1, r.k2) for r in run.coalesce(1).collect()]
        assert len(rows) == len(set(rows))


def test_no_python_on_the_main_path(spark, sf):
    from tessera.llm.common import documents
    df = L.dedup_digests(documents(spark, sf))
    plan = df._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
