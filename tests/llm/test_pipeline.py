"""The pipeline on a small table, stage by stage, against what plain Python expects."""

import random
from collections import defaultdict

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from llm_helpers import clash, frame

FOOTER = "All rights reserved by the house"
SECRET = "password = hunter2hunter2"


def small_table(spark):
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(rng.choices(letters, k=rng.randrange(3, 9))) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=60)) + f"\n{FOOTER}" for _ in range(14)]
    texts[4] = texts[4].replace("\n", f"\n{SECRET}\n")
    copies = {14: 2, 15: 2, 16: 7}
    texts += [texts[2], texts[2].upper(), texts[7]]
    gone = {17: None, 18: "", 19: "123 !! 456", 20: " \n\t "}
    texts += list(gone.values())
    df = frame(spark, texts, langs=["en"] * len(texts))
    return clash(df), texts, copies, set(gone)


def test_stages_against_plain_expectations(spark, tmp_path):
    df, texts, copies, gone = small_table(spark)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "simhash_dedup", "secret_scan", "packing"]
    docs, seen = P.documents(spark, str(tmp_path)), {}
    for name, step in P.STAGES[:-1]:
        docs = step(spark, docs, str(tmp_path))
        assert docs.columns == df.columns, name
        docs = P.stage(docs, f"test-{name}")
        rows = docs.collect()
        seen[name] = {r.doc_id: r.text for r in rows}
        assert len(rows) == len(seen[name]) and all(r.score == "x" for r in rows)
    kept = {i: t for i, t in enumerate(texts) if i not in gone}
    assert seen["language_id"] == kept
    kept = {i: "\n".join(x for x in t.split("\n") if x.lower() != FOOTER.lower()) for i, t in kept.items()}
    assert seen["line_dedup"] == kept
    groups = defaultdict(set)
    for i in kept:
        groups[copies.get(i, i)].add(i)
    left = set(seen["simhash_dedup"])
    assert all(len(left & g) == 1 for g in groups.values()) and left <= set(kept)
    kept = {i: kept[i] for i in left}
    assert seen["simhash_dedup"] == kept
    kept = {i: t.replace(SECRET, "[SECRET]") for i, t in kept.items()}
    assert seen["secret_scan"] == kept and any("[SECRET]" in t for t in kept.values())
    pieces = P.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    covered = defaultdict(list)
    for p in pieces:
        covered[p.doc_id].append((p.start, p.length, p.doc_tokens))
    assert covered.keys() == kept.keys()
    for i, t in kept.items():
        n = len(tokenizer.encode(t, add_special_tokens=False).ids) + 1
        at = 0
        for start, length, total in sorted(covered[i]):
            assert (start, total) == (at, n)
            at += length
        assert at == n
    whole = P.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in whole} == kept.keys() and len(whole) == len(pieces)


def test_empty_table(spark, tmp_path):
    small_table(spark)[0].limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).collect() == []
