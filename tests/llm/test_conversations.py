"""Conversation repair against a plain recursion and SQL."""

import functools
import hashlib
import random
import zlib

from oracle_compare import compare, duck
from tessera.llm import conversations as C

KEEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
ROLE = {"": "user", "s": "user", "u": "assistant", "a": "user"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        dice = zlib.crc32(key.encode()) % 20
        if dice == 0:
            continue
        if dice == 1:
            text = ""
        if dice == 2:
            text = "".join(c for c in text if c not in ".!?")
        if dice == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if dice == 3 else 1)
    return out


def brute(rows):
    """Cheapest repair by recursion from the end, ties by the audit itself."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    faults, seen = [], set()
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))

    @functools.cache
    def best(i, last, inserted):
        """(cost, audit) from turn i on, the last kept initial being ``last``."""
        found = []
        if i == len(rows) and last in ("", "a"):
            found.append((0, ""))
        nxt = ROLE[last][0]
        if inserted < 3:
            c, a = best(i, nxt, inserted + 1)
            found.append((c + 5, "I" + a))
        if i < len(rows):
            c, a = best(i + 1, last, 0)
            found.append((c + 2, "D" + a))
            if faults[i] not in ("b", "d"):
                extra = 5 * (faults[i] == "t")
                to = KEEP.get((last, rows[i][2][:1]))
                if to:
                    c, a = best(i + 1, to, 0)
                    found.append((c + extra, "K" + a))
                c, a = best(i + 1, nxt, 0)
                found.append((c + 1 + extra, "R" + a))
        return min(found, default=(10 ** 9, ""))

    for i in range(len(rows), 0, -50):  # a shallow recursion
        for last in ROLE:
            best(i, last, 0)
    cost, audit = best(0, "", 0)
    lines, last, i = [], "", 0
    for e in audit:
        if e == "I":
            lines.append(ROLE[last] + ":")
            last = ROLE[last][0]
            continue
        if e != "D":
            role = rows[i][2] if e == "K" else ROLE[last]
            lines.append(role + ":" + rows[i][3])
            last = role[0]
        i += 1
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"),
            faults.count("t"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


def table(spark, rows, extra=False):
    if extra:
        return spark.createDataFrame([(*r, True, "x", 1) for r in rows], "conv_id long, turn long, role string, "
                                     "text string, fault boolean, audit string, cost int")
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def sample(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.choice([0, 1, 2, 3, 5, 8, 12])):
            rows.append((conv if conv else None, rng.choice([turn, turn + rng.randrange(3), None]),
                         rng.choice(["user", "assistant", "system", "tool", "", "u", None]),
                         rng.choice(["a.", "b!", "c", " \t", "", None, "ü?", "d ", "e. \n", "f.g"])))
    return rows


def as_dict(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_against_recursion(spark):
    rows = sample(300)
    got = as_dict(C.repair_conversations(C.damage(table(spark, rows, True))))
    assert set(got) == {r[0] for r in rows}
    after = damaged(rows)
    for conv, result in got.items():
        assert result == brute([r for r in after if r[0] == conv])[0], conv


def test_state_is_carried_and_spilled(spark):
    rng = random.Random(2)
    rows = [(7, t, rng.choice(["user", "assistant", "tool"]), f"{rng.randrange(400)}" + rng.choice([".", ""]))
            for t in range(700)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        got = as_dict(C.repair_conversations(table(spark, rows), spill=64))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got[7] == brute(rows)[0]


def test_repaired_turns(spark):
    rows = sample(120, 3)
    df = table(spark, rows)
    fixed = C.repaired_turns(df, C.repair_conversations(df)).collect()
    for conv in {r[0] for r in rows}:
        lines = brute([(c, t, " " if r is None else r, " " if x is None else x)
                       for c, t, r, x in rows if c == conv])[1]
        mine = sorted((r.position, f"{r.role}:{r.text}") for r in fixed if r.conv_id == conv)
        assert mine == list(enumerate(lines))


def test_empty_and_all_dropped(spark):
    empty = C.repair_conversations(C.damage(table(spark, [])))
    assert empty.count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = as_dict(C.repair_conversations(C.damage(table(spark, [(gone, 0, "user", "a.")]))))
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_long_text(spark):
    text = "x" * 3_000_000 + "."
    got = as_dict(C.repair_conversations(table(spark, [(1, 0, "user", text), (1, 1, "assistant", text)])))
    assert got[1][-1] == hashlib.sha256(f"user:{text}\nassistant:{text}".encode()).hexdigest()


def test_query_against_sql(spark, sf):
    from tessera.llm.queries import ORACLE, QUERIES
    compare(QUERIES["op11_conversation_repair"](spark, sf), duck(sf), ORACLE["op11_conversation_repair"])
