"""Conversation structure repair: a streamed dynamic programme over sorted turns.

Rows are dealt out by conversation and sorted by turn once; a task then reads
its conversations as one stream, and the programme's state is carried from one
Arrow batch to the next.  Which turns repeat an earlier one is told before, by a
window that needs no further shuffle (a conversation is in one partition already).

The kept turns must read ``(s?(ua)+)?`` in role initials, which is an automaton
of four states: nothing yet (0), after the system turn (1), after a user turn
(2), after a whole pair (3).  Per state the cheapest edits so far are known by
their cost, by their rank among the states in ASCII order, and by the running
SHA-256 of the repaired text, so no text is held.  The rank suffices for ties:
with the same number of turns read, the audits of two states end in a turn's
edit and neither is a prefix of the other, so what follows cannot change their
order.  Backpointers take four bytes a turn and go to an unnamed temporary file
of the task beyond ``SPILL`` bytes; a lost task starts its partition again.
Memory is the backpointers' buffer, one batch, and the audit that is returned,
whatever the length of a conversation.  One conversation is one stream in one
task: its digest is a chain over its turns.

Defined cases: a null role or text is one space, a null turn comes before all
others; equal turns come in the order of role, then text; a null ``conv_id`` is
a conversation of its own; an empty role or one with another initial can be
rewritten or deleted, not kept; an empty text is blank; rows that repeat role
and text are duplicates; no rows give zeros and empty results; an empty table
gives an empty table; further columns are ignored.  Texts may have any length.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WHITE, map_rows

SPILL = 4 << 20
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
REROLE, DELETE, INSERT, BROKEN = 1, 2, 5, 5  # costs of the edits, and of a truncated turn that stays
#: state -> the role an inserted or rewritten turn takes, and the state after it
_NEXT = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
#: (state, initial of a kept turn) -> the state after it
_KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_LEGAL = {"su", "ua", "au"}
_NONE = 255


def _inserts(q: int) -> Iterator[tuple[str, int, tuple[str, ...]]]:
    """(edits, state, inserted roles) of inserting none, one or two turns: a
    third would lead back to a state that fewer reach."""
    roles: tuple[str, ...] = ()
    for k in range(3):
        yield "I" * k, q, roles
        role, q = _NEXT[q]
        roles += (role,)


def _edits() -> list[tuple]:
    """(state before, edits, cost, state after, inserted roles, own role) of each
    way past one turn; own role: None deletes it, '' keeps it as it is."""
    ways = []
    for q in _NEXT:
        for edits, at, roles in _inserts(q):
            cost = INSERT * len(edits)
            ways.append((q, edits + "D", cost + DELETE, at, roles, None, ""))
            ways += [(q, edits + "K", cost, to, roles, "", initial)
                     for (state, initial), to in _KEEP.items() if state == at]
            role, to = _NEXT[at]
            ways.append((q, edits + "R", cost + REROLE, to, roles, role, ""))
    return ways


_WAYS = _edits()


def _ways_past(initial: str, fault: int) -> list[tuple[int, list[tuple]]]:
    """Per state after a turn: (state before, cost, edits, index into _WAYS)."""
    into: dict[int, list[tuple]] = {}
    for i, (q, edits, cost, to, _, own, kept) in enumerate(_WAYS):
        if own is not None and (fault in (BLANK, DUPLICATE) or own == "" and kept != initial):
            continue
        into.setdefault(to, []).append((q, cost + BROKEN * (own is not None and fault == TRUNCATED), edits, i))
    return sorted(into.items())


_PAST = {(c, f): _ways_past(c, f) for c in ("s", "u", "a", "") for f in (0, BLANK, DUPLICATE, TRUNCATED)}
#: state -> (cost, inserted roles) of ending there
_END = {0: (0, ()), 1: (2 * INSERT, ("user", "assistant")), 2: (INSERT, ("assistant",)), 3: (0, ())}


class _Pointers:
    """Four bytes a turn, in memory up to ``SPILL`` and in an unnamed file beyond."""

    def __init__(self, spill: int):
        self.spill, self.file, self.buffer = spill, None, bytearray()

    def add(self, four: bytes) -> None:
        self.buffer += four
        if len(self.buffer) >= self.spill:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.write(self.buffer)
            self.buffer.clear()

    def backwards(self) -> Iterator[bytes]:
        blocks = [bytes(self.buffer)]
        end = self.file.tell() if self.file else 0
        while blocks or end:
            if blocks:
                block = blocks.pop()
            else:
                start = max(0, end - (self.spill & ~3 or 4))
                self.file.seek(start)
                block, end = self.file.read(end - start), start
            for k in range(len(block) - 4, -1, -4):
                yield block[k:k + 4]
        if self.file:
            self.file.close()


class Repair:
    """The programme over one conversation, fed turn by turn in order."""

    def __init__(self, spill: int = SPILL):
        self.best = {0: (0, 0, hashlib.sha256())}  # state -> (cost, rank, digest)
        self.pointers = _Pointers(spill)
        self.counts = [0, 0, 0, 0]
        self.illegal, self.before = 0, None
        self.first = self.last = None
        self.distinct = 0

    def turn(self, turn: int | None, role: str, text: str, fault: int) -> None:
        self.counts[fault] += 1
        initial = role[:1]
        if self.before is not None and self.before + initial not in _LEGAL:
            self.illegal += 1
        self.before = initial
        if turn is not None:
            if self.first is None:
                self.first = turn
            if turn != self.last:
                self.distinct, self.last = self.distinct + 1, turn
        best, chosen = self.best, []
        for to, ways in _PAST[initial if initial in ("s", "u", "a") else "", fault]:
            known = [(best[q][0] + cost, best[q][1], edits, i) for q, cost, edits, i in ways if q in best]
            if known:
                chosen.append((to, *min(known)))
        four = bytearray((_NONE,) * 4)
        after = {}
        body = None
        for rank, (to, cost, _, _, i) in enumerate(sorted(chosen, key=lambda c: c[2:4])):
            four[to] = i
            q, _, _, _, inserted, own, _ = _WAYS[i]
            digest = best[q][2]
            if inserted or own is not None:
                digest = digest.copy()
                mark = b"\n" if q else b""  # state 0 alone has no line before
                for role_in in inserted:
                    digest.update(mark + role_in.encode() + b":")
                    mark = b"\n"
                if own is not None:
                    if body is None:
                        body = b":" + text.encode()
                    digest.update(mark + (own or role).encode())
                    digest.update(body)
            after[to] = (cost, rank, digest)
        self.best = after
        self.pointers.add(bytes(four))

    def result(self) -> dict:
        cost, _, edits, q = min((c + _END[q][0], rank, "I" * len(_END[q][1]), q)
                                for q, (c, rank, _) in self.best.items())
        digest = self.best[q][2]
        for role in _END[q][1]:  # a turn stands before: states 1 and 2 have a line
            digest.update(b"\n" + role.encode() + b":")
        audit = [edits]
        for four in self.pointers.backwards():
            way = _WAYS[four[q]]
            audit.append(way[1])
            q = way[0]
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return {"gaps": gaps, "blank": self.counts[BLANK], "duplicate": self.counts[DUPLICATE],
                "truncated": self.counts[TRUNCATED], "illegal": self.illegal, "cost": cost,
                "audit": "".join(reversed(audit)), "repaired_sha256": digest.hexdigest()}


_RESULT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")


def _plain(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) without nulls in the last two, and ``live``:
    false for a row that only names its conversation."""
    live = F.col("live") if "live" in rows.columns else F.lit(True)
    return rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), live.alias("live"))


def _order() -> list:
    return [F.col(c).asc_nulls_first() for c in ("conv_id", "live", "turn", "role", "text")]


def ordered_turns(rows: DataFrame) -> DataFrame:
    """The rows dealt out by conversation and sorted by turn, with ``fault``."""
    order = [F.col("turn").asc_nulls_first()]
    same = Window.partitionBy("conv_id", "live", "_k1", "_k2").orderBy(*order)
    bare = F.btrim("text", F.lit(WHITE))
    fault = (F.when(bare == "", F.lit(BLANK)).when(F.row_number().over(same) > 1, F.lit(DUPLICATE))
             .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), F.lit(TRUNCATED)).otherwise(F.lit(0)))
    dealt = (_plain(rows).withColumn("_k1", F.xxhash64("role", "text"))
             .withColumn("_k2", F.xxhash64(F.lit(1), "role", "text")).repartition("conv_id"))
    return dealt.select("conv_id", "live", "turn", "role", "text", fault.alias("fault")).sortWithinPartitions(
        *_order())


def repair_conversations(rows: DataFrame, spill: int = SPILL) -> DataFrame:
    """Per conversation of ``rows(conv_id, turn, role, text)``: its faults, the
    cost and audit of the cheapest repair, and the digest of the repaired text.

    A column ``live`` may mark rows (false) that only name their conversation.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
        open_id, state = None, None
        for b in batches:
            done: dict[str, list] = {"conv_id": [], **{n: [] for n in names}}
            for conv, live, turn, role, text, fault in zip(
                    b["conv_id"], b["live"], b["turn"], b["role"], b["text"], b["fault"]):
                if state is None or conv != open_id:
                    if state is not None:
                        _close(done, open_id, state)
                    open_id, state = conv, Repair(spill)
                if live:
                    state.turn(turn, role, text, fault)
            if done["conv_id"]:
                yield done
        if state is not None:
            done = {"conv_id": [], **{n: [] for n in names}}
            _close(done, open_id, state)
            yield done

    return map_rows(ordered_turns(rows), run, f"conv_id {kind}, {_RESULT}")


def _close(done: dict[str, list], conv, state: Repair) -> None:
    done["conv_id"].append(conv)
    for name, value in state.result().items():
        done[name].append(value)


def repaired_turns(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """(conv_id, position, role, text, edit) of the repaired conversations.

    ``repairs`` is the result of ``repair_conversations``; each audit meets its
    conversation's turns in the same order and is played over them.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    turns = _plain(rows).where("live").withColumn("audit", F.lit(None).cast("string"))
    audits = repairs.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
                            F.lit(None).cast("string").alias("text"), F.lit(False).alias("live"), "audit")
    both = turns.unionByName(audits).repartition("conv_id").sortWithinPartitions(*_order())

    def run(batches):
        audit, at, q, position, open_id = "", 0, 0, 0, None
        for b in batches:
            out: dict[str, list] = {n: [] for n in ("conv_id", "position", "role", "text", "edit")}

            def add(role, text, edit):
                for name, value in zip(out, (open_id, position, role, text, edit)):
                    out[name].append(value)

            for conv, live, role, text, plan in zip(b["conv_id"], b["live"], b["role"], b["text"], b["audit"]):
                if not live:
                    audit, at, q, position, open_id = plan, 0, 0, 0, conv
                else:
                    edit = audit[at]
                    at += 1
                    if edit == "K":
                        add(role, text, edit)
                        q = _KEEP[q, role[:1]]
                    elif edit == "R":
                        add(_NEXT[q][0], text, edit)
                        q = _NEXT[q][1]
                    position += edit != "D"
                while at < len(audit) and audit[at] == "I":
                    add(_NEXT[q][0], "", "I")
                    q, at, position = _NEXT[q][1], at + 1, position + 1
            if out["conv_id"]:
                yield out

    return map_rows(both, run, f"conv_id {kind}, position long, role string, text string, edit string")


def damage(rows: DataFrame) -> DataFrame:
    """Conversations damaged by the remainder of crc32('conv_id:turn') by 20: 0
    drops the turn (a row that is not ``live`` still names the conversation), 1
    empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes it the user's."""
    def shown(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    dice = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    copies = F.when(F.col("_dice") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = (F.when(F.col("_dice").isin(0, 1), F.lit(""))
            .when(F.col("_dice") == 2, F.translate(F.col("text"), ".!?", "")).otherwise(F.col("text")))
    return (rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), dice.alias("_dice"))
            .select("conv_id", "turn", F.when(F.col("_dice") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    text.alias("text"), (F.col("_dice") != 0).alias("live"), F.explode(copies).alias("_copy"))
            .drop("_copy"))


#: DuckDB SQL of the query's rows: crc32 bit by bit, and the programme as a
#: recursion over turns that keeps, per state, the cheapest and then least audit.
ORACLE = """
WITH RECURSIVE
src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations
), diced AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(key, ''),
              lambda ch: [ord(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
              lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END),
            4294967295::BIGINT) % 20 AS dice
  FROM src
), damaged AS (
  SELECT conv_id, turn, CASE WHEN dice = 4 THEN 'user' ELSE role END AS role,
         CASE dice WHEN 1 THEN '' WHEN 2 THEN replace(replace(replace(text, '.', ''), '!', ''), '?', '') ELSE text END AS text
  FROM diced, (SELECT unnest([0, 1]) AS copy) WHERE dice <> 0 AND (copy = 0 OR dice = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
         trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM damaged
), faulty AS (
  SELECT *, left(role, 1) AS initial,
         CASE WHEN bare = '' THEN 1
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 2
              WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS was
  FROM placed
), ins(q, edits, cost, q1, added) AS (VALUES
  (0, '', 0, 0, ''), (0, 'I', 5, 2, 'user:'), (0, 'II', 10, 3, 'user:' || chr(10) || 'assistant:'),
  (1, '', 0, 1, ''), (1, 'I', 5, 2, 'user:'), (1, 'II', 10, 3, 'user:' || chr(10) || 'assistant:'),
  (2, '', 0, 2, ''), (2, 'I', 5, 3, 'assistant:'), (3, '', 0, 3, ''), (3, 'I', 5, 2, 'user:')
), own(q1, edit, initial, cost, role, q2) AS (VALUES
  (0, 'D', NULL, 2, NULL, 0), (1, 'D', NULL, 2, NULL, 1), (2, 'D', NULL, 2, NULL, 2), (3, 'D', NULL, 2, NULL, 3),
  (0, 'K', 's', 0, NULL, 1), (0, 'K', 'u', 0, NULL, 2), (1, 'K', 'u', 0, NULL, 2), (2, 'K', 'a', 0, NULL, 3),
  (3, 'K', 'u', 0, NULL, 2),
  (0, 'R', NULL, 1, 'user', 2), (1, 'R', NULL, 1, 'user', 2), (2, 'R', NULL, 1, 'assistant', 3),
  (3, 'R', NULL, 1, 'user', 2)
), ways AS (
  SELECT ins.q, own.q2, ins.cost + own.cost AS cost, ins.edits || own.edit AS edits, own.edit, own.initial, own.role, ins.added
  FROM ins JOIN own ON ins.q1 = own.q1
), walk AS (
  SELECT conv_id, 0::BIGINT AS n, 0 AS q, 0::BIGINT AS cost, '' AS audit, '' AS body
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, n, q2, cost, audit, body FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, q2 ORDER BY cost, audit) AS place FROM (
      SELECT w.conv_id, f.n, t.q2, w.audit || t.edits AS audit,
             w.cost + t.cost + CASE WHEN f.fault = 3 AND t.edit <> 'D' THEN 5 ELSE 0 END AS cost,
             w.body || CASE WHEN w.body <> '' AND t.added <> '' THEN chr(10) ELSE '' END || t.added
               || CASE WHEN t.edit = 'D' THEN ''
                       ELSE CASE WHEN w.body <> '' OR t.added <> '' THEN chr(10) ELSE '' END
                            || coalesce(t.role, f.role) || ':' || f.text END AS body
      FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n + 1
      JOIN ways t ON t.q = w.q AND (t.edit = 'D' OR f.fault IN (0, 3)) AND (t.edit <> 'K' OR t.initial = f.initial)
    )) WHERE place = 1
), ended AS (
  SELECT w.*, row_number() OVER (PARTITION BY w.conv_id ORDER BY n DESC, w.cost + e.cost, w.audit || e.edits) AS place,
         w.cost + e.cost AS whole, w.audit || e.edits AS edits, w.body || e.added AS text
  FROM walk w JOIN (VALUES (0, 0, '', ''), (1, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
                           (2, 5, 'I', chr(10) || 'assistant:'), (3, 0, '', '')) e(q, cost, edits, added) ON w.q = e.q
), stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
         count(*) FILTER (WHERE fault = 3) AS truncated,
         count(*) FILTER (WHERE n > 1 AND was || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(whole AS BIGINT) AS cost, edits AS audit,
       sha256(text) AS repaired_sha256
FROM ended e LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM e.conv_id WHERE place = 1
"""
