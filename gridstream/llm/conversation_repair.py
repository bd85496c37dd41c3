"""Conversation structure repair (operator 11): run-length DP.

A conversation's rows go by turn (nulls first; rows of one turn by role and md5
of the text).  A row's first fault counts: blank (no character but \\x20 and
\\x09-\\x0D), duplicate (role and text seen earlier in the conversation),
truncated (its last such character is none of ``.!?``).  Edits make the
roles' initials match ``(s?(ua)+)?``: Keep costs 0, Rerole to user or assistant
1, Delete 2 (the only edit of blank and duplicate rows), Insert an empty user or
assistant row 5; a truncated row that stays adds 5.  Of the cheapest edits the
ones whose initials, in order, are least are applied.

What an edit may do depends on a row's symbol only: its initial (s, u, a or
another) and its fault.  Equal consecutive symbols are one run.  The states are
what the repaired rows end with (nothing, s, u, a).  Costs to the end
cross a run by the binary powers of its symbol's min-plus transition, which
each worker caches; then choices are unrolled from the first row on, row by
row from the costs at the run's end (again by powers, CHUNK rows at a time).

In Spark: only keys (conversation, turn, role, md5) and faults of rows are
grouped, so that equal rows become one with a number; earlier rows of an
equal text are found by grouping and an equi-join.  The keys of a conversation
stream through one task, which holds its runs and its audit; the texts then
stream past the audit in the same order.  Texts are shuffled once, and no task
holds those of a conversation.

Edge cases: null roles and texts count as one space; a null conv_id is one
conversation; null turns come first; an empty role has no initial, so it can't
be kept; rows with ``copies`` 0 are not there, but their conversation is
reported; long texts and conversations stream; other columns are not read;
an empty table gives empty results.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstream.llm.common import SPACES, in_batches, shuffle_parts, table, written

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5     # costs
OK, CUT, GONE = 0, 1, 2                            # what a fault asks of an edit: nothing, 5 more, Delete
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)        # with the user or assistant row that may follow
ENDS = (0, math.inf, math.inf, 0)
LEGAL = {"su", "ua", "au"}
CHUNK = 4096

# --- the min-plus DP ----------------------------------------------------------


def kept_state(state: int, initial: str) -> int | None:
    """The state after a row that is kept, None where it can't be."""
    if initial == "s":
        return AFTER_S if state == START else None
    if initial == "u":
        return AFTER_U if state != AFTER_U else None
    return AFTER_A if initial == "a" and state == AFTER_U else None


def symbol(initial: str, fault: int) -> tuple[str, int]:
    return ("", GONE) if fault == GONE else (initial if initial in ("s", "u", "a") else "", fault)


def _times(a, b):
    return tuple(tuple(min(x + y for x, y in zip(row, column)) for column in zip(*b)) for row in a)


def _insertions():
    """Cost of the cheapest insertions from one state to another."""
    out = [[math.inf] * 4 for _ in range(4)]
    for q in range(4):
        at, cost = q, 0
        for _ in range(4):
            out[q][at] = min(out[q][at], cost)
            at, cost = NEXT[at], cost + INSERT
    return tuple(map(tuple, out))


@lru_cache(maxsize=None)
def transition(sym: tuple[str, int], k: int = 0):
    """Min-plus matrix of 2**k rows of a symbol: insertions, then the row."""
    if k:
        return _times(transition(sym, k - 1), transition(sym, k - 1))
    row = [[math.inf] * 4 for _ in range(4)]
    extra = TRUNCATED if sym[1] == CUT else 0
    for q in range(4):
        row[q][q] = DELETE
        if sym[1] != GONE:
            row[q][NEXT[q]] = min(row[q][NEXT[q]], REROLE + extra)
            to = kept_state(q, sym[0])
            if to is not None:
                row[q][to] = min(row[q][to], extra)
    return _times(_insertions(), row)


def applied(matrix, costs):
    """Costs before the rows of a matrix, and their least (taken off)."""
    out = [min(x + y for x, y in zip(row, costs)) for row in matrix]
    least = min(out)
    return tuple(x - least for x in out), least


def crossed(sym: tuple[str, int], n: int, costs) -> tuple[tuple, int]:
    """Costs before n rows of a symbol, and what was taken off."""
    off, k = 0, 0
    while n:
        if n & 1:
            costs, least = applied(transition(sym, k), costs)
            off += least
        n >>= 1
        k += 1
    return costs, off


@lru_cache(maxsize=1 << 16)
def before(sym: tuple[str, int], after: tuple) -> tuple[tuple, int]:
    return applied(transition(sym), after)


@lru_cache(maxsize=1 << 18)
def choice(sym: tuple[str, int], state: int, after: tuple) -> tuple[str, int]:
    """The least edits of a row (with insertions before it) and the state they lead to."""
    costs, off = before(sym, after)
    extra = TRUNCATED if sym[1] == CUT else 0
    letters = ""
    while True:
        left = costs[state] + off
        if DELETE + after[state] == left:
            return letters + "D", state
        if INSERT + costs[NEXT[state]] + off == left:
            letters, state = letters + "I", NEXT[state]
            continue
        to = kept_state(state, sym[0]) if sym[1] != GONE else None
        if to is not None and extra + after[to] == left:
            return letters + "K", to
        return letters + "R", NEXT[state]


AT_END = applied(_insertions(), ENDS)[0]           # their least is 0


def edits(runs: list[tuple[tuple[str, int], int]]) -> tuple[int, str]:
    """Least cost and the least of the cheapest edits of runs (symbol, rows)."""
    ends, costs, total = [], AT_END, 0
    for sym, n in reversed(runs):
        ends.append(costs)
        costs, off = crossed(sym, n, costs)
        total += off
    total += costs[START]
    state, audit = START, []
    for (sym, n), end in zip(runs, reversed(ends)):
        for at in range(0, n, CHUNK):
            to = min(n, at + CHUNK)
            after = [crossed(sym, n - to, end)[0]]
            for _ in range(to - at - 1):
                after.append(before(sym, after[-1])[0])
            for costs in reversed(after):
                letters, state = choice(sym, state, costs)
                audit.append(letters)
    while AT_END[state]:
        audit.append("I")
        state = NEXT[state]
    return total, "".join(audit)


# --- Spark --------------------------------------------------------------------

REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_REPORT = pa.schema([("conv_id", pa.int64())] + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
                    + [("audit", pa.string())])
BATCH_ROWS = 1 << 12
BATCH_CHARS = 1 << 22


def _reported(conv, rows) -> tuple:
    """A conversation's row of the report; rows: (role's initial, turn, copies, last character, seen earlier)."""
    blank = duplicate = truncated = illegal = turns = 0
    low = high = former = None
    runs: list = []
    for initial, turn, n, last, seen in rows:
        if not n:
            continue
        first = GONE if last == "" or seen else CUT if last not in ".!?" else OK
        blank += n if last == "" else 0
        duplicate += 0 if last == "" else n - (not seen)
        truncated += first == CUT
        illegal += (former is not None and former + initial not in LEGAL) + (n - 1)
        if turn is not None and (high is None or turn != high):
            low, high, turns = turn if low is None else low, turn, turns + 1
        former = initial
        for sym, count in ((symbol(initial, first), 1), (symbol(initial, GONE), n - 1)):
            if count and runs and runs[-1][0] == sym:
                runs[-1][1] += count
            elif count:
                runs.append([sym, count])
    cost, audit = edits(runs)
    return conv, (high - low + 1 - turns if turns else 0), blank, duplicate, truncated, illegal, cost, audit


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns]))
    held, chars = [], 0
    for conv, own in groupby(rows, key=lambda r: r[0]):
        held.append(_reported(conv, (r[1:] for r in own)))
        chars += len(held[-1][-1])
        if len(held) >= BATCH_ROWS or chars >= BATCH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _REPORT)], schema=_REPORT)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _REPORT)], schema=_REPORT)


def _repaired(audit: str, rows) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired rows; rows: (role, text, copies), in order."""
    state, at = START, 0
    for role, text, copies in rows:
        for _ in range(copies):
            while audit[at] == "I":
                yield ("assistant" if state == AFTER_U else "user"), ""
                state, at = NEXT[state], at + 1
            if audit[at] == "K":
                yield role, text
                state = kept_state(state, role[:1])
            elif audit[at] == "R":
                yield ("assistant" if state == AFTER_U else "user"), text
                state = NEXT[state]
            at += 1
    for _ in audit[at:]:
        yield ("assistant" if state == AFTER_U else "user"), ""
        state = NEXT[state]


_TURNS = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns]))
    held, chars = [], 0
    for conv, own in groupby(rows, key=lambda r: r[0]):
        audit = next(own)[1]
        for place, (role, text) in enumerate(_repaired(audit, (r[2:] for r in own))):
            held.append((conv, place, role, text))
            chars += len(text)
            if len(held) >= BATCH_ROWS or chars >= BATCH_CHARS:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _TURNS)], schema=_TURNS)
                held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _TURNS)], schema=_TURNS)


def _last(text: Column) -> Column:
    """The last character that is no white space, '' where there is none."""
    return F.right(F.rtrim(text, F.lit(SPACES)), F.lit(1))


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(report, repaired): a row for each conversation with its faults, cost and
    audit; the repaired rows (conv_id, place, role, text), those of a
    conversation in one partition, in order.  ``turns`` has conv_id, turn,
    role, text, and may have ``copies``."""
    n = shuffle_parts(turns.sparkSession)
    copies = F.col("copies").cast("long") if "copies" in turns.columns else F.lit(1).cast("long")
    rows = (turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit(" ")).alias("role"),
                         F.coalesce("text", F.lit(" ")).alias("text"), copies.alias("copies"))
            .withColumn("digest", F.md5("text")))
    keys = written(rows.withColumn("last", _last(F.col("text"))).groupBy("conv_id", "turn", "role", "digest")
                   .agg(F.sum("copies").alias("copies"), F.first("last").alias("last")), "turn-keys")
    # texts of several turns: where each is first
    again = (keys.where("copies > 0").groupBy("conv_id", "role", "digest")
             .agg(F.count("*").alias("n"), F.max(F.col("turn").isNull()).alias("no_turn"), F.min("turn").alias("first_turn")).where("n > 1")
             .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "no_turn", "first_turn"))
    joined = keys.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    seen = F.when(F.col("r").isNull(), False).when(F.col("no_turn"), F.col("turn").isNotNull()).otherwise(F.col("turn") != F.col("first_turn"))
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "digest"]
    lines = joined.withColumn("seen", seen).repartition(n, "conv_id").sortWithinPartitions(*order)
    report = written(in_batches(lines.select("conv_id", F.left("role", F.lit(1)), "turn", "copies", "last", "seen"), _report, REPORT), "report")
    none = F.lit(None)
    texts = (rows.where("copies > 0").select("conv_id", "turn", "role", "digest", none.cast("string").alias("audit"), "text", "copies", F.lit(1).alias("kind"))
             .unionByName(report.select("conv_id", none.cast("long").alias("turn"), none.cast("string").alias("role"),
                                        none.cast("string").alias("digest"), "audit", none.cast("string").alias("text"),
                                        none.cast("long").alias("copies"), F.lit(0).alias("kind"))))
    dealt = texts.repartition(n, "conv_id").sortWithinPartitions(order[0], "kind", *order[1:])
    repaired = in_batches(dealt.select("conv_id", "audit", "role", "text", "copies"), _apply,
                          "conv_id long, place long, role string, text string")
    return report, repaired


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns]))
    out = []
    for conv, own in groupby(rows, key=lambda r: r[0]):
        digest = hashlib.sha256()
        for _, place, role, text in own:
            digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
        out.append((conv, digest.hexdigest()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string()))], ["conv", "sha"])


def damaged(turns: DataFrame) -> DataFrame:
    """Rows with planted faults, by crc32(conv_id:turn) % 20: 0 drops a row, 1
    empties its text, 2 removes its ``.!?``, 3 repeats it, 4 sets role user."""
    text = F.coalesce("text", F.lit(" "))
    hit = F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
                              F.coalesce(F.col("turn").cast("string"), F.lit(" ")))) % 20
    return turns.select("conv_id", "turn", F.when(hit == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
                        F.when(hit == 1, "").when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("copies"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    report, repaired = repair(damaged(table(spark, sf_dir, "conversations")))
    digests = in_batches(repaired, _digests, "conv long, sha string").withColumn("found", F.lit(True))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (report.join(digests, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
            .withColumn("repaired_sha256", F.coalesce("sha", nothing)).drop("conv", "sha", "found"))


def _sql() -> str:
    def more(cost, letters, s):
        return f"lpad(CAST(CAST(left({s}, 12) AS BIGINT) + {cost} AS VARCHAR), 12, '0') || '{letters}' || substr({s}, 13)"

    def row(q):
        extra = "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END"
        stays = "fault NOT IN ('blank', 'duplicate')"
        out = [more(2, "D", f"v{q}"), f"CASE WHEN {stays} THEN {more(f'1 + {extra}', 'R', f'v{NEXT[q]}')} END"]
        for initial in "sua":
            to = kept_state(q, initial)
            if to is not None:
                out.append(f"CASE WHEN {stays} AND left(role, 1) = '{initial}' THEN {more(extra, 'K', f'v{to}')} END")
        return f"least({', '.join(out)}) AS w{q}"

    def ahead(q):
        return f"least(w{q}, {more(5, 'I', f'w{NEXT[q]}')}, {more(10, 'II', f'w{NEXT[NEXT[q]]}')}) AS v{q}"

    zero = "0" * 12
    return rf"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_concat([4294967295], flatten(list_transform(
        string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
        lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
        lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295) % 20 AS hit FROM conversations),
dam AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN hit = 1 THEN '' WHEN hit = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN hit = 0 THEN 0 WHEN hit = 3 THEN 2 ELSE 1 END)) AS copy FROM src),
pos AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS p FROM dam),
r AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'none' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY p) || left(role, 1) AS pair FROM pos),
rep AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(p) AS n FROM r GROUP BY conv_id),
st AS (
  SELECT conv_id, n + 1 AS p, '{zero}' AS v0, '000000000010II' AS v1, '000000000005I' AS v2, '{zero}' AS v3 FROM rep
  UNION ALL
  SELECT conv_id, p, {ahead(0)}, {ahead(1)}, {ahead(2)}, {ahead(3)} FROM (
    SELECT r.conv_id, r.p, {row(0)}, {row(1)}, {row(2)}, {row(3)}
    FROM st JOIN r ON r.conv_id IS NOT DISTINCT FROM st.conv_id AND r.p = st.p - 1)),
best AS (SELECT conv_id, CAST(left(v0, 12) AS BIGINT) AS cost, substr(v0, 13) AS audit FROM st WHERE p = 1),
letters AS (SELECT conv_id, unnest(range(1, len(audit) + 1)) AS i, audit FROM best),
steps AS (
  SELECT conv_id, i, audit[i] AS letter, count(*) FILTER (audit[i] <> 'I') OVER w AS p, count(*) FILTER (audit[i] <> 'D') OVER w AS o
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
rows_of AS (
  SELECT s.*, r.role, r.text, max(CASE WHEN s.o = 1 AND s.letter = 'K' AND left(r.role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY s.conv_id) AS sys
  FROM steps s LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.p = s.p AND s.letter <> 'I'),
fixed AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (o - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
    coalesce(text, ''), chr(10) ORDER BY i) AS body FROM rows_of WHERE letter <> 'D' GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN rep ON rep.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN fixed ON fixed.conv_id IS NOT DISTINCT FROM c.conv_id
"""


OP11_SQL = _sql()
