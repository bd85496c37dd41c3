"""Conversation repair against an exhaustive search over edits."""

import hashlib
import re
import zlib
from collections import defaultdict
from functools import lru_cache
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridstream.llm import conversation_repair as R

WORD = re.compile(r"[^\x20\x09-\x0D]")
SYMBOLS = [(i, f) for i in ("s", "u", "a", "") for f in (R.OK, R.CUT)] + [("", R.GONE)]


def cheapest(symbols):
    """(cost, audit) by recursion on rows and the text of roles made so far."""
    @lru_cache(maxsize=None)
    def go(at, made, inserted):
        out = []
        if at == len(symbols) and (made in ("", "a") or made.endswith("ua")):
            out.append((0, ""))
        tail = made[-2:] if made else ""

        def then(initial, cost, letter, nxt, ins):
            whole = tail + initial
            ok = {"s": tail == "", "u": not tail.endswith("u"), "a": tail.endswith("u")}[initial]
            if ok:
                c, a = go(nxt, whole[-2:], ins)
                out.append((c + cost, letter + a))
        if inserted < 3:
            for i in "ua":
                then(i, 5, "I", at, inserted + 1)
        if at < len(symbols):
            initial, fault = symbols[at]
            c, a = go(at + 1, made, 0)
            out.append((c + 2, "D" + a))
            if fault != R.GONE:
                extra = 5 if fault == R.CUT else 0
                if initial:
                    then(initial, extra, "K", at + 1, 0)
                for i in "ua":
                    then(i, 1 + extra, "R", at + 1, 0)
        return min(out, default=(10 ** 9, ""))
    return go(0, "", 0)


def runs_of(symbols):
    runs = []
    for s in symbols:
        if runs and runs[-1][0] == s:
            runs[-1][1] += 1
        else:
            runs.append([s, 1])
    return runs


def test_edits_of_all_short_rows():
    for n in range(4):
        for symbols in product(SYMBOLS, repeat=n):
            assert R.edits(runs_of(symbols)) == cheapest(symbols), symbols


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(SYMBOLS), st.integers(1, 7)), max_size=10))
def test_edits_of_runs(runs):
    symbols = [s for s, n in runs for _ in range(n)]
    assert R.edits(runs_of(symbols)) == cheapest(tuple(symbols))


def test_long_runs_equal_single_rows(monkeypatch):
    runs = [[("u", R.OK), 1000], [("", R.GONE), 300], [("a", R.CUT), 777], [("s", R.OK), 5], [("a", R.OK), 1]]
    whole = R.edits(runs)
    single = R.edits([[s, 1] for s, n in runs for _ in range(n)])
    monkeypatch.setattr(R, "CHUNK", 7)
    assert whole == single == R.edits(runs) and len(whole[1].replace("I", "")) == sum(n for _, n in runs)


def brute(rows):
    """Report and repaired rows by conversation; rows: (conv, turn, role, text, copies)."""
    own = defaultdict(list)
    for conv, turn, role, text, copies in rows:
        role, text = " " if role is None else role, " " if text is None else text
        own[conv] += [(turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest(), turn, text)] * copies
    out = {}
    for conv, found in own.items():
        found.sort(key=lambda r: r[:4])
        seen, faults, symbols = set(), [], []
        for *_, role, _, _, text in found:
            visible = WORD.findall(text)
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            symbols.append(R.symbol(role[:1], {"blank": R.GONE, "duplicate": R.GONE, "truncated": R.CUT, "": R.OK}[fault]))
        cost, audit = cheapest(tuple(symbols)) if len(symbols) < 9 else R.edits(runs_of(symbols))
        made, at = [], 0
        for letter in audit:
            place = len(made) - bool(made and made[0][0].startswith("s"))
            role = "assistant" if place % 2 else "user"
            if letter == "I":
                made.append((role, ""))
                continue
            row = found[at]
            at += 1
            if letter != "D":
                made.append((row[2] if letter == "K" else role, row[5]))
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in made))
        turns = {r[4] for r in found} - {None}
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(found, found[1:])]
        out[conv] = ((max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                      faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit), made)
    return out


TURNS = "conv_id long, turn long, role string, text string, copies long, place string, audit string, digest string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TURNS).repartition(3)


AWKWARD = [
    (1, 0, "system", "Be kind.", 1), (1, 1, "user", "Hello?", 1), (1, 2, "assistant", "Hi.", 1), (1, 5, "user", "And", 1), (1, 6, "assistant", "No!", 1),
    (2, 0, "user", "", 1), (2, 1, "user", " \t\n", 1), (2, 2, "assistant", None, 1),
    (3, 0, "user", "Same.", 3), (3, 0, "user", "Same.", 2), (3, 1, "assistant", "Same.", 1), (3, 2, "user", "Same.", 1), (3, None, "user", "Same.", 1),
    (4, None, None, "No role.", 1), (4, None, "", "Empty role.", 1), (4, 0, "tool", "Tool.", 1), (4, 1, "system", "Late.", 1),
    (5, 0, "user", "Dropped.", 0), (5, 1, "user", "Dropped.", 0),
    (6, 7, "unicorn", "Kept as it is. ", 1), (6, 8, "assistant", "x" * 100000 + "!", 1), (6, 9, "user", "é🙂?", 1), (6, 10, "assistant", "Yes.\n\n ", 1),
    (None, 0, "user", "No id.", 1), (None, 1, "assistant", "No id.", 1), (None, None, "user", "cut", 1),
    (7, 3, "User", "Capital.", 1), (7, 4, "assistant", "Fine.", 1), (-8, 0, "assistant", "First.", 1), (-8, 1, "system", "Second.", 1)]


def results(df):
    report, repaired = df
    rows = defaultdict(list)
    for r in repaired.collect():
        rows[r.conv_id].append((r.place, r.role, r.text))
    return {r.conv_id: (tuple(r)[1:], [x[1:] for x in sorted(rows[r.conv_id])]) for r in report.collect()}


def test_awkward_rows(spark):
    want = brute(AWKWARD)
    want[5] = ((0, 0, 0, 0, 0, 0, ""), [])
    got = results(R.repair(conversations(spark, AWKWARD)))
    assert got == want


def test_one_long_conversation(spark):
    rows = [(1, i, ["user", "assistant", "user", "tool"][i * i % 4], ["Yes.", f"Line {i}.", f"cut {i}", ""][i * 7 % 11 % 4], 1) for i in range(5000)]
    rows += [(2, 0, "user", "Again and again.", 1)] * 2000
    assert results(R.repair(conversations(spark, rows))) == brute(rows)


def test_empty_table(spark):
    report, repaired = R.repair(conversations(spark, AWKWARD).limit(0))
    assert report.count() == 0 and repaired.count() == 0


@pytest.mark.parametrize("sf", ["0.001"])
def test_query(spark, sf):
    d = f"/root/testdata/sf{sf}"
    rows = []
    for r in spark.read.parquet(f"{d}/conversations.parquet").collect():
        hit = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", r.text) if hit == 2 else r.text
        rows.append((r.conv_id, r.turn, "user" if hit == 4 else r.role, text, {0: 0, 3: 2}.get(hit, 1)))
    want = brute([r for r in rows if r[4]])
    empty = ((0, 0, 0, 0, 0, 0, ""), [])
    got = {r.conv_id: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
           for r in R.op11_conversation_repair(spark, d).collect()}
    assert got == {c: (*want.get(c, empty)[0], hashlib.sha256("\n".join(f"{a}:{b}" for a, b in want.get(c, empty)[1]).encode()).hexdigest())
                   for c in {r[0] for r in rows}}
