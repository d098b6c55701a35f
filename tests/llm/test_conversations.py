"""Conversation repair against a plain dynamic program, and long conversations against short."""

import hashlib
import re
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricelens.llm import conversations as C
from pricelens.llm.queries import damaged


def plain(symbols, start=0, goals=(0, 3)):
    """Least (cost, letters) by going through all edits from the end, without any heap."""
    move = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    best = {q: (0, "") if q in goals else None for q in range(4)}
    def inserted(best):
        for _ in range(4):
            for q in range(4):
                for r in "ua":
                    p = move.get((q, r))
                    if p and best[p]:
                        best[q] = min(filter(None, [best[q], (best[p][0] + 5, "I" + best[p][1])]))
        return best
    best = inserted(best)
    for s in reversed(symbols):
        now = {}
        for q in range(4):
            ways = [(2, "D", q)]
            if s not in "BD":
                for r in "sua":
                    p = move.get((q, r))
                    if p and s.lower() == r:
                        ways.append((5 * s.isupper(), "K", p))
                    elif p and r != "s":
                        ways.append((1 + 5 * s.isupper(), "R", p))
            now[q] = min([(best[p][0] + c, e + best[p][1]) for c, e, p in ways if best[p]], default=None)
        best = inserted(now)
    return best[start]


def test_all_short_conversations():
    for n in range(5):
        for symbols in product("suaxSAD", repeat=n):
            assert C.cheapest("".join(symbols)) == plain(symbols)


@settings(max_examples=80, deadline=None)
@given(st.text("suaxSUAXBD", max_size=60), st.integers(0, 3), st.sampled_from([(0, 3), (0,), (1,), (2,), (3,)]))
def test_search_between_any_states(symbols, start, goals):
    assert C.cheapest(symbols, start, goals) == plain(symbols, start, goals)


@given(st.text("suaxUAD", max_size=30))
def test_edits_give_the_pattern(symbols):
    cost, audit = C.cheapest(symbols)
    role = {"s": "system", "u": "user", "a": "assistant", "x": "tool", "d": "user"}
    rows = [(role[c.lower()], "t.") for c in symbols]
    got = list(C.edited(audit, rows))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for e, r, _ in got if e != "D"))
    assert len([e for e, *_ in got if e != "I"]) == len(symbols)
    assert all(r == rows[i][0] for i, (e, r, _) in enumerate(x for x in got if x[0] != "I") if e == "K")


def expected(rows):
    """The result for the rows of one conversation."""
    rows = sorted(((t is not None, t or 0, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows))
    seen, symbols = set(), ""
    for _, _, r, x in rows:
        tail = re.sub(r"[\x20\x09-\x0D]+$", "", x)
        s = r[:1] if r[:1] and r[:1] in "sua" else "x"
        symbols += "B" if not tail else "D" if (r, x) in seen else s if tail[-1] in ".!?" else s.upper()
        seen.add((r, x))
    cost, audit = plain(symbols)
    lines = [f"{r}:{x}" for e, r, x in C.edited(audit, [(r, x) for _, _, r, x in rows]) if e != "D"]
    turns = {t for known, t, _, _ in rows if known}
    pairs = [rows[i][2][:1] + rows[i + 1][2][:1] for i in range(len(rows) - 1)]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, symbols.count("B"), symbols.count("D"),
            sum(c in "SUAX" for c in symbols), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


SCHEMA = "conv_id long, turn long, role string, text string, audit string, conv string, kind int"


@pytest.fixture(scope="module")
def talks(spark):
    import random
    dice = random.Random(4)
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello."),
            (2, None, "user", "No turn."), (2, None, None, None), (2, 5, "assistant", "é 漢."),
            (3, 7, "", ""), (4, 1, "User", "Why?"), (4, 1, "assistant", "So. \t\n"), (4, 9, "tool", "cut"),
            (None, 0, "user", "a."), (None, 1, "assistant", "b."), (6, None, None, None)]
    for conv in range(10, 40):
        for turn in range(dice.randrange(1, 40)):
            rows.append((conv, dice.choice([turn, turn, 3, None]), dice.choice(["user", "assistant", "system", "x"]),
                         dice.choice([f"T{turn}.", "same.", "cut", "", " \x0b ", "Yes!"])))
    return rows, spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("long,piece", [(C.LONG, C.PIECE), (0, 3), (7, 2), (0, 512)])
def test_rows_equal_the_plain_program(talks, long, piece):
    rows, df = talks
    want = {c: expected([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    got = {r["conv"]: tuple(r)[1:] for r in C.repair(df, long=long, piece=piece).collect()}
    assert got == want


def test_repaired_turns(talks):
    rows, df = talks
    repairs = C.repair(df).persist()
    lines = {}
    for r in C.repaired_turns(df, repairs).orderBy("conv", "at").collect():
        lines.setdefault(r["conv"], []).append(r)
    for r in repairs.collect():
        mine = lines.get(r["conv"], [])
        assert "".join(x["edit"] for x in mine) == r["audit"]
        text = "\n".join(f"{x['role']}:{x['text']}" for x in mine if x["edit"] != "D")
        assert hashlib.sha256(text.encode()).hexdigest() == r["digest"]
    repairs.unpersist()


def test_one_long_conversation(spark):
    n = 3000
    rows = [(1, t, "assistant" if t % 2 else "user", f"Turn {t}." if t % 100 else "Again.") for t in range(n)]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA).repartition(4)
    got = C.repair(df).collect()
    assert [tuple(r)[1:] for r in got] == [expected([r[1:] for r in rows])]


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert C.repair(none).count() == 0 and damaged(none).count() == 0
