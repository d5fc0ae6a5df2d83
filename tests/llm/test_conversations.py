import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from strata.llm import conversations as C
from strata.llm.tables import read

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def best_by_enumeration(rows):
    """All edits of a few rows: least cost, then ASCII-least audit; rows are (role, text, fault)."""
    found, limit = None, 4 * len(rows)
    gaps = [c for n in range(3) for c in product(("user", "assistant"), repeat=n)]

    def go(i, cost, audit, out):
        nonlocal found
        if cost > limit:
            return
        for ins in gaps:
            c, a, o = cost + 3 * len(ins), audit + "I" * len(ins), out + [(r, "") for r in ins]
            if i == len(rows):
                if c <= limit and re.fullmatch("(s?(ua)+)?", "".join(r[:1] if r[:1] in ("s", "u", "a") else "x" for r, _ in o)):
                    found = min(found or (c, a, o), (c, a, o))
                continue
            role, text, fault = rows[i]
            go(i + 1, c + 4, a + "D", o)
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                go(i + 1, c + extra, a + "K", o + [(role, text)])
                for r in ("user", "assistant"):
                    go(i + 1, c + 3 + extra, a + "R", o + [(r, text)])
    go(0, 0, "", [])
    return found


def best_by_strings(rows):
    """The same by a program that carries whole audits and whole conversations."""
    best = {0: (0, "", [])}
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def spread(table):
        for _ in range(3):
            for s, (c, a, o) in list(table.items()):
                for r in ("user", "assistant"):
                    t = step.get((s, r[0]))
                    if t is not None:
                        new = (c + 3, a + "I", o + [(r, "")])
                        if t not in table or new[:2] < table[t][:2]:
                            table[t] = new
        return table

    for role, text, fault in rows:
        after = {}
        base = best
        # A longer audit may start with a shorter one; candidates are compared whole, from every insertion.
        options = []
        for s, (c, a, o) in base.items():
            options.append((s, c, a, o))
            s1, c1, a1, o1 = s, c, a, o
            for _ in range(3):
                nxt = next(((step[s1, r[0]], r) for r in ("user", "assistant") if (s1, r[0]) in step), None)
                if nxt is None:
                    break
                s1, c1, a1, o1 = nxt[0], c1 + 3, a1 + "I", o1 + [(nxt[1], "")]
                options.append((s1, c1, a1, o1))
        for s, c, a, o in options:
            moves = [(4, "D", None, s)]
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                if (s, role[:1]) in step:
                    moves.append((extra, "K", role, step[s, role[:1]]))
                moves += [(3 + extra, "R", r, step[s, r[0]]) for r in ("user", "assistant") if (s, r[0]) in step]
            for dc, letter, r, t in moves:
                new = (c + dc, a + letter, o if r is None else o + [(r, text)])
                if t not in after or new[:2] < after[t][:2]:
                    after[t] = new
        best = after
    ends = spread(dict(best))
    return min(v for s, v in ends.items() if s in (0, 3))


def fault_rows(rows):
    seen, out = set(), []
    for role, text in rows:
        last = text.rstrip(SPACE)[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def brute(conv_id, rows, best=best_by_strings):
    """The contract for one conversation; rows are (turn, role, text) of the table."""
    after = []
    for turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        after += [(turn, role, text)] * (2 if kind == 3 else 1)
    after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    marked = fault_rows([r[1:] for r in after])
    turns = {t for t, _, _ in after if t is not None}
    initials = [r[:1] for r, _, _ in marked]
    illegal = sum((x, y) not in {("s", "u"), ("u", "a"), ("a", "u")} for x, y in zip(initials, initials[1:]))
    cost, audit, out = best(marked)
    n = lambda f: sum(m[2] == f for m in marked)
    return (conv_id, max(turns) - min(turns) + 1 - len(turns) if turns else 0, n("blank"), n("duplicate"), n("truncated"), illegal,
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def by_conversation(rows):
    out = {}
    for conv, *rest in rows:
        out.setdefault(conv, []).append(tuple(rest))
    return out


def got(df):
    cols = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def want(rows, best=best_by_strings):
    return sorted((brute(c, r, best) for c, r in by_conversation(rows).items()), key=str)


def random_rows(seed, n, length, roles):
    rnd = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut", " ", "", "cut off ,", "é.", "end.\n", None]
    return [(c, t, rnd.choice(roles), rnd.choice(texts)) for c in range(n) for t in range(rnd.randint(1, length))]


def test_machine_against_enumeration():
    rnd = random.Random(5)
    for _ in range(300):
        rows = [(rnd.choice(("user", "assistant", "system", " ")), f"t{i}.", rnd.choice(("", "", "truncated", "blank"))) for i in range(rnd.randint(0, 3))]
        cost, audit, out = best_by_enumeration(rows)
        one = C.Repair(C.Steps(), 1)
        for role, text, fault in rows:
            one.add(0, role, text, fault)
        r = one.result()
        assert (r[6], r[7]) == (cost, audit), rows
        assert r[8] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in out).encode()).hexdigest()


def test_situations_stay_few_in_long_conversations(monkeypatch):
    monkeypatch.setattr(C, "SPILL", 64)     # so that backpointers go to the scratch file
    rnd = random.Random(2)
    steps = C.Steps()
    rows = [(rnd.choice(("user", "assistant", "system", "", "tool")), f"text {i}", rnd.choice(("", "", "", "truncated", "blank"))) for i in range(3000)]
    one = C.Repair(steps, 1)
    for role, text, fault in rows:
        one.add(0, role, text, fault)
    cost, audit, out = best_by_strings(rows)
    r = one.result()
    assert (r[6], r[7]) == (cost, audit)
    assert r[8] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in out).encode()).hexdigest()
    assert len(steps.situations) < 200 and len(steps.steps) < 2000


def test_query_against_brute_force(spark):
    from strata.llm import queries
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in read(spark, SF, "conversations").collect()]
    assert got(queries.op13_conversation_repair(spark, SF)) == want(rows)


@pytest.mark.parametrize("seed,roles", [(1, ["user", "assistant"]), (2, ["user", "assistant", "system", None, "", "tool", "Assistant"])])
def test_random_conversations(spark, seed, roles):
    rows = random_rows(seed, 150, 9, roles)
    assert got(C.damage_and_repair(spark.createDataFrame(rows, SCHEMA))) == want(rows)


def test_nulls_ties_repeats_long_texts_and_extra_columns(spark):
    rows = [(None, None, None, None), (None, 1, "user", "a."), (None, None, "user", "b."), (1, None, "user", "x."), (1, None, "user", "x."),
            (1, 2, "assistant", "y."), (1, 2, "assistant", "x."), (1, 2, "assistant", "y."), (2, 7, "user", "long. " * 50000),
            (2, 9, "assistant", " " * 300000 + "!" + "\n" * 300000), (3, -5, "system", "z."), (3, 2**60, "user", "q?"),
            (2**61 + 1, 0, "user", "big."), (2**61, 0, "user", "big.")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(3) for c in ("fault", "kind", "seen", "dropped", "cost", "no_id")})
    assert got(C.damage_and_repair(df)) == want(rows)


def test_all_rows_dropped_and_empty_table(spark):
    gone = next(c for c in range(1000) if all(zlib.crc32(f"{c}:{t}".encode()) % 20 == 0 for t in range(1)))
    out = got(C.damage_and_repair(spark.createDataFrame([(gone, 0, "user", "a.")], SCHEMA)))
    assert out == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert C.damage_and_repair(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_exchange_by_conversation(spark):
    plan = C.damage_and_repair(spark.createDataFrame([(1, 1, "user", "a.")], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" in plan
