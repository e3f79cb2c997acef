import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tabwright.llm import conversations as conv

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    out = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def cheapest(rows):
    """(cost, audit, lines) over all ways of editing, by trying each."""

    @lru_cache(None)
    def best(i, state):
        options = []
        if i == len(rows) and state in "Ea":
            return 0, "", ()
        after = {"E": "u", "s": "u", "u": "a", "a": "u"}[state]
        name = {"u": "user", "a": "assistant"}[after]
        if i < len(rows):
            role, text, fault = rows[i]
            extra = 5 if fault == "truncated" else 0

            def then(cost, letter, line, state):
                c, a, lines = best(i + 1, state)
                options.append((c + cost, letter + a, line + lines))

            then(2, "D", (), state)
            if fault not in ("blank", "duplicate"):
                then(1 + extra, "R", (f"{name}:{text}",), after)
                if role[:1] == after or role[:1] == "s" and state == "E":
                    then(extra, "K", (f"{role}:{text}",), role[:1])
            for more in (1, 2):
                # inserts before this row
                s, lines = state, ()
                for _ in range(more):
                    s = {"E": "u", "s": "u", "u": "a", "a": "u"}[s]
                    lines += (f"{ {'u': 'user', 'a': 'assistant'}[s]}:",)
                if fault not in ("blank", "duplicate"):
                    nxt = {"s": "u", "u": "a", "a": "u"}[s]
                    c, a, rest = best(i + 1, nxt)
                    options.append((c + 5 * more + 1 + extra, "I" * more + "R" + a, (*lines, f"{ {'u': 'user', 'a': 'assistant'}[nxt]}:{text}", *rest)))
                    if role[:1] == nxt:
                        options.append((c + 5 * more + extra, "I" * more + "K" + a, (*lines, f"{role}:{text}", *rest)))
                c, a, rest = best(i + 1, s)
                options.append((c + 5 * more + 2, "I" * more + "D" + a, lines + rest))
        else:
            c, a, lines = best(i, after)
            options.append((c + 5, "I" + a, (f"{name}:",) + lines))
        return min(options)

    import sys

    sys.setrecursionlimit(100_000)
    return best(0, "E")


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    out = {}
    for c, own in groups.items():
        found = damage(own)
        seen, faults = set(), []
        for _, role, text in found:
            shown = BLANK.findall(text)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
        turns = [t for t, _, _ in found if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        cost, audit, lines = cheapest(tuple((role, text, f) for (_, role, text), f in zip(found, faults)))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[c] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def check(spark, rows, **settings):
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = conv.report(spark, table, **settings).collect()
    want = brute(rows)
    assert len(got) == len(want)
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == want


def made(seed, n, names=("user", "assistant", "system", "tool", "", "u", None)):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rnd.randrange(0, 9)):
            turn = rnd.choice([t, t, t, t + 3, None, rnd.randrange(4)])
            text = rnd.choice(["Yes.", "No", "ok!", "", " \t\n", None, "what? ", "a.b", "日本。", "x\x0b"])
            role = rnd.choice(["user", "assistant"]) if rnd.random() < 0.6 else rnd.choice(names)
            rows.append((rnd.choice([c, c, c, c, None]) if c < 3 else c, turn, role, text))
    return rows


def test_random_conversations(spark):
    check(spark, made(1, 700))


def test_conversations_cut_into_ranges(spark):
    rnd = random.Random(2)
    rows = made(3, 40) + [
        (1000 + k, t // rnd.choice([1, 1, 2]), rnd.choice(["user", "assistant", "assistant", "tool"]), rnd.choice(["Yes.", "Well", "Hm " * 40, f"{t}."]))
        for k in range(3) for t in range(400)
    ]
    check(spark, rows, range_bytes=400)


def test_repeated_rows_and_long_texts(spark):
    long = "word " * 60_000
    rows = [(1, 1, "user", "same.")] * 500 + [(1, t, "assistant", "again.") for t in range(2, 300)] + [(2, 1, "system", "S."), (2, 2, "user", long), (2, 3, "assistant", long + ".")]
    rows += [(3, None, None, None)] * 4 + [(4, t, "user", "Yes.") for t in range(30)]
    check(spark, rows)
    check(spark, rows, range_bytes=2000)


def test_extra_columns_and_empty_tables(spark):
    rows = made(7, 30)
    clash = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("conv", "n", "part", "same", "head", "kind", "place", "damage", "blank")})
    assert {r["conv_id"]: tuple(r)[1:] for r in conv.report(spark, clash).collect()} == brute(rows)
    assert conv.report(spark, clash.limit(0)).collect() == []
    dropped = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    only = conv.report(spark, spark.createDataFrame([(9, dropped, "user", "Hi.")], SCHEMA)).collect()
    assert [tuple(r) for r in only] == [(9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_rows_fit_the_form(spark):
    rows = made(11, 200)
    got = {}
    for r in conv.repaired(spark.createDataFrame(rows, SCHEMA)).orderBy("part", "place").collect():
        got.setdefault(r["conv_id"], []).append(r["role"][0])
    assert got and all(re.fullmatch(r"(s?(ua)+)?", "".join(x)) for x in got.values())


def test_powers_of_runs():
    rnd = random.Random(5)
    for _ in range(200):
        runs = [(rnd.randrange(9), rnd.randrange(1, 40)) for _ in range(rnd.randrange(6))]
        plain = conv.END
        for code, length in reversed(runs):
            for _ in range(length):
                plain = conv._apply(conv.power(code, 0), plain)
        assert conv._apply(conv.matrix_of(runs), conv.END) == plain


def test_query_on_its_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = __spark_entry__.queries()["op13_conversation_repair"](spark, sf).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == brute(rows) and len(got) == len(brute(rows))


@pytest.mark.parametrize("initial", ["s", "u", "a", "t", ""])
def test_symbols(initial):
    assert conv.symbol(initial, "blank") == conv.symbol(initial, "duplicate") == 0
    assert conv.symbol(initial, "truncated") == conv.symbol(initial, "") + 1
