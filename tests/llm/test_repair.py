import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from tablewarden.llm import auction, repair
from tablewarden.llm.queries import QUERIES
from tests.conftest import SMALL, rows

SPACES = " \t\n\v\f\r"


def cheapest(initials, marks):
    """(cost, edits) by trying every way, shortest rows first."""
    best = {0: (0, "")}
    found = None
    for i in range(len(initials) + 1):
        for _ in range(3):
            for q, (cost, made) in list(best.items()):
                after = 3 if q == 2 else 2
                best[after] = min(best.get(after, (10**9, "")), (cost + 3, made + "I"))
        if i == len(initials):
            found = min(best[q] for q in (0, 3) if q in best)
            break
        now = {}

        def put(q, value, now=now):
            now[q] = min(now.get(q, (10**9, "")), value)
        for q, (cost, made) in best.items():
            put(q, (cost + 4, made + "D"))
            if marks[i] == "d":
                continue
            more = 3 if marks[i] == "t" else 0
            after = 3 if q == 2 else 2
            put(after, (cost + 3 + more, made + "R"))
            if initials[i] == ("a" if q == 2 else "u"):
                put(after, (cost + more, made + "K"))
            if q == 0 and initials[i] == "s":
                put(1, (cost + more, made + "K"))
        best = now
    return found


def every_way(initials, marks, most):
    """(cost, edits) over all strings of edits, without any lattice."""
    best = (10**9, "")
    for size in range(len(initials), most + 1):
        for edits in itertools.product("DIKR", repeat=size):
            if sum(e != "I" for e in edits) != len(initials):
                continue
            for first in ("", "s"):
                i, cost, said, right = 0, 0, "", True
                for e in edits:
                    want = "s" if first and not said else "ua"[(len(said) - len(first)) % 2]
                    if e == "D":
                        cost += 4
                    elif e == "I":
                        cost, said, right = cost + 3, said + want, right and want != "s"
                    else:
                        right = right and marks[i] != "d" and (initials[i] == want if e == "K" else want != "s")
                        cost, said = cost + (3 if e == "R" else 0) + (3 if marks[i] == "t" else 0), said + want
                    i += e != "I"
                if right and re.fullmatch("(s?(ua)+)?", said):
                    best = min(best, (cost, "".join(edits)))
    return best


def traced(initials, marks):
    price = auction.prices(initials, marks, auction.TAIL_COSTS)
    edits, state = auction.trace(initials, marks, price, 0)
    return price[0][0], edits + auction.TAILS[state]


def test_every_short_conversation():
    for n in range(4):
        for initials in itertools.product("suax", repeat=n):
            for marks in itertools.product(".td", repeat=n):
                assert traced(initials, marks) == cheapest(initials, marks)
    rng = random.Random(2)
    for _ in range(25):
        n = rng.randrange(4)
        initials, marks = rng.choices("suax", k=n), rng.choices("..td", k=n)
        assert traced(initials, marks) == every_way(initials, marks, n + 3)


def test_long_conversations_and_prices():
    rng = random.Random(3)
    for n in (10, 50, 400):
        for _ in range(30):
            initials, marks = "".join(rng.choices("suax", (1, 6, 6, 1), k=n)), "".join(rng.choices("..t.d", k=n))
            assert traced(initials, marks) == cheapest(initials, marks)
            # Prices are dual: no arc undercuts them.
            price = auction.prices(initials, marks, auction.TAIL_COSTS)
            for i, q in itertools.product(range(n), range(4)):
                values = [c + price[i + s][t] for _, c, s, t in auction.arcs(q, initials[i], marks[i])]
                assert price[i][q] == min(values)


def plain(table, damaged=True):
    """The contract over (conv_id, turn, role, text) in plain Python."""
    out = {c: [] for c, *_ in table}
    for conv, turn, role, text in table:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if not damaged:
            kind = 19
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    result = []
    for conv, found in out.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marks, count = set(), "", dict.fromkeys("btd", 0)
        for _, role, text in found:
            body = text.strip(SPACES)
            fault = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "."
            seen.add((role, text))
            marks += "d" if fault in "bd" else fault
            if fault != ".":
                count[fault] += 1
        initials = "".join(r[1][:1] if r[1][:1] in ("s", "u", "a") else "x" for r in found)
        turns = {r[0] for r in found if r[0] is not None}
        cost, audit = cheapest(initials, marks)
        lines, at, said = [], 0, 0
        for e in audit:
            if e != "D":
                role = "assistant" if said == 2 else "user"
                line = role + ":"
                if e != "I":
                    line = (found[at][1] if e == "K" else role) + ":" + found[at][2]
                lines.append(line)
                said = 1 if line[0] == "s" else 3 if said == 2 else 2
            at += e != "I"
        result.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, count["b"], count["d"],
                       count["t"], auction.illegal(initials), cost, audit,
                       hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(result, key=repr)


def result(df):
    return rows(df, "conv_id", *repair.RESULTS)


def test_the_query_against_plain_python(spark):
    table = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SMALL}/conversations.parquet'").fetchall()
    assert result(QUERIES["op12_repair"](spark, SMALL)) == plain(table)


def messy(rng, count):
    texts = ["Yes.", "No", "Why?", "", " \t", None, "Go!  \n", "… . ", "A long text", "ok.", "ok.", "\U0001f600!"]
    roles = ["user", "user", "assistant", "assistant", "system", "tool", None, "", "ubuntu", "User"]
    return [(rng.choice([1, 2, 3, None]) if rng.random() < 0.2 else 7, rng.choice([None, -3, *range(40)]),
             rng.choice(roles), rng.choice(texts) if rng.random() < 0.7 else f"Said {rng.randrange(99)}.")
            for _ in range(count)]


@pytest.mark.parametrize("block,most", [(1024, None), (7, None), (5, 20)])
def test_messy_rows_in_blocks(spark, block, most):
    """One conversation has most rows; blocks and split groups change nothing."""
    rng = random.Random(block)
    table = messy(rng, 150) + [(50 + i, i % 5, "user", "x") for i in range(30)]
    turns = spark.createDataFrame([(*r, 0, "k") for r in table],
                                  "conv_id bigint, turn bigint, role string, text string, pos int, conv string")
    got = repair.repaired(turns, repair.damage(turns), block_rows=block, max_rows=most)
    assert result(got) == plain(table)


def test_no_rows_and_no_rows_left(spark):
    kinds = "conv_id bigint, turn bigint, role string, text string"
    none = spark.createDataFrame([], kinds)
    assert repair.repaired(none, repair.damage(none)).collect() == []
    lost = next(t for t in range(100) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    one = spark.createDataFrame([(1, lost, "user", "Gone.")], kinds)
    empty = hashlib.sha256(b"").hexdigest()
    assert result(repair.repaired(one, repair.damage(one))) == [(1, 0, 0, 0, 0, 0, 0, "", empty)]


def test_rows_as_they_are(spark):
    """Without planted faults; a very long text is one row."""
    table = [(1, 0, "system", "Be brief."), (1, 1, "user", "word " * 50_000), (1, 2, "assistant", "Fine."),
             (2, 0, "assistant", "Hello."), (2, 5, "user", "Hi.")]
    turns = spark.createDataFrame(table, "conv_id bigint, turn bigint, role string, text string")
    assert result(repair.repair(turns)) == plain(table, damaged=False)
