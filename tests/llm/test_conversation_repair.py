import hashlib
import random
import zlib

import pytest

from quayside.llm import conversation_repair as cr
from quayside.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, n string, run long"
BLANKS = " \t\n\r\f\v"


def damage(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def exhaustive(codes):
    """Every sequence of edits no dearer than the best found so far."""
    best = [(10**9, "")]

    def sound(roles):
        rest = roles[1:] if roles.startswith("s") else roles
        return roles == "" or (rest and rest == "ua" * (len(rest) // 2))

    def may_go_on(roles):
        rest = roles[1:] if roles.startswith("s") else roles
        return rest == ("ua" * len(rest))[: len(rest)]

    def go(i, roles, cost, audit):
        if cost > best[0][0] or not may_go_on(roles):
            return
        if i == len(codes) and sound(roles):
            best[0] = min(best[0], (cost, audit))
        if i < len(codes):
            c = codes[i]
            if c not in "bd":
                extra = 3 if c.isupper() else 0
                if c.lower() in "sua":
                    go(i + 1, roles + c.lower(), cost + extra, audit + "K")
                for r in "ua":
                    go(i + 1, roles + r, cost + extra + 3, audit + "R")
            go(i + 1, roles, cost + 4, audit + "D")
        for r in "ua":
            go(i, roles + r, cost + 3, audit + "I")

    go(0, "", 0, "")
    return best[0]


def plain(codes):
    """The same by relaxing all ways until nothing changes, for longer conversations."""
    n, ways = len(codes), {(0, 0): (0, "")}
    changed = True
    while changed:
        changed = False
        for (i, q), (cost, audit) in list(ways.items()):
            steps = [(i, cr.LEADS[q][r], 3, "I") for r in "ua" if r in cr.LEADS[q]]
            if i < n:
                for extra, initial, role in cr.row_edits(codes[i]):
                    if not role or role in cr.LEADS[q]:
                        steps.append((i + 1, cr.LEADS[q][role] if role else q, extra, initial))
            for j, p, extra, initial in steps:
                new = cost + extra, audit + initial
                if new < ways.get((j, p), (10**9, "")):
                    ways[j, p], changed = new, True
    return min(ways[n, q] for q in (0, 3) if (n, q) in ways)


def expected(rows):
    """Per conversation, from its definition."""
    after = damage(rows)
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in after if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        codes, seen = "", set()
        for _, role, text in mine:
            ink = text.strip(BLANKS)
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "b" if not ink else "d" if (role, text) in seen else initial if ink[-1] in ".!?" else initial.upper()
            seen.add((role, text))
        turns = {r[0] for r in mine if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit = plain(codes)
        left = len(audit) - audit.count("D")
        roles = ("s" if left % 2 else "") + "ua" * (left // 2)
        lines, rows_left = [], list(mine)
        for initial in audit:
            if initial == "I":
                lines.append({"u": "user", "a": "assistant"}[roles[len(lines)]] + ":")
                continue
            _, role, text = rows_left.pop(0)
            if initial == "R":
                role = {"u": "user", "a": "assistant"}[roles[len(lines)]]
            if initial != "D":
                assert role[0] == roles[len(lines)]
                lines.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, codes.count("b"), codes.count("d"), sum(c.isupper() for c in codes), illegal, cost, audit, digest)
    return out


def conversations(seed=3, n=60):
    rng = random.Random(seed)
    says = ["Hello there.", "What is it?", "no stop", "", " \n", "Ünï!", "Well. ", "ok.\xa0", None, "x" * 40000 + "."]
    rows = []
    for conv in range(n):
        turn = 0
        for _ in range(rng.choice([1, 2, 3, 5, 9])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            rows.append((conv, turn if rng.random() < 0.9 else None, role, rng.choice(says), "n", 1))
            turn += rng.choice([1, 1, 1, 0, 4])
    rows += [(None, 1, "user", "of no id.", "n", 1), (None, 2, "assistant", "yes.", "n", 1), rows[0], rows[0]]
    rows += [(5, None, "user", "late?", None, None)] * 3
    for turn in range(90):  # a long one
        rows.append((1000, turn * 2, ["user", "assistant", "assistant", "tool"][turn * turn % 4], f"line {turn % 17}" + "." * (turn % 3 > 0), "n", 1))
    for turn in range(60):
        rows.append((1001, None if turn % 2 else 7, "user", "again and again.", "n", 1))
    dropped = next(i for i in range(2000, 9000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    return [*rows, (dropped, 0, "user", "Gone.", "n", 1)]


def test_edits_against_every_sequence():
    rng = random.Random(1)
    for _ in range(250):
        codes = "".join(rng.choice("suaxSUAXbdua") for _ in range(rng.randint(0, 5)))
        assert cr.cheapest_edits(codes) == exhaustive(codes), codes
        assert plain(codes) == exhaustive(codes), codes


@pytest.mark.parametrize("stretch", [1, 3, 256])
def test_stretches_join_to_the_whole(monkeypatch, stretch):
    monkeypatch.setattr(cr, "STRETCH", stretch)
    rng = random.Random(2)
    for _ in range(60):
        codes = "".join(rng.choice("suaxSUAXbduaua") for _ in range(rng.randint(0, 30)))
        assert cr.cheapest_edits(codes) == plain(codes), codes


def test_agenda_stops_at_the_goal():
    popped = []

    def deduce(item, weight):
        popped.append(item)
        yield (weight[0] + 1, weight[1] + "x"), item + 1

    assert cr.lightest([((0, ""), 0)], deduce, {5})[5] == (5, "xxxxx")
    assert popped == [0, 1, 2, 3, 4]


@pytest.mark.parametrize(("long", "stretch", "fan"), [(4096, 256, 16), (8, 4, 2), (0, 1, 2)])
def test_report_against_the_definition(spark, monkeypatch, long, stretch, fan):
    for name, value in (("LONG", long), ("STRETCH", stretch), ("FAN", fan)):
        monkeypatch.setattr(cr, name, value)
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = [tuple(r) for r in cr.repair_report(cr.damaged(df)).collect()]
    want = expected(rows)
    assert len(got) == len(want)
    assert {r[0]: r[1:] for r in got} == want
    assert any(r[7] == "" for r in got)


@pytest.mark.parametrize("long", [4096, 8])
def test_turns_after_repair(spark, monkeypatch, long):
    monkeypatch.setattr(cr, "LONG", long)
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    turns = {}
    for r in sorted(cr.repaired_turns(cr.damaged(df)).collect(), key=lambda r: r["place"]):
        turns.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    digests = {conv: hashlib.sha256("\n".join(lines).encode()).hexdigest() for conv, lines in turns.items()}
    empty = hashlib.sha256(b"").hexdigest()
    assert {conv: digests.get(conv, empty) for conv in expected(rows)} == {conv: v[-1] for conv, v in expected(rows).items()}


def test_undamaged_rows_and_clashing_columns(spark):
    rows = [(1, 0, "user", "Hi.", "n", 1), (1, 1, "assistant", "Yes.", "n", 1), (2, None, "tool", "what", "n", 1)]
    got = {r["conv_id"]: r for r in cr.repair_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[1]["cost"], got[1]["audit"], got[1]["gaps"]) == (0, "KK", 0)
    assert (got[2]["cost"], got[2]["audit"]) == (4, "D")


def test_empty_table(spark):
    assert cr.repair_report(spark.createDataFrame([], SCHEMA)).collect() == []
    assert cr.repaired_turns(cr.damaged(spark.createDataFrame([], SCHEMA))).collect() == []


def test_query_against_the_definition(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_conversation_repair"](spark, sf)
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r)[1:] for r in got.select(*names).collect()} == expected(rows)
