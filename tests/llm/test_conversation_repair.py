"""Operator 12 against a plain search that carries whole edit strings."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from glint.llm import conversation_repair as C

TURNS = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\f\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        said = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = said(role), said(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_search(rows, fault):
    """All edits by role letters so far: (cost, edits, lines) per last letter."""
    nxt = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def inserted(states):
        for _ in range(3):
            for x, (c, a, lines) in list(states.items()):
                y = nxt[x]
                new = (c + 3, a + "I", lines + (f"{name[y]}:",))
                states[y] = min(states.get(y, new), new)
        return states

    states = {"": (0, "", ())}
    for (_, _, role, text), f in zip(rows, fault):
        new = {}

        def add(x, way):
            new[x] = min(new.get(x, way), way)

        for x, (c, a, lines) in inserted(states).items():
            add(x, (c + 4, a + "D", lines))
            if f in ("blank", "duplicate"):
                continue
            c += 3 if f == "truncated" else 0
            if role[:1] == nxt[x] or (role[:1] == "s" and x == ""):
                add(role[:1], (c, a + "K", lines + (f"{role}:{text}",)))
            add(nxt[x], (c + 3, a + "R", lines + (f"{name[nxt[x]]}:{text}",)))
        states = new
    states = inserted(states)
    return min(states[x] for x in ("", "a") if x in states)


def brute(rows):
    key = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted(damaged([r for r in rows if r[0] == conv]), key=lambda r: (r[1] is not None, r[1] or 0, key(r)))
        if not mine:
            out.append((conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()))
            continue
        turns, f = [r[1] for r in mine if r[1] is not None], faults(mine)
        letters = [r[2][:1] for r in mine]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(letters, letters[1:]))
        cost, audit, lines = plain_search(mine, f)
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, f.count("blank"), f.count("duplicate"), f.count("truncated"), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed, convs, longest, texts=("Yes.", "no", "Why? ", "", " \t", "Well!", "then")):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        at = 0
        for _ in range(r.randrange(longest)):
            at += r.choice([0, 1, 1, 1, 2]) if r.random() < 0.3 else 1
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "sys"])
            rows.append((c, None if r.random() < 0.03 else at, role, r.choice(texts) if r.random() < 0.5 else f"{at} {r.choice(texts)}"))
    return rows


def run(spark, rows, tmp, name="conversations"):
    spark.createDataFrame(rows, TURNS).repartition(3).write.parquet(f"{tmp}/{name}.parquet")
    return sorted(map(tuple, C.op12_conversation_repair(spark, tmp).collect()), key=str)


ODD = [
    (None, 1, "user", "No id."), (None, 2, "assistant", "None."), (900, None, None, None), (901, None, "user", "a."), (901, None, "user", "a."),
    (902, 1, "user", "x" * 300_000 + "."), (902, 2, "assistant", "Long."), (903, 1, "user", "ü" * 50), (904, -5, "system", "s."),
    (904, 5, "user", "Hi."), (904, 5, "user", "Hi."), (904, 5, "assistant", "Tie."), (904, 9, "assistant", "Hi."),
]


def test_equals_plain_search_and_sql(spark, tmp):
    rows = made(1, 120, 14) + ODD
    got = run(spark, rows, tmp)
    assert got == brute(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp}/conversations.parquet/*.parquet'")
    cols = "conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256"
    assert sorted(con.execute(f"SELECT {cols} FROM ({C.OP12_SQL})").fetchall(), key=str) == got


def test_long_conversations_in_many_blocks(spark, tmp, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_ROWS", 5)
    monkeypatch.setattr(C, "BLOCK_CHARS", 60)
    rows = made(2, 6, 150) + ODD
    assert run(spark, rows, tmp) == brute(rows)


def test_one_conversation_with_most_turns(spark, tmp, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_ROWS", 64)
    r = random.Random(9)
    hot = [(7, i, ("user", "assistant")[(i + (i > 700)) % 2], f"{r.randrange(400)}{r.choice(['.', '!', ''])}") for i in range(1_500)]
    rows = hot + [(c, i, ("user", "assistant")[i], "So.") for c in range(20, 60) for i in range(2)]
    assert run(spark, rows, tmp) == brute(rows)
    found = C.repair_conversations(spark.createDataFrame(rows, TURNS).withColumn("key", F.lit(1)).withColumn("block", F.lit(2)))
    pieces = found.long.where("conv_id = 7")
    assert pieces.count() >= 1_500 // 64 and pieces.agg(F.max("n_kept")).first()[0] <= 130


def test_empty_table(spark, tmp):
    assert run(spark, [], tmp) == []


@pytest.mark.parametrize("seed", range(4))
def test_survivors_against_all_edits(seed):
    """Short conversations against every sequence of edits."""
    r = random.Random(seed)
    for _ in range(40):
        n = r.randrange(4)
        rows = [(0, i, r.choice(["user", "assistant", "system", "tool"]), r.choice(["A.", "b", "", "C!"])) for i in range(n)]
        fault = faults(rows)
        best = (99, "")
        for edits in itertools.product("DIKR", repeat=n + 2):
            for length in range(n, n + 3):
                best = min(best, cost_of(edits[:length], rows, fault))
        codes = bytes(4 * "sua".find(x[2][0]) % 16 + {"": 0, "truncated": 1, "blank": 2, "duplicate": 3}[f] if x[2][0] in "sua"
                      else 12 + {"": 0, "truncated": 1, "blank": 2, "duplicate": 3}[f] for x, f in zip(rows, fault))
        s = C.search(codes, C.EMPTY)
        end = C.best_end(s)
        assert (s.heads[end][0] + C.ENDS[end][1], s.path(end) + C.ENDS[end][0]) == best


def cost_of(edits, rows, fault):
    cost, state, i = 0, "", 0
    for e in edits:
        to = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        if e == "I":
            cost, state = cost + 3, to
            continue
        if i == len(rows):
            return (99, "")
        role, f = rows[i][2][0], fault[i]
        i += 1
        if e == "D":
            cost += 4
            continue
        if f in ("blank", "duplicate") or e == "K" and role != to and not (role == "s" and state == ""):
            return (99, "")
        cost += (3 if e == "R" else 0) + (3 if f == "truncated" else 0)
        state = role if e == "K" else to
    return (cost, "".join(edits)) if i == len(rows) and state in ("", "a") else (99, "")


def test_memory_is_the_unresolved_end():
    s = C.Survivors(C.EMPTY)
    most = 0
    r = random.Random(5)
    for i in range(20_000):
        s.turn(1 + i % 2 if r.random() < 0.9 else r.randrange(4), r.choice([0, 0, 0, 1, 2, 3]))
        most = max(most, s.held)
    assert most < 200 and len(s.emitted) > 19_000
