"""Repair of conversation structure by a Viterbi search that emits edits as
soon as its survivors agree.

The turns of a conversation, in order, are edited so that the first letters
of the roles read `(s?(ua)+)?`. Edits: keep a turn (0), give it the role user
or assistant (3), delete it (4; blank and repeated turns must go), insert an
empty user or assistant turn anywhere (3); a truncated turn that stays costs 3
more. Of the cheapest edits those win whose initials (D, I, K, R), read from
the first to the last, come first in ASCII order.

Search. Four states tell what the roles so far end in. After each turn each
state has one survivor; its edits are a path in a backpointer tree whose
nodes count their children. A state that no continuation can make good is
dropped (strictly worse than another by more than the dearest detour between
them). A node without children is freed; while the oldest node has one child,
all survivors share it and its edits are emitted. What is held is
the unresolved end alone, and a tie compares the two whole unresolved ends.

Scale. Turns are dealt by ranges of (conversation, turn) and cut into blocks
of bounded size; a long conversation is many blocks in many tasks. Blocks that
hold a whole conversation are repaired as they are. For the others each
block gives, for each state it may be entered in, the cost and the rank among
ties of its best edits to each state it may be left in. One pass backward over
these block summaries (a few numbers for `BLOCK_ROWS` turns) finds the cost
to go, one pass forward the states on the chosen path; then every block is
repaired alone, between the states it is entered and left in. Turns that
repeat an earlier block's are found by a grouping of the blocks' distinct
hashes.

Defined cases: null roles and texts count as one space; a null conversation
id is one conversation; null turns come first; turns of one number are taken
in the order of `tie_key` (MD5 of role and text), equal ones are
interchangeable; an empty role starts with no letter; a text of any length is
kept whole; further columns are ignored; an empty table gives no rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD_SPACE, n_partitions, save_table, small_batches

BLOCK_ROWS = 1_024       # turns in one block
BLOCK_CHARS = 1_000_000  # ... and characters, unless one turn has more
TOP = 2**63 - 1

# --- the search -----------------------------------------------------------

EMPTY, SYSTEM, USER, ASSISTANT = range(4)  # what the repaired roles end in
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
NEVER = 1 << 60
#: Turns inserted at the end to make the roles complete, and their cost.
ENDS = {EMPTY: ("", 0), SYSTEM: ("II", 2 * INSERT), USER: ("I", INSERT), ASSISTANT: ("", 0)}
#: DETOUR[x][y]: whatever follows state x follows state y at this extra cost.
DETOUR = {
    EMPTY: {SYSTEM: 6, USER: 7, ASSISTANT: 4},
    SYSTEM: {EMPTY: 0, USER: 3, ASSISTANT: 0},
    USER: {EMPTY: 3, SYSTEM: 3, ASSISTANT: 3},
    ASSISTANT: {EMPTY: 0, SYSTEM: 6, USER: 3},
}
INITIALS = "sua"         # the letters of the states after EMPTY
CLEAN, TRUNCATED, BLANK, REPEATED = range(4)  # a turn's fault
_NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}


def _moves(initial: int, fault: int) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, edits) of one turn, the edits being up to two
    insertions and what becomes of the turn; one move for each pair of
    states, the cheapest, the first in ASCII order among those."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for x in range(4):
        y = x
        for inserted in range(3):
            cost, label = inserted * INSERT, "I" * inserted
            options = [(y, cost + DELETE, label + "D")]
            if fault in (CLEAN, TRUNCATED):
                cost += CUT if fault == TRUNCATED else 0
                if initial + 1 == _NEXT[y] or (y == EMPTY and initial + 1 == SYSTEM):
                    options.append((initial + 1, cost + KEEP, label + "K"))
                options.append((_NEXT[y], cost + REROLE, label + "R"))
            for to, c, edits in options:
                best[x, to] = min(best.get((x, to), (NEVER, "")), (c, edits))
            y = _NEXT[y]
    return [(x, to, c, edits) for (x, to), (c, edits) in sorted(best.items())]


#: By initial (s, u, a, any other) and fault.
MOVES = {(i, f): _moves(i, f) for i in range(4) for f in range(4)}


class Survivors:
    """Cheapest edits to each state, as a tree of backpointers."""

    def __init__(self, state: int):
        self.parent, self.edits, self.children, self.sum = [-1], [""], [0], [0]
        self.free: list[int] = []
        self.root = 0
        self.heads: dict[int, tuple[int, int]] = {state: (0, 0)}  # state -> cost, node
        self.emitted: list[str] = []

    def _before(self, a: int, x: str, b: int, y: str) -> bool:
        """Do the edits up to node `a` and then `x` come before those up to
        `b` and then `y`? Both nodes have seen the same turns."""
        left, right = [x], [y]
        while a != b:
            left.append(self.edits[a])
            right.append(self.edits[b])
            a, b = self.parent[a], self.parent[b]
        return "".join(reversed(left)) < "".join(reversed(right))

    def _node(self, parent: int, edits: str) -> int:
        if self.free:
            n = self.free.pop()
            self.parent[n], self.edits[n], self.children[n], self.sum[n] = parent, edits, 0, 0
        else:
            n = len(self.parent)
            self.parent.append(parent)
            self.edits.append(edits)
            self.children.append(0)
            self.sum.append(0)
        self.children[parent] += 1
        self.sum[parent] += n
        return n

    def turn(self, initial: int, fault: int) -> None:
        heads, found = self.heads, {}
        for x, to, c, edits in MOVES[initial, fault]:
            if x in heads:
                cost, node = heads[x]
                cost += c
                have = found.get(to)
                if have is None or cost < have[0] or cost == have[0] and self._before(node, edits, have[1], have[2]):
                    found[to] = (cost, node, edits)
        kept = {
            x: f for x, f in found.items()
            if not any(f[0] > g[0] + DETOUR[x][y] for y, g in found.items() if y != x)}
        self.heads = {x: (cost, self._node(node, edits)) for x, (cost, node, edits) in kept.items()}
        for _, n in heads.values():
            while n != self.root and not self.children[n]:  # no survivor's path
                up = self.parent[n]
                self.children[up] -= 1
                self.sum[up] -= n
                self.free.append(n)
                n = up
        ends = {n for _, n in self.heads.values()}
        while self.children[self.root] == 1 and self.root not in ends:
            child = self.sum[self.root]
            self.free.append(self.root)
            self.root = child
            self.emitted.append(self.edits[child])

    def path(self, state: int) -> str:
        """All edits of the survivor that ends in `state`."""
        out, n = [], self.heads[state][1]
        while n != self.root:
            out.append(self.edits[n])
            n = self.parent[n]
        return "".join(self.emitted) + "".join(reversed(out))

    @property
    def held(self) -> int:
        return len(self.parent) - len(self.free)


def search(codes: bytes, state: int) -> Survivors:
    """Survivors after turns of the codes 4 * initial + fault."""
    s = Survivors(state)
    for c in codes:
        s.turn(c >> 2, c & 3)
    return s


def best_end(s: Survivors, ends=ENDS) -> int:
    """The state in which the cheapest edits end."""
    cost = {x: c + ends[x][1] for x, (c, _) in s.heads.items()}
    least = min(cost.values())
    return min((x for x in cost if cost[x] == least), key=lambda x: s.path(x) + ends[x][0])


def apply_edits(audit: str, state: int, roles: list[str], texts: list[str]) -> list[str]:
    """The repaired turns, `role:text` each, of edits that start in `state`."""
    out, i = [], 0
    for e in audit:
        if e == "D":
            i += 1
            continue
        to = SYSTEM if e == "K" and state == EMPTY and roles[i][:1] == "s" else _NEXT[state]
        role = roles[i] if e == "K" else "user" if to == USER else "assistant"
        out.append(f"{role}:{'' if e == 'I' else texts[i]}")
        i += e != "I"
        state = to
    return out


# --- blocks ---------------------------------------------------------------

def tie_key(role: Column, text: Column) -> Column:
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def _cut(most_rows: int, most_chars: int):
    """Sorted turns (conv_id, turn, key, row, role, text, code) of a range ->
    blocks. `whole`: the block is its whole conversation."""

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "block", "turn0", "key0", "whole", "turns", "keys", "roles", "texts", "codes"]
        rest, began = None, False  # does the open block begin its conversation?

        def blocks(b: pa.RecordBatch, last: bool):
            """All blocks of `b`, but the one that may go on."""
            nonlocal began
            conv, chars = b.column(0).to_pylist(), pc.utf8_length(b.column(5)).to_pylist()
            cuts, whole, size = [0], [], 0
            for i in range(1, len(conv)):
                size += chars[i - 1]
                if conv[i] != conv[i - 1]:
                    whole.append(began)
                    cuts.append(i)
                    size, began = 0, True
                elif i - cuts[-1] >= most_rows or size >= most_chars:
                    whole.append(False)
                    cuts.append(i)
                    size, began = 0, False
            if last:
                cuts.append(len(conv))
                whole.append(False)  # may go on in the next range
            if len(cuts) > 1:
                at, end = pa.array(cuts[:-1], pa.int64()), cuts[-1]
                offsets = pa.array(cuts, pa.int32())
                part = b.slice(0, end)
                lists = [pa.ListArray.from_arrays(offsets, part.column(c)) for c in (1, 2, 4, 5)]
                codes = part.column(6).to_numpy().astype(np.uint8).tobytes()
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(at), b.column(3).take(at), b.column(1).take(at), b.column(2).take(at),
                    pa.array(whole, pa.bool_()), *lists, pa.array([codes[x:y] for x, y in zip(cuts, cuts[1:])], pa.binary())], names)
            return b.slice(cuts[-1]) if not last else None

        for b in it:
            if not b.num_rows:
                continue
            rest = b if rest is None else pa.Table.from_batches([rest, b]).combine_chunks().to_batches()[0]
            rest = yield from blocks(rest, False)
        if rest is not None and rest.num_rows:
            yield from blocks(rest, True)

    return cut


def _faults(codes: bytes, keys: list[str], seen: set[str]) -> bytes:
    """The codes with the fault REPEATED where the turn was there before."""
    out = bytearray(codes)
    for i, k in enumerate(keys):
        if k in seen and out[i] & 3 != BLANK:
            out[i] = out[i] & ~3 | REPEATED
        seen.add(k)
    return bytes(out)


_LEGAL = {(0, 1), (1, 2), (2, 1)}


def _counts(codes: bytes, turns: list) -> dict[str, int]:
    faults = np.bincount(np.frombuffer(codes, np.uint8) & 3, minlength=4)
    initials = [c >> 2 for c in codes]
    some = [t for t in turns if t is not None]
    return {
        "blank": int(faults[BLANK]), "duplicate": int(faults[REPEATED]), "truncated": int(faults[TRUNCATED]),
        "illegal": sum(p not in _LEGAL for p in zip(initials, initials[1:])), "n_turns": len(set(some)),
        "low": min(some, default=None), "high": max(some, default=None)}


def _gaps(low, high, n: int) -> int:
    return 0 if low is None else min(TOP, high - low + 1 - n)


_STATS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _whole(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks that are whole conversations -> counts and repaired turns."""
    for b in it:
        rows = []
        for turns, keys, roles, texts, codes in zip(*(b.column(i).to_pylist() for i in range(1, 6))):
            codes = _faults(codes, keys, set())
            n, s = _counts(codes, turns), search(codes, EMPTY)
            end = best_end(s)
            audit = s.path(end) + ENDS[end][0]
            fixed = apply_edits(audit, EMPTY, roles, texts)
            rows.append([_gaps(n["low"], n["high"], n["n_turns"]), *(n[k] for k in _STATS[1:5]),
                         s.heads[end][0] + ENDS[end][1], audit, len(fixed), "\n".join(fixed)])
        cols = list(zip(*rows)) or [[]] * 9
        yield pa.RecordBatch.from_arrays(
            [b.column(0), *(pa.array(c, pa.int64()) for c in cols[:6]), pa.array(cols[6], pa.string()),
             pa.array(cols[7], pa.int64()), pa.array(cols[8], pa.string())],
            ["conv_id", *_STATS, "audit", "n_kept", "repaired"])


def _summaries(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks and the turns seen before them -> codes, counts, and for each
    state entered in: costs and ranks of the states left in."""
    for b in it:
        out: dict[str, list] = {n: [] for n in ("codes", "cost", "rank", "blank", "duplicate", "truncated", "illegal", "n_turns", "low", "high", "last")}
        for turns, keys, codes, seen in zip(*(b.column(i).to_pylist() for i in range(4, 8))):
            codes = _faults(codes, keys, set(seen or ()))
            out["codes"].append(codes)
            for k, v in _counts(codes, turns).items():
                out[k].append(v)
            out["last"].append(turns[-1])
            cost, rank = [], []
            for state in range(4):
                s = search(codes, state)
                order = sorted(s.heads, key=s.path)
                cost += [s.heads[x][0] if x in s.heads else NEVER for x in range(4)]
                rank += [order.index(x) if x in s.heads else 4 for x in range(4)]
            out["cost"].append(cost)
            out["rank"].append(rank)
        types = {"codes": pa.binary(), "cost": pa.list_(pa.int64()), "rank": pa.list_(pa.int64())}
        yield pa.RecordBatch.from_arrays(
            [*(b.column(i) for i in range(4)), *(pa.array(v, types.get(k, pa.int64())) for k, v in out.items())],
            ["conv_id", "block", "turn0", "key0", *out])


def _backward(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summaries (conv_id, .., cost) from a conversation's last block to its
    first -> the same with the cost to go after the block."""
    conv, goal = object(), []
    for b in it:
        at, out = b.schema.get_field_index("cost"), []
        for c, cost in zip(b.column(0).to_pylist(), b.column(at).to_pylist()):
            if c != conv:
                conv, goal = c, [ENDS[x][1] for x in range(4)]
            out.append(goal)
            goal = [min(cost[4 * x + y] + goal[y] for y in range(4)) for x in range(4)]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.list_(pa.int64()))], [*b.schema.names, "goal"])


def _forward(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summaries with the cost to go, first to last -> the states on the best
    path, and a conversation's counts so far (complete in its last block)."""
    conv, t = object(), {}
    for b in it:
        plan, stats = [], []
        for row in b.to_pylist():
            codes = row["codes"]
            if row["conv_id"] != conv:
                conv = row["conv_id"]
                t = dict.fromkeys([*_STATS, "n_turns"], 0) | {"no": 0, "state": EMPTY, "low": None, "high": None, "turn": None, "initial": None}
            else:
                t["no"] += 1
                t["illegal"] += (t["initial"], codes[0] >> 2) not in _LEGAL
                t["n_turns"] -= row["turn0"] is not None and row["turn0"] == t["turn"]
            for k in ("blank", "duplicate", "truncated", "illegal", "n_turns"):
                t[k] += row[k]
            if row["low"] is not None:
                t["low"] = row["low"] if t["low"] is None else t["low"]
                t["high"] = row["high"]
            t["turn"], t["initial"] = row["last"], codes[-1] >> 2
            x = t["state"]
            cost, rank, goal = row["cost"][4 * x: 4 * x + 4], row["rank"][4 * x: 4 * x + 4], row["goal"]
            end = min(range(4), key=lambda y: (cost[y] + goal[y], rank[y]))
            t["cost"] += cost[end]
            t["state"] = end
            plan.append((t["no"], x, end))
            stats.append([_gaps(t["low"], t["high"], t["n_turns"]), *(t[k] for k in _STATS[1:5]), t["cost"] + ENDS[end][1]])
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(b.schema.get_field_index("codes")),
             *(pa.array(c, pa.int64()) for c in zip(*plan)), *(pa.array(c, pa.int64()) for c in zip(*stats))],
            ["conv_id", "block", "codes", "no", "entered", "left", *_STATS])


def _parts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with their counts and states -> repaired turns; the last block of a
    conversation also inserts what is missing at the end."""
    for b in it:
        audits, kept, texts_out = [], [], []
        for end, entered, left, codes, roles, texts in zip(*(b.column(i).to_pylist() for i in range(8, 14))):
            audit = search(codes, entered).path(left) + (ENDS[left][0] if end else "")
            fixed = apply_edits(audit, entered, roles, texts)
            audits.append(audit)
            kept.append(len(fixed))
            texts_out.append("\n".join(fixed))
        yield pa.RecordBatch.from_arrays(
            [*b.columns[:8], pa.array(audits, pa.string()), pa.array(kept, pa.int64()), pa.array(texts_out, pa.string())],
            ["conv_id", "no", *_STATS, "audit", "n_kept", "repaired"])


class Repaired(NamedTuple):
    """`short`: conversations in one piece; `long`: the pieces of the others.
    Both hold conv_id, no (from 0), the counts of the whole conversation
    (gaps, blank, duplicate, truncated, illegal, cost), and of the piece its
    edits (audit), n_kept (turns) and repaired (`role:text` lines)."""

    short: DataFrame
    long: DataFrame


def repair_conversations(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> Repaired:
    """Repair every conversation of `turns`."""
    spark = turns.sparkSession
    small_batches(spark)
    parts = n_partitions(spark)
    said = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"), said(role).alias("role"), said(text).alias("text"))
    bare = F.expr(f"trim(TRAILING '{WORD_SPACE}' FROM text)")
    fault = F.when(bare == "", BLANK).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), CLEAN).otherwise(TRUNCATED)
    initial = F.coalesce(*[F.when(F.left("role", F.lit(1)) == c, i) for i, c in enumerate(INITIALS)], F.lit(3))
    order = ["conv_id", "turn", "key", "row"]  # nulls first
    rows = rows.select(
        "conv_id", "turn", tie_key(F.col("role"), F.col("text")).alias("key"), F.monotonically_increasing_id().alias("row"),
        "role", "text", (4 * initial + fault).cast("byte").alias("code"))
    kind = rows.schema["conv_id"].dataType

    def schema(*fields: str) -> T.StructType:
        return T.StructType([T.StructField("conv_id", kind), *T.StructType.fromDDL(", ".join(fields)).fields])

    block = ("block long", "turn0 long", "key0 string")
    blocks = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_cut(BLOCK_ROWS, BLOCK_CHARS), schema(
        *block, "whole boolean", "turns array<bigint>", "keys array<string>", "roles array<string>", "texts array<string>", "codes binary"))
    blocks = save_table(blocks, "turn-blocks")

    stats = [f"{c} long" for c in _STATS]
    piece = ("audit string", "n_kept long", "repaired string")
    whole = blocks.where("whole").select("conv_id", "turns", "keys", "roles", "texts", "codes").mapInArrow(
        _whole, schema(*stats, *piece))

    # conversations of several blocks, and the two at the ends of a range
    cut = blocks.where("NOT whole")
    keys = cut.select("conv_id", "block", "turn0", "key0", F.explode(F.array_distinct("keys")).alias("key"))
    place = F.struct("turn0", "key0", "block")
    first = keys.groupBy("conv_id", "key").agg(F.min(place).alias("first"))
    again = keys.alias("k").join(
        first.alias("f"), F.expr("k.key = f.key AND k.conv_id <=> f.conv_id AND f.first.block <> k.block"))
    seen = again.groupBy(F.col("k.block").alias("block")).agg(F.collect_list("k.key").alias("seen"))
    counted = ("codes binary", "cost array<bigint>", "rank array<bigint>", "blank long", "duplicate long", "truncated long",
               "illegal long", "n_turns long", "low long", "high long", "last long")
    marked = cut.select("conv_id", "block", "turn0", "key0", "turns", "keys", "codes").join(seen, "block", "left")
    marked = marked.select("conv_id", "block", "turn0", "key0", "turns", "keys", "codes", "seen")
    sums = marked.mapInArrow(_summaries, schema(*block, *counted))
    down = [F.col("conv_id").desc(), F.col("turn0").desc(), F.col("key0").desc(), F.col("block").desc()]
    sums = sums.repartition(parts, "conv_id").sortWithinPartitions(*down).mapInArrow(
        _backward, schema(*block, *counted, "goal array<bigint>"))
    sums = save_table(sums, "turn-sums")
    plan = sums.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "turn0", "key0", "block").mapInArrow(
        _forward, schema("block long", "codes binary", "no long", "entered long", "left long", *stats))
    plan = save_table(plan, "turn-plan")
    total = plan.groupBy(F.col("conv_id").alias("_conv")).agg(F.count("*").alias("n_pieces"), F.max_by(F.struct(*_STATS), "no").alias("s"))
    plan = plan.drop(*_STATS).join(total, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "block", "codes", "no", "entered", "left", "n_pieces", "s.*")
    carried = ["conv_id", "no", *_STATS]

    def mended(which: DataFrame) -> DataFrame:
        rows = which.join(cut.select("conv_id", "block", "roles", "texts"), "block").select(
            *carried, (F.col("no") == F.col("n_pieces") - 1).alias("end"), "entered", "left", "codes", "roles", "texts")
        return rows.mapInArrow(_parts, schema("no long", *stats, *piece))

    short = whole.select("conv_id", F.lit(0).cast("long").alias("no"), *_STATS, "audit", "n_kept", "repaired")
    return Repaired(short.unionByName(mended(plan.where("n_pieces = 1"))), mended(plan.where("n_pieces > 1")))


# --- the query ------------------------------------------------------------

def _digests(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (conv_id, no, counts, audit, n_kept, repaired), sorted ->
    conv_id, counts, audit, repaired_sha256: the text is hashed piece by
    piece and never held whole."""
    names = ["conv_id", *_STATS, "audit", "repaired_sha256"]
    conv, held, audit, sha, some = object(), None, [], None, False

    def done():
        return pa.RecordBatch.from_arrays(
            [*held, pa.array(["".join(audit)]), pa.array([sha.hexdigest()])], names)

    for b in it:
        for i, (c, a, n, text) in enumerate(zip(*(b.column(k).to_pylist() for k in (0, 8, 9, 10)))):
            if c != conv:
                if held is not None:
                    yield done()
                conv, held = c, [b.column(k).slice(i, 1) for k in (0, *range(2, 8))]
                audit, sha, some = [], hashlib.sha256(), False
            audit.append(a)
            if n:
                sha.update(("\n" if some else "").encode() + text.encode())
                some = True
    if held is not None:
        yield done()


def damage(rows: DataFrame) -> DataFrame:
    """Turns damaged by the CRC-32 of `conv_id:turn` modulo 20: 0 dropped, 1
    emptied, 2 without `.!?`, 3 twice, 4 from the user; nulls are spaces."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    out = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(said("role")).alias("role"), text.alias("text"), copies.alias("copies"))
    return out.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies", "copy")


def op12_conversation_repair(spark, sf_dir) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = repair_conversations(damage(rows))
    short = found.short.select("conv_id", *_STATS, "audit", F.sha2(F.col("repaired").cast("binary"), 256).alias("repaired_sha256"))
    schema = short.schema
    long = found.long.repartition(n_partitions(spark), "conv_id").sortWithinPartitions("conv_id", "no").mapInArrow(_digests, schema)
    every = rows.select(F.col("conv_id").alias("_conv")).distinct()
    out = every.join(short.unionByName(long), F.col("_conv").eqNullSafe(F.col("conv_id")), "left")
    none = hashlib.sha256().hexdigest()
    return out.select(
        F.col("_conv").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _STATS],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"))


#: CRC-32 byte by byte and bit by bit; then the search as a recursion over a
#: conversation's turns, with the cheapest, ASCII-least edits to each state.
OP12_SQL = """
WITH RECURSIVE base AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations
), kinds AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT)),
    lambda x, y: list_reduce(list_prepend(xor(x, y), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda p, q: CASE WHEN p & 1 = 1 THEN xor(p >> 1, 3988292384) ELSE p >> 1 END)), 4294967295::BIGINT) % 20 AS kind
  FROM base
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds
), keyed AS (
  SELECT *, rtrim(text, E' \t\n\x0b\f\r') AS bare, md5(length(role)::VARCHAR || ':' || role || text) AS tie FROM damaged
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tie) AS n
  FROM keyed
), seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) AS nth FROM numbered
), faulted AS (
  SELECT *, left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS i0,
         CASE WHEN bare = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault
  FROM seen
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
         count(*) FILTER (WHERE fault = 't') AS truncated,
         count(*) FILTER (WHERE n > 1 AND i0 || i NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulted GROUP BY conv_id
), steps AS (
  SELECT conv_id, 0::BIGINT AS n, {'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]} AS e,
         {'c': 1000000000::BIGINT, 'a': '', 'r': []::VARCHAR[]} AS s, {'c': 1000000000::BIGINT, 'a': '', 'r': []::VARCHAR[]} AS u,
         {'c': 1000000000::BIGINT, 'a': '', 'r': []::VARCHAR[]} AS o
  FROM (SELECT DISTINCT conv_id FROM faulted)
  UNION ALL
  SELECT conv_id, n,
    {'c': e.c + 4, 'a': e.a || 'D', 'r': e.r},
    list_sort([{'c': s.c + 4, 'a': s.a || 'D', 'r': s.r},
      {'c': CASE WHEN stays AND i = 's' THEN e.c + cut ELSE 1000000000 END, 'a': e.a || 'K', 'r': list_append(e.r, line)}])[1],
    list_sort([{'c': u2.c + 4, 'a': u2.a || 'D', 'r': u2.r},
      {'c': CASE WHEN stays THEN x.c + cut + CASE WHEN i = 'u' THEN 0 ELSE 3 END ELSE 1000000000 END,
       'a': x.a || CASE WHEN i = 'u' THEN 'K' ELSE 'R' END,
       'r': list_append(x.r, CASE WHEN i = 'u' THEN line ELSE 'user:' || text END)}])[1],
    list_sort([{'c': o2.c + 4, 'a': o2.a || 'D', 'r': o2.r},
      {'c': CASE WHEN stays THEN u2.c + cut + CASE WHEN i = 'a' THEN 0 ELSE 3 END ELSE 1000000000 END,
       'a': u2.a || CASE WHEN i = 'a' THEN 'K' ELSE 'R' END,
       'r': list_append(u2.r, CASE WHEN i = 'a' THEN line ELSE 'assistant:' || text END)}])[1]
  FROM (
    SELECT *, list_sort([e, s, o2])[1] AS x FROM (
      SELECT *, list_sort([o, {'c': u2.c + 3, 'a': u2.a || 'I', 'r': list_append(u2.r, 'assistant:')}])[1] AS o2 FROM (
        SELECT *, list_sort([u, {'c': y.c + 3, 'a': y.a || 'I', 'r': list_append(y.r, 'user:')}])[1] AS u2 FROM (
          SELECT t.conv_id, f.n, t.e, t.s, t.u, t.o, list_sort([t.e, t.s, t.o])[1] AS y, f.i, f.text, f.role || ':' || f.text AS line,
                 f.fault NOT IN ('b', 'd') AS stays, CASE WHEN f.fault = 't' THEN 3 ELSE 0 END AS cut
          FROM steps t JOIN faulted f ON f.conv_id IS NOT DISTINCT FROM t.conv_id AND f.n = t.n + 1))))
), ended AS (
  SELECT t.conv_id, list_sort([t.e, t.o, {'c': t.u.c + 3, 'a': t.u.a || 'I', 'r': list_append(t.u.r, 'assistant:')},
    {'c': t.s.c + 6, 'a': t.s.a || 'II', 'r': list_append(list_append(t.s.r, 'user:'), 'assistant:')}])[1] AS z
  FROM steps t JOIN (SELECT conv_id, max(n) AS total FROM faulted GROUP BY conv_id) f
    ON f.conv_id IS NOT DISTINCT FROM t.conv_id AND f.total = t.n
)
SELECT d.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(ended.z.c, 0) AS cost,
       coalesce(ended.z.a, '') AS audit, sha256(coalesce(array_to_string(ended.z.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM d.conv_id
"""
