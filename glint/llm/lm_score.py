"""Language-model scoring by a hierarchical Pitman-Yor process.

Model. Every word, and the start of a text, is a context with a restaurant of
its own; all context restaurants share one parent restaurant over single
words, whose base is uniform over the vocabulary and one unknown word. A
context without training tokens is an empty restaurant: its tokens are scored
by the parent. Words, contexts and (context, word) pairs are all kept and grow
with the corpus; nothing is chosen by a count.

Sampling. The seating is sampled by Gibbs sweeps: all customers of a dish in
a restaurant leave and are seated again one after the other, given the rest
of the restaurant. How many in a row join old tables before one opens a new
one is drawn at once (the Beta-geometric law of that urn), so a dish costs as
many steps as it has tables, not customers. As sequential seating is not
quite the conditional, two seatings are drawn and one is chosen by its
importance weight. Predictive probabilities are averaged over the sweeps
after the burn-in. A pair that was seen once has one table in every seating,
so only pairs seen more often are state of the sweeps.

Distribution. Hashes are dealt to parts; a part holds its words with all their
pairs, and the totals of the contexts with these hashes. A task turns a chunk
of texts into a list of words and a stream of word numbers, which alone are
kept. From these the chunk's distinct (word, context) pairs are made anew
whenever they are needed, and sent to the parts as arrays, one row per (chunk,
part), so even the most common word is one small entry per chunk: first those
to learn from, with counts, later all, as questions. The parent needs no
shuffle. Before each sweep the parts send the tables of their contexts, as
arrays, to the parts that hold the contexts' totals, and get the totals back;
the driver sees eight sums. At the end each part answers every chunk with its
words' and contexts' factors and its pairs' own shares, and the chunk puts
them together over its stream.

Disk. What grows with the tokens goes through a shuffle in a few turns, by
part or by chunk, and a turn's shuffle files are deleted before the next
turn's are written; a table is deleted when a later one has replaced it.

Defined cases: null and empty texts are the end token alone; repeated rows
are scored, and learned from, separately; a null id is never held out; with
no training text every token is unknown; an empty table gives no row."""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_saved, n_partitions, saved, small_batches

CHUNK_TOKENS = 1_500_000
PART_TOKENS = 2_000_000
CACHED_WORDS = 400_000
TURNS, PAIR_TURNS = 4, 2  # questions and answers, and before them pairs, are shuffled in so many turns
FEW = 24  # so many dishes are seated faster one by one than as arrays
END = 0  # the end token's word hash; as a context, the start of a text

class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh64_intdigest(word) or 1
        return found


_known = _Hashes()


def hashes(words: list[bytes]) -> np.ndarray:
    """64-bit word hashes, never END."""
    global _known
    if len(_known) > CACHED_WORDS:
        _known = _Hashes()
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


# --- chunks ---------------------------------------------------------------

def _tokens(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of tokens of this partition."""
    n = sum(len((t or b"").split()) + 1 for b in it for t in b.column(0).to_pylist())
    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])


def _planes(x: np.ndarray) -> bytes:
    """Counts and places by byte planes, which compress well."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 4).T.tobytes()


def _packed(arrays: dict) -> bytes:
    raw = pickle.dumps({
        k: (x.shape, _planes(x)) if isinstance(x, np.ndarray) and x.dtype == np.uint32 else x
        for k, x in arrays.items()}, 5)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(data: bytes) -> dict:
    arrays = pickle.loads(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True))
    return {
        k: np.ascontiguousarray(np.frombuffer(x[1], np.uint8).reshape(4, -1).T).view(np.uint32).reshape(x[0]) if isinstance(x, tuple) else x
        for k, x in arrays.items()}


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, sorted, and each value's place among them. They
    are found by hashing, so that only distinct values are sorted."""
    coded = pa.array(x).dictionary_encode()
    values = coded.dictionary.to_numpy()
    by = np.argsort(values)
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    return values[by], place[coded.indices.to_numpy()]


def _keys(r: np.ndarray, ns: np.ndarray, of=slice(None)) -> np.ndarray:
    """Word numbers of texts -> each token's word << 32 | context."""
    c = np.empty_like(r)
    c[1:] = r[:-1]
    c[np.concatenate(([0], np.cumsum(ns, dtype=np.int64)[:-1]))] = r[-1]  # END
    keys = r[of].astype(np.int64)
    keys <<= 32
    keys |= c[of]
    return keys


def _chunks(parts: int, kind: pa.DataType):
    """(id, text, train) -> one row per chunk: its ids, texts' lengths and
    training flags, words sorted by part and hash, and stream."""
    names = ["chunk", "ids", "ns", "learn", "words", "stream"]
    types = [pa.int64(), pa.list_(kind), *[pa.binary()] * 4]

    def split(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, ids, toks, train = 0, [], [], []

        def flush():
            nonlocal made, ids, toks, train
            chunk = TaskContext.get().partitionId() << 32 | made
            made += 1
            ns = np.array([len(t) for t in toks], np.uint32)
            words, at = _distinct(np.concatenate(toks))
            by = np.lexsort((words, words % np.uint64(parts)))
            rank = np.empty(len(words), np.int64)
            rank[by] = np.arange(len(words))
            row = (chunk, ids, ns.tobytes(), np.array(train, bool).tobytes(), words[by].tobytes(), _packed({"r": rank[at].astype(np.uint32)}))
            ids, toks, train = [], [], []
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

        held = 0
        for b in it:
            for i, t, learn in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                h = np.append(hashes((t or b"").lower().split()), np.uint64(END))
                ids.append(i)
                toks.append(h)
                train.append(learn)
                held += len(h)
                if held >= CHUNK_TOKENS:
                    yield flush()
                    held = 0
        if held:
            yield flush()

    return split


_CHUNK = "chunk long, ids array<{}>, ns binary, learn binary, words binary, stream binary"


def _asked(parts: int, turn: int, turns: int, train: bool):
    """Chunks -> their distinct pairs for the parts of this turn, by word and
    context: those to learn from, with counts, or all."""

    def ask(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for chunk, ns, learn, words, stream in zip(*(b.column(i).to_pylist() for i in range(5))):
                ns, learn, words = (np.frombuffer(x, t) for x, t in zip((ns, learn, words), (np.uint32, bool, np.uint64)))
                part, r = (words % np.uint64(parts)).astype(np.int64), _unpacked(stream)["r"]
                mine = (part % turns == turn)[r]
                if train:
                    mine &= np.repeat(learn, ns)
                pairs, cnt = np.unique(_keys(r, ns, mine), return_counts=True)
                word, lens = np.unique(pairs >> 32, return_counts=True)
                ctx, upto = words[pairs & 0xFFFFFFFF], np.concatenate(([0], np.cumsum(lens)))
                cut = np.searchsorted(part[word], np.arange(parts + 1))
                rows = []
                for p in range(turn, parts, turns):
                    a, z = cut[p], cut[p + 1]
                    if a < z:
                        x, y = upto[a], upto[z]
                        d = {"words": words[word[a:z]], "lens": lens[a:z].astype(np.uint32), "ctx": ctx[x:y]}
                        rows.append((p, ASKED, chunk, d | {"cnt": cnt[x:y].astype(np.uint32)} if train else d, None))
                if rows:
                    yield _rows(rows)

    return ask


# --- seating --------------------------------------------------------------

def _gammaln(x: np.ndarray) -> np.ndarray:
    shift = np.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5))
    y = x + 6
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) - shift


def seat(rng, c, others, theta, d, base):
    """Seat `c` customers of a dish in a restaurant with `others` tables of
    other dishes; `base`: the parent's probability of the dish. Returns the
    tables and the log importance weight."""
    tables, weight = np.ones(len(c), np.int64), np.zeros(len(c))
    live, pos = np.flatnonzero(c > 1), np.ones(len(c), np.int64)
    while len(live) > FEW:
        n, t = pos[live], tables[live]
        new = np.maximum((theta + d * (others[live] + t)) * base[live], 1e-300)
        old = n - d * t
        p = np.clip(rng.beta(new, old), 1e-15, 1 - 1e-15)  # that the next opens a table
        wait = np.floor(np.log(rng.random(len(live))) / np.log1p(-p))
        stop = np.minimum(n + wait + 1, c[live]).astype(np.int64)
        weight[live] += _gammaln(new + old + (stop - n)) - _gammaln(new + old)
        opened = n + wait + 1 <= c[live]
        tables[live] += opened
        pos[live] = stop
        live = live[stop < c[live]]
    # the few dishes with most tables, one number after the other
    left = [(i, int(pos[i]), int(tables[i]), 0.0, int(c[i]), float(others[i]), float(base[i])) for i in live]
    while left:
        odds = [(max((theta + d * (o + t)) * b, 1e-300), n - d * t) for _, n, t, _, _, o, b in left]
        ps = [min(max(rng.beta(new, old), 1e-15), 1 - 1e-15) for new, old in odds]
        still = []
        for (i, n, t, w, k, o, b), (new, old), p in zip(left, odds, ps):
            wait = int(math.log(rng.random() or 1e-300) / math.log1p(-p))
            stop = min(n + wait + 1, k)
            w += math.lgamma(new + old + (stop - n)) - math.lgamma(new + old)
            t += n + wait + 1 <= k
            if stop < k:
                still.append((i, stop, t, w, k, o, b))
            else:
                tables[i], weight[i] = t, weight[i] + w
        left = still
    return tables, weight


def reseat(rng, c, others, theta, d, base):
    """Two seatings, one chosen by importance."""
    (t1, w1), (t2, w2) = seat(rng, c, others, theta, d, base), seat(rng, c, others, theta, d, base)
    return np.where(rng.random(len(c)) < 1 / (1 + np.exp(np.clip(w2 - w1, -700, 700))), t1, t2)


# --- parts ----------------------------------------------------------------

# Rows between parts: the part that reads it, what it is, where it comes from,
# arrays by name and (STATE) eight numbers for the driver's sums. In this
# order a part reads them.
_ROW = "part int, kind int, src long, data binary, v array<long>"
PAIRS, STATE, TOTALS, TABLES, REPLY, FACTOR, ASKED = range(7)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    """(part, kind, src, arrays, numbers or None)"""
    part, kind, src, data, v = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(src, pa.int64()),
         pa.array([_packed(d) for d in data], pa.binary()), pa.array(v, pa.list_(pa.int64()))],
        [f.split()[0] for f in _ROW.split(", ")])


def _by_part(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list]]]:
    """Rows sorted by part, kind, src -> each part's (src, arrays) by kind."""
    part, held = None, {}
    for b in it:
        for p, kind, src, data in zip(*(b.column(i).to_pylist() for i in range(4))):
            if p != part:
                if held:
                    yield part, held
                part, held = p, {}
            held.setdefault(kind, []).append((src, _unpacked(data)))
    if held:
        yield part, held


def _dealt(rows: DataFrame, parts: int, turns: int = 1) -> DataFrame:
    """`turns`: the rows' parts are equal modulo it."""
    place = (F.col("part") / turns).cast("int")
    return rows.repartitionById(-(-parts // turns), place).sortWithinPartitions("part", "kind", "src")


def _to_parts(kind: int, part: int, parts: int, u: np.ndarray, **arrays) -> list[tuple]:
    """Arrays over contexts sorted by part, hash -> one row per part."""
    cut = np.searchsorted((u % np.uint64(parts)).astype(np.int64), np.arange(parts + 1))
    return [(c, kind, part, {"u": u[a:b]} | {k: v[a:b] for k, v in arrays.items()}, None)
            for c, (a, b) in enumerate(zip(cut, cut[1:])) if a < b]


def _contexts(known: np.ndarray, c: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct contexts `known[c]` sorted by part, hash, and each one's place."""
    used = np.flatnonzero(np.bincount(c, minlength=len(known)))
    by = used[np.lexsort((known[used], known[used] % np.uint64(parts)))]
    place = np.zeros(len(known), np.int64)
    place[by] = np.arange(len(by))
    return known[by], place[c].astype(np.uint32)


def _summed(at: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(at, weights=v, minlength=n).astype(np.int64)


def _customers(s: dict) -> tuple[np.ndarray, np.ndarray]:
    """The word of each pair of the state, and the parent's customers per
    word: the tables of all contexts."""
    word = np.repeat(np.arange(len(s["one"])), s["lens"])
    return word, s["one"] + _summed(word, s["tab"], len(s["one"]))


def _merged(parts: int):
    def merge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks' pairs sorted by part -> the part's training pairs, its
        state with one table per dish, and its contexts' totals and tables."""
        for part, held in _by_part(it):
            words, lens, ctx, cnt = (np.concatenate([d[k] for _, d in held[ASKED]]) for k in ("words", "lens", "ctx", "cnt"))
            words, at = _distinct(words)
            known, c = _distinct(ctx)
            pairs = np.repeat(at, lens) << 32 | c
            by = np.argsort(pairs)
            pairs = pairs[by]
            first = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1])))
            n = np.add.reduceat(cnt[by], first, dtype=np.int64).astype(np.uint32)
            pairs = pairs[first]
            c, word = pairs & 0xFFFFFFFF, pairs >> 32
            rows = [(part, PAIRS, part, {
                "words": words, "lens": np.bincount(word, minlength=len(words)).astype(np.uint32),
                "known": known, "c": c.astype(np.uint32), "cnt": n}, None)]
            u, to = _contexts(known, c, parts)
            rows += _to_parts(TOTALS, part, parts, u, one=_summed(to, n == 1, len(u)).astype(np.uint32), all=_summed(to, n, len(u)))
            more = n > 1
            u, to = _contexts(known, c[more], parts)
            s = {"one": _summed(word, n == 1, len(words)), "lens": np.bincount(word[more], minlength=len(words)).astype(np.uint32),
                 "u": u, "c": to, "cnt": n[more], "tab": np.ones(more.sum(), np.uint32), "top": np.ones(len(words), np.uint32),
                 "own": np.zeros(more.sum(), np.float32), "p0": []}
            c0 = _customers(s)[1]
            v = [c0.sum(), len(words), n.sum(dtype=np.int64), len(words), *((n == k).sum() for k in (1, 2)), *((c0 == k).sum() for k in (1, 2))]
            yield _rows([*rows, (part, STATE, part, s, list(map(int, v))), *_tables(part, parts, s)])

    return merge


def _tables(part: int, parts: int, s: dict) -> list[tuple]:
    return _to_parts(TABLES, part, parts, s["u"], t=_summed(s["c"], s["tab"], len(s["u"])).astype(np.uint32))


def _context_totals(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals rows of all parts -> one a part: customers, and tables of pairs
    seen once."""
    for part, held in _by_part(it):
        rows = [d for _, d in held[TOTALS]]
        u, at = np.unique(np.concatenate([d["u"] for d in rows]), return_inverse=True)
        one, every = (_summed(at, np.concatenate([d[k] for d in rows]), len(u)) for k in ("one", "all"))
        yield _rows([(part, TOTALS, part, {"u": u, "one": one, "all": every}, None)])


def _exchange(g: dict, step: int, sample: bool):
    def exchange(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every part's tables added up by context, and sent back."""
        for part, held in _by_part(it):
            k = held[TOTALS][0][1]
            tables = k["one"].copy()
            asked = [(src, np.searchsorted(k["u"], d["u"]), d["t"]) for src, d in held.get(TABLES, [])]
            for _, at, t in asked:
                tables[at] += t
            for src, at, _ in asked:
                yield _rows([(src, REPLY, part, {"T": tables[at]}, None)])
            if sample:
                a = (g["th1"] + g["d1"] * tables) / (g["th1"] + k["all"])
                yield _rows([(part, FACTOR, step, {"a": a.astype(np.float32)}, None)])

    return exchange


def _unseen(g: dict) -> float:
    """The parent's probability of a word without customers."""
    return (g["th0"] + g["d0"] * g["T0"]) * g["base"] / (g["th0"] + g["C0"])


def _recorded(s: dict, g: dict) -> dict:
    """The state with this seating's share of the averages: the parent's
    probability per word, and what each pair has in its own restaurant."""
    c0 = _customers(s)[1]
    p0 = np.maximum(c0 - g["d0"] * s["top"], 0) / (g["th0"] + g["C0"]) + _unseen(g)
    own = s["own"] + np.maximum(s["cnt"] - g["d1"] * s["tab"], 0).astype(np.float32)
    return s | {"p0": [*s["p0"], p0.astype(np.float32)], "own": own}


def _sweep(g: dict, parts: int, step: int, sample: bool):
    def sweep(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, held in _by_part(it):
            s = held[STATE][0][1]
            if sample:
                s = _recorded(s, g)
            rng = np.random.default_rng([step, part])
            word, c0 = _customers(s)
            tab, top = s["tab"].astype(np.int64), s["top"].astype(np.int64)
            if len(tab):
                total = np.concatenate([d["T"] for _, d in held[REPLY]])[s["c"]]
                # the parent without this dish's tables
                free = np.maximum(c0[word] - tab - g["d0"] * top[word], 0)
                base = (free + (g["th0"] + g["d0"] * g["T0"]) * g["base"]) / (g["th0"] + np.maximum(g["C0"] - tab, 0))
                tab = reseat(rng, s["cnt"].astype(np.int64), total - tab, g["th1"], g["d1"], base)
            s["tab"] = tab.astype(np.uint32)
            c0 = _customers(s)[1]
            pick = np.flatnonzero(c0 > 1)
            top[c0 == 1] = 1
            top[pick] = reseat(rng, c0[pick], g["T0"] - top[pick], g["th0"], g["d0"], np.full(len(pick), g["base"]))
            s["top"] = top.astype(np.uint32)
            yield _rows([(part, STATE, part, s, [int(c0.sum()), int(top.sum()), *[0] * 6]), *_tables(part, parts, s)])

    return sweep


def _numbers(state: DataFrame) -> list[int]:
    return [x or 0 for x in state.where(F.col("kind") == STATE).agg(*[F.sum(F.col("v")[i]) for i in range(8)]).first()]


# --- answers --------------------------------------------------------------

def _answers(gs: list[dict]):
    """`gs`: the sums of each sample, in order."""
    n = len(gs)
    unseen = np.array([[_unseen(g)] for g in gs], np.float32)
    d1, th1 = gs[0]["d1"], gs[0]["th1"]

    def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
        return at, table[at] == keys if len(table) else np.zeros(len(keys), bool)

    def answer(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by part, a part's own rows before what it is asked."""
        part = None
        for b in it:
            out = []
            for p, kind, src, data in zip(*(b.column(i).to_pylist() for i in range(4))):
                if p != part:
                    part, m, s, k, a = p, None, None, None, []
                d = _unpacked(data)
                if kind == PAIRS:
                    m = d
                    word = np.repeat(np.arange(len(m["words"])), m["lens"])
                    sums = _summed(word, m["cnt"], len(m["words"]))
                    keys, own = word << 32 | m["c"], np.full(len(word), 1 - d1, np.float32)
                elif kind == STATE:
                    s = _recorded(d, gs[-1])
                    own[m["cnt"] > 1] = s["own"] / n
                    p0 = np.stack(s["p0"])
                elif kind == TOTALS:
                    k = d
                elif kind == FACTOR:
                    a.append(d["a"])
                if kind != ASKED:
                    continue
                words, lens, ctx = d["words"], d["lens"], d["ctx"]
                reply = {"p0": np.repeat(unseen, len(words), 1), "known": np.zeros(len(words), np.int64),
                         "a": np.ones((n, len(words)), np.float32), "b": np.full(len(words), 1 / th1, np.float32), "own": np.zeros(len(ctx), np.float32)}
                if m:
                    at, hit = find(m["words"], words)
                    reply["p0"][:, hit], reply["known"][hit] = p0[:, at[hit]], sums[at[hit]]
                    c, met = find(m["known"], ctx)
                    to, same = find(keys, np.repeat(at, lens) << 32 | c)
                    same &= met & np.repeat(hit, lens)
                    reply["own"][same] = own[to[same]]
                if k:
                    at, hit = find(k["u"], words)
                    reply["a"][:, hit], reply["b"][hit] = np.stack(a)[:, at[hit]], 1 / (th1 + k["all"][at[hit]])
                out.append((src, p, _packed(reply)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary()))], ["chunk", "part", "data"])

    return answer


def _scored(tokens: float, vocabulary: float, kind: pa.DataType):
    """Rows sorted by chunk, its stream row (part -1) first -> documents."""
    names = ["id", "n_tokens", "n_known", "base_score", "score"]
    types = [kind, pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, replies = None, []

        def close():
            ids, ns, r = head
            ns, r = np.frombuffer(ns, np.uint32).astype(np.int64), _unpacked(r)["r"]
            p0, known, a, b, own = (np.concatenate([x[k] for x in replies], -1) for k in ("p0", "known", "a", "b", "own"))
            pairs, idx = np.unique(_keys(r, ns), return_inverse=True)  # mostly distinct: hashing takes more memory
            w, c = pairs >> 32, pairs & 0xFFFFFFFF
            p = b[c].astype(float) * own
            for x, y in zip(a, p0):
                p += x[c].astype(float) * y[w] / len(a)
            log = np.log10(np.maximum(p, 1e-300))
            base = np.log10((known + 0.5) / (tokens + 0.5 * (vocabulary + 1)))
            at = np.concatenate(([0], np.cumsum(ns)[:-1]))
            sums = [np.add.reduceat(v, at) for v in ((known > 0)[r].astype(np.int64), base[r], log[idx])]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip((ids, ns, *sums), types)], names)

        for batch in it:
            for chunk, part, ids, ns, r, data in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if part == -1:
                    if head:
                        yield close()
                    head, replies = (ids, ns, r), []
                else:
                    replies.append(_unpacked(data))
        if head:
            yield close()

    return score


def score_texts(
    docs: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", burn_in: int = 2, samples: int = 3,
) -> DataFrame:
    """One row per row of `docs`: id, n_tokens, n_known, train_tokens,
    base_score, score, perplexity. `train`: a boolean column, which rows to
    learn from."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    id_type = rows.schema["id"].dataType.simpleString()
    kind = rows.limit(0).toArrow().schema.field("id").type
    tokens = rows.where("train").select("text").mapInArrow(_tokens, "n long").agg(F.sum("n")).first()[0] or 0
    width = n_partitions(spark)
    parts = max(width, -(-tokens // PART_TOKENS))

    def kept(df: DataFrame, name: str, paths: list[str]) -> DataFrame:
        df, path = saved(df, name, tidy=True)
        paths.append(path)
        return df

    def in_turns(make, name: str, paths: list[str], turns: int = TURNS) -> DataFrame:
        tables = [kept(make(turn), name, paths) for turn in range(turns)]
        return reduce(DataFrame.unionByName, tables)

    texts, replaced = [], []  # paths of what the scores and the answers replace
    chunks = kept(rows.mapInArrow(_chunks(parts, kind), _CHUNK.format(id_type)), "chunks", texts)
    asked = lambda *turn: chunks.select(
        "chunk", "ns", "learn", "words", "stream").mapInArrow(_asked(parts, *turn), _ROW)
    paths = []  # of the state
    merged = in_turns(lambda turn: _dealt(asked(turn, PAIR_TURNS, True), parts, PAIR_TURNS).mapInArrow(
        _merged(parts), _ROW), "merged", paths, PAIR_TURNS)
    of = lambda t, *kinds: t.where(F.col("kind").isin(*kinds))
    totals = kept(_dealt(of(merged, TOTALS), parts).mapInArrow(_context_totals, _ROW), "totals", replaced)
    pairs = kept(of(merged, PAIRS), "pairs", replaced)
    state = merged
    first = _numbers(state)
    n, v = first[2:4]
    share = lambda a, b: float(np.clip(a / max(1.0, a + 2 * b), 0.05, 0.95))
    fixed = {"d1": share(*first[4:6]), "d0": share(*first[6:8]), "th1": 1.0, "th0": 1.0, "base": 1 / (v + 1)}
    gs, factors = [], []
    for step in range(burn_in + samples):
        c0, t0 = _numbers(state)[:2]
        g, sample = fixed | {"C0": c0, "T0": t0}, step >= burn_in
        back, back_path = saved(
            _dealt(totals.unionByName(of(state, TABLES)), parts).mapInArrow(_exchange(g, step, sample), _ROW), "tables", tidy=True)
        if sample:
            gs.append(g)
            factors.append(of(back, FACTOR))
            replaced.append(back_path)
        if step + 1 < burn_in + samples:
            state, path = saved(
                _dealt(of(state, STATE).unionByName(of(back, REPLY)), parts).mapInArrow(_sweep(g, parts, step, sample), _ROW), "state", tidy=True)
            for p in paths:
                drop_saved(spark, p)
            paths = [path]
        if not sample:
            drop_saved(spark, back_path)
    own = reduce(DataFrame.unionByName, factors, pairs.unionByName(of(state, STATE)).unionByName(totals))
    answers = in_turns(lambda turn: _dealt(own.where(F.col("part") % TURNS == turn).unionByName(asked(turn, TURNS, False)), parts, TURNS).select(
        "part", "kind", "src", "data").mapInArrow(_answers(gs), "chunk long, part int, data binary"), "answers", texts)
    for p in [*replaced, *paths]:
        drop_saved(spark, p)
    none = lambda name, t="binary": F.lit(None).cast(t).alias(name)
    both = chunks.select("chunk", F.lit(-1).alias("part"), "ids", "ns", "stream", none("data")).unionByName(
        answers.select("chunk", "part", none("ids", f"array<{id_type}>"), none("ns"), none("stream"), "data"))
    out = in_turns(lambda turn: both.where(F.pmod(F.xxhash64("chunk"), F.lit(TURNS)) == turn).repartition(
        width, "chunk").sortWithinPartitions("chunk", "part").mapInArrow(
        _scored(n, v, kind), f"id {id_type}, n_tokens long, n_known long, base_score double, score double"), "scores", [])
    for p in texts:
        drop_saved(spark, p)
    return out.withColumn("train_tokens", F.lit(int(n)).cast("long")).withColumn(
        "perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op8_lm_score(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))
    out = score_texts(docs, ~held)
    again = F.coalesce(F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))
    return out.select(
        F.col("id").alias("doc_id"), again.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
