"""Best-fit packing of token sequences by a configuration linear program.

1. Texts become token ids in the tasks, each document once; documents longer
   than a sequence are cut.
2. The histogram of piece lengths (at most `size` numbers, whatever the
   corpus) goes to the driver. There the configuration LP - one variable per
   multiset of lengths that fits into a sequence, one covering constraint per
   length - is solved by multiplicative weights: lengths that lag behind in
   coverage gain weight, a knapsack dynamic program prices the best
   configurations, and every configuration near the best is used for part of
   what is left.
3. `SHARE` of the solution, rounded down, is placed; the other pieces, a
   mix like the corpus's, by best-fit decreasing over the histogram.
4. The plan says, for each length, which rank goes to which sequence and
   offset. Pieces are ranked per length by task-local ranks plus running
   sums over the tasks' counts, so no length, however common, is ranked by
   one task.

Defined cases: a null or empty text gives the end id alone; repeated rows
are packed separately, and null ids too; an empty table packs to nothing;
text that spells a special token of the vocabulary is encoded as the
tokenizer does by default."""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import save_table, small_batches

LONG_RUN = 2_000      # characters without a break
GROUP_CHARS = 1_000_000  # text encoded before its pieces leave a task
SHARE = 0.6           # of the fractional solution that is placed
CHECKED = 512         # one text of so many, by its CRC-32, is encoded both ways


# --- token ids ------------------------------------------------------------

# Fixed value: how byte-level vocabularies of this kind split text first.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """How a byte-level vocabulary spells bytes: visible Latin-1 characters
    as themselves, the others as the letters from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts by the tokenizer in a file, as little-endian uint32
    bytes.

    A byte-level BPE vocabulary whose merges are in the order of their ids
    gives the same ids as its ranks do in `tiktoken`, at a third of the time
    and without a cache of words; one text of `CHECKED` is
    encoded both ways and must agree. The tokenizer itself encodes everything else:
    texts that spell a special token, texts with an extremely long run, and
    all texts of other vocabularies."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special)) if special else None
        self.ranks = self._ranked(path)

    def _ranked(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        letters, vocab = byte_letters(), model.get("vocab")
        merges = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges") or []]
        if (
            spec.get("normalizer") is not None or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True)
            or pre.get("add_prefix_space") or model.get("type", "BPE") != "BPE" or model.get("ignore_merges")
        ):
            return None
        order = [vocab[m.replace(" ", "")] for m in merges]
        words = {t: i for t, i in vocab.items() if all(c in letters for c in t)}
        if order != sorted(order) or len(words) != len(order) + 256:
            return None
        ranks = {bytes(letters[c] for c in t): i for t, i in words.items()}
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def by_file(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if self.ranks is None or self.special and self.special.search(text):
            return self.by_file(text)
        words = text.split()
        if max(map(len, words), default=0) > LONG_RUN or len(text) - sum(map(len, words)) > LONG_RUN + len(words):
            return self.by_file(text)
        return self.ranks.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _pieces(path: str, size: int, end: int):
    tail = np.array([end], "<u4").tobytes()

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in it:
            texts = b.column(1)
            at = 0
            while at < len(texts):
                group, chars = [], 0
                while at + len(group) < len(texts) and (not group or chars < GROUP_CHARS):
                    group.append(texts[at + len(group)].as_py() or "")
                    chars += len(group[-1])
                rows, piece, start, length, ids = [], [], [], [], []
                for i, text in enumerate(group):
                    raw = enc.encode(text)
                    if zlib.crc32(text.encode()) % CHECKED == 0 and raw != enc.by_file(text):
                        raise ValueError("the ranks of the vocabulary don't give the tokenizer's ids")
                    raw += tail
                    n = len(raw) // 4
                    stop = n % size or size
                    begin, k = 0, 0
                    while begin < n:
                        rows.append(at + i)
                        piece.append(k)
                        start.append(begin)
                        length.append(stop - begin)
                        ids.append(raw[4 * begin: 4 * stop])
                        begin, stop, k = stop, stop + size, k + 1
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()),
                ], ["doc_id", "piece", "start", "length", "ids"])
                at += len(group)

    return cut


def token_pieces(
    docs: DataFrame, path: str, size: int = 2048, end: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, piece, start, length, ids (binary, little-endian uint32):
    each document's ids and the end id, in pieces of at most `size`."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _pieces(path, size, end), f"doc_id {kind}, piece int, start long, length long, ids binary")


# --- the configuration program --------------------------------------------

def price(lengths: np.ndarray, weight: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unbounded knapsack: the best weight for every capacity up to `size`,
    the length placed last, and the highest capacity not above at which one
    is placed (0: none)."""
    best, last = np.zeros(size + 1), np.zeros(size + 1, np.int64)
    fits = np.searchsorted(lengths, np.arange(size + 1), side="right")
    for c in range(1, size + 1):
        best[c] = best[c - 1]
        if n := fits[c]:
            v = best[c - lengths[:n]] + weight[:n]
            i = int(v.argmax())
            if v[i] > best[c] + 1e-12:
                best[c], last[c] = v[i], lengths[i]
    return best, last, np.maximum.accumulate(np.where(last > 0, np.arange(size + 1), 0))


def _fill(last: list[int], down: list[int], c: int) -> list[int]:
    out = []
    while c := down[c]:
        out.append(last[c])
        c -= last[c]
    return out


class Solution(NamedTuple):
    """A fractional solution of the configuration program: how often each
    configuration is used, and a number of sequences that no packing, not
    even a fractional one, can go below (its dual bound)."""

    amounts: dict[tuple, float]
    bound: float


def solve(counts: dict[int, int], size: int, rate: float = 0.02, near: float = 0.004, rounds: int = 40) -> Solution:
    """The configuration LP for the histogram `counts` by multiplicative
    weights. A round prices configurations by the weights of their lengths,
    uses all near the best for part of what is left, and multiplies the
    weight of every length by how far it lags behind. Any weights give a dual
    bound: their sum over the pieces by that of the best configuration."""
    lengths = np.array(sorted(counts), np.int64)
    total = np.array([counts[int(x)] for x in lengths], float)
    at = {int(x): i for i, x in enumerate(lengths)}
    left, found, weight, bound = total.copy(), Counter(), lengths.astype(float), 0.0
    for _ in range(rounds):
        best, last, down = price(lengths, weight, size)
        bound = max(bound, float(total @ weight) / best[size])
        live = left > 1e-6 * total
        if not live.any():
            break
        # the best fillings with lengths that are left
        best, last, down = price(lengths[live], weight[live], size)
        last, down = last.tolist(), down.tolist()
        used = 0
        for lead in lengths[live][::-1]:
            i = at[int(lead)]
            if weight[i] + best[size - lead] < best[size] * (1 - near):
                continue
            conf = Counter([int(lead), *_fill(last, down, size - int(lead))])
            amount = 0.5 * min(left[at[x]] / n for x, n in conf.items())
            if amount > 0:
                used += 1
                found[tuple(sorted(conf.items()))] += amount
                for x, n in conf.items():
                    left[at[x]] -= n * amount
        lag = left / total
        weight *= np.exp(rate * (lag - lag.mean()))
        # the best is full: a length that never gets near it needs a wider view
        near = near if used else 2 * near
    return Solution(dict(found), bound)


def configurations(counts: dict[int, int], size: int) -> list[tuple[tuple, int]]:
    """An integral plan [(configuration as ((length, number), ...), how many
    sequences)] that holds exactly `counts`: `SHARE` of the solution, rounded
    down, and best-fit decreasing for the other pieces. Placing all of it
    would leave what fits nothing: the last sequences need a mix like the
    corpus's. Both work on numbers of equal pieces and equal sequences."""
    left, plan = Counter({k: v for k, v in counts.items() if v}), Counter()
    if left[size]:  # a full piece is a sequence
        plan[((size, 1),)] = left.pop(size)
    left = +left
    if left:
        for conf, amount in solve(left, size).amounts.items():
            n = int(SHARE * amount)
            if n and sum(x * k for x, k in conf) == size:  # what is not full is packed anew
                plan[conf] += n
                for x, k in conf:
                    left[x] -= n * k
    for conf, n in _best_fit(+left, size).items():
        plan[conf] += n
    return list(plan.items())


def _best_fit(left: Counter, size: int) -> Counter:
    """Best-fit decreasing: every piece, the longest first, goes where it
    leaves least room. Sequences of equal room and content go together."""
    rooms: list[int] = []                # the rooms there are, sorted
    open_: dict[int, Counter] = {}       # room -> contents -> how many
    for x in sorted(left, reverse=True):
        n = left[x]
        while n:
            i = bisect_left(rooms, x)
            if i == len(rooms):  # new sequences, as full as they get
                k = size // x
                whole, rest = divmod(n, k)
                _put(rooms, open_, size - k * x, ((x, k),), whole)
                _put(rooms, open_, size - rest * x, ((x, rest),), 1 if rest else 0)
                n = 0
                continue
            room = rooms[i]
            conf, m = next(iter(open_[room].items()))
            k = min(room // x, n)
            take = min(m, n // k)
            _take(rooms, open_, room, conf, take)
            _put(rooms, open_, room - k * x, (*conf, (x, k)), take)
            n -= take * k
    plan = Counter()
    for contents in open_.values():
        for conf, m in contents.items():
            plan[tuple(sorted(conf))] += m
    return plan


def _put(rooms: list[int], open_: dict, room: int, conf: tuple, n: int) -> None:
    if n:
        if room not in open_:
            insort(rooms, room)
            open_[room] = Counter()
        open_[room][conf] += n


def _take(rooms: list[int], open_: dict, room: int, conf: tuple, n: int) -> None:
    open_[room][conf] -= n
    if not open_[room][conf]:
        del open_[room][conf]
        if not open_[room]:
            del open_[room]
            rooms.remove(room)


def slots(plan: list[tuple[tuple, int]]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence, pieces a sequence,
    first offset) in the order of ranks."""
    out: dict[int, list] = {}
    rank, seq = Counter(), 0
    for conf, n in plan:
        offset = 0
        for x, k in conf:
            out.setdefault(x, []).append((rank[x], seq, k, offset))
            rank[x] += n * k
            offset += x * k
        seq += n
    return {x: np.array(v, np.int64) for x, v in out.items()}


def _ranked(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunk, seen = TaskContext.get().partitionId(), Counter()
    for b in it:
        ranks = []
        for x in b.column("length").to_pylist():
            ranks.append(seen[x])
            seen[x] += 1
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array([chunk] * len(ranks), pa.int32()), pa.array(ranks, pa.int64())],
            [*b.schema.names, "_chunk", "_rank"])


def _placed(table: dict[int, np.ndarray]):
    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            length = b.column("length").to_numpy()
            rank = b.column("_rank").to_numpy() + b.column("_from").to_numpy()
            seq, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                rows, t = np.flatnonzero(length == x), table[int(x)]
                row = t[np.searchsorted(t[:, 0], rank[rows], side="right") - 1]
                j = rank[rows] - row[:, 0]
                seq[rows] = row[:, 1] + j // row[:, 2]
                offset[rows] = row[:, 3] + j % row[:, 2] * x
            keep = [i for i, c in enumerate(b.schema.names) if c not in ("_chunk", "_rank", "_from")]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in keep), pa.array(seq), pa.array(offset)],
                [*(b.schema.names[i] for i in keep), "sequence_id", "offset"])

    return place


def pack_pieces(pieces: DataFrame, size: int = 2048) -> DataFrame:
    """`pieces` (any columns with `length` from 1 to `size`) with
    `sequence_id` and `offset`: every sequence holds at most `size`,
    gapless."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    ranked = save_table(pieces.mapInArrow(_ranked, f"{cols}, _chunk int, _rank long"), "pieces")
    counts = ranked.groupBy("_chunk", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(configurations(histogram, size))
    before = Window.partitionBy("length").orderBy("_chunk")
    starts = counts.select("_chunk", "length", (F.sum("n").over(before) - F.col("n")).alias("_from"))
    full = ranked.join(starts, ["_chunk", "length"]).select(*ranked.columns, "_from")
    return full.mapInArrow(_placed(table), f"{cols}, sequence_id long, offset long")


def op4_packing(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    pieces = token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), size=2048, end=0)
    # the digest is taken before packing, so ids never pass a shuffle
    pieces = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack_pieces(pieces, size=2048)
