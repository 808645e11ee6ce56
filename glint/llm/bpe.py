"""Byte-level BPE encoding and decoding by replaying the merges of a rank
file on many words at once.

A task gathers texts into blocks, splits them by the vocabulary's pattern and
numbers the distinct words; a word that an earlier block of the task has
encoded is not encoded again. Of the new words of a block the short ones are
rows of a matrix, and a round merges the leftmost pair of the lowest rank of
each. Words of more than `SHORT` bytes would take too many rounds: they lie
end to end in one
array of token ids with links to the neighbours, and an inverted index leads
from each mergeable pair to its positions in all words (pairs that spell the
same token share an entry). Merges are applied in the order of their ranks:
the lowest rank in the index is taken, its pairs are merged from left to
right wherever they still stand, and only the neighbours of a merged pair
change entries. A merge that makes a pair of a lower rank than its own - a
vocabulary may hold such - goes back to that rank first, so every word is
merged exactly as it would be alone. A word of n bytes costs n log n (a short
one at most `SHORT` n).

Each task works on its own blocks, nothing is shuffled, and what a worker
holds is bounded by the block, the longest text and `MAX_WORDS`.

Ids are those of `tiktoken` on ordinary text: a word that is itself a token
is that token, and nothing is special. Decoding puts the bytes of the ids
together.

Defined cases: a null or empty text has no ids; null ids decode to null;
bytes that are no character decode as they are; a text of any length is
encoded whole; repeated rows, null document ids and tables without rows pass
through, and so do further columns, except that columns named `n_tokens` or
`ids` (encoding) and the output column (decoding) are replaced; an id that
the vocabulary doesn't hold is an error."""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator
from functools import cache, cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches

BLOCK_CHARS = 4_000_000   # text whose words are encoded together
MAX_WORDS = 400_000       # words a worker remembers between blocks
MAX_KEPT_CHARS = 8_000_000  # ... and the characters in them
LONG_TEXT = 1_000_000     # texts from this size on are split piece by piece
SHORT = 64                # bytes of the longest words that are merged as rows of a matrix
NONE = np.int32(2**31 - 1)  # the rank of a pair that doesn't merge
GROUP_TOKENS = 2_000_000  # ids in one batch of results, unless a text has more

# Characters that Unicode made letters or numbers after version
# 16.0, the one of the tiktoken library's tables. It takes them for signs.
LATER_LETTERS = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1),
    (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686),
    (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E),
    (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
_LATER = regex.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in LATER_LETTERS) + "]")
_SIGN = "\ue000"  # a character of neither class


def split_words(text: str, pattern: regex.Pattern) -> Iterator[list[str]]:
    """The matches of `pattern` in `text`, in lists of bounded length."""
    if not text.isascii() and max(text) >= chr(LATER_LETTERS[0][0]) and _LATER.search(text):
        matches = pattern.finditer(_LATER.sub(_SIGN, text))
        words = (text[m.start(): m.end()] for m in matches)
    elif len(text) < LONG_TEXT:
        yield pattern.findall(text)
        return
    else:
        words = (m.group() for m in pattern.finditer(text))
    while part := list(islice(words, 100_000)):
        yield part


class Runs:
    """Arrays of different lengths, end to end."""

    def __init__(self, values: np.ndarray, sizes: np.ndarray):
        self.values, self.sizes = values, sizes
        self.starts = np.concatenate([[0], np.cumsum(sizes[:-1], dtype=np.int64)]) if len(sizes) else np.zeros(0, np.int64)

    def take(self, which: np.ndarray) -> np.ndarray:
        """The runs `which`, end to end."""
        n = self.sizes[which]
        ends = np.cumsum(n)
        if not len(ends):
            return self.values[:0]
        return self.values[np.repeat(self.starts[which] - ends + n, n) + np.arange(ends[-1])]

    def join(self, other: Runs) -> Runs:
        return Runs(np.concatenate([self.values, other.values]), np.concatenate([self.sizes, other.sizes]))


class Vocabulary:
    """Tokens and ranks of a rank file: base64 of a token's bytes and its
    rank, which is its id, on each line."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.span = max(ranks.values(), default=0) + 1
        self.of_byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.of_byte < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        spelled: list[bytes] = [b""] * self.span
        for token, r in ranks.items():
            spelled[r] = token
        self.tokens = pa.array(spelled, pa.binary())
        self.spelling = Runs(np.frombuffer(b"".join(spelled), np.uint8), np.array([len(s) for s in spelled], np.int64))

    # what follows is for encoding only: workers that decode don't hold it

    @cached_property
    def merge(self) -> dict[int, int]:
        """A pair of ids is one number; its merge is the id of what it
        spells."""
        out, ranks = {}, self.ranks
        for token, r in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    out[a * self.span + b] = r
        return out

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The pairs in order, with their merges. The last is never a pair:
        searches end before it."""
        pairs = np.array([*sorted(self.merge), 2**62], np.int64)
        return pairs, np.array([*(self.merge[p] for p in pairs[:-1].tolist()), NONE], np.int32)

    @cached_property
    def byte_pairs(self) -> np.ndarray:
        return np.array([[self.ranks.get(bytes([x, y]), -1) for y in range(256)] for x in range(256)], np.int64)

    def encode(self, words: list[bytes]) -> Runs:
        """The ids of each word."""
        ids = [self.ranks.get(w) for w in words]
        merged = self.merged([w for w, i in zip(words, ids) if i is None])
        alone = np.array([i is not None for i in ids], bool)
        sizes = np.ones(len(words), np.int64)
        sizes[~alone] = merged.sizes
        values = np.zeros(int(sizes.sum()), np.int32)
        mine = np.repeat(alone, sizes)
        values[mine] = np.array([i for i in ids if i is not None], np.int32)
        values[~mine] = merged.values
        return Runs(values, sizes)

    def merged(self, words: list[bytes]) -> Runs:
        """The ids of words that are no token: short ones by `rounds`, long
        ones by `replay`."""
        n = np.array([len(w) for w in words], np.int64)
        if not (n > SHORT).any():
            return self.rounds(words, n)
        some, rest = np.flatnonzero(n <= SHORT), np.flatnonzero(n > SHORT)
        both = self.rounds([words[i] for i in some], n[some]).join(self.replay([words[i] for i in rest]))
        place = np.argsort(np.concatenate([some, rest]))
        return Runs(both.take(place), both.sizes[place])

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The merge of each pair, or NONE."""
        asked, (pairs, merges) = a.astype(np.int64) * self.span + b, self.pairs
        at = np.searchsorted(pairs, asked)
        return np.where(pairs[at] == asked, merges[at], NONE)

    def rounds(self, words: list[bytes], n: np.ndarray) -> Runs:
        """The leftmost pair of the lowest rank of every word at once, round
        by round. A round makes a word one token shorter, so the words that
        have as many tokens are the rows of one matrix, which takes up those
        that begin with so many."""
        raw = np.frombuffer(b"".join(words), np.uint8)
        starts, sizes = np.cumsum(n) - n, np.where(n < 2, n, 0)
        of_byte, byte_pairs = self.of_byte.astype(np.int32), np.where(self.byte_pairs < 0, NONE, self.byte_pairs).astype(np.int32)
        word, ended = np.zeros(0, np.int64), [(np.flatnonzero(n == 1), of_byte[raw[starts[n == 1]]][:, None])]
        top = int(n.max(initial=0))
        tok, rank = np.zeros((0, top), np.int32), np.zeros((0, max(top - 1, 0)), np.int32)
        for size in range(top, 1, -1):
            if len(new := np.flatnonzero(n == size)):
                b = raw[starts[new][:, None] + np.arange(size)]
                word, tok = np.concatenate([word, new]), np.concatenate([tok, of_byte[b]])
                rank = np.concatenate([rank, byte_pairs[b[:, :-1], b[:, 1:]]])
            at = rank.argmin(1)
            low = rank[np.arange(len(word)), at]
            if (over := low == NONE).any():
                ended.append((word[over], tok[over]))
                sizes[word[over]] = size
                more = ~over
                word, tok, rank, at, low = word[more], tok[more], rank[more], at[more], low[more]
            row, kept = np.arange(len(word)), np.ones(tok.shape, bool)
            tok[row, at] = low
            kept[row, at + 1] = False
            tok = tok[kept].reshape(len(word), size - 1)
            kept = np.ones(rank.shape, bool)
            kept[row, at] = False  # of the pairs on both sides one is left in its place
            rank = rank[kept].reshape(len(word), size - 2)
            i = np.flatnonzero(at < size - 2)
            rank[i, at[i]] = self._ranks(low[i], tok[i, at[i] + 1])
            i = np.flatnonzero(at > 0)
            rank[i, at[i] - 1] = self._ranks(tok[i, at[i] - 1], low[i])
        if len(word):  # merged to one token
            ended.append((word, tok))
            sizes[word] = 1
        out = Runs(np.zeros(int(sizes.sum()), np.int32), sizes)
        for which, t in ended:
            out.values[out.starts[which][:, None] + np.arange(t.shape[1])] = t
        return out

    def replay(self, words: list[bytes]) -> Runs:
        """The merges in rank order on all words at once."""
        raw = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.array([len(w) for w in words], np.int64)
        n, ends = len(raw), np.cumsum(sizes)
        follow = np.arange(1, n + 1, dtype=np.int64)
        follow[ends[sizes > 0] - 1] = -1
        before = np.arange(-1, n - 1, dtype=np.int64)
        before[(ends - sizes)[sizes > 0]] = -1
        # the index: merge -> positions of the left one of the pair
        first = np.full(n, -1, np.int64)
        first[:-1] = self.byte_pairs[raw[:-1], raw[1:]] if n else 0
        first[follow < 0] = -1
        order = np.argsort(first, kind="stable")
        order = order[np.searchsorted(first[order], 0):]
        found, at = np.unique(first[order], return_index=True)
        index = {int(r): p.tolist() for r, p in zip(found, np.split(order, at[1:]))} if len(found) else {}
        queue = sorted(index)

        tok, nxt, prv = (array("q", x.tobytes()) for x in (self.of_byte[raw], follow, before))
        span, merge = self.span, self.merge.get
        while queue:
            r = heapq.heappop(queue)
            places = index.pop(r)
            places.sort()
            for done, p in enumerate(places):
                q = nxt[p]
                if q < 0 or merge(tok[p] * span + tok[q]) != r:
                    continue  # the pair is gone
                tok[p], tok[q] = r, -1
                after = nxt[p] = nxt[q]
                nxt[q] = -1
                lower = False
                if after >= 0:
                    prv[after] = p
                    m = merge(r * span + tok[after])
                    if m is not None:
                        if m in index:
                            index[m].append(p)
                        else:
                            index[m] = [p]
                            heapq.heappush(queue, m)
                        lower = m < r
                b = prv[p]
                if b >= 0:
                    m = merge(tok[b] * span + r)
                    if m is not None:
                        if m in index:
                            index[m].append(b)
                        else:
                            index[m] = [b]
                            heapq.heappush(queue, m)
                        lower = lower or m < r
                if lower:  # first that one, then the rest of this rank
                    if rest := places[done + 1:]:
                        index[r] = rest
                        heapq.heappush(queue, r)
                    break
        ids = np.frombuffer(tok, np.int64)
        alive = ids >= 0
        upto = np.concatenate([[0], np.cumsum(alive)])
        return Runs(ids[alive].astype(np.int32), upto[ends] - upto[ends - sizes])

    def check(self, ids: np.ndarray) -> None:
        if len(ids) and (int(ids.max()) >= self.span or (self.spelling.sizes[ids] == 0).any()):
            raise ValueError("an id is not in the vocabulary")

    def spell(self, ids: np.ndarray) -> pa.Array:
        """The bytes of each id."""
        self.check(ids)
        return self.tokens.take(pa.array(ids))

    def decode(self, ids: np.ndarray) -> bytes:
        self.check(ids)
        return self.spelling.take(ids.astype(np.int64)).tobytes()


@cache
def vocabulary(path: str) -> Vocabulary:
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})


class _Words(dict):
    """Numbers words as they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Memory:
    """Distinct words and the ids of those encoded so far."""

    def __init__(self, vocab: Vocabulary, pattern: str):
        self.vocab, self.pattern = vocab, regex.compile(pattern)
        self.words, self.ids, self.chars = _Words(), Runs(np.zeros(0, np.int32), np.zeros(0, np.int64)), 0

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.words) > MAX_WORDS or self.chars > MAX_KEPT_CHARS:
            self.__init__(self.vocab, self.pattern.pattern)
        known, number = len(self.words), self.words.__getitem__
        docs = []
        for text in texts:
            parts = [np.fromiter(map(number, part), np.int64, len(part)) for part in split_words(text, self.pattern)]
            docs.append(np.concatenate(parts) if parts else np.zeros(0, np.int64))
        new = list(islice(self.words, known, None))
        self.chars += sum(map(len, new))
        self.ids = self.ids.join(self.vocab.encode([w.encode() for w in new]))
        return (self.ids.take(d) for d in docs)


def _encode(path: str, pattern: str, text_at: int, kept: list[int]):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(vocabulary(path), pattern)

        def block(rows: list[tuple[pa.RecordBatch, int]], texts: list[str]) -> Iterator[pa.RecordBatch]:
            held, size, at = [], 0, 0
            for ids in memory.encode(texts):
                held.append(ids)
                size += len(ids)
                if size >= GROUP_TOKENS:
                    yield emit(rows[at: at + len(held)], held)
                    at, held, size = at + len(held), [], 0
            if held:
                yield emit(rows[at:], held)

        def emit(rows, ids) -> pa.RecordBatch:
            other = []
            for c in kept:
                parts = [b.column(c).slice(i, 1) for b, i in rows]
                other.append(pa.concat_arrays(parts))
            n = pa.array([len(x) for x in ids], pa.int64())
            return pa.RecordBatch.from_arrays(
                [*other, n, pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())],
                [*(rows[0][0].schema.names[c] for c in kept), "n_tokens", "ids"])

        rows, texts, chars = [], [], 0
        for b in it:
            column = b.column(text_at)
            for i in range(b.num_rows):
                text = column[i].as_py() or ""
                rows.append((b, i))
                texts.append(text)
                chars += len(text)
                if chars >= BLOCK_CHARS:
                    yield from block(rows, texts)
                    rows, texts, chars = [], [], 0
        yield from block(rows, texts)

    return run


def encode_texts(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """All columns of `docs` but the text, with `n_tokens` and `ids` (binary,
    little-endian uint32): the ids of the whole text by the rank file `path`
    (on every node), each match of `pattern` encoded separately."""
    small_batches(docs.sparkSession)
    others = [c for c in docs.columns if c not in (text_col, "n_tokens", "ids")]
    rows = docs.select(*[F.col(f"`{c}`") for c in others], F.col(text_col).cast("string").alias("_text"))
    schema = T.StructType([f for f in rows.schema.fields if f.name != "_text"])
    schema = schema.add("n_tokens", T.LongType()).add("ids", T.BinaryType())
    return rows.mapInArrow(_encode(path, pattern, len(others), list(range(len(others)))), schema)


@cache
def _names() -> pa.Array:
    return pa.array(map(str, range(2**17)), pa.string())


def _decimals(ids: np.ndarray) -> pa.Array:
    if not len(ids) or int(ids.max()) < 2**17:
        return _names().take(pa.array(ids))
    return pa.array(ids).cast(pa.string())


def _spelled(ids: pa.Array, spell, sep: str | bytes) -> pa.Array:
    """What `spell` makes of the ids of each row, joined by `sep`."""
    rows = ids.to_pylist()
    sizes = np.array([len(x or b"") // 4 for x in rows], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    each = spell(np.frombuffer(b"".join(x or b"" for x in rows), "<u4"))
    lists = pa.ListArray.from_arrays(pa.array(offsets), each, mask=pa.array([x is None for x in rows], pa.bool_()))
    return pc.binary_join(lists, sep)


def decoded(ids: Column | str, path: str) -> Column:
    """The bytes that `ids` of `encode_texts` stand for."""

    @F.arrow_udf("binary")
    def decode(ids: pa.Array) -> pa.Array:
        return _spelled(ids, vocabulary(path).spell, b"")

    return decode(ids)


def decimal(ids: Column | str) -> Column:
    """The ids as decimal numbers joined by commas."""

    @F.arrow_udf("string")
    def spell(ids: pa.Array) -> pa.Array:
        return _spelled(ids, _decimals, ",")

    return spell(ids)


def op11_bpe(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = encode_texts(docs, path, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", "n_tokens", F.sha2(decimal("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(decoded("ids", path), 256).alias("decoded_sha256"))
