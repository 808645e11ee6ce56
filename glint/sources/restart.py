"""Restart points of deflated archive members.

A deflated stream can be read from the start of any of its blocks, given the
32 KB before it. Block starts aren't marked, and they fall on any bit. They
are found while the member is inflated once: of all bit positions in a stretch
of the stream those are kept where a block of dynamic codes could begin (its
header's counts are in range, its code lengths make a complete code), and a
candidate is taken if inflating from there gives what the stream gives. A
reader checks each piece's CRC-32 against the one from this first pass."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import numpy as np

WINDOW = 32_768     # what a block may refer back to
STRETCH = 262_144   # compressed bytes searched at once
CHUNK = 65_536
PROOF = 4_096       # compressed bytes that a candidate must inflate rightly


class Point(NamedTuple):
    """A block start: byte and bit in the compressed data, offset in the
    member, the end of its piece there and the piece's CRC-32."""

    byte: int
    bit: int
    offset: int
    end: int
    crc: int
    window: bytes


def block_starts(data: np.ndarray) -> np.ndarray:
    """Bit positions in `data` where a block of dynamic codes may begin."""
    bits = np.unpackbits(data, bitorder="little")
    n = len(bits) - 17 - 3 * 19
    if n <= 0:
        return np.zeros(0, np.int64)
    # not the last block; type 2
    at = np.flatnonzero((bits[:n] == 0) & (bits[1: n + 1] == 0) & (bits[2: n + 2] == 1))

    def number(shift: int, width: int) -> np.ndarray:
        return sum(bits[at + shift + i].astype(np.int64) << i for i in range(width))

    at = at[(number(3, 5) <= 29)]
    at = at[(number(8, 5) <= 29)]
    lengths = number(13, 4) + 4
    filled = np.zeros(len(at), np.int64)  # of 128 code words of 7 bits
    for j in range(19):
        size = number(17 + 3 * j, 3)
        filled += np.where((j < lengths) & (size > 0), 128 >> np.minimum(size, 7), 0)
    return at[filled == 128]


def shifted(data: bytes, bit: int) -> bytes:
    """`data` without its first `bit` bits; one byte shorter if there are any."""
    if not bit or not data:
        return data
    x = np.frombuffer(data, np.uint8).astype(np.uint16)
    return ((x[:-1] >> bit) | (x[1:] << (8 - bit))).astype(np.uint8).tobytes()


def inflate(f: BinaryIO, start: int, stop: int, bit: int = 0, window: bytes = b"") -> Iterator[bytes]:
    """The data inflated from compressed bytes `start` to `stop` of a file."""
    d = zlib.decompressobj(-15, zdict=window) if window else zlib.decompressobj(-15)
    f.seek(start)
    rest = b""
    while not d.eof and start < stop:
        raw = f.read(min(CHUNK, stop - start))
        if not raw:
            raise EOFError("the archive is cut off")
        start += len(raw)
        last = start >= stop
        raw = rest + raw + (b"\0" if last and bit else b"")
        rest = raw[-1:] if bit else b""
        if out := d.decompress(shifted(raw, bit)):
            yield out


def _first_start(d, raw: bytes, window: bytes) -> tuple[int, int, bytes] | None:
    """In the compressed `raw` that follows state `d`: byte and bit of the
    first block start that is proven, and what is inflated before it."""
    true, fed, before = d.copy(), 0, []
    for at in block_starts(np.frombuffer(raw, np.uint8)).tolist():
        byte, bit = at >> 3, at & 7
        if byte + PROOF > len(raw):
            return None
        before.append(true.decompress(raw[fed:byte]))
        fed = byte
        if true.eof:
            return None
        seen = b"".join(before)
        trial = zlib.decompressobj(-15, zdict=(window + seen)[-WINDOW:])
        try:
            got = trial.decompress(shifted(raw[byte: byte + PROOF], bit))
        except zlib.error:
            continue
        want = true.copy().decompress(raw[byte: byte + PROOF])
        # the last symbols may need bits beyond the stretch
        n = min(len(got), len(want))
        if n > PROOF // 2 and got[:n] == want[:n]:
            return byte, bit, seen
    return None


def restart_points(f: BinaryIO, start: int, stop: int, every: int) -> Iterator[Point]:
    """Points of the member in compressed bytes `start` to `stop`, one about
    every `every` bytes of the member, where blocks begin often enough."""
    d, at, offset, window = zlib.decompressobj(-15), start, 0, b""
    point, crc = (start, 0, 0, b""), 0

    def take(out: bytes) -> None:
        nonlocal offset, window, crc
        offset += len(out)
        crc = zlib.crc32(out, crc)
        window = (window + out)[-WINDOW:]

    while at < stop and not d.eof:
        f.seek(at)
        if offset - point[2] < every:
            raw = f.read(min(CHUNK, stop - at))
            at += len(raw)
            take(d.decompress(raw))
            if not raw:
                raise EOFError("the archive is cut off")
            continue
        raw = f.read(min(STRETCH, stop - at))
        found = _first_start(d, raw, window)
        if found:
            byte, bit, _ = found
            take(d.decompress(raw[:byte]))
            yield Point(point[0], point[1], point[2], offset, crc, point[3])
            point, crc = (at + byte, bit, offset, window), 0
            at += byte
        else:
            take(d.decompress(raw[:max(1, len(raw) - PROOF)]))
            at += max(1, len(raw) - PROOF)
    yield Point(point[0], point[1], point[2], offset, crc, point[3])
