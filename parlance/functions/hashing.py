"""Deterministic draws: a function of (seed, row key) only, so results do not depend on partitioning."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from math import sin

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(seed, *keys: Column) -> Column:
    """32 hex digits for one row; sorting by it is a shuffle of the rows."""
    parts = [F.lit(str(seed))] + [k.cast("string") for k in keys]
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def draw_int(seed, *keys: Column) -> Column:
    return F.conv(F.substring(draw(seed, *keys), 1, 8), 16, 10).cast("long")


def draw_uniform(seed, *keys: Column) -> Column:
    return draw_int(seed, *keys) / F.lit(4294967296.0)


# ---- MD5 of many short texts at once -------------------------------------------------------------------

_SINES = [int(abs(sin(i + 1)) * 2**32) for i in range(64)]
_TURNS = [[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]]
_PLACES = [lambda i: i, lambda i: (5 * i + 1) % 16, lambda i: (3 * i + 5) % 16, lambda i: 7 * i % 16]
#: Prefixes hashed together: the arrays of a tile stay in the cache.
_TILE_CELLS = 32_768


def _first_words(heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """First 32 bits of the MD5 of every head with every tail; rows of both are one block's 16 words, their sum is the block."""
    start = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
    shape = (len(heads), len(tails))
    a, b, c, d, t, u = (np.empty(shape, dtype=np.uint32) for _ in range(6))
    for array, value in zip((a, b, c, d), start):
        array.fill(value)
    used = tails.any(axis=0)
    for i in range(64):
        kind, k = i // 16, _PLACES[i // 16](i)
        if kind == 0:
            np.bitwise_xor(c, d, out=t)
            np.bitwise_and(t, b, out=t)
            np.bitwise_xor(t, d, out=t)
        elif kind == 1:
            np.bitwise_xor(b, c, out=t)
            np.bitwise_and(t, d, out=t)
            np.bitwise_xor(t, c, out=t)
        elif kind == 2:
            np.bitwise_xor(b, c, out=t)
            np.bitwise_xor(t, d, out=t)
        else:
            np.invert(d, out=t)
            np.bitwise_or(t, b, out=t)
            np.bitwise_xor(t, c, out=t)
        np.add(t, a, out=t)
        np.add(t, (heads[:, k] + np.uint32(_SINES[i]))[:, None], out=t)
        if used[k]:
            np.add(t, tails[None, :, k], out=t)
        turn = _TURNS[kind][i % 4]
        np.left_shift(t, np.uint32(turn), out=u)
        np.right_shift(t, np.uint32(32 - turn), out=t)
        np.bitwise_or(t, u, out=t)
        np.add(t, b, out=t)
        a, b, c, d, t = d, t, b, c, a
    return (a + start[0]).byteswap()


def smallest_md5(heads: Sequence[bytes], tails: Sequence[bytes], n: int, without: Sequence[bytes | None]) -> list[list[int]]:
    """For each head, the places of the n tails with the smallest MD5 of head + tail, the tail equal to its ``without`` left out.

    Tails are distinct. The first 32 bits of every digest are computed in arrays; whole digests decide among the few that are
    within the n smallest by them. Texts beyond one block are hashed one by one.
    """
    place = {tail: j for j, tail in enumerate(tails)}
    longest = max(map(len, tails), default=0)
    out: list[list[int]] = [[] for _ in heads]
    if n <= 0 or not tails:
        return out

    def settle(i: int, among) -> None:
        own = place.get(without[i])
        digests = sorted((hashlib.md5(heads[i] + tails[j]).digest(), j) for j in among if j != own)
        out[i] = [j for _, j in digests[:n]]

    by_length: dict[int, list[int]] = {}
    for i, head in enumerate(heads):
        by_length.setdefault(len(head), []).append(i)
    for length, rows in by_length.items():
        if length + longest > 55 or len(tails) <= n + 1:
            for i in rows:
                settle(i, range(len(tails)))
            continue
        ends = np.zeros((len(tails), 64), dtype=np.uint8)
        for j, tail in enumerate(tails):
            stop = length + len(tail)
            ends[j, length:stop] = np.frombuffer(tail, dtype=np.uint8)
            ends[j, stop] = 0x80
            ends[j, 56:58] = np.frombuffer((8 * stop).to_bytes(2, "little"), dtype=np.uint8)
        ends = ends.view("<u4")
        step = max(_TILE_CELLS // len(tails), 1)
        for at in range(0, len(rows), step):
            tile = rows[at:at + step]
            starts = np.zeros((len(tile), 64), dtype=np.uint8)
            starts[:, :length] = np.frombuffer(b"".join(heads[i] for i in tile), dtype=np.uint8).reshape(len(tile), length)
            first = _first_words(starts.view("<u4"), ends)
            # one more than n: the tail left out may be among them
            limit = np.partition(first, n, axis=1)[:, n]
            for i, row, most in zip(tile, first, limit):
                settle(i, np.flatnonzero(row <= most).tolist())
    return out
