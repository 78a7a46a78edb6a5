"""Best-fit packing of token sequences by patterns fitted with non-negative least squares.

Texts become pieces of at most ``limit`` tokens. The histogram of piece lengths (``limit`` numbers at most, whatever
the corpus) goes to the driver. There the lengths are put into bins, patterns of few bins that fill a sequence are
enumerated, repeat counts are fitted to the histogram by non-negative least squares and rounded, and what is left is
packed best-fit by decreasing length into the room that remains. The resulting plan lists, for each length, which
ranks of its pieces go to which sequences; its size depends on ``limit`` only. Pieces are ranked within their length
by hashed buckets, so no task holds all pieces of a common length.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parlance.llm.tables import saved
from parlance.llm.tokencount import byte_letters

KEEP = 500_000
BUCKETS = 1024
BINS = 256
ODD_SPACE = re.compile("[\x1c-\x1f]").search
#: Fixed value: how the vocabulary cuts lower-case text into pre-tokens.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
#: Printable ASCII and Latin-1 letters: composed already, and lower-cased one by one.
PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch


class Encoder(dict):
    """Maps a word without white space to its ids as little-endian bytes; KEEP words at most, then it starts afresh.

    Holds for a vocabulary that composes and lower-cases, drops white space, cuts words by PRE_TOKEN and spells bytes as
    letters, since then no pre-token crosses white space. Plain words go straight to the library's merges; any other word,
    special strings among them, goes through its whole chain.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        letters = byte_letters()
        self.spelling = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(128, 256)}

    def raw(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if PLAIN(word) and "<|" not in word:
            found: list[int] = []
            for token in PRE_TOKEN(word.lower()):
                spelt = token if token.isascii() else token.translate(self.spelling)
                found += [t.id for t in self.merges.tokenize(spelt)]
            ids = np.array(found, dtype="<u4").tobytes()
        else:
            ids = self.raw(word)
        if len(self) >= KEEP:
            self.clear()
        if len(word) < 64:
            self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if ODD_SPACE(text):  # Python splits at these, the vocabulary's pattern does not
            return self.raw(text)
        return b"".join(map(self.__getitem__, text.split()))


def pieces(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", limit: int = 2048,
           end: int = 0) -> DataFrame:
    """(key, piece, start, length, ids_crc32): ids of each text, then ``end``, cut at every ``limit`` tokens."""
    closing = np.array([end], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            row, piece, length, crc = [], [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                ids = (encoder.ids(t) if t else b"") + closing
                for n, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at:at + 4 * limit]
                    row.append(i)
                    piece.append(n)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            number = pa.array(piece, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), number,
                 pa.array(np.array(piece, dtype=np.int64) * limit), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=[key, "piece", "start", "length", "ids_crc32"],
            )

    return df.select(F.col(key), F.col(text).alias("text")).mapInArrow(
        run, f"`{key}` {dict(df.dtypes)[key]}, piece int, start long, length long, ids_crc32 long"
    )


def patterns(bins: int, most: int) -> np.ndarray:
    """Rows of bin numbers (1..bins, 0 for none) of up to ``most`` pieces that fill a sequence of ``bins`` units."""
    found: list[tuple[int, ...]] = []

    def grow(head: tuple[int, ...], left: int) -> None:
        if len(head) + 1 == most:
            if left >= head[-1]:
                found.append((*head, left))
            return
        found.append((*head, left))
        for next_ in range(head[-1] if head else 1, left // 2 + 1):
            grow((*head, next_), left - next_)

    grow((), bins)
    return np.array([p + (0,) * (most - len(p)) for p in found])


def least_squares(matrix: np.ndarray, wanted: np.ndarray, rounds: int) -> np.ndarray:
    """Non-negative least squares by the active-set method: columns enter by gradient, leave at zero."""
    x = np.zeros(matrix.shape[1])
    inside = np.zeros(matrix.shape[1], dtype=bool)
    for _ in range(rounds):
        gradient = matrix.T @ (wanted - matrix @ x)
        gradient[inside] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= 1e-9 * max(1.0, float(np.abs(wanted).max())):
            break
        inside[best] = True
        while True:
            columns = np.flatnonzero(inside)
            solution = np.linalg.lstsq(matrix[:, columns], wanted, rcond=None)[0]
            if (solution > 0).all():
                x[:] = 0
                x[columns] = solution
                break
            held = x[columns]
            falling = solution <= 0
            step = np.min(held[falling] / np.maximum(held[falling] - solution[falling], 1e-300))
            held = held + step * (solution - held)
            held[falling & (held <= 1e-12)] = 0
            x[columns] = held
            inside[columns[held <= 1e-12]] = False
    return x


def plan(histogram: dict[int, int], limit: int, bins: int = BINS, most: int = 3) -> list[tuple[int, list[int]]]:
    """(repeats, lengths) of all sequences; each length occurs as often as the histogram says.

    The number of entries depends on ``limit`` and ``bins``, not on the counts.
    """
    bins = min(bins, limit)
    unit = -(-limit // bins)
    bins = -(-limit // unit)
    left = {n: c for n, c in histogram.items() if c > 0}
    out: list[tuple[int, list[int]]] = []
    if limit in left:
        out.append((left.pop(limit), [limit]))
    queues: dict[int, deque[list[int]]] = {}
    for n in sorted(left, reverse=True):
        queues.setdefault(min(bins, -(-n // unit)), deque()).append([n, left[n]])
    wanted = np.zeros(bins)
    for b, runs in queues.items():
        wanted[b - 1] = sum(c for _, c in runs)
    open_: dict[int, list[tuple[int, list[int]]]] = {}
    if wanted.any():
        rows = patterns(bins, most)
        rows = rows[np.all((rows == 0) | (wanted[rows - 1] > 0), axis=1)]
        matrix = np.zeros((bins, len(rows)))
        for column in range(most):
            used = rows[:, column] > 0
            np.add.at(matrix, (rows[used, column] - 1, np.flatnonzero(used)), 1)
        scale = wanted.max()
        weight = 1 / np.sqrt(np.maximum(wanted / scale, 1e-3))  # rare lengths count too
        repeats = least_squares(matrix * weight[:, None], wanted / scale * weight, 3 * bins) * scale
        for p in np.argsort(-repeats, kind="stable"):
            count = int(np.round(repeats[p]))
            filled = [int(b) for b in rows[p] if b]
            while count > 0 and all(queues[b] for b in set(filled)):
                take = count
                for b in set(filled):
                    take = min(take, queues[b][0][1] // filled.count(b))
                if take:
                    lengths = [queues[b][0][0] for b in filled]
                    for b in filled:
                        queues[b][0][1] -= take
                else:  # a run too short for all its places: one sequence from several runs
                    if any(sum(c for _, c in queues[b]) < filled.count(b) for b in set(filled)):
                        break
                    take, lengths = 1, []
                    for b in filled:
                        while not queues[b][0][1]:
                            queues[b].popleft()
                        lengths.append(queues[b][0][0])
                        queues[b][0][1] -= 1
                for b in set(filled):
                    while queues[b] and not queues[b][0][1]:
                        queues[b].popleft()
                open_.setdefault(limit - sum(lengths), []).append((take, lengths))
                count -= take
    rest = sorted(((n, c) for runs in queues.values() for n, c in runs if c), reverse=True)
    return out + _best_fit(rest, open_, limit)


def _best_fit(rest: list[tuple[int, int]], open_: dict[int, list[tuple[int, list[int]]]], limit: int
              ) -> list[tuple[int, list[int]]]:
    """Puts runs of equal lengths, longest first, where they leave the least room; new sequences where none is left."""
    rooms = sorted(r for r in open_ if open_[r])
    for n, count in rest:
        while count:
            at = bisect_left(rooms, n)
            if at == len(rooms):
                room, repeats, lengths = limit, -(-count // max(1, limit // n)), []
            else:
                room = rooms[at]
                repeats, lengths = open_[room].pop()
                if not open_[room]:
                    rooms.pop(at)
            fit = min(room // n, count)
            used = min(repeats, count // fit)
            if used < repeats:
                _put(open_, rooms, room, (repeats - used, lengths))
            _put(open_, rooms, room - fit * n, (used, lengths + [n] * fit))
            count -= used * fit
    return [entry for room in sorted(open_) for entry in open_[room] if entry[1]]


def _put(open_: dict, rooms: list[int], room: int, entry: tuple[int, list[int]]) -> None:
    if not open_.get(room):
        open_[room] = []
        insort(rooms, room)
    open_[room].append(entry)


def places(plan_: list[tuple[int, list[int]]]) -> pd.DataFrame:
    """The plan by length: pieces of rank first.. of a length go to sequence sequence + (rank - first), at offset."""
    rows, taken, sequence = [], {}, 0
    for repeats, lengths in plan_:
        offset = 0
        for n in lengths:
            first = taken.get(n, 0)
            rows.append((n, first, sequence, offset))
            taken[n] = first + repeats
            offset += n
        sequence += repeats
    return pd.DataFrame(rows, columns=["length", "first", "sequence", "offset"]).sort_values(["length", "first"])


def pack(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", limit: int = 2048,
         end: int = 0) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset; sequences have no gaps.

    A null or empty text is the single token ``end``. Repeated rows and null keys are pieces like any other. Only
    ``key`` and ``text`` are read. Empty table: empty result.
    """
    cut = saved(
        pieces(df, vocabulary, key, text, limit, end)
        .withColumn("bucket", F.pmod(F.xxhash64(key, "piece", "ids_crc32"), F.lit(BUCKETS))), "pieces",
    )
    counts = cut.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    where = {n: g.to_numpy()[:, 1:].T.copy() for n, g in places(plan(histogram, limit)).groupby("length")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(rank), dtype=np.int64), np.zeros(len(rank), dtype=np.int64)
            for n in np.unique(length).tolist():
                own = np.flatnonzero(length == n)
                first, start, place = where[n]
                at = np.searchsorted(first, rank[own], side="right") - 1
                sequence[own] = start[at] + rank[own] - first[at]
                offset[own] = place[at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:5], "sequence_id", "offset"],
            )

    inside = W.partitionBy("length", "bucket").orderBy(F.col(key), "piece", "ids_crc32")
    ranked = cut.withColumn("r", F.row_number().over(inside)).join(offsets, ["length", "bucket"])
    kind = dict(df.dtypes)[key]
    return ranked.select(
        key, "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("r") - 1).alias("rank")
    ).mapInArrow(
        run, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
