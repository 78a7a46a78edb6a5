"""Token counts of a byte-level BPE vocabulary: pairs merged with a heap over a linked list, no ids made.

The count of a pre-token is its byte symbols minus the merges done. Counts of the pieces between spaces are kept in a
bounded table per task.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP = 400_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: printable Latin-1 as itself, the rest from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Merger(dict):
    """Maps a piece that followed a space to its number of tokens; counts it when first met.

    Holds KEEP pieces at most and starts afresh beyond, so memory is bounded whatever the corpus holds.
    """

    def __init__(self, path: str, pattern: str) -> None:
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        names = {letters[b]: b for b in range(256)}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for order, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            made = names.setdefault(left + right, len(names))
            self.rank.setdefault((names[left], names[right]), (order, made))
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.find = regex.compile(pattern).findall
        self.cut = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)").split
        self.odd = re.compile(r" (?=\s|$)").search
        self.at_space = regex.compile(r" (?=\S)").split
        self.words: dict[str, int] = {}

    def merged(self, word: str) -> int:
        """Symbols of one pre-token left when no adjacent pair has a rank."""
        known = self.words.get(word)
        if known is not None:
            return known
        symbol: list[int] = list(word.encode())
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank
        heap = [(*rank[p], i, p) for i in range(n - 1) if (p := (symbol[i], symbol[i + 1])) in rank]
        heapq.heapify(heap)
        count = n
        while heap:
            _, made, i, pair = heapq.heappop(heap)
            j = after[i]
            if symbol[i] != pair[0] or j >= n or symbol[j] != pair[1]:
                continue  # one of the two has been merged since
            symbol[i], symbol[j] = made, -1
            count -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (p := (made, symbol[k])) in rank:
                    heapq.heappush(heap, (*rank[p], i, p))
            if (h := before[i]) >= 0 and (p := (symbol[h], made)) in rank:
                heapq.heappush(heap, (*rank[p], h, p))
        if len(self.words) >= KEEP:
            self.words.clear()
        if n < 64:
            self.words[word] = count
        return count

    def piece(self, text: str) -> int:
        return sum(map(self.merged, self.find(text)))

    def __missing__(self, piece: str) -> int:
        count = self.piece(" " + piece)
        if len(self) >= KEEP:
            self.clear()
        if len(piece) < 64:
            self[piece] = count
        return count

    def count(self, text: str) -> int:
        """Tokens of a text. A space before a visible character always starts a pre-token, so pieces are independent."""
        parts = self.cut(text)
        total = len(parts) - 1
        for part in parts:
            pieces = self.at_space(part) if self.odd(part) else part.split(" ")
            if pieces[0]:
                total += self.piece(pieces[0])
            total += sum(map(self.__getitem__, pieces[1:]))
        return total


def token_counts(df: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text",
                 limit: int = 512) -> DataFrame:
    """One row per row of ``df``: key, n_bytes, n_tokens, over_limit (n_tokens > limit).

    ``vocabulary`` is the path of a tokenizer file every executor can read, ``pattern`` its pre-token pattern. Special
    tokens inside a text count one each. Null texts count as empty: 0 bytes, 0 tokens. Whole texts are counted;
    repeated rows come back as often as they went in; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = Merger(vocabulary, pattern)
        for batch in batches:
            counts = [merger.count(t) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts])],
                names=[key, "n_bytes", "n_tokens", "over_limit"],
            )

    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    return df.select(F.col(key), F.col(text).alias("text"), size.alias("n_bytes")).mapInArrow(
        run, f"`{key}` {dict(df.dtypes)[key]}, n_bytes long, n_tokens long, over_limit boolean"
    )
