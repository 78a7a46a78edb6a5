"""Near-duplicate documents by SimHash: 64-bit fingerprints, linked within a Hamming radius by BK-trees.

Fingerprints within ``radius`` bits agree on at least ``blocks - radius`` of ``blocks`` bit blocks, so each
fingerprint is dealt to one shard per choice of ``blocks - radius`` blocks. Each shard's fingerprints form a BK-tree
(children keyed by the integer distance to their parent) and search it by following only the edges within the
radius. The trees are built where their shard lies: sending all trees to all executors would gather every
fingerprint at the driver. A shard of more than SHARD fingerprints becomes several trees, each searched by all of them.

At 6 blocks a shard key has about 21 bits; past about 2^30 distinct fingerprints take 7 (35 keys of 27 bits).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.components import components
from parlance.llm.runs import Sets, whole_runs
from parlance.llm.tables import in_blocks, saved

SHARD = 4096
SEARCHES = 4096


def fingerprint(text: bytes, width: int = 4) -> int:
    """Bit i is 1 if set in over half of the XXH64 hashes (seed 42) of all word shingles; 0 without words."""
    words = text.lower().split()  # of bytes: A-Z only, and the ASCII white space \x20 \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends - lengths + 1).tolist()
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        hashes = [digest(joined, 42)]
    else:
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, ends[width - 1:].tolist())]
    votes = np.zeros(64, dtype=np.int64)
    values = np.array(hashes, dtype="<u8")
    for at in range(0, len(values), 65_536):
        part = values[at:at + 65_536]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(values), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """(key, fp): the fingerprint as a signed long. A null text counts as empty: fingerprint 0."""

    def run(batches):
        for batch in batches:
            values = [fingerprint(t or b"", width) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], names=[key, "fp"])

    kind = dict(df.dtypes)[key]
    return df.select(F.col(key), F.col(text).cast("binary").alias("text")).mapInArrow(run, f"`{key}` {kind}, fp long")


def shard_keys(fp: Column, radius: int, blocks: int) -> Column:
    """One long per choice of ``blocks - radius`` equal blocks: the choice's number and the hash of its bits."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = 0
        for i in chosen:
            mask |= masks[i]
        mask = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.xxhash64(F.lit(number), fp.bitwiseAND(F.lit(mask).cast("long"))))
    return F.array(*keys)


class Forest:
    """BK-trees of many shards at once, grown level by level; ``shard`` numbers the tree of each member."""

    def __init__(self, values: np.ndarray, shard: np.ndarray) -> None:
        self.values = values
        count = int(shard.max()) + 1 if len(shard) else 0
        self.root = np.full(count, -1)
        first = np.unique(shard, return_index=True)
        self.root[first[0]] = first[1]
        codes, nodes = [], []
        waiting = np.setdiff1d(np.arange(len(values)), first[1])
        at = self.root[shard[waiting]]
        while len(waiting):
            code = at * 65 + np.bitwise_count(values[waiting] ^ values[at]).astype(np.int64)
            edge, child, back = np.unique(code, return_index=True, return_inverse=True)
            codes.append(edge)
            nodes.append(waiting[child])
            stay = np.ones(len(waiting), dtype=bool)
            stay[child] = False
            at, waiting = waiting[child][back][stay], waiting[stay]
        code = np.concatenate(codes) if codes else np.zeros(0, dtype=np.int64)
        order = np.argsort(code)
        self.code = code[order]
        self.child = (np.concatenate(nodes) if nodes else np.zeros(0, dtype=np.int64))[order]

    def search(self, values: np.ndarray, shard: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions (search, member) of all pairs within the radius in the search's own tree."""
        query, node = np.arange(len(values)), self.root[shard]
        query, node = query[node >= 0], node[node >= 0]
        found = []
        while len(query):
            away = np.bitwise_count(values[query] ^ self.values[node]).astype(np.int64)
            hit = away <= radius
            found.append((query[hit], node[hit]))
            low = np.searchsorted(self.code, node * 65 + np.maximum(away - radius, 0))
            high = np.searchsorted(self.code, node * 65 + np.minimum(away + radius, 64), side="right")
            width = high - low
            inside = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
            node = self.child[np.repeat(low, width) + inside]
            query = np.repeat(query, width)
        return np.concatenate([q for q, _ in found]), np.concatenate([n for _, n in found])


def links(prints: DataFrame, radius: int = 4, blocks: int = 6) -> DataFrame:
    """(u, v): enough links between distinct fingerprints ``fp`` to connect all that are linked; never all pairs."""
    keyed = prints.select("fp", F.explode(shard_keys(F.col("fp"), radius, blocks)).alias("key"))

    def run(batches):
        for rows, starts in whole_runs(batches, ("key", "_a", "_b")):
            values = rows.column("fp").to_numpy()
            bits = values.view(np.uint64)
            mine = rows.column("_mine").to_numpy(zero_copy_only=False)
            shard = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(values))))
            members = np.flatnonzero(mine)
            forest = Forest(bits[members], shard[members])
            sets = Sets(len(values))
            for at in range(0, len(values), SEARCHES):
                query, node = forest.search(bits[at:at + SEARCHES], shard[at:at + SEARCHES], radius)
                sets.join(query + at, members[node])
            roots = sets.roots()
            moved = np.flatnonzero(roots != np.arange(len(roots)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[moved]), pa.array(values[roots[moved]])], names=["u", "v"]
            )

    return in_blocks(keyed, ["key"], "fp", SHARD).select("key", "_a", "_b", "_mine", "fp").mapInArrow(
        run, "u long, v long"
    ).distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, radius: int = 4,
                    blocks: int = 6) -> DataFrame:
    """One row per row of ``df``: key, fingerprint (16 hex digits), component_id (smallest key reachable).

    Only ``key`` and ``text`` are read, so other columns cannot clash. Null and wordless texts have fingerprint 0 and
    link like any other. Repeated rows share a fingerprint and come back as often as they went in. A null key is never
    a component_id unless its whole component has none. Empty table: empty result.
    """
    prints = saved(fingerprints(df, key, text, width), "fingerprints")
    classes = saved(prints.groupBy("fp").agg(F.min(key).alias("low")), "classes")
    roots = components(links(classes.select("fp"), radius, blocks))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("least"))
    moved = rooted.join(lowest, "root").where("NOT (least <=> low)").select("fp", "least")
    # written, so that the join below has two plain inputs and a fingerprint of many rows can be split
    named = saved(
        classes.join(moved, "fp", "left").select("fp", F.coalesce("least", "low").alias("component_id")), "named"
    )
    return prints.join(named, "fp").select(
        F.col(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
    )
