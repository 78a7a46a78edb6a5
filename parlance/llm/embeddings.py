"""Near-duplicate vectors by Euclidean p-stable hashing, checked by exact cosine.

On unit vectors a cosine of at least c is a distance of at most sqrt(2 - 2c). Each table quantises ``projections`` random
projections in steps of ``width``; vectors equal in all of them share a bucket. At the defaults two vectors at cosine 0.95
meet in at least one of the tables with probability 0.95, at 0.97 with 0.998; unrelated ones share a given table's bucket
once in 10^5. Past some 10^8 vectors take more projections and tables. Buckets of one are dropped before the vectors
move; larger ones are compared block by block in their task, and only counts and a spanning forest come out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.components import components
from parlance.llm.runs import Sets, whole_runs
from parlance.llm.tables import in_blocks, saved

BLOCK = 1024
FEW = 32
PAIRS = 100_000


def usable(vector: Column) -> Column:
    """Not null, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def unit(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    values = values / np.abs(values).max(axis=1, keepdims=True)  # squares of very small or large ones stay finite
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def bucket_keys(vectors: np.ndarray, tables: int, projections: int, width: float, seed: int) -> np.ndarray:
    """One long per vector and table: a hash of its quantised projections."""
    rng = np.random.default_rng((seed, vectors.shape[1]))
    lines = rng.standard_normal((vectors.shape[1], tables * projections))
    shift = rng.uniform(0, width, tables * projections)
    odd = rng.integers(1, 1 << 62, (projections, 2)) * 2 + 1
    cells = np.floor((vectors @ lines + shift) / width).astype(np.int64).reshape(-1, tables, projections)
    keys = np.full(cells.shape[:2], vectors.shape[1], dtype=np.int64)
    with np.errstate(over="ignore"):
        for i in range(projections):
            keys = (keys ^ (cells[:, :, i] * odd[i, 0])) * odd[i, 1]
            keys ^= (keys >> 29) & ((1 << 35) - 1)
    return keys


def hashed(classes: DataFrame, tables: int, projections: int, width: float, seed: int) -> DataFrame:
    """``classes`` (cid, n, vector) with ``keys``, the bucket of each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            sizes = np.diff(vectors.offsets.to_numpy())
            keys = np.zeros((len(sizes), tables), dtype=np.int64)
            for dim in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == dim)
                keys[own] = bucket_keys(unit(vectors.take(pa.array(own)), dim), tables, projections, width, seed)
            ends = pa.array(np.arange(0, keys.size + 1, tables, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))], names=["cid", "n", "vector", "keys"]
            )

    kinds = dict(classes.dtypes)
    return classes.select("cid", "n", "vector").mapInArrow(
        run, f"cid {kinds['cid']}, n long, vector {kinds['vector']}, keys array<long>"
    )


def _pairs(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) with i < j in the same of the short runs."""
    found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
    for apart in range(1, int((stops - starts).max(initial=1))):
        size = np.maximum(stops - starts - apart, 0)
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        left = np.repeat(starts, size) + inside
        found.append((left, left + apart))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95, tables: int = 24,
                 projections: int = 16, width: float = 2.0, seed: int = 7) -> DataFrame:
    """One row per row of ``df``: key, n_links, component_id, kept (key = component_id).

    Equal vectors are collapsed first and counted as links of each other. Null and zero vectors and those with null or
    non-finite components link with nothing; vectors of different dimension never link. A null key is never a
    component_id unless its component has no other. Other columns are not read. Empty table: empty result.
    """
    rows = df.select(F.col(key).alias("id"), F.col(vector).alias("vector"))
    good = rows.where(usable(F.col("vector"))).select(
        "id", F.transform("vector", lambda x: F.when(x == 0, F.lit(0)).otherwise(x).cast("double")).alias("vector")
    )
    grouped = good.groupBy("vector").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n"))
    numbered = grouped.select(F.xxhash64("vector").alias("cid"), "low", "n", "vector")
    classes = saved(hashed(numbered, tables, projections, width, seed), "vectors")
    lows = saved(numbered.select("cid", "low", "n"), "classes")
    spread = classes.select("cid", F.posexplode("keys").alias("t", "bucket"))
    runs = ["t", "bucket", "_a", "_b"]
    met = in_blocks(spread, ["t", "bucket"], "cid", BLOCK)
    met = met.join(classes, "cid").repartition(*runs).sortWithinPartitions(*runs, "cid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_, starts in whole_runs(batches, runs):
            cid, count, table = (rows_.column(c).to_numpy() for c in ("cid", "n", "t"))
            mine = rows_.column("_mine").to_numpy(zero_copy_only=False)
            same = rows_.column("_a").to_numpy() == rows_.column("_b").to_numpy()
            keys = rows_.column("keys").combine_chunks().flatten().to_numpy().reshape(-1, tables)
            vectors = rows_.column("vector").combine_chunks()
            sizes = np.diff(vectors.offsets.to_numpy())
            links = np.zeros(len(cid), dtype=np.int64)
            sets = Sets(len(cid))

            def count_pairs(i: np.ndarray, j: np.ndarray) -> None:
                earlier = np.zeros(len(i), dtype=bool)  # a pair counts in the first table in which it meets
                for t in range(tables):
                    earlier |= (t < table[i]) & (keys[i, t] == keys[j, t])
                i, j = i[~earlier], j[~earlier]
                np.add.at(links, i, count[j])
                np.add.at(links, j, count[i])
                sets.join(i, j)

            stops = np.append(starts[1:], len(cid))
            few = (stops - starts <= FEW) & same[starts]
            i, j = _pairs(starts[few], stops[few])
            alike = sizes[i] == sizes[j]
            i, j = i[alike], j[alike]
            for dim in np.unique(sizes[i]).tolist():
                units = np.zeros((len(cid), dim))
                own = np.flatnonzero(sizes == dim)
                units[own] = unit(vectors.take(pa.array(own)), dim)
                chosen = np.flatnonzero(sizes[i] == dim)
                for at in range(0, len(chosen), PAIRS):
                    part = chosen[at:at + PAIRS]
                    near = np.einsum("ij,ij->i", units[i[part]], units[j[part]]) >= threshold
                    count_pairs(i[part][near], j[part][near])
            for start, stop in zip(starts[~few].tolist(), stops[~few].tolist()):
                for dim in np.unique(sizes[start:stop]).tolist():
                    own = start + np.flatnonzero(sizes[start:stop] == dim)
                    left = own if same[start] else own[mine[own]]
                    right = own if same[start] else own[~mine[own]]
                    near = unit(vectors.take(pa.array(left)), dim) @ unit(vectors.take(pa.array(right)), dim).T >= threshold
                    if same[start]:
                        near = np.triu(near, 1)
                    i, j = np.nonzero(near)
                    count_pairs(left[i], right[j])
            hit = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cid[hit]), pa.array(links[hit]), pa.array(cid[sets.roots()[hit]])], names=["cid", "links", "root"]
            )

    found = saved(met.select("cid", "n", "vector", "keys", "t", "bucket", "_a", "_b", "_mine").mapInArrow(
        run, "cid long, links long, root long"
    ), "found")
    roots = components(found.select(F.col("cid").alias("u"), F.col("root").alias("v")))
    named = lows.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = named.groupBy("root").agg(F.min("low").alias("component_id"))
    total = found.groupBy("cid").agg(F.sum("links").alias("links"))
    table_ = named.join(least, "root").join(total, "cid", "left").select(
        "cid", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    numbers = good.select("id", F.xxhash64("vector").alias("cid")).join(table_, "cid").select("id", "n_links", "component_id")
    bad = rows.where(~F.coalesce(usable(F.col("vector")), F.lit(False))).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    return numbers.unionByName(bad).select(
        F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
