"""Dataset catalogs: a name to a source, a column map and a tag map."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.model import COLUMN_KEYS, TAG_KEYS, DatasetSpec
from parlance.operators.align import align
from parlance.operators.sampling import head_n, reweight, sample_n
from parlance.sources.files import read_files

REWARD_STAGE = "rm"
OPTIONS = frozenset((
    "file_name", "cloud_file_name", "path", "source", "hf_hub_url", "ms_hub_url", "om_hub_url", "script_url", "formatting",
    "ranking", "subset", "split", "folder", "num_samples", "size", "weight", "streaming", "converter", "columns", "tags",
))


def parse_entry(entry: dict, base: str = "") -> DatasetSpec:
    """A given ``columns`` or ``tags`` map replaces all defaults: absent keys become null."""
    source = entry.get("file_name") or entry.get("cloud_file_name") or entry.get("path") or entry.get("source")
    if source is None:
        raise ValueError(f"entry has no readable source: {sorted(entry)}")
    unknown = sorted(set(entry) - OPTIONS)
    if unknown:
        raise ValueError(f"unknown options {unknown}; known: {sorted(OPTIONS)}")
    if base and "file_name" in entry:
        source = f"{base.rstrip('/')}/{source}"
    spec = DatasetSpec(
        source=source,
        formatting=entry.get("formatting", "alpaca"),
        ranking=bool(entry.get("ranking", False)),
        subset=entry.get("subset"), split=entry.get("split", "train"), folder=entry.get("folder"),
        num_samples=entry.get("num_samples"), size=entry.get("size"), weight=entry.get("weight"),
        streaming=bool(entry.get("streaming", False)), converter=entry.get("converter"),
    )
    if "columns" in entry:
        spec = replace(spec, **{k: entry["columns"].get(k) for k in COLUMN_KEYS})
    if "tags" in entry:
        spec = replace(spec, **{k: entry["tags"].get(k) for k in TAG_KEYS})
    return spec


def resolve(catalog: dict, name: str, stage: str | None = None, base: str = "") -> DatasetSpec:
    if name not in catalog:
        raise ValueError(f"undefined dataset {name}")
    spec = parse_entry(catalog[name], base)
    if stage is not None and spec.ranking != (stage == REWARD_STAGE):
        raise ValueError(f"dataset {name} does not fit stage {stage}: ranking data belong to {REWARD_STAGE} only")
    return spec


def load(spark: SparkSession, catalog: dict, name: str, stage: str | None = None, base: str = "",
         key: str | None = None, max_samples: int | None = None, seed: int = 0) -> DataFrame:
    """Catalog name to canonical rows: scan, sample, then align, so that dropped rows are never aligned.

    Sampling needs a row key; without one the content hash of the row is used. ``folder`` is a folder below the source,
    ``size`` and ``weight`` draw rows with replacement, ``converter`` names the layout instead of ``formatting``. Files have
    no subsets or splits, and a stream is opened by ``read_stream``: such entries raise.
    """
    spec = resolve(catalog, name, stage, base)
    if spec.subset is not None or spec.split != "train" or spec.streaming:
        raise ValueError(f"dataset {name}: subset, split and streaming do not apply to files read as a batch")
    df = read_files(spark, f"{spec.source.rstrip('/')}/{spec.folder}" if spec.folder else spec.source)
    draws = spec.size is not None or spec.weight is not None
    if draws or spec.num_samples is not None or max_samples is not None:
        if key is None:
            key = "_row_key"
            # 48 bits: an integer order of at most 4,096 zones, see rank_by_int
            df = df.withColumn(key, F.shiftrightunsigned(F.xxhash64(F.to_json(F.struct(*df.columns))), 16))
        if spec.num_samples is not None:
            df = sample_n(df, spec.num_samples, key, seed)
        if draws:
            df = reweight(df, key, spec.size, spec.weight, seed)
        if max_samples is not None:
            df = head_n(df, max_samples, key)
    return align(df, replace(spec, formatting=spec.converter) if spec.converter else spec)
