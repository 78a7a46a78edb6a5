"""File scans: batch, streaming and object-store JSON; prepared-table reuse."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# File suffix to reader.
FORMATS = {"arrow": "arrow", "csv": "csv", "json": "json", "jsonl": "json", "parquet": "parquet", "txt": "text"}


def _hadoop(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _files(spark: SparkSession, path: str) -> list[str]:
    """Data files of a path and its sub-folders (hidden files, folders and markers are left out)."""
    where, fs = _hadoop(spark, path)
    if not fs.exists(where):
        raise FileNotFoundError(f"no data at {path}")
    if not fs.getFileStatus(where).isDirectory():
        return [path]
    found, listed = [], fs.listFiles(where, True)
    while listed.hasNext():
        found.append(listed.next().getPath().toString())
    below = len(fs.getFileStatus(where).getPath().toString().rstrip("/"))
    return sorted(f for f in found if not any(part.startswith(("_", ".")) for part in f[below:].split("/")))


def _suffix(path: str) -> str:
    name = path.rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[-1].lower() if "." in name else ""


def read_files(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A file or folder in the format its suffix names; a folder must hold one format only.

    Sub-folders are read too; those named ``column=value`` give a column.
    ``.json`` may hold one array over many lines, ``.jsonl`` one record per line (splittable).
    """
    files = _files(spark, path)
    suffixes = {_suffix(f) for f in files}
    kinds = {FORMATS.get(s) for s in suffixes}
    if not files or None in kinds or "arrow" in kinds:
        raise ValueError(f"no reader for {sorted(suffixes)} at {path}")
    if len(kinds) != 1:
        raise ValueError(f"files at {path} have different formats: {sorted(suffixes)}")
    kind = kinds.pop()
    reader = spark.read if files == [path] else spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    if kind == "csv":
        return reader.option("header", True).option("multiLine", True).option("escape", '"').csv(files)
    if kind == "text":
        return reader.text(files)
    if kind == "json":
        arrays = [f for f in files if _suffix(f) == "json"]
        lines = [f for f in files if _suffix(f) == "jsonl"]
        parts = []
        if arrays:
            parts.append(reader.option("multiLine", True).json(arrays))
        if lines:
            parts.append(reader.option("multiLine", False).json(lines))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return reader.format(kind).load(files)


def read_json_store(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON and JSONL objects below an object-store prefix; other files are ignored."""
    def part(suffix: str, multi: bool) -> DataFrame | None:
        where, fs = _hadoop(spark, path.rstrip("/") + f"/*.{suffix}")
        if not fs.globStatus(where):
            return None
        reader = spark.read.option("pathGlobFilter", f"*.{suffix}").option("multiLine", multi)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.json(path)

    parts = [p for p in (part("json", True), part("jsonl", False)) if p is not None]
    if not parts:
        raise FileNotFoundError(f"no .json or .jsonl below {path}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def read_stream(spark: SparkSession, path: str, schema: StructType | str, kind: str = "json",
                files_per_trigger: int | None = None) -> DataFrame:
    """A stream over a folder, a pattern or one file.

    A file is read as a pattern that only it fits: Spark takes the path of a stream for the base of its partitions, and a file is none.
    """
    where, fs = _hadoop(spark, path)
    if fs.exists(where) and fs.getFileStatus(where).isFile():
        path = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(FORMATS.get(kind, kind)).load(path)


def has_data(spark: SparkSession, path: str) -> bool:
    where, fs = _hadoop(spark, path)
    if not fs.exists(where):
        return False
    return bool(_files(spark, path))


def prepare_or_load(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Load the prepared table when its commit marker is there, else build, save and load it.

    Reading back the written table also cuts lineage for what follows.
    """
    where, fs = _hadoop(spark, path.rstrip("/") + "/_SUCCESS")
    if not fs.exists(where):
        if has_data(spark, path):
            raise ValueError(f"{path} holds an unfinished table")
        build().write.parquet(path)
    return spark.read.parquet(path)
