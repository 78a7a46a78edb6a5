"""Web archives with a two-level capture index.

Records are compressed one by one into archive files. Captures are sorted by a key that starts with the reversed host
and cut into compressed blocks; a sparse directory names the first key of each block, and one more, of one entry per
index partition, tells which partition to look in. A lookup binary-searches both, opens one block, binary-searches it
and then reads only the record's bytes from the archive.

Archives are written by the tasks into the shared folder, under names of their own for each attempt. Only files
named by the committed capture table count, so a lost executor or a second attempt leaves at most an unused file.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.tables import saved, shared_path

FILE_BYTES = 128 << 20
BLOCK_LINES = 1000
READ_BYTES = 4 << 20
MAX_PARTS = 4096
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"


def url_key(url: str | None) -> str:
    """Host labels reversed, then the rest: http://a.b.c:80/x?y -> c,b,a)/x?y. Scheme, user and default ports go."""
    text = (url or "").strip()
    scheme, mark, rest = text.partition("://")
    if not mark:
        scheme, rest = "", text
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, path = rest[:cut].rpartition("@")[2].lower(), rest[cut:].partition("#")[0]
    name, colon, port = host.rpartition(":")
    if colon and port.isdigit():
        host = name if (scheme.lower(), port) in (("http", "80"), ("https", "443")) else host
    return ",".join(reversed(host.split("."))) + ")" + (path or "/")


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def record(identity: str, url: str | None, digest: str, payload: bytes | None, refers_to: str | None) -> bytes:
    """One compressed record: a response with its payload, or a revisit of ``refers_to``."""
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head += [f"WARC-Target-URI: {target}", f"WARC-Date: {DATE}", f"WARC-Record-ID: <urn:page:{identity}>",
             f"WARC-Payload-Digest: sha256:{digest}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload if refers_to is None else b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
    raw = "WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n"
    return pack.compress(raw.encode("utf-8", "surrogateescape")) + pack.compress(body) + pack.compress(b"\r\n\r\n") + pack.flush()


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one compressed record."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogateescape").split("\r\n")[1:])
    body = rest[:int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


def write_archives(df: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
                   least: int = 100) -> DataFrame:
    """Writes one record per row and returns the captures: urlkey, id, file, start, length.

    Of rows with equal payloads of at least ``least`` bytes the smallest id is the response, the others are revisits;
    null ids come last. The payload is the text in UTF-8, a null text an empty one.
    """
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = df.select(F.col(key).alias("id"), F.col(url).alias("url"), payload.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )
    same = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n")
    ).where("n > 1 AND first IS NOT NULL").select("digest", "first")
    told = rows.join(same, "digest", "left").select(
        F.col("id").cast("string").alias("id"), "url", "digest",
        F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first").cast("string")).alias("refers_to"), "payload",
    ).withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        store.create_dir(path, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, files, starts, lengths = [], [], [], []
            for i in range(batch.num_rows):
                if out is None:
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                id_, url_, digest, refers, body = (batch.column(c)[i].as_py() for c in range(5))
                data = record("" if id_ is None else id_, url_, digest, body, refers)
                out.write(data)
                keys.append(url_key(url_))
                files.append(name)
                starts.append(at)
                lengths.append(len(data))
                at += len(data)
                if at >= FILE_BYTES:
                    out.close()
                    out = None
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), batch.column(0), pa.array(files), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())],
                names=["urlkey", "id", "file", "start", "length"],
            )
        if out is not None:
            out.close()

    return saved(told.mapInArrow(run, "urlkey string, id string, file string, start long, length long"), "captures")


def build_index(captures: DataFrame) -> DataFrame:
    """(part, first, last, block): sorted captures in compressed blocks; parts follow the order of keys."""
    parts = min(MAX_PARTS, int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = captures.repartitionByRange(parts, "urlkey", "id", "file", "start").sortWithinPartitions(
        "urlkey", "id", "file", "start"
    ).withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        keys: list[str] = []
        part = 0
        for batch in batches:
            for row in batch.to_pylist():
                part = row.pop("part")
                keys.append(row.pop("urlkey"))
                held.append(json.dumps(row))
                if len(held) == BLOCK_LINES:
                    yield _block(part, keys, held)
                    held, keys = [], []
        if held:
            yield _block(part, keys, held)

    return saved(placed.mapInArrow(run, "part int, first string, last string, block binary"), "index")


def _block(part: int, keys: list[str], lines: list[str]) -> pa.RecordBatch:
    data = zlib.compress(json.dumps([keys, lines]).encode(), 6)
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([keys[0]]), pa.array([keys[-1]]), pa.array([data], pa.binary())],
        names=["part", "first", "last", "block"],
    )


def lookup(index: DataFrame, urls: DataFrame) -> DataFrame:
    """Captures (urlkey, id, file, start, length) of the distinct ``url`` values; one row per capture."""
    spans = index.groupBy("part").agg(F.min("first").alias("first"), F.max("last").alias("last")).orderBy("part").collect()
    parts, firsts, lasts = ([r[c] for r in spans] for c in ("part", "first", "last"))  # MAX_PARTS entries at most

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, to = [], []
            for url in batch.column(0).to_pylist():
                k = url_key(url)
                for p in range(bisect_left(lasts, k), bisect_right(firsts, k)):
                    keys.append(k)
                    to.append(parts[p])
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(keys, pa.string())], names=["part", "urlkey"])

    def search(blocks: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values(["first", "last"]).reset_index(drop=True)
        starts, ends = blocks["first"].tolist(), blocks["last"].tolist()
        opened: dict[int, tuple[list[str], list[str]]] = {}
        out = []
        for k in sorted(set(wanted["urlkey"])):
            for b in range(bisect_left(ends, k), bisect_right(starts, k)):
                if b not in opened:
                    opened = {b: json.loads(zlib.decompress(blocks["block"][b]))}
                keys, lines = opened[b]
                for i in range(bisect_left(keys, k), bisect_right(keys, k)):
                    out.append((k, *(json.loads(lines[i])[c] for c in ("id", "file", "start", "length"))))
        return pd.DataFrame(out, columns=["urlkey", "id", "file", "start", "length"])

    routed = urls.select("url").distinct().mapInArrow(route, "part int, urlkey string").distinct()
    return index.groupBy("part").cogroup(routed.groupBy("part")).applyInPandas(
        search, "urlkey string, id string, file string, start long, length long"
    )


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """(id, type, refers_to, payload_bytes, payload_digest) read from the captures' bytes alone, nearby ones at once.

    The digest is computed from the payload; for revisits it is the one in the record, and payload_bytes is null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        name, source = None, None
        for batch in batches:
            rows = batch.to_pylist()
            ids, types, refers, sizes, digests = [], [], [], [], []
            at = 0
            while at < len(rows):
                first, stop = rows[at], at + 1
                end = first["start"] + first["length"]
                while (stop < len(rows) and rows[stop]["file"] == first["file"] and rows[stop]["start"] == end
                       and end - first["start"] < READ_BYTES):
                    end += rows[stop]["length"]
                    stop += 1
                if first["file"] != name:
                    name, source = first["file"], store.open_input_file(f"{path}/{first['file']}")
                data = source.read_at(end - first["start"], first["start"])
                for row in rows[at:stop]:
                    start = row["start"] - first["start"]
                    fields, payload = parse(data[start:start + row["length"]])
                    response = fields["WARC-Type"] == "response"
                    ids.append(row["id"])
                    types.append(fields["WARC-Type"])
                    refers.append(None if response else fields["WARC-Refers-To"][len("<urn:page:"):-1])
                    sizes.append(len(payload) if response else None)
                    digests.append(hashlib.sha256(payload).hexdigest() if response else fields["WARC-Payload-Digest"][7:])
                at = stop
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(types, pa.string()), pa.array(refers, pa.string()),
                 pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
                names=["id", "type", "refers_to", "payload_bytes", "payload_digest"],
            )

    tasks = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # rows are small, their records are not
    near = captures.repartition(tasks, "file").sortWithinPartitions("file", "start")
    return near.select("id", "file", "start", "length").mapInArrow(
        run, "id string, type string, refers_to string, payload_bytes long, payload_digest string"
    )


def round_trip(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 100) -> DataFrame:
    """Writes all rows to archives, indexes them, looks every url up and reads the records back.

    One row per row of ``df``: key, payload_bytes, payload_digest, record_type, refers_to. A revisit's size comes from
    the response it refers to. Rows with the smallest id and the same payload are all responses; a null id or url is kept
    and comes back null. Other columns are not read. Empty table: empty result.
    """
    spark = df.sparkSession
    folder = shared_path(spark, "warc")
    captures = write_archives(df, folder, key, url, html, least)
    found = lookup(build_index(captures), df.select(F.col(url).alias("url")))
    read = saved(read_records(found, folder), "records")
    kind = dict(df.dtypes)[key]
    whole = read.where("type = 'response'")
    sizes = read.where("type = 'revisit'").select(F.col("refers_to").alias("id")).distinct().join(
        whole.select("id", "payload_bytes"), "id"
    ).groupBy("id").agg(F.max("payload_bytes").alias("payload_bytes"))
    again = read.where("type = 'revisit'").drop("payload_bytes").join(sizes.withColumnRenamed("id", "refers_to"), "refers_to")
    return whole.unionByName(again).select(
        F.col("id").cast(kind).alias(key), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
