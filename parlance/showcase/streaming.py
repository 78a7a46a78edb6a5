"""Streaming forms, run to completion over the folder's files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from parlance import adapters as A
from parlance.session import ensure_checkpoint_dir
from parlance.showcase import draw_of, query
from parlance.sources.files import read_stream
from parlance.streaming import streams


def _stream(spark, sf: str, name: str):
    """One table as a file stream: a file, or a folder of part files."""
    path = f"{sf}/{name}.parquet"
    return read_stream(spark, path, spark.read.parquet(path).schema, "parquet")


def _drain(spark, frame, mode: str):
    """All available files, written batch by batch to a table in the shared folder and read back."""
    target = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"

    def put(batch, number: int) -> None:
        # a batch played again overwrites its own folder
        folder = f"{target}/table" if mode == "complete" else f"{target}/table/batch={number}"
        batch.write.mode("overwrite").parquet(folder)

    empty = spark.createDataFrame([], frame.schema)
    empty.write.parquet(f"{target}/table" if mode == "complete" else f"{target}/table/batch=-1")  # a stream without rows has no batch
    run = frame.writeStream.outputMode(mode).option("checkpointLocation", f"{target}/state").foreachBatch(put)
    run.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{target}/table").drop("batch")


@query("""SELECT conv_id, turn, text AS answer FROM conversations WHERE role = 'assistant' AND length(text) > 0""")
def stream_alignment(spark, sf):
    """Single-answer rows aligned and filtered on a stream."""
    from parlance.model import DatasetSpec

    rows = _stream(spark, sf, "conversations").where("role = 'assistant'").select(
        "conv_id", "turn", F.lit("go on").alias("instruction"), F.col("text").alias("output")
    )
    out = streams.align_stream(rows, DatasetSpec(query=None), keep=["conv_id", "turn"])
    return _drain(spark, out.select("conv_id", "turn", F.get("_response", F.lit(0))["content"].alias("answer")), "append")


@query(f"""SELECT event_id, CASE WHEN {draw_of("'11'", 'event_id')} / 4294967296.0 < 0.2 THEN 'validation' ELSE 'train' END AS part FROM events""")
def stream_split(spark, sf):
    train, val = streams.split_stream(_stream(spark, sf, "events"), 0.2, "event_id", 11)
    parts = [_drain(spark, f.select("event_id", F.lit(p).alias("part")), "append") for f, p in ((train, "train"), (val, "validation"))]
    return parts[0].unionByName(parts[1])


@query("""SELECT user_id::VARCHAR AS run, max(event_id) AS current_steps, max_by(value, event_id) AS loss, round(max(event_id) / 1000000.0 * 100, 2) AS percentage FROM events GROUP BY 1""")
def stream_monitor(spark, sf):
    logs = _stream(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("run"), F.col("event_id").alias("current_steps"),
        F.lit(1000000).cast("long").alias("total_steps"), F.col("value").alias("loss"),
    )
    return _drain(spark, streams.monitor(logs).select("run", "current_steps", "loss", "percentage"), "complete")


@query("""SELECT user_id::VARCHAR AS run, max(event_id) AS current_steps, max_by(value, event_id) AS loss, round(max(event_id) / 1000000.0 * 100, 2) AS percentage FROM events GROUP BY 1""")
def run_status(spark, sf):
    return streams.monitor(A.run_log(spark, sf)).select("run", "current_steps", "loss", "percentage")
