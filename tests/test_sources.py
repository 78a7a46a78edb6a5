import json

import pytest
from pyspark.sql import functions as F

from parlance.model import DatasetSpec
from parlance.sources import catalog, files, sinks
from parlance.streaming import streams


def test_read_files_by_suffix(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.json").write_text('[{"k": 1},\n {"k": 2}]')
    (tmp_path / "a" / "y.jsonl").write_text('{"k": 3}\n{"k": 4}\n')
    assert sorted(r["k"] for r in files.read_files(spark, str(tmp_path / "a")).collect()) == [1, 2, 3, 4]
    (tmp_path / "a" / "z.txt").write_text("note")
    with pytest.raises(ValueError):
        files.read_files(spark, str(tmp_path / "a"))
    assert files.read_json_store(spark, str(tmp_path / "a")).count() == 4
    (tmp_path / "t.csv").write_text("k,t\n1,hello\n")
    assert files.read_files(spark, str(tmp_path / "t.csv")).collect()[0]["t"] == "hello"


def test_catalog_load_and_reuse(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps([{"instruction": f"q{i}", "input": "", "output": f"a{i}"} for i in range(5)]))
    entries = {"d": {"file_name": "d.json", "num_samples": 8}}
    rows = catalog.load(spark, entries, "d", "sft", str(tmp_path)).collect()
    assert len(rows) == 8 and {r["_response"][0]["content"] for r in rows} == {f"a{i}" for i in range(5)}
    more = {"size": 4, "weight": 1.5, "converter": "alpaca"}
    assert catalog.load(spark, {"d": {"file_name": "d.json", **more}}, "d", "sft", str(tmp_path)).count() == 6
    assert catalog.load(spark, entries, "d", "sft", str(tmp_path), max_samples=3).count() == 3
    for bad in ({"split": "test"}, {"streaming": True}, {"subset": "a"}, {"sise": 4}):
        with pytest.raises(ValueError):
            catalog.load(spark, {"d": {"file_name": "d.json", **bad}}, "d", "sft", str(tmp_path))
    spark.range(6).selectExpr("id", "id % 2 AS part").write.partitionBy("part").parquet(str(tmp_path / "deep" / "p"))
    assert {(r["id"], r["part"]) for r in files.read_files(spark, str(tmp_path / "deep" / "p")).collect()} == {(i, i % 2) for i in range(6)}
    target, calls = str(tmp_path / "ready"), []

    def build():
        calls.append(1)
        return spark.range(3)

    assert files.prepare_or_load(spark, target, build).count() == 3 and files.prepare_or_load(spark, target, build).count() == 3
    assert len(calls) == 1


def test_exports_and_release(spark, tmp_path):
    turns = "array<struct<role string,content string>>"
    df = spark.createDataFrame([([("user", "a")], [("assistant", "b")], "", ""), ([], [], "", "")],
                               f"_prompt {turns}, _response {turns}, _system string, _tools string")
    sinks.export_jsonl(df, str(tmp_path / "m"))
    line = next(json.loads(x) for p in (tmp_path / "m").glob("part*") for x in p.read_text().splitlines() if x)
    assert line == {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}
    rows = spark.range(20).select("id", (F.col("id") % 3 + 1).alias("level"), F.array(*[
        F.struct(F.lit(r).alias("role"), F.col("id").cast("string").alias("content")) for r in ("system", "user", "assistant")
    ]).alias("messages"))
    one = sinks.release(rows, str(tmp_path / "r1"), "1.2", 7, "id", 4)
    two = sinks.release(rows.repartition(5), str(tmp_path / "r2"), "1.2", 7, "id", 4)
    assert one.rsplit("/", 1)[1] == two.rsplit("/", 1)[1]
    assert spark.read.json(f"{one}/validation").count() == 4 and spark.read.json(f"{one}/train").count() == 16


def test_stream_equals_batch(spark, tmp_path):
    from parlance.operators.align import align
    from parlance.operators.checks import drop_invalid

    src = tmp_path / "in"
    spark.createDataFrame([(i, f"q{i}", None if i % 3 == 0 else f"a{i}") for i in range(30)], "id long, instruction string, output string").repartition(3).write.json(str(src))
    spec = DatasetSpec(query=None)
    schema = "id long, instruction string, output string"
    stream = streams.align_stream(files.read_stream(spark, str(src), schema, files_per_trigger=1), spec, keep=["id"])
    out = str(tmp_path / "out")
    stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).option("path", out).trigger(availableNow=True).start().awaitTermination()
    batch = drop_invalid(align(spark.read.schema(schema).json(str(src)), spec, ["id"]), "sft")
    key = lambda d: sorted((r["id"], r["_response"][0]["content"]) for r in d.collect())
    assert key(spark.read.parquet(out)) == key(batch) and len(key(batch)) == 20


def test_content_digest(spark):
    """The same for any order and partitioning; another for any changed, added or missing row, and for swapped values."""
    rows = [(i, f"text {i % 90}", None if i % 5 else "x") for i in range(400)]

    def digest(rows, parts=3, digits=4):
        df = spark.createDataFrame(rows, "k long, t string, n string").select(F.struct("k", "t", "n").alias("messages"))
        return sinks.content_digest(df.repartition(parts), digits=digits).first()["digest"]

    base = digest(rows)
    assert digest(rows[::-1], 7) == base and digest(rows, 1) == base
    swapped = [(0, rows[1][1], rows[0][2]), (1, rows[0][1], rows[1][2]), *rows[2:]]
    others = [rows[1:], [*rows, rows[0]], [(0, "text 0", ""), *rows[1:]], swapped, [*rows, rows[0], rows[0]]]
    found = [digest(r) for r in others]
    assert len({base, *found}) == 1 + len(others)
    assert digest(rows, 5, 3) == digest(rows, 2, 3) != base and len(digest([])) == 64
