"""Cases of the fourth round's findings."""

import shutil

import pytest

import __spark_entry__ as entry
from parlance.sources.files import read_stream
from parlance.streaming import streams

QUERIES = entry.queries()


@pytest.fixture(scope="module", params=["file", "parts", "cut by a column"])
def events(request, spark, sf, tmp_path_factory):
    """A folder with the events table as one file, as part files, or with sub-folders that give a column."""
    folder = tmp_path_factory.mktemp("events")
    target = f"{folder}/events.parquet"
    if request.param == "file":
        shutil.copy(f"{sf}/events.parquet", target)
    else:
        write = spark.read.parquet(f"{sf}/events.parquet").repartition(3).write
        (write if request.param == "parts" else write.partitionBy("event_type")).parquet(target)
    return str(folder)


def drained(rows, folder):
    """The rows of a stream, through files."""
    run = rows.writeStream.option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/out").trigger(availableNow=True)
    run.start().awaitTermination()
    return rows.sparkSession.read.parquet(f"{folder}/out")


def test_stream_of_one_file(spark, sf, events, tmp_path):
    """A stream over one file ends with the rows of the table, as one over a folder does; its columns are whole."""
    table = spark.read.parquet(f"{events}/events.parquet")
    got = drained(read_stream(spark, f"{events}/events.parquet", table.schema, "parquet"), tmp_path)
    order = ["event_id", "user_id", "event_type", "value", "props"]
    want = spark.read.parquet(f"{sf}/events.parquet").select(order).collect()
    assert sorted(got.select(order).collect()) == sorted(want) and len(want) >= 1000


def test_monitor_of_streamed_tables(spark, sf, events):
    want = QUERIES["run_status"](spark, sf).collect()
    assert sorted(QUERIES["stream_monitor"](spark, events).collect()) == sorted(want) and len(want) > 10


def test_monitor_rounds_as_sql_does(spark):
    """Percentages next to half a hundredth."""
    import duckdb

    steps = [996350, 497150, 5999250, 5999350, 50, 0, 5, 1000000, *range(100050, 2000000, 12300)]
    logs = spark.createDataFrame([(str(s), s, 1000000) for s in steps], "run string, current_steps long, total_steps long")
    got = {r.current_steps: r.percentage for r in streams.monitor(logs).collect()}
    want = duckdb.sql(f"SELECT s, round(s / 1000000.0 * 100, 2) FROM (SELECT unnest({steps})::BIGINT AS s)").fetchall()
    assert got == dict(want)


def test_split_of_streamed_tables(spark, sf, events):
    """Both parts of a table that is streamed twice, with each row once."""
    import duckdb

    duckdb.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM '{sf}/events.parquet'")
    want = duckdb.sql(entry.oracle_sql()["stream_split"]).fetchall()
    assert sorted(map(tuple, QUERIES["stream_split"](spark, events).collect())) == sorted(want) and len({p for _, p in want}) == 2


def random_sets(rng, n, letters, most):
    """Texts of a few words of their own alphabet each, near copies among them; one in nine of letters that nobody else has."""
    texts = []
    for i in range(n):
        own = letters if i % 9 else [chr(0x4E00 + rng.randrange(3000)) for _ in range(12)]
        words = ["".join(rng.choice(own) for _ in range(3)) for _ in range(4 if most < 100 else 200)]
        copy = list(texts[rng.randrange(i)]) if i and rng.random() < 0.4 else None
        if copy:
            copy[rng.randrange(len(copy))] = rng.choice(letters)
        texts.append("".join(copy or [rng.choice(words) for _ in range(rng.randrange(2, most))]))
    return texts


@pytest.mark.parametrize("most, sizes", [(60, (510, 2040, 8160)), (60, (64, 48, 96)), (400, (64, 48, 96))])
def test_common_grams_first_leave_no_pair_out(monkeypatch, most, sizes):
    """Best similarities and kept rows equal those of all pairs, also for sets of rare grams only and of more than 255."""
    import random

    import numpy as np
    import pyarrow as pa

    from parlance.operators import nearest

    for name, value in zip(("WIDE", "PART", "SLAB"), sizes):
        monkeypatch.setattr(nearest, name, value)
    rng = random.Random(most)
    texts = random_sets(rng, 400, "abcdefghijklmnopqrstuvw", most)
    counts, grams = nearest.text_grams(pa.array(texts), 2, 0)
    all_, n = np.unique(grams, return_counts=True)
    sets = nearest.Sets.of_lists(counts, grams, all_[np.argsort(-n, kind="stable")][:nearest.NAMED])
    own = [set(g.tolist()) for g in np.split(grams, np.cumsum(counts)[:-1])]
    sims = np.array([[len(a & b) / len(a | b) for b in own] for a in own])
    assert (counts.max() > nearest.LARGEST) == (most == 400)
    table = pa.table({
        "_order": list(range(400)), "_id": list(range(400)), "_size": counts, "_bits": [w.tobytes() for w in np.ascontiguousarray(sets.words.T)],
        "_rare": pa.array([sets.rare[sets.rows == i].tolist() for i in range(400)], pa.list_(pa.int64())),
    })
    got = nearest._best_of_block(table, table, True)
    assert np.allclose(got, [sims[i, :i].max(initial=0) for i in range(400)], atol=1e-12)
    assert np.allclose(nearest._best_of_block(table.slice(0, 150), table.slice(150), False), sims[:150, 150:].max(axis=1), atol=1e-12)
    for tau in (0.4, 0.6, 0.7):
        kept = []
        for i in range(400):
            if not (sims[i, kept] >= tau - 1e-12).any():
                kept.append(i)
        assert np.flatnonzero(nearest._decide(sets, tau)).tolist() == kept


def test_each_group_has_bits_for_its_own_grams(spark):
    """Grams common in one group only have a bit there, however many groups there are."""
    from parlance.operators import nearest

    rows = [(f"group {g}", g * 10 + i, g * 10 + i, list(range(g * 1000 + i, g * 1000 + 400 + i))) for g in range(6) for i in range(5)]
    sets = spark.createDataFrame(rows, "_g string, _id long, _order long, _set array<long>").selectExpr("*", "size(_set) AS _size")
    maps = nearest.with_bitmaps(sets, nearest.common_grams(sets)).collect()
    assert len(maps) == 30 and all(len(r._rare) == 0 for r in maps)
    assert all(sum(b.bit_count() for b in r._bits) == 400 for r in maps)
