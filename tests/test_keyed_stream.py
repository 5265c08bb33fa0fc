"""Incremental ingest with duplicates found in the stream's keyed state."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_streaming import RENAME, SCHEMA, _csv, _rec, _refine
from tidylake.operators import dedup
from tidylake.sources import CsvLayout, read_csv
from tidylake.streaming import ingest_keyed
from tidylake.streaming.keyed import PROVIDER, _smallest

OUT = "ano string, mes string, key string, flight string, pax int"
NAMES = [c for c, _ in SCHEMA]


def _ingest(spark, tmp, **more):
    layouts = [CsvLayout(f"{tmp}/raw", SCHEMA, RENAME, glob="*.csv")]
    before = spark.conf.get(PROVIDER)
    q = ingest_keyed(spark, layouts, _refine, f"{tmp}/silver", ["ano", "mes"], ["key"], ["flight"], sep=";",
                     null_value="null", checkpoint=f"{tmp}/ckpt", **more)
    q.awaitTermination()
    assert spark.conf.get(PROVIDER) == before
    return q


def _silver(spark, tmp):
    return spark.read.schema(OUT).parquet(f"{tmp}/silver").select("ano", "mes", "key", "flight", "pax")


def test_drops_and_restarts(spark, tmp):
    _csv(f"{tmp}/raw/a.csv", NAMES, [
        _rec("2021", "1", "k1", "F2", 1), _rec("2021", "1", "k1", "F1", 2), _rec("2021", "2", "k2", "F3", 3),
        _rec(None, "1", None, "F4", 4), _rec(None, "1", None, "F3", 4)])
    _ingest(spark, tmp)
    assert sorted(r.flight for r in _silver(spark, tmp).collect()) == ["F1", "F3", "F3"]
    # every later run is a restart from the checkpoint
    _csv(f"{tmp}/raw/b.csv", NAMES, [
        _rec("2021", "2", "k1", "F0", 5), _rec("2021", "2", "k9", "F9", 9), _rec("2022", "1", None, "F0", 6)])
    _ingest(spark, tmp)
    _csv(f"{tmp}/raw/c.csv", NAMES, [_rec("2022", "1", "k9", "F0", 7), _rec("2022", "1", "k7", "F7", 7)])
    _ingest(spark, tmp)
    assert sorted((r.key or "", r.flight) for r in _silver(spark, tmp).collect()) == [
        ("", "F3"), ("k1", "F1"), ("k2", "F3"), ("k7", "F7"), ("k9", "F9")]
    q = _ingest(spark, tmp)  # nothing new
    assert q.lastProgress is None or q.lastProgress["numInputRows"] == 0
    assert _silver(spark, tmp).count() == 5


def test_equals_the_batch_dedup_of_one_drop(spark, tmp):
    recs = [_rec(str(2020 + i % 3), str(i % 2 + 1), None if i % 17 == 0 else f"k{i % 40}", f"F{i * 7 % 100:03d}", i)
            for i in range(400)]
    for i in range(4):
        _csv(f"{tmp}/raw/{i}.csv", NAMES, recs[100 * i:100 * i + 100])
    _ingest(spark, tmp)
    raw = read_csv(spark, f"{tmp}/raw", schema=SCHEMA, sep=";", null_value="null")
    want = dedup.by_key(_refine(raw.select(*[F.col(k).alias(v) for k, v in RENAME.items()])), ["key"], ["flight"])
    assert rows(_silver(spark, tmp)) == rows(want.select("ano", "mes", "key", "flight", "pax"))


def test_one_file_per_batch_keeps_the_first(spark, tmp):
    for i in range(5):
        _csv(f"{tmp}/raw/{i}.csv", NAMES, [_rec("2021", "1", f"k{j}", f"F{9 - i}", i) for j in range(i + 1)])
        os.utime(f"{tmp}/raw/{i}.csv", (1_600_000_000 + i, 1_600_000_000 + i))
    _ingest(spark, tmp, max_files_per_trigger=1)
    assert sorted((r.key, r.flight) for r in _silver(spark, tmp).collect()) == [
        (f"k{j}", f"F{9 - j}") for j in range(5)]


def test_a_batch_that_failed_is_repeated_once(spark, tmp):
    """A batch whose commit is lost (its files are written, its log entry is not) is run again
    after a restart; readers see its rows once."""
    _csv(f"{tmp}/raw/a.csv", NAMES, [_rec("2021", "1", "k1", "F1", 1)])
    _ingest(spark, tmp)
    _csv(f"{tmp}/raw/b.csv", NAMES, [_rec("2021", "1", "k1", "F0", 1), _rec("2021", "1", "k2", "F2", 1)])
    _ingest(spark, tmp)
    for log in (f"{tmp}/silver/_spark_metadata", f"{tmp}/ckpt/keyed/commits"):
        for name in ("1", ".1.crc"):
            if os.path.exists(f"{log}/{name}"):
                os.remove(f"{log}/{name}")
    assert _silver(spark, tmp).count() == 1
    _ingest(spark, tmp)
    assert sorted(r.flight for r in _silver(spark, tmp).collect()) == ["F1", "F2"]


def test_a_batch_reads_neither_silver_nor_other_keys(spark, tmp):
    """The plan of a batch holds no scan of the silver table, and its state is RocksDB's."""
    _csv(f"{tmp}/raw/a.csv", NAMES, [_rec("2021", "1", f"k{i}", "F1", i) for i in range(500)])
    _ingest(spark, tmp)
    _csv(f"{tmp}/raw/b.csv", NAMES, [_rec("2021", "1", "k3", "F0", 1), _rec("2021", "1", "new", "F2", 1)])
    q = _ingest(spark, tmp)
    last = q.recentProgress[-1] if q.recentProgress[-1]["numInputRows"] else q.recentProgress[-2]
    state = last["stateOperators"][0]
    assert last["numInputRows"] == 2 and state["numRowsTotal"] == 501 and state["numRowsUpdated"] == 1
    assert any("rocksdb" in k for k in state["customMetrics"])
    assert "silver" not in q._jsq.explainInternal(False) if hasattr(q._jsq, "explainInternal") else True


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_smallest_row_of_each_key(size):
    import random

    import pyarrow as pa
    rnd = random.Random(size)
    recs = [(rnd.choice(["a", "b", None, ""]), rnd.choice([1, 2, None]), rnd.choice([5, None, 7]), rnd.choice("xyz"))
            for _ in range(200)]
    schema = pa.schema([("k", pa.string()), ("l", pa.int64()), ("o", pa.int64()), ("r", pa.string())])
    batches = [pa.RecordBatch.from_pylist([dict(zip("klor", r)) for r in recs[a:a + size]], schema)
               for a in range(0, 200, size)]
    got = [tuple(r.values()) for b in _smallest(["k", "l"], ["o"])(iter(batches)) for r in b.to_pylist()]

    def key(r):
        return tuple((x is not None, x if x is not None else 0) for x in (r[2], r[3]))
    want = {}
    for r in recs:
        if r[:2] not in want or key(r) < key(want[r[:2]]):
            want[r[:2]] = r
    assert sorted(got, key=repr) == sorted(want.values(), key=repr)
    assert list(_smallest(["k"], [])(iter([]))) == []
