import os

from pyspark.sql import functions as F

from tests.conftest import rows
from tidylake.operators import dedup
from tidylake.plans.layers import LabelRule, refine_fact
from tidylake.sources import CsvLayout, read_csv
from tidylake.streaming import ingest_to_silver

SCHEMA = [("ANO", "string"), ("MES", "string"), ("KEY", "string"), ("FLIGHT", "string"),
          ("PAX", "int")]
ODD = ["PAX", "FLIGHT", "KEY", "MES", "ANO"]
RENAME = {"ANO": "ano", "MES": "mes", "KEY": "key", "FLIGHT": "flight", "PAX": "pax"}
MONTHS = {1: "Janeiro", 2: "Fevereiro"}


def _csv(path, order, recs):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(";".join(order) + "\n")
        for r in recs:
            fh.write(";".join("null" if r[c] is None else str(r[c]) for c in order) + "\n")


def _rec(ano, mes, key, flight, pax):
    return dict(ANO=ano, MES=mes, KEY=key, FLIGHT=flight, PAX=pax)


def _refine(df):
    return refine_fact(df, fills=[("Ano não informado", ["ano"])],
                       labels=[LabelRule("mes", MONTHS, "?", key_type="int")])


def test_incremental_ingest_equals_batch(spark, tmp):
    raw = f"{tmp}/raw"
    out = f"{tmp}/silver"
    layouts = [CsvLayout(f"{raw}/main", SCHEMA, RENAME, glob="*.csv"),
               CsvLayout(f"{raw}/odd", [(c, dict(SCHEMA)[c]) for c in ODD],
                         RENAME, glob="*.csv")]
    _csv(f"{raw}/main/a.csv", [c for c, _ in SCHEMA],
         [_rec("2021", "1", "k1", "F2", 1), _rec("2021", "1", "k1", "F1", 2),
          _rec("2021", "2", "k2", "F3", 3), _rec(None, "1", None, "F4", 4)])
    os.makedirs(f"{raw}/odd", exist_ok=True)
    ckpt = f"{tmp}/ckpt"
    q = ingest_to_silver(spark, layouts, _refine, out, ["ano", "mes"], ["key"], ["flight"],
                         sep=";", null_value="null", checkpoint=ckpt)
    q.awaitTermination()
    first = spark.read.schema("ano string, mes string, key string, flight string, pax int") \
        .parquet(out)
    assert sorted(r.flight for r in first.collect()) == ["F1", "F3", "F4"]

    # second drop: a key seen before (in another month) wins with a smaller flight,
    # a new key, another null key, and a file in the odd layout
    _csv(f"{raw}/main/b.csv", [c for c, _ in SCHEMA],
         [_rec("2021", "2", "k1", "F0", 5), _rec("2021", "2", "k9", "F9", 9),
          _rec("2022", "1", None, "F5", 6)])
    _csv(f"{raw}/odd/c.csv", ODD, [_rec("2022", "1", "k7", "F7", 7)])
    q = ingest_to_silver(spark, layouts, _refine, out, ["ano", "mes"], ["key"], ["flight"],
                         sep=";", null_value="null", checkpoint=ckpt)
    q.awaitTermination()

    got = spark.read.schema("ano string, mes string, key string, flight string, pax int") \
        .parquet(out).select("ano", "mes", "key", "flight", "pax")
    # expected: first drop deduplicated, then the second drop's new keys only
    first_drop = dedup.by_key(_refine(_first_drop(spark, raw)), ["key"], ["flight"])
    assert rows(got.where(F.col("key") == "k1").select("flight")) == [("F1",)]  # first wins
    assert rows(got.where(F.col("key").isNull()).select("flight")) == [("F4",)]
    assert sorted(r.key for r in got.where(F.col("key").isNotNull()).collect()) == \
        ["k1", "k2", "k7", "k9"]
    assert got.count() == 5
    assert first_drop.count() == 3
    # idempotent: a re-run with no new files adds nothing
    q = ingest_to_silver(spark, layouts, _refine, out, ["ano", "mes"], ["key"], ["flight"],
                         sep=";", null_value="null", checkpoint=ckpt)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 5


def _first_drop(spark, raw):
    df = read_csv(spark, f"{raw}/main/a.csv", schema=SCHEMA, sep=";", null_value="null")
    return df.select(*[F.col(k).alias(v) for k, v in RENAME.items()])
