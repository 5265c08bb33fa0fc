"""Re-runs by a ledger of files and partitions."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidylake.plans import ledger
from tidylake.plans.layers import changed_only, refine_fact
from tidylake.sources import read_mixed
from tidylake.sources.parquet import read_parquet

SCHEMA = "K int, V string, P string, Q string"
YEARS = [str(y) for y in range(2018, 2024)]
SILVER = "K int, V string, P string, Q string"
PARTS = ["P", "Q"]


def _write(path, records, names=("K", "V", "P", "Q")):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(";".join(names) + "\n")
        for r in records:
            cells = dict(zip("KVPQ", r))
            fh.write(";".join("null" if cells[c] is None else str(cells[c]) for c in names) + "\n")


def _read(spark):
    return lambda paths: refine_fact(
        read_mixed(spark, paths, SCHEMA, sep=";", null_value="null", file="f"), fills=[("none", ["P"])])


def _run(spark, base, only=None, table="silver", folders=YEARS):
    return ledger.run(spark, f"{base}/{table}", f"{base}/{table}-ledger",
                      {y: f"{base}/raw/{y}" for y in folders}, _read(spark), PARTS, ["K"], ["V"],
                      only=only, file="f")


def _table(spark, base, table="silver"):
    return rows(read_parquet(spark, f"{base}/{table}", schema=SILVER))


@pytest.fixture()
def lake(tmp):
    """Six years; every year feeds its own partitions, some share one, one has no P, one
    partition value needs escaping, and years have files in two layouts."""
    for i, y in enumerate(YEARS):
        _write(f"{tmp}/raw/{y}/a.csv", [(100 * i + j, f"v{j}", y, f"m{j % 3}") for j in range(12)])
        _write(f"{tmp}/raw/{y}/b [x].csv", [(100 * i + j, f"u{j}", y, f"m{j % 3}") for j in range(6, 15)],
               ("Q", "P", "V", "K"))
    _write(f"{tmp}/raw/2019/late.csv", [(1, "late", "2018", "m1"), (900, "x", "2018", "m0"), (901, None, None, "a/b=c")])
    _write(f"{tmp}/raw/2022/lone.csv", [(950, "only", "1900", "gone")])
    return tmp


def test_full_run_and_ledger(spark, lake):
    done = _run(spark, lake)
    found = ledger.entries(spark, f"{lake}/silver-ledger")
    assert found.columns == ["file", "P", "Q", "rows", "source"]
    assert found.agg(F.sum("rows")).first()[0] == 6 * 21 + 4
    assert {r.source for r in found.collect()} == set(YEARS)
    assert done.rows == len(_table(spark, lake)) == 6 * 15 + 3  # K = 1 twice, in one partition


def test_one_year_reads_only_the_files_needed(spark, lake):
    _run(spark, lake)
    done = _run(spark, lake, ["2020"])
    assert {f.split("/raw/")[1][:4] for f in done.files} == {"2020"} and len(done.files) == 2
    done = _run(spark, lake, ["2018"])
    # files of other years only where they feed a partition of 2018
    assert sorted(f.split("/raw/")[1].replace("\\", "") for f in done.files) == [
        "2018/a.csv", "2018/b [x].csv", "2019/late.csv"]


@pytest.mark.parametrize("change", ["disappears", "moves", "new_file", "year_goes"])
def test_rerun_equals_a_full_run(spark, lake, change):
    _run(spark, lake)
    only = ["2022"]
    if change == "disappears":
        os.remove(f"{lake}/raw/2022/lone.csv")
    elif change == "moves":  # rows now feed another year's partition, with a smaller duplicate
        _write(f"{lake}/raw/2022/lone.csv", [(950, "only", "2020", "m0"), (200, "a", "2020", "m0")])
    elif change == "new_file":
        _write(f"{lake}/raw/2018/new.csv", [(960, "n", "2018", "m9"), (961, "n", "2021", "m0")])
        only = ["2018"]
    elif change == "year_goes":
        shutil.rmtree(f"{lake}/raw/2019")
        only = ["2019"]
    done = _run(spark, lake, only)
    _run(spark, lake, table="full")
    assert _table(spark, lake) == _table(spark, lake, "full")
    assert rows(ledger.entries(spark, f"{lake}/silver-ledger")) == rows(
        ledger.entries(spark, f"{lake}/full-ledger"))
    if change == "disappears":
        assert not os.path.exists(f"{lake}/silver/P=1900/Q=gone")
        assert ("1900", "gone") in rows(done.changed)
    if change == "year_goes":
        assert not os.path.exists(f"{lake}/silver-ledger/source=2019")
    # a run that is repeated changes nothing
    _run(spark, lake, only)
    assert _table(spark, lake) == _table(spark, lake, "full")


def test_a_run_that_broke_off_is_made_good(spark, lake, monkeypatch):
    _run(spark, lake)
    os.remove(f"{lake}/raw/2022/lone.csv")
    _write(f"{lake}/raw/2022/a.csv", [(5, "z", "2022", "m0")])

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(ledger, "record", broken)
        with pytest.raises(RuntimeError):
            _run(spark, lake, ["2022"])
    _run(spark, lake, ["2022"])
    _run(spark, lake, table="full")
    assert _table(spark, lake) == _table(spark, lake, "full")


def test_changes_prune_gold_at_run_time(spark, lake):
    _run(spark, lake)
    os.remove(f"{lake}/raw/2022/lone.csv")
    done = _run(spark, lake, ["2022"])
    for name, part in (("one", done.changed), ("two", done.changed.limit(1))):
        ledger.log_changes(name, part, f"{lake}/changes")
    changed = spark.read.parquet(f"{lake}/changes").where(F.col("run") == "one")
    silver = read_parquet(spark, f"{lake}/silver", schema=SILVER)
    touched = changed_only(silver, changed, PARTS)
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert {r.P for r in touched.collect()} == {"2022"}
    assert touched.count() == silver.where("P = '2022'").count()


def test_movement_flow_with_a_ledger(spark, tmp):
    from tests.test_airport_flows import FIELDS, _csv, _move  # generated raw files
    from tidylake.plans import airport
    years = ["2021", "2022"]
    _csv(f"{tmp}/raw/2021/a.csv", FIELDS, [_move(i, MES=str(i % 3)) for i in range(9)])
    _csv(f"{tmp}/raw/2021/notes.txt", FIELDS, [_move(50)])
    _csv(f"{tmp}/raw/2022/b.csv", airport.MOVEMENT_VARIANT_ORDER, [
        _move(20, ANO="2022", MES="7"), _move(21, ANO="2021", MES="1"), _move(0, MES="0", NR_VOO_NUMERO="1")])
    args = dict(ledger=f"{tmp}/ledger", changes=("first", f"{tmp}/changes"))
    n = airport.movements_to_silver(spark, f"{tmp}/raw", f"{tmp}/silver/movements", years, **args)
    assert n == read_parquet(spark, f"{tmp}/silver/movements", airport.silver_movement_schema()).count() > 0
    args["changes"] = ("second", f"{tmp}/changes")
    again = airport.movements_to_silver(spark, f"{tmp}/raw", f"{tmp}/silver/movements", years[:1], dynamic=True,
                                        all_years=years, **args)
    assert 0 < again < n
    silver = read_parquet(spark, f"{tmp}/silver/movements", airport.silver_movement_schema())
    assert silver.count() == n == 11
    # a row of 2022's folder beats its duplicate in 2021's
    assert "1" in {r.numero_voo for r in silver.collect()}
    logged = spark.read.parquet(f"{tmp}/changes")
    assert {r.run for r in logged.collect()} == {"first", "second"}
