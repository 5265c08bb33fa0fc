"""End-to-end airport-movement flows on small generated raw files."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidylake.plans import airport
from tidylake.sources import read_parquet

ZW = "\u200b"
FIELDS = [n for n, _ in airport.MOVEMENT_FIELDS]


def _csv(path, order, records, sep=";"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    lines = [sep.join(order)]
    for rec in records:
        lines.append(sep.join("null" if rec.get(c) is None else str(rec[c]) for c in order))
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def _move(i, **kw):
    rec = {c: None for c in FIELDS}
    rec.update(ANO="2021", MES="1", NR_AEROPORTO_REFERENCIA="SBGR", NR_MOVIMENTO_TIPO="D",
               NR_AERONAVE_MARCAS=f"PR-{i:03d}", NR_VOO_OUTRO_AEROPORTO=f"SBRJ{ZW}",
               NR_VOO_NUMERO=str(1000 + i), NR_SERVICE_TYPE=f"{ZW}J ", NR_NATUREZA="D",
               DT_PREVISTO=f"2021-01-{i % 28 + 1:02d}", HH_PREVISTO="10:00",
               DT_CALCO=f"2021-01-{i % 28 + 1:02d}", HH_CALCO="10:05",
               DT_TOQUE=f"2021-01-{i % 28 + 1:02d}", HH_TOQUE="10:40", QT_PAX_LOCAL=i)
    rec.update(kw)
    return rec


@pytest.fixture()
def lake(spark, tmp):
    raw = f"{tmp}/raw"
    default = [
        _move(1),                                              # domestic, 40 min late
        _move(2, MES="01", NR_NATUREZA="I", HH_TOQUE="10:59"),  # international, 59 min
        _move(3, MES="12", NR_MOVIMENTO_TIPO="P", HH_TOQUE="11:00", NR_NATUREZA="I"),
        _move(4, MES="13", NR_MOVIMENTO_TIPO="X"),
        _move(5, MES=None, NR_NATUREZA=None, NR_AEROPORTO_REFERENCIA=None),
        _move(6, MES="abc", NR_NATUREZA="Z", DT_TOQUE="2020-03-20", DT_PREVISTO="2020-03-20",
              DT_CALCO="2020-03-20"),
        _move(7, NR_VOO_NUMERO="777"),  # same six date/time values as 7 below -> one kept
        _move(7, NR_VOO_NUMERO="778"),
        _move(8, DT_PREVISTO="2021-01-09", HH_PREVISTO="23:50", DT_TOQUE="2021-01-10",
              HH_TOQUE="00:20", DT_CALCO="2021-01-10"),  # over midnight: 30 min
        _move(9, QT_PAX_LOCAL="bad", NR_SERVICE_TYPE="Q"),  # malformed int, unknown service
        # all six date/time values missing, twice: nulls are one dedup key
        _move(10, DT_PREVISTO=None, HH_PREVISTO=None, DT_CALCO=None, HH_CALCO=None,
              DT_TOQUE=None, HH_TOQUE=None, NR_VOO_NUMERO="1010"),
        _move(11, DT_PREVISTO=None, HH_PREVISTO=None, DT_CALCO=None, HH_CALCO=None,
              DT_TOQUE=None, HH_TOQUE=None, NR_VOO_NUMERO="1011"),
    ]
    _csv(f"{raw}/2021/mov_202101.csv", FIELDS, default)
    _csv(f"{raw}/2021/notes.txt", FIELDS, default[:1])
    variant = [_move(20, ANO="2022", MES="7", NR_AEROPORTO_REFERENCIA="SBKP")]
    _csv(f"{raw}/2022/{airport.MOVEMENT_VARIANT_FILE}", airport.MOVEMENT_VARIANT_ORDER, variant)
    _csv(f"{raw}/2022/mov_202208.csv", FIELDS, [_move(21, ANO="2022", MES="8")])

    page = ("<table><tr><td>x</td></tr></table><table><tr><td>y</td></tr></table>"
            f"<table><tr><th>{ZW}Service Type Code</th><th>{ZW}Application</th>"
            f"<th>{ZW}Type of Operation</th><th>{ZW}Service Type Description{ZW}</th></tr>"
            f"<tr><td>{ZW}J</td><td>Schedule{ZW}</td><td>Passenger</td><td>Normal</td></tr>"
            f"<tr><td>S{ZW}</td><td>Schedule</td><td>Passenger</td><td>Shuttle</td></tr>"
            f"<tr><td>{ZW}J</td><td>Schedule{ZW}</td><td>Passenger</td><td>Normal</td></tr>"
            "</table>")
    pages = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    assert airport.service_types_to_raw(pages, f"{raw}/service/") == 3

    airports = [("SBGR", "large_airport", "Guarulhos", "SA", "BR", "Guarulhos"),
                ("SBRJ", "medium_airport", "Santos Dumont", "SA", "BR", "Rio de Janeiro"),
                ("SBKP", "large_airport", "Viracopos", "SA", "BR", "Campinas")]
    head = [n for n, _ in airport.AIRPORT_FIELDS]
    recs = [dict(zip(["ident", "type", "name", "continent", "iso_country", "municipality"], a))
            for a in airports]
    recs.append(recs[0])  # duplicate row
    _csv(f"{raw}/airports/airport-codes.csv", head, recs, sep=",")

    silver = f"{tmp}/silver"
    n_mov = airport.movements_to_silver(spark, raw, f"{silver}/movements",
                                        years=["2021", "2022"])
    airport.service_types_to_silver(spark, f"{raw}/service/", f"{silver}/service_types")
    airport.airports_to_silver(spark, f"{raw}/airports/airport-codes.csv",
                               f"{silver}/airports")
    n_gold = airport.silver_to_gold(spark, silver, f"{tmp}/gold")
    return dict(tmp=tmp, silver=silver, n_mov=n_mov, n_gold=n_gold)


def test_silver_movements(spark, lake):
    assert lake["n_mov"] == 12  # 14 rows; two pairs share all six date/time values
    df = read_parquet(spark, f"{lake['silver']}/movements",
                      schema=airport.silver_movement_schema())
    assert df.columns == list(airport.MOVEMENT_COLUMNS.values())
    by_plane = {r.matricula_aeronave: r for r in df.collect()}
    assert by_plane["PR-001"].mes == "Janeiro" and by_plane["PR-002"].mes == "Janeiro"
    assert by_plane["PR-003"].mes == "Dezembro"
    assert by_plane["PR-004"].mes == airport.MONTH_DEFAULT
    assert by_plane["PR-005"].mes == airport.MONTH_DEFAULT
    assert by_plane["PR-006"].mes == airport.MONTH_DEFAULT
    assert by_plane["PR-001"].natureza_operacao == "Doméstico"
    assert by_plane["PR-005"].natureza_operacao == airport.NATURE_DEFAULT
    assert by_plane["PR-006"].natureza_operacao == airport.NATURE_DEFAULT
    assert by_plane["PR-005"].aeroporto_ref == "Aeroporto não informado"
    assert by_plane["PR-009"].qtd_pax_local is None
    assert str(by_plane["PR-001"].hora_prevista_movimento) == "2021-01-02 10:00:00"
    assert by_plane["PR-007"].numero_voo == "777"  # deterministic survivor
    assert by_plane["PR-020"].aeroporto_ref == "SBKP" and by_plane["PR-020"].mes == "Julho"
    assert "PR-010" in by_plane and "PR-011" not in by_plane  # smallest flight number kept
    assert by_plane["PR-010"].hora_manobra is None
    assert os.path.isdir(f"{lake['silver']}/movements/ano=2021/mes=Janeiro")


def test_silver_dimensions(spark, lake):
    st = read_parquet(spark, f"{lake['silver']}/service_types")
    assert st.columns == list(airport.SERVICE_TYPE_COLUMNS.values())
    assert sorted(r.cod_tipo_servico for r in st.collect()) == ["J", "S"]
    ap = read_parquet(spark, f"{lake['silver']}/airports")
    assert ap.columns == list(airport.AIRPORT_COLUMNS.values()) and ap.count() == 3


def test_gold(spark, lake):
    assert lake["n_gold"] == 12
    gold = spark.read.parquet(f"{lake['tmp']}/gold")
    assert len(gold.columns) == 43
    g = {r.matricula_aeronave: r for r in gold.collect()}
    one = g["PR-001"]
    assert one.tipo_servico_desc == "Normal" and one.atraso is True
    assert one.aeroporto_partida == "SBGR" and one.aeroporto_chegada == "SBRJ"
    assert one.nome_aeroporto_partida == "Guarulhos"
    assert one.cidade_chegada == "Rio de Janeiro"
    assert one.dia_semana == "Sábado" and one.pandemia_decreto is True
    assert g["PR-002"].atraso is False  # international, 59 minutes
    three = g["PR-003"]
    assert three.atraso is True and three.aeroporto_partida == "SBRJ"
    assert three.nome_aeroporto_chegada == "Guarulhos"
    assert g["PR-004"].aeroporto_partida is None and g["PR-004"].tipo_aero_partida is None
    assert g["PR-006"].pandemia_decreto is True
    assert g["PR-008"].atraso is True  # 23:50 -> 00:20 next day
    assert g["PR-009"].cod_tipo_servico is None  # unknown service type kept
    assert g["PR-020"].nome_aeroporto_partida == "Viracopos"
    ten = g["PR-010"]
    assert ten.dia_semana == "Dia não informado" and ten.pandemia_decreto is False
    assert ten.atraso is False


def test_declared_layouts_equal_discovered(spark, lake, tmp):
    n = airport.movements_to_silver(spark, f"{tmp}/raw", f"{tmp}/silver_declared",
                                    years=["2021", "2022"], discover=False)
    assert n == lake["n_mov"]
    a = spark.read.parquet(f"{tmp}/silver_declared")
    b = spark.read.parquet(f"{lake['silver']}/movements")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_parity_mode_reads_clock_as_timestamp(spark, lake, tmp):
    raw = f"{tmp}/raw"
    n = airport.movements_to_silver(spark, raw, f"{tmp}/silver_parity", years=["2021", "2022"],
                                    parity=True)
    df = spark.read.parquet(f"{tmp}/silver_parity")
    assert n >= 1
    labels = {r.natureza_operacao for r in df.collect()}
    assert airport.MONTH_DEFAULT in labels  # unknown nature gets the month default
    assert df.where(F.col("hora_manobra").isNotNull()).count() > 0


def test_sentinel_rows(spark, tmp):
    path = f"{tmp}/one/mov.csv"
    _csv(path, FIELDS, [_move(1, QT_CARGA=None, MES="1"), _move(2, QT_CARGA=3.5),
                        _move(3, QT_CARGA=None, MES=None)])
    out = airport.sentinel_rows(spark, path)
    got = sorted((r.matricula_aeronave, r.mes, r.qtd_carga, r.qtd_correio) for r in out.collect())
    assert got == [("PR-001", "Janeiro", -1.0, -1.0), ("PR-003", "nops", -1.0, -1.0)]


def test_run_all_layout(spark, tmp):
    raw = f"{tmp}/lake/raw"
    _csv(f"{raw}/movements/2021/m.csv", FIELDS, [_move(1), _move(2, NR_NATUREZA="I")])
    head = [n for n, _ in airport.AIRPORT_FIELDS]
    _csv(f"{raw}/airports/airport-codes.csv", head,
         [dict(zip(["ident", "name"], ["SBGR", "Guarulhos"]))], sep=",")
    page = ("<table></table><table></table><table><tr><th>Service Type Code</th>"
            "<th>Application</th><th>Type of Operation</th><th>Service Type Description</th>"
            "</tr><tr><td>J</td><td>Schedule</td><td>Passenger</td><td>Normal</td></tr></table>")
    pages = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    counts = airport.run_all(spark, raw, f"{tmp}/lake/silver", f"{tmp}/lake/gold", pages,
                             years=["2021"])
    assert counts == {"raw_service_types": 1, "silver_movements": 2,
                      "silver_service_types": 1, "silver_airports": 1, "gold": 2}
    gold = spark.read.parquet(f"{tmp}/lake/gold")
    assert {r.nome_aeroporto_partida for r in gold.collect()} == {"Guarulhos"}
    assert {r.tipo_servico_desc for r in gold.collect()} == {"Normal"}


def test_rerun_one_year_dynamic(spark, lake, tmp):
    """Re-running 2022 alone with dynamic overwrite keeps the 2021 partitions."""
    silver = f"{lake['silver']}/movements"
    before = spark.read.parquet(silver).count()
    n = airport.movements_to_silver(spark, f"{tmp}/raw", silver, years=["2022"], dynamic=True)
    assert n == 2
    assert spark.read.parquet(silver).count() == before
    g = airport.silver_to_gold(spark, lake["silver"], f"{tmp}/gold", years=["2022"],
                               dynamic=True)
    assert g == 2 and spark.read.parquet(f"{tmp}/gold").count() == lake["n_gold"]


def test_latin1_raw_files(spark, tmp):
    raw = f"{tmp}/latin/raw"
    os.makedirs(f"{raw}/2021", exist_ok=True)
    rec = _move(1, NR_AERONAVE_OPERADOR="AVIAÇÃO")
    line = ";".join("null" if rec[c] is None else str(rec[c]) for c in FIELDS)
    with open(f"{raw}/2021/m.csv", "w", encoding="latin-1") as fh:
        fh.write(";".join(FIELDS) + "\n" + line.replace(ZW, "") + "\n")
    n = airport.movements_to_silver(spark, raw, f"{tmp}/latin/silver", years=["2021"],
                                    encoding="ISO-8859-1")
    assert n == 1
    assert spark.read.parquet(f"{tmp}/latin/silver").first().aeronave_operador == "AVIAÇÃO"


def test_nested_folders_below_a_year(spark, tmp):
    raw = f"{tmp}/nested/raw"
    _csv(f"{raw}/2021/01/a.csv", FIELDS, [_move(1)])
    _csv(f"{raw}/2021/02/b.csv", FIELDS, [_move(2, DT_TOQUE="2021-02-05")])
    _csv(f"{raw}/2020/c.csv", FIELDS, [_move(3, ANO="2020")])
    n = airport.movements_to_silver(spark, raw, f"{tmp}/nested/silver", years=["2021"])
    assert n == 2


def test_year_folders_are_directly_below_the_root(spark, tmp):
    """A year in the root's own path, or deeper down, does not count."""
    raw = f"{tmp}/2022/raw dir"
    for year in ("2010", "2022"):
        _csv(f"{raw}/{year}/a.csv", FIELDS, [_move(int(year), ANO=year)])
    _csv(f"{raw}/2010/2022/b.csv", FIELDS, [_move(3, ANO="2010")])
    for discover in (True, False):
        n = airport.movements_to_silver(spark, raw, f"{tmp}/y{discover}", years=["2021", "2022"],
                                        discover=discover)
        assert n == 1


def test_dynamic_rerun_equals_the_full_run(spark, tmp):
    """Rows without a year in two folders, and a row in the other year's folder."""
    raw = f"{tmp}/rr/raw"
    _csv(f"{raw}/2021/a.csv", FIELDS, [_move(1, ANO="2021"), _move(2, ANO="null"),
                                       _move(3, ANO="2022")])
    _csv(f"{raw}/2022/b.csv", FIELDS, [_move(4, ANO="2022"), _move(5, ANO="null"),
                                       _move(6, ANO="2021"), _move(1, ANO="2021")])
    silver = f"{tmp}/rr/silver"
    years = ["2021", "2022"]
    airport.movements_to_silver(spark, raw, silver, years=years)
    full = rows(spark.read.parquet(silver))
    for again in years:
        airport.movements_to_silver(spark, raw, silver, years=[again], dynamic=True, all_years=years)
        assert rows(spark.read.parquet(silver)) == full


def test_page_choice(spark, tmp):
    table = "<table><tr>" + "".join(f"<th>{h}</th>" for h in airport.SERVICE_TYPE_COLUMNS) + "</tr><tr>" \
        + "<td>x</td>" * len(airport.SERVICE_TYPE_COLUMNS) + "</tr></table>"
    other = "<table><tr><td>x</td></tr><tr><td>y</td></tr></table>"
    pages = spark.createDataFrame([("u1", other * 2 + table), ("u2", other * 3), ("u3", other)],
                                  "url string, html string")
    assert airport.service_types_to_raw(pages, f"{tmp}/chosen", url="u1") == 1
    with pytest.raises(Exception, match="no column"):
        airport.service_types_to_raw(pages, f"{tmp}/all")
