"""Airport-movement lake: the raw -> silver -> gold flows with their fixed values.

Flows (each a plain function of paths; nothing is scheduled here):

* :func:`service_types_to_raw`  stored HTML pages -> raw service-type CSV
* :func:`movements_to_silver`   raw movement CSVs (two column layouts) -> silver
* :func:`service_types_to_silver` raw service-type CSV -> silver
* :func:`airports_to_silver`    raw airport CSV -> silver
* :func:`silver_to_gold`        silver tables -> enriched, partitioned gold
* :func:`sentinel_rows`         one raw file, filled, rows with a missing cargo weight
* :func:`run_all`               the chain in order (also ``python -m tidylake.plans.airport``)

``parity=True`` reproduces the original behaviour where it is questionable
(clock columns parsed as timestamps of the day of the read, unknown
operation nature labelled with the month default); the default corrects it.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidylake import sinks
from tidylake.functions.time import seconds_of_day
from tidylake.operators import dedup, enrich, joins
from tidylake.operators.cleaning import clean_columns, fill_nulls, replace_values
from tidylake.operators.projection import select_renamed
from tidylake.plans import ledger as ledgers
from tidylake.plans.layers import (LabelRule, changed_only, enrich_fact, refine_dimension,
                                   refine_fact, touched_partitions)
from tidylake.schema import make_schema, reorder
from tidylake.sources.csv import CsvLayout, encode_path, read_csv, read_layouts
from tidylake.sources.html_tables import extract_tables, table_columns
from tidylake.sources.mixed import read_mixed
from tidylake.sources.parquet import read_parquet

S, I, D, TS = "string", "int", "double", "timestamp"

# ---------------------------------------------------------------------------
# They must equal the source data's names and the original
# labels for identical results.  Natural order, stated as text.
# ---------------------------------------------------------------------------

# Raw movement columns, default file layout (name, type).
MOVEMENT_FIELDS = [
    ("ANO", S), ("MES", S), ("NR_AEROPORTO_REFERENCIA", S), ("NR_MOVIMENTO_TIPO", S),
    ("NR_AERONAVE_MARCAS", S), ("NR_AERONAVE_TIPO", S), ("NR_AERONAVE_OPERADOR", S),
    ("NR_VOO_OUTRO_AEROPORTO", S), ("NR_VOO_NUMERO", S), ("NR_SERVICE_TYPE", S),
    ("NR_NATUREZA", S), ("DT_PREVISTO", TS), ("HH_PREVISTO", TS), ("DT_CALCO", TS),
    ("HH_CALCO", TS), ("DT_TOQUE", TS), ("HH_TOQUE", TS), ("NR_CABECEIRA", S), ("NR_BOX", S),
    ("NR_PONTE_CONECTOR_REMOTO", S), ("NR_TERMINAL", S), ("QT_PAX_LOCAL", I),
    ("QT_PAX_CONEXAO_DOMESTICO", I), ("QT_PAX_CONEXAO_INTERNACIONAL", I), ("QT_CORREIO", D),
    ("QT_CARGA", D),
]

# Column order of the variant layout (one file of 2022-07).
MOVEMENT_VARIANT_ORDER = [
    "NR_AERONAVE_MARCAS", "NR_AERONAVE_TIPO", "NR_AERONAVE_OPERADOR", "NR_VOO_OUTRO_AEROPORTO",
    "NR_VOO_NUMERO", "DT_PREVISTO", "HH_PREVISTO", "DT_CALCO", "HH_CALCO", "DT_TOQUE",
    "HH_TOQUE", "NR_CABECEIRA", "NR_TERMINAL", "QT_PAX_LOCAL", "QT_PAX_CONEXAO_DOMESTICO",
    "QT_CORREIO", "QT_CARGA", "ANO", "MES", "NR_AEROPORTO_REFERENCIA", "NR_MOVIMENTO_TIPO",
    "NR_SERVICE_TYPE", "NR_NATUREZA", "NR_BOX", "NR_PONTE_CONECTOR_REMOTO",
    "QT_PAX_CONEXAO_INTERNACIONAL",
]
MOVEMENT_VARIANT_FILE = "Movimentacoes_Aeroportuarias_202207.csv"
MOVEMENT_YEARS = ["2019", "2020", "2021", "2022", "2023", "2024"]

# Raw -> silver names of the kept movement columns, in silver order.
MOVEMENT_COLUMNS = {
    "ANO": "ano", "MES": "mes", "NR_AEROPORTO_REFERENCIA": "aeroporto_ref",
    "NR_MOVIMENTO_TIPO": "tipo_movimento", "NR_AERONAVE_MARCAS": "matricula_aeronave",
    "NR_AERONAVE_TIPO": "aeronave_modelo_icao", "NR_AERONAVE_OPERADOR": "aeronave_operador",
    "NR_VOO_OUTRO_AEROPORTO": "aeroporto_outro", "NR_VOO_NUMERO": "numero_voo",
    "NR_SERVICE_TYPE": "tipo_servico", "NR_NATUREZA": "natureza_operacao",
    "DT_PREVISTO": "data_prevista_movimento", "HH_PREVISTO": "hora_prevista_movimento",
    "DT_CALCO": "data_calco", "HH_CALCO": "hora_calco", "DT_TOQUE": "data_manobra",
    "HH_TOQUE": "hora_manobra", "QT_PAX_LOCAL": "qtd_pax_local",
    "QT_PAX_CONEXAO_DOMESTICO": "qtd_pax_conexao_domestico",
    "QT_PAX_CONEXAO_INTERNACIONAL": "qtd_pax_conexao_internacional",
    "QT_CORREIO": "qtd_correio", "QT_CARGA": "qtd_carga",
}

# Null fills of the silver movement columns: (value, columns), in order.
MOVEMENT_FILLS = [
    ("Ano não informado", ["ano"]),
    ("Aeroporto não informado", ["aeroporto_ref", "aeroporto_outro"]),
    ("Matrícula não informada", ["matricula_aeronave"]),
    ("Modelo não informado", ["aeronave_modelo_icao"]),
    ("Operador não informado", ["aeronave_operador"]),
    ("Número de voo não informado", ["numero_voo"]),
    ("Serviço não informado", ["tipo_servico"]),
    ("Tipo de operação não informada", ["natureza_operacao"]),
]

MONTH_LABELS = {
    1: "Janeiro", 2: "Fevereiro", 3: "Março", 4: "Abril", 5: "Maio", 6: "Junho",
    7: "Julho", 8: "Agosto", 9: "Setembro", 10: "Outubro", 11: "Novembro", 12: "Dezembro",
}
MONTH_DEFAULT = "Mês não informado"
NATURE_LABELS = {"D": "Doméstico", "I": "Internacional"}
NATURE_DEFAULT = "Tipo de operação não informada"

MOVEMENT_DEDUP_KEYS = ["data_prevista_movimento", "data_calco", "data_manobra",
                       "hora_prevista_movimento", "hora_calco", "hora_manobra"]
MOVEMENT_PARTITIONS = ["ano", "mes"]

# Single-file check flow: numeric fills and the extra month fill/replacement.
CHECK_NUMERIC_FILL = (-1, ["qtd_correio", "qtd_carga", "qtd_pax_conexao_internacional",
                           "qtd_pax_conexao_domestico", "qtd_pax_local"])
CHECK_MONTH_FILL = ("nops", ["mes"])
CHECK_MONTH_REPLACE = {"1": "Janeiro"}

# Clock column -> the date column it belongs to (silver names).
CLOCK_DATES = {"hora_prevista_movimento": "data_prevista_movimento",
               "hora_calco": "data_calco", "hora_manobra": "data_manobra"}

# Service-type table: the third table of the metadata page.
SERVICE_TABLE_INDEX = 2
SERVICE_TYPE_COLUMNS = {
    "Service Type Code": "cod_tipo_servico", "Application": "aplicacao_servico",
    "Type of Operation": "tipo_servico_operacao",
    "Service Type Description": "tipo_servico_desc",
}

# Airport directory, file layout and kept columns.
AIRPORT_FIELDS = [
    ("ident", S), ("type", S), ("name", S), ("elevation_ft", S), ("continent", S),
    ("iso_country", S), ("iso_region", S), ("municipality", S), ("icao_code", S),
    ("iata_code", S), ("gps_code", S), ("local_code", S), ("coordinates", S),
]
AIRPORT_COLUMNS = {"ident": "aeroporto_icao", "type": "tipo_aeroporto",
                   "name": "nome_aeroporto", "continent": "continente",
                   "iso_country": "pais_iso", "municipality": "cidade"}

WEEKDAY_LABELS = {"Monday": "Segunda-feira", "Tuesday": "Terça-feira",
                  "Wednesday": "Quarta-feira", "Thursday": "Quinta-feira",
                  "Friday": "Sexta-feira", "Saturday": "Sábado", "Sunday": "Domingo"}
WEEKDAY_DEFAULT = "Dia não informado"
DECREE_START, DECREE_END = "2020-03-20", "2022-04-22"
DELAY_MINUTES = {"Doméstico": 30, "Internacional": 60}
DEPARTURE_COLUMNS = {"aeroporto_icao": "aeroporto_partida_icao",
                     "tipo_aeroporto": "tipo_aero_partida",
                     "nome_aeroporto": "nome_aeroporto_partida",
                     "continente": "continente_partida", "pais_iso": "pais_partida",
                     "cidade": "cidade_partida"}
ARRIVAL_COLUMNS = {"aeroporto_icao": "aeroporto_chegada_icao",
                   "tipo_aeroporto": "tipo_aero_chegada",
                   "nome_aeroporto": "nome_aeroporto_chegada",
                   "continente": "continente_chegada", "pais_iso": "pais_chegada",
                   "cidade": "cidade_chegada"}

# ---------------------------------------------------------------------------


def movement_schema(parity: bool = False, order: Sequence[str] | None = None) -> T.StructType:
    """Raw movement schema; clock columns are text unless ``parity``."""
    fields = [(n, S if (n.startswith("HH_") and not parity) else t)
              for n, t in MOVEMENT_FIELDS]
    schema = make_schema(fields)
    return reorder(schema, order) if order else schema


def silver_movement_schema() -> T.StructType:
    """Types of the silver movement table (partition columns included)."""
    raw = {f.name: f.dataType for f in movement_schema(parity=True).fields}
    return T.StructType([T.StructField(new, raw[old], True)
                         for old, new in MOVEMENT_COLUMNS.items()])


def _combine_clock(df: DataFrame) -> DataFrame:
    """``hora_x`` (clock text) -> timestamp on the day of ``data_x``."""
    out = {}
    for clock, day in CLOCK_DATES.items():
        clock_text = F.element_at(F.split(F.trim(F.col(clock)), " "), -1)
        secs = seconds_of_day(clock_text)
        out[clock] = F.timestamp_seconds(F.unix_timestamp(F.to_date(F.col(day))) + secs)
    return df.withColumns(out)


def clean_movements(df: DataFrame, parity: bool = False, deduplicate: bool = True) -> DataFrame:
    """Silver rules on raw movements already renamed to silver names."""
    if not parity:
        df = _combine_clock(df)
    nature_default = MONTH_DEFAULT if parity else NATURE_DEFAULT
    return refine_fact(
        df, fills=MOVEMENT_FILLS,
        labels=[LabelRule("mes", MONTH_LABELS, MONTH_DEFAULT, key_type="int"),
                LabelRule("natureza_operacao", NATURE_LABELS, nature_default)],
        dedup_keys=MOVEMENT_DEDUP_KEYS if deduplicate else None,
        dedup_order=_dedup_order(parity))


def _dedup_order(parity: bool) -> list[str]:
    return [] if parity else ["numero_voo", "aeroporto_ref"]


def _year_folders(root: str, years: Sequence[str]) -> str:
    """Path pattern: a file at any depth below ``root/{year}`` - directly below
    the root, so folders further up or down that look like a year do not count.
    The listing may spell the root raw or percent-encoded."""
    bare = "/" + re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "", root.rstrip("/")).strip("/")
    forms = "|".join(sorted({re.escape(f) for f in (bare, encode_path(bare))}))
    return f"(?:{forms})/(?:" + "|".join(re.escape(y) for y in years) + ")/(?:[^/]+/)*[^/]+$"


def movement_layouts(raw_root: str, years: Sequence[str] = MOVEMENT_YEARS,
                     variant_files: Sequence[str] = (MOVEMENT_VARIANT_FILE,),
                     parity: bool = False) -> list[CsvLayout]:
    """The raw movement files as layouts: ``raw_root/{year}/*.csv`` in the
    default column order, except the files named in ``variant_files`` (any
    year), which have the variant order.  A missing year folder or variant
    file just contributes no rows."""
    root = raw_root.rstrip("/")
    in_years = _year_folders(root, years)
    layouts = [CsvLayout(root, movement_schema(parity), MOVEMENT_COLUMNS,
                         exclude=list(variant_files), glob="*.csv", recursive=True,
                         include=in_years)]
    if variant_files:
        layouts.append(CsvLayout(root, movement_schema(parity, MOVEMENT_VARIANT_ORDER),
                                 MOVEMENT_COLUMNS, glob="{" + ",".join(variant_files) + "}",
                                 recursive=True, include=in_years))
    return layouts


def movements_to_silver(spark: SparkSession, raw_root: str, silver_path: str,
                        years: Sequence[str] = MOVEMENT_YEARS,
                        variant_files: Sequence[str] = (MOVEMENT_VARIANT_FILE,),
                        parity: bool = False, strict_header: bool = True,
                        discover: bool = True, dynamic: bool = False,
                        encoding: str = "utf-8", filesystem: Mapping[str, object] | None = None,
                        all_years: Sequence[str] = MOVEMENT_YEARS, ledger: str | None = None,
                        changes: tuple[str, str] | None = None) -> int:
    """Raw movement CSVs -> silver, partitioned by year and month name.

    ``discover=True`` reads files of any column layouts in one scan, by a table of
    the files' header lines (``sources.read_mixed``); ``discover=False`` uses
    the declared ``variant_files`` names, as the original did, and one scan per layout,
    which checks every file's header (``strict_header``).  A header that does not fit
    fails either way instead of being misread.

    ``dynamic`` re-runs ``years`` and keeps the other partitions.  A partition is
    named by its rows, not by their folder, so the run first finds the partitions
    that rows of ``years`` fall into and then writes exactly these, from the
    files of *all* years: rows of other folders in them, and duplicates across
    folders, come out as in a full run.  A partition that no file feeds any more
    stays until the next full run.  The default replaces the whole table.

    With ``ledger`` (a path) each run keeps a ledger of which file feeds which
    partition (``plans.ledger``): a ``dynamic`` run then reads only the files that feed
    partitions it has to rewrite, and drops those that nothing feeds any more.
    Duplicates are then looked for within a partition; rows of one date and time key with
    two years or months, a contradiction in the raw data, all stay.  ``changes`` (a run's
    name and a path) also logs the partitions that the run rewrote or dropped.

    ``encoding`` is the raw files' character set (header discovery decodes the
    same way), ``filesystem`` is passed to ``sources.file_headers``.  Returns the
    rows written.
    """
    root = raw_root.rstrip("/")

    def mixed(paths: str | Sequence[str], **more) -> DataFrame:
        return read_mixed(spark, paths, movement_schema(parity), MOVEMENT_COLUMNS, sep=";",
                          null_value="null", encoding=encoding, filesystem=filesystem, **more)

    def cleaned(of: Sequence[str]) -> DataFrame:
        if discover:
            raw = mixed(root, include=_year_folders(root, of))
        else:
            raw = read_layouts(spark, movement_layouts(root, of, variant_files, parity), sep=";",
                               null_value="null", strict_header=strict_header, encoding=encoding)
        return clean_movements(raw, parity)

    if ledger is not None:
        known = list(dict.fromkeys([*years, *all_years])) if dynamic else list(years)
        done = ledgers.run(
            spark, silver_path, ledger, {y: f"{root}/{y}" for y in known},
            lambda paths: clean_movements(mixed(paths, file="__tidylake_file"), parity, False),
            MOVEMENT_PARTITIONS, MOVEMENT_DEDUP_KEYS, _dedup_order(parity),
            only=list(years) if dynamic else None)
        if changes is not None:
            ledgers.log_changes(changes[0], done.changed, changes[1])
        return done.rows

    if not dynamic:
        silver = cleaned(years)
    else:
        silver = touched_partitions(cleaned([*years, *(y for y in all_years if y not in years)]),
                                    cleaned(years), MOVEMENT_PARTITIONS)
    return sinks.write_parquet(silver, silver_path, MOVEMENT_PARTITIONS, rebalance=True,
                               dynamic=dynamic, count=True)


def sentinel_rows(spark: SparkSession, path: str, sentinel_column: str = "qtd_carga",
                  parity: bool = False) -> DataFrame:
    """Single-file check: read one movement file (header verified), fill
    numeric nulls with -1 and text nulls with their labels, replace month
    ``"1"``, and keep the rows whose ``sentinel_column`` was missing."""
    raw = read_csv(spark, path, schema=movement_schema(parity), sep=";", null_value="null",
                   strict_header=True)
    df = select_renamed(raw, MOVEMENT_COLUMNS)
    value, cols = CHECK_NUMERIC_FILL
    df = fill_nulls(df, value, cols)
    df = fill_nulls(df, *CHECK_MONTH_FILL)
    for text, cols in MOVEMENT_FILLS:
        df = fill_nulls(df, text, cols)
    df = replace_values(df, CHECK_MONTH_REPLACE, ["mes"])
    return df.where(F.col(sentinel_column) == F.lit(value))


def service_types_to_raw(pages: DataFrame, raw_path: str, url: str | None = None) -> int:
    """Third table of the stored page ``url`` (default: of every page given) ->
    raw CSV with the table's header; a column that the table lacks is an error."""
    if url is not None:
        pages = pages.where(F.col("url") == F.lit(url))
    rows = extract_tables(pages, "html", keep=[], table_index=SERVICE_TABLE_INDEX)
    table = table_columns(rows, {h: h for h in SERVICE_TYPE_COLUMNS}, keep=[], required=True)
    return sinks.write_csv(table, raw_path, header=True, count=True)


def service_types_to_silver(spark: SparkSession, raw_path: str, silver_path: str) -> int:
    raw = read_csv(spark, raw_path, schema=None, sep=",")
    silver = refine_dimension(raw, SERVICE_TYPE_COLUMNS, key_columns=["cod_tipo_servico"])
    return sinks.write_parquet(silver, silver_path, count=True)


def airports_to_silver(spark: SparkSession, raw_path: str, silver_path: str) -> int:
    raw = read_csv(spark, raw_path, schema=AIRPORT_FIELDS, sep=",", null_value="null",
                   strict_header=True)
    silver = dedup.rows(select_renamed(raw, AIRPORT_COLUMNS))
    return sinks.write_parquet(silver, silver_path, count=True)


def measure_dimensions(service_types: DataFrame, airports: DataFrame) -> list[bool]:
    """Which of the two dimensions may be broadcast (key clean-up only shortens)."""
    return joins.measure(service_types, airports)


def hot_movement_keys(movements: DataFrame, services_small: bool, airports_small: bool
                      ) -> tuple[list, list]:
    """Service types and airports that hold a large share of the movements, found by one
    aggregate, for the joins that will shuffle: busy airports and the labels of missing
    values alike.  An airport is a key in either role."""
    if services_small and airports_small:
        return [], []
    services, own, other = joins.heavy_keys(movements, "tipo_servico", "aeroporto_ref",
                                            "aeroporto_outro")
    return services, sorted(set(own) | set(other))


def enrich_movements(movements: DataFrame, service_types: DataFrame, airports: DataFrame,
                     unique_dimensions: bool = False,
                     small: Sequence[bool] | None = None) -> DataFrame:
    """Silver -> gold rows (lazy): lookups, derived flags, both airport roles.

    ``small``: results of :func:`measure_dimensions`, measured here if not given.
    """
    # measured once, concurrently (the airport dimension serves two roles);
    # a later dedup only shrinks them, so the bounds still hold
    services_small, airports_small = small or measure_dimensions(service_types, airports)
    movements = clean_columns(movements, ["tipo_servico", "aeroporto_ref", "aeroporto_outro"])
    hot_services, hot_airports = hot_movement_keys(movements, services_small, airports_small)
    service_types = clean_columns(service_types, ["cod_tipo_servico"])
    airports = clean_columns(airports, ["aeroporto_icao"])
    if unique_dimensions:
        airports = dedup.by_key(airports, ["aeroporto_icao"])
    steps = [
        partial(joins.lookup, dim=service_types, fact_key="tipo_servico",
                dim_key="cod_tipo_servico", unique=unique_dimensions, small=services_small,
                hot_keys=hot_services),
        partial(enrich.weekday_column, column="data_manobra", labels=WEEKDAY_LABELS,
                out="dia_semana", default=WEEKDAY_DEFAULT),
        partial(enrich.date_range_flag, column="data_manobra", low=DECREE_START,
                high=DECREE_END, out="pandemia_decreto"),
        partial(enrich.delay_flag, actual="hora_manobra", planned="hora_prevista_movimento",
                category="natureza_operacao", thresholds=DELAY_MINUTES, out="atraso"),
        partial(enrich.directional_endpoints, direction="tipo_movimento",
                own="aeroporto_ref", other="aeroporto_outro",
                out_from="aeroporto_partida", out_to="aeroporto_chegada"),
        partial(joins.role_lookup, dim=airports, fact_key="aeroporto_partida",
                dim_key="aeroporto_icao", mapping=DEPARTURE_COLUMNS, small=airports_small,
                hot_keys=hot_airports),
        partial(joins.role_lookup, dim=airports, fact_key="aeroporto_chegada",
                dim_key="aeroporto_icao", mapping=ARRIVAL_COLUMNS, small=airports_small,
                hot_keys=hot_airports),
    ]
    return enrich_fact(movements, steps)


def silver_to_gold(spark: SparkSession, silver_root: str, gold_path: str,
                   unique_dimensions: bool = False, dynamic: bool = False,
                   years: Sequence[str] | None = None,
                   changes: tuple[str, str] | None = None) -> int:
    """Read the three silver tables, enrich, write gold partitioned; row count.

    ``years`` restricts the run to those silver partitions (pruned folders);
    with ``dynamic`` only the gold partitions written are replaced.  ``changes`` (a run's
    name and the table of changes that ``movements_to_silver`` keeps) restricts the run to
    the partitions which that run changed: they are pruned at run time, replaced in gold,
    and dropped there if silver no longer has them.
    """
    root = silver_root.rstrip("/")
    movements = read_parquet(spark, f"{root}/movements", schema=silver_movement_schema())
    if years:
        movements = movements.where(F.col("ano").isin(list(years)))
    changed = None
    if changes is not None:
        dynamic = True
        changed = spark.read.schema("ano string, mes string, run string").parquet(changes[1]).where(
            F.col("run") == changes[0])
        movements = changed_only(movements, changed, MOVEMENT_PARTITIONS)
    service_types = read_parquet(spark, f"{root}/service_types")
    airports = read_parquet(spark, f"{root}/airports")
    small = measure_dimensions(service_types, airports)
    gold = enrich_movements(movements, service_types, airports, unique_dimensions, small)
    if changed is not None:
        left = movements.select(*MOVEMENT_PARTITIONS).distinct()
        ledgers.drop_partitions(spark, gold_path, ledgers.outside(
            changed.select(*MOVEMENT_PARTITIONS).distinct(), left, MOVEMENT_PARTITIONS),
            MOVEMENT_PARTITIONS)
    # Silver is read folder by folder (every file belongs to one ano/mes): while
    # the dimensions are broadcast, each task writes into few gold folders, and a
    # rebalance would shuffle the widest table for nothing.  After a shuffle join
    # every task holds every month, so then the rows are rebalanced.
    return sinks.write_parquet(gold, gold_path, MOVEMENT_PARTITIONS, dynamic=dynamic,
                               rebalance=not all(small), count=True)


def run_all(spark: SparkSession, raw_root: str, silver_root: str, gold_path: str,
            pages: DataFrame | None = None, years: Sequence[str] = MOVEMENT_YEARS,
            parity: bool = False, unique_dimensions: bool = False,
            encoding: str = "utf-8") -> dict[str, int]:
    """The whole chain in dependency order; returns the rows written per step.

    Layout: ``raw_root/movements/{year}/*.csv``,
    ``raw_root/service_types/`` (written from ``pages`` when given),
    ``raw_root/airports/airport-codes.csv``; silver tables below
    ``silver_root``; gold at ``gold_path``.
    """
    raw, silver = raw_root.rstrip("/"), silver_root.rstrip("/")
    counts = {}
    if pages is not None:
        counts["raw_service_types"] = service_types_to_raw(pages, f"{raw}/service_types")
    counts["silver_movements"] = movements_to_silver(
        spark, f"{raw}/movements", f"{silver}/movements", years,
        parity=parity, encoding=encoding)
    counts["silver_service_types"] = service_types_to_silver(
        spark, f"{raw}/service_types", f"{silver}/service_types")
    counts["silver_airports"] = airports_to_silver(
        spark, f"{raw}/airports/airport-codes.csv", f"{silver}/airports")
    counts["gold"] = silver_to_gold(spark, silver, gold_path, unique_dimensions)
    return counts


def main(argv: Sequence[str] | None = None) -> None:
    import argparse
    import json

    from tidylake.session import configure

    ap = argparse.ArgumentParser(description="raw -> silver -> gold airport movements")
    ap.add_argument("--raw", required=True,
                    help="raw root: movements/{year}/*.csv, airports/airport-codes.csv")
    ap.add_argument("--silver", required=True, help="silver root (three tables below it)")
    ap.add_argument("--gold", required=True, help="gold table path (partitioned by ano, mes)")
    ap.add_argument("--pages", help="Parquet table (page_id, url, html) with the metadata page")
    ap.add_argument("--years", default=",".join(MOVEMENT_YEARS),
                    help="comma-separated year folders to ingest")
    ap.add_argument("--parity", action="store_true",
                    help="reproduce the original behaviour where it is questionable")
    ap.add_argument("--unique-dimensions", action="store_true",
                    help="one deterministic row per dimension key (no fan-out)")
    ap.add_argument("--encoding", default="utf-8", help="character set of the raw CSV files")
    ap.add_argument("--ui", action="store_true", help="keep Spark's web UI on")
    args = ap.parse_args(argv)
    builder = SparkSession.builder.appName("tidylake-airport")
    if not args.ui:
        builder = builder.config("spark.ui.enabled", "false")
    spark = configure(builder.getOrCreate())
    pages = spark.read.parquet(args.pages) if args.pages else None
    counts = run_all(spark, args.raw, args.silver, args.gold, pages,
                     [y for y in args.years.split(",") if y], args.parity,
                     args.unique_dimensions, args.encoding)
    print(json.dumps(counts))


if __name__ == "__main__":
    main()
