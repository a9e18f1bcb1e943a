"""Registered queries for the landing parser.

Each query renders the proxy daily table to gauge CSV files under the shared
folder (one file per entity and date span, with header orders, NULL tokens, bad
numbers, quoted cells, ragged lines, bad dates and variant headers injected
from data properties) and parses them back with the real reader. The gauge
files land as members of bundles: their number grows with the entities, that of
the bundles with the bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import schemas as S
from gaugeflow.plans.fixtures import (
    RENDER_EPOCH,
    RENDER_KEY_PATTERN,
    RENDER_SPAN_DAYS,
    RENDERED_HEADER,
    render_gauge_files,
)
from gaugeflow.plans.oracle import with_ctes
from gaugeflow.plans.marts_plan import ProxyMarts
from gaugeflow.plans.proxy import PROXY_RAW_SQL
from gaugeflow.plans.registry import register
from gaugeflow.session import materialize, scratch_path
from gaugeflow.sinks import export
from gaugeflow.sources import landing

# Rows before this date are rendered with the canonical header, later rows
# with the reordered one.
HEADER_SWITCH = "1998-07-01"
# Every row is also rendered in broken copies (bad dates, variant header) under
# suffixed keys. A date is broken on few days, so some files have none.
BROKEN_SQL = "(vertedor_m3s = 1.0 AND dayofmonth(fecha) = 1)"
VARIANT_HEADER = [("Almacenamiento(hm³)" if h == "VolumenAlm(Mm3)" else h) for h in S.GAUGE_HEADER]


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def _messy_cells() -> dict[str, Column]:
    """NULL tokens of three kinds, a non-numeric cell for zero evaporation,
    quoted numbers."""
    return {
        "Derrame(m3/s)": F.coalesce(_s("derrame_m3s"), F.lit("null")),
        "VolumenAlm(Mm3)": F.coalesce(_s("volumen_alm_mm3"), F.lit("NULL")),
        "Evaporacion(mm)": F.when(F.col("evaporacion_mm") == 0, F.lit("x")).otherwise(_s("evaporacion_mm")),
        "ObraToma(m3/s)": F.concat(F.lit('"'), _s("obra_toma_m3s"), F.lit('"')),
    }


def _ragged_line() -> Column:
    return F.when(F.col("vertedor_m3s") == 1.0, F.lit("ragged,1,2"))


def render_messy(raw: DataFrame, root: str) -> list[str]:
    a, b = f"{root}/canonical", f"{root}/reordered"
    d = F.col(S.DATE)
    render_gauge_files(raw.where(d < F.lit(HEADER_SWITCH).cast("date")), a, S.GAUGE_HEADER,
                       _messy_cells(), _ragged_line(), bundled=True, compressed=True)
    render_gauge_files(raw.where(d >= F.lit(HEADER_SWITCH).cast("date")), b, RENDERED_HEADER,
                       _messy_cells(), _ragged_line(), bundled=True, compressed=True)
    return [a, b]


def render_broken(raw: DataFrame, root: str) -> dict[str, str]:
    bad, variant = f"{root}/bad_dates", f"{root}/variant"
    bad_rows = raw.withColumn(S.KEY, F.concat(S.KEY, F.lit("_BADDATE")))
    render_gauge_files(bad_rows, bad, S.GAUGE_HEADER, {
        "Fecha": F.when(F.expr(BROKEN_SQL), F.lit("2001-13-45"))
        .otherwise(F.date_format(S.DATE, "yyyy-MM-dd")),
    }, bundled=True, compressed=True)
    var_rows = raw.withColumn(S.KEY, F.concat(S.KEY, F.lit("_VARIANT")))
    render_gauge_files(var_rows, variant, VARIANT_HEADER, {"Almacenamiento(hm³)": _s(S.VOLUME)}, bundled=True, compressed=True)
    return {"bad": bad, "variant": variant}


def _lines(spark: SparkSession, paths) -> DataFrame:
    return landing.scan_lines(spark, paths, key_pattern=RENDER_KEY_PATTERN, glob="*.txt.gz", recursive=True,
                              members=True)


_PARSE_SQL = with_ctes(
    """
    SELECT dam_key, fecha, precipitacion_mm,
           CASE WHEN evaporacion_mm = 0 THEN NULL ELSE evaporacion_mm END AS evaporacion_mm,
           obra_toma_m3s, vertedor_m3s, derrame_m3s, volumen_alm_mm3
    FROM raw
    """,
    raw=PROXY_RAW_SQL,
)


def prepare_parse(spark: SparkSession, sf_dir: str) -> list[str]:
    """Render the landing files of :func:`q_parse` (fixture step)."""
    return render_messy(ProxyMarts(spark, sf_dir).raw, scratch_path(spark, "landing"))


def parse_prepared(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Scan and parse rendered landing files (the operator step)."""
    rows, _, _ = landing.load_lines(_lines(spark, paths))
    return rows.select(S.KEY, S.DATE, *S.MEASURES)


@register("s1_s2_s3_s4_p9_p10_landing_parse", _PARSE_SQL)
def q_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_prepared(spark, prepare_parse(spark, sf_dir))


@register("s4_rejected_lines", with_ctes(
    "SELECT dam_key, 'ragged,1,2' AS value FROM raw WHERE vertedor_m3s = 1.0", raw=PROXY_RAW_SQL))
def q_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = render_messy(ProxyMarts(spark, sf_dir).raw, scratch_path(spark, "landing"))
    _, rejects, _ = landing.load_lines(_lines(spark, paths))
    return rejects.select(S.KEY, "value")


_SPAN_SQL = f"floor(datediff('day', DATE '{RENDER_EPOCH}', fecha) / {RENDER_SPAN_DAYS})"

_STATUS_SQL = with_ctes(
    f"""
    SELECT dam_key, cast({_SPAN_SQL} AS bigint) AS span, 'ok' AS status,
           count(*) AS data_rows,
           count(*) FILTER (WHERE vertedor_m3s = 1.0) AS rejected_rows,
           cast(0 AS bigint) AS bad_dates
    FROM raw GROUP BY dam_key, {_SPAN_SQL}, fecha < DATE '{HEADER_SWITCH}'
    UNION ALL
    SELECT dam_key || '_BADDATE', cast({_SPAN_SQL} AS bigint),
           CASE WHEN count(*) FILTER (WHERE {BROKEN_SQL}) > 0 THEN 'bad_dates' ELSE 'ok' END,
           count(*) FILTER (WHERE NOT {BROKEN_SQL}),
           cast(0 AS bigint),
           count(*) FILTER (WHERE {BROKEN_SQL})
    FROM raw GROUP BY dam_key, {_SPAN_SQL}
    UNION ALL
    SELECT dam_key || '_VARIANT', cast({_SPAN_SQL} AS bigint), 'missing_columns', cast(0 AS bigint), cast(0 AS bigint),
           cast(0 AS bigint)
    FROM raw GROUP BY dam_key, {_SPAN_SQL}
    """,
    raw=PROXY_RAW_SQL,
)


@register("s5_file_status", _STATUS_SQL)
def q_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = ProxyMarts(spark, sf_dir).raw
    root = scratch_path(spark, "landing")
    paths = render_messy(raw, root) + list(render_broken(raw, root).values())
    _, _, status = landing.load_lines(_lines(spark, paths))
    return status.select(
        S.KEY,
        F.regexp_extract("file", r"span=(\d+)/", 1).cast("long").alias("span"),
        "status",
        F.col("data_rows").cast("long").alias("data_rows"),
        F.col("rejected_rows").cast("long").alias("rejected_rows"),
        F.col("bad_dates").cast("long").alias("bad_dates"),
    )


_BAD_FILES_SQL = f"""
SELECT dam_key, {_SPAN_SQL} AS span, count(*) AS n, count(*) FILTER (WHERE {BROKEN_SQL}) AS bad
FROM raw GROUP BY 1, 2
"""


@register("a4_load_stats", with_ctes(
    f"""
    SELECT cast((SELECT count(*) FROM raw) + (SELECT coalesce(sum(n), 0) FROM bf WHERE bad = 0) AS bigint)
               AS total_rows,
           (SELECT max(fecha) FROM raw) AS max_fecha,
           cast((SELECT count(*) FROM (SELECT DISTINCT dam_key, {_SPAN_SQL} FROM raw) f)
                + (SELECT count(*) FROM bf WHERE bad = 0) AS bigint) AS files_ok,
           (SELECT count(*) FROM bf WHERE bad > 0) AS files_failed
    """, raw=PROXY_RAW_SQL, bf=_BAD_FILES_SQL))
def q_load_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, newest date and file counts after loading the good files of one
    landing directory and the bad-date copies."""
    raw = ProxyMarts(spark, sf_dir).raw
    root = scratch_path(spark, "landing")
    good = f"{root}/good"
    render_gauge_files(raw, good, S.GAUGE_HEADER, bundled=True, compressed=True)
    bad = render_broken(raw, root)["bad"]
    rows, _, status = landing.load_lines(_lines(spark, [good, bad]))
    return export.load_stats(rows, status).select(
        F.col("total_rows").cast("long").alias("total_rows"), "max_fecha",
        F.col("files_ok").cast("long").alias("files_ok"), F.col("files_failed").cast("long").alias("files_failed"))


@register("s5_good_files_only", with_ctes(
    f"""
    SELECT dam_key || '_BADDATE' AS dam_key, fecha, volumen_alm_mm3
    FROM raw r
    WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM raw WHERE {BROKEN_SQL}) b
                      WHERE b.dam_key = r.dam_key
                        AND floor(datediff('day', DATE '{RENDER_EPOCH}', b.fecha) / {RENDER_SPAN_DAYS})
                          = floor(datediff('day', DATE '{RENDER_EPOCH}', r.fecha) / {RENDER_SPAN_DAYS}))
    """, raw=PROXY_RAW_SQL))
def q_good_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file with a bad date is dropped whole; the others load."""
    raw = ProxyMarts(spark, sf_dir).raw
    paths = render_broken(raw, scratch_path(spark, "landing"))
    rows, _, _ = landing.load_lines(_lines(spark, [paths["bad"], paths["variant"]]))
    return rows.select(S.KEY, S.DATE, S.VOLUME)


@register("s6_header_aliases", with_ctes(
    f"""
    SELECT dam_key || '_VARIANT' AS dam_key, fecha, volumen_alm_mm3, precipitacion_mm
    FROM raw
    """, raw=PROXY_RAW_SQL))
def q_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = ProxyMarts(spark, sf_dir).raw
    paths = render_broken(raw, scratch_path(spark, "landing"))
    rows, _, _ = landing.load_lines(_lines(spark, paths["variant"]), aliases=landing.VARIANT_ALIASES)
    return rows.select(S.KEY, S.DATE, S.VOLUME, "precipitacion_mm")


@register("s7_tail_trim", with_ctes(
    f"""
    SELECT dam_key, fecha, {", ".join(S.MEASURES)} FROM (
        SELECT *, row_number() OVER (PARTITION BY dam_key, {_SPAN_SQL} ORDER BY fecha DESC) AS rn FROM raw) t
    WHERE rn <= {S.TAIL_ROWS}
    """, raw=PROXY_RAW_SQL))
def q_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "landing-tail")
    render_gauge_files(ProxyMarts(spark, sf_dir).raw, path, S.GAUGE_HEADER, bundled=True, compressed=True)
    lines = _lines(spark, path)
    # Both are read more than once below.
    heads = materialize(spark, landing.file_heads(lines), "tail-heads")
    trimmed = materialize(spark, landing.tail_lines(lines, heads, S.TAIL_ROWS), "tail-lines")
    rows, _, _ = landing.load_lines(trimmed)
    return rows.select(S.KEY, S.DATE, *S.MEASURES)


# Dialects by entity: separator, form of the date, text of the first cell. The
# last one has a line break in a quoted cell on the first days of months.
DIALECTS = [
    (";", "yyyy-MM-dd", None),
    ("\t", "dd/MM/yyyy", None),
    (",", "MM/dd/yyyy", None),
    ("|", "d.M.yyyy", None),
    (",", "yyyy/M/d", '"{0}\nnota, con ""coma"""'),
]


def render_dialects(raw: DataFrame, root: str) -> list[str]:
    paths = []
    for i, (sep, form, cell) in enumerate(DIALECTS):
        cells = {S.GAUGE_DATE_HEADER: F.date_format(S.DATE, form)}
        if cell is not None:
            noted = F.format_string(cell.replace("{0}", "%s"), F.col(S.KEY))
            cells["Estacion"] = F.when(F.dayofmonth(S.DATE) == 1, noted).otherwise(F.col(S.KEY))
        render_gauge_files(raw.where(_dialect() == i), f"{root}/dialect{i}", S.GAUGE_HEADER, cells, separator=sep,
                           bundled=True, compressed=True)
        paths.append(f"{root}/dialect{i}")
    return paths


def _dialect() -> Column:
    return F.pmod(F.substring(S.KEY, 2, 9).cast("int"), F.lit(len(DIALECTS)))


@register("s1_s2_s4_p10_dialects", with_ctes(
    f"""
    SELECT dam_key, {", ".join(S.MEASURES)},
           CASE WHEN cast(substr(dam_key, 2) AS int) % {len(DIALECTS)} = 2 AND early
                THEN make_date(year(fecha), dayofmonth(fecha), month(fecha)) ELSE fecha END AS fecha
    FROM (SELECT *, max(dayofmonth(fecha)) OVER (PARTITION BY dam_key, {_SPAN_SQL}) <= 12 AS early FROM raw)
    """, raw=PROXY_RAW_SQL))
def q_dialects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with other separators, orders of date parts and line breaks in
    quoted cells load whole. A month-first file without a day after the 12th
    is read day first, the choice for files that both orders fit."""
    paths = render_dialects(ProxyMarts(spark, sf_dir).raw, scratch_path(spark, "landing"))
    rows, _, _ = landing.load_lines(_lines(spark, paths))
    return rows.select(S.KEY, S.DATE, *S.MEASURES)
