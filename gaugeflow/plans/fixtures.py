"""Input files rendered from the benchmark tables, in the upstream formats.

The upstream pipeline ships no sample files, so the catalog sheet, the capacity
report and the gauge CSVs are produced here by Spark from the given tables,
written under the shared folder and read back by the real readers. Every
rendered file holds a bounded number of rows; no group of unbounded size is
collected into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import schemas as S
from gaugeflow.plans.proxy import table
from gaugeflow.session import shuffles_dropped

# Records per rendered capacity-report array (one JSON array per line).
REPORT_CHUNK = 1000
# Nation whose suppliers are missing from the capacity report of the joins,
# so that they have entities without a match.
REPORT_MISSING_NATION = "NATION_3"


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)


def catalog_key() -> Column:
    """'D<suppkey>N<nation, 2 digits>': the last two characters are the state code."""
    return F.concat(
        F.lit("D"), F.col("s_suppkey").cast("string"), F.lit("N"),
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0"),
    )


def dam_name() -> Column:
    """Supplier name with a ', Abc.' suffix, except in one region."""
    abbrev = F.concat(F.upper(F.substring("r_name", 1, 1)), F.lower(F.substring("r_name", 2, 2)), F.lit("."))
    return F.when(F.col("r_name") == "ASIA", F.col("s_name")).otherwise(
        F.concat(F.col("s_name"), F.lit(", "), abbrev))


def render_sheet(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Catalog sheet as CSV with the upstream headers (irregular whitespace in
    two of them), padded text, bad numbers, fractional ids and an extra column."""
    df = _suppliers(spark, sf_dir).select(
        F.col("s_suppkey").cast("string").alias("Número"),
        F.concat(F.lit(" "), catalog_key(), F.lit(" ")).alias("Clave"),
        dam_name().alias("Nombre de\tla  presa"),
        F.when(F.col("s_acctbal") < 0, F.lit("n/a"))
        .otherwise(F.concat(F.lit(" "), F.col("n_nationkey").cast("string"), F.lit(".5"))).alias(" Latitud"),
        (-F.col("n_regionkey")).cast("string").alias("Longitud"),
        F.floor("s_acctbal").cast("string").alias("Altitud"),
        F.concat(F.lit("  "), F.col("n_name"), F.lit("\t")).alias("Estado"),
        F.when(F.col("r_name") == "AFRICA", F.lit(None).cast("string")).otherwise(F.col("r_name")).alias("Municipio"),
        F.concat(F.col("n_regionkey").cast("string"), F.lit(".0")).alias("Identificador de la cuenca de disponibilidad"),
        F.col("r_name").alias("Cuenca de disponibilidad"),
        F.when(F.col("r_name") == "AMERICA", F.concat(F.col("n_nationkey").cast("string"), F.lit(".5")))
        .otherwise(F.col("n_nationkey").cast("string")).alias("Número de la región hidrológica"),
        F.col("n_name").alias("Región hidrológica"),
        F.lit("sin observaciones").alias("Observaciones"),
    )
    df.write.mode("overwrite").option("header", True).csv(path)


def render_capacity_report(spark: SparkSession, sf_dir: str, path: str, without: str | None = None) -> None:
    """Capacity report as JSON: each line one array of at most REPORT_CHUNK
    records (chunks of consecutive supplier keys). Suppliers of the nation
    ``without`` are absent; negative balances give a non-numeric capacity
    ('ND')."""
    sup = _suppliers(spark, sf_dir)
    if without is not None:
        sup = sup.where(F.col("n_name") != without)
    rec = F.struct(
        catalog_key().alias("clavesih"),
        F.when(F.col("s_acctbal") < 0, F.lit("ND")).otherwise((F.col("s_acctbal") / 100).cast("string")).alias("namoalmac"),
        (F.col("n_nationkey") + 1000).cast("string").alias("nameelev"),
        (F.col("s_acctbal") / 80).cast("string").alias("namealmac"),
        (F.col("n_nationkey") + 990).cast("string").alias("namoelev"),
        F.col("s_nationkey").cast("string").alias("alturacortina"),
        (F.col("n_regionkey") + 1005).cast("string").alias("elevcorona"),
        F.when(F.col("r_name") == "EUROPE", F.lit("1990.5"))
        .otherwise((F.col("n_nationkey") + 1950).cast("string")).alias("inicioop"),
        F.col("r_name").alias("corriente"),
        F.col("n_name").alias("uso"),
        F.lit("LIBRE").alias("tipovertedor"),
        F.col("s_name").alias("nombrecomun"),
    )
    chunks = (
        sup.groupBy(F.floor(F.col("s_suppkey") / REPORT_CHUNK).alias("chunk"))
        .agg(F.to_json(F.collect_list(rec)).alias("value"))
        .select("value")
    )
    chunks.write.mode("overwrite").text(path)


# ---- Gauge CSV files ------------------------------------------------------

# Rendered files: one per entity and span of RENDER_SPAN_DAYS days (at most that
# many daily rows), under <root>/dam_key=<key>/span=<n>/.
RENDER_KEY_PATTERN = r"dam_key=([^/]+)/"
RENDER_SPAN_DAYS = 4096
RENDER_EPOCH = "1900-01-01"
# Days in a compressed bundle, 5 MB of text. No two tasks can share one; what Spark
# adds per file when it deals files to tasks keeps a task near 128 MB of text.
BUNDLE_DAYS = 50_000


def render_span(date_col: str = S.DATE) -> Column:
    return F.floor(F.datediff(F.col(date_col), F.lit(RENDER_EPOCH).cast("date")) / RENDER_SPAN_DAYS)
# The rendered header puts the volume third (columns are looked up by name).
RENDERED_HEADER = [
    "Estacion", "Fecha", "VolumenAlm(Mm3)", "Precipitacion(mm)", "Evaporacion(mm)",
    "ObraToma(m3/s)", "Vertedor(m3/s)", "Derrame(m3/s)",
]


def _cell(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def render_gauge_files(raw: DataFrame, path: str, header: list[str] | None = None,
                       cells_override: dict[str, Column] | None = None,
                       extra_lines: Column | None = None, separator: str = ",", bundled: bool = False,
                       compressed: bool = False) -> None:
    """Write daily rows as gauge CSV text: per (entity, span) one file with 7
    metadata lines, the header line and the rows ordered by date. NULL
    measures become empty cells. Rows are hash-partitioned by (key, span):
    each file is whole in one task and holds at most RENDER_SPAN_DAYS rows of
    one entity, while a large entity is spread over many tasks and files.

    ``cells_override`` gives the text of a header's cell (to inject NULL
    tokens, bad numbers or dates); ``extra_lines`` (a string Column) adds one
    more line after each row when non-NULL (to inject ragged lines).

    ``bundled`` writes the same files as members of bundles, one per task: each
    line after the name of its file and a tab (see
    :mod:`gaugeflow.sources.landing`), so that the number of landed files
    follows the bytes and not the entities. ``compressed`` writes bundles with
    gzip (``.txt.gz``), their number from that of the rows: a line's name and
    date repeat those before it, the text is several times its content."""
    header = header or RENDERED_HEADER
    by_header = S.GAUGE_MEASURE_HEADERS
    overrides = cells_override or {}
    cells = []
    for h in header:
        if h in overrides:
            cells.append(overrides[h])
        elif h == "Estacion":
            cells.append(F.col(S.KEY))
        elif h == S.GAUGE_DATE_HEADER:
            cells.append(F.date_format(S.DATE, "yyyy-MM-dd"))
        else:
            cells.append(_cell(by_header.get(h, h)))
    line_no = F.datediff(F.col(S.DATE), F.lit(RENDER_EPOCH).cast("date")) * 2
    text = F.concat_ws(separator, *[F.coalesce(c, F.lit("")) for c in cells])
    if extra_lines is not None:
        text = F.concat_ws("\n", text, extra_lines)
    data = raw.select(F.col(S.KEY).alias("dam_key"), render_span().alias("span"), line_no.alias("line"), text.alias("value"))
    meta_lines = [f"Metadato {i}" for i in range(1, S.GAUGE_METADATA_LINES + 1)] + [separator.join(header)]
    heads = (
        data.select("dam_key", "span").distinct()
        .select("dam_key", "span", F.posexplode(F.array(*[F.lit(x) for x in meta_lines])).alias("pos", "value"))
        .select("dam_key", "span", (F.col("pos") - len(meta_lines)).alias("line"), "value")
    )
    lines = data.unionByName(heads)
    if not bundled:
        ordered = lines.repartition("dam_key", "span").sortWithinPartitions("dam_key", "span", "line").drop("line")
        with shuffles_dropped(raw.sparkSession):
            ordered.write.mode("errorifexists").partitionBy("dam_key", "span").text(path)
        return
    # One number to sort by: the file (lines of two files with one hash may
    # alternate, each in its order), then the line, lines without a date first.
    at = (F.xxhash64("dam_key", "span").bitwiseAND((1 << 36) - 1) * (1 << 26)
          + F.coalesce(F.col("line"), F.lit(-(1 << 24) - 1)) + (1 << 25))
    parts = [max(1, -(-raw.count() // BUNDLE_DAYS))] if compressed else []
    lines = lines.withColumn("at", at).repartition(*parts, "dam_key", "span").sortWithinPartitions("at")
    # The name that the file would have in its directories.
    name = F.concat(*[part for c in ("dam_key", "span") for part in (
        F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")), F.lit("/"))],
        F.lit("gauge.txt\t"))
    # A cell's line breaks begin lines too.
    text = F.when(F.instr("value", "\n") > 0, F.replace("value", F.lit("\n"), F.concat(F.lit("\n"), name))).otherwise(F.col("value"))
    writer = lines.select(F.concat(name, text).alias("value")).write.mode("errorifexists")
    if compressed:
        writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    with shuffles_dropped(raw.sparkSession):
        writer.text(path)
