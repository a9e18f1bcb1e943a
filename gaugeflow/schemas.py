"""Table contracts: column lists, header names and parsing constants.

Column order is part of every contract below.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the upstream file formats and table
# contracts for results to match; they are stated here in natural order.
# ---------------------------------------------------------------------------

# Gauge CSV: 7 metadata lines, then the header line, then data lines.
GAUGE_METADATA_LINES = 7
# Header cell -> raw column. "Estacion" is present but not read: the entity
# key comes from the file name.
GAUGE_HEADER = [
    "Estacion",
    "Fecha",
    "Precipitacion(mm)",
    "Evaporacion(mm)",
    "ObraToma(m3/s)",
    "Vertedor(m3/s)",
    "Derrame(m3/s)",
    "VolumenAlm(Mm3)",
]
GAUGE_DATE_HEADER = "Fecha"
GAUGE_MEASURE_HEADERS = {
    "Precipitacion(mm)": "precipitacion_mm",
    "Evaporacion(mm)": "evaporacion_mm",
    "ObraToma(m3/s)": "obra_toma_m3s",
    "Vertedor(m3/s)": "vertedor_m3s",
    "Derrame(m3/s)": "derrame_m3s",
    "VolumenAlm(Mm3)": "volumen_alm_mm3",
}
# Cells read as NULL before casting.
NULL_TOKENS = ["", "NULL", "null"]
# Incremental fetch keeps the header block plus this many trailing data rows.
TAIL_ROWS = 60
# Incremental fact refresh re-reads this many days before the target's max date.
LOOKBACK_DAYS = 7
# Staging keeps dates on or after this one (older ones are sentinels).
MIN_VALID_DATE = "1940-01-01"
# Percentile of historic volume used as the estimated capacity.
CAPACITY_QUANTILE = 0.99

# Catalog spreadsheet header (whitespace-normalised) -> column.
CATALOG_RENAMES = {
    "Número": "numero",
    "Clave": "dam_key",
    "Nombre de la presa": "dam_name",
    "Latitud": "latitude",
    "Longitud": "longitude",
    "Altitud": "altitude_m",
    "Estado": "state",
    "Municipio": "municipality",
    "Identificador de la cuenca de disponibilidad": "basin_id",
    "Cuenca de disponibilidad": "basin_name",
    "Número de la región hidrológica": "hydro_region_id",
    "Región hidrológica": "hydro_region_name",
}
CATALOG_DOUBLE_COLUMNS = ["latitude", "longitude", "altitude_m"]
CATALOG_INT_COLUMNS = ["numero", "basin_id", "hydro_region_id"]
CATALOG_STRIP_COLUMNS = ["dam_key", "dam_name", "state", "municipality", "basin_name", "hydro_region_name"]
# Trailing ", Abbrev." suffix removed from the dam name.
DAM_NAME_SUFFIX_PATTERN = r",\s*[A-Z][a-z.]+\.?\s*$"
SEED_COLUMNS = [
    "numero", "dam_key", "state_code",
    "dam_name", "dam_name_clean",
    "state", "municipality",
    "latitude", "longitude", "altitude_m",
    "basin_id", "basin_name",
    "hydro_region_id", "hydro_region_name",
]

# Capacity report field -> column, in the order the report is selected.
CAPACITY_RENAMES = {
    "clavesih": "dam_key",
    "namoalmac": "namo_oficial_mm3",
    "nameelev": "name_elev_msnm",
    "namealmac": "name_oficial_mm3",
    "namoelev": "namo_elev_msnm",
    "alturacortina": "altura_cortina_m",
    "elevcorona": "elev_corona_msnm",
    "inicioop": "inicio_operacion",
    "corriente": "corriente",
    "uso": "uso",
    "tipovertedor": "tipo_vertedor",
    "nombrecomun": "nombre_comun",
}
CAPACITY_DOUBLE_COLUMNS = [
    "namo_oficial_mm3", "name_oficial_mm3", "namo_elev_msnm",
    "name_elev_msnm", "altura_cortina_m", "elev_corona_msnm",
]
CAPACITY_INT_COLUMNS = ["inicio_operacion"]

# Enriched catalog (staging view) column order.
CATALOG_COLUMNS = [
    "numero", "dam_key", "state_code",
    "dam_name", "dam_name_clean", "nombre_comun",
    "state", "municipality",
    "latitude", "longitude", "altitude_m",
    "basin_id", "basin_name",
    "hydro_region_id", "hydro_region_name",
    "namo_oficial_mm3", "name_oficial_mm3",
    "namo_elev_msnm", "name_elev_msnm",
    "altura_cortina_m", "elev_corona_msnm",
    "inicio_operacion", "corriente", "uso", "tipo_vertedor",
]

# ---------------------------------------------------------------------------
# Derived schemas
# ---------------------------------------------------------------------------

KEY = "dam_key"
DATE = "fecha"
VOLUME = "volumen_alm_mm3"
MEASURES = list(GAUGE_MEASURE_HEADERS.values())
RAW_COLUMNS = [KEY, DATE, *MEASURES, "ingested_at"]

RAW_SCHEMA = T.StructType(
    [T.StructField(KEY, T.StringType(), False), T.StructField(DATE, T.DateType(), False)]
    + [T.StructField(m, T.DoubleType(), True) for m in MEASURES]
    + [T.StructField("ingested_at", T.TimestampType(), True)]
)

_INT_CATALOG = {"numero", "altitude_m", "basin_id", "hydro_region_id", "inicio_operacion"}
_DOUBLE_CATALOG = {
    "latitude", "longitude", "namo_oficial_mm3", "name_oficial_mm3",
    "namo_elev_msnm", "name_elev_msnm", "altura_cortina_m", "elev_corona_msnm",
}


def _catalog_type(name: str) -> T.DataType:
    if name in _INT_CATALOG:
        return T.IntegerType()
    if name in _DOUBLE_CATALOG:
        return T.DoubleType()
    return T.StringType()


CATALOG_SCHEMA = T.StructType([T.StructField(c, _catalog_type(c), True) for c in CATALOG_COLUMNS])

HISTORY_COLUMNS = [
    "first_record_date", "last_record_date", "total_records",
    "max_volumen_historico_mm3", "namo_estimado_mm3", "namo_p99_vs_oficial_pct",
]

FACT_COLUMNS = [
    KEY, DATE, "state", VOLUME,
    "namo_oficial_mm3", "name_oficial_mm3",
    "pct_llenado", "pct_llenado_name",
    "precipitacion_mm", "evaporacion_mm", "obra_toma_m3s", "vertedor_m3s", "derrame_m3s",
    "volumen_prev_mm3", "delta_volumen_mm3",
]

SNAPSHOT_DIM_COLUMNS = ["dam_name_clean", "latitude", "longitude", "municipality"]
