"""Layer schemas, column names and the fixed domain values.

Operators take column names as parameters; the defaults below are the names
of the complaint preset (bronze raw columns, silver and gold columns).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for identical results; they
# are listed plainly and in their natural order.
# ---------------------------------------------------------------------------

#: default that replaces a missing product or reason
UNSPECIFIED = "NO ESPECIFICADO"
#: raw text that means "missing" (compared after upper(trim(x)))
NA_MARKERS = ("NA",)

#: entity-type code -> category, checked in this order; anything else is
#: ENTITY_TYPE_DEFAULT
ENTITY_TYPE_CATEGORIES = (
    ((1,), "BANCO"),
    ((23, 24, 25), "PENSION Y CESANTIAS"),
    ((2, 3), "CORPORACION FINANCIERA"),
    ((5, 6), "SEGUROS"),
    ((7, 8), "SOCIEDADES FIDUCIARIAS"),
)
ENTITY_TYPE_DEFAULT = "OTRA ENTIDAD FINANCIERA"

#: legal-name suffixes taken off an upper-case name, in this order
NAME_SUFFIX_SA = r"\s+S\.A\.?\s*$"
NAME_SUFFIX_LTDA = r"\s+LTDA\.?\s*$"

#: forms of a year, of a code, and the years accepted
YEAR_DOTTED = r"^[0-9]\.[0-9]{1,3}$"
YEAR_PLAIN = r"^[0-9]{4}(\.0*)?$"
YEAR_RANGE = (1900, 2100)
CODE_FORM = r"^([+-]?[0-9]+)(\.0*)?$"

TYPE_BANK = "BANCO"
TYPE_PENSION = "PENSION Y CESANTIAS"
TYPE_INSURANCE = "SEGUROS"

STATE_OPEN = "VIGENTES"
STATE_RECEIVED = "RECIBIDOS"

TREND_UP = "AUMENTO"
TREND_DOWN = "DISMINUCION"
TREND_FLAT = "ESTABLE"

#: cluster labels in increasing order of volume
CLUSTER_LABELS = ("Bajo Volumen", "Volumen Medio", "Alto Volumen", "Volumen Crítico")
#: volume-band edges (complaints per entity): <50, 50-500, 500-2000, >2000
VOLUME_BAND_EDGES = (50, 500, 2000)

#: ranking tags
RANK_TOTAL = "total_quejas"
RANK_PRODUCTS = "productos_distintos"
RANK_RECENT_PREFIX = "quejas_"

#: KPI rows: (name, category, description)
KPI_TOTAL = ("Total Quejas", "GENERAL", "Total de quejas registradas en el periodo 2015-2020")
KPI_ENTITIES = ("Entidades con Quejas", "GENERAL",
                "Número de entidades financieras con al menos una queja")
KPI_AVG_PER_ENTITY = ("Promedio Quejas por Entidad", "PROMEDIO",
                      "Promedio de quejas por entidad financiera")
KPI_PCT_BANKS = ("Porcentaje Quejas Bancos", "DISTRIBUCION", "Porcentaje de quejas contra bancos")
KPI_PRODUCTS = ("Productos Distintos", "GENERAL", "Número de productos financieros con quejas")
KPI_PCT_OPEN = ("Quejas Vigentes Porcentaje", "ESTADO", "Porcentaje de quejas con estado VIGENTES")

# ---------------------------------------------------------------------------
# Column names
# ---------------------------------------------------------------------------

RAW_COLUMNS = ("ANIO", "MES", "TIPO_ENTIDAD", "CODIGO_ENTIDAD", "NOMBRE_ENTIDAD",
               "PRODUCTO", "MOTIVO", "ESTADO")
RAW_RESCUE = "_rescued_data"

#: bronze: everything is read as text so that no inference can corrupt a value
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

SILVER_COLUMNS = ("tipo_entidad_id", "codigo_entidad", "nombre_entidad", "producto", "motivo",
                  "estado", "anio", "mes", "fecha_queja", "periodo_mes", "trimestre",
                  "tipo_entidad_desc")
SILVER_STAMP = "fecha_procesamiento"

SILVER_SCHEMA = T.StructType([
    T.StructField("tipo_entidad_id", T.IntegerType(), True),
    T.StructField("codigo_entidad", T.IntegerType(), True),
    T.StructField("nombre_entidad", T.StringType(), True),
    T.StructField("producto", T.StringType(), True),
    T.StructField("motivo", T.StringType(), True),
    T.StructField("estado", T.StringType(), True),
    T.StructField("anio", T.IntegerType(), True),
    T.StructField("mes", T.IntegerType(), True),
    T.StructField("fecha_queja", T.DateType(), True),
    T.StructField("periodo_mes", T.StringType(), True),
    T.StructField("trimestre", T.StringType(), True),
    T.StructField("tipo_entidad_desc", T.StringType(), True),
])

#: entity grain of the entity mart
ENTITY_KEYS = ("codigo_entidad", "nombre_entidad", "tipo_entidad_desc")
#: entity grain of the rankings
RANKING_KEYS = ("nombre_entidad", "tipo_entidad_desc")
#: grain of the monthly mart
MONTH_KEYS = ("anio", "mes", "periodo_mes", "fecha_queja")

#: the five clustering features
ENTITY_FEATURES = ("total_quejas", "productos_distintos", "motivos_distintos",
                   "meses_con_quejas", "promedio_quejas_por_mes")
