"""Inputs in the shape of notices and registry, derived from the given tables.

Each input exists twice: as a DataFrame and, for the checks, as a common table
expression in ``CTES``. ``sql`` puts the named expressions before a query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import archive_path, document_base, document_name
from ..schema import DOCUMENT_FOLDER, DOCUMENT_KIND, HEADER_TO_FIELD, RAW_HEADERS, REGISTRY_SCHEMA

AS_OF = "2001-07-15 10:30:00"
RUN_TS = "2001-07-15 10:30:00"
WINDOW_DAYS = 730

CTES: dict[str, str] = {}


def sql(body: str, *names: str) -> str:
    if not names:
        return body
    return "WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in names) + "\n" + body


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_columns() -> dict[str, Column]:
    return {
        "OpportunityId": F.col("o_custkey").cast("int"),
        "Codigo": F.col("o_orderkey").cast("string"),
    }


# --- a narrow batch: every order -------------------------------------------
CTES["staged"] = """
  SELECT CAST(o_custkey AS INTEGER) AS OpportunityId, CAST(o_orderkey AS VARCHAR) AS Codigo,
         o_orderdate AS FechaModificacion
  FROM orders"""


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        *[c.alias(n) for n, c in key_columns().items()],
        F.col("o_orderdate").alias("FechaModificacion"),
    )


# --- a narrow registry: urgent orders; partial ones under a neighbour's id --
_DOC = f"'{DOCUMENT_KIND}_' || opp || '_' || code || '_' || strftime(o_orderdate, '%Y%m') || '_1'"
_REGISTRY = f"""
  SELECT opp AS OpportunityId, code AS Codigo, o_orderdate AS FechaModificacion,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS ActaPublicada,
         CASE WHEN o_totalprice < 250000 THEN '' ELSE
           '{DOCUMENT_FOLDER}/' || strftime(o_orderdate, '%Y/%m/') || {_DOC} || '.pdf' END AS UrlActaDL,
         CASE WHEN o_totalprice < 250000 THEN '' ELSE {_DOC} END AS NombreArchivoActa,
         CASE WHEN o_totalprice < 150000 THEN 0 ELSE 1 END AS Url_visitada,
         TIMESTAMP '2000-01-01 00:00:00' AS FechaModificacionReg
  FROM (SELECT *, CAST(o_custkey + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS INTEGER) AS opp,
               CAST(o_orderkey AS VARCHAR) AS code
        FROM orders WHERE {{where}}) o"""
# A batch of all orders is compared with the part of them that is known; what looks at the
# registry alone takes all orders.
CTES["registry"] = _REGISTRY.format(where="o_orderpriority = '1-URGENT'")
CTES["whole_registry"] = _REGISTRY.format(where="true")


def _document(opp: Column, code: Column) -> tuple[Column, Column]:
    """Path and name without extension of an order's document."""
    date = F.col("o_orderdate")
    base = document_base(opp, code, F.date_format(date, "yyyyMM"))
    name = document_name(base, F.lit(1), F.lit("pdf"))
    path = archive_path(F.date_format(date, "yyyy"), F.date_format(date, "MM"), name)
    return path, F.concat(base, F.lit("_1"))


def registry_columns() -> dict[str, Column]:
    """Keys and status of an order's registry entry."""
    shift = F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)
    opp = (F.col("o_custkey") + shift).cast("int")
    code = F.col("o_orderkey").cast("string")
    path, name = _document(opp, code)
    cheap = F.col("o_totalprice") < 250000
    return {
        "OpportunityId": opp,
        "Codigo": code,
        "FechaModificacion": F.col("o_orderdate"),
        "ActaPublicada": F.when(F.col("o_orderstatus") == "F", 1).otherwise(0),
        "UrlActaDL": F.when(cheap, "").otherwise(path),
        "NombreArchivoActa": F.when(cheap, "").otherwise(name),
        "Url_visitada": F.when(F.col("o_totalprice") < 150000, 0).otherwise(1),
        "FechaModificacionReg": F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"),
    }


def urgent_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = registry_columns()
    return urgent_orders(spark, sf_dir).select(*[c.alias(n) for n, c in columns.items()])


def whole_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = registry_columns()
    return table(spark, sf_dir, "orders").select(*[c.alias(n) for n, c in columns.items()])


# --- document files: two for each cheap finished order; two for every order ------------
_FILES = f"""
  SELECT 'data/{DOCUMENT_KIND}_' || o_custkey || '_' || o_orderkey || '_' || strftime(o_orderdate, '%Y%m')
         || '_' || seq || '.pdf' AS path
  FROM orders, (SELECT unnest([1, 2]) AS seq) s"""
CTES["files"] = _FILES + " WHERE o_orderstatus = 'F' AND o_totalprice < 200000"
CTES["all_files"] = _FILES


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the finished orders below a price: some notices have none."""
    stored = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 200000)
    return _files(table(spark, sf_dir, "orders").filter(stored))


def all_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _files(table(spark, sf_dir, "orders"))


def _files(orders: DataFrame) -> DataFrame:
    keys = key_columns()
    base = document_base(
        keys["OpportunityId"], keys["Codigo"], F.date_format("o_orderdate", "yyyyMM")
    )
    numbered = orders.select(base.alias("base"), F.explode(F.array(F.lit(1), F.lit(2))).alias("seq"))
    name = document_name(F.col("base"), F.col("seq"), F.lit("pdf"))
    return numbered.select(F.concat(F.lit("data/"), name).alias("path"))


# --- state dimension: regions, one missing ---------------------------------
CTES["dim"] = "SELECT r_name AS Estado, r_regionkey AS IdEstado FROM region WHERE r_name <> 'EUROPE'"


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region").filter(F.col("r_name") != "EUROPE")
    return region.select(F.col("r_name").alias("Estado"), F.col("r_regionkey").alias("IdEstado"))


# --- raw notices: every order as a row of text -----------------------------
STATE_NAMES = {
    "1-URGENT": "África",
    "2-HIGH": "america",
    "3-MEDIUM": " Asia ",
    "4-NOT SPECIFIED": "Europe",
    "5-LOW": "Middle  East",
}
_STATE_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATE_NAMES.items())
_RAW_SQL = [
    "CAST(o_orderkey AS VARCHAR)",
    "'NP-' || o_orderkey",
    "o_orderpriority",
    "o_orderstatus",
    "CASE WHEN o_orderstatus <> 'O' THEN 'Art. 41' END",
    "'REF ' || o_custkey",
    "'Orden ' || o_orderkey",
    "o_orderpriority",
    "'Orden ''' || o_orderkey || ''' de ' || o_custkey",
    "'UC' || o_custkey",
    "'Unidad ' || o_custkey",
    "'Op ' || o_orderstatus",
    "'op' || o_custkey || '@example.com'",
    f"CASE o_orderpriority {_STATE_CASE} END",
    "o_orderstatus",
    "CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"
    " ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M') END",
    "CASE WHEN o_orderstatus <> 'F' THEN strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d %H:%M:%S')"
    " ELSE strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d %H:%M') END",
    "CAST(o_custkey AS VARCHAR)",
    "strftime(o_orderdate, '%Y/%m/%d%H:%M')",
    "strftime(o_orderdate, '%Y/%m/%d %H:%M')",
    "'http://example.com/detail?opportunityId=' || o_custkey || '&ref=x'",
]
FIELD_NAMES = list(HEADER_TO_FIELD.values())[: len(RAW_HEADERS)]
CTES["raw"] = (
    "SELECT "
    + ", ".join(f"{e} AS {n}" for e, n in zip(_RAW_SQL, FIELD_NAMES))
    + ", o_orderkey AS seq, CAST(year(o_orderdate) AS VARCHAR) AS source_file FROM orders"
)


def raw_columns(id_column: str = "o_custkey") -> list[Column]:
    """The 21 text values of an order's notice, in header order."""
    key, cust = F.col("o_orderkey").cast("string"), F.col(id_column).cast("string")
    status, date = F.col("o_orderstatus"), F.col("o_orderdate")
    seconds, minutes = "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm"
    finished = status == "F"
    later = date + F.expr("INTERVAL 30 DAYS")
    state = F.coalesce(
        *[F.when(F.col("o_orderpriority") == k, v) for k, v in STATE_NAMES.items()]
    )
    return [
        key,
        F.concat(F.lit("NP-"), key),
        F.col("o_orderpriority"),
        status,
        F.when(status != "O", "Art. 41"),
        F.concat(F.lit("REF "), cust),
        F.concat(F.lit("Orden "), key),
        F.col("o_orderpriority"),
        F.concat(F.lit("Orden '"), key, F.lit("' de "), cust),
        F.concat(F.lit("UC"), cust),
        F.concat(F.lit("Unidad "), cust),
        F.concat(F.lit("Op "), status),
        F.concat(F.lit("op"), cust, F.lit("@example.com")),
        state,
        status,
        F.when(finished, F.date_format(date, seconds)).otherwise(F.date_format(date, minutes)),
        F.when(finished, F.date_format(later, minutes)).otherwise(F.date_format(later, seconds)),
        cust,
        F.date_format(date, "yyyy/MM/ddHH:mm"),
        F.date_format(date, "yyyy/MM/dd HH:mm"),
        F.concat(F.lit("http://example.com/detail?opportunityId="), cust, F.lit("&ref=x")),
    ]


def raw_notices(spark: SparkSession, sf_dir: str, id_column: str = "o_custkey") -> DataFrame:
    """21 text columns under the original headers, with file and row number."""
    return table(spark, sf_dir, "orders").select(
        *[v.alias(h) for v, h in zip(raw_columns(id_column), RAW_HEADERS)],
        F.date_format("o_orderdate", "yyyy").alias("source_file"),
        F.col("o_orderkey").alias("_seq"),
    )


def write_csv(notices: DataFrame, folder: str) -> None:
    """Notice files as CSV, blanks at the ends of a value kept."""
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    notices.write.options(header=True, escape='"', **keep).csv(folder)


# --- staged notices, all 27 fields -----------------------------------------
_STATE_SQL = """CASE upper(trim(o_state)) WHEN 'ÁFRICA' THEN '00' WHEN 'AMERICA' THEN '01'
  WHEN 'ASIA' THEN '02' WHEN 'MIDDLE  EAST' THEN '04' ELSE '' END"""


def _staged_sql(source: str, where: str) -> str:
    run = f"TIMESTAMP '{RUN_TS}'"
    parse = {
        "FechaPublicacion": "try_strptime(FechaPublicacion, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d %H:%M'])",
        "Vigencia": "try_strptime(Vigencia, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d %H:%M'])",
        "FechaCreacion": "strptime(FechaCreacion, '%Y/%m/%d%H:%M')",
        "FechaModificacion": "strptime(FechaModificacion, '%Y/%m/%d %H:%M')",
        "DescAnuncio": "replace(DescAnuncio, '''', '')",
        "ArticuloExcepcion": "coalesce(ArticuloExcepcion, '')",
        "IdEstado": _STATE_SQL.replace("o_state", "IdEstado"),
    }
    fields = ", ".join(f"{parse.get(n, n)} AS {n}" for n in FIELD_NAMES)
    return f"""
  SELECT * FROM (
    SELECT {fields},
      CAST(regexp_extract(URLAnuncio, 'opportunityId=(\\d+)', 1) AS INTEGER) AS OpportunityId,
      0 AS ActaPublicada, '' AS UrlActaDL, '' AS NombreArchivoActa,
      {run} AS FechaCreacionReg, {run} AS FechaModificacionReg, seq, source_file
    FROM {source}) s
  WHERE {where}"""


CTES["full_staged"] = _staged_sql(
    "raw", f"FechaModificacion >= TIMESTAMP '{AS_OF[:10]} 00:00:00' - INTERVAL {WINDOW_DAYS} DAY"
)

# --- full registry: urgent orders as they were before the run ---------------
_OLD = "TIMESTAMP '1999-12-31 23:59:59'"
_REGISTRY_SQL = {
    "NumProc": "'OLD-' || Codigo",
    "DescAnuncio": "'old'",
    "IdEstado": "'99'",
    "FechaPublicacion": _OLD,
    "Vigencia": _OLD,
    "FechaCreacion": _OLD,
    "FechaModificacion": _OLD,
    "ArticuloExcepcion": "''",
}
CTES["full_registry"] = (
    "SELECT "
    + ", ".join(f"{_REGISTRY_SQL.get(n, n)} AS {n}" for n in FIELD_NAMES)
    + f""", r.OpportunityId, r.ActaPublicada, r.UrlActaDL, r.NombreArchivoActa,
    {_OLD} AS FechaCreacionReg, {_OLD} AS FechaModificacionReg, r.Url_visitada
  FROM (SELECT raw.*, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate
        FROM raw JOIN orders ON raw.seq = orders.o_orderkey) w
  JOIN registry r USING (Codigo)"""
)


def full_registry(spark: SparkSession, sf_dir: str, id_column: str | None = None) -> DataFrame:
    """All registry fields of the urgent orders, with outdated notice fields."""
    old = F.lit("1999-12-31 23:59:59").cast("timestamp_ntz")
    values = dict(zip(FIELD_NAMES, raw_columns(id_column or "o_custkey")))
    values |= registry_columns()
    if id_column:
        values["OpportunityId"] = F.col(id_column)
    values |= {
        "NumProc": F.concat(F.lit("OLD-"), F.col("o_orderkey").cast("string")),
        "DescAnuncio": F.lit("old"),
        "IdEstado": F.lit("99"),
        "ArticuloExcepcion": F.lit(""),
        **{f.name: old for f in REGISTRY_SCHEMA if f.dataType.typeName() == "timestamp_ntz"},
    }
    return urgent_orders(spark, sf_dir).select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in REGISTRY_SCHEMA]
    )


# --- fetch outcomes: one per event, the type picks the branch ---------------
CTES["outcomes"] = """
  SELECT 'C' || user_id AS Codigo, CAST(user_id AS INTEGER) AS OpportunityId,
    CAST(event_id AS INTEGER) AS seq,
    CASE WHEN event_type = 'error' AND value >= 50 THEN 500 ELSE 200 END AS page_status,
    CASE WHEN event_type = 'view' THEN 0 ELSE 1 END AS n_links,
    CASE WHEN event_type = 'click' AND value < 50 THEN 5 ELSE 3 END AS link_pieces,
    CASE WHEN event_type = 'click' THEN 404 ELSE 200 END AS file_status,
    NOT (event_type = 'signup' AND value < 20) AS stored,
    CASE WHEN event_type = 'purchase' THEN true WHEN value < 50 THEN NULL ELSE false END AS uploaded,
    CASE WHEN event_type = 'error' AND value < 50 THEN 'timeout' END AS error,
    'pdf' AS ext, strftime(ts, '%Y%m%d') AS source_file
  FROM events"""


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("Codigo"),
        F.col("user_id").cast("int").alias("OpportunityId"),
        F.col("event_id").cast("int").alias("seq"),
        F.when((kind == "error") & (value >= 50), 500).otherwise(200).alias("page_status"),
        F.when(kind == "view", 0).otherwise(1).alias("n_links"),
        F.when((kind == "click") & (value < 50), 5).otherwise(3).alias("link_pieces"),
        F.when(kind == "click", 404).otherwise(200).alias("file_status"),
        (~((kind == "signup") & (value < 20))).alias("stored"),
        F.when(kind == "purchase", True).when(value >= 50, False).alias("uploaded"),
        F.when((kind == "error") & (value < 50), "timeout").alias("error"),
        F.lit("pdf").alias("ext"),
        F.date_format("ts", "yyyyMMdd").alias("source_file"),
    )


# --- report entries of these outcomes --------------------------------------
_BASE = f"'{DOCUMENT_KIND}_' || OpportunityId || '_' || Codigo || '_202401'"
_FILE = f"{_BASE} || '_' || seq || '.' || ext"
_PAGE_OK = "error IS NULL AND page_status = 200"
_LINK = f"{_PAGE_OK} AND n_links > 0 AND link_pieces = 3"
_FETCHED = f"{_LINK} AND file_status = 200"
CTES["entries"] = f"""
  SELECT source_file, Codigo, OpportunityId, 'actas_no_descargadas' AS bucket, {_BASE} AS name
  FROM outcomes WHERE NOT ({_PAGE_OK}) OR n_links = 0 OR ({_LINK} AND file_status <> 200)
  UNION ALL SELECT source_file, Codigo, OpportunityId,
    CASE WHEN stored THEN 'actas_descargadas' ELSE 'actas_no_descargadas' END, {_FILE}
  FROM outcomes WHERE {_LINK} AND file_status = 200
  UNION ALL SELECT source_file, Codigo, OpportunityId,
    CASE WHEN uploaded IS TRUE THEN 'actas_subidas_al_dl' ELSE 'actas_no_subidas_al_dl' END, {_FILE}
  FROM outcomes WHERE {_LINK} AND file_status = 200"""

# --- registry changes of these outcomes ------------------------------------
CTES["changes"] = f"""
  SELECT Codigo, OpportunityId, max(st) AS published, max(vi) AS visited,
    max(seq) FILTER (WHERE up) AS last_seq
  FROM (SELECT *, {_LINK} AND file_status = 200 AND stored AS st,
          ({_LINK} AND file_status = 200 AND stored) OR ({_PAGE_OK} AND n_links = 0) AS vi,
          {_LINK} AND file_status = 200 AND uploaded IS TRUE AS up FROM outcomes) o
  GROUP BY ALL HAVING max(st) OR max(vi) OR max(CAST(up AS INTEGER)) = 1"""
