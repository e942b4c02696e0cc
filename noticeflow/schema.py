"""Data model: headers, field names, schemas and report buckets.

Everything in this module is a fixed value that notice files, the registry
table or the run report must carry verbatim.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: source header (accents removed) -> registry field ---------
HEADER_TO_FIELD = {
    "Codigo del expediente": "Codigo",
    "Numero del procedimiento": "NumProc",
    "Caracter del procedimiento": "CaracterProc",
    "Forma del procedimiento": "FormaProc",
    "Articulo de excepcion": "ArticuloExcepcion",
    "REFERENCIA_EXPEDIENTE": "RefExpediente",
    "Titulo del expediente": "TituloExpediente",
    "Plantilla del expediente": "PlantillaExpediente",
    "Descripcion del Anuncio": "DescAnuncio",
    "Clave de la UC": "ClaveUC",
    "Nombre de la UC": "NombreUC",
    "Operador": "Operador",
    "Correo electronico": "CorreoOperador",
    "Entidad federativa": "IdEstado",
    "Tipo de contratacion": "TipoContratacion",
    "Publicacion del anuncio": "FechaPublicacion",
    "Vigencia del anuncio": "Vigencia",
    "Clave COG": "ClaveCOG",
    "Fecha de creacion": "FechaCreacion",
    "Fecha de ultima modificacion": "FechaModificacion",
    "Direccion del anuncio": "URLAnuncio",
    "opportunityId": "OpportunityId",
}

# --- fixed values: headers as they stand in the notice files ----------------
RAW_HEADERS = [
    "Código del expediente",
    "Número del procedimiento",
    "Carácter del procedimiento",
    "Forma del procedimiento",
    "Artículo de excepción",
    "REFERENCIA_EXPEDIENTE",
    "Título del expediente",
    "Plantilla del expediente",
    "Descripción del Anuncio",
    "Clave de la UC",
    "Nombre de la UC",
    "Operador",
    "Correo electrónico",
    "Entidad federativa",
    "Tipo de contratación",
    "Publicación del anuncio",
    "Vigencia del anuncio",
    "Clave COG",
    "Fecha de creación",
    "Fecha de última modificacion",
    "Dirección del anuncio",
]

# --- fixed values: report buckets -------------------------------------------
FILE_BUCKETS = [
    "actas_no_subidas_al_dl",
    "actas_no_descargadas",
    "actas_no_procesadas_literata",
    "actas_procesadas_literata",
    "actas_descargadas",
    "actas_subidas_al_dl",
]

# The counts behind the stage buckets; one bucket is declared and never filled.
STAGE_COUNTS = {
    "actas_filtradas": "filtered",
    "actas_nuevas_licitaciones_publicas": None,
    "actas_uploaded_db": "existing",
    "actas_uploaded_no_downloaded": "without_document",
    "actas_uploaded_yes_downloaded": "with_document",
    "total_actas_a_descargar": "to_download",
}

# --- fixed values: texts of the event log -----------------------------------
LOG_FOUND = "Acta localizada."
LOG_NONE = "No se encontraron Actas. longitud row_actas: "
LOG_STATUS = "Acta no descargada. Status_code: "
LOG_PAGE_ERROR = "No se descargo acta. Error: "
LOG_STORED = "Acta descargada"
LOG_NOT_STORED = "Acta no descargada. Error: "
LOG_UPLOAD = "Respuesta dl: "
LOG_UPLOAD_ERROR = "Acta no subida al data lake, error: "
LOG_PENDING_PATH = " path_dl="

# --- fixed values: document naming ------------------------------------------
DOCUMENT_KIND = "proposiciones"
DOCUMENT_FOLDER = "Acta_Presentacion_Y_Proposiciones"
ARCHIVE_MEMBER_PREFIX = "ExpedientesPublicados"
MAX_QUEUE_ROWS = 3000

# The two registry keys. They are matched one by one unless stated otherwise.
ID = "OpportunityId"
CODE = "Codigo"
KEYS = [ID, CODE]

# Columns a source adds so that a row can be told apart and traced back.
SOURCE_FILE = "source_file"
ROW_SEQ = "_seq"
# A text that sorts the files of a batch that are to count one after the other.
FILE_ORDER = "_file_order"
# The text of a row whose cells do not fit its file's header.
MALFORMED = "_malformed"

_INT = {"OpportunityId", "ActaPublicada", "Url_visitada"}
_TIME = {
    "FechaPublicacion",
    "Vigencia",
    "FechaCreacion",
    "FechaModificacion",
    "FechaCreacionReg",
    "FechaModificacionReg",
}

STAGED_FIELDS = list(HEADER_TO_FIELD.values()) + [
    "ActaPublicada",
    "UrlActaDL",
    "NombreArchivoActa",
    "FechaCreacionReg",
    "FechaModificacionReg",
]
REGISTRY_FIELDS = STAGED_FIELDS + ["Url_visitada"]

# Fields that an update of an existing notice leaves alone.
UPDATE_BLOCKED = [
    "URLAnuncio",
    "ActaPublicada",
    "UrlActaDL",
    "NombreArchivoActa",
    "FechaCreacionReg",
]
UPDATE_FIELDS = [
    f
    for f in STAGED_FIELDS
    if f not in UPDATE_BLOCKED and f not in KEYS and f != "FechaModificacionReg"
]


def _field(name: str) -> T.StructField:
    if name in _INT:
        return T.StructField(name, T.IntegerType())
    if name in _TIME:
        return T.StructField(name, T.TimestampNTZType())
    return T.StructField(name, T.StringType())


RAW_SCHEMA = T.StructType([T.StructField(h, T.StringType()) for h in RAW_HEADERS])
STAGED_SCHEMA = T.StructType([_field(f) for f in STAGED_FIELDS])
REGISTRY_SCHEMA = T.StructType([_field(f) for f in REGISTRY_FIELDS])
