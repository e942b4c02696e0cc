"""Queries over texts, dates, names and nested values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, html, legal, names, nested, text
from ..functions.text import ACCENTED, FORMAT_DROPS, PLAIN, SPACE_SET, WHITESPACE
from ..operators.entities import realign, word_spans
from ..operators.project import audit_times, fill_blank, fold_headers, number_text, rename_fields
from ..operators.project import drop_blocked, modified_since, status_constants, to_int
from . import inputs
from .inputs import AS_OF, RUN_TS, sql, table
from .registry import query

# --- SQL counterparts of the text functions ---------------------------------
_TRIM = "'" + WHITESPACE + "'"


def _squeeze(x: str) -> str:
    return f"regexp_replace({x}, ' {{2,}}', ' ', 'g')"


def _fold(x: str) -> str:
    return f"trim(translate(nfc_normalize({x}), '{ACCENTED}', '{PLAIN}'), {_TRIM})"


def _clean(x: str) -> str:
    kept = f"regexp_replace({_squeeze(_fold(x))}, '[^a-zA-Z0-9{SPACE_SET}]', ' ', 'g')"
    return f"trim({_squeeze(kept)}, {_TRIM})"


# The SQL engine maps a sharp s to a capital sharp s; the text rules want SS.
def _upper(x: str) -> str:
    return f"upper(replace({x}, 'ß', 'SS'))"


_PREPARE = {
    "licitantes": _upper("text"),
    "alfabeto_min": "lower(text)",
    "alfa_min": r"regexp_replace(lower(text), '[.,:\n\t]+', '', 'g')",
    "nombres": r"regexp_replace(" + _upper("text") + r", '(X{3,})|XX([\p{L}\p{N}_])', '\2', 'g')",
}


def _format(x: str, fmt: str) -> str:
    cleaned = _squeeze(f"regexp_replace({_fold(x)}, '{FORMAT_DROPS[fmt]}', ' ', 'g')")
    s = f"[{SPACE_SET}]"
    ends = f"regexp_replace({cleaned}, '^{s}+|{s}+$', '', 'g')"
    return rf"regexp_replace({ends}, '{s}+({s})', '\1', 'g')"


# --- text -------------------------------------------------------------------
@query("accent_fold", f"SELECT doc_id, {_fold('text')} AS folded FROM documents")
def accent_fold(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.fold_accents(F.col("text")).alias("folded"))


@query("clean_text", f"SELECT doc_id, {_clean('text')} AS cleaned FROM documents")
def clean_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query(
    "join_lines",
    r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '(\n*)\n', '\1 ', 'g'),
          ' {2,}', ' ', 'g'), '(\n )+', '
', 'g') AS joined FROM documents""",
)
def join_lines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.join_lines(F.col("text")).alias("joined"))


def _format_query(fmt: str) -> None:
    source = "conversations" if fmt in ("nombres", "alfa_min") else "documents"
    keys = ["conv_id", "turn"] if source == "conversations" else ["doc_id"]
    cleaned = _format(_PREPARE.get(fmt, "text"), fmt)

    @query(
        f"clean_by_format_{fmt}", f"SELECT {', '.join(keys)}, {cleaned} AS cleaned FROM {source}"
    )
    def run(spark, sf_dir):
        rows = table(spark, sf_dir, source)
        return rows.select(*keys, text.clean_by_format(F.col("text"), fmt).alias("cleaned"))


for _fmt in FORMAT_DROPS:
    _format_query(_fmt)


@query(
    "remove_quotes",
    f"""SELECT doc_id, replace(text, '''', '') AS plain, {_upper('text')} AS upper_text,
      lower(text) AS lower_text FROM documents""",
)
def remove_quotes(spark, sf_dir):
    body = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        text.remove_char(body).alias("plain"),
        F.upper(body).alias("upper_text"),
        F.lower(body).alias("lower_text"),
    )


@query(
    "state_prepare",
    sql(
        f"SELECT Codigo, {_format('upper(IdEstado)', 'alfabetopuntos')} AS state FROM raw", "raw"
    ),
)
def state_prepare(spark, sf_dir):
    raw = rename_fields(fold_headers(inputs.raw_notices(spark, sf_dir)))
    return raw.select("Codigo", text.prepare_state(F.col("IdEstado")).alias("state"))


# --- legal forms ------------------------------------------------------------
LEGAL_FORMS = [
    " S.A. DE C.V.", " S. DE R.L.", " s.a. de c.v.", "", ", S.C.", " S. EN C. POR A.", " SAPI DE CV",
    " S.A.S", " SOFOM ENR", " scala", " A.C.", " S DE RL DE CV",
]
_FORM_LIST = "[" + ", ".join(f"'{f}'" for f in LEGAL_FORMS) + "]"
_COMPANY = (
    f"SELECT p_partkey, p_name || {_FORM_LIST}[1 + p_partkey % {len(LEGAL_FORMS)}] AS text FROM part"
)
_STRIP = legal.endings_pattern(legal.STRIP_FIRST)
_SPLIT = legal.endings_pattern(legal.SPLIT_FIRST)


def _companies(spark, sf_dir):
    forms = F.array(*[F.lit(f) for f in LEGAL_FORMS])
    form = F.get(forms, (F.col("p_partkey") % len(LEGAL_FORMS)).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", form).alias("text"))


@query(
    "strip_legal_form",
    f"""SELECT p_partkey, text AS name, CASE WHEN regexp_matches(upper(text), '{_STRIP}')
      THEN regexp_replace(regexp_replace(upper(text), '{legal.DENOMINATION}', '', 'g'),
        '{_STRIP}', '', 'g') ELSE text END AS bare FROM ({_COMPANY}) c""",
)
def strip_legal_form(spark, sf_dir):
    bare = legal.strip_legal_form(F.col("text"))
    return _companies(spark, sf_dir).select("p_partkey", F.col("text").alias("name"), bare.alias("bare"))


@query(
    "split_legal_form",
    f"""SELECT p_partkey, i AS pos, regexp_replace(pieces[i], '{legal.DENOMINATION}', '', 'g') AS piece
      FROM (SELECT p_partkey, pieces, unnest(range(1, len(pieces) + 1)) AS i FROM (
        SELECT p_partkey, list_filter(string_split(regexp_replace(cleaned, '{_SPLIT}',
          chr(1) || '\\1' || chr(1) || '\\2' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS pieces
        FROM (SELECT p_partkey, {_format(_PREPARE['nombres'], 'nombres')} AS cleaned
              FROM ({_COMPANY}) c) d) e) f""",
)
def split_legal_form(spark, sf_dir):
    pieces = F.posexplode(legal.split_legal_form(F.col("text"))).alias("p", "piece")
    exploded = _companies(spark, sf_dir).select("p_partkey", pieces)
    return exploded.select("p_partkey", (F.col("p") + 1).cast("bigint").alias("pos"), "piece")


# --- dates ------------------------------------------------------------------
@query(
    "parse_two_formats",
    sql(
        """SELECT Codigo,
      strptime(FechaCreacion, '%Y/%m/%d%H:%M') AS created,
      strptime(FechaModificacion, '%Y/%m/%d %H:%M') AS modified,
      try_strptime(FechaPublicacion, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d %H:%M']) AS published,
      try_strptime(Vigencia, '%Y-%m-%d %H:%M:%S') AS strict_end,
      try_strptime(FechaCreacion, '%Y/%m/%d %H:%M') AS never FROM raw""",
        "raw",
    ),
)
def parse_two_formats(spark, sf_dir):
    raw = rename_fields(fold_headers(inputs.raw_notices(spark, sf_dir)))
    published = dates.parse_column("Publicacion del anuncio", F.col("FechaPublicacion"))
    return raw.select(
        "Codigo",
        dates.parse(F.col("FechaCreacion"), dates.CREATED).alias("created"),
        dates.parse(F.col("FechaModificacion"), dates.MODIFIED).alias("modified"),
        published.alias("published"),
        dates.parse(F.col("Vigencia"), dates.ISO_SECONDS).alias("strict_end"),
        dates.parse(F.col("FechaCreacion"), dates.MODIFIED).alias("never"),
    )


@query(
    "partition_label",
    """SELECT event_id, strftime(ts - INTERVAL 6 HOUR, '%Y') AS year,
      strftime(ts - INTERVAL 6 HOUR, '%m') AS month, date_trunc('second', ts) AS at_second,
      CASE WHEN length(CAST(event_id AS VARCHAR)) < 4
        THEN lpad(CAST(event_id AS VARCHAR), 4, '0') ELSE CAST(event_id AS VARCHAR) END AS padded
    FROM events""",
)
def partition_label(spark, sf_dir):
    label = dates.run_partition(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        label["year"].alias("year"),
        label["month"].alias("month"),
        dates.to_second(F.col("ts")).alias("at_second"),
        text.zero_pad(F.col("event_id").cast("string"), 4).alias("padded"),
    )


# --- projections and filters ------------------------------------------------
@query(
    "incremental_filter",
    f"""SELECT o_orderkey, o_orderdate FROM orders
      WHERE o_orderdate >= TIMESTAMP '{AS_OF[:10]} 00:00:00' - INTERVAL 30 DAY""",
)
def incremental_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return modified_since(orders, AS_OF, 30, "o_orderdate")


@query(
    "project_rename_cast",
    sql(
        f"""SELECT Codigo, TRY_CAST(ClaveCOG AS INTEGER) AS cog,
      TRY_CAST(replace(NumProc, 'NP-', CASE WHEN FormaProc = 'F' THEN '' ELSE 'x' END) AS INTEGER) AS num,
      CAST(CAST(CAST(seq AS DOUBLE) AS BIGINT) AS VARCHAR) AS seq_text, URLAnuncio,
      0 AS ActaPublicada, '' AS UrlActaDL, '' AS NombreArchivoActa,
      TIMESTAMP '{RUN_TS}' AS FechaCreacionReg, TIMESTAMP '{RUN_TS}' AS FechaModificacionReg FROM raw""",
        "raw",
    ),
)
def project_rename_cast(spark, sf_dir):
    raw = rename_fields(fold_headers(inputs.raw_notices(spark, sf_dir)))
    mark = F.when(F.col("FormaProc") == "F", "").otherwise("x")
    chosen = raw.select(
        "Codigo",
        to_int(F.col("ClaveCOG")).alias("cog"),
        to_int(F.replace(F.col("NumProc"), F.lit("NP-"), mark)).alias("num"),
        number_text(F.col("_seq")).alias("seq_text"),
        "URLAnuncio",
    )
    return audit_times(status_constants(chosen), RUN_TS)


@query(
    "fold_headers",
    sql("SELECT " + ", ".join(f'{n} AS "{n}"' for n in inputs.FIELD_NAMES) + " FROM raw", "raw"),
)
def fold_headers_query(spark, sf_dir):
    raw = inputs.raw_notices(spark, sf_dir).drop("source_file", "_seq")
    return rename_fields(fold_headers(raw))


@query(
    "fill_drop_columns",
    sql(
        "SELECT * EXCLUDE (ArticuloExcepcion, URLAnuncio, seq, source_file),"
        " coalesce(ArticuloExcepcion, '') AS ArticuloExcepcion FROM raw",
        "raw",
    ),
)
def fill_drop_columns(spark, sf_dir):
    raw = rename_fields(fold_headers(inputs.raw_notices(spark, sf_dir)))
    return drop_blocked(fill_blank(raw)).drop("source_file", "_seq")


# --- identifiers ------------------------------------------------------------
@query(
    "url_id_extract",
    r"SELECT page_id, url, nullif(regexp_extract(url, 'page=(\d+)', 1), '') AS id FROM pages",
)
def url_id_extract(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", names.url_id(F.col("url"), "page").alias("id"))


@query(
    "file_name_build",
    sql(
        """SELECT path, regexp_extract(path, '[^/]*$') AS name,
      regexp_replace(regexp_extract(path, '[^/]*$'), '\\.\\w+', '', 'g') AS bare,
      regexp_extract(path, '[^.]*$') AS ext FROM all_files""",
        "all_files",
    ),
)
def file_name_build(spark, sf_dir):
    path = F.col("path")
    return inputs.all_files(spark, sf_dir).select(
        "path",
        names.base_name(path).alias("name"),
        names.without_extensions(names.base_name(path)).alias("bare"),
        names.extension(path).alias("ext"),
    )


@query(
    "file_name_parse",
    sql(
        f"""SELECT path, p[2] AS opp, p[3] AS code, p[4][1:4] AS year, lpad(p[4][5:], 2, '0') AS month,
      '{inputs.DOCUMENT_FOLDER}/' || p[4][1:4] || '/' || lpad(p[4][5:], 2, '0') || '/' || path[6:] AS archive
      FROM (SELECT path, string_split(path[6:], '_') AS p FROM all_files) f""",
        "all_files",
    ),
)
def file_name_parse(spark, sf_dir):
    parsed = inputs.all_files(spark, sf_dir).withColumn(
        "p", names.parse_document_name(F.col("path"))
    )
    return parsed.select("path", "p.opp", "p.code", "p.year", "p.month", "p.archive")


# --- nested values ----------------------------------------------------------
_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"


@query(
    "entity_realign",
    f"""WITH whole AS MATERIALIZED (SELECT doc_id, {_clean('text')} AS clean, {_WORDS} AS words FROM documents),
      each AS MATERIALIZED (SELECT doc_id, unnest(words) AS raw, unnest(range(1, len(words) + 1)) AS i FROM whole),
      forms AS MATERIALIZED (SELECT raw, {_clean('raw')} AS word FROM (SELECT DISTINCT raw FROM each) d),
      firsts AS MATERIALIZED (SELECT doc_id, raw, word, strpos(clean, word) - 1 AS start
        FROM (SELECT DISTINCT doc_id, raw FROM each) p JOIN forms USING (raw) JOIN whole USING (doc_id))
      SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS seq, start, start + length(word) AS stop,
        'ORG' AS label FROM each JOIN firsts USING (doc_id, raw) WHERE start >= 0""",
)
def entity_realign(spark, sf_dir):
    """Every word of each text as an entity; ``seq`` counts those of a text that are found."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    moved = realign(docs.withColumn("entities", word_spans(F.col("text"))))
    entities = moved.select("doc_id", F.posexplode("realigned.entities").alias("p", "e"))
    return entities.select(
        "doc_id",
        (F.col("p") + 1).cast("bigint").alias("seq"),
        F.col("e.start").cast("bigint").alias("start"),
        F.col("e.end").cast("bigint").alias("stop"),
        F.col("e.label").alias("label"),
    )


@query(
    "numbered_keys",
    """SELECT page_id, CASE WHEN i = 1 THEN 'item' ELSE 'item_' || i || ': ' END AS key,
      regexp_replace(items[i], '<[^>]*>', '', 'g') AS value
      FROM (SELECT page_id, items, unnest(range(1, len(items) + 1)) AS i
        FROM (SELECT page_id, regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1) AS items FROM pages) p) q""",
)
def numbered_keys(spark, sf_dir):
    items = html.inner_texts(F.col("html"), "li")
    entries = F.explode(nested.numbered_keys(F.lit("item"), items)).alias("key", "value")
    return table(spark, sf_dir, "pages").select("page_id", entries)


_ANCHORS = "regexp_extract_all(html, '(?s)<li><a href=\"([^\"]*)\"', 1)"


@query(
    "html_rows",
    f"""SELECT page_id, i AS pos, links[i] AS href FROM (SELECT page_id, links,
      unnest(range(1, len(links) + 1)) AS i FROM (SELECT page_id, {_ANCHORS} AS links FROM pages) p) q""",
)
def html_rows(spark, sf_dir):
    items = html.blocks(F.col("html"), "li")
    links = F.flatten(F.transform(items, lambda b: html.attributes(b, "a", "href")))
    exploded = table(spark, sf_dir, "pages").select(
        "page_id", F.posexplode(links).alias("p", "href")
    )
    return exploded.select("page_id", (F.col("p") + 1).cast("bigint").alias("pos"), "href")


_LABEL, _STRONG = "Acta de presentac", "ExpedientesPublicados"


@query(
    "html_label_rows",
    f"""SELECT o_orderkey, 'row' AS kind, CAST(1 AS BIGINT) AS pos, 'go(''' || o_custkey || ''')' AS value FROM orders
    UNION ALL SELECT o_orderkey, 'row', 2, 'go(' || o_orderkey || ')' FROM orders
    UNION ALL SELECT o_orderkey, 'row', 3, 'in' || o_orderkey FROM orders
    UNION ALL SELECT o_orderkey, 'row', 4, 'behind' FROM orders
    UNION ALL SELECT o_orderkey, 'strong', 1, '/d/{_STRONG}' || year(o_orderdate) || '_' || o_orderkey || '.zip'
      FROM orders""",
)
def html_label_rows(spark, sf_dir):
    """Anchors of labelled table rows and links in bold, from a page built for each order."""
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    page = F.concat(
        F.lit(f"<table><tr class='r'><td id=a> {_LABEL}ión "), key,
        F.lit("</td><td><a href='#' onclick=\"go('"), cust, F.lit("')\">x</a><A title='>' onclick='go("), key,
        F.lit(")'>y</A><table><tr><td><a onclick='in"), key,
        F.lit("'>t</a></td></tr></table><a onclick=behind>b</a></td></tr><tr><td>Otra</td><td><a onclick=\"no()\">z</a></td></tr></table>"),
        F.lit(f"<strong><a href=\"/d/{_STRONG}"), F.date_format("o_orderdate", "yyyy"), F.lit("_"), key,
        F.lit(".zip\">k</a></strong><strong><a href='/other'>n</a></strong>"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", page.alias("page"))
    found = {
        "row": html.row_attributes(F.col("page"), _LABEL),
        "strong": html.strong_links(F.col("page"), _STRONG),
    }
    parts = [
        orders.select("o_orderkey", F.lit(kind).alias("kind"), F.posexplode(values).alias("p", "value"))
        for kind, values in found.items()
    ]
    rows = parts[0].unionByName(parts[1])
    return rows.select("o_orderkey", "kind", (F.col("p") + 1).cast("bigint").alias("pos"), "value")


@query(
    "link_rows",
    f"""SELECT page_id, i AS seq, CASE WHEN len(string_split('go(''' || links[i] || ''')', '''')) = 3
        THEN 'http://example.com' || links[i] END AS target,
      links[i][2:2] AS head FROM (SELECT page_id, links,
      unnest(range(1, len(links) + 1)) AS i FROM (SELECT page_id, {_ANCHORS} AS links FROM pages) p) q""",
)
def link_rows(spark, sf_dir):
    items = html.blocks(F.col("html"), "li")
    links = F.flatten(F.transform(items, lambda b: html.attributes(b, "a", "href")))
    calls = F.transform(links, lambda h: F.concat(F.lit("go('"), h, F.lit("')")))
    zipped = nested.zip_lists(call=calls, link=links)
    rows = table(spark, sf_dir, "pages").select("page_id", F.posexplode(zipped).alias("p", "z"))
    return rows.select(
        "page_id",
        (F.col("p") + 1).cast("bigint").alias("seq"),
        names.link_target(F.col("z.call"), "http://example.com").alias("target"),
        F.substring("z.link", 2, 1).alias("head"),
    )
