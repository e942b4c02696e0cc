from datetime import datetime

import pytest
from pyspark.sql import functions as F

from noticeflow.operators import report, status, updates
from noticeflow.sources import registry as scans

TABLE = (
    "OpportunityId int, Codigo string, ActaPublicada int, UrlActaDL string, "
    "NombreArchivoActa string, Url_visitada int, FechaModificacionReg timestamp_ntz"
)
OLD, NOW = datetime(2020, 1, 1), datetime(2021, 1, 1)
RUN = "2021-01-01 00:00:00"
ROWS = [(1, "a", 0, "u", "n", 0, OLD), (1, "a", 1, None, "n", 0, OLD), (2, "b", 0, "", "", 0, OLD)]


def _table(spark, rows=ROWS):
    return spark.createDataFrame(rows, TABLE)


def _rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_last_update_wins_and_hits_every_row(spark, join_path):
    changes = [(1, "a", "x", 1), (1, "a", "", 3), (1, "a", "y", 2), (9, "z", "q", 1), (None, "b", "q", 1)]
    frame = spark.createDataFrame(changes, "OpportunityId int, Codigo string, UrlActaDL string, seq int")
    out = updates.update_columns(_table(spark), frame, ["UrlActaDL"], order=["seq"], run_ts=RUN)
    assert _rows(out) == sorted(
        [(1, "a", 0, "", "n", 0, NOW), (1, "a", 1, "", "n", 0, NOW), ROWS[2]], key=repr
    )


def test_update_to_null(spark, join_path):
    frame = spark.createDataFrame([(2, "b", None)], "OpportunityId int, Codigo string, UrlActaDL string")
    out = updates.update_text(_table(spark), frame, ["UrlActaDL"], run_ts=RUN)
    assert (2, "b", 0, None, "", 0, NOW) in _rows(out)


def test_changed_rows_pad_the_state(spark):
    fields = "OpportunityId int, Codigo string, IdEstado string, UrlActaDL string"
    table = spark.createDataFrame([(i, "a", "99", "u") for i in range(5)], fields)
    table = table.withColumn("FechaModificacionReg", F.lit("2020-01-01").cast("timestamp_ntz"))
    states = ["7", "12", "123", "", None]
    staged = spark.createDataFrame([(i, "a", x, "new") for i, x in enumerate(states)], fields)
    out = updates.update_changed(table, staged, run_ts=RUN).orderBy("OpportunityId").collect()
    assert [r["IdEstado"] for r in out] == ["07", "12", "123", "", None]
    assert {r["UrlActaDL"] for r in out} == {"u"}


def test_status_forms(spark):
    one = spark.createDataFrame([(2, "b", 1)], "OpportunityId int, Codigo string, ActaPublicada int")
    assert (2, "b", 1, "", "", 1, NOW) in _rows(updates.update_published(_table(spark), one, run_ts=RUN))
    seen = one.withColumnRenamed("ActaPublicada", "Url_visitada")
    assert (2, "b", 0, "", "", 1, NOW) in _rows(updates.update_visited(_table(spark), seen, run_ts=RUN))


def test_update_where_reads_the_old_row(spark):
    out = updates.update_where(
        _table(spark),
        F.col("ActaPublicada") == 0,
        {"ActaPublicada": F.lit(5), "Url_visitada": F.col("ActaPublicada") + 1},
    )
    assert sorted((r[2], r[5]) for r in out.collect()) == [(1, 0), (5, 1), (5, 1)]


def test_repath(spark, join_path):
    moves = spark.createDataFrame([("u", "v"), ("none", "w")], "old string, new string")
    assert (1, "a", 0, "v", "n", 0, NOW) in _rows(updates.repath(_table(spark), moves, RUN))
    table = _table(spark, [(1, "a", 0, "x_1", "n", 0, OLD), (2, "b", 0, "xy1", "n", 0, OLD)])
    liked = updates.repath_like(table, "new", "x_1", RUN)
    assert [r[3] for r in _rows(liked)] == ["new", "new"]


def test_insert_keeps_copies_and_fills(spark):
    rows = spark.createDataFrame([("b", 2), ("b", 2)], "Codigo string, OpportunityId long")
    out = updates.insert_rows(_table(spark), rows, {"Url_visitada": F.lit(0)})
    assert out.schema == _table(spark).schema
    assert _rows(out).count((2, "b", None, None, None, 0, None)) == 2


def test_queue(spark):
    queue = spark.createDataFrame(
        [(3, 202101, None, 0, ""), (1, 202101, None, 0, ""), (2, 202101, OLD, 0, ""), (4, 202102, None, 0, "")],
        "opportunityId int, anomes int, FechaUltimaConsulta timestamp_ntz, ActaDescargada int, "
        "resultadoConsultaDesc string",
    )
    assert [r[0] for r in scans.queue_head(queue, 202101, ["opportunityId"], 3000).collect()] == [1, 3]
    assert [r[0] for r in scans.queue_head(queue, 202101, ["opportunityId"], 1).collect()] == [1]
    results = spark.createDataFrame([(3, 1, "ok")], "opportunityId int, ActaDescargada int, resultadoConsultaDesc string")
    out = updates.update_queue(queue, results, run_ts=RUN)
    assert (3, 202101, NOW, 1, "ok") in _rows(out)
    assert scans.queue_head(out, 202101, ["opportunityId"], 3000).count() == 1


def test_pending_and_backlog(spark):
    rows = [(1, "a", 1, "", "", 0, OLD), (2, "b", 1, None, "", 0, OLD), (3, "c", 0, "", "", None, OLD),
            (4, "d", 0, "x", "", 0, OLD)]
    table = _table(spark, rows)
    assert [r[0] for r in scans.pending_uploads(table).collect()] == [1]
    assert [r[0] for r in scans.pending_downloads(table).collect()] == [4]
    assert tuple(report.backlog(table).first()) == (1, 1, 2)


# --- outcomes: one notice per line of the branch table ----------------------------
OUTCOMES = (
    "Codigo string, OpportunityId int, seq int, page_status int, n_links int, link_pieces int, "
    "file_status int, stored boolean, uploaded boolean, error string, ext string"
)
CASES = [
    ("err", 1, 1, None, None, None, None, None, None, "boom", None),
    ("s500", 2, 1, 500, None, None, None, None, None, None, None),
    ("empty", 3, 1, 200, 0, None, None, None, None, None, None),
    ("pieces", 4, 1, 200, 1, 5, None, None, None, None, None),
    ("f404", 5, 1, 200, 1, 3, 404, None, None, None, None),
    ("ok", 6, 1, 200, 2, 3, 200, True, True, None, "pdf"),
    ("ok", 6, 2, 200, 2, 3, 200, True, True, None, "zip"),
    ("nostore", 7, 1, 200, 1, 3, 200, False, True, None, "pdf"),
    ("noup", 8, 1, 200, 1, 3, 200, True, False, None, "pdf"),
    ("raised", 9, 1, 200, 1, 3, 200, True, None, None, "pdf"),
]


@pytest.fixture
def outcomes(spark):
    return spark.createDataFrame(CASES, OUTCOMES)


def test_outcome_entries(outcomes):
    got = [
        (r["Codigo"], r["bucket"], r["name"])
        for r in status.outcome_entries(outcomes, F.lit("202103")).collect()
    ]
    none, kept = "actas_no_descargadas", "actas_descargadas"
    up, not_up = "actas_subidas_al_dl", "actas_no_subidas_al_dl"
    want = [
        ("err", none, "proposiciones_1_err_202103"),
        ("s500", none, "proposiciones_2_s500_202103"),
        ("empty", none, "proposiciones_3_empty_202103"),
        ("f404", none, "proposiciones_5_f404_202103"),
        ("ok", kept, "proposiciones_6_ok_202103_1.pdf"),
        ("ok", up, "proposiciones_6_ok_202103_1.pdf"),
        ("ok", kept, "proposiciones_6_ok_202103_2.zip"),
        ("ok", up, "proposiciones_6_ok_202103_2.zip"),
        ("nostore", none, "proposiciones_7_nostore_202103_1.pdf"),
        ("nostore", up, "proposiciones_7_nostore_202103_1.pdf"),
        ("noup", kept, "proposiciones_8_noup_202103_1.pdf"),
        ("noup", not_up, "proposiciones_8_noup_202103_1.pdf"),
        ("raised", kept, "proposiciones_9_raised_202103_1.pdf"),
        ("raised", not_up, "proposiciones_9_raised_202103_1.pdf"),
    ]
    assert sorted(got) == sorted(want)


def test_outcomes_change_the_registry(spark, outcomes, join_path):
    table = _table(spark, [(i, c, 0, "", "", 0, OLD) for c, i in {(t[0], t[1]) for t in CASES}])
    changes = status.outcome_updates(outcomes, F.lit("202103"))
    out = {r[1]: tuple(r[2:]) for r in status.apply_outcomes(table, changes, RUN).collect()}
    folder = "Acta_Presentacion_Y_Proposiciones/2021/03/"
    same = (0, "", "", 0, OLD)
    assert out == {
        "err": same,
        "s500": same,
        "pieces": same,
        "f404": same,
        "empty": (0, "", "", 1, NOW),
        "ok": (1, f"{folder}proposiciones_6_ok_202103_2.zip", "proposiciones_6_ok_202103_2", 1, NOW),
        "nostore": (0, f"{folder}proposiciones_7_nostore_202103_1.pdf", "proposiciones_7_nostore_202103_1", 0, NOW),
        "noup": (1, "", "", 1, NOW),
        "raised": (1, "", "", 1, NOW),
    }


def test_reports(spark, outcomes):
    entries = status.outcome_entries(outcomes, F.lit("202103")).withColumn("source_file", F.lit("f1"))
    counts = {r["bucket"]: r["n"] for r in report.bucket_counts(entries).collect()}
    assert counts == {
        "actas_no_subidas_al_dl": 2, "actas_no_descargadas": 5, "actas_no_procesadas_literata": 0,
        "actas_procesadas_literata": 0, "actas_descargadas": 4, "actas_subidas_al_dl": 3,
    }
    twice = report.bucket_items(entries.unionByName(entries))
    assert {r["times"] for r in twice.collect()} == {2}
    long = report.bucket_counts(entries).withColumnsRenamed({"bucket": "metric", "n": "value"})
    wide = report.wide_report(long)
    assert wide.columns == ["metric", "f1"] and wide.count() == 6
