"""Whole runs: staging, repetition, rejects, stream replay."""

import pytest
from tables import SMALL
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from noticeflow.catalog import inputs
from noticeflow.plans.incremental import run_incremental
from noticeflow.plans.staging import stage
from noticeflow.schema import RAW_HEADERS, REGISTRY_FIELDS, REGISTRY_SCHEMA, STAGED_FIELDS
from noticeflow.sinks.snapshots import SnapshotTable
from noticeflow.streaming.ingest import NoticeLines, ingest_batch, start_ingest, stream_notices

GOOD = {
    "Código del expediente": "7",
    "Descripción del Anuncio": "it's",
    "Entidad federativa": " méxico ",
    "Publicación del anuncio": "2021-03-01 10:00",
    "Vigencia del anuncio": "2021-03-02 10:00:00",
    "Fecha de creación": "2021/02/2810:00",
    "Fecha de última modificacion": "2021/03/01 00:00",
    "Dirección del anuncio": "http://h/x?opportunityId=12",
}
AS_OF, RUN = "2021-03-02 09:00:00", "2021-03-02 09:00:00"


def _raw(spark, *changes):
    rows = [tuple({**GOOD, **c}.get(h) for h in RAW_HEADERS) for c in changes]
    schema = ", ".join(f"`{h}` string" for h in RAW_HEADERS)
    return spark.createDataFrame(rows, schema).withColumn("_seq", F.monotonically_increasing_id())


def _dim(spark):
    return spark.createDataFrame([("ESTADO DE MEXICO", 15)], "Estado string, IdEstado int")


def test_staged_row(spark):
    row = stage(_raw(spark, {}), _dim(spark), AS_OF, 1, RUN).rows.first().asDict()
    assert list(row)[:27] == STAGED_FIELDS
    assert (row["Codigo"], row["OpportunityId"], row["IdEstado"], row["DescAnuncio"]) == (
        "7", 12, "15", "its",
    )
    assert (row["ActaPublicada"], row["UrlActaDL"], row["NumProc"], row["ClaveCOG"]) == (0, "", "", "")
    assert str(row["FechaPublicacion"]) == "2021-03-01 10:00:00"
    compat = stage(_raw(spark, {"Entidad federativa": "x"}), _dim(spark), AS_OF, 1, RUN, True)
    row = compat.rows.first()
    assert (row["ClaveCOG"], row["IdEstado"], row["NumProc"]) == ("nan", "nan", "")


def test_window_and_rejects(spark):
    raw = _raw(
        spark,
        {"Fecha de última modificacion": "2021/02/28 23:59"},
        {"Fecha de última modificacion": "2021/03/01 00:00"},
        {"Fecha de última modificacion": "soon"},
        {"Dirección del anuncio": "http://h/x"},
        {"Vigencia del anuncio": "2021/03/02"},
        {"Vigencia del anuncio": None},
    )
    staged = stage(raw, _dim(spark), AS_OF, 1, RUN)
    assert staged.rows.count() == 2
    found = {(r["reject_reason"], r["reject_value"]) for r in staged.rejects.collect()}
    assert found == {
        ("date: Fecha de ultima modificacion", "soon"),
        ("no id in address", "http://h/x"),
        ("date: Vigencia del anuncio", "2021/03/02"),
    }


def _run(spark, registry):
    raw, dim = inputs.raw_notices(spark, SMALL, "o_orderkey"), inputs.dimension(spark, SMALL)
    return run_incremental(raw, registry, dim, inputs.AS_OF, inputs.WINDOW_DAYS, inputs.RUN_TS)


def test_second_run_inserts_nothing(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), REGISTRY_SCHEMA)
    table.write(inputs.full_registry(spark, SMALL, "o_orderkey"))
    first = _run(spark, table.read())
    counts = first.counts.agg(F.sum("new"), F.sum("conflict"), F.sum("filtered")).first()
    assert counts[0] > 0 and counts[1] == 0
    table.write(first.registry)
    second = _run(spark, table.read())
    again = second.counts.agg(F.sum("new"), F.sum("existing"), F.sum("filtered")).first()
    assert again[0] == 0 and again[1] == again[2] == counts[2]
    assert second.registry.exceptAll(table.read()).count() == 0
    assert second.registry.columns == REGISTRY_FIELDS


def test_batch_run_again_gives_the_same_registry(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), REGISTRY_SCHEMA)
    dim = inputs.dimension(spark, SMALL)
    raw = inputs.raw_notices(spark, SMALL, "o_orderkey")
    args = (table, dim, inputs.AS_OF, inputs.WINDOW_DAYS, str(tmp_path / "r"), inputs.RUN_TS)
    ingest_batch(raw, 0, *args)
    once = table.read().count()
    ingest_batch(raw, 0, *args)
    assert (table.version(), table.read().count()) == (1, once) and once > 0
    assert spark.read.parquet(str(tmp_path / "r/counts")).agg(F.sum("new")).first()[0] == once


def test_stream_keeps_order_and_loses_no_row(spark, tmp_path):
    """A file with repeated keys, a bad row and a conflict: as the batch run, all rows accounted for."""
    known = {"Código del expediente": "7", "Dirección del anuncio": "http://h/x?opportunityId=12"}
    mixed = {"Código del expediente": "7", "Dirección del anuncio": "http://h/x?opportunityId=99"}
    raw = _raw(
        spark,
        {**known, "Descripción del Anuncio": "Z"},
        {**known, "Descripción del Anuncio": "A"},
        {"Fecha de última modificacion": "soon"},
        mixed,
        {"Código del expediente": "8", "Dirección del anuncio": "http://h/x?opportunityId=13"},
    ).coalesce(1)
    folder = str(tmp_path / "in")
    inputs.write_csv(raw.drop("_seq"), folder)
    table = SnapshotTable(spark, str(tmp_path / "t"), REGISTRY_SCHEMA, writer="stream")
    row = {f.name: None for f in REGISTRY_SCHEMA}
    row |= {"Codigo": "7", "OpportunityId": 12, "ActaPublicada": 0, "UrlActaDL": "", "Url_visitada": 0}
    table.write(spark.createDataFrame([row], REGISTRY_SCHEMA), version=0)
    notices = stream_notices(spark, folder, raw.drop("_seq").schema)
    reports = str(tmp_path / "r")
    start_ingest(notices, table, _dim(spark), AS_OF, 1, str(tmp_path / "c"), reports, RUN).awaitTermination()
    got = {r.Codigo: r.DescAnuncio for r in table.read().collect()}
    assert got == {"7": "A", "8": "its"}
    batch = run_incremental(raw, table.read_version(0), _dim(spark), AS_OF, 1, RUN)
    assert {r.Codigo: r.DescAnuncio for r in batch.registry.collect()} == got
    assert [r.reject_value for r in spark.read.parquet(f"{reports}/rejects").collect()] == ["soon"]
    conflicts = spark.read.parquet(f"{reports}/conflicts").collect()
    assert [(r.Codigo, r.OpportunityId) for r in conflicts] == [("7", 99)]
    counts = spark.read.parquet(f"{reports}/counts").collect()
    assert len(counts) == 1 and counts[0].source_file.endswith(".csv") and counts[0].filtered == 4


def test_repeated_keys_need_an_order(spark):
    raw = _raw(spark, {}, {"Descripción del Anuncio": "other"}).drop("_seq")
    row = {f.name: None for f in REGISTRY_SCHEMA}
    row |= {"Codigo": "7", "OpportunityId": 12, "ActaPublicada": 0, "UrlActaDL": ""}
    registry = spark.createDataFrame([row], REGISTRY_SCHEMA)
    with pytest.raises(ValueError, match="keys repeat"):
        run_incremental(raw, registry, _dim(spark), AS_OF, 1, RUN)


def _stream(spark, folder, schema, root):
    table = SnapshotTable(spark, f"{root}/t", REGISTRY_SCHEMA, writer="stream")
    args = (table, _dim(spark), AS_OF, 1, f"{root}/c", f"{root}/r", RUN)
    start_ingest(stream_notices(spark, folder, schema), *args).awaitTermination()
    return table


def test_stream_splits_a_file(spark, tmp_path, monkeypatch):
    """One file of many splits, with quoted line breaks: no task reads all of it, and no row is lost or torn."""
    texts = {str(i): f'a{i}\n"b"\n' + "x" * (i % 40) for i in range(300)}
    rows = [
        {"Código del expediente": i, "Dirección del anuncio": f"http://h/x?opportunityId={i}", "Descripción del Anuncio": t}
        for i, t in texts.items()
    ]
    raw = _raw(spark, *rows).drop("_seq")
    folder = str(tmp_path / "in")
    inputs.write_csv(raw.coalesce(1), folder)
    split, plain = [], NoticeLines.rows
    monkeypatch.setattr(NoticeLines, "rows", lambda self, b: split.append(b.select("block").distinct().count()) or plain(self, b))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        table = _stream(spark, folder, raw.schema, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r.Codigo: r.DescAnuncio for r in table.read().collect()} == texts
    assert len(split) == 1 and split[0] > 3


def test_stream_stops_at_another_header(spark, tmp_path):
    raw = _raw(spark, {}).drop("_seq")
    folder = str(tmp_path / "in")
    inputs.write_csv(raw.select(*reversed(raw.columns)).coalesce(1), folder)
    with pytest.raises(StreamingQueryException, match="header"):
        _stream(spark, folder, raw.schema, str(tmp_path))
