"""Sources and sinks on files in a temporary folder."""

import io
import random
import tracemalloc
import zipfile
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from noticeflow.operators.project import fold_headers, rename_fields
from noticeflow.schema import RAW_HEADERS, REGISTRY_SCHEMA
from noticeflow.sinks import files as sinks
from noticeflow.sinks.snapshots import SnapshotTable
from noticeflow.sources import archives, files, notices
from noticeflow.sources import registry as scans


def _csv(*records):
    lines = [",".join(RAW_HEADERS)]
    for record in records:
        cells = {**dict.fromkeys(RAW_HEADERS, ""), **record}
        lines.append(",".join(cells[h] for h in RAW_HEADERS))
    return "\n".join(lines) + "\n"


RECORDS = [
    {"Código del expediente": "007", "Nombre de la UC": '"a, ""b""\nc"'},
    {"Código del expediente": "9", "Nombre de la UC": " x "},
]


def test_csv_is_read_as_text(spark, tmp_path):
    (tmp_path / "n.csv").write_text(_csv(*RECORDS))
    read = rename_fields(fold_headers(notices.read_notices(spark, str(tmp_path / "n.csv"))))
    rows = read.orderBy("_seq").collect()
    assert [(r["Codigo"], r["NombreUC"], r["NumProc"], r["source_file"]) for r in rows] == [
        ("007", 'a, "b"\nc', None, "n.csv"),
        ("9", " x ", None, "n.csv"),
    ]
    with pytest.raises(ValueError):
        notices.read_notices(spark, "n.txt")


def test_columns_are_found_by_name(spark, tmp_path):
    """Files of other header orders, with more or fewer columns, and ragged rows."""
    code, name = RAW_HEADERS[0], "Nombre de la UC"
    (tmp_path / "a.csv").write_text(f"{code},{name}\n1,one\n2,two,three\n3\n")
    (tmp_path / "b.csv").write_text(f"\ufeffother,{name},Codigo del expediente,{name}\nx,four,4,y\n")
    rows = notices.read_notices(spark, str(tmp_path / "*.csv")).orderBy("source_file", "_seq").collect()
    assert [(r[code], r[name], r["_malformed"]) for r in rows] == [
        ("1", "one", None), ("2", "two", "2,two,three"), ("3", None, "3"), ("4", "four", None),
    ]
    assert {r["Operador"] for r in rows} == {None}


def test_one_quoted_file_is_read_by_many_tasks(spark, tmp_path):
    """Line breaks of both kinds within quotes, blank lines, and quotes that never close at the end."""
    code, name = RAW_HEADERS[0], "Nombre de la UC"
    rows = [f'{i},"a{i}\nb ""{i}""\r\n\n,c"\r\n' for i in range(3000)]
    (tmp_path / "a b.csv").write_text(f"{code},{name}\r\n" + "".join(rows) + '\n9999,plain\n7,"open\nmore\n', newline="")
    for key, value in (("maxPartitionBytes", "9000"), ("openCostInBytes", "1")):
        spark.conf.set(f"spark.sql.files.{key}", value)
    read = notices.read_notices(spark, str(tmp_path / "*.csv"))
    assert read.rdd.getNumPartitions() >= 5
    found = read.orderBy("_seq").collect()
    for key in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{key}")
    assert [r[code] for r in found] == [*map(str, range(3000)), "9999", None]
    assert all(r[name] == f'a{i}\nb "{i}"\r\n\n,c' for i, r in enumerate(found[:3000]))
    assert {r["source_file"] for r in found} == {"a b.csv"}
    assert [r["_malformed"] for r in found if r["_malformed"]] == ['7,"open\nmore']


def test_archive_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("ExpedientesPublicados2021_b.csv", "\ufeff" + _csv(*RECORDS))
        z.writestr("ExpedientesPublicados2020.csv", _csv(RECORDS[0]))
        z.writestr("x/ExpedientesPublicados2021.csv", _csv(RECORDS[0]))
        z.writestr("ExpedientesPublicados2021_a.csv", "")
    loaded = archives.load_archives(spark, str(tmp_path))
    members = [r["member"] for r in archives.list_members(loaded, 2021).collect()]
    assert sorted(members) == ["ExpedientesPublicados2021_a.csv", "ExpedientesPublicados2021_b.csv"]
    rows = archives.read_archives(loaded, "2021").orderBy("_seq").collect()
    assert [(r[RAW_HEADERS[0]], r["Nombre de la UC"], r["source_file"]) for r in rows] == [
        ("007", 'a, "b"\nc', "a.zip/ExpedientesPublicados2021_b.csv"),
        ("9", " x ", "a.zip/ExpedientesPublicados2021_b.csv"),
    ]
    assert archives.read_archives(loaded, "1999").count() == 0


def test_equal_members_of_two_archives(spark, tmp_path):
    for name, record in zip("ab", RECORDS):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as z:
            z.writestr("ExpedientesPublicados2021.csv", _csv(record, record))
    rows = archives.read_archives(archives.load_archives(spark, str(tmp_path)), 2021).collect()
    assert len({(r["source_file"], r["_seq"]) for r in rows}) == 4
    assert {(r["source_file"][:5], r[RAW_HEADERS[0]]) for r in rows} == {("a.zip", "007"), ("b.zip", "9")}


def test_inventory_does_not_read_contents(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.bin").write_bytes(b"x" * 1048576)
    listed = files.file_inventory(spark, str(tmp_path))
    row = listed.first()
    assert row["path"].endswith("d/a.bin") and (row["length"], row["size_mb"]) == (1048576, 1.0)
    assert "content" not in listed.columns


def test_query_names(spark):
    assert scans.query(spark, "SELECT 1, 'a'", ["x", "y"]).columns == ["x", "y"]
    assert scans.query(spark, "SELECT 1 AS q").columns == ["q"]


def test_log_round_trip(spark, tmp_path):
    rows = [(datetime(2021, 3, 1, 5, 6, 7), "f", "a,b"), (datetime(2021, 3, 1), "g", None)]
    events = spark.createDataFrame(rows, "ts timestamp_ntz, name string, result string")
    for _ in range(2):
        sinks.append_log(events, str(tmp_path / "log"))
    lines = sorted(r[0] for r in spark.read.text(str(tmp_path / "log")).collect())
    assert lines == ["20210301 00:00:00,g,"] * 2 + ["20210301 05:06:07,f,a,b"] * 2
    back = sinks.read_log(spark, str(tmp_path / "log"))
    assert sorted(map(tuple, back.collect()))[2:] == [rows[0]] * 2


def test_documents_are_laid_out_by_month(spark, tmp_path):
    frame = spark.createDataFrame([("a", b"1", "2021", "03")], "name string, content binary, year string, month string")
    sinks.write_documents(frame, str(tmp_path / "docs"))
    assert list((tmp_path / "docs" / "year=2021" / "month=03").glob("*.parquet"))


def test_report_file(spark, tmp_path):
    wide = spark.createDataFrame([("new", 1)], "metric string, f long")
    sinks.write_report(wide, str(tmp_path / "r"))
    (part,) = (tmp_path / "r").glob("*.csv")
    assert part.read_text() == "metric,f\nnew,1\n"


def test_snapshots(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), REGISTRY_SCHEMA)
    assert table.version() is None and table.read().count() == 0
    empty = spark.createDataFrame([], REGISTRY_SCHEMA)
    one = spark.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in REGISTRY_SCHEMA]
    )
    assert table.write(empty, version=0) == 0
    assert table.write(table.read().unionByName(one)) == 1
    # A step that is run again reads what stood before it.
    assert table.version(below=1) == 0
    table.write(table.read_version(0).unionByName(one), version=1)
    assert (table.version(), table.read().count(), table.read_version(0).count()) == (1, 1, 0)


def test_inventory_writes_an_order_a_line(spark, tmp_path, monkeypatch):
    """No cell holds the orders of a whole month."""
    from noticeflow.catalog import source_queries

    monkeypatch.setattr(source_queries, "shared_dir", lambda spark, name: f"{tmp_path}/{name}")
    source_queries.file_inventory(spark, "/root/testdata/sf0.001")
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    assert spark.read.text(f"{tmp_path}/inventory").count() == orders.count()


def test_archives_of_a_batch_are_not_copied():
    """Many archives in one batch, and a long member: Python holds one portion of lines beside the batch."""
    rng = random.Random(5)
    contents = []
    for _ in range(20):
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_STORED) as z:
            z.writestr("ExpedientesPublicados2021.csv", "".join(f"{'x' * rng.randint(900, 1100)}\n" for _ in range(1000)))
        contents.append(packed.getvalue())
    batch = pa.RecordBatch.from_arrays([pa.array([f"{i}.zip" for i in range(20)]), pa.array(contents, pa.binary())], names=["path", "content"])
    lengths = [len(c) for c in contents]
    del contents
    tracemalloc.start()
    try:
        found = [(path, z.infolist()[0].file_size) for path, z in archives._opened(iter([batch]))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [p for p, _ in found] == [f"{i}.zip" for i in range(20)] and all(n < size for (_, n), size in zip(found, lengths))
    assert peak < 500_000


def test_long_lines_are_handed_on_by_their_length():
    lines = ["y" * 1_000_000] * 10
    parts = [b.column("value").to_pylist() for b in archives._portions(io.BytesIO("\n".join(lines).encode()), "a.zip", "m")]
    assert sum(parts, []) == lines and max(map(len, parts)) == 5
