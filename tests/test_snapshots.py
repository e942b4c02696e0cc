"""Buckets, commits and failures of the versioned table."""

import os
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from noticeflow.sinks.snapshots import MOST_PARTS, SnapshotTable

SCHEMA = "Codigo string, n int"


def _table(spark, tmp_path, **options):
    schema = spark.createDataFrame([], SCHEMA).schema
    return SnapshotTable(spark, str(tmp_path / "t"), schema, buckets=8, **options)


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _found(frame):
    return sorted((r.Codigo or "", r.n) for r in frame.collect())


def _files(table):
    return {os.path.join(d, f) for d, _, fs in os.walk(table.root) for f in fs if f.endswith(".parquet") and "part=" in d}


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    table = _table(spark, tmp_path)
    table.write(_rows(spark, [(str(i), i) for i in range(100)] + [(None, -1)]))
    first, before = table.manifest(1), _files(table)
    plus = lambda part: part.withColumn("n", F.when(F.col("Codigo") == "7", 70).otherwise(F.col("n")))
    table.merge(_rows(spark, [("7", 0)]), plus, _rows(spark, []))
    second = table.manifest(2)
    changed = [b for b in first if first[b] != second[b]]
    assert len(first) == 8 and len(changed) == 1 and len(second[changed[0]]) == 1
    assert before < _files(table)
    assert ("7", 70) in _found(table.read()) and len(_found(table.read())) == 101
    assert ("7", 7) in _found(table.read_version(1))


def test_an_insert_only_adds_files(spark, tmp_path):
    table = _table(spark, tmp_path)
    table.write(_rows(spark, [(str(i), i) for i in range(50)]))
    seen = []
    update = lambda part: seen.append(part) or part
    table.merge(_rows(spark, []), update, _rows(spark, [("x", 1), ("x", 1)]))
    first, second = table.manifest(1), table.manifest(2)
    assert not seen and [b for b in first if second[b][:1] != first[b]] == []
    assert sum(map(len, second.values())) == sum(map(len, first.values())) + 1
    assert _found(table.read()).count(("x", 1)) == 2


def test_many_parts_are_written_anew(spark, tmp_path):
    table = _table(spark, tmp_path)
    for i in range(MOST_PARTS + 2):
        table.merge(_rows(spark, []), lambda part: part, _rows(spark, [("x", i)]))
    (parts,) = table.manifest(table.version()).values()
    assert len(parts) <= MOST_PARTS
    assert _found(table.read()) == [("x", i) for i in range(MOST_PARTS + 2)]


def test_empty_and_missing(spark, tmp_path):
    table = _table(spark, tmp_path)
    assert table.version() is None and table.read().count() == 0
    table.write(_rows(spark, []))
    assert table.version() == 1 and table.read().count() == 0


def test_two_writers_keep_both_rows(spark, tmp_path):
    """The second writer commits while the first is about to; the first goes on from its state."""
    one, two = _table(spark, tmp_path, writer="one"), _table(spark, tmp_path, writer="two")
    one.write(_rows(spark, [("a", 1), ("b", 1)]))
    put, lost = one._put, []

    def late(version, parts):
        if not lost:
            lost.append(version)
            two.merge(_rows(spark, [("a", 0)]), lambda part: part.withColumn("n", F.col("n") + 10), _rows(spark, [("B", 2)]))
        put(version, parts)

    one._put = late
    plus = lambda part: part.withColumn("n", F.col("n") + 100)
    assert one.merge(_rows(spark, [("a", 0), ("b", 0)]), plus, _rows(spark, [("A", 1)])) == 3
    rows = dict(_found(one.read()))
    assert lost == [2] and {"A": 1, "B": 2}.items() <= rows.items()
    assert rows["a"] == 111 and rows["b"] >= 101
    assert one.manifest(2) != one.manifest(3) and not [n for n in os.listdir(one.root) if n.startswith("aside")]


def test_many_writers_at_once(spark, tmp_path):
    tables = [_table(spark, tmp_path, writer=f"w{i}") for i in range(4)]

    def insert(i):
        for j in range(2):
            tables[i].merge(_rows(spark, []), lambda part: part, _rows(spark, [("x", 10 * i + j)]))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(insert, range(4)))
    assert _found(tables[0].read()) == sorted(("x", 10 * i + j) for i in range(4) for j in range(2))
    assert tables[0].versions() == list(range(1, 9))


def test_properties_come_from_the_table(spark, tmp_path):
    _table(spark, tmp_path).write(_rows(spark, [(str(i), 0) for i in range(200)]))
    schema = spark.createDataFrame([], SCHEMA).schema
    other = SnapshotTable(spark, str(tmp_path / "t"), schema, buckets=3, writer="other")
    assert (other.buckets, other.key) == (8, "Codigo")
    keys = _rows(spark, [(str(i), 0) for i in range(20)])
    other.merge(keys, lambda part: part.withColumn("n", F.when(F.col("Codigo").cast("int") < 20, 1).otherwise(0)), _rows(spark, []))
    assert sum(n for _, n in _found(other.read())) == 20
    schema_of = lambda n: SnapshotTable(spark, str(tmp_path / "u"), schema, buckets=n)
    early, late = schema_of(4), schema_of(5)
    early.write(keys)
    with pytest.raises(ValueError, match="open it again"):
        late.merge(_rows(spark, []), lambda part: part, keys)
    with pytest.raises(ValueError, match="dealt by Codigo"):
        SnapshotTable(spark, str(tmp_path / "t"), schema, key="n")


DATED = "Codigo string, Id int, day timestamp_ntz, n int"


def _dated(spark, tmp_path, **options):
    schema = spark.createDataFrame([], DATED).schema
    table = SnapshotTable(spark, str(tmp_path / "d"), schema, buckets=8, index=["Id"], **options)
    for year in (2019, 2020, 2021):
        rows = [(f"{year}-{i}", year * 100 + i, datetime(year, 1 + i % 12, 1), i) for i in range(60)]
        rows.append((f"{year}-none", None, None, -1))
        table.merge(spark.createDataFrame([], DATED), lambda part: part, spark.createDataFrame(rows, DATED))
    return table


def _read_files(frame):
    return {f.split("part=")[1] for f in frame.inputFiles()}


def test_dates_skip_files(spark, tmp_path):
    table = _dated(spark, tmp_path)
    late = table.read_between("day", least="2021-02-01")
    assert 0 < len(_read_files(late)) <= 8 < len(_read_files(table.read()))
    assert late.count() == table.read().filter("day >= '2021-02-01'").count() > 0
    exact = table.read_between("day", datetime(2020, 3, 1), datetime(2020, 3, 1))
    assert {r.day for r in exact.collect()} == {datetime(2020, 3, 1)}
    assert table.read_between("day", least="2022-01-01").count() == 0
    assert table.read_between("day", greatest="2018-01-01").inputFiles() == []


def test_update_where_keeps_what_it_does_not_change(spark, tmp_path):
    table = _dated(spark, tmp_path)
    before = table.manifest(table.version())
    table.update_where(F.col("n") == 3, {"n": F.lit(300)}, column="day", least="2020-01-01", greatest="2020-12-31")
    after = table.manifest(table.version())
    assert sum(before[b] != after[b] for b in before) == 1
    assert {(r.Codigo, r.n) for r in table.read().filter("n IN (3, 300)").collect()} == {("2019-3", 3), ("2020-3", 300), ("2021-3", 3)}
    same = table.manifest(table.version())
    table.update_where(F.col("n") == 12345, {"n": F.lit(0)})
    assert table.manifest(table.version()) == same and table.read().count() == 183
    table.update_where(F.col("n") < 0, {"n": F.lit(7)})
    assert table.read().filter("Id IS NULL AND n = 7").count() == 3


def test_few_keys_read_few_buckets(spark, tmp_path):
    table = _dated(spark, tmp_path)
    batch = spark.createDataFrame([("2020-5", 202007, None, 0), ("new", 999, None, 0), (None, None, None, 0)], DATED)
    rows = table.read_for(batch)
    buckets = {f.split("_bucket=")[1].split("/")[0] for f in rows.inputFiles()}
    assert len(buckets) <= 3
    found = {(r.Codigo, r.Id) for r in rows.collect()}
    assert {("2020-5", 202005), ("2020-7", 202007)} <= found
    # Entries of parts that are no longer in use lead nowhere.
    table.merge(batch, lambda part: part.withColumn("Id", F.lit(1)), spark.createDataFrame([], DATED))
    again = table.read_for(spark.createDataFrame([("zz", 202005, None, 0)], DATED))
    assert ("2020-5", 202005) not in {(r.Codigo, r.Id) for r in again.collect()}


def test_vacuum(spark, tmp_path):
    table = _dated(spark, tmp_path)
    table.merge(spark.createDataFrame([("2020-5", 1, None, 0)], DATED), lambda part: part, spark.createDataFrame([], DATED))
    want = sorted(map(str, table.read().collect()))
    older = sorted(map(str, table.read_version(3).collect()))
    gone = table.vacuum(keep=2)
    assert table.versions() == [3, 4] and [g for g in gone if g.startswith("commits/")]
    assert sorted(map(str, table.read().collect())) == want and sorted(map(str, table.read_version(3).collect())) == older
    table.vacuum(keep=1)
    assert table.versions() == [4] and sorted(map(str, table.read().collect())) == want


def test_a_version_belongs_to_its_writer(spark, tmp_path):
    one, two = _table(spark, tmp_path, writer="one"), _table(spark, tmp_path, writer="two")
    one.write(_rows(spark, [("a", 1)]), version=1)
    with pytest.raises(ValueError, match="another writer"):
        two.write(_rows(spark, [("a", 2)]), version=1)
    # A replayed batch finds its version done.
    assert one.write(_rows(spark, [("a", 1)]), version=1) == 1
    assert _found(two.read()) == [("a", 1)] and two.versions() == [1]


def test_unreadable_commits_are_an_error(spark, tmp_path):
    """A table that cannot be read is not an empty table."""
    table = _table(spark, tmp_path)
    table.write(_rows(spark, [("a", 1)]))
    (name,) = [n for n in os.listdir(f"{table.root}/commits") if n.endswith(".json")]
    with open(f"{table.root}/commits/{name}", "wb") as file:
        file.write(b"broken")
    with pytest.raises(ValueError):
        table.read().collect()
