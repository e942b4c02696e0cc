"""Records of split files against Python's csv module."""

import csv
import io
import random

import pytest

from noticeflow.sources.records import read_records


@pytest.fixture
def split_small(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _file(path, seed, rows, cell):
    rng = random.Random(seed)
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(["a", "b"])
        for i in range(rows):
            text = "".join(rng.choice(['x', 'é', '"', '""', "\n", "\n\n", ",", "\r\n", "y" * 30]) for _ in range(rng.randint(0, cell)))
            writer.writerow([str(i), text])


@pytest.mark.parametrize("broadcast", [True, False])
def test_records_of_split_files(spark, tmp_path, split_small, broadcast):
    if not broadcast:
        spark.conf.set("spark.noticeflow.broadcastRows", "0")
    for k, (rows, cell) in enumerate([(200, 6), (3, 400), (60, 40), (1, 1), (0, 0)]):
        _file(tmp_path / f"{k}.csv", k, rows, cell)
    found, files = read_records(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() > 10
    names = {f.file: f.path for f in files.collect()}
    rows = sorted(found.collect(), key=lambda r: (names[r.file], r.seq))
    assert all(r.whole for r in rows) and {f.first for f in files.collect()} == {"a,b"}
    for file, path in names.items():
        own = [r for r in rows if r.file == file]
        assert len({r.seq for r in own}) == len(own)
        with open(path.split(":", 1)[1], newline="") as raw:
            want = list(csv.reader(io.StringIO(raw.read(), newline="")))
        got = [next(csv.reader(io.StringIO(r.record, newline=""))) for r in own]
        assert got == want
    spark.conf.unset("spark.noticeflow.broadcastRows")


def test_quotes_that_never_close(spark, tmp_path, split_small):
    text = "a,b\n1,x\n2,\"open\n" + "more text in the last cell\n" * 100
    (tmp_path / "a.csv").write_text(text)
    found, _ = read_records(spark, str(tmp_path))
    rows = sorted(found.collect(), key=lambda r: r.seq)
    assert [r.whole for r in rows] == [True, True, False]
    assert "\n".join(r.record for r in rows) == text.removesuffix("\n")
