"""Many files in one batch against one file after the other."""

import random

import pytest
from pyspark.sql import functions as F

from noticeflow.catalog import inputs
from noticeflow.operators import file_order
from noticeflow.operators.file_order import classify_in_order
from noticeflow.schema import FILE_ORDER, REGISTRY_SCHEMA
from noticeflow.sinks.snapshots import SnapshotTable
from noticeflow.streaming.ingest import ingest_batch, start_ingest, stream_notices
from test_runs import AS_OF, RUN, _dim, _raw

PAIRS = f"{FILE_ORDER} string, OpportunityId int, Codigo string, n int"
KNOWN = "OpportunityId int, Codigo string, ActaPublicada int, UrlActaDL string"


def one_by_one(rows, registry):
    """(n, label, document) of every row; each file sees what the files before it inserted."""
    known, out = list(registry), []
    for name in sorted({r[0] for r in rows}):
        own = [r for r in rows if r[0] == name]
        pairs = {(i, c) for _, i, c, _ in own if i is not None and c is not None}
        ids, codes = {i for i, _ in pairs}, {c for _, c in pairs}
        found = [k for k in known if k[0] in ids and k[1] in codes]
        existing = {p for p in pairs if p[0] in {k[0] for k in found} and p[1] in {k[1] for k in found}}
        old_ids, old_codes = {i for i, _ in existing}, {c for _, c in existing}
        waiting = [k for k in found if k[2] and k[0] in old_ids and k[1] in old_codes]
        wait_ids, wait_codes = {k[0] for k in waiting}, {k[1] for k in waiting}
        for _, i, c, n in own:
            if (i, c) not in pairs:
                label = "new"
            else:
                label = {2: "existing", 0: "new", 1: "conflict"}[(i in old_ids) + (c in old_codes)]
            kind = {2: "without_document", 0: "with_document", 1: "mixed"}[(i in wait_ids) + (c in wait_codes)]
            out.append((n, label, kind if label == "existing" else None))
            if label == "new":
                known.append((i, c, True))
    return sorted(out)


def _case(seed, files, per_file, ids, codes):
    rng = random.Random(seed)
    rows, n = [], 0
    for f in range(files):
        for _ in range(rng.randint(1, per_file)):
            i, c = rng.randrange(ids), f"c{rng.randrange(codes)}"
            rows.append((f"f{f:03d}", None if rng.random() < 0.05 else i, None if rng.random() < 0.05 else c, n))
            n += 1
    registry = [(rng.randrange(ids), f"c{rng.randrange(codes)}", rng.random() < 0.5) for _ in range(ids // 4)]
    return rows, registry


def _labels(spark, rows, registry):
    batch = spark.createDataFrame(rows, PAIRS)
    known = spark.createDataFrame([(i, c, 0 if w else 1, "") for i, c, w in registry], KNOWN)
    return sorted((r.n, r.label, r.document) for r in classify_in_order(batch, known).collect())


@pytest.mark.parametrize("seed, files, per_file, ids, codes", [(1, 30, 4, 8, 20), (2, 5, 30, 15, 15)])
def test_as_one_by_one(spark, seed, files, per_file, ids, codes):
    rows, registry = _case(seed, files, per_file, ids, codes)
    want = one_by_one(rows, registry)
    assert _labels(spark, rows, registry) == want
    assert {"new", "existing"} <= {label for _, label, _ in want}
    assert seed < 2 or "conflict" in {label for _, label, _ in want}


def test_split_hot_keys(spark, join_path):
    rows, registry = _case(3, 8, 8, 6, 25)
    assert _labels(spark, rows, registry) == one_by_one(rows, registry)


def test_a_thousand_files_take_few_rounds(spark, monkeypatch):
    """Each notice comes in three files; rounds do not follow the number of files."""
    rows = [(f"f{(i + 333 * k) % 1000:04d}", i, f"c{i}", 3 * i + k) for i in range(1000) for k in range(3)]
    calls, plain = [], file_order._label
    monkeypatch.setattr(file_order, "_label", lambda *args: calls.append(1) or plain(*args))
    assert _labels(spark, rows, []) == one_by_one(rows, [])
    assert len(calls) <= 3


def test_chain_of_files(spark):
    """Whether a file inserts depends on the file before it, down to the first."""
    rows = [(f"f{k}", k + j, f"c{k + j}", 2 * k + j) for k in range(6) for j in (0, 1)]
    want = one_by_one(rows, [])
    assert _labels(spark, rows, []) == want


def test_batch_gives_the_registry_of_file_by_file(spark, tmp_path):
    """Rows that are inserted by one file and updated by the next, in one batch and in many."""
    def notice(code, opp, text):
        return {"Código del expediente": str(code), "Dirección del anuncio": f"http://h/x?opportunityId={opp}", "Descripción del Anuncio": text}

    rng = random.Random(4)
    files = [[notice(c := rng.randrange(9), c if rng.random() < 0.8 else c + 1, f"{k}-{j}") for j in range(4)] for k in range(5)]
    schema = _raw(spark, {}).drop("_seq").schema
    dim, folder = _dim(spark), str(tmp_path / "in")
    for k, rows in enumerate(files):
        inputs.write_csv(_raw(spark, *rows).drop("_seq").coalesce(1), f"{folder}/{k}")
    one = SnapshotTable(spark, str(tmp_path / "one"), REGISTRY_SCHEMA, writer="one", index=["OpportunityId"])
    for k in range(len(files)):
        batch = spark.read.schema(schema).option("header", True).csv(f"{folder}/{k}").withColumn("source_file", F.lit(str(k)))
        ingest_batch(batch, k, one, dim, AS_OF, 1, str(tmp_path / "r1"), RUN)
    many = SnapshotTable(spark, str(tmp_path / "many"), REGISTRY_SCHEMA, writer="many")
    notices = stream_notices(spark, f"{folder}/*", schema)
    start_ingest(notices, many, dim, AS_OF, 1, str(tmp_path / "c"), str(tmp_path / "r2"), RUN).awaitTermination()
    assert many.versions() == [1] and len(one.versions()) == 5
    found = sorted(map(str, many.read().collect()))
    assert found == sorted(map(str, one.read().collect()))
    counts = [spark.read.parquet(str(tmp_path / r / "counts")).agg(F.sum("new"), F.sum("existing"), F.sum("conflict")).first() for r in ("r1", "r2")]
    assert counts[0] == counts[1] and counts[0][0] == len(found) and counts[0][1] > 0
