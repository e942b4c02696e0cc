"""Key semantics against brute force, on broadcast and on split joins."""

import random

import pytest
from pyspark.sql import functions as F

from noticeflow.operators import keys, lookup, match_files
from noticeflow.operators.project import contains_both, undocumented, union_distinct
from noticeflow.operators.skew import Hot, spread_join

BATCH = "OpportunityId int, Codigo string, note int"
REGISTRY = (
    "OpportunityId int, Codigo string, ActaPublicada int, UrlActaDL string, "
    "NombreArchivoActa string, FechaModificacion timestamp_ntz"
)


def _random(seed):
    rng = random.Random(seed)

    def key(n):
        # One key holds about a third of the rows; some are missing.
        return rng.choice([0, 0, 0, None, *range(1, n)])

    def code(n):
        value = key(n)
        return None if value is None else f"c{value}"

    batch = [(key(8), code(8), i) for i in range(rng.randint(0, 40))]
    registry = [
        (key(14), code(14), rng.choice([0, 1, None]), rng.choice(["", "", "p", None]), "n", None)
        for _ in range(rng.randint(0, 12))
    ]
    return batch, registry


def _values(rows, i):
    return {r[i] for r in rows if r[i] is not None}


def _semi(left, right):
    ids, codes = _values(right, 0), _values(right, 1)
    return [r for r in left if r[0] in ids and r[1] in codes]


def _anti(left, right):
    ids, codes = _values(right, 0), _values(right, 1)
    return [r for r in left if r[0] not in ids and r[1] not in codes]


def _model(batch, registry):
    """Labels by plain loops over lists."""
    pairs = [r for r in batch if r[0] is not None and r[1] is not None]
    hits = _semi(registry, pairs)
    existing = _semi(pairs, hits)
    ids, codes = _values(existing, 0), _values(existing, 1)
    open_rows = _semi([r for r in registry if r[2] == 0 and r[3] == ""], existing)
    open_ids, open_codes = _values(open_rows, 0), _values(open_rows, 1)
    out = []
    for r in batch:
        if r[0] is None or r[1] is None:
            out.append((*r, "new", None))
            continue
        known, waits = (r[0] in ids) + (r[1] in codes), (r[0] in open_ids) + (r[1] in open_codes)
        label = ["new", "conflict", "existing"][known]
        document = ["with_document", "mixed", "without_document"][waits]
        out.append((*r, label, document if label == "existing" else None))
    return out


def _rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def _sorted(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, join_path, seed):
    batch, registry = _random(seed)
    b, r = spark.createDataFrame(batch, BATCH), spark.createDataFrame(registry, REGISTRY)
    assert _rows(keys.semi_independent(b, r)) == _sorted(_semi(batch, registry))
    assert _rows(keys.anti_independent(b, r)) == _sorted(_anti(batch, registry))
    assert _rows(keys.classify(b, r)) == _sorted(_model(batch, registry))
    known = {t[:2] for t in registry if None not in t[:2]}
    assert _rows(keys.semi_tuple(b, r)) == _sorted(t for t in batch if t[:2] in known)
    assert _rows(keys.anti_tuple(b, r)) == _sorted(t for t in batch if t[:2] not in known)
    hits = _semi(registry, batch)
    assert _rows(keys.ask_registry(b, r)) == _sorted(_semi(batch, hits))


def test_two_hits_in_different_rows(spark, join_path):
    registry = [(1, "a", 0, "", "", None), (2, "b", 1, "p", "n", None)]
    batch = [(1, "b", 0), (2, "a", 1), (1, "z", 2), (9, "z", 3), (1, "b", 4)]
    b, r = spark.createDataFrame(batch, BATCH), spark.createDataFrame(registry, REGISTRY)
    labels = {t[2]: t[3:] for t in keys.classify(b, r).collect()}
    assert labels == {
        0: ("existing", "mixed"),
        4: ("existing", "mixed"),
        1: ("existing", "mixed"),
        2: ("conflict", None),
        3: ("new", None),
    }
    by_tuple = {t[2]: t[3] for t in keys.classify(b, r, match="tuple").collect()}
    assert by_tuple == dict.fromkeys(range(5), "new")


def test_labels_follow_from_the_operators(spark):
    batch, registry = _random(11)
    b = spark.createDataFrame([t for t in batch if None not in t[:2]], BATCH)
    r = spark.createDataFrame(registry, REGISTRY)
    labelled = keys.classify(b, r)
    existing = keys.ask_registry(b, r)
    without = keys.existing_without_document(existing, r)
    with_doc = keys.existing_with_document(existing, without)
    pick = labelled.filter(F.col("label") == "existing").select(*b.columns)
    assert _rows(pick) == _rows(existing)
    assert _rows(labelled.filter(F.col("label") == "new").select(*b.columns)) == _rows(
        keys.anti_independent(b, existing)
    )
    for name, frame in (("without_document", without), ("with_document", with_doc)):
        chosen = labelled.filter(F.col("document") == name).select(*b.columns)
        assert _rows(chosen) == _rows(frame)


def test_empty_registry_and_unknown_match(spark):
    b = spark.createDataFrame([(1, "a", 0)], BATCH)
    r = spark.createDataFrame([], REGISTRY)
    assert [t["label"] for t in keys.classify(b, r).collect()] == ["new"]
    with pytest.raises(ValueError):
        keys.classify(b, r, match="other")


def test_not_archived(spark):
    at = spark.sql("SELECT timestamp_ntz'2021-01-02 00:00:00' AS x").first()[0]
    old = at.replace(year=2020)
    doc = "x/proposiciones_1"
    registry = [(1, "a", 1, doc, doc, at), (2, "b", 1, doc, doc, old), (3, "c", 1, doc, "n", at)]
    batch = [(1, "z", 0), (2, "b", 1), (3, "c", 2), (9, "a", 3), (None, None, 4)]
    b, r = spark.createDataFrame(batch, BATCH), spark.createDataFrame(registry, REGISTRY)
    left = keys.not_archived(b, r, "2021-01-01 00:00:00")
    assert sorted(t["note"] for t in left.collect()) == [1, 2, 4]
    assert contains_both(r, "proposiciones_", "UrlActaDL", "NombreArchivoActa").count() == 2


def test_hot_keys_are_split_and_results_whole(spark, join_path):
    rows = [(7, f"c{i}", i) for i in range(200)] + [(i, "x", i) for i in range(20)]
    left = spark.createDataFrame(rows, BATCH)
    right = spark.createDataFrame([(7, "seven"), (3, "three")], "OpportunityId int, v string")
    if join_path == "spread":
        assert [t[0] for t in Hot(left, ["OpportunityId"]).keys.collect()] == [7]
    else:
        assert Hot(left, ["OpportunityId"]).keys is None
    joined = spread_join(left, right, ["OpportunityId"], "left", ["Codigo"])
    assert joined.count() == 220
    assert joined.filter("v = 'seven'").count() == 201
    if join_path == "spread":
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        used = {
            t[0]
            for t in joined.filter("v = 'seven'").select(F.spark_partition_id()).distinct().collect()
        }
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        assert len(used) > 1


def test_copies_are_spread(spark, join_path):
    left = spark.createDataFrame([(7, "same", 1)] * 400, BATCH).repartition(8)
    right = spark.createDataFrame([(7, "seven")], "OpportunityId int, v string")
    joined = spread_join(left, right, ["OpportunityId"])
    assert joined.count() == 400
    if join_path == "spread":
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        used = spread_join(left, right, ["OpportunityId"]).select(F.spark_partition_id())
        assert used.distinct().count() > 1
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_rows_without_a_key_are_spread(spark, join_path):
    left = spark.createDataFrame([(None, "x", i) for i in range(50)] + [(1, "x", 99)], BATCH)
    right = spark.createDataFrame([(1, "one")], "OpportunityId int, v string")
    assert spread_join(left, right, ["OpportunityId"], "left_anti").count() == 50
    if join_path == "spread":
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        kept = spread_join(left, right, ["OpportunityId"], "left_anti")
        used = kept.select(F.spark_partition_id()).distinct().count()
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        assert used > 1


def test_undocumented_and_union(spark):
    rows = [(1, "a", 0, "", "", None), (2, "b", 0, None, "", None), (3, "c", None, "", "", None)]
    r = spark.createDataFrame(rows, REGISTRY)
    assert [t[0] for t in undocumented(r).collect()] == [1]
    assert union_distinct(r, r.limit(0)).count() == 3
    assert union_distinct(r, r).count() == 3


# --- lookup -------------------------------------------------------------------
def test_states(spark, join_path):
    dim = spark.createDataFrame(
        [("ESTADO DE MEXICO", 15), ("COLIMA", 6), (None, 0)], "Estado string, IdEstado int"
    )
    rows = spark.createDataFrame([("MEXICO",), ("COLIMA",), ("X",), (None,)], "IdEstado string")
    assert _rows(lookup.map_states(rows, dim)) == _sorted([("15",), ("06",), (None,), (None,)])
    compat = lookup.map_states(rows, dim, compat_nan=True)
    assert _rows(compat) == _sorted([("15",), ("06",), ("nan",), ("nan",)])
    twice = dim.unionByName(dim.filter("Estado = 'COLIMA'"))
    with pytest.raises(Exception, match="duplicate name"):
        lookup.map_states(rows, twice).collect()


# --- files --------------------------------------------------------------------
FILES = [
    "d/proposiciones_1_20_202101_2.pdf", "d/proposiciones_1_20_202101_1.pdf", "d/proposiciones_1_203_202101_1.pdf",
    "d/proposiciones_2_20_202101_1.pdf", "d/other_1_20_202101_1.pdf", "d/proposiciones_3_30_202101",
]


def test_document_match(spark, join_path):
    files = spark.createDataFrame([(f,) for f in FILES], "path string")
    wanted = [(1, "20"), (1, "2"), (1, "203"), (3, "30"), (1, "20"), (None, "20"), (4, "1")]
    pending = spark.createDataFrame(wanted, "OpportunityId int, Codigo string")
    exact = match_files.match_documents(pending, files)
    first = FILES[1]
    assert _rows(exact) == _sorted(
        [(1, "20", first), (1, "2", None), (1, "203", FILES[2]), (3, "30", None), (1, "20", first),
         (None, "20", None), (4, "1", None)]
    )
    prefix = match_files.match_documents(pending, files, match="prefix")
    # A code also finds files of longer codes; the first by path is taken.
    longer = FILES[2]
    assert _rows(prefix) == _sorted(
        [(1, "20", longer), (1, "2", longer), (1, "203", longer), (3, "30", None), (1, "20", longer),
         (None, "20", None), (4, "1", None)]
    )


def test_prefix_match_of_a_hot_id(spark, join_path):
    """Most files carry one id, whose codes have several lengths."""
    files = [(f"d/proposiciones_1_{'ab' * (i % 4)}c_20210{i % 9}_{i}.pdf",) for i in range(200)]
    files += [("d/proposiciones_2_x_202101_1.pdf",), ("d/proposiciones_3_x_202101_1.pdf",)]
    pending = [(1, "ab"), (1, "abab"), (1, "c"), (1, "zz"), (2, "x"), (2, "xx"), (4, "x"), (None, "x"), (1, None)]
    found = match_files.match_documents(
        spark.createDataFrame(pending, "OpportunityId int, Codigo string"),
        spark.createDataFrame(files, "path string"), "prefix",
    )

    def first(i, c):
        own = [p for (p,) in files if i is not None and c is not None and p.startswith(f"d/proposiciones_{i}_{c}")]
        return min(own, default=None)

    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(str((i, c, first(i, c))) for i, c in pending)


def test_names_present(spark, join_path):
    objects = spark.createDataFrame([("a/xy.pdf",), ("b/z",)], "name string")
    wanted = spark.createDataFrame([("a/x",), ("b/z",), ("b/zz",), ("q",)], "name string")
    assert _rows(match_files.names_present(wanted, objects)) == [("a/x",), ("b/z",)]
    assert _rows(match_files.names_present(wanted, objects, exact=True)) == [("b/z",)]


def test_names_present_across_ranges(spark, join_path):
    """Objects that stand in later ranges than the name they start with; copies and NULLs."""
    import random

    rng = random.Random(6)
    names = ["".join(rng.choice("ab/é😀") for _ in range(rng.randint(0, 4))) for _ in range(300)] + [None, "zz", "zz"]
    stored = ["".join(rng.choice("ab/é😀") for _ in range(rng.randint(1, 9))) for _ in range(60)] + [None, "zz"]
    wanted = spark.createDataFrame([(n,) for n in names], "name string")
    objects = spark.createDataFrame([(n,) for n in stored], "name string")
    want = [(n,) for n in names if n is not None and any(o.startswith(n) for o in stored if o is not None)]
    assert _rows(match_files.names_present(wanted, objects)) == sorted(want)
    assert match_files.names_present(wanted, objects.limit(0)).count() == 0
    assert match_files.names_present(wanted.limit(0), objects).count() == 0


def test_a_key_of_more_ways_than_any_fixed_number(spark, join_path):
    """A key is split by its own count; every row finds its match, also among copies."""
    rows = [(1, i % 50) for i in range(3000)] + [(2, i) for i in range(4)] + [(None, 0)] * 20
    left = spark.createDataFrame(rows, "k int, v int").repartition(3)
    right = spark.createDataFrame([(1, "a"), (3, "c")], "k int, w string")
    joined = spread_join(left, right, ["k"])
    assert joined.count() == len(rows)
    assert joined.filter("w = 'a'").count() == 3000 and joined.filter("w IS NULL").count() == 24
    if join_path == "spread":
        (ways,) = [r["_ways"] for r in Hot(left, ["k"]).keys.collect() if r.k == 1]
        assert ways == 1000
