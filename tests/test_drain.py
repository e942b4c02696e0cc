"""A drain of the pending queue ends, and lists what it gave up."""

from pyspark.sql import functions as F

from noticeflow.plans import pending
from noticeflow.plans.pending import drain_pending
from noticeflow.schema import REGISTRY_SCHEMA

OUTCOME = (
    "OpportunityId int, Codigo string, seq int, page_status int, n_links int, link_pieces int, "
    "file_status int, stored boolean, uploaded boolean, error string, ext string, source_file string"
)


def _registry(spark):
    blank = {f.name: None for f in REGISTRY_SCHEMA}
    kinds = {"ok": (0, 0), "none": (0, 0), "bad": (0, 0), "late": (0, 0), "lost": (1, 0), "filed": (1, 0), "done": (1, 1)}
    rows = [
        {**blank, "OpportunityId": i, "Codigo": code, "ActaPublicada": published, "Url_visitada": visited, "UrlActaDL": "x" if code == "done" else ""}
        for i, (code, (published, visited)) in enumerate(kinds.items())
    ]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def _fetch(spark, asked):
    """ok: fetched and uploaded at once; none: no document; late: fetched in pass 2, never uploaded; bad: fails."""

    def fetch(queue, n):
        asked.append(sorted(r.Codigo for r in queue.collect()))
        rows = [
            (0, "ok", n, 200, 1, 3, 200, True, True, None, "pdf", "f"),
            (1, "none", n, 200, 0, 3, 200, False, False, None, "pdf", "f"),
            (2, "bad", n, 500, 1, 3, 200, False, False, None, "pdf", "f"),
            (3, "late", n, 200 if n > 1 else 500, 1, 3, 200, True, False, None, "pdf", "f"),
            (6, "done", n, 200, 1, 3, 200, True, True, None, "pdf", "f"),
        ]
        return spark.createDataFrame(rows, OUTCOME)

    return fetch


def test_drain(spark):
    asked, files = [], spark.createDataFrame([("data/proposiciones_5_filed_202103_1.pdf",)], "path string")
    drain = drain_pending(_registry(spark), files, _fetch(spark, asked), F.lit("202103"), "2021-03-02 09:00:00", most=3)
    dead = {(r.Codigo, r.pending, r.attempts) for r in drain.dead.collect()}
    assert dead == {("bad", "download", 3), ("lost", "upload", 3), ("late", "upload", 3)}
    assert asked[:3] == [["bad", "late", "none", "ok"], ["bad", "late"], ["bad"]] and not any(asked[3:])
    assert drain.passes == 5 and len(drain.entries) == 5
    state = {r.Codigo: (r.ActaPublicada, r.Url_visitada, r.UrlActaDL != "") for r in drain.registry.collect()}
    assert state == {
        "ok": (1, 1, True), "none": (0, 1, False), "bad": (0, 0, False), "late": (1, 1, False),
        "lost": (1, 0, False), "filed": (1, 0, True), "done": (1, 1, True),
    }
    assert {r.Codigo for e in drain.entries for r in e.collect()} == {"ok", "bad", "none", "late"}


def test_attempts_of_an_earlier_drain_count(spark):
    files = spark.createDataFrame([], "path string")
    first = drain_pending(_registry(spark), files, _fetch(spark, []), F.lit("202103"), "2021-03-02 09:00:00", most=1)
    assert first.passes == 1
    asked = []
    again = drain_pending(
        first.registry, files, _fetch(spark, asked), F.lit("202103"), "2021-03-02 09:00:00", most=2, attempts=first.attempts
    )
    assert asked[0] == ["bad", "late"] and again.passes <= 3
    assert {r.Codigo for r in again.dead.collect()} >= {"bad", "lost"}
    done = drain_pending(again.registry, files, _fetch(spark, asked), F.lit("202103"), "2021-03-02 09:00:00", most=2, attempts=again.attempts)
    assert done.passes == 0 and done.dead.count() == again.dead.count()


def test_passes_read_and_write_what_waits(spark, monkeypatch):
    """Files are matched once, and settled notices are not written again in any pass."""
    matched, wrote = [], []
    plain, write = pending.match_documents, pending.write_once
    monkeypatch.setattr(pending, "match_documents", lambda *args: matched.append(1) or plain(*args))

    def noted(frame, name="step"):
        done = write(frame, name)
        wrote.append((name, done.frame.count()))
        return done

    monkeypatch.setattr(pending, "write_once", noted)
    registry = _registry(spark)
    settled = registry.filter("Codigo = 'done'")
    for i in range(20):
        registry = registry.unionByName(settled.withColumn("Codigo", F.lit(f"done{i}")))
    files = spark.createDataFrame([("data/proposiciones_5_filed_202103_1.pdf",)], "path string")
    drain = drain_pending(registry, files, _fetch(spark, []), F.lit("202103"), "2021-03-02 09:00:00", most=3)
    assert drain.registry.count() == 27 and drain.registry.columns == registry.columns and drain.dead.count() == 3
    assert len(matched) == 1
    assert max(n for name, n in wrote if name == "registry") == 6


def test_notices_without_a_key_end(spark):
    registry = _registry(spark).filter("Codigo = 'bad'").withColumn("Codigo", F.lit(None).cast("string"))
    files = spark.createDataFrame([], "path string")
    drain = drain_pending(registry, files, _fetch(spark, []), F.lit("202103"), "2021-03-02 09:00:00", most=2)
    assert [(r.OpportunityId, r.Codigo, r.pending, r.attempts) for r in drain.dead.collect()] == [(2, None, "download", 2)]
    assert drain.registry.count() == 1
