import pandas as pd
import pyarrow as pa
import pytest
from brute import SMALL, hamming_groups, repeats, simhash, words

import corpus_pipeline
from corpus_pipeline import STAGES, run

from pyspark.sql import functions as F
from tokenizers import Tokenizer
import public_tokenizers


def _frame(docs):
    return docs.toPandas().sort_values("doc_id").reset_index(drop=True)


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """The rows each stage got and gave, on the small tables with some odd rows added."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = [(10**6, "12 !!", "en", "src0", 5), (10**6 + 1, None, "en", "src0", 0), (10**6 + 2, "", None, None, 0)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    folder, out = tmp_path_factory.mktemp("stages"), [docs]
    for name, stage in STAGES:
        stage(spark, out[-1], SMALL).write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return out


def test_columns(results):
    for frame in results[1:5]:
        assert frame.dtypes == results[0].dtypes


def test_language_keeps_what_has_one(results):
    before, after = _frame(results[0]), _frame(results[1])
    assert set(before.doc_id) - set(after.doc_id) == {10**6, 10**6 + 1, 10**6 + 2}
    assert after.equals(before[before.doc_id < 10**6].reset_index(drop=True))


def test_one_of_each_group_stays(results):
    before, after = _frame(results[1]), _frame(results[2])
    roots = hamming_groups([simhash(t) for t in before.text])
    want = before.groupby(roots).doc_id.min()
    assert after.doc_id.tolist() == sorted(want)
    assert after.merge(before, how="inner").shape[0] == len(after)


def test_repeats_are_cut(results):
    before, after = _frame(results[2]), _frame(results[3])
    want = repeats(list(zip(before.doc_id, before.text)))
    assert after.doc_id.tolist() == before.doc_id.tolist()
    for old, new, n, doc_id in zip(before.text, after.text, after.n_chars, before.doc_id):
        assert len(words(new)) == want[doc_id][0] - want[doc_id][1]
        assert n == len(new)
        assert new == old if not want[doc_id][1] else True


def test_mix_takes_what_it_says(spark, results):
    from noticeflow.llm.mixing import mix

    before, after = results[3], results[4].toPandas()
    plan = {r.doc_id: r for r in mix(before).collect()}
    texts = {r.doc_id: r.text for r in before.collect()}
    got = after.groupby("doc_id").text.apply(list).to_dict()
    assert set(got) == {i for i, r in plan.items() if r.taken}
    for doc_id, own in got.items():
        assert sum(len(words(t)) for t in own) == plan[doc_id].taken
        for text in own:
            whole = text == texts[doc_id]
            assert whole or text.split(" ") == words(texts[doc_id])[: len(words(text))]


def test_pieces_hold_every_id_once(spark, results):
    docs, pieces = results[4].toPandas(), results[5].toPandas()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = [len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in docs.text]
    assert pieces.length.sum() == sum(sizes)
    for _, own in pieces.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *own.length.cumsum()[:-1]]
        total = own.length.sum()
        assert total == 1024 or total & (total - 1) == 0


def test_run_is_all_stages(spark, results):
    got = run(spark, SMALL).toPandas()
    want = results[5].toPandas()
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert got.length.sum() == want.length.sum() and set(got.columns) == set(want.columns)
    assert set(got.doc_id) == set(want.doc_id)
    assert got.groupby(key[:1]).length.sum().equals(want.groupby(key[:1]).length.sum())


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0


def test_repeated_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(20)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs.union(docs), SMALL)
    assert kept.count() == kept.select("doc_id").distinct().count()


def test_clashing_columns(spark):
    """Columns with the names the stages use inside come through untouched."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(30)
    names = ["language", "tie", "kept", "size", "taken", "_c0", "c0", "key", "range", "held_out", "_text"]
    wide = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for _, stage in STAGES[:4]:
        wide = stage(spark, wide, SMALL)
        assert wide.columns == [*docs.columns, *names]
    rows = wide.collect()
    assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)
