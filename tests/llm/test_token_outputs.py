import zlib

import numpy as np
import pandas as pd
import public_tokenizers
from brute import SMALL
from tokenizers import Tokenizer

from noticeflow.llm.packing import BITS, hilbert_keys, op8_curve_packing, pack
from noticeflow.llm.token_files import op10_token_files, read_token_files, write_token_files

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def encoded(path, text, end):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_of_given_documents(spark):
    docs = pd.read_parquet(f"{SMALL}/documents.parquet").sort_values("doc_id")
    tokenizer, start = Tokenizer.from_file(WORDS), 0
    got = {r.doc_id: r for r in op10_token_files(spark, SMALL).collect()}
    assert len(got) == len(docs)
    for doc_id, text in zip(docs.doc_id, docs.text):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        assert tuple(got[doc_id]) == (doc_id, start, len(ids), crc(ids))
        start += len(ids)


def test_token_files_defined_cases(spark, tmp_path):
    rows = [(5, "b", 1), (None, "z", 2), (-3, None, 3), (5, "a", 4), (9, "x " * 5000, 5), (5, "a", 6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(3)
    for vocabulary, width in ((49_408, 2), (70_000, 4)):
        folder = f"{tmp_path}/{vocabulary}"
        shards = write_token_files(frame, folder, WORDS, "words", 2, vocabulary)
        assert {s["width"] for s in shards} == {width}
        assert [s["base"] for s in shards] == np.cumsum([0, *[s["tokens"] for s in shards]])[:-1].tolist()
        got = sorted((r.start, r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in read_token_files(spark, folder).collect())
        want, start = [], 0
        for doc_id, text in [(None, "z"), (-3, None), (5, "a"), (5, "a"), (5, "b"), (9, "x " * 5000)]:
            ids = encoded(WORDS, text, 2)
            want.append((start, doc_id, ids))
            start += len(ids)
        assert got == want
    assert write_token_files(frame.limit(0), f"{tmp_path}/none", WORDS, "words", 2, 49_408) == []
    assert read_token_files(spark, f"{tmp_path}/none").count() == 0


def test_hilbert_neighbours_touch():
    """All cells of a small cube come once, each one step from the one before."""
    points = np.stack(np.meshgrid(*[np.arange(4)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    keys = hilbert_keys(points, 2)
    assert sorted(keys) == list(range(64))
    path = points[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
    assert hilbert_keys(np.full((1, 4), 2**BITS - 1), BITS)[0] < 2**60


def check_pieces(pieces, docs, end, length):
    ids = {i: encoded(BYTES, text, end) for i, text in docs}
    for doc_id, own in pieces.groupby("doc_id"):
        own, at = own.sort_values("start"), 0
        for r in own.itertuples():
            assert r.start == at and r.doc_tokens == len(ids[doc_id])
            part = ids[doc_id][at : at + r.length]
            assert r.ids_crc32 == crc(part) and len(part) == r.length
            at += r.length
        assert at == len(ids[doc_id])
    for _, own in pieces.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *own.length.cumsum()[:-1]]
        assert own.length.sum() <= length and int(own.length.sum()).bit_count() == 1


def test_packing_of_given_documents(spark):
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")
    pieces = op8_curve_packing(spark, SMALL).toPandas()
    assert set(pieces.doc_id) == set(docs.doc_id)
    check_pieces(pieces, list(zip(docs.doc_id, docs.text)), 0, 1024)


def test_packing_keeps_like_texts_together(spark):
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")
    pieces = op8_curve_packing(spark, SMALL).toPandas().merge(docs[["doc_id", "lang"]])
    order = pieces.sort_values(["sequence_id", "offset"]).drop_duplicates("doc_id").lang.tolist()
    same = np.mean([a == b for a, b in zip(order, order[1:])])
    shuffled = docs.lang.sample(frac=1, random_state=0).tolist()
    assert same > np.mean([a == b for a, b in zip(shuffled, shuffled[1:])]) + 0.1


def test_packing_defined_cases(spark):
    rows = [(1, None, 1), (2, "", 2), (3, "long text " * 900, 3), (4, "same", 4), (5, "same", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, place int").repartition(2)
    from pyspark.sql import functions as F

    pieces = pack(frame, BYTES, "spaced", 0, 50_257, 256).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    check_pieces(pieces.toPandas(), [(i, t) for i, t, _ in rows], 0, 256)
    twice = spark.createDataFrame([(None, "a b"), (None, "a b"), (7, "c")], "doc_id long, text string")
    got = pack(twice, BYTES, "spaced", 0, 50_257).collect()
    assert sum(r.length for r in got) == 3 + 3 + 2 and sum(r.doc_id is None for r in got) >= 2
    assert pack(frame.limit(0), BYTES, "spaced", 0, 50_257).count() == 0
