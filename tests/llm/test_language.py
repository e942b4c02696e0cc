import numpy as np
import pandas as pd

from noticeflow.llm.language import fold, identify, op9_language_mixture, train

from brute import SMALL, crc_mod


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = pd.read_parquet(f"{folder}/documents.parquet").set_index("doc_id").lang
    found = op9_language_mixture(spark, folder).toPandas()
    assert len(found) == len(truth)
    assert (found.held_out == (found.doc_id.map(lambda i: crc_mod(i, 4)) == 2)).all()
    held = found[found.held_out]
    assert (held.lang_pred == held.doc_id.map(truth)).mean() > 0.97
    assert found.score.between(0, 1).all()


def test_mixture_of_two(spark):
    """A text that joins two languages gets both, in proportion."""
    frame = pd.read_parquet(f"{SMALL}/documents.parquet")
    docs = spark.createDataFrame(frame[["doc_id", "text", "lang"]])
    languages, model = train(docs)
    en = " ".join(frame[frame.lang == "en"].text)[:9000]
    de = " ".join(frame[frame.lang == "de"].text)[:3000]
    rows = [(1, en + " " + de), (2, en), (3, de)]
    got = identify(spark.createDataFrame(rows, "doc_id long, text string"), languages, model).collect()
    mixes = {r.doc_id: {x.lang: x.share for x in r.language.languages} for r in got}
    assert set(mixes[1]) == {"en", "de"} and 0.15 < mixes[1]["de"] < 0.35
    assert set(mixes[2]) == {"en"} and set(mixes[3]) == {"de"}


def test_defined_cases(spark):
    rows = [(1, "the and of the", "en", 7), (None, "der und die", "de", 8), (3, None, "en", 9), (4, "12 _ 3!", None, 1), (5, "", "de", 2)]
    docs = fold(spark.createDataFrame(rows, "doc_id long, text string, lang string, score int"))
    assert [r.held_out for r in docs.collect()][1] is False
    languages, model = train(docs)
    assert languages == ["de", "en"]
    assert np.allclose(np.exp(model.reshape(2, 4, -1)).sum(axis=2), 1)
    got = {r["score"]: (r.language.lang_pred, r.language.score) for r in identify(docs, languages, model).collect()}
    assert got[7][0] == "en" and got[8][0] == "de"
    assert got[9] == got[1] == got[2] == ("und", 0.0)
    empty = docs.limit(0)
    languages, model = train(empty)
    assert languages == [] and identify(empty, languages, model).count() == 0
    assert {r.language.lang_pred for r in identify(docs, languages, model).collect()} == {"und"}


def test_proportions_settle():
    """One more step of EM moves no proportion by more than a ten-thousandth."""
    import numpy as np

    from noticeflow.llm.language import _fit

    ratio, counts = np.array([[1.0, 0.2], [0.2, 1.0]]), np.array([60.0, 40.0])
    share, _ = _fit(ratio, counts, np.arange(2))
    again = share * (ratio @ (counts / (share @ ratio))) / counts.sum()
    assert np.abs(again - share).max() < 1e-4
