"""Operator 9: the languages of a text as a mixture, by expectation-maximisation.

Training counts byte n-grams (1 to ``ORDERS`` bytes of letter runs in lower case, bounded by
blanks; beyond ASCII, other characters stand among them) per known language over all training rows; n-grams are hashed to
``CELLS`` cells per order, so a model has a fixed size per language. Counts are summed by
Spark; only the summed model reaches the driver and is sent to the tasks.

A text's n-grams are taken as drawn from a mixture of the languages. EM estimates the
proportions; then languages leave the set one by one, the weakest first, as long as the
log likelihood, less ``PENALTY * log(n)`` per language, does not fall. What is left is the
text's set of languages with their proportions; the largest is the prediction and its
proportion the score. Proportions are per effective n-gram: overlapping n-grams of
several orders repeat what they say, so likelihoods are divided by ``ORDERS``.

Defined cases: NULL text, and text without a letter, gives ``und`` with score 0 and no
languages; equal proportions go to the language that sorts first; without training rows
everything is ``und``; rows of equal doc_id are rows of their own; a NULL doc_id is in
training and not held out; rows with NULL lang or text train nothing; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, give_back, table, text_chunks
from .registry import query

ORDERS, CELLS = 4, 1 << 14
ROUNDS, PENALTY, SMOOTHING = 12, 3.0, 0.5
# ASCII letters in lower case, blanks for the rest of ASCII, all other bytes as they are.
_FOLDED = bytes(c if chr(c).isalpha() or c >= 0x80 else 32 for c in bytes(range(256)).lower())
_STEP = 1 << 20
_FACTOR, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(65 - CELLS.bit_length())
_SETTLED = 1e-4


def _letters(text: str | None) -> bytes:
    """Letter runs in lower case, each between single blanks; empty without letters."""
    if not text:
        return b""
    folded = (text if text.isascii() else text.lower()).encode()
    kept = b" ".join(folded.translate(_FOLDED).split())
    if not kept or not kept.isascii() and not any(c.isalpha() for c in text):
        return b""
    return b" " + kept + b" "


def _cells(letters: bytes) -> np.ndarray:
    """The cells of a text's n-grams, all orders, those of blanks alone left out."""
    data = np.frombuffer(letters, np.uint8).astype(np.uint64)
    gram, found = np.zeros(len(data), np.uint64), []
    for order in range(1, ORDERS + 1):
        n = len(data) - order + 1
        if n <= 0:
            break
        gram = (gram[:n] << np.uint64(8)) | data[order - 1 :]
        cell = (gram * _FACTOR >> _SHIFT).astype(np.int64) + (order - 1) * CELLS
        found.append(cell[data != 32] if order == 1 else cell)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _counted(letters: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells of a text and how often each occurs, long texts in steps."""
    total = np.bincount(_cells(letters[: _STEP + ORDERS - 1]), minlength=ORDERS * CELLS)
    for at in range(_STEP, len(letters), _STEP):
        total += np.bincount(_cells(letters[at : at + _STEP + ORDERS - 1]), minlength=len(total))
    cells = np.flatnonzero(total > 0)
    return cells, total[cells]


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and their log probabilities per cell, from rows (text, lang)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in text_chunks(batches):
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                if letters := _letters(text):
                    own = sums.setdefault(lang, np.zeros(ORDERS * CELLS, np.int64))
                    cells, counts = _counted(letters)
                    own[cells] += counts
        for lang, own in sums.items():
            cells = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(cells)), pa.array(cells), pa.array(own[cells])],
                names=["lang", "cell", "n"],
            )

    known = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    counted = known.mapInArrow(count, "lang string, cell long, n long")
    rows = counted.groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows.lang.unique())
    model = np.full((len(languages), ORDERS, CELLS), SMOOTHING)
    at = {lang: i for i, lang in enumerate(languages)}
    cells = rows.cell.to_numpy(np.int64)
    model[rows.lang.map(at).to_numpy(np.int64), cells // CELLS, cells % CELLS] += rows.n.to_numpy()
    model = np.log(model / model.sum(axis=2, keepdims=True))
    return languages, model.reshape(len(languages), ORDERS * CELLS)


def _fit(ratio: np.ndarray, counts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, float]:
    """EM over the chosen languages: proportions and log likelihood."""
    part = ratio[chosen]
    share = np.full(len(chosen), 1.0 / len(chosen))
    total = counts.sum()
    for _ in range(ROUNDS if len(chosen) > 1 else 0):
        new = share * (part @ (counts / (share @ part))) / total
        moved, share = np.abs(new - share).max(), new
        if moved < _SETTLED:
            break
    return share, float(counts @ np.log(np.maximum(share @ part, 1e-300)))


def infer(model: np.ndarray, letters: bytes) -> dict[int, float]:
    """The text's languages and their proportions."""
    cells, counts = _counted(letters)
    counts = counts / ORDERS
    log = model[:, cells]
    ratio = np.exp(log - log.max(axis=0))
    price = PENALTY * np.log(1.0 + counts.sum())
    chosen = np.arange(len(model))
    share, likelihood = _fit(ratio, counts, chosen)
    while len(chosen) > 1:
        fewer = np.delete(chosen, np.argmin(share))
        new_share, new_likelihood = _fit(ratio, counts, fewer)
        if new_likelihood + price < likelihood:
            break
        chosen, share, likelihood = fewer, new_share, new_likelihood
    return dict(zip(chosen.tolist(), share.tolist()))


_PREDICTED = "lang_pred string, score double, languages array<struct<lang: string, share: double>>"
_MIX = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))


def identify(
    docs: DataFrame, languages: list[str], model: np.ndarray, name: str = "language"
) -> DataFrame:
    """The rows with a struct column ``name``: lang_pred, score and the shares of all found.

    A column of that name is replaced. Only texts travel to Python.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model.astype(np.float32))

    @F.arrow_udf(_PREDICTED)
    def predict(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights = sent.value.astype(np.float64)
        for part in parts:
            names, scores, mixes = [], [], []
            for text in part.to_pylist():
                letters = _letters(text)
                found = infer(weights, letters) if letters and languages else {}
                order = sorted(found, key=lambda i: (-found[i], i))
                names.append(languages[order[0]] if order else "und")
                scores.append(min(1.0, found[order[0]]) if order else 0.0)
                mixes.append([{"lang": languages[i], "share": found[i]} for i in order])
            columns = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(mixes, _MIX)]
            yield pa.StructArray.from_arrays(columns, names=["lang_pred", "score", "languages"])
        give_back()

    return docs.withColumn(name, predict("text"))


def fold(docs: DataFrame, divisor: int = 4, held: int = 2) -> DataFrame:
    return docs.withColumn("held_out", crc_mod("doc_id", divisor) == held)


@query("op9_language_mixture")
def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fold(table(spark, sf_dir, "documents"))
    languages, model = train(docs.filter(~F.col("held_out")))
    found = identify(docs, languages, model)
    return found.select("doc_id", "held_out", "language.lang_pred", "language.score")
