"""Operator 6: remove word windows that occurred before, by recompression.

1. Every task recompresses its documents (``recompress``) and sends each entry's name with
   its place once per batch; names that repeat inside a batch are known to be shared there
   and send a single row, so no name can fill a task. Spark sorts the rows by name, and
   entries whose name occurs elsewhere go back to their documents.
2. Windows all of whose entries are shared are the candidates. They are verified by
   128-bit hashes of their words: of equal windows, the first in the order of documents
   and words is found, again once per batch and task. The firsts and the stretches of
   candidates go back to their documents; candidates that are not the first are repeats,
   and the words they cover are removed.

Documents stand in the order of doc_id, then of a hash of the text; rows equal in both
count as one document and are treated alike. Windows are judged on the input.

Defined cases: NULL text has no words; NULL doc_id comes last, like the largest number;
fewer words than a window are all kept; an empty table gives no rows; other columns,
whatever their names, may be carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written
from .common import mixed, spans, split_words, table, text_chunks, texts
from .recompress import Recompressed
from .registry import query

WINDOW = 20
_OWN, _KNOWN, _MARK = 0, 1, 2
_ENTRY = "name long, kind byte, d long, tie long, place long"


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("d").to_numpy(), batch.column("tie").to_numpy()


def _send_entries(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "t"):
            _, lengths, hashes = split_words(batch.column("t"))
            name, number, place = Recompressed(hashes, lengths, window).entries()
            order = np.argsort(name, kind="stable")
            name, number, place = name[order], number[order], place[order]
            same = name[1:] == name[:-1]
            before, after = np.concatenate([[False], same]), np.concatenate([same, [False]])
            before, after = before[: len(name)], after[: len(name)]
            d, tie = (k[number] for k in _keys(batch))
            kind = np.where(before | after, _KNOWN, _OWN).astype(np.int8)
            marks = np.flatnonzero(after & ~before)
            # What is known already only has to go home; it is spread by its own place.
            home = mixed(tie.view(np.uint64) + place.astype(np.uint64))
            sent = np.where(kind == _KNOWN, home, name)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([sent, name[marks]]).view(np.int64)),
                    pa.array(np.concatenate([kind, np.full(len(marks), _MARK, np.int8)])),
                    *(pa.array(np.concatenate([v, np.zeros(len(marks), np.int64)])) for v in (d, tie, place)),
                ],
                names=["name", "kind", "d", "tie", "place"],
            )

    return run


def _shared_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by name, those whose name another row has too."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        name, kind = batch.column("name").to_numpy(), batch.column("kind").to_numpy()
        same = name[1:] == name[:-1]
        goes_on = held is not None and held.column("name")[0].as_py() == name[0]
        before = np.concatenate([[goes_on], same])
        keep = before | np.concatenate([same, [False]]) | (kind == _KNOWN)
        keep &= kind != _MARK
        if goes_on and held.column("kind")[0].as_py() == _OWN:
            yield held.select(["d", "tie", "place"])
        yield batch.filter(pa.array(keep)).select(["d", "tie", "place"])
        held = batch.slice(batch.num_rows - 1)
        if before[-1]:
            # It went out with this batch; only its name still matters.
            held = held.set_column(1, "kind", pa.array([_KNOWN], pa.int8()))


def _candidates(batch: pa.RecordBatch, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per document, hashes of words, and the first words of the candidates."""
    _, lengths, hashes = split_words(batch.column("t"))
    parsed = Recompressed(hashes, lengths, window)
    _, number, place = parsed.entries()
    places = batch.column("places")
    row = np.repeat(np.arange(len(places)), places.value_lengths().to_numpy())
    width = 2 * int(lengths.max(initial=0)) + 2
    shared = np.isin(number * width + place, row * width + places.flatten().to_numpy())
    return lengths, hashes, parsed.windows(shared)


def _window_hashes(hashes: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each window: two sums of its words' hashes with odd factors."""
    factors = np.random.default_rng(6).integers(0, 2**63, (2, window), np.uint64) * np.uint64(2) + np.uint64(1)
    other = mixed(hashes ^ np.uint64(0x2545F4914F6CDD1D))
    one, two = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(window):
            one += mixed(hashes[starts + i]) * factors[0, i]
            two += other[starts + i] * factors[1, i]
    return mixed(one), mixed(two)


def _send_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "t"):
            lengths, hashes, starts = _candidates(batch, window)
            row, place = spans(lengths)
            one, two = _window_hashes(hashes, starts, window)
            d, tie = (k[row[starts]] for k in _keys(batch))
            place = place[starts]
            order = np.lexsort((place, tie, d, two, one))
            one, two = one[order], two[order]
            new = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])[: len(order)]
            first = order[new]
            # Stretches of candidates go home as well, spread by their own place.
            apart = (np.diff(starts) != 1) | (np.diff(row[starts]) != 0)
            begin = np.flatnonzero(np.concatenate([[True], apart])[: len(starts)])
            count = np.diff(np.append(begin, len(starts)))
            home = mixed(tie[begin].view(np.uint64) ^ d[begin].view(np.uint64) + place[begin].astype(np.uint64))
            columns = [
                np.concatenate([one[new].view(np.int64), home.view(np.int64)]),
                np.concatenate([two[new].view(np.int64), place[begin]]),
                np.concatenate([d[first], d[begin]]),
                np.concatenate([tie[first], tie[begin]]),
                np.concatenate([place[first], place[begin] | count << 32]),
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], names=["one", "two", "d", "tie", "place"]
            )

    return run


def _first_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by hash and order, the first of each hash, and all stretches."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        one, two = batch.column("one").to_numpy(), batch.column("two").to_numpy()
        new = np.concatenate([[last != (one[0], two[0])], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
        last = (one[-1], two[-1])
        new |= batch.column("place").to_numpy() >= 1 << 32
        yield batch.filter(pa.array(new)).select(["d", "tie", "place"])


def _removed(found: pa.Array, lengths: np.ndarray, window: int) -> np.ndarray:
    """Which words of documents end to end are covered by repeats.

    ``found`` lists a document's stretches of candidates, with their lengths in the high
    half, and its candidates that are the first of their kind.
    """
    row = np.repeat(np.arange(len(found)), pc.fill_null(found.value_lengths(), 0).to_numpy())
    place = found.flatten().to_numpy()
    begins = (np.cumsum(lengths) - lengths)[row] + (place & 0xFFFFFFFF)
    count, n = place >> 32, int(lengths.sum())
    edges = np.zeros(n + window + 1, np.int64)
    np.add.at(edges, begins[count > 0], 1)
    np.add.at(edges, (begins + count)[count > 0], -1)
    again = np.cumsum(edges) > 0
    again[begins[count == 0]] = False
    starts = np.flatnonzero(again)
    covered = np.zeros(n + window + 1, np.int64)
    covered[starts] += 1
    covered[starts + window] -= 1
    return np.cumsum(covered)[:n] > 0


def _cut(window: int, carried: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "t"):
            words = [t.split() for t in texts(batch, "t")]
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            removed = _removed(batch.column("found"), lengths, window)
            row, _ = spans(lengths)
            n_removed = np.bincount(row[removed], minlength=len(words))
            begins, left = np.cumsum(lengths) - lengths, []
            for i, own in enumerate(words):
                if n_removed[i]:
                    gone = removed[begins[i] : begins[i] + len(own)]
                    own = [own[k] for k in np.flatnonzero(~gone).tolist()]
                left.append(b" ".join(own).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(f"c{i}") for i in range(carried)),
                    pa.array(lengths),
                    pa.array(n_removed),
                    pa.array(left, pa.string()),
                ],
                names=[*(f"c{i}" for i in range(carried)), "n_words", "n_removed", "kept"],
            )

    return run


def _tie(docs: DataFrame) -> Column:
    """What tells rows of one doc_id apart; constant where no doc_id occurs twice."""
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return F.lit(0).cast("long") if repeated.isEmpty() else F.xxhash64("text")


def _by_document(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("d", "tie").agg(F.collect_list("place").alias(name))


def remove_repeats(docs: DataFrame, carry: list[str], window: int = WINDOW) -> DataFrame:
    """``carry`` columns, n_words, n_removed and kept (the kept words, blank between) of every row."""
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("d"),
        _tie(docs).alias("tie"),
        F.col("text").alias("t"),
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)],
    )
    own = keyed.select("d", "tie", "t")
    sent = own.mapInArrow(_send_entries(window), _ENTRY)
    home = "d long, tie long, place long"
    back = sent.repartition("name").sortWithinPartitions("name").mapInArrow(_shared_entries, home)
    places = written(_by_document(back, "places"), "shared")
    windows = own.join(places, ["d", "tie"]).mapInArrow(
        _send_windows(window), "one long, two long, d long, tie long, place long"
    )
    ordered = windows.repartition("one").sortWithinPartitions("one", "two", "d", "tie", "place")
    found = written(_by_document(ordered.mapInArrow(_first_windows, home), "found"), "found")
    joined = keyed.join(found, ["d", "tie"], "left")
    kinds = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.select(*carry).schema)]
    schema = ", ".join([*kinds, "n_words long", "n_removed long", "kept string"])
    columns = [F.col(f"c{i}").alias(c) for i, c in enumerate(carry)]
    cut = joined.mapInArrow(_cut(window, len(carry)), schema)
    return cut.select(*columns, "n_words", "n_removed", "kept")


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` with their kept words; texts that lose none stay as they are.

    A column n_chars follows its text.
    """
    copies = {f"_c{i}": F.col(c) for i, c in enumerate(docs.columns)}
    cut = remove_repeats(docs.withColumns(copies), list(copies), window)
    names = dict(zip(docs.columns, map(F.col, copies)))
    gone = F.col("n_removed") > 0
    new = {"text": F.when(gone, F.col("kept")).otherwise(names["text"])}
    if "n_chars" in names:
        kind = dict(docs.dtypes)["n_chars"]
        new["n_chars"] = F.when(gone, F.length("kept")).otherwise(names["n_chars"]).cast(kind)
    return cut.select(*[new.get(c, names[c]).alias(c) for c in docs.columns])


SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS window_text
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM docs) w),
repeats AS (
  SELECT doc_id, i FROM (SELECT doc_id, i,
    row_number() OVER (PARTITION BY window_text ORDER BY doc_id, i) AS place FROM windows) p
  WHERE place > 1),
removed AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM repeats),
kept AS (
  SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.i) AS kept, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM docs) w
  ANTI JOIN removed r ON r.doc_id = w.doc_id AND r.i = w.i
  GROUP BY w.doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(k.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""


@query("op6_substring_dedup", SQL)
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"])
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
