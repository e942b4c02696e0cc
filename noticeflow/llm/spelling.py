"""Operator 12: groups of spelling variants by PartEnum signatures.

Words are counted over all texts. Two words are near if one inserted, deleted or replaced
code point turns one into the other. As a binary vector over (letter, occurrence) a word's
multiset of letters then differs in two places at most. PartEnum (Arasu, Ganti and Kaushik,
"Efficient exact set-similarity joins", 2006) deals the places to ``PARTS`` parts and
enumerates all choices of two parts to leave out: vectors at Hamming distance two or less
agree in one such signature at least, so near words meet in an equi-join on signatures.

Words that meet are matched by what is left of them without one code point, never in pairs:
of a group, words of one length that agree without the code point at one position differ by
a replacement, a word that equals another without a code point by an insertion. Such matches
are verified on the words. Groups of up to ``BLOCK`` words are matched within a task; larger
ones (a hot signature) are dealt by these shorter strings first, which leaves no more words
together than the alphabet has letters. Either way cost follows the words and their length.

A word's form is its near word of largest count, if that is at least ``RATIO`` times its own.
Forms have ever larger counts, so chains of forms end; their ends, the roots, are found by
pointer jumping in Spark rounds.

Defined cases: NULL and empty texts have no words; a NULL doc_id is written as nothing where
doc_id enters the hash; rows of equal doc_id count each; runs shortened below the least length
are dropped; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written
from .common import mixed, spans, table, text_chunks
from .registry import query

LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
DIVISOR = 199
PARTS, DISTANCE = 8, 2
BLOCK = 4096
SAME, LONGER, SHORTER = 0, 1, 2
_HELD = 200_000
_LETTERS = 1 << 17
_KEYS = np.random.default_rng(12).integers(0, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def runs(doc_id: int | None, text: str, least: int = LEAST_LENGTH, divisor: int = DIVISOR) -> Counter:
    """Counts of a text's runs of letters, some of them short of one code point."""
    lowered = text.encode().lower().decode()
    found = Counter(re.findall(rf"[A-Za-zÀ-ÿ]{{{least},}}", lowered))
    begin = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out = Counter()
    for run, n in found.items():
        h = zlib.crc32(run.encode(), begin)
        if h % divisor == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= least:
            out[run] += n
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per word, of as many texts as the memory for words holds."""

    def counts() -> pa.RecordBatch:
        columns = [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    held = Counter()
    for batch in text_chunks(batches):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            held.update(runs(doc_id, text or ""))
            if len(held) > _HELD:
                yield counts()
                held.clear()
    yield counts()


def vocabulary(docs: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words with enough occurrences."""
    source = docs.select(F.col("doc_id").cast("long"), "text")
    parts = source.mapInArrow(_count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words end to end, and the words' lengths."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
    return flat, np.fromiter(map(len, words), np.int64, len(words))


def signatures(words: list[str], parts: int = PARTS, distance: int = DISTANCE) -> np.ndarray:
    """A row of signatures for each word, one for every choice of parts to leave out."""
    flat, lengths = _points(words)
    row, _ = spans(lengths)
    order = np.lexsort((flat, row))
    letters = flat[order]
    new = np.ones(len(letters), bool)
    new[1:] = (letters[1:] != letters[:-1]) | (row[1:] != row[:-1])
    begins = np.flatnonzero(new)
    occurrence = np.arange(len(letters)) - np.repeat(begins, np.diff(np.append(begins, len(letters))))
    places = mixed((letters << np.uint64(32)) + occurrence.astype(np.uint64) + _KEYS[0])
    part = (places % np.uint64(parts)).astype(np.int64)
    sums = np.zeros((len(words), parts), np.uint64)
    with np.errstate(over="ignore"):
        np.add.at(sums, (row, part), mixed(places))
        sums = mixed(sums + _KEYS[1 : parts + 1])
        whole = sums.sum(axis=1, dtype=np.uint64)
        out = [
            mixed(whole - sums[:, list(left_out)].sum(axis=1, dtype=np.uint64) + np.uint64(i))
            for i, left_out in enumerate(combinations(range(parts), distance))
        ]
    return np.stack(out, axis=1)


def shortened(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys under which near words match: (row, key, kind) for each.

    Every word has, for each position, a key of what is left without that code point together
    with the position (``SAME``) and a key of what is left alone (``LONGER``), and one key of
    the word as it is (``SHORTER``), which equals the LONGER keys of words that are near it.
    """
    flat, lengths = _points(words)
    row, place = spans(lengths)
    ends = np.cumsum(lengths)
    first = (ends - lengths)[row]
    with np.errstate(over="ignore"):
        powers = np.full(int(lengths.max(initial=0)) + 1, _BASE)
        powers[0] = 1
        powers = np.cumprod(powers)
        values = mixed(flat + _KEYS[20])
        before = np.concatenate([[np.uint64(0)], np.cumsum(values * powers[place])])
        # The same letters one place further down, for what stands behind the gap.
        lower = values * powers[np.maximum(place - 1, 0)]
        behind = np.concatenate([[np.uint64(0)], np.cumsum(lower)])
        left = before[np.arange(len(flat))] - before[first] + behind[ends[row]] - behind[np.arange(len(flat)) + 1]
        shorter = (lengths[row] - 1).astype(np.uint64) * _KEYS[21]
        whole = mixed(before[ends] - before[ends - lengths] + lengths.astype(np.uint64) * _KEYS[21])
        gone = mixed(left + shorter)
        replaced = mixed(gone + _KEYS[22] * (place + 1).astype(np.uint64))
    rows = np.concatenate([row, row, np.arange(len(words))])
    kinds = np.repeat(np.array([SAME, LONGER, SHORTER], np.int32), [len(row), len(row), len(words)])
    return rows, np.concatenate([replaced, gone, whole]), kinds


def near(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point turns one into the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


def matches(words: list[str], row: np.ndarray, group: np.ndarray, key: np.ndarray, kind: np.ndarray) -> list:
    """Pairs of rows whose words are near, of those that share a key within a group."""
    order = np.lexsort((-kind, key, group))
    row, group, key, kind = row[order], group[order], key[order], kind[order]
    same = (group[1:] == group[:-1]) & (key[1:] == key[:-1])
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
    found = set()
    for begin, last in edges.reshape(-1, 2).tolist():
        if kind[begin] == LONGER:
            continue  # these are longer by a code point than a word that is not here
        members = row[begin : last + 1].tolist()
        if kind[begin] == SAME:
            found.update(combinations(members, 2))
        else:
            shorter = int((kind[begin : last + 1] == SHORTER).sum())
            found.update(product(members[:shorter], members[shorter:]))
    return [(a, b) for a, b in found if near(words[a], words[b])]


_NEAR = "a string, na long, b string, nb long"


def _found(words: list[str], counts: list[int], pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    """Pairs, the smaller word first."""
    pairs = [(a, b) if words[a] < words[b] else (b, a) for a, b in pairs]
    columns = [[v[p[side]] for p in pairs] for side in (0, 1) for v in (words, counts)]
    kinds = [pa.string(), pa.int64()] * 2
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["a", "na", "b", "nb"])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word once for every signature."""
    for batch in text_chunks(batches, "word", _LETTERS):
        signed = signatures(batch.column("word").to_pylist())
        at = pa.array(np.repeat(np.arange(batch.num_rows), signed.shape[1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed.reshape(-1).view(np.int64)), batch.column("word").take(at), batch.column("n").take(at)],
            names=["sig", "word", "n"],
        )


def _portions(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[tuple]:
    """Whole groups of sorted rows, some at a time: group numbers and all columns."""
    held, letters, last, number = [], 0, None, -1
    for batch in batches:
        for *row, key in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), zip(*(batch.column(c).to_pylist() for c in group))):
            if key != last:
                if letters > _LETTERS:
                    yield tuple(zip(*held))
                    held, letters = [], 0
                number, last = number + 1, key
            held.append((number, *row))
            letters += len(row[batch.schema.get_field_index("word")])
    if held:
        yield tuple(zip(*held))


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of each signature's group."""
    for number, _, words, counts in _portions(batches, ["sig"]):
        row, key, kind = shortened(words)
        yield _found(words, counts, matches(words, row, np.array(number)[row], key, kind))


def _shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word once for every key of ``shortened``."""
    for batch in text_chunks(batches, "word", _LETTERS // 8):
        row, key, kind = shortened(batch.column("word").to_pylist())
        at = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), pa.array(kind), *(batch.column(c).take(at) for c in ("sig", "word", "n"))],
            names=["key", "kind", "sig", "word", "n"],
        )


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of each group of one signature and key."""
    for number, key, kind, _, words, counts in _portions(batches, ["sig", "key"]):
        rows = np.arange(len(words))
        yield _found(words, counts, matches(words, rows, np.array(number), np.array(key), np.array(kind)))


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, na, b, nb) of every pair of near words of (word, n), once each."""
    signed = written(words.select("word", "n").mapInArrow(_sign, "sig long, word string, n long"), "signed")
    sizes = signed.groupBy("sig").agg(F.count(F.lit(1)).alias("m"))
    met = written(signed.join(sizes.filter("m > 1"), "sig"), "met")
    small = met.filter(F.col("m") <= block).select("sig", "word", "n")
    large = met.filter(F.col("m") > block).select("sig", "word", "n")
    pairs = small.repartition("sig").sortWithinPartitions("sig").mapInArrow(_within, _NEAR)
    keyed = large.mapInArrow(_shorten, "key long, kind int, sig long, word string, n long")
    dealt = keyed.repartition("sig", "key").sortWithinPartitions("sig", "key")
    return pairs.union(dealt.mapInArrow(_by_key, _NEAR)).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form) without cycles: where each chain of forms ends."""
    ends = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = ends.join(further, "root", "left")
        ends = written(
            moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots",
        )
        if ends.filter("moved").isEmpty():
            return ends.drop("moved")
        ends = ends.drop("moved")


def variants(docs: DataFrame, least_count: int = LEAST_COUNT, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """(word, root, form, n, n_near, form_n) of every word."""
    words = written(vocabulary(docs, least_count), "words")
    pairs = written(near_words(words, block), "near")
    turned = pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("m"))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")).union(turned)
    # The largest count first, then the smallest word.
    best = F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("best")
    around = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    strong = -F.col("best.less") >= ratio * F.col("n")
    formed = words.join(around, "word", "left").select(
        "word",
        F.when(strong, F.col("best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, -F.col("best.less")).alias("form_n"),
    )
    formed = written(formed, "forms")
    ends = roots(formed.filter("form IS NOT NULL"))
    return formed.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


@query("op12_spelling_variants")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = variants(table(spark, sf_dir, "documents"))
    return found.select("word", "root", "form", "n", "n_near", "form_n")
