"""Operator 3: log probability of a text over all its segmentations into subwords.

The model is a unigram model over an existing subword vocabulary: a text is a sequence of
independent pieces and an end piece. A piece that opens a word carries the vocabulary's
word mark, so pieces determine the words and the probabilities of all texts add up to
one. Every single byte is a piece, so every text has a segmentation. Since pieces do not
cross words, the probability of a text is the product of its words' and of the end, and
a word's is the sum over its lattice of segmentations: the forward recursion adds, in log
space, over all pieces that end at a byte.

The vocabulary's own scores (its merge ranks) give the first weights; ``ROUNDS`` rounds of
expectation-maximisation over the word counts of the training rows refine them. Expected
uses of pieces come from forward and backward sums over each distinct word and are added
by Spark; only the table of pieces, whose size is the vocabulary's, reaches the driver.

Words are counted over the whole corpus. For scoring, the words that make up most tokens
(at most ``FREQUENT``, by a threshold on their count) are sent to all tasks; the others
are joined by a shuffle on the word, where no word is frequent any more.

The base model is a smoothed unigram model over words, from the same counts.

Defined cases: NULL and empty texts are the end alone; rows of equal doc_id are rows of
their own; a NULL doc_id is a training row; without training rows the base probabilities
are (0.5 / 0.5) = 1 per token and pieces keep their first weights; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written
from .common import byte_hashes, byte_sums, crc_mod, inverse_powers, range_hashes, split_words, table, text_chunks
from .registry import query

ROUNDS = 3
FREQUENT = 100_000
SMOOTHING = 0.01
_MARK = "▁"
_BLOCK = 1 << 21
_NONE = -1
_LOG10 = np.log(10.0)


@dataclass
class Pieces:
    """A subword vocabulary: byte strings that open a word or go on in one, with weights.

    ``contents`` are the openers first (``openers`` of them), then the others, then the
    end piece, which has no content.
    """

    contents: list[bytes]
    openers: int
    weights: np.ndarray

    @staticmethod
    def of_sentencepiece(path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        opens: dict[bytes, float] = {b"": 0.0}
        goes_on = dict.fromkeys((bytes([b]) for b in range(256)), 0.0)
        size = model.get_piece_size()
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_control(i) or model.is_unknown(i) or _MARK in piece[1:]:
                continue
            rank = min(-model.get_score(i), float(size))
            into, content = (opens, piece[1:]) if piece[0] == _MARK else (goes_on, piece)
            key = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else content.encode()
            into[key] = into.get(key, 0.0) + 1.0 / (rank + 1.0)
        weights = np.array([*opens.values(), *goes_on.values(), 1.0 / size]) + 1e-9
        return Pieces([*opens, *goes_on, b""], len(opens), weights / weights.sum())


class Lattice:
    """Finds pieces in words and adds up over segmentations."""

    def __init__(self, pieces: Pieces):
        self.log = np.append(np.log(pieces.weights), -np.inf)
        lengths = np.array([len(c) for c in pieces.contents])
        n = pieces.openers
        self.widths = [np.unique(lengths[:n]), np.unique(lengths[n:-1])]
        self.n = len(pieces.contents)
        data = np.frombuffer(b"".join(pieces.contents), np.uint8)
        hashes = byte_hashes(data, np.cumsum(lengths))
        self.tables = [self._table(hashes[:n], 0), self._table(hashes[n:-1], n)]

    @staticmethod
    def _table(hashes: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Open addressing: slot to piece, slot to hash, and the longest probe."""
        size = 1 << 20
        piece, owner = np.full(size, _NONE, np.int32), np.zeros(size, np.uint64)
        longest = 0
        for i, value in enumerate(hashes.tolist()):
            probe = 0
            while piece[(value + probe) % size] != _NONE:
                probe += 1
            piece[(value + probe) % size] = first + i
            owner[(value + probe) % size] = value
            longest = max(longest, probe)
        return piece, owner, longest + 1

    def _find(self, kind: int, hashes: np.ndarray) -> np.ndarray:
        piece, owner, probes = self.tables[kind]
        slot = (hashes & np.uint64(len(piece) - 1)).astype(np.int64)
        found = piece[slot]
        # Most slots are free, or hold what is looked for; only the others are probed on.
        other = np.nonzero((found != _NONE) & (owner[slot] != hashes))
        wanted, at = hashes[other], slot[other]
        found[other] = _NONE
        for _ in range(probes - 1):
            at = (at + 1) & (len(piece) - 1)
            hit = (owner[at] == wanted) & (piece[at] != _NONE)
            found[tuple(i[hit] for i in other)] = piece[at[hit]]
        return found

    def _arcs(self, sums: np.ndarray, inverse: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of words of one length: openers by end; others by end and width up to it (or none)."""
        ends = starts[:, None] + np.arange(length + 1)
        opener = np.full(ends.shape, _NONE, np.int32)
        for width in self.widths[0]:
            if width <= length:
                opener[:, width] = self._find(0, range_hashes(sums, starts, ends[:, width], inverse))
        usable = self.widths[1][self.widths[1] <= length]
        others = np.full((*ends.shape, len(usable)), _NONE, np.int32)
        for k, width in enumerate(usable):
            there = range_hashes(sums, ends[:, : length + 1 - width], ends[:, width:], inverse)
            others[:, width:, k] = self._find(1, there)
        return opener, others

    def _forward(self, opener: np.ndarray, others: np.ndarray) -> np.ndarray:
        alpha = self.log[opener]
        arcs = self.log[others]
        for j in range(1, alpha.shape[1]):
            usable = self.widths[1][self.widths[1] <= j]
            terms = alpha[:, j - usable] + arcs[:, j, : len(usable)]
            alpha[:, j] = np.logaddexp(alpha[:, j], _log_sum(terms))
        return alpha

    def _uses(self, opener, others, alpha, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in words of one length that occur ``counts`` times."""
        n = alpha.shape[1]
        arcs = self.log[others]
        beta = np.full(alpha.shape, -np.inf)
        beta[:, -1] = 0.0
        for i in range(n - 2, -1, -1):
            usable = self.widths[1][self.widths[1] < n - i]
            terms = np.stack([arcs[:, i + w, k] + beta[:, i + w] for k, w in enumerate(usable)], axis=1)
            beta[:, i] = _log_sum(terms)
        total = alpha[:, -1:]
        uses = np.zeros(self.n + 1)
        share = np.exp(self.log[opener] + beta - total) * counts[:, None]
        np.add.at(uses, opener.ravel(), share.ravel())
        for k, width in enumerate(self.widths[1]):
            if width < n:
                arc = others[:, width:, k]
                share = np.exp(alpha[:, :-width] + arcs[:, width:, k] + beta[:, width:] - total)
                np.add.at(uses, arc.ravel(), (share * counts[:, None]).ravel())
        return uses[: self.n]

    def run(self, words: pa.Array, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities of words, and expected uses of pieces if counts are given."""
        values = words.cast(pa.large_binary())
        lengths = pc.binary_length(values).to_numpy().astype(np.int64)
        data = np.frombuffer(b"".join(values.to_pylist()), np.uint8)
        sums, begins = byte_sums(data), np.cumsum(lengths) - lengths
        inverse = inverse_powers(sums)
        result, uses = np.zeros(len(lengths)), np.zeros(self.n)
        for length in np.unique(lengths).tolist():
            same = np.flatnonzero(lengths == length)
            step = max(1, _BLOCK // ((length + 1) * len(self.widths[1])))
            for at in range(0, len(same), step):
                rows = same[at : at + step]
                opener, others = self._arcs(sums, inverse, begins[rows], length)
                alpha = self._forward(opener, others)
                result[rows] = alpha[:, -1]
                if counts is not None:
                    uses += self._uses(opener, others, alpha, counts[rows])
        return result, uses


def _log_sum(terms: np.ndarray) -> np.ndarray:
    """Log of the sum of exponentials along the second axis; of nothing, minus infinity."""
    if not terms.shape[1]:
        return np.full(len(terms), -np.inf)
    top = terms.max(axis=1)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return top + np.log(np.exp(terms - top[:, None]).sum(axis=1))


def _lowered(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    words, counts, _ = split_words(pc.ascii_lower(batch.column("text")))
    return words, counts


_COUNT = "word string, trained long, occurs long"


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    names = ["word", "trained", "occurs"]

    def added() -> Iterator[pa.RecordBatch]:
        whole = pa.concat_tables(held).group_by("word").aggregate([("trained", "sum"), ("occurs", "sum")])
        yield from whole.select(["word", "trained_sum", "occurs_sum"]).rename_columns(names).to_batches(65536)

    for batch in text_chunks(batches):
        words, counts = _lowered(batch)
        coded = words.dictionary_encode()
        index = coded.indices.to_numpy()
        n = len(coded.dictionary)
        train = np.repeat(~batch.column("held_out").to_numpy(zero_copy_only=False), counts)
        columns = [np.bincount(index[train], minlength=n), np.bincount(index, minlength=n)]
        held.append(pa.table([coded.dictionary.cast(pa.string()), *map(pa.array, columns)], names=names))
        if sum(map(len, held)) > 2_000_000:
            yield from added()
            held = []
    if held:
        yield from added()


def count_words(docs: DataFrame) -> DataFrame:
    """(word, trained, occurs): how often each word occurs in training rows and in all rows."""
    counted = docs.select("text", "held_out").mapInArrow(_count_words, _COUNT)
    summed = counted.groupBy("word").agg(F.sum("trained").alias("trained"), F.sum("occurs").alias("occurs"))
    return written(summed, "words")


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 100_000) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def train_pieces(words: DataFrame, texts: int, pieces: Pieces, rounds: int = ROUNDS) -> Pieces:
    """Weights refined by expectation-maximisation over trained words and ``texts`` ends."""
    trained = words.filter("trained > 0").select("word", "trained")
    for _ in range(rounds if texts else 0):
        sent = words.sparkSession.sparkContext.broadcast(pieces)

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(sent.value)
            uses = np.zeros(lattice.n)
            for part in _gathered(batches):
                counts = part.column("trained").to_numpy().astype(float)
                uses += lattice.run(part.column("word").combine_chunks(), counts)[1]
            used = np.flatnonzero(uses)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(uses[used])], names=["piece", "uses"])

        found = trained.mapInArrow(expect, "piece long, uses double")
        rows = found.groupBy("piece").agg(F.sum("uses").alias("uses")).toPandas()
        uses = np.full(len(pieces.weights), SMOOTHING)
        uses[rows.piece.to_numpy(np.int64)] += rows.uses.to_numpy()
        uses[-1] += texts
        pieces = Pieces(pieces.contents, pieces.openers, uses / uses.sum())
        sent.unpersist()
    return pieces


def score_words(words: DataFrame, pieces: Pieces, tokens: int, kinds: int) -> DataFrame:
    """(word, known, base, score, occurs): both models' log10 probabilities of each word."""
    sent = words.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(sent.value)
        for part in _gathered(batches):
            trained = part.column("trained").to_numpy()
            base = np.log10((trained + 0.5) / (tokens + 0.5 * (kinds + 1)))
            score = lattice.run(part.column("word").combine_chunks())[0] / _LOG10
            columns = [
                part.column("word"), pa.array((trained > 0).astype(np.int64)),
                pa.array(base), pa.array(score), part.column("occurs"),
            ]
            yield from pa.table(columns, names=["word", "known", "base", "score", "occurs"]).to_batches()

    scored = words.mapInArrow(run, "word string, known long, base double, score double, occurs long")
    return written(scored, "word-scores")


def frequent_words(scored: DataFrame, most: int) -> dict[str, tuple[int, float, float]]:
    """At most ``most`` words, all those whose count reaches the lowest threshold that allows it."""
    size = F.floor(F.log2("occurs") * 8).cast("int")
    steps = scored.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()
    total, least = 0, None
    for row in sorted(steps, key=lambda r: -r["size"]):
        total += row.n
        if total > most:
            break
        least = row["size"]
    if least is None:
        return {}
    rows = scored.filter(size >= least).select("word", "known", "base", "score").collect()
    return {r.word: (r.known, r.base, r.score) for r in rows}


_PART = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, "
    "base_score double, score double, word string, times long"
)


def _score_parts(frequent, end: tuple[float, float, bool]):
    """A row of sums per document over its frequent words, and a row per other word of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {word: i for i, word in enumerate(frequent.value)}
        values = np.array([*frequent.value.values(), (0, 0.0, 0.0)], float)
        next_row = TaskContext.get().partitionId() << 33
        names = [f.split()[0] for f in _PART.split(", ")]
        for batch in text_chunks(batches):
            n = batch.num_rows
            words, counts = _lowered(batch)
            coded = words.dictionary_encode()
            which = [index.get(w, -1) for w in coded.dictionary.to_pylist()]
            code = coded.indices.to_numpy()
            which = np.array([*which, -1], np.int64)[code]
            of = np.repeat(np.arange(n), counts)
            sums = [np.bincount(of, values[which, k], n) for k in range(3)]
            rows = np.arange(next_row, next_row + n)
            next_row += n
            none = pa.nulls(n, pa.string())
            known = sums[0].astype(np.int64) + int(end[2])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows), batch.column("doc_id"), batch.column("held_out"), pa.array(counts + 1),
                    pa.array(known), pa.array(sums[1] + end[0]), pa.array(sums[2] + end[1]), none,
                    pa.nulls(n, pa.int64()),
                ],
                names=names,
            )
            rare = which < 0
            kinds = len(coded.dictionary)
            pairs, times = np.unique(of[rare] * kinds + code[rare], return_counts=True)
            m = len(pairs)
            if m:
                names_of = coded.dictionary.cast(pa.string()).take(pa.array(pairs % kinds))
                empty = [pa.nulls(m, t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[pairs // kinds]), *empty, names_of, pa.array(times)], names=names
                )

    return run


def score_texts(docs: DataFrame, pieces: Pieces, frequent: int = FREQUENT) -> DataFrame:
    """Scores of every row of (doc_id, text, held_out); rows that are not held out train."""
    docs = docs.select(F.col("doc_id").cast("long"), "text", "held_out")
    words = count_words(docs)
    texts = docs.filter(~F.col("held_out")).count()
    sums = words.filter("trained > 0").agg(F.sum("trained"), F.count(F.lit(1))).first()
    tokens, kinds = int(sums[0] or 0) + texts, int(sums[1]) + (texts > 0)
    pieces = train_pieces(words, texts, pieces)
    scored = score_words(words, pieces, tokens, kinds)
    sent = docs.sparkSession.sparkContext.broadcast(frequent_words(scored, frequent))
    end = (
        float(np.log10((texts + 0.5) / (tokens + 0.5 * (kinds + 1)))),
        float(np.log10(pieces.weights[-1])),
        texts > 0,
    )
    parts = written(docs.mapInArrow(_score_parts(sent, end), _PART), "score-parts")
    others = (
        parts.filter("word IS NOT NULL")
        .select("row", "word", "times")
        .join(scored.select("word", "known", "base", "score"), "word")
        .groupBy("row")
        .agg(
            F.sum(F.col("known") * F.col("times")).alias("more_known"),
            F.sum(F.col("base") * F.col("times")).alias("more_base"),
            F.sum(F.col("score") * F.col("times")).alias("more_score"),
        )
    )
    whole = parts.filter("word IS NULL").join(others, "row", "left")
    plus = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a)
    return whole.select(
        "doc_id", "held_out", "n_tokens", plus("n_known", "more_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        plus("base_score", "more_base"), plus("score", "more_score"),
    )


@query("op3_lattice_scores")
def op3_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").withColumn("held_out", crc_mod("doc_id", 5) == 1)
    return score_texts(docs, Pieces.of_sentencepiece(public_tokenizers.path("piece_bpe_32k.model")))
