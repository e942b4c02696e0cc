"""Many files in one batch, with the outcome of one file after the other.

A file is compared with the registry as the files before it leave it: rows that an earlier
file inserted are known to a later one. Instead of a run per file, all files are labelled
at once, with registry rows that carry the file they were *born* in and count for later
files only. Which rows are inserted depends on the labels and the labels on what was
inserted, so labelling is repeated with the rows inserted by the last round until these stay
the same. The first file is right after the first round, and a file is right one round after
the last file whose insertions it can see, so the end state is the one of file by file and
the number of rounds is the length of the longest chain of files that depend on each other,
mostly two. A batch none of whose new rows can be seen by a later file takes one round.

As file by file, a registry row counts for a file if its id and its code each occur
there, and a row of the file by the keys it shares with existing rows of its own file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import CODE, FILE_ORDER, ID, KEYS
from .keys import CONFLICT, DOCUMENT, EXISTING, LABEL, MIXED, NEW, WITH, WITHOUT, semi_independent, three_way, waits
from .skew import Hot, Sized, keyed_join, write_once

_BORN, _WAITING = "_born", "_waiting"
_PAIR = [FILE_ORDER, *KEYS]


def _values(frame: DataFrame, key: str) -> Sized:
    """Distinct values of a key in each file."""
    return write_once(frame.select(FILE_ORDER, key).distinct(), "values")


def _candidates(known: DataFrame, ids: Sized, codes: Sized) -> DataFrame:
    """Registry rows that count for a file, a row for each file.

    A row goes to the files that hold the key which occurs in fewer of them, and stays where
    the other one occurs as well.
    """
    counts = {
        key: write_once(values.frame.groupBy(key).agg(F.count(F.lit(1)).alias(f"_in_{key}")), "files")
        for key, values in ((ID, ids), (CODE, codes))
    }
    counted = known
    for key, files in counts.items():
        counted = keyed_join(counted, files, [key], "left")
    fewer = F.col(f"_in_{ID}") <= F.col(f"_in_{CODE}")
    columns = [FILE_ORDER, *known.columns]
    by_id = counted.filter(fewer).join(ids.frame, ID).filter(F.col(_BORN) < F.col(FILE_ORDER))
    by_code = counted.filter(~fewer).join(codes.frame, CODE).filter(F.col(_BORN) < F.col(FILE_ORDER))
    by_id = keyed_join(by_id.select(*columns), codes, [FILE_ORDER, CODE], "left_semi")
    by_code = keyed_join(by_code.select(*columns), ids, [FILE_ORDER, ID], "left_semi")
    return by_id.unionByName(by_code)


def _semi(frame: DataFrame, table: DataFrame) -> DataFrame:
    """Rows of a file whose id and code each occur among the file's rows of a table."""
    for key in KEYS:
        frame = keyed_join(frame, _values(table, key), [FILE_ORDER, key], "left_semi")
    return frame


def _flagged(pairs: DataFrame, table: DataFrame, prefix: str) -> DataFrame:
    for key in KEYS:
        values = table.select(FILE_ORDER, key).distinct().withColumn(prefix + key, F.lit(True))
        pairs = keyed_join(pairs, write_once(values, "flags"), [FILE_ORDER, key], "left")
    return pairs


def _label(pairs: DataFrame, known: DataFrame, ids: Sized, codes: Sized) -> DataFrame:
    """The pairs of all files with label and document, for one state of the insertions."""
    candidates = write_once(_candidates(known, ids, codes), "candidates").frame
    existing = write_once(_semi(pairs, candidates), "existing").frame
    open_rows = write_once(_semi(candidates.filter(_WAITING), existing), "open").frame
    flagged = _flagged(_flagged(pairs, existing, "_known_"), open_rows, "_open_")
    label = three_way(F.col(f"_known_{ID}"), F.col(f"_known_{CODE}"), EXISTING, NEW, CONFLICT)
    document = three_way(F.col(f"_open_{ID}"), F.col(f"_open_{CODE}"), WITHOUT, WITH, MIXED)
    return write_once(
        flagged.select(*_PAIR, label.alias(LABEL), F.when(label == EXISTING, document).alias(DOCUMENT)), "labels"
    ).frame


def _seen_later(labels: DataFrame, ids: Sized, codes: Sized) -> DataFrame:
    """Inserted pairs whose id and whose code come again in later files, as registry rows."""
    born = labels.filter(F.col(LABEL) == NEW).select(*KEYS, F.col(FILE_ORDER).alias(_BORN))
    for key, values in ((ID, ids), (CODE, codes)):
        last = values.frame.groupBy(key).agg(F.max(FILE_ORDER).alias("_last"))
        born = keyed_join(born, write_once(last, "last"), [key]).filter(F.col("_last") > F.col(_BORN)).drop("_last")
    return write_once(born.withColumn(_WAITING, F.lit(True)), "born").frame


def _mark(rows: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64(*KEYS, _BORN).cast("decimal(38,0)"))
    return tuple(rows.agg(F.count(F.lit(1)), digest).first())


def classify_in_order(batch: DataFrame, registry: DataFrame, spread_by: list[str] | None = None) -> DataFrame:
    """The batch with ``label`` and ``document``, as if its files came one by one.

    Files are ordered by the text in ``FILE_ORDER``. A row with a NULL key counts as new and
    is known to no later file.
    """
    counted = write_once(batch.groupBy(*_PAIR).agg(F.count(F.lit(1)).alias("_n")), "pairs")
    pairs = write_once(counted.frame.select(*_PAIR).dropna(), "keyed").frame
    ids, codes = _values(pairs, ID), _values(pairs, CODE)
    known = semi_independent(registry.select(*KEYS, waits().alias(_WAITING)), pairs)
    known = known.distinct().withColumn(_BORN, F.lit(""))
    known = write_once(known.select(*KEYS, _BORN, _WAITING), "known").frame
    labels = _label(pairs, known, ids, codes)
    born, before = _seen_later(labels, ids, codes), (0, None)
    while (now := _mark(born)) != before:
        before = now
        labels = _label(pairs, known.unionByName(born), ids, codes)
        born = _seen_later(labels, ids, codes)
    hot = Hot(batch, _PAIR, counted.frame)
    joined = keyed_join(batch, Sized(labels, within=counted), _PAIR, "left", spread_by, hot)
    return joined.withColumn(LABEL, F.coalesce(LABEL, F.lit(NEW)))
