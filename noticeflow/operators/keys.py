"""Membership of a batch in the registry by its two keys.

``independent`` matching looks at each key alone: a notice is known when its id
occurs in the registry *and* its code occurs there, maybe in another row.
``tuple`` matching wants both in one row. With independent matching "not new" is
not the same as "existing": a notice that shares exactly one key with an existing
one is a ``conflict``. Such rows are kept and labelled.

Labels are worked out on distinct key pairs, which are narrow and hold no copies.
Each step is written once, as the next ones need it for both keys. The wide rows
move once at most, to pick up the label of their pair.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import moment
from ..schema import CODE, DOCUMENT_KIND, ID, KEYS
from .project import contains_both, undocumented
from .skew import Hot, Sized, key_values, keyed_join, write_once

LABEL = "label"
DOCUMENT = "document"

NEW, EXISTING, CONFLICT = "new", "existing", "conflict"
WITHOUT, WITH, MIXED = "without_document", "with_document", "mixed"


def _key_table(df: DataFrame, keys: list[str] = KEYS) -> Sized:
    return write_once(df.select(*keys).distinct(), "keys")


def _hot_by_key(df: DataFrame, keys: list[str] = KEYS) -> dict[str, Hot]:
    return {key: Hot(df, [key]) for key in keys}


def _by_each_key(
    left: DataFrame,
    table: Sized,
    how: str,
    keys: list[str] = KEYS,
    hot: dict[str, Hot] | None = None,
) -> DataFrame:
    hot = hot or _hot_by_key(left, keys)
    for key in keys:
        others = [c for c in left.columns if c != key] or [key]
        left = keyed_join(left, key_values(table, key), [key], how, others, hot[key])
    return left


def semi_independent(left: DataFrame, right: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Rows of ``left`` whose every key occurs in ``right``, each on its own."""
    return _by_each_key(left, _key_table(right, keys), "left_semi", keys)


def anti_independent(left: DataFrame, right: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Rows of ``left`` none of whose keys occurs in ``right``.

    This is not the complement of ``semi_independent``. A NULL key occurs nowhere.
    """
    return _by_each_key(left, _key_table(right, keys), "left_anti", keys)


def semi_tuple(left: DataFrame, right: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    return keyed_join(left, _key_table(right, keys), keys, "left_semi")


def anti_tuple(left: DataFrame, right: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    return keyed_join(left, _key_table(right, keys), keys, "left_anti")


def search_registry(
    registry: DataFrame, batch: DataFrame, fields: list[str] = KEYS
) -> DataFrame:
    """Registry rows whose id and code each occur somewhere in the batch."""
    columns = list(dict.fromkeys([*KEYS, *fields]))
    return semi_independent(registry.select(*columns), batch).select(*fields)


def ask_registry(batch: DataFrame, registry: DataFrame) -> DataFrame:
    """Batch rows known to the registry, by independent keys."""
    return semi_independent(batch, search_registry(registry, batch))


def waits() -> Column:
    """Whether a registry row still waits for its document."""
    return F.coalesce((F.col("ActaPublicada") == 0) & (F.col("UrlActaDL") == ""), F.lit(False))


def three_way(first: Column, second: Column, both: str, none: str, one: str) -> Column:
    return (
        F.when(first.isNotNull() & second.isNotNull(), both)
        .when(first.isNull() & second.isNull(), none)
        .otherwise(one)
    )


def _flag(pairs: DataFrame, table: Sized, prefix: str, hot: dict[str, Hot]) -> DataFrame:
    """Add ``prefix + key`` per key: TRUE where its value occurs in the table."""
    for key in KEYS:
        values = key_values(table, key).frame.withColumn(prefix + key, F.lit(True))
        others = [c for c in KEYS if c != key]
        pairs = keyed_join(pairs, Sized(values, within=table), [key], "left", others, hot[key])
    return pairs


def label_pairs(pairs: Sized, registry: DataFrame, match: str = "independent") -> DataFrame:
    """Distinct key pairs of a batch with ``label`` and ``document``.

    ``document`` says, for existing pairs, whether the registry still waits for
    their document; it is NULL for the others.
    """
    known = registry.select(*KEYS, waits().alias("_waiting"))
    if match == "tuple":
        return _label_tuples(pairs, known)
    if match == "independent":
        return _label_each_key(pairs, known)
    raise ValueError(f"unknown match {match!r}")


def _label_each_key(pairs: Sized, known: DataFrame) -> DataFrame:
    if not pairs.is_small:
        # Counts and joins of both keys read this narrow copy, not the registry each time.
        known = write_once(known, "known").frame
    hot, known_hot = _hot_by_key(pairs.frame), _hot_by_key(known)
    candidates = write_once(_by_each_key(known, pairs, "left_semi", hot=known_hot), "candidates")
    existing = write_once(_by_each_key(pairs.frame, candidates, "left_semi", hot=hot), "existing")
    waiting = candidates.frame.filter("_waiting")
    open_rows = _key_table(_by_each_key(waiting, existing, "left_semi", hot=known_hot))
    flagged = _flag(pairs.frame, existing, "_known_", hot)
    flagged = _flag(flagged, open_rows, "_open_", hot)
    label = three_way(
        F.col(f"_known_{ID}"), F.col(f"_known_{CODE}"), EXISTING, NEW, CONFLICT
    )
    document = three_way(F.col(f"_open_{ID}"), F.col(f"_open_{CODE}"), WITHOUT, WITH, MIXED)
    return flagged.select(
        *KEYS, label.alias(LABEL), F.when(label == EXISTING, document).alias(DOCUMENT)
    )


def _label_tuples(pairs: Sized, known: DataFrame) -> DataFrame:
    hits = keyed_join(known, pairs, KEYS, "left_semi")
    found = write_once(hits.groupBy(*KEYS).agg(F.max("_waiting").alias("_waiting")), "hits")
    document = F.when(F.col("_waiting"), WITHOUT).when(~F.col("_waiting"), WITH)
    label = F.when(F.col("_waiting").isNull(), NEW).otherwise(EXISTING)
    joined = keyed_join(pairs.frame, found, KEYS, "left")
    return joined.select(*KEYS, label.alias(LABEL), document.alias(DOCUMENT))


def classify(
    batch: DataFrame,
    registry: DataFrame,
    match: str = "independent",
    spread_by: list[str] | None = None,
) -> DataFrame:
    """The batch with ``label`` and ``document``; every row is kept.

    A row with a NULL key belongs to no pair and counts as new. The pairs are
    written with their row counts, which also show the hot ones.
    """
    counts = batch.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_n"))
    counted = write_once(counts, "pairs")
    pairs = Sized(counted.frame.select(*KEYS).dropna(), within=counted)
    labels = Sized(label_pairs(pairs, registry, match), within=counted)
    hot = Hot(batch, KEYS, counted.frame)
    joined = keyed_join(batch, labels, KEYS, "left", spread_by, hot)
    return joined.withColumn(LABEL, F.coalesce(LABEL, F.lit(NEW)))


def existing_without_document(existing: DataFrame, registry: DataFrame) -> DataFrame:
    """Existing batch rows whose registry entry still waits for a document."""
    open_rows = search_registry(undocumented(registry), existing)
    return semi_independent(existing, open_rows)


def registry_without_document(existing: DataFrame, registry: DataFrame) -> DataFrame:
    """As ``existing_without_document``, but the registry's own rows."""
    return search_registry(undocumented(registry), existing, registry.columns)


def existing_with_document(existing: DataFrame, without: DataFrame) -> DataFrame:
    return anti_independent(existing, without)


def not_archived(batch: DataFrame, registry: DataFrame, since: datetime | str) -> DataFrame:
    """Batch rows neither of whose keys belongs to an archived document.

    Archived: changed since ``since``, with path and name that carry the document
    kind. When nothing is archived every row passes.
    """
    recent = registry.filter(F.col("FechaModificacion") >= moment(since))
    archived = contains_both(recent, f"{DOCUMENT_KIND}_", "UrlActaDL", "NombreArchivoActa")
    return anti_independent(batch, archived)
