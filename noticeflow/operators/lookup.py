"""Dimension lookup: state name to state id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import zero_pad
from .skew import Sized, keyed_join


def state_dimension(dim: DataFrame) -> DataFrame:
    """``Estado, IdEstado`` with the one spelling that differs in the notices."""
    name = F.when(F.col("Estado") == "ESTADO DE MEXICO", "MEXICO").otherwise(F.col("Estado"))
    return dim.filter(F.col("Estado").isNotNull()).select(
        name.alias("Estado"), F.col("IdEstado").alias("IdEstado")
    )


def unique_lookup(dim: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key; a key that occurs twice fails the job."""
    entry = dim.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.first(value).alias(value)
    )
    checked = F.when(
        F.col("_n") > 1,
        F.raise_error(F.concat(F.lit("duplicate name in dimension: "), F.col(key))),
    ).otherwise(F.col(value).cast("string"))
    return entry.select(key, checked.alias(value))


def map_states(
    df: DataFrame, dim: DataFrame, column: str = "IdEstado", compat_nan: bool = False
) -> DataFrame:
    """Replace a state name by its two-digit id.

    A name without an entry becomes NULL, or the text ``nan`` in compat mode.
    """
    lookup = unique_lookup(state_dimension(dim), "Estado", "IdEstado").select(
        F.col("Estado").alias(column), F.col("IdEstado").alias("_state_id")
    )
    joined = keyed_join(df, Sized(lookup), [column])
    found = zero_pad(F.col("_state_id"))
    if compat_nan:
        found = F.coalesce(found, F.lit("nan"))
    return joined.withColumn(column, found).select(*df.columns)
