"""Match pending notices to document files by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import base_name, parse_document_name
from ..schema import CODE, DOCUMENT_KIND, ID, KEYS
from .skew import keyed_join, write_once


def document_files(files: DataFrame) -> DataFrame:
    """``path, name, _rest`` of the files named like a document.

    ``_rest`` is the name after ``kind_id_``. A dot must follow somewhere.
    """
    name = base_name(F.col("path"))
    pattern = rf"\A{DOCUMENT_KIND}_([0-9]+)_(.*\..*)\z"
    return (
        files.select("path", name.alias("name"))
        .filter(F.col("name").rlike("(?s)" + pattern))
        .withColumn(ID, F.regexp_extract("name", "(?s)" + pattern, 1).try_cast("int"))
        .withColumn("_rest", F.regexp_extract("name", "(?s)" + pattern, 2))
    )


def match_documents(pending: DataFrame, files: DataFrame, match: str = "exact") -> DataFrame:
    """Pending rows with the first file (by path) of each; ``path`` NULL if none.

    ``exact`` compares the id and code written in the name. ``prefix`` takes every
    file whose name starts with ``kind_id_code``, so that a code also finds files
    of longer codes. Both are equality joins: for ``prefix`` each file is listed under
    those prefixes of its name that are as long as some pending code of its id.
    """
    named = document_files(files)
    if match == "exact":
        keyed = named.withColumn(CODE, parse_document_name(F.col("path"))["code"])
    elif match == "prefix":
        before_dot = F.length(F.regexp_extract("_rest", r"(?s)(.*)\.", 1))
        # One row per id, with the few lengths its codes have, so that a hot id can be split.
        lengths = pending.select(ID, F.length(CODE).alias("_len")).dropna().groupBy(ID)
        lengths = write_once(lengths.agg(F.collect_set("_len").alias("_lengths")), "lengths")
        keyed = (
            keyed_join(named, lengths, [ID], spread_by=["path"])
            .withColumn("_len", F.explode("_lengths"))
            .filter(F.col("_len") <= before_dot)
            .withColumn(CODE, F.substr("_rest", F.lit(1), F.col("_len")))
        )
    else:
        raise ValueError(f"unknown match {match!r}")
    first = keyed.groupBy(*KEYS).agg(F.min("path").alias("path"))
    return keyed_join(pending, write_once(first, "files"), KEYS)


def names_present(wanted: DataFrame, objects: DataFrame, exact: bool = False) -> DataFrame:
    """Wanted names that exist, or that some longer object name starts with.

    Names and objects are sorted together: if any object starts with a name, the next object
    in order does. The sort is by ranges; within a range the next object is a running value,
    and a range whose last objects lie before a name takes the first object of the ranges
    behind, a row a range.
    """
    if exact:
        stored = objects.select(F.col("name")).distinct()
        return keyed_join(wanted, write_once(stored, "names"), ["name"], "left_semi")
    sides = [d.select("name").dropna().distinct().withColumn("_stored", F.lit(i)) for i, d in enumerate((wanted, objects))]
    ranged = sides[0].unionByName(sides[1]).repartitionByRange("name")
    ranged = write_once(ranged.withColumn("_part", F.spark_partition_id()), "ranges").frame
    own = F.when(F.col("_stored") == 1, F.col("name"))
    behind = Window.orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("_part").agg(F.min(own).alias("_first"))
    parts = parts.select("_part", F.last("_first", ignorenulls=True).over(behind).alias("_behind"))
    backwards = Window.partitionBy("_part").orderBy(F.desc("name"), F.desc("_stored"))
    following = F.last(own, ignorenulls=True).over(backwards.rowsBetween(Window.unboundedPreceding, 0))
    sorted_names = ranged.withColumn("_next", following).join(F.broadcast(parts), "_part")
    found = sorted_names.filter("_stored = 0").filter(F.startswith(F.coalesce("_next", "_behind"), F.col("name")))
    return keyed_join(wanted, write_once(found.select("name"), "names"), ["name"], "left_semi")
