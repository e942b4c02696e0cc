"""Operator 7: mix sources to target weights, with DataFrame functions only.

Sources in code point order, NULL last, get the weights in turn and share all words by
them. A source can give each document at most ``most`` times, so targets stop at that;
what is over goes to the others by weight, until none is above. In closed form: with the
sources in ascending order of limit per weight, the first k stand at their limits, where
k is the first number for which the share per weight that is left for the others does
not exceed the limit per weight of the next source.

Documents get a hash-random key from their own values and are sorted by it within their
source. A running sum of sizes gives each document its place among the source's words;
the budget is cut there: whole epochs first, then every document in front of the cut, and
the document at the cut in part. The running sum has two levels: sums per source and key
range, then places within a range. So a source with any share of the rows is spread over
``2**(4 * digits)`` ranges, and no window ever holds a source.

The table of sources has one row per source; only that table is ordered as a whole.

Defined cases: NULL or empty text has size 0 and is taken 0 times; a source without words
has target 0; equal rows have equal keys and places one after the other; a NULL doc_id is
a value like any other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import written
from .common import WORD, table
from .registry import query

DIGITS = 3


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, budget) from one row (source, source_size) per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weighted = sizes.withColumn("weight", F.get(cycle, place).cast("long"))
    limited = weighted.withColumn("limit", F.col("source_size") * most).withColumn(
        "limit_per_weight", F.col("limit") / F.col("weight")
    )
    order = Window.orderBy("limit_per_weight", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    shared = (
        limited.withColumn("limits_before", F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("weights_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("words", F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn(
            "share",
            (F.col("words") - F.col("limits_before")) / (F.col("weights") - F.col("weights_before")),
        )
    )
    # Shares fall as long as sources stand at their limits; the first that fits holds for all.
    fits = F.col("share") <= F.col("limit_per_weight")
    share = F.max(F.when(fits, F.struct(-F.col("limits_before"), "share"))).over(everything)["share"]
    budget = F.least(F.coalesce(share * F.col("weight"), F.col("limit").cast("double")), "limit")
    return shared.select("source", "source_size", budget.cast("double").alias("target"))


def _taken(docs: DataFrame, weights: tuple[int, ...], most: int, carry: list[str]) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, c0, c1, ...) of every row."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    value = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    carried = [F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
    sized = docs.select("doc_id", "source", size.alias("size"), F.md5(value).alias("key"), *carried)
    # Narrow rows are sized once; whole texts are rather read again than written.
    sized = sized if carry else written(sized, "sizes")
    sized = sized.withColumn("range", F.substring("key", 1, DIGITS))
    ranges = sized.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    ranges = written(ranges, "ranges")
    sources = targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, most)
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranges.select(
        "source", "range", F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("base")
    )
    bases = bases.join(
        sources.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))
    ).drop("name")
    placed = sized.join(
        bases.select(
            F.col("source").alias("name"), F.col("range").alias("part"), "base", "source_size", "target"
        ),
        F.col("source").eqNullSafe(F.col("name")) & (F.col("range") == F.col("part")),
    )
    within = (
        Window.partitionBy("source", "range")
        .orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    end = F.col("base") + F.sum("size").over(within)
    budget = F.floor(F.col("target")).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest("source_size", F.lit(1))))
    cut = placed.withColumn("end", end).withColumn("epochs", F.coalesce(epochs, F.lit(0)).cast("long"))
    rest = budget - F.col("epochs") * F.col("source_size")
    part = F.greatest(F.lit(0), F.least("size", rest - (F.col("end") - F.col("size"))))
    taken = (F.col("epochs") * F.col("size") + part).cast("long")
    columns = ["doc_id", "source", "size", "source_size", "target", taken.alias("taken")]
    return cut.select(*columns, *[f"c{i}" for i in range(len(carry))])


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row."""
    return _taken(docs, weights, most, [])


def mixture(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """The mixed rows, with the columns of ``docs``: a row for each time a document is taken.

    A document taken in part ends after the words taken, which are joined by blanks; a
    column n_chars follows its text.
    """
    names = {c: F.col(f"c{i}") for i, c in enumerate(docs.columns)}
    text, times = names["text"], F.floor(F.col("taken") / F.col("size")).cast("int")
    rest = (F.col("taken") % F.col("size")).cast("int")
    words = F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), 1, rest)
    part = F.when(rest > 0, F.array(F.array_join(words, " "))).otherwise(F.array().cast("array<string>"))
    texts = F.explode(F.concat(F.array_repeat(text, times), part))
    rows = _taken(docs, weights, most, docs.columns).filter("taken > 0").select("*", texts.alias("_text"))
    kind = dict(docs.dtypes).get("n_chars")
    whole = F.col("_text") == text
    new = {"text": F.col("_text")}
    if kind:
        new["n_chars"] = F.when(whole, names["n_chars"]).otherwise(F.length("_text")).cast(kind)
    return rows.select(*[new.get(c, names[c]).alias(c) for c in docs.columns])


SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight,
    3 * source_size AS max_words
  FROM sums),
ordered AS (
  SELECT *, max_words / weight AS ratio,
    coalesce(sum(max_words) OVER before, 0) AS max_before,
    coalesce(sum(weight) OVER before, 0) AS weight_before,
    sum(source_size) OVER () AS words, sum(weight) OVER () AS weights
  FROM weighted
  WINDOW before AS (ORDER BY max_words / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shares AS (
  SELECT *, (words - max_before)::DOUBLE / (weights - weight_before)::DOUBLE AS share FROM ordered),
fitting AS (
  SELECT share FROM shares WHERE share <= ratio ORDER BY max_before, share DESC LIMIT 1),
sources AS (
  SELECT source, source_size,
    least(coalesce((SELECT share FROM fitting) * weight, max_words::DOUBLE), max_words::DOUBLE) AS target
  FROM shares),
placed AS (
  SELECT sized.*, source_size, target, floor(target)::BIGINT AS budget,
    (sum(size) OVER (PARTITION BY sized.source ORDER BY key, doc_id, size
      ROWS UNBOUNDED PRECEDING))::BIGINT AS upto
  FROM sized JOIN sources ON sized.source IS NOT DISTINCT FROM sources.source),
epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM placed)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, budget - epochs * source_size - (upto - size))))::BIGINT AS taken
FROM epochs
"""


@query("op7_mix_sources", SQL)
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source")
