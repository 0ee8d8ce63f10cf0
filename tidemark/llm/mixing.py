"""Mixtures of sources by target weights: Efraimidis-Spirakis sampling without replacement, in SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SOLID, fresh, require, staged, widened

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = "mix-1"
SYMBOLS = "#*$%&|<>0123456789"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"{SOLID}+")), F.lit(0)).cast("bigint")


def quality_weight(text: Column) -> Column:
    """A document's weight, 1 / 11 to 1: the less, the larger the share of symbols and digits among its characters."""
    rest = F.char_length(F.translate(text, SYMBOLS, ""))
    share = 1.0 - rest / F.greatest(F.char_length(text), F.lit(1))
    return F.when(F.coalesce(F.char_length(text), F.lit(0)) == 0, 1.0).otherwise(1.0 / (1.0 + 10.0 * share))


def draw(*parts: Column, seed: str = SEED) -> Column:
    """A number in (0, 1] with 52 random bits that depends on the values only; null counts as empty."""
    joined = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    bits = F.conv(F.substring(F.md5(joined.cast("binary")), 1, 13), 16, 10).cast("bigint")
    return (bits + 1) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Targets of sources (source, source_size), one row each.

    Sources in order of code points, null last, take the weights in turn and divide `share` of all
    sizes by them. No target exceeds `most` times its source; what is above goes to the others by
    their weights until none is above. With sources in order of size over weight, the ones that stop
    are a prefix, so one running sum finds the level of the others. Adds place (from 0), weight and
    target. A mixture has one row per source, so one task orders them.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = (
        sizes.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights)) + 1))
        .withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    )
    whole = Window.partitionBy()
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    from_here = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.lit(float(share)) * F.sum("source_size").over(whole) - F.col("before")) / F.col("left")
    levels = (
        ranked.withColumn("before", F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("cap"))
        .withColumn("left", F.sum("weight").over(from_here))
        .withColumn("level", level)
        .withColumn("stops", F.col("cap") <= F.col("level") * F.col("weight"))
        .withColumn("open", F.when(~F.col("stops"), F.struct(F.col("cap") / F.col("weight"), "place", "level")))
    )
    shared = F.min("open").over(whole)["level"] * F.col("weight")
    return levels.select(
        "source", "source_size", "place", "weight",
        F.when(F.col("stops"), F.col("cap")).otherwise(shared).alias("target"),
    )


def mix(
    rows: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """Say how often a mixture takes each row of (source, size, quality, draw, further columns).

    A source whose target is t times its size gives floor(t) complete epochs of all its rows; the
    rest of the target goes to a weighted sample without replacement. Its rows are ordered by the
    exponential key -ln(draw) / quality and taken whole from the front while that brings the sum
    nearer to the target, so a source misses it by half the size of one row at most, and no row is
    taken more often than `most` times rounded up. Rows are written once with a number, so the
    order is total; those equal in all columns are interchangeable. All sources are laid out by
    (source, key) over range partitions, whose totals give each its running sum: a source that
    holds most rows, and a row repeated any number of times, are dealt over several tasks.

    size: a long of 0 or more, null counts as 0; quality: a positive double, null, zero, NaN or
    less counts as the least positive one, such rows come last; draw: in (0, 1], null counts as the
    least. Adds source_size, target, times (int) and taken (times * size). An empty table gives
    no rows. Names of added columns may not be taken.
    """
    require(rows, "source", "size", "quality", "draw")
    widened(rows, "source_size bigint, target double, times int, taken bigint")
    number, key, part, place, budget, epochs, offset, before, of = (
        fresh(rows, f"_{x}") for x in ("number", "key", "part", "place", "budget", "epochs", "offset", "before", "of")
    )
    tiny = F.lit(5e-324)
    quality = F.when((F.col("quality") > 0) & ~F.isnan("quality"), F.col("quality")).otherwise(tiny)
    drawn = F.when((F.col("draw") > 0) & ~F.isnan("draw"), F.col("draw")).otherwise(tiny)
    size = F.coalesce(F.col("size"), F.lit(0)).cast("bigint")
    numbered = staged(
        rows.withColumn(number, F.monotonically_increasing_id()).withColumn(key, -F.log(drawn) / quality)
    )
    sizes = numbered.groupBy("source").agg(F.sum(size).alias("source_size"))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = source_targets(sizes, weights, share, most).select(
        F.col("source").alias(of), "source_size", "target", F.col("place").alias(place),
        full.cast("int").alias(epochs), (F.col("target") - full * F.col("source_size")).alias(budget),
    )
    placed = numbered.join(targets, numbered["source"].eqNullSafe(targets[of])).drop(of)
    order = [key, number]
    laid = staged(placed.repartitionByRange(place, *order).withColumn(part, F.spark_partition_id()))
    in_source = Window.partitionBy(place).orderBy(part)
    totals = laid.groupBy(place, part).agg(F.sum(size).alias(offset))
    offsets = totals.withColumn(offset, F.sum(offset).over(in_source) - F.col(offset))
    running = F.sum(size).over(Window.partitionBy(place, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    front = laid.join(offsets, [place, part]).withColumn(before, F.col(offset) + running - size)
    chosen = (2 * F.col(before) + size <= 2 * F.col(budget)) & (F.col(budget) > 0)
    times = F.col(epochs) + F.when(chosen, 1).otherwise(0)
    return front.select(
        *rows.columns, "source_size", "target", times.cast("int").alias("times"), (times * size).cast("bigint").alias("taken")
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """Mix documents (doc_id, text, source) by words, one row per document.

    size: words of the whole text, a null text having none; the weight of a document is the quality
    of its characters; the draw depends on doc_id and text, so reruns agree and documents of equal
    text are drawn each for itself. Null doc_ids and sources are values like others. Other columns
    are not read.
    """
    require(docs, "doc_id", "text", "source")
    slim = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), quality_weight(F.col("text")).alias("quality"),
        draw(F.col("doc_id"), F.col("text")).alias("draw"),
    )
    return mix(slim).select("doc_id", "size", "source_size", "target", "taken")


# The same in SQL. The parameters above.
SQL = r"""
WITH rows AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    CASE WHEN coalesce(length(text), 0) = 0 THEN 1.0::DOUBLE
      ELSE 1.0::DOUBLE / (1.0::DOUBLE + 10.0::DOUBLE * (1.0::DOUBLE - length(translate(text, '#*$%&|<>0123456789', ''))::DOUBLE / length(text)))
    END AS quality,
    (('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 13))::BIGINT + 1)::DOUBLE
      / 4503599627370496::DOUBLE AS draw
  FROM documents),
sizes AS (SELECT source, sum(size)::DOUBLE AS source_size FROM rows GROUP BY source),
ranked AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS weight, 2 * source_size AS cap,
    row_number() OVER (ORDER BY source ASC NULLS LAST) AS place
  FROM sizes),
levels AS (
  SELECT *,
    (1.5::DOUBLE * sum(source_size) OVER ()
      - (sum(cap) OVER (ORDER BY cap / weight, place ROWS UNBOUNDED PRECEDING) - cap))
    / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
targets AS (
  SELECT source, source_size, CASE WHEN cap <= level * weight THEN cap
    ELSE weight * (SELECT arg_min(level, cap / weight) FROM levels WHERE cap > level * weight) END AS target
  FROM levels),
ordered AS (
  SELECT r.doc_id, r.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs,
    sum(r.size) OVER (PARTITION BY r.source ORDER BY -ln(r.draw) / r.quality, r.doc_id ROWS UNBOUNDED PRECEDING) - r.size AS before
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (size * (epochs + CASE WHEN target - epochs * source_size > 0 AND 2 * before + size <= 2 * (target - epochs * source_size)
    THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered
"""
