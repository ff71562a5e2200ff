"""Mixing sources to target weights by capped water-filling.

Every source asks for its weight's share of the budget and is clamped at
``max_epochs`` times its size; what it cannot use is shared again among the
others by weight until no target is above its clamp. A target is then met by
whole repetitions of all documents of the source and one fractional
repetition: the documents of the source in a seeded order, up to the words
that are still wanted. The last document of that fraction is taken in part, so
each source meets its target to the word.

Defined results: a null text has size 0; a null source is a source of its own
and comes last; documents of size 0 take 0 words; a source without words has
target 0; rows that share a doc_id are mixed as separate documents; an empty
table gives an empty plan. Columns of the input other than those named are
ignored.

At scale the texts are read once, for their sizes. The seeded order of a source
is never sorted as a whole: sums over ``SLICES`` slices of the hash space find
the one slice where the fraction ends, and only its documents are ordered.
The list of sources itself (one row each) is ordered in one task. It is written
before the documents are joined with it: so Spark knows its size, sends a
short list to them and shuffles no text but those of the ordered slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcel.llm.common import WORD, materialise, whole_text

SEED = "mix-1"
#: Slices of a source's seeded order: 16 ** hex digits.
SLICE_DIGITS = 3


def cyclic_weights(sources: DataFrame, weights: tuple[float, ...] = (3, 1, 2)) -> DataFrame:
    """``weights`` in turn over the sources by code point, null last."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))


def water_fill(sources: DataFrame, budget_share: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """``source, source_size, weight`` -> the same with ``target``.

    Sorted by clamp per weight, the sources that are clamped come first, so
    the level is the budget left after them over the weight left after them,
    at the first source that this level does not clamp.
    """
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levelled = (
        sources.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("rank", F.row_number().over(by_ratio))
        .withColumn(
            "level",
            (F.col("total") * F.lit(float(budget_share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / (F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
        )
        .withColumn("open", F.col("cap") >= F.col("weight") * F.col("level"))
        .withColumn("at", F.min(F.when(F.col("open"), F.struct("rank", "level"))).over(everything))
    )
    target = F.coalesce(F.least("cap", F.col("weight") * F.col("at.level")), F.col("cap"))
    return levelled.select("source", "source_size", "weight", target.alias("target"))


def _order_key(seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    budget_share: float = 1.5,
    max_epochs: float = 2.0,
    seed: str = SEED,
    keep: bool = False,
) -> DataFrame:
    """``doc_id, text, source`` -> ``doc_id, source, size, source_size,
    target, taken``, one row per input row; with ``keep`` also ``doc``, a struct
    of all columns of the row."""
    kept = ["doc"] if keep else []
    key = _order_key(seed)
    sized = materialise(
        docs.select(
            "doc_id",
            "source",
            F.regexp_count(whole_text(), F.lit(WORD)).cast("long").alias("size"),
            key.alias("key"),
            *([F.struct(*docs.columns).alias("doc")] if keep else []),
        ).withColumn("slice", F.substring("key", 1, SLICE_DIGITS)),
        "mix-sizes",
    )
    slices = sized.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    totals = slices.groupBy("source").agg(F.sum("words").alias("source_size"))
    goals = (
        water_fill(cyclic_weights(totals, weights), budget_share, max_epochs)
        .withColumn("goal", F.round("target").cast("long"))
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("goal") / F.col("source_size"))).otherwise(0))
        .withColumn("rest", F.col("goal") - F.col("whole") * F.col("source_size"))
    )
    # the slice in which each source's fractional repetition ends, and the words before it
    running = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = materialise(
        slices.withColumn("upto", F.sum("words").over(running))
        .join(goals.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .groupBy("source")
        .agg(
            F.first("source_size").alias("source_size"),
            F.first("target").alias("target"),
            F.first("whole").alias("whole"),
            F.first("rest").alias("rest"),
            F.min(F.when(F.col("upto") >= F.col("rest"), F.struct("slice", (F.col("upto") - F.col("words")).alias("before")))).alias("end"),
        )
        .withColumnRenamed("source", "_source"),
        "mix-ends",
    )
    planned = sized.join(ends, F.col("source").eqNullSafe(F.col("_source")))
    clear = planned.where(F.col("slice") != F.col("end.slice")).withColumn(
        "extra", F.when(F.col("slice") < F.col("end.slice"), F.col("size")).otherwise(F.lit(0))
    )
    inside = Window.partitionBy("source").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    cut = planned.where(F.col("slice") == F.col("end.slice")).withColumn(
        "extra",
        F.greatest(
            F.lit(0),
            F.least("size", F.col("rest") - F.col("end.before") - F.coalesce(F.sum("size").over(inside), F.lit(0))),
        ),
    )
    return clear.unionByName(cut).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("extra")).cast("long").alias("taken"), *kept
    )


def repetitions(docs: DataFrame, **mixing) -> DataFrame:
    """The mixed corpus: each row of ``docs`` once per whole repetition and its
    first words for a part of one, with ``repetition`` (from 0) and ``words``
    (which replace columns of these names). The mix is planned on the rows
    themselves, so rows that share a doc_id are repeated each by its own share."""
    plan = mix(docs, keep=True, **mixing).where("taken > 0")
    part_of = F.transform(
        F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("size")).cast("int") - 1),
        lambda i: F.struct(i.alias("repetition"), F.least(F.col("size"), F.col("taken") - i * F.col("size")).alias("words")),
    )
    wanted = plan.select("doc", "size", F.explode(part_of).alias("r"))
    own = F.col("doc.text")
    part = F.regexp_extract(own, r"\A[\x20\x09-\x0D]*", 0)
    words = F.regexp_extract_all(own, F.lit(WORD), F.lit(0))
    text = F.when(F.col("r.words") == F.col("size"), own).otherwise(
        F.concat(part, F.array_join(F.slice(words, F.lit(1), F.col("r.words").cast("int")), " "))
    )
    kept = [c for c in docs.columns if c not in ("repetition", "words")]
    return wanted.select(*[(text if c == "text" else F.col("doc")[c]).alias(c) for c in kept], "r.repetition", "r.words")


def query(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


SQL = f"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
         source_size * 2.0::DOUBLE AS cap FROM totals),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
            - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
           / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE)) AS level,
         row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS rank FROM weighed),
final AS (SELECT arg_min(level, rank) AS level FROM levels WHERE cap >= weight * level),
goals AS (
  SELECT source, source_size, coalesce(least(cap, weight * final.level), cap) AS target
  FROM levels LEFT JOIN final ON true),
placed AS (
  SELECT s.*, g.source_size, g.target, CAST(round(g.target) AS BIGINT) AS goal,
         CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0
            ELSE goal // source_size * size + greatest(0, least(size, goal % source_size - before)) END AS BIGINT) AS taken
FROM placed
"""
