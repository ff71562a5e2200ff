"""Source-vs-target reconciliation as joins and aggregations
(J1-J4, U1-U4, A5, O1, O3).

Inputs are inventories with at least ``filename`` and ``size`` (the source
side also ``key`` and, for per-export verdicts, ``export_name``). Names are
compared by basename, as files land in one flat target folder, and within an
export: two exports may hold the same names.

Scale notes
-----------
* The source is shuffled and sorted by name once. Repeated names, the join with
  the target and the per-name state all use that order.
* ``classify`` is the complete relation: every name with its state. ``verdict``
  stores it once and takes counts and samples from there; neither gathers an
  export's names into one task. All samples come from one window: the first
  names of each state, under a constant bound (a partial ``WindowGroupLimit``
  before the shuffle), hold the first names of any set of states.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcel.session import stored

# Sizes of the samples (O3): the first names of the source, of those present on
# the target, missing there, and with another size there. The complete lists
# are the rows of ``classify``.
SAMPLES = {"source_sample": 3, "target_sample": 3, "missing_sample": 10, "mismatch_sample": 5}

MISMATCH_TYPE = T.ArrayType(T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("source_size", T.LongType()),
    T.StructField("target_size", T.LongType()),
]))


def _name_key(df: DataFrame) -> list[str]:
    return ["filename", *(["export_name"] if "export_name" in df.columns else [])]


def dedupe_source(src: DataFrame) -> DataFrame:
    """U4 + duplicate basenames: one row per ``filename`` (and export); the
    object with the greatest key wins, the last one of a listing in key order."""
    columns = [*_name_key(src), "size", *(["key"] if "key" in src.columns else [])]
    order = [F.col(c) for c in ("key", "size") if c in columns]
    later = F.lead(F.lit(1)).over(Window.partitionBy(*_name_key(src)).orderBy(*order))
    return src.select(*columns, later.alias("_later")).where("_later is null").drop("_later")


def dedupe_target(tgt: DataFrame) -> DataFrame:
    """One row per target name. Names in a flat folder are unique already;
    should an inventory repeat one, the largest size is kept."""
    return tgt.groupBy("filename").agg(F.max("size").alias("size"))


def missing_on_target(src: DataFrame, tgt: DataFrame) -> DataFrame:
    """Source names absent from the target. Only these are deduplicated."""
    return dedupe_source(src.join(tgt.select("filename"), "filename", "left_anti"))


def extra_on_target(src: DataFrame, tgt: DataFrame) -> DataFrame:
    """Target names absent from the source."""
    return dedupe_target(tgt).join(src.select("filename"), "filename", "left_anti")


def relevant_target(src: DataFrame, tgt: DataFrame) -> DataFrame:
    """Target files whose names the source has."""
    return dedupe_target(tgt).join(src.select("filename"), "filename", "left_semi")


def size_mismatches(src: DataFrame, tgt: DataFrame) -> DataFrame:
    """Names on both sides whose sizes differ; NULL vs a number differs,
    NULL vs NULL is equal."""
    s = dedupe_source(src).withColumnRenamed("size", "source_size")
    t = dedupe_target(tgt).withColumnRenamed("size", "target_size")
    return s.join(t, "filename").where(~F.col("source_size").eqNullSafe(F.col("target_size")))


# Sides that hold a name, as bits.
SOURCE, TARGET = 1, 2


def name_sides(src: DataFrame, tgt: DataFrame) -> DataFrame:
    """U1-U4 in one pass: every distinct ``filename`` with ``sides``, the bits of
    the sides that hold it. Each side is read once and reduced before the
    shuffle."""
    marked = src.select("filename", F.lit(SOURCE).alias("side")).unionByName(tgt.select("filename", F.lit(TARGET).alias("side")))
    return marked.groupBy("filename").agg(F.bit_or("side").alias("sides"))


def name_set(sides: Column, set_op: str) -> Column:
    """Is a name with these ``sides`` in the set ``missing``, ``extra``,
    ``common`` or ``all``?"""
    return {"missing": sides == SOURCE, "extra": sides == TARGET, "common": sides == SOURCE | TARGET, "all": sides > 0}[set_op]


def names_missing(src_names: DataFrame, tgt_names: DataFrame) -> DataFrame:
    return name_sides(src_names, tgt_names).where(name_set(F.col("sides"), "missing")).select("filename")


def names_common(src_names: DataFrame, tgt_names: DataFrame) -> DataFrame:
    return name_sides(src_names, tgt_names).where(name_set(F.col("sides"), "common")).select("filename")


def names_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return name_sides(a, b).select("filename")


def classify(src: DataFrame, tgt: DataFrame) -> DataFrame:
    """Every (deduplicated) source name with its target state:
    ``filename, export_name, source_size, target_size, on_target,
    size_match, state`` where state is ``ok``, ``missing`` or ``mismatch``."""
    s = dedupe_source(src).withColumnRenamed("size", "source_size")
    t = dedupe_target(tgt).select("filename", F.col("size").alias("target_size"), F.lit(True).alias("on_target"))
    j = s.join(t, "filename", "left")
    on = F.coalesce(F.col("on_target"), F.lit(False))
    match = on & F.col("source_size").eqNullSafe(F.col("target_size"))
    state = F.when(~on, "missing").when(~match, "mismatch").otherwise("ok")
    return j.select(
        "filename",
        *[c for c in ("export_name", "key") if c in s.columns],
        "source_size", "target_size", on.alias("on_target"), match.alias("size_match"), state.alias("state"),
    )


def _export_frame(spark: SparkSession, exports) -> DataFrame:
    if isinstance(exports, DataFrame):
        return exports.select("export_name").distinct()
    # a handful of configured names: a one-row relation exploded on the JVM
    names = F.array(*[F.lit(str(e)) for e in dict.fromkeys(exports)]) if exports else F.array().cast("array<string>")
    return spark.range(1).select(F.explode(names).alias("export_name"))


def verdict(
    src: DataFrame,
    tgt: DataFrame,
    exports=None,
    label: str | None = None,
    samples: dict[str, int] | None = None,
    include_extra: bool = False,
) -> DataFrame:
    """A5: one row per export (or one row overall): counts, outcome and the
    samples of ``SAMPLES``. The names themselves are the rows of ``classify``.

    ``exports`` (names or a DataFrame with ``export_name``) drives the rows,
    so an export without source files still gets a row with
    ``in_sync = false`` and ``no_files_found = true``. Without ``exports``,
    the source must carry ``export_name``, or ``label`` names one overall row.

    ``in_sync = has_files and no missing and no size mismatch``; extra target
    files do not break sync. ``outcome`` is ``ok``, ``no_files`` or
    ``out_of_sync``.

    ``include_extra`` adds ``extra_count``: target names absent from the
    source (J2), attributed to an export by their shard name (I7), or all of
    them for a ``label`` verdict. Without ``exports``, an export that has only
    extra files gets a row, and names that are no shard's have one with a null
    ``export_name``.
    """
    spark = src.sparkSession
    sizes = {**SAMPLES, **(samples or {})}
    single = label is not None or "export_name" not in src.columns
    if single:
        name = label if label is not None else ""
        src = src.withColumn("export_name", F.lit(name))
        exports = [name] if exports is None else exports
    c = stored(classify(src, tgt), "classified")

    counts = c.groupBy("export_name").agg(
        F.count(F.lit(1)).alias("source_file_count"),
        F.count_if(F.col("on_target")).alias("target_file_count"),
        F.count_if(F.col("state") == "missing").alias("missing_count"),
        F.count_if(F.col("state") == "mismatch").alias("mismatch_count"),
    )

    # the first names of each state hold the first names of any set of states
    most = max(sizes.values())
    in_state = Window.partitionBy("export_name", "state").orderBy("filename")
    first = c.withColumn("_rn", F.row_number().over(in_state)).where(F.col("_rn") <= most)
    entry = F.struct("filename", "source_size", "target_size", "state")
    held = first.groupBy("export_name").agg(F.sort_array(F.collect_list(entry)).alias("_held"))

    extras, extra_cols = None, []
    if include_extra:
        from parcel.functions.paths import shard_fields

        extra = extra_on_target(src, tgt)
        owner = F.lit(label if label is not None else "") if single else shard_fields("filename")["export_name"]
        extras = extra.select(owner.alias("owner")).groupBy("owner").agg(F.count(F.lit(1)).alias("extra_count"))
        extra_cols = [F.coalesce("extra_count", F.lit(0).cast("bigint")).alias("extra_count")]
    if exports is not None:
        base = _export_frame(spark, exports)
    else:
        base = counts.select("export_name")
        if extras is not None:  # an export may have extra files only
            base = base.unionByName(extras.select(F.col("owner").alias("export_name"))).distinct()
    out = base.join(counts, "export_name", "left").join(held, "export_name", "left")
    if extras is not None:
        out = out.join(extras, F.col("export_name").eqNullSafe(F.col("owner")), "left")

    def sample(name: str, member, value) -> Column:
        names = F.transform(F.filter("_held", member), value)
        return F.slice(names, 1, sizes[name])

    filename = lambda x: x["filename"]
    picks = {
        "source_sample": sample("source_sample", lambda x: F.lit(True), filename),
        "target_sample": sample("target_sample", lambda x: x["state"] != "missing", filename),
        "missing_sample": sample("missing_sample", lambda x: x["state"] == "missing", filename),
        "mismatch_sample": sample("mismatch_sample", lambda x: x["state"] == "mismatch", lambda x: F.struct(
            x["filename"].alias("filename"), x["source_size"].alias("source_size"), x["target_size"].alias("target_size"))),
    }
    zero = F.lit(0).cast("bigint")
    src_n = F.coalesce("source_file_count", zero)
    miss_n = F.coalesce("missing_count", zero)
    mism_n = F.coalesce("mismatch_count", zero)
    in_sync = (src_n > 0) & (miss_n == 0) & (mism_n == 0)
    empty = F.array().cast("array<string>")
    return out.select(
        "export_name",
        in_sync.alias("in_sync"),
        src_n.alias("source_file_count"),
        F.coalesce("target_file_count", zero).alias("target_file_count"),
        miss_n.alias("missing_count"),
        mism_n.alias("mismatch_count"),
        *[F.coalesce(picks[n], empty).alias(n) for n in ("source_sample", "target_sample", "missing_sample")],
        F.coalesce(picks["mismatch_sample"], F.array().cast(MISMATCH_TYPE)).alias("mismatch_sample"),
        (src_n == 0).alias("no_files_found"),
        F.when(src_n == 0, "no_files").when(in_sync, "ok").otherwise("out_of_sync").alias("outcome"),
        *extra_cols,
    )
