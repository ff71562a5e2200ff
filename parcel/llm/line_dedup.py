"""Line dedup: which lines of each document stay, as compressed bitmaps.

A line's key is the line stripped of ASCII whitespace, with A-Z lower-cased.
A key of at least ``min_chars`` code points that occurs in at least
``min_docs`` documents loses all its lines, except those of the largest doc_id
that holds it.

Method. Lines travel as a 128-bit hash of the key with their document and
position, never as text. They are range-partitioned by hash and sorted within
by document, largest first, and position; one pass over each run of equal
hashes keeps the first document and drops the rest. The runs of the
``HOT_KEYS`` most frequent keys, which could fill a task, take no part in this:
their surviving document comes from an aggregate that combines before its
shuffle, and that table, bounded by its row count, is broadcast and decides
their lines where they are read. By the pigeonhole principle every other run
holds at most 1 in ``HOT_KEYS`` of all lines. Both ways give the same answer.

The result is one row per document: ``runs``, a run-length coded bitmap of its
lines (kept, dropped, kept, ...; the first run may be 0).

Defined results: a null or empty text is one empty line; rows that share a
doc_id count as one document (all of them keep or lose the key together); a
null doc_id is smaller than any other; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcel.llm.common import ASCII_SPACE, ascii_lower, materialise, text_key, whole_text

#: How many of the most frequent keys are decided by broadcast (48 bytes each).
HOT_KEYS = 2000
#: A key on fewer lines than this is never worth a broadcast row.
HOT_LINES = 64


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """``doc_id, tkey, pos, h1, h2`` of every line that is long enough."""
    lines = docs.select("doc_id", whole_text().alias("_text")).select(
        "doc_id", text_key(F.col("_text")).alias("tkey"), F.posexplode_outer(split_lines(F.col("_text"))).alias("pos", "_line")
    )
    key = ascii_lower(F.trim(F.col("_line"), F.lit(ASCII_SPACE)))
    return (
        lines.withColumn("_key", key)
        .where(F.char_length("_key") >= min_chars)
        .select("doc_id", "tkey", "pos", F.xxhash64("_key").alias("h1"), F.xxhash64(F.lit(1), "_key").alias("h2"))
    )


def dropped_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``doc_id, tkey, pos`` of the lines that go."""
    lines = materialise(line_hashes(docs, min_chars), "line-hashes")  # read three times below
    # bits of a hash of the ids: as many set bits, at least as many documents
    mark = F.expr("shiftleft(1L, cast(pmod(xxhash64(doc_id), 63) as int))")
    hot = (
        lines.groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"), F.bit_or(mark).alias("marks"))
        .where((F.col("n") >= HOT_LINES) & (F.bit_count("marks") >= min_docs))
        .orderBy(F.desc("n"), "h1", "h2")
        .limit(HOT_KEYS)
        .select("h1", "h2", "keeper", F.lit(True).alias("hot"))
    )
    routed = lines.join(F.broadcast(hot), ["h1", "h2"], "left")
    of_hot = routed.where(F.col("hot") & ~F.col("doc_id").eqNullSafe(F.col("keeper")))
    run = Window.partitionBy("h1", "h2")
    place = F.dense_rank().over(run.orderBy(F.col("doc_id").desc_nulls_last()))
    of_rest = (
        routed.where(F.col("hot").isNull())
        .select("doc_id", "tkey", "pos", "h1", "h2")
        .repartitionByRange("h1", "h2")
        .sortWithinPartitions("h1", "h2", F.col("doc_id").desc_nulls_last(), "pos")
        .withColumn("place", place)
        .withColumn("docs", F.max("place").over(run))
        .where((F.col("place") > 1) & (F.col("docs") >= min_docs))
    )
    return of_hot.select("doc_id", "tkey", "pos").unionByName(of_rest.select("doc_id", "tkey", "pos"))


def _bitmap(positions: Column) -> Column:
    """Sorted positions of dropped lines -> the bounds of their runs."""
    first = F.filter(positions, lambda p, i: (i == 0) | (F.get(positions, i - 1) < p - 1))
    last = F.filter(positions, lambda p, i: (i == F.size(positions) - 1) | (F.get(positions, i + 1) > p + 1))
    return F.struct(first.alias("first"), last.alias("last"))


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``doc_id, tkey, n_dropped, bitmap`` for each document that loses lines
    (no row: it keeps all). The bitmap is run-length coded: the first and last
    line of every run of dropped lines, all others stay."""
    return (
        dropped_lines(docs, min_chars, min_docs)
        .groupBy("doc_id", "tkey")
        .agg(F.sort_array(F.collect_set("pos")).alias("_at"))
        .select("doc_id", "tkey", F.size("_at").cast("long").alias("n_dropped"), _bitmap(F.col("_at")).alias("bitmap"))
    )


def kept_text(text: Column, bitmap: Column) -> Column:
    """The lines that stay, joined by newlines."""
    lines = split_lines(text)
    runs = F.transform(
        F.array_append(bitmap["first"], F.size(lines)),
        lambda stop, i: F.slice(
            lines, F.coalesce(F.get(bitmap["last"], i - 1) + 2, F.lit(1)), stop - F.coalesce(F.get(bitmap["last"], i - 1) + 1, F.lit(0))
        ),
    )
    return F.when(bitmap.isNull(), text).otherwise(F.array_join(F.flatten(runs), "\n"))


def with_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``doc`` (a struct of all columns of ``docs``), ``n_dropped`` and ``bitmap``
    (null: nothing is dropped). Only here do texts move, once."""
    held = docs.select(F.struct(*docs.columns).alias("doc"), F.struct(F.col("doc_id"), text_key(whole_text()).alias("tkey")).alias("of"))
    maps = keep_bitmaps(docs, min_chars, min_docs).select(F.struct("doc_id", "tkey").alias("found"), "n_dropped", "bitmap")
    same = F.col("of.doc_id").eqNullSafe(F.col("found.doc_id")) & (F.col("of.tkey") == F.col("found.tkey"))
    return held.join(maps, same, "left").select("doc", F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "bitmap")


def query(docs: DataFrame) -> DataFrame:
    marked = with_bitmaps(docs.select("doc_id", "text"))
    text = F.coalesce("doc.text", F.lit(""))
    return marked.select(
        "doc.doc_id",
        F.size(split_lines(text)).cast("long").alias("n_lines"),
        "n_dropped",
        F.sha2(kept_text(text, F.col("bitmap")), 256).alias("kept_sha256"),
    )


def deduped(docs: DataFrame) -> DataFrame:
    """The documents with the lines that stay; a document that loses all its
    lines goes. ``n_chars`` follows the text; the other columns stay."""
    whole = F.coalesce("doc.text", F.lit(""))
    lines_left = F.size(split_lines(whole)) - F.col("n_dropped")
    untouched = F.col("bitmap").isNull()
    text = F.when(untouched, F.col("doc.text")).otherwise(kept_text(whole, F.col("bitmap")))
    out = {"text": text, "n_chars": F.when(untouched, F.col("doc")["n_chars"]).otherwise(F.char_length(text).cast("long")) if "n_chars" in docs.columns else None}
    return with_bitmaps(docs).where(lines_left > 0).select(*[out.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


SQL = """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
lines AS (SELECT doc_id, rid, string_split(text, chr(10)) AS parts FROM docs),
each AS (SELECT doc_id, rid, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM lines),
keyed AS (
  SELECT doc_id, rid, line, pos,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM each),
stats AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
          GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT k.*, s.keeper IS NOT NULL AND k.doc_id <> s.keeper AS gone FROM keyed k LEFT JOIN stats s USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id, rid
"""
