"""Benchmark decontamination by winnowing.

A window is ``n`` consecutive words of a benchmark item (all of its words, if
it has fewer); a word of a document inside any occurrence of a window is hit.

Method. Words are hashed, every run of ``k`` words gives a k-gram hash, and of
every ``n - k + 1`` neighbouring k-grams the smallest hash is kept, for the
benchmark and the documents alike. Any span of ``n`` words that both share
therefore keeps a k-gram at the same place in both, so joining the kept
k-grams finds every shared window. A hit is extended by comparing all
n-word windows around the k-gram; the words needed for that travel with the
fingerprint, so no text is shuffled. Items below ``n`` words are looked up by
all word runs of their lengths, if there are any such items: at most n - 1 lengths.

The texts are read once: their words are hashed, and the kept k-grams, the short
runs and one row with the number of words leave together. What matches the
benchmark is stored, with a row for each document, and all else starts there.

The benchmark's fingerprints are broadcast if they are counted to be at most
``BROADCAST_ROWS``; a larger benchmark is joined by a shuffle.

Defined results: null and empty texts have no words and are clean; rows that
share a doc_id are judged each by its own text; items that share an item_id
count as one; a null item_id is listed as an empty string; items without words
never match; an empty benchmark leaves all documents clean. Other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcel.llm.common import ascii_lower, materialise, text_key, whole_text

# Fixed value: what lies between words. To split there is several times faster
# than to extract the words.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Fingerprints (under 150 bytes each) that may be broadcast.
BROADCAST_ROWS = 100_000


def word_hashes(text: Column) -> Column:
    return F.transform(F.array_remove(F.split(ascii_lower(text), BETWEEN), ""), lambda w: F.xxhash64(w))


def _places(count: Column) -> Column:
    """0 .. count - 1, empty if there are none."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def _gram(words: Column, start: Column, length: int) -> Column:
    return F.xxhash64(F.lit(length), *[F.get(words, start + j) for j in range(length)])


def _grams(length: int) -> Column:
    """Hashes of all runs of so many of the ``words``."""
    return F.transform(_places(F.size("words") - (length - 1)), lambda i: _gram(F.col("words"), i, length))


def _entry(at: Column, length: int, fp: Column, around: Column | None = None) -> Column:
    none = F.lit(None).cast("array<bigint>")
    return F.struct(at.cast("int").alias("at"), F.lit(length).alias("length"), fp.alias("fp"), (none if around is None else around).alias("around"))


def _runs(length: int) -> Column:
    """An entry for each run of so many of the ``words``."""
    return F.transform(_places(F.size("words") - (length - 1)), lambda i: _entry(i, length, _gram(F.col("words"), i, length)))


def _prints(rows: DataFrame, k: int, n: int, short: list[int]) -> DataFrame:
    """Rows with a column ``words`` -> one row per kept k-gram (``length`` n),
    with ``at``, ``fp`` and ``around``: the words of all n-word windows that hold
    it; and one row per run of each length in ``short``."""
    w = n - k + 1
    grams = rows.withColumn("_g", _grams(k))
    minima = grams.withColumn(
        "_m", F.transform(_places(F.size("_g") - (w - 1)), lambda s: F.least(*[F.get(F.col("_g"), s + j) for j in range(w)]))
    )
    # kept: the smallest of at least one of the windows that hold it
    kept = F.filter(
        _places(F.size("_g")),
        lambda p: F.get(F.col("_g"), p) == F.greatest(*[F.get(F.col("_m"), p - j) for j in range(w)]),
    )
    around = lambda p: F.transform(F.sequence(p - (n - k), p + (n - 1)), lambda j: F.get(F.col("words"), j))
    found = [F.transform(kept, lambda p: _entry(p, n, F.get(F.col("_g"), p), around(p)))]
    found += [_runs(length) for length in short]
    return minima.withColumn("_f", F.concat(*found)).drop("words", "_g", "_m")


def _windows_around(around: Column, k: int, n: int) -> Column:
    """Hash of the n-word window that starts d words before the k-gram, for
    d = 0 .. n - k; null where the text has no such window."""
    out = []
    for d in range(n - k + 1):
        first = n - k - d
        inside = F.get(around, F.lit(first)).isNotNull() & F.get(around, F.lit(first + n - 1)).isNotNull()
        out.append(F.when(inside, _gram(around, F.lit(first), n)))
    return F.array(*out)


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _short_window(lengths: list[int]) -> Column:
    """The one window of an item of fewer words."""
    return F.coalesce(F.lit(None).cast("bigint"), *[F.when(F.size("words") == m, _gram(F.col("words"), F.lit(0), m)) for m in lengths])


def searched(docs: DataFrame, benchmark: DataFrame, n: int = 10, k: int = 6) -> tuple[DataFrame, DataFrame]:
    """(``doc_id, tkey, n_words, hits`` with a row for each document, whose
    ``hits`` is null, and one for each fingerprint met: an array of ``start,
    length, window``; ``window, item``)."""
    items = materialise(
        benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), word_hashes(whole_text()).alias("words")),
        "benchmark-words",
    ).where(F.size("words") > 0)
    short = sorted(r[0] for r in items.where(F.size("words") < n).select(F.size("words")).distinct().collect())  # below n values
    none = F.lit(None).cast("array<bigint>")
    of_grams = _prints(items, k, n, []).select(F.inline_outer("_f")).where("fp is not null").select(
        "fp", "length", _windows_around(F.col("around"), k, n).alias("theirs")
    )
    of_short = items.where(F.size("words") < n).select(_short_window(short).alias("fp"), F.size("words").alias("length"), none.alias("theirs"))
    marks = materialise(of_grams.unionByName(of_short).distinct(), "benchmark-prints")

    text = docs.select("doc_id", whole_text().alias("_text"))
    texts = text.select("doc_id", text_key(F.col("_text")).alias("tkey"), word_hashes(F.col("_text")).alias("words"))
    made = _prints(texts.withColumn("n_words", F.size("words").cast("long")), k, n, short)
    # one row for the document itself: length 0 is no fingerprint's
    own = F.array(_entry(F.lit(-1), 0, F.xxhash64("doc_id", "tkey")))
    # outer: else the optimizer adds a filter that computes all this once more
    rows = made.select("doc_id", "tkey", "n_words", F.inline_outer(F.concat(own, "_f")))
    met = rows.join(_bounded(marks.withColumn("_met", F.lit(True)), marks.count()), ["fp", "length"], "left").where("length = 0 or _met")
    pairs = F.arrays_zip(_windows_around(F.col("around"), k, n).alias("ours"), F.col("theirs").alias("theirs"))
    hit = lambda start, length, window: F.struct(start.alias("start"), length.alias("length"), window.alias("window"))
    extended = F.filter(
        F.transform(pairs, lambda x, d: hit(F.col("at") - d, F.lit(n), F.when(x["ours"] == x["theirs"], x["ours"]))),
        lambda x: x["window"].isNotNull(),
    )
    whole = F.array(hit(F.col("at"), F.col("length"), F.col("fp")))
    hits = F.when(F.col("length") > 0, F.when(F.col("theirs").isNull(), whole).otherwise(extended))
    found = materialise(met.select("doc_id", "tkey", "n_words", hits.alias("hits")), "benchmark-hits")
    windows = items.where(F.size("words") >= n).select(F.explode(_grams(n)).alias("window"), "item").unionByName(
        items.where(F.size("words") < n).select(_short_window(short).alias("window"), "item")
    )
    return found, windows.distinct()


def _contaminated(found: DataFrame, windows: DataFrame) -> DataFrame:
    """``doc_id, tkey, n_hit, items`` of the documents with hits."""
    hits = found.where("size(hits) > 0").select("doc_id", "tkey", F.explode("hits").alias("w"))
    of_doc = hits.groupBy("doc_id", "tkey").agg(F.collect_set("w").alias("_w"))
    covered = F.flatten(F.transform("_w", lambda x: F.sequence(x["start"], x["start"] + x["length"] - 1)))
    counted = of_doc.select(
        "doc_id", "tkey", F.size(F.array_distinct(covered)).cast("long").alias("n_hit"), F.array_distinct(F.col("_w.window")).alias("_w")
    )
    return (
        counted.select("doc_id", "tkey", "n_hit", F.explode("_w").alias("window"))
        .join(windows, "window")
        .groupBy("doc_id", "tkey")
        .agg(F.first("n_hit").alias("n_hit"), F.sort_array(F.collect_set("item")).alias("items"))
    )


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, k: int = 6) -> DataFrame:
    """``doc_id, tkey, n_hit, items`` of the documents with hits."""
    return _contaminated(*searched(docs, benchmark, n, k))


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    met, windows = searched(docs.select("doc_id", "text"), benchmark)
    counted = met.where("hits is null").select("doc_id", "n_words", F.col("tkey").alias("_tkey"))
    found = _contaminated(met, windows).withColumnRenamed("doc_id", "_id")
    on = counted["doc_id"].eqNullSafe(found["_id"]) & (counted["_tkey"] == found["tkey"])
    items = F.coalesce("items", F.array().cast("array<string>"))
    return counted.join(found, on, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a hit, all columns as they are."""
    found = contamination(docs, benchmark).select(F.struct("doc_id", "tkey").alias("found"))
    held = docs.select(F.struct(*docs.columns).alias("doc"), F.struct(F.col("doc_id"), text_key(whole_text()).alias("tkey")).alias("of"))
    same = F.col("of.doc_id").eqNullSafe(F.col("found.doc_id")) & (F.col("of.tkey") == F.col("found.tkey"))
    return held.join(found, same, "left_anti").select("doc.*")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
places AS (SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS s FROM b WHERE len(words) > 0),
windows AS (SELECT DISTINCT item, least(len(words), 10) AS n, array_to_string(words[s:s + 9], ' ') AS w FROM places),
sizes AS (SELECT DISTINCT n FROM windows),
starts AS (SELECT rid, words, n, unnest(range(1, len(words) - n + 2)) AS s FROM d, sizes WHERE len(words) >= n),
runs AS (SELECT rid, n, s, array_to_string(words[s:s + n - 1], ' ') AS w FROM starts),
hits AS (SELECT r.rid, r.n, r.s, v.item FROM runs r JOIN windows v ON r.n = v.n AND r.w = v.w),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM hits) GROUP BY rid),
named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(m.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(m.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (rid) LEFT JOIN named m USING (rid)
"""
