r"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A paragraph is a line without the white space around it. One of more than
``LONG`` characters is cut where its content says so: after every unit (a run of
letters with case, or any other one character) whose hash with the next unit's is
a multiple of ``CUT_ONE_IN``. So an edit changes the pieces around it and no others,
wherever it shifts the rest to; a run of letters is never cut. Every piece is hashed
to a wide vector of 0 and 1 (``LANES`` lanes from ``HASHES`` 64-bit hashes) and the vectors are
added lane by lane modulo 2 ** ``BITS``, more than any text has pieces: one of
2 ** 29 pieces has a gigabyte. The sum doesn't depend on the order of
the pieces; adding a piece's vector inserts it, subtracting it deletes it, and
the sums of two documents add up to that of both together. Two lanes share a
long integer, each with a spare bit above it, so one addition and one mask add
two lanes. Up to ``SLICE`` pieces are first added in narrow lanes, four to a
long, which they can't fill.

Likeness. With the piece count n, lane j gives the sign sum 2 * lane - n, whose
square has the piece counts' squared norm as its mean. For two fingerprints A
and B, 2 <A, B> / (|A|^2 + |B|^2), estimated over all lanes and cut to 0..1, is
1 for equal multisets and near 0 without shared pieces (standard error about
1 / sqrt(LANES)).

All of it is row-local: no text is regrouped for a fingerprint. Only the query's
edited texts need a document's neighbour, for which texts move once.

Defined results: a null text is an empty one, a text of white space alone has no pieces, and
two of these have likeness 1; rows that share a doc_id are fingerprinted each,
and follow each other by their texts; a null doc_id comes first; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcel.llm.common import ASCII_SPACE, whole_text

#: Longer paragraphs are cut, into pieces of so many units on average.
LONG, CUT_ONE_IN = 400, 24
UNIT = r"(?s)[\x20\x09-\x0D]*(?:[\p{L}&&[^\p{Lo}]]+|.)"
#: Documents in a bucket of neighbours, and how many buckets at most: their
#: first ids are gathered (16 bytes each).
BUCKET, MOST_BUCKETS = 1000, 65_536
HASHES = 4
BITS = 30  # lanes count modulo 2 ** 30
_FIELD = BITS + 1  # with the spare bit
_PER_LONG = 2
#: Lanes of 15 bits hold the sums of so many pieces.
_NARROW, _PER_NARROW = 15, 4
SLICE = (1 << _NARROW) - 1
_NARROWS = HASHES * _NARROW
LANES = _NARROWS * _PER_NARROW
LONGS = LANES // _PER_LONG
#: One bit of every narrow lane in a long; all value bits, and the spare ones, of every lane in one.
_ONES = sum(1 << (_NARROW * i) for i in range(_PER_NARROW))
_VALUES = sum(((1 << BITS) - 1) << (_FIELD * i) for i in range(_PER_LONG))
_SPARE = sum(1 << (_FIELD * i + BITS) for i in range(_PER_LONG))


def _cut(line: Column) -> Column:
    """The line with a line feed at every cut."""

    def of(units):
        def marked(unit, i):
            cut = F.pmod(F.xxhash64(unit, F.get(units, i + 1)), F.lit(CUT_ONE_IN)) == 0
            return F.when(cut, F.concat(unit, F.lit("\n"))).otherwise(unit)

        return F.array_join(F.transform(units, marked), "")

    # an array of one, so that the line is split once
    return F.get(F.transform(F.array(F.regexp_extract_all(line, F.lit(UNIT), F.lit(0))), of), F.lit(0))


def pieces(text: Column) -> Column:
    lines = F.transform(F.split(text, "\n"), lambda x: F.trim(x, F.lit(ASCII_SPACE)))
    cut = F.transform(lines, lambda x: F.when(F.char_length(x) > LONG, _cut(x)).otherwise(x))
    found = F.transform(F.split(F.array_join(cut, "\n"), "\n"), lambda x: F.trim(x, F.lit(ASCII_SPACE)))
    return F.filter(found, lambda x: x != "")


def _hashed(text: Column) -> Column:
    return F.transform(pieces(text), lambda p: F.array(*[F.xxhash64(F.lit(i), p) for i in range(HASHES)]))


def _bits(hashes: Column, j: int) -> Column:
    """Narrow long j of a piece's vector: four of the 60 bits used of one hash."""
    return F.shiftrightunsigned(F.get(hashes, F.lit(j // _NARROW)), j % _NARROW).bitwiseAND(F.lit(_ONES))


def _wide(narrow: Column) -> Column:
    """Two longs with two lanes each: the lanes of a narrow long."""
    lane = [F.shiftrightunsigned(narrow, _NARROW * i).bitwiseAND(F.lit(SLICE)) for i in range(_PER_NARROW)]
    return F.array(*[lane[i] + F.shiftleft(lane[i + 1], _FIELD) for i in range(0, _PER_NARROW, _PER_LONG)])


def fingerprint(text: Column) -> Column:
    """struct<n: number of pieces, v: LONGS packed lane sums>."""

    def zero(n: int) -> Column:
        return F.array_repeat(F.lit(0).cast("long"), n)

    def add(total, hashes):
        return F.array(*[F.get(total, F.lit(j)) + _bits(hashes, j) for j in range(_NARROWS)])

    def add_slice(total, narrow):
        return F.zip_with(total, F.flatten(F.transform(narrow, _wide)), lambda x, y: (x + y).bitwiseAND(F.lit(_VALUES)))

    def of(hashed):
        n = F.size(hashed)
        starts = F.sequence(F.lit(1), F.greatest(n, F.lit(1)), F.lit(SLICE))
        narrow = F.transform(starts, lambda at: F.aggregate(F.slice(hashed, at, F.lit(SLICE)), zero(_NARROWS), add))
        return F.struct(n.cast("long").alias("n"), F.aggregate(narrow, zero(LONGS), add_slice).alias("v"))

    # an array of one, so that the pieces are hashed once
    return F.get(F.transform(F.array(_hashed(text)), of), F.lit(0))


def inserted(a: Column, b: Column) -> Column:
    """The fingerprint of both multisets together."""
    return F.struct(
        (a["n"] + b["n"]).alias("n"), F.zip_with(a["v"], b["v"], lambda x, y: (x + y).bitwiseAND(F.lit(_VALUES))).alias("v")
    )


def deleted(a: Column, b: Column) -> Column:
    """The fingerprint of a without the pieces of b."""
    return F.struct((a["n"] - b["n"]).alias("n"), F.zip_with(a["v"], b["v"], _minus).alias("v"))


def _minus(x: Column, y: Column) -> Column:
    # the spare bits take the borrow of each lane
    return (x.bitwiseOR(F.lit(_SPARE)) - y).bitwiseAND(F.lit(_VALUES))


def _squares(v: Column, n: Column) -> Column:
    """Estimated squared norm of a (difference of) multiset(s)."""
    half, whole = 1 << (BITS - 1), 1 << BITS

    def of_long(total, x):
        for i in range(_PER_LONG):
            lane = F.shiftright(x, _FIELD * i).bitwiseAND(F.lit(whole - 1))
            # sign sums are at most the pieces, fewer than half of 2 ** BITS: back from the modulus
            sign = (F.pmod(lane * 2 - n + half, F.lit(whole)) - half).cast("double")
            total = total + sign * sign
        return total

    return F.aggregate(v, F.lit(0.0), of_long) / F.lit(float(LANES))


def likeness(a: Column, b: Column) -> Column:
    apart = _squares(F.zip_with(a["v"], b["v"], _minus), a["n"] - b["n"])
    both = _squares(a["v"], a["n"]) + _squares(b["v"], b["n"])
    estimate = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - apart / both))
    return F.when((a["n"] == b["n"]) & (a["v"] == b["v"]), F.lit(1.0)).when(both == 0, F.lit(0.0)).otherwise(estimate)


def to_string(print_: Column) -> Column:
    return F.concat_ws("-", F.hex(print_["n"]), F.concat_ws("", F.transform(print_["v"], lambda x: F.lpad(F.hex(x), 16, "0"))))


def _bucket(splitters: list[int]) -> Column:
    """How many of the sorted splitters are at most the doc_id, found in two
    steps of about a square root of them each; a null doc_id comes first."""
    width = max(1, int(len(splitters) ** 0.5))
    rows = [splitters[i : i + width] for i in range(0, len(splitters), width)]
    if not rows:
        return F.lit(0)

    def upto(values) -> Column:
        return F.size(F.filter(values, lambda x: x <= F.col("doc_id")))

    row = upto(F.array(*[F.lit(r[0]).cast("long") for r in rows]))
    inside = upto(F.element_at(F.array(*[F.array(*[F.lit(x).cast("long") for x in r]) for r in rows]), F.greatest(row, F.lit(1))))
    return F.when(F.col("doc_id").isNull() | (row == 0), F.lit(0)).otherwise((row - 1) * width + inside)


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, print, next_text, next_print``: the next document is the
    next row by doc_id and text, that of the last row the first. Texts move once:
    rows are dealt to buckets of neighbouring ids, and the first id of a bucket
    also goes to the bucket before, to follow its last one."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    ids = texts.select("doc_id")
    n = min(MOST_BUCKETS, ids.count() // BUCKET + 1)
    shares = [i / n for i in range(1, n)]
    found = ids.agg(F.percentile_approx("doc_id", shares, 10 * n)).first()[0] if shares else []
    bucket = _bucket(sorted({int(x) for x in found or []}))
    # of each bucket with rows, in order: its number, its first id (null before all others)
    least = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id"))
    starts = [(r["bucket"], r["first"]["doc_id"]) for r in ids.groupBy(bucket.alias("bucket")).agg(least.alias("first")).orderBy("bucket").collect()]
    before = {b: (first, starts[i - 1][0]) for i, (b, first) in enumerate(starts)}
    known = range(max(before, default=0) + 1)
    first_id = F.element_at(F.array(*[F.lit(before.get(b, (None, 0))[0]).cast("long") for b in known]), F.col("bucket") + 1)
    previous = F.element_at(F.array(*[F.lit(before.get(b, (None, 0))[1]) for b in known]), F.col("bucket") + 1)
    placed = texts.withColumn("print", fingerprint(F.col("text"))).withColumn("bucket", bucket)
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))
    guest = F.struct(previous.alias("bucket"), F.lit(True).alias("guest"))
    dealt = placed.select(
        "doc_id",
        "text",
        "print",
        F.explode_outer(F.when(F.col("doc_id").eqNullSafe(first_id), F.array(own, guest)).otherwise(F.array(own))).alias("place"),
    ).select("doc_id", "text", "print", "place.bucket", "place.guest")
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    return (
        dealt.withColumns({"next_text": F.lead("text").over(order), "next_print": F.lead("print").over(order)})
        .where("not guest")
        .drop("bucket", "guest")
    )


def query(docs: DataFrame) -> DataFrame:
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.char_length("text") - half), F.substring("next_text", F.lit(1), half))
    found = with_next(docs).withColumn("edited", edited).drop("next_text").withColumn("edited_print", fingerprint(F.col("edited")))
    return found.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        to_string(F.col("print")).alias("fingerprint"),
        to_string(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
