"""Fill-in-the-middle transformation by block rotations in place.

A text is cut into units (blanks and the word after them; blanks at its end),
and two cuts drawn from its doc_id make a prefix, a middle and a suffix. The
text goes into a bytearray, the sentinels are inserted at the cuts, and
neighbouring segments change places by three reversals, in place: reverse
each segment, then both together. The form says which segments did:

* ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle;
* ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle;
* ``plain``: the text as it is.

``restored`` finds the sentinels, rotates the segments back and deletes the
sentinels. It is exact: a text that holds a sentinel stays plain, and as no
sentinel begins with the end of another, none can arise at a seam.

Every row is done by itself where it is read: nothing is shuffled, and a task
holds a slice of an Arrow batch and one text twice.

Defined results: null and empty texts are plain, with no units; a null doc_id
draws as the empty string does; rows that share a doc_id draw the same numbers,
each for its own text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcel.llm.common import whole_text
from parcel.llm.textgrams import SPACE
from parcel.session import ship_package

# The sentinels.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Of 100 texts so many are transformed, and of 100 of these so many are spm.
TRANSFORMED, SPM = 50, 80
SEED = 42
#: Rows of a batch that are made at a time, and bytes reversed by one copy.
ROWS, COPIED = 256, 1 << 16

MADE = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_MADE = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]
)


def unit_ends(text: bytes) -> np.ndarray:
    """Where each unit ends, in bytes."""
    space = SPACE[np.frombuffer(text, np.uint8)]
    if not len(space):
        return np.empty(0, np.int64)
    return np.append(np.flatnonzero(~space[:-1] & space[1:]) + 1, len(space))


def _reverse(buf: bytearray, a: int, b: int) -> None:
    while b - a > 2 * COPIED:  # swap the ends, so that copies stay small
        head = buf[a : a + COPIED]
        buf[a : a + COPIED] = buf[b - COPIED : b][::-1]
        buf[b - COPIED : b] = head[::-1]
        a, b = a + COPIED, b - COPIED
    buf[a:b] = buf[a:b][::-1]


def rotate(buf: bytearray, a: int, middle: int, b: int) -> None:
    """The segments [a, middle) and [middle, b) change places."""
    _reverse(buf, a, middle)
    _reverse(buf, middle, b)
    _reverse(buf, a, b)


def arranged(text: bytes, first: int, second: int, form: str) -> bytearray:
    """The text, cut at two places, with its segments in the order of the form."""
    buf = bytearray(text)
    if form == "plain":
        return buf
    for at, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buf[at:at] = sentinel
    of_middle, of_suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(buf, of_middle if form == "psm" else 0, of_suffix, len(buf))
    return buf


def taken_apart(output: bytes, form: str) -> bytearray:
    """The text that ``arranged`` got."""
    buf = bytearray(output)
    if form == "plain":
        return buf
    if form == "psm":
        of_suffix = buf.index(SUFFIX)
        rotate(buf, of_suffix, buf.index(MIDDLE, of_suffix), len(buf))
    else:
        rotate(buf, 0, buf.index(PREFIX), len(buf))
    of_middle = buf.index(MIDDLE)
    of_suffix = buf.index(SUFFIX, of_middle)
    for at, sentinel in ((of_suffix, SUFFIX), (of_middle, MIDDLE), (0, PREFIX)):
        del buf[at : at + len(sentinel)]
    return buf


def _chars(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def _transform(text: bytes, h: tuple[int, int, int, int]) -> tuple:
    ends = unit_ends(text)
    n = len(ends)
    if not n or h[2] % 100 >= TRANSFORMED or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, text
    first, second = (int(ends[k - 1]) if k else 0 for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    form = "spm" if h[3] % 100 < SPM else "psm"
    return n, form, _chars(text[:first]), _chars(text[first:second]), arranged(text, first, second, form)


def _strings(values: list) -> pa.Array:
    """UTF-8 bytes as an array of strings."""
    return pa.array([bytes(v) for v in values], pa.binary()).cast(pa.string())


def _make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            draws = zip(*(batch.column(i).to_pylist() for i in range(2, 6)))
            n, form, prefix, middle, output = zip(*(_transform(t, h) for t, h in zip(texts, draws)))
            columns = [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, _strings(output)], schema=_MADE)


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            form = batch.column(batch.schema.get_field_index("form")).to_pylist()
            output = batch.column(batch.schema.get_field_index("output")).cast(pa.binary()).to_pylist()
            back = _strings([taken_apart(o, f) for o, f in zip(output, form)])
            yield pa.RecordBatch.from_arrays([*batch.columns, back], [*batch.schema.names, "restored"])


def _draws(doc_id: Column, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def transformed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``MADE``: one row for each document. ``output`` is the training text."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), *_draws(F.col("doc_id"), seed))
    return rows.mapInArrow(_make, MADE)


def restored(made: DataFrame) -> DataFrame:
    """``made`` with ``restored``: the text rebuilt from ``output`` and ``form``."""
    ship_package(made.sparkSession)
    return made.mapInArrow(_restore, f"{MADE}, restored string")


def query(docs: DataFrame) -> DataFrame:
    return restored(transformed(docs)).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS i, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS j,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
s AS (
  SELECT *, coalesce(array_to_string(units[1:i], ''), '') AS p, coalesce(array_to_string(units[i + 1:j], ''), '') AS m,
         coalesce(array_to_string(units[j + 1:], ''), '') AS s FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM s
"""
