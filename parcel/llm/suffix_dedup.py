"""Exact substring dedup with a sparse, range-partitioned suffix index.

A byte of a text is removed if a string of 200 bytes that covers it also starts
anywhere else in the corpus, in the same text or another.

Method. To sort every suffix, each would have to carry its 200 bytes: 200 times
the input. So suffixes are taken at anchors only (see ``winnow_bytes``): every
200-byte window has one, about one place in 85, and equal windows have it at
the same place.

1. Anchors are counted by their first 32 bytes. Those that occur once cannot be
   in a repeated window and go; the count combines before its shuffle.
2. The others' suffixes, with the bytes of all windows that they are the anchor
   of, are range-partitioned by their leading bytes with sampled splitters.
3. A bucket is sorted by leading bytes and gram, then by the keys of the windows;
   neighbours that are equal are repeated windows. The windows have to agree on
   both sides of the anchor, for which no single suffix order serves, hence the
   sort by window keys (64 bits, within a gram's group: 128 bits in all) in the
   place of further suffix words. Splitters are leading bytes, so equal suffixes
   are never on both sides of a boundary: none is left to compare across.
4. Grams of more than ``HOT`` anchors would make a bucket of any size. Their
   windows go to an aggregate by key, which combines before its shuffle, instead.
5. Repeated windows are merged to spans per text, and the texts are cut.

Defined results: a null text is an empty one; texts below 200 bytes keep all;
rows that share a doc_id are different texts, and so are equal rows, which
remove each other's strings like any copies; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel.llm.common import materialise, whole_text
from parcel.llm.textgrams import bytes_of, mixed
from parcel.llm.winnow_bytes import CHUNK, LENGTH, runs_of, string_hashes
from parcel.session import ship_package

#: Anchors of a gram beyond which its windows are counted by an aggregate.
HOT = 20_000
#: Suffixes that a bucket should hold, and the share of anchors that give splitters.
BUCKET, SPLIT_ONE_IN = 20_000, 64
#: Bytes of suffixes that are sorted at a time (whole groups, so a little more).
SORTED_BYTES = 8 << 20

_ANCHORS = "ref long, gram long, at int, lead long"
_SUFFIXES = "bucket int, gram long, doc_id long, ref long, first int, windows binary"


def _grouped(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int]]:
    """Slices of rows whose texts make up about a chunk."""
    sizes = np.array([0 if x is None else x for x in pc.binary_length(batch.column(column)).to_pylist()])
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > CHUNK:
            yield start, i
            start, held = i, 0
        held += n
    if len(sizes):
        yield start, len(sizes)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for a, b in _grouped(batch, column):
        part = batch.slice(a, b - a)
        data, offsets = bytes_of(part.column(column))
        yield part, data, offsets


def _lead(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The first 8 bytes as a number that sorts as they do."""
    value = np.zeros(len(places), np.uint64)
    for i in range(8):
        value = value << np.uint64(8) | data[places + i].astype(np.uint64)
    return (value ^ np.uint64(1 << 63)).view(np.int64)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in _texts(batch, 1):
            gram, at, _, _ = runs_of(data, offsets[1:])
            # a gram can be the anchor of two runs
            new = np.append(True, at[1:] != at[:-1]) if len(at) else np.empty(0, bool)
            gram, at = gram[new], at[new]
            text = np.searchsorted(offsets, at, "right") - 1
            lead = _lead(data, at)
            chosen = mixed(gram, 21) % np.uint64(SPLIT_ONE_IN) == 0
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(text)),
                    pa.array(gram.view(np.int64)),
                    pa.array((at - offsets[text]).astype(np.int32)),
                    pa.array(lead, mask=~chosen),
                ],
                ["ref", "gram", "at", "lead"],
            )


def _suffixes(splitters: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in _texts(batch, 1):
                gram, at, first, last = runs_of(data, offsets[1:])
                text = np.searchsorted(offsets, at, "right") - 1
                live = part.column(3).combine_chunks() if isinstance(part.column(3), pa.ChunkedArray) else part.column(3)
                begin = np.asarray(live.offsets)
                places, hot = (np.asarray(live.values.field(k)) for k in ("at", "hot"))
                owner = np.searchsorted(begin, np.arange(begin[0], begin[-1]), "right") - 1
                places, hot = places[begin[0] : begin[-1]] + offsets[owner], hot[begin[0] : begin[-1]]
                order = np.argsort(places)
                places, hot = places[order], hot[order]
                where = np.minimum(np.searchsorted(places, at), max(len(places) - 1, 0))
                keep = places[where] == at if len(places) else np.zeros(len(at), bool)
                gram, at, first, last, text = (x[keep] for x in (gram, at, first, last, text))
                hot = hot[where[keep]]
                bucket = np.searchsorted(splitters, _lead(data, at), "right")
                for is_hot in (False, True):
                    sel = np.flatnonzero(hot == is_hot)
                    if not len(sel):
                        continue
                    if is_hot:  # a row for each window: its key, no bytes
                        starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(first[sel], last[sel])])
                        of = np.repeat(sel, last[sel] - first[sel] + 1)
                        keys = np.array([], np.uint64) if not len(starts) else _window_keys(data, starts) ^ mixed(gram[of], 5)
                        windows = pa.nulls(len(starts), pa.binary())
                    else:
                        starts, of, keys = first[sel], sel, gram[sel]
                        windows = pa.array([data[a : b + LENGTH].tobytes() for a, b in zip(first[sel], last[sel])], pa.binary())
                    rows = pa.array(text[of])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(bucket[of].astype(np.int32)),
                            pa.array(keys.view(np.int64)),
                            part.column(2).take(rows),
                            part.column(0).take(rows),
                            pa.array((starts - offsets[text[of]]).astype(np.int32)),
                            windows,
                        ],
                        ["bucket", "gram", "doc_id", "ref", "first", "windows"],
                    )

    return run


def _window_keys(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of the windows at ascending starts, in pieces."""
    out, i = [], 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + CHUNK)))
        base = starts[i]
        out.append(string_hashes(data[base : starts[j - 1] + LENGTH], LENGTH)[starts[i:j] - base])
        i = j
    return np.concatenate(out)


def _repeated(rows: list[tuple]) -> tuple[list, list, list, list]:
    """Spans that repeated windows cover, of whole groups of suffixes."""
    lengths = np.array([len(r[4]) for r in rows])
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
    starts = np.concatenate([np.arange(e - n, e - LENGTH + 1) for e, n in zip(ends, lengths)])
    of = np.repeat(np.arange(len(rows)), lengths - LENGTH + 1)
    gram = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    keys = _window_keys(data, starts) ^ mixed(gram, 5)[of]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    starts, of = starts[twice], of[twice]
    # neighbouring starts of a suffix make one span
    new = np.append(True, (starts[1:] != starts[:-1] + 1) | (of[1:] != of[:-1])) if len(starts) else np.empty(0, bool)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(starts)) - 1 if len(head) else head
    shift = np.array([r[3] for r in rows]) - (ends - lengths)
    a, b, own = starts[head], starts[tail], of[head]
    return [rows[i][1] for i in own], [rows[i][2] for i in own], (a + shift[own]).tolist(), (b + shift[own] + LENGTH).tolist()


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted suffixes -> spans; only whole groups are compared."""
    held, size = [], 0

    def out(rows):
        doc_id, ref, start, end = _repeated(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_id, pa.int64()), pa.array(ref, pa.int64()), pa.array(start, pa.int32()), pa.array(end, pa.int32())],
            ["doc_id", "ref", "start", "end"],
        )

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if size > SORTED_BYTES and row[0] != held[-1][0]:
                yield out(held)
                held, size = [], 0
            held.append(row)
            size += len(row[4])
    if held:
        yield out(held)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
            data, merged = text.encode("utf-8", "surrogatepass"), []
            for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(end, merged[-1][1])
                else:
                    merged.append([start, end])
            kept, at = hashlib.sha256(), 0
            for start, end in merged:
                kept.update(data[at:start])
                at = end
            kept.update(data[at:])
            rows.append((doc_id, len(data), sum(b - a for a, b in merged), len(merged), kept.hexdigest(), [x for m in merged for x in m]))
        columns = list(zip(*rows)) or [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"]
        )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, ref, start, end``: spans in bytes, not merged. ``ref`` tells
    texts of the same doc_id apart."""
    ship_package(docs.sparkSession)
    texts = _referred(docs)
    anchors = materialise(texts.select("ref", "text").mapInArrow(_anchors, _ANCHORS), "suffix-anchors")
    counts = anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    live = anchors.join(counts, "gram").select("ref", F.struct("at", (F.col("n") > HOT).alias("hot")).alias("anchor"), "lead")
    live = materialise(live, "suffix-live")
    buckets = max(1, live.count() // BUCKET)
    shares = [i / buckets for i in range(1, buckets)]
    splitters = live.agg(F.percentile_approx("lead", shares or [0.5], 20 * buckets)).first()[0]
    splitters = np.unique(np.array(splitters if shares and splitters else [], np.int64))
    per_text = live.groupBy("ref").agg(F.collect_set("anchor").alias("live"))
    suffixes = texts.join(per_text, "ref").select("ref", "text", "doc_id", "live").mapInArrow(_suffixes(splitters), _SUFFIXES)
    suffixes = materialise(suffixes, "suffixes")
    few = suffixes.where("windows is not null").repartition("bucket").sortWithinPartitions("bucket", "gram")
    spans = few.select("gram", "doc_id", "ref", "first", "windows").mapInArrow(_compare, "doc_id long, ref long, start int, end int")
    hot = suffixes.where("windows is null").select("gram", "doc_id", "ref", "first")
    twice = hot.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    more = hot.join(twice, "gram", "left_semi").select("doc_id", "ref", F.col("first").alias("start"), (F.col("first") + LENGTH).alias("end"))
    return spans.unionByName(more)


def _referred(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", whole_text().alias("text")).withColumn("ref", F.xxhash64("doc_id", "text"))


def query(docs: DataFrame) -> DataFrame:
    spans = materialise(repeated_spans(docs), "suffix-spans")
    per_text = spans.groupBy("doc_id", "ref").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    per_text = per_text.withColumnsRenamed({"doc_id": "_id", "ref": "_ref"})
    texts = _referred(docs)
    joined = texts.join(per_text, (texts["ref"] == per_text["_ref"]) & texts["doc_id"].eqNullSafe(per_text["_id"]), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<long>"
    )
