"""MinHash near-dedup: one-permutation hashing, bands and star-shaped candidates.

A document's set holds the hashes of its distinct 5-word shingles. Documents
are linked if their Jaccard similarity is at least 3/4, and components of
linked documents are the groups of near copies.

1. One pass over the texts gives each document its set's size and 128-bit
   digest and a one-permutation signature: the smallest hash in each of BINS
   equal ranges of the hash space. An empty bin takes the value of a bin drawn
   for it, again and again until one is filled (optimal densification, the same
   draws for all documents). Bands of ROWS bins give bucket keys.
2. Documents with equal sets are one node, so exact copies never meet in pairs.
3. In each bucket the node that meets most others over all its buckets is the
   centre, and the others are candidates to it only: a star, whose size is that
   of the bucket. In a group of copies of one original that is the original,
   though its copies may be too far from each other.
4. Candidates that share too few bands are dropped, all others are confirmed
   on the full sets, which are made from the texts of all nodes with company.
5. What a star can miss are links between two members that are not in one
   component after this. The nodes of buckets that still hold several components
   are joined exactly: similar sets share a shingle among the rarest of each
   (a prefix of a quarter of the set), and a shingle that a whole group holds is
   met only by nodes outside of the group.

Of two documents with similarity s at least one band agrees with probability
1 - (1 - s^3)^42: 1 - 1e-10 at 3/4. All pairs that share a band and aren't in one
component by their stars are found by step 5.

Defined results: null and empty texts, and texts without words, have an empty
set and are linked with nothing; fewer words than five make one shingle of all
of them; rows that share a doc_id share its component and their texts link
it like any other; a null doc_id ranks after all others; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel.llm.common import TEXT_ROWS, materialise, whole_text
from parcel.llm.components import components
from parcel.llm.textgrams import mixed, word_runs, words_of
from parcel.session import ship_package

SHINGLE = 5
#: Linked if PART * union <= WHOLE * intersection.
PART, WHOLE = 75, 100
BANDS, ROWS = 42, 3
BINS = BANDS * ROWS
#: Candidates share at least so many bands; 18 are expected at the threshold.
LEAST_SHARED = 3
#: Shingles are ranked by how often their slot is met: a slot for each shingle,
#: within these bounds. Only slots met far more often than the mean are gathered.
LEAST_SLOT_BITS, MOST_SLOT_BITS = 18, 22

SIGNED = "doc_id long, n long, node binary, bands array<long>"
_SIGNED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.binary()), ("bands", pa.list_(pa.int64()))])


def shingle_set(words: np.ndarray) -> np.ndarray:
    return np.unique(word_runs(words, SHINGLE))


def densified(values: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Rows of bins; every row has a filled one."""
    values, todo = values.copy(), ~filled
    rng = np.random.default_rng(7)
    while todo.any():
        draw = rng.integers(0, values.shape[1], values.shape[1])
        rows = np.flatnonzero(todo.any(axis=1))
        take = todo[rows] & filled[rows][:, draw]
        values[rows] = np.where(take, values[rows][:, draw], values[rows])
        todo[rows] &= ~take
    return values


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """Bucket keys (BANDS a row) of non-empty sorted sets."""
    values = np.zeros((len(sets), BINS), np.uint64)
    filled = np.zeros((len(sets), BINS), bool)
    for i, s in enumerate(sets):
        bins = ((s >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
        first = np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))  # sorted: the smallest comes first
        values[i, bins[first]] = s[first]
        filled[i, bins[first]] = True
    values = densified(values, filled).reshape(len(sets), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), values.shape[:2])
    for r in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + values[:, :, r])
    return key


def _digest(s: np.ndarray) -> bytes:
    sums = [np.uint64(len(s)) + mixed(s, salt).sum(dtype=np.uint64) for salt in (1, 2)]
    return mixed(np.array(sums, np.uint64)).tobytes()


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            words, ends = words_of(batch.column(1))
            sets = [shingle_set(words[a:b]) for a, b in zip(ends, ends[1:])]
            some = [i for i, s in enumerate(sets) if len(s)]
            keys = dict(zip(some, band_keys([sets[i] for i in some]).view(np.int64))) if some else {}
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([keys.get(i) for i in range(len(sets))], pa.list_(pa.int64())),
                ],
                schema=_SIGNED,
            )


def _sets_of_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, text`` -> ``node, shingles`` of the texts that have this set."""
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            words, ends = words_of(batch.column(1))
            sets = [(node, shingle_set(words[a:b])) for node, a, b in zip(batch.column(0).to_pylist(), ends, ends[1:])]
            sets = [(node, s) for node, s in sets if len(s) and _digest(s) == node]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in sets], pa.binary()), pa.array([s.view(np.int64) for _, s in sets], pa.list_(pa.int64()))],
                ["node", "shingles"],
            )


def _ordered(a: str, b: str) -> list:
    """Columns a, b, n_a, n_b of a pair of (node, n), the smaller node first."""
    low, high = F.least(F.struct(f"{a}.node", f"{a}.n"), F.struct(f"{b}.node", f"{b}.n")), F.greatest(
        F.struct(f"{a}.node", f"{a}.n"), F.struct(f"{b}.node", f"{b}.n")
    )
    return [low["node"].alias("a"), high["node"].alias("b"), low["n"].alias("n_a"), high["n"].alias("n_b")]


class Linker:
    """The nodes of a corpus, and the sets of those that may be linked. Each is
    one table: the texts are shuffled once, to make the sets."""

    def __init__(self, docs: DataFrame):
        ship_package(docs.sparkSession)
        self.texts = docs.select("doc_id", whole_text().alias("text"))
        self.signed = materialise(self.texts.mapInArrow(_sign, SIGNED), "near-signed", TEXT_ROWS)
        per_node = self.signed.where("n > 0").groupBy("node")
        found = per_node.agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bands").alias("bands"))
        self.nodes = materialise(found, "near-nodes")
        keyed = self.nodes.select("node", "n", F.explode("bands").alias("key"))
        crowded = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        #: ``key, size, node, n``: the buckets of several nodes.
        self.buckets = materialise(keyed.join(crowded, "key"), "near-buckets")
        chosen = self.nodes.join(self.buckets.select("node").distinct(), "node", "left_semi").select(F.col("doc_id").alias("_id"), "node")
        texts = self.texts.join(chosen, F.col("doc_id").eqNullSafe(F.col("_id"))).select("node", "text")
        made = texts.mapInArrow(_sets_of_nodes, "node binary, shingles array<long>")
        self.sets = materialise(made.dropDuplicates(["node"]), "near-sets", TEXT_ROWS)

    def sharing(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``a, b`` (a < b) that share so many bands that they are
        worth a look at their sets."""
        bands = self.nodes.select("node", "bands")
        shared = F.size(F.array_intersect("bands_a", "bands_b"))
        both = pairs.join(bands.toDF("a", "bands_a"), "a").join(bands.toDF("b", "bands_b"), "b")
        return both.where(shared >= LEAST_SHARED).select("a", "b")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``a, b`` whose full sets are similar."""
        both = pairs.join(self.sets.toDF("a", "set_a"), "a").join(self.sets.toDF("b", "set_b"), "b")
        common = F.size(F.array_intersect("set_a", "set_b"))
        alike = common * WHOLE >= (F.size("set_a") + F.size("set_b") - common) * PART
        return materialise(both.where(alike).select("a", "b"), "near-links")


def _fitting(pairs: DataFrame) -> DataFrame:
    """``a, b, n_a, n_b`` -> distinct ``a, b`` whose sizes allow a link."""
    return pairs.where(F.least("n_a", "n_b") * WHOLE >= F.greatest("n_a", "n_b") * PART).select("a", "b").distinct()


def _stars(buckets: DataFrame) -> DataFrame:
    """The pairs of each bucket's centre, the node that meets most others over
    all its buckets, with the bucket's other nodes."""
    meets = buckets.groupBy("node").agg(F.sum(F.col("size") - 1).alias("meets"))
    ranked = buckets.join(meets, "node").select("key", F.struct("meets", "node", "n").alias("r"))
    centre = ranked.groupBy("key").agg(F.max("r").alias("c"))
    return ranked.join(centre, "key").where(F.col("r.node") != F.col("c.node")).select(*_ordered("r", "c"))


def _in_mixed_buckets(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """``node, n, comp`` of the nodes that share a bucket with a node of
    another component."""
    labelled = buckets.join(labels, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
    held = labelled.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("key")
    return labelled.join(held, "key", "left_semi").select("node", "n", "comp").distinct()


def _prefixes(shared, bits: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                firsts = []
                for found in batch.column(3):
                    s = np.asarray(found.values, np.int64).view(np.uint64)
                    often = met[(s >> np.uint64(64 - bits)).astype(np.int64)]
                    length = len(s) + (-len(s) * PART) // WHOLE + 1
                    firsts.append(s[np.lexsort((s, often))[:length]].view(np.int64))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(firsts, pa.list_(pa.int64()))], ["node", "n", "comp", "first"])

    return cut


def _prefix_pairs(work: Linker, members: DataFrame) -> DataFrame:
    """All pairs of different components among the nodes of ``node, n, comp``
    that can be linked: they share a shingle of their prefixes. For each
    shingle the component that holds it most often isn't paired with itself, so
    a group of copies meets the few others that share it, not its own members."""
    spark = members.sparkSession
    members = materialise(members, "near-members")
    held = members.agg(F.sum("n")).first()[0] or 0
    bits = min(MOST_SLOT_BITS, max(LEAST_SLOT_BITS, int(held).bit_length()))
    # any order that is the same for all sets will do, so counts of slots serve
    slots = work.sets.select(F.explode("shingles").alias("s")).groupBy(F.shiftrightunsigned("s", 64 - bits).cast("int").alias("slot"))
    got = slots.agg(F.count(F.lit(1)).cast("int").alias("c")).where(F.col("c") > 2 + 4 * (held >> bits)).toArrow()
    met = np.zeros(1 << bits, np.int32)
    met[got["slot"].to_numpy()] = got["c"].to_numpy()
    sets = work.sets.join(members, "node").select("node", "n", "comp", "shingles")
    made = sets.mapInArrow(_prefixes(spark.sparkContext.broadcast(met), bits), "node binary, n long, comp binary, first array<long>")
    first = materialise(made, "near-prefixes", TEXT_ROWS).select("node", "n", "comp", F.posexplode("first").alias("at", "key"))
    of_comp = first.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    most = of_comp.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("m"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    rows = materialise(
        first.join(most.select("key", F.col("m.comp").alias("main")), "key").withColumn("other", F.col("comp") != F.col("main")).drop("main"),
        "near-prefix-rows",
    )
    side = lambda c: [F.struct("node", "n", "comp", "at", "other").alias(c), "key"]
    x, y = rows.where("other").select(*side("x")), rows.select(*side("y"))
    need = F.ceil((F.col("x.n") + F.col("y.n")) * PART / (PART + WHOLE))
    fits = (F.col("x.comp") != F.col("y.comp")) & (~F.col("y.other") | (F.col("x.node") < F.col("y.node")))
    near = (F.least("x.n", "y.n") * WHOLE >= F.greatest("x.n", "y.n") * PART) & (F.col("x.at") + need <= F.col("x.n")) & (F.col("y.at") + need <= F.col("y.n"))
    return x.join(y, "key").where(fits & near).select(*_ordered("x", "y"))


def near_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, node, component_id`` for every row."""
    work = Linker(docs)
    seen = materialise(work.sharing(_fitting(_stars(work.buckets))), "near-candidates")
    links = work.linked(seen)
    labels = components(links)
    left = _fitting(_prefix_pairs(work, _in_mixed_buckets(work.buckets, labels)))
    more = work.linked(materialise(left.join(seen, ["a", "b"], "left_anti"), "near-candidates"))
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    of_node = work.nodes.select("node", "doc_id").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    of_root = of_node.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    ids = of_node.join(of_root, "root").select("node", "component_id")
    return work.signed.select("doc_id", F.col("n").alias("n_shingles"), "node").join(ids, "node", "left").select(
        "doc_id", "n_shingles", "node", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def query(docs: DataFrame) -> DataFrame:
    return near_components(docs).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """One document of each group, the smallest doc_id, with all its columns.
    Rows that share a doc_id stay or go together."""
    kept = query(docs).where("kept").select(F.struct("doc_id").alias("kept")).distinct()
    held = docs.select(F.struct(*docs.columns).alias("doc"))
    return held.join(kept, F.col("doc.doc_id").eqNullSafe(F.col("kept.doc_id")), "left_semi").select("doc.*")


# An exact join of all shingles and every document that each one reaches.
SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, rid, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingles
  FROM words),
sized AS (SELECT rid, len(shingles) AS n, unnest(shingles) AS s FROM sets),
shared AS (
  SELECT x.rid AS a, y.rid AS b, any_value(x.n + y.n) AS n, count(*) AS k
  FROM sized x JOIN sized y ON x.s = y.s AND x.rid < y.rid AND 100 * least(x.n, y.n) >= 75 * greatest(x.n, y.n)
  GROUP BY x.rid, y.rid),
links AS (
  SELECT a, b FROM shared WHERE 100 * k >= 75 * (n - k)
  UNION ALL SELECT b, a FROM shared WHERE 100 * k >= 75 * (n - k)),
reach AS (
  SELECT rid AS a, rid AS b FROM sets
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT r.a AS rid, min(s.doc_id) AS component_id FROM reach r JOIN sets s ON s.rid = r.b GROUP BY r.a)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, l.component_id, s.doc_id IS NOT DISTINCT FROM l.component_id AS kept
FROM sets s JOIN least l ON s.rid = l.rid
"""
