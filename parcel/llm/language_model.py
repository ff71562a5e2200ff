"""Scoring documents with a gated recurrent language model.

1. Counts: every training document's tokens (words, then one end) are counted
   in its task and summed by a shuffle; all of the corpus counts.
2. At most ``HEAD`` of the most frequent words (up to ``HEAD_BYTES`` long, so their
   table has a bound) are the model's ranking. They go to the tasks by broadcast; all
   other words are the tail, of any number, and are never broadcast.
3. Training: every training document is dealt to one of the rounds, and in it to one
   of many independent learners (more of them for a larger corpus) that start from the
   same weights (truncated backpropagation, see ``recurrent``). The mean of their
   weights, by words seen, is taken with a Spark aggregate after each round.
4. Scoring: whole documents, the state carried from window to window. The tail
   words of the documents are then joined with the counts, for what their
   class leaves open: (c + 0.5) / (N + 0.5 * (V + 1)) over the tail.

The base score is the smoothed unigram score over all words.

Defined results: a null or empty text is the end alone; a null doc_id is hashed
as an empty text; rows that share a doc_id are scored each; without training
documents every token has base probability 1 and the model is uniform over its
classes; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcel.llm.common import materialise, whole_text
from parcel.llm.recurrent import Model, Ranking, fresh
from parcel.session import ship_package

HEAD = 131_072
HEAD_BYTES = 64
#: No word holds white space, so this is none.
END = b"\n"
#: Bytes of texts that a task counts, learns from or scores at a time.
GROUP_BYTES = 24 << 20
#: Each training document is in one of so many rounds.
ROUNDS = 2
#: Words that one learner should see in a round.
LEARNER_WORDS = 1_250_000


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose texts (the first column) make up about GROUP_BYTES."""
    held, size = [], 0

    def joined():
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(0)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            upto = min(int(np.searchsorted(ends, before + GROUP_BYTES - size)) + 1, batch.num_rows)
            held.append(batch.slice(at, upto - at))
            size += int(ends[upto - 1]) - before
            at = upto
            if size >= GROUP_BYTES:
                yield joined()
                held, size = [], 0
    if held:
        yield joined()


def words_of_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words, A-Z lower-cased (the kernels know ASCII only), text after
    text, and where each text's words end."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words = split.flatten().cast(pa.binary())
    ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False), dtype=np.int64)
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    if not real.all():  # white space at the ends of a text leaves empty ones
        words, ends = words.filter(pa.array(real)), np.append(0, np.cumsum(real))[ends]
    return words, ends


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in _groups(batches):
        found = pc.value_counts(words_of_texts(group.column(0))[0])
        yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "c"])
        yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([group.num_rows], pa.int64())], ["word", "c"])


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, c`` over all texts."""
    parts = texts.select("text").mapInArrow(_count, "word binary, c long")
    return materialise(parts.groupBy("word").agg(F.sum("c").alias("c")), "lm-counts")


class Vocabulary:
    """The ranked head words and what is known of all words."""

    def __init__(self, counts: DataFrame):
        # words by steps of their count (a few hundred), the most frequent steps that fit
        short = counts.where(F.octet_length("word") <= HEAD_BYTES).withColumn("step", F.floor(F.log2("c") * 64))
        least, held = None, 0
        for step, n in sorted(short.groupBy("step").count().collect(), reverse=True):
            held += n
            if held > HEAD:
                break
            least = step
        head = short.where(F.col("step") >= F.lit(least)).select("word", "c").collect() if least is not None else []
        head = sorted(head, key=lambda r: (-r[1], bytes(r[0])))
        self.total, self.distinct = (x or 0 for x in counts.agg(F.sum("c"), F.count(F.lit(1))).first())
        self.words = pa.array([bytes(word) for word, _ in head], pa.binary())
        self.counts = np.array([c for _, c in head], np.int64)
        self.tail_total = self.total - int(self.counts.sum())
        self.tail_distinct = self.distinct - len(head)
        self.other = len(head)
        self.start = next((i for i, (word, _) in enumerate(head) if bytes(word) == END), self.other)

    def ranking(self) -> Ranking:
        return Ranking.of(self.counts, self.tail_total)

    def ranks(self, words: pa.Array, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of all tokens, an end after each text's words, and the places of the ends."""
        ranks = pc.index_in(words, value_set=self.words).fill_null(self.other).to_numpy(zero_copy_only=False)
        return np.insert(ranks, ends, self.start), ends + np.arange(len(ends))


def _learner(shared, flat):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        docs = []
        for group in _groups(batches):
            ranks, ends = words.ranks(*words_of_texts(group.column(0)))
            docs += np.split(ranks, ends[:-1] + 1)
        if docs:
            model = Model(words.ranking(), flat.value.copy())
            seen = model.train(docs, words.start)
            yield pa.RecordBatch.from_arrays([pa.array([float(seen)]), pa.array([model.flat], pa.list_(pa.float32()))], ["seen", "weights"])

    return learn


def train(texts: DataFrame, shared, words: Vocabulary, train_words: float) -> np.ndarray:
    """The weights after all rounds; ``texts`` has ``key`` for the dealing."""
    spark = texts.sparkSession
    flat = fresh(words.ranking())
    for turn in range(ROUNDS):
        mine = texts.where(F.pmod("key", F.lit(ROUNDS)) == turn)
        learners = max(1, round(train_words / ROUNDS / LEARNER_WORDS))
        dealt = mine.repartition(learners).sortWithinPartitions("key").select("text")  # evenly
        learned = dealt.mapInArrow(_learner(shared, spark.sparkContext.broadcast(flat)), "seen double, weights array<float>")
        mean = learned.select("seen", F.posexplode("weights").alias("i", "w")).groupBy("i").agg(
            (F.sum(F.col("w").cast("double") * F.col("seen")) / F.sum("seen")).alias("w")
        )
        rows = mean.toPandas()  # the weights, of a fixed number
        if len(rows):
            flat = np.zeros_like(flat)
            flat[rows["i"].to_numpy()] = rows["w"].to_numpy(np.float32)
    return flat


_SCORED = "row long, doc_id long, held_out boolean, n_tokens long, head_known long, head_base double, head_score double, tail array<binary>"


def _scorer(shared, flat):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        model = Model(vocabulary.ranking(), flat.value)
        log_count = np.append(np.log10(vocabulary.counts + 0.5), 0.0)
        for group in _groups(batches):
            words, ends = words_of_texts(group.column(0))
            ranks, places = vocabulary.ranks(words, ends)
            begins = np.append(0, places[:-1] + 1)
            # the words that are in no broadcast; the end can be one
            at = np.flatnonzero(ranks == vocabulary.other)
            owner = np.searchsorted(places, at)
            source = np.where(places[owner] == at, len(words), at - owner)
            tail = pa.concat_arrays([words, pa.array([END], pa.binary())]).take(pa.array(source))
            n_tokens, tails = places - begins + 1, np.bincount(owner, minlength=len(places))
            columns = [
                *group.columns[1:], pa.array(n_tokens), pa.array(n_tokens - tails),
                pa.array(np.add.reduceat(log_count[ranks], begins)), pa.array(model.score(np.split(ranks, begins[1:]), vocabulary.start)),
                pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(tails)), pa.int32()), tail),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "held_out", "n_tokens", "head_known", "head_base", "head_score", "tail"])

    return score


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score``, one row per row of ``docs``."""
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select("doc_id", whole_text().alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    training = texts.where("not held_out").select("text", F.xxhash64("doc_id", "text").alias("key"))
    counts = word_counts(training)
    words = Vocabulary(counts)
    shared = spark.sparkContext.broadcast(words)
    flat = spark.sparkContext.broadcast(train(training, shared, words, float(words.total)))

    # the row numbers are written before anything is matched by them
    rows = materialise(
        texts.withColumn("row", F.monotonically_increasing_id())
        .select("text", "row", F.col("doc_id").cast("long"), "held_out")
        .mapInArrow(_scorer(shared, flat), _SCORED),
        "lm-scored",
    )
    tail = rows.select("row", F.explode("tail").alias("word"))
    met = tail.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("tail_log"),
        F.count(F.lit(1)).alias("n_tail"),
        F.count("c").alias("tail_known"),
    )
    n, v = float(words.total), float(words.distinct)
    n_tail, v_tail = float(words.tail_total), float(words.tail_distinct)
    tail_log, tail_n = F.coalesce("tail_log", F.lit(0.0)), F.coalesce("n_tail", F.lit(0))
    return rows.drop("tail").join(met, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(int(words.total)).cast("long").alias("train_tokens"),
        (F.col("head_base") + tail_log - F.col("n_tokens") * F.log10(F.lit(n + 0.5 * (v + 1)))).alias("base_score"),
        (F.col("head_score") + tail_log - tail_n * F.log10(F.lit(n_tail + 0.5 * (v_tail + 1)))).alias("score"),
    )
