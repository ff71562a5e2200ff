"""Quality classifier by co-training of two views.

The text view has the words that a document holds (with and without
punctuation); the metadata view has its language, source and measures of its
page: length, shares of capitals, digits, symbols, marks and newlines, word and
line lengths, how often words repeat. There are two questions, whether a document
is good and whether it is toxic, each with its label.

Training uses a bounded sample: at most ``SAMPLE`` labelled and ``SAMPLE``
unlabelled documents, those with the smallest hash of their doc_id. Words that
differ between the labels beyond chance, found by an aggregate, enter a logistic
regression, one for each view. In every round a view hands its most confident answers on
unlabelled documents to the other view as labels, the words are chosen anew over
labelled and pseudo-labelled documents, and both views are fitted again and
calibrated on labelled documents that neither was fitted on. At last the
calibrated views are combined by a logistic regression on those, too.

All documents are scored on their whole texts, where they are read; nothing is
shuffled for that. A document is kept if it is more likely good than not and
more likely not toxic than toxic.

Defined results: a null text is an empty one; null languages and sources are
values of their own; documents without words are scored by their metadata; of
several labels for a doc_id the worse counts, null labels don't; without both
answers among the labels every document gets the share of those there are
(0.5 for good and 0 for toxic if there are none); rows that share a doc_id are
scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel.llm.common import TEXT_ROWS, materialise, whole_text
from parcel.llm.textgrams import NOT_ALNUM, bytes_of, mixed, words_of
from parcel.session import ship_package

SAMPLE = 12_000
ROUNDS = 3
#: Pseudo-labels handed over by a view in a round, and how sure it must be.
HANDED, SURE = 400, 0.97
#: A feature enters if its shares under the two labels differ by so many standard errors.
LEAST_Z, MOST_FEATURES = 4.5, 2000
BINS = 12
#: Of the labelled sample, one in so many is for calibration.
HELD_ONE_IN = 4
TARGETS = ("good", "toxic")
#: Rows of a view's matrix scored at a time.
PIECE = 1024

_MEASURES = 12


def _shares(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    found = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
    return (found[offsets[1:]] - found[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)


def _table(ranges: list[tuple[int, int]]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a:b] = True
    return out


_UPPER, _DIGIT = _table([(65, 91)]), _table([(48, 58)])
_SYMBOL, _MARK = _table([(33, 48), (58, 65), (91, 97), (123, 127)]), _table([(33, 34), (63, 64)])
_NEWLINE, _SPACE, _OTHER = _table([(10, 11)]), _table([(32, 33)]), _table([(128, 256)])


def measures(texts: pa.Array, words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Numbers on the page of each text (rows)."""
    data, offsets = bytes_of(texts)
    size, count = np.diff(offsets), np.diff(ends)
    out = np.zeros((len(texts), _MEASURES))
    for j, table in enumerate((_UPPER, _DIGIT, _SYMBOL, _MARK, _NEWLINE, _SPACE, _OTHER)):
        out[:, j] = _shares(data, offsets, table)
    out[:, 7] = np.log1p(size)
    out[:, 8] = size / np.maximum(count, 1)
    for i, (a, b) in enumerate(zip(ends, ends[1:])):
        if b > a:
            _, n = np.unique(words[a:b], return_counts=True)
            out[i, 9], out[i, 10] = len(n) / (b - a), n.max() / (b - a)
            out[i, 11] = (words[a + 1 : b] == words[a : b - 1]).mean() if b - a > 1 else 0
    return out


def _text_keys(loose: np.ndarray, strict: np.ndarray) -> np.ndarray:
    """Distinct features of the text view."""
    return np.unique(np.concatenate([loose, mixed(strict, 5)]))


def _name_key(kind: int, value: str | None) -> int:
    data = b"" if value is None else b"=" + value.encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(data, digest_size=8, salt=bytes([kind])).digest(), "little")


def _views(batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Text keys, measures and keys of language and source of ``text, lang,
    source``."""
    texts = batch.column(0)
    loose, loose_ends = words_of(texts)
    strict, strict_ends = words_of(texts, NOT_ALNUM)
    keys = [_text_keys(loose[a:b], strict[c:d]) for a, b, c, d in zip(loose_ends, loose_ends[1:], strict_ends, strict_ends[1:])]
    names = [[_name_key(8, x), _name_key(9, y)] for x, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
    return keys, measures(texts, loose, loose_ends), np.array(names, np.uint64).reshape(-1, 2)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            keys, numbers, names = _views(batch.select([0, 1, 2]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k.view(np.int64) for k in keys], pa.list_(pa.int64())),
                    pa.array(list(numbers), pa.list_(pa.float64())),
                    pa.array(list(names.view(np.int64)), pa.list_(pa.int64())),
                    batch.column(3),
                    batch.column(4),
                    batch.column(5),
                ],
                ["keys", "numbers", "names", "good", "toxic", "place"],
            )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _fit(x: np.ndarray, y: np.ndarray, w: np.ndarray, decay: float = 1e-4, steps: int = 250) -> np.ndarray:
    """Logistic regression by Adam on all rows. The last column is all ones, and
    its weight the bias."""
    theta, m, v = (np.zeros(x.shape[1], np.float32) for _ in range(3))
    share = np.clip(np.average(y, weights=w), 1e-3, 1 - 1e-3)
    theta[-1] = np.log(share / (1 - share))
    w = (w / w.sum()).astype(np.float32)
    for t in range(1, steps + 1):
        g = x.T @ (w * (_sigmoid(x @ theta) - y).astype(np.float32))
        g[:-1] += decay * theta[:-1]
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        theta -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return theta


def _chosen(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Sorted keys whose presence differs between the labels beyond chance."""
    keys = np.concatenate(rows)
    label = np.repeat(y, [len(r) for r in rows])
    names, at = np.unique(keys, return_inverse=True)
    both = np.bincount(at, minlength=len(names)).astype(float)
    ones = np.bincount(at, label, minlength=len(names))
    n1, n0 = y.sum(), len(y) - y.sum()
    p, q = ones / n1, (both - ones) / n0
    mean = both / len(y)
    z = np.abs(p - q) / np.sqrt(np.maximum(mean * (1 - mean), 1e-12) * (1 / n1 + 1 / n0))
    z[both < 5] = 0
    best = np.argsort(-z, kind="stable")[:MOST_FEATURES]
    return np.sort(names[best[z[best] > LEAST_Z]])


def _with_ones(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1))]).astype(np.float32)


def _matrix(rows: list[np.ndarray], names: np.ndarray, ones: int = 0) -> np.ndarray:
    """Which row holds which name, and so many columns of ones."""
    out = np.zeros((len(rows), len(names) + ones), np.float32)
    out[:, len(names) :] = 1
    if len(names):
        for i, r in enumerate(rows):
            at = np.minimum(np.searchsorted(names, r), len(names) - 1)
            out[i, at[names[at] == r]] = 1
    return out


class View:
    """One classifier over sets of keys, with its calibration."""

    def __init__(self, rows: list[np.ndarray], y: np.ndarray, w: np.ndarray):
        self.names = _chosen(rows, y)
        self.theta = _fit(_matrix(rows, self.names, 1), y, w)
        self.scale = np.array([1.0, 0.0])

    def raw(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.empty(len(rows), np.float32)
        for at in range(0, len(rows), PIECE):
            out[at : at + PIECE] = _matrix(rows[at : at + PIECE], self.names) @ self.theta[:-1] + self.theta[-1]
        return out

    def calibrate(self, rows: list[np.ndarray], y: np.ndarray) -> None:
        self.scale = _fit(_with_ones(self.raw(rows)[:, None]), y, np.ones(len(y)), 0.0)

    def logit(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.clip(self.raw(rows) * self.scale[0] + self.scale[1], -12, 12)


class _Rounds:
    """Co-training of one question's two views on the sample's rows."""

    def __init__(self, label: np.ndarray, places: np.ndarray):
        known = np.flatnonzero(~np.isnan(label))
        self.label, self.held = label, known[places[known] % HELD_ONE_IN == 0]
        fit, self.pool = np.setdiff1d(known, self.held), np.flatnonzero(np.isnan(label))
        self.own = [{int(i): float(label[i]) for i in fit} for _ in range(2)]
        self.trained: list[View] = []
        #: The answer for all, where there is nothing to learn from.
        self.answer = None
        if min(len(np.unique(label[part])) if len(part) else 0 for part in (fit, self.held)) < 2:
            self.answer = (float(np.mean(label[known])) if len(known) else None,)

    def pseudo(self, view: int) -> dict[int, float]:
        """Labels that the other view has handed to this one, by row."""
        return {i: y for i, y in self.own[view].items() if np.isnan(self.label[i])}

    def fit(self, views: list[list[np.ndarray]]) -> None:
        self.trained = []
        for rows, marks in zip(views, self.own):
            at = np.array(sorted(marks))
            view = View([rows[i] for i in at], np.array([marks[i] for i in at]), np.where(np.isnan(self.label[at]), 0.5, 1.0))
            view.calibrate([rows[i] for i in self.held], self.label[self.held])
            self.trained.append(view)

    def exchange(self, views: list[list[np.ndarray]]) -> None:
        """Each view's surest answers become labels of the other view."""
        for k, view in enumerate(self.trained if len(self.pool) else ()):
            sure = _sigmoid(view.logit([views[k][i] for i in self.pool]))
            for value, score in ((1.0, sure), (0.0, 1 - sure)):
                best = np.argsort(-score, kind="stable")[:HANDED]
                self.own[1 - k].update({int(self.pool[i]): value for i in best if score[i] >= SURE})

    def combined(self, views: list[list[np.ndarray]]) -> tuple[list[View], np.ndarray]:
        logits = np.column_stack([v.logit([rows[i] for i in self.held]) for v, rows in zip(self.trained, views)])
        return self.trained, _fit(_with_ones(logits), self.label[self.held], np.ones(len(self.held)), 1e-3)


class Classifier:
    """Both questions over both views; small enough to go to every task.

    ``gather`` gives the text view's rows for the pseudo-labels of a round: words
    are chosen anew each time, over labelled and pseudo-labelled documents."""

    def __init__(self, gather: Callable[[dict[str, dict[int, float]]], list[np.ndarray]], numbers, names, labels: dict[str, np.ndarray], places: np.ndarray):
        self.edges = [np.unique(np.quantile(numbers[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(_MEASURES)] if len(numbers) else []
        pages = self.page_keys(numbers, names)
        self.parts, parts = {}, {}
        for target in TARGETS:
            part = _Rounds(labels[target], places)
            if part.answer is None:
                parts[target] = part
            else:
                self.parts[target] = part.answer[0]
        for turn in range(ROUNDS if parts else 0):
            views = [gather({t: part.pseudo(0) for t, part in parts.items()}), pages]
            for part in parts.values():
                part.fit(views)
                if turn + 1 < ROUNDS:
                    part.exchange(views)
        for target, part in parts.items():
            self.parts[target] = part.combined(views)

    def page_keys(self, numbers: np.ndarray, names: np.ndarray) -> list[np.ndarray]:
        """Language, source and the bin of every measure as keys."""
        bins = [np.searchsorted(edges, numbers[:, j], "right") for j, edges in enumerate(self.edges)]
        binned = [mixed(np.uint64(1000 * (j + 1)) + b.astype(np.uint64), 3) for j, b in enumerate(bins)]
        return list(np.unique(row) for row in np.column_stack([names, *binned])) if len(numbers) else []

    def scores(self, batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        keys, numbers, names = _views(batch)
        views = [keys, self.page_keys(numbers, names) if self.edges else []]
        out = {}
        for target, part in self.parts.items():
            if part is None or isinstance(part, float):
                out[target] = np.full(len(keys), part if part is not None else {"good": 0.5, "toxic": 0.0}[target])
            else:
                trained, theta = part
                out[target] = _sigmoid(sum(v.logit(rows) * t for v, rows, t in zip(trained, views, theta)) + theta[-1])
        return out


def _telling_keys(features: DataFrame, pseudo: dict[str, dict[int, float]]) -> list[int]:
    """Words that differ between the labels beyond chance, at most
    MOST_FEATURES for each question, so that only these leave the tasks. The
    labels are those of the sample, without the documents for calibration, and
    the pseudo-labels by place."""
    fit = features.withColumns({t: F.when(F.pmod("place", F.lit(HELD_ONE_IN)) != 0, F.col(t)) for t in TARGETS})
    handed = sorted({place for marks in pseudo.values() for place in marks})  # at most 2 x HANDED x ROUNDS a question
    if handed:
        rows = [(place, *(pseudo.get(t, {}).get(place) for t in TARGETS)) for place in handed]
        more = fit.sparkSession.createDataFrame(rows, "place long, " + ", ".join(f"more_{t} double" for t in TARGETS))
        fit = fit.join(F.broadcast(more), "place", "left").withColumns({t: F.coalesce(t, f"more_{t}") for t in TARGETS})
    names, out = {t: f"n_{t}" for t in TARGETS}, set()
    sums = [x for t in TARGETS for x in (F.count(t).alias(names[t]), F.coalesce(F.sum(t), F.lit(0.0)).alias(t))]
    totals = fit.agg(*sums).first()
    of_key = fit.where(" or ".join(f"{t} is not null" for t in TARGETS)).select(F.explode("keys").alias("key"), *TARGETS).groupBy("key").agg(*sums)
    for t in TARGETS:
        n, ones = totals[names[t]], totals[t]
        if not 0 < ones < n:
            continue
        mean = F.col(names[t]) / n
        apart = F.col(t) / ones - (F.col(names[t]) - F.col(t)) / (n - ones)
        z = F.abs(apart) / F.sqrt(F.greatest(mean * (1 - mean), F.lit(1e-12)) * (1 / ones + 1 / (n - ones)))
        best = of_key.where(F.col(names[t]) >= 5).select("key", z.alias("z")).where(F.col("z") > LEAST_Z)
        out.update(r["key"] for r in best.orderBy(F.desc("z"), "key").limit(MOST_FEATURES).collect())
    return sorted(out)


def _telling_rows(features: DataFrame, telling: np.ndarray) -> list[np.ndarray]:
    """Of every row's keys those in ``telling`` (sorted), in the order of ``_in_order``.
    The words go to the tasks with the function and come back as places in
    ``telling``: written into the plan, they would fill the driver's memory."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(2)
            flat = keys.flatten().to_numpy()
            ends = np.concatenate([[0], np.cumsum(keys.value_lengths().to_numpy())])
            at = np.searchsorted(telling, flat)
            found = telling[np.minimum(at, len(telling) - 1)] == flat if len(telling) else np.zeros(len(flat), bool)
            kept = np.concatenate([[0], np.cumsum(found)])[ends].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(kept), pa.array(at[found].astype(np.int32)))], ["place", "of", "at"]
            )

    got = _in_order(features.select("place", F.xxhash64("keys").alias("of"), "keys").mapInArrow(held, "place long, of long, at array<int>"))
    return [telling[row.values.to_numpy()].view(np.uint64) for row in got["at"]]


def _in_order(rows: DataFrame) -> pa.Table:
    """On the driver, by ``place`` and ``of``, a hash of the row's keys."""
    got = rows.toArrow()
    return got.take(np.lexsort([got["of"].to_numpy(), got["place"].to_numpy()]))


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    """From the bounded sample; texts become features where they are read."""
    ship_package(docs.sparkSession)
    told = labels.groupBy("doc_id").agg(F.min("quality").alias("good"), F.max("toxic").alias("toxic")).where("doc_id is not null")
    order = F.xxhash64(F.lit(7), "doc_id")
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    labelled = ids.join(told, "doc_id").orderBy(order, "doc_id").limit(SAMPLE)
    others = ids.join(told.select("doc_id"), "doc_id", "left_anti").orderBy(order, "doc_id").limit(SAMPLE)
    chosen = labelled.unionByName(others.withColumns({"good": F.lit(None).cast("int"), "toxic": F.lit(None).cast("int")}))
    picked = docs.select("doc_id", whole_text().alias("text"), "lang", "source").join(
        F.broadcast(materialise(chosen, "quality-sample")), "doc_id"
    )
    made = picked.select(
        "text", "lang", "source", F.col("good").cast("double").alias("good"), F.col("toxic").cast("double").alias("toxic"), order.alias("place")
    ).mapInArrow(_featurise, "keys array<long>, numbers array<double>, names array<long>, good double, toxic double, place long")
    features = materialise(made, "quality-features", TEXT_ROWS)
    got = _in_order(features.select("place", F.xxhash64("keys").alias("of"), "numbers", "names", *TARGETS))
    numbers = np.array(got["numbers"].to_pylist(), float).reshape(-1, _MEASURES)
    names = np.array(got["names"].to_pylist(), np.int64).reshape(-1, 2).view(np.uint64)
    known = {t: got[t].to_pandas().to_numpy(float, na_value=np.nan) for t in TARGETS}
    places = got["place"].to_numpy()

    def gather(pseudo: dict[str, dict[int, float]]) -> list[np.ndarray]:
        by_place = {t: {int(places[i]): y for i, y in marks.items()} for t, marks in pseudo.items()}
        return _telling_rows(features, np.array(_telling_keys(features, by_place), np.int64))

    return Classifier(gather, numbers, names, known, places)


def scored(docs: DataFrame, model: Classifier) -> DataFrame:
    """``doc`` (a struct of all columns of ``docs``) and ``quality``:
    struct<good, toxic, kept>."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("good double, toxic double, kept boolean")
    def judge(text: pa.Array, lang: pa.Array, source: pa.Array) -> pa.Array:
        whole = pa.RecordBatch.from_arrays([text, lang, source], ["text", "lang", "source"])
        found = [shared.value.scores(whole.slice(at, 512)) for at in range(0, len(text), 512)]
        good, toxic = (np.concatenate([np.empty(0), *(x[t] for x in found)]) for t in TARGETS)
        return pa.StructArray.from_arrays([pa.array(good), pa.array(toxic), pa.array((good >= 0.5) & (toxic < 0.5))], ["good", "toxic", "kept"])

    answer = judge(whole_text(), F.col("lang").cast("string"), F.col("source").cast("string"))
    return docs.select(F.struct(*docs.columns).alias("doc"), answer.alias("quality"))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs.select("doc_id", "text", "lang", "source"), train(docs, labels)).select(
        "doc.doc_id", F.col("quality.good").alias("good_score"), F.col("quality.toxic").alias("toxic_score"), F.col("quality.kept").alias("kept")
    )


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, all columns as they are."""
    return scored(docs, train(docs, labels)).where("quality.kept").select("doc.*")
