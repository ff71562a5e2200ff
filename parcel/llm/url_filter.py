"""URL filter: rules for hosts and paths, and logistic regression on hashed
character n-grams where no rule fits.

A rule names a host, the start of a path and a verdict. It fits its host and all
its subdomains if the url's path starts with the rule's; of several that fit the
longest wins. The rules are a configured list that becomes one expression, so
they need no join.

The classifier is trained from a small labelled table ``host, path, label`` (label
1: block). ``labelled_by_rules`` makes one from the urls that the rules decide: at
most ``LABELLED`` different ones of each verdict, those with the smallest hash.
Features are the character n-grams (``LENGTHS``) of host and path, with marks
at both ends and each field hashed by itself, into 2^``BITS`` weights; an n-gram
counts 1 / sqrt(number of n-grams), so long urls don't outweigh short ones.
The weights (512 kB) go to every task, and every url is judged where it is
read: nothing is shuffled but the sample, and page bodies aren't read.

Defined results: a null url, and one without ``://``, has an empty host and an
empty path and is judged by the method; of very long urls all characters count;
urls without a label of both kinds to learn from get the verdict of the labels
there are, ``allow`` if there are none; rows that share a page_id or an url are
judged each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcel.llm.common import ascii_lower
from parcel.llm.textgrams import mixed
from parcel.session import ship_package


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)
LENGTHS = (3, 4, 5)
BITS = 16
#: Labelled urls of each verdict that the classifier is fitted on.
LABELLED = 3000
STEPS, RATE, DECAY = 150, 0.5, 1e-5
#: Characters whose n-grams are hashed at a time.
CHUNK = 1 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(len("://")))).otherwise(F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _first_fitting(rules: tuple[Rule, ...], value) -> Column:
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the last one asked first is the longest
        on_host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        found = F.when(on_host & F.col("path").startswith(rule.path), F.lit(value(rule))).otherwise(found)
    return found


def ruled(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``page_id, host, path, rule, ruling``: the longest rule that fits and
    its verdict, null without one."""
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path")).withColumns(
        {"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))}
    )
    return parts.withColumns({"rule": _first_fitting(rules, lambda r: r.name), "ruling": _first_fitting(rules, lambda r: r.verdict)})


def _grams(strings: list[str], salt: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of every n-gram, in pieces."""
    marked = [f"\x02{s}\x03" for s in strings]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(s) for s in marked])
    for start in range(0, len(codes), CHUNK):
        at = np.arange(start, min(start + CHUNK, len(codes)))
        row = np.searchsorted(ends, at, "right")
        for length in LENGTHS:
            inside = at + length <= ends[row]
            first = at[inside]
            h = np.full(len(first), length, np.uint64)
            for j in range(length):
                h = h * _FACTOR + codes[first + j]
            yield row[inside], (mixed(h, salt) >> np.uint64(64 - BITS)).astype(np.int32)


def n_grams(hosts: list[str], paths: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    yield from _grams(hosts, 1)
    yield from _grams(paths, 2)


class Model:
    """Hashed weights; ``only`` is the answer where one label was all there was."""

    def __init__(self, weights: np.ndarray | None = None, bias: float = 0.0, only: float | None = None):
        self.weights, self.bias, self.only = weights, bias, only

    def score(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """Probability that the verdict is ``block``."""
        if self.only is not None:
            return np.full(len(hosts), self.only)
        total, count = np.zeros(len(hosts)), np.zeros(len(hosts))
        for row, bucket in n_grams(hosts, paths):
            total += np.bincount(row, self.weights[bucket], len(hosts))
            count += np.bincount(row, minlength=len(hosts))
        return _sigmoid(total / np.sqrt(np.maximum(count, 1)) + self.bias)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(hosts: list[str], paths: list[str], label: np.ndarray) -> Model:
    """Logistic regression on all labelled urls, by Adagrad."""
    if not len(label) or label.min() == label.max():
        return Model(only=float(label[0]) if len(label) else 0.0)
    rows, buckets = (np.concatenate(x) for x in zip(*n_grams(hosts, paths)))
    scale = 1 / np.sqrt(np.bincount(rows, minlength=len(label)))
    each = np.where(label > 0, 0.5 / (label > 0).sum(), 0.5 / (label <= 0).sum())
    weights, squares, bias, bias_squares = np.zeros(1 << BITS), np.full(1 << BITS, 1e-12), 0.0, 1e-12
    for _ in range(STEPS):
        p = _sigmoid(np.bincount(rows, weights[buckets], len(label)) * scale + bias)
        off = (p - label) * each
        slope = np.bincount(buckets, (off * scale)[rows], 1 << BITS) + DECAY * weights
        squares += slope * slope
        weights -= RATE * slope / np.sqrt(squares)
        bias_squares += off.sum() ** 2
        bias -= RATE * off.sum() / np.sqrt(bias_squares)
    return Model(weights.astype(np.float32), float(bias))


def labelled_by_rules(parts: DataFrame, most: int = LABELLED) -> DataFrame:
    """``ruled`` -> ``host, path, label`` of different urls that a rule decides,
    at most so many of each verdict. At least one n-gram rule tells them apart,
    so the sample serves as labels for what no rule knows."""
    told = parts.where("ruling is not null").groupBy("host", "path").agg(F.max((F.col("ruling") == "block").cast("int")).alias("label"))
    order = F.xxhash64(F.lit(11), "host", "path")
    of = [told.where(F.col("label") == value).orderBy(order, "host", "path").limit(most) for value in (0, 1)]
    return of[0].unionByName(of[1])


def train(labelled: DataFrame) -> Model:
    """From a small table ``host, path, label``; null labels are left out."""
    got = labelled.where("label is not null").select("host", "path", F.col("label").cast("double").alias("label"))
    rows = sorted(got.collect())  # bounded by the table, which is small by its definition
    return fit([r["host"] or "" for r in rows], [r["path"] or "" for r in rows], np.array([r["label"] for r in rows]))


def judged(pages: DataFrame, model: Model, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score``."""
    ship_package(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(host: pd.Series, path: pd.Series) -> pd.Series:
        out = [shared.value.score(list(host.iloc[at : at + 1024]), list(path.iloc[at : at + 1024])) for at in range(0, len(host), 1024)]
        return pd.Series(np.concatenate(out) if out else np.empty(0))

    scored = ruled(pages, rules).withColumn("score", score("host", "path"))
    by_method = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruling", by_method).alias("verdict"), "score")


def query(pages: DataFrame) -> DataFrame:
    urls = pages.select("page_id", "url")
    return judged(urls, train(labelled_by_rules(ruled(urls))))
