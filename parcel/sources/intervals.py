"""Q8 for any query: all runs of a range in one scan.

The run dates become a relation with a row for each run, and the query a
``LATERAL`` subquery in which the interval markers are columns of that row.
Spark turns the markers' conditions into a join by range between the scan and
the few run rows, which are broadcast, and keeps groups, windows and limits of
the query apart for each run. So the tables are read once, however many runs
there are, and the query needn't name its date column.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession

from parcel.functions.params import PLACEHOLDERS, Interval

#: Run rows that may be broadcast; a longer range goes in several scans.
MOST_RUNS = 5_000

_NAMES = "|".join(PLACEHOLDERS)
_MARKERS = "|".join(Interval.of("2000-01-01").sql_args())
# strings, quoted names and comments are passed over as a whole
_TOKEN = re.compile(
    r"(?P<text>'(?:[^'\\]|\\.|'')*')|(?P<skip>\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/)"
    rf"|(?P<marker>(?<![:\w]):(?:{_MARKERS})\b)|(?P<bare>\{{(?:{_NAMES})\}})",
    re.S,
)


class NotCorrelated(ValueError):
    """The query can't be written with the run's columns."""


def correlated(query: str, run: str = "_run") -> str:
    """The query with ``:name`` markers as ``_run.p_name`` and ``'... {name}
    ...'`` texts as concatenations with ``_run.t_name``. A placeholder outside
    of a text (in a table's name, say) can't be a column."""

    def column(found: re.Match) -> str:
        token = found.group()
        if found["marker"]:
            return f"{run}.p_{token[1:]}"
        if found["bare"] or found["skip"] and re.search(rf"\{{(?:{_NAMES})\}}", token) and not token.startswith(("--", "/*")):
            raise NotCorrelated(f"{token} is no value of its own")
        if found["skip"]:
            return token
        parts = re.split(rf"\{{({_NAMES})\}}", token[1:-1])
        if len(parts) == 1:
            return token
        texts = [f"'{p}'" if i % 2 == 0 else f"{run}.t_{p}" for i, p in enumerate(parts)]
        texts = [t for t in texts if t != "''"]
        return texts[0] if len(texts) == 1 else f"concat({', '.join(texts)})"

    return _TOKEN.sub(column, query)


def _literal(name: str, value) -> str:
    if isinstance(value, str):
        return f"'{value}' AS {name}"
    kind = "TIMESTAMP" if hasattr(value, "hour") else "DATE"
    return f"{kind}'{value}' AS {name}"


def _run_rows(runs: list[Interval]) -> str:
    """A relation of literals: folder date, typed values and texts."""
    rows = []
    for run in runs:
        typed = [_literal(f"p_{k}", v) for k, v in run.sql_args().items()]
        texts = [_literal(f"t_{k}", v) for k, v in run.placeholder_values().items()]
        rows.append(f"STRUCT({', '.join([_literal('folder_date', run.folder_date), *typed, *texts])})")
    return f"SELECT inline(array({', '.join(rows)}))"


def run_over(spark: SparkSession, query: str, runs: list[Interval]) -> DataFrame:
    """The rows of ``query`` for each run, tagged with its ``folder_date``.
    Raises ``NotCorrelated`` where the query can't be correlated."""
    inner, out = correlated(query), None
    for at in range(0, len(runs), MOST_RUNS):
        rows = _run_rows(runs[at : at + MOST_RUNS])
        try:
            found = spark.sql(
                f"SELECT _rows.*, _run.folder_date AS _folder_date FROM ({rows}) _run, LATERAL (\n{inner}\n) _rows"
            )
        except (ParseException, AnalysisException) as exc:
            raise NotCorrelated(str(exc)) from exc
        out = found if out is None else out.unionByName(found)
    if out is None:
        raise ValueError("no runs")
    return out.drop("folder_date").withColumnRenamed("_folder_date", "folder_date")
