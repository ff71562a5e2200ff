r"""Chat formatting by schema fingerprints.

Records come in several layouts: one turn per row, a list of messages, a
prompt with its completion, an instruction with input and output. A layout is
known by a hash over its nested field paths, and the hash selects a declarative
mapping (a Spark SQL expression) to the canonical turns ``turn, role, text``.

Every turn is formatted on a row of its own, so a conversation of any length
is formatted in parallel, and the formatted conversation is its parts in order:

    user       <s>[INST] text [/INST]
    assistant   text </s>
    others     <<role>> text <</>>

``[ ] < > \`` inside texts and roles are escaped by a backslash: no text can end
or begin a turn, and reading back restores each turn exactly. The loss mask
(``mask_start``, ``mask_length`` in the part) covers assistant texts.

Reading back hashes a conversation in its order, so its parts pass through one
task as a stream; nothing but the running digest and a turn is held.

Defined results: null texts and roles are empty; turns are in the order of
turn (null first), role, text; repeated rows are repeated turns; a null conv_id
is a conversation of its own; a layout without a mapping raises an error that
lists its paths; an empty table gives no rows. Extra columns change the layout,
so callers select the fields that they mean.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcel.llm.common import materialise
from parcel.session import ship_package


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{f.name}")]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    return [at]


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


_TURN = "struct(cast({0} as bigint) as turn, {1} as role, {2} as text)"
#: The layouts: their field paths, their fields, and their turns as an array.
LAYOUTS = (
    (".conv_id .turn .role .text", "conv_id bigint, turn bigint, role string, text string", f"array({_TURN.format('turn', 'role', 'text')})"),
    (
        ".conv_id .messages[].role .messages[].content",
        "conv_id bigint, messages array<struct<role: string, content: string>>",
        f"transform(messages, (m, i) -> {_TURN.format('i', 'm.role', 'm.content')})",
    ),
    (
        ".conv_id .prompt .completion",
        "conv_id bigint, prompt string, completion string",
        f"""array({_TURN.format(0, "'user'", 'prompt')}, {_TURN.format(1, "'assistant'", 'completion')})""",
    ),
    (
        ".conv_id .instruction .input .output",
        "conv_id bigint, instruction string, input string, output string",
        f"""array({_TURN.format(0, "'user'", "concat_ws('\\n\\n', instruction, nullif(input, ''))")}, {_TURN.format(1, "'assistant'", 'output')})""",
    ),
)
#: Fingerprint -> (fields, turns).
MAPPINGS = {fingerprint(paths.split()): (ddl, turns) for paths, ddl, turns in LAYOUTS}


def canonical_turns(records: DataFrame) -> DataFrame:
    """A table in any known layout -> ``conv_id, turn, role, text``."""
    paths = field_paths(records.schema)
    known = MAPPINGS.get(fingerprint(paths))
    if known is None:
        raise ValueError(f"no mapping for the layout {sorted(paths)}")
    turns = records.select("conv_id", F.inline(F.expr(known[1])))
    return turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def _json_paths(value, at: str = "") -> list[str]:
    if isinstance(value, dict):
        return [p for k, v in value.items() for p in _json_paths(v, f"{at}.{k}")]
    if isinstance(value, list):
        return [p for v in value for p in _json_paths(v, f"{at}[]")]
    return [at]


def _layout_of(record: str | None) -> str | None:
    try:
        value = json.loads(record) if record is not None else None
    except ValueError:
        return None
    return fingerprint(_json_paths(value)) if isinstance(value, dict) else None


@F.pandas_udf(T.StringType())
def _json_fingerprint(records: pd.Series) -> pd.Series:
    return records.map(_layout_of)


def turns_of_json(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A column ``record`` of JSON objects in mixed layouts -> (canonical turns,
    the rejected records with their ``layout``). Every record takes the mapping
    of its own fingerprint; null and broken ones (no layout) and those whose
    layout has no mapping, lists without an entry among them, are rejected."""
    ship_package(records.sparkSession)
    marked = materialise(records.select("record", _json_fingerprint("record").alias("layout")), "chat-records")
    parts = [
        canonical_turns(marked.where(F.col("layout") == mark).select(F.from_json("record", ddl).alias("r")).select("r.*"))
        for mark, (ddl, _) in MAPPINGS.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out, marked.where(F.col("layout").isNull() | ~F.col("layout").isin(*MAPPINGS))


def _escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[\]<>\\])", r"\\$1")


def format_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` -> ``conv_id, turn, role, part,
    mask_start, mask_length`` (the mask in code points of the part)."""
    body = _escaped(F.col("text"))
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    part = (
        F.when(user, F.concat(F.lit("<s>[INST] "), body, F.lit(" [/INST]")))
        .when(assistant, F.concat(F.lit(" "), body, F.lit(" </s>")))
        .otherwise(F.concat(F.lit("<<"), _escaped(F.col("role")), F.lit(">> "), body, F.lit(" <</>>")))
    )
    return turns.select(
        "conv_id",
        "turn",
        "role",
        part.alias("part"),
        F.when(assistant, F.lit(1)).otherwise(F.lit(0)).alias("mask_start"),
        F.when(assistant, F.char_length(body)).otherwise(F.lit(0)).alias("mask_length"),
    )


_BODY = r"((?:[^\[\]<>\\]++|\\.)*+)"
_NEXT_TURN = re.compile(rf"<s>\[INST\] {_BODY}\[/INST\]| {_BODY}</s>|<<{_BODY}>> {_BODY}<</>>", re.S)
_ESCAPE = re.compile(r"\\(.)", re.S)


def _plain(body: str) -> str:
    return _ESCAPE.sub(r"\1", body)


def parse(formatted: str) -> tuple[list[tuple[str, str]], str]:
    """Turns (role, text) at the start of a formatted text, and what is left."""
    turns, at = [], 0
    while found := _NEXT_TURN.match(formatted, at):
        user, assistant, role, other = found.groups()
        if user is not None:
            turns.append(("user", _plain(user[:-1])))
        elif assistant is not None:
            turns.append(("assistant", _plain(assistant[:-1])))
        else:
            turns.append((_plain(role), _plain(other[:-1])))
        at = found.end()
    return turns, formatted[at:]


class _Digest:
    """Of one conversation, fed with its parts in order."""

    def __init__(self, conv_id):
        self.conv_id, self.rest, self.counts = conv_id, "", [0, 0, 0]
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, part: str, start: int, length: int) -> None:
        masked = _plain(part[start : start + length])
        self.loss.update(masked.encode())
        turns, self.rest = parse(self.rest + part)
        for role, text in turns:
            self.turns.update(f"{role}\n{text}\n".encode())
        self.counts = [a + b for a, b in zip(self.counts, (len(turns), len(masked), len(part)))]

    def row(self) -> dict:
        if self.rest:
            raise ValueError(f"conversation {self.conv_id} can't be read back: {self.rest[:100]!r}")
        n, loss, formatted = self.counts
        return {
            "conv_id": self.conv_id, "n_turns": n, "turns_sha256": self.turns.hexdigest(),
            "loss_chars": loss, "loss_sha256": self.loss.hexdigest(), "formatted_chars": formatted,
        }


READ_BACK = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if now is None or now.conv_id != row["conv_id"]:
                if now is not None:
                    done.append(now.row())
                now = _Digest(row["conv_id"])
            now.feed(row["part"], row["mask_start"], row["mask_length"])
        yield pa.RecordBatch.from_pylist(done, schema=_ARROW)
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.row()], schema=_ARROW)


def read_back(parts: DataFrame) -> DataFrame:
    """What the formatted conversations say, one row for each."""
    ship_package(parts.sparkSession)
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "part")
    return ordered.select("conv_id", "part", "mask_start", "mask_length").mapInArrow(_read_back, READ_BACK)


def query(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, [("user", control), ("assistant", control)])], LAYOUTS[1][1])
    turns = canonical_turns(conversations.select("conv_id", "turn", "role", "text")).unionByName(canonical_turns(more))
    return read_back(materialise(format_turns(turns), "chat-formatted"))


SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
bodies AS (
  SELECT *, regexp_replace(text, '([\[\]<>\\])', '\\\1', 'g') AS body, regexp_replace(role, '([\[\]<>\\])', '\\\1', 'g') AS name FROM turns),
parts AS (
  SELECT *, CASE role WHEN 'user' THEN '<s>[INST] ' || body || ' [/INST]' WHEN 'assistant' THEN ' ' || body || ' </s>'
                 ELSE '<<' || name || '>> ' || body || ' <</>>' END AS part FROM bodies)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, part)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, part) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(part)) AS BIGINT) AS formatted_chars
FROM parts GROUP BY conv_id
"""
