"""Shared test rows and the DuckDB side."""

import duckdb
import pyarrow as pa

#: Nulls in every column, empty and long texts, ties and repeated rows.
ODD = [
    (1, None, None, None),
    (2, "", "en", "b"),
    (3, " \t\n ", "en", "b"),
    (4, "one two three", "en", None),
    (5, "One  two\nthree", "de", "a"),
    (6, "long " * 30_000 + "end", "fr", "a"),
    (7, "same text here and there, again and again until the line is long", "en", "a"),
    (7, "same text here and there, again and again until the line is long", "en", "a"),
    (7, "another text under the same number", "en", "a"),
    (8, "same text here and there, again and again until the line is long", "en", "a"),
    (9, "\x00\x1f É ß   \U0001f600 İK", "en", "é"),
    (None, "a document without a number", "en", "c"),
    (None, None, None, None),
]


def sql_rows(docs, sql, items=()):
    con = duckdb.connect()
    cols = list(zip(*docs)) or [(), (), (), ()]
    documents = pa.table({"doc_id": pa.array(cols[0], pa.int64()), "text": pa.array(cols[1], pa.string()), "source": pa.array(cols[3], pa.string())})
    benchmark = pa.table({"item_id": pa.array([i for i, _ in items], pa.int64()), "text": pa.array([t for _, t in items], pa.string())})
    con.register("documents", documents)
    con.register("benchmark", benchmark)
    return con.execute(sql).to_arrow_table().to_pylist()
