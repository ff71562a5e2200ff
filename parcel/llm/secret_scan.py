"""Secret scans with an incremental blob ledger.

Every version of every path is content-addressed by the SHA-256 of its text (a
blob). The ledger lists which blobs were scanned under which version of the
rules. A scan takes each blob whose pair (blob, rule version) is not in the
ledger exactly once, however many paths or versions hold it, and its findings
are joined back to all of them. Only addresses are grouped; texts move once, by
path and address, so a blob with very many copies is no hot key.

Spans are ``kind:start:end`` in code points, end exclusive, by start and then
by the order of the rules.

Defined results: a null text is an empty blob without findings; rows that share
a path are versions of it and get the findings of their own text; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcel import files
from parcel.llm.common import materialise, whole_text
from parcel.session import ship_package

# The rules. Name, pattern, least length, the group it holds for,
# and lower-case strings of which a text with a match has at least one.
BASE_RULES = (
    (
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        8,
        2,
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
    ),
    ("access", r"AKIA[A-Z0-9]+", 16, 0, ("akia",)),
    ("hex", r"[0-9a-f]{32,}", 32, 0, ()),
)
MORE_RULES = (
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, 0, ("private key-----",)),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 1, 0, ("eyj",)),
    ("github", r"gh[oprsu]_[A-Za-z0-9]{36,}", 1, 0, ("gho_", "ghp_", "ghr_", "ghs_", "ghu_")),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 1, 0, ("xox",)),
    ("login_url", r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]+:[^\s:/@]+@", 1, 0, ("://",)),
)
RULES = BASE_RULES + MORE_RULES
#: Names this set of rules in the ledger: another set is another version.
RULE_VERSION = hashlib.sha256(repr(RULES).encode()).hexdigest()[:16]

LEDGER = "blob string, rules string"
FINDINGS = "blob string, rules string, n_assign long, n_access long, n_hex long, base string, spans string"


def spans_of(text: str, compiled: list[tuple]) -> list[tuple[int, int, int]]:
    """(start, number of the rule, end), sorted."""
    low = text.lower()
    found = []
    for number, (pattern, least, group, needs) in enumerate(compiled):
        if not needs or any(x in low for x in needs):
            found += [(m.start(), number, m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
    return sorted(found)


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    compiled = [(re.compile(pattern, re.ASCII), least, group, needs) for _, pattern, least, group, needs in RULES]
    base = len(BASE_RULES)
    name = [r[0] for r in RULES]
    for batch in batches:
        rows = []
        for blob, text in zip(batch["blob"], batch["text"]):
            found = spans_of(text, compiled)
            if found:
                said = [(number, f"{name[number]}:{start}:{end}") for start, number, end in found]
                counts = [sum(n == k for n, _ in said) for k in range(base)]
                rows.append((blob, RULE_VERSION, *counts, ",".join(s for n, s in said if n < base), ",".join(s for _, s in said)))
        yield pd.DataFrame(rows, columns=["blob", "rules", "n_assign", "n_access", "n_hex", "base", "spans"])


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None, rules: str = RULE_VERSION) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``path, text`` -> (``path, blob`` of every row, the ledger's new rows
    ``blob, rules``, the findings in the new blobs; a blob without findings
    has no row there)."""
    spark = versions.sparkSession
    ship_package(spark)
    texts = versions.select("path", whole_text().alias("text")).withColumn("blob", F.sha2("text", 256))
    paths = materialise(texts.select("path", "blob"), "blob-paths")
    first = paths.groupBy("blob").agg(F.min("path").alias("path"))
    if ledger is not None:
        first = first.join(ledger.where(F.col("rules") == rules).select("blob"), "blob", "left_anti")
    first = first.select(F.col("blob").alias("_blob"), F.col("path").alias("_path"))
    unseen = texts.join(first, texts["path"].eqNullSafe(first["_path"]) & (texts["blob"] == first["_blob"]), "left_semi")
    # a path and text that occur twice are still one blob
    found = materialise(unseen.select("blob", "text").mapInPandas(_scan, FINDINGS).dropDuplicates(["blob"]), "secret-findings")
    return paths, first.select(F.col("_blob").alias("blob"), F.lit(rules).alias("rules")), found


def findings_by_path(paths: DataFrame, findings: DataFrame, rules: str = RULE_VERSION) -> DataFrame:
    """All paths with the findings of their blobs under one version of the
    rules, old and new ones alike."""
    mine = findings.where(F.col("rules") == rules).drop("rules").dropDuplicates(["blob"])
    return paths.join(mine, "blob", "left").na.fill(0, ["n_assign", "n_access", "n_hex"]).na.fill("", ["base", "spans"])


def scan_and_remember(versions: DataFrame, store: str) -> DataFrame:
    """``findings_by_path`` of all rows, with a ledger and findings kept in the
    folder ``store``: what earlier calls have scanned under these rules isn't
    scanned again. Findings are written before the ledger, so a lost run's blobs
    are scanned once more, not missed."""
    spark = versions.sparkSession
    kept = [f"{store}/{name}" for name in ("ledger", "findings")]
    ledger, old = (stored_rows(spark, path, schema) for path, schema in zip(kept, (LEDGER, FINDINGS)))
    paths, new, found = scan_unseen(versions, ledger)
    new = materialise(new, "new-blobs")
    found.write.mode("append").parquet(kept[1])
    new.write.mode("append").parquet(kept[0])
    return findings_by_path(paths, found if old is None else old.unionByName(found))


def stored_rows(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The rows kept so far, fixed as they are now; ``None`` if there are none."""
    if not files.exists(path):
        return None
    return materialise(spark.read.schema(schema).parquet(path), "kept-rows")


def query(docs: DataFrame) -> DataFrame:
    paths, _, found = scan_unseen(docs.select(F.col("doc_id").alias("path"), "text"))
    return findings_by_path(paths, found).select(
        F.col("path").alias("doc_id"), "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans"
    )
