"""Odd tables: clashing column names, shared ids, empty tables, rule versions."""

import random
from collections import Counter

import pytest
from llm_rows import ODD
from pyspark.sql import functions as F

import corpus_pipeline
from parcel.llm import chat, decontamination, line_dedup, mixing, near_dedup, quality, secret_scan

CLASHING = ("_id _of _text _tkey _quality _n_dropped _bitmap _w _r _size _source doc of found quality bitmap n_dropped size key slice "
            "taken target hits tkey item window start kept root comp node n a b").split()
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def clashing(make_docs):
    return lambda rows: make_docs(rows).drop(*CLASHING).withColumns({c: F.lit(f"of the user: {c}") for c in CLASHING})


STAGES = {
    "quality": lambda spark, docs: quality.kept_documents(docs, spark.createDataFrame([], LABELS)),
    "lines": lambda spark, docs: line_dedup.deduped(docs),
    "near_duplicates": lambda spark, docs: near_dedup.kept_documents(docs),
    "benchmark": lambda spark, docs: decontamination.clean(docs, spark.createDataFrame([(1, "two three")], "item_id long, text string")),
    "mix": lambda spark, docs: mixing.repetitions(docs),
}


def test_all_stages_are_tried():
    assert list(STAGES) == [name for name, _ in corpus_pipeline.STAGES]


@pytest.mark.parametrize("stage", STAGES)
def test_stage_on_odd_rows(spark, clashing, stage):
    """Nulls in every column, repeated rows and ids; columns of the user named
    like inner ones come out as they went in."""
    docs = clashing(ODD)
    out = STAGES[stage](spark, docs)
    own = [c for c in docs.columns if c != "words"]
    assert [c for c in out.columns if c not in ("repetition", "words")] == own
    rows = out.collect()
    assert rows and all(r[c] == f"of the user: {c}" for r in rows for c in CLASHING)
    texts = Counter((r.doc_id, r.text) for r in rows)
    if stage == "quality":  # without labels nothing is known to be bad
        assert texts == Counter((r[0], r[1]) for r in ODD)
    if stage == "benchmark":
        assert texts == Counter((r[0], r[1]) for r in ODD if "two" not in (r[1] or "").lower())
    if stage == "near_duplicates":  # the copies under 5 and 8 go, rows that share 7 stay together
        assert Counter(i for i, _ in texts.elements()) == Counter(r[0] for r in ODD if r[0] not in (5, 8))


@pytest.mark.parametrize("stage", STAGES)
def test_stage_on_an_empty_table(spark, clashing, stage):
    out = STAGES[stage](spark, clashing([]))
    assert out.count() == 0 and set(clashing([]).columns) - {"words"} <= set(out.columns)


def test_rows_that_share_an_id_are_mixed_each(make_docs):
    rows = [(7, "a b c", "en", "a"), (7, "d e f g h", "en", "a"), (7, "d e f g h", "en", "a"), (None, "i j", "en", None), (8, None, "en", "a")]
    docs = make_docs(rows)
    taken = sum(r.taken for r in mixing.mix(docs).collect())
    out = mixing.repetitions(docs).collect()
    assert sum(r["words"] for r in out) == sum(len(r.text.split()) for r in out) == taken
    most = Counter((i, t) for i, t, *_ in rows)
    assert all(n <= 2 * most[k] * len((k[1] or "").split()) for k, n in _words(out, rows).items())


def _words(out, rows):
    """Words of each input row's text among the repetitions."""
    held = Counter()
    for r in out:
        text = next(t for i, t, *_ in rows if i == r.doc_id and (t or "").startswith(r.text))
        held[(r.doc_id, text)] += r["words"]
    return held


def test_empty_tables_of_scans_and_chats(spark, make_docs):
    assert secret_scan.query(make_docs([])).collect() == []
    empty = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert [r.conv_id for r in chat.query(spark, empty).collect()] == [-7]
    turns, rejected = chat.turns_of_json(spark.createDataFrame([], "record string"))
    assert turns.collect() == rejected.collect() == []


def test_findings_are_of_one_rule_version(spark):
    paths = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "path long, blob string")
    found = spark.createDataFrame([("x", v, 1, 0, 0, "b", s) for v, s in (("old", "s1"), (secret_scan.RULE_VERSION, "s2"))], secret_scan.FINDINGS)
    got = {r.path: r.spans for r in secret_scan.findings_by_path(paths, found).collect()}
    assert got == {1: "s2", 2: "s2", 3: ""}


def test_a_stored_ledger_scans_what_is_new(spark, make_docs, tmp_path, monkeypatch):
    rows = [(1, "password=abcdefgh", "en", "a"), (2, "clean", "en", "a"), (3, None, "en", "a")]
    versions = lambda rows: make_docs(rows).select(F.col("doc_id").alias("path"), "text")
    store = f"file:{tmp_path}/store"
    first = secret_scan.scan_and_remember(versions(rows[:2]), store).collect()
    assert {r.path: r.base for r in first} == {1: "assign:0:17", 2: ""}
    again = secret_scan.scan_and_remember(versions([*rows, (4, "token = 12345678", "en", "a"), (5, rows[0][1], "en", "a")]), store).collect()
    assert {r.path: r.base for r in again} == {1: "assign:0:17", 2: "", 3: "", 4: "assign:0:16", 5: "assign:0:17"}
    ledger = spark.read.parquet(f"{store}/ledger")
    assert ledger.count() == ledger.distinct().count() == 4


def test_a_word_that_only_pseudo_labelled_documents_hold(spark, make_docs):
    """The labelled documents never hold `zorch`; all unlabelled documents
    of the bad source do, among clean words, and the page view hands them over."""
    rnd = random.Random(2)
    words = lambda n: " ".join(rnd.choice("one two three four five six seven eight".split()) for _ in range(n))
    rows, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        text = words(30) if i < 300 or not bad else words(29) + " zorch"
        rows.append((i, text, "en", "spam" if bad else "good"))
        if i < 300:
            labels.append((i, int(not bad), 0))
    docs = make_docs(rows)
    model = quality.train(docs, spark.createDataFrame(labels, LABELS))
    trained, _ = model.parts["good"]
    held = [(1000, words(29) + " zorch", "xx", "unknown"), (1001, words(30), "xx", "unknown")]
    texts, pages = trained
    assert len(texts.names) > 0  # `zorch` and no labelled word
    got = {r.doc.doc_id: r.quality.good for r in quality.scored(make_docs(held), model).collect()}
    assert got[1000] < got[1001]


def test_classifier_on_labels_it_has_not_seen(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    seen = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) != 0)
    unseen = {r.doc_id: r.quality == 1 and r.toxic == 0 for r in labels.join(seen, "doc_id", "left_anti").collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = quality.scored(docs.select("doc_id", "text", "lang", "source"), quality.train(docs, seen)).select("doc.doc_id", "quality.kept").collect()
    kept = {r.doc_id: r.kept for r in got if r.doc_id in unseen}
    clean = [kept[i] for i, good in unseen.items() if good]
    bad = [not kept[i] for i, good in unseen.items() if not good]
    print(f"unseen labels: {len(clean)} clean, {sum(clean) / len(clean):.4f} kept; {len(bad)} bad, {sum(bad) / len(bad):.4f} gone")
    assert sum(clean) / len(clean) > 0.97 and sum(bad) / len(bad) > 0.9
