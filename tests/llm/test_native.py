"""Fingerprints, line dedup, mixing and decontamination."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from llm_rows import ODD, sql_rows
from pyspark.sql import functions as F

from parcel.llm import decontamination, fingerprints, line_dedup, mixing


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def odd_key(r):
    return (r[0] is not None, r[0] or 0, r[1] or "")


# ------------------------------------------------------------- fingerprints --

def test_fingerprint_neighbours_and_edits(make_docs):
    rows = sorted(ODD, key=odd_key)
    got = fingerprints.query(make_docs(ODD)).collect()
    assert len(got) == len(rows)
    want = Counter()
    for i, r in enumerate(rows):
        text, after = r[1] or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        want[(r[0], len(text), sha(text[: len(text) - half] + after[:half]))] += 1
    assert Counter((g.doc_id, g.n_chars, g.edited_sha256) for g in got) == want
    assert all(0 <= g.near_edited <= 1 and 0 <= g.near_next <= 1 for g in got)


def test_fingerprint_buckets_do_not_show(make_docs, monkeypatch):
    monkeypatch.setattr(fingerprints, "BUCKET", 3)
    docs = make_docs([(i * 7 % 50, f"text {i}. more {i}", "en", "a") for i in range(50)])
    got = {g.doc_id: g.edited_sha256 for g in fingerprints.query(docs).collect()}
    texts = {i * 7 % 50: f"text {i}. more {i}" for i in range(50)}
    for i in range(50):
        a, b = texts[i], texts[(i + 1) % 50]
        assert got[i] == sha(a[: len(a) - len(a) // 2] + b[: len(a) // 2])


def test_fingerprint_is_homomorphic_and_order_free(spark):
    df = spark.createDataFrame([("a b.\nc d.\ne f.", "e f.\na b.\nc d.", "g h.", "a b.\nc d.\ne f.\ng h.")], "x string, y string, z string, xz string")
    p = {c: fingerprints.fingerprint(F.col(c)) for c in df.columns}
    r = df.select(
        (p["x"] == p["y"]).alias("order"),
        (fingerprints.inserted(p["x"], p["z"]) == p["xz"]).alias("insert"),
        (fingerprints.deleted(p["xz"], p["z"]) == p["x"]).alias("delete"),
        (p["x"] == p["z"]).alias("other"),
        fingerprints.likeness(p["x"], p["y"]).alias("same"),
    ).first()
    assert (r.order, r.insert, r.delete, r.other, r.same) == (True, True, True, False, 1.0)


def test_fingerprint_of_very_long_repetitions(spark):
    lines = lambda n, word="row": f"{word} of a table\n" * n
    rows = [
        (lines(20_000), lines(10_000) + "".join(f"line {i}\n" for i in range(300))),
        (lines(9_000), lines(4_500)),
        ("a\n" * 16_384, "b\n" * 16_384),
    ]
    df = spark.createDataFrame([(t,) for row in rows for t in row], "x string")
    made = df.select(fingerprints.fingerprint(F.col("x")).alias("p")).collect()
    pairs = spark.createDataFrame([(a.p, b.p) for a, b in zip(made[::2], made[1::2])], "x struct<n: long, v: array<long>>, y struct<n: long, v: array<long>>")
    got = [r.near for r in pairs.select(fingerprints.likeness(F.col("x"), F.col("y")).alias("near")).collect()]
    assert [m.p.n for m in made] == [20_000, 10_300, 9_000, 4_500, 16_384, 16_384] and made[4].p.v != made[5].p.v
    assert abs(got[0] - 0.8) < 0.02 and abs(got[1] - 0.8) < 0.02 and got[2] < 0.3


def test_fingerprint_is_of_paragraphs(spark):
    rnd = random.Random(2)
    words = [rnd.choice(["the", f"word{chr(97 + rnd.randrange(26))}{chr(97 + rnd.randrange(26))}"]) for _ in range(2000)]
    plain, dense = " ".join(words), "".join(chr(0x4E00 + rnd.randrange(9000)) for _ in range(3000))
    pairs = [
        ("a b. c d.\ne f.", "e f. a b.\nc d."),  # no paragraph in common
        (plain, "x " + plain),
        (plain, plain.replace(" ", "  ", 1)),
        (dense, "\u4e00\u4e01" + dense),
        (plain, " ".join(reversed(words))),
        ("  a b\r\n\n c d", "c d\na b"),  # white space around paragraphs
        ("\t\n \n", ""),
    ]
    df = spark.createDataFrame(pairs, "x string, y string")
    made = df.select(*[fingerprints.fingerprint(F.col(c)).alias(c) for c in "xy"])
    got = [r.near for r in made.select(fingerprints.likeness(F.col("x"), F.col("y")).alias("near")).collect()]
    assert got[0] < 0.5 and min(got[1:4]) > 0.9 and got[4] < 0.2 and got[5:] == [1.0, 1.0]


def pieces_by_force(text):
    return Counter(x for x in (line.strip(" \t\n\x0b\x0c\r") for line in text.split("\n")) if x)


def test_likeness_against_exact_multisets(spark):
    rnd = random.Random(5)
    line = lambda: f"paragraph {rnd.randrange(60)} of them"
    pairs = [("\n".join(line() for _ in range(rnd.randrange(1, 80))), "\n".join(line() for _ in range(rnd.randrange(1, 80)))) for _ in range(30)]
    df = spark.createDataFrame([(i, *pair) for i, pair in enumerate(pairs)], "i int, x string, y string")
    made = df.select("i", *[fingerprints.fingerprint(F.col(c)).alias(c) for c in "xy"])
    got = [r.near for r in made.orderBy("i").select(fingerprints.likeness(F.col("x"), F.col("y")).alias("near")).collect()]
    for near, pair in zip(got, pairs):
        a, b = (pieces_by_force(t) for t in pair)
        dot = sum(n * b[k] for k, n in a.items())
        exact = 2 * dot / (sum(n * n for n in a.values()) + sum(n * n for n in b.values()))
        assert abs(near - exact) < 0.35


# --------------------------------------------------------------- line dedup --

def lines_by_force(rows):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    holders = defaultdict(set)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    gone = {k: max(h, key=lambda i: (i is not None, i or 0)) for k, h in holders.items() if len(k) >= 20 and len(h) >= 3}
    out = Counter()
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if gone.get(key(x), i) == i]
        out[(i, len(lines), len(lines) - len(kept), sha("\n".join(kept)))] += 1
    return out


REPEATED = [(i, f"own line number {i} of the text\n  A Line that Many documents HOLD\nown end {i}\na line that many documents hold", "en", "a") for i in range(9)]


@pytest.mark.parametrize("hot", [True, False])
def test_lines(make_docs, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT_LINES", 1 if hot else 10**9)
    rows = ODD + REPEATED + [(3, "a line that many documents hold", "en", "a")]
    got = line_dedup.query(make_docs(rows)).collect()
    assert Counter(tuple(g) for g in got) == lines_by_force(rows)


def test_documents_without_lines_go(make_docs):
    rows = REPEATED + [(0, "a line that many documents hold", "en", "a")]
    docs = line_dedup.deduped(make_docs(rows))
    assert docs.columns == make_docs(rows).columns
    kept = [(r.doc_id, r.text) for r in docs.collect()]
    assert len(kept) == 9 and all(t.count("documents") == (2 if i == 8 else 0) for i, t in kept)


# ------------------------------------------------------------------- mixing --

@pytest.mark.parametrize("rows", [ODD, [(i, "w " * (i % 7), "en", "abc"[i % 3]) for i in range(200)] + [(500, "x " * 5000, "en", "a")]])
def test_mix(make_docs, rows):
    got = mixing.query(make_docs(rows)).collect()
    want = sql_rows(rows, mixing.SQL)
    assert Counter((g.doc_id, g.size, g.source_size, round(g.target, 6), g.taken) for g in got) == Counter(
        (a["doc_id"], a["size"], a["source_size"], round(a["target"], 6), a["taken"]) for a in want
    )
    assert all(g.taken <= 2 * g.size for g in got)


def test_repetitions_hold_what_the_mix_takes(make_docs):
    docs = make_docs([(i, " ".join(f"w{j}" for j in range(i % 9)), "en", "abc"[i % 3]) for i in range(90)])
    out = mixing.repetitions(docs)
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect() if r.taken}
    words = Counter()
    for r in out.collect():
        assert len(r.text.split()) == r["words"]
        words[r.doc_id] += len(r.text.split())
    assert words == taken


def test_the_mix_shuffles_no_texts_to_a_short_list_of_sources(spark, make_docs):
    rng = random.Random(3)
    docs = make_docs([(i, " ".join(rng.randbytes(8).hex() for _ in range(60)), "en", "abc"[i % 3]) for i in range(600)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")  # less than the texts, more than the sources
    try:
        plan = mixing.repetitions(docs)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2


# ---------------------------------------------------------- decontamination --

ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short item"), (3, None), (3, ""), (None, "another benchmark item of exactly ten words is this one"), (1, "extra text for item one")]
WORDS = ITEMS[0][1].split()


def test_contamination(spark, make_docs):
    rows = ODD + [
        (20, "before, " + ", ".join(WORDS) + " after", "en", "a"),
        (21, " ".join(WORDS[:9]), "en", "a"),
        (22, " ".join(WORDS[1:11]).upper() + " " + " ".join(WORDS[:10]), "en", "a"),
        (23, "a Short-ITEM here", "en", "a"),
        (24, "another benchmark item of exactly ten words is this one", "en", "a"),
    ]
    bench = spark.createDataFrame([(i, t, "z") for i, t in ITEMS], "item_id long, text string, window string")
    got = decontamination.query(make_docs(rows), bench).collect()
    want = sql_rows(rows, decontamination.SQL, ITEMS)
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert Counter(tuple(g[n] for n in names) for g in got) == Counter(tuple(w[n] for n in names) for w in want)
    assert {g.doc_id for g in got if g.contaminated} == {20, 22, 23, 24}
    clean = decontamination.clean(make_docs(rows), bench)
    assert clean.count() == len(rows) - 4


def test_every_ten_word_span_is_found(spark, make_docs):
    words = [f"w{i * i % 97}x{i}" for i in range(60)]
    rows = [(i, "pad " * (i % 5) + " ".join(words[i : i + 10]) + " tail", "en", "a") for i in range(51)]
    bench = spark.createDataFrame([(0, " ".join(words))], "item_id long, text string")
    assert all(g.n_hit == 10 for g in decontamination.query(make_docs(rows), bench).collect())


# -------------------------------------------------------------- empty tables --

def test_empty_tables(spark, make_docs):
    docs, bench = make_docs([]), spark.createDataFrame([], "item_id long, text string")
    for df in (fingerprints.query(docs), line_dedup.query(docs), mixing.query(docs), decontamination.query(docs, bench)):
        assert df.count() == 0
    assert not any(r.contaminated for r in decontamination.query(make_docs(ODD), bench).collect())
