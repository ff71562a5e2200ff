"""Substring dedup and near duplicates against brute force."""

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import ODD, sql_rows

from parcel.llm import near_dedup, suffix_dedup, textgrams, winnow_bytes
from parcel.llm.common import materialise


def long_rows():
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(60), text(90), "é" * 150]
    rows = []
    for i in range(40):
        parts = [text(rnd.randint(0, 120))]
        if i % 3 == 0:
            parts += [shared[i % 2], text(20)]
        if i % 7 == 0:
            parts += [shared[2]]
        if i % 10 == 0:
            parts += [parts[0], "x" * 500]
        rows.append((100 + i, " ".join(parts), "en", "a"))
    rows += [(200, rows[0][1], "en", "a"), (201, shared[0][:199], "en", "a"), (202, shared[0][:200], "en", "a")]
    return rows


def cut_by_force(rows):
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    out = Counter()
    for r, t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i : i + 200] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out[(r[0], len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("hot", [20_000, 2])
def test_substrings(make_docs, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "BUCKET", 10)
    monkeypatch.setattr(suffix_dedup, "SPLIT_ONE_IN", 2)
    rows = [r for r in ODD if r[0] != 6] + [(6, "long " * 300 + "end", "fr", "a")] + long_rows()
    got = suffix_dedup.query(make_docs(rows)).collect()
    assert Counter((g.doc_id, g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) for g in got) == cut_by_force(rows)


def test_anchors_in_pieces(monkeypatch):
    data = np.frombuffer(random.Random(5).randbytes(5000), np.uint8)
    whole = winnow_bytes.runs_of(data, np.array([3000, 5000]))
    monkeypatch.setattr(winnow_bytes, "CHUNK", 700)
    pieces = winnow_bytes.runs_of(data, np.array([3000, 5000]))
    starts = lambda runs: {(int(at), s) for _, at, a, b in zip(*runs) for s in range(a, b + 1)}
    assert starts(whole) == starts(pieces) and len({s for _, s in starts(whole)}) == 2801 + 1801


def test_words_hash_as_texts_split():
    texts = ["Ab  cd\n", None, "", "ab", "x\x0bÉ y" + "z" * 70_000, " \t"]
    words, ends = textgrams.words_of(pa.array(texts))
    split = [(t or "").encode().lower().split() for t in texts]
    assert list(np.diff(ends)) == [len(s) for s in split]
    flat = [w for s in split for w in s]
    assert len(set(flat)) == len(set(words.tolist())) and words[0] == words[2]


def groups_by_force(rows):
    sets = []
    for r in rows:
        w = (r[1] or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) or rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] == sets[j] != set():
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min((x for x in (least.get(find(i)), r[0]) if x is not None), default=None)
    return Counter((r[0], len(sets[i]), least[find(i)] if sets[i] else r[0]) for i, r in enumerate(rows))


def copies(n, size, edits, seed):
    """Copies of one original, each with edits of its own: many are linked
    through the original only."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(size)]
    out = [" ".join(base)]
    for _ in range(n):
        w = list(base)
        for at in rnd.sample(range(size), edits):
            w[at] = f"e{rnd.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_near_duplicates(make_docs):
    texts = copies(40, 200, 5, 1) + copies(3, 60, 1, 2) + copies(60, 120, 3, 4)
    passage = " ".join(f"p{i}" for i in range(60))
    rnd = random.Random(9)
    texts += [passage + " " + " ".join(f"u{rnd.randrange(10**6)}" for _ in range(rnd.randint(30, 60))) for _ in range(60)]
    texts += [" ".join(f"t{i}" for i in range(n)) for n in (1, 2, 4, 5, 6, 7, 8, 9, 10, 11, 12)] * 2
    rows = [r for r in ODD if r[0] != 7] + [(100 + 7 * i % 1000, t, "en", "a") for i, t in enumerate(texts)]
    got = near_dedup.near_components(make_docs(rows)).collect()
    assert Counter((g.doc_id, g.n_shingles, g.component_id) for g in got) == groups_by_force(rows)


def test_near_duplicates_in_one_template(make_docs):
    """Holders of a passage of 340 shingles, not linked by it; every fourth pair
    shares three more shingles and is linked."""
    rnd = random.Random(12)
    own = lambda n: [f"u{rnd.randrange(10**9)}" for _ in range(n)]
    passage = [f"p{i}" for i in range(344)]
    texts = []
    for i in range(80):
        border = own(3)
        texts += [" ".join(passage + border + own(57)), " ".join(passage + (border if i % 4 == 0 else own(3)) + own(57))]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    got = near_dedup.near_components(make_docs(rows)).collect()
    want = groups_by_force(rows)
    assert len({c for _, _, c in want}) == 140
    assert Counter((g.doc_id, g.n_shingles, g.component_id) for g in got) == want


def test_near_duplicates_sql(make_docs):
    rows = [*ODD, *((100 + i, t, "en", "a") for i, t in enumerate(copies(20, 80, 2, 6) + copies(5, 30, 1, 7)))]
    got = Counter(tuple(r) for r in near_dedup.query(make_docs(rows)).collect())
    assert got == Counter(tuple(r.values()) for r in sql_rows(rows, near_dedup.SQL))


def test_kept_documents(make_docs):
    docs = make_docs([(5, "a b c d e f", "en", "a"), (2, "A b  c d e f", "en", "a"), (3, None, "en", "a"), (4, "", "en", "a")])
    kept = near_dedup.kept_documents(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {2, 3, 4}


def test_empty(make_docs):
    assert suffix_dedup.query(make_docs([])).count() == near_dedup.query(make_docs([])).count() == 0


def test_densified_bins_agree_for_equal_rows():
    values = np.array([[5, 0, 0, 9], [5, 0, 0, 9]], np.uint64)
    filled = values > 0
    out = near_dedup.densified(values, filled)
    assert (out[0] == out[1]).all() and set(out[0].tolist()) <= {5, 9}


def test_words_are_hashed_a_bounded_piece_at_a_time(monkeypatch):
    texts = pa.array(["Some words of a long text, " * 1000] * 150)  # 4 MB
    tracemalloc.start()
    words, ends = textgrams.words_of(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6
    monkeypatch.setattr(textgrams, "CHUNK", 8 << 20)
    whole, whole_ends = textgrams.words_of(texts)
    assert (words == whole).all() and (ends == whole_ends).all()


def test_texts_reach_python_a_bounded_batch_at_a_time(spark, make_docs, monkeypatch):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(key)
    counted = spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n long")
    assert max(r.n for r in materialise(counted, "test-sizes", 1024).collect()) <= 1024
    spark.conf.set(key, "100")
    try:
        assert max(r.n for r in materialise(counted, "test-sizes", 1024).collect()) <= 100  # a smaller one of the user stays
    finally:
        spark.conf.set(key, before)
    monkeypatch.setattr(near_dedup, "materialise", lambda df, label, batch=None: seen.append((label, batch)) or materialise(df, label, batch))
    near_dedup.query(make_docs([(i, f"some words of text number {i // 2} here", "en", "a") for i in range(8)])).collect()
    assert {x for x, batch in seen if batch} == {"near-signed", "near-sets", "near-prefixes"} and spark.conf.get(key) == before
