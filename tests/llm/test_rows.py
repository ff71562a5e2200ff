"""Url filter, whitening and fill-in-the-middle."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_rows import ODD, sql_rows

from parcel.llm import fill_in_middle, url_filter, whitening


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------- fill in the middle --

def middle_by_force(rows):
    out = Counter()
    for i, text, *_ in rows:
        text = text or ""
        units = re.findall("[ \t-\r]*[^ \t-\r]+|[ \t-\r]+", text)
        digest = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[8 * j : 8 * j + 8], 16) for j in range(4))
        a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
            form, made = "plain", text
        elif h4 % 100 < 80:
            form, made = "spm", f"<S>{s}<P>{p}<M>{m}"
        else:
            form, made = "psm", f"<P>{p}<S>{s}<M>{m}"
        chars = (None, None) if form == "plain" else (len(p), len(m))
        out[(i, len(units), form, *chars, sha(made), sha(text))] += 1
    return out


def middle_rows():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("aé<PSM>\U0001f600\x00") for _ in range(rnd.randint(1, 6)))
    space = lambda: rnd.choice([" ", "\n", " \t", "\x0b\r ", "\u00a0"])
    rows = [(i, "".join(word() + space() for _ in range(rnd.randint(0, 30))) + rnd.choice(["", "end", "  "]), "en", "a") for i in range(300)]
    return [*ODD, *rows, (400, " \n" * 50, "en", "a"), (-5, "a text with a negative number", "en", "a"), (7, "x" * 300_000 + " y", "en", "a")]


def test_fill_in_middle(make_docs):
    rows = middle_rows()
    got = fill_in_middle.query(make_docs(rows)).collect()
    assert Counter(tuple(g) for g in got) == middle_by_force(rows)
    assert {"plain", "psm", "spm"} == {g.form for g in got}
    assert fill_in_middle.query(make_docs([])).collect() == []


def test_fill_in_middle_sql(make_docs):
    rows = middle_rows()
    theirs = sql_rows(rows, fill_in_middle.SQL)
    ours = [r.asDict() for r in fill_in_middle.query(make_docs(rows)).collect()]
    key = lambda r: tuple(str(x) for x in r.values())
    assert sorted(ours, key=key) == sorted(theirs, key=key)


def test_rotations_of_long_texts():
    rnd = random.Random(1)
    for n in (0, 1, 5, 3 * fill_in_middle.COPIED + 7, 10 * fill_in_middle.COPIED):
        text = rnd.randbytes(n).replace(b"<", b"(")
        first, second = sorted((rnd.randint(0, n), rnd.randint(0, n)))
        for form in ("plain", "psm", "spm"):
            made = bytes(fill_in_middle.arranged(text, first, second, form))
            p, m, s = text[:first], text[first:second], text[second:]
            assert made == {"plain": text, "psm": b"<P>" + p + b"<S>" + s + b"<M>" + m, "spm": b"<S>" + s + b"<P>" + p + b"<M>" + m}[form]
            assert bytes(fill_in_middle.taken_apart(made, form)) == text


def test_output_is_the_training_text(make_docs):
    made = {r.doc_id: r for r in fill_in_middle.transformed(make_docs([(i, "a few words here", "en", "a") for i in range(40)])).collect()}
    assert all(sorted(r.output.replace("<P>", "").replace("<S>", "").replace("<M>", "")) == sorted("a few words here") for r in made.values())


# ------------------------------------------------------------------- url filter --

PAGES = "page_id long, url string, html string, host string, path string, label int, score string, rule string"
URLS = [
    "http://a.net/x", "https://M.Example.NET/en/1?q=/de/", "https://example.net/en", "http://example.net/en/", "http://notexample.net/en/5",
    "http://example.com/de/1", "http://sub.example.com/de/", "http://example.com/DE/1", "http://example.com.org/de/1", "http://w.org/fr/9#x",
    "http://org/fr/", "http://w.org/fr", "http://net", "http://net/", "http://x.net?a=/b", "ftp://a://b.net/c", "no scheme", "", None, "://", "http://",
    "http://é.net/ü/", "http://a.b\nc.net/\n", "http://u:p@h.net:80/", "http://" + "a" * 200_000 + ".com/" + "b" * 200_000,
]


def url_by_force(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest).group()
    path = re.match("[^?#]*", rest[len(host) :]).group()
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [
        (h + p, v)
        for h, p, v in (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return host, path, *max(fits, key=lambda f: len(f[0]), default=(None, None))


@pytest.fixture(scope="module")
def make_pages(spark):
    return lambda urls: spark.createDataFrame([(i, u, "<p>", "x", "y", 1, "z", "r") for i, u in enumerate(urls)], PAGES)


def test_url_rules(make_pages):
    urls = [*URLS, *URLS[:3]]
    got = {r.page_id: r for r in url_filter.query(make_pages(urls)).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        host, path, rule, ruling = url_by_force(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert got[i].verdict == ruling if ruling else got[i].verdict in ("allow", "block")
        assert 0 <= got[i].score <= 1


def test_url_tables_without_labels(make_pages):
    assert url_filter.query(make_pages([])).collect() == []
    verdicts = lambda urls: [r.verdict for r in url_filter.query(make_pages(urls)).orderBy("page_id").collect()]
    assert verdicts(["http://a.com/", None]) == ["allow", "allow"]
    assert verdicts(["http://a.net/", "http://a.com/", None]) == ["block", "block", "block"]


def test_url_classifier_on_unseen_urls(spark, make_pages):
    rnd = random.Random(8)
    bad, good = ["casino", "poker", "pills", "xxx"], ["school", "library", "garden", "museum"]
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(3, 8)))

    def url(label):
        names = [word(), rnd.choice(bad if label else good), word()]
        rnd.shuffle(names)
        return f"{names[0]}-{names[1]}.com", f"/{names[2]}/{rnd.randint(1, 999)}"

    rows = [(*url(i % 2), i % 2) for i in range(600)]
    model = url_filter.train(spark.createDataFrame([*rows[:300], ("n", "/", None)], "host string, path string, label int"))
    hosts, paths, labels = zip(*rows[300:])
    assert ((model.score(list(hosts), list(paths)) > 0.5) == np.array(labels)).mean() > 0.97
    judged = url_filter.judged(make_pages([f"http://{h}{p}" for h, p in zip(hosts, paths)]), model).collect()
    assert np.mean([(r.verdict == "block") == labels[r.page_id] for r in judged]) > 0.97


def test_n_grams_in_pieces(monkeypatch):
    hosts, paths = ["abc.org", "", "é" * 50], ["/x/y", "/" + "z" * 99, ""]
    whole = Counter(zip(*(x.tolist() for x in map(np.concatenate, zip(*url_filter.n_grams(hosts, paths))))))
    monkeypatch.setattr(url_filter, "CHUNK", 7)
    assert whole == Counter(zip(*(x.tolist() for x in map(np.concatenate, zip(*url_filter.n_grams(hosts, paths))))))
    assert sum(whole.values()) == sum(max(0, len(s) + 3 - n) for s in (*hosts, *paths) for n in (3, 4, 5))


# -------------------------------------------------------------------- whitening --

EMBEDDINGS = "vec_id long, embedding array<float>, label int, x string, ids int, c0 double, component string"


@pytest.fixture(scope="module")
def make_vectors(spark):
    return lambda rows: spark.createDataFrame([(i, v, None, "x", 1, 0.0, "c") for i, v in rows], EMBEDDINGS)


def whitened_by_force(rows):
    """n, explained, {id: (deviation, projections)}"""
    fine = [(i, [float(np.float32(c)) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    lengths = Counter(len(v) for _, v in fine)
    most = max(lengths, key=lambda d: (lengths[d], d))
    fine = [(i, v) for i, v in fine if len(v) == most]
    x = np.floor(64 * np.array([v for _, v in fine])).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:32], q[:, ::-1][:, :32]
    keep = e > 1e-12 * e[0]
    return n, e[keep] / np.trace(v), [i for i, _ in fine], [sum((n * int(c) - int(s)) ** 2 for c, s in zip(r, sums)) for r in x], (centred @ q[:, keep]) / np.sqrt(e[keep])


def compare(make_vectors, rows, near):
    got = whitening.query(make_vectors(rows)).collect()
    n, explained, ids, deviations, want = whitened_by_force(rows)
    assert len(got) == want.size and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-10
    assert Counter((r.vec_id, r.deviation) for r in got) == Counter({k: c * want.shape[1] for k, c in Counter(zip(ids, deviations)).items()})
    shares = {r.component: r.explained for r in got}
    assert np.allclose([shares[j + 1] for j in range(len(explained))], explained, rtol=1e-9)
    once = Counter(ids)
    of = {(r.vec_id, r.component): r.whitened for r in got if once[r.vec_id] == 1}
    at = [k for k, i in enumerate(ids) if once[i] == 1]
    for j in range(want.shape[1]):
        ours = np.array([of[(ids[k], j + 1)] for k in at])
        assert min(np.abs(ours - s * want[at, j]).max() for s in (1, -1)) < near


def test_whitening(make_vectors):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((700, 64)) * np.linspace(1, 0.4, 64)
    rows = [(i, list(map(float, v))) for i, v in enumerate(base)]
    rows += [(900, None), (901, [None] + [0.5] * 63), (902, [float("nan")] * 64), (903, [float("inf")] + [0.0] * 63), (904, [1.0] * 63), (905, [])]
    rows += [(None, [0.25] * 64), (7, [0.5] * 64)] + [(910, [0.75] * 64)] * 200
    compare(make_vectors, rows, 1e-8)


def test_whitening_of_a_flat_spectrum(make_vectors):
    rng = np.random.default_rng(6)
    compare(make_vectors, [(i, list(map(float, v))) for i, v in enumerate(rng.standard_normal((300, 90)))], 1e-8)


def test_whitening_without_rank(make_vectors):
    assert whitening.query(make_vectors([])).collect() == []
    assert whitening.query(make_vectors([(1, [0.5, 0.25])])).collect() == []
    assert whitening.query(make_vectors([(1, [0.5]), (2, [0.5]), (3, None)])).collect() == []
    rng = np.random.default_rng(3)
    flat = rng.standard_normal((50, 3)) @ rng.standard_normal((3, 60))
    rows = [(i, list(map(float, np.round(v * 4) / 64))) for i, v in enumerate(flat)]
    whitened = whitening.query(make_vectors([*rows, *((100 + i, v) for i, v in rows)])).collect()
    assert whitened and max(r.identity_error for r in whitened) < 1e-6
    plane = [(i, [float(a) / 64, float(b) / 64, float(a + b) / 64, 0.0]) for i, (a, b) in enumerate(rng.integers(-50, 50, (40, 2)))]
    compare(make_vectors, plane, 1e-8)


def test_spectrum_is_certified(spark, make_vectors):
    rng = np.random.default_rng(9)
    rows = [(i, list(map(float, v))) for i, v in enumerate(rng.standard_normal((500, 90)))]
    found = whitening.Spectrum(whitening.packed(make_vectors(rows)), components=8, extra=8, degree=6)
    assert found.residual < whitening.FLOOR and len(found.values) == 8 and found.passes < 200
