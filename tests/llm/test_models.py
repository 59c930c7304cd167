"""Language ID, quality classifier and URL filter."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import common, ftrl, langid, url_filter
from tests.llm.conftest import ODD

A = "the and of to in that with this from have which were been their would".split()
B = "der die und das nicht eine ist für auch werden über schön größer müssen".split()


def texts(words, n, seed):
    r = np.random.default_rng(seed)
    return [" ".join(r.choice(words, 30)) for _ in range(n)]


def test_language_id(docs):
    rows = [(k, t, "en") for k, t in enumerate(texts(A, 60, 1))] + [(100 + k, t, "de") for k, t in enumerate(texts(B, 60, 2))]
    model = langid.fit(docs([r for r in rows if r[0] % 3], extra=True), per_language=30)
    assert set(model.languages) == {"en", "de"} and np.allclose(np.linalg.norm(model.vectors, axis=1), 1, atol=1e-4)
    odd = [(900 + k, t, "fr") for k, t in enumerate([*ODD, "12 34 !"])]
    out = {r.doc_id: r for r in langid.predict_languages(docs(rows + odd, extra=True), model).collect()}
    assert all(out[k].lang_pred == lang for k, _, lang in rows)
    assert all(0 <= r.score <= 1 for r in out.values())
    for k, t, _ in odd:
        assert (out[k].lang_pred == "und") == (not any(c.isalpha() for c in t or ""))
    again = langid.fit(docs([r for r in rows if r[0] % 3]), per_language=30)
    assert np.array_equal(model.vectors, again.vectors)


def test_language_id_without_examples(docs):
    model = langid.fit(docs([(1, "x", None), (2, None, "en"), (3, "12", "en")]))
    assert [r.lang_pred for r in langid.predict_languages(docs(["abc", None]), model).collect()] == ["und", "und"]
    assert langid.predict_languages(docs([]), model).collect() == []
    assert langid.fit(docs([(None, "eins zwei", ""), (4, "one two", "en")])).languages == ["", "en"]


def test_language_sample_is_bounded(docs):
    """Repeated rows are learned from once, and whole rows are left out beyond the bounds."""
    rows = [(1, "alpha beta", "a")] * 300 + [(k, f"text number {k} of many", "b") for k in range(50, 90)]
    got = langid.sample(docs(rows), 20, 15, 10**6, 1)
    assert len(got) == 15 and sum(r["lang"] == "a" for r in got) == 1
    full = langid.sample(docs(rows), 20, 100, 10**6, 1)
    some = langid.sample(docs(rows), 20, 100, sum(r["n"] for r in full[:7]), 1)
    assert [r["idx"] for r in some] == [r["idx"] for r in full[:7]]


def test_nearest_centroid_by_brute_force(docs):
    """Grams, weights, cosine and rejection anew, from the centroids."""
    rows = [(k, t, "en") for k, t in enumerate(texts(A, 30, 1))] + [(100 + k, t, "de") for k, t in enumerate(texts(B, 30, 2))]
    model = langid.fit(docs(rows))
    for doc_id, text, score, lang, rejected in ((r.doc_id, t, r.score, r.lang_pred, r.rejected) for r in langid.predict_languages(docs(rows), model).collect() for k, t, _ in rows if k == r.doc_id):
        plain = "".join(c if c.isalpha() else " " for c in text.lower())
        plain = " " + " ".join(plain.split()) + " "
        grams = {}
        for size in (1, 2, 3):
            for k in range(len(plain) - size + 1):
                code = 0
                for c in plain[k : k + size]:
                    code = (code * 0x1F123BB5 + ord(c)) % 2**64
                at = int(langid.mix64(np.array([(code + (size << 60)) % 2**64], np.uint64))[0]) >> (64 - langid.BITS)
                grams[at] = grams.get(at, 0) + 1
        vector = np.zeros(1 << langid.BITS)
        for at, n in grams.items():
            vector[at] = np.log1p(n) * model.idf[at]
        cosines = model.vectors @ vector / np.linalg.norm(vector)
        best = int(np.argmax(cosines))
        assert lang == model.languages[best] and score == pytest.approx(min(1, cosines[best]), abs=1e-5), doc_id
        assert rejected == (cosines[best] < model.least[best]) or abs(cosines[best] - model.least[best]) < 1e-6


def test_gram_counts_in_pieces(monkeypatch):
    text = " ".join(texts(B, 3, 5)).encode()
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "_PIECE", 17)
    assert np.array_equal(whole, langid.gram_counts(text))


def test_classifier(spark, docs):
    good, bad = texts(A, 80, 3), texts([w.upper() + "!" for w in A] + ["spam"] * 5, 80, 4)
    rows = [(k, t) for k, t in enumerate(good)] + [(100 + k, t) for k, t in enumerate(bad)]
    labels = spark.createDataFrame([(k, int(k < 100)) for k, _ in rows if k % 4] + [(500, 1), (1, None), (2, 7)], "doc_id long, label int")
    w = ftrl.fit(docs(rows, extra=True), labels)
    out = {r.doc_id: r for r in ftrl.score_documents(docs(rows + [(900 + k, t) for k, t in enumerate(ODD)], extra=True), w).collect()}
    assert np.mean([out[k].predicted == (k < 100) for k, _ in rows if k % 4 == 0]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out.values())
    assert out[900].score == out[901].score
    assert np.array_equal(w, ftrl.fit(docs(rows), labels))
    none = ftrl.fit(docs(rows), labels.where("false"))
    assert {r.score for r in ftrl.score_documents(docs(["a", None]), none).collect()} == {0.5}


def test_labelled_sample_is_bounded(spark, docs):
    """Repeated ids and labels don't multiply, and rows come whole or not at all."""
    rows = [(1, "same words here")] * 300 + [(1, "another text")] + [(k, f"some words {k}") for k in range(10, 30)]
    labels = spark.createDataFrame([(1, 1)] * 50 + [(k, k % 2) for k in range(10, 30)], "doc_id long, label int")
    got = ftrl.sample(docs(rows), labels, ftrl.BITS, 100, 10**6, 1)
    assert len(got) == 22
    assert len(ftrl.sample(docs(rows), labels, ftrl.BITS, 7, 10**6, 1)) == 7
    order = [r["idx"] for r in got]
    assert [r["idx"] for r in ftrl.sample(docs(rows), labels, ftrl.BITS, 100, sum(r["n"] for r in got[:5]), 1)] == order[:5]


def test_long_texts_keep_all_features(spark, docs):
    text = " ".join(f"w{k}" for k in range(20_000))
    (row,) = ftrl.sample(docs([(1, text)]), spark.createDataFrame([(1, 1)], "doc_id long, label int"), ftrl.BITS, 10, 10**6, 1)
    assert row["n"] == len(ftrl.features(text.encode())[0]) > 30_000 and len(row["idx"]) == 4 * row["n"]


def test_scores_by_brute_force(spark, docs):
    """Hashed unigrams and bigrams, weights and the logistic anew."""
    r = np.random.default_rng(5)
    w = r.normal(size=(1 << ftrl.BITS) + 1)
    rows = [(k, t) for k, t in enumerate([*ODD, *texts(A, 5, 1), "Same same SAME x"])]
    for row in ftrl.score_documents(docs(rows), w).collect():
        words = [x.lower() for x in (rows[row.doc_id][1] or "").encode().split()]
        hashes = [int(common.word_hashes(x)[0]) for x in words]
        grams = hashes + [int(common.gram_hashes(np.array(hashes[k : k + 2], np.uint64), 2)[0]) for k in range(len(hashes) - 1)]
        count = {}
        for g in grams:
            count[g >> (64 - ftrl.BITS)] = count.get(g >> (64 - ftrl.BITS), 0) + 1
        value = {g: 1 + np.log(n) for g, n in count.items()}
        norm = np.sqrt(sum(v * v for v in value.values())) or 1.0
        assert row.score == pytest.approx(1 / (1 + np.exp(-(sum(w[g] * v for g, v in value.items()) / norm + w[-1]))))


def test_ftrl_against_dense_updates():
    """The sparse update equals the textbook update on all coordinates."""
    model, r = ftrl.Ftrl(6, l1=0.1), np.random.default_rng(1)
    z, n = np.zeros(7), np.zeros(7)
    for _ in range(40):
        index = np.sort(r.choice(6, 3, replace=False))
        value, label = r.random(3), int(r.integers(2))
        x = np.zeros(7)
        x[index], x[6] = value, 1
        w = np.where(np.abs(z) <= 0.1, 0, -(z - np.sign(z) * 0.1) / ((1 + np.sqrt(n)) / model.alpha + model.l2))
        g = (1 / (1 + np.exp(-w @ x)) - label) * x
        z += g - (np.sqrt(n + g * g) - np.sqrt(n)) / model.alpha * w
        n += g * g
        model.update(index, value, label, 1.0)
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        ("https://WWW.Example.ORG/es/1?x", "www.example.org", "/es/1", "example.org/es/", "block"),
        ("http://example.org/en/2#a", "example.org", "/en/2", "org/", "allow"),
        ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        ("ftp://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("http://a.com/fr/", "a.com", "/fr/", "com/fr/", "allow"),
        ("x://com/de/#", "com", "/de/", "com/de/", "block"),
        ("http://a.org", "a.org", "", None, None),
        ("http://a.org?q=/", "a.org", "", None, None),
        ("http://a.orgx/", "a.orgx", "/", None, None),
        ("no scheme/es/", "", "", None, None),
        ("a://b://c/d", "b:", "//c/d", None, None),
        ("", "", "", None, None),
        (None, "", "", None, None),
    ],
)
def test_url_rules(spark, url, host, path, rule, verdict):
    df = spark.createDataFrame([(url,)], "url string")
    h, p = url_filter.split_url(F.col("url"))
    got = df.select(h.alias("h"), p.alias("p")).withColumn("r", url_filter.rule_of(F.col("h"), F.col("p"), RULES)).first()
    assert (got.h, got.p) == (host, path)
    assert (got.r and tuple(got.r)) == ((rule, verdict) if rule else None)


def test_url_models(spark):
    r = np.random.default_rng(2)
    rows = [(k, f"http://s{k}.org/news/{r.integers(999)}") for k in range(60)] + [(100 + k, f"http://s{k}.com/de/win-cash-{r.integers(999)}") for k in range(60)]
    odd = [(200, None), (201, ""), (202, "http://x.net/news/77"), (203, "http://x.net/win-cash-5"), (203, "http://x.net/win-cash-5")]
    pages = spark.createDataFrame(rows + odd, "page_id long, url string").withColumn("rule", F.lit("clash"))
    out = url_filter.judge_urls(pages, RULES).collect()
    assert len(out) == len(rows) + len(odd)
    by = {x.page_id: x for x in out}
    assert by[202].verdict == "allow" and by[203].verdict == "block" and by[202].figure > by[203].figure
    assert all(x.verdict in ("allow", "block") for x in out) and by[0].rule == "org/" and by[0].figure is None
    assert url_filter.judge_urls(pages.limit(0), RULES).collect() == []


class Markov:
    """Counts of the byte after each context, as a dictionary."""

    def __init__(self, urls, order):
        self.order, self.next = order, {}
        for url in urls:
            padded = b"\2" * order + url + b"\3"
            for k in range(order, len(padded)):
                for n in range(order + 1):
                    follow = self.next.setdefault(padded[k - n : k], {})
                    follow[padded[k]] = follow.get(padded[k], 0) + 1

    def probability(self, context, byte):
        p = 1 / 256
        for n in range(self.order + 1):
            seen = self.next.get(context[len(context) - n :])
            if seen is None:
                break
            p = (seen.get(byte, 0) + len(seen) * p) / (sum(seen.values()) + len(seen))
        return p

    def log_likelihood(self, url):
        padded = b"\2" * self.order + url + b"\3"
        return sum(np.log2(self.probability(padded[k - self.order : k], padded[k])) for k in range(self.order, len(padded)))


@pytest.mark.parametrize("order", [2, 5])
def test_figures_by_brute_force(spark, order):
    """Every figure, and the best threshold among all."""
    import hashlib

    r = np.random.default_rng(3)
    rows = [f"http://s{k % 30}.org/news/{r.integers(99)}" for k in range(150)] + [f"http://s{k}.com/de/win-é-{r.integers(999)}" for k in range(90)]
    rows += [f"http://x.net/{w}/{r.integers(99)}" for w in ("news", "win", "é", "") for _ in range(5)] + [None, "", "http://x.net/" + "ab" * 3000, "http://x.net/news/1", "http://x.net/news/1"]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    out = {x.page_id: x for x in url_filter.judge_urls(pages, RULES, order=order).collect()}
    assert sorted(out) == list(range(len(rows)))
    verdicts = {rows[k]: x.verdict for k, x in out.items() if x.rule}

    def held(url):
        return int(hashlib.md5(f"{url}{url_filter.SEED}".encode()).hexdigest()[:8], 16) % 4 == 3

    good, bad = (Markov([u.encode() for u, v in verdicts.items() if v == verdict and not held(u)], order) for verdict in url_filter.VERDICTS)

    def figure(url):
        raw = (url or "").encode()
        return (good.log_likelihood(raw) - bad.log_likelihood(raw)) / len(raw) if raw else 0.0

    marks = [(figure(u), v) for u, v in verdicts.items() if held(u)]
    n = {v: sum(x == v for _, x in marks) for v in url_filter.VERDICTS}

    def rate(cut):
        return sum((f >= cut) == (v == "allow") and 1 / n[v] for f, v in marks)

    cells = {}
    for f, v in marks:
        cells[round(f * url_filter.GRID), v] = cells.get((round(f * url_filter.GRID), v), 0) + 1
    cut = url_filter.best_cut([(c, v, k) for (c, v), k in cells.items()])
    assert rate(cut) == pytest.approx(max(rate(f + e) for f, _ in marks for e in (-2e-3, 2e-3)))
    for k, x in out.items():
        if x.rule is None:
            assert x.figure == pytest.approx(figure(rows[k]), abs=1e-5)
            assert x.verdict == ("allow" if x.figure >= cut else "block") or abs(x.figure - cut) < 2e-3


def test_probabilities_sum_to_one():
    model = Markov([b"abcabc", b"abd"], 2)
    for context in (b"\2\2", b"ab", b"zz"):
        assert sum(model.probability(context, c) for c in range(256)) == pytest.approx(1)
