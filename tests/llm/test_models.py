"""Page labelling, language id and quality: learnt models against held-out rows."""

import html
import random
import zlib

import numpy as np

from delaylens.llm import extraction, languages, nbsvm
from tests.llm.helpers import prose

DOCS = "doc_id long, text string, lang string, score string"


def held_out(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 3 == 1


def page(k, rng):
    text = [" ".join(prose(rng, rng.randint(1, 40))) + "." for _ in range(rng.randint(2, 7))]
    body = "".join(f"<p>{html.escape(t)}" + rng.choice(["</p>", "<br>", ""]) for t in text)
    junk = " ".join(prose(rng, 9))
    return (k, f"http://x/{k}", (
        f"<!DOCTYPE html><html><head><title>{text[0]}</title><style>p{{}}</style>"
        f"<script>var t=\"</p>\";</script></head><body><nav><ul><li><a href='/'>{junk[:9]}</a></li>"
        f"<li><a href='/b'>{junk[:5]}</a></li></ul></nav><!-- ad --><div class=\"ad\">{junk}</div>"
        f"<article><h1>{html.escape(text[0])}</h1>{body}</article><footer>&copy; {junk}</footer>"),
            "\n".join(" ".join(t.split()) for t in [text[0], *text]))


def test_blocks_of_odd_markup():
    got = extraction.blocks("a &amp; b<p>c<p title='x>y'>d<b>e</b>\n f<br>g</div><!-- no --><li>"
                            "<a href=1>h</a> i<script>z</script><unknown-tag>j < k<")
    assert [b.text for b in got] == ["a & b", "c", "de f g", "h i", "j < k<"]
    assert got[3].linked == 1 and extraction.blocks("") == []
    assert len(extraction.blocks("<div>" * 3000 + "x" + "</div>" * 3000)) == 1


def test_blocks_of_pages_with_left_out_end_tags():
    def texts(source):
        return [b.text for b in extraction.blocks(source)]

    head = "<html><head><title>T</title>"
    assert texts(head + "<meta charset=x><body><article><h1>a</h1><p>b") == ["a", "b"]
    assert texts(head + "<script>s</script>a <b>c</b><br>d") == ["a c d"]
    assert texts(head + "<style>s</style></head><body>a") == ["a"]
    assert texts("<head><title>T <b>is</b> <!-- x --> it</title><p>a") == ["a"]
    assert texts("<head><title>T<body><article>a") == ["a"]
    assert texts("<head><title>T<b>a</b><p>b") == ["a", "b"] and texts("<title>T") == []
    assert texts("<head-line>a</head-line><title-bar>b</title-bar><b-box>c</b-box>") == ["a", "b", "c"]
    assert "head" not in extraction.blocks(head + "<main>a")[0].path
    assert texts("<p>a <svg viewBox='0 > 1' /> b<p>c") == ["a b", "c"]
    assert texts("<p>a<svg><svg><text>x</text></svg>y<svg/></svg>b<p>c") == ["ab", "c"]
    assert texts("<p>a<svg width=1><path d=''><p>b<SVG><text>x</text></SVG ><p>c") == ["a", "b", "c"]
    assert texts("<p>a<svg-icon>i</svg-icon><p>b<template-x>c<p>d") == ["a", "i", "b", "c", "d"]
    assert texts("<p>a<template>x</template><script src='>'>x</script ><style/>x") == ["a"]
    assert texts("<select><option>x<option>y</select><button><p>z</button><p>a") == ["a"]
    assert texts("<button>m<article>a</article><button>x</button><p>b") == ["m", "a", "b"]


def test_long_blocks_and_pages_are_used_whole(monkeypatch):
    words = ["a"] * 200 + ["b"] * 300
    got = extraction.vectors(extraction.blocks("<p>" + "<br>".join(words)))[0]
    a, b = (extraction.bucket(w, extraction.WORDS) for w in "ab")
    want = np.zeros(extraction.WORDS)
    want[a] += 0.4
    want[b] += 0.6
    assert a != b and np.allclose(got[extraction.PATHS:extraction.PATHS + extraction.WORDS], want)
    for n in (0, 1, 399, 400, 401, 750, 751, 2000):
        cut = extraction.sequences(list(range(n)))
        assert [x for k, p in enumerate(cut) for x in p[50 if k else 0:]] == list(range(n))
        assert all(0 < len(p) <= 400 for p in cut)
    seen = []
    monkeypatch.setattr(extraction.Labeller, "train", lambda net, pages, labels: seen.extend(labels))
    extraction.fit_on(["<article>" + "<p>one text" * 1000 + "</article>", "<article><p>short</article>"])
    assert max(map(len, seen)) <= 400 and sum(map(len, seen)) > 1000


def test_labels_of_real_pages_are_only_attributes(spark):
    odd = ["<article><table><tr><td data-label=\"Price\">ten<td data-label=''>two<td data-label=1>x"
           "</table></article>", "<p \0label=\"7\">a</p><p \0label=\"1\">b</p>"]
    assert [b.label for s in odd for b in extraction.blocks(s)] == [None] * 5
    marked = extraction.blocks(extraction._inside("<div class=x>", "<p>a</p>", 0), relaid=True)
    assert [(b.text, b.label) for b in marked] == [("a", 0)]
    rng = random.Random(4)
    rows = [page(k, rng)[:3] for k in range(12)] + [(50 + k, "u", s) for k, s in enumerate(odd)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    net = extraction.fit(df)
    assert {r.page_id for r in extraction.extract(df, net).collect()} == {r[0] for r in rows}


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    net = extraction.Labeller(4, hidden=3)
    x = rng.normal(size=(2, 5, 4))
    mask = np.array([[1, 1, 1, 1, 1], [1, 1, 1, 0, 0]], bool)
    y = (rng.random((2, 5)) < 0.5) * 1.0

    def loss():
        z = net.forward(x, mask)[0]
        each = np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - z * y
        return each[mask].sum() / mask.sum()

    grads = net.gradients(x, mask, y)
    for name, g in grads.items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        old, eps = net.p[name][at], 1e-5
        net.p[name][at] = old + eps
        high = loss()
        net.p[name][at] = old - eps
        low = loss()
        net.p[name][at] = old
        assert abs((high - low) / (2 * eps) - g[at]) < 1e-6 + 1e-4 * abs(g[at]), name


def test_extraction(spark):
    rng = random.Random(3)
    rows = [page(k, rng) for k in range(160)]
    extra = [(900, None, None), (901, "u", ""), (902, "u", "<p>" + "long words " * 30000), (903, "u", "<")]
    df = spark.createDataFrame([r[:3] for r in rows] + extra,
                               "page_id long, url string, html string").repartition(3)
    net = extraction.fit(df)
    got = {r.page_id: r for r in extraction.extract(df, net).collect()}
    assert len(got) == 164
    right = [got[k].text == want for k, _, _, want in rows]
    assert np.mean(right) > 0.95
    assert got[900].text == "" and got[901].text == "" and got[903].n_chars == len(got[903].text)
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert extraction.fit(df.limit(0)) is None
    assert extraction.extract(df.limit(0), None).count() == 0
    other = ('<div class="content"><h1>A title of the text</h1><p>The text has many words and goes on '
             'for a while here.</p></div><div class="comments"><p>I agree with all of this, thanks a '
             'lot for it.</p></div><div class="footer">Copyright</div>')
    kept = net.label([extraction.vectors(extraction.blocks(other))])[0]
    assert kept.tolist() == [True, True, False, False]


def test_language(spark):
    rng = random.Random(5)
    letters = {"aa": "abcdeé", "bb": "fghijü", "cc": "klmnoñ"}
    rows = [(k, " ".join(prose(rng, rng.randint(2, 60), letters[lang])).capitalize(), lang, "x")
            for k in range(300) for lang in [("aa", "bb", "cc")[k % 3]]]
    odd = [(1000, None, "aa", ""), (1001, "12 34 !?", "bb", ""), (1002, "", None, ""),
           (None, rows[0][1], "aa", ""), (1003, rows[1][1], None, ""), (0, rows[0][1], "aa", "")]
    df = spark.createDataFrame(rows + odd, DOCS)
    model = languages.fit(df)
    assert model.languages == ["aa", "bb", "cc"] and 0 < model.confidence <= 1
    got = languages.predict(df.drop("lang"), model).collect()
    assert len(got) == len(rows) + len(odd)
    want = {i: lang for i, _, lang, _ in rows}
    tested = [r.lang_pred == want[r.doc_id] for r in got if r.doc_id in want and held_out(r.doc_id)]
    assert len(tested) > 50 and np.mean(tested) > 0.97
    for r in got:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (r.doc_id in (1000, 1001, 1002))
    none = languages.fit(df.where("lang = 'zz'"))
    assert none is None
    assert {r.lang_pred for r in languages.predict(df, none).collect()} == {"und"}
    assert languages.predict(df.limit(0), model).count() == 0


def test_every_language_is_learnt(spark):
    """More values than a sample of full size has room for; two fits are the same."""
    rng = random.Random(6)
    pairs = [a + b for a in "abcdefghijklmnopq" for b in "rstuvwxyz"][:150]
    rows = [(k, " ".join(prose(rng, 40, pairs[k % 150])), f"l{k % 150:03d}", "x") for k in range(3000)]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    model = languages.fit(df, sample_rows=1500)
    assert len(model.languages) == 150
    got = languages.predict(df, model).select("doc_id", "lang_pred").collect()
    right = [r.lang_pred == f"l{r.doc_id % 150:03d}" for r in got if held_out(r.doc_id)]
    assert np.mean(right) > 0.8
    again = languages.fit(df.repartition(3), sample_rows=1500)
    assert languages.predict(df, again).select("doc_id", "lang_pred").exceptAll(
        spark.createDataFrame(got)).count() == 0


def test_subwords_belong_to_their_text():
    import pyarrow as pa
    from delaylens.llm import kernels
    texts = ["ab cd", "", None, "Ab  cd\n", "x", "  ", "é é"]
    found, owner = languages.subwords(kernels.texts_of(pa.array(texts)))
    per = [sorted(found[owner == i].tolist()) for i in range(len(texts))]
    for i, t in enumerate(texts):
        alone, own = languages.subwords(kernels.texts_of(pa.array([t])))
        assert per[i] == sorted(alone.tolist()), t
    assert per[0] == per[3] and not per[1] and not per[5] and per[4]


def test_rejection_keeps_the_wanted_share():
    confidence = np.array([0.9, 0.8, 0.7, 0.6])
    assert languages.rejection(confidence, np.array([1, 1, 0, 1]), 0.99) == 0.8
    assert languages.rejection(confidence, np.array([0, 1, 1, 1]), 0.99) == 1.0


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(2)
    rows = [np.sort(rng.choice(40, 8, False)) for _ in range(120)]
    y = np.array([(r < 20).sum() > 4 for r in rows], int)
    ratios = nbsvm.log_ratios(rows, y, buckets=40)
    w, b = nbsvm.descend(rows, y, ratios, epochs=400)
    x = np.zeros((120, 40))
    for i, r in enumerate(rows):
        x[i, r] = ratios[r] / np.linalg.norm(ratios[r])
    s = np.where(y > 0, 1.0, -1.0)

    def primal(w, b):
        return 0.5 * (w @ w + b * b) + np.maximum(0, 1 - s * (x @ w + b)).sum()

    best = primal(w, b)
    for _ in range(300):
        assert primal(w + rng.normal(0, 0.05, 40), b + rng.normal(0, 0.05)) >= best - 1e-2


def test_quality(spark):
    rng = random.Random(6)
    docs, labels = [], []
    for k in range(400):
        words = prose(rng, rng.randint(3, 80))
        good = k % 4 != 0
        text = " ".join(words) if good else rng.choice([
            " ".join(w.upper() + "!!" for w in words), " ".join(w + "***" for w in words),
            " ".join([words[0]] * 30)])
        docs.append((k, text, "en", "x"))
        labels.append((k, int(good), 0))
    odd = [(900, None, "en", ""), (901, "", "en", ""), (None, "text", "en", ""), (0, docs[0][1], "en", "")]
    df = spark.createDataFrame(docs + odd, DOCS)
    marks = spark.createDataFrame(labels + [(None, 1, 0), (5, None, 0)],
                                  "doc_id long, quality int, toxic int")
    model = nbsvm.fit(df, marks)
    got = nbsvm.score(df, model).collect()
    assert len(got) == len(docs) + len(odd) and all(0 <= r.score <= 1 for r in got)
    tested = [r.predicted == int(r.doc_id % 4 != 0) for r in got
              if r.doc_id is not None and r.doc_id < 400 and held_out(r.doc_id)]
    assert len(tested) > 80 and np.mean(tested) > 0.95
    alone = nbsvm.fit(df, marks.where("quality = 1"))
    assert all(r.score > 0.99 for r in nbsvm.score(df, alone).collect())
    nothing = nbsvm.fit(df, marks.limit(0))
    assert all(abs(r.score - 0.5) < 1e-9 for r in nbsvm.score(df, nothing).collect())
    assert nbsvm.score(df.limit(0), model).count() == 0
