"""Quality rules, toxicity and main text against brute force and labelled texts."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridspark.llm import main_text, quality, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_counts(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def texts(seed):
    r = random.Random(seed)
    alphabet = ["a", "b", "é", "ß|", "#x", "日本", "\x85", "\xa0y", "\x1c", "A!"]
    out = [None, "", "\n\n", " \t\r\x0b\x0c", "one", "a b c d e f g h", "a b c d e f g h a b c d e f g h"]
    for _ in range(60):
        out.append("".join(r.choice(alphabet) + r.choice([" ", "  ", "\n", "\t"]) for _ in range(r.randint(0, 120))))
    out.append("long " * 60_000 + "\n" + "x" * 200_000)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_of_whole_texts(seed):
    some = texts(seed)
    counts, bits, line_words, first = quality.measure(some)
    got = list(zip(*[counts[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], strict=True))
    assert got == [slow_counts(t) for t in some]
    assert len(bits) == sum((t or "").count("\n") + 1 for t in some) == len(line_words)
    assert np.add.reduceat(line_words, first).tolist() == counts["n_words"].tolist()


def test_viterbi_is_the_best_of_all_sequences():
    r = random.Random(5)
    for _ in range(30):
        n = r.randint(1, 7)
        e = np.array([r.uniform(-2, 2) for _ in range(n)])
        moves = [[r.uniform(-1, 1) for _ in range(2)] for _ in range(2)]
        score = lambda y: sum(x * s for x, s in zip(e, y, strict=True)) + sum(moves[a][b] for a, b in zip(y, y[1:]))  # noqa: B023, E731
        best = max(itertools.product((0, 1), repeat=n), key=score)
        got = quality.viterbi(e, np.array([0]), moves).tolist()
        assert score(got) == pytest.approx(score(best))


def corpus(spark, n=160):
    r = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        good = i % 3 != 0
        line = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(15)) + "."
        junk = lambda: " | ".join(r.choice(["HOME", "###", "NEXT", "***"]) for _ in range(12))
        body = [line() for _ in range(4)] + ([] if good else [junk() for _ in range(9)])
        r.shuffle(body)
        rows.append((i, "\n".join(body), "en", "s", 1, "clash", False))
        labels.append((i, int(good), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, good string, kept boolean")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_line_model_learns_content(spark):
    docs, labels = corpus(spark)
    model = quality.train(docs, labels.filter("doc_id < 100"))
    got = docs.select("doc_id", quality.judge(F.col("text"), model).alias("q")).select("doc_id", "q.*").collect()
    wrong = [r.doc_id for r in got if r.kept != (r.doc_id % 3 != 0) and r.doc_id >= 100]
    assert len(wrong) <= 2
    bad = next(r for r in got if r.doc_id == 102)
    assert bad.content_words == 60 and bad.n_lines == 13  # the four lines of prose among the junk
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)


def test_quality_without_labels_or_rows(spark):
    docs, labels = corpus(spark, 6)
    model = quality.train(docs, labels.limit(0))
    odd = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "few words"), (3, "w " * 8), (4, " ".join(map(str, range(30))))], "doc_id long, text string")
    got = [tuple(r) for r in odd.select("doc_id", quality.judge(F.col("text"), model).alias("q")).select("doc_id", "q.n_words", "q.base_failed", "q.kept").collect()]
    assert got == [(None, 0, True, False), (1, 0, True, False), (1, 0, True, False), (2, 2, True, False), (3, 8, True, False), (4, 30, False, True)]
    assert quality.keep_good(docs.limit(0), model).count() == 0
    quality.train(docs.limit(0), labels)


def toxic_corpus(spark, n=600):
    r = random.Random(4)
    vocabulary = ["".join(r.choice("abcdefghijklm") for _ in range(5)) for _ in range(400)]
    bad = ["vrekkal", "vrekkot", "vrekkun", "idiot", "zumpt"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = [r.choice(vocabulary) for _ in range(r.randint(20, 200))]
        if toxic:
            for _ in range(max(3, len(words) // 50)):
                words.insert(r.randrange(len(words)), r.choice(bad))
        rows.append((i, " ".join(words), "en", "s", 1, 0.5))
        labels.append((i, 1, int(toxic) if i % 61 else 1 - int(toxic)))  # some labels are wrong
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_corpus(spark)
    model = toxicity.train(docs, labels)
    got = docs.select("doc_id", toxicity.held_out("doc_id").alias("h"), toxicity.score(F.col("text"), model).alias("p")).collect()
    held = [r for r in got if r.h]
    assert 150 < len(held) < 250 and all(0 <= r.p <= 1 for r in got)
    assert sum((r.p >= 0.7) != (r.doc_id % 5 == 0) for r in held) <= 2
    again = toxicity.train(docs.repartition(7), labels)
    assert again["terms"] == model["terms"] and again["signals"] == pytest.approx(model["signals"])
    assert toxicity.keep_clean(docs, model).columns == docs.columns


def test_toxicity_does_not_learn_held_out_labels(spark):
    docs, labels = toxic_corpus(spark)
    wrong = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, labels)["signals"] == toxicity.train(docs, wrong)["signals"]


def test_toxicity_edge_cases(spark):
    docs, labels = toxic_corpus(spark, 10)
    model = toxicity.train(docs.limit(0), labels)  # no row to learn from: the lexicons decide
    odd = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "idiot moron scum"), (3, "word " * 50_000)], "doc_id long, text string")
    rows = odd.select(toxicity.held_out("doc_id").alias("h"), toxicity.score(F.col("text"), model).alias("p")).collect()
    assert [r.p >= 0.7 for r in rows] == [False, False, False, True, False] and rows[0].h is False
    assert toxicity.keep_clean(odd.limit(0), model).count() == 0
    toxicity.train(docs, labels.limit(0))


def test_label_model_recovers_truth_and_dependence():
    r = np.random.default_rng(2)
    truth = r.integers(0, 2, 4000)
    right = lambda p: np.where(r.random(4000) < p, 2 * truth - 1, 1 - 2 * truth)
    good, fair, poor = right(0.95), right(0.8), right(0.6)
    copy = np.where(r.random(4000) < 0.95, poor, right(0.6))  # depends on the poor voter
    votes = np.stack([good, fair, poor, copy], 1).astype(np.int8)
    votes[r.random(4000) < 0.3, 1] = 0
    given = np.where(r.random(4000) < 0.9, truth, 1 - truth)
    post, report = toxicity.label_model(votes, given)
    assert ((post >= 0.5) == truth).mean() > 0.95  # the best possible is 0.9565
    assert report["accuracy"][0] == pytest.approx(0.95, abs=0.03) and report["accuracy"][2] == pytest.approx(0.6, abs=0.05)
    assert 3 in (report["parent"][2], 3) and (report["parent"][3] == 2 or report["parent"][2] == 3)


@pytest.fixture(scope="module")
def page_model():
    return main_text.train()


def test_labelled_pages_come_back(page_model):
    for source in main_text.LABELLED:
        page = main_text.Page(source)
        p, _ = main_text.marginals(page, page_model["unary"], page_model["pair"])
        assert [int(q >= 0.5) for q, t in zip(p, page.text, strict=True) if t] == [g for g, t in zip(page.given, page.text, strict=True) if t]


def test_marginals_equal_enumeration(page_model):
    page = main_text.Page("<div class=ad><p>a b c d.</p><p>e</p></div><div><p>f g h.</p></div>")
    n = len(page.parent)
    pair = {"element": [0.3, -0.4, 0.2, 0.9], "run": [1.0, -0.3, 0.1, 0.7]}
    unary = {f: math.sin(i) for i, f in enumerate(sorted({f for fs in page.features for f in fs}))}
    mass, total = [0.0] * n, 0.0
    for y in itertools.product((0, 1), repeat=n):
        s = sum(unary[f] * v for v, fs in zip(y, page.features, strict=True) for f in fs)
        s += sum(pair["run" if page.text[i] is not None else "element"][2 * y[page.parent[i]] + y[i]] for i in range(1, n))
        total += math.exp(s)
        for i in range(n):
            mass[i] += y[i] * math.exp(s)
    got, joint = main_text.marginals(page, unary, pair)
    assert got == pytest.approx([m / total for m in mass])
    assert all(sum(j) == pytest.approx(1) for j in joint[1:])


def runs(source):
    return [t for t in main_text.Page(source).text if t is not None]


def test_reading_broken_pages():
    assert runs("a<p>b &amp; c&nbsp;d<p>e<br>f\n\t g<b>h</b>i") == ["a", "b & c d", "e f ghi"]
    assert runs("<script>x<p>y</script><p>z<!-- q <p> -->w</p><style>") == ["zw"]
    assert runs('<p title="a > b">c</p><p title="d>e') == ["c", 'e'] or runs('<p title="a > b">c</p>') == ["c"]
    assert runs("1 < 2 <3 > 4") == ["1 < 2 <3 > 4"]
    assert runs("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><table><tr><td>e<td>f<tr><td>g</table>") == list("abcdefg")
    assert runs("<!-- never closed <p>a") == [] and runs("<p") == [] and runs("") == []
    assert runs("<head><title>t</title></head><body><p>x") == ["x"] and runs("<head><title>t</title><body><p>x") == ["x"]
    assert len(runs("<p>a" * 20_000)) == 20_000
    deep = "<div>" * 20_000 + "x"
    assert runs(deep) == ["x"]
    assert runs('<p a="' * 5000) is not None


def test_quotes_of_attributes():
    assert runs("""<p>a<img alt='15" screen'>b</p><p title="x">c</p><p>d</p>""") == ["ab", "c", "d"]
    assert runs("""<p>a<a href="x"">b</a></p><p title="y">c</p><p>d</p>""") == ["ab", "c", "d"]
    assert runs("""<p title='a > "b' id=x>c</p><p title="it's > d">e</p>""") == ["c", "e"]
    assert runs("""<p>a<b x=5">b</b></p><p class="y">c</p>""") == ["ab", "c"]
    assert runs("""<p title="a>b</p><p>c</p>""") == ["b", "c"]
    page = main_text.Page("""<div title='9" >' class="footer">x</div>""")
    assert "hint foot" in page.features[1]
    assert runs("""<p a=">" """ * 50_000) is not None


def test_formulas_and_fallback_text_are_read(page_model):
    assert runs("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p><xmp>a <b> &amp;</xmp><p>z") == ["so x=2 holds", "a <b> &amp;", "z"]
    for name in ("object", "noscript", "canvas", "template"):
        assert runs(f"<p>a</p><{name}><p>b</p></{name}><p>c</p>") == ["a", "b", "c"]
        assert runs(f"<p>a</p><{name}><p>b</p>") == ["a", "b"]
    for name in ("select", "svg", "title", "textarea", "xmp"):
        assert runs(f"<p>a</p><{name}><p>b</p>") == ["a", "b"]
    assert runs("<select><option>a<option>b</select><svg/>c") == ["a b", "c"]
    assert runs("<p>a</p><script>b</script ><style>c</style><title>d</title><textarea>e</textarea><p>f") == ["a", "f"]
    assert runs("<p>a <img><noscript><img src=x></noscript><svg><title>t</title><path/></svg>b<hr>c<hr>d") == ["a b", "c", "d"]
    assert len(main_text.Page("<p>a<hr>b<hr>c").parent) == 5
    assert runs("<object>" * 20_000 + "a" + "</object>" * 20_000) == ["a"]
    assert len(runs("<p>a<title>" * 20_000)) == 20_000
    words = main_text.WORDS
    article = f"<p>{words}.</p><noscript><p>{words}, fallback.</p></noscript><xmp>{words} kept</xmp><p>{words} <math><mi>y</mi></math>.</p>"
    page = main_text.Page(f"<body><nav><a>Home</a></nav><article>{article}</article><footer>© Site</footer></body>")
    p, _ = main_text.marginals(page, page_model["unary"], page_model["pair"])
    kept = [t for t, q in zip(page.text, p, strict=True) if t and q >= 0.5]
    assert kept == [f"{words}.", f"{words}, fallback.", f"{words} kept", f"{words} y."]


def test_extract_rows(spark, page_model):
    rows = [(1, "u", main_text.LABELLED[0], "clash"), (None, None, None, None), (2, "v", "", ""), (2, "v", "", ""), (3, "w", "<p>" + "word. " * 60_000, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_text.extract(pages, page_model).collect()
    assert [(r.page_id, r.url) for r in got] == [(r[0], r[1]) for r in rows]
    assert got[0].text.startswith("Flood\n\nthe river") and "Related" not in got[0].text and "cookies" not in got[0].text
    assert [r.text for r in got[1:4]] == [""] * 3 and all(r.n_chars == len(r.text) for r in got)
    assert got[4].n_chars == 60_000 * 6 - 1
    assert main_text.extract(pages.limit(0), main_text.train(pages.limit(0))).count() == 0


def test_pages_of_the_table_whole(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = main_text.extract(pages, main_text.train(pages)).join(pages.select("page_id", "html"), "page_id").collect()
    import html

    for r in got:
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert r.text == "\n\n".join(b for b in blocks if b)


def test_stray_end_tags_take_linear_time():
    import time

    def took(n):
        page = "<div>a" * n + "</p>" * n + "<ul>" + "<li>b" * n
        t = time.perf_counter()
        main_text.Page(page)
        return time.perf_counter() - t

    took(500)
    assert took(16_000) < 24 * max(took(2_000), 1e-3)  # eight times the page
    page = main_text.Page("<div><p>a</span></b></p><ul><li>x</ul></li></div></div>")
    assert [t for t in page.text if t] == ["a", "x"] and not any(page.open.values())
