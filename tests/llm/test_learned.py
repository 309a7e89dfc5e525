"""Toxicity and HTML extraction: parts against brute force, models by held-out rows."""

import html
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from notecohort.llm import html_extract as H
from notecohort.llm import toxicity as T

BAD = ["blockhead", "nitwit", "scoundrel", "dimwit", "oaf"]


def test_automaton_equals_edit_distance():
    rnd = random.Random(1)
    terms = [("".join(rnd.choice("abc") for _ in range(rnd.randint(2, 10))), False, 1.0) for _ in range(30)]
    lexicon = T.Lexicon(terms)
    for _ in range(4000):
        word = rnd.choice(terms)[0] if rnd.random() < 0.5 else "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 11)))
        for _ in range(rnd.randint(0, 3)):
            i = rnd.randrange(len(word) + 1)
            word = word[:i] + rnd.choice(["", "a", "d"]) + word[i + rnd.randint(0, 1):]
        if not word:
            continue
        near = [d for t, _, _ in terms if (d := brute.edit_distance(t, word)) <= T.Lexicon.edits(t)]
        got = lexicon.match(word)
        assert (got is None) == (not near) and (got is None or got[1] == min(near)), word
    assert T.Lexicon([("abcd", True, 1.0)]).match("abcdefg") == (0, 0)
    assert T.Lexicon([("abcd", True, 1.0)]).match("abce") is None and T.Lexicon([]).match("x") is None


def test_quotation_is_told_from_abuse():
    lexicon = T.Lexicon([("nitwit", False, 6.0)])
    direct, quoted = T.features(lexicon, "you are a nitwit here"), T.features(lexicon, 'the label "nitwit" was used')
    assert direct[0] > 0 and direct[2] == 0 and direct[4] > 0
    assert quoted[0] == 0 and quoted[2] > 0
    assert T.features(lexicon, "a nitwitt")[1] > 0 and T.features(lexicon, "") == [0.0] * T.FEATURES


def test_contractions_and_brackets_are_no_quotation(spark, made):
    lexicon = T.Lexicon([("nitwit", False, 6.0)])
    for s in ("you don't think nitwit and you can't", "he (a nitwit here) went", 'a "thing" nitwit and "more"', "it's a nitwit (yes)",
              "the boys' own nitwit and the girls' too"):
        assert T.features(lexicon, s)[0] > 0 and T.features(lexicon, s)[2] == 0, s
    for s in ('the "old nitwit" word', "the 'don't nitwit' word", "the „nitwit“ word", "the «nitwit» word", '"nitwit"'):
        assert T.features(lexicon, s)[0] == 0 and T.features(lexicon, s)[2] > 0, s
    docs, labels, _ = made
    plain = "some nitwit and a blockhead with a scoundrel"
    texts = [plain, "he doesn't nitwit, can't (blockhead), won't, isn't a scoundrel, don't", "well (nitwit) and (blockhead) and (scoundrel) so",
             '"nitwit" and then some more words so that these stand far enough apart from each other "blockhead" '
             'and then again some more words so that these stand far enough apart "scoundrel"']
    more = docs.unionByName(spark.createDataFrame([(10_000 + i, t, None, "s", 1, 2) for i, t in enumerate(texts)], docs.schema))
    got = {r.doc_id: r for r in T.toxicity(more, labels).collect() if r.doc_id >= 10_000}
    assert all(got[10_000 + i].predicted for i in range(3))
    base = float(T.train(docs, labels, ~T.held_out(F.col("doc_id"))).score(np.zeros((1, T.FEATURES)))[0])
    assert base < got[10_003].score < got[10_000].score


def corpus(n=600):
    rnd = random.Random(2)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(2, 9))) for _ in range(rnd.randint(5, 120))]
        toxic = i % 4 == 0
        for _ in range(rnd.randint(2, 4) if toxic else 0):
            bad = rnd.choice(BAD)
            if rnd.random() < 0.2 and len(bad) > 5:
                bad = bad[:2] + "x" + bad[3:]
            words.insert(rnd.randrange(len(words)), bad)
        docs.append((i, " ".join(words), None, "s", 1, 2))
        labels.append((i, None, int(toxic)))
    return docs, labels


def test_swaps_are_one_edit():
    rnd = random.Random(5)
    terms = [("".join(rnd.choice("abc") for _ in range(rnd.randint(2, 10))), False, 1.0) for _ in range(30)]
    lexicon = T.Lexicon(terms, swaps=True)

    def distance(a, b):  # edits and changes of place of two letters, none edited twice
        d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 2:i] == b[j - 1] + b[j - 2]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]

    for _ in range(3000):
        word = rnd.choice(terms)[0]
        for _ in range(rnd.randint(0, 2)):
            i = rnd.randrange(len(word))
            word = word[:i] + rnd.choice([word[i:i + 2][::-1], "d"]) + word[i + 2:]
        near = [d for t, _, _ in terms if (d := distance(t, word)) <= T.Lexicon.edits(t)]
        got = lexicon.match(word)
        assert (got is None) == (not near) and (got is None or got[1] == min(near)), word


def test_texts_with_misspelt_terms_alone_are_found(spark):
    docs, labels = corpus()
    for bad in BAD:  # no misspelling in the labelled rows
        docs = [(i, t.replace(bad[:2] + "x" + bad[3:], bad), *r) for i, t, *r in docs]
    rnd = random.Random(6)
    words = lambda: ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(2, 9))) for _ in range(40)]
    tried = []
    for kind in ("clean", "letter", "swap"):
        for _ in range(40):
            w = words()
            for _ in range(0 if kind == "clean" else 2):
                bad = rnd.choice([b for b in BAD if len(b) > 4])
                i = rnd.randrange(1, len(bad) - 2)
                i += bad[i] == bad[i + 1]
                w.insert(rnd.randrange(len(w)), bad[:i] + "x" + bad[i + 1:] if kind == "letter" else bad[:i] + bad[i + 1] + bad[i] + bad[i + 2:])
            tried.append((kind, " ".join(w)))
    schema = "doc_id long, text string, lang string, source string, toxic int, score int"
    table = spark.createDataFrame(docs + [(10_000 + i, t, None, "s", 1, 2) for i, (_, t) in enumerate(tried)], schema)
    got = {r.doc_id: r.predicted for r in T.toxicity(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    share = {k: np.mean([got[10_000 + i] for i, (x, _) in enumerate(tried) if x == k]) for k in ("clean", "letter", "swap")}
    assert share["clean"] < 0.05 and min(share["letter"], share["swap"]) > 0.95, share


def lexicon_terms(spark, rows):
    table = spark.createDataFrame(rows, "text string, toxic int").repartition(6)
    n1 = sum(y for _, y in rows)
    return T._terms(table.where("toxic = 1"), table.where("toxic = 0"), n1, len(rows) - n1)


def test_whole_words_stay_beside_beginnings(spark):
    rows = [(f"{a}{w} tail{i}" if i % 2 else f"plain words{i} morn", i % 2)
            for i, (a, w) in enumerate([("grumb", x) for x in ("lersome", "lingly", "elicious")] * 40)]
    terms = lexicon_terms(spark, rows)
    stems = [t for t, prefix, _ in terms if prefix]
    assert stems and {"grumblersome", "grumblingly", "grumbelicious"} <= {t for t, prefix, _ in terms if not prefix}
    assert T.Lexicon(terms, True).match("gurmblingly")[1] == 1


def test_the_lexicon_has_no_caps(spark):
    """A long tail of terms, each in a few of many toxic rows, is learned whole; chance words are not."""
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9))
    bad, plain = [word() for _ in range(900)], [word() for _ in range(4000)]
    rows = [(" ".join(rnd.sample(plain, 12) + [bad[i % 900]] * (i < 6300)), int(i < 6300)) for i in range(16_000)]
    terms = {t for t, prefix, _ in lexicon_terms(spark, rows)}
    known = lambda w: any(w.startswith(t) for t in terms)
    assert sum(map(known, bad)) > 0.99 * len(bad) and sum(map(known, plain)) < 0.02 * len(plain)


@pytest.fixture(scope="module")
def made(spark):
    docs, labels = corpus()
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, toxic int, score int"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict((d, t) for d, _, t in labels))


def test_held_out_rows_are_told(made):
    docs, labels, truth = made
    out = T.toxicity(docs, labels).collect()
    assert len(out) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    # what held-out rows are labelled changes nothing
    other = labels.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert Counter(map(tuple, T.toxicity(docs, other).collect())) == Counter(map(tuple, out))


def test_scores_equal_brute_force(made):
    docs, labels, _ = made
    model = T.train(docs, labels, ~T.held_out(F.col("doc_id")))
    texts = ["", "you nitwit", 'a "nitwit" word', "ntiwit and blokhead", "(scoundrel) dimwitt, oafs you", "he said nitwit. plain words"]
    texts += [r.text for r in docs.orderBy("doc_id").limit(150).collect()]
    lexicon = model.lexicon()
    got = model.score(np.array([T.features(lexicon, t or "") for t in texts]))
    want = [brute.toxic_score(model, t, T.context, T.Lexicon.edits) for t in texts]
    assert model.trained and np.allclose(got, want, atol=1e-9) and max(want) > 0.9


def test_equal_texts_take_the_toxic_label(spark):
    rows = [(i, f"text {i // 4}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 3)) for i in range(400)], "doc_id long, quality int, toxic int")
    first, again = (T._texts(d, T._labelled(d, labels, F.lit(True))).collect() for d in (docs, docs.repartition(3)))
    assert len(first) == 100 and all(r.toxic == 1 for r in first) and set(first) == set(again)


def test_toxicity_of_odd_rows(spark, odd, none, made):
    docs, labels, _ = made
    model = T.train(docs, labels, F.lit(True))
    scores = {(r.doc_id, r.score) for r in T.score(odd, model).collect()}
    assert len(T.score(odd, model).collect()) == odd.count() and {d for d, _ in scores} == {r.doc_id for r in odd.collect()}
    base = float(model.score(np.zeros((1, T.FEATURES)))[0])
    assert all(abs(s - base) < 1e-12 for d, s in scores if d in (1, 2, 3))
    kept = T.reject_toxic(odd, labels)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    held = {r.doc_id: r.held_out for r in T.toxicity(odd, labels).collect()}
    assert held[None] is False
    assert T.toxicity(none, labels).collect() == [] and T.reject_toxic(none, labels).collect() == []
    assert {r.score for r in T.toxicity(docs, labels.where("toxic = 9")).collect()} == {0.0}
    twice = labels.unionByName(labels.where("toxic = 1").withColumn("toxic", F.lit(0))).unionByName(spark.createDataFrame(
        [(None, 1, 1), (10**9, 1, 1), (3, None, None)], labels.schema))
    assert Counter(map(tuple, T.toxicity(docs, twice).collect())) == Counter(map(tuple, T.toxicity(docs, labels).collect()))


# ---- HTML ----------------------------------------------------------------------------------
def article(source):
    """The given pages' main text, read off their one article element."""
    inside = re.search(r"<article>(.*?)</article>", source, re.S).group(1)
    parts = (html.unescape(re.sub(r"<[^>]*>", " ", p.replace("<b>", "").replace("</b>", ""))) for p in re.split(r"</?(?:h1|p)>", inside))
    return "\n\n".join(x for x in (" ".join(p.split()) for p in parts) if x)


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = {r.page_id: r.html for r in pages.collect()}
    out = H.main_text(pages).collect()
    assert len(out) == len(rows) and all(r.text == article(rows[r.page_id]) and r.n_chars == len(r.text) for r in out)


def test_odd_pages(spark):
    long = "<article>" + "<p>word &amp; word</p>" * 20_000 + "</article>"
    deep = "<div>" * 3000 + "<p>deep</p>"
    pages = [(1, None, None), (2, "u", ""), (3, "u", "no markup at all, only words."), (4, None, long), (None, "u", deep), (5, "u", "<p>a <b>b</p><!-- open"),
             (6, "u", "<script>var x = '<p>'"), (7, "u", "< 5 > 3 <p class='x>y</p>"), (2, "u", "")]
    df = spark.createDataFrame([(*p, 1, "t", 2) for p in pages], "page_id long, url string, html string, n_chars int, text string, turn int")
    out = H.main_text(df).collect()
    assert Counter((r.page_id, r.url) for r in out) == Counter((p, u) for p, u, _ in pages)
    got = {r.page_id: r for r in out}
    assert got[1].text == got[2].text == "" and got[1].n_chars == 0 and "var x" not in got[6].text and "open" not in got[5].text
    assert got[4].text == "\n\n".join(["word & word"] * 20_000)
    empty = spark.createDataFrame([], df.schema)
    assert H.main_text(empty).collect() == []


def told(source):
    """All text that the parser keeps."""
    return " ".join("".join(t for _, _, t in H.parse(source).pieces).split())


def test_unclosed_and_empty_elements_end_before_the_text():
    kept = "<p>one</p> <p>two</p> "
    for noise in ('<svg viewBox="0 0 1 1"/>', "<svg />", "<svg><path d='M0'/><text>x</text></svg>", "<svg><path d='M0'/>", "<svg><title>t</title>x",
                  "<svg><foreignObject><div>x</div></foreignObject></svg>", "<svg><a href='/'><text>x</text></a></svg>", "<svg><svg>x</svg>y</svg>",
                  "<object data='x'>x", "<object data='x'><p>x</p></object>", "<object>x<object>y</object>", "<select><option>x</option></select>",
                  "<select><option>x", "<select><option>x<option>y</select>", "<object><script>'<object>'</script><p>x</p></object>"):
        assert told(kept + noise + kept) == "one two one two", noise
        assert told(kept + noise + kept + noise + kept + "<svg>x</svg>") == "one two one two one two", noise
        assert told(f"<div><span>one</span>{noise}</div> <p>two</p>") == "one two", noise
    assert told("<p>one <a href='/'><svg><path></a>two</p>") == "one two" and told("<svg><path><b>one</b>") == "one"
    assert told(kept + "<svg><foreignObject><div>one</div>") == "one two one" and told(kept + "<script>x" + kept) == "one two"
    many = "<object>" * 20_000
    assert told(many + "<p>one</p>") == "one"


BROKEN = ["<a", "<p a=\"'>", "<svg><foreignObject>", "<svg><foreignObject><div>", "< ", "<b>|</zz>", "<div><b>|</b>", "<span>|<p></p>", "<div>",
          "<select>", "<object><p>", "<ul><li>", "<svg><path><b>x", "<!--", "<a \"'>", "&", "<script>", "<a class="]


@pytest.mark.parametrize("piece", BROKEN)
@pytest.mark.parametrize("end", ["", ">", "</svg>", "<b \">"])
def test_time_grows_with_the_page(piece, end):
    """Broken markup of all kinds takes time in proportion to its length, not to its square."""
    def seconds(n):
        best = 1e9
        for _ in range(2):
            begun = time.perf_counter()
            H.Nodes([H.parse("".join(x * n for x in piece.split("|")) + end)])
            best = min(best, time.perf_counter() - begun)
        return best

    assert seconds(16_000) < 8 * max(seconds(4_000), 0.01)


def test_tags_end_outside_quotes():
    tags = lambda s: [(s[a:b], slash, name) for a, b, slash, name, _ in H.Source(s).marks(0)]
    assert tags("<a href='x>y'>t</a><b c=\"'>\">u") == [("<a href='x>y'>", "", "a"), ("</a>", "/", "a"), ("<b c=\"'>\">", "", "b")]
    assert tags("<p it's><q>") == [("<p it's>", "", "p"), ("<q>", "", "q")]
    assert tags("<a <!-- x --><script><b></script><c") == [("<a <!-- x -->", "", "a")] and tags("1 < 2 <3 > <d/>") == [("<d/>", "", "d")]


def test_icons_do_not_cut_an_article(spark):
    inside = "".join(f"<p>Sentence number {i} of the article, with some words, that goes on for a while.</p>{'<svg class=icon />' * (i == 3)}" for i in range(12))
    source = f"<html><body><nav><a href='/'>home</a></nav><article><h1>Title here</h1>{inside}</article><footer>end</footer></body></html>"
    rows = spark.createDataFrame([(1, "u", source), (2, "u", source.replace("<svg class=icon />", "")), (3, "u", source.replace("<svg class=icon />", "<svg><path>"))],
                                 "page_id long, url string, html string")
    got = {r.page_id: r.text for r in H.main_text(rows).collect()}
    assert "number 11" in got[2] and got[1] == got[2] == got[3]


def test_pages_without_telling_markup(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    trees = H.train(pages)
    rows = [r.html for r in pages.collect()]
    plain = [re.sub(r"<(/?)(article|nav|footer)>", r"<\1div>", s).replace(' class="ad"', "") for s in rows]
    assert np.mean([a == article(s) for a, s in zip(H.extract(plain, trees), rows, strict=True)]) > 0.95
    made = H.template_pages(100, seed=99)  # others than those of the fit
    want = []
    for s in made:
        page = H.parse(s)
        want.append(H.blocks(page, [H.MAIN if y else H.NOISE for y in H.Nodes([page]).labels()]))
    assert np.mean([a == b for a, b in zip(H.extract(made, trees), want, strict=True)]) > 0.9


def test_decoding_never_contradicts_itself():
    rng = np.random.default_rng(0)
    for s in H.template_pages(20, seed=5):
        page = H.parse(s)
        state = H.decode(page, rng.random(len(page.tag)))
        for i in range(1, len(state)):
            above = state[page.parent[i]]
            assert above == H.ABOVE or state[i] == H.NOISE or above == state[i] == H.MAIN


def test_decoding_is_the_best_labelling():
    rng = np.random.default_rng(1)
    page = H.parse("<body><div><p>a b</p><p>c</p></div><div><p>d e f</p></div></body>")
    n = len(page.tag)
    for _ in range(50):
        p = rng.random(n)
        weight = 1 + np.log1p(np.array(page.chars))
        value = lambda s: sum(weight[i] * np.log(p[i] if x == H.MAIN else 1 - p[i]) for i, x in enumerate(s))  # noqa: E731, B023
        every = [[k // 3**i % 3 for i in range(n)] for k in range(3**n)]
        fits = [s for s in every if all(s[page.parent[i]] == H.ABOVE or s[i] == H.NOISE or s[page.parent[i]] == s[i] == H.MAIN for i in range(1, n))]
        assert abs(value(H.decode(page, p)) - max(map(value, fits))) < 1e-9


def test_boosting_learns_a_rule():
    rng = np.random.default_rng(3)
    x = rng.random((4000, 5))
    y = ((x[:, 0] > 0.4) ^ (x[:, 3] > 0.6)).astype(float)
    trees = H.boost(x[:3000], y[:3000])
    assert ((trees.probability(x[3000:]) > 0.5) == y[3000:]).mean() > 0.97
    assert np.allclose(H.boost(x[:50], np.ones(50)).probability(x[:5]), 1, atol=0.01)
