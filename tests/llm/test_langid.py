"""Language identification: models against a dictionary version, answers on held-out rows."""

import math
import random
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from notecohort.llm import langid as L
from notecohort.llm import queries, toxicity

SYLLABLES = {"aa": "ka ti po mu ne", "bb": "schu gro bre lim öst", "cc": "zé ñor vô ça quí"}


def sentence(rnd, lang, words):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(4)
    rows = [(i, sentence(rnd, lang := rnd.choice(sorted(SYLLABLES)), rnd.randint(3, 40)), lang) for i in range(600)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)


def chars(text):
    """The characters that the models see, three spaces before the first."""
    out = "   "
    for c in text.lower():
        if unicodedata.category(c)[0] in "LM":
            out += c
        elif out[-1] != " ":
            out += " "
    return out if out[-1] == " " else out + " "


def brute_model(texts):
    """Bits of (character, context) by interpolated Kneser-Ney with continuation counts."""
    grams = {4: Counter()}
    for t in texts:
        s = chars(t)
        grams[4].update(s[i - 3:i + 1] for i in range(3, len(s)))
    for order in (3, 2, 1):
        grams[order] = Counter(g[1:] for g in grams[order + 1])
    total, types, discount = defaultdict(int), defaultdict(int), {}
    for order, counts in grams.items():
        n1, n2 = (sum(n == k for n in counts.values()) for k in (1, 2))
        discount[order] = n1 / (n1 + 2 * n2) if n1 else 0.5
        for g, n in counts.items():
            total[order, g[:-1]] += n
            types[order, g[:-1]] += 1

    def p(g):
        order = len(g)
        lower = p(g[1:]) if order > 1 else 1 / (len(grams[1]) + 1)
        if not total[order, g[:-1]]:
            return lower
        d = discount[order]
        return (max(grams[order][g] - d, 0) + d * types[order, g[:-1]] * lower) / total[order, g[:-1]]

    return p


def test_entropies_equal_a_dictionary_version(corpus):
    rows, docs = corpus
    texts = {lang: [t for _, t, x in rows if x == lang][:60] for lang in SYLLABLES}
    chosen = [(lang, t) for lang, some in texts.items() for t in some]
    model = L.learn(docs.sparkSession.createDataFrame(chosen, "lang string, text string").repartition(4), hash_bits=32)
    assert model.langs == sorted(SYLLABLES)
    probe = ["Kati PO, mune 12 kaka", "schugro! 漢字 zé", "x", "", "  ---ka", "é" * 40, "\U00010428 ka"]
    h, n, lettered = model.entropies(probe)
    assert lettered.tolist() == [True, True, True, False, True, True, True]
    models = [brute_model(texts[lang]) for lang in model.langs]
    for i, t in enumerate(probe):
        s = chars(t) if any(unicodedata.category(c)[0] in "LM" for c in t.lower()) else "   "
        assert n[i] == len(s) - 3
        for k, p in enumerate(models):
            want = -sum(math.log2(p(s[j - 3:j + 1])) for j in range(3, len(s))) / max(len(s) - 3, 1)
            assert h[i, k] == pytest.approx(want, rel=1e-6, abs=1e-9), (t, k)


def test_probabilities_add_up(corpus):
    """Over all characters of a language, seen or not, after seen and unseen contexts."""
    rows, docs = corpus
    model = L.learn(docs.select("lang", "text"), hash_bits=32)
    for k, lang in enumerate(model.langs):
        seen = sorted({c for _, t, x in rows if x == lang for c in chars(t)})
        assert model.types[k] == len(seen)
        for context in ("   ", " ka", "zzz", "mus"):
            grams = np.array([sum(ord(x) << 16 * (3 - i) for i, x in enumerate(context + c)) for c in [*seen, "ж"]], np.uint64)
            assert (2 ** model.log_probability(grams)[:, k]).sum() == pytest.approx(1, abs=1e-6)


def test_hash_is_that_of_spark(spark):
    x = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 200)
    got = spark.createDataFrame([(int(v),) for v in x], "v long").select(F.xxhash64("v")).collect()
    assert L.hash_long(x.view(np.uint64)).view(np.int64).tolist() == [r[0] for r in got]


def test_held_out_rows_and_rejection(corpus):
    rows, docs = corpus
    model = L.train(docs, ~toxicity.held_out(F.col("doc_id")))
    got = L.identify(docs, model).join(docs.withColumn("out", toxicity.held_out(F.col("doc_id"))), "doc_id").where("out").collect()
    assert len(got) > 100 and sum(r.lang == r.lang_pred for r in got) >= 0.99 * len(got)
    assert all(0 <= r.score <= 1 for r in got) and sum(r.rejected for r in got) <= 0.1 * len(got)
    spark = docs.sparkSession
    junk = [(1, "qwx zzpt wqq vvv jjj xxqz " * 4), (2, "Ωμέγα και άλλα γράμματα του ελληνικού αλφαβήτου")]
    assert all(r.rejected and r.lang_pred in model.langs for r in L.identify(spark.createDataFrame(junk, "doc_id long, text string"), model).collect())


def test_score_is_calibrated(spark):
    """Short texts of two languages that share most syllables: the score is about the share of right answers."""
    rnd = random.Random(7)
    own = {"aa": "ka ti po mu ne ta".split(), "bb": "ka ti po mu ne lu".split()}
    rows = []
    for i in range(6000):
        lang = rnd.choice(["aa", "bb"])
        rows.append((i, " ".join(rnd.choice(own[lang]) for _ in range(rnd.randint(1, 8))), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = L.identify(docs, L.train(docs, ~toxicity.held_out(F.col("doc_id")))).join(docs, "doc_id").where(toxicity.held_out(F.col("doc_id"))).toPandas()
    right = got["lang"] == got["lang_pred"]
    assert abs(got["score"].mean() - right.mean()) < 0.05
    sure = got["score"] > 0.9
    assert 0.3 < sure.mean() < 0.8 and right[sure].mean() > 0.95 and right[~sure].mean() < 0.7


def test_odd_rows(odd, none, corpus):
    model = L.train(odd, F.col("doc_id") >= 0)
    assert model.langs == ["de", "en"]
    got = L.identify(odd, model).collect()
    assert len(got) == odd.count()
    for r in got:
        assert r.lang_pred in ("de", "en", "und") and 0 <= r.score <= 1
    lang = {r.doc_id: r for r in got if r.doc_id is not None}
    assert all((lang[i].lang_pred, lang[i].score, lang[i].rejected) == ("und", 0.0, True) for i in (1, 2, 3))
    assert lang[7].lang_pred != "und" and len([r for r in got if r.doc_id == 10]) == 3
    assert L.identify(none, model).collect() == []
    nothing = L.train(none, F.lit(True))
    assert nothing.langs == [] and {(r.lang_pred, r.score, r.rejected) for r in L.identify(odd, nothing).collect()} == {("und", 0.0, True)}
    assert L.identify(none, nothing).collect() == []


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    got = queries.op11_kneser_ney_langid(spark, sf).join(docs, "doc_id").collect()
    out = [r for r in got if r.held_out]
    assert len(got) == docs.count() and sum(r.lang == r.lang_pred for r in out) >= 0.99 * len(out)
