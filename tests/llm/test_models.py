"""Language models (op3) and pairwise ranking (op9): probabilities, accuracy, hard rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dimload.llm import bradley_terry, kneser_ney

from .conftest import HARD

SYLLABLES = {"aa": "ka ki ku ta ti".split(), "bb": "zor zur grat brum".split(), "cc": "éli oue lle ai".split()}


def sentence(rng, lang):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 30)))


def corpus(n=300, seed=3):
    rng = random.Random(seed)
    langs = [rng.choice(sorted(SYLLABLES)) for _ in range(n)]
    return [(i, sentence(rng, lang), lang) for i, lang in enumerate(langs)]


def fitted(grams):
    """The sorted hash arrays of one language from its longest n-grams, in memory."""
    ORDER = kneser_ney.ORDER
    shares, weights = [], []
    full = grams["depth"].to_numpy()
    levels = []
    for k in range(ORDER, 0, -1):
        here = grams[full == k][[f"g{k}", *([f"c{k - 1}"] if k > 1 else [])]].to_numpy(np.int64)
        n = grams.loc[full == k, "n"].to_numpy(np.float64)
        if levels:  # shorter n-grams: the number of different characters seen before them
            longer = grams[full > k].drop_duplicates(f"g{k + 1}")
            inner = longer[[f"g{k}", *([f"c{k - 1}"] if k > 1 else [])]].to_numpy(np.int64)
            here = np.concatenate([here, inner])
            n = np.concatenate([n, np.ones(len(inner))])
        keys, first, inverse = np.unique(here[:, 0], return_index=True, return_inverse=True)
        count = np.bincount(inverse, weights=n, minlength=len(keys))
        context = here[first, 1] if k > 1 else np.zeros(len(keys), np.int64)
        once, twice = (count == 1).sum(), (count == 2).sum()
        discount = min(0.95, max(0.1, once / max(once + 2 * twice, 1)))
        names, which = np.unique(context, return_inverse=True)
        total = np.bincount(which, weights=count, minlength=len(names))
        kinds = np.bincount(which, minlength=len(names))
        shares.append((keys, (count - np.minimum(discount, count)) / total[which]))
        weights.append((names, np.minimum(1.0, discount * kinds / total)))
        levels.append(k)
    out = {"characters": np.array([float(len(shares[-1][0]) + 1)]), "root": weights[-1][1]}
    for name, parts in (("grams", shares), ("contexts", weights[:-1])):
        keys = np.concatenate([p[0] for p in parts]).view(np.uint64)
        order = np.argsort(keys)
        out[name], out[name[:-1] + "_values"] = keys[order], np.concatenate([p[1] for p in parts])[order].astype(np.float32)
    return out


def plain_entropies(training, texts):
    """Interpolated Kneser-Ney by dictionaries of strings: the cross-entropy of each text."""

    def places(text):
        for word in re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower()):
            marked = "\0" + word + "\0"
            for i in range(1, len(marked)):
                yield marked[max(0, i + 1 - kneser_ney.ORDER) : i + 1]

    longest = Counter(g for t in training for g in places(t))
    level = {}
    for k in range(kneser_ney.ORDER, 0, -1):
        count = Counter({g: n for g, n in longest.items() if len(g) == k})
        for longer in {g[-k - 1 :] for g in longest if len(g) > k}:
            count[longer[1:]] += 1
        once, twice = (sum(n == x for n in count.values()) for x in (1, 2))
        discount = min(0.95, max(0.1, once / max(once + 2 * twice, 1)))
        total, kinds = Counter(), Counter()
        for g, n in count.items():
            total[g[:-1]] += n
            kinds[g[:-1]] += 1
        level[k] = count, discount, total, kinds
    characters = len(level[1][0]) + 1

    def chance(g):
        count, discount, total, kinds = level[len(g)]
        c = g[:-1]
        share = max(count[g] - discount, 0) / total[c] if g in count else 0.0
        back = min(1.0, discount * kinds[c] / total[c]) if c in total else 1.0
        return share + back * (chance(g[1:]) if len(g) > 1 else 1 / characters)

    return [-sum(math.log(chance(g)) for g in places(t)) / max(sum(1 for _ in places(t)), 1) for t in texts]


def test_scores_equal_plain_kneser_ney(spark):
    """Languages and cross-entropies of all documents, against models of strings and dictionaries."""
    rows = [(i, t if i % 9 else t.upper() + " Zür 12", lang) for i, t, lang in corpus(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = {r["doc_id"]: r for r in kneser_ney.predict(df, kneser_ney.fit(df.where("doc_id % 3 <> 0")), F.col("doc_id") % 3 != 0).collect()}
    langs = sorted({r[2] for r in rows})
    by_lang = [plain_entropies([t for i, t, x in rows if x == lang and i % 3], [t for _, t, _ in rows]) for lang in langs]
    for k, (i, _, _) in enumerate(rows):
        mine = [e[k] for e in by_lang]
        assert got[i]["cross_entropy"] == pytest.approx(min(mine), rel=1e-5)
        assert got[i]["lang_pred"] == langs[mine.index(min(mine))]


def test_a_language_without_a_right_document_has_the_pooled_bound(spark):
    df = spark.createDataFrame([*corpus(120), (900, "ka", "zz")], "doc_id long, text string, lang string")
    models = kneser_ney.fit(df)
    odd = spark.createDataFrame([(901, "ka qqqqq wwww xxxx vvvv qqqq", None)], df.schema)
    out = kneser_ney.predict(df.unionByName(odd), models, F.col("doc_id") < 900).where("doc_id = 901").first()
    assert out["rejected"]


def model_of(texts):
    words = kneser_ney._lowered(pa.array(texts))
    p = kneser_ney.positions(words.vocabulary)
    weight = np.bincount(words.codes, minlength=len(words.vocabulary))[p["word"]]
    rows = pd.DataFrame({c: v.view(np.int64) if v.dtype == np.uint64 else v for c, v in p.items()}).assign(n=weight)
    same = {c: "first" for c in rows.columns if c not in ("gram", "n")}
    return fitted(rows.groupby("gram", as_index=False).agg(same | {"n": "sum"}))


def test_chances_sum_to_one():
    """After any context, the chances of all characters (and of an unseen one) sum to one."""
    texts = ["abab abba bab", "ba ab aab abbb", "b a"]
    model = model_of(texts)
    letters = sorted({c for t in texts for c in t if c != " "})
    for context in ("", "a", "ab", "bba", "abab"):
        total = 0.0
        for c in [*letters, None, "q"]:
            word = context + (c or "")
            p = kneser_ney.positions(pa.array([word]))
            at = len(p["depth"]) - 1 if c is None else len(word) - 1
            total += float(np.exp(kneser_ney.log_chances(model, p, np.array([at]))[0]))
        assert total == pytest.approx(1.0, abs=1e-5)


def test_model_does_not_depend_on_partitions(spark):
    rows = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    a, b = (kneser_ney.fit(rows.repartition(n)) for n in (1, 7))
    for lang in a:
        for name in a[lang]:
            assert np.array_equal(a[lang][name], b[lang][name])


def test_models_hold_all_grams(spark, monkeypatch):
    """Shards in Spark equal one fit in memory over all n-grams, and score alike."""
    assert "max_grams" not in kneser_ney.fit.__code__.co_varnames
    monkeypatch.setattr(kneser_ney, "SHARD_ROWS", 40_000)
    rng = random.Random(8)
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(8)) for _ in range(4_000)] + ["abab abba bab"]
    rows = spark.createDataFrame([(i, t, "zh") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(4)
    models, want = kneser_ney.fit(rows), model_of(texts)
    assert len(models.files) > 1 and sorted(models["zh"]) == sorted(want)
    for name, values in models["zh"].items():
        assert np.array_equal(values, want[name]), name
    got = kneser_ney.predict(rows.where("doc_id < 50 or doc_id = 4000"), models, F.lit(True)).collect()
    for r in got:
        p = kneser_ney.positions(kneser_ney._lowered(pa.array([texts[r["doc_id"]]])).vocabulary)
        assert r["cross_entropy"] == pytest.approx(-kneser_ney.log_chances(want, p, np.arange(len(p["depth"]))).mean())
    assert len(got) == 51


def test_languages_are_told_apart(spark):
    rows = spark.createDataFrame(corpus(), "doc_id long, text string, lang string").repartition(3)
    models = kneser_ney.fit(rows.where("doc_id % 5 <> 0"))
    out = kneser_ney.predict(rows, models, F.col("doc_id") % 5 == 1).join(rows.select("doc_id", "lang"), "doc_id").toPandas()
    held = out[out.doc_id % 5 == 0]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert out.score.between(0, 1).all()
    odd = spark.createDataFrame([(1, "qqq xwv qxq wwv", "aa")], rows.schema)
    assert kneser_ney.predict(odd.unionByName(rows), models, F.col("doc_id") % 5 == 1).where("rejected and doc_id = 1").count() >= 1


def test_language_of_hard_rows(spark, hard, empty):
    models = kneser_ney.fit(hard)
    assert sorted(models) == ["de", "en", "xx"]
    rows = kneser_ney.predict(hard, models, F.lit(True)).collect()
    assert len(rows) == len(HARD)
    for r in rows:
        if r["doc_id"] in (3, 4, 5):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in models
    assert kneser_ney.fit(empty) == {}
    assert {r["lang_pred"] for r in kneser_ney.predict(hard, {}, F.lit(True)).collect()} == {"und"}
    assert kneser_ney.predict(empty, models, F.lit(True)).collect() == []


def test_ranking_recovers_an_order():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 4))
    quality = x @ [2.0, -1.0, 0.0, 0.5] > 0
    model = bradley_terry.learned(x[quality], x[~quality])
    s = (x - model.mean) / model.scale @ model.weights
    assert ((s >= model.threshold) == quality).mean() > 0.97


def labelled(n=240):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        words = [sentence(rng, "aa") for _ in range(3)]
        good = rng.random() < 0.7
        rows.append((i, ". ".join(words) + "." if good else " | ".join(" ".join(words).split()).upper(), int(good)))
    return rows


def test_quality_of_held_out_documents(spark):
    rows = spark.createDataFrame(labelled(), "doc_id long, text string, quality int").repartition(3)
    docs, labels = rows.select("doc_id", "text"), rows.select("doc_id", "quality")
    model = bradley_terry.fit(docs, labels.where("doc_id % 3 <> 1"))
    out = bradley_terry.score(docs, model).join(labels, "doc_id").where("doc_id % 3 = 1").toPandas()
    assert ((out.score >= 0.5) == (out.quality == 1)).mean() > 0.95 and out.score.between(0, 1).all()
    again = bradley_terry.fit(docs.repartition(5), labels.where("doc_id % 3 <> 1"))
    assert np.allclose(model.mean, again.mean)
    small = bradley_terry.fit(docs, labels, max_rows=10, pairs=500)
    assert small is not None


def test_threshold_is_the_best_quantile_of_all_scores(spark):
    """Against numpy over all documents; labels cover some of them."""
    rng = np.random.default_rng(3)
    s = np.concatenate([rng.normal(0, 1, 3000), rng.normal(3, 1, 1000)])
    known = {i: int(s[i] + rng.normal(0, 0.5) > 1.2) for i in rng.permutation(4000)[:700].tolist()}
    scores = spark.createDataFrame([(i, float(x)) for i, x in enumerate(s)], "doc_id long, score double").repartition(3)
    got = bradley_terry.threshold(scores, spark.createDataFrame(list(known.items()), "doc_id long, quality int"))
    good, bad = (np.array([s[i] for i, q in known.items() if q == k]) for k in (1, 0))
    cuts = np.quantile(s, np.linspace(0, 1, bradley_terry.CUTS + 2)[1:-1], method="inverted_cdf")
    balanced = np.array([(good >= c).mean() + (bad < c).mean() for c in cuts])
    assert got in cuts and balanced[list(cuts).index(got)] == pytest.approx(balanced.max())


def brute_features(text):
    """Some of the features by plain Python."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    letters = re.findall(r"[A-Za-z]", text or "")
    chars = max(sum(map(len, w)), 1)
    return [
        np.log1p(len(w)),
        sum(map(len, w)) / max(len(w), 1),
        len(re.findall(r"[#*$%&|<>]", text or "")) / chars,
        len(re.findall(r"[!?]", text or "")) / chars,
        len(re.findall(r"[A-Z]", text or "")) / max(len(letters), 1),
        len(letters) / chars,
    ]


def test_features_equal_plain_python():
    texts = [r[1] for r in HARD] + [t for _, t, _ in labelled(30)]
    got = bradley_terry.features(pa.array(texts))
    assert np.allclose(got[:, :6], [brute_features(t) for t in texts])
    assert np.allclose(got[:, 9], [len(set(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) / max(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), 1) for t in texts])


def test_fit_is_the_minimum_of_the_logistic_loss():
    """The gradient over the drawn pairs, computed the long way, vanishes at the weights."""
    rng = np.random.default_rng(7)
    good, bad = rng.normal(0.4, 1, (80, 3)), rng.normal(0, 1, (60, 3))
    model = bradley_terry.learned(good, bad, pairs=2000, seed=5)
    draw = np.random.default_rng(5)
    a, b = good[draw.integers(0, 80, 2000)], bad[draw.integers(0, 60, 2000)]

    def loss(w):
        return np.mean([np.log1p(np.exp(-((x - y) / model.scale @ w))) for x, y in zip(a, b, strict=True)]) + 0.5e-2 * (w @ w)

    step = np.eye(3) * 1e-4
    assert all(abs(loss(model.weights + e) - loss(model.weights - e)) / 2e-4 < 1e-5 for e in step)


def test_scoring_once_equals_fit_and_score(spark):
    rows = spark.createDataFrame(labelled(), "doc_id long, text string, quality int").repartition(3)
    docs, labels = rows.select("doc_id", "text"), rows.where("doc_id % 2 = 0").select("doc_id", "quality")
    once = {r["doc_id"]: r["score"] for r in bradley_terry.rank(docs, labels).collect()}
    twice = {r["doc_id"]: r["score"] for r in bradley_terry.score(docs, bradley_terry.fit(docs, labels)).collect()}
    assert once.keys() == twice.keys() and all(once[k] == pytest.approx(twice[k]) for k in once)


def test_quality_of_hard_rows(spark, hard, empty):
    labels = spark.createDataFrame([(1, 1), (1, 1), (10, 0), (9, 0), (8, 1), (99, 0)], "doc_id long, quality int")
    model = bradley_terry.fit(hard, labels)
    rows = bradley_terry.score(hard, model).collect()
    assert len(rows) == len(HARD) and all(0 <= r["score"] <= 1 for r in rows)
    kept = bradley_terry.keep(hard, model)
    assert kept.schema == hard.schema
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted(r["doc_id"] or 0 for r in rows if r["score"] >= 0.5)
    assert bradley_terry.fit(hard, labels.where("quality = 1")) is None and bradley_terry.fit(empty, labels) is None
    assert {r["score"] for r in bradley_terry.score(hard, None).collect()} == {0.5}
    assert bradley_terry.score(empty, model).collect() == [] and bradley_terry.keep(empty, model).collect() == []
