import math
import random
import zlib

import numpy as np

from txengine.llm.hashed_ftrl import Ftrl, FtrlOptions, Hasher, fit_toxicity, keep_clean, score


def _data(spark):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(400):
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(3, 60))]
        if bad := i % 5 == 0:
            w.insert(rng.randrange(len(w)), rng.choice(["Vile!", "awful"]))
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learns_the_words_that_matter(spark):
    docs, labels = _data(spark)
    model = fit_toxicity(docs, labels, FtrlOptions(l1=2.0))
    out = score(docs, model, "doc_id").join(labels, "doc_id").toPandas()
    assert (out.predicted == out.toxic).mean() > 0.97
    assert ((out.score >= 0.5) == (out.predicted == 1)).all() and out.score.between(0, 1).all()
    assert 0 < len(model.at[0]) < 500  # sparse


def test_one_step_by_definition():
    o = FtrlOptions(bits=4, alpha=0.5, beta=1.0, l1=0.1, l2=0.2)
    m = Ftrl(o)
    m.learn(np.array([3, 5]), 1)
    assert m.z[3] == m.z[5] == m.z[-1] == -0.5 and m.n[3] == 0.25
    w = -(-0.5 + 0.1) / ((1 + 0.5) / 0.5 + 0.2)
    assert np.isclose(m._weights(np.array([3]))[0], w)
    assert np.isclose(m._weights(np.array([16]))[0], 0.5 / (1.5 / 0.5 + 0.2))  # no L1 on the intercept


def plain_ftrl(text, toxic, o):
    """Learning written out with dictionaries, update by update, from (id -> text) and
    (id -> label): a function from a text to its score."""
    h, z, n = Hasher(o), {}, {}
    order = sorted((zlib.crc32(str(i).encode()), i) for i in toxic if i in text and zlib.crc32(str(i).encode()) % 5)

    def weight(f):
        l1 = 0 if f == "base" else o.l1
        if abs(z.get(f, 0)) <= l1:
            return 0.0
        return (math.copysign(l1, z[f]) - z[f]) / ((o.beta + math.sqrt(n[f])) / o.alpha + o.l2)

    for _ in range(o.epochs):
        for _, i in order:
            at = [*h.distinct(text[i]).tolist(), "base"]
            w = {f: weight(f) for f in at}
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - toxic[i]
            for f in at:
                before = n.get(f, 0.0)
                z[f] = z.get(f, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / o.alpha * w[f]
                n[f] = before + g * g
    return lambda t: 1 / (1 + math.exp(-sum(map(weight, [*h.distinct(t).tolist(), "base"]))))


def test_end_to_end_by_definition(spark):
    docs, labels = _data(spark)
    o = FtrlOptions(l1=0.5, epochs=2, bits=16)
    text = {r.doc_id: r.text for r in docs.collect()}
    want = plain_ftrl(text, {r.doc_id: r.toxic for r in labels.collect()}, o)
    for r in score(docs, fit_toxicity(docs, labels, o), "doc_id").collect():
        assert math.isclose(r.score, want(text[r.doc_id]), rel_tol=1e-9)


def test_nothing_learnt_drops_nothing(spark):
    docs, labels = _data(spark)
    for lab in (labels.limit(0), labels.where("toxic = 1"), labels.unionAll(labels.selectExpr("doc_id", "1 - toxic"))):
        assert keep_clean(docs, fit_toxicity(docs, lab)).count() == docs.count()
    # a contradicted label teaches nothing, an equal one nothing more
    more = labels.unionAll(labels.where("doc_id < 100")).unionAll(labels.where("doc_id between 200 and 220").selectExpr("doc_id", "1 - toxic"))
    model, want = fit_toxicity(docs, more), fit_toxicity(docs, labels.where("doc_id not between 200 and 220"))
    assert model.intercepts == want.intercepts and model.at[0].tolist() == want.at[0].tolist()


def test_features():
    h = Hasher(FtrlOptions())
    assert len(h.distinct("a b c")) == 6  # three words, two pairs, one skip
    assert len(h.distinct(None)) == len(h.distinct("")) == len(h.distinct("... !")) == 0
    assert h.distinct("A, b").tolist() == h.distinct("a B").tolist()
    assert not set(h.all("a b").tolist()[2:]) & set(h.all("b a").tolist()[2:])


def test_defined_results(spark):
    docs, labels = _data(spark)
    odd = spark.createDataFrame([(None, "awful"), (900, None), (901, ""), (902, "w1 " * 100_000), (0, "again")], "doc_id long, text string")
    more = docs.unionAll(odd).selectExpr("*", "1 as score", "2 as __x")
    lab = labels.unionAll(spark.createDataFrame([(1, None), (None, 1), (2, 0), (2, 0)], "doc_id long, toxic int"))
    model = fit_toxicity(more, lab)
    assert score(more, model, "doc_id").count() == 405
    kept = keep_clean(more, model)
    assert kept.schema == more.schema and {r.doc_id for r in kept.collect()} >= {900, 901, 902}
    none = fit_toxicity(docs, labels.limit(0))
    assert {r.score for r in score(docs.limit(3), none).collect()} == {0.5}
    clean = fit_toxicity(docs, labels.where("toxic = 0"))
    n = labels.where("toxic = 0 and pmod(crc32(cast(cast(doc_id as string) as binary)), 5) <> 0").count()
    assert np.isclose(score(docs.limit(1), clean).first().score, 1 / (n + 2))
    assert score(docs.limit(0), model).count() == 0
