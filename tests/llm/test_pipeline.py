"""Every stage of the corpus pipeline against plain code or SQL, on all rows of the smallest
tables."""

import numpy as np
import pytest

import corpus_pipeline as cp
from conftest import SF0001
from oracle_compare import duck
from test_bin_sketch import _brute
from test_hashed_ftrl import plain_ftrl
from txengine.llm import quality_votes, soft_mixing
from txengine.llm.common import table, words
from txengine.llm.edit_pieces import EditOptions, normalised
from txengine.llm.hashed_ftrl import FtrlOptions, Hasher


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage, the input first."""
    out = [table(spark, SF0001, "documents")]
    for _, f in cp.STAGES:
        out.append(f(spark, out[-1], SF0001).cache())
    return out


def test_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["quality", "toxicity", "near_duplicates", "decontamination", "mixing"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert stages[-1].count() == stages[-2].count()


def test_quality(stages):
    """The operator's SQL with the posterior alone."""
    sql = quality_votes.OP6_SQL.replace(f"NOT {quality_votes.BASE_FAILED} AND ", "")
    assert sql != quality_votes.OP6_SQL
    rel = duck(SF0001).sql(sql)
    want = {r[0] for r in rel.fetchall() if r[rel.columns.index("kept")]}
    assert {r.doc_id for r in stages[1].collect()} == want


def test_toxicity(spark, stages):
    text = {r.doc_id: r.text for r in stages[0].collect()}
    toxic = {r.doc_id: r.toxic for r in table(spark, SF0001, "labels").where("toxic is not null").collect()}
    score = plain_ftrl(text, toxic, FtrlOptions())
    assert {r.doc_id for r in stages[2].collect()} == {r.doc_id for r in stages[1].collect() if score(r.text) < 0.5}


def test_near_duplicates(stages):
    rows = stages[2].collect()
    want = _brute([r.doc_id for r in rows], [r.text for r in rows], 5)
    assert {r.doc_id for r in stages[3].collect()} == {i for i, (_, c) in want.items() if i == c}


def _distances(items, text):
    """Of each item the smallest edit distance to any part of the text, by full tables of all
    items side by side."""
    wide = max(map(len, items))
    chars = np.array([[ord(c) for c in i] + [0] * (wide - len(i)) for i in items])
    rising = np.arange(wide + 1)
    col = np.tile(rising, (len(items), 1))
    last = np.array([len(i) for i in items])[:, None]
    best = last[:, 0].copy()
    for c in text:
        new = np.zeros_like(col)
        new[:, 1:] = np.minimum(col[:, 1:] + 1, col[:, :-1] + (chars != ord(c)))
        col = np.minimum.accumulate(new - rising, axis=1) + rising
        best = np.minimum(best, np.take_along_axis(col, last, 1)[:, 0])
    return best


def test_decontamination(spark, stages):
    items = [t for r in table(spark, SF0001, "benchmark").collect() if (t := normalised(r.text))]
    budget = np.array([EditOptions().budget(i) for i in items])
    want = {r.doc_id for r in stages[3].collect() if (_distances(items, normalised(r.text)) > budget).all()}
    assert {r.doc_id for r in stages[4].collect()} == want


def test_mixing(spark, stages):
    """Posteriors from the model's weights; rates that meet the targets and are, among all that do,
    nearest to 1: there is one pull with rate = max(0, 1 - p . pull)."""
    names = list(cp.MIX.weights)
    labels = table(spark, SF0001, "labels").select("doc_id", soft_mixing.domain_of_labels().alias("domain"))
    model = soft_mixing.fit_domains(stages[0], labels, cp.MIX)
    text = {r.doc_id: r.text for r in stages[4].collect()}
    rows = stages[5].collect()
    hasher, weight = Hasher(cp.MIX.learner), [dict(zip(a.tolist(), w.tolist())) for a, w in zip(model.linear.at, model.linear.weights)]
    for r in rows:
        at = hasher.distinct(text[r.doc_id]).tolist()
        odds = [sum(w.get(f, 0.0) for f in at) + b for w, b in zip(weight, model.linear.intercepts)]
        e = np.exp([model.slope * min(30, max(-30, o)) + s for o, s in zip(odds, model.shift)])
        assert np.allclose([r[f"p_{x}"] for x in names], e / e.sum(), rtol=1e-6)
        assert r.n_tokens == len(words(text[r.doc_id])) and abs(r.copies - r.rate) < 1
    p = np.array([[r[f"p_{x}"] for x in names] for r in rows])
    n, rate = np.array([r.n_tokens for r in rows]), np.array([r.rate for r in rows])
    share = (rate * n) @ p / n.sum()
    assert np.allclose(share, list(cp.MIX.weights.values()), rtol=2e-3) and rows[0].target_gap <= cp.MIX.tolerance
    assert not np.allclose(n @ p / n.sum(), list(cp.MIX.weights.values()), rtol=0.1)  # it had to mix
    pull = np.linalg.lstsq(p[rate > 0], 1 - rate[rate > 0], rcond=None)[0]
    assert np.allclose(np.maximum(0, 1 - p @ pull), rate, atol=1e-6)
