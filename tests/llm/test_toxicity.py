import os

import numpy as np
import pytest

from orelode.llm import toxicity as T
from orelode.llm.examples import CLEAN, MARKED, TOXIC


def scores(model, texts):
    return [max([0.0, *(T.sentence_score(p) for p in model.marginals(T.chains(t)))]) if t and T.chains(t) else 0.0 for t in texts]


@pytest.fixture(scope="module")
def model():
    return T.train([], (TOXIC, CLEAN), MARKED)


@pytest.mark.parametrize("raw,word", [("fu​ck", "fuck"), ("f.u.c.k", "fuck"), ("s h i t h e a d", "shithead"), ("1d1ot", "idiot"), ("fuuuuck", "fuck"), ("idiоt", "idiot"), ("f*ck", "fuck"), ("a-s-s-h-o-l-e", "asshole"), ("id#ot", "idiot")])
def test_disguises(raw, word):
    (chain,) = T.chains(f"you {raw} there")
    assert chain[1][0].rstrip("~") == word and chain[1][1] & (T.I_ | T.P_)


def test_ordinary_words_and_names_are_no_misspelt_insults():
    for text in ("the slope cuts the shaft", "Mamek Mozasotru Holdings", "La empresa Moror Chekrozazu", "where the whole shift sat"):
        assert not any(t[1] & (T.I_ | T.P_ | T.S_) for c in T.chains(text) for t in c), text


def test_held_out_examples():
    fold = lambda xs, k: ([x for i, x in enumerate(xs) if i % 4 != k], [x for i, x in enumerate(xs) if i % 4 == k])
    right = []
    for k in range(4):
        (a, b), (c, d) = fold(TOXIC, k), fold(CLEAN, k)
        m = T.train([], (a, c))
        right += [s > 0.5 for s in scores(m, b)] + [s <= 0.5 for s in scores(m, d)]
    assert np.mean(right) > 0.7


def test_spans_leave_out_the_clean_half(model):
    # none of these is an example; the offending words are the ones in brackets
    texts = [
        "The furnace was relined in June, [[you brainless moron]].", "[[Shut up, you fucking idiot]], the tonnage for May is in the table.", "The drill crew reached level nine and [[your boss is a lying bastard]].",
        "The trucks queue at the weighbridge every morning, [[asshole]].", "[[You are a worthless cretin]], and the core boxes are stored in the shed.",
    ]
    inside, outside = [], []
    for text in texts:
        for c, gold in T.labelled(text):
            for p, y in zip(model.marginals([c])[0], gold):
                (inside if y else outside).append(p)
    assert np.mean(np.array(inside) > 0.5) > 0.8 and np.mean(np.array(outside) > 0.5) < 0.15


def test_labels_of_marked_parts():
    ((chain, gold),) = T.labelled("The pump, [[you idiot]], runs.")
    assert [t[0] for t, y in zip(chain, gold) if y] == ["you", "idiot"] and len(gold) == 5


def test_forward_backward_against_enumeration():
    import itertools

    m = T.Model()
    m.table[:] = np.random.default_rng(0).normal(0, 1, len(m.table))
    (chain,) = T.chains("you are a very dull crew")
    ids, sent, place = T.features([chain])
    em = m.table[ids].sum(1) + m.bias
    total, hot = 0.0, np.zeros(len(chain))
    for labels in itertools.product((0, 1), repeat=len(chain)):
        w = np.exp(sum(e for e, y in zip(em, labels) if y) + sum(m.trans[a, b] for a, b in zip(labels, labels[1:])))
        total += w
        hot += w * np.array(labels)
    assert np.allclose(m.marginals([chain, chain[:2]])[0], hot / total, atol=1e-4)


def test_documents_with_every_defect(spark, model):
    texts = [None, "", "  ", "The pump runs. Shut up, you fucking idiot! The pit is dry.", "a" * 1_000_000, "gravel " * 100_000, "\n\n...", "The pump runs."]
    d = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)] * 2, "doc_id long, text string, source string").selectExpr("*", "1 AS score", "'x' AS spans")
    labels = spark.createDataFrame([(3, 1), (3, None), (7, 0), (99, 1)], "doc_id long, toxic int")
    got = T.score_documents(d, labels, ["doc_id", "source"]).collect()
    assert len(got) == 16
    by = {r["doc_id"]: r for r in got}
    assert [i for i in by if by[i]["toxic"]] == [3] and by[0]["score"] == by[1]["score"] == 0
    (span,) = by[3]["spans"]
    assert "idiot" in texts[3][span["start"] : span["end"]] and "pump" not in texts[3][span["start"] : span["end"]]
    assert T.score_documents(d.limit(0), labels.limit(0), ["doc_id"]).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no tables")
def test_held_out_judgements(spark):
    d, l = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "doc_label"))
    rows = T.judged_sample(d, l)
    train, test = rows[::2], [r for r in rows[1::2] if r[1] in (0.0, 1.0)]
    m = T.train(train, (TOXIC, CLEAN))
    agree = [(s > 0.5) == (y == 1.0) for s, (_, y) in zip(scores(m, [t for t, _ in test]), test)]
    assert np.mean(agree) > 0.85  # annotators err too


def test_sample_is_bounded(spark):
    d = spark.range(50).selectExpr("id AS doc_id", "concat('t', id) AS text")
    labels = spark.range(50).selectExpr("id AS doc_id", "1 AS toxic")
    assert len(T.judged_sample(d, labels, most=10)) == 10
