import random

import numpy as np
import pytest

from orelode.llm import mixing, packing, tokens

KINDS = [("small", 100), ("large", 1000), ("none", 0), ("null", None)]


def packed(spark, docs, block_rows=100_000):
    d = spark.createDataFrame(docs, "doc_id long, n_tokens int").selectExpr("*", "'x' AS block", "1 AS size")
    k = spark.createDataFrame(KINDS, "container_kind string, capacity_tokens int").selectExpr("*", "9 AS n_tokens")
    return [tuple(r) for r in packing.pack(d, "doc_id", "n_tokens", k, block_rows).collect()]


def test_cutting_long_texts_changes_no_count(monkeypatch):
    rng = random.Random(3)
    whole = tokens.encoder(tokens.VOCABULARY)
    monkeypatch.setattr(tokens, "PIECE", 40)
    for _ in range(300):
        text = "".join(rng.choice(["ore ", "grade", "12", "3.5", "\n", "\n\n", "  ", "'s", "Übung", "矿山，", "x" * 30, "²", "-", " "]) for _ in range(60))
        assert tokens.count(text) == len(whole.encode_ordinary(text)), text


def test_nothing_is_lost_cut_or_overfilled(spark):
    rng = random.Random(4)
    docs = [(i, rng.choice([1, 5, 30, 51, 60, 100, 101, 250, 999, 1000, 1001, 2500])) for i in range(400)] + [(1000, None), (1001, 0), (None, 5), (7, 30)]
    for rows in (packed(spark, docs), packed(spark, docs, block_rows=50)):
        for kind, cap in KINDS[:2]:
            own = [r for r in rows if r[0] == kind]
            fill = {}
            for _, box, _, _, n in own:
                fill[box] = fill.get(box, 0) + n
            assert max(fill.values()) <= cap and sum(fill.values()) == sum(n for i, n in docs if n and i is not None)
            for i, n in {d for d in docs if d[1] and d[0] not in (None, 7)}:
                pieces = sorted((s, m) for _, _, d, s, m in own if d == i)
                assert [m for _, m in pieces] == ([n] if n <= cap else [cap] * (n // cap) + [n % cap] * (n % cap > 0)) and [s for s, _ in pieces] == [cap * j for j in range(len(pieces))]
        assert {r[0] for r in rows} == {"small", "large"}
    assert packed(spark, []) == []
    none = spark.createDataFrame([("none", 0)], "container_kind string, capacity_tokens int")
    assert packing.pack(spark.createDataFrame(docs, "doc_id long, n_tokens int"), "doc_id", "n_tokens", none).count() == 0


def test_little_room_is_left():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 512, 20_000)
    assert (packing.harmonic(sizes, 512).max() + 1) * 512 < 1.01 * sizes.sum()


def test_token_counts(spark):
    texts = ["", None, "Hello world", "word " * 60_000, "x" * 250_000, "émigré naïve 不"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "7 AS id")
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.with_counts(df, ["doc_id"]).collect()}
    enc = tokens.encoder(tokens.VOCABULARY)
    assert got[0] == got[1] == 0 and got[2] == len(enc.encode_ordinary("Hello world")) and got[3] == len(enc.encode_ordinary(texts[3])) and got[5] == len(enc.encode_ordinary(texts[5])) and got[4] > 0


TARGETS = [("m", "Site-Report", 0.6, 1), ("m", "lab_log", 0.3, 3), ("m", "tiny", 0.1, 5), ("n", "site_report", 0.5, 1), ("n", "absent", 0.5, 3)]


def mixed(spark, docs, **how):
    d = spark.createDataFrame(docs, "doc_id long, source string, n_tokens int").selectExpr("*", "'x' AS h", "1 AS prefix")
    t = spark.createDataFrame(TARGETS, "mix_name string, source string, target_share double, max_repeats int")
    rows, report = mixing.mix(d, t, **how)
    return rows.collect(), {(r["mix_name"], r["source"]): r for r in report.collect()}


def test_shares_hold_and_short_sources_are_reported(spark):
    rng = random.Random(8)
    docs = [(i, rng.choice(["site_report", " SITE-REPORT", "Site_Report"]), rng.randint(1, 40)) for i in range(3000)] + [(5000 + i, "lab_log", rng.randint(1, 40)) for i in range(800)] + [(9000 + i, "tiny", rng.randint(1, 40)) for i in range(50)]
    docs += [(20001, None, 5), (20002, "other", 5), (20003, "tiny", None), (20004, "tiny", 0)]
    rows, rep = mixed(spark, docs)
    size = sum(r["n_tokens"] * r["repeats"] for r in rows if r["mix_name"] == "m")
    for source, share, most in (("site_report", 0.6, 1), ("lab_log", 0.3, 3), ("tiny", 0.1, 5)):
        own = [r for r in rows if r["mix_name"] == "m" and r["source"] == source]
        assert max(r["repeats"] for r in own) <= most and abs(sum(r["n_tokens"] * r["repeats"] for r in own) - share * size) <= 80
        assert rep["m", source]["tokens"] == sum(r["n_tokens"] * r["repeats"] for r in own) and not rep["m", source]["short"]
    assert rep["n", "absent"]["tokens"] == 0 and rep["n", "absent"]["short"] and rep["n", "site_report"]["share"] == 1.0
    rows, rep = mixed(spark, docs, total=0, redistribute=True)
    assert rep["m", "tiny"]["short"] and rep["m", "tiny"]["most_repeats"] == 5
    assert {r["doc_id"] for r in rows}.isdisjoint({20001, 20002, 20003, 20004})


def test_thresholds_are_exact_and_nested(spark):
    rng = random.Random(3)
    docs = [(i, "site_report", rng.randint(1, 9)) for i in range(2000)]
    few, _ = mixed(spark, docs, total=1000)
    many, _ = mixed(spark, docs, total=4000)
    a = {r["doc_id"] for r in few if r["mix_name"] == "m"}
    b = {r["doc_id"] for r in many if r["mix_name"] == "m"}
    assert a < b and 600 - 9 < sum(n for i, _, n in docs if i in a) <= 600 and 2400 - 9 < sum(n for i, _, n in docs if i in b) <= 2400


@pytest.mark.parametrize("docs", [[], [(1, "site_report", 5)], [(1, "site_report", 5), (1, "site_report", 5)]])
def test_tiny_inputs(spark, docs):
    rows, rep = mixed(spark, docs)
    assert len(rep) == 5 and all(r["repeats"] == 1 for r in rows)
