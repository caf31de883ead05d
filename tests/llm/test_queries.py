import os

import pytest
from pyspark.sql import functions as F

from oracle import compare, connect
from orelode.llm import queries, terms
from orelode.plans.runtime import table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


def rows(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    assert len(set(df.columns)) == len(df.columns)
    return df.toPandas()


def unique(df, *columns):
    return len(df) and not df.duplicated(list(columns)).any()


@pytest.mark.parametrize("name,a,b", [("p1_found", "name_a", "name_b"), ("p5_found", "facility_id_a", "facility_id_b")])
def test_pairs_are_ordered_and_come_once(spark, name, a, b):
    got = rows(spark, name)
    assert unique(got, a, b) and (got[a] < got[b]).all()


@pytest.mark.parametrize("pairs,groups,ids,group", [("p1_found", "p1_entities", "name", "entity"), ("p5_found", "p5_groups", "facility_id", "site_id")])
def test_pairs_are_those_of_the_groups(spark, pairs, groups, ids, group):
    got = rows(spark, groups)
    sizes = got.groupby(group)[ids].count()
    assert unique(got, ids) and (sizes > 1).all() and (sizes * (sizes - 1) // 2).sum() == len(rows(spark, pairs))
    assert (got.groupby(group)[ids].min() == sizes.index).all()


def test_values_meet_entries_or_are_unmatched(spark):
    got, term = rows(spark, "p3_found"), table(spark, FOLDER, "canonical_term").toPandas()
    known = set(zip(term["field_name"], term["canonical"]))
    assert unique(got, "rec_id", "field_name", "pos") and all(c == terms.UNMATCHED or (f, c) in known for f, c in zip(got["field_name"], got["canonical"]))
    unmatched = rows(spark, "p3_unmatched")
    assert unmatched["rows"].sum() == (got["canonical"] == terms.UNMATCHED).sum()


def test_merged_records_take_the_surviving_values(spark):
    won, merged = rows(spark, "p4_found"), rows(spark, "p4_merged")
    assert unique(won, "facility_id", "field_name") and unique(merged, "facility_id")
    many = set(merged.loc[merged["n_rows"] > 1, "facility_id"])
    assert set(won["facility_id"]) <= many
    first = won[won["field_name"] == "aliases"].iloc[0]
    (value,) = table(spark, FOLDER, "facility").where(F.col("rec_id") == int(first["rec_id"])).select(F.to_json("aliases")).first()
    assert merged.set_index("facility_id").loc[first["facility_id"], "aliases"] == value


def test_containers_hold_every_token_once_and_no_more_than_fits(spark):
    got = rows(spark, "p8_containers")
    room = {r["container_kind"]: r["capacity_tokens"] for r in table(spark, FOLDER, "container_spec").collect()}
    full = got.groupby(["container_kind", "container_id"])["n_tokens"].sum().reset_index()
    assert (full["n_tokens"] <= full["container_kind"].map(room)).all()
    totals = got.groupby("container_kind")["n_tokens"].sum()
    assert totals.nunique() == 1 and set(totals.index) == {k for k, c in room.items() if c and c > 0}
    fill = rows(spark, "p8_fill").set_index("container_kind")
    assert (fill["tokens"].reindex(totals.index) == totals).all() and (fill["used"] <= 1).all()


def test_mixes_respect_repeats_and_report_what_they_hold(spark):
    got, shares = rows(spark, "p9_mix"), rows(spark, "p9_shares")
    assert unique(got, "mix_name", "doc_id") and (shares["most_repeats"] <= shares["max_repeats"]).all()
    held = (got["n_tokens"] * got["repeats"]).groupby([got["mix_name"], got["source"]]).sum()
    assert all(held.get((r.mix_name, r.source), 0) == r.tokens for r in shares.itertuples())
    once = rows(spark, "p9_shares_once")
    assert (once.groupby("mix_name")["share"].sum() <= 1.0001).all()


def test_every_document_has_a_score_and_every_source_a_rate(spark):
    scores, rates = rows(spark, "p10_scores"), rows(spark, "p10_rates")
    n = table(spark, FOLDER, "documents").count()
    assert len(scores) == n == rates["documents"].sum() and scores["score"].between(0, 1).all()
    assert set(rows(spark, "p10_found")["doc_id"]) == set(scores.loc[scores["toxic"], "doc_id"]) and rates["toxic"].sum() == scores["toxic"].sum()
    assert (scores.loc[scores["toxic"], "n_spans"] > 0).all()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, name):
    assert compare(spark, connect(FOLDER), FOLDER, name, queries.QUERIES[name], queries.ORACLES[name]) == ""
