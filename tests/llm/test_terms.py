import random

from orelode.llm.strings import damerau
from orelode.llm.terms import BKTree, entries, map_records, map_values, most_edits

TERMS = [(1, "commodity", "copper", "Cu"), (2, "commodity", "iron", "Fe"), (3, "commodity", "rare earths", "REE"), (4, "type", "mine", None), (5, "type", "steel_plant", None), (6, "status", "closed", None), (7, "status", "unknown", None)]


def test_tree_returns_every_entry_within_the_threshold():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(3, 9))) for _ in range(400)]
    items = [(w, 0, i, w) for i, w in enumerate(dict.fromkeys(words))]
    tree = BKTree(items)
    for _ in range(60):
        q = "".join(rng.choice("abcd") for _ in range(rng.randint(2, 9)))
        assert {t for *_, t in tree.within(q, 2)} == {w for w, *_ in items if damerau(q, w) <= 2}


def mapped(spark, pairs, shard_rows=20_000):
    terms = spark.createDataFrame(TERMS, "term_id long, field_name string, canonical string, symbol string")
    values = spark.createDataFrame(pairs, "field_name string, raw string")
    return {(r["field_name"], r["raw"]): r["canonical"] for r in map_values(values, terms, shard_rows).collect()}


CASES = {
    ("commodity", "Cu"): "copper", ("commodity", " COPPER ore"): "copper", ("commodity", "Cooppwr ore"): "copper", ("commodity", "cobre"): "copper", ("commodity", "Iron (Fe)"): "iron", ("commodity", "Fe - iron"): "iron", ("commodity", "RED METAL (CU)"): "copper",
    ("commodity", "terres rares"): "rare earths", ("commodity", "timber"): "unmatched", ("commodity", "16.797"): "unmatched", ("commodity", "row 14"): "unmatched", ("commodity", "x" * 500_000): "unmatched", ("type", "mne"): "mine", ("type", "Steel Plant"): "steel_plant",
    ("type", "colliery"): "mine", ("type", "school"): "unmatched", ("status", "Closed 1998"): "closed", ("status", "#REF!"): "unmatched", ("status", "npt nown"): "unknown", ("other", "copper"): "unmatched",
}


def test_values(spark):
    assert mapped(spark, list(CASES)) == CASES


def test_shards_agree_with_one_tree(spark):
    assert mapped(spark, list(CASES), shard_rows=2) == CASES


def test_a_term_beats_a_synonym_of_another_shard(spark):
    # galena is a synonym of lead and here a term of its own; Pb is a symbol and a term's text
    terms = [(1, "commodity", "lead", "Pb"), (2, "commodity", "galena", None), (3, "commodity", "pb", None), (4, "commodity", "silver", "Pb")]
    terms = spark.createDataFrame(terms, "term_id long, field_name string, canonical string, symbol string")
    values = spark.createDataFrame([("commodity", w) for w in ("Galena", "plomb", "PB", "galeena", "plomo ore")], "field_name string, raw string")
    for shard_rows in (100, 2, 1):
        got = {r["raw"]: r["canonical"] for r in map_values(values, terms, shard_rows).collect()}
        assert got == {"Galena": "galena", "plomb": "lead", "PB": "pb", "galeena": "galena", "plomo ore": "lead"}, shard_rows


def test_distance_of_very_long_texts():
    a = "ab" * 50_000
    assert damerau(a, a[:-1] + "c", 3) == 1 and damerau("x" + a, a + "y", 3) == 2 and damerau(a, "ba" * 50_000, 1) == 2


def test_records_with_nulls_blanks_and_exact_entries(spark):
    terms = spark.createDataFrame(TERMS, "term_id long, field_name string, canonical string, symbol string").selectExpr("*", "'x' AS raw", "1 AS slot")
    rows = [(1, [("copper", True), (None, False), (" ", False), ("CU", False), ("CU", False)], ["mine", None, "Mine"], "closed"), (2, None, None, None), (3, [], [], ""), (4, None, ["pit"], "Shut down")]
    f = spark.createDataFrame(rows, "rec_id long, commodities array<struct<metal:string,is_primary:boolean>>, types array<string>, status string").selectExpr("*", "'y' AS canonical", "'z' AS pos")
    got = {(r["rec_id"], r["field_name"], r["pos"], r["canonical"]) for r in map_records(f, terms).collect()}
    assert got == {(1, "commodity", 3, "copper"), (1, "commodity", 4, "copper"), (1, "type", 2, "mine"), (4, "type", 0, "mine"), (4, "status", 0, "closed")}
    assert map_records(f.limit(0), terms).count() == 0


def test_thresholds_and_compounds():
    assert [most_edits(n) for n in (3, 4, 7, 10)] == [0, 1, 2, 3]
    assert ("galena lead", 2, 9, "lead") in entries("commodity", [(9, "lead", "Pb")])
