import itertools
import random

import pytest

from orelode.llm.components import components
from orelode.llm.names import collapsed, edits, name_links, name_pairs, parsed
from orelode.llm.near import near_parts
from orelode.llm.strings import damerau, squash


@pytest.mark.parametrize(
    "a,b",
    [
        ("Histeth Chikrosadro Resources LLC", "HISTETH-CHIKOSADRO RES. L.L.C."), ("Histeth Chikrosadro Resources LLC", "Chikrosadro Histeth Rsrcs LLC"), ("Histeth Chikrosadro Resources LLC", "H. Chikrosadro Resources LLC et al."),
        ("Mitrugogle & Fotos Copper GmbH", "The Fotos Mitrugogle Copper GmbH (51%)"), ("Sukradome Coal S.A.", "sucradome coal Sociedad Anónima"), ("Trofur Zolutragu Gold Mines LLC", "Trofurzolutagu Gold Mines"), ("Tizith Trahuvasi Coal plc", "Trahuwasitizith Coal plc"), ("Drubastitra Iron plc", "Drubasttra Iron plc (NBI)"), ("Robert Kigustitra", "Kigustitra, Rob"),
        ("Robert Kigustitra", "Mr R.H. Kigoustitra"), ("José Drolalito", "Pepe Drolalyto"), ("Krestal Kenidramu International LLC", "Int'l Krestal Kenidramu LLC"),
    ],
)
def test_variants_link(spark, a, b):
    df = spark.createDataFrame([(a,), (a,), (b,)], "name string")
    assert [set(r) for r in name_pairs(df).collect()] == [{a, b}]


def test_affiliates_relatives_and_placeholders_stay_apart(spark):
    names = ["Sukradome Coal S.A.", "Sukradome Copper S.A.", "Sukradome S.A.", "Robert Kigustitra", "Katarzyna Kigustitra", "Vatik Rashashosu Lithium Inc", "Vatik Rashashosu Lithium LLC", "Unknown", "unknown", "-", "", None, "n/a", "N/A", "(?)", "...", "J. Shebavogi"]
    df = spark.createDataFrame([(n, "x", 1) for n in names for _ in (0, 1)], "name string, hub string, n int")
    assert name_pairs(df).count() == 0


def test_long_names_repeats_and_empty(spark):
    long = "Zovoglama" * 5000 + " Mining Ltd"
    df = spark.createDataFrame([(long,), (long + ".",), ("x" * 100_000,)], "name string")
    assert [sorted(r) for r in name_pairs(df).collect()] == [sorted((long, long + "."))]
    assert name_pairs(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "a,b",
    [
        ("Alpha Brava Carlita Delton Mining Ltd", "Alpha Brava Carlita Delton Mining Limited"), ("Alpha Brava Carlita Delton Mining Ltd", "Brava Alpha Delton Carlita Mng Ltd"), ("Alpha Brava Carlita Delton Mining Ltd", "Alpha Brava Carlitta Delton Mining"),
        ("J. R. Zmithkova Mining Ltd", "J R Zmithkova Mining Limited"), ("Kora " * 40 + "Vasti Copper plc", "Vasti " + "Kora " * 40 + "Copper plc"), ("Zovogla" * 6 + " Copper plc", "Zovogla" * 5 + "Zovohla Copper plc"),
    ],
)
def test_names_of_any_number_and_length_of_words(spark, a, b):
    df = spark.createDataFrame([(a,), (a,), (b,), ("Alpha Brava Dorinta Vexel Mining Ltd",)], "name string")
    assert [set(r) for r in name_pairs(df).collect()] == [{a, b}]


def test_names_far_from_the_hub_meet_each_other(spark):
    # all share a form with the commonest name, which is near none of them
    df = spark.createDataFrame([("Tramu Barolina Mining Ltd",)] * 9 + [("Tramu Bexitofu Mining Ltd",), ("Tramu Bexitofo Mining Ltd",)], "name string")
    assert [sorted(r) for r in name_pairs(df).collect()] == [["Tramu Bexitofo Mining Ltd", "Tramu Bexitofu Mining Ltd"]]


def test_the_score_decides_where_a_line_of_business_is_left_open(spark):
    sure = [("Sukradome Coal",)] * 3 + [("Sukradame Copper",)] * 3 + [(f"Sukrad{c}me Copper",) for c in "eiuy"] + [("Sukradome",)]
    pairs = {tuple(r) for r in name_pairs(spark.createDataFrame(sure, "name string")).collect()}
    assert ("Sukradome", "Sukradome Coal") in pairs and not any("Copper" in a and "Coal" in b or "Coal" in a and "Copper" in b for a, b in pairs)
    torn = [("Sukradome Coal",), ("Sukradome Copper",), ("Sukradome",)]
    assert name_pairs(spark.createDataFrame(torn, "name string")).count() == 0


def test_links_grow_with_names_not_with_pairs(spark):
    core = "Kochubahe"
    variants = {f"Tramu {core[:i]}{c}{core[i:]} Mining Ltd" for i in range(1, 9) for c in "aeiou"}
    df = spark.createDataFrame([("Tramu Kochubahe Mining Ltd",)] * 9 + [(v,) for v in variants], "name string")
    assert name_links(df).count() < 12 * len(variants)
    n = len(variants) + 1
    assert name_pairs(df).count() == n * (n - 1) // 2


def test_components_against_union_find(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 200), (None, 3), (5, 5)]
    got = {}
    for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect():
        got.setdefault(r["component"], set()).add(r["node"])
    assert sorted(map(sorted, got.values())) == [[*range(41), 200], [100, 101, 102]]


def test_distance_is_the_true_one():
    def brute(a, b):  # breadth-first over edits
        seen, level, d = {a}, {a}, 0
        while b not in level:
            d += 1
            level = {v for w in level for v in [w[:i] + w[i + 1 :] for i in range(len(w))] + [w[:i] + c + w[i:] for i in range(len(w) + 1) for c in "abc"] + [w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in "abc"] + [w[:i] + w[i + 1] + w[i] + w[i + 2 :] for i in range(len(w) - 1)]} - seen
            seen |= level
        return d

    for a, b in itertools.product(["", "a", "ab", "ca", "abc", "bca", "aacb"], repeat=2):
        assert damerau(a, b) == brute(a, b), (a, b)


def test_parsing():
    assert parsed("Shovishegli  & Musi Min. Sands Company") == ("c", "mineral sands", ["shovishegli", "musi"], "co")
    assert parsed("D.K. Kobratroda")[:2] == ("p", "d.")
    assert parsed("G. Mines Teten Didrurubri Public Limited Company")[1:] == ("gold mines", ["teten", "didrurubri"], "plc")
    assert [parsed(f"Sukradome Coal {x}")[3] for x in ("S.A.", "Sociedad Anónima", "Pty. Limited", "L.L.C.", "")] == ["sa", "sa", "pty", "llc", ""]


def _changed(rnd, word: str, most: int) -> str:
    letters = list(word)
    for _ in range(rnd.randint(0, most)):
        at, how = rnd.randrange(len(letters)), rnd.randrange(4)
        if how == 0:
            letters.insert(at, rnd.choice("abkr"))
        elif how == 1 and len(letters) > 2:
            del letters[at]
        elif how == 2:
            letters[at] = rnd.choice("abkr")
        elif at + 1 < len(letters):
            letters[at], letters[at + 1] = letters[at + 1], letters[at]
    return "".join(letters)


def _readings(rnd, n: int) -> list[tuple[str, ...]]:
    found = set()
    while len(found) < n:
        words = [_changed(rnd, rnd.choice(["tramu", "kochubahe", "bor", "zutra", "histethikor", "kora" * 9]), 2) for _ in range(rnd.choice([1, 2, 2, 3, 4]))]
        kind = rnd.randrange(6)
        words = [words[0][0], *words[1:]] if kind == 0 else ["".join(words)] if kind == 1 else words
        found.add(tuple(words))
    return sorted(found)


@pytest.mark.parametrize("kind", "cp")
def test_near_readings_against_all_pairs(kind):
    parts = _readings(random.Random(2), 400) if kind == "c" else sorted({(_changed(random.Random(i), "kigustitra"[: 5 + i % 6], 3),) for i in range(150)})
    near = lambda i, j: edits(kind, list(parts[i]), list(parts[j])) is not None
    want = {(i, j) for i, j in itertools.combinations(range(len(parts)), 2) if near(i, j)}
    assert {(i, j) for i, j in near_parts(kind, parts, collapsed, squash, [True] * len(parts)) if near(i, j)} == want and len(want) > 100


def test_every_near_pair_is_of_one_entity(spark):
    rnd = random.Random(5)
    base = ["Tramu Kochubahe", "Histethikor", "Bor Zutra", "Drubastitra Vexelo", "Alpha Brava Carlita"]
    names = sorted({" ".join(_changed(rnd, w, 2) for w in rnd.choice(base).split()).title() + " Coal Ltd" for _ in range(150)})
    read = {n: parsed(n) for n in names}
    near = lambda a, b: read[a][1] == read[b][1] and edits("c", read[a][2], read[b][2]) is not None
    want = {(a, b) for a, b in itertools.combinations(names, 2) if near(a, b)}
    got = {tuple(r) for r in name_pairs(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    assert want <= got and len(want) > 300


@pytest.mark.parametrize(
    "a,b",
    [("Drubastitra Iron plc", "Trubostidra Iron plc"), ("Kochubahe Tramu Coal Ltd", "Rochubahe Bramu Coal Ltd"), ("Trofur Zolutragu Zinc LLC", "Trofurzolutaku Zinc LLC"), ("Robert Kigus", "Robert Kagos"), ("X Coal Ltd", "X Coal Limited")],
)
def test_the_farthest_variants_link(spark, a, b):
    assert [set(r) for r in name_pairs(spark.createDataFrame([(a,), (b,)], "name string")).collect()] == [{a, b}]


def test_names_without_a_form_bring_no_two_forms_together(spark):
    names = ["Drubastitra Iron LLC", "Drubastidra Iron", "Grubosdidra Iron GmbH", "X Iron LLC", "Xerubas Iron LLC"]
    got = {tuple(r) for r in name_pairs(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    assert got == {("Drubastidra Iron", "Drubastitra Iron LLC")}
