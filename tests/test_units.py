import pytest
from pyspark.sql import functions as F

from orelode.functions.units import number_readings, number_text, readings
from orelode.operators.units import canonical_values, least_residual, milli

REF = [
    ("mass_rate", "tpa", "t/a", 1.0, 0.0), ("mass_rate", "tpa", "kt/a", 1e3, 0.0), ("mass_rate", "tpa", "Mt/a", 1e6, 0.0), ("mass_rate", "tpa", "t/d", 365.0, 0.0), ("temperature", "degC", "degF", 0.555555555555556, -17.7777777777778),
    ("temperature", "degC", "K", 1.0, -273.15), ("length", "m", "m", 1.0, 0.0), ("length", "m", "ft", 0.3048, 0.0), ("water_flow", "m3/d", "us_gal/min", 5.45099296896, 0.0), ("grade", "g/t", "troy_oz/short_ton", 34.285714285714, 0.0),
]


@pytest.mark.parametrize(
    "text,code,scale",
    [
        ("MT per annum (metric tons)", "t/a", 1), ("thousand tonnes per year", "t/a", 1e3), ("'000 t/yr", "t/a", 1e3), ("Mtpa", "Mt/a", 1), ("ktpa", "kt/a", 1), ("mtpd (metric tons per day)", "t/d", 1), ("toneladas/año", "t/a", 1), ("t p.a.", "t/a", 1),
        ("koz pa", "koz/a", 1), ("thousand ounces a year", "troy_oz/a", 1e3), ("gpm (US)", "us_gal/min", 1), ("US gallons per minute", "us_gal/min", 1), ("opt (oz/short ton)", "troy_oz/short_ton", 1), ("bar(g)", "bar", 1), ("'", "ft", 1),
        ("gr/ton métrica", "g/t", 1), ("cu.m/day", "m3/d", 1), ("m³/hr", "m3/h", 1), ("mega watt", "MW", 1), ("lb/sq in", "psi", 1), ("per cent", "percent", 1), ("hm3", "Mm3", 1), ("square miles", "mi2", 1), ("deg F", "degF", 1),
    ],
)
def test_spellings(text, code, scale):
    assert readings(text)[0] == (scale, code)


def test_spellings_of_nothing():
    assert readings("") == () and readings("see annex") == () and readings("x" * 10_000) == ()


NUMBERS = {
    "1.9552E+8 bbl": [195520000.0], "6.4664 x 10^7": [64664000.0], "94 960 yards": [94960.0], "1'223.4": [1223.4], "6.147,9": [6147.9], "1,400,000": [1400000.0], "68,2deg F": [68.2], "0,064": [0.064], "4,163": [4163.0, 4.163],
    "10.355": [10.355], "rock temperature of 178 Fahrenheit (2024 report)": [178.0], "~1.21e6": [1210000.0], "101": [101.0], "c. 117000": [117000.0], "n/a": [], "5 078": [5078.0], "-12 C": [-12.0],
}


def test_numbers(spark):
    df = spark.createDataFrame([(k,) for k in NUMBERS], "t string")
    got = {r["t"]: [x["value"] for x in r["n"]] for r in df.select("t", number_readings(number_text(F.col("t"))[0]).alias("n")).collect()}
    for k, want in NUMBERS.items():
        assert got[k] == pytest.approx(want), k


def tables(spark, rows):
    r = spark.createDataFrame(rows, "result_id string, facility_key string, json_id string, as_of_date date, value_canonical double, value_raw string, raw_unit string")
    m = spark.createDataFrame([("cap", "mass_rate", "tpa"), ("temp", "temperature", "degC"), ("len", "length", "m"), ("status", None, None)], "json_id string, quantity string, unit_canonical string")
    return r.selectExpr("*", "'clash' AS quantity", "1.0 AS factor"), m.selectExpr("*", "'clash' AS value_raw"), spark.createDataFrame(REF, "quantity string, unit_canonical string, unit_code string, factor double, shift double")


def test_conversion_and_defined_cases(spark):
    rows = [
        ("a", "f", "cap", None, None, "14", "t/d"), ("b", "f", "cap", None, None, "7.7k tonnes per year", None), ("c", "f", "temp", None, None, "roughly 197.5 °F", None), ("d", "f", "cap", None, None, "4796", None), ("e", "f", "temp", None, None, "1623", "MWe"),
        ("f", "f", "status", None, None, "5 t/d", None), ("g", "f", "cap", None, None, None, "t/d"), ("h", "f", "len", None, None, "94 960", "feet"), ("i", "f", "cap", None, None, "2.914M tonnes per year", " tonnes per year "), ("i", "f", "cap", None, None, "2.914M tonnes per year", None),
        (None, None, "len", None, None, "3 ft", None), ("j", "f", "len", None, None, "9" * 400, "ft"), ("k", "f", "len", None, None, "x" * 200_000 + " 5 ft", None), ("l", "f", "len", None, None, "", ""),
    ]
    got = milli(canonical_values(*tables(spark, rows))).collect()
    values = {r["result_id"]: r["value_milli"] for r in got}
    assert values == {"a": 5110000, "b": 7700000, "c": 91944, "h": 28943808, "i": 2914000000, None: 914, "k": 1524}
    assert len(got) == 8  # repeated rows each


def test_identities_decide_between_readings(spark):
    rows = [
        ("filed", "f", "len", None, 4.163, "4,163", "m"), ("free", "g", "len", None, None, "4,163", "m"), ("peer", "h", "len", None, None, "4,163", "m"), ("peer2", "h", "len", None, None, "4.2", "m"),
    ]
    import datetime

    rows = [(a, b, c, datetime.date(2024, 1, 1), e, f, g) for a, b, c, _, e, f, g in rows]
    got = {r["result_id"]: (r["value"], r["unique"]) for r in canonical_values(*tables(spark, rows)).collect()}
    assert got["filed"] == (4.163, True) and got["peer"] == (4.163, True) and got["free"] == (4163.0, False)


def test_a_wrong_unit_column_is_overruled_and_contradictions_are_flagged(spark):
    import datetime

    day = datetime.date(2024, 1, 1)
    rows = [
        ("wrong", "f", "cap", day, 4200.0, "4.2 kt per year", "t/a"), ("kept", "g", "cap", day, None, "4.2 kt per year", "t/a"), ("off", "h", "cap", day, 5000.0, "5", "t/a"),
        ("p1", "i", "len", day, None, "100", "m"), ("p2", "i", "len", day, None, "101 m", None), ("p3", "i", "len", day, None, "90000", "m"), ("alone", "j", "len", day, None, "7", "m"),
    ]
    got = {r["result_id"]: r for r in canonical_values(*tables(spark, rows)).collect()}
    assert (got["wrong"]["value"], got["wrong"]["contradicted"]) == (4200.0, False)
    assert (got["kept"]["value"], got["kept"]["unique"]) == (4.2, False)  # the column counts, but nothing confirms it
    assert got["off"]["value"] == 5.0 and got["off"]["contradicted"] and got["p3"]["contradicted"]
    assert not got["alone"]["contradicted"] and got["alone"]["residual"] == 0.0


def test_mass_density_volume(spark):
    of = lambda *v: [(x, i) for i, x in enumerate(v)]
    schema = ", ".join(f"{c} array<struct<value:double,rank:int>>" for c in ("mass", "density", "volume"))
    df = spark.createDataFrame([(of(2.7e6, 2.7e9), of(2.7, 2700.0), of(1e6)), (of(5.0, 7.0), [], of(1.0)), (None, None, None)], schema)
    got = [r["chosen"] for r in least_residual(df, ["mass", "density", "volume"], [{"mass": 1, "density": -1, "volume": -1}]).collect()]
    assert (got[0]["mass"], got[0]["density"], got[0]["unique"]) == (2.7e6, 2.7, False)  # tonnes and t/m3 fit as well as kg and kg/m3
    assert got[1]["mass"] == 5.0 and not got[1]["unique"] and got[2]["mass"] is None


def test_empty(spark):
    assert canonical_values(*tables(spark, [])).count() == 0
