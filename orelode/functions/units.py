"""Numbers and units as people type them.

A spelling is taken apart into scale words, a numerator and denominators; the parts compose to a
unit code that is looked up among the codes of the measured quantity.  So "thousand tonnes per
year", "kt/y" and "ktpa" meet in one code without listing every spelling.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column, functions as F

# Words for units, by the code they stand for.
WORDS = {
    "t": "t tn tonne tonnes tonelada toneladas metric-ton metric-tons ton-metrica tons-metricas ton-métrica tonne-metrique mton",
    "kt": "kt kilotonne kilotonnes kiloton kilotons", "Mt": "Mt megatonne megatonnes megaton megatons",
    "kg": "kg kgs kilo kilos kilogram kilograms kilogramme kilogrammes kilogramo kilogramos",
    "g": "g gr grs gram grams gramme grammes gramo gramos", "lb": "lb lbs pound pounds libra libras",
    "short_ton": "st sht short-ton short-tons us-ton us-tons ust", "long_ton": "lt long-ton long-tons imperial-ton imperial-tons",
    "troy_oz": "oz ozt ounce ounces troy-oz troy-ounce troy-ounces oz-t onza onzas", "koz": "koz k-oz",
    "MW": "MW MWe MWel megawatt megawatts mega-watt mega-watts", "kW": "kW KW kWe kilowatt kilowatts", "GW": "GW GWe gigawatt gigawatts", "W": "W watt watts",
    "m3": "m3 cu-m cubic-metre cubic-metres cubic-meter cubic-meters metros-cubicos cbm", "L": "L l ltr ltrs litre litres liter liters litro litros",
    "ML": "ML Ml megalitre megalitres megaliter megaliters", "Mm3": "Mm3 hm3", "bbl": "bbl bbls barrel barrels barril barriles", "us_gal": "us-gal us-gallon us-gallons gal-us",
    "percent": "% pct percent per-cent", "ppb": "ppb parts-per-billion", "g/t": "ppm parts-per-million gpt",
    "m": "m mt mts mtr metre metres meter meters metro metros", "km": "km kms kilometre kilometres kilometer kilometers", "ft": "ft feet foot '", "yd": "yd yds yard yards", "mi": "mi mile miles",
    "ha": "ha has hectare hectares hectarea hectareas", "km2": "km2 sq-km square-kilometre square-kilometres square-kilometer square-kilometers",
    "acre": "ac acre acres", "m2": "m2 sq-m square-metre square-metres square-meter square-meters", "mi2": "mi2 sq-mi square-mile square-miles",
    "kWh": "kWh KWH kwh kilowatt-hour kilowatt-hours", "MWh": "MWh MWH megawatt-hour megawatt-hours", "GJ": "GJ gigajoule gigajoules", "MJ": "MJ megajoule megajoules",
    "degC": "C °C deg-C degC celsius degree-celsius degrees-celsius", "degF": "F °F deg-F degF fahrenheit degrees-fahrenheit", "K": "K kelvin kelvins",
    "kPa": "kPa kpa KPA kilopascal kilopascals", "bar": "bar bars barg bara", "psi": "psi PSI psig lb/sq-in lb/in2", "MPa": "MPa megapascal megapascals", "atm": "atm atmosphere atmospheres",
}
TIMES = {
    "a": "a y yr yrs year years annum pa año años ano anos an", "month": "mo month months mes meses", "d": "d day days dia día", "h": "h hr hrs hour hours hora horas",
    "min": "min mins minute minutes m", "s": "s sec secs second seconds",
}
#: Abbreviations without a stroke.
COMPACT = {
    "tpa": "t/a", "ktpa": "kt/a", "Mtpa": "Mt/a", "mtpa": "Mt/a", "tpd": "t/d", "tph": "t/h", "tpm": "t/month", "mtpd": "t/d", "lps": "L/s", "gpm": "us_gal/min", "us-gpm": "us_gal/min",
    "opt": "troy_oz/short_ton", "kgpt": "kg/t", "cumecs": "m3/s",
}
SCALES = {"thousand": 1e3, "k": 1e3, "mil": 1e3, "'000": 1e3, "million": 1e6, "millions": 1e6, "millones": 1e6, "mn": 1e6, "M": 1e6, "mio": 1e6, "billion": 1e9, "bn": 1e9}
_WORD = {w: code for code, words in WORDS.items() for w in words.split()}
_LOWER = {w.lower(): code for code, words in WORDS.items() for w in words.split() if len(w) > 3 or w.lower() == w}
_TIME = {w: code for code, words in TIMES.items() for w in words.split()}
_NOTE = re.compile(r"\((?!us\)|g\)|a\))[^)]*\)?", re.I)
_FOLD = str.maketrans("áéíóúÁÉÍÓÚ³²\u2019\u2032\u00a0\u202f", "aeiouAEIOU32''  ")


def _atom(text: str, table: dict[str, str]) -> str | None:
    dashed = re.sub(r"[\s\-]+", "-", text.strip(" .-"))
    for form in (dashed, dashed.replace(".", ""), dashed.replace(".", "-")):
        found = table.get(form) or (_LOWER if table is _WORD else table).get(form.lower())
        if found:
            return found
    return None


def _codes(text: str) -> list[str]:
    """Unit codes that the text, free of scale words, may stand for; the likeliest first."""
    dashed = re.sub(r"[\s\-]+", "-", text.strip(" .-"))
    if dashed in COMPACT or dashed.lower() in COMPACT:
        return [COMPACT.get(dashed) or COMPACT[dashed.lower()]]
    whole = _atom(text, _WORD)
    if whole:
        return [whole]
    bare = re.sub(r"\bper\s+(?=annum\b)", "/", re.sub(r"\b(?:p\.?\s?a\.?)(?=\s|$)", "/a", text))
    parts = [p for p in re.split(r"\s*/\s*|\s+(?:per|al|por|each|an?)\s+|\s+p\.", bare) if p.strip()]
    if len(parts) == 2:
        low = _atom(parts[1], _TIME) or _atom(parts[1], _WORD)
        tops = ["t", "Mt"] if parts[0].strip() == "MT" else [_atom(parts[0], _WORD)]
        return [f"{top}/{low}" for top in tops if top and low]
    return ["t", "Mt"] if text.strip() == "MT" else []


@lru_cache(maxsize=200_000)
def readings(text: str) -> tuple[tuple[float, str], ...]:
    """(scale, unit code) pairs that a typed unit may mean, the likeliest first."""
    t = _NOTE.sub(" ", (text or "").translate(_FOLD))
    t = re.sub(r"\((us)\)", " ", t, flags=re.I) if re.search(r"gpm", t, re.I) else re.sub(r"\((g|a)\)", "", t, flags=re.I)
    t, scale = t.strip(), 1.0
    while True:
        if codes := _codes(t):
            return tuple((scale, c) for c in codes)
        m = re.match(r"('000|[A-Za-z]+)\s*(?=\s|$)", t)
        if not m or (m[1] not in SCALES and m[1].lower() not in ("thousand", "million", "millones", "billion")):
            return ()
        scale *= SCALES.get(m[1]) or SCALES[m[1].lower()]
        t = t[m.end() :].strip()
        if not t:
            return ((scale, ""),)


def resolved(quantity: str | None, canonical: str | None, in_text: str | None, in_column: str | None, refs: dict) -> list[tuple[float, float, int]]:
    """(factor, shift, rank) readings of a value's unit within its quantity.

    The unit column counts; without one, the unit in the value's own text.  Scale words in the
    text multiply a unit from the column unless the text only repeats that unit.  Another unit that
    the text itself names is a further, less likely reading.
    """
    text, column = (in_text or "").translate(_FOLD), (in_column or "").translate(_FOLD)
    text, column = _NOTE.sub(" ", text).strip(), column.strip()
    plain = _NOTE.sub(" ", column).strip()
    scale, source = 1.0, text
    if column:
        source = column
        if text and text != plain:
            rest = text[: -len(plain)].strip() if plain and text.endswith(plain) else text
            for word in rest.split():
                scale *= SCALES.get(word) or SCALES.get(word.lower(), 1.0)
    out = []
    for s, code in readings(source):
        if (quantity, code) in refs:
            factor, shift = refs[quantity, code]
            out.append((scale * s * factor, shift, len(out)))
    own = text if column and out else ""
    for s, code in readings(own) if own else ():
        factor, shift = refs.get((quantity, code), (None, None))
        if factor is not None and all((s * factor, shift) != (f, h) for f, h, _ in out):
            out.append((s * factor, shift, 10 + len(out)))
    return out


def number_text(raw: Column) -> tuple[Column, Column]:
    """The first number in the text, as written, and what follows it."""
    t = F.translate(raw, "\u00a0\u202f\u2009\u2019\u2212", "   '-")
    num = r"(?:(?<=^|\s|~)-)?\d+(?:[ ']\d{3}(?!\d))*(?:[.,]\d+)*(?:\s?[xX×]\s?10\^?[+-]?\d+|[eE][+-]?\d+)?"
    return F.regexp_extract(t, num, 0), F.trim(F.regexp_extract(t, num + r"(.*)$", 1))


def number_readings(num: Column) -> Column:
    """array<struct<value, rank>> of the numbers the text may mean, the likeliest first.

    One comma before exactly three digits may group thousands (rank 0) or mark decimals (1).
    """
    exp = F.coalesce(F.regexp_extract(num, r"(?:[eE]|[xX×]\s?10\^?)([+-]?\d+)$", 1).try_cast("int"), F.lit(0))
    powered = num.rlike(r"[eExX×]")
    m = F.regexp_replace(F.regexp_replace(num, r"(?:\s?[xX×]\s?10\^?[+-]?\d+|[eE][+-]?\d+)$", ""), r"[ ']", "")
    comma, dot = F.locate(",", m), F.locate(".", m)
    no_comma, no_dot = F.regexp_replace(m, ",", ""), F.regexp_replace(m, r"\.", "")
    decimal_comma = F.regexp_replace(no_dot, ",", ".")
    value = lambda s, rank: F.struct((s.try_cast("double") * F.pow(F.lit(10.0), exp)).alias("value"), F.lit(rank).alias("rank"))
    sure = lambda s: F.array(value(s, 0))
    both = (comma > 0) & (dot > 0)
    found = (
        F.when(both & m.rlike(r"\.\d+$") & ~m.rlike(r"\..*,"), sure(no_comma))
        .when(both, sure(decimal_comma))
        .when(m.rlike(r",\d+,"), sure(no_comma))
        .when(m.rlike(r"\.\d+\."), sure(no_dot))
        .when((comma > 0) & ~powered & m.rlike(r"^-?[1-9]\d{0,2},\d{3}$"), F.array(value(no_comma, 0), value(decimal_comma, 1)))
        .when(comma > 0, sure(decimal_comma))
        .otherwise(sure(m))
    )
    return F.filter(found, lambda x: x["value"].isNotNull())
