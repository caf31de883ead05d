"""Scalar functions on names, types, statuses, metals and coordinates, as native columns."""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from orelode.functions import fixed


def lookup(key: Column, table: dict[str, str]) -> Column:
    """The value of a small fixed table, null where the key is not in it."""
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), key)


def slugify(c: Column) -> Column:
    """Lower case, parentheticals dropped, other runs of non-alphanumerics to single dashes.
    Letters outside ASCII are dropped, not transliterated; null stays null."""
    bare = F.regexp_replace(F.lower(F.trim(c)), r"\([^)]*\)", "")
    return F.regexp_replace(F.regexp_replace(bare, "[^a-z0-9]+", "-"), "^-+|-+$", "")


def name_norm(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def normalize_type(c: Column) -> Column:
    """struct<type, confidence> of a raw type, by exact, de-punctuated and contained matches in
    the fixed order of the table."""
    pair = lambda t, p: F.struct(F.lit(t).alias("type") if isinstance(t, str) else t.alias("type"), F.lit(p).alias("confidence"))
    r = F.lower(F.trim(c))
    flat = F.translate(r, "_-", "  ")
    out = (
        F.when(c.isNull() | (c == ""), pair("facility", 0.2))
        .when(F.translate(r, ".-", "").rlike("^[0-9]+$"), pair("facility", 0.1))
        .when(r.isin(*fixed.TYPE_MAPPING), pair(lookup(r, fixed.TYPE_MAPPING), 0.95))
        .when(flat.isin(*fixed.TYPE_MAPPING), pair(lookup(flat, fixed.TYPE_MAPPING), 0.9))
    )
    for key, value in fixed.TYPE_MAPPING.items():
        out = out.when(r.contains(key), pair(value, 0.85))
    return out.otherwise(pair("facility", 0.3))


def parse_types(c: Column) -> Column:
    """Types of a ``,`` or ``;`` separated text; synonyms mapped, others kept, ["mine"] if none."""
    parts = F.transform(F.split(F.lower(c), "[,;]"), lambda t: F.trim(t))
    mapped = F.transform(parts, lambda t: F.coalesce(lookup(t, fixed.TYPES), t))
    kept = F.array_distinct(F.filter(mapped, lambda t: t != ""))
    none = c.isNull() | F.trim(c).isin("", "-") | (F.size(kept) == 0)
    return F.when(none, F.array(F.lit("mine"))).otherwise(kept)


def parse_status(c: Column) -> Column:
    word = F.regexp_extract(F.lower(c), rf"\b({fixed.STATUS_WORDS})\b", 1)
    by_word = F.coalesce(lookup(word, fixed.STATUSES), F.lit("unknown"))
    whole = F.coalesce(lookup(F.lower(F.trim(c)), fixed.STATUSES), F.lit("unknown"))
    return F.when(c.isNull() | F.trim(c).isin("", "-"), "unknown").when(word != "", by_word).otherwise(whole)


def normalize_metal(c: Column) -> Column:
    key = F.lower(F.trim(c))
    return F.coalesce(lookup(key, fixed.METALS), key)


def parse_commodities(primary: Column, other: Column) -> Column:
    """array<struct<metal, primary>> of two separated texts; the first mention of a metal wins."""
    of = lambda c, flag: F.transform(F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "[,;]"), lambda m: F.trim(m)), lambda m: ~m.isin("", "-")), lambda m: F.struct(normalize_metal(m).alias("metal"), F.lit(flag).alias("primary")))
    both = F.concat(of(primary, True), of(other, False))
    names = F.transform(both, lambda x: x["metal"])
    return F.filter(both, lambda x, i: F.array_position(names, x["metal"]) == i + 1)


def confidence_label(c: Column) -> Column:
    return F.when(c >= 0.85, "Very High").when(c >= 0.75, "High").when(c >= 0.60, "Moderate").when(c >= 0.40, "Low").otherwise("Very Low")


def asset_types(types: Column) -> Column:
    title = F.transform(F.filter(types, lambda t: t.isNotNull()), lambda t: F.coalesce(lookup(F.lower(t), fixed.ASSET_TYPES), t))
    return F.when(types.isNull() | (F.size(types) == 0), "Mine").otherwise(F.array_join(title, ";"))


def humanize_type(c: Column) -> Column:
    return F.when(c.isNull() | c.isin("", "facility"), "").otherwise(F.initcap(F.translate(c, "_", " ")))


def core_name(c: Column, operator: Column | None = None) -> Column:
    """The name without parentheticals, its operator and noise words; the trimmed name if nothing
    is left."""
    s = F.regexp_replace(c, r"\([^)]*\)", " ")
    if operator is not None:
        word = F.concat(F.lit(r"(?i)\b\Q"), F.regexp_replace(operator, r"\\E", ""), F.lit(r"\E\b"))
        s = F.when(F.coalesce(operator, F.lit("")) == "", s).otherwise(F.regexp_replace(s, word, F.lit(" ")))
    # in one pass, longer words first: none ends as another begins, so it is as if they went one by one
    noise = "|".join(sorted(fixed.NOISE_WORDS, key=lambda w: (-len(w), w)))
    s = F.regexp_replace(s, rf"(?i)\b(?:{noise})\b", " ")
    s = F.trim(F.regexp_replace(s, r"\s+", " "))
    return F.when(s != "", s).otherwise(F.trim(c))


def word_overlap(a: Column, b: Column) -> Column:
    """Shared words over the words of the shorter text; 0 if either has none."""
    words = lambda c: F.array_distinct(F.filter(F.split(c, r"\s+"), lambda w: w != ""))
    x, y = words(a), words(b)
    n = F.least(F.size(x), F.size(y))
    return F.when(n > 0, F.size(F.array_intersect(x, y)) / n).otherwise(0.0)


def contains_either(a: Column, b: Column) -> Column:
    return a.contains(b) | b.contains(a)


def owners(c: Column) -> Column:
    """array<struct<name, percentage, role>> of texts like "A (60%), B 40%"."""
    bare = F.regexp_replace(c, r"(?i)^\s*(?:joint venture|jv)\s*:\s*", "")
    pattern = r"([^,;()%]+?)\s*\(?\s*(\d+(?:\.\d+)?)\s*%\s*\)?"
    names = F.transform(F.regexp_extract_all(bare, F.lit(pattern), F.lit(1)), lambda n: F.trim(n))
    shares = F.transform(F.regexp_extract_all(bare, F.lit(pattern), F.lit(2)), lambda s: s.try_cast("double"))
    found = F.zip_with(names, shares, lambda n, s: F.struct(n.alias("name"), s.alias("percentage"), F.when(s > 50, "owner").otherwise("minority_owner").alias("role")))
    one = F.array(F.struct(F.trim(bare).alias("name"), F.lit(None).cast("double").alias("percentage"), F.lit("owner").alias("role")))
    return F.when(F.size(found) > 0, found).when(F.trim(bare) != "", one).otherwise(F.slice(one, 1, 0))


def geohash(lat: Column, lon: Column, length: int = 7) -> Column:
    """Geohash by bisection with strict comparisons, so (0, 0) is ``7zzzzzz``; null in, null out.

    The cell numbers of both axes are computed at once and their bits interleaved.
    """
    total = 5 * length

    def number(c: Column, half: float, bits: int) -> Column:
        step = 2 * half / (1 << bits)
        i = F.ceil((c + half) / step).cast("long") - 1
        # cell borders are exact doubles: a border belongs to the cell below it
        i = F.when(c <= i * step - half, i - 1).when(c > (i + 1) * step - half, i + 1).otherwise(i)
        return F.greatest(F.lit(0), F.least(F.lit((1 << bits) - 1), i))

    east, north = number(lon, 180.0, total - total // 2), number(lat, 90.0, total // 2)
    chars = []
    for at in range(length):
        value = F.lit(0)
        for p in range(5 * at, 5 * at + 5):
            axis, bits = (east, total - total // 2) if p % 2 == 0 else (north, total // 2)
            value = value * 2 + F.shiftright(axis, bits - 1 - p // 2).bitwiseAND(1)
        chars.append(F.substring(F.lit("0123456789bcdefghjkmnpqrstuvwxyz"), (value + 1).cast("int"), F.lit(1)))
    return F.when(lat.isNotNull() & lon.isNotNull(), F.concat(*chars))


def same_ignoring_accents(a: Column, b: Column) -> Column:
    """Whether two texts are equal but for accents and case; not if either is null or empty."""
    return F.coalesce((a != "") & (b != "") & (F.lower(to_ascii(a)) == F.lower(to_ascii(b))), F.lit(False))


def with_note(notes: Column, suffix: str) -> Column:
    """The note with ``suffix`` after a bar, or the suffix alone where there is none."""
    return F.when(F.coalesce(notes, F.lit("")) == "", F.lit(suffix)).otherwise(F.concat_ws(" | ", notes, F.lit(suffix)))


def matchable(c: Column) -> Column:
    """Lower case without parentheticals and signs other than dashes, blanks collapsed."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(c), r"\([^)]*\)", ""), r"[^a-z0-9\s\-]", "")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


#: Sixteen winds, clockwise from north.
WINDS = "N NNE NE ENE E ESE SE SSE S SSW SW WSW W WNW NW NNW".split()


def bearing(wind: Column) -> Column:
    """Degrees of a wind's name, north for anything else."""
    return F.coalesce(lookup(F.upper(F.trim(wind)), {w: str(22.5 * i) for i, w in enumerate(WINDS)}).cast("double"), F.lit(0.0))


def destination(lat: Column, lon: Column, km: Column, bearing: Column) -> Column:
    """struct<lat, lon> reached on the sphere from a point, a distance and a bearing in degrees."""
    d, p, t = km / 6371.0, F.radians(lat), F.radians(bearing)
    to = F.asin(F.sin(p) * F.cos(d) + F.cos(p) * F.sin(d) * F.cos(t))
    east = F.atan2(F.sin(t) * F.sin(d) * F.cos(p), F.cos(d) - F.sin(p) * F.sin(to))
    return F.struct(F.degrees(to).alias("lat"), F.degrees(F.radians(lon) + east).alias("lon"))


def completeness(df_cols: dict[str, Column]) -> Column:
    """Weighted completeness of a record from ``lat``, ``commodities``, ``mentions``, ``aliases``,
    ``status``, ``confidence`` and ``verified``."""
    n = lambda c: F.coalesce(F.when(F.size(c) >= 0, F.size(c)), F.lit(0))
    bonus = F.when(df_cols["verified"] == "human_verified", 20).when(df_cols["verified"] == "csv_imported", 10).when(df_cols["verified"] == "llm_verified", 5).otherwise(0)
    known = F.when(df_cols["status"].isNull() | (df_cols["status"] != "unknown"), 5).otherwise(0)
    return (
        F.when(df_cols["lat"].isNotNull(), 10.0).otherwise(0.0) + 2 * n(df_cols["commodities"]) + 3 * n(df_cols["mentions"]) + n(df_cols["aliases"]) + known + 10 * F.coalesce(df_cols["confidence"], F.lit(0.0)) + bonus
    )


def evidence_hash(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *parts), 256)


@F.pandas_udf(T.DoubleType())
def seq_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity; the order of the arguments matters."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)])


@F.pandas_udf(T.StringType())
def to_ascii(a: pd.Series) -> pd.Series:
    """Decomposed and without what is not ASCII; null stays null."""
    return a.map(lambda s: None if s is None else unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode())


@F.pandas_udf(T.DoubleType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Indel similarity of the sorted words of two texts."""

    def ratio(x: str, y: str) -> float:
        x, y = " ".join(sorted((x or "").lower().split())), " ".join(sorted((y or "").lower().split()))
        if not x and not y:
            return 1.0
        row = [0] * (len(y) + 1)
        for cx in x:
            left = 0
            for j, cy in enumerate(y, 1):
                left, row[j] = row[j], left + 1 if cx == cy else max(row[j], row[j - 1])
        return 2 * row[-1] / (len(x) + len(y))

    return pd.Series([ratio(x, y) for x, y in zip(a, b)])
