"""Near-duplicate site records: one site under several ids, by tensored minhash banding.

A site's names and aliases are reduced to their proper words (the core) and what tells siblings
apart (numbers, phases, sides).  Equal records collapse into classes of country, core, qualifier
and place, so copies cost nothing.  Distinct cores are shingled into letter pairs and triples; two
small collections of minhash bands are computed, and every table key is a pair of one band from
each, which gives ``BANDS`` squared tables from 2 x ``BANDS`` bands.  Candidates are verified by
edit distance, and classes with similar cores by qualifier and by distance.  Connected classes are
one site.  Bands alone miss many pairs with two or three edits, so cores also meet by what is left of
them, or of their ends, after deletions, which misses no pair the verifier accepts; cores under four
letters meet by equality only.

Places are compared without regard to signs and to the order of latitude and longitude, which are
often mixed up.  A record without a usable place joins the one place its name has in its country,
none if there are several.  Names of claims and placeholders do not count.

Defined results: null ids and names without proper words link to nothing; a country is taken from
the id's prefix where that is a known code, else from any notation in ``country_iso3``; namesakes
further apart than about 5 km, or in different countries, stay apart.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from orelode.llm.components import components
from orelode.llm.strings import ascii_fold, deletions, squash
from orelode.operators.spatial import country_codes, usable
from orelode.plans.runtime import bounded, cut, slots

BANDS, ROWS = 10, 2
SHORT = 12
CELL, NEAR = 0.05, 0.09
PLACEHOLDERS = set("tbd tba n/a na none null unknown unnamed - -- ? various".split())

# Words of site names that do not name the site.
DESCRIPTORS = set(
    "mine mines mina minas pit pits open opencast quarry quarries plant works colliery concentrator smelter refinery mill project proj deposit dep old new ex lease claim operation operations op workings working site "
    "facility complex hill hl mount mt saint st sta santa san el la los las the de del of and former hills hle conc smltr qry coll prospect area field co".split()
) | set(
    "copper gold silver zinc lead nickel cobalt iron aluminum aluminium bauxite manganese chromium lithium tin tungsten molybdenum uranium platinum palladium coal rare earths earth phosphate potash graphite vanadium titanium antimony "
    "mercury bismuth fluorspar baryte gypsum limestone salt diamonds kaolin tantalum niobium sulfur sand".split()
)
SIDES = {"north": "n", "south": "s", "east": "e", "west": "w", "upper": "u", "lower": "l", "central": "c", "inner": "i", "outer": "o"}
ROMAN = {"i": "1", "ii": "2", "iii": "3", "iv": "4", "v": "5", "vi": "6", "vii": "7", "viii": "8", "ix": "9", "x": "10"}
NUMBERED = set("shaft phase no number nr block stage unit pit section level zone".split())


@lru_cache(maxsize=100_000)
def parse_site(name: str) -> tuple[str, str]:
    """(core, qualifier): the proper words, squashed and run together in order, and what tells
    siblings apart (numbers, phases, sides)."""
    low = ascii_fold(name).lower().strip()
    if low in PLACEHOLDERS or low.endswith(" claim"):
        return "", ""
    t = re.sub(r"[^a-z0-9]+", " ", low.split(",")[0]).split()
    core, qual = [], []
    for i, w in enumerate(t):
        before = t[i - 1] if i else ""
        if w.isdigit():
            qual.append(w)
        elif w in SIDES:
            qual.append(SIDES[w])
        elif w in ROMAN and before in NUMBERED:
            qual.append(ROMAN[w])
        elif w not in DESCRIPTORS and w not in NUMBERED and len(w) > 0:
            core.append(w)
    return squash("".join(core)), "".join(sorted(qual))


def _variants(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for fid, country, name, aliases, a, z in zip(b["fid"], b["country"], b["name"], b["aliases"], b["a"], b["z"]):
            own, qual = parse_site(name) if isinstance(name, str) else ("", "")
            cores = {own}
            for alias in aliases if aliases is not None else ():
                if isinstance(alias, str):
                    core, q = parse_site(alias)
                    cores.add(core)
                    qual = qual or (q if core == own or not own else "")
            rows += [(fid, country, core, qual, a, z) for core in sorted(cores) if len(core) >= 3]
        yield pd.DataFrame(rows, columns=["fid", "country", "core", "qual", "a", "z"])


def _minhash(grams: Column, seed: int) -> Column:
    return F.array_min(F.transform(grams, lambda g: F.xxhash64(g, F.lit(seed))))


def most_edits(length: int) -> int:
    """Edits the verifier accepts by the longer core's letters."""
    return 3 if length >= 9 else 2 if length >= 6 else 1


def rests(core: str) -> set[str]:
    """Keys that two cores share if the verifier may accept them: up to ``SHORT`` letters what is
    left by as many deletions as it accepts edits; of longer ones, whose two ends cannot both hold
    more than one of three edits, the ends by one deletion.  Cores up to three letters longer or
    shorter meet in the keys of the same kind."""
    found = deletions(core, most_edits(len(core))) if len(core) <= SHORT else set()
    for width, low, high in ((6, SHORT - 2, SHORT + 6), (8, SHORT + 4, 10**9)):
        if low <= len(core) <= high:
            found |= {f"<{d}" for d in deletions(core[:width], 1)} | {f">{d}" for d in deletions(core[-width:], 1)}
    return found


def _shortened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """:func:`rests` of each core, a few cores at a time, so memory does not grow with the batch."""
    for b in batches:
        for at in range(0, len(b), 64):
            part = b.iloc[at : at + 64]
            lists = [sorted(rests(core)) for core in part["core"]]
            n = [len(x) for x in lists]
            yield pd.DataFrame({"core_id": np.repeat(part["core_id"].to_numpy(), n), "country": np.repeat(part["country"].to_numpy(), n), "rest": [x for xs in lists for x in xs]})


def similar_cores(cores: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``country``, ``core_a``, ``core_b``, ``edits`` of similar distinct cores of a country, core_a < core_b;
    ``shingled`` are those that also meet in a table of bands."""
    text = F.concat(F.lit("^"), F.col("core"), F.lit("$"))
    at = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - n + 1)), lambda i: F.substring(text, i, F.lit(n)))
    distinct = cores.where("length(core) >= 4").select("country", "core").distinct()
    # a number of partitions given by hand: few bytes make much work here
    # and small ids, for they travel with every key
    own = cut(distinct.repartition(slots(cores.sparkSession))).withColumn("core_id", F.monotonically_increasing_id())
    base = own.withColumn("grams", F.array_distinct(F.concat(at(2), at(3))))
    band = lambda side, i: F.xxhash64(*(_minhash(F.col("grams"), 1000 * side + rows * i + r) for r in range(rows)))
    base = base.select("core_id", "country", *(F.array(*(band(s, i) for i in range(bands))).alias(f"side{s}") for s in (0, 1)))
    keys = F.flatten(F.transform("side0", lambda x, i: F.transform("side1", lambda y, j: F.xxhash64(F.col("country"), x, y, i * bands + j))))
    rest = own.select("core_id", "country", "core").mapInPandas(_shortened, "core_id bigint, country string, rest string")
    # the last bit of a key says whether it comes from a table of bands
    marked = lambda key, shingled: F.shiftleft(key, 1) + F.lit(shingled)
    tables = base.select("core_id", F.explode(keys).alias("k")).select("core_id", marked(F.col("k"), 1).alias("key"))
    tables = tables.unionByName(rest.select("core_id", marked(F.xxhash64("country", "rest"), 0).alias("key"))).repartition(slots(cores.sparkSession), "key")
    pairs = tables.alias("l").join(tables.alias("r"), (F.col("l.key") == F.col("r.key")) & (F.col("l.core_id") < F.col("r.core_id")))
    pairs = pairs.groupBy(F.col("l.core_id").alias("x"), F.col("r.core_id").alias("y")).agg((F.max(F.col("l.key").bitwiseAND(1)) == 1).alias("shingled"))
    side = lambda i, c: own.select(F.col("core_id").alias(i), F.col("country").alias(f"country_{c}"), F.col("core").alias(f"core_{c}"))
    pairs = pairs.join(side("x", "a"), "x").join(side("y", "b"), "y").where("country_a = country_b")
    length = F.greatest(F.length("core_a"), F.length("core_b"))
    most = F.when(length >= 9, 3).when(length >= 6, 2).otherwise(1)
    pairs = pairs.withColumn("edits", F.levenshtein("core_a", "core_b", 3)).where((F.col("edits") >= 0) & (F.col("edits") <= most))
    return pairs.select(F.col("country_a").alias("country"), F.least("core_a", "core_b").alias("core_a"), F.greatest("core_a", "core_b").alias("core_b"), "edits", "shingled")


def site_groups(facility: DataFrame, country_ref: DataFrame) -> DataFrame:
    """``facility_id`` and ``site`` for every id that shares its site with another id."""
    codes = country_codes(country_ref)
    iso = codes.select(F.upper("notation").alias("prefix"), F.col("meant").alias("by_prefix")).where("length(prefix) = 3 and prefix = by_prefix")
    ok = usable(F.col("location.lat"), F.col("location.lon"))
    x, y = F.abs("location.lat"), F.abs("location.lon")
    rows = facility.where("facility_id is not null").select(
        F.col("facility_id").alias("fid"), F.upper(F.substring("facility_id", 1, 3)).alias("prefix"), F.lower(F.trim("country_iso3")).alias("notation"), "name", "aliases",
        F.when(ok, F.least(x, y)).alias("a"), F.when(ok, F.greatest(x, y)).alias("z"),
    )
    rows = rows.join(bounded(iso, 10_000), "prefix", "left").join(bounded(codes, 10_000), "notation", "left").select("fid", F.coalesce("by_prefix", "meant", F.lit("")).alias("country"), "name", "aliases", "a", "z")
    found = rows.repartition(slots(rows.sparkSession)).mapInPandas(_variants, "fid string, country string, core string, qual string, a double, z double")
    cell = lambda c: F.coalesce(F.floor(F.col(c) / CELL).cast("int"), F.lit(-9))
    found = found.withColumns({"ca": cell("a"), "cz": cell("z")}).withColumn("cls", F.xxhash64("country", "core", "qual", "ca", "cz"))
    found = cut(found)
    members = found.select("fid", "cls").distinct()
    classes = cut(found.groupBy("cls").agg(*(F.first(c).alias(c) for c in ("country", "core", "qual", "ca", "cz")), F.avg("a").alias("a"), F.avg("z").alias("z")))
    sims = cut(similar_cores(classes))
    links = []
    # one id is one site
    least = members.groupBy("fid").agg(F.min("cls").alias("least"))
    links.append(members.join(least, "fid").select(F.col("cls").alias("u"), F.col("least").alias("v")))
    # one name over neighbouring cells
    near = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 1), (1, -1), (1, 0), (1, 1))))
    step = classes.where("ca >= 0").select("cls", "country", "core", "qual", "ca", "cz", F.explode(near).alias("d"))
    step = step.select(F.col("cls").alias("u"), F.xxhash64("country", "core", "qual", F.col("ca") + F.col("d.i"), F.col("cz") + F.col("d.j")).alias("v"))
    links.append(step.join(classes.select(F.col("cls").alias("v")), "v").select("u", "v"))
    # similar names: at one place, or both without; where no place confirms them they must share shingles
    both = sims.unionByName(sims.select("country", F.col("core_b").alias("core_a"), F.col("core_a").alias("core_b"), "edits", "shingled"))
    one = classes.select("country", F.col("core").alias("core_a"), "qual", F.col("cls").alias("u"), F.col("a").alias("a1"), F.col("z").alias("z1"))
    two = classes.select("country", F.col("core").alias("core_b"), "qual", F.col("cls").alias("v"), F.col("a").alias("a2"), F.col("z").alias("z2"))
    placed, lost = F.col("a1").isNotNull(), one.where("a1 is null")
    # located classes meet by neighbourhood: one side in its own square, the other in all nine around
    square = lambda c: F.floor(F.col(c) / NEAR).cast("int")
    around = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    here = one.where(placed).join(both.where("core_a < core_b"), ["country", "core_a"]).withColumns({"sa": square("a1"), "sz": square("z1")})
    there = two.where("a2 is not null").withColumn("d", F.explode(around)).withColumns({"sa": square("a2") + F.col("d.i"), "sz": square("z2") + F.col("d.j")}).drop("d")
    together = (F.abs(F.col("a1") - F.col("a2")) <= 0.045) & (F.abs(F.col("z1") - F.col("z2")) <= NEAR)
    links.append(here.join(there, ["country", "core_b", "qual", "sa", "sz"]).where(together).select("u", "v"))
    # without a place a core and qualifier are one class
    wild = both.where("shingled")
    links.append(lost.join(wild.where("edits <= 2 and core_a < core_b"), ["country", "core_a"]).join(two.where("a2 is null"), ["country", "core_b", "qual"]).select("u", "v"))
    # without a place: the one place of the name, else the one place of similar names
    spread = two.where("a2 is not null").groupBy("country", "core_b", "qual").agg(F.min("v").alias("v"), *(f(c).alias(f"{f.__name__}_{c}") for c in ("a2", "z2") for f in (F.min, F.max)))
    wide = [F.min("v").alias("v"), *((F.max(f"max_{c}") - F.min(f"min_{c}")).alias(f"d{c}") for c in ("a2", "z2"))]
    same = lost.join(spread.withColumnRenamed("core_b", "core_a"), ["country", "core_a", "qual"]).groupBy("u").agg(*wide)
    close = lost.join(same.select("u"), "u", "left_anti").join(wild, ["country", "core_a"]).join(spread, ["country", "core_b", "qual"]).groupBy("u").agg(*wide)
    links.append(same.unionByName(close).where("da2 <= 0.1 and dz2 <= 0.2").select("u", "v"))
    comp = components(reduce(DataFrame.unionByName, links), "u", "v").select(F.col("node").alias("cls"), "component")
    sited = members.join(comp, "cls", "left").select("fid", F.coalesce("component", "cls").alias("site")).distinct()
    many = sited.groupBy("site").agg(F.count("*").alias("n")).where("n > 1").select("site")
    return sited.join(many, "site").select(F.col("fid").alias("facility_id"), "site")


def site_pairs(facility: DataFrame, country_ref: DataFrame) -> DataFrame:
    """All pairs of different ids of one site, ``facility_id_a`` < ``facility_id_b``."""
    g = cut(site_groups(facility, country_ref))
    on = (F.col("l.site") == F.col("r.site")) & (F.col("l.facility_id") < F.col("r.facility_id"))
    return g.alias("l").join(g.alias("r"), on).select(F.col("l.facility_id").alias("facility_id_a"), F.col("r.facility_id").alias("facility_id_b"))
