"""Blocked duplicate search, star clusters, best record and merge of facility records.

Exact copies (same folded name, aliases and position) collapse into classes before any pair is
made; pairs are between class representatives.  A class's members are found by its key.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from orelode.functions.text import completeness, contains_either, seq_ratio, word_overlap
from orelode.operators.spatial import usable
from orelode.plans.runtime import cut, slots


def cell(c: Column) -> Column:
    """The tenth-of-a-degree cell of a coordinate, half to even."""
    return F.rint(c * 10).cast("int")


def classes(facility: DataFrame) -> DataFrame:
    """One row a class of records with equal folded name, aliases and position: ``class_id`` (least
    rec_id), ``n_records``, ``low``, ``aliases``, ``lat``, ``lon``, ``cell_lat``, ``cell_lon``.
    Records without a usable position are left out, for they block with nothing."""
    lat, lon = F.col("location.lat"), F.col("location.lon")
    folded = F.array_sort(F.array_distinct(F.transform(F.filter(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: a.isNotNull()), F.lower)))
    rows = facility.where(usable(lat, lon)).select("rec_id", F.lower(F.coalesce("name", F.lit(""))).alias("low"), folded.alias("aliases"), lat.alias("lat"), lon.alias("lon"))
    return rows.groupBy("low", "aliases", "lat", "lon").agg(F.min("rec_id").alias("class_id"), F.count("*").alias("n_records")).withColumns({"cell_lat": cell(F.col("lat")), "cell_lon": cell(F.col("lon"))})


def candidate_counts(cls: DataFrame) -> DataFrame:
    """``class_id``, ``n_records`` and how many other classes share its cell, without making pairs."""
    cells = cls.groupBy("cell_lat", "cell_lon").agg((F.count("*") - 1).alias("n_candidates"))
    return cls.join(cells, ["cell_lat", "cell_lon"]).select("class_id", "n_records", "n_candidates")


def candidate_pairs(cls: DataFrame) -> DataFrame:
    """Pairs of classes in one cell, ``id_a`` < ``id_b``, with both sides as structs a and b.

    The join goes cell by cell; cells with more than the skew threshold are split by AQE.
    """
    side = lambda s: cls.select("cell_lat", "cell_lon", F.struct("class_id", "low", "aliases", "lat", "lon").alias(s))
    return side("a").join(side("b"), ["cell_lat", "cell_lon"]).where("a.class_id < b.class_id").select(F.col("a.class_id").alias("id_a"), F.col("b.class_id").alias("id_b"), "a", "b")


def native_reason(a: str = "a", b: str = "b") -> Column:
    """The first native reason for two records to be duplicates, null if none."""
    x, y = F.col(f"{a}.low"), F.col(f"{b}.low")
    dlat, dlon = F.abs(F.col(f"{a}.lat") - F.col(f"{b}.lat")), F.abs(F.col(f"{a}.lon") - F.col(f"{b}.lon"))
    alias = F.array_contains(f"{b}.aliases", x) | F.array_contains(f"{a}.aliases", y)
    return F.when((dlat < 0.1) & (dlon < 0.1) & contains_either(x, y), "near_contained").when(word_overlap(x, y) > 0.8, "words").when(alias, "alias")


def fuzzy_pairs(cls: DataFrame) -> DataFrame:
    """Duplicate pairs by the native reasons or by similarity; similarity is only computed where
    no native reason holds."""
    pairs = candidate_pairs(cls).withColumn("reason", native_reason())
    rest = pairs.where("reason is null").withColumn("ratio", seq_ratio("a.low", "b.low"))
    near = (F.abs(F.col("a.lat") - F.col("b.lat")) < 0.01) & (F.abs(F.col("a.lon") - F.col("b.lon")) < 0.01)
    rest = rest.where((F.col("ratio") > 0.85) | (near & (F.col("ratio") > 0.6))).select("id_a", "id_b", F.lit("similar").alias("reason"))
    return pairs.where("reason is not null").select("id_a", "id_b", "reason").unionByName(rest)


def star_clusters(cls: DataFrame, most_rounds: int = 10_000) -> DataFrame:
    """``class_id`` and ``seed``: taken in id order, each class that no earlier seed claims becomes
    a seed and claims its duplicates; members match their seed, not each other.

    Whole cells never meet in one task: in every round the classes without an undecided earlier
    neighbour are seeds, their neighbours are members, and the decided edges drop out.
    """
    pairs = cut(fuzzy_pairs(cls).select("id_a", "id_b"))
    open_, members = pairs, None
    for _ in range(most_rounds):
        heads = open_.select(F.col("id_a").alias("h")).distinct().join(open_.select(F.col("id_b").alias("h")), "h", "left_anti")
        lost = cut(open_.join(heads, open_.id_a == heads.h, "left_semi").select(F.col("id_b").alias("class_id")).distinct())
        members = lost if members is None else members.unionByName(lost)
        open_ = cut(open_.join(lost, open_.id_b == lost.class_id, "left_anti").join(lost, F.col("id_a") == F.col("class_id"), "left_anti"))
        if open_.isEmpty():
            break
    else:
        raise RuntimeError(f"no fixpoint in {most_rounds} rounds")
    seeds = cls.select("class_id").join(members, "class_id", "left_anti")
    claimed = pairs.join(members, pairs.id_b == members.class_id, "left_semi").join(seeds, pairs.id_a == seeds.class_id, "left_semi").groupBy(F.col("id_b").alias("class_id")).agg(F.min("id_a").alias("seed"))
    return seeds.select("class_id", F.col("class_id").alias("seed")).unionByName(claimed)


def score() -> Column:
    return completeness({"lat": F.col("location.lat"), "commodities": F.col("commodities"), "mentions": F.col("company_mentions"), "aliases": F.col("aliases"), "status": F.col("status"), "confidence": F.col("verification.confidence"), "verified": F.col("verification.status")})


def best_records(facility: DataFrame, group: str) -> DataFrame:
    """The most complete record of each group, ties to the least rec_id; an aggregate, so groups
    may be of any size."""
    order = F.struct(F.round(score(), 6), -F.col("rec_id"))
    return facility.where(F.col(group).isNotNull()).groupBy(group).agg(F.max_by("rec_id", order).alias("rec_id"), F.round(F.max(score()), 4).alias("score"), F.count("*").alias("n_records"))


def merged_aliases(facility: DataFrame, group: str) -> DataFrame:
    """Per group the sorted union of names and aliases without the best record's name."""
    best = best_records(facility, group).join(facility.select("rec_id", F.col("name").alias("best_name")), "rec_id").select(group, "best_name")
    names = facility.select(group, F.explode(F.concat(F.coalesce("aliases", F.array().cast("array<string>")), F.array("name"))).alias("alias")).where("alias is not null and trim(alias) <> ''").distinct()
    kept = names.join(best, group).where("alias <> best_name")
    return kept.groupBy(group).agg(F.array_join(F.array_sort(F.collect_set("alias")), "|").alias("aliases"))


def merged_sources(facility: DataFrame, group: str) -> DataFrame:
    """Per group the sources distinct by type and id, the first seen (least rec_id, position) kept."""
    rows = facility.where(F.col(group).isNotNull()).select(group, "rec_id", F.posexplode("sources").alias("pos", "s"))
    return rows.groupBy(group, F.col("s.type").alias("type"), F.col("s.id").alias("id")).agg(F.min_by("s.url", F.struct("rec_id", "pos")).alias("url"), F.count("*").alias("n_seen"))


def merged_commodities(facility: DataFrame, group: str) -> DataFrame:
    """Per group and metal (case ignored) one commodity: the last that has a formula, else the first."""
    rows = facility.where(F.col(group).isNotNull()).select(group, "rec_id", F.posexplode("commodities").alias("pos", "c")).where("trim(c.metal) <> ''")
    order = F.struct("rec_id", "pos")
    formula = F.max_by("c.chemical_formula", F.when(F.col("c.chemical_formula").isNotNull(), order))
    return rows.groupBy(group, F.lower(F.trim("c.metal")).alias("metal")).agg(formula.alias("chemical_formula"), F.bool_or(F.coalesce("c.is_primary", F.lit(False))).alias("is_primary"))


def merged_mentions(facility: DataFrame, group: str) -> DataFrame:
    """Per group and company name the mention of the greatest confidence, of equals the first."""
    rows = facility.where(F.col(group).isNotNull()).select(group, "rec_id", F.posexplode("company_mentions").alias("pos", "m")).where("trim(m.name) <> ''")
    order = F.struct(F.coalesce("m.confidence", F.lit(-1.0)).alias("c"), (-F.col("rec_id")).alias("r"), (-F.col("pos")).alias("p"))
    return rows.groupBy(group, F.trim("m.name").alias("name")).agg(F.max_by("m.role", order).alias("role"), F.max("m.confidence").alias("confidence"))


def without_losers(facility: DataFrame, group: str) -> DataFrame:
    """The best record of each group and all records without a group key."""
    best = best_records(facility, group).select("rec_id")
    return facility.join(best, "rec_id", "left_semi").unionByName(facility.where(F.col(group).isNull()))


def rarest(keys: DataFrame, id_: list[str], key: str, most: Column, counts: DataFrame) -> DataFrame:
    """Of every id's distinct ``key`` values the ``most`` rarest ones (an expression over ``n``,
    their number).  Two sides that are joined on them need the same ``counts``
    (:func:`frequencies`), so that both agree which are rare.  A list is as long as a name has parts."""
    lists = keys.join(counts, key).groupBy(*id_).agg(F.array_sort(F.collect_list(F.struct("_f", key))).alias("_l")).withColumn("n", F.size("_l"))
    return lists.select(*id_, F.explode(F.slice("_l", F.lit(1), most.cast("int"))[key]).alias(key))


def frequencies(key: str, *sides: DataFrame) -> DataFrame:
    """How often each ``key`` occurs on all sides together, as ``_f``."""
    both = sides[0].select(key)
    for other in sides[1:]:
        both = both.unionByName(other.select(key))
    return both.groupBy(key).agg(F.count("*").alias("_f"))


#: So many new names of a country are compared with 16 times as many old ones at once.
PART = 4096
#: Up to so many words the sets of words of a name are listed.
SUBSETS = 8


def subsets(words: Column, fits: Callable[[Column, Column], Column]) -> Column:
    """The sets that can be made of a name's sorted words and whose size ``fits`` the number of its
    words, as sorted arrays.  For at most ``SUBSETS`` words, so there are at most 255."""
    n = F.size(words)
    masks = F.filter(F.sequence(F.lit(1), (F.pow(2, n) - 1).cast("int")), lambda m: fits(F.bit_count(m), n))
    return F.transform(masks, lambda m: F.filter(words, lambda w, i: F.getbit(m, i) == 1))


def _signs(text: str) -> np.ndarray:
    """What a text holds, as bits: each letter (32 classes) at least once, twice, three and four
    times.  Two texts have no more letters in common than bits, but for letters met more often."""
    bits, times = np.zeros((4, 32), np.float32), Counter(ord(c) % 32 for c in text)
    for at, n in times.items():
        bits[:n, at] = 1
    return np.append(bits.ravel(), sum(n - 4 for n in times.values() if n > 4)).astype(np.float32)


def _similar(news: list[str], olds: list[str], least: float = 0.85, block: int = 2048) -> Iterator[tuple[str, str]]:
    """All pairs of a new and an old text whose similarity exceeds ``least``.

    A matrix product bounds the letters in common from above; a bit-parallel longest common
    subsequence bounds them nearer, of many pairs at once; what is left is compared in full.
    """
    news, olds = sorted(news, key=len), sorted(olds, key=len)
    sizes = np.array([len(x) for x in olds])
    signs = np.array([_signs(x) for x in olds]).reshape(len(olds), 129)
    for s in range(0, len(news), block):
        part = news[s : s + block]
        # 2 * shorter / (both) must exceed the least, too
        lo, hi = len(part[0]) * least / (2 - least) - 1, len(part[-1]) * (2 - least) / least + 1
        own, n = np.array([_signs(x) for x in part]), np.array([len(x) for x in part])
        for t in range(int(np.searchsorted(sizes, lo)), int(np.searchsorted(sizes, hi, "right")), block):
            m = sizes[t : min(t + block, int(np.searchsorted(sizes, hi, "right")))]
            other = signs[t : t + len(m)]
            held = own[:, :128] @ other[:, :128].T
            held += np.minimum(own[:, 128:], other[:, 128])
            i, j = np.nonzero(2 * held > np.float32(least) * (n[:, None] + m) - 0.01)
            for at in range(0, len(i), 200_000):
                x, y = i[at : at + 200_000], j[at : at + 200_000]
                kept = 2 * _subsequence(part, x, olds, y + t) > least * (n[x] + m[y]) - 1e-6
                for p, q in zip(x[kept], y[kept]):
                    if SequenceMatcher(None, part[p], olds[q + t]).ratio() > least:
                        yield part[p], olds[q + t]


def _subsequence(a: list[str], i: np.ndarray, b: list[str], j: np.ndarray) -> np.ndarray:
    """At least the length of the longest common subsequence of a[i] and b[j]; texts over 63
    letters count as equal.  Letters are told apart by 64 classes."""
    long = np.array([len(x) > 63 for x in a])[i] | np.array([len(b[y]) > 63 for y in j], bool)
    rows, at = np.unique(i, return_inverse=True)
    where = np.zeros((len(rows), 64), np.uint64)
    for r, x in enumerate(rows):
        for k, c in enumerate(a[x][:63]):
            where[r, ord(c) % 64] |= np.uint64(1 << k)
    cols, to = np.unique(j, return_inverse=True)
    width = max((min(len(b[y]), 63) for y in cols), default=0)
    codes = np.full((len(cols), width), -1, np.int8)
    for r, y in enumerate(cols):
        codes[r, : min(len(b[y]), 63)] = [ord(c) % 64 for c in b[y][:63]]
    v = np.full(len(i), ~np.uint64(0))
    for k in range(width):
        c = codes[to, k]
        u = v & np.where(c >= 0, where[at, c], np.uint64(0))
        v = (v + u) | (v - u)
    return np.where(long, 1 << 20, np.bitwise_count(~v).astype(np.int64))


def _similar_pairs(key: tuple, news: pd.DataFrame, olds: pd.DataFrame) -> pd.DataFrame:
    found = [(key[0], x, y) for x, y in _similar(list(news["low"]), list(olds["other"]))] if len(news) and len(olds) else []
    return pd.DataFrame(found, columns=["country", "low", "other"])


def _name_pairs(new: DataFrame, old: DataFrame, similar: bool) -> DataFrame:
    """Pairs (country, low, other) of a new and an old name that share more than 0.8 of the words
    of the shorter one or, with ``similar``, have a similarity above 0.85.

    Words: a name whose words nearly all occur in another shares one of its rarest words with it.
    Similarity: letter pairs are too common to join on, so the names of a country are dealt into
    parts, and each two parts are compared in blocks that form no rows (:func:`_similar`).  An empty
    name is similar to nothing.
    """
    words = lambda c: F.array_distinct(F.filter(F.split(c, r"\s+"), lambda w: w != ""))
    names = [d.select("country", "low").where("low is not null").distinct() for d in (new, old)]
    n, o = (d.select("country", "low", F.explode(words(F.col("low"))).alias("w")) for d in names)
    short = F.ceil(F.col("n") * 0.2)
    by, counts = ["country", "w"], frequencies("w", n, o)
    pairs = rarest(n, ["country", "low"], "w", short, counts).join(o.withColumnRenamed("low", "other"), by).select("country", "low", "other")
    pairs = pairs.unionByName(n.join(rarest(o, ["country", "low"], "w", short, counts).withColumnRenamed("low", "other"), by).select("country", "low", "other")).distinct()
    found = pairs.where(word_overlap(F.col("low"), F.col("other")) > 0.8)
    if not similar:
        return found
    # a task has one core: threads of matrix products of all tasks would stand in each other's way
    new.sparkSession.sparkContext.environment.setdefault("OPENBLAS_NUM_THREADS", "1")
    full = [cut(d.where("low <> ''")) for d in names]
    counts = [d.groupBy("country").agg(F.ceil(F.count("*") / size).cast("int").alias(k)) for d, size, k in zip(full, (PART, 16 * PART), ("kn", "ko"))]
    grid = counts[0].join(counts[1], "country")
    every = lambda k: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(k).cast("bigint") - 1))
    dealt = full[0].join(grid, "country").select("country", "low", F.pmod(F.xxhash64("low"), "kn").alias("pn"), every("ko").alias("po"))
    met = full[1].join(grid, "country").select("country", F.col("low").alias("other"), every("kn").alias("pn"), F.pmod(F.xxhash64("low"), "ko").alias("po"))
    # a number of partitions given by hand: few bytes make much work here
    cells = [d.repartition(4 * slots(new.sparkSession), "country", "pn", "po").groupBy("country", "pn", "po") for d in (dealt, met)]
    close = cells[0].cogroup(cells[1]).applyInPandas(_similar_pairs, "country string, low string, other string")
    return found.unionByName(close).distinct()


def import_matches(new: DataFrame, old: DataFrame, similar: bool = True) -> DataFrame:
    """For each new record the existing one of its country that it duplicates: ``rec_id``,
    ``existing_rec_id`` and ``priority``, the first that holds of

    0. the same facility_id;
    1. within 0.01 degrees and names similar (above 0.6) or one in the other, or within 0.1 degrees
       and very similar (above 0.85) or one in the other;
    2. the same name, within 0.01 degrees unless one of them has no position (zero counts as none);
    3. names very similar, or with more than 0.8 of the words of the shorter one;
    4. a name or alias of one is an alias of the other.

    Case is ignored; within a priority the least rec_id counts.  ``similar=False`` leaves out the
    similarity of 1 and 3.  Records without a name match by id or alias only.
    """
    lat, lon = F.col("location.lat"), F.col("location.lon")
    lists = lambda c: F.filter(F.coalesce(F.transform(c, F.lower), F.array().cast("array<string>")), lambda a: a.isNotNull() & (a != ""))
    side = lambda d, p: d.select(F.col("rec_id").alias(f"{p}id"), "facility_id", F.coalesce("country_iso3", F.lit("")).alias("country"), F.lower("name").alias("low"), lat.alias(f"{p}lat"), lon.alias(f"{p}lon"), lists(F.col("aliases")).alias("al"))
    n, o = side(new, "n"), side(old, "o")
    least = F.min("oid").alias("oid")
    hit = lambda d, p: d.groupBy("nid").agg(least).withColumn("priority", F.lit(p))
    by_id = hit(n.select("nid", "facility_id").join(o.groupBy("facility_id").agg(least), "facility_id"), 0)

    # neighbours: equal records collapse first, the old ones stand in their own cell and the eight around
    def near(size: float, keys: list[str]) -> DataFrame:
        at = lambda c: F.floor(F.col(c) / size).cast("int")
        around = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
        a = n.where("low is not null").groupBy("country", "low", "nlat", "nlon").agg(F.min("nid").alias("any")).drop("any").withColumns({"ca": at("nlat"), "co": at("nlon")})
        b = o.where("low is not null").groupBy("country", F.col("low").alias("other"), "olat", "olon").agg(least).withColumn("d", F.explode(around)).withColumns({"ca": at("olat") + F.col("d.i"), "co": at("olon") + F.col("d.j")}).drop("d")
        if "low" in keys:
            b = b.withColumn("low", F.col("other"))
        close = (F.abs(F.col("nlat") - F.col("olat")) < size) & (F.abs(F.col("nlon") - F.col("olon")) < size)
        return a.join(b, ["country", "ca", "co", *keys]).where(close)

    pairs = near(0.1, [])
    fits = contains_either(F.col("low"), F.col("other"))
    if similar:
        tight = (F.abs(F.col("nlat") - F.col("olat")) < 0.01) & (F.abs(F.col("nlon") - F.col("olon")) < 0.01)
        pairs = pairs.withColumn("ratio", F.when(~fits, seq_ratio("low", "other")))
        fits = fits | (F.col("ratio") > 0.85) | (tight & (F.col("ratio") > 0.6))
    placed = pairs.where(fits).groupBy("country", "low", "nlat", "nlon").agg(least)
    by_place = hit(n.join(placed, ["country", "low", "nlat", "nlon"]), 1)

    missing = lambda p: F.coalesce((F.col(f"{p}lat") == 0) | (F.col(f"{p}lon") == 0), F.lit(True))
    named = o.where("low is not null").groupBy("country", "low").agg(least, F.min(F.when(missing("o"), F.col("oid"))).alias("bare"))
    loose = n.join(named, ["country", "low"]).select("nid", F.when(missing("n"), F.col("oid")).otherwise(F.col("bare")).alias("oid")).where("oid is not null")
    same = near(0.01, ["low"]).where(~missing("n") & ~missing("o")).groupBy("country", "low", "nlat", "nlon").agg(least)
    by_name = hit(loose.unionByName(n.join(same, ["country", "low", "nlat", "nlon"]).select("nid", "oid")), 2)

    close = _name_pairs(n, o, similar).join(named.select("country", F.col("low").alias("other"), "oid"), ["country", "other"]).groupBy("country", "low").agg(least)
    by_words = hit(n.join(close, ["country", "low"]), 3)

    tokens = lambda d: d.select("*", F.explode(F.concat(F.transform("al", lambda a: F.struct(a.alias("t"), F.lit(True).alias("alias"))), F.array(F.struct(F.col("low").alias("t"), F.lit(False).alias("alias"))))).alias("x")).where("x.t <> ''")
    held = tokens(o).groupBy("country", "x.t").agg(F.min(F.when(F.col("x.alias"), F.col("oid"))).alias("as_alias"), least)
    own = tokens(n).select("nid", "country", "x.*").join(held, ["country", "t"])
    by_alias = hit(own.select("nid", F.when(F.col("alias"), F.col("oid")).otherwise(F.col("as_alias")).alias("oid")).where("oid is not null"), 4)
    every = by_id.unionByName(by_place).unionByName(by_name).unionByName(by_words).unionByName(by_alias)
    return every.groupBy(F.col("nid").alias("rec_id")).agg(F.min(F.struct("priority", "oid")).alias("b")).select("rec_id", F.col("b.oid").alias("existing_rec_id"), F.col("b.priority").alias("priority"))


def disambiguated(df: DataFrame, slug: Column, suffixes: list[Column], id_: str) -> DataFrame:
    """``id_`` and its ``unique_slug``: of the holders of a slug the least id keeps it; the others
    try one suffix after the other (region, geohash, ...) until they are the least to claim a slug
    that nobody holds, and end with a short hash of the id.

    Each step is two aggregations over slugs; nothing is ordered globally.  Blank suffixes are
    skipped.
    """
    tail = F.concat(F.lit("-"), F.substring(F.sha2(F.col(id_).cast("string"), 256), 1, 10))
    # every step is read by the next ones, so it is materialised; most ids are settled by the first
    open_ = cut(df.select(F.col(id_), slug.alias("slug"), *(s.alias(f"s{i}") for i, s in enumerate(suffixes))))
    least = lambda d: d.groupBy("try").agg(F.min(id_).alias("_owner"))
    slugs = least(open_.select(F.col("slug").alias("try"), id_))
    ranked = open_.join(slugs, open_["slug"] == slugs["try"]).drop("try")
    held = ranked.where(F.col(id_) == F.col("_owner")).select(id_, F.col("slug").alias("try"))
    open_ = cut(ranked.where(F.col(id_) != F.col("_owner")).drop("_owner"))
    taken = slugs.select("try")
    for i in range(len(suffixes)):
        claims = open_.withColumn("try", F.when(F.col(f"s{i}") != "", F.concat_ws("-", "slug", f"s{i}")))
        first = cut(least(claims.where("try is not null")).join(taken, "try", "left_anti")).select("try", F.col("_owner").alias(id_))
        held, taken = held.unionByName(first), taken.unionByName(first.select("try"))
        open_ = open_.join(first.select(id_), id_, "left_anti")
    return held.select(id_, F.col("try").alias("unique_slug")).unionByName(open_.select(id_, F.concat("slug", tail).alias("unique_slug")))


def dedupe_summary(facility: DataFrame, group: str) -> DataFrame:
    """One row: records, groups of two or more, records in them, and how many would be removed."""
    sizes = facility.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("n"))
    many = sizes.agg(F.count_if(F.col("n") > 1).alias("groups"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("in_groups"))
    return facility.agg(F.count("*").alias("records")).crossJoin(many).withColumn("removed", F.col("in_groups") - F.col("groups"))
