"""Company mentions resolved to known companies, gated, and written as relationships."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orelode.functions import fixed
from orelode.functions.text import matchable, slugify
from orelode.operators.dedupe import SUBSETS, frequencies, rarest, subsets
from orelode.operators.spatial import haversine_km

ROLES = ("operator", "owner", "majority_owner", "minority_owner")


def words(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(matchable(c), r"[\s\-]+"), lambda w: w != ""))


def mentioned(facility: DataFrame) -> DataFrame:
    """``rec_id``, ``facility_id``, ``name``, ``role``, ``lat``, ``lon`` of the mentions that can
    become relationships: an unknown or missing role counts as operator, other roles than those of
    operators and owners and blank names are left out.  A zero or missing position is null."""
    role = F.lower(F.trim("m.role"))
    role = F.when(F.coalesce(role, F.lit("unknown")).isin("unknown", ""), "operator").otherwise(role)
    point = (F.col("location.lat") != 0) & (F.col("location.lon") != 0)
    rows = facility.select("rec_id", "facility_id", F.explode("company_mentions").alias("m"), *(F.when(point, F.col(f"location.{c}")).alias(c) for c in ("lat", "lon")))
    rows = rows.select("rec_id", "facility_id", F.trim("m.name").alias("name"), role.alias("role"), "lat", "lon")
    return rows.where((F.col("name") != "") & F.col("role").isin(*ROLES))


def best_companies(names: DataFrame, companies: DataFrame, least: float = 70.0) -> DataFrame:
    """``name``, ``company_id``, ``company_name``, ``score`` (0-100), ``hq_lat``, ``hq_lon``: for each
    distinct name the company of the greatest score of at least ``least``, ties to the least id.

    The score is the share of words two names have in common (Dice).  No pairs are made: both sides
    are exploded to the sets of words they could share, of equal sets of a number of words only the
    least id is kept, and names look their sets up.  A set smaller than what two names share scores
    less than the whole of it, so it changes no maximum.  Names of more than ``SUBSETS`` words join
    on their rarest words.  ``companies``: company_id, company_name, hq_lat, hq_lon; names without
    words resolve to nothing.
    """
    dice = lambda o, p, q: F.round(200.0 * o / (p + q), 4)
    sized = lambda d: d.where(F.size("a") > 0).withColumn("n", F.size("a"))
    named = names.select("name").where(F.length(F.trim("name")) > 0).distinct().select("name", F.array_sort(words(F.col("name"))).alias("a"))
    known = companies.where("company_id is not null").select("company_id", "company_name", "hq_lat", "hq_lon", F.array_sort(words(F.col("company_name"))).alias("a"))
    left = sized(named.select("a").distinct())
    right = sized(known.groupBy("a").agg(F.min("company_id").alias("company_id")))

    # the other name has at least the words of a set, so a set that is too small even then is left out
    enough = lambda o, n: dice(o, n, o) >= least
    sets = lambda d: d.where(F.col("n") <= SUBSETS).withColumn("s", F.explode(subsets(F.col("a"), enough)))
    firms = sets(right).groupBy("s", F.col("n").alias("m")).agg(F.min("company_id").alias("company_id"))
    scored = sets(left).join(firms, "s").select("a", "company_id", dice(F.size("s"), F.col("n"), F.col("m")).alias("score"))

    # long names: a name of n words has partners of at least n * share words and leaves few of its own unshared
    share = least / (200 - least)
    few = F.floor(F.col("n") * (1 - share) + 1e-9) + 1
    other = right.select("company_id", F.col("a").alias("b"), F.col("n").alias("m"))
    for p, q in ((F.col("n") > SUBSETS, F.col("m") > SUBSETS * share), ((F.col("n") > SUBSETS * share) & (F.col("n") <= SUBSETS), F.col("m") > SUBSETS)):
        x, y = left.where(p), other.where(q)
        wx, wy = x.select("a", F.explode("a").alias("w")), y.select("company_id", "b", F.explode("b").alias("w"))
        counts = frequencies("w", wx, wy)
        pairs = rarest(wx, ["a"], "w", few, counts).join(rarest(wy, ["company_id", "b"], "w", few, counts), "w").select("a", "company_id", "b").distinct()
        scored = scored.unionByName(pairs.select("a", "company_id", dice(F.size(F.array_intersect("a", "b")), F.size("a"), F.size("b")).alias("score")))
    best = scored.where(F.col("score") >= least).groupBy("a").agg(F.min(F.struct((-F.col("score")).alias("s"), "company_id")).alias("b")).select("a", "b.company_id", (-F.col("b.s")).alias("score"))

    # an id may have several names: the least of those with this score
    rows = best.join(known.withColumnRenamed("a", "b"), "company_id").where(dice(F.size(F.array_intersect("a", "b")), F.size("a"), F.size("b")) == F.col("score"))
    rows = rows.groupBy("a").agg(F.min(F.struct("company_id", "company_name", "hq_lat", "hq_lon")).alias("c"), F.max("score").alias("score"))
    return named.join(rows, "a").select("name", "c.company_id", "c.company_name", "score", "c.hq_lat", "c.hq_lon")


def resolved(mentions: DataFrame, best: DataFrame, gates: tuple[float, float] = fixed.GATES["moderate"]) -> DataFrame:
    """Mentions with ``company_id``, ``confidence`` and ``gate``.

    The confidence is the score in hundredths, plus 0.10 if the company's seat is within 10 km of
    the site and 0.05 within 100 km, at most 1.  At ``gates[0]`` it is accepted, at ``gates[1]`` to
    be reviewed, else, and without a company, pending.
    """
    km = haversine_km(F.col("lat"), F.col("lon"), F.col("hq_lat"), F.col("hq_lon"))
    boost = F.when(km < 10, 0.10).when(km < 100, 0.05).otherwise(0.0)
    rows = mentions.join(best, "name", "left").withColumn("boost", boost)
    rows = rows.withColumn("confidence", F.when(F.col("score").isNotNull(), F.round(F.least(F.lit(1.0), F.col("score") / 100 + F.col("boost")), 3)))
    gate = F.when(F.col("confidence") >= gates[0], "auto_accept").when(F.col("confidence") >= gates[1], "review").otherwise("pending")
    said = F.when(F.col("score") >= 95, "Exact name match").when(F.col("score") >= 85, "Strong name match").when(F.col("score").isNotNull(), "Fuzzy name match")
    said = F.when(F.col("boost") > 0, F.concat(said, F.lit("; proximity boost +"), F.format_string("%.2f", "boost"))).otherwise(said)
    return rows.withColumns({"gate": gate, "explanation": said}).drop("hq_lat", "hq_lon")


def relationships(rows: DataFrame) -> DataFrame:
    """One relationship for each accepted site, company and role, of several mentions the surest;
    the id is a hash of the three, so reruns find their rows again."""
    kept = rows.where("gate = 'auto_accept'").groupBy("facility_id", "company_id", "role").agg(F.max("confidence").alias("confidence"), F.min("company_name").alias("company_name"))
    return kept.select(F.sha2(F.concat_ws("|", F.coalesce("facility_id", F.lit("")), "company_id", "role"), 256).alias("relationship_id"), "facility_id", "company_id", "company_name", "role", "confidence")


def operators(rows: DataFrame) -> DataFrame:
    """``rec_id`` and the accepted ``operator_id`` of greatest confidence (ties to the least id)."""
    kept = rows.where("gate = 'auto_accept' and role = 'operator'")
    return kept.groupBy("rec_id").agg(F.min(F.struct((-F.col("confidence")).alias("c"), "company_id")).alias("b")).select("rec_id", F.col("b.company_id").alias("operator_id"))


def linked(facility: DataFrame, rows: DataFrame) -> DataFrame:
    """``rec_id``, the accepted ``operator_id`` of greatest confidence (ties to the least id) and the
    sorted distinct ``owner_ids``; records without an accepted company have null and none."""
    kept = rows.where("gate = 'auto_accept'")
    owners = kept.where("role <> 'operator'").select("rec_id", "company_id").distinct().groupBy("rec_id").agg(F.array_join(F.array_sort(F.collect_list("company_id")), "|").alias("owner_ids"))
    return facility.select("rec_id").join(operators(rows), "rec_id", "left").join(owners, "rec_id", "left").select("rec_id", "operator_id", F.coalesce("owner_ids", F.lit("")).alias("owner_ids"))


def enrichment_stats(facility: DataFrame, rows: DataFrame) -> DataFrame:
    """One row: records, those with mentions, mentions by gate, resolved ones and relationships."""
    by_gate = rows.agg(
        F.count("*").alias("mentions"), F.count("company_id").alias("resolved"), *(F.count_if(F.col("gate") == g).alias(g) for g in ("auto_accept", "review", "pending")),
        F.countDistinct("rec_id").alias("records_with_mentions"), F.countDistinct(F.when(F.col("gate") == "auto_accept", F.struct(F.coalesce("facility_id", F.lit("")), "company_id", "role"))).alias("relationships"),
    )
    return facility.agg(F.count("*").alias("records")).crossJoin(by_gate)


def canonical_names(names: DataFrame, aliases: DataFrame) -> DataFrame:
    """``name`` and its ``canonical``: what ``aliases`` (alias, canonical) says, without regard to case
    and outer blanks, else the name itself.  An alias listed twice takes the least canonical."""
    known = aliases.where("alias is not null").groupBy(F.lower(F.trim("alias")).alias("_key")).agg(F.min("canonical").alias("_to"))
    return names.withColumn("_key", F.lower(F.trim("name"))).join(known, "_key", "left").select("name", F.coalesce("_to", "name").alias("canonical"))


def merged_mentions(own: Column, added: Column, force: bool = False) -> Column:
    """Mentions of a record after a backfill from a listing: only where it has none, or with
    ``force`` those whose names (case ignored) it lacks are appended."""
    none = F.size(F.coalesce(own, F.array().cast("array<string>"))) <= 0
    low = F.transform(own, lambda x: F.lower(x))
    fresh = F.filter(added, lambda x: ~F.coalesce(F.array_contains(low, F.lower(x)), F.lit(False)))
    return F.when(none, added).otherwise(F.concat(own, fresh) if force else own)


def listed_companies(text: Column) -> Column:
    """Distinct (case ignored) names of a text separated by semicolons; all of them are companies."""
    parts = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")
    low = F.transform(parts, lambda x: F.lower(x))
    return F.filter(parts, lambda x, i: F.array_position(low, F.lower(x)) == i + 1)


def company_slug(name: Column) -> Column:
    return F.concat(F.lit("cmp-"), slugify(name))
