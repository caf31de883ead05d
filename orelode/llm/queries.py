"""Queries of this subpackage over the driver's tables, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orelode.llm import mixing, names, packing, sites, survivors, terms, tokens, toxicity
from orelode.plans.runtime import cut, table


def _names(spark: SparkSession, d: str) -> DataFrame:
    mentions = table(spark, d, "facility").select(F.explode("company_mentions.name").alias("name"))
    return mentions.unionByName(table(spark, d, "facility_company_relationships").select(F.col("company_name").alias("name")))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return names.name_pairs(_names(spark, d))


def p1_entities(spark: SparkSession, d: str) -> DataFrame:
    """Every linked spelling with its entity and its number of direct links."""
    links = cut(names.name_links(_names(spark, d)))
    ends = links.select("name").unionByName(links.select(F.col("hub").alias("name"))).groupBy("name").agg(F.count("*").alias("links"))
    groups = names.components(links, "name", "hub").select(F.col("node").alias("name"), F.col("component").alias("entity"))
    return groups.join(ends, "name")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return terms.map_records(table(spark, d, "facility"), table(spark, d, "canonical_term"))


def p3_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Values that no entry is close to, with the number of rows that hold them."""
    facility, term = table(spark, d, "facility"), table(spark, d, "canonical_term")
    values = terms.facility_values(facility).groupBy("field_name", "raw").agg(F.count("*").alias("rows"))
    mapped = terms.map_values(values, term).where(F.col("canonical") == terms.UNMATCHED)
    return values.join(mapped.select("field_name", "raw"), ["field_name", "raw"])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.facility_survivors(table(spark, d, "facility"))


def p4_merged(spark: SparkSession, d: str) -> DataFrame:
    return survivors.merged(table(spark, d, "facility"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return sites.site_pairs(table(spark, d, "facility"), table(spark, d, "country_ref"))


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    """Every id that shares its site, with the least id of the site and the number of ids."""
    g = cut(sites.site_groups(table(spark, d, "facility"), table(spark, d, "country_ref")))
    head = g.groupBy("site").agg(F.min("facility_id").alias("site_id"), F.count("*").alias("n_ids"))
    return g.join(head, "site").select("facility_id", "site_id", "n_ids")


def _counted(spark: SparkSession, d: str) -> DataFrame:
    return cut(tokens.with_counts(table(spark, d, "documents"), ["doc_id", "source"]))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(_counted(spark, d), "doc_id", "n_tokens", table(spark, d, "container_spec"))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p8_containers(spark, d), table(spark, d, "container_spec"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(_counted(spark, d), table(spark, d, "mix_target"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(_counted(spark, d), table(spark, d, "mix_target"))[1]


def p9_shares_once(spark: SparkSession, d: str) -> DataFrame:
    """Shares of mixes as large as their sources are, what short sources lack passed on."""
    return mixing.mix(_counted(spark, d), table(spark, d, "mix_target"), total=0, redistribute=True)[1]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    scored = toxicity.score_documents(table(spark, d, "documents"), table(spark, d, "doc_label"), ["doc_id"], spans=False)
    return scored.where("toxic").select("doc_id")


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    """Every document's score and how many offending spans it has."""
    scored = toxicity.score_documents(table(spark, d, "documents"), table(spark, d, "doc_label"), ["doc_id", "source"])
    return scored.select("doc_id", "source", F.round("score", 4).alias("score"), "toxic", F.size("spans").alias("n_spans"), "spans")


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    """Per source: documents, toxic ones and their share."""
    scored = toxicity.score_documents(table(spark, d, "documents"), table(spark, d, "doc_label"), ["source"], spans=False)
    label = mixing.source_label(F.col("source"))
    return scored.groupBy(label.alias("source")).agg(F.count("*").alias("documents"), F.count_if("toxic").alias("toxic"), F.round(F.avg(F.col("toxic").cast("int")), 6).alias("rate"), F.round(F.avg("score"), 6).alias("mean_score"))


QUERIES = {f.__name__: f for f in (p1_found, p1_entities, p3_found, p3_unmatched, p4_found, p4_merged, p5_found, p5_groups, p8_containers, p8_fill, p9_mix, p9_shares, p9_shares_once, p10_found, p10_scores, p10_rates)}

USABLE = "list_filter(list_distinct(list_transform({0}, lambda x: lower(trim(regexp_replace({1}, '\\s+', ' ', 'g'))))), lambda x: x IS NOT NULL AND x NOT IN (" + ", ".join(f"'{p}'" for p in survivors.PLACEHOLDERS) + "))"
_FIELDS = " UNION ALL ".join(f"SELECT facility_id, rec_id, verification, '{f}' AS field_name, len({USABLE.format(f, 'x' if part is None else 'x.' + part)}) AS n FROM facility" for f, part in survivors.ITEM.items())
ORACLES: dict[str, str] = {
    # the orders agree, so the most trusted row is also the latest and the fullest
    "p4_found": f"""WITH u AS ({_FIELDS}), g AS (SELECT facility_id FROM facility WHERE facility_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
 SELECT facility_id, field_name, arg_max(rec_id, (CASE verification.status {" ".join(f"WHEN '{t}' THEN {len(survivors.TRUST) - i}" for i, t in enumerate(survivors.TRUST))} ELSE 0 END, coalesce(verification.confidence, -1), n, -rec_id)) AS rec_id
 FROM u JOIN g USING (facility_id) WHERE n > 0 GROUP BY 1, 2""",
}
