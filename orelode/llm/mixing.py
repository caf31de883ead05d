"""Sources mixed to target shares of tokens, by hash-threshold histograms.

Every document has a fixed 60-bit hash.  Tokens are summed by source and hash bucket; from the
cumulated histogram follows, for each mix and source, the bucket in which its budget ends.  Only
those boundary buckets are summed again, more finely, until a bucket cannot be cut further.  The
result is one threshold a mix and source, and the mix itself a plain filter: documents below the
threshold occur once more than the others.  Nothing is sorted, thresholds of several mixes over
one source are nested, and only one boundary bucket a mix and source reaches the driver.

A mix's total is the largest at which every source that has documents holds its share; or
``total`` tokens; or with ``total=0`` the tokens its sources hold once.  Then a source that falls
short of its share even when every document is repeated ``max_repeats`` times gives all it has,
and what it lacks is passed on to the others in proportion to their targets while they have room
only if ``redistribute``; otherwise the mix is that much smaller and the report shows it.

Defined results: source labels are compared without case and outer blanks, ``-`` as ``_``; sources
without documents are reported with 0; documents of other sources, null sources and documents
without tokens are left out; exact copies under other ids are documents of their own.  The share
reached differs from the target by less than one document.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window, functions as F


BITS = (12, 16, 16, 16)  # of the hash, level by level
TOP = 1 << sum(BITS)


def source_label(c: Column) -> Column:
    return F.translate(F.lower(F.trim(c)), "-", "_")


def _hash(doc_id: str, seed: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id)), 64 - sum(BITS))


def plan(counts: DataFrame, targets: list, total: int | None, redistribute: bool) -> tuple[list[dict], dict]:
    """Per mix and source: full passes and the token budget of the partial one."""
    # only sources of the targets, whose number is bounded, reach the driver
    asked = counts.sparkSession.createDataFrame([(s,) for s in sorted({t["source"] for t in targets if t["source"] is not None})], "source string")
    sums = counts.join(F.broadcast(asked), "source", "left_semi").groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    have = {r["source"]: r["tokens"] for r in sums.collect()}
    mixes = defaultdict(list)
    for t in targets:
        mixes[t["mix_name"]].append(t)
    jobs = []
    for mix, rows in sorted(mixes.items()):
        cap = {r["source"]: have.get(r["source"], 0) * max(0, r["max_repeats"] or 0) for r in rows}
        held = [cap[r["source"]] / r["target_share"] for r in rows if cap[r["source"]] and r["target_share"]]
        size = sum(have.get(r["source"], 0) for r in rows) if total == 0 else total or int(min(held, default=0))
        want = {r["source"]: r["target_share"] * size for r in rows}
        if redistribute:
            for _ in rows:
                lack = sum(max(0.0, want[s] - cap[s]) for s in want)
                roomy = {s: r["target_share"] for r in rows if want[s := r["source"]] < cap[s]}
                want = {s: min(want[s], cap[s]) for s in want}
                if lack < 0.5 or not roomy:
                    break
                for s, w in roomy.items():
                    want[s] += lack * w / sum(roomy.values())
        for r in rows:
            s = r["source"]
            budget, own = min(want[s], cap[s]), have.get(s, 0)
            full = int(budget // own) if own else 0
            jobs.append({"mix_name": mix, "source": s, "target_share": r["target_share"], "max_repeats": r["max_repeats"], "full": full, "budget": budget - full * own, "size": size, "have": own})
    return jobs, have


def thresholds(docs: DataFrame, jobs: list[dict]) -> list[dict]:
    """Adds ``threshold``: documents with a smaller hash are in the partial pass.

    Histograms are cumulated in Spark; of each job only the boundary bucket and the tokens before
    it reach the driver.
    """
    spark = docs.sparkSession
    for j in jobs:
        j["threshold"] = 0
    state = {i: (0, j["budget"]) for i, j in enumerate(jobs) if j["budget"] > 0}  # prefix, tokens left
    done = 0
    for bits in BITS:
        if not state:
            break
        shift = sum(BITS) - done - bits
        edges = spark.createDataFrame([(i, jobs[i]["source"], prefix, float(left)) for i, (prefix, left) in state.items()], "job int, source string, prefix long, left double")
        prefix = F.shiftright("h", sum(BITS) - done) if done else F.lit(0).cast("long")
        bucket = docs.select("source", prefix.alias("prefix"), F.shiftright("h", shift).alias("bucket"), "n_tokens")
        sums = bucket.join(F.broadcast(edges.select("source", "prefix").distinct()), ["source", "prefix"], "left_semi").groupBy("source", "prefix", "bucket").agg(F.sum("n_tokens").alias("n"))
        # at most 2**bits buckets under one prefix
        before = F.sum("n").over(Window.partitionBy("source", "prefix").orderBy("bucket")) - F.col("n")
        steps = sums.withColumn("before", before).join(F.broadcast(edges), ["source", "prefix"]).where(F.col("before") <= F.col("left"))
        last = steps.groupBy("job").agg(F.max(F.struct("bucket", "before", "n")).alias("b"), F.first("left").alias("left")).select("job", "b.*", "left").collect()
        state = {}
        for r in last:
            # the last bucket that begins within the budget: it ends within it, or is cut further
            whole = r["before"] + r["n"] <= r["left"]
            at = r["bucket"] + 1 if whole else r["bucket"]
            jobs[r["job"]]["threshold"] = at << shift
            if not whole:
                state[r["job"]] = (at, r["left"] - r["before"])
        done += bits
    return jobs


def mix(docs: DataFrame, targets: DataFrame, total: int | None = None, redistribute: bool = False, seed: int = 17, doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows, report) of the mixes of ``targets`` (mix_name, source, target_share, max_repeats; at
    most 10,000 rows) from ``docs`` (doc_id, source, n_tokens).

    Rows: ``mix_name``, ``source``, ``doc_id``, ``n_tokens`` and how often it is in the mix,
    ``repeats``.  Report: per mix and source the target, the share and tokens reached.
    """
    wanted = targets.select("mix_name", source_label(F.col("source")).alias("source"), "target_share", "max_repeats").limit(10_001).collect()
    if len(wanted) > 10_000:
        raise ValueError("more than 10,000 mix targets")
    docs = docs.where("n_tokens > 0").select(F.col(doc_id).alias("doc_id"), source_label(F.col("source")).alias("source"), "n_tokens", _hash(doc_id, seed).alias("h"))
    jobs, _ = plan(docs.select("source", "n_tokens"), wanted, total, redistribute)
    jobs = thresholds(docs, jobs)
    spark = docs.sparkSession
    schema = "mix_name string, source string, target_share double, max_repeats int, full int, threshold long, size long, have long"
    cuts = spark.createDataFrame([tuple(j[c.split()[0]] for c in schema.split(", ")) for j in jobs], schema)
    repeats = F.col("full") + (F.col("h") < F.col("threshold")).cast("int")
    rows = docs.join(F.broadcast(cuts), "source").withColumn("repeats", repeats).where("repeats > 0").select("mix_name", "source", "doc_id", "n_tokens", "repeats")
    got = rows.groupBy("mix_name", "source").agg(F.sum(F.col("n_tokens").cast("long") * F.col("repeats")).alias("tokens"), F.count("*").alias("documents"), F.max("repeats").alias("most_repeats"))
    whole = got.groupBy("mix_name").agg(F.sum("tokens").alias("mix_tokens"))
    report = cuts.join(got, ["mix_name", "source"], "left").join(whole, "mix_name", "left").select(
        "mix_name", "source", "target_share", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), "max_repeats",
        F.coalesce(F.round(F.col("tokens") / F.col("mix_tokens"), 6), F.lit(0.0)).alias("share"), F.coalesce(F.round(F.col("tokens") / F.col("size"), 6), F.lit(0.0)).alias("share_of_plan"),
        (F.col("have") * F.col("max_repeats") < F.col("target_share") * F.col("size") - 1).alias("short"),
    )
    return rows, report
