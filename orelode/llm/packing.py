"""Documents packed into containers of fixed capacity, by harmonic packing.

Lengths are partitioned into reciprocal-capacity classes: class k holds lengths in
(C/(k+1), C/k] and exactly k of them fill a container, so every worker fills the containers of
every class on its own by counting.  Lengths are dealt in descending order.  What stays free in a
container that has its count is given to lengths of later classes, each to the tightest room it
fits; only lengths that fit no room open containers of their class.  The containers of the last,
open class (at most C/classes) have no count and are filled like any room.

Work is split into blocks by a hash of the document, each at most about ``block_rows`` items, so
neither a hot source nor one long class gathers in a task; each block leaves at most one partly
filled container a class.

Defined results: documents without tokens (null and empty texts) or without an id are not placed; a document longer
than the capacity is cut into full pieces and a rest, which is packed like any other; all others
stay whole.  Repeated rows are items of their own.  Kinds without a positive capacity are left out.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

CLASSES = 24


def harmonic(sizes: np.ndarray, capacity: int, classes: int = CLASSES) -> np.ndarray:
    """Container number of each size (all within 1..capacity)."""
    k = np.minimum(capacity // np.maximum(sizes, 1), classes).tolist()
    order = np.argsort(-sizes, kind="stable")
    bins = np.empty(len(sizes), np.int64)
    rooms: list[tuple[int, int]] = []  # (free, container) of the containers that have their count
    free: list[int] = []
    now, b, missing = 0, -1, 0  # the class at hand, its container being filled, documents it lacks
    for i, s in zip(order.tolist(), sizes[order].tolist()):
        if k[i] != now:
            if missing and free[b]:
                insort(rooms, (free[b], b))
            now, missing = k[i], 0
        at = bisect_left(rooms, (s, -1))
        if at < len(rooms):
            room, into = rooms.pop(at)
            bins[i] = into
            if room > s:
                insort(rooms, (room - s, into))
            continue
        if not missing:
            b, missing = len(free), now if now < classes else 1
            free.append(capacity)
        bins[i] = b
        free[b] -= s
        missing -= 1
        if not missing and free[b]:
            insort(rooms, (free[b], b))
    return bins


def pack(docs: DataFrame, doc_id: str, tokens: str, kinds: DataFrame, block_rows: int = 100_000, classes: int = CLASSES, most_kinds: int = 1000) -> DataFrame:
    """``container_kind``, ``container_id``, ``doc_id``, ``start_token`` and ``n_tokens`` of every
    placed document or piece, for every kind of ``kinds`` (container_kind, capacity_tokens; at most
    ``most_kinds`` rows)."""
    specs = kinds.where("capacity_tokens > 0").select("container_kind", F.col("capacity_tokens").cast("int").alias("capacity")).limit(most_kinds + 1).collect()
    if len(specs) > most_kinds:
        raise ValueError(f"more than {most_kinds} kinds of containers")
    items = docs.where((F.col(tokens) > 0) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(tokens).cast("int").alias("size"))
    blocks = max(1, -(-items.count() // block_rows))
    items = items.withColumn("block", F.pmod(F.xxhash64("doc_id", "size"), F.lit(blocks)))
    every = F.array(*(F.struct(F.lit(r["container_kind"]).alias("container_kind"), F.lit(r["capacity"]).alias("capacity")) for r in specs))
    kind = "array<struct<container_kind:string,capacity:int>>"
    pairs = items.select("*", F.explode(every.cast(kind) if specs else F.lit(None).cast(kind)).alias("_kind")).select("*", "_kind.*").drop("_kind")  # every document goes to every kind
    starts = F.sequence(F.lit(0), ((F.col("size") - 1) / F.col("capacity")).cast("int"))
    pieces = pairs.select("*", F.explode(starts).alias("_piece")).withColumn("start_token", F.col("_piece") * F.col("capacity"))
    pieces = pieces.select("container_kind", "capacity", "block", "doc_id", "start_token", F.least("capacity", F.col("size") - F.col("start_token")).alias("n_tokens"))

    def fill(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["doc_id", "start_token"], kind="stable")
        bins = harmonic(part["n_tokens"].to_numpy(), int(part["capacity"].iloc[0]), classes)
        names = np.char.add(f"{key[0]}-{key[1]}-", bins.astype(str))
        return pd.DataFrame({"container_kind": part["container_kind"], "container_id": names, "doc_id": part["doc_id"], "start_token": part["start_token"], "n_tokens": part["n_tokens"]})

    return pieces.groupBy("container_kind", "block").applyInPandas(fill, "container_kind string, container_id string, doc_id bigint, start_token int, n_tokens int")


def fill_report(packed: DataFrame, kinds: DataFrame) -> DataFrame:
    """Containers, tokens and the share of capacity used, by kind."""
    per = packed.groupBy("container_kind").agg(F.count_distinct("container_id").alias("containers"), F.count("*").alias("pieces"), F.sum("n_tokens").alias("tokens"))
    return per.join(kinds.select("container_kind", "capacity_tokens"), "container_kind").select("*", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 4).alias("used"))
