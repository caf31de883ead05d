"""Points near other points, and points within regions, by a latitude-strip sweep.

Latitude is range-partitioned into strips.  A point belongs to exactly one strip, which owns all
its pairs; a box (a place grown by the radius, or the envelope of a polygon part) is copied to
every strip it overlaps.  Within a strip both are sorted by longitude, and one pass over the
Arrow batches keeps the active boxes; hits are verified by great-circle distance or by ray
casting.  Strips with more points than ``per_task`` are split by a salt of the point's id and
their boxes copied to each part, so a hot latitude never ends in one task.

Defined results: points with a null id or a null, out of range or (0, 0) position give no row, nor do boxes
whose position is null or text cannot be read; repeated points are matched each; the pair of
equal distance and radius counts as near; a point on a polygon's edge may fall on either side.
Empty inputs give an empty result.  Boxes over the antimeridian are cut in two, boxes reaching a
pole cover all longitudes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orelode.plans.runtime import bounded

EARTH_KM = 6371.0
STRIP_DEG = 0.5
_EVENTS = "strip int, salt int, ord double, point boolean, id bigint, lat double, lon double, lat_lo double, lat_hi double, ord_hi double, shape string, label string"


def usable(lat: Column, lon: Column) -> Column:
    """Whether a stored position can be a place on earth and is not the null island."""
    return F.coalesce((F.abs(lat) <= 90) & (F.abs(lon) <= 180) & ~((lat == 0) & (lon == 0)), F.lit(False))


def haversine(lat1, lon1, lat2, lon2):
    """Great-circle distance in km as numpy arrays."""
    p1, p2 = np.radians(lat1), np.radians(lat2)
    a = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_KM * np.arcsin(np.minimum(1.0, np.sqrt(a)))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km as a column."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def rings(wkt: str) -> list[np.ndarray]:
    """All rings of a POLYGON or MULTIPOLYGON; with even-odd counting holes need no mark."""
    found = []
    for part in re.findall(r"\(([^()]+)\)", wkt or ""):
        xy = np.array([[float(v) for v in p.split()[:2]] for p in part.split(",")])
        if len(xy) >= 3:
            found.append(xy if (xy[0] == xy[-1]).all() else np.vstack([xy, xy[:1]]))
    return found


def inside(lon: np.ndarray, lat: np.ndarray, shape: list[np.ndarray]) -> np.ndarray:
    """Even-odd ray casting of many points against one polygon."""
    odd = np.zeros(len(lon), bool)
    for ring in shape:
        x1, y1, x2, y2 = ring[:-1, 0], ring[:-1, 1], ring[1:, 0], ring[1:, 1]
        for s in range(0, len(lon), 4096):
            px, py = lon[s : s + 4096, None], lat[s : s + 4096, None]
            across = (y1 > py) != (y2 > py)
            with np.errstate(divide="ignore", invalid="ignore"):
                at = (x2 - x1) * (py - y1) / (y2 - y1) + x1
            odd[s : s + 4096] ^= (across & (px < at)).sum(1) % 2 == 1
    return odd


def circles(df: DataFrame, id_: str, lat: str, lon: str, km: float, label: str | None = None) -> DataFrame:
    """Boxes that hold all points within ``km`` of each row's position."""
    deg = math.degrees(km / EARTH_KM)
    held = usable(F.col(lat), F.col(lon)) | ((F.col(lat) == 0) & (F.col(lon) == 0))
    base = df.where(held & F.col(id_).isNotNull()).select(
        F.col(id_).cast("bigint").alias("id"), F.col(lat).alias("lat"), F.col(lon).alias("lon"), (F.col(label) if label else F.lit(None)).cast("string").alias("label")
    )
    polar = F.abs(F.col("lat")) + deg >= 89.9
    wide = F.degrees(F.asin(F.least(F.lit(1.0), math.sin(math.radians(deg)) / F.cos(F.radians("lat"))))) + 1e-9
    lo, hi = F.when(polar, -180.0).otherwise(F.col("lon") - wide), F.when(polar, 180.0).otherwise(F.col("lon") + wide)
    base = base.withColumns({"lo": lo, "hi": hi, "lat_lo": F.col("lat") - deg - 1e-9, "lat_hi": F.col("lat") + deg + 1e-9, "shape": F.lit(None).cast("string")})
    return _wrapped(base)


def regions(df: DataFrame, id_: str, wkt: str, label: str | None = None) -> DataFrame:
    """Boxes around each polygon, with its text to verify hits."""
    kind = "struct<id:bigint,label:string,shape:string,lo:double,hi:double,lat_lo:double,lat_hi:double>"

    def envelopes(batches):
        for b in batches:
            out = []
            for i, w, lab in zip(b.column("id").to_pylist(), b.column("shape").to_pylist(), b.column("label").to_pylist()):
                try:
                    shape = rings(w)
                except ValueError:
                    continue
                if shape:
                    xy = np.vstack(shape)
                    (lo, a), (hi, z) = xy.min(0), xy.max(0)
                    out.append({"id": i, "label": lab, "shape": w, "lo": lo, "hi": hi, "lat_lo": a, "lat_hi": z})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("id", pa.int64()), ("label", pa.string()), ("shape", pa.string()), *((k, pa.float64()) for k in ("lo", "hi", "lat_lo", "lat_hi"))]))

    base = df.select(F.col(id_).cast("bigint").alias("id"), F.col(wkt).alias("shape"), (F.col(label) if label else F.lit(None)).cast("string").alias("label"))
    boxes = base.where(F.col("shape").isNotNull() & F.col("id").isNotNull()).mapInArrow(envelopes, kind[7:-1].replace(":", " "))
    return boxes.withColumns({"lat": F.lit(None).cast("double"), "lon": F.lit(None).cast("double")})


def _wrapped(boxes: DataFrame) -> DataFrame:
    """Cuts boxes that cross the antimeridian."""
    lo, hi = F.col("lo"), F.col("hi")
    whole = F.array(F.struct(F.greatest(lo, F.lit(-180.0)).alias("lo"), F.least(hi, F.lit(180.0)).alias("hi")))
    east = F.when(hi > 180, F.array(F.struct(F.lit(-180.0).alias("lo"), (hi - 360).alias("hi"))))
    west = F.when(lo < -180, F.array(F.struct((lo + 360).alias("lo"), F.lit(180.0).alias("hi"))))
    none = F.slice(whole, 1, 0)
    parts = F.explode(F.concat(whole, F.coalesce(east, none), F.coalesce(west, none)))
    return boxes.select("*", parts.alias("cut")).drop("lo", "hi").select("*", "cut.lo", "cut.hi").drop("cut")


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over events sorted by (strip, salt, ord): boxes open at their west edge."""
    active: dict[str, np.ndarray] | None = None
    at = (None, None)
    shapes: dict[int, list[np.ndarray]] = {}
    fields = ("id", "lat", "lon", "lat_lo", "lat_hi", "ord", "ord_hi", "shape", "label")
    empty = pa.schema([("point_id", pa.int64()), ("box_id", pa.int64()), ("label", pa.string()), ("km", pa.float64())])
    for batch in batches:
        t = {f.name: batch.column(i).to_numpy(zero_copy_only=False) for i, f in enumerate(batch.schema)}
        n = batch.num_rows
        if not n:
            continue
        change = np.flatnonzero((np.diff(t["strip"]) != 0) | (np.diff(t["salt"]) != 0)) + 1
        for s, e in zip([0, *change], [*change, n]):
            key = (t["strip"][s], t["salt"][s])
            if key != at:
                at, active = key, None
            own = slice(s, e)
            is_point = t["point"][own].astype(bool)
            new = {f: t[f][own][~is_point] for f in fields}
            box = new if active is None else {f: np.concatenate([active[f], new[f]]) for f in fields}
            lon, lat, ids = (t[f][own][is_point] for f in ("ord", "lat", "id"))
            if len(lon) and len(box["id"]):
                first = np.searchsorted(lon, box["ord"].astype(float), "left")
                last = np.searchsorted(lon, box["ord_hi"].astype(float), "right")
                for b in np.flatnonzero(last > first):
                    w = slice(first[b], last[b])
                    hit = np.flatnonzero((lat[w] >= box["lat_lo"][b]) & (lat[w] <= box["lat_hi"][b])) + first[b]
                    if not len(hit):
                        continue
                    if box["shape"][b] is None:
                        km = haversine(lat[hit], lon[hit], float(box["lat"][b]), float(box["lon"][b]))
                        ok = km <= float(box["label"][b].split("\t")[0])
                    else:
                        i = int(box["id"][b])
                        if i not in shapes:
                            shapes[i] = rings(box["shape"][b])
                        ok = inside(lon[hit], lat[hit], shapes[i])
                        km = np.zeros(len(hit))
                    if ok.any():
                        k = int(ok.sum())
                        label = box["label"][b].split("\t", 1)[1]
                        yield pa.RecordBatch.from_arrays([pa.array(ids[hit][ok].astype("int64")), pa.array([int(box["id"][b])] * k, pa.int64()), pa.array([label] * k, pa.string()), pa.array(km[ok])], schema=empty)
            edge = float(t["ord"][e - 1])
            keep = box["ord_hi"].astype(float) >= edge
            active = {f: box[f][keep] for f in fields}


def match_boxes(points: DataFrame, id_: str, lat: str, lon: str, boxes: DataFrame, km: float = 0.0, per_task: int = 250_000) -> DataFrame:
    """``point_id``, ``box_id``, ``label`` and ``km`` of every usable point in a circle or polygon.

    ``boxes`` comes from :func:`circles` (then ``km`` is its radius) or :func:`regions`.
    ``id_`` must be integral and unique among the points.
    """
    strip = lambda c: F.floor((c + 90) / STRIP_DEG).cast("int")
    pts = points.where(usable(F.col(lat), F.col(lon)) & F.col(id_).isNotNull()).select(F.col(id_).cast("bigint").alias("id"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
    pts = pts.withColumn("strip", strip(F.col("lat")))
    reach = F.explode(F.sequence(strip(F.greatest(F.col("lat_lo"), F.lit(-90.0))), strip(F.least(F.col("lat_hi"), F.lit(90.0)))))
    placed = boxes.select("*", reach.alias("strip"))
    # a strip dense in points is split by points, one dense in boxes by boxes, and one dense in both
    # by both: points go to every part of the boxes and boxes to every part of the points.  The
    # table has at most 180 / STRIP_DEG + 1 rows, whatever the input
    parts = lambda d, name: d.groupBy("strip").agg(F.ceil(F.count("*") / per_task).cast("int").alias(name))
    hot = parts(pts, "parts").join(parts(placed, "box_parts"), "strip")
    none = lambda kind: F.lit(None).cast(kind)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    left = pts.join(F.broadcast(hot), "strip").select("*", every("box_parts").alias("b")).select(
        "strip", (own("parts") * F.col("box_parts") + F.col("b")).alias("salt"), F.col("lon").alias("ord"), F.lit(True).alias("point"), "id", "lat", "lon",
        none("double").alias("lat_lo"), none("double").alias("lat_hi"), none("double").alias("ord_hi"), none("string").alias("shape"), none("string").alias("label"),
    )
    right = placed.join(F.broadcast(hot), "strip").select("*", every("parts").alias("p")).select(
        "strip", (F.col("p") * F.col("box_parts") + own("box_parts")).alias("salt"), F.col("lo").alias("ord"), F.lit(False).alias("point"), "id", "lat", "lon", "lat_lo", "lat_hi", F.col("hi").alias("ord_hi"), "shape",
        F.concat(F.lit(f"{km!r}\t"), F.coalesce("label", F.lit(""))).alias("label"),
    )
    events = left.unionByName(right).repartition("strip", "salt").sortWithinPartitions("strip", "salt", "ord", "point")
    return events.mapInArrow(_sweep, "point_id bigint, box_id bigint, label string, km double")


def country_codes(refs: DataFrame) -> DataFrame:
    """``notation`` (trimmed, lower case) to ``iso3`` for codes and names of the reference."""
    pairs = [refs.select(F.lower(F.trim(F.col(c))).alias("notation"), F.col("iso3").alias("meant")) for c in ("iso3", "iso2", "country_name")]
    return pairs[0].unionByName(pairs[1]).unionByName(pairs[2]).where("notation <> ''").groupBy("notation").agg(F.min("meant").alias("meant"))


def surroundings(facility: DataFrame, place: DataFrame, district: DataFrame, country: DataFrame, km: float = 25.0) -> DataFrame:
    """``rec_id``, ``kind`` (place, district_home, district_abroad) and ``target_id`` of the places
    within ``km`` of each facility record and of the district around it.

    A district is at home if its country is the one the record's ``country_iso3`` names in any
    notation; an unknown or null country makes it abroad.
    """
    pts = facility.select("rec_id", F.col("location.lat").alias("lat"), F.col("location.lon").alias("lon"))
    near = match_boxes(pts, "rec_id", "lat", "lon", circles(place, "place_id", "lat", "lon", km), km)
    near = near.select(F.col("point_id").alias("rec_id"), F.lit("place").alias("kind"), F.col("box_id").alias("target_id"))
    held = match_boxes(pts, "rec_id", "lat", "lon", regions(district, "district_id", "wkt", "country_iso3"))
    said = facility.select("rec_id", F.lower(F.trim("country_iso3")).alias("notation")).join(bounded(country_codes(country), 10_000), "notation", "left").select("rec_id", "meant")
    held = held.join(said, held.point_id == said.rec_id, "left").select(
        F.col("point_id").alias("rec_id"),
        F.when(F.col("label") == F.col("meant"), "district_home").otherwise("district_abroad").alias("kind"),
        F.col("box_id").alias("target_id"),
    )
    return near.unionByName(held)


def nearest_regions(points: DataFrame, id_: str, lat: str, lon: str, key: str, polygons: DataFrame, region_id: str, wkt: str, region_key: str, most: int = 20_000, most_bytes: int = 64 << 20) -> DataFrame:
    """``id_``, ``region_id`` and ``km`` (planar degrees x 111, 0 inside) of the nearest polygon with
    the point's ``key``, among at most ``most`` polygons of ``most_bytes`` together; unusable points
    give no row.  Polygons whose box is farther than the best so far are not measured."""
    size = polygons.agg(F.coalesce(F.sum(F.octet_length(wkt)), F.lit(0)).alias("n")).first()["n"]
    if size > most_bytes:
        raise ValueError(f"the polygons have more than {most_bytes} bytes")
    rows = polygons.where(F.col(wkt).isNotNull()).select(F.col(region_id).cast("bigint"), F.col(region_key), F.col(wkt)).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} polygons")
    known: dict = {}
    for i, k, w in rows:
        known.setdefault(k, []).append((i, w))

    def search(batches):
        shapes: dict = {}
        for b in batches:
            ids, keys = b.column("id").to_pylist(), b.column("k").to_pylist()
            a, o = b.column("lat").to_numpy(zero_copy_only=False), b.column("lon").to_numpy(zero_copy_only=False)
            out = []
            for k in set(keys) & set(known):
                at = np.flatnonzero([x == k for x in keys])
                if k not in shapes:
                    parsed = [(i, rings(w)) for i, w in known[k]]
                    shapes[k] = [(i, shape, np.concatenate(shape).min(0), np.concatenate(shape).max(0)) for i, shape in parsed if shape]
                every, best, who = at, np.full(len(at), np.inf), np.zeros(len(at), np.int64)
                spots = np.stack([o[every], a[every]], 1)
                for i, shape, low, high in shapes[k]:
                    least = np.sqrt((np.maximum(np.maximum(low - spots, spots - high), 0) ** 2).sum(1))
                    todo = np.flatnonzero(least <= best)
                    if not len(todo):
                        continue
                    at = every[todo]
                    d = np.full(len(at), np.inf)
                    for ring in shape:
                        p, q = ring[:-1], ring[1:]
                        v = q - p
                        for s in range(0, len(at), 2048):
                            xy = np.stack([o[at[s : s + 2048]], a[at[s : s + 2048]]], 1)[:, None, :]
                            t = np.clip(((xy - p) * v).sum(2) / np.maximum((v**2).sum(1), 1e-18), 0, 1)
                            d[s : s + 2048] = np.minimum(d[s : s + 2048], np.sqrt(((p + t[..., None] * v - xy) ** 2).sum(2)).min(1))
                    d = np.where(inside(o[at], a[at], shape), 0, d)
                    closer = (d < best[todo]) | ((d == best[todo]) & (i < who[todo]))
                    best[todo], who[todo] = np.where(closer, d, best[todo]), np.where(closer, i, who[todo])
                out += [{"id": ids[j], "region_id": int(w), "km": float(x) * 111.0} for j, w, x in zip(every, who, best) if np.isfinite(x)]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("id", pa.int64()), ("region_id", pa.int64()), ("km", pa.float64())]))

    pts = points.where(usable(F.col(lat), F.col(lon))).select(F.col(id_).cast("bigint").alias("id"), F.col(key).alias("k"), F.col(lat).alias("lat"), F.col(lon).alias("lon"))
    return pts.mapInArrow(search, "id bigint, region_id bigint, km double").withColumnRenamed("id", id_)
