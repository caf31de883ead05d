"""Free-entered values mapped to a canonical list with BK-trees.

The reference entries (canonical terms, their symbols and known synonyms, and the compounds that
rules make of them) are put into Burkhard-Keller trees under the true Damerau-Levenshtein
distance, which is a metric, so the triangle inequality prunes and still returns every entry
within the threshold.  A large reference is sharded: every shard finds its own winner for every
distinct value and the winners are merged by least distance.  Each distinct value is looked up
once, whatever the number of rows that hold it.

Defined results: null and blank values give no row; a value whose stored text is an entry gives
none either; the threshold grows with the longer of value and entry (no edit up to 3
letters, 1 up to 6, 2 up to 9, 3 beyond); of entries at the same least distance
canonical texts come before synonyms, these before compounds, then the least term_id wins; anything else is ``unmatched``.  Repeated values in a list are mapped at each position.
"""

from __future__ import annotations

import pickle
import re

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from orelode.llm.strings import ascii_fold, damerau
from orelode.plans.runtime import cut

# Synonyms by canonical term, separated by commas.
COMMODITY = {
    "copper": "cobre, cuivre, kupfer, tembaga, red metal, chalcopyrite", "gold": "oro, ouro, or metal, emas, gold dore, dore", "silver": "plata, prata, argent, argent metal, silber, perak",
    "zinc": "cinc, zinco, zink, seng, sphalerite", "lead": "plomo, chumbo, plomb, blei, timbal, galena", "nickel": "niquel, nikel, nickel laterite, nickel sulphide, pentlandite, ferro nickel, ferronickel",
    "cobalt": "cobalto, kobalt, cobalt hydroxide", "iron": "hierro, ferro, fer, eisen, eisenerz, minerai de fer, minerio de ferro, besi, mineral de hierro, magnetite, hematite",
    "aluminum": "aluminium, aluminio, alumina", "bauxite": "bauxita, bauxit, bauksit", "manganese": "manganeso, manganes, mangan, mangane, ferromanganese, pyrolusite", "chromium": "cromo, chrome, chrom, chromite, krom, cromita, ferrochrome, ferrochromium",
    "lithium": "litio, lithium carbonate, lithium brine, spodumene, lithium hydroxide", "tin": "estano, estanho, etain, zinn, timah, cassiterite", "tungsten": "wolfram, tungsteno, wolframite, wolframio, scheelite",
    "molybdenum": "molibdeno, molybdenite, molybdene, moly, molybdan", "uranium": "uranio, uran, yellowcake, u3o8, uraninite, uranium oxide", "platinum": "platino, platina, platine, platin, pgm, pge, platinum group metals, platinum group elements",
    "palladium": "paladio, paladium", "coal": "carbon, charbon, kohle, steinkohle, carvao, batubara, hard coal, coking coal, thermal coal, lignite, anthracite",
    "rare earths": "rare earth elements, rare earth, ree, treo, tierras raras, terres rares, seltene erden, terras raras, rare earth oxides", "phosphate": "fosfato, phosphorite, phosphat, phosphate rock, rock phosphate, apatite", "potash": "potasa, potassium salts, sylvinite, kali, potassa",
    "graphite": "grafito, natural graphite, graphit, grafite, flake graphite", "vanadium": "vanadio, v2o5, vanadium pentoxide", "titanium": "titanio, titan, ilmenite, rutile, titane, tio2, titanium dioxide", "antimony": "antimonio, antimoine, antimon, stibnite",
    "mercury": "mercurio, quicksilver, quecksilber, mercure, cinnabar", "bismuth": "bismuto, bismut, wismut", "fluorspar": "fluorita, fluorite, fluor spar, flussspat", "baryte": "barite, barita, barytes, schwerspat, baritina",
    "gypsum": "yeso, gesso, gips, gypse, gypsum rock", "limestone": "caliza, calcaire, kalkstein, calcario, batu kapur", "salt": "sal, sel, salz, halite, rock salt, sal gema, garam", "diamonds": "diamond, diamantes, diamante, diamants, diamanten, alluvial diamonds",
    "kaolin": "kaolinite, china clay, caolin", "tantalum": "tantalo, tantalite, coltan", "niobium": "niobio, pyrochlore, columbium", "sulfur": "sulphur, azufre, soufre, schwefel, enxofre", "sand": "silica sand, arena, arena silicea, areia, sable, frac sand, quartz sand",
}
TYPE = {
    "mine": "mina, mines, coal mine, colliery, open pit, open pit mine, opencast, opencast mine, pit, surface mine, underground mine, quarry, bergwerk, tambang",
    "smelter": "smeltery, smelting works, smelter complex, copper smelter, fundicion, fonderie, smelting plant", "refinery": "metal refinery, refining works, refineria, raffinerie, refining plant, electro refinery, electrorefinery",
    "concentrator": "ore concentrator, flotation concentrator, concentration plant, concentradora, flotation plant", "mill": "stamp mill, ball mill, ball mill house, grinding mill, molino, mill house, ore mill",
    "heap_leach": "heap leach pad, heap leaching, lixiviacion en pilas, leach pad", "tailings": "tailings dam, tailings storage facility, relavera, tailings pond, tailings storage, tsf", "exploration": "exploracion, prospect, drilling project, exploration project, exploration site",
    "hydromet_plant": "hydrometallurgical plant, hydrometallurgy plant, sx ew plant, hydromet", "rolling_mill": "hot strip mill, strip mill, laminadora, rolling works, plate mill", "steel_plant": "steelworks, steel works, steel mill, aceria, stahlwerk, steelmaking plant, iron steel works, iron and steel works, steel complex",
    "battery_recycling": "li ion recycling plant, battery recycler, battery recycling plant, recycling of batteries, black mass plant", "processing_plant": "process plant, ore processing, planta de beneficio, processing facility, ore processing plant, beneficiation plant",
}
STATUS = {
    "operating": "operational, active, in operation, in production, producing, running, op, en operacion, operativa, in betrieb, en service",
    "closed": "abandoned, shut down, shut, inactive, decommissioned, mined out, cerrada, cerrado, ferme, stillgelegt, depleted", "suspended": "care and maintenance, care maint, on hold, dormant, stalled, temporarily idled, idled, suspendida, mothballed, temporarily closed",
    "construction": "under construction, construction phase, in development, en construccion, being built, development", "planned": "proposed, feasibility, pre feasibility, bankable study, planificada, planificado, permitting",
    "exploration": "exploring, early exploration, exploracion, drilling stage, grassroots, prospecting", "unknown": "not known, status unknown, undetermined, unk, desconocido, desconocida, unbekannt, inconnu",
}
SYNONYMS = {"commodity": COMMODITY, "type": TYPE, "status": STATUS}
#: Words that only say in what form a commodity comes.
AFTER = ("ore", "metal", "concentrate", "conc", "cathode", "bullion")
BEFORE = ("placer", "native", "primary", "refined")
UNMATCHED = "unmatched"


def plain(text: str) -> str:
    """Lower case without accents, punctuation and digits at word ends; spaces for _ and -."""
    t = re.sub(r"[_\-/&+,;:.'\"()]+", " ", ascii_fold(text).lower())
    t = re.sub(r"\s+", " ", t).strip()
    return re.sub(r"(?:\s+\d\w*|(?<=[a-z]{4})\d{4})+$", "", t)


def entries(field: str, terms: list[tuple]) -> list[tuple[str, int, int, str]]:
    """(text, kind, term_id, canonical) of one field's (term_id, canonical, symbol) rows.

    ``kind`` says how the text came about and ranks what it means, whichever shard holds it: 0 the
    canonical text, 1 a synonym, 2 a compound, 3 a symbol (exact only).  Of one text the least
    (kind, term_id) stays.
    """
    out: dict[str, tuple[int, int, str]] = {}

    def add(text: str, kind: int, term: int, canonical: str) -> None:
        if text:
            out[text] = min(out.get(text, (9, 0, "")), (kind, term, canonical))

    for term, canonical, _ in terms:
        own = plain(canonical)
        words = [w for w in map(plain, SYNONYMS.get(field, {}).get(canonical, "").split(",")) if w]
        add(own, 0, term, canonical)
        for word in words:
            add(word, 1, term, canonical)
        for word in (own, *words) if field == "commodity" else ():
            for text in (*(f"{word} {form}" for form in AFTER), *(f"{form} {word}" for form in BEFORE)):
                add(text, 2, term, canonical)
            add(f"{word} {own}", 2, term, canonical)
    return [(t, k, i, c) for t, (k, i, c) in sorted(out.items())]


def most_edits(length: int) -> int:
    return 0 if length <= 3 else 1 if length <= 6 else 2 if length <= 9 else 3


class BKTree:
    """Burkhard-Keller tree over (text, kind, term_id, canonical) entries, kept flat: ``edges[i]``
    maps a distance from entry i to the entry below it."""

    def __init__(self, items: list[tuple[str, int, int, str]], symbols: dict[str, tuple[int, int, str]] | None = None) -> None:
        self.items = items
        self.exact = {t: (k, i, c) for t, k, i, c in items}
        self.symbols = symbols or {}
        self.longest = max((len(t) for t, *_ in items), default=0)
        self.edges: list[dict[int, int]] = [{} for _ in items]
        for at in range(1, len(items)):
            node, text = 0, items[at][0]
            while True:
                d = damerau(text, items[node][0])
                if d not in self.edges[node]:
                    self.edges[node][d] = at
                    break
                node = self.edges[node][d]

    def within(self, text: str, most: int) -> list[tuple[int, int, int, str, str]]:
        """Every (distance, kind, term_id, canonical, text) within ``most`` edits."""
        found, todo = [], [0] if self.items else []
        while todo:
            node = todo.pop()
            t, k, i, c = self.items[node]
            below = self.edges[node]
            # a distance beyond the farthest edge in reach opens none and is no hit
            d = damerau(text, t, most + max(below, default=0))
            if d <= most:
                found.append((d, k, i, c, t))
            todo += [child for e, child in below.items() if d - most <= e <= d + most]
        return found

    def nearest(self, text: str) -> tuple[int, int, int, str] | None:
        """The least (distance, kind, term_id, canonical) of the entries the text may mean."""
        sure = [x[text] for x in (self.exact, self.symbols) if text in x]
        if sure:
            return (0, *min(sure))
        most = most_edits(len(text) + 1)
        if len(text) <= 2 or len(text) > self.longest + most:
            return None  # no entry can be near
        ok = [(d, k, i, c) for d, k, i, c, t in self.within(text, most) if d <= most_edits(max(len(t), len(text)))]
        return min(ok, default=None)


def build_tree(field: str, rows: list[tuple]) -> BKTree:
    """The tree of one shard from its (term_id, canonical, symbol) rows."""
    symbols: dict[str, tuple[int, int, str]] = {}
    for i, c, s in rows:
        if isinstance(s, str) and plain(s):
            symbols[plain(s)] = min(symbols.get(plain(s), (9, 0, "")), (3, i, c))
    return BKTree(entries(field, rows), symbols)


def readings(raw: str) -> list[str]:
    """What a typed value may say: as a whole, or the two halves of "Cu - copper" and "Copper (Cu)"."""
    m = re.fullmatch(r"\s*(.+?)\s+-\s+(.+?)\s*", raw) or re.fullmatch(r"\s*(.+?)\s*\(([^)]*)\)\s*", raw)
    return [plain(raw), *(plain(g) for g in (m.groups() if m else ()))]


def _lookup(raw: str, tree: BKTree) -> tuple[int, int, int, str] | None:
    found = [tree.nearest(r) for r in readings(raw) if re.search(r"[a-z]", r)]
    return min((x for x in found if x), default=None)


def map_values(values: DataFrame, terms: DataFrame, shard_rows: int = 20_000) -> DataFrame:
    """``field_name``, ``raw``, ``canonical`` (or ``unmatched``) and ``distance`` of each distinct
    (field_name, raw) of ``values``.

    ``terms`` has term_id, field_name, canonical, symbol.  It is split into shards of at most about
    ``shard_rows`` terms by hash.  Each shard's trees are built once, in one task, and handed to the
    tasks that search them; values meet every shard, and the least (distance, kind, term_id) of all
    shards wins, so the number of shards changes no answer.
    """
    shards = max(1, -(-terms.count() // shard_rows))
    distinct = values.select("field_name", "raw").where(F.length(F.trim("raw")) > 0).distinct()
    spark = values.sparkSession
    slots = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    own = terms.where("canonical is not null").select("term_id", "field_name", "canonical", "symbol", F.pmod(F.xxhash64("term_id"), F.lit(shards)).cast("int").alias("shard"))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        rows = sorted((int(i), c, s if isinstance(s, str) else None) for i, c, s in zip(part["term_id"], part["canonical"], part["symbol"]))
        tree = build_tree(part["field_name"].iloc[0], rows)
        return pd.DataFrame({"field_name": [part["field_name"].iloc[0]], "shard": [part["shard"].iloc[0]], "tree": [pickle.dumps(tree)]})

    def search(vals: pd.DataFrame, built: pd.DataFrame) -> pd.DataFrame:
        trees = {f: pickle.loads(t) for f, t in zip(built["field_name"], built["tree"])}
        rows = [(f, raw, *((_lookup(raw, trees[f]) if f in trees else None) or (None,) * 4)) for f, raw in zip(vals["field_name"], vals["raw"])]
        return pd.DataFrame(rows, columns=["field_name", "raw", "distance", "kind", "term_id", "canonical"]).astype({"distance": "Int64", "kind": "Int64", "term_id": "Int64"})

    trees = cut(own.groupBy("field_name", "shard").applyInPandas(build, "field_name string, shard int, tree binary"))
    every = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    # one task a slot: a number given by hand keeps small inputs from being coalesced into one task
    left = distinct.select("field_name", "raw", F.explode(every(shards)).alias("shard"), F.pmod(F.xxhash64("raw"), F.lit(slots)).cast("int").alias("slot")).repartition(slots, "slot", "shard")
    right = trees.select("*", F.explode(every(slots)).alias("slot")).repartition(slots, "slot", "shard")
    hits = left.groupBy("slot", "shard").cogroup(right.groupBy("slot", "shard")).applyInPandas(search, "field_name string, raw string, distance int, kind int, term_id long, canonical string")
    best = hits.groupBy("field_name", "raw").agg(F.min(F.struct(F.col("distance").isNull().alias("none"), "distance", "kind", "term_id", "canonical")).alias("b"))
    return best.select("field_name", "raw", F.coalesce("b.canonical", F.lit(UNMATCHED)).alias("canonical"), F.col("b.distance").alias("distance"))


def facility_values(facility: DataFrame) -> DataFrame:
    """``rec_id``, ``field_name``, ``pos``, ``raw`` of all non-blank metals, types and statuses."""
    metals = facility.select("rec_id", F.lit("commodity").alias("field_name"), F.posexplode(F.col("commodities.metal")).alias("pos", "raw"))
    types = facility.select("rec_id", F.lit("type").alias("field_name"), F.posexplode("types").alias("pos", "raw"))
    status = facility.select("rec_id", F.lit("status").alias("field_name"), F.lit(0).alias("pos"), F.col("status").alias("raw"))
    found = metals.unionByName(types).unionByName(status).where(F.length(F.regexp_replace("raw", r"\s+", "")) > 0)
    return found.select("rec_id", "field_name", F.col("pos").cast("bigint").alias("pos"), "raw")


def map_records(facility: DataFrame, terms: DataFrame) -> DataFrame:
    """``rec_id``, ``field_name``, ``pos``, ``canonical`` of all values that are not entries."""
    known = terms.select("field_name", F.col("canonical").alias("raw")).distinct()
    values = facility_values(facility).join(known, ["field_name", "raw"], "left_anti")
    mapped = map_values(values, terms)
    return values.join(mapped, ["field_name", "raw"]).select("rec_id", "field_name", "pos", "canonical")
