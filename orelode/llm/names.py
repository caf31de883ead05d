"""Variant spellings of company and person names, linked by canonical rewritings.

Every distinct name is rewritten in all ways the rules allow: decorations and legal forms are
dropped, nicknames become first names, abbreviated lines of business are spelled out, parts are
taken in any order, run together or as initials, and letters may be missing.  The rewritten forms
are exploded and joined by equality.  Within one form the commonest name of each line of business
(of each first name, for persons) is the hub the others are compared with, so the work is linear
in the names however many share a form.  Comparisons that hold become links, scored by their edits
and by the rarity of the rarest form in common; connected names are one entity.

Defined results: null, blank and placeholder names link to nothing; spellings that are equal as
stored are one name; a name without a line of business (or with only an initial) joins an entity
only if the names it matches agree on one, or if the score of one stands out; else it is left alone.  Titles and
a missing legal form do not tell entities apart; lines of business, first names and two different
legal forms (however written) do; a name without one joins the nearest names.  A lone initial tells nothing.
Words may have any length, and names any number of them.

Names near each other that share no form, or whose hubs are strangers, are found in a second way
(:func:`_every`): within one line of business all that :func:`edits` accepts is linked.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from orelode.llm.components import components
from orelode.llm.near import near_parts
from orelode.llm.strings import ascii_fold, damerau, deletions, squash
from orelode.plans.runtime import bounded, cut, slots

#: Words of more letters are joined by their ends.
LONG = 32
#: By how much a line of business must outscore the next for a name that leaves it open.
MARGIN = 2.0

# Words of names.
PLACEHOLDERS = set("unknown none null na n/a nan tbd tba tbc various undisclosed confidential private unnamed anonymous other others - -- --- ? . desconocido unbekannt inconnu".split())
LEGAL = set(
    "ltd limited plc inc incorporated llc corp corporation gmbh sa pty co company lp llp ag nv bv ab oy as spa sarl sas srl ltda sl jsc ojsc pjsc ooo oao pao tbk pt kg kk bhd sdn pvt proprietary sociedad anonima public".split()
)
#: The form a name has, by the first of these words it holds; other words stand for themselves.
FORM = {"pty": "pty", "proprietary": "pty", "plc": "plc", "public": "plc", "llc": "llc", "gmbh": "gmbh", "sa": "sa", "sociedad": "sa", "inc": "inc", "incorporated": "inc", "corp": "corp", "corporation": "corp", "ltd": "ltd", "limited": "ltd"}
GENERIC = set("group grupo cos companies partners ptnrs of the and y et al cia associates assoc".split())
LINES = (
    "mining iron copper coal zinc lithium cement metals minerals smelting engineering exploration resources quarries holdings international gold mines mineral sands silver nickel steel "
    "energy power uranium platinum diamonds aluminium potash phosphate salt ventures development construction services logistics trading"
).split()
SHORT = {
    "intl": "international", "hldgs": "holdings", "hold": "holdings", "hldg": "holdings", "min": "mineral", "ming": "mining", "mng": "mining", "minls": "minerals", "mins": "minerals", "mnrls": "minerals",
    "mns": "mines", "res": "resources", "rsrcs": "resources", "expl": "exploration", "explor": "exploration", "exp": "exploration", "cem": "cement", "cmt": "cement", "met": "metals", "mtls": "metals",
    "mets": "metals", "engg": "engineering", "engrg": "engineering", "eng": "engineering", "engr": "engineering", "quarr": "quarries", "qrs": "quarries", "qrys": "quarries", "smelt": "smelting", "smltg": "smelting",
    "copp": "copper", "cu": "copper", "zn": "zinc", "li": "lithium", "lith": "lithium", "snds": "sands", "sds": "sands", "gld": "gold", "au": "gold", "fe": "iron", "irn": "iron",
}
TITLES = set("mr mrs ms miss dr prof sr sra herr frau heirs messrs ms/ m/s don dona".split())
FIRST = {
    "jose": "pepe", "katarzyna": "kasia kate", "theodore": "ted teddy theo", "johannes": "jan hans johann", "william": "bill will billy wm liam", "ignacio": "nacho", "margaret": "maggie peggy meg marge",
    "rosario": "charo", "vincenzo": "enzo vince", "robert": "rob bob bobby robbie", "mikhail": "misha michail mikhael", "susanna": "sue susie suzanne susan", "aleksandr": "sasha alex alexander alexandr",
    "guadalupe": "lupe lupita", "elizabeth": "beth liz lizzie betty eliza elisabeth", "nicholas": "nick nico nicolas klaus", "francisco": "pancho paco fco francisko", "dmitri": "dima dmitry dimitri mitya",
    "james": "jim jimmy jamie", "john": "jack johnny", "joseph": "joe joey", "richard": "rick dick rich", "charles": "charlie chuck", "edward": "ed eddie ned", "thomas": "tom tommy", "michael": "mike mick",
    "ivan": "vanya", "maria": "mariya marie", "anna": "anya annie", "giuseppe": "beppe peppe", "manuel": "manolo", "antonio": "tonio toni", "eduardo": "lalo", "catherine": "cathy kathy katie",
}
_FIRST = {short: full for full, shorts in FIRST.items() for short in [full, *shorts.split()]}
_LINE = {w: w for w in LINES} | SHORT


def _first(word: str) -> str | None:
    if word in _FIRST:
        return _FIRST[word]
    near = [full for full in FIRST if len(word) >= 3 and word not in _LINE and damerau(word, full, 2) <= (1 if len(full) < 7 else 2)]
    return near[0] if len(near) == 1 else None


def parsed(name: str) -> tuple[str, str, list[str], str] | None:
    """(kind, facet, parts, legal): kind c or p; facet the line of business or the first name, or
    an initial with a dot, or ''; parts the proper words in order, initials as single letters;
    legal the form, '' if none is said."""
    t = ascii_fold(name).lower().strip()
    if not t or t in PLACEHOLDERS:
        return None
    t = re.sub(r"[\(\[].*?[\)\]]|[\(\[].*$", " ", t)
    t = re.sub(r"\bet\s+al\b\.?", " ", t)
    amp = "&" in t or " and " in t
    t = re.sub(r"\b(?:[a-z]\s?\.\s?)+[a-z]\b\.?", lambda m: f" {w} " if (w := re.sub(r"[^a-z]", "", m[0])) in LEGAL else m[0], t)
    t = re.sub(r"\b([a-z])\.(?=-?[a-z]{2,})", r"\1. ", t)
    t = re.sub(r"\bm/s\b|\bheirs\s+of\b|\bgroup\s+of\s+companies\b", lambda m: " group " if "group" in m[0] else " ", t)
    comma = "," in t
    words = [w for w in re.split(r"[\s,/&+\-]+", t) if w]
    proper: list[str] = []
    line: list[str] = []
    company = amp
    forms_: list[str] = []
    spaced = []
    for w in words:
        dotted = re.fullmatch(r"(?:[a-z]\.){2,}[a-z]?", w)
        spaced += [c for c in w if c.isalpha()] if dotted else [w]
    for w in spaced:
        bare = re.sub(r"[^a-z0-9]", "", w)
        if not bare or bare in TITLES:
            continue
        if bare in LEGAL:
            company = True
            forms_.append(bare)
        elif bare in GENERIC:
            company = company or bare not in ("the", "of", "y", "and")
        elif bare in _LINE and (len(bare) > 2 or w != bare or bare in _LINE):
            company = True
            line.append(_LINE[bare])
        else:
            proper.append(bare)
    for lone, letter, word in (("mines", "g", "gold"), ("sands", "m", "mineral")):
        if lone in line and word not in line and letter in proper and len(proper) > 1:
            proper.remove(letter)
            line.insert(line.index(lone), word)
    if not proper:
        return None
    legal = next((FORM[w] for w in FORM if w in forms_), forms_[0] if forms_ else "")
    legal = "co" if legal in ("company", "co") else legal
    if "mineral" in line and "sands" not in line and len(line) == 1:
        line = ["minerals"]
    if not company and (comma or len(proper) >= 2):
        full = [p for p in proper if len(p) > 1]
        firsts = [(p, f) for p in full if (f := _first(p))]
        if full and (firsts or len(full) < len(proper)):
            if firsts and len(full) > 1:
                given, facet = firsts[-1] if comma else firsts[0]
                rest = [p for p in full if p != given] or [given]
                return "p", facet, [max(rest, key=len)], ""
            initials = [p for p in proper if len(p) == 1]
            if initials and len(full) == 1:
                return "p", initials[0] + ".", full, ""
    return "c", " ".join(dict.fromkeys(line)), [squash(p) if len(p) > 1 else p for p in proper], legal


def shortened(word: str, most: int) -> set[str]:
    """What is left of the word by up to ``most`` letters left out.  Of long words either end has
    at most half of the edits, so their ends, each short of one letter at most, stand for them."""
    if len(word) <= LONG:
        return deletions(word, most)
    return {f"{w}{side}" for end, side in ((word[:16], "<"), (word[-16:], ">")) for w in deletions(end, most // 2)}


def collapsed(parts: list[str]) -> str:
    return re.sub(r"(.)\1+", r"\1", "".join(parts))


def forms(kind: str, parts: list[str]) -> set[str]:
    """The canonical rewritings to join on."""
    if kind == "p":
        s = squash(parts[0])
        return {"p:" + d for d in shortened(s, 2 if len(s) >= 7 else 1)}
    found: set[str] = set()
    words = [p for p in parts if len(p) > 1]
    if len(parts) == 2:
        for i in (0, 1):
            w, other = parts[i], parts[1 - i]
            if len(w) > 1:
                found |= {f"c:{d}|{other[0]}" for d in shortened(w, 2 if len(w) >= 7 else 1)}
    if len(words) == len(parts) <= 3:
        for order in ([words, words[::-1]] if len(words) > 1 else [words]):
            joined = collapsed(order)
            found |= {"j:" + d for d in shortened(joined, 1 if len(parts) > 1 else 2 if len(joined) < 15 else 1)}
    if len(parts) > 2:
        # any number of words, in any order: all of them, and all but one, which may be misspelt
        whole = sorted(parts)
        found |= {"m:" + "|".join(whole[:i] + whole[i + 1 :]) for i in range(len(whole))} | {"m:" + "|".join(whole)}
    return found


def _near(a: str, b: str) -> int | None:
    """Edits between two proper words, or None if they are different words."""
    if len(a) == 1 or len(b) == 1:
        return 1 if a[0] == b[0] else None
    most = 1 if min(len(a), len(b)) <= 4 else 2 if max(len(a), len(b)) <= 8 else 3
    d = damerau(a, b, most)
    return d if d <= most else None


def edits(kind: str, a: list[str], b: list[str]) -> int | None:
    """Edits between the proper parts of two names, or None if they differ."""
    if kind == "p" or len(a) == len(b) == 1:
        x, y = (squash(a[0]), squash(b[0])) if kind == "p" else (a[0], b[0])
        if x == y:
            return 0
        if min(len(x), len(y)) == 1:  # a lone initial tells nothing
            return None
        d = _near(x, y)  # of people only the surname is left to tell, so it must be nearer
        return d if d is not None and d <= (2 if kind == "p" else 3) else None
    best = None
    if len(a) == len(b) == 2:
        for x, y in ((b[0], b[1]), (b[1], b[0])):
            p, q = _near(a[0], x), _near(a[1], y)
            if p is not None and q is not None and max(min(len(a[0]), len(x)), min(len(a[1]), len(y))) > 1:  # words, not only initials
                best = min(p + q, best if best is not None else 99)
        if best is not None:
            return best
    elif len(a) == len(b):
        x, y = list((Counter(a) - Counter(b)).elements()), list((Counter(b) - Counter(a)).elements())
        if len(x) <= 1:
            return _near(x[0], y[0]) if x else 0
    if all(len(w) > 1 for w in a + b):
        for x in (a, a[::-1]):
            for y in (b, b[::-1]):
                d = damerau(collapsed(x), collapsed(y), 2)
                if d <= 2:
                    best = min(d, best if best is not None else 99)
    return best


_READ = "name string, name_id bigint, n bigint, kind string, facet string, legal string, parts array<string>, forms array<bigint>"


def _rewritten(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for name, key, n in zip(b["name"], b["name_id"], b["n"]):
            got = parsed(name)
            if got:
                kind, facet, parts, legal = got
                rows.append((name, key, n, kind, facet, legal, parts, sorted(xxhash.xxh64_intdigest(kind + f) - (1 << 63) for f in forms(kind, parts))))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in _READ.split(", ")])


def _verdicts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        got = [edits(k, list(x), list(y)) for k, x, y in zip(b["kind"], b["parts"], b["hub_parts"])]
        b = b.assign(edits=pd.array(got, dtype="Int64"))
        yield b.loc[b["edits"].notna(), ["name_id", "hub_id", "edits", "rarity"]]


def _compared(forms_: DataFrame, read: DataFrame) -> DataFrame:
    """One round: ``name_id``, ``hub_id``, ``edits``, ``rarity`` of the names that are near the hub of
    a form they share.  ``forms_`` has form, name_id, n, kind, facet, legal."""
    hubs = forms_.groupBy("form", "kind", "facet", "legal").agg(F.min(F.struct((-F.col("n")).alias("n"), "name_id")).alias("h"), F.count("*").alias("width"))
    hubs = hubs.select("form", "kind", F.col("facet").alias("hub_facet"), F.col("legal").alias("hub_legal"), F.col("h.name_id").alias("hub_id"), "width")
    fits = (
        F.col("facet").eqNullSafe(F.col("hub_facet"))
        | ((F.col("facet") == "") & (F.col("kind") == "c"))
        | ((F.col("kind") == "p") & F.col("facet").endswith(".") & F.col("hub_facet").startswith(F.substring("facet", 1, 1)))
    )
    agree = (F.col("legal") == F.col("hub_legal")) | (F.col("legal") == "") | (F.col("hub_legal") == "")
    same = forms_.join(hubs, ["form", "kind"]).where(fits & agree & (F.col("name_id") != F.col("hub_id")))
    pairs = same.groupBy("name_id", "hub_id").agg(F.max(-F.log2("width")).alias("rarity"))
    side = lambda key, parts, *more: read.select(F.col("name_id").alias(key), F.col("parts").alias(parts), *more)
    pairs = pairs.join(side("name_id", "parts", "kind"), "name_id").join(side("hub_id", "hub_parts"), "hub_id")
    # a number of partitions given by hand: few bytes make much work here
    return pairs.repartition(slots(read.sparkSession)).mapInPandas(_verdicts, "name_id bigint, hub_id bigint, edits int, rarity double")


def _spanned(rows: pd.DataFrame) -> pd.DataFrame:
    """Links of one group: every reading of its facet to the others it is near, as a forest that
    connects them nearest first, and every reading that leaves the facet open to each entity it is
    near.  A link that would bring two legal forms together, over names that say none, is not made."""
    group, kind = rows["group"].iloc[0], rows["kind"].iloc[0]
    parts = sorted({tuple(p) for p in rows["parts"]})
    at = {p: i for i, p in enumerate(parts)}
    held: list[list[int]] = [[] for _ in parts]
    own, legal, ids, n, names = (rows["facet"] == group).tolist(), rows["legal"].tolist(), rows["name_id"].tolist(), rows["n"].tolist(), rows["names"].tolist()
    asked = [False] * len(parts)
    for r, p in enumerate(rows["parts"]):
        held[at[tuple(p)]].append(r)
        asked[at[tuple(p)]] |= own[r]
    near = [(0, i, i) for i in range(len(parts)) if len(held[i]) > 1 and asked[i]]
    for i, j in near_parts(kind, parts, collapsed, squash, asked):
        if (d := edits(kind, list(parts[i]), list(parts[j]))) is not None:
            near.append((d, i, j))
    root = list(range(len(rows)))

    def top(r: int) -> int:
        while root[r] != r:
            root[r] = root[root[r]]
            r = root[r]
        return r

    said = [{x} - {""} for x in legal]
    found, open_ = [], []
    for d, i, j in sorted(near):
        for x in held[i]:
            for y in held[j]:
                if (i == j and x >= y) or not (own[x] or own[y]) or (legal[x] and legal[y] and legal[x] != legal[y]):
                    continue
                if not (own[x] and own[y]):
                    open_.append((d, *((y, x) if own[x] else (x, y))))
                elif (p := top(x)) != (q := top(y)) and len(said[p] | said[q]) < 2:
                    root[p], said[q] = q, said[p] | said[q]
                    name, hub = sorted((x, y), key=lambda r: (n[r], -ids[r]))
                    found.append((ids[name], ids[hub], d, 0.0))
    width, best = Counter(), {}
    for d, x, y in open_:
        width[x] += names[y]
        if (x, top(y)) not in best and len(said[x] | said[top(y)]) < 2:
            said[x] = said[x] | said[top(y)]
            best[x, top(y)] = d, y
    found += [(ids[x], ids[y], d, -math.log2(1 + width[x])) for (x, _), (d, y) in best.items()]
    return pd.DataFrame(found, columns=["name_id", "hub_id", "edits", "rarity"])


def _every(read: DataFrame) -> DataFrame:
    """Links that connect all names that are near each other, whether or not they share a form.

    Names with the same reading are linked to the commonest of them, and readings are compared in
    groups of one line of business (first name); those that leave it open are in every group they fit.
    """
    best = F.min(F.struct((-F.col("n")).alias("n"), "name_id")).alias("b")
    readings = cut(read.groupBy("kind", "facet", "legal", "parts").agg(best, F.count("*").alias("names")).select("kind", "facet", "legal", "parts", "b.name_id", (-F.col("b.n")).alias("n"), "names"))
    same = read.join(readings.select("kind", "facet", "legal", "parts", F.col("name_id").alias("hub_id")), ["kind", "facet", "legal", "parts"]).where("name_id <> hub_id")
    same = same.select("name_id", "hub_id", F.lit(0).alias("edits"), F.lit(0.0).alias("rarity"))
    groups = readings.select(F.col("kind").alias("_kind"), F.col("facet").alias("group")).distinct()
    open_ = (F.col("facet") == "") | ((F.col("kind") == "p") & F.col("facet").endswith("."))
    into = (F.col("kind") == F.col("_kind")) & (F.col("group") != F.col("facet")) & (((F.col("kind") == "c") & (F.col("facet") == "")) | ((F.col("kind") == "p") & F.col("group").startswith(F.substring("facet", 1, 1))))
    more = readings.where(open_).join(bounded(groups, 10_000), into).drop("_kind")
    rows = readings.withColumn("group", F.col("facet")).unionByName(more)
    # a number of partitions given by hand: few bytes make much work here
    rows = rows.repartition(4 * slots(read.sparkSession), "kind", "group").groupBy("kind", "group")
    return same.unionByName(rows.applyInPandas(_spanned, "name_id bigint, hub_id bigint, edits int, rarity double"))


def name_links(names: DataFrame, name: str = "name") -> DataFrame:
    """Links (``name``, ``hub``, ``edits``, ``rarity``, ``score``) between spellings of one entity.

    Each distinct spelling links to some commoner spellings, not to all of its entity.  Besides
    the hubs of its forms these are so many that all spellings :func:`edits` accepts are connected.
    """
    distinct = names.select(F.col(name).alias("name")).where(F.length(F.trim("name")) > 0).groupBy("name").agg(F.count("*").alias("n"))
    distinct = distinct.repartition(slots(distinct.sparkSession)).withColumn("name_id", F.xxhash64("name"))
    read = cut(distinct.mapInPandas(_rewritten, _READ))
    forms_ = read.select("name_id", "n", "kind", "facet", "legal", F.explode("forms").alias("form"))
    held = cut(_compared(forms_, read))
    known = held.select("name_id", "hub_id").unionByName(held.select(F.col("hub_id").alias("name_id"), F.col("name_id").alias("hub_id")))
    held = held.unionByName(_every(read).join(known, ["name_id", "hub_id"], "left_anti"))
    about = read.select("name_id", "name", "facet")
    held = held.join(about, "name_id").join(about.select(F.col("name_id").alias("hub_id"), F.col("name").alias("hub"), F.col("facet").alias("hub_facet")), "hub_id")
    held = cut(held.select("name", "hub", "facet", "hub_facet", "edits", "rarity", (F.col("rarity") - F.col("edits")).alias("score")))
    # a name that leaves its facet open belongs to the one facet it meets, or to the one whose best
    # score stands out; else it is left alone, for its true owner cannot be told
    full = (F.col("facet") != "") & ~F.col("facet").endswith(".")
    wide = (F.col("hub_facet") != "") & ~F.col("hub_facet").endswith(".")
    best = held.where(~full & wide).groupBy("name", "hub_facet").agg(F.max("score").alias("score"))
    best = best.groupBy("name").agg(F.max(F.struct("score", "hub_facet")).alias("b"), F.count("*").alias("k")).select("name", F.col("b.hub_facet").alias("own"), F.col("b.score").alias("top"), "k")
    rivals = held.where(~full & wide).join(best.where("k > 1").select("name", "own", "top"), "name").where("hub_facet <> own").groupBy("name").agg(F.max("score").alias("next"))
    best = best.join(rivals, "name", "left").select("name", "own", (F.col("next") > F.col("top") - MARGIN).alias("torn"))
    open_ = held.where(~full).join(best, "name", "left").where(F.coalesce(~F.col("torn"), F.lit(True)) & (~wide | (F.col("hub_facet") == F.col("own"))))
    # nor do two such names that belong to different facets bring these together
    open_ = open_.join(best.select(F.col("name").alias("hub"), F.col("own").alias("hub_own")), "hub", "left").where(F.coalesce(F.col("own") == F.col("hub_own"), F.lit(True))).select(held.columns)
    alone = best.where("torn").select(F.col("name").alias("hub"))
    links = held.where(full).unionByName(open_).join(alone, "hub", "left_anti")
    return links.select("name", "hub", "edits", "rarity", "score")


def name_groups(names: DataFrame, name: str = "name") -> DataFrame:
    """``name`` and ``entity`` (the least spelling) of every spelling that has another one."""
    return components(name_links(names, name), "name", "hub").select(F.col("node").alias("name"), F.col("component").alias("entity"))


def name_pairs(names: DataFrame, name: str = "name") -> DataFrame:
    """All pairs of different spellings of one entity, ``name_a`` < ``name_b``."""
    g = cut(name_groups(names, name))
    return g.alias("a").join(g.alias("b"), F.col("a.entity") == F.col("b.entity")).where("a.name < b.name").select(F.col("a.name").alias("name_a"), F.col("b.name").alias("name_b"))
