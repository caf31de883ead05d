"""Free-form reports to rows: listings, pipe and tab tables, concatenated tables and narrative lines.

Each document is scanned whole by one Arrow task; a document without any site gives no row, as do
null and blank texts.  A listing with commas wins over tables, these over concatenated text, and
that over narrative lines.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orelode.functions import fixed

ROW = "doc_id bigint, format string, table_no int, row_no int, header string, value string"
KINDS = r"mine|quarry|pit|smelter|refinery|plant|concentrator|mill|colliery|deposit|project"
# How lines introduce sites ("Name Mine (Location):", "Name (Location):", "- Name Mine:"),
# what headings look like, and what is no site but an agency, a company or a mere commodity.
INTRODUCED = (
    r"([A-Z][^:\n]+?(?:Mine|Project|Complex|Plant|Refinery|Smelter|Deposit|Field|Quarry|Basin))\s*(?:\(([^)]+)\))?\s*:", r"([A-Z][^:\n]+?)\s*\(([^)]+)\)\s*:",
    r"[\-•]\s*([A-Z][^:\n]+?(?:Mine|Project|Complex|Plant|Refinery|Smelter|Deposit|Field|Quarry))\s*(?:\(([^)]+)\))?\s*:",
)
SECTION, HEADING = r"(?:Section\s+)?(\d+\.?\d*)\s+(.+?)(?:\s*-\s*(.+?))?$", r"(?:Section\s+)?\d{1,2}(?:\.\d*)*\s+[A-Z]"
NO_SITE = (
    r"\b(?:department|ministry|council|agency|commission|authority|bureau|administration)\b", r"\b(?:government|federal|national|state|provincial)\s+(?:of|for)\b", r"^(?:platinum group metals?|precious metals?|base metals?|rare earths?|commodities?)$",
    r"^(?:gold|copper|iron|coal|diamonds?)$", r"\b(?:corporation|company|enterprises?|holdings?|ltd|inc|plc|limited)\b", r"\b(?:services?|solutions?|consulting|investments?)\b", r"^(?:the\s+)?(?:mining|minerals?|resources?)\s+(?:industry|sector)$",
)
# Commodities of section titles and of texts, places, kinds, statuses and operators.
SECTION_METALS = {k: k for k in "copper lead zinc tin tungsten nickel gold silver jade".split()} | {"ruby": "precious stones", "sapphire": "precious stones", "iron": "iron", "coal": "coal", "rare earth": "rare earths", "antimony": "antimony", "gas": "natural gas", "oil": "petroleum", "cement": "limestone", "marble": "marble"}
TEXT_METALS = {k: rf"\b{k}\b" for k in "copper lead zinc gold silver tin tungsten nickel iron coal jade ruby antimony".split()} | {"rare earths": r"\brare earth", "natural gas": r"\bnatural gas\b|\bgas\b"}
PLACES = (r"\b(?:located\s+in|situated\s+in|located|situated|in)\s+(?:the\s+)?([A-Z][^,\.]+(?:Region|State|Province|District|Township|Area))", r"\(([A-Z][^)]+(?:Region|State|Province|District))\)")
NAMED_TYPES = {"mine": r"\bmine\b", "smelter": r"\bsmelter\b", "refinery": r"\brefinery\b", "plant": r"\bplant\b|\bfactory\b", "complex": r"\bcomplex\b", "deposit": r"\bdeposit\b", "project": r"\bproject\b", "quarry": r"\bquarry\b"}
TEXT_STATUSES = {"operating": r"\boperating\b|\boperational\b|\bactive\b|\bproducing\b", "closed": r"\bclosed\b|\binactive\b|\bshuttered\b", "construction": r"\bunder construction\b|\bdeveloping\b|\bin development\b", "planned": r"\bplanned\b|\bproposed\b|\bcontracted\b"}
RUN_BY = tuple(rf"(?:{by})\s+([A-Z][^,\.;]+?(?:Ltd|Limited|Co\.|Corporation|Inc|Company|Group|Enterprise)\.?)" for by in ("operated by|operator|run by", "owned by|owner"))
CONTEXT_LINES = 9


def normal_header(header: str) -> str:
    """The standard name of a table header; the first rule that fits counts, others stay raw."""
    h = header.lower().strip()
    rules = (
        ("name", any(x in h for x in fixed.SITE_HEADERS) or h == "name"), ("group_names", "group name" in h), ("synonyms", "synonym" in h or "alias" in h), ("lat", "latitude" in h or h == "lat"), ("lon", "longitude" in h or h == "lon"),
        ("primary", "primary commodity" in h), ("other", any(x in h for x in ("secondary commodities", "secondary commodity", "other commodities"))), ("types", "asset type" in h or "facility type" in h), ("status", "status" in h),
        ("confidence_factor", "confidence factor" in h), ("country", "country" in h), ("operator", any(x in h for x in ("operating company", "operator", "stakeholder"))), ("notes", "note" in h),
    )
    return next((name for name, fits in rules if fits), header)


def is_facility_table(headers: list[str]) -> bool:
    return len(headers) >= 2 and sum(w in h.lower() for h in headers for w in fixed.TABLE_WORDS) >= 3


def is_header(cells: list[str]) -> bool:
    """Whether a row within a table is the header of another one."""
    known = {normal_header(x) for x in cells} & {"name", "group_names", "synonyms", "lat", "lon", "primary", "other", "types", "status", "country", "operator", "notes"}
    return is_facility_table(cells) and "name" in known and len(known) > 1 and not any(re.search(r"\d", x) for x in cells)


def is_heading(line: str) -> bool:
    """Whether a line without tabs begins a new section, rather than going on with notes."""
    return len(line) > 10 and line[0].isupper() and not line.startswith(("Historic", "One of", "Part of", "A ")) and ":" not in line


def valid_name(c: Column) -> Column:
    """Whether a cell can be the name of a site."""
    low = F.lower(F.trim(c))
    return c.isNotNull() & (low != "") & ~low.rlike("|".join(f"(?:{p})" for p in fixed.NOT_NAMES))


def tables(text: str) -> list[tuple[str, list[list[str]]]]:
    """(format, rows with the header first) of every table in a text; short rows are padded, long
    ones cut to the header.

    A tab table goes on over up to four lines without tabs, notes and blank lines, until a heading
    that follows one of them; pipe tables go on over blank lines only.  After such lines another
    header begins a table of its own.
    """
    found, block, kind, gap = [], [], None, 0

    def close() -> None:
        nonlocal block, kind, gap
        rows = [r for r in block if not all(re.fullmatch(r":?-{2,}:?", x) or not x for x in r)]
        if len(rows) >= 2:
            n = len(rows[0])
            found.append((kind, [(r + [""] * n)[:n] for r in rows]))
        block, kind, gap = [], None, 0

    for line in text.split("\n"):
        sep = "|" if line.count("|") >= 2 else "\t" if line.count("\t") >= 2 else None
        if sep:
            if kind and sep != {"pipe": "|", "tab": "\t"}[kind]:
                close()
            kind = "pipe" if sep == "|" else "tab"
            cells = [x.strip() for x in line.strip().strip("|" if sep == "|" else "").split(sep)]
            if gap and is_header(cells):
                close()
                kind = "tab"
            block.append(cells)
            gap = 0
        elif kind == "tab":
            gap += 1
            if gap >= 5 or gap > 1 and is_heading(line.strip()):
                close()
        elif line.strip():
            close()
    close()
    return found


def listing(text: str) -> list[list[str]] | None:
    """The rows, header first, of a text that is one comma-separated listing of sites; else null."""
    start = text.strip().lstrip("\ufeff")
    if start.split("\n", 1)[0].count("|") >= 2:
        return None
    reader = csv.reader(io.StringIO(start, newline=""))
    try:
        head = [h.strip() for h in next(reader, [])]
        # prose with commas is no header
        if not is_facility_table(head) or any(len(h) > 60 or re.search(r"[.!?]\s+[A-Z]", h) for h in head):
            return None
        rows = [[x.strip() for x in r] for r in reader if r]
    except csv.Error:
        return None
    n = len(head)
    return [head, *((r + [""] * n)[:n] for r in rows)] if any(len(r) >= n for r in rows) else None


def _introduced(line: str, flags: int = 0) -> tuple[str, str, str] | None:
    """(name, location, rest of the line) where a line introduces a site."""
    for p in INTRODUCED if ":" in line else ():
        if m := re.match(p, line, flags):
            name, place = m[1], m[2] or ""
            if inner := re.search(r"\(([^)]+)\)", name):
                name, place = re.sub(r"\s*\([^)]+\)", "", name), inner[1]
            return name, place, line[m.end() :]
    m = re.match(rf"(?:[-*•]|\d+[.)])?\s*((?:[A-Z][\w'-]*\s+){{1,4}}(?i:{KINDS}))\b\s*(?:[:(–-]|\bis\b)\s*(.*)", line)
    return (m[1], "", m[2]) if m else None


def _attributes(name: str, place: str, own: str, context: str, metal: str) -> dict[str, str] | None:
    name = re.sub(r"\s+", " ", name).strip()
    if len(name) < 3 or any(re.search(p, name.lower()) for p in NO_SITE):
        return None
    texts = (own, context)  # what the line itself says comes first

    def first(patterns) -> str:
        return next((m[1].strip() for t in texts for p in patterns if (m := re.search(p, t, re.IGNORECASE))), "")

    status = next((k for t in texts for k, p in TEXT_STATUSES.items() if re.search(p, t, re.IGNORECASE)), "")
    if not status:
        word = re.search(rf"\b({fixed.STATUS_WORDS})\b", own.lower())
        status = word[1] if word else "unknown"
    metals = {k for t in texts for k, p in TEXT_METALS.items() if re.search(p, t, re.IGNORECASE)} | ({metal} if metal else set())
    return {
        "name": name, "location": place.strip() or first(PLACES), "primary": ", ".join(sorted(metals)), "types": next((k for k, p in NAMED_TYPES.items() if re.search(p, name, re.IGNORECASE)), "mine"), "status": status, "operator": first(RUN_BY), "notes": (context or own.strip())[:200],
    }


def narrative(text: str) -> list[dict[str, str]]:
    """Sites that lines introduce as "Name Mine (Location): ...", "Name (Location): ...",
    "- Name Mine: ..." or "Name Mine is ...", with location, commodities, type, status, operator and notes.

    They are found in the rest of the line and in up to nine lines after it, which the next site or
    numbered heading ends; the heading's commodity holds for the sites below it.  Agencies, companies
    and mere commodities are no sites.
    """
    out, metal, i = [], "", 0
    lines = [x.strip() for x in text.split("\n")]
    while i < len(lines):
        line = lines[i]
        section = re.match(SECTION, line) if len(line) < 100 else None
        if section:
            metal = next((v for k, v in SECTION_METALS.items() if k in section[2].lower()), metal)
        found = _introduced(line, re.IGNORECASE)
        i += 1
        if not found:
            continue
        context = []
        for after in lines[i : i + CONTEXT_LINES]:
            if _introduced(after) or len(after) < 100 and re.match(HEADING, after):
                break
            context.append(after)
        i += len(context)
        name, place, own = found
        if site := _attributes(name, place, own, " ".join(x for x in context if x), metal):
            out.append(site)
    return out


def concatenated(text: str) -> list[tuple[str, str, str]]:
    """(name, status, commodity) rows of a table whose cells ran together, like
    "NameStatusCommodityAlpha MineoperatingGold": longest words first, up to an empty line."""
    m = re.search(r"(?i)name\s*status\s*commodity", text)
    if not m:
        return []
    body = re.split(r"\n\s*\n", text[m.end() :])[0]
    status = "|".join(sorted((re.escape(s) for s in fixed.STATUSES), key=len, reverse=True))
    metal = "|".join(sorted({re.escape(x) for kv in fixed.METALS.items() for x in kv if len(x) > 2}, key=len, reverse=True))
    return [(a.strip(), b.lower(), c.lower()) for a, b, c in re.findall(rf"([A-Z][^\n|]*?)\s*((?i:{status}))\s*((?i:{metal}))(?=[A-Z\s]|$)", body)]


def parse_reports(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a cell: document, format, table and row number, standard header, value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "format", "table_no", "row_no", "header", "value"]
        schema = pa.schema([("doc_id", pa.int64()), ("format", pa.string()), ("table_no", pa.int32()), ("row_no", pa.int32()), ("header", pa.string()), ("value", pa.string())])
        for b in batches:
            rows = []
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                if not t:
                    continue
                listed = listing(t)
                known = [("csv", listed)] if listed else [(k, r) for k, r in tables(t) if is_facility_table(r[0])]
                for no, (kind, table) in enumerate(known):
                    heads = [normal_header(h) for h in table[0]]
                    rows += [(i, kind, no, n, h, v) for n, r in enumerate(table[1:]) for h, v in zip(heads, r)]
                joined = [] if known else concatenated(t)
                for n, cells in enumerate(joined):
                    rows += [(i, "concatenated", 0, n, h, v) for h, v in zip(("name", "status", "primary"), cells)]
                if not known and not joined:
                    for n, site in enumerate(narrative(t)):
                        rows += [(i, "narrative", 0, n, h, v) for h, v in site.items()]
            cols = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, ROW)
