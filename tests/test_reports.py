from orelode.sources import reports

REPORT = """Sites of the north
2.1 Copper
Letpadaung Mine: This is the largest pit.
It is located in the Sagaing Region, and run by Wanbao Mining Ltd. since 2012.

The site is operational.
Mawchi (Kayah State): Historically a source of tungsten.
Production was shuttered.
Department of Mines (Naypyidaw): licences
Lead is not meant here.
Acme Holdings Project: owned by others
3 Oil and gas
Yadana Offshore Gas Field: proposed
Upper Red River Valley Old Copper Smelter Complex (Shan State): active
4. Tin
- Alpha Tin Quarry (Dawei): closed
* Beta Hill Mill - suspended
5) Gamma Hill Mine: closed in 1998
Delta Pit is open.
"""


def test_narrative_scan():
    got = {s["name"]: s for s in reports.narrative(REPORT)}
    assert list(got) == ["Letpadaung Mine", "Mawchi", "Yadana Offshore Gas Field", "Upper Red River Valley Old Copper Smelter Complex", "Alpha Tin Quarry", "Beta Hill Mill", "Gamma Hill Mine", "Delta Pit"]
    first = got["Letpadaung Mine"]
    assert (first["location"], first["primary"], first["types"], first["status"], first["operator"]) == ("Sagaing Region", "copper", "mine", "operating", "Wanbao Mining Ltd.")
    assert first["notes"].startswith("It is located") and first["notes"].endswith("operational.")
    facts = {n: (s["location"], s["primary"], s["types"], s["status"]) for n, s in got.items()}
    assert facts["Mawchi"] == ("Kayah State", "copper, tungsten", "mine", "closed")
    assert facts["Yadana Offshore Gas Field"] == ("", "natural gas", "mine", "planned")
    assert facts["Upper Red River Valley Old Copper Smelter Complex"] == ("Shan State", "natural gas", "smelter", "operating")
    assert facts["Alpha Tin Quarry"] == ("Dawei", "tin", "quarry", "closed") and facts["Beta Hill Mill"][3] == "suspended" and facts["Delta Pit"][3] == "unknown"


def test_context_is_nine_lines():
    site = "Alpha Mine:\n" + "x\n" * 8
    assert [s["status"] for s in reports.narrative(site + "closed") + reports.narrative(site + "x\nclosed")] == ["closed", "unknown"]
    assert reports.narrative("") == [] and reports.narrative("Nothing: here") == []


def test_prose_with_commas_is_no_listing():
    assert reports.listing("Rainfall closed the haul road to the mine site, about 934 metres from the present portal. Local suppliers delivered timber, lime and metals\na, b, c, d") is None
    assert reports.listing("The site, a mine of the region, has no operator.\n\nNothing else") is None and reports.listing("") is None and reports.listing('Site Name,Operator,Location\n"' + "x" * 200_000 + '"') is None


def test_a_listing_comes_first(spark):
    listed = 'Site Name,Operator,Location\n"Alpha, Upper",Acme\n\nBeta,Ace,North,more\n'
    prose = "The site, a mine of the region, has no operator.\n\nSite Name | Operator | Location\n--- | --- | ---\nC | D | E"
    got = reports.parse_reports(spark.createDataFrame([(1, listed), (2, prose)], "doc_id long, text string")).collect()
    cells = {(r["doc_id"], r["format"], r["row_no"], r["header"]): r["value"] for r in got}
    assert cells[1, "csv", 0, "name"] == "Alpha, Upper" and cells[1, "csv", 0, "Location"] == "" and cells[1, "csv", 1, "Location"] == "North"
    assert cells[2, "pipe", 0, "operator"] == "D" and len(cells) == 9


def test_tab_tables_go_on_over_notes_and_blank_lines(spark):
    head, row = "Site Name\tLatitude\tNotes\tOperator", "{}\t1.5\tlong notes\tAcme"
    text = "\n".join([head, row.format("A"), "second line of the notes", "", "Historic workings to the north", row.format("B"), "", "", "", "", row.format("C"), "The notes go on", row.format("D"), "", "Refineries of the south", row.format("lost")])
    docs = [(1, text), (2, "\n".join([head, row.format("A"), *[""] * 5, row.format("lost")])), (3, "\n".join([head, row.format("A"), "", "Mine Name\tStatus\tLocation", "B\tclosed\tNorth"]))]
    got = reports.parse_reports(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    names = {n: [r["value"] for r in sorted(got, key=lambda r: (r["table_no"], r["row_no"])) if r["doc_id"] == n and r["header"] == "name"] for n in (1, 2, 3)}
    assert names == {1: ["A", "B", "C", "D"], 2: ["A"], 3: ["A", "B"]}
    assert [r["value"] for r in got if r["doc_id"] == 3 and r["header"] == "status"] == ["closed"]
