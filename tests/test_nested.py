import json

from pyspark.sql import functions as F

from orelode.operators.nested import TREE, branch, child_table, flatten_documents


def brute(body):
    try:
        doc = json.loads(body.lstrip("﻿ \n"))
    except (ValueError, AttributeError):
        return []
    doc = doc if "facility_id" in doc else doc.get("facility") or doc.get("payload", {}).get("facility") or doc.get("payload") or doc
    out = []

    def elements(x):
        if isinstance(x, str) and x.strip()[:1] in ("[", "{"):
            x = json.loads(x)
        if isinstance(x, list):
            return [(i, e) for i, e in enumerate(x) if e is not None]
        if isinstance(x, dict):
            return [(int(k), e) for k, e in x.items() if e is not None] if all(k.isdigit() for k in x) else [(0, x)]
        return [(0, x)] if isinstance(x, str) and x.strip() else []

    def walk(name, value, parent, inner):
        single = name in ("verification", "fix")
        for pos, e in elements(value)[: 1 if single else None]:
            node = (f"{parent}." if parent else "") + name + ("" if single else f"[{pos}]")
            out.append((parent, node))
            if isinstance(e, str) and e.strip()[:1] == "{":
                e = json.loads(e)
            if isinstance(e, dict):
                for k, deeper in inner.items():
                    walk(k, e.get(k), node, deeper)

    for name, inner in (("commodities", {"products": {}}), ("sources", {"evidence": {}}), ("verification", {"issues": {"fix": {}}, "history": {}})):
        walk(name, doc.get(name), "", inner)
    return sorted(out)


BODIES = {
    1: '{"facility_id": "a", "commodities": [{"metal": "gold", "products": [{"stream": "ore"}, null, {"stream": "dore"}]}, null, "zinc"], "sources": {"id": "x", "evidence": {"title": "t"}}}',
    2: '﻿{"payload": {"facility": {"facility_id": "b", "commodities": "[{\\"metal\\": \\"tin\\"}]", "verification": {"issues": [{"fix": {"lat": 1}}, {"fix": null}], "history": {"0": {"status": "s"}, "2": "x"}}}}}',
    3: '{"facility_id": "c", "commodities": "silver", "sources": [], "verification": "{\\"status\\": \\"ok\\", \\"issues\\": []}"}',
    4: '{"facility_id": "d", "commodities": [{"metal": "gold"',
    5: None,
    6: "",
    7: '{"facility": {"facility_id": "e", "commodities": {"0": "lead", "1": {"metal": "iron", "products": "ore"}}, "verification": [{"issues": {"type": "t", "fix": "swap"}}]}}',
    8: "[1, 2]",
    9: '{"facility_id": "f", "commodities": null, "sources": "", "verification": null, "note": "' + "long " * 50_000 + '"}',
}


def test_every_notation_against_a_row_by_row_parser(spark):
    df = spark.createDataFrame([(i, b, "extra", "x") for i, b in BODIES.items()], "raw_id long, body string, node string, key string")
    got = {}
    for r in flatten_documents(df, "raw_id", "body").collect():
        got.setdefault(r["raw_id"], []).append((r["parent_node"], r["node"]))
    assert {i: sorted(v) for i, v in got.items()} == {i: b for i, v in BODIES.items() if (b := brute(v) if i != 8 else [])}


def test_child_tables_keep_their_links(spark):
    df = spark.createDataFrame([(1, BODIES[1])], "raw_id long, body string")
    nodes = flatten_documents(df, "raw_id", "body", payload=True)
    metals = {(r["node"], r["metal"]) for r in child_table(nodes, "raw_id", "commodities", {"metal": "metal string"}).collect()}
    assert metals == {("commodities[0]", "gold"), ("commodities[2]", "zinc")}
    streams = child_table(nodes, "raw_id", "products", {"stream": "stream string"}).collect()
    assert {(r["parent_node"], r["node"], r["stream"]) for r in streams} == {("commodities[0]", "commodities[0].products[0]", "ore"), ("commodities[0]", "commodities[0].products[2]", "dore")}


def test_verification_and_fix_have_tables(spark, tmp_path):
    from orelode.curation import QUERIES

    bodies = [(1, '{"facility_id": "a", "verification": {"status": "ok", "confidence": "0.65", "last_checked": "29 Jun 2025", "issues": [null, {"type": "t", "fix": {"lat": -1.5, "lon": "20"}}, {"fix": "swap"}, {"fix": null}]}}'), (2, '{"facility_id": "b", "verification": "[{\\"confidence\\": 0.3}]"}'), (3, '{"facility_id": "c", "verification": null}'), (4, '{"facility_id": "d", "verification": "pending"}')]
    spark.createDataFrame(bodies, "raw_id long, body string").write.parquet(str(tmp_path / "facility_raw.parquet"))
    got = {k: {tuple(r) for r in QUERIES[f"p2_{k}"](spark, str(tmp_path)).collect()} for k in ("verification", "fix", "issues")}
    assert got["verification"] == {(1, "", "verification", "ok", 0.65, "29 Jun 2025"), (2, "", "verification", None, 0.3, None), (4, "", "verification", "pending", None, None)}
    assert got["fix"] == {(1, "verification.issues[1]", "verification.issues[1].fix", None, -1.5, 20.0), (1, "verification.issues[2]", "verification.issues[2].fix", "swap", None, None)}
    # every child row has its parent's row
    assert {(r[0], r[1]) for r in got["fix"]} <= {(r[0], r[2]) for r in got["issues"]} and {(r[0], r[1]) for r in got["issues"]} <= {(r[0], r[2]) for r in got["verification"]}


def test_empty_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "raw_id long, body string")
    assert flatten_documents(empty, "raw_id", "body").count() == 0
    twice = spark.createDataFrame([(1, BODIES[3]), (1, BODIES[3]), (None, BODIES[3])], "raw_id long, body string")
    assert flatten_documents(twice, "raw_id", "body").count() == 3 * len(brute(BODIES[3]))


def test_one_kind_reads_its_branch_only(spark):
    bodies = ['{"facility_id": "a", "commodities": [{"metal": "cu", "products": [{"stream": "x"}, null, "y"]}, "au"], "verification": {"issues": [{"type": "t", "fix": "f"}], "history": ["h"]}}', "{", None]
    df = spark.createDataFrame(list(enumerate(bodies)), "id long, body string")
    every = flatten_documents(df, "id", "body", payload=True)
    for kind in ("commodities", "products", "verification", "issues", "fix", "history", "evidence"):
        got = flatten_documents(df, "id", "body", payload=True, kind=kind)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, every.where(F.col("kind") == kind).collect())), kind
    assert branch(TREE, "fix") == {"verification": {"issues": {"fix": {}}}}
