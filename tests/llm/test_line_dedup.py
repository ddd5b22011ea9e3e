from __future__ import annotations

import hashlib

import duckdb

from arrearly.llm import line_dedup as L


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(rows):
    small = lambda i: (i is not None, i if i is not None else 0)
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) < 2 or doc == min(holders[key(x)], key=small)]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_small_table_against_sql_and_brute_force(small, sf0001):
    docs = small("documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert rows(L.contract(docs)) == want and any(x[2] for x in want)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf0001}/documents.parquet')")
    assert sorted((tuple(r) for r in con.execute(L.SQL).fetchall()), key=repr) == want


EDGES = [
    (5, "A line of some length\n  a LINE of some length\t\nshort\nonly here, a line"), (3, "other words at first\r\na line of some length"),
    (9, "a line of some length"), (9, "a line of some length"), (9, "again a different text\nshort"), (None, "Only Here, a line\nÉté à la plage"),
    (7, "ÉTÉ à la plage\nété à la plage\nxété à la plage"), (8, "Été À la plage\nÉté à la plage"), (1, None), (2, ""), (4, "\n\n\n"), (6, "short\nshort"),
    (11, " a line of some length"), (12, "ten points\nnine poin"), (13, "TEN POINTS\nnine poin"), (14, "\n".join(f"row number {i % 700}" for i in range(30000))),
    (15, "\n".join(f"row number {i}" for i in range(0, 900, 3)) + "\n"),
]


def test_edges(docs_of):
    assert rows(L.contract(docs_of(EDGES))) == brute(EDGES)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", EDGES)
    # Repeated rows of one doc_id and null ids count the same in both.
    assert sorted((tuple(r) for r in con.execute(L.SQL).fetchall()), key=repr) == brute(EDGES)
    hot = [(i, f"the one very common line\nown line of document {i}\nthe one very common line") for i in range(3000)]
    assert rows(L.contract(docs_of(hot))) == brute(hot)


def test_frequent_lines_are_dealt_by_their_share(spark, docs_of):
    rows = spark.range(20_000).selectExpr("CASE WHEN id % 2 = 0 THEN 7 WHEN id % 10 = 1 THEN 8 ELSE id + 100 END AS h1").repartition(4)
    assert {r.h1: r.salts for r in L.frequent_lines(rows, 20).collect()} == {7: 10, 8: 2}
    assert L.frequent_lines(rows.limit(0), 20).count() == 0
    few = [(i, "\n".join(["one very common line"] * (i % 3) + [f"line of three {i % 3}", f"own line number {i}"])) for i in range(400)]
    for slices in (2, 16, 1024):
        docs = docs_of(few)
        got = {r.doc_id: r.n_dropped for r in L.keep_bitmaps(docs, slices=slices).collect()}
        assert got == {d: n for d, _, n, _ in brute(few) if n}


def test_bitmaps_and_texts(docs_of):
    docs = docs_of([(1, "first long line\nb\nsecond long line\n"), (2, "x\nfirst long line\nSecond long line\ny\nsecond LONG line"), (3, None)])
    assert [(r.doc_id, r.keep_bitmap, r.n_dropped) for r in L.keep_bitmaps(docs).collect()] == [(2, [1, 2, 1, 1], 3)]
    out = L.dedup_lines(docs)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out.collect()) == [(1, "first long line\nb\nsecond long line\n", 35), (2, "x\ny", 3), (3, None, 0)]
    assert L.contract(docs.limit(0)).count() == 0 and L.dedup_lines(docs.limit(0)).count() == 0


def test_emptied_documents_go_if_asked(docs_of):
    docs = docs_of([(1, "a line that several have\nanother line of many"), (2, "Another line of many\n ... \nA line that several have"),
                    (3, "a line that several have\nown"), (4, ""), (5, None), (6, "\n--\n"), (7, "a line that several have\n文")])
    left = {r.doc_id: r.text for r in L.dedup_lines(docs, drop_emptied=True).collect()}
    assert left == {1: "a line that several have\nanother line of many", 3: "own", 4: "", 5: None, 6: "\n--\n", 7: "文"}
    assert L.dedup_lines(docs).count() == 7


def test_plan_is_native(docs_of):
    plan = L.contract(docs_of(EDGES, extra=False))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "MapIn", "CartesianProduct")) and "rangepartitioning" in plan
