from __future__ import annotations

import re

import corpus_pipeline as P
from arrearly.llm import decontaminate, jaccard_join, language_id, line_dedup
from arrearly.llm.common import written


def test_stages_on_their_own_input(spark, sf0001, small):
    docs = small("documents")
    names = [n for n, _ in P.STAGES]
    assert names == ["language_id", "line_dedup", "jaccard_join", "decontaminate", "packing"] and P.ORACLE_SQL is None
    made = {}
    for name, stage in P.STAGES:
        out = written(stage(spark, docs, sf0001), f"t-{name}")
        if name != "packing":
            assert out.columns == small("documents").columns
        made[name] = (docs, out)
        docs = out
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    before, after = made["language_id"]
    assert ids(after) == {r.doc_id for r in before.collect() if language_id.has_letter(r.text)}
    before, after = made["line_dedup"]
    dropped = {r.doc_id for r in line_dedup.contract(before).collect() if r.n_dropped}
    gone = ids(before) - ids(after)
    left = {r.doc_id: r.text for r in line_dedup.dedup_lines(before).collect()}
    assert gone == {i for i in dropped if not re.search("[0-9A-Za-z\x80-\U0010ffff]", left[i])}
    assert line_dedup.contract(after).agg({"n_dropped": "sum"}).first()[0] == 0
    assert {r.doc_id: r.text for r in after.collect()} == {i: t for i, t in left.items() if i not in gone}
    before, after = made["jaccard_join"]
    assert ids(after) == {r.class_id for r in jaccard_join.contract(before).collect()}
    before, after = made["decontaminate"]
    hit = {r.doc_id for r in decontaminate.contract(before, small("benchmark")).collect() if r.contaminated}
    assert ids(after) == ids(before) - hit
    before, after = made["packing"]
    assert ids(before) == ids(after)
    assert all(re.search(r"\w", r.text) for r in before.collect()) and after.where("length <= 1 AND piece = 0").count() == 0
    run = P.run(spark, sf0001)
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in run.collect()) == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in after.collect())


def test_language_stage_depends_on_its_model(spark, sf0001, docs_of, words):
    es = [f"la casa de los niños y la señora que canta en la mañana {words(i, 6)}" for i in range(20)]
    de = [f"der schöne Garten und die große Straße mit den Häusern {words(i + 50, 6)}" for i in range(20)]
    rows = [(i, t, "es") for i, t in enumerate(es)] + [(i + 100, t, "de") for i, t in enumerate(de)]
    asked = [(1000, es[3] + " y los niños", None), (1001, de[4] + " und die Straße", None), (1002, es[5], "xx"), (1003, "12 34", "es")]
    kept = {r.doc_id: r.lang for r in P.keep_known_languages(spark, docs_of(rows + asked), sf0001).collect()}
    assert kept[1000] == "es" and kept[1001] == "de" and kept[1002] == "xx" and 1003 not in kept and len(kept) == 43
    # Other labels, another model, other languages.
    swapped = [(i, t, {"es": "b", "de": "a"}[x]) for i, t, x in rows]
    kept = {r.doc_id: r.lang for r in P.keep_known_languages(spark, docs_of(swapped + asked), sf0001).collect()}
    assert kept[1000] == "b" and kept[1001] == "a"


def test_edges(spark, sf0001, docs_of):
    rows = [(1, None), (2, ""), (3, "text of one document in words"), (3, "text of one document in words"), (None, "a line without any id at all"), (5, "x " * 300000)]
    for source in (docs_of(rows), docs_of(rows).limit(0)):
        docs = source
        for name, stage in P.STAGES:
            docs = written(stage(spark, docs, sf0001), f"e-{name}")
            if name != "packing":
                assert docs.columns == source.columns
    assert docs.count() == 0
