from __future__ import annotations

import math
import re
from collections import Counter

import duckdb
import pytest

from arrearly.llm import lm_scores as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(rows, order=3, backoff=0.4, leave_out=True):
    texts = [WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for _, t in rows]
    grams = lambda w, k: Counter(tuple(w[i: i + k]) for i in range(len(w) - k + 1))
    total = [sum((grams(w, k) for w in texts), Counter()) for k in range(1, order + 1)]
    n_all = sum(map(len, texts))
    out = []
    for (doc, _), w in zip(rows, texts):
        own = [grams(w, k) if leave_out else Counter() for k in range(1, order + 1)]
        c = lambda g: total[len(g) - 1][g] - own[len(g) - 1][g]  # noqa: B023, E731
        rest = max(n_all - (len(w) if leave_out else 0), 1)
        micro = backed = 0
        for i in range(len(w)):
            top = min(order, i + 1)
            for k in range(top, 0, -1):
                g = tuple(w[i - k + 1: i + 1])
                if c(g) > 0 or k == 1:
                    p = c(g) / c(g[:-1]) if k > 1 else max(c(g), 1)
                    micro += round((math.log10(p) + (top - k) * math.log10(backoff)) * L.UNIT) - (round(math.log10(rest) * L.UNIT) if k == 1 else 0)
                    backed += top > k
                    break
        out.append((doc, len(w), micro, backed))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_sql_on_small_tables(small, sf0001):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf0001}/documents.parquet')")
    want = sorted((tuple(r) for r in con.execute(L.SQL).fetchall()), key=repr)
    assert rows(L.contract(small("documents"))) == want
    # many blocks and hash partitions give the same
    got = L.score(small("documents"), block_chars=20_000, part_chars=50_000).select("doc_id", "n_words", "micro_log10", "n_backed_off")
    assert rows(got) == want


@pytest.mark.parametrize("order,leave_out", [(1, True), (2, True), (3, False), (4, True)])
def test_edges_against_brute_force(docs_of, words, order, leave_out):
    texts = [(1, words(1, 50)), (2, words(1, 50)), (2, words(1, 50)), (None, words(2, 30) + " " + words(1, 20)), (4, None), (5, ""), (6, "?!"),
             (7, "one"), (8, "one two"), (9, "Éa éa ÉA"), (10, words(3, 3000))]
    got = rows(L.score(docs_of(texts), order=order, leave_out=leave_out, block_chars=500, part_chars=900))
    assert got == brute(texts, order, leave_out=leave_out)


def test_very_long_text(docs_of, words):
    texts = [(1, words(1, 60_000)), (2, words(1, 30)), (3, "word " * 40_000), (3, words(2, 20))]
    for sizes in ({}, {"block_chars": 50_000, "part_chars": 20_000}):
        assert rows(L.score(docs_of(texts), **sizes)) == brute(texts)


def test_one_document_and_none(docs_of):
    assert rows(L.score(docs_of([(1, "a b a")]))) == brute([(1, "a b a")])
    assert L.score(docs_of([(1, "a")]).limit(0)).count() == 0


def plain_counts(rows, order=3):
    out = Counter()
    for _, t in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        for k in range(1, order + 1):
            out.update((k, " ".join(w[i: i + k])) for i in range(len(w) - k + 1))
    return out


@pytest.mark.parametrize("sizes", [{}, {"block_chars": 300, "part_chars": 200}])
def test_count_table(docs_of, words, sizes):
    texts = [(1, words(1, 80)), (2, words(1, 80)), (3, None), (4, "one ONE one"), (None, "été 文 été"), (6, "")]
    got = {(r.n, r.hash): r["count"] for r in L.count_table(docs_of(texts), **sizes).collect()}
    want = plain_counts(texts)
    w = L.Words([g.encode() for _, g in want])
    hashed = {}
    for i, (k, g) in enumerate(want):
        a = int(w.bounds[i])
        own = L.Grams([g.encode()], k).orders[k - 1][0]
        assert len(own) == 1 and int(w.bounds[i + 1]) - a == k
        hashed[k, int(own.view("int64")[0])] = want[k, g]
    assert got == hashed


def test_scores_against_a_table_of_another_corpus(spark, docs_of, words):
    corpus = [(i, words(i % 4, 60)) for i in range(8)] + [(50, "rare pair here")]
    asked = [(1, words(0, 40) + " rare pair here"), (2, "nothing known 文字 at all"), (3, None), (3, None), (4, words(2, 3000)), (None, "rare")]
    table = L.count_table(docs_of(corpus))
    # Scoring the corpus itself is the plain score without leaving a document out.
    assert rows(L.score_against(docs_of(corpus), table)) == rows(L.score(docs_of(corpus), leave_out=False)) == brute(corpus, leave_out=False)
    want = {k: v for k, v in ((r[0], r) for r in brute_against(asked, corpus))}
    for part_rows in (2_000_000, 10):
        got = rows(L.score_against(docs_of(asked), table, part_rows=part_rows, block_chars=400))
        assert len(got) == 6 and {r[0]: r for r in got} == want
    # An empty table knows no word, and N is 1.
    assert {r.micro_log10 for r in L.score_against(docs_of([(1, "a")]), table.limit(0)).collect()} == {0}
    assert L.score_against(docs_of(asked).limit(0), table).count() == 0


def brute_against(asked, corpus, order=3, backoff=0.4):
    total = plain_counts(corpus, order)
    n_all = sum(c for (k, _), c in total.items() if k == 1)
    for doc, t in asked:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        micro = backed = 0
        for i in range(len(w)):
            top = min(order, i + 1)
            for k in range(top, 0, -1):
                c = total[k, " ".join(w[i - k + 1: i + 1])]
                if c > 0 or k == 1:
                    p = c / total[k - 1, " ".join(w[i - k + 1: i])] if k > 1 else max(c, 1)
                    micro += round((math.log10(p) + (top - k) * math.log10(backoff)) * L.UNIT) - (round(math.log10(max(n_all, 1)) * L.UNIT) if k == 1 else 0)
                    backed += top > k
                    break
        yield doc, len(w), micro, backed
