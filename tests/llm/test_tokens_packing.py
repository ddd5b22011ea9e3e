from __future__ import annotations

import bisect
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from arrearly.llm import packing as P
from arrearly.llm import token_counts as T
from arrearly.llm import tokens

HARD = ["", "a", "\n", " ", "x" * 5000, " " * 3000 + "end", "a  b \t\n\n c", "été ñandú ß 12345 don't I'LL", "𝄞🙂 mixed 文字", "<|endoftext|> text", "  a b", "\n" * 700 + "z"]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(tokens.vocabulary_path("byte_bpe_50k.json"))
    return lambda x: t.encode(x or "", add_special_tokens=False)


def test_ids_and_offsets(small, reference):
    for text in HARD + [r.text for r in small("documents").limit(60).collect()]:
        want = reference(text)
        ids = tokens.encode(text)
        assert ids.tolist() == want.ids, text[:40]
        if len(ids):
            first, after = tokens.char_spans(text, ids)
            assert first[0] == 0 and after[-1] == len(text) and (after > first).all()
            data = text.encode()
            at = np.concatenate(([0], np.cumsum(tokens._ranked("byte_bpe_50k")[1][ids])))
            begun = np.cumsum([(x & 0xC0) != 0x80 for x in data])
            assert first.tolist() == [int(begun[i]) - 1 for i in at[:-1]] and after.tolist() == [int(begun[i - 1]) for i in at[1:]]


def test_section_counts(docs_of, small, reference):
    docs = small("documents")
    totals = {r.doc_id: len(reference(r.text).ids) for r in docs.collect()}
    for rule in T.RULES:
        got = T.section_counts(docs, rule=rule).groupBy("doc_id").sum("n_tokens").collect()
        assert {r[0]: round(r[1], 6) for r in got} == totals, rule
    with pytest.raises(ValueError):
        T.section_counts(docs, rule="other")


def test_allocation_rules():
    first, after = np.array([0, 2, 5, 9]), np.array([2, 5, 9, 10])
    starts = np.array([0, 4, 4, 6])
    assert T.allocate(first, after, starts, 10, "start").tolist() == [2, 0, 1, 1]
    assert T.allocate(first, after, starts, 10, "majority").tolist() == [2, 0, 0, 2]
    assert np.allclose(T.allocate(first, after, starts, 10, "split"), [1 + 2 / 3, 0, 1 / 3 + 1 / 4, 3 / 4 + 1])
    assert T.lines("a\nb\n").tolist() == [0, 2] and T.lines("").tolist() == [0] and T.lines("\n\nx").tolist() == [0, 1, 2]


def test_section_edges(spark, docs_of):
    got = T.section_counts(docs_of([(1, None), (2, ""), (None, "a\nb"), (4, "x\n\ny"), (4, "x\n\ny")])).collect()
    assert sorted(((r.doc_id, r.section, r.start, r.end, r.n_tokens) for r in got), key=repr) == sorted(
        [(1, 0, 0, 0, 0.0), (2, 0, 0, 0, 0.0), (None, 0, 0, 2, 2.0), (None, 1, 2, 3, 1.0)] + 2 * [(4, 0, 0, 2, 2.0), (4, 1, 2, 3, 1.0), (4, 2, 3, 4, 1.0)], key=repr)
    assert T.section_counts(docs_of([(1, "a")]).limit(0)).count() == 0
    rows = spark.createDataFrame([(1, "one two", None), (2, "", "three")], "doc_id long, title string, body string")
    got = T.field_counts(rows, ["title", "body"]).orderBy("doc_id", "section").collect()
    assert [(r.doc_id, r.section, r.start, r.end) for r in got] == [(1, 0, 0, 8), (1, 1, 8, 9), (2, 0, 0, 1), (2, 1, 1, 7)]
    assert [sum(r.n_tokens for r in got if r.doc_id == i) for i in (1, 2)] == [len(tokens.encode("one two\n\n")), len(tokens.encode("\nthree\n"))]


def plain_sections(text, starts, rule, reference):
    """Tokens per section, character by character."""
    enc = reference(text)
    char_of, out, at = [], [0.0] * len(starts), 0
    for i, c in enumerate(text):
        char_of += [i] * len(c.encode())
    for token in enc.tokens:  # one character of it is one byte of the text
        chars = sorted(set(char_of[at: at + len(token)]))
        at += len(token)
        own = [bisect.bisect_right(starts, c) - 1 for c in chars]
        if rule == "start":
            out[own[0]] += 1
        elif rule == "majority":
            out[max(sorted(set(own)), key=own.count)] += 1
        else:
            for k in own:
                out[k] += 1 / len(own)
    assert at == len(char_of)
    return out


def test_section_counts_against_a_plain_count(docs_of, small, reference):
    texts = [r.text for r in small("documents").limit(25).collect()] + [h for h in HARD if h] + ["a\n\n\nb\n", "é\nñ\n文\n\n𝄞", "x <|endo\nftext|> y\n<|endoftext|>\n"]
    docs = docs_of(list(enumerate(texts)))
    for rule in T.RULES:
        got = {}
        for r in T.section_counts(docs, rule=rule).collect():
            got.setdefault(r.doc_id, {})[r.section] = r.n_tokens
        for i, text in enumerate(texts):
            starts = [0, *[k + 1 for k, c in enumerate(text) if c == "\n" and k + 1 < len(text)]]
            want = plain_sections(text, starts, rule, reference)
            assert np.allclose([got[i][k] for k in range(len(starts))], want), (rule, text[:40])


def test_sections_of_a_very_long_text(docs_of, reference):
    text = "".join(f"line {i} été <|endoftext|>\n" if i % 1000 == 0 else f"row {i} of many words\n" for i in range(40_000))
    got = T.section_counts(docs_of([(1, text), (2, "x" * 400_000)]), rule="majority").collect()
    lines = {r.section: r for r in got if r.doc_id == 1}
    assert len(lines) == 40_000 and round(sum(r.n_tokens for r in lines.values())) == len(reference(text).ids)
    assert all(text[r.start: r.end].endswith("\n") for r in lines.values())
    assert [r.n_tokens for r in got if r.doc_id == 2] == [len(reference("x" * 400_000).ids)]


def test_field_counts_repeated_tied_and_empty(spark, docs_of, reference):
    rows = [(1, "same", "same"), (1, "same", "same"), (2, None, None), (None, "", "x\ny"), (3, "é" * 3000, "<|endoftext|>")]
    df = spark.createDataFrame(rows, "doc_id long, title string, body string").selectExpr("*", "'t' AS text", "1 AS section", "2 AS sizes")
    for rule in T.RULES:
        got = sorted(((r.doc_id, r.section, r.start, r.end, round(r.n_tokens, 6)) for r in T.field_counts(df, ["title", "body"], rule=rule).collect()), key=repr)
        want = []
        for doc, *fields in rows:
            parts = [(f or "") + "\n" for f in fields]
            starts = [0, len(parts[0])]
            found = plain_sections("".join(parts), starts, rule, reference)
            want += [(doc, i, starts[i], starts[i] + len(parts[i]), round(found[i], 6)) for i in (0, 1)]
        assert got == sorted(want, key=repr), rule
    assert T.field_counts(df.limit(0), ["title", "body"]).count() == 0


def check_packing(got, texts, reference):
    """Every piece right, every sequence gapless; returns the sequences' number."""
    ids = {d: np.array(reference(t).ids + [2], "<u4") for d, t in texts}
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for d, own in by_doc.items():
        own.sort(key=lambda r: (r.piece, r.sequence_id))
        copies = sum(1 for x, _ in texts if x == d)
        own = own[::copies]
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == np.cumsum([0] + [r.length for r in own[:-1]]).tolist() and sum(r.length for r in own) == len(ids[d])
        assert all(r.length == 1024 for r in own[1:])
        assert all(r.ids_crc32 == zlib.crc32(ids[d][r.start: r.start + r.length].tobytes()) for r in own)
    assert set(by_doc) == {d for d, _ in texts}
    for own in by_seq.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0] + [r.length for r in own[:-1]]).tolist()
        assert sum(r.length for r in own) <= 1024
    return len(by_seq)


def test_packing_small_table(small, reference):
    texts = [(r.doc_id, r.text) for r in small("documents").collect()]
    got = P.contract(small("documents")).collect()
    n = check_packing(got, texts, reference)
    least = -(-sum(r.length for r in got) // 1024)
    assert n <= least * 1.02 + 1, (n, least)


def test_packing_edges(docs_of, reference):
    texts = [(1, None), (2, ""), (3, " ".join(["word"] * 1023)), (4, " ".join(["word"] * 1024)), (5, " ".join(["word"] * 5000)), (6, "x"), (6, "x"), (None, "no id"),
             (8, " " * 2000 + "y"), (9, "<|endoftext|>")]
    got = P.contract(docs_of(texts)).collect()
    check_packing(got, texts, reference)
    assert [r.length for r in got if r.doc_id == 3] == [1024] and sorted(r.length for r in got if r.doc_id == 4) == [1, 1024]
    assert sorted((r.piece, r.length) for r in got if r.doc_id == 5) == [(0, 5001 % 1024), (1, 1024), (2, 1024), (3, 1024), (4, 1024)]
    assert P.contract(docs_of([(1, "a")]).limit(0)).count() == 0
    assert P.cut(1, 4) == [(0, 1)] and P.cut(4, 4) == [(0, 4)] and P.cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_every_capacity_holds(docs_of, small):
    found = P.pieces(small("documents"))
    got = P.pack(found, max_docs=3, max_attention=400_000, shard_pieces=40).collect()
    by = {}
    for r in got:
        by.setdefault((r.shard, r.sequence), []).append(r.length)
    for own in by.values():
        assert own == [1024] or (sum(own) <= 1024 and len(own) <= 3 and (sum(x * x for x in own) <= 400_000 or len(own) == 1))
    assert len(got) == found.count()


def test_full_pieces_need_no_shard(spark):
    rows = [(i % 5 if i % 7 else None, i, 0, 1024, 9) for i in range(60)] + [(i, 0, 0, 500, 9) for i in range(6)]
    found = spark.createDataFrame(rows, P.PIECES).repartition(4)
    got = P.pack(found, shard_pieces=2).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(rows, key=repr)
    full, short = [r for r in got if r.length == 1024], [r for r in got if r.length < 1024]
    assert all(r.shard < 0 and r.offset == 0 for r in full) and all(r.shard >= 0 for r in short)
    assert len({(r.shard << 32) + r.sequence for r in full}) == 60


def test_best_fit_takes_the_tightest():
    number, offset = P.best_fit(np.array([700, 600, 400, 300, 20]), np.array([1024.0, 1024.0, 1e9]), np.array([1.0, 0, 0]))
    assert number.tolist() == [0, 1, 1, 0, 0] or number.tolist()[:4] == [0, 1, 1, 0]
    assert offset.tolist()[:4] == [0, 0, 600, 700]
