from __future__ import annotations

import pytest

from arrearly.llm import language_id as L


def phrases(text, sample):
    """Greedy longest matches, by plain search."""
    n, i = 0, 0
    while i < len(text):
        j = i + 1
        while j <= len(text) and text[i:j] in sample:
            j += 1
        i = max(i + 1, j - 1)
        n += 1
    return n


def test_phrases_are_longest_matches():
    samples = {"x": "the cat sat on the mat and the hat", "y": "le chat est sur la table et le chien", "z": "aaaa"}
    m = L.Model(samples)
    texts = ["the cat and the table", "le chat on the mat", "", "qqq", "a", "aaaaaaaaaaa", "the hat" * 30]
    got = m.phrases(texts)
    assert got.tolist() == [[phrases(t, samples[lang]) for lang in m.langs] for t in texts]


def test_segments_only_add_phrases_at_their_ends():
    m = L.Model({"x": "ab" * 3000})
    assert m.phrases(["ab" * 2000]).tolist() == [[-(-4000 // L.SEGMENT)]]


def test_suffix_automaton_has_exactly_the_substrings():
    text = "abracadabra cab"
    nxt = L.suffix_automaton(text)

    def has(s):
        state = 0
        for c in s:
            if c not in nxt[state]:
                return False
            state = nxt[state][c]
        return True

    assert all(has(text[i:j]) for i in range(len(text)) for j in range(i, len(text) + 1))
    assert not any(has(s) for s in ("abd", "cabr", "aa", "z", "rac "))


def test_held_out_accuracy(small):
    docs = small("documents")
    got = L.contract(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and held
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_edges(docs_of, small):
    samples = L.learn(L.training_rows(small("documents")))
    assert set(samples) == {"de", "en", "es", "fr"} and all(len(s) <= L.SAMPLE_CHARS for s in samples.values())
    docs = docs_of([(1, None), (2, ""), (3, "123 -- _ !?"), (4, "½²"), (5, "文字"), (6, "x"), (6, "x"), (None, "the and with"), (8, "die und der " * 60000)])
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(docs, samples).collect()}
    assert [got[i][0] for i in (1, 2, 3, 4)] == ["und"] * 4 and got[1][1] == 0
    assert got[5][0] in samples and got[6][0] in samples and got[None][0] == "en" and got[8][0] == "de"
    assert L.predict(docs, samples).count() == 9 and L.predict(docs.limit(0), samples).count() == 0
    kept = L.keep_known(docs, samples)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["5", "6", "6", "8", "None"]
    untaught = docs_of([(1, "text", None), (5, "text", None)])
    assert {(r.lang_pred, r.score) for r in L.contract(untaught).collect()} == {("und", 0.0)}


def test_too_many_languages(docs_of):
    with pytest.raises(ValueError):
        L.learn(docs_of([(i, f"text {i}", f"l{i}") for i in range(L.MAX_LANGUAGES + 1)]))


def test_shared_passages_are_not_learned(docs_of):
    passage = "one long passage that documents of every language quote here"
    got = L.unshared({"x": [f"ab cd {passage} ef", "gh ij"], "y": [f"{passage} kl mn"], "z": ["solo text"]})
    assert got == {"x": ["ab cd", "ef", "gh ij"], "y": ["kl mn"], "z": ["solo text"]}
    # a language with nothing but a shared text is still learned
    samples = L.learn(docs_of([(1, passage, "x"), (2, passage, "y"), (3, passage, "y")]))
    assert samples == {"x": passage, "y": passage}


def test_edges_count_as_the_dense_table(monkeypatch):
    samples = {"x": "the cat sat on the mat and the hat", "y": "le chat est sur la table", "z": "文字 的 文 字 的 of"}
    texts = ["the cat and 文字 le chat", "的 文字 的", "qqq", "", "the hat" * 400]
    want = [[phrases(t, samples[lang]) for lang in "xyz"] for t in texts[:4]]
    dense = L.Model(samples)
    monkeypatch.setattr(L, "DENSE_CELLS", 300)
    mixed = L.Model(samples)
    monkeypatch.setattr(L, "DENSE_CELLS", 0)
    sparse = L.Model(samples)
    assert not dense.edges and 0 < len(mixed.edges) < 3 and len(sparse.edges) == 3
    got = dense.phrases(texts).tolist()
    assert got[:4] == want and mixed.phrases(texts).tolist() == got and sparse.phrases(texts).tolist() == got


def test_any_number_of_languages(docs_of, words):
    n = L.MAX_LANGUAGES + 6
    texts = {f"l{i:02d}": " ".join(f"{w}{chr(0x4E00 + i)}{chr(0x5E00 + i)}" for w in words(i, 30).split()) for i in range(n)}
    rows = [(i, t, lang) for i, (lang, t) in enumerate(texts.items())] + [(3, texts["l03"], "l03")] * 2 + [(None, "12", None), (999, None, None)]
    docs = docs_of(rows)
    samples = L.learn(docs, most=None)
    assert len(samples) == n and len(L.language_groups(samples)) > 2
    whole = L.Model(samples).predict([t for _, t, _ in rows])
    got = sorted(((r.doc_id, r.lang_pred, round(r.score, 9)) for r in L.predict(docs, samples).collect()), key=repr)
    assert got == sorted(((r[0], lang, round(x, 9)) for r, lang, x in zip(rows, *whole)), key=repr)
    assert {r[2] for r in rows if r[2]} == {x[1] for x in got} - {"und"}
    assert L.contract(docs).count() == len(rows) and L.keep_known(docs, samples).count() == len(rows) - 2
    asked = docs_of([(i, t, None) for i, (_, t) in enumerate(sorted(texts.items()))] + [(500, texts["l07"], "own"), (501, "7 8", None)])
    want = {r.doc_id: r.lang_pred for r in L.predict(asked, samples).collect()} | {500: "own"}
    kept = {r.doc_id: r.lang for r in L.keep_known(asked, samples).collect()}
    assert kept == {i: x for i, x in want.items() if x != "und"} and len(kept) == n + 1
    some = {r.doc_id for r in L.keep_known(asked, samples, keep=["l07"]).collect()}
    assert some == {7, 500}
    assert L.keep_known(asked, samples, least=1.1).count() == 0


def test_kept_languages_and_least_score(docs_of):
    samples = {"en": "the cat sat on the mat and the hat was on the cat", "fr": "le chat est sur la table et la souris"}
    docs = docs_of([(1, "the cat and the hat", None), (2, "le chat et la souris", None), (3, "le chat", "en"), (4, "1", None)])
    assert {r.doc_id: r.lang for r in L.keep_known(docs, samples).collect()} == {1: "en", 2: "fr", 3: "en"}
    assert {r.doc_id for r in L.keep_known(docs, samples, keep={"fr"}).collect()} == {2, 3}
    assert L.keep_known(docs, samples, least=1.1).count() == 0
    # Without a column lang, or with another type of it, nothing is written.
    assert L.keep_known(docs.drop("lang"), samples).columns == [c for c in docs.columns if c != "lang"]


def test_no_language_learned_keeps_texts_with_letters(docs_of):
    docs = docs_of([(1, "clean text", None), (2, None, None), (3, "12 ?", None), (None, "文", None), (5, "", None)])
    samples = L.learn(L.training_rows(docs))
    assert samples == {}
    assert {(r.doc_id, r.text) for r in L.keep_known(docs, samples).collect()} == {(1, "clean text"), (None, "文")}
