from __future__ import annotations

import hashlib

import pytest

from arrearly.llm import chat as C

HARD = [("user", r"\### Assistant: </turn> ok"), ("assistant", r"\### Assistant: </turn> ok"), ("assistant", ""), ("a:b\n### c", "x\\"), ("", "\\\\n #< \n</turn>\n### user: hi"),
        ("assistant", "é𝄞 </turn>\n"), ("user", "</turn>\n### assistant: no"), ("assistant", "<"), ("assistant", "\\")]


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def expected(conv, turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return (conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(C.sections(turns)))


def test_round_trip_and_spans():
    whole, rewritten, spans = C.locate(C.sections, HARD)
    assert C.parse(whole) == HARD and not rewritten
    assert [C.unescape(whole[a:b]) for _, _, a, b in spans] == [t for _, t in HARD]
    assert spans[0][0] == 0 and all(x[1] == y[0] for x, y in zip(spans, spans[1:])) and spans[-1][1] == len(whole)
    with pytest.raises(ValueError):
        C.parse(whole + "tail")


def test_long_conversation_is_the_same():
    turns = [(("user", "assistant")[i % 2], f"text {i} " * (i % 7)) for i in range(400)]
    assert C.locate(C.sections, turns)[0] == C.sections(turns)
    short = C._steps(C.sections, turns, None)
    assert C._steps(C.sections, turns, C.CONTEXT) == short
    assert C.parse(C.sections(turns)) == turns


def test_templates_that_rewrite_history():
    def last_thought(turns):  # keeps the thoughts of the last answer only
        said = [t if i == len(turns) - 1 else t.split("|")[-1] for i, (_, t) in enumerate(turns)]
        return "<s>" + "".join(f"[{r}] {t}\n" for (r, _), t in zip(turns, said))

    turns = [("user", "hi"), ("assistant", "hm|hello"), ("user", "more"), ("assistant", "so|fine")]
    whole, rewritten, spans = C.locate(last_thought, turns)
    assert rewritten and whole == last_thought(turns)
    assert spans[1] is None and whole[slice(*spans[0][2:])] == "hi"
    plain = lambda t: "<s>" + "".join(f"[{r}] {x}\n" for r, x in t)
    whole, rewritten, spans = C.locate(plain, turns)
    assert not rewritten and [whole[a:b] for _, _, a, b in spans] == [t for _, t in turns]
    counted = lambda t: f"{len(t)} turns: " + "".join(x for _, x in t)
    assert C.locate(counted, [("user", "x")] * 300)[1]


@pytest.mark.parametrize("n", [128, 129, 200])
def test_rewriting_in_prefixes_alone(n):
    def short_for_tools(turns):  # shows the last 10 turns only while the last one is a tool's
        return "".join(f"[{r}] {t}\n" for r, t in (turns[-10:] if turns and turns[-1][0] == "tool" else turns))

    turns = [(("user", "tool", "assistant")[i % 3], f"text {i}") for i in range(n - 1)] + [("assistant", "end")]
    assert C.locate(short_for_tools, turns)[1]


def test_query(spark, small):
    conv = small("conversations")
    chats = {}
    for r in sorted(conv.collect(), key=lambda r: r.turn):
        chats.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    want = [expected(k, v) for k, v in chats.items()] + [expected(-7, [("user", HARD[0][1]), ("assistant", HARD[0][1])])]
    assert sorted(tuple(r) for r in C.contract(conv).collect()) == sorted(want)


def test_edges(spark, docs_of):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 2, None, "c"), (2, None, "assistant", "x"), (2, 0, "assistant", "y"), (None, 0, "assistant", "z"),
            (3, 5, "assistant", "tie"), (3, 5, "assistant", "tie"), (3, 5, "user", "a"), (4, 0, "assistant", "long " * 200000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'z' AS formatted", "1 AS n_turns")
    got = {r[0]: tuple(r) for r in C.contract(df).collect()}
    assert got[1] == expected(1, [("user", ""), ("assistant", "b"), ("", "c")])
    assert got[2] == expected(2, [("assistant", "x"), ("assistant", "y")])
    assert got[3] == expected(3, [("assistant", "tie"), ("assistant", "tie"), ("user", "a")])
    assert got[None][1:] == expected(None, [("assistant", "z")])[1:] and got[4] == expected(4, [("assistant", "long " * 200000)])
    assert {r[0] for r in C.contract(df.limit(0)).collect()} == {-7}
