"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to one string.
It is rendered for successive prefixes of a conversation; where the new
output continues the old one, what was added is the new turn's span. Where it
does not, the template has rewritten history: the conversation is marked,
and turns whose span no longer holds in the last output get no span. The text
inside a turn's span is found by rendering the same prefix with that turn's
text empty: what both have in common at either end is the turn's frame.

A template may declare, by an attribute ``looks_back``, that what a turn adds depends
on at most so many turns before it. If those are at most ``CONTEXT``, a
conversation of over ``WHOLE_PREFIXES`` turns is rendered in prefixes of its
last ``CONTEXT`` turns, so that its cost grows with its length and not with
the square; the spans are then proved against one rendering of the whole
conversation, and the full prefixes are rendered if they do not hold. For any
other template all full prefixes are rendered at every length.

``sections`` marks turns as ``### role: text</turn>`` and puts a backslash
before every ``\\``, ``#`` and ``<`` of a text (in a role also ``:``, and a
newline is written ``\\n``), so no text can hold a control string and ``parse``
reads everything back.

Defined results: null roles and texts are empty; turns are taken in the order
(turn, role, text), repeated rows are turns of their own; rows with a null
conv_id are one conversation; an empty table gives no rows. Only conv_id,
turn, role and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

WHOLE_PREFIXES = 128
CONTEXT = 8
LEARNED_ROLE = "assistant"
Turns = list[tuple[str, str]]
FORMATTED = ("conv_id long, formatted string, rewrites_history boolean, "
             "spans array<struct<role:string,start:int,end:int,text_start:int,text_end:int>>")
_TURN = re.compile(r"### ([^\\:]*(?:\\.[^\\:]*)*): ([^\\<]*(?:\\.[^\\<]*)*)</turn>\n", re.S)


def escape(text: str) -> str:
    return re.sub(r"([\\#<])", r"\\\1", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def _role(role: str) -> str:
    return re.sub(r"([\\#<:])", r"\\\1", role).replace("\n", "\\n")


def sections(turns: Turns) -> str:
    return "".join(f"### {_role(r)}: {escape(t)}</turn>\n" for r, t in turns)


sections.looks_back = 0


def parse(formatted: str) -> Turns:
    """The turns of an output of ``sections``; an error if it is none."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((re.sub(r"\\(.)", lambda x: "\n" if x[1] == "n" else x[1], m[1], flags=re.S), unescape(m[2])))
        at = m.end()
    return out


def common_prefix(a: str, b: str) -> int:
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid - 1)
    return lo


def _steps(render: Callable[[Turns], str], turns: Turns, context: int | None) -> tuple[list[tuple[str, int, int]], bool]:
    """What each turn added, and its text's place in that; whether every
    output continued the one before."""
    out, stable = [], True
    for i in range(len(turns)):
        lo = 0 if context is None else max(0, i - context)
        before, after = render(turns[lo:i]), render(turns[lo: i + 1])
        if not after.startswith(before):
            stable = False
        cut = common_prefix(before, after)
        own = after[cut:]
        bare = render([*turns[lo:i], (turns[i][0], "")])
        head = max(0, min(common_prefix(after, bare), len(after)) - cut)
        tail = max(0, len(bare) - cut - head)
        out.append((own, head, max(head, len(own) - tail)))
    return out, stable


def locate(render: Callable[[Turns], str], turns: Turns) -> tuple[str, bool, list[tuple[int, int, int, int] | None]]:
    """Output, whether history was rewritten, and per turn (start, end, start of
    its text, end of its text) in the output."""
    whole = render(turns)
    if len(turns) > WHOLE_PREFIXES and getattr(render, "looks_back", CONTEXT + 1) <= CONTEXT:
        steps, stable = _steps(render, turns, CONTEXT)
        if not (stable and "".join([render([]), *[s for s, _, _ in steps]]) == whole):
            steps, stable = _steps(render, turns, None)
    else:
        steps, stable = _steps(render, turns, None)
    spans, at = [], len(render([]))
    for own, a, b in steps:
        ok = whole.startswith(own, at)
        spans.append((at, at + len(own), at + a, at + b) if stable or ok else None)
        at += len(own)
    return whole, not stable, spans


def format_chats(rows: DataFrame, render: Callable[[Turns], str] = sections) -> DataFrame:
    """One row per conversation: output, spans in characters (columns of
    ``FORMATTED``). A turn without a span has nulls."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def run(batch):
        out = {"conv_id": batch.column("conv_id").to_pylist(), "formatted": [], "rewrites_history": [], "spans": []}
        for raw in batch.column("turns").to_pylist():
            turns = [(t["role"], t["text"]) for t in raw]
            whole, rewritten, spans = locate(render, turns)
            out["formatted"].append(whole)
            out["rewrites_history"].append(rewritten)
            out["spans"].append([dict(zip(("role", "start", "end", "text_start", "text_end"), (r, *(s or [None] * 4))))
                                 for (r, _), s in zip(turns, spans)])
        return out

    return arrow_map(chats, run, FORMATTED)


def contract(conversations: DataFrame) -> DataFrame:
    spark = conversations.sparkSession
    said = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, LEARNED_ROLE, said)], "conv_id long, turn long, role string, text string")
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(more)

    def run(batch):
        names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        out = {"conv_id": batch.column("conv_id").to_pylist()} | {n: [] for n in names}
        for formatted, spans in zip(batch.column("formatted").to_pylist(), batch.column("spans").to_pylist()):
            turns = parse(formatted)
            loss = "".join(unescape(formatted[s["text_start"]: s["text_end"]]) for s in spans if s["role"] == LEARNED_ROLE)
            everything = "".join(f"{r}\n{t}\n" for r, t in turns)
            for n, v in zip(names, (len(turns), _sha(everything), len(loss), _sha(loss), len(formatted))):
                out[n].append(v)
        return out

    return arrow_map(format_chats(rows), run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def _escaped_length(c: str, marks: str) -> str:
    return f"length({c}) + " + " + ".join(f"length({c}) - length(replace({c}, {m}, ''))" for m in marks.split())


SQL = f"""
WITH c AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, n, r, chr(92) || '### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, '{LEARNED_ROLE}')) v(n, r)),
l AS (SELECT *, 4 + {_escaped_length('role', 'chr(92) chr(35) chr(60) chr(58) chr(10)')} + 2
    + {_escaped_length('text', 'chr(92) chr(35) chr(60)')} + 8 AS size FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = '{LEARNED_ROLE}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = '{LEARNED_ROLE}'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM l GROUP BY conv_id
"""
