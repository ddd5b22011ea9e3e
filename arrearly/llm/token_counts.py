"""Token counts per section of a document, attributed by offsets.

A document is encoded once, whole; every token has a character span, and an
interval join (two binary searches over the sorted section starts) gives the
sections it touches. A token that crosses a boundary is allocated by a rule:

* ``start``: all of it to the section of its first character;
* ``majority``: to the section that holds most of its characters, the earlier
  one on a tie;
* ``split``: to each section in proportion to the characters it holds.

So the counts of a document's sections always sum to its tokens. Sections are
half-open character ranges that cover the text; ``lines`` gives every line
with its line end. ``fields`` renders several columns as one document, each
ended by a newline, with one section per column.

Defined results: a null or empty text has one empty section with no tokens
(with ``fields``: one per column); empty sections count 0; repeated rows
repeat. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import arrow_map

RULES = ("start", "majority", "split")
COUNTS = "doc_id long, section int, start long, end long, n_tokens double"


def lines(text: str) -> np.ndarray:
    """Section starts: every line with its newline; a text that ends in a
    newline has no empty last line."""
    at = [0]
    while (n := text.find("\n", at[-1])) >= 0 and n + 1 < len(text):
        at.append(n + 1)
    return np.array(at, np.int64)


def allocate(first: np.ndarray, after: np.ndarray, starts: np.ndarray, size: int, rule: str = "start") -> np.ndarray:
    """Tokens per section from token spans [first, after) and the ascending
    section starts, which cover [0, size)."""
    if rule not in RULES:
        raise ValueError(f"rule: {rule!r}")
    n = len(starts)
    # Of sections with the same start only the last has characters.
    a = np.searchsorted(starts, first, side="right") - 1
    if rule == "start":
        return np.bincount(a, minlength=n).astype(np.float64)
    b = np.searchsorted(starts, np.maximum(after - 1, first), side="right") - 1
    out = np.bincount(a[a == b], minlength=n).astype(np.float64)
    ends = np.append(starts[1:], size)
    for i in np.flatnonzero(a != b).tolist():
        own = np.arange(a[i], b[i] + 1)
        held = np.minimum(after[i], ends[own]) - np.maximum(first[i], starts[own])
        if rule == "majority":
            out[own[held.argmax()]] += 1
        else:
            out[own] += held / held.sum()
    return out


def _counted(ids: list, texts: list[str], starts: list[np.ndarray], rule: str, vocabulary: str) -> dict:
    out = {c: [] for c in ("doc_id", "section", "start", "end", "n_tokens")}
    for doc, text, at in zip(ids, texts, starts):
        found = allocate(*tokens.char_spans(text, tokens.encode(text, vocabulary), vocabulary), at, len(text), rule)
        out["doc_id"] += [doc] * len(at)
        out["section"] += range(len(at))
        out["start"] += at.tolist()
        out["end"] += [*at[1:].tolist(), len(text)]
        out["n_tokens"] += found.tolist()
    return out


def section_counts(docs: DataFrame, sections: Callable[[str], np.ndarray] = lines, rule: str = "start",
                   vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """One row per document and section of ``text`` (columns of ``COUNTS``)."""
    if rule not in RULES:
        raise ValueError(f"rule: {rule!r}")

    def run(batch):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        return _counted(batch.column("doc_id").to_pylist(), texts, [sections(t) for t in texts], rule, vocabulary)

    return arrow_map(docs.select("doc_id", "text"), run, COUNTS)


def field_counts(rows: DataFrame, fields: list[str], key: str = "doc_id", rule: str = "start",
                 vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """One row per row of ``rows`` and field: the fields, each ended by a
    newline, are encoded as one document. Section i is fields[i]."""
    if rule not in RULES:
        raise ValueError(f"rule: {rule!r}")
    parts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    made = rows.select(F.col(key).alias("doc_id"), F.concat(*[F.concat(p, F.lit("\n")) for p in parts]).alias("text"),
                       F.array(*[F.length(p) + 1 for p in parts]).alias("sizes"))

    def run(batch):
        starts = [np.concatenate(([0], np.cumsum(s[:-1], dtype=np.int64))) for s in batch.column("sizes").to_pylist()]
        return _counted(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), starts, rule, vocabulary)

    return arrow_map(made, run, COUNTS)
