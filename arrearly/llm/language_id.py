"""Language ID by cross-parsing entropy.

For each language a suffix automaton is built of a bounded sample of its
labelled texts. A text is parsed greedily against each automaton into
longest matches (phrases); the language whose sample needs the fewest
phrases, normalised by the logarithm of the sample's length, wins.

The sample is ``SAMPLE_ROWS`` labelled rows per language (dealt by a hash of
doc_id, texts of at most ``PLAIN_CHARS`` characters first) and
``SAMPLE_CHARS`` normalised characters of them, without runs of ``SHARED`` words
that two of its rows have (boilerplate and passages that documents of every
language quote). Any number of label values is learned; the driver holds their
sample rows. An automaton is a dense table over its own language's letters, or sorted
edges where that has over ``DENSE_CELLS`` cells (scripts of many letters).
Over ``GROUP_LANGUAGES`` languages are parsed against in groups, each a pass of its own
over the texts, and a text's phrase counts are joined before the winner is
chosen, so a Python worker holds the automata of one group. Only the sample texts travel; every Python
worker builds the automata once. Texts are parsed whole, in segments of
``SEGMENT`` characters that all advance together, so that each step is a few
array operations; a phrase ends where its segment ends.

Normalisation: lower case, every run of non-letters becomes one space.
Defined results: ``und`` with score 0 for a null text, a text without any
letter, or when no language was learned; ties go to the smaller language
name; rows are independent, so repeated rows repeat. Only ``doc_id``,
``text`` and (to learn) ``lang`` are read.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
from collections.abc import Collection

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, arrow_map, crc_mod, map_rows, text_batches

SAMPLE_ROWS = 64
SAMPLE_CHARS = 24_000
PLAIN_CHARS = 4_000
SHARED = 6
MAX_LANGUAGES = 64
GROUP_LANGUAGES = 32
DENSE_CELLS = 1 << 21
SEGMENT = 1024
UNKNOWN = "und"
COUNTS = "__lang_phrases"  # a helper column of ``keep_known``
PREDICTED = "doc_id long, lang_pred string, score double"


def normal(text: str) -> str:
    return re.sub(r"[\W\d_]+", " ", text.lower()).strip()


def has_letter(text: str | None) -> bool:
    return bool(text) and any(m.group().isalpha() for m in re.finditer(r"[^\W\d_]", text))


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the suffix automaton: state 0 is the root, and a string
    is a substring of ``text`` if and only if it can be followed from there."""
    nxt: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


class Edges:
    """An automaton as sorted edges. As in the dense tables, a step gives
    twice the next state plus one if a new phrase begins there."""

    def __init__(self, states: list[dict[str, int]], own: dict[str, int]):
        self.width = len(own) + 1
        edges = sorted((s * self.width + own[c], to) for s, step in enumerate(states) for c, to in step.items() if s)
        self.key = np.array([k for k, _ in edges] + [np.iinfo(np.int64).max], np.int64)
        self.to = np.array([to for _, to in edges] + [0], np.int64) * 2
        self.root = np.ones(self.width, np.int64)
        for c, to in states[0].items():
            self.root[own[c]] = to * 2 + 1

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        key = state * self.width + code
        at = np.searchsorted(self.key, key)
        return np.where(self.key[at] == key, self.to[at], self.root[code])


class Model:
    """The automata of all languages: small ones as one dense table of steps (a
    step from a state by a letter gives twice the next state's row, plus one if
    a new phrase begins there), others as ``Edges``. Each has codes of its own letters."""

    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        self.bits = np.array([math.log2(len(samples[x]) + 2) for x in self.langs])
        letters = sorted({c for s in samples.values() for c in s})
        self.code = np.zeros(0x110000, np.uint8 if len(letters) < 250 else np.uint16 if len(letters) < 65_000 else np.uint32)
        for i, c in enumerate(letters):
            self.code[ord(c)] = i + 1
        # own[l, code]: the letter's code in language l; 0: a letter its sample has not
        self.own = np.zeros((len(self.langs), len(letters) + 1), np.int32)
        tables, base = [], 0
        self.dense, self.roots, self.edges = [], [], {}
        for k, lang in enumerate(self.langs):
            own = {c: i + 1 for i, c in enumerate(sorted(set(samples[lang])))}
            for c, i in own.items():
                self.own[k, self.code[ord(c)]] = i
            states, width = suffix_automaton(samples[lang]), len(own) + 1
            if len(states) * width > DENSE_CELLS:
                self.edges[k] = Edges(states, own)
                continue
            root = np.full(width, base * 2 + 1, np.int64)
            for c, to in states[0].items():
                root[own[c]] = (base + to * width) * 2 + 1
            steps = np.tile(root, (len(states), 1))
            at = [(s, own[c], to) for s, edges in enumerate(states) for c, to in edges.items() if s]
            if at:
                s, c, to = np.array(at, np.int64).T
                steps[s, c] = (base + to * width) * 2
            # Doubled rows of at most GROUP_LANGUAGES tables stay below 2**31.
            tables.append(steps.ravel().astype(np.int32) if steps.max() < 1 << 31 else steps.ravel())
            self.dense.append(k)
            self.roots.append(base)
            base += steps.size
        self.steps = np.concatenate(tables) if tables else np.zeros(0, np.int32)

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases of each normalised text (rows) for each language (columns)."""
        out = np.zeros((len(texts), len(self.langs)))
        codes = [self.code[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)] for t in texts]
        lanes = [(k, c[i: i + SEGMENT]) for k, c in enumerate(codes) for i in range(0, len(c), SEGMENT)]
        if not lanes:
            return out
        lanes.sort(key=lambda x: -len(x[1]))
        sizes = np.array([len(c) for _, c in lanes])
        grid = np.zeros((sizes[0], len(lanes)), codes[0].dtype)
        for j, (_, c) in enumerate(lanes):
            grid[: len(c), j] = c
        active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")  # lanes longer than t
        # A lane begins at its root, where every step begins a phrase.
        found = np.zeros((len(self.langs), len(lanes)), np.int32)
        if self.dense:
            own, got = self.own[self.dense], np.zeros((len(self.dense), len(lanes)), np.int32)
            at = np.repeat(np.array(self.roots, self.steps.dtype), len(lanes)).reshape(len(self.dense), -1)
            for t in range(sizes[0]):
                n = active[t]
                step = self.steps.take(at[:, :n] + own.take(grid[t, :n], axis=1))
                got[:, :n] += step & 1
                at[:, :n] = step >> 1
            found[self.dense] = got
        for k, edges in self.edges.items():
            state = np.zeros(len(lanes), np.int64)
            for t in range(sizes[0]):
                n = active[t]
                step = edges.step(state[:n], self.own[k].take(grid[t, :n]))
                found[k, :n] += step & 1
                state[:n] = step >> 1
        np.add.at(out, [k for k, _ in lanes], found.T)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        keep = [i for i, t in enumerate(texts) if self.langs and has_letter(t)]
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if keep:
            best, score = decide(self.phrases([normal(texts[i]) for i in keep]) * self.bits)
            for k, i in enumerate(keep):
                langs[i], scores[i] = self.langs[best[k]], float(score[k])
        return langs, scores


def decide(cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cheapest language of each row, and its score."""
    best = cost.argmin(axis=1)
    # Evidence for the best against each other language: saved bits per bit.
    share = np.exp(-8 * (cost / np.maximum(cost.min(axis=1, keepdims=True), 1e-9) - 1))
    return best, share[np.arange(len(cost)), best] / share.sum(axis=1)


def learn(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS, most: int | None = MAX_LANGUAGES) -> dict[str, str]:
    """Sample text per language of rows (doc_id, text, lang); bounded by
    sample_rows rows for each language. Over ``most`` languages are an error;
    None, as the query has it, is any number."""
    order = Window.partitionBy("lang").orderBy(F.length("text") > PLAIN_CHARS, F.xxhash64("doc_id"), F.xxhash64("text"))
    rows = (labelled.where("lang is not null and length(text) > 0").select("doc_id", "text", "lang")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample_rows)
            .select("lang", "rank", F.substring("text", 1, sample_chars).alias("text")))  # no more is used of a row
    rows = (rows if most is None else rows.limit(most * sample_rows + 1)).collect()
    if most is not None and len({r["lang"] for r in rows}) > most:
        raise ValueError(f"over {most} values of lang")
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["rank"])):
        clean, own = normal(r["text"]), out.setdefault(r["lang"], [])
        if clean and clean not in own:
            own.append(clean)
    samples = {}
    for lang, own in unshared(out).items():
        if sum(map(len, own)) < sample_chars // 8:  # little but shared text: better that than none
            own = out[lang]
        if own:
            samples[lang] = "  ".join(own)[:sample_chars]
    return samples


def unshared(texts: dict[str, list[str]], n: int = SHARED) -> dict[str, list[str]]:
    """The texts without runs of n words that another text, of any language,
    has too; a text falls into the pieces between them."""
    places = [(lang, t) for lang, own in texts.items() for t in own]
    w = Words([t for _, t in places])
    at, h = w.windows(n)
    place = np.searchsorted(w.bounds, at, side="right") - 1
    order = np.lexsort((place, h))
    h, place = h[order], place[order]
    edge = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1], [True]))) if len(h) else np.zeros(1, np.int64)
    several = place[edge[:-1]] != place[edge[1:] - 1]
    runs = at[order[np.repeat(several, np.diff(edge))]]
    marks = np.zeros(len(w.starts) + 1, np.int64)
    np.add.at(marks, runs, 1)
    np.add.at(marks, runs + n, -1)
    shared = np.cumsum(marks) > 0
    out: dict[str, list[str]] = {lang: [] for lang in texts}
    for k, (lang, t) in enumerate(places):
        drops = shared[w.bounds[k]: w.bounds[k + 1]].tolist()
        out[lang] += [" ".join(x for x, _ in own) for drop, own in itertools.groupby(zip(t.split(), drops, strict=True), key=lambda x: x[1]) if not drop]
    return out


_models: dict[tuple, Model] = {}


def model_of(samples: dict[str, str]) -> Model:
    """The model of these samples, built once in each Python worker."""
    key = tuple(sorted(samples.items()))
    if key not in _models:
        _models.clear()
        _models[key] = Model(samples)
    return _models[key]


def language_groups(samples: dict[str, str]) -> list[dict[str, str]]:
    """The samples in groups of at most GROUP_LANGUAGES, by name."""
    names = sorted(samples)
    return [{x: samples[x] for x in names[i: i + GROUP_LANGUAGES]} for i in range(0, len(names), GROUP_LANGUAGES)]


def predict(docs: DataFrame, samples: dict[str, str]) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    groups = language_groups(samples)
    if len(groups) > 1:
        return _predict_by_groups(docs, groups)

    def run(batch):
        langs, scores = model_of(samples).predict(batch.column("text").to_pylist())
        return {"doc_id": batch.column("doc_id").to_pylist(), "lang_pred": langs, "score": scores}

    return arrow_map(docs.select("doc_id", "text"), run, PREDICTED)


def _predict_by_groups(docs: DataFrame, groups: list[dict[str, str]]) -> DataFrame:
    """``predict`` with a pass for each group. Rows of the same doc_id and
    text (by a 64-bit hash) have the same counts and are repeated at the end."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))

    def counts(samples, part, batch):
        texts = batch.column("text").to_pylist()
        keep = [i for i, t in enumerate(texts) if has_letter(t)]
        found: list = [None] * len(texts)
        for i, x in zip(keep, model_of(samples).phrases([normal(texts[i]) for i in keep]).astype(np.int32).tolist() if keep else ()):
            found[i] = x
        return {"doc_id": batch.column("doc_id").to_pylist(), "text_hash": batch.column("text_hash").to_pylist(), "part": [part] * len(texts), "phrases": found}

    passes = [arrow_map(rows, functools.partial(counts, g, i), "doc_id long, text_hash long, part int, phrases array<int>") for i, g in enumerate(groups)]
    once = (functools.reduce(DataFrame.unionByName, passes).groupBy("doc_id", "text_hash", "part").agg(F.count("*").alias("copies"), F.first("phrases").alias("phrases"))
            .groupBy("doc_id", "text_hash").agg(F.first("copies").alias("copies"), F.sort_array(F.collect_list(F.struct("part", "phrases"))).alias("parts"))
            .select("doc_id", F.when(F.col("parts")[0]["phrases"].isNotNull(), F.flatten("parts.phrases")).alias("phrases"), "copies"))
    names = [x for g in groups for x in g]
    bits = np.array([math.log2(len(g[x]) + 2) for g in groups for x in g])

    def choose(batch):
        found = batch.column("phrases").to_pylist()
        langs, scores = [UNKNOWN] * len(found), [0.0] * len(found)
        keep = [i for i, x in enumerate(found) if x is not None]
        if keep:
            best, score = decide(np.array([found[i] for i in keep], np.float64) * bits)
            for k, i in enumerate(keep):
                langs[i], scores[i] = names[best[k]], float(score[k])
        return {"doc_id": batch.column("doc_id").to_pylist(), "lang_pred": langs, "score": scores, "copies": batch.column("copies").to_pylist()}

    chosen = arrow_map(once, choose, PREDICTED + ", copies long")
    return chosen.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("doc_id", "lang_pred", "score")


def keep_known(docs: DataFrame, samples: dict[str, str], keep: Collection[str] | None = None, least: float = 0.0) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text has a language: the predicted
    one, among ``keep`` (None: any learned) and with a score of ``least`` or more. A
    null ``lang`` becomes the prediction; a given one stays. If no language was
    learned, texts with a letter stay as they are.

    Each group of languages appends its phrase counts to the row in a pass of its
    own; the last one decides, so rows stay where they are."""
    groups = language_groups(samples)
    fills = "lang" in docs.columns and docs.schema["lang"].dataType == T.StringType()

    def decided(part: pa.RecordBatch, langs, scores) -> pa.RecordBatch:
        good = [x != UNKNOWN and (keep is None or x in keep) and s >= least for x, s in zip(langs, scores)]
        if fills and samples:
            given = part.column("lang").to_pylist()
            own = pa.array([x if x is not None else y for x, y in zip(given, langs)], pa.string())
            part = part.set_column(part.schema.get_field_index("lang"), "lang", own)
        return part.filter(pa.array(good, pa.bool_()))

    def one(batches):
        for b in batches:
            for lo, hi in text_batches(b.column("text")):
                part = b.slice(lo, hi - lo)
                texts = part.column("text").to_pylist()
                if groups:
                    langs, scores = model_of(groups[0]).predict(texts)
                else:
                    langs, scores = ["" if has_letter(t) else UNKNOWN for t in texts], [1.0] * len(texts)
                yield decided(part, langs, scores)

    if len(groups) <= 1:
        if not groups:
            keep, least = None, 0.0
        return map_rows(docs, one)

    def counted(group, batches):
        for b in batches:
            for lo, hi in text_batches(b.column("text")):
                part = b.slice(lo, hi - lo)
                texts = part.column("text").to_pylist()
                before = part.column(COUNTS).to_pylist()
                own = [i for i, t in enumerate(texts) if has_letter(t)]
                found = model_of(group).phrases([normal(texts[i]) for i in own]).astype(np.int32).tolist() if own else ()
                for i, x in zip(own, found):
                    before[i] = before[i] + x
                yield part.set_column(part.schema.get_field_index(COUNTS), COUNTS, pa.array(before, pa.list_(pa.int32())))

    names = [x for g in groups for x in g]
    bits = np.array([math.log2(len(g[x]) + 2) for g in groups for x in g])

    def chosen(batches):
        for b in batches:
            found = b.column(COUNTS).to_pylist()
            langs, scores = [UNKNOWN] * len(found), [0.0] * len(found)
            own = [i for i, x in enumerate(found) if x]
            if own:
                best, score = decide(np.array([found[i] for i in own], np.float64) * bits)
                for k, i in enumerate(own):
                    langs[i], scores[i] = names[best[k]], float(score[k])
            part = b.drop_columns([COUNTS])
            yield decided(part, langs, scores)

    out = docs.withColumn(COUNTS, F.array().cast("array<int>"))
    for g in groups:
        out = map_rows(out, functools.partial(counted, g))
    return map_rows(out, chosen, docs.schema)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where((crc_mod(F.col("doc_id"), 5) != 0) & F.col("lang").isNotNull())


def contract(docs: DataFrame) -> DataFrame:
    held = F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    out = predict(docs, learn(training_rows(docs), most=None))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
