"""n-gram Jaccard join: a MinHash LSH forest finds candidates, exact set
comparison decides.

A document is the set of its word 5-grams (64-bit hashes of lower-cased words; a
text of fewer words, but not none, is one n-gram). Documents with
equal sets are one node, found by a set hash. A node gets ``TREES`` labels of
``DEPTH`` MinHash values each. For every tree all labels are sorted (range
partitions over the whole label): a prefix trie, in which nodes that share a
prefix stand together. Matching begins with whole labels: each node is matched
with the node before it, its longest common prefix, and with the smallest node of its
trie branch. Matches whose signatures agree far less than the threshold asks
(by ``SLACK``, 3.9 standard deviations) are dropped, and the rest connect nodes into
groups. From then on only nodes of different groups are matched: first the
other trees follow (the first step takes ``FIRST_TREES``), then the prefix is shortened
by one value at a time, until the target recall for a pair at the threshold
is met: 1 - (1 - THRESHOLD**depth)**TREES >= ``RECALL``. So a large group of near copies
is joined by its first trees and long prefixes, and its matches stay few.
At last, in branches of the shortest prefix that still hold several groups and
over two nodes (unlike documents that share passages), the signatures of all
nodes of different groups are compared, in blocks and without a row per
pair. So whatever shares a branch has been matched, however crowded it is.

A group is verified whole, every pair of its nodes that could be linked, on
their sets: a pair counts if |A and B| / |A or B| >= THRESHOLD. The sets of grouped nodes are
made of the texts once and written, sorted hashes; texts do not travel again. Groups
of up to ``BLOCK_BYTES`` are dealt over tasks in batches of about ``TASK_BYTES``. A larger
group is parted by set size into bands (``BAND`` apart, so that sets more than three
bands apart cannot reach the threshold and never meet) and a band by hash into blocks of
about ``BLOCK_BYTES``; each pair of blocks within reach is a task of at most two blocks, which
it compares in tiles of ``TILE`` nodes. Tasks give link counts and a spanning forest of
links, never the pairs themselves. Verified links make the classes.

Result per document: class_id, the smallest doc_id of its class, and n_links,
the number of other documents whose similarity to it is at least
the threshold (documents with the same set included).

Defined results: a text that is null, empty or without words has no links and
its own doc_id as class. Repeated rows are documents of their own, linked to each
other. A null doc_id counts; a class's id is its smallest non-null one, and null
if it has none. An empty table gives no rows. Other columns are not read.
Set hashes have 64 bits: among 10**9 different sets two are taken for equal
with a chance of 3 %.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import M3, Words, arrow_map, mix, written

SHINGLE = 5
THRESHOLD = 0.8
TREES = 16
FIRST_TREES = 4
DEPTH = 6
RECALL = 0.995
SLACK = 0.16
BLOCK_BYTES = 8 << 20  # of a block's sets; a set larger than that is a block of its own
NODE_BYTES = 1_024  # a node counts this besides its set, which bounds the nodes of a block
TASK_BYTES = 16 << 20
TILE = 512
BAND = 0.9  # sizes of neighbouring bands
BRANCH = 512
TASK_NODES = 2_000
SKETCH = "doc_id long, text_hash long, node long, signature binary"

_RNG = np.random.default_rng(911)
_A = (_RNG.integers(0, 1 << 31, TREES * DEPTH, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32)


def stop_depth(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix that reaches the target recall at the threshold."""
    return next(d for d in range(depth, 0, -1) if d == 1 or 1 - (1 - threshold**d) ** trees >= recall)


def steps(threshold: float = THRESHOLD, recall: float = RECALL) -> list[tuple[int, int]]:
    """(prefix, trees) of the matching steps."""
    return [(DEPTH, FIRST_TREES), *[(d, TREES) for d in range(DEPTH, stop_depth(threshold, recall=recall) - 1, -1)]]


def shingle_sets(texts: list[str | None], n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    w = Words(texts)
    at, h = w.windows(n)
    edges = np.searchsorted(at, w.bounds)
    out = []
    for k in range(len(texts)):
        a, b = int(w.bounds[k]), int(w.bounds[k + 1])
        own = h[edges[k]: edges[k + 1]]
        if 0 < b - a < n:
            own = np.array([b - a], np.uint64)
            for i in range(a, b):
                own = mix(own * M3 + w.hashes[i: i + 1])
        out.append(np.unique(own))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values, one row per (non-empty) set."""
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])))[:-1]
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    return np.stack([np.minimum.reduceat(x * a + b, starts) for a, b in zip(_A, _B)], axis=1)


def sketches(docs: DataFrame) -> DataFrame:
    """Set hash (``node``) and signature of every document; null without words."""

    def run(batch):
        sets = shingle_sets(batch.column("text").to_pylist())
        full = [i for i, s in enumerate(sets) if len(s)]
        node, signature = [None] * len(sets), [None] * len(sets)
        for i, sig in zip(full, signatures([sets[i] for i in full]) if full else ()):
            node[i] = int(mix(mix(sets[i]).sum(keepdims=True) + np.uint64(len(sets[i]))).view(np.int64)[0])
            signature[i] = sig.tobytes()
        return {"doc_id": batch.column("doc_id").to_pylist(), "text_hash": batch.column("text_hash").to_pylist(), "node": node, "signature": signature}

    return arrow_map(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), run, SKETCH)


def _label(tree: Column, depth: int) -> Column:
    """The first ``depth`` values of a tree's label, as bytes."""
    return F.substring(F.col("signature"), tree * (4 * DEPTH) + 1, F.lit(4 * depth))


def candidates(nodes: DataFrame, depth: int, trees: int = TREES) -> DataFrame:
    """Distinct matches (a < b) in the first ``trees`` at prefixes of ``depth``,
    between nodes of different groups. ``nodes``: (node, signature, label), label being the group."""
    rows = (nodes.select("node", "signature", F.col("label").alias("group"), F.explode(F.array(*[F.lit(t) for t in range(trees)])).alias("tree"))
            .select("tree", _label(F.col("tree"), DEPTH).alias("label"), "node", "group"))
    trie = rows.repartitionByRange("tree", "label", "node").sortWithinPartitions("tree", "label", "node")

    def near(batches):
        """Matches each row with the one before it if they share the prefix;
        the last row is carried over to the next batch."""
        last = None
        for b in batches:
            key = [t.to_bytes(2, "big") + x[: 4 * depth] for t, x in zip(b.column("tree").to_pylist(), b.column("label").to_pylist())]
            node, group = b.column("node").to_pylist(), b.column("group").to_pylist()
            if last:
                key, node, group = [last[0], *key], [last[1], *node], [last[2], *group]
            made = [(node[i - 1], node[i]) for i in range(1, len(key)) if key[i - 1] == key[i] and group[i - 1] != group[i]]
            if made:
                x = np.array(made, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x.min(axis=1)), pa.array(x.max(axis=1))], names=["a", "b"])
            if key:
                last = key[-1], node[-1], group[-1]

    pairs = trie.mapInArrow(near, "a long, b long")
    branches = rows.select(F.xxhash64("tree", F.substring("label", 1, 4 * depth)).alias("branch"), "node", "group")
    first = (branches.groupBy("branch").agg(F.min(F.struct("node", "group")).alias("f"), F.count("*").alias("n")).where("n > 1")
             .select("branch", F.col("f.node").alias("a"), F.col("f.group").alias("of")))
    star = branches.join(first, "branch").where("group <> of").select("a", F.col("node").alias("b"))
    return pairs.unionByName(star).distinct()


def similar_signatures(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The matches whose signatures agree in at least this share."""
    a = nodes.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    b = nodes.select(F.col("node").alias("b"), F.col("signature").alias("sb"))

    def run(batches):
        for t in batches:
            x, y = (np.frombuffer(b"".join(t.column(c).to_pylist()), np.uint32).reshape(t.num_rows, TREES * DEPTH) for c in ("sa", "sb"))
            yield t.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= least))

    return pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def crowded_links(nodes: DataFrame, depth: int, least: float) -> DataFrame:
    """(a, b): links that join all nodes of different groups that share a
    branch of ``depth`` in any tree and whose signatures agree in at least this
    share. Branches of two nodes are left out: the two stand together and have
    been matched. ``nodes``: (node, signature, label), label being the group.

    A branch's largest group needs no comparison in itself. Its nodes (side 0) and
    the others (side 1) are cut into blocks of about ``BRANCH``; each block of the
    others meets every block of both sides, each pair a task of at most two blocks."""
    rows = (nodes.select("node", F.col("label").alias("group"), "signature", F.explode(F.array(*[F.lit(t) for t in range(TREES)])).alias("tree"))
            .select(F.xxhash64("tree", _label(F.col("tree"), depth)).alias("branch"), "node", "group"))
    crowded = written(rows.groupBy("branch").agg(F.count("*").alias("n"), F.min("group").alias("lo"), F.max("group").alias("hi"))
                      .where("n > 2 and lo <> hi").select("branch"), "crowded")
    rows = written(rows.join(crowded, "branch"), "crowded-nodes")
    sizes = (rows.groupBy("branch", "group").agg(F.count("*").alias("n"))
             .groupBy("branch").agg(F.sum("n").alias("n"), F.max(F.struct("n", "group")).alias("most"))
             .select("branch", F.col("most.group").alias("most"), _blocks(F.col("most.n"), BRANCH).alias("blocks0"), _blocks(F.col("n") - F.col("most.n"), BRANCH).alias("blocks1")))
    dealt = rows.join(sizes, "branch").withColumn("side", (F.col("group") != F.col("most")).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("side") == 0, F.col("blocks0")).otherwise(F.col("blocks1"))).cast("int")
    # Blocks are numbered through, those of side 0 first; one of side 0 meets only those of side 1.
    dealt = dealt.withColumn("block", own + F.col("side") * F.col("blocks0"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.when(F.col("side") == 0, F.col("blocks0")).otherwise(F.lit(0)), F.col("blocks0") + F.col("blocks1") - 1)))
    lo, hi = F.least("block", "other"), F.greatest("block", "other")
    tasks = max(1, -(-rows.count() // TASK_NODES))
    small = (F.col("blocks0") == 1) & (F.col("blocks1") == 1)
    task = F.when(small, F.pmod(F.xxhash64("branch"), F.lit(tasks))).otherwise(F.xxhash64("branch", lo, hi))
    dealt = dealt.select(task.alias("task"), "branch", lo.alias("lo"), hi.alias("hi"), "node", "group")
    dealt = dealt.join(nodes.select("node", "signature"), "node")

    def run(pdf):
        out = []
        for _, g in pdf.groupby(["branch", "lo", "hi"], sort=False):
            node, group = g["node"].to_numpy(np.int64), g["group"].to_numpy(np.int64)
            linked = group[:, None] != group[None, :]
            if linked.any():
                linked &= agreement(np.frombuffer(b"".join(g["signature"]), np.uint32).reshape(len(g), TREES * DEPTH)) >= least
                to = node[forest(linked)]
                out.append(pd.DataFrame({"a": node, "b": to})[to != node])
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": []})

    return dealt.groupBy("task").applyInPandas(run, "a long, b long").distinct()


def _blocks(n: Column, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(n / size)).cast("int")


def agreement(signature: np.ndarray) -> np.ndarray:
    """Share of equal values of every pair of signatures."""
    same = np.zeros((len(signature), len(signature)), np.uint16)
    for values in signature.T:
        same += values[:, None] == values[None, :]
    return same / signature.shape[1]


def components(links: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """(node, label) for the nodes of ``links`` (a, b): label is the smallest
    node of the connected component. Every round writes its table to the
    shared folder: each node takes the smallest label around it, then the
    label of its label, until a round changes nothing."""
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-links")
    if both.isEmpty():
        return both.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label"))
    labels = written(labels, f"{name}-0")
    for i in range(max_rounds):
        around = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m")))
        step = labels.join(around, "node").select("node", F.col("label").alias("was"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = step.join(jump, "label", "left").select("node", "was", F.least("label", F.coalesce("further", "label")).alias("label"))
        new = written(step, f"{name}-{i + 1}")
        changed = new.where("was <> label").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels
    raise RuntimeError(f"components of {name} did not settle in {max_rounds} rounds")


def joined_groups(groups: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``groups`` with the labels that the links (a, b) between nodes leave:
    the groups' own graph, which is smaller than the nodes', is labelled."""
    a = groups.select(F.col("node").alias("a"), F.col("label").alias("la"))
    b = groups.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    between = links.join(a, "a").join(b, "b").select(F.col("la").alias("a"), F.col("lb").alias("b")).where("a <> b")
    new = components(between, name).select(F.col("node").alias("label"), F.col("label").alias("new"))
    return groups.join(new, "label", "left").withColumn("label", F.coalesce("new", "label")).drop("new")


def compare(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Which pairs of sets reach the similarity: a square matrix without the
    diagonal for one list, else left by right."""
    sets = left if right is None else [*left, *right]
    n, sizes = len(sets), np.array([len(s) for s in sets])
    all_ = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(all_, kind="stable")
    all_, owner = all_[order], owner[order]
    new = np.concatenate(([True], all_[1:] != all_[:-1]))
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1  # a shingle of one set adds nothing
    column, owner = column[shared], owner[shared]
    if len(column):
        column = np.cumsum(np.concatenate(([0], np.diff(column) > 0)))
    m = len(left)
    common = np.zeros((m, m if right is None else n - m), np.float32)
    columns = int(column[-1]) + 1 if len(column) else 0
    width = max(1, min(columns, (1 << 22) // n))
    edges = np.searchsorted(column, np.arange(0, columns + width, width))
    for lo, hi in zip(edges[:-1], edges[1:]):
        part = np.zeros((n, width), np.float32)
        part[owner[lo:hi], column[lo:hi] % width] = 1
        common += part[:m] @ (part if right is None else part[m:]).T
    a, b = sizes[:m, None], (sizes[None, :] if right is None else sizes[None, m:])
    # Whole numbers below 2**24 are exact in float32, so this is the exact test but for the threshold's own rounding.
    out = common >= threshold * (a + b - common) - 1e-9
    if right is None:
        np.fill_diagonal(out, False)
    return out


def forest(linked: np.ndarray) -> np.ndarray:
    """For each node of a symmetric matrix the smallest node connected to it."""
    label = np.arange(len(linked))
    while True:
        around = np.where(linked, label[None, :], len(linked)).min(axis=1, initial=len(linked))
        new = np.minimum(label, around)
        new = new[new]
        if (new == label).all():
            return label
        label = new


VERIFIED = "node long, links long, other long"
SETS = "node long, n long, shingles binary"


def reach(threshold: float = THRESHOLD, band: float = BAND) -> int:
    """How many bands apart two sets may be and still be linked: sizes of bands d
    apart differ by a factor of band**(d - 1) at the most alike."""
    return next(d for d in range(1, 1000) if band**d < threshold)


def node_sets(groups: DataFrame, docs: DataFrame, sketch: DataFrame) -> DataFrame:
    """(node, n, shingles): the set of each node of ``groups``, sorted hashes. Made of one of
    its texts; any one will do, as their sets are equal."""
    chosen = (sketch.join(groups.select("node"), "node").groupBy("node").agg(F.min(F.struct("text_hash", "doc_id")).alias("d"))
              .select("node", F.col("d.text_hash").alias("chosen_hash"), F.col("d.doc_id").alias("chosen_doc")))
    same = (F.xxhash64("text") == F.col("chosen_hash")) & F.col("doc_id").eqNullSafe(F.col("chosen_doc"))
    texts = docs.select("doc_id", "text").join(chosen, same).select("node", "text")

    def run(batch):
        sets = shingle_sets(batch.column("text").to_pylist())
        return {"node": batch.column("node").to_pylist(), "n": [len(s) for s in sets], "shingles": [s.tobytes() for s in sets]}

    return arrow_map(texts, run, SETS).groupBy("node").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"))


def compare_blocks(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float, tile: int = TILE):
    """Link matrices of all tiles of two blocks (of one, if ``right`` is None), as
    (from, to, matrix) in positions of the blocks."""
    for i in range(0, len(left), tile):
        if right is None:
            yield i, i, compare(left[i: i + tile], None, threshold)
        for j in range(0 if right is not None else i + tile, len(left if right is None else right), tile):
            yield i, j, compare(left[i: i + tile], (left if right is None else right)[j: j + tile], threshold)


def verify(groups: DataFrame, docs: DataFrame, sketch: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(node, links, other): for every node how many documents it is linked to in one
    task, and nodes it is connected to there. ``groups``: (node, label, copies)
    of all nodes; those alone in their group are left out."""
    alone = groups.groupBy("label").agg(F.count("*").alias("nodes")).where("nodes > 1")
    groups = written(groups.select("node", "copies", "label").join(alone, "label").drop("nodes"), "members")
    sets = written(node_sets(groups, docs, sketch), "sets")
    weight = F.col("n") * 8 + NODE_BYTES
    sized = groups.join(sets.select("node", "n"), "node")
    bytes_ = sized.groupBy("label").agg(F.sum(weight).alias("bytes"))
    band = F.when(F.col("bytes") <= BLOCK_BYTES, F.lit(0)).otherwise(F.floor(F.log("n") / F.lit(float(-np.log(BAND))))).cast("int")
    sized = written(sized.join(bytes_, "label").withColumn("band", band), "sized")
    bands = sized.groupBy("label", "band").agg(F.greatest(F.lit(1), F.ceil(F.sum(weight) / BLOCK_BYTES)).cast("int").alias("blocks"))
    code = lambda band_, sub: band_.cast("long") * F.lit(1 << 32) + sub
    own = code(F.col("band"), F.pmod(F.xxhash64("node"), F.col("blocks")))
    apart = F.when(F.col("bytes") <= BLOCK_BYTES, F.lit(0)).otherwise(F.lit(reach(threshold)))
    met = F.explode(F.sequence(F.col("band") - apart, F.col("band") + apart))
    others = bands.select("label", F.col("band").alias("met"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("sub"))
    dealt = (sized.join(bands, ["label", "band"]).select("label", "node", "copies", "bytes", own.alias("own"), met.alias("met"))
             .join(others, ["label", "met"]).withColumn("other", code(F.col("met"), F.col("sub"))))
    lo, hi = F.least("own", "other"), F.greatest("own", "other")
    small = sized.where(F.col("bytes") <= BLOCK_BYTES).agg(F.sum(weight)).first()[0] or 0
    tasks = max(1, -(-small // TASK_BYTES))
    task = F.when(F.col("bytes") <= BLOCK_BYTES, F.pmod(F.xxhash64("label"), F.lit(tasks))).otherwise(F.xxhash64("label", lo, hi))
    rows = dealt.select(task.alias("task"), "label", lo.alias("lo"), hi.alias("hi"), "own", "node", "copies").join(sets.select("node", "shingles"), "node")

    def run(pdf):
        out = []
        for (_, lo_, hi_), g in pdf.groupby(["label", "lo", "hi"], sort=False):
            g = g.sort_values(["own", "node"])
            node, copies = g["node"].to_numpy(np.int64), g["copies"].to_numpy(np.int64)
            own_sets = [np.frombuffer(b, np.uint64) for b in g["shingles"]]
            m = len(g) if lo_ == hi_ else int((g["own"] == lo_).sum())
            if m == len(g) and lo_ != hi_ or not m:
                continue  # one of the two blocks has no node
            links = np.zeros(len(g), np.int64)
            joins = [np.stack([node, node], axis=1)]
            for i, j, linked in compare_blocks(own_sets[:m], None if lo_ == hi_ else own_sets[m:], threshold):
                if not linked.any():
                    continue
                one = lo_ == hi_ and i == j
                a = np.arange(i, i + linked.shape[0])
                b = a if one else np.arange(j, j + linked.shape[1]) + (0 if lo_ == hi_ else m)
                links[a] += linked @ copies[b]
                at = a
                if not one:
                    links[b] += linked.T @ copies[a]
                    at, size = np.concatenate((a, b)), len(a)
                    square = np.zeros((len(at), len(at)), bool)
                    square[:size, size:] = linked
                    square[size:, :size] = linked.T
                    linked = square
                to = node[at[forest(linked)]]
                joins.append(np.stack([node[at], to], axis=1)[to != node[at]])
            edges = np.unique(np.concatenate(joins), axis=0)
            total = dict(zip(node.tolist(), links.tolist()))
            itself = edges[:, 0] == edges[:, 1]
            out.append(pd.DataFrame({"node": edges[:, 0], "links": np.where(itself, [total[x] for x in edges[:, 0].tolist()], 0), "other": edges[:, 1]}))
        return pd.concat(out) if out else pd.DataFrame({"node": [], "links": [], "other": []})

    return rows.groupBy("task").applyInPandas(run, VERIFIED)


def jaccard_classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(doc_id, text_hash, class_id, n_links, class) of every row; ``class`` is
    the same number for the rows of a class, and null without words."""
    sketch = written(sketches(docs), "sketch")
    nodes = written(sketch.where("node is not null").groupBy("node").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("first_doc"), F.min("signature").alias("signature")), "nodes")
    groups = nodes.select("node", "copies", "signature", F.col("node").alias("label"))
    for depth, trees in steps(threshold, recall):
        likely = similar_signatures(candidates(groups, depth, trees), nodes, threshold - SLACK)
        groups = written(joined_groups(groups, likely, f"groups-{depth}-{trees}"), f"groups-{depth}-{trees}")
    likely = crowded_links(groups, stop_depth(threshold, recall=recall), threshold - SLACK)
    groups = written(joined_groups(groups, likely, "groups-crowded"), "groups-crowded")
    verified = written(verify(groups, docs, sketch, threshold), "verified")
    classes = components(verified.select(F.col("node").alias("a"), F.col("other").alias("b")).where("a <> b"), "classes")
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    own = nodes.join(classes, "node", "left").join(links, "node", "left").select(
        "node", "copies", "first_doc", F.coalesce("label", "node").alias("class"), F.coalesce("links", F.lit(0)).alias("links"))
    ids = own.groupBy("class").agg(F.min("first_doc").alias("class_id"))
    per_node = own.join(ids, "class").select("node", "class", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    return sketch.select("doc_id", "text_hash", "node").join(per_node, "node", "left").select(
        "doc_id", "text_hash", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "class")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (its own columns) with one document of each class: the one with
    the smallest doc_id (null last). Of repeated rows one stays."""
    found = written(jaccard_classes(docs, threshold), "keep")
    linked = found.where("n_links > 0")
    best = linked.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("best"))
    marks = linked.join(best, "class").select(
        F.col("doc_id").alias("__class_doc"), F.col("text_hash").alias("__class_hash"),
        (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash"))).alias("__class_stays")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__class_doc")) & (F.xxhash64("text") == F.col("__class_hash"))
    marked = docs.join(marks, same, "left")
    alone = marked.where(F.col("__class_stays").isNull())
    first = marked.where("__class_stays").dropDuplicates(["__class_doc", "__class_hash"])
    return alone.unionByName(first).select(*[F.col(f"`{c}`") for c in docs.columns])


def contract(docs: DataFrame) -> DataFrame:
    return jaccard_classes(docs).select("doc_id", "class_id", "n_links")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SQL = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT rid, ws, least({SHINGLE}, len(ws)) AS size, unnest(range(len(ws) - least({SHINGLE}, len(ws)) + 1)) AS i FROM d WHERE len(ws) > 0),
s AS (SELECT DISTINCT rid, size, array_to_string(list_slice(ws, i + 1, i + size), ' ') AS shingle FROM i),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
c AS (SELECT a.rid AS a, b.rid AS b, count(*) AS common FROM s a JOIN s b ON a.size = b.size AND a.shingle = b.shingle AND a.rid <> b.rid GROUP BY a.rid, b.rid),
l AS (SELECT c.a, c.b FROM c JOIN n x ON x.rid = c.a JOIN n y ON y.rid = c.b WHERE 5 * common >= 4 * (x.n + y.n - common)),
r AS (SELECT rid AS a, rid AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
m AS (SELECT r.a AS rid, min(d.doc_id) AS class_id FROM r JOIN d ON d.rid = r.b GROUP BY r.a),
k AS (SELECT a AS rid, count(*) AS n_links FROM l GROUP BY a)
SELECT d.doc_id, m.class_id, coalesce(k.n_links, 0) AS n_links FROM d JOIN m ON m.rid = d.rid LEFT JOIN k ON k.rid = d.rid
"""
