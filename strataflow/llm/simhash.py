"""SimHash near-dedup with a binary-trie self-join.

Fingerprints are 64-bit majority votes of the XXH64 values of three-word shingles. Distinct fingerprints form
a binary trie; pairs within a Hamming budget are found by walking pairs of trie nodes together, adding up the
bits in which their paths differ and dropping a pair once that is over the budget.

The walk is spread over the cluster in two steps. (1) The 64 bits are cut into budget + 1 blocks; two
fingerprints within the budget agree on one block, so for each block in turn the trie is rooted at that
block's value (the bits rotated to the top) and every root node is walked on its own. (2) A root node with
more than ``node_cap`` fingerprints is opened further: its rows go to pairs of child nodes eight bits deeper
whose paths are within the budget, again and again until every pair is small. Nothing is dropped.
Each task turns its pairs into star edges to the smallest fingerprint it reaches, so the edges grow with the
rows and not with the pairs; the components of these edges are the groups.

Edge cases: a null or blank text has fingerprint zero, linked like any other; equal fingerprints are always
linked; a null id is an id like any other (never smallest unless alone); other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blank_if_null, named, stored
from .components import connected_components
from .exact_dedup import keep_keys, row_key

SHINGLE = 3
BUDGET = 2
SEED = 42
NODE_CAP = 2048
STEP = 8
_PIECE = 1 << 15


def simhash(data: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one text's UTF-8 bytes; A-Z are lower-cased, words split at white space."""
    words = data.lower().split()  # of bytes: A-Z only, and exactly the six blanks
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) <= shingle:
        values = np.array([xxhash.xxh64_intdigest(text, seed)], dtype=np.uint64)
        return int(_majority(values.view(np.uint8).reshape(-1, 8)))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-shingle])).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest, n = xxhash.xxh64_intdigest, len(starts)
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _PIECE):
        values = np.array([digest(text[a:b], seed) for a, b in zip(starts[at : at + _PIECE], stops[at : at + _PIECE], strict=True)], dtype=np.uint64)
        votes += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def _majority(rows: np.ndarray) -> np.uint64:
    votes = np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * votes > len(rows), bitorder="little").view(np.uint64)[0]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, said, fp): said is the SHA-256 of the text, fp a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([simhash(x.as_py()) for x in batch.column("raw")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("said"), pa.array(found.view(np.int64))], names=["id", "said", "fp"])

    text = blank_if_null(text_col)
    return docs.select(named(id_col).alias("id"), F.sha2(text, 256).alias("said"), text.cast("binary").alias("raw")).mapInArrow(run, f"id {kind}, said string, fp long")


def trie_pairs(left: np.ndarray, right: np.ndarray | None, bits: int, spent: np.ndarray | int, budget: int, nodes: tuple[np.ndarray, ...] | None = None, most: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of values whose lowest `bits` bits differ in at most budget - spent places.

    left: sorted unsigned values; right: None to join left with itself (each pair once), else the other side.
    nodes: (first, end, first, end, itself) of the node pairs to start from, as ranges of left and right; by
    default the whole arrays. Values under one node must agree above the lowest `bits` bits.
    """
    other = left if right is None else right
    if nodes is None:
        nodes = tuple(np.array([x]) for x in (0, len(left), 0, len(other), right is None))
    spent = np.broadcast_to(np.asarray(spent, dtype=np.int64), nodes[0].shape).copy()
    stack = [(bits - 1, *nodes, spent)]
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    while stack:
        bit, a0, a1, b0, b1, own, d = stack.pop()
        if len(a0) > most:
            half = len(a0) // 2
            stack += [(bit, *(x[:half] for x in (a0, a1, b0, b1, own, d))), (bit, *(x[half:] for x in (a0, a1, b0, b1, own, d)))]
            continue
        if not len(a0):
            continue
        if bit < 0:
            yield a0[~own], b0[~own]
            continue
        if bit not in sums:
            sums[bit] = tuple(np.concatenate(([0], np.cumsum(v >> np.uint64(bit) & np.uint64(1)).astype(np.int64))) for v in (left, other))
        ones_a, ones_b = sums[bit]
        am, bm = a1 - (ones_a[a1] - ones_a[a0]), b1 - (ones_b[b1] - ones_b[b0])
        cross = ~own
        parts = [(a0, am, b0, bm, own, d), (am, a1, bm, b1, own, d), (a0, am, bm, b1, np.zeros_like(own), d + 1), (am[cross], a1[cross], b0[cross], bm[cross], own[cross], d[cross] + 1)]
        joined = [np.concatenate(x) for x in zip(*parts, strict=True)]
        n0, n1, m0, m1, same, diff = joined
        keep = (n1 > n0) & (m1 > m0) & (diff <= budget) & ~(same & (n1 - n0 < 2))
        stack.append((bit - 1, *(x[keep] for x in joined)))


def _roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index that each of n indices reaches over the pairs."""
    root = np.arange(n)
    for a, b in pairs:
        while True:
            x, y = root[a], root[b]
            low, high = np.minimum(x, y), np.maximum(x, y)
            if (low == high).all():
                break
            np.minimum.at(root, high, low)
            while not (root[root] == root).all():
                root = root[root]
    return root


def _rotate(fp: np.ndarray, by: int) -> np.ndarray:
    by %= 64
    return fp if not by else fp << np.uint64(by) | fp >> np.uint64(64 - by)


def _blocks(budget: int) -> list[tuple[int, int]]:
    """(first bit from the top, width) of budget + 1 blocks of the 64 bits."""
    cuts = [64 * i // (budget + 1) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _walk(batches: Iterator[pa.RecordBatch], budget: int, blocks: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Rows (block, depth, node_a, node_b, spent, side, fp) sorted by node pair; emits star edges (a, b)."""
    fields = ("block", "depth", "node_a", "node_b", "spent", "side", "fp")
    held: list[np.ndarray] | None = None

    def solve(rows: list[np.ndarray]) -> pa.RecordBatch:
        block, depth, node_a, node_b, spent, side, fp = rows
        values = fp.view(np.uint64)
        edges_a, edges_b = [], []
        for j, deep in {*zip(block.tolist(), depth.tolist(), strict=True)}:
            at = np.flatnonzero((block == j) & (depth == deep))
            turned = _rotate(values[at], blocks[j][0])
            order = np.lexsort((turned, side[at], node_b[at], node_a[at]))
            at, turned = at[order], turned[order]
            edge = np.flatnonzero(np.r_[True, (np.diff(node_a[at]) != 0) | (np.diff(node_b[at]) != 0)])
            stop = np.r_[edge[1:], len(at)]
            own = node_a[at][edge] == node_b[at][edge]
            middle = np.where(own, stop, edge + np.add.reduceat((side[at] == 0).astype(np.int64), edge))
            begin, finish = np.where(own, edge, middle), stop
            live = np.where(own, stop - edge > 1, (middle > edge) & (stop > middle))
            nodes = tuple(x[live] for x in (edge, np.where(own, stop, middle), begin, finish, own))
            found = trie_pairs(turned, None, 64 - int(deep), spent[at][edge][live], budget, nodes)
            root = _roots(len(at), found)
            moved = np.flatnonzero(root != np.arange(len(root)))
            edges_a.append(values[at[moved]].view(np.int64))
            edges_b.append(values[at[root[moved]]].view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (edges_a, edges_b)], names=["a", "b"])

    for batch in batches:
        now = [batch.column(f).to_numpy(zero_copy_only=False) for f in fields]
        held = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
        if len(held[0]) >= 1 << 16:  # the last node pair may go on in the next batch
            last = np.flatnonzero(np.any([np.diff(x) != 0 for x in held[:4]], axis=0))
            if len(last):
                cut = last[-1] + 1
                yield solve([x[:cut] for x in held])
                held = [x[cut:] for x in held]
    if held is not None and len(held[0]):
        yield solve(held)


def hamming_links(prints: DataFrame, budget: int = BUDGET, node_cap: int = NODE_CAP) -> DataFrame:
    """Star edges (a, b) over the distinct fingerprints in column fp whose components are those of all links."""
    blocks = _blocks(budget)
    turned = F.array(*[F.struct(F.lit(j).alias("block"), F.shiftrightunsigned(_turn(F.col("fp"), at), 64 - width).alias("node"), F.lit(width).alias("depth")) for j, (at, width) in enumerate(blocks)])
    rows = prints.select("fp").distinct().select("fp", F.explode(turned).alias("t"))
    rows = rows.select("t.block", "t.depth", F.col("t.node").alias("node_a"), F.col("t.node").alias("node_b"), F.lit(0).alias("spent"), F.lit(0).alias("side"), "fp")
    key = ["block", "depth", "node_a", "node_b"]
    ready: list[DataFrame] = []
    while True:
        rows = stored(rows, "nodes")
        sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("depth").alias("d"))
        large = sizes.where((F.col("n") > node_cap) & (F.col("d") < 64)).select(*key)
        alone = sizes.where(F.col("n") < 2).select(*key)
        any_large = not large.isEmpty()
        done = rows.join(large.union(alone) if any_large else alone, key, "left_anti")
        ready.append(done)
        if not any_large:
            break
        rows = _open(rows.join(large, key, "left_semi"), blocks, budget)
    walked = [
        x.repartition(*key).sortWithinPartitions(*key).mapInArrow(lambda batches: _walk(batches, budget, blocks), "a long, b long")
        for x in ready
    ]
    out = walked[0]
    for x in walked[1:]:
        out = out.union(x)
    return out


def _turn(fp, by: int):
    return fp if not by else F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by))


def _open(rows: DataFrame, blocks: list[tuple[int, int]], budget: int) -> DataFrame:
    """Rows of large node pairs, dealt to the pairs of their children STEP bits deeper that are within the budget."""
    start = F.element_at(F.array(*[F.lit(at) for at, _ in blocks]), F.col("block") + 1)
    own = F.col("node_a") == F.col("node_b")
    step = F.least(F.lit(STEP), F.lit(64) - F.col("depth"))
    child = F.expr(f"(shiftrightunsigned(shiftleft(fp, __start) | IF(__start = 0, 0L, shiftrightunsigned(fp, 64 - __start)), 64 - depth - __step)) & {2**STEP - 1}L & (shiftleft(1L, __step) - 1)")
    masks = [m for m in range(1 << STEP) if m.bit_count() <= budget]
    mask = F.explode(F.array(*[F.lit(m).cast("long") for m in masks]))
    first = F.col("side") == 0
    wide = rows.withColumns({"__start": start, "__step": step, "__own": own}).withColumn("__child", child).withColumn("__mask", mask)
    wide = wide.withColumn("__spent", F.col("spent") + F.bit_count("__mask")).where((F.col("__spent") <= budget) & (F.col("__mask") < F.expr("shiftleft(1L, __step)")))
    wide = wide.withColumn("__mate", F.col("__child").bitwiseXOR(F.col("__mask")))
    left = F.when(F.col("__own"), F.least("__child", "__mate")).otherwise(F.when(first, F.col("__child")).otherwise(F.col("__mate")))
    right = F.when(F.col("__own"), F.greatest("__child", "__mate")).otherwise(F.when(first, F.col("__mate")).otherwise(F.col("__child")))
    side = F.when(F.col("__own"), (F.col("__child") > F.col("__mate")).cast("int")).otherwise(F.col("side"))
    return wide.select(
        "block", (F.col("depth") + F.col("__step")).alias("depth"),
        F.expr("shiftleft(node_a, __step)").bitwiseOR(left).alias("node_a"), F.expr("shiftleft(node_b, __step)").bitwiseOR(right).alias("node_b"),
        F.col("__spent").alias("spent"), side.alias("side"), "fp",
    )


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET, node_cap: int = NODE_CAP) -> DataFrame:
    """One row per row of docs: id, fingerprint (16 hex digits), component_id (the smallest id reachable)."""
    prints = stored(fingerprints(docs, id_col, text_col).drop("said"), "simhash")
    classes = _classes(prints, F.min("id"), budget, node_cap)
    return prints.join(classes, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("best").alias("component_id"))


def _classes(prints: DataFrame, least: Column, budget: int, node_cap: int) -> DataFrame:
    """(fp, best): a component's smallest value of the aggregate `least`, for each of its fingerprints."""
    distinct = prints.groupBy("fp").agg(least.alias("least"))
    links = connected_components(hamming_links(prints, budget, node_cap)).select(F.col("node").alias("fp"), "root")
    rooted = distinct.join(links, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("best"))
    return stored(rooted.join(smallest, "root").select("fp", "best"), "classes")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET, node_cap: int = NODE_CAP) -> DataFrame:
    """docs with one row of each near-copy group, all columns kept: that of the smallest id (null last), then of the
    smaller SHA-256 of its text; of rows that repeat an id only the one of its group that this picks stays.
    """
    prints = stored(fingerprints(docs, id_col, text_col), "simhash")
    best = _classes(prints, F.min(F.struct(F.col("id").isNull().alias("z"), "id", "said")), budget, node_cap)
    return keep_keys(docs, row_key(named(id_col), F.sha2(blank_if_null(text_col), 256)), best.select(row_key(F.col("best.id"), F.col("best.said"))))
