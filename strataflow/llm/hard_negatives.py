"""Hard negatives by a secondary sort: for each anchor and each of its best positives, the best negatives in a window below it.

A pair's score is the integer inner product of the quantised vectors. Pairs are packed into keys (anchor, descending score, kind,
id); Spark deals them by anchor and sorts them within partitions (`repartitionAndSortWithinPartitions`), and an iterator reads an
anchor's pairs in order: a positive opens a window, a negative goes to the open windows that its score fits, and a window closes once
it is full or scores have fallen below it. No more than an anchor's open windows are held. Kind puts positives before negatives of the
same score, since a score of 0 fits its own window.

Anchors meet all rows in tiles of a block of anchors and a block of rows, whose sizes are bounded in bytes; a tile's scores are one
matrix product. Only pairs that may count leave a tile, which loses none, since a list's best are among the best of its parts:

* positives: the best of the tile for each anchor, in tiles of one label, so that only pairs of a label are scored; then the best
  over all tiles;
* negatives: with an anchor's positives known, the best of the tile in each positive's window.

Every row meets every anchor by contract, so scores grow with rows times anchors; what is shuffled are vectors, once for each block of
the other side, and the pairs kept of each tile.

Scores are exact: products are taken in floating point while the largest possible sum is below 2**53, in Python's integers beyond.

Edge cases: rows with a null label, a null vector or a component that is null, NaN or infinite take no part; components beyond a long,
and scores beyond +-2**62, are held to that; a shorter vector goes on with zeros, and an empty one scores 0; rows with a null id are
candidates that come last on ties, and no anchors. Of rows that repeat an anchor's id the least by (label, vector) is the anchor; rows
of the anchor's id are none of its candidates; rows that repeat another id are candidates each. Other columns are ignored; an empty
table, or one without anchors, gives no rows. A positive below zero has an empty window.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import named, stored

#: Bytes of a block's vectors in a tile, rows of one at least, and anchors whose scores are held at once.
BLOCK_BYTES = 32 << 20
LEAST_ROWS = 4096
AT_ONCE = 256
_LIMIT = 1 << 62
_BIAS = 1 << 63
#: (anchor, descending score, kind, whether the id is null, id), so that bytes compare as the key does.
_KEY = struct.Struct(">QQBBQ")
POSITIVE, NEGATIVE = 0, 1
SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_PAIRS = "anchor long, score long, id long"


@dataclass(frozen=True)
class Windows:
    """How many positives and negatives count, and a negative's least and most share of the positive's score, in percent."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95

    def bounds(self, score: int) -> tuple[int, int]:
        """The least and the largest score of a negative of this positive; none fits if the first is larger."""
        return -(-self.low * score // 100), self.high * score // 100


def quantised(rows: DataFrame, is_anchor: Column, id_col: str, label: Column, vector_col: str, scale: int = 256) -> DataFrame:
    """(id, label, q, anchor) of the rows that take part; q: whole components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    v = named(vector_col).cast("array<double>")
    kept = rows.where(label.isNotNull() & v.isNotNull() & ~F.exists(v, bad))
    q = F.transform(v, lambda x: F.floor(x * scale).cast("bigint"))
    ident = named(id_col).cast("long")
    return kept.select(ident.alias("id"), label.cast("string").alias("label"), q.alias("q"), (ident.isNotNull() & F.coalesce(is_anchor, F.lit(False))).alias("anchor"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """A row for each vector, shorter ones filled up with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of a and of b, as int64 within +-2**62."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (a, b)]
    if width * most[0] * most[1] < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, -_LIMIT, _LIMIT).astype(np.int64)


class _Tile:
    """A block of anchors and a block of rows, these in the order of ties."""

    def __init__(self, anchors: pa.Table, rows: pa.Table) -> None:
        ids = rows.column("id").combine_chunks()
        null = ids.is_null().to_numpy(zero_copy_only=False)
        plain = ids.fill_null(0).to_numpy(zero_copy_only=False)
        order = np.lexsort((plain, null))
        self.anchors, self.rows = anchors, rows
        self.null, self.ids = null[order], plain[order]
        self.vectors = _matrix(rows.column("q"))[order]
        self.of_row = order
        self.of_anchor = anchors.column("id").to_numpy()

    def scored(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first anchor, scores of some anchors with all rows, which rows share the anchor's id)."""
        mine = _matrix(self.anchors.column("q"))
        for at in range(0, len(mine), AT_ONCE):
            own = (self.ids == self.of_anchor[at : at + AT_ONCE, None]) & ~self.null
            yield at, inner(mine[at : at + AT_ONCE], self.vectors), own

    def pairs(self, found: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
        """The pairs (anchor's place, rows' places, scores) as a table."""
        places = np.concatenate([cols for _, cols, _ in found]) if found else np.zeros(0, np.int64)
        names = np.repeat(self.of_anchor[[i for i, _, _ in found]], [len(cols) for _, cols, _ in found]) if found else np.zeros(0, np.int64)
        scores = np.concatenate([s for _, _, s in found]) if found else np.zeros(0, np.int64)
        return pa.table({"anchor": pa.array(names, pa.int64()), "score": pa.array(scores, pa.int64()), "id": pa.array(self.ids[places], pa.int64(), mask=self.null[places])})


def _best(scores: np.ndarray, allowed: np.ndarray, n: int) -> np.ndarray:
    """Places of the n best allowed scores, earlier places first on ties, in any order."""
    places = np.flatnonzero(allowed)
    if len(places) <= n:
        return places
    values = scores[places]
    least = np.partition(values, len(values) - n)[len(values) - n]
    above = places[values > least]
    return np.concatenate([above, places[values == least][: n - len(above)]])


def _positives(n: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        tile, found = _Tile(anchors, rows), []
        if anchors.num_rows and rows.num_rows:
            for at, scores, own in tile.scored():
                for i, (line, same) in enumerate(zip(scores, own, strict=True)):
                    cols = _best(line, ~same, n)
                    found.append((at + i, cols, line[cols]))
        return tile.pairs(found)

    return run


def _negatives(windows: Windows):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        tile, found = _Tile(anchors, rows), []
        if anchors.num_rows and rows.num_rows:
            names = pa.chunked_array([*anchors.column("label").chunks, *rows.column("label").chunks]).combine_chunks().dictionary_encode().indices.to_numpy()
            mine, theirs = names[: anchors.num_rows], names[anchors.num_rows :][tile.of_row]
            bounds = [[windows.bounds(s) for s in wants if s >= 0] for wants in anchors.column("wants").to_pylist()]
            least = np.array([min((low for low, _ in b), default=1) for b in bounds], np.int64)
            most = np.array([max((high for _, high in b), default=0) for b in bounds], np.int64)
            for at, scores, own in tile.scored():
                part = slice(at, at + len(scores))
                fit = (scores >= least[part, None]) & (scores <= most[part, None]) & (theirs != mine[part, None]) & ~own
                for i in np.flatnonzero(fit.any(axis=1)):
                    cols = np.flatnonzero(fit[i])
                    cols = cols[np.argsort(-scores[i, cols], kind="stable")]
                    falling = -scores[i, cols]
                    picked = set()
                    for low, high in bounds[at + i]:
                        first = int(np.searchsorted(falling, -high))
                        last = int(np.searchsorted(falling, -low, side="right"))
                        picked.update(range(first, min(last, first + windows.negatives)))
                    cols = cols[sorted(picked)]
                    found.append((at + int(i), cols, scores[i, cols]))
        return tile.pairs(found)

    return run


def pack(anchor: int, score: int, kind: int, row: int | None) -> bytes:
    return _KEY.pack(anchor + _BIAS, _BIAS - score, kind, row is None, (row or 0) + _BIAS)


def unpack(key: bytes) -> tuple[int, int, int, int | None]:
    anchor, score, kind, null, row = _KEY.unpack(key)
    return anchor - _BIAS, _BIAS - score, kind, None if null else row - _BIAS


def emit(keys: Iterator[tuple[bytes, None]], windows: Windows) -> Iterator[tuple]:
    """Rows of SCHEMA from keys in order; holds the open windows of one anchor only."""
    anchor, opened = None, []  # of each window: positive, its score, least and largest score, negatives so far
    for key, _ in keys:
        of, score, kind, row = unpack(key)
        if of != anchor:
            anchor, opened = of, []
        if kind == POSITIVE:
            low, high = windows.bounds(score)
            if score >= 0:
                opened.append([row, score, low, high, 0])
            continue
        for window in opened:
            if window[2] <= score <= window[3]:
                window[4] += 1
                yield anchor, window[0], window[4], row, window[1], score
        opened = [w for w in opened if w[4] < windows.negatives and w[2] <= score]


def _blocks(n: int, width: int, parts: int, least: int) -> int:
    """Blocks of n vectors, none beyond BLOCK_BYTES but by chance of dealing; up to `parts` while they keep `least` rows."""
    return max(1, -(-n * max(width, 1) * 8 // BLOCK_BYTES), min(parts, n // least))


def hard_negatives(rows: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding", windows: Windows = Windows(), scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for all anchors, as the module says."""
    spark = rows.sparkSession
    base = stored(quantised(rows, is_anchor, id_col, label, vector_col, scale), "vectors")
    size = base.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors"), F.coalesce(F.max(F.size("q")), F.lit(0)).alias("width")).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    of_rows, of_anchors = _blocks(size["n"], size["width"], parts, LEAST_ROWS), _blocks(size["anchors"], size["width"], 1, 1)
    anchors = base.where("anchor").groupBy("id").agg(F.min(F.struct("label", "q")).alias("v")).select("id", "v.label", "v.q", F.pmod(F.xxhash64("id"), F.lit(of_anchors)).alias("ab"))
    every = lambda n, name: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))).alias(name)
    # A row's block comes from its place in the stored files, so that rows that are alike are dealt evenly.
    blocks = base.select("id", "label", "q", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(of_rows)).alias("rb")).select("*", every(of_anchors, "ab"))

    own = lambda df: df.select(*[F.col(c).alias(c) for c in df.columns])  # noqa: E731  both sides come from one table
    tiles = lambda left, keys, run: own(left.select("*", every(of_rows, "rb"))).groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInArrow(run, _PAIRS)
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    near = tiles(anchors, ["label", "ab", "rb"], _positives(windows.positives))
    positives = stored(near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= windows.positives).drop("n"), "positives")
    wants = positives.groupBy(F.col("anchor").alias("id")).agg(F.collect_set("score").alias("wants"))
    negatives = tiles(anchors.join(wants, "id"), ["ab", "rb"], _negatives(windows))
    pairs = positives.withColumn("kind", F.lit(POSITIVE)).unionByName(negatives.withColumn("kind", F.lit(NEGATIVE)))
    keys = pairs.select("anchor", "score", "kind", "id").rdd.map(lambda r: (pack(*r), None))
    ordered = keys.repartitionAndSortWithinPartitions(parts, lambda key: zlib.crc32(key[:8]))
    return spark.createDataFrame(ordered.mapPartitions(lambda part: emit(part, windows)), SCHEMA, verifySchema=False)


def relabelled(id_col: str = "vec_id", label_col: str = "label") -> Column:
    """The label that the query goes by: the next of ten where the id is divisible by 7."""
    return F.when(named(id_col) % 7 == 0, (named(label_col) + 1) % 10).otherwise(named(label_col))


def anchored(id_col: str = "vec_id") -> Column:
    return named(id_col) % 50 == 0


ORACLE = """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id IS DISTINCT FROM b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
w AS (
  SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS r, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM w WHERE r <= 3"""
