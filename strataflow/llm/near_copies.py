"""Near-copy removal for pipelines: five-word shingles, Jaccard similarity of 0.8 or more, checked exactly.

Texts are lower-cased (A-Z) and split at white space as in :mod:`simhash`; texts of equal words are one node.
Candidates come from two sides. (1) The SimHash trie links nodes whose fingerprints over the same shingles are
within a few bits, which only the closest copies are. (2) Below those, a node has ``BANDS`` keys of ``BAND_ROWS``
minimum hashes each; nodes sharing a key meet. A pair of similarity J shares one with probability
1 - (1 - J^6)^20: 0.998 at 0.80, over 0.9999 at 0.87. Every candidate pair is checked by the exact similarity of its
shingle sets, and only pairs that pass become edges of components.

Checking goes in rounds, so that a large group of copies, or of texts that share a common passage, costs its rows and
not its pairs. First each node of a key meets the key's smallest node. Then the nodes of keys that are still in several
components are joined by their rarest shingles (prefix filter): of the shingles that a set shares with other components, in an
order common to all, two sets that must have o in common share one among all but the last o - 1 of each.

Sets of one large group, variants of one text, can have nearly all of their shingles in common without being links, so that even
their rarest ones are held by most of the group. So nodes that share such a shingle form a family, and each set x is
replaced by its difference D to the family's core, the shingles of over half of its members. With c = (1-s)/(1+s), x and y are
s similar just if their differences differ by at most c(|x|+|y|), so with slack = |D| - c|x|
* where two slacks sum to 0 or less, both are links of the family's member of least slack: such links make a star;
* all other links hold at least (slack + slack)/2 elements of their differences in common, and a second prefix filter over
  these, rare within the family, finds them. Elements that only one component has count for nothing, and an element's holders
  whose slacks exceed what the others can share leave before they are joined.
Any core gives whole results; an empty one is the plain filter again. Where a family has no common core (texts chained by shingles of
different parts), its large groups can still cost pairs. No link is lost, and pairs inside one component, which change nothing, are left unread.

Edge cases: a null or blank text is a node without shingles, equal only to itself; a text of five words or
fewer has itself as its one shingle; ids may be null or repeated, since nodes go by text; of a group the smallest
id stays (null ids last, then the smaller SHA-256 of the text), one row of it; other columns are kept; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blank_if_null, named, stored
from .components import connected_components
from .exact_dedup import keep_keys, row_key
from .simhash import BUDGET, SEED, hamming_links

SHINGLE = 5
LEAST = 0.8
BANDS, BAND_ROWS = 20, 6
_MIX = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS * BAND_ROWS, 1), dtype=np.uint64)
_FLIP, _ODD = _MIX[0], _MIX[1] | np.uint64(1)
_PIECE, _WIDE = 1 << 15, 512


def shingle_hashes(words: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 values of a text's shingles, in order."""
    text = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(text, SEED)] if words else [], dtype=np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-shingle]))
    stops = ends[shingle - 1 :] - 1
    pieces = [zip(starts[at : at + _PIECE].tolist(), stops[at : at + _PIECE].tolist(), strict=True) for at in range(0, len(starts), _PIECE)]
    return np.concatenate([np.array([digest(text[a:b], SEED) for a, b in piece], dtype=np.uint64) for piece in pieces])


def majority(values: np.ndarray) -> int:
    """The SimHash of shingle hashes."""
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(values), _PIECE):
        votes += np.unpackbits(values[at : at + _PIECE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(values), bitorder="little").view(np.uint64)[0])


def band_keys(values: np.ndarray) -> np.ndarray:
    """The signed keys of a text's bands; none without shingles."""
    if not len(values):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * BAND_ROWS, (1 << 64) - 1, dtype=np.uint64)
    for at in range(0, len(values), _WIDE):
        np.minimum(least, ((values[at : at + _WIDE] ^ _FLIP) * _ODD).min(axis=1), out=least)
    rows = least.reshape(BANDS, BAND_ROWS)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), i) for i, r in enumerate(rows)], dtype=np.uint64).view(np.int64)


def _words(raw: pa.Scalar) -> list[bytes]:
    return raw.as_py().lower().split()  # of bytes: A-Z only, and exactly the six blanks


def _node(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _marks(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, prints, keys = [], [], []
        for raw in batch.column("raw"):
            words = _words(raw)
            values = shingle_hashes(words, shingle)
            nodes.append(_node(words))
            prints.append(majority(values))
            keys.append(band_keys(values))
        columns = [batch.column("id"), batch.column("said"), pa.array(nodes, pa.binary()), pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(keys, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "said", "node", "fp", "keys"])


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.unique(shingle_hashes(_words(raw), shingle)).tobytes() for raw in batch.column("raw")]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "grams"])


def _similar(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("left"), batch.column("right"), strict=True):
            x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
            small, large = sorted((len(x), len(y)))
            common = 2 * large if small < least * large else len(np.intersect1d(x, y, assume_unique=True))
            keep.append(large > 0 and small >= least * large and common >= least * (small + large - common))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, least: float = LEAST, budget: int = BUDGET) -> DataFrame:
    """docs with one row of each group of texts linked by a similarity of `least` or more, all columns kept."""
    kind = docs.schema[id_col].dataType.simpleString()
    raw, said = blank_if_null(text_col).cast("binary").alias("raw"), F.sha2(blank_if_null(text_col), 256)
    rows = docs.select(named(id_col).alias("id"), said.alias("said"), raw)
    marks = stored(rows.mapInArrow(lambda batches: _marks(batches, shingle), f"id {kind}, said string, node binary, fp long, keys array<long>"), "near_marks")

    keyed = stored(marks.where(F.size("keys") > 0).select("node", F.explode("keys").alias("key")).distinct(), "near_keys")
    shared = keyed.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("tail")).where("head <> tail").select("key", "head")
    members = stored(keyed.join(shared, "key"), "near_members")
    heads = marks.where(F.size("keys") > 0).groupBy("fp").agg(F.min("node").alias("head"))
    same = marks.where(F.size("keys") > 0).select("fp", "node").join(heads, "fp").select("node", "head")
    close = hamming_links(marks.where(F.size("keys") > 0), budget)
    linked = close.join(heads.select(F.col("fp").alias("a"), F.col("head").alias("node")), "a").join(heads.select(F.col("fp").alias("b"), "head"), "b").select("node", "head")
    first = _pairs(members.select("node", "head").union(same).union(linked))
    first = stored(first, "near_pairs")

    #: Shingle sets of the nodes that can be in a pair, one for each node.
    wanted = members.select("node").union(first.select("a")).union(first.select("b")).distinct()
    one = marks.join(wanted, "node", "left_semi").groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("z"), "id", "said")).alias("best"))
    one = one.select("node", row_key(F.col("best.id"), F.col("best.said")).alias("__key"))
    texts = rows.select(row_key(F.col("id"), F.col("said")).alias("__key"), "raw").join(one, "__key").dropDuplicates(["__key"]).select("node", "raw")  # equal rows share a key
    grams = stored(texts.mapInArrow(lambda batches: _sets(batches, shingle), "node binary, grams binary"), "near_sets")

    edges = stored(_checked(first, grams, least), "near_edges")
    found = stored(connected_components(edges), "near_roots")
    rooted = members.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    tops = rooted.where("node = head").select("key", F.col("root").alias("top"))
    several = stored(rooted.join(tops, "key").where(F.col("root") != F.col("top")).select("key").distinct(), "near_rest")
    open_ = stored(rooted.join(several, "key", "left_semi").select("node", "root").distinct(), "near_open")

    apart = differences(grams, open_, least)
    star = stored(_star(apart), "near_star")
    sure = stored(_checked(_pairs(star.select("node", "top")), grams, least), "near_edges")
    rest = rare_pairs(apart.select("node", "grams"), _relabelled(apart, star, sure), least).join(first, ["a", "b"], "left_anti")
    #: The first components' stars hold all that their edges said.
    edges = found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(sure).union(_checked(rest, grams, least))

    roots = connected_components(edges)
    placed = marks.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    best = placed.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("z"), "id", "said")).alias("best"))
    return keep_keys(docs, row_key(named(id_col), said), best.select(row_key(F.col("best.id"), F.col("best.said"))))


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches with their last column, grams, as lists, some rows at a time."""
    for batch in batches:
        sets, start, held = [], 0, 0
        for i, grams in enumerate(batch.column("grams")):
            sets.append(np.frombuffer(grams.as_buffer(), dtype=np.int64))
            held += len(sets[-1])
            if held >= _PIECE or i + 1 == batch.num_rows:
                ends = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([*batch.slice(start, len(sets)).columns[:-1], lists], names=batch.schema.names)
                sets, start, held = [], i + 1, 0


def _exploded(sets: DataFrame) -> DataFrame:
    """A row for each element of a set, gram, beside the other columns."""
    kept = [c for c in sets.columns if c != "grams"]
    schema = T.StructType([*(sets.schema[c] for c in kept), T.StructField("grams", T.ArrayType(T.LongType()))])
    return sets.select(*kept, "grams").mapInArrow(_lists, schema).select(*kept, F.explode("grams").alias("gram"))


def _apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = (np.frombuffer(x.as_buffer(), dtype=np.int64) for x in batch.column("grams"))
        cores = (np.array(c.as_py() or [], dtype=np.int64) for c in batch.column("core"))
        gaps = [np.setxor1d(x, c, assume_unique=True).tobytes() for x, c in zip(sets, cores, strict=True)]
        names = ["node", "root", "family", "size"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(gaps, pa.binary())], names=[*names, "grams"])


#: Slacks are sums of fractions; comparisons of them leave this much room, since whatever passes is checked exactly.
_ROOM = 1e-6


def _size(grams: str = "grams") -> Column:
    return F.expr(f"octet_length({grams}) div 8")


def _needed(slacks: Column) -> Column:
    """How many elements two sets must have in common, from the sum of their slacks."""
    return F.greatest(F.lit(1), F.ceil(slacks / 2 - _ROOM))


def differences(grams: DataFrame, nodes: DataFrame, least: float = LEAST) -> DataFrame:
    """(node, root, family, size, slack, grams): of nodes (node, root) that share a rare shingle with another root, the difference to their family's core."""
    rows = stored(_prefixes(grams, nodes, least), "near_rare")
    heads = rows.groupBy("gram").agg(F.min("node").alias("head"))
    families = connected_components(rows.join(heads, "gram").select(F.col("node").alias("a"), F.col("head").alias("b")))
    families = stored(families.select("node", F.col("root").alias("family")), "near_families")
    sets = stored(grams.join(families, "node").join(nodes, "node").select("node", "root", "family", _size().alias("size"), "grams"), "near_members")
    held = _exploded(sets.select("family", "grams")).groupBy("family", "gram").agg(F.count(F.lit(1)).alias("n"))
    half = families.groupBy("family").agg((F.count(F.lit(1)) / 2).alias("half"))
    #: Of a core, at most twice as many elements as its family's sets have on average.
    cores = held.join(half, "family").where("n > half").groupBy("family").agg(F.collect_list("gram").alias("core"))
    gaps = sets.join(stored(cores, "near_cores"), "family", "left").select("node", "root", "family", "size", "grams", "core")
    gaps = gaps.mapInArrow(_apart, "node binary, root binary, family binary, size long, grams binary")
    return stored(gaps.withColumn("slack", _size() - F.col("size") * ((1 - least) / (1 + least))), "near_apart")


def _star(apart: DataFrame) -> DataFrame:
    """(node, root, top, top_root): nodes and their family's member of least slack, where the two slacks make a link certain."""
    tops = apart.groupBy("family").agg(F.min(F.struct("slack", "node", "root")).alias("top"))
    sure = apart.join(tops, "family").where((F.col("slack") + F.col("top.slack") <= _ROOM) & (F.col("root") != F.col("top.root")))
    return sure.select("node", "root", F.col("top.node").alias("top"), F.col("top.root").alias("top_root"))


def _relabelled(apart: DataFrame, star: DataFrame, sure: DataFrame) -> DataFrame:
    """The nodes of apart, those of roots that star links join under one root; they may be more than components, never less apart."""
    linked = star.withColumn("a", F.least("node", "top")).withColumn("b", F.greatest("node", "top")).join(sure, ["a", "b"], "left_semi")
    names = linked.select("root", "top").union(linked.select("top_root", "top")).groupBy("root").agg(F.min("top").alias("label"))
    return apart.join(stored(names, "near_labels"), "root", "left").select("node", F.coalesce("label", "root").alias("root"), "family", "size", "slack")


def _prefixes(sets: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Rows (family, gram, node, root, size, slack, rank, cap) of sets that a similar set of another root can meet at.

    nodes: node and root; besides, for differences, family, size of the whole set and slack. A whole set is its difference to nothing.
    """
    sets = sets.join(nodes, "node")
    if "slack" in nodes.columns:
        floor = F.col("lo")
    else:
        sets = sets.withColumn("family", F.lit("").cast("binary")).withColumn("size", _size())
        sets = sets.withColumn("slack", F.col("size") * (2 * least / (1 + least)))
        floor = F.col("slack") * least
    tokens = stored(_exploded(sets), "near_tokens")
    several = (F.min("root") != F.max("root")).alias("joins")
    rarity = tokens.groupBy("family", "gram").agg(F.count(F.lit(1)).alias("n"), several, F.min("slack").alias("lo")).where("joins")
    own = Window.partitionBy("node")
    ranked = tokens.join(stored(rarity, "near_rarity"), ["family", "gram"])
    ranked = ranked.withColumn("rank", F.row_number().over(own.orderBy("n", "gram"))).withColumn("cap", F.count(F.lit(1)).over(own))
    ranked = ranked.where(F.col("rank") <= F.col("cap") - _needed(F.col("slack") + F.greatest("lo", floor)) + 1)
    rare = stored(ranked.select("family", "gram", "node", "root", "size", "slack", "rank", "cap"), "near_rare")
    most = 2 * F.col("cap") - F.col("slack")  # the slack that a partner can have
    met = rare.groupBy("family", "gram").agg(several, F.min("slack").alias("lo"), F.max(most).alias("hi")).where("joins")
    fits = (F.col("slack") <= F.col("hi") + _ROOM) & (F.col("lo") <= most + _ROOM)
    return rare.join(stored(met, "near_met"), ["family", "gram"]).where(fits).drop("joins", "lo", "hi")


def rare_pairs(sets: DataFrame, nodes: DataFrame, least: float = LEAST) -> DataFrame:
    """Candidate pairs (a, b), a < b, of nodes of different roots: all that can be `least` similar or more.

    Of differences (see `_prefixes`), all such pairs within a family whose slacks sum to more than 0.
    """
    rows = stored(_prefixes(sets, nodes, least), "near_rare")
    x, y = rows.alias("x"), rows.alias("y")
    need = _needed(F.col("x.slack") + F.col("y.slack"))
    fits = (F.col("x.family") == F.col("y.family")) & (F.col("x.gram") == F.col("y.gram")) & (F.col("x.root") != F.col("y.root")) & (F.col("x.node") < F.col("y.node"))
    for one, other in (("x", "y"), ("y", "x")):
        fits &= (F.col(f"{one}.size") >= F.col(f"{other}.size") * least - _ROOM) & (F.col(f"{one}.rank") <= F.col(f"{one}.cap") - need + 1)
    return _pairs(x.join(y, fits).select(F.col("x.node").alias("p"), F.col("y.node").alias("q")))


def _pairs(links: DataFrame) -> DataFrame:
    """Distinct pairs a < b of the two columns' nodes."""
    x, y = (F.col(c) for c in links.columns)
    return links.where(x != y).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def _checked(pairs: DataFrame, grams: DataFrame, least: float) -> DataFrame:
    left = grams.select(F.col("node").alias("a"), F.col("grams").alias("left"))
    right = grams.select(F.col("node").alias("b"), F.col("grams").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(lambda batches: _similar(batches, least), "a binary, b binary")
