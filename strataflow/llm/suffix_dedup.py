"""Suffix-array dedup: removes bytes covered by strings of MATCH bytes that also start anywhere else.

Which texts can share such a string is settled first. Every window of MATCH bytes names an anchor, the
leftmost of its GRAM-byte strings with the smallest hash, and runs of windows with one anchor are pieces of at
most 2 * MATCH bytes. Equal windows have equal anchors at equal places, so only pieces whose anchor occurs
twice can hold a repeated window, and they are dealt to shards by their anchor: a small row for each piece
is shuffled, and bytes only for pieces that a shard must look at. Pieces that occur twice as they are repeat
as a whole; each is kept once. Anchors only bring pieces together, so that colliding ones cost time; what counts as equal
is told by bytes within a shard, and between shards and rows by 128 bits of BLAKE2, which no known texts share.

Each shard builds a suffix array over its pieces by Larsson-Sadakane refinement in numpy (ranks of the first
eight bytes, doubled on the groups that are still unsorted) and common prefixes of neighbours in text order by
Kasai's carry. The last round sorts by MATCH bytes but leaves the ranks at those of the round before, so it is the
common prefix that decides: a window repeats if its neighbour shares MATCH bytes. An anchor with more than
``shard_pieces`` distinct pieces is spread over several shards; these hand on the digests of their windows in sorted
runs, which meet by digest and are merged by binary search. Nothing is capped or dropped.

A document's cuts and spans are lists in its row, of a few dozen bytes for each piece: they grow with the text beside them.

Edge cases: a null text counts as empty; texts under MATCH bytes lose nothing; matches may overlap, touch or
lie in one document, and never cross documents; rows that repeat an id and text are copies of each other; a
null id is an id; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blank_if_null, named, stored

MATCH = 200
GRAM = 32
#: Bytes of the digests by which pieces and windows of different tasks are told apart.
DIGEST = 16
SHARD_PIECES = 8192
CHUNK_BYTES = 1 << 20
BLOCK = 1 << 20
_RANDOM = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=DIGEST).digest()


def _binary(joined: bytes, n: int) -> pa.Array:
    """n digests in a row as an array of binaries."""
    offsets = np.arange(n + 1, dtype=np.int32) * DIGEST
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(joined)])


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all strings of `gram` bytes (a power of two), by doubling."""
    h, width = _RANDOM[data], 1
    while width < gram:
        h = (h[:-width] * _ODD) ^ (h[width:] >> np.uint64(7)) ^ h[width:]
        width *= 2
    h = h * _ODD
    return h ^ h >> np.uint64(29)


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbouring values, by doubling."""
    out, done = values, 1
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    return np.minimum(out[: len(values) - width + 1], out[width - done : width - done + len(values) - width + 1])


def pieces(data: bytes, match: int = MATCH, gram: int = GRAM, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor hash) of each run of windows with one anchor."""
    starts, counts, anchors = [], [], []
    width = match - gram + 1
    for at in range(0, max(0, len(data) - match + 1), block):
        part = np.frombuffer(data, dtype=np.uint8, count=min(block + match - 1, len(data) - at), offset=at)
        h = _gram_hashes(part, gram)
        keyed = (h & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(h), dtype=np.uint64)
        place = (_window_least(keyed, width) & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        starts.append(first + at)
        counts.append(np.diff(np.r_[first, len(place)]))
        anchors.append(h[place[first]])
    none = np.zeros(0, np.int64)
    return (np.concatenate(starts), np.concatenate(counts), np.concatenate(anchors)) if starts else (none, none, none.astype(np.uint64))


def suffix_ranks(data: np.ndarray, depth: int, asked: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank) of all suffixes by their first `depth` bytes: equal ranks where these are equal.

    Larsson-Sadakane: a suffix's rank is its group's first place in the order. A round at width h sorts the
    members of groups that are still shared by the rank of the suffix h further on. With `asked`, a flag for each
    suffix, the last round puts only those in order, and all ranks stay those of the round before: groups that may be
    equal to `depth`, for common prefixes to tell.
    """
    n = len(data)
    padded = np.r_[data, np.zeros(depth + 8, np.uint8)]
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = key << np.uint64(8) | padded[i : i + n]
    order = np.argsort(key, kind="stable")
    rank = np.zeros(n + depth + 1, np.int64)

    def regroup(places: np.ndarray, fresh: np.ndarray) -> None:
        """Ranks of the suffixes at `places` of the order; fresh: where a group begins."""
        heads = np.maximum.accumulate(np.where(fresh, places, 0))
        rank[order[places]] = heads + 1  # 0 is for what lies behind the end

    ordered = key[order]
    fresh = np.r_[True, ordered[1:] != ordered[:-1]] if n else np.zeros(0, bool)
    regroup(np.arange(n), fresh)
    del key, ordered
    width, places = 8, np.arange(n)
    while width < depth and len(places):
        ahead = min(width, depth - width)
        shared = np.r_[~fresh[1:], False] | ~fresh  # not alone in its group
        if asked is not None and width + ahead >= depth:
            shared &= asked[order[places]]
        places = places[shared]
        if not len(places):
            break
        members = order[places]
        both = rank[members] * np.int64(len(rank) + 1) + rank[members + ahead]
        sort = np.argsort(both)
        order[places] = members[sort]
        width += ahead
        if asked is None or width < depth:
            both = both[sort]
            fresh = np.r_[True, both[1:] != both[:-1]]
            regroup(places, fresh)
    return order, rank[:n]


def common_prefixes(data: bytes, order: np.ndarray, wanted: np.ndarray, most: int) -> np.ndarray:
    """For each wanted suffix, ascending: bytes (up to `most`) shared with its neighbour before it in the order.

    order: sorted suffixes, all or some of the text's. Kasai: going through the text, a suffix shares at most one
    byte less with its neighbour than the suffix before it did, if that one's neighbour goes along.
    """
    place = np.full(len(data), -1, np.int64)
    place[order] = np.arange(len(order))
    before = np.where(place[wanted] > 0, order[np.maximum(place[wanted] - 1, 0)], -2)
    out, carry, last, back = np.zeros(len(wanted), np.int64), 0, -2, -2
    for k, (i, j) in enumerate(zip(wanted.tolist(), before.tolist(), strict=True)):
        carry = max(carry - 1, 0) if i == last + 1 and j == back + 1 else 0
        if j >= 0:
            a, b = data[i + carry : i + most], data[j + carry : j + most]
            if a == b:
                carry += len(a)
            else:
                low, high = 0, min(len(a), len(b))
                while low < high:  # the first difference, by halves
                    middle = (low + high + 1) // 2
                    low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
                carry += low
        out[k], last, back = carry, i, j
    return out


def repeated_windows(chunks: list[bytes], match: int = MATCH) -> list[np.ndarray]:
    """For each piece: which of its windows also start elsewhere in these pieces."""
    data = b"".join(chunks)
    sizes = np.array([len(c) for c in chunks])
    ends = np.cumsum(sizes)
    is_window = np.zeros(len(data), bool)
    for end, size in zip(ends.tolist(), sizes.tolist(), strict=True):
        is_window[end - size : end - match + 1] = True
    order, rank = suffix_ranks(np.frombuffer(data, np.uint8), match, is_window)
    windows = order[is_window[order]]  # bytes of a piece's tail that begin no window of it don't count
    same = np.flatnonzero(rank[windows[1:]] == rank[windows[:-1]])  # candidates: the bytes they share beyond the last ranks decide
    told = np.zeros(len(data), bool)
    if len(same):
        wanted = np.sort(windows[same + 1])
        hit = wanted[common_prefixes(data, windows, wanted, match) >= match]
        place = np.zeros(len(data), np.int64)
        place[windows] = np.arange(len(windows))
        told[hit] = told[windows[place[hit] - 1]] = True
    return [told[end - size : end - match + 1] for end, size in zip(ends.tolist(), sizes.tolist(), strict=True)]


def _ranges(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    yield from zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)


def _batch(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema, strict=True)], names=[n for n, _ in schema])


def _anchors(batches: Iterator[pa.RecordBatch], match: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc, tag, raw in zip(batch.column("id").to_pylist(), batch.column("tag").to_pylist(), batch.column("raw"), strict=True):
            data = raw.as_py()
            start, count, anchor = pieces(data, match, gram)
            if not len(start):
                continue
            prints = b"".join([_digest(data[a:b]) for a, b in zip(start.tolist(), (start + count + (match - 1)).tolist(), strict=True)])
            n = len(start)
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc] * n, pa.int64()), pa.array(np.full(n, tag, np.int64)), pa.array(start), pa.array(count.astype(np.int32)), pa.array(anchor.view(np.int64)), _binary(prints, n)],
                names=["id", "tag", "start", "windows", "anchor", "piece"],
            )


def _anchor_hashes(batches: Iterator[pa.RecordBatch], match: int, gram: int) -> Iterator[pa.RecordBatch]:
    """The anchors alone, for counting."""
    for batch in batches:
        found = [pieces(raw.as_py(), match, gram)[2] for raw in batch.column("raw")]
        hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], names=["anchor"])


_SHARD = [("anchor", pa.int64()), ("piece", pa.binary()), ("begin", pa.int32()), ("stop", pa.int32()), ("shard", pa.int32()), ("key", pa.binary())]


def _shards(batches: Iterator[pa.RecordBatch], match: int, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows (anchor, shard, shards, piece, raw) sorted by anchor and shard: marks, and keys of shared anchors' windows."""
    held: list[tuple[int, int, int, bytes, bytes]] = []
    size = 0

    def solve(rows: list[tuple[int, int, int, bytes, bytes]]) -> pa.RecordBatch:
        unique = list({(a, p): r for r in rows for a, p in [(r[0], r[3])]}.values())
        out: list[tuple] = []
        for (anchor, shard, shards, piece, raw), flags in zip(unique, repeated_windows([r[4] for r in unique], match), strict=True):
            out += [(anchor, piece, a, b, shard, None) for a, b in _ranges(flags)]
            if shards > 1:
                out += [(anchor, piece, i, i + 1, shard, _digest(raw[i : i + match])) for i in range(len(flags))]
        return _batch(out, _SHARD)

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "shard", "shards", "piece", "raw")), strict=True):
            if size >= chunk_bytes and (row[0], row[1]) != held[-1][:2]:
                yield solve(held)
                held, size = [], 0
            held.append(row)
            size += len(row[4])
    if held:
        yield solve(held)


def _merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (anchor, part, shard, key, piece, begin) sorted so: marks of windows whose key another shard's run holds."""
    fields = ("anchor", "part", "shard", "key", "piece", "begin")
    held: list[np.ndarray] | None = None

    def solve(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        anchor, part, shard, key, piece, begin = rows
        hit = np.zeros(len(key), bool)
        cut = np.flatnonzero(np.r_[True, (np.diff(anchor) != 0) | (np.diff(part) != 0)])
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(key)], strict=True):
            runs = np.flatnonzero(np.r_[True, np.diff(shard[a:b]) != 0]) + a
            merged, owner = np.zeros(0, key.dtype), np.zeros(0, np.int64)
            for c, d in zip(runs.tolist(), [*runs[1:].tolist(), b], strict=True):
                own, at = np.unique(key[c:d], return_index=True)
                place = np.searchsorted(merged, own)
                found = (place < len(merged)) & (merged[np.minimum(place, max(len(merged) - 1, 0))] == own) if len(merged) else np.zeros(len(own), bool)
                hit[owner[place[found]]] = True
                hit[c:d] |= np.isin(key[c:d], own[found])
                merged = np.insert(merged, place[~found], own[~found])
                owner = np.insert(owner, place[~found], (at + c)[~found])
            hot = np.unique(key[a:b][hit[a:b]])
            hit[a:b] |= np.isin(key[a:b], hot)
        whole = (p.ljust(DIGEST, b"\0") for p in piece[hit].tolist())  # numpy leaves out trailing zeros
        rows = [(x, p, s, s + 1) for x, p, s in zip(anchor[hit].tolist(), whole, begin[hit].tolist(), strict=True)]
        yield _batch(rows, [("anchor", pa.int64()), ("piece", pa.binary()), ("begin", pa.int32()), ("stop", pa.int32())])

    for batch in batches:
        now = [batch.column(f).to_numpy(zero_copy_only=False) for f in fields]
        now = [x.astype(f"S{DIGEST}") if f in ("key", "piece") else x for x, f in zip(now, fields, strict=True)]
        held = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
        last = np.flatnonzero((np.diff(held[0]) != 0) | (np.diff(held[1]) != 0)) if len(held[0]) > 1 << 17 else []
        if len(last):
            end = last[-1] + 1
            yield from solve([x[:end] for x in held])
            held = [x[end:] for x in held]
    if held is not None and len(held[0]):
        yield from solve(held)


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tool = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = pa.array([tool.compress(x.as_py()) for x in batch.column("raw")], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("tag"), packed], names=["id", "tag", "packed"])


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def repeated_spans(docs: DataFrame, match: int = MATCH, gram: int = GRAM, shard_pieces: int = SHARD_PIECES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """docs (id, tag, raw) -> (id, tag, spans): byte ranges, not yet merged, of each document that has any."""
    schema = "id long, tag long, start long, windows int, anchor long, piece binary"
    found = docs.mapInArrow(lambda b: _anchors(b, match, gram), schema)
    counted = docs.select("raw").mapInArrow(lambda b: _anchor_hashes(b, match, gram), "anchor long")
    twice = stored(counted.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "anchors")
    live = stored(found.join(twice, "anchor", "left_semi"), "pieces")
    where = F.struct("id", "tag", "start", "windows")
    kinds = stored(live.groupBy("anchor", "piece").agg(F.count(F.lit(1)).alias("n"), F.min(where).alias("at")), "kinds")
    # tables of anchors and ranges are stored, so that the joins with them have exchanges of their own, whose large partitions can be split
    several = stored(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("fewest")).where("kinds > 1 AND fewest = 1"), "several")
    shards = F.ceil(F.col("kinds") / shard_pieces).cast("int")
    cut = F.struct("anchor", F.pmod(F.xxhash64("piece"), F.col("shards")).cast("int").alias("shard"), "shards", "piece", F.col("at.start").alias("start"), F.col("at.windows").alias("windows"))
    wanted = kinds.join(several.withColumn("shards", shards), "anchor").groupBy(F.col("at.id").alias("i"), F.col("at.tag").alias("t")).agg(F.collect_list(cut).alias("cuts"))
    packed = docs.mapInArrow(_compress, "id long, tag long, packed binary")

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor()
        names = [("anchor", pa.int64()), ("shard", pa.int32()), ("shards", pa.int32()), ("piece", pa.binary()), ("raw", pa.binary())]
        for batch in batches:
            for z, cuts in zip(batch.column("packed"), batch.column("cuts").to_pylist(), strict=True):
                data = tool.decompress(z.as_py())
                yield _batch([(c["anchor"], c["shard"], c["shards"], c["piece"], data[c["start"] : c["start"] + c["windows"] + match - 1]) for c in cuts], names)

    bytes_of = packed.join(wanted, F.col("id").eqNullSafe(F.col("i")) & (F.col("tag") == F.col("t"))).select("packed", "cuts").mapInArrow(slices, "anchor long, shard int, shards int, piece binary, raw binary")
    ranked = bytes_of.repartition("anchor", "shard").sortWithinPartitions("anchor", "shard").mapInArrow(lambda b: _shards(b, match, chunk_bytes), "anchor long, piece binary, begin int, stop int, shard int, key binary")
    ranked = stored(ranked, "shards")
    runs = ranked.where("key IS NOT NULL").withColumn("part", F.pmod(F.xxhash64("key"), F.lit(64)).cast("int"))
    merged = runs.repartition("anchor", "part").sortWithinPartitions("anchor", "part", "shard", "key").select("anchor", "part", "shard", "key", "piece", "begin").mapInArrow(_merge_runs, "anchor long, piece binary, begin int, stop int")
    whole = kinds.where("n > 1").select("anchor", "piece", F.lit(0).alias("begin"), F.col("at.windows").alias("stop"))
    marks = whole.union(ranked.where("key IS NULL").select("anchor", "piece", "begin", "stop")).union(merged)
    ranges = marks.groupBy("anchor", "piece").agg(F.collect_set(F.struct("begin", "stop")).alias("ranges"))  # at most one for each window
    ranges = stored(ranges, "ranges")
    spots = live.join(ranges, ["anchor", "piece"]).select("id", "tag", F.explode("ranges").alias("r"), "start")
    # A set: rows that repeat an id and text have the same spans, which all of them meet below.
    return spots.groupBy("id", "tag").agg(F.collect_set(F.struct((F.col("start") + F.col("r.begin")).alias("a"), (F.col("start") + F.col("r.stop") + (match - 1)).alias("b"))).alias("spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", match: int = MATCH, gram: int = GRAM, shard_pieces: int = SHARD_PIECES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per row of docs: id, n_bytes, n_removed, n_spans, kept_sha256, spans (array of byte ranges)."""
    raw = blank_if_null(text_col).cast("binary")
    rows = docs.select(named(id_col).cast("long").alias("id"), F.xxhash64(blank_if_null(text_col)).alias("tag"), raw.alias("raw"))
    spans = repeated_spans(rows, match, gram, shard_pieces, chunk_bytes).select(F.col("id").alias("i"), F.col("tag").alias("t"), "spans")
    joined = rows.mapInArrow(_compress, "id long, tag long, packed binary").join(spans, F.col("id").eqNullSafe(F.col("i")) & (F.col("tag") == F.col("t")), "left")
    names = [("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.list_(pa.int64())))]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for doc, z, found in zip(batch.column("id").to_pylist(), batch.column("packed"), batch.column("spans").to_pylist(), strict=True):
                data = tool.decompress(z.as_py())
                merged = merge_spans([(s["a"], s["b"]) for s in found or []])
                kept, at = hashlib.sha256(), 0
                for a, b in merged:
                    kept.update(data[at:a])
                    at = b
                kept.update(data[at:])
                out.append((doc, len(data), sum(b - a for a, b in merged), len(merged), kept.hexdigest(), [list(m) for m in merged]))
            yield _batch(out, names)

    done = joined.select("id", "packed", "spans").mapInArrow(finish, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>")
    return done.withColumnRenamed("id", id_col)
