"""Audit of how sources of a language differ in their terms: kept terms by iceberg prefix refinement, then exact divergences.

Terms. A language keeps the terms that at least `least` of its documents have. They are found by prefixes of bytes, level by level:
a level counts, for each prefix that extends a survivor of the level before, the distinct documents with a term that begins so, and
discards those below `least`; a term that ends within the prefix is counted as itself and is complete. Each level's prefixes are
twice as long, and levels go on until no incomplete prefix is left. No term can be lost, since a term's documents are among those of
each of its prefixes.

A level is one pass over the documents. Inside an Arrow batch terms are cut with array operations, a document's prefixes are made
distinct, and counts leave as one row per (language, prefix); Spark adds them up. Counts of batches add, since a document is in one.
Survivors come back to the next pass as a filter of FILTER_BITS bits, a bound that doesn't depend on the data: what it lacks was
discarded, and what it lets in by chance is counted and discarded by its own count. So results don't depend on it.

Divergences. With the kept terms' counts of each (language, source), terms that a source exceeds its language in are ranked by window
functions. Sources are compared in tiles: the terms of a language in slices by hash, its sources in blocks, so that a tile is
bounded. A tile fills in the share that an absent term has, and sums go out per pair of sources; terms that neither block has
come in by their number. All arithmetic is on whole numbers: shares below 2**31, their squares below 2**63.

Edge cases: null text, language or source counts as blank; a row is a document, so rows that repeat an id count each; documents
without terms, and groups of them, keep their place in the pairs; a language that keeps no term gives pairs of value 0. Texts are cut
in runs of documents and pieces between terms, so a very long one takes no more room than its distinct terms and a piece. Other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blank_if_null, stored

#: Bytes of the first level's prefixes; each level doubles them.
FIRST = 6
#: Bits of the filter that carries survivors to the next pass: 4 MB.
FILTER_BITS = 1 << 25
#: Bytes of text cut at once, sources of a block, rows of a slice of terms, terms compared at once.
PIECE = 8 << 20
BLOCK = 1024
SLICE_ROWS = 200_000
AT_ONCE = 2048
#: The scale of a share, and what is added to each count.
SCALE, ADDED = 1_000_000_000, 2
_BYTES = np.arange(256, dtype=np.uint8)
#: Bytes of terms: all beyond ASCII, and letters; A-Z are lower-cased.
IN_TERM = (_BYTES >= 0x80) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A))
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
#: Seed of Spark's xxhash64.
_SEED = 42


# Terms of a batch


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of documents of about PIECE bytes; a longer document is a run of its own."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def _pieces(data: np.ndarray, at: int, end: int) -> Iterator[tuple[int, int]]:
    """Ranges of about PIECE bytes of data[at:end] that end outside a term."""
    while at < end:
        stop = min(at + PIECE, end)
        while stop < end and IN_TERM[data[stop]]:
            outside = np.flatnonzero(~IN_TERM[data[stop : min(stop + 4096, end)]])
            stop = stop + int(outside[0]) if len(outside) else min(stop + 4096, end)
        yield at, stop
        at = stop


def _cut(part: np.ndarray, over: int = 0) -> tuple[np.ndarray, pa.Array]:
    """(first byte, term) of each term in part of more than `over` bytes; terms lower-cased."""
    inside = np.zeros(len(part) + 2, bool)
    np.take(IN_TERM, part, out=inside[1:-1])
    borders = np.flatnonzero(inside[1:] != inside[:-1])  # where a term begins and ends, by turns
    first, sizes = borders[::2], borders[1::2] - borders[::2]
    data = part[inside[1:-1]]
    if over:
        long = sizes > over
        data, first, sizes = data[np.repeat(long, sizes)], first[long], sizes[long]
    bounds = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=bounds[1:])
    return first, pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(LOWER[data])])


def incidences(texts: pa.Array, over: int = 0) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct terms, document, term's place, occurrences) of each distinct pair of document and term of more than `over` bytes.

    Each text must end outside a term, so that none goes on into the next.
    """
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if len(texts) and texts.buffers()[2] is not None and offsets[-1] else np.zeros(0, np.uint8)
    names, docs, codes, counts = [], [], [], []
    for at, stop in _pieces(data, int(offsets[0]), int(offsets[-1])):
        first, terms = _cut(data[at:stop], over)
        doc = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(first, offsets.astype(np.int64) - at)))
        coded = terms.dictionary_encode()
        n = max(len(coded.dictionary), 1)
        pair, count = np.unique(doc * n + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
        names.append(coded.dictionary)
        docs.append(pair // n)
        codes.append(pair % n)
        counts.append(count)
    if not names:
        none = np.zeros(0, np.int64)
        return pa.array([], pa.binary()), none, none, none
    if len(names) == 1:
        return names[0], docs[0], codes[0], counts[0]
    every = pa.concat_arrays(names).dictionary_encode()
    of_all, before = every.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum([0, *map(len, names)])
    doc, code, count = np.concatenate(docs), np.concatenate([of_all[c + b] for c, b in zip(codes, before, strict=False)]), np.concatenate(counts)
    pair, count = _summed(doc * len(every.dictionary) + code, count)  # a document may be in several pieces
    return every.dictionary, pair // len(every.dictionary), pair % len(every.dictionary), count


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(values, first)


# Filters


def filter_of(rows: DataFrame) -> np.ndarray:
    """The bits of all (lang, prefix) of rows: built as bitmaps of 4 KB by Spark, FILTER_BITS / 8 bytes in all."""
    # A bit's place is xxhash64 of both; that is signed here, but FILTER_BITS divides 2**64, so the remainder is that of the unsigned value.
    bit = F.pmod(F.xxhash64("lang", "prefix"), F.lit(FILTER_BITS).cast("bigint")) + 1
    maps = rows.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in maps.collect():  # FILTER_BITS / 32768 rows at most
        part = np.frombuffer(r.bits, np.uint8)
        at = (r.bucket - 1) * len(part)
        out[at : at + len(part)] = part[: len(out) - at]
    return out


def _passing(bits: np.ndarray, langs: list[str], lang: np.ndarray, prefixes: pa.Array, code: np.ndarray) -> np.ndarray:
    """Which of the (language, prefix) pairs a filter has."""
    n = max(len(prefixes), 1)
    pair, back = np.unique(lang * n + code, return_inverse=True)
    seeds, names = [xxhash.xxh64_intdigest(x.encode(), _SEED) for x in langs], prefixes.to_pylist()
    digest = xxhash.xxh64_intdigest
    size = 8 * len(bits)
    at = np.fromiter((digest(names[k % n], seeds[k // n]) % size for k in pair.tolist()), np.int64, len(pair))
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)[back]


def _places(coded: pa.DictionaryArray) -> np.ndarray:
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _coded(column: pa.Array) -> tuple[list[str], np.ndarray]:
    coded = column.dictionary_encode()
    return coded.dictionary.to_pylist(), _places(coded)


# Passes over the documents


def _plain(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """text, closed by a line end, lang and source, nulls as blanks."""
    return docs.select(F.concat(blank_if_null(text_col), F.lit("\n")).alias("text"), blank_if_null(lang_col).alias("lang"), blank_if_null(source_col).alias("source"))


def level(docs: DataFrame, done: int, length: int, survivors) -> DataFrame:
    """(lang, prefix, whole, docs): in how many documents a term begins with a prefix of `length` bytes, or is it (whole).

    Only terms of more than `done` bytes whose first `done` bytes the broadcast filter `survivors` has. Rows of a batch; sums are
    the caller's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = survivors.value if survivors is not None else None
        for batch in (part for whole in batches for part in _parts(whole)):
            terms, doc, code, _ = incidences(batch.column("text"), done)
            langs, lang_of = _coded(batch.column("lang"))
            size = pc.binary_length(terms).to_numpy(zero_copy_only=False)
            prefixes = pc.binary_slice(terms, 0, length).dictionary_encode()
            candidate = _places(prefixes) * 2 + (size <= length)  # of each term: its prefix, and whether it is all of it
            if bits is not None:
                parents = pc.binary_slice(terms, 0, done).dictionary_encode()
                good = _passing(bits, langs, lang_of[doc], parents.dictionary, _places(parents)[code])
                doc, code = doc[good], code[good]
            n = 2 * max(len(prefixes.dictionary), 1)
            pair = np.unique(doc * n + candidate[code])  # a document counts once for a prefix
            group, docs_with = np.unique(lang_of[pair // n] * n + pair % n, return_counts=True)
            yield pa.RecordBatch.from_arrays([
                pa.array(langs, pa.string()).take(pa.array(group // n)), prefixes.dictionary.take(pa.array(group % n // 2)), pa.array(group % 2 == 1), pa.array(docs_with, pa.int64()),
            ], names=["lang", "prefix", "whole", "docs"])

    return docs.select("text", "lang").mapInArrow(run, "lang string, prefix binary, whole boolean, docs long")


def kept_terms(docs: DataFrame, least: int = 10, first: int = FIRST) -> DataFrame:
    """(lang, prefix, docs): the terms, as bytes, that at least `least` documents of a language have. docs: text, lang."""
    spark = docs.sparkSession
    done, length, survivors, kept = 0, first, None, None
    while True:
        found = level(docs, done, length, survivors).groupBy("lang", "prefix", "whole").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least)
        found = stored(found, "prefixes")
        complete = found.where("whole").drop("whole")
        kept = complete if kept is None else kept.unionByName(complete)
        going_on = found.where("NOT whole")
        if survivors is not None:
            survivors.unpersist()
        if going_on.isEmpty():
            return kept
        survivors = spark.sparkContext.broadcast(filter_of(going_on))
        done, length = length, 2 * length


def occurrences(docs: DataFrame, kept: DataFrame, least: int) -> DataFrame:
    """(lang, source, prefix, n, of_lang) of the kept terms: occurrences, above 0, in the group and in its language.

    What the filter lets in by chance goes by its own count of documents, which come along. A batch sends one row for a group
    and term, dealt by language and term once for all sums.
    """
    bits = docs.sparkSession.sparkContext.broadcast(filter_of(kept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            langs, lang_of_all = _coded(whole.column("lang"))
            sources, source_of_all = _coded(whole.column("source"))
            group_of_all, at = lang_of_all * max(len(sources), 1) + source_of_all, 0
            names, groups, codes, counts, docs_with = [], [], [], [], []
            for batch in _parts(whole):
                terms, doc, code, count = incidences(batch.column("text"))
                group, lang = group_of_all[at : at + len(batch)][doc], lang_of_all[at : at + len(batch)][doc]
                at += len(batch)
                good = _passing(bits.value, langs, lang, terms, code)
                group, code, count = group[good], code[good], count[good]
                n = max(len(terms), 1)
                pair, total = _summed(group * n + code, np.stack([count, np.ones_like(count)], axis=1))
                used, code = np.unique(pair % n, return_inverse=True)
                names.append(terms.take(pa.array(used)))
                groups.append(pair // n)
                codes.append(code + sum(map(len, names[:-1])))
                counts.append(total[:, 0])
                docs_with.append(total[:, 1])
            if not names:
                continue
            every = pa.concat_arrays(names).dictionary_encode()
            n = max(len(every.dictionary), 1)
            pair, total = _summed(np.concatenate(groups) * n + _places(every)[np.concatenate(codes)], np.stack([np.concatenate(counts), np.concatenate(docs_with)], axis=1))
            group, m = pair // n, max(len(sources), 1)
            yield pa.RecordBatch.from_arrays([
                pa.array(langs, pa.string()).take(pa.array(group // m)), pa.array(sources, pa.string()).take(pa.array(group % m)), every.dictionary.take(pa.array(pair % n)), pa.array(total[:, 0]), pa.array(total[:, 1]),
            ], names=["lang", "source", "prefix", "n", "docs"])

    rows = docs.mapInArrow(run, "lang string, source string, prefix binary, n long, docs long").repartition("lang", "prefix")
    counted = rows.groupBy("lang", "prefix", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "prefix")
    summed = counted.withColumns({"of_lang": F.sum("n").over(of_term), "docs": F.sum("docs").over(of_term)})
    return summed.where(F.col("docs") >= least).select("lang", "source", "prefix", "n", "of_lang")


# Divergences


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + ADDED) / (total + ADDED * terms)), exactly; null without terms."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (n + ADDED).cast("decimal(19,0)")
    below = F.nullif(total + ADDED * terms, F.lit(0)).cast("decimal(19,0)")
    return F.call_function("div", top, below) + 1


def apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q))."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _tile(terms: pa.Table, groups: pa.Table) -> pa.Table:
    """(lang, i, j, value, n): sums over the terms that either block has, for i of one block and j > i of the other."""
    out = {"lang": [], "i": [], "j": [], "value": [], "n": []}
    if terms.num_rows:
        place, absent, block = (groups.column(c).to_numpy() for c in ("place", "absent", "block"))
        order = np.argsort(place)
        place, absent, block = place[order], absent[order], block[order]
        bi, bj = groups.column("bi")[0].as_py(), groups.column("bj")[0].as_py()
        left, right = np.flatnonzero(block == bi), np.flatnonzero(block == bj)
        code = terms.column("prefix").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        row = np.argsort(code, kind="stable")
        code, column, p = code[row], np.searchsorted(place, terms.column("place").to_numpy()[row]), terms.column("p").to_numpy()[row]
        n = int(code[-1]) + 1
        sums = np.zeros((len(place), len(place)), np.int64)
        for at in range(0, n, AT_ONCE):
            some = slice(*np.searchsorted(code, [at, at + AT_ONCE]))
            grid = np.tile(absent, (min(AT_ONCE, n - at), 1))
            grid[code[some] - at, column[some]] = p[some]
            for i in left:
                js = right[right > i]
                mine, theirs = grid[:, i : i + 1], grid[:, js]
                sums[i, js] += ((mine - theirs) ** 2 // (mine + theirs)).sum(axis=0)
        for i in left:
            js = right[right > i]
            out["i"] += [int(place[i])] * len(js)
            out["j"] += place[js].tolist()
            out["value"] += sums[i, js].tolist()
        out["lang"], out["n"] = [groups.column("lang")[0].as_py()] * len(out["i"]), [n] * len(out["i"])
    return pa.table({"lang": pa.array(out["lang"], pa.string())} | {c: pa.array(out[c], pa.int64()) for c in ("i", "j", "value", "n")})


def pair_values(shares: DataFrame, groups: DataFrame, slices: int) -> DataFrame:
    """(lang, source, item, value) for each two sources of a language.

    shares (lang, prefix, place, block, p) of terms that are there; groups (lang, source, place, block, blocks, absent, terms).
    """
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = lambda df: df.select("*", other.alias("other")).withColumns({"bi": F.least("block", "other"), "bj": F.greatest("block", "other")}).drop("other", "blocks")
    keys = ["lang", "bi", "bj", "slice"]
    left = dealt(shares.select(*[F.col(c).alias(c) for c in shares.columns])).withColumn("slice", F.pmod(F.xxhash64("prefix"), F.lit(slices)).cast("int"))
    right = dealt(groups.where(F.col("absent").isNotNull()).drop("source", "terms")).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    sums = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_tile, "lang string, i long, j long, value long, n long").groupBy("lang", "i", "j").agg(F.sum("value").alias("value"), F.sum("n").alias("n"))
    mine = groups.select("lang", "source", "place", "absent", "terms")
    theirs = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("__place"), F.col("absent").alias("__absent"))
    pairs = mine.join(theirs, "lang").where(F.col("place") != F.col("__place")).withColumns({"i": F.least("place", "__place"), "j": F.greatest("place", "__place")})
    rest = (F.col("terms") - F.coalesce("n", F.lit(0))) * apart(F.col("absent"), F.col("__absent"))
    value = F.coalesce("value", F.lit(0)) + F.coalesce(rest, F.lit(0))
    return pairs.join(sums, ["lang", "i", "j"], "left").select("lang", "source", "item", value.alias("value"))


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = 10, ranks: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): `pair` rows for all other sources of the language, `term` rows up to `ranks`."""
    plain = _plain(docs, text_col, lang_col, source_col)
    kept = kept_terms(plain, least)
    counts = stored(occurrences(plain, kept, least), "occurrences")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    every = plain.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(of_lang, "lang", "left").join(sizes, "lang", "left").na.fill(0, ["total", "lang_total", "terms"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("bigint") - 1  # a language's sources, which pairs square
    absent = share(F.lit(0), F.col("total"), F.col("terms"))
    groups = stored(every.withColumn("place", place).withColumns({"absent": absent, "block": F.expr(f"place div {BLOCK}").cast("int"), "sources": F.count(F.lit(1)).over(Window.partitionBy("lang"))}).withColumn("blocks", F.expr(f"(sources - 1) div {BLOCK} + 1").cast("int")).drop("sources"), "groups")
    # Ranked terms
    p = share(F.col("n"), F.col("total"), F.col("terms"))
    shares = counts.join(groups, ["lang", "source"]).withColumn("p", p)
    q = share(F.col("of_lang"), F.col("lang_total"), F.col("terms"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = shares.withColumn("q", q).where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("prefix").cast("string").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= ranks)
    # Pairs of sources
    slices = max(1, -(-counts.count() // SLICE_ROWS))
    pairs = pair_values(shares.select("lang", "prefix", "place", "block", "blocks", "p"), groups.drop("total", "lang_total"), slices)
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(best))
    return pairs.unionByName(terms)


ORACLE = r"""WITH d AS (SELECT row_number() OVER () AS i, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
t AS (SELECT i, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY 1, 2 HAVING count(DISTINCT i) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
g AS (SELECT lang, source, coalesce((SELECT sum(n) FROM c WHERE c.lang = x.lang AND c.source = x.source), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) x),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * v.v) AS p
  FROM g JOIN kept ON kept.lang = g.lang JOIN v ON v.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
l AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 2)) // ((SELECT sum(total) FROM g WHERE g.lang = p.lang) + 2 * (SELECT v FROM v WHERE v.lang = p.lang)) AS q FROM p GROUP BY 1, 2),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST(((p.p - l.q) * (p.p - l.q)) // (p.p + l.q) AS BIGINT) AS value FROM p JOIN l USING (lang, term) WHERE p.n > 0 AND p.p > l.q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10"""
