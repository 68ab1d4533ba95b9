"""Document fingerprints by winnowing.

A text's words are hashed, and in place of a word of more than CUT characters all its runs of PART characters, one from
each place, so that text without white space has words that don't depend on where it begins. A cyclic-polynomial hash
rolls over them, each k-gram's from the one before by the word that enters and the word that
leaves, and of every w neighbouring k-gram hashes the smallest is chosen, the rightmost on a tie. Chosen hashes keep
their positions. Any run of ``w + k - 1`` words of up to CUT characters that two texts share leaves a common
fingerprint entry, as does any run of more than CUT characters without white space (it holds ``w + k - 1`` parts, by
the default values); none shorter than k words, or k parts, can. The hash starts anew every STRETCH grams, with the same
values, so that a long text's array isn't copied for each of its words.

A fingerprint is spelled as ``hash:position`` entries in text order; the likeness of two is the Jaccard
similarity of their sets of hashes.

DataFrame functions only. A document and the next one in descending id order meet in a window over ranges of the
order (id, then a hash of the text, so that a null or often repeated id has many ranges too). The ranges are those of
Spark's own range partitioner over these keys; their bounds are a table that stays on the executors, searched by halves,
and each range also gets the first row of the range after it.

Edge cases: a null text counts as empty; a text without words has an empty fingerprint, alike to another empty
one (1) and to nothing else (0); a text with fewer than k words has one entry; null ids come last; rows that
repeat an id follow each other in order of the hashes of their texts; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blank_if_null, let, named, stored

GRAM = 4
WINDOW = 10
CUT = 24
PART = 8
#: Bytes of text that a range should hold where there are few, and once every core has several: rows are sorted in a range, and may spill.
RANGE_BYTES = 8 << 20
LARGE_BYTES = 512 << 20
RANGES_PER_CORE = 8
STRETCH = 32
_LOW = (1 << 32) - 1


def _turn(c: Column, by: int) -> Column:
    return F.shiftleft(c, by).bitwiseOR(F.shiftrightunsigned(c, 64 - by)) if by else c


def words_of(text: Column) -> Column:
    """Words of up to CUT characters, and the overlapping parts of longer ones, in text order."""
    one = r"[^\x20\x09-\x0D]"
    word = rf"(?<!{one}){one}{{1,{CUT}}}+(?!{one})"
    return F.regexp_extract_all(text, F.lit(rf"(?=({word}|{one}{{{PART}}}))(?:{word}|{one})"), F.lit(1))


def winnow(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """Array of chosen entries in text order: hash in the upper 31 bits, reversed position in the lower 32."""
    hashed = F.transform(words_of(text), lambda w: F.xxhash64(w))

    def rolled(h: Column) -> Column:
        word = lambda i: F.coalesce(F.get(h, i), F.lit(0))
        last = F.greatest(F.size(h) - gram, F.lit(0))

        def stretch(s: Column) -> Column:
            first = word(s)
            for j in range(1, gram):
                first = _turn(first, 1).bitwiseXOR(word(s + j))
            step = lambda acc, i: F.concat(acc, F.array(_turn(F.element_at(acc, -1), 1).bitwiseXOR(_turn(F.get(h, i - 1), gram)).bitwiseXOR(word(i + (gram - 1)))))
            ends = F.least(s + (STRETCH - 1), last)
            return F.aggregate(F.when(ends > s, F.sequence(s + 1, ends)).otherwise(F.array().cast("array<int>")), F.array(first), step)

        every = F.flatten(F.transform(F.sequence(F.lit(0), last, F.lit(STRETCH)), stretch))
        return F.transform(every, lambda g, i: F.shiftleft(F.shiftrightunsigned(F.xxhash64(g), 33), 32).bitwiseOR(F.lit(_LOW) - i))

    def chosen(g: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(g) - window + 1, F.lit(1)))
        return F.array_distinct(F.transform(starts, lambda i: F.array_min(F.slice(g, i, window))))

    none = F.array().cast("array<bigint>")
    return let(hashed, lambda h: F.when(F.size(h) > 0, let(rolled(h), chosen)).otherwise(none))


def hashes(entries: Column) -> Column:
    return F.array_distinct(F.transform(entries, lambda e: F.shiftrightunsigned(e, 32)))


def spelled(entries: Column) -> Column:
    one = lambda e: F.concat(F.lower(F.lpad(F.hex(F.shiftrightunsigned(e, 32)), 8, "0")), F.lit(":"), (F.lit(_LOW) - e.bitwiseAND(F.lit(_LOW))).cast("string"))
    return F.array_join(F.transform(entries, one), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(F.coalesce(F.try_divide(shared, F.size(a) + F.size(b) - shared), F.lit(0.0)))


def fingerprint_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """(id, fingerprint, n_words of entries): the plain fingerprint of each row."""
    rows = docs.select(named(id_col).alias("id"), winnow(blank_if_null(text_col), gram, window).alias("entries"))
    return rows.select(F.col("id").alias(id_col), spelled(F.col("entries")).alias("fingerprint"), F.size("entries").cast("long").alias("n_entries"))


def _order() -> Column:
    """A row's key in the order of documents: ids descending, null last, then a hash of the text."""
    return F.struct(F.col("id").isNull().alias("z"), F.bitwise_not("id").alias("i"), F.xxhash64("text").alias("t"))


def _bounds(rows: DataFrame) -> tuple[DataFrame, int]:
    """(one row with the array `bounds` of the last keys, ascending, of all ranges but the last; number of ranges)."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    few = min(size // RANGE_BYTES, RANGES_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism)
    n = int(max(1, few, size // LARGE_BYTES))
    keys = rows.select(_order().alias("key")).repartitionByRange(n, "key")
    last = keys.groupBy(F.spark_partition_id().alias("range")).agg(F.max("key").alias("key"))
    gathered = last.agg(F.sort_array(F.collect_list("key")).alias("every"))  # a key for each range
    bounds = stored(gathered.select(F.slice("every", 1, F.greatest(F.size("every") - 1, F.lit(0))).alias("bounds")), "bounds")
    return bounds, bounds.select(F.size("bounds")).first()[0] + 1


def _range_of(key: Column, bounds: Column, n: int) -> Column:
    """How many of the n - 1 bounds lie below a key, by halves."""
    steps = F.array(*[F.lit(1 << k) for k in range(n.bit_length(), -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.coalesce(F.get(bounds, at + s - 1) < key, F.lit(False)), at + s).otherwise(at))


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """One row per row of docs: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last half replaced by as much of the next document's beginning, in descending id
    order; the first document follows the last.
    """
    rows = docs.select(named(id_col).cast("long").alias("id"), blank_if_null(text_col).alias("text"))
    bounds, n_ranges = _bounds(rows)
    if n_ranges == 1:
        dealt = rows.withColumn("part", F.lit(0))
    else:
        dealt = rows.crossJoin(F.broadcast(bounds)).withColumn("part", _range_of(_order(), F.col("bounds"), n_ranges)).drop("bounds")  # with one row
    heads = dealt.groupBy("part").agg(F.min(_order()).alias("head"))  # a row for each range
    order = Window.orderBy("part")
    before = F.coalesce(F.lag("part").over(order), F.last("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    heads = F.broadcast(heads.select(F.col("part").alias("of"), "head", before.alias("to")))
    firsts = dealt.join(heads, (F.col("part") == F.col("of")) & (_order() == F.col("head"))).groupBy("to").agg(F.min("text").alias("text"))
    ghosts = firsts.select(F.lit(None).cast("long").alias("id"), "text", F.col("to").alias("part"), F.lit(True).alias("ghost"))
    every = dealt.withColumn("ghost", F.lit(False)).union(ghosts).repartition(n_ranges, "part")
    marked = every.withColumn("entries", winnow(F.col("text"), gram, window)).withColumn("own", hashes(F.col("entries")))
    follow = Window.partitionBy("part").orderBy("ghost", F.desc_nulls_last("id"), F.xxhash64("text"), "text")
    paired = marked.withColumn("next_text", F.lead("text").over(follow)).withColumn("next_own", F.lead("own").over(follow)).where(~F.col("ghost"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = paired.withColumn("edited", F.concat(F.left("text", n - half), F.left("next_text", half)))
    done = edited.withColumn("edited_entries", winnow(F.col("edited"), gram, window)).withColumn("edited_own", hashes(F.col("edited_entries")))
    return done.select(
        F.col("id").alias(id_col), n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        spelled(F.col("entries")).alias("fingerprint"), spelled(F.col("edited_entries")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited_own")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
