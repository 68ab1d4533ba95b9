"""Exact dedup by composable polynomial fingerprints.

A text's normalised bytes (white space deleted) are cut into chunks. Each chunk has a polynomial hash under
two prime moduli; hashes of neighbouring chunks combine by length-shifted arithmetic,
``H(AB) = H(A) * B^|B| + H(B)``, so the chunks of one huge text can be hashed apart and in any grouping.
Rows of equal fingerprint and length are candidates. They are then compared chunk by chunk: per chunk number
the smallest and largest chunk of the candidates must agree, a partial aggregate that never gathers a group.
Candidates that disagree anywhere (a collision) are told apart by the SHA-256 of their text. Tables of groups are stored
before rows meet them, so that a join's large partitions (a group of copies with a third of the rows) can be split.

Edge cases: a null text counts as empty and all empty texts are one group; a null id is an id like any other;
one row of each group stays whatever the ids are, and whichever of rows that repeat id and text: the one with the most code points, then the smallest id (null last), then
the smaller SHA-256 of its text; columns besides id and text are ignored by :func:`exact_groups` and kept by
:func:`drop_copies`, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, blank_if_null, named, stored, unused

#: Two primes below 2^31, so that a byte times a power stays far below 2^64 when summed over a chunk.
MODULI = (2147483647, 2147483629)
BASES = (911382323, 972663749)
CHUNK = 1 << 16


def _powers(base: int, mod: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    done = 1
    while done < n:  # doubling: base^(done+i) = base^done * base^i
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, mod)) % np.uint64(mod)
        done += step
    return out[::-1].copy()


_TABLES: dict[int, list[np.ndarray]] = {}


def _tables(chunk: int) -> list[np.ndarray]:
    if chunk not in _TABLES:
        _TABLES[chunk] = [_powers(b, m, chunk) for b, m in zip(BASES, MODULI, strict=True)]
    return _TABLES[chunk]


def chunk_hash(chunk: bytes, size: int = CHUNK) -> tuple[int, int, int]:
    """(hash under each modulus, length) of one chunk of at most `size` bytes."""
    values = np.frombuffer(chunk, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    n = len(values)
    first, second = (int((values * powers[size - n :]).sum() % np.uint64(m)) for powers, m in zip(_tables(size), MODULI, strict=True))
    return first, second, n


def combine(left: tuple[int, int, int], right: tuple[int, int, int]) -> tuple[int, int, int]:
    """The hash of two neighbouring pieces from their hashes."""
    (a, b, n), (c, d, m) = left, right
    return (a * pow(BASES[0], m, MODULI[0]) + c) % MODULI[0], (b * pow(BASES[1], m, MODULI[1]) + d) % MODULI[1], n + m


def fingerprint(data: bytes, size: int = CHUNK) -> tuple[int, int, int]:
    """(hash, hash, length) of a whole text, chunk by chunk."""
    out = (0, 0, 0)
    for at in range(0, len(data), size):
        out = combine(out, chunk_hash(data[at : at + size], size))
    return out


def _fingerprints(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints, lengths, digests = [], [], []
        for raw in batch.column("raw"):
            data = raw.as_py().translate(None, BLANKS)
            a, b, n = fingerprint(data, size)
            prints.append(a << 32 | b)
            lengths.append(n)
            digests.append(hashlib.sha256(data).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("n_points"), pa.array(prints, pa.int64()), pa.array(lengths, pa.int64()), pa.array(digests, pa.string())],
            names=["id", "n_points", "fp", "n_bytes", "sha"],
        )


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    names = ["fp", "n_bytes", "chunk_no", "chunk"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        rows: list[list] = [[], [], [], []]
        held = 0
        for raw, fp, n in zip(batch.column("raw"), batch.column("fp").to_pylist(), batch.column("n_bytes").to_pylist(), strict=True):
            data = raw.as_py().translate(None, BLANKS)
            for no, at in enumerate(range(0, len(data), size)):
                for column, value in zip(rows, (fp, n, no, data[at : at + size]), strict=True):
                    column.append(value)
                held += size
                if held >= 16 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=names)
                    rows, held = [[], [], [], []], 0
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=names)


def _decided(docs: DataFrame, id_col: str, text_col: str, chunk: int) -> DataFrame:
    """One row per row of docs: id, said (SHA-256 of the text as it is), sha, group_size, best (that of the row that stays)."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(named(id_col).alias("id"), blank_if_null(text_col).alias("text"))
    raw = F.col("text").cast("binary").alias("raw")
    marks = stored(
        rows.select(F.struct("id", F.sha2("text", 256).alias("said")).alias("id"), F.length("text").cast("long").alias("n_points"), raw)
        .mapInArrow(lambda batches: _fingerprints(batches, chunk), f"id struct<id: {kind}, said: string>, n_points long, fp long, n_bytes long, sha string")
        .select("id.id", "id.said", "n_points", "fp", "n_bytes", "sha", F.monotonically_increasing_id().alias("row")),
        "fingerprints",
    )
    several = stored(marks.groupBy("fp", "n_bytes").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp", "n_bytes"), "several")
    candidates = marks.join(several, ["fp", "n_bytes"]).select(row_key(F.col("id"), F.col("said")).alias("key"), "fp", "n_bytes").distinct()
    compared = (
        rows.withColumn("key", row_key(F.col("id"), F.sha2("text", 256)))
        .join(stored(candidates, "candidates"), "key")  # by id and text: each row meets one candidate, null and repeated ids too
        .select("fp", "n_bytes", raw)
        .mapInArrow(lambda batches: _chunks(batches, chunk), "fp long, n_bytes long, chunk_no long, chunk binary")
        .groupBy("fp", "n_bytes", "chunk_no")
        .agg(F.min("chunk").alias("least"), F.max("chunk").alias("most"))
    )
    collided = stored(compared.where("least <> most").select("fp", "n_bytes", F.lit(True).alias("collided")).distinct(), "collided")
    if collided.isEmpty():
        keyed = marks.withColumn("told", F.lit(""))
    else:
        keyed = marks.join(collided, ["fp", "n_bytes"], "left").withColumn("told", F.when(F.col("collided"), F.col("sha")).otherwise(F.lit("")))
    key = ["fp", "n_bytes", "told"]
    best = F.struct((-F.col("n_points")).alias("p"), F.col("id").isNull().alias("z"), F.col("id").alias("i"), F.col("said").alias("s"), F.col("row").alias("r"))
    groups = stored(keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("group_size"), F.min(best).alias("best")), "groups")
    return keyed.join(groups, key).select("id", "said", "sha", "group_size", "best", (F.col("row") == F.col("best.r")).alias("kept"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256.

    Of equal normalised texts the row with the most code points in the original text stays, then the smallest
    id (null ids last), then the smallest digest of the original text; of rows that repeat both, one stays.
    """
    return _decided(docs, id_col, text_col, chunk).select(
        F.col("id").alias(id_col),
        F.col("best.i").alias("keep_id"),
        "group_size",
        "kept",
        F.col("sha").alias("text_sha256"),
    )


def row_key(id_: Column, said: Column) -> Column:
    """A row's id and the SHA-256 of its text as one text, never null: one shuffle serves a join and a last step."""
    return F.concat_ws("=", said, id_.cast("string"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of equal texts, all columns kept."""
    chosen = F.col("id").eqNullSafe(F.col("best.i")) & (F.col("said") == F.col("best.s"))
    stay = _decided(docs, id_col, text_col, CHUNK).where(chosen).select(row_key(F.col("id"), F.col("said")).alias("key"))
    return keep_keys(docs, row_key(named(id_col), F.sha2(blank_if_null(text_col), 256)), stay)


def keep_keys(docs: DataFrame, own: Column, stay: DataFrame) -> DataFrame:
    """docs with one row of each key of `stay` (one column), all columns kept; own: a row's key."""
    (key,) = unused("key", taken=docs.columns)
    return docs.withColumn(key, own).join(stay.toDF(key).distinct(), key, "left_semi").dropDuplicates([key]).select(*[named(c) for c in docs.columns])


#: The query's contract in DuckDB SQL.
ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), g AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size, first_value(doc_id) OVER stay AS keep_id, row_number() OVER stay = 1 AS kept
  FROM t WINDOW stay AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST, sha256(text))
)
SELECT doc_id, keep_id, group_size, kept, sha256(norm) AS text_sha256 FROM g
"""
