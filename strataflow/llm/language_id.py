"""Language identification by rank-order n-gram profiles.

Each language's profile is the list of its most frequent character n-grams (one to three letters, words
padded by a blank) in rank order, learned from labelled rows. A document's own most frequent n-grams are
ranked alike; its distance to a profile is the sum of how far each n-gram is out of place, an n-gram that the
profile lacks counting the most. The nearest profile wins; the score is one minus the distance over the
largest possible distance.

Learning reads a bounded sample of labelled rows: at most about ``sample_rows`` per language, chosen by a hash
of the id, so reruns agree. Prediction covers every row and whole texts.

Edge cases: a null text, or one without letters, is ``und`` with score 0; ties between languages go to the
first in code-point order; with no labelled rows every text is ``und``; null ids are not learned from; other
columns are kept by :func:`identify`, whatever their names, but for one named like a result, which the result replaces
(`names` gives the results other names); an empty table gives an empty result.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import named

UNKNOWN = "und"
#: n-grams kept of a profile, and of a document.
PROFILE_SIZE = 400
DOC_SIZE = 300
SAMPLE_ROWS = 5000

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """A code point's own value if it is a letter, else a blank."""
    if not _LETTERS:
        table = np.full(sys.maxunicode + 1, 32, dtype=np.uint32)
        for i in range(sys.maxunicode + 1):
            if unicodedata.category(chr(i))[0] == "L":
                table[i] = i
        _LETTERS.append(table)
    return _LETTERS[0]


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams (packed code points, 21 bits each) and their counts; empty if there are no letters."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if not text:
        return none
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    points = _letters()[points]
    blank = points == 32
    if blank.all():
        return none
    keep = ~blank
    keep[1:] |= ~blank[:-1]  # the first blank after a letter stays
    points = points[keep]
    points = np.concatenate(([32], points, [32])).astype(np.uint64) if points[-1] != 32 else np.concatenate(([32], points)).astype(np.uint64)
    one, two = points[points != 32], points[:-1] | points[1:] << np.uint64(21)
    three = two[:-1] | points[2:] << np.uint64(42)
    middle = points[1:-1] != 32  # no n-gram across words
    return np.unique(np.concatenate((one, two, three[middle])), return_counts=True)


def _top(found: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """The n most frequent n-grams, in rank order; ties by their code."""
    return found[np.lexsort((found, -counts))[:n]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, Counter] = {}
    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
            found, counts = grams(text.as_py())
            totals.setdefault(lang, Counter()).update(dict(zip(found.tolist(), counts.tolist(), strict=True)))
    for lang, counter in totals.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(counter), pa.string()), pa.array(list(counter), pa.int64()), pa.array(list(counter.values()), pa.int64())], names=["lang", "gram", "n"]
        )


def learn_profiles(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, sample_rows: int = SAMPLE_ROWS, size: int = PROFILE_SIZE) -> dict[str, np.ndarray]:
    """{language: n-grams in rank order}, from about sample_rows rows of each language."""
    rows = labelled.select(named(id_col).alias("id"), named(text_col).alias("text"), named(lang_col).alias("lang")).dropna()
    totals = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"))
    draw = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 20)) / float(1 << 20)
    kept = {r["lang"]: min(1.0, sample_rows / r["n_rows"]) for r in totals.collect()}  # a row for each language
    if not kept:
        return {}
    wanted = F.lit(False)
    for lang, part in kept.items():
        wanted = wanted | ((F.col("lang") == lang) & (draw < part))
    counts = (
        rows.where(wanted)
        .select("text", "lang")
        .mapInArrow(_count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size).collect()  # `size` rows for each language
    out: dict[str, list[tuple[int, int]]] = {}
    for r in top:
        out.setdefault(r["lang"], []).append((r["rank"], r["gram"]))
    return {lang: np.array([g for _, g in sorted(out[lang])], dtype=np.uint64) for lang in sorted(out)}


class Profiles:
    """Ranks of every profile's n-grams, looked up by binary search."""

    def __init__(self, profiles: dict[str, np.ndarray], doc_size: int = DOC_SIZE) -> None:
        self.langs = sorted(profiles)
        self.doc_size = doc_size
        self.size = max((len(p) for p in profiles.values()), default=0)
        self.grams = np.unique(np.concatenate([profiles[x] for x in self.langs])) if profiles else np.zeros(0, np.uint64)
        self.ranks = np.full((len(self.langs), len(self.grams) + 1), -1, dtype=np.int64)
        for i, lang in enumerate(self.langs):
            self.ranks[i, np.searchsorted(self.grams, profiles[lang])] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        found, counts = grams(text)
        if not len(found) or not self.langs:
            return UNKNOWN, 0.0
        own = _top(found, counts, self.doc_size)
        at = np.searchsorted(self.grams, own)
        at[(at < len(self.grams)) & (self.grams[np.minimum(at, len(self.grams) - 1)] != own)] = len(self.grams)
        ranks = self.ranks[:, at]
        apart = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))))
        total = apart.sum(axis=1)
        best = int(np.argmin(total))
        return self.langs[best], float(1 - total[best] / (self.size * len(own)))


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], text_col: str = "text", keep: list[Column] | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns `keep` of docs (all but those in `names` if None), with the language and the score under `names`."""
    spark: SparkSession = docs.sparkSession
    columns = keep if keep is not None else [named(c) for c in docs.columns if c.lower() not in names]
    shape = docs.select(*columns)
    at = docs.columns.index(text_col) if keep is None and text_col in shape.columns and len(shape.columns) == len(docs.columns) else None
    sent = [*columns, *([named(text_col)] if at is None else [])]  # the text travels once
    n, at = len(columns), len(columns) if at is None else at
    schema = T.StructType([*shape.schema, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    model = spark.sparkContext.broadcast(profiles)  # PROFILE_SIZE n-grams for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Profiles(model.value)
        for batch in batches:
            said = [judge.predict(x.as_py()) for x in batch.column(at)]
            own = batch.columns[:n]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array([x for x, _ in said], pa.string()), pa.array([x for _, x in said], pa.float64())], names=schema.names
            )

    return docs.select(*sent).toDF(*[f"c{i}" for i in range(len(sent))]).mapInArrow(run, schema)


def training_rows(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang") -> DataFrame:
    """Rows that may be learned from: crc32 of the id as text is no multiple of 5, and the label is known."""
    return docs.where((F.crc32(named(id_col).cast("string").cast("binary")) % 5 != 0) & named(lang_col).isNotNull())


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(named(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
