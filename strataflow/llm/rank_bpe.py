"""Byte-level BPE by a rank file, through the tiktoken library: encoding in stretches, decoding to raw bytes.

A text is encoded a stretch at a time, so that the library's pattern never runs over more than about STRETCH characters
of a text that offers boundaries. A stretch ends at a safe boundary: a place where the pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

ends a match whatever comes before and after. No alternative goes on with white space, a letter, a digit or another sign after
a character of a different one of these kinds, but that a blank leads the next word and an apostrophe a contraction. So a boundary
is a change of kind whose first character is not white space, unless it is an apostrophe before a letter. What follows is matched as
if it began a text, since nothing in the pattern looks back; what precedes ends in no white space, so its only look ahead is settled.
Between kinds other than white space, boundaries are taken only where both characters are of scripts whose kinds no version of Unicode
will change, as the two pattern engines may be of different versions.

A run of white space is one match, less its last character if something follows. The library's pattern engine goes out of stack
space on a run of some hundred thousand characters, so longer ones than BLANKS are cut out by this rule and merged as one piece.

Edge cases: a null text is encoded as an empty one, which has no tokens; rows that repeat an id are rows of their own; other
columns are ignored, or kept as they are by the column operators; an empty table gives no rows. A text without any boundary (one
word of millions of letters) is one match to the pattern too, and is encoded at once, in room proportional to it. Decoding joins the
tokens' bytes, whether or not they are whole UTF-8; null ids give null bytes; an id that the rank file lacks is an error.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import blank_if_null, named

#: Characters after which the next safe boundary ends a stretch.
STRETCH = 1 << 16
#: White space runs of so many characters are cut out before the pattern sees them.
BLANKS = 1 << 12
#: Characters whose kind (letter, digit, other) is the same in all versions of Unicode that have them, and all have.
_SETTLED = r"[\x00-ɏΑ-ΡΣ-ωА-я‐-‧、-〃ぁ-ゔァ-ヺ一-龥가-힣]"
_LETTER, _DIGIT, _OTHER = (rf"[{kind}&&{_SETTLED}]" for kind in (r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]"))
_SAFE = regex.compile(
    rf"(?<=\S)(?=\s)|(?<={_LETTER})(?=[{_DIGIT}||{_OTHER}])|(?<={_DIGIT})(?=[{_LETTER}||{_OTHER}])|(?<=[{_OTHER}--'])(?=[{_LETTER}||{_DIGIT}])|(?<=')(?={_DIGIT})",
    regex.V1,
)


class RankCodec:
    """Encodes and decodes by a rank file and a splitting pattern."""

    def __init__(self, path: str, pattern: str, stretch: int = STRETCH, blanks: int = BLANKS) -> None:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.tool = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.stretch, self.runs = stretch, regex.compile(rf"\s{{{blanks},}}")

    def stretches(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text in pieces that are encoded on their own, and whether each is a single match of the pattern."""
        at, end = 0, len(text)
        while at < end:
            found = _SAFE.search(text, at + self.stretch) if end - at > self.stretch else None
            stop = found.start() if found else end
            for run in self.runs.finditer(text, at, stop):
                if at < run.start():
                    yield text[at : run.start()], False
                at = run.end() - (run.end() < end)
                yield text[run.start() : at], True
            if at < stop:
                yield text[at:stop], False
            at = stop

    def encode_parts(self, text: str) -> Iterator[list[int]]:
        for part, single in self.stretches(text):
            yield self.tool._encode_single_piece(part) if single else self.tool.encode_ordinary(part)

    def encode(self, text: str) -> list[int]:
        return [i for part in self.encode_parts(text) for i in part]

    def decode(self, ids: list[int]) -> bytes:
        return self.tool.decode_bytes(ids)

    def digests(self, text: str) -> tuple[int, str, str]:
        """(number of tokens, SHA-256 of the ids, SHA-256 of the bytes decoded from them), a stretch at a time."""
        n, all_ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for ids in self.encode_parts(text):
            all_ids.update(((" " if n else "") + " ".join(map(str, ids))).encode())
            decoded.update(self.tool.decode_bytes(ids))
            n += len(ids)
        return n, all_ids.hexdigest(), decoded.hexdigest()


_CODECS: dict[tuple[str, str], RankCodec] = {}


def codec(path: str, pattern: str) -> RankCodec:
    """The worker's codec for a rank file."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = RankCodec(path, pattern)
    return _CODECS[path, pattern]


def encode_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_tokens, ids_sha256, decoded_sha256. path: the rank file, on every machine."""
    kind = docs.schema[id_col].dataType.simpleString()
    kinds = (pa.int64(), pa.string(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, pattern)
        for batch in batches:
            found = [tool.digests(x.as_py()) for x in batch.column("text")]
            columns = [pa.array([row[i] for row in found], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(named(id_col).alias("id"), blank_if_null(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def _with_column(docs: DataFrame, column: str, out: str, kind: T.DataType, arrow: pa.DataType, make) -> DataFrame:
    """docs with make(value of `column`) as column `out`, which replaces one of that name; make runs beside the data."""
    kept = [c for c in docs.columns if c != out]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(out, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([make(x.as_py()) for x in batch.column(len(kept))], arrow)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], made], names=schema.names)

    return docs.select(*map(named, kept), named(column)).toDF(*[f"c{i}" for i in range(len(kept) + 1)]).mapInArrow(run, schema)


def encode_column(docs: DataFrame, path: str, pattern: str, text_col: str = "text", out: str = "token_ids") -> DataFrame:
    """docs with the ids of its texts as an array column."""
    return _with_column(docs, text_col, out, T.ArrayType(T.IntegerType()), pa.list_(pa.int32()), lambda text: codec(path, pattern).encode(text or ""))


def decode_column(rows: DataFrame, path: str, pattern: str, ids_col: str = "token_ids", out: str = "decoded") -> DataFrame:
    """rows with the bytes of its ids as a binary column."""
    return _with_column(rows, ids_col, out, T.BinaryType(), pa.binary(), lambda ids: None if ids is None else codec(path, pattern).decode(ids))
