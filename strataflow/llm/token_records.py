"""Token ids as length-delimited binary records, with an offset index beside them.

File format. A record file is a run of records, each ::

    length   8 bytes  number of payload bytes
    check    4 bytes  masked checksum of the length field
    payload  `length` bytes
    check    4 bytes  masked checksum of the payload
    mark     1 byte   0x0A

and a payload is ``id (8 bytes, signed) | flags (1 byte) | ids``, all little-endian; flag 1: the id is null,
flag 2: ids take four bytes each, else two. The checksum is CRC-32, masked by rotating right by 15 bits and
adding 0xA282EAD8, so that a checksum stored inside checked data does not upset an outer one.

Files are written by Spark's own committer (a record is a row of bytes, the mark its line end), so lost tasks
and executors leave nothing behind and any store works that Spark can write to. Documents are range-partitioned
by id, then digest of the text and place, so file order is id order and no id needs a file of its own. The index is a table built from the files, all checksums verified: file,
ordinal, byte offset, length, id, number of tokens, checksum of the ids and the ids before it in its file; a
shuffled reader draws rows from it and reads byte ranges.

Encoding goes through the tokenizers library. White space starts a new word in byte-level vocabularies, so a
text's space-led pieces encode on their own, and repeated pieces come from a bounded cache. Where texts can be cut
into words of the vocabulary's pattern, a new word goes straight to the library's merges; other new pieces go
through the whole library. Texts with white space beyond the common six characters are encoded in one call.

Edge cases: a null text is encoded as an empty one and still gets its end id; null ids come first; rows that
repeat an id are records of their own; other columns are ignored; an empty table writes no record.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import compress
from operator import not_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import blank_if_null, new_path, stored

END_ID = 2
MARK = b"\n"
SHARD_BYTES = 16 << 20
CACHE = 300_000  # below the 349,525 entries at which a dict's table doubles
_MASK = 0xA282EAD8
_LENGTH, _CHECK = struct.Struct("<Q"), struct.Struct("<I")
_HEAD = struct.Struct("<qB")
#: White space on which Python and the vocabulary's pattern might disagree, or that is rare.
_ODD = re.compile("[" + "".join(map(chr, [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF])) + "]")
_PIECES = re.compile(r"\s*\S+|\s+")
#: Characters beyond ASCII, Latin letters and common signs: for the rest Python's classes are those of the pattern.
_FOREIGN = re.compile(r"[^\x00-\x1b\x20-\x84\x86-\x9f\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]")
_LETTERS = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
#: The vocabulary's word pattern, for such texts: letters, contractions, digits, other signs, white space.
_WORDS = re.compile(rf" ?[{_LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^ \t-\r0-9{_LETTERS}]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """One record without its closing mark, which the writer adds."""
    size = _LENGTH.pack(len(payload))
    return b"".join((size, _CHECK.pack(masked(size)), payload, _CHECK.pack(masked(payload))))


def unframe(data: bytes | memoryview) -> Iterator[tuple[int, memoryview]]:
    """(offset, payload) of each record of a file; ValueError where a checksum or the mark is wrong."""
    data, at = memoryview(data), 0
    while at < len(data):
        (n,) = _LENGTH.unpack_from(data, at)
        if _CHECK.unpack_from(data, at + 8)[0] != masked(data[at : at + 8]):
            raise ValueError(f"wrong length checksum at {at}")
        payload, end = data[at + 12 : at + 12 + n], at + 12 + n
        if bytes(data[end + 4 : end + 5]) != MARK or _CHECK.unpack_from(data, end)[0] != masked(payload):
            raise ValueError(f"wrong payload checksum at {at}")
        yield at, payload
        at = end + 5


def pack(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = len(ids) > 0 and int(ids.max()) > 0xFFFF
    return _HEAD.pack(doc_id or 0, (doc_id is None) | wide << 1) + ids.astype("<u4" if wide else "<u2").tobytes()


def unpack(payload: memoryview) -> tuple[int | None, np.ndarray]:
    doc_id, flags = _HEAD.unpack_from(payload)
    return None if flags & 1 else doc_id, np.frombuffer(payload[_HEAD.size :], dtype="<u4" if flags & 2 else "<u2")


def _byte_signs() -> dict[int, str]:
    """Byte-level vocabularies write a byte as a printable character: some as themselves, the others from U+0100 on."""
    same = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(0x100) if b not in same)
    return {b: chr(b) for b in same} | {b: chr(0x100 + n) for n, b in enumerate(others)}


_SIGNS = _byte_signs()


class _Pieces(dict):
    """Ids of pieces, as bytes; those of a word are made when first asked for. Of two generations of `size` pieces it
    holds the young one."""

    def __init__(self, encode: Callable[[str], bytes], size: int) -> None:
        super().__init__()
        self._encode, self._size, self.old = encode, size, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self._encode(word)
        self.keep(word, ids)
        return ids

    def keep(self, piece: str, ids: bytes) -> None:
        if len(piece) <= 64:
            if len(self) >= self._size:
                self.old = dict(self)
                self.clear()
            self[piece] = ids


class Encoder:
    """Texts to ids through the tokenizers library, repeated pieces from a bounded cache.

    Pieces are words of the vocabulary's own pattern where Python's character classes agree with it, else
    space-led runs; a word that is a run too has the same ids. The cache has two generations of `cache` pieces: a
    piece used again moves to the young one, and the old one goes when that is full.
    """

    def __init__(self, path: str, cache: int = CACHE) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task, one core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self._tool = Tokenizer.from_file(path)
        self._special = [t.content for t in self._tool.get_added_tokens_decoder().values()]
        self._known, self._merges = _Pieces(self._merged, cache), self._tool.model.tokenize
        # With such a vocabulary the library writes a word's bytes as signs and merges them, and does nothing else.
        cut = self._tool.pre_tokenizer
        self._cuts_words = self._tool.normalizer is None and isinstance(cut, ByteLevel) and cut.use_regex and not cut.add_prefix_space

    def _merged(self, word: str) -> bytes:
        common = word.isascii() and word.isprintable()
        signs = word.replace(" ", _SIGNS[32]) if common else word.encode().decode("latin-1").translate(_SIGNS)
        return array("I", [t.id for t in self._merges(signs)]).tobytes()

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        known, new = {}, []
        for p in set(pieces):
            ids = self._known.old.get(p)
            known[p] = ids
            if ids is None:
                new.append(p)
        known.update(zip(new, (array("I", e.ids).tobytes() for e in self._tool.encode_batch_fast(new, add_special_tokens=False)), strict=True))
        for p, ids in known.items():
            self._known.keep(p, ids)
        return known

    def ids(self, text: str) -> np.ndarray:
        plain = not _FOREIGN.search(text)
        if plain and self._cuts_words and not any(s in text for s in self._special):
            return np.frombuffer(b"".join(map(self._known.__getitem__, _WORDS.findall(text))), dtype=np.uint32)
        if not plain and _ODD.search(text):
            return np.array(self._tool.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        pieces = _PIECES.findall(text)
        found = list(map(self._known.get, pieces))
        if None in found:
            missing = list(compress(range(len(found)), map(not_, found)))
            made = self._learn([pieces[i] for i in missing])
            for i in missing:
                found[i] = made[pieces[i]]
        return np.frombuffer(b"".join(found), dtype=np.uint32)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_records(docs: DataFrame, to: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> None:
    """Record files of all rows of docs under `to`, in ascending order of id; `to` must not exist."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), blank_if_null(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, end = encoder(tokenizer), np.array([end_id], dtype=np.uint32)
        for batch in batches:
            out, held = [], 0
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                out.append(frame(pack(doc_id, np.concatenate((tool.ids(text.as_py()), end)))))
                held += len(out[-1])
                if held >= 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    # A null or often repeated id is dealt to many files, by digest and place of its rows.
    key = ["id", "digest", "place"]
    ordered = rows.withColumns({"digest": F.xxhash64("text"), "place": F.monotonically_increasing_id()}).repartitionByRange(shards, *key).sortWithinPartitions(*key).select("id", "text")
    ordered.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("record")).write.option("lineSep", MARK.decode()).text(to)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(shard, file, content): a row for each record file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(_shard(F.col("path")).alias("shard"), F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def _shard(path: Column) -> Column:
    return F.regexp_extract(path, r"part-(\d+)", 1).cast("long")


_INDEX = {"shard": "long", "file": "string", "ordinal": "long", "offset": "long", "n_bytes": "long", "id": "long", "n_tokens": "long", "ids_crc32": "long", "before": "long"}


def build_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, read from the files with all checksums verified: the columns of _INDEX.

    ids_crc32 is the CRC-32 of the ids as four bytes each; before counts the ids of earlier records of the file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, file, content in zip(batch.column("shard").to_pylist(), batch.column("file").to_pylist(), batch.column("content"), strict=True):
                rows, before = [], 0
                for no, (at, payload) in enumerate(unframe(content.as_buffer())):
                    doc_id, ids = unpack(payload)
                    rows.append((shard, file, no, at, len(payload), doc_id, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), before))
                    before += len(ids)
                if rows:
                    columns = [pa.array(c, pa.string() if kind == "string" else pa.int64()) for c, kind in zip(zip(*rows, strict=True), _INDEX.values(), strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=list(_INDEX))

    return _files(spark, path).mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in _INDEX.items()))


def shard_starts(index: DataFrame, block: int = 1024) -> DataFrame:
    """(shard, start): ids in all earlier files. Sums run inside blocks of files, then over the blocks."""
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("n")).withColumn("block", F.floor(F.col("shard") / block))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = totals.groupBy("block").agg(F.sum("n").alias("n")).select("block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("block").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.join(blocks, "block").select("shard", (F.col("base") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("start"))


def read_ids(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(id, ids) of the index rows in `wanted`, each cut from its file by offset and length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int | None, np.ndarray]] = []
            for content, spans in zip(batch.column("content"), batch.column("spans").to_pylist(), strict=True):
                data = memoryview(content.as_buffer())
                for s in spans:
                    end = s["offset"] + 12 + s["n_bytes"] + 5
                    out += [unpack(p) for _, p in unframe(data[s["offset"] : end])]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.int64()), pa.array([x for _, x in out], pa.list_(pa.int64()))], names=["id", "ids"])

    spans = wanted.groupBy("file").agg(F.collect_list(F.struct("offset", "n_bytes")).alias("spans"))  # a file's records at most
    return _files(spark, path).join(spans, "file").select("content", "spans").mapInArrow(run, "id long, ids array<long>")


def record_digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", to: str | None = None) -> DataFrame:
    """Writes docs, reads the files back into an index: id, start, n_tokens, ids_crc32, shard, ordinal for each record."""
    spark = docs.sparkSession
    path = to or new_path(spark, "records")
    write_records(docs, f"{path}/data", tokenizer, id_col, text_col)
    build_index(spark, f"{path}/data").write.parquet(f"{path}/index")
    index = spark.read.parquet(f"{path}/index")
    starts = stored(shard_starts(index), "starts")
    return index.join(starts, "shard").select(F.col("id").alias(id_col), (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "shard", "ordinal")
