import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strataflow.llm import token_records as R

PATH = public_tokenizers.path("byte_bpe_50k.json")


def texts():
    rng = random.Random(9)
    odd = ["", " ", "a", " a", "a  b", "a\n\n b", "a \n b ", "x\xa0 y", "　z", "a\x1cb \x1d c", "don't  stop\t\tnow ", "<|endoftext|>q <|endoftext|> ", "日本 語", "🙂 🙂", "w" * 4000, "a\r\n b\x0b c\x0c d", "\x85 e"]
    return odd + ["".join(rng.choices(" \n\tab1.,'ésé<|>", k=rng.randint(1, 200))) for _ in range(120)]


def test_files_hold_the_library_ids_in_order(spark, documents):
    library = Tokenizer.from_file(PATH)
    rows = [*((3 * i, t) for i, t in enumerate(texts())), (7, None), (7, None), (None, "null id")]
    docs = documents(rows).withColumn("start", F.lit("mine")).repartition(5)
    R_rows = R.record_digests(docs, PATH).orderBy("shard", "ordinal").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    assert len(R_rows) == len(rows)
    for r, (i, t) in zip(R_rows, order, strict=True):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_shards_index_and_shuffled_reads(spark, documents, tmp_path):
    rows = [(i, "word " * (i % 50)) for i in range(300)]
    path = f"file://{tmp_path}/x"
    R.write_records(documents(rows), path, PATH, shard_bytes=4000)
    index = R.build_index(spark, path)
    assert index.select("shard").distinct().count() > 3
    found = {r.id: r.ids for r in R.read_ids(spark, path, index.where("id % 7 = 3")).collect()}
    library = Tokenizer.from_file(PATH)
    assert found == {i: [*library.encode(t, add_special_tokens=False).ids, 2] for i, t in rows if i % 7 == 3}
    starts = {r.shard: r.start for r in R.shard_starts(index, block=2).collect()}
    sums = {r.shard: r.n for r in index.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()}
    assert all(starts[s] == sum(n for k, n in sums.items() if k < s) for s in sums)


def test_one_id_has_many_files(spark, documents, tmp_path):
    """Rows without an id, half of them equal, are dealt to files of about the size asked for; starts count on over them."""
    rows = [(None, "equal words " * 20) for _ in range(200)] + [(None, f"word {i} " * 20) for i in range(200)] + [(5, "five")]
    path = f"file://{tmp_path}/x"
    R.write_records(documents(rows), path, PATH, shard_bytes=8000)
    index = R.build_index(spark, path)
    sizes = [r.n for r in index.groupBy("shard").agg(F.sum("n_bytes").alias("n")).collect()]
    assert len(sizes) > 5 and max(sizes) < 4 * sum(sizes) / len(sizes)
    got = R.record_digests(documents(rows), PATH, to=f"file://{tmp_path}/y").orderBy("shard", "ordinal").collect()
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    assert len(got) == 401 and got[-1].doc_id == 5


class MergesOnly:
    """A tokenizer whose encoding of texts must not be asked for."""

    def encode(self, *args, **kwargs):
        raise AssertionError("the whole library was asked for a word")

    encode_batch_fast = encode


def test_new_words_go_straight_to_the_merges():
    library, tool = Tokenizer.from_file(PATH), R.Encoder(PATH, cache=50)  # generations change all the time
    tool._tool = MergesOnly()
    rng = random.Random(4)
    signs = [c for c in map(chr, range(0x2100)) if not R._FOREIGN.search(c)]
    plain = ["", " ", "  a", "a  \n b ", "don't  stop'll\t\tnow 's", "a \n \nb", "x" * 4000, "é" * 200, "\x00\x7f\x80 €5 – 1.5", *signs, *(" " + c for c in signs)]
    plain += ["".join(rng.choices(" \n\t\rab1.,'sétß–€", k=rng.randint(1, 60))) for _ in range(2000)] + ["".join(rng.choices(signs, k=40)) for _ in range(300)]
    for text in plain * 2:
        assert tool.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_damage_is_noticed():
    data = b"".join(R.frame(R.pack(i, np.arange(5) + 65_534 * i)) + R.MARK for i in range(3))
    assert [R.unpack(p)[1].tolist() for _, p in R.unframe(data)] == [(np.arange(5) + 65_534 * i).tolist() for i in range(3)]
    for at in (2, 9, 15, len(data) - 1):
        with pytest.raises(ValueError):
            list(R.unframe(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :]))


def test_empty_table(documents):
    assert R.record_digests(documents([]), PATH).count() == 0
