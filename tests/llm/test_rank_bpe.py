import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.errors import PythonException

from strataflow.llm import rank_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(11)
    odd = ["", " ", "\n", "a \n b", "a\t\nb", "x" * 900, "don't 'll we're'd ''s 's's", "!'s", "$5 5$ a5b", "日本語テキスト。", "é́", "🙂🙂 🙂", "\x00\x1c\x85\xa0", "<|endoftext|>", "a" + " " * 300 + "b", " " * 300, "\n" * 40 + "x"]
    alphabets = ("ab '!5\n", "aé '1日。\t ", " \n\t\r　\xa0x", "'strevmld1!", "abcdefghij 0123.,")
    return [*odd, *("".join(rng.choices(a, k=k)) for a in alphabets for k in (3, 17, 90, 700) for _ in range(12))]


def digests(library, text):
    ids = library.encode_ordinary(text)
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode_bytes(ids)).hexdigest()


def test_any_stretch_gives_the_ids_of_the_library(library):
    for stretch, blanks in ((1, 2), (3, 5), (16, 1000), (1 << 16, 1 << 12)):
        tool = rank_bpe.RankCodec(PATH, PATTERN, stretch, blanks)
        for text in texts():
            assert tool.encode(text) == library.encode_ordinary(text), (stretch, text)
            assert "".join(part for part, _ in tool.stretches(text)) == text
            assert tool.decode(tool.encode(text)) == text.encode()


def test_stretches_are_short_where_there_are_boundaries():
    tool = rank_bpe.RankCodec(PATH, PATTERN, 100)
    for text in ("word " * 5000, "ab12" * 5000, "日本。" * 5000):
        assert max(len(part) for part, _ in tool.stretches(text)) < 110


def test_runs_of_white_space_beyond_the_pattern_engine(library):
    tool = rank_bpe.RankCodec(PATH, PATTERN)
    for run, tail in ((" " * 1_000_000, "end"), ("\n" * 1_000_000, ""), (" \t" * 400_000, "!")):
        ids = tool.encode("start" + run + tail)
        assert tool.decode(ids) == ("start" + run + tail).encode()
    short = "start" + " " * 10_000 + "end"
    assert tool.encode(short) == library.encode_ordinary(short)


def test_query_columns_equal_the_library(documents, library):
    rows = [*enumerate(texts()), (None, "id is null"), (5, "again"), (5, "again"), (900, None), (901, "long text, 'quoted'\n" * 20_000)]
    got = rank_bpe.encode_digests(documents(rows), PATH, PATTERN)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted([tuple(r) for r in got.collect()], key=repr) == sorted([(i, *digests(library, t or "")) for i, t in rows], key=repr)
    assert rank_bpe.encode_digests(documents([]), PATH, PATTERN).count() == 0


def test_columns_beside_clashing_names(spark, library):
    df = spark.createDataFrame([(1, "half 🙂", "x"), (2, None, "y")], "`id` int, `text` string, `token_ids` string")
    encoded = rank_bpe.encode_column(df, PATH, PATTERN)
    assert encoded.columns == ["id", "text", "token_ids"]
    ids = {r.id: r.token_ids for r in encoded.collect()}
    assert ids == {1: library.encode_ordinary("half 🙂"), 2: []}
    cut = spark.createDataFrame([(1, ids[1][:-1], "old"), (2, None, "old"), (3, [], "old")], "id int, token_ids array<int>, decoded string")
    back = {r.id: r.decoded for r in rank_bpe.decode_column(cut, PATH, PATTERN).collect()}
    assert back[1] == library.decode_bytes(ids[1][:-1]) and back[2] is None and back[3] == b""
    with pytest.raises(PythonException):
        rank_bpe.decode_column(spark.createDataFrame([([60000],)], "token_ids array<int>"), PATH, PATTERN).collect()
