import hashlib
import random
import tracemalloc

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strataflow.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(7)
    odd = [
        "", "  \n", "Hello World!!", "<|endoftext|>abc <|startoftext|>d", "ΑΣ ΟΔΟΣ İstanbul ǅ", "\x1cab\x1d c\x85d\xa0e", "don't I'LL we're", "١٢٣ 123", "é é", "日本語テキスト",
        "a" * 3000, "ab" * 1500 + "!", "the" * 900, "🙂" * 400, "½²³ Ⅷ", "!!!" * 300, "x\x00y", "ß" * 200,
    ]
    many = ["".join(rng.choices(a, k=k)) for a in ("abcdefghijklmnopqrstuvwxyz", "aeinorst ", "0123456789.", "éèßöñçа б") for k in (5, 60, 900)]
    mixed = ["".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x250, 0xD7FF), rng.randrange(0x1F000, 0x1FA00)])) for _ in range(80)) for _ in range(40)]
    return [*odd, *many, *mixed]


def digests(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    spelled = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(spelled.encode()).hexdigest()


def test_query_columns_equal_the_library(documents, library):
    rows = [*enumerate(texts()), (None, "id is null"), (5, "again"), (5, "again"), (900, None)]
    got = bpe.encode_digests(documents(rows), PATH)
    want = [(i, *digests(library, t or "")) for i, t in rows]
    assert sorted([tuple(r) for r in got.collect()], key=repr) == sorted(want, key=repr)
    assert bpe.encode_digests(documents([]), PATH).count() == 0


def test_small_caches_change_nothing(library):
    tool = bpe.Codec(bpe.load(PATH), cache=3)
    assert all(tool.digests(t) == digests(library, t) for t in texts())


def test_stream_emits_stable_tokens_in_bounded_room():
    merges = bpe.load(PATH)
    word = "".join(random.Random(2).choices("theinganderst", k=2500)).encode()
    symbols = [merges.inner[b] for b in word[:-1]] + [merges.last[word[-1]]]
    read = 0

    def source():
        nonlocal read
        for s in symbols:
            read += 1
            yield s

    out, done = [], 0
    for token in merges.stream(source(), room=200):
        out.append(token)
        done += merges.lengths[token]
        assert read - done <= merges.lookahead + 200 + 2 * merges.longest
    assert out == merges.merge(list(symbols))


def test_round_trip_through_the_byte_machine():
    tool = bpe.codec(PATH)
    text = "plain wörds 日本語 🙂 and more"
    assert "".join(tool.decode(tool.encode(text))).strip() == text
    machine = bpe.TextMachine()
    assert "".join(machine.feed(bytes([b])) for b in text.encode()) + machine.finish() == text


def test_ids_as_a_column_keep_the_rest(documents, library):
    frame = documents([(1, "two words"), (2, None)])
    out = bpe.encode_column(frame, PATH, out="ids").orderBy("doc_id").collect()
    assert out[0].ids == library.encode("two words", add_special_tokens=False).ids and out[1].ids == [] and out[0].text == "two words"


def test_digests_decode_the_emitted_ids(library, monkeypatch):
    """The decoded digest comes out of the byte machine, from ids, in runs; stretches change nothing."""
    fed = []
    real = bpe.TextMachine.feed
    monkeypatch.setattr(bpe.TextMachine, "feed", lambda self, data: (fed.append(len(data)), real(self, data))[1])
    tool = bpe.Codec(bpe.load(PATH))
    rng = random.Random(3)
    long = " ".join("".join(rng.choices("abcdefgé日 \u0301Σ\x1c\n", k=12)) for _ in range(9000))
    for text in ("two words", long, long[:300] + "<|endoftext|>" + long):
        fed.clear()
        ids = library.encode(text, add_special_tokens=False).ids
        assert tool.digests(text) == digests(library, text)
        assert sum(fed) == len(library.decode(ids, skip_special_tokens=False).encode())
        assert "".join(tool.decode_tokens(ids)) == library.decode(ids, skip_special_tokens=False)
    assert len(fed) > 5 and max(fed) < sum(fed) / 3
    for size in (1, 7, 50):
        monkeypatch.setattr(bpe, "STRETCH", size)
        assert all(tool.digests(t) == digests(library, t) for t in (*texts(), long[:2000]))


def test_every_token_comes_out_of_the_stream(library, monkeypatch):
    """Without a cache the stream emits exactly the tokens of the digests; with one, each distinct word's once."""
    emitted = []
    real = bpe.Merges.stream
    monkeypatch.setattr(bpe.Merges, "stream", lambda self, *a, **k: (emitted.append(t) or t for t in real(self, *a, **k)))
    bare = bpe.Codec(bpe.load(PATH))
    for text in (t for t in texts() if "<|" not in t):
        emitted.clear()
        bare._words.clear(), bare._parts.clear()
        seen = bare.encode(text)
        assert seen == library.encode(text, add_special_tokens=False).ids
        assert set(seen) <= set(emitted)
    tool = bpe.Codec(bpe.load(PATH))
    emitted.clear()
    assert tool.digests("one two one two three")[0] == len(library.encode("one two one two three", add_special_tokens=False).ids)
    assert emitted == library.encode("one two three", add_special_tokens=False).ids


def test_column_of_ids_beside_any_columns(documents, library):
    frame = documents([(1, "Hello there"), (2, None)]).withColumns({"token_ids": F.lit("old"), "a.b": F.lit(1), "id": F.lit(2), "n_tokens": F.lit(3)})
    got = bpe.encode_column(frame, PATH)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "a.b", "id", "n_tokens", "token_ids"]
    assert [r.token_ids for r in got.orderBy("doc_id").collect()] == [library.encode("Hello there", add_special_tokens=False).ids, []]
    assert bpe.encode_digests(frame, PATH).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_words_go_on_over_stretches(library, monkeypatch):
    """Texts without blanks are cut inside words, at any place that normalisation and contractions allow."""
    rng = random.Random(11)
    kinds = ["abcdeßéΣİ", "日本語文字한글", "!?-'’", "'sretvlmd", "0123½", "e\u0301\u0323a", "\u1112\u1161\u11ab", "\xa0\u3000x", "🙂é"]
    runs = ["".join(rng.choices(rng.choice(kinds), k=rng.randint(1, 30))) for _ in range(400)]
    texts_ = ["".join(rng.sample(runs, 25)) for _ in range(30)] + ["a" * 700 + "'s" * 40, "日" * 900 + "<|endoftext|>" + "本" * 900 + " end", "''" * 300, "\u0301" * 200]
    want = [digests(library, t) for t in texts_]
    for size in (1, 3, 20, 64):
        monkeypatch.setattr(bpe, "STRETCH", size)
        tool = bpe.Codec(bpe.load(PATH))
        assert [tool.digests(t) for t in texts_] == want


@pytest.mark.parametrize("letters", ["日本語文字列", "abcdefghij"])
def test_a_text_without_blanks_takes_constant_room(library, letters):
    """Room beside the text is the same for 800,000 characters as for 400,000, more than two stretches each."""
    tool, peaks = bpe.Codec(bpe.load(PATH)), []
    tool.digests(letters)
    for n in (400_000, 800_000):
        text = "".join(random.Random(n).choices(letters, k=n))
        tracemalloc.start()
        got = tool.digests(text)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert got == digests(library, text)
    assert max(peaks) < 8 << 20 and peaks[1] < 1.3 * peaks[0]
