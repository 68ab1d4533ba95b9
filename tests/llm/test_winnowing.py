import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from strataflow.llm import winnowing as W


def slow_words(text):
    """Words of up to 24 characters; of a longer one its 8 characters from each place."""
    out = []
    for word in re.split(r"[\x20\x09-\x0D]+", text or ""):
        out += [word[i : i + 8] for i in range(len(word) - 7)] if len(word) > 24 else [word] if word else []
    return out


def slow_entries(text, table):
    """The rolled hash of each gram; table: the 64-bit hash of each word, from Spark."""
    words = slow_words(text)
    if not words:
        return []
    turn = lambda x, r: (x << r | x >> 64 - r) & (2**64 - 1) if r else x
    h = [table[w] % 2**64 for w in words]
    grams = []
    for i in range(max(1, len(h) - W.GRAM + 1)):
        x = 0
        for j in range(W.GRAM):
            x ^= turn(h[i + j] if i + j < len(h) else 0, W.GRAM - 1 - j)
        grams.append(x)
    return grams


@pytest.fixture(scope="module")
def hashing(spark):
    """hash(values) -> {value: xxhash64}, by Spark, for words or longs."""

    def run(values, kind):
        frame = spark.createDataFrame([(v,) for v in set(values)], f"v {kind}")
        return {r.v: r.h for r in frame.select("v", F.xxhash64("v").alias("h")).collect()}

    return run


def texts():
    rng = random.Random(13)
    words = ["".join(rng.choices("abcdefé", k=rng.randint(1, 6))) for _ in range(60)]
    odd = [None, "", " \n", "one", "one two", "a b c d", "a a a a a a a a a a a a a a a a a a a a a", "x" * 500, "é🙂 " * 30, "w" * 24 + " " + "v" * 25, "a " + "日本🙂語" * 40 + " b", "".join(rng.choices("日本語文字", k=300))]
    return odd + [" ".join(rng.choices(words, k=rng.randint(1, 120))) for _ in range(30)]


def slow_all(text, hashing_words, mix):
    grams = slow_entries(text, hashing_words)
    out = []
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    values = [mix[signed(g)] % 2**64 >> 33 for g in grams]
    for i in range(max(1, len(values) - W.WINDOW + 1) if values else 0):
        span = values[i : i + W.WINDOW]
        least = min(span)
        at = i + max(j for j, v in enumerate(span) if v == least)
        if (least, at) not in out:
            out.append((least, at))
    return out


def test_matches_brute_force(documents, hashing):
    rows = [(5 * i, t) for i, t in enumerate(texts())] + [(15, "same id"), (15, "same id"), (None, "last one here")]
    frame = documents(rows).withColumn("own", F.lit("mine")).withColumn("part", F.lit(1))
    placed = hashing([t or "" for _, t in rows], "string")
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), placed[r[1] or ""]))
    plain = [t or "" for _, t in order]
    edited = []
    for i, t in enumerate(plain):
        half, after = len(t) // 2, plain[(i + 1) % len(plain)]
        edited.append(t[: len(t) - half] + after[:half])
    table = hashing([w for t in plain + edited for w in slow_words(t)], "string")
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    mix = hashing([signed(g) for t in plain + edited for g in slow_entries(t, table)], "long")
    prints = {t: slow_all(t, table, mix) for t in plain + edited}
    spell = lambda e: ",".join(f"{v:08x}:{p}" for v, p in e)

    def like(a, b):
        x, y = {v for v, _ in prints[a]}, {v for v, _ in prints[b]}
        return len(x & y) / len(x | y) if x | y else 1.0

    want = []
    for i, (doc, _) in enumerate(order):
        t, e, after = plain[i], edited[i], plain[(i + 1) % len(plain)]
        want.append((doc, len(t), hashlib.sha256(e.encode()).hexdigest(), spell(prints[t]), spell(prints[e]), like(t, e), like(t, after)))
    assert sorted([tuple(r) for r in W.edited_pairs(frame).collect()], key=repr) == sorted(want, key=repr)


def test_many_ranges_give_the_same(documents, monkeypatch):
    frame = documents([(i * i, t) for i, t in enumerate(texts())])
    one = sorted([tuple(r) for r in W.edited_pairs(frame).collect()])
    monkeypatch.setattr(W, "RANGE_BYTES", 500)
    assert sorted([tuple(r) for r in W.edited_pairs(frame).collect()]) == one


def test_a_shared_run_is_always_found(documents):
    rng = random.Random(1)
    run = " ".join(f"s{i}" for i in range(W.WINDOW + W.GRAM - 1))
    noise = lambda: " ".join(f"n{rng.random()}" for _ in range(rng.randint(0, 40)))
    frame = documents([(i, f"{noise()} {run} {noise()}") for i in range(20)]).select("doc_id", W.hashes(W.winnow(F.col("text"))).alias("h"))
    sets = [set(r.h) for r in frame.collect()]
    assert all(a & b for a in sets for b in sets)


def test_one_row_and_none(documents):
    only = W.edited_pairs(documents([(1, "one two three four five six")])).first()
    assert only.near_next == 1.0 and W.edited_pairs(documents([])).count() == 0


def test_null_and_repeated_ids_have_many_ranges(documents, monkeypatch):
    """A third of the rows has no id, a third one id: every range gives the same rows, and no range has a third of them."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"{i * 7919 % 1000} {'word ' * (i % 9)}") for i in range(600)]
    frame = documents(rows)
    one = sorted([tuple(r) for r in W.edited_pairs(frame).collect()], key=repr)
    monkeypatch.setattr(W, "RANGE_BYTES", 400)
    plain = frame.select(F.col("doc_id").alias("id"), "text")
    bounds, n = W._bounds(plain)
    parts = plain.crossJoin(bounds).select(W._range_of(W._order(), F.col("bounds"), n).alias("part")).groupBy("part").count().collect()
    assert len(parts) > 20 and max(r["count"] for r in parts) < 80
    assert sorted([tuple(r) for r in W.edited_pairs(frame).collect()], key=repr) == one


def test_a_shift_keeps_likeness_in_text_without_blanks(documents):
    """One character put before 3,000 without a blank changes next to nothing; other text of the same letters is unlike."""
    rng = random.Random(4)
    text, other = ("".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(3000)) for _ in range(2))
    got = {r.doc_id: r for r in W.edited_pairs(documents([(3, "字" + text), (2, text), (1, other)])).collect()}
    assert got[3].near_next > 0.99 and got[2].near_next == 0.0 and 0.2 < got[3].near_edited < 0.6


def test_a_shared_run_without_blanks_is_always_found(documents):
    rng = random.Random(5)
    noise = lambda: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(rng.randint(0, 60)))
    run = "".join(chr(0x3041 + i) for i in range(W.CUT + 1))
    frame = documents([(i, noise() + run + noise()) for i in range(30)]).select("doc_id", W.hashes(W.winnow(F.col("text"))).alias("h"))
    sets = [set(r.h) for r in frame.collect()]
    assert all(a & b for a in sets for b in sets)


def test_texts_that_begin_alike_have_many_ranges(documents, monkeypatch):
    """Rows without an id whose texts share a long beginning are dealt to many ranges."""
    frame = documents([(None, "the same beginning of every page " * 3 + str(i)) for i in range(400)]).select(F.col("doc_id").alias("id"), "text")
    monkeypatch.setattr(W, "RANGE_BYTES", 1000)
    bounds, n = W._bounds(frame)
    parts = frame.crossJoin(bounds).select(W._range_of(W._order(), F.col("bounds"), n).alias("part")).groupBy("part").count().collect()
    assert len(parts) > 10 and max(r["count"] for r in parts) < 120
