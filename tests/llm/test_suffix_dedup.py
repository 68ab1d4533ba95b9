import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import suffix_dedup as S


def slow(rows, match):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i : i + match] for d in data for i in range(len(d) - match + 1))
    out = []
    for (doc, _), d in zip(rows, data, strict=True):
        gone = bytearray(len(d))
        for i in range(len(d) - match + 1):
            if seen[d[i : i + match]] > 1:
                gone[i : i + match] = b"\1" * match
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((doc, len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def make_rows(seed, n=60, match=200):
    rng = random.Random(seed)
    noise = lambda k: "".join(rng.choices("abcdefghij é", k=k))
    shared = [noise(k) for k in (match - 1, match, match + 1, match * 2, match * 6)]
    rows = [(i, "".join(rng.choice([noise(rng.randint(0, match)), rng.choice(shared)]) for _ in range(rng.randint(0, 5)))) for i in range(n)]
    whole = noise(match * 4)
    return rows + [(n, None), (n + 1, ""), (n + 2, "x" * (match * 4)), (n + 3, "ing " * match), (n + 4, whole), (n + 5, whole), (n + 6, whole[: match * 2] + "!" + whole[match * 2 :]), (None, noise(match * 2)), (3, "again" + whole), (3, "again" + whole)]


def got(frame, **k):
    return sorted([tuple(r)[:5] for r in S.remove_repeats(frame, **k).collect()], key=repr)


def test_matches_brute_force(documents):
    rows = make_rows(1)
    assert got(documents(rows).withColumn("spans", F.lit("mine")).withColumn("raw", F.lit(1))) == slow(rows, 200)


@pytest.mark.parametrize("shard_pieces", [2, 5])
def test_spread_anchors_are_merged_without_loss(documents, shard_pieces):
    rows = make_rows(2, match=24)
    assert got(documents(rows), match=24, gram=8, shard_pieces=shard_pieces, chunk_bytes=500) == slow(rows, 24)


def test_suffix_ranks_and_prefixes():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 400, dtype=np.uint8)
    raw = data.tobytes()
    order, rank = S.suffix_ranks(data, 37)
    keys = [raw[i : i + 37].ljust(37, b"\0") for i in range(len(raw))]
    assert [keys[i] for i in order] == sorted(keys)
    assert all((rank[i] == rank[j]) == (keys[i] == keys[j]) for i in range(0, 400, 7) for j in range(400))
    prefixes = S.common_prefixes(raw, order, np.arange(400), 37)
    place = {int(p): k for k, p in enumerate(order)}
    for i in range(400):
        if place[i]:
            a, b = raw[i : i + 37], raw[order[place[i] - 1] :][:37]
            assert prefixes[i] == next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def test_long_texts_go_in_blocks():
    data = bytes(np.random.default_rng(0).integers(97, 100, 5000, dtype=np.uint8))
    for block in (300, 5000):
        start, count, _ = S.pieces(data, 50, 16, block)
        assert start[0] == 0 and (start[1:] == (start + count)[:-1]).all() and start[-1] + count[-1] == len(data) - 49


def test_empty_table(documents):
    assert S.remove_repeats(documents([])).count() == 0


def test_colliding_anchors_change_nothing(documents, monkeypatch):
    """All pieces of all texts under two anchors: only bytes and digests tell them apart."""
    import pyarrow as pa

    def coarse(original):
        def run(batches, *a):
            for b in original(batches, *a):
                at = b.schema.names.index("anchor")
                columns = [pa.array(c.to_numpy() & 1) if i == at else c for i, c in enumerate(b.columns)]
                yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

        return run

    for name in ("_anchors", "_anchor_hashes"):
        monkeypatch.setattr(S, name, coarse(getattr(S, name)))
    for seed, pieces in ((5, 8192), (6, 7)):
        rows = make_rows(seed, n=25, match=24)
        assert got(documents(rows), match=24, gram=8, shard_pieces=pieces, chunk_bytes=2000) == slow(rows, 24)


def test_common_prefixes_decide(monkeypatch):
    """Windows that agree in 128 to 199 bytes reach Kasai and are refused by it; those of 200 pass."""
    asked = []
    real = S.common_prefixes
    monkeypatch.setattr(S, "common_prefixes", lambda *a: asked.append(real(*a)) or asked[-1])
    base = bytes(np.random.default_rng(3).integers(97, 123, 400, dtype=np.uint8))
    chunks = [base[:210], base[:199] + b"!" * 60, base[:150] + b"?" * 60, base[100:400], base[:205] + b"#" * 30]
    flags = S.repeated_windows(chunks)
    assert (asked[0] < 200).any() and (asked[0] == 200).any()
    seen = Counter(c[i : i + 200] for c in chunks for i in range(len(c) - 199))
    assert [f.tolist() for f in flags] == [[seen[c[i : i + 200]] > 1 for i in range(len(c) - 199)] for c in chunks]


def test_spans_of_repeated_rows_grow_with_the_text_not_with_the_rows(documents):
    """2,000 equal rows without an id: each meets the text's spans once."""
    text = "".join(chr(97 + i * i % 23) for i in range(700))
    rows = [(None, text)] * 2000 + [(1, text[:300]), (2, "clean")]
    raw = documents(rows).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("tag"), F.col("text").cast("binary").alias("raw"))
    few = documents([(None, text)] * 2).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("tag"), F.col("text").cast("binary").alias("raw"))
    spans = lambda df: S.repeated_spans(df).where("id IS NULL").select(F.size("spans")).first()[0]
    assert spans(raw) <= 2 * spans(few) + 4
    done = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in S.remove_repeats(documents(rows)).distinct().collect()}
    assert done == {None: (700, 700, 1), 1: (300, 300, 1), 2: (5, 0, 0)}
