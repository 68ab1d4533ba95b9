import random

import numpy as np
import pytest

from strataflow.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, score string, anchor string"


def slow(rows, windows=H.Windows()):
    """The contract in plain Python: rows of (id, vector, label)."""
    good = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label) for i, v, label in rows if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    anchors = {}
    for i, q, label in good:
        if i is not None and i % 50 == 0:
            anchors[i] = min(anchors.get(i, (str(label), q)), (str(label), q))
    out = []
    for a, (la, qa) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(qa, q, strict=False)), i is None, i or 0, str(label) == la) for i, q, label in good if i != a)
        name = lambda null, i: None if null else i
        for ps, pnull, p, _ in [s for s in scored if s[3]][: windows.positives]:
            fit = [s for s in scored if not s[3] and windows.low * -ps <= 100 * -s[0] <= windows.high * -ps]
            out += [(a, name(pnull, p), k, name(null, i), -ps, -s) for k, (s, null, i, _) in enumerate(fit[: windows.negatives], 1)]
    return out


def mined(df):
    return sorted([tuple(r) for r in H.hard_negatives(df, H.anchored(), H.relabelled()).collect()], key=repr)


@pytest.fixture
def embeddings(spark):
    return lambda rows: spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def drawn(rng, n, width=6, labels=3):
    return [(i, [round(rng.uniform(-1, 1), 2) for _ in range(width)], rng.randrange(labels)) for i in range(n)]


def test_equals_brute_force_in_any_blocks(embeddings, monkeypatch):
    rows = drawn(random.Random(3), 420)
    df = embeddings(rows)
    want = sorted(slow(rows), key=repr)
    assert len(want) > 60
    assert mined(df) == want
    monkeypatch.setattr(H, "BLOCK_BYTES", 6 * 8 * 40)  # 11 blocks of rows
    monkeypatch.setattr(H, "_blocks", lambda n, *_: max(1, n // 40))
    monkeypatch.setattr(H, "AT_ONCE", 2)
    assert mined(df) == want


def test_ties_repeats_nulls_and_odd_vectors(embeddings):
    rng = random.Random(5)
    rows = drawn(rng, 120, 3, 2)
    common = [0.5, 0.25, -0.125]
    rows += [(200 + i, common, i % 3) for i in range(60)]  # a very common vector, an anchor among them
    rows += [(250, common, 1), (250, [0.5, 0.5, 0.5], 1), (260, common, 2), (260, common, 2)]  # repeated ids
    rows += [(None, common, 1), (None, [0.1, 0.9, 0.2], 0), (300, None, 1), (301, [0.5, None, 0.1], 1), (302, [float("nan"), 0.1, 0.1], 1), (303, [float("inf"), 0.0, 0.0], 0), (304, common, None)]
    rows += [(350, [], 1), (351, [0.5], 1), (352, [0.5, 0.25, -0.1, 0.7], 1), (400, [0.0, 0.0, 0.0], 1), (401, [0.0, 0.0, 0.0], 1), (450, [-0.9, -0.9, -0.9], 2), (451, [0.9, 0.9, 0.9], 2)]
    assert mined(embeddings(rows)) == sorted(slow(rows), key=repr)


def test_scores_beyond_floating_point_are_exact(embeddings):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(-1, 1) * 1e6 for _ in range(4)], i % 2) for i in range(120)]
    assert mined(embeddings(rows)) == sorted(slow(rows), key=repr)
    a = np.array([[1 << 62, 5], [3, -4]])
    assert H.inner(a, a).tolist() == [[1 << 62, 3 * (1 << 62) - 20 if 3 * (1 << 62) - 20 < 1 << 62 else 1 << 62], [1 << 62, 25]]


def test_empty_tables_and_no_anchors(embeddings):
    assert mined(embeddings([])) == []
    assert mined(embeddings([(1, [0.1], 1), (2, [0.2], 1)])) == []
    assert mined(embeddings([(50, [0.1], 1)])) == []


def test_keys_sort_as_their_parts():
    rng = random.Random(1)
    parts = [(rng.randrange(-3, 3), rng.randrange(-(1 << 62), 1 << 62) if rng.random() < 0.5 else rng.randrange(-2, 3), rng.randrange(2), rng.choice([None, -5, 0, 7, 1 << 60])) for _ in range(500)]
    assert all(H.unpack(H.pack(*p)) == p for p in parts)
    plain = lambda p: (p[0], -p[1], p[2], p[3] is None, p[3] or 0)
    assert sorted(parts, key=lambda p: H.pack(*p)) == sorted(parts, key=plain)


def test_windows_close_once_full_or_passed():
    seen = []

    def keys():
        for key in [(1, 100, 0, 5), (1, 96, 1, 6), (1, 95, 1, 7), (1, 90, 0, 8), (1, 80, 1, 9), (1, 60, 1, 10), (1, 40, 1, 11), (2, 10, 1, 12)]:
            seen.append(key)
            yield H.pack(*key), None

    got = list(H.emit(keys(), H.Windows()))
    assert got == [(1, 5, 1, 7, 100, 95), (1, 5, 2, 9, 100, 80), (1, 8, 1, 9, 90, 80), (1, 5, 3, 10, 100, 60), (1, 8, 2, 10, 90, 60)]


def test_other_windows(spark, embeddings):
    rows = drawn(random.Random(9), 150)
    w = H.Windows(2, 1, 20, 60)
    got = H.hard_negatives(embeddings(rows), H.anchored(), H.relabelled(), windows=w).select(*[c.split()[0] for c in H.SCHEMA.split(", ")])
    assert sorted([tuple(r) for r in got.collect()], key=repr) == sorted(slow(rows, w), key=repr)
