import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from strataflow.llm import simhash as S


def slow_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 3 else [" ".join(words)]
    values = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def slow_components(prints):
    """{fp: set of fps reachable at 2 or fewer bits}."""
    fps, left, out = sorted(set(prints)), set(prints), {}
    while left:
        todo, seen = [left.pop()], set()
        while todo:
            x = todo.pop()
            seen.add(x)
            near = {y for y in left if (x ^ y).bit_count() <= 2}
            left -= near
            todo += near
        out |= dict.fromkeys(seen, seen)
    assert set(out) == set(fps)
    return out


def check(rows, got):
    prints = [(i, slow_print(t)) for i, t in rows]
    groups = slow_components([p for _, p in prints])
    least = {p: min((i for i, q in prints if q in groups[p] and i is not None), default=None) for _, p in prints}
    assert sorted([tuple(r) for r in got.collect()], key=repr) == sorted([(i, f"{p:016x}", least[p]) for i, p in prints], key=repr)


def near_rows(n, seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeéß", k=rng.randint(1, 7))) for _ in range(300)]
    base = rng.choices(words, k=400)
    rows = [(0, None), (1, ""), (2, " \n"), (3, "A b"), (4, "a B"), (5, "a b c"), (6, "a b c d"), (7, "x" * 50_000)]
    for i in range(n):
        copy = list(base) if i % 3 else rng.choices(words, k=rng.randint(1, 40))
        copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append((10 + i, " ".join(copy)))
    return rows


def test_matches_brute_force(documents):
    rows = [*near_rows(150), (500, "A b"), (500, "A b"), (None, "q r s t u v")]
    check(rows, S.near_groups(documents(rows)))


def test_large_nodes_are_opened_without_loss(documents):
    rows = near_rows(150, seed=6)
    check(rows, S.near_groups(documents(rows), node_cap=3))


def test_trie_join_finds_every_pair():
    rng = np.random.default_rng(0)
    center = rng.integers(0, 2**63, dtype=np.uint64)
    values = {int(center)}
    for _ in range(400):
        v = int(center)
        for b in rng.integers(0, 64, rng.integers(0, 5)):
            v ^= 1 << int(b)
        values.add(v)
    values = np.array(sorted(values), dtype=np.uint64)
    found = {(int(a), int(b)) for x, y in S.trie_pairs(values, None, 64, 0, 2, most=50) for a, b in zip(*np.sort([x, y], axis=0), strict=True)}
    want = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if (int(values[i]) ^ int(values[j])).bit_count() <= 2}
    assert found == want


def test_empty_and_clashing_columns(documents):
    assert S.near_groups(documents([])).count() == 0
    frame = documents([(1, "a b c d e"), (2, "a b c d e"), (3, "w")]).withColumn("fp", F.lit("x")).withColumn("component_id", F.lit(9))
    left = S.drop_near_copies(frame)
    assert left.columns == frame.columns and {r.doc_id for r in left.collect()} == {1, 3}


def test_repeated_ids_keep_only_the_row_their_group_picks(documents):
    rows = [(7, "a b c d e"), (7, "p q r s t"), (7, "a b c d e"), (3, "a  b c d e"), (None, "p q r s t"), (None, "u v w x y z")]
    frame = documents(rows).withColumns({"key": F.lit(1), "a.b": F.lit(2)})
    left = S.drop_near_copies(frame)
    assert left.columns == frame.columns
    assert sorted([(r.doc_id, r.text) for r in left.collect()], key=repr) == sorted([(3, "a  b c d e"), (7, "p q r s t"), (None, "u v w x y z")], key=repr)
