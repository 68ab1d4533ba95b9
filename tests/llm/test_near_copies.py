import random

import corpus_pipeline
from pyspark.sql import functions as F

from strataflow.llm import near_copies as N


def grams(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 5 else {tuple(words)} - {()}


def similarity(x, y):
    return len(x & y) / len(x | y) if x | y else 0


def brute(rows):
    """One (id, text) of each component of pairs at 0.8 or more, over all pairs."""
    sets = [(i, t, grams(t)) for i, t in rows]
    root = list(range(len(sets)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(sets)):
        for j in range(i):
            if similarity(sets[i][2], sets[j][2]) >= 0.8 or not (sets[i][2] or sets[j][2]):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(sets)):
        groups.setdefault(find(i), []).append(rows[i])
    return groups.values()


def planted(seed=9):
    """Documents of some hundred words, and for each a copy of a similarity between 0.75 and 0.99."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(2000)]
    rows = []
    for i in range(60):
        base = rng.choices(words, k=rng.randint(120, 500))
        copy = list(base)
        for at in rng.sample(range(len(copy)), max(1, round(len(copy) * (i % 6) * 0.0042))):
            copy[at] = "new" + str(at)
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
    return rows


def test_copies_from_08_to_098_are_dropped(spark, sf, documents):
    rows = planted()
    near = [similarity(grams(rows[i][1]), grams(rows[i + 1][1])) for i in range(0, len(rows), 2)]
    assert sum(0.8 <= s <= 0.98 for s in near) >= 30 and min(near) < 0.85
    frame = documents(rows).withColumn("lang", F.lit("en"))
    left = {r.doc_id for r in corpus_pipeline.near(spark, frame, sf).collect()}
    assert left == {min(i for i, _ in g) for g in brute(rows)}


def test_chains_nulls_and_repeated_ids(documents):
    rng = random.Random(1)
    words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    chain = [(10 + k, " ".join([*(f"c{k}n{j}" for j in range(4 * k)), *words[4 * k :]])) for k in range(12)]
    odd = [(1, None), (2, ""), (None, "a b"), (None, "c d e f g h"), (None, "A  b"), (3, "x y z"), (3, "p q r"), (4, "x y  z"), (4, "p q r")]
    rows = [*chain, *odd]
    left = N.drop_near_copies(documents(rows).withColumn("node", F.lit(1)))
    assert left.columns[-1] == "node"
    got = sorted([(r.doc_id, r.text) for r in left.collect()], key=repr)
    groups = list(brute(rows))
    assert len(got) == len(groups) and all(sum(r in g for r in got) == 1 for g in groups)
    assert all((r[0] is None) == all(i is None for i, _ in g) and r[0] == min((i for i, _ in g if i is not None), default=None) for g in groups for r in got if r in g)
    assert N.drop_near_copies(documents([])).count() == 0


def test_a_common_passage_costs_rows_and_not_pairs(documents, spark, monkeypatch):
    """Six hundred texts share most of their words; few of them are near copies, which are found, and few pairs are read."""
    rng = random.Random(4)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(60))
    texts = [passage + " " + " ".join(f"u{rng.randrange(10**7)}" for _ in range(rng.randint(14, 30))) for _ in range(600)]
    copies = []
    for t in texts[::20]:
        words = t.split()
        words[-1] = "edited"
        copies.append(" ".join(words))
    rows = list(enumerate(texts + copies))
    real, read = N.rare_pairs, []

    def counted(*a):
        out = real(*a)
        read.append(out.count())
        return out

    monkeypatch.setattr(N, "rare_pairs", counted)
    left = sorted(r.doc_id for r in N.drop_near_copies(documents(rows)).collect())
    assert left == sorted(min(i for i, _ in g) for g in brute(rows))
    assert read[0] < len(rows)


def test_rare_pairs_are_all_that_are_similar(spark):
    """Over random sets, every pair of different roots at 0.8 or more is a candidate."""
    import numpy as np

    rng = random.Random(8)
    base = [rng.sample(range(300), rng.randint(5, 40)) for _ in range(12)]
    sets = [{*rng.sample(b, len(b) - rng.randint(0, len(b) // 6)), *rng.sample(range(300), rng.randint(0, 3))} for b in base for _ in range(12)]
    rows = [(bytes([i]), bytes([i // 3]), bytearray(np.array(sorted(s), dtype=np.uint64).tobytes())) for i, s in enumerate(sets)]
    frame = spark.createDataFrame(rows, "node binary, root binary, grams binary")
    got = {(r.a[0], r.b[0]) for r in N.rare_pairs(frame.select("node", "grams"), frame.select("node", "root")).collect()}
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if i // 3 != j // 3 and similarity(sets[i], sets[j]) >= 0.8}
    assert len(want) > 20 and want <= got


def variants(n, seed=5):
    """n texts that each change from 0 to 14 words of one text of 150; every third one changes a word more of the text before it."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(150)]
    texts = []
    for k in range(n):
        words = texts[-1].split() if k % 3 == 2 else list(base)
        for at in rng.sample(range(150), 1 if k % 3 == 2 else rng.randint(0, 14)):
            words[at] = f"v{k}n{at}"
        texts.append(" ".join(words))
    return texts


def test_variants_of_one_text_cost_rows_and_not_pairs(documents, monkeypatch):
    """Most of five hundred variants are 0.5 to 0.8 similar: components are those of brute force, and candidates fewer than texts."""
    rows = list(enumerate(variants(500)))
    real, read = N.rare_pairs, []

    def counted(*a):
        out = real(*a)
        read.append(out.count())
        return out

    monkeypatch.setattr(N, "rare_pairs", counted)
    left = sorted(r.doc_id for r in N.drop_near_copies(documents(rows)).collect())
    want = sorted(min(i for i, _ in g) for g in brute(rows))
    assert left == want and 50 < len(want) < 450
    assert read[0] < len(rows)


def test_star_and_pairs_of_differences_join_all_that_are_similar(spark):
    """Without any links known before: star links and candidates, checked, give the components of all similar pairs."""
    import numpy as np
    import xxhash

    texts = variants(90, 6) + [t.replace("b1", "c1") for t in variants(40, 7)]
    sets = [grams(t) for t in texts]
    data = [np.array(sorted(xxhash.xxh64_intdigest(" ".join(g)) for g in s), dtype=np.uint64).tobytes() for s in sets]
    rows = [(bytes([i]), bytes([i]), bytearray(d)) for i, d in enumerate(data)]
    frame = spark.createDataFrame(rows, "node binary, root binary, grams binary")
    plain, nodes = frame.select("node", "grams"), frame.select("node", "root")
    apart = N.differences(plain, nodes)
    star = N._star(apart)
    sure = N._checked(N._pairs(star.select("node", "top")), plain, 0.8)
    rest = N._checked(N.rare_pairs(apart.select("node", "grams"), N._relabelled(apart, star, sure)), plain, 0.8)
    root = list(range(len(sets)))
    find = lambda i: i if root[i] == i else find(root[i])
    got = [(r.a[0], r.b[0]) for r in sure.union(rest).collect()]
    assert all(similarity(sets[i], sets[j]) >= 0.8 for i, j in got) and star.count() > 10
    for i, j in got:
        root[find(i)] = find(j)
    want = [(i, j) for i in range(len(sets)) for j in range(i) if similarity(sets[i], sets[j]) >= 0.8]
    assert len(want) > 100 and all(find(i) == find(j) for i, j in want)
    assert len({find(i) for i in range(len(sets))}) > 10
