import collections
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from strataflow.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def slow(rows, least=10, ranks=10):
    """The contract in plain Python: rows of (text, lang, source)."""
    cut = [(TERM.findall((t or "").translate(LOWER)), lang or "", source or "") for t, lang, source in rows]
    docs = collections.Counter((lang, w) for words, lang, _ in cut for w in set(words))
    kept = {k for k, n in docs.items() if n >= least}
    count, groups = collections.Counter(), {(lang, source) for _, lang, source in cut}
    for words, lang, source in cut:
        count.update((lang, source, w) for w in words if (lang, w) in kept)
    out = []
    for lang in {g[0] for g in groups}:
        terms, sources = sorted(w for x, w in kept if x == lang), sorted(s for x, s in groups if x == lang)
        share = lambda n, total: 1 + 1_000_000_000 * (n + 2) // (total + 2 * len(terms))  # noqa: B023, E731
        apart = lambda p, q: (p - q) ** 2 // (p + q)
        total = {s: sum(count[lang, s, w] for w in terms) for s in sources}
        p = {s: [share(count[lang, s, w], total[s]) for w in terms] for s in sources}
        q = [share(sum(count[lang, s, w] for s in sources), sum(total.values())) for w in terms]
        for s in sources:
            pairs = sorted((-sum(map(apart, p[s], p[o])), o.encode(), o) for o in sources if o != s)
            out += [(lang, s, "pair", o, -v, k) for k, (v, _, o) in enumerate(pairs, 1)]
            best = sorted((-apart(a, b), w.encode(), w) for a, b, w in zip(p[s], q, terms, strict=True) if count[lang, s, w] and a > b)
            out += [(lang, s, "term", w, -v, k) for k, (v, _, w) in enumerate(best[:ranks], 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, "a", 1) for r in rows], "text string, lang string, source string, prefix string, n int")


def audit(spark, rows):
    return sorted(tuple(r) for r in D.divergence(table(spark, rows)).collect())


def drawn(rng, n):
    words = ["the", "The", "THEN", "thence", "thenceforth", "thenceforthward", "é", "éa", "日本語", "日本", "x" * 70, "x" * 64 + "y", "a", "ab", "abcd", "abcde", "abcdefgh", "abcdefghi", "mixed-case", "z9z"]
    words += ["".join(rng.choices("abß日", k=rng.randrange(1, 12))) for _ in range(40)]
    weigh = [[rng.random() ** 3 for _ in words] for _ in range(4)]
    return [(rng.choice([" ", "\n", ", ", "1"]).join(rng.choices(words, weigh[i % 4], k=rng.randrange(0, 30))), rng.choice(["en", "de", None, ""]), rng.choice(["s", "s", "s", "a", "Ä", None, "b"])) for i in range(n)]


def test_equals_brute_force(spark):
    rows = drawn(random.Random(2), 260)
    rows += [(None, "en", "only nulls"), ("...", "fr", "one"), ("word", "fr", "two"), (None, "fr", "one"), ("same text again", "en", "s")] + [("same text again", "en", "s")] * 11
    want = slow(rows)
    assert {r[2] for r in want} == {"pair", "term"} and any(len(r[3]) > 60 for r in want)
    assert audit(spark, rows) == want


def test_small_blocks_and_slices_change_nothing(spark, monkeypatch):
    rows = drawn(random.Random(4), 150)
    want = slow(rows)
    for name, value in (("BLOCK", 2), ("SLICE_ROWS", 30)):
        monkeypatch.setattr(D, name, value)
    assert audit(spark, rows) == want
    monkeypatch.setattr(D, "FILTER_BITS", 1 << 15)  # a small filter lets much in by chance
    assert audit(spark, rows) == want


def test_no_documents_and_no_terms(spark):
    assert audit(spark, []) == []
    rows = [("few words", "en", s) for s in "abc"]
    assert audit(spark, rows) == slow(rows) == sorted(("en", s, "pair", o, 0, k) for s in "abc" for k, o in enumerate([x for x in "abc" if x != s], 1))


def test_tiles_compare_terms_in_parts(monkeypatch):
    groups = pa.table({"lang": ["en"] * 3, "place": [0, 1, 2], "absent": [5, 9, 4], "block": [0, 0, 0], "bi": [0] * 3, "bj": [0] * 3})
    terms = pa.table({"prefix": [bytes([97 + t]) for t in range(7) for _ in range(2)], "place": [p for t in range(7) for p in {t % 3, (t + 1) % 3}], "p": list(range(10, 24))})
    whole = D._tile(terms, groups)
    monkeypatch.setattr(D, "AT_ONCE", 3)
    assert D._tile(terms, groups) == whole and whole.column("n").to_pylist() == [7] * 3


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_incidences_of_slices(piece, monkeypatch):
    monkeypatch.setattr(D, "PIECE", piece)
    texts = ["", "Ab ab", "", "ab", "ümläut ümläut x", "", "x" * 50 + " tail", ""]
    for at in range(len(texts)):
        part = pa.array([t + " " for t in texts])[at:]
        terms, doc, code, count = D.incidences(part)
        got = sorted((d, terms[c].as_py().decode(), n) for d, c, n in zip(doc.tolist(), code.tolist(), count.tolist(), strict=True))
        assert got == sorted((d, w, n) for d, t in enumerate(texts[at:]) for w, n in collections.Counter(TERM.findall(t.translate(LOWER))).items())


def test_prefixes_are_discarded_level_by_level(spark):
    """Passes see only what extends a survivor: a long term of few documents is never counted at full length."""
    rows = [("commonword " + f"rare{i:03d}".replace("0", "a").replace("1", "b").replace("2", "c"), "en", "s") for i in range(12)]
    docs = D._plain(table(spark, rows), "text", "lang", "source")
    first = {(r.prefix.decode() if isinstance(r.prefix, (bytes, bytearray)) else r.prefix, r.whole) for r in D.level(docs, 0, 4, None).collect()}
    assert first == {("comm", False), ("rare", False)} | {x for x in first if x[0] not in ("comm", "rare")}
    bits = D.filter_of(spark.createDataFrame([("en", b"comm")], "lang string, prefix binary"))
    assert int(np.unpackbits(bits).sum()) == 1
    assert D._passing(bits, ["de", "en"], np.array([0, 1, 1]), pa.array([b"comm", b"rare"]), np.array([0, 0, 1])).tolist() == [False, True, False]
    second = D.level(docs, 4, 8, spark.sparkContext.broadcast(bits)).collect()
    assert {bytes(r.prefix) for r in second} == {b"commonwo"} and sum(r.docs for r in second) == 12
    assert {bytes(r.prefix) for r in D.kept_terms(docs).collect()} == {b"commonword"}


def test_sql_says_the_same(spark):
    rows = drawn(random.Random(8), 120)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    assert sorted(con.execute(D.ORACLE).fetchall()) == slow(rows) == audit(spark, rows)
