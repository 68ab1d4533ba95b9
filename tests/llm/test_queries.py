"""The registered queries on the smallest tables, against plain versions."""

import collections
import unicodedata
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strataflow.llm import divergence, exact_dedup, hard_negatives, language_id, queries

from .test_bpe import digests
from .test_exact_dedup import brute
from .test_mixing import slow_targets
from .test_pii import slow_base
from .test_rank_bpe import PATH as RANKS
from .test_rank_bpe import digests as rank_digests
from .test_simhash import slow_components, slow_print
from .test_suffix_dedup import slow as slow_repeats
from .test_url_filter import slow_verdicts

Q = queries.queries()


@pytest.fixture(scope="module")
def docs(sf):
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{sf}/documents.parquet'").fetchall()


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_names():
    assert [int(n[2:].split("_")[0]) for n in Q] == list(range(1, 14))


def test_op1(spark, sf, docs):
    tool, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in Q["op1_token_records"](spark, sf).collect()}
    for i, t, *_ in sorted(docs):
        ids = [*tool.encode(t or "", add_special_tokens=False).ids, 2]
        assert got[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_op2(spark, sf, docs):
    tool = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert rows(Q["op2_bpe"](spark, sf)) == sorted([(i, *digests(tool, t or "")) for i, t, *_ in docs], key=repr)


def test_op3(spark, sf, docs):
    got = {r.doc_id: r for r in Q["op3_winnowing"](spark, sf).collect()}
    order = sorted(docs, reverse=True)
    prints = collections.defaultdict(set)
    for (i, t, *_), (_, after, *_) in zip(order, order[1:] + order[:1], strict=True):
        import hashlib

        half = len(t) // 2
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()
        prints[t].add(got[i].fingerprint)
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert all(len(p) == 1 for p in prints.values())
    long = [got[i] for i, t, *_ in docs if len(t.split()) > 100]
    assert np.mean([r.near_edited for r in long]) > 0.25


def test_op4(spark, sf, docs):
    prints = [(i, slow_print(t)) for i, t, *_ in docs]
    groups = slow_components([p for _, p in prints])
    least = {p: min(i for i, q in prints if q in groups[p]) for _, p in prints}
    assert rows(Q["op4_simhash_dedup"](spark, sf)) == sorted([(i, f"{p:016x}", least[p]) for i, p in prints], key=repr)


def test_op5(spark, sf, docs):
    assert rows(Q["op5_suffix_dedup"](spark, sf)) == slow_repeats([d[:2] for d in docs], 200)


def test_op6(spark, sf, docs):
    sizes, taken, source = collections.Counter(), collections.Counter(), {d[0]: d[3] for d in docs}
    got = Q["op6_mixing"](spark, sf).collect()
    for r in got:
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
    want = slow_targets(dict(sizes))
    assert all(r.target == pytest.approx(want[source[r.doc_id]]) and r.taken <= 3 * r.size for r in got)
    most = collections.defaultdict(int)
    for r in got:
        most[source[r.doc_id]] = max(most[source[r.doc_id]], r.size)
    assert all(abs(taken[s] - want[s]) <= most[s] for s in sizes)


def test_op7(spark, sf, docs):
    lang = {d[0]: d[2] for d in docs}
    got = Q["op7_language_id"](spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.9 * len(held)


def slow_grams(text):
    """1- to 3-grams of a text's letter runs, padded by a blank, packed by code points."""
    runs = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in (text or "").lower()).split()
    pack = lambda s: sum(ord(c) << 21 * i for i, c in enumerate(s))
    out = collections.Counter()
    for w in runs:
        padded = f" {w} "
        out.update(pack(c) for c in w)
        out.update(pack(padded[i : i + 2]) for i in range(len(padded) - 1))
        out.update(pack(padded[i : i + 3]) for i in range(len(padded) - 2))
    return out


def test_op7_against_a_plain_version(spark, sf, docs):
    """Profiles and out-of-place distances by counting in plain Python; every language is under the sample bound here."""
    totals = collections.defaultdict(collections.Counter)
    for i, t, lang, _ in docs:
        if zlib.crc32(str(i).encode()) % 5 and lang is not None and t is not None:
            totals[lang] += slow_grams(t)
    ranked = lambda c, n: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:n]]
    ranks = {lang: {g: k for k, g in enumerate(ranked(c, language_id.PROFILE_SIZE))} for lang, c in totals.items()}
    size = max(map(len, ranks.values()))
    got = {r.doc_id: (r.lang_pred, r.score) for r in Q["op7_language_id"](spark, sf).collect()}
    for i, t, *_ in docs:
        own = ranked(slow_grams(t), language_id.DOC_SIZE)
        apart = {lang: sum(abs(r[g] - k) if g in r else size for k, g in enumerate(own)) for lang, r in sorted(ranks.items())}
        lang = min(apart, key=apart.get) if own else "und"
        assert got[i][0] == lang and got[i][1] == pytest.approx(1 - apart[lang] / (size * len(own)) if own else 0.0)


def test_op8(spark, sf):
    pages = duckdb.sql(f"SELECT page_id, url, html FROM '{sf}/pages.parquet'").fetchall()
    assert [r[:5] for r in rows(Q["op8_url_filter"](spark, sf))] == [w[:5] for w in sorted(slow_verdicts(pages), key=repr)]


def test_op9(spark, sf, docs):
    got = rows(Q["op9_exact_dedup"](spark, sf))
    assert got == brute([d[:2] for d in docs])
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert got == sorted(duckdb.sql(exact_dedup.ORACLE).fetchall(), key=repr)


def test_op10(spark, sf, docs):
    import hashlib

    got = {r.doc_id: r for r in Q["op10_pii"](spark, sf).collect()}
    for i, t, *_ in docs:
        base = slow_base(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(got[i].spans.split(",")) | {""}


def test_op11(spark, sf, docs):
    import base64

    import tiktoken

    with open(RANKS, "rb") as f:
        tool = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, special_tokens={})
    assert rows(Q["op11_rank_bpe"](spark, sf)) == sorted([(i, *rank_digests(tool, t or "")) for i, t, *_ in docs], key=repr)


def test_op13(spark, sf):
    got = Q["op13_hard_negatives"](spark, sf)
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = duckdb.sql(hard_negatives.ORACLE)
    assert got.columns == want.columns
    assert rows(got) == sorted(want.fetchall(), key=repr)


def test_op12(spark, sf):
    got = Q["op12_source_divergence"](spark, sf)
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = duckdb.sql(divergence.ORACLE)
    assert got.columns == want.columns
    assert rows(got) == sorted(want.fetchall(), key=repr)
