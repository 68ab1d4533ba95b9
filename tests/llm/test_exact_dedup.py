import hashlib
import random

from pyspark.sql import functions as F

from strataflow.llm import exact_dedup as X


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(str.maketrans("", "", " \t\n\x0b\x0c\r")), []).append((-len(t or ""), i is None, i))
    best = {k: min(v, key=lambda x: (x[0], x[1], x[2] or 0))[2] for k, v in groups.items()}
    out, stays = [], set()
    for i, t in rows:
        k = (t or "").translate(str.maketrans("", "", " \t\n\x0b\x0c\r"))
        kept = i == best[k] and k not in stays and (-len(t or ""), i is None, i) == min(groups[k], key=lambda x: (x[0], x[1], x[2] or 0))
        stays |= {k} if kept else set()
        out.append((i, best[k], len(groups[k]), kept, hashlib.sha256(k.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_matches_brute_force_with_nulls_ties_and_long_texts(documents):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a b", "ab", "a  b", "ä b\x0b", "äb", "x" * 200_000, "x" * 199_999 + " x", "\xa0a", "a"]
    rows = [(i, rng.choice(texts)) for i in range(60)] + [(100, "a b"), (100, "a b"), (None, "only"), (None, "on ly"), (None, "on ly"), (None, "o nly"), (7, "x y"), (7, "x  y"), (7, "x\ty ")]
    got = X.exact_groups(documents(rows), chunk=1000)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute(rows)


def test_fingerprints_compose():
    data = bytes(random.Random(1).randbytes(10_000))
    whole = X.fingerprint(data, 16_384)
    for cut in (0, 1, 4096, 9_999, 10_000):
        assert X.combine(X.fingerprint(data[:cut], 64), X.fingerprint(data[cut:], 1000)) == whole


def test_collisions_are_told_apart(documents, monkeypatch):
    """With a fingerprint that sees only the length, different texts of one length stay apart."""
    rows = [(1, "abc"), (2, "abd"), (3, "a bc"), (4, "xyz")]
    real = X.exact_groups
    frame = documents(rows)
    import strataflow.llm.exact_dedup as module

    def weak(batches, size):
        for batch in batch_only_length(module._fingerprints.__wrapped__(batches, size) if hasattr(module._fingerprints, "__wrapped__") else original(batches, size)):
            yield batch

    import pyarrow as pa

    original = module._fingerprints

    def batch_only_length(found):
        for b in found:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([7] * b.num_rows, pa.int64()), b.column(3), b.column(4)], names=b.schema.names)

    monkeypatch.setattr(module, "_fingerprints", lambda batches, size: batch_only_length(original(batches, size)))
    assert sorted([tuple(r) for r in real(frame).collect()], key=repr) == brute(rows)


def test_empty_table_and_drop_copies_keep_columns(documents):
    assert X.exact_groups(documents([])).count() == 0
    frame = documents([(1, "a"), (2, " a"), (3, None)]).withColumn("kept", F.lit("mine")).withColumn("fp", F.lit(1))
    left = X.drop_copies(frame)
    assert left.columns == frame.columns
    assert {r.doc_id for r in left.collect()} == {2, 3}


def test_drop_copies_keeps_every_text_on_null_and_repeated_ids(documents):
    """One row of each group of equal texts, whatever the ids: none lost, none twice."""
    rows = [(None, "p q"), (None, "r"), (None, "pq"), (None, "s"), (7, "t"), (7, "u"), (7, "t "), (9, "t"), (9, "v"), (7, "u"), (8, "w  x"), (8, "w x"), (8, "wx"), (None, None)]
    left = sorted([(r.doc_id, r.text) for r in X.drop_copies(documents(rows)).collect()], key=repr)
    assert left == sorted([(None, "p q"), (None, "r"), (None, "s"), (7, "t "), (7, "u"), (9, "v"), (8, "w  x"), (None, None)], key=repr)


def test_null_ids_send_each_text_once(documents, spark, monkeypatch):
    """Two thousand rows without an id, in forty groups of equal texts: as many chunk rows as rows."""
    sent = spark.sparkContext.accumulator(0)
    original = X._chunks

    def counted(batches, size):
        for batch in original(batches, size):
            sent.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(X, "_chunks", counted)
    rows = [(None if i % 2 else 7, f"text {i % 40} {' ' * (i % 50)}") for i in range(4000)]
    assert sorted([tuple(r) for r in X.exact_groups(documents(rows)).collect()], key=repr) == brute(rows)
    assert 0 < sent.value <= len(rows)


def test_any_column_names(documents):
    frame = documents([(1, "a"), (2, " a"), (3, None)]).withColumns({"key": F.lit(1), "__key": F.lit(2), "a.b": F.lit(3), "KEY_": F.lit(4)})
    left = X.drop_copies(frame)
    assert left.columns == frame.columns and sorted(r[0] for r in left.collect()) == [2, 3]
    dotted = frame.withColumnsRenamed({"doc_id": "doc.id", "text": "the.text"})
    assert sorted(r[0] for r in X.drop_copies(dotted, "doc.id", "the.text").collect()) == [2, 3]
