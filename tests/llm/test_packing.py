import itertools
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tripcraft.llm import packing
from tripcraft.llm.tokens import Encoder, default_vocabulary

PLAIN = Encoder(open(default_vocabulary(), encoding="utf-8").read()).tokenizer


def ids_of(text, end=packing.END_ID):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, end]


def check(pieces, docs, length):
    """Every id in exactly one piece, sequences gapless, none over the length, lengths powers of two."""
    sequences, whole = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
        whole[p.doc_id].append(p)
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= length and at & (at - 1) == 0
    assert set(whole) == {k for k, _ in docs}
    for k, text in docs:
        ids, at = ids_of(text), 0
        for p in sorted(whole[k], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], dtype="<u4").tobytes())
            at += p.length
        assert at == len(ids)
    return sequences


@pytest.mark.parametrize(("bits", "dims"), [(1, 2), (3, 2), (2, 3), (1, 6), (2, 4)])
def test_curve_visits_neighbours(bits, dims):
    """All points once, and each next one a step away."""
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)), dtype=np.int64)
    keys = packing.hilbert(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_registered_query(spark, sf01):
    docs = spark.read.parquet(f"{sf01}/documents.parquet").select("doc_id", "text")
    out = packing.op11_packing(spark, sf01)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    pieces = out.collect()
    assert sorted(map(tuple, pieces)) == sorted(map(tuple, out.collect()))
    check(pieces, [tuple(r) for r in docs.collect()], packing.LENGTH)


def test_neighbours_on_the_curve_are_alike(spark, sf01):
    texts = [r.text for r in spark.read.parquet(f"{sf01}/documents.parquet").orderBy("doc_id").collect()]
    vectors = packing.hashed([np.array(ids_of(t)) for t in texts])
    order = np.argsort(packing.hilbert(packing.grid(packing.projected(vectors, packing.signs()))), kind="stable")
    near = np.einsum("nd,nd->n", vectors[order[:-1]], vectors[order[1:]])
    apart = np.einsum("nd,nd->n", vectors[:-1], vectors[1:])
    assert np.median(near) > np.median(apart) + 0.1


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_edges(spark, partitions):
    rows = [(1, ""), (2, None), (3, "a"), (4, "long word " * 3000), (5, "\n\n  x"), (-6, "é中🙂<|endoftext|>")]
    rows += [(100 + k, "the same copy of a text") for k in range(300)]
    frame = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, ids string, n int").repartition(4)
    out = packing.packed(frame, length=64, partitions=partitions)
    pieces = out.selectExpr("doc_id", "start", "length", "crc32(ids) as ids_crc32", "doc_tokens", "sequence_id", "offset").collect()
    sequences = check(pieces, rows, 64)
    total = sum(len(ids_of(t)) for _, t in rows)
    assert len(sequences) <= total // 64 + 6 * partitions + 1
    assert packing.packed(frame.limit(0)).count() == 0


def test_repeated_rows_and_null_keys(spark):
    rows = [(None, "x y"), (None, "x y"), (7, "x y"), (7, "x y"), (7, "z")]
    pieces = packing.packed(spark.createDataFrame(rows, "doc_id long, text string"), length=4).collect()
    assert sum(p.length for p in pieces) == sum(len(ids_of(t)) for _, t in rows)
    starts = [(p.doc_id, p.start) for p in pieces]
    assert starts.count((None, 0)) == 2 and starts.count((7, 0)) == 3


def test_length_is_a_power_of_two(spark):
    with pytest.raises(ValueError, match="power of two"):
        packing.packed(spark.createDataFrame([(1, "a")], "doc_id long, text string"), length=100)


def test_a_hot_point_spans_partitions(spark):
    """Copies are on one point of the curve; their row numbers split them."""
    frame = spark.range(4000).selectExpr("id as doc_id", "'copy of one text' as text")
    out = packing.packed(frame, length=64, partitions=8).selectExpr("sequence_id div 8589934592 as p").groupBy("p").count().collect()
    assert len(out) == 8 and max(r["count"] for r in out) < 3 * min(r["count"] for r in out)
