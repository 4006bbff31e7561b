from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from locusweave.llm import packing, tokens
from locusweave.llm.packing import Packer, tail_lengths

from .conftest import DATA, needs_data


def test_curve_visits_neighbours():
    bits, dims = 3, 3
    grid = np.stack(np.meshgrid(*[np.arange(2**bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    keys = packing.hilbert_keys(grid, bits)
    assert sorted(keys) == list(range(2 ** (bits * dims)))
    path = grid[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=30), st.sampled_from([1, 8, 16]))
def test_packer_keeps_every_id(lengths, size):
    packer, pieces, given_ids = Packer(size, 5), [], {}
    for n, length in enumerate(lengths):
        ids = np.arange(length, dtype="<u4") + 1000 * n
        given_ids[n] = ids
        pieces += packer.add((n, 0), ids)
    pieces += packer.finish()
    back, filled = defaultdict(bytes), defaultdict(int)
    for doc_id, start, length, raw, total, sequence, offset, _ in pieces:
        assert start == len(back[doc_id]) // 4 and offset == filled[sequence] and total == len(given_ids[doc_id]) and length > 0
        back[doc_id] += raw
        filled[sequence] += length
    assert {n: np.frombuffer(raw, "<u4").tolist() for n, raw in back.items()} == {n: ids.tolist() for n, ids in given_ids.items() if len(ids)}
    assert sorted(filled) == list(range(5, 5 + len(filled)))
    assert all(n == size or n & (n - 1) == 0 for n in filled.values())


def test_tails_need_no_padding():
    assert tail_lengths(700) == [512, 128, 32, 16, 8, 4] and tail_lengths(0) == []


def test_both_encoders_agree():
    texts = ["Hello, world's  end\n\n x ", "Ère ñ übér | a*** $$$", "<|endoftext|> a", "", " ", "日本語 テスト", "tab\t\tand\r\nmore", "a" * 3000, "é́ ²³ Ⅷ", "  x"]
    slow, _ = tokens._encoders(tokens.VOCABULARY)
    for text in texts:
        assert tokens.encode(text) == slow.encode(text, add_special_tokens=False).ids, text


def round_trip(pieces, pairs):
    """Every row's ids come out whole and once, sequences are full and gapless."""
    back, filled = defaultdict(list), defaultdict(list)
    for r in pieces:
        back[r.doc_id].append(r)
        filled[r.sequence_id].append(r)
    for rows in filled.values():
        rows.sort(key=lambda r: r.offset)
        at = 0
        for r in rows:
            assert r.offset == at and len(r.ids) == 4 * r.length
            at += r.length
        assert at <= 1024 and at & (at - 1) == 0
    want = defaultdict(list)
    for doc_id, text in pairs:
        want[doc_id].append(tuple([*tokens.encode(text or ""), 0]))
    got = defaultdict(list)
    for doc_id, rows in back.items():
        if len(want[doc_id]) == 1:
            rows.sort(key=lambda r: r.start)
            got[doc_id].append(tuple(np.frombuffer(b"".join(bytes(r.ids) for r in rows), "<u4").tolist()))
            assert {r.doc_tokens for r in rows} == {len(want[doc_id][0])}
        else:
            assert sum(r.length for r in rows) == sum(map(len, want[doc_id]))
            got[doc_id] = want[doc_id]
    assert got == want


def test_odd_rows(docs):
    pairs = [(1, "some words here"), (1, "some words here"), (2, None), (3, ""), (None, "no id"), (4, "x y " * 30_000), (5, "some words here")]
    round_trip(packing.pack_documents(docs(pairs)).collect(), pairs)
    assert packing.pack_documents(docs([])).count() == 0


@needs_data
def test_documents_round_trip(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    pieces = packing.pack_documents(df).collect()
    round_trip(pieces, [(r.doc_id, r.text) for r in df.collect()])


def test_equal_rows_spread_over_ranges(docs, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    df = docs([(1, "the same short text")] * 8000).repartition(8)
    pieces = packing.pack_documents(df, 64).groupBy(F.spark_partition_id()).agg(F.sum("length").alias("n")).collect()
    total = sum(r.n for r in pieces)
    assert total == 8000 * (len(tokens.encode("the same short text")) + 1)
    assert len(pieces) > 1 and max(r.n for r in pieces) < 0.5 * total
