"""Packing: exact round trip, brute-force best fit, and edge rows."""

from __future__ import annotations

import random

import numpy as np
import pytest

from marquee.llm import packing as P
from tables import sf_dir  # noqa: F401

SCHEMA = "doc_id bigint, text string, ids string, row int"


@pytest.fixture(scope="module")
def bpe():
    with open(P.TOKENIZER, "rb") as f:
        return P.encoding(f.read())


def unpacked(rows, row_tokens):
    """{(doc_id, copy): bytes of ids} rebuilt from packed rows, and checks of each row."""
    pieces = {}
    for r in rows:
        ids, positions = (np.frombuffer(b, "<u2") for b in (r.ids, r.position_ids))
        assert len(ids) == len(positions) == row_tokens
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= row_tokens
        assert (ids[r.n_tokens :] == P.END_TOKEN).all()
        for k, (doc, offset) in enumerate(zip(r.doc_ids, r.doc_offsets, strict=True)):
            lo, hi = r.cu_seqlens[k], r.cu_seqlens[k + 1]
            assert hi > lo and (positions[lo:hi] == np.arange(hi - lo)).all()
            pieces.setdefault((doc, offset), []).append(ids[lo:hi].tolist())
    return pieces


def test_round_trip_with_edge_rows(spark, bpe):
    texts = {1: "one two three", 2: "", 4: " <|endoftext|> é\n\n ñ " * 30, 5: "x" * 3000, 6: "b"}
    data = [(k, t, "clash", 0) for k, t in texts.items()] + [(3, None, "", 1), (6, "b", "", 2), (None, "no id", "", 3)]
    rows = P.pack_tokens(spark.createDataFrame(data, SCHEMA).repartition(2), row_tokens=16, window_tokens=100).collect()
    pieces = unpacked(rows, 16)
    for doc, text in texts.items():
        copies = 2 if doc == 6 else 1
        parts = sorted((offset, found) for (d, offset), found in pieces.items() if d == doc)
        ids = [x for _, found in parts for x in found[0]]
        assert all(len(found) == copies for _, found in parts)
        if text:
            assert ids[-1] == P.END_TOKEN and bpe.decode(ids[:-1]) == text
        else:
            assert not parts
    assert bpe.decode(pieces[None, 0][0][:-1]) == "no id"
    assert not any(d == 3 for d, _ in pieces)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert P.pack_tokens(empty).collect() == []


def test_best_fit_matches_brute_force():
    rng = random.Random(5)
    for most in (1, 7, 64, 100):
        sizes = [rng.randint(1, most) for _ in range(200)]
        pieces = [P.Piece(k, 0, np.zeros(n, np.uint16)) for k, n in enumerate(sizes)]
        room = []
        for n in sorted(sizes, reverse=True):
            fitting = [r for r in room if r >= n]
            if fitting:
                room.remove(min(fitting))
            room.append((min(fitting) if fitting else most) - n)
        packed = P.best_fit_decreasing(pieces, most)
        assert sorted(most - sum(len(p.ids) for p in row) for row in packed) == sorted(room)
        assert sorted(p.doc_id for row in packed for p in row) == list(range(200))


def test_documents_round_trip(spark, bpe, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    packed = P.pack_tokens(docs).collect()
    pieces = unpacked(packed, P.ROW_TOKENS)
    whole = {}
    for (doc, _), found in sorted(pieces.items()):
        whole.setdefault(doc, []).extend(found[0])
    for r in docs.collect():
        assert bpe.decode(whole[r.doc_id][:-1]) == r.text
    assert sum(r.n_tokens for r in packed) / (len(packed) * P.ROW_TOKENS) > 0.9


def test_written_matrices(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"words of text {k} " * k) for k in range(1, 40)], "doc_id bigint, text string")
    packed = P.pack_tokens(docs, row_tokens=64)
    P.write_packed(packed, str(tmp_path))
    rows = spark.read.parquet(f"{tmp_path}/rows")
    assert rows.count() == packed.count()
    assert P.read_matrix([r.ids for r in rows.collect()], 64).shape == (rows.count(), 64)
    assert spark.read.parquet(f"{tmp_path}/segments").agg({"doc_ids": "max"}).first()[0] == 39
