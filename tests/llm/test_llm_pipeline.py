"""The pipeline stage by stage against plain Python, on odd rows and on nothing."""

from __future__ import annotations

import hashlib

import pytest
from test_llm_operators import SCHEMA, brute_base, brute_components, brute_lines, corpus, docs, empty, frame, odd  # noqa: F401

import corpus_pipeline as p


def rows_of(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages_in_turn(spark, docs):  # noqa: F811
    stage = dict(p.STAGES)
    assert list(stage) == ["quality_rules", "line_dedup", "near_dedup", "mixing", "byte_bpe"]
    kept = stage["quality_rules"](spark, docs, "").cache()
    assert kept.columns == docs.columns
    for r in docs.collect():
        n, _, _, _, rep = brute_base(r.text)
        if n < 10 or 100 * rep > 20 * n:
            assert kept.filter(kept.doc_id == r.doc_id).count() == 0
    lines = stage["line_dedup"](spark, kept, "").cache()
    want = brute_lines(rows_of(kept))
    assert {r.doc_id: r.text for r in lines.collect()} == {i: v[2] for i, v in want.items()}
    near = stage["near_dedup"](spark, lines, "").cache()
    comp = brute_components(rows_of(lines), 5, 80)
    assert {r.doc_id for r in near.collect()} == {i for i, (_, c) in comp.items() if c == i}
    mixed = stage["mixing"](spark, near, "").cache()
    assert mixed.columns == docs.columns and 0 < mixed.count() <= near.count()
    out = {r.doc_id: r for r in stage["byte_bpe"](spark, mixed, "").collect()}
    from gatefold.llm.byte_bpe import ByteBPE, default_path

    bpe = ByteBPE(default_path())
    for r in mixed.collect():
        assert hashlib.sha256(bpe.decode(out[r.doc_id].ids)).digest() == hashlib.sha256(r.text.encode()).digest()


def test_odd_and_empty_tables(spark, odd, empty):  # noqa: F811
    for table in (odd, empty):
        d = table
        for _, f in p.STAGES[:-1]:
            d = f(spark, d, "")
            assert d.columns == table.columns
        assert p.STAGES[-1][1](spark, d, "").count() <= table.count()


def test_run(spark, tmp_path):
    rows = [(i, f"document number {i} " + " ".join(f"w{i}x{k}" for k in range(30))) for i in range(12)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = p.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids"] and 0 < out.count() <= 12
    assert SCHEMA


def test_bpe_stage_decodes(spark, monkeypatch):
    """Ids that don't decode to their text stop the stage."""
    from gatefold.llm import byte_bpe

    class Lossy:
        def encode(self, texts):
            return [[1] for _ in texts]

        def decode(self, ids):
            return b"?"

    monkeypatch.setattr(byte_bpe, "codec", lambda path: Lossy())
    with pytest.raises(Exception, match="decoded ids differ"):
        dict(p.STAGES)["byte_bpe"](spark, frame(spark, [(1, "some text")]), "").collect()
