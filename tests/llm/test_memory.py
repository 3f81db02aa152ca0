"""What a Python worker holds at once: blocks of bounded bytes."""

from __future__ import annotations

import pyarrow as pa
import pytest

from tessera.llm import blocks, bpe, neardup


@pytest.fixture
def batch():
    texts = [f"text {i} " * 400 for i in range(800)] + ["long " * 100_000, None, ""]  # 3 MB, then one text of 0.5 MB
    ids = list(range(len(texts)))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ids, pa.int64()), pa.array(texts)], names=["doc_id", "uid", "text"])


def watch(monkeypatch, module) -> list:
    seen, cut = [], blocks.text_blocks

    def text_blocks(*given):
        for block in cut(*given):
            seen.append((block.n, len(block.data)))
            yield block

    monkeypatch.setattr(module, "text_blocks", text_blocks)
    return seen


def bounded(seen: list) -> bool:
    return len(seen) > 10 and all(n == 1 or size <= 256 << 10 for n, size in seen)


def test_sketches_work_on_small_blocks(batch, monkeypatch):
    seen = watch(monkeypatch, neardup)
    assert sum(r.num_rows for r in neardup._sketch(5)(iter([batch]))) == batch.num_rows
    assert bounded(seen)


def test_tokenizer_works_on_small_blocks(batch, monkeypatch):
    seen = watch(monkeypatch, bpe)
    ranks = bpe._read(bpe.default_ranks())
    run = bpe._each_block(ranks, "text", lambda rows, texts: pa.RecordBatch.from_arrays([pa.array([sum(len(e[0]) for e in own) for own in texts], pa.int64())], names=["n"]))
    assert sum(r.num_rows for r in run(iter([batch]))) == batch.num_rows
    assert bounded(seen)


def test_powers_follow_the_block():
    blocks._POWERS.clear()
    assert len(blocks.powers(3, 100)) == 101 and len(blocks._POWERS[3]) < 1 << 20
    more = blocks.powers(3, 3_000_000)
    assert len(more) == 3_000_001 and int(more[-1]) == pow(3, 3_000_000, 1 << 64)
    blocks._POWERS.clear()


def test_classes_of_all_code_points():
    import pyarrow.compute as pc

    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    alpha = pc.utf8_is_alpha(pa.array(map(chr, points))).to_numpy(zero_copy_only=False)
    table = bpe.class_table()[points]
    white = set(bpe.WHITE_SPACE)
    plain = [i for i, c in enumerate(points) if c not in white]
    assert ((table == bpe._LETTER) == alpha)[plain].all()
