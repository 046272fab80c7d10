import zlib

import numpy as np
import pytest

from tidemark.llm import packing as P


def check(rows, found, length):
    """``found`` holds every id of every row once, in gapless sequences."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.vocabulary()[0])
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        assert r.length == len(r.ids) > 0 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for k, pieces in by_sequence.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == length or k == len(by_sequence) - 1
    # pieces of a document are neighbours in the stream
    texts, held = [], []
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.start == sum(map(len, held))
        held.append(list(r.ids))
        if r.start + r.length == r.doc_tokens:
            texts.append((str(r.doc_id), sum(held, [])))
            held = []
    assert not held
    want = [(str(i), tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in rows]
    assert sorted(texts) == sorted(want)


def test_every_id_lies_in_one_piece(spark, frame):
    rows = [(i, f"document {i} about cats, dögs and 数 " * (i % 9)) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "no id"), (5, "same id"), (5, "same id"), (6, "a<|endoftext|>b"), (7, " \n\t  x" * 3000), (8, "a" * 20000)]
    found = P.pieces(frame(rows), length=64).collect()
    check(rows, found, 64)
    assert "ids" not in P.pieces(frame(rows), length=64, with_ids=False).columns


def test_empty_table(frame):
    assert P.pieces(frame([])).count() == 0


def test_neighbours_on_the_curve_share_words(spark, frame):
    cat, sun = "cat purr meow whisker claw ", "sun moon star orbit comet "
    rows = [(i, (cat if i % 2 else sun) * 40) for i in range(40)]
    found = sorted(P.pieces(frame(rows), length=256).collect(), key=lambda r: (r.sequence_id, r.offset))
    kinds = [r.doc_id % 2 for r in found if r.start == 0]
    assert sum(a != b for a, b in zip(kinds, kinds[1:])) == 1


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_hilbert_steps_to_neighbours(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    key = P.hilbert(grid, bits)
    order = np.argsort(key)
    assert (key[order] == np.arange(len(grid))).all()
    assert (np.abs(np.diff(grid[order], axis=0)).sum(axis=1) == 1).all()


def test_both_encoders_agree():
    json_path, ranks = P.vocabulary()
    slow, fast = P.encoders(json_path, None), P.encoders(json_path, ranks)
    for text in ["", "it's 1234 o'clock", "été  naïve\r\n\t x", "𝄞𝄞 ​́", "   lead", "trail   ", "<|endoftext|>", "\x00\x01", "don'T", "²½ Ⅷ"]:
        assert slow(text).tolist() == fast(text).tolist()
