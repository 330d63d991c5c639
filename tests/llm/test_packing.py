import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from codesift.llm import packing
from codesift.llm.queries import tokenizer_path
from llm_data import corpus, empty, frame


def test_cut_covers_and_wastes_little():
    for n in range(1, 9000):
        pieces = packing.cut(n)
        assert sum(pieces) == n and max(pieces) <= 2048
        for p in pieces:
            share = 2048 // (2048 // p)
            assert (share - p) * 64 <= share


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


ODD = ["", "  ", "a\n\nb", " x ", "éa ́b", "a b\x1cc", "<|endoftext|> x<|endoftext|>y", "İstanbul ΣΑΣ", "it's don't WE'LL", "ﬁ ǅ",
       "ÀÉß ÿ", "word.,!", "...", "日本 語", "a b c", "x" * 3000]


def test_ids_equal_the_tokenizer(tokenizer):
    words = packing.WordIds(tokenizer_path())
    texts = ODD + [r[1] for r in corpus()] + ODD
    for text, got in zip(texts, words.encode(texts)):
        assert got.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids + [1], text


def test_round_trip(spark, tokenizer):
    rows = corpus() + [(300 + i, t, "h", "s") for i, t in enumerate(ODD)]
    got = packing.pack(frame(spark, rows), tokenizer_path()).collect()
    want = sorted((i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])) for i, t, *_ in rows if i is not None and i != 5)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc_id, ids in want:
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for rs in sequences.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert sum(r.start == 0 for r in got) == len(rows)
    total = sum(r.length for r in got)
    assert len(sequences) <= total / 2048 * 65 / 64 + 2 * 3
    assert packing.pack(empty(spark), tokenizer_path()).count() == 0
