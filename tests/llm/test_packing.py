"""Tokens against the tokenizer itself, sequences against the packing rules."""

import tracemalloc
from collections import defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from solvind.llm.packing import OpenBins, UnitTokens, pack_documents, token_pieces
from solvind.llm.queries import PACKING_TOKENIZER, tokenizer_path
from solvind.llm.textgrid import chunks

ODD = [
    "", "  ", "<|endoftext|> a<|startoftext|>", "<|STARTOFTEXT|>", "It's DON'T 'tis 's S x'Re", "É Ê × ÷ ß Œuvre été J̌ İstanbul ΣΑΣ",
    "a\x1cb \x0bc\x0cd e f", "12 3.5 x²", "--a--b", "\n\n", "ab😀cd 中文字符", "A\tB\rC", "don”t “q”", "Ã©", "Zz.", "́abc d́ .", "x_y __z",
]


@pytest.fixture(scope="module")
def tokens():
    return UnitTokens(tokenizer_path(PACKING_TOKENIZER))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path(PACKING_TOKENIZER))


def ids_of(tokens, texts):
    found = []
    for _, rows, data, offsets in chunks(pa.array(texts, pa.string())):
        ids, before = tokens.chunk(data, offsets)
        found += [ids[before[k] : before[k + 1]].tolist() for k in range(rows)]
    return found


def test_ids_of_odd_texts(tokens, tokenizer):
    assert ids_of(tokens, ODD) == [e.ids for e in tokenizer.encode_batch(ODD, add_special_tokens=False)]


@given(st.lists(st.text(alphabet="aBcÉéßñ İ'.,<|>!\n\t12_́中😀", max_size=40), max_size=6))
@settings(max_examples=150, deadline=None)
def test_ids_of_any_text(tokens, tokenizer, texts):
    assert ids_of(tokens, texts) == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@given(st.lists(st.integers(1, 20), max_size=80), st.integers(1, 5))
@settings(max_examples=100, deadline=None)
def test_bins_hold_their_capacity(lengths, most):
    bins, loads = OpenBins(20, most), defaultdict(int)
    for length in lengths:
        number, offset = bins.place(length)
        assert loads[number] == offset
        loads[number] += length
        assert loads[number] <= 20 and bins.count <= most
    assert bins.made == len(loads)


def test_sequences(documents, odd_rows, prose, tokenizer):
    rows = odd_rows + [(100 + k, prose(5 + k % 300)) for k in range(400)]
    found = pack_documents(documents(rows), tokenizer_path(PACKING_TOKENIZER)).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for row in found:
        sequences[row.sequence_id].append((row.offset, row.length))
        pieces[row.doc_id].append(row)
    total = sum(row.length for row in found)
    assert len(sequences) <= -(-total // 2048) * 1.05 + 1
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    for doc_id, text, *_ in rows:
        if doc_id in (9, 10):
            continue  # repeated
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        mine = sorted(pieces[doc_id], key=lambda row: row.piece)
        assert [row.piece for row in mine] == list(range(len(mine))) and [row.start for row in mine] == [2048 * row.piece for row in mine]
        assert [row.ids_crc32 for row in mine] == [crc32(ids[row.start : row.start + row.length].tobytes()) for row in mine]
        assert sum(row.length for row in mine) == len(ids)
    assert len(pieces[10]) == 2 * len({row.piece for row in pieces[10]})
    assert pack_documents(documents([]), tokenizer_path(PACKING_TOKENIZER)).count() == 0


def test_a_worker_holds_a_small_part_of_a_batch_at_once(spark, prose):
    class Docs:
        """Gives the function that runs on batches."""

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    cut = token_pieces(Docs(), tokenizer_path(PACKING_TOKENIZER))
    batch = pa.RecordBatch.from_arrays([pa.array(range(2_000)), pa.array([prose(300) for _ in range(2_000)])], ["doc_id", "text"])
    assert batch.nbytes > 2_500_000
    for _ in cut(iter([batch.slice(0, 100)])):
        pass  # the tokenizer is loaded
    tracemalloc.start()
    try:
        rows = sum(part.num_rows for part in cut(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 2_000 and peak < 50_000_000
