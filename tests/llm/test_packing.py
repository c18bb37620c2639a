"""Packing: ids against the tokenizer library, plans against their rules, edge cases."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from changeflow.llm import packing

SCHEMA = "doc_id long, text string, piece string, sequence_id string, offset int"


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


ODD = ["a", "B", "é", " ", "  ", "\n", "\t", "1", "²", "!", "'s", "<|endoftext|>", "\x1c", "　", "\xa0", "日本", "🙂", "_", "\r", "\x85"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(ODD), max_size=14).map("".join), st.text(max_size=20)), max_size=6))
def test_ids_are_those_of_the_tokenizer(reference, texts):
    ids, ends = packing.encoder("byte_bpe_50k")(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert ids[ends[i] : ends[i + 1]].tolist() == reference(text)


@settings(max_examples=80, deadline=None)
@given(st.integers(2, 64).flatmap(lambda cap: st.tuples(st.just(cap), st.dictionaries(st.integers(1, cap), st.integers(1, 60), max_size=30))))
def test_plan_places_every_piece_once_without_gaps(case):
    capacity, counts = case
    made = packing.plan(counts, capacity, groups=8)
    fill = np.zeros(made.sequences, int)
    ranks = {length: [] for length in counts}
    for length, rank, n, sequence, offset in sorted(made.runs, key=lambda run: run[4]):
        at = np.arange(sequence, sequence + n)
        assert (fill[at] == offset).all()
        fill[at] += length
        ranks[length] += range(rank, rank + n)
    assert all(sorted(ranks[length]) == list(range(n)) for length, n in counts.items())
    assert not len(fill) or (fill.min() > 0 and fill.max() <= capacity)


def test_plan_is_near_the_bound_and_no_larger_for_more_rows():
    rng = np.random.default_rng(1)
    lengths, counts = np.unique(rng.integers(1, 2049, 20000), return_counts=True)
    counts = dict(zip(lengths.tolist(), counts.tolist()))
    once, often = packing.plan(counts), packing.plan({k: n * 10**6 for k, n in counts.items()})
    least = sum(k * n for k, n in counts.items()) / 2048
    assert once.sequences <= 1.01 * least
    assert often.sequences <= 1.01 * 10**6 * least
    assert len(often.runs) < 4 * len(once.runs)


def test_documents(spark, reference):
    rng = np.random.default_rng(0)
    texts = ["", None, "one", "one", " ".join(["long"] * 5000), "x" * 3000] + [" ".join(["w"] * int(n)) for n in rng.integers(1, 300, 60)]
    rows = [(i if i != 3 else 2, text, "p", "s", 1) for i, text in enumerate(texts)]
    found = packing.pack_documents(spark.createDataFrame(rows, SCHEMA), capacity=256).collect()
    by_sequence, by_doc = {}, {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256
    for i, text in enumerate(texts):
        if i in (2, 3):
            continue
        ids, parts = reference(text), sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert sum(r.length for r in parts) == len(ids) and all(r.length == 256 for r in parts[1:])
        for r in parts:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    assert len(by_doc[2]) == 2  # a repeated row


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).collect() == []
