"""Packing against direct tokenization, whole tables and small fixtures."""

import os
import zlib
from collections import defaultdict

import numpy as np
import pytest

from snaptrack.llm import packing
from tests.llm.cases import documents

SF_DIR = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


def ids_of(texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(packing.tokenizer_path())
    found = model.encode_batch([text or "" for text in texts], add_special_tokens=False)
    return [item.ids + [0] for item in found]


def check(rows, texts):
    """``texts`` by unique doc_id. Returns the share of padding."""
    expected = dict(zip(texts, ids_of(list(texts.values()))))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        pieces[row["doc_id"]].append(row)
        sequences[row["sequence_id"]].append(row)
    assert set(pieces) == set(expected)
    for doc_id, ids in expected.items():
        at = 0
        for row in sorted(pieces[doc_id], key=lambda r: r["start"]):
            assert row["start"] == at and row["doc_tokens"] == len(ids)
            part = np.array(ids[at : at + row["length"]], "<u4").tobytes()
            assert row["ids_crc32"] == zlib.crc32(part)
            at += row["length"]
        assert at == len(ids)
    padded = 0
    for members in sequences.values():
        at = 0
        for row in sorted(members, key=lambda r: r["offset"]):
            assert row["offset"] == at
            at += row["length"]
        assert at <= 1024
        padded += 0 if at & (at - 1) == 0 else 1024 - at
    assert sorted(sequences) == list(range(len(sequences)))
    return padded / sum(map(len, expected.values()))


def test_whole_table(spark):
    rows = packing.op5(spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert check(rows, {row["doc_id"]: row["text"] for row in docs}) < 0.02
    steps = defaultdict(int)
    for row in rows:
        steps[row["step_id"]] += row["length"]
    assert max(steps.values()) <= 2 * min(steps.values()) + 1024


ODD = [
    None, "", " ", "  a  b", "a\n\nb \n c", "x  y z", "it's we'll don't", "<|endoftext|> a",
    "é ñ ß 漢字 かな", "1 23  4,5.6", "tab\t x", " 　 a \x85 b\x1c c", "word " * 5000,
    "​ a﻿ b", "a\x85 b \xa0 c\x1c\x1d d \x0b\x0c e", "ǅ ª º ² ¼ Ǹ ÿ × ÷", "a" * 3000, "emoji 🙂 x", "\x00 \x7f b",
]


@pytest.mark.parametrize("ranks", [None, packing.tokenizer_path(packing.RANKS)])
def test_odd_texts(spark, ranks):
    rows = packing.pack(documents(spark, ODD), packing.tokenizer_path(), ranks).collect()
    check(rows, dict(enumerate(ODD)))


def test_empty_repeated_and_clashing(spark):
    none = packing.pack(documents(spark, []), packing.tokenizer_path())
    assert none.collect() == []
    docs = documents(spark, ["same text"] * 40).selectExpr(
        "0L as doc_id", "text", "1 as start", "2 as rank", "3 as rest", "'x' as sums"
    )
    rows = packing.pack(docs, packing.tokenizer_path()).collect()
    assert len(rows) == 40
    assert len({(row["sequence_id"], row["offset"]) for row in rows}) == 40


@pytest.mark.parametrize("seed", range(5))
def test_plan_places_everything(seed):
    lengths = np.random.default_rng(seed).integers(1, 1024, 3000 * seed + 7)
    counts = dict(zip(*map(np.ndarray.tolist, np.unique(lengths, return_counts=True))))
    placed = defaultdict(int)
    for window, repeats, parts in packing.plan(counts):
        total = sum(length * copies for length, copies in parts)
        assert total <= window and (window == 1024 or total == window)
        for length, copies in parts:
            placed[length] += repeats * copies
    assert placed == counts
