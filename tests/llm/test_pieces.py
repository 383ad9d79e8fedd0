"""Piece encoding against a plain dynamic program, and exact round trips."""

import os

import numpy as np
import pytest

from snaptrack.llm import pieces
from tests.llm.cases import documents
from tests.llm.test_packing import ODD

SF_DIR = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def words():
    return pieces.vocabulary(pieces.model_path())


def plain(words, text):
    """Best path over one whole text, character by character."""
    spelled = words.spelled.tobytes()
    table = {}
    for i in range(len(words.spans) - 1):
        key = spelled[words.spans[i] : words.spans[i + 1]]
        if key and i not in set(words.bytes_at.tolist()):
            table[key] = i
    if not text:
        return []
    data = b" " + text.encode()
    best = {0: (0.0, [])}
    for start in range(len(data)):
        if start not in best or data[start] & 0xC0 == 0x80:
            continue
        score, path = best[start]
        width = next(
            (n for n in range(1, 5) if start + n >= len(data) or data[start + n] & 0xC0 != 0x80)
        )
        options = [
            (size, [table[data[start : start + size]]])
            for size in range(words.longest, 0, -1)
            if data[start : start + size] in table and start + size <= len(data)
        ]
        if not any(size == width for size, _ in options):
            options.append((width, [words.bytes_at[b] for b in data[start : start + width]]))
        for size, ids in options:
            total = score
            for i in ids:
                total += words.scores[i]
            if start + size not in best or total > best[start + size][0]:
                best[start + size] = (total, path + [int(i) for i in ids])
    return best[len(data)][1]


def test_against_plain_search(spark, words):
    texts = [text for text in ODD if not text or len(text) < 500]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(20).collect()
    texts += [row["text"][:400] for row in docs] + ["▁ marker ▁▁", "   ", " lead", "trail "]
    rows = {r["doc_id"]: r for r in pieces.tokenize(documents(spark, texts), words).collect()}
    score = lambda ids: sum(words.scores[i] for i in ids)
    for i, text in enumerate(texts):
        expected = plain(words, text)
        assert rows[i]["round_trip"] and rows[i]["n_tokens"] == len(rows[i]["ids"])
        assert score(rows[i]["ids"]) == pytest.approx(score(expected))
        assert rows[i]["ids"] == expected


def test_whole_table_round_trip(spark, words):
    tokens = pieces.op3(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    back = {r["doc_id"]: r["text"] for r in pieces.texts_of(tokens, words).collect()}
    assert back == {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert tokens.filter("not round_trip").count() == 0


def test_odd_rows(spark, words):
    rows = pieces.tokenize(documents(spark, ODD * 2), words).collect()
    assert len(rows) == 2 * len(ODD) and all(row["round_trip"] for row in rows)
    assert rows[0]["ids"] == [] and rows[1]["n_tokens"] == 0
    clashing = documents(spark, ["a b"]).selectExpr("doc_id", "text", "1 as ids", "2 as n_tokens")
    assert pieces.tokenize(clashing, words).count() == 1
    assert pieces.tokenize(documents(spark, []), words).collect() == []


def test_trie_finds_all_keys():
    keys = {bytes(k): i for i, k in enumerate({tuple(np.random.default_rng(i).integers(0, 256, i % 7 + 1)) for i in range(500)})}
    base, check, value = pieces.double_array(keys)
    for key, number in keys.items():
        node = 0
        for byte in key:
            slot = base[node] + byte + 1
            assert check[slot] == node
            node = slot
        assert value[node] == number
