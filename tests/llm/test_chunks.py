"""Chunk dedup against a plain version, planted passages and awkward rows."""

import os
import random
from collections import defaultdict

import numpy as np
import pytest

from snaptrack.llm import chunks
from tests.llm.cases import documents
from tests.llm.test_packing import ODD

SF_DIR = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")
SPACES = b" \t\n\x0b\x0c\r"


def plain_chunks(text):
    """Chunk byte strings, byte by byte."""
    data, out, start = text.encode(), [], 0
    for i in range(1, len(data)):
        if i < chunks.REACH:
            continue
        rolling = 0
        for byte in data[max(0, i - chunks.REACH) : i]:
            rolling = (rolling << 1) + int(chunks.GEAR[byte]) & 0xFFFFFFFF
        rolling >>= 8
        word = data[i - 1] in SPACES and data[i] not in SPACES
        if word and rolling & 3 == 0 or data[i] & 0xC0 != 0x80 and rolling & 255 == 255:
            out.append(data[start:i])
            start = i
    return out + [data[start:]] if data else []


def plain(texts, min_words=chunks.MIN_WORDS):
    """Runs of chunks in which every next pair, or a long chunk alone, is held by an earlier text."""
    cut = [plain_chunks(text or "") for text in texts]
    bounds = [np.cumsum([0, *map(len, found)]) for found in cut]
    starts = [
        [j for j in range(len(d)) if d[j] not in SPACES and (j == 0 or d[j - 1] in SPACES)]
        for d in ((text or "").encode() for text in texts)
    ]

    def words_in(i, a, b):
        return sum(a <= j < b for j in starts[i])

    holders = defaultdict(set)
    for i, found in enumerate(cut):
        for k in range(len(found)):
            if k:
                holders[found[k - 1], found[k]].add(i)
            if words_in(i, bounds[i][k], bounds[i][k + 1]) >= min_words:
                holders[found[k]].add(i)
    out = []
    for i, (text, found) in enumerate(zip(texts, cut)):
        runs = []
        for k in range(len(found)):
            pair = k and min(holders[found[k - 1], found[k]]) < i
            alone = found[k] in holders and min(holders[found[k]]) < i
            if pair and runs and runs[-1][1] == k:
                runs[-1][1] = k + 1
            elif pair:
                runs.append([k - 1, k + 1])
            elif alone:
                runs.append([k, k + 1])
        kept, at, edge = b"", 0, bounds[i]
        for low, high in runs:
            if words_in(i, edge[low], edge[high]) >= min_words:
                kept += b"".join(found[at:low])
                at = high
        kept += b"".join(found[at:])
        out.append(None if text is None else kept.decode())
    return out


def run(spark, texts):
    rows = chunks.deduplicated(documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    return rows


def words(rng, count):
    return [f"{rng.choice('abcdefgh')}{rng.randrange(3000)}é"[: rng.randrange(3, 7)] for _ in range(count)]


def test_matches_plain_version(spark):
    rng = random.Random(7)
    shared = [" ".join(words(rng, n)) for n in (8, 30, 60, 120)]
    texts = []
    for _ in range(60):
        parts = [" ".join(words(rng, rng.randrange(40))) for _ in range(3)]
        parts.insert(rng.randrange(3), rng.choice(shared))
        texts.append(rng.choice([" ", "\n", "  \t"]).join(parts))
    texts += texts[:5] + ["x" * 700, "x" * 700 + " y"] + ODD
    found = {row["doc_id"]: row for row in run(spark, texts)}
    expected = plain(texts)
    for i, text in enumerate(expected):
        assert found[i]["text"] == text
        assert found[i]["_cut"]["n_chunks"] == len(plain_chunks(texts[i] or ""))


def test_planted_passages_are_caught(spark):
    rng = random.Random(11)
    passages = [words(rng, 55) for _ in range(100)]
    texts, first = [], {}
    for i in range(300):
        own = words(rng, 80)
        at = rng.randrange(80)
        if i < 200:
            first.setdefault(i % 100, i)
            own[at:at] = passages[i % 100]
        texts.append(" ".join(own))
    rows = {row["doc_id"]: row for row in run(spark, texts)}
    caught = [i for i in range(300) if rows[i]["_cut"]["removed_words"]]
    assert set(caught) <= set(range(100, 200))  # the first holders and clean texts stay
    assert len(caught) >= 96
    assert all(first[i % 100] in rows[i]["_cut"]["owners"] for i in caught)


def test_whole_copies_go(spark):
    rng = random.Random(5)
    text = " ".join(words(rng, 200))
    docs = documents(spark, [text] * 30 + [" ".join(words(rng, 50))])
    assert sorted(r["doc_id"] for r in chunks.without_repeats(docs).collect()) == [0, 30]


def test_odd_rows(spark):
    assert run(spark, []) == []
    text = "word and more words " * 20
    rows = documents(spark, [text, text]).selectExpr(
        "cast(null as long) as doc_id", "text", "1 as id", "2 as digest", "3 as foreign", "4 as owner"
    )
    found = chunks.deduplicated(rows).collect()
    assert sorted(r["text"] for r in found) == ["", text] and found[0]["owner"] == 4
    assert [r["_cut"]["owners"] for r in found if not r["text"]] == [[None]]
    assert chunks.deduplicated(rows).columns == [*rows.columns, "_cut"]


def test_small_pieces_change_nothing():
    rng = random.Random(3)
    texts = [" ".join(words(rng, 300)).encode() for _ in range(5)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    together = chunks.cuts(data, offsets)
    for text, start, stop in zip(texts, offsets, offsets[1:]):
        alone = chunks.cuts(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        inside = together[(together >= start) & (together <= stop)] - start
        assert alone.tolist() == inside.tolist()


@pytest.mark.parametrize("same_id", ["cast(null as long)", "7L"])
def test_rows_of_one_id_are_documents_of_their_own(spark, same_id):
    """A third of the rows under one id, or under none: one holder of a passage keeps it."""
    rng = random.Random(17)
    passage = " ".join(words(rng, 60))
    texts = [" ".join([*words(rng, 30), passage, *words(rng, 30)]) for _ in range(20)]
    whole = " ".join(words(rng, 60))
    rows = documents(spark, [*texts, whole, whole, whole]).selectExpr(f"{same_id} as doc_id", "text")
    found = [r["text"] for r in chunks.deduplicated(rows).collect()]
    inner = " ".join(passage.split()[10:50])
    assert len(found) == 23 and sum(inner in text for text in found) == 1
    assert found.count(whole) == 1 and found.count("") == 2


def test_no_run_is_put_together_from_many_documents(spark):
    """Independent words of a Zipf law share short chunks, and no passage."""
    rng = np.random.default_rng(4)
    weights = 1 / np.arange(1, 2001) ** 1.2
    drawn = rng.choice(2000, (2500, 300), p=weights / weights.sum())
    names = [f"{chr(97 + i % 26)}{i}" for i in range(2000)]
    texts = [" ".join(names[w] for w in row) for row in drawn]
    rows = run(spark, texts)
    assert sum(row["_cut"]["removed_words"] > 0 for row in rows) == 0
