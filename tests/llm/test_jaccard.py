"""The n-gram Jaccard join against brute force."""

import random

import pytest

from snaptrack.llm import jaccard
from tests.llm.cases import documents


def shingles(text, size):
    upper = {c: c + 32 for c in range(65, 91)}
    words = (text or "").encode().split()
    words = [bytes(upper.get(c, c) for c in word) for word in words]
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(texts, size, percent):
    sets = [shingles(text, size) for text in texts]
    comp = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and comp[i] != comp[j] and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((comp[i], comp[j]))
                comp = [low if c == high else c for c in comp]
    return {(i, len(s), c) for i, (s, c) in enumerate(zip(sets, comp))}


def run(spark, texts, size=3, percent=90):
    rows = jaccard.jaccard_components(documents(spark, texts), size, percent).collect()
    assert len(rows) == len(texts)
    return {tuple(row) for row in rows}


def near_copies(seed, groups, copies, words, edits):
    """Groups of copies of a text with a few words changed, among them a very common passage."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    passage = [word() for _ in range(12)]
    out = []
    for _ in range(groups):
        base = [word() for _ in range(words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(edits + 1)):
                text[rng.randrange(len(text))] = word()
            out.append(" ".join(passage + text if rng.random() < 0.4 else text))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_near_copies(spark, size, percent):
    texts = near_copies(1, 6, 12, 80, 4) + near_copies(2, 1, 150, 60, 6)
    assert run(spark, texts, size, percent) == brute(texts, size, percent)


def test_large_group_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "FEW", 3)
    texts = near_copies(3, 1, 200, 40, 5) + near_copies(4, 3, 30, 25, 3)
    assert run(spark, texts) == brute(texts, 3, 90)


ODD = [
    None, "", "  \n\t", "one", "One", "ONE  ", "two words", "Two\x0bWords", "two words x",
    "É é", "é É", "a b c", "a b c a b c a b c", "A B C", "\x1c a", "\x85 b",
    " ".join(str(i) for i in range(30000)), " ".join(str(i) for i in range(1, 30001)), "a b c d",
]


def test_odd_texts(spark):
    assert run(spark, ODD) == brute(ODD, 3, 90)


def test_empty_repeated_null_and_clashing(spark):
    assert run(spark, []) == set()
    rows = documents(spark, ["p q r s", "p q r s", "x y z"]).selectExpr(
        "cast(null as long) as doc_id", "text", "1 as node", "2 as n", "3 as component_id"
    )
    found = jaccard.jaccard_components(rows, 3, 90).collect()
    assert sorted(row["n_shingles"] for row in found) == [1, 2, 2]
    rows = documents(spark, ["p q r s", "x y z", "x y z"]).selectExpr("5L as doc_id", "text")
    assert jaccard.jaccard_components(rows, 3, 90).count() == 3


def test_bound_of_common_rare_ngrams():
    for x in range(1, 80):
        for y in range(x, 80):
            if x * 100 < y * 90:
                continue
            overlap = -(-90 * (x + y) // 190)
            outside = max(-(-90 * n // 100) - 1 for n in (x, y))
            assert overlap - outside <= min(x, y)


@pytest.mark.parametrize("same_id", ["cast(null as long)", "7L", "if(doc_id % 3 = 0, null, if(doc_id % 3 = 1, 7L, doc_id))"])
def test_one_of_each_group_whatever_the_ids(spark, same_id):
    """Copies and near copies under one id, or none: one of each group stays, and all others."""
    rng = random.Random(12)
    texts, groups = [], []
    for group in range(6):
        words = [f"g{group}w{i}" for i in range(100)]
        for copy in range(7):
            changed = list(words)
            changed[copy if copy < 3 else 0] = f"x{copy if copy < 3 else 0}"
            texts.append(" ".join(changed))
            groups.append(group)
    texts += [None, "", "few words", "few words"]
    rows = documents(spark, texts).selectExpr(f"{same_id} as doc_id", "text", "source", "1 as copy", "2 as comp")
    found = jaccard.one_of_each(rows)
    assert found.columns == rows.columns
    kept = [row["text"] for row in found.collect()]
    for group in range(6):
        assert sum(bool(text) and text.split()[-1] == f"g{group}w99" for text in kept) == 1
    assert kept.count(None) == kept.count("") == kept.count("few words") == 1 and len(kept) == 9
