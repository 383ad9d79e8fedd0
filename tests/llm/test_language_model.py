"""Language-model scores against plain sums, and against the counts alone on held-out texts."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from snaptrack.llm import language_model as lm
from snaptrack.llm.ragged import SpanHasher, flat, lowered, words
from tests.conftest import SMALL

SCHEMA = "doc_id long, text string, row long, words string, times int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, 1, "w", 2) for i, t in zip(ids, texts)], SCHEMA)


def place(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7


def plain_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(lower), None]


def plain(ids, texts):
    counts = Counter(w for i, t in zip(ids, texts) if place(i) != 2 for w in plain_words(t))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for doc_id, text in zip(ids, texts):
        listed = plain_words(text)
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in listed)
        known = sum(counts[w] > 0 for w in listed)
        out.append((doc_id, place(doc_id) == 2, len(listed), known, total, round(base, 6)))
    return sorted(out, key=repr)


def query(spark, docs):
    key = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return lm.scored(docs, key % 7 == 2).collect()


def base_rows(rows):
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    return sorted(((*(r[n] for n in names), round(r["base_score"], 6)) for r in rows), key=repr)


@pytest.mark.parametrize("head", [4, lm.HEAD])
def test_counts_and_base(spark, monkeypatch, head):
    original = lm.vocabulary
    monkeypatch.setattr(lm, "vocabulary", lambda counts: original(counts, head))
    rng = random.Random(3)
    names = ["The", "the", "cat", "É", "é", " ", "a.b", "z", "end", "of", "\x1f", "x" * 40]
    texts = [" ".join(rng.choices(names, k=rng.randrange(30))) for _ in range(200)]
    texts += [None, "", " \t\n", "unseen words only", "the " * 200_000, texts[0], texts[0]]
    ids = [*range(len(texts) - 3), 5, 5, None]
    rows = query(spark, frame(spark, texts, ids))
    assert base_rows(rows) == plain(ids, texts)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)


def test_nothing_to_learn_from(spark):
    assert query(spark, frame(spark, [])) == []
    held = [i for i in range(100) if place(i) == 2][:3]
    rows = query(spark, frame(spark, ["some words", None, ""], held))
    assert base_rows(rows) == plain(held, ["some words", None, ""])
    assert [r["base_score"] for r in rows] == [0, 0, 0]


def learnt(spark, texts):
    docs = frame(spark, texts).select("text")
    counts = lm.stored(lm.counted(docs), "counts")
    known = lm.vocabulary(counts, 8)
    return counts, known, lm.trained(docs, known)


def test_probabilities_of_all_tokens_add_up(spark):
    """Over all known tokens, and one unknown token per class, in several contexts."""
    rng = random.Random(9)
    names = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(names, weights=range(60, 0, -1), k=25)) for _ in range(60)]
    counts, known, weights = learnt(spark, texts)
    listed = counts.filter("word is not null").collect()
    endings = np.array([r["ending"] for r in listed])
    tokens = np.array([r["word"] for r in listed], np.int64).view(np.uint64)
    sizes = np.array([r["c"] for r in listed])
    assert sizes.sum() == known.total and known.tokens.sum() == known.total and known.kinds.sum() == len(listed)
    for context in ([], ["w0"], ["w1", "w2"], ["new", "w5"]):
        data, offsets = flat(pa.array([" ".join(context)]))
        sequence, last, at = lm.tokens_of(data, offsets, SpanHasher(lm.SEED))
        active = lm.feature_rows(sequence, known.classes(sequence, last), at, len(weights))[:, -1:]
        z = lm.log_odds(weights, active)[0].astype(float)
        p = np.exp(z) / np.exp(z).sum()
        classes = known.classes(tokens, endings)
        inside = np.where(classes < len(known.singles), 1, (sizes + 1) / (known.tokens + known.kinds + 1)[classes])
        unknown = (p / (known.tokens + known.kinds + 1))[lm.SINGLES :].sum()
        spare = p[len(known.singles) : lm.SINGLES].sum()
        assert (p[classes] * inside).sum() + unknown + spare == pytest.approx(1, abs=1e-5)
        assert spare < 1e-6


def test_probabilities_inside_classes_add_up(spark):
    """Over the tokens of the head, the rarer ones and one unknown token of every class."""
    rng = random.Random(9)
    names = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(names, weights=range(60, 0, -1), k=25)) for _ in range(60)]
    docs = frame(spark, texts).select("text")
    counts = lm.stored(lm.counted(docs), "counts")
    known = lm.vocabulary(counts, 40)
    tree = lm.forks(known)
    _, inside = lm.fitted(docs, known, tree)
    assert np.abs(inside).max() > 0.01
    listed = counts.filter("word is not null").collect()
    tokens = np.array([r["word"] for r in listed], np.int64).view(np.uint64)
    classes = known.classes(tokens, np.array([r["ending"] for r in listed]))
    sizes, hit = np.array([r["c"] for r in listed]), known.in_head(tokens)[0]
    assert hit.sum() == 40 and len(listed) > 50
    for seed in range(3):
        features = np.full((4, len(tokens)), seed, np.uint64) * lm.ODD + np.arange(4, dtype=np.uint64)[:, None]
        for weights, close in ((inside, 1e-5), (0 * inside, 1e-6)):
            p = 10 ** lm.fork_scores(weights, tree, features, known.leaves(tokens, classes))
            closed = (sizes + 1) / (known.tokens + known.kinds + 1)[classes]
            p = np.where(hit, p, p * (sizes + 1) / 10 ** tree.rarer[classes])
            for kind in set(classes.tolist()):
                rarer = np.array([len(known.head) + kind])
                unknown = 10 ** (lm.fork_scores(weights, tree, features[:, :1], rarer) - tree.rarer[kind])
                total = p[classes == kind].sum() + (unknown[0] if kind >= lm.SINGLES else 0)
                assert total == pytest.approx(1, abs=close)
            if not weights.any():
                assert p[classes >= lm.SINGLES] == pytest.approx(closed[classes >= lm.SINGLES], rel=1e-4)


def test_a_token_depends_on_its_context_inside_its_class(spark, monkeypatch):
    """Two tokens of one class and one frequency: only what stands before tells them apart."""
    monkeypatch.setattr(lm, "class_scores", lambda weights, active, classes: 0.0 * classes)
    held = [i for i in range(3000) if place(i) == 2][:4]
    ids = [i for i in range(3000) if place(i) != 2]
    fill = " ".join(f"f{i} f{i}" for i in range(lm.SINGLES + 4))
    texts = [f"{i} {fill} one xa_same {fill} two xb_same" for i in ids]
    asked = ["one xa_same", "one xb_same", "two xb_same", "two xa_same"]
    scores = {r["doc_id"]: r["score"] for r in query(spark, frame(spark, texts + asked, ids + held))}
    a, b, c, d = (scores[i] for i in held)
    assert a > b + 0.1 and c > d + 0.1


def test_score_is_the_sum_over_tokens(spark):
    texts = ["the cat sat on the mat", "the dog sat on the log", "a bird", "the cat again"] * 8
    rows = query(spark, frame(spark, texts))
    docs = frame(spark, texts)
    key = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    training = docs.filter(key % 7 != 2).select("text")
    counts = lm.stored(lm.counted(training), "counts")
    known = lm.vocabulary(counts)
    weights = lm.trained(training, known)
    by_word = {r["word"]: r["c"] for r in counts.filter("word is not null").collect()}
    for row in rows:
        data, offsets = flat(pa.array([texts[row["doc_id"]]]))
        tokens, endings, at = lm.tokens_of(data, offsets, SpanHasher(lm.SEED))
        classes = known.classes(tokens, endings)
        active, total = lm.feature_rows(tokens, classes, at, len(weights)), 0.0
        for i, token in enumerate(tokens):
            z = (weights[0] + sum(weights[r] for r in active[:, i])).astype(float)
            kind = classes[i]
            total += (z[kind] - np.log(np.exp(z).sum())) / math.log(10)
            if kind >= len(known.singles):
                c = by_word.get(int(token.astype(np.int64)), 0)
                total += math.log10((c + 1) / (known.tokens[kind] + known.kinds[kind] + 1))
        assert row["score"] == pytest.approx(total, rel=1e-4)


def test_places_in_the_head_without_a_search(monkeypatch):
    rng = np.random.default_rng(4)
    head = np.unique(rng.integers(0, 1 << 64, 500, np.uint64))
    head = np.unique(np.concatenate([head, head[250] + np.arange(40, dtype=np.uint64)]))  # one crowded place
    tokens = np.concatenate([head, head + np.uint64(1), head - np.uint64(1), lm.END[None], np.uint64([0, (1 << 64) - 1])])
    expected = np.minimum(np.searchsorted(head, tokens), len(head) - 1)
    known = lm.Vocabulary(*[None] * 2, head, *[None] * 6, lm.head_starts(head))

    def search(*_):
        raise AssertionError("a binary search for every token")

    monkeypatch.setattr(np, "searchsorted", search)
    hit, place = known.in_head(tokens)
    assert (place == expected).all() and (hit == np.isin(tokens, head)).all()
    none = lm.Vocabulary(*[None] * 2, head[:0], *[None] * 6, lm.head_starts(head[:0]))
    assert not none.in_head(tokens)[0].any()


def test_group_sums_are_those_of_reduceat():
    """To the last bit, whatever the sizes of the groups."""
    rng = np.random.default_rng(5)
    values = rng.normal(size=(3000, lm.CLASSES)).astype(np.float32)
    for keys in (rng.zipf(1.4, 3000) % 900, np.arange(3000), np.zeros(3000, np.int64), rng.integers(0, 1000, 3000)):
        order = np.argsort(keys, kind="stable")
        _, first, times = np.unique(keys, return_index=True, return_counts=True)
        first = np.searchsorted(keys[order], keys[first])
        expected = np.add.reduceat(values[order], first, axis=0)
        assert (lm.group_sums(values, order, first, times) == expected).all()


def test_steps_are_not_scrambled_one_by_one(monkeypatch):
    """Scoring and learning scramble forks once for the tree, and give the places of the plain formula."""
    texts = [" ".join(f"w{i * k % 60}" for i in range(60)) for k in range(1, 8)]
    data, offsets = flat(pa.array(texts))
    tokens, endings, at = lm.tokens_of(data, offsets, SpanHasher(lm.SEED))
    found, first, counts = np.unique(tokens, return_index=True, return_counts=True)
    groups = np.arange(lm.ENDINGS) % (lm.CLASSES - lm.SINGLES) + lm.SINGLES
    home = endings[first]
    per = [np.bincount(groups[home], weights, lm.CLASSES).astype(np.int64) for weights in (counts, None)]
    known = lm.Vocabulary(
        int(counts.sum()), len(found), found, counts, home, found[:0], groups, *per, lm.head_starts(found)
    )
    tree, classes = lm.forks(known), known.classes(tokens, endings)
    features, leaves = lm.contexts(tokens, classes, at), known.leaves(tokens, classes)
    sizes, fork, _ = tree.ways(leaves)
    spread = np.repeat(features, sizes, 1)
    plain = (spread + lm.mixed(fork.astype(np.uint64) + np.uint64(1))) * lm.ODD >> lm.FORK_PLACE

    def scrambled(*_):
        raise AssertionError("a scramble for every step")

    monkeypatch.setattr(lm, "mixed", scrambled)
    assert (lm.fork_slots(features, sizes, tree.codes[fork]) == plain.astype(np.int64)).all()
    weights, power, visits = np.zeros(lm.SLOTS, np.float32), np.zeros(lm.SLOTS, np.float32), np.zeros(lm.SLOTS, np.int64)
    lm.learn_forks(weights, power, visits, tree, features, leaves)
    assert visits.sum() == plain.size and (visits == np.bincount(plain.ravel().astype(np.int64), minlength=lm.SLOTS)).all()
    assert (lm.fork_scores(weights, tree, features, leaves) < 0).any()


def test_words_and_case_of_all_bytes():
    """Bytes below 9, 128 and above, and all blanks, against plain tests of each byte."""
    data = np.random.default_rng(6).integers(0, 256, 20_000).astype(np.uint8)
    data = np.concatenate([np.arange(256, dtype=np.uint8), data])
    low = [b + 32 if 65 <= b <= 90 else b for b in data.tolist()]
    assert lowered(data).tolist() == low and lowered(data).dtype == np.uint8
    starts, ends, at = words(data, np.array([0, 100, 100, len(data)]))
    rows = (data[:100].tobytes(), b"", data[100:].tobytes())
    expected = [w for row in rows for w in re.findall(rb"[^\x20\x09-\x0D]+", row)]
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == expected and at[-1] == len(expected)


def test_context_features():
    tokens = np.arange(1, 8, dtype=np.uint64)
    at = np.array([0, 3, 4, 7])
    classes = np.arange(7)
    rows = lm.feature_rows(tokens, classes, at, 1 << 12)
    alone = [
        lm.feature_rows(tokens[a:b], classes[a:b], np.array([0, b - a]), 1 << 12)
        for a, b in zip(at[:-1], at[1:])
    ]
    assert (rows == np.concatenate(alone, axis=1)).all() and rows.min() > 0


def test_held_out_texts_are_likelier_than_by_counts(spark):
    rows = lm.op13(spark, SMALL.replace("0.001", "0.01")).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 100
    better = sum(r["score"] > r["base_score"] for r in held) / len(held)
    gain = sum(r["score"] - r["base_score"] for r in held) / sum(r["n_tokens"] for r in held)
    assert better > 0.9 and gain > 0.1, (better, gain)


def test_query_counts_of_the_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = plain([r["doc_id"] for r in docs], [r["text"] for r in docs])
    assert base_rows(lm.op13(spark, SMALL).collect()) == expected
