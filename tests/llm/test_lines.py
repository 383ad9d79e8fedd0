"""Line dedup against brute force."""

import random

import numpy as np
import pytest

from snaptrack.llm import lines
from tests.llm.cases import documents
from tests.llm.test_packing import ODD


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def near(a, b, edits):
    """``distance(a, b) <= edits`` from the cells beside the diagonal."""
    row = {j: j for j in range(min(edits, len(b)) + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - edits), min(len(b), i + edits) + 1):
            options = [row.get(j, edits + 1) + 1, new.get(j - 1, edits + 1) + 1]
            if j:
                options.append(row.get(j - 1, edits + 1) + (x != b[j - 1]))
            else:
                options.append(i)
            new[j] = min(options)
        row = new
        if min(row.values(), default=edits + 1) > edits:
            return False
    return row.get(len(b), edits + 1) <= edits


def plain(texts, edits=lines.EDITS):
    """Numbers of the lines that go, per text."""
    places = [
        (i, n, line.encode())
        for i, text in enumerate(texts)
        for n, line in enumerate((text or "").split("\n"))
        if len(line.encode()) >= lines.MIN_BYTES
    ]
    distinct = sorted({line for _, _, line in places})
    comp = {line: k for k, line in enumerate(distinct)}
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if abs(len(a) - len(b)) <= edits and comp[a] != comp[b] and near(a, b, edits):
                old, new = comp[a], comp[b]
                comp = {k: new if v == old else v for k, v in comp.items()}
    first, gone = {}, {i: [] for i in range(len(texts))}
    for i, n, line in places:
        if first.setdefault(comp[line], (i, n)) != (i, n):
            gone[i].append(n)
    return gone


def changed(rng, line, most):
    data = list(line)
    for _ in range(rng.randrange(most + 1) if data else 0):
        at, kind = rng.randrange(len(data)), rng.randrange(3)
        if kind == 0:
            data.insert(at, rng.choice("abé"))
        elif kind == 1:
            data[at] = rng.choice("abx")
        elif len(data) > 1:
            del data[at]
    return "".join(data)


def corpus(seed, bases, copies, size):
    rng = random.Random(seed)
    found = []
    for _ in range(bases):
        base = "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(32, size)))
        found += [changed(rng, base, 3) for _ in range(copies)]
    rng.shuffle(found)
    return ["\n".join(found[i : i + 3] + ["short"]) for i in range(0, len(found), 3)]


def check(spark, texts):
    expected = plain(texts)
    rows = lines.deduplicated(documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text, gone = texts[row["doc_id"]], expected[row["doc_id"]]
        assert row["_dropped"] == gone
        left = [x for n, x in enumerate((text or "").split("\n")) if n not in gone]
        assert row["text"] == (None if text is None else "\n".join(left))


def test_near_lines(spark):
    check(spark, corpus(1, 30, 6, 120) + corpus(2, 3, 20, 40) + ODD + ["a" * 40 + "\n" + "a" * 42])


def test_large_keys_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lines, "FEW", 3)
    monkeypatch.setattr(lines, "BLOCK", 8)
    rng = random.Random(4)
    stem = "the same first part of all the lines "
    texts = [stem + changed(rng, "abcdefgh" * 3, 6) + str(rng.randrange(40)) for _ in range(90)]
    check(spark, texts)


def test_empty_repeated_null_and_clashing(spark):
    assert lines.deduplicated(documents(spark, [])).collect() == []
    line = "a line that is long enough to count as one"
    rows = documents(spark, [line, line + "\n" + line]).selectExpr(
        "cast(null as long) as doc_id", "text", "1 as id", "2 as line", "3 as key", "4 as dropped"
    )
    found = lines.deduplicated(rows)
    assert found.columns == [*rows.columns, "_lines", "_dropped"]
    assert sorted(r["text"] for r in found.collect()) == ["", line]
    copies = documents(spark, [line] * 50 + ["other"])
    assert sorted(r["doc_id"] for r in lines.without_repeats(copies).collect()) == [0, 50]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_automaton(edits):
    rng = random.Random(edits)
    a = ["".join(rng.choice("ab") for _ in range(rng.randrange(12))) for _ in range(800)]
    b = [changed(rng, x, 5) if x else "ab"[: rng.randrange(3)] for x in a]
    spans = [x.encode() for x in a + b]
    at = np.cumsum([0, *map(len, spans)])
    sizes = np.diff(at)
    found = lines.within(
        np.frombuffer(b"".join(spans), np.uint8), at[:800], sizes[:800], at[800:1600],
        sizes[800:], edits,
    )
    expected = [distance(x, y) <= edits for x, y in zip(spans, spans[800:])]
    assert found.tolist() == expected
    assert [near(x, y, edits) for x, y in zip(spans, spans[800:])] == expected


@pytest.mark.parametrize("same_id", ["cast(null as long)", "7L"])
def test_rows_of_one_id_lose_only_their_own_lines(spark, same_id):
    copy, texts = "a line that is copied into another row", []
    unique = [[f"{row} {n} " + chr(97 + row) * 20 + chr(104 + n) * 20 for n in range(4)] for row in range(4)]
    for row, own in enumerate(unique):
        own.insert(row, copy)  # at another number in each
        texts.append("\n".join([*own, "tiny"]))
    rows = documents(spark, texts + [texts[2]]).selectExpr(f"{same_id} as doc_id", "text")
    found = [r["text"].split("\n") for r in lines.deduplicated(rows).collect()]
    assert len(found) == 5 and texts[0].split("\n") in found  # its copy is first in line order
    assert all(row.count("tiny") == 1 for row in found)
    kept = sorted(line for row in found for line in row if line != "tiny")
    assert kept == sorted([copy, *(x for own in unique for x in own if x != copy)])


def test_short_lines_go_if_equal(spark, tmp_path):
    texts = ["Menu\n\nabc\n }\nshare", "other\nMenu\n\n \nabd\n }", "Menu\nMenu \nabc"]
    expected = ["Menu\n\nabc\n }\nshare", "other\n\n \nabd", "Menu "]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r["text"] for r in lines.op1(spark, str(tmp_path)).collect()}
    assert [found[i] for i in range(3)] == expected
    found = {r["doc_id"]: r["text"] for r in lines.without_repeats(documents(spark, texts)).collect()}
    assert [found[i] for i in range(3)] == expected


@pytest.mark.parametrize("few", [lines.FEW, 1])  # 1: all keys go through blocks
def test_edits_count_characters(spark, monkeypatch, few):
    monkeypatch.setattr(lines, "FEW", few)
    rng = random.Random(6)
    bases = ["".join(rng.choice("abcé漢字 🙂ñ") for _ in range(rng.randrange(30, 60))) for _ in range(40)]
    texts = bases + ["déjà vu au café de la gare du nord à midi", "deja vu au café de la gare du nord à midi"]
    for base in bases:
        for edits in (1, 2, 4):
            data = list(base)
            for at in rng.sample(range(len(data)), edits):
                data[at] = rng.choice("漢🙂") if rng.random() < 0.5 else data[at] + "字"
            texts.append("".join(data))
    rows = lines.deduplicated(documents(spark, texts), short=True, whole=True).collect()
    comp = list(range(len(texts)))
    for i, a in enumerate(texts):
        for j, b in enumerate(texts[:i]):
            if near(a, b, lines.EDITS):
                comp = [comp[j] if c == comp[i] else c for c in comp]
    kept = {min(i for i, c in enumerate(comp) if c == group) for group in comp}
    assert {row["doc_id"] for row in rows if not row["_dropped"]} == kept
    assert len(kept) < 90
