"""Conversation repair against a plain search over all edits."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from snaptrack.llm import conversations as cv
from tests.compare import duck_rows, spark_rows
from tests.conftest import SMALL

SCHEMA = "conv_id long, turn long, role string, text string, seg string, kind int, audit string"
BLANK = re.compile(r"[\x20\x09-\x0D]*\Z")


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        hit = zlib.crc32(key.encode()) % 20
        if hit == 4:
            role = "user"
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        yield from [(conv, turn, role, text, hit != 0)] * (2 if hit == 3 else 1)


def plain(rows):
    """Answers from first principles: a search over states with whole audits."""
    answers = {}
    for conv in {row[0] for row in rows}:
        mine = [row[1:4] for row in rows if row[0] == conv and row[4]]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in mine:
            solid = text.strip(" \t\n\x0b\x0c\r")
            faults.append(
                "b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "."
            )
            seen.add((role, text))
        states = insert({0: (0, "", ())})
        for (_, role, text), fault in zip(mine, faults):
            new = {}
            late = fault == "t"
            for state, (cost, audit, lines) in states.items():
                offer(new, state, cost + 3, audit + "D", lines)
                if fault in "bd":
                    continue
                for name, letter in (("user", "u"), ("assistant", "a")):
                    if step(state, letter) is not None:
                        offer(new, step(state, letter), cost + 2 + late, audit + "R", (*lines, name + ":" + text))
                if step(state, role[:1]) is not None:
                    offer(new, step(state, role[:1]), cost + late, audit + "K", (*lines, role + ":" + text))
            states = insert(new)
        cost, audit, lines = min(states[s] for s in (0, 3) if s in states)
        turns = [t for t, _, _ in mine if t is not None]
        initials = [role[:1] for _, role, _ in mine]
        answers[conv] = {
            "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        }
    return answers


def step(state, letter):
    return {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((state, letter))


def offer(states, state, cost, audit, lines):
    if state not in states or (cost, audit) < states[state][:2]:
        states[state] = (cost, audit, lines)


def insert(states):
    for _ in range(2):
        for state, (cost, audit, lines) in list(states.items()):
            for name, letter in (("user", "u"), ("assistant", "a")):
                if step(state, letter) is not None:
                    offer(states, step(state, letter), cost + 2, audit + "I", (*lines, name + ":"))
    return states


def check(spark, rows, damaged=True):
    frame = spark.createDataFrame([(*row, "x", 1, "y") for row in rows], SCHEMA)
    if damaged:
        found, known = cv.repaired(cv.damaged(frame)), list(damage(rows))
    else:
        found = cv.repaired(frame.withColumn("present", F.lit(True)))
        known = [(c, t, " " if r is None else r, " " if x is None else x, True) for c, t, r, x in rows]
    found = found.collect()
    answers = {row["conv_id"]: {k: v for k, v in row.asDict().items() if k != "conv_id"} for row in found}
    assert len(answers) == len(found)
    assert answers == plain(known)
    return answers


def drawn(rng, conv, count, texts):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    return [(conv, rng.choice([i, i, i, i + 1, None]), rng.choice(roles), rng.choice(texts)) for i in range(count)]


def test_drawn_conversations(spark):
    rng = random.Random(5)
    texts = ["Yes.", "No!", "why?  ", "cut off", " ", "", None, "été", "\n\t", "a b.", "\u00a0", "1", "2.", "3?"]
    rows = [row for conv in range(300) for row in drawn(rng, conv, rng.randrange(9), texts)]
    check(spark, rows + drawn(rng, None, 40, texts))


def test_drawn_conversations_match_the_sql(spark, tmp_path):
    rng = random.Random(21)
    texts = ["Yes.", "No!", "cut off", " ", "", None, "été", "\n\t", "a b.", "1", "2.", "x" * 70 + "1.", "x" * 70 + "2."]
    rows = [row for conv in range(250) for row in drawn(rng, conv, rng.randrange(9), texts)]
    rows += drawn(rng, None, 9, texts)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    found = spark_rows(cv.op12(spark, str(tmp_path)))
    assert found == duck_rows(duck, cv.ORACLE) and len(found[1]) > 200


def test_one_conversation_with_most_rows(spark, monkeypatch):
    monkeypatch.setattr(cv, "SEGMENT_ROWS", 16)
    rng = random.Random(8)
    texts = [f"text {i}{end}" for i in range(150) for end in ("", ".")] + [""]
    rows = [(7, i // 2 if i % 5 else None, rng.choice(["user", "assistant", "system"]), rng.choice(texts)) for i in range(1200)]
    rows += [row for conv in range(20, 60) for row in drawn(rng, conv, 6, texts)]
    rows += [(8, 3, "user", "the same.")] * 300
    found = check(spark, rows, damaged=False)
    assert found[7]["duplicate"] > 500 and len(found[7]["audit"]) >= 1200
    assert found[8]["duplicate"] == 299


def test_null_empty_and_dropped(spark):
    assert check(spark, []) == {}
    keys = [c for c in range(2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:2]
    rows = [(c, 0, "user", "Gone.") for c in keys] + [(None, None, None, None), (5000, None, "assistant", "x" * 300_000)]
    found = check(spark, rows)
    assert found[keys[0]] == {**dict.fromkeys(cv.TOTALS, 0), "audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}


def test_query_on_the_table(spark):
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet").collect()
    known = plain(list(damage([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows])))
    found = cv.op12(spark, SMALL).collect()
    assert {r["conv_id"]: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in found} == known


@pytest.mark.parametrize("size", [1, 2, 3, 4])
def test_matrices_of_all_short_sequences(size):
    one, two = chr(cv.FIRST_RULE), chr(cv.FIRST_RULE + 1)
    rules = [(one, "ua"), (two, one + one)]
    known = cv.evaluated(rules)
    for text in map("".join, itertools.product("suaxSU-", repeat=size)):
        slow = cv.IDENTITY
        for symbol in text:
            slow = cv.product(slow, known[symbol])
        fast = cv.matrix(text, rules, known)
        assert [c and (c[0], cv.text_of(c[1])) for c in fast] == [c and (c[0], cv.text_of(c[1])) for c in slow]


def test_ropes_compare_as_texts():
    rng = random.Random(1)

    def rope(depth):
        if not depth:
            return rng.choice(["K", "D", "I", "KK", "R"])
        return cv.joined(rope(depth - 1), rng.choice([rope(depth - 1), ""]))

    shared = rope(4)
    for _ in range(300):
        a, b = (cv.joined(shared, rope(3)) for _ in range(2))
        assert cv.before(a, b) == (cv.text_of(a) < cv.text_of(b))


def test_pairs_are_learnt_from_all_sequences(spark):
    texts = [("sua",)] * 5 + [("uaua",)] * 7 + [("UA-",)]
    rules = cv.learnt_rules(spark.createDataFrame(texts, "symbols string"))
    assert rules[0][1] == "ua"
    assert all(cv.compressed(t, rules) != t for t, in texts[:12])
    grown = {s: p for s, p in rules}

    def whole(text):
        return "".join(whole(grown[c]) if c in grown else c for c in text)

    assert all(whole(cv.compressed(t, rules)) == t for t, in texts)
