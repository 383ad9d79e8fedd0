"""Balance, slots and kept groups of the sharding."""

import itertools
import os
import random
import zlib
from collections import Counter, defaultdict

from snaptrack.llm import sharding
from tests.llm.cases import documents

SF_DIR = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


def check(rows, texts):
    by_id = {row["doc_id"]: row for row in rows}
    assert len(rows) == len(texts) and set(by_id) == set(texts)
    slots, groups = defaultdict(list), defaultdict(list)
    for doc_id, text in texts.items():
        row, data = by_id[doc_id], (text or "").encode()
        assert row["size"] == len(data) + 1 and row["text_crc32"] == zlib.crc32(data)
        assert row["law"] == "rows" and row["grown_shard"] is None
        slots[row["shard"]].append(row["slot"])
        groups[text or ""].append(row["shard"])
    counts = [len(slots[s]) for s in range(sharding.SHARDS)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(sharding.SHARDS))
    for s, found in slots.items():
        assert sorted(found) == list(range(len(found)))
    return groups


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    groups = check(sharding.op4(spark, SF_DIR).collect(), {r["doc_id"]: r["text"] for r in docs})
    assert all(len(set(shards)) == 1 for shards in groups.values())


def test_large_group_fills_whole_shards(spark):
    texts = ["copy"] * 100 + [f"own {i}" for i in range(140)] + ["pair", "pair", None, ""]
    rows = sharding.shard_documents(documents(spark, texts)).collect()
    groups = check(rows, dict(enumerate(texts)))
    assert len(set(groups["copy"])) <= 8  # 100 copies, 15 a shard
    assert len(set(groups["pair"])) == len(set(groups[""])) == 1


def test_all_linked(spark):
    """No free room at all: a hash keeps one pair in 16 whole, swaps must keep every second."""
    texts = [f"text {i // 2}" for i in range(160)]
    groups = check(
        sharding.shard_documents(documents(spark, texts)).collect(), dict(enumerate(texts))
    )
    assert sum(len(set(shards)) == 1 for shards in groups.values()) >= 40


def test_empty_repeated_and_clashing(spark):
    assert sharding.shard_documents(documents(spark, [])).collect() == []
    rows = documents(spark, ["x"] * 20).selectExpr(
        "cast(null as long) as doc_id", "text", "1 as shard", "2 as slot", "3 as size"
    )
    found = sharding.shard_documents(rows).collect()
    assert len({(r["shard"], r["slot"]) for r in found}) == 20
    assert max(Counter(r["shard"] for r in found).values()) == 2


def lawful(allowed, free):
    """No shard gains more than its room; one beyond its room takes nothing in before it has given."""
    for shard, room in enumerate(free):
        coming = sum(n for (_, b), n in allowed.items() if b == shard)
        going = sum(n for (a, _), n in allowed.items() if a == shard)
        if coming > max(0, going + room):
            return False
    return True


def test_quotas_swap_and_fill():
    moves = {(0, 1): 5, (1, 0): 3, (2, 1): 4}
    found = sharding.quotas(moves, [0, 3, 0])
    assert lawful(found, [0, 3, 0]) and sum(found.values()) == 9
    assert sharding.quotas({(0, 1): 7, (1, 2): 7, (2, 0): 7}, [0, 0, 0]) == {
        (0, 1): 7, (1, 2): 7, (2, 0): 7
    }
    assert sharding.quotas({(0, 1): 7}, [0, -2]) == {(0, 1): 0}


def test_quotas_allow_as_many_moves_as_any():
    rng = random.Random(2)
    for _ in range(150):
        pairs = [(a, b) for a in range(3) for b in range(3) if a != b and rng.random() < 0.7]
        moves = {pair: rng.randrange(1, 4) for pair in pairs}
        free = [rng.randrange(0, 4) for _ in range(3)]
        found = sharding.quotas(moves, free)
        assert lawful(found, free) and all(0 <= found[p] <= moves[p] for p in pairs)
        choices = (dict(zip(pairs, n)) for n in itertools.product(*(range(moves[p] + 1) for p in pairs)))
        assert sum(found.values()) == max(sum(c.values()) for c in choices if lawful(c, free))


def test_quotas_of_full_shards_are_lawful():
    rng = random.Random(3)
    for _ in range(200):
        pairs = [(a, b) for a in range(16) for b in range(16) if a != b and rng.random() < 0.4]
        moves = {pair: rng.randrange(1, 10_000) for pair in pairs}
        free = [rng.randrange(-3000, 3000) for _ in range(16)]
        found = sharding.quotas(moves, free)
        assert lawful(found, free) and all(0 <= found[p] <= moves[p] for p in pairs)
