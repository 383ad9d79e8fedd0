"""Sharding by balanced label propagation.

Documents that share a key are linked. Every linked document starts on a shard of its own hash;
each round it votes for the shard where most of its group is, and moves there under quotas: a
shard takes in as many documents as leave it, and beyond that only what its free room holds. Documents
without a link fill the shards at the end, so counts differ by one at most (law ``rows``).

A round is an aggregation by (group, shard), a join back and a ranking of the movers; the driver
sees shards x shards counts only. A group larger than a shard fills one shard after another.

Defined results: a null text counts as empty; equal texts, empty ones too, are linked; repeated
rows are placed each; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snaptrack.llm.tables import ranked, stored, table

SHARDS = 16


def quotas(moves: dict[tuple[int, int], int], free: list[int]) -> dict[tuple[int, int], int]:
    """Moves allowed from shard to shard, as many as can be: no shard gains more than its free room
    on balance, and one that holds too much takes in nothing before it has given that away.

    First what comes into a shard beyond its room and what leaves it is cut, the largest flow
    first, until every shard agrees. Then moves are given back and shifted along circles on which
    more moves are won than lost, until there is none: 16 shards have few.
    """
    allowed, changed = dict(moves), True
    while changed:
        changed = False
        for shard, room in enumerate(free):
            coming, going = _flows(allowed, shard)
            over = min(coming, coming - going - room)
            flows = sorted(pair for pair in allowed if pair[1] == shard)
            for pair in sorted(flows, key=allowed.get, reverse=True):
                cut = min(max(over, 0), allowed[pair])
                allowed[pair] -= cut
                over -= cut
                changed |= cut > 0
    while circle := _gaining_circle(moves, allowed, free):
        amount = min(limit for _, _, limit in circle)
        for pair, sign, _ in circle:
            if pair is not None:
                allowed[pair] += sign * amount
    return allowed


def _flows(allowed: dict[tuple[int, int], int], shard: int) -> tuple[int, int]:
    coming = sum(n for (_, target), n in allowed.items() if target == shard)
    going = sum(n for (source, _), n in allowed.items() if source == shard)
    return coming, going


def _gaining_circle(moves, allowed, free) -> list[tuple[tuple[int, int] | None, int, int]]:
    """Changes ``(pair, sign, limit)`` along a circle that wins moves, or none (Bellman-Ford).

    The circle may lead through a pool: any shard may give more rows than it takes, and take as
    many more as its room lets it.
    """
    pool, steps = len(free), []
    most = sum(moves.values()) + 1
    for shard, room in enumerate(free):
        coming, going = _flows(allowed, shard)
        slack = room + going - coming
        steps.append((pool, shard, 0, None, 0, most if slack >= 0 else -slack))
        if slack > 0:
            steps.append((shard, pool, 0, None, 0, slack))
        for pair in sorted(moves):
            if pair[1] == shard and slack >= 0 and allowed[pair] < moves[pair]:
                steps.append((*pair, 1, pair, 1, moves[pair] - allowed[pair]))
            if pair[1] == shard and allowed[pair] > 0:
                steps.append((shard, pair[0], -1, pair, -1, allowed[pair]))
    gain, last = [0] * (pool + 1), [None] * (pool + 1)
    for _ in range(pool + 2):
        moved = None
        for step in steps:
            if gain[step[0]] + step[2] > gain[step[1]]:
                gain[step[1]], last[step[1]], moved = gain[step[0]] + step[2], step, step[1]
        if moved is None:
            return []
    for _ in range(pool + 1):
        moved = last[moved][0]
    circle, at = [], moved
    while not circle or at != moved:
        circle.append(last[at][3:])
        at = last[at][0]
    return circle


def by_value(column: Column, values: dict[int, int]) -> Column:
    """A number looked up by shard."""
    return F.create_map(*[F.lit(x) for item in values.items() for x in item])[column]


def propagate(linked: DataFrame, capacity: list[int], rounds: int) -> DataFrame:
    """``_row, _key, shard`` after the last round that moves anything.

    Every other round looks for shards with free room alone, for groups too large for one. Ties
    are broken anew every two rounds, so a pair that cannot meet on one shard tries the other.
    """
    spark, shards = linked.sparkSession, len(capacity)
    start = F.pmod(F.xxhash64("_row"), F.lit(shards)).cast("int")
    state = stored(linked.select("_row", "_key", start.alias("shard")), "shards")
    idle = 0
    for turn in range(rounds):
        held = {row["shard"]: row["count"] for row in state.groupBy("shard").count().collect()}
        free = [capacity[s] - held.get(s, 0) for s in range(shards)]
        is_open = F.element_at(F.array(*[F.lit(turn % 2 == 0 or room > 0) for room in free]), F.col("shard") + 1)
        votes = state.groupBy("_key", "shard").agg(F.count("*").alias("n"))
        votes = votes.withColumns(
            {"_weight": F.struct("n", F.xxhash64("_key", "shard", F.lit(turn // 2))), "_open": is_open}
        )
        best = votes.groupBy("_key").agg(
            F.max(F.struct("_weight", "_open", "shard")).alias("_top"),
            F.max(F.when(F.col("_open"), F.struct("_weight", "shard"))).alias("_room"),
            F.count("*").alias("_spread"),
        )
        goal = F.when(F.col("_top._open"), F.col("_top.shard")).otherwise(F.col("_room.shard"))
        weight = F.when(F.col("_top._open"), F.col("_top._weight")).otherwise(
            F.col("_room._weight")
        )
        # Rows leave for a shard with more of their group only, so no two shards trade for ever.
        wishes = votes.join(best.filter("_spread > 1"), "_key").filter(weight > F.col("_weight"))
        wishes = stored(wishes.select("_key", "shard", goal.alias("_goal")), "wishes")
        movers = stored(state.join(wishes, ["_key", "shard"]), "movers")
        moves = {
            (row["shard"], row["_goal"]): row["count"]
            for row in movers.groupBy("shard", "_goal").count().collect()
        }
        allowed = {pair: n for pair, n in quotas(moves, free).items() if n}
        idle = 0 if allowed else idle + 1
        if idle == 2 or not moves and turn % 2 == 0:
            break
        if not allowed:
            continue
        limits = spark.createDataFrame(
            [(a, b, n) for (a, b), n in allowed.items()], "shard int, _goal int, _most long"
        )
        chosen = (
            ranked(movers, "_rank", ["shard", "_goal"], ["_row"])
            .join(F.broadcast(limits), ["shard", "_goal"])
            .filter("_rank < _most")
        )
        moved = chosen.select("_row", F.col("_goal").alias("_new"))
        state = stored(
            state.join(moved, "_row", "left").select(
                "_row", "_key", F.coalesce("_new", "shard").alias("shard")
            ),
            "shards",
        )
    return state


def balanced_shards(rows: DataFrame, shards: int = SHARDS, rounds: int = 2 * SHARDS) -> DataFrame:
    """Adds ``shard`` and ``slot`` to stored rows with a unique ``_row`` and a link key ``_key``."""
    total = rows.count()
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    many = rows.groupBy("_key").agg(F.count("*").alias("_n")).filter("_n > 1").select("_key")
    linked = rows.select("_row", "_key").join(stored(many, "groups"), "_key")
    placed = propagate(linked, capacity, rounds)
    placed = stored(ranked(placed, "slot", ["shard"], ["_row"]), "placed")
    sizes = {row["shard"]: row["count"] for row in placed.groupBy("shard").count().collect()}
    kept = {s: min(sizes.get(s, 0), capacity[s]) for s in range(shards)}
    settled = placed.filter(F.col("slot") < by_value(F.col("shard"), kept))
    settled = settled.select("_row", "shard", "slot")
    loose = ranked(
        rows.select("_row").join(settled.select("_row"), "_row", "left_anti"),
        "_rank", [], ["_row"],
    )
    shard, first, begins = F, 0, {}
    for s in range(shards):
        begins[s] = first
        first += capacity[s] - kept[s]
        shard = shard.when(F.col("_rank") < first, s)
    filled = loose.withColumn("shard", shard)
    offset = by_value(F.col("shard"), {s: kept[s] - begins[s] for s in range(shards)})
    filled = filled.select("_row", "shard", (F.col("_rank") + offset).alias("slot"))
    return rows.join(settled.unionByName(filled), "_row")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("_row"),
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(text.cast("binary"))).alias("_key"),
        ),
        "sizes",
    )
    return balanced_shards(rows, shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
