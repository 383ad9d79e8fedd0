"""Exact top-k by inner product with a pivot table.

Vectors become integers, so scores are exact. With d the Euclidean distance,
``2 q.v = |q|^2 + |v|^2 - d(q, v)^2``, and for every pivot p ``d(q, v) >= |d(q, p) - d(v, p)|``.
The largest of these lower bounds over all pivots gives an upper bound of the score; bounds carry a
margin far above the rounding error, and ties go on. The pivots are vectors far apart, chosen from
a sample; the sample also gives each query a k-th score to start from, which all blocks share.

Tasks put their candidates into blocks of like ones (by nearest pivot) and keep the range of each
block's distances. A block is sent to a block of queries only if its bound reaches the k-th score
that some query starts from. There candidates are evaluated in the order of their own bounds until
the next bound lies below the k-th score found. Vectors that lie in clusters are mostly never
evaluated; where distances are all alike, as among independent random vectors of many components,
no pivot can tell them apart, and nearly all are (``evaluated`` reports it).

No side is broadcast. A query's best rows of each block are merged by a partial top-k. Rows are told
apart by a stored number, so a row is never its own candidate, and other rows of its id are.

Defined results: vectors that are null or empty, or hold null, NaN or infinite components, or whose
length differs from the sample's most common length, take no part; fewer candidates than k give
all of them; an empty table gives no row; rows of one id are queries and candidates each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from snaptrack.llm.tables import lowest, ranked, stored, table

K = 10
SCALE = 1024
PIVOTS = 32
SAMPLE = 2048
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 2048
SORTED = 1 << 15
SUMMARIES = 256
MOST_KNOWN = 1024
CHUNK = 256
MARGIN = 1e-6


def usable(vectors: DataFrame, scale: int) -> DataFrame:
    """``_row, vec_id`` and integer components of the rows that take part."""
    broken = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    good = F.col("vec_id").isNotNull() & (F.size("embedding") > 0)
    return vectors.filter(good & ~F.coalesce(broken, F.lit(True))).select(
        F.monotonically_increasing_id().alias("_row"), "vec_id", whole.alias("v")
    )


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Rows x pivots, from exact integer squares."""
    squares = (rows**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * rows @ pivots.T
    return np.sqrt(squares.astype(float))


def upper_bounds(queries, query_table, rows, row_table) -> np.ndarray:
    """Queries x rows: no score exceeds its bound."""
    low = np.zeros((len(queries), len(rows)))
    for p in range(query_table.shape[1]):
        np.maximum(low, np.abs(query_table[:, p, None] - row_table[None, :, p]), out=low)
    squares = (queries**2).sum(1)[:, None] + (rows**2).sum(1)[None]
    bound = (squares - np.maximum(low * (1 - MARGIN) - MARGIN, 0) ** 2) / 2
    return bound + np.abs(bound) * MARGIN + 1


def chosen_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Vectors far from each other: each next one is the farthest from those before."""
    found = [0]
    away = distances(sample, sample[:1])[:, 0]
    while len(found) < min(count, len(sample)) and away.max() > 0:
        found.append(int(away.argmax()))
        away = np.minimum(away, distances(sample, sample[found[-1:]])[:, 0])
    return sample[found]


def best_rows(query, query_row, bound, floor, block, k):
    """Top k of one block for one query that reach ``floor``, best first, ties to the smaller id;
    and how many candidates were evaluated."""
    order = np.flatnonzero(bound >= floor)
    order = order[np.argsort(-bound[order], kind="stable")]
    scores, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
    seen = 0
    for start in range(0, len(order), CHUNK):
        if len(scores) == k and bound[order[start]] < scores[-1]:
            break
        chunk = order[start : start + CHUNK]
        chunk = chunk[block["keys"][chunk] != query_row]
        seen += len(chunk)
        scores = np.concatenate([scores, block["rows"][chunk] @ query])
        found = np.concatenate([found, block["ids"][chunk]])
        top = np.lexsort((found, -scores))[:k]
        scores, found = scores[top], found[top]
    return scores, found, seen


def grouped(vectors: DataFrame, pivots: np.ndarray, block: int) -> DataFrame:
    """Blocks of at most ``block`` rows in the order of their nearest pivots and the distance to it,
    their distances to all pivots, and the least and largest of these."""

    def blocks(ids, keys, rows):
        table = distances(rows, pivots)
        near = table.argmin(1)
        order = np.lexsort((table[np.arange(len(rows)), near], near))
        for start in range(0, len(order), block):
            part = order[start : start + block]
            norms = (rows[part] ** 2).sum(1).max().astype(float)
            yield [
                ids[part], keys[part], rows[part], table[part],
                np.concatenate([table[part].min(0), table[part].max(0), [norms]]),
            ]

    def run(batches) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out():
            for cells in blocks(*(np.concatenate(x) for x in zip(*held))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cell.tobytes()], pa.binary()) for cell in cells],
                    ["ids", "keys", "rows", "table", "summary"],
                )

        for batch in batches:
            if batch.num_rows:
                ids, keys = (batch.column(n).to_numpy().astype(np.int64) for n in ("vec_id", "_row"))
                held.append((ids, keys, matrix(batch.column("v")).astype(np.int64)))
                size += batch.num_rows
            if size >= SORTED:
                yield from out()
                held, size = [], 0
        if held:
            yield from out()

    schema = "ids binary, keys binary, rows binary, table binary, summary binary"
    return vectors.mapInArrow(run, schema)


def with_floors(queries: DataFrame, sample: np.ndarray, sample_keys: np.ndarray, k: int) -> DataFrame:
    """Adds the k-th score of each query among the sample, which its k-th score cannot be below."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors = []
            for cells in batch.select(["keys", "rows"]).to_pylist():
                keys = np.frombuffer(cells["keys"], np.int64)
                scores = np.frombuffer(cells["rows"], np.int64).reshape(len(keys), -1) @ sample.T
                scores[keys[:, None] == sample_keys[None]] = np.iinfo(np.int64).min
                lowest_ = np.full(len(keys), np.iinfo(np.int64).min)
                if len(sample) > k:
                    lowest_ = np.partition(scores, len(sample) - k, axis=1)[:, len(sample) - k]
                floors.append(lowest_.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(floors, pa.binary())], [*batch.schema.names, "floors"]
            )

    return queries.mapInArrow(run, ", ".join(f"{name} binary" for name in [*queries.columns, "floors"]))


def arrays_of(cells: dict, mark: str = "") -> dict[str, np.ndarray]:
    """The arrays of a block."""
    keys = np.frombuffer(cells[mark + "keys"], np.int64)
    return {
        "keys": keys,
        "ids": np.frombuffer(cells[mark + "ids"], np.int64),
        "rows": np.frombuffer(cells[mark + "rows"], np.int64).reshape(len(keys), -1),
        "table": np.frombuffer(cells[mark + "table"]).reshape(len(keys), -1),
    }


def reaching(squares, table, floors, summaries) -> np.ndarray:
    """Whether some query's bound for a whole block of candidates reaches its floor."""
    low, high, norm = np.split(summaries, [table.shape[1], 2 * table.shape[1]], axis=1)
    out = np.zeros(len(summaries), bool)
    for start in range(0, len(table), 32):
        part = table[start : start + 32, None]
        apart = np.maximum(part - high[None], low[None] - part).max(2)
        apart = np.maximum(apart * (1 - MARGIN) - MARGIN, 0)
        bound = (squares[start : start + 32, None] + norm[:, 0][None] - apart**2) / 2
        bound += np.abs(bound) * MARGIN + 1
        out |= (bound >= floors[start : start + 32, None]).any(0)
    return out


def meetings(candidates: DataFrame, queries: DataFrame, blocks: int) -> DataFrame:
    """``block, cblock``: which candidate blocks some query of a block has to look at. Only the
    ranges of distances travel here, many to a row."""

    def gather(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SUMMARIES):
                part = batch.slice(start, SUMMARIES)
                cells = [part.column("cblock").to_numpy().tobytes(), b"".join(part.column("summary").to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], ["cblocks", "summaries"])

    def decide(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cells in batch.to_pylist():
                found = np.frombuffer(cells["cblocks"], np.int64)
                query = arrays_of(cells)
                reach = reaching(
                    (query["rows"] ** 2).sum(1), query["table"], np.frombuffer(cells["floors"], np.int64),
                    np.frombuffer(cells["summaries"]).reshape(len(found), -1),
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(reach.sum(), cells["block"])), pa.array(found[reach])], ["block", "cblock"]
                )

    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    some = candidates.select("cblock", "summary").mapInArrow(gather, "cblocks binary, summaries binary")
    return some.withColumn("block", every).join(queries, "block").mapInArrow(decide, "block long, cblock long")


def top_k(
    vectors: DataFrame,
    is_query: F.Column,
    k: int = K,
    scale: int = SCALE,
    pivots: int = PIVOTS,
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
    evaluated: bool = False,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query among all rows but its own. ``evaluated``
    asks for ``query_id, evaluated`` instead: how many candidates each query was compared with."""
    rows = stored(usable(vectors, scale), "vectors")
    empty = vectors.sparkSession.createDataFrame(
        [], "query_id long, evaluated long" if evaluated else "query_id long, rank int, vec_id long, score long"
    )
    first = lowest(rows, "_row", SAMPLE).collect()
    if not first:
        return empty
    lengths = [len(row["v"]) for row in first]
    width = max(sorted(set(lengths)), key=lengths.count)
    first = [row for row in first if len(row["v"]) == width]
    sample, keys = np.array([row["v"] for row in first], np.int64), np.array([row["_row"] for row in first])
    chosen = chosen_pivots(sample, pivots)
    rows = rows.filter(F.size("v") == width)
    queries = grouped(rows.filter(is_query), chosen, query_block).drop("summary")
    queries = stored(with_floors(queries, sample, keys, k), "queries")
    queries = stored(ranked(queries, "block", [], ["keys"]), "queries")
    blocks = queries.count()
    if not blocks:
        return empty
    candidates = grouped(rows, chosen, candidate_block)
    candidates = stored(candidates.withColumn("cblock", F.monotonically_increasing_id()), "candidates")
    pairs = stored(meetings(candidates, queries, blocks), "pairs")
    names = {name: f"q_{name}" for name in ("ids", "keys", "rows", "table", "floors")}

    def search(batches) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}  # the k-th scores found in this task
        for batch in batches:
            for cells in batch.to_pylist():
                block, query = arrays_of(cells), arrays_of(cells, "q_")
                if cells["block"] not in known:
                    if len(known) >= MOST_KNOWN:
                        known.clear()
                    known[cells["block"]] = np.frombuffer(cells["q_floors"], np.int64).copy()
                floors, out = known[cells["block"]], []
                for low in range(0, len(floors), 64):
                    part = slice(low, low + 64)
                    bound = upper_bounds(query["rows"][part], query["table"][part], block["rows"], block["table"])
                    for q, row in enumerate(bound, low):
                        key, name = query["keys"][q], query["ids"][q]
                        scores, found, seen = best_rows(query["rows"][q], key, row, floors[q], block, k)
                        if len(scores) == k:
                            floors[q] = max(floors[q], scores[-1])
                        if evaluated:
                            scores, found = np.array([seen]), np.zeros(1, np.int64)
                        out.append((np.full(len(found), key), np.full(len(found), name), found, scores))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(part)) for part in zip(*out)],
                    ["query_row", "query_id", "vec_id", "score"],
                )

    met = candidates.drop("summary").join(pairs, "cblock").join(queries.withColumnsRenamed(names), "block")
    partial = met.mapInArrow(search, "query_row long, query_id long, vec_id long, score long")
    if evaluated:
        return partial.groupBy("query_row").agg(
            F.first("query_id").alias("query_id"), F.sum("score").alias("evaluated")
        ).drop("query_row")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (
        partial.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE = f"""
with v as (
  select row_number() over () as r, vec_id,
         list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as e
  from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select q.r, q.vec_id as query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::bigint as score
  from v q join v c on q.r <> c.r where q.vec_id % 100 = 0)
select query_id, rank::int as rank, vec_id, score from (
  select *, row_number() over (partition by r order by score desc, vec_id) as rank
  from pairs) where rank <= {K}"""
