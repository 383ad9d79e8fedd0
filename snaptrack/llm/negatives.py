"""Hard negatives of an anchor: rows of other labels whose score lies in a window below a positive's.

The windows of an anchor's positives overlap. Their upper limits, in falling order, cut the scores
into disjoint slots: slot j holds the scores under the j-th limit and not under the next. Tasks
keep the first k rows of each slot; the window of positive j is answered by the first k rows of the
slots from j on, less what lies under the window's lower limit. As slots fall, these are suffixes
of one ordered list of at most ``positives * k`` rows.

Anchors are a stated share of the rows and meet all rows in blocks: every group of candidate
blocks meets every block of anchors once, sorted so that a task sees the pairs of one meeting in a
row. It keeps one running best per anchor and slot and emits a fixed number of rows for each,
however many candidates it has seen. Nothing but counts is collected and no side is broadcast.
Anchors and candidates are told apart by a stored row number, never by their id.

Defined results: rows whose id, label or vector is null, whose vector is empty or holds a null or
non-finite component take no part; vectors of different lengths never meet; a row of the anchor's
id is a candidate if it is another row; equal rows count once each; a positive without negatives in
its window gives no row; a negative score has an empty window; an empty table gives no row; other
columns are not read. Scores must fit 64 bits, a hundred times over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from snaptrack.llm.tables import ranked, stored, table

POSITIVES = 5
K = 10
SCALE = 256
LOW, HIGH = 30, 90
ANCHOR_BLOCK = 4096
CANDIDATE_BLOCK = 4096
GROUP = 32
LEAST_GROUPS = 16
TILE = 128
EXACT = 2.0**53
BLOCK_SCHEMA = "width int, size int, rows binary, keys binary, ids binary, labels binary, limits binary"


def usable(vectors: DataFrame, label: Column, scale: int) -> DataFrame:
    """``_row, vec_id, label, v`` of the rows that take part, v in whole numbers."""
    broken = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)
    return vectors.filter(good & ~F.coalesce(broken, F.lit(True))).select(
        F.monotonically_increasing_id().alias("_row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        whole.alias("v"),
    )


def packed(rows: DataFrame, block: int) -> DataFrame:
    """Blocks of at most ``block`` vectors of one length, sorted by label inside."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            values = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = np.diff(lists.offsets.to_numpy())
            starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
            columns = {
                name: batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)
                for name in ("_row", "vec_id", "label")
            }
            limits = batch.column("limits").flatten().to_numpy(zero_copy_only=False)
            limits = limits.astype(np.int64).reshape(batch.num_rows, -1)
            for width in np.unique(sizes):
                same = np.flatnonzero(sizes == width)
                same = same[np.argsort(columns["label"][same], kind="stable")]
                for low in range(0, len(same), block):
                    part = same[low : low + block]
                    cells = values[starts[part][:, None] + np.arange(width)].astype(np.int64)
                    most = np.abs(cells).max()
                    kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
                    raw = [cells.astype(kind), *(columns[n][part] for n in columns), limits[part]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(width)], pa.int32()), pa.array([len(part)], pa.int32())]
                        + [pa.array([x.tobytes()], pa.binary()) for x in raw],
                        ["width", "size", "rows", "keys", "ids", "labels", "limits"],
                    )

    return rows.mapInArrow(run, BLOCK_SCHEMA)


class Block:
    """The arrays of a packed block."""

    def __init__(self, cells: dict, mark: str = ""):
        def array(name, kind=np.int64):
            return np.frombuffer(cells[mark + name], kind)

        size, raw = cells[mark + "size"], cells[mark + "rows"]
        kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(raw) // size // cells[mark + "width"]]
        rows = array("rows", kind).reshape(size, -1)
        self.keys, self.ids, self.labels = (array(name) for name in ("keys", "ids", "labels"))
        self.limits = array("limits").reshape(size, -1)
        self.whole = rows.astype(np.int64)
        self.real = rows.astype(float)
        self.most = float(np.sqrt((self.real**2).sum(1).max()))


def scores(anchors: Block, a: np.ndarray, rows: Block, b: np.ndarray) -> np.ndarray:
    """Exact inner products; in floating point while no partial sum can leave its whole numbers."""
    if anchors.most * rows.most < EXACT:
        return (anchors.real[a] @ rows.real[b].T).astype(np.int64)
    return anchors.whole[a] @ rows.whole[b].T


class Best:
    """The first ``k`` of every group by falling score, then id and row."""

    def __init__(self, groups: int, k: int):
        self.k, self.least = k, np.full(groups, np.iinfo(np.int64).min)
        self.found = np.zeros((4, 0), np.int64)

    def add(self, group, score, ids, keys) -> None:
        open_ = score >= self.least[group]
        new = np.stack([group[open_], score[open_], ids[open_], keys[open_]])
        if not new.shape[1]:
            return
        both = np.concatenate([self.found, new], axis=1)
        both = both[:, np.lexsort((both[3], both[2], -both[1], both[0]))]
        first = np.searchsorted(both[0], both[0])
        place = np.arange(both.shape[1]) - first
        self.found = both[:, place < self.k]
        last = both[:, place == self.k - 1]
        self.least[last[0]] = last[1]


def best_of(anchors: Block, best: Best, rows: Block, same: bool) -> None:
    """Adds a block of candidates: those of the anchor's label, or of others by slot."""
    slots = anchors.limits.shape[1] // 2
    for label in np.unique(anchors.labels):
        mine, theirs = anchors.labels == label, rows.labels == label
        a, b = np.flatnonzero(mine), np.flatnonzero(theirs if same else ~theirs)
        for low in range(0, len(a) if len(b) else 0, TILE):
            part = a[low : low + TILE]
            score = scores(anchors, part, rows, b)
            if same:
                i, j = np.nonzero(
                    (anchors.keys[part][:, None] != rows.keys[b][None])
                    & (score >= best.least[part][:, None])
                )
                best.add(part[i], score[i, j], rows.ids[b[j]], rows.keys[b[j]])
                continue
            upper, lower = anchors.limits[part, :slots], anchors.limits[part, slots:]
            inside = (score <= upper.max(1)[:, None]) & (score >= lower.min(1)[:, None])
            i, j = np.nonzero(inside)
            value = score[i, j]
            slot = (upper[i] >= value[:, None]).sum(1) - 1
            best.add(part[i] * slots + slot, value, rows.ids[b[j]], rows.keys[b[j]])


def searched(candidates: DataFrame, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """``anchor, slot, score, vec_id``: the best rows of each task for every anchor and slot.

    ``anchors`` are packed and stored with their limits. Slot 0 is the only one of positives.
    """
    blocks = stored(ranked(anchors, "block", [], ["keys"]), "anchors")
    names = [c for c in blocks.columns if c != "block"]
    kinds = {row["width"] for row in blocks.select("width").distinct().collect()}
    count, groups = blocks.count(), max(LEAST_GROUPS, -(-candidates.count() // GROUP))
    grid = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grid")
    left = blocks.select("block", grid, *[F.col(c).alias(f"a_{c}") for c in names])
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(count, 1) - 1).cast("long")))
    right = candidates.filter(F.col("width").isin(list(kinds) or [0])).select(
        every.alias("block"), F.pmod(F.xxhash64("keys"), F.lit(groups)).cast("int").alias("grid"), "*"
    )

    def run(batches) -> Iterator[pa.RecordBatch]:
        at, anchors, best = None, None, None

        def out():
            group, score, ids, _ = best.found
            slots = 1 if same else anchors.limits.shape[1] // 2
            return pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (anchors.keys[group // slots], group % slots, score, ids)],
                ["anchor", "slot", "score", "vec_id"],
            )

        for batch in batches:
            for i in range(batch.num_rows):
                cells = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                if at != (cells["block"], cells["grid"]):
                    if at:
                        yield out()
                    at, anchors = (cells["block"], cells["grid"]), Block(cells, "a_")
                    slots = 1 if same else anchors.limits.shape[1] // 2
                    best = Best(len(anchors.keys) * slots, k)
                if cells["width"] == cells["a_width"]:
                    best_of(anchors, best, Block(cells), same)
        if at:
            yield out()

    # A sort-merge join keeps the pairs of one meeting together.
    return right.join(left.hint("merge"), ["block", "grid"]).mapInArrow(
        run, "anchor long, slot long, score long, vec_id long"
    )


def first_rows(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """One row per ``by`` with ``best``: the first k of ``score, vec_id`` in order."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    kept = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    rows = F.sort_array(F.collect_list(F.struct("place", "vec_id", "score")))
    return kept.groupBy(*by).agg(rows.alias("best"))


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = POSITIVES,
    k: int = K,
    scale: int = SCALE,
    low: int = LOW,
    high: int = HIGH,
    anchor_block: int = ANCHOR_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``, and
    ``anchor_row`` and ``position``, which tell equal ids apart.

    The negatives of a positive with score p are the first ``k`` rows of other labels with
    ``low * p <= 100 * score <= high * p``.
    """
    label = F.col("label") if label is None else label
    rows = stored(usable(vectors, label, scale), "vectors")
    none = F.array().cast("array<long>")
    candidates = stored(packed(rows.withColumn("limits", none), candidate_block), "candidates")
    chosen = stored(rows.filter(is_anchor), "chosen")
    blocks = packed(chosen.withColumn("limits", none), anchor_block)
    found = searched(candidates, blocks, positives, True)
    # Rank 0 is the best positive, whose limit is the highest.
    ordered = first_rows(found, ["anchor"], positives)
    windows = F.transform(
        F.filter("best", lambda x: x.score >= 0),
        lambda x: F.struct(
            x.vec_id.alias("positive_id"),
            x.score.alias("positive_score"),
            F.call_function("div", x.score * high, F.lit(100)).alias("upper"),
            F.call_function("div", x.score * low + 99, F.lit(100)).alias("lower"),
        ),
    )
    windows = stored(
        ordered.select("anchor", windows.alias("windows")).filter(F.size("windows") > 0), "windows"
    )

    def padded(name: str) -> Column:
        """One limit per slot; missing positives repeat the last one's limit, with an empty slot."""
        return F.transform(
            F.sequence(F.lit(0), F.lit(positives - 1)),
            lambda i: F.col("windows")[F.least(i, F.size("windows") - 1)][name],
        )

    limited = chosen.join(
        windows.select(
            F.col("anchor").alias("_row"),
            F.concat(padded("upper"), padded("lower")).alias("limits"),
        ),
        "_row",
    )
    blocks = packed(limited, anchor_block)
    slots = first_rows(searched(candidates, blocks, k, False), ["anchor", "slot"], k)
    listed = slots.groupBy("anchor").agg(F.collect_list(F.struct("slot", "best")).alias("_slots"))
    falling = F.flatten(
        F.transform(
            F.sort_array("_slots"),
            lambda s: F.transform(
                s.best, lambda x: F.struct(s.slot.alias("slot"), x.vec_id.alias("vec_id"), x.score.alias("score"))
            ),
        )
    )
    merged = listed.select("anchor", falling.alias("falling")).join(windows, "anchor")
    each = merged.select(
        "anchor", "falling", F.posexplode("windows").alias("position", "window")
    )
    # The last of equal limits begins the slot that holds their scores; slots before it are empty.
    suffix = F.slice(F.filter("falling", lambda x: x.slot >= F.col("position")), 1, k)
    inside = F.filter(suffix, lambda x: x.score >= F.col("window.lower"))
    answers = each.select(
        "anchor", "position", "window.positive_id", "window.positive_score",
        F.posexplode(inside).alias("place", "negative"),
    )
    names = chosen.select(F.col("_row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return answers.join(names, "anchor").select(
        "anchor_id",
        "positive_id",
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("negative.vec_id").alias("negative_id"),
        "positive_score",
        F.col("negative.score").alias("negative_score"),
        F.col("anchor").alias("anchor_row"),
        F.col("position").alias("position"),
    )


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved
    ).drop("anchor_row", "position")


ORACLE = f"""
with v as (
  select row_number() over () as r, vec_id,
         case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as e
  from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select a.r as anchor, a.vec_id as anchor_id, c.r as other, c.vec_id, c.label = a.label as same,
         list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2]))::bigint as score
  from v a join v c on a.r <> c.r and len(a.e) = len(c.e) where a.vec_id % 100 = 0),
positives as (
  select anchor, anchor_id, other, vec_id as positive_id, score as positive_score
  from pairs where same
  qualify row_number() over (partition by anchor order by score desc, vec_id, other) <= {POSITIVES}),
negatives as (
  select p.anchor_id, p.positive_id, n.vec_id as negative_id, p.positive_score,
         n.score as negative_score,
         row_number() over (partition by p.anchor, p.other order by n.score desc, n.vec_id) as rank
  from positives p join pairs n on n.anchor = p.anchor and not n.same
   and {LOW} * p.positive_score <= 100 * n.score and 100 * n.score <= {HIGH} * p.positive_score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score
from negatives where rank <= {K}"""
