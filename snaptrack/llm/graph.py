"""Connected components and fixed-size sums over all tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from snaptrack.llm.tables import stored

BLOCKS = 64


def components(links: DataFrame) -> DataFrame:
    """``node, comp`` for every node of the links ``a, b``; comp is the smallest node reached.

    Every round takes the smallest label among the neighbours and then the label's own label,
    which halves the way to go; each round is a written table. Only counts reach the driver.
    """
    both = links.selectExpr("a as node", "b as other").union(
        links.selectExpr("b as node", "a as other")
    )
    edges = stored(both.filter("node <> other").distinct(), "edges")
    labels = stored(
        edges.groupBy("node").agg(F.least("node", F.min("other")).alias("comp")), "labels"
    )
    while True:
        near = edges.join(labels.withColumnRenamed("node", "other"), "other")
        lowest = near.groupBy("node").agg(F.min("comp").alias("_near"))
        step = labels.join(lowest, "node").select(
            "node", F.least("comp", "_near").alias("comp"), F.col("comp").alias("_old")
        )
        step = stored(step, "labels")
        ahead = step.select(F.col("node").alias("comp"), F.col("comp").alias("_next"))
        new = stored(
            step.join(ahead, "comp").select(
                "node", F.least("comp", "_next").alias("comp"), "_old"
            ),
            "labels",
        )
        changed = new.filter("comp <> _old").limit(1).count()
        labels = new.drop("_old")
        if not changed:
            return labels


def block_pairs(members: DataFrame, key: str, block: int) -> DataFrame:
    """Rows dealt to pairs of blocks in which every two members of a key that may need a test meet.

    ``members`` are stored rows with ``key, node, comp, _main``: members of the component
    ``_main`` need no test among themselves. Blocks hold about ``block`` nodes; a key whose
    members are all of one component has none. A row's ``inside, i, j`` name its pair.
    """
    is_main = F.col("comp") == F.col("_main")
    sizes = members.groupBy(key).agg(
        F.count_if(is_main).alias("_in"), F.count_if(~is_main).alias("_out")
    ).filter("_out > 0")
    sizes = sizes.select(
        key, F.ceil(F.col("_in") / block).alias("_ins"), F.ceil(F.col("_out") / block).alias("_outs")
    )
    count = F.when(is_main, F.col("_ins")).otherwise(F.col("_outs"))
    met = members.join(stored(sizes, "blocks"), key).withColumns(
        {"_inside": is_main, "_block": F.pmod(F.xxhash64("node"), count)}
    )

    def each(upto: str, pair) -> Column:
        every = F.sequence(F.lit(0).cast("long"), F.col(upto) - 1)
        return F.when(F.col(upto) > 0, F.transform(every, pair)).otherwise(
            F.array().cast("array<struct<inside:boolean,i:bigint,j:bigint>>")
        )

    def place(inside: bool, i, j) -> Column:
        return F.struct(F.lit(inside).alias("inside"), i.alias("i"), j.alias("j"))

    own = F.col("_block")
    outer = each("_outs", lambda j: place(False, F.least(j, own), F.greatest(j, own)))
    to_main = each("_ins", lambda j: place(True, own, j))
    from_main = each("_outs", lambda i: place(True, i, own))
    places = F.when(F.col("_inside"), from_main).otherwise(F.concat(outer, to_main))
    return met.withColumn("at", F.explode(places)).select(key, "at.*", "node", "comp")


def task_totals(
    df: DataFrame,
    update: Callable[[Iterator[pa.RecordBatch], np.ndarray], None],
    size: int,
    dtype=np.int64,
    merge=np.add,
) -> np.ndarray:
    """One array of ``size`` numbers over all rows: ``update`` fills one per task, ``merge`` joins
    them. Tasks send blocks of the array, without empty ones and as places and values where few are
    set; blocks are merged one at a time, and the size is fixed. Zeros must not count in ``merge``."""
    part = size // BLOCKS
    kind = np.dtype(dtype)

    def sparse(values: np.ndarray) -> tuple[bytes, bytes]:
        at = np.flatnonzero(values)
        if 0 < len(at) * (4 + kind.itemsize) < part * kind.itemsize:
            return at.astype(np.int32).tobytes(), values[at].tobytes()
        return b"", values.tobytes()

    def batch_of(found: dict[int, tuple[bytes, bytes]]):
        cells = list(zip(*found.values()))
        return pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int32()), *(pa.array(list(c), pa.binary()) for c in cells)],
            ["block", "places", "sums"],
        )

    def fill(batches):
        total = np.zeros(size, dtype)
        update(batches, total)
        blocks = total[: part * BLOCKS].reshape(BLOCKS, part)
        found = {int(i): sparse(blocks[i]) for i in np.flatnonzero(blocks.any(1))}
        if found:
            yield batch_of(found)

    def join(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, places, sums in zip(*(c.to_pylist() for c in batch.columns)):
                if block not in found:
                    found[block] = np.zeros(part, dtype)
                at = np.frombuffer(places, np.int32) if places else slice(None)
                found[block][at] = merge(found[block][at], np.frombuffer(sums, dtype))
        if found:
            yield batch_of({block: sparse(values) for block, values in found.items()})

    schema = "block int, places binary, sums binary"
    rows = df.mapInArrow(fill, schema).repartition(BLOCKS, "block").mapInArrow(join, schema)
    total = np.zeros(size, dtype)
    for row in rows.collect():  # BLOCKS rows of a fixed size
        target = total[row["block"] * part : (row["block"] + 1) * part]
        at = np.frombuffer(row["places"], np.int32) if row["places"] else slice(None)
        target[at] = np.frombuffer(row["sums"], dtype)
    return total
