"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Documents of equal n-gram sets become one node. An n-gram's frequency is read from a table of
fixed size into which all n-grams of all documents are counted. The columns of a node fall into
two blocks: its rarest n-grams, as many as two sets at the threshold must share one of, and the
rest. The product of the rare block is accumulated as overlap counts; a pair is discarded when its
count stays below what the two sizes require, and the rest of the columns are multiplied for the
pairs that remain.

A rare n-gram shared by few nodes gives its pairs directly. One shared by more (a group of near
copies) is first joined to its most typical node alone; what that links is one component, and
pairs inside a component need no test. The nodes outside the main component then meet all others
in blocks: one task per block pair takes the product of the rare columns, and that of all columns
for the nodes that remain. No pair is lost: each pair of nodes
that shares a rare n-gram is tested, or already connected.

Defined results: a text without words has an empty set and is linked with nothing; fewer words
than ``size`` are one n-gram; rows of equal id are kept apart, each with its own text; a null id
is smaller than none, so a component's id is null only if all its ids are; an empty table gives
no row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snaptrack.llm.graph import block_pairs, components, task_totals
from snaptrack.llm.ragged import SpanHasher, bounds, lowered, mixed, pieces, words
from snaptrack.llm.tables import stored, table, told_apart

COUNTERS = 1 << 18
MARKS = 1 << 22
COPY = "_copy"
FEW = 128
BLOCK = 256
COLUMNS = 8192
FACTOR = np.uint64(0xD6E8FEB86659FD93)


def ngram_sets(data, offsets, size: int, hasher: SpanHasher) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    data = lowered(data)
    starts, ends, at = words(data, offsets)
    hashed = hasher(data, starts, ends)
    grams = np.zeros(len(hashed), np.uint64)
    for i in range(min(size, len(hashed))):
        grams[: len(hashed) - i] += hashed[i:] * np.uint64(pow(int(FACTOR), i + 1, 1 << 64))
    grams = mixed(grams)
    found = []
    for low, high in zip(at[:-1].tolist(), at[1:].tolist()):
        if high - low >= size:
            found.append(np.unique(grams[low : high - size + 1]))
        elif high > low:
            turn = FACTOR ** np.arange(1, high - low + 1, dtype=np.uint64)
            whole = (hashed[low:high] * turn).sum(dtype=np.uint64) + np.uint64(high - low)
            found.append(mixed(np.array([whole])))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def set_digest(grams: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    first = mixed(grams ^ FACTOR).sum(dtype=np.uint64)
    turn = np.uint64(0xA24BAED4963EE407)
    second = np.bitwise_xor.reduce(mixed(grams + turn)) if len(grams) else np.uint64(0)
    both = mixed(np.array([first, second + np.uint64(len(grams))])).view(np.int64)
    return int(both[0]), int(both[1])


def frequencies(docs: DataFrame, size: int) -> np.ndarray:
    """How often the n-grams of each slot occur in the sets of all documents."""

    def update(batches, total):
        hasher = SpanHasher()
        for _, data, offsets in pieces(batches):
            for grams in ngram_sets(data, offsets, size, hasher):
                np.add.at(total, (grams % np.uint64(COUNTERS)).astype(np.int64), 1)

    return task_totals(docs.select("text"), update, COUNTERS)


def described(docs: DataFrame, size: int, percent: int, counts: np.ndarray) -> DataFrame:
    """Per document its set size, digest, rarest n-grams and how frequent those are; ``copy``
    tells apart the rows of one id, where ``docs`` have one."""
    copy = F.col(COPY) if COPY in docs.columns else F.lit(0).cast("long")

    def run(batches) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for part, data, offsets in pieces(batches):
            sets = ngram_sets(data, offsets, size, hasher)
            sizes = np.array([len(grams) for grams in sets], np.int64)
            lengths = np.where(sizes > 0, sizes + (-percent * sizes // 100) + 1, 0)
            rare, typical = [np.zeros(0, np.uint64)], []
            for grams, length in zip(sets, lengths.tolist()):
                often = counts[(grams % np.uint64(COUNTERS)).astype(np.int64)]
                order = np.lexsort((grams, often))[:length]
                rare.append(grams[order])
                typical.append(float(np.log1p(often[order]).mean()) if length else 0.0)
            digests = [set_digest(grams) for grams in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").cast(pa.int64()),
                    part.column("copy"),
                    pa.array(sizes),
                    pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([d[1] for d in digests], pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(bounds(lengths).astype(np.int32)),
                        pa.array(np.concatenate(rare).view(np.int64)),
                    ),
                    pa.array(typical, pa.float64()),
                ],
                ["doc_id", "copy", "n", "d1", "d2", "rare", "typical"],
            )

    return docs.select("doc_id", copy.alias("copy"), "text").mapInArrow(
        run, "doc_id long, copy long, n long, d1 long, d2 long, rare array<long>, typical double"
    )


def slot_of(ids: pa.Array) -> np.ndarray:
    """Where an id is marked; nulls are marked as 0."""
    values = ids.cast(pa.int64()).fill_null(0).to_numpy().view(np.uint64)
    return (mixed(values) % np.uint64(MARKS)).astype(np.int64)


def sets_of(docs: DataFrame, nodes: DataFrame, needed: DataFrame, size: int) -> DataFrame:
    """``node, grams`` of the needed nodes, from the texts.

    Ids of the needed documents are marked in a bit table of fixed size, so that few other
    documents leave the scan; the digest decides which text is meant.
    """
    wanted = stored(nodes.join(needed, "node", "left_semi").select("node", "rep", "d1", "d2"), "wanted")

    def mark(batches, total):
        for batch in batches:
            total[slot_of(batch.column("rep"))] = 1

    marks = task_totals(wanted.select("rep"), mark, MARKS, np.uint8, np.maximum)

    def run(batches) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            batch = batch.filter(pa.array(marks[slot_of(batch.column("doc_id"))] > 0))
            for _, data, offsets in pieces([batch]):
                sets = ngram_sets(data, offsets, size, hasher)
                digests = [set_digest(grams) for grams in sets]
                ends = bounds(np.array([len(grams) for grams in sets])).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([d[0] for d in digests], pa.int64()),
                        pa.array([d[1] for d in digests], pa.int64()),
                        pa.ListArray.from_arrays(
                            pa.array(ends), pa.array(np.concatenate(sets).view(np.int64))
                        ),
                    ],
                    ["d1", "d2", "grams"],
                )

    found = docs.select("doc_id", "text").mapInArrow(run, "d1 long, d2 long, grams array<long>")
    return stored(
        found.join(wanted.select("node", "d1", "d2"), ["d1", "d2"])
        .groupBy("node").agg(F.first("grams").alias("grams")),
        "sets",
    )


def sizes_fit(x: Column, y: Column, percent: int) -> Column:
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def least_common(x: Column, y: Column, percent: int) -> Column:
    """Rare n-grams two sets at the threshold must share, from their sizes: the whole overlap
    they need less what can lie outside the rare block of the one whose block ends first."""
    overlap = F.ceil((x + y) * percent / F.lit(100.0 + percent) - 1e-9)
    outside = F.greatest(*[F.ceil(n * percent / F.lit(100.0) - 1e-9) - 1 for n in (x, y)])
    return F.greatest(F.lit(1), overlap - outside)


def tested(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose whole sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("_x"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("_y"))
    common = F.size(F.array_intersect("_x", "_y"))
    union = F.size("_x") + F.size("_y") - F.col("_common")
    return (
        pairs.select("a", "b").join(left, "a").join(right, "b")
        .select("a", "b", "_x", "_y", common.alias("_common"))
        .filter(F.col("_common") * 100 >= union * percent)
        .select("a", "b")
    )


def overlaps(lists) -> np.ndarray:
    """Sizes of all pairwise intersections: the product of the incidence matrix with itself."""
    columns = np.unique(np.concatenate(lists.to_list()), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(lists)), lists.map(len))
    total = np.zeros((len(lists), len(lists)), np.float32)
    for low in range(0, int(columns.max()) + 1, COLUMNS):
        inside = (columns >= low) & (columns < low + COLUMNS)
        block = np.zeros((len(lists), COLUMNS), np.float32)
        block[owner[inside], columns[inside] - low] = 1
        total += block @ block.T
    return total


def block_candidates(percent: int):
    """The rows of a block pair that some other row may link with, by sizes and rare n-grams."""

    def run(key, rows):
        n, comp = rows["n"].to_numpy(), rows["comp"].to_numpy()
        total, low = n[:, None] + n[None], np.minimum(n[:, None], n[None])
        high = total - low
        outside = -(-percent * high // 100) - 1
        needed = np.maximum(1, -(-percent * total // (100 + percent)) - outside)
        open_pair = (low * 100 >= high * percent) & (overlaps(rows["rare"]) >= needed)
        open_pair &= comp[:, None] != comp[None]
        return rows.loc[open_pair.any(axis=1), ["gram", "inside", "i", "j", "node", "comp"]]

    return run


def block_links(percent: int):
    """Links of a block pair from the product of its incidence matrices, as few as connect."""

    def run(key, rows):
        import pandas as pd

        rows = rows.sort_values("node", ignore_index=True)
        sizes = rows["grams"].map(len).to_numpy()
        overlap = overlaps(rows["grams"])
        union = sizes[:, None] + sizes[None] - overlap
        a, b = np.nonzero(np.triu(overlap * 100 >= union * percent, 1))
        top, first = list(range(len(rows))), {}
        for i, comp in enumerate(rows["comp"].tolist()):  # connected already
            top[i] = first.setdefault(comp, i)

        def root(i):
            while top[i] != i:
                top[i] = top[top[i]]
                i = top[i]
            return i

        nodes, out = rows["node"].to_numpy(), []
        for i, j in zip(a.tolist(), b.tolist()):
            p, q = root(i), root(j)
            if p != q:
                top[max(p, q)] = min(p, q)
                out.append((nodes[i], nodes[j]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def links(docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """Links ``a, b`` that connect the nodes of every component."""
    entries = nodes.select("node", "n", "typical", F.explode("rare").alias("gram"))
    grams = entries.groupBy("gram").agg(
        F.count("*").alias("m"), F.max(F.struct("typical", "node", "n")).alias("hub")
    ).filter("m > 1")
    grams = stored(
        grams.select("gram", "m", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n")),
        "grams",
    )
    shared = stored(entries.drop("typical").join(grams, "gram"), "entries")
    many = shared.filter(F.col("m") > FEW)
    stars = many.filter("node <> hub").groupBy("node", "hub").agg(
        F.count("*").alias("c"), F.first("n").alias("n"), F.first("hub_n").alias("hub_n")
    )
    n, hub_n = F.col("n"), F.col("hub_n")
    stars = stored(
        stars.filter(sizes_fit(n, hub_n, percent) & (F.col("c") >= least_common(n, hub_n, percent)))
        .select(F.col("node").alias("a"), F.col("hub").alias("b")),
        "stars",
    )
    ends = stars.selectExpr("a as node").union(stars.selectExpr("b as node")).distinct()
    found = stored(tested(stars, sets_of(docs, nodes, ends, size), percent), "links")
    comps = stored(components(found), "components")

    # A pair that shares an unresolved frequent n-gram is met in blocks, any other by its count.
    marked = many.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    main = comps.select(F.col("node").alias("hub"), F.col("comp").alias("_main"))
    marked = marked.join(main, "hub", "left").withColumn("_main", F.coalesce("_main", "hub"))
    marked = stored(marked.select("gram", "node", "comp", "_main"), "marked")
    met = block_pairs(marked, "gram", BLOCK).join(nodes.select("node", "n", "rare"), "node")
    met = met.groupBy("gram", "inside", "i", "j").applyInPandas(
        block_candidates(percent),
        "gram long, inside boolean, i long, j long, node long, comp long",
    )

    few = shared.filter(F.col("m") <= FEW).select("gram", F.struct("node", "n").alias("x"))
    listed = few.groupBy("gram").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    x, y = F.col("x"), F.col("y")
    pairs = (
        listed.select(F.posexplode("xs").alias("i", "x"), "xs")
        .select("x", F.explode(F.slice("xs", F.col("i") + 2, F.lit(FEW))).alias("y"))
        .filter(sizes_fit(x["n"], y["n"], percent))
        .groupBy(x["node"].alias("a"), y["node"].alias("b"))
        .agg(F.count("*").alias("c"), F.first(x["n"]).alias("n"), F.first(y["n"]).alias("hub_n"))
        .filter(F.col("c") >= least_common(n, hub_n, percent))
    )
    pairs = stored(pairs.select("a", "b"), "pairs")
    for side in "ab":
        known = comps.select(F.col("node").alias(side), F.col("comp").alias(f"_{side}"))
        pairs = pairs.join(known, side, "left")
    apart = F.coalesce("_a", "a") != F.coalesce("_b", "b")
    pairs = stored(pairs.filter(apart).select("a", "b"), "pairs")
    met = stored(met, "met")
    ends = pairs.selectExpr("a as node").union(pairs.selectExpr("b as node"))
    sets = sets_of(docs, nodes, ends.union(met.select("node")).distinct(), size)
    inside = met.join(sets, "node").groupBy("gram", "inside", "i", "j")
    return stored(
        found.union(tested(pairs, sets, percent)).union(
            inside.applyInPandas(block_links(percent), "a long, b long")
        ),
        "links",
    )


def jaccard_groups(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id, copy, n, comp, component_id``, one row per document; those without a set have no
    ``comp`` and their own id."""
    rows = stored(described(docs, size, percent, frequencies(docs, size)), "described")
    nodes = (
        rows.filter("n > 0").groupBy("d1", "d2")
        .agg(
            F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("rare").alias("rare"),
            F.first("typical").alias("typical"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = stored(nodes, "nodes")
    comps = components(links(docs, nodes, size, percent))
    named = nodes.select("node", "d1", "d2", "rep").join(comps, "node", "left")
    named = stored(named.withColumn("comp", F.coalesce("comp", "node")), "named")
    lowest = stored(named.groupBy("comp").agg(F.min("rep").alias("component_id")), "lowest")
    named = stored(named.join(lowest, "comp").select("d1", "d2", "comp", "component_id"), "named")
    full = rows.filter("n > 0").join(named, ["d1", "d2"])
    empty = rows.filter("n = 0").withColumns(
        {"comp": F.lit(None).cast("long"), "component_id": F.col("doc_id")}
    )
    columns = ["doc_id", "copy", "n", "comp", "component_id"]
    return full.select(columns).union(empty.select(columns))


def jaccard_components(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per document."""
    groups = jaccard_groups(docs.select("doc_id", "text"), size, percent)
    return groups.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, that of the smallest id, and all without words.

    A null id is larger than any other; rows of one id are told apart by a hash of their text.
    """
    known = told_apart(docs, COPY)
    groups = stored(jaccard_groups(known.select("doc_id", COPY, "text"), size, percent), "groups")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "copy")
    first = groups.filter("comp is not null").groupBy("comp").agg(F.min(order).alias("first"))
    keep = first.select("first.doc_id", "first.copy").union(
        groups.filter("comp is null").select("doc_id", "copy")
    )
    keep = stored(keep.toDF("_id", "_of"), "keep")
    own = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col(COPY) == F.col("_of"))
    return known.join(keep, own, "left_semi").select(*docs.columns)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), size=3, percent=90)


ORACLE = """
with recursive base as (
  select row_number() over () as r, doc_id,
         list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
  from documents),
sets as (
  select r, doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))
    end as s from base),
grams as (select r, unnest(s) as g from sets),
common as (
  select a.r as x, b.r as y, count(*) as c
  from grams a join grams b on a.g = b.g and a.r < b.r group by all),
links as (
  select x, y from common join sets a on a.r = x join sets b on b.r = y
  where 100 * c >= 90 * (len(a.s) + len(b.s) - c)),
edges as (select x, y from links union all select y, x from links),
reach as (
  select r as x, r as y from sets
  union select reach.x, edges.y from reach join edges on reach.y = edges.x)
select s.doc_id, len(s.s)::bigint as n_shingles, min(o.doc_id) as component_id
from reach join sets s on s.r = reach.x join sets o on o.r = reach.y group by s.r, s.doc_id, s.s"""
