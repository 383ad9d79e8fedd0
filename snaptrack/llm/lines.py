"""Line dedup by a segment-partition edit join.

Lines of ``MIN_BYTES`` UTF-8 bytes or more that differ by at most ``edits`` edits are one
class with all they reach; the class keeps its first line in the order of (doc_id, line number),
every other one goes. Shorter lines stay, or with ``short`` go if they hold a word and equal an
earlier line: the digests find them, the edit join never sees them. The query and the pipeline set it.

Edits count bytes, or characters with ``whole``, as the query and the pipeline set it: then an accent
is one edit in any script. ``MIN_BYTES`` counts bytes in both, so no line that took part by bytes is
left out by characters, and lines within some edits by bytes are so by characters.

A line of n units is split into ``edits + 1`` even segments. If two lines are within the
threshold, one segment of the shorter is a substring of the longer, at a place that the lengths
allow. So each line probes, for each length it could match, the few substrings that segments of
that length may equal; the probes at its own segments are its index entries. Keys met by one line
alone are left out. What remains is verified exactly: common ends are trimmed, and the rest runs
through a bit-parallel automaton whose words hold the band of ``2 * edits + 1`` diagonals, for
all pairs at once.

A key of few lines gives its pairs directly. One of more (a template's lines) is first joined to
one of them; the lines that are not linked with it meet all others in blocks.

Defined results: null and empty texts stay; repeated lines inside a document go like others; rows of
one id, null too, are rows of their own, ordered by line number and then by a hash of their text, so
that one line of each class is left whatever the ids; every row gives one row with the columns of
its input; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from snaptrack.llm.graph import block_pairs, components, task_totals
from snaptrack.llm.ragged import (
    BASE, SPACE, SpanHasher, bounds, characters, flat, mixed, pieces, take
)
from snaptrack.llm.tables import has_word, stored, table, told_apart

EDITS = 2
MIN_BYTES = 32
MARKS = 1 << 24
FEW = 64
BLOCK = 256
NO_ID = -(1 << 63)
COPY = "_copy"
CELLS = 1 << 22


def line_spans(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of all lines, without line breaks, and how many each text has."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    counts = np.diff(np.searchsorted(breaks, offsets)) + 1
    return starts, ends, counts


def probes(edits: int) -> list[tuple[int, int, int]]:
    """``(shorter by, segment, shift)`` of all substrings to probe, own segments first.

    The shift is bounded from the left and from the right: before segment i lie at most i edits,
    after it at most ``edits - i``, of which the difference in length takes its share.
    """
    found = [
        (shorter, i, shift)
        for shorter in range(edits + 1)
        for i in range(edits + 1)
        for shift in range(max(-i, shorter - edits + i), min(i, shorter + edits - i) + 1)
    ]
    return sorted(found, key=lambda probe: (probe[0] > 0 or probe[2] != 0, probe))


def line_keys(
    data, starts, ends, edits: int, hasher: SpanHasher, least: int = MIN_BYTES
) -> np.ndarray:
    """Lines x probes; 0 where a probe does not apply. Lines have ``least`` units or more."""
    size, keys = ends - starts, []
    hasher.grow(len(data) + 1)
    sums = bounds64(hasher, data)
    for shorter, i, shift in probes(edits):
        length = size - shorter
        base, longer = length // (edits + 1), length % (edits + 1)
        plain = edits + 1 - longer
        at = i * base + np.maximum(0, i - plain) + shift
        width = base + (i >= plain)
        good = (at >= 0) & (at + width <= size) & (length >= least)
        low = starts + np.where(good, at, 0)
        high = low + np.where(good, width, 0)
        spans = (sums[high] - sums[low]) * hasher.inverses[low]
        named = np.uint64((i + 1) * 0xD1B54A32D192ED03 % (1 << 64)) + length.astype(np.uint64)
        keys.append(np.where(good, mixed(mixed(spans) + mixed(named)) | np.uint64(1), np.uint64(0)))
    return np.stack(keys, axis=1) if keys else np.zeros((len(starts), 0), np.uint64)


def bounds64(hasher: SpanHasher, data: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    if data.dtype == np.uint8:
        codes = hasher.codes[data]
    else:  # the same for the same number
        codes = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(BASE) + np.uint64(hasher.seed)
        codes = mixed(codes)
    np.cumsum(codes * hasher.powers[: len(data)], out=sums[1:])
    return sums


def described(docs: DataFrame, edits: int, short: bool, whole: bool) -> DataFrame:
    """One row per line that takes part: its place, digest and keys; short lines have no keys."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        first, second, third = (SpanHasher(seed) for seed in (21, 22, 23))
        for part, data, offsets in pieces(batches, most=1 << 20):
            starts, ends, counts = line_spans(data, offsets)
            owner = np.repeat(np.arange(len(counts)), counts)
            number = np.arange(len(starts)) - np.repeat(bounds(counts)[:-1], counts)
            meant = ends - starts >= MIN_BYTES
            if short:
                solid = bounds(~SPACE[data])
                meant |= solid[ends] > solid[starts]
            starts, ends, owner, number = (x[meant] for x in (starts, ends, owner, number))
            d1, d2 = first(data, starts, ends), second(data, starts, ends)
            fresh = np.unique(d1, return_index=True)[1]
            fresh = fresh[ends[fresh] - starts[fresh] >= MIN_BYTES]
            units, least = (data, starts[fresh], ends[fresh]), MIN_BYTES
            if whole:
                units, least = characters(*units), MIN_BYTES // 4
            keys = line_keys(*units, edits, third, least)
            lengths = np.zeros(len(starts), np.int64)
            lengths[fresh] = keys.shape[1]
            order = np.argsort(fresh)
            ids = part.column("doc_id").cast(pa.int64()).fill_null(NO_ID).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[owner]),
                    part.column("row").take(pa.array(owner)),
                    pa.array(number.astype(np.int32)),
                    pa.array(d1.view(np.int64)),
                    pa.array(d2.view(np.int64)),
                    pa.ListArray.from_arrays(
                        pa.array(bounds(lengths).astype(np.int32)),
                        pa.array(keys[order].ravel().view(np.int64)),
                    ),
                ],
                ["id", "row", "line", "d1", "d2", "keys"],
            )

    return docs.select("doc_id", "text", F.col(COPY).alias("row")).mapInArrow(
        run, "id long, row long, line int, d1 long, d2 long, keys array<long>"
    )


def marker(name: str):
    """Marks the values of a column in a table of fixed size."""

    def mark(batches, total: np.ndarray) -> None:
        for batch in batches:
            total[batch.column(name).to_numpy().view(np.uint64) % np.uint64(MARKS)] = 1

    return mark


def shared_keys(lines: DataFrame, edits: int) -> DataFrame:
    """``key, d1, index`` of the keys that several lines meet at, one of them by a segment."""
    own = edits + 1
    each = lines.select("d1", F.posexplode("keys").alias("at", "key")).filter("key <> 0")
    keys = each.groupBy("key").agg(
        F.min("d1").alias("low"), F.max("d1").alias("high"), F.min("at").alias("at")
    ).filter((F.col("low") < F.col("high")) & (F.col("at") < own))
    keys = stored(keys.select("key"), "keys")
    marks = task_totals(keys, marker("key"), MARKS, np.uint8, np.maximum) > 0

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("keys")
            counts = lists.value_lengths().to_numpy()
            values = lists.flatten().to_numpy().view(np.uint64)
            row = np.repeat(np.arange(len(counts)), counts)
            at = np.arange(len(values)) - np.repeat(bounds(counts)[:-1], counts)
            keep = marks[values % np.uint64(MARKS)] & (values != 0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(values[keep].view(np.int64)),
                    batch.column("d1").take(pa.array(row[keep])),
                    pa.array(at[keep] < own),
                ],
                ["key", "d1", "index"],
            )

    found = lines.select("d1", "keys").mapInArrow(run, "key long, d1 long, index boolean")
    return stored(
        found.join(keys, "key").groupBy("key", "d1").agg(F.max("index").alias("index")), "entries"
    )


def texts_of(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """``node, d1, d2, line`` of the lines with the needed digests, each distinct line once."""
    marks = task_totals(needed, marker("d1"), MARKS, np.uint8, np.maximum) > 0

    def run(batches) -> Iterator[pa.RecordBatch]:
        first, second = SpanHasher(21), SpanHasher(22)
        for _, data, offsets in pieces(batches):
            starts, ends, _ = line_spans(data, offsets)
            long = ends - starts >= MIN_BYTES
            starts, ends = starts[long], ends[long]
            d1 = first(data, starts, ends)
            fresh = np.unique(d1, return_index=True)[1]
            fresh = fresh[marks[d1[fresh] % np.uint64(MARKS)]]
            starts, ends = starts[fresh], ends[fresh]
            raw = take(data, starts, ends - starts).tobytes()
            at = bounds(ends - starts).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(d1[fresh].view(np.int64)),
                    pa.array(second(data, starts, ends).view(np.int64)),
                    pa.BinaryArray.from_buffers(
                        pa.binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(raw)]
                    ),
                ],
                ["d1", "d2", "line"],
            )

    found = docs.select("text").mapInArrow(run, "d1 long, d2 long, line binary")
    lines = found.join(needed, "d1", "left_semi").groupBy("d1", "d2").agg(
        F.first("line").alias("line")
    )
    return stored(lines.withColumn("node", F.monotonically_increasing_id()), "texts")


def automaton(a, sizes_a, b, sizes_b, edits: int) -> np.ndarray:
    """Whether rows of the padded matrices ``a`` and ``b`` are within ``edits`` edits.

    Bit ``o + edits`` of ``state[d]`` says that the first j bytes of b and the first j + o of a
    are within d edits.
    """
    band, result = (1 << 2 * edits + 1) - 1, np.zeros(len(a), bool)
    rows = np.arange(len(a))
    room = np.minimum(sizes_a, edits)
    state = [(2 << np.minimum(room, d)) - 1 << edits for d in range(edits + 1)]
    for j in range(int(sizes_b.max(initial=0)) + 1):
        ended = sizes_b[rows] == j
        place = sizes_a[rows] - j + edits
        reached = (place >= 0) & (place <= 2 * edits)
        reached &= state[edits] >> np.clip(place, 0, 2 * edits) & 1 == 1
        result[rows[ended & reached]] = True
        alive = ~ended & (state[edits] != 0)
        rows, state = rows[alive], [bits[alive] for bits in state]
        if not len(rows):
            break
        match = np.zeros(len(rows), np.int64)
        for shift in range(-edits, edits + 1):
            at = j + shift
            if 0 <= at < a.shape[1]:
                same = (a[rows, at] == b[rows, j]) & (at < sizes_a[rows])
                match |= same.astype(np.int64) << shift + edits
        first = max(0, edits - j - 1)
        last = np.clip(sizes_a[rows] - j - 1 + edits, -1, 2 * edits)
        valid = (2 << last) - 1 & band & ~((1 << first) - 1)
        new = [state[0] & match & valid]
        for d in range(1, edits + 1):
            moved = state[d] & match | state[d - 1] | state[d - 1] >> 1 | new[d - 1] << 1
            new.append(moved & valid)
        state = new
    return result


def padded(data, starts, sizes) -> np.ndarray:
    out = np.zeros((len(starts), int(sizes.max(initial=0)) + 1), data.dtype)
    rows = np.repeat(np.arange(len(starts)), sizes)
    out[rows, np.arange(len(rows)) - np.repeat(bounds(sizes)[:-1], sizes)] = take(
        data, starts, sizes
    )
    return out


def within(data, starts_a, sizes_a, starts_b, sizes_b, edits: int) -> np.ndarray:
    """Which pairs of spans of bytes or characters are within ``edits`` edits."""
    result = np.zeros(len(starts_a), bool)
    order = np.argsort(np.maximum(sizes_a, sizes_b), kind="stable")
    order = order[np.abs(sizes_a - sizes_b)[order] <= edits]
    widths = np.maximum(sizes_a, sizes_b)[order] + 1
    low = 0
    while low < len(order):
        high = low + 1
        while high < len(order) and widths[min(2 * high - low, len(order)) - 1] * 2 * (
            high - low
        ) <= CELLS:
            high = min(2 * high - low, len(order))
        part, low = order[low:high], high
        sa, na, sb, nb = (x[part] for x in (starts_a, sizes_a, starts_b, sizes_b))
        short = np.minimum(na, nb)
        a, b = padded(data, sa, na), padded(data, sb, nb)
        width = np.arange(min(a.shape[1], b.shape[1]))
        differs = (a[:, : len(width)] != b[:, : len(width)]) | (width >= short[:, None])
        front = np.argmax(differs, axis=1)
        back_a, back_b = padded(data[::-1], len(data) - sa - na, na), padded(
            data[::-1], len(data) - sb - nb, nb
        )
        rest = (short - front)[:, None]
        differs = (back_a[:, : len(width)] != back_b[:, : len(width)]) | (width >= rest)
        back = np.argmax(differs, axis=1)
        na, nb = na - front - back, nb - front - back
        result[part] = automaton(
            padded(data, sa + front, na), na, padded(data, sb + front, nb), nb, edits
        )
    return result


def tested(pairs: DataFrame, texts: DataFrame, edits: int, whole: bool) -> DataFrame:
    """The pairs ``a, b`` of nodes whose lines are within the threshold."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                (x, at), (y, bt) = (flat(part.column(c).cast(pa.large_binary())) for c in "xy")
                data, starts, ends = (
                    np.concatenate([x, y]), np.concatenate([at[:-1], bt[:-1] + len(x)]),
                    np.concatenate([at[1:], bt[1:] + len(x)]),
                )
                if whole:
                    data, starts, ends = characters(data, starts, ends)
                (a, b), (m, n) = np.split(starts, 2), np.split(ends - starts, 2)
                good = within(data, a, m, b, n, edits)
                yield part.select(["a", "b"]).filter(pa.array(good))

    left = texts.select(F.col("node").alias("a"), F.col("line").alias("x"))
    right = texts.select(F.col("node").alias("b"), F.col("line").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    close = F.abs(F.length("x") - F.length("y")) <= edits * (4 if whole else 1)
    return joined.filter(close).mapInArrow(run, "a long, b long")


def block_links(edits: int, whole: bool):
    """Links among the lines of a block pair that are not in one component."""

    def run(key, rows):
        import pandas as pd

        data = np.frombuffer(b"".join(rows["line"]), np.uint8)
        at = bounds(rows["line"].map(len).to_numpy())
        starts, ends, comp, node = at[:-1], at[1:], rows["comp"].to_numpy(), rows["node"].to_numpy()
        if whole:
            data, starts, ends = characters(data, starts, ends)
        sizes = ends - starts
        close = np.abs(sizes[:, None] - sizes[None]) <= edits
        a, b = np.nonzero(np.triu(close & (comp[:, None] != comp[None]), 1))
        good = within(data, starts[a], sizes[a], starts[b], sizes[b], edits)
        return pd.DataFrame({"a": node[a[good]], "b": node[b[good]]}).astype("int64")

    return run


def near_lines(docs: DataFrame, lines: DataFrame, edits: int, whole: bool) -> DataFrame:
    """``d1, d2, comp`` of the lines that some other line is linked with."""
    entries = shared_keys(lines, edits)
    texts = texts_of(docs, stored(entries.select("d1").distinct(), "needed"))
    members = entries.join(texts.select("d1", "node"), "d1").select("key", "node", "index")
    sizes = members.groupBy("key").agg(F.count("*").alias("m"), F.min("node").alias("hub"))
    members = stored(members.join(stored(sizes.filter("m > 1"), "sizes"), "key"), "members")
    x, y = F.col("x"), F.col("y")
    few = members.filter(F.col("m") <= FEW).groupBy("key").agg(
        F.collect_list(F.struct("node", "index")).alias("xs")
    )
    pairs = (
        few.select(F.explode("xs").alias("x"), "xs").filter("x.index")
        .select("x", F.explode("xs").alias("y")).filter(x["node"] != y["node"])
        .select(
            F.least(x["node"], y["node"]).alias("a"), F.greatest(x["node"], y["node"]).alias("b")
        )
    )
    many = members.filter(F.col("m") > FEW)
    stars = many.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    pairs = stored(pairs.union(stars).distinct(), "pairs")
    found = stored(tested(pairs, texts, edits, whole), "links")
    comps = stored(components(found), "components")
    main = comps.select(F.col("node").alias("hub"), F.col("comp").alias("_main"))
    marked = many.join(comps, "node", "left").join(main, "hub", "left").select(
        "key", "node", F.coalesce("comp", "node").alias("comp"),
        F.coalesce("_main", "hub").alias("_main"),
    )
    met = block_pairs(stored(marked, "marked"), "key", BLOCK).join(
        texts.select("node", "line"), "node"
    )
    more = met.groupBy("key", "inside", "i", "j").applyInPandas(
        block_links(edits, whole), "a long, b long"
    )
    comps = components(found.union(more))
    return stored(texts.select("node", "d1", "d2").join(comps, "node").drop("node"), "near")


def dropped_lines(docs: DataFrame, edits: int, short: bool, whole: bool) -> DataFrame:
    """``id, row`` and the numbers of the lines that go; ``docs`` have a ``COPY`` column."""
    lines = stored(described(docs, edits, short, whole), "lines")
    near = near_lines(docs, lines, edits, whole)
    place = F.struct("id", "line", "row")
    first = lines.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = first.join(near, ["d1", "d2"], "left")
    repeated = stored(first.filter("first <> last or comp is not null").drop("last"), "repeated")
    kept = repeated.filter("comp is not null").groupBy("comp").agg(F.min("first").alias("_first"))
    classes = repeated.join(stored(kept, "kept"), "comp", "left").select(
        "d1", "d2", F.coalesce("_first", "first").alias("first")
    )
    gone = lines.select("id", "row", "line", "d1", "d2").join(stored(classes, "classes"), ["d1", "d2"])
    return gone.filter(place != F.col("first")).groupBy("id", "row").agg(
        F.array_sort(F.collect_set("line")).alias("dropped")
    )


def deduplicated(
    docs: DataFrame, edits: int = EDITS, short: bool = False, whole: bool = False
) -> DataFrame:
    """The rows of ``docs`` without their repeated lines, with ``_lines`` and ``_dropped``."""
    known = told_apart(docs, COPY)
    each = known.select(F.struct(*docs.columns).alias("_row"), "doc_id", F.col("text").alias("_text"), COPY)
    gone = dropped_lines(known, edits, short, whole).withColumnsRenamed({"id": "_id", "row": "_of"})
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    own = (key == F.col("_id")) & (F.col(COPY) == F.col("_of"))
    rows = each.join(gone, own, "left").select(
        "_row", "_text", F.split("_text", "\n").alias("_split"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("_dropped"),
    )
    numbers = F.sequence(F.lit(0), F.size("_split") - 1)
    kept = F.transform(F.array_except(numbers, "_dropped"), lambda i: F.get("_split", i))
    text = F.when(F.size("_dropped") > 0, F.array_join(kept, "\n")).otherwise(F.col("_text"))
    columns = [
        text.alias("text") if name == "text" else F.col(f"_row.`{name}`").alias(name)
        for name in docs.columns
    ]
    lines = F.coalesce(F.size("_split"), F.lit(0)).cast("long").alias("_lines")
    return rows.select(*columns, lines, "_dropped")


def without_repeats(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """The documents without repeated lines of any length; one left without a word goes."""
    rows = deduplicated(docs, edits, short=True, whole=True)
    untouched = F.size("_dropped") == 0
    left = has_word(F.coalesce("text", F.lit("")))
    return rows.filter(untouched | left).drop("_lines", "_dropped")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = deduplicated(docs, short=True, whole=True)
    return rows.select(
        "doc_id", F.col("_lines").alias("n_lines"), F.size("_dropped").cast("long").alias("n_dropped"),
        F.col("_dropped").alias("dropped"), "text",
    )
