"""Substring dedup by content-defined chunking.

A gear hash over the last 16 bytes decides where a chunk ends: at one word start in four, and
at one character in 256 wherever there is no white space. Cuts depend on the bytes around them
alone, so an insertion moves no cut but the nearest. What documents share are digests of chunks
beside each other (a long chunk counts alone too): a run of chunks goes on only while each next pair
is shared, so it is not put together from chunks that stand in different places. A pair that several
documents hold belongs to the first of them, by id. Runs that belong to other documents are cut out
of a text if they count ``min_words`` words or more, so a shared short line stays.

Digests are of 64 bits and counted after a document's own repeats are dropped, so what a third of
all documents hold is added up before the shuffle. A bit table of fixed size lets those that occur
once skip the join with the shared ones.

Defined results: null stays null and an empty text empty; repeats inside one document stay; rows
of one id, null too, are documents of their own, ordered by a hash of their text; every row gives
one row, with the columns of its input; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, functions as F

from snaptrack.llm.graph import task_totals
from snaptrack.llm.ragged import BASE, SPACE, SpanHasher, bounds, flat, mixed, pieces, runs
from snaptrack.llm.tables import stored, table, told_apart

MIN_WORDS = 20
MARKS = 1 << 24
REACH = 16
NO_ID = -(1 << 63)
COPY = "_copy"
GEAR = (mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE)) >> np.uint64(32)).astype(
    np.uint32
)


def gear(data: np.ndarray) -> np.ndarray:
    """Rolling hash of the ``REACH`` bytes up to each byte."""
    found, step = GEAR[data], 1
    while step < REACH:
        shifted = found[:-step] << np.uint32(step)
        found[step:] = found[step:] + shifted
        step *= 2
    return found


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sorted chunk bounds, text bounds included. No cut lies in a text's first bytes, where the
    hash would reach into the text before."""
    if not len(data):
        return np.zeros(1, np.int64)
    found = gear(data) >> np.uint32(8)
    at = np.zeros(len(data) + 1, bool)
    space = SPACE[data]
    at[1:-1] = space[:-1] & ~space[1:] & (found[:-1] & np.uint32(3) == 0)
    at[1:-1] |= ((data[1:] & 0xC0) != 0x80) & (found[:-1] & np.uint32(255) == 255)
    starts = offsets[:-1][np.diff(offsets) > 0]
    near = starts[:, None] + np.arange(REACH)
    at[near[near < len(at)]] = False
    at[offsets] = True
    return np.flatnonzero(at)


def word_starts(data: np.ndarray) -> np.ndarray:
    """How many words begin before each byte."""
    begins = ~SPACE[data]
    begins[1:] &= SPACE[data[:-1]]
    return bounds(begins)


def pair_digests(data: np.ndarray, at: np.ndarray, hasher: SpanHasher, min_words: int):
    """Digests of what may be shared, with the first and the last chunk of each. A pair that
    reaches over the end of a text is among them; see ``of_texts``."""
    chunks = hasher(data, at[:-1], at[1:])
    counted = word_starts(data)
    pairs = mixed(mixed(chunks[:-1]) + chunks[1:]) if len(chunks) else chunks
    long = np.flatnonzero(np.diff(counted[at]) >= min_words)
    first = np.concatenate([np.arange(len(pairs)), long])
    last = np.concatenate([np.arange(1, len(pairs) + 1), long])
    return np.concatenate([pairs, mixed(chunks[long])]), first, last, counted


def of_texts(first: np.ndarray, last: np.ndarray, bounds_: np.ndarray):
    """Which of them lie inside one text, and the text, for the chunk bounds of texts."""
    owner = np.searchsorted(bounds_, first, "right") - 1
    return last < bounds_[owner + 1], owner


def occurrences(docs: DataFrame, min_words: int, marks: np.ndarray | None = None) -> DataFrame:
    """``digest, id, copy`` of what each document holds, once each, only marked ones if given."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher(9)
        for part, data, offsets in pieces(batches):
            at = cuts(data, offsets)
            digests, first, last, _ = pair_digests(data, at, hasher, min_words)
            inside, owner = of_texts(first, last, np.searchsorted(at, offsets))
            if marks is not None:
                inside &= marked(marks, digests)
            digests, owner = digests[inside], owner[inside]
            order = np.lexsort((digests, owner))
            digests, owner = digests[order], owner[order]
            new = np.ones(len(digests), bool)
            new[1:] = (digests[1:] != digests[:-1]) | (owner[1:] != owner[:-1])
            ids = part.column("doc_id").cast(pa.int64()).fill_null(NO_ID).to_numpy()
            copies = part.column("copy").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests[new].view(np.int64))] + [pa.array(x[owner[new]]) for x in (ids, copies)],
                ["digest", "id", "copy"],
            )

    return docs.select("doc_id", F.col(COPY).alias("copy"), "text").mapInArrow(
        run, "digest long, id long, copy long"
    )


def marked(marks: np.ndarray, digests: np.ndarray) -> np.ndarray:
    slot = digests & np.uint64(MARKS - 1)
    byte = marks[(slot >> np.uint64(3)).astype(np.int64)]
    return (byte >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def mark(batches, total: np.ndarray) -> None:
    for batch in batches:
        total[(batch.column("digest").to_numpy().view(np.uint64) & np.uint64(MARKS - 1)).astype(
            np.int64
        )] = 1


def foreign_chunks(docs: DataFrame, min_words: int) -> DataFrame:
    """``id, copy`` with the digests that belong to an earlier document, and the ids of those."""
    place = F.struct("id", "copy")
    shared = stored(
        occurrences(docs, min_words).groupBy("digest")
        .agg(F.min(place).alias("owner"), F.max(place).alias("_last"))
        .filter("owner < _last").drop("_last"),
        "shared",
    )
    total = task_totals(shared.select("digest"), mark, MARKS, np.uint8, np.maximum)
    bits = np.packbits(total, bitorder="little")
    found = occurrences(docs, min_words, bits).join(shared, "digest").filter(place != F.col("owner"))
    return found.groupBy("id", "copy").agg(
        F.array_sort(F.collect_set(F.struct("digest", F.col("owner.id").alias("owner")))).alias("foreign")
    )


def foreign_places(digests, owner, foreign, lists) -> np.ndarray:
    """Which digests are listed for their own text. ``lists`` are the bounds of each text's list."""
    known, code = np.unique(foreign, return_inverse=True)
    if not len(known):
        return np.zeros(len(digests), bool)
    place = np.minimum(np.searchsorted(known, digests), len(known) - 1)
    text = np.repeat(np.arange(len(lists) - 1), np.diff(lists))
    listed = np.isin(owner * len(known) + place, text * len(known) + code)
    return (known[place] == digests) & listed


def removed_runs(first, last, hit, count: int, bounds_, at, counted, min_words: int):
    """First chunk and end of the runs of ``hit`` pairs with enough words. Two pairs that share a
    chunk belong to one run; ``bounds_`` are the chunk bounds of texts, which no run crosses."""
    joined, covered = np.zeros(count + 1, bool), np.zeros(count, bool)
    pairs = hit & (last > first)
    joined[last[pairs]] = True  # the chunk goes on with the one before it
    covered[first[hit]] = True
    covered[last[hit]] = True
    joined[:-1] &= covered
    low = np.flatnonzero(covered & ~joined[:-1])
    ends = np.append(covered[1:] & joined[1:-1], False)
    high = np.flatnonzero(covered & ~ends) + 1
    long = counted[at[high]] - counted[at[low]] >= min_words
    return low[long], high[long]


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` with ``text`` cut, and a struct ``_cut`` that tells what went: byte
    spans, their words and the ids of the documents that keep the passages."""
    fields = "struct<n_chunks:long,removed_words:long,spans:array<struct<start:long,stop:long>>,owners:array<long>>"
    known = told_apart(docs, COPY)
    others = [F.col(f"`{name}`") for name in docs.columns if name != "text"]
    whole = known.select(F.struct(*others).alias("_row"), "doc_id", COPY, "text")
    lists = foreign_chunks(known, min_words).withColumnsRenamed({"id": "_id", "copy": "_of"})
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    own = (key == F.col("_id")) & (F.col(COPY) == F.col("_of"))
    rows = whole.join(lists, own, "left").select("_row", "text", "foreign")

    def run(batches) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher(9)
        for batch in batches:
            data_all, ends = flat(batch.column("text"))
            for lo, hi in runs(ends):
                part = batch.slice(lo, hi - lo)
                yield cut_rows(part, data_all[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo], hasher)

    def cut_rows(part, data, offsets, hasher) -> pa.RecordBatch:
        at = cuts(data, offsets)
        digests, first, last, counted = pair_digests(data, at, hasher, min_words)
        bounds_ = np.searchsorted(at, offsets)
        inside, owner = of_texts(first, last, bounds_)
        digests, first, last, owner = (x[inside] for x in (digests, first, last, owner))
        lists = part.column("foreign")
        listed = lists.flatten()
        sizes = lists.value_lengths().fill_null(0).to_numpy()
        foreign = listed.field("digest").to_numpy().view(np.uint64)
        hit = foreign_places(digests, owner, foreign, bounds(sizes))
        low, high = removed_runs(first, last, hit, len(at) - 1, bounds_, at, counted, min_words)
        text = np.searchsorted(bounds_, low, "right") - 1
        begin, end = at[low], at[high]
        # What is left of all texts, with their new bounds.
        gone = np.zeros(len(data) + 1, np.int32)
        np.add.at(gone, begin, 1)
        np.add.at(gone, end, -1)
        keep = np.cumsum(gone[:-1]) == 0
        lost = np.bincount(text, end - begin, len(offsets) - 1).astype(np.int64)
        places = pa.py_buffer(bounds(np.diff(offsets) - lost))
        texts = pa.LargeStringArray.from_buffers(len(part), places, pa.py_buffer(data[keep].tobytes()))
        texts = texts.cast(pa.string())
        texts = pa.compute.if_else(part.column("text").is_valid(), texts, None)
        spans = bounds(np.bincount(text, minlength=len(offsets) - 1)).astype(np.int32)
        removed = np.bincount(text, counted[end] - counted[begin], len(offsets) - 1).astype(np.int64)
        places = pa.StructArray.from_arrays(
            [pa.array(x - offsets[text]) for x in (begin, end)], ["start", "stop"]
        )
        owners = owners_of(part, low, high, text, digests, first, last, hit, owner)
        cut = pa.StructArray.from_arrays(
            [
                pa.array(np.diff(bounds_)), pa.array(removed),
                pa.ListArray.from_arrays(pa.array(spans), places), owners,
            ],
            ["n_chunks", "removed_words", "spans", "owners"],
        )
        return pa.RecordBatch.from_arrays([part.column("_row"), texts, cut], ["_row", "text", "_cut"])

    def owners_of(part, low, high, text, digests, first, last, hit, owner) -> pa.Array:
        """The documents that keep what was cut out of the texts that lost something."""
        out: list[list] = [[] for _ in range(len(part))]
        cut = np.zeros(len(part), bool)
        cut[text] = True
        ends = np.zeros(int(high.max(initial=0)) + 1, bool)
        for a, b in zip(low, high):
            ends[a:b] = True
        used = hit & cut[owner]
        used[used] &= (last[used] < len(ends)) & ends[np.minimum(last[used], len(ends) - 1)]
        order = np.argsort(owner[used], kind="stable")
        digests, owner = digests[used][order], owner[used][order]
        for i in np.flatnonzero(cut):
            pairs = part.column("foreign")[i].values
            mine = digests[np.searchsorted(owner, i) : np.searchsorted(owner, i, "right")]
            held = np.isin(pairs.field("digest").to_numpy().view(np.uint64), mine)
            found = np.unique(pairs.field("owner").to_numpy()[held]).tolist()
            out[i] = [None if x == NO_ID else x for x in found]
        return pa.array(out, pa.list_(pa.int64()))

    kind = dict(rows.dtypes)["_row"]
    out = rows.mapInArrow(run, f"_row {kind}, text string, _cut {fields}")
    columns = [
        F.col("text") if name == "text" else F.col(f"_row.`{name}`").alias(name)
        for name in docs.columns
    ]
    return out.select(*columns, "_cut")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with repeated passages cut out; one left without a word goes."""
    rows = deduplicated(docs, min_words)
    left = F.trim(F.translate(F.coalesce("text", F.lit("")), "\t\n\x0b\x0c\r", "     ")) != ""
    untouched = F.size("_cut.spans") == 0
    return rows.filter(untouched | left).drop("_cut")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "_cut.*", "text"
    )
