"""Hierarchical multi-length packing of tokenized documents.

A document is cut at every full window; its rest is routed to the tier of the smallest window
that holds it. The long tier opens one window per rest and fills the gap from shorter tiers,
the longest fit first. Shorter tiers keep the windows that fill exactly; what is left over is
packed into long windows. Sequences of all tiers are then dealt to step groups in proportion.

The plan is made from the histogram of rest lengths, at most one number per length whatever the
size of the corpus. A document finds its place by its rank among the rests of its length, so
nothing but ranks is shuffled. Texts are tokenized once.

Defined results: a null or empty text is the end token alone; repeated rows are packed each;
an empty table gives no piece; other columns are not read.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from snaptrack.llm.ragged import bounds, pieces
from snaptrack.llm.tables import ranked, stored, table

WINDOWS = (1024, 512, 256)
END = 0
STEP_TOKENS = 1 << 19
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"

# Fixed value: how the rank file's vocabulary splits a text before merging.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(tokenizer: str, ranks: str | None):
    """Ids of a text as the tokenizer file gives them, without special tokens added.

    With ``ranks``, the same vocabulary as a rank file, texts of letters and signs below U+0250
    take that faster path; their pre-tokens cannot differ. Other texts, and those that spell an
    added token, take the tokenizer itself.
    """
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer)
    added = [token.content for token in model.get_added_tokens_decoder().values()]

    def exact(text: str) -> np.ndarray:
        return np.array(model.encode(text, add_special_tokens=False).ids, np.int32)

    if ranks is None:
        return exact
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(key): int(rank) for key, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if not text.isascii() and max(text) >= "\u0250" or any(token in text for token in added):
            return exact(text)
        return fast.encode_to_numpy(text).astype(np.int32)

    return encode


def encoded(
    batches, tokenizer: str, ranks: str | None
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows with their flat ids and offsets, the end token included."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    encode, end = encoder(tokenizer, ranks), np.array([END], np.int32)
    for part, _, _ in pieces(batches):
        found = [encode(text or "") for text in part.column("text").to_pylist()]
        lengths = np.fromiter(map(len, found), np.int64, len(found)) + 1
        joined = np.concatenate([ids for one in found for ids in (one, end)])
        yield part, joined, bounds(lengths)


def tokenized(
    docs: DataFrame, tokenizer: str, window: int, ranks: str | None, with_ids: bool = False
) -> DataFrame:
    """Per document ``doc_tokens``, the checksums of its full windows, and its rest."""

    def measure(batches):
        for part, ids, at in encoded(batches, tokenizer, ranks):
            raw = memoryview(ids.astype("<u4"))
            tokens = np.diff(at)
            full, sums, rests = tokens // window, [], []
            for start, end in zip(at[:-1].tolist(), at[1:].tolist()):
                cut = end - (end - start) % window
                sums += [zlib.crc32(raw[i : i + window]) for i in range(start, cut, window)]
                rests.append(zlib.crc32(raw[cut:end]))
            columns = [
                part.column("doc_id").cast(pa.int64()),
                pa.array(tokens),
                pa.ListArray.from_arrays(
                    pa.array(bounds(full).astype(np.int32)), pa.array(sums, pa.int64())
                ),
                pa.array(tokens % window),
                pa.array(rests, pa.int64()),
            ]
            names = ["doc_id", "doc_tokens", "sums", "rest", "rest_crc32"]
            if with_ids:
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
                columns, names = [*columns, lists], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, doc_tokens long, sums array<long>, rest long, rest_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(
        measure, schema + ", ids array<int>" * with_ids
    )


def plan(counts: dict[int, int], windows=WINDOWS) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """``(window, repeats, [(length, copies), ...])`` from the number of rests of each length."""
    longest = windows[0]
    left = np.zeros(longest + 1, np.int64)
    for length, count in counts.items():
        if 0 < length < longest:
            left[length] = count
    found = []

    def fill(length: int, window: int) -> tuple[list[tuple[int, int]], int]:
        left[length] -= 1
        parts, gap = [[length, 1]], window - length
        reach = gap
        while gap and reach:
            reach = min(reach, gap)
            fits = np.flatnonzero(left[1 : reach + 1])
            if not len(fits):
                break
            fit = int(fits[-1]) + 1
            copies = min(gap // fit, int(left[fit]))
            parts.append([fit, copies])
            gap -= fit * copies
            reach = fit - 1
        left[length] += 1
        if len(parts) > 1 and parts[1][0] == length:  # a run of the opener's own length
            parts[0][1] += parts.pop(1)[1]
        return [tuple(part) for part in parts], gap

    def take(window: int, low: int, high: int, exact: bool) -> None:
        for length in range(high, low, -1):
            while left[length]:
                parts, gap = fill(length, window)
                if gap and exact:
                    break
                repeats = min(int(left[size]) // copies for size, copies in parts)
                for size, copies in parts:
                    left[size] -= repeats * copies
                found.append((window, repeats, parts))

    take(longest, longest // 2, longest - 1, exact=False)
    for window in windows[1:]:
        take(window, window // 2, window, exact=True)
    take(longest, 0, longest // 2, exact=False)
    return found


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    windows=WINDOWS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """One row per piece: where it starts in its document, and its sequence, offset and step.

    The table of places has at most a few rows per rest length and is broadcast.
    """
    spark, longest = docs.sparkSession, windows[0]
    rows = stored(tokenized(docs, tokenizer, longest, ranks), "tokens")
    totals = rows.groupBy("rest").agg(
        F.count("*").alias("n"), F.sum(F.size("sums")).alias("full")
    ).collect()  # one row per rest length
    full = sum(row["full"] for row in totals)
    found = plan({row["rest"]: row["n"] for row in totals}, windows)
    tokens = longest * full + sum(row["rest"] * row["n"] for row in totals)
    steps = max(1, -(-tokens // step_tokens))
    sequences = dict.fromkeys(windows, 0) | {longest: full}
    used: dict[int, int] = {}
    first, places = full, []
    for window, repeats, parts in found:
        offset = 0
        for length, copies in parts:
            rank = used.get(length, 0)
            count = repeats * copies
            places.append(
                (length, rank, rank + count, copies, first, offset, window, sequences[window])
            )
            used[length] = rank + count
            offset += length * copies
        sequences[window] += repeats
        first += repeats
    schema = (
        "length long, low long, high long, copies long, first long, base long, window long, "
        "nth long"
    )
    placed = F.broadcast(spark.createDataFrame(places, schema))
    identity = ["doc_id", "doc_tokens", "rest_crc32"]
    share = F.create_map(*[F.lit(x) for w in windows for x in (w, max(1, sequences[w]))])

    def step(window, nth):
        return F.floor(nth * steps / share[window]).cast("long").alias("step_id")

    whole = ranked(
        rows.filter(F.size("sums") > 0).withColumn("_full", F.size("sums")),
        "_first", [], identity, weight="_full",
    )
    whole = whole.select("doc_id", "doc_tokens", "_first", F.posexplode("sums"))
    whole = whole.select(
        "doc_id",
        (F.col("pos") * F.lit(longest)).cast("long").alias("start"),
        F.lit(longest).cast("long").alias("length"),
        F.col("col").alias("ids_crc32"),
        "doc_tokens",
        (F.col("_first") + F.col("pos")).cast("long").alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.lit(longest).cast("long").alias("window"),
        step(F.lit(longest), F.col("_first") + F.col("pos")),
    )
    rests = ranked(rows.filter("rest > 0").drop("sums"), "_rank", ["rest"], identity)
    nth = F.floor((F.col("_rank") - F.col("low")) / F.col("copies")).cast("long")
    turn = (F.col("_rank") - F.col("low")) % F.col("copies")
    rests = rests.join(
        placed, (F.col("rest") == F.col("length")) & F.expr("_rank >= low and _rank < high")
    ).select(
        "doc_id",
        (F.col("doc_tokens") - F.col("rest")).alias("start"),
        "length",
        F.col("rest_crc32").alias("ids_crc32"),
        "doc_tokens",
        (F.col("first") + nth).alias("sequence_id"),
        (F.col("base") + turn * F.col("length")).alias("offset"),
        "window",
        step(F.col("window"), F.col("nth") + nth),
    )
    return whole.unionByName(rests)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path(RANKS))
