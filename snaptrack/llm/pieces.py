"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The pieces come from a public model file. Such a file holds merge ranks instead of
log-probabilities, so a piece's log score is that of its rank under Zipf's law; other scores can
be given. Spaces are the white-space marker and a text starts with one. A character that no
piece covers becomes its UTF-8 bytes, at a score below every piece's.

Among paths of equal score the one whose last piece is longer wins, and so on to the front.

Defined results: a null or empty text has no ids; decoding gives back every text byte for byte;
repeated rows repeat; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from snaptrack.llm.ragged import bounds, pieces as text_pieces, take
from snaptrack.llm.tables import table
from snaptrack.llm.units import UnitCache

MODEL = "piece_bpe_32k.model"
MARKER = "▁"
UNKNOWN_PENALTY = 10.0


class Vocabulary(NamedTuple):
    """The trie and what decoding needs; its size depends on the vocabulary alone."""

    base: np.ndarray  # where the children of a node start
    check: np.ndarray  # the parent of a slot, -1 if free
    value: np.ndarray  # the piece that ends at a node, -1 if none
    scores: np.ndarray  # log score by id
    bytes_at: np.ndarray  # id of each byte's piece
    spelled: np.ndarray  # bytes of all pieces, one after another
    spans: np.ndarray  # their offsets by id
    longest: int


def fit(free: np.ndarray, codes: np.ndarray, low: int, step: int = 2048) -> int:
    """The first base from which all ``codes`` fall on free slots."""
    while True:
        bases = low + np.flatnonzero(free[low : low + step]) - codes[0]
        bases = bases[bases >= 0]
        good = free[bases[:, None] + codes].all(axis=1)
        if good.any():
            return int(bases[np.argmax(good)])
        low += step


def double_array(keys: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First-fit double array. A child of node n by byte c lies at base[n] + c + 1."""
    tree: list[dict[int, int]] = [{}]
    ends = [-1]
    for key, value in keys.items():
        node = 0
        for byte in key:
            if byte not in tree[node]:
                tree[node][byte] = len(tree)
                tree.append({})
                ends.append(-1)
            node = tree[node][byte]
        ends[node] = value
    size = 4 * len(tree) + 1024
    base, check, value = (np.full(size, fill, np.int32) for fill in (0, -1, -1))
    free = np.ones(size, bool)
    free[0] = False
    check[0] = -2
    slots, low = {0: 0}, 1
    for node, children in enumerate(tree):  # parents come before their children
        slot = slots[node]
        value[slot] = ends[node]
        if not children:
            base[slot] = size  # beyond the arrays: every lookup fails
            continue
        codes = np.array(sorted(children)) + 1
        low += int(np.argmax(free[low:]))  # the first free slot
        start = low - int(codes[0]) if len(codes) == 1 else -1
        start = start if start >= 0 else fit(free, codes, low)
        base[slot] = start
        for code in codes.tolist():
            check[start + code], free[start + code] = slot, False
            slots[children[code - 1]] = start + code
    return base, check, value


def vocabulary(path: str) -> Vocabulary:
    """Reads a model file on the driver; the result is shipped to the tasks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    bytes_at = np.zeros(256, np.int32)
    spelled, keys = [], {}
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            bytes_at[int(piece[1:-1], 16)] = i
            spelled.append(bytes([int(piece[1:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i):
            spelled.append(b"")
        else:
            spelled.append(piece.replace(MARKER, " ").encode())
            keys[spelled[-1]] = i
    ranks = np.arange(1.0, size + 1)
    scores = -np.log(ranks) - np.log(np.sum(1 / ranks))
    scores[bytes_at] = scores.min() - UNKNOWN_PENALTY
    scores = np.round(scores * 65536) / 65536  # sums are exact, so ties are ties
    spans = bounds(np.array([len(piece) for piece in spelled]))
    base, check, value = double_array(keys)
    longest = max(map(len, keys))
    flat = np.frombuffer(b"".join(spelled), np.uint8)
    return Vocabulary(base, check, value, scores, bytes_at, flat, spans, longest)


def matches(words: Vocabulary, data: np.ndarray, ends: np.ndarray):
    """All pieces at all characters: starts, lengths and ids. ``ends`` bounds each byte's unit."""
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    at, state = heads, np.zeros(len(heads), np.int32)
    size, found = len(words.base), []
    width = np.ones(len(data) + 1, np.int64)  # bytes of the character at a head
    width[heads] = np.diff(np.append(heads, len(data)))
    single = np.zeros(len(data), bool)
    for depth in range(1, words.longest + 1):
        inside = at + depth <= ends[at]
        at, state = at[inside], state[inside]
        if not len(at):
            break
        slot = words.base[state].astype(np.int64) + data[at + depth - 1] + 1
        slot[slot >= size] = 0
        good = words.check[slot] == state
        at, state = at[good], slot[good].astype(np.int32)
        value = words.value[state]
        hit = value >= 0
        found.append((at[hit], np.full(int(hit.sum()), depth), value[hit]))
        single[at[hit][width[at[hit]] == depth]] = True
    bare = ~single[heads]
    lone = take(np.arange(len(data)), heads[bare], width[heads[bare]])
    found.append((lone, np.ones(len(lone), np.int64), words.bytes_at[data[lone]]))
    return tuple(np.concatenate(part) for part in zip(*found))


def encode_units(words: Vocabulary, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Best paths of all units at once: one step per (start in unit, piece length)."""
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    data = np.frombuffer(b"".join(units), np.uint8)
    offsets = bounds(sizes)
    owner = np.repeat(np.arange(len(units)), sizes)
    at, length, ids = matches(words, data, offsets[owner + 1])
    begin = at - offsets[owner[at]]
    order = np.lexsort((-length, begin))
    at, length, ids, begin = at[order], length[order], ids[order], begin[order]
    node = at + owner[at]  # a unit of n bytes has n + 1 nodes
    best = np.full(len(data) + len(units), -np.inf)
    best[offsets[:-1] + np.arange(len(units))] = 0
    back, via = np.zeros(len(best), np.int64), np.zeros(len(best), np.int32)
    gain = words.scores[ids]
    change = np.flatnonzero((np.diff(begin) != 0) | (np.diff(length) != 0)) + 1
    edges = [0, *change.tolist(), len(at)] if len(at) else [0]
    for low, high in zip(edges, edges[1:]):
        source = node[low:high]
        target = source + length[low]
        score = best[source] + gain[low:high]
        better = score > best[target]
        target = target[better]
        best[target] = score[better]
        back[target], via[target] = source[better], ids[low:high][better]
    first = offsets[:-1] + np.arange(len(units))
    now, rows, steps = first + sizes, np.arange(len(units)), []
    while len(rows):
        moving = now > first[rows]
        rows, now = rows[moving], now[moving]
        steps.append((rows, via[now]))
        now = back[now]
    unit, piece = (np.concatenate(part) for part in zip(*reversed(steps))) if steps else ([], [])
    order = np.argsort(unit, kind="stable")
    return np.asarray(piece, np.int32)[order], np.bincount(unit, minlength=len(units))


def marked(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a marker in front of each that is not empty."""
    filled = np.diff(offsets) > 0
    return np.insert(data, offsets[:-1][filled], 32), offsets + np.append(0, np.cumsum(filled))


def unit_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that no piece crosses: a run of markers and what follows, or one line break."""
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (data[1:] == 32) & (data[:-1] != 32)
    breaks = np.flatnonzero(data == 10)
    cut[breaks], cut[breaks + 1] = True, True
    cut[offsets] = True
    at = np.flatnonzero(cut)
    return at[:-1], at[1:]


def encode(words: Vocabulary, cache: UnitCache, data: np.ndarray, offsets: np.ndarray):
    """Flat ids and offsets of the texts."""
    data, offsets = marked(data, offsets)
    if not len(data):
        return np.zeros(0, np.int32), np.zeros_like(offsets)
    starts, ends = unit_spans(data, offsets)
    ids, lengths = cache(data, starts, ends)
    return ids, bounds(lengths)[np.searchsorted(starts, offsets)]


def decode(words: Vocabulary, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts, without the marker in front."""
    lengths = (words.spans[1:] - words.spans[:-1])[ids]
    data = take(words.spelled, words.spans[ids], lengths)
    offsets = bounds(lengths)[at]
    filled = np.diff(offsets) > 0
    keep = np.ones(len(data), bool)
    keep[offsets[:-1][filled]] = False
    return data[keep], offsets - np.append(0, np.cumsum(filled))


def new_cache(words: Vocabulary) -> UnitCache:
    return UnitCache(lambda units: encode_units(words, units))


def tokenize(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """``doc_id, ids, n_tokens, n_byte_tokens`` and whether decoding gives the text back."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        cache = new_cache(words)
        lone = np.zeros(len(words.scores), np.int64)
        lone[words.bytes_at] = 1
        for part, data, offsets in text_pieces(batches):
            ids, at = encode(words, cache, data, offsets)
            again, ends = decode(words, ids, at)
            same = np.diff(ends) == np.diff(offsets)
            if len(again) == len(data):
                wrong = bounds(again != data)
                same &= np.diff(wrong[offsets]) == 0
            else:
                same &= np.array(
                    [
                        np.array_equal(again[a:b], data[c:d])
                        for a, b, c, d in zip(ends, ends[1:], offsets, offsets[1:])
                    ],
                    bool,
                )
            columns = [
                part.column("doc_id").cast(pa.int64()),
                pa.array(np.diff(at)),
                pa.array(np.diff(bounds(lone[ids])[at])),
                pa.array(same),
                pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids)),
            ]
            names = ["doc_id", "n_tokens", "n_byte_tokens", "round_trip", "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(
        run,
        "doc_id long, n_tokens long, n_byte_tokens long, round_trip boolean, ids array<int>",
    )


def texts_of(tokens: DataFrame, words: Vocabulary) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``: the decoder as an operator of its own."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            lists = lists.fill_null([]) if lists.null_count else lists
            at = lists.offsets.to_numpy().astype(np.int64)
            ids = lists.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]]
            data, offsets = decode(words, ids, at - at[0])
            text = pa.LargeStringArray.from_buffers(
                len(batch), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data.tobytes())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), text.cast(pa.string())],
                ["doc_id", "text"],
            )

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize(table(spark, sf_dir, "documents"), vocabulary(model_path()))
