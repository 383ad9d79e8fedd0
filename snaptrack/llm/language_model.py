"""Scoring texts by a hashed maximum-entropy model with a class-factored softmax.

The probability of a token is that of its class in its context, times that of the token in its
class and context. The first factor is a log-linear model: a row of weights, one per class, for each
active feature, summed and normalized over the classes. Features are the token before, the two
before, the classes of the three before, and the token before the last (a skip); they are hashed to
rows. The most frequent tokens are classes of their own. Others are put into classes by their last
bytes: endings whose tokens have like neighbours form a class (k-means over the counts of hashed
neighbours), so an unknown token has a class too.

The second factor is a log-linear model of the same features. As a class has thousands of tokens, it
is divided in two again and again: its most frequent tokens and one leaf for all rarer ones are the
leaves of a Huffman tree, and every fork is a softmax over its two sides, with a weight for each
feature, hashed together with the fork. Forks start from the counts below them, so that without
any weights a token has the share ``(c + 1) / (n + v + 1)`` of its class, with c the token's count, n
and v the counts of tokens and of distinct ones in its class. Tokens of the leaf for rarer ones have
the same closed form in it; the one over is for all unknown tokens of the class, so that
probabilities add up to one.

The weights are learnt by distributed gradient updates. In each round every task goes once over its
share of the round's documents in small batches (with step lengths of its own for each row of
weights); then the changes of all tasks are averaged, each weighted by how often the task met the
row. Sums are in whole numbers, so their order does not matter.

What grows with the corpus stays in tables: the counts of all distinct tokens are a table that is
joined with the tokens of documents. Tasks hold the ``HEAD`` most frequent counts, their trees, and
tables of weights: one whose rows grow with the number of tokens up to ``MOST_ROWS``, and ``SLOTS``
weights of forks. Scores are computed in
batches of numpy arrays; documents of any length are taken in parts.

Defined results: a null text is empty, and an empty one has the end token alone; a null ``doc_id``
is learnt from; repeated rows repeat; without anything to learn from every token is unknown; an
empty table gives no row; other columns are not read. Tokens are told apart by a 64-bit hash.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snaptrack.llm.graph import task_totals
from snaptrack.llm.ragged import SpanHasher, bounds, lowered, mixed, pieces, take, words
from snaptrack.llm.tables import stored, table

END = np.uint64(0x5851F42D4C957F2D)
START = np.uint64(0x14057B7EF767814F)
SEED = 13
CLASSES = 32
SINGLES = 16
HEAD = 1 << 16
ENDINGS = 1 << 11
NEIGHBOURS = 64
TAIL = 3
LEAST_ROWS, MOST_ROWS = 1 << 12, 1 << 16
TOKENS_PER_ROW = 1024
ROUNDS = 2
RATE = 0.4
SLOTS = 1 << 18
FORK_RATE = 0.2
FORK_PLACE = np.uint64(64 - 18)
ODD = np.uint64(0xD6E8FEB86659FD93)
BATCH = 1 << 13
FEW = 3
STARTS = 17
FORK_BATCH = 1 << 14
SCALE = 1 << 16
FLUSH = 1 << 20
PIECE = 1 << 19


def tokens_of(data: np.ndarray, offsets: np.ndarray, hasher: SpanHasher):
    """Hashes and endings of all tokens, the end of each text included, and the token offsets."""
    starts, ends, at = words(data, offsets)
    lower = lowered(data)
    hashes = hasher(lower, starts, ends)
    last = np.zeros(len(starts), np.uint64)
    for k in range(1, TAIL + 1):
        place = ends - k
        byte = np.where(place >= starts, lower[np.maximum(place, 0)], 0) if len(lower) else last
        last = last << np.uint64(8) | byte.astype(np.uint64)
    endings = (mixed(last + np.uint64(1)) % np.uint64(ENDINGS)).astype(np.int64)
    return np.insert(hashes, at[1:], END), np.insert(endings, at[1:], 0), at + np.arange(len(at))


def earlier(values: np.ndarray, at: np.ndarray, steps: int, start) -> np.ndarray:
    """The value so many tokens before in the same text, or ``start``."""
    out = np.full(len(values), start, values.dtype)
    out[steps:] = values[: max(len(values) - steps, 0)]
    for k in range(steps):
        place = at[:-1] + k
        out[place[place < at[1:]]] = start
    return out


def contexts(tokens: np.ndarray, classes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Features x tokens: hashes of what stands before each token."""
    one, two = (earlier(tokens, at, k, START) for k in (1, 2))
    kinds = sum(earlier(classes, at, k, CLASSES) << (8 * k) for k in (1, 2, 3)).astype(np.uint64)
    keys = (
        one + np.uint64(1), mixed(one) + two * np.uint64(3), kinds + np.uint64(5),
        two + np.uint64(0x9E3779B9),
    )
    return np.stack([mixed(key) for key in keys])


def rows_of(features: np.ndarray, rows: int) -> np.ndarray:
    """Rows of the weight table; row 0 is active everywhere."""
    return (features % np.uint64(rows - 1) + np.uint64(1)).astype(np.int64)


def feature_rows(tokens: np.ndarray, classes: np.ndarray, at: np.ndarray, rows: int) -> np.ndarray:
    return rows_of(contexts(tokens, classes, at), rows)


def leading(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - STARTS)).view(np.int64)


def head_starts(head: np.ndarray) -> np.ndarray:
    """How many of the sorted hashes are below each value of the leading bits."""
    return bounds(np.bincount(leading(head), minlength=1 << STARTS))[:-1]


class Vocabulary(NamedTuple):
    """What tasks know of the counts: the most frequent tokens and the sizes of classes."""

    total: int
    distinct: int
    head: np.ndarray  # sorted hashes
    counts: np.ndarray  # of the head
    home: np.ndarray  # endings of the head
    singles: np.ndarray  # sorted hashes of the tokens that are classes of their own
    groups: np.ndarray  # the class of each ending
    tokens: np.ndarray  # per class
    kinds: np.ndarray  # per class
    starts: np.ndarray  # the first place in the head of hashes with each leading STARTS bits

    def classes(self, tokens: np.ndarray, endings: np.ndarray) -> np.ndarray:
        found = self.groups[endings]
        if len(self.singles):
            place = np.minimum(np.searchsorted(self.singles, tokens), len(self.singles) - 1)
            found = np.where(self.singles[place] == tokens, place, found)
        return found

    def in_head(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether a token is of the head, and its place there."""
        if not len(self.head):
            return np.zeros(len(tokens), bool), np.zeros(len(tokens), np.int64)
        last = len(self.head) - 1
        place = np.minimum(self.starts.take(leading(tokens)), last)
        found = self.head.take(place)
        behind = np.flatnonzero(found < tokens)
        while len(behind):  # a few steps: hashes spread evenly over their leading bits
            place[behind] += 1
            behind = behind[place[behind] <= last]
            found[behind] = self.head[place[behind]]
            behind = behind[found[behind] < tokens[behind]]
        return found == tokens, np.minimum(place, last)

    def leaves(self, tokens: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """The leaf of each token: its place in the head, or that of the rarer ones of its class."""
        hit, place = self.in_head(tokens)
        return np.where(hit, place, len(self.head) + classes)


class Forks(NamedTuple):
    """The way to each leaf, the head first and then the rarer tokens of each class."""

    at: np.ndarray  # offsets of the ways
    steps: np.ndarray  # twice the fork, and one if the way takes its second side
    prior: np.ndarray  # of each fork: log odds of the second side by the counts
    rarer: np.ndarray  # per class: log10 of the denominator of the leaf for rarer tokens
    codes: np.ndarray  # of each fork: its part of the places of its weights

    def ways(self, leaves: np.ndarray):
        """The number of steps of each token, the fork of each step, and the side that it takes."""
        starts = self.at.take(leaves)
        sizes = self.at.take(leaves + 1) - starts
        steps = take(self.steps, starts, sizes)
        return sizes, steps >> 1, (steps & 1).astype(np.float32)


def huffman(sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The fork above each node (-1: none), its side there, and its size; leaves come first."""
    up, side, size = [-1] * len(sizes), [0] * len(sizes), list(sizes)
    heap = [(n, i) for i, n in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        (n, a), (m, b) = heapq.heappop(heap), heapq.heappop(heap)
        up[a] = up[b] = len(up)
        side[b] = 1
        heapq.heappush(heap, (n + m, len(up)))
        up.append(-1)
        side.append(0)
        size.append(n + m)
    return np.array(up), np.array(side), np.array(size, float)


def forks(known: Vocabulary) -> Forks:
    """A tree for each class that is more than one token."""
    classes, weight, head = known.classes(known.head, known.home), known.counts + 1, len(known.head)
    rest = known.tokens + known.kinds + 1
    np.subtract.at(rest, classes, weight)
    leaves, steps, prior = [], [], [np.zeros(0)]
    for kind in range(SINGLES, CLASSES):
        leaf = np.append(np.flatnonzero(classes == kind), head + kind)
        up, side, size = huffman(np.append(weight[leaf[:-1]], rest[kind]).tolist())
        node, count, first = np.arange(len(leaf)), len(leaf), sum(map(len, prior))
        second = np.zeros(len(up) - count)
        second[up[side == 1] - count] = size[side == 1]
        prior.append(np.log(second / (size[count:] - second)))
        while len(node):  # all leaves climb a step
            below = up[node] >= 0
            leaf, node = leaf[below], node[below]
            leaves.append(leaf)
            steps.append(2 * (first + up[node] - count) + side[node])
            node = up[node]
    leaf = np.concatenate(leaves)
    at = bounds(np.bincount(leaf, minlength=head + CLASSES))
    ways = np.concatenate(steps)[np.argsort(leaf, kind="stable")]
    odds = np.concatenate(prior).astype(np.float32)
    codes = mixed(np.arange(1, len(odds) + 1, dtype=np.uint64)) * ODD
    return Forks(at, ways.astype(np.int32), odds, np.log10(rest), codes)


COUNTS = "word long, ending int, beside int, n long"


def counted(docs: DataFrame) -> DataFrame:
    """``word, ending, beside, c``: the count of every distinct token, and, with a null ``word``,
    how often a token of the ending stands beside one of a hashed neighbour class. Tasks add up
    before the shuffle."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        hasher, held, size = SpanHasher(SEED), [], 0
        beside = np.zeros(ENDINGS * NEIGHBOURS, np.int64)

        def merged():
            found, first, back = np.unique(
                np.concatenate([h for h, _, _ in held]), return_index=True, return_inverse=True
            )
            sums = np.bincount(back, np.concatenate([n for _, _, n in held]), len(found))
            return found, np.concatenate([e for _, e, _ in held])[first], sums.astype(np.int64)

        def batch_of(found, endings, sums):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(found.view(np.int64)), pa.array(endings.astype(np.int32)),
                    pa.nulls(len(found), pa.int32()), pa.array(sums),
                ],
                ["word", "ending", "beside", "n"],
            )

        for _, data, offsets in pieces(batches):
            tokens, endings, at = tokens_of(data, offsets, hasher)
            listed = pa.array(tokens).dictionary_encode()
            found, place = listed.dictionary.to_numpy(), listed.indices.to_numpy()
            home = np.zeros(len(found), np.int64)
            home[place] = endings  # equal tokens end alike
            held.append((found, home, np.bincount(place, minlength=len(found))))
            near = (tokens % np.uint64(NEIGHBOURS)).astype(np.int64)
            same = np.ones(max(len(tokens) - 1, 0), bool)
            same[at[1:-1] - 1] = False
            for a, b in ((endings[:-1], near[1:]), (endings[1:], near[:-1])):
                beside += np.bincount((a * NEIGHBOURS + b)[same], minlength=len(beside))
            size += len(found)
            if size > FLUSH:
                held = [merged()]
                size = len(held[0][0])
                if size > FLUSH // 2:
                    yield batch_of(*held[0])
                    held, size = [], 0
        if held:
            yield batch_of(*merged())
        some = np.flatnonzero(beside)
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(len(some), pa.int64()), pa.array((some // NEIGHBOURS).astype(np.int32)),
                pa.array((some % NEIGHBOURS).astype(np.int32)), pa.array(beside[some]),
            ],
            ["word", "ending", "beside", "n"],
        )

    rows = docs.select("text").mapInArrow(run, COUNTS)
    return rows.groupBy("word", "ending", "beside").agg(F.sum("n").alias("c"))


def ending_classes(beside: np.ndarray, count: int) -> np.ndarray:
    """The group of each ending: k-means over the shares of its neighbours, weighted by size."""
    sizes = beside.sum(1)
    shares = np.sqrt(beside / np.maximum(sizes, 1)[:, None])
    centres = shares[[int(np.argmax(sizes))]]
    for _ in range(count - 1):
        # The next centre is the heaviest ending far from all others.
        away = ((shares[:, None] - centres[None]) ** 2).sum(2).min(1) * np.sqrt(sizes)
        centres = np.concatenate([centres, shares[[int(np.argmax(away))]]])
    for _ in range(20):
        group = ((shares[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        weight = np.bincount(group, sizes, count)
        sums = np.stack([np.bincount(group, shares[:, i] * sizes, count) for i in range(shares.shape[1])], 1)
        centres = np.where(weight[:, None] > 0, sums / np.maximum(weight, 1)[:, None], centres)
    return group


def vocabulary(counts: DataFrame, head: int = HEAD) -> Vocabulary:
    """Reads sums per ending and the ``head`` most frequent tokens of stored counts."""
    listed = counts.filter("word is not null")
    top = listed.orderBy(F.desc("c"), "word").limit(head).collect()
    hashes = np.array([row["word"] for row in top], np.int64).view(np.uint64)
    sizes = np.array([row["c"] for row in top], np.int64)
    home = np.array([row["ending"] for row in top], np.int64)
    beside = np.zeros((ENDINGS, NEIGHBOURS))
    for row in counts.filter("word is null").collect():  # of a fixed size
        beside[row["ending"], row["beside"]] = row["c"]
    groups = ending_classes(beside, CLASSES - SINGLES) + SINGLES
    per_ending = listed.groupBy("ending").agg(F.sum("c").alias("tokens"), F.count("*").alias("kinds"))
    tokens, kinds = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for row in per_ending.collect():  # one row per ending
        tokens[groups[row["ending"]]] += row["tokens"]
        kinds[groups[row["ending"]]] += row["kinds"]
    total, distinct = int(tokens.sum()), int(kinds.sum())
    np.subtract.at(tokens, groups[home[:SINGLES]], sizes[:SINGLES])
    np.subtract.at(kinds, groups[home[:SINGLES]], 1)
    order, singles = np.argsort(hashes), np.sort(hashes[:SINGLES])
    place = np.searchsorted(singles, hashes[:SINGLES])
    tokens[place], kinds[place] = sizes[:SINGLES], 1
    return Vocabulary(
        total, distinct, hashes[order], sizes[order], home[order], singles, groups, tokens, kinds,
        head_starts(hashes[order]),
    )


# ---- the model of classes


def start_weights(known: Vocabulary) -> np.ndarray:
    """Row 0 gives the classes their share of the tokens; other rows are zero."""
    rows = LEAST_ROWS
    while rows < MOST_ROWS and rows * TOKENS_PER_ROW < known.total:
        rows *= 2
    weights = np.zeros((rows, CLASSES), np.float32)
    spare = np.arange(CLASSES) < SINGLES
    spare[: len(known.singles)] = False
    weights[0] = np.log((known.tokens + 1.0) / (known.total + CLASSES))
    weights[0, spare] = -30  # no token is of these classes
    return weights


def log_odds(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Tokens x classes: natural logarithms of the class probabilities."""
    z = weights.take(rows[0], 0)
    for row in rows[1:]:
        z += weights.take(row, 0)
    z += weights[0]
    z -= z.max(1, keepdims=True)
    return z


def group_sums(values: np.ndarray, order: np.ndarray, first: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Sums of the rows of each group. The groups of ``FEW`` rows or less, which most are, are
    added row by row, in the order in which ``reduceat`` adds the others."""
    sums = values.take(order.take(first), 0)
    for size in range(2, FEW + 1):
        group = np.flatnonzero(times == size)
        rest = values.take(order.take(first[group] + 1), 0)
        for k in range(2, size):
            rest += values.take(order.take(first[group] + k), 0)
        sums[group] += rest
    many = times > FEW
    if many.any():
        inside = values.take(order[np.repeat(many, times)], 0)
        sums[many] = np.add.reduceat(inside, bounds(times[many])[:-1], axis=0)
    return sums


def learn(weights, power, visits, rows: np.ndarray, classes: np.ndarray) -> None:
    """One batch of updates, in place."""
    z = np.exp(log_odds(weights, rows))
    z /= z.sum(1, keepdims=True)
    z[np.arange(len(classes)), classes] -= 1
    total = z.sum(0)
    power[0] += float((total**2).mean())
    visits[0] += len(classes)
    changes = [(np.zeros(1, np.int64), total[None].copy())]
    for row in rows:
        order = np.argsort(row.astype(np.uint16), kind="stable")  # short numbers sort faster
        sorted_ = row[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
        used, times = sorted_[first], np.diff(np.append(first, len(row)))
        sums = group_sums(z, order, first, times)
        power[used] += np.einsum("ij,ij->i", sums, sums) / CLASSES
        visits[used] += times
        changes.append((used, sums))
    for used, sums in changes:
        sums *= (RATE / np.sqrt(power[used] + 1))[:, None]
        moved = weights.take(used, 0)
        moved -= sums
        weights[used] = moved


# ---- the model of tokens in their class


def fork_slots(features: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Features x steps: places of the weights of each fork in its token's context."""
    slots = np.repeat(features * ODD, sizes, 1)
    slots += codes
    slots >>= FORK_PLACE
    return slots.view(np.int64)


def learn_forks(own, power, visits, tree: Forks, features: np.ndarray, leaves: np.ndarray) -> None:
    """One batch of updates, in place."""
    sizes, fork, side = tree.ways(leaves)
    slots = fork_slots(features, sizes, tree.codes.take(fork))
    z = tree.prior.take(fork) + own.take(slots).sum(0)
    wrong = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - side
    change = np.zeros(len(own), np.float32)
    for row in slots:
        np.add.at(change, row, wrong)
    visits += np.bincount(slots.ravel(), minlength=len(own))
    power += change**2
    own -= FORK_RATE * change / np.sqrt(power + 1)


def fork_scores(weights, tree: Forks, features: np.ndarray, leaves: np.ndarray) -> np.ndarray:
    """log10 of the probability of every token's leaf in its class."""
    out = np.zeros(len(leaves))
    for low in range(0, len(leaves), BATCH):
        part = slice(low, low + BATCH)
        sizes, fork, side = tree.ways(leaves[part])
        slots = fork_slots(features[:, part], sizes, tree.codes.take(fork))
        z = tree.prior.take(fork) + weights.take(slots).sum(0)
        logs = np.maximum((1 - 2 * side) * z, 0) + np.log(1 + np.exp(-np.abs(z)))
        out[part] = -np.bincount(np.repeat(np.arange(len(sizes)), sizes), logs, len(sizes))
    return out / np.log(10)


def fitted(
    docs: DataFrame, known: Vocabulary, tree: Forks, rounds: int = ROUNDS
) -> tuple[np.ndarray, np.ndarray]:
    """The weights of classes and of forks after all rounds, each over its own part of the documents."""
    weights, inside = start_weights(known), np.zeros(SLOTS, np.float32)
    part = F.pmod(F.xxhash64("text"), F.lit(rounds))
    for turn in range(rounds):
        weights, inside = one_round(docs.filter(part == turn), known, tree, weights, inside)
    return weights, inside


def trained(docs: DataFrame, known: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """The weights of classes alone."""
    return fitted(docs, known, forks(known), rounds)[0]


def one_round(
    docs: DataFrame, known: Vocabulary, tree: Forks, weights: np.ndarray, inside: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    rows = len(weights)
    cells = rows * CLASSES
    at = np.cumsum([cells, rows, SLOTS])  # changes and visits of rows, then those of slots

    def update(batches, total):
        own, power = weights.copy(), np.zeros(rows, np.float32)
        visits, hasher = np.zeros(rows, np.int64), SpanHasher(SEED)
        slots, strength = inside.copy(), np.zeros(SLOTS, np.float32)
        met = np.zeros(SLOTS, np.int64)
        for _, data, offsets in pieces(batches, PIECE):
            tokens, endings, ends = tokens_of(data, offsets, hasher)
            classes = known.classes(tokens, endings)
            leaves, features = known.leaves(tokens, classes), contexts(tokens, classes, ends)
            active = rows_of(features, rows)
            for low in range(0, len(tokens), BATCH):
                part = slice(low, low + BATCH)
                learn(own, power, visits, active[:, part], classes[part])
            for low in range(0, len(tokens), FORK_BATCH):
                part = slice(low, low + FORK_BATCH)
                learn_forks(slots, strength, met, tree, features[:, part], leaves[part])
        change = (own - weights).astype(float) * visits[:, None] * SCALE
        total[:cells] = np.rint(change).ravel()
        total[cells : at[1]] = visits
        total[at[1] : at[2]] = np.rint((slots - inside).astype(float) * met * SCALE)
        total[at[2] :] = met

    found = task_totals(docs.select("text"), update, rows * (CLASSES + 1) + 2 * SLOTS)
    changes, visits, moved, met = np.split(found, at)
    change = changes.reshape(rows, CLASSES) / np.maximum(visits, 1)[:, None] / SCALE
    return (weights + change).astype(np.float32), (inside + moved / np.maximum(met, 1) / SCALE).astype(np.float32)


# ---- scores


def class_scores(weights, active: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """log10 of the probability of every token's class."""
    out = np.zeros(len(classes))
    for low in range(0, len(classes), BATCH):
        part = slice(low, low + BATCH)
        z = log_odds(weights, active[:, part])
        chosen = z[np.arange(len(z)), classes[part]]
        out[part] = chosen - np.log(np.exp(z).sum(1))
    return out / np.log(10)


def row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the tokens of each text; every text has one at least."""
    return np.add.reduceat(values, at[:-1]) if len(at) > 1 else np.zeros(0, values.dtype)


PARTS = (
    "row long, doc_id {}, held_out boolean, n_tokens long, head_known long, head_base double, "
    "head_score double, words array<long>, times array<long>"
)


def head_scores(
    docs: DataFrame, known: Vocabulary, tree: Forks, weights: np.ndarray, inside: np.ndarray
) -> DataFrame:
    """Per document all that needs no more than the head, and its other tokens with their numbers."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher(SEED)
        for part, data, offsets in pieces(batches, PIECE):
            tokens, endings, at = tokens_of(data, offsets, hasher)
            classes = known.classes(tokens, endings)
            hit, place = known.in_head(tokens)
            logs = np.zeros(len(tokens))
            logs[hit] = np.log10(known.counts[place[hit]] + 1.0)
            features, leaves = contexts(tokens, classes, at), np.where(hit, place, len(known.head) + classes)
            score = class_scores(weights, rows_of(features, len(weights)), classes)
            score += fork_scores(inside, tree, features, leaves)
            score -= np.where(hit, 0, tree.rarer[classes])
            rest = np.flatnonzero(~hit)
            text = np.searchsorted(at, rest, "right") - 1
            order = np.lexsort((tokens[rest], text))
            word, text = tokens[rest][order], text[order]
            new = np.ones(len(word), bool)
            new[1:] = (word[1:] != word[:-1]) | (text[1:] != text[:-1])
            first = np.flatnonzero(new)
            ends = pa.array(np.searchsorted(text[first], np.arange(len(at))).astype(np.int32))
            times = np.diff(np.append(first, len(word))).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc_id"), part.column("held_out")]
                + [pa.array(np.diff(at))]
                + [pa.array(row_sums(x, at)) for x in (hit.astype(np.int64), logs, score)]
                + [
                    pa.ListArray.from_arrays(ends, pa.array(word[first].view(np.int64))),
                    pa.ListArray.from_arrays(ends, pa.array(times)),
                ],
                ["row", "doc_id", "held_out", "n_tokens", "head_known", "head_base", "head_score",
                 "words", "times"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("row", "doc_id", "held_out", "text").mapInArrow(run, PARTS.format(kind))


def scored(docs: DataFrame, held_out: Column) -> DataFrame:
    """Scores of all documents by a model learnt from those that are not ``held_out``."""
    docs = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text", held_out.alias("held_out")
    )
    training = docs.filter("not held_out").select(F.coalesce("text", F.lit("")).alias("text"))
    counts = stored(counted(training), "counts")
    known = vocabulary(counts)
    tree = forks(known)
    weights, inside = fitted(training, known, tree)
    parts = stored(head_scores(docs, known, tree, weights, inside), "scores")
    rest = parts.select("row", F.explode(F.arrays_zip("words", "times")).alias("rest"))
    rest = rest.select("row", F.col("rest.words").alias("word"), F.col("rest.times").alias("n"))
    # Only known tokens matter: an unknown one adds log10(0 + 1).
    met = rest.join(counts.filter("word is not null").select("word", "c"), "word").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.col("c") + F.lit(1.0))).alias("log"), F.sum("n").alias("known")
    )
    more = F.coalesce("log", F.lit(0.0))
    size = F.log10(F.lit(float(known.total + known.distinct + 1)))
    return parts.join(met, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("head_base") + more - F.col("n_tokens") * size).alias("base_score"),
        (F.col("head_score") + more).alias("score"),
    )


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return scored(table(spark, sf_dir, "documents"), place % 7 == 2)
