"""Conversation structure repair: the cheapest edits that give every conversation a lawful form.

A conversation is lawful if its role initials are ``(s?(ua)+)?``. Edits and their costs: Keep 0,
Rerole to user or assistant 2, Delete 3 (a must for blank rows and duplicates), Insert an empty
turn 2; a truncated row that is not deleted adds 1. Of equally cheap edits the ones whose initials
are first in ASCII count.

The automaton of the form has four states, and a letter that a row or an insertion may add follows
from the state. So a row is one of nine symbols, and a sequence of symbols is a 4 x 4 matrix in
(min, +): the cheapest edits, with their audit, that lead from one state to another. Insertions are
counted before the row that follows them; then no audit is the beginning of another of the same
rows, and the first audit of a whole is made of the first audits of its parts.

Sequences are compressed by Re-Pair: rounds of pair counts over all distinct sequences, each of
which replaces its most frequent pairs that share no symbol. Rules and rounds are bounded, which
costs time alone. Every rule has one matrix, made bottom-up from its two parts; audits are ropes
that share these parts. A conversation multiplies the matrices of the few symbols that are left.

Conversations are cut into segments of bounded size by a range sort, so one that holds a third of
all rows spreads over tasks up to its last step: a fold of small matrices, and the digest of the
repaired text, which SHA-256 forces into one stream and which holds one segment at a time.

Defined results: null roles and texts are one space; a null ``conv_id`` is a conversation of its
own; null turns come first; rows of one turn are in the order of role and text (its first 64
characters, then a digest), so equal rows stand together; gaps count over the turns that are left;
a conversation without rows has zeros, an empty audit and the digest of nothing; an empty table
gives no row; other columns are not read. Equal texts are told by SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from snaptrack.llm.tables import stored, table

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
SEGMENT_ROWS = 512
SEGMENT_BYTES = 1 << 22
HEAD = 64
RULES = 512
ROUNDS = 12
LEAST = 2
FIRST_RULE = 0xE000
MEMO = 1 << 16

# States: nothing yet, after system, after user, after assistant.
STATES = 4
NEXT = (2, 2, 3, 2)  # the state that a user or assistant turn leads to
NAMES = {2: "user", 3: "assistant"}
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "x": {}}
FINAL = ((0, ""), (4, "II"), (2, "I"), (0, ""))
LAWFUL = {"su", "ua", "au"}
DELETED = "-"


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, present``: the rows after the damage that their key names."""
    key = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    )
    hit = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    copies = F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(hit == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        (hit != 0).alias("present"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


# ---- segments of ordered rows


def ordered(rows: DataFrame) -> DataFrame:
    """Rows in the order of conversation and turn over all tasks, with what a segment needs."""
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    last = F.substring(F.rtrim(text, F.lit(BLANKS)), -1, 1)
    fault = F.when(F.translate(text, BLANKS, "") == "", "b").when(last.isin(*ENDS), ".").otherwise("t")
    rows = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.substring(text, 1, HEAD).alias("_head"),
        F.unhex(F.sha2(F.concat(F.octet_length(role), F.lit(":"), role, text), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("_row"),
        "present",
        fault.alias("fault"),
        F.when(F.col("present"), text).alias("text"),
    )
    order = ["conv_id", "turn", "role", "_head", "digest", "_row"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_head", "_row")


class Segment:
    """Rows of one conversation that stand together."""

    def __init__(self, conv_id, number: int, whole: bool):
        self.cells = {
            "conv_id": conv_id, "seg": number, "whole": whole, "initials": "", "faults": "",
            "low": None, "high": None, "turns": 0, "roles": [], "texts": [], "digests": [],
        }
        self.bytes, self.marks, self.seen = 0, [], set()

    def add(self, turn, role, digest, fault, text) -> None:
        cells = self.cells
        if fault != "b" and digest in self.seen:
            fault = "d"
        self.seen.add(digest)
        initial = role[:1]
        self.marks.append((initial if initial and initial in "sua" else "x", fault))
        cells["roles"].append(role)
        cells["texts"].append(text)
        cells["digests"].append(digest)
        if turn is not None and turn != cells["high"]:
            cells["low"] = turn if cells["low"] is None else cells["low"]
            cells["high"], cells["turns"] = turn, cells["turns"] + 1
        self.bytes += len(text)

    def full(self) -> bool:
        return len(self.marks) >= SEGMENT_ROWS or self.bytes >= SEGMENT_BYTES

    def done(self, whole: bool) -> dict:
        cells = self.cells
        cells["initials"], cells["faults"] = ("".join(x) for x in zip(*self.marks)) if self.marks else ("", "")
        cells["whole"] &= whole
        if cells["whole"]:
            cells["digests"] = []  # no other segment may hold its texts
        return cells


def segments(rows: DataFrame) -> DataFrame:
    """One row per segment. ``whole`` ones hold all rows of their conversation; of the others that
    may go on in another task or segment, the digests are kept."""
    fields = [
        T.StructField("conv_id", rows.schema["conv_id"].dataType),
        *T.StructType.fromDDL(
            "seg long, whole boolean, initials string, faults string, low long, high long, "
            "turns long, roles array<string>, texts array<string>, digests array<binary>"
        ).fields,
    ]
    schema = T.StructType(fields)
    arrow_types = {
        "seg": pa.int64(), "whole": pa.bool_(), "initials": pa.string(), "faults": pa.string(),
        "low": pa.int64(), "high": pa.int64(), "turns": pa.int64(), "roles": pa.list_(pa.string()),
        "texts": pa.list_(pa.string()), "digests": pa.list_(pa.binary()),
    }

    def run(batches) -> Iterator[pa.RecordBatch]:
        task, number, segment, out, size = TaskContext.get().partitionId(), 0, None, [], 0
        kinds = None

        def flushed():
            return pa.RecordBatch.from_pylist(out, pa.schema(kinds))

        for batch in batches:
            kinds = [("conv_id", batch.schema.field("conv_id").type), *arrow_types.items()]
            columns = ("conv_id", "turn", "role", "digest", "fault", "text", "present")
            for conv_id, turn, role, digest, fault, text, present in zip(
                *(batch.column(c).to_pylist() for c in columns)
            ):
                same = segment is not None and segment.cells["conv_id"] == conv_id
                if not same or segment.full():
                    if segment is not None:
                        out.append(segment.done(not same))
                        size += segment.bytes
                    # The first conversation of a task may have begun in the one before.
                    segment = Segment(conv_id, (task << 32) + number, number > 0 and not same)
                    number += 1
                if present:
                    segment.add(turn, role, digest, fault, text)
                if len(out) >= 4096 or size >= SEGMENT_BYTES:
                    yield flushed()
                    out, size = [], 0
        if segment is not None:
            out.append(segment.done(False))
        if out:
            yield flushed()

    return rows.mapInArrow(run, schema)


def repeated_elsewhere(cut: DataFrame) -> DataFrame:
    """``seg, again``: positions whose role and text an earlier segment of the conversation holds.

    A segment holds a text once here, so a text on most rows of a large conversation comes down to
    one row per segment.
    """
    spots = cut.filter("not whole").select(
        F.col("conv_id"), "seg", "faults", F.posexplode("digests").alias("at", "digest")
    )
    spots = stored(
        spots.filter(~F.expr("substring(faults, at + 1, 1)").isin("b", "d")).drop("faults"), "spots"
    )
    first = spots.groupBy("conv_id", "digest").agg(
        F.min("seg").alias("first"), F.count("*").alias("n")
    )
    first = first.filter("n > 1").select(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"), "first")
    met = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest"))
    later = spots.join(first, met).filter("seg > first")
    return later.groupBy("seg").agg(F.collect_list("at").alias("again"))


def shapes(cut: DataFrame) -> DataFrame:
    """Per segment its symbols, its counts and what its neighbours need to know of its ends."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        names = ["symbols", "blank", "duplicate", "truncated", "illegal", "first", "last"]
        for batch in batches:
            out = {name: [] for name in names}
            for initials, faults, again in zip(
                *(batch.column(c).to_pylist() for c in ("initials", "faults", "again"))
            ):
                if again:
                    marks = list(faults)
                    for at in again:
                        marks[at] = "d"
                    faults = "".join(marks)
                out["symbols"].append(symbols(initials, faults))
                for name, mark in (("blank", "b"), ("duplicate", "d"), ("truncated", "t")):
                    out[name].append(faults.count(mark))
                pairs = zip(initials, initials[1:])
                out["illegal"].append(sum(a + b not in LAWFUL for a, b in pairs))
                out["first"].append(initials[:1])
                out["last"].append(initials[-1:])
            kept = ["conv_id", "seg", "low", "high", "turns"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept]
                + [pa.array(out[n], pa.int64() if n in names[1:5] else pa.string()) for n in names],
                kept + names,
            )

    columns = cut.select("conv_id", "seg", "low", "high", "turns", "initials", "faults", "again")
    schema = columns.drop("initials", "faults", "again").schema
    for name in ("symbols", "blank", "duplicate", "truncated", "illegal", "first", "last"):
        text = name in ("symbols", "first", "last")
        schema = schema.add(name, T.StringType() if text else T.LongType())
    return columns.mapInArrow(run, schema)


def symbols(initials: str, faults: str) -> str:
    """Initials, in upper case if the row is truncated; a row that must go is one symbol."""
    return "".join(
        DELETED if fault in "bd" else initial.upper() if fault == "t" else initial
        for initial, fault in zip(initials, faults)
    )


# ---- matrices in (min, +) with audits


def before(a, b) -> bool:
    """Whether the text of rope ``a`` comes before that of ``b``. Parts they share are skipped."""
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        deep_x, deep_y = isinstance(x, tuple), isinstance(y, tuple)
        if deep_x and (not deep_y or x[0] >= y[0]):
            left += [x[2], x[1]]
            right.append(y)
        elif deep_y:
            left.append(x)
            right += [y[2], y[1]]
        else:
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return x[:n] < y[:n]
            if len(x) > n:
                left.append(x[n:])
            if len(y) > n:
                right.append(y[n:])
    return bool(right)


def text_of(rope) -> str:
    out, todo = [], [rope]
    while todo:
        part = todo.pop()
        if isinstance(part, tuple):
            todo += [part[2], part[1]]
        else:
            out.append(part)
    return "".join(out)


def size_of(rope) -> int:
    return rope[0] if isinstance(rope, tuple) else len(rope)


def joined(a, b):
    """The rope of both texts: a pair with its length, or the other if one is empty."""
    if not size_of(a):
        return b
    if not size_of(b):
        return a
    return (size_of(a) + size_of(b), a, b)


def better(new, old) -> bool:
    if old is None or new[0] != old[0]:
        return old is None or new[0] < old[0]
    return before(new[1], old[1])


def product(a: list, b: list) -> list:
    """Matrices are 16 entries (cost, rope) or None, from state i to state j at 4 * i + j."""
    out = [None] * (STATES * STATES)
    for i in range(STATES):
        for k in range(STATES):
            x = a[STATES * i + k]
            if x is None:
                continue
            for j in range(STATES):
                y = b[STATES * k + j]
                old = out[STATES * i + j]
                if y is None or old is not None and x[0] + y[0] > old[0]:
                    continue
                new = (x[0] + y[0], joined(x[1], y[1]))
                if better(new, old):
                    out[STATES * i + j] = new
    return out


IDENTITY = [(0, "") if i == j else None for i in range(STATES) for j in range(STATES)]


def insertions() -> list:
    out = list(IDENTITY)
    for i in range(STATES):
        state, text = NEXT[i], "I"
        while out[STATES * i + state] is None:
            out[STATES * i + state] = (2 * len(text), text)
            state, text = NEXT[state], text + "I"
    return out


def leaf(symbol: str) -> list:
    """The matrix of one row, after any insertions."""
    out = [None] * (STATES * STATES)
    cost = 1 if symbol.isupper() else 0
    for i in range(STATES):
        moves = [(3, "D", i)]
        if symbol != DELETED:
            moves.append((2 + cost, "R", NEXT[i]))
            if i in KEPT[symbol.lower()]:
                moves.append((cost, "K", KEPT[symbol.lower()][i]))
        for price, edit, j in moves:
            if better((price, edit), out[STATES * i + j]):
                out[STATES * i + j] = (price, edit)
    return product(insertions(), out)


LEAVES = "suaxSUAX" + DELETED


def evaluated(rules: list[tuple[str, str]]) -> dict[str, list]:
    """The matrix of every symbol, a rule's from those of its two parts."""
    out = {symbol: leaf(symbol) for symbol in LEAVES}
    for symbol, pair in rules:
        out[symbol] = product(out[pair[0]], out[pair[1]])
    return out


def compressed(text: str, rules: list[tuple[str, str]]) -> str:
    for symbol, pair in rules:
        text = text.replace(pair, symbol)
    return text


def matrix(text: str, rules: list[tuple[str, str]], known: dict[str, list]) -> list:
    """The matrix of a sequence: its compressed symbols, multiplied two by two."""
    parts = [known[symbol] for symbol in compressed(text, rules)]
    while len(parts) > 1:
        pairs = [product(a, b) for a, b in zip(parts[::2], parts[1::2])]
        parts = pairs + parts[len(parts) // 2 * 2 :]
    return parts[0] if parts else IDENTITY


def learnt_rules(shaped: DataFrame, most: int = RULES, rounds: int = ROUNDS) -> list[tuple[str, str]]:
    """Re-Pair over all sequences: ``(symbol, pair)`` in the order in which they replace."""
    rest = stored(shaped.groupBy("symbols").agg(F.count("*").alias("n")), "sequences")
    rules: list[tuple[str, str]] = []
    for _ in range(rounds):
        at = F.sequence(F.lit(1), F.length("symbols") - 1)
        pairs = F.explode(F.transform(at, lambda i: F.substring(F.col("symbols"), i, F.lit(2))))
        counts = (
            rest.filter(F.length("symbols") > 1)
            .select("n", pairs.alias("pair"))
            .groupBy("pair").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= LEAST)
            .orderBy(F.desc("n"), "pair")
            .limit(most)
        )
        new: list[tuple[str, str]] = []
        used: set[str] = set()
        for row in counts.collect():  # at most ``most`` rows
            if used.isdisjoint(row["pair"]) and len(rules) + len(new) < most:
                new.append((chr(FIRST_RULE + len(rules) + len(new)), row["pair"]))
                used |= set(row["pair"])
        if not new:
            break
        rules += new
        replaced = F.col("symbols")
        for symbol, pair in new:
            replaced = F.replace(replaced, F.lit(pair), F.lit(symbol))
        rest = stored(rest.select(replaced.alias("symbols"), "n"), "sequences")
    return rules


def matrices(shaped: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Adds ``costs, ranks, audits``: the segment's matrix; equal audits have equal ranks."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        known, memo = evaluated(rules), {}
        for batch in batches:
            out = []
            for text in batch.column("symbols").to_pylist():
                if text not in memo:
                    if len(memo) >= MEMO:
                        memo.clear()
                    cells = matrix(text, rules, known)
                    audits = [text_of(cell[1]) if cell else None for cell in cells]
                    places = {a: i for i, a in enumerate(sorted({a for a in audits if a is not None}))}
                    memo[text] = (
                        [cell[0] if cell else None for cell in cells],
                        [places.get(a) for a in audits],
                        audits,
                    )
                out.append(memo[text])
            kinds = (pa.int64(), pa.int32(), pa.string())
            more = [pa.array([row[i] for row in out], pa.list_(kind)) for i, kind in enumerate(kinds)]
            names = [n for n in batch.schema.names if n != "symbols"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + more, names + ["costs", "ranks", "audits"]
            )

    schema = shaped.drop("symbols").schema
    for name, kind in (("costs", T.LongType()), ("ranks", T.IntegerType()), ("audits", T.StringType())):
        schema = schema.add(name, T.ArrayType(kind))
    return shaped.mapInArrow(run, schema)


# ---- conversations


FAR = 1 << 60
TOTALS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def cheapest_path(costs: np.ndarray, ranks: np.ndarray) -> tuple[int, list[int], int]:
    """Least cost, the entry taken in each segment, and the last state. Equal costs go to the
    audit that is first: no audit of a segment begins another, so the first difference decides."""
    ahead = [np.array([cost for cost, _ in FINAL])]
    for cost in costs[::-1]:
        ahead.append((cost.reshape(STATES, STATES) + ahead[-1][None]).min(1))
    ahead.reverse()
    total, state, taken = int(ahead[0][0]), 0, []
    for cost, rank, rest in zip(costs, ranks, ahead[1:]):
        row = slice(STATES * state, STATES * state + STATES)
        whole = cost[row] + rest
        best = np.flatnonzero(whole == whole.min())
        to = int(best[np.argmin(rank[row][best])])
        taken.append(STATES * state + to)
        state = to
    return total, taken, state


def folded(parts: DataFrame) -> DataFrame:
    """``conv_id, seg, entry``; the last segment of a conversation has its totals and its tail."""
    names = ["conv_id", "seg", "entry", *TOTALS, "tail"]

    def answer(rows: list[dict]) -> list[dict]:
        costs = np.array([[FAR if c is None else c for c in row["costs"]] for row in rows])
        ranks = np.array([[99 if c is None else c for c in row["ranks"]] for row in rows])
        total, taken, state = cheapest_path(costs, ranks)
        out = [{"conv_id": r["conv_id"], "seg": r["seg"], "entry": e} for r, e in zip(rows, taken)]
        last = {name: sum(row[name] for row in rows) for name in TOTALS[1:5]}
        filled = [row for row in rows if row["first"]]
        last["illegal"] += sum(
            a["last"] + b["first"] not in LAWFUL for a, b in zip(filled, filled[1:])
        )
        timed = [row for row in rows if row["turns"]]
        turns = sum(row["turns"] for row in timed)
        turns -= sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:]))
        last["gaps"] = timed[-1]["high"] - timed[0]["low"] + 1 - turns if timed else 0
        out[-1] |= {**last, "cost": total, "tail": FINAL[state][1]}
        return out

    schema = parts.select("conv_id", "seg").schema.add("entry", T.IntegerType())
    for name in TOTALS:
        schema = schema.add(name, T.LongType())
    schema = schema.add("tail", T.StringType())

    def run(batches) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            kinds = pa.schema(
                [("conv_id", batch.schema.field("conv_id").type), ("seg", pa.int64()), ("entry", pa.int32())]
                + [(name, pa.int64()) for name in TOTALS] + [("tail", pa.string())]
            )
            out: list[dict] = []
            for row in batch.to_pylist():
                if rows and rows[0]["conv_id"] != row["conv_id"]:
                    out += answer(rows)
                    rows = []
                rows.append(row)
            yield pa.RecordBatch.from_pylist(out, kinds)
        if rows:
            yield pa.RecordBatch.from_pylist(answer(rows), kinds)

    parts = parts.drop("audits").repartition("conv_id").sortWithinPartitions("conv_id", "seg")
    return parts.mapInArrow(run, schema).select(*names)


class Writer:
    """Streams the repaired lines of one conversation into a digest."""

    def __init__(self):
        self.digest, self.state, self.first, self.audit = hashlib.sha256(), 0, True, []

    def line(self, role: str, text: str) -> None:
        self.digest.update((("" if self.first else "\n") + role + ":" + text).encode())
        self.first = False

    def write(self, audit: str, roles: list[str], texts: list[str]) -> None:
        self.audit.append(audit)
        at = 0
        for edit in audit:
            if edit in "IR":
                self.state = NEXT[self.state]
                self.line(NAMES[self.state], texts[at] if edit == "R" else "")
            elif edit == "K":
                self.state = KEPT[roles[at][0]][self.state]
                self.line(roles[at], texts[at])
            at += edit != "I"


def written(cut: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row per conversation. Edits travel ahead of the texts that they belong to, so that one
    sort brings both together without a join on a key that may be null or hot."""
    ahead = chosen.select(
        "conv_id", "seg", F.lit(0).alias("kind"), "audit", *TOTALS, "tail",
        F.lit(None).cast("array<string>").alias("roles"), F.lit(None).cast("array<string>").alias("texts"),
    )
    texts = cut.select(
        "conv_id", "seg", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"),
        *[F.lit(None).cast("long").alias(n) for n in TOTALS], F.lit(None).cast("string").alias("tail"),
        "roles", "texts",
    )
    both = ahead.union(texts).repartition("conv_id").sortWithinPartitions("conv_id", "seg", "kind")
    schema = cut.select("conv_id").schema
    for name in TOTALS:
        schema = schema.add(name, T.LongType())
    schema = schema.add("audit", T.StringType()).add("repaired_sha256", T.StringType())

    def run(batches) -> Iterator[pa.RecordBatch]:
        writer, edits = Writer(), None
        for batch in batches:
            kinds = pa.schema(
                [("conv_id", batch.schema.field("conv_id").type)]
                + [(name, pa.int64()) for name in TOTALS]
                + [("audit", pa.string()), ("repaired_sha256", pa.string())]
            )
            out = []
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                if not row["kind"]:
                    edits = row
                    continue
                writer.write(edits["audit"], row["roles"], row["texts"])
                if edits["tail"] is not None:
                    writer.write(edits["tail"], [], [])
                    out.append(
                        {n: edits[n] for n in ("conv_id", *TOTALS)}
                        | {"audit": "".join(writer.audit), "repaired_sha256": writer.digest.hexdigest()}
                    )
                    writer = Writer()
            yield pa.RecordBatch.from_pylist(out, kinds)

    return both.mapInArrow(run, schema)


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits and the digest of the result.

    ``rows`` have ``conv_id, turn, role, text, present``; a row that is not present names its
    conversation and is nothing else.
    """
    cut = stored(segments(ordered(rows)), "segments")
    again = stored(repeated_elsewhere(cut), "again")
    shaped = stored(shapes(cut.join(again, "seg", "left")), "shapes")
    parts = stored(matrices(shaped, learnt_rules(shaped)), "matrices")
    chosen = folded(parts).join(parts.select("seg", "audits"), "seg")
    chosen = chosen.withColumn("audit", F.element_at("audits", F.col("entry") + 1)).drop("audits")
    return written(cut, stored(chosen, "edits"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(damaged(table(spark, sf_dir, "conversations")))


def _oracle() -> str:
    """The same by a search over states, row by row and letter by letter."""
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    far = "{'c': 1000000000, 'a': ''}"

    def after(state: str, cost: str, edits: str) -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edits}'}}"

    def first(*choices: str) -> str:
        return f"list_sort([{', '.join(choices)}])[1]"

    def may(condition: str, choice: str) -> str:
        return f"case when {condition} then {choice} else {far} end"

    inserted = [
        "s[1]",
        "s[2]",
        first("s[3]", *(after(f"s[{i}]", "2", "I") for i in (1, 2, 4))),
        first("s[4]", after("s[3]", "2", "I"), *(after(f"s[{i}]", "4", "II") for i in (1, 2))),
    ]
    free, late = "o.fault in ('.', 't')", "case when o.fault = 't' then 1 else 0 end"
    kept = f"({late})"
    again = f"(2 + {late})"
    moved = [
        after("i[1]", "3", "D"),
        first(after("i[2]", "3", "D"), may(f"{free} and o.initial = 's'", after("i[1]", kept, "K"))),
        first(
            after("i[3]", "3", "D"),
            *(may(free, after(f"i[{j}]", again, "R")) for j in (1, 2, 4)),
            *(may(f"{free} and o.initial = 'u'", after(f"i[{j}]", kept, "K")) for j in (1, 2, 4)),
        ),
        first(
            after("i[4]", "3", "D"),
            may(free, after("i[3]", again, "R")),
            may(f"{free} and o.initial = 'a'", after("i[3]", kept, "K")),
        ),
    ]
    ended = first("s[1]", after("s[2]", "4", "II"), after("s[3]", "2", "I"), "s[4]")
    return f"""
with recursive
k as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name
  from conversations),
h as (
  select *, xor(list_reduce(
    list_prepend(4294967295::ubigint, list_transform(string_split(name, ''), lambda c: ascii(c)::ubigint)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), list_transform(range(8), lambda j: j::ubigint)),
      lambda v, j: xor(v >> 1, case when v & 1 = 1 then 3988292384::ubigint else 0::ubigint end))),
    4294967295::ubigint) % 20 as hit
  from k),
d as (
  select conv_id, turn, case when hit = 4 then 'user' else role end as role,
         case when hit = 1 then '' when hit = 2 then translate(text, '.!?', '') else text end as text
  from h, unnest(case when hit = 3 then [0, 1] else [0] end) as t(copy) where hit <> 0),
n as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, substr(text, 1, {HEAD}),
           sha256(strlen(role)::varchar || ':' || role || text)) as n
  from d),
o as (
  select *, case when left(role, 1) in ('s', 'u', 'a') then left(role, 1) else 'x' end as initial,
         case when trim(text, {blanks}) = '' then 'b'
              when row_number() over (partition by conv_id, role, text order by n) > 1 then 'd'
              when right(rtrim(text, {blanks}), 1) in ('.', '!', '?') then '.' else 't' end as fault
  from n),
convs as (
  select c.conv_id, count(o.n) as size,
         coalesce(max(o.turn) - min(o.turn) + 1 - count(distinct o.turn), 0) as gaps,
         coalesce(count_if(o.fault = 'b'), 0) as blank, coalesce(count_if(o.fault = 'd'), 0) as duplicate,
         coalesce(count_if(o.fault = 't'), 0) as truncated
  from (select distinct conv_id from conversations) c
  left join o on o.conv_id is not distinct from c.conv_id group by c.conv_id),
bad as (
  select a.conv_id, count(*) as illegal from o a join o b
    on a.conv_id is not distinct from b.conv_id and b.n = a.n + 1
  where a.initial || b.initial not in ('su', 'ua', 'au') group by a.conv_id),
dp as (
  select conv_id, 0::bigint as n, [{{'c': 0, 'a': ''}}, {far}, {far}, {far}] as s from convs
  union all
  select conv_id, n, [{', '.join(moved)}] as s
  from (select dp.conv_id, o.n, o, [{', '.join(inserted)}] as i
        from dp join o on o.conv_id is not distinct from dp.conv_id and o.n = dp.n + 1) as p),
best as (
  select convs.*, {ended} as top from convs join dp
    on dp.conv_id is not distinct from convs.conv_id and dp.n = convs.size),
lines as (
  select conv_id, top.a as audit, 0 as place, 0::bigint as n, 0 as state, null::varchar as written from best
  union all
  select l.conv_id, l.audit, l.place + 1, l.n + (e <> 'I')::int,
         case when e = 'D' then l.state when e = 'K' and o.initial = 's' then 1
              when e = 'K' and o.initial = 'u' then 2 when e = 'K' then 3
              when l.state = 2 then 3 else 2 end,
         case when e = 'D' then l.written else
           coalesce(l.written || chr(10), '') || case when e = 'K' then o.role
             when l.state = 2 then 'assistant' else 'user' end || ':' ||
           case when e = 'I' then '' else o.text end end
  from (select *, substr(audit, place + 1, 1) as e from lines where place < length(audit)) as l
  left join o on o.conv_id is not distinct from l.conv_id and o.n = l.n + 1)
select best.conv_id, gaps::bigint as gaps, blank::bigint as blank, duplicate::bigint as duplicate,
       truncated::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, top.c::bigint as cost,
       top.a as audit, sha256(coalesce(written, '')) as repaired_sha256
from best left join bad on bad.conv_id is not distinct from best.conv_id
join lines on lines.conv_id is not distinct from best.conv_id and lines.place = length(top.a)"""


ORACLE = _oracle()
