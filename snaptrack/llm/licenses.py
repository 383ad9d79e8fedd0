"""License scan: a trained paragraph classifier in built-in expressions.

A paragraph is a line with a word, or a window of neighbouring lines of a block: a notice wrapped
over lines is seen whole, whatever signs its lines begin with. A block ends at a line without a word
of a-z or digits. Windows of ``WIDTHS`` lines begin at every line, and where lines are short, windows
of as many lines as hold ``TARGETS`` words: the longest has room for every template at one word a
line. A window is reported only if it is confirmed and no narrower one inside it is confirmed for
the same family. A paragraph's features
are the hashed words and word pairs of its lower case form, each of weight one over the root of
their number. A multinomial logistic regression tells licence families and ``unknown`` apart; a
held-back part of its rows sets the temperature of the probabilities. A prediction is confirmed if its probability reaches ``CERTAIN`` and a template
of the family shares ``SHARE`` of its words and word pairs with the paragraph, which must hold what
tells the family from its likes (``REQUIRED``: lesser, affero, version numbers, sa, nc) and nothing
that takes the grant back (``DENIED``: not licensed, no longer released); its template share is 0
otherwise. Identifiers of the SPDX list are templates like others.

The model is fitted on the driver on the templates, on variants of them, and on the paragraphs of
``SAMPLE`` document ids, the first in the order of a hash, that match no template: at most
``MOST_ROWS`` lines of at most ``TAUGHT_CHARS`` characters, the first in the order of a hash. Scoring is one
projection over all paragraphs. Two bounds come first: a few words of each template without which
no paragraph can share enough of it, and the most any family can gain over ``unknown``. Only
paragraphs that pass both get the probabilities of all families; no other one could be confirmed.

The scored paragraphs are written before they are put together: what a caller does with the result,
a filter too, reads that table and the documents.

Defined results: one row per row, whatever its id; a null or empty text has no paragraph and no
licence; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import json
from collections import Counter
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snaptrack.llm.tables import first_ids, has_word, lines_of, once, stored, table, told_apart

SLOTS = 2048
SAMPLE = 256
MOST_ROWS = 2048
VARIANTS = 40
CERTAIN = 0.5
SHARE = 0.6
TAUGHT_CHARS = 2000
WIDTHS = (2, 3, 4, 6)
TARGETS = (12, 24, 48)
UNKNOWN = "unknown"

# Notices of public licences, in lower case without signs.
TEMPLATES = {
    "apache-2.0": (
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license",
        "you may obtain a copy of the license at http www apache org licenses license 2 0",
        "unless required by applicable law or agreed to in writing software distributed under the"
        " license is distributed on an as is basis",
    ),
    "mit": (
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files",
        "the above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the software",
    ),
    "gpl-3.0": (
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms"
        " of the gnu general public license",
        "you should have received a copy of the gnu general public license along with this"
        " program",
        "this program is free software you can redistribute it and or modify it under the terms"
        " of the gnu general public license as published by the free software foundation either"
        " version 3 of the license or at your option any later version",
    ),
    "gpl-2.0": (
        "this work is licensed under the gnu general public license version 2",
        "this program is free software you can redistribute it and or modify it under the terms"
        " of the gnu general public license as published by the free software foundation either"
        " version 2 of the license or at your option any later version",
        "under the terms of the gnu general public license version 2 as published by the free"
        " software foundation",
    ),
    "lgpl-3.0": (
        "this work is licensed under the gnu lesser general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms"
        " of the gnu lesser general public license as published by the free software foundation"
        " either version 3 of the license or at your option any later version",
    ),
    "lgpl-2.1": (
        "this work is licensed under the gnu lesser general public license version 2 1",
        "this library is free software you can redistribute it and or modify it under the terms"
        " of the gnu lesser general public license as published by the free software foundation"
        " either version 2 1 of the license or at your option any later version",
    ),
    "agpl-3.0": (
        "this work is licensed under the gnu affero general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms"
        " of the gnu affero general public license as published by the free software foundation"
        " either version 3 of the license or at your option any later version",
    ),
    "mpl-2.0": (
        "licensed under the mozilla public license version 2 0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "if a copy of the mpl was not distributed with this file you can obtain one at http"
        " mozilla org mpl 2 0",
    ),
    "isc": (
        "licensed under the isc license",
        "permission to use copy modify and or distribute this software for any purpose with or"
        " without fee is hereby granted provided that the above copyright notice and this"
        " permission notice appear in all copies",
    ),
    "bsd": (  # how the texts of both BSD licences begin
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met",
    ),
    "bsd-2-clause": ("licensed under the bsd 2 clause license",),
    "bsd-3-clause": (
        "licensed under the bsd 3 clause license",
        "neither the name of the copyright holder nor the names of its contributors may be used"
        " to endorse or promote products derived from this software",
    ),
    "cc-by-4.0": (
        "licensed under cc by 4 0",
        "this work is licensed under a creative commons attribution 4 0 international license",
    ),
    "cc-by-sa-4.0": (
        "licensed under cc by sa 4 0",
        "this work is licensed under a creative commons attribution sharealike 4 0 international"
        " license",
    ),
    "cc-by-nd-4.0": (
        "licensed under cc by nd 4 0",
        "this work is licensed under a creative commons attribution noderivatives 4 0"
        " international license",
    ),
    "cc-by-nc-sa-4.0": (
        "licensed under cc by nc sa 4 0",
        "this work is licensed under a creative commons attribution noncommercial sharealike 4 0"
        " international license",
    ),
    "cc-by-nc-nd-4.0": (
        "licensed under cc by nc nd 4 0",
        "this work is licensed under a creative commons attribution noncommercial noderivatives"
        " 4 0 international license",
    ),
    "cc0-1.0": (
        "licensed under cc0 1 0",
        "to the extent possible under law the author has waived all copyright and related or"
        " neighboring rights to this work under cc0 1 0 universal public domain dedication",
    ),
    "cc-by-nc-4.0": (
        "licensed under cc by nc 4 0",
        "this work is licensed under a creative commons attribution noncommercial 4 0"
        " international license",
    ),
    "bsl-1.0": (
        "distributed under the boost software license version 1 0",
        "permission is hereby granted free of charge to any person or organization obtaining a copy"
        " of the software and accompanying documentation covered by this license",
    ),
    "epl-2.0": (
        "licensed under the eclipse public license version 2 0",
        "this program and the accompanying materials are made available under the terms of the"
        " eclipse public license 2 0",
    ),
    "eupl-1.2": (
        "licensed under the eupl version 1 2",
        "licensed under the european union public licence version 1 2",
    ),
    "unlicense": (
        "released under the unlicense",
        "this is free and unencumbered software released into the public domain",
    ),
    "all-rights-reserved": (
        "all rights reserved",
        "no part of this work may be reproduced without the written permission of the publisher",
    ),
}

# Words and word pairs that tell a family from its likes. A paragraph is confirmed
# only if it holds one of each group; a family without an entry has no likes in the list.
REQUIRED = {
    "apache-2.0": (("apache",), ("2", "v2", "version 2")),
    "mit": (("mit", "granted free", "substantial portions"),),
    "gpl-3.0": (("gnu general", "gpl"), ("version 3", "v3", "gpl 3")),
    "gpl-2.0": (("gnu general", "gpl"), ("version 2", "v2", "gpl 2")),
    "lgpl-3.0": (("lesser", "lgpl"), ("version 3", "v3", "lgpl 3")),
    "lgpl-2.1": (("lesser", "lgpl"), ("version 2", "v2", "lgpl 2"), ("2 1", "v2 1")),
    "agpl-3.0": (("affero", "agpl"), ("version 3", "v3", "agpl 3")),
    "mpl-2.0": (("mozilla", "mpl"), ("2 0", "v2 0", "mpl 2")),
    "isc": (("isc", "without fee"),),
    "bsd": (("redistribution and",),),
    "bsd-2-clause": (("2 clause",),),
    "bsd-3-clause": (("3 clause", "neither the"),),
    "cc-by-4.0": (("by 4", "attribution 4"),),
    "cc-by-sa-4.0": (("by sa", "attribution sharealike"), ("sa 4", "sharealike 4")),
    "cc-by-nd-4.0": (("by nd", "attribution noderivatives"), ("nd 4", "noderivatives 4")),
    "cc-by-nc-4.0": (("nc 4", "noncommercial 4"),),
    "cc-by-nc-sa-4.0": (("nc sa", "noncommercial sharealike"), ("sa 4", "sharealike 4")),
    "cc-by-nc-nd-4.0": (("nc nd", "noncommercial noderivatives"), ("nd 4", "noderivatives 4")),
    "cc0-1.0": (("cc0",), ("cc0 1", "1 0")),
    "bsl-1.0": (("boost", "bsl", "or organization"),),
    "epl-2.0": (("eclipse", "epl"), ("2 0", "epl 2", "v2 0", "v 2")),
    "eupl-1.2": (("eupl", "european union"), ("1 2", "v1 2")),
    "unlicense": (("unlicense", "unencumbered"),),
}

# Identifiers as they follow "SPDX-License-Identifier:", in lower case without signs.
IDENTIFIERS = {
    "apache-2.0": ("apache 2 0",),
    "mit": ("mit",),
    "gpl-3.0": ("gpl 3 0 only", "gpl 3 0 or later"),
    "gpl-2.0": ("gpl 2 0 only", "gpl 2 0 or later"),
    "lgpl-3.0": ("lgpl 3 0 only", "lgpl 3 0 or later"),
    "lgpl-2.1": ("lgpl 2 1 only", "lgpl 2 1 or later"),
    "agpl-3.0": ("agpl 3 0 only", "agpl 3 0 or later"),
    "mpl-2.0": ("mpl 2 0",),
    "isc": ("isc",),
    "bsd-2-clause": ("bsd 2 clause",),
    "bsd-3-clause": ("bsd 3 clause",),
    "cc-by-4.0": ("cc by 4 0",),
    "cc-by-sa-4.0": ("cc by sa 4 0",),
    "cc-by-nd-4.0": ("cc by nd 4 0",),
    "cc-by-nc-4.0": ("cc by nc 4 0",),
    "cc-by-nc-sa-4.0": ("cc by nc sa 4 0",),
    "cc-by-nc-nd-4.0": ("cc by nc nd 4 0",),
    "cc0-1.0": ("cc0 1 0",),
    "bsl-1.0": ("bsl 1 0",),
    "epl-2.0": ("epl 2 0",),
    "eupl-1.2": ("eupl 1 2",),
    "unlicense": ("unlicense",),
}
TEMPLATES = {
    family: (*texts, *(f"spdx license identifier {name}" for name in IDENTIFIERS.get(family, ())))
    for family, texts in TEMPLATES.items()
}

# Word pairs that take back a grant; a paragraph that holds one is not confirmed.
DENIED = (
    "not licensed", "not released", "not under", "never licensed", "never released",
    "longer licensed", "longer released", "nor licensed", "not covered", "not available",
)

# Sentences about licences that grant none.
NO_LICENCE = (
    "the driving license was renewed last week in the town hall",
    "he has a license to operate the crane and the truck",
    "the software is free for the first month and then paid by the year",
    "the public library is open to all members of the general public",
    "version 3 of the program runs on the new machine at the institute",
    "the work was released in april under the title of the second book",
    "all seats were reserved and the rights of the guests were explained",
    "the copyright office moved to a new building near the river",
)


class Model(NamedTuple):
    families: list[str]  # unknown comes last
    weights: np.ndarray  # families x slots
    bias: np.ndarray
    temperature: float


def plain_words(text: Column) -> Column:
    return F.array_remove(F.split(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), " "), "")


def with_words(paragraphs: DataFrame) -> DataFrame:
    return once(paragraphs, "_words", plain_words(F.col("paragraph")))


def paragraphs_of(docs: DataFrame, needed: list[str]) -> DataFrame:
    """``_row, line, last, _words`` of the lines and windows that hold a needed word.

    A document's words are found once; windows are slices of them, made only where one of their
    lines holds a needed word. A line takes along the lines after it up to the widest window: six,
    or as many more as it takes to reach the largest number of words.
    """
    listed = F.split(F.lit(" ".join(needed)), " ")
    texts = docs.select("_row", lines_of(F.col("text")).alias("_texts"))
    rows = once(texts, "_lines", F.transform("_texts", plain_words)).drop("_texts")
    rows = once(rows, "_hits", F.transform("_lines", lambda words: F.arrays_overlap(words, listed)))
    rows = rows.filter(F.exists("_hits", lambda hit: hit))
    least, most, room = max(WIDTHS), max(TARGETS), F.size("_lines")
    rows = once(rows, "_sizes", F.transform("_lines", lambda words: F.size(words)))

    def reach(i: Column) -> Column:
        """The number of lines from line i on that hold the largest number of words."""
        taken = F.aggregate(
            F.slice("_sizes", i + 1, F.lit(most)),
            F.struct(F.lit(0).alias("words"), F.lit(0).alias("lines")),
            lambda so_far, n: F.struct(
                (so_far["words"] + n).alias("words"),
                (so_far["lines"] + F.when(so_far["words"] < most, 1).otherwise(0)).alias("lines"),
            ),
        )
        return F.greatest(taken["lines"], F.lit(least))

    def hit_within(i: Column, lines: Column) -> Column:
        return F.exists(F.slice("_hits", i + 1, lines), lambda hit: hit)

    # Lines with a hit in the widest window, then those whose own reach holds it.
    first = F.filter(F.sequence(F.lit(0), room - 1), lambda i: hit_within(i, F.lit(most)))
    spans = F.transform(first, lambda i: F.struct(i.alias("line"), reach(i).alias("reach")))
    spans = F.filter(spans, lambda span: hit_within(span["line"], span["reach"]))
    near = F.transform(
        spans,
        lambda span: F.struct(
            span["line"].alias("line"), F.slice("_lines", span["line"] + 1, span["reach"]).alias("group")
        ),
    )
    rows = rows.select("_row", F.explode(near).alias("_near")).select("_row", "_near.*")
    empty = F.array_position(F.transform("group", lambda words: F.size(words) == 0), True)
    room = F.when(empty > 0, empty - 1).otherwise(F.size("group")).cast("int")
    rows = rows.select("_row", "line", F.slice("group", F.lit(1), room).alias("group"))
    rows = rows.filter(F.exists("group", lambda words: F.arrays_overlap(words, listed)))
    sizes = F.transform("group", lambda words: F.size(words))
    sums = F.aggregate(
        sizes, F.array(F.lit(0)), lambda sums, n: F.concat(sums, F.array(F.element_at(sums, -1) + n))
    )
    rows = once(rows, "_sums", sums)
    room = F.size("group")
    widths = F.filter(F.array(F.lit(1), *map(F.lit, WIDTHS)), lambda n: n <= room)
    # Lines until so many words are reached; and the rest of a block is a window too.
    wider = F.transform(
        F.array(*map(F.lit, TARGETS)),
        lambda goal: F.least(F.size(F.filter("_sums", lambda total: total < goal)), room),
    )
    wider = F.filter(wider, lambda n: n > least)
    rest = F.filter(F.array(F.least(room, F.lit(least))), lambda n: n > 0)
    widths = F.array_distinct(F.concat(widths, rest, wider))
    rows = rows.select("_row", "line", "group", F.explode(widths).alias("_width"))
    rows = once(rows, "_words", F.flatten(F.slice("group", F.lit(1), F.col("_width"))))
    return rows.filter(F.arrays_overlap("_words", listed)).select(
        "_row", "line", (F.col("line") + F.col("_width") - 1).alias("last"), "_words"
    )


def grams_of_words() -> tuple[Column, Column, Column]:
    """Hashes of the ``_words``; from them, as ``_hashes``, hashes of words and pairs; from those,
    as ``_grams``, the slots."""
    hashes = F.transform("_words", lambda word: F.xxhash64(word))
    after = F.slice("_hashes", 2, F.greatest(F.size("_hashes"), F.lit(1)))
    pairs = F.zip_with("_hashes", after, lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))
    grams = F.array_distinct(F.concat(F.col("_hashes"), F.array_compact(pairs)))
    slots = F.transform("_grams", lambda h: F.pmod(h, F.lit(SLOTS)).cast("int"))
    return hashes, grams, F.array_distinct(slots)


def with_slots(paragraphs: DataFrame) -> DataFrame:
    """``_grams`` and ``_slots`` from ``_words``."""
    hashes, grams, slots = grams_of_words()
    rows = once(once(paragraphs, "_hashes", hashes), "_grams", grams)
    return once(rows, "_slots", slots).drop("_hashes", "_words")


def constant(values: np.ndarray) -> Column:
    """An array that the optimizer folds into one literal."""
    text = ",".join(f"{value:.4f}" for value in values)
    return F.split(F.lit(text), ",").cast("array<double>")


def total(values: np.ndarray) -> Column:
    """The weights of a paragraph's slots, added up."""
    return F.aggregate(
        "_slots", F.lit(0.0), lambda sum_, slot: sum_ + F.element_at(constant(values), slot + 1)
    )


def numbered(spark: SparkSession, texts: list[str]) -> list[tuple[list[int], list[int]]]:
    """Slots and grams of a few texts, by the expressions that score the corpus."""
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, paragraph string")
    found = with_slots(with_words(rows)).orderBy("i").collect()
    return [(row["_slots"], row["_grams"]) for row in found]


def denied_grams(spark: SparkSession) -> list[int]:
    return [grams[-1] for _, grams in numbered(spark, list(DENIED))]  # a pair comes last


def required_grams(spark: SparkSession) -> list[list[list[int]]]:
    """The groups of ``REQUIRED`` as grams, per family in the order of the templates."""
    names = sorted({gram for groups in REQUIRED.values() for group in groups for gram in group})
    last = {name: grams[-1] for name, (_, grams) in zip(names, numbered(spark, names))}  # a pair comes last
    return [[[last[gram] for gram in group] for group in REQUIRED.get(family, ())] for family in TEMPLATES]


def needed_words(common: dict[str, int]) -> list[str]:
    """Words, rare ones first, so that each template without its own loses too much to match."""
    found = set()
    for texts in TEMPLATES.values():
        for text in texts:
            words = text.split()
            grams = {(a,) for a in words} | set(zip(words, words[1:]))
            gone = set()
            for word in sorted(set(words), key=lambda w: (common.get(w, 0), -len(w), w)):
                if sum(not gone & set(gram) for gram in grams) < SHARE * len(grams):
                    break
                gone.add(word)
            found |= gone
    return sorted(found)


def matrix(slots: list[list[int]]) -> np.ndarray:
    out = np.zeros((len(slots), SLOTS), np.float32)
    for row, found in zip(out, slots):
        row[found] = 1 / np.sqrt(max(len(found), 1))
    return out


def variants(rng: np.random.Generator, words: list[str], filler: list[str]) -> list[str]:
    """A template with a word lost at either end and other words around it."""
    out = [" ".join(words)]
    for _ in range(VARIANTS):
        low, high = rng.integers(0, 2), len(words) - rng.integers(0, 2)
        around = [
            list(rng.choice(filler, rng.integers(0, 12))) if rng.random() < 0.5 else []
            for _ in range(2)
        ]
        out.append(" ".join([*around[0], *words[low:high], *around[1]]))
    return out


def training_rows(docs: DataFrame) -> tuple[list[str], list[str], list[str]]:
    """Texts and families: variants of the templates and a bounded sample of the corpus; and the
    words to look for first."""
    rng = np.random.default_rng(7)
    chosen = F.broadcast(first_ids(docs, SAMPLE).distinct())
    few = docs.select("doc_id", "text").join(chosen, "doc_id")
    lines = few.select(F.explode(lines_of(F.col("text"))).alias("line")).filter(has_word(F.col("line")))
    lines = lines.filter(F.length("line") <= TAUGHT_CHARS)
    found = [row["line"] for row in lines.orderBy(F.xxhash64("line"), "line").limit(MOST_ROWS).collect()]
    common = Counter(word for text in found for word in text.lower().split())
    filler = sorted({word for text in [*found[:200], *NO_LICENCE] for word in text.lower().split()})
    texts, families = [], []
    for family, templates in TEMPLATES.items():
        for template in templates:
            made = variants(rng, template.split(), filler)
            texts, families = texts + made, families + [family] * len(made)
    others = [" ".join(rng.choice(filler, rng.integers(3, 60))) for _ in range(200)]
    spread = [text for sentence in NO_LICENCE for text in variants(rng, sentence.split(), filler)]
    others += found + spread
    return texts + others, families + [UNKNOWN] * len(others), needed_words(common)


def fitted(x: np.ndarray, y: np.ndarray, families: list[str], steps: int = 200) -> Model:
    """Full-batch Adam with a ridge; every fifth row chooses the temperature."""
    count = len(families)
    held = np.arange(len(y)) % 5 == 0
    share = np.bincount(y[~held], minlength=count).astype(float)
    weight = (1 / np.maximum(share, 1))[y[~held]]  # every family counts alike
    weight /= weight.sum()
    weight = weight.astype(np.float32)
    target = np.eye(count, dtype=np.float32)[y[~held]]
    train, parts = x[~held], [np.zeros((SLOTS, count), np.float32), np.zeros(count, np.float32)]
    first, second = ([np.zeros_like(part) for part in parts] for _ in range(2))
    for step in range(1, steps + 1):
        logits = train @ parts[0] + parts[1]
        chance = np.exp(logits - logits.max(1, keepdims=True))
        error = (chance / chance.sum(1, keepdims=True) - target) * weight[:, None]
        slopes = [train.T @ error + np.float32(1e-5) * parts[0], error.sum(0)]
        for part, m, v, slope in zip(parts, first, second, slopes):
            m += 0.1 * (slope - m)
            v += 0.01 * (slope**2 - v)
            part -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    logits = (x[held] @ parts[0] + parts[1]).astype(float)

    def loss(temperature: float) -> float:
        scaled = logits / temperature
        top = scaled.max(1)
        norm = top + np.log(np.exp(scaled - top[:, None]).sum(1))
        return float((norm - scaled[np.arange(len(scaled)), y[held]]).mean())

    temperature = min(np.exp(np.linspace(-1, 2, 61)), key=loss)
    return Model(families, parts[0].T.round(4), parts[1].round(4), float(temperature))


def train(docs: DataFrame) -> tuple[Model, dict[str, list[list[int]]], list[str]]:
    """The model, the grams of the templates, and the words to look for first."""
    spark = docs.sparkSession
    families = [*TEMPLATES, UNKNOWN]
    flat = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    templates: dict[str, list[list[int]]] = {family: [] for family in TEMPLATES}
    for (family, _), (_, grams) in zip(flat, numbered(spark, [text for _, text in flat])):
        templates[family].append(grams)
    texts, names, needed = training_rows(docs)
    rows = numbered(spark, texts)
    every = [set(found) for group in templates.values() for found in group]
    keep = [
        i for i, ((_, found), name) in enumerate(zip(rows, names))
        if name != UNKNOWN or all(len(t.intersection(found)) < SHARE * len(t) for t in every)
    ]
    x = matrix([rows[i][0] for i in keep])
    y = np.array([families.index(names[i]) for i in keep])
    return fitted(x, y, families), templates, needed


def scored(
    paragraphs: DataFrame, model: Model, templates: dict[str, list[list[int]]],
    required: list[list[list[int]]], denied: list[int],
) -> DataFrame:
    """The paragraphs that some family may win, with ``family, probability, template``."""
    rows, kept = paragraphs, [name for name in paragraphs.columns if name != "_words"]
    root = F.sqrt(F.size("_slots").cast("double"))
    gain = (model.weights[:-1] - model.weights[-1]).max(0)
    reach = float((model.bias[:-1] - model.bias[-1]).max())
    rows = once(with_slots(rows), "_bound", total(gain))
    rows = rows.filter(F.col("_bound") / root + F.lit(reach) > -1e-3)
    logits = [
        ((total(w) / root + F.lit(float(b))) / F.lit(model.temperature)).alias(f"_{i}")
        for i, (w, b) in enumerate(zip(model.weights, model.bias))
    ]
    rows = once(rows, "_logits", F.struct(*logits)).select("*", "_logits.*")
    names = [f"_{i}" for i in range(len(model.families))]
    best = F.greatest(*[F.struct(F.col(n).alias("v"), F.lit(f).alias("f")) for n, f in zip(names, model.families)])
    rows = rows.withColumn("_best", best)
    mass = sum((F.exp(F.col(n) - F.col("_best.v")) for n in names), F.lit(0.0))
    def literal(values: list) -> Column:  # folded once; indexed by the family's number
        return F.from_json(F.lit(json.dumps(values)), "array<array<array<long>>>")

    def share(found: Column) -> Column:
        return F.size(F.array_intersect("_grams", found)) / F.size(found).cast("double")

    place = F.array_position(F.split(F.lit(" ".join(model.families)), " "), F.col("_best.f")).cast("int")
    shares = F.array_max(F.transform(F.element_at(literal([*templates.values(), []]), place), share))
    told = F.forall(
        F.element_at(literal([*required, []]), place), lambda group: F.arrays_overlap("_grams", group)
    )
    taken_back = F.arrays_overlap("_grams", F.from_json(F.lit(json.dumps(denied)), "array<long>"))
    match = F.when(told & ~taken_back, shares).otherwise(F.lit(0.0))
    return rows.select(
        *kept, F.col("_best.f").alias("family"),
        F.round(F.lit(1.0) / mass, 6).alias("probability"), match.alias("template"),
    ).filter(F.col("family") != UNKNOWN)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: its paragraphs, its licence families, and every prediction."""
    docs = told_apart(docs.select("doc_id", "text"), "_copy")
    docs = docs.withColumn("_row", F.struct("doc_id", "_copy"))
    model, templates, needed = train(docs)
    required, denied = required_grams(docs.sparkSession), denied_grams(docs.sparkSession)
    found = scored(paragraphs_of(docs, needed), model, templates, required, denied).withColumn(
        "confirmed", (F.col("probability") >= CERTAIN) & (F.col("template") >= SHARE)
    ).filter("line = last or confirmed")
    fields = ["line", "last", "family", "probability", "template", "confirmed"]
    found = stored(found.select("_row", F.struct(*fields).alias("hit")), "paragraphs")
    hits = found.groupBy("_row").agg(F.array_sort(F.collect_list("hit")).alias("predictions"))
    none = F.array().cast(hits.schema["predictions"].dataType)
    sure = F.filter("predictions", lambda hit: hit["confirmed"])
    families = F.transform(sure, lambda hit: hit["family"])
    named = F.filter(
        families, lambda family: (family != "bsd") | ~F.array_contains(families, "bsd-3-clause")
    )

    def bsd(family: Column) -> Column:
        """A BSD text without the third clause anywhere is the text of two clauses."""
        return F.when(family == "bsd", "bsd-2-clause").otherwise(family)

    def narrowest(hits: Column) -> Column:
        def inside(hit, other):
            return (
                other["confirmed"] & (other["family"] == hit["family"])
                & (other["line"] >= hit["line"]) & (other["last"] <= hit["last"])
                & (other["last"] - other["line"] < hit["last"] - hit["line"])
            )

        return F.filter(
            hits, lambda hit: (hit["line"] == hit["last"]) | ~F.exists(hits, lambda other: inside(hit, other))
        )
    count = F.size(F.filter(lines_of(F.col("text")), has_word)).cast("long")
    counted = docs.select("_row", "doc_id", count.alias("n_paragraphs"))  # no text goes into the join
    return (
        counted.join(hits, "_row", "left")
        .select("doc_id", "n_paragraphs", F.coalesce("predictions", none).alias("predictions"))
        .select(
            "doc_id", "n_paragraphs",
            F.array_sort(F.array_distinct(F.transform(named, bsd))).alias("licenses"),
            narrowest(F.col("predictions")).alias("predictions"),
        )
    )


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
