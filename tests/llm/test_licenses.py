"""The license scan against the notices planted in the table, and awkward rows."""

import os
import time

from pyspark.sql import functions as F

from snaptrack.llm import licenses
from tests.llm.cases import documents
from tests.llm.test_packing import ODD

SF_DIR = os.environ.get("LLM_MODEL_SF_DIR", "/root/testdata/sf0.01")
NOTICES = {
    "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
    "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
    "Released under the MIT License.": "mit",
    "All rights reserved.": "all-rights-reserved",
}


def test_whole_table(spark):
    found = {row["doc_id"]: row for row in licenses.op10(spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(found) == len(docs)
    for doc in docs:
        lines = (doc["text"] or "").split("\n")
        expected = sorted({family for notice, family in NOTICES.items() if notice in lines})
        assert found[doc["doc_id"]]["licenses"] == expected
        assert found[doc["doc_id"]]["n_paragraphs"] == sum(bool(line.strip(" \t\x0b\x0c\r")) for line in lines)


def test_variants_unknown_and_odd_rows(spark):
    texts = [
        "Some words.\nPermission is hereby granted, free of charge, to any person obtaining a copy "
        "of this software and associated documentation files (the \"Software\")",
        "My driving license was lost near the river", *NOTICES, *ODD, "licensed " * 3000,
    ]
    rows = {row["doc_id"]: row for row in licenses.scan(documents(spark, texts)).collect()}
    assert rows[0]["licenses"] == ["mit"] and rows[0]["predictions"][0]["line"] == 1
    assert rows[1]["licenses"] == []
    for i, family in enumerate(NOTICES.values(), 2):
        assert rows[i]["licenses"] == [family]
    assert all(rows[i]["licenses"] == [] for i in range(7, len(texts)))


def test_empty_repeated_null_and_clashing(spark):
    assert licenses.scan(documents(spark, [])).collect() == []
    rows = documents(spark, ["All rights reserved."] * 3).selectExpr(
        "cast(null as long) as doc_id", "text", "1 as line", "2 as family", "3 as n", "4 as hit"
    )
    found = licenses.scan(rows).collect()
    assert [r["n_paragraphs"] for r in found] == [1, 1, 1]
    assert all(r["licenses"] == ["all-rights-reserved"] for r in found)


def test_rows_of_one_id_are_told_apart(spark):
    """A third of the rows under one id and a third under none: each keeps its own predictions."""
    texts = ["All rights reserved.", "Nothing here.", "Released under the MIT License."] * 20
    rows = spark.createDataFrame([([None, 7, i][i % 3], t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = licenses.scan(rows).collect()
    named = sorted((r["doc_id"] is None, r["licenses"]) for r in found)
    assert named == sorted([(True, ["all-rights-reserved"]), (False, []), (False, ["mit"])] * 20)


def test_the_result_can_be_filtered_joined_and_sorted(spark):
    """The plan of a filter does not grow: what is filtered are written tables."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = licenses.scan(docs)
    begin = time.monotonic()
    few = found.filter("doc_id < 300").join(docs.select("doc_id", "lang"), "doc_id").orderBy("doc_id")
    rows = few.filter(F.size("licenses") > 0).collect()
    assert time.monotonic() - begin < 30 and rows
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 50_000


def test_notices_at_any_number_of_words_a_line(spark):
    notices = {
        "bsd-2-clause": "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files",
        "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License.",
    }
    texts, expected = [], []
    for family, notice in notices.items():
        words = notice.split()
        for wide in (1, 2, 3, 4, 5, 9):
            lines = [" ".join(words[i : i + wide]) for i in range(0, len(words), wide)]
            texts.append("\n".join(["first words", "of a file", *lines, "and the rest", "of the block"]))
            expected.append([family])
    rows = {row["doc_id"]: row for row in licenses.scan(documents(spark, texts)).collect()}
    assert [rows[i]["licenses"] for i in range(len(texts))] == expected


def test_the_widest_window_holds_every_template():
    longest = max(len(text.split()) for texts in licenses.TEMPLATES.values() for text in texts)
    assert longest <= max(licenses.TARGETS)


def test_plan_is_native(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


WRAPPED = {
    "bsd-3-clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

 * Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

 * Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.""",
    "gpl-3.0": """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.""",
    "apache-2.0": """// Licensed under the Apache License,
// Version 2.0 (the "License");
// you may not use this file except in
// compliance with the License.""",
    "mit": """Permission is hereby granted, free of charge, to any
person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in
the Software without restriction""",
}


def test_notices_wrapped_over_lines(spark):
    texts = [f"A title\n\n{text}\nmore text of the file" for text in WRAPPED.values()]
    parted = WRAPPED["bsd-3-clause"].split("\n")[:2]
    texts.append("\n\n".join(parted))  # two blocks
    rows = {row["doc_id"]: row for row in licenses.scan(documents(spark, texts)).collect()}
    for i, family in enumerate(WRAPPED):
        assert rows[i]["licenses"] == [family]
        assert all(hit["confirmed"] for hit in rows[i]["predictions"] if hit["last"] > hit["line"])
    first = [hit for hit in rows[0]["predictions"] if hit["confirmed"]][0]
    assert (first["line"], first["last"]) == (2, 3)
    assert rows[4]["licenses"] == []


FREE = (
    "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} License "
    "as published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version."
)
CREATIVE = "This work is licensed under a Creative Commons {} 4.0 International License."
OTHERS = {
    FREE.format("program", "Lesser General Public", "3"): ["lgpl-3.0"],
    FREE.format("library", "Lesser General Public", "2.1"): ["lgpl-2.1"],
    FREE.format("program", "Affero General Public", "3"): ["agpl-3.0"],
    FREE.format("program", "General Public", "2"): ["gpl-2.0"],
    FREE.format("program", "General Public", "3"): ["gpl-3.0"],
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
    "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.": ["mpl-2.0"],
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.": ["isc"],
    "Licensed under the BSD 2-Clause License": ["bsd-2-clause"],
    "Redistribution and use in source and binary forms, with or without modification,\nare permitted provided that the "
    "following conditions are met:\n\n1. Redistributions of source code must retain the notice.": ["bsd-2-clause"],
    "Licensed under the BSD 3-Clause License": ["bsd-3-clause"],
    CREATIVE.format("Attribution"): ["cc-by-4.0"],
    CREATIVE.format("Attribution-ShareAlike"): ["cc-by-sa-4.0"],
    CREATIVE.format("Attribution-NonCommercial"): ["cc-by-nc-4.0"],
    CREATIVE.format("Attribution-NoDerivatives"): ["cc-by-nd-4.0"],
    CREATIVE.format("Attribution-NonCommercial-ShareAlike"): ["cc-by-nc-sa-4.0"],
    CREATIVE.format("Attribution-NonCommercial-NoDerivatives"): ["cc-by-nc-nd-4.0"],
    "Licensed under CC BY-SA 4.0.": ["cc-by-sa-4.0"],
    "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this "
    "work under CC0 1.0 Universal.": ["cc0-1.0"],
    "Distributed under the Boost Software License, Version 1.0.": ["bsl-1.0"],
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
    "which is available at https://www.eclipse.org/legal/epl-2.0/": ["epl-2.0"],
    "Licensed under the EUPL, Version 1.2 only": ["eupl-1.2"],
    "This is free and unencumbered software released into the public domain.": ["unlicense"],
    "// SPDX-License-Identifier: Apache-2.0": ["apache-2.0"],
    "# SPDX-License-Identifier: MIT": ["mit"],
    "/* SPDX-License-Identifier: GPL-2.0-or-later */": ["gpl-2.0"],
    "SPDX-License-Identifier: LGPL-2.1-only": ["lgpl-2.1"],
    "SPDX-License-Identifier: BSD-3-Clause": ["bsd-3-clause"],
    "SPDX-License-Identifier: CC-BY-SA-4.0": ["cc-by-sa-4.0"],
    "SPDX-License-Identifier: EPL-2.0": ["epl-2.0"],
    # what is not granted
    "This file is NOT licensed under the MIT license.": [],
    "The tool is no longer released under the MIT License.": [],
    "The second part was never licensed under the Apache License, Version 2.0.": [],
    "SPDX-License-Identifier: LicenseRef-Proprietary": [],
    # the likes of families that are not listed
    "You should have received a copy of the GNU General Public License along with this program.": [],
    FREE.format("program", "Lesser General Public", "9"): [],
    "This work is licensed under a Creative Commons Attribution 3.0 International License.": [],
}


def test_families_that_differ_by_a_word(spark):
    rows = {row["doc_id"]: row for row in licenses.scan(documents(spark, list(OTHERS))).collect()}
    assert {text: rows[i]["licenses"] for i, text in enumerate(OTHERS)} == OTHERS


def test_every_template_passes_its_own_test():
    for family, texts in licenses.TEMPLATES.items():
        words = [text.split() for text in texts]
        grams = [{*w, *(" ".join(p) for p in zip(w, w[1:]))} for w in words]
        groups = licenses.REQUIRED.get(family, ())
        assert any(all(g & set(group) for group in groups) for g in grams)
