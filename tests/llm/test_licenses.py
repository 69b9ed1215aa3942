"""License hits: spans, damaged notices and the chance of retrieval."""

import math
import os
import random

import pytest

from cohortloom.llm import licenses
from tests.llm import edges


def hits(spark, rows, templates=None):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(rows)], "doc_id INT, text STRING, hits STRING")
    return {r["doc_id"]: [tuple(h) for h in r["hits"]] for r in licenses.scan(df, templates).collect()}


def test_spans_and_repeats(spark):
    notice = "Licensed under the Apache License, Version 2.0."
    got = hits(spark, [f"before it {notice} between {notice.upper()} after", "licensed under the", None, "", notice])
    assert got[0] == [("Apache-2.0", 2, 10, 1.0), ("Apache-2.0", 11, 19, 1.0)]
    assert (got[1], got[2], got[3]) == ([], [], []) and got[4] == [("Apache-2.0", 0, 8, 1.0)]


def test_long_notice_with_damage(spark):
    name, text = licenses.TEMPLATES[1]
    words = text.split()
    one, many = list(words), list(words)
    one[0] = "changed"
    for i in range(0, len(words), 4):
        many[i] = "changed"
    got = hits(spark, [" ".join(one), " ".join(many)])
    assert [h[0] for h in got[0]] == [name] and got[0][0][3] < 1 and got[1] == []


def test_every_occurrence_is_retrieved(spark):
    """At any place of a long text, for templates of all lengths."""
    rng = random.Random(8)
    templates = [(f"t{n}", " ".join(f"w{n}x{i}" for i in range(n))) for n in (1, 3, 5, 6, 9, 17, 40, 150)]
    rows, want = [], []
    for k in range(300):
        name, text = templates[k % len(templates)]
        lead = rng.randrange(200)
        rows.append(edges.prose(rng, lead) + " " + text + " " + edges.prose(rng, rng.randrange(200)))
        want.append([(name, lead, lead + len(text.split()), 1.0)])
    got = hits(spark, rows, templates)
    assert [got[i] for i in range(len(rows))] == want


def test_no_templates(spark):
    assert hits(spark, ["a b c"], []) == {0: []}


GNU = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as published by "
    "the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
)
REDISTRIBUTION = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
DISCLAIMER = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."
NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products. "
FEE = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
ISC = ", provided that the above copyright notice and this permission notice appear in all copies. "
WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES."


def test_neighbouring_licences_are_told_apart(spark):
    want = {
        GNU.format(what="program", kind="General Public License", version="2"): {"GPL", "GPL-2.0"},
        GNU.format(what="program", kind="General Public License", version="3"): {"GPL", "GPL-3.0"},
        GNU.format(what="program", kind="Lesser General Public License", version="3"): {"LGPL-3.0"},
        GNU.format(what="library", kind="Lesser General Public License", version="2.1"): {"LGPL-2.1"},
        GNU.format(what="program", kind="Affero General Public License", version="3"): {"AGPL-3.0"},
        "This work is licensed under the GNU General Public License, version 2.": {"GPL-2.0"},
        "This work is licensed under the GNU General Public License, version 3.": {"GPL-3.0"},
        REDISTRIBUTION + DISCLAIMER: {"BSD", "BSD-2-Clause"},
        REDISTRIBUTION + NAMES + DISCLAIMER: {"BSD", "BSD-3-Clause"},
        FEE + ISC + WARRANTY: {"ISC"},
        FEE + ". " + WARRANTY: {"0BSD"},
    }
    got = hits(spark, list(want))
    assert [{h[0] for h in got[i]} for i in range(len(want))] == list(want.values())


def test_no_template_has_the_share_of_another_licence():
    shingles = []
    for name, text in licenses.TEMPLATES:
        words = licenses.tokens(text.encode())
        assert len(words) >= 5 and "'" not in text
        shingles.append((name, {tuple(words[i : i + 5]) for i in range(len(words) - 4)}))
    for name, mine in shingles:
        assert not [n for n, other in shingles if n != name and len(mine & other) >= math.ceil(0.8 * len(mine))]


@pytest.mark.parametrize("file, want", [
    ("Apache-2.0", {"Apache-2.0"}), ("CC0-1.0", {"CC0-1.0"}), ("GPL-1", {"GPL", "GPL-1.0"}), ("GPL-2", {"GPL", "GPL-2.0"}), ("GPL-3", {"GPL", "GPL-3.0"}),
    ("LGPL-2", {"LGPL-2.0"}), ("LGPL-2.1", {"LGPL-2.1"}), ("LGPL-3", {"LGPL-3.0"}), ("MPL-1.1", {"MPL-1.1"}), ("MPL-2.0", {"MPL-2.0"}), ("BSD", {"BSD", "BSD-3-Clause"}),
])
def test_whole_texts_and_damaged_copies(spark, file, want):
    path = f"/usr/share/common-licenses/{file}"
    if not os.path.exists(path):
        pytest.skip("no copy of the text here")
    with open(path, encoding="utf-8") as f:
        text = f.read()
    words = text.split()
    for i in range(60, len(words), 120):
        words[i] = "changed"
    got = hits(spark, [text, " ".join(words)])
    assert {h[0] for h in got[0]} == want and {h[0] for h in got[1]} <= want and got[1]
