"""License scans: MinHash bands over overlapping text windows, then exact shingle containment.

Templates of similar length share a class. A class cuts a text's shingles into blocks as long as its
longest template and takes windows of two neighbouring blocks, so every occurrence lies whole in
one. A window retrieves the templates that agree with it in at least one band (one minimum a band).
A template of which the stated share stands in a window collides in a band with the probability of
their Jaccard similarity, whose smallest value follows from the lengths; the number of bands makes
the chance of no collision at most MISS. Retrieved pairs are verified on the shingles themselves.

Nothing is shuffled: the templates, a list of the caller's, are small and checked to be.
"""

from __future__ import annotations

import bisect
import dataclasses
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.decontaminate import CHUNK, Hasher, shingle_hashes, tokens
from cohortloom.llm.text import utf8

#: Chance that a window with a template's share agrees with it in no band.
MISS = 1e-5
#: Shingles of a block at least.
BLOCK = 4
#: Words of all templates together, at most: the bound of what is broadcast.
MOST_WORDS = 2_000_000

#: Notices by which texts state their licence, and passages of the licences' own texts.
#: Licences that share most of their words are told apart by passages in which no other licence of the list has
#: four fifths of the shingles: at most 18 shingles with the telling word four words from either end, or at most
#: 4, of which all are needed. `BSD` and `GPL` name the family, of which a text may state the variant elsewhere.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "under the GNU General Public License, version 3."),
    ("GPL", "redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS"),
    ("Artistic-2.0", "The Artistic License 2.0 Copyright (c) 2000"),
    ("BSD-2-Clause", "the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE"),
    ("BSD-3-Clause", "the documentation and/or other materials provided with the distribution. 3. Neither the name of"),
    ("BSD-3-Clause", "the documentation and/or other materials provided with the distribution. Neither the name of"),
    ("BSD-4-Clause", "All advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("0BSD", "for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS"),
    ("ISC", "with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("CC0-1.0", "hereby overtly, fully, permanently, irrevocably and unconditionally waives, abandons, and surrenders all of Affirmer s Copyright and Related Rights"),
    ("CC0-1.0", "has waived all copyright and related or neighboring rights to this work"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-ND-4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-SA-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International"),
    ("EPL-1.0", "Eclipse Public License - v 1.0 THE ACCOMPANYING PROGRAM"),
    ("EPL-2.0", "Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM"),
    ("EPL-2.0", "under the terms of the Eclipse Public License 2.0"),
    ("EPL-2.0", "the terms of the Eclipse Public License v. 2.0 which is available at"),
    ("GPL-1.0", "GNU GENERAL PUBLIC LICENSE Version 1, February"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June"),
    ("GPL-2.0", "under the GNU General Public License, version 2."),
    ("GPL-2.0", "the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License"),
    ("GPL-2.0", "the terms of the GNU General Public License version 2 as published by the Free Software Foundation"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19"),
    ("AGPL-3.0", "licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-2.0", "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June"),
    ("LGPL-2.1", "LESSER GENERAL PUBLIC LICENSE Version 2.1, February"),
    ("LGPL-2.1", "licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29"),
    ("LGPL-3.0", "the GNU Lesser General Public License, version 3."),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may"),
    ("MPL-1.1", "Mozilla Public License Version 1.1 1. Definitions"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL"),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary"),
    ("Zlib", "In no event will the authors be held liable for any damages arising from the use of this software"),
] + [
    (name, f"terms of the GNU {kind} as published by the Free Software Foundation; either version {version} of the License, or")
    for name, kind, version in (
        ("AGPL-3.0", "Affero General Public License", "3"),
        ("GPL-2.0", "General Public License", "2"),
        ("GPL-3.0", "General Public License", "3"),
        ("LGPL-2.0", "Library General Public License", "2"),
        ("LGPL-2.1", "Lesser General Public License", "2.1"),
        ("LGPL-3.0", "Lesser General Public License", "3"),
    )
]


@dataclasses.dataclass
class Class:
    """Templates of one shingle size whose shingle numbers round up to `block`."""

    size: int
    block: int
    templates: list[int]
    shingles: list[np.ndarray]
    factors: np.ndarray
    #: Sorted minima of all templates and bands, with the template of each.
    minima: np.ndarray
    owner: np.ndarray


def bands_for(shingles: int, block: int, share: float) -> int:
    """Bands that a template of so many shingles needs in windows of two blocks."""
    common = math.ceil(share * shingles)
    similar = common / (2 * block + shingles - common)
    return 1 if similar >= 1 else math.ceil(math.log(MISS) / math.log(1 - similar))


def compile_templates(templates: list[tuple[str, str]], shingle: int, share: float) -> list[Class]:
    """Classes of the templates; one of fewer words than a shingle is one shorter shingle, one without words is none."""
    hasher = Hasher()
    groups: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
    total = 0
    for at, (_, text) in enumerate(templates):
        words = tokens(text.encode("utf-8", "replace"))
        total += len(words)
        if words:
            size = min(shingle, len(words))
            found = np.unique(shingle_hashes(hasher(words), size))
            block = max(BLOCK, 1 << (len(words) - size).bit_length())
            groups.setdefault((size, block), []).append((at, found))
    if total > MOST_WORDS:
        raise ValueError(f"the templates have {total} words; {MOST_WORDS} may be broadcast, so scan in several runs")
    rng = np.random.default_rng(20)
    out = []
    for (size, block), members in sorted(groups.items()):
        bands = max(bands_for(len(s), block, share) for _, s in members)
        factors = rng.integers(1, 1 << 63, bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        minima = np.array([[(s * f).min() for f in factors] for _, s in members], np.uint64)
        # A band's number goes into the key, so that only equal bands meet.
        keys = (minima ^ _band_marks(bands)).ravel()
        order = np.argsort(keys, kind="stable")
        owner = np.repeat(np.arange(len(members)), bands)[order]
        out.append(Class(size, block, [a for a, _ in members], [s for _, s in members], factors, keys[order], owner))
    return out


def _band_marks(bands: int) -> np.ndarray:
    return np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def retrieve(cls: Class, hashes: np.ndarray, inside: np.ndarray) -> set[tuple[int, int]]:
    """(first shingle of a window, member of the class) of all windows and templates that agree in a band.

    Shingles that are not `inside` a text count for no minimum.
    """
    n, block = len(hashes), cls.block
    starts = np.arange(0, n, block)
    marks = _band_marks(len(cls.factors))
    found: set[tuple[int, int]] = set()
    for factor, mark in zip(cls.factors, marks, strict=True):
        low = np.minimum.reduceat(np.where(inside, hashes * factor, np.uint64(0xFFFFFFFFFFFFFFFF)), starts)
        low[:-1] = np.minimum(low[:-1], low[1:])
        keys = low ^ mark
        at = np.searchsorted(cls.minima, keys)
        for w in np.flatnonzero(cls.minima[np.minimum(at, len(cls.minima) - 1)] == keys).tolist():
            k = int(at[w])
            while k < len(cls.minima) and cls.minima[k] == keys[w]:
                found.add((int(starts[w]), int(cls.owner[k])))
                k += 1
    return found


def occurrences(hashes: np.ndarray, places: list[int], length: int, share: float) -> list[tuple[int, float]]:
    """(first shingle, containment) of stretches that begin at one of `places` and hold the share of a template.

    `places` are those of the template's shingles, `length` in number. The best stretch comes first,
    of equally good ones the earliest; a later one may not overlap it.
    """
    tried, last, held = [], 0, {}
    for k, p in enumerate(places):
        while last < len(places) and places[last] < p + length:
            h = int(hashes[places[last]])
            held[h] = held.get(h, 0) + 1
            last += 1
        have = sum(1 for n in held.values() if n)
        if have >= math.ceil(share * length):
            tried.append((-have / length, p))
        held[int(hashes[places[k]])] -= 1
    taken: list[int] = []
    out: list[tuple[int, float]] = []
    for score, p in sorted(tried):
        at = bisect.bisect(taken, p)
        if (at == 0 or p - taken[at - 1] >= length) and (at == len(taken) or taken[at] - p >= length):
            taken.insert(at, p)
            out.append((p, -score))
    return out


def scan(
    docs: DataFrame, templates: list[tuple[str, str]] | None = None, doc_id: str = "doc_id", text: str = "text",
    shingle: int = 5, share: float = 0.8,
) -> DataFrame:
    """A row per document: doc_id, n_words, hits (license, start, end, containment), by start.

    start and end count words (runs of letters and digits in any case); containment is the share of
    the template's distinct shingles. A null or empty text has no hits; repeated rows are scanned one
    by one; no templates find nothing. Other columns are not read.
    """
    templates = TEMPLATES if templates is None else templates
    classes = compile_templates(templates, shingle, share)
    names = [n for n, _ in templates]
    shared = docs.sparkSession.sparkContext.broadcast(classes)  # MOST_WORDS bounds it

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            texts, at, held, total = utf8(batch.column(1)), 0, [], 0
            for i, t in enumerate(texts):
                held.append(tokens(t))
                total += len(held[-1])
                if total < CHUNK and i + 1 < len(texts):
                    continue
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, i + 1 - at), pa.array([len(w) for w in held], pa.int64()), pa.array(hits(held, hasher), KIND)],
                    ["doc_id", "n_words", "hits"],
                )
                at, held, total = i + 1, [], 0

    def hits(held: list[list[bytes]], hasher: Hasher) -> list[list[dict]]:
        sizes = [len(w) for w in held]
        words = hasher([w for ws in held for w in ws])
        ends = np.cumsum(sizes)
        out: list[list[dict]] = [[] for _ in held]
        for cls in shared.value:
            hashes = shingle_hashes(words, cls.size)
            # Over all texts of the chunk at once: a shingle that reaches into the next text is taken out below.
            limit = np.repeat(ends, sizes)[: len(hashes)]
            inside = np.arange(len(hashes)) + cls.size <= limit
            windows: dict[int, list[int]] = {}
            for first, member in retrieve(cls, hashes, inside) if len(hashes) else ():
                windows.setdefault(member, []).append(first)
            for member, firsts in windows.items():
                template = cls.shingles[member]
                spots = np.unique(np.concatenate([np.arange(f, min(f + 2 * cls.block, len(hashes))) for f in firsts]))
                spots = spots[inside[spots] & np.isin(hashes[spots], template)]
                for p, containment in occurrences(hashes, spots.tolist(), len(template), share):
                    doc = int(np.searchsorted(ends, p, side="right"))
                    start = p - int(ends[doc] - sizes[doc])
                    end = min(start + len(template) + cls.size - 1, sizes[doc])
                    out[doc].append({"license": names[cls.templates[member]], "start": start, "end": end, "containment": containment})
        return [sorted(h, key=lambda x: (x["start"], x["license"], x["end"])) for h in out]

    kind = docs.select(F.col(doc_id)).schema[0].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        look, f"doc_id {kind}, n_words BIGINT, hits ARRAY<STRUCT<license: STRING, start: INT, end: INT, containment: DOUBLE>>"
    )


KIND = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("containment", pa.float64())]))
