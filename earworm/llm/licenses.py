"""License scans by patience alignment (operator 6).

A text's words are aligned with each license template: words that occur exactly
once on both sides are anchors, the longest increasing subsequence of the
anchors is kept, and the gaps between kept anchors are aligned in the same way;
a gap without anchors matches its common beginning and end.  The share of the
template's words that are matched is its coverage.

A long text is not aligned as one: only stretches that can reach the asked
coverage are, by the number of the template's telling words in them, which
bounds the coverage from above.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from earworm.llm.store import documents

WORD = re.compile(r"[^\W_]+")

# Public license notices.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied."),
    "Apache-2.0-text": (
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
        "REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms and conditions for use, "
        "reproduction, and distribution as defined by Sections 1 through 9 of this document."),
    "GPL": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "GPL-3.0-text": (
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone "
        "is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. "
        "Preamble The GNU General Public License is a free, copyleft license for software and other kinds of works."),
    "AGPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."),
    "LGPL-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version."),
    "LGPL-2.1-text": (
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, "
        "Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is "
        "not allowed. This is the first released version of the Lesser GPL. It also counts as the successor of the GNU "
        "Library Public License, version 2, hence the version number 2.1."),
    "LGPL": "This library is licensed under the GNU Lesser General Public License, version 2.1.",
    "BSD": "Licensed under the BSD 3-Clause License.",
    "BSD-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer."),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPL-2.0-text": (
        "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity "
        "that creates, contributes to the creation of, or owns Covered Software."),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    "Artistic-2.0-text": (
        "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not "
        "allowed. Preamble This license establishes the terms under which a given free software Package may be copied, "
        "modified, distributed, and/or redistributed. The intent is that the Copyright Holder maintains some artistic "
        "control over the development of that Package while still keeping the Package available as open source and free "
        "software."),
    "BSL-1.0-notice": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
        "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties "
        "to whom the Software is furnished to do so"),
    "Zlib-notice": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    "ISC-notice": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-NC": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA": "Licensed under CC BY-SA 4.0.",
    "CC-BY": "Licensed under CC BY 4.0.",
    "CC0": "Released under the CC0 1.0 Universal public domain dedication.",
    "CC0-1.0-text": (
        "CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES. DISTRIBUTION OF THIS DOCUMENT "
        "DOES NOT CREATE AN ATTORNEY-CLIENT RELATIONSHIP. CREATIVE COMMONS PROVIDES THIS INFORMATION ON AN \"AS-IS\" "
        "BASIS. CREATIVE COMMONS MAKES NO WARRANTIES REGARDING THE USE OF THIS DOCUMENT OR THE INFORMATION OR WORKS "
        "PROVIDED HEREUNDER, AND DISCLAIMS LIABILITY FOR DAMAGES RESULTING FROM THE USE OF THIS DOCUMENT OR THE "
        "INFORMATION OR WORKS PROVIDED HEREUNDER."),
    "All-rights": "Copyright. All rights reserved.",
}

# Words that tell nothing about a license.
PLAIN = frozenset("a all and any are as at be by can for from in is it may not of on or that the this to under with you".split())


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def increasing(values: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence (patience piles)."""
    tops, at, before = [], [], [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        if pile == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[pile], at[pile] = v, i
        before[i] = at[pile - 1] if pile else -1
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched places (in a, in b), increasing on both sides."""
    pairs, work = [], [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = [(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in place]
        kept = [anchors[k] for k in increasing([j for _, j in anchors])]
        pairs += kept
        if kept:
            edges = [(a0 - 1, b0 - 1), *kept, (a1, b1)]
            work += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(pairs)


class Template:
    """A template's words and what a stretch must hold to cover enough of it."""

    def __init__(self, name: str, text: str, coverage: float):
        self.name, self.words = name, words_of(text)
        self.telling = Counter(w for w in self.words if w not in PLAIN)
        self.place = {w: i for i, w in enumerate(self.words) if self.telling[w] == 1}
        self.allowed = int(len(self.words) * (1 - coverage) + 1e-9)  # words that may be missing
        self.needed = sum(self.telling.values()) - self.allowed
        if self.needed < 1:
            raise ValueError(f"template {name} has too few telling words")

    def possible(self, counts) -> bool:
        return sum(min(n, counts[w]) for w, n in self.telling.items() if w in counts) >= self.needed

    def stretches(self, words: list[str], places: dict[str, list[int]]):
        """Stretches of the text that may cover the template: around telling
        words that stand closer together than the template is long."""
        hits = sorted(i for w in self.telling for i in places.get(w, ()))
        reach = len(self.words)
        groups: list[list[int]] = []
        for i in hits:
            if groups and i - groups[-1][-1] <= reach:
                groups[-1].append(i)
            else:
                groups.append([i])
        for group in groups:
            if not self.possible(Counter(words[i] for i in group)):
                continue
            lo, hi = max(0, group[0] - reach), min(len(words), group[-1] + reach + 1)
            if hi - lo <= 4 * reach:
                yield lo, hi
            else:  # many notices in a row: overlapping windows, each notice whole in one
                for at in range(lo, hi, reach):
                    yield at, min(hi, at + 2 * reach)
            here = Counter(words[i] for i in group)
            if any(n > self.telling[w] for w, n in here.items()):
                # perhaps more notices than one, whose words are no anchors when
                # aligned together: windows from where a word says one starts
                starts = {max(lo, i - self.place[words[i]]) for i in group if words[i] in self.place}
                ends = {(at, min(hi, at + n)) for at in starts for n in (reach, reach + self.allowed, 2 * reach)}
                for at, end in sorted(ends):
                    if self.possible(Counter(words[at:end])):
                        yield at, end


def apart(hits: list[tuple], order) -> list[tuple]:
    """Hits that do not overlap, the first by ``order`` before others; by start."""
    kept: list[tuple] = []
    for hit in sorted(hits, key=order):
        at = bisect_left(kept, hit[1], key=lambda h: h[1])
        if (at == 0 or kept[at - 1][2] <= hit[1]) and (at == len(kept) or hit[2] <= kept[at][1]):
            kept.insert(at, hit)
    return kept


def scan(text: str, templates: list[Template], vocabulary: frozenset[str], coverage: float) -> list[tuple]:
    """(name, start, end, coverage) of each license found, in text order; spans
    in code points.  Of finds that overlap, the one with most words matched
    stays."""
    found = list(WORD.finditer(text))
    words = [m[0].lower() for m in found]
    counts = Counter(words) if vocabulary & set(words) else Counter()
    out = []
    likely = [t for t in templates if t.possible(counts)]
    if not likely:
        return out
    places: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        if w in vocabulary:
            places.setdefault(w, []).append(i)
    for t in likely:
        best: list[tuple] = []
        for lo, hi in t.stretches(words, places):
            pairs = align(words[lo:hi], t.words)
            share = len(pairs) / len(t.words)
            first, last = (lo + pairs[0][0], lo + pairs[-1][0]) if pairs else (lo, lo)
            # words that lie further apart are not one notice
            if share >= coverage and last - first < 2 * len(t.words):
                best.append((t.name, found[first].start(), found[last].end(), share, len(pairs)))
        # of one notice in several windows: most words matched, then closest together
        out += apart(best, lambda h: (-h[4], h[2] - h[1], h[1]))
    # one notice, several templates: the one with most words matched, then covered
    return [hit[:4] for hit in apart(out, lambda h: (-h[4], -h[3], h[1], h[0]))]


def license_spans(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = 0.8,
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_licenses, licenses, spans) of every row: distinct names in
    text order, and name:start:end:coverage of each find, comma-joined.

    A map without shuffle.  Null and empty texts: none.  Null ids and repeated
    rows pass through; other columns are not read.
    """
    texts = dict(templates or TEMPLATES)

    def find(batches):
        made = [Template(name, t, coverage) for name, t in texts.items()]
        vocabulary = frozenset(w for t in made for w in t.telling)
        for batch in batches:
            hits = [scan(t or "", made, vocabulary, coverage) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(h) for h in hits], pa.int64()),
                 pa.array([",".join(dict.fromkeys(x[0] for x in h)) for h in hits], pa.string()),
                 pa.array([",".join(f"{n}:{a}:{b}:{c:.3f}" for n, a, b, c in h) for h in hits], pa.string())],
                names=["doc_id", "n_licenses", "licenses", "spans"])

    return docs.select(docs[doc_id].cast("bigint"), docs[text].cast("string")).mapInArrow(
        find, "doc_id bigint, n_licenses bigint, licenses string, spans string")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents at a coverage of 0.8."""
    return license_spans(documents(spark, sf_dir))
