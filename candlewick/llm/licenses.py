"""License scans by conditional compression.

Lines that speak of licensing, and what stands between near ones, form candidate blocks.  Wordings are
sought in a block and as many words around it as a wording can span; a block grows to the lines of the
wordings that it has.  It is compressed alone and with each license's wordings as a zstandard raw
dictionary; the size reductions order the licenses.  All of them are sought by wording: the words of a
known wording that the text lacks, and the words that it has instead, must not change which license it is.
A block has every license that is confirmed in it.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts, read, whole_text

# Per license the lines that files commonly name it by, its SPDX tag, and the notice that its publisher words.
WORDINGS = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) "
        "any later version.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
}

KEYWORDS = r"(?i)licen[sc]e|copyright|spdx|redistribut|permission[ \t\r\n]+is[ \t\r\n]+hereby|public[ \t\r\n]+domain"
#: Lines without a keyword that may stand between lines of one block.
GAP = 2
LOST = 1 << 20  # more words than any text part has
LEVEL = 9
#: Share of a wording's words that a block must have, and words that never may differ.
MIN_WORDS_SHARE = 0.9
_TELLING = re.compile(
    r"\d|^(?:mit|apache|bsd|gnu|gpl|lgpl|lesser|affero|mozilla|mpl|cc|by|nc|sa|nd|noncommercial|sharealike|noderivatives|no|not|without|only)$"
)
_KEYWORD, _WORD = re.compile(KEYWORDS), re.compile(r"[^\W_]+(?:\.[0-9]+)*")


def spans(lines: list[str]) -> list[tuple[int, int]]:
    """(first, last line) of the candidate blocks."""
    out: list[tuple[int, int]] = []
    for i in sorted({i for begin, end in _keywords(lines) for i in range(begin, end + 1)}):
        if out and i - out[-1][1] <= GAP + 1:
            out[-1] = (out[-1][0], i)
        else:
            out.append((i, i))
    return out


def _keywords(lines: list[str]) -> list[tuple[int, int]]:
    """(first, last line) of each keyword; one of several words may be wrapped."""
    begins = [0, *accumulate(len(line) + 1 for line in lines)]
    found = [(m.start(), m.end() - 1) for m in _KEYWORD.finditer("\n".join(lines))]
    return [(bisect_right(begins, a) - 1, bisect_right(begins, b) - 1) for a, b in found]


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Wording:
    """The words of a wording, and where a text has them.

    An occurrence has all words but few, in order, and few others between them; none of either may be
    a telling word.  By dynamic programming over the text's words: the fewest words that stand between
    (LOST if it can't be), by words of the wording passed and how many of these are missing.
    """

    def __init__(self, text: str):
        self.words = words(text)
        n = len(self.words)
        self.may_miss, self.may_add = int((1 - MIN_WORDS_SHARE) * n + 1e-9), n // 4
        self.telling = np.array([bool(_TELLING.search(w)) for w in self.words])
        self.needed = {w for w in self.words if _TELLING.search(w)}
        self.at: dict[str, np.ndarray] = {w: np.array([v == w for v in self.words]) for w in set(self.words)}
        self.none = np.zeros(n, bool)

    @property
    def reach(self) -> int:
        """Words that an occurrence spans at most."""
        return len(self.words) + self.may_add

    def _rows(self, block: list[str]) -> Iterator[np.ndarray]:
        n, missing = len(self.words), self.may_miss
        start = np.full((missing + 1, n + 1), LOST, np.int32)
        start[0, 0] = 0
        last = start
        for word in block:
            row = start.copy()
            row[:, 1:] = np.where(self.at.get(word, self.none), last[:, :-1], LOST)
            if not _TELLING.search(word):
                row[:, 1:n] = np.minimum(row[:, 1:n], last[:, 1:n] + 1)
            for m in range(missing):
                row[m + 1, 1:] = np.minimum(row[m + 1, 1:], np.where(self.telling, LOST, row[m, :-1]))
            yield row
            last = row

    def occurrences(self, block: list[str]) -> list[tuple[int, int, list[str], list[str]]]:
        """(first word, after the last, words that the block lacks, words that it has between) of the
        occurrences that don't overlap, those with fewer differences first."""
        have = Counter(block)
        if any(w not in have for w in self.needed):
            return []
        if sum((Counter(self.words) - have).values()) > self.may_miss:
            return []
        ends = []
        for end, row in enumerate(self._rows(block), 1):
            cost = [(int(added) + m, m) for m, added in enumerate(row[:, -1]) if added <= self.may_add]
            if cost and block[end - 1] in self.at:
                ends.append((*min(cost), end))
        out, taken = [], np.zeros(len(block), bool)
        for cost, m, end in sorted(ends):
            begin, lacking, between = self._traced(block, end, m, cost - m)
            if not taken[begin:end].any():
                taken[begin:end] = True
                out.append((begin, end, lacking, between))
        return out

    def _traced(self, block: list[str], end: int, m: int, added: int) -> tuple[int, list[str], list[str]]:
        first = max(0, end - self.reach)
        part = block[first:end]
        rows = [None, *self._rows(part)]
        i, j, lacking, between = len(self.words), len(part), [], []
        while i:
            row, before = rows[j], rows[j - 1]
            free = 0 if i == 1 and m == 0 else LOST
            if self.words[i - 1] == part[j - 1] and added == (before[m, i - 1] if before is not None else free):
                i, j, begin = i - 1, j - 1, j - 1
            elif m and not self.telling[i - 1] and added == row[m - 1, i - 1]:
                i, m = i - 1, m - 1
                lacking.append(self.words[i])
            else:
                added, j = added - 1, j - 1
                between.append(part[j])
        return first + begin, lacking[::-1], between[::-1]


@lru_cache(1)
def known() -> dict[str, list[Wording]]:
    return {name: [Wording(w) for w in own] for name, own in WORDINGS.items()}


@lru_cache(1)
def reach() -> int:
    """Words that an occurrence of any wording spans at most."""
    return max(w.reach for own in known().values() for w in own)


def regions(text: str) -> list[tuple[int, str, tuple[tuple[int, int], ...]]]:
    """(first line, lines, blocks as (first, last line) in them): blocks that one occurrence could
    span, with the lines around them that it could reach into."""
    lines = text.split("\n")
    sizes = [0, *accumulate(len(words(line)) for line in lines)] if _KEYWORD.search(text) else []
    groups: list[list[tuple[int, int]]] = []
    for a, b in spans(lines) if sizes else []:
        if groups and sizes[a] - sizes[groups[-1][-1][1] + 1] < reach():
            groups[-1].append((a, b))
        else:
            groups.append([(a, b)])
    out = []
    for own in groups:
        first = bisect_right(sizes, max(0, sizes[own[0][0]] - reach())) - 1
        first = min(first, own[0][0])
        last = max(own[-1][1], bisect_left(sizes, min(sizes[-1], sizes[own[-1][1] + 1] + reach())) - 1)
        out.append((first, "\n".join(lines[first : last + 1]), tuple((a - first, b - first) for a, b in own)))
    return out


class Scanner:
    def __init__(self):
        import zstandard

        self.plain = zstandard.ZstdCompressor(level=LEVEL)
        self.given = {}
        for name, wordings in WORDINGS.items():
            known = zstandard.ZstdCompressionDict("\n".join(wordings).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.given[name] = zstandard.ZstdCompressor(level=LEVEL, dict_data=known)
        self.scan = lru_cache(20_000)(self._scan)

    def reductions(self, block: str) -> list[tuple[float, str]]:
        """(share of the compressed size that a license's wordings save, license), best first."""
        data = block.encode("utf-8", "surrogatepass")
        alone = len(self.plain.compress(data))
        sizes = {name: len(c.compress(data)) for name, c in self.given.items()}
        return sorted(((1 - n / alone, name) for name, n in sizes.items()), key=lambda x: (-x[0], x[1]))

    def _scan(self, region: str, own: tuple[tuple[int, int], ...]) -> list[tuple]:
        """(line, license or None, best by size, reduction, missing, added) of a region's blocks."""
        lines = region.split("\n")
        line_of = [i for i, line in enumerate(lines) for _ in words(line)]
        text = [w for line in lines for w in words(line)]
        found = []
        for name, wordings in known().items():
            for begin, end, missing, added in (o for w in wordings for o in w.occurrences(text)):
                a, b = line_of[begin], line_of[end - 1]
                if any(a <= last and first <= b for first, last in own):
                    found.append((a, b, name, missing, added))
        merged: list[tuple[int, int]] = []
        for a, b in sorted([*own, *(f[:2] for f in found)]):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        out = []
        for a, b in merged:
            ranked = self.reductions("\n".join(lines[a : b + 1]))
            best: dict[str, tuple] = {}
            for f in found:
                if a <= f[0] <= b:
                    best[f[2]] = min(best.get(f[2], f), f, key=lambda x: (len(x[3]) + len(x[4]), x[3], x[4]))
            passed = [(a, name, ranked[0][1], r, *best[name][3:]) for r, name in ranked if name in best]
            out += passed or [(a, None, ranked[0][1], ranked[0][0], [], [])]
        return out


def differences(wording: list[str], block: list[str]) -> tuple[list[str], list[str]]:
    """(words of the wording that the block lacks, words that stand in the block instead or between)."""
    missing, added = [], []
    matcher = SequenceMatcher(None, wording, block, autojunk=False)
    found = [m for m in matcher.get_matching_blocks() if m.size]
    first, last = (found[0].b, found[-1].b + found[-1].size) if found else (0, 0)
    for tag, a, b, c, d in matcher.get_opcodes():
        if tag != "equal":
            missing += wording[a:b]
            added += [block[k] for k in range(c, d) if first <= k < last]
    return missing, added


def is_wording(wording: list[str], block: list[str]) -> tuple[bool, list[str], list[str]]:
    missing, added = differences(wording, block)
    same = len(missing) <= (1 - MIN_WORDS_SHARE) * len(wording) and len(added) <= len(wording) // 4
    return same and not any(map(_TELLING.search, missing + added)), missing, added


@lru_cache(1)
def scanner() -> Scanner:
    return Scanner()


def license_blocks(docs: DataFrame) -> DataFrame:
    """Per candidate block and license confirmed in it (one row with null if none is): doc_id, line,
    license, best_by_size, reduction, missing, added.

    Null and empty texts, and texts that don't speak of licensing, have no blocks; repeated rows are
    scanned each; other columns are ignored.  The first filter runs inside the scan of the table.
    """

    def row(texts: list[str]) -> dict:
        out = []
        for text in texts:
            out.append([(first + a, *rest) for first, region, own in regions(text) for a, *rest in scanner().scan(region, own)])
        names = ("line", "license", "best_by_size", "reduction", "missing", "added")
        return {"found": [[dict(zip(names, b, strict=True)) for b in own] for own in out]}

    schema = "found array<struct<line: int, license: string, best_by_size: string, reduction: double, missing: array<string>, added: array<string>>>"
    speaking = docs.where(whole_text().rlike(KEYWORDS))
    return map_texts(speaking, row, schema).select("doc_id", F.inline("found"))


def brute_force(text: str) -> str | None:
    """The license whose wording differs least, without looking at sizes; for tests."""
    best = confirmed(text)
    return min(best)[2] if best else None


def confirmed(text: str) -> list[tuple[int, int, str]]:
    """(differences, minus the words, license) of the wordings that whole texts have, window by window; for tests."""
    own, best = words(text), []
    for name, wordings in WORDINGS.items():
        for w in map(words, wordings):
            for i in range(len(own)):
                for size in range(1, len(w) + len(w) // 4 + 1):
                    ok, missing, added = is_wording(w, own[i : i + size]) if size >= MIN_WORDS_SHARE * len(w) else (False, [], [])
                    if ok:
                        best.append((len(missing) + len(added), -len(w), name))
    return best


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_blocks(read(spark, sf_dir, "documents"))
