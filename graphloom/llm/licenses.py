"""License scans by conditional compression.

Words with a license cue, with as many words around as a notice can take on either side, form candidate blocks,
so that a notice may be wrapped at any column. A block is compressed alone, and with each template as a zstandard
raw dictionary; the templates are ranked by how much smaller it gets. In this order all whose words the block holds
are confirmed by exact wording: place and template are compared word by word, and what the template's required
words lack, and which numbers differ, decides. Where places of confirmed templates overlap, what they span together
is compressed with each of them, and the one that makes it smallest counts. So version 3 of a license and version 2
are told apart by their wording, not by size, and a license whose notice holds another's whole wording and a clause
more by that clause.

Defined cases: a null or empty text has no block; repeated rows are scanned each for itself; licenses that tie
are taken by name; an empty table gives an empty result; further columns don't matter; texts of any length are
scanned whole.
"""

from __future__ import annotations

import re
from collections import Counter
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The public wording of notices, by SPDX identifier. Numbers stand as they are in the license.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
        "MIT License",
    ),
    "MIT-0": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Licensed under the BSD 3-Clause License.",
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
        "Licensed under the BSD 2-Clause License.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, Version 2.0.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
    ),
    "0BSD": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "CC0-1.0": ("Licensed under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "All-Rights-Reserved": ("All rights reserved.",),
}

#: A word may be wrapped after a hyphen.
_WORD = re.compile(r"[A-Za-z0-9]+(?:(?:[.]|-(?:[^\S\n]*\n[^\w\n]*)?)[A-Za-z0-9]+)*")
#: Words a notice can't do without: each template holds more of them than may be lacking, so a wording that
#: covers enough of it has one. A word counts by its beginning.
_CUE = re.compile(r"(?:sub|un)?licen[cs]|copyright|copies|permi(?:ssion|tted)|granted|software|(?:re)?distribut|reserved|rights|unencumbered|domain|mozilla|mpl|gnu|foundation|disclaimer|binary|waived|warrant|contributors|endorse|notice|retain", re.I)
#: Share of a template's words that must stand in the text in order, and how much longer the place may be.
COVERAGE, STRETCH = 0.85, 1.3


def wording(text: str) -> list[str]:
    return [re.sub(r"-\W+", "-", w).lower() for w in _WORD.findall(text)]


def reach(n_words: int) -> int:
    """Words that the place of a template of so many words may take, at most."""
    return int(STRETCH * n_words + 2)


#: Words on either side of a cue word that a notice with it can take.
REACH = max(reach(len(wording(t))) for of in TEMPLATES.values() for t in of)


def blocks(text: str, around: int = REACH) -> list[tuple[int, str]]:
    """(offset, text) of the candidate blocks: cue words with the words around, whatever the lines; those that touch are one."""
    if not _CUE.search(text):
        return []
    words = list(_WORD.finditer(text))
    spans: list[list[int]] = []  # first and last word
    for i, m in enumerate(words):
        if _CUE.match(text, m.start()):
            if spans and i - around <= spans[-1][1] + 1:
                spans[-1][1] = i + around
            else:
                spans.append([max(0, i - around), i + around])
    ends = [(words[a].start(), words[min(z, len(words) - 1)].end()) for a, z in spans]
    return [(a, text[a:z]) for a, z in ends]


class Scanner:
    """Finds licenses in texts."""

    def __init__(self, templates: dict[str, tuple[str, ...]] = TEMPLATES, level: int = 3):
        import zstandard as zstd

        self.entries = [(name, t, wording(t)) for name in templates for t in templates[name]]
        self.counts = [Counter(want) for _, _, want in self.entries]
        self.around = max(reach(len(want)) for _, _, want in self.entries)
        params = zstd.ZstdCompressionParameters.from_level(level, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.plain = zstd.ZstdCompressor(compression_params=params)
        given = lambda t: zstd.ZstdCompressor(compression_params=params, dict_data=zstd.ZstdCompressionDict(t.encode(), dict_type=zstd.DICT_TYPE_RAWCONTENT))
        self.given = [given(t) for _, t, _ in self.entries]
        self.worded = [given(" ".join(want)) for _, _, want in self.entries]
        self.judged = lru_cache(4096)(self._judge)
        self.compared = lru_cache(16384)(self._compare)

    def reductions(self, block: str) -> list[float]:
        """For each template, the share of the block's compressed size that it saves."""
        raw = block.encode("utf-8", "surrogatepass")
        alone = len(self.plain.compress(raw))
        return [(alone - len(c.compress(raw))) / alone for c in self.given]

    def _remainders(self, words: list[str], places: list[tuple[int, float, int, int, str]]) -> list[int]:
        """For each place, the compressed size given its template of what it and the places that it overlaps with, directly or by others, span."""
        spans: list[list[int]] = []
        for lo, hi in sorted(p[2:4] for p in places):
            if spans and lo < spans[-1][1]:
                spans[-1][1] = max(hi, spans[-1][1])
            else:
                spans.append([lo, hi])
        raw = {a: " ".join(words[a:z]).encode("utf-8", "surrogatepass") for a, z in spans}
        return [len(self.worded[i].compress(raw[max(a for a in raw if a <= lo)])) for i, _, lo, _, _ in places]

    def _compare(self, i: int, words: tuple[str, ...]) -> tuple[float, int, int, str] | None:
        """(coverage, first word, end, differences) of a template in a window, if its wording is confirmed there."""
        _, _, want = self.entries[i]
        match = SequenceMatcher(None, want, words, autojunk=False)
        same = [m for m in match.get_matching_blocks() if m.size]
        coverage = sum(m.size for m in same) / len(want)
        if coverage < COVERAGE:
            return None
        lo, hi = same[0].b, same[-1].b + same[-1].size
        lacking, instead = [], []
        for op, a, b, c, d in match.get_opcodes():
            if op != "equal":
                lacking += want[a:b]
            if op == "replace":  # at the window's ends as many words as are lacking: the others are around the notice
                instead += words[max(c, d - (b - a)) : d] if a == 0 else words[c : min(d, c + b - a)] if b == len(want) else words[c:d]
            if op == "insert" and 0 < a < len(want):  # put into the wording, not around it
                instead += words[c:d]
        # a number or a license's own term that differs is another license
        if any(any(ch.isdigit() for ch in w) or w in _TERMS for w in lacking) or any(w in _TERMS for w in instead):
            return None
        return coverage, lo, hi, " ".join(f"-{w}" for w in lacking)

    def _places(self, i: int, words: list[str]) -> list[tuple[float, int, int, str]]:
        """What _compare confirms of a template anywhere in a block's words; windows that hold too few of its words can't be."""
        want, least = self.counts[i], COVERAGE * len(self.entries[i][2])
        wide, left, n, held = reach(len(self.entries[i][2])), dict(self.counts[i]), 0, []
        for z in range(len(words) + wide):
            if z < len(words) and words[z] in want:
                left[words[z]] -= 1
                n += left[words[z]] >= 0
            s = z - wide + 1  # the window of s is full now
            if s >= 0 and words[s] in want:
                if n >= least:
                    held.append((-n, -s))
                left[words[s]] += 1
                n -= left[words[s]] > 0
            if s == len(words) - 1:
                break
        out: list[tuple[float, int, int, str]] = []
        for _, s in sorted(held):
            s = -s
            if any(lo <= s < hi for _, lo, hi, _ in out):
                continue
            z = min(len(words), s + wide)
            while words[z - 1] not in want:
                z -= 1
            if got := self.compared(i, tuple(words[s:z])):
                out.append((got[0], s + got[1], s + got[2], got[3]))
        return out

    def _judge(self, block: str) -> tuple[tuple[str, float, float, str], ...]:
        """(license, reduction, coverage, differences) of each confirmed license in a block, best first."""
        words = wording(block)
        stock = Counter(words)
        saved = self.reductions(block)
        places = []
        for i in sorted(range(len(saved)), key=lambda i: (-saved[i], i)):
            if sum(min(k, stock[w]) for w, k in self.counts[i].items()) >= COVERAGE * len(self.entries[i][2]):
                places += [(i, *p) for p in self._places(i, words)]
        best: dict[str, tuple[float, float, str]] = {}
        taken: list[tuple[int, int]] = []
        # of places that overlap, the one whose template makes the span smallest counts, then the one with most words, then the closest wording
        order = lambda x: (x[0], -round(x[1][1] * len(self.entries[x[1][0]][2])), -x[1][1], -saved[x[1][0]], self.entries[x[1][0]][0], x[1][2])
        for _, (i, coverage, lo, hi, differences) in sorted(zip(self._remainders(words, places), places), key=order):
            if any(lo < z and a < hi for a, z in taken):
                continue
            taken.append((lo, hi))
            name = self.entries[i][0]
            if name not in best or saved[i] > best[name][0]:
                best[name] = (saved[i], coverage, differences)
        return tuple((name, *v) for name, v in sorted(best.items(), key=lambda x: (-x[1][0], x[0])))

    def scan(self, text: str) -> tuple[int, list[tuple[int, str, float, float, str]]]:
        """Number of candidate blocks; (offset of the block, license, reduction, coverage, differences) found in them."""
        cand = blocks(text, self.around)
        return len(cand), [(at, *f) for at, b in cand for f in self.judged(b)]


#: Words whose change makes another license (a fixed value).
_TERMS = frozenset("apache mit gnu gpl lesser affero bsd mozilla mpl isc cc cc0 by by-nc by-nd by-sa by-nc-sa by-nc-nd attribution noncommercial sharealike noderivatives".split())

_FOUND = "array<struct<offset:long,license:string,reduction:double,coverage:double,differences:string>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_blocks, found) for each row: found lists offset, license, reduction, coverage and differences."""
    src = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    kind = src.schema[id_col].dataType.simpleString()
    item = pa.list_(pa.struct([("offset", pa.int64()), ("license", pa.string()), ("reduction", pa.float64()), ("coverage", pa.float64()), ("differences", pa.string())]))

    def run(batches):
        scanner = Scanner()
        for batch in batches:
            rows = [scanner.scan(t.as_py() or "") for t in batch.column(1)]
            found = [[dict(zip(("offset", "license", "reduction", "coverage", "differences"), f)) for f in fs] for _, fs in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in rows], pa.int64()), pa.array(found, item)], names=[id_col, "n_blocks", "found"])

    return src.mapInArrow(run, f"`{id_col}` {kind}, n_blocks long, found {_FOUND}")
