"""License texts in documents: winnowed fingerprints choose candidates, banded alignment confirms them.

Templates are cut into words; the hashes of their runs of words are winnowed, so that every stretch of
``run + window - 1`` equal words shares a fingerprint, and kept in an inverted index (fingerprint to
template and place).  A document's runs are looked up in it; the places where hits agree on an offset
(document place minus template place) give candidates, and each is aligned word by word inside a
diagonal band.  What is reported is how well the template is matched, and where.  Notices of a few words
differ from those of other licenses in one word or two, so all their words must stand in a row; versions of a
license differ in a number, so the numbers of a long template must all be there.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import Texts, map_texts, slices

_GNU = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name}General Public "
    "License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
    "later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
)

# License notices as their licenses word them.
TEMPLATES: Mapping[str, str] = {
    "mit-notice": "Released under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "mit-licensed-notice": "Licensed under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."
    ),
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-nd-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "cc-by-nc-sa-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "cc-by-nc-nd-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-nd-4.0-notice": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-sa-4.0-notice": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-4.0-notice": "Licensed under CC BY-NC-ND 4.0.",
    "cc0-1.0-notice": "Licensed under CC0 1.0.",
    "cc0-1.0": (
        "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related "
        "or neighboring rights to this work."
    ),
    "cc0-1.0-software": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
        "this software to the public domain worldwide. This software is distributed without any warranty."
    ),
    "gpl-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl-2.1-notice": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "gpl-2.0": _GNU.format(what="program", name="", version="2"),
    "lgpl-2.1": _GNU.format(what="library", name="Lesser ", version="2.1"),
    "lgpl-3.0": _GNU.format(what="program", name="Lesser ", version="3"),
    "agpl-3.0": _GNU.format(what="program", name="Affero ", version="3"),
    "unlicense-notice": "Released under the Unlicense.",
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means."
    ),
    "epl-1.0-notice": "Licensed under the Eclipse Public License, Version 1.0.",
    "epl-2.0-notice": "Licensed under the Eclipse Public License, Version 2.0.",
    "epl-1.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 "
        "which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"
    ),
    "epl-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
}

# Identifiers of the licenses above in the SPDX list; each is a template behind the words that announce one.
SPDX = (
    "MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "MPL-2.0", "CC0-1.0", "Unlicense", "EPL-1.0", "EPL-2.0",
    "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later",
    "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later",
)
TEMPLATES = {**TEMPLATES, **{f"spdx-{name.lower()}": f"SPDX-License-Identifier: {name}" for name in SPDX}}


@dataclass(frozen=True)
class Settings:
    """Words per run, runs per winnowing window, half width of the band, and least coverage of a template.

    Templates of fewer than ``whole`` words must be matched word for word; of longer ones, all words that hold a digit, as
    these tell versions apart.
    """

    run: int = 3
    window: int = 2
    band: int = 4
    coverage: float = 0.8
    whole: int = 16


#: Letters and digits make words, without case; every other ASCII character separates them.
FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())


@dataclass(frozen=True)
class Index:
    """Fingerprints in ascending order with template and place; the words of every template."""

    names: tuple[str, ...]
    words: tuple[np.ndarray, ...]
    numbers: tuple[np.ndarray, ...]  # of these, the ones that hold a digit
    prints: np.ndarray
    template: np.ndarray
    place: np.ndarray


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest hash of every window, the last one of equals."""
    if len(hashes) <= window:
        return np.array([len(hashes) - 1 - int(hashes[::-1].argmin())]) if len(hashes) else np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes[::-1], window)
    return np.unique(len(hashes) - 1 - (np.arange(len(views)) + views.argmin(1)))


def folded(texts: list[bytes]) -> Texts:
    """The words of the comparison; byte places are those of the texts."""
    return Texts([t.translate(FOLD) for t in texts])


def with_digit(read: Texts) -> np.ndarray:
    """Whether each word holds a digit."""
    before = np.concatenate(([0], np.cumsum((read.data >= 48) & (read.data < 58))))
    return before[read.word_end] > before[read.word_start]


def in_order(wanted: list, held: list) -> bool:
    """Whether ``wanted`` is a subsequence of ``held``."""
    rest = iter(held)
    return all(word in rest for word in wanted)


def build_index(templates: Mapping[str, str], settings: Settings) -> Index:
    names = tuple(templates)
    read = folded([templates[n].encode() for n in names])
    runs, at = read.shingles(settings.run)
    doc = read.word_doc[at]
    prints, owner, place = [], [], []
    for t in range(len(names)):
        mine = np.flatnonzero(doc == t)
        chosen = mine[winnow(runs[mine], settings.window)] if len(mine) else mine
        prints.append(runs[chosen])
        owner.append(np.full(len(chosen), t))
        place.append(at[chosen] - read.first_word[t])
    whole = np.concatenate(prints)
    by = np.argsort(whole, kind="stable")
    words = tuple(read.words[a:b] for a, b in zip(read.first_word[:-1], read.first_word[1:]))
    digits = with_digit(read)
    numbers = tuple(read.words[a:b][digits[a:b]] for a, b in zip(read.first_word[:-1], read.first_word[1:]))
    return Index(names, words, numbers, whole[by], np.concatenate(owner)[by], np.concatenate(place)[by])


@lru_cache(maxsize=4)
def index_of(templates: tuple[tuple[str, str], ...], settings: Settings) -> Index:
    return build_index(dict(templates), settings)


def align(text: np.ndarray, template: np.ndarray, offset: int, band: int) -> tuple[int, int, int]:
    """Longest common subsequence of a template and the text around ``offset``, inside a diagonal band.

    Text word ``i`` and template word ``j`` are compared if ``|i - offset - j| <= band``.  Returns the number of matched
    words and the first and last matched text word (-1, -1 without a match); of equal ones that which begins last.
    """
    width = 2 * band + 1
    none = (0, -1, -1)
    row = [none] * (width + 2)
    for j in range(len(template)):
        # Cell d of a row stands for text word offset + j + d - band; the row before is one diagonal step behind.
        new = [none] * (width + 2)
        for d in range(1, width + 1):
            i = offset + j + (d - 1) - band
            best = max(row[d + 1], new[d - 1], key=lambda c: (c[0], c[1], -c[2]))
            if 0 <= i < len(text) and text[i] == template[j]:
                count, first, _ = row[d]
                best = max(best, (count + 1, first if count else i, i), key=lambda c: (c[0], c[1], -c[2]))
            new[d] = best
        row = new
    return max(row[1:-1], key=lambda c: (c[0], c[1], -c[2]))


@dataclass(frozen=True)
class Match:
    """A template in a text: matched words, their share of the template or of a longer span, and the span (code points, end exclusive)."""

    license: str
    matched: int
    coverage: float
    start: int
    end: int


def candidates(read: Texts, index: Index, settings: Settings) -> dict[int, list[tuple[int, int]]]:
    """By text: templates and offsets that fingerprints suggest; offsets of long ones closer than half the band count once."""
    runs, at = read.shingles(settings.run)
    low = np.searchsorted(index.prints, runs)
    hit = np.flatnonzero(index.prints[np.minimum(low, len(index.prints) - 1)] == runs)
    high = np.searchsorted(index.prints, runs[hit], "right")
    found: dict[int, set[tuple[int, int]]] = {}
    for k, stop in zip(hit.tolist(), high.tolist()):
        doc = int(read.word_doc[at[k]])
        for e in range(int(low[k]), stop):
            offset = int(at[k] - read.first_word[doc]) - int(index.place[e])
            found.setdefault(doc, set()).add((int(index.template[e]), offset))
    out = {}
    for doc, places in found.items():
        out[doc] = []
        for template, offset in sorted(places):
            far = not out[doc] or out[doc][-1][0] != template or offset - out[doc][-1][1] > settings.band // 2
            if far or len(index.words[template]) < settings.whole:
                out[doc].append((template, offset))
    return out


def scan(texts: list[bytes], index: Index, settings: Settings) -> list[list[Match]]:
    """The matches of every text by start; a match of which a better one holds more than half is left out."""
    out: list[list[Match]] = [[] for _ in texts]
    if not len(index.prints):
        return out
    read = folded(texts)
    digits = with_digit(read)
    for doc, places in candidates(read, index, settings).items():
        first_word = int(read.first_word[doc])
        words = read.words[first_word : read.first_word[doc + 1]]
        found: set[tuple[int, float, int, int, int]] = set()
        for template, offset in places:
            wanted = index.words[template]
            if len(wanted) < settings.whole:
                if offset >= 0 and np.array_equal(words[offset : offset + len(wanted)], wanted):
                    found.add((len(wanted), 1.0, template, offset, offset + len(wanted) - 1))
                continue
            matched, first, last = align(words, wanted, offset, settings.band)
            # Words put into the span count against it like words that are missing.
            coverage = matched / max(len(wanted), last - first + 1)
            span = slice(first_word + first, first_word + last + 1)
            if coverage >= settings.coverage and in_order(index.numbers[template].tolist(), read.words[span][digits[span]].tolist()):
                found.add((matched, coverage, template, first, last))
        best: list[tuple[int, float, int, int, int]] = []
        for match in sorted(found, key=lambda m: (-m[0], -m[1], m[3], m[2])):
            first, last = match[3:]
            if not any(2 * (min(kept[4], last) - max(kept[3], first) + 1) > last - first + 1 for kept in best):
                best.append(match)
        for matched, coverage, template, first, last in sorted(best, key=lambda m: (m[3], m[2])):
            a, b = (int(p - read.starts[doc]) for p in (read.word_start[first_word + first], read.word_end[first_word + last]))
            start = len(texts[doc][:a].decode("utf-8", "replace"))
            end = start + len(texts[doc][a:b].decode("utf-8", "replace"))
            out[doc].append(Match(index.names[template], matched, coverage, start, end))
    return out


SCHEMA = "doc_id long, license string, matched_words long, coverage double, start long, end long"


def find_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, settings: Settings = Settings()) -> DataFrame:
    """One row per match: ``doc_id``, ``license``, ``matched_words``, ``coverage`` (their share of the template, or of
    the span if that is longer), ``start``, ``end``.

    A template shorter than one run of words is never found.  A null or empty text has no match and gives no row, nor
    does an empty table; a repeated row gives its matches again; a null ``doc_id`` stays null; other columns are not read.
    """
    chosen = tuple(templates.items())

    def run(batches):
        index = index_of(chosen, settings)
        for batch, texts in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            rows = [(i, m.license, m.matched, m.coverage, m.start, m.end) for i, found in zip(ids, scan(texts, index, settings)) for m in found]
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [part.split()[0] for part in SCHEMA.split(", ")])

    return map_texts(docs, run, SCHEMA)
