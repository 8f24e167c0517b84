"""License scan: winnowed fingerprints of templates pick candidates, banded alignment measures them.

Templates and texts are split into lower-cased tokens of letters and digits. Of every few neighbouring token triples
the one with the least code is a fingerprint, so a shared run of K + WINDOW - 1 tokens shares one for certain. The
inverted index maps a fingerprint to its places in the templates; matches near one diagonal are a candidate, and an
alignment of the whole template within a band around that diagonal gives the matched tokens. The index has the size
of the templates and travels with the task; texts are looked at once, whole, where they lie.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 3
WINDOW = 2
BAND = 8               # of long templates; short ones have a narrower band, so that repeats stay apart
MIN_COVERAGE = 0.7
SHORT = 16             # tokens; of templates up to here every naming token is needed
FEW = 3                # as many tokens that tell a longer template from another are all needed
# Words of short templates that name no license.
GENERIC = frozenset("a an as code dedicated distributed domain file in international is it license licensed of "
                    "released software source subject terms the this to under universal version work".split())

# License notices and texts, as their publishers word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License."),
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT "
        "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See "
        "the GNU Affero General Public License for more details."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution."),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of "
        "its contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission."),
    "CC0-1.0": "This work is dedicated to the public domain under CC0 1.0 Universal.",
    "CC0-1.0-short": "Licensed under CC0 1.0.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-NC-4.0-long": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version. This library is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU Lesser General Public License for more details."),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT "
        "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See "
        "the GNU Lesser General Public License for more details."),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."),
}

SCHEMA = ("doc_id long, license string, coverage double, matched_tokens int, template_tokens int, start_char int, "
          "end_char int, spans array<struct<start:int,end:int>>")
ARROW = pa.schema([
    ("doc_id", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()), ("matched_tokens", pa.int32()),
    ("template_tokens", pa.int32()), ("start_char", pa.int32()), ("end_char", pa.int32()),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])

# Bytes to bytes: letters lower-cased, all else below 128 but digits to blanks; bytes above belong to letters.
FOLD = bytes(ord(chr(b).lower()) if chr(b).isalnum() and b < 128 else b if b >= 128 else 32 for b in range(256))
TOKEN = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")
NEVER = np.iinfo(np.int64).max


class Index:
    """Inverted index of the templates' fingerprints."""

    def __init__(self, templates: dict[str, str]):
        words = {name: text.encode().translate(FOLD).split() for name, text in templates.items()}
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for ws in words.values() for w in ws}))}
        self.names = sorted(words)
        self.tokens = [np.array([self.vocabulary[w] for w in words[n]], dtype=np.int64) for n in self.names]
        self.bands = [min(BAND, 1 + len(tokens) // 4) for tokens in self.tokens]
        postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, tokens in enumerate(self.tokens):
            codes = self.codes(tokens)
            # a template shorter than a window still has one fingerprint
            for at in self.winnow(codes) if len(codes) >= WINDOW else range(len(codes)):
                postings[int(codes[at])].append((t, int(at)))
        self.postings = dict(postings)
        self.known = np.array(sorted(postings), dtype=np.int64)
        # places of a short template's naming tokens; sets of places of a longer one that tell it from each like it
        self.naming = [[i for i, w in enumerate(words[n]) if w.decode() not in GENERIC] if len(words[n]) <= SHORT else []
                       for n in self.names]
        self.telling = [[] if len(tokens) <= SHORT else self._telling(t) for t, tokens in enumerate(self.tokens)]

    def _telling(self, t: int) -> list[set[int]]:
        tokens, sets = self.tokens[t], []
        for u, other in enumerate(self.tokens):
            if u == t or len(other) <= SHORT:
                continue
            covered = {i for i, _ in align(tokens, other, 0, max(len(tokens), len(other)))}
            missing = set(range(len(tokens))) - covered
            if missing and len(covered) >= MIN_COVERAGE * len(tokens) / 2:
                sets.append(missing)
        return sets

    def tells(self, t: int, pairs: list[tuple[int, int]]) -> bool:
        """Whether a match has what names its template: in a short one all naming tokens, neighbours as neighbours; in a
        longer one what each similar template lacks, all of few tokens or MIN_COVERAGE of more."""
        at = dict(pairs)
        naming = self.naming[t]
        if any(i not in at for i in naming) or any(j == i + 1 and at[j] != at[i] + 1 for i, j in pairwise(naming)):
            return False
        return all(len(places & at.keys()) >= (1 if len(places) <= FEW else MIN_COVERAGE) * len(places)
                   for places in self.telling[t])

    def codes(self, tokens: np.ndarray) -> np.ndarray:
        """One number per run of K known tokens, scrambled so that common words are not the least; else NEVER."""
        n = len(tokens) - K + 1
        if n <= 0:
            return np.empty(0, dtype=np.int64)
        code = np.zeros(n, dtype=np.uint64)
        known = np.ones(n, dtype=bool)
        for k in range(K):
            part = tokens[k:k + n]
            known &= part >= 0
            code = code * np.uint64(len(self.vocabulary)) + part.astype(np.uint64)
        code = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(1)  # an odd factor: distinct runs keep distinct codes
        return np.where(known, code.astype(np.int64), NEVER)

    @staticmethod
    def winnow(codes: np.ndarray) -> np.ndarray:
        """Places that are the rightmost least of some WINDOW neighbours."""
        if len(codes) < WINDOW:
            return np.empty(0, dtype=np.int64)
        windows = np.lib.stride_tricks.sliding_window_view(codes, WINDOW)
        return np.unique(np.arange(len(windows)) + WINDOW - 1 - np.argmin(windows[:, ::-1], axis=1))

    def ids(self, text: bytes) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, text.translate(FOLD).split(), repeat(-1)), dtype=np.int64)

    def candidates(self, tokens: np.ndarray) -> list[tuple[int, int]]:
        """(template, diagonal) pairs that fingerprints of the text vote for, one per place in the text."""
        codes = self.codes(tokens)
        places = np.flatnonzero(codes != NEVER)
        if not len(places):
            return []
        if len(codes) >= WINDOW:
            places = np.intersect1d(places, self.winnow(codes), assume_unique=True)
        elif len(codes):
            places = np.arange(len(codes))
        places = places[np.isin(codes[places], self.known)]
        open_: dict[int, list[list[int]]] = defaultdict(list)  # template: [diagonal, last place]
        for at in places.tolist():
            for t, inside in self.postings[int(codes[at])]:
                diagonal = at - inside
                for region in reversed(open_[t]):
                    if at - region[1] > len(self.tokens[t]) + self.bands[t]:
                        region = None
                        break
                    if abs(diagonal - region[0]) <= self.bands[t]:
                        region[1] = at
                        break
                else:
                    region = None
                if region is None:
                    open_[t].append([diagonal, at])
        return [(t, region[0]) for t, regions in open_.items() for region in regions]


def align(template: np.ndarray, tokens: np.ndarray, diagonal: int, band: int = BAND) -> list[tuple[int, int]]:
    """Matched (template place, text place) pairs of a longest common subsequence within `band` of the diagonal."""
    width = 2 * band + 1
    table = np.zeros((len(template) + 1, width), dtype=np.int32)
    equal = np.zeros((len(template), width), dtype=bool)
    offsets = np.arange(width) - band + diagonal
    for i, token in enumerate(template):
        at = offsets + i
        inside = (at >= 0) & (at < len(tokens))
        equal[i, inside] = tokens[at[inside]] == token
        # one template token on, the same text token lies one cell to the right
        above = np.r_[table[i, 1:], 0]
        table[i + 1] = np.maximum.accumulate(np.maximum(above, table[i] + equal[i]))
    pairs, i, c = [], len(template), width - 1
    while i and table[i, c]:
        if c and table[i, c - 1] == table[i, c]:
            c -= 1
        elif equal[i - 1, c] and table[i - 1, c] + 1 == table[i, c]:
            pairs.append((i - 1, int(offsets[c]) + i - 1))
            i -= 1
        else:
            i, c = i - 1, c + 1
    return pairs[::-1]


def find_licenses(index: Index, text: bytes, min_coverage: float) -> list[tuple]:
    """(license, coverage, matched, template tokens, start, end, spans) with places in characters, by place."""
    tokens = index.ids(text)
    found = []
    for t, diagonal in index.candidates(tokens):
        pairs = align(index.tokens[t], tokens, diagonal, index.bands[t])
        if pairs and len(pairs) >= min_coverage * len(index.tokens[t]) and index.tells(t, pairs):
            found.append((t, pairs))
    if not found:
        return []
    # of overlapping matches the one stays that has the most tokens, less those of template and text left unmatched
    def worth(pairs: list[tuple[int, int]], t: int) -> int:
        return 3 * len(pairs) - len(index.tokens[t]) - (pairs[-1][1] - pairs[0][1] + 1)

    found.sort(key=lambda f: (-worth(f[1], f[0]), f[0], f[1][0][1]))
    taken: list[tuple[int, int, int]] = []
    characters = [m.span() for m in TOKEN.finditer(text.decode())]
    out = []
    for t, pairs in found:
        first, last = pairs[0][1], pairs[-1][1]
        # matches with different templates may touch: half of the shorter one must lie in the other
        if any(first <= b and a <= last and (t == u or 2 * (min(b, last) - max(a, first) + 1) >= min(b - a, last - first) + 1)
               for a, b, u in taken):
            continue
        taken.append((first, last, t))
        spans: list[dict[str, int]] = []
        before = None
        for _, at in pairs:
            if before is not None and at == before + 1:
                spans[-1]["end"] = characters[at][1]
            else:
                spans.append({"start": characters[at][0], "end": characters[at][1]})
            before = at
        out.append((index.names[t], len(pairs) / len(index.tokens[t]), len(pairs), len(index.tokens[t]),
                    characters[first][0], characters[last][1], spans))
    return sorted(out, key=lambda r: (r[4], r[0]))


def scan_licenses(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                  templates: dict[str, str] | None = None, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row per match: doc_id, license, coverage (matched share of the template's tokens), matched_tokens,
    template_tokens, start_char, end_char, and spans of matched characters.

    Null, empty and unlicensed texts give no rows. A text may match several templates, or one in several places; of
    matches that overlap the best one stays. A match must have the tokens that tell its license from others.
    Null ids and repeated rows give rows like any other; an empty table gives none. Other columns are ignored.
    """
    wanted = TEMPLATES if templates is None else templates

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(wanted)
        for batch in batches:
            rows = [(key, *match) for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
                    for match in find_licenses(index, value.as_py() or b"", min_coverage)]
            columns = list(zip(*rows, strict=True)) or [[]] * len(ARROW)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW, strict=True)],
                                             schema=ARROW)

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
            .mapInArrow(scan, SCHEMA))
