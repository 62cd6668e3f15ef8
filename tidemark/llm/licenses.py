"""License scans (operator 5): MinHash bands over overlapping text windows, then exact shingle containment.

Texts and templates are lower-cased and split into words; sets are of five-word shingles. Templates are put into classes of
length, each at most a quarter longer than the one before. In the class of L shingles windows hold 2 L shingles and start every L, so a copy of a
template of the class lies whole in one of them; a window that holds such a template to 75 percent has a similarity of at least
3/11 with it. Bands have one minhash each, ``BANDS`` in all: such a window agrees with the template in no band with probability
(8/11)^BANDS, below 3e-6. A table (class, band, minhash) leads to templates; a window's minhashes are computed once for all
templates of its class, and only templates that the table gives are verified: the share of their shingles that the window
holds. A window can agree in a band only if it holds the least shingle of a template in some band, so other windows need no
minhashes. Overlapping finds of one template become one.

Null and empty texts and texts of fewer than five words match nothing and have no row; repeated rows give repeated
rows; an empty table gives an empty table; templates of fewer than five words raise an error. Only the columns named are
read, so others may have any name. Texts are scanned whole.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from tidemark.llm.common import map_rows, ship

ship(__name__)

SHINGLE, BANDS, CONTAINMENT = 5, 40, 0.75
REMEMBERED = 200_000
WORD = r"\w+"

#: Notices of public licenses.
TEMPLATES = {
    "0BSD permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS."
    ),
    "AGPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "AGPL-3.0 notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "Artistic-2.0 notice": (
        "This is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0."
    ),
    "BSD binary condition": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "BSD conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ),
    "BSD source condition": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    ),
    "BSD-2-Clause notice": "This software is distributed under the BSD 2-Clause License.",
    "BSD-3-Clause condition": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission."
    ),
    "BSD-3-Clause notice": "This software is distributed under the BSD 3-Clause License.",
    "BSD-4-Clause condition": (
        "All advertising materials mentioning features or use of this software must display the following acknowledgement:"
    ),
    "BSL-1.0 notice": "Distributed under the Boost Software License, Version 1.0.",
    "BSL-1.0 permission": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
        'documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the '
        "Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to "
        "do so, all subject to the following:"
    ),
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0 sentence": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-ND-4.0 notice": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."
    ),
    "CC-BY-NC-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-ND-4.0 notice": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-SA-3.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0 notice": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."
    ),
    "CDDL-1.0 header": (
        "The contents of this file are subject to the terms of the Common Development and Distribution License (the License). "
        "You may not use this file except in compliance with the License."
    ),
    "EPL-2.0 header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
        "available at https://www.eclipse.org/legal/epl-2.0"
    ),
    "EUPL-1.2 header": (
        "Licensed under the EUPL, Version 1.2 or - as soon they will be approved by the European Commission - subsequent versions of the EUPL"
    ),
    "GFDL-1.3 notice": (
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, "
        "Version 1.3 or any later version published by the Free Software Foundation"
    ),
    "GPL-2.0 header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ),
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
        "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "ISC permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-2.1 header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."
    ),
    "LGPL-3.0 header": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "LGPL-3.0 notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT conditions": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "MIT notice": "Released under the MIT License.",
    "MIT permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "MPL-1.1 header": (
        'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use this file '
        "except in compliance with the License."
    ),
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "OFL-1.1 notice": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "PSF-2.0 notice": "Licensed to PSF under a Contributor Agreement.",
    "Unlicense dedication": "This is free and unencumbered software released into the public domain.",
    "Unlicense permission": (
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
        "compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "Warranty disclaimer": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES '
        "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "WTFPL permission": (
        "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed "
        "as long as the name is changed."
    ),
    "Zlib permission": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
        "any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
        "including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"
    ),
}
#: Identifiers whose one-line tag has five words or more. Tags of one-word identifiers have four.
TAGGED = [
    "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0",
    "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later",
    "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MPL-2.0", "OFL-1.1",
]
TEMPLATES |= {f"{name} tag": f"SPDX-License-Identifier: {name}" for name in TAGGED}
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word):
        value = xxhash.xxh64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = value
        return value


def multipliers() -> np.ndarray:
    """Odd multipliers of the minhash functions, one a band."""
    return np.random.default_rng(50_021).integers(1, 1 << 63, BANDS, dtype=np.uint64) | np.uint64(1)


def length_class(size: int) -> int:
    """The least length of a class that is ``size`` or more: 1 and on, each a quarter (and at least 1) longer."""
    length = 1
    while length < size:
        length = max(length + 1, length * 5 // 4)
    return length


class Scanner:
    """Finds templates in texts."""

    def __init__(self, templates: dict[str, str]):
        self.words, self.factors = _WordHashes(), multipliers()
        self.names, self.sets = sorted(templates), []
        self.bands: dict[int, dict[tuple[int, int], list[int]]] = {}  # class: (band, minhash): templates
        marks: dict[int, set[int]] = {}  # class: the shingles that are least in some band of a template
        for i, name in enumerate(self.names):
            shingles = np.unique(self.shingles(templates[name]))
            if not len(shingles):
                raise ValueError(f"template {name!r} has fewer than {SHINGLE} words")
            self.sets.append(shingles)
            length = length_class(len(shingles))
            mixed = shingles * self.factors[:, None]
            table, least = self.bands.setdefault(length, {}), mixed.argmin(axis=1)
            for entry in enumerate(mixed.min(axis=1).tolist()):
                table.setdefault(entry, []).append(i)
            marks.setdefault(length, set()).update(shingles[least].tolist())
        self.marks = {length: np.array(sorted(m), np.uint64) for length, m in marks.items()}
        self.any_mark = np.unique(np.concatenate([*self.marks.values(), np.empty(0, np.uint64)]))

    def shingles(self, text: str) -> np.ndarray:
        h = np.array(list(map(self.words.__getitem__, re.findall(WORD, text.lower()))), np.uint64)
        n = len(h) - SHINGLE + 1
        if n < 1:
            return np.empty(0, np.uint64)
        z = h[:n].copy()
        for k in range(1, SHINGLE):
            z *= _MIX
            z += h[k : n + k]
        z ^= z >> np.uint64(32)
        return z * _MIX

    def retrieved(self, window: np.ndarray, length: int) -> set[int]:
        """The templates of a class that agree with a window in some band."""
        table, found = self.bands[length], set()
        for entry in enumerate((window * self.factors[:, None]).min(axis=1).tolist()):
            found.update(table.get(entry, ()))
        return found

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(template, containment, first and last word) of every find."""
        if not text:
            return []
        z = self.shingles(text)
        marked = np.flatnonzero(_held(self.any_mark, z))
        if not len(marked):
            return []
        finds: dict[int, list[list]] = {}
        for length in self.bands:
            own = marked[_held(self.marks[length], z[marked])]
            for start in np.unique(np.concatenate([own // length, np.maximum(own // length - 1, 0)])).tolist():
                start *= length
                window = z[start : start + 2 * length]
                for i in self.retrieved(window, length):
                    inside = np.flatnonzero(np.isin(window, self.sets[i]))
                    share = len(np.unique(window[inside])) / len(self.sets[i])
                    if share < CONTAINMENT:
                        continue
                    a, b = start + int(inside[0]), start + int(inside[-1]) + SHINGLE - 1
                    before = finds.setdefault(i, [])
                    if before and a <= before[-1][2]:
                        before[-1] = [max(share, before[-1][0]), min(a, before[-1][1]), max(b, before[-1][2])]
                    else:
                        before.append([share, a, b])
        return [(self.names[i], *f) for i in sorted(finds) for f in finds[i]]


def _held(sorted_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys are in a sorted array."""
    if not len(sorted_):
        return np.zeros(len(keys), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, keys), len(sorted_) - 1)] == keys


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, license, containment, start, end): every find in every text, its place in code points."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = TEMPLATES if templates is None else templates

    def make():
        scanner = Scanner(chosen)

        def fn(cols):
            rows = []
            for doc, text in zip(*cols):
                found = scanner.scan(text)
                if found:
                    places = [m.span() for m in re.finditer(WORD, text.lower())]
                    rows += [(doc, n, s, places[a][0], min(places[b][1], len(text))) for n, s, a, b in found]
            return [list(c) for c in zip(*rows)]

        return fn

    return map_rows(docs.select("doc_id", "text"), make, f"doc_id {kind}, license string, containment double, start bigint, end bigint")
