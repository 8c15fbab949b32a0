"""License scan: MinHash bands over overlapping text windows retrieve templates, shingle containment verifies them.

Templates are the paragraphs of license texts and notices, and short statements made from names and forms of words.  A
template of m words is looked for in windows of the least size of which three quarters hold it with an eighth of its words
added; windows begin at every quarter of their size, so any such stretch lies whole in one.  A window has ``BANDS`` minima
of its shingles, each a band of one row; a template is retrieved if one is equal.  The Jaccard similarity of a window and
a template of which it holds three quarters is 0.31 at least (sizes grow by a third or a half), so a pair meets with
probability 1 - 0.69^BANDS, over 0.9998.  A retrieved template counts if at least ``least`` of its shingles are in the
window; of overlapping finds the one with the highest containment stays.

Words are runs of letters and digits, A-Z as a-z, so punctuation and line breaks inside a notice do not matter.  A shingle
is five words; of a template of fewer than ``SHORT`` words, three.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, shared

BANDS, SHORT = 24, 40
#: Words of windows; all are multiples of 4.
SIZES = (8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512, 768, 1024)

# Names of public licenses, by SPDX name.
NAMES = {
    "0BSD": ["Zero-Clause BSD License", "BSD Zero Clause License", "0BSD license"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPL v3", "AGPLv3"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License", "Apache-2.0 license"],
    "Artistic-2.0": ["Artistic License 2.0", "Artistic License, version 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License", "two-clause BSD license"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "Modified BSD License", "three-clause BSD license"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons CC BY 4.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution 4.0 license"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-SA-3.0": ["CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 3.0 Unported License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal Public Domain Dedication", "Creative Commons Zero license"],
    "CDDL-1.0": ["Common Development and Distribution License", "CDDL 1.0"],
    "ECL-2.0": ["Educational Community License, Version 2.0"],
    "EPL-1.0": ["Eclipse Public License 1.0", "Eclipse Public License v1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "EPL 2.0"],
    "EUPL-1.2": ["European Union Public Licence 1.2", "EUPL 1.2"],
    "GFDL-1.3": ["GNU Free Documentation License, Version 1.3", "GNU Free Documentation License"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU GPL v2", "GPL version 2", "GPLv2 license"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPL version 3", "GPLv3 license"],
    "ISC": ["ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1", "LGPL 2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPLv3 license"],
    "MIT": ["MIT License", "MIT license agreement", "Expat license"],
    "MPL-1.1": ["Mozilla Public License, Version 1.1", "MPL 1.1"],
    "MPL-2.0": ["Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "MS-PL": ["Microsoft Public License", "Ms-PL license"],
    "NCSA": ["University of Illinois/NCSA Open Source License"],
    "ODbL-1.0": ["Open Database License", "Open Data Commons Open Database License"],
    "OFL-1.1": ["SIL Open Font License, Version 1.1", "SIL Open Font License"],
    "OSL-3.0": ["Open Software License version 3.0"],
    "PostgreSQL": ["PostgreSQL License"],
    "PSF-2.0": ["Python Software Foundation License Version 2", "PSF license"],
    "Unlicense": ["Unlicense", "The Unlicense"],
    "WTFPL": ["Do What The Fuck You Want To Public License", "WTFPL license"],
    "X11": ["X11 License", "MIT/X11 license"],
    "Zlib": ["zlib License", "zlib/libpng license"],
}
FORMS = [
    "licensed under {}", "licensed under the {}", "released under {}", "released under the {}", "distributed under the {}", "available under the {}",
    "under the terms of the {}", "this work is licensed under a {}", "this work is licensed under the {}", "is covered by the {}", "dual licensed under the {}",
]
# Paragraphs of license texts and of the notices that they ask for.
PARAGRAPHS = {
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program. If not, see https://www.gnu.org/licenses/",
    ],
    "Apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES',
    ],
    "BSD-3-Clause": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "BSL-1.0": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software"],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights", "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law"],
    "CDDL-1.0": ["The contents of this file are subject to the terms of the Common Development and Distribution License (the \"License\"). You may not use this file except in compliance with the License."],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "EUPL-1.2": ["Licensed under the EUPL, Version 1.2 or as soon they will be approved by the European Commission, subsequent versions of the EUPL (the \"Licence\"); You may not use this work except in compliance with the Licence."],
    "GFDL-1.3": ["Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation; with no Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts."],
    "GPL": [
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/",
    ],
    "GPL-2.0": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "GPL-3.0": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "LGPL-2.1": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "LGPL-3.0": ["This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "MIT": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "OFL-1.1": ["This Font Software is licensed under the SIL Open Font License, Version 1.1. This license is copied below, and is also available with a FAQ at https://scripts.sil.org/OFL"],
    "PostgreSQL": ["Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "WTFPL": ["Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed."],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"],
}


def templates() -> list[tuple[str, str]]:
    """(license, text) of all paragraphs, tags, and statements made from names and forms."""
    out = [(name, text) for name, texts in PARAGRAPHS.items() for text in texts]
    out += [(name, f"SPDX-License-Identifier: {name}{more}") for name in NAMES for more in ("", "-only", "-or-later") if not more or "GPL" in name]
    return out + [(name, form.format(spoken)) for name, all_ in NAMES.items() for spoken in all_ for form in FORMS]


_SOLID = np.zeros(256, bool)
_SOLID[48:58] = _SOLID[65:91] = _SOLID[97:123] = _SOLID[128:] = True
_SEEDS = arrays.mix(np.arange(1, BANDS + 1, dtype=np.uint64)) | np.uint64(1)


def _words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.where(_SOLID[buf], arrays.LOWER[buf], np.uint8(32))
    starts, ends, first = arrays.words(low, off)
    return arrays.Rolling(low).of(starts, ends), first


class Templates:
    """Shingle sets of all templates, and for each length of shingles and size of windows their minima by band."""

    def __init__(self, texts: list[tuple[str, str]], k: int):
        self.names, self.size, self.sets, self.k = [], [], [], []
        by: dict[tuple[int, int], list[int]] = {}
        for name, text in sorted(set(texts)):
            raw = np.frombuffer(text.encode(), np.uint8)
            h, _ = _words(raw, np.array([0, len(raw)]))
            if not len(h):
                continue
            span = min(k if len(h) >= SHORT else 3, len(h))
            room = next((w for w in SIZES if 3 * w >= 4 * (len(h) + len(h) // 8)), 4 * (len(h) // 2))
            by.setdefault((span, room), []).append(len(self.names))
            self.names.append(name)
            self.size.append(len(h))
            self.sets.append(np.unique(arrays.window_hash(h, span)))
            self.k.append(span)
        self.windows: dict[int, list[tuple[int, list]]] = {}
        for (span, room), own in sorted(by.items()):
            bands = []
            for seed in _SEEDS:
                least = np.array([(self.sets[t] * seed).min() for t in own], np.uint64)
                order = np.argsort(least, kind="stable")
                table = np.zeros(1 << 16, bool)
                table[(least & np.uint64(0xFFFF)).astype(np.int64)] = True
                bands.append((table, least[order], np.array(own)[order]))
            self.windows.setdefault(span, []).append((room, bands))

    def retrieved(self, grams: np.ndarray, span: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, first shingle, template) of the windows that share a band with a template."""
        found: dict[int, list[np.ndarray]] = {}
        sizes = [room for room, _ in self.windows[span]]
        n, number = -(-len(grams) // max(sizes)) * max(sizes) + max(sizes), len(self.names)
        for band, seed in enumerate(_SEEDS):
            least = {1: np.full(n, ~np.uint64(0), np.uint64)}
            np.multiply(grams, seed, out=least[1][: len(grams)])
            for room, bands in self.windows[span]:
                own = _blocks(least, room // 4)
                own = np.minimum(own[:-1], own[1:])
                own = np.minimum(own[:-2], own[2:])
                table, values, of = bands[band]
                at = np.flatnonzero(table[(own & np.uint64(0xFFFF)).astype(np.int64)])
                lo, hi = np.searchsorted(values, own[at]), np.searchsorted(values, own[at], "right")
                if (hi > lo).any():
                    found.setdefault(room, []).append(np.repeat(at * (room // 4), hi - lo) * number + of[arrays.ragged(lo, hi - lo)])
        for room, keys in found.items():
            key = np.unique(np.concatenate(keys))
            yield room, key // number, key % number

    def find(self, words: np.ndarray, first: np.ndarray, least: float) -> dict[int, list[tuple[int, int, int, float]]]:
        """By text: (template, first word, words, containment), overlapping weaker finds left out."""
        found: dict[int, set[tuple[int, int, int, float]]] = {}
        rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for span in self.windows:
            grams = arrays.window_hash(words, span)
            if not len(grams):
                continue
            for room, starts, of in self.retrieved(grams, span):
                for s, t in zip(starts.tolist(), of.tolist(), strict=True):
                    own = grams[s : s + room]
                    known = self.sets[t]
                    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    hit = s + np.flatnonzero(known[at] == own)
                    hit = hit[hit + span <= first[rows[hit] + 1]]  # inside one text
                    if len(hit) < least * len(known):
                        continue
                    for row in np.unique(rows[hit]).tolist():
                        mine = hit[rows[hit] == row]
                        share = len(np.unique(grams[mine])) / len(known)
                        if share >= least:
                            begin = int(mine[0] - first[row])
                            found.setdefault(row, set()).add((t, begin, int(mine[-1] - mine[0]) + span, share))
        out = {}
        for row, all_ in found.items():
            taken = np.zeros(int(first[row + 1] - first[row]), bool)
            kept = []
            for x in sorted(all_, key=lambda x: (-x[3], -self.size[x[0]], x[1], x[2], x[0])):
                if not taken[x[1] : x[1] + x[2]].any():
                    kept.append(x)
                    taken[x[1] : x[1] + x[2]] = True
            out[row] = sorted(kept, key=lambda x: x[1])
        return out


def _blocks(least: dict[int, np.ndarray], size: int) -> np.ndarray:
    """Minima of consecutive blocks of ``size`` (2 or 3 times a power of two), each from those of half or a third of it."""
    if size not in least:
        if size == 3:
            x = least[1][: len(least[1]) // 3 * 3]
            least[3] = np.minimum(np.minimum(x[0::3], x[1::3]), x[2::3])
        else:
            x = _blocks(least, size // 2)
            x = x[: len(x) // 2 * 2]
            least[size] = np.minimum(x[0::2], x[1::2])
    return least[size]


def license_scan(docs: DataFrame, texts: list[tuple[str, str]] | None = None, k: int = 5, least: float = 0.75) -> DataFrame:
    """(doc_id, license, first_word, n_words, containment), a row for each notice found in each row of ``docs``.

    ``docs`` has doc_id and text; ``texts`` are (license, text), by default ``templates()``.  A find goes from the first to
    the last shingle of the template in a window.  Ties of overlapping finds go to the longer template, then the earlier
    place, then the first name.

    Null and empty texts hold nothing.  Repeated rows are scanned each for itself; a null doc_id is returned as
    null.  A text is read in one piece, in memory of some 60 times its size.  Other columns are ignored, whatever their
    names; an empty table, or no templates, gives no rows.
    """
    spark = docs.sparkSession
    shared.ship(spark)
    held = spark.sparkContext.broadcast(Templates(templates() if texts is None else texts, k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            out: list[tuple] = []
            for a, _, buf, off in arrays.text_pieces(batch, "text"):
                for i, finds in sorted(known.find(*_words(buf, off), least).items()):
                    out += [(batch.column(0)[a + i].as_py(), known.names[t], begin, m, share) for t, begin, m, share in finds]
            if out:
                types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], ["doc_id", "license", "first_word", "n_words", "containment"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(arrays.lean(run), "doc_id long, license string, first_word long, n_words long, containment double")
