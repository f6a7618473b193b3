"""License scans: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them.

Texts are sets of word 5-grams (shorter templates are one gram of all their words). Templates are grouped by size s, the
next power of two of their number of grams; a text's windows for a group have 2s grams and start every s, so that any passage of
s grams lies in one window, whose Jaccard similarity with the template is more than 1/4. Of BANDS one-row bands one is
equal with probability 1 - (3/4)^BANDS at least, and a retrieved template counts if CONTAINED of its grams are in the window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Hashes, mix64, slices, table, texts_of
from .decontaminate import words

N, CONTAINED, BANDS = 5, 0.8, 32
#: Public licenses, whole where they are short, and the notices and headers by which texts refer to long ones.
TEMPLATES = {
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. "
        "You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."
    ),
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
        "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause-endorsement": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    ),
    "BSD-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    ),
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, "
        "and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: "
        "The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, "
        "unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor."
    ),
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-long-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-ND-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "CC-BY-NC-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-SA-3.0-notice": "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "EPL-2.0-header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "GFDL-1.3-header": (
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation; "
        "with no Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts."
    ),
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ),
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."
    ),
    "LGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "MIT-whole": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MIT-notice": "Released under the MIT License.",
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "WTFPL": "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.",
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
    ),
}


_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


def grams(h: np.ndarray, n: int = N) -> np.ndarray:
    out = np.zeros(max(0, len(h) - n + 1), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + len(out)]
    return mix64(out)


class Templates:
    """Bands of the templates by group (grams of n words, size s)."""

    def __init__(self, texts: dict[str, str], bands: int = BANDS):
        hashes = Hashes()
        self.bands, self.sets, self.groups = bands, {}, {}
        for name, text in sorted(texts.items()):
            w = words(text.encode())
            if not w:
                continue
            n = min(N, len(w))
            g = np.unique(grams(hashes.of(w), n))
            self.sets[name] = g
            s = 1 << (len(g) - 1).bit_length()
            self.groups.setdefault((n, s), []).append(name)
        self.keys = {}
        for key, names in self.groups.items():
            for band in range(bands):
                least = np.array([mix64(self.sets[name], band).min() for name in names], np.uint64)
                order = np.argsort(least, kind="stable")
                some = np.zeros(1 << 16, bool)
                some[(least >> np.uint64(48)).astype(np.int64)] = True
                self.keys[key, band] = (least[order], [names[i] for i in order], some)

    def scan(self, texts: list[np.ndarray]) -> list[dict[str, tuple[int, float]]]:
        """For each text's word hashes: template -> (windows that hold it, the largest containment). The texts are laid end to
        end; grams across their borders take no part, and windows across them are verified text by text."""
        found: list[dict[str, dict[int, float]]] = [{} for _ in texts]
        h = np.concatenate(texts) if texts else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        for n in {n for n, _ in self.groups}:
            g = grams(h, n)
            if not len(g):
                continue
            across = owner[: len(g)] != owner[n - 1 : n - 1 + len(g)]
            sizes = sorted(s for m, s in self.groups if m == n)
            likely: set[tuple[int, int, str]] = set()
            for band in range(self.bands):
                block, width = mix64(g, band), 1
                block[across] = _MOST
                for s in sizes:
                    while width < s:  # least of each s grams
                        block = np.append(block, _MOST) if len(block) % 2 else block
                        block, width = np.minimum(block[0::2], block[1::2]), 2 * width
                    keys, names, some = self.keys[(n, s), band]
                    least = block.copy()
                    np.minimum(block[:-1], block[1:], out=least[:-1])
                    for i in np.flatnonzero(some[(least >> np.uint64(48)).astype(np.int64)]).tolist():
                        for k in range(int(np.searchsorted(keys, least[i])), len(keys)):
                            if keys[k] != least[i]:
                                break
                            likely.add((i, s, names[k]))
            for i, s, name in likely:
                t, window = self.sets[name], slice(i * s, i * s + 2 * s)
                inside, whose = g[window][~across[window]], owner[: len(g)][window][~across[window]]
                for d in np.unique(whose).tolist():
                    share = len(np.intersect1d(np.unique(inside[whose == d]), t, assume_unique=True)) / len(t)
                    if share >= CONTAINED:
                        found[d].setdefault(name, {})[i] = share
        return [{name: (len(w), max(w.values())) for name, w in f.items()} for f in found]


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, licenses (names, sorted), containment (the largest for each), n_licenses.

    A null or empty text holds none; texts of any length are read whole. A template with exactly CONTAINED of its grams in a window counts, and so do all that
    fit, the long form of a license beside its short one. Repeated rows are scanned each, null ids are kept, an empty table gives
    none; other columns are ignored. Templates are a parameter and are sent to executors: a few thousand texts at most."""
    texts = dict(TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, hashes = Templates(texts), Hashes()
        for batch in slices(batches, "text", 1 << 20):
            found = index.scan([hashes.of(words(t)) for t in texts_of(batch, "text")])
            names = [sorted(f) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(names, pa.list_(pa.string())),
                    pa.array([[f[x][1] for x in n] for f, n in zip(found, names)], pa.list_(pa.float64())),
                    pa.array([len(n) for n in names], pa.int32()),
                ],
                names=["doc_id", "licenses", "containment", "n_licenses"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, licenses array<string>, containment array<double>, n_licenses int")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.concat_ws(",", "licenses").alias("licenses"), F.coalesce(F.array_max("containment"), F.lit(0.0)).alias("containment"), "n_licenses")
