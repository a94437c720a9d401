"""License scans: passages compared with licence templates by the Dice coefficient over word bigrams.

Texts are normalised: lower case, words of letters and digits, all else dropped.
For a template of m bigrams to reach the threshold t, a passage needs at least
t / (2 - t) * m of them and may hold at most (2 - t) / t * m in all; the first
bound drops nearly every (text, template) pair from hashed bigrams of a whole
batch at once, the second bounds the passages that are tried.  What is left is
scored on the words themselves.  Of passages that overlap, the best counts.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hashing
from .common import prepare, table

THRESHOLD = 0.8

#: (SPDX-like name, text).  Fixed values: public notices and licence texts.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    ),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("Artistic-2.0", "This is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0."),
    ("Artistic-1.0", "This library is free software; you can redistribute it and/or modify it under the same terms as Perl itself."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

_WORDS = re.compile(rb"[a-z0-9\x80-\xff]+")
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(ord("a"), ord("z") + 1), *range(ord("0"), ord("9") + 1), *range(0x80, 0x100)]] = True


def normalise(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def bigrams(words: list[bytes]) -> list[tuple[bytes, bytes]]:
    return list(zip(words, words[1:], strict=False))


class Matcher:
    """Templates ready for batches of texts."""

    def __init__(self, templates: Iterable[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD):
        if not 0 < threshold <= 1:
            raise ValueError("the threshold lies in (0, 1]")
        self.t = threshold
        self.names, self.grams = [], []
        for name, text in templates:
            if g := bigrams(_WORDS.findall(normalise(text))):
                self.names.append(name)
                self.grams.append(Counter(g))
        self.sizes = [sum(g.values()) for g in self.grams]
        self.need = [int(np.ceil(threshold / (2 - threshold) * m - 1e-9)) for m in self.sizes]
        self.most = [int((2 - threshold) / threshold * m + 1e-9) for m in self.sizes]
        codes: dict[int, list[tuple[int, int]]] = {}
        for i, g in enumerate(self.grams):
            for (a, b), n in g.items():
                h = int(self._hash(a + b" " + b)[0])
                codes.setdefault(h, []).append((i, n))
        self.codes = np.array(sorted(codes), np.uint64)
        self.holders = [codes[int(c)] for c in self.codes]

    @staticmethod
    def _hash(raw: bytes) -> np.ndarray:
        buffer = np.frombuffer(raw + b"\n", np.uint8)
        s, e = hashing.runs(_IN_WORD[buffer])
        h = hashing.Ranges(buffer)(s, e)
        return hashing.mixed(h[:-1] * np.uint64(3) + h[1:])

    def possible(self, raws: list[bytes]) -> list[list[int]]:
        """Templates that each text may hold by the least overlap, from hashed bigrams."""
        out: list[list[int]] = [[] for _ in raws]
        for first, part in hashing.steps(raws):
            buffer, begin = hashing.join(part)
            s, e = hashing.runs(_IN_WORD[buffer])
            if len(s) < 2:
                continue
            h = hashing.Ranges(buffer)(s, e)
            both = hashing.mixed(h[:-1] * np.uint64(3) + h[1:])
            doc = np.searchsorted(begin, s, side="right") - 1
            k = np.minimum(np.searchsorted(self.codes, both), len(self.codes) - 1)
            hit = np.flatnonzero((self.codes[k] == both) & (doc[1:] == doc[:-1]))
            pairs, times = np.unique(np.stack([doc[hit], k[hit]], axis=1), axis=0, return_counts=True)
            counts: dict[tuple[int, int], int] = {}
            for (d, c), n in zip(pairs.tolist(), times.tolist(), strict=True):
                for i, m in self.holders[c]:
                    counts[d, i] = counts.get((d, i), 0) + min(n, m)
            for (d, i), n in counts.items():
                if n >= self.need[i]:
                    out[first + d].append(i)
        return out

    def score(self, raw: bytes, templates: list[int]) -> list[tuple[float, int, int, int]]:
        """(dice, first word, end word, template) of passages at or above the threshold; of overlapping ones the best."""
        grams = bigrams(_WORDS.findall(raw))
        found = []
        for i in templates:
            want, m = self.grams[i], self.sizes[i]
            hits = [p for p, g in enumerate(grams) if g in want]
            for a, start in enumerate(hits):
                seen: Counter = Counter()
                common = 0
                for end in hits[a:]:
                    if end - start >= self.most[i]:
                        break
                    g = grams[end]
                    seen[g] += 1
                    common += seen[g] <= want[g]
                    dice = 2 * common / (end - start + 1 + m)
                    if dice >= self.t:
                        found.append((dice, start, end + 2, i))
        found.sort(key=lambda f: (-f[0], -self.sizes[f[3]], f[1], self.names[f[3]]))
        out: list[tuple[float, int, int, int]] = []
        starts: list[int] = []  # of what is taken, in order; taken passages don't overlap
        for f in found:
            k = bisect_left(starts, f[1])
            if (k == 0 or out[k - 1][2] <= f[1]) and (k == len(out) or out[k][1] >= f[2]):
                starts.insert(k, f[1])
                out.insert(k, f)
        return out

    def match(self, texts: list[str | None]) -> list[list[dict]]:
        raws = [normalise(t or "") for t in texts]
        return [
            [{"license": self.names[i], "dice": d, "first_word": s, "end_word": e} for d, s, e, i in self.score(r, sorted(p))] if p else []
            for r, p in zip(raws, self.possible(raws), strict=True)
        ]


def scan(docs: DataFrame, text: str = "text", templates: Iterable[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, name: str = "licenses") -> DataFrame:
    """All columns of ``docs`` and ``licenses``: array of (license, dice, first_word, end_word) by place.

    Word numbers count normalised words; the end is exclusive.  Null, empty and
    licence-free texts have an empty array.  Row by row and whole texts, so repeated
    rows agree; of passages that overlap with one score, the larger template's, then
    the earlier counts.  An empty table gives no rows; a column named like the result
    is replaced, and other names may clash with nothing.
    """
    prepare(docs.sparkSession)
    templates = list(templates)
    held: list[Matcher] = []

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if not held:
            held.append(Matcher(templates, threshold))
        for part in parts:
            yield pd.Series(held[0].match(list(part)), dtype=object)

    kind = "array<struct<license: string, dice: double, first_word: int, end_word: int>>"
    return docs.withColumn(name, F.pandas_udf(run, kind)(F.col(text)))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    best = F.get(F.sort_array(F.transform("licenses", lambda m: F.struct((-m["dice"]).alias("d"), m["license"].alias("l")))), F.lit(0))
    listed = F.array_join(F.transform("licenses", lambda m: F.concat_ws(":", m["license"], m["first_word"].cast("string"), m["end_word"].cast("string"))), ",")
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_matches"), best["l"].alias("license"), (-best["d"]).alias("dice"), listed.alias("matches"))
