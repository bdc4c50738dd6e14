"""License notices by conditional compression.

A candidate block is the words around a cue, placed so that the cue lies on one
of a template's own: as many words as the template has and, on both sides, as
many more as may be added.  Words are counted as they are compared, so comment
marks are none.  Every block is compressed alone and with the template as
zstandard raw dictionary; a template that saves nothing is no candidate.

A candidate is confirmed by the exact wording differences: words of the
template that are missing, words of the block that the template lacks.  What
stands before the first and after the last common word is no part of the
notice.  Licenses share much of their wording, so several templates may be
confirmed for the same words: all of them then compress the block that they
cover together, and the one with the largest size reduction is the license.

Only texts with a cue word leave the scan (a JVM filter); a third of all rows
in one source or one group of copies changes nothing, as rows are independent.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache, partial

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import documents

#: Part of a template's words that a block must have, in order.
MIN_WORDING = 0.8
#: Words that a candidate has beyond its template's on each side, at least.
MORE_WORDS = 4

# Wordings of well-known license notices.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."),
    "All rights reserved": "All rights reserved.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License."),
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
        "other materials provided with the distribution. 3. Neither the name of the copyright holder "
        "nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission."),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "This work is licensed under CC0 1.0 Universal.",
    "CC0-1.0 notice": (
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights "
        "to this software to the public domain worldwide. This software is distributed without any warranty."),
    "CC0-1.0 waiver": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0 notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."),
    "GPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-2.1 notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Public domain": "Released into the public domain.",
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."),
}
#: A notice has one of these.
CUES = r"(?i)licen[cs]|permission|redistribut|free\W+software|public\W+domain|all\W+rights\W+reserved|waived\W+all\W+copyright"
_KINDS = CUES.removeprefix("(?i)").split("|")
_CUE = re.compile("(?i)" + "|".join(f"({kind})" for kind in _KINDS))
_WORD = re.compile(r"\S+")

FOUND = "array<struct<start:int,end:int,license:string,plain_bytes:int,template_bytes:int,missing:array<string>,extra:array<string>>>"
_FOUND = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("license", pa.string()), ("plain_bytes", pa.int32()),
                    ("template_bytes", pa.int32()), ("missing", pa.list_(pa.string())), ("extra", pa.list_(pa.string()))])


def words_of(text: str) -> list[str]:
    """Words to compare: lower case, without outer punctuation."""
    return [w for w in (x.strip(".,;:()[]\"'*#/-").lower() for x in text.split()) if w]


def places(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int]]]:
    """(start, end and form of the words to compare; which word each cue is in, and the cue's kind)."""
    words = [(m.start(), m.end(), w[0]) for m in _WORD.finditer(text) if (w := words_of(m.group()))]
    begins = [b for b, _, _ in words]
    return words, [(bisect_right(begins, m.start()) - 1, m.lastindex) for m in _CUE.finditer(text)]


class Templates:
    def __init__(self, wordings: dict[str, str]):
        self.names = list(wordings)
        self.words = {n: words_of(t) for n, t in wordings.items()}
        self.bag = {n: Counter(w) for n, w in self.words.items()}
        self.more = {n: max(MORE_WORDS, int((1 - MIN_WORDING) * len(w)) + 1) for n, w in self.words.items()}
        # by kind of cue: the templates that have it and where
        self.cued: dict[int, dict[str, list[int]]] = defaultdict(lambda: defaultdict(list))
        for n, t in wordings.items():
            for at, kind in places(t)[1]:
                self.cued[kind][n].append(at)
        self.plain = zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=False)
        self.given = {
            n: zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=False, write_dict_id=False,
                                        dict_data=zstandard.ZstdCompressionDict(t.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            for n, t in wordings.items()}
        # blocks recur (whole notices are copied): bounded memory of their results
        self.sizes = lru_cache(1 << 16)(self._sizes)
        self.differences = lru_cache(1 << 14)(self._differences)

    def _sizes(self, name: str, block: str) -> tuple[int, int]:
        data = block.encode("utf-8", "surrogatepass")
        return len(self.plain.compress(data)), len(self.given[name].compress(data))

    def _differences(self, name: str, have: tuple[str, ...]) -> tuple[tuple[str, ...], tuple[str, ...], int, int, int, int]:
        """(missing, extra, words in common, first and end of the words that
        count, where the template's first word would lie)."""
        want = self.words[name]
        same = [m for m in SequenceMatcher(None, want, have, autojunk=False).get_matching_blocks() if m.size]
        if not same:
            return tuple(want), (), 0, 0, 0, 0
        # a stray word far before the notice, or after it, is none of its words
        while len(same) > 1 and same[1].b - same[0].b - same[0].size > 2 * same[0].size:
            same.pop(0)
        while len(same) > 1 and same[-1].b - same[-2].b - same[-2].size > 2 * same[-1].size:
            same.pop()
        first, upto = same[0].b, same[-1].b + same[-1].size
        kept_a = {i for m in same for i in range(m.a, m.a + m.size)}
        kept_b = {i for m in same for i in range(m.b, m.b + m.size)}
        return (tuple(w for i, w in enumerate(want) if i not in kept_a),
                tuple(have[i] for i in range(first, upto) if i not in kept_b), len(kept_a), first, upto, first - same[0].a)

    def candidates(self, text: str, words: list[tuple[int, int, str]], cues: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
        """(template, first word, end) of the blocks that their template makes smaller."""
        spots = {(n, max(0, at - i)) for at, kind in cues for n, own in self.cued[kind].items() for i in own}
        out = []
        for n, place in sorted(spots):
            first, end = max(0, place - self.more[n]), min(len(words), place + len(self.words[n]) + self.more[n])
            plain, given = self.sizes(n, text[words[first][0]:words[end - 1][1]])
            if given < plain:
                out.append((n, first, end))
        return out

    def confirmed(self, name: str, words: list[tuple[int, int, str]], first: int, end: int) -> tuple | None:
        """(missing, extra, first and end word) of a block whose differences are few enough.

        A block that a cue put beside the notice is moved onto it: to where its
        first common word has its place in the template.
        """
        want, more = len(self.words[name]), self.more[name]
        found = None
        while True:
            have = tuple(w for _, _, w in words[first:end])
            # words in common, in order, are never more than in any order
            if (Counter(have) & self.bag[name]).total() < MIN_WORDING * want:
                return found
            missing, extra, common, a, b, start = self.differences(name, have)
            if found and len(missing) + len(extra) >= len(found[0]) + len(found[1]):
                return found
            if common >= MIN_WORDING * want and len(extra) <= (1 - MIN_WORDING) * want + 1:
                found = missing, extra, first + a, first + b
            elif found is None:
                return None
            place = first + start
            first, end = max(0, place - more), min(len(words), max(0, place) + want + more)

    def scan(self, text: str) -> list[dict]:
        """Confirmed notices of a text, in order, none overlapping another."""
        words, cues = places(text)
        found: dict[tuple[int, int, str], tuple] = {}
        for name, first, end in self.candidates(text, words, cues):
            notice = self.confirmed(name, words, first, end)
            if notice:
                missing, extra, begin, upto = notice
                found[begin, upto, name] = missing, extra
        kept: list[dict] = []
        todo = [sorted(found)]
        while todo:
            some = todo.pop()
            # notices that overlap, one or several steps apart
            groups: list[list[tuple[int, int, str]]] = []
            reach = -1
            for notice in some:
                if notice[0] >= reach:
                    groups.append([])
                groups[-1].append(notice)
                reach = max(reach, notice[1])
            for group in groups:
                block = text[words[group[0][0]][0]:words[max(n[1] for n in group) - 1][1]]
                saved = {n: self.sizes(n[2], block) for n in group}
                # the largest reduction; where one template lies twice, its nearest wording
                best = max(group, key=lambda n: (saved[n][0] - saved[n][1], n[2], -sum(map(len, found[n])), -n[0]))
                missing, extra = found[best]
                kept.append({"start": words[best[0]][0], "end": words[best[1] - 1][1], "license": best[2], "plain_bytes": saved[best][0],
                             "template_bytes": saved[best][1], "missing": list(missing), "extra": list(extra)})
                rest = [n for n in group if n[1] <= best[0] or n[0] >= best[1]]
                if rest:
                    todo.append(rest)
        return sorted(kept, key=lambda f: f["start"])


def _scan(batches: Iterator[pa.RecordBatch], wordings: dict[str, str]) -> Iterator[pa.RecordBatch]:
    templates = Templates(wordings)
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([templates.scan(t.as_py()) for t in batch.column(1)], pa.list_(_FOUND))], ["id", "notices"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", wordings: dict[str, str] = TEMPLATES) -> DataFrame:
    """``(id, notices)`` for every row whose text has a cue word.

    A null or empty text has none and gives no row; a cue without a confirmed
    notice gives an empty list.  Repeated rows and null ids give their rows.
    Templates that save the same are told apart by name only.  ``plain_bytes``
    and ``template_bytes`` are the sizes of the block that the notice was
    ranked on.
    An empty table gives an empty result.
    """
    rows = docs.where(F.col(text_col).rlike(CUES)).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(partial(_scan, wordings=wordings), f"id {dict(rows.dtypes)['id']}, notices {FOUND}")


def query(spark, sf_dir):
    """op9: every confirmed license notice of the documents table."""
    return (scan(documents(spark, sf_dir)).select(F.col("id").alias("doc_id"), F.explode("notices").alias("f"))
            .select("doc_id", F.col("f.start").alias("start"), F.col("f.end").alias("end"), F.col("f.license").alias("license"),
                    "f.plain_bytes", "f.template_bytes", F.size("f.missing").alias("n_missing"), F.size("f.extra").alias("n_extra")))
