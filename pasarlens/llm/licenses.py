"""Licence scans: a positional index of rare licence words, template alignment, mandatory key phrases.

Words are runs of digits, letters and characters beyond ASCII, with A-Z in lower case. A template's word positions are indexed.
In a text the words with the highest inverse template frequency are looked up; a template is proposed where enough of
its rare words stand at the same relative position, and named only if its key phrases stand there in full.

Results in special cases: a null text is the empty text (no words, no labels, score 0); a null id is passed on; repeated rows are
scanned one by one; an empty table gives an empty result; other columns are ignored. A text of any length is scanned whole; of
templates that match equally well all are labels.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasarlens.llm.scratch import bounded_batches
from pasarlens.llm.text_arrays import byte_class, find_words, pieces

#: Phrases that always count, with their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Label, words, and key phrases among them that must stand in full. Licences are whole, in parts between the places
#: where names, years or numbers of clauses are filled in; of long licences it is the notice that their authors ask for.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files", ("granted free of charge", "associated documentation files")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", ("source and binary forms", "following conditions are met")),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
     "with the license", ("apache license version 2 0",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation", ("gnu general public license",)),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
     "public license as published by the free software foundation", ("gnu lesser general public license",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ("mozilla public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", ("with or without fee",)),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     ("creative commons attribution",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("unencumbered software released into the public domain",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the rights to "
     "use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the "
     "software is furnished to do so subject to the following conditions the above copyright notice and this permission notice "
     "shall be included in all copies or substantial portions of the software the software is provided as is without warranty "
     "of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular "
     "purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other "
     "liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or "
     "the use or other dealings in the software",
     ("deal in the software without restriction", "copies or substantial portions of the software")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
     "provided that the above copyright notice and this permission notice appear in all copies the software is provided as is "
     "and the author disclaims all warranties with regard to this software including all implied warranties of "
     "merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential "
     "damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence "
     "or other tortious action arising out of or in connection with the use or performance of this software",
     ("this permission notice appear in all copies", "the author disclaims all warranties")),
    ("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
     "the software is provided as is and the author disclaims all warranties with regard to this software",
     ("fee is hereby granted the software is provided",)),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following "
     "disclaimer", ("redistributions of source code must retain",)),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
     "disclaimer in the documentation and or other materials provided with the distribution",
     ("redistributions in binary form must reproduce",)),
    ("bsd-3-clause", "nor the names of its contributors may be used to endorse or promote products derived from this software "
     "without specific prior written permission", ("used to endorse or promote products derived from this software",)),
    ("bsd", "this software is provided by the copyright holders and contributors as is and any express or implied warranties "
     "including but not limited to the implied warranties of merchantability and fitness for a particular purpose are "
     "disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special "
     "exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use "
     "data or profits or business interruption however caused and on any theory of liability whether in contract strict "
     "liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised "
     "of the possibility of such damage",
     ("provided by the copyright holders and contributors as is", "advised of the possibility of such damage")),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable "
     "for any damages arising from the use of this software permission is granted to anyone to use this software for any "
     "purpose including commercial applications and to alter it and redistribute it freely subject to the following "
     "restrictions", ("alter it and redistribute it freely",)),
    ("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software if "
     "you use this software in a product an acknowledgment in the product documentation would be appreciated but is not "
     "required", ("origin of this software must not be misrepresented",)),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original "
     "software", ("altered source versions must be plainly marked",)),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
     "accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit "
     "the software and to prepare derivative works of the software and to permit third parties to whom the software is "
     "furnished to do so all subject to the following",
     ("any person or organization obtaining a copy", "use reproduce display distribute execute and transmit")),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form "
     "or as a compiled binary for any purpose commercial or non commercial and by any means",
     ("anyone is free to copy modify publish use compile sell or distribute",)),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it "
     "is allowed as long as the name is changed", ("changing it is allowed as long as the name is changed",)),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee "
     "and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the "
     "following two paragraphs appear in all copies",
     ("without a written agreement is hereby granted", "following two paragraphs appear in all copies")),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is "
     "distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for "
     "the specific language governing permissions and limitations under the license",
     ("software distributed under the license is distributed on an as is basis",)),
    ("gpl", "either version 2 of the license or at your option any later version this program is distributed in the hope that it "
     "will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular "
     "purpose see the gnu general public license for more details",
     ("at your option any later version", "gnu general public license for more details")),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general "
     "public license as published by the free software foundation", ("gnu affero general public license",)),
    ("mpl-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at",
     ("copy of the mpl was not distributed with this file",)),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license",
     ("eclipse public license",)),
    ("cc0-1.0", "to the extent possible under law the person who associated cc0 with this work has waived all copyright and related "
     "or neighboring rights to this work", ("waived all copyright and related or neighboring rights",)),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license",
     ("creative commons attribution sharealike",)),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
     ("creative commons attribution noncommercial",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("mit", "spdx license identifier mit", ("identifier mit",)),
    ("apache-2.0", "spdx license identifier apache 2 0", ("identifier apache 2 0",)),
)

#: Share of a template's rare words that must agree on one relative position.
AGREE = 0.6

FOLD = np.arange(256)
FOLD[65:91] += 32
INSIDE = byte_class(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


@dataclass(frozen=True)
class Index:
    vocabulary: np.ndarray  # sorted word hashes
    order: np.ndarray  # place in the vocabulary -> word id
    words: list[np.ndarray]  # word ids of each template
    rare: list[np.ndarray]  # positions of each template's rare words
    posting_start: np.ndarray  # by word id, into the two below
    posting_template: np.ndarray
    posting_position: np.ndarray
    keys: list[list[tuple[int, np.ndarray]]]  # of each template: offset and word ids of each key phrase
    base: list[tuple[str, np.ndarray]]


def _find(words: list[str], part: list[str]) -> int:
    return next(i for i in range(len(words)) if words[i : i + len(part)] == part)


@lru_cache(maxsize=1)
def template_index() -> Index:
    texts = [t.split() for _, t, _ in TEMPLATES]
    names = sorted({w for t in texts for w in t} | {w for p in BASE_PHRASES for w in p.split()})
    number = {w: i for i, w in enumerate(names)}
    encoded = [w.encode() for w in names]
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in encoded])])
    hashes = find_words(np.frombuffer(b"".join(encoded), np.uint8), offsets, INSIDE, FOLD).hashes
    order = np.argsort(hashes)
    found_in = Counter(w for t in texts for w in set(t))
    weight = {w: math.log((1 + len(texts)) / found_in[w]) for w in found_in}
    rare = []
    for t in texts:
        limit = sorted((weight[w] for w in t), reverse=True)[len(t) // 2]
        rare.append(np.array([i for i, w in enumerate(t) if weight[w] >= limit]))
    postings = sorted((number[texts[k][i]], k, int(i)) for k, places in enumerate(rare) for i in places)
    return Index(
        hashes[order],
        order,
        [np.array([number[w] for w in t]) for t in texts],
        rare,
        np.searchsorted([p[0] for p in postings], np.arange(len(names) + 1)),
        np.array([p[1] for p in postings]),
        np.array([p[2] for p in postings]),
        [
            [(_find(t, key.split()), np.array([number[w] for w in key.split()])) for key in keys]
            for t, (_, _, keys) in zip(texts, TEMPLATES, strict=True)
        ],
        [(label, np.array([number[w] for w in phrase.split()])) for phrase, label in BASE_PHRASES.items()],
    )


def _stands(ids: np.ndarray, row: np.ndarray, at: np.ndarray, own: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Whether the words ``part`` stand at places ``at`` of rows ``own``."""
    ok = (at >= 0) & (at + len(part) <= len(ids))
    safe = np.where(ok, at, 0)
    for j, word in enumerate(part):
        place = np.minimum(safe + j, len(ids) - 1)
        ok &= (ids[place] == word) & (row[place] == own)
    return ok


def _alignments(index: Index, ids: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Template, rows and share of its words, for every place where its rare words agree and its key phrases stand."""
    at = np.flatnonzero(ids >= 0)
    lengths = index.posting_start[ids[at] + 1] - index.posting_start[ids[at]]
    at, lengths = at[lengths > 0], lengths[lengths > 0]
    if not len(at):
        return
    first = index.posting_start[ids[at]]
    own = np.repeat(first - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
    begin = np.repeat(at, lengths) - index.posting_position[own]
    template = index.posting_template[own]
    # row, template and place in one number: a template may begin up to its own length before the first word
    before = max(map(len, index.words))
    span = len(ids) + before
    code = (np.repeat(row[at], lengths) * len(index.words) + template) * span + begin + before
    code, n = np.unique(code, return_counts=True)
    needed = np.array([max(1, math.ceil(AGREE * len(r))) for r in index.rare])
    code = code[n >= needed[code // span % len(needed)]]
    own, begins = code // span, code % span - before
    all_rows, which = own // len(needed), own % len(needed)
    for k in np.unique(which):
        rows, begins_k = all_rows[which == k], begins[which == k]
        ok = np.ones(len(rows), bool)
        for offset, part in index.keys[k]:
            ok &= _stands(ids, row, begins_k + offset, rows, part)
        rows, begins_k = rows[ok], begins_k[ok]
        share = np.zeros(len(rows))
        for j, word in enumerate(index.words[k]):
            share += _stands(ids, row, begins_k + j, rows, np.array([word]))
        yield int(k), rows, share / len(index.words[k])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = template_index()
    for batch in batches:
        for a, b, data, offsets in pieces(batch.column(1)):
            words = find_words(data, offsets, INSIDE, FOLD)
            place = np.minimum(np.searchsorted(index.vocabulary, words.hashes), len(index.vocabulary) - 1)
            ids = np.where(index.vocabulary[place] == words.hashes, index.order[place], -1)
            n = b - a
            n_base, first, last = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.full(n, -1, np.int64)
            base: list[set[str]] = [set() for _ in range(n)]
            more: list[set[str]] = [set() for _ in range(n)]
            score = np.zeros(n)
            for label, part in index.base:
                at = np.flatnonzero(ids == part[0])
                at = at[_stands(ids, words.row, at, words.row[at], part)]
                own, rel = words.row[at], at - words.offsets[words.row[at]]
                np.add.at(n_base, own, 1)
                np.maximum.at(last, own, rel)
                for r, p in zip(own.tolist(), rel.tolist(), strict=True):
                    first[r] = p if first[r] < 0 else min(first[r], p)
                    base[r].add(label)
                score[own] = 1.0
            for k, rows, share in _alignments(index, ids, words.row):
                np.maximum.at(score, rows, share)
                for r in rows.tolist():
                    more[r].add(TEMPLATES[k][0])
            none = first < 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, n),
                    pa.array(np.diff(words.offsets), pa.int64()),
                    pa.array(n_base),
                    pa.array(first, mask=none),
                    pa.array(last, mask=none),
                    pa.array([sorted(x) for x in base], pa.list_(pa.string())),
                    pa.array([sorted(x | y) for x, y in zip(base, more, strict=True)], pa.list_(pa.string())),
                    pa.array(score),
                ],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text with its licence labels. No shuffle."""
    bounded_batches(df.sparkSession)
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(
        _scan,
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels array<string>, labels array<string>, score double",
    )
