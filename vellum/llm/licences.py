"""Licence scans with a positional index of rare licence words.

``TEMPLATES`` holds notices and whole bodies of public licences by label; each has mandatory key phrases. One pass counts in how
many documents every licence word stands (partial sums; the vocabulary is bounded by the templates). The index holds, for each
template, postings of its rarest words only: so many that a place where ``AGREE`` of the template's words stand must have
``VOTES`` of them. Each posting that a document's words hit votes for a pair (template, relative position); pairs with enough
votes are where the postings intersect. They are verified: AGREE of the template's words must stand at their places and every
key phrase inside the span. A body (a template of BODY words or more) may also have words too many or too few: votes are added over
a band of offsets, and AGREE of its words must stand in order within the band (a banded longest common subsequence, all offsets of
a body at once). A key phrase stands as it is: a word put into one or taken out of it undoes the label. Base phrases are found exactly and always keep their label.

Both passes are per row without a shuffle of texts; the broadcast holds document frequencies of the template words only. Work is
linear in a text's words, but for verification, which costs a template's length a voted place.

Defined cases: a null or empty text has no words, no labels, score 0 and null places; very long texts are scanned whole; of words
that are equally rare the earlier one in the template is indexed; repeated rows are scanned each; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm._arrow import tidy

# The base phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Wording of public licences and of the usual notices, with the phrases that must be present.
TEMPLATES: list[tuple[str, str, tuple[str, ...]]] = [
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted", "free of charge")),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"),
        to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or
        sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
        WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
        NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
        CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
        ("permission is hereby granted free of charge", "the above copyright notice and this permission notice"),
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above
        copyright notice and this permission notice appear in all copies.""",
        ("permission to use copy modify", "with or without fee"),
    ),
    (
        "0bsd",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED
        "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES""",
        ("permission to use copy modify", "is hereby granted the software is provided"),
    ),
    (
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from
        the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
        redistribute it freely, subject to the following restrictions""",
        ("permission is granted to anyone to use this software", "redistribute it freely"),
    ),
    ("apache-2", "licensed under the apache license version 2 0", ("apache license", "version 2")),
    (
        "apache-2",
        """you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES
        OR CONDITIONS OF ANY KIND, either express or implied.""",
        ("except in compliance with the license", "apache org licenses"),
    ),
    ("apache-2", "you may not use this file except in compliance with the license", ("except in compliance with the license",)),
    (
        "apache-2",
        """each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce,
        prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.""",
        ("contributor hereby grants to you a perpetual worldwide", "derivative works"),
    ),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met""",
        ("redistribution and use", "source and binary forms"),
    ),
    (
        "bsd-2",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
        and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" """,
        ("redistribution and use in source and binary forms", "with the distribution this software is provided"),
    ),
    (
        "bsd-3",
        """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
        without specific prior written permission.""",
        ("endorse or promote products derived from this software",),
    ),
    ("gpl", "licensed under the gnu general public license version", ("gnu general public license",)),
    (
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free
        Software Foundation""",
        ("free software", "gnu general public license"),
    ),
    ("lgpl", "licensed under the gnu lesser general public license version", ("gnu lesser general public license",)),
    (
        "lgpl",
        """you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation""",
        ("gnu lesser general public license",),
    ),
    ("agpl", "licensed under the gnu affero general public license version", ("gnu affero general public license",)),
    (
        "agpl",
        """you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation""",
        ("gnu affero general public license",),
    ),
    (
        "mpl-2",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You
        can obtain one at""",
        ("mozilla public license",),
    ),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    (
        "epl",
        """The accompanying program is provided under the terms of this Eclipse Public License ("Agreement"). Any use, reproduction or distribution of the
        program constitutes recipient's acceptance of this agreement""",
        ("eclipse public license",),
    ),
    ("epl", "made available under the terms of the eclipse public license", ("eclipse public license",)),
    ("artistic-2", "licensed under the artistic license 2 0", ("artistic license 2 0",)),
    (
        "bsl-1",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered
        by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the
        Software""",
        ("any person or organization obtaining a copy",),
    ),
    ("bsl-1", "distributed under the boost software license version 1 0", ("boost software license",)),
    ("cc-by-nc", "licensed under cc by nc", ("cc by nc",)),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial license", ("creative commons attribution", "noncommercial")),
    ("cc-by-sa", "licensed under cc by sa", ("cc by sa",)),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    (
        "cc0",
        """To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this
        work.""",
        ("to the extent possible under law", "cc0"),
    ),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute
        this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
        ("free and unencumbered software", "public domain"),
    ),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
    # Titles.
    ("apache-2", "Apache License Version 2.0, January 2004", ("apache license version 2 0 january 2004",)),
    ("gpl-2", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", ("general public license version 2 june 1991",)),
    ("gpl-3", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", ("gnu general public license version 3 29 june 2007",)),
    ("lgpl-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", ("lesser general public license version 2 1 february 1999",)),
    ("lgpl-3", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", ("lesser general public license version 3 29 june 2007",)),
    ("agpl-3", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", ("affero general public license version 3 19 november 2007",)),
    ("mpl-2", "Mozilla Public License Version 2.0 1. Definitions", ("mozilla public license version 2 0",)),
    ("artistic-2", "The Artistic License 2.0 Copyright (c) 2000-2006, The Perl Foundation", ("artistic license 2 0", "perl foundation")),
    # Heads of bodies.
    (
        "gpl-2",
        """The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU General Public License is intended
        to guarantee your freedom to share and change free software--to make sure the software is free for all its users.""",
        ("gnu general public license is intended to guarantee", "change free software"),
    ),
    (
        "gpl-3",
        """The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for most software and other practical
        works are designed to take away your freedom to share and change the works. By contrast, the GNU General Public License is intended to guarantee your
        freedom to share and change all versions of a program--to make sure it remains free software for all its users.""",
        ("gnu general public license is a free copyleft license", "all versions of a program"),
    ),
    (
        "lgpl-2.1",
        """The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU General Public Licenses are intended
        to guarantee your freedom to share and change free software--to make sure the software is free for all its users. This license, the Lesser General Public
        License, applies to some specially designated software packages--typically libraries""",
        ("the lesser general public license applies to some",),
    ),
    (
        "lgpl-3",
        """This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented
        by the additional permissions listed below.""",
        ("gnu lesser general public license incorporates",),
    ),
    (
        "agpl-3",
        """The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with
        the community in the case of network server software.""",
        ("gnu affero general public license", "network server software"),
    ),
    (
        "apache-2",
        """"License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document. "Licensor" shall
        mean the copyright owner or entity authorized by the copyright owner that is granting the License.""",
        ("sections 1 through 9 of this document",),
    ),
    (
        "mpl-2",
        """"Contributor" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software. "Contributor Version" means the
        combination of the Contributions of others (if any) used by a Contributor and that particular Contributor's Contribution.""",
        ("owns covered software",),
    ),
    # Notices that name a licence.
    ("mit", "under the terms of the mit license", ("terms of the mit license",)),
    ("apache-2", "under the terms of the apache license version 2 0", ("apache license version 2",)),
    ("bsd", "under the terms of the bsd license", ("terms of the bsd license",)),
    ("gpl", "under the terms of the gnu general public license", ("gnu general public license",)),
    ("mpl-2", "under the terms of the mozilla public license version 2 0", ("mozilla public license version 2",)),
    ("gpl-2", "under the gplv2", ("gplv2",)),
    ("gpl-2", "gplv2 license", ("gplv2 license",)),
    ("gpl-3", "under the gplv3", ("gplv3",)),
    ("gpl-3", "gplv3 license", ("gplv3 license",)),
]

# Identifiers of the SPDX list, as words, by label. Each is a notice behind "SPDX-License-Identifier".
SPDX = {
    "0bsd": "0bsd",
    "agpl 3 0": "agpl-3",
    "apache 2 0": "apache-2",
    "artistic 2 0": "artistic-2",
    "bsd 2 clause": "bsd-2",
    "bsd 3 clause": "bsd-3",
    "bsl 1 0": "bsl-1",
    "cc by 4 0": "cc-by",
    "cc by nc 4 0": "cc-by-nc",
    "cc by sa 4 0": "cc-by-sa",
    "cc0 1 0": "cc0",
    "epl 2 0": "epl",
    "gpl 2 0": "gpl-2",
    "gpl 3 0": "gpl-3",
    "isc": "isc",
    "lgpl 2 1": "lgpl-2.1",
    "lgpl 3 0": "lgpl-3",
    "mit": "mit",
    "mpl 2 0": "mpl-2",
    "unlicense": "unlicense",
    "zlib": "zlib",
}
TEMPLATES += [(label, f"SPDX-License-Identifier: {name}", (f"spdx license identifier {name}",)) for name, label in SPDX.items()]

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
#: Share of a template's words that must stand at their places.
AGREE = 0.8
#: Votes that a place needs from a template's indexed words.
VOTES = 2
#: Words from which on a template is a body, whose places may have words too many or too few, and places that are aligned at once.
BODY, TOGETHER = 12, 2048


def words_of(text: str | None) -> list[bytes]:
    """The words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z in lower case, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _template_words() -> set[bytes]:
    return {w for _, text, _ in TEMPLATES for w in words_of(text)}


@tidy
def _frequency_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, total, n = _template_words(), Counter(), 0
    for batch in batches:
        for text in batch.column(0):
            n += 1
            total.update(known.intersection(words_of(text.as_py())))
    yield pa.RecordBatch.from_arrays([pa.array([*(w.decode() for w in total), ""]), pa.array([*total.values(), n], pa.int64())], ["word", "n"])


def document_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) for every template word, and for '' the number of documents."""
    return docs.select(F.col(text_col).alias("text")).mapInArrow(_frequency_counter, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Index:
    """Postings of each template's rarest words: word -> places in templates."""

    def __init__(self, counts: dict[str, int]) -> None:
        total = counts.get("", 0)
        self.templates = [(label, words_of(text), [words_of(k) for k in keys]) for label, text, keys in TEMPLATES]
        self.idf = {w: math.log((total + 1) / (counts.get(w.decode(), 0) + 1)) for w in _template_words()}
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.votes: list[int] = []
        for t, (_, words, _) in enumerate(self.templates):
            missing = len(words) - least_words(words)  # so many words may be other ones, so of any missing + VOTES places VOTES hold
            indexed = sorted(range(len(words)), key=lambda q: (-self.idf[words[q]], q))[: missing + VOTES]
            self.votes.append(len(indexed) - missing)
            for q in indexed:
                self.postings[words[q]].append((t, q))
        self.bodies = {w: np.array(own, np.int64) for w, places in self.postings.items() if (own := [x for x in places if len(self.templates[x[0]][1]) >= BODY])}
        self.codes = {w: k for k, w in enumerate(sorted({w for _, words, _ in self.templates if len(words) >= BODY for w in words}), 1)}
        self.slack = np.array([slack(len(words)) for _, words, _ in self.templates], np.int64)

    def scan(self, words: list[bytes]) -> list[tuple[str, int, float]]:
        """(label, start, agreement) of every verified template, in the order of templates and places."""
        votes: Counter = Counter()
        for i, w in enumerate(words):
            if w in self.postings:
                votes.update((t, i - q) for t, q in self.postings[w])
        out = []
        for (t, at), n in sorted(votes.items()):
            label, wanted, keys = self.templates[t]
            if n < self.votes[t]:
                continue
            same = sum(0 <= at + q < len(words) and words[at + q] == w for q, w in enumerate(wanted))
            if same >= least_words(wanted) and all(has(words, max(at, 0), at + len(wanted), key) for key in keys):
                out.append((label, at, same / len(wanted)))
        return out


    def centres(self, words: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
        """(template, offsets) around which so many indexed words of a body stand that AGREE of its words may stand in order there."""
        own = [(i, self.bodies[w]) for i, w in enumerate(words) if w in self.bodies]
        if not own:
            return
        which = np.concatenate([p[:, 0] for _, p in own])
        offset = np.concatenate([i - p[:, 1] for i, p in own])
        by = np.lexsort((offset, which))
        which, offset = which[by], offset[by]
        edge = np.flatnonzero(np.concatenate(([True], which[1:] != which[:-1])))
        for a, z in zip(edge, [*edge[1:], len(which)], strict=True):
            t, here = int(which[a]), offset[a:z]
            room = self.slack[t]
            enough = np.searchsorted(here, here + 2 * room, "right") - np.arange(len(here)) >= self.votes[t]
            if enough.any():
                yield t, np.unique(np.unique(here[enough])[:, None] + np.arange(-room, room + 1))

    def aligned(self, words: list[bytes], known: frozenset[str] = frozenset()) -> list[tuple[str, int, float]]:
        """(label, start, agreement) of bodies whose words stand in order, each at most ``slack`` words off one offset.

        Bodies of known labels are not looked for.

        Offsets in reach of each other are one place: that of the best agreement, the middle one of several.
        """
        out, ids = [], None
        for t, at in self.centres(words):
            label, wanted, keys = self.templates[t]
            if label in known:
                continue
            room = int(self.slack[t])
            if ids is None:
                ids = np.array([self.codes.get(w, 0) for w in words], np.int32)
            body = np.array([self.codes[w] for w in wanted], np.int32)
            same = np.concatenate([in_order(ids, body, at[k : k + TOGETHER], room) for k in range(0, len(at), TOGETHER)])
            good = same >= least_words(wanted)
            at, same = at[good], same[good]
            for spots, counts in zip(*(np.split(x, np.flatnonzero(np.diff(at) > 2 * room + 1) + 1) for x in (at, same)), strict=True):
                if len(spots):
                    best = spots[counts == counts.max()]
                    start = int(best[(len(best) - 1) // 2])
                    if all(has(words, max(start - room, 0), start + len(wanted) + room, key) for key in keys):
                        out.append((label, start, int(counts.max()) / len(wanted)))
        return out


def slack(n: int) -> int:
    """How many words a word of a body of n words may be off its offset, to either side."""
    return 1 + n // 40


def in_order(ids: np.ndarray, body: np.ndarray, offsets: np.ndarray, room: int) -> np.ndarray:
    """For each offset the longest common subsequence of the body and the words, no word over ``room`` places off the offset."""
    pad = len(body) + 2 * room + 1
    padded = np.concatenate((np.zeros(pad, np.int32), ids, np.zeros(pad, np.int32)))
    band = offsets[:, None] + np.arange(-room, room + 1) + pad
    inside = len(padded) - 1
    best = np.zeros((len(offsets), 2 * room + 2), np.int32)  # the last column stays zero: nothing comes from beyond the band
    for q, w in enumerate(body):
        match = padded[np.clip(band + q, 0, inside)] == w
        now = np.maximum(best[:, :-1] + match, best[:, 1:])
        best[:, :-1] = np.maximum.accumulate(now, axis=1)
    return best.max(1)


def least_words(template: list[bytes]) -> int:
    """How many of a template's words must stand at their places."""
    return math.ceil(AGREE * len(template))


def has(words: list[bytes], a: int, b: int, phrase: list[bytes]) -> bool:
    return any(words[i : i + len(phrase)] == phrase for i in range(a, b - len(phrase) + 1))


def base_places(words: list[bytes]) -> list[tuple[str, int]]:
    """(label, word number) of every place of a base phrase, in one walk over the text for each phrase."""
    out, joined = [], b" " + b" ".join(words) + b" "
    for phrase, label in BASE.items():
        number, seen = 0, 0
        for m in re.finditer(b"(?= " + re.escape(phrase.encode()) + b" )", joined):
            number += joined.count(b" ", seen, m.start())
            seen = m.start()
            out.append((label, number))
    return out


def _scanner(counts):
    @tidy
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(counts.value)
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for text in batch.column(1):
                words = words_of(text.as_py())
                base, more = base_places(words), index.scan(words)
                more += index.aligned(words, frozenset(m[0] for m in more))
                starts = [at for _, at in base]
                labels = {label for label, _ in base}
                row = (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | {m[0] for m in more})), 1.0 if base else max((m[2] for m in more), default=0.0), [(m[0], m[1], m[2]) for m in more])
                for k, v in enumerate(row):
                    out[k].append(v)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("agreement", pa.float64())]))]
            places = pa.array([[dict(zip(("label", "start", "agreement"), m, strict=True)) for m in x] for x in out[7]], types[7])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, t) for v, t in zip(out[:7], types[:7], strict=True)), places], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"])

    return scan


def licence_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places) for each row."""
    counts = {r["word"]: r["n"] for r in document_frequencies(docs, text_col).collect()}  # one row a template word
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(
        _scanner(docs.sparkSession.sparkContext.broadcast(counts)),
        f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, places array<struct<label:string,start:bigint,agreement:double>>",
    )
