"""Licence scan: spans of words compared with licence templates by the Dice coefficient over word bigrams."""
from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from panelflume.llm.common import sealed

# Notices, grants and openings of the full texts as their stewards publish them.
_FSF = ("under the terms of the GNU {} as published by the Free Software Foundation{} either version {}{} or (at your option) any later version.")
_FSF_BODY = ("Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution.")
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
       "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
TEMPLATES = [
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it " + _FSF.format("Affero General Public License", ",", "3", " of the License,")),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. " + _FSF_BODY),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("BSD-2-Clause", _BSD),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                     "the following conditions are met:"),
    ("BSD-3-Clause", _BSD + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                            "products derived from this software without specific prior written permission."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC0-1.0", "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or "
                "neighboring rights to this work."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC0-1.0", "This work is licensed under a Creative Commons CC0 1.0 Universal License."),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which "
                "accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
                "available at https://www.eclipse.org/legal/epl-2.0/"),
    ("GPL-1.0", "This program is free software; you can redistribute it and/or modify it " + _FSF.format("General Public License", ";", "1", ",")),
    *[(f"GPL-{v}.0", f"This work is licensed under the GNU General Public License, version {v}.") for v in (2, 3)],
    *[(f"GPL-{v}.0", "This program is free software: you can redistribute it and/or modify it " + _FSF.format("General Public License", ",", v, " of the License,"))
      for v in (2, 3)],
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. " + _FSF_BODY),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. " + _FSF_BODY),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.0", "This library is free software; you can redistribute it and/or modify it "
     + _FSF.format("Library General Public License", ";", "2", " of the License,")),
    *[(f"LGPL-{float(v)}", f"This work is licensed under the GNU Lesser General Public License, version {v}.") for v in ("2.1", "3")],
    *[(f"LGPL-{float(v)}", "This library is free software; you can redistribute it and/or modify it "
       + _FSF.format("Lesser General Public License", ";", v, " of the License,")) for v in ("2.1", "3")],
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc. " + _FSF_BODY),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. " + _FSF_BODY),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
                  "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
                  "commercial or non-commercial, and by any means."),
    *[(f"CC-{k}-{v}", f"Licensed under CC {k} {v}.") for k in _CC for v in ("2.0", "2.5", "3.0", "4.0")],
    *[(f"CC-{k}-{v}", f"This work is licensed under a Creative Commons {name} {v} {scope} License.")
      for k, name in _CC.items() for v, scope in (("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International"))],
]
THRESHOLD = 0.8
TOKEN = re.compile(r"[^\W\d_]+|\d+")


def normal_words(text: str) -> list[str]:
    """Lower-case words and numbers, which tell versions apart."""
    return TOKEN.findall(text.lower())


def bigrams(words: list[str]) -> list[tuple[str, str]]:
    return list(zip(words, words[1:]))


class Templates:
    """Templates with a size index and the words that begin their bigrams."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        self.threshold = threshold
        self.items = [(name, Counter(bigrams(normal_words(text)))) for name, text in templates]
        self.sizes = [sum(c.values()) for _, c in self.items]
        self.known = {b: [k for k, (_, c) in enumerate(self.items) if b in c] for _, c in self.items for b in c}
        ratio = (2 - threshold) / threshold
        self.bounds = [(n / ratio - 1e-9, n * ratio + 1e-9) for n in self.sizes]
        self.words = {w for pair in self.known for w in pair}


def scan(text: str | None, t: Templates) -> list[tuple[str, float, int, int]]:
    """(license, dice, first line, last line) of the best span for each licence; lines count from 0.

    Spans are whole consecutive lines. A span of b bigrams can reach Dice d with a template of n only if n*d/(2-d) <= b <=
    n*(2-d)/d, so only templates in that range are compared, and a span grows only while one can still be in range. Spans
    start at a line that has a template bigram or begins one with the next line's first word.
    """
    lines = (text or "").split("\n")
    known, vocabulary = t.known, t.words
    tokens: dict[int, list[str]] = {}

    def of(i: int) -> list[str]:
        if i not in tokens:
            tokens[i] = normal_words(lines[i])
        return tokens[i]

    best: dict[str, tuple[float, int, int]] = {}
    for i in range(len(lines)):
        start = of(i)
        hits = {k for b in bigrams(start) for k in known.get(b, ())}
        nxt = next((w for j in range(i + 1, len(lines)) for w in of(j)[:1]), None) if start and start[-1] in vocabulary else None
        if nxt is not None:
            hits.update(known.get((start[-1], nxt), ()))
        if not hits:
            continue
        most = max(t.bounds[k][1] for k in hits)
        words: list[str] = []
        for j in range(i, len(lines)):
            words += of(j)
            size = len(words) - 1
            if size > most:
                break
            pairs = Counter(bigrams(words))
            for k in hits:
                lo, hi = t.bounds[k]
                if lo <= size <= hi:
                    dice = 2 * sum((pairs & t.items[k][1]).values()) / (size + t.sizes[k])
                    name = t.items[k][0]
                    if dice >= t.threshold and (name not in best or (dice, -i, -j) > (best[name][0], -best[name][1], -best[name][2])):
                        best[name] = (dice, i, j)
    return sorted((name, d, i, j) for name, (d, i, j) in best.items())


def spans(words: list[str], t: Templates) -> list[tuple[int, int, float, int, int]]:
    """(template, shared bigrams, dice, first word, last word) of spans of words like a template: from each start the closest,
    then the shortest.

    A span that begins or ends with a bigram the template lacks is less like it than without, so only spans between
    template bigrams are compared. A start needs as many of them as the smallest span, within the largest span, and
    shared bigrams are counted on from end to end.
    """
    pairs = bigrams(words)
    at: dict[int, list[int]] = {}
    for i, b in enumerate(pairs):
        for k in t.known.get(b, ()):
            at.setdefault(k, []).append(i)
    out = []
    for k, places in at.items():
        body, n, most = t.items[k][1], t.sizes[k], math.floor(t.bounds[k][1])
        least = max(1, math.ceil(t.bounds[k][0]))
        for a in range(len(places) - least + 1):
            first = places[a]
            if places[a + least - 1] - first >= most:
                continue
            used: Counter = Counter()
            both, closest = 0, None
            for i in places[a:a + most]:
                size = i - first + 1
                if size > most:
                    break
                b = pairs[i]
                if used[b] < body[b]:
                    used[b] += 1
                    both += 1
                    dice = 2 * both / (size + n)
                    if dice >= t.threshold and (closest is None or dice > closest[2]):
                        closest = (k, both, dice, first, i + 1)
            if closest:
                out.append(closest)
    return out


def scan_words(text: str | None, t: Templates) -> list[tuple[str, float, int, int]]:
    """scan() over spans of words instead of whole lines: notices within lines are found, lines only say where.

    Of overlapping spans of different licences only one counts, that of the template with the most bigrams in it, then the
    closest: a notice is its closest licence's, not also its relatives'.
    """
    low = (text or "").lower()
    owner: dict[int, str] = {}
    best: dict[str, tuple[float, int, int]] = {}
    for k, _, dice, i, j in sorted(spans(normal_words(low), t), key=lambda x: (-x[1], -x[2], x[3], x[4], x[0])):
        name = t.items[k][0]
        owners = {owner.get(w) for w in range(i, j + 1)}
        if owners == {None}:
            owner.update(dict.fromkeys(range(i, j + 1), name))
        elif owners != {name}:
            continue
        if name not in best or (dice, -i, -j) > (best[name][0], -best[name][1], -best[name][2]):
            best[name] = (dice, i, j)
    if not best:
        return []
    starts = [m.start() for m in TOKEN.finditer(low)]
    return sorted((name, d, low.count("\n", 0, starts[i]), low.count("\n", 0, starts[j])) for name, (d, i, j) in best.items())


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] | None = None,
                  threshold: float = THRESHOLD) -> DataFrame:
    """A row for each licence found in a document: doc_id, license, dice, first_line, last_line.

    Every word of every text is looked at, whatever the lines. A notice counts for one licence only, its closest relative's. Of several spans like one licence the closest counts, then the
    first, then the shortest. Null and empty texts have no licence; repeated rows give repeated results; an empty table gives an empty one.
    Other columns do not matter. There is no shuffle; templates travel with the task.
    """
    rows, names = sealed(docs.select(doc_id, text))
    chosen = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Templates(chosen, threshold)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found = [(i, *hit) for i, body in zip(ids, batch.column(1).to_pylist()) for hit in scan_words(body, t)]
            cols = list(zip(*found)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(
                cols, [pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32()])], names=["doc_id", "license", "dice", "first_line", "last_line"])

    return rows.withColumn(names[doc_id], rows[names[doc_id]].cast("long")).mapInArrow(
        run, "doc_id long, license string, dice double, first_line int, last_line int")
