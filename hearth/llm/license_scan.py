"""License scans with directory inheritance (operator 2).

Texts that speak of a licence become sparse TF-IDF vectors and are compared by cosine
with full licence texts (``licenses/``) and short notices.  Compared are the lines, the
whole text, and windows of a template's length that slide over all tokens: they find
comment headers that run over several lines and notices inside long lines, as comment
signs and line breaks are no tokens.  SPDX tags are read by their grammar.  Where hits
overlap, the one that explains most of the words stays; of the others the best cosine
is the document's own licence.

A document whose whole text is like a template, or that consists of licence lines for
the most part, is a licence file and speaks for its directory.  Documents without a
licence of their own inherit from the nearest ancestor directory that has a licence
file: directories are resolved once each, by joining them with their ancestors' paths,
and documents join their directory.

The templates are a fixed small table that the driver reads; everything else follows
the input and is joined on equal keys.
"""

from __future__ import annotations

import math
import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import WORD, written

MIN_COSINE = 0.6
#: Least cosine of windows, and of whole texts with full licence texts (prose shares their common words).
WINDOW_COSINE = 0.8
#: Share of a document's words in licence lines from which it counts as a licence file.
FILE_SHARE = 0.4

#: Usual notices of public licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("proprietary", "Copyright. All rights reserved."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MIT", "The MIT License (MIT)"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
     "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
     "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
     "either express or implied. See the License for the specific language governing permissions and limitations under the License."),
)

#: Names that follow "under" in a notice.
NAMES = (
    ("MIT", ("the MIT License",)),
    ("Apache-2.0", ("the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License")),
    ("BSD-2-Clause", ("the BSD 2-Clause License", "the 2-Clause BSD License", "the Simplified BSD License")),
    ("BSD-3-Clause", ("the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License", "the Modified BSD License")),
    ("ISC", ("the ISC License",)), ("Zlib", ("the zlib License",)), ("Unlicense", ("the Unlicense",)),
    ("MPL-2.0", ("the Mozilla Public License, version 2.0", "the MPL 2.0")),
    ("CC0-1.0", ("CC0 1.0", "the Creative Commons CC0 1.0 Universal")),
) + tuple((f"{short}-{v}", (f"the GNU {long} License, version {v.removesuffix('.0')}", f"the GNU {long} License v{v}", f"the {short} version {v.removesuffix('.0')}",
                           f"the {short}v{v.removesuffix('.0')}", f"version {v.removesuffix('.0')} of the GNU {long} License"))
          for short, long, versions in (("GPL", "General Public", ("2.0", "3.0")), ("LGPL", "Lesser General Public", ("2.1", "3.0")),
                                        ("AGPL", "Affero General Public", ("3.0",))) for v in versions) + tuple(
    (f"CC-{short}-4.0", (f"CC {short} 4.0", f"a Creative Commons {long} 4.0 International License"))
    for short, long in (("BY", "Attribution"), ("BY-NC", "Attribution-NonCommercial"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
                        ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")))

#: The notice that the GNU licences ask for.
GNU = ("This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} License as published by the "
       "Free Software Foundation; either version {v} of the License, or (at your option) any later version. This {what} is distributed in the hope "
       "that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
       "See the GNU {name} License for more details.")
GNU_NOTICES = tuple((f"{short}-{v}", notice.format(what=what, name=name, v=v.removesuffix(".0")))
                    for notice in (GNU, GNU[:GNU.index(" This {what} is distributed")]) for short, name, what, versions in (("GPL", "General Public", "program", ("2.0", "3.0")), ("LGPL", "Lesser General Public", "library", ("2.1", "3.0")),
                                                        ("AGPL", "Affero General Public", "program", ("3.0",))) for v in versions)

#: A notice that names its licence is found only with one of the words that name it.
KEYS = {"MIT": "mit mit-style", "Apache-2.0": "apache", "BSD-2-Clause": "bsd 2-clause", "BSD-3-Clause": "bsd bsd-style 3-clause", "ISC": "isc", "Zlib": "zlib",
        "Unlicense": "unlicense unencumbered", "MPL-2.0": "mozilla mpl", "BSL-1.0": "boost", "CC0-1.0": "cc0", "LGPL-2.1": "lesser lgpl lgplv2.1",
        "LGPL-3.0": "lesser lgpl lgplv3", "AGPL-3.0": "affero agpl agplv3", "GPL-2.0": "gnu gpl gplv2", "GPL-3.0": "gnu gpl gplv3",
        "CC-BY-4.0": "by attribution", "CC-BY-NC-4.0": "by-nc attribution-noncommercial", "CC-BY-SA-4.0": "by-sa attribution-sharealike",
        "CC-BY-ND-4.0": "by-nd attribution-noderivatives", "CC-BY-NC-SA-4.0": "by-nc-sa attribution-noncommercial-sharealike",
        "CC-BY-NC-ND-4.0": "by-nc-nd attribution-noncommercial-noderivatives"}
#: Says nothing against a licence that is given beside it.
LAST = "proprietary"

#: Texts and lines worth a comparison (ASCII case folded).
SPEAKS = r"(?i)licen[cs]e|copyright|spdx|redistribut|permission is hereby|free software|creative commons|\bcc[ -]by|\bcc0|public domain|gpl"
TOKEN = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"

_SPEAKS, _TOKEN, _WORD = re.compile(SPEAKS, re.A), re.compile(TOKEN), re.compile(WORD)
_REMARK = re.compile(r"^[ \t]*(?:rem|dnl)[ \t]", re.I | re.M)  # comment signs that are words
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() \t-]+)", re.I)
#: Templates of more tokens slide by a sixteenth of their length.
SHORT = 64


def license_texts() -> tuple[tuple[str, str], ...]:
    """(license, full text) of the files beside this module; read on the driver."""
    folder = os.path.join(os.path.dirname(os.path.abspath(__file__)), "licenses")
    out = []
    for name in sorted(os.listdir(folder)):
        with open(os.path.join(folder, name), encoding="utf-8") as f:
            out.append((name.removesuffix(".txt"), f.read()))
    # the Affero text is the GPL's under its own name, but for one section
    gpl = dict(out).get("GPL-3.0")
    if gpl:
        out.append(("AGPL-3.0", re.sub(r"(?i)GNU General Public", "GNU Affero General Public", gpl)))
    return tuple(out)


def spdx_ids(text: str) -> list[str]:
    """Licences of an SPDX expression: ids joined by AND or OR; what follows WITH is no licence."""
    known = {n.lower(): n for n in [*KEYS, *(n for n, _ in TEMPLATES), "GPL-1.0", "LGPL-2.0", "0BSD", "Artistic-1.0", "PSF-2.0", "MPL-1.1", "GFDL-1.2", "GFDL-1.3"]}
    out, wanted = [], True
    words = iter(text.replace("(", " ").replace(")", " ").split())
    for w in words:
        if wanted:
            base = re.sub(r"(?i)(-only|-or-later|\+)$", "", w).lower()
            out.append(known.get(base, w))
            wanted = False
        elif w.upper() == "WITH":
            next(words, None)
        elif w.upper() in ("AND", "OR"):
            wanted = True
        else:
            break
    return [x for x in out if x.upper() not in ("NONE", "NOASSERTION") and re.search("[A-Za-z0-9]", x)]


class Scorer:
    """Cosines of a text's lines, windows and whole with the templates."""

    def __init__(self, notices, texts, min_cosine: float):
        self.all = [(name, _TOKEN.findall(t.lower()), False) for name, t in notices] + [(name, _TOKEN.findall(t.lower()), True) for name, t in texts]
        self.min_cosine = min_cosine
        self.place: dict[str, int] = {}
        for _, tokens, _ in self.all:
            for w in tokens:
                self.place.setdefault(w, len(self.place))
        v, n = len(self.place), len(self.all)
        self.tf = np.zeros((n, v + 1))  # the last place is that of unknown words
        for row, (_, tokens, _) in zip(self.tf, self.all):
            for w, c in Counter(tokens).items():
                row[self.place[w]] = c
        self.idf = np.log((1 + n) / (1 + (self.tf > 0).sum(0))) + 1
        self.idf[v] = math.log(1 + n) + 1
        raw = self.tf * self.idf
        self.weight = raw / np.sqrt((raw ** 2).sum(1, keepdims=True))
        self.mass = (self.tf * self.idf ** 2).sum(1)
        self.size = np.array([len(tokens) for _, tokens, _ in self.all])
        self.full = np.array([full for _, _, full in self.all])
        self.keys = [{self.place[k] for k in KEYS.get(name, "").split() if k in tokens} and
                     {self.place[k] for k in KEYS[name].split() if k in self.place} if not full else set() for name, tokens, full in self.all]

    def vector(self, ids: np.ndarray):
        """Places and counts of the known words, mass of all, norm."""
        at, c = np.unique(ids, return_counts=True)
        v = len(self.place)
        idf = self.idf[np.minimum(at, v)]
        known = at < v
        return at[known], c[known], float((c * idf ** 2).sum()), math.sqrt(float(((c * idf) ** 2).sum()))

    def compare(self, vector, rows) -> tuple[np.ndarray, np.ndarray]:
        """Cosine with the templates ``rows``, and the mass of equal words less that of all others."""
        at, c, mass, norm = vector
        cosine = (self.weight[np.ix_(rows, at)] @ (c * self.idf[at])) / (norm or 1.0)
        both = np.minimum(self.tf[np.ix_(rows, at)], c) @ (self.idf[at] ** 2)
        return cosine, 3 * both - mass - self.mass[rows]

    def judge(self, text: str, file_share: float) -> tuple[str | None, float | None, bool]:
        """(license, cosine, is a licence file) of a text."""
        ids, spans, unknown = [], [], {}
        hits, said, seen, spdx = [], 0, set(), []
        clean = _REMARK.sub("", text)
        for line in clean.split("\n"):
            start = len(ids)
            for w in _TOKEN.findall(line.lower()):
                p = self.place.get(w)
                ids.append(p if p is not None else unknown.setdefault(w, len(self.place) + len(unknown)))
            if _SPEAKS.search(line) and len(ids) > start:
                spans.append((line.strip(" "), start, len(ids)))
        ids = np.array(ids, np.int64)
        if not len(ids):
            return None, None, False
        there = set(np.unique(ids).tolist())
        rows = np.array([t for t, k in enumerate(self.keys) if not k or k & there])

        def add(a: int, z: int, some: np.ndarray, least) -> bool:
            vector = self.vector(ids[a:z])
            own = set(vector[0].tolist())
            cosine, net = self.compare(vector, some)
            good = [i for i in np.flatnonzero(cosine.round(9) >= least) if not self.keys[some[i]] or self.keys[some[i]] & own]
            hits.extend((-float(net[i]), -round(float(cosine[i]), 9), self.all[some[i]][0], a, z) for i in good)
            return bool(good)

        least = np.where(self.full, max(WINDOW_COSINE, self.min_cosine), self.min_cosine)
        whole = add(0, len(ids), rows, least[rows])
        notices = rows[~self.full[rows]]
        for line, a, z in spans:
            tag = _SPDX.search(line)
            if tag:
                spdx += [(-math.inf, -1.0, name, a, z) for name in spdx_ids(tag[1])]
            if add(a, z, notices, self.min_cosine) and line not in seen:
                seen.add(line)
                said += len(_WORD.findall(line))
        v = np.minimum(ids, len(self.place))
        squares = np.concatenate([[0.0], np.cumsum(self.idf[v] ** 2)])
        least = max(WINDOW_COSINE, self.min_cosine)
        for t in rows.tolist():
            m = int(self.size[t])
            if m >= len(ids):
                continue  # the whole text was compared
            step = 1 if m <= SHORT else m // 16
            at = np.unique(np.append(np.arange(0, len(ids) - m + 1, step), len(ids) - m))
            dot = np.concatenate([[0.0], np.cumsum(self.idf[v] * self.weight[t][v])])
            # repeated words only lengthen the vector: an upper bound of the cosine
            bound = (dot[at + m] - dot[at]) / np.sqrt(squares[at + m] - squares[at])
            for a in at[bound >= least - 1e-9].tolist():
                add(a, a + m, np.array([t]), least)
        # of hits that overlap the one that explains most
        taken = np.zeros(len(ids), bool)
        kept = list(spdx)
        for _, _, _, a, z in spdx:
            taken[a:z] = True
        for hit in sorted(hits):
            if not taken[hit[3]:hit[4]].any():
                taken[hit[3]:hit[4]] = True
                kept.append(hit)
        if not kept:
            return None, None, False
        _, cosine, name = min((name == LAST, cosine, name) for _, cosine, name, _, _ in kept)
        return name, -cosine, whole or 0 < said >= file_share * len(_WORD.findall(text))


def own_licenses(files: DataFrame, templates, texts, min_cosine: float, file_share: float) -> DataFrame:
    """(doc_id, path, own, cosine, is_file) of every row of (doc_id, path, text)."""
    notices = tuple(templates)
    if templates is TEMPLATES:
        notices += tuple((name, f"under {x}") for name, names in NAMES for x in names) + GNU_NOTICES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in batches:
            own = []
            for text in batch.column("text"):
                text = text.as_py()
                if text is None:
                    own.append((None, None, False))
                    continue
                scorer = scorer or Scorer(notices, texts, min_cosine)
                own.append(scorer.judge(text, file_share))
            cols = list(zip(*own)) or [(), (), ()]
            yield pa.record_batch([batch.column("doc_id"), batch.column("path"), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()),
                                   pa.array(cols[2], pa.bool_())], names=["doc_id", "path", "own", "cosine", "is_file"])

    # texts that do not speak of a licence stay where they are
    return files.withColumn("text", F.when(F.col("text").rlike(SPEAKS), F.col("text"))).mapInArrow(
        run, "doc_id long, path string, own string, cosine double, is_file boolean")


def scan(files: DataFrame, templates=TEMPLATES, min_cosine: float = MIN_COSINE, file_share: float = FILE_SHARE, texts=None) -> DataFrame:
    """(doc_id, path, text) → doc_id, path, license, cosine, origin, from_dir of every row.

    origin: "file" (a licence file), "header" (a licence notice of its own),
    "inherited" (from ``from_dir``), or "none".  A directory with several licence files
    has the licence most of them name, ties to the first name.  Null text is empty; a
    null path has no ancestors; repeated rows are judged alike.  ``texts`` are full
    licence texts (``license_texts`` if none are given).  An SPDX tag counts with cosine 1;
    ids that no template has are reported as written.
    """
    keyed = files.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("path").cast("string").alias("path"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    judged = own_licenses(keyed, templates, license_texts() if texts is None else texts, min_cosine, file_share)
    folder = F.when(F.col("path").isNotNull(), F.regexp_extract("path", r"^(.*)/[^/]*$", 1))
    judged = written(judged.withColumn("dir", folder), "license-own")
    # licences of directories, then of all their descendants that occur
    votes = judged.filter("is_file and dir is not null").groupBy("dir", "own").agg(F.count(F.lit(1)).alias("n"))
    speaks = votes.groupBy("dir").agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("own").alias("l"))).alias("b")).select(
        F.col("dir").alias("up"), F.col("b.l").alias("given"))
    dirs = judged.filter("own is null and dir is not null").select("dir").distinct()
    parts = F.split("dir", "/")
    # the directory itself, its parent and so on up to the root ""
    ups = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(
        k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("up")))).alias("a")).select("dir", "a.depth", "a.up").distinct()
    near = ups.join(speaks, "up").groupBy("dir").agg(F.max(F.struct("depth", "up", "given")).alias("b")).select(
        "dir", F.col("b.up").alias("from_dir"), F.col("b.given").alias("given"))
    out = judged.join(near, "dir", "left")
    has = F.col("own").isNotNull()
    return out.select(
        "doc_id", "path", F.when(has, F.col("own")).otherwise(F.col("given")).alias("license"),
        F.when(has, F.col("cosine")).alias("cosine"),
        F.when(F.col("is_file"), "file").when(has, "header").when(F.col("given").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~has, F.col("from_dir")).alias("from_dir"))
