"""Licence scan: TF-IDF cosine of headers and licence files to templates, then inheritance.

Every line of a file (headers can stand anywhere), every window of as many terms as a
notice has, over line breaks and comment marks, and, for licence files, the whole
text is compared with short templates of the common licences. Windows find notices that
are wrapped, stand inside a longer line or are a part of a licence's full text (its title
or a sentence of its own is a template). Windows that cannot reach ``least`` are left out by the
weight of the template's terms in them (an upper bound, so none is lost). Terms are weighted
tf * ln((1 + files) / (1 + files with the term)), the counts being taken over
all files; only terms of the templates need a count (a fixed vocabulary), any other term has
the weight of an unseen one, which can only lower a cosine. The best template of a file
counts if its cosine reaches ``least``.

A file without a licence of its own inherits that of the nearest directory above it
(its own directory first) whose licence file names one: distinct directories are
joined with the licensed directories on each of their ancestor paths, the longest
wins, and files join their directory. A hot directory is one row in that join.

A reservation of rights stands beside licences too: ``proprietary`` counts only as a line (or
licence file) of its own, and only if no licence reaches ``least``. The sentence that both BSD licences
begin with names BSD-3-Clause.

Defined cases: null or empty texts have no licence of their own; several licence
files of one directory: the best cosine, then the smallest template name; ties
between templates: the smallest name; null paths belong to no directory and inherit
nothing; repeated rows are reported row by row; long texts are read
whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import quoted, scratch, split_words, text_slices

# Short forms of public licence notices (fixed values: SPDX name and notice).
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0",
                   "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0", "Apache License Version 2.0, January 2004",
                   "SPDX-License-Identifier: Apache-2.0"],
    "MIT": ["Released under the MIT License", "Licensed under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction",
            "SPDX-License-Identifier: MIT"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License",
                "GNU General Public License Version 3, 29 June 2007", "SPDX-License-Identifier: GPL-3.0"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2",
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License",
                "GNU General Public License Version 2, June 1991", "SPDX-License-Identifier: GPL-2.0"],
    "LGPL-3.0": ["licensed under the GNU Lesser General Public License, version 3",
                 *(f"This {x} is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                   "Public License as published by the Free Software Foundation, either version 3 of the License" for x in ("library", "program")),
                 "GNU Lesser General Public License Version 3, 29 June 2007", "SPDX-License-Identifier: LGPL-3.0"],
    "LGPL-2.1": ["licensed under the GNU Lesser General Public License, version 2.1",
                 *(f"This {x} is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                   "Public License as published by the Free Software Foundation; either version 2.1 of the License" for x in ("library", "program")),
                 "GNU Lesser General Public License Version 2.1, February 1999", "SPDX-License-Identifier: LGPL-2.1"],
    "AGPL-3.0": ["licensed under the GNU Affero General Public License, version 3",
                 "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
                 "Public License as published by the Free Software Foundation, either version 3 of the License",
                 "GNU Affero General Public License Version 3, 19 November 2007", "SPDX-License-Identifier: AGPL-3.0"],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met", "Licensed under the BSD 3-Clause License",
                     "SPDX-License-Identifier: BSD-3-Clause"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Licensed under the BSD 2-Clause License", "SPDX-License-Identifier: BSD-2-Clause"],
    "ISC": ["ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies", "SPDX-License-Identifier: ISC"],
    "EPL-2.0": ["Eclipse Public License - v 2.0", "SPDX-License-Identifier: EPL-2.0"],
    "CC0-1.0": ["CC0 1.0 Universal", "SPDX-License-Identifier: CC0-1.0"],
    "Zlib": ["zlib License", "SPDX-License-Identifier: Zlib"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
                "Mozilla Public License Version 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "proprietary": ["All rights reserved", "Copyright. All rights reserved", "Confidential and proprietary"],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
}
# Current SPDX identifiers of the GNU family tell this version from later ones; the licence is the same.
for _name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"):
    TEMPLATES[_name] += [f"SPDX-License-Identifier: {_name}-{_form}" for _form in ("only", "or-later")]
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)([.\-_][^/]*)?$"
_TERM = re.compile(r"[\w.+\-]*\w")


@dataclass(frozen=True)
class LicenceParams:
    least: float = 0.8


def _terms(words: list[str]) -> list[str]:
    """A word as a term: lower case, without comment marks and other edge punctuation."""
    return [m[0] if (m := _TERM.search(w.lower())) else "" for w in words]


def vocabulary() -> dict[str, int]:
    terms = sorted({t for notices in TEMPLATES.values() for n in notices for t in _terms(n.split()) if t})
    return {t: i for i, t in enumerate(terms)}


def term_counts(files: DataFrame, text_col: str) -> DataFrame:
    """(term, n): files with each template term."""
    vocab = vocabulary()

    def run(batches):
        total = np.zeros(len(vocab), np.int64)
        for part in text_slices(batches, "t"):
            w = split_words(part.column(0))
            term = np.array([vocab.get(t, -1) for t in _terms(w.vocab)], np.int64)
            if len(term):
                of = term[w.codes]
                key = np.unique(w.doc_of[of >= 0] * len(vocab) + of[of >= 0])
                total += np.bincount(key % len(vocab), minlength=len(vocab))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(vocab), dtype=np.int32)), pa.array(total)], names=["term", "n"])

    counted = files.select(quoted(text_col).cast("string").alias("t")).mapInArrow(run, "term int, n bigint")
    return counted.groupBy("term").agg(F.sum("n").alias("n"))


def _matrix(vocab: dict[str, int], idf: np.ndarray) -> tuple[list[str], np.ndarray, list[int]]:
    """Names, unit vectors and numbers of terms of all templates, sorted by name."""
    names, rows, sizes = [], [], []
    for name in sorted(TEMPLATES):
        for notice in TEMPLATES[name]:
            v = np.zeros(len(vocab))
            terms = [vocab[t] for t in _terms(notice.split()) if t]
            for t in terms:
                v[t] += idf[t]
            names.append(name)
            rows.append(v / np.linalg.norm(v))
            sizes.append(len(terms))
    return names, np.array(rows), sizes


def _windows(of, owner, n_owner, state, least):
    """Best cosine and template of any window of each owner: ``of`` holds the terms of all owners in
    order (-1: foreign). A window has as many terms as the template it is compared with."""
    vocab, idf, unseen, names, templates, sizes = state
    cosine, which = np.zeros(n_owner), np.zeros(n_owner, np.int64)
    weight = np.append(idf, unseen) ** 2
    for k, (u, m) in enumerate(zip(templates, sizes)):
        n = len(of) - m + 1
        if n <= 0 or names[k] == "proprietary":
            continue
        # cosine <= root of the template's weight that lies in the window (Cauchy-Schwarz)
        inside = np.concatenate([[0.0], np.cumsum(np.append(u ** 2, 0.0)[of])])
        at = np.flatnonzero(inside[m:] - inside[:-m] >= least ** 2 - 1e-6)
        at = at[owner[at] == owner[at + m - 1]]
        for s in range(0, len(at), 4096):
            some = at[s:s + 4096]
            terms = of[some[:, None] + np.arange(m)]
            cells = np.arange(len(some))[:, None] * (len(vocab) + 1) + terms % (len(vocab) + 1)
            tf = np.bincount(cells.ravel(), minlength=len(some) * (len(vocab) + 1)).reshape(len(some), -1)
            # a foreign term weighs as if each were another word
            power = np.where(np.arange(len(vocab) + 1) < len(vocab), tf ** 2, tf) @ weight
            cos = np.round((tf[:, :-1] * idf) @ u / np.sqrt(power), 12)
            best = np.zeros(n_owner)
            np.maximum.at(best, owner[some], cos)
            better = best > cosine              # templates come by name: the first of equals stays
            cosine, which = np.where(better, best, cosine), np.where(better, k, which)
    return cosine, which


def own_licences(files: DataFrame, path_col: str, text_col: str, id_col: str, p: LicenceParams) -> DataFrame:
    """(id, path, licence, cosine): best template of each file, null below the threshold."""
    spark = files.sparkSession
    vocab = vocabulary()
    counts = {r.term: r.n for r in term_counts(files, text_col).collect()}     # one number for each template term
    n = files.count()
    idf = np.log((1 + n) / (1 + np.array([counts.get(i, 0) for i in range(len(vocab))]))) + 1e-9
    unseen = float(np.log(1 + n) + 1e-9)
    names, templates, sizes = _matrix(vocab, idf)
    named = np.array([x != "proprietary" for x in names])
    shared = spark.sparkContext.broadcast((vocab, idf, unseen, names, templates, sizes))

    def best(owner, term, n_owner, state):
        """Best cosine and template of every owner of terms (numbers, -1: foreign); a licence that
        reaches ``least`` goes before a reservation of rights."""
        vocab, idf, unseen, names, templates, _ = state
        cosine, which = np.zeros(n_owner), np.zeros(n_owner, np.int64)
        size = len(vocab)
        known = term >= 0
        # owners that share no term with a template are at 0
        live = np.unique(owner[known])
        if len(live) == 0:
            return cosine, which
        row = np.searchsorted(live, owner)
        mine = (row < len(live)) & (live[np.minimum(row, len(live) - 1)] == owner)
        row, term, known = row[mine], term[mine], known[mine]
        foreign = np.bincount(row[~known], minlength=len(live)) * unseen ** 2
        for at in range(0, len(live), 4096):
            to = min(len(live), at + 4096)
            s, e = np.searchsorted(row, [at, to])
            ok = known[s:e]
            tf = np.bincount((row[s:e][ok] - at) * size + term[s:e][ok], minlength=(to - at) * size).reshape(-1, size)
            v = tf * idf
            dots = v @ templates.T
            cos = dots / np.sqrt((v ** 2).sum(1) + foreign[at:to])[:, None]
            cos = np.round(cos, 12)
            licensed = (cos[:, named] >= p.least).any(1)
            cos[np.ix_(licensed, ~named)] = 0.0
            which[live[at:to]] = cos.argmax(1)
            cosine[live[at:to]] = cos.max(1)
        return cosine, which

    def prefer(where, c, k, top, template):
        """The better of two findings for each file: a licence that reaches ``least``, then the cosine, then the name."""
        a, b = named[k] & (c >= p.least), named[template] & (top >= p.least)
        better = where & ((a & ~b) | ((a == b) & ((c > top) | ((c == top) & (k < template)))))
        return np.where(better, c, top), np.where(better, k, template)

    def run(batches):
        state = shared.value
        vocab, names = state[0], state[3]
        for part in text_slices(batches, "t"):
            lines = [(t or "").split("\n") for t in part.column(2).to_pylist()]
            file_of = np.repeat(np.arange(len(lines)), [len(x) for x in lines])
            w = split_words(pa.array([x for f in lines for x in f], pa.string()))
            term = np.array([(-2 if t == "" else vocab.get(t, -1)) for t in _terms(w.vocab)], np.int64)
            of = term[w.codes] if len(w.codes) else np.zeros(0, np.int64)
            real = of > -2          # marks without letters are no terms
            of, line = of[real], w.doc_of[real]
            cosine, which = best(line, of, len(file_of), state)
            # best line of a file: a licence, largest cosine, then the first template by name
            order = np.lexsort((which, -cosine, ~named[which] | (cosine < p.least), file_of))
            first = order[np.searchsorted(file_of[order], np.arange(len(lines)))] if len(lines) else order
            top, template = cosine[first], which[first]
            whole = np.array(part.column(3).to_pylist(), bool)
            if whole.any():
                c, k = best(file_of[line], of, len(lines), state)
                top, template = prefer(whole, c, k, top, template)
            c, k = _windows(of, file_of[line], len(lines), state, p.least)
            top, template = prefer(np.ones(len(lines), bool), c, k, top, template)
            licence = [names[k] if c >= p.least else None for c, k in zip(top, template)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(3), pa.array(licence, pa.string()), pa.array(top)],
                                             names=["id", "path", "whole", "licence", "cosine"])

    src = files.select(quoted(id_col).cast("bigint").alias("id"), quoted(path_col).cast("string").alias("path"),
                       quoted(text_col).cast("string").alias("t"))
    src = src.withColumn("whole", F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False)))
    return src.mapInArrow(run, "id bigint, path string, whole boolean, licence string, cosine double")


def _directory(path):
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", id_col: str = "doc_id",
         p: LicenceParams = LicenceParams()) -> DataFrame:
    """(id, path, licence, origin, cosine): origin is ``own``, ``inherited`` or ``none``; for inherited
    licences ``cosine`` is the file's own best."""
    own = scratch(own_licences(files, path_col, text_col, id_col, p), "licences")
    own = own.withColumn("dir", _directory(F.col("path")))
    licensed = (own.where("whole AND licence IS NOT NULL")
                .groupBy("dir").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("best"))
                .select(F.col("dir").alias("above"), F.col("best.licence").alias("dir_licence")))
    parts = F.split("dir", "/")
    ancestors = (own.where("licence IS NULL AND dir IS NOT NULL").select("dir").distinct()
                 .select("dir", F.explode(F.transform(
                     F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))).alias("above"))
                 .distinct())
    nearest = (ancestors.join(licensed, "above").groupBy("dir")
               .agg(F.max_by("dir_licence", F.length("above")).alias("dir_licence")))
    joined = own.join(nearest, "dir", "left")
    return joined.select(
        F.col("id").alias(id_col), "path", F.coalesce("licence", "dir_licence").alias("licence"),
        F.when(F.col("licence").isNotNull(), "own").when(F.col("dir_licence").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.round("cosine", 9).alias("cosine"))
