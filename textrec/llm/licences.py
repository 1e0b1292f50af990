"""License scans with a trained paragraph classifier.

Paragraphs are the lines of a text.  A sparse logistic regression over word
unigrams and bigrams, one against the rest for each licence family, is trained
from the notices in ``TEMPLATES`` and shortened variants of them, against
ordinary paragraphs and near-miss sentences.  The ordinary ones are
``SAMPLE_PARAGRAPHS`` distinct paragraphs of the documents, those with the
smallest hash of all; only the numbers of their known n-grams are collected,
so the sample is bounded however long a paragraph is.  A paragraph's class is
unknown unless the best family's probability reaches a threshold, calibrated
so that none of the sample's paragraphs that were not trained on reaches it.

A family is confirmed by comparing the paragraph with the templates.  The one
that it holds best, by the share of the template's word bigrams that stand in
the paragraph in the same order, has to be the family's and to be held to
``CONFIRM``.  At least half of the bigrams that tell it from the templates of
each other family have to be there: "GNU Lesser General" lacks the "GNU
General" that tells the GPL from the LGPL, "CC BY-ND 4.0" the "BY 4.0" that
tells CC BY from CC BY-NC.  ``n_unconfirmed`` counts
paragraphs that the classifier takes for a licence but no template confirms.

Notices are often wrapped.  Consecutive lines (no blank line between them) that
are no notices by themselves are read as one run of words, and the stretches of
a run that hold enough of a template and cross a line end are judged by the
same classifier and templates.  A wrapped notice counts once; its lines don't
count as unconfirmed.  A line that is a notice by itself counts by itself.

Only n-grams of the training notices carry weights, so a paragraph without any
is unknown at once.

Defined cases: null and empty texts have no paragraphs; empty tables give an
empty result; a text of any length is read whole; repeated rows are treated
alike; other columns are not looked at."""

from __future__ import annotations

import heapq
import re
from collections import Counter
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textrec.llm.common import id_text, id_type, ship_package, table, text_slices
from textrec.llm.learning import sigmoid

SAMPLE_PARAGRAPHS = 2048
CONFIRM = 0.6
MARGIN = 0.05
MIN_THRESHOLD = 0.5
#: A wrapped notice may be this many times as long as its template.
STRETCH = 2

#: Notices by licence family, as they are published or commonly
#: shortened.
NOTICES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License."),
    "Apache-1.1": (
        "Licensed under the Apache License, Version 1.1.",
        "The Apache Software License, Version 1.1"),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"),
    "LGPL": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation"),
    "AGPL": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation"),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    "CC0": (
        "Licensed under CC0 1.0.",
        "This work is dedicated to the public domain under CC0 1.0 Universal."),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-ND": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "CC-BY-NC-SA": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    "CC-BY-NC-ND": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International "
        "License."),
    "Proprietary": (
        "All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without prior written permission.",
        "Copyright (c) the authors. All rights reserved.",
        "This document is confidential and proprietary."),
}
#: Short identifiers of the families in file headers.
IDENTIFIERS = {
    "Apache-2.0": ("Apache-2.0",), "Apache-1.1": ("Apache-1.1",), "MIT": ("MIT",), "ISC": ("ISC",),
    "GPL": ("GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"),
    "LGPL": ("LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    "AGPL": ("AGPL-3.0-only", "AGPL-3.0-or-later"), "MPL-2.0": ("MPL-2.0",),
    "BSD": ("BSD-2-Clause", "BSD-3-Clause"), "CC0": ("CC0-1.0",), "CC-BY": ("CC-BY-4.0",),
    "CC-BY-NC": ("CC-BY-NC-4.0",), "CC-BY-SA": ("CC-BY-SA-4.0",), "CC-BY-ND": ("CC-BY-ND-4.0",),
    "CC-BY-NC-SA": ("CC-BY-NC-SA-4.0",), "CC-BY-NC-ND": ("CC-BY-NC-ND-4.0",)}
TEMPLATES = {f: (*notices, *(f"SPDX-License-Identifier: {i}" for i in IDENTIFIERS.get(f, ())))
             for f, notices in NOTICES.items()}
#: Sentences that mention licences and are none.
NEAR_MISSES = (
    "She renewed her driving license under the new rules.", "The general public was not allowed to use the work.",
    "Version 2.0 of the software was released in spring.", "The MIT team published a paper on free software.",
    "He has a license to sell wine.", "Apache helicopters flew over the base.", "This work is about the public good.",
    "The fishing license costs 4.0 euros a day.", "We are free to use the source.", "version 3 of the file")
FAMILIES = tuple(TEMPLATES)
_TOKENS = re.compile(r"\w+(?:\.\w+)*").findall


def tokens_of(paragraph: str) -> list[str]:
    return _TOKENS(paragraph.lower())


def grams(tokens: list[str]) -> set:
    return {*tokens, *zip(tokens, tokens[1:], strict=False)}


def paragraphs(text: str) -> list[str]:
    return [p for p in text.split("\n") if p.strip()]


def line_runs(text: str) -> list[list[tuple[int, str]]]:
    """(paragraph number, line) of consecutive lines without a blank one."""
    out, i, run = [], 0, []
    for p in text.split("\n"):
        if p.strip():
            run.append((i, p))
            i += 1
        elif run:
            out.append(run)
            run = []
    return [*out, run] if run else out


def bigrams(tokens: list[str]) -> list[tuple[str, str]]:
    return list(zip(tokens, tokens[1:], strict=False))


class Template:
    """A notice's word bigrams, their order and those that tell its family from
    each of the others (given by all their bigrams)."""

    def __init__(self, notice: str, others: list[set]):
        self.bigrams = bigrams(tokens_of(notice))
        self.telling = [set(self.bigrams) - other for other in others]
        self.places: dict[tuple[str, str], int] = {}
        for i, g in enumerate(self.bigrams):
            self.places[g] = self.places.get(g, 0) | 1 << i

    def share(self, found: list[tuple[str, str]]) -> float:
        """The longest common subsequence with a paragraph's bigrams, as a share
        of the template: one bit of a whole number for each template bigram."""
        full = (1 << len(self.bigrams)) - 1
        free = full
        for g in found:
            at = self.places.get(g)
            if at:
                hit = free & at
                free = ((free + hit) | (free - hit)) & full
        return (len(self.bigrams) - free.bit_count()) / len(self.bigrams)

    def told(self, have: set) -> bool:
        return all(2 * len(t & have) >= len(t) for t in self.telling)


def all_templates() -> list[list[Template]]:
    of = {f: {g for t in TEMPLATES[f] for g in bigrams(tokens_of(t))} for f in FAMILIES}
    return [[Template(t, [of[o] for o in FAMILIES if o != f]) for t in TEMPLATES[f]] for f in FAMILIES]


def template_counts() -> list[list[Counter]]:
    """The word bigrams of each template, by family."""
    return [[Counter(zip(t, t[1:], strict=False)) for t in map(tokens_of, TEMPLATES[f])] for f in FAMILIES]


def stretches(tokens: list[str], template: Counter) -> list[tuple[float, int, int]]:
    """(template share, start, end) of the stretches of words that hold at least
    ``CONFIRM`` of a template's bigrams, from left to right."""
    size = template.total()
    hits = [(i, g) for i, g in enumerate(zip(tokens, tokens[1:], strict=False)) if g in template]
    out, first = [], 0
    have, matched = Counter(), 0
    k = 0
    while k < len(hits):
        at, g = hits[k]
        while first < k and hits[first][0] <= at - STRETCH * size:
            old = hits[first][1]
            matched -= have[old] <= template[old]
            have[old] -= 1
            first += 1
        have[g] += 1
        matched += have[g] <= template[g]
        k += 1
        if matched >= CONFIRM * size:
            while have[hits[first][1]] > template[hits[first][1]]:  # a spare one before the notice
                have[hits[first][1]] -= 1
                first += 1
            start, end = hits[first][0], at
            while k < len(hits) and hits[k][0] < start + STRETCH * size:
                g = hits[k][1]
                have[g] += 1
                if have[g] <= template[g]:
                    matched, end = matched + 1, hits[k][0]
                k += 1
            out.append((matched / size, start, end + 2))
            while k and hits[k - 1][0] > end:
                k -= 1
            first, have, matched = k, Counter(), 0
    return out


def wrapped(run: list[tuple[int, list[str]]], templates: list[list[Counter]],
            known: set | None = None) -> list[tuple[int, float, int, int]]:
    """(family, template share, first, last) of stretches that cross a line end
    in a run of (paragraph number, words); first and last are places in it.
    ``known``: the bigrams of all templates."""
    tokens = [t for _, line in run for t in line]
    have = set(zip(tokens, tokens[1:], strict=False))
    if known is not None:
        have &= known
    if not have:
        return []
    out, place = [], None
    for k, family in enumerate(templates):
        for t in family:
            if len(have) >= CONFIRM * len(t) and len(have & t.keys()) >= CONFIRM * len(t):
                place = place or [n for n, (_, line) in enumerate(run) for _ in line]
                out += [(k, share, place[start], place[end - 1]) for share, start, end in stretches(tokens, t)
                        if place[start] < place[end - 1]]
    return out


def variants(text: str) -> list[list[str]]:
    """A notice whole, without a word at a time, and in longer paragraphs whose
    other words may be those of other notices."""
    t = tokens_of(text)
    out = [t, ["copyright", "2024", *t], [*t, "see", "the", "file"], ["this", "file", "is", *t, "by", "the", "authors"],
           ["the", "text", "of", "this", "work", "is", *t, "and", "the", "software", "as", "published"]]
    return out + [t[:i] + t[i + 1:] for i in range(len(t)) if len(t) > 4]


def notice_rows() -> list[tuple[int, list[str]]]:
    """(family, words) of the notices and their variants."""
    return [(f, v) for f, name in enumerate(FAMILIES) for t in TEMPLATES[name] for v in variants(t)]


def gram_numbers() -> dict:
    """Numbers of the words and bigrams of the training notices."""
    return {g: i for i, g in enumerate(sorted({g for _, v in notice_rows() for g in grams(v)}, key=str))}


class Model:
    """``ordinary``: for each ordinary paragraph the numbers of its known n-grams."""

    def __init__(self, ordinary: list[list[int]], epochs: int = 2000, rate: float = 4.0, ridge: float = 1e-5):
        self.number = gram_numbers()
        rows = [(f, self.ids(v)) for f, v in notice_rows()]
        rows += [(-1, self.ids(tokens_of(p))) for p in NEAR_MISSES]
        rows += [(-1, ids) for i, ids in enumerate(ordinary) if i % 3]
        x = np.zeros((len(rows), len(self.number) + 1), np.float32)
        x[:, -1] = 1
        for r, (_, ids) in enumerate(rows):
            x[r, ids] = self.value(ids)
        y = np.array([[f == k for k in range(len(FAMILIES))] for f, _ in rows], np.float32)
        self.weights = np.zeros((len(self.number) + 1, len(FAMILIES)), np.float32)
        balance = np.where(y.any(axis=1), len(rows) / max(1, y.sum()), 1.0)[:, None] / len(rows)
        for _ in range(epochs):
            p = sigmoid(x @ self.weights)
            self.weights -= rate * (x.T @ ((p - y) * balance) + ridge * self.weights)
        best = [self.best(ids)[1] for ids in ordinary[::3]]
        self.threshold = max(MIN_THRESHOLD, min(0.95, max(best, default=0.0) + MARGIN))
        self.templates, self.counts = all_templates(), template_counts()
        self.known = {g for family in self.counts for t in family for g in t}

    def ids(self, tokens: list[str]) -> list[int]:
        return [self.number[g] for g in grams(tokens) & self.number.keys()]

    @staticmethod
    def value(ids) -> float:
        return 1 / max(1, len(ids)) ** 0.5

    def best(self, ids: list[int]) -> tuple[int, float]:
        """The most likely family and its probability."""
        p = sigmoid(self.weights[ids].sum(axis=0) * self.value(ids) + self.weights[-1])
        k = int(p.argmax())
        return k, float(p[k])

    def confirmed(self, tokens: list[str]) -> tuple[int, float]:
        """The family one of whose templates the paragraph holds best, and the
        template share; -1 if that template's telling bigrams are missing."""
        found = [g for g in bigrams(tokens) if g in self.known]
        have, best = set(found), (-1, 0.0)
        for k, templates in enumerate(self.templates):
            for t in templates:
                if len(have & t.places.keys()) > best[1] * len(t.bigrams) * 0.999 - 1:
                    share = t.share(found)
                    if share > best[1]:
                        best = (k if t.told(have) else -1, share)
        return best

    def scan(self, text: str) -> tuple[list[tuple[str, float, float, int]], int, int]:
        """Confirmed notices (family, probability, template share, paragraph),
        the number of paragraphs, and how many notices nothing confirmed."""
        found, unconfirmed, n = [], 0, 0
        for lines in line_runs(text):
            n += len(lines)
            rest, doubtful = [[]], set()
            for i, p in lines:
                tokens = tokens_of(p)
                k, probability, share, held = self.judge(tokens)
                if held:
                    found.append((FAMILIES[k], probability, share, i))
                    rest.append([])
                    continue
                if k >= 0:
                    doubtful.add(i)
                rest[-1].append((i, tokens))
            for run in rest:
                if len(run) > 1:
                    joined = self.joined(run)
                    found += [x for x, _ in joined]
                    doubtful -= {i for _, taken in joined for i in taken}
            unconfirmed += len(doubtful)
        return sorted(found, key=lambda x: x[3]), n, unconfirmed

    def judge(self, tokens: list[str]) -> tuple[int, float, float, bool]:
        """The family of a paragraph (-1: unknown), its probability, the
        template share and whether a template confirms it."""
        ids = self.ids(tokens)
        if ids:
            k, probability = self.best(ids)
            if probability >= self.threshold:
                other, share = self.confirmed(tokens)
                return k, probability, share, share >= CONFIRM and other == k
        return -1, 0.0, 0.0, False

    def joined(self, run: list[tuple[int, list[str]]]) -> list[tuple[tuple[str, float, float, int], list[int]]]:
        """Wrapped notices of a run, the fullest first where they overlap, and
        the paragraphs that each takes."""
        out, taken = [], set()
        for k, _, first, last in sorted(wrapped(run, self.counts, self.known), key=lambda x: (-x[1], x[2] - x[3], x)):
            places = range(first, last + 1)
            family, probability, share, held = self.judge([t for _, line in run[first:last + 1] for t in line])
            if held and family == k and taken.isdisjoint(places):
                taken.update(places)
                out.append(((FAMILIES[k], probability, share, run[first][0]), [run[p][0] for p in places]))
        return out


def ordinary_of(text: str, want, counts: list[list[Counter]], known: set):
    """(hash, words) of the paragraphs that ``want(hash)`` asks for, in which no
    template is half present and that are no part of a wrapped notice."""
    for run in line_runs(text):
        keys = [(blake2b(p.encode("utf-8", "surrogatepass"), digest_size=8).digest(), i, p) for i, p in run]
        asked = [(key, i, p) for key, i, p in keys if want(key)]
        if not asked:
            continue
        parts = set()
        for _, _, first, last in wrapped([(i, tokens_of(p)) for i, p in run], counts, known):
            parts.update(i for i, _ in run[first:last + 1])
        for key, i, p in asked:
            tokens = tokens_of(p)
            have = set(bigrams(tokens)) & known
            if i not in parts and all(2 * len(t.keys() & have) < len(t) for family in counts for t in family):
                yield key, tokens


def ordinary_paragraphs(docs: DataFrame, text_col: str = "text", limit: int = SAMPLE_PARAGRAPHS) -> list[list[int]]:
    """The known n-grams of the ``limit`` distinct ordinary paragraphs with the
    smallest hash.  Each task keeps its smallest ones, so only paragraphs that
    may be among them are looked into."""
    ship_package(docs.sparkSession)

    def run(batches):
        number, counts = gram_numbers(), template_counts()
        known = {g for family in counts for t in family for g in t}
        kept: dict[bytes, list[int]] = {}
        worst: list[int] = []  # a heap of the kept hashes, the largest first

        def want(key):
            return key not in kept and (len(kept) < limit or int.from_bytes(key) < -worst[0])

        for _, texts in text_slices(batches):
            for text in texts:
                for key, tokens in ordinary_of(text, want, counts, known):
                    if want(key):
                        kept[key] = sorted(number[g] for g in grams(tokens) & number.keys())
                        heapq.heappush(worst, -int.from_bytes(key))
                        if len(kept) > limit:
                            del kept[(-heapq.heappop(worst)).to_bytes(8)]
        yield pa.RecordBatch.from_arrays([pa.array(list(kept), pa.binary()), pa.array(list(kept.values()), pa.list_(pa.int32()))],
                                         names=["key", "ids"])

    rows = (docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "key binary, ids array<int>")
            .groupBy("key").agg(F.min("ids").alias("ids")).orderBy("key").limit(limit).collect())
    return [list(r.ids) for r in rows]


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_paragraphs, families (sorted, comma-joined), n_notices,
    n_unconfirmed, confidence (of the surest notice, else 0)."""
    ship_package(docs.sparkSession)
    pairs = id_text(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the size of the notices' n-grams

    def run(batches):
        m = shared.value
        for rows, texts in text_slices(batches):
            found = [m.scan(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([n for _, n, _ in found], pa.int64()),
                 pa.array([",".join(sorted({f for f, *_ in x})) for x, _, _ in found], pa.string()),
                 pa.array([len(x) for x, _, _ in found], pa.int64()), pa.array([u for _, _, u in found], pa.int64()),
                 pa.array([max((p for _, p, _, _ in x), default=0.0) for x, _, _ in found], pa.float64())],
                names=["doc_id", "n_paragraphs", "families", "n_notices", "n_unconfirmed", "confidence"])

    return pairs.mapInArrow(run, f"doc_id {id_type(pairs)}, n_paragraphs bigint, families string, n_notices bigint, "
                                 "n_unconfirmed bigint, confidence double")


def op3_paragraph_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs, Model(ordinary_paragraphs(docs)))
