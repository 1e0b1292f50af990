import random
import re
import textwrap

import pytest

from textrec.llm import licences as L


@pytest.fixture(scope="module")
def model(spark):
    return L.Model(L.ordinary_paragraphs(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))


def test_query_equals_the_lines_in_the_documents(spark):
    """Brute force: a line that is one of the notices, wherever it stands."""
    sf = "/root/testdata/sf0.01"
    notices = {" ".join(L.tokens_of(t)): f for f, ts in L.TEMPLATES.items() for t in ts}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = L.op3_paragraph_licences(spark, sf).collect()
    assert len(rows) == len(texts)
    found = 0
    for r in rows:
        lines = [p for p in (texts[r.doc_id] or "").split("\n") if p.strip()]
        want = {notices[" ".join(L.tokens_of(p))] for p in lines if " ".join(L.tokens_of(p)) in notices}
        assert r.families == ",".join(sorted(want)) and r.n_paragraphs == len(lines), r
        found += bool(want)
    assert found > 10


def test_families_variants_and_near_misses(model):
    for family, templates in L.TEMPLATES.items():
        for t in templates:
            assert [x[0] for x in model.scan(t)[0]] == [family], t
            assert [x[0] for x in model.scan(f"Copyright 2021 A. Person\n{t.upper()} \nmore")[0]][-1:] == [family], t
    for t in L.NEAR_MISSES + ("license", "MIT", "under the", "the license of the version"):
        assert model.scan(t)[0] == [], t
    text = "Licensed under the Apache License, Version 2.0.\nword\nReleased under the MIT License."
    assert [(x[0], x[3]) for x in model.scan(text)[0]] == [("Apache-2.0", 0), ("MIT", 2)]


def test_odd_rows(spark, odd_docs, no_docs, model):
    rows = L.scan(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(r.families == "" for r in rows)
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    assert all(r.n_paragraphs == len([p for p in re.split("\n", texts[r.doc_id] or "") if p.strip()]) for r in rows)
    assert L.scan(no_docs, model).count() == 0 and L.ordinary_paragraphs(no_docs) == []
    assert [x[0] for x in L.Model([]).scan("Released under the MIT License.")[0]] == ["MIT"]


@pytest.mark.parametrize("width", [30, 70, 75, 80])
def test_wrapped_notices(model, width):
    """The notices wrapped as in real files, with comment signs or without, and
    between other lines."""
    for family, templates in L.TEMPLATES.items():
        for t in templates:
            lines = textwrap.wrap(t, width)
            if len(lines) < 2 or model.scan(lines[0])[0]:  # a first line that is a notice counts by itself
                continue
            for sign in ("", "# ", " * "):
                body = "\n".join(sign + x for x in lines)
                for text in (body, f"A file of the project\n{body}\nand the code begins here\nwith other words", body + "\n\n" + body):
                    found, n, unconfirmed = model.scan(text)
                    assert {x[0] for x in found} == {family} and unconfirmed == 0, (text, found)
                    assert len(found) == 1 + ("\n\n" in text) and n == len([x for x in text.split("\n") if x.strip()])
    bsd = textwrap.wrap(L.TEMPLATES["BSD"][0], 75)
    assert model.scan("\n\n".join(bsd))[0] == []
    assert model.scan("\n".join(L.NEAR_MISSES))[0] == []
    many = "\n".join(f"line {i} of a long file" for i in range(3000))
    assert [(x[0], x[3]) for x in model.scan("\n".join([many, *bsd, many]))[0]] == [("BSD", 3000)]


#: Notices as files have them, most in other words than the templates'; some
#: short identifiers are templates too.  One ("by the authors") was missed until
#: the training variants got other words around the notice.
HELD_OUT = {
    "LGPL": ("This file is part of a library that is free software; you can redistribute it and/or modify it under the terms "
             "of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1",
             "SPDX-License-Identifier: LGPL-2.1-only"),
    "AGPL": ("you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
             "published by the Free Software Foundation, version 3",),
    "GPL": ("Foo is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License",
            "// SPDX-License-Identifier: GPL-2.0-only"),
    "CC-BY-ND": ("The text is licensed under CC BY-ND 4.0",
                 "This photo is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-NC-SA": ("Except where noted, licensed under CC BY-NC-SA 4.0",),
    "CC-BY-NC-ND": ("The slides are licensed under CC BY-NC-ND 4.0.",),
    "CC-BY-NC": ("Figures licensed under CC BY-NC 4.0",),
    "CC-BY": ("Data licensed under CC BY 4.0 by the authors",),
    "Apache-1.1": ("This code is licensed under the Apache License, Version 1.1",),
    "Apache-2.0": ("This code is licensed under the Apache License, Version 2.0",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.\nIf a copy of the MPL was "
                "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
                "# SPDX-License-Identifier: MPL-2.0"),
    "ISC": ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies.",
            "SPDX-License-Identifier: ISC"),
    "MIT": ("The code is released under the MIT License, see LICENSE",),
}


def test_held_out_notices_get_their_family(model):
    for family, notices in HELD_OUT.items():
        for t in notices:
            assert {x[0] for x in model.scan(t)[0]} == {family}, (t, model.scan(t))


def test_notices_of_no_family_are_not_taken_for_one(model):
    """A word that contradicts the family: nothing confirms it."""
    for t in ("This work is licensed under the GNU Free Documentation License, version 1.3.",
              "Licensed under CC BY-XX 4.0.", "SPDX-License-Identifier: Zlib", "SPDX-License-Identifier: BSL-1.0",
              "Released under the Eclipse Public License.", "Licensed under the Educational Community License, Version 2.0.",
              "Released under the Ruby License."):
        assert model.scan(t)[0] == [], (t, model.scan(t))


def test_share_is_in_order():
    """Against the plain table of the longest common subsequence."""
    rng = random.Random(5)
    t = L.Template(L.TEMPLATES["GPL"][1], [])
    for _ in range(200):
        found = [rng.choice(t.bigrams + [("x", "y")]) for _ in range(rng.randrange(60))]
        row = [0] * (len(t.bigrams) + 1)
        for g in found:
            old = row[:]
            for i, b in enumerate(t.bigrams):
                row[i + 1] = old[i] + 1 if g == b else max(old[i + 1], row[i])
        assert t.share(found) == row[-1] / len(t.bigrams)
    assert t.share(t.bigrams) == 1 and t.share(t.bigrams[::-1]) < 0.2


def test_sample_covers_all_paragraphs(spark):
    """Brute force of the sample: long texts and long paragraphs count too."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    long = "\n\n".join(f"paragraph {i} of a long text " + "the terms of it " * (i % 7) * 300 for i in range(400))
    docs = docs.select("text").unionByName(spark.createDataFrame([(long,), (long,), (None,)], "text string"))
    counts, number = L.template_counts(), L.gram_numbers()
    known = {g for family in counts for t in family for g in t}
    want = {}
    for r in docs.collect():
        want.update(L.ordinary_of(r.text or "", lambda key: True, counts, known))
    ids = [sorted(number[g] for g in L.grams(want[k]) & number.keys()) for k in sorted(want)]
    assert len(ids) > 500
    for limit in (50, 10**6):
        assert L.ordinary_paragraphs(docs.repartition(5), limit=limit) == ids[:limit]
