import re

import pytest

from aerolake.llm import licences

NOTICES = {r"apache license": "apache", r"gnu general public": "gpl", r"mit license": "mit", r"cc by-nc": "cc-by-nc"}


@pytest.fixture(scope="module")
def model(spark):
    return licences.train(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_finds_the_notices_and_nothing_else(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = set()
    for r in docs.collect():
        for k, line in enumerate(r["text"].split("\n")):
            for pattern, family in NOTICES.items():
                if re.search(pattern, line.lower()):
                    want.add((r["doc_id"], k, family))
    got = licences.scan(docs, model).collect()
    assert {(r["doc_id"], r["paragraph"], r["family"]) for r in got} == want and len(want) > 20
    assert all(r["similarity"] >= licences.MIN_SIMILARITY and model.threshold <= r["probability"] <= 1 for r in got)


def test_the_scan_equals_judging_every_line(small_docs, model):
    extra = ["The MIT License\nReleased under the MIT License, and more\n\nplease licensed under the apache License, version 2.0 or so", "x\n" * 50 + "LICENSED UNDER CC BY-SA 4.0!"]
    texts = [r["text"].encode() for r in small_docs.collect()] + [t.encode() for t in extra]
    brute = [(i, k, *hit) for i, t in enumerate(texts) for k, line in enumerate(t.split(b"\n")) if (hit := model.judge(licences.plain_words(line)))]
    assert licences.scan_texts(model, texts) == brute and len(brute) >= 3


def test_families(model):
    for family, templates in licences.TEMPLATES.items():
        for t in templates:
            found = model.judge(licences.plain_words(t.encode()))
            assert found and found[0] == family, t
    for t in (*licences.OTHER, "he was released under the bridge", "license and registration please", "version two of the public work is free"):
        assert model.judge(licences.plain_words(t.encode())) is None, t


def test_awkward_and_empty(awkward, no_docs, spark):
    assert licences.scan(awkward).count() == 0
    assert licences.scan(no_docs).count() == 0
    rows = [(None, "Released under the MIT License."), (1, None), (2, "a\nReleased under the MIT License."), (2, "a\nReleased under the MIT License.")]
    got = licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["paragraph"], r["family"]) for r in got), key=str) == sorted([(None, 0, "mit"), (2, 1, "mit"), (2, 1, "mit")], key=str)


@pytest.mark.parametrize("line, family", [
    ("// SPDX-License-Identifier: GPL-3.0-or-later", "gpl"), ("/* SPDX-License-Identifier: AGPL-3.0-only */", "agpl"), ("# SPDX-License-Identifier: MIT", "mit"),
    ("The MIT License (MIT)", "mit"), ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "bsd"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "cc-by-sa"),
    ("This work is licensed under the Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", "cc-by-nc-nd"),
    ("This work is licensed under the Creative Commons Attribution 4.0 International License.", "cc-by"), ("Licensed under CC BY-ND 4.0", "cc-by-nd"),
    ("Licensed under the GNU Affero General Public License", "agpl"), ("SPDX-License-Identifier: EUPL-1.2", "unknown"), ("Licensed under the Foo License 2", "unknown")])
def test_real_notices(model, line, family):
    assert [r[:3] for r in licences.scan_texts(model, [f"some words\n{line}\nand more".encode()])] == [(0, 1, family)]


def test_keys_lose_nothing():
    for family, own in licences._PAIRS.items():
        for number, template in enumerate(own):
            keys = [k for k, at in licences._KEYED.items() if (family, number) in at]
            assert (len(template) - len(keys)) / len(template) < licences.MIN_SIMILARITY


@pytest.mark.parametrize("text, family, line", [
    ("x = 1\n// This file is licensed under the Apache\n// License, Version 2.0\ny = 2", "apache", 1), ("Released under the MIT\r\nLicense", "mit", 0),
    ("licensed under the Creative Commons Attribution\n-ShareAlike License", "cc-by-sa", 0),
    ("/*\n * This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n"
     " * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or (at your option) any later version.\n */", "lgpl", 1),
    ("# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions\n# are met:", "bsd", 0),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that", "unknown", 0)])
def test_wrapped_notices(model, text, family, line):
    assert [r[:3] for r in licences.scan_texts(model, [b"nothing here", text.encode()])] == [(1, line, family)]


def test_an_empty_line_ends_a_notice(model):
    assert licences.scan_texts(model, [b"Released under the MIT\n\nLicense", b"Released under the MIT", b"License"]) == []


def test_wrapped_at_any_width(model):
    import textwrap

    for family, templates in licences.TEMPLATES.items():
        for t in templates:
            for width in (30, 60):
                found = licences.scan_texts(model, [("# " + "\n# ".join(textwrap.wrap(t, width))).encode()])
                assert {r[2] for r in found} == {family}, (t, width, found)
