import random
import re
import time

import pytest

import aisleframe.llm.license_scan as module
from aisleframe.llm.license_scan import NOTICES, TAGS, Scanner, blocks, license_findings


@pytest.mark.parametrize("license_, notice", NOTICES + TAGS)
def test_every_notice_is_found(license_, notice):
    scanner = Scanner()
    for text in (notice, notice.upper(), f"see: {notice} thanks", notice.replace(" ", "  ")):
        found = scanner.scan(text.encode())
        assert found and found[0] == license_ and found[2] == 0 and found[1] > 0


def test_wording_decides():
    scanner = Scanner()
    assert scanner.scan(b"Licensed under the Apache License, Version 1.1.") is None
    assert scanner.scan(b"Licensed under the Foo License, Version 2.0.") is None
    assert scanner.scan(b"Licensed under CC BY-SA 3.0.") is None
    assert scanner.scan(b"You need a license to drive a car in this country.") is None
    long = NOTICES[4][1].replace("hereby granted", "hereby given").encode()
    license_, _, changed, shown = scanner.scan(long)
    assert (license_, changed) == ("MIT", 1) and "granted" in shown and "given" in shown


def by_wording_alone(scanner, text):
    """(line, license, changed words) of every notice that stands anywhere in the text, nothing compressed."""
    tokens = [(t.group().lower(), text.count("\n", 0, t.start())) for t in re.finditer(r"\S+", text)]
    tokens = [(t, line) for t, line in tokens if module._word(t)]
    written, words = [t for t, _ in tokens], [module._word(t) for t, _ in tokens]
    denied, found, taken = module._denials(written), {}, []
    hits = sorted({h for k in range(len(scanner.notices)) for h in scanner.wordings(words, denied, k, 0, len(words))})
    for changed, _, first, end, k, _ in hits:
        license_ = scanner.notices[k][0]
        if not any(x == license_ and first < e and f < end for x, f, e in taken):
            taken.append((license_, first, end))
            found.setdefault((tokens[first][1], license_), changed)
    return sorted((*key, n) for key, n in found.items())


def test_ranking_leaves_out_no_notice_that_wording_finds():
    """Windows ranked by compression against every notice at every word, on notices with words put in, taken out and changed."""
    draw, scanner, found = random.Random(9), Scanner(), 0
    prose = PROSE.decode().split()
    for _ in range(400):
        words = []
        for _ in range(draw.randint(1, 4)):
            words += draw.choices(prose, k=draw.randint(0, 60))
            notice = draw.choice(NOTICES + TAGS)[1].split()
            for _ in range(draw.choice([0, 0, 1, 2, 4])):
                at = draw.randrange(len(notice))
                notice[at: at + draw.randint(0, 1)] = [draw.choice(prose)] * draw.randint(0, 1)
                notice = notice or ["the"]
            words += notice
        text = "".join(w + draw.choice("    \n") for w in words)
        wanted = by_wording_alone(scanner, text)
        assert sorted((line, x, n) for line, x, _, n, _ in scanner.in_windows(text.encode())) == wanted
        found += len(wanted)
    assert found > 400


def test_ranking_by_bytes_saved():
    scanner = Scanner()
    for k, (_, notice) in enumerate(NOTICES + TAGS):
        written = f"{PROSE.decode()} {notice} {PROSE.decode()}".lower().split()
        at = next(i for i in module.cue_words(written) if i >= len(PROSE.split()))
        gains = {n: gain for gain, n, _, _ in scanner.ranking(written, at)}
        assert gains[k] >= 0.5 or scanner.own[k] < module.LEAST_OWN, (k, notice, gains[k], scanner.own[k])
    nothing = "you need a license to drive a car".split()
    assert all(gain < module.LEAST_GAIN for gain, k, _, _ in scanner.ranking(nothing, 3) if scanner.own[k] >= module.LEAST_OWN)


@pytest.mark.parametrize("text", [
    "Not licensed under the MIT license.", "This is never released under the MIT License", "It isn't available under the MIT licence.",
    "The code is not yet licensed under CC BY 4.0.", "a license granted by MIT", "License and MIT"])
def test_denied_or_only_named(text):
    assert Scanner().findings(text.encode()) == []


@pytest.mark.parametrize("text, license_", [
    ("MIT License\n\nCopyright (c) 2020 someone", "MIT"), ("License: MIT", "MIT"), ("// SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
    ("It is available under the MIT licence.", "MIT"), ("covered by the GNU GPL v3, see below", "GPL-3.0"),
    ("This is not the end. Released under the MIT License.", "MIT"), ("What is not code is licensed under CC BY 4.0.", "CC-BY-4.0")])
def test_short_forms(text, license_):
    assert {f[1] for f in Scanner().findings(text.encode())} == {license_}


def test_very_long_text():
    text = (PROSE * 20_000 + NOTICES[0][1].encode() + b"\n") * 2
    began = time.perf_counter()
    assert [f[:2] for f in Scanner().findings(text)] == [(0, "Apache-2.0"), (1, "Apache-2.0")]
    assert time.perf_counter() - began < 60


def test_blocks():
    text = b"one\nMIT license here\n\npermission is\ngranted by\nthe copyright owner\n\nend"
    assert blocks(text) == [(1, b"MIT license here"), (3, b"permission is"), (5, b"the copyright owner"), (3, b"permission is granted by the copyright owner")]
    assert blocks(b"") == [] == blocks(b"nothing")


def test_table(docs_of):
    wrapped = NOTICES[4][1].replace(" copies of", "\ncopies of").replace(" associated", "\nassociated")
    rows = [(1, f"a b\n{NOTICES[0][1]}\nc"), (2, None), (3, ""), (4, "no such thing"), (5, f"{NOTICES[2][1]}\n\n{NOTICES[-2][1]}"), (6, wrapped),
            (1, f"a b\n{NOTICES[0][1]}\nc"), (None, NOTICES[2][1])]
    found = license_findings(docs_of(rows)).collect()
    assert sorted((r["doc_id"] or 0, r["line"], r["license"]) for r in found if r["doc_id"] != 6) == [
        (0, 0, "MIT"), (1, 1, "Apache-2.0"), (1, 1, "Apache-2.0"), (5, 0, "MIT"), (5, 2, "CC0-1.0")]
    assert {r["license"] for r in found if r["doc_id"] == 6} == {"MIT"}
    assert license_findings(docs_of([])).collect() == []


PROSE = b"The river rises in the hills above the town, and for most of the year it is shallow enough to be crossed on foot. "


@pytest.mark.parametrize("license_, notice", NOTICES + TAGS)
def test_notice_behind_other_text_on_its_line(license_, notice):
    scanner = Scanner()
    for times in (1, 3, 40):
        line = PROSE * times + notice.encode() + b" " + PROSE * times
        found = [f[1:] for f in scanner.in_windows(line)]
        assert [(f[0], f[2]) for f in found] == [(license_, 0)] and found[0][1] > 0
    assert scanner.in_windows(PROSE + b"It is licensed under rules of the Apache people, license 7.0. " + PROSE) == []


def test_table_of_notices_behind_other_text(docs_of):
    rows = [(i, PROSE.decode() * 3 + n) for i, (_, n) in enumerate(NOTICES)]
    found = license_findings(docs_of(rows)).collect()
    assert sorted((r["doc_id"], r["line"], r["license"]) for r in found) == [(i, 0, x) for i, (x, _) in enumerate(NOTICES)]


@pytest.mark.parametrize("license_, notice", NOTICES + TAGS)
def test_notice_wrapped_anywhere(license_, notice):
    scanner, words = Scanner(), notice.split()
    for sign in ("", "# ", " * ", "-- "):
        for k in range(1, len(words)):
            text = f"first line\n{sign}{' '.join(words[:k])}\n{sign}{' '.join(words[k:])}\nlast line"
            assert {(f[0], f[1]) for f in scanner.findings(text.encode()) if f[0] == 1} == {(1, license_)}
    text = "Copyright 2020 someone\n\n" + "\n".join(words) + "\n\nend"
    assert (2, license_) in [f[:2] for f in scanner.findings(text.encode())]


def test_headers_as_they_are_wrapped(docs_of):
    gpl = """Copyright (C) 2020 someone

    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful."""
    bsd = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:"""
    apache = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at

#     http://www.apache.org/licenses/LICENSE-2.0
"""
    both = "Released under the MIT License. Parts of it are licensed under the Apache License, Version 2.0.\nThe text is licensed under CC BY 4.0."
    found = license_findings(docs_of([(1, gpl), (2, gpl.replace("version 3", "version 2")), (3, bsd), (4, apache), (5, both)])).collect()
    assert sorted((r["doc_id"], r["line"], r["license"]) for r in found) == [
        (1, 2, "GPL-3.0"), (2, 2, "GPL-2.0"), (3, 0, "BSD-2-Clause"), (4, 0, "Apache-2.0"), (5, 0, "Apache-2.0"), (5, 0, "MIT"), (5, 1, "CC-BY-4.0")]
