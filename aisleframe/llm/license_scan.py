"""License notices in texts by conditional compression.

A candidate window is a cue word with as many words on both sides as a notice may take, across lines and paragraphs. It is
compressed by zstandard alone and with the notice as a raw dictionary. The bytes saved, against those that the dictionary saves
on the notice itself, say how much of the notice the window holds, however much other text stands around it. Notices are
ranked by this gain; those that explain enough are compared word by word with the window, best first, and the exact differences
decide. Lines with a cue word, and paragraphs with cue words on several lines, are candidates too, for notices with more words
put in between; there the share of the block's size counts.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher
from itertools import islice

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from aisleframe.llm.hashing import chunked
# Names of licenses as tags write them, and as notices do.
TAGGED = (
    ("Apache-2.0", "Apache License 2.0"), ("MIT", "MIT"), ("GPL-3.0", "GPL v3"), ("GPL-2.0", "GPL v2"), ("LGPL-3.0", "LGPL v3"),
    ("AGPL-3.0", "AGPL v3"), ("MPL-2.0", "MPL 2.0"), ("BSD-3-Clause", "BSD 3-Clause"), ("BSD-2-Clause", "BSD 2-Clause"),
    ("ISC", "ISC"), ("CC-BY-4.0", "CC BY 4.0"), ("CC-BY-SA-4.0", "CC BY-SA 4.0"), ("CC0-1.0", "CC0 1.0"))
FORMS = ("SPDX-License-Identifier: {tag}", "License: {tag}", "License: {name}", "available under the {name} licence")
# Public wordings of license notices.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
     "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
     "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
     "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("MIT", "MIT License"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
     "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
     "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("GPL-3.0", "GNU GPL v3"),
    ("GPL-2.0", "GNU GPL v2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
     "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
     "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Released under the 3-Clause BSD License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
     "provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
TAGS = tuple(
    dict.fromkeys((license_, form.format(tag=license_, name=name)) for form in FORMS for license_, name in TAGGED))
_GAP = rb"[\s*#/;%!|<>-]+"  # a line may end between two words
CUES = re.compile(
    rb"licen[sc]|gnu" + _GAP + rb"gpl|copyright|public" + _GAP + rb"domain|unencumbered|creative" + _GAP + rb"commons|permission|"
    rb"redistribut|binary" + _GAP + rb"forms|code" + _GAP + rb"form|free" + _GAP + rb"software|under" + _GAP + rb"law|neighbou?ring", re.I)

LEAST_GAIN = 0.3  # of the bytes that a notice saves on itself
LEAST_OWN = 16  # bytes; zstandard saves next to nothing on shorter notices, which are compared word by word at every cue
LEAST_SHARE = 0.2  # of a block's compressed size
SPARE = 10  # one word in so many of a notice may be missing or different
BETWEEN = 4  # words that a window holds beside the notice's own, and one more for so many of these
SHORT = 4  # notices of at most so many words have none in between
LEVEL = 3
FINE_LEVEL = 13  # of windows, where matches of few bytes tell notices apart

_WORD = re.compile(r"[^\s]+")
_BYTE_WORD = re.compile(rb"[^\s]+")


def _word(written: str) -> str:
    return written.strip(".,;:()\"'“”*#/-<>!%|").lower()  # comment signs before wrapped lines too


def _words(text: str) -> list[str]:
    return [w for w in map(_word, _WORD.findall(text)) if w]


# Words that tell licenses apart, beside all words with a digit.
_NAMING = frozenset(
    "apache mit gnu general lesser affero mozilla bsd isc creative commons attribution attribution-sharealike attribution-noncommercial "
    "attribution-noderivatives attribution-noncommercial-sharealike gpl lgpl agpl mpl cc by by-sa by-nc by-nc-sa by-nd by-nc-nd unencumbered waived".split())


# Words that take a notice back where one of the others follows at once or after one word.
_DENYING = frozenset("not never isn't aren't neither nor".split())
_GRANTING = frozenset("licensed released available covered distributed published offered under".split())
DENIED = 8  # words from there on, in the same sentence, at which no notice begins


def naming(word: str) -> bool:
    return word in _NAMING or any(c.isdigit() for c in word)


def blocks(text: bytes) -> list[tuple[int, bytes]]:
    """(first line, block) of candidate lines and paragraphs; lines are parted by line feeds, paragraphs by blank lines."""
    return [(first, block) for first, _, block in _candidates(text)]


def _candidates(text: bytes) -> list[tuple[int, int, bytes]]:
    """The same with the last line; a paragraph reaches from its first to its last line with a cue and comes after its lines."""
    if not CUES.search(text):
        return []
    found, paragraph = [], []
    for i, line in enumerate([*text.split(b"\n"), b""]):
        if line and not line.isspace():
            paragraph.append((i, line))
            if CUES.search(line):
                found.append((i, i, line))
        else:
            if sum(CUES.search(x) is not None for _, x in paragraph) > 1:
                first = next(k for k, (_, x) in enumerate(paragraph) if CUES.search(x))
                last = max(k for k, (_, x) in enumerate(paragraph) if CUES.search(x))
                found.append((paragraph[first][0], paragraph[last][0], b" ".join(x for _, x in paragraph[first: last + 1])))
            paragraph = []
    return found


def stretches(text: bytes, reach: int) -> Iterator[tuple[int, bytes]]:
    """(first line, text) from `reach` words before to `reach` words after each cue word; stretches that meet are one."""
    spans: list[list[int]] = []
    for cue in CUES.finditer(text):
        low = spans[-1][1] if spans else 0
        start = low
        if cue.start() > low:
            before = text[low: cue.start()].rsplit(None, reach)
            start += len(before[0]) if len(before) > reach else 0
        end = cue.end()
        for word in islice(_BYTE_WORD.finditer(text, end), reach + 1):
            end = word.end()
        if spans and start == low:
            spans[-1][1] = max(low, end)
        else:
            spans.append([start, end])
    line = at = 0
    for start, end in spans:
        line += text.count(b"\n", at, start)
        at = start
        yield line, text[start: end]


def differences(block: str, notice: str) -> tuple[int, list[str], bool]:
    """(changed words, what is missing or other, whether a naming word is among them); words around the notice don't count."""
    return _differences(_words(block), _words(notice))[:3]


def _differences(have: list[str], want: list[str]) -> tuple[int, list[str], bool, int, int]:
    """The same, and from where to where the notice stands in the block's words."""
    changed, shown, named = 0, [], False
    codes = SequenceMatcher(None, want, have, autojunk=False).get_opcodes()
    equal = [(c, d) for kind, _, _, c, d in codes if kind == "equal"] or [(0, 0)]
    for k, (kind, a, b, c, d) in enumerate(codes):
        outside = kind == "insert" and k in (0, len(codes) - 1)
        if kind == "equal" or outside:
            continue
        edge = a == b or k in (0, len(codes) - 1)
        changed += b - a if edge else max(b - a, d - c)
        shown.append(f"-{' '.join(want[a:b])} +{' '.join(have[c:d])}" if not edge else f"-{' '.join(want[a:b])}")
        named |= any(map(naming, want[a:b])) or kind == "insert" and any(map(naming, have[c:d]))
    return changed, shown, named, equal[0][0], equal[-1][1]


def _compressors(notices, level: int) -> tuple[zstandard.ZstdCompressor, list[zstandard.ZstdCompressor]]:
    """One without and one with each notice as a raw dictionary."""
    raw = [zstandard.ZstdCompressionDict(n.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT) for _, n in notices]
    return zstandard.ZstdCompressor(level=level), [zstandard.ZstdCompressor(level=level, dict_data=d) for d in raw]


class Scanner:
    def __init__(self, notices=NOTICES + TAGS):
        self.notices = notices
        # notices and blocks are compressed in lower case, with single spaces
        self.alone, self.given = _compressors(notices, LEVEL)
        self.alone_fine, self.given_fine = _compressors(notices, FINE_LEVEL)
        self.wants = [_words(n) for _, n in notices]
        self.needs = [(frozenset(w), frozenset(filter(naming, w)), len(w) // SPARE) for w in self.wants]
        self.widths = [len(w) + (BETWEEN + len(w) // BETWEEN if len(w) > SHORT else 0) for w in self.wants]
        self.reach = max(self.widths)
        self.ranked: dict[tuple[int, str], list[tuple[int, int, int]]] = {}
        self.own = [self._bytes_saved(" ".join(n.lower().split()).encode(), k) for k, (_, n) in enumerate(notices)]
        self.seen: dict[bytes, list[tuple]] = {}

    def scan(self, block: bytes) -> tuple[str, float, int, str] | None:
        """The finding with the fewest changed words, or None."""
        return min((hit[1:] for hit in self.findings(block)), key=lambda hit: hit[2], default=None)

    def in_block(self, block: bytes) -> list[tuple[str, float, int, str]]:
        """(license, share of the size that its notice saves, changed words, differences) of a block, one per license."""
        if block not in self.seen:
            if len(self.seen) >= 10_000:
                self.seen.clear()
            self.seen[block] = self._in_block(block)
        return self.seen[block]

    def _in_block(self, block: bytes) -> list[tuple[str, float, int, str]]:
        text = block.decode(errors="replace")
        plain = " ".join(text.lower().split()).encode()
        size = len(self.alone.compress(plain))
        written = [t.lower() for t in _WORD.findall(text) if _word(t)]
        words, denied = _words(text), [*_denials(written), False]
        saved = [(1 - len(c.compress(plain)) / size, -k) for k, c in enumerate(self.given) if len(self.wants[k]) > SHORT]
        found: dict[str, tuple] = {}
        for share, k in sorted(saved, reverse=True):
            if share < LEAST_SHARE:
                break
            license_, notice = self.notices[-k]
            if denied[_differences(words, self.wants[-k])[3]]:
                continue
            changed, shown, named = differences(text, notice)
            if not named and changed * SPARE <= len(_words(notice)) and (license_ not in found or changed < found[license_][2]):
                found[license_] = (license_, share, changed, "; ".join(shown))
        return list(found.values())

    def findings(self, text: bytes) -> list[tuple[int, str, float, int, str]]:
        """(line, license, share, changed words, differences) of a text, one per line and license."""
        if not CUES.search(text):
            return []
        found: dict[tuple[int, str], tuple] = {}
        windows = self.in_windows(text)
        for line, last, block in _candidates(text):
            for license_, *rest in self.in_block(block):
                if last == line or not any(a == license_ and line <= i <= last for i, a in (*found, *(w[:2] for w in windows))):
                    found[line, license_] = tuple(rest)
        for line, license_, *rest in windows:
            found.setdefault((line, license_), tuple(rest))
        return [(*key, *value) for key, value in sorted(found.items())]

    def in_windows(self, block: bytes) -> list[tuple[int, str, float, int, str]]:
        """(line, license, share of the notice's own stretch that is saved, changed words, differences), one per line and license."""
        found: dict[tuple[int, str], tuple] = {}
        for line, stretch in stretches(block, self.reach):
            text = stretch.decode(errors="replace")
            written, words, lines, at = [], [], [], 0
            for token in _WORD.finditer(text):
                line += text.count("\n", at, token.start())
                at = token.start()
                if word := _word(token.group()):
                    written.append(token.group().lower())
                    words.append(word)
                    lines.append(line)
            taken: list[tuple[str, int, int]] = []
            for changed, _, first, end, k, shown in sorted(set(self._confirmed(words, written))):
                license_ = self.notices[k][0]
                if any(other == license_ and first < e and f < end for other, f, e in taken):
                    continue
                taken.append((license_, first, end))
                if (lines[first], license_) not in found:
                    plain = " ".join(written[first: end]).encode()
                    share = 1 - len(self.given[k].compress(plain)) / len(self.alone.compress(plain))
                    found[lines[first], license_] = (share, changed, shown)
        return [(*key, *value) for key, value in sorted(found.items())]

    def _bytes_saved(self, plain: bytes, k: int) -> int:
        return len(self.alone_fine.compress(plain)) - len(self.given_fine[k].compress(plain))

    def ranking(self, written: list[str], at: int) -> list[tuple[float, int, int, int]]:
        """(gain, notice, first word, end) of the windows around the cue word at `at`, one for each notice, largest gain first."""
        alone: dict[int, tuple[bytes, int]] = {}
        ranked = []
        for k, width in enumerate(self.widths):
            first, end = max(at - width, 0), at + width + 1
            if width not in alone:
                plain = " ".join(written[first: end]).encode()
                alone[width] = plain, len(self.alone_fine.compress(plain))
            plain, size = alone[width]
            ranked.append(((size - len(self.given_fine[k].compress(plain))) / max(self.own[k], 1), k, first, end))
        return sorted(ranked, key=lambda r: (-r[0], r[1]))

    def _confirmed(self, words: list[str], written: list[str]) -> Iterator[tuple[int, int, int, int, int, str]]:
        """(changed words, minus length, first word, end, notice, differences) of the wordings in windows whose gain is large enough."""
        denied = _denials(written)
        for at in cue_words(written):
            key = min(at, self.reach), " ".join(written[max(at - self.reach, 0): at + self.reach + 1])
            if key not in self.ranked:  # boilerplate repeats
                if len(self.ranked) >= 10_000:
                    self.ranked.clear()
                self.ranked[key] = [
                    (k, first - at, end - at) for gain, k, first, end in self.ranking(written, at) if gain >= LEAST_GAIN or self.own[k] < LEAST_OWN]
            for k, first, end in self.ranked[key]:
                yield from self.wordings(words, denied, k, at + first, at + end)

    def wordings(self, words: list[str], denied: list[bool], k: int, low: int, high: int) -> Iterator[tuple[int, int, int, int, int, str]]:
        """The same of the wordings of one notice between two words, by exact comparison alone."""
        want, (needed, names, spare) = self.wants[k], self.needs[k]
        have = set(words[low: high])
        if len(needed - have) > spare or not names <= have:
            return
        starts, width = frozenset(want[:spare + 1]), self.widths[k]  # one of these words is unchanged
        for p in range(low, min(high, len(words))):
            if words[p] not in starts:
                continue
            window = words[p: min(p + width, high)]
            if len(needed.difference(window)) > spare or not names.issubset(window):
                continue
            changed, shown, named, first, end = _differences(window, want)
            if not named and changed <= spare and not denied[p + first]:
                yield changed, first - end, p + first, p + end, k, "; ".join(shown)


def _denials(written: list[str]) -> list[bool]:
    """Whether a notice that begins at the word would be a denied one."""
    denied, left = [], 0
    for at, token in enumerate(written):
        left = max(left - 1, 0)
        if _word(token) in _DENYING and not _GRANTING.isdisjoint(map(_word, written[at + 1: at + 3])):
            left = DENIED
        denied.append(left > 0)
        if token[-1] in ".;:!?":
            left = 0
    return denied


def cue_words(written: list[str]) -> list[int]:
    """Where the words with which a cue begins stand."""
    text = " ".join(written).encode()
    starts, at = [], 0
    for word in written:
        starts.append(at)
        at += len(word.encode()) + 1
    return sorted({bisect_right(starts, cue.start()) - 1 for cue in CUES.finditer(text)})


def _scan(keep: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for part, texts in chunked(batches):
            at, found = [], []
            for i, text in enumerate(texts):
                hits = scanner.findings(text)
                at += [i] * len(hits)
                found += hits
            rows = part.take(pa.array(at, pa.int64()))
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.string())
            made = [pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [*[rows.column(c) for c in keep], *made], names=[*keep, "line", "license", "saved", "n_changed", "differences"])
    return run


def license_findings(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep`, line, license, saved, n_changed and differences of each license notice in docs (text).

    line is the line on which the notice begins, from 0, or the first cue line of the paragraph for a notice with so many words
    put in between that no window holds it. A line has one row for each license whose notices begin on it, and a text any number
    of findings; null and empty texts, and texts without a notice, have none. Among notices of a license that explain a block
    equally well the first listed wins. A notice whose sentence denies it is none. saved is the share of the line's compressed size, or of the notice's own stretch where
    it is found by a window. Rows that repeat give repeated rows. Other columns of docs are not looked at.
    """
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*keep, "text").mapInArrow(
        _scan(list(keep)), f"{types}, line bigint, license string, saved double, n_changed bigint, differences string")
