"""License scans by patience alignment of texts with license templates.

A template's telling words pick the regions of a text that may hold it. A region is aligned with
the template by patience: words that occur once in either are anchors, the longest increasing
run of anchors stays, and the gaps between anchors are aligned in the same way, equal ends first.
Coverage is the share of the template's words that found a place. The words that tell a license from
its siblings (name, version) must all be found, next to each other.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import built, words

#: From this coverage on a template counts as found.
LEAST_COVERAGE = 0.8

# Public license notices, as their authors ask for them to be stated.
TEMPLATES: dict[str, str] = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software."
    ),
    "MIT-line": "Released under the MIT License.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        "in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
        "list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version. This program is distributed in the "
        "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-line": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License."
    ),
    "Reserved": "All rights reserved.",
}

#: What tells a template from its siblings: phrases that a text must hold in this order, with
#: nothing inserted. A template without any needs its coverage only.
TELLING: dict[str, tuple[str, ...]] = {
    "MIT-line": ("MIT License",),
    "Apache-2.0": ("Apache License, Version 2.0",),
    "Apache-2.0-line": ("Apache License, Version 2.0",),
    "GPL-3.0": ("GNU General Public License", "version 3 of the License"),
    "GPL-3.0-line": ("GNU General Public License, version 3",),
    "CC-BY-NC-4.0-line": ("CC BY-NC 4.0",),
    "CC-BY-4.0-line": ("Creative Commons Attribution 4.0",),
}


def _add(name: str, text: str, *telling: str) -> None:
    TEMPLATES[name] = text
    TELLING[name] = telling


CC_PARTS = {"SA": "ShareAlike", "ND": "NoDerivatives", "NC": "NonCommercial"}


def _add_siblings() -> None:
    """The same notices for the licenses that differ from the above in a few words, and for other
    ways to write the telling words."""
    for name, title in (
        ("MIT-expat", "MIT (Expat) License"),
        ("MIT-x11", "MIT/X11 License"),
        ("MIT-0", "MIT-0 License"),
        ("MIT-0-named", "MIT No Attribution License"),
        ("ISC", "ISC License"),
        ("BSD", "BSD License"),
        ("BSD-2-Clause", "BSD 2-Clause License"),
        ("BSD-3-Clause", "BSD 3-Clause License"),
    ):
        _add(f"{name}-line", f"Released under the {title}.", title)
    for version in ("1.0", "1.1", "2.0"):
        for kind, title in (
            ("line", f"Apache License, Version {version}"),
            ("short", f"Apache License {version}"),
            ("v", f"Apache License v{version}"),
        ):
            if f"Apache-{version}-{kind}" not in TEMPLATES:
                _add(f"Apache-{version}-{kind}", f"Licensed under the {title}.", title)
            if version == "2.0" and kind != "line":
                notice = TEMPLATES["Apache-2.0"].replace("Apache License, Version 2.0", title)
                _add(f"Apache-2.0-notice-{kind}", notice, title)
    for name, family, work, versions in (
        ("GPL", "GNU General Public License", "program", ("2", "3")),
        ("AGPL", "GNU Affero General Public License", "program", ("3",)),
        ("LGPL", "GNU Lesser General Public License", "library", ("2.1", "3")),
        ("LGPL", "GNU Library General Public License", "library", ("2",)),
    ):
        notice = TEMPLATES["GPL-3.0"].replace("GNU General Public License", family).replace("program", work)
        later = notice[notice.index(" as published") : notice.index(" This " + work + " is distributed")]
        for version in versions:
            own = f"{name}-{version if '.' in version else version + '.0'}"
            for kind, number in (("", version), ("-dot", own.split("-")[1])):
                if own + kind not in TEMPLATES and (not kind or number != version):
                    text = notice.replace("version 3", f"version {number}")
                    _add(own + kind, text, family, f"version {number} of the License")
            title = f"{family} version {version}"
            only = notice.replace(family + later, f"{title} as published by the Free Software Foundation.")
            _add(f"{own}-only", only, title)
            for kind, title in (
                ("line", f"{family}, version {version}"),
                ("short", f"{family} v{version}"),
                ("number", f"{family} {version}"),
                ("of", f"version {version} of the {family}"),
            ):
                if f"{own}-{kind}" not in TEMPLATES:
                    _add(f"{own}-{kind}", f"This work is licensed under the {title}.", title)
        if f"{name}-any-line" not in TEMPLATES:
            _add(f"{name}-any-line", f"This work is licensed under the {family}.", family)
    for version, scope in (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic")):
        for parts in ("", "SA", "ND", "NC", "NC-SA", "NC-ND"):
            kind = "-".join(part for part in ("BY", parts) if part)
            short = f"CC {kind} {version}"
            names = ["Attribution", *(CC_PARTS[part] for part in parts.split("-") if part)]
            long = f"Creative Commons {'-'.join(names)} {version}"
            for form, text, title in (
                ("short", f"Licensed under {short}.", short),
                ("long", f"This work is licensed under a {long} {scope} License.", long),
            ):
                if text not in TEMPLATES.values():
                    _add(f"CC-{kind}-{version}-{form}", text, title)


_add_siblings()

#: Words too common to tell a template by.
COMMON = frozenset(
    b"a above all an and any are as at be by can do either even following for free from general if "
    b"in include included including is it law list may must no not of on or other out permit person "
    b"persons program provided public purpose shall so that the this to under use version with "
    b"without work you your 0 2 3 4".split()
)

Words = list[bytes]


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence."""
    tops: list[int] = []
    piles: list[int] = []
    before: list[int] = []
    for i, value in enumerate(values):
        pile = bisect_left(tops, value)
        before.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(value)
            piles.append(i)
        else:
            tops[pile], piles[pile] = value, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def _once(own: Words, start: int, end: int) -> dict[bytes, int]:
    places: dict[bytes, int] = {}
    for i in range(start, end):
        places[own[i]] = -1 if own[i] in places else i
    return {word: i for word, i in places.items() if i >= 0}


def align(template: Words, text: Words) -> list[tuple[int, int]]:
    """Pairs of places with equal words, increasing in both."""
    pairs: list[tuple[int, int]] = []
    gaps = [(0, len(template), 0, len(text))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and template[a] == text[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and template[b - 1] == text[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a == b or c == d:
            continue
        own, other = _once(template, a, b), _once(text, c, d)
        both = sorted((i, other[word]) for word, i in own.items() if word in other)
        anchors = [both[k] for k in increasing([place for _, place in both])]
        if not anchors:
            continue
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        pairs += anchors
        for (i, j), (k, m) in zip(edges, edges[1:], strict=False):
            if i + 1 < k and j + 1 < m:
                gaps.append((i + 1, k, j + 1, m))
    return sorted(pairs)


def _places(phrase: Words, own: Words, start: int = 0) -> list[int]:
    """Where a phrase begins in own, from start on."""
    size = len(phrase)
    return [i for i in range(start, len(own) - size + 1) if own[i] == phrase[0] and own[i : i + size] == phrase]


class Scanner:
    def __init__(self, templates: dict[str, str], telling: dict[str, tuple[str, ...]] = TELLING):
        self.templates = {name: words(text.encode()) for name, text in templates.items()}
        #: Of each template, where its telling phrases begin and end.
        self.telling: dict[str, list[tuple[int, int]]] = {}
        #: The word that a template is sought by, as a place in its first phrase.
        self.sought: dict[str, int] = {}
        self.by_word: dict[bytes, list[str]] = {}
        for name, own in self.templates.items():
            phrases, at = [], 0
            for phrase in (words(text.encode()) for text in telling.get(name, ())):
                places = _places(phrase, own, at) if phrase else []
                if not places:  # another template of that name
                    phrases = []
                    break
                at = places[0] + len(phrase)
                phrases.append((places[0], at))
            self.telling[name] = phrases
            if phrases:
                first = own[slice(*phrases[0])]
                rare = [i for i, word in enumerate(first) if word not in COMMON and not word.isdigit()]
                self.sought[name] = rare[0] if rare else 0
                seeds = {first[self.sought[name]]}
            else:
                seeds = set(own) - COMMON or set(own)
            for word in seeds:
                self.by_word.setdefault(word, []).append(name)
        #: Templates with more telling words, for one whose only phrase is part of theirs.
        self.narrower: dict[str, set[str]] = {}
        for name, phrases in self.telling.items():
            if len(phrases) == 1:
                phrase = self.templates[name][slice(*phrases[0])]
                more = {
                    other
                    for other, theirs in self.telling.items()
                    if sum(b - a for a, b in theirs) > len(phrase)
                    and any(_places(phrase, self.templates[other][a:b]) for a, b in theirs)
                }
                if more:
                    self.narrower[name] = more

    def scan(self, text: bytes, least: float) -> list[dict]:
        """Found templates: license, coverage, first and stop (words of the text)."""
        own = words(text)
        by_word = self.by_word
        seeds: dict[str, list[int]] = {}
        for i, word in enumerate(own):
            if word in by_word:
                for name in by_word[word]:
                    seeds.setdefault(name, []).append(i)
        found = []
        for name, places in seeds.items():
            if phrases := self.telling[name]:
                phrase, shift = self.templates[name][slice(*phrases[0])], self.sought[name]
                size = len(phrase)
                places = [i - shift for i in places if i >= shift and own[i - shift : i - shift + size] == phrase]
            if places:
                found += self._in_regions(name, own, places, least)
        found = self._narrowest(found)
        for match in found:
            del match["telling"]
        return sorted(found, key=lambda x: (x["first"], x["license"]))

    def _narrowest(self, found: list[dict]) -> list[dict]:
        """Without the matches whose telling words are part of those of a narrower match."""
        out = []
        covers: dict[str, tuple[list[int], list[int]]] = {}
        for match in found:
            name = match["license"]
            if name in self.narrower:
                if name not in covers:
                    ranges = sorted(m["telling"] for m in found if m["license"] in self.narrower[name])
                    ends = list(accumulate((end for _, end in ranges), max))
                    covers[name] = ([start for start, _ in ranges], ends)
                starts, ends = covers[name]
                at = bisect_right(starts, match["telling"][0])
                if at and ends[at - 1] >= match["telling"][1]:
                    continue
            out.append(match)
        return out

    def _aligned(self, name: str, region: Words) -> tuple[list[tuple[int, int]], tuple[int, int]]:
        """The alignment with most pairs that holds each telling phrase whole, and where these
        begin and end in the region."""
        template, phrases = self.templates[name], self.telling[name]
        if not phrases:
            return align(template, region), (0, 0)
        places = [_places(template[a:b], region) for a, b in phrases]
        best: list[tuple[int, int]] = []
        span = (0, 0)
        for first in places[0]:
            chosen, at = [first], first + phrases[0][1] - phrases[0][0]
            for (a, b), own in zip(phrases[1:], places[1:], strict=True):
                k = bisect_left(own, at)
                if k == len(own):
                    break
                chosen.append(own[k])
                at = own[k] + b - a
            if len(chosen) < len(phrases):
                break
            pairs, i, j = [], 0, 0
            for (a, b), c in zip([*phrases, (len(template),) * 2], [*chosen, len(region)], strict=True):
                pairs += [(i + x, j + y) for x, y in align(template[i:a], region[j:c])]
                pairs += [(a + k, c + k) for k in range(b - a)]
                i, j = b, c + b - a
            if not best or (len(pairs), best[-1][1] - best[0][1]) > (len(best), pairs[-1][1] - pairs[0][1]):
                best, span = pairs, (first, at)
        return best, span

    def _in_regions(self, name: str, own: Words, places: list[int], least: float) -> list[dict]:
        template = self.templates[name]
        size = len(template)
        half = max(1, size // 2)
        starts = sorted({k * half for place in places for k in range((place - 2 * size) // half, place // half + 1)})
        spots = [s for s in starts if s > -2 * size]
        best: list[dict] = []
        for start in spots:
            low = max(0, start)
            region = own[low : start + 2 * size]
            if not region:
                continue
            pairs, told = self._aligned(name, region)
            if not pairs or len(pairs) < least * size:
                continue
            first, stop = low + pairs[0][1], low + pairs[-1][1] + 1
            match = {
                "license": name,
                "coverage": len(pairs) / size,
                "first": first,
                "stop": stop,
                "telling": (low + told[0], low + told[1]),
            }
            if best and first < best[-1]["stop"]:
                if (match["coverage"], first - stop) > (best[-1]["coverage"], best[-1]["first"] - best[-1]["stop"]):
                    best[-1] = match
            else:
                best.append(match)
        return best


RESULT = "array<struct<license:string,coverage:double,first:int,stop:int>>"
_RESULT = pa.list_(
    pa.struct(
        [("license", pa.string()), ("coverage", pa.float64()), ("first", pa.int32()), ("stop", pa.int32())]
    )
)


def licenses(
    docs: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    out: str = "licenses",
    least_coverage: float = LEAST_COVERAGE,
    telling: dict[str, tuple[str, ...]] = TELLING,
) -> DataFrame:
    """docs with the templates found in each whole text: license, coverage (0 to 1), and the
    words from first to before stop. Matches of one template do not overlap. A template with telling
    phrases is found only where these are, whole and in order; one whose only phrase is part of
    another's gives way to that one where both are found.

    Null and wordless texts have none. Templates are a parameter of the caller's size and are
    broadcast; one without words is never found. A text of any length is scanned whole, in memory of
    its task. Rows are independent of each other, so repeated ones are treated alike. A column named
    as `out` is replaced; all others pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast((dict(templates), dict(telling)))

    def scan(texts: pa.Array) -> pa.Array:
        scanner = built("licenses", shared.value, lambda own: Scanner(*own))
        return pa.array([scanner.scan(x.as_py() or b"", least_coverage) for x in texts], _RESULT)

    return docs.withColumn(out, F.arrow_udf(scan, RESULT)(F.col("text").cast("binary")))
