import random
import re
from itertools import combinations

from tests.llm.conftest import clashing, prose, table
from tillroll.llm import licenses

OWN = licenses.TEMPLATES


def names(text, **options):
    return [m["license"] for m in licenses.Scanner(OWN).scan(text.encode(), options.get("least", 0.8))]


def test_templates_are_found_in_prose():
    for name, template in OWN.items():
        text = f"{prose(1, 50)} {template} {prose(2, 50)}"
        assert name in names(text)
        match = next(m for m in licenses.Scanner(OWN).scan(text.encode(), 0.8) if m["license"] == name)
        assert match["coverage"] == 1.0
        words = licenses.words(text.encode())[match["first"] : match["stop"]]
        assert words == licenses.words(template.encode())


def test_edits_and_line_breaks_lower_the_coverage():
    words = OWN["MIT"].split()
    changed = [w if i % 12 else f"x{i}" for i, w in enumerate(words)]
    text = "\n * ".join(" ".join(changed[i : i + 9]) for i in range(0, len(changed), 9))
    (match,) = [m for m in licenses.Scanner(OWN).scan(text.encode(), 0.8) if m["license"] == "MIT"]
    assert 0.85 < match["coverage"] < 1
    assert "MIT" not in names(" ".join(words[:60]))


def test_each_of_many_copies_is_found():
    for n in (2, 3, 5):
        assert names(" ".join(["All rights reserved."] * n)).count("Reserved") == n
        assert names(f" {prose(n, 9)} ".join([OWN["BSD"]] * n)).count("BSD") == n
        assert names(" ".join([OWN["BSD"]] * n)).count("BSD") == n


def test_prose_has_none():
    assert all(names(prose(k, 300)) == [] for k in range(10))
    assert names("license " * 3000) == [] and names("") == []


def longest(values):
    for size in range(len(values), 0, -1):
        for own in combinations(values, size):
            if all(a < b for a, b in zip(own, own[1:], strict=False)):
                return size
    return 0


def test_increasing_by_brute_force():
    own = random.Random(1)
    for _ in range(200):
        values = own.sample(range(30), own.randint(0, 9))
        chosen = [values[i] for i in licenses.increasing(values)]
        assert chosen == sorted(chosen) and len(chosen) == longest(values)


def test_alignment_is_increasing_and_equal():
    own = random.Random(2)
    for _ in range(200):
        a, b = (own.choices([b"a", b"b", b"c", b"d", b"e"], k=own.randint(0, 12)) for _ in range(2))
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x < y and z < w for (x, z), (y, w) in zip(pairs, pairs[1:], strict=False))


def test_over_a_table(spark, odd_texts):
    texts = [*odd_texts, f"{prose(1, 9)}\n{OWN['GPL-3.0-line']}"]
    result = licenses.licenses(clashing(table(spark, texts))).orderBy("doc_id").collect()
    assert [[m.license for m in r.licenses] for r in result] == [[]] * len(odd_texts) + [["GPL-3.0-line"]]
    assert licenses.licenses(table(spark, [])).collect() == []


def family(name):
    """A license without the form in which its notice is written."""
    kinds = "line|short|long|number|of|only|dot|v|named|expat|x11|notice"
    while re.search(rf"-({kinds})$", name):
        name = re.sub(rf"-({kinds})$", "", name)
    return name


def test_each_notice_is_found_under_its_own_name_only():
    scanner = licenses.Scanner(OWN)
    for name, notice in OWN.items():
        text = f"{prose(3, 20)} {notice} {prose(4, 20)}"
        found = {m["license"] for m in scanner.scan(text.encode(), 0.8)}
        assert name in found and {family(n) for n in found} == {family(name)}, (name, found)


def test_siblings_are_not_taken_for_each_other():
    work = "This work is licensed under"
    for text, found in (
        ("Released under the BSD License.", ["BSD-line"]),
        (f"{work} the GNU General Public License, version 2.", ["GPL-2.0-line"]),
        (f"{work} the GNU Lesser General Public License, version 3.", ["LGPL-3.0-line"]),
        (f"{work} the GNU General Public License, version 9.", ["GPL-any-line"]),
        ("Licensed under CC BY 4.0.", ["CC-BY-4.0-short"]),
        ("Licensed under CC BY-NC-SA 4.0.", ["CC-BY-NC-SA-4.0-short"]),
        (f"{work} a Creative Commons Attribution-NonCommercial 4.0 International License.", ["CC-BY-NC-4.0-long"]),
        (f"{work} a Creative Commons Attribution 3.0 Unported License.", ["CC-BY-3.0-long"]),
        ("Licensed under the Apache License, Version 1.1.", ["Apache-1.1-line"]),
        ("Released under the Foo License.", []),
        ("Released under the MIT and not the BSD License.", ["BSD-line"]),
    ):
        assert names(text) == found, text


def test_telling_words_do_not_hide_edited_notices():
    assert names("Licensed under the terms of the MIT License.") == ["MIT-line"]
    assert names("The MIT License is short. Released under the MIT License.") == ["MIT-line"]
    assert names("This work is licensed under GNU General Public License v3.0") == ["GPL-3.0-short"]
    lesser = OWN["GPL-3.0"].replace("General", "Lesser General")
    assert names(lesser) == ["LGPL-3.0"]
    assert names(" ".join([OWN["GPL-3.0"], OWN["GPL-2.0"]])) == ["GPL-3.0", "GPL-2.0"]
    assert names("gnu general public license " * 3000) == []
