from __future__ import annotations

import random
from itertools import combinations

import pytest

from furrow.llm import license_scan as scan


def test_longest_rise_is_longest():
    random.seed(1)
    for _ in range(200):
        second = random.sample(range(8), 8)
        pairs = list(enumerate(second))
        got = scan.longest_rise(pairs)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(got, got[1:])) and set(got) <= set(pairs)
        longest = max(n for n in range(9) for c in combinations(second, n) if list(c) == sorted(c))
        assert len(got) == longest


def test_alignment_rises_and_matches():
    random.seed(2)
    for _ in range(200):
        text, template = ([random.choice("abcdefghij") for _ in range(random.randint(0, 20))] for _ in "xy")
        pairs = scan.align(text, template)
        assert all(text[i] == template[j] for i, j in pairs)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:]))
    assert len(scan.align(list("abcab"), list("abcab"))) == 5


def found(df, **options):
    rows = scan.scan(df, **options).collect()
    return sorted((r["doc_id"], r["license"], r["start"], r["end"]) for r in rows)


def test_every_template_is_found_in_prose_and_in_lines(docs):
    prose = "the of and to this software is a copy in any under work " * 8
    rows, want = [], []
    for i, (name, text) in enumerate(scan.TEMPLATES.items()):
        shown = text.upper().replace(" ", "\n * ") if i % 2 else text
        rows.append((i, f"{prose}\n# {shown}!\n{prose}"))
        want.append((i, name))
    got = found(docs(rows))
    assert set(want) <= {(i, name) for i, name, _, _ in got}
    for i, name, start, end in got:
        assert scan.WORD.findall(rows[i][1][start:end].lower())


def test_a_licence_that_occurs_twice_and_changed_words(docs):
    notice, mit = scan.TEMPLATES["Apache-2.0-notice"], scan.TEMPLATES["MIT"]
    changed = mit.replace("free of charge", "gratis").replace("Software is furnished", "work is furnished")
    rows = [(1, f"{notice}.\n{notice}."), (2, f"x {changed} y"), (3, " ".join(mit.split()[:30])), (4, mit + " " + notice + " " + mit)]
    got = [(i, name) for i, name, _, _ in found(docs(rows))]
    assert got.count((1, "Apache-2.0-notice")) == 2 and (2, "MIT") in got
    assert not any(i == 3 for i, _ in got)
    assert got.count((4, "MIT")) == 2 and got.count((4, "Apache-2.0-notice")) == 1


def test_what_is_alike_is_not_the_same(docs):
    rows = [(1, "Released under the Apache License"), (2, "Licensed under CC BY-SA 4.0"), (3, "all rights of others")]
    assert found(docs(rows)) == []


def test_nulls_empty_repeated_long_and_clashing(docs, clashing):
    text = "é" * 9 + " " + scan.TEMPLATES["MIT-notice"]
    rows = [(1, None), (2, ""), (3, text), (3, text), (None, text), (5, "word " * 100_000 + text)]
    got = scan.scan(clashing(rows)).collect()
    assert sorted((r["doc_id"] or 0, r["start"]) for r in got) == [(0, 10), (3, 10), (3, 10), (5, 500_010)]
    assert scan.scan(docs([])).count() == 0


@pytest.mark.parametrize("line, name", [
    ("Released under the MIT License.", "MIT-notice"),
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0-notice"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0-notice"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0-notice"),
    ("All rights reserved.", "all-rights-reserved"),
])
def test_every_licence_line_of_the_tables_is_found(spark, line, name):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {r["doc_id"] for r in table.where(table["text"].contains(line)).collect()}
    got = {r["doc_id"] for r in scan.scan(table).where(f"license = '{name}'").collect()}
    assert want and want <= got


def held(words: list[str], template: list[str]) -> int:
    """Length of the longest common subsequence, by the table."""
    row = [0] * (len(template) + 1)
    for word in words:
        before = row[:]
        for k, other in enumerate(template):
            row[k + 1] = before[k] + 1 if word == other else max(before[k + 1], row[k])
    return row[-1]


def most(words: list[str], template: scan.Template) -> int:
    """Greatest number of disjoint spans of at most twice the template's length that hold enough of it in order."""
    best = [0]
    for end in range(1, len(words) + 1):
        starts = range(end - template.least, max(-1, end - 2 * len(template.words) - 1), -1)
        start = next((a for a in starts if held(words[a:end], template.words) >= template.least), None)
        best.append(max(best[-1], 0 if start is None else best[start] + 1))
    return best[-1]


def assert_whole(words: list[str], template: scan.Template) -> None:
    got = scan.matches(words, template)
    assert len(got) == most(words, template), (words, got)
    assert all(a[1] <= b[0] for a, b in zip(got, got[1:]))
    for first, stop, n in got:
        assert stop - first <= 2 * len(template.words)
        assert template.least <= n <= held(words[first:stop], template.words)


def test_copies_after_prose_are_all_found(docs):
    text = "the foo Released under the MIT License. Released under the MIT License."
    assert [text[a:b] for _, _, a, b in found(docs([(1, text)]))] == ["Released under the MIT License"] * 2


@pytest.mark.parametrize("name", ["MIT-notice", "Apache-2.0-notice", "all-rights-reserved", "Unlicense"])
def test_copies_stretched_at_every_offset_as_by_brute_force(name):
    (template,) = scan.prepare({name: scan.TEMPLATES[name]}, scan.LEAST_COVERAGE)
    random.seed(3)
    for offset in range(4 * len(template.words)):
        words = [random.choice(["foo", random.choice(template.words)]) for _ in range(offset)]
        for _ in range(random.randint(1, 4)):
            copy = list(template.words)
            for _ in range(random.randint(0, len(copy))):
                copy.insert(random.randint(0, len(copy)), random.choice(["foo", "bar", random.choice(template.words)]))
            words += copy + ["foo"] * random.randint(0, 3)
        assert_whole(words, template)


def test_copies_with_missing_words_as_by_brute_force():
    random.seed(4)
    for size, coverage in ((4, 0.5), (6, 0.6), (10, 0.8), (12, 0.9)):
        for _ in range(150):
            words = [random.choice("abcdefgh") for _ in range(size)]
            (template,) = scan.prepare({"x": " ".join(words)}, coverage)
            text = [random.choice("abcdefghz") for _ in range(random.randint(0, 15))]
            for _ in range(random.randint(0, 4)):
                text += [w for w in words if random.random() < 0.93] + [random.choice("abcz") for _ in range(random.randint(0, 3))]
            assert_whole(text, template)
