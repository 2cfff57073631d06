import random

import pytest

from tabula.llm import licenses as L


def scan(text, **options):
    return [(m.license, m.start, m.end, round(m.coverage, 3)) for m in L.Scanner(L.TEMPLATES, **options).scan(text)]


def test_every_template_is_found_whole():
    for name, texts in L.TEMPLATES.items():
        for text in texts:
            padded = "Some words before. " + text + " And some after."
            found = [m for m in L.Scanner(L.TEMPLATES).scan(padded) if m.license == name]
            assert found and max(m.coverage for m in found) == 1.0, name
            best = max(found, key=lambda m: m.words)
            assert padded[best.start:best.end].rstrip(".:") in text + " "


def test_copies_each_have_a_span():
    line = "Released under the MIT License."
    text = f"{line}\n{line}\nwords between {line}"
    assert [(a, b) for name, a, b, _ in scan(text) if name == "MIT"] == [
        (0, 30), (32, 62), (len(text) - len(line), len(text) - 1)]


def test_changed_words_lower_the_coverage():
    text = L.TEMPLATES["MIT"][1].split()
    rng = random.Random(1)
    for k in rng.sample(range(10, len(text)), 6):
        text[k] = "changed"
    del text[30:33]
    found = scan("é " * 10 + " ".join(text))
    assert [f[0] for f in found] == ["MIT"] and 0.8 <= found[0][3] < 0.97


def test_siblings_are_told_apart():
    gpl = ("Foo is free software; you can redistribute it and/or modify it under the terms of the GNU {} Public "
           "License as published by the Free Software Foundation; either version {} of the License, or (at your "
           "option) any later version.")
    for name, version, want in (("General", "2", "GPL-2.0"), ("General", "3", "GPL-3.0"),
                                ("Lesser General", "2.1", "LGPL-2.1"), ("Lesser General", "3", "LGPL-3.0"),
                                ("Affero General", "3", "AGPL-3.0"), ("Library General", "2", "LGPL-2.0")):
        assert [f[0] for f in scan(gpl.format(name, version))] == [want]
    assert scan(gpl.format("General", "7")) == []
    head, third, end = L.BSD_HEAD, L.BSD_THIRD, L.BSD_DISCLAIMER
    for text, want in ((head, "BSD-2-Clause"), (head + end, "BSD-2-Clause"), (head + third, "BSD-3-Clause"),
                       (head + third + end, "BSD-3-Clause"), (head + L.BSD_ADVERTISING + third + end, "BSD-4-Clause")):
        assert [f[0] for f in scan("Copyright X. " + text)] == [want]
    assert [f[0] for f in scan("Licensed under CC BY-NC-SA 4.0.")] == ["CC-BY-NC-SA-4.0"]
    assert scan("Licensed under CC BY-SA 3.0.") == []


def test_other_text_has_no_match():
    assert scan("") == [] and scan("the license") == []
    assert scan("Licensed under the table, version two of the story, and released under the bridge.") == []


def test_long_texts_are_scanned_part_by_part(monkeypatch):
    rng = random.Random(2)
    filler = " ".join("".join(rng.choice("abcde") for _ in range(5)) for _ in range(3000))
    text = filler + " " + L.TEMPLATES["GPL-3.0"][0] + " " + filler + " " + L.TEMPLATES["Apache-2.0"][1]
    whole = scan(text)
    monkeypatch.setattr(L, "PART", 4000)
    monkeypatch.setattr(L, "OVERLAP", 2000)
    assert scan(text) == whole and [w[0] for w in whole] == ["GPL-3.0", "Apache-2.0"]


def test_winnowing_selects_one_of_every_window():
    words = [f"w{k}" for k in range(50)]
    places = {p for p, _ in L.winnowed(words)}
    runs = len(words) - L.GRAM + 1
    assert all(places & set(range(k, k + L.WINNOW)) for k in range(runs - L.WINNOW + 1))


def brute_extension(template, words, i=0, j=0, n=0, score=0.0):
    best = (score, n)
    if i < len(template) and j < len(words):
        same = template[i] == words[j]
        best = max(best, brute_extension(template, words, i + 1, j + 1, n + same, score + (1 if same else -L.GAP)))
    if i < len(template):
        best = max(best, brute_extension(template, words, i + 1, j, n, score - L.GAP))
    if j < len(words):
        best = max(best, brute_extension(template, words, i, j + 1, n, score - L.GAP))
    return best


@pytest.mark.parametrize("seed", range(20))
def test_banded_extension_equals_full_alignment(seed):
    rng = random.Random(seed)
    template = [rng.choice("abc") for _ in range(6)]
    words = [rng.choice("abc") for _ in range(6)]
    score, n = brute_extension(template, words)
    found = L.extension(template, words)
    assert found == sorted(set(found)) and len(found) == n or score < len(found) <= 6


def test_edge_cases(edge_docs, no_docs, spark):
    assert L.scanned(edge_docs).collect() == [] and L.scanned(no_docs).collect() == []
    rows = [(1, "x Released under the MIT License."), (1, "x Released under the MIT License."),
            (None, "Licensed under CC BY-NC 4.0.")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.license, r.start) for r in L.scanned(docs).collect()), key=repr)
    assert got == [(1, "MIT", 2), (1, "MIT", 2), (None, "CC-BY-NC-4.0", 0)]


def test_equals_plain_search_on_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = {(r.doc_id, r.license) for r in L.scanned(docs).collect()}
    lines = {"GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
             "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0", "MIT": "Released under the MIT License",
             "Apache-2.0": "Licensed under the Apache License, Version 2.0"}
    want = {(r.doc_id, name) for r in docs.collect() for name, line in lines.items() if line in r.text}
    assert want and want <= got and len(got - want) <= 0.02 * len(want)
