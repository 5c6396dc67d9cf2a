"""Decontamination and licences."""

import re

import pytest

import oracle
from conftest import DATA
from llm_fixtures import awkward, no_docs, texts  # noqa: F401
from logmetrics.llm import decontamination, licences
from logmetrics.llm.licence_texts import RULES
from logmetrics.llm.queries import ORACLES, op4_warc_revisits, op6_licence_scan, op7_jaccard_join, op9_decontamination

ITEM = "Alpha beta gamma, delta epsilon zeta eta theta; iota KAPPA lambda mu nu"


@pytest.fixture
def items(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), "item_id string, text string")

    return make


def found(docs, items, **options):
    return {r.doc_id: r for r in decontamination.find_passages(docs, items, **options).collect()}


def test_windows_and_offsets(texts, items):
    inside = "Before it: alpha-beta gamma delta epsilon zeta eta theta iota kappa and after"
    nine = "beta gamma delta epsilon zeta eta theta iota kappa"
    docs = texts(inside, nine, nine + " lambda", "tiny thing here", "tiny  THING!", None, "")
    got = found(docs, items(("1", ITEM), ("2", "Tiny thing"), ("3", None), ("4", "!!"), ("5", ITEM)))
    assert got[0].n_hit == 10 and got[0].items == ["1", "5"]
    span = got[0].spans[0]
    assert inside[span.start : span.end] == "alpha-beta gamma delta epsilon zeta eta theta iota kappa"
    assert got[1].n_hit == 0 and got[2].n_hit == 10
    assert got[3].items == ["2"] and got[3].n_hit == 2 and got[4].n_hit == 2
    assert got[5].n_words == 0 and got[5].items == [] and got[6].n_words == 0


def test_offsets_count_characters(texts, items):
    doc = "日本 ß é alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    span = found(texts(doc), items(("1", ITEM)))[0].spans[0]
    assert doc[span.start : span.end] == "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"


@pytest.mark.parametrize("options", [{"block_bytes": 100}, {"block_bytes": 100, "pass_bytes": 900}, {"window": 9}])
def test_blocks_and_passes_find_the_same(spark, options):
    docs, items = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/benchmark.parquet")
    window = options.get("window", 10)
    got = decontamination.find_passages(docs, items, **options)
    want = {r.doc_id: brute(r.text, items.collect(), window) for r in docs.collect()}
    assert {r.doc_id: (r.n_words, r.n_hit, r.items) for r in got.collect()} == want
    assert any(w[1] for w in want.values())


def brute(text, items, window):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, names = split(text), set(), set()
    for i in items:
        own = split(i.text)
        k = min(window, len(own))
        windows = {tuple(own[p : p + k]) for p in range(len(own) - k + 1)} if k else set()
        for p in range(len(words) - k + 1):
            if k and tuple(words[p : p + k]) in windows:
                hit.update(range(p, p + k))
                names.add(str(i.item_id))
    return len(words), len(hit), sorted(names)


def test_repeated_words_do_not_multiply(texts, items):
    got = found(texts("the " * 3000), items(("1", "the " * 300)))
    assert got[0].n_hit == 3000


def test_awkward_rows(awkward, no_docs, items, texts):
    assert decontamination.find_passages(awkward, items()).count() == awkward.count()
    assert decontamination.find_passages(no_docs, items(("1", ITEM))).collect() == []
    assert decontamination.find_passages(texts("a"), items(("1", ITEM))).columns == ["doc_id", "n_words", "n_hit", "spans", "items"]


@pytest.mark.parametrize("query", [op4_warc_revisits, op7_jaccard_join, op9_decontamination])
def test_query_matches_sql(spark, query):
    want = oracle.connect(DATA).sql(ORACLES[query.__name__]).df()
    assert oracle.differences(query(spark, DATA).toPandas(), want) == ""


def test_every_rule_finds_its_text():
    rules = licences.default_rules()
    for licence, text in RULES:
        wrapped = "A title\nCopyright (c) 2020 A. Writer\n\n" + text.replace(" and ", "\nand ", 3).upper() + "\n\nMore text."
        found, _ = rules.match(wrapped)
        assert [f[0] for f in found] == [licence], text
        assert wrapped[found[0][1] : found[0][2]].split()[0] == text.upper().split()[0]


def test_order_of_sentences_counts():
    rules = licences.Rules([("both", "First one. Second one."), ("first", "First one.")])
    names = lambda t: [m[0] for m in rules.match(t)[0]]
    assert names("First one. Second one.") == ["both"]
    assert names("Second one. First one.") == ["first"]
    assert names("First one. Something else. Second one.") == ["both"]
    assert names("first ONE! first one") == ["first", "first"]
    assert names("Not first one. ") == []


def test_licence_rows(awkward, no_docs, texts):
    rows = licences.scan(awkward).collect()
    assert len(rows) == awkward.count() and all(r.licences == [] for r in rows)
    assert licences.scan(no_docs).collect() == []
    assert licences.scan(texts("Released under the MIT License.")).first().licences == ["MIT"]


def test_licence_query_against_plain_search(spark):
    lines = {
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
        "MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    }
    docs = spark.read.parquet(f"{DATA.replace('0.001', '0.01')}/documents.parquet").collect()
    want = {d.doc_id: ",".join(sorted(k for k, line in lines.items() if line in d.text)) for d in docs}
    got = {r.doc_id: r.licences for r in op6_licence_scan(spark, DATA.replace("0.001", "0.01")).collect()}
    assert got == want and any(want.values())


def licences_of(text):
    return [m[0] for m in licences.default_rules().match(text)[0]]


BSD3, MIT = (next(text for name, text in RULES if name == licence) for licence in ("BSD-3-Clause", "MIT"))


@pytest.mark.parametrize("holder", ["the University nor the names of its contributors", "Foo, Inc. nor the names of\nits contributors", "Google LLC"])
def test_bsd_clause_that_names_an_organisation(holder):
    text = BSD3.replace("the copyright holder nor the names of its contributors", holder).replace("COPYRIGHT HOLDERS AND CONTRIBUTORS", "REGENTS AND CONTRIBUTORS")
    assert licences_of(text) == ["BSD-3-Clause"]


def test_unknown_text_between_sentences_counts():
    extra = "You may not use this software in any machine that is used to sort the mail of other people. "
    assert licences_of(BSD3.replace("Neither the name", "Nobody else by the name")) == ["BSD-2-Clause variant"]
    assert licences_of(MIT.replace("The above", extra + "The above")) == ["MIT variant"]
    assert licences_of(MIT.replace("The above", extra * 20 + "The above")) == []


@pytest.mark.parametrize("licence", ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"])
def test_full_texts(licence):
    from logmetrics.llm.licence_full_texts import FULL_TEXTS

    parts = dict(FULL_TEXTS)[licence]
    whole = "\n\n".join(parts).replace(" the ", "\n   the ")
    assert licences_of(whole) == [licence]
    assert set(licences_of("\n".join(parts[:-1]))) == set(licences_of("\n".join(parts[-1:]))) == {licence}
    assert set(licences_of(whole.replace("conditions", "rules", 1))) <= {licence, f"{licence} variant"}


@pytest.mark.parametrize("text, want", [
    ("This file is licensed under the MIT License.", ["MIT"]), ("All code in this\nfolder is released under the terms of the GNU GPL version 2.", ["GPL-2.0"]),
    ("Licensed under either of Apache License, Version 2.0 or MIT license at your option.", ["Apache-2.0", "MIT"]),
    ("The library is distributed under the LGPL v2.1 or later.", ["LGPL-2.1-or-later"]), ("This work is not licensed under the MIT License.", []),
    ("// SPDX-License-Identifier: (MIT OR Apache-2.0)\nint x;", ["MIT", "Apache-2.0"]), ("/* SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note */", ["GPL-2.0"]),
    ("SPDX-License-Identifier: BSL-1.0", ["BSL-1.0"]), ("# Title\nLicense: MIT\n", ["MIT"]), ("The MIT License is a short text.", []),
    ("GNU AFFERO GENERAL PUBLIC LICENSE\n   Version 3, 19 November 2007\n", ["AGPL-3.0"]),
])
def test_notices_in_other_words(text, want):
    assert licences_of(text) == want


@pytest.mark.parametrize("options", [{}, {"block_bytes": 50, "pass_bytes": 60}])
def test_items_without_id_hit(texts, items, options):
    docs = texts(ITEM, ITEM + " Tiny thing", "nothing of it")
    got = found(docs, items((None, ITEM), ("2", "Tiny thing")), **options)
    assert [(got[i].n_hit, got[i].items) for i in range(3)] == [(13, []), (15, ["2"]), (0, [])]
