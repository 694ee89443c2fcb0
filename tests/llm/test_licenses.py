"""License scans against brute force: every place of a phrase, templates as plain regular expressions."""

import re
from collections import Counter

import duckdb
import pytest

from martlake.llm import licenses
from martlake.llm.queries import ORACLE_SQL

MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
       "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
       "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
       "is furnished to do so, subject to the following conditions:\n\n The above copyright notice and this permission notice "
       "{} shall be included in all copies or substantial portions of the Software.")


def rows():
    long = "filler words " * 9000
    return [(0, "Released under the MIT License. Under the mit license"), (1, None), (2, ""), (3, "under the mit"),
            (4, "Licensed under the Apache License, Version 2.0, and CC BY-NC 4.0."), (5, MIT.format("")),
            (6, MIT.format("(including the next paragraph)")), (7, MIT.format("(including every paragraph)")), (8, MIT.format("")[12:]),
            (9, long + "apache license version 2 " + long + "cc by nc"), (10, "cc by cc by nc under the mit license version 2"),
            (11, "Neither the name of the Foo Bar nor the names of its contributors may be used to endorse or promote products "
                 "derived from this software without specific prior written permission"),
            (12, "Neither the name of " + "x " * 13 + "nor the names of its contributors may be used to endorse or promote products "
                 "derived from this software without specific prior written permission"),
            (13, "This work is licensed under the GNU General Public License, version 3."), (14, "under the gnu general public"),
            (15, "ünder the mit license"), (15, "ünder the mit license"), (15, "under the mit license"), (None, "CC-BY-NC"),
            (16, "!!! \n"), (17, "licensed under apache license 2"), (18, "this odd tool is released under the terms of the mit license")]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def expected(text):
    w = words(text)
    joined = " " + " ".join(w) + " "
    places = [(i, label) for label, p in licenses.PHRASES.items() for i in range(len(w)) if w[i: i + len(p.split())] == p.split()]
    all_ = {**licenses.PHRASES, **licenses.TEMPLATES}
    found = {label for label, m in all_.items() if re.search(licenses.pattern(m), joined)}
    starts = [i for i, _ in places]
    longest = max((licenses.mandatory(licenses.parse(all_[x])) for x in found), default=0)
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})),
            ",".join(sorted(found)), licenses.strength(longest) if longest else 0.0)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows()], "doc_id long, text string, spans string, n_words int").repartition(3)


def test_licenses(spark, docs):
    got = Counter(tuple(r) for r in licenses.license_digest(docs).collect())
    assert got == Counter((i, *expected(t)) for i, t in rows())
    by = {r[0]: r for r in got}
    assert by[0][2] == 2 and by[10][2] == 2 and by[9][5] == "apache-2,cc-by-nc"
    assert "mit-text" in by[5][6] and "mit-text" in by[6][6] and "mit-text" not in by[7][6] and "mit-text" not in by[8][6]
    assert "bsd-no-endorsement" in by[11][6] and by[12][6] == "" and by[13][6] == "gpl-named"
    assert licenses.license_digest(docs.limit(0)).count() == 0


def test_spans(spark, docs):
    spans = {r.doc_id: r.spans for r in licenses.scan(docs, licenses.TEMPLATES).where("doc_id in (13, 18)").collect()}
    assert [(s.label, s["first"], s["last"]) for s in spans[13]] == [("gpl-named", 4, 11)]
    assert [(s.label, s["first"], s["last"]) for s in spans[18]] == [("mit-grant", 0, 11), ("mit-grant", 4, 11)]


def test_sql_gives_the_same(spark, docs):
    con, small = duckdb.connect(), docs.where("length(text) < 1000 or text is null")  # DuckDB copies the words at every place
    con.register("documents", small.select("doc_id", "text").toArrow())
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    sql = con.sql(ORACLE_SQL["op11_template_licenses"]).select(*names).fetchall()
    assert Counter(sql) == Counter(tuple(r) for r in licenses.license_digest(small).collect())


@pytest.mark.parametrize("bad", ["<<beginOptional>>a", "a<<endOptional>>", "<<var;words=0..3>> a", "<<beginOptional>>a<<endOptional>>", ""])
def test_templates_need_mandatory_wording(bad):
    with pytest.raises(ValueError):
        licenses.Automaton({"x": bad})


def test_regions_at_ends_and_in_each_other():
    scanner = licenses.Scanner({"x": "a <<beginOptional>>b <<beginOptional>>c<<endOptional>> d<<endOptional>> <<var;words=1..2>> e"})
    import numpy as np
    for text, ok in [("a q e", 1), ("a e", 0), ("a q r e", 1), ("a q r s e", 0), ("a b c d q e", 1), ("a b d q e", 1), ("a b c q e", 0), ("a b c e", 1)]:
        raw = text.encode()
        _, found = scanner.spans(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        assert bool(found[0]) == bool(ok), text
