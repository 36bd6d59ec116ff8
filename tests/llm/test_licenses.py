import re

import pytest
from conftest import SF_SMALL

from llm.conftest import with_clashes
from tessera.llm import licenses, queries


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingles(text):
    own = words(text)
    return [tuple(own[i:i + 5]) for i in range(len(own) - 4)]


def brute(rows, templates):
    """Best share of a template's shingles near any place of a text that has one of them."""
    out = {}
    for i, text in rows:
        own = shingles(text)
        for name, template in templates.items():
            want = shingles(template)
            best = 0.0
            for at in range(0, len(own), licenses.STRIDE):
                low = max(0, at - len(want) + 1)
                around = set(own[low:low + 2 * len(want) + licenses.STRIDE])
                if set(own[at:at + licenses.STRIDE]) & set(want):
                    best = max(best, len(around & set(want)) / len(set(want)))
            if best >= licenses.MIN_CONTAINMENT:
                out[i, name] = best
    return out


def found(frame):
    return {(r.doc_id, r.license): r.containment for r in frame.collect()}


def test_query_equals_brute_force(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(rows, licenses.TEMPLATES)
    assert want and found(queries.op7_license_scans(spark, sf)) == want


def test_edited_long_and_repeated_notices(spark):
    grant = licenses.TEMPLATES["mit-grant"]
    edited = grant.replace("any person", "any human person")
    rows = [(1, "start " * 37 + grant + " end" * 50), (2, "x " * 11 + edited), (3, grant[:len(grant) // 2]),
            (4, None), (5, "a b"), (6, " ".join([licenses.TEMPLATES["mit-notice"]] * 40)),
            (7, "W " * 30_000 + licenses.TEMPLATES["gpl-3.0-notice"]), (None, licenses.TEMPLATES["mit-notice"])]
    frame = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    got = found(licenses.scan(frame))
    assert got == brute(rows, licenses.TEMPLATES)
    assert {(1, "mit-grant"), (6, "mit-notice"), (7, "gpl-3.0-notice"), (None, "mit-notice")} <= set(got)


def test_no_rows_and_short_templates(spark, no_docs):
    assert licenses.scan(no_docs).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(no_docs, templates={"x": "too short"})


def test_whole_licences_headers_and_wordings(spark):
    bodies = {n: t for n, t in licenses.LICENSES.items() if n.endswith("-text")}
    rows = [(1, "x " * 30 + "Redistribution and use in source and binary forms, with or without modification, are "
                "permitted provided that the following conditions are met:"),
            (2, "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
            (3, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
                "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
            (4, "Licensed under the MIT License"), (5, "y " * 2_000 + "an ordinary text about nothing at all"),
            (6, "\n".join("// " + line for line in bodies["gpl-3.0-text"].split("\n")) + " z" * 500),
            (7, bodies["apache-2.0-text"][:len(bodies["apache-2.0-text"]) // 2])]
    rows += [(100 + i, f"Copyright {i} someone\n{t}") for i, t in enumerate(bodies.values())]
    got = found(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {(1, "bsd-conditions"), (2, "gpl-3.0-or-later"), (3, "mpl-2.0-header"), (4, "mit-licensed"),
            (6, "gpl-3.0-text")} <= set(got)
    assert {(100 + i, n): 1.0 for i, n in enumerate(bodies)}.items() <= got.items()
    assert not {k for k in got if k[0] == 5 or k[0] == 7 and k[1] == "apache-2.0-text"}
    assert not {k for k in got if k[0] == 2 and k[1] != "gpl-3.0-or-later"}      # not another version


def test_containment_of_repeats_equals_brute_force(spark):
    import random
    rng = random.Random(3)
    templates = {"a": "p q p q p q p q p q r s", "b": " ".join(rng.choice("pqrs") for _ in range(40)),
                 "c": "p q r s p"}
    rows = [(i, " ".join(rng.choice("pqrs") if rng.random() < 0.97 else "t" for _ in range(n)))
            for i, n in enumerate([5, 6, 9, 40, 80, 200, 400])] + [(50, "t t " + " ".join([templates["a"]] * 5)),
                                                                   (51, templates["b"] * 2)]
    frame = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found(licenses.scan(frame, templates=templates)) == brute(rows, templates)
