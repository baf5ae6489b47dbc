"""Licence scans: variants of a text share a digest; the table against SQL."""

import duckdb

from ledgerlake.llm import licenses
from ledgerlake.llm.common import table
from tests.conftest import plan_of

SCHEMA = "doc_id long, text string, license string, row int"


def scan(spark, texts, **known):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    found = licenses.scanned(spark.createDataFrame(rows, SCHEMA), licenses.known(spark, **known))
    return {r.doc_id: r for r in found.collect()}


def test_variants_of_a_licence(spark):
    mit = licenses.TEXTS["MIT"]
    texts = [
        mit,
        mit.upper(),
        mit.replace("\n\n", "\n").replace('"', "”").replace(", ", " ,\n\t"),
        mit.replace("Copyright (c) <year> <copyright holders>", "Copyright © 2021-2024 Somebody Else, Inc.\n(c) 2019 others\nAll rights reserved."),
        mit.replace("License", "Licence").replace("sublicense", "sub-licence").replace("COPYRIGHT HOLDERS", "copyright owners"),
        "/*\n * " + mit.replace("\n", "\n * ") + "\n */",
        mit.replace("free of charge", "for a fee"),
        mit + " More.",
        mit[:-40],
        mit.replace("software", "softwareé"),
    ]
    got = scan(spark, texts)
    assert [got[i].license for i in range(len(texts))] == ["MIT"] * 6 + [None] * 4
    assert len({got[i].text_digest for i in range(6)}) == 1


def test_notices_in_lines(spark):
    texts = [
        "prose\nReleased under the MIT Licence.\nmore",
        "RELEASED UNDER THE MIT LICENSE",
        "# SPDX-License-Identifier: MIT\nLicensed under CC BY-NC 4.0.\nLicensed  under CC BY–NC 4.0",
        "it says Released under the MIT License. and goes on",
        "",
        None,
        "...\n\n!!",
    ]
    got = scan(spark, texts)
    assert [(got[i].license, got[i].notices, got[i].n_notice_lines) for i in range(7)] == [
        (None, "MIT", 1), ("MIT", "MIT", 1), (None, "CC-BY-NC-4.0,MIT", 3), (None, "", 0), (None, "", 0), (None, "", 0), (None, "", 0),
    ]


def test_documents_equal_sql(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    want = sorted(con.sql(licenses.oracle()).fetchall())
    got = sorted(tuple(r) for r in licenses.scanned(docs, licenses.known(spark)).collect())
    assert got == want and any(r[3] for r in got)


def test_repeats_null_ids_and_empty_tables(spark):
    rows = [(1, "x", "a", 1), (1, "x", "a", 1), (None, "Licensed under CC BY-NC 4.0.", "a", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = licenses.scanned(docs, licenses.known(spark))
    assert sorted((str(r.doc_id), r.license) for r in got.collect()) == [("1", None), ("1", None), ("None", "CC-BY-NC-4.0")]
    assert licenses.scanned(docs.limit(0), licenses.known(spark)).collect() == []
    none = licenses.scanned(docs, licenses.known(spark).limit(0)).collect()
    assert [r.license for r in none] == [None] * 3
    empty = licenses.scanned(docs, spark.createDataFrame([("Nothing", "!!"), ("B", "X"), ("A", "x.")], "license string, text string")).collect()
    assert sorted(str(r.license) for r in empty) == ["A", "A", "None"]
    plan = plan_of(got)
    assert "Python" not in plan and "Arrow" not in plan


def test_common_licences_are_known_whole_by_notice_and_by_identifier(spark):
    whole = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Unlicense", "Zlib", "CC0-1.0")
    untitled = licenses.TEXTS["MIT"].split("\n", 1)[1]
    filled = licenses.TEXTS["Apache-2.0"].replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2021 Somebody")
    regents = licenses.TEXTS["BSD-3-Clause"].replace("COPYRIGHT HOLDERS", "REGENTS").replace("COPYRIGHT HOLDER", "REGENTS").replace("the copyright holder nor", "the University nor")
    notices = {
        "# SPDX-License-Identifier: BSD-3-Clause": "BSD-3-Clause", "// SPDX-License-Identifier: MPL-2.0": "MPL-2.0",
        "SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0", "SPDX-License-Identifier: GPL-3.0-only": "GPL-3.0",
        "This project is licensed under the BSD 3-Clause License.": "BSD-3-Clause",
        " * Licensed under the Apache License, Version 2.0 (the \"License\");": "Apache-2.0",
        "Released under the GNU General Public License v2.0": "GPL-2.0", "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
    }
    texts = [*(licenses.TEXTS[k] for k in whole), untitled, filled, regents, *(f"code\n{line}\nmore" for line in notices)]
    got = scan(spark, texts)
    n = len(whole)
    assert [got[i].license for i in range(n + 3)] == [*whole, "MIT", "Apache-2.0", "BSD-3-Clause"]
    assert [got[n + 3 + i].notices for i in range(len(notices))] == list(notices.values())


def test_no_form_has_two_names(spark):
    form = licenses.joined(licenses.canonical_lines(licenses.F.col("text")))
    twice = licenses.known(spark).groupBy(form.alias("form")).agg(licenses.F.collect_set("license").alias("names")).filter("size(names) > 1")
    assert [(r.form[:60], r.names) for r in twice.collect()] == []
