"""Licence scans by canonical digest, by DataFrame operations only.

A text is brought to a canonical form: small letters, plain quotes and dashes, no copyright lines, one
spelling of words that have several, and single spaces for all other marks. The digest of the form is looked
up among those of known licences in a hash join. Whole documents are looked up, and each of their lines, as
licence notices are lines of larger documents.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Quotes and dashes, and the plain mark each counts as.
FANCY, PLAIN = "‘’‚“”„«»–—‐‑−", "''''''''-----"
# Spellings and what they count as, in this order; parts of words count, too.
SPELLINGS = (
    ("licenc", "licens"), ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"),
    ("artefact", "artifact"), ("authoris", "authoriz"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("catalogue", "catalog"), ("categoris", "categoriz"), ("centre", "center"), ("favour", "favor"),
    ("fulfill", "fulfil"), ("initialis", "initializ"), ("judgement", "judgment"), ("labelling", "labeling"),
    ("maximis", "maximiz"), ("minimis", "minimiz"), ("modelling", "modeling"), ("organis", "organiz"), ("practis", "practic"),
    ("programme", "program"), ("realis", "realiz"), ("recognis", "recogniz"), ("signalling", "signaling"),
    ("utilis", "utiliz"), ("whilst", "while"), ("wilful", "willful"), ("non-commercial", "noncommercial"),
    ("per cent", "percent"), ("copyright owner", "copyright holder"), ("sub-licens", "sublicens"), ("https:", "http:"),
)
# A line that states a copyright: the word or sign with a sign or year after it.
COPYRIGHT = r"(?m)^[^a-z0-9\n]*(copyright[ \t]*(\(c\)|©|[0-9])|\(c\)[ \t]|©)[^\n]*$"
RESERVED = "all rights reserved"
MARKS = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"

# Notices, as they stand in documents.
NOTICES = {
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT"),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"),
}
# Licences short enough to stand here. More stand in licences.json, or are rows of the caller's table.
TEXTS = {
    "MIT": """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """ISC License

Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """BSD Zero Clause License

Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
}

# More of both from the file: whole texts, their other wordings, usual notices, and all SPDX identifiers.
FILE = Path(__file__).with_name("licences.json")


def text_name(identifier: str) -> str:
    """The licence text that an SPDX identifier stands for; which later versions count is no part of the text."""
    return identifier.removesuffix("-only").removesuffix("-or-later").removesuffix("+")


def extend() -> None:
    """Add what the file lists; another wording of a whole text is a notice that fills a document."""
    listed = json.loads(FILE.read_text(encoding="utf-8"))
    untitled = [(name, text.split("\n\n", 2)[2]) for name, text in TEXTS.items()]
    TEXTS.update(listed["texts"])
    more = [*untitled, *((name, f"The {name} License\n\n{text}") for name, text in untitled), ("MIT", f"The MIT License (MIT)\n\n{untitled[0][1]}")]
    more += [(name, text) for part in ("wordings", "lines") for name, texts in listed[part].items() for text in texts]
    more += [(name, phrase.format(said)) for name, names in listed["names"].items() for said in names for phrase in listed["phrases"]]
    more += [(text_name(i), f"SPDX-License-Identifier: {i}") for i in listed["spdx"]]
    for name, text in more:
        NOTICES[name] = (*NOTICES.get(name, ()), text)


extend()


def canonical_lines(text: Column) -> Column:
    """The canonical form with its line ends still in it."""
    out = F.translate(F.coalesce(text.cast("string"), F.lit("")), CAPITALS + FANCY, SMALL + PLAIN)
    out = F.regexp_replace(out, COPYRIGHT, "")
    for old, new in ((RESERVED, ""), *SPELLINGS):
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.regexp_replace(out, MARKS, " ")


def joined(lines: Column) -> Column:
    """One line, with single spaces."""
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def digest(form: Column) -> Column:
    return F.sha2(form.cast("binary"), 256)


def known(spark: SparkSession, texts: dict[str, str] | None = None, notices: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(license, text) of the licences and notices given, those of this module by default."""
    rows = [*(TEXTS if texts is None else texts).items(), *((k, t) for k, ts in (NOTICES if notices is None else notices).items() for t in ts)]
    return spark.createDataFrame(rows, "license string, text string")


def scanned(docs: DataFrame, licences: DataFrame) -> DataFrame:
    """(doc_id, text_digest, license, notices, n_notice_lines) for every row.

    ``license`` is that of the whole text, NULL if it is none; ``notices`` lists the licences its lines are,
    in order and each once; a document that is a notice as a whole has both. Where licences share a form the
    first name counts, and a licence without words is left out. NULL texts are empty and match nothing. Rows
    without a doc_id and repeated rows stay; other columns are ignored. ``licences`` is a list of known
    texts, which the join may broadcast by its measured size.
    """
    digests = licences.select("license", joined(canonical_lines(F.col("text"))).alias("form")).filter("form <> ''")
    digests = digests.groupBy(digest(F.col("form")).alias("known")).agg(F.min("license").alias("license"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), canonical_lines(F.col("text")).alias("form"))
    lines = F.filter(F.transform(F.split("form", "\n"), joined), lambda x: x != "")
    # The first unit is the whole text, the others are its lines.
    units = rows.select("row", "doc_id", F.posexplode(F.concat(F.array(joined(F.col("form"))), lines)).alias("unit", "form"))
    found = units.withColumn("digest", digest(F.col("form"))).drop("form").join(digests, F.col("digest") == F.col("known"), "left")
    whole = F.col("unit") == 0
    return (
        found.filter(whole | F.col("license").isNotNull())
        .groupBy("row", "doc_id")
        .agg(
            F.max(F.when(whole, F.col("digest"))).alias("text_digest"),
            F.max(F.when(whole, F.col("license"))).alias("license"),
            F.array_join(F.array_sort(F.collect_set(F.when(~whole, F.col("license")))), ",").alias("notices"),
            F.count(F.when(~whole, 1)).alias("n_notice_lines"),
        )
        .drop("row")
    )


def oracle() -> str:
    """The SQL for scanned() with the licences of this module; doc_ids are unique."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    form = f"translate(coalesce(text, ''), {quoted(CAPITALS + FANCY)}, {quoted(SMALL + PLAIN)})"
    form = f"regexp_replace({form}, {quoted(COPYRIGHT)}, '', 'g')"
    for old, new in ((RESERVED, ""), *SPELLINGS):
        form = f"replace({form}, {quoted(old)}, {quoted(new)})"
    form = f"regexp_replace({form}, {quoted(MARKS)}, ' ', 'g')"
    one = "trim(regexp_replace({0}, '[ \\n]+', ' ', 'g'))"
    values = ", ".join(f"({quoted(k)}, {quoted(t)})" for k, t in [*TEXTS.items(), *((k, t) for k, ts in NOTICES.items() for t in ts)])
    return f"""
    WITH k AS (SELECT min(license) AS license, sha256({one.format("form")}) AS digest
               FROM (SELECT license, {form} AS form FROM (VALUES {values}) v(license, text)) GROUP BY 2),
    d AS (SELECT doc_id, {form} AS form FROM documents),
    l AS (SELECT doc_id, {one.format("line")} AS line FROM (SELECT doc_id, unnest(string_split(form, chr(10))) AS line FROM d)),
    n AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, count(*) AS n
          FROM l JOIN k ON sha256(line) = digest WHERE line <> '' GROUP BY doc_id)
    SELECT d.doc_id, sha256({one.format("form")}) AS text_digest, k.license, coalesce(notices, '') AS notices, coalesce(n, 0) AS n_notice_lines
    FROM d LEFT JOIN k ON k.digest = sha256({one.format("form")}) LEFT JOIN n USING (doc_id)"""
