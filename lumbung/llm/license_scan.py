"""Licence scan by Dice coefficient over word bigrams, with DataFrame operations only.

Texts are normalised (lower case, everything but a-z, 0-9 and line breaks becomes a space) and cut into units:
every line, every paragraph of several lines (lines between empty ones), and the whole document when it has several
paragraphs. A unit is held against the templates whose number of distinct bigrams allows the threshold: a Dice
coefficient of t needs t / (2 - t) <= |unit| / |template| <= (2 - t) / t. The best template of a unit is reported
when 2 |common| / (|unit| + |template|) >= t; of equal ones the first by name.

The threshold also asks for t / (2 - t) of a template's bigrams. Words that touch so many of them that fewer are left (the
longest words first, common ones last) are its *key words*: a match holds one of them. Documents, then units, without any key word of
any template are passed over before bigrams are made.

No row is shuffled: templates are a literal of fixed size. Units without two words, and NULL or empty texts, match
nothing. Repeated rows are reported each time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm.common import result, table

# Short notices and standard texts of public licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
    "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
    "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
    "permissions and limitations under the License.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to "
    "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}
THRESHOLD = 0.8
# Words too common to be key words while there are others.
FUNCTION_WORDS = {
    "a", "an", "and", "any", "at", "be", "by", "can", "either", "except", "for", "if", "in", "including", "is", "later", "may", "not", "of", "on",
    "option", "or", "person", "persons", "so", "terms", "the", "this", "to", "under", "was", "with", "without", "work", "you", "your",
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), "[^a-z0-9\n]+", " ")


def _words(unit: Column) -> Column:
    return F.filter(F.split(unit, "[ \n]+"), lambda w: w != "")


def _bigrams(words: Column) -> Column:
    pairs = F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def _template(name: str, text: str) -> tuple[str, list[str]]:
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()
    return name, sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def key_words(grams: list[str], share: float) -> set[str]:
    """Words of which every text with ``share`` of the bigrams has at least one."""
    words = sorted({w for g in grams for w in g.split()}, key=lambda w: (w in FUNCTION_WORDS, -len(w), w))
    chosen: set[str] = set()
    for w in words:
        if sum(chosen.isdisjoint(g.split()) for g in grams) < share * len(grams):
            break
        chosen.add(w)
    return chosen


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, unit, unit_no, license, dice, n_bigrams) of every unit that matches a template."""
    known = [_template(n, t) for n, t in sorted(templates.items())]
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    literal = F.array(*[
        F.struct(F.lit(n).alias("name"), F.array(*map(F.lit, g)).alias("grams"), F.lit(len(g)).alias("size")) for n, g in known])
    # Sizes outside all bounds need no bigrams at all.
    least, most = min(len(g) for _, g in known) * low, max(len(g) for _, g in known) * high

    keys = sorted(set().union(*(key_words(g, low) for _, g in known)))
    text = F.col("text").cast("string")
    norm = docs.filter(F.lower(text).rlike(f"(?<![a-z0-9])(?:{'|'.join(keys)})(?![a-z0-9])")).select("doc_id", normalised(text).alias("norm"))
    paragraphs = F.split("norm", "\n *(?:\n *)+")
    several = F.filter(F.transform(paragraphs, lambda p, i: F.struct(F.lit("paragraph").alias("unit"), i.alias("unit_no"), p.alias("body"))),
                       lambda s: F.trim(s["body"]).contains("\n"))
    lines = F.transform(F.split("norm", "\n"), lambda x, i: F.struct(F.lit("line").alias("unit"), i.alias("unit_no"), x.alias("body")))
    whole = F.when(F.size(paragraphs) > 1,
                   F.array(F.struct(F.lit("document").alias("unit"), F.lit(0).alias("unit_no"), F.col("norm").alias("body")))
                   ).otherwise(F.array().cast("array<struct<unit:string,unit_no:int,body:string>>"))
    units = norm.select("doc_id", F.explode(F.concat(lines, several, whole)).alias("u")).select("doc_id", "u.unit", "u.unit_no", _words(F.col("u.body")).alias("words"))
    units = units.filter((F.size("words") - 1 >= least) & F.arrays_overlap("words", F.array(*map(F.lit, keys)))).select("doc_id", "unit", "unit_no", _bigrams(F.col("words")).alias("grams"))
    size = F.size("grams")
    units = units.filter((size >= least) & (size <= most))
    fitting = F.filter(literal, lambda t: (size >= t["size"] * F.lit(low)) & (size <= t["size"] * F.lit(high)))
    scored = F.transform(fitting, lambda t: F.struct(
        (F.size(F.array_intersect("grams", t["grams"])) * 2.0 / (size + t["size"])).alias("dice"), t["name"].alias("name")))
    best = F.reduce(scored, F.lit(None).cast("struct<dice:double,name:string>"),
                    lambda a, b: F.when(a.isNull() | (b["dice"] > a["dice"]), b).otherwise(a))
    return units.withColumn("best", best).filter(F.col("best.dice") >= threshold).select(
        "doc_id", "unit", "unit_no", F.col("best.name").alias("license"), F.col("best.dice").alias("dice"), size.alias("n_bigrams"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All licence notices in all documents."""
    return scan(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    rows = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in sorted(TEMPLATES.items()))
    words = r"list_filter(regexp_split_to_array({}, '[ \n]+'), lambda w: w <> '')"
    grams = "list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))"
    return rf"""
with t as (select name, {words.format("regexp_replace(lower(body), '[^a-z0-9]+', ' ', 'g')")} as words from (values {rows}) v(name, body)),
templates as (select name, {grams} as grams from t),
norm as (select doc_id, regexp_replace(lower(text), '[^a-z0-9\n]+', ' ', 'g') as norm from documents where text is not null),
parts as (select doc_id, norm, string_split(norm, chr(10)) as lines, regexp_split_to_array(norm, '\n *(?:\n *)+') as paragraphs from norm),
units as (
  select doc_id, 'line' as unit, unnest(range(0, len(lines)))::int as unit_no, unnest(lines) as body from parts
  union all
  select * from (select doc_id, 'paragraph', unnest(range(0, len(paragraphs)))::int, unnest(paragraphs) as body from parts)
    where contains(trim(body), chr(10))
  union all
  select doc_id, 'document', 0, norm from parts where len(paragraphs) > 1
), worded as (select doc_id, unit, unit_no, {words.format("body")} as words from units),
sized as (select doc_id, unit, unit_no, {grams} as grams from worded where len(words) > 1),
scored as (
  select s.doc_id, s.unit, s.unit_no, t.name as license, len(s.grams)::int as n_bigrams,
         len(list_intersect(s.grams, t.grams)) * 2.0::double / (len(s.grams) + len(t.grams)) as dice
  from sized s join templates t on list_has_any(s.grams, t.grams)
)
select doc_id, unit, unit_no, license, dice, n_bigrams from scored where dice >= {THRESHOLD}
qualify row_number() over (partition by doc_id, unit, unit_no order by dice desc, license) = 1
"""


ORACLE_OP7 = _oracle()
