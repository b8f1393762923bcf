"""Licence scans by sentence rules, in DataFrame operations only.

A text is cut into sentences; each, in normal form, is looked up among known licence
sentences and becomes its identifier. A known sentence may also be wrapped over several lines,
behind comment marks or not, begin after a colon or a list marker and end at a colon. A rule is an ordered list of identifiers; it holds
where these follow one another among the recognised sentences of a text, whatever
unknown sentences lie between. A licence is found if one of its rules holds.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

# --- fixed values: sentences of public licence texts and notices, and the rules over them ---
SENTENCES = {
    "mit_short": "Released under the MIT License.",
    "mit_short_2": "Licensed under the MIT License.",
    "mit_short_3": "This project is licensed under the terms of the MIT license.",
    "mit_grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
                 "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
                 "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
                 "following conditions:",
    "mit_notice": "The above copyright notice and this permission notice shall be included in all copies or substantial "
                  "portions of the Software.",
    "apache_short": "Licensed under the Apache License, Version 2.0.",
    "apache_head": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License.",
    "apache_copy": "You may obtain a copy of the License at",
    "apache_as_is": "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                    "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl3_short": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3_short_2": "Licensed under the GNU General Public License v3.0.",
    "gpl2_short": "This work is licensed under the GNU General Public License, version 2.",
    "gpl3_head": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                 "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                 "option) any later version.",
    "gpl2_head": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                 "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                 "option) any later version.",
    "gpl_no_warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
                       "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "bsd_head": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                "the following conditions are met:",
    "bsd_source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                  "following disclaimer.",
    "bsd_binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                  "following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd_names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                 "products derived from this software without specific prior written permission.",
    "mpl2_head": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc0_short": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
                 "this work.",
    "cc_by_short": "Licensed under CC BY 4.0.",
    "cc_by_long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc_by_sa_short": "Licensed under CC BY-SA 4.0.",
    "cc_by_sa_long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc_by_nc_short": "Licensed under CC BY-NC 4.0.",
    "cc_by_nc_long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc_by_nd_short": "Licensed under CC BY-ND 4.0.",
    "rights_reserved": "All rights reserved.",
}
RULES = [
    ("MIT", ["mit_short"]), ("MIT", ["mit_short_2"]), ("MIT", ["mit_short_3"]), ("MIT", ["mit_grant", "mit_notice"]),
    ("Apache-2.0", ["apache_short"]), ("Apache-2.0", ["apache_head", "apache_copy"]), ("Apache-2.0", ["apache_head", "apache_as_is"]),
    ("GPL-3.0", ["gpl3_short"]), ("GPL-3.0", ["gpl3_short_2"]), ("GPL-3.0-or-later", ["gpl3_head", "gpl_no_warranty"]),
    ("GPL-2.0", ["gpl2_short"]), ("GPL-2.0-or-later", ["gpl2_head", "gpl_no_warranty"]),
    ("BSD-2-Clause", ["bsd_head", "bsd_source", "bsd_binary"]),
    ("BSD-3-Clause", ["bsd_head", "bsd_source", "bsd_binary", "bsd_names"]),
    ("MPL-2.0", ["mpl2_head"]), ("CC0-1.0", ["cc0_short"]),
    ("CC-BY-4.0", ["cc_by_short"]), ("CC-BY-4.0", ["cc_by_long"]),
    ("CC-BY-SA-4.0", ["cc_by_sa_short"]), ("CC-BY-SA-4.0", ["cc_by_sa_long"]),
    ("CC-BY-NC-4.0", ["cc_by_nc_short"]), ("CC-BY-NC-4.0", ["cc_by_nc_long"]),
    ("CC-BY-ND-4.0", ["cc_by_nd_short"]), ("all-rights-reserved", ["rights_reserved"]),
]
# --------------------------------------------------------------------------------------------
NOISE = r"[^\p{L}\p{N}\n.!?]+"
SENTENCE_END = r" ?[.!?]+(?:[ \n]+|$)| ?\n[ \n]*"
#: For wrapped sentences, in texts that keep their colons: what stands before one (a list marker too), between
#: two of its words (a line break, no blank line) and after it.
FOLD_NOISE = r"[^\p{L}\p{N}\n.!?:]+"
MARKER = r"(?:[0-9]{1,2}|[a-z]|[ivx]{2,4}) "
BEFORE = rf"(?:(?:^|\n) ?(?:{MARKER})?|[.!?:] (?:{MARKER})?)"
BETWEEN = r"(?: ?:? ?\n ?| ?: ?| )"
AFTER = r"(?= ?(?:[.!?:]+(?:[ \n]|$)|\n|$))"


def sentences(text: Column) -> Column:
    """Sentences in normal form: lower case, anything but letters, digits and inner stops as one space.

    Only these two steps depend on the text; an empty or null text has no sentences.
    """
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NOISE, " ")
    return F.filter(F.split(F.trim(plain), SENTENCE_END), lambda s: s != "")


def clues(forms: list[str]) -> list[str]:
    """A few words one of which stands in every form; a text without any of them holds no form."""
    left, out = set(forms), []
    while left:
        words = {w for f in left for w in f.split(" ") if len(w) > 5 or w == max(f.split(" "), key=len)}
        out.append(max(sorted(words), key=lambda w: (sum(w in f.split(" ") for f in left), len(w))))
        left = {f for f in left if out[-1] not in f.split(" ")}
    return out


def wrapped(df: DataFrame, text: str, first: list[str], later: list[str], ids: Column, at: str) -> DataFrame:
    """``df`` with the known sentences of a text as ``at`` (position, identifier), whatever line breaks and colons they
    hold; the longest where several begin.

    ``later`` are the parts of a known sentence after its first; they must be whole lines or sentences, as "2.0" says
    little after a colon. Positions count the sentences of ``sentences`` before the one it begins in.
    """
    one_of = lambda forms: "|".join(BETWEEN.join(re.sub(r"([.!?])", r"\\\1", w) for w in f.split(" ")) for f in sorted(forms, key=lambda f: (-len(f), f)))
    either = rf"{BEFORE}(?:{one_of(first)}){AFTER}"
    if later:
        either += rf"|(?:(?:^|\n) ?|[.!?] )(?:{one_of(later)})(?= ?(?:[.!?]+(?:[ \n]|$)|\n|$))"
    hint = F.lit(False)
    for w in clues(first + later):
        hint = hint | F.contains(F.col("__lower"), F.lit(w))
    found = F.when(hint, F.regexp_extract_all(F.trim(F.regexp_replace("__lower", FOLD_NOISE, " ")), F.lit(either), F.lit(0)))
    gaps = F.when(F.size("__found") > 0, F.split(F.trim(F.regexp_replace("__lower", FOLD_NOISE, " ")), either))

    def breaks(hit: Column, i: Column) -> Column:
        """Sentence ends between the match before and this one, and within this one; a letter stands for a match."""
        lead = F.regexp_extract(hit, r"^[^\p{L}\p{N}]*", 0)
        gap = F.concat(F.when(i > 0, "x").otherwise(""), F.element_at("__gaps", i + 1), lead, F.lit("x"))
        return F.struct((F.size(sentences(gap)) - 1).alias("before"), (F.size(sentences(hit)) - 1).alias("inside"))

    def told(hit: Column, i: Column) -> Column:
        form = F.regexp_replace(F.trim(F.regexp_replace(hit, r"[ \n:]+", " ")), r"^[.!?]* ?", "")
        until = F.aggregate(F.slice("__breaks", F.lit(1), i), F.lit(0), lambda n, x: n + x["before"] + x["inside"])
        return F.struct((until + F.element_at("__breaks", i + 1)["before"]).alias("position"),
                        F.coalesce(F.try_element_at(ids, form), F.try_element_at(ids, F.regexp_replace(form, rf"^{MARKER}", ""))).alias("id"))

    nothing = F.array().cast("array<struct<position:int,id:string>>")
    return (df.withColumn("__lower", F.lower(F.coalesce(F.col(text), F.lit("")))).withColumn("__found", found).withColumn("__gaps", gaps)
            .withColumn("__breaks", F.transform("__found", breaks)).withColumn(at, F.coalesce(F.transform("__found", told), nothing))
            .drop("__lower", "__found", "__gaps", "__breaks"))


def scan(df: DataFrame, text: str = "text", known: dict[str, str] = SENTENCES,
         rules: list[tuple[str, list[str]]] = RULES, at: str = "license_sentences", found: str = "licenses") -> DataFrame:
    """``df`` with its recognised sentences (position from 0, identifier) and the licences found, sorted.

    One pass without a shuffle; the known sentences and the rules are literals of the plan. A rule holds if it does
    among the wrapped sentences or among those that are whole lines, which may be the beginning of a wrapped one.
    A longer rule of the same beginning does not hide a shorter one, except that a licence
    whose rules all lie within a longer rule that holds is not reported (BSD-2 within BSD-3).
    """
    table_of = df.sparkSession.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("id"), F.lit(s).alias("s")) for k, s in known.items()])).alias("k"))
    forms = table_of.select("k.id", F.explode(sentences(F.col("k.s"))).alias("form")).collect()
    parts: dict[str, list[str]] = {}
    for r in forms:  # a known sentence may itself fall into several, all of which must follow one another
        parts.setdefault(r["id"], []).append(r["form"])
    names = {form: f"s{i}" for i, form in enumerate(sorted({f for p in parts.values() for f in p}))}
    ids = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    pairs = F.filter(F.transform(sentences(F.col(text)), lambda s, i: F.struct(i.alias("position"), F.try_element_at(ids, s).alias("id"))),
                     lambda x: x["id"].isNotNull())
    first = {p[0] for p in parts.values()}
    sequence = [(name, "," + ",".join(names[f] for k in rule for f in parts[k]) + ",") for name, rule in rules]
    inside = {name: {other for other, seq in sequence if other != name
                     and all(any(s in t for o, t in sequence if o == other) for n, s in sequence if n == name)} for name, _ in sequence}
    string = lambda c: F.concat(F.lit(","), F.array_join(F.transform(F.col(c), lambda x: x["id"]), ","), F.lit(","))
    held = {name: F.lit(False) for name, _ in sequence}
    for name, seq in sequence:
        held[name] = held[name] | F.contains(F.col("__seq"), F.lit(seq)) | F.coalesce(F.contains(F.col("__lines_seq"), F.lit(seq)), F.lit(False))
    shown = []
    for name in sorted(held):
        hidden = F.lit(False)
        for other in sorted(inside[name]):
            hidden = hidden | held[other]
        shown.append(F.when(held[name] & ~hidden, F.lit(name)))
    nothing = F.size(at) == 0
    return (wrapped(df, text, sorted(first), sorted(set(names) - first), ids, at).withColumn("__lines", F.when(~nothing, pairs))
            .withColumn("__seq", string(at)).withColumn("__lines_seq", string("__lines"))
            .withColumn(found, F.when(nothing, F.array().cast("array<string>"))
                        .otherwise(F.filter(F.array(*shown), lambda x: x.isNotNull()))).drop("__seq", "__lines", "__lines_seq"))


def query(spark, sf_dir: str) -> DataFrame:
    """op10: the licences of every whole document, and how many known sentences and where the first stands."""
    rows = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.size("license_sentences").cast("long").alias("n_known"),
                       F.coalesce(F.try_element_at("license_sentences", F.lit(1))["position"], F.lit(-1)).cast("long").alias("first_sentence"),
                       F.array_join("licenses", ",").alias("licenses"))


def _sql() -> str:
    """The single-sentence rules and all others as DuckDB SQL over the same fixed values."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quote(k)}, {quote(s)})" for k, s in SENTENCES.items())
    rules = ", ".join(f"({i}, {quote(n)}, {j}, {quote(k)})" for i, (n, r) in enumerate(RULES) for j, k in enumerate(r))
    form = rf"""list_filter(string_split_regex(trim(regexp_replace(lower(coalesce({{0}}, '')), '[^\p{{L}}\p{{N}}\n.!?]+', ' ', 'g')),
                ' ?[.!?]+(?:[ \n]+|$)| ?\n[ \n]*'), lambda s: s <> '')"""
    return rf"""
WITH known(id, sentence) AS (VALUES {known}),
rules(rule, license, step, id) AS (VALUES {rules}),
parts AS (SELECT id, unnest(forms) AS form, generate_subscripts(forms, 1) AS part FROM (SELECT id, {form.replace("{0}", "sentence").replace("{{", "{").replace("}}", "}")} AS forms FROM known)),
rule_forms AS (SELECT rule, license, chr(1) || string_agg(form, chr(1) ORDER BY step, part) || chr(1) AS sequence FROM rules JOIN parts USING (id) GROUP BY ALL),
cut AS (SELECT doc_id, {form.replace("{0}", "text").replace("{{", "{").replace("}}", "}")} AS forms FROM documents),
every AS (SELECT doc_id, unnest(forms) AS form, generate_subscripts(forms, 1) - 1 AS position FROM cut),
seen AS (SELECT doc_id, form, position FROM every WHERE form IN (SELECT form FROM parts)),
texts AS (SELECT doc_id, count(*) AS n_known, min(position) AS first_sentence, chr(1) || string_agg(form, chr(1) ORDER BY position) || chr(1) AS sequence FROM seen GROUP BY 1),
held AS (SELECT DISTINCT doc_id, license FROM texts JOIN rule_forms ON contains(texts.sequence, rule_forms.sequence)),
shown AS (SELECT * FROM held h WHERE NOT (license = 'BSD-2-Clause' AND EXISTS (SELECT 1 FROM held o WHERE o.doc_id = h.doc_id AND o.license = 'BSD-3-Clause'))),
named AS (SELECT doc_id, string_agg(license, ',' ORDER BY license) AS licenses FROM shown GROUP BY 1)
SELECT d.doc_id, coalesce(n_known, 0)::BIGINT AS n_known, coalesce(first_sentence, -1)::BIGINT AS first_sentence, coalesce(licenses, '') AS licenses
FROM documents d LEFT JOIN texts USING (doc_id) LEFT JOIN named USING (doc_id)
"""


SQL = _sql()
