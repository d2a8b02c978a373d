"""Licence scan by sentence rules (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostar.llm.common import SPACE, pick

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Known licence sentences, normalised: identifier -> wordings.
SENTENCES: dict[str, tuple[str, ...]] = {
    "mit_name": ("released under the mit license", "licensed under the mit license",
                 "this project is licensed under the mit license", "the mit license",
                 "the mit license mit", "mit license"),
    "mit_grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute sublicense "
        "and or sell copies of the software and to permit persons to whom the software is furnished to "
        "do so subject to the following conditions",),
    "mit_notice": (
        "the above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the software",),
    "asis_software": (
        "the software is provided as is without warranty of any kind express or implied including but "
        "not limited to the warranties of merchantability fitness for a particular purpose and "
        "noninfringement",),
    "isc_grant": (
        "permission to use copy modify and or distribute this software for any purpose with or without "
        "fee is hereby granted provided that the above copyright notice and this permission notice "
        "appear in all copies",),
    "bsd_grant": (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",),
    "bsd_source": (
        "redistributions of source code must retain the above copyright notice this list of conditions "
        "and the following disclaimer",
        "1. redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer"),
    "bsd_binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of "
        "conditions and the following disclaimer in the documentation and or other materials provided "
        "with the distribution",
        "2. redistributions in binary form must reproduce the above copyright notice this list of "
        "conditions and the following disclaimer in the documentation and or other materials provided "
        "with the distribution"),
    "bsd_endorse": (
        "neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission",
        "3. neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission"),
    "bsd_name": ("licensed under the bsd license", "released under the bsd license"),
    "apache_name": ("licensed under the apache license version 2.0",
                    "licensed under the apache license version 2.0 the license",
                    "released under the apache license version 2.0",
                    "this project is licensed under the apache license version 2.0"),
    "apache_comply": ("you may not use this file except in compliance with the license",),
    "apache_copy": ("you may obtain a copy of the license at",),
    "gpl3_name": ("this work is licensed under the gnu general public license version 3",
                  "licensed under the gnu general public license version 3",
                  "released under the gnu general public license version 3"),
    "gpl2_name": ("this work is licensed under the gnu general public license version 2",
                  "licensed under the gnu general public license version 2",
                  "released under the gnu general public license version 2"),
    "gpl3_grant": (
        "this program is free software you can redistribute it and or modify it under the terms of the "
        "gnu general public license as published by the free software foundation either version 3 of "
        "the license or at your option any later version",),
    "gpl2_grant": (
        "this program is free software you can redistribute it and or modify it under the terms of the "
        "gnu general public license as published by the free software foundation either version 2 of "
        "the license or at your option any later version",),
    # The same as the headers write it, with ; and : that end sentences.
    "gpl_free": ("this program is free software",),
    "gpl3_terms": (
        "you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation either version 3 of the license or at your option any "
        "later version",),
    "gpl2_terms": (
        "you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation either version 2 of the license or at your option any "
        "later version",),
    "gpl_terms": (
        "you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation",),
    "gpl3_later": ("either version 3 of the license or at your option any later version",),
    "gpl2_later": ("either version 2 of the license or at your option any later version",),
    "gpl_useful": (
        "this program is distributed in the hope that it will be useful but without any warranty",),
    "gpl_implied": (
        "without even the implied warranty of merchantability or fitness for a particular purpose",),
    "gpl_hope": (
        "this program is distributed in the hope that it will be useful but without any warranty without "
        "even the implied warranty of merchantability or fitness for a particular purpose",),
    "gpl_details": ("see the gnu general public license for more details",),
    "lgpl_name": ("licensed under the gnu lesser general public license version 3",
                  "licensed under the gnu lesser general public license version 2.1"),
    "agpl_name": ("licensed under the gnu affero general public license version 3",),
    # "v. 2.0" ends a sentence after its v; only version 2.0 says "source code form".
    "mpl_name": ("this source code form is subject to the terms of the mozilla public license v. 2.0",
                 "this source code form is subject to the terms of the mozilla public license v",
                 "licensed under the mozilla public license version 2.0"),
    "cc_by_nc": ("licensed under cc by nc 4.0", "this work is licensed under cc by nc 4.0"),
    "cc_by_sa": ("licensed under cc by sa 4.0", "this work is licensed under cc by sa 4.0"),
    "cc_by": ("licensed under cc by 4.0", "this work is licensed under cc by 4.0"),
    "cc0": ("licensed under cc0 1.0", "this work is licensed under cc0 1.0"),
    "reserved": ("all rights reserved",),
}

#: Wordings with a free part: identifier -> pattern over a whole normalised sentence.
PATTERNS: dict[str, str] = {
    "copyright": r"^copyright( c)? [0-9]{4}.*$",
    "spdx_mit": r"^(.* )?spdx license identifier mit$",
    "spdx_apache": r"^(.* )?spdx license identifier apache 2.0$",
    "spdx_gpl3": r"^(.* )?spdx license identifier gpl 3.0( or later| only)?$",
    "spdx_bsd3": r"^(.* )?spdx license identifier bsd 3 clause$",
}

#: Licence rules in the order in which they are tried: a rule takes its
#: identifiers where they follow each other, other sentences left aside.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("MIT", ("mit_grant", "mit_notice", "asis_software")),
    ("MIT", ("mit_grant", "mit_notice")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("ISC", ("isc_grant",)),
    ("Apache-2.0", ("apache_name", "apache_comply", "apache_copy")),
    ("GPL-3.0-or-later", ("gpl3_grant", "gpl_hope", "gpl_details")),
    ("GPL-2.0-or-later", ("gpl2_grant", "gpl_hope", "gpl_details")),
    ("GPL-3.0-or-later", ("gpl_free", "gpl3_terms", "gpl_useful", "gpl_implied", "gpl_details")),
    ("GPL-3.0-or-later", ("gpl_free", "gpl_terms", "gpl3_later", "gpl_useful", "gpl_implied", "gpl_details")),
    ("GPL-2.0-or-later", ("gpl_free", "gpl2_terms", "gpl_useful", "gpl_implied", "gpl_details")),
    ("GPL-2.0-or-later", ("gpl_free", "gpl_terms", "gpl2_later", "gpl_useful", "gpl_implied", "gpl_details")),
    ("GPL-3.0-or-later", ("gpl_free", "gpl3_terms")),
    ("GPL-3.0-or-later", ("gpl_free", "gpl_terms", "gpl3_later")),
    ("GPL-2.0-or-later", ("gpl_free", "gpl2_terms")),
    ("GPL-2.0-or-later", ("gpl_free", "gpl_terms", "gpl2_later")),
    ("GPL-3.0-or-later", ("gpl3_terms",)),
    ("GPL-3.0-or-later", ("gpl_terms", "gpl3_later")),
    ("GPL-2.0-or-later", ("gpl2_terms",)),
    ("GPL-2.0-or-later", ("gpl_terms", "gpl2_later")),
    ("GPL-3.0-or-later", ("gpl3_grant",)),
    ("GPL-2.0-or-later", ("gpl2_grant",)),
    ("Apache-2.0", ("apache_name",)),
    ("Apache-2.0", ("spdx_apache",)),
    ("MIT", ("mit_name",)),
    ("MIT", ("spdx_mit",)),
    ("GPL-3.0", ("gpl3_name",)),
    ("GPL-3.0", ("spdx_gpl3",)),
    ("GPL-2.0", ("gpl2_name",)),
    ("LGPL", ("lgpl_name",)),
    ("AGPL-3.0", ("agpl_name",)),
    ("MPL-2.0", ("mpl_name",)),
    ("BSD-3-Clause", ("spdx_bsd3",)),
    ("BSD", ("bsd_name",)),
    ("CC-BY-NC-4.0", ("cc_by_nc",)),
    ("CC-BY-SA-4.0", ("cc_by_sa",)),
    ("CC-BY-4.0", ("cc_by",)),
    ("CC0-1.0", ("cc0",)),
    ("All-Rights-Reserved", ("copyright", "reserved")),
    ("All-Rights-Reserved", ("reserved",)),
)

#: Each known sentence holds one of these; texts without any are not taken apart.
CLUES = r"(?i)licen[sc]e|copyright|redistribut|rights[\x20\x09-\x0D]+reserved|permission|warranty|free[^a-z0-9]+software"
#: The colon of an SPDX tag ends no sentence: a bare "MIT" or "mit" is none of a licence.
_TAG = r"(?i)(spdx-license-identifier:)[\x20\x09]+"
_END = r"([.!?;:])[\x20\x09-\x0D]+"


def _sentences(text: Column) -> Column:
    """Normalised sentences: ended by . ! ? ; or : before white space, or by a line break."""
    marked = F.regexp_replace(F.concat(text, F.lit("\n")), _END, "$1\n")
    plain = F.translate(marked, UPPER, LOWER)

    def clean(x: Column) -> Column:
        words = F.regexp_replace(x, r"[^a-z0-9.+]+", " ")
        return F.btrim(F.regexp_replace(words, r"[.]+( |$)", " "))

    return F.transform(F.split(plain, "\n"), clean)


def _identify(sentence: Column) -> Column:
    known = F.create_map(*[F.lit(x) for name, wordings in SENTENCES.items()
                           for w in wordings for x in (w, name)])
    tests = [F.when(sentence.rlike(p), F.lit(name)) for name, p in PATTERNS.items()]
    return F.coalesce(F.try_element_at(known, sentence), *tests)


def _sequence(text: Column) -> Column:
    """The identifiers of the known sentences in order, each between bars: |a||b|."""
    ids = F.array_compact(F.transform(_sentences(text), _identify))
    return F.array_join(F.transform(ids, lambda i: F.concat(F.lit("|"), i, F.lit("|"))), "")


def _ruled(sequence: Column) -> Column:
    """struct(rest, found): what no rule took, and the licences found."""
    rules = F.array(*[F.struct(F.lit(name).alias("name"),
                               F.lit("".join(f"|{i}|" for i in ids)).alias("ids"))
                      for name, ids in RULES])
    start = F.struct(sequence.alias("rest"), F.lit("").alias("found"))

    def apply(state: Column, rule: Column) -> Column:
        hit = F.contains(state["rest"], rule["ids"])
        return F.struct(
            F.when(hit, F.replace(state["rest"], rule["ids"], F.lit("#"))).otherwise(state["rest"]).alias("rest"),
            F.when(hit, F.concat(state["found"], F.lit(","), rule["name"])).otherwise(state["found"]).alias("found"))

    return F.aggregate(rules, start, apply)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, licenses, n_known, n_left, verdict.

    A text is read twice: with line breaks as sentence ends, and with line
    breaks as spaces (wrapped licence texts). Sentences that are known become
    identifiers, unknown ones are left aside, and RULES are tried in order
    over the identifier sequence; each takes the identifiers it matches.
    ``licenses`` joins the distinct names by commas, sorted. ``n_known`` counts the
    identified sentences of the reading that identifies more, ``n_left`` those
    that no rule took in the reading that leaves fewer. verdict: 'none' (no
    licence sentence), 'unknown' (only sentences that no rule takes), else
    'licensed', or 'reserved' when All-Rights-Reserved is all that was found.

    Cases: null and empty texts are 'none'; repeated rows are judged each; an
    empty table gives no rows.
    """
    rows = pick(docs, "doc_id", "text")
    hinted = F.when(F.col("text").rlike(CLUES), F.regexp_replace("text", _TAG, "$1"))
    rows = rows.select("doc_id", hinted.alias("text"))
    flat = F.regexp_replace("text", SPACE, " ")
    rows = rows.withColumn("by_line", _sequence(F.col("text"))).withColumn("by_text", _sequence(flat))
    rows = rows.withColumn("a", _ruled(F.col("by_line"))).withColumn("b", _ruled(F.col("by_text")))
    found = F.array_sort(F.array_distinct(F.filter(
        F.split(F.concat("a.found", "b.found"), ","), lambda x: x != "")))
    names = F.coalesce(F.array_join(found, ","), F.lit(""))

    def count(seq: str) -> Column:
        return F.coalesce(F.regexp_count(seq, F.lit(r"\|[a-z0-9_]+\|")), F.lit(0))

    known = F.greatest(count("by_line"), count("by_text"))
    verdict = (F.when(known == 0, "none").when(names == "", "unknown")
               .when(names == "All-Rights-Reserved", "reserved").otherwise("licensed"))
    return rows.select("doc_id", names.alias("licenses"), known.cast("int").alias("n_known"),
                       F.least(count("a.rest"), count("b.rest")).cast("int").alias("n_left"),
                       verdict.alias("verdict"))


def op3_license_rules(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    """The same by joins: a table of wordings, numbered sentences, and one step per rule."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"({quote(w)}, {quote(n)})" for n, ws in SENTENCES.items() for w in ws)
    free = " ".join(f"WHEN regexp_matches(sentence, {quote(p)}) THEN {quote(n)}" for n, p in PATTERNS.items())
    steps, last = [], "seqs"
    for k, (name, ids) in enumerate(RULES):
        pat = quote("".join(f"|{i}|" for i in ids))
        steps.append(f"r{k} AS (SELECT doc_id, way, n, replace(rest, {pat}, '#') AS rest, "
                     f"CASE WHEN contains(rest, {pat}) THEN list_append(found, {quote(name)}) "
                     f"ELSE found END AS found FROM {last})")
        last = f"r{k}"
    space = r"[\x20\x09-\x0D]+"
    return rf"""
WITH wordings(s, id) AS (VALUES {known}),
readings AS (
  SELECT doc_id, 'line' AS way, text AS body FROM documents
  UNION ALL SELECT doc_id, 'text', regexp_replace(text, '{space}', ' ', 'g') FROM documents),
parts AS (
  SELECT doc_id, way, string_split(translate(
    regexp_replace(coalesce(body, '') || chr(10), '([.!?;:]){space}', '\1' || chr(10), 'g'),
    '{UPPER}', '{LOWER}'), chr(10)) AS p FROM readings),
pieces AS (
  SELECT doc_id, way, unnest(p) AS raw, generate_subscripts(p, 1) AS place FROM parts),
clean AS (
  SELECT doc_id, way, place, trim(regexp_replace(regexp_replace(raw, '[^a-z0-9.+]+', ' ', 'g'),
         '[.]+( |$)', ' ', 'g')) AS sentence FROM pieces),
named AS (
  SELECT doc_id, way, place, coalesce(w.id, CASE {free} END) AS id
  FROM clean c LEFT JOIN wordings w ON w.s = c.sentence),
seqs AS (
  SELECT doc_id, way, count(id) AS n,
         coalesce(string_agg('|' || id || '|', '' ORDER BY place) FILTER (id IS NOT NULL), '') AS rest,
         CAST([] AS VARCHAR[]) AS found
  FROM named GROUP BY doc_id, way),
{", ".join(steps)},
merged AS (
  SELECT doc_id, max(n) AS n_known,
         min(len(regexp_extract_all(rest, '\|[a-z0-9_]+\|'))) AS n_left,
         array_to_string(list_sort(list_distinct(flatten(list(found)))), ',') AS licenses
  FROM {last} GROUP BY doc_id)
SELECT doc_id, coalesce(licenses, '') AS licenses, CAST(n_known AS INTEGER) AS n_known,
       CAST(n_left AS INTEGER) AS n_left,
       CASE WHEN n_known = 0 THEN 'none' WHEN licenses = '' THEN 'unknown'
            WHEN licenses = 'All-Rights-Reserved' THEN 'reserved' ELSE 'licensed' END AS verdict
FROM merged
"""


SQL = _sql()
