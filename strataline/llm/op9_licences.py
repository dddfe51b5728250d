"""Licence scan by sentence rules: known licence sentences become identifiers, and the sequence of a document's
identifiers is matched against ordered rules.

The rules know full texts, headers, titles, notices ("licensed under the ...") and SPDX tags of the licences in
``FAMILIES`` and a few more. A sentence ends after ``.``, ``;`` or ``:`` before white space, at a line without letters or digits, at a line break after anything but
a letter, digit, comma or quote (licence texts come wrapped), and before a line that opens as licence notices do. Its
normal form has lower-case letters and digits with single spaces, which drops comment marks. A document's known
sentences form a string of identifiers in text order, with a bar where unknown sentences lie between two. It is read
from left to right: at each identifier the first rule in order whose sequence follows wins, and its stretch is spent,
so a full text wins over the mention it begins with.

Built-in functions only. Sentences are looked up in a table of fixed size, so the one large side is never shuffled;
only the known sentences are grouped by document.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from .shared import only

# Sentences of public licence texts and notices, and the licence each ordered sequence of them stands for.
SENTENCES: dict[str, tuple[str, ...]] = {
    "apache_notice": ("Licensed under the Apache License, Version 2.0.",
                      'Licensed under the Apache License, Version 2.0 (the "License")',
                      "Licensed under the Apache License, Version 2.0"),
    "apache_comply": ("you may not use this file except in compliance with the License.",),
    "apache_copy": ("You may obtain a copy of the License at",),
    "apache_url": ("http://www.apache.org/licenses/LICENSE-2.0", "https://www.apache.org/licenses/LICENSE-2.0"),
    "apache_as_is": ('Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',),
    "mit_title": ("The MIT License", "MIT License", "The MIT License (MIT)"),
    "mit_notice": ("Released under the MIT License.", "Licensed under the MIT License.",
                   "This project is licensed under the MIT License.", "Distributed under the MIT License."),
    "mit_grant": ('Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions',),
    "mit_keep": ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",),
    "mit_as_is": ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',),
    "bsd_grant": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",),
    "bsd_source": ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",),
    "bsd_binary": ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",),
    "bsd_names": ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",),
    "gpl3_notice": ("This work is licensed under the GNU General Public License, version 3.",
                    "Licensed under the GNU General Public License, version 3."),
    "gpl2_notice": ("This work is licensed under the GNU General Public License, version 2.",
                    "Licensed under the GNU General Public License, version 2."),
    "gpl_free": ("This program is free software",),
    "gpl2_later": ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",),
    "gpl3_later": ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "gpl_hope": ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",),
    "cc_by_4": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc_by_sa_4": ("Licensed under CC BY-SA 4.0.",
                   "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc_by_nc_4": ("Licensed under CC BY-NC 4.0.",
                   "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc0": ("Released under CC0 1.0.", "Dedicated to the public domain under CC0 1.0."),
    "all_rights": ("All rights reserved.",),
}
RULES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("apache_2_header", "Apache-2.0", ("apache_notice", "apache_comply", "apache_copy", "apache_url", "apache_as_is")),
    ("mit_titled_text", "MIT", ("mit_title", "mit_grant", "mit_keep", "mit_as_is")),
    ("mit_text", "MIT", ("mit_grant", "mit_keep", "mit_as_is")),
    ("bsd_3_text", "BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_names")),
    ("bsd_2_text", "BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("gpl_3_later_text", "GPL-3.0-or-later", ("gpl_free", "gpl3_later", "gpl_hope")),
    ("gpl_2_later_text", "GPL-2.0-or-later", ("gpl_free", "gpl2_later", "gpl_hope")),
    ("apache_2_notice", "Apache-2.0", ("apache_notice",)),
    ("mit_notice", "MIT", ("mit_notice",)),
    ("mit_title", "MIT", ("mit_title",)),
    ("gpl_3_notice", "GPL-3.0-only", ("gpl3_notice",)),
    ("gpl_2_notice", "GPL-2.0-only", ("gpl2_notice",)),
    ("cc_by_nc_4_notice", "CC-BY-NC-4.0", ("cc_by_nc_4",)),
    ("cc_by_sa_4_notice", "CC-BY-SA-4.0", ("cc_by_sa_4",)),
    ("cc_by_4_notice", "CC-BY-4.0", ("cc_by_4",)),
    ("cc0_notice", "CC0-1.0", ("cc0",)),
    ("all_rights", "LicenseRef-proprietary", ("all_rights",)),
)

# SPDX identifiers of common licences and the names notices call them by.
FAMILIES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Apache License 2.0", "Apache License, Version 2", "Apache 2.0 License", "Apache License v2.0", "Apache-2.0 License",
                   "Apache Software License 2.0", "Apache 2.0"),
    "MIT": ("MIT license (MIT)", "MIT", "Expat License"),
    "ISC": ("ISC License", "ISC licence", "ISC"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause License", "FreeBSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "Revised BSD License",
                     "BSD-3-Clause License", "BSD-style License"),
    "GPL-2.0-only": ("GNU General Public License v2", "GNU GPL v2", "GPLv2", "GPL v2", "GNU General Public License v2.0", "GPL-2.0"),
    "GPL-2.0-or-later": ("GNU General Public License version 2 or later", "GPLv2+", "GPL v2 or later", "GPL-2.0+"),
    "GPL-3.0-only": ("GNU General Public License v3", "GNU GPL v3", "GPLv3", "GPL v3", "GNU General Public License v3.0", "GPL-3.0"),
    "GPL-3.0-or-later": ("GNU General Public License version 3 or later", "GPLv3+", "GPL v3 or later", "GPL-3.0+"),
    "LGPL-2.1-only": ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPL v2.1", "LGPLv2.1", "LGPL-2.1"),
    "LGPL-2.1-or-later": ("GNU Lesser General Public License version 2.1 or later", "LGPLv2.1+", "LGPL-2.1+"),
    "LGPL-3.0-only": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3", "LGPL v3", "LGPLv3", "LGPL-3.0"),
    "LGPL-3.0-or-later": ("GNU Lesser General Public License version 3 or later", "LGPLv3+", "LGPL-3.0+"),
    "AGPL-3.0-only": ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3", "AGPL v3", "AGPLv3", "AGPL-3.0"),
    "AGPL-3.0-or-later": ("GNU Affero General Public License version 3 or later", "AGPLv3+", "AGPL-3.0+"),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License, v.", "MPL 2.0", "MPL-2.0"),
    "EPL-1.0": ("Eclipse Public License 1.0", "Eclipse Public License v1.0", "EPL 1.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License v2.0", "EPL 2.0"),
    "Unlicense": ("Unlicense", "Unlicence"),
    "Zlib": ("zlib License", "zlib/libpng License"),
    "BSL-1.0": ("Boost Software License 1.0", "Boost Software License, Version 1.0"),
    "Artistic-2.0": ("Artistic License 2.0",),
    "WTFPL": ("WTFPL License",),
    "CC0-1.0": ("CC0 1.0", "Creative Commons Zero v1.0 Universal License", "CC0 1.0 Universal License"),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0 International License", "CC-BY-4.0 License"),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0 License"),
    "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC-4.0 License"),
    "CC-BY-ND-4.0": ("Creative Commons Attribution-NoDerivatives 4.0 International License", "CC BY-ND 4.0"),
}
# What stands before a name in a notice.
OPENINGS = tuple(f"{subject}{verb} under {article}" for article in ("the ", "a ", "") for subject, verb in (
    ("", "Licensed"), ("", "Released"), ("", "Distributed"), ("", "Available"), ("This project is ", "licensed"),
    ("This work is ", "licensed"), ("This software is ", "licensed"), ("This program is ", "licensed"), ("This file is ", "licensed"),
    ("This code is ", "licensed"), ("This library is ", "licensed"), ("This software is ", "released"),
    ("This project is ", "released"), ("This software is ", "distributed")))
# Full texts and headers beyond those above, and titles that stand alone.
SENTENCES |= {
    "mpl_form": ("This Source Code Form is subject to the terms of the Mozilla Public License, v.",),  # 2.0 is a sentence then
    "gpl_terms": ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",),
    "lgpl_terms": ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",),
    "v2_either": ("either version 2 of the License, or (at your option) any later version.",),
    "v21_either": ("either version 2.1 of the License, or (at your option) any later version.",),
    "v3_either": ("either version 3 of the License, or (at your option) any later version.",),
    "isc_grant": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
                  "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "unlicense_free": ("This is free and unencumbered software released into the public domain.",),
    "unlicense_anyone": ("Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",),
    "lgpl_free": ("This library is free software",),
    "lgpl3_later": ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "agpl3_later": ("you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "gpl_title": ("GNU GENERAL PUBLIC LICENSE",),
    "gpl_title_3": ("GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",),
    "gpl_title_2": ("GNU GENERAL PUBLIC LICENSE Version 2, June 1991",),
    "lgpl_title_3": ("GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",),
    "agpl_title_3": ("GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",),
    "apache_title": ("Apache License Version 2.0, January 2004",),
    "mpl_title": ("Mozilla Public License Version 2.0",),
    "epl_title": ("Eclipse Public License - v 2.0",),
}
RULES = (
    ("gpl_2_later_header", "GPL-2.0-or-later", ("gpl_free", "gpl_terms", "v2_either")),
    ("gpl_3_later_header", "GPL-3.0-or-later", ("gpl_free", "gpl_terms", "v3_either")),
    ("lgpl_21_later_header", "LGPL-2.1-or-later", ("lgpl_free", "lgpl_terms", "v21_either")),
    ("lgpl_3_later_header", "LGPL-3.0-or-later", ("lgpl_free", "lgpl_terms", "v3_either")),
    ("lgpl_3_later_text", "LGPL-3.0-or-later", ("lgpl_free", "lgpl3_later")),
    ("agpl_3_later_text", "AGPL-3.0-or-later", ("gpl_free", "agpl3_later")),
    ("unlicense_text", "Unlicense", ("unlicense_free", "unlicense_anyone")),
    *RULES,
    ("gpl_3_later_short", "GPL-3.0-or-later", ("gpl_free", "gpl3_later")), ("isc_text", "ISC", ("isc_grant",)), ("unlicense_short", "Unlicense", ("unlicense_free",)), ("mpl_2_short", "MPL-2.0", ("mpl_form",)),
    ("gpl_3_title", "GPL-3.0-only", ("gpl_title_3",)), ("gpl_2_title", "GPL-2.0-only", ("gpl_title_2",)),
    ("lgpl_3_title", "LGPL-3.0-only", ("lgpl_title_3",)), ("agpl_3_title", "AGPL-3.0-only", ("agpl_title_3",)),
    ("apache_2_title", "Apache-2.0", ("apache_title",)), ("mpl_2_title", "MPL-2.0", ("mpl_title",)), ("epl_2_title", "EPL-2.0", ("epl_title",)),
)


def _with_families() -> None:
    """Sentences and rules of every family by rule: each opening with each name, and its SPDX tag."""
    global RULES
    known = {normal_form(text) for texts in SENTENCES.values() for text in texts}
    more = []
    for licence, names in FAMILIES.items():
        key = re.sub(r"[^a-z0-9]", "_", licence.lower())
        forms: dict[str, str] = {}
        for opening in OPENINGS:
            for name in names:
                forms.setdefault(normal_form(opening + name), opening + name)
        SENTENCES[f"notice_{key}"] = tuple(text for form, text in forms.items() if form not in known)
        SENTENCES[f"spdx_{key}"] = tuple(dict.fromkeys((f"SPDX license {licence}", f"SPDX license {licence.removesuffix('-only')}")))
        known |= set(forms)
        more += [(f"family_{key}", licence, (f"notice_{key}",)), (f"spdx_{key}", licence, (f"spdx_{key}",))]
    RULES = (*RULES, *more)


WHITE = r"\x20\x09-\x0D"
# Places where sentences end: pattern and replacement, MARK standing for the end.
MARK = "\x01"
ENDS = (
    # A tag is a sentence of its own, and so is each further identifier of its expression.
    (r"SPDX-License-Identifier:[ \t]*\(?([A-Za-z0-9.+-]+)\)?", "tag"),
    *[(r"(SPDX license [A-Za-z0-9.+-]+\x01)[ \t]+(?:OR|AND)[ \t]+\(?([A-Za-z0-9.+-]+)\)?", "next")] * 4,
    (r"([0-9])\+([^+0-9A-Za-z]|$)", "plus"),
    (rf"([.;:])[{WHITE}]+", "after"),
    (r"[\n\r][^A-Za-z0-9]*[\n\r]", "here"),
    (r"([^A-Za-z0-9,\x22\x01])[\n\r]+", "after"),
    (r"[\n\r]+([^A-Za-z0-9\x01]{0,8}(?:Licensed under|Released under|Distributed under|Dedicated to|This work is|"
     r"This project is|This program is|This software is|This file is|This code is|This library is|Available under|This Source Code|Permission is|Redistribution|Neither the|All rights|The MIT|MIT License))", "before"),
)
OTHER = r"[^a-z0-9]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Each known sentence has one of these stems; sentences without one are not normalised.
CUES = ("licen", "unencumbered", "warrant", "redistribut", "permission", "software", "cc.by", "cc0", "reserved", "contributors", "under ", "distributed with")


# What takes the place of the end that a pattern finds, in Spark's notation.
REPLACED = {"after": "$1" + MARK, "here": MARK, "before": MARK + "$1", "tag": MARK + "SPDX license $1" + MARK,
            "next": "$1SPDX license $2" + MARK, "plus": "$1 or later$2"}


def normal_form(text: str) -> str:
    """The normal form of a known sentence, as :func:`normal` makes it after the ends are marked."""
    text = re.sub(r"([0-9])\+([^+0-9A-Za-z]|$)", r"\1 or later\2", text)
    return re.sub(OTHER, " ", text.translate(str.maketrans(UPPER, LOWER))).strip(" ")


_with_families()


def normal(sentence: Column) -> Column:
    """Lower-case ASCII letters and digits, everything else one space, trimmed."""
    return F.trim(F.regexp_replace(F.translate(sentence, UPPER, LOWER), OTHER, " "))


def known_forms(sentences: dict[str, tuple[str, ...]] = SENTENCES) -> dict[str, str]:
    """Normal form to identifier. Every form needs a cue word and belongs to one identifier."""
    forms: dict[str, str] = {}
    for name, texts in sentences.items():
        for form in map(normal_form, texts):
            if forms.setdefault(form, name) != name:
                raise ValueError(f"two identifiers for {form!r}")
            if not any(re.search(cue, form) for cue in CUES):
                raise ValueError(f"no cue word in {form!r}")
    return forms


def rule_pattern(rules: tuple[tuple[str, str, tuple[str, ...]], ...] = RULES) -> str:
    """All rules as one ordered alternation over strings such as ``/mit_grant@4/mit_keep@5|/cc0@9``."""
    return "|".join("".join(f"/{name}@[0-9]+" for name in names) for _, _, names in rules)


def known_sentences(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    sentences: dict[str, tuple[str, ...]] = SENTENCES) -> DataFrame:
    """``doc_id``, ``row_key``, ``place`` (number of the sentence in its text, from 0) and ``sentence``."""
    forms = docs.sparkSession.createDataFrame(list(known_forms(sentences).items()), "normal string, sentence string")
    marked = F.col(f"`{text_column}`")
    for pattern, side in ENDS:
        marked = F.regexp_replace(marked, pattern, REPLACED[side])
    rows = only(docs, [id_column, text_column]).select(
        F.col(f"`{id_column}`").alias("doc_id"),
        F.xxhash64(f"`{id_column}`", F.lit("/"), f"`{text_column}`").alias("row_key"),
        F.posexplode(F.split(marked, MARK)).alias("place", "raw"))
    cued = rows.where(F.translate("raw", UPPER, LOWER).rlike("|".join(CUES)))
    # The known forms are a fixed list.
    return cued.withColumn("normal", normal(F.col("raw"))).join(F.broadcast(forms), "normal").select(
        "doc_id", "row_key", "place", "sentence")


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
         sentences: dict[str, tuple[str, ...]] = SENTENCES,
         rules: tuple[tuple[str, str, tuple[str, ...]], ...] = RULES) -> DataFrame:
    """One row per matched stretch: ``doc_id``, ``row_key``, ``rule``, ``licence``, ``place`` (its first sentence),
    ``n_sentences``.

    Null and empty texts and texts without a matched sentence give no rows. Rows equal in id and text share a
    ``row_key`` and are scanned once. Ids may be null. An empty table gives no rows; other columns are ignored.
    """
    found = known_sentences(docs, id_column, text_column, sentences).distinct()
    # The identifiers of one text: as many as it has sentences at most.
    listed = found.groupBy("doc_id", "row_key").agg(F.array_sort(F.collect_list(F.struct("place", "sentence"))).alias("known"))
    token = F.transform("known", lambda x, i: F.concat(
        F.when((i > 0) & (x["place"] > F.get("known", i - 1)["place"] + 1), F.lit("|")).otherwise(F.lit("")),
        F.lit("/"), x["sentence"], F.lit("@"), x["place"].cast("string")))
    hits = listed.select("doc_id", "row_key", F.explode(F.regexp_extract_all(
        F.array_join(token, ""), F.lit(f"({rule_pattern(rules)})"), 1)).alias("hit"))
    names = docs.sparkSession.createDataFrame(
        [("".join(f"/{n}" for n in names), rule, licence, len(names)) for rule, licence, names in rules],
        "names string, rule string, licence string, n_sentences int")
    return (
        hits.withColumn("names", F.regexp_replace("hit", "@[0-9]+", ""))
        .join(F.broadcast(names), "names")  # the fixed rules
        .select("doc_id", "row_key", "rule", "licence", F.regexp_extract("hit", "@([0-9]+)", 1).cast("int").alias("place"), "n_sentences")
    )


def oracle() -> str:
    """The scan in DuckDB's SQL: ``doc_id``, ``licences`` and ``n_matches`` of texts with a match."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    marked = "text"
    for pattern, side in ENDS:
        to = REPLACED[side].replace("$", "\\").replace(MARK, "@@")
        marked = f"regexp_replace({marked}, {quoted(pattern)}, replace({quoted(to)}, '@@', chr(1)), 'g')"
    forms = ", ".join(f"({quoted(f)}, {quoted(n)})" for f, n in known_forms().items())
    names = ", ".join(f"({quoted(''.join('/' + n for n in names))}, {quoted(licence)})" for _, licence, names in RULES)
    return f"""
WITH forms(normal, sentence) AS (VALUES {forms}),
rules(names, licence) AS (VALUES {names}),
split AS (SELECT doc_id, string_split({marked}, chr(1)) AS parts FROM documents),
sentences AS (SELECT doc_id, unnest(parts) AS raw, generate_subscripts(parts, 1) - 1 AS place FROM split),
known AS (
  SELECT doc_id, place, sentence,
         lag(place) OVER (PARTITION BY doc_id ORDER BY place) AS earlier
  FROM sentences JOIN forms
    ON forms.normal = trim(regexp_replace(translate(raw, '{UPPER}', '{LOWER}'), '{OTHER}', ' ', 'g'))),
lines AS (
  SELECT doc_id, string_agg(CASE WHEN place > earlier + 1 THEN '|' ELSE '' END || '/' || sentence || '@' || place, ''
                            ORDER BY place) AS line FROM known GROUP BY doc_id),
hits AS (SELECT doc_id, unnest(regexp_extract_all(line, {quoted(rule_pattern())})) AS hit FROM lines)
SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences, count(*) AS n_matches
FROM hits JOIN rules ON rules.names = regexp_replace(hit, '@[0-9]+', '', 'g')
GROUP BY doc_id"""
