"""License scans by sentence rules, in SQL functions.

A line ends at a line break, at an empty line, at ``. ; : ! ?`` before white space and at a
web address; signs and words that open comments at its start do not count, so a line of these
alone is empty.
A known sentence is found where it fills a run of whole lines, however many it is wrapped
over. A run goes over the end of a sentence or an empty line only where the known text has
such an end itself (``free software: you can``, ``v. 2.0``). Words are compared as lower-case
letters and digits; where several known sentences fit, the longest counts. Known licence
sentences have identifiers; ``RULES`` are ordered sequences of identifiers. A licence is
found if its identifiers occur in that order among the recognised sentences, with at most
``MAX_BETWEEN`` other recognised ones in between. A rule that begins another one is not
found where the text goes on with the other: three BSD clauses are not also two. An SPDX
tag is a sentence of its own for each identifier of ``TAGGED``; expressions of several are not.

Only texts with one of ``CUES`` are searched: every known sentence holds one, as a single
word that no line break divides, so nothing is missed. Null and empty texts have no licences;
every row gives one row, ties do not occur, other columns are ignored, and an empty table
gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BETWEEN = 3

# Sentences of public licence texts and notices, normalised but for the marks
# that cut them; a text may have these or not.
SENTENCES = {
    "apache2_notice": "licensed under the apache license version 2 0",
    "apache2_notice_the_license": "licensed under the apache license version 2 0 the license",
    "apache2_compliance": "you may not use this file except in compliance with the license",
    "apache2_copy": "you may obtain a copy of the license at",
    "apache2_basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "mit_notice": "released under the mit license",
    "mit_licensed": "licensed under the mit license",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_keep": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit_as_is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "bsd_intro": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "gpl3_work": "this work is licensed under the gnu general public license version 3",
    "gpl3_licensed": "licensed under the gnu general public license version 3",
    "gpl2_work": "this work is licensed under the gnu general public license version 2",
    "gpl2_licensed": "licensed under the gnu general public license version 2",
    "gpl_free": "this program is free software; you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation; either version 3 of the license or at your option any later version",
    "gpl2_free": "this program is free software; you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation; either version 2 of the license or at your option any later version",
    "gpl_hope": "this program is distributed in the hope that it will be useful but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl3_notice": "licensed under the gnu lesser general public license version 3",
    "mpl2_notice": "this source code form is subject to the terms of the mozilla public license v. 2 0",
    "bsd_neither": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "agpl_free": "this program is free software; you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation; either version 3 of the license or at your option any later version",
    "lgpl21_free": "this library is free software; you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation; either version 2 1 of the license or at your option any later version",
    "lgpl_hope": "this library is distributed in the hope that it will be useful but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose",
    "epl2_notice": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at",
    "apache2_title": "apache license version 2 0 january 2004",
    "gpl3_title": "gnu general public license version 3 29 june 2007",
    "gpl2_title": "gnu general public license version 2 june 1991",
    "agpl3_title": "gnu affero general public license version 3 19 november 2007",
    "lgpl3_title": "gnu lesser general public license version 3 29 june 2007",
    "lgpl21_title": "gnu lesser general public license version 2 1 february 1999",
    "verbatim": "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed",
    "mit_see": "licensed under the mit license see license",
    "mit_see_file": "licensed under the mit license see license file",
    "mit_see_details": "licensed under the mit license see license for details",
    "cc_by_nc": "licensed under cc by nc 4 0",
    "cc_by": "licensed under cc by 4 0",
    "cc_by_sa": "licensed under cc by sa 4 0",
    "cc_by_nd": "licensed under cc by nd 4 0",
    "cc_by_nc_sa": "licensed under cc by nc sa 4 0",
    "cc_by_nc_nd": "licensed under cc by nc nd 4 0",
    "cc0": "released under cc0 1 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "reserved": "all rights reserved",
}

# Identifiers of the public SPDX list.
TAGGED = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0",
    "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "CC-BY-SA-4.0", "CC0-1.0",
    "CDDL-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only",
    "GPL-3.0-or-later", "ISC", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-2.0", "OFL-1.1", "Unlicense", "WTFPL", "Zlib",
)


def _plain(words: str, between: str) -> str:
    return between.join(re.findall("[a-z0-9]+", words.lower()))


SENTENCES |= {f"spdx_{_plain(x, '_')}": f"spdx license identifier: {_plain(x, ' ')}" for x in TAGGED}
CREATIVE = {x: SENTENCES[x] for x in ("cc_by", "cc_by_nc", "cc_by_sa", "cc_by_nd", "cc_by_nc_sa", "cc_by_nc_nd")}
SENTENCES |= {f"{name}_international": f"{sentence} international" for name, sentence in CREATIVE.items()}

# Licence, and the identifiers that make it up, in order; forms of one sentence as a pattern.
RULES = {
    "Apache-2.0 notice": ("apache2_notice",),
    "Apache-2.0 header": ("apache2_notice_the_license", "apache2_compliance", "apache2_copy", "apache2_basis"),
    "MIT notice": ("mit_notice",),
    "MIT reference": ("mit_licensed",),
    "MIT": ("mit_grant", "mit_keep", "mit_as_is"),
    "BSD-2-Clause": ("bsd_intro", "bsd_source", "bsd_binary"),
    "BSD-3-Clause": ("bsd_intro", "bsd_source", "bsd_binary", "bsd_neither"),
    "ISC": ("isc_grant",),
    "GPL-3.0 notice": ("gpl3_work",),
    "GPL-3.0 reference": ("gpl3_licensed",),
    "GPL-2.0 notice": ("gpl2_work",),
    "GPL-2.0 reference": ("gpl2_licensed",),
    "GPL-3.0-or-later": ("gpl_free", "gpl_hope"),
    "GPL-2.0-or-later": ("gpl2_free", "gpl_hope"),
    "AGPL-3.0-or-later": ("agpl_free", "gpl_hope"),
    "LGPL-2.1-or-later": ("lgpl21_free", "lgpl_hope"),
    "EPL-2.0 notice": ("epl2_notice",),
    "Apache-2.0 text": ("apache2_title",),
    "GPL-3.0 text": ("gpl3_title", "verbatim"),
    "GPL-2.0 text": ("gpl2_title", "verbatim"),
    "AGPL-3.0 text": ("agpl3_title", "verbatim"),
    "LGPL-3.0 text": ("lgpl3_title", "verbatim"),
    "LGPL-2.1 text": ("lgpl21_title", "verbatim"),
    "MIT reference to file": ("(?:mit_see|mit_see_file|mit_see_details)",),
    "LGPL-3.0 notice": ("lgpl3_notice",),
    "MPL-2.0": ("mpl2_notice",),
    "CC-BY-NC-4.0": ("cc_by_nc(?:_international)?",),
    "CC-BY-4.0": ("cc_by(?:_international)?",),
    "CC-BY-SA-4.0": ("cc_by_sa(?:_international)?",),
    "CC-BY-ND-4.0": ("cc_by_nd(?:_international)?",),
    "CC-BY-NC-SA-4.0": ("cc_by_nc_sa(?:_international)?",),
    "CC-BY-NC-ND-4.0": ("cc_by_nc_nd(?:_international)?",),
    "CC0-1.0": ("cc0",),
    "Unlicense": ("unlicense",),
    "All rights reserved": ("reserved",),
}
RULES |= {f"{x} tag": (f"spdx_{_plain(x, '_')}",) for x in TAGGED}

CUES = r"(?i)licen[sc]e|permission|redistribut|software|warranty|reserved|domain|cc0"
COMMENT = r"(?m)^[^\p{L}\p{N}\n]+(?:(?:rem|dnl)\b[^\p{L}\p{N}\n]*)?|^(?:rem|dnl)\b[^\p{L}\p{N}\n]*"
SENTENCE_END = r"\n[\x20\t\r]*\n|[.;:!?](?=\s|$)|https?://\S+"
# Stands for a sentence's end in lowered texts, which hold no capitals.
CUT = "X"


def sentence_pattern(sentence: str) -> str:
    """The words of a known sentence, wrapped anyhow; cuts are allowed where it has them itself."""
    pieces = (r"[\x20\n]++".join(piece.split()) for piece in re.split(SENTENCE_END, sentence))
    return rf"[\x20\n{CUT}]++".join(pieces)


# Of sentences that start alike the longest is tried first.
KNOWN = (
    r"(?m)^\x20?("
    + "|".join(sentence_pattern(s) for s in sorted(SENTENCES.values(), key=len, reverse=True))
    + rf")(?=\x20?{CUT}?\x20?$)"
)


def marked(text: Column) -> Column:
    """Lower-case letters and digits, single spaces, line breaks and cuts."""
    plain = F.regexp_replace(F.lower(text), COMMENT, "")
    return F.regexp_replace(F.regexp_replace(plain, SENTENCE_END, f"{CUT}\n"), rf"[^a-z0-9\n{CUT}]+", " ")


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    words = lambda s: " ".join(re.findall("[a-z0-9]+", s))
    known = F.create_map(*(F.lit(x) for name, sentence in SENTENCES.items() for x in (words(sentence), name)))
    found = F.regexp_extract_all(marked(text), F.lit(KNOWN), F.lit(1))
    names = F.transform(found, lambda s: F.element_at(known, F.regexp_replace(s, "[^a-z0-9]+", " ")))
    return F.when(text.rlike(CUES), names).otherwise(F.array().cast("array<string>"))


def rule_pattern(names: tuple[str, ...]) -> str:
    """Identifiers in order, not followed by what makes them the beginning of another rule."""
    between = rf"(?:\w+ ){{0,{MAX_BETWEEN}}}"
    longer = {rule[len(names)] for rule in RULES.values() if len(rule) > len(names) and rule[: len(names)] == names}
    # Where the rule begins anew, what follows belongs to that.
    onward = rf"(?:(?!{names[0]} )\w+ ){{0,{MAX_BETWEEN}}}"
    stays = "".join(rf"(?! {onward}{name} )" for name in sorted(longer))
    return " " + rf" {between}".join(names) + rf"(?= ){stays}"


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, sentence_ids, licences`` of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", sentence_ids(text).alias("sentence_ids"))
    line = F.concat(F.lit(" "), F.concat_ws(" ", "sentence_ids"), F.lit(" "))
    matched = [F.when(line.rlike(rule_pattern(names)), F.lit(licence)) for licence, names in RULES.items()]
    some = F.when(F.size("sentence_ids") > 0, F.array_compact(F.array(*matched)))
    return found.withColumn("licences", F.coalesce(some, F.array().cast("array<string>")))
