"""License recognition by sentence rules, in DataFrame expressions only.

Texts are normalised to lower-case letters and digits with marks where a sentence may begin or
end: at stops and at line ends. Sentences known from license texts that stand between two marks
become identifiers. Line ends (with the comment marks of the next line), semicolons and colons
may also stand inside a known sentence, as texts are wrapped and commented; blank lines and full
stops may not, but for the one of "v. 2.0". Of known sentences that begin at one place the
longest counts. A text's identifiers, in order, are matched against license rules: ordered lists
of identifiers, the longest first. Identifiers that a rule used up are not used by later rules.
Other sentences may stand between two sentences of a rule, other licenses' sentences may not.
Comment marks are characters other than letters and digits (``#``, ``//``, ``*``; not ``rem``).
Known are headers and grants of usual licenses, sentences that put something under a license by
its name, and SPDX lines of one identifier (``2.0+`` reads as ``2.0-or-later``; an expression of
several isn't known). A sentence that names a license in other words isn't known either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known license sentences: fixed values, normalised, by identifier.
SENTENCES = {
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-line": "released under the mit license",
    "mit-line-2": "licensed under the mit license",
    "apache-line": "licensed under the apache license version 2 0",
    "apache-line-2": "licensed under the apache license version 2 0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-obtain": "you may obtain a copy of the license at",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl3-line": "this work is licensed under the gnu general public license version 3",
    "gpl3-line-2": "licensed under the gnu general public license version 3",
    "gpl2-line": "this work is licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "mpl-terms": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by-line": "licensed under cc by 4 0",
    "cc-by-sa-line": "licensed under cc by sa 4 0",
    "cc-by-nc-line": "licensed under cc by nc 4 0",
    "cc-by-nd-line": "licensed under cc by nd 4 0",
    "cc0-line": "licensed under cc0 1 0",
    "reserved": "all rights reserved",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl2-only-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "lgpl21-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl3-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl3-free-2": "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "agpl3-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-grant-2": "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "isc-warranty": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "zlib-warranty": "this software is provided as is without any express or implied warranty",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "unlicense-domain": "this is free and unencumbered software released into the public domain",
    "epl2-terms": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
    "epl2-terms-2": "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0",
    "epl2-terms-3": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "epl2-terms-4": "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0 which is available at https www eclipse org legal epl 2 0",
    "epl1-terms": "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at",
    "epl1-terms-2": "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html",
}

# License rules: ordered identifiers, the longest first. (name, category, identifiers)
RULES = (
    ("BSD-3-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("Apache-2.0", "permissive", ("apache-line-2", "apache-comply", "apache-obtain", "apache-as-is")),
    ("MIT", "permissive", ("mit-grant", "mit-notice", "mit-warranty")),
    ("BSD-2-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("GPL-3.0-or-later", "copyleft", ("gpl-free", "gpl-hope")),
    ("Apache-2.0", "permissive", ("apache-line-2", "apache-comply")),
    ("MIT", "permissive", ("mit-line",)),
    ("MIT", "permissive", ("mit-line-2",)),
    ("MIT", "permissive", ("mit-grant",)),
    ("Apache-2.0", "permissive", ("apache-line",)),
    ("Apache-2.0", "permissive", ("apache-line-2",)),
    ("GPL-3.0-only", "copyleft", ("gpl3-line",)),
    ("GPL-3.0-only", "copyleft", ("gpl3-line-2",)),
    ("GPL-2.0-only", "copyleft", ("gpl2-line",)),
    ("GPL-3.0-or-later", "copyleft", ("gpl-free",)),
    ("MPL-2.0", "copyleft", ("mpl-terms",)),
    ("CC-BY-4.0", "permissive", ("cc-by-line",)),
    ("CC-BY-SA-4.0", "copyleft", ("cc-by-sa-line",)),
    ("CC-BY-NC-4.0", "noncommercial", ("cc-by-nc-line",)),
    ("CC-BY-ND-4.0", "noderivatives", ("cc-by-nd-line",)),
    ("CC0-1.0", "permissive", ("cc0-line",)),
    ("all-rights-reserved", "proprietary", ("reserved",)),
    ("GPL-2.0-or-later", "copyleft", ("gpl2-free", "gpl-hope")),
    ("GPL-2.0-only", "copyleft", ("gpl2-only-free", "gpl-hope")),
    ("LGPL-2.1-or-later", "copyleft", ("lgpl21-free", "lgpl-hope")),
    ("LGPL-3.0-or-later", "copyleft", ("lgpl3-free", "lgpl-hope")),
    ("LGPL-3.0-or-later", "copyleft", ("lgpl3-free-2", "gpl-hope")),
    ("AGPL-3.0-or-later", "copyleft", ("agpl3-free", "gpl-hope")),
    ("ISC", "permissive", ("isc-grant", "isc-warranty")),
    ("ISC", "permissive", ("isc-grant-2", "isc-warranty")),
    ("0BSD", "permissive", ("0bsd-grant", "isc-warranty")),
    ("Zlib", "permissive", ("zlib-warranty", "zlib-grant")),
    ("GPL-2.0-or-later", "copyleft", ("gpl2-free",)),
    ("GPL-2.0-only", "copyleft", ("gpl2-only-free",)),
    ("LGPL-2.1-or-later", "copyleft", ("lgpl21-free",)),
    ("LGPL-3.0-or-later", "copyleft", ("lgpl3-free",)),
    ("LGPL-3.0-or-later", "copyleft", ("lgpl3-free-2",)),
    ("AGPL-3.0-or-later", "copyleft", ("agpl3-free",)),
    ("ISC", "permissive", ("isc-grant",)),
    ("ISC", "permissive", ("isc-grant-2",)),
    ("0BSD", "permissive", ("0bsd-grant",)),
    ("Zlib", "permissive", ("zlib-grant",)),
    ("Unlicense", "permissive", ("unlicense-domain",)),
    ("EPL-2.0", "copyleft", ("epl2-terms",)),
    ("EPL-2.0", "copyleft", ("epl2-terms-2",)),
    ("EPL-2.0", "copyleft", ("epl2-terms-3",)),
    ("EPL-2.0", "copyleft", ("epl2-terms-4",)),
    ("EPL-1.0", "copyleft", ("epl1-terms",)),
    ("EPL-1.0", "copyleft", ("epl1-terms-2",)),
)

# SPDX identifiers by category: fixed values.
SPDX = {
    "permissive": ("MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "ISC", "Zlib", "Unlicense", "BSL-1.0", "CC0-1.0", "CC-BY-4.0"),
    "copyleft": ("GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
                 "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "EPL-1.0", "EPL-2.0", "CC-BY-SA-4.0"),
    "noncommercial": ("CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0"),
    "noderivatives": ("CC-BY-ND-4.0",),
}
# What licenses are called, normalised, and how something is put under one: fixed values.
CALLED = {
    "MIT": ("mit license",), "ISC": ("isc license",), "Zlib": ("zlib license",), "0BSD": ("bsd zero clause license",),
    "Apache-2.0": ("apache license version 2 0", "apache license 2 0"),
    "BSD-2-Clause": ("bsd 2 clause license",), "BSD-3-Clause": ("bsd 3 clause license",), "BSL-1.0": ("boost software license version 1 0",),
    "GPL-2.0-only": ("gnu general public license version 2",), "GPL-3.0-only": ("gnu general public license version 3",),
    "LGPL-2.1-only": ("gnu lesser general public license version 2 1",), "LGPL-3.0-only": ("gnu lesser general public license version 3",),
    "AGPL-3.0-only": ("gnu affero general public license version 3",),
    "MPL-2.0": ("mozilla public license version 2 0", "mozilla public license 2 0"), "EPL-2.0": ("eclipse public license 2 0",),
    "CC-BY-4.0": ("creative commons attribution 4 0 international", "creative commons attribution 4 0 international license"),
    "CC-BY-SA-4.0": ("creative commons attribution sharealike 4 0 international", "creative commons attribution sharealike 4 0 international license"),
    "CC-BY-NC-4.0": ("creative commons attribution noncommercial 4 0 international", "creative commons attribution noncommercial 4 0 international license"),
    "CC-BY-ND-4.0": ("creative commons attribution noderivatives 4 0 international", "creative commons attribution noderivatives 4 0 international license"),
    "CC-BY-NC-SA-4.0": ("creative commons attribution noncommercial sharealike 4 0 international", "creative commons attribution noncommercial sharealike 4 0 international license"),
    "CC-BY-NC-ND-4.0": ("creative commons attribution noncommercial noderivatives 4 0 international", "creative commons attribution noncommercial noderivatives 4 0 international license"),
}
PUT_UNDER = ("licensed under the", "released under the", "distributed under the", "this work is licensed under the", "this work is licensed under a",
             "licensed under a", "this project is licensed under the", "this software is licensed under the")


def _named() -> tuple[dict[str, str], list[tuple[str, str, tuple[str, ...]]]]:
    """Sentences that put something under a license by its name, SPDX lines, and their rules of one identifier."""
    sentences: dict[str, str] = {}
    rules = []
    category = {name: kind for kind, names in SPDX.items() for name in names}

    def add(identifier: str, sentence: str, name: str) -> None:
        if sentence not in SENTENCES.values():
            sentences[identifier] = sentence
            rules.append((name, category[name], (identifier,)))

    for name in category:
        written = {name, name.removesuffix("-only")}
        for n, own in enumerate(sorted(written)):
            add(f"spdx-{name.lower()}-{n}", "spdx license identifier " + own.lower().replace("-", " ").replace(".", " "), name)
        for c, called in enumerate(CALLED.get(name, ())):
            for p, put in enumerate(PUT_UNDER):
                add(f"named-{name.lower()}-{c}-{p}", f"{put} {called}", name)
    return sentences, rules


_SENTENCES, _RULES = _named()
SENTENCES = SENTENCES | _SENTENCES
#: Rules of several identifiers, the longest first, are tried one after the other; then each identifier left may be one of a rule by itself.
SEVERAL = tuple(sorted((r for r in RULES if len(r[2]) > 1), key=lambda r: -len(r[2])))
ALONE = {rule[0]: f"{name} {category}" for name, category, rule in (*RULES, *_RULES) if len(rule) == 1}

# A text without any of these words holds no known sentence, however it is wrapped.
WRAPPED_HINT = "(?i)license|permi(t|ssion)|redistribut|warrant|unencumbered|rights[^a-z0-9]+reserved"
# Where sentences end for sure: stops ("4.0." ends one, "4.0" doesn't; "v. 2" neither) and blank lines.
HARD_END = r"(?<!\bv)[.!?](?=\s|\z)|\n[^a-z0-9\n]*+(?=\n)"
# Where they may end.
SOFT_END = r"[.;:](?=\s|\z)|[\r\n]"


def _marked(text: Column) -> Column:
    """Words of a text, parted by ``|`` at sure ends, else by ``/`` at possible ends, else by a space."""
    steps = ((r"(?<=[0-9])\+(?=\s|\z)", " or later"), (HARD_END, "|"), (SOFT_END, "/"), ("[^a-z0-9|/]+", " "), (r"(?<![ /])[ /]*+\|[ /|]*+", "|"), (" ?/[ /]*+", "/"))
    text = F.concat(F.lit("\n\n"), F.translate(F.lower(text), "|/", "~~"), F.lit("\n\n"))
    for pattern, mark in steps:
        text = F.regexp_replace(text, pattern, mark)
    return text


def alternatives(space: str) -> str:
    """A pattern of all known sentences, parted by their first words, the longest first; ``space`` is what may part two words."""
    by_first: dict[str, list[str]] = {}
    for sentence in sorted(SENTENCES.values(), key=len, reverse=True):
        first, rest = sentence.split(" ", 1)
        by_first.setdefault(first, []).append(rest.replace(" ", space))
    return "(?:" + "|".join(f"{first}{space}(?:{'|'.join(rests)})" for first, rests in by_first.items()) + ")"


def sentence_ids(text: Column) -> Column:
    """Places (from 1, in ``SENTENCES``) of the known sentences of a text, in order."""
    known = F.split(F.lit("|".join(SENTENCES.values())), r"\|")
    pattern = f"(?<=[|/]){alternatives('[ /]')}(?=[|/])"
    found = F.regexp_extract_all(_marked(text), F.lit(pattern), F.lit(0))
    places = F.transform(found, lambda s: F.array_position(known, F.translate(s, "/", " ")))
    return F.when(text.rlike(WRAPPED_HINT), places).otherwise(F.array().cast("array<bigint>"))


def _used_up(ids: Column, rule: tuple[str, ...]) -> tuple[str, Column]:
    """The pattern of a rule in a string of identifiers, and the string without its matches."""
    numbers = [list(SENTENCES).index(name) + 1 for name in rule]
    pattern = "".join(f",{n}," for n in numbers)
    return pattern, F.replace(ids, F.lit(pattern), F.lit(",0,"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_sentences, sentence_ids, licenses, categories)``, a row for every row of ``docs``.

    ``licenses`` and ``categories`` are sorted, distinct and comma-joined; empty where no rule matches.
    Null and empty texts hold no sentence. Repeated rows give equal results; null ids are kept; an
    empty table gives no rows. Other columns are not looked at.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), sentence_ids(F.coalesce(F.col(text_col), F.lit(""))).alias("ids"))
    names = F.split(F.lit("|".join(SENTENCES)), r"\|")
    own = own.select("doc_id", F.size("ids").cast("long").alias("n_sentences"),
                     F.array_join(F.transform("ids", lambda p: F.get(names, (p - 1).cast("int"))), ",").alias("sentence_ids"),
                     F.concat(F.lit(","), F.array_join(F.col("ids").cast("array<string>"), ",,"), F.lit(",")).alias("left"))
    # Texts without known sentences (nearly all) skip the rules.
    found, left = F.array().cast("array<string>"), F.col("left")
    for name, category, rule in SEVERAL:
        pattern, rest = _used_up(left, rule)
        found = F.concat(found, F.when(F.instr(left, pattern) > 0, F.array(F.lit(f"{name} {category}"))).otherwise(F.array()))
        left = rest
    by_itself = F.split(F.lit("|".join(ALONE.get(n, "") for n in SENTENCES)), r"\|")
    alone = F.transform(F.regexp_extract_all(left, F.lit("[1-9][0-9]*"), F.lit(0)), lambda p: F.get(by_itself, p.cast("int") - 1))
    found = F.concat(found, F.filter(alone, lambda f: f != ""))
    matches = F.when(F.col("n_sentences") > 0, found).otherwise(F.array().cast("array<string>"))
    return own.select("doc_id", "n_sentences", "sentence_ids", matches.alias("found")).select(
        "doc_id", "n_sentences", "sentence_ids",
        F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda f: F.split_part(f, F.lit(" "), F.lit(1))))), ",").alias("licenses"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda f: F.split_part(f, F.lit(" "), F.lit(2))))), ",").alias("categories"))
