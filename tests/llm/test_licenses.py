"""Sentence rules, the DuckDB statement, and edge cases."""

import duckdb
import pytest

from tidemark.llm import license_scan as ls
from tidemark.llm.queries import ORACLE_SQL, QUERIES

from .conftest import SF

MIT = [ls.SENTENCES[k] for k in ("mit-grant", "mit-notice", "mit-warranty")]


def scan(df):
    return {r.doc_id: (r.n_sentences, r.licenses, r.categories) for r in ls.scan_licenses(df).collect()}


@pytest.mark.parametrize("text, want", [
    (None, (0, "", "")), ("", (0, "", "")), ("license", (0, "", "")),
    ("Licensed under the Apache License, Version 2.0.", (1, "Apache-2.0", "permissive")),
    ("Intro. LICENSED under CC BY-NC 4.0.\nAll rights reserved.", (2, "CC-BY-NC-4.0,all-rights-reserved", "noncommercial,proprietary")),
    (".\n".join(MIT), (3, "MIT", "permissive")), (f"{MIT[0]}. Some words. {MIT[1]}. More. {MIT[2]}!", (3, "MIT", "permissive")),
    (f"{MIT[1]}. {MIT[2]}", (2, "", "")), ("Released under the MIT License. " * 3000, (3000, "MIT", "permissive")),
    ("not released under the MIT license", (0, "", ""))])
def test_texts(documents, text, want):
    assert scan(documents([(1, text)])) == {1: want}


def test_longest_rule_first_and_used_once(documents):
    parts = [ls.SENTENCES[k] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")]
    got = scan(documents([(1, ". ".join(parts)), (2, ". ".join(parts[:3])), (3, ". ".join(parts[:3] + parts))]))
    assert {k: v[1] for k, v in got.items()} == {1: "BSD-3-Clause", 2: "BSD-2-Clause", 3: "BSD-2-Clause,BSD-3-Clause"}


def test_repeated_rows_null_ids_and_empty_table(documents):
    rows = ls.scan_licenses(documents([(None, "All rights reserved.")] * 2 + [(1, "x")])).collect()
    assert sorted(r.licenses for r in rows) == ["", "all-rights-reserved", "all-rights-reserved"]
    assert ls.scan_licenses(documents([])).count() == 0


# License headers as they are published: fixed values.
MIT_TEXT = """Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE FOR ANY CLAIM."""
BSD_TEXT = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
GPL_TEXT = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
APACHE_TEXT = """Licensed under the Apache License, Version 2.0 (the
"License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
MPL_TEXT = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this file, look elsewhere."""
GPL2_TEXT = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
LGPL_TEXT = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details."""
AGPL_TEXT = GPL_TEXT.replace("GNU General Public License as", "GNU Affero General Public License as")
ISC_TEXT = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE."""
ZERO_TEXT = ISC_TEXT.replace(""", provided that the above
copyright notice and this permission notice appear in all copies""", "")
ZLIB_TEXT = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:"""
UNLICENSE_TEXT = """This is free and unencumbered software released
into the public domain."""
EPL_TEXT = """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/"""
EPL1_TEXT = """All rights reserved. This program and the accompanying materials
are made available under the terms of the Eclipse Public License v1.0
which accompanies this distribution, and is available at
http://www.eclipse.org/legal/epl-v10.html"""
CC_TEXT = """This work is licensed under a Creative Commons
Attribution-NonCommercial-ShareAlike 4.0 International License."""
WRAPPED = [(GPL2_TEXT, (2, "GPL-2.0-or-later", "copyleft")), (LGPL_TEXT, (2, "LGPL-2.1-or-later", "copyleft")), (AGPL_TEXT, (2, "AGPL-3.0-or-later", "copyleft")),
           (ISC_TEXT, (2, "ISC", "permissive")), (ZERO_TEXT, (2, "0BSD", "permissive")), (ZLIB_TEXT, (2, "Zlib", "permissive")),
           (UNLICENSE_TEXT, (1, "Unlicense", "permissive")), (EPL_TEXT, (1, "EPL-2.0", "copyleft")),
           (EPL1_TEXT, (2, "EPL-1.0,all-rights-reserved", "copyleft,proprietary")), (CC_TEXT, (1, "CC-BY-NC-SA-4.0", "noncommercial")),
           ("Licensed under the\nMozilla Public License 2.0", (1, "MPL-2.0", "copyleft")),
           (MIT_TEXT, (3, "MIT", "permissive")), (BSD_TEXT, (4, "BSD-3-Clause", "permissive")), (GPL_TEXT, (2, "GPL-3.0-or-later", "copyleft")),
           (APACHE_TEXT, (4, "Apache-2.0", "permissive")), (MPL_TEXT, (1, "MPL-2.0", "copyleft")),
           ("All rights\nreserved", (1, "all-rights-reserved", "proprietary"))]


@pytest.mark.parametrize("mark, end", [("", "\n"), ("# ", "\n"), (" * ", "\r\n"), ("// ", " \n")])
def test_wrapped_headers(documents, mark, end):
    rows = [(k, end.join(f"{mark}{line}" for line in text.split("\n"))) for k, (text, _) in enumerate(WRAPPED)]
    assert scan(documents(rows)) == {k: want for k, (_, want) in enumerate(WRAPPED)}


@pytest.mark.parametrize("text, n", [
    ("Released under\n\nthe MIT license", 0), ("Released under\n#\n# the MIT license", 0), ("All rights. Reserved", 0),
    ("Title\nreleased under the MIT license\nmore words", 1), ("All rights  reserved", 1), ("All/rights|reserved", 1),
    (": " * 50_000 + "\n - " * 50_000 + "all rights\n*reserved", 1)])
def test_ends_of_sentences(documents, text, n):
    assert scan(documents([(1, text)]))[1][0] == n


@pytest.mark.parametrize("line, want", [
    ("SPDX-License-Identifier: MIT", "MIT"), ("/* SPDX-License-Identifier: GPL-2.0 */", "GPL-2.0-only"), ("// SPDX-License-Identifier: GPL-2.0+", "GPL-2.0-or-later"),
    ("# SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1-or-later"), ("SPDX-License-Identifier:BSD-3-Clause\r", "BSD-3-Clause"),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", ""), ("see SPDX-License-Identifier: MIT", "")])
def test_spdx_lines(documents, line, want):
    assert scan(documents([(1, f"{line}\nint x;\n")]))[1][1] == want


def test_every_known_sentence_has_its_own_place():
    assert len(set(ls.SENTENCES.values())) == len(ls.SENTENCES)
    assert {i for *_, rule in ls.RULES for i in rule} | set(ls.ALONE) <= set(ls.SENTENCES)


def test_statement_joins_wrapped_lines(documents):
    texts = [end.join(f"{mark}{line}" for line in text.split("\n")) for text, _ in WRAPPED for mark, end in (("", "\n"), ("# ", "\n"), (" * ", "\r\n"))]
    texts += [None, "", "released under\n\nthe MIT license", "released under\n#\n# the MIT license", "All rights. Reserved", "all rights reserved", "All/rights|reserved? Yes",
              "x; all rights reserved: released under the MIT license! SPDX-License-Identifier: Apache-2.0\n", "Uses v. 2.\nSPDX-License-Identifier: GPL-2.0+ ", ". ".join(ls.SENTENCES.values())]
    docs = documents(list(enumerate(texts)))
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    got = ls.scan_licenses(docs)
    assert sorted(map(tuple, got.collect())) == sorted(con.sql(ORACLE_SQL["op5_license_scan"]).select(*got.columns).fetchall())


def test_query_against_duckdb(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    got = QUERIES["op5_license_scan"](spark, SF)
    want = con.sql(ORACLE_SQL["op5_license_scan"])
    at = [want.columns.index(c) for c in got.columns]
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r[k] for k in at) for r in want.fetchall())
