"""Sentence rules: sequences, order of the rules, odd rows."""
import textwrap

from llm_cases import clash, documents, frame

from ontime_spark.llm import license_rules as R

MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
       "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
       "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
       "is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be "
       "included in all copies or substantial portions of the Software.")


def test_sequences_and_order(spark):
    rows = [(1, "Some text.\nReleased under the MIT License.\nMore."), (2, "ALL RIGHTS   RESERVED! Licensed under the Apache License, Version 2.0."),
            (3, MIT), (4, MIT.split("\n\n")[1] + "\n" + MIT.split("\n\n")[0]), (5, "It was released under the MIT License."),
            (6, "This work is licensed under the GNU General Public License, version 3.\nAll rights reserved."),
            (7, "licensed under cc by-nc 4.0"), (8, "We kept all rights reserved for us."), (9, None), (10, ""),
            (11, "All rights reserved. " * 500)]
    out, r = R.identified(clash(frame(spark, rows)))
    got = {x.doc_id: (x[r].licence, list(x[r].sentences)) for x in out.collect()}
    assert got[1] == ("MIT", ["mit-short"])
    assert got[2] == ("Apache-2.0", ["rights", "apache2-short"])
    assert got[3] == ("MIT", ["mit-grant", "mit-notice"])
    assert got[4] == (None, ["mit-notice", "mit-grant"])
    assert got[5] == (None, []) and got[8] == (None, [])
    assert got[6] == ("GPL-3.0", ["gpl3-short", "rights"])
    assert got[7] == ("CC-BY-NC-4.0", ["cc-by-nc4-short"])
    assert got[9] == got[10] == (None, []) and len(got[11][1]) == 500


def test_odd_rows_and_empty_table(spark):
    rows = documents()
    out, r = R.identified(frame(spark, rows))
    assert out.where(f"{r}.rule > 0").count() == 0 and out.count() == len(rows)
    assert R.identified(frame(spark, []))[0].count() == 0


def test_rules_use_known_identifiers():
    known = {i for i, _ in R.SENTENCES}
    assert all(set(ids) <= known for _, ids in R.RULES)
    assert len(known) == len(R.SENTENCES) == len({t for _, t in R.SENTENCES})


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE"""


def test_standard_headers_wrapped_and_on_one_line(spark):
    wrapped_mit = "\n\n".join(textwrap.fill(p, 72) for p in MIT.split("\n\n")) + "\n\n" + WARRANTY
    headers = {"Apache-2.0": (APACHE, ["apache2-grant", "apache2-comply", "apache2-copy", "apache2-warranty"]),
               "GPL-3.0-or-later": (GPL, ["gpl-free", "gpl-hope", "gpl-copy"]), "MPL-2.0": (MPL, ["mpl2"]),
               "MIT": (wrapped_mit, ["mit-grant", "mit-notice", "mit-warranty"])}
    forms = [lambda t: t, lambda t: " ".join(t.split()), lambda t: t.replace("\n", "\r\n"),
             lambda t: "/*\n" + "\n".join(f" * {x}".rstrip() for x in t.split("\n")) + "\n */\nint main;",
             lambda t: "Intro of it.\n" + "\n".join(textwrap.wrap(" ".join(t.split()), 31, break_long_words=False, break_on_hyphens=False)) + "\nMore."]
    rows = [(i, form(text)) for i, (text, form) in enumerate((t, f) for t, _ in headers.values() for f in forms)]
    want = [(licence, ids) for licence, (_, ids) in headers.items() for _ in forms]
    # On one line no mark stands between the address and the sentence after it.
    want[1] = ("Apache-2.0", ["apache2-grant", "apache2-comply"])
    out, r = R.identified(frame(spark, rows))
    got = {x.doc_id: (x[r].licence, list(x[r].sentences)) for x in out.collect()}
    assert [got[i] for i in range(len(rows))] == want


def test_every_wording_can_be_reached(spark):
    rows = [(i, f"Before it.\n{t}\n\nafter it") for i, (_, t) in enumerate(R.SENTENCES)]
    out, r = R.identified(frame(spark, rows))
    assert {x.doc_id: list(x[r].sentences) for x in out.collect()} == {i: [k] for i, (k, _) in enumerate(R.SENTENCES)}


def test_sentence_ends_and_runs(spark):
    rows = [(1, "All rights. Reserved."), (2, "all rights\nreserved"), (3, "\n" * 100000 + "All rights reserved"),
            (4, "; " * 50000 + "all rights reserved"), (5, "日" * 100000 + " reserved\nAll\n\nrights: reserved!"),
            (6, "Licensed under the Apache License, Version 2.0\n(the \"License\"); more")]
    out, r = R.identified(frame(spark, rows))
    got = {x.doc_id: list(x[r].sentences) for x in out.collect()}
    assert got == {1: [], 2: ["rights"], 3: ["rights"], 4: ["rights"], 5: ["rights"], 6: ["apache2-grant"]}


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
THIRD = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""


def test_further_licences_titles_and_grants(spark):
    cases = [(BSD, "BSD-2-Clause"), (BSD + THIRD, "BSD-3-Clause"), ("BSD 3-Clause License\n\n" + BSD + THIRD, "BSD-3-Clause"), (ISC, "ISC"),
             (GPL.replace("version 3", "version 2"), "GPL-2.0-or-later"), (GPL.replace("GNU General", "GNU Affero General"), "AGPL-3.0-or-later"),
             (GPL.replace("This program is free", "This library is free").replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1"), "LGPL-2.1-or-later"),
             ("# SPDX-License-Identifier: Apache-2.0\nimport os", "Apache-2.0"), ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0-or-later"),
             ("MIT License\n\nCopyright (c) 2020 A", "MIT"), ("We like it. This project is licensed under the MIT License. See it.", "MIT"),
             ("This software is distributed under the Apache License, Version 2.0.", "Apache-2.0"), ("Licensed under the Apache License 2.0", "Apache-2.0"),
             ("This is free and unencumbered software released into the public domain.", "Unlicense"),
             ("This project is all rights reserved.", None), ("The MIT License is short to read.", None), ("We had a MIT license in mind", None)]
    out, r = R.identified(frame(spark, [(i, t) for i, (t, _) in enumerate(cases)]))
    got = {x.doc_id: x[r].licence for x in out.collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}


def test_statement_has_the_current_splitting(spark, tmp_dir):
    """The DuckDB statement on wrapped, commented and one-line notices."""
    import duckdb
    texts = [APACHE, GPL, MPL, BSD + THIRD, ISC, " ".join(APACHE.split()), "\n".join(f" * {x}" for x in GPL.split("\n")), MIT,
             "This project is licensed under the MIT License. All rights reserved.", "All rights. Reserved", "; " * 50 + "all rights\nreserved!", None, ""]
    df = frame(spark, list(enumerate(texts)))
    df.write.parquet(f"{tmp_dir}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_dir}/documents.parquet/*.parquet')")
    want = sorted(con.execute(R.SQL["op9_license_scan"]).fetchall())
    assert sorted(tuple(r) for r in R.op9_license_scan(spark, tmp_dir).collect()) == want and sum(w[1] > 0 for w in want) == 10
