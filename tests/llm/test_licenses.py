"""Licence scan on notices and edge cases; the whole table is compared with SQL."""

from __future__ import annotations

from plumbline.llm import licenses


def scan(spark, texts, **options):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, status string")
    rows = {r.doc_id: (r.sentence_ids, r.licenses, r.status) for r in licenses.recognise(df, **options).collect()}
    return [rows[i] for i in range(len(texts))]


def test_notices(spark):
    got = scan(spark, [
        "Prose. Released under the MIT License.",
        "LICENSED under the Apache License,\tVersion 2.0!\nmore",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "All rights reserved. The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
        "not released under the MIT License. nothing",
    ])
    assert [(x[1], x[2]) for x in got] == [
        (["MIT"], "recognised"), (["Apache-2.0"], "recognised"), (["GPL-3.0-only"], "recognised"),
        (["CC-BY-NC-4.0", "MIT"], "recognised"), (["Apache-2.0"], "recognised"), (["LicenseRef-Proprietary"], "unclear"), ([], "none")]
    assert got[4][0] == ["apache_the_license", "apache_comply"]


def test_order_of_rules(spark):
    known, rules = {"a": "license a", "b": "license b"}, [(("a", "b"), "AB"), (("b", "a"), "BA"), (("a",), "A")]
    got = scan(spark, ["License A. License B.", "license b\nlicense a", "license a\nlicense a", "license b"], known=known, rules=rules)
    assert got == [(["a", "b"], ["AB"], "recognised"), (["b", "a"], ["BA"], "recognised"), (["a", "a"], ["A"], "recognised"), (["b"], [], "unclear")]


def test_edges(spark):
    long = "word " * 200_000 + ". Released under the MIT License. " + "tail " * 1000
    got = scan(spark, [None, "", ".", "  \n\n", long, "Released under the MIT License"] )
    assert [x[2] for x in got] == ["none"] * 4 + ["recognised"] * 2
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.recognise(empty).count() == 0
    twice = spark.createDataFrame([(1, "All rights reserved."), (1, "All rights reserved."), (None, None)], "doc_id long, text string")
    assert licenses.recognise(twice).count() == 3


def test_every_known_sentence_has_the_hint(spark):
    df = spark.createDataFrame(list(enumerate(licenses.SENTENCES.values())), "doc_id long, text string")
    assert df.filter(~df.text.rlike(licenses.HINT)).count() == 0
    assert {r.text for r in df.select(licenses.normalised(df.text).alias("text")).collect()} == set(licenses.SENTENCES.values())
    assert all(r.sentence_ids for r in licenses.recognise(df).collect())


WRAPPED = {
    "MIT": (
        """Copyright (c) 2020 Someone

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
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.""", ["mit_grant", "mit_notice", "as_is"]),
    "BSD-3-Clause": (
        """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.""", ["bsd_redistribute", "bsd_source", "bsd_binary", "bsd_endorse"]),
    "Apache-2.0": (
        """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software""", ["apache_the_license", "apache_comply", "apache_obtain"]),
    "GPL-3.0-or-later": (
        """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.""", ["gpl_free", "gpl_hope"]),
    "GPL-2.0-or-later": (
        """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version.""", ["gpl2_free"]),
    "MPL-2.0": (
        """This Source Code Form is subject to the terms of the Mozilla Public License, v.
2.0. If a copy of the MPL was not distributed with this file""", ["mpl2"]),
    "LicenseRef-Proprietary": ("Some Company. All rights\nreserved.", ["reserved"]),
}

# Further published notices, wrapped as they usually come.
MORE_WRAPPED = {
    "BSD-2-Clause": ("""Copyright (c) 2019, Someone
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
""", ["reserved", "bsd_redistribute", "bsd_source", "bsd_binary"]),
    "ISC": ("""Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
""", ["isc_grant"]),
    "LGPL-2.1-or-later": ("""This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details.
""", ["lgpl21_free", "lgpl_hope"]),
    "LGPL-3.0-or-later": ("""This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Lesser General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
""", ["lgpl3_free"]),
    "AGPL-3.0-or-later": ("""This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU Affero General Public License for more details.
""", ["agpl3_free", "gpl_hope"]),
    "EPL-2.0": ("""This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/
""", ["epl2_available"]),
    "BSL-1.0": ("""Distributed under the Boost Software License,
Version 1.0. (See accompanying file LICENSE_1_0.txt)
""", ["boost_distributed"]),
    "Zlib": ("""Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
""", ["zlib_grant"]),
    "Unlicense": ("""This is free and unencumbered software released into the
public domain.
""", ["unlicense_free"]),
}


def test_further_notices(spark):
    expected = [(ids, [name], "recognised") for name, (_, ids) in MORE_WRAPPED.items()]
    texts = [text for text, _ in MORE_WRAPPED.values()]
    assert scan(spark, texts) == expected
    assert scan(spark, ["# " + t.replace("\n", "\n# ") for t in texts]) == expected


def test_reserved_rights_name_no_licence_beside_another(spark):
    both = "All rights reserved.\n" + WRAPPED["MIT"][0]
    assert scan(spark, [both, "All rights reserved.", "All rights reserved. Released under the MIT license."]) == [
        (["reserved", "mit_grant", "mit_notice", "as_is"], ["MIT"], "recognised"),
        (["reserved"], ["LicenseRef-Proprietary"], "recognised"),
        (["reserved", "mit_released"], ["MIT"], "recognised"),
    ]


def test_wrapped_notices(spark):
    texts = [text for text, _ in WRAPPED.values()]
    expected = [(ids, [name], "recognised") for name, (_, ids) in WRAPPED.items()]
    assert scan(spark, texts) == expected
    for mark in ("# ", " * ", "// ", ";; ", "! ", ".. "):
        assert scan(spark, [mark + t.replace("\n", "\n" + mark) for t in texts]) == expected
    assert scan(spark, [t.replace("\n", "\r\n") for t in texts]) == expected
    # On one line, the marks inside sentences stay.
    assert scan(spark, [" ".join(t.split()) for t in texts[-4:]]) == expected[-4:]


def test_sentences_do_not_go_on_beyond_full_stops(spark):
    got = scan(spark, ["Released under the MIT.\nLicense or not.", "released under\nthe MIT license or not", "All rights! Reserved",
                       "license a;\nlicense b", "x license a. y"], known=None)
    assert [x[2] for x in got] == ["none"] * 5
    known, rules = {"a": "license a", "ab": "license a license b"}, [(("ab",), "AB"), (("a",), "A")]
    got = scan(spark, ["license a;\nlicense b", "license a.\nlicense b", "... " * 100_000 + "license a"], known=known, rules=rules)
    assert [x[0] for x in got] == [["ab"], ["a"], ["a"]]
