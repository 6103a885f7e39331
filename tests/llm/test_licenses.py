"""Licence texts of many holders, short forms and SPDX expressions."""

import textwrap

import pytest

from sitelattice.llm import licenses

HOLDERS = ["Example Inc.", "the University of Nowhere", "ACME Corp.", "Jane Q. Public", "The Foo Project Authors", "Müller & Söhne GmbH", "Big Co. Ltd.", "the copyright holder", "Foo, Bar and Baz", "example.org"]
_BSD = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
]
_ENDORSE = "3. Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_ENDORSE_SHORT = "3. The name of {} may not be used to endorse or promote products derived from this software without specific prior written permission."
_AS_IS = 'THIS SOFTWARE IS PROVIDED BY {} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.'
_MIT = [
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
]
_ISC = ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."]
TEXTS = {
    "MIT": ["Copyright (c) 2020 {}", *_MIT], "ISC": ["Copyright (c) 2020 {}", *_ISC], "BSD-2-Clause": ["Copyright (c) 2020, {}", *_BSD, _AS_IS],
    "BSD-3-Clause": ["Copyright (c) 2020, {}", *_BSD, _ENDORSE, _AS_IS], "BSD-3-Clause short": ["Copyright (c) 2020, {}", *_BSD, _ENDORSE_SHORT, _AS_IS],
}


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["licences"] for r in licenses.scan(docs).orderBy("doc_id").collect()]


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_other_holders(spark, name):
    """Never a wrong licence; the right one for every holder, wrapped and with comment marks."""
    plain = ["\n\n".join(p.format(h.upper() if p is _AS_IS else h) for p in TEXTS[name]) for h in HOLDERS]
    wrapped = ["\n\n".join(textwrap.fill(p, 76) for p in t.split("\n\n")) for t in plain]
    marked = ["\n".join(f" * {line}".rstrip() for line in t.split("\n")) for t in wrapped]
    got = found(spark, plain + wrapped + marked)
    assert all(g in ([name.split(" ")[0]], []) for g in got), [(t[:40], g) for t, g in zip(plain * 3, got, strict=True) if g not in ([name.split(" ")[0]], [])][:3]
    assert sum(map(bool, got)) == len(got), [t for t, g in zip(plain + wrapped + marked, got, strict=True) if not g][:2]


def test_short_forms(spark):
    said = {
        "The code is MIT licensed.": ["MIT"], "License: Apache 2.0": ["Apache-2.0"], "Licensed under the MIT license (see LICENSE).": ["MIT"], "Apache License\n   Version 2.0, January 2004\n": ["Apache-2.0"],
        "license: bsd 3-clause": ["BSD-3-Clause"], "Our license counter is MIT made.": [], "A licensed driver.": [], "This project is ISC licensed!": ["ISC"],
    }
    assert found(spark, list(said)) == list(said.values())


def test_spdx_expressions(spark):
    said = {
        "MIT": ["MIT"], "MIT OR Apache-2.0": ["Apache-2.0", "MIT"], "GPL-2.0+": ["GPL-2.0-or-later"], "(LGPL-2.1-only OR MIT) AND BSD-3-Clause": ["BSD-3-Clause", "LGPL-2.1-only", "MIT"],
        "GPL-2.0-only WITH Classpath-exception-2.0 OR MIT": ["GPL-2.0-only", "MIT"], "Apache-2.0 */ int x": [], "": [],
    }
    got = found(spark, [f"// SPDX-License-Identifier: {e}\nint x;" for e in said])
    assert got[:5] == list(said.values())[:5] and got[5][:1] in ([], ["Apache-2.0"]) and got[6] == []
    assert found(spark, ["# SPDX-License-Identifier: MIT\n# SPDX-License-Identifier: ISC", None]) == [["ISC", "MIT"], []]
