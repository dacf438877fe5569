from test_license import names

CASES = [
    ("Licensed under the MIT License", "MIT"),
    ("Distributed under the MIT License", "MIT"),
    ("SPDX-License-Identifier: MIT", "MIT"),
    ("This file is released under the ISC License, see there", "ISC"),
    ("It can be used under the terms of the Eclipse Public License v2.0 as given", "EPL-2.0"),
    ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.", "Unlicense"),
]


def test_notices_beside_the_templates(spark):
    rows = [(i * 10 + k, "word " * k + notice + " more" * k) for i, (notice, _) in enumerate(CASES) for k in range(3)]
    assert {i: got for i, got in names(spark, rows)} == {i * 10 + k: {want} for i, (_, want) in enumerate(CASES) for k in range(3)}
