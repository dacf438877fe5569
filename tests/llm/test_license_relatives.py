import pytest

from test_license import names
from rosterkeep.llm import license_scan

CASES = [
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "CC-BY-NC-4.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "CC-BY-ND-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License.", "CC-BY-NC-SA-3.0"),
    ("Licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-ND-4.0"),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
]


def test_relatives(spark):
    rows = [(i * 10 + k, "word " * k + notice + " more" * k) for i, (notice, _) in enumerate(CASES) for k in range(3)]
    assert {i: got for i, got in names(spark, rows)} == {i * 10 + k: {want} for i, (_, want) in enumerate(CASES) for k in range(3)}


def test_unlisted_relatives_are_not_taken_for_listed_ones(spark):
    rows = [(1, "This work is licensed under the GNU General Public License, version 1."), (2, "Released under the Foo License."), (3, "Licensed under the Apache License, Version 9.9")]
    assert names(spark, rows) == [(1, set()), (2, set()), (3, set())]


@pytest.mark.parametrize("gnu", ["General", "Lesser General", "Affero General"])
def test_long_notices(spark, gnu):
    text = license_scan.TEMPLATES[7][1].replace("General", gnu)
    assert names(spark, [(1, text)]) == [(1, {{"G": "GPL", "L": "LGPL", "A": "AGPL"}[gnu[0]] + "-3.0"})]
