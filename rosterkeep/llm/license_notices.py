"""Notices of usual licenses beside those of ``license_scan.TEMPLATES``: a bounded list, of the following forms.

- ``under the NAME`` and its like for licenses with a name of three words or more, with every version listed; ``licensed
  under the NAME`` and its like for shorter names; the SPDX line.
- The full sentence and the short form of Creative Commons licenses, for six kinds and four versions, and CC0.
- The notice that the license itself asks for (GNU licenses, MPL).
- The whole body of MIT; the grant of ISC, Zlib, BSL-1.0 and Unlicense, and the third clause of BSD-3-Clause.

The bodies of licenses of thousands of words (Apache, GNU, MPL, EPL, CC legal code) are not templates; their copies are found
only where they hold one of the forms above.
"""

from __future__ import annotations

_GNU = {"GPL": "General Public License", "LGPL": "Lesser General Public License", "AGPL": "Affero General Public License"}
_VERSIONS = {"GPL": ("2", "3"), "LGPL": ("2.1", "3"), "AGPL": ("3",)}
_NAMED = {
    "Apache-2.0": ("Apache License 2.0", "Apache License, Version 2.0", "Apache 2.0 License", "Apache License v2.0"),
    "Apache-1.1": ("Apache License 1.1", "Apache License, Version 1.1"),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0"),
    "MPL-1.1": ("Mozilla Public License 1.1", "Mozilla Public License, version 1.1", "Mozilla Public License, v. 1.1"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License, version 2.0", "Eclipse Public License v. 2.0"),
    "EPL-1.0": ("Eclipse Public License 1.0", "Eclipse Public License v1.0", "Eclipse Public License, version 1.0", "Eclipse Public License v. 1.0"),
    "BSL-1.0": ("Boost Software License 1.0", "Boost Software License, Version 1.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License"),
}
_SHORT_NAMED = {"MIT": ("MIT License", "MIT Licence"), "ISC": ("ISC License",), "BSD": ("BSD License",), "Zlib": ("zlib License",), "Unlicense": ("Unlicense",)}
_SHORT_FORMS = ("licensed under the", "released under the", "distributed under the", "available under the", "published under the", "provided under the", "under the terms of the", "subject to the")
_CC = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_CC_VERSIONS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic"}


def _notices():
    for kind, name in _GNU.items():
        for version in _VERSIONS[kind]:
            license = f"{kind}-{version if '.' in version else version + '.0'}"
            for form in (f", version {version}", f" version {version}.0", f" v{version}", f" v{version}.0"):
                yield license, f"under the GNU {name}{form}"
            yield license, f"This work is licensed under the GNU {name}, version {version}."
            what = "library" if license == "LGPL-2.1" else "program"
            yield license, (
                f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as "
                f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
            )
            for tail in ("only", "or later"):
                yield license, f"SPDX-License-Identifier: {license} {tail}"
    for license, names in _NAMED.items():
        for name in names:
            yield license, f"under the {name}"
        yield license, f"SPDX-License-Identifier: {license}"
    for license, names in _SHORT_NAMED.items():
        for name in names:
            for form in _SHORT_FORMS:
                yield license, f"{form} {name}"
    for license in ("MIT", "ISC", "Zlib", "Unlicense"):
        yield license, f"SPDX-License-Identifier: {license}"
    for kind, name in _CC.items():
        for version, place in _CC_VERSIONS.items():
            license = f"CC-{kind}-{version}"
            yield license, f"This work is licensed under a Creative Commons {name} {version} {place} License."
            yield license, f"under a Creative Commons {name} {version} License"
            yield license, f"under the Creative Commons {name} {version}"
            yield license, f"Licensed under CC {kind} {version}."
            yield license, f"SPDX-License-Identifier: {license}"
    yield "CC0-1.0", "under the Creative Commons CC0 1.0 Universal"
    yield "CC0-1.0", "has waived all copyright and related or neighboring rights"
    yield "CC0-1.0", "SPDX-License-Identifier: CC0-1.0"
    yield "CC0-1.0", "dedicated to the public domain under CC0 1.0"


_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '

_BODIES = (
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS +
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
        "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
    ),
    (
        "Zlib",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter "
        "it and redistribute it freely, subject to the following restrictions:",
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, "
        "and transmit the Software",
    ),
)

NOTICES = (*_notices(), *_BODIES)
