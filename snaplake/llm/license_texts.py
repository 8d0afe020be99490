"""Notices, headers and whole texts of public licenses, by SPDX identifier, and the words that tell them apart."""

from __future__ import annotations

_NO_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
)
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def _gnu(name: str, version: str) -> list[str]:
    """The notice and the header of a license of the GNU family."""
    return [
        f"This work is licensed under the GNU {name}, version {version}.",
        f"Licensed under the GNU {name}, version {version}.",
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software "
        f"Foundation, either version {version} of the License, or (at your option) any later version.",
    ]


def _creative_commons(short: str, name: str) -> list[str]:
    return [f"Licensed under CC {short} 4.0.", f"This work is licensed under a Creative Commons {name} 4.0 International License."]


#: Notices and headers: the words of ``NAMES`` and the version numbers in them must agree.
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain '
        "a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See '
        "the License for the specific language governing permissions and limitations under the License.",
    ],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "The MIT License (MIT)"],
    "GPL-3.0": _gnu("General Public License", "3"),
    "GPL-2.0": _gnu("General Public License", "2"),
    "LGPL-3.0": _gnu("Lesser General Public License", "3"),
    "LGPL-2.1": _gnu("Lesser General Public License", "2.1"),
    "AGPL-3.0": _gnu("Affero General Public License", "3"),
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at https://mozilla.org/MPL/2.0/",
    ],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.", "Licensed under the BSD 2-Clause License."],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", "Licensed under the BSD 3-Clause License."],
    "ISC": ["Released under the ISC License.", "Licensed under the ISC License."],
    "Zlib": ["Released under the Zlib License.", "Licensed under the Zlib License."],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0."],
    "CC-BY-4.0": _creative_commons("BY", "Attribution"),
    "CC-BY-SA-4.0": _creative_commons("BY-SA", "Attribution-ShareAlike"),
    "CC-BY-NC-4.0": _creative_commons("BY-NC", "Attribution-NonCommercial"),
    "CC-BY-ND-4.0": _creative_commons("BY-ND", "Attribution-NoDerivatives"),
    "CC-BY-NC-SA-4.0": _creative_commons("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    "CC-BY-NC-ND-4.0": _creative_commons("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    "CC0-1.0": ["Released under CC0 1.0 Universal."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Proprietary": ["All rights reserved."],
}
#: Whole texts, which seldom name the license and whose clauses may be numbered or not.
TEXTS = {
    "MIT": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n"
        + _NO_WARRANTY
        + " IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ],
    "BSD-2-Clause": [_BSD + _BSD_END],
    "BSD-3-Clause": [_BSD + _BSD_THIRD + _BSD_END],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from "
        "the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
        "and redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim "
        "that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but "
        "is not required.\n\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n\n"
        "3. This notice may not be removed or altered from any source distribution."
    ],
    "BSL-1.0": [
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by "
        'this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the '
        "Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following"
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute "
        "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ],
}
#: Names and variants of licenses, those without a template too: a notice that has another of them is another license's.
NAMES = frozenset(
    """mit apache gnu lesser affero library gpl lgpl agpl mozilla mpl bsd isc zlib boost artistic eclipse cddl epl eupl cc cc0 unlicense wtfpl
    2-clause 3-clause 4-clause 0bsd by-sa by-nc by-nd by-nc-sa by-nc-nd attribution attribution-sharealike attribution-noncommercial
    attribution-noderivatives attribution-noncommercial-sharealike attribution-noncommercial-noderivatives""".split()
)
#: Every notice and text above has at least one of these.
CUES = (
    "licens", "copyright", "rights reserved", "public domain", "creative commons", "released under", "subject to the terms", "hereby granted", "as-is",
    "distributed under",
)
