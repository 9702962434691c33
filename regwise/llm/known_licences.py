"""Known licences: published wordings of short licences and notices, and digests of long ones."""

from __future__ import annotations

# Licences in their published wording.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_REDISTRIBUTION = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BINARY = ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
           "and/or other materials provided with the distribution.")
_NO_ENDORSEMENT = ("Neither the name of {name} nor the names of its contributors may be used to endorse or promote products derived from this software without "
                   "specific prior written permission.")
_ADVERTISING = ("All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software "
                "developed by the University of California, Berkeley and its contributors.")
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY {by} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL {liable} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_HOLDERS = {"by": "THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "liable": "THE COPYRIGHT HOLDER OR CONTRIBUTORS"}
_REGENTS = {"by": "THE REGENTS AND CONTRIBUTORS", "liable": "THE REGENTS OR CONTRIBUTORS"}
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <http://unlicense.org/>"""
BOOST = """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
POSTGRESQL = """Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies.

IN NO EVENT SHALL THE UNIVERSITY OF CALIFORNIA BE LIABLE TO ANY PARTY FOR DIRECT, INDIRECT, SPECIAL, INCIDENTAL, OR CONSEQUENTIAL DAMAGES, INCLUDING LOST PROFITS, ARISING OUT OF THE USE OF THIS SOFTWARE AND ITS DOCUMENTATION, EVEN IF THE UNIVERSITY OF CALIFORNIA HAS BEEN ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.

THE UNIVERSITY OF CALIFORNIA SPECIFICALLY DISCLAIMS ANY WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE. THE SOFTWARE PROVIDED HEREUNDER IS ON AN "AS IS" BASIS, AND THE UNIVERSITY OF CALIFORNIA HAS NO OBLIGATIONS TO PROVIDE MAINTENANCE, SUPPORT, UPDATES, ENHANCEMENTS, OR MODIFICATIONS."""
WTFPL = """DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
Version 2, December 2004

Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.

DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION

0. You just DO WHAT THE FUCK YOU WANT TO."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""
_GNU_NOTICE = """This program is free software{colon} you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details.

You should have received a copy of the {name} along with this program. If not, see <https://www.gnu.org/licenses/>."""
# id, name, versions with the ending that a bare version has
GNU = (("GPL", "GNU General Public License", ("1", "2", "3")), ("LGPL", "GNU Lesser General Public License", ("2.1", "3")),
       ("AGPL", "GNU Affero General Public License", ("3",)), ("GFDL", "GNU Free Documentation License", ("1.1", "1.2", "1.3")))
CREATIVE = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
            "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
CREATIVE_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
# licences that notices name, with the names in use
NAMED = {
    "MIT": ("MIT License",), "ISC": ("ISC License",), "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"), "Zlib": ("zlib License",),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "Modified BSD License"), "BSL-1.0": ("Boost Software License, Version 1.0",),
    "Apache-1.1": ("Apache License, Version 1.1",), "Apache-2.0": ("Apache License, Version 2.0", "Apache 2.0 License"), "Unlicense": ("Unlicense",),
    "MPL-1.1": ("Mozilla Public License, Version 1.1",), "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"),
    "EPL-1.0": ("Eclipse Public License, Version 1.0",), "EPL-2.0": ("Eclipse Public License, Version 2.0", "Eclipse Public License 2.0"),
    "EUPL-1.2": ("European Union Public Licence, Version 1.2",), "Artistic-2.0": ("Artistic License 2.0",), "PostgreSQL": ("PostgreSQL License",),
}
# sha256 of the normal form of long licences: the whole text as published, and (second) up to the end of its terms
DIGESTS: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("45c5565dedc03ff2a570c67c5af611f8a3d0a0227c6e81d9fb11fbf0c004b959", "2b4a3f34572f63637f58db72bdacad38516a1e1e6788b08931d0a0d5c0be33dd",),
    "Artistic-1.0-Perl": ("08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702",),
    "CC0-1.0": ("96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",),
    "GFDL-1.2-only": ("1c057ea35084eb195331cec1a49fca335c176422a7726a9a23636906fd4e241f", "925dba96dda1b00cd8ff146661df40b6b2a302af5bf2f1243976eddb6d5a8450",),
    "GFDL-1.3-only": ("7e8edd3abe6258bb82bb853d91a0c24fcd9976894fd0592747354cffe1cb18e7", "0cb0736777286efc71748df95c0748e42cbf34246d31f42e488fded6114061ce",),
    "GPL-1.0-only": ("98db0b473e0a45a62b04a39b6b864b4e079a58d513e2196f94fe7252fa8574a6", "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70",),
    "GPL-2.0-only": ("e95eb1718f9f373d56cc586a5f7d1bfa11668867f6e85e982d2b6108b97d90a1", "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808",),
    "GPL-3.0-only": ("df71f3c423c11bc52456a9775329f1d9a3168a6f071654750b9eb155fb3ec0eb", "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191",),
    "LGPL-2.0-only": ("e4deecd0730802431ad09f00ae3793f3703c8e4dba639586545d9f958405614d", "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2",),
    "LGPL-2.1-only": ("d3826e4e563a04a354453ff139a32b19d6c3fe283f518eb566107c54e18cd01f", "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df",),
    "LGPL-3.0-only": ("aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",),
    "MPL-1.1": ("26ba73e836ecb04fe87d5eca80ca27cff1afa2d7683455be1517bd23b8d27986",),
    "MPL-2.0": ("4019e4c8fe9ede57c538b37b3332dc097a88c163e273bb6905d38316e63c2eb6",),
}


def _versioned(version: str) -> str:
    return version if "." in version else f"{version}.0"


def _bsd(name: str, parts: tuple[str, ...], warranty: dict[str, str]) -> list[tuple[str, str]]:
    """A BSD licence with its conditions numbered, and with marks that count as punctuation."""
    tail = _BSD_WARRANTY.format(**warranty)
    return [(name, "\n\n".join((_REDISTRIBUTION, *(f"{mark(i)} {p}" for i, p in enumerate(parts, 1)), tail))) for mark in (lambda i: f"{i}.", lambda i: "*")]


def texts() -> list[tuple[str, str]]:
    """``(licence, text)`` of all known wordings."""
    out = [("MIT", MIT), ("MIT", "MIT License\n\n" + MIT), ("MIT", "The MIT License (MIT)\n\n" + MIT), ("MIT", "The MIT License\n\n" + MIT),
           ("MIT-0", MIT.replace(", subject to the following conditions:", ".").replace("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n", "")),
           ("Zlib", ZLIB), ("Zlib", "zlib License\n\n" + ZLIB), ("Unlicense", UNLICENSE), ("BSL-1.0", BOOST), ("PostgreSQL", POSTGRESQL), ("PostgreSQL", "PostgreSQL License\n\n" + POSTGRESQL),
           ("WTFPL", WTFPL), ("Apache-2.0", APACHE_NOTICE), ("MPL-2.0", MPL_NOTICE)]
    for head in ("", "ISC License\n\n"):
        out.append(("ISC", f"{head}{ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{ISC_WARRANTY}"))
    out.append(("0BSD", f"{ISC_GRANT}.\n\n{ISC_WARRANTY}"))
    three = (_SOURCE, _BINARY, _NO_ENDORSEMENT)
    for name, parts in (("BSD-2-Clause", three[:2]), ("BSD-3-Clause", three)):
        for holder in ("the copyright holder", "the copyright owner"):
            for i, text in _bsd(name, tuple(p.format(name=holder) for p in parts), _HOLDERS):
                out += [(i, text), (i, f"{name.replace('-C', ' C').replace('BSD-', 'BSD ').replace(' C', '-C')} License\n\n{text}")]
    out += _bsd("BSD-3-Clause", tuple(p.format(name="the University") for p in three), _REGENTS)
    out += _bsd("BSD-4-Clause", (_SOURCE, _BINARY, _ADVERTISING, _NO_ENDORSEMENT.format(name="the University")), _REGENTS)
    for kind, name, versions in GNU:
        for v in versions:
            licence = f"{kind}-{_versioned(v)}"
            out += [(f"{licence}-or-later", _GNU_NOTICE.format(name=name, version=v, colon=c)) for c in (":", ";")]
            out += [(f"{licence}-only", f"{lead} the {name}, {word} {v}.") for lead in ("This work is licensed under", "Licensed under", "Released under") for word in ("version", "v")]
            out += [(f"{licence}-or-later", f"{lead} the {name}, version {v} or later.") for lead in ("This work is licensed under", "Licensed under", "Released under")]
    for short, name in CREATIVE.items():
        for v in CREATIVE_VERSIONS:
            region = "International" if v == "4.0" else "Unported" if v == "3.0" else "Generic"
            out += [(f"CC-{short}-{v}", t) for t in (
                f"Licensed under CC {short} {v}.", f"This work is licensed under CC {short} {v}.", f"This work is licensed under a Creative Commons {name} {v} {region} License.",
                f"This work is licensed under the Creative Commons {name} {v} {region} License.", f"Creative Commons {name} {v} {region}")]
    for licence, names in NAMED.items():
        out += [(licence, f"{lead} the {n}.") for n in names for lead in ("Released under", "Licensed under", "This work is licensed under", "Distributed under")]
    ids = sorted({i for i, _ in out} | set(DIGESTS))
    return out + [(i, f"SPDX-License-Identifier: {i}") for i in ids]
