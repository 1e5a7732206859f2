"""Public licence texts and the notices that name a licence, as their publishers word them."""

from __future__ import annotations

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE."""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""

_BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
materials provided with the distribution."""

_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""

_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY
OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""

_MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""

_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means."""

def _header(program: str, family: str, version: str) -> str:
    """The notice that the publisher of the GNU licences asks for in every file."""
    return (
        f"This {program} is free software{':' if version == '3' else ';'} you can redistribute it and/or modify it under the "
        f"terms of the GNU {family} as published by the Free Software Foundation{',' if version == '3' else ';'} either "
        f"version {version} of the License, or (at your option) any later version. This {program} is distributed in the hope "
        f"that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
        f"FOR A PARTICULAR PURPOSE. See the GNU {family} for more details."
    )


# The GNU licences that have short notices and file notices of one wording, by name and version.
_GNU = (
    ("GPL-1.0", "General Public License", "1"),
    ("GPL-2.0", "General Public License", "2"),
    ("GPL-3.0", "General Public License", "3"),
    ("LGPL-2.0", "Library General Public License", "2"),
    ("LGPL-2.1", "Lesser General Public License", "2.1"),
    ("LGPL-3.0", "Lesser General Public License", "3"),
    ("AGPL-3.0", "Affero General Public License", "3"),
)
_GNU_NOTICES = tuple(
    (name, text)
    for name, family, version in _GNU
    for text in (
        f"Licensed under the GNU {family}, version {version}.",
        f"This work is licensed under the GNU {family}, version {version}.",
        _header("library" if family.startswith(("Lesser", "Library")) else "program", family, version),
    )
)
# The Creative Commons licences by their parts, and the versions with the names they go by.
_CREATIVE = (
    ("BY", "Attribution"),
    ("BY-SA", "Attribution-ShareAlike"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
)
_CREATIVE_VERSIONS = (("3.0", "Unported"), ("4.0", "International"))
_CREATIVE_NOTICES = tuple(
    (f"CC-{short}-{version}", text)
    for short, long in _CREATIVE
    for version, scope in _CREATIVE_VERSIONS
    for text in (
        f"Licensed under CC {short} {version}.",
        f"This work is licensed under a Creative Commons {long} {version} {scope} License.",
    )
)

# (licence, text); several texts may stand for one licence.
TEMPLATES = (
    ("MIT", _MIT_GRANT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("ISC", _ISC_GRANT),
    ("ISC", "Licensed under the ISC License."),
    ("BSD-2-Clause", f"{_BSD_CONDITIONS} {_BSD_DISCLAIMER}"),
    ("BSD-3-Clause", f"{_BSD_CONDITIONS} {_BSD_NAMES} {_BSD_DISCLAIMER}"),
    ("Apache-2.0", _APACHE_HEADER),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    *_GNU_NOTICES,
    ("MPL-2.0", _MPL_HEADER),
    ("Unlicense", _UNLICENSE),
    *_CREATIVE_NOTICES,
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
)
