"""Public licence texts and one-line notices, by SPDX name.

Long texts are files of the folder ``known``. Notices are made from the licences' names by templates.
"""

import re
from importlib.resources import files

_MIT_BODY = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation
the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions
of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE.
"""

_ISC_BODY = """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
USE OR PERFORMANCE OF THIS SOFTWARE.
"""

_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN
ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""

_BSD_TWO = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution.
"""

_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
"""

_ZLIB_BODY = """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be
appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.

3. This notice may not be removed or altered from any source distribution.
"""

_APACHE_NOTICE = """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
the specific language governing permissions and limitations under the License.
"""

KNOWN = {
    "Apache-2.0 (header)": _APACHE_NOTICE,
    "Apache-2.0 (line)": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": _BSD_TWO + _BSD_END,
    "BSD-2-Clause (titled)": "BSD 2-Clause License\n" + _BSD_TWO + _BSD_END,
    "BSD-3-Clause": _BSD_TWO + _BSD_THIRD + _BSD_END,
    "BSD-3-Clause (titled)": "BSD 3-Clause License\n" + _BSD_TWO + _BSD_THIRD + _BSD_END,
    "CC-BY-4.0 (line)": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0 (line)": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 (line)": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0 (line)": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": _ISC_BODY,
    "ISC (titled)": "ISC License\n" + _ISC_BODY,
    "MIT": _MIT_BODY,
    "MIT (line)": "Released under the MIT License.",
    "MIT (titled)": "MIT License\n" + _MIT_BODY,
    "MIT (titled, the)": "The MIT License (MIT)\n" + _MIT_BODY,
    "Zlib": _ZLIB_BODY,
    "Zlib (titled)": "zlib License\n" + _ZLIB_BODY,
}

# Whole texts, as published; the ones with a part on how to apply them also count without it.
_FILES = (
    "Apache-2.0", "Artistic-1.0-Perl", "BSL-1.0", "CC0-1.0", "GFDL-1.3", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0",
    "Unlicense",
)
_END = re.compile(r"^[ ]*END OF TERMS AND CONDITIONS[ ]*$", re.M)

for _name in _FILES:
    KNOWN[_name] = _text = files(__package__).joinpath("known", f"{_name}.txt").read_text("utf-8")
    if _found := _END.search(_text):
        KNOWN[f"{_name} (terms)"] = _text[: _found.start()]
        KNOWN[f"{_name} (terms, end)"] = _text[: _found.end()]


def _gnu(name: str, short: str, version: str) -> dict[str, tuple[str, ...]]:
    """Names of a licence of the GNU project in one version, alone and with later ones."""
    plain = version.removesuffix(".0")
    alone = [f"{name}, version {plain}", f"{name} version {version}", f"{name} v{version}", f"GNU {short} v{plain}", f"{short} v{plain}", f"{short}v{plain}", f"{short} {version}"]
    later = [f"{n}{end}" for n in alone for end in (" or later", " or any later version")]
    return {
        f"{short}-{version}-only": (*alone, f"{alone[0]} only"),
        f"{short}-{version}-or-later": (*later, f"{short}v{plain}+", f"{short} {plain}+"),
    }


def _creative(kind: str, words: str, version: str) -> dict[str, tuple[str, ...]]:
    return {f"CC-{kind}-{version}": (
        f"CC {kind} {version}", f"Creative Commons {kind} {version}", f"Creative Commons {words} {version}",
        f"Creative Commons {words} {version} International", f"Creative Commons {words} {version} License",
        f"Creative Commons {words} {version} International License",
    )}


_CREATIVE = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}

# Names that notices call the licences by.
NAMES: dict[str, tuple[str, ...]] = {
    "0BSD": ("Zero-Clause BSD License", "0BSD License", "BSD Zero Clause License"),
    "Apache-2.0": (
        "Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0", "Apache 2.0 License", "Apache 2",
        "Apache-2.0 License", "Apache Software License 2.0", "Apache Software License, Version 2.0", "ASL 2.0",
    ),
    "Artistic-2.0": ("Artistic License 2.0", "Artistic License, Version 2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "BSD-2-Clause License", "Simplified BSD License", "FreeBSD License"),
    "BSD-3-Clause": (
        "BSD 3-Clause License", "3-Clause BSD License", "BSD-3-Clause License", "New BSD License", "Modified BSD License",
        "BSD 3-Clause \"New\" or \"Revised\" License", "Revised BSD License",
    ),
    "BSL-1.0": ("Boost Software License", "Boost Software License, Version 1.0", "Boost Software License 1.0", "BSL 1.0"),
    "CC0-1.0": (
        "CC0", "CC0 1.0", "CC0 1.0 Universal", "Creative Commons CC0", "Creative Commons Zero", "Creative Commons CC0 1.0 Universal",
        "Creative Commons Zero v1.0 Universal",
    ),
    "EPL-1.0": ("Eclipse Public License 1.0", "Eclipse Public License v1.0", "Eclipse Public License, Version 1.0", "EPL 1.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License, Version 2.0", "EPL 2.0"),
    "EUPL-1.2": ("European Union Public Licence 1.2", "European Union Public License, Version 1.2", "EUPL 1.2", "EUPL v1.2"),
    "ISC": ("ISC License", "ISC"),
    "MIT": ("MIT License", "MIT", "MIT License (MIT)", "Expat License", "terms of the MIT License"),
    "MPL-1.1": ("Mozilla Public License 1.1", "Mozilla Public License, Version 1.1", "MPL 1.1"),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, Version 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License v2.0", "MPL 2.0", "MPLv2"),
    "ODbL-1.0": ("Open Database License", "Open Data Commons Open Database License", "Open Database License 1.0", "ODbL", "ODbL 1.0"),
    "PSF-2.0": ("Python Software Foundation License", "PSF License", "Python Software Foundation License Version 2"),
    "Unlicense": ("Unlicense",),
    "WTFPL": ("WTFPL", "Do What The Fuck You Want To Public License"),
    "Zlib": ("zlib License", "zlib/libpng License"),
}
for _name, _short, _versions in (
    ("GNU General Public License", "GPL", ("1.0", "2.0", "3.0")), ("GNU Lesser General Public License", "LGPL", ("2.1", "3.0")),
    ("GNU Library General Public License", "LGPL", ("2.0",)), ("GNU Affero General Public License", "AGPL", ("3.0",)),
    ("GNU Free Documentation License", "GFDL", ("1.2", "1.3")),
):
    for _version in _versions:
        NAMES |= _gnu(_name, _short, _version)
for _kind, _words in _CREATIVE.items():
    for _version in ("3.0", "4.0"):
        NAMES |= _creative(_kind, _words, _version)

_SUBJECTS = (
    "", "This work is ", "This project is ", "This software is ", "This program is ", "This file is ", "This document is ",
)
_VERBS = ("licensed", "released", "distributed")


def notices(licence: str, names: tuple[str, ...]) -> list[str]:
    """One-line notices of a licence."""
    identifiers = dict.fromkeys((licence, licence.removesuffix("-only"), licence.replace("-or-later", "+")))
    made = [f"{key}: {x}" for x in identifiers for key in ("SPDX-License-Identifier", "License")] + [f"License: {x}" for x in names]
    for name in dict.fromkeys((*names, *identifiers)):
        article = "the " if re.search(r"Licen[sc]e|^Unlicense|^terms", name) else ""
        made += [f"{subject}{verb} under {article}{name}" for subject in _SUBJECTS for verb in _VERBS]
    return made


def _bare(text: str) -> str:
    return " ".join(re.findall(r"[^\W_]+", text.lower()))


_seen = {_bare(text) for text in KNOWN.values()}
for _name, _names in NAMES.items():
    for _number, _notice in enumerate(x for x in notices(_name, _names) if _bare(x) not in _seen):
        if _bare(_notice) not in _seen:
            _seen.add(_bare(_notice))
            KNOWN[f"{_name} (line {_number + 2})"] = _notice
