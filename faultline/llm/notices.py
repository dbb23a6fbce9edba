"""Templates of licenses beside the short notices in `licenses.NOTICES`, and what tells them apart.

A family is a sentence that several licenses share but for their name and version. Long bodies are known
by their title, or by the sentences that only they have; short ones also as a whole. `FAMILIES` names the notices of each family.
"""

from __future__ import annotations

_GNU = {
    "GPL-1.0": ("General", "1"),
    "GPL-2.0": ("General", "2"),
    "GPL-3.0": ("General", "3"),
    "LGPL-2.0": ("Library General", "2"),
    "LGPL-2.1": ("Lesser General", "2.1"),
    "LGPL-3.0": ("Lesser General", "3"),
    "AGPL-3.0": ("Affero General", "3"),
}
_GNU_DATES = {
    "GPL-1.0": "February 1989",
    "GPL-2.0": "June 1991",
    "GPL-3.0": "29 June 2007",
    "LGPL-2.0": "June 1991",
    "LGPL-2.1": "February 1999",
    "LGPL-3.0": "29 June 2007",
    "AGPL-3.0": "19 November 2007",
}
_CC = {
    "CC-BY": "Attribution",
    "CC-BY-SA": "Attribution-ShareAlike",
    "CC-BY-ND": "Attribution-NoDerivatives",
    "CC-BY-NC": "Attribution-NonCommercial",
    "CC-BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "CC-BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_CC_VERSIONS = {"4.0": "4.0 International", "3.0": "3.0 Unported"}

_GNU_SENTENCES = {
    name: f"This work is licensed under the GNU {kind} Public License, version {version}"
    for name, (kind, version) in _GNU.items()
    if name != "GPL-3.0"
}
_GNU_TITLES = {
    f"{name} text": f"GNU {kind} Public License Version {version}, {_GNU_DATES[name]}"
    for name, (kind, version) in _GNU.items()
}
_GNU_NOTICES = {
    f"{name} notice": "This program is free software: you can redistribute it and/or modify it under "
    f"the terms of the GNU {kind} Public License as published by the Free Software Foundation"
    for name, kind in {"LGPL": "Lesser General", "AGPL": "Affero General"}.items()
}
_CC_SENTENCES = {
    # The sentence of CC-BY-NC-4.0 stands beside its short notice in `NOTICES`.
    f"{name}-{version}" + (" notice" if (name, version) == ("CC-BY-NC", "4.0") else ""): "This work is "
    f"licensed under a Creative Commons {kind} {kind_of_version} License"
    for name, kind in _CC.items()
    for version, kind_of_version in _CC_VERSIONS.items()
    if (name, version) != ("CC-BY", "4.0")
}
_CC_SHORT = {
    f"{name}-{version} short": f"Licensed under CC {name[3:]} {version}"
    for name in _CC
    for version in _CC_VERSIONS
    if (name, version) != ("CC-BY-NC", "4.0")
}
_APACHE = {
    f"{name} notice": f"Licensed under the {kind} (the \"License\"); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at"
    for name, kind in {
        "Apache-1.1": "Apache License, Version 1.1",
        "ECL-2.0": "Educational Community License, Version 2.0",
    }.items()
}
_MPL = {
    "MPL-1.1": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1",
}
_EPL = {
    f"EPL-{version}": "This program and the accompanying materials are made available under the terms of "
    f"the Eclipse Public License v{version}"
    for version in ("1.0", "2.0")
}

_BSD_BINARY = (
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
    "and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
    "or promote products derived from this software without specific prior written permission."
)
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\""
_BSD_ADVERTISING = (
    "All advertising materials mentioning features or use of this software must display the following "
    "acknowledgement: This product includes software developed by"
)
_BSD = {
    "BSD-2-Clause": f"{_BSD_BINARY} {_BSD_END}",
    "BSD-3-Clause": f"{_BSD_BINARY} 3. {_BSD_NAMES} {_BSD_END}",
    "BSD-3-Clause unnumbered": f"{_BSD_BINARY} {_BSD_NAMES} {_BSD_END}",
    "BSD-4-Clause": f"{_BSD_BINARY} 3. {_BSD_ADVERTISING}",
    "BSD-4-Clause unnumbered": f"{_BSD_BINARY} {_BSD_ADVERTISING}",
}

_OTHERS = {
    "Apache-2.0 text": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND "
    "CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "MPL-2.0 text": "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each "
    "individual or legal entity that creates, contributes to the creation of, or owns Covered Software.",
    "MPL-1.1 text": "Mozilla Public License Version 1.1 1. Definitions. 1.0.1. \"Commercial Use\" means "
    "distribution or otherwise making the Covered Code available to a third party.",
    "MIT text": "The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
    "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS "
    "FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted, provided that the above copyright notice and this permission notice "
    "appear in all copies.",
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
    "WARRANTIES",
    "ISC name": "Released under the ISC License",
    "Zlib": "Permission is granted to anyone to use this software for any purpose, including commercial "
    "applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a "
    "copy of the software and accompanying documentation covered by this license",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free "
    "to copy, modify, publish, use, compile, sell, or distribute this software",
    "OFL-1.1": "This Font Software is licensed under the SIL Open Font License, Version 1.1",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or "
    "neighboring rights to this work",
    "WTFPL": "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE Version 2, December 2004",
}

# Whole texts without the lines of title, year and holder, which differ from copy to copy.
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the "
    "above copyright notice, this list of conditions and the following disclaimer. 2."
)
_BSD_DISCLAIMER = (
    f"{_BSD_END} AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
    "THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS "
    "OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF "
    "SUCH DAMAGE."
)
_ISC_DISCLAIMER = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
    "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
    "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
    "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
    "SOFTWARE."
)
_WHOLE = {
    "MIT whole": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files (the \"Software\"), to deal in the Software without "
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions: "
    f"{_OTHERS['MIT text']} IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
    "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "BSD-2-Clause whole": f"{_BSD_START} {_BSD_BINARY} {_BSD_DISCLAIMER}",
    "BSD-3-Clause whole": f"{_BSD_START} {_BSD_BINARY} 3. {_BSD_NAMES} {_BSD_DISCLAIMER}",
    "ISC whole": f"{_OTHERS['ISC']} {_ISC_DISCLAIMER}",
    "0BSD whole": "Permission to use, copy, modify, and/or distribute this software for any purpose with "
    f"or without fee is hereby granted. {_ISC_DISCLAIMER}",
    "Zlib whole": "This software is provided 'as-is', without any express or implied warranty. In no event "
    "will the authors be held liable for any damages arising from the use of this software. "
    f"{_OTHERS['Zlib']}: 1. The origin of this software must not be misrepresented; you must not claim "
    "that you wrote the original software. If you use this software in a product, an acknowledgment in the "
    "product documentation would be appreciated but is not required. 2. Altered source versions must be "
    "plainly marked as such, and must not be misrepresented as being the original software. 3. This notice "
    "may not be removed or altered from any source distribution.",
    "Unlicense whole": f"{_OTHERS['Unlicense']}, either in source code form or as a compiled binary, for "
    "any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright "
    "laws, the author or authors of this software dedicate any and all copyright interest in the software "
    "to the public domain. We make this dedication for the benefit of the public at large and to the "
    "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment "
    "in perpetuity of all present and future rights to this software under copyright law. "
    + _OTHERS["MIT text"].partition("Software. ")[2]
    + " IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
    "USE OR OTHER DEALINGS IN THE SOFTWARE.",
}

MORE_NOTICES = {
    **_GNU_SENTENCES,
    **_GNU_TITLES,
    **_GNU_NOTICES,
    **_CC_SENTENCES,
    **_CC_SHORT,
    **_APACHE,
    **_MPL,
    **_EPL,
    **_BSD,
    **_OTHERS,
    **_WHOLE,
}

FAMILIES = (
    ("GPL-3.0", *_GNU_SENTENCES),
    tuple(_GNU_TITLES),
    ("GPL notice", *_GNU_NOTICES),
    ("CC-BY-4.0", *_CC_SENTENCES),
    ("CC-BY-NC-4.0", *_CC_SHORT),
    ("Apache-2.0 notice", *_APACHE),
    ("MPL-2.0", *_MPL),
    tuple(_EPL),
    ("BSD-2-Clause", "BSD-3-Clause unnumbered"),
    ("BSD-3-Clause", "BSD-4-Clause"),
    ("BSD-3-Clause unnumbered", "BSD-4-Clause unnumbered"),
    ("ISC", "0BSD"),
    ("BSD-2-Clause whole", "BSD-3-Clause whole"),
    ("ISC whole", "0BSD whole"),
)
