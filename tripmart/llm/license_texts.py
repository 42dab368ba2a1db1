"""Further known licences: short texts, and digests of the canonical forms of
long ones (see ``license_scan.canonical``)."""

from __future__ import annotations

_BSD_1 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_2 = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT {0} AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
EVENT SHALL THE COPYRIGHT {1} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""
_BSD_3 = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <{0}>"""

# As often found: the holder in the singular, and with lines that are kept.
_BSD = [(i, a.format(*who)) for i, a in (("BSD-2-Clause", _BSD_1 + _BSD_2), ("BSD-3-Clause", _BSD_1 + _BSD_3 + _BSD_2))
        for who in (("HOLDERS", "HOLDER"), ("HOLDERS", "HOLDERS"), ("OWNERS", "OWNER"), ("OWNER", "OWNER"))]
_TITLES = {"BSD-2-Clause": ["BSD 2-Clause License", 'Simplified BSD License', "The BSD 2-Clause License"],
           "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License"],
           "ISC": ["ISC License", "The ISC License"], "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"],
           "Zlib": ["zlib License", "The zlib License"], "Unlicense": ["The Unlicense", "Unlicense"]}
RIGHTS = "All rights reserved."


def further(given: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The texts above, and each whole text, also of ``given``, with the usual
    title or an "all rights reserved" line before it."""
    own = [*_BSD, *[("Unlicense", _UNLICENSE.format(u)) for u in ("http://unlicense.org/", "https://unlicense.org",
                                                                  "http://unlicense.org")]]
    out = list(own)
    for i, text in [*own, *[(i, t) for i, t in given if "\n" in t]]:
        out += [(i, f"{line}\n\n{text}") for line in (
            RIGHTS, *_TITLES.get(i, []), *[f"{t}\n\n{RIGHTS}" for t in _TITLES.get(i, [])])]
    return out


# SHA-256 of the canonical forms of the published texts.
DIGESTS: list[tuple[str, str]] = [
    ("Apache-2.0", "73a7d4ec24b4fca332b670d1c54f91a51a0cf7ac593e0168325f682a5ba19e3c"),  # without its appendix
    ("Apache-2.0", "6baf7b29c3334a6937496a13add7631a7e8100aad8f2a1326fd51f2ed13ac30a"),
    ("GPL-1.0", "193b0c5ce11614abae0062d6feadd14834ed0980131e961c6db429bc5e39d683"),
    ("GPL-2.0", "77043a279c53ceb53f4641417f87a52a75ab4320668365e9ac8a24137a5bd1f4"),
    ("GPL-3.0", "d13c4915355799014d12a06aff7b8920f37be9b29d83c1646b28d7461beca5b8"),
    ("LGPL-2.0", "e507ba863c3337617d721b1fc293cf60ffc7b8220781d0fee216eac84e352a2a"),
    ("LGPL-2.1", "305bade5d66b6819c9cd0039417b916b64cc06a81ee604b5d1a4d759b0a25efe"),
    ("LGPL-3.0", "572947626844a56d29ace510237040204d4085696621f319533ca366aa897913"),
    ("MPL-1.1", "ccf563bf7e9602ddc84771c776f95cf289b0b370516e99218af854a38db125d1"),
    ("MPL-2.0", "085a00a7d5f35fd39ee7b08052486f5758ccc298a989a6393e2ce3ead8160650"),
    ("CC0-1.0", "5caa6b96e2c9f66e9ca02d726096312a8662a9c4fea6446ff24fee66902e58dc"),
    ("GFDL-1.2", "5594fdaeaf595a116554f09adc241952e39153fab9c66c7fff550149a7b57dc3"),
    ("GFDL-1.3", "87a1efb1bff9352f087f6d3c380d405157e6d943c8bec65a46261fa87940ec41"),
]
