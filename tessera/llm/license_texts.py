"""Full texts of common licences for the known list of :mod:`tessera.llm.license_scan`.

The files under ``licenses/`` are the licences as published, named by SPDX
identifier.  The short ones are built here, with the dress in which they are
customarily shipped.  A text that differs in other words is another text.
"""

from __future__ import annotations

import re
from importlib.resources import files
from itertools import product

#: Title lines (the first is the usual one) by licence; a text counts with each and without any.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "Zlib": ["zlib License", "The zlib License", "The zlib/libpng License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License"],
}

BSD_HEAD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
"""
BSD_CLAUSES = [
    """Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.""",
    """Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.""",
    """Neither the name of the copyright holder nor the names of its
contributors may be used to endorse or promote products derived from
this software without specific prior written permission.""",
]
BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER{s} OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
RESERVED = "All rights reserved."


def _bsd() -> list[tuple[str, str]]:
    """Clauses numbered or with bullets; the owner in the singular or plural."""
    out = []
    for n, numbered, s in product((2, 3), (True, False), ("", "S")):
        clauses = [f"{i}. {c}" if numbered else f"* {c}" for i, c in enumerate(BSD_CLAUSES[:n], 1)]
        out.append((f"BSD-{n}-Clause", "\n".join([BSD_HEAD, *clauses, BSD_TAIL.format(s=s)])))
    return out


def _published() -> list[tuple[str, str]]:
    folder = files("tessera.llm").joinpath("licenses")
    return sorted((f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in folder.iterdir() if f.name.endswith(".txt"))


def _without_title(license_id: str, text: str) -> list[str]:
    """The text from behind its title lines on (name, version and address, up to the first long or blank line)."""
    head, _, rest = re.sub(r"\A\s+", "", text).partition("\n\n")
    out = [rest]
    if license_id == "CC0-1.0":  # "Creative Commons Legal Code", then "CC0 1.0 Universal"
        out.append(rest.lstrip("\n").partition("\n\n")[2])
    return out


def _endings(license_id: str, text: str) -> list[str]:
    """The text with its appendix, with the appendix's copyright line filled in (which then does not count), and without."""
    out = [text]
    if license_id == "Apache-2.0":
        out.append(re.sub(r"(?m)^.*Copyright \[yyyy\] \[name of copyright owner\].*$", "", text))
    end = re.search(r"END OF TERMS AND CONDITIONS", text)
    if end:
        out += [text[: end.end()], text[: end.start()]]
    return out


def with_dress(known: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """``known`` short texts with each title and "All rights reserved." line, and the published files."""
    short = [(i, t) for i, t in known if i in TITLES and len(t) > 500] + _bsd()
    # OpenBSD's wording of ISC
    short += [(i, t.replace("and/or distribute", "and distribute")) for i, t in short if i == "ISC"]
    out = []
    for i, text in short:
        for title, reserved in product(["", *TITLES[i]], ("", RESERVED)):
            out.append((i, "\n\n".join(filter(None, [title, reserved, text]))))
    for i, text in _published():
        for whole in _endings(i, text):
            out += [(i, t) for t in [whole, *_without_title(i, whole)]]
    return out
