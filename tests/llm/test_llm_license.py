from pathlib import Path

from tessera.llm import license_scan as L
from tessera.llm.queries import QUERIES

MIT = next(t for n, t in L.KNOWN if n == "MIT" and len(t) > 500)


def got(df, **kw):
    return {r.id: (r.license_id, r.notice_ids) for r in L.scan(df, **kw).collect()}


def test_whole_texts_in_any_dress(docs):
    rows = [
        (1, MIT),
        (2, "Copyright (c) 2020 Some One\n(c) 2021 Others\n© 2022 More\n\n" + MIT.upper()),
        (8, MIT.replace("copyright\nholders", "copyright holders").replace("COPYRIGHT HOLDERS", "COPYRIGHT\r\nHOLDERS")),
        (3, MIT.replace("\n", " ").replace('"', "'").replace("sublicense", "sublicence")),
        (4, MIT + " And more."),
        (5, MIT[:-40]),
        (6, "  licensed under the apache licence, version 2.0!! "),
        (7, "Licensed under the Apache License, Version 2.1."),
    ]
    out = got(docs(rows, extra=True))
    assert [out[i][0] for i in range(1, 8)] == ["MIT", "MIT", "MIT", None, None, "Apache-2.0", None]
    assert out[8][0] == "MIT"


def test_lines_nulls_and_repeats(docs):
    rows = [
        (1, "All rights reserved.\r\nwords\nReleased under the MIT License.\rLicensed under CC BY-NC 4.0."),
        (2, None), (3, ""), (4, "!!!\n\n"), (5, "Copyright 2020 Someone"), (None, "Released under the MIT License."),
        (6, "word " * 50_000), (6, "word " * 50_000),
    ]
    out = got(docs(rows))
    assert out[1] == (None, ["CC-BY-NC-4.0", "LicenseRef-all-rights-reserved", "MIT"])
    assert out[None] == ("MIT", ["MIT"])
    assert all(out[i] == (None, None) for i in (2, 3, 4, 5, 6))
    r = L.scan(docs(rows)).collect()
    assert len(r) == len(rows) and {x.id for x in r if x.text_digest is None} == {2, 3, 4, 5}
    assert got(docs([])) == {}


BSD_3 = """BSD 3-Clause License

Copyright (c) 2021, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

* Redistributions of source code must retain the above copyright notice, this
  list of conditions and the following disclaimer.

* Redistributions in binary form must reproduce the above copyright notice,
  this list of conditions and the following disclaimer in the documentation
  and/or other materials provided with the distribution.

* Neither the name of the copyright holder nor the names of its
  contributors may be used to endorse or promote products derived from
  this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""


def test_standard_files_as_published(docs):
    published = {f.stem: f.read_text() for f in (Path(L.__file__).parent / "licenses").glob("*.txt")}
    apache = published["Apache-2.0"]
    terms = apache[: apache.index("APPENDIX")]
    rows = [
        (1, "MIT License\n\nCopyright (c) 2020 Some One\n\n" + MIT),
        (2, "The MIT License (MIT)\n\nCopyright (c) 2020 Some One\n\n" + MIT),
        (3, BSD_3),
        (4, BSD_3.replace("All rights reserved.\n", "").partition("\n")[2]),
        (5, apache),
        (6, apache.replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2020 Some One")),
        (7, terms),
        (8, apache[apache.index("TERMS AND CONDITIONS FOR USE") :]),
        (9, BSD_3.replace("DISCLAIMED", "WELCOME")),
    ]
    out = got(docs(rows))
    assert [out[i][0] for i in range(1, 9)] == ["MIT"] * 2 + ["BSD-3-Clause"] * 2 + ["Apache-2.0"] * 4
    assert out[9][0] is None
    out = got(docs([(i, t) for i, t in enumerate(published.values())]))
    assert [out[i][0] for i in range(len(published))] == list(published) and len(published) == 7


def test_known_list_is_a_parameter(docs):
    assert got(docs([(1, "My  own\nterms")]), known=[("own", "my own terms.")]) == {1: ("own", None)}


def test_repeated_ids_keep_their_own_notices(docs):
    rows = [(1, "x\nAll rights reserved"), (1, "y\nReleased under the MIT license")]
    out = sorted(str(r.notice_ids) for r in L.scan(docs(rows)).collect())
    assert out == ["['LicenseRef-all-rights-reserved']", "['MIT']"]


def test_query_is_complete(spark):
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert QUERIES["op4_license_scan"](spark, sf).count() == n
