from __future__ import annotations

import re
import textwrap
from collections import Counter

import zstandard

from pagemill.llm import licenses
from pagemill.llm.common import table
from tests.llm import odd

NOTICES = {k: v for k, v in licenses.TEMPLATES.items() if len(v) < 120}


def test_every_planted_notice_is_found_once(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").select("doc_id", "text").collect()}
    want = sorted((i, name, m.start()) for i, t in docs.items() for name, notice in NOTICES.items() for m in re.finditer(re.escape(notice.rstrip(".")), t))
    got = licenses.query(spark, sf).where("exact").collect()
    assert sorted((r["doc_id"], r["license"], r["start"]) for r in got) == want
    assert all(docs[r["doc_id"]][r["start"] : r["end"]] == NOTICES[r["license"]].rstrip(".") for r in got)


def found(text):
    scanner = licenses.Scanner(licenses.TEMPLATES)
    return [(n, m, a) for x, y in licenses.blocks_of(text) for n, _, _, _, m, a, _ in scanner.block(text[x:y])]


def test_wording_differences_are_listed():
    mit = licenses.TEMPLATES["MIT"]
    assert found(mit) == [("MIT", [], [])]
    changed = mit.replace("without limitation ", "").replace("any person", "any natural person")
    assert found("Some words before.\n" + changed + "\nSome words after.") == [("MIT", ["without", "limitation"], ["natural"])]
    assert found("A permission slip is needed for the warranty of this copyright.") == []


def test_ranking_equals_plain_compression_with_each_template():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for name, text in licenses.TEMPLATES.items():
        words = [w.lower() for w in licenses.WORD.findall("Some words before. " + text)]
        data = " ".join(words).encode()
        plain = len(zstandard.ZstdCompressor(level=licenses.LEVEL).compress(data))
        want = []
        for k, t in enumerate(scanner.known):
            given = zstandard.ZstdCompressionDict(" ".join(t.words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            lacking = sum((Counter(t.words) - Counter(words)).values())
            if lacking <= int(licenses.ALLOWED * len(t.words) + 1e-9):
                want.append((plain - len(zstandard.ZstdCompressor(level=licenses.LEVEL, dict_data=given).compress(data)), k))
        assert scanner.saved(words) == sorted(want, key=lambda x: (-x[0], x[1])) and name in [scanner.known[k].name for _, k in want]


def test_every_template_is_found_whole_however_it_is_wrapped():
    for name, text in licenses.TEMPLATES.items():
        shapes = [text, *("\n".join(textwrap.wrap(text, width, break_long_words=False, break_on_hyphens=False)) for width in (20, 40, 50, 60, 72, 80))]
        for shape in [*shapes, *("\n".join(f"# {line}" for line in x.split("\n")) for x in shapes)]:
            assert found(shape) == [(name, [], [])], (name, shape)
            assert found("Rain fell on the hills all night.\n" * 60 + shape + "\nThe river rose by noon." * 60) == [(name, [], [])]


def test_a_notice_across_windows_is_found_whole():
    mit, versions = licenses.TEMPLATES["MIT"], [licenses.TEMPLATES[f"GPL-{v}.0-notice"] for v in (2, 3)]
    for n in range(1020, 1200, 20):
        assert ("MIT", [], []) in found("copyright " * n + mit + " copyright" * 400)
    assert [f[0] for f in found(("\n" + "Rain fell on the hills all night. " * 4).join(versions))] == ["GPL-2.0-notice", "GPL-3.0-notice"]


def test_two_licenses_in_one_block_and_versions():
    text = "Released under the MIT License.\nThis work is licensed under the GNU General Public License, version 2."
    assert [f[0] for f in found(text)] == ["MIT-notice", "GPL-2.0-notice"]
    assert [f[0] for f in found(licenses.TEMPLATES["GPL-3.0-header"])] == ["GPL-3.0-header"]


def test_long_blocks_are_read_whole():
    lines = ["Licensed under CC BY-NC 4.0."] * 900 + [licenses.TEMPLATES["ISC"]] + ["Licensed under CC BY-NC 4.0."] * 100
    got = [f[0] for f in found("\n".join(lines))]
    assert got.count("CC-BY-NC-4.0-notice") == 1000 and got.count("ISC") == 1


def test_odd_rows(spark):
    docs = odd.documents(spark, [*odd.rows(), (200, "Released under the MIT License.", "en", "s"), (None, "Released under the MIT License.", None, None)])
    got = licenses.scan(docs).collect()
    assert sorted((str(r["doc_id"]), r["license"], r["exact"]) for r in got) == [("200", "MIT-notice", True), ("None", "MIT-notice", True)]
    assert licenses.scan(odd.empty(spark)).count() == 0


WORK, GNU = "This work is licensed under", "is licensed under the GNU"
COMMONS = f"{WORK} a Creative Commons"
GPL, LGPL, BSD = licenses.TEMPLATES["GPL-3.0-header"], licenses.TEMPLATES["LGPL-2.1-header"], licenses.CONDITIONS
NEAR_MISSES = {
    f"{COMMONS} Attribution-NonCommercial 4.0 International License.": ["CC-BY-NC-4.0-long-notice"],
    f"{COMMONS} Attribution-ShareAlike 4.0 International License.": ["CC-BY-SA-4.0-notice"],
    f"{COMMONS} Attribution-NoDerivatives 4.0 International License.": ["CC-BY-ND-4.0-notice"],
    f"{COMMONS} Attribution-NonCommercial-ShareAlike 4.0 International License.": ["CC-BY-NC-SA-4.0-notice"],
    f"{COMMONS} Attribution-NonCommercial-NoDerivatives 4.0 International License.": ["CC-BY-NC-ND-4.0-notice"],
    f"{COMMONS} Attribution NonCommercial 4.0 International License.": [],
    f"{COMMONS} Attribution ShareAlike 4.0 International License.": [],
    f"{COMMONS} Attribution 3.0 International License.": [],
    f"{COMMONS} Attribution 2.5 International License.": [],
    f"{COMMONS} 4.0 International License.": [],
    f"{COMMONS} Attribution v4 International License.": ["CC-BY-4.0-notice"],
    "Licensed under CC BY-NC-SA 4.0.": [],
    "Licensed under CC BY-NC 3.0.": [],
    "Licensed under CC BY-NC.": [],
    "Licensed under the Apache License, Version 1.1.": [],
    "Licensed under the Apache License.": [],
    "Licensed under the License, Version 2.0.": [],
    f"This work {GNU} General Public License, version 4.": [],
    f"This work {GNU} General Public License, version 1.": [],
    f"This work {GNU} General Public License, version 2.0.": ["GPL-2.0-notice"],
    f"This work {GNU} General Public License, v3.": ["GPL-3.0-notice"],
    f"This work {GNU} Lesser General Public License, version 3.": ["LGPL-3.0-notice"],
    f"This work {GNU} Lesser General Public License, version 2.": [],
    f"This work {GNU} Affero General Public License, version 3.": ["AGPL-3.0-notice"],
    f"This work {GNU} Affero General Public License, version 2.": [],
    "It is not released under the MIT License.": [],
    "It was never released under the MIT License.": [],
    "It is no longer released under the MIT License.": [],
    "You may not. Released under the MIT License.": ["MIT-notice"],
    "Released under the modified MIT License.": [],
    "Released under the License.": [],
    "Released under the BSD License.": [],
    GPL.replace("version 3", "version 4"): [],
    GPL.replace("General", "Lesser General"): ["LGPL-3.0-header"],
    LGPL.replace("2.1", "3"): ["LGPL-3.0-header"],
    LGPL.replace("2.1", "2"): [],
    LGPL.replace("Lesser", "Affero"): [],
    BSD + licenses.ENDORSING: ["BSD-3-Clause"],
    BSD + licenses.ADVERTISING + licenses.ENDORSING: ["BSD-4-Clause"],
    BSD + licenses.ADVERTISING.replace("the organization", "the many people of a society of writers " * 6): [],
    licenses.TEMPLATES["MIT"].replace("shall be included", "shall not be included"): [],
    "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions.": ["Apache-2.0-text"],
    "GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc.": ["GPL-3.0-text"],
    "GNU LESSER GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007": ["LGPL-3.0-text"],
    "GNU GENERAL PUBLIC LICENSE\n Version 1, February 1989": [],
}


def test_no_near_miss_is_named_wrongly():
    assert {text: [f[0] for f in found(text)] for text in NEAR_MISSES} == NEAR_MISSES
    for text, names in NEAR_MISSES.items():
        inside = f"Rain fell on the hills all night. {text}\nThe river rose by noon, and the road was closed."
        assert [f[0] for f in found(inside)] == names, inside


def test_lists_may_be_numbered_and_what_follows_is_told():
    numbered = BSD.replace("met: Redistributions", "met: 1. Redistributions").replace("disclaimer. Redistributions", "disclaimer. 2. Redistributions")
    assert found(numbered) == [("BSD-2-Clause", [], ["1", "2"])]
    (finding,) = licenses.Scanner(licenses.TEMPLATES).block("Released under the MIT License. The river rose by noon.")
    assert finding[6] == ["the", "river", "rose", "by", "noon"]
