from helpers import ODD, frame, sentences

from tillhouse.llm.licenses import MIN_COVERAGE, TEMPLATES, Index, align, find_licenses, scan_licenses

INDEX = Index(TEMPLATES)


def found(text, least=MIN_COVERAGE):
    return find_licenses(INDEX, text.encode(), least)


def test_every_template_is_found_whole_where_it_stands():
    for name, template in TEMPLATES.items():
        text = "Some prose of the corpus.\n" + template + "\nand more, é."
        match = {m[0]: m for m in found(text)}[name]
        assert match[1] == 1.0
        assert text[match[4]:match[5]].lower().split()[0] == template.lower().split()[0]
        assert match[6][0]["start"] == match[4] and match[6][-1]["end"] == match[5]


def test_edits_lower_the_coverage():
    text = TEMPLATES["MIT-text"].replace("including", "incl.").replace("merge, ", "").replace("persons to", "persons, well, to")
    match = found("x " + text)[0]
    assert match[0] == "MIT-text" and .9 < match[1] < 1 and len(match[6]) >= 3
    half = " ".join(TEMPLATES["MIT-text"].split()[:40])
    assert found(half) == [] and found(half, .4)[0][0] == "MIT-text"


def test_repeats_and_clean_texts():
    assert [m[0] for m in found("Released under the MIT License. " * 3)] == ["MIT"] * 3
    for text in [*sentences(20, 200), "the license of the software is here", "", "under the MIT"]:
        assert found(text) == []


def test_alignment_is_a_longest_common_subsequence():
    import random

    import numpy as np
    rng = random.Random(0)
    for _ in range(30):
        a, b = ([rng.randint(0, 3) for _ in range(rng.randint(1, 12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        pairs = align(np.array(a), np.array(b), 0, band=13)
        assert len(pairs) == best[-1][-1] and all(a[i] == b[j] for i, j in pairs)
        assert pairs == sorted(pairs) and len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs)


def test_job(spark):
    rows = [*ODD, (50, "Licensed under CC BY-NC 4.0."), (None, "x Released under the MIT License"), (51, "ü " * 9 + "released under THE mit license")]
    got = scan_licenses(frame(spark, rows).selectExpr("*", "'z' as license")).collect()
    assert sorted(((r.doc_id or 0, r.license, r.start_char) for r in got)) == [(0, "MIT", 2), (50, "CC-BY-NC-4.0", 0), (51, "MIT", 18)]
    assert scan_licenses(frame(spark, rows).limit(0)).count() == 0


def names(text):
    return [m[0] for m in found(text)]


def test_near_misses_are_not_another_license():
    assert names("Licensed under CC BY 4.0.") == ["CC-BY-4.0-short"]
    assert names("Licensed under CC BY-NC 4.0.") == ["CC-BY-NC-4.0"]
    assert names("Licensed under CC BY-NC-SA 4.0.") == ["CC-BY-NC-SA-4.0"]
    assert names("Licensed under CC BY 3.0.") == []
    assert names("This work is licensed under the GNU General Public License, version 2.") == ["GPL-2.0"]
    assert names("This work is licensed under the GNU General Public License, version 4.") == []
    assert names("This work is licensed under the GNU Lesser General Public License, version 2.") == []
    assert names("Licensed under the Apache License, Version 1.1.") == []
    assert names("Released under the XYZ License.") == []
    assert names("Distributed under the MIT License.") == ["MIT"]
    sa = "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    assert names(sa) == ["CC-BY-SA-4.0"] and names(sa.replace("-ShareAlike", "-NoDerivatives")) == []


def test_each_template_stands_for_itself_alone_and_beside_others():
    for name, template in TEMPLATES.items():
        assert names("Some prose.\n" + template + "\nand more") == [name]
    both = TEMPLATES["BSD-2-Clause"] + " and " + TEMPLATES["MIT"] + " " + TEMPLATES["GPL-2.0-header"]
    assert names(both) == ["BSD-2-Clause", "MIT", "GPL-2.0-header"]


def test_edited_headers_keep_their_version():
    for name in ("GPL-2.0-header", "GPL-3.0-header", "LGPL-2.1-header", "LGPL-3.0-header", "AGPL-3.0-header", "BSD-3-Clause"):
        edited = TEMPLATES[name].replace("distributed in the hope", "given in the hope").replace("this software", "the work")
        assert names("x " + edited) == [name]
