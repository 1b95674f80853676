"""Licence rules in wrapped texts, and the SPDX short name of every family."""

import re

import pytest

from periodgrid.llm import licences

SHORT = """MIT mit|Apache-1.1 apache-1.1|Apache-2.0 apache-2.0|GPL-2.0-or-later gpl-2|GPL-3.0-only gpl-3|LGPL-2.1-only lgpl-2.1
LGPL-3.0-or-later lgpl-3|AGPL-3.0-only agpl-3|BSD-3-Clause bsd|BSD-1-Clause bsd|0BSD bsd|MPL-2.0 mpl-2.0|EPL-2.0 epl-2.0|CDDL-1.0 cddl-1.0
CC-BY-4.0 cc-by-4.0|CC-BY-NC-SA-3.0 cc-by-3.0|CC0-1.0 cc0-1.0|ISC isc|Zlib zlib|BSL-1.0 boost-1.0|Artistic-2.0 artistic-2.0
Unlicense unlicense|WTFPL wtfpl|OSL-3.0 osl-3.0|AFL-3.0 afl-3.0|EUPL-1.2 eupl-1.2|OFL-1.1 ofl-1.1|PSF-2.0 psf-2.0|Python-2.0 psf-2.0
PostgreSQL postgresql|OpenSSL openssl|MS-PL ms-pl|MS-RL ms-rl|ODbL-1.0 odbl-1.0|UPL-1.0 upl-1.0|GFDL-1.3-or-later fdl-1.3
W3C w3c|NCSA ncsa|BlueOak-1.0.0 blueoak-1.0.0"""


@pytest.fixture(scope="module")
def scanner():
    return licences.Scanner()


def test_short_names_of_every_family(scanner):
    pairs = [entry.split(" ") for line in SHORT.splitlines() for entry in line.split("|")]
    for name, label in pairs:
        kept = [(r.label, r.form, text[s:e]) for text in [f"spdx-license-identifier: {name.lower()}"] for s, e, r in scanner.scan(text)[1]]
        assert kept and kept[0][:2] == (label, "identifier") and kept[0][2].endswith(name.lower()), (name, kept)
    assert {label for label, _, _ in licences.FAMILIES} == {label.split("-")[0] if label[:2] not in ("cc", "ms") else label.split("-4")[0].split("-3")[0].split("-1")[0] for _, label in pairs}


@pytest.mark.parametrize("text, label", [
    ("creative\ncommons attribution license", "cc-by"),
    ("the gnu general\n * public license, version 3", "gpl-3"),
    ("gnu library general public license", "lgpl"),
    ("all\n// rights   reserved", "proprietary"),
    ("permission is hereby\n# granted, free of charge", "mit"),
    ("permission is hereby granted, free of charge, to any person obtaining a copy", "mit"),
    ("redistribution\nand use in source and binary forms, with or without modification", "bsd"),
    ("http://www.apache.org/licenses/license-2.0", "apache"),
    ("released into the\n public   domain", "public-domain"),
])
def test_wrapped_texts(spark, scanner, text, label):
    assert label in {r.label for _, _, r in scanner.scan(text)[1]}
    row = licences.scan_licences(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert label in row.labels.split(",") and row.score > 0


def test_keywords_leave_no_match_out(scanner):
    """Whatever stands in a text, the rules behind the keywords find what all rules find."""
    texts = [f"x {form.replace('VERSION', '2.0')} y" for name in ("GNU Library General Public", "SIL Open Font", "Creative--Commons", "BSD 3-Clause", "common development\nand distribution", "cc0")
             for form in (f"licensed under the terms of the {name} license version VERSION", f"{name} license", f"see file copying for the {name}", f"spdx-license-identifier: {name}")]
    for text in (t.lower() for t in texts):
        every = [(m.start(), m.end(), r) for r in licences.rules() for m in r.pattern.finditer(text)]
        got = [(s, e, r.label, r.form) for s, e, r in scanner.scan(text)[1]]
        assert got == [(s, e, r.label, r.form) for s, e, r in licences.suppress(every)]
    assert all(rule.keyword and re.fullmatch("[a-z0-9. ]+", rule.keyword) for rule in licences.rules())
