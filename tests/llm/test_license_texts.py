"""Licence files, wrapped headers, SPDX tags and notices inside long lines."""

import os

import pytest

from hearth.llm import license_scan

HERE = os.path.join(os.path.dirname(os.path.abspath(__file__)), "licenses")
BODY = "\n".join(f"def f{i}(x):\n    return g{i}(x, k{i})" for i in range(40))
APACHE = """# Copyright 2020 Some Body
#
# Licensed under the Apache License, Version 2.0 (the "License"); you may not
# use this file except in compliance with the License. You may obtain a copy of
# the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
"""
GPL2 = """/*
 * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; either version 2 of the License, or
 * (at your option) any later version.
 */
"""


def real(name):
    with open(f"{HERE}/{name}.txt", encoding="utf-8") as f:
        return f.read()


def test_real_license_files_speak_for_their_directories(spark):
    rows, want = [], {}
    for i, (folder, file) in enumerate((("m", "urllib3_MIT"), ("a", "requests_Apache-2.0"), ("b", "psutil_BSD-3-Clause"))):
        rows += [(2 * i, f"{folder}/LICENSE", real(file)), (2 * i + 1, f"{folder}/src/x", BODY)]
        want |= {2 * i: (file.split("_")[1], "file", None), 2 * i + 1: (file.split("_")[1], "inherited", folder)}
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()
    assert {r.doc_id: (r.license, r.origin, r.from_dir) for r in got} == want
    assert all(r.cosine >= 0.9 for r in got if r.origin == "file")


HEADERS = [
    ("Apache-2.0", "// SPDX-License-Identifier: Apache-2.0"), ("GPL-3.0", "/* SPDX-License-Identifier: GPL-3.0-only */"),
    ("MIT", "# SPDX-License-Identifier: MIT"), ("EUPL-1.2", "# SPDX-License-Identifier: EUPL-1.2"),
    ("GPL-2.0", "# SPDX-License-Identifier: (GPL-2.0-or-later WITH Classpath-exception-2.0 OR MIT)"),
    ("MIT", "This software is licensed under the MIT license."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0. What follows on the line is prose of some length that tells of other things."),
    ("Apache-2.0", APACHE), ("GPL-2.0", GPL2), ("MIT", "".join(f"// {x}\n" for x in real("urllib3_MIT").split("\n"))),
    ("BSD-3-Clause", "".join(f" * {x}\n" for x in real("psutil_BSD-3-Clause").split("\n"))),
    (None, "This software is licensed under the Foo license."), (None, "# SPDX-License-Identifier: NONE"),
    (None, "The driver's licence of a person is of no matter here, and neither is the copyright of a book."),
]


def test_headers_tags_and_notices_inside_lines(spark):
    rows = [(i, f"d{i}/x", f"{head}\n{BODY}\n") for i, (_, head) in enumerate(HEADERS)]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    for i, (name, head) in enumerate(HEADERS):
        assert (got[i].license, got[i].origin) == (name, "header" if name else "none"), head


@pytest.mark.parametrize("name, text", license_scan.license_texts())
def test_every_full_text_is_its_own_license(name, text):
    scorer = license_scan.Scorer(license_scan.TEMPLATES, license_scan.license_texts(), license_scan.MIN_COSINE)
    assert scorer.judge("Copyright 2001 A. Holder\n" + text, license_scan.FILE_SHARE)[::2] == (name, True)
