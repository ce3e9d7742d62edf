from tessera.llm import licences as lic

MIT = """# Permission is hereby granted, free of charge, to any person obtaining a copy
# of this software and associated documentation files.
#
# The above copyright notice and this permission notice shall be included in all copies.
#
# THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND."""
APACHE = """/* Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *     http://www.apache.org/licenses/LICENSE-2.0 */"""
CASES = [
    (1, MIT, ["MIT"]), (2, APACHE, ["Apache-2.0"]), (3, None, []), (4, "", []), (5, "nothing to see here.", []),
    (6, "Text.\nLicensed under CC BY-NC 4.0.\nMore.", ["CC-BY-NC"]), (7, "We have a licence of our own.", []),
    (8, "This work is licensed under the GNU General Public License, version 3.\nReleased under the MIT License.",
     ["MIT", "GPL-3.0"]),
    (9, "licensed under the GNU Lesser General Public License, version 3", ["LGPL-3.0"]),
    (10, "Copyright (c) 2020 Someone.\nAll rights reserved.", ["Proprietary"]),
    (11, "word " * 100000 + "\nLicensed under CC BY 4.0.", ["CC-BY"]), (None, "SPDX-License-Identifier: MIT", ["MIT"]),
    (12, "Released under the MIT License. " * 3, ["MIT"]),
]


def test_rules(spark):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t, _ in CASES],
                               "doc_id long, text string, licences string, sentences int")
    got = {r["doc_id"]: r for r in lic.scan(df.unionByName(df)).collect()}
    assert {i: sorted(set(r["licences"])) for i, r in got.items()} == {i: sorted(w) for i, _, w in CASES}
    assert lic.scan(df.unionByName(df)).count() == 2 * len(CASES)
    assert got[7]["identifiers"] == [lic.UNKNOWN]
    assert got[1]["identifiers"] == ["mit_grant", "mit_condition", "as_is_warranty"]


def gnu(name, version, end="", mark=":", comma=",", lead="# "):
    """The header as the licence's own appendix words it."""
    lines = [f"This program is free software{mark} you can redistribute it and/or modify",
             f"it under the terms of the GNU {name}General Public License as published by",
             f"the Free Software Foundation{comma} {version} of the License{end}.", "",
             "This program is distributed in the hope that it will be useful,",
             "but WITHOUT ANY WARRANTY; without even the implied warranty of",
             f"MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU {name}",
             "General Public License for more details.", "",
             f"You should have received a copy of the GNU {name}General Public License",
             "along with this program.  If not, see <https://www.gnu.org/licenses/>."]
    return "\n".join((lead + line).rstrip() for line in lines) + "\n\nimport os\n"


def test_gnu_headers(spark):
    later = ", or\n# (at your option) any later version"
    cases = [
        (gnu("", "either version 3", later), "gpl_3_published_later", "GPL-3.0-or-later"),
        (gnu("", "either version 2", later.replace("# ", " * "), ";", ";", " * "), "gpl_2_published_later",
         "GPL-2.0-or-later"),
        (gnu("", "version 2", "", ";", ";", "// "), "gpl_2_published", "GPL-2.0"),
        (gnu("Lesser ", "either version 2.1", later, ";", ";"), "lgpl_21_published_later", "LGPL-2.1-or-later"),
        (gnu("Library ", "either version 2", later, ";", ";"), "lgpl_2_published_later", "LGPL-2.0-or-later"),
        (gnu("Lesser ", "either version 3", later), "lgpl_3_published_later", "LGPL-3.0-or-later"),
        (gnu("Affero ", "either version 3", later), "agpl_3_published_later", "AGPL-3.0-or-later"),
        (gnu("Affero ", "version 3"), "agpl_3_published", "AGPL-3.0")]
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in lic.scan(df).collect()}
    for i, (_, notice, licence) in enumerate(cases):
        assert got[i]["identifiers"] == [notice, "gpl_no_warranty", "gpl_details", "gpl_received", "gpl_address"]
        assert got[i]["licences"] == [licence]
    alone = spark.createDataFrame([(1, gnu("", "either version 3", later).split("\n#\n")[0])],
                                  "doc_id long, text string")
    assert [r["licences"] for r in lic.scan(alone).collect()] == [["GPL-3.0-or-later"]]


BSD_2 = """// Copyright (c) 2020, Some One
// All rights reserved.
//
// Redistribution and use in source and binary forms, with or without
// modification, are permitted provided that the following conditions are met:
//
// 1. Redistributions of source code must retain the above copyright notice, this
//    list of conditions and the following disclaimer.
//
// 2. Redistributions in binary form must reproduce the above copyright notice,
//    this list of conditions and the following disclaimer in the documentation
//    and/or other materials provided with the distribution.
"""
APACHE_HEADER = """# Copyright 2020 Some One
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at http://mozilla.org/MPL/2.0/. */"""
EPL = """This program and the accompanying materials are made available under the
terms of the Eclipse Public License 2.0 which is available at
https://www.eclipse.org/legal/epl-2.0/"""
SPDX = "// SPDX-License-Identifier: "
HEADERS = [
    (BSD_2, ["BSD-2-Clause"]), (APACHE_HEADER, ["Apache-2.0"]), (MPL, ["MPL-2.0"]), (EPL, ["EPL-2.0"]),
    (EPL.replace("License 2.0", "License v1.0"), ["EPL-1.0"]),
    ("This is under the GNU Library General Public License, version 2.", ["LGPL-2.0"]),
    ("This file is not licensed under the MIT license.", []),
    (SPDX + "Apache-2.0 OR MIT", ["Apache-2.0", "MIT"]), (SPDX + "GPL-2.0-or-later", ["GPL-2.0-or-later"]),
    (SPDX + "MIT-0\nimport os", ["MIT-0"]), (SPDX + "LGPL-2.1-only */", ["LGPL-2.1"]), (SPDX + "MPL-2.0.", ["MPL-2.0"]),
    (SPDX + "GPL-2.0+ WITH Classpath-exception-2.0", ["GPL-2.0-or-later"]),
    (SPDX + "(MIT OR GPL-3.0-only) AND BSD-3-Clause\nint x;", ["BSD-3-Clause", "GPL-3.0", "MIT"]),
    (SPDX + "((Apache-2.0) OR (MIT))", ["Apache-2.0", "MIT"]), (SPDX + "LicenseRef-own", []),
    (SPDX, []), ("SPDX-License-Identifier:MIT", ["MIT"]),
    (SPDX + "ISC\n// Copyright (c) 2020 X.\n// All rights reserved.", ["ISC"])]


def test_published_headers(spark):
    df = spark.createDataFrame(list(enumerate(t for t, _ in HEADERS)), "doc_id long, text string")
    got = {r["doc_id"]: sorted(r["licences"]) for r in lic.scan(df).collect()}
    assert {HEADERS[i][0]: g for i, g in got.items()} == dict(HEADERS)


def test_no_python_in_the_plan(spark):
    from tessera.llm.queries import QUERIES
    df = QUERIES["op6_licence_scan"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_empty(spark, none):
    assert lic.scan(none).count() == 0
