import helpers as h
import pytest
from compare import assert_same, oracle

from textloom.llm import licences, queries

MIT = """MIT License

Copyright (c) 2024 Some Author

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD = """Copyright (c) 2024, Some Author

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
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
GPL = """This program is free software{} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version {} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""


def test_verbatim_wrapped_notices(spark):
    values = [MIT, BSD, APACHE, GPL.format(":", 3), GPL.format(";", 2), MIT.replace("\n", "\r\n"), "Intro\nReleased under the MIT License\nmore", "We have\nno licence here"]
    out = {r["doc_id"]: r for r in licences.digest(h.frame(spark, values)).collect()}
    assert [out[d]["licence"] for d in range(8)] == ["MIT", "BSD-3-Clause", "Apache-2.0", "GPL-3.0-or-later", "GPL-2.0-or-later", "MIT", "MIT", None]
    assert [out[d]["rules"].split(",")[0] for d in range(8)] == ["mit-full", "bsd3-full", "apache-full", "gpl3-full", "gpl2-full", "mit-full", "mit-name", ""]
    assert "gpl3-notice" in out[3]["rules"] and "gpl2-notice" in out[4]["rules"] and out[0]["n_known"] == 2 and "bsd3-text" in out[1]["rules"]


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_larger_tables_equal_the_sql(spark, size):
    sf = f"/root/testdata/{size}"
    assert_same(queries.QUERIES["op6_licences"](spark, sf), oracle(sf, licences.ORACLE))


def test_two_hundred_sentences_load(spark):
    sentences = {f"s{k}": f"known sentence number n{k} of the list" for k in range(200)}
    rules = [(f"r{k}", f"L{k}", (f"s{k}", f"s{(k + 1) % 200}")) for k in range(200)]
    rows = h.frame(spark, ["Known sentence number n31 of the list. Known sentence number n32 of the list.", "Known sentence number\n# n199 of the list. x. Known sentence number n0 of the list", "n31"])
    out = {r["doc_id"]: (r["rules"], r["licence"], r["n_known"]) for r in licences.scan(rows, sentences=sentences, rules=rules).collect()}
    assert out == {0: ("r31", "L31", 2), 1: ("r199", "L199", 2), 2: ("", None, 0)}


def test_the_sql_reads_wrapped_texts_too(spark, tmp_path):
    values = [MIT, BSD, APACHE, GPL.format(":", 3), GPL.format(";", 2), "SPDX-License-Identifier: MIT", "// SPDX-License-Identifier: BSD-3-Clause", None, "", "a. 1. b"]
    h.frame(spark, values).coalesce(1).write.parquet(f"{tmp_path}/t")
    next((tmp_path / "t").glob("*.parquet")).rename(tmp_path / "documents.parquet")
    for t in ("pages", "benchmark", "labels", "conversations"):
        (tmp_path / f"{t}.parquet").symlink_to(tmp_path / "documents.parquet")
    assert_same(queries.QUERIES["op6_licences"](spark, str(tmp_path)), oracle(str(tmp_path), licences.ORACLE))
