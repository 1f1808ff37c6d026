"""Licence tags and names that stand in one line."""

import pytest

from rapport.llm import licenses

LINES = {
    "// SPDX-License-Identifier: MIT": ["MIT"],
    "# SPDX-License-Identifier: Apache-2.0": ["Apache-2.0"],
    "/* SPDX-License-Identifier: GPL-2.0-or-later */": ["GPL-or-later"],
    "SPDX-License-Identifier: GPL-2.0-only": ["GPL-2.0"],
    "SPDX-License-Identifier: LGPL-2.1-or-later": ["LGPL-or-later"],
    "SPDX-License-Identifier: BSD-3-Clause": ["BSD-3-Clause"],
    "SPDX-License-Identifier: CC0-1.0": ["CC0-1.0"],
    "SPDX-License-Identifier: LicenseRef-Own": ["SPDX-tagged"],
    "Cc: By all means, come in": [],
    "Please cc by mail": [],
    "Licensed under CC BY 4.0.": ["CC-BY"],
    "Licensed under CC BY-NC 4.0.": ["CC-BY-NC"],
    "Creative Commons Attribution 3.0": ["CC-BY"],
    "Distributed under the Boost Software License, Version 1.0.": ["BSL-1.0"],
    "Under the zlib license": ["Zlib"],
    "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE": ["WTFPL"],
}


@pytest.fixture(scope="module")
def found(spark):
    rows = spark.createDataFrame(list(enumerate(LINES)), "doc_id long, text string")
    return {r.doc_id: r.licenses for r in licenses.licenses(rows).collect()}


@pytest.mark.parametrize("at", range(len(LINES)))
def test_line(found, at):
    assert found[at] == list(LINES.values())[at]
