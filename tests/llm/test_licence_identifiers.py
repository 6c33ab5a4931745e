"""Identifiers of no known family after a tag, and words before a licence in prose."""

from curastra.llm import licences

TEXTS = {
    "Licensed under the GPL-3.0-or-later": ("gpl", False),
    "licensed under the terms of the MPL-2.0, see": ("mpl", False),
    "Licensed under the terms and conditions of either MIT or Apache-2.0": ("apache,mit", True),
    "Licensed under an agreement and MIT": ("", None),
    "Licensed under MIT and then some": ("mit", True),
    "SPDX-License-Identifier: (LicenseRef-X OR MIT)": ("licenseref-x,mit", False),
    "SPDX-License-Identifier: WTFPL AND GPL-2.0-only": ("gpl,wtfpl", False),
    "# SPDX-License-Identifier: Artistic-2.0": ("artistic-2.0", False),
    "SPDX-License-Identifier: EUPL-1.2 OR curl": ("curl,eupl-1.2", False),
    "SPDX-License-Identifier: GPLv3 -->": ("gplv3", False),
    "/* SPDX-License-Identifier: PSF-2.0 */": ("psf-2.0", False),
    "SPDX-License-Identifier: DocumentRef-a:LicenseRef-b AND MIT": ("documentref-a:licenseref-b,mit", False),
    "SPDX-License-Identifier: MIT and then we": ("mit", True),
    "SPDX-License-Identifier: GPL-2.0 WITH Linux-syscall-note": ("gpl", False),
    "SPDX-License-Identifier: NONE": ("", None),
    "An SPDX-License-Identifier is needed": ("", None),
}


def test_unknown_identifiers_and_words_before(spark):
    rows = licences.scan(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")).collect()
    got = {r.doc_id: (r.labels, r.permissive) for r in rows}
    assert [got[i] for i in range(len(TEXTS))] == list(TEXTS.values())
    assert all((r.score > 0.9) == bool(r.labels) for r in rows)
