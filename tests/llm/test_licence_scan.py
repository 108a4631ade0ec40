import re

from tidemart.llm import licence_scan as ls
from tidemart.llm.licence_rules import NAMES, RULES, SENTENCES, WORDINGS


def brute(text):
    """Licences, rules and known sentences of a text, in plain Python."""
    def sequence(cut):
        out = []
        for sentence in re.split(cut, text or ""):
            plain = ls.plain_text(sentence) if re.search(ls.CUE, sentence) else ""
            if plain in ls.KNOWN or plain.startswith(ls.BARRIER):
                out.append(ls.KNOWN.get(plain, "!"))
                continue
            names = [n for chain in re.findall(ls.NOTICE, plain) for n in re.findall(f"({ls.NAME})", chain)]
            out += [ls.SAID[re.sub(f"{ls.LATER}$", " or later", n)] for n in names] or [None]
        return out

    both = [sequence(ls.AT_LINES), sequence(ls.AT_ENDS)]
    rules, licences = [], set()
    for licence, sentences in RULES:
        own = [ls.KNOWN[ls.plain_text(SENTENCES[x])] if x in SENTENCES else x for x in sentences]

        def holds(seq, own=own):
            def follow(at, left):
                if not left:
                    return True
                for step in range(ls.GAP + 1):
                    place = at + 1 + step
                    if place >= len(seq):
                        return False
                    if seq[place] is not None:
                        return seq[place] == left[0] and follow(place, left[1:])
                return False
            return any(seq[i] == own[0] and follow(i, own[1:]) for i in range(len(seq)))

        if any(holds(s) for s in both):
            rules.append("+".join(sentences))
            licences.add(licence)
    return sorted(licences), rules, sum(x not in (None, "!") for x in both[0])


def wrapped(names, width=60, gap=""):
    import textwrap
    return "\n".join(textwrap.wrap(" ".join(f"{SENTENCES[n]} {gap}" for n in names), width))


MIT = ["mit-grant", "mit-keep", "mit-as-is", "mit-liable"]
BSD = ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is"]
TEXTS = [
    None, "", "Nothing of the kind. No license here.", "Text.\nLicensed under CC BY-NC 4.0.\nMore text.", "Released under the MIT License.",
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0.",
    "foo bar.  This project is released under the terms of the BSD 3-Clause Licence! And on.", "// SPDX-License-Identifier: MIT\nint x;",
    wrapped(MIT), wrapped(reversed(MIT)), wrapped(BSD), wrapped(BSD[:3] + BSD[4:]), wrapped(MIT[:3]), wrapped(MIT[:2]),
    wrapped(MIT, gap="Unknown. Words. Here."), wrapped(MIT, gap="Too. Many. Unknown. Words."), "\n".join(SENTENCES[n] for n in BSD).upper(),
    wrapped(["apache-grant", "apache-comply", "apache-obtain", "apache-unless", "apache-see"]),
    wrapped(["gpl-3.0-or-later-terms", "gpl-hope", "gpl-see"]), wrapped(["mpl-subject", "mpl-copy"]),
    "License: MIT\nAll rights reserved.", "the license of the MIT", "x " * 100_000 + "\nLicensed under the ISC License.\n",
    "Released under the MIT License. Released under the MIT License.\n" + wrapped(MIT), "Licensed under\nthe MIT License.",
]


def test_equals_brute_force(spark):
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(TEXTS)] + [(None, TEXTS[4], 7), (4, TEXTS[4], 7)],
                                 "doc_id long, text string, known int")
    rows = ls.scan(docs).collect()
    assert len(rows) == len(TEXTS) + 2
    for row in rows:
        assert (row.licences, row.rules, row.known) == brute(row.text), row.text
    got = {r.doc_id: r.licences for r in rows if r.doc_id is not None}
    assert got[3] == ["CC-BY-NC-4.0"] and got[4] == ["MIT"] and got[5] == ["GPL-3.0"] and got[6] == ["Apache-2.0"] and got[7] == ["BSD-3-Clause"]
    assert got[8] == got[9] == got[13] == got[15] == got[25] == ["MIT"] and got[10] == got[14] == got[16] == got[22] == []
    assert got[11] == got[17] == ["BSD-3-Clause"] and got[12] == ["BSD-2-Clause"] and got[19] == ["GPL-3.0-or-later"]


ORG = "Neither the name of Google Inc. nor the names of its contributors may be used to endorse or promote products " \
      "derived from this software without specific prior written permission."
OTHER_ORG = ORG.replace("Google Inc. nor the names of its contributors", "Example")
FORMS = {
    "Foo is released under the MIT License.": ["MIT"],
    "Licensed under the MIT License, see LICENSE.": ["MIT"],
    "This code is licensed under the MIT license (see LICENSE file)": ["MIT"],
    "SPDX-License-Identifier: GPL-2.0-or-later": ["GPL-2.0-or-later"],
    "# SPDX-License-Identifier: GPL-2.0-only": ["GPL-2.0-only"],
    "/* SPDX-License-Identifier: GPL-2.0+ */": ["GPL-2.0-or-later"],
    "SPDX-License-Identifier: (MIT OR Apache-2.0)": ["Apache-2.0", "MIT"],
    "SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note\nint main;": ["GPL-2.0-only", "Linux-syscall-note"],
    "SPDX-License-Identifier: GPL-2.0 AND BSD-3-Clause": ["BSD-3-Clause", "GPL-2.0"],
    "Licensed under either of Apache License, Version 2.0 or the MIT license at your option.": ["Apache-2.0", "MIT"],
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": ["CC-BY-4.0"],
    "It is distributed under the GNU General Public License, version 3 or any later version.": ["GPL-3.0-or-later"],
    "Use of this source code is governed by the Apache License 2.0, which is in the file.": ["Apache-2.0"],
    "This is not licensed under the MIT License.": [], "Released under the MIT Press agreement.": [], "Released under an MIT-style license.": [],
    "Released under the GPL 2.7 license.": [], "The book was published by the author in 2003.": [],
    wrapped(["bsd-grant", "bsd-source", "bsd-binary"]) + "\n" + ORG + "\n" + SENTENCES["bsd-as-is"]: ["BSD-3-Clause"],
    wrapped(["bsd-grant", "bsd-source", "bsd-binary"]) + "\n3. " + OTHER_ORG + "\n" + SENTENCES["bsd-as-is"]: ["BSD-3-Clause"],
    # An unknown third clause is no gap, whatever it says.
    wrapped(["bsd-grant", "bsd-source", "bsd-binary"]) + "\nNeither the name of X nor anything else may be sold.\n" + SENTENCES["bsd-as-is"]: [],
    wrapped(["bsd-grant", "bsd-source", "bsd-binary", "bsd-advert"]) + " This product includes software of X. " + ORG + " "
    + SENTENCES["bsd-as-is"]: ["BSD-4-Clause"],
    wrapped(["bsd-grant", "bsd-source", "bsd-binary"]) + "\n" + SENTENCES["bsd-as-is"].replace(
        "THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE REGENTS OF SOME UNIVERSITY"): ["BSD-2-Clause"],
    SENTENCES["bsd-grant"] + "\n\n  1) " + SENTENCES["bsd-source"] + "\n\n  2) " + SENTENCES["bsd-binary"] + "\n\n"
    + SENTENCES["bsd-as-is"].replace("HOLDERS", "OWNERS"): ["BSD-2-Clause"],
    wrapped(MIT).replace("NONINFRINGEMENT", "NON-INFRINGEMENT").replace("permission notice", "permission notice (including the next paragraph)"): ["MIT"],
    wrapped(["isc-grant", "isc-as-is"]).replace("and/or", "and").replace("THE AUTHOR", "SOMEBODY ELSE"): ["ISC"],
    "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License version 2 as\n"
    "published by the Free Software Foundation.": ["GPL-2.0-only"],
    "Foo is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
    "the Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.": ["GPL-2.0-or-later"],
    "\n\n".join(SENTENCES[x] for x in ("apache-obtain", "apache-unless", "apache-see")).replace("http://", "https://"): ["Apache-2.0"],
    "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n"
    + wrapped(["apache-unless", "apache-see"]): ["Apache-2.0"],
    "Eclipse Public License - v 2.0\n\n    " + wrapped(["epl-provided"]): ["EPL-2.0"], wrapped(["bsl-grant", "bsl-keep"]): ["BSL-1.0"],
    wrapped(["cc0-deed"]): ["CC0-1.0"], wrapped(["cc0-owner"]): ["CC0-1.0"], wrapped(["cc-by-sa-4.0-bound"]): ["CC-BY-SA-4.0"],
    "To the extent possible under law, Jane Roe has waived all copyright and related or neighboring rights to The Great Work.": ["CC0-1.0"],
    "Copyright (c) 2020 Foo Inc. All rights reserved.": ["all rights reserved"],
}


def test_forms_of_notices_and_texts(spark):
    docs = spark.createDataFrame(list(enumerate(FORMS)), "doc_id long, text string")
    for row in ls.scan(docs).collect():
        assert (row.licences, row.rules, row.known) == brute(row.text), row.text
        assert row.licences == FORMS[row.text], (row.text, row.licences)


def test_every_name_and_sentence_is_known_and_cued():
    for name in SENTENCES:
        for said in [SENTENCES[name], *WORDINGS.get(name, [])]:
            assert re.search(ls.CUE, said), name
            assert ls.KNOWN[ls.plain_text(said)]
    for licence, names in NAMES.items():
        for name in names:
            assert brute(f"Released under the {name}.")[0] == [licence] == brute(f"SPDX-License-Identifier: {name}")[0], name


def test_native_plan(spark):
    plan = ls.scan(spark.createDataFrame([(1, "x")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Exchange", plan)
    assert ls.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
