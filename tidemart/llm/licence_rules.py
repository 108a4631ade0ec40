"""Known licence sentences, names of licences, and the rules over sentences.

Fixed values: the sentences are those of the published licence texts.
"""

from __future__ import annotations

# Names that a notice gives a licence.
NAMES = {
    "MIT": ["MIT License", "MIT", "Expat License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License",
                   "Apache 2.0", "Apache-2.0", "Apache Software License 2.0", "Apache License, Version 2", "Apache 2"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "BSD-3-Clause"],
    "ISC": ["ISC License", "ISC"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0", "MPL-2.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "EPL-2.0"],
    "BSL-1.0": ["Boost Software License 1.0", "Boost Software License, Version 1.0", "BSL-1.0"],
    "Zlib": ["zlib License", "Zlib"],
    "Unlicense": ["Unlicense", "Unlicense License"],
    "Linux-syscall-note": ["Linux-syscall-note"],
    "Classpath-exception-2.0": ["Classpath-exception-2.0", "Classpath exception"],
    "GCC-exception-3.1": ["GCC-exception-3.1"],
    "LLVM-exception": ["LLVM-exception", "LLVM exceptions"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "CC0", "Creative Commons Zero v1.0 Universal", "CC0-1.0"],
}
# Licences that a notice may narrow to one version ("only") or widen to later ones.
VERSIONED = []
for _kind, _long in (("GPL", "GNU General Public License"), ("LGPL", "GNU Lesser General Public License"),
                     ("AGPL", "GNU Affero General Public License")):
    for _version in {"GPL": ("2", "3"), "LGPL": ("2.1", "3"), "AGPL": ("3",)}[_kind]:
        _full = _version if "." in _version else f"{_version}.0"
        _said = dict.fromkeys((_version, _full))
        VERSIONED.append(f"{_kind}-{_full}")
        NAMES[f"{_kind}-{_full}"] = [f"{_kind}-{_full}", *(
            name for v in _said for name in (
                f"{_long}, version {v}", f"{_long} version {v}", f"{_long} v{v}", f"{_long} {v}", f"GNU {_kind} v{v}",
                f"GNU {_kind} version {v}", f"{_kind}v{v}", f"{_kind} v{v}", f"{_kind} {v}", f"{_kind} version {v}"))]
_TERMS = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
for _code in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
    _long = "-".join(_TERMS[part] for part in _code.split("-"))
    for _version in ("3.0", "4.0"):
        NAMES[f"CC-{_code}-{_version}"] = [
            f"CC {_code} {_version}", f"CC-{_code}-{_version}", f"Creative Commons {_code} {_version}",
            f"Creative Commons {_long} {_version} License", f"Creative Commons {_long} {_version}",
            f"Creative Commons {_long} {_version} International License", f"Creative Commons {_long} {_version} International"]

# Sentences of licence texts and headers.
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
                 "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
                 "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
                 "following conditions:",
    "mit-keep": "The above copyright notice and this permission notice shall be included in all copies or substantial "
                "portions of the Software.",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
                 "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liable": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
                  "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
                  "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                 "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
                 "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                 "that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                  "following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                  "following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                   "promote products derived from this software without specific prior written permission.",
    "bsd-advert": "All advertising materials mentioning features or use of this software must display the following "
                  "acknowledgement:",
    "bsd-as-is": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
                 "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
                 "PARTICULAR PURPOSE ARE DISCLAIMED.",
    "apache-grant": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-obtain": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-unless": "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                     "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "mpl-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "unlicense-free": "This is free and unencumbered software released into the public domain.",
    "unlicense-anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
                        "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-liable": "In no event will the authors be held liable for any damages arising from the use of this software.",
    "epl-title": "Eclipse Public License - v 2.0",
    "epl-provided": "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (\"AGREEMENT\").",
    "bsl-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
                 "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
                 "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to "
                 "permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    "bsl-keep": "The copyright notices in the Software and this entire statement, including the above license grant, this "
                "restriction and the following disclaimer, must be included in all copies of the Software, in whole or in "
                "part, and all derivative works of the Software, unless such copies or derivative works are solely in the "
                "form of machine-executable object code generated by a source language processor.",
    "cc0-deed": "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of "
                "his or her rights to the work worldwide under copyright law, including all related and neighboring rights, "
                "to the extent allowed by law.",
    "cc0-owner": "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related "
                 "Rights (defined below) upon the creator and subsequent owner(s) (each and all, an \"owner\") of an original "
                 "work of authorship and/or a database (each, a \"Work\").",
    "cc0-waived": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
                  "this work.",
    "reserved": "All rights reserved.",
}

# Further wordings of the same sentences.
WORDINGS = {
    "apache-obtain": ["You may obtain a copy of the License at"],
    "bsd-endorse": ["The name of the author may not be used to endorse or promote products derived from this software without "
                    "specific prior written permission.",
                    "The names of its contributors may not be used to endorse or promote products derived from this software "
                    "without specific prior written permission."],
    "isc-as-is": ["THE SOFTWARE IS PROVIDED \"AS IS\" AND ISC DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
                  "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."],
    "unlicense-free": ["This is free and unencumbered software released to the public domain."],
}

# Wordings that mean the same, and parts that name holders, in normalised sentences: what stands for each.
VARIANTS = [
    ("licence", "license"),
    ("non infringement", "noninfringement"),
    ("and or ", "and "),
    ("https ", "http "),
    ("copyright owner", "copyright holder"),
    (r"^(?:(?:[0-9]{1,2}|i{1,3}|iv) )+(?=redistribution|neither |all advertising |the names? of )", ""),
    (r" including the next paragraph(?= shall be included)", ""),
    (r"^neither the names? of .* nor (?:the )?names of (?:its|their|the|any) contributors (?=may be used)",
     "neither the name of the copyright holder nor the names of its contributors "),
    (r"^neither the name of .*(?= may be used to endorse)(?<!contributors)",
     "neither the name of the copyright holder nor the names of its contributors"),
    (r"^the names? of .*(?= may not be used to endorse)(?<!its contributors)", "the name of the author"),
    (r"(?<=^this software is provided by ).*(?= as is and any express)", "the copyright holders and contributors"),
    (r"(?<=^the software is provided as is and ).*(?= disclaims all warranties)", "the author"),
    (r"(?<=^in no event shall ).*(?= be liable for any claim damages or other liability)", "the authors or copyright holders"),
    (r"(?<=^in no event will the )author(?= be held liable)", "authors"),
    (r"(?<=^to the extent possible under law ).*(?= waived all copyright and related or neighboring rights)", "the author has"),
    (r"(?<=waived all copyright and related or neighboring rights to ).*$", "this work"),
]

# Ordered sentences; other known sentences may not come between, unknown ones may (a few).
RULES = [
    ("MIT", ["mit-grant", "mit-keep", "mit-as-is", "mit-liable"]),
    ("MIT", ["mit-grant", "mit-keep", "mit-as-is"]),
    ("ISC", ["isc-grant", "isc-as-is"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is"]),
    ("Apache-2.0", ["apache-grant", "apache-comply"]),
    ("Apache-2.0", ["apache-obtain", "apache-unless", "apache-see"]),
    ("MPL-2.0", ["mpl-subject", "mpl-copy"]),
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse", "bsd-as-is"]),
    ("EPL-2.0", ["epl-title", "epl-provided"]),
    ("BSL-1.0", ["bsl-grant", "bsl-keep"]),
    ("CC0-1.0", ["cc0-deed"]),
    ("CC0-1.0", ["cc0-owner"]),
    ("CC0-1.0", ["cc0-waived"]),
    ("Unlicense", ["unlicense-free", "unlicense-anyone"]),
    ("Zlib", ["zlib-as-is", "zlib-liable"]),
    ("all rights reserved", ["reserved"]),
]
for _kind, _long, _program in (("GPL", "GNU General Public License", "program"), ("AGPL", "GNU Affero General Public License", "program"),
                               ("LGPL", "GNU Lesser General Public License", "library")):
    SENTENCES[f"{_kind.lower()}-hope"] = (
        f"This {_program} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;")
    SENTENCES[f"{_kind.lower()}-see"] = f"See the {_long} for more details."
    SENTENCES[f"{_kind.lower()}-published"] = (
        f"you can redistribute it and/or modify it under the terms of the {_long} as published by the Free Software Foundation;")
    for _version in {"GPL": ("2", "3"), "LGPL": ("2.1", "3"), "AGPL": ("3",)}[_kind]:
        _full = f"{_kind}-{_version if '.' in _version else _version + '.0'}"
        _later, _only = f"{_full}-or-later", f"{_full}-only"
        SENTENCES[f"{_later.lower()}-terms"] = (
            f"you can redistribute it and/or modify it under the terms of the {_long} as published by the Free Software "
            f"Foundation, either version {_version} of the License, or (at your option) any later version.")
        # The same words after a semicolon, which ends a sentence.
        SENTENCES[f"either-{_version}"] = f"either version {_version} of the License, or (at your option) any later version."
        SENTENCES[f"version-{_version}"] = f"version {_version} of the License."
        SENTENCES[f"{_only.lower()}-terms"] = (
            f"you can redistribute it and/or modify it under the terms of the {_long} version {_version} as published by the "
            "Free Software Foundation.")
        SENTENCES[f"{_only.lower()}-comma"] = (
            f"you can redistribute it and/or modify it under the terms of the {_long} as published by the Free Software "
            f"Foundation, version {_version} of the License.")
        RULES += [(_later, [f"{_later.lower()}-terms"]), (_later, [f"{_kind.lower()}-published", f"either-{_version}"]),
                  (_only, [f"{_only.lower()}-terms"]), (_only, [f"{_only.lower()}-comma"]),
                  (_only, [f"{_kind.lower()}-published", f"version-{_version}"])]
for _code in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
    SENTENCES[f"cc-{_code.lower()}-4.0-bound"] = (
        "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this "
        f"Creative Commons {'-'.join(_TERMS[part] for part in _code.split('-'))} 4.0 International Public License (\"Public License\").")
    RULES.append((f"CC-{_code}-4.0", [f"cc-{_code.lower()}-4.0-bound"]))
RULES += [(name, [f"notice-{name.lower()}"]) for name in NAMES]
RULES += [(f"{name}-{kind}", [f"notice-{name.lower()}-{kind}"]) for name in VERSIONED for kind in ("only", "or-later")]
