"""License scans by sentence rules.

Known license sentences are mapped to identifiers; a text becomes the sequence of
known sentences found in it, and that sequence is matched against ordered rules, the
longest rule first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from contrail.llm.common import id_and_text

# Sentences of public license texts and notices. Words compare in lower case,
# without punctuation at their ends; "<v>" stands for one version number such as 2.0, "<h>"
# for one to SLOT words such as a holder's name.
SENTENCES: dict[str, str] = {
    "apache-line": "Licensed under the Apache License, Version 2.0",
    "apache-line-the": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache-comply": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License",
    "mit-line": "Released under the MIT License",
    "mit-line-licensed": "Licensed under the MIT License",
    "mit-title": "The MIT License (MIT)",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "as-is-software": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "as-is-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-line": "Licensed under the BSD License",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "gpl-line": "This work is licensed under the GNU General Public License, version <v>",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl-see": "See the GNU General Public License for more details",
    "lgpl-line": "This work is licensed under the GNU Lesser General Public License, version <v>",
    "mpl-terms": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mpl-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    "unlicense-domain": "This is free and unencumbered software released into the public domain",
    "cc0-line": "Licensed under CC0 <v>",
    "cc-by-line": "Licensed under CC BY <v>",
    "cc-by-sa-line": "Licensed under CC BY-SA <v>",
    "cc-by-nc-line": "Licensed under CC BY-NC <v>",
    "cc-by-nd-line": "Licensed under CC BY-ND <v>",
    "cc-by-nc-sa-line": "Licensed under CC BY-NC-SA <v>",
    "cc-by-nc-nd-line": "Licensed under CC BY-NC-ND <v>",
    "spdx": "SPDX-License-Identifier: <v>",
    "bsd-advertising": "All advertising materials mentioning features or use of this software must display the following acknowledgement",
    "gpl-any-free": "This <h> is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version <v> of the License, or (at your option) any later version",
    "gpl-only": "This <h> is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version <v> as published by the Free Software Foundation",
    "lgpl-free": "This <h> is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version <v> of the License, or (at your option) any later version",
    "lgpl-see": "See the GNU Lesser General Public License for more details",
    "agpl-free": "This <h> is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version <v> of the License, or (at your option) any later version",
    "agpl-see": "See the GNU Affero General Public License for more details",
    "gpl-title": "GNU General Public License Version <v>",
    "lgpl-title": "GNU Lesser General Public License Version <v>",
    "agpl-title": "GNU Affero General Public License Version <v>",
    "apache-title": "Apache License Version 2.0, January 2004",
    "mpl-title": "Mozilla Public License Version <v>",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "epl-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v<v>",
    "epl-title": "Eclipse Public License - v <v>",
    "boost-title": "Boost Software License - Version 1.0",
    "boost-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following",
}

# Further wordings of a sentence.
WORDINGS: list[tuple[str, str]] = [
    ("apache-copy", "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"),
    ("mpl-copy", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"),
    ("isc-grant", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("gpl-only", "This <h> is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version <v> of the License"),
    ("gpl-hope", "This <h> is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    ("epl-terms", "This program and the accompanying materials are made available under the terms of the Eclipse Public License <v>"),
    ("epl-terms", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. <v>"),
    *(("bsd-endorse", f"{start} be used to endorse or promote products derived from this software without specific prior written permission") for start in (
        "Neither the name of <h> nor the names of its contributors may", "Neither the name of <h> nor the names of contributors may",
        "Neither the name of <h> nor the names of any contributors may", "Neither the name of <h> nor the names of other contributors may",
        "Neither the name of <h> nor the names of their contributors may", "Neither the name nor trademarks of <h> may", "Neither the name of <h> may",
        "The name of <h> may not", "The names of its contributors may not", "Neither the names of <h> nor the names of its contributors may")),
]

# Names of licenses as notices give them. A notice is one of OPENINGS, an article and a name.
_VERBS = ("licensed", "released", "distributed", "available", "made available")
_UNDER = ("under", "under the terms of")
OPENINGS = [*(f"{verb} {under}" for verb in _VERBS for under in _UNDER),
            *(f"{what} <h> {be} {verb} {under}" for what in ("This", "The") for be in ("is", "are") for verb in _VERBS for under in _UNDER),
            *(f"{what} {verb} under" for what in ("Code", "Source code", "Software", "Data", "Content", "Documentation", "Project", "Package", "Library")
              for verb in (*_VERBS, "is licensed", "is released", "is distributed", "is available")),
            *(f"{dual} licensed under" for dual in ("Dual", "Dual-", "Triple")), "Dual-licensed under", "Licensed under either", "Licensed under either of",
            "Licensed under one of", "Released under either", "Released under either of"]
#: Openings that a short name alone may follow: "License: MIT".
LABELS = ["License", "Project license", "Code license", "License type"]
NAMES: list[tuple[str, str]] = [
    ("MIT License", "MIT"), ("MIT licence terms", "MIT"), ("Apache License, Version 2.0", "Apache-2.0"), ("Apache License 2.0", "Apache-2.0"),
    ("Apache 2.0 License", "Apache-2.0"), ("Apache-2.0 License", "Apache-2.0"), ("BSD License", "BSD"), ("BSD 2-Clause License", "BSD-2-Clause"),
    ("BSD-2-Clause License", "BSD-2-Clause"), ("2-Clause BSD License", "BSD-2-Clause"), ("Simplified BSD License", "BSD-2-Clause"),
    ("BSD 3-Clause License", "BSD-3-Clause"), ("BSD-3-Clause License", "BSD-3-Clause"), ("3-Clause BSD License", "BSD-3-Clause"),
    ("New BSD License", "BSD-3-Clause"), ("ISC License", "ISC"), ("zlib License", "Zlib"), ("Unlicense", "Unlicense"),
    ("Boost Software License, Version 1.0", "BSL-1.0"), ("Boost Software License 1.0", "BSL-1.0"),
    *((f"{full}{mid} <v>", f"{short}-<v>") for full, short in (("Mozilla Public License", "MPL"), ("Eclipse Public License", "EPL"))
      for mid in ("", ", version", ", v.")),
    *((name, out) for full, short in (("GNU General Public License", "GPL"), ("GNU Lesser General Public License", "LGPL"), ("GNU Affero General Public License", "AGPL"))
      for name, out in ((full, short), (f"{full} <v>", f"{short}-<v>"), (f"{full}, version <v>", f"{short}-<v>"),
                        (f"{full} <v> or later", f"{short}-<v>-or-later"), (f"{full}, version <v> or later", f"{short}-<v>-or-later"),
                        (f"{full}, version <v> or any later version", f"{short}-<v>-or-later"),
                        (f"{full} <v> only", f"{short}-<v>-only"), (f"{full}, version <v> only", f"{short}-<v>-only"))),
    *((f"Creative Commons Attribution{long} <v> International License", f"CC-BY{short}-<v>") for long, short in (
        ("", ""), ("-ShareAlike", "-SA"), ("-NonCommercial", "-NC"), ("-NoDerivatives", "-ND"), ("-NonCommercial-ShareAlike", "-NC-SA"),
        ("-NonCommercial-NoDerivatives", "-NC-ND"))),
]
# Short names, as they follow LABELS and OPENINGS.
SHORT_NAMES: list[tuple[str, str]] = [
    ("MIT", "MIT"), ("Apache-2.0", "Apache-2.0"), ("Apache 2.0", "Apache-2.0"), ("Apache 2", "Apache-2.0"), ("Apache License 2", "Apache-2.0"),
    ("ASL 2.0", "Apache-2.0"), ("BSD", "BSD"), ("BSD-2-Clause", "BSD-2-Clause"), ("BSD 2-Clause", "BSD-2-Clause"), ("BSD-3-Clause", "BSD-3-Clause"),
    ("BSD 3-Clause", "BSD-3-Clause"), ("3-Clause BSD", "BSD-3-Clause"), ("2-Clause BSD", "BSD-2-Clause"), ("ISC", "ISC"), ("Zlib", "Zlib"),
    ("Unlicense", "Unlicense"), ("BSL-1.0", "BSL-1.0"), ("CC0", "CC0"), ("CC0 <v>", "CC0-<v>"), ("CC0-1.0", "CC0-1.0"),
    ("MPL <v>", "MPL-<v>"), ("MPL-2.0", "MPL-2.0"), ("MPLv2", "MPL-2.0"), ("EPL <v>", "EPL-<v>"), ("EPL-2.0", "EPL-2.0"), ("EPL-1.0", "EPL-1.0"),
    *((f"{cc}{sep} <v>", f"CC-BY{tail}-<v>") for tail in ("", "-SA", "-NC", "-ND", "-NC-SA", "-NC-ND")
      for cc, sep in ((f"CC BY{tail}", ""), (f"CC-BY{tail}", ""), (f"CC BY{tail}", " International"))),
    *((f"CC-BY{tail}-{v}", f"CC-BY{tail}-{v}") for tail in ("", "-SA", "-NC", "-ND", "-NC-SA", "-NC-ND") for v in ("3.0", "4.0")),
    *((f"{gnu}{name}{version}{tail}", f"{name}-<v>{end}") for gnu in ("", "GNU ") for name in ("GPL", "LGPL", "AGPL")
      for version in (" <v>", " version <v>", ", version <v>") for tail, end in (
          ("", ""), (" or later", "-or-later"), (" or any later version", "-or-later"), (" only", "-only"))),
    *((f"{gnu}{name}v{v}{tail}", f"{name}-{v}{end}") for gnu in ("", "GNU ") for name, versions in (("GPL", ("2", "3")), ("LGPL", ("2.1", "3")), ("AGPL", ("3",)))
      for v in versions for tail, end in (("", ""), ("+", ".0-or-later" if "." not in v else "-or-later"), (" or later", ".0-or-later" if "." not in v else "-or-later"))),
    *((f"{name}-{v}{end}", f"{name}-{v}{end}") for name, versions in (("GPL", ("2.0", "3.0")), ("LGPL", ("2.1", "3.0")), ("AGPL", ("3.0",)))
      for v in versions for end in ("", "-only", "-or-later")),
    *((f"{gnu}{name}", name) for gnu in ("", "GNU ") for name in ("GPL", "LGPL", "AGPL")),
]

# Ordered rules. "<v>" in a license name is the version that the sentence holds.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("Apache-2.0", ("apache-line-the", "apache-comply", "apache-copy", "apache-as-is", "apache-see")),
    ("Apache-2.0", ("apache-line-the",)), ("Apache-2.0", ("apache-line",)), ("Apache-2.0", ("apache-title",)),
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "as-is-software", "as-is-liability")),
    ("MIT", ("mit-grant", "mit-notice", "as-is-software", "as-is-liability")),
    ("MIT", ("mit-grant", "mit-notice")), ("MIT", ("mit-title",)), ("MIT", ("mit-line",)), ("MIT", ("mit-line-licensed",)),
    ("BSD-4-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-endorse")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    ("BSD", ("bsd-line",)),
    ("ISC", ("isc-grant",)),
    ("GPL-<v>", ("gpl-line",)), ("LGPL-<v>", ("lgpl-line",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope", "gpl-see")), ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-2.0-or-later", ("gpl-2-free", "gpl-hope", "gpl-see")), ("GPL-2.0-or-later", ("gpl-2-free",)),
    ("MPL-2.0", ("mpl-terms", "mpl-copy")), ("MPL-2.0", ("mpl-terms",)), ("MPL-<v>", ("mpl-title",)),
    ("GPL-<v>-or-later", ("gpl-any-free", "gpl-hope", "gpl-see")), ("GPL-<v>-or-later", ("gpl-any-free",)),
    ("GPL-<v>-only", ("gpl-only", "gpl-hope", "gpl-see")), ("GPL-<v>-only", ("gpl-only",)),
    ("LGPL-<v>-or-later", ("lgpl-free", "gpl-hope", "lgpl-see")), ("LGPL-<v>-or-later", ("lgpl-free",)),
    ("AGPL-<v>-or-later", ("agpl-free", "gpl-hope", "agpl-see")), ("AGPL-<v>-or-later", ("agpl-free",)),
    ("GPL-<v>", ("gpl-title",)), ("LGPL-<v>", ("lgpl-title",)), ("AGPL-<v>", ("agpl-title",)),
    ("Zlib", ("zlib-as-is", "zlib-grant")), ("Zlib", ("zlib-grant",)), ("EPL-<v>", ("epl-terms",)), ("EPL-<v>", ("epl-title",)),
    ("BSL-1.0", ("boost-title", "boost-grant")), ("BSL-1.0", ("boost-title",)), ("BSL-1.0", ("boost-grant",)), ("<v>", ("spdx",)),
    ("Unlicense", ("unlicense-domain",)),
    ("CC0-<v>", ("cc0-line",)), ("CC-BY-<v>", ("cc-by-line",)), ("CC-BY-SA-<v>", ("cc-by-sa-line",)), ("CC-BY-NC-<v>", ("cc-by-nc-line",)),
    ("CC-BY-ND-<v>", ("cc-by-nd-line",)), ("CC-BY-NC-SA-<v>", ("cc-by-nc-sa-line",)), ("CC-BY-NC-ND-<v>", ("cc-by-nc-nd-line",)),
]

VERSION = re.compile(r"v?\d+(?:\.\d+)*")
WORD = re.compile(r"\S+")
#: A sentence may start at the text's or a line's start, after the end of a sentence, or after a list mark.
START = re.compile(r"(?:\A|\n|[.!?;:,]\s|(?:[*#/-]|\d[.)]|\(\w\))\s)\s*(?=\S)")
#: An SPDX notice may stand anywhere; its expression ends with its line.
_ID = r"[A-Za-z0-9](?:[A-Za-z0-9.+:-]*[A-Za-z0-9+])?"
_PART = rf"(?:\([ \t]*)*{_ID}(?:[ \t]+WITH[ \t]+{_ID})?(?:[ \t]*\))*"
SPDX = re.compile(rf"(?<!\w)(?i:SPDX-License-Identifier):[ \t]*({_PART}(?:[ \t]+(?:AND|OR)[ \t]+{_PART})*)")
#: Longest filling of "<h>", in words.
SLOT = 12
_STOP = re.compile(r"[.!?]\W*$")
EDGE = ".,;:!?()[]{}\"'`*#/-"


def word_of(raw: str) -> str:
    """Normal form of a word: lower case, no punctuation at the ends, American spelling."""
    return raw.strip(EDGE).lower().replace("licence", "license")


def _all_names() -> list[tuple[str, str]]:
    """License names; short ones also with the word license."""
    return [*NAMES, *SHORT_NAMES, *((f"{name} license", out) for name, out in SHORT_NAMES if "<v>" not in name)]


def wordings() -> list[tuple[str, str]]:
    """(identifier, wording) of every known sentence; a notice's identifier is its license."""
    return [*_plain(), *((f"notice {out}", f"{opening}{name}") for opening in _notice_openings() for name, out in _all_names())]


def _plain() -> list[tuple[str, str]]:
    return [*((name, x) for name, x in SENTENCES.items() if name != "spdx"), *WORDINGS]


def _notice_openings() -> list[str]:
    return [*(f"{opening} {article}" for opening in OPENINGS for article in ("the ", "a ", "an ", "")),
            *(f"{label}: {article}" for label in LABELS for article in ("the ", ""))]


def _enter(root: dict, sentence: str) -> dict:
    node = root
    for raw in sentence.replace(" v<v>", " <v>").split():
        word = raw if raw in ("<v>", "<h>") else word_of(raw)
        node = node.setdefault(word, {}) if word else node
    return node


def _trie(pairs: list[tuple[str, str]]) -> dict:
    root: dict = {}
    for name, sentence in pairs:
        _enter(root, sentence).setdefault(None, name)
    return root


def _joined(node: dict, more: dict) -> dict:
    """Both tries in one; parts that only one of them has are shared, not copied."""
    return more if not node else {w: _joined(node[w], more[w]) if w in node and w in more and w is not None else node.get(w, more.get(w)) for w in {**node, **more}}


#: License names: what a notice's opening leads to, and what may follow a notice, "... or the MIT license".
_NAMES_ROOT = _trie([(f"notice {out}", name) for name, out in _all_names()])


def _sentence_trie() -> dict:
    root = _trie(_plain())
    # the longer openings first, as what is joined to a shorter one must hold them
    for opening in _notice_openings():
        _enter(root, opening)
    for opening in sorted(_notice_openings(), key=lambda o: -len(o.split())):
        *path, last = [w for w in (x if x == "<h>" else word_of(x) for x in opening.split()) if w]
        node = root
        for w in path:
            node = node[w]
        node[last] = _joined(node[last], _NAMES_ROOT)
    return root


_ROOT = _sentence_trie()
ANOTHER = re.compile(r"[\s,;]*\s(?:and/or|and|or)\s+(?:under\s+)?(?:the\s+|an?\s+)?(?=\S)")
#: Single words, as a text may break a line between any two. Each sentence holds one of these; texts with none are not searched further.
TRIGGERS = ("licens", "licenc", "permission", "redistribution", "neither", "unencumbered", "software", "program", "mpl", "endorse", "apache", "released",
            "distributed", "available")


def sentences(text: str) -> list[tuple[int, int, str, str]]:
    """Known sentences in order: (start, end, identifier, version or '')."""
    low = text.lower()
    if not any(t in low for t in TRIGGERS):
        return []
    out = [(m.start(), m.start(1) + len(e), "spdx", e) for m in SPDX.finditer(text) for e in [_balanced(m[1])]] if "spdx" in low else []
    named = [(x[0], x[1]) for x in out]
    done = 0
    for m in START.finditer(text):
        at = m.end()
        if at >= done and (best := _longest(text, at)) and not any(s < best[1] and at < e for s, e in named):
            out.append(best)
            done = best[1]
            while best and best[2].startswith("notice ") and (more := ANOTHER.match(text, done)):
                if best := _longest(text, more.end(), _NAMES_ROOT):
                    out.append(best)
                    done = best[1]
    return sorted(out)


def _balanced(expression: str) -> str:
    """Without closing brackets that belong to the text around it."""
    while expression.count(")") > expression.count("("):
        expression = expression[:expression.rindex(")")].rstrip()
    return expression


def _longest(text: str, at: int, root: dict = _ROOT) -> tuple[int, int, str, str] | None:
    """Longest known sentence that starts at ``at``; of equally long ones the one with fewer slots."""
    states, best, last = [(root, "", 0)], None, None  # node, version, words that the slot before the node may still take
    for w in WORD.finditer(text, at):
        word = word_of(w[0])
        if not word:  # a comment mark at a line's start
            if states[0][0] is root:
                break
            continue
        # a slot lies within one sentence
        within = last is None or not (_STOP.search(last[0]) and w[0][0].isupper() or text.count("\n", last.end(), w.start()) > 1)
        literal, slots, last = [], [], w
        for node, version, left in states:
            if word in node:
                literal.append((node[word], version, 0))
            if "<v>" in node and VERSION.fullmatch(word):
                literal.append((node["<v>"], word.removeprefix("v"), 0))
            if "<h>" in node and within:
                slots.append((node["<h>"], version, SLOT - 1))
            if left and within:
                slots.append((node, version, left - 1))
        states = literal + slots
        if not states:
            break
        best = next(((at, w.end(), node[None], version) for node, version, _ in literal if None in node), best)
    return best


_BY_FIRST: dict[str, list[tuple[str, tuple[str, ...]]]] = {}
for _name, _rule in sorted([*RULES, *((out, (f"notice {out}",)) for out in dict.fromkeys(out for _, out in _all_names()))], key=lambda r: -len(r[1])):
    _BY_FIRST.setdefault(_rule[0], []).append((_name, _rule))


def _name(name: str, version: str) -> str:
    """SPDX writes 3.0 where a text says version 3."""
    if name.endswith(("-or-later", "-only")) and "." not in version:
        version += ".0"
    return name.replace("<v>", version)


def matches(found: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str]]:
    """Rules matched by a text's known sentences, in order: (start, end, license)."""
    out, i = [], 0
    names = tuple(f[2] for f in found)
    while i < len(found):
        for name, rule in _BY_FIRST.get(names[i], ()):
            if names[i:i + len(rule)] == rule:
                out.append((found[i][0], found[i + len(rule) - 1][1], _name(name, found[i][3])))
                i += len(rule)
                break
        else:
            i += 1
    return out


def licenses(text: str) -> list[tuple[int, int, str]]:
    """Matched rules in order: (start, end, license)."""
    return matches(sentences(text))


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, licenses (sorted names, comma-joined), n_matches, n_sentences, spans.

    ``spans`` lists license:start:end in code points of the original text, comma-joined
    in order. Null and empty texts hold none. Repeated rows give repeated results; an
    empty table gives an empty result; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            known = [sentences(t) for t in texts]
            found = [matches(k) for k in known]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array([",".join(sorted({x[2] for x in f})) for f in found], pa.string()),
                pa.array([len(f) for f in found], pa.int64()),
                pa.array([len(k) for k in known], pa.int64()),
                pa.array([",".join(f"{name}:{s}:{e}" for s, e, name in f) for f in found], pa.string()),
            ], names=["doc_id", "licenses", "n_matches", "n_sentences", "spans"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, licenses string, n_matches long, n_sentences long, spans string")
