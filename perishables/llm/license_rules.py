"""Signature rules of the licence scan.

A signature is written as words: ``a|b`` is either word, ``word?`` may be missing, and a word may be a regular
expression of letters and digits.  Texts are matched as lower-case words without punctuation, so
"Apache-2.0" reads ``apache 2 0``.  Every rule has a keyword that each of its matches holds, and the scan
looks for a rule's signature only where its keyword stands.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: base phrases of the contract (phrase, label) ---
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# label | keyword of its names | names (each a signature)
FAMILIES = (
    ("mit", "license", ("mit license", "expat license", "mit x11 license", "x11 license")),
    ("mit-0", "attribution", ("mit no attribution",)),
    ("apache-1.1", "apache", ("apache software? license version? 1 1",)),
    ("apache-2.0", "apache", ("apache software? license version? v?2 0?", "apache license version? v?2 0", "apache 2 0 license?")),
    ("gpl-1.0", "public", ("gnu? general public license version? v?1 0?",)),
    ("gpl-2.0", "public", ("gnu? general public license version? v?2 0?", "gnu? general public license version 2 or|only later?")),
    ("gpl-3.0", "public", ("gnu? general public license version? v?3 0?", "gnu? general public license version 3 or|only later?")),
    ("lgpl-2.0", "public", ("gnu? lesser|library general public license version? v?2 0?",)),
    ("lgpl-2.1", "public", ("gnu? lesser|library general public license version? v?2 1",)),
    ("lgpl-3.0", "public", ("gnu? lesser general public license version? v?3 0?",)),
    ("agpl-3.0", "affero", ("gnu? affero general public license version? v?3? 0?",)),
    ("fdl-1.3", "documentation", ("gnu? free documentation license version? 1?",)),
    ("bsd", "bsd", ("bsd license", "bsd style license")),
    ("bsd-0", "bsd", ("zero|0 clause bsd license?", "bsd zero clause license")),
    ("bsd-2-clause", "bsd", ("2|two clause bsd license?", "bsd 2|two clause license?", "simplified|freebsd bsd license")),
    ("bsd-3-clause", "bsd", ("3|three clause bsd license?", "bsd 3|three clause license?", "modified|new|revised bsd license")),
    ("bsd-4-clause", "bsd", ("4|four clause bsd license?", "bsd 4|four clause license?", "original bsd license")),
    ("isc", "isc", ("isc license",)),
    ("mpl-1.1", "mozilla", ("mozilla public license version? v?1 1",)),
    ("mpl-2.0", "mozilla", ("mozilla public license version? v?2? 0?",)),
    ("epl-1.0", "eclipse", ("eclipse public license version? v?1 0?",)),
    ("epl-2.0", "eclipse", ("eclipse public license version? v?2? 0?",)),
    ("edl-1.0", "eclipse", ("eclipse distribution license version? v?1? 0?",)),
    ("cddl", "cddl", ("cddl version? 1?", "common development and distribution license cddl")),
    ("cpl-1.0", "public", ("common public license version? 1? 0?",)),
    ("eupl", "union", ("european union public licen[cs]e version? v?1? 1|2?",)),
    ("osl-3.0", "open", ("open software license version? v?3? 0?",)),
    ("afl-3.0", "academic", ("academic free license version? v?3? 0?",)),
    ("artistic-1.0", "artistic", ("artistic license version? 1 0?",)),
    ("artistic-2.0", "artistic", ("artistic license version? 2? 0?",)),
    ("bsl-1.0", "boost", ("boost software license version? 1? 0?",)),
    ("zlib", "zlib", ("zlib license", "zlib libpng license")),
    ("unlicense", "unlicense", ("the? unlicense",)),
    ("wtfpl", "wtfpl", ("wtfpl version? 2?",)),
    ("beerware", "beerware", ("beerware license?",)),
    ("psf-2.0", "python", ("python software foundation license version? 2?", "psf python license")),
    ("ruby", "ruby", ("ruby license",)),
    ("php-3.01", "php", ("php license version? 3? 0?1?",)),
    ("ofl-1.1", "font", ("sil? open font license version? v?1? 1?",)),
    ("odbl-1.0", "database", ("open database license version? v?1? 0?",)),
    ("odc-by-1.0", "data", ("open data commons attribution license version? 1? 0?",)),
    ("pddl-1.0", "domain", ("public domain dedication and license version? 1? 0?",)),
    ("cc0-1.0", "cc0", ("cc0 1? 0? universal?",)),
    ("cc-by-2.0", "cc", ("cc by 2 0",)),
    ("cc-by-3.0", "cc", ("cc by 3 0",)),
    ("cc-by-4.0", "cc", ("cc by 4 0",)),
    ("cc-by-sa-3.0", "cc", ("cc by sa 3 0",)),
    ("cc-by-sa-4.0", "cc", ("cc by sa 4 0",)),
    ("cc-by-nc-3.0", "cc", ("cc by nc 3 0",)),
    ("cc-by-nc-4.0", "cc", ("cc by nc 4 0",)),
    ("cc-by-nd-4.0", "cc", ("cc by nd 4 0",)),
    ("cc-by-nc-sa-4.0", "cc", ("cc by nc sa 4 0",)),
    ("cc-by-nc-nd-4.0", "cc", ("cc by nc nd 4 0",)),
    ("cc-by", "commons", ("creative commons attribution [1-4]? 0? international|unported|generic? public? license?",)),
    ("cc-by-sa", "commons", ("creative commons attribution share alike", "creative commons attribution sharealike [1-4]? 0? international|unported?")),
    ("cc-by-nc", "commons", ("creative commons attribution non commercial", "creative commons attribution noncommercial [1-4]? 0? international|unported?")),
    ("cc-by-nd", "commons", ("creative commons attribution noderivatives|noderivs [1-4]? 0? international|unported?",)),
    ("cc0-1.0", "commons", ("creative commons zero", "creative commons public domain dedication")),
    ("ms-pl", "microsoft", ("microsoft public license",)),
    ("ms-rl", "microsoft", ("microsoft reciprocal license",)),
    ("sspl-1.0", "server", ("server side public license version? v?1?",)),
    ("busl-1.1", "business", ("business source license version? 1? 1?",)),
    ("elastic-2.0", "elastic", ("elastic license version? v?2? 0?",)),
    ("openssl", "openssl", ("openssl license",)),
    ("ncsa", "ncsa", ("university of illinois ncsa open source license", "ncsa license")),
    ("upl-1.0", "permissive", ("universal permissive license version? v?1? 0?",)),
    ("postgresql", "postgresql", ("postgresql licen[cs]e",)),
    ("vim", "vim", ("vim license",)),
    ("w3c", "w3c", ("w3c software? notice? and? license",)),
    ("mulan-2.0", "mulan", ("mulan psl v2", "mulan permissive software license version? v?2?")),
    ("llama", "llama", ("llama [2-4]? community license",)),
    ("openrail", "rail", ("open rail m? license?",)),
)

# identifiers as they stand behind "SPDX-License-Identifier:", by label where the two differ in words
SPDX = {
    "mit": "mit", "apache-2.0": "apache 2 0", "apache-1.1": "apache 1 1", "gpl-1.0": "gpl 1 0", "gpl-2.0": "gpl 2 0", "gpl-3.0": "gpl 3 0",
    "lgpl-2.0": "lgpl 2 0", "lgpl-2.1": "lgpl 2 1", "lgpl-3.0": "lgpl 3 0", "agpl-3.0": "agpl 3 0", "cddl": "cddl 1 0|1",
    "fdl-1.3": "gfdl 1 3", "isc": "isc", "zlib": "zlib", "unlicense": "unlicense", "wtfpl": "wtfpl", "postgresql": "postgresql",
}

# how a licence is granted; the family's name follows
GRANTS = (
    "licensed under the? terms? of? the?",
    "released|distributed|published|provided|made under the? terms? of? the?",
    "available|usable under the? terms? of? the?",
    "subject to the terms and? conditions? of the",
    "dual|multi licensed under the?",
    "governed by the",
)

# label | keyword | signature: passages of licence texts and notices
PASSAGES = (
    ("mit", "granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "warranty", "the software is provided as is without warranty of any kind express or implied"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions", "redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "endorse", "may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must"),
    ("isc", "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu"),
    ("gpl", "warranty", "without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl", "received", "you should have received a copy of the gnu general public license"),
    ("lgpl", "lesser", "you should have received a copy of the gnu lesser general public license"),
    ("agpl", "affero", "you should have received a copy of the gnu affero general public license"),
    ("apache-2.0", "compliance", "you may not use this file except in compliance with the license"),
    ("apache-2.0", "writing", "unless required by applicable law or agreed to in writing software distributed under the license"),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("public-domain", "domain", "released|placed|dedicated in|into|to the public domain"),
    ("public-domain", "domain", "this work|software|file|code is in the public domain"),
    ("public-domain", "waived", "has waived all copyright"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("bsl-1.0", "machine", "all copies of the software must include machine executable object code"),
    ("ofl-1.1", "reserved", "reserved font name"),
    ("all-rights-reserved", "reserved", "all rights reserved"),
    ("copyright", "copyright", "copyright c? [12][0-9][0-9][0-9]"),
    ("copyright", "copyright", "c copyright [12][0-9][0-9][0-9]"),
    ("proprietary", "confidential", "proprietary and confidential"),
    ("proprietary", "unauthorized", "unauthorized copying|reproduction of this file? via? any? medium? is strictly prohibited"),
    ("proprietary", "permission", "without the? prior written permission of"),
    ("non-commercial", "commercial", "for non commercial use only"),
    ("non-commercial", "noncommercial", "for noncommercial use only"),
    ("terms-of-use", "terms", "terms of use apply"),
    ("license-reference", "license", "see the? license file? for details"),
    ("license-reference", "license", "see license txt|md|rst"),
    ("license-reference", "copying", "see the? file copying"),
    ("license-reference", "licensed", "licensed under"),
    ("license-reference", "agreement", "licen[cs]e agreement"),
    ("license-reference", "terms", "under the terms of the license"),
    ("mit", "sublicense", "rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "substantial", "this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "dealings", "arising from out of or in connection with the software or the use or other dealings in the software"),
    ("mit", "holders", "in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("x11", "advertising", "shall not be used in advertising or otherwise to promote the sale use or other dealings in this software"),
    ("bsd-3-clause", "neither", "neither the name of the? copyright? holder|owner|organization|university|company? nor the names of its contributors may be used"),
    ("bsd-3-clause", "endorse", "the name of the author may not be used to endorse or promote products"),
    ("bsd", "disclaimed", "warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("bsd", "exemplary", "be liable for any direct indirect incidental special exemplary or consequential damages"),
    ("bsd", "procurement", "procurement of substitute goods or services loss of use data or profits or business interruption"),
    ("bsd-2-clause", "conclusions", "the views and conclusions contained in the software and documentation are those of the authors"),
    ("bsd-3-clause-clear", "patent", "no express or implied licenses to any party s patent rights are granted by this license"),
    ("isc", "disclaims", "the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("isc", "tortious", "whether in an action of contract negligence or other tortious action"),
    ("hpnd", "representations", "makes|make no representations about the suitability of this software for any purpose"),
    ("apache-2.0", "irrevocable", "perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce"),
    ("apache-2.0", "irrevocable", "royalty free irrevocable except as stated in this section patent license"),
    ("apache-2.0", "recipients", "you must give any other recipients of the work or derivative works a copy of this license"),
    ("apache-2.0", "governing", "see the license for the specific language governing permissions and limitations under the license"),
    ("apache-2.0", "contributor", "licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-1.1", "endorse", "the names apache and apache software foundation must not be used to endorse"),
    ("or-later", "later", "either version [1-3] 0|1? of the license or at your option any later version"),
    ("gpl", "hope", "this program is distributed in the hope that it will be useful"),
    ("lgpl", "hope", "this library is distributed in the hope that it will be useful"),
    ("gpl", "freedom", "when we speak of free software we are referring to freedom not price"),
    ("gpl-2.0", "freedom", "the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-2.0", "prominent", "you must cause the modified files to carry prominent notices stating that you changed the files and the date of any change"),
    ("gpl-2.0", "activities", "activities other than copying distribution and modification are not covered by this license"),
    ("gpl-2.0", "interactively", "if the modified program normally reads commands interactively when run"),
    ("gpl-3.0", "copyleft", "is a free copyleft license for software and other kinds of works"),
    ("gpl-3.0", "corresponding", "the corresponding source for a work in object code form means"),
    ("gpl-3.0", "technological", "no covered work shall be deemed part of an effective technological measure"),
    ("gpl-3.0", "propagate", "to propagate a work means to do anything with it"),
    ("gpl-3.0", "convey", "to convey a work means any kind of propagation that enables other parties to make or receive copies"),
    ("agpl-3.0", "remotely", "must prominently offer all users interacting with it remotely through a computer network"),
    ("agpl-3.0", "copyleft", "is a free copyleft license for software and other kinds of works specifically designed to ensure cooperation"),
    ("lgpl-2.1", "derivative", "contains no derivative of any portion of the library but is designed to work with the library"),
    ("lgpl-3.0", "incorporates", "incorporates the terms and conditions of version 3 of the gnu general public license"),
    ("gpl-exception", "linking", "linking this library statically or dynamically with other modules is making a combined work"),
    ("gpl-exception", "classpath", "classpath exception"),
    ("gpl-exception", "runtime", "gcc runtime library exception"),
    ("gpl-exception", "bison", "you may create a larger work that contains part or all of the bison parser skeleton"),
    ("fsf-text", "verbatim", "everyone is permitted to copy and distribute verbatim copies of this license document"),
    ("fsf-unlimited", "unlimited", "gives unlimited permission to copy and or distribute it with or without modifications"),
    ("fdl-1.3", "documentation", "copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("fdl-1.3", "invariant", "with no invariant sections no front cover texts and no back cover texts"),
    ("mpl-1.1", "contents", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-2.0", "mpl", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-2.0", "secondary", "incompatible with secondary licenses"),
    ("epl", "accompanying", "this program and the accompanying materials are made available under the terms of the eclipse"),
    ("epl", "constitutes", "any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement"),
    ("cddl", "contents", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("eupl", "eupl", "licensed under the eupl"),
    ("artistic-1.0", "semblance", "such that the copyright holder maintains some semblance of artistic control over the development of the package"),
    ("artistic-2.0", "establishes", "this license establishes the terms under which a given free software package may be copied modified distributed"),
    ("perl", "perl", "under the same terms as perl itself"),
    ("bsl-1.0", "accompanying", "obtaining a copy of the software and accompanying documentation covered by this license"),
    ("zlib", "altered", "altered source versions must be plainly marked as such"),
    ("zlib", "altered", "this notice may not be removed or altered from any source distribution"),
    ("zlib", "damages", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("unlicense", "compile", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("unlicense", "jurisdictions", "in jurisdictions that recognize copyright laws the author or authors of this software dedicate"),
    ("wtfpl", "fuck", "do what the fuck you want to"),
    ("beerware", "beer", "you can buy me a beer in return"),
    ("psf-2.0", "licensee", "psf is making python available to licensee on an as is basis"),
    ("php-3.01", "php", "products derived from this software may not be called php"),
    ("ofl-1.1", "font", "this font software is licensed under the sil open font license"),
    ("ofl-1.1", "font", "neither the font software nor any of its individual components in original or modified versions may be sold by itself"),
    ("odbl-1.0", "database", "any rights in individual contents of the database are licensed under"),
    ("odbl-1.0", "database", "made available under the open database license"),
    ("cc-by", "credit", "you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("cc-by", "redistribute", "you are free to share copy and redistribute the material in any medium or format"),
    ("cc-by-sa", "remix", "if you remix transform or build upon the material you must distribute your contributions under the same license"),
    ("cc-by-nd", "remix", "if you remix transform or build upon the material you may not distribute the modified material"),
    ("cc-by-nc", "commercial", "you may not use the material for commercial purposes"),
    ("cc", "commons", "provided under the terms of this creative commons public license"),
    ("cc", "firm", "creative commons corporation is not a law firm and does not provide legal services"),
    ("cc", "exercising", "by exercising the licensed rights defined below you accept and agree to be bound"),
    ("cc", "reserved", "some rights reserved"),
    ("cc0-1.0", "affirmer", "affirmer hereby overtly fully permanently irrevocably and unconditionally waives"),
    ("cc0-1.0", "waived", "to the extent possible under law the? author|authors|person|publisher who? associated? cc0? with? this? work? has|have waived all copyright"),
    ("cc-by", "creativecommons", "creativecommons org licenses by [1-4] 0|5"),
    ("cc-by-sa", "creativecommons", "creativecommons org licenses by sa [1-4] 0|5"),
    ("cc-by-nc", "creativecommons", "creativecommons org licenses by nc [1-4] 0|5"),
    ("cc-by-nd", "creativecommons", "creativecommons org licenses by nd [1-4] 0|5"),
    ("cc-by-nc-sa", "creativecommons", "creativecommons org licenses by nc sa [1-4] 0|5"),
    ("cc-by-nc-nd", "creativecommons", "creativecommons org licenses by nc nd [1-4] 0|5"),
    ("cc0-1.0", "creativecommons", "creativecommons org publicdomain zero 1 0"),
    ("public-domain", "creativecommons", "creativecommons org publicdomain mark 1 0"),
    ("apache-2.0", "apache", "apache org licenses license 2 0"),
    ("mit", "opensource", "opensource org licenses? mit"),
    ("isc", "opensource", "opensource org licenses? isc"),
    ("bsd-2-clause", "opensource", "opensource org licenses? bsd 2 clause"),
    ("bsd-3-clause", "opensource", "opensource org licenses? bsd 3 clause"),
    ("gpl", "gnu", "gnu org licenses gpl"),
    ("lgpl", "gnu", "gnu org licenses lgpl"),
    ("agpl", "gnu", "gnu org licenses agpl"),
    ("fdl-1.3", "gnu", "gnu org licenses fdl"),
    ("mpl-2.0", "mozilla", "mozilla org mpl 2? 0?"),
    ("epl", "eclipse", "eclipse org legal epl"),
    ("bsl-1.0", "boost", "boost org license 1 0"),
    ("ofl-1.1", "sil", "scripts sil org ofl"),
    ("ms-pl", "infringed", "over patents that you claim are infringed by the software"),
    ("openssl", "openssl", "this product includes software developed by the openssl project"),
    ("openssl", "cryptographic", "this product includes cryptographic software written by eric young"),
    ("ncsa", "restriction", "to deal with the software without restriction"),
    ("postgresql", "california", "in no event shall the university of california be liable to any party"),
    ("vim", "vim", "there are no restrictions on distributing unmodified copies of vim"),
    ("w3c", "obtaining", "by obtaining using and or copying this work you the licensee agree"),
    ("sspl-1.0", "functionality", "if you make the functionality of the program or a modified version available to third parties as a service"),
    ("busl-1.1", "production", "make non production use of the licensed work"),
    ("busl-1.1", "grant", "additional use grant"),
    ("elastic-2.0", "hosted", "provide the software to third parties as a hosted or managed service"),
    ("commons-clause", "sell", "does not grant to you the right to sell the software"),
    ("llama", "llama", "built with meta? llama"),
    ("llama", "monthly", "greater than 700 million monthly active users"),
    ("openrail", "restrictions", "use based restrictions"),
    ("json", "evil", "the software shall be used for good not evil"),
    ("eula", "user", "end user licen[cs]e agreement"),
    ("eula", "decompile", "reverse engineer decompile or disassemble"),
    ("eula", "installing", "by installing copying or otherwise using the? this? software|product you agree to be bound by"),
    ("proprietary", "confidential", "is the confidential and proprietary information of"),
    ("proprietary", "unpublished", "this is an unpublished work"),
    ("proprietary", "evaluation", "for evaluation purposes only"),
    ("all-rights-reserved", "transmitted", "may be reproduced stored? distributed? or transmitted in any form or by any means"),
    ("all-rights-reserved", "publication", "no part of this publication may be reproduced"),
    ("non-commercial", "commercial", "not for commercial use"),
    ("non-commercial", "personal", "for personal use only"),
    ("hpnd", "documentation", "permission to use copy modify and distribute this software and its documentation for any purpose"),
    ("bsd-4-clause", "acknowledgement", "must display the following acknowledgement"),
    ("bsd-4-clause", "acknowledgment", "must display the following acknowledgment"),
    ("non-commercial", "academic", "for academic use|purposes only"),
    ("non-commercial", "educational", "for educational use|purposes only"),
    ("non-commercial", "research", "for research use|purposes only"),
    ("license-reference", "notices", "third party notices"),
    ("license-reference", "license", "refer to the license file"),
    ("license-reference", "license", "a copy of the license is included"),
    ("license-reference", "license", "received a copy of the license along with"),
)

# order of the kinds of rules: (priority, confidence)
SPDX_RANK, GRANT_RANK, PASSAGE_RANK, NAME_RANK, WEAK_RANK = (4, 1.0), (3, 0.95), (2, 0.85), (2, 0.75), (1, 0.4)
WEAK = ("license-reference", "copyright", "all-rights-reserved", "terms-of-use")


@dataclass(frozen=True)
class Rule:
    number: int
    keyword: str
    pattern: str
    label: str
    priority: int
    confidence: float
    base: bool


def signature(words: str) -> str:
    """A signature as a regular expression over text in which every word stands between two blanks of its own."""
    parts = []
    for token in words.split():
        optional = token.endswith("?") and not token.endswith("]?") or token.endswith("]?") and token.startswith("[")
        token = token[:-1] if optional else token
        inner = "|".join(f" {w} " for w in token.split("|"))
        parts.append(f"(?:{inner})?" if optional else f"(?:{inner})" if "|" in inner else inner)
    return "".join(parts)


def rules() -> tuple[Rule, ...]:
    """Every rule in order: base phrases, identifiers, grants of each family, passages, bare names."""
    found: list[tuple[str, str, str, tuple[int, float], bool]] = []
    for phrase, label in BASE:
        found.append(("license", phrase, label, (2, 0.7), True))
    labels = dict.fromkeys(label for label, _, _ in FAMILIES)
    for label in labels:
        name = SPDX.get(label, label.replace("-", " ").replace(".", " "))
        found.append(("spdx", f"spdx license identifier {name}", label, SPDX_RANK, False))
    # a grant is one rule for each name: any of the phrases, then the name
    for label, keyword, names in FAMILIES:
        found.extend((keyword, name, label, GRANT_RANK, False) for name in names)
    for label, keyword, words in PASSAGES:
        found.append((keyword, words, label, WEAK_RANK if label in WEAK else PASSAGE_RANK, False))
    for label, keyword, names in FAMILIES:
        found.extend((keyword, name, label, NAME_RANK, False) for name in names)
    grants = f"(?:{'|'.join(map(signature, GRANTS))})"
    return tuple(Rule(i, keyword, (grants if rank == GRANT_RANK else "") + signature(words), label, *rank, base)
                 for i, (keyword, words, label, rank, base) in enumerate(found))
