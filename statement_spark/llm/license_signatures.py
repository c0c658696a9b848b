"""License signatures: hand-written patterns over normalised text, in order of priority.

Normalised text is lower case, its words (letters, digits, non-ASCII) joined by single spaces: "GPL-3.0+" is "gpl 3 0".
A family is (label, priority, keyword, confidence, patterns); a pattern is tried only where its keyword occurs. Lower
priorities are stronger: 1 exact grants, 2 named licenses with version, 3 named licenses, 4 short names, 5 mere hints.
"""
from __future__ import annotations

import re

V2 = r"(?:version |v ?)?2(?: 0)?"
V3 = r"(?:version |v ?)?3(?: 0)?"
LATER = r"(?: (?:of the license )?or (?:at your option )?(?:any )?later(?: versions?)?)"
LICENSE = r"licen[sc]e"

FAMILIES: list[tuple[str, int, str, float, tuple[str, ...]]] = [
    ("apache-2.0", 1, "apache", 1.0, (
        rf"licensed under the apache {LICENSE} {V2}",
        rf"released under the (?:terms of the )?apache {LICENSE} {V2}",
        rf"distributed under the (?:terms of the )?apache {LICENSE} {V2}",
        rf"you may not use this file except in compliance with the {LICENSE} you may obtain a copy of the {LICENSE} at http www apache org licenses {LICENSE} 2 0",
        r"www apache org licenses license 2 0(?: txt| html)?",
    )),
    ("apache-2.0", 2, "apache", 0.95, (
        rf"apache {LICENSE} {V2}", rf"apache software {LICENSE} {V2}", rf"apache {V2} {LICENSE}", r"apache 2(?: 0)?",
    )),
    ("apache-1.1", 2, "apache", 0.95, (rf"apache (?:software )?{LICENSE} (?:version |v ?)?1 1", r"apache 1 1")),
    ("apache-1.0", 2, "apache", 0.95, (rf"apache (?:software )?{LICENSE} (?:version |v ?)?1 0", r"apache 1 0")),
    ("apache", 3, "apache", 0.8, (rf"apache (?:software )?{LICENSE}", rf"apache (?:style|like) {LICENSE}")),
    ("mit", 1, "mit", 1.0, (
        rf"released under the (?:terms of the )?mit {LICENSE}", rf"licensed under the (?:terms of the )?mit {LICENSE}",
        rf"distributed under the (?:terms of the )?mit {LICENSE}", rf"available under the (?:terms of the )?mit {LICENSE}",
        r"opensource org licenses mit",
    )),
    ("mit", 1, "permission is hereby granted", 1.0, (
        r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    )),
    ("mit", 2, "mit", 0.9, (rf"the mit {LICENSE}", rf"mit x11 {LICENSE}", rf"mit expat {LICENSE}")),
    ("mit", 3, "mit", 0.8, (rf"mit {LICENSE}", rf"mit (?:style|like) {LICENSE}", rf"{LICENSE} mit", r"mit licensed")),
    ("x11", 2, "x11", 0.9, (rf"x11 {LICENSE}", rf"x consortium {LICENSE}")),
    ("mit-0", 2, "mit", 0.95, (rf"mit no attribution(?: {LICENSE})?", r"mit 0 licen[sc]e")),
    ("isc", 1, "permission to use copy modify", 1.0, (
        r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    )),
    ("isc", 3, "isc", 0.85, (rf"isc {LICENSE}", rf"internet systems consortium {LICENSE}", rf"{LICENSE} isc")),
    ("gpl-3.0-or-later", 1, "general public", 1.0, (
        rf"gnu general public {LICENSE} (?:as published by the free software foundation either )?{V3}{LATER}",
        rf"general public {LICENSE} as published by the free software foundation either {V3} of the {LICENSE} or at your option any later version",
    )),
    ("gpl-2.0-or-later", 1, "general public", 1.0, (
        rf"gnu general public {LICENSE} (?:as published by the free software foundation either )?{V2}{LATER}",
        rf"general public {LICENSE} as published by the free software foundation either {V2} of the {LICENSE} or at your option any later version",
    )),
    ("gpl-3.0", 1, "general public", 1.0, (
        rf"licensed under the (?:terms of the )?gnu general public {LICENSE} {V3}",
        rf"released under the (?:terms of the )?gnu general public {LICENSE} {V3}",
        rf"distributed under the (?:terms of the )?gnu general public {LICENSE} {V3}",
    )),
    ("gpl-2.0", 1, "general public", 1.0, (
        rf"licensed under the (?:terms of the )?gnu general public {LICENSE} {V2}",
        rf"released under the (?:terms of the )?gnu general public {LICENSE} {V2}",
        rf"distributed under the (?:terms of the )?gnu general public {LICENSE} {V2}",
    )),
    ("gpl-3.0", 2, "general public", 0.95, (rf"(?:gnu )?general public {LICENSE} {V3}",)),
    ("gpl-2.0", 2, "general public", 0.95, (rf"(?:gnu )?general public {LICENSE} {V2}",)),
    ("gpl-1.0", 2, "general public", 0.95, (rf"gnu general public {LICENSE} (?:version |v ?)1(?: 0)?",)),
    ("gpl", 3, "general public", 0.8, (
        rf"gnu general public {LICENSE}", rf"under the general public {LICENSE}", r"gnu public licen[sc]e",
        r"www gnu org licenses gpl(?: \d(?: 0)?)?(?: txt| html)?", r"gnu org copyleft gpl(?: html)?",
    )),
    ("gpl-3.0-or-later", 2, "gpl", 0.95, (r"gpl ?v?3(?: 0)? or later", r"gplv3 (?:plus|or above)", rf"gpl ?{V3}{LATER}")),
    ("gpl-2.0-or-later", 2, "gpl", 0.95, (r"gpl ?v?2(?: 0)? or later", r"gplv2 (?:plus|or above)", rf"gpl ?{V2}{LATER}")),
    ("gpl-3.0", 3, "gpl", 0.85, (r"gpl ?v ?3(?: 0)?(?: only)?", r"gpl 3(?: 0)?(?: only)?", r"gpl version 3(?: 0)?")),
    ("gpl-2.0", 3, "gpl", 0.85, (r"gpl ?v ?2(?: 0)?(?: only)?", r"gpl 2(?: 0)?(?: only)?", r"gpl version 2(?: 0)?")),
    ("gpl", 4, "gpl", 0.6, (r"gnu gpl", r"gpl licen[sc]ed?", r"under (?:the )?gpl", r"gpl compatible licen[sc]e")),
    ("gpl-classpath-exception", 2, "classpath exception", 0.95, (rf"(?:gpl|general public {LICENSE})[a-z0-9 ]{{0,40}} classpath exception", r"classpath exception 2 0")),
    ("lgpl-3.0", 2, "lesser general", 0.95, (rf"(?:gnu )?lesser general public {LICENSE} {V3}{LATER}?",)),
    ("lgpl-2.1", 2, "lesser general", 0.95, (rf"(?:gnu )?lesser general public {LICENSE} (?:version |v ?)?2 1{LATER}?",)),
    ("lgpl-2.0", 2, "library general", 0.95, (rf"(?:gnu )?library general public {LICENSE}(?: {V2})?",)),
    ("lgpl", 3, "lesser general", 0.8, (rf"(?:gnu )?lesser general public {LICENSE}", r"lesser gpl")),
    ("lgpl-3.0", 3, "lgpl", 0.85, (r"lgpl ?v ?3(?: 0)?", r"lgpl (?:version )?3(?: 0)?")),
    ("lgpl-2.1", 3, "lgpl", 0.85, (r"lgpl ?v ?2 1", r"lgpl (?:version )?2 1")),
    ("lgpl", 4, "lgpl", 0.6, (r"gnu lgpl", r"lgpl licen[sc]ed?", r"under (?:the )?lgpl", r"lgpl")),
    ("agpl-3.0", 2, "affero", 0.95, (rf"(?:gnu )?affero general public {LICENSE} {V3}{LATER}?",)),
    ("agpl", 3, "affero", 0.8, (rf"(?:gnu )?affero general public {LICENSE}", rf"affero gpl", rf"affero {LICENSE}")),
    ("agpl-3.0", 3, "agpl", 0.85, (r"agpl ?v? ?3(?: 0)?", r"agpl version 3(?: 0)?")),
    ("agpl", 4, "agpl", 0.6, (r"gnu agpl", r"under (?:the )?agpl", r"agpl")),
    ("gfdl", 2, "free documentation", 0.95, (rf"gnu free documentation {LICENSE}(?: version)?(?: 1 [123])?", rf"free documentation {LICENSE}")),
    ("gfdl", 4, "gfdl", 0.6, (r"gfdl(?: 1 [123])?",)),
    ("bsd-3-clause", 1, "redistribution and use in source", 1.0, (
        r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met[a-z0-9 ]{0,900}neither the name of",
    )),
    ("bsd-2-clause", 2, "redistribution and use in source", 0.9, (
        r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    )),
    ("bsd-3-clause", 2, "bsd", 0.95, (
        r"bsd 3 clause(?: licen[sc]e)?", r"3 clause bsd(?: licen[sc]e)?", r"three clause bsd(?: licen[sc]e)?",
        rf"(?:new|modified|revised) bsd {LICENSE}", r"opensource org licenses bsd 3 clause",
    )),
    ("bsd-2-clause", 2, "bsd", 0.95, (
        r"bsd 2 clause(?: licen[sc]e)?", r"2 clause bsd(?: licen[sc]e)?", r"two clause bsd(?: licen[sc]e)?",
        rf"(?:simplified|freebsd) (?:bsd )?{LICENSE}", r"opensource org licenses bsd 2 clause",
    )),
    ("bsd-4-clause", 2, "bsd", 0.95, (r"bsd 4 clause(?: licen[sc]e)?", rf"(?:original|old) bsd {LICENSE}", r"4 clause bsd(?: licen[sc]e)?")),
    ("0bsd", 2, "bsd", 0.95, (r"zero clause bsd(?: licen[sc]e)?", r"bsd zero clause(?: licen[sc]e)?", r"0bsd(?: licen[sc]e)?")),
    ("bsd", 3, "bsd", 0.75, (rf"bsd {LICENSE}", rf"bsd (?:style|like) {LICENSE}", r"berkeley software distribution licen[sc]e", r"bsd licensed")),
    ("mpl-2.0", 2, "mozilla public", 0.95, (
        rf"mozilla public {LICENSE} {V2}", rf"subject to the terms of the mozilla public {LICENSE} {V2}",
        r"mozilla org mpl 2 0",
    )),
    ("mpl-1.1", 2, "mozilla public", 0.95, (rf"mozilla public {LICENSE} (?:version |v ?)?1 1",)),
    ("mpl", 3, "mozilla", 0.8, (rf"mozilla public {LICENSE}", r"mozilla licen[sc]e")),
    ("mpl-2.0", 3, "mpl", 0.85, (r"mpl ?v? ?2(?: 0)?", r"mplv2")),
    ("epl-2.0", 2, "eclipse", 0.95, (rf"eclipse public {LICENSE} {V2}", r"eclipse org legal epl 2 0")),
    ("epl-1.0", 2, "eclipse", 0.95, (rf"eclipse public {LICENSE} (?:version |v ?)?1(?: 0)?", r"eclipse org legal epl v10")),
    ("epl", 3, "eclipse", 0.8, (rf"eclipse public {LICENSE}", rf"eclipse distribution {LICENSE}")),
    ("cddl-1.0", 2, "common development", 0.95, (rf"common development and distribution {LICENSE}(?: (?:version |v ?)?1 [01])?",)),
    ("cddl", 4, "cddl", 0.6, (r"cddl(?: 1 [01])?",)),
    ("cpl-1.0", 3, "common public", 0.85, (rf"common public {LICENSE}(?: (?:version |v ?)?1 0)?",)),
    ("eupl-1.2", 2, "european union public", 0.95, (rf"european union public {LICENSE}(?: (?:version |v ?)?1 [12])?",)),
    ("eupl", 4, "eupl", 0.6, (r"eupl(?: v?1 [12])?",)),
    ("osl-3.0", 3, "open software", 0.85, (rf"open software {LICENSE}(?: {V3})?",)),
    ("afl-3.0", 3, "academic free", 0.85, (rf"academic free {LICENSE}(?: {V3})?",)),
    ("artistic-2.0", 2, "artistic", 0.95, (rf"artistic {LICENSE} {V2}", r"artistic 2 0")),
    ("artistic", 3, "artistic", 0.8, (rf"(?:the )?(?:clarified )?artistic {LICENSE}", rf"perl artistic {LICENSE}")),
    ("perl", 3, "perl", 0.8, (r"under the same terms as perl(?: itself)?", r"same terms as the perl 5 programming language")),
    ("bsl-1.0", 2, "boost", 0.95, (rf"boost software {LICENSE}(?: (?:version |v ?)?1(?: 0)?)?", r"www boost org license 1 0 txt")),
    ("busl-1.1", 2, "business source", 0.95, (rf"business source {LICENSE}(?: (?:version |v ?)?1 1)?",)),
    ("sspl-1.0", 2, "server side public", 0.95, (rf"server side public {LICENSE}(?: (?:version |v ?)?1(?: 0)?)?",)),
    ("elastic-2.0", 2, "elastic", 0.95, (rf"elastic {LICENSE}(?: {V2})?",)),
    ("commons-clause", 2, "commons clause", 0.95, (rf"commons clause(?: {LICENSE})?(?: condition)?(?: v?1 0)?",)),
    ("zlib", 1, "provided as is without any express", 1.0, (
        r"this software is provided as is without any express or implied warranty in no event will the authors be held liable",
    )),
    ("zlib", 3, "zlib", 0.85, (rf"zlib {LICENSE}", rf"zlib libpng {LICENSE}", r"under the zlib licen[sc]e")),
    ("libpng", 3, "libpng", 0.85, (rf"libpng {LICENSE}(?: version 2)?",)),
    ("openssl", 3, "openssl", 0.85, (rf"openssl {LICENSE}", rf"openssl ssleay {LICENSE}")),
    ("php-3.01", 3, "php", 0.85, (rf"php {LICENSE}(?: (?:version |v ?)?3 01?)?",)),
    ("python-2.0", 3, "python", 0.85, (rf"python software foundation {LICENSE}(?: {V2})?", rf"psf {LICENSE}", rf"python {LICENSE}")),
    ("ruby", 3, "ruby", 0.8, (rf"ruby {LICENSE}", rf"same terms as ruby")),
    ("postgresql", 3, "postgresql", 0.85, (rf"postgresql {LICENSE}",)),
    ("ncsa", 3, "ncsa", 0.85, (rf"(?:university of illinois )?ncsa (?:open source )?{LICENSE}",)),
    ("ms-pl", 3, "microsoft", 0.85, (rf"microsoft public {LICENSE}", rf"microsoft permissive {LICENSE}")),
    ("ms-rl", 3, "microsoft", 0.85, (rf"microsoft reciprocal {LICENSE}",)),
    ("unicode", 3, "unicode", 0.85, (rf"unicode (?:data files and software )?{LICENSE}(?: (?:v|version )?3)?",)),
    ("w3c", 3, "w3c", 0.85, (rf"w3c (?:software(?: and document)?(?: notice and)? )?{LICENSE}",)),
    ("upl-1.0", 3, "universal permissive", 0.85, (rf"universal permissive {LICENSE}(?: (?:version |v ?)?1 0)?",)),
    ("unlicense", 1, "unencumbered", 1.0, (r"this is free and unencumbered software released into the public domain",)),
    ("unlicense", 2, "unlicen", 0.95, (r"the unlicense", r"unlicense org", r"released under the unlicense")),
    ("wtfpl", 2, "what the", 0.95, (rf"do what the f[a-z]* you want to public {LICENSE}",)),
    ("wtfpl", 4, "wtfpl", 0.7, (r"wtfpl(?: version 2)?",)),
    ("beerware", 3, "beer", 0.85, (rf"the beer ware {LICENSE}", r"beerware licen[sc]e")),
    ("json", 3, "shall be used for good", 0.9, (r"the software shall be used for good not evil",)),
    ("ofl-1.1", 2, "open font", 0.95, (rf"(?:sil )?open font {LICENSE}(?: (?:version |v ?)?1 [01])?",)),
    ("odbl-1.0", 2, "open database", 0.95, (rf"open (?:data commons open )?database {LICENSE}(?: (?:version |v ?)?1 0)?", r"odbl 1 0")),
    ("odc-by-1.0", 2, "open data commons", 0.95, (rf"open data commons attribution {LICENSE}(?: (?:version |v ?)?1 0)?",)),
    ("pddl-1.0", 2, "public domain dedication and", 0.95, (rf"(?:open data commons )?public domain dedication and {LICENSE}(?: 1 0)?",)),
    ("ogl-uk-3.0", 3, "open government", 0.85, (rf"open government {LICENSE}(?: {V3})?",)),
    ("cdla-permissive", 3, "community data", 0.85, (rf"community data {LICENSE} agreement permissive",)),
    ("cdla-sharing", 3, "community data", 0.85, (rf"community data {LICENSE} agreement sharing",)),
    ("openrail", 3, "rail", 0.85, (rf"(?:creativeml |bigscience )?open rail(?: m)? {LICENSE}", rf"openrail(?: m)? {LICENSE}", r"responsible ai licen[sc]e")),
    ("cc0-1.0", 2, "cc0", 0.95, (r"cc0 1 0(?: universal)?", r"creative commons cc0", r"cc0 public domain dedication", r"under cc0")),
    ("cc0-1.0", 2, "publicdomain", 0.95, (r"creativecommons org publicdomain zero 1 0",)),
    ("cc0-1.0", 2, "creative commons zero", 0.95, (r"creative commons zero(?: v?1 0)?",)),
    ("cc-by-nc-nd", 1, "cc by nc nd", 1.0, (r"cc by nc nd(?: [1-4] [05])?(?: international)?",)),
    ("cc-by-nc-sa", 1, "cc by nc sa", 1.0, (r"cc by nc sa(?: [1-4] [05])?(?: international)?",)),
    ("cc-by-nc", 1, "cc by nc", 1.0, (r"cc by nc(?: [1-4] [05])?(?: international)?", r"licensed under (?:a )?cc by nc(?: [1-4] [05])?")),
    ("cc-by-nd", 1, "cc by nd", 1.0, (r"cc by nd(?: [1-4] [05])?(?: international)?", r"licensed under (?:a )?cc by nd(?: [1-4] [05])?")),
    ("cc-by-sa", 1, "cc by sa", 1.0, (r"cc by sa(?: [1-4] [05])?(?: international)?", r"licensed under (?:a )?cc by sa(?: [1-4] [05])?")),
    ("cc-by-4.0", 2, "cc by", 0.95, (r"cc by 4 0(?: international)?", r"licensed under (?:a )?cc by 4 0")),
    ("cc-by-3.0", 2, "cc by", 0.95, (r"cc by 3 0(?: unported)?",)),
    ("cc-by", 3, "cc by", 0.8, (r"cc by(?: [12] [05])?", r"under (?:a )?cc by")),
    ("cc-by-nc-nd", 1, "noncommercial noderiv", 1.0, (r"creative commons attribution noncommercial noderiv(?:s|atives)(?: [1-4] [05])?",)),
    ("cc-by-nc-sa", 1, "noncommercial sharealike", 1.0, (r"creative commons attribution noncommercial sharealike(?: [1-4] [05])?",)),
    ("cc-by-nc", 2, "creative commons", 0.95, (r"creative commons attribution non ?commercial(?: [1-4] [05])?",)),
    ("cc-by-sa", 2, "creative commons", 0.95, (r"creative commons attribution share ?alike(?: [1-4] [05])?",)),
    ("cc-by-nd", 2, "creative commons", 0.95, (r"creative commons attribution no ?deriv(?:s|atives)(?: [1-4] [05])?",)),
    ("cc-by", 3, "creative commons", 0.85, (rf"creative commons attribution(?: [1-4] [05])?(?: international)?(?: public)?(?: {LICENSE})?",)),
    ("cc", 4, "creative commons", 0.6, (rf"creative commons {LICENSE}", rf"under (?:a )?creative commons")),
    ("cc-by-nc-nd", 2, "creativecommons", 0.95, (r"creativecommons org licenses by nc nd(?: \d \d)?",)),
    ("cc-by-nc-sa", 2, "creativecommons", 0.95, (r"creativecommons org licenses by nc sa(?: \d \d)?",)),
    ("cc-by-nc", 3, "creativecommons", 0.9, (r"creativecommons org licenses by nc(?: \d \d)?",)),
    ("cc-by-sa", 2, "creativecommons", 0.95, (r"creativecommons org licenses by sa(?: \d \d)?",)),
    ("cc-by-nd", 2, "creativecommons", 0.95, (r"creativecommons org licenses by nd(?: \d \d)?",)),
    ("cc-by", 3, "creativecommons", 0.9, (r"creativecommons org licenses by(?: \d \d)?",)),
    ("public-domain", 2, "public domain", 0.85, (
        r"(?:released|placed|dedicated|is) (?:in|into|to) the public domain", r"public domain work", r"this work is in the public domain",
    )),
    ("all-rights-reserved", 3, "all rights reserved", 0.8, (r"copyright (?:c )?(?:\d{4} )?[^ ]+(?: [^ ]+){0,6} all rights reserved",)),
    ("all-rights-reserved", 4, "all rights reserved", 0.6, (r"all rights reserved",)),
    ("proprietary", 3, "proprietary", 0.8, (rf"proprietary and confidential", rf"proprietary {LICENSE}", r"unauthorized copying of this file")),
    ("eula", 3, "end user", 0.8, (rf"end user {LICENSE} agreement",)),
    ("commercial", 4, "commercial", 0.6, (rf"commercial {LICENSE}", rf"{LICENSE} fee", r"commercially licensed")),
    ("no-warranty", 5, "warrant", 0.3, (
        r"without warranties or conditions of any kind", r"without any warranty without even the implied warranty of merchantability",
        r"provided as is without warranty of any kind", r"disclaims all warranties",
    )),
    ("license-hint", 5, "licen", 0.2, (rf"see the {LICENSE} file", rf"under the terms of the {LICENSE}", rf"{LICENSE} agreement", r"licensed under", r"open source licen[sc]e")),
    ("copyright-hint", 5, "copyright", 0.2, (r"copyright c \d{4}", r"copyright \d{4}", r"copyright holders?")),
]

# Names that stand behind an identifier tag; their rules are made from the names.
IDENTIFIERS = [
    "0BSD", "AFL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-1.1", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause",
    "BSD-3-Clause", "BSD-4-Clause", "BSL-1.0", "BUSL-1.1", "CC-BY-3.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-4.0",
    "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "CC-BY-SA-3.0", "CC-BY-SA-4.0", "CC0-1.0", "CDDL-1.0", "CPL-1.0", "ECL-2.0", "EPL-1.0",
    "EPL-2.0", "EUPL-1.2", "GFDL-1.3", "GPL-1.0-only", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later",
    "ISC", "LGPL-2.0-only", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0",
    "MPL-1.1", "MPL-2.0", "MS-PL", "MS-RL", "NCSA", "ODbL-1.0", "OFL-1.1", "OSL-3.0", "PDDL-1.0", "PHP-3.01", "PostgreSQL",
    "Python-2.0", "Ruby", "SSPL-1.0", "Unlicense", "UPL-1.0", "Vim", "W3C", "WTFPL", "X11", "Zlib", "ZPL-2.1",
]


OPEN, CLOSE = "(?<![^ ])(?:", ")(?![^ ])"  # word boundaries of normalised text
SHARED_STEMS = ("licen", "gpl", "bsd", "commons", "apache", "public", "reserved", "warrant", "permi", "software", "copyright", "perl", "ruby", "mpl", "cc")


def needed_word(pattern: str, keyword: str) -> str:
    """A stretch of letters without which the pattern can't match: one that many patterns share, else its longest."""
    inner = pattern.removeprefix(OPEN).removesuffix(CLOSE).replace("licen[sc]e", "licen")
    fixed, before = re.sub(r"\[[^\]]*\]|\\.", " ", inner), ""
    while fixed != before:  # groups from the inside out: optional ones and alternatives don't count
        fixed, before = re.sub(r"\((?:\?:)?[^()]*\)(?:\?|\{[^}]*\})?", " ", fixed), fixed
    letters = re.findall("[a-z]+", re.sub(r"[a-z0-9]\?|\{[^}]*\}", " ", fixed))
    longest = max(letters, key=len, default="")
    shared = next((stem for stem in SHARED_STEMS if any(stem in run for run in letters)), None)
    return shared or (longest if len(longest) > 2 else max(keyword.split(), key=len))


def signatures() -> list[tuple[str, int, str, float, str]]:
    """(label, priority, keyword, confidence, pattern) in order; patterns stand on word boundaries."""
    named = [(label, priority, keyword, confidence, pattern)
             for label, priority, keyword, confidence, patterns in FAMILIES for pattern in patterns]
    tagged = [(name.lower(), 1, "spdx license identifier", 1.0,
               "spdx license identifier " + name.lower().replace("-", " ").replace(".", " ")) for name in IDENTIFIERS]
    return [(*rule[:4], OPEN + rule[4] + CLOSE) for rule in sorted(tagged + named, key=lambda r: r[1])]
