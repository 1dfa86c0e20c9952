"""Licence scans, in DataFrame functions only.

A text is reduced to its words (ASCII lower case, joined by single spaces).
Base phrases are counted everywhere. A table of signature rules, each a
regular expression behind a keyword that must occur first, is then tried on
the texts that hold any licence word; overlapping detections are resolved by
rule priority: a detection whose interval lies within that of one with the
same or a better priority is dropped.

Defined cases: a null or empty text has no words, no labels and score 0; rows
may repeat, also with null or equal doc_ids (rows are told apart by doc_id
and a hash of the text, and equal rows get equal answers).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendorlens.llm.common import ascii_lower, read

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
BASE_CONFIDENCE = 0.5

# Signature rules: priority, label, keyword and pattern over the joined words,
# written by hand, a line each. Priority 1 is a full licence statement or
# identifier, 2 a licence named with a version, 3 a bare name, 4 a hint. Every
# match of a pattern contains its keyword from the start of a word.
FULL, VERSIONED, NAMED, HINT = 1, 2, 3, 4
CONFIDENCE = {FULL: 1.0, VERSIONED: 0.9, NAMED: 0.7, HINT: 0.3}
WORDING = [(int(line[0]), *line[2:].split(" | ")) for line in """\
1 mit | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software
1 mit | above copyright notice | the above copyright notice and this permission notice shall be included in all copies
1 isc | permission to use | permission to use copy modify and or distribute this software for any purpose with or without fee
1 bsd-2-clause | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted
1 bsd-3-clause | neither the name | neither the name of (?:[^ ]+ ){1,8}nor the names of (?:its|the) contributors
1 bsd-4-clause | advertising materials | all advertising materials mentioning features or use of this software must display
1 apache-2.0 | licensed under the apache | licensed under the apache license version 2 0
1 apache-2.0 | compliance with the license | you may not use this file except in compliance with the license
1 gpl | free software | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
1 gpl | later version | gnu general public license (?:as published by the free software foundation )?(?:either )?version [123](?: 0)? (?:of the license )?or (?:at your option )?any later version
1 unlicense | unencumbered | this is free and unencumbered software released into the public domain
1 cc0-1.0 | waived all copyright | waived all copyright and related or neighboring rights
1 zlib | provided as is | this software is provided as is without any express or implied warranty in no event will the authors be held liable
1 mpl-2.0 | mozilla public | this source code form is subject to the terms of the mozilla public license v(?:ersion)? ?2 0
1 wtfpl | just do what | you just do what the fuck you want to
1 mit | mit license | (?:released|licensed|distributed|available) under the (?:terms of the )?mit license
3 mit | mit license | (?:the )?(?:expat )?mit license
3 mit | spdx | spdx license identifier mit
3 isc | isc license | (?:the )?isc license
3 apache | apache | apache (?:software )?licen[sc]e
3 apache | apache asl | apache asl
3 gpl | gpl | (?:gnu )?gpl
3 lgpl | lgpl | (?:gnu )?lgpl
3 agpl | agpl | (?:gnu )?agpl
3 fdl | gfdl | (?:gnu )?gfdl
3 cddl | cddl | cddl
3 eupl | eupl | eupl
3 gpl | general public | (?:gnu )?general public licen[sc]e
3 lgpl | lesser general | (?:gnu )?lesser general public licen[sc]e
3 lgpl | library general | (?:gnu )?library general public licen[sc]e
3 agpl | affero | (?:gnu )?affero general public licen[sc]e
3 fdl | free documentation | (?:gnu )?free documentation licen[sc]e
3 mpl | mozilla public | mozilla public licen[sc]e
3 epl | eclipse public | eclipse public licen[sc]e
3 cddl | development and distribution | common development and distribution licen[sc]e
3 eupl | european union public | european union public licen[sc]e
3 osl | open software license | open software license
3 afl | academic free | academic free licen[sc]e
3 artistic | artistic license | (?:perl )?artistic license
3 boost | boost software | boost software licen[sc]e
3 ofl | open font | (?:sil )?open font licen[sc]e
3 python | python software foundation | python software foundation licen[sc]e
3 php | php license | php license
3 zlib | zlib license | zlib license
3 unlicense | unlicense | (?:the )?unlicense
3 wtfpl | wtfpl | wtfpl
3 beerware | beerware | beerware(?: license)?
3 ms-pl | microsoft public | microsoft public licen[sc]e
3 ms-rl | microsoft reciprocal | microsoft reciprocal licen[sc]e
3 cecill | cecill | cecill(?: [abc])?(?: license)?
3 odbl | open database license | open database license
3 pddl | public domain dedication | public domain dedication and license
3 cc0 | cc0 | cc0
3 cc | creative commons | creative commons
3 public-domain | public domain | (?:released|dedicated) (?:in)?to the public domain
4 public-domain | public domain | public domain
4 copyright | copyright | copyright (?:c )?(?:19|20)[0-9]{2}
4 copyright | copyright | copyrighted (?:by|material)
4 reserved | rights reserved | (?:all|some|no) rights reserved
4 proprietary | proprietary | proprietary and confidential
4 proprietary | unauthorized copying | unauthorized copying of this (?:file|document)
1 mit | without restriction including | to deal in the software without restriction including without limitation the rights to use copy modify merge publish
1 mit | substantial portions | (?:shall be included in )?all copies or substantial portions of the software
1 mit | authors or copyright holders | in no event shall the authors or copyright holders be liable for any claim damages or other liability
1 x11 | x consortium | the name of the x consortium shall not be used in advertising
2 mit-0 | mit no attribution | mit no attribution(?: licen[sc]e)?
3 mit | mit licence | (?:the )?(?:expat )?mit licence
3 mit | mit licensed | mit licensed
3 mit | under mit | (?:licensed|released|distributed|available) under mit
3 mit | dual licensed | dual licensed (?:under )?(?:the )?mit
3 bsd | bsd license | (?:the )?bsd license
3 bsd | bsd licence | (?:the )?bsd licence
3 bsd | bsd licensed | bsd licensed
3 bsd | bsd style | bsd style(?: licen[sc]e)?
2 bsd-3-clause | new bsd | (?:the )?new bsd licen[sc]e
2 bsd-3-clause | modified bsd | (?:the )?modified bsd licen[sc]e
2 bsd-3-clause | revised bsd | (?:the )?revised bsd licen[sc]e
2 bsd-2-clause | simplified bsd | (?:the )?simplified bsd licen[sc]e
2 bsd-2-clause | freebsd licen | (?:the )?freebsd licen[sc]e
2 bsd-4-clause | original bsd | (?:the )?original bsd licen[sc]e
2 0bsd | zero clause bsd | zero clause bsd(?: licen[sc]e)?
2 0bsd | 0bsd | 0bsd
1 bsd | redistributions of source | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
1 bsd | redistributions in binary | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
1 bsd-3-clause | endorse or promote | endorse or promote products derived from this software without specific prior written permission
1 bsd-4-clause | university of california | this product includes software developed by the university of california berkeley
3 isc | isc licence | (?:the )?isc licence
3 isc | isc licensed | isc licensed
3 isc | isc | (?:licensed|released|distributed|available) under (?:the )?isc
1 isc | disclaims all warranties | the author disclaims all warranties with regard to this software including all implied warranties
1 apache-2.0 | apache org licenses | apache org licenses license 2 0
1 apache-2.0 | without warranties or conditions | distributed on an as is basis without warranties or conditions of any kind
1 apache-2.0 | each contributor hereby grants | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable
1 apache-2.0 | january 2004 | apache license version 2 0 january 2004
1 apache-1.1 | apache software foundation | this product includes software developed by the apache software foundation
1 gpl | hope that it will be useful | distributed in the hope that it will be useful but without any warranty
1 gpl | received a copy of the gnu general | you should have received a copy of the gnu general public license
1 lgpl | received a copy of the gnu lesser | you should have received a copy of the gnu lesser general public license
1 agpl | received a copy of the gnu affero | you should have received a copy of the gnu affero general public license
1 gpl | permitted to copy and distribute verbatim | everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed
1 lgpl | library is free software | this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license
1 agpl | remote network interaction | remote network interaction use with the gnu general public license
1 gpl-2.0 | june 1991 | (?:gnu )?general public license version 2 june 1991
1 gpl-3.0 | 29 june 2007 | (?:gnu )?general public license version 3 29 june 2007
1 lgpl-2.1 | february 1999 | (?:gnu )?lesser general public license version 2 1 february 1999
1 lgpl-3.0 | 29 june 2007 | (?:gnu )?lesser general public license version 3 29 june 2007
1 agpl-3.0 | 19 november 2007 | (?:gnu )?affero general public license version 3 19 november 2007
1 fdl | invariant sections | with no invariant sections no front cover texts and no back cover texts
2 gpl-classpath | classpath exception | (?:gnu )?classpath exception
2 gpl-linking | linking exception | linking exception
2 gpl-linking | gcc runtime | gcc runtime library exception
2 gpl-2.0-only | gpl 2 0 only | gpl 2 0 only
2 gpl-2.0-or-later | gpl 2 0 or later | gpl 2 0 or later
2 gpl-3.0-only | gpl 3 0 only | gpl 3 0 only
2 gpl-3.0-or-later | gpl 3 0 or later | gpl 3 0 or later
2 lgpl-2.0-only | lgpl 2 0 only | lgpl 2 0 only
2 lgpl-2.0-or-later | lgpl 2 0 or later | lgpl 2 0 or later
2 lgpl-2.1-only | lgpl 2 1 only | lgpl 2 1 only
2 lgpl-2.1-or-later | lgpl 2 1 or later | lgpl 2 1 or later
2 lgpl-3.0-only | lgpl 3 0 only | lgpl 3 0 only
2 lgpl-3.0-or-later | lgpl 3 0 or later | lgpl 3 0 or later
2 agpl-3.0-only | agpl 3 0 only | agpl 3 0 only
2 agpl-3.0-or-later | agpl 3 0 or later | agpl 3 0 or later
1 mpl-2.0 | mpl was not distributed | a copy of the mpl was not distributed with this file
1 mpl-1.1 | subject to the mozilla | subject to the mozilla public license version 1 1
1 mpl | initial developer of the original code | the initial developer of the original code is
1 mpl-2.0 | incompatible with secondary | this source code form is incompatible with secondary licenses
1 epl-2.0 | accompanying materials are made | accompanying materials are made available under the terms of the eclipse public license (?:v )?2 0
1 epl-1.0 | accompanying materials are made | accompanying materials are made available under the terms of the eclipse public license v(?:ersion )?1 0
1 cddl | cddl header start | cddl header start
1 cddl | subject to the terms of the common | subject to the terms of the common development and distribution license
1 eupl | under the eupl | licensed under the eupl(?: version)? 1 [012]
1 unlicense | anyone is free to copy | anyone is free to copy modify publish use compile sell or distribute this software
1 unlicense | dedicate any and all copyright | dedicate any and all copyright interest in the software to the public domain
1 cc0-1.0 | dedicated the work | the person who associated a work with this deed has dedicated the work to the public domain
1 cc0-1.0 | cc0 1 0 universal | cc0 1 0 universal
1 cc0-1.0 | publicdomain zero | creativecommons org publicdomain zero 1 0
1 public-domain | publicdomain mark | creativecommons org publicdomain mark 1 0
1 cc-by-4.0 | licenses by 4 0 | creativecommons org licenses by 4 0
1 cc-by-3.0 | licenses by 3 0 | creativecommons org licenses by 3 0
1 cc-by-sa-4.0 | licenses by sa 4 0 | creativecommons org licenses by sa 4 0
1 cc-by-sa-3.0 | licenses by sa 3 0 | creativecommons org licenses by sa 3 0
1 cc-by-nc-4.0 | licenses by nc 4 0 | creativecommons org licenses by nc 4 0
1 cc-by-nc-sa-4.0 | licenses by nc sa 4 0 | creativecommons org licenses by nc sa 4 0
1 cc-by-nc-nd-4.0 | licenses by nc nd 4 0 | creativecommons org licenses by nc nd 4 0
1 cc-by-nd-4.0 | licenses by nd 4 0 | creativecommons org licenses by nd 4 0
1 zlib | alter it and redistribute it freely | alter it and redistribute it freely subject to the following restrictions
1 zlib | must not be misrepresented | the origin of this software must not be misrepresented
3 zlib | zlib libpng | zlib libpng licen[sc]e
3 libpng | libpng licen | libpng licen[sc]e
1 boost-1.0 | distributed under the boost | distributed under the boost software license version 1 0
1 boost-1.0 | accompanying documentation covered | obtaining a copy of the software and accompanying documentation covered by this license
1 wtfpl | what the fuck you want | do what the fuck you want to public license
1 beerware | buy me a beer | you can buy me a beer in return
1 artistic | same terms as perl | under the same terms as perl itself
1 artistic-1.0 | intent of this document | the intent of this document is to state the conditions under which a package may be copied
1 postgresql | without a written agreement | for any purpose without fee and without a written agreement is hereby granted
3 postgresql | postgresql licen | (?:the )?postgresql licen[sc]e
1 hpnd | appear in supporting documentation | both that copyright notice and this permission notice appear in supporting documentation
3 ncsa | ncsa open source | (?:university of illinois )?ncsa open source licen[sc]e
1 openssl | openssl toolkit | developed by the openssl project for use in the openssl toolkit
3 openssl | openssl licen | openssl licen[sc]e
3 ruby | ruby licen | ruby licen[sc]e
1 ruby | same terms as ruby | under the same terms as ruby
3 vim | vim licen | vim licen[sc]e
3 curl | curl licen | curl licen[sc]e
3 info-zip | info zip licen | info zip licen[sc]e
3 icu | icu licen | icu licen[sc]e
3 unicode | unicode licen | unicode licen[sc]e(?: agreement)?
1 unicode | unicode data files | any person obtaining a copy of the unicode data files
1 ofl-1.1 | font software is licensed | this font software is licensed under the sil open font license version 1 1
2 ofl | reserved font name | with reserved font names?
3 python | psf licen | psf licen[sc]e(?: agreement)?
1 python | psf is making python | psf is making python available to licensee on an as is basis
1 ms-pl | governs use of the accompanying | this license governs use of the accompanying software if you use the software you accept this license
3 ms-pl | ms pl | ms pl
3 ms-rl | ms rl | ms rl
1 json | good not evil | the software shall be used for good not evil
2 elastic-2.0 | elastic licen | elastic licen[sc]e 2 0
3 elastic | elastic licen | elastic licen[sc]e
3 sspl | server side public | server side public licen[sc]e
3 sspl | sspl | sspl
3 busl | business source licen | business source licen[sc]e
3 commons-clause | commons clause | commons clause(?: licen[sc]e condition)?
3 llama | community licen | llama [23] community licen[sc]e(?: agreement)?
3 openrail | openrail | (?:creativeml |bigscience )?openrail(?: m| d| s)?
3 odc-by | open data commons attribution | open data commons attribution licen[sc]e
3 odc-by | odc by | odc by
3 odbl | odbl | odbl
3 ogl | open government licen | open government licen[sc]e
3 ogl | crown copyright | crown copyright
3 etalab | licence ouverte | licence ouverte
3 dl-de | datenlizenz deutschland | datenlizenz deutschland (?:namensnennung|zero)
3 nasa | nasa open source | nasa open source agreement
3 qpl | q public licen | q public licen[sc]e
3 sleepycat | sleepycat | sleepycat licen[sc]e
3 watcom | watcom | (?:sybase )?open watcom(?: public)? licen[sc]e
3 cpal | common public attribution | common public attribution licen[sc]e
3 cpl | common public licen | common public licen[sc]e
3 ipl | ibm public licen | ibm public licen[sc]e
3 apsl | apple public source | apple public source licen[sc]e
3 npl | netscape public | netscape public licen[sc]e
3 spl | sun public licen | sun public licen[sc]e
3 rpl | reciprocal public | reciprocal public licen[sc]e
3 nokia | nokia open source | nokia open source licen[sc]e
3 intel | intel open source | intel open source licen[sc]e
3 w3c | w3c software notice | w3c software notice and (?:document )?licen[sc]e
3 lppl | latex project public | latex project public licen[sc]e
1 lppl | conditions of the latex | distributed and or modified under the conditions of the latex project public license
3 d-fsl | deutsche freie software | deutsche freie software lizenz
1 cecill | under french law | governed by the cecill(?: [bc])? license under french law
3 mulan | mulan | mulan (?:psl|permissive software licen[sc]e)(?: v[12])?
3 upl | universal permissive | universal permissive licen[sc]e
3 aal | attribution assurance | attribution assurance licen[sc]e
3 ftl | freetype | freetype (?:project )?licen[sc]e
3 ijg | independent jpeg group | (?:work of )?the independent jpeg group
3 tcl | tcl tk licen | tcl tk licen[sc]e
3 blueoak | blue oak model | blue oak model licen[sc]e
3 hippocratic | hippocratic | hippocratic licen[sc]e
3 parity | parity public | parity public licen[sc]e
3 polyform | polyform | polyform (?:noncommercial|small business|shield|strict|perimeter)(?: licen[sc]e)?
3 miros | miros licen | miros licen[sc]e
3 fair | fair licen | fair licen[sc]e
3 motosoto | motosoto | motosoto open source licen[sc]e
3 entessa | entessa | entessa public licen[sc]e
3 realnetworks | realnetworks public | realnetworks public source licen[sc]e
3 zimbra | zimbra public | zimbra public licen[sc]e
3 sugarcrm | sugarcrm public | sugarcrm public licen[sc]e
3 xfree86 | xfree86 | xfree86(?: project)? licen[sc]e
4 proprietary | confidential and proprietary | confidential and proprietary
4 proprietary | trade secret | trade secrets? of
4 proprietary | may not be reproduced | may not be reproduced (?:or transmitted )?in any form
4 proprietary | strictly prohibited | (?:copying|reproduction|redistribution|distribution) is strictly prohibited
4 proprietary | internal use only | for internal use only
4 eula | end user licen | end user licen[sc]e agreement
4 copyright | protected by | protected by (?:international )?copyright
4 non-commercial | commercial use only | (?:for )?non commercial use only
4 non-commercial | noncommercial use | (?:for )?noncommercial use(?: only)?
4 royalty-free | royalty free | royalty free(?: licen[sc]e)?
4 open-source | open source licen | open source licen[sc]e
4 copyleft | copyleft | copyleft
4 shareware | shareware | shareware
4 freeware | freeware | freeware
4 public-domain | known copyright | no known copyright restrictions
""".splitlines()]
# Families with versions: (label, keyword, name in words, identifier in words, versions).
FAMILIES = [
    ("gpl", "gpl", r"(?:gnu )?gpl", "gpl", "1.0 2.0 3.0"),
    ("gpl", "general public", r"(?:gnu )?general public licen[sc]e", "gpl", "1.0 2.0 3.0"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl", "lgpl", "2.0 2.1 3.0"),
    ("lgpl", "lesser general", r"(?:gnu )?lesser general public licen[sc]e", "lgpl", "2.0 2.1 3.0"),
    ("agpl", "agpl", r"(?:gnu )?agpl", "agpl", "1.0 3.0"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[sc]e", "agpl", "1.0 3.0"),
    ("fdl", "gfdl", r"(?:gnu )?gfdl", "gfdl", "1.1 1.2 1.3"),
    ("fdl", "free documentation", r"(?:gnu )?free documentation licen[sc]e", "gfdl", "1.1 1.2 1.3"),
    ("apache", "apache", r"apache(?: software)?(?: licen[sc]e)?", "apache", "1.0 1.1 2.0"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e", "mpl", "1.0 1.1 2.0"),
    ("mpl", "mpl", r"mpl", "mpl", "1.0 1.1 2.0"),
    ("epl", "eclipse", r"eclipse public licen[sc]e", "epl", "1.0 2.0"),
    ("cddl", "cddl", r"cddl", "cddl", "1.0 1.1"),
    ("eupl", "eupl", r"eupl", "eupl", "1.0 1.1 1.2"),
    ("osl", "osl", r"osl", "osl", "1.0 2.0 2.1 3.0"),
    ("afl", "afl", r"afl", "afl", "1.1 1.2 2.0 2.1 3.0"),
    ("artistic", "artistic", r"(?:perl )?artistic licen[sc]e", "artistic", "1.0 2.0"),
    ("boost", "boost", r"boost software licen[sc]e", "bsl", "1.0"),
    ("ofl", "open font", r"(?:sil )?open font licen[sc]e", "ofl", "1.0 1.1"),
    ("zpl", "zope", r"zope public licen[sc]e", "zpl", "1.1 2.0 2.1"),
    ("php", "php licen", r"php licen[sc]e", "php", "3.0 3.1"),
    ("ecl", "educational community", r"educational community licen[sc]e", "ecl", "1.0 2.0"),
]
CC_VERSIONS = "1.0 2.0 2.5 3.0 4.0"
CC_KINDS = [
    ("cc-by", r"by", r"attribution"),
    ("cc-by-sa", r"by sa", r"attribution share ?alike"),
    ("cc-by-nd", r"by nd", r"attribution no ?deriv(?:s|atives|ative works)"),
    ("cc-by-nc", r"by nc", r"attribution non ?commercial"),
    ("cc-by-nc-sa", r"by nc sa", r"attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", r"by nc nd", r"attribution non ?commercial no ?deriv(?:s|atives|ative works)"),
]
def rules() -> list[tuple[int, str, str, str, float]]:
    """All signature rules: the wordings, two for every version of every
    family (name with its version, and identifier with its version), and the
    Creative Commons licences by both names with and without a version."""
    out = [(p, label, word, f"(?<= )(?:{pattern})(?= )", CONFIDENCE[p]) for p, label, word, pattern in WORDING]

    def versioned(label: str, word: str, name: str, version: str) -> None:
        major, _, minor = version.partition(".")
        tail = f"(?:v(?:ersion)? ?)?{major}" + (f"(?: {minor})?" if minor == "0" else f" {minor}")
        # a version without its zero must not be the start of another one
        out.append((VERSIONED, f"{label}-{version}", word,
                    f"(?<= )(?:{name}) ?{tail}(?= )(?! [0-9] )", CONFIDENCE[VERSIONED]))

    for label, word, name, short, versions in FAMILIES:
        for version in versions.split():
            versioned(label, word, name, version)
            versioned(label, "spdx", f"spdx license identifier {short}", version)
    for label, short, name in CC_KINDS:
        for word, named in ((f"cc {short}", f"cc {short}"), ("creative commons attribution", f"creative commons {name}")):
            out.append((NAMED, label, word, f"(?<= )(?:{named})(?= )", CONFIDENCE[NAMED]))
        for version in CC_VERSIONS.split():
            versioned(label, f"cc {short}", f"cc {short}", version)
            versioned(label, "creative commons", f"creative commons {name}(?: licen[sc]e)?", version)
    for name, versions in (("bsd", ("2", "3", "4")),):
        for n in versions:
            word = {"2": "two", "3": "three", "4": "four"}[n]
            out.append((VERSIONED, f"bsd-{n}-clause", "clause",
                        f"(?<= )(?:{name} (?:{n}|{word}) clause|(?:{n}|{word}) clause {name})(?: licen[sc]e)?(?= )", 0.9))
    return list(dict.fromkeys(out))  # families with two names have one identifier


def any_of(phrases: list[str]) -> str:
    """A regular expression of phrases as a tree of their letters, so that one
    letter of a text is compared with few."""
    if "" in phrases:
        return ""  # a longer phrase adds nothing
    by_first: dict[str, list[str]] = {}
    for phrase in phrases:
        by_first.setdefault(phrase[0], []).append(phrase[1:])
    parts = [first + any_of(rest) for first, rest in sorted(by_first.items())]
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


def gate() -> str:
    """What every text with a keyword holds, and no other."""
    return " " + any_of(sorted({word for _, _, word, _, _ in rules()}))


def joined_words(text: Column) -> Column:
    """' w1 w2 ... ': the words of the text, each after one space."""
    body = F.regexp_replace(F.concat(F.lit(" "), ascii_lower(F.coalesce(text, F.lit(""))), F.lit(" ")), NOT_WORD, " ")
    return body


def _spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.translate(s, " ", ""))


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score, n_detections."""
    base = (df.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("th"),
                      joined_words(F.col(text)).alias("s"))
              .withColumn("n_words", (_spaces(F.col("s")) - 1).cast("long")))
    gated = base.where(F.col("s").rlike(gate()))
    for i, (phrase, _) in enumerate(BASE):
        pieces = F.split("s", f" {phrase}(?= )", -1)
        base = base.withColumn(f"p{i}", F.when(F.contains("s", F.lit(f" {phrase} ")), pieces))
    found = [F.col(f"p{i}") for i in range(len(BASE))]
    count = sum((F.coalesce(F.size(p) - 1, F.lit(0)) for p in found), F.lit(0))
    first = F.least(*[_spaces(F.get(p, 0)) for p in found])
    last = F.greatest(*[F.col("n_words") - (_spaces(F.get(p, F.size(p) - 1)) - 1) - len(phrase.split())
                        for p, (phrase, _) in zip(found, BASE)])
    labels = F.array_compact(F.array(*[F.when(p.isNotNull(), label) for p, (_, label) in zip(found, BASE)]))
    base = base.select("doc_id", "th", "n_words", count.cast("long").alias("n_base"),
                       first.cast("long").alias("first_word"), last.cast("long").alias("last_word"),
                       F.array_sort(labels).alias("base"))
    more = resolve(detect(gated)).groupBy("doc_id", "th").agg(
        F.collect_set("label").alias("more"), F.max("confidence").alias("confidence"),
        F.count(F.lit(1)).alias("detections"))
    more = more.select(F.col("doc_id").alias("d"), F.col("th").alias("t"), "more", "confidence", "detections")
    out = base.join(more, base["doc_id"].eqNullSafe(more["d"]) & (base["th"] == more["t"]), "left")
    both = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    by_base = F.when(F.col("n_base") > 0, F.lit(BASE_CONFIDENCE)).otherwise(F.lit(0.0))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                      F.array_join("base", ",").alias("base_labels"), F.array_join(both, ",").alias("labels"),
                      F.greatest(by_base, F.coalesce("confidence", F.lit(0.0))).alias("score"),
                      F.coalesce("detections", F.lit(0)).cast("long").alias("n_detections"))


def detect(gated: DataFrame) -> DataFrame:
    """Every match of every rule whose keyword occurs: doc_id, th, rule,
    priority, label, confidence, start, end (characters of the joined words).
    Matches of one rule don't overlap; their places follow from the lengths of
    the pieces between them."""
    table = F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(p).alias("priority"), F.lit(label).alias("label"),
                               F.lit(f" {word}").alias("word"), F.lit(f"({pattern})").alias("pattern"), F.lit(c).alias("confidence"))
                      for i, (p, label, word, pattern, c) in enumerate(rules())])
    tried = gated.select("doc_id", "th", "s", F.explode(
        F.filter(table, lambda r: F.contains("s", r["word"]))).alias("r"))
    # one pass marks the matches; between marks, gaps and matches take turns
    tried = tried.withColumn("marked", F.regexp_replace("s", F.col("r.pattern"), F.lit("\x01$1\x01")))
    tried = tried.where(F.length("marked") > F.length("s")).withColumn("pieces", F.split("marked", "\x01", -1))
    lengths = F.transform(F.sequence(F.lit(0), F.expr("size(pieces) div 2 - 1")), lambda i: F.struct(
        i.alias("k"), F.length(F.get("pieces", 2 * i)).alias("gap"), F.length(F.get("pieces", 2 * i + 1)).alias("size")))
    rows = (tried.select("doc_id", "th", "r.rule", "r.priority", "r.label", "r.confidence",
                         F.explode(lengths).alias("m"))
                 .select("doc_id", "th", "rule", "priority", "label", "confidence", "m.k", "m.gap", "m.size")
                 .distinct())
    rows = rows.withColumn("end", F.expr(
        "sum(gap + size) OVER (PARTITION BY doc_id, th, rule ORDER BY k ROWS UNBOUNDED PRECEDING)"))
    return rows.withColumn("start", F.col("end") - F.col("size")).drop("k", "gap", "size")


def resolve(detections: DataFrame) -> DataFrame:
    """Drop each detection within one of the same or a better priority.

    Sorted by start, longest first, then priority, a containing interval
    stands before what it contains; so the furthest end among earlier rows
    of no worse priority decides. Intervals that are equal keep one."""
    order = "(PARTITION BY doc_id, th ORDER BY start, end DESC, priority, rule ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    reach = F.lit(None).cast("long")
    for p in (HINT, NAMED, VERSIONED, FULL):
        reach = F.when(F.col("priority") <= p, F.expr(f"max(CASE WHEN priority <= {p} THEN end END) OVER {order}")
                       ).otherwise(reach)
    return detections.withColumn("reach", reach).where(
        F.col("reach").isNull() | (F.col("reach") < F.col("end"))).drop("reach")


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents", "doc_id", "text"))
