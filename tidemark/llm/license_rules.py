"""Ordered signature rules for license texts.

A line is: label | keyword | patterns, one pattern after another separated by
`` ; ``.  Patterns run over lower-cased words with one space between them, so
"Apache License, Version 2.0" reads "apache license version 2 0".  ``{v}`` in
label and pattern stands for each version listed after the label as
``label: a, b``; a version's dots read as spaces in a pattern.  Lines and
patterns that stand first are more specific and outrank later ones.  A pattern
is run only on texts with its keyword, so every match of it must hold that.
"""

import re

# The rules, most specific first.
RULES = r"""
spdx-{v}: 0bsd, afl-3.0, agpl-3.0, apache-2.0, artistic-2.0, bsd-2-clause, bsd-3-clause, bsl-1.0, cc-by-4.0, cc-by-sa-4.0, cc0-1.0, epl-2.0, eupl-1.2, gpl-2.0, gpl-3.0, isc, lgpl-2.1, lgpl-3.0, mit, mpl-2.0, ofl-1.1, unlicense, wtfpl, zlib | spdx | spdx license identifier {v}
agpl-{v}: 1, 3 | affero | gnu affero general public licen[sc]e as published by the free software foundation (?:either )?version {v} ; gnu affero general public licen[sc]e (?:version |v ?){v} ; affero general public licen[sc]e (?:version |v ?){v} ; affero gpl (?:version |v ?)?{v}
agpl-{v}: 1, 3 | agpl | agpl (?:version |v ?)?{v} ; agplv{v}
lgpl-{v}: 2, 2.1, 3 | lesser | gnu lesser general public licen[sc]e as published by the free software foundation (?:either )?version {v} ; gnu lesser general public licen[sc]e (?:version |v ?){v} ; lesser general public licen[sc]e (?:version |v ?){v} ; lesser gpl (?:version |v ?)?{v}
lgpl-{v}: 2, 2.1, 3 | lgpl | lgpl (?:version |v ?)?{v} ; lgplv{v}
lgpl-2 | library general public | gnu library general public licen[sc]e(?: (?:version |v ?)2)?
gpl-{v}: 1, 2, 3 | general public | gnu general public licen[sc]e as published by the free software foundation (?:either )?version {v} ; gnu general public licen[sc]e (?:version |v ?){v} ; general public licen[sc]e (?:version |v ?){v}
gpl-{v}: 1, 2, 3 | gpl | gnu gpl (?:version |v ?)?{v} ; gpl (?:version |v ?)?{v} ; gplv{v}
gfdl-{v}: 1.1, 1.2, 1.3 | free documentation | gnu free documentation licen[sc]e (?:version |v ?)?{v} ; free documentation licen[sc]e (?:version |v ?){v}
apache-{v}: 1.0, 1.1, 2.0 | apache | licensed under the apache licen[sc]e (?:version )?{v} ; apache licen[sc]e (?:version |v ?)?{v} ; apache software licen[sc]e (?:version |v ?)?{v} ; asl (?:version |v ?)?{v} apache ; apache {v} licen[sc]e
apache-2 | apache | apache licen[sc]e version 2
mpl-{v}: 1.0, 1.1, 2.0 | mozilla | mozilla public licen[sc]e (?:version |v ?)?{v} ; mozilla public licen[sc]es? v {v}
mpl-{v}: 1.0, 1.1, 2.0 | mpl | mpl (?:version |v ?)?{v}
epl-{v}: 1.0, 2.0 | eclipse | eclipse public licen[sc]e (?:version |v ?)?{v} ; eclipse distribution licen[sc]e (?:version |v ?)?{v}
epl-{v}: 1.0, 2.0 | epl | epl (?:version |v ?)?{v}
eupl-{v}: 1.0, 1.1, 1.2 | european union | european union public licen[sc]e (?:version |v ?)?{v}
eupl-{v}: 1.0, 1.1, 1.2 | eupl | eupl (?:version |v ?)?{v}
cddl-{v}: 1.0, 1.1 | common development | common development and distribution licen[sc]e (?:version |v ?)?{v}
cddl-{v}: 1.0, 1.1 | cddl | cddl (?:version |v ?)?{v}
cc-by-nc-nd-{v}: 2.0, 2.5, 3.0, 4.0 | cc | cc by nc nd (?:version )?{v}
cc-by-nc-nd-{v}: 2.0, 2.5, 3.0, 4.0 | creative | creative commons attribution non ?commercial no ?deriv(?:ative|ative work)?s? {v}
cc-by-nc-sa-{v}: 2.0, 2.5, 3.0, 4.0 | cc | cc by nc sa (?:version )?{v}
cc-by-nc-sa-{v}: 2.0, 2.5, 3.0, 4.0 | creative | creative commons attribution non ?commercial share ?alike {v}
cc-by-nc-{v}: 2.0, 2.5, 3.0, 4.0 | cc | cc by nc (?:version )?{v}
cc-by-nc-{v}: 2.0, 2.5, 3.0, 4.0 | creative | creative commons attribution non ?commercial {v} ; creative commons attribution non ?commercial {v} international
cc-by-nd-{v}: 2.0, 2.5, 3.0, 4.0 | cc | cc by nd (?:version )?{v}
cc-by-nd-{v}: 2.0, 2.5, 3.0, 4.0 | creative | creative commons attribution no ?derivatives? {v}
cc-by-sa-{v}: 2.0, 2.5, 3.0, 4.0 | cc | cc by sa (?:version )?{v}
cc-by-sa-{v}: 2.0, 2.5, 3.0, 4.0 | creative | creative commons attribution share ?alike {v} ; creative commons attribution share ?alike {v} international
cc-by-{v}: 2.0, 2.5, 3.0, 4.0 | cc | cc by (?:version )?{v}
cc-by-{v}: 2.0, 2.5, 3.0, 4.0 | creative | creative commons attribution {v} ; creative commons attribution {v} international
cc0-1.0 | cc0 | cc0 1 0 universal ; cc0 1 0 ; cc0 licen[sc]e ; cc0 public domain dedication ; under cc0
cc0-1.0 | creative | creative commons zero(?: v?1 0)? ; creative commons public domain dedication
cc-by-nc-nd | cc | cc by nc nd
cc-by-nc-sa | cc | cc by nc sa
cc-by-nc | cc | cc by nc
cc-by-nd | cc | cc by nd
cc-by-sa | cc | cc by sa
cc-by | cc | (?:licensed|released|available|published|distributed) under (?:a |the )?cc by(?! n[cd]| sa) ; cc by licen[sc]e
cc-by-nc | creative | creative commons attribution non ?commercial licen[sc]e
cc-by-sa | creative | creative commons attribution share ?alike licen[sc]e
cc-by-nd | creative | creative commons attribution no ?derivatives? licen[sc]e
cc-by | creative | creative commons attribution licen[sc]e
cc | creative | creative commons licen[sc]e ; under (?:a )?creative commons
bsd-{v}-clause: 0, 1, 2, 3, 4 | bsd | bsd {v} clause(?: licen[sc]e)? ; {v} clause bsd(?: licen[sc]e)?
bsd-2-clause | bsd | simplified bsd licen[sc]e ; freebsd licen[sc]e ; two clause bsd ; bsd two clause
bsd-3-clause | bsd | (?:new|modified|revised) bsd licen[sc]e ; three clause bsd ; bsd three clause
bsd-4-clause | bsd | original bsd licen[sc]e ; old bsd licen[sc]e ; four clause bsd
bsd-3-clause | endorse or promote | neither the names? of .{1,80}? may be used to endorse or promote products derived from this software
bsd | bsd | bsd style licen[sc]e ; bsd licen[sc]e ; under (?:the )?bsd
mit | mit | licensed under the mit licen[sc]e ; released under the mit licen[sc]e ; distributed under the mit licen[sc]e ; the mit licen[sc]e ; mit expat licen[sc]e ; mit x11 licen[sc]e ; mit style licen[sc]e ; mit licen[sc]e
mit-0 | mit | mit no attribution(?: licen[sc]e)? ; mit 0 licen[sc]e
mit | permission is hereby | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | expat | expat licen[sc]e
x11 | x11 | x11 licen[sc]e
isc | isc | isc licen[sc]e
isc | internet systems | internet systems consortium licen[sc]e
isc | permission to use | permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted
zlib | zlib | zlib libpng licen[sc]e ; zlib licen[sc]e
libpng | libpng | libpng licen[sc]e
bsl-1.0 | boost | boost software licen[sc]e version 1 0 ; boost software licen[sc]e ; boost licen[sc]e
busl-1.1 | business source | business source licen[sc]e 1 1 ; business source licen[sc]e
artistic-{v}: 1.0, 2.0 | artistic | artistic licen[sc]e {v} ; artistic licen[sc]e version {v}
artistic | artistic | perl artistic licen[sc]e ; artistic licen[sc]e
afl-{v}: 1.1, 1.2, 2.0, 2.1, 3.0 | academic free | academic free licen[sc]e (?:version |v ?)?{v}
osl-{v}: 1.0, 2.0, 2.1, 3.0 | open software | open software licen[sc]e (?:version |v ?)?{v}
ofl-{v}: 1.0, 1.1 | open font | sil open font licen[sc]e (?:version )?{v} ; open font licen[sc]e {v}
ofl | open font | sil open font licen[sc]e ; open font licen[sc]e
odbl-1.0 | open database | open database licen[sc]e v?1 0 ; open database licen[sc]e ; open data commons open database
odc-by-1.0 | open data commons | open data commons attribution licen[sc]e
pddl-1.0 | open data commons | open data commons public domain dedication
unlicense | unlicense | the unlicense ; unlicense org ; unlicense licen[sc]e
unlicense | public domain | this is free and unencumbered software released into the public domain
wtfpl | do what the | do what the f\w{3} you want to public licen[sc]e
wtfpl | wtfpl | wtfpl
beerware | beer | beer ?ware licen[sc]e
python-2.0 | python | python software foundation licen[sc]e(?: version 2)?
python-2.0 | psf | psf licen[sc]e
php-{v}: 3.0, 3.01 | php | php licen[sc]e (?:version )?{v}
ruby | ruby | ruby licen[sc]e
postgresql | postgresql | postgresql licen[sc]e
openssl | openssl | openssl licen[sc]e
ncsa | ncsa | university of illinois ncsa open source licen[sc]e ; ncsa licen[sc]e
ms-pl | microsoft | microsoft public licen[sc]e
ms-rl | microsoft | microsoft reciprocal licen[sc]e
upl-1.0 | universal permissive | universal permissive licen[sc]e(?: v?1 0)?
sspl-1.0 | server side public | server side public licen[sc]e(?: v?1)?
elastic-2.0 | elastic | elastic licen[sc]e 2 0 ; elastic licen[sc]e
cecill-{v}: 1.0, 2.0, 2.1 | cecill | cecill (?:licen[sc]e )?(?:version |v ?)?{v}
cecill-b | cecill | cecill b(?: licen[sc]e)?
cecill-c | cecill | cecill c(?: licen[sc]e)?
cpl-1.0 | common public | common public licen[sc]e(?: (?:version |v ?)?1 0)?
ipl-1.0 | ibm public | ibm public licen[sc]e
cpal-1.0 | common public attribution | common public attribution licen[sc]e
hpnd | historical permission | historical permission notice and disclaimer
mulan-{v}: 1, 2 | mulan | mulan permissive software licen[sc]e (?:version |v ?){v} ; mulan psl v?{v}
llama | llama | llama \d?(?: \d)? ?community licen[sc]e
openrail | creativeml | creativeml open ?rail(?: m)?
openrail | openrail | openrail m? ?licen[sc]e ; bigscience openrail
gpl | general public | gnu general public licen[sc]e ; general public licen[sc]e
gpl | gpl | gnu gpl ; under the gpl ; gpl licen[sc]e
lgpl | lesser | gnu lesser general public licen[sc]e
lgpl | lgpl | lgpl
agpl | affero | gnu affero general public licen[sc]e
agpl | agpl | agpl
gfdl | free documentation | gnu free documentation licen[sc]e
apache | apache | apache licen[sc]e ; apache software licen[sc]e
mpl | mozilla | mozilla public licen[sc]e
epl | eclipse | eclipse public licen[sc]e
public-domain | public domain | released (?:in)?to the public domain ; dedicated to the public domain ; in the public domain ; public domain dedication ; this work is public domain
proprietary | all rights reserved | all rights reserved
proprietary | proprietary | proprietary licen[sc]e ; proprietary and confidential
commercial | commercial licen | commercial licen[sc]e
copyleft | copyleft | copyleft licen[sc]e ; copyleft
unspecified | licen | licensed under (?:the )?terms ; see licen[sc]e file ; under the following licen[sc]e ; subject to the terms of (?:the|this) licen[sc]e
"""

#: (phrase, label) of the base scan.
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]

#: Innermost groups, classes, repeated or optional characters, escapes: what a match may lack or vary in.
VARIES = re.compile(r"\(\?[:!][^()]*\)\??|\[[^]]*\]\??|\\?[^\\()](?:\?|\{[\d,]+\}\??)|\\\w")


def mandatory(pattern: str) -> list[str]:
    """Stretches of letters and spaces that every match of a pattern holds."""
    n = 1
    while n:
        pattern, n = VARIES.subn("\0", pattern)
    return [] if "|" in pattern else [x for x in pattern.split("\0") if x]


def rules() -> list[tuple[int, str, str, str]]:
    """(priority, label, keyword, pattern), the highest priority first."""
    out = []
    for line in RULES.strip().splitlines():
        head, keyword, patterns = (x.strip() for x in line.split(" | ", 2))
        label, _, versions = head.partition(": ")
        # the longer version first: 2.1 is not a 2
        for v in sorted((x.strip() for x in versions.split(",")), key=len, reverse=True):
            said = v.replace(".", " ").replace("-", " ")
            out += [(label.replace("{v}", v), keyword, p.strip().replace("{v}", said)) for p in patterns.split(" ; ")]
    return [(len(out) - i, *x) for i, x in enumerate(out)]
