"""Signature rules of the license scan, on texts of lower-case words joined by single spaces.

A rule has a label, a priority, a confidence, a keyword that must occur before its pattern is
tried, and a pattern. Names give rules by templates (title, tag, notice); the bodies of
licenses have patterns of their own.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# label; keyword; pattern of the name; tag words of the machine-readable identifier (or -)
NAMES = """
gpl-1.0; general public; gnu general public licen[cs]e (?:v|version )1(?: 0)?; gpl 1 0(?: only| or later)?
gpl-2.0; general public; gnu general public licen[cs]e (?:v|version )2(?: 0)?; gpl 2 0(?: only| or later)?
gpl-3.0; general public; gnu general public licen[cs]e (?:v|version )3(?: 0)?; gpl 3 0(?: only| or later)?
lgpl-2.0; general public; gnu library general public licen[cs]e(?: (?:v|version )2(?: 0)?)?; lgpl 2 0(?: only| or later)?
lgpl-2.1; general public; gnu lesser general public licen[cs]e (?:v|version )2 1; lgpl 2 1(?: only| or later)?
lgpl-3.0; general public; gnu lesser general public licen[cs]e (?:v|version )3(?: 0)?; lgpl 3 0(?: only| or later)?
lgpl; general public; gnu lesser general public licen[cs]e; lgpl
agpl-3.0; general public; gnu affero general public licen[cs]e(?: (?:v|version )3(?: 0)?)?; agpl 3 0(?: only| or later)?
gfdl; documentation; gnu free documentation licen[cs]e(?: (?:v|version )1 [123])?; gfdl 1 [123](?: only| or later)?
apache-1.1; apache; apache (?:software )?licen[cs]e (?:v|version )?1 1; apache 1 1
apache-2.0; apache; apache (?:software )?licen[cs]e (?:v|version )?2(?: 0)?; apache 2 0
mit; mit; mit licen[cs]e; mit
mit-0; mit; mit no attribution(?: licen[cs]e)?; mit 0
x11; x11; x11 licen[cs]e; x11
bsd-2-clause; bsd; (?:simplified |2 clause |two clause )bsd(?: licen[cs]e)?|bsd (?:2 clause|two clause)(?: licen[cs]e)?; bsd 2 clause
bsd-3-clause; bsd; (?:new |modified |revised |3 clause |three clause )bsd(?: licen[cs]e)?|bsd (?:3 clause|three clause)(?: licen[cs]e)?; bsd 3 clause
bsd-4-clause; bsd; (?:original |4 clause |four clause )bsd(?: licen[cs]e)?|bsd (?:4 clause|four clause)(?: licen[cs]e)?; bsd 4 clause
0bsd; bsd; (?:zero clause |0 clause )bsd(?: licen[cs]e)?|bsd zero clause(?: licen[cs]e)?; 0bsd
bsd; bsd; bsd licen[cs]e; -
isc; isc; isc licen[cs]e; isc
mpl-1.0; mozilla; mozilla public licen[cs]e (?:v|version )?1 0; mpl 1 0
mpl-1.1; mozilla; mozilla public licen[cs]e (?:v|version )?1 1; mpl 1 1
mpl-2.0; mozilla; mozilla public licen[cs]e (?:v|version )?2 0; mpl 2 0
epl-1.0; eclipse; eclipse public licen[cs]e (?:v|version )?1 0; epl 1 0
epl-2.0; eclipse; eclipse public licen[cs]e (?:v|version )?2 0; epl 2 0
edl-1.0; eclipse; eclipse distribution licen[cs]e(?: (?:v|version )?1 0)?; -
cddl-1.0; common development; common development and distribution licen[cs]e(?: (?:v|version )?1 0)?; cddl 1 0
cddl-1.1; common development; common development and distribution licen[cs]e (?:v|version )?1 1; cddl 1 1
cpl-1.0; common public; common public licen[cs]e(?: (?:v|version )?1 0)?; cpl 1 0
cpal-1.0; common public; common public attribution licen[cs]e(?: (?:v|version )?1 0)?; cpal 1 0
eupl-1.1; european union; european union public licen[cs]e (?:v|version )?1 1; eupl 1 1
eupl-1.2; european union; european union public licen[cs]e (?:v|version )?1 2; eupl 1 2
artistic-1.0; artistic; artistic licen[cs]e (?:v|version )?1 0; artistic 1 0
artistic-2.0; artistic; artistic licen[cs]e (?:v|version )?2 0; artistic 2 0
artistic; artistic; artistic licen[cs]e; -
bsl-1.0; boost; boost software licen[cs]e(?: (?:v|version )?1 0)?; bsl 1 0
busl-1.1; business source; business source licen[cs]e(?: (?:v|version )?1 1)?; busl 1 1
sspl-1.0; server side; server side public licen[cs]e(?: (?:v|version )?1)?; sspl 1 0
elastic-2.0; elastic; elastic licen[cs]e(?: (?:v|version )?2(?: 0)?)?; elastic 2 0
zlib; zlib; zlib licen[cs]e; zlib
libpng; libpng; libpng licen[cs]e; libpng(?: 2 0)?
openssl; openssl; openssl licen[cs]e; openssl
python-2.0; python; python software foundation licen[cs]e(?: (?:v|version )?2)?|psf licen[cs]e(?: agreement)?; python 2 0|psf 2 0
php-3.01; php; php licen[cs]e(?: (?:v|version )?3 01)?; php 3 01
ruby; ruby; ruby licen[cs]e; ruby
postgresql; postgresql; postgresql licen[cs]e; postgresql
ncsa; ncsa; (?:university of illinois )?ncsa open source licen[cs]e; ncsa
afl-3.0; academic free; academic free licen[cs]e(?: (?:v|version )?3 0)?; afl 3 0
osl-3.0; open software; open software licen[cs]e(?: (?:v|version )?3 0)?; osl 3 0
ms-pl; microsoft; microsoft public licen[cs]e; ms pl
ms-rl; microsoft; microsoft reciprocal licen[cs]e; ms rl
ofl-1.1; open font; (?:sil )?open font licen[cs]e(?: (?:v|version )?1 1)?; ofl 1 1
upl-1.0; universal permissive; universal permissive licen[cs]e(?: (?:v|version )?1 0)?; upl 1 0
vim; vim; vim licen[cs]e; vim
w3c; w3c; w3c software (?:notice and )?licen[cs]e; w3c
wtfpl; what the fuck; do what the fuck you want to public licen[cs]e; wtfpl
unlicense; unlicense; the unlicense; unlicense
beerware; beer; beer ware licen[cs]e|beerware licen[cs]e; beerware
json; json; json licen[cs]e; json
ecl-2.0; educational community; educational community licen[cs]e(?: (?:v|version )?2 0)?; ecl 2 0
lppl-1.3c; latex; latex project public licen[cs]e(?: (?:v|version )?1 3c)?; lppl 1 3c
odbl-1.0; open database; open (?:data commons open )?database licen[cs]e(?: (?:v|version )?1 0)?; odbl 1 0
odc-by-1.0; open data commons; open data commons attribution licen[cs]e(?: (?:v|version )?1 0)?; odc by 1 0
pddl-1.0; public domain dedication; (?:open data commons )?public domain dedication and licen[cs]e; pddl 1 0
cc0-1.0; cc0; cc0(?: 1 0)?(?: universal)?; cc0 1 0
cc-by-sa; creative commons; creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?; cc by sa [1-4] [05]
cc-by-nc; creative commons; creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?; cc by nc [1-4] [05]
cc-by-nd; creative commons; creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?; cc by nd [1-4] [05]
cc-by-nc-sa; creative commons; creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?; cc by nc sa [1-4] [05]
cc-by-nc-nd; creative commons; creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?; cc by nc nd [1-4] [05]
cc-by; creative commons; creative commons attribution(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?; cc by [1-4] [05]
"""

# label; keyword; sentence from the license's own text or its customary notice
BODIES = """
mit; permission; permission is hereby granted free of charge to any person obtaining a copy of this software
mit; furnished; to permit persons to whom the software is furnished to do so
isc; permission; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
bsd; redistribution; redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause; endorse; neither the names? of .{1,80}? may be used to endorse or promote products
bsd-4-clause; advertising; all advertising materials mentioning features or use of this software must display
gpl; free software; this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e
gpl-2.0; free software; free software foundation either version 2 of the licen[cs]e
gpl-3.0; free software; free software foundation either version 3 of the licen[cs]e
gpl; along with this program; you should have received a copy of the gnu general public licen[cs]e
lgpl; this library; this library is free software you can redistribute it and or modify it under the terms of the gnu lesser
agpl-3.0; affero; under the terms of the gnu affero general public licen[cs]e
apache-2.0; apache; you may not use this file except in compliance with the licen[cs]e.{0,80}? apache org licenses license 2 0
apache-2.0; compliance; you may not use this file except in compliance with the licen[cs]e
mpl-2.0; source code form; this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0
mpl-1.1; mozilla; subject to the mozilla public licen[cs]e version 1 1
epl-2.0; eclipse; this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e
bsl-1.0; boost; distributed under the boost software licen[cs]e
zlib; express or implied; this software is provided as is without any express or implied warranty in no event will the authors be held liable
unlicense; public domain; this is free and unencumbered software released into the public domain
public-domain; public domain; (?:dedicated|released|placed) (?:to|into|in) the public domain
public-domain; public domain; (?:is|are) in the public domain
cc0-1.0; no rights; no rights reserved
cc0-1.0; creativecommons; creativecommons org publicdomain zero
cc-by; creativecommons; creativecommons org licenses by [1-4] [05]
cc-by-sa; creativecommons; creativecommons org licenses by sa [1-4] [05]
cc-by-nc; creativecommons; creativecommons org licenses by nc [1-4] [05]
cc-by-nd; creativecommons; creativecommons org licenses by nd [1-4] [05]
cc-by-nc-sa; creativecommons; creativecommons org licenses by nc sa [1-4] [05]
cc-by-nc-nd; creativecommons; creativecommons org licenses by nc nd [1-4] [05]
ofl-1.1; open font; this font software is licensed under the sil open font licen[cs]e
artistic; artistic; same terms as perl itself
proprietary; all rights; all rights reserved
proprietary; confidential; proprietary and confidential
proprietary; permission; no part of this .{1,60}? may be reproduced
cc-by; cc by; cc by(?: [1-4] [05])?
cc-by-sa; cc by; cc by sa(?: [1-4] [05])?
cc-by-nc; cc by; cc by nc(?: [1-4] [05])?
cc-by-nd; cc by; cc by nd(?: [1-4] [05])?
cc-by-nc-sa; cc by; cc by nc sa(?: [1-4] [05])?
cc-by-nc-nd; cc by; cc by nc nd(?: [1-4] [05])?
gpl; general public; gnu general public licen[cs]e
apache; apache; apache licen[cs]e
"""

# kind; priority; confidence; pattern around a name or a tag
TEMPLATES = (
    ("tag", 5, 0.97, "spdx license identifier (?:{})"),
    ("notice", 4, 0.9, "(?:licen[cs]ed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?(?:{})"),
    ("header", 3, 0.85, "licen[cs]e (?:is )?(?:the )?(?:{})"),
    ("title", 2, 0.7, "(?:{})"),
)


@dataclass(frozen=True)
class Rule:
    label: str
    kind: str
    priority: int
    confidence: float
    keyword: bytes
    pattern: re.Pattern


def _rows(table: str) -> list[list[str]]:
    return [[cell.strip() for cell in line.split(";")] for line in table.strip().splitlines()]


def build_rules() -> list[Rule]:
    """All rules, in the order in which they are tried."""
    out = []

    def add(label: str, kind: str, priority: int, confidence: float, keyword: str, pattern: str) -> None:
        out.append(Rule(label, kind, priority, confidence, keyword.encode(), re.compile(f"(?<= )(?:{pattern})(?= )".encode())))

    for label, keyword, name, tag in _rows(NAMES):
        for kind, priority, confidence, around in TEMPLATES:
            if kind != "tag":
                add(label, kind, priority, confidence, keyword, around.format(name))
            elif tag != "-":
                add(label, kind, priority, confidence, "spdx", around.format(tag))
    for label, keyword, sentence in _rows(BODIES):
        short = len(sentence) < 40
        add(label, "body", 1 if short else 4, 0.5 if short else 0.95, keyword, sentence)
    return sorted(out, key=lambda r: -r.priority)
