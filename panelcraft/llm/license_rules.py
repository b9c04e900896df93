"""Hand-written signature rules for licenses, in order.

A rule is a line: label, priority (smaller is stronger), keywords that a text must all have, and a
regex over the text's words in lower case with one blank between two.  Regexes have no unbounded
repetition, so a detection is at most ``LONGEST`` words.  Priorities: 0 fixed phrases, 1 sentences
of a license's own text or notice, 2 names with version, tags and identifiers, 3 bare names.
"""

from __future__ import annotations

from dataclasses import dataclass

LONGEST = 64


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keywords: tuple[str, ...]
    regex: str


#: fixed values: phrases whose every place counts, and their labels
BASE = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]

SIGNATURES = """
mit          | 1 | hereby granted copy    | permission is hereby granted free of charge to any person obtaining a copy of this software(?: and associated documentation files)?
mit          | 1 | copyright permission copies substantial | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit          | 2 | mit license            | (?:released|licensed|distributed|available|provided|published) under (?:the )?(?:terms of (?:the )?)?mit license
mit          | 2 | spdx mit               | spdx license identifier mit
mit          | 2 | mit license            | the mit license mit
mit          | 2 | expat license          | expat license
mit          | 2 | opensource mit         | opensource org licenses? mit(?: license)?(?: php)?
mit          | 2 | mit license            | license mit
mit          | 3 | mit                    | mit licen[sc]ed?
mit          | 3 | mit style              | mit style license
mit-0        | 2 | mit 0 spdx             | spdx license identifier mit 0
mit-0        | 2 | mit attribution        | mit no attribution(?: license)?
x11          | 2 | x11 license            | x11 license
x11          | 1 | consortium advertising | except as contained in this notice the name of the x consortium shall not be used in advertising
apache-2     | 1 | apache compliance      | licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2     | 1 | unless required applicable basis | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2     | 2 | apache license         | apache (?:software )?license (?:version |v)?2(?: 0)?
apache-2     | 2 | spdx apache            | spdx license identifier apache 2 0
apache-2     | 2 | apache org licenses    | (?:www )?apache org licenses license 2 0(?: txt| html)?
apache-2     | 2 | apache                 | apache 2 0(?: license)?
apache-1.1   | 2 | apache license         | apache (?:software )?license (?:version |v)?1 1
apache-1.1   | 2 | apache spdx            | spdx license identifier apache 1 1
apache-1.0   | 2 | apache license         | apache (?:software )?license (?:version |v)?1 0
apache       | 3 | apache license         | apache (?:software )?license
apache       | 3 | apache licensed        | apache licensed
gpl-2        | 1 | gnu general foundation | gnu general public license as published by the free software foundation either version 2 of the license
gpl-3        | 1 | gnu general foundation | gnu general public license as published by the free software foundation either version 3 of the license
gpl-2        | 2 | general public license | (?:gnu )?general public license (?:version |v)?2(?: 0)?
gpl-3        | 2 | general public license | (?:gnu )?general public license (?:version |v)?3(?: 0)?
gpl-1        | 2 | general public license | (?:gnu )?general public license (?:version |v)?1(?: 0)?
gpl-2        | 2 | spdx gpl               | spdx license identifier gpl 2 0(?: only| or later)?
gpl-3        | 2 | spdx gpl               | spdx license identifier gpl 3 0(?: only| or later)?
gpl-1        | 2 | spdx gpl               | spdx license identifier gpl 1 0(?: only| or later)?
gpl-2        | 2 | gplv2                  | (?:gnu )?gplv2
gpl-3        | 2 | gplv3                  | (?:gnu )?gplv3
gpl-2        | 2 | gpl                    | (?:gnu )?gpl (?:version |v )?2(?: 0)?
gpl-3        | 2 | gpl                    | (?:gnu )?gpl (?:version |v )?3(?: 0)?
gpl-2        | 2 | gpl2                   | gpl2
gpl-3        | 2 | gpl3                   | gpl3
gpl          | 1 | received gnu general   | you should have received a copy of the gnu general public license along with this program
gpl          | 1 | program redistribute gnu | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl          | 3 | general public license | (?:gnu )?general public license
gpl          | 3 | gnu gpl                | gnu gpl
gpl-classpath | 2 | classpath exception   | (?:gnu )?classpath exception
gpl-classpath | 1 | linking library statically | linking this library statically or dynamically with other modules is making a combined work
lgpl-2.1     | 1 | gnu lesser foundation  | gnu lesser general public license as published by the free software foundation either version 2 1 of the license
lgpl-3       | 1 | gnu lesser foundation  | gnu lesser general public license as published by the free software foundation either version 3 of the license
lgpl-2.1     | 2 | lesser general public license | (?:gnu )?lesser general public license (?:version |v)?2 1
lgpl-3       | 2 | lesser general public license | (?:gnu )?lesser general public license (?:version |v)?3(?: 0)?
lgpl-2       | 2 | library general public license | (?:gnu )?library general public license (?:version |v)?2(?: 0)?
lgpl-2.1     | 2 | spdx lgpl              | spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-3       | 2 | spdx lgpl              | spdx license identifier lgpl 3 0(?: only| or later)?
lgpl-2       | 2 | spdx lgpl              | spdx license identifier lgpl 2 0(?: only| or later)?
lgpl-2.1     | 2 | lgpl                   | lgpl (?:version |v )?2 1
lgpl-3       | 2 | lgpl                   | lgpl (?:version |v )?3(?: 0)?
lgpl-3       | 2 | lgplv3                 | lgplv3
lgpl         | 1 | received gnu lesser    | you should have received a copy of the gnu lesser general public license along with this library
lgpl         | 3 | lesser general public license | (?:gnu )?lesser general public license
lgpl         | 3 | library general public license | (?:gnu )?library general public license
lgpl         | 3 | lgpl                   | lgpl
agpl-3       | 1 | gnu affero foundation  | gnu affero general public license as published by the free software foundation either version 3 of the license
agpl-3       | 2 | affero general public license | (?:gnu )?affero general public license (?:version |v)?3(?: 0)?
agpl-3       | 2 | spdx agpl              | spdx license identifier agpl 3 0(?: only| or later)?
agpl-3       | 2 | agplv3                 | agplv3
agpl-3       | 2 | agpl                   | agpl (?:version |v )?3(?: 0)?
agpl-1       | 2 | affero general public license | affero general public license (?:version |v)?1(?: 0)?
agpl         | 3 | affero general public license | (?:gnu )?affero general public license
agpl         | 3 | agpl                   | agpl
gfdl-1.1     | 2 | free documentation license | (?:gnu )?free documentation license (?:version |v)?1 1
gfdl-1.2     | 2 | free documentation license | (?:gnu )?free documentation license (?:version |v)?1 2
gfdl-1.3     | 2 | free documentation license | (?:gnu )?free documentation license (?:version |v)?1 3
gfdl         | 1 | document gnu free documentation | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl         | 3 | free documentation license | (?:gnu )?free documentation license
gfdl         | 3 | gfdl                   | gfdl
bsd-2        | 2 | bsd spdx               | spdx license identifier bsd 2 clause
bsd-3        | 2 | bsd spdx               | spdx license identifier bsd 3 clause
bsd-4        | 2 | bsd spdx               | spdx license identifier bsd 4 clause
bsd-0        | 2 | 0bsd spdx              | spdx license identifier 0bsd
bsd-0        | 2 | 0bsd                   | 0bsd
bsd-2        | 2 | bsd clause             | (?:2|two) clause bsd(?: license)?
bsd-3        | 2 | bsd clause             | (?:3|three) clause bsd(?: license)?
bsd-4        | 2 | bsd clause             | (?:4|four) clause bsd(?: license)?
bsd-2        | 2 | bsd clause             | bsd (?:2|two) clause(?: license)?
bsd-3        | 2 | bsd clause             | bsd (?:3|three) clause(?: license)?
bsd-4        | 2 | bsd clause             | bsd (?:4|four) clause(?: license)?
bsd-2        | 2 | freebsd license        | freebsd license
bsd-2        | 2 | simplified bsd         | simplified bsd license
bsd-3        | 2 | bsd license            | (?:revised|modified) bsd license
bsd-3        | 2 | new bsd license        | new bsd license
bsd-4        | 2 | original bsd           | original bsd license
bsd          | 1 | redistribution binary permitted | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd          | 1 | redistributions retain copyright | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd          | 1 | redistributions binary reproduce | redistributions in binary form must reproduce the above copyright notice
bsd-3        | 1 | neither contributors endorse | neither the name of (?:[^ ]+ ){1,8}nor the names of its contributors may be used to endorse or promote products
bsd-4        | 1 | advertising materials acknowledgement | all advertising materials mentioning features or use of this software must display the following acknowledgement
bsd          | 3 | bsd license            | bsd license
bsd          | 3 | bsd licensed           | bsd licensed
bsd          | 3 | bsd style              | bsd style license
isc          | 1 | permission purpose granted | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc          | 2 | isc spdx               | spdx license identifier isc
isc          | 3 | isc license            | isc license
mpl-1.0      | 2 | mozilla public license | mozilla public license (?:version |v)?1 0
mpl-1.1      | 2 | mozilla public license | mozilla public license (?:version |v)?1 1
mpl-2        | 2 | mozilla public license | mozilla public license (?:version |v)?2(?: 0)?
mpl-1.1      | 2 | mpl spdx               | spdx license identifier mpl 1 1
mpl-2        | 2 | mpl spdx               | spdx license identifier mpl 2 0
mpl-2        | 1 | subject mozilla public | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2        | 2 | mpl                    | mpl (?:version |v )?2(?: 0)?
mpl-1.1      | 2 | mpl                    | mpl (?:version |v )?1 1
mpl          | 3 | mozilla public license | mozilla public license
epl-1        | 2 | eclipse public license | eclipse public license (?:version |v )?1(?: 0)?
epl-2        | 2 | eclipse public license | eclipse public license (?:version |v )?2(?: 0)?
epl-1        | 2 | epl spdx               | spdx license identifier epl 1 0
epl-2        | 2 | epl spdx               | spdx license identifier epl 2 0
epl          | 1 | eclipse accompanying materials | this program and the accompanying materials are made available under the terms of the eclipse public license
epl          | 3 | eclipse public license | eclipse public license
edl-1        | 2 | eclipse distribution license | eclipse distribution license(?: (?:version |v )?1 0)?
cddl-1       | 2 | cddl spdx              | spdx license identifier cddl 1 0
cddl-1.1     | 2 | cddl spdx              | spdx license identifier cddl 1 1
cddl-1       | 2 | common development distribution license | common development and distribution license(?: cddl)? (?:version |v )?1 0
cddl-1.1     | 2 | common development distribution license | common development and distribution license(?: cddl)? (?:version |v )?1 1
cddl         | 3 | common development distribution license | common development and distribution license
cddl         | 3 | cddl                   | cddl
cpl-1        | 2 | common public license  | common public license(?: (?:version |v )?1 0)?
ipl-1        | 2 | ibm public license     | ibm public license(?: (?:version |v )?1 0)?
lpl-1        | 2 | lucent public license  | lucent public license
spl-1        | 2 | sun public license     | sun public license
epl-erlang   | 2 | erlang public license  | erlang public license
qpl-1        | 2 | q public license       | q public license
nokia        | 2 | nokia open license     | nokia open source license
apsl-2       | 2 | apple public license   | apple public source license
intel        | 2 | intel open license     | intel open source license
realnetworks | 2 | realnetworks license   | realnetworks public source license
cc0          | 1 | waiving copyright dedicated | dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law
cc0          | 2 | cc0 spdx               | spdx license identifier cc0 1 0
cc0          | 2 | cc0                    | cc0 1 0(?: universal)?
cc0          | 2 | commons zero           | creative commons zero
cc0          | 3 | cc0                    | cc0
cc-by        | 2 | creative commons attribution | creative commons attribution (?:1 0|2 0|2 5|3 0|4 0)(?: international| unported| generic)?
cc-by        | 2 | creativecommons licenses by | creativecommons org licenses by (?:1 0|2 0|2 5|3 0|4 0)
cc-by        | 2 | cc by                  | cc by (?:1 0|2 0|2 5|3 0|4 0)
cc-by        | 3 | creative commons attribution | creative commons attribution(?: license)?
cc-by        | 3 | cc by                  | cc by(?: license)
cc-by-sa     | 2 | creative commons sharealike | creative commons attribution sharealike(?: (?:1 0|2 0|2 5|3 0|4 0))?(?: international| unported| generic)?(?: license)?
cc-by-sa     | 2 | creative commons share alike | creative commons attribution share alike(?: (?:1 0|2 0|2 5|3 0|4 0))?(?: international| unported| generic)?(?: license)?
cc-by-sa     | 2 | creativecommons licenses sa | creativecommons org licenses by sa (?:1 0|2 0|2 5|3 0|4 0)
cc-by-sa     | 2 | cc by sa               | cc by sa(?: (?:1 0|2 0|2 5|3 0|4 0))?
cc-by-nd     | 2 | creative commons attribution | creative commons attribution no ?derivatives(?: (?:3 0|4 0))?
cc-by-nd     | 2 | creativecommons licenses nd | creativecommons org licenses by nd (?:1 0|2 0|2 5|3 0|4 0)
cc-by-nd     | 2 | cc by nd               | cc by nd(?: (?:1 0|2 0|2 5|3 0|4 0))?
cc-by-nc     | 2 | creative commons attribution | creative commons attribution non ?commercial(?: (?:1 0|2 0|2 5|3 0|4 0))?
cc-by-nc     | 2 | creative commons commercial | creative commons attribution non commercial(?: (?:1 0|2 0|2 5|3 0|4 0))?
cc-by-nc     | 2 | creativecommons licenses nc | creativecommons org licenses by nc (?:1 0|2 0|2 5|3 0|4 0)
cc-by-nc     | 2 | cc by nc               | cc by nc (?:1 0|2 0|2 5|3 0|4 0)
cc-by-nc-sa  | 2 | cc nc sa               | cc by nc sa(?: (?:1 0|2 0|2 5|3 0|4 0))?
cc-by-nc-sa  | 2 | creativecommons nc sa  | creativecommons org licenses by nc sa (?:1 0|2 0|2 5|3 0|4 0)
cc-by-nc-sa  | 2 | creative commons attribution | creative commons attribution non ?commercial share ?alike(?: (?:1 0|2 0|2 5|3 0|4 0))?
cc-by-nc-nd  | 2 | cc nc nd               | cc by nc nd(?: (?:1 0|2 0|2 5|3 0|4 0))?
cc-by-nc-nd  | 2 | creativecommons nc nd  | creativecommons org licenses by nc nd (?:1 0|2 0|2 5|3 0|4 0)
cc-by-nc-nd  | 2 | creative commons attribution | creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: (?:1 0|2 0|2 5|3 0|4 0))?
cc-pd        | 2 | creativecommons publicdomain | creativecommons org publicdomain (?:mark|zero) 1 0
cc           | 3 | creative commons license | creative commons license
public-domain | 1 | public domain        | (?:released|placed|dedicated) (?:in|into|to) the public domain
public-domain | 1 | hereby public domain  | hereby (?:released|placed|dedicated) (?:in|into|to) the public domain
public-domain | 2 | work public domain    | this work is in the public domain
public-domain | 2 | software public domain | this software is in the public domain
unlicense    | 1 | unencumbered public domain | this is free and unencumbered software released into the public domain
unlicense    | 1 | anyone compiled binary | anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary
unlicense    | 2 | unlicense spdx         | spdx license identifier unlicense
unlicense    | 2 | unlicense org          | unlicense org
unlicense    | 3 | unlicense              | the unlicense
wtfpl        | 2 | fuck public license    | do what the fuck you want to public license
wtfpl        | 2 | wtfpl                  | wtfpl
zlib         | 1 | altered misrepresented | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib         | 1 | provided implied warranty authors | this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib         | 2 | zlib spdx              | spdx license identifier zlib
zlib         | 2 | zlib libpng            | zlib libpng license
zlib         | 3 | zlib license           | zlib license
libpng       | 2 | libpng license         | libpng license
boost-1      | 2 | boost license          | boost software license(?: (?:version |v )?1 0)?
boost-1      | 2 | bsl spdx               | spdx license identifier bsl 1 0
boost-1      | 1 | boost software         | distributed under the boost software license version 1 0
artistic-1   | 2 | artistic license       | artistic license (?:version |v )?1(?: 0)?
artistic-2   | 2 | artistic license       | artistic license (?:version |v )?2(?: 0)?
artistic-2   | 2 | artistic spdx          | spdx license identifier artistic 2 0
artistic     | 3 | artistic license       | artistic license
perl         | 1 | same terms perl        | under the same terms as perl itself
python-2     | 2 | python foundation license | python software foundation license(?: (?:version |v )?2)?
python-2     | 2 | psf license            | psf license(?: agreement)?
python-2     | 2 | psf spdx               | spdx license identifier psf 2 0
ruby         | 2 | ruby license           | ruby license
ruby         | 1 | same terms ruby        | under the same terms as ruby itself
php-3        | 2 | php license            | php license(?: (?:version |v )?3 0 ?1?)?
zpl-2        | 2 | zope public license    | zope public license(?: (?:version |v )?2 [01])?
w3c          | 2 | w3c license            | w3c software (?:notice and )?license
postgresql   | 2 | postgresql license     | postgresql license
openssl      | 2 | openssl license        | openssl license
openssl      | 1 | openssl toolkit project | this product includes software developed by the openssl project for use in the openssl toolkit
curl         | 2 | curl license           | curl license
ncsa         | 2 | ncsa open license      | ncsa open source license
ncsa         | 2 | illinois ncsa          | university of illinois ncsa(?: open source license)?
upl-1        | 2 | universal permissive license | universal permissive license(?: (?:version |v )?1 0)?
afl-3        | 2 | academic free license  | academic free license(?: (?:version |v )?3 0)?
osl-3        | 2 | open license           | open software license (?:version |v )?3 0
ecl-2        | 2 | educational community license | educational community license(?: (?:version |v )?2 0)?
eupl-1.1     | 2 | european union public  | european union public licen[cs]e (?:version |v )?1 1
eupl-1.2     | 2 | european union public  | european union public licen[cs]e (?:version |v )?1 2
eupl         | 3 | european union public  | european union public licen[cs]e
eupl         | 3 | eupl                   | eupl
cecill-2     | 2 | cecill license         | cecill (?:free software )?license(?: agreement)?
cecill       | 3 | cecill                 | cecill
mulan-2      | 2 | mulan psl              | mulan psl v ?2
ms-pl        | 2 | microsoft public license | microsoft public license
ms-rl        | 2 | microsoft reciprocal license | microsoft reciprocal license
ofl-1.1      | 2 | sil open font license  | sil open font license(?: (?:version |v )?1 1)?
ofl-1.1      | 2 | ofl spdx               | spdx license identifier ofl 1 1
ofl          | 3 | open font license      | open font license
odbl-1       | 2 | open database license  | (?:open data commons )?open database license(?: odbl)?(?: (?:version |v )?1 0)?
odc-by       | 2 | open commons attribution | open data commons attribution license
pddl-1       | 2 | domain dedication license | (?:open data commons )?public domain dedication and license
odbl-1       | 3 | odbl                   | odbl
ogl-3        | 2 | government licence     | open government licence(?: (?:version |v )?3 0)?
ogl-3        | 2 | government license     | open government license(?: (?:version |v )?3 0)?
cdla         | 2 | community data license agreement | community data license agreement(?: permissive| sharing)?(?: (?:version )?[12] 0)?
sspl-1       | 2 | server side public license | server side public license(?: (?:version |v )?1)?
sspl-1       | 3 | sspl                   | sspl
busl-1.1     | 2 | business source license | business source license(?: (?:version |v )?1 1)?
elastic-2    | 2 | elastic license        | elastic license(?: (?:version |v )?2 0)?
commons-clause | 2 | commons clause       | commons clause(?: license condition)?
openrail     | 2 | openrail               | (?:bigscience |creativeml )?openrail m?(?: license)?
openrail     | 2 | rail license           | (?:bigscience |creativeml )?(?:open )?rail license
llama        | 2 | llama license          | llama (?:2 |3 )?community license(?: agreement)?
proprietary  | 1 | unauthorized copying prohibited | unauthorized copying of this (?:file|work|software|document) via any medium is strictly prohibited
proprietary  | 1 | proprietary confidential | proprietary and confidential
proprietary  | 2 | reproduced permission without | (?:may not|must not) be reproduced (?:[^ ]+ ){0,6}without (?:prior |express |the )?(?:written )?permission
proprietary  | 2 | end user license agreement | end user license agreement
all-rights   | 2 | rights reserved        | all rights reserved
jquery       | 2 | dual licensed mit gpl  | dual licensed under (?:the )?mit (?:and|or) gpl(?: licenses)?
unknown-spdx | 3 | spdx identifier        | spdx license identifier
"""


def _parsed() -> list[Rule]:
    rules = [Rule(label, 0, tuple(phrase.split()), phrase) for label, phrase in BASE]
    for line in SIGNATURES.strip().splitlines():
        label, priority, keywords, regex = (part.strip() for part in line.split("|", 3))
        rules.append(Rule(label, int(priority), tuple(keywords.split()), regex))
    return rules


RULES = _parsed()
