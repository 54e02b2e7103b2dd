"""Licence signatures: one rule a line, ``label | priority | keyword | regex``, in order.

Regexes run on the text's words joined by one blank (letters A-Z in any case),
so punctuation and line breaks never matter.  Priority 3: a licence named in
full or by its identifier; 2: a usual short form; 1: a general notice.  The
keyword must occur in the lower-cased words before the regex is tried.
"""

from __future__ import annotations

RULES_TEXT = r"""
gpl | 2 | general public | general public license
cc-by | 2 | cc by | cc by
reserved | 1 | rights reserved | all rights reserved
agpl-3.0 | 3 | affero | gnu affero general public licen[sc]e(?: v(?:ersion)?)? ?3(?: 0)?
agpl-3.0 | 3 | agpl | agpl(?: v)? ?3(?: 0)?(?: (?:only|or later))?
agpl-1.0 | 3 | affero | affero general public licen[sc]e(?: v(?:ersion)?)? 1(?: 0)?
agpl | 2 | affero | (?:gnu )?affero general public licen[sc]e
agpl | 2 | agpl | agpl
lgpl-2.0 | 3 | general public | gnu library general public licen[sc]e(?: v(?:ersion)?)? 2(?: 0)?
lgpl-2.1 | 3 | general public | gnu lesser general public licen[sc]e(?: v(?:ersion)?)? 2 1
lgpl-3.0 | 3 | general public | gnu lesser general public licen[sc]e(?: v(?:ersion)?)? 3(?: 0)?
lgpl-2.1 | 3 | lgpl | lgpl(?: v)? ?2 1(?: (?:only|or later))?
lgpl-3.0 | 3 | lgpl | lgpl(?: v)? ?3(?: 0)?(?: (?:only|or later))?
lgpl-2.0 | 3 | lgpl | lgpl(?: v)? ?2 0(?: (?:only|or later))?
lgpl | 2 | general public | (?:gnu )?(?:lesser|library) general public licen[sc]e
lgpl | 2 | lgpl | lgpl
gpl-1.0 | 3 | general public | gnu general public licen[sc]e(?: v(?:ersion)?)? 1(?: 0)?
gpl-2.0 | 3 | general public | gnu general public licen[sc]e(?: as published by the free software foundation)?(?: either)?(?: v(?:ersion)?)? 2(?: 0)?
gpl-3.0 | 3 | general public | gnu general public licen[sc]e(?: as published by the free software foundation)?(?: either)?(?: v(?:ersion)?)? 3(?: 0)?
gpl-2.0 | 3 | gpl | (?:gnu )?gpl(?: v)? ?2(?: 0)?(?: (?:only|or later))?
gpl-3.0 | 3 | gpl | (?:gnu )?gpl(?: v)? ?3(?: 0)?(?: (?:only|or later))?
gpl-2.0 | 3 | gplv | gplv2
gpl-3.0 | 3 | gplv | gplv3
gpl-classpath | 3 | classpath | classpath exception(?: 2 0)?
gpl-font | 3 | font exception | (?:gpl )?font exception(?: 2 0)?
gpl | 2 | general public | gnu general public licen[sc]e
gpl | 2 | gnu gpl | gnu gpl
gpl-warranty | 1 | without even the implied | without even the implied warranty of merchantability or fitness for a particular purpose
gpl-redistribute | 1 | redistribute it | you can redistribute it and or modify it under the terms of
gfdl-1.1 | 3 | free documentation | gnu free documentation licen[sc]e(?: v(?:ersion)?)? 1 1
gfdl-1.2 | 3 | free documentation | gnu free documentation licen[sc]e(?: v(?:ersion)?)? 1 2
gfdl-1.3 | 3 | free documentation | gnu free documentation licen[sc]e(?: v(?:ersion)?)? 1 3
gfdl | 2 | free documentation | (?:gnu )?free documentation licen[sc]e
gfdl | 2 | gfdl | gfdl
apache-1.0 | 3 | apache | apache (?:software )?licen[sc]e(?: v(?:ersion)?)? 1 0
apache-1.1 | 3 | apache | apache (?:software )?licen[sc]e(?: v(?:ersion)?)? 1 1
apache-2.0 | 3 | apache | apache (?:software )?licen[sc]e(?: v(?:ersion)?)? 2(?: 0)?
apache-2.0 | 3 | apache | apache 2(?: 0)?
apache-2.0 | 3 | apache org | (?:www )?apache org licenses license 2 0(?: txt| html)?
apache | 2 | apache | (?:the )?apache (?:software )?licen[sc]e
mit | 3 | permission is hereby | permission is hereby granted free of charge to any person obtaining a copy of this software
mit-0 | 3 | mit | mit (?:no attribution|0)(?: licen[sc]e)?
mit | 2 | mit licen | (?:the )?mit licen[sc]e
mit | 2 | license mit | license mit
mit | 2 | licence mit | licence mit
mit | 2 | expat | expat licen[sc]e
x11 | 2 | x11 | x11 licen[sc]e
x-consortium | 2 | x consortium | x consortium licen[sc]e
bsd-4-clause | 3 | advertising materials | all advertising materials mentioning features or use of this software
bsd-3-clause | 3 | endorse or promote | may be used to endorse or promote products derived from this software without specific prior written permission
bsd-2-clause | 3 | source code must retain | redistributions of source code must retain the above copyright notice
bsd-binary | 3 | binary form must reproduce | redistributions in binary form must reproduce the above copyright notice
bsd-0-clause | 3 | bsd | (?:0bsd|bsd zero clause|zero clause bsd)(?: licen[sc]e)?
bsd-1-clause | 3 | bsd | bsd 1 clause(?: licen[sc]e)?
bsd-2-clause | 3 | bsd | (?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: licen[sc]e)?
bsd-3-clause | 3 | bsd | (?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: licen[sc]e)?
bsd-4-clause | 3 | bsd | (?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[sc]e)?
bsd-3-clause-clear | 3 | bsd | (?:bsd 3 clause clear|clear bsd)(?: licen[sc]e)?
bsd-patent | 3 | bsd | bsd 2 clause patent(?: licen[sc]e)?
bsd | 2 | bsd | bsd (?:style )?licen[sc]e
isc | 3 | isc | isc licen[sc]e
isc | 3 | permission to use copy | permission to use copy modify and or distribute this software for any purpose with or without fee
hpnd | 3 | permission to use copy | permission to use copy modify and distribute this software and its documentation for any purpose
ntp | 2 | ntp licen | ntp licen[sc]e
mpl-1.0 | 3 | mozilla | mozilla public licen[sc]e(?: v(?:ersion)?)? 1 0
mpl-1.1 | 3 | mozilla | mozilla public licen[sc]e(?: v(?:ersion)?)? 1 1
mpl-2.0 | 3 | mozilla | mozilla public licen[sc]e(?: v(?:ersion)?)? 2(?: 0)?
mpl-2.0 | 3 | mpl | mpl(?: v)? ?2(?: 0)?
mpl-1.1 | 3 | mpl | mpl(?: v)? ?1 1
mpl | 2 | mozilla | mozilla public licen[sc]e
epl-1.0 | 3 | eclipse | eclipse public licen[sc]e(?: v(?:ersion)?)? 1(?: 0)?
epl-2.0 | 3 | eclipse | eclipse public licen[sc]e(?: v(?:ersion)?)? 2(?: 0)?
epl | 2 | eclipse | eclipse public licen[sc]e
edl-1.0 | 3 | eclipse | eclipse distribution licen[sc]e(?: v(?:ersion)?)? 1(?: 0)?
cddl-1.0 | 3 | common development | common development and distribution licen[sc]e(?: cddl)?(?: v(?:ersion)?)? 1 0
cddl-1.1 | 3 | common development | common development and distribution licen[sc]e(?: cddl)?(?: v(?:ersion)?)? 1 1
cddl | 2 | common development | common development and distribution licen[sc]e
cddl | 2 | cddl | cddl
cpl-1.0 | 3 | common public | common public licen[sc]e(?: v(?:ersion)?)? 1 0
cpl | 2 | common public | common public licen[sc]e
cpal-1.0 | 3 | common public attribution | common public attribution licen[sc]e(?: v(?:ersion)?)?(?: 1 0)?
ipl-1.0 | 3 | ibm public | ibm public licen[sc]e(?: v(?:ersion)?)?(?: 1 0)?
spl-1.0 | 3 | sun public | sun public licen[sc]e(?: v(?:ersion)?)?(?: 1 0)?
npl-1.1 | 3 | netscape public | netscape public licen[sc]e(?: v(?:ersion)?)?(?: 1 [01])?
apsl-2.0 | 3 | apple public | apple public source licen[sc]e(?: v(?:ersion)?)?(?: 2 0)?
eupl-1.1 | 3 | european union public | european union public licen[sc]e(?: v(?:ersion)?)? 1 1
eupl-1.2 | 3 | european union public | european union public licen[sc]e(?: v(?:ersion)?)? 1 2
eupl | 2 | european union public | european union public licen[sc]e
eupl | 2 | eupl | eupl(?: v?1 [012])?
cecill-2.1 | 3 | cecill | cecill(?: v(?:ersion)?)? 2 1
cecill-b | 3 | cecill | cecill b
cecill-c | 3 | cecill | cecill c
cecill | 2 | cecill | cecill
osl-3.0 | 3 | open software | open software licen[sc]e(?: v(?:ersion)?)?(?: 3 0)?
afl-3.0 | 3 | academic free | academic free licen[sc]e(?: v(?:ersion)?)?(?: [123] [012])?
artistic-1.0 | 3 | artistic | artistic licen[sc]e(?: v(?:ersion)?)? 1 0
artistic-2.0 | 3 | artistic | artistic licen[sc]e(?: v(?:ersion)?)? 2 0
artistic | 2 | artistic | artistic licen[sc]e
perl | 2 | same terms as perl | (?:under the )?same terms as perl itself
python-2.0 | 3 | python | python (?:software foundation )?licen[sc]e(?: v(?:ersion)?)? 2(?: 0)?
psf | 2 | python software foundation | python software foundation licen[sc]e
cnri-python | 3 | cnri | cnri (?:open source )?(?:licen[sc]e agreement|python)
php-3.01 | 3 | php licen | php licen[sc]e(?: v(?:ersion)?)?(?: 3 01?)?
ruby | 2 | ruby | ruby(?: s)? licen[sc]e
lua | 2 | lua licen | lua licen[sc]e
tcl | 2 | tcl | tcl tk licen[sc]e
zlib | 3 | zlib | zlib(?: libpng)? licen[sc]e
zlib | 3 | altered source versions | altered source versions must be plainly marked as such
libpng | 3 | libpng | libpng licen[sc]e(?: v(?:ersion)?)?(?: 2)?
bsl-1.0 | 3 | boost | boost software licen[sc]e(?: v(?:ersion)?)?(?: 1 0)?
bsl-1.1 | 3 | business source | business source licen[sc]e(?: v(?:ersion)?)?(?: 1 1)?
sspl-1.0 | 3 | server side public | server side public licen[sc]e(?: v(?:ersion)?)?(?: 1)?
elastic-2.0 | 3 | elastic licen | elastic licen[sc]e(?: v(?:ersion)?)?(?: 2 0)?
commons-clause | 3 | commons clause | commons clause(?: licen[sc]e)?(?: condition)?(?: v(?:ersion)?)?(?: 1 0)?
polyform-nc | 3 | polyform | polyform noncommercial licen[sc]e(?: 1 0 0)?
polyform | 2 | polyform | polyform (?:small business|shield|perimeter|strict|internal use) licen[sc]e(?: 1 0 0)?
ms-pl | 3 | microsoft | microsoft public licen[sc]e(?: ms pl)?
ms-rl | 3 | microsoft | microsoft reciprocal licen[sc]e(?: ms rl)?
ncsa | 3 | ncsa | (?:university of illinois )?ncsa open source licen[sc]e
upl-1.0 | 3 | universal permissive | universal permissive licen[sc]e(?: v(?:ersion)?)?(?: 1 0)?
unicode | 3 | unicode | unicode (?:data files and software )?licen[sc]e(?: v(?:ersion)?)?(?: 3)?
icu | 2 | icu licen | icu licen[sc]e
w3c | 3 | w3c | w3c software (?:notice and )?licen[sc]e
curl | 2 | curl licen | curl licen[sc]e
openssl | 3 | openssl | openssl licen[sc]e
ssleay | 3 | ssleay | (?:original )?ssleay licen[sc]e
sleepycat | 3 | sleepycat | sleepycat (?:public )?licen[sc]e
postgresql | 3 | postgresql | postgresql licen[sc]e
sqlite-blessing | 3 | may you do good | may you do good and not evil
json | 3 | shall be used for good | the software shall be used for good not evil
vim | 2 | vim licen | vim licen[sc]e
wtfpl | 3 | wtfpl | wtfpl(?: v(?:ersion)?)?(?: 2)?
wtfpl | 3 | do what the | do what the f\S* you want to(?: public licen[sc]e)?
unlicense | 3 | unlicense | (?:the )?unlicense
unlicense | 3 | unencumbered software | free and unencumbered software released into the public domain
public-domain | 2 | public domain | (?:released|placed|dedicated|is) (?:in|into|to) the public domain
public-domain | 1 | public domain | public domain
ofl-1.1 | 3 | open font | (?:sil )?open font licen[sc]e(?: v(?:ersion)?)? 1 1
ofl | 2 | open font | (?:sil )?open font licen[sc]e
ofl | 2 | ofl 1 | ofl 1 1
bitstream-vera | 3 | bitstream vera | bitstream vera fonts? (?:copyright|licen[sc]e)
ubuntu-font | 3 | ubuntu font | ubuntu font licen[sc]e(?: v(?:ersion)?)?(?: 1 0)?
lppl-1.3 | 3 | latex project | latex project public licen[sc]e(?: v(?:ersion)?)?(?: 1 3[abc]?)?
ftl | 3 | freetype | freetype (?:project )?licen[sc]e
ijg | 3 | independent jpeg | independent jpeg group(?: s)?(?: software| licen[sc]e)?
libtiff | 2 | libtiff | libtiff licen[sc]e
imagemagick | 3 | imagemagick | imagemagick licen[sc]e
qpl-1.0 | 3 | q public | q public licen[sc]e(?: v(?:ersion)?)?(?: 1 0)?
ecl-2.0 | 3 | educational community | educational community licen[sc]e(?: v(?:ersion)?)?(?: 2 0)?
efl | 3 | eiffel forum | eiffel forum licen[sc]e(?: v(?:ersion)?)?(?: [12](?: 0)?)?
entessa | 2 | entessa | entessa public licen[sc]e
fair | 2 | fair licen | fair licen[sc]e
mulan-psl-2.0 | 3 | mulan | mulan psl v2|mulan permissive software licen[sc]e(?: v(?:ersion)?)? 2
odc-by-1.0 | 3 | open data commons | open data commons attribution licen[sc]e(?: v?1 0)?
odbl-1.0 | 3 | open database | open (?:data commons open )?database licen[sc]e(?: v?1 0)?
odbl | 2 | odbl | odbl(?: v?1 0)?
pddl-1.0 | 3 | public domain dedication and | public domain dedication and licen[sc]e(?: v?1 0)?
cdla-permissive | 3 | community data | community data licen[sc]e agreement permissive(?: v(?:ersion)?)?(?: [12] 0)?
cdla-sharing | 3 | community data | community data licen[sc]e agreement sharing(?: v(?:ersion)?)?(?: 1 0)?
ogl-uk | 3 | open government | open government licen[sc]e(?: v(?:ersion)?)?(?: [123] 0)?
etalab-2.0 | 3 | licence ouverte | (?:etalab )?licence ouverte(?: etalab)?(?: 2 0)?
etalab-2.0 | 3 | etalab | etalab 2 0
openrail-m | 3 | rail | (?:creativeml |bigscience )?open ?rail(?: ?m)?(?: licen[sc]e)?
cc0-1.0 | 3 | cc0 | cc0(?: 1 0)?(?: universal)?
cc0-1.0 | 3 | creative commons | creative commons zero(?: v?1 0)?(?: universal)?
cc-pdm | 3 | public domain mark | public domain mark(?: 1 0)?
cc-by-nc-nd | 3 | cc by | cc by nc nd(?: [1234] [05])?
cc-by-nc-sa | 3 | cc by | cc by nc sa(?: [1234] [05])?
cc-by-nc | 3 | cc by | cc by nc(?: [1234] [05])?
cc-by-nd | 3 | cc by | cc by nd(?: [1234] [05])?
cc-by-sa | 3 | cc by | cc by sa(?: [1234] [05])?
cc-by-1.0 | 3 | cc by | cc by 1 0
cc-by-2.0 | 3 | cc by | cc by 2 0
cc-by-2.5 | 3 | cc by | cc by 2 5
cc-by-3.0 | 3 | cc by | cc by 3 0
cc-by-4.0 | 3 | cc by | cc by 4 0
cc-by-nc-nd | 3 | creative commons | creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: works)?(?: [1234] [05])?(?: international| unported)?
cc-by-nc-sa | 3 | creative commons | creative commons attribution non ?commercial share ?alike(?: [1234] [05])?(?: international| unported)?
cc-by-nc | 3 | creative commons | creative commons attribution non ?commercial(?: [1234] [05])?(?: international| unported)?
cc-by-nd | 3 | creative commons | creative commons attribution no ?deriv(?:ative)?s(?: works)?(?: [1234] [05])?(?: international| unported)?
cc-by-sa | 3 | creative commons | creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported)?
cc-by | 3 | creative commons | creative commons attribution(?: [1234] [05])?(?: international| unported| generic)?
cc-url | 3 | creativecommons org | creativecommons org licenses by(?: nc| nd| sa)*(?: [1234] [05])?
cc0-url | 3 | creativecommons org | creativecommons org publicdomain zero(?: 1 0)?
cc | 1 | creative commons | creative commons(?: licen[sc]e)?
cc | 1 | some rights reserved | some rights reserved
copyleft | 1 | copyleft | copyleft
copyright | 1 | copyright | copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?
copyright | 1 | copyright | (?:is )?(?:protected by|subject to) copyright(?: law)?
proprietary | 2 | proprietary | (?:confidential and proprietary|proprietary and confidential|proprietary licen[sc]e)
eula | 2 | end user licen | end user licen[sc]e agreement
eula | 2 | eula | eula
non-commercial | 1 | commercial | (?:for )?(?:non ?commercial|personal and non ?commercial) use only
research-only | 1 | research | for research (?:purposes|use) only
no-redistribution | 1 | redistribut | (?:may not be|no|not be) (?:copied or )?redistribut(?:ed|ion)
no-warranty | 1 | without warranty | (?:provided )?as is(?: and)? without warranty of any kind
licensed-under | 1 | licensed under | licensed under(?: the)?
spdx | 2 | spdx | spdx licen[sc]e identifier
"""


def rules() -> list[dict]:
    """The rules in order; ``keyword`` and the regex both see words joined by one blank."""
    out = []
    for n, line in enumerate(x for x in RULES_TEXT.strip().split("\n")):
        label, priority, keyword, regex = line.split(" | ", 3)
        out.append({"label": label, "priority": int(priority), "keyword": keyword, "n": n,
                    "regex": f"(?i)(?<= )(?:{regex})(?= )"})
    return out
