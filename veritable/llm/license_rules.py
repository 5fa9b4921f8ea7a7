"""License signatures written one by one, for wordings that the phrasings by family do not cover.

Each is a label, a regular expression over normalized words (lower case, parted by single spaces, no
punctuation), the keywords of which one must occur, a priority and a weight.
"""

from __future__ import annotations

SIGNATURES = (
    # SPDX identifiers that are no family's name and version
    ("0bsd", "spdx licen[sc]e identifier 0bsd", "0bsd", 5, 0.99),
    ("bsl", "spdx licen[sc]e identifier bsl 1 0", "bsl 1 0", 5, 0.99),
    ("busl", "spdx licen[sc]e identifier busl 1 1", "busl", 5, 0.99),
    ("bsd-2-clause", "spdx licen[sc]e identifier bsd 2 clause(?: patent)?", "bsd 2 clause", 6, 0.99),
    ("bsd-3-clause", "spdx licen[sc]e identifier bsd 3 clause(?: clear| lbnl)?", "bsd 3 clause", 6, 0.99),
    ("gpl", "spdx licen[sc]e identifier gpl [123] 0(?: only| or later)?(?: with [a-z]+ exception(?: [0-9] [0-9])?)?",
     "identifier gpl", 6, 0.99),
    ("lgpl", "spdx licen[sc]e identifier lgpl [23] [01](?: only| or later)?", "identifier lgpl", 6, 0.99),
    ("mit-0", "spdx licen[sc]e identifier mit 0", "mit 0", 6, 0.99),
    ("cc-by-sa", "spdx licen[sc]e identifier cc by sa [1-4] [05]", "cc by sa", 6, 0.99),
    ("cc0", "spdx licen[sc]e identifier cc0 1 0", "cc0 1 0", 6, 0.99),
    ("unlicense", "spdx licen[sc]e identifier unlicense", "identifier unlicense", 6, 0.99),
    ("blueoak", "spdx licen[sc]e identifier blueoak 1 0 0", "blueoak", 6, 0.99),
    ("apache-mit", "spdx licen[sc]e identifier (?:apache 2 0 or mit|mit or apache 2 0)", ("2 0 or mit", "mit or apache"), 7, 0.99),
    ("none", "spdx licen[sc]e identifier none", "identifier none", 5, 0.6),
    # Two licenses to choose from, or both
    ("apache", "(?:licen[sc]ed|available|distributed) under either of (?:the )?apache(?: licen[sc]e)?(?: version)? 2 0", "either of", 5, 0.95),
    ("mit", "apache(?: licen[sc]e)?(?: version)? 2 0(?: licen[sc]e)? or (?:the )?mit(?: licen[sc]e)?", "apache", 4, 0.9),
    ("apache", "mit(?: licen[sc]e)? or (?:the )?apache(?: licen[sc]e)?(?: version)? 2 0", ("or apache", "or the apache"), 4, 0.9),
    ("apache-mit", "dual licen[sc]ed under (?:the )?(?:mit and apache|apache(?: 2 0)? and mit)", ("mit and apache", "and mit"), 6, 0.95),
    ("gpl", "dual licen[sc]ed (?:under )?(?:the )?(?:gnu )?gplv?[23]?(?: 0)? (?:and|or) (?:the )?(?:gnu )?gplv?[23]?(?: 0)?", "dual", 5, 0.95),
    ("gpl", "dual licen[sc]ed (?:under )?(?:the )?(?:gnu )?gplv?[23]?(?: 0)?(?: only)? (?:and|or) (?:a |the )?commercial(?: licen[sc]e)?", "commercial", 5, 0.95),
    ("mpl-gpl", "mpl 1 1 gpl 2 0 lgpl 2 1", "mpl 1 1", 6, 0.97),
    ("gpl", "(?:either|any) version [23] of the licen[sc]e or at your option any later version", "at your option", 4, 0.85),
    ("gpl", "same terms as perl(?: 5)?(?: itself)?", "terms as perl", 4, 0.8),
    # GNU
    ("gpl", "(?:under|by|with|to|of) (?:the )?(?:gnu )?gplv[123](?: or later| only| licen[sc]e)?", "gplv", 4, 0.9),
    ("lgpl", "(?:under|by|with|to|of) (?:the )?(?:gnu )?lgplv[23](?: [01])?(?: or later| only| licen[sc]e)?", "lgplv", 5, 0.9),
    ("agpl", "(?:under|by|with|to|of) (?:the )?(?:gnu )?agplv3(?: or later| only| licen[sc]e)?", "agplv3", 5, 0.9),
    ("gpl", "this program is free software you can redistribute it and or modify it", "free software", 5, 0.95),
    ("gpl", "you should have received a copy of the gnu general public licen[sc]e", "should have received", 5, 0.95),
    ("lgpl", "you should have received a copy of the gnu lesser general public licen[sc]e", "should have received", 6, 0.95),
    ("agpl", "you should have received a copy of the gnu affero general public licen[sc]e", "should have received", 6, 0.95),
    ("gpl", "published by the free software foundation", "free software foundation", 3, 0.7),
    ("gpl", "gnu gpl compatible", "compatible", 2, 0.4),
    ("gpl", "see (?:the )?gnu general public licen[sc]e for more details", "for more details", 4, 0.9),
    ("gpl", "www gnu org licen[sc]es gpl(?: [23] 0)?(?: html| txt)?", "gnu org", 4, 0.9),
    ("lgpl", "www gnu org licen[sc]es (?:old licen[sc]es )?lgpl(?: [23] [01])?(?: html| txt)?", "lgpl", 4, 0.9),
    ("agpl", "www gnu org licen[sc]es agpl(?: 3 0)?(?: html| txt)?", "agpl", 4, 0.9),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e", "modify this document", 6, 0.98),
    ("gfdl", "with no invariant sections no front cover texts and no back cover texts", "invariant sections", 5, 0.9),
    ("gpl", "gcc runtime library exception", "runtime library exception", 4, 0.85),
    ("gpl", "gpl with (?:the )?(?:classpath|linking|font) exception", "exception", 4, 0.9),
    # Apache
    ("apache", "you may not use this file except in compliance with the licen[sc]e", "except in compliance", 5, 0.95),
    ("apache", "you may obtain a copy of the licen[sc]e at(?: http| https)?(?: www)? apache org licen[sc]es licen[sc]e 2 0", "apache org", 6, 0.98),
    ("apache", "distributed on an as is basis without warranties or conditions of any kind", "as is basis", 5, 0.9),
    ("apache", "licen[sc]ed to the apache software foundation asf under one or more contributor licen[sc]e agreements", "contributor", 6, 0.98),
    ("apache", "this product includes software developed (?:at|by) (?:the )?apache software foundation", "product includes", 4, 0.8),
    ("apache", "apache 2(?: 0)? licen[sc]ed", "apache 2", 4, 0.85),
    ("apache", "asl 2 0", "asl 2 0", 3, 0.6),
    # MIT and its kin
    ("mit", "the above copyright notice and this permission notice shall be included in all copies", "permission notice", 5, 0.95),
    ("mit", "the software is provided as is without warranty of any kind express or implied", "express or implied", 4, 0.85),
    ("mit", "mit style licen[sc]e", "mit style", 3, 0.7),
    ("mit", "x11 licen[sc]e", "x11", 3, 0.8),
    ("mit", "opensource org licen[sc]es mit(?: licen[sc]e)?(?: php| html)?", "opensource org", 4, 0.95),
    ("mit-0", "mit no attribution", "no attribution", 4, 0.9),
    ("isc", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted", "with or without fee", 6, 0.97),
    ("0bsd", "bsd zero clause(?: licen[sc]e)?", "zero clause", 4, 0.95),
    ("ntp", "permission to use copy modify and distribute this software and its documentation for any purpose (?:with or )?without fee is hereby granted", "and its documentation", 6, 0.95),
    ("hpnd", "historical permission notice and disclaimer", "historical permission", 4, 0.95),
    ("curl", "curl licen[sc]e", "curl", 3, 0.8),
    ("jpl", "json licen[sc]e", "json", 3, 0.7),
    ("json", "the software shall be used for good not evil", "good not evil", 5, 0.98),
    # BSD
    ("bsd-3-clause", "neither the name of(?: [a-z0-9]+){1,8} nor the names of its contributors may be used", "neither the name", 5, 0.95),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display", "advertising materials", 6, 0.98),
    ("bsd", "redistributions of source code must retain the above copyright notice", "redistributions of source", 5, 0.95),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice", "redistributions in binary", 5, 0.95),
    ("bsd", "use of this source code is governed by a bsd style licen[sc]e", "bsd style", 5, 0.95),
    ("bsd", "bsd style licen[sc]e", "bsd style", 3, 0.8),
    ("bsd", "(?:two|three|four) clause bsd(?: licen[sc]e)?", "clause bsd", 4, 0.9),
    ("bsd", "the regents of the university of california all rights reserved", "regents", 5, 0.9),
    ("bsl", "boost software licen[sc]e version 1 0(?: august 17th 2003)?", "boost software", 5, 0.97),
    ("bsl", "(?:distributed|licen[sc]ed) under (?:the )?bsl 1 0", "bsl 1 0", 5, 0.95),
    ("busl", "business source licen[sc]e(?: 1 1)?", "business source", 4, 0.95),
    # Creative Commons, spelled short and long
    ("cc-by", "creative commons by [1-4] [05]", "creative commons by", 4, 0.9),
    ("cc-by-sa", "creative commons by sa(?: [1-4] [05])?", "creative commons by sa", 5, 0.9),
    ("cc-by-nc", "creative commons by nc(?: [1-4] [05])?", "creative commons by nc", 5, 0.9),
    ("cc-by-nd", "creative commons by nd(?: [1-4] [05])?", "creative commons by nd", 5, 0.9),
    ("cc-by-nc-sa", "creative commons by nc sa(?: [1-4] [05])?", "creative commons by nc sa", 6, 0.9),
    ("cc-by-nc-nd", "creative commons by nc nd(?: [1-4] [05])?", "creative commons by nc nd", 6, 0.9),
    ("cc-by", "creativecommons org licenses by [1-4] [05]", "licenses by", 5, 0.97),
    ("cc-by-sa", "creativecommons org licenses by sa [1-4] [05]", "licenses by sa", 6, 0.97),
    ("cc-by-nc", "creativecommons org licenses by nc [1-4] [05]", "licenses by nc", 6, 0.97),
    ("cc-by-nd", "creativecommons org licenses by nd [1-4] [05]", "licenses by nd", 6, 0.97),
    ("cc-by-nc-sa", "creativecommons org licenses by nc sa [1-4] [05]", "licenses by nc sa", 7, 0.97),
    ("cc-by-nc-nd", "creativecommons org licenses by nc nd [1-4] [05]", "licenses by nc nd", 7, 0.97),
    ("cc0", "creativecommons org publicdomain zero 1 0", "publicdomain zero", 6, 0.98),
    ("cc0", "cc0 1 0 universal", "cc0 1 0", 5, 0.97),
    ("cc0", "waived all copyright and related or neighboring rights", "neighboring rights", 5, 0.95),
    ("public-domain", "public domain mark 1 0", "domain mark", 4, 0.9),
    ("cc-by-sa", "text is available under the creative commons attribution share ?alike licen[sc]e", "text is available", 6, 0.97),
    ("cc-by", "some rights reserved", "some rights", 2, 0.4),
    # Mozilla, Eclipse and other named licenses
    ("mpl", "this source code form is subject to the terms of the mozilla public licen[sc]e v(?: |ersion )?2 0", "source code form", 6, 0.98),
    ("mpl", "mozilla org mpl 2 0", "mozilla org", 5, 0.95),
    ("mpl", "mpl 2(?: 0)?", "mpl 2", 3, 0.7),
    ("epl", "eclipse public licen[sc]e v(?: |ersion )?[12] 0", "eclipse public", 5, 0.95),
    ("epl", "www eclipse org legal epl v(?:10|20|2 0|1 0)", "legal epl", 5, 0.95),
    ("edl", "eclipse distribution licen[sc]e", "eclipse distribution", 4, 0.95),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution licen[sc]e", "contents of this file", 6, 0.98),
    ("cpal", "common public attribution licen[sc]e", "public attribution", 4, 0.95),
    ("eupl", "licen[sc]ed under the eupl(?: version)? 1 [12]", "the eupl", 5, 0.97),
    ("upl", "universal permissive licen[sc]e", "universal permissive", 4, 0.95),
    ("ms-rl", "microsoft reciprocal licen[sc]e", "microsoft reciprocal", 4, 0.95),
    ("ms-pl", "ms pl", "ms pl", 3, 0.7),
    ("afl", "academic free licen[sc]e(?: version)?(?: [1-3] [01])?", "academic free", 4, 0.95),
    ("nasa", "nasa open source agreement", "nasa open", 4, 0.95),
    ("qpl", "q public licen[sc]e", "q public", 4, 0.9),
    ("sleepycat", "sleepycat(?: public)? licen[sc]e", "sleepycat", 4, 0.95),
    ("sspl", "server side public licen[sc]e", "server side public", 4, 0.97),
    ("elastic", "elastic licen[sc]e(?: 2 0)?", "elastic licen", 4, 0.95),
    ("commons-clause", "commons clause licen[sc]e condition", "commons clause", 4, 0.95),
    ("polyform", "polyform (?:noncommercial|small business|shield|strict)(?: licen[sc]e)?", "polyform", 4, 0.95),
    ("ofl", "sil open font licen[sc]e(?: version)? 1 1", "sil open font", 6, 0.98),
    ("ofl", "with reserved font name", "reserved font name", 4, 0.9),
    ("ubuntu-font", "ubuntu font licen[sc]e", "ubuntu font", 4, 0.95),
    ("bitstream", "bitstream vera fonts copyright", "bitstream vera", 4, 0.95),
    ("odc-by", "open data commons attribution licen[sc]e", "open data commons", 4, 0.95),
    ("pddl", "public domain dedication and licen[sc]e", "domain dedication", 4, 0.95),
    ("odbl", "data is available under the open database licen[sc]e", "data is available", 5, 0.97),
    ("cdla", "community data licen[sc]e agreement (?:permissive|sharing)", "community data", 4, 0.95),
    ("ogl-uk", "open government licen[sc]e(?: v3 0| version [123])?", "open government", 4, 0.95),
    ("openrail", "(?:creativeml )?open ?rail(?: m)?(?: licen[sc]e)?", ("open rail", "openrail"), 3, 0.8),
    ("wtfpl", "do what the fuck you want to", "do what the", 4, 0.97),
    ("beerware", "if we meet some day and you think this stuff is worth it you can buy me a beer", "buy me a beer", 5, 0.98),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "held liable", 6, 0.97),
    ("zlib", "the origin of this software must not be misrepresented", "misrepresented", 5, 0.95),
    ("libpng", "png reference library", "png reference", 4, 0.8),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered", 6, 0.99),
    ("unlicense", "unlicense org", "unlicense org", 4, 0.9),
    ("artistic", "artistic licen[sc]e 2 0", "artistic licen", 5, 0.95),
    ("python", "python software foundation licen[sc]e(?: version)? 2", "python software", 5, 0.95),
    ("ruby", "ruby s licen[sc]e", "ruby s", 4, 0.85),
    ("vim", "vim licen[sc]e", "vim licen", 4, 0.9),
    ("tcl", "tcl tk licen[sc]e", "tcl tk", 4, 0.9),
    ("icu", "icu licen[sc]e(?: icu 1 8 1 and later)?", "icu licen", 4, 0.9),
    ("unicode", "unicode inc licen[sc]e agreement", "unicode inc", 4, 0.95),
    ("w3c", "w3c software notice and (?:document )?licen[sc]e", "w3c software", 5, 0.97),
    ("openssl", "this product includes software developed by the openssl project", "openssl project", 5, 0.97),
    ("imagemagick", "imagemagick licen[sc]e", "imagemagick", 4, 0.95),
    ("ijg", "independent jpeg group", "jpeg group", 4, 0.8),
    ("freetype", "freetype (?:project )?licen[sc]e", "freetype", 4, 0.95),
    ("hippocratic", "hippocratic licen[sc]e", "hippocratic", 4, 0.95),
    ("anti-996", "anti 996 licen[sc]e", "anti 996", 4, 0.95),
    ("mulan", "mulan p(?:sl|ermissive software licen[sc]e) ?v[12]", "mulan", 4, 0.95),
    ("cern-ohl", "cern open hardware licen[sc]e", "cern open", 4, 0.95),
    ("solderpad", "solderpad hardware licen[sc]e", "solderpad", 4, 0.95),
    # Rights that are kept
    ("proprietary", "this software is (?:the )?(?:confidential and )?proprietary(?: information)?(?: of| to)", "proprietary", 4, 0.85),
    ("proprietary", "may not be (?:copied|reproduced|redistributed|disclosed)(?: [a-z]+){0,6} without (?:the )?(?:prior )?(?:express )?(?:written )?(?:permission|consent)", "may not be", 4, 0.85),
    ("proprietary", "no part of this (?:publication|work|document|book) may be reproduced", "no part of this", 5, 0.95),
    ("proprietary", "licen[sc]ed not sold", "not sold", 4, 0.8),
    ("proprietary", "end user licen[sc]e agreement", "end user", 4, 0.8),
    ("proprietary", "trade secrets? (?:of|and)", "trade secret", 3, 0.6),
    ("proprietary", "for internal use only", "internal use", 3, 0.6),
    ("proprietary", "for evaluation purposes only", "evaluation purposes", 3, 0.6),
    ("noncommercial", "for (?:personal and )?non ?commercial use only", ("non commercial", "noncommercial"), 4, 0.85),
    ("noncommercial", "(?:may|must) not be used for commercial purposes", "commercial purposes", 4, 0.85),
    ("noncommercial", "for (?:academic|research|educational) (?:and research )?(?:use|purposes) only", "only", 4, 0.8),
    ("no-derivatives", "no derivative works (?:may be|are) (?:made|permitted|allowed)", "no derivative works", 4, 0.85),
    ("no-ai", "may not be used (?:to train|for training)(?: [a-z]+){0,5} (?:models?|systems?)", "may not be used", 4, 0.85),
    ("reserved", "all rights are reserved", "rights are reserved", 3, 0.7),
    ("reserved", "alle rechte vorbehalten", "rechte vorbehalten", 4, 0.9),
    ("reserved", "tous droits réservés", "tous droits", 4, 0.9),
    ("reserved", "todos los derechos reservados", "derechos reservados", 4, 0.9),
    ("reserved", "todos os direitos reservados", "direitos reservados", 4, 0.9),
    ("reserved", "tutti i diritti riservati", "diritti riservati", 4, 0.9),
    ("reserved", "alle rechten voorbehouden", "rechten voorbehouden", 4, 0.9),
    ("reserved", "wszelkie prawa zastrzeżone", "wszelkie prawa", 4, 0.9),
)
