"""License signatures.  A rule is a label, keywords of which one must begin a word of the text before its pattern is tried, a priority and a
pattern over the text's words, which are lower case and one blank apart ("version 2.0" reads "version 2 0").

Each family is written by hand: its label, its keyword, the words that name it, and the short name used in tags.  Every
name is tried in a few ordered contexts, the most telling first; phrases of license bodies and links are rules of their own."""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    keywords: list[str]
    priority: int
    weight: float
    pattern: str
    needs: str = ""  # a word of every match begins like this


# Label, keyword, pattern of the name, pattern of the short tag ("" if none).
FAMILIES = [
    ("mit", "mit", r"(?:the )?mit", r"mit"),
    ("mit-0", "mit", r"mit (?:no attribution|0)", r"mit 0"),
    ("x11", "x11", r"(?:mit )?x11", r"x11"),
    ("isc", "isc", r"isc", r"isc"),
    ("bsd-2-clause", "bsd", r"(?:(?:the )?(?:simplified|freebsd) bsd|(?:the )?bsd (?:2|two) clause|(?:2|two) clause bsd)", r"bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:(?:the )?(?:new|modified|revised) bsd|(?:the )?bsd (?:3|three) clause|(?:3|three) clause bsd)", r"bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:(?:the )?original bsd|(?:the )?bsd (?:4|four) clause|(?:4|four) clause bsd)", r"bsd 4 clause"),
    ("bsd-0-clause", "bsd|0bsd|zero clause", r"(?:zero clause bsd|bsd zero clause|0bsd)", r"0bsd"),
    ("bsd", "bsd", r"(?:the )?bsd(?: style)?", r"bsd"),
    ("apache-1.0", "apache", r"(?:the )?apache (?:software )?licen[cs]e (?:version |v )?1 0", r"apache 1 0"),
    ("apache-1.1", "apache", r"(?:the )?apache (?:software )?licen[cs]e (?:version |v )?1 1", r"apache 1 1"),
    ("apache-2.0", "apache", r"(?:the )?apache (?:software )?(?:licen[cs]e )?(?:version |v )?(?:2 0|2|v2|v2 0)", r"apache 2 0"),
    ("apache", "apache", r"(?:the )?apache(?: software)?", r"apache"),
    ("gpl-1.0", "general public|gpl", r"(?:gnu )?(?:general public licen[cs]e|gpl) (?:version |v )?(?:1|v1)(?: 0)?", r"gpl 1 0(?: only| or later)?"),
    ("gpl-2.0", "general public|gpl", r"(?:gnu )?(?:general public licen[cs]e|gpl) (?:version |v )?(?:2|v2)(?: 0)?", r"gpl 2 0(?: only| or later)?"),
    ("gpl-3.0", "general public|gpl", r"(?:gnu )?(?:general public licen[cs]e|gpl) (?:version |v )?(?:3|v3)(?: 0)?", r"gpl 3 0(?: only| or later)?"),
    ("gpl", "general public|gpl", r"(?:the )?(?:gnu )?(?:general public|gpl)", r"gpl"),
    ("lgpl-2.0", "general public|lgpl", r"(?:gnu )?(?:library general public licen[cs]e|lgpl) (?:version |v )?(?:2|v2)(?: 0)?", r"lgpl 2 0(?: only| or later)?"),
    ("lgpl-2.1", "general public|lgpl", r"(?:gnu )?(?:lesser general public licen[cs]e|lgpl) (?:version |v )?(?:2|v2) 1", r"lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", "general public|lgpl", r"(?:gnu )?(?:lesser general public licen[cs]e|lgpl) (?:version |v )?(?:3|v3)(?: 0)?", r"lgpl 3 0(?: only| or later)?"),
    ("lgpl", "general public|lgpl", r"(?:the )?(?:gnu )?(?:(?:lesser|library) general public|lgpl)", r"lgpl"),
    ("agpl-3.0", "affero|agpl", r"(?:gnu )?(?:affero general public licen[cs]e|agpl) (?:version |v )?(?:3|v3)(?: 0)?", r"agpl 3 0(?: only| or later)?"),
    ("agpl", "affero|agpl", r"(?:the )?(?:gnu )?(?:affero general public|agpl)", r"agpl"),
    ("gfdl", "free documentation", r"(?:the )?(?:gnu )?free documentation", r"gfdl 1 [0-9]"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e (?:version |v )?1 1", r"mpl 1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[cs]e (?:version |v )?2(?: 0)?", r"mpl 2 0"),
    ("mpl", "mozilla", r"(?:the )?mozilla public", r"mpl"),
    ("epl-1.0", "eclipse", r"eclipse public licen[cs]e (?:version |v )?1 0", r"epl 1 0"),
    ("epl-2.0", "eclipse", r"eclipse public licen[cs]e (?:version |v )?2(?: 0)?", r"epl 2 0"),
    ("epl", "eclipse", r"(?:the )?eclipse (?:public|distribution)", r"epl"),
    ("cddl", "common development", r"(?:the )?common development and distribution", r"cddl 1 [01]"),
    ("cpl", "common public", r"(?:the )?common public", r"cpl 1 0"),
    ("ipl", "ibm", r"(?:the )?ibm public", r"ipl 1 0"),
    ("artistic", "artistic", r"(?:the )?(?:perl )?artistic", r"artistic [12] 0"),
    ("boost", "boost", r"(?:the )?boost software", r"bsl 1 0"),
    ("zlib", "zlib", r"(?:the )?zlib(?: libpng)?", r"zlib"),
    ("libpng", "libpng|png reference", r"(?:the )?(?:png reference library|libpng)", r"libpng(?: 2 0)?"),
    ("openssl", "openssl", r"(?:the )?(?:dual )?openssl", r"openssl"),
    ("curl", "curl", r"(?:the )?curl", r"curl"),
    ("php", "php", r"(?:the )?php", r"php 3 0?1?"),
    ("python", "python", r"(?:the )?python(?: software foundation)?", r"(?:psf|python) 2 0"),
    ("ruby", "ruby", r"(?:the )?ruby", r"ruby"),
    ("postgresql", "postgresql", r"(?:the )?postgresql", r"postgresql"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", r"unlicense"),
    ("wtfpl", "wtf|do what the", r"(?:the )?(?:do what the f[a-z]+ you want to public|wtfpl)", r"wtfpl"),
    ("cc0-1.0", "cc0", r"(?:the )?(?:creative commons )?cc0(?: 1 0)?(?: universal)?", r"cc0 1 0"),
    ("cc-by-4.0", "creative commons", r"creative commons attribution (?:4 0 )?(?:international )?", r"cc by 4 0"),
    ("cc-by-sa", "creative commons", r"creative commons attribution share ?alike(?: [234] 0)?(?: international| unported)?", r"cc by sa [1234] 0"),
    ("cc-by-nc", "creative commons", r"creative commons attribution non ?commercial(?: [234] 0)?(?: international| unported)?", r"cc by nc [1234] 0"),
    ("cc-by-nd", "creative commons", r"creative commons attribution no ?derivatives(?: [234] 0)?(?: international| unported)?", r"cc by nd [1234] 0"),
    ("cc-by-nc-sa", "creative commons", r"creative commons attribution non ?commercial share ?alike(?: [234] 0)?(?: international| unported)?", r"cc by nc sa [1234] 0"),
    ("cc-by-nc-nd", "creative commons", r"creative commons attribution non ?commercial no ?derivatives(?: [234] 0)?(?: international| unported)?", r"cc by nc nd [1234] 0"),
    ("creative-commons", "creative commons", r"(?:a |the )?creative commons", r"cc by"),
    ("odbl", "open data", r"(?:the )?open (?:data commons )?(?:open )?database", r"odbl 1 0"),
    ("ofl", "open font", r"(?:the )?(?:sil )?open font", r"ofl 1 [01]"),
    ("eupl", "european union", r"(?:the )?european union public", r"eupl 1 [012]"),
    ("afl", "academic free", r"(?:the )?academic free", r"afl [123] [012]"),
    ("osl", "open software", r"(?:the )?open software", r"osl [123] [01]"),
    ("ms-pl", "microsoft public", r"(?:the )?microsoft public", r"ms pl"),
    ("ms-rl", "microsoft reciprocal", r"(?:the )?microsoft reciprocal", r"ms rl"),
    ("upl", "universal permissive", r"(?:the )?universal permissive", r"upl 1 0"),
    ("blueoak", "blue oak", r"(?:the )?blue oak model", r"blueoak 1 0 0"),
    ("vim", "vim", r"(?:the )?vim", r"vim"),
    ("tcl", "tcl", r"(?:the )?tcl tk", r"tcl"),
    ("latex", "latex project", r"(?:the )?latex project public", r"lppl 1 [0-3][ac]?"),
    ("ncsa", "ncsa", r"(?:the )?(?:university of illinois )?ncsa(?: open source)?", r"ncsa"),
    ("sleepycat", "sleepycat", r"(?:the )?sleepycat", r"sleepycat"),
    ("bsl-1.1", "business source", r"(?:the )?business source", r"busl 1 1"),
    ("sspl", "server side public", r"(?:the )?server side public", r"sspl 1 0"),
    ("elastic-2.0", "elastic", r"(?:the )?elastic", r"elastic 2 0"),
    ("openrail", "rail|openrail", r"(?:the )?(?:bigscience |creativeml )?open ?rail(?: m)?", r"openrail"),
]

# Phrases of license bodies, and of links.
BODIES = [
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to use", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", r"redistributions? and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse or promote", r"(?:neither the name|the names?) of [^ ]+(?: [^ ]+){0,20} endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", "you may not use this file", r"you may not use this file except in compliance with the licen[cs]e"),
    ("apache-2.0", "apache org", r"apache org licenses license 2 0"),
    ("gpl", "free software foundation", r"under the terms of the gnu general public licen[cs]e as published by the free software foundation"),
    ("lgpl", "free software foundation", r"under the terms of the gnu (?:lesser|library) general public licen[cs]e as published by the free software foundation"),
    ("agpl", "free software foundation", r"under the terms of the gnu affero general public licen[cs]e as published by the free software foundation"),
    ("gpl", "gnu org", r"gnu org (?:licenses|copyleft) gpl(?: html| txt)?"),
    ("lgpl", "gnu org", r"gnu org (?:licenses|copyleft) lgpl(?: html| txt)?"),
    ("mpl-2.0", "mozilla org", r"mozilla org mpl 2 0"),
    ("mpl", "mozilla public", r"subject to the terms of the mozilla public licen[cs]e"),
    ("cc0-1.0", "creativecommons org", r"creativecommons org publicdomain zero 1 0"),
    ("cc-by-4.0", "creativecommons org", r"creativecommons org licenses by 4 0"),
    ("cc-by-sa", "creativecommons org", r"creativecommons org licenses by sa [1234] [05]"),
    ("cc-by-nc", "creativecommons org", r"creativecommons org licenses by nc [1234] [05]"),
    ("cc-by-nd", "creativecommons org", r"creativecommons org licenses by nd [1234] [05]"),
    ("unlicense", "public domain", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", "public domain", r"(?:is|are) (?:hereby )?in the public domain"),
    ("boost", "boost org", r"boost org license 1 0"),
    ("zlib", "as is", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("wtfpl", "what the", r"you just do what the f[a-z]+ you want to"),
    ("artistic", "perl itself", r"same terms as perl itself"),
    ("proprietary", "all rights reserved", r"all rights reserved"),
    ("proprietary", "confidential", r"(?:proprietary and confidential|confidential and proprietary)"),
    ("no-derivatives", "may not be", r"may not be (?:copied|reproduced|redistributed) without (?:the )?(?:prior )?(?:express )?(?:written )?permission"),
]

# The three base phrases; their places are counted whatever else is found.
BASE = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]

#: One of these begins a word of every match of every rule.
GATE = [
    "licen", "under", "domain", "rights", "confidential", "permission", "redistribution", "advertising", "promote", "warranty",
    "apache", "gnu", "mozilla", "creativecommons", "boost", "what", "perl",
]


def rules() -> list[Rule]:
    """All rules, most telling first."""
    made = [Rule(label, [keyword], 6, 0.98, pattern) for label, keyword, pattern in BODIES]
    for label, keyword, name, tag in FAMILIES:
        keywords = keyword.split("|")
        called = name if "licen[cs]e (?:version" in name else f"{name} licen[cs]e"  # a version follows the word itself
        made += [
            Rule(label, keywords, 4, 0.95, rf"(?:licensed|released|distributed|available|published|provided) (?:to you )?under (?:the )?(?:terms of (?:the )?)?{name}(?: licen[cs]e)?"),
            Rule(label, keywords, 3, 0.9, rf"licen[cs]e (?:type |name )?(?:is )?(?:the )?{name}(?: licen[cs]e)?", "licen"),
            Rule(label, keywords, 2, 0.85, called, "licen"),
        ]
        if tag:
            made += [
                Rule(label, ["spdx"], 7, 0.99, rf"spdx license identifier {tag}", "licen"),
                Rule(label, ["license"], 5, 0.92, rf"license {tag} see (?:the )?license", "licen"),
            ]
    made += [Rule(label, ["license"], 1, 0.8, phrase, "licen") for label, phrase in BASE]
    return sorted(made, key=lambda r: -r.priority)
