"""License scans with ordered signature rules.

A rule is a regex with a label and a priority; it runs only on texts that hold the keywords that every match must hold.
Keywords are read off the parsed regexes, so the prefilter loses nothing, and one automaton finds them all in a pass.
Detections are intervals of the text. One that lies within an interval of higher priority (or of the same
priority, where longer or earlier) is suppressed, so "GNU Lesser General Public License" is not also a GPL.
SPDX tags are read as expressions, all their identifiers count. A family's label goes where a member's is in the text.
The three base phrases are word sequences whose labels always stay.
"""

from __future__ import annotations

import re
from re import _constants as sre
from re import _parser as sre_parser
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Words, text_slices

_W = rb"[0-9a-z\x80-\xff]"
_GAP = rb"[^0-9a-z\x80-\xff]+"

#: Word sequences and their labels.
BASE = ((b"mit license", "mit"), (b"apache license", "apache"), (b"general public license", "gpl"))


#: Clauses that must all hold; one holds if the text has all literals of one of its sets.
Needs = tuple[tuple[frozenset[bytes], ...], ...]


def _needs(parsed, head: bytes = b"", least: int = 3) -> Needs:
    """Literals of ``least`` bytes or more that every match of a parsed regex after ``head`` holds; other constructs ask for nothing."""
    clauses: list[tuple[frozenset[bytes], ...]] = []
    literals, run = set(), bytearray(head)

    def close() -> None:
        if len(run) >= least:
            literals.add(bytes(run))
        run.clear()

    for op, value in parsed:
        if op is sre.LITERAL:
            run.append(value)
            continue
        before = bytes(run)
        close()
        if op is sre.SUBPATTERN or op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0] > 0:
            clauses += _needs(value[-1], least=least)
            continue
        if op is not sre.BRANCH:
            continue
        # The parser moves what all branches begin with before them. A branch gives all its sure literals, or else one clause.
        sets: set[frozenset[bytes]] = set()
        for branch in value[1]:
            own = _needs(branch, before, least)
            single = frozenset().union(*(c[0] for c in own if len(c) == 1))
            sets.update([single] if single else max(own, key=lambda c: min(map(len, c)), default=(frozenset(),)))
        if all(sets):
            clauses.append(tuple(sorted(sets, key=sorted)))
    close()
    return ((frozenset(literals),), *clauses) if literals else tuple(clauses)


#: Labels that say less than others: a family goes where one of its members, by its beginning, is in the same text.
FAMILIES = {"bsd": ("bsd-",), "gpl": ("gpl-2", "gpl-3", "agpl", "lgpl"), "lgpl": ("lgpl-",), "agpl": ("agpl-",), "mpl": ("mpl-",), "epl": ("epl-",), "apache": ("apache-",), "cc": ("cc-", "cc0"), "all-rights-reserved": ("",)}
#: SPDX exceptions that are labels of their own.
EXCEPTIONS = ((re.compile(rb"llvm-exception"), "llvm-exception"), (re.compile(rb"classpath-exception-2\.0"), "gpl-classpath"), (re.compile(rb"font-exception-2\.0"), "gpl-font"), (re.compile(rb"bison-exception-2\.2"), "gpl-bison"), (re.compile(rb"autoconf-exception-[23]\.0"), "gpl-autoconf"))
_TAG = re.compile(rb"spdx-license-identifier:[ \t]*")
_TERM = re.compile(rb"[ \t(]*([a-z0-9][a-z0-9.+-]*)[ \t)]*")


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    weight: float
    keywords: tuple[tuple[bytes, ...], ...]
    pattern: re.Pattern[bytes]


# Names by license: label, SPDX identifiers, how prose names it (regexes over lower-cased text).
def _version(number: bytes) -> bytes:
    """How prose gives a version: v2, version 2, version 2.0, or 2.0 alone."""
    return rb"(?:,? ?v(?:ersion)?\.? ?" + number + rb"(?:\.0)?| " + number + (rb"" if b"." in number else rb"\.0") + rb")"


NAMES: tuple[tuple[str, tuple[bytes, ...], tuple[bytes, ...]], ...] = (
    ("mit", (rb"mit", rb"x11"), (rb"(?:the )?mit/?(?:x11)? licen[cs]e", rb"expat licen[cs]e")),
    ("mit-0", (rb"mit-0",), (rb"mit no attribution",)),
    ("apache-1.1", (rb"apache-1\.1",), (rb"apache (?:software )?licen[cs]e,? ?v(?:ersion)?\.? ?1\.1",)),
    ("apache-2.0", (rb"apache-2\.0",), (rb"apache (?:software )?licen[cs]e" + _version(b"2"), rb"apache 2\.0")),
    ("gpl-2.0", (rb"gpl-2\.0(?:-only|-or-later|\+)?",), (rb"gnu general public licen[cs]e" + _version(b"2"), rb"gpl ?v?2(?:\.0)?")),
    ("gpl-3.0", (rb"gpl-3\.0(?:-only|-or-later|\+)?",), (rb"gnu general public licen[cs]e" + _version(b"3"), rb"gpl ?v?3(?:\.0)?")),
    ("lgpl-2.0", (rb"lgpl-2\.0(?:-only|-or-later|\+)?",), (rb"gnu (?:lesser|library) general public licen[cs]e" + _version(b"2"), rb"lgpl ?v?2(?:\.0)?")),
    ("lgpl-2.1", (rb"lgpl-2\.1(?:-only|-or-later|\+)?",), (rb"gnu (?:lesser|library) general public licen[cs]e" + _version(rb"2\.1"), rb"lgpl ?v?2\.1")),
    ("lgpl-3.0", (rb"lgpl-3\.0(?:-only|-or-later|\+)?",), (rb"gnu lesser general public licen[cs]e" + _version(b"3"), rb"lgpl ?v?3(?:\.0)?")),
    ("agpl-3.0", (rb"agpl-3\.0(?:-only|-or-later|\+)?",), (rb"gnu affero general public licen[cs]e" + _version(b"3"), rb"agpl ?v?3(?:\.0)?")),
    ("gfdl", (rb"gfdl-1\.[123](?:-only|-or-later)?",), (rb"gnu free documentation licen[cs]e",)),
    ("bsd-2-clause", (rb"bsd-2-clause",), (rb"(?:2|two)[- ]clause bsd", rb"simplified bsd licen[cs]e", rb"freebsd licen[cs]e")),
    ("bsd-3-clause", (rb"bsd-3-clause",), (rb"(?:3|three)[- ]clause bsd", rb"(?:new|modified|revised) bsd licen[cs]e")),
    ("bsd-4-clause", (rb"bsd-4-clause",), (rb"(?:4|four)[- ]clause bsd", rb"original bsd licen[cs]e")),
    ("0bsd", (rb"0bsd",), (rb"zero[- ]clause bsd", rb"bsd zero clause")),
    ("mpl-1.1", (rb"mpl-1\.1",), (rb"mozilla public licen[cs]e" + _version(rb"1\.1"), rb"mpl ?v?1\.1")),
    ("mpl-2.0", (rb"mpl-2\.0",), (rb"mozilla public licen[cs]e" + _version(b"2"), rb"mpl ?v?2(?:\.0)?")),
    ("epl-1.0", (rb"epl-1\.0",), (rb"eclipse public licen[cs]e" + _version(b"1"), rb"epl ?v?1(?:\.0)?")),
    ("epl-2.0", (rb"epl-2\.0",), (rb"eclipse public licen[cs]e" + _version(b"2"), rb"epl ?v?2(?:\.0)?")),
    ("cddl-1.0", (rb"cddl-1\.[01]",), (rb"common development and distribution licen[cs]e",)),
    ("cpl-1.0", (rb"cpl-1\.0",), (rb"common public licen[cs]e",)),
    ("eupl", (rb"eupl-1\.[12]",), (rb"european union public licen[cs]e",)),
    ("isc", (rb"isc",), (rb"(?:the )?isc licen[cs]e",)),
    ("zlib", (rb"zlib",), (rb"zlib(?:/libpng)? licen[cs]e",)),
    ("bsl-1.0", (rb"bsl-1\.0",), (rb"boost software licen[cs]e",)),
    ("unlicense", (rb"unlicense",), (rb"(?:the )?unlicense",)),
    ("wtfpl", (rb"wtfpl",), (rb"do what the fuck you want to public licen[cs]e", rb"wtfpl")),
    ("cc0-1.0", (rb"cc0-1\.0",), (rb"creative commons zero", rb"cc0")),
    ("cc-by", (rb"cc-by-[1234]\.0",), (rb"creative commons attribution(?: [1234]\.0)?(?: international| unported)? licen[cs]e",)),
    ("cc-by-sa", (rb"cc-by-sa-[1234]\.0",), (rb"creative commons attribution[- ]share[- ]?alike",)),
    ("cc-by-nc", (rb"cc-by-nc-[1234]\.0",), (rb"creative commons attribution[- ]non[- ]?commercial",)),
    ("cc-by-nd", (rb"cc-by-nd-[1234]\.0",), (rb"creative commons attribution[- ]no[- ]?deriv(?:s|atives)",)),
    ("artistic", (rb"artistic-[12]\.0",), (rb"artistic licen[cs]e(?: [12]\.0)?",)),
    ("python", (rb"psf-2\.0", rb"python-2\.0"), (rb"python software foundation licen[cs]e",)),
    ("ruby", (rb"ruby",), (rb"ruby licen[cs]e",)),
    ("php", (rb"php-3\.0[01]?",), (rb"php licen[cs]e",)),
    ("ofl-1.1", (rb"ofl-1\.1",), (rb"sil open font licen[cs]e", rb"open font licen[cs]e")),
    ("ms-pl", (rb"ms-pl",), (rb"microsoft public licen[cs]e",)),
    ("ms-rl", (rb"ms-rl",), (rb"microsoft reciprocal licen[cs]e",)),
    ("afl", (rb"afl-[123]\.[012]",), (rb"academic free licen[cs]e",)),
    ("osl", (rb"osl-[123]\.[01]",), (rb"open software licen[cs]e",)),
    ("odbl", (rb"odbl-1\.0",), (rb"open (?:data commons open )?database licen[cs]e",)),
    ("vim", (rb"vim",), (rb"vim licen[cs]e",)),
    ("ncsa", (rb"ncsa",), (rb"university of illinois/ncsa", rb"ncsa open source licen[cs]e")),
    ("qpl", (rb"qpl-1\.0",), (rb"q public licen[cs]e",)),
    ("postgresql", (rb"postgresql",), (rb"postgresql licen[cs]e",)),
)
# Signatures: sentences, titles, addresses and short forms, each for one license, by priority.
# 60: sentences of license texts and notices; 55: addresses; 45: titles; 25: families without a version.
_WEIGHTS = {60: 0.95, 55: 0.95, 45: 0.8, 25: 0.5}
SIGNATURES: tuple[tuple[int, str, bytes], ...] = (
    (60, "mit", rb"permission is hereby granted, free of charge, to any person obtaining a copy"),
    (60, "mit", rb"the above copyright notice and this permission notice shall be included in all copies or substantial portions"),
    (60, "mit", rb"in no event shall the authors or copyright holders be liable for any claim, damages or other liability"),
    (60, "x11", rb"except as contained in this notice, the name of .{1,80}? shall not be used in advertising"),
    (60, "isc", rb"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee"),
    (60, "isc", rb"the software is provided \W{0,2}as is\W{0,2} and (?:the author|isc) disclaims all warranties with regard to this software"),
    (60, "hpnd", rb"permission to use, copy, modify,? and distribute this software and its documentation for any purpose"),
    (60, "ntp", rb"permission to use, copy, modify, and distribute this software and its documentation .{0,40}?with or without fee is hereby granted, provided"),
    (60, "bsd", rb"redistribution and use in source and binary forms, with or without modification"),
    (60, "bsd-2-clause", rb"other materials provided with the distribution\.\W{0,8}this software is provided by"),
    (60, "bsd", rb"redistributions of source code must retain the above copyright notice, this list of conditions"),
    (60, "bsd", rb"redistributions in binary form must reproduce the above copyright notice, this list of conditions"),
    (60, "bsd-3-clause", rb"neither the name of .{1,80}? may be used to endorse or promote products"),
    (60, "bsd-3-clause", rb"the names? of .{1,80}? may not be used to endorse or promote products derived from this software"),
    (60, "bsd-4-clause", rb"all advertising materials mentioning features or use of this software"),
    (60, "bsd-3-clause-clear", rb"no express or implied licenses to any party's patent rights are granted by this license"),
    (60, "0bsd", rb"permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted\."),
    (60, "unlicense", rb"free and unencumbered software released into the public domain"),
    (60, "unlicense", rb"anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
    (60, "public-domain", rb"(?:released|placed|dedicated|is) (?:in|into|to) the public domain"),
    (60, "public-domain", rb"the authors? (?:hereby )?disclaims? copyright to this (?:source code|software|work)"),
    (60, "public-domain", rb"no copyright is claimed(?: in the united states)?"),
    (60, "apache-2.0", rb"you may not use this (?:file|work|software|product) except in compliance with the license"),
    (60, "apache-2.0", rb"unless required by applicable law or agreed to in writing, software distributed under the license"),
    (60, "apache-2.0", rb"grants to you a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable (?:copyright|patent|\(except)"),
    (60, "apache-1.1", rb"this product includes software developed by the apache (?:software foundation|group)"),
    (60, "gpl", rb"you can redistribute it and/or modify it under the terms of the gnu general public licen[cs]e"),
    (60, "gpl", rb"you should have received a copy of the gnu general public licen[cs]e"),
    (60, "gpl", rb"see the gnu general public licen[cs]e for more details"),
    (60, "gpl-2.0", rb"gnu general public licen[cs]e as published by the free software foundation[,;] (?:either )?version 2 of the licen[cs]e"),
    (60, "gpl-3.0", rb"gnu general public licen[cs]e as published by the free software foundation[,;] (?:either )?version 3 of the licen[cs]e"),
    (60, "lgpl-2.0", rb"gnu (?:lesser|library) general public licen[cs]e as published by the free software foundation[,;] (?:either )?version 2 of the licen[cs]e"),
    (60, "lgpl-2.1", rb"gnu lesser general public licen[cs]e as published by the free software foundation[,;] (?:either )?version 2\.1 of the licen[cs]e"),
    (60, "lgpl-3.0", rb"gnu lesser general public licen[cs]e as published by the free software foundation[,;] (?:either )?version 3 of the licen[cs]e"),
    (60, "agpl-3.0", rb"gnu affero general public licen[cs]e as published by the free software foundation[,;] (?:either )?version 3 of the licen[cs]e"),
    (60, "gpl-3.0", rb"gnu general public licen[cs]e .{0,40}?version 3, 29 june 2007"),
    (60, "lgpl-3.0", rb"gnu lesser general public licen[cs]e .{0,40}?version 3, 29 june 2007"),
    (60, "gpl-2.0", rb"gnu general public licen[cs]e .{0,40}?version 2, june 1991"),
    (60, "gpl", rb"the licenses for most software are designed to take away your freedom to share and change it"),
    (60, "lgpl", rb"under the terms of the gnu (?:lesser|library) general public licen[cs]e"),
    (60, "lgpl", rb"you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e"),
    (60, "lgpl", rb"see the gnu (?:lesser|library) general public licen[cs]e for more details"),
    (60, "lgpl-2.1", rb"version 2\.1, february 1999"),
    (60, "agpl", rb"under the terms of the gnu affero general public licen[cs]e"),
    (60, "agpl-3.0", rb"version 3, 19 november 2007"),
    (60, "gpl-classpath", rb"linking this (?:library|software) statically or dynamically with other modules"),
    (60, "gpl-font", rb"as a special exception, if you create a document which uses this font"),
    (60, "gpl-bison", rb"as a special exception, you may create a larger work that contains part or all of the bison parser skeleton"),
    (60, "gpl-autoconf", rb"as a special exception to the gnu general public licen[cs]e, if you distribute this file as part of a program"),
    (60, "llvm-exception", rb"llvm exceptions? to the apache 2\.0 licen[cs]e"),
    (60, "gfdl", rb"permission is granted to copy, distribute and/or modify this document under the terms of the gnu free documentation"),
    (60, "mpl-2.0", rb"this source code form is subject to the terms of the mozilla public licen[cs]e"),
    (60, "mpl-1.1", rb"the contents of this file are subject to the mozilla public licen[cs]e version 1\.1"),
    (60, "epl-1.0", rb"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e v1\.0"),
    (60, "epl-2.0", rb"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e (?:v )?2\.0"),
    (60, "cddl-1.0", rb"the contents of this file are subject to the terms of the common development and distribution licen[cs]e"),
    (60, "cpl-1.0", rb"the accompanying program is provided under the terms of this common public licen[cs]e"),
    (60, "ipl-1.0", rb"the accompanying program is provided under the terms of this ibm public licen[cs]e"),
    (60, "eupl", rb"licensed under the eupl"),
    (60, "zlib", rb"this software is provided 'as-is', without any express or implied warranty"),
    (60, "zlib", rb"the origin of this software must not be misrepresented"),
    (60, "zlib", rb"altered source versions must be plainly marked as such"),
    (60, "libpng", rb"the png reference library is supplied \W?as is"),
    (60, "bsl-1.0", rb"permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software"),
    (60, "wtfpl", rb"you just do what the fuck you want to"),
    (60, "beerware", rb"if we meet some day, and you think this stuff is worth it, you can buy me a beer"),
    (60, "json", rb"the software shall be used for good, not evil"),
    (60, "curl", rb"copyright .{0,60}?daniel stenberg.{0,80}?all rights reserved"),
    (60, "openssl", rb"this product includes software developed by the openssl project"),
    (60, "ssleay", rb"this product includes cryptographic software written by eric young"),
    (60, "php", rb"this product includes php software, freely available from"),
    (60, "python", rb"the psf (?:hereby grants|is making python)"),
    (60, "vim", rb"there are no restrictions on distributing unmodified copies of vim"),
    (60, "artistic", rb"the intent of this document is to state the conditions under which a package may be copied"),
    (60, "perl", rb"(?:it )?under the same terms as perl(?: itself)?"),
    (60, "ruby", rb"distributed under the same terms as ruby"),
    (60, "ofl-1.1", rb"this font software is licensed under the sil open font licen[cs]e"),
    (60, "ofl-1.1", rb"reserved font names?"),
    (60, "ncsa", rb"deal with the software without restriction, including without limitation the rights to use"),
    (60, "postgresql", rb"permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee"),
    (60, "tcl", rb"the authors hereby grant permission to use, copy, modify, distribute, and license this software"),
    (60, "icu", rb"permission is hereby granted, free of charge, .{0,200}?copyright notice\(s\)"),
    (60, "unicode", rb"unicode,? inc\. (?:hereby )?grants|unicode data files (?:and|or) software"),
    (60, "cc0-1.0", rb"to the extent possible under law, .{0,120}?has waived all copyright"),
    (60, "cc-by", rb"this work is licensed under a creative commons attribution (?:[1234]\.0 )?(?:international |unported )?licen[cs]e"),
    (60, "odc-by", rb"open data commons attribution licen[cs]e"),
    (60, "pddl", rb"public domain dedication and licen[cs]e"),
    (60, "proprietary", rb"this (?:software|file|document) (?:contains|is) (?:the )?(?:confidential|proprietary)"),
    (60, "proprietary", rb"unauthorized (?:copying|reproduction|use|distribution) .{0,80}?strictly prohibited"),
    (60, "all-rights-reserved", rb"copyright .{0,80}?all rights reserved"),
    (55, "apache-2.0", rb"apache\.org/licenses/license-2\.0"),
    (55, "gpl", rb"gnu\.org/(?:licenses|copyleft)/(?:old-licenses/)?gpl"),
    (55, "lgpl", rb"gnu\.org/(?:licenses|copyleft)/(?:old-licenses/)?lgpl"),
    (55, "gfdl", rb"gnu\.org/(?:licenses|copyleft)/fdl"),
    (55, "agpl", rb"gnu\.org/licenses/agpl"),
    (55, "mpl-2.0", rb"mozilla\.org/(?:[a-z-]+/)?mpl/2\.0"),
    (55, "mpl-1.1", rb"mozilla\.org/mpl/mpl-1\.1"),
    (55, "mit", rb"opensource\.org/licen[cs]es?/mit"),
    (55, "isc", rb"opensource\.org/licen[cs]es?/isc"),
    (55, "bsd-3-clause", rb"opensource\.org/licen[cs]es?/bsd-3-clause"),
    (55, "bsd-2-clause", rb"opensource\.org/licen[cs]es?/bsd-2-clause"),
    (55, "bsd", rb"opensource\.org/licen[cs]es?/bsd-license"),
    (55, "ms-pl", rb"opensource\.org/licen[cs]es?/ms-pl"),
    (55, "artistic", rb"opensource\.org/licen[cs]es?/artistic"),
    (55, "epl-1.0", rb"eclipse\.org/legal/epl-v10"),
    (55, "epl-2.0", rb"eclipse\.org/legal/epl-(?:v20|2\.0)"),
    (55, "bsl-1.0", rb"boost\.org/license_1_0"),
    (55, "unlicense", rb"unlicense\.org"),
    (55, "wtfpl", rb"wtfpl\.net"),
    (55, "ofl-1.1", rb"scripts\.sil\.org/ofl"),
    (55, "cddl-1.0", rb"opensolaris\.org/os/licensing"),
    (55, "php", rb"php\.net/license"),
    (55, "cc0-1.0", rb"creativecommons\.org/publicdomain/zero"),
    (55, "public-domain", rb"creativecommons\.org/(?:licenses/publicdomain|publicdomain/mark)"),
    (55, "cc-by", rb"creativecommons\.org/licenses/by/"),
    (55, "cc-by-sa", rb"creativecommons\.org/licenses/by-sa/"),
    (55, "cc-by-nc", rb"creativecommons\.org/licenses/by-nc/"),
    (55, "cc-by-nc-sa", rb"creativecommons\.org/licenses/by-nc-sa"),
    (55, "cc-by-nc-nd", rb"creativecommons\.org/licenses/by-nc-nd"),
    (55, "cc-by-nd", rb"creativecommons\.org/licenses/by-nd"),
    (55, "odbl", rb"opendatacommons\.org/licenses/odbl"),
    (55, "odc-by", rb"opendatacommons\.org/licenses/by"),
    (55, "openrail", rb"huggingface\.co/spaces/bigscience/license"),
    (45, "cc-by-nc-sa", rb"creative commons attribution[- ]non[- ]?commercial[- ]share[- ]?alike|cc-by-nc-sa"),
    (45, "cc-by-nc-nd", rb"creative commons attribution[- ]non[- ]?commercial[- ]no[- ]?deriv|cc-by-nc-nd"),
    (45, "cc-by-sa", rb"cc-by-sa"),
    (45, "cc-by-nc", rb"cc-by-nc"),
    (45, "cc-by", rb"cc-by"),
    (45, "openrail", rb"(?:bigscience |creativeml )?open ?rail(?:[-+]*m)?(?: licen[cs]e)?"),
    (45, "llama", rb"llama [234](?:\.[0-9])? community licen[cs]e"),
    (45, "elastic-2.0", rb"elastic licen[cs]e"),
    (45, "sspl-1.0", rb"server side public licen[cs]e|sspl"),
    (45, "busl-1.1", rb"business source licen[cs]e"),
    (45, "commons-clause", rb"commons clause"),
    (45, "prosperity", rb"prosperity public licen[cs]e"),
    (45, "polyform", rb"polyform (?:noncommercial|shield|strict|small business|perimeter)"),
    (45, "cecill", rb"cecill(?:-[bc])?(?: licen[cs]e)?"),
    (45, "sleepycat", rb"sleepycat licen[cs]e"),
    (45, "watcom", rb"sybase open watcom public licen[cs]e"),
    (45, "apsl", rb"apple public source licen[cs]e"),
    (45, "nasa", rb"nasa open source agreement"),
    (45, "intel", rb"intel open source licen[cs]e"),
    (45, "w3c", rb"w3c (?:software (?:notice and )?)?licen[cs]e"),
    (45, "zpl", rb"zope public licen[cs]e"),
    (45, "lppl", rb"latex project public licen[cs]e"),
    (45, "ecl-2.0", rb"educational community licen[cs]e"),
    (45, "mulan", rb"mulan (?:psl|permissive software licen[cs]e)"),
    (45, "upl-1.0", rb"universal permissive licen[cs]e"),
    (45, "blueoak", rb"blue oak model licen[cs]e"),
    (45, "ms-lpl", rb"microsoft limited public licen[cs]e"),
    (45, "hippocratic", rb"hippocratic licen[cs]e"),
    (45, "dual", rb"dual[- ]licen[cs]ed"),
    (25, "gpl", rb"gnu general public licen[cs]e|gnu gpl|gpl"),
    (25, "lgpl", rb"gnu (?:lesser|library) general public licen[cs]e|gnu lgpl|lgpl"),
    (25, "agpl", rb"gnu affero general public licen[cs]e|gnu agpl|agpl"),
    (25, "bsd", rb"bsd licen[cs]e|bsd[- ]style"),
    (25, "mpl", rb"mozilla public licen[cs]e|mpl"),
    (25, "epl", rb"eclipse public licen[cs]e|epl"),
    (25, "apache", rb"apache (?:software )?licen[cs]e"),
    (25, "cc", rb"creative commons"),
    (25, "eupl", rb"eupl"),
    (25, "open-source", rb"osi[- ]approved licen[cs]e"),
    (25, "proprietary", rb"proprietary licen[cs]e|commercial licen[cs]e|end user licen[cs]e agreement"),
)


def _keywords(needs: Needs) -> tuple[tuple[bytes, ...], ...]:
    """Groups of keywords, of each of which every match holds one: the longest literal of each way to hold a clause."""
    return tuple(tuple(sorted({max(s, key=lambda x: (len(x), x)) for s in clause})) for clause in needs)


def _rule(label: str, priority: int, weight: float, pattern: bytes) -> Rule:
    return Rule(label, priority, weight, _keywords(_needs(sre_parser.parse(pattern, re.S))), re.compile(pattern, re.S))


def _rules() -> tuple[Rule, ...]:
    """Every name in every way it is declared (tag, manifest field, sentence, bare name), and the signatures."""
    rules = []
    for label, tags, names in NAMES:
        tag, name = b"(?:" + b"|".join(tags) + b")", b"(?:" + b"|".join(names) + b")"
        for priority, weight, pattern in (
            (50, 0.95, rb"\"?licen[cs]e\"? ?[:=] ?[\"'\[]*" + tag + rb"[\"'\]]"),
            (40, 0.9, rb"(?:licen[cs]ed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?(?:" + name + rb"|" + tag + rb"(?= licen))"),
            (35, 0.85, rb"dual[- ]licen[cs]ed under (?:the )?" + name),
            (30, 0.8, name),
            (20, 0.6, rb"see (?:the )?" + name + rb" for (?:more )?details"),
        ):
            rules.append(_rule(label, priority, weight, rb"(?<!" + _W + rb")" + pattern.replace(b" ", rb"\s+").replace(rb"\s+?", rb"\s*") + rb"(?!" + _W + rb")"))
    for priority, label, pattern in SIGNATURES:
        spaced = b"(?:" + pattern.replace(b" ", rb"\s+").replace(rb"\s+?", rb"\s*") + b")"
        if priority <= 45:  # names are whole words
            spaced = rb"(?<!" + _W + rb")" + spaced + rb"(?!" + _W + rb")"
        rules.append(_rule(label, priority, _WEIGHTS[priority], spaced))
    return tuple(sorted(rules, key=lambda r: -r.priority))


RULES = _rules()
KEYWORDS = tuple(sorted({x for r in RULES for group in r.keywords for x in group}))
_BASE = tuple((re.compile(rb"(?<!" + _W + rb")" + phrase.replace(b" ", _GAP) + rb"(?!" + _W + rb")"), phrase.split()[-1], label) for phrase, label in BASE)


_IDENTIFIERS = tuple((re.compile(b"|".join(tags)), label) for label, tags, _ in NAMES) + EXCEPTIONS


def expressions(low: bytes) -> list[tuple[int, int, str]]:
    """(start, end, label) of every identifier of the SPDX expressions of a text: terms joined by OR, AND and WITH, with parentheses.

    A line's expression ends where two terms follow each other without a word between them. Identifiers that are not
    known have no label.
    """
    out = []
    for tag in _TAG.finditer(low):
        at, joined = tag.end(), True
        while m := _TERM.match(low, at):
            word = m[1].rstrip(b".")
            if word in (b"or", b"and", b"with"):
                joined = True
            elif not joined:
                break
            else:
                joined = False
                out += [(m.start(1), m.start(1) + len(word), label) for pattern, label in _IDENTIFIERS if pattern.fullmatch(word)]
            at = m.end()
    return out


def specific(labels: set[str]) -> set[str]:
    """Without families of which a member is there."""
    return {x for x in labels if x not in FAMILIES or not any(y != x and y.startswith(FAMILIES[x]) for y in labels)}


@lru_cache(1)
def _finder() -> ahocorasick.Automaton:
    """Finds all keywords in one pass; bytes are read as Latin-1, a character each."""
    automaton = ahocorasick.Automaton()
    for k in KEYWORDS:
        automaton.add_word(k.decode("latin-1"), k)
    automaton.make_automaton()
    return automaton


@lru_cache(4096)
def _possible(has: frozenset[bytes]) -> tuple[Rule, ...]:
    """The rules that can match a text with these keywords."""
    return tuple(r for r in RULES if not any(has.isdisjoint(group) for group in r.keywords))


def detect(low: bytes, prefilter: bool = True) -> list[tuple[int, int, str, float]]:
    """Detections (start, end, label, weight) that no other one suppresses, in order of the text."""
    rules = _possible(frozenset(k for _, k in _finder().iter(low.decode("latin-1")))) if prefilter else RULES
    found = [(m.start(), m.end(), r) for r in rules for m in r.pattern.finditer(low) if m.end() > m.start()]
    found += [(start, end, Rule(label, 60, 0.99, (), _TAG)) for start, end, label in expressions(low)]
    # Whatever lies around a detection starts no later: one pass by start, with the furthest end of each priority so far.
    found.sort(key=lambda x: (x[0], -x[1], -x[2].priority))
    kept: list[tuple[int, int, str, float]] = []
    furthest: dict[int, int] = {}
    for s, e, r in found:
        if not any(z >= e and p >= r.priority for p, z in furthest.items()):
            kept.append((s, e, r.label, r.weight))
        furthest[r.priority] = max(e, furthest.get(r.priority, 0))
    return sorted(kept)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in text_slices(batches):
        words = Words(data, offsets)
        low = LOWER[data].tobytes()
        out: list[tuple] = []
        for i in range(batch.num_rows):
            a, z = int(offsets[i]), int(offsets[i + 1])
            text = low[a:z]
            own = words.start[words.of[i] : words.of[i + 1]]
            places = [(m.start(), label) for pattern, last, label in _BASE if last in text for m in pattern.finditer(text)]
            at = np.searchsorted(own, np.array([p for p, _ in places], np.int64) + a) if places else None
            base = {label for _, label in places}
            found = detect(text)
            labels = base | specific({x[2] for x in found})
            score = max([0.8 * bool(places), *(x[3] for x in found)])
            out.append((len(own), len(places), int(at.min()) if places else None, int(at.max()) if places else None, ",".join(sorted(base)), ",".join(sorted(labels)), score, [{"start": s, "end": e, "label": n} for s, e, n, _ in found]))
        cols = list(zip(*out, strict=True))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string())]))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: counts and places of the base phrases, labels, score, detections (byte spans).

    ``score`` is the weight of the surest detection, 0 without any. Null and empty texts have no words, no label
    and score 0. Repeated rows and ids stay rows of their own; other columns are not read.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_scan, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<start:long,end:long,label:string>>")
