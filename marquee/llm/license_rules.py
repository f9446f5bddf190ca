"""Signature rules for licences: names and forms of statement, combined into a few hundred ordered patterns."""

from __future__ import annotations

from dataclasses import dataclass

#: Label, keyword that must occur for any rule of its name to be tried, pattern of its name, identifiers in tags,
#: address where its text stands. Every text that the name's pattern matches holds the keyword; names without a
#: common word are rows of their own, the further ones without tag and address. Fixed values.
LICENCES = (
    ("0bsd", "bsd", r"(?:zero[- ]clause bsd|bsd zero[- ]clause|0bsd)", r"0bsd", "opensource\\.org/licenses?/0bsd"),
    ("afl-3", "academic", r"academic free licen[sc]e(?:,? v(?:ersion)? ?|,? )3(?:\.0)?", r"afl-3\.0", "opensource\\.org/licenses?/afl-3\\.0"),
    ("agpl-3", "gpl", r"(?:gnu )?a(?:ffero )?gpl(?:,? version|[- ]?v)? ?3(?:\.0)?", r"agpl-3\.0(?:-only|-or-later)?", "gnu\\.org/licenses/agpl-3\\.0"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[sc]e", r"agpl-1\.0", "gnu\\.org/licenses/agpl"),
    ("apache-1.1", "apache", r"apache (?:software )?licen[sc]e,? v(?:ersion)? ?1\.1", r"apache-1\.1", "apache\\.org/licenses/license-1\\.1"),
    ("apache-2", "apache", r"apache (?:software )?licen[sc]e(?:,? v(?:ersion)? ?|,? )2(?:\.0)?", r"apache-2\.0", "apache\\.org/licenses/license-2\\.0"),
    ("apache", "apache", r"apache (?:software )?licen[sc]e", r"apache-1\.0", "apache\\.org/licenses"),
    ("artistic-1", "artistic", r"artistic licen[sc]e(?:,? v(?:ersion)? ?|,? )1(?:\.0)?", r"artistic-1\.0(?:-perl|-cl8)?", "opensource\\.org/licenses?/artistic-1\\.0"),
    ("artistic-2", "artistic", r"artistic licen[sc]e(?:,? v(?:ersion)? ?|,? )2(?:\.0)?", r"artistic-2\.0", "opensource\\.org/licenses?/artistic-2\\.0"),
    ("blueoak", "blue oak", r"blue oak model licen[sc]e", r"blueoak-1\.0\.0", "blueoakcouncil\\.org/license"),
    ("bsd-2-clause", "bsd", r"(?:(?:2|two)[- ]clause bsd|bsd[- ](?:2|two)[- ]clause|(?:simplified|freebsd) bsd)", r"bsd-2-clause", "opensource\\.org/licenses?/bsd-2-clause"),
    ("bsd-3-clause", "bsd", r"(?:(?:3|three)[- ]clause bsd|bsd[- ](?:3|three)[- ]clause|(?:new|modified|revised) bsd)", r"bsd-3-clause", "opensource\\.org/licenses?/bsd-3-clause"),
    ("bsd-4-clause", "bsd", r"(?:(?:4|four)[- ]clause bsd|bsd[- ](?:4|four)[- ]clause|original bsd)", r"bsd-4-clause", "spdx\\.org/licenses/bsd-4-clause"),
    ("bsd", "bsd", r"bsd(?:[- ]style)? licen[sc]e", r"bsd", "opensource\\.org/licenses?/bsd-license"),
    ("bsl-1", "boost", r"boost software licen[sc]e", r"bsl-1\.0", "boost\\.org/license_1_0"),
    ("busl-1.1", "business source", r"business source licen[sc]e", r"busl-1\.1", "mariadb\\.com/bsl11"),
    ("cc-by", "by", r"cc[- ]by(?: \d\.\d)?(?: international)?", r"cc-by-\d\.\d", "creativecommons\\.org/licenses/by/"),
    ("cc-by", "creative commons", r"creative commons attribution(?: \d\.\d)?(?: international)?", None, None),
    ("cc-by-nc", "by", r"cc[- ]by[- ]nc(?: \d\.\d)?(?: international)?", r"cc-by-nc-\d\.\d", "creativecommons\\.org/licenses/by-nc/"),
    ("cc-by-nc", "creative commons", r"creative commons attribution[- ]non-?commercial(?: \d\.\d)?(?: international)?", None, None),
    ("cc-by-nc-nd", "by", r"cc[- ]by[- ]nc[- ]nd(?: \d\.\d)?", r"cc-by-nc-nd-\d\.\d", "creativecommons\\.org/licenses/by-nc-nd/"),
    ("cc-by-nc-nd", "creative commons", r"creative commons attribution[- ]non-?commercial[- ]no-?deriv(?:ative)?s(?: \d\.\d)?", None, None),
    ("cc-by-nc-sa", "by", r"cc[- ]by[- ]nc[- ]sa(?: \d\.\d)?", r"cc-by-nc-sa-\d\.\d", "creativecommons\\.org/licenses/by-nc-sa/"),
    ("cc-by-nc-sa", "creative commons", r"creative commons attribution[- ]non-?commercial[- ]share-?alike(?: \d\.\d)?", None, None),
    ("cc-by-nd", "by", r"cc[- ]by[- ]nd(?: \d\.\d)?", r"cc-by-nd-\d\.\d", "creativecommons\\.org/licenses/by-nd/"),
    ("cc-by-nd", "creative commons", r"creative commons attribution[- ]no-?deriv(?:ative)?s(?: \d\.\d)?", None, None),
    ("cc-by-sa", "by", r"cc[- ]by[- ]sa(?: \d\.\d)?", r"cc-by-sa-\d\.\d", "creativecommons\\.org/licenses/by-sa/"),
    ("cc-by-sa", "creative commons", r"creative commons attribution[- ]share-?alike(?: \d\.\d)?", None, None),
    ("cc0", "cc", r"cc0(?: 1\.0)?(?: universal)?", r"cc0-1\.0", "creativecommons\\.org/publicdomain/zero"),
    ("cc0", "creative commons", r"creative commons zero(?: 1\.0)?(?: universal)?", None, None),
    ("cddl-1", "common development", r"common development and distribution licen[sc]e", r"cddl-1\.[01]", "opensource\\.org/licenses?/cddl"),
    ("cecill", "cecill", r"cecill(?:-[bc])?(?: licen[sc]e)?", r"cecill-(?:1|2|b|c)[.0-9]*", "cecill\\.info/licences"),
    ("cpl-1", "common public", r"common public licen[sc]e", r"cpl-1\.0", "opensource\\.org/licenses?/cpl"),
    ("ecl-2", "educational", r"educational community licen[sc]e", r"ecl-2\.0", "opensource\\.org/licenses?/ecl-2\\.0"),
    ("elastic-2", "elastic", r"elastic licen[sc]e(?:,? v(?:ersion)? ?|,? )2(?:\.0)?", r"elastic-2\.0", "elastic\\.co/licensing/elastic-license"),
    ("epl-1", "eclipse", r"eclipse public licen[sc]e(?:,? v(?:ersion)? ?|,? )1(?:\.0)?", r"epl-1\.0", "eclipse\\.org/legal/epl-v10"),
    ("epl-2", "eclipse", r"eclipse public licen[sc]e(?:,? v(?:ersion)? ?|,? )2(?:\.0)?", r"epl-2\.0", "eclipse\\.org/legal/epl-2\\.0"),
    ("eupl-1.2", "european union", r"european union public licen[sc]e", r"eupl-1\.[12]", "joinup\\.ec\\.europa\\.eu/.{0,40}eupl"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[sc]e", r"gfdl-1\.[123](?:-only|-or-later)?", "gnu\\.org/licenses/fdl"),
    ("gpl-1", "gpl", r"(?:gnu )?gpl(?:,? version|[- ]?v)? ?1(?:\.0)?", r"gpl-1\.0(?:-only|-or-later)?", "gnu\\.org/licenses/old-licenses/gpl-1\\.0"),
    ("gpl-2", "gpl", r"(?:gnu )?gpl(?:,? version|[- ]?v)? ?2(?:\.0)?", r"gpl-2\.0(?:-only|-or-later|\+)?", "gnu\\.org/licenses/(?:old-licenses/)?gpl-2\\.0"),
    ("gpl-2", "general public", r"(?:gnu )?general public licen[sc]e,? v(?:ersion)? ?2(?:\.0)?", r"gnu-gpl-2", "gnu\\.org/licenses/gpl2"),
    ("gpl-3", "gpl", r"(?:gnu )?gpl(?:,? version|[- ]?v)? ?3(?:\.0)?", r"gpl-3\.0(?:-only|-or-later|\+)?", "gnu\\.org/licenses/gpl-3\\.0"),
    ("gpl-3", "general public", r"(?:gnu )?general public licen[sc]e,? v(?:ersion)? ?3(?:\.0)?", r"gnu-gpl-3", "gnu\\.org/licenses/gpl3"),
    ("gpl", "general public", r"gnu general public licen[sc]e", r"gpl", "gnu\\.org/licenses/gpl\\.html"),
    ("isc", "isc", r"isc licen[sc]e", r"isc", "opensource\\.org/licenses?/isc"),
    ("lgpl-2.1", "gpl", r"(?:gnu )?lgpl(?:,? version|[- ]?v)? ?2\.1", r"lgpl-2\.1(?:-only|-or-later|\+)?", "gnu\\.org/licenses/(?:old-licenses/)?lgpl-2\\.1"),
    ("lgpl-3", "gpl", r"(?:gnu )?lgpl(?:,? version|[- ]?v)? ?3(?:\.0)?", r"lgpl-3\.0(?:-only|-or-later|\+)?", "gnu\\.org/licenses/lgpl-3\\.0"),
    ("lgpl", "general public", r"(?:gnu )?(?:lesser|library) general public licen[sc]e", r"lgpl", "gnu\\.org/licenses/lgpl\\.html"),
    ("mit", "mit", r"mit licen[sc]e", r"mit(?:-0)?", "opensource\\.org/licenses?/mit"),
    ("mit", "expat", r"expat licen[sc]e", None, None),
    ("mit", "x11", r"x11 licen[sc]e", None, None),
    ("mpl-1.1", "mozilla", r"mozilla public licen[sc]e(?:,? v(?:ersion)? ?|,? )1\.1", r"mpl-1\.1", "mozilla\\.org/(?:en-us/)?mpl/1\\.1"),
    ("mpl-2", "mozilla", r"mozilla public licen[sc]e(?:,? v(?:ersion)? ?|,? )2(?:\.0)?", r"mpl-2\.0", "mozilla\\.org/(?:en-us/)?mpl/2\\.0"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e", r"ms-pl", "opensource\\.org/licenses?/ms-pl"),
    ("ncsa", "ncsa", r"(?:university of illinois/)?ncsa open source licen[sc]e", r"ncsa", "opensource\\.org/licenses?/ncsa"),
    ("odbl-1", "open d", r"open (?:data commons open )?database licen[sc]e", r"odbl-1\.0", "opendatacommons\\.org/licenses/odbl"),
    ("ofl-1.1", "open font", r"(?:sil )?open font licen[sc]e", r"ofl-1\.[01]", "scripts\\.sil\\.org/ofl"),
    ("openssl", "openssl", r"openssl licen[sc]e", r"openssl", "openssl\\.org/source/license"),
    ("osl-3", "open software", r"open software licen[sc]e", r"osl-3\.0", "opensource\\.org/licenses?/osl-3\\.0"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e", r"postgresql", "opensource\\.org/licenses?/postgresql"),
    ("psf-2", "python", r"python (?:software foundation )?licen[sc]e", r"psf-2\.0|python-2\.0", "docs\\.python\\.org/.{0,12}license"),
    ("sspl-1", "server side", r"server side public licen[sc]e", r"sspl-1\.0", "mongodb\\.com/licensing/server-side"),
    ("unlicense", "unlicense", r"the unlicense", r"unlicense", "unlicense\\.org"),
    ("upl-1", "universal permissive", r"universal permissive licen[sc]e", r"upl-1\.0", "opensource\\.org/licenses?/upl"),
    ("w3c", "w3c", r"w3c software (?:notice and )?licen[sc]e", r"w3c", "w3\\.org/consortium/legal"),
    ("wtfpl", "do what the", r"do what the f\w{1,3} you want to public licen[sc]e", r"wtfpl", "wtfpl\\.net"),
    ("zlib", "zlib", r"zlib(?:/libpng)? licen[sc]e", r"zlib", "opensource\\.org/licenses?/zlib"),
    ("zpl-2.1", "zope", r"zope public licen[sc]e", r"zpl-2\.[01]", "opensource\\.org/licenses?/zpl"),
)

#: Priority (1 decides first), confidence, keyword of the form or None, and the pattern around a part of LICENCES.
FORMS = (
    (1, 0.99, "spdx-license-identifier", "tag", r"spdx-license-identifier:[ \t]*(?:{0})(?![\w.-])"),
    (2, 0.95, "under", "name",
     r"(?:licen[sc]ed|released|distributed|available|published|provided|covered)[\s\w]{{0,30}}? under (?:the )?(?:terms of (?:the )?)?{0}(?!\w)"),
    (3, 0.9, "://", "address", r"https?://(?:www\.)?{0}"),
    (4, 0.6, None, "name", r"(?<!\w){0}(?!\w)"),
)

#: Statements that name no licence: label, keyword, pattern, confidence. They decide last. Fixed values.
OTHERS = (
    ("all-rights-reserved", "rights reserved", r"all rights reserved", 0.5),
    ("public-domain", "public domain", r"(?:placed in|dedicated to|released into|in) the public domain", 0.6),
    ("permissive-text", "free of charge", r"permission is hereby granted,? free of charge", 0.7),
    ("bsd-text", "redistribution", r"redistribution and use in source and binary forms", 0.7),
    ("gpl-text", "free software", r"this (?:program|library) is free software", 0.7),
    ("no-warranty", "warrant", r"without (?:any )?warrant(?:y|ies) of any kind", 0.3),
)

#: A text without any of these is not looked at further. Every text that a pattern matches holds one of them.
ANCHORS = (
    "licen", "spdx", "rights reserved", "public domain", "gpl", "bsd", "cc-by", "cc by", "cc0", "creative commons",
    "creativecommons", "cecill", "free of charge", "redistribution", "free software", "warrant", "opensource.org",
    "opendatacommons", "scripts.sil.org", "mozilla.org", "joinup.ec", "w3.org", "eclipse.org/legal",
    "mariadb.com/bsl11", "wtfpl.net",
)


@dataclass(frozen=True)
class Rule:
    order: int
    priority: int
    confidence: float
    label: str
    keyword: str
    pattern: str


def rules() -> list[Rule]:
    """All rules in the order in which they decide among equal ones."""
    made = []
    for priority, confidence, form_keyword, part, pattern in FORMS:
        for label, keyword, name, tag, address in LICENCES:
            own = {"name": name, "tag": tag, "address": address}[part]
            if own is None:
                continue
            gate = keyword if form_keyword in (None, "under") else form_keyword
            made.append((priority, confidence, label, gate, pattern.format(own)))
    last = max(priority for priority, *_ in FORMS) + 1
    made += [(last, confidence, label, keyword, pattern) for label, keyword, pattern, confidence in OTHERS]
    return [Rule(i, *rule[:2], *rule[2:]) for i, rule in enumerate(made)]
