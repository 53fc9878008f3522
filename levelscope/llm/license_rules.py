"""Signatures of licenses and rights notices, over lower-cased words joined by single blanks.

Each rule is a label, a pattern and a confidence; its place in the list is its priority, first before
later. Patterns start with a plain word. ``@2.0`` stands for a version in any of its spellings. They use
what the regular expressions of Spark and of SQL engines have in common: groups, choices, ``?``, classes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: Words that are too common to look for first.
COMMON = set(
    "all and any be by common data development do for free general in is may new no not of on only open original "
    "public q released rights server side some the this to under universal use used what with you zero".split()
)

#: Names of licenses as texts write them, under the identifiers that are usual for them.
NAMES = """
0bsd: zero clause bsd( licen[cs]e)?
0bsd: 0bsd( licen[cs]e)?
afl-3.0: academic free licen[cs]e@3.0
agpl-3.0: gnu affero general public licen[cs]e(@3.0)?
agpl-3.0: affero general public licen[cs]e(@3.0)?
agpl-3.0: (gnu )?agpl@3.0( only| or later)?
apache-1.1: apache (software )?licen[cs]e@1.1
apache-2.0: apache (software )?licen[cs]e(@2.0)?
apache-2.0: apache@2.0
apsl-2.0: apple public source licen[cs]e(@2.0)?
artistic-1.0: artistic licen[cs]e@1.0
artistic-2.0: artistic licen[cs]e@2.0
blueoak-1.0.0: blue oak model licen[cs]e(@1.0)?( 0)?
bsd-1-clause: bsd 1 clause( licen[cs]e)?
bsd-2-clause: bsd 2 clause( licen[cs]e)?
bsd-2-clause: simplified bsd licen[cs]e
bsd-2-clause: freebsd licen[cs]e
bsd-3-clause: bsd 3 clause( clear)?( licen[cs]e)?
bsd-3-clause: (new|modified|revised) bsd licen[cs]e
bsd-4-clause: bsd 4 clause( licen[cs]e)?
bsd-4-clause: original bsd licen[cs]e
bsd: bsd (style )?licen[cs]e
bsl-1.0: boost software licen[cs]e(@1.0)?
busl-1.1: business source licen[cs]e(@1.1)?
cc0-1.0: cc0(@1.0)?( universal)?
cc0-1.0: creative commons zero(@1.0)?( universal)?
cddl-1.0: common development and distribution licen[cs]e(@1.0)?
cddl-1.1: common development and distribution licen[cs]e@1.1
cecill-2.1: cecill( free software licen[cs]e)?@2.1
cpal-1.0: common public attribution licen[cs]e(@1.0)?
cpl-1.0: common public licen[cs]e(@1.0)?
ecl-2.0: educational community licen[cs]e(@2.0)?
elastic-2.0: elastic licen[cs]e(@2.0)?
epl-1.0: eclipse public licen[cs]e@1.0
epl-2.0: eclipse public licen[cs]e(@2.0)?
eupl-1.1: european union public licen[cs]e@1.1
eupl-1.2: european union public licen[cs]e(@1.2)?
gfdl-1.1: gnu free documentation licen[cs]e@1.1
gfdl-1.2: gnu free documentation licen[cs]e@1.2
gfdl-1.3: gnu free documentation licen[cs]e(@1.3)?
gpl-1.0: gnu general public licen[cs]e@1.0( only| or later)?
gpl-2.0: gnu general public licen[cs]e@2.0( only| or later| or any later version)?
gpl-2.0: gnu gpl@2.0( only| or later)?
gpl-2.0: gpl@2.0( only| or later)?
gpl-3.0: gnu general public licen[cs]e@3.0( only| or later| or any later version)?
gpl-3.0: gnu gpl@3.0( only| or later)?
gpl-3.0: gpl@3.0( only| or later)?
gpl: gnu general public licen[cs]e
gpl: gnu gpl
gpl: gpl licen[cs]e
hpnd: historical permission notice and disclaimer
ipl-1.0: ibm public licen[cs]e(@1.0)?
isc: isc licen[cs]e
lgpl-2.0: gnu library general public licen[cs]e(@2.0)?
lgpl-2.1: gnu lesser general public licen[cs]e@2.1( only| or later| or any later version)?
lgpl-2.1: (gnu )?lgpl@2.1( only| or later)?
lgpl-3.0: gnu lesser general public licen[cs]e@3.0( only| or later| or any later version)?
lgpl-3.0: (gnu )?lgpl@3.0( only| or later)?
lgpl: gnu lesser general public licen[cs]e
lgpl: (gnu )?lgpl( licen[cs]e)?
lppl-1.3c: latex project public licen[cs]e( version)?( 1 3c)?
mit-0: mit no attribution( licen[cs]e)?
mit: (the )?mit licen[cs]e
mit: expat licen[cs]e
mpl-1.1: mozilla public licen[cs]e@1.1
mpl-2.0: mozilla public licen[cs]e(@2.0)?
mpl-2.0: mpl@2.0
ms-pl: microsoft public licen[cs]e
ms-rl: microsoft reciprocal licen[cs]e
mulanpsl-2.0: mulan (psl|permissive software licen[cs]e)(@2.0)?
ncsa: (university of illinois )?ncsa open source licen[cs]e
odbl-1.0: (open data commons open|open) database licen[cs]e(@1.0)?
odc-by-1.0: open data commons attribution licen[cs]e(@1.0)?
ofl-1.1: sil open font licen[cs]e(@1.1)?
ogl-3.0: open government licen[cs]e(@3.0)?
osl-3.0: open software licen[cs]e@3.0
pddl-1.0: public domain dedication and licen[cs]e(@1.0)?
php-3.01: php licen[cs]e( version)?( 3 01)?
polyform-noncommercial: polyform non ?commercial licen[cs]e(@1.0)?( 0)?
postgresql: postgresql licen[cs]e
psf-2.0: python software foundation licen[cs]e(@2.0)?
python-2.0: python licen[cs]e@2.0
qpl-1.0: q public licen[cs]e(@1.0)?
sspl-1.0: server side public licen[cs]e(@1.0)?
unicode-dfs: unicode (inc )?licen[cs]e agreement
unlicense: (unlicense|unlicence)
upl-1.0: universal permissive licen[cs]e(@1.0)?
vim: vim licen[cs]e
w3c: w3c software (notice and )?licen[cs]e
wtfpl: wtfpl( licen[cs]e)?
wtfpl: do what the fuck you want to public licen[cs]e
zlib: zlib licen[cs]e
zpl-2.1: zope public licen[cs]e(@2.1)?
"""

#: Addresses of license texts.
ADDRESSES = """
apache-2.0: apache org licenses license 2 0
mit: opensource org licenses mit
bsd-2-clause: opensource org licenses bsd 2 clause
bsd-3-clause: opensource org licenses bsd 3 clause
isc: opensource org licenses isc
gpl-2.0: gnu org licenses (old licenses )?gpl 2 0
gpl-3.0: gnu org licenses gpl 3 0
lgpl-2.1: gnu org licenses (old licenses )?lgpl 2 1
lgpl-3.0: gnu org licenses lgpl 3 0
agpl-3.0: gnu org licenses agpl 3 0
gpl: gnu org licenses gpl
mpl-2.0: mozilla org (en us )?mpl 2 0
epl-2.0: eclipse org legal epl (v20|2 0)
cc0-1.0: creativecommons org publicdomain zero 1 0
public-domain: creativecommons org publicdomain mark 1 0
odbl-1.0: opendatacommons org licenses odbl
unlicense: unlicense org
"""

#: Other notices, with how sure they make.
NOTICES = """
0.9 mit: permission is hereby granted free of charge to any person obtaining a copy
0.9 isc: permission to use copy modify and or distribute this software for any purpose
0.9 bsd: redistribution and use in source and binary forms with or without modification
0.9 unlicense: this is free and unencumbered software released into the public domain
0.9 cc0-1.0: no rights reserved
0.7 some-rights: some rights reserved
0.7 reserved: all rights reserved
0.7 gpl: general public license
0.6 public-domain: public domain
0.6 public-domain: dedicated to the public domain
0.6 copyright: copyright (c )?(19|20)[0-9][0-9]
0.6 copyright: copyright holders?
0.8 proprietary: proprietary and confidential
0.8 proprietary: confidential and proprietary
0.7 proprietary: (unauthorised|unauthorized) (copying|reproduction|distribution)
0.7 no-redistribution: (not for redistribution|not for distribution)
0.7 no-redistribution: (may not be reproduced|may not be redistributed|may not be republished)
0.7 non-commercial: (noncommercial|non commercial) use only
0.7 non-commercial: for non ?commercial (use|purposes)
0.7 personal-use: personal use only
0.7 personal-use: for personal use only
0.6 attribution: attribution (is )?required
0.6 permission: (re)?printed with permission
0.6 permission: (used with permission|used by permission)
"""

#: Ways to say that something is under a license; each makes a rule of its own with every name.
GRANTS = ("licensed under", "released under")
GRANT_WORDS = r"( the terms of)?( the| a| an)?( terms of the)?"
VARIANTS = ("by", "by nc", "by nd", "by sa", "by nc nd", "by nc sa")
LONG_NAMES = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?deriv(ative)?s( works)?", "sa": "share ?alike"}
VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
IDENTIFIED = ("mit", "isc", "zlib", "unlicense", "wtfpl", "ncsa", "postgresql", "vim", "w3c", "hpnd")


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    confidence: float

    @property
    def plain(self) -> list[str]:
        """The plain words that it starts with."""
        plain = re.match(r"[a-z0-9 ]*", self.pattern)[0]
        rest = self.pattern[len(plain) :]
        if rest.startswith("?"):
            plain = plain[:-1]
        if rest and not plain.endswith(" ") and not re.match(r"[(?:]+ ", rest):  # the last word may go on
            plain = plain[: plain.rfind(" ") + 1]
        if not plain.strip():
            raise ValueError(f"{self.pattern} starts with no plain word")
        return plain.split()

    @property
    def head(self) -> str:
        """What it is looked up by: the first two plain words, or the only one."""
        return " ".join(self.plain[:2])

    @property
    def keyword(self) -> str:
        """A plain word without which the rule need not be tried, a rare one if there is one."""
        return max(self.plain, key=lambda w: (w not in COMMON, len(w)))

    @property
    def anchored(self) -> str:
        return f"^(?:{self.pattern})(?: |$)"


def _with_versions(pattern: str) -> str:
    def spelled(match) -> str:
        major, minor = match[1], match[2]
        last = "(?: 0)?" if minor == "0" else f" {minor}"
        return f"(?: version)? v?{major}{last}"

    return re.sub(r"@(\d+)\.(\d+)", spelled, pattern)


def _choices(pattern: str) -> list[str]:
    """A choice at the front becomes several patterns, so that each starts with a plain word."""
    match = re.match(r"\(([^()]*)\)(\?)?( ?)(.*)", pattern)
    if not match:
        return [pattern]
    options = [option + match[3] for option in match[1].split("|")]
    return [option + match[4] for option in options + ([""] if match[2] else [])]


def _lines(text: str) -> list[tuple[str, str]]:
    pairs = [line.split(": ", 1) for line in text.strip().splitlines()]
    return [(head, re.sub(r" +", " ", choice)) for head, pattern in pairs for choice in _choices(pattern)]


def _creative_commons() -> list[tuple[str, str]]:
    out = []
    for variant in VARIANTS:
        long = " ".join(LONG_NAMES[part] for part in variant.split())
        for version in (*reversed(VERSIONS), None):
            label = "cc-" + variant.replace(" ", "-") + (f"-{version}" if version else "")
            at = f"@{version}" if version else ""
            out += [(label, f"cc {variant}{at}"), (label, f"creative commons {long}{at}( international| unported| generic)?")]
            out.append((label, f"creativecommons org licenses {variant}" + (f" {version.replace('.', ' ')}" if version else "")))
    return out


def rules() -> list[Rule]:
    """All rules; the most certain come first."""
    names = _lines(NAMES) + _creative_commons()
    identifiers = sorted({label for label, _ in names if re.search(r"\d|-", label)} | set(IDENTIFIED))
    out = [
        Rule(name, f"spdx license identifier {re.sub('[^a-z0-9]+', ' ', name)}( only| or later)?", 1.0)
        for name in identifiers
    ]
    for grant in GRANTS:
        out += [Rule(label, f"{grant}{GRANT_WORDS} {_with_versions(pattern)}", 0.95) for label, pattern in names]
    out += [Rule(label, pattern, 0.9) for label, pattern in _lines(ADDRESSES)]
    out += [Rule(label, _with_versions(pattern), 0.8) for label, pattern in names]
    for head, pattern in _lines(NOTICES):
        sure, label = head.split(" ")
        out.append(Rule(label, pattern, float(sure)))
    return out
