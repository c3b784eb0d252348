"""The signature rules of the licence scan, strongest first.

Per licence: identifier, names, addresses and telling phrases, each a regular expression over the
text with A-Z lower-cased. ``rules`` spells the forms in which they occur. Every rule has a keyword,
one run of characters without blanks that any of its matches holds, whichever alternative matched.
Bounded gaps (``[\\s\\S]``) go across line breaks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

#: A gap between words: blanks, hyphens and the marks of comments at the start of a line.
GAP = r"[\s*#/-]+"
V = r"(?:version|v\.?)"

# Fixed values: (label, identifier, (keyword, name), ..., with addresses and phrases marked by kind).
LICENCES = (
    ("mit", r"mit", (("mit", r"mit~licen[cs]e"), ("expat", r"expat~licen[cs]e"), ("x11", r"mit/x11")),
     (("opensource.org", r"opensource\.org/licen[cs]es?/mit"), ("mit-license.org", r"mit-license\.org")),
     (("hereby", r"permission~is~hereby~granted,~free~of~charge,~to~any~person~obtaining~a~copy"),)),
    ("mit-0", r"mit-0", (("mit", r"mit~no~attribution"),), (), ()),
    ("apache-2.0", r"apache-2\.0",
     (("apache", r"apache~(?:software~)?licen[cs]e,?~(?:@~)?2(?:\.0)?\b"), ("apache", r"apache[ -]2(?:\.0)?\b"), ("asl", r"\basl[ -]?2\.0")),
     (("apache.org", r"apache\.org/licen[cs]es/license-2\.0"), ("opensource.org", r"opensource\.org/licen[cs]es?/apache-2\.0")),
     (("apache", r"you~may~not~use~this~file~except~in~compliance~with~the~licen[cs]e[\s\S]{0,80}apache"),
      ("unless", r"unless~required~by~applicable~law~or~agreed~to~in~writing,~software~distributed~under~the~licen[cs]e"))),
    ("apache-1.1", r"apache-1\.1", (("apache", r"apache~(?:software~)?licen[cs]e,?~(?:@~)?1\.1"),), (("apache.org", r"apache\.org/licen[cs]es/license-1\.1"),), ()),
    ("apache-1.0", r"apache-1\.0", (("apache", r"apache~(?:software~)?licen[cs]e,?~(?:@~)?1\.0"),), (("apache.org", r"apache\.org/licen[cs]es/license-1\.0"),), ()),
    ("gpl-1.0", r"gpl-1\.0(?:-only|-or-later|\+)?", (("gpl", r"gpl~?v?1(?:\.0)?\b"),), (("gnu.org", r"gnu\.org/licen[cs]es/(?:old-licenses/)?gpl-1\.0"),), ()),
    ("gpl-2.0", r"gpl-2\.0(?:-only)?", (("gnu", r"gnu~general~public~licen[cs]e,?~(?:as~published[\s\S]{0,60}?~)?@~2(?:\.0)?\b"), ("gpl", r"(?:gnu~)?gpl[ ,-]*v?(?:ersion~)?2(?:\.0)?\b")),
     (("gnu.org", r"gnu\.org/licen[cs]es/(?:old-licenses/)?gpl-2\.0"), ("opensource.org", r"opensource\.org/licen[cs]es?/gpl-2\.0")), ()),
    ("gpl-2.0-or-later", r"gpl-2\.0(?:-or-later|\+)", (("gpl", r"(?:gnu~)?gpl[ ,-]*v?2(?:\.0)?\+"),), (),
     (("either", r"either~@~2~of~the~licen[cs]e,~or~\(at~your~option\)~any~later~version"),)),
    ("gpl-3.0", r"gpl-3\.0(?:-only)?", (("gnu", r"gnu~general~public~licen[cs]e,?~(?:as~published[\s\S]{0,60}?~)?@~3(?:\.0)?\b"), ("gpl", r"(?:gnu~)?gpl[ ,-]*v?(?:ersion~)?3(?:\.0)?\b")),
     (("gnu.org", r"gnu\.org/licen[cs]es/gpl-3\.0"), ("opensource.org", r"opensource\.org/licen[cs]es?/gpl-3\.0")), ()),
    ("gpl-3.0-or-later", r"gpl-3\.0(?:-or-later|\+)", (("gpl", r"(?:gnu~)?gpl[ ,-]*v?3(?:\.0)?\+"),), (),
     (("either", r"either~@~3~of~the~licen[cs]e,~or~\(at~your~option\)~any~later~version"),)),
    ("lgpl-2.0", r"lgpl-2\.0(?:-only|-or-later|\+)?", (("library", r"gnu~library~general~public~licen[cs]e(?:,?~@~2(?:\.0)?)?"), ("lgpl", r"lgpl[ ,-]*v?2(?:\.0)?\b")), (), ()),
    ("lgpl-2.1", r"lgpl-2\.1(?:-only|-or-later|\+)?", (("lesser", r"gnu~lesser~general~public~licen[cs]e,?~@~2\.1"), ("lgpl", r"lgpl[ ,-]*v?2\.1\b")),
     (("gnu.org", r"gnu\.org/licen[cs]es/(?:old-licenses/)?lgpl-2\.1"), ("opensource.org", r"opensource\.org/licen[cs]es?/lgpl-2\.1")), ()),
    ("lgpl-3.0", r"lgpl-3\.0(?:-only|-or-later|\+)?", (("lesser", r"gnu~lesser~general~public~licen[cs]e,?~@~3(?:\.0)?"), ("lgpl", r"lgpl[ ,-]*v?3(?:\.0)?\b")),
     (("gnu.org", r"gnu\.org/licen[cs]es/lgpl-3\.0"), ("opensource.org", r"opensource\.org/licen[cs]es?/lgpl-3\.0")), ()),
    ("agpl-1.0", r"agpl-1\.0(?:-only|-or-later)?", (("affero", r"affero~general~public~licen[cs]e,?~@~1"),), (), ()),
    ("agpl-3.0", r"agpl-3\.0(?:-only|-or-later|\+)?", (("affero", r"(?:gnu~)?affero~general~public~licen[cs]e,?~@~3(?:\.0)?"), ("agpl", r"agpl[ ,-]*v?3(?:\.0)?\b")),
     (("gnu.org", r"gnu\.org/licen[cs]es/agpl-3\.0"),), ()),
    ("gfdl-1.1", r"gfdl-1\.1(?:-only|-or-later)?", (("documentation", r"gnu~free~documentation~licen[cs]e,?~@~1\.1"),), (), ()),
    ("gfdl-1.2", r"gfdl-1\.2(?:-only|-or-later)?", (("documentation", r"gnu~free~documentation~licen[cs]e,?~@~1\.2"),), (), ()),
    ("gfdl-1.3", r"gfdl-1\.3(?:-only|-or-later)?", (("documentation", r"gnu~free~documentation~licen[cs]e,?~@~1\.3"), ("gfdl", r"\bgfdl\b")), (("gnu.org", r"gnu\.org/licen[cs]es/fdl"),), ()),
    ("bsd-1-clause", r"bsd-1-clause", (("bsd", r"(?:1|one)[ -]clause~bsd(?:~licen[cs]e)?"),), (), ()),
    ("bsd-2-clause", r"bsd-2-clause", (("bsd", r"(?:2|two)[ -]clause~bsd(?:~licen[cs]e)?"), ("simplified", r"simplified~bsd(?:~licen[cs]e)?"), ("freebsd", r"freebsd~licen[cs]e")),
     (("opensource.org", r"opensource\.org/licen[cs]es?/bsd-2-clause"),), ()),
    ("bsd-3-clause", r"bsd-3-clause", (("bsd", r"(?:3|three)[ -]clause~bsd(?:~licen[cs]e)?"), ("bsd", r"(?:new|revised|modified)~bsd(?:~licen[cs]e)?|bsd~\(revised\)"), ("bsd", r"new~bsd~licen[cs]e")),
     (("opensource.org", r"opensource\.org/licen[cs]es?/bsd-3-clause"),),
     (("endorse", r"neither~the~name~of[\s\S]{1,120}?may~be~used~to~endorse~or~promote~products"),)),
    ("bsd-4-clause", r"bsd-4-clause", (("bsd", r"(?:4|four)[ -]clause~bsd(?:~licen[cs]e)?"), ("original", r"original~bsd~licen[cs]e")), (),
     (("advertising", r"all~advertising~materials~mentioning~features"),)),
    ("0bsd", r"0bsd", (("0bsd", r"\b0bsd\b"), ("zero", r"zero[ -]clause~bsd"), ("bsd", r"bsd~zero~clause~licen[cs]e")), (), ()),
    ("bsd", r"bsd", (("bsd", r"bsd(?:[ -]style)?~licen[cs]e"), ("berkeley", r"berkeley~software~distribution~licen[cs]e")), (),
     (("redistribution", r"redistribution~and~use~in~source~and~binary~forms"),)),
    ("isc", r"isc", (("isc", r"\bisc~licen[cs]e"),), (("opensource.org", r"opensource\.org/licen[cs]es?/isc"),),
     (("permission", r"permission~to~use,~copy,~modify,~and/or~distribute~this~software~for~any~purpose"),)),
    ("mpl-1.0", r"mpl-1\.0", (("mozilla", r"mozilla~public~licen[cs]e,?~(?:@~)?1\.0"), ("mpl", r"\bmpl[ -]?v?1\.0")), (), ()),
    ("mpl-1.1", r"mpl-1\.1", (("mozilla", r"mozilla~public~licen[cs]e,?~(?:@~)?1\.1"), ("mpl", r"\bmpl[ -]?v?1\.1")), (("mozilla.org", r"mozilla\.org/mpl/(?:mpl-)?1\.1"),), ()),
    ("mpl-2.0", r"mpl-2\.0(?:-no-copyleft-exception)?", (("mozilla", r"mozilla~public~licen[cs]e,?~(?:@~)?2\.0"), ("mpl", r"\bmpl[ -]?v?2(?:\.0)?")), (("mozilla.org", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),),
     (("source", r"this~source~code~form~is~subject~to~the~terms~of~the~mozilla~public~licen[cs]e"),)),
    ("epl-1.0", r"epl-1\.0", (("eclipse", r"eclipse~public~licen[cs]e,?~(?:-~)?(?:@~)?1\.0"), ("epl", r"\bepl[ -]?v?1\.0")), (("eclipse.org", r"eclipse\.org/legal/epl-v10"),), ()),
    ("epl-2.0", r"epl-2\.0", (("eclipse", r"eclipse~public~licen[cs]e,?~(?:-~)?(?:@~)?2\.0"), ("epl", r"\bepl[ -]?v?2\.0")), (("eclipse.org", r"eclipse\.org/legal/epl-(?:v)?2\.?0"),), ()),
    ("edl-1.0", r"bsd-3-clause-eclipse", (("eclipse", r"eclipse~distribution~licen[cs]e"),), (("eclipse.org", r"eclipse\.org/org/documents/edl-v10"),), ()),
    ("cddl-1.0", r"cddl-1\.0", (("cddl", r"\bcddl(?:[ -]?v?1\.0)?\b"), ("distribution", r"common~development~and~distribution~licen[cs]e(?:,?~@~1\.0)?")), (), ()),
    ("cddl-1.1", r"cddl-1\.1", (("cddl", r"\bcddl[ -]?v?1\.1"),), (), ()),
    ("cpl-1.0", r"cpl-1\.0", (("common", r"common~public~licen[cs]e"),), (), ()),
    ("ipl-1.0", r"ipl-1\.0", (("ibm", r"ibm~public~licen[cs]e"),), (), ()),
    ("artistic-1.0", r"artistic-1\.0(?:-perl|-cl8)?", (("artistic", r"artistic~licen[cs]e,?~(?:@~)?1\.0"),), (), ()),
    ("artistic-2.0", r"artistic-2\.0", (("artistic", r"artistic~licen[cs]e,?~(?:@~)?2\.0"),), (("opensource.org", r"opensource\.org/licen[cs]es?/artistic-2\.0"),), ()),
    ("zlib", r"zlib", (("zlib", r"zlib(?:/libpng)?~licen[cs]e"),), (("opensource.org", r"opensource\.org/licen[cs]es?/zlib"),),
     (("misrepresented", r"the~origin~of~this~software~must~not~be~misrepresented"),)),
    ("libpng", r"libpng(?:-2\.0)?", (("libpng", r"libpng~licen[cs]e"),), (), ()),
    ("bsl-1.0", r"bsl-1\.0", (("boost", r"boost~software~licen[cs]e(?:,?~(?:-~)?@~1\.0)?"),), (("boost.org", r"boost\.org/license_1_0"),), ()),
    ("busl-1.1", r"busl-1\.1", (("business", r"business~source~licen[cs]e(?:~1\.1)?"),), (("mariadb.com", r"mariadb\.com/bsl11"),), ()),
    ("unlicense", r"unlicense", (("unlicense", r"\bthe~unlicense\b|\bunlicense\b"),), (("unlicense.org", r"unlicense\.org"),),
     (("unencumbered", r"this~is~free~and~unencumbered~software~released~into~the~public~domain"),)),
    ("wtfpl", r"wtfpl", (("wtfpl", r"\bwtfpl\b"), ("fuck", r"do~what~the~fuck~you~want~to~public~licen[cs]e")), (("wtfpl.net", r"wtfpl\.net"),), ()),
    ("beerware", r"beerware", (("beer", r"beer-?ware~licen[cs]e"),), (), ()),
    ("ncsa", r"ncsa", (("ncsa", r"(?:university~of~illinois/)?ncsa~open~source~licen[cs]e"),), (), ()),
    ("psf-2.0", r"psf-2\.0|python-2\.0", (("python", r"python~software~foundation~licen[cs]e"), ("psf", r"\bpsf~licen[cs]e")), (), ()),
    ("php-3.01", r"php-3\.01", (("php", r"\bphp~licen[cs]e(?:,?~@~3\.01)?"),), (("php.net", r"php\.net/license/3_01"),), ()),
    ("ruby", r"ruby", (("ruby", r"\bruby(?:'s)?~licen[cs]e"),), (), ()),
    ("openssl", r"openssl", (("openssl", r"openssl~(?:and~ssleay~)?licen[cs]e"),), (), ()),
    ("curl", r"curl", (("curl", r"\bcurl~licen[cs]e"),), (), ()),
    ("postgresql", r"postgresql", (("postgresql", r"postgresql~licen[cs]e"),), (), ()),
    ("eupl-1.1", r"eupl-1\.1", (("eupl", r"\beupl[ -]?(?:v\.?~?)?1\.1"),), (), ()),
    ("eupl-1.2", r"eupl-1\.2", (("eupl", r"\beupl(?:[ -]?(?:v\.?~?)?1\.2)?\b"), ("european", r"european~union~public~licen[cs]e")), (), ()),
    ("osl-3.0", r"osl-3\.0", (("open", r"open~software~licen[cs]e(?:,?~@~3\.0)?"),), (), ()),
    ("afl-3.0", r"afl-3\.0", (("academic", r"academic~free~licen[cs]e(?:,?~@~3\.0)?"),), (), ()),
    ("ms-pl", r"ms-pl", (("microsoft", r"microsoft~public~licen[cs]e"), ("ms-pl", r"\bms-pl\b")), (), ()),
    ("ms-rl", r"ms-rl", (("microsoft", r"microsoft~reciprocal~licen[cs]e"), ("ms-rl", r"\bms-rl\b")), (), ()),
    ("ofl-1.1", r"ofl-1\.1", (("font", r"(?:sil~)?open~font~licen[cs]e(?:,?~@~1\.1)?"),), (("scripts.sil.org", r"scripts\.sil\.org/ofl"),), ()),
    ("odbl-1.0", r"odbl-1\.0", (("database", r"open~(?:data~commons~open~)?database~licen[cs]e"), ("odbl", r"\bodbl\b")), (("opendatacommons.org", r"opendatacommons\.org/licen[cs]es/odbl"),), ()),
    ("odc-by-1.0", r"odc-by-1\.0", (("odc", r"\bodc-by\b"), ("attribution", r"open~data~commons~attribution~licen[cs]e")), (("opendatacommons.org", r"opendatacommons\.org/licen[cs]es/by"),), ()),
    ("pddl-1.0", r"pddl-1\.0", (("pddl", r"\bpddl\b"), ("dedication", r"public~domain~dedication~and~licen[cs]e")), (("opendatacommons.org", r"opendatacommons\.org/licen[cs]es/pddl"),), ()),
    ("sspl-1.0", r"sspl-1\.0", (("sspl", r"\bsspl\b"), ("server", r"server~side~public~licen[cs]e")), (), ()),
    ("elastic-2.0", r"elastic-2\.0", (("elastic", r"elastic~licen[cs]e(?:~2\.0)?"),), (), ()),
    ("openrail-m", r"openrail-m", (("openrail", r"\bopenrail(?:-m|\+\+-m|-s)?\b"),), (), ()),
    ("llvm-exception", r"llvm-exception", (("llvm", r"llvm~exceptions?"),), (), ()),
    ("cc0-1.0", r"cc0-1\.0", (("cc0", r"\bcc0(?:[ -]1\.0)?\b"), ("zero", r"creative~commons~zero")), (("creativecommons.org", r"creativecommons\.org/publicdomain/zero"),), ()),
    ("public-domain", r"public-domain", (("domain", r"(?:in|into|to)~the~public~domain"), ("domain", r"public~domain~mark")), (("creativecommons.org", r"creativecommons\.org/publicdomain/mark"),), ()),
    *(
        (f"cc-{parts}-{version}", rf"cc-{parts}-{version.replace('.', chr(92) + '.')}",
         (("cc", rf"\bcc[ -]{parts.replace('-', '[ -]')}[ -]v?{version.replace('.', chr(92) + '.')}"),),
         (("creativecommons.org", rf"creativecommons\.org/licen[cs]es/{parts}/{version.replace('.', chr(92) + '.')}"),), ())
        for parts in ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
        for version in ("2.0", "2.5", "3.0", "4.0")
    ),
    ("cc-by", r"cc-by", (("attribution", r"creative~commons~attribution(?:~(?:[1-4]\.[05])?~?(?:international|unported)?~?licen[cs]e)?"), ("cc", r"\bcc[ -]by\b")), (), ()),
    ("cc-by-sa", r"cc-by-sa", (("share", r"creative~commons~attribution[ -]share-?alike"), ("share", r"creative~commons~attribution[ -]share[ -]alike"), ("cc", r"\bcc[ -]by[ -]sa\b")), (), ()),
    ("cc-by-nd", r"cc-by-nd", (("noderiv", r"creative~commons~attribution[ -]noderiv(?:ative)?s"), ("cc", r"\bcc[ -]by[ -]nd\b")), (), ()),
    ("cc-by-nc", r"cc-by-nc", (("noncommercial", r"creative~commons~attribution[ -]noncommercial"), ("cc", r"\bcc[ -]by[ -]nc\b")), (), ()),
    ("cc-by-nc-sa", r"cc-by-nc-sa", (("noncommercial", r"creative~commons~attribution[ -]noncommercial[ -]share-?alike"), ("cc", r"\bcc[ -]by[ -]nc[ -]sa\b")), (), ()),
    ("cc-by-nc-nd", r"cc-by-nc-nd", (("noncommercial", r"creative~commons~attribution[ -]noncommercial[ -]noderiv(?:ative)?s"), ("cc", r"\bcc[ -]by[ -]nc[ -]nd\b")), (), ()),
    ("apache", r"apache", (("apache", r"apache~(?:software~)?licen[cs]e"),), (), ()),
    ("gpl", r"gpl", (("gnu", r"gnu~general~public~licen[cs]e"), ("gnu", r"gnu~gpl\b")), (("gnu.org", r"gnu\.org/licen[cs]es/gpl(?:\.html)?"),), ()),
    ("lgpl", r"lgpl", (("lesser", r"gnu~lesser~general~public~licen[cs]e"), ("lgpl", r"\b(?:gnu~)?lgpl\b")), (), ()),
    ("agpl", r"agpl", (("affero", r"(?:gnu~)?affero~general~public~licen[cs]e"), ("agpl", r"\b(?:gnu~)?agpl\b")), (), ()),
    ("mpl", r"mpl", (("mozilla", r"mozilla~public~licen[cs]e"),), (), ()),
    ("epl", r"epl", (("eclipse", r"eclipse~public~licen[cs]e"),), (), ()),
    ("artistic", r"artistic", (("artistic", r"\bartistic~licen[cs]e"),), (), ()),
    ("proprietary", r"licenseref-proprietary", (), (),
     (("unauthori", r"unauthori[sz]ed~(?:copying|use|reproduction)~[\s\S]{0,60}?~?(?:is~)?strictly~prohibited"),
      ("confidential", r"(?:proprietary~and~confidential|confidential~and~proprietary)"))),
)

#: Tiers, strongest first: identifier tags, telling phrases and addresses, grants by name, names,
#: bare notices. The numbers are the scores of what they find.
TAG, TEXT, GRANT, NAME, NOTICE = 1, 2, 3, 4, 5
SCORES = {TAG: 1.0, TEXT: 0.95, GRANT: 0.9, NAME: 0.7, NOTICE: 0.3}


@dataclass(frozen=True)
class Rule:
    label: str
    tier: int
    keyword: str
    pattern: str


def spelled(form: str) -> str:
    return form.replace("~", GAP).replace("@", V)


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules, strongest first; their order decides between equal intervals of one tier."""
    found = []
    for label, tag, names, addresses, phrases in LICENCES:
        ends = r"(?![a-z0-9.+-]*[a-z0-9+])"
        found.append(Rule(label, TAG, "spdx-license-identifier", rf"spdx-license-identifier:\s*(?:{tag}){ends}"))
        found += [Rule(label, TEXT, keyword, spelled(form)) for keyword, form in (*addresses, *phrases)]
        for keyword, form in names:
            found.append(
                Rule(label, GRANT, keyword, spelled(rf"(?:licensed|released|distributed|available|published|provided)~under~(?:the~)?(?:terms~of~the~)?(?:{form})"))
            )
            found.append(Rule(label, NAME, keyword, rf"(?<![a-z0-9])(?:{spelled(form)})"))
    notices = (
        ("all-rights-reserved", "reserved", r"all~rights~reserved"),
        ("copyright", "copyright", r"copyright~(?:\(c\)|©)?~?(?:19|20)[0-9]{2}"),
        ("unnamed-licence", "licen", r"licen[cs]ed~under"),
    )
    found += [Rule(label, NOTICE, keyword, spelled(form)) for label, keyword, form in notices]
    return tuple(sorted(found, key=lambda rule: rule.tier))
