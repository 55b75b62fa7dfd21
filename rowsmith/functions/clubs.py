"""Canonical forms of club names and domains."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from rowsmith import config as C
from rowsmith.functions.text import among, joined, squeeze, strip, text, tokens

# Legal forms found in company names, longer phrases first.
LEGAL_FORMS = [
    r"\bsociedad\s+anonima\s+deportiva\b", r"\bsocieta\s+sportiva\s+dilettantistica\b", r"\bfootball\s+and\s+athletic\s+co\s+ltd\b", r"\bfootball\s+club\s+limited\b",
    r"\bs\s*p\s*a\b", r"\bs\s*r\s*l\b", r"\bs\s*a\s*s\b", r"\bs\s*a\s*d\b", r"\bs\s*l\s*u\b", r"\bsa\b", r"\bag\b", r"\bgmbh\b", r"\be\s*v\b", r"\bkg\b", r"\bco\s+ltd\b",
    r"\blimited\b", r"\bltd\b", r"\bcompany\b", r"\bclub\b(?=\s+atletico|\s+atlético)",
]
# Signs and what stands for them.
SIGNS = [(r"^the\b", ""), ("&", "and"), ("[-–—/]", " "), ("['’.,]", "")]


def strip_invisible(c: Column) -> Column:
    """Without format characters: zero-width signs, byte order marks, soft hyphens."""
    return F.regexp_replace(text(c), r"\p{Cf}", "")


def _decomposed(x: str) -> str:
    return "".join(ch for ch in unicodedata.normalize("NFKD", x) if not unicodedata.combining(ch))


#: Latin letters and signs that decompose to one ASCII character, and those characters.
_FROM = "".join(chr(i) for i in range(0x80, 0x250) if len(d := _decomposed(chr(i))) == 1 and d.isascii())
_TO = "".join(map(_decomposed, _FROM))


@pandas_udf(StringType())
def _folded(s: pd.Series) -> pd.Series:
    return s.map(_decomposed, na_action="ignore")


def fold(c: Column) -> Column:
    """Compatibility decomposition without combining marks. Texts that single letters make ASCII are done with in the JVM;
    only what is left then, as other scripts and combining marks, is handed to Python."""
    plain = F.translate(text(c), _FROM, _TO)
    rest = plain.rlike(r"[^\x00-\x7F]")
    return F.when(rest, _folded(F.when(rest, text(c)))).otherwise(plain)


def normalise_club(c: Column, extra: list[tuple[str, str]] = (), folded: bool = True) -> Column:
    s = strip_invisible(c)
    s = F.lower(fold(s) if folded else s)
    for pattern, by in SIGNS:
        s = F.regexp_replace(s, "(?U)" + pattern, by)
    for pattern in LEGAL_FORMS:
        s = F.regexp_replace(s, "(?U)" + pattern, "")
    for pattern, by in extra:
        s = F.regexp_replace(s, "(?iU)" + pattern, by)
    return squeeze(s)


def prefix_first(norm: Column) -> Column:
    """Known club prefixes moved to the front, each side in its own order."""
    known = among(C.CLUB_PREFIXES)
    t = tokens(norm)
    return joined(F.concat(F.filter(t, lambda x: F.array_contains(known, x)), F.filter(t, lambda x: ~F.array_contains(known, x))))


def close(a: Column, b: Column) -> Column:
    """Equal, or both of 8 letters or more and one edit apart (two if the shorter one has 12)."""
    la, lb = F.length(a), F.length(b)
    most = F.when(F.least(la, lb) >= 12, 2).otherwise(1)
    distance = F.levenshtein(a, b, 2)
    return (a == b) | ((la >= 8) & (lb >= 8) & (F.abs(la - lb) <= 2) & (distance >= 0) & (distance <= most))


def clean_domain(c: Column) -> Column:
    """Host without scheme, user, port, path, leading dot and www."""
    d = F.lower(strip(c))
    url = d.rlike("^https?://")
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(d, "^https?://", ""), r"[/?#].*$", ""), r"^[^@]*@|:\d*$", "")
    bare = F.regexp_replace(F.regexp_replace(d, r"^\.+", ""), "/.*$", "")
    s = F.when(url, F.regexp_replace(host, r"^\.+", "")).otherwise(bare)
    return F.regexp_replace(s, r"^www\.", "")


def domain_suffixes(domain: Column) -> Column:
    """The domain and all its parent domains: a equals b or is below it exactly if b is among a's."""
    labels = F.split(domain, r"\.")
    return F.when(domain != "", F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).otherwise(F.expr("cast(array() as array<string>)"))


def domains_match(a: Column, b: Column) -> Column:
    under = lambda x, y: F.endswith(x, F.concat(F.lit("."), y))
    return (a != "") & (b != "") & ((a == b) | under(a, b) | under(b, a))
