"""Canonical forms of names, as Column expressions that stay inside the JVM.

Patterns use Unicode classes ((?U)) so that white space and word edges mean what they
mean for any script. Canonical strings are never null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowsmith import config as C

SPACE = r"(?U)\s+"


def text(c: Column) -> Column:
    """Null as empty."""
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    """Without white space at the ends."""
    return F.regexp_replace(text(c), r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(text(c), SPACE, " "))


def tokens(c: Column) -> Column:
    """Words of a squeezed string; the empty string has none."""
    return F.filter(F.split(c, " "), lambda t: t != "")


def joined(words: Column) -> Column:
    return F.array_join(words, " ")


def among(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def mapped(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def _replace(c: Column, *steps: tuple[str, str]) -> Column:
    for pattern, by in steps:
        c = F.regexp_replace(c, pattern, by)
    return c


# Abbreviations and spellings in league names, in the order in which they are replaced.
LEAGUE_SPELLINGS = [
    (r"(?U)\bconf\.\s*$", "conference"), (r"(?U)\bconf\b", "conference"), (r"(?U)\bconferences\b", "conference"), (r"(?U)\bleagues\b", "league"),
    (r"(?U)\bassoc\.\b", "association"), (r"(?U)\bassocs\b", "association"), (r"(?U)\bath\.\b", "athletic"), (r"(?U)\bath\b", "athletic"),
    (r"(?U)\bintercol\.\b", "intercollegiate"), (r"(?U)\bdiv\.\b", "division"), (r"(?U)\bnatl\.\b", "national"),
]


def normalise_league(c: Column) -> Column:
    """Trailing parenthesis, leading article, abbreviations, punctuation and number words made uniform."""
    s = F.lower(strip(_replace(strip(c), (r"(?U)\s*\([^)]*\)\s*$", ""))))
    s = _replace(s, (r"(?U)^the\s+", ""), ("&", "and"))
    s = _replace(s, *LEAGUE_SPELLINGS)
    s = _replace(s, (r"[-.,]", " "), (r"(?U)(?<=[a-z])(?=\d)|(?<=\d)(?=[a-z])", " "))
    numbers = mapped(C.NUMBER_WORDS)
    return joined(F.transform(tokens(squeeze(s)), lambda t: F.coalesce(numbers[t], t)))


def strip_sport_division(c: Column) -> Column:
    """Lower case without sport, gender and division words; the cleaned original if nothing else is left."""
    whole = squeeze(_replace(F.lower(text(c)), ("&", " and "), (r"[-.,]", " ")))
    s = _replace(whole, (r"(?U)\bd\s?(?:1|2|3|iii|ii|i)\b", " "), (r"(?U)\b(?:naia|njcaa|juco)\b", " "), (r"(?U)\b(?:men'?s|women'?s|m and w|mens|womens)\b", " "))
    sports = among(C.SPORT_TOKENS)
    left = joined(F.filter(tokens(squeeze(s)), lambda t: ~F.array_contains(sports, t)))
    return F.when(left != "", left).otherwise(whole)


def paren(c: Column) -> Column:
    """What a trailing parenthesis holds, or empty."""
    return strip(F.regexp_extract(text(c), r"(?U)\(([^)]+)\)\s*$", 1))


def acronym(c: Column, least: int = 2) -> Column:
    """A trailing parenthesis of ``least`` to 12 characters, in lower case, or empty."""
    inner = paren(c)
    return F.when((F.length(inner) >= least) & (F.length(inner) <= 12), F.lower(inner)).otherwise("")


def significant_words(norm: Column, stopwords: list[str] = C.LEAGUE_STOPWORDS) -> Column:
    """Distinct words of more than two letters that aren't filler."""
    stop = among(stopwords)
    return F.array_distinct(F.filter(tokens(norm), lambda t: (F.length(t) > 2) & ~F.array_contains(stop, t)))


def core(norm: Column, generic: list[str] = C.TYPE_TOKENS) -> Column:
    """Without generic type words."""
    drop = among(generic)
    return joined(F.filter(tokens(norm), lambda t: ~F.array_contains(drop, t)))


def spaceless(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit(""))


def _first_letters(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda t: F.left(t, F.lit(1))), "")


def trailing_acronym(norm: Column) -> Column:
    """Struct (base, acronym): a name's last word split off if it spells the initials of the words before it."""
    t = tokens(norm)
    base = F.slice(t, 1, F.greatest(F.size(t) - 1, F.lit(0)))
    last = F.element_at(t, -1)
    skip = among(C.ACRONYM_CONNECTORS)
    plain = _first_letters(base)
    significant = _first_letters(F.filter(base, lambda w: ~F.array_contains(skip, w)))
    fits = (F.size(t) >= 3) & F.length(last).between(2, 6) & last.rlike(r"(?U)^\p{L}+$") & ((last == plain) | (last == significant))
    return F.struct(F.when(fits, joined(base)).otherwise(norm).alias("base"), F.when(fits, last).otherwise("").alias("acronym"))


def initials(c: Column) -> Column:
    """First letters and digits of a name's words, without small words."""
    skip = among(C.INITIAL_STOPWORDS)
    kept = F.filter(tokens(normalise_league(c)), lambda t: ~F.array_contains(skip, t))
    return F.array_join(F.filter(F.transform(kept, lambda t: F.left(t, F.lit(1))), lambda x: x.rlike(r"(?U)[\p{L}\p{N}]")), "")


def division(c: Column) -> Column:
    """d1, d2, d3, naia, njcaa or empty."""
    found = _replace(F.regexp_extract(F.lower(text(c)), r"(?U)\b(d\s*-?\s*(?:iii|ii|i|[123])|naia|njcaa)\b", 1), (r"(?U)[\s-]", ""))
    return F.when(found == "diii", "d3").when(found == "dii", "d2").when(found == "di", "d1").otherwise(found)


def contains_words(outer: Column, inner: Column) -> Column:
    """Whether single-spaced ``inner`` stands in ``outer`` at word edges."""
    pad = lambda x: F.concat(F.lit(" "), x, F.lit(" "))
    return F.contains(pad(outer), pad(inner))


def token_run(needle: Column, hay: Column) -> Column:
    """Whether the words of ``needle`` stand in ``hay`` one after another."""
    return (needle != "") & contains_words(hay, needle)


def overlap_ratio(a: Column, b: Column) -> Column:
    """Common words over the larger set's size; 0 if either is empty."""
    both = (F.size(a) > 0) & (F.size(b) > 0)
    return F.when(both, F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.size(b))).otherwise(F.lit(0.0))


def acronym_safe(name: Column, norm: Column, words: Column, stopwords: list[str] = C.LEAGUE_STOPWORDS) -> Column:
    """Whether an acronym hit may stand: a short name in capitals, or more than half of the smaller word set in common."""
    base = strip(_replace(text(name), (r"(?U)\s*\([^)]*\)\s*$", "")))
    capital = (F.upper(base) == base) & (F.lower(base) != base) & (F.length(base) <= 6)
    own = significant_words(norm, stopwords)
    common = F.size(F.array_intersect(own, words))
    some = (F.size(own) > 0) & (F.size(words) > 0)
    return capital | (some & (common > F.least(F.size(own), F.size(words)) * 0.5))


# Patterns of names that are no entities.
JUNK = [
    r"\bmen'?s\s+soccer\b", r"\bwomen'?s\s+soccer\b", r"\bmen'?s\s+lacrosse\b", r"\bwomen'?s\s+lacrosse\b", r"\bmen'?s\s+hockey\b", r"\bwomen'?s\s+hockey\b",
    r"\bmen'?s\s+basketball\b", r"\bwomen'?s\s+basketball\b", r"^test\b", r"\bmerge\b", r"\bdelete\b", r"^deal\s+done\b", r"^abcx$", r"^sport$", r"^pobox$",
]


def junk_reason(c: Column) -> Column:
    """Why a name is no entity, or null."""
    name = text(c)
    reason = F.when(strip(name) == "", "empty name")
    for p in JUNK:
        reason = reason.when(name.rlike("(?iU)" + p), f"matches junk pattern: {p}")
    return reason.when(F.length(strip(name)) <= 2, F.concat(F.lit("too-short name: "), strip(name)))


def slug(c: Column) -> Column:
    return _replace(F.lower(text(c)), (r"[^a-z0-9]+", "-"), (r"^-+|-+$", ""))


def split_name(c: Column, repeat_single: bool = False) -> Column:
    """Struct (first, last); a single word is repeated as the last name or leaves it empty."""
    t = tokens(squeeze(c))
    rest = joined(F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))))
    first = F.coalesce(F.get(t, F.lit(0)), F.lit(""))
    return F.struct(first.alias("first"), F.when(F.size(t) == 1, first if repeat_single else F.lit("")).otherwise(rest).alias("last"))


def email_domain(c: Column) -> Column:
    e = text(c)
    return F.when(F.contains(e, F.lit("@")), F.lower(strip(F.element_at(F.split(e, "@"), -1)))).otherwise("")


def record_id(c: Column) -> Column:
    """A bare 15 or 18 character id, the one in a record's address, or the text unchanged."""
    s = strip(c)
    inside = F.regexp_extract(s, r"(?:^|/)([A-Za-z0-9]{18}|[A-Za-z0-9]{15})(?=/|\?|#|$)", 1)
    return F.when(inside != "", inside).otherwise(s)


def sheet_id(c: Column) -> Column:
    """The document id of a sheet's address, or the text as it is."""
    s = strip(c)
    inside = F.regexp_extract(s, r"/d/([A-Za-z0-9_-]+)", 1)
    return F.when(inside != "", inside).otherwise(s)


def record_url(base: str, sobject: str, ident: Column) -> Column:
    return F.concat(F.lit(f"{base.rstrip('/')}/lightning/r/{sobject}/"), ident, F.lit("/view"))


def escaped(c: Column) -> Column:
    """Double quotes escaped for a quoted query value."""
    return F.replace(text(c), F.lit('"'), F.lit('\\"'))


def gender_of(config_id: Column) -> Column:
    s = F.lower(text(config_id))
    return F.when(s.rlike(r"women|female|girls"), "Womens").when(s.rlike(r"(^|[^a-z])(men|mens|male|boys)([^a-z]|$)"), "Mens").otherwise("")


def truthy(c: Column) -> Column:
    return F.lower(strip(c)).isin("yes", "true", "1", "y")
