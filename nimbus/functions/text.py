"""Column -> Column text functions: ratings, HTML to text, dates in questions."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fixed value: a stand-alone digit 1..5, with Unicode word boundaries as in Python's re.
RATING_PATTERN = r"(?U)\b([1-5])\b"


def rating(text: Column | str) -> Column:
    """the first stand-alone digit 1..5 of an answer text -> int, else null.
    "5 - good" -> 5, "a 3/5" -> 3, "score 10" -> null, "é5" -> null."""
    v = _col(text)
    return F.nullif(F.regexp_extract(v, RATING_PATTERN, 1), F.lit("")).try_cast("int")


def rating_numeric(value: Column | str) -> Column:
    """F11 for numeric answers: truncated to int, no 1..5 check."""
    return _col(value).try_cast("double").try_cast("int")


# HTML parts removed with their content, then tags; applied in order. A tag ends at the
# first > outside quotes, or, where quotes do not close, at the first > at all.
HTML_DROP_PATTERNS = [
    r"(?is)<script\b[^>]*>.*?</script\s*>",
    r"(?is)<style\b[^>]*>.*?</style\s*>",
    r"(?is)<template\b[^>]*>.*?</template\s*>",
    r"(?s)<!--.*?-->",
    r"(?s)<![^>]*>",
    r"(?s)<\?[^>]*>",
    r"""(?s)</?[a-zA-Z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>""",
    r"(?s)</?[a-zA-Z][^>]*>",
]


def character_references() -> dict[str, str]:
    """What a reference's name stands for: the named ones of HTML 4 and apos, and the numbers
    128-159, which mean the characters of Windows-1252 (all from Python's own tables)."""
    named = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"}
    old = {f"#{code}": bytes([code]).decode("cp1252", "ignore") or chr(code) for code in range(128, 160)}
    return named | old


_REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);"


def _referred(name: Column) -> Column:
    """The character of a reference's name (null: no such reference). Numbers that are no character give U+FFFD."""
    table = F.create_map(*[F.lit(x) for pair in character_references().items() for x in pair])
    digits = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 6), 16, 10)).when(name.startswith("#"), F.substring(name, 2, 7))
    code = digits.cast("int")
    odd = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    old = F.when(code.between(128, 159), F.try_element_at(table, F.concat(F.lit("#"), code.cast("string"))))
    valid = F.when(odd, F.lit(0x20)).otherwise(code)
    number = F.when(odd, F.lit("\ufffd")).otherwise(F.coalesce(old, F.decode(F.unhex(F.lpad(F.hex(valid), 8, "0")), "UTF-32")))
    return F.when(name.startswith("#"), number).otherwise(F.try_element_at(table, name))


def decode_references(text: Column | str) -> Column:
    """Character references decoded in one pass: the text is cut at every &, and what follows it up
    to a semicolon is looked up once. Each is decoded once (``&amp;lt;`` gives ``&lt;``); an unknown
    or unfinished one stays as it is."""
    c = _col(text)

    def piece(p: Column, at: Column) -> Column:
        name = F.regexp_extract(p, _REFERENCE, 1)
        found = F.when(name != "", _referred(name))
        known = F.concat(found, F.substr(p, F.length(name) + 2))
        return F.when(at == 0, p).otherwise(F.coalesce(known, F.concat(F.lit("&"), p)))

    # texts without a reference are left alone
    return F.when(c.contains("&"), F.array_join(F.transform(F.split(c, "&"), piece), "")).otherwise(c)


def html_to_text(html: Column | str) -> Column:
    """HTML -> plain text. Script, style and template bodies, comments,
    declarations and tags go (replaced by nothing), whatever their attributes hold in quotes;
    named and numeric character references are decoded. No white-space collapsing. Native, no Python."""
    c = _col(html)
    for pat in HTML_DROP_PATTERNS:
        c = F.regexp_replace(c, pat, "")
    return decode_references(c)


# English month names and ordinal words for days.
MONTHS = [
    "January", "February", "March", "April", "May", "June", "July", "August",
    "September", "October", "November", "December",
]
_MONTH_ALT = "|".join(MONTHS)
ORDINAL_WORDS = [
    "first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth",
    "eleventh", "twelfth", "thirteenth", "fourteenth", "fifteenth", "sixteenth", "seventeenth",
    "eighteenth", "nineteenth", "twentieth", "twenty-first", "twenty-second", "twenty-third",
    "twenty-fourth", "twenty-fifth", "twenty-sixth", "twenty-seventh", "twenty-eighth",
    "twenty-ninth", "thirtieth", "thirty-first",
]
_ORD_ALT = "|".join(sorted(ORDINAL_WORDS, key=len, reverse=True))

# Patterns (case-insensitive) of the date forms found in questions.
P_MONTH_DAY_YEAR = rf"(?i)\b({_MONTH_ALT})\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})\b"
P_COMPACT = r"\b((?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01]))\b"
P_ISO = r"\b(\d{4}-\d{2}-\d{2})\b"
P_ORDINAL_OF = rf"(?i)\b({_ORD_ALT})(?:\s+day)?\s+of\s+({_MONTH_ALT}),?\s+(\d{{4}})\b"
P_MONTH_YEAR = rf"(?i)\b({_MONTH_ALT}),?\s+(\d{{4}})\b"


def _parse_mdy(match: Column) -> Column:
    """'july 10th, 2023' (any case, ordinal suffix, optional comma) -> DATE."""
    t = F.regexp_replace(match, r"(?i)(\d)(st|nd|rd|th)\b", "$1")
    t = F.regexp_replace(t, r"[,\s]+", " ")
    return F.try_to_date(F.nullif(F.initcap(F.trim(t)), F.lit("")), "MMMM d yyyy")


def _parse_ordinal(match: Column) -> Column:
    """'first (day) of January, 2023' -> DATE."""
    word = F.lower(F.regexp_extract(match, r"^(\S+)", 1))
    day = F.array_position(F.array(*[F.lit(w) for w in ORDINAL_WORDS]), word)
    rest = F.regexp_extract(match, r"(?i)of\s+(.*)$", 1)
    rest = F.regexp_replace(rest, r"[,\s]+", " ")
    text = F.concat_ws(" ", F.initcap(F.split_part(F.trim(rest), F.lit(" "), F.lit(1))), F.nullif(day, F.lit(0)).cast("string"),
                       F.split_part(F.trim(rest), F.lit(" "), F.lit(2)))
    return F.try_to_date(F.nullif(text, F.lit("")), "MMMM d yyyy")


# Staging columns: the raw match of each form, computed once per question.
MATCH_COLUMNS = ["_q_mdy", "_q_compact", "_q_iso", "_q_ord", "_q_month"]


def date_matches(q: Column) -> dict[str, Column]:
    """One regex evaluation per date form (the matched text, '' when absent)."""
    return {
        "_q_mdy": F.regexp_extract(q, P_MONTH_DAY_YEAR, 0),
        "_q_compact": F.regexp_extract(q, P_COMPACT, 1),
        "_q_iso": F.regexp_extract(q, P_ISO, 1),
        # the ordinal form needs the word 'of': skip its 31-way alternation otherwise
        "_q_ord": F.when(F.lower(q).contains(" of "), F.regexp_extract(q, P_ORDINAL_OF, 0)).otherwise(F.lit("")),
        "_q_month": F.regexp_extract(q, P_MONTH_YEAR, 0),
    }


def _when_found(match: str, parse: Callable[[Column], Column]) -> Column:
    """``parse`` of a match, if there is one. It stands in a lambda: in the projection's generated code the
    parsing of all forms makes a method of over 8,000 bytes, which the JVM does not compile."""
    return F.when(F.col(match) != "", F.transform(F.array(match), parse)[0])


def date_from_matches() -> Column:
    """Parse only the forms that matched (most questions match one or none)."""
    return F.coalesce(
        _when_found("_q_mdy", _parse_mdy),
        _when_found("_q_compact", lambda m: F.try_to_date(m, "yyyyMMdd")),
        _when_found("_q_iso", lambda m: F.try_to_date(m, "yyyy-MM-dd")),
        _when_found("_q_ord", _parse_ordinal),
    )


def month_from_matches() -> Column:
    """The first day of the month that matched."""
    return _when_found("_q_month", lambda m: F.try_to_date(F.nullif(F.initcap(F.trim(F.regexp_replace(m, r"[,\s]+", " "))), F.lit("")), "MMMM yyyy"))


def question_date(q: Column | str) -> Column:
    """the date named in a free question, or null.

    Forms: 'July 10, 2023', 'June 1st, 2023', '20230913', '2023-09-13',
    'first (day) of January, 2023'. The first form that matches wins, in that
    order. (For many questions prefer ``routing.with_question_dates``, which
    stages the matches so each pattern runs once.)
    """
    c = _col(q)
    m = date_matches(c)
    return F.coalesce(
        _parse_mdy(m["_q_mdy"]),
        F.try_to_date(F.nullif(m["_q_compact"], F.lit("")), "yyyyMMdd"),
        F.try_to_date(F.nullif(m["_q_iso"], F.lit("")), "yyyy-MM-dd"),
        _parse_ordinal(m["_q_ord"]),
    )


def question_month(q: Column | str) -> Column:
    """F20, month only ('February, 2023'): struct(month_start, month_end), or null."""
    c = _col(q)
    start = F.try_to_date(
        F.nullif(F.initcap(F.trim(F.regexp_replace(F.regexp_extract(c, P_MONTH_YEAR, 0), r"[,\s]+", " "))), F.lit("")),
        "MMMM yyyy",
    )
    return F.when(start.isNotNull(), F.struct(start.alias("month_start"), F.last_day(start).alias("month_end")))


# --- names inside free text -----------------------------------------------------------

def name_key(c: Column | str) -> Column:
    """A name as it is compared: lower case, blanks collapsed."""
    return F.lower(F.trim(F.regexp_replace(_col(c), r"\s+", " ")))


def names_pattern(names: list[str], plural: bool = False) -> str:
    """One regular expression for many names, case-insensitive, at word boundaries.

    The names are folded into a tree by their common beginnings, so a text position is
    given up at the first letter no name goes on with, however many names there are, and
    the longest name wins. Blanks in a name match any white space; ``plural`` lets an s follow.
    """
    tree: dict = {}
    for name in names:
        at = tree
        for ch in " ".join(name.lower().split()):
            at = at.setdefault(ch, {})
        at[""] = {}

    def letter(ch: str) -> str:
        return r"\s+" if ch == " " else ch if ch.isalnum() else "\\" + ch

    def write(at: dict) -> str:
        branches = [letter(ch) + write(below) for ch, below in sorted(at.items()) if ch]
        if not branches:
            return ""
        body = branches[0] if len(branches) == 1 and "" not in at else "(?:" + "|".join(branches) + ")"
        return body + "?" if "" in at else body

    body = write(tree)
    if not body:
        return r"(?!)"
    return rf"(?iu)(?<![\p{{L}}\p{{N}}]){body}{'s?' if plural else ''}(?![\p{{L}}\p{{N}}])"


def names_in(text: Column | str, names: list[str], plural: bool = False) -> Column:
    """The distinct ``names`` (as ``name_key`` gives them) found in a text, in order of appearance."""
    found = F.regexp_extract_all(_col(text), F.lit(names_pattern(names, plural)), F.lit(0))
    keys = F.transform(F.coalesce(found, F.array().cast("array<string>")), name_key)
    if plural:
        known = F.array(*[F.lit(" ".join(n.lower().split())) for n in names]) if names else F.array().cast("array<string>")
        keys = F.transform(keys, lambda x: F.when(F.array_contains(known, x), x).otherwise(F.regexp_replace(x, "s$", "")))
    return F.array_distinct(keys)
