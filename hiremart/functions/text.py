"""Text functions as Column -> Column expressions.

Everything here stays inside Catalyst: no Python UDF, so each function
compiles into whole-stage codegen next to the scan that feeds it.

Regular expressions are written so that Java's engine (Spark) and RE2
(the DuckDB oracle) read them the same way: character classes are spelled
out instead of relying on ``\\s``, whose meaning differs between the two.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Java's ``\s`` (space, tab, newline, vertical tab, form feed, carriage return).
WS = "[ \\t\\n\\x0B\\f\\r]"
# Characters that Java's ``.`` refuses to match (no DOTALL, no UNIX_LINES).
LINE_TERMINATORS = "[\\n\\r\\x{85}\\x{2028}\\x{2029}]"
# Java's String.trim() strips every code point up to U+0020.
JAVA_TRIM_CHARS = "".join(chr(i) for i in range(0x21))

UNKNOWN = "UNKNOWN"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_bom(c) -> Column:
    """Drop every U+FEFF in the line (not only a leading one)."""
    return F.replace(col_(c), F.lit("\ufeff"), F.lit(""))


def java_trim(c) -> Column:
    """Trim like java.lang.String.trim (all chars <= U+0020)."""
    return F.btrim(col_(c), F.lit(JAVA_TRIM_CHARS))


def collapse_ws(c, repl: str = " ") -> Column:
    """T5: every run of whitespace becomes one ``repl``."""
    return F.regexp_replace(col_(c), WS + "+", repl)


def empty_to_unknown(c) -> Column:
    """'' -> 'UNKNOWN' with the input read once (an anchored replace)."""
    return F.regexp_replace(col_(c), "^\\z", UNKNOWN)


def unknown_if_blank(c) -> Column:
    """NULL or blank text -> 'UNKNOWN', else UPPER(TRIM(c)).

    Reads ``c`` once, so the expression stays linear when Catalyst inlines
    it into a pushed-down filter.
    """
    return F.coalesce(empty_to_unknown(F.upper(java_trim(col_(c)))), F.lit(UNKNOWN))


def has_line_terminator(c) -> Column:
    return col_(c).rlike(LINE_TERMINATORS)


def matches_anywhere(c, pattern: str) -> Column:
    """F8: Pig ``c MATCHES '.*(pattern).*'`` without the quadratic ``.*``.

    A whole-string match of ``.*(p).*`` succeeds exactly when ``p`` occurs
    somewhere and no line terminator stops the dots.  NULL stays NULL.
    """
    c = col_(c)
    return ~has_line_terminator(c) & c.rlike(pattern)


def matches_whole(c, pattern: str) -> Column:
    """F8: Pig/Java ``MATCHES`` (whole string), via an anchored find."""
    return col_(c).rlike("^(?:" + pattern + ")\\z")


def extract_or_null(c, pattern: str, idx: int = 1) -> Column:
    """T2 building block: first match's group, NULL when nothing matches.

    Spark's regexp_extract returns '' on no match; the reference returns NULL.
    """
    c = col_(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, idx))


def extract_last_or_null(c, pattern: str, idx: int = 1) -> Column:
    """T2 building block: group of the last match anywhere in the text,
    NULL when nothing matches (one left-to-right scan).  For the reference's
    greedy ``.*"key"...`` extraction use ``extract_json_string``, which
    also respects line terminators the way Java's ``.`` does.
    """
    return F.try_element_at(
        F.regexp_extract_all(col_(c), F.lit(pattern), idx), F.lit(-1)
    )


def json_string_pattern(key: str) -> str:
    """``"key" : "value"`` with the value cut at the first quote."""
    for ch in '\\^$.|?*+()[]{}"':
        if ch in key:
            raise ValueError(f"JSON key needs escaping: {key!r}")
    return '"' + key + '"' + WS + "*:" + WS + '*"([^"]*)"'


def extract_json_string(c, key: str) -> Column:
    """String value of ``key`` in a JSON text line; NULL when absent.

    Same answer as ``REGEX_EXTRACT(line, '.*"key"\\s*:\\s*"([^"]*)".*', 1)``:
    the greedy prefix makes the last occurrence win, the value stops at
    the first quote (even an escaped one), and numbers or nested values do
    not match.  Java's ``.`` cannot cross a line terminator, so the match
    starts at a line start, which ``(?m)^`` pins; the greedy ``.*`` then
    backtracks once, a single linear scan per key.  The value is the text
    between the last two quotes of the match.
    """
    body = '"' + key + '"' + WS + "*:" + WS + '*"[^"]*"'
    json_string_pattern(key)   # validates the key
    m = F.regexp_substr(col_(c), F.lit("(?m)^.*" + body))
    return F.substring_index(F.substring_index(m, '"', -2), '"', 1)


def json_string_pieces(c, keys: list[str]) -> Column:
    """T2, one scan for several keys: every ``key" : "value"`` in the text, in order.

    A scan consumes only the quote before a key, so a key that begins inside another's
    value is found too.  An empty piece stands where a line terminator is.
    """
    for k in keys:
        json_string_pattern(k)   # validates the key
    piece = "(?:" + "|".join(keys) + ')"' + WS + "*:" + WS + '*"[^"]*"'
    return F.regexp_extract_all(col_(c), F.lit('"(?=(' + piece + "))|" + LINE_TERMINATORS), F.lit(1))


def json_string_fields(df: DataFrame, c, fields: dict[str, str]) -> DataFrame:
    """``df`` with one more column for each key of ``fields`` (key -> column), as ``extract_json_string`` gives them.

    The last string value of a key wins, of those that begin in the first line of the text that has the key.
    The scan is a generator's input, so Catalyst neither repeats it for each column
    nor moves it into a filter on one of them.
    """
    pieces = json_string_pieces(c, list(fields))
    scanned = F.transform(F.array(pieces), lambda p: F.struct(p.alias("_hm_pieces"), F.transform(p, lambda x: F.substring_index(x, '"', 1)).alias("_hm_keys")))
    found = df.select("*", F.inline(scanned))
    keys, pieces = F.col("_hm_keys"), F.col("_hm_pieces")

    def piece_of(key: str) -> Column:
        last = F.get(F.reverse(pieces), F.array_position(F.reverse(keys), key) - 1)
        first = F.array_position(keys, key)
        rest = F.slice(keys, first, F.size(keys))
        line = F.slice(rest, 1, F.when(F.array_position(rest, "") > 0, F.array_position(rest, "") - 1).otherwise(F.size(rest)))
        in_line = F.when(first > 0, F.get(pieces, first - 1 + F.size(line) - F.array_position(F.reverse(line), key)))
        return F.when(F.array_contains(keys, ""), in_line).otherwise(last)

    values = [F.substring_index(F.substring_index(piece_of(k), '"', -2), '"', 1).alias(n) for k, n in fields.items()]
    return found.select(*df.columns, *values)


def _class_escape(ch: str) -> str:
    return "\\" + ch if ch in "^$.|?*+()[]{}\\-/" else ch


def head_segment_pattern(delim: str) -> str:
    """Whole-string ``([^d]+).*``: starts with a non-delimiter, and no line
    terminator follows the first delimiter (Java's ``.`` stops there)."""
    d = _class_escape(delim)
    return "^[^" + d + "]+(?:" + d + LINE_TERMINATORS[:1] + "^" + LINE_TERMINATORS[1:] + "*)?\\z"


def head_segment(c, delim: str) -> Column:
    """T6 step: text before the first ``delim``.

    Same result as ``c MATCHES '([^d]+).*' ? REGEX_EXTRACT(c, '([^d]+).*', 1) : c``
    with 'UNKNOWN' passed through: a text that starts with a non-delimiter
    and has no line terminator after its first delimiter is cut there;
    anything else (no delimiter, leading delimiter) is kept.  One anchored
    replace reads ``c`` once.
    """
    d = _class_escape(delim)
    return F.regexp_replace(col_(c), "^([^" + d + "]+)" + d + LINE_TERMINATORS[:1] + "^" + LINE_TERMINATORS[1:] + "*\\z", "$1")


def head_segments(c, delims: str = "/,>") -> Column:
    """Apply head_segment for each delimiter in turn."""
    out = col_(c)
    for d in delims:
        out = head_segment(out, d)
    return out


def slug(c) -> Column:
    """T7 core: UPPER(TRIM), whitespace runs -> '_', drop [^A-Z0-9_-].

    Accented letters are deleted, so two names may share a slug.
    """
    s = F.upper(java_trim(col_(c)))
    return F.regexp_replace(collapse_ws(s, "_"), "[^A-Z0-9_-]", "")


def slug_or_unknown(c) -> Column:
    """Slug, with an empty slug -> 'UNKNOWN'."""
    return empty_to_unknown(slug(c))


# --- T8 / T9 fixed values: Vietnamese vowel families folded to ASCII after
# LOWER (precomposed letters, as listed by the reference), and the
# separators the location cleaner turns into spaces.
ACCENT_FAMILIES = [
    ("a", "áàảãạăắằẳẵặâấầẩẫậ"),
    ("e", "éèẻẽẹêếềểễệ"),
    ("i", "íìỉĩị"),
    ("o", "óòỏõọôốồổỗộơớờởỡợ"),
    ("u", "úùủũụưứừửữự"),
    ("y", "ýỳỷỹỵ"),
    ("d", "đ"),
]
SPACE_CHARS = "\u00a0|\u2026"   # NBSP, pipe, horizontal ellipsis
SPACE_SEQUENCES = "\\.\\.\\."   # three dots

_FOLD_FROM = "".join(chars for _, chars in ACCENT_FAMILIES)
_FOLD_TO = "".join(base * len(chars) for base, chars in ACCENT_FAMILIES)


def fold_accents(c) -> Column:
    """LOWER then map each accented vowel (and đ) to its base letter."""
    return F.translate(F.lower(col_(c)), _FOLD_FROM, _FOLD_TO)


#: Combining marks of the accented vowels, apart from base letters (U+0300..U+036F).
COMBINING = "[\\x{300}-\\x{36F}]"


def composed_letters() -> dict[str, str]:
    """Letter with its marks in ascending order -> composed letter, for every accented vowel in both cases.

    Derived from the letters' decompositions: a letter with two marks is also reached from
    each of its parts that has one of them composed already."""
    table: dict[str, str] = {}
    letters = "".join(chars for _, chars in ACCENT_FAMILIES)
    for letter in letters + letters.upper():
        base, *marks = unicodedata.normalize("NFD", letter)
        if not marks:   # a stroke is no combining mark
            continue
        table[base + "".join(sorted(marks))] = letter
        for mark in marks if len(marks) > 1 else ():
            part = unicodedata.normalize("NFC", base + mark)
            table[part + "".join(m for m in marks if m != mark)] = letter
    return table


def compose_accents(c) -> Column:
    """T8, optional step: an accented vowel written as letter and combining marks becomes one letter.

    The marks may come in any order.  Other letters, and marks that make up no accented
    vowel, stay as they are.  Text without combining marks is passed through.
    """
    c = col_(c)
    table = F.create_map(*[F.lit(x) for pair in composed_letters().items() for x in pair])
    clusters = F.regexp_extract_all(c, F.lit("(?s)." + COMBINING + "*"), F.lit(0))

    def whole(x: Column) -> Column:
        marks = F.array_sort(F.split(F.substring(x, 2, 1 << 20), ""))
        key = F.concat(F.substring(x, 1, 1), F.array_join(marks, ""))
        return F.when(F.length(x) > 1, F.coalesce(F.try_element_at(table, key), x)).otherwise(x)

    return F.when(c.rlike(COMBINING), F.array_join(F.transform(clusters, whole), "")).otherwise(c)


def space_separators(c) -> Column:
    """NBSP, '|', '...' and '…' become a space."""
    spaced = F.translate(col_(c), SPACE_CHARS, " " * len(SPACE_CHARS))
    return F.regexp_replace(spaced, SPACE_SEQUENCES, " ")


def clean_location(c, compose: bool = False) -> Column:
    """T8 + T9 on NULL-as-'' text: the key the province rules look at.

    ``compose`` first composes letters written with combining marks, which the folding does not know."""
    text = F.coalesce(col_(c), F.lit(""))
    return space_separators(fold_accents(compose_accents(text) if compose else text))


# --- T10 fixed value: TOKENIZE's second argument is a set of delimiter
# characters, here the characters of the text '[,;/|]+'.
TOKEN_DELIMITERS = "[,;/|]+"
TOKEN_SPLIT_REGEX = (
    "[" + "".join("\\" + ch if ch in "[]\\^-" else ch for ch in sorted(set(TOKEN_DELIMITERS))) + "]"
)


def tokens(c) -> Column:
    """Array of tokens of UPPER(TRIM(c)); ['UNKNOWN'] for blank input.

    Empty pieces vanish (a text of delimiters only gives an empty array,
    hence no row after explode); a blank token becomes 'UNKNOWN'.  Blank
    input turns into the text 'UNKNOWN' first, which splits into itself.
    """
    parts = F.filter(F.split(unknown_if_blank(c), TOKEN_SPLIT_REGEX, -1), lambda x: x != "")
    return F.transform(parts, unknown_if_blank)


def split_fields(c, sep: str = "\t") -> Column:
    """Split on a literal separator keeping empty trailing fields."""
    return F.split(col_(c), regex_literal(sep), -1)


def regex_literal(text: str) -> str:
    """Escape a literal so both Java regex and RE2 read it verbatim."""
    return "".join("\\" + ch if ch in "\\^$.|?*+()[]{}" else ch for ch in text)
