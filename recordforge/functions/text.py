"""Text rules as Column expressions: everything here stays inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space, word edges and letter confusions the results depend on.
SPACES = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85                 　"
SPACE = "[\\s\\x1c-\\x1f\\x85\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
LINE_BREAK = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"
NOT_AFTER_WORD = "(?<![\\p{L}\\p{N}_])"
NOT_BEFORE_WORD = "(?![\\p{L}\\p{N}_])"
DIGIT_CONFUSION = ("OoIl|SB", "0011158")
ID_CONFUSION = ("OoQqIl|SB", "000011158")
NUMERIC_CONFUSION = ("OQIL|ZSGB", "001112568")
# Connector spellings and abbreviations that lose their dot.
TERM_FIXES = {"BIN": ("B1N", "8IN", "BJN"), "BINTI": ("BINT1", "B1NTI", "8INTI")}
DOTTED_TERMS = ("BT", "BTE", "HJ", "HJH", "MOHD", "KG")
NAME_STOP_WORDS = ("TAHUN", "TAHN", "TAHUH", "THN", "RM", "NO", "NIKAH", "KELUAR")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it any number of times in ``body``.

    A Column that is used n times is also evaluated n times; nested rules would grow
    exponentially.  The last function of a fold over no elements binds it to a variable instead.
    An element of a transformed array would do, too, but Spark asks the type of that array for
    every row, and with it the types of all rules within.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda bound, _: bound, body)


def blank_to_null(column: Column) -> Column:
    # nullif would evaluate its argument twice inside a lambda.
    return let(column, lambda value: F.when(value != "", value))


def strip(column: Column) -> Column:
    return F.btrim(column, F.lit(SPACES))


def swap(column: Column, table: tuple[str, str]) -> Column:
    """``translate`` for few characters, none of which is the result of another; a text without them isn't rebuilt."""
    for old, new in zip(table[0], table[1], strict=True):
        column = F.replace(column, F.lit(old), F.lit(new))
    return column


def squeeze(column: Column) -> Column:
    """White space runs to one space, none at the ends."""
    # Printable ASCII with single blanks, as most texts are, has nothing to replace.
    return F.trim(let(column, lambda v: F.when(v.rlike("[^!-~ ]|  "), F.regexp_replace(v, SPACE + "+", " ")).otherwise(v)))


def whole_word(alternatives: Sequence[str]) -> str:
    return f"{NOT_AFTER_WORD}(?:{'|'.join(alternatives)}){NOT_BEFORE_WORD}"


def _holds(text: Column, parts: Sequence[str]) -> Column:
    """Whether a text has any of the parts; parts around others aren't looked for."""
    least = [p for p in parts if not any(q != p and q in p for q in parts)]
    return reduce(lambda a, b: a | b, [text.contains(p) for p in least])


def normalise_text(column: Column) -> Column:
    """Upper case, one kind of line break, single blanks, corrected connectors and abbreviations."""
    value = F.replace(F.upper(F.coalesce(column, F.lit(""))), F.lit("\r"), F.lit("\n"))
    dotted = f"{NOT_AFTER_WORD}({'|'.join(DOTTED_TERMS)})\\.{NOT_BEFORE_WORD}"

    def terms(text: Column) -> Column:
        for right, wrong in TERM_FIXES.items():
            text = F.regexp_replace(text, whole_word(wrong), right)
        return text

    # A search for bytes is cheap; the patterns run on texts that can hold a match only.
    value = let(value, lambda v: F.when(_holds(v, ("\t", "  ")), F.regexp_replace(v, "[ \\t]+", " ")).otherwise(v))
    value = let(value, lambda v: F.when(_holds(v, [w for wrong in TERM_FIXES.values() for w in wrong]), terms(v)).otherwise(v))
    return strip(let(value, lambda v: F.when(v.contains("."), F.regexp_replace(v, dotted, "$1")).otherwise(v)))


def repair_digits(column: Column) -> Column:
    """Letters that look like digits to digits."""
    return swap(column, DIGIT_CONFUSION)


def numeric_text(column: Column) -> Column:
    return repair_digits(normalise_text(column))


def repair_ids(column: Column) -> Column:
    """Identity numbers: separators and lone letters stay, a leading letter before digits stays."""
    value = squeeze(F.regexp_replace(normalise_text(column), "[^A-Z0-9./\\-\\s]", " "))
    parts = F.regexp_extract_all(value, F.lit("(\\s+|[./-]|[^\\s./-]+)"), F.lit(1))

    def repaired(part: Column) -> Column:
        return (
            F.when(F.length(part) == 1, F.when(part.rlike("^[A-Z./ -]$"), part).otherwise(swap(part, ID_CONFUSION)))
            .when(part.rlike("^[A-Z].*[0-9]"), F.concat(F.substring(part, 1, 1), swap(F.substring(part, 2, 1 << 30), ID_CONFUSION)))
            .otherwise(swap(part, ID_CONFUSION))
        )

    return F.trim(F.array_join(F.transform(parts, repaired), ""))


def _drop_final_dot(text: Column) -> Column:
    """A dot after a last token of more than three letters ends the text, shorter ones are abbreviations."""

    def dropped(value: Column) -> Column:
        token = F.replace(F.substring_index(value, " ", -1), F.lit("."), F.lit(""))
        return F.when(value.endswith(".") & (F.length(token) > 3), F.rtrim(value, F.lit("."))).otherwise(value)

    return let(text, dropped)


def clean_name(column: Column) -> Column:
    """Name letters only, without register words; NULL when nothing is left."""
    value = F.regexp_replace(normalise_text(column), "[^A-Z\\s.'/()-]", " ")
    value = squeeze(F.regexp_replace(value, whole_word(NAME_STOP_WORDS), " "))
    return blank_to_null(_drop_final_dot(value))


def prepare_name(column: Column) -> Column:
    """Form of a name that candidates start from; '' when nothing is left."""
    value = squeeze(F.upper(F.coalesce(column, F.lit(""))))
    value = squeeze(F.regexp_replace(value, "[^A-Z0-9\\s.'/()@-]", " "))
    return squeeze(_drop_final_dot(value))


def free_text(column: Column) -> Column:
    return F.upper(squeeze(column))


def raw_lines(column: Column) -> Column:
    return F.split(F.coalesce(column, F.lit("")), LINE_BREAK)


def meaningful_lines(column: Column) -> Column:
    """Non-empty normalised lines in order, as an array."""
    return F.filter(F.transform(raw_lines(column), free_text), lambda line: line != "")


def replace_tokens(column: Column, tokens: Mapping[str, str]) -> Column:
    """Exact replacement of blank-separated tokens."""
    lookup = F.create_map(*[F.lit(x) for pair in tokens.items() for x in pair])
    return F.array_join(F.transform(F.split(column, " "), lambda t: F.coalesce(F.try_element_at(lookup, t), t)), " ")


def replace_patterns(column: Column, patterns: Sequence[tuple[str, str]]) -> Column:
    """Regular expressions applied in the given order."""
    for pattern, replacement in patterns:
        column = F.regexp_replace(column, pattern, replacement)
    return column


def similarity(left: Column, right: Column) -> Column:
    """1 - levenshtein distance / longer length."""
    longest = F.greatest(F.length(left), F.length(right))
    return F.when(longest == 0, F.lit(1.0)).otherwise(F.lit(1.0) - F.levenshtein(left, right) / longest.cast("double"))


def strip_zeros(digits: Column) -> Column:
    return F.regexp_replace(digits, "^0+(?=.)", "")
