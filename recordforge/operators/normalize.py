"""Bulk text normalisation; every rule is a Column expression or a join with a rule table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.functions import gestalt
from recordforge.functions import text as T
from recordforge.functions.rules import RuleTable

# Relations the vocabulary snap knows, and its cutoff.
RELATIONS = ("BAPA KANDUNG", "SAUDARA LELAKI", "WALI HAKIM", "BAPA", "ABANG", "SAUDARA", "LELAKI", "DATUK")
SNAP_CUTOFF = 0.72
# Misread connector tokens and misread words of office addresses, in order.
NAME_TOKENS = {
    "B1N": "BIN", "BJN": "BIN", "BLN": "BIN", "BINT1": "BINTI", "B1NTI": "BINTI",
    "M0HD": "MOHD", "MOHO": "MOHD", "A8D": "ABD", "HI.": "HJ.",
}
OFFICE_PATTERNS = (
    (T.whole_word(["ITJ", "LTJ", "IJT", "H1", "HI"]) + "\\s*\\.?", "HJ."),
    (T.whole_word(["BIR", "BJN", "B1N"]), "BIN"),
    (T.NOT_AFTER_WORD + "BINT!(?=[\\p{L}\\p{N}_])", "BINTI"),
    (T.whole_word(["PENDAFTAPAN", "PENOAFTARAN"]), "PENDAFTARAN"),
    (T.whole_word(["NIKAHH"]), "NIKAH"),
    (T.whole_word(["MASJIO", "MASJ1D"]), "MASJID"),
    (T.whole_word(["KAWASAH", "KAWASAM"]), "KAWASAN"),
    (T.whole_word(["ISLAN"]), "ISLAM"),
)
# Printed labels, following labels and hint words of the typed form.
LEADING_LABELS = {
    "nama_suami": "nama", "nama_isteri": "nama", "nama_pendaftar": "nama", "nama_wali": "nama",
    "hubungan_wali": "hubungan", "saksi_1": "saksi\\s*1", "saksi_2": "saksi\\s*2",
    "tarikh_nikah": "tarikh\\s*nikah", "alamat_pendaftar": "alamat", "mas_kahwin": "mas\\s*kahwin",
}
TRAILING_LABELS = (
    "NO\\.?\\s*SIRI", "NO\\.?\\s*SIN", "UMUR", "BANGSA", "WARGANEGARA", "ALAMAT",
    "PENDAFTAR", "HUBUNGAN", "SAKSI\\s+PERTAMA", "SAKSI\\s+KEDUA",
)
LOCATION_WORDS = (
    "DAERAH", "SELANGOR", "SUNGAI", "BESAR", "KAMPUNG", "PEJABAT", "AGAMA", "ISLAM", "WARGANEGARA",
    "BANGSA", "UMUR", "NO", "SIRI", "SIN", "TARIKH", "HIJRAH", "MASIHI", "PENDAFTAR",
)
MEN, WOMEN, WITNESS = ("BIN", "BINTI", "HAJI", "HJ", "TUAN", "USTAZ"), ("BIN", "BINTI", "HAJI", "HJ", "PUAN", "CIK"), ("BIN", "BINTI", "HAJI", "HJ")
NAME_HINTS = {
    "nama_suami": MEN, "nama_isteri": WOMEN, "nama_wali": MEN, "nama_pendaftar": MEN, "saksi_1": WITNESS, "saksi_2": WITNESS,
}
RELATION_HINTS = ("BAPA", "KANDUNG", "WALI", "HAKIM")
ADDRESS_HINTS = ("PEJABAT", "ALAMAT", "TEMPAT")
ADDRESS_WORDS = (
    "PEJABAT", "AGAMA", "ISLAM", "DAERAH", "SELANGOR", "SUNGAI", "KAMPUNG", "JALAN", "BESAR", "TAWAR", "LEMAN",
)
DATE_LABELS = ("TARIKH", "HIJRAH", "MASIHI")


def _each(df: DataFrame, cols: Sequence[str], rule) -> DataFrame:
    return df.withColumns({c: rule(F.col(c)) for c in cols})


def normalise_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _each(df, cols, T.normalise_text)


def repair_digits(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _each(df, cols, T.repair_digits)


def repair_ids(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _each(df, cols, T.repair_ids)


def clean_names(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _each(df, cols, T.clean_name)


def split_lines(df: DataFrame, col: str, position: str = "line_ix", line: str = "line") -> DataFrame:
    """One row per non-empty normalised line, numbered from 0."""
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.posexplode(T.meaningful_lines(F.col(col))).alias(position, line))


def apply_token_rules(
    df: DataFrame, cols: Sequence[str], tokens: Mapping[str, str] | None = None, patterns: Sequence[tuple[str, str]] = ()
) -> DataFrame:
    """Exact tokens first, then patterns in their order."""

    def rule(column: Column) -> Column:
        if tokens:
            column = T.replace_tokens(column, tokens)
        return T.replace_patterns(column, patterns)

    return _each(df, cols, rule)


def apply_rules(df: DataFrame, rules: RuleTable, fields: Mapping[str, str]) -> DataFrame:
    """Rules of a table on columns; ``fields`` gives the field of each column."""
    return df.withColumns({column: rules.apply(field, F.col(column)) for column, field in fields.items()})


def apply_phrase_rules(df: DataFrame, rules: DataFrame, value: str = "value", field: str = "field") -> DataFrame:
    """Whole-value corrections from a table (field, phrase, replacement).

    A rule given twice counts once, of contradicting ones the first in sort order.  The optimizer broadcasts the rules
    only when their size allows it.
    """
    lookup = rules.groupBy(F.col("field").alias(field), F.col("phrase").alias(value)).agg(F.min("replacement").alias("replacement"))
    return (
        df.join(lookup, [field, value], "left")
        .select(*[F.coalesce("replacement", value).alias(value) if c == value else F.col(c) for c in df.columns])
    )


def _letters(column: Column) -> Column:
    return T.squeeze(F.regexp_replace(T.normalise_text(column), "[^A-Z ]", " "))


def snap_value(letters: Column, vocabulary: Sequence[str] = RELATIONS, cutoff: float = SNAP_CUTOFF) -> Column:
    """Exact member of the vocabulary or the most similar one by edit distance, else NULL."""

    def rated(text: Column, size: Column, value: str) -> Column:
        # A distance is at least the difference of the lengths: other lengths can't reach the cutoff.
        sizes = [n for n in range(1, 64 + 8 * len(value)) if 1.0 - abs(n - len(value)) / max(n, len(value)) >= cutoff]
        entry = F.struct(T.similarity(text, F.lit(value)).alias("ratio"), F.lit(value).alias("value"))
        # Where a cutoff lets most lengths pass, all are compared.
        return entry if len(sizes) > 4 * len(value) + 16 else F.when(size.between(min(sizes), max(sizes)), entry)

    def snapped(text: Column) -> Column:
        ranked = T.let(F.length(text), lambda size: F.array(*[rated(text, size, v) for v in vocabulary]))
        near = T.let(F.array_max(ranked), lambda best: F.when(best["ratio"] >= cutoff, best["value"]))
        return F.when(text.isNull() | (text == ""), F.lit(None)).when(text.isin(list(vocabulary)), text).otherwise(near)

    return T.let(letters, snapped)


def snap_vocabulary(
    df: DataFrame,
    col: str,
    vocabulary: Sequence[str] = RELATIONS,
    cutoff: float = SNAP_CUTOFF,
    metric: str = "levenshtein",
    out: str = "snapped",
) -> DataFrame:
    """Snap a column to a small vocabulary.

    ``levenshtein`` is a plain expression.  ``gestalt`` is the ratio of matching blocks; it
    runs in Arrow batches and only once per distinct text.
    """
    if metric == "levenshtein":
        return df.withColumn("__letters", _letters(F.col(col))).withColumn(out, snap_value(F.col("__letters"), vocabulary, cutoff)).drop("__letters")
    if metric != "gestalt":
        raise ValueError(f"unknown metric: {metric}")
    keyed = df.withColumn("__letters", _letters(F.col(col)))
    snapped = keyed.select("__letters").distinct().withColumn(out, gestalt.closest(F.col("__letters"), vocabulary, cutoff))
    return keyed.join(snapped, "__letters", "left").drop("__letters")


def strip_label(line: Column, field: str | None) -> Column:
    label = LEADING_LABELS.get(field or "")
    if label:
        line = F.regexp_replace(line, f"(?i)^\\s*({label}\\s*:?\\s*)", "")
    line = F.regexp_replace(F.translate(line, ":", " "), "[ \\t]+", " ")
    line = T.strip(line)
    noise = f"(?i){T.NOT_AFTER_WORD}(?:{'|'.join(TRAILING_LABELS)}){T.NOT_BEFORE_WORD}.*$"
    line = T.strip(F.regexp_replace(line, noise, ""))
    return F.btrim(F.regexp_replace(line, "[ \\t]+", " "), F.lit(" ,"))


def strip_labels(df: DataFrame, col: str, field: str) -> DataFrame:
    """Remove the printed label in front of a value and everything from the next printed label on."""
    return df.withColumn(col, strip_label(F.col(col), field))


def _any(text: Column, words: Sequence[str]) -> Column:
    return text.rlike("|".join(words))


def best_line(column: Column, field: str | None) -> Column:
    """Line of a region that looks most like a value of the field."""
    lines = F.filter(F.transform(T.raw_lines(column), lambda l: strip_label(T.strip(l), field)), lambda l: l != "")

    def ranked(line: Column, place: Column) -> Column:
        return T.let(F.upper(line), lambda upper: scored(line, upper, place))

    def scored(line: Column, upper: Column, place: Column) -> Column:
        digit = line.rlike("\\d")
        words = F.size(F.regexp_extract_all(upper, F.lit("[A-Z@']+"), F.lit(0)))
        score = words - F.when(digit, 5).otherwise(0) - F.when(_any(upper, LOCATION_WORDS), 3).otherwise(0)
        for hint in NAME_HINTS.get(field or "", ()):
            score = score + F.when(upper.contains(hint), 2).otherwise(0)
        if field == "hubungan_wali":
            score = score + F.when(_any(upper, RELATION_HINTS), 4).otherwise(0)
        if field == "alamat_pendaftar":
            score = score + F.when(_any(upper, ADDRESS_HINTS), 3).otherwise(0) + F.when(digit, 2).otherwise(0)
            preferred = ~_any(upper, DATE_LABELS) & (_any(upper, ADDRESS_WORDS) | digit)
        else:
            preferred = ~digit
        return F.struct(
            preferred.alias("preferred"), score.alias("score"), words.alias("words"), (-F.length(line)).alias("short"),
            (-place).alias("early"), line.alias("line"),
        )

    # A text of one line, as most regions have, is not ranked.
    alone = strip_label(T.strip(column), field)
    best = F.when(~column.rlike(T.LINE_BREAK), alone).otherwise(F.array_max(F.transform(lines, ranked))["line"])
    return F.when(column.isNotNull(), T.blank_to_null(F.btrim(T.squeeze(best), F.lit(" ,"))))


def best_lines(df: DataFrame, col: str, field: str) -> DataFrame:
    return df.withColumn(col, best_line(F.col(col), field))
