"""Field rules as Column expressions: serials, money, ages, identity numbers and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordforge.functions.text import (
    NOT_AFTER_WORD,
    NOT_BEFORE_WORD,
    NUMERIC_CONFUSION,
    blank_to_null,
    free_text,
    let,
    meaningful_lines,
    numeric_text,
    repair_ids,
    squeeze,
    strip,
    strip_zeros,
    swap,
)

# Patterns of the ledger and of the typed form, and their limits.
AGE_WORDS = "(?:TAHUN|TAHUH|TAHN|THN)"
AGE_PATTERN = f"(?:^|[\\s/\\-])([1-9]\\d{{1,2}})\\s*{AGE_WORDS}{NOT_BEFORE_WORD}"
MODERN_ID = f"{NOT_AFTER_WORD}(\\d{{6}})[-\\s./]?(\\d{{2}})[-\\s./]?(\\d{{4}}){NOT_BEFORE_WORD}"
LEGACY_ID = f"{NOT_AFTER_WORD}([A-Z]{{1,3}}(?:/[A-Z]{{1,3}})?)[-\\s./]*(\\d{{5,7}})"
LEGACY_NUMBER = f"{NOT_AFTER_WORD}(\\d{{5,7}})"
ISO_DATE = f"{NOT_AFTER_WORD}\\d{{4}}\\s*[-./:,;]\\s*\\d{{1,2}}\\s*[-./:,;]\\s*\\d{{1,2}}{NOT_BEFORE_WORD}"
DAY_FIRST_DATE = f"{NOT_AFTER_WORD}\\d{{1,2}}\\s*[-./:,;]\\s*\\d{{1,2}}\\s*[-./:,;]\\s*\\d{{2,4}}{NOT_BEFORE_WORD}"
COMPACT_DATE = f"{NOT_AFTER_WORD}\\d{{1,2}}\\s*[-./:,;]\\s*\\d\\d{{2}}{NOT_BEFORE_WORD}"
DETAIL_HINT = (
    f"(?:(?:[A-Z]{{1,3}}/[A-Z]{{1,3}}|[A-Z])[-\\s./]*\\d{{5,8}}{NOT_BEFORE_WORD}"
    f"|{NOT_AFTER_WORD}\\d{{5,8}}{NOT_BEFORE_WORD}"
    f"|{NOT_AFTER_WORD}\\d{{6}}[-\\s./]?\\d{{2}}[-\\s./]?\\d{{4}}{NOT_BEFORE_WORD}"
    f"|{NOT_AFTER_WORD}\\d{{2,3}}\\s*{AGE_WORDS}{NOT_BEFORE_WORD})"
)
CENTURY_PIVOT = 30
AGE_LOW, AGE_HIGH = 15, 100


def found(column: Column, pattern: str, group: int = 0) -> Column:
    """First match or NULL."""
    return blank_to_null(F.regexp_extract(column, pattern, group))


def all_found(column: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(column, F.lit(pattern), F.lit(group))


def confusions(column: Column) -> Column:
    """How many characters are letters that stand for digits."""
    return F.length(column) - F.length(F.regexp_replace(column, f"[{NUMERIC_CONFUSION[0]}]", ""))


# ---------------------------------------------------------------- serials


def ledger_serial(column: Column) -> Column:
    """Serial with its year when both are seen, otherwise the first number."""
    with_year = f"{NOT_AFTER_WORD}(\\d{{3,5}})\\s*[/\\\\|]\\s*(\\d{{2,4}}){NOT_BEFORE_WORD}"
    alone = f"{NOT_AFTER_WORD}(\\d{{1,5}}){NOT_BEFORE_WORD}"

    def clean(digits: Column) -> Column:
        cut = lambda d: F.when((F.length(d) > 3) & d.startswith("4"), F.substring(d, 1, 3)).otherwise(d)
        return strip_zeros(let(digits, cut))

    def serial(text: Column) -> Column:
        year = F.substring(F.regexp_extract(text, with_year, 2), -2, 2)
        return F.coalesce(F.concat(clean(found(text, with_year, 1)), F.lit("/"), year), clean(found(text, alone, 1)))

    return let(swap(free_text(F.coalesce(column, F.lit(""))), ("OQSLI", "00511")), serial)


def typed_serial(column: Column) -> Column:
    return F.regexp_replace(found(column, f"{NOT_AFTER_WORD}\\d+\\s*/\\s*\\d{{4}}{NOT_BEFORE_WORD}"), "\\s*/\\s*", "/")


# ---------------------------------------------------------------- money


def _money_of_line(line: Column) -> Column:
    text = F.regexp_replace(F.translate(line, "O", "0"), "(?<=\\d)[IL](?=\\d)", "1")
    parts = let(text, lambda t: F.struct(t.alias("text"), all_found(t, "\\d+").alias("groups")))

    def amount(p: Column) -> Column:
        text, groups = p["text"], p["groups"]
        count, last = F.size(groups), F.try_element_at(groups, F.lit(-1))
        front = F.array_join(F.slice(groups, F.lit(1), F.greatest(count - 1, F.lit(0))), "")
        unlike = F.replace(text, F.lit("RM"), F.lit("")).rlike("[A-Z]")
        bare = ~text.contains("RM") & (count == 1) & (F.length(last) < 2)
        readable = (count > 0) & ~unlike & ~bare
        cents_apart = readable & (count >= 2) & (F.length(last) <= 2)
        glued = readable & (count == 1) & (F.length(last) >= 3)
        ringgit = lambda whole, cents: F.concat(F.lit("RM "), strip_zeros(whole), F.lit("."), cents)
        return (
            F.when(cents_apart, ringgit(front, F.rpad(last, 2, "0")))
            .when(glued, ringgit(F.substring(last, F.lit(1), F.length(last) - 2), F.substring(last, -2, 2)))
            .when(readable & (count == 1), ringgit(last, F.lit("00")))
        )

    return let(parts, amount)


def ledger_money(column: Column) -> Column:
    """struct(value, raw, needs_review) from the last line that is only digits and currency."""
    return money_of_lines(meaningful_lines(column))


def money_of_lines(lines: Column) -> Column:
    """``ledger_money`` of the meaningful lines of a cell."""
    # Letters that neither stand for a digit nor for the currency make a line unreadable at once.
    possible = F.filter(lines, lambda l: ~l.rlike("[A-HJKNPQS-Z]"))
    priced = F.transform(possible, lambda l: F.struct(_money_of_line(l).alias("value"), l.alias("raw")))
    last = F.try_element_at(F.filter(priced, lambda p: p["value"].isNotNull()), F.lit(-1))

    def flagged(l: Column) -> Column:
        review = F.coalesce(~l["raw"].contains("RM"), F.lit(False))
        return F.struct(l["value"].alias("value"), l["raw"].alias("raw"), review.alias("needs_review"))

    return let(last, flagged)


def typed_money(column: Column) -> Column:
    """Amount after the currency with its decimals kept and thousands separated."""
    pattern = f"(?i){NOT_AFTER_WORD}RM\\s*([0-9][0-9\\s,]*(?:\\.[0-9]{{1,2}})?)"
    amount = found(column, pattern, 1)
    # Blanks and commas separate thousands; any other white space makes the amount unreadable.
    number = strip(F.regexp_replace(amount, "[ ,]", ""))

    def grouped(n: Column) -> Column:
        whole, cents = F.split_part(n, F.lit("."), F.lit(1)), F.split_part(n, F.lit("."), F.lit(2))
        thousands = F.reverse(F.regexp_replace(F.reverse(strip_zeros(whole)), "(\\d{3})(?=\\d)", "$1,"))
        ending = F.when(cents == "", F.lit("")).otherwise(F.concat(F.lit("."), cents))
        return F.when(n.rlike("^[0-9]+(\\.[0-9]+)?$"), F.concat(F.lit("RM "), thousands, ending))

    return let(number, grouped)


# ---------------------------------------------------------------- ages


def ledger_ages(column: Column, low: int = AGE_LOW, high: int = AGE_HIGH) -> Column:
    """Distinct plausible ages in order; a leading 7 of two digits is a misread 2."""
    digits = all_found(numeric_text(column), AGE_PATTERN, 1)
    ages = F.transform(
        digits, lambda d: F.when((F.length(d) == 2) & d.startswith("7"), d.cast("int") - 50).otherwise(d.cast("int"))
    )
    return F.array_distinct(F.filter(ages, lambda a: a.between(low, high)))


def typed_age(column: Column, low: int = 16, high: int = 120) -> Column:
    lines = F.filter(F.transform(F.split(column, "\\r\\n|[\\n\\r]"), strip), lambda l: l != "")
    age = found(F.try_element_at(lines, F.lit(1)), f"{NOT_AFTER_WORD}(\\d{{1,3}}){NOT_BEFORE_WORD}", 1).cast("int")
    return let(age, lambda a: F.when(a.between(low, high), a))


# ---------------------------------------------------------------- identity numbers


def _days_in_month(month: Column, leap: Column) -> Column:
    return F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)


def valid_birth_digits(digits: Column) -> Column:
    """yyMMdd is a day in 19yy or in 20yy."""
    year, month, day = (F.substring(digits, p, 2).try_cast("int") for p in (1, 3, 5))
    return month.between(1, 12) & (day >= 1) & (day <= _days_in_month(month, year % 4 == 0))


def id_candidate(column: Column) -> Column:
    """struct(value, source, correction_type, validity, plausibility, similarity, substitutions) or NULL.

    A text gives at most one candidate: twelve characters are a modern number, fewer a legacy one.
    """
    shape = "^([A-Z])?([A-Z0-9|]{5,8})([A-Z])?$"
    prepared = squeeze(F.regexp_replace(F.upper(column), "[^A-Z0-9|./\\-\\s]", " "))

    def forms(p: Column) -> Column:
        return F.struct(F.regexp_replace(p, "[^A-Z0-9|]", "").alias("compact"), F.regexp_replace(p, "[\\s.-]+", "").alias("joined"))

    def scored(value: Column, n: Column, validity: float, plausibility: float, fixed: bool = False) -> Column:
        changed = F.lit(False) if fixed else n > 0
        return F.struct(
            value.alias("value"),
            F.when(changed, "typo_rule").otherwise("safe_normalisation").alias("source"),
            F.when(changed, "digit_confusion").otherwise("safe_normalisation").alias("correction_type"),
            F.greatest(F.lit(0.0), F.lit(validity) - n * F.lit(0.05)).alias("validity"),
            F.greatest(F.lit(0.0), F.lit(plausibility) - n * F.lit(0.03)).alias("plausibility"),
            F.greatest(F.lit(0.0), F.lit(0.99) - n * F.lit(0.05)).alias("similarity"),
            n.cast("int").alias("substitutions"),
        )

    def digits(f: Column) -> Column:
        body = F.regexp_extract(f["compact"], shape, 2)
        return F.struct(
            f["compact"].alias("compact"), f["joined"].alias("joined"), (F.length(f["compact"]) == 12).alias("twelve"),
            swap(f["compact"], NUMERIC_CONFUSION).alias("modern"),
            body.alias("body"), swap(body, NUMERIC_CONFUSION).alias("body_digits"),
        )

    def candidate(f: Column) -> Column:
        modern = f["twelve"] & f["modern"].rlike("^\\d{12}$") & valid_birth_digits(f["modern"])
        lettered = ~f["twelve"] & f["joined"].rlike("^[A-Z]{1,3}(?:/[A-Z]{1,3})?\\d{5,8}$")
        plain = ~f["twelve"] & f["body_digits"].rlike("^\\d+$")
        plain_value = F.concat(F.regexp_extract(f["compact"], shape, 1), f["body_digits"], F.regexp_extract(f["compact"], shape, 3))
        return (
            F.when(modern, scored(f["modern"], confusions(f["compact"]), 1.0, 0.99))
            .when(lettered, scored(f["joined"], F.lit(0), 1.0, 1.0, fixed=True))
            .when(plain, scored(plain_value, confusions(f["body"]), 0.98, 0.97))
        )

    return let(let(let(prepared, forms), digits), candidate)


def ledger_ids(column: Column) -> Column:
    """struct(legacy, modern, raw): a letter-led legacy number, a 12-digit one, or a bare legacy number."""

    def seen(text: Column) -> Column:
        return F.struct(found(text, LEGACY_ID).alias("lettered"), found(text, MODERN_ID).alias("modern"), found(text, LEGACY_NUMBER).alias("bare"))

    def read(s: Column) -> Column:
        # A bare number counts only where nothing else was found.
        bare = F.when(s["lettered"].isNull() & s["modern"].isNull(), s["bare"])
        values = F.transform(F.array(s["lettered"], bare, s["modern"]), lambda t: F.when(t.isNotNull(), id_candidate(t)["value"]))
        return F.struct(s.alias("s"), values.alias("values"))

    def chosen(r: Column) -> Column:
        s, values = r["s"], r["values"]
        plain = F.concat(F.regexp_extract(s["lettered"], LEGACY_ID, 1), F.regexp_extract(s["lettered"], LEGACY_ID, 2))
        legacy = F.when(s["lettered"].isNotNull(), F.coalesce(values[0], plain)).when(
            s["bare"].isNotNull() & s["modern"].isNull(), F.coalesce(values[1], s["bare"])
        )
        raw = F.concat_ws(" / ", F.trim(F.coalesce(s["lettered"], s["bare"])), F.trim(s["modern"]))
        return F.struct(legacy.alias("legacy"), values[2].alias("modern"), blank_to_null(raw).alias("raw"))

    return let(let(let(repair_ids(column), seen), read), chosen)


def typed_ids(column: Column) -> Column:
    """struct(legacy, modern) of the typed form: modern, else letter-led, else 7 or 8 bare digits."""

    def seen(text: Column) -> Column:
        modern = found(text, f"{NOT_AFTER_WORD}\\d{{6}}[\\s./-]*\\d{{2}}[\\s./-]*\\d{{4}}{NOT_BEFORE_WORD}")
        lettered = F.regexp_replace(found(text, "(?:[A-Z]{1,3}/[A-Z]{1,3}|[A-Z])[-\\s./]*\\d{5,7}"), "[\\s.]", "")
        bare = found(text, f"{NOT_AFTER_WORD}\\d{{7,8}}{NOT_BEFORE_WORD}")
        return F.struct(F.coalesce(lettered, bare).alias("legacy"), F.regexp_replace(modern, "\\D", "").alias("modern"))

    def chosen(s: Column) -> Column:
        return F.struct(F.when(s["modern"].isNull(), s["legacy"]).alias("legacy"), s["modern"].alias("modern"))

    return let(let(F.upper(column), seen), chosen)


# ---------------------------------------------------------------- dates


def _calendar_day(day: Column, month: Column, year: Column) -> Column:
    """dd-MM-yyyy when the three digit groups name a real day; two-digit years turn at the pivot."""
    y = year.try_cast("int")
    full = F.when(F.length(year) == 2, F.when(y <= CENTURY_PIVOT, y + 2000).otherwise(y + 1900)).otherwise(y)
    numbers = F.struct(day.try_cast("int").alias("d"), month.try_cast("int").alias("m"), full.alias("y"))

    def dated(n: Column) -> Column:
        d, m, y = n["d"], n["m"], n["y"]
        leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
        real = y.between(1, 9999) & m.between(1, 12) & (d >= 1) & (d <= _days_in_month(m, leap))
        two = lambda c: F.lpad(c.cast("string"), 2, "0")
        return F.when(real, F.concat(two(d), F.lit("-"), two(m), F.lit("-"), y.cast("string")))

    return let(numbers, dated)


def date_value(column: Column) -> Column:
    """Normalised date of a text that holds one date, or NULL."""
    prepared = swap(F.upper(column), NUMERIC_CONFUSION)
    prepared = squeeze(F.regexp_replace(prepared, "[^0-9./\\-\\s]", " "))
    groups = F.filter(F.split(prepared, "[-./\\s]+"), lambda g: g != "")

    def dated(groups: Column) -> Column:
        a, b, c = (F.get(groups, F.lit(i)) for i in range(3))
        three = F.size(groups) == 3
        year_first = F.when(three & (F.length(a) == 4), _calendar_day(c, b, a))
        collapsed = F.when((F.size(groups) == 2) & (F.length(b) == 3), _calendar_day(a, F.substring(b, 1, 1), F.substring(b, 2, 2)))
        return F.coalesce(F.when(three, _calendar_day(a, b, c)), year_first, collapsed)

    return let(groups, dated)


def date_candidate(column: Column) -> Column:
    """Candidate struct of a date text, or NULL."""
    facts = F.struct(date_value(column).alias("value"), confusions(F.upper(column)).alias("n"))

    def candidate(f: Column) -> Column:
        n = f["n"]
        return F.when(
            f["value"].isNotNull(),
            F.struct(
                f["value"].alias("value"),
                F.when(n > 0, "typo_rule").otherwise("safe_normalisation").alias("source"),
                F.when(n > 0, "date_digit_confusion").otherwise("date_normalisation").alias("correction_type"),
                F.greatest(F.lit(0.0), F.lit(1.0) - n * F.lit(0.05)).alias("validity"),
                F.greatest(F.lit(0.0), F.lit(0.98) - n * F.lit(0.04)).alias("plausibility"),
                F.greatest(F.lit(0.0), F.lit(0.99) - n * F.lit(0.05)).alias("similarity"),
                n.cast("int").alias("substitutions"),
            ),
        )

    return let(facts, candidate)


def ledger_date(column: Column) -> Column:
    """struct(value, raw, needs_review): ISO, then day-first, then collapsed dates; first real one wins."""
    spots = let(numeric_text(column), lambda text: F.concat(*[all_found(text, p) for p in (ISO_DATE, DAY_FIRST_DATE, COMPACT_DATE)]))
    dated = F.transform(spots, lambda s: F.struct(date_value(s).alias("value"), s.alias("raw")))
    first = F.try_element_at(F.filter(dated, lambda s: s["value"].isNotNull()), F.lit(1))
    leftover = blank_to_null(F.array_join(meaningful_lines(column), " "))

    def result(f: Column) -> Column:
        raw = F.coalesce(f["first"]["raw"], f["leftover"])
        review = f["first"].isNull() & f["leftover"].isNotNull()
        return F.struct(f["first"]["value"].alias("value"), raw.alias("raw"), review.alias("needs_review"))

    return let(F.struct(first.alias("first"), leftover.alias("leftover")), result)


def typed_date(column: Column) -> Column:
    lines = F.filter(F.transform(F.split(column, "\\r\\n|[\\n\\r]"), strip), lambda l: l != "")
    per_line = F.filter(F.transform(lines, date_value), lambda d: d.isNotNull())
    return F.coalesce(F.try_element_at(per_line, F.lit(1)), date_value(strip(column)))


# ---------------------------------------------------------------- validity


def valid_id(column: Column) -> Column:
    forms = F.struct(
        F.regexp_replace(F.upper(column), "[^A-Z0-9]", "").alias("compact"), F.regexp_replace(F.upper(column), "[ .]", "").alias("spaced")
    )

    def valid(f: Column) -> Column:
        other = f["spaced"].rlike("^[A-Z]{1,3}(?:/[A-Z]{1,3})?\\d{5,8}$") | f["compact"].rlike("^\\d{5,8}$")
        return F.when(f["compact"].rlike("^\\d{12}$"), valid_birth_digits(f["compact"])).otherwise(other)

    return F.coalesce(let(forms, valid), F.lit(False))


def suspicious_id(column: Column) -> Column:
    """Five or more digits that are all the same."""
    digits = F.regexp_replace(column, "[^0-9]", "")
    return F.coalesce(digits.rlike("^(\\d)\\1{4,}$"), F.lit(False))


def valid_date(column: Column) -> Column:
    return F.coalesce(date_value(strip(column)).isNotNull(), F.lit(False))


def suspicious_name(column: Column) -> Column:
    """Empty, or with a digit; other odd characters never survive the preparation of a name."""
    from recordforge.functions.text import prepare_name

    return let(prepare_name(column), lambda p: (p == "") | p.rlike("[0-9]"))
