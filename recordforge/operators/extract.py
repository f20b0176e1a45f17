"""Cell text to typed columns.  Everything is a narrow projection; only the pivot of cells shuffles."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.functions import fields as X
from recordforge.functions import gestalt
from recordforge.functions import text as T
from recordforge.functions.rules import Rule, RuleTable
from recordforge.operators.normalize import NAME_TOKENS, OFFICE_PATTERNS, RELATIONS, SNAP_CUTOFF, best_line, snap_value

# Cells of a ledger record, markers of numbered people, misread relation and remark phrases.
CELLS = ("bil", "suami_isteri", "pendaftar", "wali", "hubungan_wali", "saksi", "tarikh_nikah", "tarikh_keluar", "remarks", "tandatangan")
NUMBER_MARKERS = {"①": "\n1) ", "②": "\n2) ", "③": "\n3) ", "④": "\n4) ", "❶": "\n1) ", "❷": "\n2) "}
NUMBERED = "(?:^|\\n|\\s)(?:[\\[(]?[12][\\])\\-.]|[①②])\\s*"
NUMBER_PREFIX = "^\\s*(?:[\\[(]?\\d+[\\])\\-.]?|[①②③④⑤⑥⑦⑧⑨])\\s*"
# Rules that hold unless the caller gives a table of its own.
PHRASES = RuleTable(
    Rule(place, field, "phrase", pattern, value)
    for place, (field, pattern, value) in enumerate(
        (
            ("relation", "SAUDARA LECAKI (CABANG)", "SAUDARA LELAKI (ABANG)"),
            ("relation", "SAUDARA CECAKI", "SAUDARA LELAKI"),
            ("relation", "BAPA SULONG", "SAUDARA LELAKI (ABANG)"),
            ("relation", "SAUDARA SEBAPAK", "SAUDARA LELAKI"),
            ("remarks", "DIAMBIL OLEH SUAM", "Diambil oleh suami"),
            ("remarks", "DIAMBIL OLEH", "Diambil oleh suami"),
            ("remarks", "DIAMBIL OLEH SUAMI", "Diambil oleh suami"),
        )
    )
)

Snap = Callable[[Column], Column]


def _with(df: DataFrame, name: str, value: Column, raw: Column, review: Column) -> DataFrame:
    return df.withColumns({name: value, f"{name}_raw": raw, f"{name}_needs_review": review})


def extract_serial(df: DataFrame, col: str, name: str = "serial", profile: str = "ledger") -> DataFrame:
    value = X.ledger_serial(F.col(col)) if profile == "ledger" else X.typed_serial(F.col(col))
    return _with(df, name, value, F.col(col), value.isNull())


def extract_money(df: DataFrame, col: str, name: str = "money", profile: str = "ledger") -> DataFrame:
    if profile == "typed":
        value = X.typed_money(F.col(col))
        return _with(df, name, value, F.col(col), value.isNull())
    parsed = df.withColumn("__m", X.ledger_money(F.col(col)))
    return _with(parsed, name, F.col("__m.value"), F.col("__m.raw"), F.col("__m.needs_review")).drop("__m")


def extract_ages(df: DataFrame, col: str, name: str = "ages", low: int = 15, high: int = 100, profile: str = "ledger") -> DataFrame:
    if profile == "typed":
        value = X.typed_age(F.col(col), low, high)
        return _with(df, name, value, F.col(col), value.isNull())
    value = X.ledger_ages(F.col(col), low, high)
    return _with(df, name, value, F.col(col), F.size(value) == 0)


def extract_ids(df: DataFrame, col: str, name: str = "id", profile: str = "ledger") -> DataFrame:
    """Adds ``<name>_legacy``, ``<name>_modern``, ``<name>_raw`` and ``<name>_needs_review``."""
    parsed = df.withColumn("__i", X.ledger_ids(F.col(col)) if profile == "ledger" else X.typed_ids(F.col(col)))
    raw = F.col("__i.raw") if profile == "ledger" else F.col(col)
    return parsed.withColumns(
        {
            f"{name}_legacy": F.col("__i.legacy"),
            f"{name}_modern": F.col("__i.modern"),
            f"{name}_raw": raw,
            f"{name}_needs_review": F.col("__i.legacy").isNull() & F.col("__i.modern").isNull(),
        }
    ).drop("__i")


def extract_dates(df: DataFrame, col: str, name: str = "date", profile: str = "ledger") -> DataFrame:
    if profile == "typed":
        value = X.typed_date(F.col(col))
        return _with(df, name, value, F.col(col), value.isNull())
    parsed = df.withColumn("__d", X.ledger_date(F.col(col)))
    return _with(parsed, name, F.col("__d.value"), F.col("__d.raw"), F.col("__d.needs_review")).drop("__d")


def name_value(column: Column) -> Column:
    """Prepared name with misread connector tokens replaced, NULL when empty."""
    return T.blank_to_null(T.replace_tokens(T.prepare_name(column), NAME_TOKENS))


# ---------------------------------------------------------------- people


def _placeholder(line: Column) -> Column:
    bracketed = line.contains("[") & line.contains("]") & line.contains(":")
    return line.contains("MOCK_OCR") | bracketed | ~line.rlike("[\\p{L}\\p{N}]")


def people(lines: Column, max_people: int = 2) -> Column:
    """array<struct(person_no, name_text, detail)> from the ordered lines of one cell.

    A person is a run of name lines followed by detail lines (identity number or age); a name
    line after a detail line starts the next person.  All of it happens inside the row.
    """
    kept = F.filter(lines, lambda l: ~_placeholder(l))

    def marked(line: Column) -> Column:
        # Every detail has two digits side by side.
        spot = lambda n: F.when(n.rlike("[0-9]{2}"), F.regexp_instr(n, F.lit(X.DETAIL_HINT))).otherwise(0)
        facts = T.let(X.numeric_text(line), lambda n: F.struct(n.alias("numeric"), spot(n).alias("spot")))

        def parts(f: Column) -> Column:
            detail = T.free_text(F.substring(f["numeric"], f["spot"], F.length(f["numeric"])))
            return F.struct(
                (f["spot"] > 0).alias("is_detail"),
                F.when(f["spot"] > 0, T.free_text(F.substring(line, F.lit(1), f["spot"] - 1))).otherwise(line).alias("name"),
                F.when(f["spot"] > 0, F.coalesce(T.blank_to_null(detail), line)).alias("detail"),
            )

        return T.let(facts, parts)

    def grouped(marks: Column) -> Column:
        size = F.size(marks)
        places = F.filter(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), lambda i: i <= size)
        is_detail = lambda i: F.coalesce(F.get(marks, i - 1)["is_detail"], F.lit(False))
        starts = F.filter(places, lambda i: (i == 1) | (~is_detail(i) & is_detail(i - 1)))

        def person(starts: Column, start: Column, number: Column) -> Column:
            following = F.coalesce(F.get(starts, number + 1), size + 1)

            def described(own: Column) -> Column:
                # A detail part in the very first line ends the name at once.
                names = F.filter(own, lambda m, i: (m["name"] != "") & (~m["is_detail"] | (i == 0)))
                details = F.filter(own, lambda m: m["is_detail"])
                return F.struct(
                    (number + 1).alias("person_no"),
                    F.array_join(names["name"], " ").alias("name_text"),
                    F.array_join(details["detail"], "\n").alias("detail"),
                )

            return T.let(F.slice(marks, start, following - start), described)

        return T.let(starts, lambda starts: F.slice(F.transform(starts, lambda s, n: person(starts, s, n)), 1, max_people))

    return T.let(F.transform(kept, marked), grouped)


def priced_lines(column: Column) -> Column:
    """struct(lines, money) of a cell: its lines, each read once, and ``ledger_money``."""
    return T.let(T.meaningful_lines(column), lambda lines: F.struct(lines.alias("lines"), X.money_of_lines(lines).alias("money")))


def unpriced_lines(priced: Column) -> Column:
    """Lines of ``priced_lines`` without those that equal its money line."""
    return T.let(priced, lambda f: F.filter(f["lines"], lambda l: ~l.eqNullSafe(f["money"]["raw"])))


def person_fields(person: Column) -> Column:
    """struct(name, id_legacy, id_modern, id_raw, age) of one person."""

    def fields(p: Column) -> Column:
        return F.struct(
            name_value(p["name_text"]).alias("name"), X.ledger_ids(p["detail"]).alias("ids"),
            F.try_element_at(X.ledger_ages(p["detail"]), F.lit(1)).alias("age"),
        )

    def flat(f: Column) -> Column:
        ids = f["ids"]
        return F.struct(
            f["name"].alias("name"), ids["legacy"].alias("id_legacy"), ids["modern"].alias("id_modern"), ids["raw"].alias("id_raw"), f["age"].alias("age")
        )

    return T.let(T.let(person, fields), flat)


def segment_people(df: DataFrame, col: str, key: Sequence[str], max_people: int = 2) -> DataFrame:
    """One row per person of a cell, with name, identity numbers and age; the money line is left out."""
    rows = df.select(*key, F.inline(people(unpriced_lines(priced_lines(F.col(col))), max_people)))
    return rows.select(*key, "person_no", F.inline(F.array(person_fields(F.struct("name_text", "detail")))), "detail")


def name_address(column: Column) -> Column:
    """struct(name, address, line_count): the first line is the name, the rest the address."""
    lines = F.transform(T.meaningful_lines(column), lambda l: T.free_text(T.replace_patterns(l, OFFICE_PATTERNS)))

    def parts(lines: Column) -> Column:
        rest = F.filter(F.slice(lines, 2, 1 << 30), lambda l: l != "")
        return F.struct(
            name_value(F.try_element_at(lines, F.lit(1))).alias("name"),
            T.blank_to_null(F.array_join(rest, "\n")).alias("address"),
            F.size(lines).alias("line_count"),
        )

    return T.let(lines, parts)


def extract_name_address(df: DataFrame, col: str, name: str = "name", address: str = "address") -> DataFrame:
    parsed = df.withColumn("__n", name_address(F.col(col)))
    return parsed.withColumns(
        {
            name: F.col("__n.name"),
            address: F.col("__n.address"),
            f"{address}_needs_review": F.col("__n.line_count") < 2,
        }
    ).drop("__n")


def levenshtein_snap(vocabulary: Sequence[str] = RELATIONS, cutoff: float = SNAP_CUTOFF) -> Snap:
    def snap(text: Column) -> Column:
        return snap_value(T.squeeze(F.regexp_replace(T.normalise_text(text), "[^A-Z ]", " ")), vocabulary, cutoff)

    return snap


def gestalt_snap(vocabulary: Sequence[str] = RELATIONS, cutoff: float = SNAP_CUTOFF) -> Snap:
    """Ratio of matching blocks, in Arrow batches; for results that must not differ by the metric."""
    return lambda text: gestalt.closest(T.squeeze(F.regexp_replace(T.normalise_text(text), "[^A-Z ]", " ")), vocabulary, cutoff)


def extract_guardian(
    df: DataFrame, name_col: str, relation_col: str, snap: Snap | None = None, name: str = "guardian", relation: str = "relation", rules: RuleTable = PHRASES
) -> DataFrame:
    """Guardian name and relation: phrase table, then a bracketed relation, then the longest suffix that snaps."""
    snap = snap or levenshtein_snap()
    lines = F.concat(*[T.meaningful_lines(T.normalise_text(F.col(c))) for c in (name_col, relation_col)])
    base = df.withColumn("__text", T.normalise_text(F.array_join(lines, " ")))
    bare = T.squeeze(F.regexp_replace(F.col("__text"), "\\([^)]*\\)", " "))
    base = base.withColumns(
        {
            "__phrase": rules.phrase("relation", F.col("__text")),
            "__bracket": snap(X.found(F.col("__text"), "\\(([^)]{2,})\\)", 1)),
            "__words": F.filter(F.split(bare, " "), lambda w: w != ""),
        }
    )
    # A shorter suffix is looked at only where nothing before it was found.
    open_ = F.col("__phrase").isNull() & F.col("__bracket").isNull()
    for n in (4, 3, 2, 1):
        suffix = F.when(open_ & (F.size("__words") >= n), F.array_join(F.slice("__words", -n, n), " "))
        base = base.withColumn(f"__s{n}", snap(suffix))
        open_ = open_ & F.col(f"__s{n}").isNull()
    taken = F.when(F.col("__bracket").isNotNull(), 0)
    for n in (4, 3, 2, 1):
        taken = taken.when(F.col(f"__s{n}").isNotNull(), n)
    taken = taken.otherwise(0)
    left = F.array_join(F.slice("__words", F.lit(1), F.size("__words") - taken), " ")
    left = F.regexp_replace(left, f"{T.NOT_AFTER_WORD}C\\s*(?=BAPA|LELAKI|SAUDARA)\\b", " ")
    helpers = ["__text", "__phrase", "__bracket", "__words", *[f"__s{n}" for n in (4, 3, 2, 1)]]
    return base.withColumns(
        {
            name: F.when(F.col("__phrase").isNull(), T.clean_name(left)),
            relation: F.coalesce("__phrase", "__bracket", "__s4", "__s3", "__s2", "__s1"),
        }
    ).drop(*helpers)


def numbered_names(column: Column, n: int = 2) -> Column:
    """Names of numbered people; without two markers the lines are split in the middle."""
    text = F.coalesce(column, F.lit(""))
    for marker, plain in NUMBER_MARKERS.items():
        text = F.replace(text, F.lit(marker), F.lit(plain))
    parts = F.struct(
        F.split(text, NUMBERED).alias("pieces"),
        F.filter(
            F.transform(T.meaningful_lines(text), lambda l: T.strip(F.regexp_replace(l, NUMBER_PREFIX, ""))), lambda l: l != ""
        ).alias("lines"),
    )

    def chosen(s: Column) -> Column:
        lines = s["lines"]
        numbered = F.filter(F.transform(F.slice(s["pieces"], 2, 1 << 30), T.free_text), lambda p: p != "")
        middle = F.greatest(F.lit(1), F.floor(F.size(lines) / 2).cast("int"))
        halves = F.array(
            F.array_join(F.slice(lines, F.lit(1), middle), " "),
            F.array_join(F.slice(lines, middle + 1, F.greatest(F.size(lines), F.lit(1))), " "),
        )
        by_line = F.when(F.size(lines) > 2, halves).otherwise(lines)
        return T.let(numbered, lambda n: F.when((F.size(s["pieces"]) > 2) & (F.size(n) >= 2), n).otherwise(by_line))

    names = F.transform(T.let(parts, chosen), T.clean_name)
    return F.slice(F.filter(names, lambda p: p.isNotNull()), 1, n)


def split_numbered(df: DataFrame, col: str, n: int = 2, prefix: str = "person_") -> DataFrame:
    named = df.withColumn("__n", numbered_names(F.col(col), n))
    return named.withColumns({f"{prefix}{i + 1}": F.get("__n", F.lit(i)) for i in range(n)}).drop("__n")


def ordinal(column: Column, default: int = 1) -> Column:
    """Integer of a text: the whole of it, or the last run of digits in it, or the default."""
    text = F.trim(column.cast("string"))
    runs = F.regexp_extract_all(text, F.lit("\\d+"), F.lit(0))
    whole = F.when(text.rlike("^-?\\d+$"), text.try_cast("int"))
    return F.coalesce(whole, F.try_element_at(runs, F.lit(-1)).try_cast("int"), F.lit(default))


def coerce_ordinal(df: DataFrame, col: str, default: int = 1, out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, ordinal(F.col(col), default))


# ---------------------------------------------------------------- records


def pivot_cells(cells: DataFrame, key: Sequence[str], names: Sequence[str] = CELLS, prefix: str = "raw_") -> DataFrame:
    """One row per record with one text column per known cell; a known list of cells needs no extra job."""
    picks = [F.max(F.when(F.col("cell") == c, F.col("text"))).alias(prefix + c) for c in names]
    return cells.groupBy(*key).agg(*picks)


def assemble_records(cells: DataFrame, key: Sequence[str], snap: Snap | None = None, rules: RuleTable = PHRASES) -> DataFrame:
    """Cells of a record to the typed record: fields, raw texts and issue codes.

    ``rules`` has the phrases of relations and remarks that stand for others.
    """
    wide = pivot_cells(cells, key, CELLS[:-1])
    raw = lambda c: F.coalesce(F.col(f"raw_{c}"), F.lit(""))
    wide = wide.withColumn("__priced", priced_lines(raw("suami_isteri")))
    wide = wide.withColumns(
        {
            "__money": F.col("__priced.money"),
            "__lines": F.size("__priced.lines"),
            "__people": F.transform(people(unpriced_lines(F.col("__priced"))), person_fields),
        }
    )
    wide = extract_guardian(wide, "raw_wali", "raw_hubungan_wali", snap, "nama_wali", "hubungan_wali", rules)
    wide = wide.withColumns(
        {
            "__office": name_address(raw("pendaftar")),
            "__names": numbered_names(raw("saksi")),
            "__nikah": X.ledger_date(raw("tarikh_nikah")),
            "__keluar": X.ledger_date(raw("tarikh_keluar")),
        }
    )
    remark = T.blank_to_null(T.free_text(raw("remarks")))
    business: dict[str, Column] = {"bil": X.ledger_serial(raw("bil"))}
    for i, who in enumerate(("suami", "isteri")):
        one = F.get("__people", F.lit(i))
        business |= {
            f"nama_{who}": one["name"],
            f"ic_lama_{who}": one["id_legacy"],
            f"ic_baru_{who}": one["id_modern"],
            f"id_{who}_raw": one["id_raw"],
            f"umur_{who}": one["age"],
        }
    business |= {
        "mas_kahwin": F.col("__money.value"),
        "mas_kahwin_raw": F.col("__money.raw"),
        "nama_pendaftar": F.col("__office.name"),
        "alamat_pendaftar": F.col("__office.address"),
        "nama_wali": F.col("nama_wali"),
        "hubungan_wali": F.col("hubungan_wali"),
        "saksi_1": F.get("__names", F.lit(0)),
        "saksi_2": F.get("__names", F.lit(1)),
        "tarikh_nikah": F.col("__nikah.value"),
        "tarikh_nikah_raw": F.col("__nikah.raw"),
        "tarikh_keluar": F.col("__keluar.value"),
        "tarikh_keluar_raw": F.col("__keluar.raw"),
        "remarks": F.coalesce(rules.phrase("remarks", remark), remark),
    }
    texts = {f"raw_{c}": T.blank_to_null(F.col(f"raw_{c}")) for c in CELLS[:-1]}
    full = wide.select(
        *key, *[v.alias(k) for k, v in business.items()], *[v.alias(k) for k, v in texts.items()],
        F.col("__lines").alias("__spouse_lines"), F.size("__people").alias("__people"), F.col("__money.needs_review").alias("__bare_money"),
        F.col("__office.line_count").alias("__office_lines"), F.col("__nikah.needs_review").alias("__nikah"), F.col("__keluar.needs_review").alias("__keluar"),
    )
    seen = F.col("__spouse_lines") > 0
    code = lambda condition, text: F.when(condition, F.lit(text))
    odd = lambda c: F.col(c).isNotNull() & (X.suspicious_name(F.col(c)) | F.col(c).rlike("[^A-Z\\s.'/()-]"))
    no_id = lambda who: F.col(f"ic_lama_{who}").isNull() & F.col(f"ic_baru_{who}").isNull()
    issues = F.array_compact(
        F.array(
            code(~seen, "spouse_cell_empty"),
            code(seen & (F.col("__people") < 2), "spouse_names_incomplete"),
            code(seen & F.col("mas_kahwin").isNotNull() & F.col("__bare_money"), "mas_kahwin_missing_rm"),
            code(seen & F.col("umur_suami").isNull(), "umur_suami_missing"),
            code(seen & F.col("umur_isteri").isNull(), "umur_isteri_missing"),
            code(seen & no_id("suami"), "id_suami_missing"),
            code(seen & no_id("isteri"), "id_isteri_missing"),
            code(seen & odd("nama_suami"), "nama_suami_suspicious"),
            code(seen & odd("nama_isteri"), "nama_isteri_suspicious"),
            code(F.col("__office_lines") == 0, "pendaftar_empty"),
            code(F.col("__office_lines") == 1, "pendaftar_address_missing"),
            code(F.col("hubungan_wali").isNull(), "wali_relationship_missing"),
            code(F.col("nama_wali").isNull(), "wali_name_missing"),
            code(F.col("saksi_1").isNull(), "saksi_missing"),
            code(F.col("saksi_1").isNotNull() & F.col("saksi_2").isNull(), "saksi_2_missing"),
            code(F.col("__nikah"), "tarikh_nikah_unparsed"),
            code(F.col("__keluar"), "tarikh_keluar_unparsed"),
        )
    )
    status = F.when(F.size("review_reason") == 0, F.lit("OK")).otherwise(F.lit("REVIEW"))
    helpers = ["__spouse_lines", "__people", "__bare_money", "__office_lines", "__nikah", "__keluar"]
    return full.withColumn("review_reason", issues).withColumn("status_review", status).drop(*helpers)


# Regions of the typed form that hold plain text.
TYPED_TEXT_FIELDS = (
    "nama_suami", "nama_isteri", "nama_pendaftar", "alamat_pendaftar", "nama_wali", "hubungan_wali", "saksi_1", "saksi_2",
)
TYPED_FIELDS = (
    "bil", "nama_suami", "id_suami", "umur_suami", "nama_isteri", "id_isteri", "umur_isteri", "mas_kahwin",
    "nama_pendaftar", "alamat_pendaftar", "nama_wali", "hubungan_wali", "saksi_1", "saksi_2", "tarikh_nikah",
)


def typed_value(field: str, text: Column) -> Column:
    """What the text of a region of the typed form says; of identity numbers struct(legacy, modern)."""
    if field == "bil":
        value = X.typed_serial(text)
    elif field.startswith("id_"):
        value = X.typed_ids(text)
    elif field.startswith("umur_"):
        value = X.typed_age(text)
    elif field == "mas_kahwin":
        value = X.typed_money(text)
    else:
        value = X.typed_date(text) if field == "tarikh_nikah" else best_line(text, field)
    return F.when(text.isNotNull(), value)


def typed_record(value: Callable[[str], Column], text: Callable[[str], Column]) -> dict[str, Column]:
    """Columns of the typed record from the values and texts of its fields."""
    out: dict[str, Column] = {"bil": value("bil")}
    for who in ("suami", "isteri"):
        ids = value(f"id_{who}")
        out |= {
            f"nama_{who}": value(f"nama_{who}"),
            f"ic_lama_{who}": ids["legacy"],
            f"ic_baru_{who}": ids["modern"],
            f"id_{who}_raw": text(f"id_{who}"),
            f"umur_{who}": value(f"umur_{who}"),
        }
    out |= {"mas_kahwin": value("mas_kahwin"), "mas_kahwin_raw": text("mas_kahwin")}
    out |= {f: value(f) for f in TYPED_TEXT_FIELDS if not f.startswith(("nama_suami", "nama_isteri"))}
    out |= {"tarikh_nikah": value("tarikh_nikah"), "tarikh_nikah_raw": text("tarikh_nikah")}
    first = lambda *names: F.coalesce(*[T.blank_to_null(text(n)) for n in names])
    out |= {
        "raw_bil": text("bil"),
        "raw_suami_isteri": first("nama_suami", "id_suami", "nama_isteri", "id_isteri"),
        "raw_pendaftar": first("nama_pendaftar", "alamat_pendaftar"),
        "raw_wali": text("nama_wali"),
        "raw_hubungan_wali": text("hubungan_wali"),
        "raw_saksi": first("saksi_1", "saksi_2"),
        "raw_tarikh_nikah": text("tarikh_nikah"),
    }
    return out


def assemble_typed(fields: DataFrame, key: Sequence[str]) -> DataFrame:
    """Region texts of a typed form (key, field, raw_text) to the typed record."""
    picks = [F.max(F.when(F.col("field") == f, F.col("raw_text"))).alias(f"__{f}") for f in TYPED_FIELDS]
    wide = fields.groupBy(*key).agg(*picks)
    wide = wide.withColumns({f"__v_{f}": typed_value(f, F.col(f"__{f}")) for f in TYPED_FIELDS})
    out = typed_record(lambda f: F.col(f"__v_{f}"), lambda f: F.col(f"__{f}"))
    return wide.select(*key, *[v.alias(k) for k, v in out.items()])
