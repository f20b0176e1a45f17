"""Typed form flow: words of two-page documents to output rows with a status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.operators import export, extract, validate, words
from recordforge.operators.words import Anchor, Region
from recordforge.session import cut, stored

KEY = ["doc_id"]


def typed_results(
    tokens: DataFrame,
    pages: DataFrame,
    regions: Sequence[Region],
    anchors: Sequence[Anchor],
    threshold: float = 0.5,
    expected_pages: int = 2,
    retries: DataFrame | None = None,
    max_retry: int = 6,
) -> DataFrame:
    """One row per document: record, diagnostics, retry list and status.

    ``pages`` has ``doc_id``, ``page_no``, ``n_words`` and ``error``; every document only meets
    its own pages because all joins carry its id.
    """
    # One small row per page; several branches read it.
    transforms = cut(words.estimate_transform(pages, words.match_phrases(tokens, anchors)))
    # Words of the regions are read for their bands and for their lines.
    fields = words.fields_from_regions(tokens, transforms, regions, cut=stored)
    raw = cut(fields.select("doc_id", "field", "raw_text", "confidence"))
    return results_of_fields(raw, pages, threshold, expected_pages, retries, max_retry)


def results_of_fields(
    raw: DataFrame, pages: DataFrame, threshold: float = 0.5, expected_pages: int = 2, retries: DataFrame | None = None, max_retry: int = 6
) -> DataFrame:
    """``typed_results`` from the region texts (doc_id, field, raw_text, confidence).

    ``retries`` are second readings of fields, in the same columns; those of fields on a document's retry list replace a
    first reading that they improve, and the record is assembled and checked again.
    """
    complete = words.page_completeness(pages.select("doc_id", "page_no", (F.col("n_words") > 0).alias("has_ocr"), "error"), expected=expected_pages)
    # Documents meet their packed texts before anything is made of them: all the rest is made row by row, and nothing wide is dealt or sorted.
    # Rows per field are made by explode, whose size the optimizer takes for that of the files: joins are told to sort and not to broadcast.
    docs = complete.select("doc_id", "document_error").join(validate.field_entries(raw, KEY).hint("merge"), KEY, "left")
    if retries is not None:
        docs = docs.join(validate.field_entries(retries, KEY, "__again").hint("merge"), KEY, "left")
        docs = _retried(_judged(docs, "__a", "__entries", threshold), threshold, max_retry)
        docs = _judged(docs, "__r", "__taken", threshold, known="__a")
        count = F.coalesce(F.size(F.filter("__taken", lambda e: e["accepted"])), F.lit(0)).cast("long")
    else:
        docs, count = _judged(docs, "__r", "__entries", threshold), F.lit(0).cast("long")
    of = lambda kind: lambda f: F.col(f"__r{kind}_{f}")
    record = extract.typed_record(of("value"), lambda f: F.col(f"__rpick_{f}")["raw_text"])
    known = F.col("__entries").isNotNull()
    diagnosed = validate.diagnosed(F.col("__rvalid"), of("text"), of("confidence"), threshold, max_retry)
    diagnosed["failed_fields"] = F.when(known, diagnosed["failed_fields"]).otherwise(F.array().cast("array<string>"))
    diagnosed |= {c: F.when(known, diagnosed[c]) for c in ("diagnostics", "retry_fields")}
    meaningful = validate.meaningful_fields(lambda name: record[name])
    filled = docs.select("doc_id", "document_error", *[c.alias(n) for n, c in record.items()], meaningful.alias("meaningful_field_count"), *[c.alias(n) for n, c in diagnosed.items()], F.when(known, count).otherwise(0).alias("retry_count"))
    return validate.document_status(filled)


def _judged(docs: DataFrame, name: str, entries: str, threshold: float, known: str | None = None) -> DataFrame:
    """Adds to documents, of every field, its text, value and confidence, and ``<name>valid``, the verdicts in the order of the fields.

    ``known`` is the name of a reading before: a document without entries keeps its texts, and a field with the same text what it said.
    """
    out = validate.with_picks(docs, entries, f"{name}pick_")
    if known is not None:
        out = out.withColumns({f"{name}pick_{f}": F.when(F.col(entries).isNull(), F.col(f"{known}pick_{f}")).otherwise(F.col(f"{name}pick_{f}")) for f in validate.TYPED_FIELDS})
    raw = lambda n, f: F.col(f"{n}pick_{f}")["raw_text"]

    def made(kind: str, f: str, column: Column) -> Column:
        return column if known is None else F.when(raw(name, f).eqNullSafe(raw(known, f)), F.col(f"{known}{kind}_{f}")).otherwise(column)

    out = out.withColumns({f"{name}value_{f}": made("value", f, extract.typed_value(f, raw(name, f))) for f in validate.TYPED_FIELDS})
    record = extract.typed_record(lambda f: F.col(f"{name}value_{f}"), lambda f: raw(name, f))
    columns = {f"{name}text_{f}": validate.read_text(f, F.col(f"{name}pick_{f}")) for f in validate.TYPED_FIELDS}
    columns |= {f"{name}confidence_{f}": F.coalesce(F.col(f"{name}pick_{f}")["confidence"], F.lit(0.0)) for f in validate.TYPED_FIELDS}
    columns |= {f"{name}ok_{f}": made("ok", f, F.coalesce(validate.form_ok(f, lambda c: record[c]), F.lit(False))) for f in validate.TYPED_FIELDS}
    out = out.withColumns(columns)
    of = lambda kind, f: F.col(f"{name}{kind}_{f}")
    return out.withColumn(f"{name}valid", F.array(*[validate.field_valid(f, of("ok", f), of("text", f), of("confidence", f), threshold) for f in validate.TYPED_FIELDS]))


def _retried(docs: DataFrame, threshold: float, max_retry: int) -> DataFrame:
    """Adds ``__taken``, the region texts of a document after the second reading, with those that were ``accepted``; null without second readings.

    Whether a reading is valid depends on its own field only, so all second readings of a document are judged at once.
    As ``candidates.prefer_retry``, row by row: at most ``max_retry`` second readings of failed fields, by the order of the fields.
    """
    fields = F.array(*[F.lit(f) for f in validate.TYPED_FIELDS])
    verdict = lambda name, f: F.element_at(F.col(f"{name}valid"), F.array_position(fields, f).cast("int"))
    docs = docs.withColumn("__wanted", F.slice(validate.failed_names(F.col("__avalid")), 1, max_retry))
    docs = docs.withColumn("__second", F.filter(F.coalesce("__again", F.filter("__entries", lambda e: F.lit(False))), lambda e: F.array_contains("__wanted", e["field"])))
    docs = _judged(docs, "__b", "__second", threshold)
    place = lambda e: F.struct(
        F.array_position(fields, e["field"]).alias("place"), e["raw_text"].alias("raw_text"), e["confidence"].alias("confidence"),
        e["field"].alias("field"), verdict("__b", e["field"]).alias("valid"),
    )
    docs = docs.withColumn("__offered", F.slice(F.array_sort(F.transform("__second", place)), 1, max_retry))
    entry = lambda f, text, confidence: F.struct(f.alias("field"), text.alias("raw_text"), confidence.cast("double").alias("confidence"))
    missing = F.filter("__wanted", lambda f: ~F.exists("__entries", lambda e: e["field"] == f))
    first = F.concat(
        F.transform(F.filter("__entries", lambda e: F.array_contains(fields, e["field"])), lambda e: entry(e["field"], e["raw_text"], F.coalesce(e["confidence"], F.lit(0.0)))),
        F.transform(missing, lambda f: entry(f, F.lit(None).cast("string"), F.lit(0.0))),
    )

    def better(e: Column, o: Column) -> Column:
        return F.coalesce(o["valid"] & (~verdict("__a", e["field"]) | (o["confidence"] >= e["confidence"] + F.lit(0.05))), F.lit(False))

    def taken(e: Column) -> Column:
        kept = F.struct(e["raw_text"].alias("raw_text"), e["confidence"].alias("confidence"), F.lit(False).alias("accepted"), e["field"].alias("field"))
        new = lambda o: F.struct(o["raw_text"].alias("raw_text"), o["confidence"].cast("double").alias("confidence"), F.lit(True).alias("accepted"), e["field"].alias("field"))
        mine = F.filter("__offered", lambda o: o["field"] == e["field"])
        return F.when(F.exists("__offered", lambda o: o["field"] == e["field"]), F.transform(mine, lambda o: F.when(better(e, o), new(o)).otherwise(kept))).otherwise(F.array(kept))

    return docs.withColumn("__taken", F.when(F.size("__offered") > 0, F.flatten(F.transform(first, taken))))


def typed_output(results: DataFrame, sources: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """The output rows of the form; ``sources`` gives each document its ``source_file`` and ``processed_at``."""
    rows = results.join(sources.select(*KEY, "source_file", "processed_at").hint("merge"), KEY).withColumns(
        {"processing_status": F.col("status"), "review_required": F.col("status") == "REVIEW_REQUIRED", "error_message": F.col("document_error")}
    )
    return export.typed_rows(rows, existing, ["processed_at", *KEY])
