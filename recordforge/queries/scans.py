"""Sources and sinks."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge import fixtures
from recordforge.functions.scan import steps
from recordforge.queries import query
from recordforge.queries.store import LEDGER, ledger
from recordforge.sources import annotations, files, records


LISTING = "select doc_id, source||'/v1.2/'||cast(doc_id as {s})||case doc_id%5 when 0 then '.PDF' when 1 then '.jpeg' when 2 then '.txt' when 3 then '' else '.tif.bak' end as path, n_chars as length from documents"


@query("io1_list_documents", f"select * from ({LISTING.format(s='varchar')}) where doc_id%5 in (0, 1)")
def io1_list_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.supported_documents(fixtures.sql(spark, sf_dir, LISTING.format(s="string")))


@query("io2_content_hash", "select doc_id, sha256(text) as content_hash from documents")
def io2_content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.content_hash(fixtures.table(spark, sf_dir, "documents").select("doc_id", "text"), "text").drop("text")


@query("io3_skip_done", f"with {LEDGER} select 'file_'||c_custkey as path from customer where 'file_'||c_custkey not in (select path from l where status='DONE')")
def io3_skip_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fixtures.sql(spark, sf_dir, "select 'file_'||cast(c_custkey as string) as path from customer")
    return files.skip_done(found, ledger(spark, sf_dir), ["DONE"])




@query(
    "io4_unique_names",
    f"""select page_id, name, case when i=0 then name else left(name, -4)||'_'||i||'.pdf' end as unique_name from
 (select *, row_number() over (partition by name order by page_id)-1 as i from (select page_id, 'doc_'||regexp_extract(url, '/([a-z]+)/[0-9]+', 1)||'.pdf' as name from pages))""",
)
def io4_unique_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = fixtures.table(spark, sf_dir, "pages")
    named = pages.select("page_id", F.concat(F.lit("doc_"), F.regexp_extract("url", "/([a-z]+)/[0-9]+", 1), F.lit(".pdf")).alias("name"))
    return files.unique_names(named, "name", ["page_id"], [steps("page_id", 65536)])


@query(
    "io5_safe_names",
    """with p as (select page_id, page_id%3 as page, 1+page_id%2 as pages, list_filter(string_split(regexp_replace(url, '([^/])\\.[^./]+$', '\\1'), '/'), lambda x: x<>'') as parts from pages),
 s as (select *, array_to_string(list_transform(parts, lambda x: coalesce(nullif(trim(regexp_replace(x, '[^A-Za-z0-9._-]+', '_', 'g'), '._'), ''), 'page')), '__') as stem from p)
 select page_id, case when pages>1 then stem||'_page_'||lpad((page+1)::varchar, 3, '0') else stem end as safe_name from s""",
)
def io5_safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = fixtures.sql(spark, sf_dir, "select page_id, url, page_id%3 as page, 1+page_id%2 as pages from pages")
    return files.safe_names(pages, "url", "page", "pages").select("page_id", "safe_name")


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as recogniser output: a block per line, a word per token, a symbol per character."""
    vertex = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    def word(token, t, l):
        return F.struct(
            F.transform(F.split(token, ""), lambda c: F.struct(c.alias("text"))).alias("symbols"),
            (F.lit(0.5) + (t % 32) / 64).alias("confidence"),
            F.struct(F.array(vertex(t * 50 + 40, l * 20), vertex(t * 50, l * 20 + 12), vertex(t * 50, l * 20), vertex(t * 50 + 40, l * 20 + 12)).alias("vertices")).alias("bounding_box"),
        )

    def block(line, l):
        words = F.transform(F.split(line, " "), lambda token, t: word(token, t, l))
        return F.struct(F.array(F.struct(F.lit(0.5).alias("confidence"), words.alias("words"))).alias("paragraphs"))

    blocks = F.transform(F.split("text", "\n"), block)
    page = F.struct(F.lit(1000).alias("width"), F.lit(0).alias("height"), blocks.alias("blocks"))
    return fixtures.table(spark, sf_dir, "documents").select("doc_id", F.array(page).alias("pages"))


@query("io6_explode_annotations", "select doc_id, cast(ln as bigint)*1000000000000+tn as word_ix, text, round(0.5+(tn%32)/64, 6) as confidence, x1, y1, x2, y2 from fx_words")
def io6_explode_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = annotations.explode_annotations(tree(spark, sf_dir), ["doc_id"])
    return words.select("doc_id", "word_ix", "text", F.round("confidence", 6).alias("confidence"), "x1", "y1", "x2", "y2")


@query(
    "io6_explode_paragraphs",
    "select doc_id, cast(ln as bigint)*1000000 as line_ix, string_agg(text, ' ' order by tn) as text, round(avg(0.5+(tn%32)/64), 6) as confidence, min(x1) as x1, min(y1) as y1, max(x2) as x2, max(y2) as y2 from fx_words group by doc_id, ln",
)
def io6_explode_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = annotations.explode_paragraphs(tree(spark, sf_dir), ["doc_id"])
    return rows.select("doc_id", "line_ix", "text", F.round("confidence", 6).alias("confidence"), "x1", "y1", "x2", "y2")


@query(
    "io7_explode_parallel_arrays",
    """with t as (select doc_id, string_split(text, ' ') as w from documents), e as (select doc_id, unnest(range(len(w))) as i, unnest(w) as text, len(w) as n from t)
 select doc_id, i::int as word_ix, text, case when i<n-1 then (i%10)/10.0 else 0 end::double as confidence, case when i<n-2 then i*2.0 end::double as x1, case when i<n-2 then i*3.0 end::double as y2 from e""",
)
def io7_explode_parallel_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = fixtures.table(spark, sf_dir, "documents").select("doc_id", F.split("text", " ").alias("rec_texts"))
    # The last score and the last two boxes are missing.
    n = F.size("rec_texts")
    arrays = texts.withColumns(
        {
            "rec_scores": F.transform(F.slice("rec_texts", F.lit(1), n - 1), lambda _, i: (i % 10) / 10),
            "rec_boxes": F.transform(F.slice("rec_texts", F.lit(1), F.greatest(n - 2, F.lit(0))), lambda _, i: F.array(i * 2.0, i * 1.0, i * 4.0, i * 3.0)),
        }
    )
    return annotations.explode_parallel_arrays(arrays, ["doc_id"]).select("doc_id", "word_ix", "text", "confidence", "x1", "y2")


EXPORTED = """select source_file as `Source File`, cast(source_page as string)||'.0' as `Source Page`, ' '||cast(source_record as string)||' ' as `Source Record`, status as `Status`,
 case when source_record%3=0 then 'bad' else cast(confidence as string) end as `Confidence`, case when source_record%2=0 then ' a ;; b' end as `Review Reason`, case when source_record%5=0 then 'x' else '30' end as `Umur Suami` from fx_records"""


@query(
    "io8_read_records",
    """select source_file, source_page, source_record::varchar as source_record, status as status_review, case when source_record%3<>0 then confidence end as confidence,
 case when source_record%2=0 then 'a|b' else '' end as review_reason, case when source_record%5<>0 then 30 end as umur_suami from fx_records""",
)
def io8_read_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = records.parse_records(fixtures.sql(spark, sf_dir, EXPORTED))
    return parsed.select("source_file", "source_page", "source_record", "status_review", "confidence", F.array_join("review_reason", "|").alias("review_reason"), "umur_suami")


@query(
    "io10_write_parts",
    """select source_record, source_file, ((row_number() over (order by source_file, source_page, source_record)-1)//500)+1 as part_no,
 'export_'||lpad((((row_number() over (order by source_file, source_page, source_record)-1)//500)+1)::varchar, 3, '0') as part from fx_records""",
)
def io10_write_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.view(spark, sf_dir, "fx_records").select("source_file", "source_page", "source_record")
    chunk = [F.col("source_file"), F.col("source_page"), steps("source_record", 65536)]
    return records.part_numbers(rows, 500, ["source_file", "source_page", "source_record"], chunk, "export").drop("source_page")


@query("io13_load_store", "select source_record as id, source_file, source_page, source_record, status as status_review, confidence, 'a;b' as review_reason from fx_records")
def io13_load_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.view(spark, sf_dir, "fx_records")
    stored = rows.select(
        F.col("source_record").alias("id"), "source_file", "source_page", "source_record",
        F.to_json(F.struct(F.col("status").alias("status_review"), "confidence", F.array(F.lit("a"), F.lit("b")).alias("review_reason"), F.lit(1).alias("unknown"))).alias("raw_record"),
    )
    loaded = records.load_store(stored)
    return loaded.select("id", "source_file", "source_page", "source_record", "record.status_review", "record.confidence", F.array_join("record.review_reason", ";").alias("review_reason"))
