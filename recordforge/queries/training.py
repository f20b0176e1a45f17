"""Training export: documents as records, their attributes as cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge import fixtures
from recordforge.functions.scan import steps
from recordforge.operators import training as T
from recordforge.queries import query

CELLS = "select doc_id, c as cell, case c when 'lang' then lang when 'source' then case when doc_id%5=0 then ' ' else source end else cast(n_chars as {s}) end as label, c='lang' and corrected as corrected_label from fx_reviews {explode}"
SPARK_CELLS = CELLS.format(s="string", explode="lateral view explode(array('lang', 'source', 'n_chars')) z as c")
DUCK_CELLS = CELLS.format(s="varchar", explode="cross join (values ('lang'), ('source'), ('n_chars')) as z(c)")
EXAMPLES = f"""e as (select c.doc_id, c.cell, trim(label) as label_text, corrected_label as used_corrected_label, verified,
 case when ('0x'||left(sha256('file|'||c.doc_id), 8))::bigint/4294967295.0::double < 0.2::double then 'val' else 'train' end as dataset_split from ({DUCK_CELLS}) c join fx_reviews r on c.doc_id=r.doc_id where verified and trim(label)<>'' and c.doc_id%7<>0),
 n as (select *, row_number() over (order by doc_id, cell) as example_no from e)"""


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    bundles = fixtures.sql(spark, sf_dir, "select doc_id, 'file' as file, verified from fx_reviews")
    labels = fixtures.sql(spark, sf_dir, SPARK_CELLS)
    return bundles, labels.where("doc_id%7<>0").select("doc_id", "cell"), labels


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.hash_split(T.training_examples(*_inputs(spark, sf_dir), ["doc_id"]), ["file", "doc_id"], 0.2)


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.number_examples(examples(spark, sf_dir), ["doc_id", "cell"], [steps("doc_id", 4096)])


@query("t1_training_examples", f"with {EXAMPLES} select doc_id, cell, label_text, used_corrected_label, verified from e")
def t1_training_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return examples(spark, sf_dir).select("doc_id", "cell", "label_text", "used_corrected_label", "verified")


@query(
    "t1_skipped_counts",
    f"select (select count_if(not verified) from fx_reviews) as skipped_unverified_records, count(*) as skipped_empty_labels from ({DUCK_CELLS}) c join fx_reviews r on c.doc_id=r.doc_id where verified and trim(label)='' and c.doc_id%7<>0",
)
def t1_skipped_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.skipped_counts(*_inputs(spark, sf_dir), ["doc_id"])


@query(
    "t2_hash_split",
    "select source_file, source_page, source_record, case when ('0x'||left(sha256(source_file||'|'||source_page||'|'||source_record), 8))::bigint/4294967295.0::double < 0.1::double then 'val' else 'train' end as dataset_split from fx_records",
)
def t2_hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["source_file", "source_page", "source_record"]
    return T.hash_split(fixtures.view(spark, sf_dir, "fx_records").select(*keys), keys, 0.1)


@query("t3_number_examples", f"with {EXAMPLES} select doc_id, cell, example_no, 'crops/'||cell||'/'||lpad(example_no::varchar, 6, '0')||'.jpg' as image_path from n")
def t3_number_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(spark, sf_dir).select("doc_id", "cell", "example_no", "image_path")


@query("t4_escape_tsv", "select doc_id, replace(replace(replace(replace(text, ' de ', '\\'||chr(9)), '\\', '\\\\'), chr(9), '\\t'), chr(10), '\\n') as text from documents")
def t4_escape_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fixtures.table(spark, sf_dir, "documents").select("doc_id", F.replace(F.col("text"), F.lit(" de "), F.lit("\\\t")).alias("text"))
    return T.escape_tsv(docs, "text")


@query(
    "t5_manifest",
    f"""with {EXAMPLES} select doc_id, cell, 'crops/'||cell||'/'||lpad(example_no::varchar, 6, '0')||'.jpg' as image_path, dataset_split, label_text, 13 as n_keys from n""",
)
def t5_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = numbered(spark, sf_dir).withColumns({"source_file": F.col("file"), "source_record": F.col("doc_id").cast("string")})
    lines = T.manifest(source)
    get = lambda k: F.get_json_object("value", f"$.{k}").alias(k)
    return lines.select(
        F.get_json_object("value", "$.source_record").cast("long").alias("doc_id"), F.get_json_object("value", "$.cell_name").alias("cell"),
        get("image_path"), get("dataset_split"), get("label_text"), F.size(F.json_object_keys("value")).alias("n_keys"),
    )


@query("t6_training_stats", f"with {EXAMPLES} select coalesce(dataset_split, 'ALL') as dataset_split, coalesce(cell, 'ALL') as cell, count(*) as examples from e group by cube(dataset_split, cell)")
def t6_training_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.training_stats(examples(spark, sf_dir))
