"""Schemas of the record model and its edge tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Header name of every field of a record, in record order, and the public selections.
EXPORT_FIELDS = {
    "Bil": "bil", "Nama Suami": "nama_suami", "IC Lama Suami": "ic_lama_suami", "IC Baru Suami": "ic_baru_suami", "ID Suami Raw": "id_suami_raw",
    "Umur Suami": "umur_suami", "Nama Isteri": "nama_isteri", "IC Lama Isteri": "ic_lama_isteri", "IC Baru Isteri": "ic_baru_isteri",
    "ID Isteri Raw": "id_isteri_raw", "Umur Isteri": "umur_isteri", "Mas Kahwin": "mas_kahwin", "Mas Kahwin Raw": "mas_kahwin_raw",
    "Nama Pendaftar": "nama_pendaftar", "Alamat Pendaftar": "alamat_pendaftar", "Nama Wali": "nama_wali", "Hubungan Wali": "hubungan_wali",
    "Saksi 1": "saksi_1", "Saksi 2": "saksi_2", "Tarikh Nikah": "tarikh_nikah", "Tarikh Nikah Raw": "tarikh_nikah_raw",
    "Tarikh Keluar": "tarikh_keluar", "Tarikh Keluar Raw": "tarikh_keluar_raw", "Remarks": "remarks", "Confidence": "confidence",
    "Status Review": "status_review", "Review Reason": "review_reason", "Source File": "source_file", "Source Page": "source_page",
    "Source Record": "source_record", "Crop Folder": "crop_folder", "Raw Bil": "raw_bil", "Raw Suami Isteri": "raw_suami_isteri",
    "Raw Pendaftar": "raw_pendaftar", "Raw Wali": "raw_wali", "Raw Hubungan Wali": "raw_hubungan_wali", "Raw Saksi": "raw_saksi",
    "Raw Tarikh Nikah": "raw_tarikh_nikah", "Raw Tarikh Keluar": "raw_tarikh_keluar", "Raw Remarks": "raw_remarks",
    "Raw OCR JSON": "raw_ocr_json", "Created At": "created_at", "Updated At": "updated_at",
}
STATUS_ALIAS = "Status"
PUBLIC_COLUMNS = (
    "Bil", "Nama Suami", "IC Lama Suami", "IC Baru Suami", "Umur Suami", "Nama Isteri", "IC Lama Isteri", "IC Baru Isteri", "Umur Isteri",
    "Mas Kahwin", "Nama Pendaftar", "Alamat Pendaftar", "Nama Wali", "Hubungan Wali", "Saksi 1", "Saksi 2", "Tarikh Nikah", "Tarikh Keluar",
    "Remarks", "Confidence", "Status", "Created At", "Updated At",
)
PUBLIC_CSV_COLUMNS = PUBLIC_COLUMNS[:-2]
TYPED_CSV_COLUMNS = (
    "Bil", "Nama Suami", "IC Lama Suami", "IC Baru Suami", "Umur Suami", "Nama Isteri", "IC Lama Isteri", "IC Baru Isteri", "Umur Isteri",
    "Mas Kahwin", "Nama Pendaftar", "Alamat Pendaftar", "Nama Wali", "Hubungan Wali", "Saksi 1", "Saksi 2", "Tarikh Nikah", "Tarikh Keluar",
    "Source File", "Processing Status", "Review Required", "Failed Fields", "Retry Count", "Error Message",
)

_TYPES = {
    "umur_suami": T.IntegerType(),
    "umur_isteri": T.IntegerType(),
    "source_page": T.IntegerType(),
    "confidence": T.DoubleType(),
    "review_reason": T.ArrayType(T.StringType()),
}
RECORD = T.StructType([T.StructField(f, _TYPES.get(f, T.StringType())) for f in EXPORT_FIELDS.values()])

BOX = [T.StructField(c, T.DoubleType()) for c in ("x1", "y1", "x2", "y2")]
WORDS = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        T.StructField("page_no", T.IntegerType()),
        T.StructField("word_ix", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        *BOX,
    ]
)
CELLS = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        T.StructField("page_no", T.IntegerType()),
        T.StructField("record_ix", T.IntegerType()),
        T.StructField("cell", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("avg_conf", T.DoubleType()),
    ]
)

_VERTEX = "array<struct<x:double,y:double>>"
_WORD = f"struct<symbols:array<struct<text:string>>,confidence:double,bounding_box:struct<vertices:{_VERTEX}>>"
ANNOTATION_PAGES = (
    f"array<struct<width:int,height:int,blocks:array<struct<paragraphs:array<struct<confidence:double,words:array<{_WORD}>>>>>>>"
)
