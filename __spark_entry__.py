"""

``entry(spark)`` runs the flagship query (industry totals with the grand
total) on /root/testdata/sf0.001.  ``queries()`` maps each operator of
the same query in DuckDB SQL.  Job postings are not among the driver
tables, so posting queries read the view of ``hiremart.sources.orders_view``
built from ``orders`` (FIXTURES.md §1); both engines build it from the same
value lists.  Every query reads whole tables and whole texts.
"""

from __future__ import annotations

import importlib
import importlib.util
import os
import sys
import unicodedata
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hiremart.functions import buckets as B  # noqa: E402
from hiremart.functions import provinces as PV  # noqa: E402
from hiremart.functions import text as TX  # noqa: E402
from hiremart.functions.predicates import INDUSTRY_TOTAL_LABEL, NOT_DISPLAYED, NOT_DISPLAYED_RAW  # noqa: E402
from hiremart.operators import aggregates as AG  # noqa: E402
from hiremart.operators.joins import left_join_default, lookup_join  # noqa: E402
from hiremart.operators.materialize import materialize, repartitioned, shared_dir  # noqa: E402
from hiremart.operators.numbering import dense_index, input_order_ids, with_source  # noqa: E402
from hiremart.operators.ordering import placed, sorted_ranges  # noqa: E402
from hiremart.plans import features as FT  # noqa: E402
from hiremart.plans import industry as IN  # noqa: E402
from hiremart.plans import location as LO  # noqa: E402
from hiremart.plans import marts as MA  # noqa: E402
from hiremart.plans import requirements as RQ  # noqa: E402
from hiremart.plans.job import data_quality_report  # noqa: E402
from hiremart.plans.postings import enrich  # noqa: E402
from hiremart.schemas import JOB_BASE_CLEAN, POSTING_JSON_KEYS, RAW_TEXT_COLUMNS  # noqa: E402
from hiremart.session import ship_package  # noqa: E402
from hiremart.sources.orders_view import LOCATIONS, postings_view, postings_view_sql  # noqa: E402
from hiremart.sources.postings import parse_posting_lines, read_postings_jsonl, valid_postings  # noqa: E402
from hiremart.sources.tables import TSV_OPTIONS, ragged_fields, read_tsv  # noqa: E402
from hiremart.sources.writers import CSV_OPTIONS, EXPORTS, export, write_per_key, write_tsv  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


# ----------------------------------------------------------------------------
# Spark side
# ----------------------------------------------------------------------------

def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _texts(spark, sf_dir, name, *cols):
    """The needed columns of a text table."""
    return repartitioned(_t(spark, sf_dir, name).select(*cols))


def _postings(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return postings_view(repartitioned(orders))


def _enriched(spark, sf_dir):
    return enrich(_postings(spark, sf_dir))


def _labelled(spark, sf_dir):
    e = _enriched(spark, sf_dir)
    return e, LO.location_labels(e)


def q_industry_total(spark, sf_dir):
    """A1 + A5 + O3 + U3: industry totals, grand total last (flagship)."""
    return IN.industry_totals(_enriched(spark, sf_dir))


def q_extract_or_null(spark, sf_dir):
    """Regex field extraction, NULL when absent."""
    pages = _texts(spark, sf_dir, "pages", "page_id", "html")
    return pages.select(
        "page_id",
        TX.extract_or_null(F.col("html"), "<title>([^<]*)").alias("title"),
        TX.extract_or_null(F.col("html"), "<h7>([^<]*)").alias("h7"),
        TX.extract_last_or_null(F.col("html"), 'href="([^"]*)"').alias("last_href"),
    )


def _posting_json_lines(p: DataFrame) -> DataFrame:
    """Render postings as JSON lines.

    Some lines get a BOM; on some, an earlier duplicate of an existing key
    with a decoy text, plus a numeric value for another key, precede the
    real fields (the last string value must win; numbers read as NULL).
    """
    body = F.to_json(F.struct(*[F.col(c).alias(k) for k, c in zip(POSTING_JSON_KEYS, RAW_TEXT_COLUMNS)]))
    prefix = '{"' + POSTING_JSON_KEYS[1] + '": "DECOY", "' + POSTING_JSON_KEYS[6] + '": 7, '
    with_body = p.select("job_id", "raw_ind", body.alias("body"))
    decoy = F.concat(F.lit(prefix), F.expr("substr(body, 2)"))
    line = F.when((F.col("job_id") % 3 == 0) & F.col("raw_ind").isNotNull(), decoy).otherwise(F.col("body"))
    line = F.when(F.col("job_id") % 7 == 0, F.concat(F.lit("\ufeff"), line)).otherwise(line)
    return with_body.select("job_id", line.alias("line"))


def q_postings_jsonl_roundtrip(spark, sf_dir):
    """S1 + T1 + T2 + F1 + W1: JSON lines -> job_base_clean with dense ids."""
    lines = _posting_json_lines(_postings(spark, sf_dir))
    parsed = valid_postings(parse_posting_lines(lines, "line"))
    return dense_index(parsed, ["job_id"], "mahout_id").select("mahout_id", "job_id", *RAW_TEXT_COLUMNS)


def q_valid_rows(spark, sf_dir):
    """non-null, non-blank titles."""
    return valid_postings(_postings(spark, sf_dir)).select("job_id", "raw_title")


def q_dense_row_id(spark, sf_dir):
    """1..n over orders by o_orderkey, distributed."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return dense_index(o, ["o_orderkey"], "row_id")


def q_scan_order_ids(spark, sf_dir):
    """W1 as the job assigns ids: 1..n by file and place in the file.

    The driver's orders file stores rows in key order, so the oracle can state
    it with row_number(); tests/test_numbering.py has several files and splits.
    """
    o = with_source(_t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "_metadata"))
    return input_order_ids(o.drop("_metadata"), "row_id")


def q_dense_row_id_lineitem(spark, sf_dir):
    """W1 on the largest table: 1..n over (l_orderkey, l_linenumber)."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return dense_index(li, ["l_orderkey", "l_linenumber"], "row_id")


def q_data_quality_report(spark, sf_dir):
    """A6 + F2: total and three conditional counts in one aggregate."""
    return data_quality_report(valid_postings(_postings(spark, sf_dir)))


def q_ragged_width_profile(spark, sf_dir):
    """S5 + T20 + A8: every text line split on spaces; lines per field count."""
    docs = _texts(spark, sf_dir, "documents", "text")
    lines = docs.select(F.explode(F.split(F.col("text"), "\n", -1)).alias("line"))
    r = ragged_fields(lines, "line", ["first", "second"], sep=" ")
    return r.groupBy("_ncols").agg(
        F.count(F.lit(1)).cast("long").alias("n_lines"),
        F.count("second").cast("long").alias("n_with_second"),
    )


def q_ragged_tsv_roundtrip(spark, sf_dir):
    """S5 + T20: postings rendered as tab-separated lines, some short (9
    fields), some long (an extra field), some with a non-numeric id, read
    back by position with the ragged reader."""
    p = _postings(spark, sf_dir)
    jid = F.col("job_id")
    fields = [F.when(jid % 6 == 0, F.concat(F.lit("#"), jid.cast("string"))).otherwise(jid.cast("string"))]
    fields += [F.coalesce(F.col(c), F.lit("")) for c in RAW_TEXT_COLUMNS[:-1]]
    last = F.when(jid % 4 == 0, F.lit(None)).otherwise(F.coalesce(F.col(RAW_TEXT_COLUMNS[-1]), F.lit("")))
    extra = F.when(jid % 5 == 0, F.lit("EXTRA"))
    line = F.concat_ws("\t", *fields, last, extra)      # concat_ws skips the NULL pieces
    lines = p.select(jid.alias("src_id"), line.alias("line"))
    r = ragged_fields(lines, "line", ["job_id"] + RAW_TEXT_COLUMNS, id_col="job_id")
    return r.select("job_id", *RAW_TEXT_COLUMNS, "_ncols")


def q_job_base_width_profile(spark, sf_dir):
    """Field-count distribution of the tab-separated postings lines."""
    return MA.width_profile(q_ragged_tsv_roundtrip(spark, sf_dir))


def q_normalize_text(spark, sf_dir):
    """T3 + T4 + T5 on whole documents: collapse whitespace, Java trim, upper."""
    docs = _texts(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", F.upper(TX.java_trim(TX.collapse_ws(F.col("text")))).alias("norm_text"))


def q_head_segment(spark, sf_dir):
    """T6 (+T5): industry names for the industry and the requirement marts."""
    e = _enriched(spark, sf_dir)
    return e.select("job_id", "industry_name", "req_industry_name")


def q_slug(spark, sf_dir):
    """T7 on part names and types."""
    part = _t(spark, sf_dir, "part")
    return part.select("p_partkey", TX.slug_or_unknown(F.col("p_name")).alias("name_slug"), TX.slug_or_unknown(F.col("p_type")).alias("type_slug"))


def q_industry_slug(spark, sf_dir):
    """Industry ids of the requirement marts (accented letters deleted)."""
    return _enriched(spark, sf_dir).select("job_id", F.col("req_industry_id").alias("industry_id"))


def q_fold_accents(spark, sf_dir):
    """T8 + T9 on whole documents."""
    docs = _texts(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", TX.clean_location(F.col("text")).alias("folded"))


def q_fold_accents_conversations(spark, sf_dir):
    """T8 + T9 on every conversation turn."""
    c = _texts(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    return c.select("conv_id", "turn", TX.clean_location(F.col("text")).alias("folded"))


def q_tokenize_explode(spark, sf_dir):
    """Skill tokens, one row each."""
    p = _postings(spark, sf_dir)
    return p.select("job_id", F.explode(TX.tokens(F.col("raw_skill"))).alias("skill"))


def q_experience_bucket(spark, sf_dir):
    """T11 with SQL CASE semantics."""
    return _postings(spark, sf_dir).select("job_id", B.experience_bucket(F.col("raw_exp")).alias("experience"))


def q_experience_bucket_pig_nulls(spark, sf_dir):
    """T11 with the reference engine's NULL-propagating CASE."""
    return _postings(spark, sf_dir).select("job_id", B.experience_bucket(F.col("raw_exp"), True).alias("experience"))


def q_category_map(spark, sf_dir):
    """T12 + T13."""
    p = _postings(spark, sf_dir)
    return p.select("job_id", B.education_level(F.col("raw_edu")).alias("education"), B.employment_type(F.col("raw_type")).alias("employment_type"))


def q_ordered_rules(spark, sf_dir):
    """T14 + F8: ordered substring rules over distinct locations, joined back."""
    e, labels = _labelled(spark, sf_dir)
    return LO.classify_postings(e.select("job_id", "raw_loc", "loc_key"), labels).select("job_id", "raw_loc", "province_name")


def q_code_lookup(spark, sf_dir):
    """T15 + T16: log_location."""
    e, labels = _labelled(spark, sf_dir)
    return LO.log_location(e, labels)


def q_left_join_default(spark, sf_dir):
    """Left join with a default for unmatched rows."""
    docs = _texts(spark, sf_dir, "documents", "doc_id", "lang")
    labels = _t(spark, sf_dir, "labels")
    j = left_join_default(docs, labels, ["doc_id"], {"quality": -1, "toxic": -1})
    return j.select(
        "doc_id", "lang",
        F.col("quality").cast("int").alias("quality"),
        F.col("toxic").cast("int").alias("toxic"),
        F.when(F.col("quality") == -1, F.lit("UNKNOWN")).when(F.col("quality") == 1, F.lit("GOOD")).otherwise(F.lit("POOR")).alias("quality_label"),
    )


def q_count_by_key(spark, sf_dir):
    """A1: postings per industry."""
    return AG.count_by(_enriched(spark, sf_dir), ["industry_name"], "total_jobs")


def q_count_by_two_keys(spark, sf_dir):
    """A2: postings per (province, industry) = industry_by_location."""
    e, labels = _labelled(spark, sf_dir)
    return IN.industry_by_location(e, labels)


def q_titles_by_location(spark, sf_dir):
    """A2 + T7: postings per (province, title) with the folder slug."""
    e, labels = _labelled(spark, sf_dir)
    return IN.titles_by_location(e, labels)


def q_lineitem_flag_counts(spark, sf_dir):
    """A2 on the largest table."""
    return AG.count_by(_t(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "n")


def q_totals_with_grand_total_first(spark, sf_dir):
    """A4 + O3: province totals, grand total first."""
    e, labels = _labelled(spark, sf_dir)
    return LO.province_totals(e, labels)


def q_totals_with_grand_total_last(spark, sf_dir):
    """A5 + O3: parts by type, grand total last."""
    return AG.with_grand_total(_t(spark, sf_dir, "part"), "p_type", "n", "ALL", total_first=False)


def q_segment_totals(spark, sf_dir):
    """A4 on customers by market segment."""
    c = _t(spark, sf_dir, "customer")
    return AG.with_grand_total(c, "c_mktsegment", "n", "ALL", total_first=True)


def q_known_category_totals(spark, sf_dir):
    """F3 + F4: M1/M2."""
    return MA.industry_total_known(IN.industry_totals(_enriched(spark, sf_dir)))


def q_requirement_totals(spark, sf_dir):
    """A3 + J2 + T10-T13: the five requirement tables as one long table."""
    return RQ.requirement_long(_enriched(spark, sf_dir))


def q_requirement_rollup(spark, sf_dir):
    """Value totals over all industries, irrelevant values dropped."""
    return MA.requirement_rollup(RQ.requirement_long(_enriched(spark, sf_dir)))


def _req_mart(kind):
    def q(spark, sf_dir):
        return MA.requirement_mart(RQ.requirement_long(_enriched(spark, sf_dir), null_propagates=True), kind)
    q.__doc__ = f"M7-M10: {MA.REQUIREMENT_MARTS[kind][0]} (reference NULL semantics)."
    return q


def _by_location_viz(spark, sf_dir):
    e, labels = _labelled(spark, sf_dir)
    return MA.industry_by_location_viz(IN.industry_by_location(e, labels, sort=False))


def q_industry_by_location_viz(spark, sf_dir):
    """M3."""
    return _by_location_viz(spark, sf_dir)


def q_province_total(spark, sf_dir):
    """M4 / A7."""
    return MA.province_total(_by_location_viz(spark, sf_dir))


def q_topn_per_group(spark, sf_dir):
    """W4 + F5: top 5 part types per brand by count."""
    part = _t(spark, sf_dir, "part")
    c = AG.count_by(part, ["p_brand", "p_type"], "n")
    return AG.top_n_per_group(c, ["p_brand"], [F.desc("n"), F.asc("p_type")], 5)


def q_top5_industries_by_province(spark, sf_dir):
    """M5."""
    return MA.top_industries_by_province(_by_location_viz(spark, sf_dir), 5)


def q_top3_industries_by_province(spark, sf_dir):
    """The console's top 3 industries of each province."""
    return MA.top_industries_by_province(_by_location_viz(spark, sf_dir), 3)


def q_share_of_group(spark, sf_dir):
    """W5 + J6 + T21: M6."""
    return MA.province_industry_share(_by_location_viz(spark, sf_dir))


def q_topk_global(spark, sf_dir):
    """The 500 most frequent tokens of the documents, of a vocabulary that is larger."""
    docs = _texts(spark, sf_dir, "documents", "text")
    words = docs.select(F.explode(F.split("text", "[^A-Za-z]+")).alias("w")).where("w <> ''").select(F.upper("w").alias("token"))
    return AG.top_k(AG.count_by(words, ["token"], "n"), [F.desc("n"), F.asc("token")], MA.SKILL_TOP_K)


def q_distinct_lookup(spark, sf_dir):
    """A9."""
    return FT.industry_lookup(RQ.requirement_long(_enriched(spark, sf_dir)))


def _merged(spark, sf_dir, null_propagates=False):
    """The merged feature rows.  The requirement table, which its two sides read, is computed once."""
    e, labels = _labelled(spark, sf_dir)
    long = materialize(RQ.requirement_long(e, null_propagates))
    return FT.merged_features(long, IN.industry_by_location(e, labels, sort=False))


def q_industry_index(spark, sf_dir):
    """W2."""
    return FT.industry_index(_merged(spark, sf_dir))


def q_feature_value_index(spark, sf_dir):
    """W3."""
    return FT.feature_value_index(_merged(spark, sf_dir))


def q_feature_matrix(spark, sf_dir):
    """U1 + U2 + J3-J5 + T17 + T18, with NULL values (index 0)."""
    m = materialize(_merged(spark, sf_dir, True))
    return FT.feature_matrix(m, FT.industry_index(m), FT.feature_value_index(m))


def q_bar_topn(spark, sf_dir):
    """O6 + F7 + T22: the 25 most frequent part names, of many more."""
    names = AG.count_by(_t(spark, sf_dir, "part"), ["p_name"], "n")
    return AG.bar_top_n(names, "p_name", "n", 25)


def q_share_pivot_top(spark, sf_dir):
    """A10-A12 + F6 + O7: brand x type share matrix, top 10 x top 20, as one row per cell.

    Types have dots in their names and one in five sizes has none (NULL)."""
    kind = F.when(F.col("p_size") % 5 != 0, F.translate("p_type", " ", ".")).alias("kind")
    counts = AG.count_by(_t(spark, sf_dir, "part").select("p_brand", kind), ["p_brand", "kind"], "job_count")
    shares = AG.share_of_group(counts, ["p_brand"], "job_count", "brand_total", "share")
    matrix = AG.pivot_share(shares, "p_brand", "kind", "share", "brand_total", "job_count", 10, 20)
    return AG.unpivoted(matrix, ["p_brand", "brand_total"], "kind", "share")


def q_province_industry_heatmap(spark, sf_dir):
    """The chart's province x industry share matrix, 25 provinces
    by total x 20 industries by count, as one row per cell."""
    share = MA.province_industry_share(_by_location_viz(spark, sf_dir))
    matrix = AG.pivot_share(share, "province", "industry", "share", "province_job_count", "job_count", 25, 20)
    return AG.unpivoted(matrix, ["province", "province_job_count"], "industry", "share")


def q_tsv_schema_roundtrip(spark, sf_dir):
    """Postings rendered as tab-separated lines and read by position with the declared schema."""
    p = _postings(spark, sf_dir).select("job_id", *RAW_TEXT_COLUMNS)
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in p.columns])
    row = F.from_csv(line, JOB_BASE_CLEAN.simpleString()[7:-1].replace(":", " "), dict(TSV_OPTIONS))
    return p.select(row.alias("r")).select("r.*")


def q_top_raw_locations(spark, sf_dir):
    """Postings per raw location."""
    return MA.top_raw_locations(_enriched(spark, sf_dir))


def _fresh(spark, name):
    """A path not yet used in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def q_tsv_store_roundtrip(spark, sf_dir):
    """K1 + K2 + S2-S4: postings stored as tab-separated text, replaced by the whole table, read by schema."""
    p = _postings(spark, sf_dir).select("job_id", *RAW_TEXT_COLUMNS)
    path = _fresh(spark, "tsv-store")
    write_tsv(valid_postings(p), path)
    write_tsv(p, path, mode="overwrite")
    return read_tsv(spark, path, JOB_BASE_CLEAN)


def q_per_key_folder_roundtrip(spark, sf_dir):
    """K3 + J1 + T14: locations stored in one folder per province, read back with the folder's key."""
    e, labels = _labelled(spark, sf_dir)
    path = _fresh(spark, "per-key")
    write_per_key(LO.log_location(e, labels), path, "province_name")
    lines = spark.read.schema("value string, key string").text(path)
    names = ["job_id", "province_id", "province_name", "is_overseas", "is_unknown"]
    fields = F.from_csv("value", "job_id long, province_id int, province_name string, is_overseas int, is_unknown int", dict(TSV_OPTIONS))
    return lines.select("key", fields.alias("r")).select("key", *[f"r.{n}" for n in names])


def q_csv_export_roundtrip(spark, sf_dir):
    """K4 + K5: a mart exported in each format and read back."""
    mart = materialize(_req_mart("skill")(spark, sf_dir))
    names, out = mart.columns, None
    for fmt in EXPORTS:
        path = export(mart, _fresh(spark, "export"), "skills", fmt)
        back = spark.read.parquet(path) if fmt == "parquet" else spark.read.options(**CSV_OPTIONS).csv(path)
        back = back.select(F.lit(fmt).alias("format"), *[F.col(n).cast(mart.schema[n].dataType) for n in names])
        out = back if out is None else out.unionByName(back)
    return out


def q_postings_files(spark, sf_dir):
    """S1 + S6 + T1 + T2 + F1 + W1: several text files of JSON lines, read by a glob; ids follow file and line."""
    path = _fresh(spark, "postings")
    in_order = sorted_ranges(_postings(spark, sf_dir), ["job_id"], at_least=5)
    _posting_json_lines(in_order).select("line").write.text(path)
    return read_postings_jsonl(spark, f"{path}/part-*").withColumnRenamed("job_id", "row_id")


def q_ordered_requirements(spark, sf_dir):
    """O1: requirement counts by industry and value, ascending, with the place of each."""
    long = RQ.requirement_long(_enriched(spark, sf_dir)).where("feature_type = 'exp'")
    rows = long.select("industry_id", "industry_name", F.col("feature_value").alias("exp_required"), "total_jobs")
    return placed(rows, ["industry_id", "industry_name", "exp_required"])


def q_ordered_industries(spark, sf_dir):
    """O2: industries by postings, descending (ties by name), with the place of each."""
    totals = AG.count_by(_enriched(spark, sf_dir), ["industry_name"], "total_jobs")
    return placed(totals, ["-total_jobs", "industry_name"])


def q_ordered_province_industries(spark, sf_dir):
    """(count descending, name ascending) over every pair of the presentation table, with the place of each."""
    return placed(_by_location_viz(spark, sf_dir), ["-job_count", "industry", "province"])


def q_lookup_join(spark, sf_dir):
    """Postings joined with a lookup of sectors; half of the rows have one sector, half have none."""
    p = _postings(spark, sf_dir).select("job_id", "raw_sec", "raw_loc")
    sectors = p.where("raw_sec is not null").groupBy("raw_sec").agg(F.count(F.lit(1)).alias("sector_jobs"), F.min("job_id").alias("first_job"))
    return lookup_join(p, sectors.where(F.col("raw_sec") != NOT_DISPLAYED_RAW), ["raw_sec"], {"sector_jobs": 0, "first_job": -1})


def q_province_by_words(spark, sf_dir):
    """T14 with match="word": provinces by whole words."""
    e = _enriched(spark, sf_dir)
    labels = LO.location_labels(e, match="word")
    return LO.classify_postings(e.select("job_id", "raw_loc", "loc_key"), labels).select("job_id", "raw_loc", "province_name")


def q_summed_feature_rows(spark, sf_dir):
    """U2, summing: sparse rows of each industry, cells of one industry and value added up."""
    merged = materialize(_merged(spark, sf_dir))
    matrix = FT.feature_matrix(merged, materialize(FT.industry_index(merged)), materialize(FT.feature_value_index(merged)))
    rows = FT.sparse_rows(matrix)
    text = F.transform("cells", lambda x: F.concat_ws(":", x["feature_value_idx"].cast("string"), x["feature_type_idx"].cast("string"), x["feature_count"].cast("string")))
    return rows.select("industry_idx", "block", F.size("cells").cast("long").alias("n_cells"), F.array_join(text, " ").alias("cells"))


def q_fold_decomposed(spark, sf_dir):
    """T8 + T9 with the composing step: texts whose vowels are written as letter and combining marks."""
    p = _postings(spark, sf_dir).select("job_id", "raw_loc")
    texts = {v: unicodedata.normalize("NFD", v) for v in LOCATIONS if v}
    apart = F.create_map(*[F.lit(x) for pair in texts.items() for x in pair])
    rows = p.select("job_id", F.coalesce(F.try_element_at(apart, F.col("raw_loc")), F.col("raw_loc")).alias("raw_loc"))
    return rows.select("job_id", TX.compose_accents("raw_loc").alias("composed"), TX.clean_location("raw_loc", compose=True).alias("clean"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "industry_total": q_industry_total,
    "extract_or_null": q_extract_or_null,
    "postings_jsonl_roundtrip": q_postings_jsonl_roundtrip,
    "valid_rows": q_valid_rows,
    "dense_row_id": q_dense_row_id,
    "dense_row_id_lineitem": q_dense_row_id_lineitem,
    "scan_order_ids": q_scan_order_ids,
    "data_quality_report": q_data_quality_report,
    "ragged_width_profile": q_ragged_width_profile,
    "ragged_tsv_roundtrip": q_ragged_tsv_roundtrip,
    "job_base_width_profile": q_job_base_width_profile,
    "normalize_text": q_normalize_text,
    "head_segment": q_head_segment,
    "slug": q_slug,
    "industry_slug": q_industry_slug,
    "fold_accents": q_fold_accents,
    "fold_accents_conversations": q_fold_accents_conversations,
    "tokenize_explode": q_tokenize_explode,
    "experience_bucket": q_experience_bucket,
    "experience_bucket_pig_nulls": q_experience_bucket_pig_nulls,
    "category_map": q_category_map,
    "ordered_rules": q_ordered_rules,
    "code_lookup": q_code_lookup,
    "left_join_default": q_left_join_default,
    "count_by_key": q_count_by_key,
    "count_by_two_keys": q_count_by_two_keys,
    "titles_by_location": q_titles_by_location,
    "lineitem_flag_counts": q_lineitem_flag_counts,
    "totals_with_grand_total_first": q_totals_with_grand_total_first,
    "totals_with_grand_total_last": q_totals_with_grand_total_last,
    "segment_totals": q_segment_totals,
    "known_category_totals": q_known_category_totals,
    "requirement_totals": q_requirement_totals,
    "requirement_rollup": q_requirement_rollup,
    "requirement_experience_total": _req_mart("exp"),
    "requirement_education_total": _req_mart("edu"),
    "requirement_employment_type_total": _req_mart("type"),
    "requirement_skill_total": _req_mart("skill"),
    "industry_by_location_viz": q_industry_by_location_viz,
    "province_total": q_province_total,
    "topn_per_group": q_topn_per_group,
    "top5_industries_by_province": q_top5_industries_by_province,
    "top3_industries_by_province": q_top3_industries_by_province,
    "share_of_group": q_share_of_group,
    "topk_global": q_topk_global,
    "distinct_lookup": q_distinct_lookup,
    "industry_index": q_industry_index,
    "feature_value_index": q_feature_value_index,
    "feature_matrix": q_feature_matrix,
    "bar_topn": q_bar_topn,
    "tsv_schema_roundtrip": q_tsv_schema_roundtrip,
    "share_pivot_top": q_share_pivot_top,
    "province_industry_heatmap": q_province_industry_heatmap,
    "top_raw_locations": q_top_raw_locations,
    "tsv_store_roundtrip": q_tsv_store_roundtrip,
    "per_key_folder_roundtrip": q_per_key_folder_roundtrip,
    "csv_export_roundtrip": q_csv_export_roundtrip,
    "postings_files": q_postings_files,
    "ordered_requirements": q_ordered_requirements,
    "ordered_industries": q_ordered_industries,
    "ordered_province_industries": q_ordered_province_industries,
    "lookup_join": q_lookup_join,
    "province_by_words": q_province_by_words,
    "summed_feature_rows": q_summed_feature_rows,
    "fold_decomposed": q_fold_decomposed,
}


def entry(spark: SparkSession) -> DataFrame:
    return q_industry_total(spark, SMOKE_DIR)


def _pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def _with_package(query):
    """``query`` with this package made known to the Python workers first."""

    def run(spark, sf_dir):
        ship_package(spark)
        return query(spark, sf_dir)

    return run


def _training_data_module():
    """The training-data queries, or None where that subpackage is not installed."""
    if importlib.util.find_spec("hiremart.llm") is None:
        return None
    return importlib.import_module("hiremart.llm.queries")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = dict(QUERIES)
    module = _training_data_module()
    if module is not None:
        found |= {name: _with_package(query) for name, query in module.queries().items()}
        if importlib.util.find_spec("corpus_pipeline") is not None:
            found["pipeline"] = _with_package(_pipeline)
    return found


# ----------------------------------------------------------------------------
# DuckDB oracle: the same semantics written independently in SQL
# ----------------------------------------------------------------------------

# Fixed values, written out here so that the SQL does not share them with the code under test.
WHITE = "[ \\t\\n\\x0B\\f\\r]"
LINE_ENDS = "[\\n\\r\\x{85}\\x{2028}\\x{2029}]"
ACCENTED = "áàảãạăắằẳẵặâấầẩẫậéèẻẽẹêếềểễệíìỉĩịóòỏõọôốồổỗộơớờởỡợúùủũụưứừửữựýỳỷỹỵđ"
BASE = "a" * 17 + "e" * 11 + "i" * 5 + "o" * 17 + "u" * 11 + "y" * 5 + "d"
EDUCATIONS = [
    (["KHÔNG HIỂN THỊ", "UNKNOWN", "KHÔNG GIỚI HẠN", "KHÁC"], "KHÔNG YÊU CẦU"),
    (["TRUNG HỌC CƠ SỞ (CẤP 2) TRỞ LÊN"], "THCS"),
    (["TRUNG HỌC PHỔ THÔNG (CẤP 3) TRỞ LÊN", "TRUNG HỌC"], "THPT"),
    (["ĐẠI HỌC TRỞ LÊN", "CỬ NHÂN"], "ĐẠI HỌC"),
    (["CAO HỌC TRỞ LÊN", "THẠC SĨ"], "CAO HỌC"),
    (["TRUNG CẤP", "TRUNG CẤP TRỞ LÊN"], "TRUNG CẤP"),
]
EMPLOYMENTS = [
    (["TOÀN THỜI GIAN CỐ ĐỊNH", "TOÀN THỜI GIAN", "TOÀN THỜI GIAN TẠM THỜI"], "TOÀN THỜI GIAN"),
    (["BÁN THỜI GIAN"], "BÁN THỜI GIAN"),
    (["THỜI VỤ", "HỢP ĐỒNG THỜI VỤ"], "THỜI VỤ / HỢP ĐỒNG"),
    (["THỰC TẬP"], "THỰC TẬP"),
    (["KHÁC", "KHÔNG HIỂN THỊ", "UNKNOWN"], "KHÁC / KHÔNG HIỂN THỊ"),
]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def s_jtrim(x: str) -> str:
    return "regexp_replace(" + x + ", '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def s_collapse(x: str, repl: str = " ") -> str:
    return f"regexp_replace({x}, {_q(WHITE + '+')}, {_q(repl)}, 'g')"


def s_has_lt(x: str) -> str:
    return f"regexp_matches({x}, {_q(LINE_ENDS)})"


def s_anywhere(x: str, pattern: str) -> str:
    return f"(NOT {s_has_lt(x)} AND regexp_matches({x}, {_q(pattern)}))"


def s_unknown_if_blank(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {s_jtrim(x)} = '' THEN 'UNKNOWN' ELSE upper({s_jtrim(x)}) END"


def s_head(x: str, d: str) -> str:
    start = f"^([^{d}]+)"  # cut at the first delimiter, if no line ends after it
    return (
        f"CASE WHEN {x} = 'UNKNOWN' THEN 'UNKNOWN' WHEN regexp_matches({x}, {_q(start)}) "
        f"AND NOT {s_has_lt(f'substr({x}, length(regexp_extract({x}, {_q(start)}, 1)) + 1)')} "
        f"THEN regexp_extract({x}, {_q(start)}, 1) ELSE {x} END"
    )


def s_industry(raw: str, hidden_is_unknown: bool) -> str:
    blank = f"{raw} IS NULL OR {s_jtrim(raw)} = ''" + (f" OR {raw} = {_q(NOT_DISPLAYED_RAW)}" if hidden_is_unknown else "")
    clean = f"(CASE WHEN {blank} THEN 'UNKNOWN' ELSE {s_jtrim(raw)} END)"
    seg = clean
    for d in "/,>":
        seg = "(" + s_head(seg, d) + ")"
    col = s_jtrim(s_collapse(seg))
    return f"(CASE WHEN {seg} = 'UNKNOWN' THEN 'UNKNOWN' WHEN {col} = '' THEN 'UNKNOWN' ELSE upper({col}) END)"


def s_slug(x: str) -> str:
    return f"regexp_replace({s_collapse('upper(' + s_jtrim(x) + ')', '_')}, '[^A-Z0-9_-]', '', 'g')"


def s_slug_or_unknown(x: str) -> str:
    return f"(CASE WHEN {s_slug(x)} = '' THEN 'UNKNOWN' ELSE {s_slug(x)} END)"


def s_industry_id(name: str) -> str:
    return f"(CASE WHEN {name} = 'UNKNOWN' THEN 'UNKNOWN' WHEN {s_slug(name)} = '' THEN 'UNKNOWN' ELSE {s_slug(name)} END)"


def s_fold(x: str) -> str:
    folded = f"translate(lower({x}), {_q(ACCENTED)}, {_q(BASE)})"
    spaced = f"translate({folded}, {_q(chr(0xA0) + '|' + chr(0x2026))}, '   ')"
    return f"replace({spaced}, '...', ' ')"


def s_province(raw: str) -> str:
    c = s_fold(f"coalesce({raw}, '')")
    parts = [f"CASE WHEN {c} IS NULL OR {c} = '' THEN 'UNKNOWN' WHEN {s_has_lt(c)} THEN 'UNKNOWN'"]
    for r in PV.LOCATION_RULES:
        parts.append(f"WHEN regexp_matches({c}, {_q(r.regex())}) THEN {_q(r.label)}")
    parts.append("ELSE 'UNKNOWN' END")
    return " ".join(parts)


def s_province_by_words(raw: str) -> str:
    c = s_fold(f"coalesce({raw}, '')")
    words = f"(' ' || array_to_string(regexp_extract_all({c}, '[\\p{{L}}\\p{{N}}]+'), ' ') || ' ')"
    parts = ["CASE"]
    for r in PV.LOCATION_RULES:
        names = [" ".join("".join(ch if ch.isalnum() else " " for ch in k).split()) for k in r.keywords]
        names += ["(quan|q|dist|district) ?0?(1[0-2]|[1-9])"] if r.patterns else []
        parts.append(f"WHEN regexp_matches({words}, {_q(' (' + '|'.join(names) + ') ')}) THEN {_q(r.label)}")
    return " ".join([*parts, "ELSE 'UNKNOWN' END"])


def s_code(name: str) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {v}" for k, v in PV.province_code_table())
    return f"CAST(CASE {name} {whens} ELSE 0 END AS INTEGER)"


def s_tokens(x: str) -> str:
    parts = f"list_filter(string_split_regex(upper({s_jtrim(x)}), '[\\[,;/|\\]+]'), lambda t: t <> '')"
    cleaned = f"list_transform({parts}, lambda t: CASE WHEN {s_jtrim('t')} = '' THEN 'UNKNOWN' ELSE upper({s_jtrim('t')}) END)"
    return f"(CASE WHEN {x} IS NULL OR {s_jtrim(x)} = '' THEN ['UNKNOWN'] ELSE {cleaned} END)"


def s_experience(x: str, null_propagates: bool = False) -> str:
    raw = f"({s_unknown_if_blank(x)})"
    t = s_jtrim(f"coalesce({x}, '')")
    digits = f"(CASE WHEN regexp_matches({t}, '^[0-9]') THEN regexp_extract({t}, '^([0-9]+)', 1) END)"
    not_req = "'KHÔNG YÊU CẦU', 'KHÔNG HIỂN THỊ', 'UNKNOWN', 'NULL'"
    chain = (
        f"CASE WHEN {raw} IN ({not_req}) THEN 'KHÔNG YÊU CẦU' "
        f"WHEN {s_anywhere(raw, 'DƯỚI 1 NĂM')} THEN 'DƯỚI 1 NĂM' "
        f"WHEN regexp_matches({digits}, '^[123]$') THEN '1-3 NĂM' "
        f"WHEN regexp_matches({digits}, '^[45]$') THEN '3-5 NĂM' "
        f"WHEN {s_anywhere(raw, '5' + WHITE + '*-' + WHITE + '*10')} THEN '3-5 NĂM' "
        f"WHEN regexp_matches({digits}, '^[6-9]$|^[1-9][0-9]+$') THEN 'TRÊN 5 NĂM' "
        f"WHEN {s_anywhere(raw, 'TRÊN' + WHITE + '*5')} THEN 'TRÊN 5 NĂM' "
        f"WHEN {raw} = 'DƯỚI 1 NĂM' THEN 'DƯỚI 1 NĂM' "
        f"ELSE {raw} END"
    )
    if not null_propagates:
        return f"({chain})"
    first_two = f"({raw} IN ({not_req}) OR {s_anywhere(raw, 'DƯỚI 1 NĂM')})"
    return f"(CASE WHEN {first_two} OR {digits} IS NOT NULL THEN {chain} END)"


def s_mapped(x: str, table) -> str:
    raw = f"({s_unknown_if_blank(x)})"
    whens = " ".join(f"WHEN {raw} IN ({', '.join(_q(v) for v in ins)}) THEN {_q(label)}" for ins, label in table)
    return f"(CASE {whens} ELSE {raw} END)"


def s_irrelevant(x: str) -> str:
    n = f"upper(trim({x}, ' '))"
    return f"({n} IS NULL OR {n} = '' OR {n} = 'UNKNOWN' OR contains({n}, {_q(NOT_DISPLAYED)}))"


P_CTE = "p AS (" + postings_view_sql("orders") + ")"

E_CTE = (
    "e AS (SELECT job_id, "
    + s_industry("raw_ind", True) + " AS industry_name, "
    + s_industry("raw_ind", False) + " AS req_industry_name, "
    + f"upper({s_jtrim('raw_title')}) AS job_title, raw_loc, coalesce(raw_loc, '') AS loc_key, "
    + s_province("raw_loc") + " AS province_name, "
    + "raw_sec, raw_exp, raw_req, raw_skill, raw_edu, raw_type FROM p)"
)
E2_CTE = "e2 AS (SELECT *, " + s_industry_id("req_industry_name") + " AS req_industry_id FROM e)"


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


def _long_cte(null_propagates: bool = False) -> str:
    exp = s_experience("raw_exp", null_propagates)
    return (
        "items AS ("
        f"SELECT req_industry_id AS industry_id, req_industry_name AS industry_name, 'exp' AS feature_type, {exp} AS feature_value FROM e2 "
        f"UNION ALL SELECT req_industry_id, req_industry_name, 'edu', {s_mapped('raw_edu', EDUCATIONS)} FROM e2 "
        f"UNION ALL SELECT req_industry_id, req_industry_name, 'type', {s_mapped('raw_type', EMPLOYMENTS)} FROM e2 "
        f"UNION ALL SELECT req_industry_id, req_industry_name, 'skill', unnest({s_tokens('raw_skill')}) FROM e2 "
        f"UNION ALL SELECT req_industry_id, req_industry_name, 'req', unnest({s_tokens('raw_req')}) FROM e2), "
        "lng AS (SELECT feature_type, industry_id, industry_name, feature_value, CAST(count(*) AS BIGINT) AS total_jobs "
        "FROM items GROUP BY ALL)"
    )


BYLOC_CTE = (
    "byloc AS (SELECT province_name AS location_name, industry_name, CAST(count(*) AS BIGINT) AS total_jobs "
    "FROM e GROUP BY province_name, industry_name)"
)
VIZ_CTE = (
    "viz AS (SELECT location_name AS province, industry_name AS industry, total_jobs AS job_count FROM byloc "
    f"WHERE NOT {s_irrelevant('industry_name')})"
)
MERGED_CTE = (
    "lookup AS (SELECT DISTINCT industry_id, industry_name FROM lng), "
    "merged AS (SELECT industry_id, industry_name, feature_type, feature_value, total_jobs FROM lng UNION ALL "
    "SELECT coalesce(l.industry_id, 'UNKNOWN'), coalesce(b.industry_name, 'UNKNOWN'), 'location', "
    "coalesce(b.location_name, 'UNKNOWN'), coalesce(b.total_jobs, 0) FROM byloc b LEFT JOIN lookup l ON b.industry_name = l.industry_name), "
    "ind_idx AS (SELECT CAST(row_number() OVER (ORDER BY industry_id) AS BIGINT) AS industry_idx, industry_id "
    "FROM (SELECT DISTINCT industry_id FROM merged)), "
    "fv_idx AS (SELECT CAST(row_number() OVER (ORDER BY feature_type NULLS FIRST, feature_value NULLS FIRST) AS BIGINT) AS feature_value_idx, "
    "feature_type, feature_value FROM (SELECT DISTINCT feature_type, feature_value FROM merged))"
)


MERGED_PARTS = (P_CTE, E_CTE, E2_CTE, _long_cte(), BYLOC_CTE, MERGED_CTE)


def _industry_totals_sql() -> str:
    return (
        _with(P_CTE, E_CTE)
        + "SELECT CASE WHEN grouping(industry_name) = 1 THEN " + _q(INDUSTRY_TOTAL_LABEL) + " ELSE industry_name END AS industry_name, "
        "CAST(count(*) AS BIGINT) AS total_jobs, CAST(grouping(industry_name) AS BIGINT) AS is_total "
        "FROM e GROUP BY ROLLUP (industry_name)"
    )


def _requirement_mart_sql(kind: str) -> str:
    _, value_name = MA.REQUIREMENT_MARTS[kind]
    return (
        _with(P_CTE, E_CTE, E2_CTE, _long_cte(True))
        + f"SELECT feature_value AS {value_name}, CAST(sum(total_jobs) AS BIGINT) AS job_count FROM lng "
        f"WHERE feature_type = '{kind}' AND NOT {s_irrelevant('feature_value')} GROUP BY feature_value"
    )


def oracle_sql() -> dict[str, str]:
    module = _training_data_module()
    return _reference_sql() | (module.oracle_sql() if module is not None else {})


def _reference_sql() -> dict[str, str]:
    valid = f"raw_title IS NOT NULL AND {s_jtrim('raw_title')} <> ''"
    jt = ", ".join(RAW_TEXT_COLUMNS)
    sql = {
        "industry_total": _industry_totals_sql(),
        "extract_or_null": (
            "SELECT page_id, "
            "CASE WHEN regexp_matches(html, '<title>([^<]*)') THEN regexp_extract(html, '<title>([^<]*)', 1) END AS title, "
            "CASE WHEN regexp_matches(html, '<h7>([^<]*)') THEN regexp_extract(html, '<h7>([^<]*)', 1) END AS h7, "
            "regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)[-1] AS last_href FROM pages"
        ),
        "postings_jsonl_roundtrip": (
            _with(P_CTE) + f"SELECT CAST(row_number() OVER (ORDER BY job_id) AS BIGINT) AS mahout_id, job_id, {jt} FROM p WHERE {valid}"
        ),
        "valid_rows": _with(P_CTE) + f"SELECT job_id, raw_title FROM p WHERE {valid}",
        "dense_row_id": "SELECT o_orderkey, o_custkey, CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS row_id FROM orders",
        "scan_order_ids": "SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS row_id, o_orderkey, o_custkey FROM orders",
        "dense_row_id_lineitem": (
            "SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS BIGINT) AS row_id FROM lineitem"
        ),
        "data_quality_report": (
            _with(P_CTE)
            + "SELECT 'Data_Quality_Report' AS report_name, CAST(count(*) AS BIGINT) AS total_jobs, "
            + ", ".join(
                f"CAST(count(*) FILTER (WHERE {c} IS NOT NULL AND {c} <> {_q(NOT_DISPLAYED_RAW)}) AS BIGINT) AS {n}"
                for c, n in [("raw_sec", "jobs_with_sector"), ("raw_skill", "jobs_with_skills"), ("raw_req", "jobs_with_requirement")]
            )
            + f" FROM p WHERE {valid} HAVING count(*) > 0"
        ),
        "ragged_width_profile": (
            "WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents), "
            "f AS (SELECT string_split(line, ' ') AS parts FROM l) "
            "SELECT CAST(len(parts) AS BIGINT) AS _ncols, CAST(count(*) AS BIGINT) AS n_lines, "
            "CAST(count(parts[2]) AS BIGINT) AS n_with_second FROM f GROUP BY len(parts)"
        ),
        # Java's toUpperCase maps ß to "SS"; DuckDB's upper keeps one letter.
        "ragged_tsv_roundtrip": (
            _with(P_CTE)
            + "SELECT CASE WHEN job_id % 6 = 0 THEN NULL ELSE job_id END AS job_id, "
            + ", ".join(f"coalesce({c}, '') AS {c}" for c in RAW_TEXT_COLUMNS[:-1])
            + ", CASE WHEN job_id % 4 = 0 THEN (CASE WHEN job_id % 5 = 0 THEN 'EXTRA' END) "
            "ELSE coalesce(raw_type, '') END AS raw_type, "
            "CAST(10 - CASE WHEN job_id % 4 = 0 THEN 1 ELSE 0 END + CASE WHEN job_id % 5 = 0 THEN 1 ELSE 0 END AS BIGINT) AS _ncols "
            "FROM p"
        ),
        "job_base_width_profile": (
            _with(P_CTE)
            + "SELECT CAST(10 - CASE WHEN job_id % 4 = 0 THEN 1 ELSE 0 END + CASE WHEN job_id % 5 = 0 THEN 1 ELSE 0 END AS BIGINT) AS _ncols, "
            "CAST(count(*) AS BIGINT) AS count FROM p GROUP BY 1"
        ),
        "normalize_text": f"SELECT doc_id, upper(replace({s_jtrim(s_collapse('text'))}, 'ß', 'SS')) AS norm_text FROM documents",
        "head_segment": _with(P_CTE, E_CTE) + "SELECT job_id, industry_name, req_industry_name FROM e",
        "slug": f"SELECT p_partkey, {s_slug_or_unknown('p_name')} AS name_slug, {s_slug_or_unknown('p_type')} AS type_slug FROM part",
        "industry_slug": _with(P_CTE, E_CTE, E2_CTE) + "SELECT job_id, req_industry_id AS industry_id FROM e2",
        "fold_accents": f"SELECT doc_id, {s_fold('coalesce(text, ' + chr(39) + chr(39) + ')')} AS folded FROM documents",
        "fold_accents_conversations": (
            f"SELECT conv_id, turn, {s_fold('coalesce(text, ' + chr(39) + chr(39) + ')')} AS folded FROM conversations"
        ),
        "tokenize_explode": _with(P_CTE) + f"SELECT job_id, unnest({s_tokens('raw_skill')}) AS skill FROM p",
        "experience_bucket": _with(P_CTE) + f"SELECT job_id, {s_experience('raw_exp')} AS experience FROM p",
        "experience_bucket_pig_nulls": _with(P_CTE) + f"SELECT job_id, {s_experience('raw_exp', True)} AS experience FROM p",
        "category_map": (
            _with(P_CTE)
            + f"SELECT job_id, {s_mapped('raw_edu', EDUCATIONS)} AS education, "
            f"{s_mapped('raw_type', EMPLOYMENTS)} AS employment_type FROM p"
        ),
        "ordered_rules": _with(P_CTE, E_CTE) + "SELECT job_id, raw_loc, province_name FROM e",
        "code_lookup": (
            _with(P_CTE, E_CTE)
            + f"SELECT job_id, {s_code('province_name')} AS province_id, province_name, "
            "CAST(province_name = 'OVERSEAS' AS INTEGER) AS is_overseas, CAST(province_name = 'UNKNOWN' AS INTEGER) AS is_unknown FROM e"
        ),
        "left_join_default": (
            "SELECT d.doc_id, d.lang, CAST(coalesce(l.quality, -1) AS INTEGER) AS quality, "
            "CAST(coalesce(l.toxic, -1) AS INTEGER) AS toxic, "
            "CASE WHEN l.quality IS NULL THEN 'UNKNOWN' WHEN l.quality = 1 THEN 'GOOD' ELSE 'POOR' END AS quality_label "
            "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
        ),
        "count_by_key": _with(P_CTE, E_CTE) + "SELECT industry_name, CAST(count(*) AS BIGINT) AS total_jobs FROM e GROUP BY industry_name",
        "count_by_two_keys": _with(P_CTE, E_CTE, BYLOC_CTE) + "SELECT location_name, industry_name, total_jobs FROM byloc",
        "titles_by_location": (
            _with(P_CTE, E_CTE)
            + "SELECT province_name AS location_name, job_title, CAST(count(*) AS BIGINT) AS total_jobs, "
            + s_slug_or_unknown("province_name") + " AS location_slug FROM e GROUP BY province_name, job_title"
        ),
        "lineitem_flag_counts": (
            "SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus"
        ),
        "totals_with_grand_total_first": (
            _with(P_CTE, E_CTE)
            + "SELECT CASE WHEN grouping(province_name) = 1 THEN " + _q(PV.TOTAL_LABEL) + " ELSE province_name END AS city_name, "
            "CAST(count(*) AS BIGINT) AS job_count, CAST(grouping(province_name) AS BIGINT) AS is_total FROM e GROUP BY ROLLUP (province_name)"
        ),
        "totals_with_grand_total_last": (
            "SELECT CASE WHEN grouping(p_type) = 1 THEN 'ALL' ELSE p_type END AS p_type, "
            "CAST(count(*) AS BIGINT) AS n, CAST(grouping(p_type) AS BIGINT) AS is_total FROM part GROUP BY ROLLUP (p_type)"
        ),
        "segment_totals": (
            "SELECT CASE WHEN grouping(c_mktsegment) = 1 THEN 'ALL' ELSE c_mktsegment END AS c_mktsegment, "
            "CAST(count(*) AS BIGINT) AS n, CAST(grouping(c_mktsegment) AS BIGINT) AS is_total FROM customer GROUP BY ROLLUP (c_mktsegment)"
        ),
        "known_category_totals": (
            _with(P_CTE, E_CTE)
            + "SELECT industry_name AS industry, CAST(count(*) AS BIGINT) AS job_count FROM e GROUP BY industry_name "
            f"HAVING industry_name NOT IN ('UNKNOWN', {_q(INDUSTRY_TOTAL_LABEL)}) AND NOT {s_irrelevant('industry_name')}"
        ),
        "requirement_totals": _with(P_CTE, E_CTE, E2_CTE, _long_cte()) + "SELECT * FROM lng",
        "requirement_rollup": (
            _with(P_CTE, E_CTE, E2_CTE, _long_cte())
            + "SELECT feature_type, feature_value, CAST(sum(total_jobs) AS BIGINT) AS job_count FROM lng "
            f"WHERE NOT {s_irrelevant('feature_value')} GROUP BY feature_type, feature_value"
        ),
        "requirement_experience_total": _requirement_mart_sql("exp"),
        "requirement_education_total": _requirement_mart_sql("edu"),
        "requirement_employment_type_total": _requirement_mart_sql("type"),
        "requirement_skill_total": _requirement_mart_sql("skill") + " ORDER BY job_count DESC, skill LIMIT 500",
        "industry_by_location_viz": _with(P_CTE, E_CTE, BYLOC_CTE, VIZ_CTE) + "SELECT * FROM viz",
        "province_total": (
            _with(P_CTE, E_CTE, BYLOC_CTE, VIZ_CTE)
            + "SELECT province, CAST(sum(job_count) AS BIGINT) AS province_job_count FROM viz GROUP BY province"
        ),
        "topn_per_group": (
            "SELECT * FROM (SELECT p_brand, p_type, CAST(count(*) AS BIGINT) AS n, "
            "CAST(row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) AS BIGINT) AS rn "
            "FROM part GROUP BY p_brand, p_type) WHERE rn <= 5"
        ),
        "top5_industries_by_province": (
            _with(P_CTE, E_CTE, BYLOC_CTE, VIZ_CTE)
            + "SELECT * FROM (SELECT province, industry, job_count, CAST(row_number() OVER "
            "(PARTITION BY province ORDER BY job_count DESC, industry) AS BIGINT) AS rn FROM viz) WHERE rn <= 5"
        ),
        "top3_industries_by_province": (
            _with(P_CTE, E_CTE, BYLOC_CTE, VIZ_CTE)
            + "SELECT * FROM (SELECT province, industry, job_count, CAST(row_number() OVER "
            "(PARTITION BY province ORDER BY job_count DESC, industry) AS BIGINT) AS rn FROM viz) WHERE rn <= 3"
        ),
        "share_of_group": (
            _with(P_CTE, E_CTE, BYLOC_CTE, VIZ_CTE)
            + "SELECT v.province, v.industry, v.job_count, t.province_job_count, "
            "CASE WHEN t.province_job_count > 0 THEN v.job_count / t.province_job_count END AS share FROM viz v "
            "LEFT JOIN (SELECT province, CAST(sum(job_count) AS BIGINT) AS province_job_count FROM viz GROUP BY province) t "
            "ON v.province = t.province"
        ),
        "topk_global": (
            "SELECT token, CAST(count(*) AS BIGINT) AS n FROM (SELECT upper(unnest(regexp_extract_all(text, '[A-Za-z]+'))) AS token "
            "FROM documents) GROUP BY token ORDER BY n DESC, token LIMIT 500"
        ),
        "distinct_lookup": _with(P_CTE, E_CTE, E2_CTE, _long_cte()) + "SELECT DISTINCT industry_id, industry_name FROM lng",
        "industry_index": _with(*MERGED_PARTS) + "SELECT * FROM ind_idx",
        "feature_value_index": _with(*MERGED_PARTS) + "SELECT * FROM fv_idx",
        "feature_matrix": (
            _with(P_CTE, E_CTE, E2_CTE, _long_cte(True), BYLOC_CTE, MERGED_CTE)
            + "SELECT CAST(coalesce(i.industry_idx, -1) AS BIGINT) AS industry_idx, "
            "CAST(CASE m.feature_type WHEN 'exp' THEN 1 WHEN 'edu' THEN 2 WHEN 'type' THEN 3 WHEN 'skill' THEN 4 "
            "WHEN 'req' THEN 5 WHEN 'location' THEN 6 ELSE 0 END AS BIGINT) AS feature_type_idx, "
            "CAST(coalesce(f.feature_value_idx, 0) AS BIGINT) AS feature_value_idx, "
            "CAST(coalesce(m.total_jobs, 0) AS BIGINT) AS feature_count FROM merged m "
            "LEFT JOIN ind_idx i ON m.industry_id = i.industry_id "
            "LEFT JOIN fv_idx f ON m.feature_type = f.feature_type AND m.feature_value = f.feature_value"
        ),
        "bar_topn": (
            "SELECT p_name, CAST(count(*) AS DOUBLE) AS n FROM part WHERE p_name IS NOT NULL "
            "GROUP BY p_name ORDER BY n DESC, p_name LIMIT 25"
        ),
        "tsv_schema_roundtrip": (
            _with(P_CTE) + "SELECT job_id, " + ", ".join(f"nullif({c}, '') AS {c}" for c in RAW_TEXT_COLUMNS) + " FROM p"
        ),
        "share_pivot_top": _matrix_sql(
            "SELECT p_brand, CASE WHEN p_size % 5 <> 0 THEN replace(p_type, ' ', '.') END AS kind, "
            "CAST(count(*) AS BIGINT) AS job_count FROM part GROUP BY ALL", "p_brand", "kind", "brand_total", 10, 20,
        ),
        "province_industry_heatmap": _matrix_sql(
            _with(P_CTE, E_CTE, BYLOC_CTE, VIZ_CTE) + "SELECT * FROM viz", "province", "industry", "province_job_count", 25, 20,
        ),
        "tsv_store_roundtrip": _with(P_CTE) + "SELECT job_id, " + ", ".join(f"nullif({c}, '') AS {c}" for c in RAW_TEXT_COLUMNS) + " FROM p",
        "per_key_folder_roundtrip": (
            _with(P_CTE, E_CTE)
            + f"SELECT province_name AS key, job_id, {s_code('province_name')} AS province_id, province_name, "
            "CAST(province_name = 'OVERSEAS' AS INTEGER) AS is_overseas, CAST(province_name = 'UNKNOWN' AS INTEGER) AS is_unknown FROM e"
        ),
        "csv_export_roundtrip": (
            f"SELECT format, m.* FROM ({_requirement_mart_sql('skill')} ORDER BY job_count DESC, 1 LIMIT 500) AS m, (VALUES ('csv'), ('csv-single'), ('parquet')) AS f (format)"
        ),
        "postings_files": _with(P_CTE) + f"SELECT CAST(row_number() OVER (ORDER BY job_id) AS BIGINT) AS row_id, {jt} FROM p WHERE {valid}",
        "ordered_requirements": (
            _with(P_CTE, E_CTE, E2_CTE, _long_cte())
            + "SELECT industry_id, industry_name, feature_value AS exp_required, total_jobs, CAST(row_number() OVER (ORDER BY industry_id, industry_name, feature_value) AS BIGINT) AS place "
            "FROM lng WHERE feature_type = 'exp'"
        ),
        "ordered_industries": (
            _with(P_CTE, E_CTE)
            + "SELECT industry_name, CAST(count(*) AS BIGINT) AS total_jobs, CAST(row_number() OVER (ORDER BY count(*) DESC, industry_name) AS BIGINT) AS place FROM e GROUP BY industry_name"
        ),
        "ordered_province_industries": (
            _with(P_CTE, E_CTE, BYLOC_CTE, VIZ_CTE)
            + "SELECT *, CAST(row_number() OVER (ORDER BY job_count DESC, industry, province) AS BIGINT) AS place FROM viz"
        ),
        "lookup_join": (
            _with(P_CTE)
            + f", s AS (SELECT raw_sec, count(*) AS n, min(job_id) AS first_job FROM p WHERE raw_sec <> {_q(NOT_DISPLAYED_RAW)} GROUP BY raw_sec) "
            "SELECT job_id, raw_sec, raw_loc, CAST(coalesce(n, 0) AS BIGINT) AS sector_jobs, coalesce(first_job, -1) AS first_job FROM p LEFT JOIN s USING (raw_sec)"
        ),
        "province_by_words": _with(P_CTE) + f"SELECT job_id, raw_loc, {s_province_by_words('raw_loc')} AS province_name FROM p",
        "summed_feature_rows": (
            _with(*MERGED_PARTS)
            + ", cell AS (SELECT CAST(coalesce(i.industry_idx, -1) AS BIGINT) AS industry_idx, CAST(coalesce(f.feature_value_idx, 0) AS BIGINT) AS v, "
            "list_position(['exp', 'edu', 'type', 'skill', 'req', 'location'], m.feature_type) AS t, sum(m.total_jobs) AS n FROM merged m LEFT JOIN ind_idx i USING (industry_id) "
            "LEFT JOIN fv_idx f ON m.feature_type = f.feature_type AND m.feature_value = f.feature_value GROUP BY 1, 2, 3) "
            "SELECT industry_idx, CAST(v // 4096 AS BIGINT) AS block, CAST(count(*) AS BIGINT) AS n_cells, "
            "string_agg(v || ':' || t || ':' || n, ' ' ORDER BY v, t) AS cells FROM cell GROUP BY industry_idx, v // 4096"
        ),
        "fold_decomposed": _with(P_CTE) + "SELECT job_id, raw_loc AS composed, " + s_fold("coalesce(raw_loc, '')") + " AS clean FROM p",
        "top_raw_locations": _with(P_CTE) + "SELECT raw_loc, CAST(count(*) AS BIGINT) AS count FROM p GROUP BY raw_loc",
    }
    return sql


def _matrix_sql(base: str, row: str, col: str, total: str, rows: int, cols: int) -> str:
    """Cells of the share matrix: the largest rows and columns, 0.0 where there is nothing;
    a row with no cell in the chosen columns is left out."""
    return (
        f"WITH base AS ({base}), t AS (SELECT {row}, CAST(sum(job_count) AS BIGINT) AS {total} FROM base GROUP BY {row}), "
        f"r AS (SELECT * FROM t ORDER BY {total} DESC, {row} LIMIT {rows}), "
        f"c AS (SELECT {col} FROM base GROUP BY {col} ORDER BY sum(job_count) DESC, {col} NULLS FIRST LIMIT {cols}), "
        f"x AS (SELECT b.{row}, b.{col}, b.job_count FROM base b JOIN c ON b.{col} IS NOT DISTINCT FROM c.{col}) "
        f"SELECT r.{row}, r.{total}, coalesce(c.{col}, '(null)') AS {col}, "
        f"coalesce((SELECT sum(x.job_count) / r.{total} FROM x WHERE x.{row} = r.{row} AND x.{col} IS NOT DISTINCT FROM c.{col}), 0.0) AS share "
        f"FROM r, c WHERE r.{row} IN (SELECT {row} FROM x)"
    )
