"""The whole batch job: raw postings -> every table of SURVEY §1.3.

Stages follow the reference's hand-offs, but each hand-off is a written
table in ``--output-dir`` (Parquet by default, tab-separated text with
``--table-format tsv``) that the next stage reads back.  A written table
cuts the lineage, survives lost executors, and lets later stages read only
the columns they use.

    spark-submit --py-files hiremart.zip run_job.py --input postings.jsonl --output-dir out/

Stage 1  JSON lines -> job_base_clean (ids 1..n in input order), data_quality_stats
Stage 2  locations  -> log_location, final_63_provinces_total, ten_tinh/<province>
Stage 3  industries -> industry_total, industry_by_location, industry_province_titles/<slug>
         (province totals, industry totals and industry x location are sums over
         one written (raw location x industry) count table: one scan for three)
Stage 4  requirements -> requirement_analysis/{exp,skill,req,edu,type}_total
Stage 5  feature matrix -> mahout_features, mahout_industry_index, mahout_feature_value_index
Stage 6  presentation marts -> viz/<name>.csv (or Parquet)
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.predicates import NOT_DISPLAYED_RAW
from ..sources.postings import read_postings_jsonl, valid_postings
from ..sources.tables import empty_as_null, read_ragged_tsv, read_tsv
from ..sources.writers import EXPORTS, export, write_parquet, write_per_key, write_tsv
from . import features as FT
from . import industry as IN
from . import location as LO
from . import marts as MA
from . import requirements as RQ
from .postings import enrich



@dataclass
class Store:
    """Where and how hand-off tables are written and read back."""

    spark: SparkSession
    root: str
    fmt: str = "parquet"          # parquet | tsv
    mode: str = "overwrite"       # overwrite | errorifexists

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def write(self, df: DataFrame, name: str, mode: str | None = None) -> None:
        mode = mode or self.mode
        if self.fmt == "tsv":
            write_tsv(df, self.path(name), mode)
        else:
            write_parquet(df, self.path(name), mode)

    def read(self, name: str, schema) -> DataFrame:
        if self.fmt == "tsv":
            return read_tsv(self.spark, self.path(name), schema)
        return self.spark.read.parquet(self.path(name))


def run_concurrently(actions: list[Callable[[], object]], max_workers: int = 4) -> list:
    """Submit independent Spark actions from several driver threads.

    Each mart write is a short job; run one after another they leave most
    cores idle between jobs.  Spark schedules jobs from several threads
    side by side, so independent writes overlap.  Errors propagate.
    """
    if len(actions) <= 1:
        return [a() for a in actions]
    with ThreadPoolExecutor(max_workers=min(max_workers, len(actions))) as pool:
        return [f.result() for f in [pool.submit(a) for a in actions]]


# Fixed value: the report name written in the data-quality table.
REPORT_NAME = "Data_Quality_Report"


def data_quality_report(postings: DataFrame) -> DataFrame:
    """A6 + F2: total postings and postings with a shown sector, skills, requirement."""

    def shown(c: str):
        return F.count(F.when(F.col(c).isNotNull() & (F.col(c) != NOT_DISPLAYED_RAW), F.lit(1))).cast("long")

    agg = postings.agg(
        F.count(F.lit(1)).cast("long").alias("total_jobs"),
        shown("raw_sec").alias("jobs_with_sector"),
        shown("raw_skill").alias("jobs_with_skills"),
        shown("raw_req").alias("jobs_with_requirement"),
    )
    return agg.where(F.col("total_jobs") > 0).select(
        F.lit(REPORT_NAME).alias("report_name"),
        "total_jobs", "jobs_with_sector", "jobs_with_skills", "jobs_with_requirement",
    )


def stage_base(store: Store, input_path, parser: str = "regex", base_mode: str = "errorifexists") -> DataFrame:
    """job_base_clean and data_quality_stats; returns the stored postings.

    The profile is computed on the values as parsed (an empty field is not
    NULL there), as the reference profiles before its hand-off; later
    stages read the table back with empty fields as NULL.
    """
    postings = read_postings_jsonl(store.spark, input_path, parser=parser)
    if store.fmt == "parquet":
        store.write(postings, "job_base_clean", base_mode)
        back = store.spark.read.parquet(store.path("job_base_clean"))
    else:
        path = store.path("_internal/job_base_clean")
        write_parquet(postings, path)
        back = store.spark.read.parquet(path)
        store.write(back, "job_base_clean", base_mode)
    store.write(data_quality_report(back), "data_quality_stats", base_mode)
    return back


FACTS_TABLE = "_location_industry_facts"   # internal hand-off, always Parquet


def stage_location(store: Store, enriched: DataFrame, labels: DataFrame, facts: DataFrame) -> list:
    """The location outputs as independent write actions."""
    totals = LO.province_totals_from_facts(facts, labels).select("city_name", "job_count")
    return [
        lambda: store.write(LO.log_location(enriched, labels), "log_location"),
        lambda: store.write(totals, "final_63_provinces_total"),
        lambda: write_per_key(LO.province_details(enriched, labels), store.path("ten_tinh"), "province_name"),
    ]


def stage_industry(store: Store, enriched: DataFrame, labels: DataFrame, facts: DataFrame) -> list:
    """The industry outputs as independent write actions."""
    totals = IN.industry_totals_from_facts(facts).select("industry_name", "total_jobs")
    titles = IN.titles_by_location(enriched, labels, sort=False)
    return [
        lambda: store.write(totals, "industry_total"),
        lambda: store.write(IN.industry_by_location_from_facts(facts, labels), "industry_by_location"),
        lambda: write_per_key(titles, store.path("industry_province_titles"), "location_slug"),
    ]


LONG_TABLE = "requirement_analysis/_long"   # internal hand-off, always Parquet


def stage_requirements(store: Store, enriched: DataFrame, null_propagates: bool) -> None:
    """One pass builds the long table; the five per-kind tables are cuts of it."""
    write_parquet(RQ.requirement_long(enriched, null_propagates), store.path(LONG_TABLE))
    long = _long_from_store(store)
    run_concurrently([
        (lambda k: (lambda: store.write(RQ.requirement_table(long, k), f"requirement_analysis/{k}_total")))(kind)
        for kind in RQ.KINDS
    ])


def _long_from_store(store: Store) -> DataFrame:
    return store.spark.read.parquet(store.path(LONG_TABLE))


def _named(store: Store, name: str, schema, names: list[str]) -> DataFrame:
    """A stored table under the job's column names; an error where it is not such a table.

    A folder in another format must not pass for an empty table: Parquet has to
    have the columns, tab-separated lines a number in their last field."""
    t = store.read(name, schema)
    if store.fmt == "tsv":
        t = t.toDF(*names)
        wrong = not t.where(F.col(names[-1]).isNull()).isEmpty()
    else:
        wrong = not set(names) <= set(t.columns)
    if wrong:
        raise ValueError(f"{store.path(name)} is no {store.fmt} table of {', '.join(names)}")
    return t.select(*names)


def _by_location_from_store(store: Store) -> DataFrame:
    return _named(store, "industry_by_location", S.INDUSTRY_BY_LOCATION, ["location_name", "industry_name", "total_jobs"])


def _industry_totals_from_store(store: Store) -> DataFrame:
    return _named(store, "industry_total", S.INDUSTRY_TOTAL, ["industry_name", "total_jobs"])


def _requirements_from_store(store: Store, kinds: list[str]) -> DataFrame:
    """The requirement long table, put together from the per-kind tables."""
    parts = []
    for kind in kinds:
        names = ["industry_id", "industry_name", RQ.VALUE_COLUMNS[kind], "total_jobs"]
        t = _named(store, f"requirement_analysis/{kind}_total", S.REQUIREMENT_TOTAL, names)
        parts.append(t.select(F.lit(kind).alias("feature_type"), "industry_id", "industry_name", F.col(names[2]).alias("feature_value"), "total_jobs"))
    long = parts[0]
    for part in parts[1:]:
        long = long.unionByName(part)
    return long


def _handoff(store: Store, df: DataFrame, name: str, public: bool = True) -> DataFrame:
    """Write ``df`` once and return a frame that reads the written copy.

    With Parquet tables the public table is the hand-off.  With TSV tables
    (or for internal tables) a Parquet copy is written first and the public
    TSV is produced from it, so the plan runs once and later stages keep
    typed, column-pruned reads.
    """
    if public and store.fmt == "parquet":
        store.write(df, name)
        return store.spark.read.parquet(store.path(name))
    path = store.path(f"_internal/{name}")
    write_parquet(df, path)
    back = store.spark.read.parquet(path)
    if public:
        store.write(back, name)
    return back


def stage_features(store: Store) -> None:
    long = _long_from_store(store) if _exists(store, LONG_TABLE) else _requirements_from_store(store, RQ.KINDS)
    merged = _handoff(store, FT.merged_features(long, _by_location_from_store(store)),
                      "mahout_merged_features", public=False)
    ind, fv = run_concurrently([
        lambda: _handoff(store, FT.industry_index(merged), "mahout_industry_index"),
        lambda: _handoff(store, FT.feature_value_index(merged), "mahout_feature_value_index"),
    ])
    store.write(FT.feature_matrix(merged, ind, fv), "mahout_features")


def export_marts(marts: dict[str, DataFrame], export_dir: str, export_format: str, chart_data: bool = False) -> dict[str, str]:
    """Export the marts (and, optionally, the chart data derived from them)."""
    jobs = {n: (marts[n], export_dir) for n in marts}
    if chart_data:
        for n, df in MA.chart_data(marts).items():
            jobs[f"chart_{n}"] = (df, export_dir.rstrip("/") + "/charts")
    names = list(jobs)
    paths = run_concurrently(
        [(lambda n: (lambda: export(jobs[n][0], jobs[n][1], n.removeprefix("chart_"), export_format)))(n) for n in names]
    )
    return dict(zip(names, paths))


def stage_presentation(store: Store, export_dir: str, export_format: str, chart_data: bool = False) -> dict[str, str]:
    marts = MA.presentation_marts(
        _industry_totals_from_store(store).where(F.col("industry_name") != "TONG_TAT_CA"),
        _by_location_from_store(store),
        _long_from_store(store) if _exists(store, LONG_TABLE) else _requirements_from_store(store, PRESENTATION_KINDS),
    )
    return export_marts(marts, export_dir, export_format, chart_data)


PRESENTATION_KINDS = ["exp", "edu", "type", "skill"]


def presentation_from_tables(
    spark: SparkSession, tables_dir: str, export_dir: str | None = None, export_format: str = "csv", show: int = 0,
    chart_data: bool = False, table_format: str = "tsv",
) -> dict[str, str]:
    """Only the presentation stage, over existing tables (SURVEY §1.3's layout).

    A user with tables from an earlier run can produce the marts without
    running it again.  Tables in another format than ``table_format`` are an error.
    """
    store = Store(spark, tables_dir, table_format)
    totals, by_loc = _industry_totals_from_store(store), _by_location_from_store(store)
    long = _requirements_from_store(store, PRESENTATION_KINDS)
    if show > 0:
        print_profiles(store, show)
    marts = MA.presentation_marts(totals.where(F.col("industry_name") != "TONG_TAT_CA"), by_loc, long)
    return export_marts(marts, _export_dir(store, export_dir), export_format, chart_data)


def _export_dir(store: Store, export_dir: str | None) -> str:
    """The export folder; never the one that holds the tables, whose names the marts share."""
    chosen = (export_dir or store.path("viz")).rstrip("/")
    if chosen == store.root.rstrip("/"):
        raise ValueError("the export folder holds the job's tables: choose another one")
    return chosen


def charts_from_exports(spark: SparkSession, export_dir: str, export_format: str = "csv") -> dict[str, str]:
    """M12 from marts that were exported before; charts whose mart is absent are left out."""
    ending = EXPORTS[export_format][0]
    store = Store(spark, export_dir)
    marts = {}
    for name in MA.CHART_SOURCES:
        if _exists(store, name + ending):
            path = store.path(name + ending)
            if export_format == "parquet":
                marts[name] = spark.read.parquet(path)
            else:
                t = spark.read.options(header="true", escape='"').csv(path)
                marts[name] = t.select(*[F.col(c).try_cast("double" if c == "share" else "long").alias(c) if c in MA.NUMBER_COLUMNS else F.col(c) for c in t.columns])
    return {n: export(df, export_dir.rstrip("/") + "/charts", n, export_format) for n, df in MA.chart_data(marts).items()}


def _exists(store: Store, name: str) -> bool:
    jvm = store.spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(store.path(name))
    return path.getFileSystem(store.spark._jsc.hadoopConfiguration()).exists(path)


def print_profiles(store: Store, n: int) -> None:
    """The console profiles of the presentation job.

    Every list is a small aggregate or a sample; ``n`` rows of each reach the
    driver, and the leading industries of every province whole."""

    def shown(title: str, df: DataFrame, rows: int = n) -> None:
        print(f"\n[{title}]")
        df.show(rows, truncate=False)

    shown("Postings by industry", _industry_totals_from_store(store).orderBy(F.desc("total_jobs"), F.asc("industry_name")))
    by_loc = _by_location_from_store(store)
    shown("Postings by province and industry, some rows", by_loc)
    leading = MA.top_industries_by_province(MA.industry_by_location_viz(by_loc), 3)
    shown("Three leading industries of each province", leading, leading.count())
    for kind in PRESENTATION_KINDS:
        if _exists(store, f"requirement_analysis/{kind}_total"):
            mart = MA.requirement_mart(_requirements_from_store(store, [kind]), kind)
            shown(f"Requirement '{kind}', 20 most frequent", mart, 20)
    if not _exists(store, "job_base_clean"):
        return
    base = store.read("job_base_clean", S.JOB_BASE_CLEAN)
    shown("Postings, some rows", base)
    if store.fmt == "tsv":
        ragged = read_ragged_tsv(store.spark, store.path("job_base_clean"), ["job_id"] + S.RAW_TEXT_COLUMNS, id_col="job_id")
        shown("Fields per posting line", MA.width_profile(ragged), 50)
    shown("Most frequent raw locations", MA.top_raw_locations(base, n))


STAGES = ["base", "location", "industry", "requirements", "features", "presentation"]


def run(
    spark: SparkSession,
    input_path,
    output_dir: str,
    *,
    table_format: str = "parquet",
    export_format: str = "csv",
    export_dir: str | None = None,
    parser: str = "regex",
    pig_null_case: bool = True,
    overwrite: bool = False,
    show: int = 0,
    chart_data: bool = False,
    input_format: str = "jsonl",
    stages: list[str] | None = None,
    match: str = "substring",
) -> dict[str, str]:
    """Run the stages (all by default); returns the exported mart paths.

    ``input_format="job_base_clean"`` starts from an existing tab-separated
    job_base_clean table (ids already assigned) and runs stages 2-6.  With
    ``stages``, only those run, in their order, over the tables that earlier
    ones left in ``output_dir``.
    """
    store = Store(spark, output_dir, table_format)
    wanted = STAGES if stages is None else [s for s in STAGES if s in stages]
    if stages is not None and set(stages) - set(STAGES):
        raise ValueError(f"stages are {', '.join(STAGES)}")
    export_to = _export_dir(store, export_dir) if "presentation" in wanted else None
    if "base" not in wanted and input_format == "jsonl":
        if not {"location", "industry", "requirements"} & set(wanted):
            return _late_stages(store, wanted, export_to, export_format, show, chart_data)
        stored = store.read("job_base_clean", S.JOB_BASE_CLEAN)
    elif input_format == "job_base_clean":
        stored = read_tsv(spark, input_path, S.JOB_BASE_CLEAN)
    elif input_format == "jsonl":
        stored = stage_base(store, input_path, parser, "overwrite" if overwrite else "errorifexists")
    else:
        raise ValueError(f"unknown input format: {input_format}")
    base = empty_as_null(stored, S.RAW_TEXT_COLUMNS)
    enriched = enrich(base)
    # The requirement stage needs only the postings, so it runs beside the
    # location and industry writes.
    actions = [lambda: stage_requirements(store, enriched, pig_null_case)] if "requirements" in wanted else []
    if {"location", "industry"} & set(wanted):
        labels = LO.location_labels(enriched, match)
        write_parquet(LO.location_industry_facts(enriched), store.path(FACTS_TABLE))
        facts = store.spark.read.parquet(store.path(FACTS_TABLE))
        actions += stage_location(store, enriched, labels, facts) if "location" in wanted else []
        actions += stage_industry(store, enriched, labels, facts) if "industry" in wanted else []
    run_concurrently(actions)
    return _late_stages(store, wanted, export_to, export_format, show, chart_data)


def _late_stages(store: Store, wanted: list[str], export_to: str | None, export_format: str, show: int, chart_data: bool) -> dict[str, str]:
    if "features" in wanted:
        stage_features(store)
    if "presentation" not in wanted:
        return {}
    if show > 0:
        print_profiles(store, show)
    return stage_presentation(store, export_to, export_format, chart_data)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(description="Job-posting analytics batch job")
    ap.add_argument("--input", nargs="+", help="JSON-lines postings or a job_base_clean table (files, folders or globs)")
    ap.add_argument("--input-format", default="jsonl", choices=["jsonl", "job_base_clean"])
    ap.add_argument("--output-dir", required=True)
    ap.add_argument("--presentation-only", action="store_true",
                    help="only build the marts from existing tables (of --table-format) in --output-dir")
    ap.add_argument("--table-format", default="parquet", choices=["parquet", "tsv"])
    ap.add_argument("--stages", help=f"comma-separated stages to run over existing tables, of {','.join(STAGES)}")
    ap.add_argument("--charts-only", action="store_true", help="only build chart data from marts exported before")
    ap.add_argument("--export-format", default="csv", choices=list(EXPORTS))
    ap.add_argument("--export-dir", default=None)
    ap.add_argument("--parser", default="regex", choices=["regex", "json"])
    ap.add_argument("--match", default="substring", choices=list(LO.MATCHES), help="how location keywords match")
    ap.add_argument("--sql-case", action="store_true",
                    help="experience buckets with SQL CASE semantics instead of the reference's NULL rule")
    ap.add_argument("--overwrite", action="store_true", help="replace job_base_clean and data_quality_stats")
    ap.add_argument("--show", type=int, default=0, help="print console profiles with this many rows")
    ap.add_argument("--chart-data", action="store_true", help="also export the data behind each chart (viz/charts)")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("hiremart").getOrCreate()
    if args.presentation_only:
        out = presentation_from_tables(spark, args.output_dir, args.export_dir, args.export_format, args.show, args.chart_data, args.table_format)
        for name, path in out.items():
            print(f"{name}\t{path}")
        return 0
    if args.charts_only:
        out = charts_from_exports(spark, args.export_dir or args.output_dir.rstrip("/") + "/viz", args.export_format)
        for name, path in out.items():
            print(f"{name}\t{path}")
        return 0 if out else 1
    stages = args.stages.split(",") if args.stages else None
    if not args.input and (stages is None or "base" in stages):
        ap.error("--input is required unless the stages start from existing tables")
    out = run(
        spark, args.input, args.output_dir,
        table_format=args.table_format, export_format=args.export_format, export_dir=args.export_dir,
        parser=args.parser, pig_null_case=not args.sql_case, overwrite=args.overwrite, show=args.show,
        chart_data=args.chart_data, input_format=args.input_format, stages=stages, match=args.match,
    )
    for name, path in out.items():
        print(f"{name}\t{path}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())


__all__ = ["run", "main", "presentation_from_tables", "Store", "data_quality_report", "valid_postings"]
