"""Command-line entry for running catalogue stages as Spark applications.

    spark-submit folio/cli.py ingest   --input-dir RAW_CSV_DIR --output-dir INGESTED [--per-source-dir DIR]
    spark-submit folio/cli.py clean    --input-dir INGESTED --output-dir CLEAN
    spark-submit folio/cli.py enrich   --input-dir CLEAN --metadata META --output-dir ENRICHED [--use-author]
    spark-submit folio/cli.py features --input-dir ENRICHED --output-dir FEATURES
    spark-submit folio/cli.py store    --input-dir ENRICHED --store BOOKS [--cluster-by-key]
    spark-submit folio/cli.py stats    --ingested INGESTED --clean CLEAN --enriched ENRICHED
    spark-submit folio/cli.py embed    --input-dir ENRICHED --output-dir EMBEDDINGS
    spark-submit folio/cli.py validate --input-dir ENRICHED --embeddings EMBEDDINGS
    spark-submit folio/cli.py recommend --store BOOKS --embeddings EMBEDDINGS --query TEXT [--top-k 5] [--output-dir OUT]
    spark-submit folio/cli.py browse   --store BOOKS [--skip 0] [--limit 25] [--field title --query TEXT]
    spark-submit folio/cli.py run      --input-dir RAW_CSV_DIR --metadata META --output-dir OUT

Stage tables are Parquet.  ``--metadata`` is a Parquet table with
``isbn_key, title_key, meta_pos, info_json`` (one metadata document per row).
The session comes from ``spark-submit`` (or ``SparkSession.builder`` defaults);
nothing here sets cluster configuration.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from folio.constants import DEFAULT_PAGE_SIZE, DEFAULT_TOP_K  # noqa: E402


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="folio", description="Catalogue stages on Spark")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("ingest", help="CSV directory -> canonical ingested table")
    s.add_argument("--input-dir", required=True)
    s.add_argument("--output-dir", required=True)
    s.add_argument("--no-multiline", action="store_true", help="split large files (no quoted line breaks)")
    s.add_argument("--per-source-dir", help="also write the ingested rows as CSV, one directory per input file")

    s = sub.add_parser("clean", help="normalise, validate, dedupe, record ids")
    s.add_argument("--input-dir", required=True)
    s.add_argument("--output-dir", required=True)

    s = sub.add_parser("enrich", help="tiered lookup against a metadata table")
    s.add_argument("--input-dir", required=True)
    s.add_argument("--metadata", required=True)
    s.add_argument("--output-dir", required=True)
    s.add_argument("--use-author", action="store_true")
    s.add_argument("--skew-salt", type=int, default=0)

    s = sub.add_parser("features", help="frozen feature table")
    s.add_argument("--input-dir", required=True)
    s.add_argument("--output-dir", required=True)

    s = sub.add_parser("store", help="insert-or-ignore into the books table")
    s.add_argument("--input-dir", required=True)
    s.add_argument("--store", required=True)
    s.add_argument("--cluster-by-key", action="store_true", help="range-cluster new files by book_key")

    s = sub.add_parser("stats", help="data-quality report per stage")
    s.add_argument("--ingested", required=True)
    s.add_argument("--clean", required=True)
    s.add_argument("--enriched", required=True)

    s = sub.add_parser("embed", help="semantic text -> vectors, saved with their ids")
    s.add_argument("--input-dir", required=True)
    s.add_argument("--output-dir", required=True)

    s = sub.add_parser("validate", help="ids against vectors; fails if they do not match")
    s.add_argument("--input-dir", required=True)
    s.add_argument("--embeddings", required=True)

    s = sub.add_parser("recommend", help="the stored books nearest to a text")
    s.add_argument("--store", required=True)
    s.add_argument("--embeddings", required=True)
    s.add_argument("--query", required=True, action="append")
    s.add_argument("--top-k", type=int, default=DEFAULT_TOP_K)
    s.add_argument("--output-dir")

    s = sub.add_parser("browse", help="one page of the stored books, with the number of matches")
    s.add_argument("--store", required=True)
    s.add_argument("--skip", type=int, default=0)
    s.add_argument("--limit", type=int, default=DEFAULT_PAGE_SIZE)
    s.add_argument("--field")
    s.add_argument("--query")

    s = sub.add_parser("run", help="all stages, each written as a table")
    s.add_argument("--input-dir", required=True)
    s.add_argument("--metadata", required=True)
    s.add_argument("--output-dir", required=True)
    return p


def _order(df):
    from folio.sources.catalog_csv import ORDER_COLUMNS

    return ORDER_COLUMNS if all(c in df.columns for c in ORDER_COLUMNS) else ("row_pos",)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    own = spark is None
    spark = spark or SparkSession.builder.appName(f"folio-{args.cmd}").getOrCreate()

    from folio.operators.cleaning import clean
    from folio.operators.enrichment import enrich
    from folio.operators.features import features
    from folio.operators.quality import enrichment_stats, profile, stage_summary
    from folio.operators.store import append_to_store, to_store_rows
    from folio.operators.search import browse
    from folio.operators.vectors import require_aligned
    from folio.plans.jobs import build_embeddings, recommend, run_catalog
    from folio.session import clean_scratch
    from folio.sources.catalog_csv import ingest
    from folio.sources.sinks import read_embeddings

    if args.cmd == "ingest":
        ingest(spark, args.input_dir, multiline=not args.no_multiline).write.mode("overwrite").parquet(args.output_dir)
        if args.per_source_dir:
            # S5 from the written table (the CSV parse is not repeated).  Rows
            # leave each task in input-file order; no shuffle precedes the write.
            from folio.sources.catalog_csv import ORDER_COLUMNS
            from folio.sources.sinks import write_per_source

            table = spark.read.parquet(args.output_dir).sortWithinPartitions("source_file", *ORDER_COLUMNS)
            write_per_source(table.drop(*ORDER_COLUMNS), args.per_source_dir)
    elif args.cmd == "clean":
        df = spark.read.parquet(args.input_dir)
        clean(df, _order(df)).write.mode("overwrite").parquet(args.output_dir)
    elif args.cmd == "enrich":
        df = spark.read.parquet(args.input_dir)
        order = _order(df)
        out = enrich(df, spark.read.parquet(args.metadata), use_author=args.use_author, carry=tuple(order),
                     skew_salt=args.skew_salt)
        out.write.mode("overwrite").parquet(args.output_dir)
    elif args.cmd == "features":
        features(spark.read.parquet(args.input_dir)).write.mode("overwrite").parquet(args.output_dir)
    elif args.cmd == "store":
        df = spark.read.parquet(args.input_dir)
        order = _order(df)
        stored = append_to_store(spark, to_store_rows(df, keep=list(order)), args.store, order=order,
                                 cluster_by_key=args.cluster_by_key)
        print(f"stored rows: {stored.count()}")
    elif args.cmd == "stats":
        ingested, cleaned, enriched = (spark.read.parquet(p) for p in (args.ingested, args.clean, args.enriched))
        profile(ingested, distinct=["title", "isbn"], missing=["isbn", "year"]).show(truncate=False)
        profile(cleaned, distinct=["record_id", "isbn"], missing=["isbn"], present=["isbn"]).show(truncate=False)
        enrichment_stats(enriched).show(truncate=False)
        stage_summary({"ingested": ingested, "cleaned": cleaned, "enriched": enriched}).show(truncate=False)
    elif args.cmd == "embed":
        build_embeddings(spark.read.parquet(args.input_dir), args.output_dir)
    elif args.cmd == "validate":
        ids = spark.read.parquet(args.input_dir).select("record_id")
        require_aligned(ids, read_embeddings(spark, args.embeddings), "record_id")
    elif args.cmd == "recommend":
        queries = spark.createDataFrame(list(enumerate(args.query)), "qid int, text string")
        rows = recommend(spark.read.parquet(args.store), read_embeddings(spark, args.embeddings), queries, args.top_k)
        if args.output_dir:
            rows.write.mode("overwrite").parquet(args.output_dir)
        else:
            rows.select("qid", "rank", "score", "record_id", "title", "authors", "page", "total_pages").show(
                len(args.query) * max(1, args.top_k), truncate=80)
    elif args.cmd == "browse":
        books = spark.read.parquet(args.store).select("book_key", "title", "authors", "publisher", "year", "isbn")
        browse(books, ["book_key"], args.skip, args.limit, args.field, args.query).show(max(1, args.limit), truncate=80)
    elif args.cmd == "run":
        paths = run_catalog(spark, args.input_dir, spark.read.parquet(args.metadata), args.output_dir)
        print(paths)
    if own:
        clean_scratch(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
