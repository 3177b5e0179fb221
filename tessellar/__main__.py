"""python -m tessellar COMMAND: retrieve, metadata, split, assemble, split-parquet."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellar import schemas
from tessellar.operators import assemble, keyed, retrieve, split
from tessellar.plans.dataset import metadata_of, stored
from tessellar.session import session
from tessellar.sources import batches, files, remote, sinks


def _retrieve(spark: SparkSession, a: argparse.Namespace, http=None) -> str:
    """Articles that are needed, out of the API and the batch files, written to the folder; a PDF that fails is reported."""
    if http is None:
        from tessellar.sources import http
    spark.dataSource.register(remote.article_source(http.get_json, a.api))
    listed = spark.read.format("articles").option("query", retrieve.source_query(a.query)).option("page_size", a.page_size).load()
    wanted = retrieve.needs(listed, files.existing(spark, a.output_dir), a.skip_existing).persist()
    if wanted.isEmpty():
        return "Nothing to download."
    page = spark.createDataFrame([(http.get_text(a.batches + "/"),)], "html string")
    found = retrieve.fetch_list(wanted.select("number"), batches.batch_links(page, "html", a.batches), None)
    got = batches.read_batches(found.select("number", "url"), http.open_batch)
    # of an article in several batches the first counts
    one = got.groupBy("ppr_id").agg(F.min_by(F.struct("xml", "batch_url", "downloaded_at"), "batch_url").alias("r")).select("ppr_id", "r.*")
    chosen = (one if a.limit is None else one.orderBy("ppr_id").limit(a.limit)).persist()
    old = files.read_sidecars(spark, a.output_dir).select(retrieve.article_number(F.col("ppr_id")).alias("ppr_id"), *schemas.PROVENANCE_FIELDS)
    texts, log = stored(chosen, wanted, old.join(chosen, "ppr_id", "left_semi"))
    pdfs = batches.fetch_files(wanted.where("pdf_needed").join(chosen.select(F.col("ppr_id").alias("number")), "number", "left_semi"), "number", "pdf_url", http.fetch).persist()
    urls = pdfs.where("content IS NOT NULL").join(wanted, "number").select(F.col("number").alias("ppr_id"), F.col("pdf_url").alias("pdf_source_url"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("pdf_downloaded_at"))
    empty = urls.select("ppr_id", *[F.lit(None).cast(t).alias(f) for f, t in (("xml_source_url", "string"), ("xml_downloaded_at", "string"), ("xml_ftfy_applied", "boolean"))], "pdf_source_url", "pdf_downloaded_at")
    sinks.write_documents(texts.select("ppr_id", "xml", "xml_original"), a.output_dir)
    sinks.write_documents(pdfs.where("content IS NOT NULL").select(F.col("number").alias("ppr_id"), F.col("content").alias("pdf")), a.output_dir)
    sinks.write_documents(keyed.upsert(log, empty, "ppr_id"), a.output_dir)
    for r in pdfs.where("error IS NOT NULL").select("number", "error").limit(20).collect():
        print(f"PDF download failed for PPR{r.number}: {r.error}", file=sys.stderr)
    return f"Finished. Downloaded: {chosen.count()}"


def _metadata(spark: SparkSession, a: argparse.Namespace) -> str:
    texts = files.read_xml(spark, a.input_dir)
    rows = metadata_of(texts, files.read_sidecars(spark, a.input_dir)).persist()
    sinks.write_jsonl(rows, a.output_jsonl)
    return f"Wrote metadata for {rows.count()} documents to {a.output_jsonl}"


def _counts(df: DataFrame) -> str:
    n = {r["split"]: r["n"] for r in split.split_counts(df).collect()}
    return " ".join(f"{s}={n[s]}" for s in split.SPLITS) + f" (total={sum(n.values())})"


def _split(spark: SparkSession, a: argparse.Namespace) -> str:
    split.checked_shares(a.train, a.val)
    rows = split.non_empty(files.read_jsonl(spark, a.metadata_jsonl, "ppr_id STRING, language STRING"), a.metadata_jsonl)
    got = split.stratified_split(rows, "ppr_id", "language", a.train, a.val, a.seed).select("ppr_id", "split").persist()
    sinks.write_csv(got.orderBy(split.seeded(F.col("ppr_id"), a.seed + 1)), a.output_csv)
    return "Split: " + _counts(got)


def _assemble(spark: SparkSession, a: argparse.Namespace) -> str:
    splits = files.read_csv(spark, a.split_csv).select("ppr_id", "split")
    lines = files.read_jsonl(spark, a.metadata_jsonl).withColumn("line_no", F.monotonically_increasing_id())
    documents = files.read_xml(spark, a.documents_dir).select("ppr_id", "xml").join(files.read_binary(spark, a.documents_dir), "ppr_id", "left")
    whole = assemble.with_files(assemble.with_metadata(splits, lines), documents).select("split", *schemas.names(schemas.DATASET))
    return "\n".join(f"wrote {n}" for n in sinks.name_split_files(whole, a.output_dir))


def _split_parquet(spark: SparkSession, a: argparse.Namespace) -> str:
    rows = split.non_empty(files.read_parquets(spark, a.input_dir).drop("file_split"), a.input_dir)
    keyed_rows = rows.withColumn("__row", F.xxhash64(F.to_json(F.struct("*")), F.monotonically_increasing_id()))
    got = split.two_step_split(keyed_rows, "__row", a.seed).distinct()
    return "\n".join(f"wrote {n}" for n in sinks.name_split_files(keyed_rows.join(got, "__row").drop("__row"), a.output_dir))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tessellar", description=__doc__)
    commands = top.add_subparsers(required=True)

    def command(name: str, run, *places: str) -> argparse.ArgumentParser:
        p = commands.add_parser(name)
        for place in places:
            p.add_argument(place)
        p.set_defaults(run=run)
        return p

    r = command("retrieve", _retrieve, "output_dir")
    r.add_argument("--api", required=True, help="url of the search of the API")
    r.add_argument("--batches", required=True, help="url of the folder of the batch files")
    r.add_argument("--limit", type=int)
    r.add_argument("--query", default="")
    r.add_argument("--page-size", type=int, default=100)
    r.add_argument("--no-skip-existing", dest="skip_existing", action="store_false")
    command("metadata", _metadata, "input_dir", "output_jsonl")
    s = command("split", _split, "metadata_jsonl", "output_csv")
    s.add_argument("--train", type=float, default=0.2)
    s.add_argument("--val", type=float, default=0.3)
    s.add_argument("--seed", type=int, default=42)
    command("assemble", _assemble, "documents_dir", "split_csv", "metadata_jsonl", "output_dir")
    p = command("split-parquet", _split_parquet)
    p.add_argument("--input-dir", required=True)
    p.add_argument("--output-dir", required=True)
    p.add_argument("--seed", type=int, default=42)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        print(a.run(spark or session("tessellar"), a))
    except (ValueError, FileNotFoundError) as e:
        print(e, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
