"""Registered queries of the core, each with the SQL it is checked against where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellar import schemas
from tessellar.functions import text as tx
from tessellar.operators import assemble, audit, keyed, nested, retrieve, split, xmlmeta

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _author_text(c: str = "authors") -> F.Column:
    one = lambda a: F.concat_ws("~", F.coalesce(a["name"], F.lit("")), F.coalesce(a["orcid"], F.lit("")), F.array_join(a["affiliations"], "^"))
    return F.array_join(F.transform(F.col(c), one), "|")


_AUTHOR_SQL = "array_to_string(list_transform(authors, lambda a: coalesce(a.name,'') || '~' || coalesce(a.orcid,'') || '~' || array_to_string(a.affiliations, '^')), '|')"
_CODE_SQL = "CASE language_raw WHEN 'pt' THEN 'pt' WHEN 'PT' THEN 'pt' WHEN 'po' THEN 'pt' WHEN 'es' THEN 'es' WHEN 'sp' THEN 'es' WHEN 'en' THEN 'en' WHEN 'fr' THEN 'fr' WHEN 'de' THEN 'de' ELSE lower(coalesce(language_raw,'')) END"
_STRATUM_SQL = "CASE WHEN language IN ('pt','es') THEN language ELSE 'other' END"


# ---- language and splits


@query(f"SELECT ppr_id, language_raw, {_CODE_SQL} AS language FROM hf_dataset")
def lang_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "hf_dataset").select("ppr_id", "language_raw", tx.language_code(F.col("language_raw")).alias("language"))


@query(f"SELECT {_STRATUM_SQL} AS stratum, count(*) AS n FROM metadata_lines GROUP BY 1")
def stratum_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "metadata_lines").groupBy(split.stratum(F.col("language")).alias("stratum")).agg(F.count(F.lit(1)).alias("n"))


_SPLIT_SQL = f"""
SELECT ppr_id, stratum, CASE WHEN rn <= round_even(n * CAST(0.2 AS DOUBLE), 0) THEN 'train' WHEN rn <= round_even(n * CAST(0.2 AS DOUBLE), 0) + round_even(n * CAST(0.3 AS DOUBLE), 0) THEN 'val' ELSE 'test' END AS split
FROM (SELECT ppr_id, stratum, row_number() OVER (PARTITION BY stratum ORDER BY md5('42:' || ppr_id), ppr_id) AS rn, count(*) OVER (PARTITION BY stratum) AS n
      FROM (SELECT ppr_id, {_STRATUM_SQL} AS stratum FROM hf_dataset))"""


@query(_SPLIT_SQL)
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stratified_split(read(spark, sf_dir, "hf_dataset"), "ppr_id", "language")


@query(f"SELECT stratum, count(*) FILTER (split='train') AS train, count(*) FILTER (split='val') AS val, count(*) FILTER (split='test') AS test FROM ({_SPLIT_SQL}) GROUP BY stratum")
def stratum_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stratum_counts(stratified_split(spark, sf_dir))


@query(f"SELECT s.split, coalesce(n, 0) AS n FROM (VALUES ('train'),('val'),('test')) s(split) LEFT JOIN (SELECT split, count(*) AS n FROM ({_SPLIT_SQL}) GROUP BY split) USING (split)")
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_counts(stratified_split(spark, sf_dir))


@query(
    """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rn, count(*) OVER () AS n FROM documents),
s AS (SELECT *, ceil(n * CAST(0.8 AS DOUBLE)) AS held, ceil(ceil(n * CAST(0.8 AS DOUBLE)) * CAST(0.625 AS DOUBLE)) AS tests FROM r)
SELECT doc_id, CASE WHEN rn <= n - held THEN 'train' WHEN rn <= n - tests THEN 'validation' ELSE 'test' END AS split FROM s"""
)
def two_step_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.two_step_split(read(spark, sf_dir, "documents"), "doc_id")


@query("SELECT ppr_id, CASE WHEN split = 'val' THEN 'validation' ELSE split END AS split FROM split_assignments")
def split_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "split_assignments").select("ppr_id", split.split_table(F.col("split")).alias("split"))


# ---- extraction from XML


@query(
    f"SELECT ppr_id, doi, version, title, {_AUTHOR_SQL} AS authors, pub_date, license, array_to_string(keywords, '|') AS keywords, subject_heading, subject_europepmc_category, article_type, language, language_raw "
    "FROM hf_dataset WHERE article_type <> '' OR language_raw <> '' OR doi <> '' OR title <> ''"
)
def metadata_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All metadata read out of the XML of every record; records whose XML is not well formed give no row."""
    got = xmlmeta.with_subjects(xmlmeta.read_articles(read(spark, sf_dir, "hf_dataset"), "ppr_id", "xml"))
    flat = got.withColumns({"authors": _author_text(), "keywords": F.array_join("keywords", "|")})
    return flat.withColumns({c: F.coalesce(c, F.lit("")) for c in ("subject_heading", "subject_europepmc_category")})


@query("SELECT ppr_id FROM hf_dataset WHERE NOT (article_type <> '' OR language_raw <> '' OR doi <> '' OR title <> '')")
def unreadable_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xmlmeta.unreadable(read(spark, sf_dir, "hf_dataset"), "ppr_id", "xml")


@query("SELECT ppr_id, CAST(len(authors) AS BIGINT) AS n, coalesce(list_sum(list_transform(authors, lambda a: len(a.affiliations))), 0)::BIGINT AS affiliations, len(list_filter(authors, lambda a: a.orcid <> ''))::BIGINT AS orcids FROM hf_dataset WHERE len(authors) > 0")
def author_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = xmlmeta.read_articles(read(spark, sf_dir, "hf_dataset"), "ppr_id", "xml").where("size(authors) > 0")
    affiliations = F.aggregate("authors", F.lit(0).cast("bigint"), lambda n, a: n + F.size(a["affiliations"]))
    return got.select("ppr_id", F.size("authors").cast("bigint").alias("n"), affiliations.alias("affiliations"), F.size(F.filter("authors", lambda a: a["orcid"] != "")).cast("bigint").alias("orcids"))


@query("SELECT ppr_id, replace(ppr_id, 'PPR', 'PPR') AS id, 'PPR' || substr(ppr_id, 4) AS from_stem FROM hf_dataset")
def id_from_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = read(spark, sf_dir, "hf_dataset").select("ppr_id")
    return ids.select("ppr_id", xmlmeta.article_id(F.col("ppr_id")).alias("id"), xmlmeta.article_id(F.concat(F.lit("PPR_"), F.substring("ppr_id", 4, 99))).alias("from_stem"))


@query(
    """SELECT event_id, concat_ws('-', nullif(y, ''), CASE WHEN length(m) < 2 THEN lpad(m, 2, '0') ELSE m END, CASE WHEN length(d) < 2 THEN lpad(d, 2, '0') ELSE d END) AS pub_date FROM (
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '' ELSE year(ts)::VARCHAR END AS y, CASE WHEN event_id % 5 = 0 THEN '' ELSE month(ts)::VARCHAR END AS m, CASE WHEN event_id % 11 = 0 THEN '123' ELSE day(ts)::VARCHAR END AS d FROM events)"""
)
def date_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda f, k, other: F.when(F.col("event_id") % k == 0, other).otherwise(f("ts").cast("string"))
    return read(spark, sf_dir, "events").select("event_id", tx.joined_date(part(F.year, 7, ""), part(F.month, 5, ""), part(F.day, 11, "123")).alias("pub_date"))


@query("SELECT ppr_id, array_to_string(list_filter(list_transform(list_concat(keywords, [' ', '', chr(160) || title || chr(9)]), lambda k: regexp_replace(k, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g')), lambda k: k <> ''), '|') AS keywords FROM hf_dataset")
def keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.col("keywords"), F.array(F.lit(" "), F.lit(""), F.concat(F.lit(" "), F.col("title"), F.lit("\t"))))
    return read(spark, sf_dir, "hf_dataset").select("ppr_id", F.array_join(tx.non_blank(padded), "|").alias("keywords"))


@query("SELECT user_id, arg_max(event_id, event_id) FILTER (event_type = 'click') AS click, arg_max(event_id, event_id) FILTER (event_type = 'view') AS view FROM events GROUP BY user_id")
def subject_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open map of the last value for each kind, two known kinds taken out."""
    last = keyed.last_wins(read(spark, sf_dir, "events").select(F.concat_ws("/", "user_id", "event_type").alias("k"), "user_id", "event_type", "event_id"), "k", [F.col("event_id")])
    wide = last.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "event_id"))).alias("m"))
    return wide.select("user_id", F.col("m")["click"].alias("click"), F.col("m")["view"].alias("view"))


# ---- text


@query("SELECT doc_id, text FROM documents")
def mojibake_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text spoilt by reading its UTF-8 as Latin-1, repaired again."""
    spoilt = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return read(spark, sf_dir, "documents").select("doc_id", tx.fixed_text(spoilt).alias("text"))


@query("SELECT doc_id, NOT regexp_full_match(text, '[\\x00-\\x7f]*', 's') AS changed FROM documents")
def repair_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    spoilt = read(spark, sf_dir, "documents").select("doc_id", F.decode(F.encode("text", "UTF-8"), "ISO-8859-1").alias("text"))
    return xmlmeta.repaired(spoilt, "text").select("doc_id", F.col("text_changed").alias("changed"))


@query("SELECT doc_id, replace(replace(replace(text, ' ', chr(13) || chr(10)), chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text FROM documents")
def newline_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", tx.unix_newlines(F.regexp_replace("text", " ", "\r\n")).alias("text"))


@query("SELECT ppr_id, octet_length(pdf)::BIGINT AS bytes, substr(title, 1, 70) AS title FROM hf_dataset")
def binary_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "hf_dataset").select("ppr_id", F.octet_length("pdf").cast("bigint").alias("bytes"), F.substring("title", 1, 70).alias("title"))


@query("SELECT event_id, coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT), -1) AS k, coalesce(json_extract_string(props, '$.absent'), 'none') AS absent FROM events")
def json_get_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = F.from_json("props", "k BIGINT, absent STRING", {"mode": "FAILFAST"})
    return read(spark, sf_dir, "events").select("event_id", F.coalesce(got["k"], F.lit(-1)).alias("k"), F.coalesce(got["absent"], F.lit("none")).alias("absent"))


@query("SELECT ppr_id, recorded_at IS NOT NULL AS stamped, strftime(recorded_at AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(recorded_at) % 1000000 = 0 THEN '' ELSE strftime(recorded_at AT TIME ZONE 'UTC', '.%f') END || '+00:00' AS at FROM provenance")
def iso_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "provenance").select("ppr_id", F.col("recorded_at").isNotNull().alias("stamped"), tx.iso_stamp(F.col("recorded_at")).alias("at"))


# ---- one row per key, provenance


_LAST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ppr_id ORDER BY line_no DESC) AS rn FROM metadata_lines) WHERE rn = 1"


@query(f"SELECT ppr_id, line_no, doi, version, title FROM ({_LAST})")
def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.last_wins(read(spark, sf_dir, "metadata_lines"), "ppr_id", [F.col("line_no")]).select("ppr_id", "line_no", "doi", "version", "title")


_MERGED_SQL = "SELECT ppr_id, " + ", ".join(
    f"max(CASE WHEN {f} IS NOT NULL THEN {{'r': recorded_at, 'l': loaded_at, 'v': {f}}} END).v AS {f}" for f in schemas.PROVENANCE_FIELDS
) + " FROM provenance GROUP BY ppr_id"


@query(_MERGED_SQL)
def provenance_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.merged_log(read(spark, sf_dir, "provenance"), "ppr_id", ["recorded_at", "loaded_at"])


@query(f"SELECT h.ppr_id, m.xml_source_url, m.xml_downloaded_at, m.xml_ftfy_applied, m.pdf_source_url, m.pdf_downloaded_at FROM hf_dataset h LEFT JOIN ({_MERGED_SQL}) m ON h.ppr_id = m.ppr_id")
def sidecar_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.with_sidecar(read(spark, sf_dir, "hf_dataset").select("ppr_id"), provenance_merge(spark, sf_dir), "ppr_id")


@query(
    f"""WITH old AS (SELECT ppr_id, xml_source_url, pdf_source_url FROM hf_dataset), new AS ({_MERGED_SQL})
SELECT ppr_id, coalesce(new.xml_source_url, old.xml_source_url) AS xml_source_url, coalesce(new.pdf_source_url, old.pdf_source_url) AS pdf_source_url FROM old FULL JOIN new USING (ppr_id)"""
)
def provenance_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("xml_source_url", "pdf_source_url")
    return keyed.upsert(read(spark, sf_dir, "hf_dataset").select("ppr_id", *fields), provenance_merge(spark, sf_dir), "ppr_id", fields)


# ---- assembly


@query(
    f"""SELECT s.split, s.ppr_id, coalesce(doi,'') AS doi, coalesce(version,'') AS version, coalesce(title,'') AS title, coalesce({_AUTHOR_SQL},'') AS authors, coalesce(pub_date,'') AS pub_date, coalesce(license,'') AS license,
coalesce(array_to_string(keywords,'|'),'') AS keywords, coalesce(subject_heading,'') AS subject_heading, coalesce(subject_europepmc_category,'') AS subject_europepmc_category, coalesce(article_type,'') AS article_type, coalesce(language,'') AS language,
coalesce(language_raw,'') AS language_raw, coalesce(xml_source_url,'') AS xml_source_url, coalesce(xml_downloaded_at,'') AS xml_downloaded_at, coalesce(xml_ftfy_applied,false) AS xml_ftfy_applied, coalesce(pdf_source_url,'') AS pdf_source_url, coalesce(pdf_downloaded_at,'') AS pdf_downloaded_at
FROM split_assignments s LEFT JOIN ({_LAST}) m ON s.ppr_id = m.ppr_id"""
)
def assemble_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = assemble.with_metadata(read(spark, sf_dir, "split_assignments"), read(spark, sf_dir, "metadata_lines"))
    return got.withColumns({"authors": _author_text(), "keywords": F.array_join("keywords", "|")})


@query("SELECT s.split, s.ppr_id, length(replace(replace(xml, chr(13) || chr(10), chr(10)), chr(13), chr(10)))::BIGINT AS chars, octet_length(pdf)::BIGINT AS bytes FROM split_assignments s JOIN hf_dataset h ON s.ppr_id = h.ppr_id")
def assemble_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = assemble.with_files(read(spark, sf_dir, "split_assignments"), read(spark, sf_dir, "hf_dataset"), strict=False)
    return got.select("split", "ppr_id", F.length("xml").cast("bigint").alias("chars"), F.octet_length("pdf").cast("bigint").alias("bytes"))


@query("SELECT DISTINCT ppr_id FROM split_assignments WHERE ppr_id NOT IN (SELECT ppr_id FROM hf_dataset)")
def missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.missing_files(read(spark, sf_dir, "split_assignments"), read(spark, sf_dir, "hf_dataset"))


@query("SELECT CASE WHEN split = 'val' THEN 'validation' ELSE split END AS split, count(*) AS n, sum(length(xml))::BIGINT AS chars FROM split_assignments JOIN hf_dataset USING (ppr_id) GROUP BY 1")
def split_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = read(spark, sf_dir, "hf_dataset").select("ppr_id", F.length("xml").cast("bigint").alias("chars"))
    rows = read(spark, sf_dir, "split_assignments").join(files, "ppr_id")
    return rows.groupBy(split.split_table(F.col("split")).alias("split")).agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))


# ---- retrieval


_NUMBERED = "SELECT *, TRY_CAST(substr(id, 4) AS BIGINT) AS number FROM api_articles WHERE id LIKE 'PPR%' AND TRY_CAST(substr(id, 4) AS BIGINT) IS NOT NULL"
_URL = "list_filter(fulltexturllist.fulltexturl, lambda x: x.documentstyle = 'pdf' AND x.site = 'Europe_PMC')[1].url"
_ONE = f"SELECT number, max({{'t': title, 'u': url}}).u AS pdf_url, max({{'t': title, 'u': url}}).t AS title FROM (SELECT number, title, {_URL} AS url FROM ({_NUMBERED})) GROUP BY number"


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "api_articles").select("id", "title", F.col("fulltexturllist").cast("STRUCT<fullTextUrl: ARRAY<STRUCT<documentStyle: STRING, site: STRING, url: STRING>>>").alias("fullTextUrlList"))


def _held(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is there already, as the two thirds of the records by number."""
    rows = read(spark, sf_dir, "hf_dataset").select(retrieve.article_number(F.col("ppr_id")).alias("number"), "pdf_source_url")
    return rows.select("number", F.lit(True).alias("has_xml"), (F.col("pdf_source_url") != "").alias("has_pdf"))


def _wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.numbered(_articles(spark, sf_dir)).select("number").distinct()


@query(f"SELECT id, {_URL} AS pdf_url FROM api_articles")
def first_match_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _articles(spark, sf_dir).select("id", retrieve.pdf_url(F.col("fullTextUrlList.fullTextUrl")).alias("pdf_url"))


@query(f"SELECT id, number FROM ({_NUMBERED})")
def id_parse_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.numbered(_articles(spark, sf_dir)).select("id", "number")


@query(
    f"""WITH held AS (SELECT TRY_CAST(substr(ppr_id, 4) AS BIGINT) AS number, pdf_source_url <> '' AS p FROM hf_dataset)
SELECT a.number, title, pdf_url, held.number IS NULL AS xml_needed, pdf_url IS NOT NULL AND NOT coalesce(p, false) AS pdf_needed FROM ({_ONE}) a LEFT JOIN held ON a.number = held.number
WHERE held.number IS NULL OR (pdf_url IS NOT NULL AND NOT coalesce(p, false))"""
)
def pending_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.needs(_articles(spark, sf_dir), _held(spark, sf_dir))


_BATCHED = f"SELECT DISTINCT i.number, b.url, b.start_id, b.end_id FROM ({_NUMBERED}) i JOIN batch_files b ON i.number BETWEEN b.start_id AND b.end_id"


@query(_BATCHED)
def range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.batches_of(_wanted(spark, sf_dir), read(spark, sf_dir, "batch_files"))


@query(f"SELECT DISTINCT url, start_id, end_id FROM ({_BATCHED})")
def batch_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.needed_batches(_wanted(spark, sf_dir), read(spark, sf_dir, "batch_files"))


@query("SELECT xml_source_url AS url, number, min(ROW(recorded_at, loaded_at)).recorded_at AS recorded_at FROM (SELECT *, TRY_CAST(substr(ppr_id, 4) AS BIGINT) AS number FROM provenance WHERE xml_source_url IS NOT NULL) GROUP BY 1, 2".replace("min(ROW(recorded_at, loaded_at)).recorded_at", "min(recorded_at)"))
def first_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read(spark, sf_dir, "provenance").where("xml_source_url IS NOT NULL")
    rows = log.select(F.col("xml_source_url").alias("url"), retrieve.article_number(F.col("ppr_id")).alias("number"), "recorded_at", "loaded_at")
    return retrieve.first_in_batch(rows, ["recorded_at", "loaded_at"]).select("url", "number", "recorded_at")


@query(f"SELECT number, url, start_id FROM ({_BATCHED}) ORDER BY start_id, url, number LIMIT 100")
def fetch_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hundred articles in the order of retrieval; the limit is the operator."""
    return retrieve.fetch_list(_wanted(spark, sf_dir), read(spark, sf_dir, "batch_files"), limit=100)


@query(f"SELECT DISTINCT number FROM ({_NUMBERED}) WHERE number NOT IN (SELECT TRY_CAST(substr(ppr_id, 4) AS BIGINT) FROM hf_dataset)")
def pending_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wanted(spark, sf_dir).join(_held(spark, sf_dir), "number", "left_anti")


@query(f"SELECT h.ppr_id, a.title, a.pdf_url FROM hf_dataset h JOIN ({_ONE}) a ON a.number = TRY_CAST(substr(h.ppr_id, 4) AS BIGINT)")
def article_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = retrieve.needs(_articles(spark, sf_dir), _held(spark, sf_dir), skip_existing=False).select("number", "title", "pdf_url")
    return read(spark, sf_dir, "hf_dataset").select("ppr_id", retrieve.article_number(F.col("ppr_id")).alias("number")).join(one, "number").drop("number")


@query("SELECT url, start_id, end_id FROM batch_files ORDER BY start_id")
def batch_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches read back out of the links of an index page."""
    from tessellar.sources.batches import batch_links

    page = read(spark, sf_dir, "batch_files").select(F.concat(F.lit('<a href="'), F.substring_index("url", "/", -1), F.lit('">batch</a>')).alias("html"))
    return batch_links(page, "html", "https://files.preprintbank.example/fulltext")


# ---- audit


_OLD = "SELECT CASE WHEN line_no % 2 = 0 THEN 'even' ELSE 'odd' END AS split, nullif(regexp_extract(doi, '^10\\.99871/prelo\\.([0-9]+)', 1), '') AS id FROM metadata_lines"
_LOCAL = "SELECT h.ppr_id, s.split, nullif(regexp_extract(doi, '^10\\.99871/prelo\\.([0-9]+)', 1), '') AS id FROM hf_dataset h JOIN (SELECT DISTINCT * FROM split_assignments) s ON h.ppr_id = s.ppr_id"
_PREFIX = r"10\.99871/prelo\."


def _local(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = read(spark, sf_dir, "hf_dataset").select("ppr_id", audit.leading_number(F.col("doi"), _PREFIX).alias("id"))
    return ids.join(read(spark, sf_dir, "split_assignments").distinct(), "ppr_id").select("ppr_id", "split", "id")


def _foreign(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "metadata_lines").select(F.when(F.col("line_no") % 2 == 0, "even").otherwise("odd").alias("split"), audit.leading_number(F.col("doi"), _PREFIX).alias("id"))
    return audit.distinct_ids(rows)


@query("SELECT ppr_id, nullif(regexp_extract(doi, '^10\\.99871/prelo\\.([0-9]+)', 1), '') AS id FROM hf_dataset")
def doi_id_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "hf_dataset").select("ppr_id", audit.leading_number(F.col("doi"), _PREFIX).alias("id"))


@query(f"SELECT DISTINCT split, id FROM ({_LOCAL}) WHERE id IS NOT NULL")
def distinct_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.distinct_ids(_local(spark, sf_dir))


@query(
    f"""WITH f AS (SELECT DISTINCT split, id FROM ({_OLD}) WHERE id IN (SELECT id FROM ({_LOCAL}) WHERE id IS NOT NULL))
SELECT split, count(DISTINCT id) AS n FROM f GROUP BY split UNION ALL SELECT '*', count(DISTINCT id) FROM f"""
)
def overlap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.overlap_counts(_local(spark, sf_dir), _foreign(spark, sf_dir))


@query(
    f"""SELECT l.id, l.split AS local_split, string_agg(f.split, ',' ORDER BY f.split) AS splits FROM (SELECT DISTINCT id, split FROM ({_LOCAL}) WHERE id IS NOT NULL) l
JOIN (SELECT DISTINCT split, id FROM ({_OLD})) f ON l.id = f.id GROUP BY 1, 2"""
)
def overlap_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.overlap_detail(audit.distinct_ids(_local(spark, sf_dir)), _foreign(spark, sf_dir), ("even", "odd"))


@query(
    f"""SELECT l.split AS a, r.split AS b, count(DISTINCT x.id) AS n FROM (VALUES ('train', 'val'), ('train', 'test'), ('val', 'test')) p(a, b)
JOIN (SELECT 'train' AS split UNION ALL SELECT 'val') l ON l.split = p.a JOIN (SELECT 'val' AS split UNION ALL SELECT 'test') r ON r.split = p.b
LEFT JOIN (SELECT DISTINCT u.split AS s, v.split AS t, u.id FROM ({_LOCAL}) u JOIN ({_LOCAL}) v ON u.id = v.id) x ON x.s = p.a AND x.t = p.b GROUP BY 1, 2"""
)
def cross_split_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.cross_split_pairs(audit.distinct_ids(_local(spark, sf_dir)), ("train", "val", "test"))


_ENTRIES = "SELECT line_no AS pos, 'all' AS split, regexp_extract(doi, '([0-9]+)[^0-9]*$', 1) || coalesce(nullif(CASE WHEN regexp_matches(version, '^[vV]?[0-9]+$') THEN CASE WHEN version ILIKE 'v%' THEN version ELSE 'v' || version END END, ''), '') || '/' AS entry FROM metadata_lines"


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive entries as made of DOI and version: '100004741v5/'."""
    version = F.when(F.col("version").rlike("^[vV]?[0-9]+$"), F.when(F.lower("version").startswith("v"), F.col("version")).otherwise(F.concat(F.lit("v"), "version")))
    entry = F.concat(F.regexp_extract("doi", r"([0-9]+)[^0-9]*$", 1), F.coalesce(version, F.lit("")), F.lit("/"))
    return read(spark, sf_dir, "metadata_lines").select(F.col("line_no").alias("pos"), F.lit("all").alias("split"), entry.alias("entry"))


@query(
    f"""WITH e AS (SELECT split, pos, regexp_extract(entry, '^([0-9]+)[vV][0-9]+/', 1) AS id, regexp_extract(entry, '^[0-9]+([vV][0-9]+)/', 1) AS version FROM ({_ENTRIES}) WHERE regexp_matches(entry, '^[0-9]+[vV][0-9]+/')),
f AS (SELECT split, id, version, min(pos) AS pos FROM e GROUP BY ALL)
SELECT split, id, string_agg(version, ',' ORDER BY pos, version) AS versions, count(*) AS n FROM f GROUP BY split, id HAVING count(*) > 1"""
)
def multi_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    number, version = audit.versioned(F.col("entry"))
    return audit.several_versions(_entries(spark, sf_dir).select("split", "pos", number.alias("id"), version.alias("version")))


@query(f"SELECT pos, rtrim(entry, '/') AS entry FROM ({_ENTRIES}) WHERE NOT regexp_matches(entry, '^[0-9]+[vV][0-9]+')")
def unrecognised_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = _entries(spark, sf_dir).select("pos", F.regexp_replace("entry", "/+$", "").alias("entry"))
    return audit.unrecognised(top)


@query("SELECT count(*) AS n, count(DISTINCT ppr_id) AS ids, count(DISTINCT doi) AS dois FROM metadata_lines")
def global_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "metadata_lines").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("ppr_id").alias("ids"), F.count_distinct("doi").alias("dois"))


@query("SELECT section, count(*) AS n FROM documents GROUP BY section")
def pruned_scan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").groupBy("section").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT ppr_id, array_to_string(keywords[1:5], '|') AS first, array_to_string(CASE WHEN len(keywords) < 5 THEN keywords ELSE keywords[-5:] END, '|') AS last FROM hf_dataset")
def first_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = audit.ends(F.col("keywords"))
    return read(spark, sf_dir, "hf_dataset").select("ppr_id", F.array_join(first, "|").alias("first"), F.array_join(last, "|").alias("last"))


@query("SELECT r_regionkey AS key, r_name AS name, NULL::INTEGER AS parent FROM region UNION ALL SELECT n_nationkey, n_name, n_regionkey FROM nation")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessellar.sources.files import union_all

    region = read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))
    return union_all([region, read(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("parent"), F.col("n_name").alias("name"), F.col("n_nationkey").alias("key"))]).select("key", "name", "parent")


@query("SELECT id FROM (SELECT ppr_id AS id FROM hf_dataset UNION SELECT ppr_id FROM metadata_lines UNION SELECT ppr_id FROM split_assignments)")
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = [read(spark, sf_dir, t).select(F.col("ppr_id").alias("id")) for t in ("hf_dataset", "metadata_lines", "split_assignments")]
    return ids[0].union(ids[1]).union(ids[2]).distinct()


@query("SELECT ppr_id FROM hf_dataset INTERSECT SELECT ppr_id FROM metadata_lines")
def intersect_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "hf_dataset").select("ppr_id").intersect(read(spark, sf_dir, "metadata_lines").select("ppr_id"))


# ---- problem 7


@query()
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent-child links of every well-formed XML, out of the flat tables."""
    return nested.article_links(read(spark, sf_dir, "hf_dataset"), "ppr_id", "xml")


@query()
def p7_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of all flat tables of every well-formed XML."""
    df = read(spark, sf_dir, "hf_dataset")
    rows = nested.shred(df, "ppr_id", "xml", nested.derived_inlining(df, "xml"))
    return rows.withColumns({"fields": F.to_json("fields"), "to": F.to_json("to")})


@query("SELECT ppr_id, UNNEST(range(1, len(authors) + 1))::INTEGER AS no, UNNEST(list_transform(authors, lambda a: a.name)) AS name, UNNEST(list_transform(authors, lambda a: a.orcid)) AS orcid FROM hf_dataset")
def p7_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.flatten(read(spark, sf_dir, "hf_dataset"), "ppr_id", "authors")["authors"]


@query(
    """SELECT ppr_id, no_1, UNNEST(range(1, len(a) + 1))::INTEGER AS no, UNNEST(a) AS value FROM (
SELECT ppr_id, UNNEST(range(1, len(authors) + 1))::INTEGER AS no_1, UNNEST(list_transform(authors, lambda a: a.affiliations)) AS a FROM hf_dataset)"""
)
def p7_affiliations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.flatten(read(spark, sf_dir, "hf_dataset"), "ppr_id", "authors")["authors.affiliations"]


def entry(spark: SparkSession) -> DataFrame:
    """Rows of each stratum in each split."""
    return stratum_split_counts(spark, "/root/testdata/sf0.001")
