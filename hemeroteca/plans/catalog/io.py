"""Round trips through the readers and writers."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemeroteca.functions import fixed_values as fv
from hemeroteca.operators import cleaning, dedupe, quality
from hemeroteca.plans import inputs
from hemeroteca.plans.catalog.registry import ORDER_URLS_SQL, SUSPECTS_SQL, articles_sql, query
from hemeroteca.session import scratch_path
from hemeroteca.sources import readers, writers

_DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)


def _docs(spark, sf):
    return inputs.documents(spark, sf).select(*_DOCS.names)


@query("SELECT doc_id, text, lang, source FROM documents")
def json_round_trip(spark, sf):
    path = scratch_path(spark, "json")
    writers.write_records(_docs(spark, sf), path)
    return readers.read_records(spark, path, _DOCS)


#: Records of one array file.
_PER_FILE = 500


def _write_arrays(spark, sf, path, array, changed=lambda r: r):
    """JSON array files of so many records each, none of them growing with the data, all in one folder.

    ``array`` is the file's text, as an expression over ``body``, the joined records, and ``block``.
    """
    records = _docs(spark, sf).select("doc_id", F.to_json(F.struct(*_DOCS.names)).alias("r"))
    blocks = records.select("doc_id", changed(F.col("r")).alias("r")).groupBy(F.expr(f"doc_id div {_PER_FILE}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "r"))).alias("rs")
    )
    body = F.array_join(F.transform("rs", lambda x: x["r"]), ",")
    texts = blocks.select(body.alias("body"), "block").select(F.expr(array).alias("value"))
    texts.write.option("lineSep", "\n").option("maxRecordsPerFile", 1).text(path)


@query(f"SELECT doc_id, text, lang, source, doc_id % {_PER_FILE} AS idx_in_file FROM documents")
def json_array_scan(spark, sf):
    """JSON array files, read back with each record's place in its file."""
    path = scratch_path(spark, "json-arrays")
    _write_arrays(spark, sf, path, "concat('[', body, ']')")
    back = readers.read_json_array(spark, path, _DOCS)
    return back.select(*_DOCS.names, F.col("idx").alias("idx_in_file"))


@query("SELECT doc_id, text, lang, source, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents")
def json_one_array(spark, sf):
    """All records in a single array file, written as one and read back in splits, each record with its place."""
    path = scratch_path(spark, "json-one")
    writers.write_json_array(_docs(spark, sf), path, "doc_id")
    return readers.read_json_array(spark, path, _DOCS).drop("file")


@query(
    f"""SELECT 'record' AS kind, doc_id, doc_id % {_PER_FILE} AS idx FROM documents WHERE doc_id // {_PER_FILE} % 2 = 1 AND doc_id % 7 <> 5
    UNION ALL SELECT 'wrong type', doc_id, doc_id % {_PER_FILE} FROM documents WHERE doc_id // {_PER_FILE} % 2 = 1 AND doc_id % 7 = 5
    UNION ALL SELECT 'broken file', NULL, NULL FROM (SELECT DISTINCT doc_id // {_PER_FILE} AS block FROM documents) WHERE block % 2 = 0"""
)
def json_arrays_some_broken(spark, sf):
    """Every other array file is cut short: its records don't count, and the file is told.

    In the others, the records of which the id is text are told with their place.
    """
    path = scratch_path(spark, "json-broken")
    odd = F.regexp_replace("r", '^\\{"doc_id":([0-9]+)', '{"doc_id":"no. $1"')
    array = "if(block % 2 = 0, concat('[', left(body, length(body) - 3)), concat('[', body, ']'))"
    _write_arrays(spark, sf, path, array, lambda r: F.when(F.col("doc_id") % 7 == 5, odd).otherwise(r))
    rows, rejects = readers.split_json_arrays(spark, path, _DOCS)
    number = F.nullif(F.regexp_extract("text", '^\\{"doc_id":"no. ([0-9]+)"', 1), F.lit("")).cast("long")
    told = rejects.select(F.when(F.col("idx").isNull(), "broken file").otherwise("wrong type").alias("kind"), number.alias("doc_id"), "idx")
    return rows.select(F.lit("record").alias("kind"), "doc_id", "idx").unionByName(told)


@query(
    """SELECT 'record' AS kind, doc_id, CAST(NULL AS VARCHAR) AS line FROM documents WHERE doc_id % 10 <> 3
    UNION ALL SELECT 'broken line', NULL, '{"doc_id": ' || doc_id || ', ' FROM documents WHERE doc_id % 10 = 3"""
)
def json_lines_some_broken(spark, sf):
    """Every tenth line is cut short, and comes back as it is."""
    path = scratch_path(spark, "lines-broken")
    record = F.to_json(F.struct(*_DOCS.names))
    cut = F.concat(F.lit('{"doc_id": '), F.col("doc_id").cast("string"), F.lit(", "))
    _docs(spark, sf).select(F.when(F.col("doc_id") % 10 == 3, cut).otherwise(record).alias("value")).write.text(path)
    rows, rejects = readers.split_records(spark, path, _DOCS)
    return rows.select(F.lit("record").alias("kind"), "doc_id", F.lit(None).cast("string").alias("line")).unionByName(
        rejects.select(F.lit("broken line").alias("kind"), F.lit(None).cast("long").alias("doc_id"), "line")
    )


@query("SELECT 104 AS checkpoint_page, doc_id AS idx, lang FROM documents")
def checkpoint_read(spark, sf):
    """Good progress checkpoints; an absent and an unreadable one add nothing."""
    good, bad = scratch_path(spark, "checkpoint"), scratch_path(spark, "checkpoint-bad")
    schema = T.StructType.fromDDL("page int, articles array<struct<idx:long,lang:string>>")
    # A checkpoint holds what one crawl has so far; here one for each block of rows.
    blocks = _docs(spark, sf).groupBy(F.expr(f"doc_id div {_PER_FILE}").alias("block")).agg(
        F.collect_list(F.struct(F.col("doc_id").alias("idx"), "lang")).alias("articles")
    )
    blocks.select(F.lit(104).alias("page"), "articles").write.option("maxRecordsPerFile", 1).json(good)
    spark.range(1).select(F.lit('{"page": 3, "articles": [{"idx": 1')).write.text(bad)
    return dedupe.append_rows(*[readers.read_checkpoint(spark, p, schema) for p in (good, f"{good}-absent", bad)])


@query(
    f"""SELECT 'some' AS kind, idx AS index, left(title, 80) AS title, url, array_to_string(s[1:5], '|') AS merged_words, 1 AS written
    FROM (SELECT *, {SUSPECTS_SQL} AS s FROM {articles_sql()}) WHERE len(s) > 0
    UNION ALL SELECT 'none', NULL, NULL, NULL, NULL, 0"""
)
def glued_report_if_any(spark, sf):
    """The whole glued-word report, written and read again; the articles that aren't in it give no file."""
    articles = inputs.articles(spark, sf)
    report = quality.glued_report(articles)
    clean = articles.join(report.select(F.col("index").alias("idx")), "idx", "left_anti")
    out = []
    for kind, issues in (("some", report), ("none", quality.glued_report(clean))):
        path = scratch_path(spark, "glued")
        written = writers.write_report(issues, path)
        if there := readers.exists(spark, path):
            rows = readers.read_records(spark, path, issues.schema)
        else:
            rows = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in issues.schema])
        if written != there:
            raise AssertionError(f"{kind}: written {written}, file {there}")
        words = F.array_join("merged_words", "|").alias("merged_words")
        out.append(rows.select(F.lit(kind).alias("kind"), "index", "title", "url", words, F.lit(int(written)).alias("written")))
    return dedupe.append_rows(*out)


_LISTED = """'["' || lang || '", "it''s", "' || source || '"]'"""


@query(
    f"""SELECT 'articles.csv' AS file, doc_id AS idx, lang AS first, source AS second FROM documents UNION ALL
    SELECT 'issues.csv', doc_id, {_LISTED}, NULL FROM documents WHERE doc_id % 2 = 0"""
)
def json_folder_to_csv_lists(spark, sf):
    """A folder with records, a report whose rows hold lists, an empty array, a broken file and a checkpoint.

    The list's text is compared with its single quotes, but for those inside a word, made double.
    """
    folder = scratch_path(spark, "folder")
    rows = _docs(spark, sf).select(F.col("doc_id").alias("idx"), "lang", "source")
    writers.write_records(rows, f"{folder}/articles.json")
    listed = F.array("lang", F.lit("it's"), "source").alias("words")
    writers.write_records(rows.where("idx % 2 = 0").select("idx", listed), f"{folder}/issues.json")
    for name, text in (("empty", ""), ("broken", '{"idx": 1, '), ("checkpoint_1", '{"idx": 1}')):
        spark.range(1).select(F.lit(text)).write.text(f"{folder}/{name}.json")
    outcome = writers.json_folder_to_csv(spark, folder, multi_line=False)
    if sorted(outcome) != ["articles.json", "broken.json", "empty.json", "issues.json"]:
        raise AssertionError(f"unexpected files: {sorted(outcome)}")
    if outcome["empty.json"] is not None or not isinstance(outcome["broken.json"], Exception):
        raise AssertionError(f"unexpected outcomes: {outcome}")
    first = readers.read_csv(spark, f"{folder}/articles.csv", T.StructType.fromDDL("idx long, lang string, source string"))
    second = readers.read_csv(spark, f"{folder}/issues.csv", T.StructType.fromDDL("idx long, words string"))
    doubled = F.regexp_replace("words", r"(?<![a-z])'|'(?![a-z])", '"')
    return first.select(F.lit("articles.csv").alias("file"), "idx", F.col("lang").alias("first"), F.col("source").alias("second")).unionByName(
        second.select(F.lit("issues.csv").alias("file"), "idx", doubled.alias("first"), F.lit(None).cast("string").alias("second"))
    )


@query("SELECT doc_id, text, lang, source FROM documents")
def json_folder_scan(spark, sf):
    """A folder that holds the records and a checkpoint of them, which does not count."""
    path = scratch_path(spark, "json-folder")
    rows = _docs(spark, sf)
    for name in ("articles.json", "checkpoint_articles.json"):
        writers.write_records(rows, f"{path}/{name}")
    return readers.read_json_folder(spark, path, _DOCS, multi_line=False)


@query("SELECT doc_id, nullif(text, '') AS text, lang, source FROM documents")
def csv_round_trip(spark, sf):
    path = scratch_path(spark, "csv")
    writers.write_csv(_docs(spark, sf), path)
    return readers.read_csv(spark, path, _DOCS)


@query("SELECT doc_id, nullif(text, '') AS text, CASE WHEN doc_id % 3 = 0 THEN lang END AS lang, source FROM documents")
def json_to_csv_key_union(spark, sf):
    """Ragged JSON records to CSV: the header is the sorted union of keys."""
    json_path, csv_path = scratch_path(spark, "ragged"), scratch_path(spark, "union")
    ragged = _docs(spark, sf).withColumn("lang", F.when(F.col("doc_id") % 3 == 0, F.col("lang")))
    ragged.write.json(json_path)  # a NULL field leaves no key behind
    writers.json_to_csv(spark, json_path, csv_path, multi_line=False)
    header = T.StructType(sorted(_DOCS.fields, key=lambda f: f.name))
    return readers.read_csv(spark, csv_path, header)


@query("SELECT CAST(doc_id // 200 + 1 AS INT) AS snapshot, count(*) AS n, min(doc_id) AS first_idx FROM documents GROUP BY 1")
def snapshot_folders(spark, sf):
    path = scratch_path(spark, "snapshots")
    rows = _docs(spark, sf).withColumnRenamed("doc_id", "idx")
    writers.write_snapshots(rows, path, fv.BODIES_PER_SNAPSHOT)
    schema = T.StructType(
        [T.StructField("idx", T.LongType()), *_DOCS.fields[1:], T.StructField("snapshot", T.IntegerType())]
    )
    back = readers.read_csv(spark, path, schema)
    return back.groupBy("snapshot").agg(F.count("*").alias("n"), F.min("idx").alias("first_idx"))


@query("SELECT CAST(doc_id // 200 + 1 AS INT) AS snapshot, CAST(doc_id // 200 // 50 AS INT) AS folder, doc_id AS idx, lang FROM documents")
def snapshot_folders_together(spark, sf):
    """Fifty snapshots a folder, each row with its snapshot's number."""
    path = scratch_path(spark, "snapshots")
    rows = inputs.table(spark, sf, "documents").select(F.col("doc_id").alias("idx"), "lang")
    writers.write_snapshots(rows, path, fv.BODIES_PER_SNAPSHOT, together=50)
    kinds = {"idx": T.LongType(), "lang": T.StringType(), "snapshot": T.IntegerType(), "snapshots": T.IntegerType()}
    back = readers.read_csv(spark, path, T.StructType([T.StructField(c, k) for c, k in kinds.items()]))
    return back.withColumnRenamed("snapshots", "folder")


@query(
    """SELECT 'pages' AS kind, CAST(page // 5 + 1 AS INT) AS checkpoint, count(*) AS n, max(page) AS last
    FROM (SELECT doc_id % 105 AS page FROM documents) GROUP BY 2
    UNION ALL SELECT 'bodies', CAST(doc_id // 10 + 1 AS INT), count(*), max(doc_id) FROM documents GROUP BY 2"""
)
def checkpoint_buckets(spark, sf):
    """What each progress checkpoint adds: one for five listing pages, one for ten bodies."""
    rows = inputs.listing(spark, sf).select((F.col("page") - 1).cast("long").alias("page"), "idx")
    out = []
    for kind, order, every in (("pages", "page", fv.PAGES_PER_CHECKPOINT), ("bodies", "idx", fv.BODIES_PER_CHECKPOINT)):
        numbered = rows.withColumn("checkpoint", writers.snapshot_no(order, every)).groupBy("checkpoint")
        counted = numbered.agg(F.count("*").alias("n"), F.max(order).alias("last"))
        out.append(counted.select(F.lit(kind).alias("kind"), "checkpoint", "n", "last"))
    return dedupe.append_rows(*out)


@query(f"SELECT idx, url FROM {ORDER_URLS_SQL}")
def resume_from_output(spark, sf):
    """Two runs into one append-only output: the second does what the first has left.

    A run may finish one URL twice, with the same time; one row of it comes back.
    """
    path = scratch_path(spark, "finished")
    work = inputs.order_urls(spark, sf).select("idx", "url", F.col("listed_at").alias("scraped_at"))
    work = work.union(work.where("idx % 5 = 0"))
    for part in (work.where("scraped_at < '1996-01-01'"), work):
        done = readers.read_finished(spark, path, work.schema)
        writers.append_finished(dedupe.resume_backlog(part, done), path)
    return readers.read_finished(spark, path, work.schema).select("idx", "url")


@query(
    f"""SELECT idx, url, CASE WHEN (date IS NULL OR trim(date) = '')
    AND regexp_matches(url, '/[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}}/')
    THEN replace(regexp_extract(url, '/([0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}})/', 1), '/', '-') ELSE date END AS date
    FROM {articles_sql()}"""
)
def date_fill_rewritten(spark, sf):
    """Filling dates "in place": a new version beside the stored one."""
    path = scratch_path(spark, "articles")
    inputs.articles(spark, sf).select("idx", "url", "date").write.parquet(path)
    stored = spark.read.parquet(path)
    writers.rewrite(spark, cleaning.fill_dates(stored).drop("date_filled"), path)
    return spark.read.parquet(writers.current_version(spark, path))
