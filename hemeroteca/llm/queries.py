"""Queries that apply each operator to its whole table, and their check SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemeroteca import session
from hemeroteca.llm import (
    bpe, centroids, line_dedup, line_rules, merkle, mil, near, packing, pieces, pii, prefixes, sharding, urls,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session.apply(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    ids = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary, keep_text=False)
    return bpe.decode(ids, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack every document into sequences of 2048 tokens."""
    pieces = packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=2048
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("token_bytes").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


SHARDS = [f"shard-{n:03d}" for n in range(128)]


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place every document, with all shards and with the last one withdrawn."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    placed = sharding.place(docs, "doc_id", SHARDS)
    return sharding.place(placed, "doc_id", SHARDS[:-1], shard="shard_without_last")


def _shard_sql(shards: list[str]) -> str:
    digits = f"substr(md5(CAST(doc_id AS VARCHAR)), 1, {sharding.DIGITS})"
    owners = sharding.fill_slots(shards)
    return f"CAST(({owners})[1 + CAST(('0x' || {digits})::BIGINT % {sharding.SLOTS} AS INTEGER)] AS INTEGER)"


ORACLES["op2_sharding"] = (
    f"SELECT doc_id, {_shard_sql(SHARDS)} AS shard, {_shard_sql(SHARDS[:-1])} AS shard_without_last FROM documents"
)

RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


#: Names of sites that serve advertisements and spam.
UNWANTED_SITES = ("casino-win", "ads-track", "cheap-pills", "spam-farm", "free-bets", "adult-x")


@query
def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every page's url; the list holds the hosts of advertisers and spammers, with all their subdomains."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    hosts = pages.select(urls.host(F.col("url")).alias("key"))
    sites = F.array(*map(F.lit, UNWANTED_SITES))
    return urls.judge(pages, RULES, hosts.where(F.arrays_overlap(F.split("key", "[.]"), sites)).distinct()).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def _rule_sql(rule: str) -> str:
    host, _, path = rule.partition("/")
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}'))"


_LONGEST_FIRST = sorted(RULES, key=lambda r: -len(r[1]))
ORACLES["op9_urls"] = f"""
    WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{urls.UPPER}', '{urls.LOWER}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    ruled AS (SELECT *, CASE {' '.join(f"WHEN {_rule_sql(r)} THEN '{r}'" for _, r in _LONGEST_FIRST)} END AS rule,
        CASE {' '.join(f"WHEN {_rule_sql(r)} THEN '{v}'" for v, r in _LONGEST_FIRST)} END AS decided FROM parts)
    SELECT page_id, host, path, rule, coalesce(decided, CASE WHEN
        list_has_any(string_split(host, '.'), ['casino-win', 'ads-track', 'cheap-pills', 'spam-farm', 'free-bets', 'adult-x'])
        THEN 'block' ELSE 'allow' END) AS verdict FROM ruled"""


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every document's lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = line_rules.fit(docs, table(spark, sf_dir, "labels"))
    return line_rules.judge(docs, field).drop("text", "content_lines")


#: A secret of the deployment; this one is for the test data.
PSEUDONYM_KEY = b"pseudonyms of the test tables"


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with pseudonyms for personal data."""
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without repeated passages of several lines, by chunks that end at every line."""
    return line_dedup.drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op6_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as ``op6_line_dedup``, which was of fewer chunks once; kept under its name."""
    return op6_line_dedup(spark, sf_dir)


@query
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint every document, and an edited copy of it."""
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = merkle.compare_with_edit(table(spark, sf_dir, "documents"), parts)
    return made.withColumn("edited_sha256", F.sha2("edited_text", 256)).drop("edited_text")


@query
def op8_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document; a fifth of the documents, by a checksum of the id, is held out of learning."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    model = mil.fit(docs.where(~held_out), table(spark, sf_dir, "labels").where(~held_out))
    return mil.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "top_passage"
    )


@query
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near.classes(table(spark, sf_dir, "documents"))


@query
def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document with the piece vocabulary."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    ids = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model, keep_text=False, packed=True)
    return pieces.decode(ids, model).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster all embeddings around 16 centroids."""
    found = centroids.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3, size=64, scale=64)
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.withColumn("centroid_sha256", digest).drop("centroid")


def _centroid_sql(rounds: int) -> str:
    near = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (SELECT r, id, v, arg_min(struct_pack(k := k, d := {near}), struct_pack(d := {near}, k := k)) AS b
            FROM kept, c{n} GROUP BY r, id, v)""")
        steps.append(f"""m{n} AS (SELECT k, list(s ORDER BY i) AS c FROM (SELECT b.k AS k, i, floor_sum(sum(v[i])::HUGEINT, count(*)) AS s
            FROM a{n}, range(1, 65) AS t(i) GROUP BY b.k, i) GROUP BY k)""")
        steps.append(f"c{n + 1} AS MATERIALIZED (SELECT c{n}.k, coalesce(m{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN m{n} USING (k))")
    # Division of whole numbers cuts towards zero here, so what is below zero is mended.
    text = ", ".join(steps[:-2]).replace("floor_sum(sum(v[i])::HUGEINT, count(*))", "(sum(v[i])::BIGINT - ((sum(v[i])::BIGINT % count(*)) + count(*)) % count(*)) // count(*)")
    return f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id AS id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
        c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || id), v) - 1 AS k, v AS c FROM kept QUALIFY k < 16), {text}
        SELECT id AS vec_id, b.k::INTEGER AS cluster, b.d AS distance, (sum(b.d) OVER (PARTITION BY b.k))::BIGINT AS cluster_inertia,
        (sum(b.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} ON c{rounds}.k = b.k"""


ORACLES["op12_centroids"] = _centroid_sql(3)


@query
def op13_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    return prefixes.trie(table(spark, sf_dir, "conversations"), family=5, most=8)


_CRC_BYTE = "list_reduce(range(8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, {0})"
_CRC_SQL = f"""xor(4294967295, list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT),
    lambda s, x: {_CRC_BYTE.format("xor(s, x)")}, 4294967295::BIGINT))"""
ORACLES["op13_prefixes"] = f"""
    WITH own AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS n,
        sha256(coalesce(role, '') || chr(31) || coalesce(text, '')) AS code, octet_length(encode(coalesce(text, ''))) AS bytes
        FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (SELECT c, {_CRC_SQL} % 9 AS h FROM (SELECT DISTINCT c FROM own)),
    turns AS (SELECT convs.c, n, code, bytes FROM convs JOIN own ON own.c = convs.c - convs.c % 5 AND own.n < h
        UNION ALL SELECT c, n, code, bytes FROM own JOIN convs USING (c) WHERE n >= h),
    paths AS MATERIALIZED (SELECT c, row_number() OVER w AS d, bytes, string_agg(code, '/') OVER (w ROWS UNBOUNDED PRECEDING) || '/' AS path
        FROM turns WINDOW w AS (PARTITION BY c ORDER BY n) UNION ALL SELECT c, 0, 0, '/' FROM convs),
    lengths AS (SELECT c, max(d) AS last FROM paths GROUP BY c),
    nodes AS MATERIALIZED (SELECT CASE WHEN d = 0 THEN '' ELSE path END AS path, d, min(c) AS conv, count(*) AS n, any_value(bytes) AS bytes,
        coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = last), '') AS ends FROM paths JOIN lengths USING (c) GROUP BY ALL),
    up AS (SELECT child.path, parent.path AS above, parent.conv FROM nodes child JOIN nodes parent
        ON child.d = parent.d + 1 AND starts_with(child.path, parent.path)),
    below AS (SELECT top.path, count(*) FILTER (WHERE sub.path NOT IN (SELECT above FROM up)) AS n_leaves,
        sum((sub.n - 1) * sub.bytes)::BIGINT AS saved FROM nodes top JOIN nodes sub ON starts_with(sub.path, top.path) GROUP BY top.path)
    SELECT nodes.conv AS conv_id, d AS depth, up.conv AS parent_conv_id, n AS n_convs,
        (SELECT count(*) FROM up u WHERE u.above = nodes.path) AS n_children, n_leaves, saved AS saved_tokens, sha256(ends) AS ends_sha256
    FROM nodes JOIN below USING (path) LEFT JOIN up USING (path)"""


#: All pairs that share a shingle, by the shingles themselves.
ORACLES["op10_near_dedup"] = """
    WITH RECURSIVE worded AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws FROM documents),
    listed AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS s FROM worded),
    sized AS MATERIALIZED (SELECT doc_id, len(s) AS n FROM listed),
    tokens AS MATERIALIZED (SELECT doc_id, unnest(s) AS token FROM listed),
    links AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id
        JOIN sized x ON x.doc_id = a.doc_id JOIN sized y ON y.doc_id = b.doc_id GROUP BY a.doc_id, b.doc_id, x.n, y.n
        HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
    reach AS (SELECT doc_id AS node, doc_id AS seen FROM sized UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.seen)
    SELECT doc_id, n::BIGINT AS n_shingles, min(seen) AS component_id, doc_id = min(seen) AS kept FROM sized JOIN reach ON node = doc_id GROUP BY doc_id, n"""

#: Every pair of neighbouring lines that stands earlier goes; the first one's last line is left to it.
ORACLES["op6_line_dedup"] = ORACLES["op6_passage_dedup"] = r"""
    WITH src AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
    numbered AS (SELECT doc_id, l, unnest(range(len(l))) AS n FROM src),
    worded AS (SELECT doc_id, l, n, lead(n) OVER (PARTITION BY doc_id ORDER BY n) AS m FROM numbered WHERE regexp_matches(l[n + 1], '\S')),
    pairs AS MATERIALIZED (SELECT doc_id, n, m, array_to_string(l[n + 1:m + 1], chr(10)) AS chunk FROM worded WHERE m IS NOT NULL),
    firsts AS (SELECT chunk, min(struct_pack(d := doc_id, n := n, m := m)) AS f FROM pairs GROUP BY chunk HAVING count(*) > 1),
    gone AS (SELECT doc_id, unnest(range(n + (doc_id = f.d AND n = f.m)::INT, m + 1)) AS k FROM pairs JOIN firsts USING (chunk)
        WHERE NOT (doc_id = f.d AND n = f.n)),
    dropped AS (SELECT doc_id, list_sort(list_distinct(list(k))) AS ks FROM gone GROUP BY doc_id)
    SELECT doc_id, CASE WHEN ks IS NULL THEN text ELSE array_to_string(
        list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(ks, i - 1)), chr(10)) END AS text,
        coalesce(list_transform(ks, lambda k: k::INT), []) AS removed_lines FROM documents LEFT JOIN dropped USING (doc_id)"""
