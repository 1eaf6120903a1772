"""The registered queries of the subpackage, each with its SQL where SQL can give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm import (
    divergence,
    licences,
    lines,
    manifest,
    mixing,
    neardup,
    neighbours,
    quality,
    substrings,
    suffixes,
    templates,
    tokens,
    toxicity,
)
from weirflow.llm.logistic import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("k", "th", "positions")


SQL["op1_mix_sources"] = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5(doc_id::VARCHAR) AS h
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
ranked AS (
  SELECT *, [5.0, 2.0, 1.0][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT]::DOUBLE AS weight,
    ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT AS turn
  FROM totals),
filled AS (
  SELECT *, coalesce(sum(source_size) OVER before, 0)::DOUBLE * 2 AS given, count(*) OVER before AS n,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open
  FROM ranked
  WINDOW before AS (ORDER BY source_size / weight, turn, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT arg_min((1.5 * (SELECT sum(size) FROM sizes)::DOUBLE - given) / open, n) FILTER (
    source_size * 2.0 > weight * (1.5 * (SELECT sum(size) FROM sizes)::DOUBLE - given) / open) AS level
  FROM filled),
targets AS (SELECT *, least(source_size * 2.0::DOUBLE, weight * (SELECT level FROM level)) AS target FROM ranked),
placed AS (
  SELECT s.*, source_size, target, turn,
    (sum(s.size) OVER (PARTITION BY s.source ORDER BY h, doc_id, s.size ROWS UNBOUNDED PRECEDING) - s.size)::DOUBLE AS start
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
counted AS (
  SELECT *, (CASE WHEN start + size / 2.0 < target THEN 1 ELSE 0 END
    + CASE WHEN start + source_size + size / 2.0 < target THEN 1 ELSE 0 END)::BIGINT AS copies,
    least(start / target, 1.0::DOUBLE) AS share,
    CASE turn WHEN 0 THEN 1.5::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS w0,
    CASE turn WHEN 0 THEN -2.0::DOUBLE WHEN 1 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE END AS slope
  FROM placed)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies,
  CASE WHEN copies > 0 THEN CASE WHEN share = 0 THEN 0.0 ELSE share * 2 / (sqrt(w0 * w0 + share * slope) + w0) END END AS position
FROM counted
"""


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(substrings.drop_repeated_substrings(table(spark, sf_dir, "documents")))


SQL["op5_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT doc_id, unnest(generate_series(1, len(words) - 12)) AS pos, words FROM w WHERE len(words) >= 13),
windows AS (SELECT doc_id, pos, md5(array_to_string(words[pos:pos + 12], ' ')) AS h FROM starts),
firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(pos, pos + 12)) AS pos
  FROM windows JOIN firsts USING (h) WHERE doc_id > first),
listed AS (SELECT doc_id, list(pos) AS gone, count(*) AS n FROM gone GROUP BY doc_id),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS pos FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text
  FROM placed ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(suffixes.drop_repeated_bytes(table(spark, sf_dir, "documents")))


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(lines.drop_repeated_lines(table(spark, sf_dir, "documents")))


SQL["op10_line_dedup"] = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
placed AS (SELECT doc_id, unnest(lines) AS line, unnest(generate_series(1, len(lines))) AS pos FROM split),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM placed),
common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT k.*, c.key IS NOT NULL AND k.doc_id < c.keeper AS gone FROM keyed k LEFT JOIN common c USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links")


SQL["op8_ngram_jaccard_join"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
grams AS (
  SELECT DISTINCT doc_id, md5(array_to_string(words[pos:pos + 4], ' ')) AS gram
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS pos FROM w WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE common.n::DOUBLE >= 0.8::DOUBLE * (x.n + y.n - common.n)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
heads AS (SELECT a AS doc_id, min(b) AS head FROM reach GROUP BY a),
counts AS (SELECT a AS doc_id, count(*) AS n FROM links GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(head, doc_id)) AS class_id, coalesce(n, 0)::BIGINT AS n_links
FROM documents LEFT JOIN heads USING (doc_id) LEFT JOIN counts USING (doc_id)
"""


@query
def op7_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = templates.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("k", "th")


@query
def op6_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, fold(F.col("doc_id"), 5) != 0)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(fold(F.col("row.doc_id"), 5) == 0, F.lit(False))
    return scored.select("row.doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op4_random_indexing_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, fold(F.col("doc_id"), 4) != 2)
    scored = quality.score(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(fold(F.col("row.doc_id"), 4) == 2, F.lit(False))
    return scored.select("row.doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op3_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


@query
def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licences.scan(docs, licences.fit(docs)).drop("notice")


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    seen = manifest.leaf([F.col(c) + tampered.cast("long") if c == "n_chars" else F.col(c) for c in manifest.FIELDS])
    rows = manifest.manifest(docs, carried={"seen": seen})
    return manifest.verify(rows.withColumn("proof_sha256", manifest.proof(F.col("path"))), "seen").drop("path", "seen")


SQL["op11_merkle_manifest"] = r"""
WITH RECURSIVE bits AS (
  SELECT doc_id, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
fields AS (
  SELECT d.doc_id, coalesce('=' || lang, '') AS g,
    coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS a,
    n_chars, n_chars + coalesce((xor(crc, 4294967295) % 7 = 0)::BIGINT, 0) AS seen_chars,
    coalesce(strlen(text) || ':' || text, '-') AS z
  FROM documents d LEFT JOIN bits USING (doc_id)),
leaves AS (
  SELECT doc_id, g, sha256(a || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || z) AS leaf,
    sha256(a || coalesce(strlen(seen_chars::VARCHAR) || ':' || seen_chars, '-') || z) AS seen
  FROM fields),
climb AS (
  SELECT doc_id, leaf, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY g) AS n, leaf AS node, seen AS fold, '' AS proof
  FROM leaves
  UNION ALL
  SELECT c.doc_id, c.leaf, c.g, c.idx // 2, (c.n + 1) // 2,
    sha256(CASE WHEN c.idx % 2 = 0 THEN c.node || coalesce(s.node, '') ELSE s.node || c.node END),
    sha256(CASE WHEN c.idx % 2 = 0 THEN c.fold || coalesce(s.node, '') ELSE s.node || c.fold END),
    c.proof || coalesce(s.node, '')
  FROM climb c LEFT JOIN (SELECT DISTINCT g, idx, node FROM climb) s ON s.g = c.g AND s.idx = xor(c.idx, 1)
  WHERE c.n > 1),
groups AS (
  SELECT g, any_value(node) AS node, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n
  FROM climb WHERE n = 1 GROUP BY g),
rise AS (
  SELECT c.doc_id, c.leaf, c.node AS subroot, t.idx, t.n, c.node, c.fold, c.proof
  FROM climb c JOIN groups t USING (g) WHERE c.n = 1
  UNION ALL
  SELECT r.doc_id, r.leaf, r.subroot, r.idx // 2, (r.n + 1) // 2,
    sha256(CASE WHEN r.idx % 2 = 0 THEN r.node || coalesce(s.node, '') ELSE s.node || r.node END),
    sha256(CASE WHEN r.idx % 2 = 0 THEN r.fold || coalesce(s.node, '') ELSE s.node || r.fold END),
    r.proof || coalesce(s.node, '')
  FROM rise r LEFT JOIN (SELECT DISTINCT idx, node FROM rise) s ON s.idx = xor(r.idx, 1)
  WHERE r.n > 1)
SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = node AS verified
FROM rise WHERE n = 1
"""


@query
def op12_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


SQL["op13_source_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
used AS (
  SELECT id, lang, source, translate(unnest(words), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM used GROUP BY ALL),
kept AS (SELECT lang, term FROM used GROUP BY ALL HAVING count(DISTINCT id) >= 3),
groups AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, v::HUGEINT AS v
  FROM groups g JOIN kept k USING (lang) JOIN sizes USING (lang) LEFT JOIN counts c USING (lang, source, term)),
rates AS (
  SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER (PARTITION BY lang, source) + v)::HUGEINT AS p FROM dense),
whole AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(n)::HUGEINT + 1) // (sum(sum(n)) OVER (PARTITION BY lang) + any_value(v))::HUGEINT AS q
  FROM dense GROUP BY lang, term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM rates a JOIN rates b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
scored AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b USING (lang) LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  WHERE a.source <> b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM rates JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM scored QUALIFY part = 'pair' OR rank <= 200
"""
