"""Registered queries of the training-data operators: op<N>_<name> over the whole
given tables with production parameters, plus the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.bpe_codec import codec_digests
from strata.llm.common import table
from strata.llm.embedding_dedup import embedding_classes
from strata.llm.jaccard_join import jaccard_classes
from strata.llm.merkle_manifest import document_manifest
from strata.llm.mixing import mixing_copies
from strata.llm.packing import pack_sequences
from strata.llm.periodic_runs import run_digests
from strata.llm.quality import quality_scores
from strata.llm.token_counts import token_counts
from strata.llm.token_output import encode_to_files
from strata.llm.topk import top_k
from strata.llm.toxicity import toxicity_scores
from strata.llm.warc import archive_round_trip

TOKEN_LIMIT = 1024


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, bit-packed in files and read back."""
    return encode_to_files(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into windows of 2048 ids."""
    pieces = pack_sequences(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by compression."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors by cosine of at least 0.95."""
    classes = embedding_classes(table(spark, sf_dir, "embeddings"), 0.95)
    return classes.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive, normalised and read back."""
    return archive_round_trip(table(spark, sf_dir, "pages"), least_bytes=0).drop("block_bytes")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all vectors for each hundredth."""
    return top_k(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to the mix of sources."""
    mixed = mixing_copies(table(spark, sf_dir, "documents"), ["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes and link counts of all documents: five words, 0.8."""
    joined = jaccard_classes(table(spark, sf_dir, "documents"))
    return joined.select("doc_id", "class_id", "n_links", "representative", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by class-conditional language models."""
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and byte-level BPE tokens of every document."""
    counts = token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op11_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the distinct-word table and decoded again."""
    return codec_digests(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, and the text without repeats."""
    return run_digests(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents, with proofs checked on tampered texts."""
    return document_manifest(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_output, op2_packing, op3_quality, op4_embedding_dedup, op5_warc, op6_topk, op7_mixing, op8_jaccard_join, op9_toxicity,
        op10_token_counts, op11_bpe_codec, op12_periodic_runs, op13_merkle_manifest,
    )
}

# Base 32 of a digest, five bits of its 160 at a time.
_BITS = "concat(" + ", ".join(f"lpad(bin(('0x' || substr(sha1(coalesce(html, '')), {i}, 5))::BIGINT), 20, '0')" for i in range(1, 41, 5)) + ")"

# crc32 of a decimal id: a byte is folded in, then eight shifts (-1 in the list).
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT],
    flatten(list_transform(range(1, length(coalesce(doc_id::VARCHAR, '')) + 1), lambda i: list_concat([ord(substr(doc_id::VARCHAR, i, 1))::BIGINT], [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END), 4294967295::BIGINT)"""


def _leaf(text: str) -> str:
    values = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    return "sha256(concat(" + ", ".join(f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values) + "))"


def _levels(name: str, base: str) -> str:
    """Recursive CTE (t, level, idx, digest, n) of trees of eight from their leaves."""
    return f"""{name} AS (
  {base}
  UNION ALL
  SELECT t, level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (n + 7) // 8 FROM {name} WHERE n > 1 GROUP BY t, level, idx // 8, n
)"""


_MERKLE = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, lang, {_leaf("text")} AS leaf,
         CASE WHEN {_CRC32} % 3 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
  FROM documents
), p AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY lang) AS n
  FROM l
), {_levels("g", "SELECT t, 0 AS level, idx, leaf AS digest, n FROM p")},
r AS (SELECT t AS idx, level AS top, digest, count(*) OVER () AS n FROM g WHERE n = 1),
{_levels("h", "SELECT -1::BIGINT AS t, 0 AS level, idx, digest, n FROM r")},
s AS (
  SELECT *, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS low,
         coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS high
  FROM (SELECT * FROM g UNION ALL SELECT * FROM h) WINDOW w AS (PARTITION BY t, level, idx // 8 ORDER BY idx)
), c AS (
  SELECT doc_id, leaf, p.t AS tree, p.t, 0 AS level, p.idx, '' AS proof, coalesce(changed, leaf) AS folded, row_number() OVER () AS row_id FROM p
  UNION ALL
  SELECT doc_id, leaf, tree, CASE WHEN s.n = 1 THEN -1 ELSE c.t END, CASE WHEN s.n = 1 THEN 0 ELSE c.level + 1 END, CASE WHEN s.n = 1 THEN c.tree ELSE c.idx // 8 END,
         CASE WHEN s.n = 1 THEN proof ELSE proof || low || high END, CASE WHEN s.n = 1 THEN folded ELSE sha256(low || folded || high) END, row_id
  FROM c JOIN s ON s.t = c.t AND s.level = c.level AND s.idx = c.idx WHERE s.n > 1 OR c.t >= 0
), top AS (SELECT level, digest AS root FROM h WHERE n = 1)
SELECT doc_id, leaf, r.digest AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM c JOIN top ON c.t = -1 AND c.level = top.level JOIN r ON r.idx = c.tree"""

ORACLE_SQL: dict[str, str] = {
    "op13_merkle_manifest": _MERKLE,
    "op5_warc": f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, {_BITS} AS bits, coalesce(html, '') AS payload FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST('0b' || substr(bits, 5 * CAST(i AS INT) + 1, 5) AS INT) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f""",
    "op4_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id""",
    "op6_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * x::DOUBLE) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_sum(list_transform(list_zip(q.x, r.x), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v r ON q.vec_id % 100 = 0 AND q.vec_id <> r.vec_id AND len(q.x) = len(r.x)
), k AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 10""",
    "op8_jaccard_join": """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0b\\f\\r]+') AS ws FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS gram FROM w
), s AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
m AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT m.a, m.b FROM m JOIN s x ON x.doc_id = m.a JOIN s y ON y.doc_id = m.b WHERE 9 * m.common >= 4 * (x.n + y.n)),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS class_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a),
t AS (SELECT doc_id, md5(array_to_string(list_sort(list(gram)), chr(10))) AS key FROM g GROUP BY doc_id),
p AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY key) AS representative FROM t)
SELECT d.doc_id, c.class_id, coalesce(n.n_links, 0) AS n_links, coalesce(p.representative, d.doc_id) AS representative, d.doc_id = c.class_id AS kept
FROM documents d JOIN c ON c.a = d.doc_id LEFT JOIN n ON n.a = d.doc_id LEFT JOIN p ON p.doc_id = d.doc_id""",
}
