"""The queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to a WARC archive and read back."""
    from .storage import new_folder
    from .warc import read_warc, write_warc

    folder = new_folder(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), folder)
    return read_warc(spark, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
w AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first < page_id THEN first END AS refers_to
FROM w
"""


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    from .token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE), limit=512)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality; labels of held-out documents are never learnt."""
    from .quality import fit_quality, score_quality

    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against the benchmark's windows."""
    from .decontamination import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans", "items")


#: Words of a text in DuckDB: ASCII letters in lower case, digits, and everything beyond ASCII.
WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP4 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
b AS (SELECT item_id, {WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
sizes AS (SELECT DISTINCT least(10, len(w)) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS g
  FROM b, range(1, greatest(len(w) - 10, 0) + 2) AS r(i) WHERE len(w) > 0),
dw AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM d, sizes, range(1, greatest(len(w) - n + 1, 0) + 1) AS r(i)),
h AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN bw USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM h, range(0, n) AS r(k) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
  FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses that documents name."""
    from .license_scan import scan

    return scan(table(spark, sf_dir, "documents"))


def op6_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 4096 ids."""
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer(WORD_BPE), capacity=4096, end_id=2)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in documents."""
    from .pii import digest_columns, find, fit_pii

    docs = table(spark, sf_dir, "documents")
    return digest_columns(find(docs, fit_pii(docs)))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by 5-word shingles at a Jaccard similarity of 0.75 or more."""
    from .jaccard_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), width=5, num=75, den=100)


OP8 = r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM t, range(1, greatest(len(w) - 5, 0) + 2) AS r(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * inter >= 75 * (x.n + y.n - inter)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT t.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM t LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)
"""


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best of every hundredth vector among all others."""
    from .exact_top_k import top_k

    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)


OP9 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


def op10_token_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' ids written to the archive and read back."""
    from .storage import new_folder
    from .token_archive import token_digests, write_token_archive

    folder = new_folder(spark, "tokens")
    write_token_archive(table(spark, sf_dir, "documents"), folder, tokenizer(WORD_BPE), end_id=1)
    return token_digests(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": op1_warc,
        "op2_token_counts": op2_token_counts,
        "op3_quality": op3_quality,
        "op4_decontamination": op4_decontamination,
        "op5_license_scan": op5_license_scan,
        "op6_harmonic_packing": op6_harmonic_packing,
        "op7_pii": op7_pii,
        "op8_jaccard_join": op8_jaccard_join,
        "op9_exact_top_k": op9_exact_top_k,
        "op10_token_archive": op10_token_archive,
    }


def oracle_sql() -> dict[str, str]:
    from .license_scan import oracle

    return {"op5_license_scan": oracle(WORDS), "op1_warc": OP1, "op4_decontamination": OP4, "op8_jaccard_join": OP8, "op9_exact_top_k": OP9}
