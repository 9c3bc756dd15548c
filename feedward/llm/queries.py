"""One query for each operator over its whole test table, and SQL where it can express it."""

import zlib
from collections.abc import Iterator
from uuid import uuid4

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ensure_checkpoint_dir, read_table, text_portions
from .decontaminate import find_contamination
from .licenses import scan_licenses
from .lines import dedup_lines
from .mixing import mix_sources
from .neighbours import nearest_neighbours
from .periodic import periodic_runs
from .pii import find_pii
from .secret_scan import scan_secrets
from .simhash import near_duplicates
from .token_files import read_tokens, write_tokens
from .toxicity import score_toxicity, train_toxicity
from .urlfilter import judge_urls, rules_table
from .vector_codes import compress_vectors

# The rules are part of the contract.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents")).drop("found")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("hits", "items")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents")).drop("found")


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "mix_epoch", "mix_block", "mix_order")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"),
        F.col("deduped.deleted").cast("long").alias("n_deleted"),
        F.sha2(F.coalesce("deduped.text", F.lit("")), 256).alias("text_sha256"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score_toxicity(docs, train_toxicity(docs, read_table(spark, sf_dir, "labels"))).drop("found")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages"), rules_table(spark, URL_RULES))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(read_table(spark, sf_dir, "documents")).drop("found")


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From one word on, by a checksum of the id, the words repeat with a period."""
    for batch in batches:
        ids = batch["doc_id"].to_pylist()
        for start, texts in text_portions(batch["text"]):
            for i, text in enumerate(texts):
                words = text.encode("utf-8", "surrogatepass").split()
                if not words:
                    continue
                chosen = zlib.crc32(str(ids[start + i]).encode()) // 10
                first = chosen % len(words)
                period = 1 + (len(words) - first) // (3 + chosen % 8)
                unit = words[first : first + period]
                words[first:] = (unit * (len(words) // period + 1))[: len(words) - first]
                texts[i] = b" ".join(words).decode("utf-8", "surrogatepass")
            yield pa.RecordBatch.from_arrays([pa.array(ids[start : start + len(texts)], pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])


def _with_repeats(docs: DataFrame) -> DataFrame:
    """Repeats planted in a tenth of the documents, by their ids; the others are as they were."""
    docs = docs.select("doc_id", "text")
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    return docs.filter(~chosen).unionByName(docs.filter(chosen).mapInArrow(_repeats, "doc_id long, text string"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_with_repeats(read_table(spark, sf_dir, "documents")))
    ranked = F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    top = F.array_min(ranked)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") == 0, "").otherwise(F.concat(F.array_join(lines, "\n"), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        top["s"].alias("start"),
        (-top["l"]).alias("length"),
        top["p"].alias("period"),
        F.floor(-top["l"] * 1000 / top["p"]).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/tokens-{uuid4().hex}"
    write_tokens(read_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, folder).select(
        "doc_id",
        "start",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = compress_vectors(read_table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", "codebooks_sha256")


def _vector_codes_sql() -> str:
    """Two rounds of plain k-means in whole numbers; every part is measured against every entry."""
    steps = []
    for number in range(3):
        squared = "list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        steps.append(f"""
near_{number} AS MATERIALIZED (
    SELECT row_no, p, x, arg_min(entry, squared * 64 + entry) AS entry, min(squared) AS squared
    FROM (SELECT row_no, s.p, x, entry, CAST(coalesce({squared}, 0) AS BIGINT) AS squared
          FROM sliced s JOIN books_{number} c ON s.p = c.p)
    GROUP BY row_no, p, x)""")
        if number < 2:
            steps.append(f"""
means_{number} AS (
    SELECT p, entry, list(CAST((total - (total % n + n) % n) // n AS BIGINT) ORDER BY place) AS mean
    FROM (SELECT p, entry, place, sum(x[place]) AS total, count(*) AS n
          FROM near_{number}, unnest(range(1, len(x) + 1)) AS u(place) GROUP BY p, entry, place)
    GROUP BY p, entry),
books_{number + 1} AS MATERIALIZED (
    SELECT p, entry, coalesce(mean, y) AS y FROM books_{number} LEFT JOIN means_{number} USING (p, entry))""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS row_no, vec_id, label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
sliced AS MATERIALIZED (
    SELECT row_no, p, list_slice(v, p * (len(v) // 16) + 1, (p + 1) * (len(v) // 16)) AS x
    FROM kept, unnest(range(16)) AS u(p)),
books_0 AS MATERIALIZED (SELECT p, row_no AS entry, x AS y FROM sliced WHERE row_no < 64),{",".join(steps)},
coded AS (
    SELECT row_no, string_agg(printf('%02x', CAST(entry AS INT)), '' ORDER BY p) AS code, CAST(sum(squared) AS BIGINT) AS error
    FROM near_2 GROUP BY row_no),
digest AS (
    SELECT sha256(string_agg(CAST(number AS VARCHAR), ',' ORDER BY p, entry, place)) AS codebooks_sha256
    FROM (SELECT p, entry, place, y[place] AS number FROM books_2, unnest(range(1, len(y) + 1)) AS u(place)))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (row_no), digest
"""


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_decontamination": op2_decontamination,
    "op3_licenses": op3_licenses,
    "op4_neighbours": op4_neighbours,
    "op5_simhash": op5_simhash,
    "op6_mixing": op6_mixing,
    "op7_line_dedup": op7_line_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_url_filter": op9_url_filter,
    "op10_pii": op10_pii,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_files": op12_token_files,
    "op13_vector_codes": op13_vector_codes,
}

SQL = {
    # Windows of ten words (or the whole item) as lists, joined on equality.
    "op2_decontamination": r"""
WITH item_words AS (
    SELECT item_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
windows AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS size,
           array_to_string(list_slice(w, s, s + least(10, len(w)) - 1), ' ') AS key
    FROM item_words, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(s) WHERE len(w) > 0),
doc_words AS (
    SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT row_no, s, size, array_to_string(list_slice(w, s, s + size - 1), ' ') AS key
    FROM doc_words, sizes, unnest(range(1, len(w) - size + 2)) AS u(s)),
hits AS (SELECT row_no, s, p.size, item_id FROM places p JOIN windows v ON p.size = v.size AND p.key = v.key),
covered AS (
    SELECT row_no, count(DISTINCT word_no) AS n_hit
    FROM hits, unnest(range(s, s + size)) AS u(word_no) GROUP BY row_no),
items AS (
    SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT row_no, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY row_no)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered USING (row_no) LEFT JOIN items USING (row_no)
""",
    # Every rule that fits, the longest first.
    "op9_url_filter": """
WITH rules(rhost, rpath, verdict) AS (VALUES
    ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
tails AS (
    SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
                         THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail
    FROM pages),
split AS (
    SELECT page_id, regexp_extract(tail, '^[^/?#]*') AS raw_host,
           substr(tail, length(regexp_extract(tail, '^[^/?#]*')) + 1) AS rest
    FROM tails),
urls AS (
    SELECT row_number() OVER () AS row_no, page_id,
           translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^?#]*') AS path
    FROM split),
fits AS (
    SELECT u.*, r.rhost || r.rpath AS rule, r.verdict,
           row_number() OVER (PARTITION BY row_no
                              ORDER BY length(rhost || rpath) DESC NULLS LAST, length(rhost) DESC) AS place
    FROM urls u LEFT JOIN rules r
      ON (u.host = r.rhost OR suffix(u.host, '.' || r.rhost)) AND starts_with(u.path, r.rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
""",
    "op13_vector_codes": _vector_codes_sql(),
}
