"""One query per operator, each over the whole of its table, and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import table
from siltstone.llm.decontamination import with_leaks
from siltstone.llm.exact_dups import exact_duplicates
from siltstone.llm.importance import resample
from siltstone.llm.license_scan import scan_licenses
from siltstone.llm.merkle import manifest
from siltstone.llm.near_dups import Plan, near_duplicates
from siltstone.llm.quality import judge
from siltstone.llm.repeats import remove_repeats
from siltstone.llm.sentencepieces import encode_documents
from siltstone.llm.sharding import shards
from siltstone.llm.token_counts import count_tokens
from siltstone.llm.token_files import read_token_files, write_token_files
from siltstone.llm.toxicity import held_out, score_documents, train
from siltstone.session import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def byte_bpe() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_text_convolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, by a model that never saw the held-out ones."""
    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "toxic",
    )


@query
def op2_patched_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    path = new_folder(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, byte_bpe(), end_id=0)
    return read_token_files(spark, path)


@query
def op3_signature_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence findings in all documents."""
    return scan_licenses(table(spark, sf_dir, "documents"))


ORACLES["op4_adaptive_thresholds"] = r"""
WITH split AS (
  SELECT doc_id, coalesce('=' || lang, '') AS la, coalesce('=' || source, '') AS so, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls
  FROM documents),
windows AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM split, unnest(generate_series(1, len(ws) - 2)) AS u(i) WHERE len(ws) > 2),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS v(k) GROUP BY 1),
counted AS (
  SELECT split.doc_id, la, so, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN repeated USING (doc_id)),
rated AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CAST(CASE WHEN word_chars > 0 THEN floor(n_symbols * 1000::DOUBLE / word_chars) ELSE 0 END AS BIGINT) AS symbol_rate,
    CAST(CASE WHEN n_lines > 0 THEN floor(n_dup_lines * 1000::DOUBLE / n_lines) ELSE 0 END AS BIGINT) AS dup_line_rate,
    CAST(CASE WHEN n_words > 0 THEN floor(n_repeat_words * 1000::DOUBLE / n_words) ELSE 0 END AS BIGINT) AS repeat_rate,
    CAST(CASE WHEN n_words > 0 THEN floor(word_chars * 10::DOUBLE / n_words) ELSE 0 END AS BIGINT) AS word_length
  FROM counted),
long AS (
  UNPIVOT (SELECT la, so, symbol_rate, dup_line_rate, repeat_rate, word_length FROM rated WHERE NOT base_failed)
  ON symbol_rate, dup_line_rate, repeat_rate, word_length INTO NAME feature VALUE v),
sketch AS (
  SELECT la, so, feature, (v >> greatest(length(bin(v)) - 5, 0)) << greatest(length(bin(v)) - 5, 0) AS bucket, count(*) AS n
  FROM long GROUP BY ALL),
levels AS (
  SELECT 0 AS level, la, so, feature, bucket, n FROM sketch
  UNION ALL SELECT 1, la, NULL, feature, bucket, sum(n) FROM sketch GROUP BY ALL
  UNION ALL SELECT 2, NULL, NULL, feature, bucket, sum(n) FROM sketch GROUP BY ALL),
ranked AS (
  SELECT *, sum(n) OVER (PARTITION BY level, la, so, feature ORDER BY bucket) AS below,
         sum(n) OVER (PARTITION BY level, la, so, feature) AS size FROM levels),
settings AS (
  SELECT * FROM (VALUES ('symbol_rate', 500, 800, 3, 500), ('dup_line_rate', 500, 990, 0, 500),
                        ('repeat_rate', 500, 990, 0, 500), ('word_length', 250, 750, 3, 1000000))
    AS s(feature, lower_share, upper_share, reach, cap)),
quantiles AS (
  SELECT level, la, so, feature, max(size) AS size,
         min(bucket) FILTER (1000 * below >= lower_share * size) AS low,
         min(bucket) FILTER (1000 * below >= upper_share * size) AS high
  FROM ranked JOIN settings USING (feature) GROUP BY ALL),
chosen AS (
  SELECT own.la, own.so, own.feature,
         CASE WHEN own.size >= 200 THEN own.low WHEN lang.size >= 200 THEN lang.low ELSE every.low END AS low,
         CASE WHEN own.size >= 200 THEN own.high WHEN lang.size >= 200 THEN lang.high ELSE every.high END AS high
  FROM quantiles own JOIN quantiles lang ON lang.level = 1 AND lang.la = own.la AND lang.feature = own.feature
  JOIN quantiles every ON every.level = 2 AND every.feature = own.feature WHERE own.level = 0),
fences AS (
  SELECT la, so, feature, least(high + reach * (high - low), cap) AS most, low - reach * (high - low) AS least
  FROM chosen JOIN settings USING (feature)),
judged AS (
  UNPIVOT (SELECT doc_id, la, so, symbol_rate, dup_line_rate, repeat_rate, word_length FROM rated WHERE NOT base_failed)
  ON symbol_rate, dup_line_rate, repeat_rate, word_length INTO NAME feature VALUE v),
beyond AS (
  SELECT doc_id FROM (
    SELECT *, (v >> greatest(length(bin(v)) - 5, 0)) << greatest(length(bin(v)) - 5, 0) AS bucket FROM judged)
  JOIN fences USING (la, so, feature) WHERE bucket > most OR (feature = 'word_length' AND bucket < least))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM beyond) AS kept,
       symbol_rate, dup_line_rate, repeat_rate, word_length
FROM rated"""


@query
def op4_adaptive_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdicts of all documents."""
    return judge(table(spark, sf_dir, "documents"))


@query
def op5_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of all documents, and whether they give the text back."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return encode_documents(table(spark, sf_dir, "documents"), model)


@query
def op6_sampled_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all documents without 100-byte strings that stand earlier."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op7_digest_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents from a cache that a first run over them has filled."""
    docs, cache = table(spark, sf_dir, "documents"), new_folder(spark, "token-counts")
    count_tokens(docs, cache, byte_bpe())
    return count_tokens(docs, cache, byte_bpe())


@query
def op8_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards whose row counts are at most one apart."""
    placed = shards(table(spark, sf_dir, "documents"), 16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op9_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in all documents, one row per document and item."""
    found = with_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("leaks"))


ORACLES["op10_odd_sketches"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) = 1 THEN ws[1] ELSE ws[i] || ' ' || ws[i + 1] END AS s
  FROM words, unnest(generate_series(1, greatest(len(ws) - 1, 1))) AS u(i) WHERE len(ws) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM shared JOIN sizes sx ON sx.doc_id = x JOIN sizes sy ON sy.doc_id = y
  WHERE 100 * c >= 80 * (sx.n + sy.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (
  SELECT doc_id, doc_id AS seen FROM documents
  UNION SELECT reached.doc_id, edges.y FROM reached JOIN edges ON edges.x = reached.seen)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(seen) AS component_id,
       doc_id = min(seen) AS kept
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""


@query
def op10_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents, over shingles of two words."""
    return near_duplicates(table(spark, sf_dir, "documents"), Plan(words=2))


# Checksums are spelled out: DuckDB has no crc32.
CRC32_TABLE = """
crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
                          i::BIGINT) ORDER BY i) AS t
  FROM range(256) r(i))"""


def crc32_sql(text: str) -> str:
    """SQL for the unsigned crc32 of a text; the row must hold ``t`` of ``crc_table``."""
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2*i+1, 2))::BIGINT)"
    step = "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce({octets}, {step}, 4294967295::BIGINT), 4294967295)"


ORACLES["op11_regular_sampling"] = rf"""
WITH {CRC32_TABLE},
own AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
wanted AS (
  SELECT regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
own_words AS (SELECT r, unnest(ws) AS w FROM own),
wanted_words AS (SELECT unnest(ws) AS w FROM wanted),
words AS (SELECT DISTINCT w FROM (SELECT w FROM own_words UNION ALL SELECT w FROM wanted_words)),
buckets AS MATERIALIZED (SELECT w, {crc32_sql("w")} % 10000 AS b FROM words, crc_table),
s AS (SELECT b, count(*) AS n FROM own_words JOIN buckets USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM wanted_words JOIN buckets USING (w) GROUP BY b),
totals AS (SELECT (SELECT coalesce(sum(n), 0) FROM s)::BIGINT AS s_all, (SELECT coalesce(sum(n), 0) FROM t)::BIGINT AS t_all),
gains AS (
  SELECT b, floor(1000 * ln(((coalesce(t.n, 0) + 1) * (s_all + 10000))::DOUBLE / ((s.n + 1) * (t_all + 10000))))::BIGINT AS g
  FROM s LEFT JOIN t USING (b), totals),
weights AS (
  SELECT r, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM own_words JOIN buckets USING (w) JOIN gains USING (b) GROUP BY r),
scored AS (
  SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT
           AS score
  FROM own LEFT JOIN weights USING (r)),
places AS (
  SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place
  FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= (SELECT count(*) * 10 // 100 FROM scored WHERE n_features >= 20) THEN place END AS rank
FROM places"""


@query
def op11_regular_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of all documents, drawn towards the benchmark's words, in the order of their scores."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_quotient_filters"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


@query
def op12_quotient_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among all documents."""
    return exact_duplicates(table(spark, sf_dir, "documents"))


def _merkle_sql(levels: int = 24, languages: int = 8) -> str:
    """All levels one after the other; a tree that is down to one node keeps it."""

    def climb(name: str, key: str, n: int) -> list[str]:
        return [
            f"""{name}{i + 1} AS MATERIALIZED (
  SELECT {key}, p // 2 AS p, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY p)) END AS h,
         (any_value(n) + 1) // 2 AS n
  FROM {name}{i} GROUP BY {key}, p // 2)"""
            for i in range(n)
        ]

    def walk(name: str, key: str, n: int, start: str, out: str) -> list[str]:
        """Fold and collect siblings level by level; q is the place of the row's node."""
        parts, before = [], start
        for i in range(n):
            parts.append(
                f"""{out}{i} AS MATERIALIZED (
  SELECT w.* REPLACE (w.q // 2 AS q, w.proof || coalesce(s.h, '') AS proof,
         CASE WHEN m.n = 1 THEN w.f WHEN s.h IS NULL THEN sha256(w.f)
              WHEN w.q % 2 = 0 THEN sha256(w.f || s.h) ELSE sha256(s.h || w.f) END AS f)
  FROM {before} w JOIN {name}{i} m ON m.{key} = w.{key} AND m.p = w.q
  LEFT JOIN {name}{i} s ON s.{key} = w.{key} AND s.p = xor(w.q, 1))"""
            )
            before = f"{out}{i}"
        return parts

    def stated(value: str) -> str:
        return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"

    def leaf(n_chars: str) -> str:
        return "sha256(" + " || ".join(map(stated, ["doc_id", "source", "lang", n_chars, "text"])) + ")"

    ctes = [
        CRC32_TABLE,
        f"""leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '') AS la, {leaf("n_chars")} AS leaf,
         CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 7 = 0 THEN {leaf("(n_chars + 1)")} ELSE {leaf("n_chars")} END AS seen
  FROM documents, crc_table)""",
        """t0 AS MATERIALIZED (
  SELECT *, leaf AS h, row_number() OVER (PARTITION BY la ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY la) AS n
  FROM leaves)""",
        *climb("t", "la", levels),
        f"u0 AS MATERIALIZED (SELECT 0 AS k, la, h, row_number() OVER (ORDER BY encode(la)) - 1 AS p, count(*) OVER () AS n FROM t{levels})",
        *climb("u", "k", languages),
        "w AS (SELECT doc_id, la, leaf, p AS q, '' AS proof, seen AS f FROM t0)",
        *walk("t", "la", levels, "w", "w"),
        f"x AS (SELECT w.* REPLACE (u0.p AS q), 0 AS k, u0.h AS subroot FROM w{levels - 1} w JOIN u0 USING (la))",
        *walk("u", "k", languages, "x", "x"),
    ]
    return (
        "WITH "
        + ",\n".join(ctes)
        + f"""
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = r.h AS verified
FROM x{languages - 1} JOIN u{languages} r USING (k)"""
    )


#: Enough levels for 16 million rows a language and 256 languages.
ORACLES["op13_subtree_exchange"] = _merkle_sql()


@query
def op13_subtree_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, checked against rows of which every seventh was tampered with."""
    docs = table(spark, sf_dir, "documents")
    # Every seventh row by its id's checksum; never a row without id.
    tampered = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 0
    return manifest(docs, {"n_chars": F.when(tampered, docs["n_chars"] + 1).otherwise(docs["n_chars"])})
