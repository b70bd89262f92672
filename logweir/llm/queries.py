"""One query for each operator, over its whole table with production parameters, and SQL for those it can express."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.llm.chat import format_chats
from logweir.llm.collocations import mine_collocations
from logweir.llm.decision_list import judge_documents
from logweir.llm.exact_dedup import exact_groups
from logweir.llm.kneser_ney import judge_quality
from logweir.llm.merkle import build_manifest, leaf_digest, prove
from logweir.llm.mixing import mix
from logweir.llm.packing import pack
from logweir.llm.piece_scan import decode_pieces, encode_pieces
from logweir.llm.probminhash import near_classes
from logweir.llm.suffix_dedup import cut_rows
from logweir.llm.tables import table
from logweir.llm.token_files import read_token_files, write_token_files
from logweir.llm.url_filter import judge_urls
from logweir.workspace import new_folder

#: A file of the tokenizers library; where it stands is the caller's choice.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
END = 1
#: A model file of the sentencepiece library.
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    keep = ["doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("own")]
    cut = cut_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=keep)
    nothing = F.lit(0).cast("long")
    return cut.select(
        "doc_id",
        "n_bytes",
        F.coalesce("cut.n_removed", nothing).alias("n_removed"),
        F.coalesce("cut.n_spans", nothing).alias("n_spans"),
        F.coalesce(F.sha2("cut.left", 256), "own").alias("kept_sha256"),
    )


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = format_chats(table(spark, sf_dir, "conversations"))
    return made.withColumn("rendered_sha256", F.sha2("rendered", 256)).drop("rendered", "position")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "lang", "n_bytes", F.round("perplexity", 6).alias("perplexity"), "kept")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), folder, WORD_BPE, END)
    read = read_token_files(spark, folder).drop("ids", "id")
    index = spark.read.parquet(f"{folder}/index").select("part", "block", "slot", F.col("id").alias("doc_id"), "start")
    return read.join(index, ["part", "block", "slot"]).select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = decode_pieces(encode_pieces(table(spark, sf_dir, "documents"), PIECES), PIECES)
    return made.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "score",
        "ids_crc32",
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).withColumnRenamed("digest", "text_sha256")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(table(spark, sf_dir, "documents"))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    claimed = leaf_digest([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text])
    return prove(build_manifest(docs, claimed=claimed)).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_chat_format": op3_chat_format,
    "op4_quality_rules": op4_quality_rules,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_token_files": op6_token_files,
    "op7_url_filter": op7_url_filter,
    "op8_minhash": op8_minhash,
    "op9_pieces": op9_pieces,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_collocations": op11_collocations,
    "op12_source_mix": op12_source_mix,
    "op13_merkle": op13_merkle,
}

ORACLES = {
    # Bytes are pairs of hexadecimal digits here.
    "op2_suffix_dedup": r"""
        WITH d AS (
            SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
        ), parts AS (
            SELECT k, 1000 * b AS base, h[2000 * b + 1:2000 * b + 2398] AS part
            FROM (SELECT k, h, unnest(range(0, greatest(length(h) // 2 + 800, 0) // 1000)) AS b FROM d)
        ), starts AS MATERIALIZED (
            SELECT k, base + i AS i, md5_number(part[2 * i + 1:2 * i + 400]) AS g
            FROM (SELECT k, base, part, unnest(range(0, least(1000, length(part) // 2 - 199))) AS i FROM parts)
        ), again AS (
            SELECT k, i FROM starts WHERE g IN (SELECT g FROM starts GROUP BY g HAVING count(*) > 1)
        ), marked AS (
            SELECT *, coalesce(i > lag(i) OVER (PARTITION BY k ORDER BY i) + 200, true) AS new FROM again
        ), runs AS (
            SELECT *, count_if(new) OVER (PARTITION BY k ORDER BY i) AS run FROM marked
        ), spans AS (
            SELECT k, min(i) AS first, max(i) + 200 AS last FROM runs GROUP BY k, run
        ), gaps AS (
            SELECT k, first, last, coalesce(lag(last) OVER (PARTITION BY k ORDER BY first), 0) AS begin FROM spans
        ), cut AS (
            SELECT k, sum(last - first)::BIGINT AS n_removed, count(*) AS n_spans, max(last) AS tail,
                   string_agg(h[2 * begin + 1:2 * first], '' ORDER BY first) AS kept
            FROM gaps JOIN d USING (k) GROUP BY k
        )
        SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(kept || h[2 * tail + 1:], h))) AS kept_sha256
        FROM d LEFT JOIN cut USING (k)
    """,
    "op10_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
            FROM documents
        ), g AS (
            SELECT *, first_value(doc_id) OVER (PARTITION BY content ORDER BY chars DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY content) AS group_size
            FROM d
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM g
    """,
    "op11_collocations": r"""
        WITH t AS (
            SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) AS piece
            FROM documents
        ), p AS (
            SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM t
        ), g AS (
            SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS a
            FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT *, unnest(range(1, 5)) AS m FROM p))
            GROUP BY ALL
        ), f AS MATERIALIZED (
            SELECT *, string_split(phrase, ' ') AS w FROM g WHERE a >= 30
        ), parts AS MATERIALIZED (
            SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:m], ' ') AS tail
            FROM (SELECT *, unnest(range(1, m)) AS k FROM f)
        ), cuts AS (
            SELECT p.*, x.a AS l, y.a AS r, 2000000::HUGEINT * p.a // (x.a + y.a) AS score
            FROM parts AS p JOIN f AS x ON x.lang = p.lang AND x.phrase = p.head JOIN f AS y ON y.lang = p.lang AND y.phrase = p.tail
        ), best AS (
            SELECT lang, phrase, a, l, r, score FROM cuts
            QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), pieces AS MATERIALIZED (
            SELECT lang, a, array_to_string(w[i:i + n - 1], ' ') AS phrase
            FROM (SELECT *, unnest(range(1, m - n + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS n FROM f))
        ), inside AS (
            SELECT DISTINCT x.lang, x.phrase FROM pieces AS p JOIN f AS x USING (lang, phrase) WHERE 100 * p.a >= 80 * x.a
        ), total AS (
            SELECT lang, sum(a)::BIGINT AS n FROM g WHERE m = 1 GROUP BY lang
        ), ranked AS (
            SELECT best.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
            FROM best ANTI JOIN inside USING (lang, phrase)
        )
        SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
    """,
    "op12_source_mix": r"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
        ), s AS (
            SELECT source, sum(size)::HUGEINT AS source_size,
                   CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
            FROM d GROUP BY source
        ), o AS (
            SELECT *, row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS k FROM s
        ), levels AS (
            SELECT k, w, 200 * source_size AS cap,
                   (150 * sum(source_size) OVER () - coalesce(sum(200 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::HUGEINT AS top,
                   (sum(w) OVER (ORDER BY k DESC))::HUGEINT AS bottom
            FROM o
        ), level AS (
            SELECT top, bottom FROM levels WHERE w * top <= cap * bottom ORDER BY k LIMIT 1
        ), t AS (
            SELECT source, source_size::BIGINT AS source_size,
                   least(w::DOUBLE * top::DOUBLE / bottom::DOUBLE / 100, (2 * source_size)::DOUBLE) AS target
            FROM s, level
        ), e AS (
            SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS take,
                   sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('17:' || d.doc_id || ':' || d.size), d.doc_id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS before
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, size::BIGINT AS size, source_size, target,
               (CASE WHEN source_size = 0 THEN 0 ELSE take // source_size * size
                     + greatest(least(take % source_size - before, size), 0) END)::BIGINT AS taken
        FROM e
    """,
    "op13_merkle": r"""
        WITH RECURSIVE parts AS (
            SELECT doc_id, source, x.*
            FROM documents, LATERAL (SELECT
                coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                coalesce(strlen(text) || ':' || text, '-') AS body,
                replace(text, chr(10), '') AS cut,
                list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::UBIGINT)),
                    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]),
                        lambda v, i: xor(v >> 1, 3988292384::UBIGINT * (v & 1)))) AS crc) AS x
        ), leaves AS (
            SELECT doc_id, source, sha256(head || body) AS leaf,
                   CASE WHEN xor(crc, 4294967295::UBIGINT) % 2 = 0
                        THEN sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) ELSE sha256(head || body) END AS claimed
            FROM parts
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                   dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
            FROM leaves
        ), up AS (
            SELECT tree, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM ranked
            UNION ALL
            SELECT tree, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 2) // 3
            FROM up WHERE n > 1 GROUP BY tree, level, pos // 3
        ), subroots AS (
            SELECT tree, digest AS subroot FROM up WHERE n = 1
        ), above AS (
            SELECT 0 AS level, tree AS pos, subroot AS digest, count(*) OVER () AS n FROM subroots
            UNION ALL
            SELECT level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 2) // 3
            FROM above WHERE n > 1 GROUP BY level, pos // 3
        ), nodes AS (
            SELECT tree, level, pos, n, digest FROM up WHERE n > 1
            UNION ALL SELECT -1, level, pos, n, digest FROM above WHERE n > 1
        ), runs AS (
            SELECT tree, level, pos // 3 AS run, list(digest ORDER BY pos) AS digests FROM nodes GROUP BY ALL
        ), fold AS (
            SELECT row_number() OVER () AS id, tree, 0 AS level, pos, tree AS home, claimed AS digest, '' AS proof FROM ranked
            UNION ALL
            SELECT f.id, CASE WHEN r.digests IS NULL THEN -1 ELSE f.tree END, CASE WHEN r.digests IS NULL THEN 0 ELSE f.level + 1 END,
                   CASE WHEN r.digests IS NULL THEN f.home ELSE f.pos // 3 END, f.home,
                   CASE WHEN r.digests IS NULL THEN f.digest ELSE sha256(array_to_string(
                       list_concat(list_append(r.digests[1:f.pos % 3], f.digest), r.digests[f.pos % 3 + 2:]), '')) END,
                   f.proof || coalesce(array_to_string(list_concat(r.digests[1:f.pos % 3], r.digests[f.pos % 3 + 2:]), ''), '')
            FROM fold AS f LEFT JOIN runs AS r ON r.tree = f.tree AND r.level = f.level AND r.run = f.pos // 3
            WHERE r.digests IS NOT NULL OR f.tree >= 0
        ), ends AS (
            SELECT id, digest, proof FROM fold QUALIFY row_number() OVER (PARTITION BY id ORDER BY tree = -1 DESC, level DESC) = 1
        ), numbered AS (
            SELECT row_number() OVER () AS id, * FROM ranked
        )
        SELECT doc_id, leaf, subroot, o.digest AS root, sha256(e.proof) AS proof_sha256, e.digest AS folded_root, e.digest = o.digest AS verified
        FROM numbered JOIN ends AS e USING (id) JOIN subroots USING (tree), above AS o WHERE o.n = 1
    """,
}
