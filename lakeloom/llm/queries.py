"""The operators as registered queries over the given tables, and the same in SQL where it can say it."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.rows import documents, table, workspace


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm.chunk_dedup import exact_duplicates

    return exact_duplicates(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    from lakeloom.llm.line_dedup import drop_common_lines

    kept = drop_common_lines(table(spark, sf_dir, "documents"), min_docs, min_chars)
    return kept.withColumn("kept_sha256", F.sha2("text", 256)).drop("text")


def op3_simhash(spark: SparkSession, sf_dir: str, distance: int = 4, width: int = 4) -> DataFrame:
    from lakeloom.llm.simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"), distance, width).drop("component_key")
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op4_token_files(spark: SparkSession, sf_dir: str, file: str = "byte_bpe_50k.json", end_id: int = 2) -> DataFrame:
    from lakeloom.llm.token_files import read_token_files, with_checksum, write_token_files

    path = workspace(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, vocabulary(file), end_id)
    return with_checksum(read_token_files(spark, path))


def op5_token_counts(spark: SparkSession, sf_dir: str, file: str = "piece_bpe_32k.model", limit: int = 4096) -> DataFrame:
    from lakeloom.llm.token_counts import count_tokens

    counts = count_tokens(table(spark, sf_dir, "documents"), vocabulary(file))
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents is scanned first, as an earlier crawl; the scan of all then meets a ledger that knows it."""
    from lakeloom.llm.secret_ledger import RULES, find_secrets, kind_count, listing, scan_unseen

    docs, ledger = table(spark, sf_dir, "documents"), workspace(spark, "secret-ledger")
    earlier = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    scan_unseen(documents(docs.filter(earlier)), ledger)
    found = find_secrets(docs, ledger)
    return found.select(
        "doc_id",
        *(kind_count(i).alias(f"n_{rule.kind}") for i, rule in enumerate(RULES)),
        F.sha2(listing(), 256).alias("base_sha256"),
        listing().alias("spans"),
    )


def op7_suffix_pieces(spark: SparkSession, sf_dir: str, file: str = "piece_bpe_32k.model") -> DataFrame:
    """n_tokens and checksum of the ids of every text, and the SHA-256 of the text that they decode to."""
    from lakeloom.llm.suffix_pieces import decode, encode

    model = vocabulary(file)
    back = decode(encode(table(spark, sf_dir, "documents"), model), model)
    return back.select("doc_id", "n_tokens", F.sha2("decoded", 256).alias("decoded_sha256"), "ids_crc32")


def op8_packing(
    spark: SparkSession, sf_dir: str, file: str = "word_bpe_49k.json", end_id: int = 1, size: int = 2048
) -> DataFrame:
    from lakeloom.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary(file), end_id, size)


def op9_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm.spotsigs import fingerprints_with_edits

    return fingerprints_with_edits(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm.byte_cnn import learn, predictions

    docs = table(spark, sf_dir, "documents")
    return predictions(docs, learn(docs))


def op11_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm.weak_quality import judge

    return judge(table(spark, sf_dir, "documents"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm.resampling import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm.prefix_trie import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_chunk_recipes": op1_chunk_recipes,
    "op2_line_dedup": op2_line_dedup,
    "op3_simhash": op3_simhash,
    "op4_token_files": op4_token_files,
    "op5_token_counts": op5_token_counts,
    "op6_secrets": op6_secrets,
    "op7_suffix_pieces": op7_suffix_pieces,
    "op8_packing": op8_packing,
    "op9_spotsigs": op9_spotsigs,
    "op10_language": op10_language,
    "op11_weak_quality": op11_weak_quality,
    "op12_resampling": op12_resampling,
    "op13_prefix_trie": op13_prefix_trie,
}



def _spans_sql() -> str:
    """The matches of each kind: gaps between them by a split, so that places follow from lengths."""
    assign = (
        "(?:" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
        for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
        r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    )
    kinds = [(0, "assign", assign, 1, 8), (1, "access", "AKIA[A-Z0-9]+", 0, 16), (2, "hex", "[0-9a-f]+", 0, 32)]
    return " UNION ALL ".join(
        f"""
        SELECT r, {rank} AS rank, '{kind}' AS kind, place, len, value >= {least} AS good,
               sum(gap + len) OVER (PARTITION BY r ORDER BY place) AS stop
        FROM (SELECT r, unnest(range(len(m))) AS place, unnest(list_transform(m, lambda x: length(x))) AS len,
                     unnest(list_transform(v, lambda x: length(x))) AS value,
                     unnest(list_transform(g[1:len(m)], lambda x: length(x))) AS gap
              FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {group}) AS v,
                           regexp_split_to_array(t, '{pattern}') AS g FROM d))
        """
        for rank, kind, pattern, group, least in kinds
    )


#: What a byte adds to a CRC-32.
_CRC = [zlib.crc32(bytes([v])) ^ zlib.crc32(b"\0") for v in range(256)]


def _resampling_sql() -> str:
    """CRC-32 byte by byte over the distinct features, with the table of what each byte adds."""
    runs = " UNION ALL ".join(
        f"SELECT side, r, unnest(list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i+{n - 1}], ' '))) AS f FROM d"
        for n in (1, 2, 3)
    )
    return rf"""
        WITH d AS (
            SELECT side, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM (SELECT 0 AS side, row_number() OVER () AS r, doc_id, text FROM documents
                  UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark)
        ), g AS (SELECT side, r, f, count(*) AS k FROM ({runs}) GROUP BY ALL
        ), c AS (
            SELECT f, xor(list_reduce(list_transform(range(1, 2 * strlen(f), 2), lambda i: CAST('0x' || x[i:i+1] AS BIGINT)),
                                      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS b
            FROM (SELECT f, hex(f) AS x FROM (SELECT DISTINCT f FROM g)), (SELECT {_CRC} AS t)
        ), h AS (
            SELECT b, coalesce(sum(k) FILTER (WHERE side = 0), 0) AS s, coalesce(sum(k) FILTER (WHERE side = 1), 0) AS t
            FROM g JOIN c USING (f) GROUP BY b
        ), gain AS (
            SELECT b, CAST(floor(1000 * ln((CAST(t + 1 AS DOUBLE) * CAST((SELECT sum(s) FROM h) + 10000 AS DOUBLE))
                         / (CAST(s + 1 AS DOUBLE) * CAST((SELECT sum(t) FROM h) + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM h
        ), weighed AS (
            SELECT r, CAST(sum(k) AS BIGINT) AS n_features, CAST(sum(k * gain) AS BIGINT) AS weight
            FROM g JOIN c USING (f) JOIN gain USING (b) WHERE side = 0 GROUP BY r
        ), scored AS (
            SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS fit,
                   coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((
                       CAST('0x' || sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) + 0.5) / 4294967296.0))) AS BIGINT)
                   AS score
            FROM d LEFT JOIN weighed USING (r) WHERE side = 0
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored
        )
        SELECT doc_id, n_features, weight, score,
               CASE WHEN fit AND place <= 5 * (SELECT count(*) FROM scored WHERE fit) // 100 THEN place END AS rank FROM placed
    """


_BLANK = r"[\x20\x09-\x0D]"
ORACLES = {
    "op1_chunk_recipes": rf"""
        WITH d AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '{_BLANK}+', ' ', 'g') AS t FROM documents
        )
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)
    """,
    "op2_line_dedup": rf"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), l AS (
            SELECT r, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS place FROM d
        ), k AS (
            SELECT r, line, place,
                   translate(regexp_replace(regexp_replace(line, '^{_BLANK}+', ''), '{_BLANK}+$', ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
        ), common AS (
            SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10
        ), marked AS (
            SELECT k.r, k.line, k.place, common.key IS NOT NULL AS gone FROM k LEFT JOIN common ON k.key = common.key
        ), texts AS (
            SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
                   coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS t FROM marked GROUP BY r
        )
        SELECT d.doc_id, n_lines, n_dropped, sha256(t) AS kept_sha256 FROM texts JOIN d USING (r)
    """,
    "op6_secrets": rf"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
        ), s AS ({_spans_sql()}), l AS (
            SELECT r, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access,
                   count(*) FILTER (WHERE rank = 2) AS n_hex,
                   string_agg(kind || ':' || (stop - len) || ':' || stop, ',' ORDER BY stop - len, rank) AS spans
            FROM s WHERE good GROUP BY r
        )
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN l USING (r)
    """,
    "op12_resampling": _resampling_sql(),
    "op13_prefix_trie": r"""
        WITH t AS (
            SELECT conv_id, turn, dense_rank() OVER (ORDER BY coalesce(role, ''), coalesce(text, '')) AS id,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
                   sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS tie
            FROM conversations WHERE conv_id IS NOT NULL
        ), own AS (
            SELECT conv_id, list({'id': id, 'words': words} ORDER BY turn NULLS FIRST, tie) AS s FROM t GROUP BY conv_id
        ), crc AS (
            SELECT conv_id, s, xor(list_reduce(list_transform(range(1, 2 * strlen(d), 2), lambda i: CAST('0x' || hex(d)[i:i+1] AS BIGINT)),
                                   lambda a, b: xor(a >> 8, k[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) % 4 AS h
            FROM (SELECT conv_id, s, CAST(conv_id AS VARCHAR) AS d FROM own), (SELECT CRC_TABLE AS k)
        ), seq AS (
            SELECT a.conv_id, list_concat(coalesce(b.s[1:a.h], []), a.s[a.h + 1:]) AS s
            FROM crc a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20
        ), p AS (
            SELECT conv_id, d, len(s) AS len, list_transform(s[1:d], lambda x: x.id) AS key, coalesce(s[d].words, 0) AS words
            FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM seq)
        ), n AS (
            SELECT d, key, min(conv_id) AS least, count(*) AS n, max(words) AS words, max(len) = d AS leaf,
                   coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len = d), '') AS ends
            FROM p GROUP BY d, key
        ), c AS (
            SELECT d - 1 AS d, key[1:d - 1] AS key, count(*) AS children FROM n WHERE d > 0 GROUP BY ALL
        ), r AS (
            -- what a conversation adds to the nodes it is in: the nodes further on of which it is the smallest member
            SELECT p.d, p.key, sum(CASE WHEN p.conv_id = n.least THEN (n.n - 1) * n.words ELSE 0 END) OVER w AS saved,
                   sum(CASE WHEN p.conv_id = n.least AND n.leaf THEN 1 ELSE 0 END) OVER w AS leaves
            FROM p JOIN n USING (d, key) WINDOW w AS (PARTITION BY p.conv_id ORDER BY p.d DESC)
        ), sums AS (SELECT d, key, sum(saved) AS saved, sum(leaves) AS leaves FROM r GROUP BY d, key)
        SELECT n.least AS conv_id, CAST(n.d AS BIGINT) AS depth, u.least AS parent_conv_id, n.n AS n_convs,
               coalesce(c.children, 0) AS n_children, CAST(sums.leaves AS BIGINT) AS n_leaves, CAST(sums.saved AS BIGINT) AS saved_tokens,
               sha256(n.ends) AS ends_sha256
        FROM n JOIN sums USING (d, key) LEFT JOIN c USING (d, key) LEFT JOIN n u ON u.d = n.d - 1 AND u.key = n.key[1:n.d - 1]
    """.replace("CRC_TABLE", str(_CRC)),
}
