"""Queries of the operators in this package, by key, and the SQL twins of those that SQL can state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake.llm import align, bpe, licences, minhash, packing, pii, puscore, quality, rans, search, substring, vectors, warc
from screenlake.llm.common import default_pieces, default_tokenizer, sha256_hex, table
from screenlake.session import scratch_path

#: Ids of the default tokenizer file: 50,256 of its model and one special token.
VOCABULARY = 50_257


def op1_disclosure_sanitise(spark: SparkSession, folder: str) -> DataFrame:
    clean = pii.sanitise(table(spark, folder, "documents"))
    return clean.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", sha256_hex("base").alias("base_sha256"), "spans")


def op2_count_min_substrings(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring.remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", sha256_hex("text").alias("kept_sha256"))


OP2_SQL = r"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), w AS (
    SELECT doc_id, s, array_to_string(ws[s:s + 19], ' ') AS window_text
    FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 19)) AS s FROM d WHERE len(ws) >= 20)
), later AS (
    SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY window_text ORDER BY doc_id, s) AS nth FROM w) WHERE nth > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(generate_series(s, s + 19)) AS place FROM later
), words AS (
    SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS place FROM d
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def op3_segment_reassembly(spark: SparkSession, folder: str) -> DataFrame:
    archives = scratch_path(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), archives)
    read = warc.read_archives(spark, archives).withColumnRenamed("key", "page_id")
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
        min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
    FROM pages
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM p
"""


def op4_positive_unlabelled(spark: SparkSession, folder: str) -> DataFrame:
    return puscore.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(table(spark, folder, "documents"), default_tokenizer(), keep_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op6_spherical_cells(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(table(spark, folder, "embeddings"))


def op7_chosen_path_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


OP7_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle
    FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS i FROM d WHERE len(ws) > 0)
), n AS (
    SELECT doc_id, count(*) AS n_shingles FROM s GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), edges AS (
    SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * shared >= 85 * (p.n_shingles + q.n_shingles - shared)
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x
), c AS (
    SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x
)
SELECT doc_id, coalesce(n_shingles, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
"""


def op8_distribution_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents")).drop("char_distance", "word_distance")


def _op8_sql() -> str:
    lists = "CASE lang " + " ".join(f"WHEN '{name}' THEN [{', '.join(repr(w) for w in own)}]" for name, own in quality.COMMON.items()) + " ELSE []::VARCHAR[] END"
    classes = [r"[^a-z]", r"[^\x20\x09-\x0D]", r"[^A-Z]", r"[\x00-\x7F]", r"[^0-9]", r"[^#*$%&|<>]"]
    counts = ", ".join(f"length(regexp_replace(text, '{rule}', '', 'g'))" for rule in classes)
    bins = quality.BINS
    mean = lambda column, total, n: "[" + ", ".join(f"coalesce(avg(CASE WHEN {total} > 0 THEN {column}[{i}] / {total} END), 0)" for i in range(1, n + 1)) + "]"

    def distance(column: str, reference: str, n: int) -> str:
        p, q = f"({column}[i] / list_sum({column}))", f"{reference}[i]"
        part = lambda x: f"(CASE WHEN {x} > 0 THEN {x} * log2({x} / (({p} + {q}) / 2)) ELSE 0 END)"
        inner = f"list_sum(list_transform(range(1, {n + 1}), lambda i: ({part(p)} + {part(q)}) / 2))"
        return f"CASE WHEN list_sum({column}) = 0 OR list_sum({reference}) = 0 THEN 0 ELSE sqrt(greatest({inner}, 0)) END"

    return rf"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS text, CASE WHEN lang IN ({', '.join(map(repr, quality.COMMON))}) THEN lang ELSE 'other' END AS lang,
            list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM documents
    ), w AS (
        SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS k FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM d WHERE len(ws) > 2)
    ), again AS (
        SELECT doc_id, count(DISTINCT place) AS n FROM (
            SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS times FROM w) WHERE times > 1
        ) GROUP BY doc_id
    ), h AS (
        SELECT *, length(text) AS n_chars, len(ws) AS n_words, [{counts}] AS six, list_transform(ws, lambda x: lower(x)) AS low, {lists} AS own FROM d
    ), p AS (
        SELECT *, list_append(six, n_chars - list_sum(six)) AS chars,
            list_append(list_transform(range(1, {bins}), lambda i: CASE WHEN i <= len(own) THEN len(list_filter(low, lambda x: x = own[i])) ELSE 0 END),
                n_words - len(list_filter(low, lambda x: list_contains(own, x)))) AS commons
        FROM h
    ), r AS (
        SELECT lang, {mean('chars', 'n_chars', 7)} AS char_reference, {mean('commons', 'n_words', bins)} AS word_reference FROM p GROUP BY lang
    ), v AS (
        SELECT doc_id, n_words::BIGINT AS n_words, (n_chars - six[2])::BIGINT AS word_chars, six[6]::BIGINT AS n_symbols,
            (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, n_chars,
            {distance('chars', 'char_reference', 7)} AS char_distance, {distance('commons', 'word_reference', bins)} AS word_distance
        FROM p JOIN r USING (lang) LEFT JOIN again USING (doc_id)
    ), b AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM v
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND NOT (n_chars >= 300 AND char_distance > 0.3) AND NOT (n_words >= 80 AND word_distance > 0.3) AS kept
    FROM b
    """


def op9_rans_tokens(spark: SparkSession, folder: str) -> DataFrame:
    read = rans.round_trip(table(spark, folder, "documents"), default_tokenizer(), VOCABULARY)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_pair_index_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, folder, "documents"), default_tokenizer())


def op11_suffix_automaton_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents")).drop("spans")


def op12_pointer_jumping_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align.align(table(spark, folder, "documents"), default_tokenizer(), default_pieces())


def op13_ball_tree_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark")).select("item_id", "rank", "doc_id", "score")


OP13_SQL = r"""
WITH lowered AS (
    SELECT doc_id, text, 'd' AS kind FROM documents UNION ALL SELECT item_id, text, 'i' FROM benchmark
), words AS (
    SELECT kind, doc_id, unnest(list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term
    FROM lowered
), tf AS (
    SELECT doc_id, term, count(*) AS tf FROM words WHERE kind = 'd' GROUP BY ALL
), len AS (
    SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY ALL
), size AS (
    SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM len
), weight AS (
    SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM tf GROUP BY ALL) CROSS JOIN size
), item AS (
    SELECT DISTINCT doc_id AS item_id, term FROM words WHERE kind = 'i'
), scored AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))))::BIGINT AS score
    FROM item JOIN weight USING (term) JOIN tf USING (term) JOIN len USING (doc_id) CROSS JOIN size GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 50
"""


QUERIES = {
    "op1_disclosure_sanitise": op1_disclosure_sanitise,
    "op2_count_min_substrings": op2_count_min_substrings,
    "op3_segment_reassembly": op3_segment_reassembly,
    "op4_positive_unlabelled": op4_positive_unlabelled,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_spherical_cells": op6_spherical_cells,
    "op7_chosen_path_minhash": op7_chosen_path_minhash,
    "op8_distribution_divergence": op8_distribution_divergence,
    "op9_rans_tokens": op9_rans_tokens,
    "op10_pair_index_bpe": op10_pair_index_bpe,
    "op11_suffix_automaton_licences": op11_suffix_automaton_licences,
    "op12_pointer_jumping_alignment": op12_pointer_jumping_alignment,
    "op13_ball_tree_search": op13_ball_tree_search,
}
ORACLES = {"op8_distribution_divergence": _op8_sql(), "op7_chosen_path_minhash": OP7_SQL, "op2_count_min_substrings": OP2_SQL, "op3_segment_reassembly": OP3_SQL, "op13_ball_tree_search": OP13_SQL}
