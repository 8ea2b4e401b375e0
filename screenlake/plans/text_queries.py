"""Text columns, tokens, added tasks and ROUGE."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F

from screenlake.functions import text as tx
from screenlake.functions.rouge import rouge, rouge_means
from screenlake.operators import corpus, encoding, metrics, sentences
from screenlake.plans import bindings as b
from screenlake.plans.metric_queries import token_scores
from screenlake.plans.registry import query
from screenlake.session import materialize, scratch_path
from screenlake.sources import files

# Longest encoded source and target, in tokens.
SOURCE, TARGET = 3600, 500


def _docs(spark, sf_dir, *columns):
    return b.table(spark, sf_dir, "documents").select("doc_id", *columns)


@query("resolve_columns", """SELECT "text", conv_id AS summary FROM conversations""")
def resolve_columns(spark, sf_dir):
    talk = b.table(spark, sf_dir, "conversations").select("turn", "conv_id", "role", "text")
    return corpus.resolve_columns(talk, text_column="text")


@query("dataset_columns", """SELECT "text", role AS summary FROM conversations""")
def dataset_columns(spark, sf_dir):
    """Columns by the name of a known data set."""
    talk = b.table(spark, sf_dir, "conversations").select("conv_id", F.col("text").alias("dialogue"), F.col("role").alias("summary"))
    return corpus.resolve_columns(talk, dataset="samsum")


@query(
    "text_form",
    """SELECT d.doc_id, coalesce(l.quality::VARCHAR, 'nan') AS quality FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def text_form(spark, sf_dir):
    joined = _docs(spark, sf_dir).join(b.table(spark, sf_dir, "labels"), "doc_id", "left")
    return joined.select("doc_id", tx.as_text("quality").alias("quality"))


@query(
    "batched_map",
    """SELECT doc_id, len("text") AS n_chars, upper(lang) AS lang FROM documents""",
)
def batched_map(spark, sf_dir):
    """A user's function over batches of rows."""

    def measured(frames):
        for frame in frames:
            yield frame.assign(n_chars=frame["text"].str.len(), lang=frame["lang"].str.upper())[["doc_id", "n_chars", "lang"]]

    return corpus.map_batches(_docs(spark, sf_dir, "text", "lang"), measured, "doc_id long, n_chars long, lang string")


@query("prefix_text", """SELECT doc_id, 'summarize: ' || "text" AS "text" FROM documents""")
def prefix_text(spark, sf_dir):
    return corpus.prefix_text(_docs(spark, sf_dir, "text"), "text", "summarize: ")


@query(
    "file_root",
    """SELECT doc_id, split_part(split_part(source || '_' || doc_id || '.x.json', '.', 1), '_', 1) AS root FROM documents""",
)
def file_root(spark, sf_dir):
    path = F.concat("source", F.lit("_"), F.col("doc_id").cast("string"), F.lit(".x.json"))
    return _docs(spark, sf_dir, "source").select("doc_id", tx.file_root(path).alias("root"))


@query("parent_dir", "SELECT page_id, string_split(url, '/')[-2] AS parent FROM pages")
def parent_dir(spark, sf_dir):
    return b.table(spark, sf_dir, "pages").select("page_id", tx.parent_dir("url").alias("parent"))


@query(
    "sentence_lines",
    r"""SELECT doc_id, regexp_replace("text", '([.!?])\s+', E'\\1\n', 'g') AS "text" FROM documents""",
)
def sentence_lines(spark, sf_dir):
    return _docs(spark, sf_dir, "text").withColumn("text", tx.sentence_lines("text"))


ABBREVIATIONS_SQL = r"""
    tokens AS (SELECT unnest(regexp_extract_all("text", '\S+')) AS token FROM documents),
    typed AS (SELECT regexp_replace(lower(token), '^[^\p{L}\p{N}]+', '') AS bare, ends_with(token, '.') AS period FROM tokens),
    counted AS (SELECT CASE WHEN ends_with(bare, '.') THEN bare[:-2] ELSE bare END AS word, count(*) FILTER (period) AS a,
                       count(*) FILTER (NOT period) AS b FROM typed GROUP BY 1),
    share AS (SELECT sum(a) / sum(a + b) AS p FROM counted),
    scores AS (SELECT word, a AS with_period, b AS without_period, len(word) - len(replace(word, '.', '')) + 1 AS periods,
                      len(replace(word, '.', '')) AS inner_length,
                      -2 * (a * ln(p / 0.99::DOUBLE) + b * ln((1 - p) / (1 - 0.99::DOUBLE))) AS ratio
               FROM counted, share WHERE a > 0 AND regexp_matches(word, '^\p{L}')),
    scored AS (SELECT word, with_period, without_period,
                      ratio * exp(-inner_length) * periods * power(inner_length::DOUBLE, -without_period) AS score FROM scores)"""


@query("abbreviation_scores", f"WITH {ABBREVIATIONS_SQL} SELECT word, with_period, without_period, round(score, 6) + 0.0::DOUBLE AS score FROM scored")
def abbreviation_scores(spark, sf_dir):
    return sentences.abbreviation_scores(_docs(spark, sf_dir, "text")).withColumn("score", F.round("score", 6) + F.lit(0.0))


@query(
    "sentence_lines_learned",
    rf"""WITH {ABBREVIATIONS_SQL},
        known AS (SELECT list(word) AS words FROM scored WHERE score >= {sentences.THRESHOLD}),
        cut AS (SELECT doc_id, regexp_extract_all("text", '(?s)(.*?[.!?]\s+|.+$)', 1) AS pieces FROM documents),
        lasts AS (SELECT doc_id, list_transform(pieces, lambda p: {{'piece': p,
                         'bare': regexp_replace(lower(string_split(rtrim(regexp_replace(p, '\s', ' ', 'g')), ' ')[-1]), '^[^\p{{L}}\p{{N}}]+', '')}}) AS l FROM cut)
        SELECT doc_id, array_to_string(list_transform(l, lambda x: CASE WHEN ends_with(x.bare, '.') AND list_contains(words, x.bare[:-2])
                   OR NOT regexp_matches(x.piece, '[.!?]\s+$') THEN x.piece ELSE regexp_replace(x.piece, '([.!?])\s+$', E'\\1\n') END), '') AS "text"
        FROM lasts, known""",
)
def sentence_lines_learned(spark, sf_dir):
    docs = _docs(spark, sf_dir, "text")
    return sentences.sentence_lines(docs, sentences.learn_abbreviations(docs))


@query(
    "token_counts",
    r"""SELECT doc_id, len(regexp_extract_all("text", '\S+')) AS token_count,
               len(regexp_extract_all(split_part("text", chr(10), 1), '\S+')) AS token_count_correct FROM documents""",
)
def token_counts(spark, sf_dir):
    counted = corpus.count_tokens(b.pairs(spark, sf_dir))
    return counted.select(F.col("row_id").alias("doc_id"), "token_count", "token_count_correct")


@query(
    "filter_token_limits",
    rf"""WITH {b.TURNS_SQL},
        c AS (SELECT conv_id, turn, len(regexp_extract_all(prompt, '\S+')) AS token_count,
                     len(regexp_extract_all(correct_answer, '\S+')) AS token_count_correct FROM turns)
        SELECT * FROM c WHERE token_count <= 30 AND token_count_correct <= 200""",
)
def filter_token_limits(spark, sf_dir):
    counted = corpus.count_tokens(b.turns(spark, sf_dir))
    kept = corpus.limit_tokens(counted, 30, 200)
    return kept.select("conv_id", "turn", "token_count", "token_count_correct")


# -------------------------------------------------------------------- encoding

VOCAB_SQL = r"""
    vocab AS (SELECT token, 2 + row_number() OVER (ORDER BY token) AS id FROM (
        SELECT DISTINCT unnest(regexp_extract_all("text", '\S+')) AS token FROM benchmark))"""


def ids_sql(length: int | None = None) -> str:
    return rf"""{VOCAB_SQL},
    cut AS (SELECT doc_id, regexp_extract_all("text", '\S+')[1:{length or ''}] AS t FROM documents),
    flat AS (SELECT doc_id, generate_subscripts(t, 1) AS pos, unnest(t) AS token FROM cut),
    coded AS (SELECT doc_id, list(coalesce(id, 2) ORDER BY pos) AS ids, list(token ORDER BY pos) FILTER (id IS NOT NULL)
              AS known FROM flat LEFT JOIN vocab USING (token) GROUP BY doc_id),
    rows_ AS (SELECT doc_id, coalesce(ids, []) AS ids, coalesce(known, []) AS known
              FROM documents LEFT JOIN coded USING (doc_id))"""


def _vocab(spark, sf_dir):
    return encoding.vocabulary(b.table(spark, sf_dir, "benchmark"), "text")


def _joined(column):
    return F.array_join(F.col(column).cast("array<string>"), " ")


@query(
    "encode_pad",
    f"""WITH {ids_sql(SOURCE)} SELECT doc_id, array_to_string(list_resize(ids, {SOURCE}, 0), ' ') AS input_ids,
        array_to_string(list_resize(list_transform(ids, lambda x: 1), {SOURCE}, 0), ' ') AS attention_mask FROM rows_""",
)
def encode_pad(spark, sf_dir):
    coded = encoding.encode(_docs(spark, sf_dir, "text"), "doc_id", {"x": ("text", SOURCE)}, _vocab(spark, sf_dir))
    return coded.select("doc_id", _joined("x_ids").alias("input_ids"), _joined("x_mask").alias("attention_mask"))


@query(
    "shift_right",
    f"""WITH {ids_sql(TARGET)} SELECT doc_id, '0 ' || array_to_string(list_resize(ids, {TARGET}, 0)[1:{TARGET - 1}], ' ')
        AS decoder_input_ids, array_to_string(list_resize(ids, {TARGET}, 0), ' ') AS labels FROM rows_""",
)
def shift_right(spark, sf_dir):
    docs = _docs(spark, sf_dir, F.col("text").alias("summary"), F.col("source").alias("text"))
    coded = encoding.encode_pairs(docs, "doc_id", _vocab(spark, sf_dir), SOURCE, TARGET)
    return coded.select("doc_id", _joined("decoder_input_ids").alias("decoder_input_ids"), _joined("labels").alias("labels"))


@query("decode_ids", f"WITH {ids_sql()} SELECT doc_id, array_to_string(known, ' ') AS \"text\" FROM rows_")
def decode_ids(spark, sf_dir):
    vocab = _vocab(spark, sf_dir)
    coded = encoding.encode(_docs(spark, sf_dir, "text"), "doc_id", {"x": ("text", None)}, vocab)
    return encoding.decode(coded, "doc_id", "x_ids", vocab)


@query(
    "mean_gen_len",
    rf"""SELECT avg(len(regexp_extract_all("text", '\S+'))) AS gen_len FROM documents""",
)
def mean_gen_len(spark, sf_dir):
    coded = encoding.encode(_docs(spark, sf_dir, "text"), "doc_id", {"x": ("text", None)}, _vocab(spark, sf_dir))
    return metrics.mean_length(coded, "x_ids", encoding.PAD)


# ----------------------------------------------------------------------- tasks


@query(
    "batch_predict",
    rf"""WITH {b.TURNS_SQL} SELECT conv_id, turn, {b.FIRST_SENTENCE_SQL.format("prompt")} AS predictions FROM turns""",
)
def batch_predict(spark, sf_dir):
    def load():
        end = re.compile(r"(.*?[.!?])(\s|$)", re.DOTALL | re.ASCII)

        def run(texts: np.ndarray) -> np.ndarray:
            found = [end.match(t) for t in texts]
            return np.array([m.group(1) if m else "" for m in found], dtype=object)

        return run

    rows = corpus.predict(b.turns(spark, sf_dir), corpus.batch_predictor(load, 64))
    return rows.select("conv_id", "turn", "predictions")


@query(
    "attach_predictions",
    rf"""WITH {b.PAIRS_SQL} SELECT row_id, id, correct_answer, {b.FIRST_SENTENCE_SQL.format("prompt")} AS predictions
        FROM pairs""",
)
def attach_predictions(spark, sf_dir):
    pairs = b.pairs(spark, sf_dir)
    predicted = corpus.predict(pairs.select("row_id", "prompt"), b.first_sentence).select("row_id", "predictions")
    return corpus.attach_predictions(pairs.select("row_id", "id", "correct_answer"), predicted)


PREDICTED_SQL = f"""{b.PAIRS_SQL}, predicted AS (SELECT *, {b.FIRST_SENTENCE_SQL.format("prompt")} AS predictions FROM pairs)"""


@query(
    "correctness_task",
    f"""WITH {PREDICTED_SQL} SELECT row_id, 'correct?:' || prompt || ' ' || predictions AS prompt, prompt AS prompt_old,
        CASE WHEN predictions = correct_answer THEN 'yes' ELSE 'no' END AS correct_answer,
        correct_answer AS correct_answer_board FROM predicted""",
)
def correctness_task(spark, sf_dir):
    rows = corpus.correctness_task(corpus.predict(b.pairs(spark, sf_dir), b.first_sentence))
    return rows.select("row_id", "prompt", "prompt_old", "correct_answer", "correct_answer_board")


@query(
    "fix_task",
    f"WITH {PREDICTED_SQL} SELECT row_id, 'fix:' || prompt AS prompt, predictions AS correct_answer FROM predicted",
)
def fix_task(spark, sf_dir):
    rows = corpus.fix_task(corpus.predict(b.pairs(spark, sf_dir), b.first_sentence))
    return rows.select("row_id", "prompt", "correct_answer")


CLASSES_SQL = """
    roots AS (SELECT *, split_part(split_part(path_data, '.', 1), '_', 1) AS root FROM pairs),
    numbered AS (SELECT *, (dense_rank() OVER (ORDER BY root) - 1)::VARCHAR AS id_int FROM roots),
    copies AS (SELECT row_id, 'solve' AS task, 'solve: ' || prompt AS prompt, correct_answer FROM numbered
               UNION ALL SELECT row_id, 'classify', 'classify: ' || prompt,
                                string_split(id, '/')[-2] || '/' || path_data || ' ' || id_int FROM numbered)"""


@query("classification_task", f"WITH {b.PAIRS_SQL}, {CLASSES_SQL} SELECT row_id, task, prompt, correct_answer FROM copies")
def classification_task(spark, sf_dir):
    return corpus.classification_task(b.pairs(spark, sf_dir)).select("row_id", "task", "prompt", "correct_answer")


@query(
    "augment_tasks",
    rf"""WITH {PREDICTED_SQL}, {CLASSES_SQL},
        sampled AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || row_id)) AS rn,
                                          count(*) OVER () AS n FROM predicted) WHERE rn <= round_even(n * 0.3::DOUBLE, 0)),
        grown AS (SELECT row_id, task, prompt, correct_answer FROM copies
                  UNION ALL SELECT row_id, 'correctness', 'correct?:' || prompt || ' ' || predictions,
                                   CASE WHEN predictions = correct_answer THEN 'yes' ELSE 'no' END FROM sampled
                  UNION ALL SELECT row_id, 'fix', 'fix:' || prompt, predictions FROM sampled),
        counted AS (SELECT *, len(regexp_extract_all(prompt, '\S+')) AS token_count,
                           len(regexp_extract_all(correct_answer, '\S+')) AS token_count_correct FROM grown)
        SELECT row_id, task, prompt, correct_answer, token_count, token_count_correct,
               row_number() OVER (ORDER BY md5('42:' || len(row_id::VARCHAR) || '_' || row_id || ':' || len(task) || '_' || task)) - 1 AS position
        FROM counted WHERE token_count <= 400 AND token_count_correct <= 50""",
)
def augment_tasks(spark, sf_dir):
    grown = corpus.augment(
        b.pairs(spark, sf_dir), 400, 50, b.first_sentence, correctness_ratio=0.3, fix_ratio=0.3, classification=True
    )
    return grown.select(
        "row_id", "task", "prompt", "correct_answer", "token_count", "token_count_correct", "position"
    )


# ----------------------------------------------------------------------- ROUGE

ROUGE_SQL = r"""
    words AS (SELECT *, list_filter(string_split(regexp_replace(lower({p}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '') AS p,
                     list_filter(string_split(regexp_replace(lower({y}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '') AS y
              FROM {source}),
    grams AS (SELECT {key}, 1 AS n, unnest(p) AS g, 1 AS a, 0 AS b FROM words
              UNION ALL SELECT {key}, 1, unnest(y), 0, 1 FROM words
              UNION ALL SELECT {key}, 2, unnest(list_transform(range(1, len(p)), lambda i: p[i] || ' ' || p[i + 1])), 1, 0 FROM words
              UNION ALL SELECT {key}, 2, unnest(list_transform(range(1, len(y)), lambda i: y[i] || ' ' || y[i + 1])), 0, 1 FROM words),
    per_gram AS (SELECT {key}, n, g, sum(a) AS a, sum(b) AS b FROM grams GROUP BY ALL),
    sums AS (SELECT {key}, n, sum(least(a, b)) AS o, sum(a) AS a, sum(b) AS b FROM per_gram GROUP BY {key}, n),
    f AS (SELECT {key}, n, CASE WHEN o > 0 THEN 2 * (o / a) * (o / b) / (o / a + o / b) ELSE 0.0::DOUBLE END AS f FROM sums),
    scored AS (SELECT k.{first}, {key_list} coalesce(f1.f, 0) AS rouge1, coalesce(f2.f, 0) AS rouge2 FROM {source} k
               LEFT JOIN f f1 ON {on1} AND f1.n = 1 LEFT JOIN f f2 ON {on2} AND f2.n = 2)"""

TURN_ROUGE_SQL = ROUGE_SQL.format(
    p="prompt", y="correct_answer", source="turns", key="conv_id, turn", first="conv_id", key_list="k.turn,",
    on1="f1.conv_id = k.conv_id AND f1.turn = k.turn", on2="f2.conv_id = k.conv_id AND f2.turn = k.turn",
)


def _scored(spark, sf_dir, kinds, stem):
    """Scores of the turns, found by a number that is written with them."""
    turns = materialize(b.turns(spark, sf_dir).withColumn("row", F.monotonically_increasing_id()), "turns")
    return turns.select("row", "conv_id", "turn").join(rouge(turns, "row", "prompt", "correct_answer", kinds, stem), "row")


@query(
    "rouge_rows",
    f"""WITH {b.TURNS_SQL}, {TURN_ROUGE_SQL}
        SELECT conv_id, turn, round(rouge1, 6) AS rouge1, round(rouge2, 6) AS rouge2 FROM scored""",
)
def rouge_rows(spark, sf_dir):
    scored = _scored(spark, sf_dir, ("rouge1", "rouge2"), False)
    return scored.select("conv_id", "turn", *[F.round(k, 6).alias(k) for k in ("rouge1", "rouge2")])


@query(
    "rouge_n",
    f"""WITH {b.TURNS_SQL}, {TURN_ROUGE_SQL}
        SELECT round(avg(rouge1) * 100, 4) AS rouge1, round(avg(rouge2) * 100, 4) AS rouge2 FROM scored""",
)
def rouge_n(spark, sf_dir):
    kinds = ("rouge1", "rouge2")
    turns = materialize(b.turns(spark, sf_dir).withColumn("row", F.monotonically_increasing_id()), "turns")
    return rouge(turns, "row", "prompt", "correct_answer", kinds, False).agg(*rouge_means(kinds))


LCS_SQL = rf"""
    WITH RECURSIVE {b.TURNS_SQL}, {TURN_ROUGE_SQL},
    steps AS (SELECT conv_id, turn, p, y, 0 AS i, list_transform(range(0, len(p) + 1), lambda j: 0) AS lengths FROM words
              UNION ALL
              SELECT conv_id, turn, p, y, i + 1, list_prepend(0, list_transform(range(1, len(p) + 1), lambda j: list_max(
                  list_transform(range(1, j + 1), lambda k: greatest(lengths[k + 1],
                                 CASE WHEN p[k] = y[i + 1] THEN lengths[k] + 1 ELSE 0 END)))))
              FROM steps WHERE i < len(y)),
    ends AS (SELECT conv_id, turn, lengths[len(p) + 1] AS l, len(p) AS n, len(y) AS m FROM steps WHERE i = len(y))
    SELECT conv_id, turn, round(CASE WHEN l > 0 THEN 2 * (l / n) * (l / m) / (l / n + l / m) ELSE 0.0::DOUBLE END, 6)
           AS "rougeL" FROM ends"""


@query("rouge_lcs", LCS_SQL)
def rouge_lcs(spark, sf_dir):
    scored = _scored(spark, sf_dir, ("rougeL",), False)
    return scored.select("conv_id", "turn", F.round("rougeL", 6).alias("rougeL"))


@query("rouge_l")
def rouge_l(spark, sf_dir):
    kinds = ("rouge1", "rouge2", "rougeL", "rougeLsum")
    lines = {c: tx.sentence_lines(tx.strip(c)) for c in ("prompt", "correct_answer")}
    turns = materialize(b.turns(spark, sf_dir).withColumns(lines).withColumn("row", F.monotonically_increasing_id()), "turns")
    return rouge(turns, "row", "prompt", "correct_answer", kinds, stem=True).agg(*rouge_means(kinds))


PAIR_ROUGE_SQL = ROUGE_SQL.format(
    p="predictions", y="correct_answer", source="predicted", key="row_id", first="row_id", key_list="",
    on1="f1.row_id = k.row_id", on2="f2.row_id = k.row_id",
)


@query(
    "evaluate_file",
    rf"""WITH {PREDICTED_SQL}, stripped AS (SELECT trim(predictions, E' \t\n\x0B\f\r') AS p, trim(correct_answer, E' \t\n\x0B\f\r') AS y FROM predicted),
        {PAIR_ROUGE_SQL}
        SELECT 'test_num_correct' AS metric, count(*) FILTER (p = y)::DOUBLE AS value FROM stripped
        UNION ALL SELECT 'test_num_total', count(*)::DOUBLE FROM stripped
        UNION ALL SELECT 'test_accuracy', round(count(*) FILTER (p = y) / count(*), 4) FROM stripped
        UNION ALL SELECT 'test_gen_len', round(avg(len(regexp_extract_all(p, '\S+'))), 4) FROM stripped
        UNION ALL SELECT 'test_rouge1', round(avg(rouge1) * 100, 4) FROM scored""",
)
def evaluate_file(spark, sf_dir):
    """Text pairs written as CSV by their columns, then evaluated from that file."""
    path = scratch_path(spark, "pairs") + ".csv"
    files.write_csv(b.pairs(spark, sf_dir), path)
    _, report = corpus.evaluate_file(spark, path, b.first_sentence, stem=False, scores=("rouge1",))
    return report


@query("evaluate_report")
def evaluate_report(spark, sf_dir):
    """All that the job reports: four stemmed scores, with sentences that know the corpus's abbreviations."""
    pairs = b.pairs(spark, sf_dir)
    abbreviations = sentences.learn_abbreviations(pairs, "prompt")
    _, report = corpus.evaluate(pairs, b.first_sentence, token_scores(spark, sf_dir), abbreviations=abbreviations)
    return report


@query(
    "evaluate_predictions",
    rf"""WITH {PREDICTED_SQL}, {PAIR_ROUGE_SQL},
        stripped AS (SELECT trim(predictions, E' \t\n\x0B\f\r') AS p, trim(correct_answer, E' \t\n\x0B\f\r') AS y FROM predicted),
        v AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS k FROM embeddings),
        t AS (SELECT vec_id, vec_id // 32 AS batch, label, ln(sum(exp(x))) - sum(x) FILTER (k = label) AS loss
              FROM v GROUP BY ALL),
        r AS (SELECT sum(CASE WHEN label = 0 THEN 0 ELSE loss END) / count(*) FILTER (label <> 0) AS loss FROM t GROUP BY batch)
        SELECT 'test_num_correct' AS metric, count(*) FILTER (p = y)::DOUBLE AS value FROM stripped
        UNION ALL SELECT 'test_num_total', count(*)::DOUBLE FROM stripped
        UNION ALL SELECT 'test_accuracy', round(count(*) FILTER (p = y) / count(*), 4) FROM stripped
        UNION ALL SELECT 'test_gen_len', round(avg(len(regexp_extract_all(p, '\S+'))), 4) FROM stripped
        UNION ALL SELECT 'test_rouge1', round(avg(rouge1) * 100, 4) FROM scored
        UNION ALL SELECT 'test_rouge2', round(avg(rouge2) * 100, 4) FROM scored
        UNION ALL SELECT 'test_loss', round(avg(loss), 4) FROM r""",
)
def evaluate_predictions(spark, sf_dir):
    """The part of the report that SQL can state: ROUGE-1 and 2 of words as they are."""
    _, report = corpus.evaluate(
        b.pairs(spark, sf_dir), b.first_sentence, token_scores(spark, sf_dir), stem=False, scores=("rouge1", "rouge2")
    )
    return report
