"""Text-pair corpora: column choice, added tasks, token limits, evaluation."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenlake.functions.rouge import KINDS, SUBSEQUENCES, rouge, rouge_means
from screenlake.functions.text import as_text, file_root, parent_dir, sentence_lines, strip, token_count, with_prefix
from screenlake.operators import index, metrics
from screenlake.operators.sentences import sentence_lines as split_sentences
from screenlake.session import materialize
from screenlake.sources import files

Predictor = Callable[[Column], Column]

# Text and summary columns of public data sets, by data set name.
DATASET_COLUMNS = {
    "amazon_reviews_multi": ("review_body", "review_title"),
    "big_patent": ("description", "abstract"),
    "cnn_dailymail": ("article", "highlights"),
    "orange_sum": ("text", "summary"),
    "pn_summary": ("article", "summary"),
    "psc": ("extract_text", "summary_text"),
    "samsum": ("dialogue", "summary"),
    "thaisum": ("body", "summary"),
    "xglue": ("news_body", "news_title"),
    "xsum": ("document", "summary"),
    "wiki_summary": ("article", "highlights"),
}

# What each task puts in front of its prompt.
SOLVE, CLASSIFY, CORRECT, FIX = "solve: ", "classify: ", "correct?:", "fix:"

# Fixed value: a table whose name holds this mark has its tasks already.
AUGMENTED_MARK = "additional_tasks"


def resolve_columns(
    df: DataFrame,
    text_column: str | None = None,
    summary_column: str | None = None,
    dataset: str | None = None,
    known: Mapping[str, tuple[str, str]] = DATASET_COLUMNS,
) -> DataFrame:
    """``text, summary``: the named columns, else the data set's own, else the first two."""
    usual = known.get(dataset) if dataset else None
    chosen = []
    for place, given in enumerate((text_column, summary_column)):
        if given is not None and given not in df.columns:
            raise ValueError(f"column '{given}' needs to be one of: {', '.join(df.columns)}")
        chosen.append(given or (usual or df.columns)[place])
    return df.select(F.col(chosen[0]).alias("text"), F.col(chosen[1]).alias("summary"))


def prefix_text(df: DataFrame, column: str, prefix: str | None) -> DataFrame:
    return df.withColumn(column, with_prefix(column, prefix))


# ----------------------------------------------------------------- predictions


def batch_predictor(make_fn, batch_size: int, return_type: T.DataType | None = None) -> Predictor:
    """Column function around a model loaded once per Python worker.

    ``make_fn()`` returns a function from a numpy batch to a numpy batch; Spark
    cuts each partition into batches of at most ``batch_size`` rows.
    """
    return predict_batch_udf(make_fn, return_type=return_type or T.StringType(), batch_size=batch_size)


def map_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """A user function over Arrow batches: ``fn(iterator of pandas frames)`` yields frames of ``schema``."""
    return df.mapInPandas(fn, schema)


def predict(df: DataFrame, predictor: Predictor, prompt: str = "prompt", out: str = "predictions") -> DataFrame:
    return df.withColumn(out, predictor(F.col(prompt)))


def attach_predictions(df: DataFrame, predictions: DataFrame, key: str = "row_id") -> DataFrame:
    """Predictions joined to their source rows by key."""
    return df.join(predictions, key)


# ----------------------------------------------------------------------- tasks


def correctness_task(predicted: DataFrame) -> DataFrame:
    """"Is this answer right?" rows; the old prompt and answer stay in columns of their own."""
    right = F.col("predictions") == F.col("correct_answer_board")
    kept = predicted.withColumns({"prompt_old": F.col("prompt"), "correct_answer_board": F.col("correct_answer")})
    return kept.withColumns(
        {
            "prompt": F.concat(F.lit(CORRECT), "prompt_old", F.lit(" "), "predictions"),
            "correct_answer": F.when(right, "yes").otherwise("no"),
        }
    )


def fix_task(predicted: DataFrame, keep_old: bool = False) -> DataFrame:
    """"Fix this" rows. The target is the prediction itself and the prompt does not show it, by definition."""
    kept = predicted
    if keep_old:
        kept = kept.withColumns({"prompt_old": F.col("prompt"), "correct_answer_board": F.col("correct_answer")})
    return kept.withColumns({"prompt": F.concat(F.lit(FIX), "prompt"), "correct_answer": F.col("predictions")})


def classification_task(df: DataFrame, nan_text: bool = False) -> DataFrame:
    """Every row twice: a "solve" copy with its answer, and a "classify" copy whose target is its class.

    The class is parent folder / path, a space and the number of the file
    root. One scan makes both copies. ``nan_text`` writes a missing prompt as ``nan``.
    """
    rooted = df.withColumn("id_root_file", file_root("path_data"))
    numbered = index.group_number(rooted, "id_root_file", "id_int")
    copies = numbered.withColumn("task", F.explode(F.array(F.lit("solve"), F.lit("classify"))))
    second = F.col("task") == "classify"
    prompt = as_text("prompt") if nan_text else F.col("prompt")
    target = F.concat(parent_dir("id"), F.lit("/"), "path_data", F.lit(" "), "id_int")
    return copies.withColumns(
        {
            "prompt": F.concat(F.when(second, CLASSIFY).otherwise(SOLVE), prompt),
            "correct_answer": F.when(second, target).otherwise(F.col("correct_answer")),
        }
    )


def add_tasks(
    df: DataFrame,
    predictor: Predictor | None = None,
    correctness_ratio: float = 0.0,
    fix_ratio: float = 0.0,
    classification: bool = False,
    key: str = "row_id",
    seed: str | int = 42,
    name: str = "",
) -> DataFrame:
    """Base rows plus the wanted tasks, told apart by ``task``.

    The correctness and fix tasks share the correctness sample when both are
    on. Predictions are written, so the model runs once however often the
    result is read.
    Samples are drawn before the classification copies change the prompts.
    """
    if AUGMENTED_MARK in name:
        return df if "task" in df.columns else df.withColumn("task", F.lit("base"))
    added = []
    ratio = correctness_ratio or fix_ratio
    if ratio > 0:
        if predictor is None:
            raise ValueError("the correctness and fix tasks need a predictor")
        sampled = materialize(predict(index.sample_fraction(df, [key], ratio, seed), predictor), "predicted")
        if correctness_ratio > 0:
            added.append(correctness_task(sampled).withColumn("task", F.lit("correctness")))
        if fix_ratio > 0:
            added.append(fix_task(sampled, keep_old=correctness_ratio > 0).withColumn("task", F.lit("fix")))
    base = classification_task(df) if classification else df.withColumn("task", F.lit("base"))
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), added, base)


def count_tokens(df: DataFrame, end_marker: bool = False) -> DataFrame:
    """Adds ``token_count`` of the prompt and ``token_count_correct`` of the answer."""
    return df.withColumns(
        {
            "token_count": token_count("prompt", end_marker),
            "token_count_correct": token_count("correct_answer", end_marker),
        }
    )


def limit_tokens(df: DataFrame, max_input: int, max_output: int) -> DataFrame:
    """Rows with both counts at or under their limit; a missing text counts as 0 tokens."""
    count = lambda column: F.coalesce(F.col(column), F.lit(0))
    return df.filter((count("token_count") <= max_input) & (count("token_count_correct") <= max_output))


def augment(
    df: DataFrame,
    max_input: int,
    max_output: int,
    predictor: Predictor | None = None,
    correctness_ratio: float = 0.0,
    fix_ratio: float = 0.0,
    classification: bool = False,
    filter_tokens: bool = True,
    shuffle: bool = True,
    key: str = "row_id",
    seed: str | int = 42,
    name: str = "",
    write_to: str | None = None,
) -> DataFrame:
    """Adds tasks, writes them when asked, drops long rows, and orders the rest by seed (``position``).

    Rows beyond a limit go before anything is written. What is kept is written
    once, with its counts and a row number. The order works on the narrow
    columns, and each row's text joins it by that number, so repeated and
    missing keys do no harm.
    """
    grown = add_tasks(df, predictor, correctness_ratio, fix_ratio, classification, key, seed, name)
    if write_to and AUGMENTED_MARK not in name and (correctness_ratio or fix_ratio or classification):
        files.write_csv(grown, write_to)
    row = [key, "task"]
    if not filter_tokens:
        return index.permute(grown, row, seed) if shuffle else grown
    limited = limit_tokens(count_tokens(grown), max_input, max_output)
    kept = materialize(limited.withColumn("_row", F.monotonically_increasing_id()), "grown")
    if not shuffle:
        return kept.drop("_row")
    order = index.permute(kept.select("_row", *row), row, seed).select("_row", "position")
    return kept.join(order, "_row").drop("_row")


# ------------------------------------------------------------------ evaluation


def evaluate(
    df: DataFrame,
    predictor: Predictor | None = None,
    token_scores: DataFrame | None = None,
    prompt: str = "prompt",
    answer: str = "correct_answer",
    stem: bool = True,
    prefix: str = "test_",
    scores: tuple[str, ...] = KINDS,
    abbreviations: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(rows with predictions and correct, metric/value table)``.

    Accuracy, ROUGE, mean length and, where token scores are given, the mean of the batch losses. Rows and predictions
    are written once, numbered; without a predictor the rows must bring their ``predictions``. Sentences for
    ROUGE-Lsum end at marks, and not behind ``abbreviations`` where a table of them is given.
    """
    predicted = df if predictor is None else predict(df, predictor, prompt)
    marked = metrics.mark_exact(predicted, "predictions", answer)
    numbered = materialize(marked.withColumn("_row", F.monotonically_increasing_id()), "predicted")
    sides = ["_p", "_y"]
    texts = numbered.select("_row", strip("predictions").alias("_p"), strip(answer).alias("_y"))
    for side in sides:
        texts = texts.withColumn(side, sentence_lines(side)) if abbreviations is None else split_sentences(texts, abbreviations, side)
    hit = F.count_if("correct")
    summary = numbered.agg(
        hit.alias("num_correct"),
        F.count("*").alias("num_total"),
        F.try_divide(hit, F.count("*")).alias("accuracy"),
        F.avg(token_count("predictions")).alias("gen_len"),
    )
    report = metrics.prefixed(summary, prefix, digits=4)
    for kinds in ([k for k in scores if k not in SUBSEQUENCES], [k for k in scores if k in SUBSEQUENCES]):
        if kinds:
            means = rouge(texts, "_row", *sides, tuple(kinds), stem).agg(*rouge_means(tuple(kinds)))
            report = report.unionByName(metrics.prefixed(means, prefix, digits=4))
    if token_scores is not None:
        loss = metrics.mean_of_batch_ratios(token_scores, "logits", "label", "mask")
        report = report.unionByName(metrics.prefixed(loss, prefix, digits=4))
    return numbered.drop("_row"), report


def evaluate_file(
    spark: SparkSession, path: str, predictor: Predictor, folder: str = "", **options
) -> tuple[DataFrame, DataFrame]:
    """The same for a CSV file of text pairs."""
    return evaluate(files.read_csv(spark, path, files.PAIR_SCHEMA, folder), predictor, **options)


def evaluate_frame(spark: SparkSession, frame, predictor: Predictor, **options) -> tuple[DataFrame, DataFrame]:
    """The same for a pandas frame in memory."""
    return evaluate(spark.createDataFrame(frame), predictor, **options)


def write_evaluation(
    marked: DataFrame, report: DataFrame, test_file: str, output_dir: str, epoch: int, overwrite: bool = False
) -> str:
    """Writes the rows as CSV, named by epoch and number of right answers, and the metrics as JSON."""
    right = marked.filter("correct").count()
    target = files.results_name(test_file, output_dir, epoch, right)
    files.write_csv(marked, target, overwrite)
    files.write_metrics(report, f"{output_dir.rstrip('/')}/test_results.json", overwrite)
    return target
