"""Classification requests and answers, and the hook for the model itself.

The model is the only place where Python runs inside a task: a batch function
given by the caller. Its answers are written to a table and read back, so that
no later failure or second action asks the model again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.answers import (
    ANSWER_FIELDS,
    ANSWER_LINES,
    NO_RESPONSE,
    classification_prompt,
    last_line,
    outside_types,
    provider_named,
    reason_given,
    types_named,
)

Model = Callable[[list[str]], list[str | None]]
ANSWER_SCHEMA = "request_hash string, response string, error string"
#: Of a write: 2 moves the file of a task into place when the task ends.
COMMIT_BY_TASK = "mapreduce.fileoutputcommitter.algorithm.version"


def class_requests(df: DataFrame, content: str = "context") -> DataFrame:
    """Add the classification prompt for `(project_url, context, valid_types)`."""
    prompt = classification_prompt(F.col("project_url"), F.col(content), F.col("valid_types"))
    return df.withColumn("prompt", prompt)


def parse_answers(df: DataFrame, col: str = "response", default: str = NO_RESPONSE) -> DataFrame:
    """Add the four answer fields; a field without its line is Unknown.

    Without an answer all are Unknown, with the reason in both reason fields:
    the text in a column `error` if there is one, else the default.
    """
    kept = [c for c in df.columns if c not in ANSWER_FIELDS]
    # The four lines are columns of their own, so that each is looked for once.
    lines = {f"_l{i}": last_line(F.col(col), prefix) for i, prefix in enumerate(ANSWER_LINES)}
    values = (
        types_named(F.col("_l0")),
        reason_given(F.col("_l1"), ANSWER_LINES[1]),
        provider_named(F.col("_l2")),
        reason_given(F.col("_l3"), ANSWER_LINES[3]),
    )
    why = F.lit(default)
    if "error" in df.columns:
        why = F.coalesce("error", why)
    failed = F.coalesce(F.col(col), F.lit("")) == ""
    unanswered = (F.lit("Unknown"), F.substring(why, 1, 100)) * 2
    return df.withColumns(lines).select(
        *kept,
        *[
            F.when(failed, instead).otherwise(value).alias(name)
            for name, value, instead in zip(ANSWER_FIELDS, values, unanswered)
        ],
    )


def flag_outside_types(df: DataFrame) -> DataFrame:
    flag = outside_types(F.col("deployment_type"), F.col("valid_types"))
    return df.withColumn("outside_valid_types", flag)


def with_request_hash(df: DataFrame, prompt: str = "prompt") -> DataFrame:
    return df.withColumn("request_hash", F.sha2(F.col(prompt), 256))


def _asking(model: Model) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Answers to batches of prompts. A failing batch is tried prompt by prompt, so one bad prompt costs only its own answer."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prompts = batch["prompt"].tolist()
            try:
                answers, errors = list(model(prompts)), [None] * len(prompts)
            except Exception:
                answers, errors = [], []
                for prompt in prompts:
                    try:
                        answers.append(model([prompt])[0])
                        errors.append(None)
                    except Exception as failure:
                        answers.append(None)
                        errors.append(str(failure)[:100])
            yield pd.DataFrame(
                {"request_hash": batch["request_hash"], "response": answers, "error": errors}
            )

    return ask


def _distinct_prompts(requests: DataFrame) -> DataFrame:
    hashed = requests if "request_hash" in requests.columns else with_request_hash(requests)
    return hashed.groupBy("request_hash").agg(F.first("prompt").alias("prompt"))


def infer(requests: DataFrame, model: Model, partitions: int | None = None) -> DataFrame:
    """Ask the model once per distinct prompt: `(request_hash, response, error)`.

    Prompts are made distinct first, so a prompt shared by many rows is one call. Nothing is kept:
    an action asks anew, and a lost task asks its prompts again. `stored_answers` keeps answers.
    """
    distinct = _distinct_prompts(requests)
    dealt = distinct if partitions is None else distinct.repartition(partitions, "request_hash")
    return dealt.mapInPandas(_asking(model), ANSWER_SCHEMA)


def ask_in_slices(
    requests: DataFrame, model: Model, path: str, max_parallel: int = 8, slice_size: int = 64
) -> int:
    """Append the answers to distinct prompts to the table at `path`, in slices; the number of prompts asked.

    A slice of about `slice_size` prompts is one call, one task and one file, which is committed when that
    task ends, not when its job does: whatever fails later, what was answered stays. So the files
    are the log of finished slices, keyed by the hash of the prompt. Waves of `max_parallel` slices
    bound the calls at a time, however many slices there are. The prompts to ask are written
    once, by wave, beside the answers (`_asked-*`, hidden from readers), so a wave reads its own alone.
    """
    spark = requests.sparkSession
    folder = path.rstrip("/")
    asked = f"{folder}/_asked-{uuid.uuid4().hex}"
    # Slices by hash: their number follows from a count of hashes, which carries no prompt.
    distinct = _distinct_prompts(requests)
    n = distinct.select("request_hash").count()
    if not n:
        return 0
    slices = -(-n // slice_size)
    number = F.pmod(F.xxhash64("request_hash"), F.lit(slices))
    places = {
        "wave": F.floor(number / max_parallel).cast("int"),
        "slot": (number % max_parallel).cast("int"),
    }
    distinct.withColumns(places).repartition("wave").write.partitionBy("wave").parquet(asked)
    prompts = spark.read.schema("request_hash string, prompt string, slot int, wave int").parquet(asked)
    for wave in range(-(-slices // max_parallel)):
        mine = prompts.where(F.col("wave") == wave).repartitionById(max_parallel, F.col("slot"))
        answered = mine.select("request_hash", "prompt").mapInPandas(_asking(model), ANSWER_SCHEMA)
        answered.write.mode("append").option(COMMIT_BY_TASK, "2").parquet(folder)
    return n


def stored_answers(
    requests: DataFrame, model: Model, path: str, max_parallel: int = 8, slice_size: int = 64
) -> DataFrame:
    """Answers to all requests, from the table at `path`; only prompts that no finished slice holds are asked.

    New answers are kept before anything uses them. A prompt without an answer keeps its error and is
    asked again by the next run.
    """
    spark = requests.sparkSession
    hashed = with_request_hash(requests)
    known = _read_answers(spark, path)
    new = hashed.select("request_hash", "prompt")
    if known is not None:
        new = new.join(known.where("response IS NOT NULL"), "request_hash", "left_anti")
    ask_in_slices(new, model, path, max_parallel, slice_size)
    stored = _read_answers(spark, path)
    if stored is None:  # nothing was ever asked
        stored = spark.createDataFrame([], ANSWER_SCHEMA)
    return hashed.join(stored, "request_hash", "left").drop("request_hash")


def _read_answers(spark, path: str) -> DataFrame | None:
    reader = spark.read.schema(ANSWER_SCHEMA)
    try:
        # By file names: Spark takes two reads of one folder for the same data and would
        # reuse the older one, without the files appended in between.
        table = reader.parquet(f"{path.rstrip('/')}/*.parquet")
    except Exception as failure:
        if "PATH_NOT_FOUND" in str(failure):
            return None
        raise
    # A prompt may have been asked by several runs: one answer counts, else one error.
    return table.groupBy("request_hash").agg(
        F.max("response").alias("response"), F.max("error").alias("error")
    )
