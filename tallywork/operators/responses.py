"""From prompts to requests, and from responses to measurement rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions import chat_json, names


def build_requests(prompts: DataFrame, seed: int = 0, max_tokens: int = 4096) -> DataFrame:
    """The prompts with the JSON body that asks for a response to each."""
    return prompts.withColumn("request", chat_json.request(F.col("text"), seed, max_tokens))


def response_timings(responses: DataFrame, body: str = "body") -> DataFrame:
    """Token counts, time to the first token and time per token in place of the JSON body."""
    timing = F.col("_timing")
    parsed = responses.withColumn("_timing", chat_json.timings(F.col(body)))
    return parsed.select(
        *[c for c in responses.columns if c != body],
        timing["prompt_n"].alias("prompt_n"),
        timing["predicted_n"].alias("predicted_n"),
        timing["cache_n"].alias("cache_n"),
        chat_json.time_to_first_token(timing).alias("ttft"),
        timing["predicted_per_token_ms"].alias("tpot"),
    )


def response_content(responses: DataFrame, body: str = "body") -> DataFrame:
    """The text of the first choice in place of the JSON body."""
    return responses.withColumn("content", chat_json.content(F.col(body))).drop(body)


def with_model_parts(files: DataFrame, path: str = "model_file") -> DataFrame:
    """Add the model and quantization that a model file is named after."""
    return files.select(
        "*",
        names.model_name(F.col(path)).alias("model"),
        names.quantization(F.col(path)).alias("quantization"),
    )
