"""Chat completion requests and responses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RESPONSE_SCHEMA = (
    "timings STRUCT<prompt_n: INT, predicted_n: INT, cache_n: INT,"
    " prompt_ms: DOUBLE, predicted_per_token_ms: DOUBLE>"
)
CONTENT_PATH = "$.choices[0].message.content"


def timings(body: Column) -> Column:
    return F.from_json(body, RESPONSE_SCHEMA)["timings"]


def time_to_first_token(timing: Column) -> Column:
    return timing["prompt_ms"] + timing["predicted_per_token_ms"]


def content(body: Column) -> Column:
    return F.get_json_object(body, CONTENT_PATH)


def request(prompt: Column, seed: Column | int = 0, max_tokens: int = 4096) -> Column:
    """One request with the prompt as its only message."""
    message = F.struct(F.lit("user").alias("role"), prompt.alias("content"))
    return F.to_json(
        F.struct(
            F.array(message).alias("messages"),
            (F.lit(seed) if isinstance(seed, int) else seed).alias("seed"),
            F.lit(max_tokens).alias("max_tokens"),
        )
    )
