"""Checking concepts with a model: prompt, answer, score."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.prompts import build_prompt, parse_response
from scriptorium.functions.text import mention_count
from scriptorium.operators.embed import verify


def verify_scenes(scenes: DataFrame, text: str, candidates: str, make_model: Callable[[], Callable[[list[str]], list[str]]],
                  **prompt) -> DataFrame:
    """Add ``confirmed`` (concepts the model names), ``score`` and ``error`` to every scene.

    The whole scene goes into the prompt. The score is the number of confirmed concepts that the scene mentions; 0 where the model fails, or its
    answer is empty or unreadable.
    """
    asked = scenes.withColumn("_prompt", build_prompt(F.col(text), F.col(candidates), **prompt))
    answered = verify(asked, "_prompt", make_model, "_answer", "error")
    confirmed = F.coalesce(parse_response(F.col("_answer"))["tropes"], F.array().cast("array<string>"))
    return answered.withColumn("confirmed", confirmed).withColumn("score", mention_count(F.col(text), F.col("confirmed"))).drop("_prompt", "_answer")
