"""Rows for fine-tuning and preference training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sft_text(kind: Column, question: Column, options: Column, reasoning: Column, answer: Column, options_style: str = "newline") -> Column:
    """The training text of an item; options one a line, or ('repr') as a quoted list."""
    listed = F.array_join(options, "\n") if options_style == "newline" else F.concat(F.lit("['"), F.array_join(options, "', '"), F.lit("']"))
    chosen = F.concat(F.lit("### 질문: "), question, F.lit("\n### 선택지:\n"), listed, F.lit("\n### 정답: "), reasoning, F.lit("### 정답: "), answer)
    return F.when(kind == "mcqa", chosen).otherwise(F.concat(F.lit("### 질문: "), question, F.lit("\n### 정답: "), answer))


def dpo_triples(df: DataFrame) -> DataFrame:
    return df.select(F.col("question").alias("prompt"), F.col("answer").alias("chosen"), F.col("old_answer").alias("rejected"))
