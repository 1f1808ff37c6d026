"""Survey answers: latest per question, multi-select scoring, one wide row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rapport.functions import choices, choices_text
from rapport.labels import WIDE_ANSWERS, ScoreRules
from rapport.operators import latest_value, pivot_answers, split_join


def choice_score(choice: Column, rules: ScoreRules) -> Column:
    """Score of one option: the first rule whose text it contains, else null."""
    return F.coalesce(*[F.when(choice.contains(text), score) for text, score in rules.scores])


def score_answers(answers: DataFrame, rules: ScoreRules) -> DataFrame:
    """Distinct multi-select texts with the rounded-up mean score of their options.

    Options naming ``rules.ignored`` do not count; a text made of nothing else
    has no row. Each distinct text is parsed once.
    """
    texts = answers.where(F.col("name_short") == rules.scored_name).select("response_value").distinct()
    picked = texts.select("response_value", F.explode(choices(F.col("response_value"))).alias("choice"))
    picked = picked.where(~F.col("choice").contains(rules.ignored))
    score = F.avg(choice_score(F.col("choice"), rules))
    return picked.groupBy("response_value").agg(F.ceil(score).cast("bigint").alias("response_numeric"))


def latest_raw_answers(responses: DataFrame, survey_defs: DataFrame) -> DataFrame:
    """Latest answer text per person and question; ties give the smallest text.

    Answers are reduced before they meet the question names: joined first, they
    would stay clustered by question, and one question may hold most answers.
    """
    answered = responses.where("response_value IS NOT NULL")
    latest = latest_value(answered, ["reach_id", "question_id"], "canvass_timestamp", "response_value", "min")
    return split_join(latest, survey_defs.select("question_id", "name_short"), "question_id")


def latest_answers(responses: DataFrame, survey_defs: DataFrame, rules: ScoreRules) -> DataFrame:
    """Latest answers with readable multi-select text and their score.

    The score joins on the raw text, so an equal text given to another question
    carries it too.
    """
    latest = latest_raw_answers(responses, survey_defs)
    raw = F.col("response_value")
    shown = F.when(F.col("name_short").isin(*rules.multi_select), choices_text(raw)).otherwise(raw)
    return split_join(latest, score_answers(latest, rules), "response_value", "left").select(
        F.to_date("canvass_timestamp").alias("canvass_date"),
        "canvass_timestamp",
        "reach_id",
        "question_id",
        "name_short",
        shown.alias("response_value"),
        "response_numeric",
    )


def wide_answers(answers: DataFrame, columns: dict[str, tuple[str, str]] = WIDE_ANSWERS) -> DataFrame:
    """One row per person with a column per question."""
    return pivot_answers(answers, "reach_id", "name_short", columns)
