"""Generated quizzes: recovery of their JSON, validation, and rates of an evaluation."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUIZ = "struct<questions:array<struct<question:string,options:array<string>,correct_answer:string,shortcut_used:string>>>"


def recovered_json(raw: Column) -> Column:
    """The JSON of a reply: as it stands or in its first fence, else from the first { to the last }; null where neither parses."""
    text = F.trim(raw)
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1)
    plain = F.when(fenced != "", fenced).otherwise(text)
    inner = F.regexp_extract(plain, r"(?s)\{.*\}", 0)
    return F.coalesce(F.when(F.try_parse_json(plain).isNotNull(), plain), F.when((inner != "") & F.try_parse_json(inner).isNotNull(), inner))


def valid_quiz(quiz: Column) -> Column:
    """Every question is long enough, has four options, one of them the answer, and names its shortcut; no question is valid too."""
    ok = F.forall(
        quiz["questions"],
        lambda q: F.coalesce((F.length(q["question"]) >= 10) & (F.size(q["options"]) == 4) & F.array_contains(q["options"], q["correct_answer"]) & (F.length(q["shortcut_used"]) >= 5), F.lit(False)),
    )
    return F.coalesce(ok, F.lit(False))


def distinct_options(options: Column) -> Column:
    return F.size(F.array_distinct(options)) == F.size(options)


def ask(prompts: DataFrame, call: Callable[[str], str], column: str = "prompt", out: str = "reply") -> DataFrame:
    """Replies of a model behind `call`, one request a row; an error becomes a null reply and its message in `error`."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in prompts.schema)}, `{out}` string, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            replies, errors = [], []
            for p in batch[column]:
                try:
                    replies.append(call(p))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  a failed request is a record, not the end of the job
                    replies.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield batch.assign(**{out: replies, "error": errors})

    return prompts.mapInPandas(run, schema)


def evaluation_rates(records: DataFrame, by: str) -> DataFrame:
    """records (by, correct, grounded, distinct_options, lexical) -> rates; null where nothing was judged, lexical 0 then."""
    rate = lambda c: F.round(F.avg(F.col(c).cast("int")), 4)
    return records.groupBy(by).agg(
        F.count("*").alias("n"), rate("correct").alias("correct_rate"), rate("grounded").alias("grounded_rate"), rate("distinct_options").alias("distinct_rate"),
        F.round(F.coalesce(F.avg("lexical"), F.lit(0.0)), 4).alias("avg_lexical"),
    )


SYSTEM = "Write multiple-choice questions out of the excerpts alone. Answer with JSON: questions, each with question, four options, correct_answer, shortcut_used."
JUDGE = "Judge one question against its excerpts. Answer with JSON: answer_correct, shortcut_grounded, confidence, notes."
VERDICT = "answer_correct boolean, shortcut_grounded boolean, confidence double, notes string"


def request_fault(topic: Column, n: Column, k: Column) -> Column:
    """What is wrong with a request, null where nothing is: the bounds of `check_request` over columns."""
    size = F.length(F.trim(topic))
    return (
        F.when(~F.coalesce(size.between(2, 200), F.lit(False)), "topic")
        .when(~F.coalesce(n.between(1, 8), F.lit(False)), "n")
        .when(~F.coalesce(k.between(2, 12), F.lit(False)), "k")
    )


class Refused(Exception):
    """An answer of a provider that is no success."""

    def __init__(self, status: int, message: str = "") -> None:
        super().__init__(f"{status}: {message}")
        self.status, self.message = status, message


# Answers after which a request is worth repeating, how often, and how providers name the time to wait.
RETRYABLE, RETRIES, WAIT = frozenset({429, 500, 502, 503, 504}), 4, re.compile(r"try again in ([\d.]+)s", re.I)


def waiting_time(message: str, attempt: int) -> float:
    """Seconds before the next attempt: half a second more than the provider asks for, else doubled each time."""
    asked = WAIT.search(message)
    return float(asked[1]) + 0.5 if asked else float(2**attempt)


def retried(call: Callable[[str], str], retries: int = RETRIES, sleep: Callable[[float], None] = time.sleep) -> Callable[[str], str]:
    """`call`, repeated while the provider refuses with a status that may pass; the last refusal is raised."""

    def patient(prompt: str) -> str:
        for attempt in range(retries):
            try:
                return call(prompt)
            except Refused as e:
                if e.status not in RETRYABLE:
                    raise
                sleep(waiting_time(e.message, attempt))
        return call(prompt)

    return patient


def check_request(topic: str, n: int = 3, k: int = 6) -> None:
    """Refuse a request beyond its bounds."""
    if not 2 <= len(topic.strip()) <= 200:
        raise ValueError("topic must have 2 to 200 characters")
    if not 1 <= n <= 8:
        raise ValueError("n must be 1 to 8")
    if not 2 <= k <= 12:
        raise ValueError("k must be 2 to 12")


def quizzes(contexts: DataFrame, call: Callable[[str], str], topic: str = "topic", context: str = "context", n: int = 3) -> DataFrame:
    """contexts with quiz, valid and error: one request for each context; an empty one is an error without a request."""
    prompt = F.format_string(f"{SYSTEM}\n\nTopic: %s\nQuestions: {n}\n\nExcerpts:\n%s", topic, context)
    empty = F.coalesce(F.trim(F.col(context)) == "", F.lit(True))
    replied = ask(contexts.where(~empty).withColumn("prompt", prompt), call)
    told = replied.withColumn("quiz", F.from_json(recovered_json(F.col("reply")), QUIZ)).withColumn("valid", valid_quiz(F.col("quiz")))
    told = told.withColumn("error", F.coalesce("error", F.when(~F.col("valid"), "the reply is no valid quiz"))).drop("prompt", "reply")
    none = contexts.where(empty).select("*", F.lit("nothing was found").alias("error"), F.lit(None).cast(QUIZ).alias("quiz"), F.lit(False).alias("valid"))
    return told.unionByName(none)


def judged(generated: DataFrame, call: Callable[[str], str], context: str = "context") -> DataFrame:
    """One row for each question of the valid quizzes, with its lexical score, the judge's verdict (null where the judge
    failed) and `ok`: judged right and grounded."""
    from ..functions.text import grounding

    each = generated.where("valid").select(*[c for c in generated.columns if c not in ("quiz", "valid", "error")], F.explode("quiz.questions").alias("q"))
    rated = each.withColumns({"distinct_options": distinct_options(F.col("q.options")), "lexical": F.bround(grounding(F.col("q.shortcut_used"), F.col(context)), 2), "question": F.to_json("q")}).drop("q")
    asked = ask(rated.withColumn("prompt", F.concat(F.lit(JUDGE + "\n\nQuestion: "), F.col("question"), F.lit("\n\nExcerpts:\n"), F.col(context))), call)
    verdict = asked.withColumn("judge", F.from_json(recovered_json(F.col("reply")), VERDICT)).drop("prompt", "reply")
    return verdict.withColumn("ok", F.coalesce(F.col("judge.answer_correct") & F.col("judge.shortcut_grounded"), F.lit(False)))


def graded(answers: DataFrame, chosen: str = "chosen", right: str = "correct_answer") -> DataFrame:
    """Answers with whether the chosen option is the right one."""
    return answers.withColumn("is_right", F.coalesce(F.col(chosen) == F.col(right), F.lit(False)))
