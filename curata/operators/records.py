"""Training records from trajectories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def assistant_text() -> Column:
    """The response, behind the reasoning in think marks if there is any. Null where the response is."""
    response = T.strip(F.col("response"))
    return F.when(T.is_blank(F.col("reasoning")), response).otherwise(F.concat(F.lit("<think>\n"), T.strip(F.col("reasoning")), F.lit("\n</think>\n\n"), response))


def alpaca(trajectory: DataFrame) -> DataFrame:
    """traj_id, prompt, response, system; rows without a response are left out."""
    return trajectory.where("response is not null").select("traj_id", F.col("prompt"), assistant_text().alias("response"), "system")


def turn(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def messages() -> Column:
    """System turn if there is one, the task prompt in place of a repair wrapper, the assistant's turn."""
    user = F.coalesce(T.some(F.col("metadata.prompt_meta.prompt"), F.col("prompt")), F.lit(""))
    return F.array_compact(F.array(F.when(F.col("system") != "", turn("system", F.col("system"))), turn("user", user), turn("assistant", assistant_text())))


def message_records(trajectory: DataFrame) -> DataFrame:
    """traj_id, messages of the rows that can be exported."""
    return trajectory.where("response is not null and coalesce(sparkproof_validation.passed, true)").select("traj_id", messages().alias("messages"))


def few_shot(examples: list[tuple[str, str]], question: Column) -> Column:
    """The examples, then the open question."""
    head = "".join(f"Question: {q}\nAnswer: {a}\n" for q, a in examples)
    return F.concat(F.lit(head + "Question: "), question, F.lit("\nAnswer:"))


def benchmark_prompt(prompt: Column, input_code: Column, constraints: Column) -> Column:
    """A benchmark's prompt with its input code in a python block and its constraints, where it has them."""
    code = F.when(input_code != "", F.concat(F.lit("\n\n```python\n"), input_code, F.lit("\n```")))
    more = F.when(constraints != "", F.concat(F.lit("\n\nConstraints: "), constraints))
    return F.concat(F.coalesce(prompt, F.lit("")), F.coalesce(code, F.lit("")), F.coalesce(more, F.lit("")))


def exported(rows: DataFrame) -> DataFrame:
    """traj_id, line: the messages of a row, and its metadata if it has any, as a line of JSON. Rows without messages are left out."""
    from ..sources.files import json_line

    has = F.col("messages").isNotNull() & (F.size("messages") > 0)
    with_both, alone = json_line(F.struct("messages", "metadata")), json_line(F.struct("messages"))
    return rows.where(has).select("traj_id", F.when(F.col("metadata").isNotNull(), with_both).otherwise(alone).alias("line"))


def episode_messages() -> Column:
    """Messages of a multi-turn episode (metadata.episode: system, turns of role and content), where a row has one; else those of a single turn."""
    turns = F.transform("metadata.episode.turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    system = F.array_compact(F.array(F.when(F.col("metadata.episode.system") != "", turn("system", F.col("metadata.episode.system")))))
    return F.when(F.size("metadata.episode.turns") > 0, F.concat(system, turns)).otherwise(messages())
