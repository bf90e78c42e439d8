"""Chat-format records for supervised fine-tuning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import options as O
from ..functions import text as T

#: System message per task type; written for this library, to be replaced by the user's own.
SYSTEM = {
    "reasoning": "You solve financial questions step by step and state one final answer.",
    "mcq": "You answer multiple-choice questions on finance with one option letter.",
    "sentiment": "You label the sentiment of financial text for an investor.",
    "instruction": "You carry out the given financial task accurately and briefly.",
}
#: What the final answer of each kind of task consists of.
ANSWER_FORM = {"mcq": "A single option letter", "sentiment": "One label only"}


def _block(title: str, body: Column) -> Column:
    return F.when(body != "", F.concat(F.lit(f"{title}:\n"), body))


def user_message(source: Column, task_type: Column, question: Column, context: Column, options: Column, history: Column | None = None) -> Column:
    """Blocks by kind of task, joined by blank lines; empty blocks are left out."""
    kind, q, c, opts = F.lower(T.filled(task_type)), T.strip(question), T.strip(context), O.relabelled(options)
    talk = T.strip(history) if history is not None else F.lit("")

    def made(task: str, form: str, *blocks: Column) -> Column:
        ask = f"Return exactly this format:\n<reasoning>\n...\n</reasoning>\n<final_answer>\n{form}\n</final_answer>"
        return F.array_join(F.array_compact(F.array(F.lit(f"Task: {task}"), *blocks, F.lit(ask))), "\n\n")

    return (
        F.when(kind == "mcq", made("Choose the single best option.", ANSWER_FORM["mcq"], F.concat(F.lit("Question:\n"), q), _block("Options", opts), _block("Context", c)))
        .when(kind == "sentiment", made("Classify the sentiment of the financial text.", ANSWER_FORM["sentiment"], _block("Instruction", q), _block("Text", c), _block("Allowed labels", opts)))
        .when(talk != "", made("Solve the current turn of the dialogue.", "The final answer only", F.concat(F.lit("Current question:\n"), q), _block("Prior dialogue", talk), _block("Context", c)))
        .when(kind == "reasoning", made("Solve the financial reasoning problem.", "The final answer only", F.concat(F.lit("Question:\n"), q), _block("Context", c)))
        .otherwise(made("Follow the instruction.", "The final answer only", F.concat(F.lit("Instruction:\n"), q), _block("Additional context", c), _block("Options", opts)))
    )


def assistant_message(reasoning: Column, answer: Column) -> Column:
    return F.concat(F.lit("<reasoning>\n"), T.strip(reasoning), F.lit("\n</reasoning>\n<final_answer>\n"), T.strip(answer), F.lit("\n</final_answer>"))


def export(df: DataFrame, history: str | None = None) -> DataFrame:
    """(id, messages, source, task_type, task_domain, language); messages are system, user and assistant."""
    kind = F.lower(T.filled(F.col("task_type")))
    system = F.lit(SYSTEM["instruction"])
    for k, v in SYSTEM.items():
        system = F.when(kind == k, v).otherwise(system)
    user = user_message(F.col("source"), F.col("task_type"), F.col("question"), F.col("context"), F.col("options"), F.col(history) if history else None)
    say = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    messages = F.array(say("system", system), say("user", user), say("assistant", assistant_message(F.col("model_reasoning"), F.col("model_answer"))))
    return df.select("id", messages.alias("messages"), "source", "task_type", "task_domain", "language")
