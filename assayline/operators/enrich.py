"""Text for each row from a generator the caller supplies."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STUB_NAME = "template"


def first_line(prompt: str) -> str:
    """Stand-in generator: answers with the first line of the input."""
    return prompt.split("\n", 1)[0].strip()


def with_text(df: DataFrame, prompt: str, out: str,
              generate: Callable[[str], str] = first_line, model: str = STUB_NAME,
              status: str = "generation_status", tasks: int | None = None) -> DataFrame:
    """Adds the generated text, the model name and 'success' or 'error'.

    A generator that raises marks its own row and leaves the job running. Only the
    prompt goes to Python, in Arrow batches. A report that was aggregated may sit in
    one partition; `tasks` spreads its rows before a slow generator sees them.
    """

    @F.pandas_udf("text string, state string")
    def run(prompts: pd.Series) -> pd.DataFrame:
        rows = []
        for p in prompts:
            try:
                rows.append((generate(p), "success"))
            except Exception as e:
                rows.append((f"[ERROR: {e}]", "error"))
        return pd.DataFrame(rows, columns=["text", "state"])

    # one call per row even though two fields are read, and no second call on reuse
    run = run.asNondeterministic()
    if tasks:
        df = df.repartition(tasks)
    return (
        df.withColumn("_made", run(F.col(prompt)))
        .withColumns({out: F.col("_made.text"), "model_name": F.lit(model),
                      status: F.col("_made.state")})
        .drop("_made"))


def stamped(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.current_timestamp())
