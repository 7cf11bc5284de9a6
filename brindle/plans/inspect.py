"""Plan inspection."""

from __future__ import annotations

import io
from collections.abc import Iterator
from contextlib import contextmanager, redirect_stdout

from pyspark.sql import DataFrame, SparkSession

MODES = ("simple", "extended", "codegen", "cost", "formatted")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``DataFrame.explain`` prints."""
    if mode not in MODES:
        raise ValueError(f"unknown explain mode {mode!r}; expected one of {MODES}")
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()


def executed_plan(df: DataFrame) -> str:
    """Run the query, then return its plan as adaptive execution left it.

    The rows are counted where they are; only the count reaches the driver.
    """
    df._jdf.queryExecution().toRdd().count()
    return plan_text(df, "simple")


@contextmanager
def scoped_conf(spark: SparkSession, **settings: str) -> Iterator[SparkSession]:
    """Set SQL settings (``__`` stands for ``.``) and put the old values back."""
    wanted = {key.replace("__", "."): value for key, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
