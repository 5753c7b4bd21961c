"""The library reachable from SQL: row-local operators as session functions, table operators as views.

A row-local operator is a Column expression; its analyzed form is written out
as SQL and registered as a temporary SQL function of the session
(``CREATE TEMPORARY FUNCTION name(text STRING) RETURNS <type> RETURN <expr>``),
so ``spark.sql`` runs exactly the expression the DataFrame form runs, inside
whole-stage code generation, with no Python at run time. Table operators are
registered as temporary views of their results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import personal, text

ROW_LOCAL: dict[str, Callable[[Column], Column]] = {
    "gm_clean_text": text.clean_text,
    "gm_word_count": text.word_count,
    "gm_has_email": personal.has_email,
    "gm_has_url": personal.has_url,
    "gm_has_phone": personal.has_phone,
    "gm_has_stated_name": personal.has_stated_name,
    "gm_has_signature": personal.has_signature,
    "gm_redact_reply": personal.redact_reply,
    "gm_mask_stated_name": personal.mask_stated_name,
    "gm_drop_greeting": personal.drop_greeting,
}


def expression_sql(spark: SparkSession, expr: Callable[[Column], Column]) -> tuple[str, str]:
    """(SQL text, result type) of ``expr`` applied to a STRING column named ``text``."""
    plan = spark.createDataFrame([], "text string").select(expr(F.col("text")).alias("out"))
    analyzed = plan._jdf.queryExecution().analyzed()
    return analyzed.projectList().apply(0).child().sql(), plan.schema["out"].dataType.simpleString().upper()


def register_functions(spark: SparkSession) -> list[str]:
    """Registers every function of ``ROW_LOCAL`` in the session; returns their names."""
    for name, expr in ROW_LOCAL.items():
        body, kind = expression_sql(spark, expr)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS {kind} RETURN {body}")
    return list(ROW_LOCAL)


def register_views(spark: SparkSession, views: dict[str, DataFrame]) -> list[str]:
    """Each DataFrame as a temporary view of that name (the result of a table operator, or an input)."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
