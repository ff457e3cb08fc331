from __future__ import annotations

from collections import Counter
from datetime import datetime


def bag(df, *columns):
    return Counter(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def one(spark, column, sql="SELECT 1"):
    return spark.sql(sql).select(column.alias("x")).first()["x"]


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df).split("Initial Plan")[0]


def largest_method(df) -> int:
    """Bytes of the longest method Spark generates for a query; the JVM does not compile those of over 8000."""
    debug = df.sparkSession._jvm.org.apache.spark.sql.execution.debug
    stages = debug.__getattr__("package$").__getattr__("MODULE$").codegenStringSeq(
        df._jdf.queryExecution().executedPlan()
    )
    return max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size()))
