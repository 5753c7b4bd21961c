"""Row-local operators called from SQL give what their DataFrame forms give, without Python."""

from pyspark.sql import functions as F

from gristmill.functions import sql as sql_surface

TEXTS = [None, "", "  Hello <b>World</b> \t", "my name is Anna B, mail a@b.org, call 555-123-4567",
         "Dr. Mary Stone wrote www.example.org/x", "Hi! Welcome to the site.\xa0 Doctor says rest", "x" * 20_000]


def test_functions_equal_their_columns(spark):
    names = sql_surface.register_functions(spark)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "row_id long, text string")
    df.createOrReplaceTempView("gm_texts")
    calls = ", ".join(f"{n}(text) AS {n}" for n in names)
    got = spark.sql(f"SELECT row_id, {calls} FROM gm_texts")
    want = df.select("row_id", *[f(F.col("text")).alias(n) for n, f in sql_surface.ROW_LOCAL.items()])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
