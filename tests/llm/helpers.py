"""Small tables with the awkward rows every operator must survive."""

from pyspark.sql import functions as F

DOC = "doc_id long, text string, lang string, source string, n_chars long"

AWKWARD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n\x0b ", "en", "a", 5),
    (None, "alpha beta gamma delta", None, "b", 22),
    (5, "one two three four five six seven eight nine ten", "en", None, 48),
    (5, "one two three four five six seven eight nine ten", "en", None, 48),
    (6, "é ü\nΩ \U0001F600 end", "fr", "", None),
    (7, "w " * 30000, "en", "a", 60000),
]


def docs(spark, rows=AWKWARD):
    return spark.createDataFrame(rows, DOC).repartition(3)


def clash(df, *names):
    """Extra columns whose names an operator may use inside."""
    for n in names:
        df = df.withColumn(n, F.lit("x"))
    return df
