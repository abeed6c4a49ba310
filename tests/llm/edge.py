"""Documents with nulls, empty and long texts, copies and columns whose names clash."""

LONG = " ".join(f"word{i % 977} other{i % 31}" for i in range(20_000))
ROWS = [
    (1, "One small text about nothing at all in particular.", "en", "a", 5),
    (1, "One small text about nothing at all in particular.", "en", "a", 5),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, LONG, "en", "b", 1),
    (None, "No id here, but some words to read none the less.", "en", "b", 1),
    (6, " \t\n ", "en", "b", 1),
    (7, "漢字 かな 🙂 é́ ​", "ja", "b", 1),
]
#: Extra columns are named like the results of operators and their inner columns.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("id", "score", "ids", "label", "n", "token", "node", "class", "start", "end", "rank",
           "predicted", "mark", "component")


def documents(spark, rows=ROWS):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in CLASHES:
        df = df.withColumn(name, df.lang)
    return df


def plain(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
