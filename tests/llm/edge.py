"""Small tables with every case that an operator must bear."""

LONG = " ".join(f"word{i % 977} other{i}" for i in range(30_000))


def documents(spark, rows):
    """Rows of (doc_id, text) with columns that clash with names used inside."""
    rows = [(i, t, None, "src", n, "x", 1.5) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, c0 string, `k1.x` double")


def texts(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
