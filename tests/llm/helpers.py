"""Tables with the awkward cases every operator must take: nulls, empty and long texts, ties, repeats, extra columns."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, rk string, target int"


def docs(spark, extra=()):
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    base = [
        (1, "a b c d e f g h", "en", "s1"),
        (1, "a b c d e f g h", "en", "s1"),
        (2, None, "en", "s1"),
        (3, "", None, None),
        (4, " \t\n\x0b ", "en", "s2"),
        (5, long, "en", "s1"),
        (6, long, "en", "s2"),
        (7, "Ä ö  x\ny\rz <|endoftext|> é", "de", None),
        (None, "no id here", "en", "s1"),
        (8, "x", None, "s1"),
        (9, "x y", "en", "s1"),
        (10, "X  Y", "en", "s1"),
        *extra,
    ]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), 7, "clash", 1) for r in base], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows=((1, 1, 0), (5, 0, 1), (5, 0, 1), (8, None, None), (None, 1, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
