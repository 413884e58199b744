"""Small document frames with awkward rows."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, lang="en", extra=()):
    rows = [(i, t, lang, "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, *extra], DOCS).repartition(3)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
