"""Small tables for the operator tests."""

CLASH = ["dotted.name", "_row", "label", "score", "fp", "key", "id", "hash", "size", "slot", "rank", "held_out", "copies", "part", "pos", "ids"]
DOC = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)


def docs(spark, rows):
    """Documents from (doc_id, text[, source]) with extra columns named like internal ones."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), *["x"] * len(CLASH)) for r in rows]
    return spark.createDataFrame(full, DOC)


ODD = [(1, "one two three four five"), (1, "one two three four five"), (2, None), (3, ""), (None, "lost words here"),
       (4, "  \n\t "), (5, "x" * 20000), (6, "word " * 30000), (7, "Ünïcode 日本 \U0001f600 ok")]
