"""Small awkward tables shared by the operator tests."""

AWKWARD = [
    (7, "The quick brown fox jumps over the lazy dog. You are an idiot, really.\nSecond line here.", "en"),
    (3, "", "en"), (4, None, None), (9, "   \n\t ", "de"), (11, "x", "fr"),
    (12, "The quick brown fox jumps over the lazy dog. You are an idiot, really.\nSecond line here.", "en"),
    (12, "The quick brown fox jumps over the lazy dog. You are an idiot, really.\nSecond line here.", "en"),
    (None, "no id here at all", "en"), (20, "wörter und größe, ein langer satz über nichts. " * 400, "de"),
    (21, "日本語 テキスト 😀 emoji  with  runs   of spaces \x1c and\x0bcontrols", None), (22, "1234 5678 !!! ???", "xx"),
]
SCHEMA = "doc_id long, text string, lang string, source string, score double, ids array<int>, fp long, bucket int"


def awkward(spark):
    """Nulls, empty and long texts, repeats, and extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, g, "s", 0.5, [1], 7, 1) for i, t, g in AWKWARD], SCHEMA)


def empty(spark):
    return awkward(spark).limit(0)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
