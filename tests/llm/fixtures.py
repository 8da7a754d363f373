"""Small awkward tables: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import random

WORDS = ["alpha", "beta", "gamma", "delta", "Eps", "zeta", "eta", "theta", "iota", "kappa", "la", "mu", "été", "straße", "ñu", "日本語", "x1", "42", "don't", "--", "😀"]
CLASH = ["id", "row", "text_sha256", "size", "value", "digest", "key", "copies", "next", "block", "draw", "score", "part", "cuts"]


def prose(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + (rng.choice(WORDS) if rng.random() < 0.5 else "") for _ in range(n))


def awkward_rows() -> list[tuple]:
    long = prose(4000, 1)
    rows = [
        (1, "a b c d e f g h i j", "en", "s1"), (2, "A B c d e f g h i j", "en", "s1"), (3, "", "en", "s2"), (4, None, "en", "s2"),
        (5, " \t\n ", None, "s2"), (6, long, "en", "s3"), (7, "x" * 30000, "en", "s3"), (8, "É é ÀB straße İ K K ſ", "fr", None),
        (8, "É é ÀB straße İ K K ſ", "fr", None), (9, "É É àb STRASSE", "fr", None), (None, "no id here at all", None, None),
        (None, "no id here at all", None, None), (10, prose(60, 2), "de", "s1"), (11, prose(60, 2), "de", "s1"), (12, long + " tail", "en", "s3"),
        (13, "<|endoftext|> and <|endoftext|>", "en", "s1"), (14, "\x1c\x1d\x85 ​x\r\n\n  y  ", "en", "s4"), (15, "a", "es", "s4"),
        (-3, "1 2 3 4 5 6 7 8 9 10 11 12 13", "es", "s4"), (2**62, prose(300, 3), "es", "s1"), (16, "\x00zero\x00 byte", "en", "s4"),
        (17, "la la la la la la la la la la " * 3 + "mu la la la la la la la", "en", "s4"),
    ]
    return rows + [(100 + k, prose(40 + k, 50 + k), ["en", "de", None][k % 3], f"s{k % 4}") for k in range(30)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)


def table(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or ""), *["clash"] * len(CLASH)) for r in rows], SCHEMA).repartition(3)


def awkward(spark):
    return table(spark, awkward_rows())


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def as_sf_dir(spark, docs, marks, folder: str) -> str:
    docs.write.parquet(f"{folder}/documents.parquet")
    marks.write.parquet(f"{folder}/labels.parquet")
    return folder
