"""Documents that operators must take: nulls, no words, repeated rows, long texts, clashing columns."""

import random

from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for themselves or give to their results.
CLASHING = (
    "id", "key", "_id", "_kept", "kept", "kept_text", "copies", "number", "class", "class_no", "n_links", "shard", "slot",
    "score", "lang_pred", "held_out", "anomaly", "row", "bucket", "part", "words", "block", "quality", "n_words", "item_id",
)


def prose(n: int, seed: int, lang: str = "en") -> str:
    draw = random.Random(f"{lang}{seed}")
    parts = {"en": ["the", "and", "ing", "er", "on", "th", "ou", "ea"], "de": ["sch", "ung", "ein", "kei", "tz", "ver", "zu", "ge"]}[lang]
    words = ["".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(n)]
    return " ".join(words) + "."


def strange_rows():
    long = prose(30_000, 1)
    same = prose(80, 2)
    near = same.split()
    near[-1] = "changed"
    texts = [
        (0, None), (1, ""), (2, " \n\t "), (None, "alone"), (None, None), (3, "alone"), (4, "x"), (5, "12 34 !? |"),
        (6, same), (6, same), (6, same), (7, same), (8, " ".join(near)), (9, long), (10, prose(60, 3) + "\n" + prose(60, 3)),
        (11, "é ß\x1c漢字 😀 <|endoftext|> don't"), (12, "a" * 3_000), (13, prose(120, 4, "de")), (14, "of " * 200), (-5, prose(90, 5)),
    ]
    return [(key, text, None if i % 4 == 0 else "de" if key == 13 else "en", None if i % 5 == 0 else "s", None if text is None else len(text)) for i, (key, text) in enumerate(texts)]


def strange(spark, columns=CLASHING):
    df = spark.createDataFrame(strange_rows(), COLUMNS)
    return df.select("*", *[F.lit("other").alias(name) for name in columns])


def nothing(spark):
    return spark.createDataFrame([], COLUMNS)


def random_docs(spark, n: int = 60, seed: int = 0):
    """Documents with exact and near copies, shared passages and repeats inside a text."""
    draw = random.Random(seed)
    passages = [prose(draw.randint(36, 60), 100 + i) for i in range(4)]
    rows = []
    for i in range(n):
        kind = draw.random()
        if kind < 0.3 and rows:
            words = draw.choice(rows)[1].split()
            for _ in range(draw.choice([0, 0, 1, 2, 5])):
                words[draw.randrange(len(words))] = "new"
            text = " ".join(words)
        else:
            parts = [prose(draw.randint(1, 120), seed * 1000 + i)]
            parts += draw.choices(passages, k=draw.randint(0, 2))
            draw.shuffle(parts)
            text = draw.choice([" ", "\n"]).join(parts)
        rows.append((i, text, "en", "s", len(text)))
    return spark.createDataFrame(rows, COLUMNS)
