"""Small frames with the cases every operator has to bear."""

import random

from pyspark.sql import functions as F

WORDS = [f"w{i}" for i in range(400)]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n, words=WORDS):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) for _ in range(n))


def frame(spark, rows):
    """Documents from (id, text) pairs, with columns whose names clash with results."""
    df = spark.createDataFrame(
        [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows], DOCS
    )
    for name in ("cls", "label", "spans", "kept", "n_words", "places", "node", "row_fp", "ids", "length"):
        df = df.withColumn(name, F.lit("x"))
    return df


def odd_rows():
    """Null id, null text, empty, blank, a repeated row, a long text, shared ids."""
    long_text = prose(5, 30_000)
    return [
        (None, prose(1, 80)), (None, None), (3, None), (4, ""), (5, " \n\t "), (6, prose(6, 90)),
        (6, prose(6, 90)), (7, prose(6, 90)), (8, long_text), (9, long_text + " tail"), (10, "one"),
        (11, "a b 　 é \U0001f642"), (12, prose(12, 70)), (12, prose(13, 70)),
    ]
