"""Small document tables with the awkward cases every operator meets."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use for their own columns, as extra columns of the input.
CLASHES = (
    "size source_size target copies taken shard slot curve host path rule verdict n_words kept labels score fp component_id "
    "text_key _key _k _s _n runs lines words anchor hash value n row found"
).split()


def words(rng: random.Random, n: int, stem: str = "") -> str:
    return " ".join(stem + "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(n))


def awkward(seed: int = 7) -> list[tuple]:
    """NULLs in every column, empty and long texts, ties, repeated rows, near and exact copies."""
    rng = random.Random(seed)
    long = words(rng, 6000)
    base = words(rng, 80)
    near = base.replace(base.split()[40], "zzz", 1)
    rows = [
        (1, base, "en", "a", 1),
        (2, base, "en", "a", 1),
        (3, near, "en", "b", None),
        (4, None, "de", "b", 0),
        (5, "", "de", None, 0),
        (6, "   \t \n\n", None, "a", 5),
        (7, long, "fr", "c", 9),
        (8, long[3000:] + " tail", "fr", "c", 9),
        (9, "12 34 !!", "fr", "c", 9),
        (10, base, None, None, None),
        (10, base, None, None, None),
        (None, words(rng, 30), "en", "a", 3),
        (None, None, None, None, None),
        (11, "one", "en", "a", 3),
        (12, "Same Line\nsame line \nother", "en", "a", 3),
    ]
    rows += [(100 + i, words(rng, rng.randint(5, 60)) + "\nA shared line\n" + words(rng, 9), "en", "abc"[i % 3], 1) for i in range(25)]
    return rows


def frame(spark, rows=None, schema: str = SCHEMA):
    return spark.createDataFrame(awkward() if rows is None else rows, schema)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(i).alias(name) for i, name in enumerate(CLASHES)])
