from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

DOC_FIELDS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# names that operators use inside
CLASHES = ["id", "row", "node", "words", "tie", "keys", "slice", "guest", "bucket", "anchor", "_text", "score", "start"]


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(n))


def odd_texts() -> list[tuple[int | None, str | None]]:
    """Ids and texts with every awkward case: nulls, empty and blank texts,
    copies, repeated rows, ties, very long and very short ones."""
    rng = random.Random(5)
    base, passage = sentence(rng, 120), sentence(rng, 60)
    long = sentence(rng, 30_000)
    return [
        (7, None), (3, ""), (4, " \t\n\x0b\x0c\r "), (5, "one"), (6, "a b c d"), (1, base), (2, base), (10, base),
        (10, base), (11, base.replace(" ", "\n", 40)), (12, base + " tail"), (13, f"{sentence(rng, 80)} {passage} {sentence(rng, 70)}"),
        (14, f"{sentence(rng, 75)}\n{passage}\n{sentence(rng, 90)}"), (15, long), (16, long[:60_000]),
        (None, base), (None, sentence(rng, 50)), (17, "x y z w v u " * 40), (18, "Ünïcode ﬁ 漢字 🙂 <|endoftext|> Σς İ\x1c\x85\xa0 end"),
        (19, "line one here\nline one here\n\nother | line\n \nline one here"), (20, passage), (20, passage + " more"),
        (21, "# $ % & | < > *"), (1 << 40, sentence(rng, 200)), (-4, sentence(rng, 30)),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, ["en", None, "fr"][k % 3], f"s{k % 2}", len(t or ""), *([None] * len(CLASHES)))
            for k, (i, t) in enumerate(odd_texts())]
    schema = T.StructType.fromDDL(DOC_FIELDS + "".join(f", `{c}` string" for c in CLASHES))
    return spark.createDataFrame(rows, schema).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_FIELDS)
