"""Small corpora with the awkward rows that every operator must take."""

import random

from pyspark.sql import DataFrame, SparkSession

# Clashing names on purpose: operators use columns of these names themselves.
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, key string, kept boolean, n_words string, "
          "class string, value string, h string, t string, label string")


SYLLABLES = "the an er on re in ed st at en ti nd or ea es ha ou it le ing ble ly sh tion".split()


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 5))) for _ in range(n))


def sentences(seed: int, n: int) -> str:
    w = words(seed, n).split()
    return "\n".join(" ".join(w[i:i + 12]).capitalize() + "." for i in range(0, n, 12))


def edited(text: str, every: int) -> str:
    w = text.split(" ")
    return " ".join("changed" if i % every == every - 1 else x for i, x in enumerate(w))


def texts() -> list:
    long = sentences(1, 400)
    return [long, long, edited(long, 97), edited(long, 31), None, "", "   \n\t ", "one", "one two three", "ONE Two three",
            "é" * 30, "日本語 テスト 文章", "\x00 \x0b \x0c \x85 \xa0 x", "a" * 5000, "😀 " * 40, "<|endoftext|> <s> </s> ▁ ▁▁",
            sentences(2, 5000), "repeat me " * 200, long[:1500] + "\n" + sentences(3, 200), sentences(4, 120), "x\n" * 50, "!" * 300]


def docs(spark: SparkSession, some: list, ids: list | None = None) -> DataFrame:
    ids = list(range(len(some))) if ids is None else ids
    rows = [(i, t, "en" if t else None, "s", None if t is None else len(t), "k", None, "w", "c", "v", "h", "t", "l") for i, t in zip(ids, some)]
    return spark.createDataFrame(rows, SCHEMA)
