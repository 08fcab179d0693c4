import pytest
from pyspark.sql import types as T

from shelfcast.llm.queries import ready

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
        # Names that operators use inside or return.
        T.StructField("id", T.StringType()), T.StructField("score", T.StringType()), T.StructField("row", T.StringType()),
    ]
)


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text[, lang]) with extra columns of clashing names."""
    ready(spark)

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None, "x", "y", "z") for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return build


def words(seed: int, count: int, kinds: int = 5000) -> list[str]:
    import random

    rng = random.Random(seed)
    return [f"w{rng.randrange(kinds)}" for _ in range(count)]


@pytest.fixture(scope="session")
def odd_rows():
    """Null and repeated ids, null, empty, blank and very long texts, repeated rows."""
    long = " ".join(words(1, 30_000))
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (None, "lost words here"), (None, None), (5, long), (6, long),
        (7, "Añö　wide space  two\n\nlines <|endoftext|> end "), (8, " ".join(words(2, 400))), (8, " ".join(words(3, 400))),
        (9, "\x00 nul \x1f"), (10, " ".join(words(2, 400)) + " tail"),
    ]
