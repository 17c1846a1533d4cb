import random

import pytest

HARD = [None, "", " \t\n\x0b\r ", "one", "a b", "ñ é ü " * 40, "x" * 3000, "same line\n" * 400]
#: Columns whose names operators use themselves.
CLASHES = ("text_key", "row", "size", "shard", "n", "key", "part", "bin", "piece", "at", "tok", "order", "word", "component_id", "kept")


def prose(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(vocabulary)]
    return [rng.choice(words) for _ in range(n)]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, clashes=True):
        """A documents table of (id, text) pairs, with columns of clashing names."""
        full = [(i, t, "en" if k % 2 else "fr", f"src{k % 3}", len(t or "")) for k, (i, t) in enumerate(rows)]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
        if clashes:
            from pyspark.sql import functions as F

            df = df.withColumns({name: F.lit("clash") for name in CLASHES})
        return df

    return make
