from __future__ import annotations

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Build a documents table from texts, or from (doc_id, text) pairs, with a column that clashes with results."""

    def build(rows, extra: bool = False, start: int = 0):
        pairs = [r if isinstance(r, tuple) else (start + k, r) for k, r in enumerate(rows)]
        df = spark.createDataFrame([(i, t, None if i is None or i % 3 == 0 else "en", "s", None if t is None else len(t)) for i, t in pairs], DOCUMENTS)
        if extra:
            from pyspark.sql import functions as F

            for c in ("score", "n", "component_id", "shard", "spans", "length", "rep", "kept", "digest", "tie"):
                df = df.withColumn(c, F.lit("clash"))
        return df.repartition(3)

    return build


def prose(seed: int, n: int, vocabulary: int = 4000) -> str:
    """n words of a small invented language."""
    import random

    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary):x}" for _ in range(n))


@pytest.fixture(scope="session")
def prose_of():
    return prose
