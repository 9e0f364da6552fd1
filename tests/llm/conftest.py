import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows_for(texts):
    return [(k, t, "en", f"s{k % 3}", None if t is None else len(t)) for k, t in enumerate(texts)]


@pytest.fixture
def docs(spark):
    """Documents from a list of texts, with ids from 0; or from whole rows."""

    def make(texts):
        rows = [t if isinstance(t, tuple) else rows_for([t] * (k + 1))[k] for k, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture
def clashing():
    """Extra columns under names that operators use."""

    def add(df, *names):
        for k, name in enumerate(names):
            df = df.withColumn(name, F.lit(f"extra{k}"))
        return df

    return add


@pytest.fixture
def prose():
    """Repeatable random texts; ``vocabulary`` small makes words and passages recur."""

    def make(seed, n_words, vocabulary=400):
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n_words))

    return make
