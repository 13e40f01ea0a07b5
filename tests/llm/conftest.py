import os

os.environ.setdefault("OMP_NUM_THREADS", "1")

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators work with themselves.
CLASHES = "id key row rep label group seed item found range copy tokens sequence_id offset verdict host rule language component score".split()

PROSE = {
    "en": "the quick report of the river and the harbour was read by all of the people that live on the hill with care ",
    "fr": "le rapport de la rivière et du port est lu par tous les gens qui vivent dans la vieille ville avec soin ",
    "de": "der bericht über den fluss und den hafen wurde von allen leuten gelesen die auf dem hügel wohnen und arbeiten ",
}


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of (doc_id, text[, lang[, source]]) rows."""

    def make(rows, clash=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if clash:
            from pyspark.sql import functions as F

            df = df.withColumns({c: F.lit("x") for c in CLASHES})
        return df

    return make


def hard_rows():
    """Nulls, empty, blank and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977} the {i}" for i in range(60_000))
    return [
        (1, PROSE["en"] * 3, "en", "a"),
        (2, PROSE["en"] * 3, None, None),
        (2, PROSE["en"] * 3, None, None),
        (3, None, "en", "a"),
        (4, "", "fr", "a"),
        (5, " \t\n", "fr", "b"),
        (6, "!!! ???", None, "b"),
        (7, PROSE["fr"] * 2, "fr", "b"),
        (8, long, "en", "c"),
        (None, PROSE["de"] * 2, "de", "c"),
        (None, None, None, None),
        (9, "one", "en", "c"),
    ]
