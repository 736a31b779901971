from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names the operators use inside, as extra columns of the input.
CLASHES = ("_row", "_keep", "size", "kept", "n_words", "found", "spans", "copies", "fp", "component_id", "label", "count", "_x", "e", "t", "_s", "target", "score")


@pytest.fixture(scope="session")
def docs_of(spark):
    """Builds a documents table from (doc_id, text[, lang, source]) rows, with clashing extra columns."""

    def build(rows, clash: bool = False):
        full = [(*r, *("en", "a")[len(r) - 2 :]) if len(r) < 4 else r for r in rows]
        df = spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in full], DOCS)
        if clash:
            from pyspark.sql import functions as F

            df = df.select("*", *(F.lit(f"x{k}").alias(c) for k, c in enumerate(CLASHES)), F.create_map(F.lit("m"), F.lit(1)).alias("a_map"))
        return df

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, blank and very long texts, ties and repeated rows."""
    import random

    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    same = text(80)
    long_ = text(30_000)
    rows = [(1, None, "en", "a"), (2, "", None, "a"), (3, " \n\t ", "en", None), (None, text(50), "en", "b"), (4, same, "en", "a"), (5, same, "de", "b"), (6, same, "en", "a"), (6, same, "en", "a")]
    rows += [(7, long_, "en", "b"), (8, "x" * 200_000, "en", "b"), (9, same + " z", None, None), (10, "a b c", "en", "a")]
    return rows + [(20 + k, text(rng.randint(5, 200)), "en", rng.choice("abc")) for k in range(40)]


@pytest.fixture(scope="session")
def dir_of(tmp_path_factory):
    """Writes tables as a folder that queries can read."""

    def write(**tables) -> str:
        d = tmp_path_factory.mktemp("tables")
        for name, df in tables.items():
            df.write.parquet(f"{d}/{name}.parquet")
        return str(d)

    return write
