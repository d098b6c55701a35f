import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from pricelens.llm.util import reach_package
    from pricelens.session import build_session
    s = build_session("local[4]", shuffle_partitions=4)
    reach_package(s)
    return s


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and extra
    columns whose names clash with those that the operators make."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, "
              "score double, size long, cls string, doc string, copies int, slot int")
    base = " ".join(f"word{i % 97}" for i in range(400))
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, base + " tail", "en", None),
        (4, None, None, None), (None, "une phrase toute seule", "fr", "b"), (None, None, "fr", "b"),
        (5, "", "en", "b"), (6, " \t\n ", "de", "b"), (7, "12345 ---", "de", "a"), (8, "kurz", "de", "c"),
        (9, "Long " * 60_000, "en", "c"), (10, "naïve Ünïcode 漢字 text " * 9, "de", "c"),
        (11, "eins zwei drei vier fünf sechs", "de", "a"), (12, "eins zwei drei vier fünf sechs", "de", "b"),
        (13, "the quick brown fox jumps over the lazy dog again and again today", "en", "a"),
        (14, "le renard brun saute par dessus le chien paresseux", "fr", "a")]
    return spark.createDataFrame([(*r, None, 0.5, 3, "x", "y", 2, 1) for r in rows], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
