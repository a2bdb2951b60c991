import pytest

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards mix strong potions near old stone bridges every autumn evening before the rain begins to fall softly on green hills".split()


def passage(seed, n):
    """n words that don't repeat in runs, fixed by a seed."""
    x, out = seed * 7919 + 13, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 5) % 97))
    return " ".join(out)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty and very long texts, repeated rows, one id with two texts, clashing extra columns."""
    long_text = passage(1, 30_000)
    base = [
        (1, passage(2, 80), "en", "a", 1), (2, None, "en", "a", None), (3, "", None, None, 0), (4, long_text, "de", "b", 1), (5, long_text, "de", "b", 1),
        (6, passage(2, 80), "en", "a", 1), (6, passage(2, 80), "en", "a", 1), (None, passage(3, 60), "fr", "c", 1), (None, None, None, None, None),
        (7, passage(4, 70), "fr", "c", 1), (7, passage(5, 70), "fr", "c", 1), (8, "x", "en", "a", 1), (9, " \n\t ", "en", "a", 1), (10, "é\U0001f600 ß", "de", "b", 1),
    ]
    extra = "score double, predicted int, kept boolean, t string, h string, node string, label string, n long, d string, mask int, secret_spans string, pii_counts string, decon_words long, mix_slot long, n_tokens long"
    rows = [(*r, 0.5, 7, None, "t", "h", "n", "l", 3, "d", 5, "s", "p", 1, 2, 3) for r in base]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + extra)


@pytest.fixture(scope="session")
def none(spark, odd):
    return spark.createDataFrame([], odd.schema)
