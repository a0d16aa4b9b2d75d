"""Texts and tables that the corpus tests import; fixtures themselves are in conftest.py."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size string, fp string"

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "s", "ly", "ing"]) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls in any column, empty and long texts, repeated rows, equal texts, odd white space."""
    long = prose(5, 20_000)
    rows = [
        (1, prose(1, 60), "en", "a", 3, True, "x", "y"),
        (2, prose(1, 60), "en", "a", None, None, None, None),
        (3, prose(2, 80), None, "b", 1, True, "x", "y"),
        (4, None, "en", None, None, None, None, None),
        (5, "", "de", "b", 0, False, "", ""),
        (6, " \t\n\x0b\f\r ", None, None, 7, True, "x", "y"),
        (None, prose(3, 50), "en", "a", 2, True, "x", "y"),
        (None, None, None, None, None, None, None, None),
        (7, long, "en", "a", 9, True, "x", "y"),
        (8, "x" * 50_000, "en", "c", 9, True, "x", "y"),
        (9, "one two\none two\n\none two\nÜber straße 日本語 é <|endoftext|> it's", "de", "c", 1, True, "x", "y"),
        (10, "#### | $$$ %%% &&& <> ||| ### *** $$$ | ####", "en", "b", 1, True, "x", "y"),
        (2**62, prose(4, 70), "fr", "", 2**61, True, "x", "y"),
    ]
    return rows + [rows[0], rows[0]]


def write_tables(spark, folder, **tables) -> str:
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
