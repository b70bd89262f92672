"""Tables with what operators must get along with: nulls, blanks, long texts, repeated rows, clashing names."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id long, digest string, content string, kept boolean, code long, words string, bucket int, Left string"
)


def prose(seed: int, words: int, alphabet: str = "abcdefgh") -> str:
    rng = random.Random(seed)
    pick = ["".join(rng.choices(alphabet, k=rng.randint(1, 7))) for _ in range(400)]
    return " ".join(rng.choices(pick, k=words))


def documents(spark, rows: list[tuple]):
    """Rows (doc_id, text, lang) as documents, with columns named like those that operators work with."""
    made = [(i, t, lang, "s", None if t is None else len(t), 7, "d", "c", None, 1, "w", 2, "l") for i, t, lang in rows]
    return spark.createDataFrame(made, SCHEMA)


def odd_rows() -> list[tuple]:
    long = prose(5, 30_000)
    return [
        (1, None, "en"),
        (2, "", "en"),
        (3, " \t\n\x0b ", None),
        (4, "one", "en"),
        (5, prose(1, 80), "en"),
        (6, prose(1, 80), "en"),
        (6, prose(1, 80), "en"),
        (7, prose(1, 80).replace(" ", "\n"), "de"),
        (8, long, "en"),
        (9, long + " end", "xx"),
        (10, "naïve ünïcödé 漢字 😀 " * 30, "fr"),
        (11, "a" * 1000, None),
        (None, prose(2, 40), "en"),
        (None, None, None),
    ]
