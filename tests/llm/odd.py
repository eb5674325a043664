"""Rows that operators on documents must take: nulls, empty and long texts, repeated rows, extra columns."""

import random

_random = random.Random(5)
_SYLLABLES = ["the", "re", "an", "ing", "of", "tion", "ou", "st", "er", "on", "ha", "nd"]


def prose(words: int, seed: int | None = None) -> str:
    rng = random.Random(seed) if seed is not None else _random
    out = ["".join(rng.choices(_SYLLABLES, k=rng.randint(1, 3))) for _ in range(words)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(out))


LONG = prose(30_000, 1)
ODD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "One two three four five."), (4, "One two three four five."),
    (None, "no id here at all, not one"), (None, None), (5, "x" * 5000), (6, LONG), (7, "日本語 текст ελληνικά ½ ² ‹› é"),
    (8, "<|endoftext|> and <|startoftext|> <|ENDOFTEXT|>"), (9, "tab\there  two  spaces nbsp \r\n\x1cand more   "),
    (10, "ONE two THREE four five."), (11, "one"), (12, LONG.upper()), (13, "İstanbul ÀÉ \U0001f600 it's they'll  \n\n a"), (2**53 + 1, prose(60, 2)),
    (-7, prose(60, 2)), (14, prose(60, 2)), (15, " leading"), (16, "trailing "), (17, "\n"),
]
CLASHING = "score ids node key component length start payload votes content offset keep_id kept at share n_tokens bucket guest own_w _id _text hub class edited".split()


def documents(spark, rows=ODD, lang=None):
    """doc_id, text, lang and columns named like the operators' own."""
    lang = lang or (lambda i, text: "en" if i is not None and i % 2 else None)
    data = [(i, text, lang(i, text), *[None] * len(CLASHING)) for i, text in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in CLASHING)).repartition(3)
