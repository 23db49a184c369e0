"""Rows that several tests use."""

import random


def prose(seed, words, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


EDGE_ROWS = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\f\r "),
    (4, "one"),
    (5, "one"),
    (5, "one"),
    (None, "one two"),
    (None, None),
    (6, "Ünïcödé  text with 日本語 and 🙂 emoji"),
    (7, "x" * 200_000),
    (8, prose(1, 30_000)),
    (9, prose(1, 30_000) + " "),
    (10, "a\x1cb\x1dc 'tis it's <|endoftext|> {json: 'x'}"),
]
