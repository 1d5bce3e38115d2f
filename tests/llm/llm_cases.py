"""Rows that every operator must stand."""

#: Long enough for repeated 400-byte strings, with characters of two bytes.
PASSAGE = " ".join(f"passage{i} wörd" for i in range(60))

#: Nulls in any column, empty and blank texts, equal texts, repeated rows, one very long text.
TEXTS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"),
    (2, "alpha  beta\ngamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"),
    (3, "ALPHA beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron rho"),
    (4, None), (5, ""), (6, " \t\n"), (7, "one"), (8, "two words"), (9, "Ünïcode 日本語 text \U0001F600"),
    (10, "head " + PASSAGE + " tail"), (11, PASSAGE), (12, "other " + PASSAGE), (12, "other " + PASSAGE),
    (None, "no identifier"), (None, None), (13, "x" * 1200), (14, "long " + " ".join(f"w{i % 997}" for i in range(30_000))),
    (15, "Licensed under CC BY-NC 4.0. All rights reserved. all RIGHTS-reserved"), (16, "general public license cc by cc by"),
]
