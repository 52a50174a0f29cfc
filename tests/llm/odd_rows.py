"""Rows (doc_id, text) with nulls, empty and long texts, ties and repeats."""

ODD = [
    (1, None), (2, ""), (3, " \t\n"), (None, "a null id"), (5, "one"), (6, "one"), (7, "one"), (7, "one"), (7, "two words"),
    (8, "Ünïcödé 漢字 👍🏽 x"), (9, "word " * 5000), (-10, "the same line of some length\nshort\nthe same line of some length"),
    (11, "The same LINE of some length \nother"), (12, "\tthe same line of some length"), (None, "the same line of some length"),
]
