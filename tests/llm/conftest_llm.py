"""Rows shared by the tests."""

#: Nulls, empty and odd texts, ties and repeated rows.
ODD = [
    (1, None), (2, ""), (3, " "), (4, "\n\t  "), (5, "one"), (5, "one"), (6, "one"), (None, "no id here"), (None, None),
    (7, "a  b  c\n\nd \x1c e f '  's don't I'LL 123 4567 !!?  ́x ǅ straße ΣΑΣ \U0001f600\U0001f600"),
    (8, " lead and trail "), (9, "x" * 3000 + " " + "ab" * 2000), (10, "日本語のテキスト" * 200), (11, "<|endoftext|> in text"),
    (12, "word " * 5000),
]
