"""Documents that every operator must take."""

ODD = [
    (1, None, None),
    (2, "", "en"),
    (3, " \t\r\n ", "en"),
    (None, "the cat sat on the mat and the dog lay by the door of the house", None),
    (4, "the cat sat on the mat and the dog lay by the door of the house", "en"),
    (4, "the cat sat on the mat and the dog lay by the door of the house", "en"),
    (5, "word " * 60_000, "en"),
    (6, "x" * 50_000, None),
    (7, "日本語 \U0001f600 ▁ \x00 </s>[INST]", "xx"),
]
