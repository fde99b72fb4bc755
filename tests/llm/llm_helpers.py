"""Texts that the tests share."""

TEXT = "the quick brown fox jumps over the lazy dog and runs far away from all the noise of the town "
ODD = [(5, None), (6, ""), (7, " \t\n"), (8, "one"), (9, "one two three"), (10, "été \U0001f600 naïve 123"),
       (11, "word " * 3000), (12, "x" * 30000), (12, "x" * 30000), (None, "no id at all"), (13, TEXT * 3), (14, TEXT * 3), (14, "same id, other text " * 5)]
