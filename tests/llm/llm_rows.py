"""Rows for the tests of the training-data operators."""

import random

WORDS = "the of and river stone cloud garden winter letter music paper engine market doctor signal forest island".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int, words=WORDS) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(words) + (str(r.randrange(40)) if r.random() < 0.5 else "") for _ in range(n))


#: Nulls in every column, empty and white texts, ties, repeated rows, a long
#: text, copies and near copies, a shared line.
def odd_docs() -> list[tuple]:
    long = prose(5, 30_000)
    near = prose(6, 400)
    rows = [
        (1, None, "en", "a", None), (2, "", "en", None, 0), (3, " \t\n ", None, "a", 4), (4, "one", "en", "b", 3),
        (5, "Two words", "en", "b", 9), (6, long, "en", "b", len(long)), (None, "no id here at all", "en", "c", 17),
        (7, near, "fr", "c", 1), (8, near, "fr", "c", 1), (9, near + " tail", "fr", None, 1), (9, near + " tail", "fr", None, 1),
        (10, "1234 5678 !!", "en", "a", 12), (11, "Grüße\n\nSHARED line \nünï\rcode", "de", "a", 9),
    ]
    return rows + [(100 + i, f"{prose(i, 30)}\n shared LINE\t\n{prose(90 + i, 5)}", "en", "abc"[i % 3], 5) for i in range(12)]
