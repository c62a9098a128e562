"""Small inputs that every corpus operator must get through."""

import random

LONG = "abcé" * 20_000 + " end"  # a word of 100 kB
CLASH = "doc_id bigint, text string, lang string, source string, n_chars bigint, " \
        "fp bigint, row bigint, seq int, h string, found string, id string, new_text string, kept_id int, " \
        "score string, lang_pred string, size string, shard string, doc string, start string, t string, i string"


def odd_rows():
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, "x"), (5, LONG), (6, "The cat sat on the mat. " * 30),
             (6, "The cat sat on the mat. " * 30), (7, "The cat sat on the mat. " * 30), (8, "1234 5678"),
             (9, "<|endoftext|> a  <|endoftext|>"), (None, "no id here at all"), (10, "naïve café, 日本語 テキスト 🙂 ok")]
    return [(i, t, None if t is None else "en", None, None if t is None else len(t),
             1, 2, 3, "h", "f", "id", "n", 4, "s", "l", "z", "q", "d", "b", "t", "i") for i, t in texts]


def odd(spark):
    return spark.createDataFrame(odd_rows(), CLASH)


def none(spark):
    return spark.createDataFrame([], CLASH)


def prose(seed, n, words=400, most=60):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeéñ") for _ in range(r.randint(1, 7))) for _ in range(words)]
    return [" ".join(r.choice(vocab) for _ in range(r.randint(0, most))) for _ in range(n)]
