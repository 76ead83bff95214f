"""Small documents for the tests: prose, copies, near copies, and every edge case in one table."""

import random

CLASHING = ("n_words", "kept", "c", "shard", "epoch", "size", "set", "h", "x0", "doc", "root", "text_hash", "source_key", "base_failed", "gone_id")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = ("an", "ber", "cor", "del", "en", "fil", "gra", "hon", "is", "jor", "kel", "lum", "mar", "nor", "os", "par", "qui", "ren", "sol", "tur")


def prose(rng: random.Random, n: int) -> str:
    words, out = ["".join(rng.choices(SYLLABLES, k=rng.choice((1, 2, 2, 3)))) for _ in range(n)], []
    while words:
        k = rng.randint(5, 14)
        sentence, words = words[:k], words[k:]
        out.append(" ".join([sentence[0].capitalize(), *sentence[1:]]) + ".")
    return "".join(s + ("\n" if i % 4 == 3 else " ") for i, s in enumerate(out)).strip()


def changed(rng: random.Random, text: str, n: int) -> str:
    words = text.split(" ")
    for i in rng.sample(range(len(words)), min(n, len(words))):
        words[i] = "changed" + str(rng.randint(0, 999))
    return " ".join(words)


def corpus(n: int = 260, seed: int = 5) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): a third of one source, exact and near copies, junk."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(12, 160)) for _ in range(n)]
    passage = prose(rng, 70)
    for i in range(0, n, 9):
        texts[i] = texts[0]
    for i in range(1, n, 13):
        texts[i] = changed(rng, texts[1], rng.randint(0, 6))
    for i in range(3, n, 17):
        texts[i] = texts[i] + " " + passage + " " + prose(rng, 10)
    for i in range(5, n, 31):
        texts[i] = " ".join(w + "%%%" for w in texts[i].split())
    return [(i, t, rng.choice(("en", "de")), "src0" if i % 3 == 0 else f"src{i % 4}", len(t)) for i, t in enumerate(texts)]


def edges() -> list[tuple]:
    """Nulls in any column, empty and blank texts, ties, repeated rows, a very long text and a long word."""
    rng = random.Random(9)
    long_text = " ".join(prose(rng, 150) for _ in range(60)) + "\n" + "x" * 30_000
    same = prose(rng, 30)
    return [
        (None, prose(rng, 40), "en", "s", 1), (1000, None, "en", "s", None), (1001, "", "en", "s", 0), (1002, " \n\t ", None, None, 4), (1003, "one", "en", None, 3),
        (1004, "two words", None, "s", 9), (1005, long_text, "en", "s", None), (1006, same, "en", "s", 1), (1006, same, "en", "s", 1), (1007, same, "en", "s", 1),
        (1008, "é à ü ñ 中文 𝒳 word joined a\x0bb\x0cc", "fr", "s", 1), (None, None, None, None, None), (None, same, "en", "s", 1), (1009, "a b a b a b a b a b a b", "en", "s", 1),
    ]


def frame(spark, rows, clash: bool = False):
    df = spark.createDataFrame(rows, SCHEMA)
    if clash:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit("other").alias(c) for c in CLASHING])
    return df


def rows_of(df, *columns) -> list[tuple]:
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)
