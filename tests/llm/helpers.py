"""Small tables that hold the awkward cases of every operator."""

import random

CLASHING = ["node", "root", "kind", "words", "hash", "a", "b", "key", "part", "score", "size", "block", "label", "h", "c", "at", "evidence"]


def prose(seed: int, n: int, words: int = 400) -> str:
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(1, 4))) for _ in range(words)]
    return " ".join(rnd.choice(pool) for _ in range(n))


def awkward_texts() -> list:
    return [None, "", "   \t\n", "one", "Two words", "a b c", "Ünïcödé ß 日本語 текст ελληνικά", "1234 567.8 +-()",
            "<|endoftext|> inside <|startoftext|>", "x" * 3000, "a " * 500, "\x00\x1f odd \x85 \xa0 blanks",
            prose(1, 120), prose(1, 120), prose(2, 30_000)]


def documents(spark, texts=None, ids=None, lang=None, extra=True):
    """documents with extra columns whose names operators might use themselves."""
    texts = awkward_texts() if texts is None else texts
    ids = list(range(len(texts))) if ids is None else ids
    lang = lang or ["en" if i % 3 else None for i in range(len(texts))]
    rows = [(i, t, g, None if k % 2 else "src", None if t is None else len(t), *([k] * len(CLASHING) if extra else []))
            for k, (i, t, g) in enumerate(zip(ids, texts, lang))]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    if extra:
        schema += "".join(f", `{c}` long" for c in CLASHING)
    return spark.createDataFrame(rows, schema)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
