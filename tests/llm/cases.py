"""Small document tables for the text operators."""

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars int"
LONG = 3_000


def corpus(seed=1, n=60):
    """Words from a small vocabulary, with copies, near copies, shared passages and odd texts."""
    rng = random.Random(seed)
    words = ["the", "of", "Alpha", "beta,", "gamma", "été", "naïve.", "x1", "über", "delta", "omega"] + [
        "".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(400)]

    def prose(k):
        out = []
        for i in range(k):
            out.append(rng.choice(words) + ("\n" if rng.random() < 0.06 else " "))
        return "".join(out).strip()

    passage = prose(90)
    texts = [prose(rng.randint(3, 220)) for _ in range(n)]
    texts += [f"{prose(30)}\n{passage}\n{prose(30)}" for _ in range(6)]
    base = prose(200).split(" ")
    for _ in range(8):
        near = list(base)
        for k in rng.sample(range(len(near)), rng.randint(0, 3)):
            near[k] = "changed"
        texts.append(" ".join(near))
    texts += [texts[0], texts[0], "", " \n\t ", "one", "one two three", "aa " * 300, "z" * 2_000, prose(LONG)]
    rows = [(i, t, rng.choice(["en", "fr", None]), "src0", len(t)) for i, t in enumerate(texts)]
    rows += [(1000, None, None, None, None), (None, texts[1], "en", None, 1), (2, texts[2], "en", "src0", 3), (2, texts[2], "en", "src0", 3)]
    return rows


def table(spark, rows=None, parts=3):
    """With columns whose names the operators use inside."""
    rows = corpus() if rows is None else rows
    frame = spark.createDataFrame(rows, COLUMNS).repartition(parts)
    return frame.selectExpr("*", "1 AS start", "'x' AS ids", "2 AS bucket", "'y' AS removed", "3 AS stratum", "4 AS kept", "5 AS cluster")


def empty(spark):
    return table(spark, [])
