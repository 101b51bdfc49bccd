"""Documents with every awkward case, and plain Python versions of what the queries count."""

import random
import re

from pyspark.sql import types as T

SPACE = re.compile("[\x20\x09-\x0d]+")

#: Extra columns whose names the operators use inside.
CLASHING = ("row_key", "digest", "value", "name", "shard", "block", "host", "pi", "words", "part", "train", "rank", "size")

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
        *[T.StructField(name, T.StringType()) for name in CLASHING],
    ]
)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def prose(seed, n, vocabulary=400):
    draw = random.Random(seed)
    made = [f"{draw.choice('bcdfgh')}{draw.choice('aeiou')}{draw.choice('klmn')}{k % 97}" for k in range(vocabulary)]
    out = []
    for k in range(n):
        out.append(draw.choice(made).capitalize() if k % 9 == 0 else draw.choice(made))
        out.append("\n" if k % 11 == 10 else " ")
    return "".join(out)


def edge_texts():
    """Null, empty and blank texts, copies, near copies, shared passages, few words, one very long text, other scripts."""
    base, passage = prose(1, 120), prose(2, 25)
    near = base.split(" ")
    texts = [None, "", " \n\t ", "one", "Two words", base, base, base.upper(), base + " ", passage]
    for k in range(8):
        changed = list(near)
        for j in range(k + 1):
            changed[(7 * k + 31 * j) % len(changed)] = f"edit{k}x{j}"
        texts.append(" ".join(changed))
    texts += [prose(10 + k, 40) + "\n" + passage + "\n" + prose(30 + k, 30) for k in range(5)]
    texts += [prose(3, 20_000, 5_000), "x" * 5_000, "ab " * 300, "größe ñandú 東京 東京 naïve été " * 6, "1234 5678 !!! ???"]
    texts += [prose(50 + k, 60) for k in range(6)]
    return texts


def edge_docs(spark, texts=None):
    """The texts under ids that are not in order, two sources and a null one; two rows repeat."""
    texts = edge_texts() if texts is None else texts
    rows = []
    for k, text in enumerate(texts):
        source = None if k % 7 == 6 else f"src{k % 2}"
        rows.append((k * 37 % 101 + 200 * (k // 101), text, None if k % 5 == 4 else "en", source, len(text or ""), *["clash"] * len(CLASHING)))
    rows += [rows[5], rows[0]] if len(rows) > 5 else []
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.select("doc_id", "text", "source").collect()]
