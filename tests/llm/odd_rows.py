"""Small rows that every operator must survive."""

import random

from pyspark.sql import types as T

DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # Names that operators use inside.
    T.StructField("start", T.StringType()), T.StructField("id", T.StringType()),
    T.StructField("row", T.StringType()), T.StructField("score", T.StringType()),
    T.StructField("fp", T.StringType()), T.StructField("value", T.StringType()),
    T.StructField("words", T.StringType()), T.StructField("text_hash", T.StringType())])


def prose(seed: int, n: int) -> str:
    """n words in lines, with sentences."""
    r = random.Random(seed)
    words = ["".join(r.choice(["an", "re", "th", "on", "ti", "sé", "lo", "mi"]) for _ in range(r.randint(1, 4)))
             for _ in range(n)]
    return "".join(w + (".\n" if i % 11 == 10 else " ") for i, w in enumerate(words)).strip()


def doc_row(doc_id, text, source="src0"):
    return (doc_id, text, "en", source, None if text is None else len(text), *["x"] * 8)


def odd_documents():
    """Nulls, empty and white-space texts, a very long text, copies, near
    copies, repeated rows, one id with two texts, special strings."""
    base, long_text = prose(1, 120), prose(2, 30_000)
    near = base.split(" ")
    near[60] = "changed"
    rows = [doc_row(1, base), doc_row(2, base), doc_row(3, " ".join(near)), doc_row(4, ""), doc_row(5, None),
            doc_row(6, " \n\t "), doc_row(7, long_text), doc_row(8, "one"), doc_row(9, "one two"),
            doc_row(9, "two texts of one id"), doc_row(10, prose(3, 60)), doc_row(10, prose(3, 60)),
            doc_row(None, prose(4, 50)), doc_row(None, base), doc_row(11, prose(5, 30) + " " + base),
            doc_row(12, "a  b\n \nfoo   bar <|endoftext|> it's we'll\r\n\x0b\x0c x  "),
            doc_row(13, "same " * 70), doc_row(-4, "ÉCLAIR Éclair éclair ABC abc " + prose(6, 40)),
            doc_row(14, 'Thnt token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" ' + prose(7, 30), None)]
    return [(*r[:3], r[3], *r[4:]) for r in rows]
