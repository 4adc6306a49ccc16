import pytest
from pyspark.sql import types as T

LONG = "Every word of this long text is numbered " + " ".join(f"word{i}" for i in range(9000))
PASSAGE = ("this passage is shared by several documents and it is longer than two hundred bytes so that every window "
           "of it repeats in the corpus, which makes the suffix array stage remove it from all of the documents, "
           "whatever else they hold before or after the shared words")

# (doc_id, text): nulls, empty, blank, very long, ties, repeated rows, shared passages
DOCS = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "Two words"), (6, "three little words"),
    (7, LONG), (8, LONG), (9, "An " + PASSAGE + " alpha beta gamma"), (10, "Zé " + PASSAGE + " und noch etwas mehr ß"),
    (11, "same text for ties"), (12, "same text for ties"), (12, "same text for ties"),
    (13, "of " * 500), (14, "ab" * 300), (15, "plain text with  double   spaces \n and \t tabs "), (None, "no id here"),
    (None, None), (16, "THREE little WORDS"), (17, "İstanbul ǅ ﬀ ß"), (18, "tail " + PASSAGE), (18, "other text, same id"),
]
# columns whose names operators might use themselves
EXTRA = ["h", "key", "size", "shard", "score", "fp", "cell", "x", "n", "rank", "w", "version", "rest", "row", "spans"]


@pytest.fixture(scope="session")
def docs(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType())] + [T.StructField(c, T.StringType()) for c in EXTRA])
    rows = [(i, t, "en", "s", None if t is None else len(t), *("clash",) * len(EXTRA)) for i, t in DOCS]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")
