"""Language identification by compression.

Every language gets zstandard raw-content dictionaries made of slices of its
training texts.  A text is reduced to lower-case letters and single spaces,
cut into chunks (so that a dictionary matters for every part of a long text),
and each chunk is encoded with the dictionary of every language; the language
with the smallest total wins.  Texts whose two best totals are close are
encoded again with further dictionaries of each language, whose totals are
added, since a few bytes decide there.  A text whose final margin is still
too narrow is rejected (``rejected``), as is one without letters (``und``).

Training: ``DICTIONARIES`` dictionaries of ``DICT_BYTES`` bytes a language,
each filled with slices of at most ``SLICE`` letters from the middle of at most
``SAMPLE_ROWS`` training rows, those with the smallest hashes of id and text, of
the ``LANGUAGES`` most common languages.  This bounded sample is the documented
size of the model; it does not grow with the corpus, whatever ids repeat.

Cases: a null text, an empty text or one without letters is ``und`` with
score 0 and rejected; rows with a null language are not learned from; with no
training rows every text is ``und``; equal texts get equal results; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, sample_bounds, sample_hash, small_batches

DICT_BYTES = 32 << 10
DICTIONARIES = 4          # the first one is the main dictionary
SLICE = 1024
SAMPLE_ROWS = 4000        # training rows a language
LANGUAGES = 64            # the most common ones are learned
LEVEL = 6
CHUNK = 2048
CLOSE = 0.03              # below this margin the further dictionaries are used
MIN_MARGIN = 0.002        # of the second-best total, below it a text is rejected
UNKNOWN = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    return _NOT_LETTERS.sub(" ", text.lower()).strip()


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> dict[str, list[bytes]]:
    """language -> dictionaries, the most common language first, from a bounded sample of ``rows``: the rows with
    the smallest hashes of id and text of each of the ``LANGUAGES`` most common languages, equal rows once.  They
    are found without sorting rows (``sample_bounds``)."""
    rows = rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), sample_hash(id_col, text_col, salt="langid").alias("u"), F.col(text_col).alias("text"))
    order = (F.col("n").desc(), "lang")
    common = [r["lang"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(*order).limit(LANGUAGES)
              .collect()]
    if not common:
        return {}
    spark = rows.sparkSession
    known = spark.createDataFrame([(lang,) for lang in common], "lang string")
    rows = rows.join(F.broadcast(known), "lang")
    bounds = spark.createDataFrame(list(sample_bounds(rows, "lang", "u", SAMPLE_ROWS).items()), "lang string, bound long")
    middle = F.greatest(F.lit(1), F.floor((F.length("text") - 2 * SLICE) / 2) + 1).cast("int")
    sample = rows.join(F.broadcast(bounds), "lang").where("u < bound").groupBy("lang", "u").agg(
        F.min(F.col("text").substr(middle, F.lit(2 * SLICE))).alias("t"))
    texts = defaultdict(list)
    for r in sorted(sample.collect(), key=lambda r: (r["u"], r["t"])):        # at most LANGUAGES x SAMPLE_ROWS slices
        t = letters(r["t"])[:SLICE]
        if t:
            texts[r["lang"]].append(t)
    return {lang: _dictionaries(texts[lang]) for lang in common if texts[lang]}


def _dictionaries(texts: list[str]) -> list[bytes]:
    """Slices dealt out round-robin; every dictionary is filled up to its size."""
    out = []
    for d in range(DICTIONARIES):
        mine, size = [], 0
        for t in texts[d::DICTIONARIES] or texts:
            if size >= DICT_BYTES:
                break
            b = t.encode()
            mine.append(b)
            size += len(b) + 1
        out.append(b" ".join(mine)[:DICT_BYTES])
    return out


class Classifier:
    def __init__(self, model: dict[str, list[bytes]]):
        import zstandard as zstd
        self.langs = list(model)
        self.by_dict = []
        for d in range(DICTIONARIES):
            row = []
            for lang in self.langs:
                content = zstd.ZstdCompressionDict(model[lang][d], dict_type=zstd.DICT_TYPE_RAWCONTENT)
                content.precompute_compress(level=LEVEL)
                row.append(zstd.ZstdCompressor(level=LEVEL, dict_data=content, write_content_size=False,
                                               write_checksum=False, write_dict_id=False))
            self.by_dict.append(row)

    def _sizes(self, chunks: list[bytes], dicts) -> list[int]:
        return [sum(len(row[i].compress(c)) for row in dicts for c in chunks) for i in range(len(self.langs))]

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """language, score, margin (the part by which the best total is smaller)."""
        raw = letters(text or "").encode()
        if not raw or not self.langs:
            return UNKNOWN, 0.0, 0.0
        chunks = [raw[i:i + CHUNK] for i in range(0, len(raw), CHUNK)]
        sizes = self._sizes(chunks, self.by_dict[:1])
        if len(sizes) == 1:
            return self.langs[0], 1.0, 1.0
        if self._margin(sizes) < CLOSE:
            sizes = [a + b for a, b in zip(sizes, self._sizes(chunks, self.by_dict[1:]))]
        best = sizes.index(min(sizes))                         # a tie goes to the more common language
        margin = self._margin(sizes)
        return self.langs[best], 0.5 + 0.5 * min(1.0, margin / 0.2), margin

    @staticmethod
    def _margin(sizes: list[int]) -> float:
        a, b = sorted(sizes)[:2]
        return (b - a) / b


def predict_column(docs: DataFrame, model: dict[str, list[bytes]], text_col: str = "text") -> Column:
    """struct(lang_pred, score, rejected) of a text column.  The model (a few
    hundred kilobytes, a fixed size a language) is broadcast; its compressors
    live as long as a task."""
    shared = small_batches(docs).sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        classify = Classifier(shared.value)
        for texts in batches:
            rows = [classify(t) for t in texts]
            yield pd.DataFrame({"lang_pred": [r[0] for r in rows], "score": [r[1] for r in rows],
                                "rejected": [r[2] < MIN_MARGIN for r in rows]})
        del classify
        give_back()

    return predict(F.col(text_col))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(5)) == 0, F.lit(False))


def identify(docs: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected; learned from the rows of
    ``training`` (default: ``docs``) that are not held out."""
    training = docs if training is None else training
    model = train(training.where(~held_out()))
    d = docs.select("doc_id", "text")
    return (d.withColumn("p", predict_column(d, model))
            .select("doc_id", held_out().alias("held_out"), "p.lang_pred", "p.score", "p.rejected"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` (all columns) whose language is identified."""
    model = train(docs.where(~held_out()))
    return (docs.withColumn("_lang", predict_column(docs, model)).where(~F.col("_lang.rejected"))
            .select(docs.columns))
