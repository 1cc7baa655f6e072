"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text in lower case, white space runs made one blank, is cut into all its
n-grams of 1 to 3 characters; each is hashed to one of 2**14 features per
length. Training sums the counts per language in Spark; the matrix of
log-probabilities (features x languages, of bounded size) is broadcast, and a
batch of texts is scored at once as a sparse matrix whose rows are the texts.

Training reads at most ``sample`` documents a language, drawn by a hash of the
text; predictions see nothing but the text.

Defined results: a text that is null or has no letter is ``und`` with score 0;
so is every text if there is nothing to learn from. Equal scores go to the
language first by code point.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalframe.llm.shared import packed, unpacked

GRAMS = (1, 2, 3)
BITS = 14
SMOOTHING = 0.5
#: Documents a language that training reads at most, about.
SAMPLE = 4000
MAX_MATRIX_BYTES = 256 << 20
UNDETERMINED = "und"
#: Characters that are worked on at a time; the arrays of a slab are some 80 times as large.
_SLAB = 1 << 17


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_prior: np.ndarray
    #: One row per feature, one column per language.
    log_likelihood: np.ndarray


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all n-grams, one row per length and one column per character, and where each text begins.

    Each text gets a blank on either side, so that word edges count at its ends too.
    """
    clean = [f" {' '.join(t.lower().split())} " for t in texts]
    begins = np.cumsum([0, *map(len, clean)])
    chars = np.frombuffer("".join(clean).encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.empty((len(GRAMS), len(chars)), np.int32)
    gram = np.zeros(len(chars), np.uint32)
    for i, n in enumerate(GRAMS):
        # The hash of n characters from that of the n - 1 before; what reaches over a text's edge is two blanks at least.
        gram = gram * np.uint32(0x01000193)
        gram[: len(chars) - n + 1] += chars[n - 1 :]
        mixed = (gram ^ gram >> np.uint32(15)) * np.uint32(0x9E3779B1)
        out[i] = (mixed >> np.uint32(32 - BITS)).astype(np.int32) + (i << BITS)
    return out, begins


def _slabs(texts: pd.Series) -> Iterator[list[int]]:
    """Positions of texts that together have about _SLAB characters."""
    part, size = [], 0
    for i, t in enumerate(texts):
        part.append(i)
        size += len(t)
        if size >= _SLAB:
            yield part
            part, size = [], 0
    if part:
        yield part


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(documents: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    known = documents.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter(F.col("lang").isNotNull() & has_letter(F.col("text")))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    n_features = len(GRAMS) << BITS
    if n_features * len(languages) * 4 > MAX_MATRIX_BYTES:
        raise ValueError(f"{len(languages)} languages: the matrix would not fit into {MAX_MATRIX_BYTES} bytes")
    if not languages:
        return Model([], np.zeros(0), np.zeros((n_features, 0), np.float32))
    number = {name: i for i, name in enumerate(languages)}
    # One in so many of each language; a hash of the text decides, so copies go together.
    thin = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, max(1, round(n / sample)))])
    drawn = known.filter(F.pmod(F.xxhash64("text"), thin[F.col("lang")]) == 0)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(languages), n_features), np.int64)
        for b in batches:
            for part in _slabs(b["text"]):
                found, begins = features(list(b["text"].iloc[part]))
                label = np.repeat(b["lang"].iloc[part].map(number).to_numpy(), np.diff(begins))
                np.add.at(total, (label[None, :].repeat(len(GRAMS), 0), found), 1)
        language, feature = np.nonzero(total)
        yield pd.DataFrame({"language": language, "feature": feature, "n": total[language, feature]})

    counted = drawn.select("text", "lang").mapInPandas(count, "language long, feature long, n long")
    sums = counted.groupBy("language", "feature").agg(F.sum("n").alias("n")).toPandas()
    counts = np.full((n_features, len(languages)), SMOOTHING)
    counts[sums["feature"], sums["language"]] += sums["n"]
    by_length = counts.reshape(len(GRAMS), -1, len(languages))
    likelihood = np.log(by_length / by_length.sum(1, keepdims=True)).reshape(n_features, -1)
    prior = np.log(np.array([sizes[name] for name in languages]) / sum(sizes.values()))
    return Model(languages, prior, likelihood.astype(np.float32))


def score(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the best language of each text, and its posterior probability."""
    found, begins = features(texts)
    joint = np.tile(model.log_prior, (len(texts), 1))
    for row in found:
        # Row sums of a sparse matrix of ones times the log-probabilities.
        joint += np.add.reduceat(model.log_likelihood[row], begins[:-1], axis=0, dtype=np.float64)
    best = joint.argmax(1)
    odds = np.exp(joint - joint[np.arange(len(joint)), best][:, None])
    return best, 1 / odds.sum(1)


def predict(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows with ``lang_pred`` and ``score``; extra columns of that name are replaced."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def judged(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        name = np.full(len(texts), UNDETERMINED, object)
        sure = np.zeros(len(texts))
        if m.languages:
            given = np.nonzero(texts.notna().to_numpy())[0]
            for part in _slabs(texts.iloc[given]):
                at = given[part]
                best, sure[at] = score(m, list(texts.iloc[at]))
                name[at] = np.array(m.languages, object)[best]
        return pd.DataFrame({"lang_pred": name, "score": sure})

    rows = documents.select(packed(documents).alias("_row"))
    body = F.col("_row")[text]
    # A text without letters reaches the model as null.
    out = rows.withColumn("_found", judged(F.when(has_letter(body), body)))
    kept = [c for c in documents.columns if c not in ("lang_pred", "score")]
    return out.select(*[F.col("_row")[c].alias(c) for c in kept], "_found.lang_pred", "_found.score")


def keep_identified(documents: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Documents whose language is found with at least that probability, unchanged."""
    rows = documents.select(packed(documents).alias("_row"), F.col("text").alias("text"))
    judged = predict(rows, model)
    return unpacked(judged.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)).select("_row"))
