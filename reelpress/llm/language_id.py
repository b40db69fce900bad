"""Language identification by error-correcting output codes.

Every language has a codeword of bits, all columns of the exhaustive code for up to seven
languages and a fixed pseudo-random code beyond. One linear classifier per bit, on hashed
character n-grams, predicts the bits of a text. Decoding adds up, per language, the logistic
loss of each bit's margin against its codeword, weighted by how well that bit was told for that
language in training; the language with the least loss is nearest. A text is ambiguous if the
runner-up comes within ``MARGIN`` of it. It fits if the nearest codeword's weighted loss is below ``MAX_LOSS``:
log 2 is that of tossed coins, which texts of two languages reach, and far more means bits that firmly contradict
every language that was learned.

The classifiers are fitted on the driver on a bounded sample: at most ``SAMPLE_PER_LANGUAGE``
labelled texts of each language and ``SAMPLE`` in all, chosen by a hash of their ids, as feature vectors of ``FEATURES``
numbers that the executors made. Prediction reads every whole text, in blocks.

Defined results: null text or a text without a letter is ``und`` with score 0 and does not fit; if nothing
was learned every text is ``und``, but those with a letter fit; rows with null labels are not learned from; ties go to the first
language by name; repeated rows are predicted alike; an empty table gives an empty result;
input columns named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelpress.llm.common import without

#: Labelled texts of each language that are learned from, at most.
SAMPLE_PER_LANGUAGE = 500
#: Labelled texts that are learned from in all, at most; so many ids are broadcast.
SAMPLE = 10_000
#: Different labels that are learned, at most, the most frequent ones; so many counts are broadcast.
MAX_LANGUAGES = 1000
#: Texts whose features are held at a time.
TEXTS = 250
FEATURES = 2048
MARGIN = 0.2
#: Weighted loss of the nearest codeword from which a text fits no language.
MAX_LOSS = 2.0
#: Characters that are counted at a time.
BLOCK = 1 << 19
#: Stretches the features, which are small, so that gradient steps of order one suit them.
SCALE = 40.0
RESULT = ("lang_pred", "score", "ambiguous", "fits")
UNKNOWN = "und"


def letter_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def features(text: str, letters: np.ndarray) -> np.ndarray | None:
    """Square roots of the shares of hashed 1- to 3-grams of letters; None without a letter."""
    counts, any_letter = np.zeros(FEATURES, np.int64), False
    for at in range(0, len(text), BLOCK):
        part = text[max(0, at - 2) : at + BLOCK].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")
        is_letter = letters[codes]
        any_letter = any_letter or bool(is_letter.any())
        c = np.where(is_letter, codes, 32).astype(np.uint32)
        c = np.concatenate(([np.uint32(32)], c, [np.uint32(32)]))
        pair = c[:-1] * np.uint32(0x9E3779B1) + c[1:]
        for grams, keep in (
            (c, c != 32),
            (pair, (c[:-1] != 32) | (c[1:] != 32)),
            (pair[:-1] * np.uint32(0x85EBCA77) + c[2:], c[1:-1] != 32),
        ):
            mixed = grams[keep] * np.uint32(0xC2B2AE3D)
            counts += np.bincount(mixed >> np.uint32(21), minlength=FEATURES)
    if not any_letter:
        return None
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def codewords(classes: int, seed: int = 7) -> np.ndarray:
    """Rows of +1 and -1, one per class."""
    if classes <= 1:
        return np.ones((classes, 1))
    if classes <= 7:
        columns = np.arange(1, 2 ** (classes - 1))
        # bit c - 1 of the column's number says on which side class c is; class 0 is on the first
        rows = [np.zeros(len(columns), int)]
        rows += [(columns >> c) & 1 for c in range(classes - 1)]
        return 1 - 2 * np.array(rows)
    width = int(np.ceil(15 * np.log2(classes)))
    best, widest = None, -1
    for attempt in range(50):
        code = np.random.default_rng(seed + attempt).choice([-1, 1], (classes, width))
        apart = min(int((code[i] != code[j]).sum()) for i in range(classes) for j in range(i))
        if apart > widest:
            best, widest = code, apart
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Weighted loss of each row of features against each language's codeword."""
        margins = x @ self.weights + self.bias
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None])
        return (loss * self.trust[None]).sum(axis=2)


def fit(x: np.ndarray, labels: list[str], steps: int = 300, rate: float = 1.0) -> Model:
    """Logistic regression per bit, all bits at once, by gradient steps with momentum."""
    languages = sorted(set(labels))
    index = {name: i for i, name in enumerate(languages)}
    y = np.array([index[name] for name in labels])
    code = codewords(len(languages))
    target = code[y]
    share = 1 / np.bincount(y, minlength=len(languages))[y] / len(languages)
    weights, bias = np.zeros((x.shape[1], code.shape[1])), np.zeros(code.shape[1])
    dw, db = np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(steps):
        margins = SCALE * (x @ weights) + bias
        pull = -target / (1 + np.exp(np.clip(target * margins, -50, 50))) * share[:, None]
        dw = 0.9 * dw - rate * (x.T @ pull + 1e-5 * weights)
        db = 0.9 * db - rate * pull.sum(axis=0)
        weights, bias = weights + dw, bias + db
    weights = weights * SCALE
    right = (np.sign(x @ weights + bias) == target).astype(float)
    trust = np.array([right[y == c].mean(axis=0) for c in range(len(languages))])
    trust = (trust + 1e-6) / (trust + 1e-6).sum(axis=1, keepdims=True)
    return Model(languages, code, weights, bias, trust)


def train(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> Model | None:
    """The model of a bounded sample of ``labelled``; None if it has no text with a letter."""
    known = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = known.groupBy(F.col(lang).alias("of")).agg(F.count("*").alias("n"))
    counts = counts.orderBy(F.desc("n"), "of").limit(MAX_LANGUAGES)  # rarer ones are not learned
    languages = counts.count()
    most = min(per_language, SAMPLE // max(1, languages))
    # a few times as many ids as wanted, by their hash, whatever the number of rows or tasks
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(1 << 30)
    first = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = (
        known.select(F.col(lang).alias("lang"), F.col(doc_id).alias("id"))
        .join(F.broadcast(counts), F.col("lang") == F.col("of"))
        .where(share * F.col("n") < 4 * most + 50)
        .withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= most)
        .select(F.col("id").alias("chosen_id")).distinct()
    )
    sample = known.select(
        F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text")
    ).join(F.broadcast(chosen), F.col("id").eqNullSafe(F.col("chosen_id")), "left_semi")

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = letter_table()
        for batch in batches:
            made = [features(t, letters) for t in batch["text"]]
            keep = [v is not None for v in made]
            yield pd.DataFrame(
                {
                    "id": batch["id"][keep],
                    "lang": batch["lang"][keep],
                    "x": [v.tobytes() for v in made if v is not None],
                }
            )

    rows = (
        sample.select(F.col("id").cast("string").alias("id"), "lang", "text")
        .mapInPandas(vectors, "id string, lang string, x binary")
        .dropDuplicates(["id", "lang"])
        .collect()
    )
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], r["id"] or ""))
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in rows])
    return fit(x, [r["lang"] for r in rows])


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1), ambiguous and fits."""
    plain = without(docs.withColumn("__text", F.col(text)), *RESULT)
    if model is None:
        return plain.withColumns(
            {
                "lang_pred": F.lit(UNKNOWN),
                "score": F.lit(0.0),
                "ambiguous": F.lit(True),
                "fits": F.coalesce(F.col("__text").rlike(r"\p{L}"), F.lit(False)),
            }
        ).drop("__text")
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean, fits boolean")
    def tell(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters, known = letter_table(), Model(**shared.value)
        for texts in parts:
            told = [_tell(texts[at : at + TEXTS], letters, known) for at in range(0, len(texts), TEXTS)]
            if told:
                yield pd.concat(told, ignore_index=True)

    told = plain.withColumn("__told", tell("__text"))
    return told.withColumns({name: F.col(f"__told.{name}") for name in RESULT}).drop(
        "__told", "__text"
    )


def _tell(texts: pd.Series, letters: np.ndarray, known: Model) -> pd.DataFrame:
    made = [None if t is None else features(t, letters) for t in texts]
    at = [i for i, v in enumerate(made) if v is not None]
    names = np.full(len(made), UNKNOWN, object)
    scores, unsure = np.zeros(len(made)), np.ones(len(made), bool)
    fits = np.zeros(len(made), bool)
    if at:
        losses = known.losses(np.stack([made[i] for i in at]))
        best = losses.argmin(axis=1)
        odds = np.exp(-2 * (losses - losses.min(axis=1, keepdims=True)))
        near = np.sort(losses, axis=1)
        fits[at] = near[:, 0] < MAX_LOSS
        names[at] = np.array(known.languages, object)[best]
        scores[at] = 1 / odds.sum(axis=1)
        unsure[at] = near[:, 1] - near[:, 0] < MARGIN if near.shape[1] > 1 else False
    return pd.DataFrame({"lang_pred": names, "score": scores, "ambiguous": unsure, "fits": fits})


def held_out(doc_id: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """Learns from the labelled rows that are not held out and predicts all rows."""
    model = train(docs.where(~held_out(doc_id)), text, lang, doc_id)
    return predict(docs, model, text)
