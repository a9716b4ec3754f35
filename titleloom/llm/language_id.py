"""Language identification in two steps: the language family, then one-versus-one linear SVMs within it.

Features are hashed byte n-grams of the whole lower-cased text, as a unit vector of square roots of counts.
Classifiers are fitted on a sample of labelled rows of bounded size; feature vectors, not texts, come to the
driver. Prediction is one pass over the texts without a shuffle.

Defined results
    * Null and empty texts, and texts without a letter, are ``und`` with score 0.
    * A null id is hashed as the empty string, so such rows are learned from.
    * Equal texts get equal predictions; votes that tie go to the larger sum of margins, then to the
      language that comes first in code point order.
    * Without labelled rows every text is ``und``. With one language every text with a letter is that one.
    * Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleloom.llm.common import blob, other_columns_aside

UNDETERMINED = "und"
#: Length of a feature vector, and the n-gram lengths that are hashed into it.
FEATURES = 1 << 12
NGRAMS = (1, 2, 3, 4)
#: Labelled rows to fit on: expected number for each language, most in all.
PER_LANGUAGE = 400
MOST_ROWS = 8000
#: One row in so many is held out from learning.
FOLDS = 3
#: Score below which a document is rejected where documents are filtered.
LEAST_SCORE = 0.3
HELD_OUT_FOLD = 1

# Families of languages by ISO 639-1 code. Any other language is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "indo-aryan": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "uralic": "et fi hu",
    "turkic": "az kk ky tk tr tt ug uz",
    "semitic": "am ar he mt ti",
    "dravidian": "kn ml ta te",
    "austronesian": "id jv mg ms su tl",
    "sinitic": "zh yue",
    "bantu": "rw sw xh zu",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

#: Letters of ASCII in lower case, a blank for the rest of ASCII; other bytes stay.
_LETTERS = bytes(c if c > 127 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_MULTIPLIER = np.uint32(0x9E3779B1)
_PIECE = 1 << 20


def features(text: bytes) -> np.ndarray:
    """Unit vector of a UTF-8 text, as 32-bit floats."""
    plain = b" ".join(text.decode("utf-8", "replace").lower().encode().translate(_LETTERS).split())
    counts = np.zeros(FEATURES, np.int64)
    overlap = max(NGRAMS) - 1
    for begin in range(0, len(plain), _PIECE):
        data = np.frombuffer(plain[begin : begin + _PIECE + overlap], np.uint8).astype(np.uint32)
        code = np.zeros(len(data), np.uint32)
        for n in range(1, max(NGRAMS) + 1):
            code = (code[: len(data) - n + 1] + data[n - 1 :] + np.uint32(n)) * _MULTIPLIER
            code ^= code >> np.uint32(15)
            if n in NGRAMS:
                counts += np.bincount(code[:_PIECE] >> np.uint32(20), minlength=FEATURES)
    weight = np.sqrt(counts).astype(np.float32)
    return weight / max(np.linalg.norm(weight), 1e-9)


def fit_svm(rows: np.ndarray, positive: np.ndarray, cost: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights of a linear SVM with squared hinge loss, by dual coordinate descent; the last one is the bias."""
    rows = np.hstack([rows, np.ones((len(rows), 1), np.float32)])
    sign = np.where(positive, 1.0, -1.0)
    weights, alpha = np.zeros(rows.shape[1]), np.zeros(len(rows))
    square = (rows.astype(np.float64) ** 2).sum(1) + 0.5 / cost
    order = np.random.default_rng(0)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            slope = sign[i] * (rows[i] @ weights) - 1 + alpha[i] * 0.5 / cost
            step = max(alpha[i] - slope / square[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                weights += step * sign[i] * rows[i]
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return weights.astype(np.float32)


def _chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-4 * np.clip(margin, -50, 50)))


@dataclass
class LanguageModel:
    """One SVM per family against the others, and one per pair of languages of a family."""

    families: dict[str, list[str]] = field(default_factory=dict)
    family_weights: np.ndarray | None = None
    pair_weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fit(cls, rows: np.ndarray, languages: list[str]) -> LanguageModel:
        named = np.array(languages, object)
        model = cls()
        for language in sorted(set(languages)):
            model.families.setdefault(_FAMILY.get(language, language), []).append(language)
        kin = np.array([_FAMILY.get(language, language) for language in languages], object)
        if len(model.families) > 1:
            model.family_weights = np.stack([fit_svm(rows, kin == family) for family in model.families])
        for family, members in model.families.items():
            pairs = []
            for one, other in combinations(members, 2):
                pick = (named == one) | (named == other)
                pairs.append(fit_svm(rows[pick], named[pick] == one))
            if pairs:
                model.pair_weights[family] = np.stack(pairs)
        return model

    def predict(self, vector: np.ndarray) -> tuple[str, float]:
        """Language and confidence of a text that has letters."""
        names = list(self.families)
        if not names:
            return UNDETERMINED, 0.0
        family, sure = names[0], 1.0
        if self.family_weights is not None:
            margin = self.family_weights[:, :-1] @ vector + self.family_weights[:, -1]
            best = int(np.argmax(margin))
            family = names[best]
            sure = float(_chance((margin[best] - np.max(np.delete(margin, best))) / 2))
        members = self.families[family]
        if len(members) == 1:
            return members[0], sure
        weights = self.pair_weights[family]
        margin = weights[:, :-1] @ vector + weights[:, -1]
        votes, sums, chance = np.zeros(len(members)), np.zeros(len(members)), np.zeros(len(members))
        for (one, other), m in zip(combinations(range(len(members)), 2), margin, strict=True):
            votes[one if m >= 0 else other] += 1
            sums[one] += m
            sums[other] -= m
            chance[one] += _chance(m)
            chance[other] += _chance(-m)
        best = max(range(len(members)), key=lambda k: (votes[k], sums[k], -k))
        return members[best], sure * float(chance[best]) / (len(members) - 1)


def held_out(id: str = "doc_id") -> Column:
    """Whether a row is kept from learning."""
    key = F.coalesce(F.col(id).cast("string"), F.lit(""))
    return F.crc32(key) % FOLDS == HELD_OUT_FOLD


def _has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit_languages(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = PER_LANGUAGE,
    most_rows: int = MOST_ROWS,
) -> LanguageModel:
    """Fit on labelled rows outside the held-out fold: in each language a share of them by a hash of id and text.

    The share comes from the number of rows of the language, so some ``per_language`` rows are taken, and no
    more than ``most_rows`` in all even if rows repeat.
    """
    rows = docs.select(
        F.col(lang).cast("string").alias("lang"),
        F.xxhash64(F.col(id).cast("string"), F.col(text)).bitwiseAND(F.lit((1 << 52) - 1)).alias("key"),
        F.col(text).cast("string").alias("text"),
    ).filter(F.col("lang").isNotNull() & ~held_out(id) & _has_letters(F.col("text")))
    counts = {row["lang"]: row["n"] for row in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return LanguageModel()
    share = max(2, min(per_language, most_rows // (2 * len(counts))))
    last = F.create_map(*[F.lit(x) for name, n in sorted(counts.items()) for x in (name, min(1.0, share / n) * (1 << 52))])
    sample = rows.filter(F.col("key") < last[F.col("lang")]).select("lang", "text")

    def vectors(batches):
        for batch in batches:
            column = batch.column("text")
            found = [features(blob(column, i)).tobytes() for i in range(len(batch))]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(found, pa.binary())], ["lang", "vector"])

    got = sample.mapInArrow(vectors, "lang string, vector binary").limit(most_rows).collect()
    got = sorted((r["lang"], bytes(r["vector"])) for r in got)
    if not got:
        return LanguageModel()
    return LanguageModel.fit(np.stack([np.frombuffer(v, np.float32) for _, v in got]), [name for name, _ in got])


def predict_languages(
    docs: DataFrame, model: LanguageModel, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """``docs`` with the predicted language and its score; columns of these names are replaced."""
    others = [name for name in docs.columns if name not in names]
    letters = F.when(_has_letters(F.col(text)), 1.0).otherwise(0.0)
    marked = docs.select(*others, F.lit("").alias(names[0]), letters.alias(names[1]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        model = shared.value
        for batch in batches:
            column, letters = batch.column(text), batch.column(names[1]).to_pylist()
            found = [
                model.predict(features(blob(column, i))) if letters[i] else (UNDETERMINED, 0.0)
                for i in range(len(batch))
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())],
                names=batch.schema.names,
            )

    return marked.mapInArrow(predict, marked.schema)


@other_columns_aside
def keep_identified(
    docs: DataFrame, least: float = LEAST_SCORE, id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Rows of ``docs`` whose language is told with at least the score ``least``, all columns as they are.

    Without labelled rows there is no language to tell, and rows with letters stay.
    """
    model = fit_languages(docs, id, text, lang)
    if not model.families:
        return docs.filter(_has_letters(F.col(text).cast("string")))
    names = ("_lang_pred", "_lang_score")
    found = predict_languages(docs, model, text, names)
    sure = (F.col(names[0]) != UNDETERMINED) & (F.col(names[1]) >= least)
    return found.filter(sure).select(*docs.columns)


def identify_languages(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per document the id, ``held_out``, ``lang_pred`` and ``score``."""
    model = fit_languages(docs, id, text, lang)
    rows = docs.select(F.col(id), held_out(id).alias("held_out"), F.col(text).cast("string").alias("_text"))
    return predict_languages(rows, model, "_text").select(id, "held_out", "lang_pred", "score")
