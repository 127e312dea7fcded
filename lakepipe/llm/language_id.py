"""Language ID (operator 5): error-correcting output codes over binary n-gram classifiers.

Every learned language gets a codeword of bits: all distinct two-way splits of the languages if there are at most
``EXHAUSTIVE``, else the best of seeded random codes. One logistic classifier per bit, on hashed byte bigrams
and trigrams of the lower-cased whole text (roots of counts, unit length), predicts whether the text's language has that bit.
Decoding weighs each bit by its logistic loss: the codeword with the least total loss wins. ``score`` is the share of
exp(-loss) that the winner has of all languages; a winner less than ``AMBIGUOUS`` nats ahead of the second is flagged.

The classifiers are fitted on a bounded sample of labelled rows: about ``PER_LANGUAGE`` of each language, ``SAMPLE``
in all, chosen by a hash of the id at a rate per language that follows its count. Only their feature vectors
(of fixed size) reach the driver; every text is then predicted on the executors from the broadcast weights.

Null texts and texts without a letter give ``und`` with score 0, as does every text if nothing was
learned; a single learned language gets score 1. Null languages are not learned. Repeated rows repeat; other columns
are ignored, and language, source and id are no inputs of a prediction.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._base import map_batches

BUCKETS = 4096
PER_LANGUAGE = 600
SAMPLE = 4000
EXHAUSTIVE = 6
AMBIGUOUS = 1.0
STEPS = 200
SCHEMA = "doc_id long, lang_pred string, score double, second string, ambiguous boolean"


def features(text: str) -> np.ndarray:
    """Hashed byte bigrams and trigrams of a whole text, as a unit vector."""
    a = np.frombuffer(f" {text.lower()} ".encode(), np.uint8).astype(np.uint32)
    two = (a[:-1] << 8) | a[1:]
    three = (two[:-1] << 8) | a[2:]
    counts = np.zeros(BUCKETS)
    for grams, salt in ((two, 0x9E3779B1), (three, 0x85EBCA6B)):
        counts += np.bincount((grams * np.uint32(salt)) >> np.uint32(20), minlength=BUCKETS)
    roots = np.sqrt(counts)
    return (roots / np.linalg.norm(roots)).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def code_matrix(k: int) -> np.ndarray:
    """Codewords (rows) of ``k`` languages as +1 and -1."""
    if k < 2:
        return np.ones((k, 0))
    if k <= EXHAUSTIVE:  # every split into two sets, the first language always in the same one
        splits = [(1, *s) for s in itertools.product((1, -1), repeat=k - 1) if -1 in s]
        return np.array(splits, float).T
    rng, best, far = np.random.default_rng(17), None, -1
    for _ in range(300):
        code = rng.choice((-1.0, 1.0), (k, int(np.ceil(10 * np.log2(k)))))
        near = min((a != b).sum() for a, b in itertools.combinations(code, 2))
        if near > far and (abs(code.sum(0)) < k).all():
            best, far = code, near
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # (BUCKETS + 1, bits)

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Total logistic loss of each language's codeword for each row."""
        margins = x @ self.weights[:-1] + self.weights[-1]
        return np.logaddexp(0, -margins[:, None, :] * self.code[None]).sum(2)


def fit(x: np.ndarray, labels: list[str]) -> Model:
    """One classifier per bit of the code, by full gradient steps with per-weight rates."""
    languages = sorted(set(labels))
    code = code_matrix(len(languages))
    y = code[[languages.index(s) for s in labels]] if labels else np.zeros((0, 0))
    w = np.zeros((BUCKETS + 1, code.shape[1]), np.float32)
    if code.shape[1]:
        x1 = np.hstack([x, np.ones((len(x), 1), np.float32)])
        seen = np.full_like(w, 1e-8)
        # languages count alike, however many rows of them were drawn
        share = np.array([1 / labels.count(s) for s in labels], np.float32)[:, None] / len(languages)
        for _ in range(STEPS):
            z = np.clip(y * (x1 @ w), -30, 30)
            g = x1.T @ (-share * y / (1 + np.exp(z))).astype(np.float32) + 1e-6 * w
            seen += g * g
            w -= (0.5 * g / np.sqrt(seen)).astype(np.float32)
    return Model(languages, code, w)


def train(labelled: DataFrame) -> Model:
    """Fit from rows (doc_id, text, lang); rows without language or letter are left out."""
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return fit(np.zeros((0, BUCKETS), np.float32), [])
    each = min(PER_LANGUAGE, max(1, SAMPLE // len(counts)))
    rate = F.create_map(*[F.lit(v) for s, n in counts.items() for v in (s, int(1e6 * min(1.0, each / n)) + 1)])
    drawn = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1_000_000)) < rate[F.col("lang")])

    def run(langs: list, texts: list) -> dict[str, list]:
        keep = [(s, features(t).astype(np.float16).tobytes()) for s, t in zip(langs, texts, strict=True) if has_letter(t)]
        return {"lang": [s for s, _ in keep], "x": [x for _, x in keep]}

    found = sorted((r.lang, bytes(r.x)) for r in map_batches(drawn, ["lang", "text"], "lang string, x binary", run).collect())
    x = np.array([np.frombuffer(v, np.float16) for _, v in found], np.float32).reshape(-1, BUCKETS)
    return fit(x, [s for s, _ in found])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Language, score, runner-up and ambiguity of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(ids: list, texts: list) -> dict[str, list]:
        m = shared.value
        out = {"doc_id": ids, "lang_pred": ["und"] * len(ids), "score": [0.0] * len(ids),
               "second": [None] * len(ids), "ambiguous": [True] * len(ids)}
        at = [i for i, t in enumerate(texts) if m.languages and has_letter(t)]
        if not at:
            return out
        losses = m.losses(np.array([features(texts[i]) for i in at]))
        order = np.argsort(losses, axis=1, kind="stable")
        best = losses.min(1)
        scores = 1 / np.exp(best[:, None] - losses).sum(1)
        for row, i in enumerate(at):
            out["lang_pred"][i] = m.languages[order[row, 0]]
            out["score"][i] = float(scores[row])
            if len(m.languages) > 1:
                out["second"][i] = m.languages[order[row, 1]]
            out["ambiguous"][i] = bool(len(m.languages) > 1
                                       and losses[row, order[row, 1]] - best[row] < AMBIGUOUS)
        return out

    return map_batches(docs, ["doc_id", "text"], SCHEMA, run)


def learn_and_identify(docs: DataFrame, held_out: Column) -> DataFrame:
    """Fit on the rows that are not held out, predict all rows."""
    model = train(docs.filter(~held_out))
    return identify(docs, model).withColumn("held_out", held_out)
