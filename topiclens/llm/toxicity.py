"""Toxic documents and their offending sentences, learned from document labels alone.

A document is a bag of sentences, and toxic if at least one of them is: its score is the
noisy-or of the sentences' scores. A sentence's score is logistic in the words that it has,
and in the beginnings of its words.
Fitting raises the likelihood of the documents' labels; which sentence made a document
toxic comes out by itself.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclens.llm.common import map_texts
from topiclens.llm.fitting import bounded_sample, text_remainder

#: Labelled rows to fit on, for each label.
FIT_ROWS = 2000
#: Lengths of the beginnings of words that count besides whole words.
BEGINNINGS = (3, 4, 5, 6, 7)
#: Words and beginnings that toxic documents have more often than others count. By fewer standard
#: errors than this, the penalty of their weights rises with the power of what is missing.
SURE_ERRORS = 4.5
DOUBT = 4
#: Below so many standard errors, it rises no more.
FEWEST_ERRORS = 0.3
ROUNDS = 400
PENALTY = 1e-4
OFFENDING = 0.5


@dataclass
class BagModel:
    """What a sentence's words add to its log odds."""

    base: float
    words: dict[str, float]


_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W_]+")
#: Words whose signs a task remembers; when there are more, it starts anew.
REMEMBERED = 400_000


def _signs(word: str) -> list[str]:
    """A word, and its beginnings, which end in a star."""
    return [word] + [word[:n] + "*" for n in BEGINNINGS if len(word) >= n]


class _Known(dict):
    """Of each word: which of the signs in `wanted` it has."""

    def __init__(self, wanted):
        super().__init__()
        self.wanted = wanted

    def __missing__(self, word: str) -> frozenset:
        if len(self) > REMEMBERED:
            self.clear()
        found = self[word] = frozenset(self.wanted[x] for x in _signs(word) if x in self.wanted)
        return found


def _bags(text: str, known: _Known):
    """Start, end and signs of each sentence that has a word, in code points."""
    for m in _SENTENCE.finditer(text):
        words = _WORD.findall(m.group())
        if words:
            signs = [f for w in words if (f := known[w])]
            yield *m.span(), frozenset().union(*signs) if signs else frozenset()


def _telling(texts: list[str], y) -> dict[str, float]:
    """The signs that toxic documents have more often than others, and by how many standard errors."""
    counts: dict[str, list[int]] = {}
    for text, label in zip(texts, y):
        for x in {x for w in set(_WORD.findall(text)) for x in _signs(w)}:
            counts.setdefault(x, [0, 0])[int(label)] += 1
    toxic, clean = float(y.sum()), float(len(y) - y.sum())

    def errors(n: list[int]) -> float:
        whole = (n[0] + n[1]) / (toxic + clean)
        return (n[1] / toxic - n[0] / clean) / ((whole * (1 - whole) + 1e-12) * (1 / toxic + 1 / clean)) ** 0.5

    return {x: e for x, n in sorted(counts.items()) if (e := errors(n)) > 0}


def _fit(texts: list[str], labels: list[int], toxic_share: float | None = None) -> BagModel:
    """toxic_share: of all documents, where the sample's differs."""
    import numpy as np

    pairs = [(t.lower(), k) for t, k in zip(texts, labels) if _WORD.search(t)]
    y = np.array([k for _, k in pairs], np.float64)
    if not len(y) or y.min() == y.max():
        return BagModel(8.0 if len(y) and y[0] == 1 else -8.0, {})
    telling = _telling([t for t, _ in pairs], y)
    number = {x: i for i, x in enumerate(telling)}
    sure = np.clip(np.array([*telling.values()], np.float64), FEWEST_ERRORS, SURE_ERRORS)
    penalty = PENALTY * (SURE_ERRORS / sure) ** DOUBT
    known = _Known(number)
    owner, at, feature = [], [], []
    for k, (t, _) in enumerate(pairs):
        for _, _, signs in _bags(t, known):
            at += [len(owner)] * len(signs)
            feature += signs
            owner.append(k)
    row = len(owner)
    owner, at, feature = (np.array(v, np.int64) for v in (owner, at, feature))
    share = toxic_share or y.mean()
    heavy = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    w = np.zeros(len(number) + 1)
    w[-1] = -4.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, ROUNDS + 1):
        s = w[-1] + np.bincount(at, weights=w[feature], minlength=row)
        p = 1 / (1 + np.exp(-np.clip(s, -30, 30)))
        # The log of the chance that no sentence is toxic.
        none = -np.bincount(owner, weights=np.logaddexp(0, s), minlength=len(y))
        some = np.maximum(-np.expm1(none), 1e-9)
        slope = (heavy * np.where(y == 1, -np.exp(none) / some, 1.0))[owner] * p / len(y)
        g = np.append(np.bincount(feature, weights=slope[at], minlength=len(number)), slope.sum())
        g[:-1] += penalty * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return BagModel(float(w[-1]), {x: float(w[i]) for x, i in number.items()})


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", per_label: int = FIT_ROWS) -> BagModel:
    """A model from about `per_label` rows of each label, which the driver holds.

    Rows with a null text or label are left out. Without both labels, all scores are alike.
    """
    used = labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").alias("label")).where(
        "id IS NOT NULL AND label IS NOT NULL"
    )
    # The sample is bounded by per_label and the number of labels.
    chosen = F.broadcast(bounded_sample(used, "label", "id", per_label).dropDuplicates(["id"]))
    texts = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")).where("text IS NOT NULL")
    rows = sorted(texts.join(chosen, "id").collect(), key=lambda r: (str(r["id"]), r["text"]))
    share = used.agg(F.avg(F.col("label").cast("double"))).first()[0]
    return _fit([r["text"] for r in rows], [int(r["label"]) for r in rows], share)


def _scorer(model: BagModel):
    import math

    known = _Known({x: x for x in model.words})
    weight = model.words.__getitem__

    def apply(texts: list[str | None]) -> tuple[list[float], list[list[tuple[int, int, float]]]]:
        scores, found = [], []
        for t in texts:
            none, hits = 0.0, []
            for a, b, signs in _bags((t or "").lower(), known):
                s = model.base + sum(map(weight, signs))
                none += s + math.log1p(math.exp(-s)) if s > 0 else math.log1p(math.exp(s))
                p = 1 / (1 + math.exp(-s)) if s > -700 else 0.0
                if p >= OFFENDING:
                    hits.append((a, b, p))
            scores.append(-math.expm1(-none))
            found.append(hits)
        return scores, found

    return apply


def scored(docs: DataFrame, model: BagModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score, offending), a row for each row of docs.

    offending: start, end and score of the sentences that are toxic by themselves, in code
    points of the text in lower case. Null texts and texts without a word score 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    kind = docs.schema[id].dataType.simpleString()

    def make():
        score = _scorer(shared.value)

        def apply(ids, texts):
            scores, found = score(texts)
            return [ids, scores, [[{"start": a, "end": b, "score": p} for a, b, p in f] for f in found]]

        return apply

    schema = f"id {kind}, score double, offending array<struct<start:int,end:int,score:double>>"
    return map_texts(docs, [id, text], make, schema).withColumnRenamed("id", id)


def score_held_out(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, score, predicted, offending): fitted on the rows that are not held out."""
    model = fit(docs, labels.where(text_remainder(F.col(id), 5) != 0), id, text)
    held = F.coalesce(text_remainder(F.col(id), 5) == 0, F.lit(False))
    out = scored(docs, model, id, text)
    return out.select(
        id, held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending"
    )
