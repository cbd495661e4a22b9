"""Languages of texts by a string kernel.

The kernel of two passages is the number of hash places (8,192) of character n-grams of 1 to
4 letters that both have (a blended spectrum of presences, in which n-grams that share a place
count as one), over the root of the product of their sizes. A
sample of passages serves as Nystroem landmarks; one kernel ridge regression for each
language tells it from the rest. Passages are scored in batches by matrix products, and a
text's score is the mean of its passages', weighted by length, so whole texts count and
long ones are scored like short ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclens.llm.common import free_name, map_texts, with_results
from topiclens.llm.fitting import bounded_sample, text_remainder

#: Labelled rows to fit on, for each language, and the most passages of them.
FIT_ROWS = 400
FIT_PASSAGES = 1500
LANDMARKS = 128
PASSAGE = 2000
BATCH = 64
GRAMS = 4
#: n-grams are told apart by hashes of this many values.
WIDTH = 1 << 13
RIDGE = 1e-3
NO_LANGUAGE = "und"


@dataclass
class KernelModel:
    """Landmarks, their part of the regression, and the languages it tells apart."""

    languages: list[str]
    landmarks: object  # float32, width x landmarks
    weights: object  # float32, landmarks x languages


def passages(text: str, size: int = PASSAGE) -> list[str]:
    """A text's letters, other characters as one space, in passages of `size` characters."""
    import regex

    body = regex.sub(r"[^\p{L}\p{M}]+", " ", text.lower()).strip()
    if not body:
        return []
    # The last passage is at least half as long as the others.
    n = max(1, round(len(body) / size))
    step = -(-len(body) // n)
    return [body[i : i + step] for i in range(0, len(body), step)]


def presences(parts: list[str], width: int = WIDTH, grams: int = GRAMS):
    """A row for each passage: which n-grams it has; and the root of each row's sum."""
    import numpy as np

    joined = " " + " ".join(parts) + " "
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    sizes = np.array([len(p) + 1 for p in parts])
    row = np.repeat(np.arange(len(parts), dtype=np.int32) * width, sizes)
    row = np.append(row, row[-1:])
    out = np.zeros(len(parts) * width, np.float32)
    # Passages meet at a space: n-grams over it are left out, so none spans two passages.
    rolled = np.zeros(len(codes), np.uint32)
    for n in range(grams):
        m = len(codes) - n
        rolled = rolled[:m] * np.uint32(0x9E3779B1) + codes[n:]
        mixed = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        place = (mixed >> np.uint32(32 - width.bit_length() + 1)).astype(np.int32) + row[:m]
        out[place if n < 2 else place[row[:m] == row[n - 1 : n - 1 + m]]] = 1
    out = out.reshape(len(parts), width)
    return out, np.sqrt(np.maximum(out.sum(axis=1, keepdims=True), 1))


def _kernel(parts: list[str], landmarks):
    """Kernel values of passages with the landmarks, which are scaled already."""
    rows, roots = presences(parts)
    return (rows @ landmarks) / roots


def _spread(items: list, most: int) -> list:
    """All items, or `most` of them at even distances: all texts of the sample are drawn from."""
    n = len(items)
    return items if n <= most else [items[i * n // most] for i in range(most)]


def _fit(texts: list[str], langs: list[str], most_passages: int = FIT_PASSAGES) -> KernelModel:
    """Ridge regression on the kernel's Nystroem form. texts: in an order of no meaning."""
    import numpy as np

    languages = sorted(set(langs))
    parts, ys = [], []
    for k, lang in enumerate(languages):
        own = _spread([p for t, x in zip(texts, langs) if x == lang for p in passages(t)], most_passages)
        parts += own
        ys += [k] * len(own)
    if not parts:
        return KernelModel([], np.zeros((WIDTH, 0), np.float32), np.zeros((0, 0), np.float32))
    ys = np.array(ys)
    rng = np.random.default_rng(7)
    each = max(1, LANDMARKS // len(languages))
    chosen = np.concatenate([
        rng.permutation(np.flatnonzero(ys == k))[:each] for k in range(len(languages))
    ])
    rows, roots = presences([parts[i] for i in chosen])
    landmarks = np.ascontiguousarray((rows / roots).T)
    between = (landmarks.T @ landmarks).astype(np.float64)
    gram = np.zeros_like(between)
    target = np.zeros((len(chosen), len(languages)))
    share = np.bincount(ys, minlength=len(languages))
    for a in range(0, len(parts), BATCH):
        kernel = _kernel(parts[a : a + BATCH], landmarks).astype(np.float64)
        # Each language weighs the same.
        weight = 1 / share[ys[a : a + BATCH]]
        signs = np.where(ys[a : a + BATCH, None] == np.arange(len(languages)), 1.0, -1.0)
        gram += kernel.T @ (kernel * weight[:, None])
        target += kernel.T @ (signs * weight[:, None])
    weights = np.linalg.solve(gram + RIDGE * between + 1e-9 * np.eye(len(chosen)), target)
    return KernelModel(languages, landmarks, weights.astype(np.float32))


def fit(labelled: DataFrame, id: str = "doc_id", text: str = "text", label: str = "lang", per_label: int = FIT_ROWS, most_passages: int = FIT_PASSAGES) -> KernelModel:
    """A model from about `per_label` rows of each label, which the driver holds.

    Of more than `most_passages` passages of a label, so many are fitted on, at even distances.
    Rows with a null text or label are left out. Without rows the model knows no language.
    """
    used = labelled.select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").alias("label")
    ).where("text IS NOT NULL AND label IS NOT NULL")
    rows = bounded_sample(used, "label", "id", per_label).collect()
    rows = sorted(rows, key=lambda r: (str(r["id"]), r["text"]))
    return _fit([r["text"] for r in rows], [r["label"] for r in rows], most_passages)


def _scorer(model: KernelModel):
    import numpy as np

    def apply(texts: list[str | None]) -> tuple[list[str], list[float]]:
        parts, owner, sizes = [], [], []
        for i, t in enumerate(texts):
            for p in passages(t) if t else []:
                parts.append(p)
                owner.append(i)
                sizes.append(len(p))
        total = np.zeros((len(texts), len(model.languages)))
        weight = np.zeros(len(texts))
        for a in range(0, len(parts), BATCH):
            made = _kernel(parts[a : a + BATCH], model.landmarks) @ model.weights
            size = np.array(sizes[a : a + BATCH], np.float64)
            np.add.at(total, owner[a : a + BATCH], made * size[:, None])
            np.add.at(weight, owner[a : a + BATCH], size)
        langs, scores = [], []
        for row, w in zip(total, weight):
            if not w or not len(row):
                langs.append(NO_LANGUAGE)
                scores.append(0.0)
                continue
            k = int(np.argmax(row))
            langs.append(model.languages[k])
            # Regression targets are -1 and 1.
            scores.append(float(min(1.0, max(0.0, (row[k] / w + 1) / 2))))
        return langs, scores

    return apply


def identified(docs: DataFrame, model: KernelModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, lang_pred, score), a row for each row of docs.

    Texts that are null or have no letter are `und` with a score of 0, as are all texts if
    the model knows no language; ties go to the first language in alphabetical order. No
    other column is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a size fixed above
    kind = docs.schema[id].dataType.simpleString()

    def make():
        score = _scorer(shared.value)
        return lambda ids, texts: [ids, *score(texts)]

    out = map_texts(docs, [id, text], make, f"id {kind}, lang_pred string, score double")
    return out.withColumnRenamed("id", id)


def in_known_languages(docs: DataFrame, model: KernelModel, text: str = "text") -> DataFrame:
    """The rows of docs whose text has a letter; all columns stay as they are.

    The prediction rejects no text with a letter, also if the model knows no language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        if not shared.value.languages:
            return lambda texts: [["" if t and passages(t) else NO_LANGUAGE for t in texts]]
        score = _scorer(shared.value)
        return lambda texts: [score(texts)[0]]

    name = free_name(docs, "lang_pred")
    told = with_results(docs, text, make, f"{name} string")
    return told.where(F.col(name) != NO_LANGUAGE).drop(name)


def identify_held_out(docs: DataFrame, id: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score): fitted on the rows that are not held out."""
    remainder = text_remainder(F.col(f"`{id}`"), 4)
    model = fit(docs.where(remainder != 2), id, text, label)
    out = identified(docs, model, id, text)
    held = F.coalesce(text_remainder(F.col(f"`{id}`"), 4) == 2, F.lit(False))
    return out.select(id, held.alias("held_out"), "lang_pred", "score")
