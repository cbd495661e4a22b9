"""Quality of documents by a linear-chain conditional random field over their lines.

Each line is good or bad. Its score depends on its own signs and on its neighbours', and on
whether the line before is good. Forward-backward gives each line's chance of being good; a
document's quality is their mean, weighted by length, put on the labels' scale. For fitting,
the lines of a labelled document have its label.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclens.llm.common import map_texts
from topiclens.llm.fitting import bounded_sample, text_remainder

#: Labelled rows to fit on, for each label.
FIT_ROWS = 2000
ROUNDS = 250
#: Characters whose lines are measured together.
SEGMENT = 1 << 19
PENALTY = 1e-3
#: Most that a change or a stay between lines may weigh.
HOLD = 1.5


@dataclass
class ChainModel:
    mean: object
    scale: object
    weights: object
    moves: object  # score of going from a label to a label
    slope: float
    offset: float


def line_signs(texts: list[str]):
    """Of all lines with a character: their signs, their length and the number of their text."""
    import numpy as np

    joined = "\n".join(texts) + "\n"
    owner = np.repeat(np.arange(len(texts)), [t.count("\n") + 1 for t in texts])
    signs, marks, start = [], [], 0
    while start < len(joined):
        # Some lines at a time, as the work on a line takes many times its size.
        stop = joined.find("\n", start + SEGMENT) + 1 or len(joined)
        made = _signs_of(joined[start:stop])
        signs.append(made[0])
        marks.append(made[1])
        start = stop
    signs, marks = np.concatenate(signs), np.concatenate(marks)
    marks ^= owner.astype(np.uint64) << np.uint64(40)
    _, back, times = np.unique(marks, return_inverse=True, return_counts=True)
    solid = signs[:, 0]
    kept = solid > 0
    again = (times[back] > 1).astype(float)[:, None]
    return np.concatenate([signs[:, 1:], again], axis=1)[kept], solid[kept], owner[kept]


def _signs_of(lines: str):
    """Of each line: its number of solid characters, its signs, and a hash of its text."""
    import numpy as np

    codes = np.frombuffer(lines.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.flatnonzero(codes == 10)
    starts = np.append(0, ends[:-1] + 1)

    def total(mask):
        run = np.append(0, np.cumsum(mask, dtype=np.int32))
        return (run[ends] - run[starts]).astype(np.float64)

    upper = ((codes >= 65) & (codes <= 90)) | ((codes >= 0xC0) & (codes <= 0xDE) & (codes != 0xD7))
    lower = ((codes >= 97) & (codes <= 122)) | ((codes >= 0xDF) & (codes != 0xF7))
    digit = (codes >= 48) & (codes <= 57)
    space = (codes == 32) | ((codes >= 9) & (codes <= 13)) | (codes == 0xA0)
    point = (codes == 46) | (codes == 44) | (codes == 59) | (codes == 39)
    loud = (codes == 33) | (codes == 63)
    bar = codes == 124
    other = ~(upper | lower | digit | space | point | loud | bar)
    begins = ~space & np.append(True, space[:-1])
    again = np.append(False, codes[1:] == codes[:-1]) & ~space
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    repeated = _repeated(begins, space, mixed)
    size = (ends - starts).astype(np.float64)
    solid = size - total(space & (codes != 10))
    words = total(begins)
    # A line is told from others by a sum of its mixed characters and their places.
    place = (np.arange(len(codes)) - np.repeat(starts, ends - starts + 1)).astype(np.uint64)
    mixed *= place * np.uint64(2) + np.uint64(1)
    run = np.append(np.uint64(0), np.cumsum(mixed, dtype=np.uint64))
    n, wide = np.maximum(solid, 1), np.maximum(words, 1)
    signs = np.stack([
        solid, np.log1p(size), np.log1p(words), solid / wide,
        total(upper) / n, total(digit) / n, total(point) / n, total(loud) / n, total(bar) / n,
        total(other) / n, total(other) / wide, total(bar) / wide, total(loud) / wide,
        total(again) / n, total(repeated) / wide, (words < 3).astype(float),
    ], axis=1)
    return signs, run[ends] - run[starts]


def _repeated(begins, space, mixed):
    """Whether a word starts here that is one of the two words before it."""
    import numpy as np

    at = np.flatnonzero(begins)
    run = np.append(np.uint64(0), np.cumsum(np.where(space, np.uint64(0), mixed), dtype=np.uint64))
    word = np.diff(run[np.append(at, len(begins))])
    out = np.zeros(len(begins), bool)
    out[at[1:]] |= word[1:] == word[:-1]
    out[at[2:]] |= word[2:] == word[:-2]
    return out


def with_neighbours(signs, owner):
    """A line's signs, and those of the lines before and after it in its text."""
    import numpy as np

    before, after = np.zeros_like(signs), np.zeros_like(signs)
    inner = np.flatnonzero(owner[1:] == owner[:-1]) + 1  # lines with one before them
    before[inner], after[inner - 1] = signs[inner - 1], signs[inner]
    edge = np.ones((len(signs), 1))
    edge[inner] = 0
    return np.concatenate([signs, before, after, edge, np.ones((len(signs), 1))], axis=1)


def chances(good, owner, moves):
    """Forward-backward: each line's chance of being good; of each line that has one before
    it, the chances of the four moves, and its number.

    good: a line's score for good over bad; owner: the line's text, in order.
    """
    import numpy as np

    if not len(good):
        return np.zeros(0), np.zeros((0, 2, 2)), np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    length = np.diff(np.append(first, len(owner)))
    score = np.stack([np.zeros_like(good), good], axis=1)
    ahead, behind = score.copy(), np.zeros_like(score)
    longest = int(length.max())
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    counts = np.searchsorted(-length, -np.arange(longest), side="left")  # texts longer than t
    for t in range(1, longest):
        i = first[: counts[t]] + t
        ahead[i] += np.logaddexp(ahead[i - 1, :1] + moves[0], ahead[i - 1, 1:] + moves[1])
    for t in range(longest - 1, 0, -1):
        i = first[: counts[t]] + t
        onward = behind[i] + score[i]
        behind[i - 1] = np.logaddexp(moves[:, 0] + onward[:, :1], moves[:, 1] + onward[:, 1:])
    both = ahead + behind
    whole = np.logaddexp(both[:, 0], both[:, 1])
    inner = np.flatnonzero(np.append(False, owner[1:] == owner[:-1]))
    pair = (
        ahead[inner - 1][:, :, None] + moves[None] + (behind[inner] + score[inner])[:, None, :]
    ) - whole[inner][:, None, None]
    return np.exp(both[:, 1] - whole), np.exp(pair), inner


def _means(good, sizes, owner, texts: int):
    import numpy as np

    total = np.bincount(owner, weights=sizes, minlength=texts)
    held = np.bincount(owner, weights=sizes * good, minlength=texts)
    return np.where(total > 0, held / np.maximum(total, 1e-9), 0.0)


def _fit(texts: list[str], labels: list[int]) -> ChainModel:
    """Conditional maximum likelihood with a quadratic penalty; each text weighs the same."""
    import numpy as np

    signs, sizes, owner = line_signs(texts) if texts else (np.zeros((0, 16)), np.zeros(0), np.zeros(0, int))
    x = with_neighbours(signs, owner)
    y = np.array(labels, np.float64)
    if not len(x) or y.min() == y.max():
        share = 1.0 if len(y) and y.min() == 1 else 0.0
        k = 50 if not len(x) else x.shape[1]
        return ChainModel(np.zeros(k), np.ones(k), np.zeros(k), np.zeros((2, 2)), 0.0, 12.0 * share - 6.0)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean[-1], scale[-1] = 0, 1
    scale[scale < 1e-9] = 1
    x = np.clip((x - mean) / scale, -8, 8)
    lines = np.bincount(owner, minlength=len(y))
    # Each label weighs the same, too.
    share = np.array([(y == 0).sum(), (y == 1).sum()])
    weight = (1 / share[y.astype(int)] / np.maximum(lines, 1))[owner] / 2
    target = y[owner]
    w, moves = np.zeros(x.shape[1]), np.zeros((2, 2))
    m, v = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    for step in range(1, ROUNDS + 1):
        good, pair, inner = chances(x @ w, owner, moves)
        g = x.T @ (weight * (good - target)) + PENALTY * w
        seen = np.zeros((len(inner), 2, 2))
        seen[np.arange(len(inner)), target[inner].astype(int), target[inner].astype(int)] = 1
        g_moves = ((pair - seen) * weight[inner][:, None, None]).sum(axis=0) + PENALTY * moves
        g = np.append(g, g_moves.ravel())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w -= move[:-4]
        moves = np.clip(moves - move[-4:].reshape(2, 2), -HOLD, HOLD)
    good, _, _ = chances(x @ w, owner, moves)
    mean_good = _means(good, sizes, owner, len(y))[lines > 0]
    slope, offset = _scaled(mean_good, y[lines > 0])
    return ChainModel(mean, scale, w, moves, slope, offset)


def _log_odds(p):
    import numpy as np

    p = np.clip(p, 0.002, 0.998)
    return np.log(p / (1 - p))


def _scaled(means, y) -> tuple[float, float]:
    """Slope and offset of a logistic regression of the labels on the means' log odds."""
    import numpy as np

    a = np.stack([_log_odds(means), np.ones(len(y))], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        hessian = a.T @ (a * (p * (1 - p))[:, None]) + 1e-2 * np.eye(2)
        beta -= np.linalg.solve(hessian, a.T @ (p - y) + 1e-2 * (beta - [1.0, 0.0]))
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", per_label: int = FIT_ROWS) -> ChainModel:
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
    return _fit([r["text"] for r in rows], [int(r["label"]) for r in rows])


def _scorer(model: ChainModel):
    import numpy as np

    def apply(texts: list[str | None]):
        """Each text's quality, and the chances of its lines."""
        signs, sizes, owner = line_signs([t or "" for t in texts])
        x = np.clip((with_neighbours(signs, owner) - model.mean) / model.scale, -8, 8)
        good, _, _ = chances(x @ model.weights, owner, model.moves)
        means = _means(good, sizes, owner, len(texts))
        scores = 1 / (1 + np.exp(-(model.slope * _log_odds(means) + model.offset)))
        ends = np.cumsum(np.bincount(owner, minlength=len(texts)))
        return scores, np.split(good, ends[:-1])

    return apply


def scored(docs: DataFrame, model: ChainModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score, line_chances), a row for each row of docs.

    line_chances: of each line that is not blank, the chance that it is good. Texts without
    such a line, and null texts, count as wholly bad.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size
    kind = docs.schema[id].dataType.simpleString()

    def make():
        score = _scorer(shared.value)
        return lambda ids, texts: [ids, *score(texts)]

    out = map_texts(docs, [id, text], make, f"id {kind}, score double, line_chances array<double>")
    return out.withColumnRenamed("id", id)


def score_held_out(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, score, predicted): fitted on the rows that are not held out."""
    model = fit(docs, labels.where(text_remainder(F.col(id), 3) != 1), id, text)
    held = F.coalesce(text_remainder(F.col(id), 3) == 1, F.lit(False))
    return scored(docs, model, id, text).select(
        id, held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
