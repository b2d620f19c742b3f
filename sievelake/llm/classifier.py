"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of `PASSAGE` words. Every passage is encoded: shares of character classes,
shape of its words, and shares of hashed words, standardised and put through a learned tanh layer.
Gated attention, softmax over the bag of w . (tanh(V h) * sigmoid(U h)), weighs the passages; the weighted sum of
their codes is scored by a logistic unit. All weights are learned together from document labels.

Fitting takes labelled documents in the order of a hash of doc_id, of each label at most `sample` and as many as have
`budget` passages together (two documented bounds on rows; one alone above the budget is passed over), and of each all
passages; losses are weighted so that the labels count as
often as in all rows allowed. The features of that sample are written by tasks; those within the budget come to the driver, at most 188
bytes times twice the budget whatever the length of texts, which runs the gradient steps, adding up gradients over runs of about `PIECE` passages; scoring reads whole texts in tasks, all passages, with the weights as a broadcast of fixed size.

Labels are learned from rows whose crc32 of doc_id (as text) modulo 3 is not 1. Scores depend on the text alone.

Defined cases: null labels and null label ids are left out; a document labelled repeatedly has the mean label,
0.5 counting as 1; without labels of both kinds every score is 1 (only label 1, or none) or 0; a null or empty text is
one passage of zeros; a null doc_id counts as the text ''; an empty table gives an empty result; extra
columns are carried by `keep_good`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.llm.storage import keep
from sievelake.llm.text import Words, blocks

PASSAGE = 64
PIECE = 50_000
SAMPLE = 2500
#: Passages of a label that come to the driver at most.
BUDGET = 200_000
CODE = 24
GATE = 12
STEPS = 250
RATE = 0.02
DECAY = 1e-4
SEED = 9
WORD_BINS = 32

#: Character classes by byte: one each for the marks that stand out, groups for the rest.
_CLASS = np.full(256, 9, dtype=np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 3
for _n, _marks in enumerate((b"|", b"!", b"#*$%&", b".,;:?", b"<>{}[]()/\\=_^~+@"), 4):
    _CLASS[list(_marks)] = _n
CLASSES = 10
FEATURES = CLASSES + 5 + WORD_BINS


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def encoded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the first passage of each text (one more at the end)."""
    words = Words(texts)
    count = np.diff(words.first)
    passages = np.maximum(1, -(-count // PASSAGE))
    first = np.concatenate([[0], np.cumsum(passages)])
    total = int(first[-1])
    of_word = first[words.text] + (np.arange(len(words.text)) - words.first[words.text]) // PASSAGE
    size = words.ends - words.starts
    out = np.zeros((total, FEATURES), np.float32)
    if not len(size):
        return out, first
    n_words = np.bincount(of_word, minlength=total)
    n_bytes = np.bincount(of_word, weights=size, minlength=total)
    ink = np.repeat(words.starts - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum()))
    kinds = np.bincount(np.repeat(of_word, size) * CLASSES + _CLASS[words.raw[ink]], minlength=total * CLASSES)
    out[:, :CLASSES] = kinds.reshape(total, CLASSES) / np.maximum(n_bytes, 1)[:, None]
    some = np.maximum(n_words, 1)
    out[:, CLASSES] = n_bytes / some / 10
    out[:, CLASSES + 1] = np.log1p(n_words) / 5
    again = (words.hashes[1:] == words.hashes[:-1]) & (of_word[1:] == of_word[:-1])
    out[:, CLASSES + 2] = np.bincount(of_word[1:][again], minlength=total) / some
    order = np.lexsort((words.hashes, of_word))
    h, p = words.hashes[order], of_word[order]
    fresh = np.append(True, (h[1:] != h[:-1]) | (p[1:] != p[:-1]))
    out[:, CLASSES + 3] = np.bincount(p[fresh], minlength=total) / some
    long_ = size > 12
    out[:, CLASSES + 4] = np.bincount(of_word[long_], minlength=total) / some
    bins = (words.hashes >> np.uint64(59)).astype(np.int64)
    found = np.bincount(of_word * WORD_BINS + bins, minlength=total * WORD_BINS).reshape(total, WORD_BINS)
    out[:, CLASSES + 5 :] = found / some[:, None]
    return out, first


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(model: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """Everything a pass computes, by name. `first` is the first passage of each bag, without the end."""
    bag = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
    h = np.tanh(x @ model["W"] + model["b"])
    t, s = np.tanh(h @ model["V"]), _sigmoid(h @ model["U"])
    e = (t * s) @ model["w"]
    e = np.exp(e - np.maximum.reduceat(e, first)[bag])
    a = e / np.add.reduceat(e, first)[bag]
    z = np.add.reduceat(a[:, None] * h, first)
    return {"bag": bag, "h": h, "t": t, "s": s, "a": a, "z": z, "p": _sigmoid(z @ model["c"] + model["d"])}


def gradients(model, x, first, y, weight) -> dict[str, np.ndarray]:
    f = forward(model, x, first)
    bag, h, t, s, a, z = (f[k] for k in ("bag", "h", "t", "s", "a", "z"))
    out = weight * (f["p"] - y)
    dz = (out[:, None] * model["c"])[bag]
    da = (h * dz).sum(1)
    de = a * (da - np.add.reduceat(a * da, first)[bag])
    gate = de[:, None] * model["w"]
    dt, ds = gate * s * (1 - t * t), gate * t * s * (1 - s)
    dh = (a[:, None] * dz + dt @ model["V"].T + ds @ model["U"].T) * (1 - h * h)
    return {
        "W": x.T @ dh,
        "b": dh.sum(0),
        "V": h.T @ dt,
        "U": h.T @ ds,
        "w": (t * s).T @ de,
        "c": z.T @ out,
        "d": out.sum(keepdims=True),
    }


def fit(x: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = STEPS) -> dict[str, np.ndarray]:
    """Weights from bags of passages by Adam; a function of its input alone."""
    mean = np.array([c.mean(dtype=np.float64) for c in x.T])
    scale = np.array([c.std(dtype=np.float64) for c in x.T]) + 1e-3
    # runs of whole bags, of PIECE passages or of a bag that has more
    heads = np.flatnonzero(np.diff(first // PIECE, prepend=-1))
    tails = np.append(heads[1:], len(first))
    ends = np.append(first, len(x))
    rng = np.random.default_rng(SEED)
    shapes = {"W": (FEATURES, CODE), "V": (CODE, GATE), "U": (CODE, GATE), "w": (GATE,), "c": (CODE,)}
    model = {k: rng.normal(0, 1 / np.sqrt(v[0]), v) for k, v in shapes.items()} | {"b": np.zeros(CODE), "d": np.zeros(1)}
    weight = weight / weight.sum()
    m = {k: np.zeros_like(v) for k, v in model.items()}
    v = {k: np.zeros_like(x_) for k, x_ in model.items()}
    for step in range(1, steps + 1):
        total = dict.fromkeys(model, 0.0)
        for i, j in zip(heads, tails):
            piece = (x[ends[i] : ends[j]] - mean) / scale
            for k, g in gradients(model, piece, first[i:j] - first[i], y[i:j], weight[i:j]).items():
                total[k] = total[k] + g
        for k, g in total.items():
            g = g + DECAY * model[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            model[k] = model[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model | {"mean": mean, "scale": scale}


def scores(model: dict | float, texts: list[str | None]) -> np.ndarray:
    if isinstance(model, float):
        return np.full(len(texts), model)
    out = [np.zeros(0)]
    for _, _, held in blocks(texts):
        x, first = encoded(held)
        out.append(forward(model, (x - model["mean"]) / model["scale"], first[:-1])["p"])
    return np.concatenate(out)


def _featured(batches):
    """For mapInArrow: the text, in the last column, to its passages, as bytes of float32, and their count; other columns pass."""
    for batch in batches:
        *names, _ = batch.schema.names
        texts = batch.column(len(names)).to_pylist()
        for begin, end, held in blocks(texts):
            x, first = encoded(held)
            rows = [x[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
            facts = [batch.column(i).slice(begin, end - begin) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*facts, pa.array(rows, pa.binary()), pa.array(np.diff(first), pa.int64())], names=[*names, "passages", "n"]
            )


def within(sizes: list[tuple[int, int, int]], budget: int) -> dict[int, int]:
    """The last place of each label, of (label, place, passages), up to which documents of at most `budget` passages have that many together."""
    last: dict[int, int] = {}
    for label in {s[0] for s in sizes}:
        total = 0
        for _, place, n in sorted(s for s in sizes if s[0] == label and s[2] <= budget):
            total += n
            if total > budget:
                break
            last[label] = place
    return last


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE, budget: int = BUDGET
) -> dict[str, np.ndarray] | float:
    """The model, or a constant score where labels of one kind are missing."""
    allowed = (
        labels.select(F.col(doc_id).alias("id"), F.col(label).cast("double").alias("label"))
        .where("id IS NOT NULL AND label IS NOT NULL")
        .groupBy("id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
        .where(~held_out(F.col("id")))
    )
    counts = {r["label"]: r["n"] for r in allowed.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return float(next(iter(counts), 1))
    place = F.xxhash64("id").alias("place")
    chosen = [allowed.where(F.col("label") == y).select("id", "label", place).orderBy("place", "id").limit(sample) for y in (0, 1)]
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(chosen[0].unionAll(chosen[1]), "id")
    featured = keep(texts.select("label", "place", "text").mapInArrow(_featured, "label int, place long, passages binary, n long"))
    last = within([tuple(r) for r in featured.select("label", "place", "n").collect()], budget)
    held = F.lit(False)
    for y, end in last.items():
        held = held | ((F.col("label") == y) & (F.col("place") <= end))
    rows = featured.where(held & (F.col("n") <= budget)).select("label", "passages").collect()
    rows.sort(key=lambda r: (r["label"], bytes(r["passages"])))
    if len({r["label"] for r in rows}) < 2:
        return float(next((r["label"] for r in rows), 1))
    bags = [np.frombuffer(bytes(r["passages"]), np.float32).reshape(-1, FEATURES) for r in rows]
    y = np.array([r["label"] for r in rows], np.float64)
    share = np.array([counts[0] / max((y == 0).sum(), 1), counts[1] / max((y == 1).sum(), 1)])
    first = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]])
    return fit(np.concatenate(bags), first, y, share[y.astype(int)])


def scored(docs: DataFrame, model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, held_out, score, predicted."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[doc_id].dataType.simpleString()

    def rows(batches):
        for batch in batches:
            p = scores(held.value, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    read = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"))
    return read.mapInArrow(rows, f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """The rows of `docs` with a score of 0.5 or more; all columns, no join."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def rows(batches):
        for batch in batches:
            yield batch.filter(pa.array(scores(held.value, batch.column(place).to_pylist()) >= 0.5))

    return docs.mapInArrow(rows, docs.schema)
