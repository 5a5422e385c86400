"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is an embedding of its own, where enough learned texts have it, beside what a bidirectional recurrent
network with attention pooling reads from its characters, so unseen forms of known stems count too. A second such
network reads windows of ``WINDOW`` words that overlap, whole texts at any length; its attention pools a window into
one number. A text's score comes from its strongest window and the mean over its windows, by a logistic curve that is
fitted on learned rows which the network did not see.

One task trains, on a sample of labelled rows of bounded size; its weights are one small row. Scoring runs where the
texts are: a word goes through the character network once for each worker and keeps its projected input.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The bounded training sample: rows of each label, whole texts. One row in ``FOLD`` fits the curve only.
ROWS, FOLD = 768, 4
#: Words a window, words from one window's start to the next one's, windows at once.
WINDOW, STEP, BATCH = 32, 24, 2048
#: Widths of embeddings and states; training rows that a word needs for an embedding of its own.
CHAR, CHAR_STATE, WORD, STATE, OFTEN = 8, 10, 6, 10, 5
#: Gradient steps, windows in each, learning rate; steps between two looks at all windows; words hidden while learning; decay.
STEPS, SOME, RATE, LOOK, HIDDEN, DECAY = 300, 128, 0.03, 75, 0.5, 0.3
#: Score from which a text is called toxic; words that a worker remembers.
LIMIT, REMEMBERED = 0.7, 150_000

#: Letters and digits; a longer run is several words.
_WORDS = re.compile(r"[^\W_]{1,20}")

Weights = dict[str, np.ndarray]


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def window_starts(n: int) -> list[int]:
    """Every window of a text of n words; an empty text has one, without words."""
    return list(range(0, max(1, n - WINDOW + STEP), STEP)) if n > WINDOW else [0]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _product(a: np.ndarray, b: np.ndarray, unit: bool = True) -> np.ndarray:
    """``a @ b`` of single precision, each row's result the same to the last bit whatever rows are beside it.

    Libraries add up a row's products in an order that depends on the number of rows. Rounded to 20 binary places, products
    and sums (below 2^13) are exact in double precision, so the order does not matter. States (``unit``) are at most 1.
    """
    if a.dtype != np.float32:
        return np.matmul(a, b)
    if unit:  # below 4: numbers from 8 to 16 have 20 binary places in single precision
        a = (a + np.float32(12)) - np.float32(12)
    else:
        a = np.rint(a.astype(np.float64) * 2.0**20) * 2.0**-20
    return np.matmul(a.astype(np.float64), np.rint(b.astype(np.float64) * 2.0**20) * 2.0**-20).astype(np.float32)


def _reversed(lengths: np.ndarray, steps: int) -> np.ndarray:
    """Place in time of the t-th symbol from the end, by sequence; padding stays where it is."""
    t = np.arange(steps)[:, None]
    return np.where(t < lengths, lengths - 1 - t, t)


def _gathered(at: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Sums of rows of ``values`` by their place in an array of ``count`` rows."""
    out = np.zeros((count, values.shape[1]), np.float32)
    if len(at):
        order = np.argsort(at, kind="stable")
        first = np.flatnonzero(np.diff(at[order], prepend=-1))
        out[at[order][first]] = np.add.reduceat(values[order], first, axis=0)
    return out


class Pooled:
    """A bidirectional recurrent layer with attention pooling over projected inputs, with its gradients."""

    def __init__(self, weights: Weights, name: str):
        self.u, self.a, self.ab, self.v = (weights[f"{name}.{x}"] for x in ("u", "a", "ab", "v"))
        self.name = name

    def forward(self, x: np.ndarray, lengths: np.ndarray, keep: bool = False) -> np.ndarray:
        """``x``: (time, direction, sequence, 3 states), longest sequence first, backward already reversed; (sequence, 2 states)."""
        steps, _, count, wide = x.shape
        size = wide // 3
        product = np.matmul if keep else _product
        going = np.searchsorted(-lengths, -np.arange(steps), side="left")  # sequences longer than t
        h = np.zeros((2, count, size), x.dtype)
        states, saved = np.zeros((steps, 2, count, size), x.dtype), []
        for t, on in enumerate(going.tolist()):
            h, now = h[:, :on], x[t, :, :on]
            g = product(h, self.u)
            zr = _sigmoid(now[:, :, : 2 * size] + g[:, :, : 2 * size])
            n = np.tanh(now[:, :, 2 * size :] + zr[:, :, size:] * g[:, :, 2 * size :])
            if keep:
                saved.append((h, zr, n, g[:, :, 2 * size :]))
            h = n + zr[:, :, :size] * (h - n)
            states[t, :, :on] = h
        back, at = _reversed(lengths, steps), np.arange(count)
        both = np.concatenate([states[:, 0], states[back, 1, at]], axis=2)
        hidden = np.tanh(product(both, self.a) + self.ab)
        there = np.arange(steps)[:, None] < lengths
        score = np.where(there, (hidden * self.v).sum(axis=2), -1e9)
        weight = np.exp(score - score.max(axis=0, initial=-1e9)) * there
        total = np.zeros(count, weight.dtype)
        for now in weight:  # in order also for a single sequence
            total += now
        weight /= np.maximum(total, 1e-9)
        if keep:
            self.saved = (x.shape, going, saved, both, hidden, weight, back)
        return (weight[:, :, None] * both).sum(axis=0)

    def backward(self, d_out: np.ndarray, grads: Weights) -> np.ndarray:
        """Adds this layer's gradients; returns that of ``x``."""
        shape, going, saved, both, hidden, weight, back = self.saved
        steps, _, count, wide = shape
        size = wide // 3
        d_weight = (both * d_out).sum(axis=2)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        flat = lambda m: m.reshape(-1, m.shape[2])
        grads[f"{self.name}.v"] += d_score.reshape(-1) @ flat(hidden)
        d_hidden = d_score[:, :, None] * self.v * (1 - hidden**2)
        grads[f"{self.name}.a"] += flat(both).T @ flat(d_hidden)
        grads[f"{self.name}.ab"] += d_hidden.sum(axis=(0, 1))
        d_both = weight[:, :, None] * d_out + d_hidden @ self.a.T
        d_states = np.empty((steps, 2, count, size), both.dtype)
        d_states[:, 0] = d_both[:, :, :size]
        d_states[back, 1, np.arange(count)] = d_both[:, :, size:]
        d_x, d_u, d_h = np.zeros(shape, both.dtype), grads[f"{self.name}.u"], np.zeros((2, 0, size), both.dtype)
        turned = self.u.transpose(0, 2, 1)
        for t in range(steps - 1, -1, -1):
            h, zr, n, gn = saved[t]
            z, r = zr[:, :, :size], zr[:, :, size:]
            d = d_states[t, :, : going[t]].copy()
            d[:, : d_h.shape[1]] += d_h
            d_n = d * (1 - z) * (1 - n * n)
            d_zr = np.concatenate([d * (h - n), d_n * gn], axis=2) * zr * (1 - zr)
            d_x[t, :, : going[t]] = np.concatenate([d_zr, d_n], axis=2)
            d_g = np.concatenate([d_zr, d_n * r], axis=2)
            d_u += np.matmul(h.transpose(0, 2, 1), d_g)
            d_h = d * z + np.matmul(d_g, turned)
        return d_x


class Network:
    """Weights, alphabet and vocabulary. Index 0 is padding (characters) or a word without its own embedding."""

    def __init__(self, weights: Weights, letters: str, words: list[str]):
        self.weights = weights
        self.letters = {c: i + 2 for i, c in enumerate(letters)}
        self.words = {w: i + 1 for i, w in enumerate(words)}
        self.alphabet, self.vocabulary = letters, words

    @staticmethod
    def fresh(letters: str, words: list[str], seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, by: (rng.standard_normal(shape) / np.sqrt(by)).astype(np.float32)
        w: Weights = {"chars": draw(len(letters) + 2, CHAR, by=2), "words": draw(len(words) + 1, WORD, by=10)}
        for name, wide, size in (("char", CHAR, CHAR_STATE), ("word", WORD + 2 * CHAR_STATE, STATE)):
            w |= {f"{name}.x": draw(2, wide, 3 * size, by=wide), f"{name}.b": np.zeros((2, 1, 3 * size), np.float32), f"{name}.u": draw(2, size, 3 * size, by=size)}
            w |= {f"{name}.a": draw(2 * size, size, by=2 * size), f"{name}.ab": np.zeros(size, np.float32), f"{name}.v": draw(size, by=size)}
        w |= {"out": draw(2 * STATE, by=2 * STATE), "bias": np.zeros(1, np.float32)}
        return Network(w, letters, words)

    def spelled(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(time, word) characters and lengths."""
        lengths = np.array([len(w) for w in words], np.int64)
        out = np.zeros((int(lengths.max()) if len(words) else 0, len(words)), np.int64)
        get = self.letters.get
        for i, w in enumerate(words):
            out[: len(w), i] = [get(c, 1) for c in w]
        return out, lengths

    def inputs(self, words: list[str], keep: bool = False, hidden: np.ndarray | None = None) -> np.ndarray:
        """(direction, word, 3 states): each word's projected input of the second network; longest word first."""
        w = self.weights
        chars, lengths = self.spelled(words)
        back = np.take_along_axis(chars, _reversed(lengths, len(chars)), axis=0)
        table = np.matmul(w["chars"], w["char.x"]) + w["char.b"]
        layer = Pooled(w, "char")
        read = layer.forward(np.stack([table[0][chars], table[1][back]], axis=1), lengths, keep)
        own = np.array([self.words.get(x, 0) for x in words], np.int64)
        if hidden is not None:
            own[hidden] = 0
        joined = np.concatenate([w["words"][own], read], axis=1)
        if keep:
            self.saved = (chars, back, layer, own, joined)
        return (np.matmul(joined, w["word.x"]) if keep else _product(joined, w["word.x"], False)) + w["word.b"]

    def logits(self, inputs: np.ndarray, ids: np.ndarray, lengths: np.ndarray, keep: bool = False) -> np.ndarray:
        """A number a window, longest first; ``ids`` are (time, window) places in ``inputs``."""
        back = np.take_along_axis(ids, _reversed(lengths, len(ids)), axis=0)
        layer = Pooled(self.weights, "word")
        pooled = layer.forward(np.stack([inputs[0][ids], inputs[1][back]], axis=1), lengths, keep)
        if keep:
            self.last = (ids, back, layer, pooled)
        return (pooled * self.weights["out"]).sum(axis=1) + self.weights["bias"]

    def gradients(self, d_logits: np.ndarray, count: int) -> Weights:
        """Of the windows and words of the last calls with ``keep``; ``count`` words."""
        w = self.weights
        grads = {k: np.zeros_like(v) for k, v in w.items()}
        ids, back, layer, pooled = self.last
        chars, chars_back, reader, own, joined = self.saved
        grads["out"] += pooled.T @ d_logits
        grads["bias"] += d_logits.sum()
        d_x = layer.backward(d_logits[:, None] * w["out"], grads)
        flat = lambda at, d: _gathered(at.ravel(), d.reshape(-1, d.shape[2]), count)
        d_in = np.stack([flat(ids, d_x[:, 0]), flat(back, d_x[:, 1])])
        grads["word.x"] += np.matmul(joined.T, d_in)
        grads["word.b"] += d_in.sum(axis=1, keepdims=True)
        d_joined = np.matmul(d_in, w["word.x"].transpose(0, 2, 1)).sum(axis=0)
        grads["words"] += _gathered(own, d_joined[:, :WORD], len(w["words"]))
        d_c = reader.backward(d_joined[:, WORD:], grads)
        wide, letters = d_c.shape[3], len(w["chars"])
        d_table = np.stack([_gathered(chars.ravel(), d_c[:, 0].reshape(-1, wide), letters), _gathered(chars_back.ravel(), d_c[:, 1].reshape(-1, wide), letters)])
        grads["char.x"] += np.matmul(w["chars"].T, d_table)
        grads["char.b"] += d_table.sum(axis=1, keepdims=True)
        grads["chars"] += np.matmul(d_table, w["char.x"].transpose(0, 2, 1)).sum(axis=0)
        return grads


class Scorer:
    """A network and its curve; remembers words' inputs."""

    def __init__(self, network: Network, curve: np.ndarray):
        self.network, self.curve = network, curve
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.inputs = np.zeros((2, 0, 3 * STATE), np.float32)

    def _learn(self, texts: list[list[str]]) -> None:
        if len(self.places) > REMEMBERED:
            self.forget()
        new = sorted({w for t in texts for w in t if w not in self.places}, key=len, reverse=True)
        if new:
            done = [self.inputs] + [self.network.inputs(new[i : i + 4096]) for i in range(0, len(new), 4096)]
            self.places.update(zip(new, range(len(self.places), len(self.places) + len(new)), strict=True))
            self.inputs = np.concatenate(done, axis=1)

    def windows(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first word, logit) of every window of every text."""
        self._learn(texts)
        numbers = [np.array([self.places[w] for w in t], np.int64) for t in texts]
        at = [(i, s, min(WINDOW, len(t) - s)) for i, t in enumerate(texts) for s in window_starts(len(t))]
        at.sort(key=lambda x: -x[2])
        inputs = self.inputs if self.inputs.shape[1] else np.zeros((2, 1, 3 * STATE), np.float32)
        logits = []
        for b in range(0, len(at), BATCH):
            some = at[b : b + BATCH]
            lengths = np.array([x[2] for x in some], np.int64)
            ids = np.zeros((int(lengths[0]), len(some)), np.int64)
            for j, (i, s, n) in enumerate(some):
                ids[:n, j] = numbers[i][s : s + n]
            logits.append(self.network.logits(inputs, ids, lengths).astype(np.float64))
        return np.array([x[0] for x in at], np.int64), np.array([x[1] for x in at], np.int64), np.concatenate(logits)

    def features(self, texts: list[list[str]]) -> np.ndarray:
        """(strongest window, mean of the windows' probabilities as log odds) of each text, over all of its windows."""
        owner, _, logit = self.windows(texts)
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, owner, logit)
        mean = np.clip(np.bincount(owner, _sigmoid(logit), len(texts)) / np.bincount(owner, minlength=len(texts)), 1e-6, 1 - 1e-6)
        return np.stack([np.clip(best, -30, 30), np.log(mean / (1 - mean))], axis=1)

    def score(self, texts: list[list[str]]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        best, mean = self.features(texts).T
        return _sigmoid(best * self.curve[0] + mean * self.curve[1] + self.curve[2])


def _fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps, slightly drawn to zero, so that separable rows have a finite curve.

    Some labels are wrong, and a wrong one flattens the curve for all. So rows that the fit contradicts, a tenth of
    either label at most, are left out and it is fitted again.
    """
    rows, draw, kept = np.concatenate([x, np.ones((len(x), 1))], axis=1), np.array([0.05, 0.05, 1e-3]), np.ones(len(x), bool)
    for _ in range(3):
        c, some, target, w = np.zeros(3), rows[kept], y[kept], weight[kept]
        for _ in range(30):
            p = _sigmoid(some @ c)
            c -= np.linalg.solve((some * (w * p * (1 - p))[:, None]).T @ some + np.diag(draw), some.T @ (w * (p - target)) + draw * c)
        off = np.abs(y - _sigmoid(rows @ c))
        kept = np.ones(len(x), bool)
        for label in (0, 1):
            mine = np.flatnonzero(y == label)
            worst = mine[np.argsort(-off[mine], kind="stable")[: len(mine) // 10]]
            kept[worst[off[worst] > 0.6]] = False
    return c


def train(rows: list[tuple[int, str | None, int, float]]) -> Scorer | float:
    """A scorer from (hash, text, label, weight) rows, always the same from the same rows; with one label only, a constant.

    Weights undo the sample's share of labels where the curve is fitted: a score is the chance among all labelled rows.
    """
    rows = sorted(rows, key=lambda r: (r[0], r[1] or "", r[2]))
    labels = np.array([r[2] for r in rows], np.int64)
    if not len(rows) or labels.min() == labels.max():
        return float(labels.max()) if len(rows) else 0.0
    texts = [words_of(r[1]) for r in rows]
    fold = np.zeros(len(rows), bool)
    for label in (0, 1):
        fold[np.flatnonzero(labels == label)[FOLD - 1 :: FOLD]] = True
    learned = np.flatnonzero(~fold)
    seen: dict[str, int] = {}
    letters: dict[str, int] = {}
    for i in learned:
        for w in sorted(set(texts[i])):
            seen[w] = seen.get(w, 0) + 1
            for c in w:
                letters[c] = letters.get(c, 0) + 1
    network = Network.fresh("".join(sorted(c for c, n in letters.items() if n >= OFTEN)), sorted(w for w, n in seen.items() if n >= OFTEN))
    rng = np.random.default_rng(5)
    by_label = [[i for i in learned if labels[i] == k] for k in (0, 1)]
    mean = {k: np.zeros_like(v) for k, v in network.weights.items()}
    square = {k: np.zeros_like(v) for k, v in network.weights.items()}
    chances: dict[int, np.ndarray] = {}
    for step in range(1, STEPS + 1):
        if step % LOOK == 0:  # a toxic text need not be so everywhere: its windows are drawn by what the network now says
            looked = Scorer(network, np.zeros(3)).windows([texts[i] for i in learned])
            for k, i in enumerate(learned.tolist()):
                mine = looked[0] == k
                p = _sigmoid(looked[2][mine][np.argsort(looked[1][mine])]) + 1e-3
                chances[i] = np.cumsum(p / p.sum())
        some = []
        for j in range(SOME):
            i = by_label[j % 2][rng.integers(len(by_label[j % 2]))]
            starts, drawn = window_starts(len(texts[i])), rng.random()
            by_chance = i in chances and j % 4 != 2  # half of the clean windows are any, the others the doubtful ones
            s = starts[min(len(starts) - 1, int(np.searchsorted(chances[i], drawn)) if by_chance else int(drawn * len(starts)))]
            some.append((texts[i][s : s + WINDOW], j % 2))
        some.sort(key=lambda x: -len(x[0]))
        here = sorted(sorted({w for t, _ in some for w in t}), key=len, reverse=True) or [""]
        place = {w: k for k, w in enumerate(here)}
        lengths = np.array([len(t) for t, _ in some], np.int64)
        ids = np.zeros((max(1, int(lengths.max())), len(some)), np.int64)
        for k, (t, _) in enumerate(some):
            ids[: len(t), k] = [place[w] for w in t]
        y = np.array([k for _, k in some], np.float32)
        logit = network.logits(network.inputs(here, True, rng.random(len(here)) < HIDDEN), ids, lengths, True)
        grads = network.gradients(((_sigmoid(logit) - y) / len(y)).astype(np.float32), len(here))
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for k, g in grads.items():
            g *= min(1.0, 1 / max(norm, 1e-9))
            mean[k] += 0.1 * (g - mean[k])
            square[k] += 0.01 * (g**2 - square[k])
            network.weights[k] *= 1 - DECAY * rate
            network.weights[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-7)
    scorer = Scorer(network, np.zeros(3))
    rest = np.flatnonzero(fold) if len(set(labels[fold].tolist())) == 2 else np.arange(len(rows))
    scorer.curve = _fit_curve(scorer.features([texts[i] for i in rest]), labels[rest].astype(np.float64), np.array([rows[i][3] for i in rest]))
    scorer.forget()
    return scorer


def packed(model: Scorer | float) -> bytes:
    out = io.BytesIO()
    if isinstance(model, float):
        np.savez(out, constant=np.array(model))
    else:
        net = model.network
        np.savez_compressed(out, curve=model.curve, letters=np.array(list(net.alphabet)), vocabulary=np.array(net.vocabulary), **{f"w.{k}": v for k, v in net.weights.items()})
    return out.getvalue()


def unpacked(data: bytes) -> Scorer | float:
    held = np.load(io.BytesIO(data))
    if "constant" in held:
        return float(held["constant"])
    weights = {k[2:]: held[k] for k in held.files if k.startswith("w.")}
    return Scorer(Network(weights, "".join(held["letters"].tolist()), held["vocabulary"].tolist()), held["curve"])


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(h, text, label, weight) of at most ``ROWS`` ids of each label, those with the least hash.

    Ids are chosen from ``labels`` alone, by a threshold that follows each label's count. They are few, so they are
    broadcast to the texts; of repeated rows of an id, one is taken.
    """
    named = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("id is not null and label in (0, 1)").withColumn("h", F.pmod(F.xxhash64("id"), F.lit(1 << 40)))
    counts = {r["label"]: r["n"] for r in named.groupBy("label").agg(F.count("*").alias("n")).collect()}
    bound = F.coalesce(*[F.when(F.col("label") == k, F.lit(min(1 << 40, int((1 << 40) * 0.8 * ROWS / n)))) for k, n in counts.items()]) if counts else F.lit(0)
    picked = sorted((r["h"], r["id"], r["label"]) for r in named.filter(F.col("h") < bound).select("h", "id", "label").distinct().collect()) if counts else []
    taken = {k: [x for x in picked if x[2] == k][:ROWS] for k in counts}
    share = lambda k: counts[k] / len(taken[k]) * len(picked) / sum(counts.values())
    kept = [(*r, share(k)) for k in counts for r in taken[k]]
    chosen = docs.sparkSession.createDataFrame(kept, f"h long, id {named.schema['id'].dataType.simpleString()}, label int, weight double")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(chosen), "id").groupBy("h", "id", "label", "weight").agg(F.min("text").alias("text")).select("h", "text", "label", "weight")


def _train_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [(r["h"], r["text"], r["label"], r["weight"]) for b in batches for r in b.to_pylist()]
    yield pa.RecordBatch.from_arrays([pa.array([packed(train(rows))], pa.binary())], names=["model"])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> bytes:
    """The packed model of the labelled rows; one task trains, as the sample is bounded."""
    sample = training_sample(docs, labels, label_col, id_col, text_col)
    rows = sample.repartition(1).mapInArrow(_train_task, "model binary").collect()
    return bytes(rows[0]["model"]) if rows else packed(0.0)


_MODELS: dict[int, Scorer | float] = {}


def _score_task(data: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if hash(data) not in _MODELS:
            _MODELS.clear()
            _MODELS[hash(data)] = unpacked(data)
        model = _MODELS[hash(data)]
        for batch in batches:
            texts, scores, held = [], [], 0
            values = batch.column(1)
            for i in range(batch.num_rows):
                texts.append(words_of(values[i].as_py()) if not isinstance(model, float) else [])
                held += len(texts[-1])
                if held >= 1 << 16 or i == batch.num_rows - 1:
                    scores += [model] * len(texts) if isinstance(model, float) else model.score(texts).tolist()
                    texts, held = [], 0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["row", "score"])

    return run


def toxicity(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row's whole text, all its windows. Null and empty texts score as windows without words.

    Rows and ids that repeat are rows of their own; equal texts have equal scores; nothing but the text decides.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.struct(F.col(id_col).alias("id")).alias("row"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_score_task(model), f"row struct<id:{kind}>, score double").select(F.col("row.id").alias("doc_id"), "score")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def predict_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels.filter(~held_out()))
    found = toxicity(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"))
