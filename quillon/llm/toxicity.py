"""Toxicity scores by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as the sum of its own embedding and the mean embedding of hashed character n-grams at its two ends. Texts
are cut into overlapping windows; every window is scored, and a small calibrator turns a text's window scores into one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import U64, mix, prefix_hash, slices, span_hash
from quillon.llm.language import held_out

WINDOW, STRIDE = 64, 48
HIDDEN, INPUT, ATTENTION = 8, 12, 8
BUCKETS = 1 << 14
VOCABULARY = 8192
CACHE = 120_000
_EDGE = ".,;:!?\"'()[]{}|*#$%&<>-"


LEADING, TRAILING = range(1, 8), range(2, 5)


def word_features(tokens: list[str], vocabulary: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Each word's row (0 if unknown) and the buckets of its 1 to 7 leading and 2 to 4 trailing characters (BUCKETS: none)."""
    words = [t.strip(_EDGE) or t for t in tokens]
    rows = np.array([vocabulary.get(w, 0) for w in words], dtype=np.int64)
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(U64)
    prefix, end = prefix_hash(mix(codes + U64(1))), np.cumsum(sizes)
    grams = np.full((len(words), len(LEADING) + len(TRAILING)), BUCKETS, dtype=np.int64)
    for k, n in enumerate((*LEADING, *TRAILING)):
        has = np.flatnonzero(sizes >= n)
        at = (end - sizes)[has] if k < len(LEADING) else end[has] - n
        grams[has, k] = (mix(span_hash(prefix, at, at + n) + U64(k)) % U64(BUCKETS)).astype(np.int64)
    return rows, grams


def window_starts(n: int) -> list[int]:
    """Starts of the overlapping windows that cover n words; none for 0."""
    return list(range(0, max(1, n - (WINDOW - STRIDE)), STRIDE)) if n else []


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """The parameters, the forward pass and the gradients. Directions are stacked on the first axis."""

    def __init__(self, vocabulary: dict[str, int], seed: int = 3):
        g = np.random.default_rng(seed)
        draw = lambda *shape, scale: (g.standard_normal(shape) * scale).astype(np.float32)
        self.vocabulary = vocabulary
        self.p = {
            "word": draw(len(vocabulary) + 1, INPUT, scale=0.1),
            "char": draw(BUCKETS, INPUT, scale=0.3),
            "wx": draw(2, INPUT, 3 * HIDDEN, scale=0.3),
            "bx": np.zeros((2, 1, 3 * HIDDEN), np.float32),
            "wh": draw(2, HIDDEN, 3 * HIDDEN, scale=0.3),
            "wa": draw(2 * HIDDEN, ATTENTION, scale=0.3),
            "va": draw(ATTENTION, scale=0.3),
            "wo": draw(2 * HIDDEN, scale=0.3),
            "bo": np.zeros(1, np.float32),
        }
        self.p["word"][0] = 0

    def inputs(self, tokens: list[str], drop: np.ndarray | None = None) -> tuple[np.ndarray, tuple]:
        """Vectors of distinct tokens, and what their gradients need."""
        rows, grams = word_features(tokens, self.vocabulary)
        if drop is not None:
            rows = np.where(drop, 0, rows)
        share = (1 / np.maximum((grams < BUCKETS).sum(axis=1), 1)).astype(np.float32)
        chars = np.concatenate([self.p["char"], np.zeros((1, INPUT), self.p["char"].dtype)])
        x = self.p["word"][rows] + chars[grams].sum(axis=1) * share[:, None]
        return x, (rows, grams, share)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Input terms of all gates: (tokens, direction, gates)."""
        return np.stack([x @ self.p["wx"][d] + self.p["bx"][d] for d in (0, 1)], axis=1)

    def forward(self, table: np.ndarray, ids: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """Logit of each window; ids are rows of the projected table, padded at the end."""
        n, steps = ids.shape
        wh, H = self.p["wh"], HIDDEN
        states = np.zeros((2, steps, n, H), np.float32)
        trace = []
        for d in (0, 1):
            h = np.zeros((n, H), np.float32)
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                a = table[ids[:, t], d]
                b = h @ wh[d]
                zr = _sigmoid(a[:, : 2 * H] + b[:, : 2 * H])
                z, r = zr[:, :H], zr[:, H:]
                new = np.tanh(a[:, 2 * H :] + r * b[:, 2 * H :])
                live = (t < lengths)[:, None]
                nxt = np.where(live, new + z * (h - new), h)
                if keep:
                    trace.append((d, t, h, z, r, new, b[:, 2 * H :], live))
                h = nxt
                states[d, t] = h
        both = np.concatenate([states[0], states[1]], axis=2)
        u = np.tanh(both @ self.p["wa"])
        e = np.where(np.arange(steps)[:, None] < lengths[None, :], u @ self.p["va"], -1e9)
        w = np.exp(e - e.max(axis=0))
        w /= w.sum(axis=0)
        context = np.einsum("tn,tnh->nh", w, both)
        logit = context @ self.p["wo"] + self.p["bo"][0]
        return (logit, (trace, both, u, w, context)) if keep else logit

    def infer(self, ahead: np.ndarray, back: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """What forward() gives, for windows sorted so that all have about one length; both directions step together."""
        n, steps, H = len(ids), int(lengths.max()), HIDDEN
        h, states = np.zeros((2, n, H), np.float32), np.empty((steps, 2, n, H), np.float32)
        a, b = np.empty((2, n, 3 * H), np.float32), np.empty((2, n, 3 * H), np.float32)
        full = int(lengths.min()) == steps
        for t in range(steps):
            np.take(ahead, ids[:, t], axis=0, out=a[0], mode="clip")
            np.take(back, ids[:, steps - 1 - t], axis=0, out=a[1], mode="clip")
            np.matmul(h, self.p["wh"], out=b)
            gates = np.tanh((a[:, :, : 2 * H] + b[:, :, : 2 * H]) * np.float32(0.5))
            gates *= np.float32(0.5)
            gates += np.float32(0.5)
            new = np.tanh(a[:, :, 2 * H :] + gates[:, :, H:] * b[:, :, 2 * H :])
            moved = new + gates[:, :, :H] * (h - new)
            h = moved if full else np.where(np.stack([t < lengths, steps - 1 - t < lengths])[:, :, None], moved, h)
            states[t] = h
        both = np.concatenate([states[:, 0], states[::-1, 1]], axis=2)
        e = np.tanh(both @ self.p["wa"]) @ self.p["va"]
        if not full:
            e = np.where(np.arange(steps)[:, None] < lengths[None, :], e, np.float32(-1e9))
        w = np.exp(e - e.max(axis=0))
        w /= w.sum(axis=0)
        return (w * (both @ self.p["wo"])).sum(axis=0) + self.p["bo"][0]

    def gradients(self, x: np.ndarray, used: tuple, table: np.ndarray, ids: np.ndarray, lengths: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p, H = self.p, HIDDEN
        logit, (trace, both, u, w, context) = self.forward(table, ids, lengths, keep=True)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        dl = ((_sigmoid(logit) - y) * weight / weight.sum()).astype(np.float32)
        g["bo"][0], g["wo"] = dl.sum(), context.T @ dl
        dc = dl[:, None] * p["wo"]
        dw = np.einsum("nh,tnh->tn", dc, both)
        de = w * (dw - (w * dw).sum(axis=0))
        g["va"] = np.einsum("tn,tna->a", de, u)
        du = de[:, :, None] * p["va"] * (1 - u * u)
        g["wa"] = np.einsum("tnh,tna->ha", both, du)
        dboth = w[:, :, None] * dc[None] + du @ p["wa"].T
        dtable = np.zeros_like(table)
        carry = {0: np.zeros((len(ids), H), np.float32), 1: np.zeros((len(ids), H), np.float32)}
        for d, t, h, z, r, new, bn, live in reversed(trace):
            dh = dboth[t][:, d * H : (d + 1) * H] + carry[d]
            dn = dh * (1 - z) * (1 - new * new) * live
            dz = dh * (h - new) * z * (1 - z) * live
            dr = dn * bn * r * (1 - r)
            da = np.concatenate([dz, dr, dn], axis=1)
            db = np.concatenate([dz, dr, dn * r], axis=1)
            np.add.at(dtable[:, d], ids[:, t], da)
            g["wh"][d] += h.T @ db
            carry[d] = np.where(live, dh * z, dh) + db @ p["wh"][d].T
        rows, grams, share = used
        dx = np.zeros_like(x)
        for d in (0, 1):
            g["wx"][d] = x.T @ dtable[:, d]
            g["bx"][d, 0] = dtable[:, d].sum(axis=0)
            dx += dtable[:, d] @ p["wx"][d].T
        np.add.at(g["word"], rows, dx)
        chars = np.zeros((BUCKETS + 1, INPUT), dx.dtype)
        np.add.at(chars, grams.ravel(), np.repeat(dx * share[:, None], grams.shape[1], axis=0))
        g["char"] = chars[:BUCKETS]
        g["word"][0] = 0
        return g


class _Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in (0, 1))

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        for k, x in g.items():
            x = x * min(1, 5 / (norm + 1e-9))
            self.m[k] += 0.1 * (x - self.m[k])
            self.v[k] += 0.01 * (x * x - self.v[k])
            self.p[k] -= self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.99**self.t)) + 1e-8)


class Model:
    """A trained network and its calibrator; `constant` stands in where there was nothing to learn from."""

    def __init__(self, network: Network | None, calibrator: np.ndarray | None = None, constant: float = 0.0):
        self.network, self.calibrator, self.constant = network, calibrator, constant

    def finish(self, logits: np.ndarray) -> float:
        return float(_sigmoid(summary(logits) @ self.calibrator))


def summary(logits: np.ndarray) -> np.ndarray:
    """What the calibrator sees of a text: its best window, the mean of its three best, the mean of all, and their number."""
    top = np.sort(logits)[::-1]
    return np.array([1.0, top[0], top[:3].mean(), logits.mean(), np.log(len(logits))])


class Scorer:
    """Scores texts in blocks of windows, with a bounded cache of projected words."""

    def __init__(self, model: Model, block: int = 1024):
        self.model, self.block = model, block
        self.rows: dict[str, int] = {}
        self.size, self.tables = 0, [np.zeros((1024, 3 * HIDDEN), np.float32) for _ in (0, 1)]

    def _ids(self, texts: list[list[str]]) -> list[np.ndarray]:
        if len(self.rows) > CACHE:
            self.rows, self.size = {}, 0
        rows = self.rows
        fresh = list(dict.fromkeys(w for ws in texts for w in ws if w not in rows))
        if fresh:
            added = self.model.network.project(self.model.network.inputs(fresh)[0])
            rows.update(zip(fresh, range(self.size, self.size + len(fresh))))
            while self.size + len(fresh) > len(self.tables[0]):
                self.tables = [np.concatenate([x, np.empty_like(x)]) for x in self.tables]
            for d in (0, 1):
                self.tables[d][self.size : self.size + len(fresh)] = added[:, d]
            self.size += len(fresh)
        return [np.array(list(map(self.rows.__getitem__, ws)), dtype=np.int64) for ws in texts]

    def logits(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Window logits of each text (none for texts without words)."""
        ids = self._ids(texts)
        counts = [len(window_starts(len(x))) for x in ids]
        total = sum(counts)
        spans, lengths = np.zeros((total, WINDOW), np.int64), np.zeros(total, np.int64)
        k = 0
        for x in ids:
            for s in window_starts(len(x)):
                part = x[s : s + WINDOW]
                spans[k, : len(part)], lengths[k] = part, len(part)
                k += 1
        out, order = np.zeros(total, np.float32), np.argsort(-lengths, kind="stable")
        for a in range(0, total, self.block):
            part = order[a : a + self.block]
            whole = part[lengths[part] == WINDOW]
            for some in (whole, part[len(whole) :]):
                if len(some):
                    out[some] = self.model.network.infer(*self.tables, spans[some], lengths[some])
        return np.split(out, np.cumsum(counts)[:-1]) if counts else []

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if self.model.network is None:
            return np.full(len(texts), self.model.constant)
        words = [(t or "").lower().split() for t in texts]
        return np.array([self.model.finish(x) if len(x) else 0.0 for x in self.logits(words)])


def fit(texts: list[str], labels: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.02, seed: int = 3) -> Model:
    """Train on whole texts: a text's label is put on its highest window so far (at first on any), then calibrate."""
    if len(set(labels.tolist())) < 2:
        return Model(None, constant=float(labels[0]) if len(labels) else 0.0)
    g = np.random.default_rng(seed)
    words = [t.lower().split() for t in texts]
    usable = [i for i, ws in enumerate(words) if ws]
    order = g.permutation(usable)
    held, train = order[: max(2, len(order) // 5)], order[max(2, len(order) // 5) :]
    if len(set(labels[train].tolist())) < 2 or len(set(labels[held].tolist())) < 2:
        held = train = order
    counts = Counter(w.strip(_EDGE) or w for i in train for w in set(words[i]))
    network = Network({w: k + 1 for k, (w, n) in enumerate(counts.most_common(VOCABULARY)) if n > 1}, seed)
    adam, model = _Adam(network.p, rate), Model(network)
    positive = float(labels[train].mean())
    steps = max(epochs * len(train) // batch, 300)
    best: dict[int, int] = {}
    done = 0
    while done < steps:
        if done >= steps // 4:  # look where each text is most toxic now
            scorer = Scorer(model)
            for a in range(0, len(train), 256):
                part = train[a : a + 256]
                for i, x in zip(part, scorer.logits([words[i] for i in part])):
                    best[i] = int(np.argmax(x))
        adam.rate = rate * (1 - 0.9 * done / steps)
        for a in range(0, len(train), batch):
            part = [i for i in g.permutation(train)[:batch]] if len(train) < batch else train[a : a + batch]
            chosen = []
            for i in part:
                starts = window_starts(len(words[i]))
                if i in best:
                    chosen.append((i, starts[best[i]]))
                if i not in best or not labels[i]:
                    chosen.append((i, starts[g.integers(len(starts))]))
            spans = [words[i][s : s + WINDOW] for i, s in chosen]
            tokens = list(dict.fromkeys(w for ws in spans for w in ws))
            row = {w: k for k, w in enumerate(tokens)}
            lengths = np.array([len(ws) for ws in spans])
            ids = np.array([[row[w] for w in ws] + [0] * (WINDOW - len(ws)) for ws in spans])
            x, used = network.inputs(tokens, g.random(len(tokens)) < 0.2)
            y = np.array([float(labels[i]) for i, _ in chosen], np.float32)
            weight = np.where(y > 0, min(10.0, (1 - positive) / positive), 1.0).astype(np.float32)
            adam.step(network.gradients(x, used, network.project(x), ids, lengths, y, weight))
            done += 1
            if done >= steps:
                break
        train = g.permutation(train)
    scorer = Scorer(model)
    seen = np.array([summary(x) for a in range(0, len(held), 256) for x in scorer.logits([words[i] for i in held[a : a + 256]])])
    model.calibrator = logistic(seen, labels[held].astype(float))
    return model


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a penalised logistic regression by Newton's method, with the scale taken out of the penalty."""
    scale = np.maximum(x.std(axis=0), 1e-6)
    scale[0] = 1
    z, w = x / scale, np.zeros(x.shape[1])
    ridge = np.diag([1e-3, *[penalty] * (x.shape[1] - 1)])
    for _ in range(rounds):
        p = _sigmoid(z @ w)
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge + 1e-6 * np.eye(len(w)), z.T @ (y - p) - ridge @ w)
        w += np.clip(step, -2, 2)
    return w / scale


def train(docs: DataFrame, labels: DataFrame, sample: int = 6000, characters: int = 60_000_000) -> Model:
    """Learn from at most `sample` labelled rows (doc_id, toxic) that are not held out, chosen by a hash of the doc_id.

    The bounds keep the driver's share constant: a few thousand whole texts of at most `characters` in all (a text that
    would exceed that is left out), and a vocabulary of the VOCABULARY most frequent words of these. Rows with a null
    label, doc_id or text are not used; of several labels for a document the highest counts, of several texts the least.
    """
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.filter(F.col("text").isNotNull()).select("doc_id", "text")
    sized = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct(F.length("text").alias("size"), F.xxhash64("text").alias("mark"))).alias("t"))
    left, picked = characters, []
    for doc_id, size, mark in sized.select("doc_id", "t.size", "t.mark").orderBy(F.xxhash64("doc_id"), "doc_id").collect():  # at most sample rows
        if size <= left:
            left -= size
            picked.append((doc_id, mark))
    own = docs.sparkSession.createDataFrame(picked, f"doc_id {dict(docs.dtypes)['doc_id']}, mark long")
    one = texts.withColumn("mark", F.xxhash64("text")).join(F.broadcast(own), ["doc_id", "mark"]).dropDuplicates(["doc_id", "mark"])
    rows = one.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic").collect()  # bounded by sample and characters
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    return fit([r["text"] for r in rows], np.array([int(r["toxic"]) for r in rows]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text; a text without words, or null, scores 0.

    Rows are scored one by one: repeats, nulls in other columns and further columns change nothing.
    """
    kind = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by VOCABULARY and BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                scores = scorer(batch.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = 6000) -> DataFrame:
    """Scores of all documents, learned from the labelled ones that are not held out."""
    return score(docs, train(docs, labels, sample))
