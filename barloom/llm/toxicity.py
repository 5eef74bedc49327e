"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A token's input is the sum of a word embedding and of embeddings of its first and
last characters, for all that occur twice among the texts it was fitted on; one
dimension starts from the class log-odds of the feature, the rest at random. A token whose
ends do not cover it (a sentence in a script without spaces, glued words) is followed by
its overlapping pieces, one from every character on, so every byte is seen. Windows of ``WINDOW`` tokens overlap by a quarter; all
windows of a text are scored and the highest one is the text's.

Fitting: at most ``max_fit_rows`` labelled texts a class (smallest hash of the id, texts
up to ``max_fit_bytes`` bytes) are collected. Labels stand on texts, not on windows, so the
window that says most is chosen for each text, the network is trained on the chosen
ones by back-propagation and Adam, and the choice is made again. A fifth of the texts
is kept apart for the final logistic scale. Rows held out (crc32 of the id, mod 3, is 1)
are never learnt from. Only the text is an input.

Defined cases: null and wordless texts are one empty window, which scores next to 0; without both classes
among the labels every score is the share of label 1 (0 without labels); rows with
a null id are never held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A

WINDOW, STRIDE = 32, 24
HIDDEN, INPUT = 8, 8
PREFIXES, SUFFIXES = (3, 4, 5, 6), (3, 4)
#: Bytes that the ends of a token cover, and bytes of a piece of a longer one.
LONG, PIECE = 10, 6
MAX_FIT_ROWS = 2500
MAX_FIT_BYTES = 1 << 16
REJECT = 0.7
SMOOTH = 6.0
LEAST_STEPS = 150
EMPTY_LOGIT = -30.0
#: A column of this name in the documents is replaced.
SCORE = "_barloom_toxicity"
BLOCK_WINDOWS = 2048
BLOCK_WORDS = 1 << 17
_FEATURES = 1 + len(PREFIXES) + len(SUFFIXES)


def _with_pieces(buffer: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spans, each of more than ``LONG`` bytes followed by its pieces; a piece starts at a character."""
    long = np.flatnonzero(end - start > LONG)
    size = end[long] - start[long]
    owner = np.repeat(long, size)
    at = np.arange(len(owner)) + np.repeat(start[long] - np.cumsum(size) + size, size)
    first = (buffer[at] & 0xC0) != 0x80
    owner, at = owner[first], at[first]
    # the last piece is the first one to reach the end
    need = (at > start[owner]) & (np.append(0, at[:-1])[: len(at)] + PIECE < end[owner])
    owner, at = owner[need], at[need]
    order = np.argsort(np.concatenate([np.arange(len(start)), owner]), kind="stable")
    ends = np.concatenate([end, np.minimum(at + PIECE, end[owner])])
    return np.concatenate([start, at])[order], ends[order], np.concatenate([row, row[owner]])[order]


def _features(buffer: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each token's word, feature hashes of each distinct word) in a padded buffer."""
    hashes = A.span_hashes(buffer, start, end)
    one, first = np.unique(hashes, return_index=True)
    s, e = start[first], end[first]
    view = A.lanes(buffer)
    out = [one]
    for k, (size, from_end) in enumerate([(n, False) for n in PREFIXES] + [(n, True) for n in SUFFIXES]):
        n = np.minimum(size, e - s)
        lane = view[e - n if from_end else s] & A._MASKS[n]
        out.append(A.mix(lane ^ np.uint64((k + 1) << 56)))
    return np.searchsorted(one, hashes), np.stack(out, axis=1)


def _windows(size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first token, tokens) of all windows of texts with ``size`` tokens; one empty one for none."""
    number = np.maximum(1, -(-np.maximum(size - (WINDOW - STRIDE), 0) // STRIDE))
    text = np.repeat(np.arange(len(size)), number)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    first = nth * STRIDE
    return text, first + (np.cumsum(size) - size)[text], np.minimum(size[text] - first, WINDOW)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    """The parameters, the forward pass and its gradients."""

    def __init__(self, known: np.ndarray, log_odds: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        #: Sorted hashes of the features that have an embedding; row 0 stands for all others.
        self.known = known
        self.table = (0.1 * rng.standard_normal((len(known) + 1, INPUT))).astype(np.float32)
        self.table[1:, 0] = log_odds
        self.table[0] = 0
        self.p = {
            "W": draw(INPUT, 6 * HIDDEN),
            "b": np.zeros(6 * HIDDEN, np.float32),
            "Uf": draw(HIDDEN, 3 * HIDDEN),
            "Ub": draw(HIDDEN, 3 * HIDDEN),
            "A": draw(2 * HIDDEN, 2 * HIDDEN),
            "v": draw(2 * HIDDEN),
            "o": draw(2 * HIDDEN),
            "c": np.zeros(1, np.float32),
        }
        self.scale = (1.0, 0.0)

    def rows(self, features: np.ndarray) -> np.ndarray:
        """Table rows of feature hashes."""
        if not len(self.known):
            return np.zeros(features.shape, np.int64)
        at = np.minimum(np.searchsorted(self.known, features), len(self.known) - 1)
        return np.where(self.known[at] == features, at + 1, 0)

    def inputs(self, ids: np.ndarray) -> np.ndarray:
        """The input vector of each distinct word."""
        return self.table[ids].sum(axis=1)

    def _direction(self, x: np.ndarray, at: np.ndarray, mask: np.ndarray, U: np.ndarray, back: bool, keep: list | None):
        """States after each step, one direction; ``x`` holds the projected inputs of the distinct words."""
        rows, steps = at.shape
        h = np.zeros((rows, HIDDEN), np.float32)
        out = np.empty((steps, rows, HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1) if back else range(steps):
            g = x[at[:, t]]
            u = h @ U
            zr = _sigmoid(g[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN] * mask[:, t, None], zr[:, HIDDEN:]
            c = np.tanh(g[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
            if keep is not None:
                keep.append((t, h, z, r, c, u[:, 2 * HIDDEN :]))
            h = h + z * (c - h)
            out[t] = h
        return out

    def forward(self, x: np.ndarray, at: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of each window; ``at`` points to rows of ``x`` (distinct words)."""
        p = self.p
        projected = x @ p["W"] + p["b"]
        tapes: tuple = (None, None) if keep is None else ([], [])
        f = self._direction(projected[:, : 3 * HIDDEN], at, mask, p["Uf"], False, tapes[0])
        b = self._direction(projected[:, 3 * HIDDEN :], at, mask, p["Ub"], True, tapes[1])
        h = np.concatenate([f, b], axis=2)
        e = np.tanh(h @ p["A"])
        weight = np.where(mask.T, np.exp(np.clip(e @ p["v"], -30, 30)), 0.0).astype(np.float32)
        total = weight.sum(axis=0)
        weight /= np.where(total > 0, total, 1)
        pooled = np.einsum("tn,tnh->nh", weight, h)
        if keep is not None:
            keep.update(tapes=tapes, h=h, e=e, weight=weight, pooled=pooled)
        return pooled @ p["o"] + p["c"]

    def gradients(self, x, at, mask, y) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Of the mean logistic loss: by parameter, and by row of ``x``."""
        p, k = self.p, {}
        logit = self.forward(x, at, mask, k)
        d = ((_sigmoid(logit) - y) / len(y)).astype(np.float32)
        g = {"o": k["pooled"].T @ d, "c": np.array([d.sum()], np.float32)}
        dpool = d[:, None] * p["o"]
        dweight = np.einsum("nh,tnh->tn", dpool, k["h"])
        dh = k["weight"][:, :, None] * dpool
        ds = k["weight"] * (dweight - (k["weight"] * dweight).sum(axis=0))
        g["v"] = np.einsum("tn,tnh->h", ds, k["e"])
        de = ds[:, :, None] * p["v"] * (1 - k["e"] ** 2)
        g["A"] = np.einsum("tnh,tng->hg", k["h"], de)
        dh += de @ p["A"].T
        dprojected = np.zeros((len(x), 6 * HIDDEN), np.float32)
        for name, tape, part in (("Uf", k["tapes"][0], 0), ("Ub", k["tapes"][1], 1)):
            U, dU = p[name], np.zeros_like(p[name])
            carry = np.zeros((len(y), HIDDEN), np.float32)
            each = np.empty((at.shape[1], len(y), 3 * HIDDEN), np.float32)
            for t, h, z, r, c, uc in reversed(tape):
                down = carry + dh[t, :, part * HIDDEN : (part + 1) * HIDDEN]
                dc = down * z * (1 - c * c)
                dz = down * (c - h) * z * (1 - z)
                dr = dc * uc * r * (1 - r)
                inner = np.concatenate([dz, dr, dc * r], axis=1)
                dU += h.T @ inner
                carry = down * (1 - z) + inner @ U.T
                each[t] = np.concatenate([dz, dr, dc], axis=1) * mask[:, t, None]
            np.add.at(dprojected[:, part * 3 * HIDDEN : (part + 1) * 3 * HIDDEN], at.T, each)
            g[name] = dU
        g["W"], g["b"] = x.T @ dprojected, dprojected.sum(axis=0)
        return g, dprojected @ p["W"].T


class Texts:
    """Tokens and windows of some texts, ready for the network."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        rows = len(offsets) - 1
        buffer = A.padded(raw, lower=True)
        start, end, row = _with_pieces(buffer, *A.spans(A.ALNUM[buffer[: len(raw)]], offsets))
        self.place, self.features = _features(buffer, start, end)
        if not len(self.features):  # the empty window points to some word and masks it
            self.features = np.zeros((1, _FEATURES), np.uint64)
        self.text, self.first, self.size = _windows(np.diff(A.run_starts(row, rows)))
        self.rows = rows

    def window(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the words, mask) of some windows."""
        step = np.arange(WINDOW)
        mask = step < self.size[which, None]
        if not len(self.place):
            return np.zeros(mask.shape, np.int64), mask
        at = np.minimum(self.first[which, None] + step, len(self.place) - 1)
        return self.place[at], mask

    def logits(self, net: Network) -> np.ndarray:
        """Of every window."""
        few = len(self.features) <= BLOCK_WORDS
        x = net.inputs(net.rows(self.features)) if few else None
        out = np.empty(len(self.text), np.float32)
        for a in range(0, len(out), BLOCK_WINDOWS):
            which = np.arange(a, min(a + BLOCK_WINDOWS, len(out)))
            at, mask = self.window(which)
            if not few:  # the words of the block only
                words, at = np.unique(at, return_inverse=True)
                at = at.reshape(mask.shape)
                x = net.inputs(net.rows(self.features[words]))
            out[which] = net.forward(x, at, mask)
        out[self.size == 0] = EMPTY_LOGIT
        return out

    def highest(self, logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text its highest logit and the window that has it."""
        order = np.lexsort((logits, self.text))
        last = np.append(self.text[order][1:] != self.text[order][:-1], True)
        return logits[order[last]], order[last]


def _window_tokens(data: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(text, token) of every token of every window."""
    owner = np.repeat(data.text, data.size)
    step = np.repeat(data.first - np.cumsum(data.size) + data.size, data.size) + np.arange(len(owner))
    return owner, step


def _distinct(data: Texts) -> np.ndarray:
    """Flags of the texts that are no near copy of an earlier one, by four minimal shingle hashes."""
    owner, step = _window_tokens(data)
    grams = A.window_hashes(data.features[data.place[step], 0], 3)
    owner = owner[: len(grams)]
    keep, seen = np.ones(data.rows, bool), set()
    least = np.full((4, data.rows), 2**64 - 1, dtype=np.uint64)
    for k in range(4):
        np.minimum.at(least[k], owner, A.mix(grams + np.uint64(k)))
    for i, marks in enumerate(zip(*(r.tolist() for r in least))):
        own = {(k, m) for k, m in enumerate(marks) if m != 2**64 - 1}
        keep[i] = not own & seen
        seen |= own
    return keep


def train(texts: list[bytes], y: np.ndarray, rounds: int = 3, epochs: int = 6, rate: float = 0.01, batch: int = 128) -> Network:
    """A network from whole texts and their labels."""
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    data = Texts(np.frombuffer(b"".join(texts), dtype=np.uint8), offsets)
    apart = np.arange(len(y)) % 5 == 4
    # copies would make the chance words they share look like a class of their own
    single = _distinct(data)
    learn = np.flatnonzero(~apart & single)
    # log-odds of each feature by the texts it occurs in
    owner, step = _window_tokens(data)
    pairs = np.unique(owner * len(data.features) + data.place[step])  # a word of a text, once
    owner, word = pairs // len(data.features), pairs % len(data.features)
    used = (~apart & single)[owner]
    owner, word = owner[used], word[used]
    known, ids = np.unique(data.features, return_inverse=True)
    ids = ids.reshape(data.features.shape)
    counts = np.zeros((2, len(known)))
    for k in range(_FEATURES):
        seen = np.unique(owner * len(known) + ids[word, k])
        np.add.at(counts, (y[seen // len(known)].astype(int), seen % len(known)), 1)
    total = np.bincount(y[learn].astype(int), minlength=2)
    smooth = SMOOTH * total / total.sum()
    odds = np.log((counts[1] + smooth[1]) / (counts[0] + smooth[0]) * total[0] / total[1])
    often = counts.sum(axis=0) > 1
    net = Network(known[often], odds[often].astype(np.float32))
    ids = net.rows(data.features)

    word_odds = net.table[ids, 0].sum(axis=1)
    first_guess = np.full(len(data.text), -1e9, np.float32)
    for a in range(0, len(first_guess), BLOCK_WINDOWS):
        which = np.arange(a, min(a + BLOCK_WINDOWS, len(first_guess)))
        at, mask = data.window(which)
        first_guess[which] = np.where(mask, word_odds[at], -1e9).max(axis=1)
    moments = {n: [np.zeros_like(v), np.zeros_like(v)] for n, v in net.p.items()}
    rng, tick, guess = np.random.default_rng(11), 0, first_guess
    for _ in range(rounds):
        _, chosen = data.highest(guess)
        for _ in range(max(epochs, LEAST_STEPS * batch // max(1, len(learn)))):
            order = rng.permutation(learn)
            for a in range(0, len(order), batch):
                rows = order[a : a + batch]
                at, mask = data.window(chosen[rows])
                words, at = np.unique(at, return_inverse=True)
                at = at.reshape(mask.shape)
                x = net.inputs(ids[words])
                g, dx = net.gradients(x, at, mask, y[rows])
                tick += 1
                for n, v in net.p.items():
                    m, s = moments[n]
                    grad = np.clip(g[n], -1, 1)
                    m += 0.1 * (grad - m)
                    s += 0.001 * (grad * grad - s)
                    v -= rate * (m / (1 - 0.9**tick)) / (np.sqrt(s / (1 - 0.999**tick)) + 1e-8)
                np.subtract.at(net.table, ids[words].ravel(), np.repeat(0.05 * np.clip(dx, -1, 1), _FEATURES, axis=0))
                net.table[0] = 0
        guess = data.logits(net)
    best, _ = data.highest(guess)
    net.scale = _logistic_scale(best[apart], y[apart]) if 0 < y[apart].mean() < 1 else _logistic_scale(best, y)
    return net


def _logistic_scale(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> tuple[float, float]:
    """(slope, offset) of a logistic fit by Newton steps; the slope stays positive."""
    slope, offset = 1.0, 0.0
    design = np.stack([x.astype(float), np.ones(len(x))], axis=1)
    for _ in range(30):
        p = _sigmoid(np.clip(design @ [slope, offset], -30, 30))
        grad = design.T @ (p - y) + ridge * np.array([slope - 1, offset])
        hess = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        move = np.clip(np.linalg.solve(hess, grad), -1, 1)
        slope, offset = max(0.05, slope - move[0]), offset - move[1]
    return float(slope), float(offset)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_fit_rows: int = MAX_FIT_ROWS, max_fit_bytes: int = MAX_FIT_BYTES) -> Network | float:
    """A network, or the share of label 1 if there is only one class."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("_t_label")).filter(
        F.col("_t_label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    found = []
    for label in (0, 1):
        chosen = known.filter(F.col("_t_label") == label).select("doc_id").distinct().orderBy(*order).limit(max_fit_rows)
        # the sample is bounded by max_fit_rows, so it can be broadcast
        rows = docs.select("doc_id", "text").filter(F.octet_length("text") <= max_fit_bytes).join(F.broadcast(chosen), "doc_id")
        rows = rows.orderBy(*order, "text").limit(max_fit_rows)
        found.append([r.text.encode() for r in rows.select("text").toLocalIterator()])
    if not found[0] or not found[1]:
        return float(bool(found[1]))
    # both classes spread evenly, so that any fifth has both
    place = np.concatenate([np.linspace(0, 1, len(f), endpoint=False) for f in found])
    texts, y = found[0] + found[1], np.repeat([0.0, 1.0], [len(found[0]), len(found[1])])
    order = np.argsort(place, kind="stable")
    return train([texts[i] for i in order], y[order])


def score(docs: DataFrame, model: Network | float) -> DataFrame:
    """``docs`` with the column ``SCORE``: every whole text's score from 0 to 1."""
    docs = docs.drop(SCORE)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    @A.trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for batch in batches:
            scores = np.full(batch.num_rows, net if isinstance(net, float) else 0.0)
            raw, offsets = A.text_bytes(batch.column("text"))
            for a, b in A.chunks(offsets) if isinstance(net, Network) else ():
                data = Texts(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                best, _ = data.highest(data.logits(net))
                scores[a:b] = _sigmoid(np.clip(net.scale[0] * best.astype(float) + net.scale[1], -30, 30))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, SCORE]
            )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(SCORE, T.DoubleType())]))


def drop_toxic(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """``docs`` without those that score ``reject`` or more."""
    return score(docs, fit(docs, labels)).filter(F.col(SCORE) < reject).drop(SCORE)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col(SCORE).alias("score"),
        (F.col(SCORE) >= REJECT).cast("int").alias("predicted"),
    )
