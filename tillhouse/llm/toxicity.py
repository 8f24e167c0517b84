"""Toxicity scores from a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as a vector of word and character inputs: trained embeddings of the word's hash and of the hashes of its
character 3- to 5-grams, and the label log-odds of both in the training sample. Windows of WINDOW words overlap;
forward and backward gated recurrent units read each window, attention pools their states, and a text's score is that
of its worst window, calibrated to a probability. The sample for training is bounded (MAX_PER_LABEL texts of each
label, chosen by hash); scoring covers every window of every text, where the texts lie.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 32
STRIDE = 24
HIDDEN = 8
WORD_BITS = 15
CHAR_BITS = 16
WORD_DIM = 4
CHAR_DIM = 4
STATS = 4             # log-odds of the word, greatest and mean log-odds of its n-grams, length
MAX_PER_LABEL = 1500  # texts of each label that training sees
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
SEED = 7
BATCH = 2048          # windows scored at once
CACHED = 1 << 17      # words whose inputs are kept
STRIP = bytes(b for b in range(33, 127) if not chr(b).isalnum())
GRAMS = (3, 4, 5)


def held_out(doc_id, folds: int = FOLDS, fold: int = HELD_OUT):
    """Rows without an id are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(True))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(None, STRIP).split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _hash_words(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets; n-gram buckets of all words in a row; where each word's begin; word lengths."""
    text = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), dtype=np.uint8).astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words])
    ends = np.cumsum(lengths)
    starts = ends - lengths
    owner = np.repeat(np.arange(len(words)), lengths)
    powers = np.uint64(1099511628211)
    rolling = np.zeros(len(text), dtype=np.uint64)
    grams, owners = [], []
    for n in range(1, max(GRAMS) + 1):
        rolling[:len(text) - n + 1] = rolling[:len(text) - n + 1] * powers + text[n - 1:]
        if n in GRAMS:
            fits = np.flatnonzero(np.arange(len(text)) + n <= ends[owner])
            grams.append(_mix(rolling[fits] + np.uint64(n)) & np.uint64((1 << CHAR_BITS) - 1))
            owners.append(owner[fits])
    own = np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    gram = np.concatenate(grams)[order].astype(np.int64)
    # position-weighted sum of the letters, as a whole-word hash
    weight = _mix((np.arange(len(text)) - starts[owner]).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    whole = _mix(np.add.reduceat(_mix(text + weight), starts)) & np.uint64((1 << WORD_BITS) - 1)
    return whole.astype(np.int64), gram, np.searchsorted(own[order], np.arange(len(words))), lengths - 2


def _log_odds(rows: list[np.ndarray], labels: np.ndarray, size: int, least: int) -> np.ndarray:
    counts = np.zeros((2, size))
    for seen, label in zip(rows, labels, strict=True):
        counts[int(label), np.unique(seen)] += 1
    totals = np.bincount(labels, minlength=2)
    odds = np.log((counts[1] + .5) / (totals[1] + 1)) - np.log((counts[0] + .5) / (totals[0] + 1))
    return np.where(counts.sum(axis=0) >= least, odds, 0.0).astype(np.float32)


def windows_of(n: int) -> np.ndarray:
    """Starts of the windows over n words: every STRIDE, the last one at the end."""
    if n <= WINDOW:
        return np.zeros(1, dtype=np.int64)
    starts = np.arange(0, n - WINDOW, STRIDE)
    return np.append(starts, n - WINDOW)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Weights, and what runs on them. Everything is float32 numpy, so it travels to tasks as it is."""

    def __init__(self, word_odds: np.ndarray, char_odds: np.ndarray):
        rng = np.random.default_rng(SEED)
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        inputs, h = WORD_DIM + CHAR_DIM + STATS, HIDDEN
        self.word_odds, self.char_odds = word_odds, char_odds
        self.w = {
            "word": normal(1 << WORD_BITS, WORD_DIM, scale=.05), "char": normal(1 << CHAR_BITS, CHAR_DIM, scale=.05),
            "bias_f": np.zeros(3 * h, np.float32), "bias_b": np.zeros(3 * h, np.float32),
            "in_f": normal(inputs, 3 * h, scale=.3), "in_b": normal(inputs, 3 * h, scale=.3),
            "rec_f": normal(h, 3 * h, scale=.3), "rec_b": normal(h, 3 * h, scale=.3),
            "att": normal(2 * h, h, scale=.3), "att_v": normal(h, scale=.3), "out": normal(2 * h, scale=.3),
            "out_b": np.zeros(1, np.float32),
        }
        self.scale, self.shift, self.clean = 1.0, 0.0, 0.0

    @classmethod
    def of(cls, parts: dict) -> Network:
        """A network from vars() of another: plain arrays and numbers are what travels."""
        network = cls.__new__(cls)
        network.__dict__.update(parts)
        return network

    def inputs(self, words: list[bytes]):
        """(input vectors, what is needed to pass gradients back to the embeddings)."""
        if not words:
            none = np.empty(0, np.int64)
            return np.empty((0, WORD_DIM + CHAR_DIM + STATS), np.float32), (none, none, np.empty((0, 1), np.float32))
        whole, grams, first, length = _hash_words(words)
        number = np.diff(np.append(first, len(grams))).clip(1)[:, None].astype(np.float32)
        odds = self.char_odds[grams]
        stats = np.stack([self.word_odds[whole], np.maximum.reduceat(odds, first),
                          np.add.reduceat(odds, first) / number[:, 0], np.log1p(length)], axis=1)
        chars = np.add.reduceat(self.w["char"][grams], first, axis=0) / number
        return np.concatenate([self.w["word"][whole], chars, stats.astype(np.float32)], axis=1), (whole, grams, number)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Input parts of all six gates; row 0 is the padding."""
        w = self.w
        both = np.concatenate([x @ w["in_f"] + w["bias_f"], x @ w["in_b"] + w["bias_b"]], axis=1)
        return np.concatenate([np.zeros((1, both.shape[1]), np.float32), both])

    def forward(self, gates: np.ndarray, mask: np.ndarray, keep: bool = False):
        """gates: (batch, WINDOW, 6h); mask: (batch, WINDOW), 1 for words. Returns logits, and the tape if kept."""
        w, h = self.w, HIDDEN
        batch, steps = mask.shape
        states = np.zeros((batch, steps, 2 * h), np.float32)
        tape = {}
        for side, (rec, order) in enumerate((("rec_f", range(steps)), ("rec_b", range(steps - 1, -1, -1)))):
            state = np.zeros((batch, h), np.float32)
            for t in order:
                g = gates[:, t, side * 3 * h:(side + 1) * 3 * h]
                r = state @ w[rec]
                zr = 1 / (1 + np.exp(-(g[:, :2 * h] + r[:, :2 * h])))
                z, reset = zr[:, :h], zr[:, h:]
                new = np.tanh(g[:, 2 * h:] + reset * r[:, 2 * h:])
                m = mask[:, t, None]
                after = state + m * (1 - z) * (new - state)
                if keep:
                    tape[side, t] = (state, z, reset, new, r[:, 2 * h:])
                state = after
                states[:, t, side * h:(side + 1) * h] = state
        tanh = np.tanh(states @ w["att"])
        score = np.where(mask > 0, tanh @ w["att_v"], -1e9)
        score = np.exp(score - score.max(axis=1, keepdims=True)) * (mask > 0)
        share = score / np.maximum(score.sum(axis=1, keepdims=True), 1e-9)
        pooled = np.einsum("bt,bth->bh", share, states)
        logits = pooled @ w["out"] + w["out_b"][0]
        return (logits, (states, tanh, share, pooled, tape)) if keep else logits

    def gradients(self, words: list[bytes], index: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over windows; index: (batch, WINDOW) into words + 1, 0 for padding."""
        w, h = self.w, HIDDEN
        x, (whole, grams, number) = self.inputs(words)
        mask = (index > 0).astype(np.float32)
        logits, (states, tanh, share, pooled, tape) = self.forward(self.project(x)[index], mask, keep=True)
        batch, steps = mask.shape
        grad = {k: np.zeros_like(v) for k, v in w.items() if k not in ("word", "char")}
        d_logit = ((_sigmoid(logits) - labels) / batch).astype(np.float32)
        grad["out"], grad["out_b"] = pooled.T @ d_logit, np.array([d_logit.sum()], np.float32)
        d_pooled = d_logit[:, None] * w["out"]
        d_share = np.einsum("bh,bth->bt", d_pooled, states)
        d_score = share * (d_share - (share * d_share).sum(axis=1, keepdims=True))
        d_tanh = d_score[:, :, None] * w["att_v"] * (1 - tanh ** 2)
        grad["att_v"] = np.einsum("bt,bth->h", d_score, tanh)
        grad["att"] = np.einsum("bti,btj->ij", states, d_tanh)
        d_states = share[:, :, None] * d_pooled[:, None, :] + d_tanh @ w["att"].T
        d_gates = np.zeros((batch, steps, 6 * h), np.float32)
        for side, (rec, order) in enumerate((("rec_f", range(steps - 1, -1, -1)), ("rec_b", range(steps)))):
            back = np.zeros((batch, h), np.float32)
            for t in order:
                state, z, reset, new, r_new = tape[side, t]
                back = back + d_states[:, t, side * h:(side + 1) * h]
                m = mask[:, t, None]
                d_new = back * m * (1 - z) * (1 - new ** 2)
                d_z = -back * m * (new - state) * z * (1 - z)
                d_r = d_new * r_new * reset * (1 - reset)
                d_rec = np.concatenate([d_z, d_r, d_new * reset], axis=1)
                grad[rec] += state.T @ d_rec
                d_gates[:, t, side * 3 * h:(side + 1) * 3 * h] = np.concatenate([d_z, d_r, d_new], axis=1)
                back = back * (1 - m * (1 - z)) + d_rec @ w[rec].T
        per_word = np.zeros((len(words) + 1, 6 * h), np.float32)
        np.add.at(per_word, index.ravel(), d_gates.reshape(-1, 6 * h))
        per_word = per_word[1:]
        forward, backward = per_word[:, :3 * h], per_word[:, 3 * h:]
        grad["in_f"], grad["in_b"] = x.T @ forward, x.T @ backward
        grad["bias_f"], grad["bias_b"] = forward.sum(axis=0), backward.sum(axis=0)
        d_x = forward @ w["in_f"].T + backward @ w["in_b"].T
        grad["word"], grad["char"] = np.zeros_like(w["word"]), np.zeros_like(w["char"])
        np.add.at(grad["word"], whole, d_x[:, :WORD_DIM])
        spread = np.repeat(d_x[:, WORD_DIM:WORD_DIM + CHAR_DIM] / number, number[:, 0].astype(int), axis=0)
        np.add.at(grad["char"], grams, spread)
        return grad


class Scorer:
    """Raw scores of texts with one network; keeps the input parts of words it has met."""

    def __init__(self, network: Network):
        self.network = network
        self.number: dict[bytes, int] = {}
        self.gates = network.project(np.empty((0, WORD_DIM + CHAR_DIM + STATS), np.float32))

    def indexes(self, words: list[bytes]) -> np.ndarray:
        if len(self.number) > CACHED:
            self.__init__(self.network)
        new = list({w for w in words if w not in self.number})
        if new:
            base = len(self.number) + 1
            self.number.update(zip(new, range(base, base + len(new)), strict=True))
            if base + len(new) > len(self.gates):
                room = np.zeros((2 * (base + len(new)), self.gates.shape[1]), np.float32)
                room[:base] = self.gates[:base]
                self.gates = room
            for at in range(0, len(new), 20_000):
                part = self.network.inputs(new[at:at + 20_000])[0]
                self.gates[base + at:base + at + len(part)] = self.network.project(part)[1:]
        return np.fromiter(map(self.number.__getitem__, words), dtype=np.int64, count=len(words))

    def window_logits(self, index: np.ndarray) -> np.ndarray:
        """Of every window of one text, given its word numbers."""
        starts = windows_of(len(index))
        if len(index) < WINDOW:
            index = np.pad(index, (0, WINDOW - len(index)))
        out = []
        for at in range(0, len(starts), BATCH):
            take = index[starts[at:at + BATCH, None] + np.arange(WINDOW)]
            out.append(self.network.forward(self.gates[take], (take > 0).astype(np.float32)))
        return np.concatenate(out)

    def raw(self, texts: list[bytes]) -> np.ndarray:
        """Greatest window logit of each text; windows of many texts share a batch."""
        scores = np.full(len(texts), -np.inf)
        held: list[tuple[int, np.ndarray]] = []
        windows = 0

        def flush() -> None:
            nonlocal held, windows
            if held:
                rows = np.concatenate([x for _, x in held])
                owner = np.repeat([i for i, _ in held], [len(x) for _, x in held])
                logits = self.network.forward(self.gates[rows], (rows > 0).astype(np.float32))
                np.maximum.at(scores, owner, logits)
            held, windows = [], 0

        for i, text in enumerate(texts):
            words = words_of(text)
            if not words:
                scores[i] = self.network.clean  # nothing to read: as clean as clean texts are on average
                continue
            if len(self.number) > CACHED:
                flush()  # what is held refers to the words kept so far
            index = self.indexes(words)
            starts = windows_of(len(index))
            if len(index) < WINDOW:
                index = np.pad(index, (0, WINDOW - len(index)))
            for at in range(0, len(starts), BATCH):
                held.append((i, index[starts[at:at + BATCH, None] + np.arange(WINDOW)]))
                windows += len(held[-1][1])
                if windows >= BATCH:
                    flush()
        flush()
        return scores

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        return _sigmoid(self.network.scale * self.raw(texts) + self.network.shift)


class _Adam:
    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.step = weights, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in weights.items()}

    def apply(self, grad: dict[str, np.ndarray]) -> None:
        self.step += 1
        for k, g in grad.items():
            self.m[k] += .1 * (g - self.m[k])
            self.v[k] += .001 * (g * g - self.v[k])
            fix = self.rate * np.sqrt(1 - .999 ** self.step) / (1 - .9 ** self.step)
            self.weights[k] -= (fix * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(np.float32)


def train(texts: list[bytes], labels: np.ndarray, base_rate: float, rounds: int = 3, steps: int = 150) -> Network:
    """Multiple-instance training: each round, a text is represented by the window the network finds worst, clean
    texts by a random one besides; the first round takes the windows with the greatest log-odds."""
    rng = np.random.default_rng(SEED)
    docs = [words_of(t) for t in texts]
    hashed = [_hash_words(d) if d else (np.empty(0, np.int64),) * 4 for d in docs]
    network = Network(_log_odds([x[0] for x in hashed], labels, 1 << WORD_BITS, 4),
                      _log_odds([x[1] for x in hashed], labels, 1 << CHAR_BITS, 8))
    if len(set(labels.tolist())) < 2:
        network.scale, network.shift = 0.0, float(np.log((base_rate + 1e-3) / (1 - base_rate + 1e-3)))
        return network
    adam = _Adam(network.w, 3e-3)
    for round_ in range(rounds):
        scorer = Scorer(network)
        picked: list[tuple[list[bytes], int]] = []
        for doc, seen, label in zip(docs, hashed, labels, strict=True):
            if not doc:
                continue
            starts = windows_of(len(doc))
            if round_:
                worst = int(np.argmax(scorer.window_logits(scorer.indexes(doc))))
            else:
                odds = np.maximum(network.word_odds[seen[0]], np.maximum.reduceat(network.char_odds[seen[1]], seen[2]))
                total = np.r_[0, np.cumsum(np.maximum(odds, 0) ** 2)]
                worst = int(np.argmax(total[np.minimum(starts + WINDOW, len(doc))] - total[starts]))
            chosen = {worst} if label else {worst, int(rng.integers(len(starts)))}
            picked += [(doc[starts[c]:starts[c] + WINDOW], int(label)) for c in chosen]
        order = np.concatenate([rng.permutation(len(picked)) for _ in range(-(-128 * steps // len(picked)))])
        for at in range(0, 128 * steps, 128):
            part = [picked[i] for i in order[at:at + 128]]
            words = sorted({w for window, _ in part for w in window})
            number = {w: i + 1 for i, w in enumerate(words)}
            index = np.zeros((len(part), WINDOW), np.int64)
            for i, (window, _) in enumerate(part):
                index[i, :len(window)] = [number[w] for w in window]
            adam.apply(network.gradients(words, index, np.array([y for _, y in part], np.float32)))
    # calibration: logistic regression on the text scores, weighted to the base rate
    raw = Scorer(network).raw(texts)
    read = np.array([bool(d) for d in docs]) & (labels == 0)
    network.clean = float(raw[read].mean()) if read.any() else float(raw.min())
    raw[[not d for d in docs]] = network.clean
    share = labels.mean()
    weight = np.where(labels == 1, base_rate / share, (1 - base_rate) / (1 - share))
    a, b = 1.0, 0.0
    for _ in range(500):
        error = weight * (_sigmoid(a * raw + b) - labels)
        a, b = a - .05 * ((error * raw).mean() + .01 * (a - 1)), b - .05 * error.mean()
    network.scale, network.shift = float(max(a, .1)), float(b)
    return network


def score_toxicity(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                   label: str = "toxic", max_per_label: int = MAX_PER_LABEL, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted: one row per row of `docs`.

    Labels of held-out ids, null labels and labels without a document are not used. Null and blank texts score
    as the average clean text of the sample does. Repeated rows score alike. Without usable labels every score is the same;
    an empty table gives no rows. Other columns are ignored.
    """
    known = (labels.select(F.col(doc_id).alias("l_id"), F.col(label).cast("int").alias("y"))
             .where(F.col("y").isin(0, 1) & ~held_out(F.col("l_id"))))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    mine = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    texts: list[bytes] = []
    ys: list[int] = []
    for y in (0, 1):
        # the choice is made among ids, so only the chosen texts move
        ids = (known.where(F.col("y") == y).select("l_id").distinct().orderBy(F.xxhash64("l_id"), "l_id")
               .limit(max_per_label))
        rows = mine.join(F.broadcast(ids), F.col("doc_id") == F.col("l_id")).select("doc_id", "text")
        # ids are unique in a sound table; the limit also bounds one where they repeat
        for row in rows.orderBy(F.xxhash64("doc_id"), "text").limit(max_per_label).collect():
            texts.append(bytes(row["text"] or b""))
            ys.append(y)
    total = sum(counts.values())
    network = train(texts, np.array(ys, dtype=np.int64), counts.get(1, 0) / total if total else 0.0)
    shared = docs.sparkSession.sparkContext.broadcast(vars(network))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Network.of(shared.value))
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 256):
                out.append(scorer.probabilities([x or b"" for x in batch.column(1).slice(at, 256).to_pylist()]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(out) if out else [], pa.float64())], names=["doc_id", "score"])

    return (mine.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")))
