"""A bidirectional gated recurrent network with attention pooling over words, trained in numpy.

Each word enters as a word vector (of its own if it was seen often enough in training, else a shared one) beside a
character vector (the scaled sum of its hashed byte n-grams, so that unseen forms of a seen stem are near it).  A text is
read in overlapping windows; a window's attention weighs its words' states into one, from which its logit follows, and
the text takes the largest logit.  Training marks whole texts only: a text is positive if any window is (noisy or).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Words of a window and from one window to the next.
WINDOW, STRIDE = 32, 24
#: Sizes: states a direction, word and character vectors, attention, hash buckets of byte n-grams, and their lengths.
HIDDEN, WORD_DIM, CHAR_DIM, ATTENTION, BUCKETS, GRAMS = 12, 12, 20, 12, 1 << 14, (3, 4, 5)
#: Words taken up together in scoring; bounds the memory of a task whatever the length of its texts.
CHUNK_WORDS = 60_000
_WORD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and other code points, as UTF-8."""
    return text.lower().encode("utf-8", "replace").translate(_WORD).split()


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte n-grams of ``words``, with marks at both ends, and the word that each belongs to."""
    data = np.frombuffer(b"^" + b"$^".join(words) + b"$", np.uint8).astype(np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))  # bytes to the end of the word
    buckets, owners = [], []
    for n in GRAMS:
        h = np.full(max(0, len(data) - n + 1), n, np.uint32)
        for i in range(n):
            h = (h ^ data[i:i + len(h)]) * np.uint32(0x01000193)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        whole = left[:len(h)] >= n
        buckets.append(((h ^ (h >> np.uint32(13))) % np.uint32(BUCKETS))[whole].astype(np.int32))
        owners.append(owner[:len(h)][whole])
    buckets, owners = np.concatenate(buckets), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return buckets[order], owners[order]


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, words and text of every window, for texts that lie one after the other; a text without words has none."""
    counts = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(lengths)), counts)
    inside = (np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)) * STRIDE
    start = np.repeat(np.cumsum(lengths) - lengths, counts) + inside
    return start, np.minimum(WINDOW, np.repeat(lengths, counts) - inside), text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights by name, and the number of each known word (0 is shared by all others)."""

    weights: dict[str, np.ndarray]
    known: dict[bytes, int]

    @classmethod
    def start(cls, known: dict[bytes, int], seed: int = 13) -> Network:
        r = np.random.default_rng(seed)
        h, d = HIDDEN, WORD_DIM + CHAR_DIM
        w = {"word": r.normal(0, 0.1, (len(known) + 1, WORD_DIM)), "char": r.normal(0, 0.1, (BUCKETS, CHAR_DIM)),
             "in": r.normal(0, 0.4 / np.sqrt(d), (d, 6 * h)) * 2, "bias": np.zeros(6 * h),
             "gates": r.normal(0, 0.5 / np.sqrt(h), (2, h, 2 * h)), "new": r.normal(0, 0.5 / np.sqrt(h), (2, h, h)),
             "look": r.normal(0, 0.5 / np.sqrt(2 * h), (2 * h, ATTENTION)), "look_bias": np.zeros(ATTENTION),
             "heed": r.normal(0, 0.5, ATTENTION), "out": r.normal(0, 0.5, 2 * h), "out_bias": np.array([-2.0])}
        w["bias"][:h] = w["bias"][3 * h:4 * h] = 1.0  # gates begin by keeping the state
        return cls({k: v.astype(np.float32) for k, v in w.items()}, known)

    # -------------------------------------------------------------- forward

    def embed(self, distinct: list[bytes]):
        """Input projections (word, 6 x hidden) of distinct words, and what the way back needs."""
        w = self.weights
        number = np.fromiter((self.known.get(x, 0) for x in distinct), np.int64, len(distinct))
        bucket, owner = grams(distinct)
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])  # every word has an n-gram: the marks make three bytes
        scale = (1 / np.sqrt(np.diff(np.r_[first, len(owner)]))).astype(np.float32)[:, None]
        x = np.concatenate([w["word"][number], np.add.reduceat(w["char"][bucket], first, axis=0) * scale], axis=1)
        return x @ w["in"] + w["bias"], (x, number, bucket, owner, scale)

    def run(self, projected: np.ndarray, at: np.ndarray, live: np.ndarray, keep: bool = False):
        """Logits of windows. ``at`` (step, window): rows of ``projected``; ``live``: which steps have a word."""
        w, h = self.weights, HIDDEN
        steps, n = at.shape
        states = np.zeros((steps, n, 2 * h), np.float32)
        trace: list = [None, None]
        every = bool(live.all())
        for side in (0, 1):
            p = projected[:, 3 * h * side:3 * h * (side + 1)]
            gates, new = w["gates"][side], w["new"][side]
            state = np.zeros((n, h), np.float32)
            saved = []
            for t in (range(steps) if side == 0 else range(steps - 1, -1, -1)):
                x = p[at[t]]
                g = _sigmoid(x[:, :2 * h] + state @ gates)
                c = np.tanh(x[:, 2 * h:] + (g[:, h:] * state) @ new)
                after = c + g[:, :h] * (state - c)
                if not every:
                    after = np.where(live[t][:, None], after, state)
                if keep:
                    saved.append((t, state, g, c))
                state = after
                states[t, :, h * side:h * (side + 1)] = state
            trace[side] = saved
        look = np.tanh(states @ w["look"] + w["look_bias"])
        scores = np.where(live, look @ w["heed"], -np.inf)
        heed = np.exp(scores - scores.max(axis=0))
        heed /= heed.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", heed, states)
        logit = pooled @ w["out"] + w["out_bias"]
        return logit, (states, trace, look, heed, pooled) if keep else None

    # -------------------------------------------------------------- backward

    def back(self, d_logit: np.ndarray, saved, embedded, projected: np.ndarray, at: np.ndarray, live: np.ndarray) -> dict:
        """Gradients of every weight for the logits' gradients."""
        w, h = self.weights, HIDDEN
        states, trace, look, heed, pooled = saved
        x, number, bucket, owner, scale = embedded
        grad = {"out": pooled.T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * w["out"]
        d_states = heed[:, :, None] * d_pooled
        d_heed = np.einsum("bh,tbh->tb", d_pooled, states)
        d_score = heed * (d_heed - (heed * d_heed).sum(axis=0))
        grad["heed"] = np.einsum("tb,tba->a", d_score, look)
        d_look = d_score[:, :, None] * w["heed"] * (1 - look * look)
        grad["look"] = np.einsum("tbh,tba->ha", states, d_look)
        grad["look_bias"] = d_look.sum(axis=(0, 1))
        d_states += d_look @ w["look"].T
        grad["gates"], grad["new"] = np.zeros_like(w["gates"]), np.zeros_like(w["new"])
        d_in = np.zeros((*at.shape, 6 * h), np.float32)
        for side in (0, 1):
            gates, new = w["gates"][side], w["new"][side]
            d = np.zeros((at.shape[1], h), np.float32)
            for t, state, g, c in reversed(trace[side]):
                d = d + d_states[t, :, h * side:h * (side + 1)]
                on = live[t][:, None]
                da = np.where(on, d, 0)
                z, r = g[:, :h], g[:, h:]
                dc = da * (1 - z) * (1 - c * c)
                dz = da * (state - c) * z * (1 - z)
                dm = dc @ new.T
                dr = dm * state * r * (1 - r)
                dg = np.concatenate([dz, dr], axis=1)
                grad["new"][side] += (r * state).T @ dc
                grad["gates"][side] += state.T @ dg
                d_in[t, :, 3 * h * side:3 * h * side + 2 * h] = dg
                d_in[t, :, 3 * h * side + 2 * h:3 * h * (side + 1)] = dc
                d = np.where(on, da * z + dm * r + dg @ gates.T, d)
        flat, order = d_in.reshape(-1, 6 * h), np.argsort(at, axis=None, kind="stable")
        rows = at.reshape(-1)[order]
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        d_projected = np.zeros_like(projected)
        d_projected[rows[first]] = np.add.reduceat(flat[order], first, axis=0)
        grad["in"], grad["bias"] = x.T @ d_projected, d_projected.sum(axis=0)
        dx = d_projected @ w["in"].T
        grad["word"] = np.zeros_like(w["word"])
        np.add.at(grad["word"], number, dx[:, :WORD_DIM])
        by = np.argsort(bucket, kind="stable")
        first = np.flatnonzero(np.r_[True, bucket[by][1:] != bucket[by][:-1]])
        grad["char"] = np.zeros_like(w["char"])
        grad["char"][bucket[by][first]] = np.add.reduceat((dx[:, WORD_DIM:] * scale)[owner[by]], first, axis=0)
        return grad

    # -------------------------------------------------------------- texts

    def score(self, texts: list[list[bytes]]) -> np.ndarray:
        """Largest window logit of each text (words); minus infinity for a text without words."""
        out = np.full(len(texts), -np.inf)
        begin = 0
        while begin < len(texts):
            end, size = begin, 0
            while end < len(texts) and (end == begin or size + len(texts[end]) <= CHUNK_WORDS):
                size += len(texts[end])
                end += 1
            if size > CHUNK_WORDS:  # one long text: window by window, so that its length bounds nothing
                whole = texts[begin]
                step = CHUNK_WORDS // STRIDE * STRIDE
                parts = [whole[i:i + step + WINDOW - STRIDE] for i in range(0, max(1, len(whole) - (WINDOW - STRIDE)), step)]
                out[begin] = max(float(self._score(p)[0]) for p in ([q] for q in parts))
            else:
                out[begin:end] = self._score(texts[begin:end])
            begin = end
        return out

    def _score(self, texts: list[list[bytes]]) -> np.ndarray:
        out = np.full(len(texts), -np.inf)
        distinct, ids, lengths = index(texts)
        if not len(ids):
            return out
        start, size, text = windows(lengths)
        at, live = spread(ids, start, size)
        logits, _ = self.run(self.embed(distinct)[0], at, live)
        np.maximum.at(out, text, logits)
        return out


def index(texts: list[list[bytes]]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the number of each word of the texts one after the other, and the texts' lengths."""
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(x, len(number)) for t in texts for x in t), np.int64)
    return list(number), ids, np.fromiter(map(len, texts), np.int64, len(texts))


def spread(ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows as columns: word numbers by step, and which steps have a word."""
    step = np.arange(WINDOW)[:, None]
    live = step < size
    return ids[np.minimum(start + step, len(ids) - 1)], live


def fit(texts: list[list[bytes]], labels: np.ndarray, steps: int = 180, batch_words: int = 16_000, rate: float = 0.01,
        decay: float = 1e-5, least: int = 3, vocabulary: int = 20_000, seed: int = 13) -> Network:
    """Train on texts (words) with label 0 or 1, in so many steps over batches of about ``batch_words`` words; both labels
    weigh the same in sum.  Words in at least ``least`` texts have a vector of their own (the most frequent
    ``vocabulary``, ties by the word)."""
    holds: dict[bytes, int] = {}
    for t in texts:
        for x in set(t):
            holds[x] = holds.get(x, 0) + 1
    common = sorted((x for x, n in holds.items() if n >= least), key=lambda x: (-holds[x], x))[:vocabulary]
    net = Network.start({x: i + 1 for i, x in enumerate(common)}, seed)
    m = {k: np.zeros_like(v) for k, v in net.weights.items()}
    v = {k: np.zeros_like(x) for k, x in net.weights.items()}
    r = np.random.default_rng(seed)
    share = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    order, done = r.permutation(len(texts)), 0
    for step in range(1, steps + 1):
        size, take = 0, []
        while size < batch_words and len(take) < len(texts):  # again from the start, reordered, at the end
            if done == len(order):
                order, done = r.permutation(len(texts)), 0
            take.append(order[done])
            size += len(texts[order[done]])
            done += 1
        distinct, ids, lengths = index([texts[i] for i in take])
        if not len(ids):
            continue
        start, n, text = windows(lengths)
        at, live = spread(ids, start, n)
        projected, embedded = net.embed(distinct)
        logit, saved = net.run(projected, at, live, keep=True)
        # Noisy or: a text is clean if all its windows are; log P(clean) is the sum of theirs.
        clean = np.bincount(text, -np.logaddexp(0, logit.astype(float)), len(take))
        toxic = -np.expm1(np.minimum(clean, -1e-7))
        pull = np.where(labels[take] == 1, -np.exp(clean) / toxic, 1.0) * share[take] / len(take)
        d_logit = (pull[text] * _sigmoid(logit)).astype(np.float32)
        grad = net.back(d_logit, saved, embedded, projected, at, live)
        speed = rate * min(1.0, step / 20) * max(0.05, 1 - step / (steps + 1))
        for k, g in grad.items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            net.weights[k] = (net.weights[k] * (1 - decay) - speed * (m[k] / (1 - 0.9 ** step))
                              / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return net
