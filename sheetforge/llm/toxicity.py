"""Toxicity: a bidirectional gated recurrent network with attention pooling, over word and character inputs.

Trained in numpy on a bounded sample of labelled rows; scoring runs over all overlapping windows of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._bytes import SPACE, _hash_block, mix, powers, utf8
from ._common import materialize

#: Words in a window; windows begin every STRIDE words, and the last one ends with the text.
WINDOW, STRIDE = 32, 16
#: At most about so many labelled documents of each class are learned from, chosen by a hash of doc_id.
SAMPLE = 2000
#: About so many bytes of their texts.
MOST_BYTES = 1 << 26
#: Parts of the sample; what is known of a word for a training document comes from the other parts.
FOLDS = 4
#: Character input: runs of so many bytes of a word with its edges marked.
GRAM = 5
#: Documents of the sample in which a word or run has to occur to count as evidence.
LEAST = 4
SLOTS = 1 << 18
WORD_BUCKETS, GRAM_BUCKETS, EMBED = 4096, 4096, 4
HIDDEN, ATTEND = 8, 8
STATIC = 4
INPUT = STATIC + 2 * EMBED
#: Texts are worked on in blocks of about so many bytes.
BLOCK = 1 << 20
#: Windows scored at a time.
CHUNK = 1024
_EDGE = np.uint8(0)


# --- inputs


@dataclass
class Words:
    """The distinct words of some text: their hashes, and the hashes of their character runs with bounds."""

    hashes: np.ndarray
    grams: np.ndarray
    bounds: np.ndarray


def distinct_words(data: np.ndarray, cuts: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray]:
    """(distinct words, number of each word in turn, words' first bytes) of one block of text."""
    lowered = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    h, starts = _hash_block(lowered, cuts, False)
    keys, first, number = np.unique(h, return_index=True, return_inverse=True)
    gap = np.concatenate((SPACE[data], [True]))
    gap_at = np.flatnonzero(gap)
    begin = starts[first]
    end = np.minimum(gap_at[np.searchsorted(gap_at, begin)], _next_cut(cuts, begin, len(data)))
    size = end - begin
    padded = size + 2
    bounds = np.concatenate(([0], np.cumsum(padded)))
    text = np.full(bounds[-1], _EDGE, np.uint8)
    inside = np.arange(bounds[-1]) - np.repeat(bounds[:-1], padded)
    keep = (inside > 0) & (inside <= np.repeat(size, padded))
    text[keep] = lowered[(np.repeat(begin, padded) + inside - 1)[keep]]
    n = max(0, len(text) - GRAM + 1)
    with np.errstate(over="ignore"):
        factors = powers(np.uint64(0x9FB21C651E98DF25), GRAM)
        total = np.zeros(n, np.uint64)
        for i in range(GRAM):
            total += (text[i : i + n].astype(np.uint64) + np.uint64(1)) * factors[i]
        grams = mix(total)
    per_word = np.maximum(0, padded - GRAM + 1)
    valid = np.zeros(len(text) + 1, np.int64)
    ok = np.repeat(bounds[1:], padded)[:n] - np.arange(n) >= GRAM
    valid[1 : n + 1] = ok
    at = np.concatenate(([0], np.cumsum(per_word)))
    return Words(keys, grams[ok], at), number, starts


def _next_cut(cuts: np.ndarray, begin: np.ndarray, n: int) -> np.ndarray:
    edges = np.append(np.sort(cuts), n)
    return edges[np.searchsorted(edges, begin, "right").clip(max=len(edges) - 1)]


@dataclass
class Evidence:
    """Log odds of words (or character runs) in toxic against other documents, in a hash table."""

    keys: np.ndarray
    odds: np.ndarray

    @staticmethod
    def build(keys: np.ndarray, toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int) -> Evidence:
        seen = toxic + other
        ok = seen >= LEAST
        keys, toxic, other, seen = keys[ok], toxic[ok], other[ok], seen[ok]
        odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((other + 0.5) / (n_other + 1))
        odds *= seen / (seen + 4.0)
        order = np.argsort(np.abs(odds), kind="stable")  # the strongest is written last and stays
        table, values = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.float32)
        place = Evidence._place(keys[order])
        table[place], values[place] = keys[order], odds[order]
        return Evidence(table, values)

    @staticmethod
    def _place(keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(40)) % np.uint64(SLOTS)

    def of(self, keys: np.ndarray) -> np.ndarray:
        place = self._place(keys)
        return np.where(self.keys[place] == keys, self.odds[place], np.float32(0))


def static_inputs(words: Words, word_odds: Evidence, gram_odds: Evidence) -> np.ndarray:
    """The word's log odds, and the largest, smallest and mean log odds of its character runs."""
    out = np.zeros((len(words.hashes), STATIC), np.float32)
    out[:, 0] = word_odds.of(words.hashes)
    full = np.flatnonzero(np.diff(words.bounds) > 0)
    if len(full):
        odds, at = gram_odds.of(words.grams), words.bounds[full]
        out[full, 1] = np.maximum.reduceat(odds, at)
        out[full, 2] = np.minimum.reduceat(odds, at)
        out[full, 3] = np.add.reduceat(odds, at) / np.diff(words.bounds)[full]
    return out / np.float32(3)


def gram_means(words: Words, table: np.ndarray) -> np.ndarray:
    out = np.zeros((len(words.hashes), table.shape[1]), np.float32)
    full = np.flatnonzero(np.diff(words.bounds) > 0)
    if len(full):
        values = table[(words.grams % np.uint64(GRAM_BUCKETS)).astype(np.int64)]
        out[full] = np.add.reduceat(values, words.bounds[full], axis=0) / np.diff(words.bounds)[full, None]
    return out


def windows(n: int) -> np.ndarray:
    """First words of the overlapping windows of a text of n words; together they cover every word."""
    if n <= WINDOW:
        return np.zeros(1 if n else 0, np.int64)
    return np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW)


# --- network


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def init(rng) -> dict[str, np.ndarray]:
    def normal(*shape, scale):
        return rng.normal(0, scale, shape).astype(np.float32)

    p = {"word": normal(WORD_BUCKETS, EMBED, scale=0.05), "gram": normal(GRAM_BUCKETS, EMBED, scale=0.05)}
    for d in "fb":
        p[f"W{d}"] = normal(INPUT, 3 * HIDDEN, scale=0.4)
        p[f"b{d}"] = np.zeros(3 * HIDDEN, np.float32)
        p[f"U{d}"] = normal(HIDDEN, 3 * HIDDEN, scale=0.3)
        p[f"c{d}"] = np.zeros(HIDDEN, np.float32)
    p |= {"Wa": normal(2 * HIDDEN, ATTEND, scale=0.3), "ba": np.zeros(ATTEND, np.float32), "va": normal(ATTEND, scale=0.3)}
    return p | {"wo": normal(2 * HIDDEN, scale=0.3), "bo": np.zeros(1, np.float32)}


def gru(gates: np.ndarray, mask: np.ndarray | None, U: np.ndarray, c: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States after each step. gates: steps x windows x 3 HIDDEN (input part of update, reset, candidate)."""
    steps, n, _ = gates.shape
    h = np.zeros((n, HIDDEN), np.float32)
    out = np.empty((steps, n, HIDDEN), np.float32)
    for t in range(steps):
        a, u = gates[t], h @ U
        zr = 1 / (1 + np.exp(-(a[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])))
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        hn = u[:, 2 * HIDDEN :] + c
        cand = np.tanh(a[:, 2 * HIDDEN :] + r * hn)
        new = cand + z * (h - cand)
        if mask is not None:
            new = np.where(mask[t][:, None], new, h)
        if keep is not None:
            keep.append((h, z, r, hn, cand))
        h = out[t] = new
    return out


def gru_back(d_out: np.ndarray, mask: np.ndarray, U: np.ndarray, keep: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of the gates, U and c from those of the states."""
    steps, n, _ = d_out.shape
    d_gates = np.zeros((steps, n, 3 * HIDDEN), np.float32)
    dU, dc, dh = np.zeros_like(U), np.zeros(HIDDEN, np.float32), np.zeros((n, HIDDEN), np.float32)
    for t in reversed(range(steps)):
        h, z, r, hn, cand = keep[t]
        dh = dh + d_out[t]
        live = mask[t][:, None]
        d_new = np.where(live, dh, 0)
        d_prev = np.where(live, 0, dh) + d_new * z
        d_cand = d_new * (1 - z) * (1 - cand**2)
        dz = d_new * (h - cand) * z * (1 - z)
        dr = d_cand * hn * r * (1 - r)
        d_gates[t] = np.concatenate((dz, dr, d_cand), 1)
        du = np.concatenate((dz, dr, d_cand * r), 1)
        dU += h.T @ du
        dc += (d_cand * r).sum(0)
        dh = d_prev + du @ U.T
    return d_gates, dU, dc


def forward(p: dict, gates_f: np.ndarray, gates_b: np.ndarray, mask: np.ndarray | None, keep: dict | None = None) -> np.ndarray:
    """Logits of windows; gates are steps x windows x 3 HIDDEN, those of the backward pass in reversed order of steps."""
    kf, kb = ([], []) if keep is not None else (None, None)
    f = gru(gates_f, mask, p["Uf"], p["cf"], kf)
    b = gru(gates_b, None if mask is None else mask[::-1], p["Ub"], p["cb"], kb)[::-1]
    states = np.concatenate((f, b), 2)
    u = np.tanh(states @ p["Wa"] + p["ba"])
    s = u @ p["va"]
    if mask is not None:
        s = np.where(mask, s, -1e9)
    e = np.exp(s - s.max(0))
    share = e / e.sum(0)
    pooled = np.einsum("tn,tnh->nh", share, states)
    if keep is not None:
        keep |= {"kf": kf, "kb": kb, "states": states, "u": u, "share": share, "pooled": pooled}
    return pooled @ p["wo"] + p["bo"][0]


def backward(p: dict, d_logit: np.ndarray, mask: np.ndarray, k: dict) -> tuple[dict, np.ndarray, np.ndarray]:
    g = {"wo": k["pooled"].T @ d_logit, "bo": d_logit.sum(keepdims=True)}
    d_pooled = d_logit[:, None] * p["wo"]
    d_states = k["share"][:, :, None] * d_pooled
    d_share = np.einsum("tnh,nh->tn", k["states"], d_pooled)
    ds = k["share"] * (d_share - (k["share"] * d_share).sum(0))
    g["va"] = np.einsum("tn,tna->a", ds, k["u"])
    du = ds[:, :, None] * p["va"] * (1 - k["u"] ** 2)
    g["Wa"] = np.einsum("tnh,tna->ha", k["states"], du)
    g["ba"] = du.sum((0, 1))
    d_states = d_states + du @ p["Wa"].T
    gf, g["Uf"], g["cf"] = gru_back(d_states[:, :, :HIDDEN], mask, p["Uf"], k["kf"])
    gb, g["Ub"], g["cb"] = gru_back(d_states[::-1, :, HIDDEN:], mask[::-1], p["Ub"], k["kb"])
    return g, gf, gb[::-1]


@dataclass
class Model:
    params: dict[str, np.ndarray]
    word_odds: Evidence
    gram_odds: Evidence
    #: Weights of (1, highest window, log of the sum over windows, log of their number) for the document's logit.
    pool: np.ndarray

    def gates(self, words: Words, static: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Each distinct word's input part of the gates, for both directions."""
        p = self.params
        if static is None:
            static = static_inputs(words, self.word_odds, self.gram_odds)
        x = np.concatenate((static, p["word"][(words.hashes % np.uint64(WORD_BUCKETS)).astype(np.int64)], gram_means(words, p["gram"])), 1)
        return x @ p["Wf"] + p["bf"], x @ p["Wb"] + p["bb"]

    def logits(self, gates_f: np.ndarray, gates_b: np.ndarray, index: np.ndarray) -> np.ndarray:
        """Logits of windows of word numbers (windows x WINDOW; -1 where a short text has no more words)."""
        out = np.empty(len(index), np.float32)
        for at in range(0, len(index), CHUNK):
            part = index[at : at + CHUNK].T
            mask = part >= 0 if (part[-1] < 0).any() else None
            out[at : at + CHUNK] = forward(self.params, gates_f[part], gates_b[part[::-1]], mask)
        return out


def pooled(best: np.ndarray, total: np.ndarray, count: np.ndarray) -> np.ndarray:
    n = np.log(np.maximum(count, 1))
    return np.stack((np.ones(len(best)), best, np.log(np.maximum(total, 1e-9)), n), 1)


def _window_index(numbers: np.ndarray) -> np.ndarray:
    first = windows(len(numbers))
    place = first[:, None] + np.arange(WINDOW)
    return np.where(place < len(numbers), numbers[np.minimum(place, max(len(numbers) - 1, 0))], -1) if len(first) else np.zeros((0, WINDOW), np.int64)


# --- training


def all_words(texts: list[bytes]) -> tuple[Words, list[np.ndarray]]:
    """The distinct words of many texts, and each text's words by number; worked out in blocks, so that memory follows
    the distinct words and not the bytes."""
    blocks, numbers, owners = [], [], []
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) < BLOCK):
            size += len(texts[to]) + 1
            to += 1
        data = np.frombuffer(b"\n".join(texts[at:to]) + b"\n", np.uint8)
        cuts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts[at:to]])))
        words, number, starts = distinct_words(data, cuts[:-1])
        blocks.append(words)
        bounds = np.searchsorted(starts, cuts)
        numbers += [number[a:b].astype(np.int32) for a, b in zip(bounds, bounds[1:], strict=False)]
        owners += [len(blocks) - 1] * (to - at)
        at = to
    base = np.cumsum([0] + [len(b.hashes) for b in blocks])
    keys, first, inverse = np.unique(np.concatenate([b.hashes for b in blocks]), return_index=True, return_inverse=True)
    block = np.searchsorted(base, first, "right") - 1
    runs = [blocks[k].grams[blocks[k].bounds[i - base[k]] : blocks[k].bounds[i - base[k] + 1]] for k, i in zip(block.tolist(), first.tolist(), strict=True)]
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in runs])))
    out = Words(keys, np.concatenate(runs) if runs else np.zeros(0, np.uint64), bounds)
    return out, [inverse[base[k] + n] for k, n in zip(owners, numbers, strict=True)]


def fit(texts: list[bytes], toxic: np.ndarray, prior: float, seed: int = 5, rounds: int = 3, epochs: int = 6) -> Model:
    """Trains on whole documents by their most suspicious windows, chosen anew in each round."""
    rng = np.random.default_rng(seed)
    words, docs = all_words(texts)
    fold = rng.permutation(len(texts)) % FOLDS
    gram_keys, gram_number = np.unique(words.grams, return_inverse=True)
    word_in = np.zeros((2, FOLDS, len(words.hashes)), np.int32)
    gram_in = np.zeros((2, FOLDS, len(gram_keys)), np.int32)
    for d, own in enumerate(docs):
        mine = np.unique(own)
        word_in[toxic[d], fold[d], mine] += 1
        if len(mine):
            runs = np.concatenate([gram_number[words.bounds[w] : words.bounds[w + 1]] for w in mine])
            gram_in[toxic[d], fold[d], np.unique(runs)] += 1

    def evidence(without: int | None):
        use = [f for f in range(FOLDS) if f != without]
        n = [max(1, int(((toxic == c) & np.isin(fold, use)).sum())) for c in (1, 0)]
        pick = lambda table: (table[1][use].sum(0), table[0][use].sum(0))
        return Evidence.build(words.hashes, *pick(word_in), *n), Evidence.build(gram_keys, *pick(gram_in), *n)

    static = [static_inputs(words, *evidence(f)) for f in range(FOLDS)]
    model = Model(init(rng), *evidence(None), np.array([0.0, 1.0, 0.0, 0.0]))
    p = model.params
    index = [_window_index(d) for d in docs]
    owner = np.repeat(np.arange(len(docs)), [len(i) for i in index])
    index = np.concatenate(index) if len(owner) else np.zeros((0, WINDOW), np.int64)
    first = np.searchsorted(owner, np.arange(len(docs)))
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    step = 0

    def scored():
        out = np.zeros(len(index), np.float32)
        for f in range(FOLDS):
            own = np.flatnonzero(fold[owner] == f)
            out[own] = model.logits(*model.gates(words, static[f]), index[own])
        return out

    def train(chosen, weight):
        nonlocal step
        for some in np.array_split(rng.permutation(chosen), max(1, len(chosen) // 256)):
            part = index[some].T
            mask = part >= 0
            used, inverse = np.unique(np.maximum(part, 0), return_inverse=True)
            inverse = inverse.reshape(part.shape)
            buckets = (words.hashes[used] % np.uint64(WORD_BUCKETS)).astype(np.int64)
            counts = np.diff(words.bounds)[used]
            gram_at = np.repeat(words.bounds[used], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            gram_bucket = (words.grams[gram_at] % np.uint64(GRAM_BUCKETS)).astype(np.int64)
            gram_word = np.repeat(np.arange(len(used)), counts)
            means = np.zeros((len(used), EMBED), np.float32)
            np.add.at(means, gram_word, p["gram"][gram_bucket])
            means /= np.maximum(counts, 1)[:, None]
            by_fold = np.stack([s[used] for s in static])
            f = fold[owner[some]]
            x = np.concatenate((by_fold[f[None, :], inverse], p["word"][buckets][inverse], means[inverse]), 2)
            keep: dict = {}
            gates = [x @ p[f"W{d}"] + p[f"b{d}"] for d in "fb"]
            logit = forward(p, gates[0], gates[1][::-1], mask, keep)
            label = toxic[owner[some]]
            d_logit = ((sigmoid(logit) - label) * weight[label] / len(some)).astype(np.float32)
            g, gf, gb = backward(p, d_logit, mask, keep)
            flat = x.reshape(-1, INPUT)
            dx = np.zeros_like(flat)
            for d, dg in (("f", gf), ("b", gb)):
                dg = dg.reshape(-1, 3 * HIDDEN)
                g[f"W{d}"], g[f"b{d}"] = flat.T @ dg, dg.sum(0)
                dx += dg @ p[f"W{d}"].T
            per_word = np.zeros((len(used), INPUT), np.float32)
            np.add.at(per_word, inverse.ravel(), dx)
            g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
            np.add.at(g["word"], buckets, per_word[:, STATIC : STATIC + EMBED])
            np.add.at(g["gram"], gram_bucket, (per_word[:, STATIC + EMBED :] / np.maximum(counts, 1)[:, None])[gram_word])
            step += 1
            for k, v in p.items():
                m, s = moment[k]
                grad = g[k] + 1e-4 * v
                m += 0.1 * (grad - m)
                s += 0.001 * (grad**2 - s)
                v -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)

    full = np.flatnonzero(np.diff(np.append(first, len(owner))) > 0)
    if not len(full) or toxic.min() == toxic.max():
        model.pool = np.array([np.log(prior / (1 - prior)), 0, 0, 0])
        return model
    strength = np.zeros(len(index), np.float32)
    for f in range(FOLDS):
        own = np.flatnonzero(fold[owner] == f)
        strength[own] = np.where(index[own] >= 0, np.maximum(static[f][np.maximum(index[own], 0), 0], static[f][np.maximum(index[own], 0), 1]), 0).max(1)
    for turn in range(rounds):
        order = np.lexsort((rng.random(len(index)), -(strength if turn == 0 else scored()), owner))
        top = order[first[full]]
        chance = rng.choice(len(index), min(len(index), len(full)))
        clean = chance[toxic[owner[chance]] == 0]
        chosen = np.concatenate((top, clean))
        share = toxic[owner[chosen]].mean()
        for _ in range(epochs):
            train(chosen, np.array([0.5 / (1 - share), 0.5 / share], np.float32))
    logit = scored()
    best = np.full(len(docs), -10.0)
    total, count = np.zeros(len(docs)), np.zeros(len(docs))
    np.maximum.at(best, owner, logit)
    np.add.at(total, owner, np.exp(np.minimum(logit, 30)))
    np.add.at(count, owner, 1)
    x, y = pooled(best, total, count)[full], toxic[full]
    share = y.mean()
    weight = np.where(y == 1, prior / share, (1 - prior) / (1 - share))
    w = np.zeros(x.shape[1])
    for _ in range(25):  # Newton's method with a ridge
        q = sigmoid(x @ w)
        grad = x.T @ (weight * (q - y)) + 0.5 * w
        w -= np.linalg.solve((x * (weight * q * (1 - q))[:, None]).T @ x + 0.5 * np.eye(len(w)), grad)
    model.pool = w
    return model


# --- tables


def held_out() -> F.Column:
    """True for rows whose labels are never learned from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from labelled rows that aren't held out; None if there are none.

    The fit is bounded: about `sample` whole documents of each class, picked by a hash of doc_id, and about MOST_BYTES of text in all come to the driver.
    Labels that repeat a doc_id count once, as toxic if any says so, and so do rows: their smallest text is learned from.
    """
    said = labels.where("toxic in (0, 1) and doc_id is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(~held_out())
    known = said.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    if not counts:
        return None
    draw = F.pmod(F.xxhash64(F.lit("toxic-sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, sample / counts.get(1, 1)).otherwise(sample / counts.get(0, 1))
    picked = F.broadcast(known.where(draw < share))  # two times `sample` rows
    rows = docs.where("text is not null").select("doc_id", "text").join(picked, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = materialize(rows, "learned")
    n_bytes = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    if n_bytes > MOST_BYTES:
        again = F.pmod(F.xxhash64(F.lit("toxic-bytes"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
        rows = rows.where(again < MOST_BYTES / n_bytes).where(F.octet_length("text") <= MOST_BYTES // 16)
    rows = rows.orderBy("doc_id").collect()
    if not rows:
        return None
    prior = min(0.99, max(0.01, counts.get(1, 0) / sum(counts.values())))
    return fit([r["text"].encode("utf-8", "replace") for r in rows], np.array([r["toxic"] for r in rows]), prior)


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, row after the last, bytes) of runs of rows of about BLOCK bytes; a longer row comes in pieces.

    Each piece of a long row begins STRIDE words or more before the end of the last, so windows overlap throughout.
    """
    row, n = 0, len(offsets) - 1
    while row < n:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1)
        part = data[offsets[row] : offsets[last]]
        if len(part) <= BLOCK:
            yield row, last, part
        else:
            at = 0
            while at < len(part):
                stop = min(len(part), at + BLOCK)
                while stop < len(part) and not SPACE[part[stop]]:
                    stop += 1
                yield row, last, part[at:stop]
                if stop == len(part):
                    break
                gaps = np.flatnonzero(SPACE[part[at + 1 : stop]])
                back = at + 1 + int(gaps[-WINDOW]) if len(gaps) >= WINDOW else stop
                at = back if back > at + (stop - at) // 2 else stop
        row = last


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score (0 to 1) of every row: all overlapping windows of the whole text, pooled.

    Texts without words (null, empty, white space) have score 0; so has every text if there was nothing to learn
    from. Rows that repeat a doc_id are scored each. An empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            n = batch.num_rows
            best, total, count = np.full(n, -np.inf), np.zeros(n), np.zeros(n)
            data, offsets = utf8(batch.column("text"))
            for row, last, part in _pieces(data, offsets) if m is not None else ():
                if not len(part):
                    continue
                long = last == row + 1
                cuts = np.zeros(1, np.int64) if long else offsets[row:last] - offsets[row]
                words, number, starts = distinct_words(part, cuts)
                if not len(number):
                    continue
                bounds = np.array([0, len(number)]) if long else np.searchsorted(starts, offsets[row : last + 1] - offsets[row])
                index = [_window_index(number[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
                owner = np.repeat(np.arange(row, last), [len(i) for i in index])
                gates = m.gates(words)
                index = np.concatenate(index)
                short = index[:, -1] < 0  # texts of less than a window apart, so that the others need no mask
                for some in (np.flatnonzero(~short), np.flatnonzero(short)):
                    logit = m.logits(*gates, index[some]).astype(np.float64)
                    np.maximum.at(best, owner[some], logit)
                    np.add.at(total, owner[some], np.exp(np.minimum(logit, 30)))
                    np.add.at(count, owner[some], 1)
            full = count > 0
            out = np.zeros(n)
            if full.any():
                out[full] = sigmoid(pooled(best[full], total[full], count[full]) @ m.pool)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out)], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from labels of those that aren't held out; null, empty, repeated and long texts as in `learn` and `score`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
