"""Language-model scores: a log-bilinear model of the greatest likelihood over the whole training text, and counts of the whole corpus."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ._bytes import LOWER, SPACE, mix, utf8, word_hashes
from ._common import bounded_batches, materialize

#: Words with an output of their own in the model; the others share CLASSES outputs, by their last three bytes.
WORDS, CLASSES = 1024, 128
#: At most so many of the most frequent words, with their counts, go to every worker; all others are joined by shuffle.
HEAD = 1 << 18
#: Steps of the fit, over all places of the training text each, and their rate at first.
FIT, FIT_RATE = 60, 0.05
#: The prior on token and output vectors, in roots of the places of an output: it fades as the text grows.
STIFF = 8.0
DIM, EPOCHS, BATCH, NOISE, RATE = 32, 3, 1024, 256, 0.06
#: Steps of an epoch at least, as far as batches can be made smaller for it.
STEPS = 250
#: Outputs 0 and 1: what stands before a text (never predicted), and its end.
START, END = 0, 1
CONTEXT = 2
_DRAW = np.uint64(0x2545F4914F6CDD1D)


def held_out() -> Column:
    """True for rows that are never learned from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1


# --- tokens


def endings(data: np.ndarray, cuts: np.ndarray, classes: int) -> np.ndarray:
    """The class of each word of a run of bytes, by its last three bytes in lower case; `cuts` are the starts of rows inside it."""
    gap = SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[cuts] = True
    starts = np.flatnonzero(~gap & (np.concatenate(([True], gap[:-1])) | edge[:-1]))
    ends = np.flatnonzero(~gap & (np.concatenate((gap[1:], [True])) | edge[1:])) + 1
    code = np.zeros(len(ends), np.uint64)
    for back in range(1, 4):
        there = ends - back
        code = (code << np.uint64(8)) | np.where(there >= starts, LOWER[data[np.maximum(there, 0)]], 0).astype(np.uint64)
    return (mix(code + np.uint64(1)) % np.uint64(classes)).astype(np.int32)


def tokens(column, classes: int = CLASSES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row after the last, hashes of their words, word classes, word offsets by row) for runs of whole rows."""
    data, offsets = utf8(column)
    for first, last, h, bounds in word_hashes(data, offsets):
        part = data[offsets[first] : offsets[last]]
        kinds = endings(part, offsets[first:last] - offsets[first], classes) if len(part) else np.zeros(0, np.int32)
        yield first, last, h, kinds, bounds


# --- counts of the corpus


def _count(classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [(h, kinds) for _, _, h, kinds, _ in tokens(batch.column("text"), classes)]
            if held:
                word, at, n = np.unique(np.concatenate([h for h, _ in held]), return_index=True, return_counts=True)
                kind = np.concatenate([k for _, k in held])[at]
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(kind), pa.array(n.astype(np.int64))], names=["word", "kind", "n"])

    return run


def counts(docs: DataFrame, classes: int = CLASSES) -> DataFrame:
    """(word, kind, n): how often each word of all rows occurs, by its 64-bit hash; counted in the tasks before the shuffle."""
    bounded_batches(docs.sparkSession)
    rows = docs.select("text").mapInArrow(_count(classes), "word long, kind int, n long")
    return rows.groupBy("word").agg(F.first("kind").alias("kind"), F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """The bounded part of the counts that every worker has.

    head (sorted hashes), head_n, head_out (the word's own output, or -1); kind_n, kind_v: occurrences and distinct words of each
    class without the words that have an output; n_ends, n_tokens, n_types: of the whole training text.
    """

    head: np.ndarray
    head_n: np.ndarray
    head_out: np.ndarray
    kind_n: np.ndarray
    kind_v: np.ndarray
    n_ends: int
    n_tokens: int
    n_types: int

    @property
    def n_words(self) -> int:
        return int((self.head_out >= 0).sum())

    def find(self, h: np.ndarray) -> np.ndarray:
        """The place of each hash in `head`, or -1."""
        if not len(self.head):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.head, h), len(self.head) - 1)
        return np.where(self.head[at] == h, at, -1)

    def outputs(self, at: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """The output of each word, from its place in `head` and its class."""
        own = np.where(at >= 0, self.head_out[at], -1) if len(self.head) else np.full(len(at), -1)
        return np.where(own >= 0, own, 2 + self.n_words + kinds)

    def totals(self) -> np.ndarray:
        """Occurrences of each output in the training text."""
        own = np.zeros(self.n_words, np.int64)
        has = self.head_out >= 0
        own[self.head_out[has] - 2] = self.head_n[has]
        return np.concatenate(([0, self.n_ends], own, self.kind_n))

    def kind_log(self) -> np.ndarray:
        """log10 of what a class's word counts are divided by: one unseen word a class has half an occurrence."""
        return np.log10(self.kind_n + 0.5 * (self.kind_v + 1))

    def base_log(self) -> float:
        return float(np.log10(self.n_tokens + 0.5 * (self.n_types + 1)))


def lexicon(counted: DataFrame, n_ends: int, words: int = WORDS, classes: int = CLASSES, head: int = HEAD) -> Lexicon:
    """Totals over all counts, and the at most `head` most frequent words.

    Which words these are follows from a histogram of counts (steps of an eighth of a power of two, so a few hundred rows whatever the corpus): the
    lowest step is taken with which they are no more than `head`. Nothing that grows with the corpus comes to the driver.
    """
    per = counted.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()  # a row a class
    kind_n, kind_v = np.zeros(classes, np.int64), np.zeros(classes, np.int64)
    for r in per:
        kind_n[r["kind"]], kind_v[r["kind"]] = r["n"], r["v"]
    n_tokens, n_types = int(kind_n.sum()) + n_ends, int(kind_v.sum()) + (n_ends > 0)
    step = F.floor(F.log2("n") * 8).cast("int")
    room, least = head, None
    for r in counted.groupBy(step.alias("step")).count().orderBy(F.col("step").desc()).collect():  # some hundred rows
        room -= r["count"]
        if room < 0:
            break
        least = r["step"]
    top = counted.where(step >= least).toArrow() if least is not None else None
    if top is None:
        empty = np.zeros(0, np.int64)
        return Lexicon(empty.view(np.uint64), empty, empty, kind_n, kind_v, n_ends, n_tokens, n_types)
    h, n, kind = top["word"].to_numpy().view(np.uint64), top["n"].to_numpy(), top["kind"].to_numpy().astype(np.int64)
    order = np.argsort(h)
    h, n, kind = h[order], n[order], kind[order]
    best = np.lexsort((h, -n))[:words]
    out = np.full(len(h), -1, np.int64)
    out[best] = 2 + np.arange(len(best))
    np.subtract.at(kind_n, kind[best], n[best])
    np.subtract.at(kind_v, kind[best], 1)
    return Lexicon(h, n, out, kind_n, kind_v, n_ends, n_tokens, n_types)


# --- the model


@dataclass
class Model:
    """log p(output | a, b) = one[a, output] + two[b, output] - norm[a, b]: a is the token two places before, b the one before."""

    one: np.ndarray
    two: np.ndarray
    norm: np.ndarray

    def log_probabilities(self, a: np.ndarray, b: np.ndarray, out: np.ndarray) -> np.ndarray:
        """Natural logarithms, normalised over all outputs but START."""
        return self.one[a, out].astype(np.float64) + self.two[b, out] - self.norm[a, b]


class Network:
    """A log-bilinear network: context vectors, one matrix a place, output vectors and biases."""

    def __init__(self, totals: np.ndarray, dim: int = DIM, seed: int = 0):
        rng = np.random.default_rng(seed)
        n = len(totals)
        smooth = totals + 0.5
        smooth[START] = 0
        self.noise = smooth / smooth.sum()
        self.known = np.log(np.maximum(self.noise, 1e-30))
        self.weights = {
            "R": rng.normal(0, 0.3, (n, dim)), "Q": np.zeros((n, dim)), "bias": self.known.copy(),
            **{f"C{i}": np.eye(dim) + rng.normal(0, 0.05, (dim, dim)) for i in range(CONTEXT)},
        }

    def _logits(self, context: np.ndarray, target: np.ndarray, noise: np.ndarray):
        """The log odds that the target, and that each of `noise`, is data and not noise; the places of a batch share the noise."""
        w = self.weights
        seen = [w["R"][context[:, i]] for i in range(CONTEXT)]
        hidden = sum(s @ w[f"C{i}"] for i, s in enumerate(seen))
        k = np.log(len(noise))
        yes = (hidden * w["Q"][target]).sum(1) + w["bias"][target] - k - self.known[target]
        no = hidden @ w["Q"][noise].T + (w["bias"][noise] - k - self.known[noise])
        return seen, hidden, yes, no

    def loss(self, context: np.ndarray, target: np.ndarray, noise: np.ndarray) -> float:
        """Noise-contrastive loss a place."""
        _, _, yes, no = self._logits(context, target, noise)
        return float((np.logaddexp(0, -yes).sum() + np.logaddexp(0, no).sum()) / len(target))

    def gradients(self, context: np.ndarray, target: np.ndarray, noise: np.ndarray) -> dict:
        """Of `loss`."""
        w, n = self.weights, len(target)
        seen, hidden, yes, no = self._logits(context, target, noise)
        d_yes = -1 / (1 + np.exp(np.clip(yes, -50, 50))) / n
        d_no = 1 / (1 + np.exp(np.clip(-no, -50, 50))) / n
        d_hidden = d_yes[:, None] * w["Q"][target] + d_no @ w["Q"][noise]
        grads = {name: np.zeros_like(value) for name, value in w.items()}
        np.add.at(grads["Q"], target, d_yes[:, None] * hidden)
        np.add.at(grads["Q"], noise, d_no.T @ hidden)
        np.add.at(grads["bias"], target, d_yes)
        np.add.at(grads["bias"], noise, d_no.sum(0))
        for i, s in enumerate(seen):
            grads[f"C{i}"] = s.T @ d_hidden
            np.add.at(grads["R"], context[:, i], d_hidden @ w[f"C{i}"].T)
        return grads

    def train(self, windows: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH, noise: int = NOISE, rate: float = RATE, seed: int = 0) -> None:
        """Adagrad over shuffled windows (two outputs before, and the one that follows); few windows come in smaller batches."""
        rng = np.random.default_rng(seed)
        batch = max(32, min(batch, len(windows) // STEPS))
        squares = {name: np.full_like(v, 1e-3) for name, v in self.weights.items()}
        cumulative = np.cumsum(self.noise)
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), batch):
                own = windows[order[at : at + batch]]
                drawn = np.minimum(np.searchsorted(cumulative, rng.random(noise) * cumulative[-1], "right"), len(cumulative) - 1)
                for name, g in self.gradients(own[:, :CONTEXT], own[:, CONTEXT], drawn).items():
                    squares[name] += g * g
                    self.weights[name] -= rate * g / np.sqrt(squares[name])

    def likelihood(self, one: np.ndarray, two: np.ndarray, contexts: np.ndarray) -> tuple[float, dict]:
        """The negative log likelihood a place of a text, with a prior on R and Q, and its gradients.

        `one` and `two` say how often each output stands two places and one place behind each token, `contexts` how often each pair of tokens is
        a context. They are all that the likelihood of a log-bilinear model needs of the text: the scores are linear in the first two,
        and normalisers depend on contexts alone.
        """
        w, places = self.weights, max(1.0, float(two.sum(dtype=np.float64)))
        stiff = STIFF * float(np.sqrt(places / len(two)))
        first, second = w["R"] @ w["C0"], w["R"] @ w["C1"]
        x, y = first @ w["Q"].T, second @ w["Q"].T + w["bias"]
        y[:, START] = -np.inf
        high, low = x.max(1, keepdims=True), y.max(1, keepdims=True)
        ex, ey = np.exp(x - high), np.exp(y - low)
        total = np.maximum(ex @ ey.T, np.finfo(ex.dtype).tiny)
        share = contexts / total
        y[:, START] = 0
        prior = 0.5 * stiff * float((w["R"] ** 2).sum() + (w["Q"] ** 2).sum())
        fit = float((one * x).sum(dtype=np.float64) + (two * y).sum(dtype=np.float64)) - float((contexts * (np.log(total) + high + low.T)).sum(dtype=np.float64))
        dx, dy = (ex * (share @ ey) - one) / places, (ey * (share.T @ ex) - two) / places
        d_first, d_second = dx @ w["Q"], dy @ w["Q"]
        return (prior - fit) / places, {
            "R": d_first @ w["C0"].T + d_second @ w["C1"].T + stiff / places * w["R"], "Q": dx.T @ first + dy.T @ second + stiff / places * w["Q"], "bias": dy.sum(0),
            "C0": w["R"].T @ d_first, "C1": w["R"].T @ d_second,
        }

    def learn(self, one: np.ndarray, two: np.ndarray, contexts: np.ndarray, steps: int = FIT, rate: float = FIT_RATE) -> None:
        """Adam on `likelihood`, the whole text in each step; the rate falls to zero."""
        one, two, contexts = (x.astype(np.float32) for x in (one, two, contexts))
        self.weights = {name: v.astype(np.float32) for name, v in self.weights.items()}
        mean, square = ({name: np.zeros_like(v) for name, v in self.weights.items()} for _ in range(2))
        for step in range(1, steps + 1):
            for name, g in self.likelihood(one, two, contexts)[1].items():
                mean[name] += 0.1 * (g - mean[name])
                square[name] += 0.01 * (g * g - square[name])
                now = rate * 0.5 * (1 + np.cos(np.pi * (step - 1) / steps))
                self.weights[name] -= np.float32(now / (1 - 0.9**step)) * mean[name] / (np.sqrt(square[name] / np.float32(1 - 0.99**step)) + np.float32(1e-9))
        self.weights = {name: v.astype(np.float64) for name, v in self.weights.items()}

    def model(self) -> Model:
        """Scores of all outputs after every token at each place, and the normaliser of every context, by products of whole matrices.

        A context's scores are sums of one row for each of its two places, so the sum of their exponentials over all outputs is an entry of the
        product of the two matrices of exponentials.
        """
        w = self.weights
        one = (w["R"] @ w["C0"] @ w["Q"].T).astype(np.float32)
        two = (w["R"] @ w["C1"] @ w["Q"].T + w["bias"]).astype(np.float32)
        two[:, START] = -np.inf
        high, low = one.max(1).astype(np.float64), two.max(1).astype(np.float64)
        norm = np.log(np.exp(one - high[:, None]) @ np.exp(two - low[:, None]).T) + high[:, None] + low
        return Model(one, two, norm)


def _contexts(out: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, target, row) of every token and end of some rows, whose words' outputs are `out`."""
    n = len(bounds) - 1
    sizes = np.diff(bounds) + 1
    row = np.repeat(np.arange(n), sizes)
    target = np.full(len(row), END)
    ends = np.cumsum(sizes) - 1
    inside = np.ones(len(row), bool)
    inside[ends] = False
    target[inside] = out
    first = np.concatenate(([0], ends[:-1] + 1))
    place = np.arange(len(row)) - first[row]
    b = np.where(place >= 1, np.concatenate(([START], target[:-1])), START)
    a = np.where(place >= 2, np.concatenate(([START, START], target[:-2]))[: len(row)], START)
    return a, b, target, row


def _followers(shared, classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex: Lexicon = shared.value
        size = 2 + lex.n_words + classes
        seen = np.zeros(2 * size * size, np.int64)
        for batch in batches:
            for _, _, h, kinds, bounds in tokens(batch.column("text"), classes):
                a, b, target, _ = _contexts(lex.outputs(lex.find(h), kinds), bounds)
                for place, before in enumerate((a, b)):
                    np.add.at(seen, (place * size + before) * size + target, 1)
        cells = np.flatnonzero(seen)
        for at in range(0, len(cells), 1 << 18):
            part = cells[at : at + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(seen[part])], names=["cell", "n"])

    return run


def followers(docs: DataFrame, lex: Lexicon, classes: int = CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """How often each output stands two places, and one place, behind each token in all rows; summed in the tasks and then by cell.

    At most two numbers for each pair of outputs come to the driver, however large the corpus, and as columns: millions of row objects would take
    hundreds of MB there.
    """
    bounded_batches(docs.sparkSession)
    size = 2 + lex.n_words + classes
    rows = docs.select("text").mapInArrow(_followers(docs.sparkSession.sparkContext.broadcast(lex), classes), "cell int, n long")
    got = rows.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros(2 * size * size)
    seen[got["cell"].to_numpy()] = got["n"].to_numpy()
    one, two = seen.reshape(2, size, size)
    return one, two


def contexts_of(two: np.ndarray) -> np.ndarray:
    """How often each pair of tokens is a context: whatever follows a token, but for an end, is followed itself; and each text begins with nothing before it."""
    out = two.copy()
    out[:, END] = 0
    out[START, START] = two[START].sum()
    return out


def fit(docs: DataFrame, lex: Lexicon, steps: int = FIT, classes: int = CLASSES) -> Model:
    """The model of all training rows: every place of their texts counts in every step, by `followers`, which is all that the likelihood depends on."""
    network = Network(lex.totals())
    if lex.n_tokens:
        one, two = followers(docs, lex, classes)
        network.learn(one, two, contexts_of(two), steps)
    return network.model()


# --- scores


def _score(shared, classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, model = shared.value
        kind_log, half = lex.kind_log(), np.log10(0.5)
        log_n = np.log10(lex.head_n + 0.5)
        for batch in batches:
            n = batch.num_rows
            n_tokens, n_known = np.ones(n, np.int64), np.full(n, int(lex.n_ends > 0))
            base, score = np.full(n, np.log10(lex.n_ends + 0.5)), np.zeros(n)
            rest, rest_bounds = [np.zeros(0, np.uint64)], np.zeros(n + 1, np.int64)
            for first, last, h, kinds, bounds in tokens(batch.column("text"), classes):
                at = lex.find(h)
                out = lex.outputs(at, kinds)
                row = np.repeat(np.arange(last - first), np.diff(bounds))
                total = lambda x: np.bincount(row, x, last - first)  # noqa: B023, E731
                there = at >= 0
                n_tokens[first:last] += np.diff(bounds)
                n_known[first:last] += np.bincount(row[there], minlength=last - first)
                # a word outside head counts as unseen until the join finds it
                own = np.where(there, log_n[at], half) if len(log_n) else np.full(len(at), half)
                base[first:last] += total(own)
                a, b, target, place = _contexts(out, bounds)
                score[first:last] += np.bincount(place, model.log_probabilities(a, b, target), last - first) / np.log(10)
                shared_out = out >= 2 + lex.n_words
                score[first:last] += total(np.where(shared_out, own - kind_log[kinds], 0.0))
                rest.append(h[~there])
                rest_bounds[first + 1 : last + 1] = np.bincount(row[~there], minlength=last - first)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(rest_bounds).astype(np.int32)), pa.array(np.concatenate(rest).view(np.int64)))
            base -= n_tokens * lex.base_log()
            found = [pa.array(n_tokens), pa.array(n_known), pa.array(base), pa.array(score), lists]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *found], names=["doc_id", "held_out", "row", "n_tokens", "n_known", "base_score", "score", "rest"])

    return run


def score_documents(docs: DataFrame, train: Column | None = None) -> DataFrame:
    """doc_id and what the corpus and the model say of every row of `docs` (doc_id, text; other columns are ignored).

    Learns from the rows where `train` holds (default: not held out). Tokens are the words of the whole text, A-Z in lower case, split at ASCII white space, and one end
    a text; null is the empty text, which is its end alone. base_score is the sum over the tokens of log10((c + 0.5) / (N + 0.5 * (V + 1))).

    score is the log10 probability of the text under the model: a log-bilinear network of the two tokens before predicts the end, one of the WORDS most frequent words, or the class
    of any other word; a word of a class with N' occurrences of V' training words has (c + 0.5) / (N' + 0.5 * (V' + 1)) of the class's probability, where c = 0 stands for one unseen
    word. Over all outcomes this sums to 1. Counts cover all training rows, and the network's weights are fitted to all of their places (`fit`).

    Words are told apart by 64-bit hashes: two of ten million different words share one with a probability of about 3e-6.
    Counts of the HEAD most frequent words are in every worker; other words go, by hash, to the table of counts, which isn't broadcast, and what is found
    there is added to their rows. Rows that repeat a doc_id are scored each. An empty table gives no rows; without training rows all scores of base are 0.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    train = ~held_out() if train is None else train
    learned = docs.select("doc_id", "text").where(train)
    counted = materialize(counts(learned), "counts")
    lex = lexicon(counted, learned.count())
    model = fit(learned, lex)
    rows = docs.select("doc_id", (~train).alias("held_out"), F.monotonically_increasing_id().alias("row"), "text")
    shared = spark.sparkContext.broadcast((lex, model))
    # the row's number is fixed by writing: what follows reads it from the files
    numbers = "n_tokens long, n_known long, base_score double, score double, rest array<long>"
    schema = StructType(rows.schema.fields[:3] + StructType.fromDDL(numbers).fields)
    plain = materialize(rows.mapInArrow(_score(shared, CLASSES), schema), "scored")
    return _with_rest(plain, counted, lex)


def _with_rest(plain: DataFrame, counted: DataFrame, lex: Lexicon) -> DataFrame:
    """Adds what the words outside head have in the table of counts."""
    tail = plain.select("row", F.explode("rest").alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
    more = (F.log10(F.col("n") + 0.5) - F.log10(F.lit(0.5))) * F.col("times")
    met = tail.join(counted, "word").groupBy("row").agg(F.sum("times").alias("more_known"), F.sum(more).alias("more"))
    out = plain.drop("rest").join(met, "row", "left")
    extra = F.coalesce("more", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(lex.n_tokens).cast("long").alias("train_tokens"), (F.col("base_score") + extra).alias("base_score"), (F.col("score") + extra).alias("score"),
    )


def op11_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from those that aren't held out; null, empty and repeated rows as in score_documents."""
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
