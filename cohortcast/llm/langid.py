"""Language ID: a bidirectional gated recurrent network over bytes.

Text is cut into windows of bytes.  A gated recurrent unit reads each window
forwards, another backwards; both states label every byte with a distribution
over the languages, and a document's probabilities are the mean over all its
bytes.  The network is trained in numpy on the driver by backpropagation
through time, on a bounded sample of labelled windows; prediction reads whole
texts, in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortcast.llm.common import OWN, give_back, sliced

#: Label where no language is named: no letter, or nothing was learned.
UNDETERMINED = "und"
#: Bytes of a window; state starts at zero at either end of it.
WINDOW_BYTES = 128
#: Windows the recurrence advances together, text bytes a task holds at a time.
LANES, SLICE_BYTES = 4096, 2_000_000


@dataclass(frozen=True)
class Settings:
    """Training.  The sample is ``windows_per_doc`` windows of at most
    ``docs_per_language`` documents of each language and ``sample_docs`` in all
    (each language has one at least, however many there are): 38,400 x 2 windows
    of 128 bytes, 10 MB on the driver."""

    hidden: int = 8
    docs_per_language: int = 600
    windows_per_doc: int = 2
    sample_docs: int = 38_400
    steps: int = 120
    batch: int = 128
    rate: float = 0.02
    seed: int = 11


@dataclass
class Model:
    """Weights of both directions: byte tables (256, 3H), recurrences (H, 3H),
    biases (3H) and read-outs (H, C); gates in the order update, reset, new."""

    languages: list[str]
    tables: list[np.ndarray]
    recurs: list[np.ndarray]
    biases: list[np.ndarray]
    outs: list[np.ndarray]
    offset: np.ndarray


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _softmax(x):
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class _Direction:
    """One direction over a batch; keeps what going back through time needs."""

    def __init__(self, table, recur, bias):
        self.table, self.recur, self.bias = table, recur, bias
        self.h_size = recur.shape[0]

    def forward(self, x, mask):
        n, (steps, lanes) = self.h_size, x.shape
        h = np.zeros((lanes, n))
        self.kept, states = [], np.empty((steps, lanes, n))
        for t in range(steps):
            a, u = self.table[x[t]] + self.bias, h @ self.recur
            z, r = _sigmoid(a[:, :n] + u[:, :n]), _sigmoid(a[:, n:2 * n] + u[:, n:2 * n])
            new = np.tanh(a[:, 2 * n:] + r * u[:, 2 * n:])
            m = mask[t][:, None]
            self.kept.append((h, z, r, new, u[:, 2 * n:], m))
            h = m * (new + z * (h - new)) + (1 - m) * h
            states[t] = h
        return states

    def backward(self, x, d_states):
        """Gradients of table, recurrence and bias from those of the states."""
        n, (steps, lanes) = self.h_size, x.shape
        d_recur, d_bias, d_inputs = np.zeros_like(self.recur), np.zeros_like(self.bias), np.empty((3 * n, steps, lanes))
        dh = np.zeros((lanes, n))
        for t in range(steps - 1, -1, -1):
            h, z, r, new, un, m = self.kept[t]
            dh = dh + d_states[t]
            d_out, dh = dh * m, dh * (1 - m)
            d_new = d_out * (1 - z) * (1 - new * new)
            d_z = d_out * (h - new) * z * (1 - z)
            d_r = d_new * un * r * (1 - r)
            d_a = np.concatenate([d_z, d_r, d_new], 1)
            d_u = np.concatenate([d_z, d_r, d_new * r], 1)
            d_inputs[:, t] = d_a.T
            d_bias += d_a.sum(0)
            d_recur += h.T @ d_u
            dh = dh + d_out * z + d_u @ self.recur.T
        d_table = np.stack([np.bincount(x.ravel(), d.ravel(), 256) for d in d_inputs], 1)
        return d_table, d_recur, d_bias


def train(windows: list[bytes], labels: list[str], settings: Settings = Settings()) -> Model:
    """Fits the network to windows and their languages, which it draws evenly.

    Every byte of a window is to be labelled with the window's language:
    cross-entropy per byte, gradients through time in both directions, Adam.
    """
    rng = np.random.default_rng(settings.seed)
    languages = sorted(set(labels))
    n, c = settings.hidden, len(languages)
    shapes = {"table": (256, 3 * n), "recur": (n, 3 * n), "bias": (3 * n,), "out": (n, c)}
    params = {f"{k}{d}": rng.normal(0, 0.3 if k == "table" else 1 / np.sqrt(n), s) if k != "bias" else np.zeros(s)
              for d in "fb" for k, s in shapes.items()}
    params["offset"] = np.zeros(c)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    width = max(map(len, windows), default=1)
    data, length = np.zeros((len(windows), width), np.uint8), np.array([len(w) for w in windows])
    for i, w in enumerate(windows):
        data[i, :len(w)] = np.frombuffer(w, np.uint8)
    of = [np.flatnonzero([lang == name for lang in labels]) for name in languages]
    for step in range(1, settings.steps + 1 if c > 1 else 1):
        y = rng.integers(0, c, settings.batch)
        rows = np.array([rng.choice(of[k]) for k in y])
        x, mask = data[rows].T, (np.arange(width)[:, None] < length[rows]).astype(float)
        ways = [_Direction(params["table" + d], params["recur" + d], params["bias" + d]) for d in "fb"]
        hf = ways[0].forward(x, mask)
        hb = ways[1].forward(x[::-1], mask[::-1])[::-1]
        p = _softmax(hf @ params["outf"] + hb @ params["outb"] + params["offset"])
        d = p.copy()
        d[:, np.arange(settings.batch), y] -= 1
        d *= (mask / mask.sum(0).clip(1) / settings.batch)[:, :, None]
        grads = {"outf": np.einsum("tbh,tbc->hc", hf, d), "outb": np.einsum("tbh,tbc->hc", hb, d), "offset": d.sum((0, 1))}
        for way, k, xs, ds in ((ways[0], "f", x, d @ params["outf"].T), (ways[1], "b", x[::-1], (d @ params["outb"].T)[::-1])):
            grads["table" + k], grads["recur" + k], grads["bias" + k] = way.backward(xs, ds)
        norm = np.sqrt(sum((g * g).sum() for g in grads.values()))
        rate = settings.rate * min(1, 20 * (settings.steps + 1 - step) / settings.steps / 10)
        for k, g in grads.items():
            m, v = moments[k]
            g = g * min(1.0, 1.0 / (norm + 1e-12))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            params[k] -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    pick = lambda k: [params[k + d].astype(np.float32) for d in "fb"]
    return Model(languages, pick("table"), pick("recur"), pick("bias"), pick("out"), params["offset"].astype(np.float32))


def sample(docs: DataFrame, labelled: Column, settings: Settings = Settings(), id_col: str = "doc_id",
           text_col: str = "text", lang_col: str = "lang") -> list[tuple[bytes, str]]:
    """The training windows: of every language the first documents in the order
    of a hash of the id, ``docs_per_language`` at most and fewer where there are
    more languages than ``sample_docs`` has room for, each cut at places that
    its hash chooses."""
    rows = docs.where(labelled & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"))
    # a row a language, as in the model
    counts = (docs.where(labelled & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
              .groupBy(F.col(lang_col).cast("string").alias("lang")).count().collect())
    if not counts:
        return []
    each, part = max(1, min(settings.docs_per_language, settings.sample_docs // len(counts))), 1 << 20
    # twice as many and some pass the bound, so that enough do; a rare language's all
    bounds = docs.sparkSession.createDataFrame(
        [(r["lang"], int(np.ceil(min(1.0, (2 * each + 32) / r["count"]) * part))) for r in counts], "lang string, bound long")
    rows = rows.withColumn("h", F.xxhash64(F.coalesce("id", F.lit("")), F.lit(settings.seed)))
    # sent to the tasks, as the model is: a join that shuffles would deal whole texts out by language
    rows = rows.join(F.broadcast(bounds), "lang").withColumn("nth", F.pmod("h", F.lit(part))).where("nth < bound")
    at = lambda k: F.pmod(F.xxhash64("h", F.lit(k)), F.greatest(F.length("text") - WINDOW_BYTES, F.lit(0)) + 1).cast("int")
    cut = F.array(*[F.substring("text", at(k) + 1, F.lit(WINDOW_BYTES)) for k in range(settings.windows_per_doc)])
    rows = rows.select("h", "lang", "nth", cut.alias("cuts"))
    first = F.row_number().over(W.partitionBy("lang").orderBy("nth", "h", "cuts"))
    taken = (rows.withColumn("nth", first).where(F.col("nth") <= each)
             .select("h", "lang", F.posexplode("cuts").alias("k", "cut")).orderBy("h", "k", "cut").collect())
    # a cut of characters may begin with letters of several bytes: keep WINDOW_BYTES
    return [(r["cut"].encode()[:WINDOW_BYTES], r["lang"]) for r in taken if r["cut"]]


def learn(docs: DataFrame, labelled: Column | None = None, settings: Settings = Settings(), id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model of the rows of ``docs`` that ``labelled`` holds for (all)."""
    got = sample(docs, F.lit(True) if labelled is None else labelled, settings, id_col, text_col, lang_col)
    return train([w for w, _ in got], [lang for _, lang in got], settings)


class Reader:
    """A model's prediction, laid out for many windows at once."""

    def __init__(self, model: Model):
        n = self.n = model.recurs[0].shape[0]
        self.c = len(model.languages)
        # sigmoid(x) = tanh(x / 2) / 2 + 1 / 2: the halves go into the weights
        part = lambda w, a, b, f: np.ascontiguousarray(w[:, a:b] * np.float32(f))
        self.ways = []
        for table, recur, bias, out in zip(model.tables, model.recurs, model.biases, model.outs):
            x = table + bias
            gates = np.stack([part(x, 0, n, 0.5), part(x, n, 2 * n, 0.5)])
            turns = np.stack([part(recur, 0, n, 0.5), part(recur, n, 2 * n, 0.5)])
            self.ways.append((gates, turns, part(x, 2 * n, 3 * n, 1), part(recur, 2 * n, 3 * n, 1), out))
        self.offset = model.offset

    def _states(self, way: int, x: np.ndarray, mask: np.ndarray | None, logits: np.ndarray) -> None:
        """Runs one direction over x (steps, lanes), adds its part of logits."""
        gates, turns, table, recur, out = self.ways[way]
        lanes = x.shape[1]
        h, u = np.zeros((lanes, self.n), np.float32), np.empty((lanes, self.n), np.float32)
        zr, zr_x, new = np.empty((2, lanes, self.n), np.float32), np.empty((2, lanes, self.n), np.float32), np.empty_like(h)
        for t in range(len(x)) if way == 0 else range(len(x) - 1, -1, -1):
            np.take(gates[0], x[t], 0, zr_x[0], "clip")
            np.take(gates[1], x[t], 0, zr_x[1], "clip")
            np.matmul(h, turns, zr)
            zr += zr_x
            np.tanh(zr, zr)
            zr *= 0.5
            zr += 0.5
            np.matmul(h, recur, u)
            u *= zr[1]
            np.take(table, x[t], 0, new, "clip")
            new += u
            np.tanh(new, new)
            h -= new
            h *= zr[0]
            h += new
            if mask is not None:
                h *= mask[t]  # past the end: the state stays at its start
            logits[t] += h @ out

    def positions(self, x: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Probabilities (steps, lanes, languages) of every byte of windows."""
        padded = length.min(initial=len(x)) < len(x)
        mask = (np.arange(len(x))[:, None] < length).astype(np.float32)[:, :, None] if padded else None
        logits = np.empty((*x.shape, self.c), np.float32)
        logits[:] = self.offset
        for way in (0, 1):
            self._states(way, x, mask, logits)
        logits -= logits.max(-1, keepdims=True)
        np.exp(logits, logits)
        logits /= logits.sum(-1, keepdims=True)
        return logits if mask is None else logits * mask

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Probabilities (texts, languages): the mean over all bytes."""
        sizes = np.array([len(t) for t in texts], np.int64)
        windows = -(-sizes // WINDOW_BYTES)
        doc = np.repeat(np.arange(len(texts)), windows)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows)
        start = np.repeat(np.cumsum(sizes) - sizes, windows) + nth * WINDOW_BYTES
        length = np.minimum(sizes[doc] - nth * WINDOW_BYTES, WINDOW_BYTES)
        data = np.frombuffer(b"".join(texts) + bytes(WINDOW_BYTES), np.uint8)
        total = np.zeros((len(texts), self.c))
        lanes = max(64, LANES * 8 // max(8, self.c))
        order = np.argsort(-length, kind="stable")  # full windows need no mask
        for k in range(0, len(order), lanes):
            at = order[k:k + lanes]
            steps = np.arange(int(length[at].max()))
            p = self.positions(data[start[at] + steps[:, None]], length[at]).sum(0)
            np.add.at(total, doc[at], p)
        return total / np.maximum(sizes, 1)[:, None]


_WORKER: dict = {}


def predict(docs: DataFrame, model: Model, text_col: str = "text", label_col: str = "lang_pred",
            score_col: str = "score", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all) of ``docs`` with the language of the whole
    text and its probability.

    ``und`` with score 0 where the text is null or has no letter, or where the
    model has learned no language.  A tie goes to the first language by name.
    Equal texts get equal results; columns named as the results are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # a few kB a language
    kept = [c for c in (docs.columns if keep is None else keep) if c not in (label_col, score_col)]
    own_text = text_col not in kept
    marked = docs.select(*kept, *([F.col(text_col).cast("string").alias(f"{OWN}text")] if own_text else []),
                         F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias(f"{OWN}says"))
    names, at, n = [*kept, label_col, score_col], len(kept) if own_text else kept.index(text_col), len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _WORKER.get("of") is not held.value:
            _WORKER.update(of=held.value, reader=Reader(held.value))
        reader, languages = _WORKER["reader"], held.value.languages
        for whole in batches:
            for batch in sliced(whole, at, SLICE_BYTES):
                texts, said = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
                said = said & bool(languages)
                p = reader.documents([t.encode() for t, s in zip(texts, said) if s]) if said.any() else np.zeros((0, 1))
                label, score = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
                label[said], score[said] = [languages[k] for k in p.argmax(1)], np.clip(p.max(1, initial=0), 0, 1)
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(label, pa.string()), pa.array(score)], names=names)
            give_back()

    return marked.mapInArrow(run, T.StructType([*marked.schema.fields[:n], T.StructField(label_col, T.StringType()),
                                                T.StructField(score_col, T.DoubleType())]))


def remainder(id_col: str, by: int) -> Column:
    """crc32 of the id as text (null: empty), modulo ``by``."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % by


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4,
             held_out_fold: int = 2, settings: Settings = Settings()) -> DataFrame:
    """Learns from all folds but one and predicts all documents."""
    held_out = remainder(id_col, folds) == held_out_fold
    model = learn(docs, ~held_out, settings, id_col, text_col, lang_col)
    named = docs.select(F.col(id_col), held_out.alias("held_out"), F.col(text_col))
    return predict(named, model, text_col, keep=[id_col, "held_out"])
