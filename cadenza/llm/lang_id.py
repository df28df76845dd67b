"""Language ID by a bidirectional gated recurrent network over bytes (operator 6).

The network reads the bytes of a word in both directions and gives every
position a distribution over the languages; a document's probabilities pool
those of all its positions.  It is trained in numpy by backpropagation through
time on a bounded sample of labelled rows.

State starts anew at white space (and after SEGMENT bytes without any), so equal
words have equal outputs and a task computes each once.  Every word of the whole
text is read and pooled as often as it occurs.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .blocks import bound_batches

UNKNOWN = "und"
SEGMENT = 48
HIDDEN = 16
MEMO = 250_000
_LETTER = re.compile(rb"[a-z\x80-\xff]")
_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or (not text.isascii() and any(map(str.isalpha, text))))


def segments(text: str) -> list[bytes]:
    """The words of a text, A-Z folded; long ones in runs of SEGMENT bytes."""
    words = text.encode().lower().split()
    if max(map(len, words), default=0) <= SEGMENT:
        return words
    return [w[i:i + SEGMENT] for w in words for i in range(0, len(w), SEGMENT)]


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


@dataclass
class Network:
    """Parameters of both directions (``table``: input weights of each byte; ``u``, ``bias``: recurrent) and the output layer."""
    languages: list[str]
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, languages: list[str], hidden: int, seed: int) -> "Network":
        rng, p = np.random.default_rng(seed), {}
        for d in "fb":
            p[f"table_{d}"] = rng.normal(0, 0.3, (256, 3 * hidden))
            p[f"u_{d}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
            p[f"bias_{d}"] = np.zeros(3 * hidden)
            p[f"inner_{d}"] = np.zeros(hidden)
        p["out"] = rng.normal(0, 0.3, (2 * hidden, len(languages)))
        p["out_bias"] = np.zeros(len(languages))
        return cls(languages, {k: v.astype(np.float32) for k, v in p.items()})

    def _run(self, ids: np.ndarray, live: np.ndarray, d: str, keep: bool):
        """States of one direction, [time, batch, hidden]; with ``keep`` also what the backward pass needs."""
        table, u, bias, inner = (self.p[f"{k}_{d}"] for k in ("table", "u", "bias", "inner"))
        steps, hidden = ids.shape[1], u.shape[0]
        h = np.zeros((len(ids), hidden), np.float32)
        states, saved = np.zeros((steps, len(ids), hidden), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            x = table[ids[:, t]] + bias
            a = h @ u
            z = _sigmoid(x[:, :hidden] + a[:, :hidden])
            r = _sigmoid(x[:, hidden:2 * hidden] + a[:, hidden:2 * hidden])
            c = a[:, 2 * hidden:] + inner
            n = np.tanh(x[:, 2 * hidden:] + r * c)
            m = live[:, t:t + 1]
            new = h + m * (1 - z) * (n - h)                 # outside the word the state stays
            if keep:
                saved.append((t, h, z, r, c, n, m))
            h = new
            states[t] = h
        return states, saved

    def positions(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Log probabilities of every position, [time, batch, language]; positions after a word's end mean nothing."""
        live = (np.arange(ids.shape[1]) < lengths[:, None]).astype(np.float32)
        both = np.concatenate([self._run(ids, live, d, False)[0] for d in "fb"], axis=2)
        y = both @ self.p["out"] + self.p["out_bias"]
        y -= y.max(2, keepdims=True)
        return y - np.log(np.exp(y).sum(2, keepdims=True))

    def gradient(self, ids: np.ndarray, lengths: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over the positions and its gradient, by backpropagation through time."""
        live = (np.arange(ids.shape[1]) < lengths[:, None]).astype(np.float32)
        runs = {d: self._run(ids, live, d, True) for d in "fb"}
        both = np.concatenate([runs[d][0] for d in "fb"], axis=2)
        y = both @ self.p["out"] + self.p["out_bias"]
        y -= y.max(2, keepdims=True)
        prob = np.exp(y)
        prob /= prob.sum(2, keepdims=True)
        weight = (live / live.sum()).T[:, :, None]
        rows = np.arange(len(ids))
        loss = float(-(np.log(prob[:, rows, label] + 1e-12) * weight[:, :, 0]).sum())
        dy = prob.copy()
        dy[:, rows, label] -= 1
        dy *= weight
        g = {"out": np.einsum("tbh,tbl->hl", both, dy), "out_bias": dy.sum((0, 1))}
        dboth = dy @ self.p["out"].T
        hidden = len(self.p["inner_f"])
        for i, d in enumerate("fb"):
            u = self.p[f"u_{d}"]
            dstates = dboth[:, :, i * hidden:(i + 1) * hidden]
            dtable, du = np.zeros_like(self.p[f"table_{d}"]), np.zeros_like(u)
            dbias, dinner = np.zeros(3 * hidden, np.float32), np.zeros(hidden, np.float32)
            carry = np.zeros((len(ids), hidden), np.float32)
            for t, h, z, r, c, n, m in reversed(runs[d][1]):
                dh = dstates[t] + carry
                dn = dh * m * (1 - z) * (1 - n * n)
                dz = dh * m * (h - n) * z * (1 - z)
                dr = dn * c * r * (1 - r)
                dc = dn * r
                dx = np.concatenate([dz, dr, dn], axis=1)
                da = np.concatenate([dz, dr, dc], axis=1)
                seen, where = np.unique(ids[:, t], return_inverse=True)
                onehot = np.zeros((len(seen), len(ids)), np.float32)
                onehot[where, rows] = 1
                dtable[seen] += onehot @ dx
                du += h.T @ da
                dbias += dx.sum(0)
                dinner += dc.sum(0)
                carry = dh * (1 - m * (1 - z)) + da @ u.T
            g |= {f"table_{d}": dtable, f"u_{d}": du, f"bias_{d}": dbias, f"inner_{d}": dinner}
        return loss, g

    def word_sums(self, words: list[bytes]) -> np.ndarray:
        """Log probabilities summed over each word's positions, [word, language]."""
        out = np.zeros((len(words), len(self.languages)), np.float32)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for at in range(0, len(order), 1024):
            some = order[at:at + 1024]
            ids, lengths = padded([words[i] for i in some])
            live = (np.arange(ids.shape[1]) < lengths[:, None]).T[:, :, None]
            out[some] = (self.positions(ids, lengths) * live).sum(0)
        return out


def padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(w) for w in words])
    width = int(lengths.max())
    return np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width), lengths


def fit(words: list[bytes], labels: np.ndarray, languages: list[str], hidden: int = HIDDEN, epochs: int = 4,
        least_steps: int = 200, batch: int = 512, rate: float = 0.02, seed: int = 7) -> Network:
    """Train on (word, language) pairs with Adam; batches hold words of like length, in seeded order."""
    net = Network.fresh(languages, hidden, seed)
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    lengths = np.array([len(w) for w in words])
    epochs = max(epochs, -(-least_steps // -(-len(words) // batch)))         # a small sample is read more often
    step, total = 0, epochs * -(-len(words) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(words))
        order = order[np.argsort(lengths[order], kind="stable")]
        for b in rng.permutation(-(-len(words) // batch)):
            some = order[b * batch:(b + 1) * batch]
            ids, size = padded([words[i] for i in some])
            _, g = net.gradient(ids, size, labels[some])
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            step += 1
            pace = rate * (1 - 0.9 * step / total) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for k, v in g.items():
                v = v * min(1.0, 1 / (norm + 1e-9))
                first[k] += 0.1 * (v - first[k])
                second[k] += 0.001 * (v * v - second[k])
                net.p[k] -= (pace * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return net


def train(df: DataFrame, text_col: str, lang_col: str, order: Column, rows_per_language: int = 150,
          words_per_row: int = 60) -> Network | None:
    """Train on at most ``rows_per_language`` labelled rows of each language (the first by ``order``) and at most
    ``words_per_row`` words spread evenly over each row's whole text; None if no labelled row has a letter.

    These bounds are the only sample in this module: they bound what the driver
    gathers.  Languages weigh alike.
    """
    rows = df.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"), order.alias("key")) \
        .filter("text is not null and lang is not null and key is not null")
    ranked = rows.select("lang", "key").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("key")))
    last = ranked.filter(F.col("rank") <= rows_per_language).groupBy("lang").agg(F.max("key").alias("last"))
    chosen = rows.join(F.broadcast(last), "lang").filter(F.col("key") <= F.col("last")).select("lang", "key", "text")   # one row a language

    def words(batches):
        for batch in batches:
            lang, key, out = [], [], []
            for name, k, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = [w for w in segments(text) if _LETTER.search(w)]
                step = max(1, -(-len(found) // words_per_row))
                if found:
                    lang.append(name)
                    key.append(k)
                    out.append(found[::step])
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(key, pa.string()),
                                              pa.array(out, pa.list_(pa.binary()))], names=["lang", "key", "words"])

    # rows with equal keys (repeated ids) may exceed the bound by their repeats: cut again
    sample = chosen.mapInArrow(words, "lang string, key string, words array<binary>") \
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("key", F.xxhash64(F.to_json("words"))))) \
        .filter(F.col("rank") <= rows_per_language).orderBy("lang", "rank").select("lang", "words").collect()
    if not sample:
        return None
    languages = sorted({r.lang for r in sample})
    by = {name: [bytes(w) for r in sample if r.lang == name for w in r.words] for name in languages}
    most = max(len(v) for v in by.values())
    pairs = [(w, i) for i, name in enumerate(languages) for w in np.resize(np.array(by[name], object), most)]
    return fit([w for w, _ in pairs], np.array([i for _, i in pairs]), languages)


def predict(df: DataFrame, text_col: str, net: Network | None, carry: list[str]) -> DataFrame:
    """Language of every whole text, from its bytes alone.

    Returns (row struct of ``carry``, lang_pred string, score double: pooled
    probability of that language, 0 to 1; labels array of (lang, prob) structs).
    Null texts and texts without a letter are ``und`` with score 0 (and so is
    all, without a network).  Ties go to the language that sorts first.  Rows are
    read one by one, so repeated rows and null ids do not matter.
    """
    bound_batches(df.sparkSession)
    rows = F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")
    held = df.select(rows) if text_col in carry else df.select(rows, F.col(f"`{text_col}`").alias("text"))
    names = net.languages if net else []

    def run(batches):
        known: dict[bytes, int] = {}
        sums, sizes = np.zeros((0, len(names)), np.float32), np.zeros(0, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = (batch.column("row").field(text_col) if text_col in carry else batch.column("text")).to_pylist()
                letters = [bool(names) and has_letter(t) for t in texts]
                split = [segments(t) if ok else [] for t, ok in zip(texts, letters)]
                fresh = list(set().union(*split) - known.keys())
                if len(known) + len(fresh) > MEMO:
                    known.clear()
                    sums, sizes = sums[:0], sizes[:0]
                    fresh = list(set().union(*split))
                if fresh:
                    useful = np.array([_LETTER.search(w) is not None for w in fresh])
                    part = np.zeros((len(fresh), len(names)), np.float32)
                    if useful.any():
                        part[useful] = net.word_sums([w for w, u in zip(fresh, useful) if u])
                    known.update(zip(fresh, range(len(sums), len(sums) + len(fresh))))
                    sums = np.concatenate([sums, part])
                    sizes = np.concatenate([sizes, np.array([len(w) for w in fresh]) * useful])
                lang, score, labels = [], [], []
                for words, ok in zip(split, letters):
                    if not ok:
                        lang.append(UNKNOWN)
                        score.append(0.0)
                        labels.append([])
                        continue
                    where = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                    y = sums[where].sum(0, dtype=np.float64) / np.sqrt(max(1, sizes[where].sum()))
                    y = np.exp(y - y.max())
                    y /= y.sum()
                    best = int(np.argmax(y))
                    lang.append(names[best])
                    score.append(float(y[best]))
                    labels.append([{"lang": n, "prob": float(v)} for n, v in zip(names, y)])
                yield pa.RecordBatch.from_arrays([
                    batch.column("row"), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                    pa.array(labels, pa.list_(pa.struct([("lang", pa.string()), ("prob", pa.float64())])))],
                    names=["row", "lang_pred", "score", "labels"])

    kind = held.schema["row"].dataType.simpleString()
    return held.mapInArrow(run, f"row {kind}, lang_pred string, score double, labels array<struct<lang: string, prob: double>>")
