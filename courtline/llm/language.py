"""Language identification (operator 4): a bidirectional gated recurrent network over bytes.

Two gated recurrent layers of HIDDEN units read the bytes of a text in both directions; a softmax over
their joined states labels every byte with a language, and the probabilities of all bytes of a document
are averaged. Texts are read whole, in windows of WINDOW bytes that begin with an empty state. The network
is trained here, in numpy, by backpropagation through time with Adam.

It is fitted on a bounded sample of labelled documents, drawn by a hash of the doc_id among the documents that
are not held out: PER_LANGUAGE of each language at most, and fewer where there are very many languages, so that
there are SAMPLE documents at most or one of each language; of a longer text a piece of PIECE characters, its
place drawn too. Only their text and lang are learned from. Every language that occurs is learned.

Defined results: ``und`` with score 0 for NULL, empty and letterless texts, and for all texts when no
document is labelled; of languages with equal scores the first by name; NULL doc_ids are not held out;
repeated rows get equal results; very long texts are read whole; an empty table gives an empty result; other
columns, of any name, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup, small, text_batches
from .shingles import text_slices

HIDDEN = 8
WINDOW = 64
PER_LANGUAGE = 300
#: Documents of the sample, unless there are more languages, and characters of each: 48 MB at most.
SAMPLE, PIECE = 6_000, 2_000
STEPS, BATCH, RATE = 240, 192, 0.02
#: Windows that a task reads side by side.
SIDE_BY_SIDE = 2048
UNKNOWN = "und"


def held_out(doc_id: str = "doc_id") -> Column:
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


class BiGRU:
    """Parameters by name: for each direction d, W_d (byte to gates), U_d (state to gates), b_d; V, c."""

    def __init__(self, n_labels: int, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        h = HIDDEN
        self.p: dict[str, np.ndarray] = {}
        for d in "fb":
            self.p[f"W{d}"] = rng.normal(0, 0.3, (256, 3 * h)).astype(np.float32)
            self.p[f"U{d}"] = rng.normal(0, 0.3, (h, 3 * h)).astype(np.float32)
            self.p[f"b{d}"] = np.zeros(3 * h, np.float32)
        self.p["V"] = rng.normal(0, 0.3, (2 * h, n_labels)).astype(np.float32)
        self.p["c"] = np.zeros(n_labels, np.float32)

    def states(self, x: np.ndarray, mask: np.ndarray, d: str, trace: list | None = None) -> np.ndarray:
        """States of direction ``d`` after each byte; x and mask are (time, window). A masked byte
        leaves the state as it is."""
        h, p = HIDDEN, self.p
        table, u = p[f"W{d}"] + p[f"b{d}"], p[f"U{d}"]
        out = np.empty((*x.shape, h), np.float32)
        state = np.zeros((x.shape[1], h), np.float32)
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            gates, inner = table[x[t]], state @ u
            # Update and reset gates by one tanh: sigmoid(a) = (1 + tanh(a / 2)) / 2.
            zr = gates[:, : 2 * h] + inner[:, : 2 * h]
            zr *= 0.5
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            z, r = zr[:, :h], zr[:, h:]
            new = r * inner[:, 2 * h :]
            new += gates[:, 2 * h :]
            np.tanh(new, out=new)
            moved = state - new
            moved *= z
            moved += new
            if not mask[t].all():
                moved = np.where(mask[t][:, None], moved, state)
            if trace is not None:
                trace.append((t, state, z, r, new, inner[:, 2 * h :]))
            state = moved
            out[t] = state
        return out

    def probabilities(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Label probabilities of every byte, (time, window, label)."""
        both = np.concatenate([self.states(x, mask, "f"), self.states(x, mask, "b")], axis=2)
        return _softmax(both @ self.p["V"] + self.p["c"])

    def gradients(self, x: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over bytes and its gradients, by backpropagation through time."""
        h, p = HIDDEN, self.p
        traces: dict[str, list] = {"f": [], "b": []}
        both = np.concatenate([self.states(x, mask, d, traces[d]) for d in "fb"], axis=2)
        prob = _softmax(both @ p["V"] + p["c"])
        n = mask.sum()
        picked = np.take_along_axis(prob, label[None, :, None], axis=2)[:, :, 0]
        loss = float(-(np.log(picked + 1e-9) * mask).sum() / n)
        err = prob.copy()
        err[:, np.arange(x.shape[1]), label] -= 1
        err *= (mask / n)[:, :, None]
        flat = err.reshape(-1, err.shape[2])
        g = {"V": both.reshape(-1, 2 * h).T @ flat, "c": flat.sum(axis=0)}
        down = err @ p["V"].T
        for d, part in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            u = p[f"U{d}"]
            gw, gu = np.zeros_like(p[f"W{d}"]), np.zeros_like(u)
            back = np.zeros((x.shape[1], h), np.float32)
            for t, state, z, r, new, inner_n in reversed(traces[d]):
                dh = back + down[t][:, part]
                on = mask[t][:, None]
                dn = dh * (1 - z) * (1 - new * new)
                dz = dh * (state - new) * z * (1 - z)
                dr = dn * inner_n * r * (1 - r)
                pre = np.concatenate([dz, dr, dn], axis=1) * on
                rec = np.concatenate([dz, dr, dn * r], axis=1) * on
                gu += state.T @ rec
                np.add.at(gw, x[t], pre)
                back = np.where(on, dh * z + rec @ u.T, dh)
            g[f"W{d}"], g[f"U{d}"], g[f"b{d}"] = gw, gu, gw.sum(axis=0)
        return loss, g


def _softmax(a: np.ndarray) -> np.ndarray:
    a = np.exp(a - a.max(axis=-1, keepdims=True))
    a /= a.sum(axis=-1, keepdims=True)
    return a


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, mask, row) of all windows of a slice of texts; bytes and mask are (window, time)."""
    lengths = np.diff(offsets)
    per_row = -(-lengths // WINDOW)
    rows = np.repeat(np.arange(len(lengths)), per_row)
    first = np.cumsum(per_row) - per_row
    start = offsets[:-1][rows] + (np.arange(len(rows)) - first[rows]) * WINDOW
    at = start[:, None] + np.arange(WINDOW)
    mask = at < offsets[1:][rows][:, None]
    return data[np.where(mask, at, 0)] if len(data) else np.zeros(at.shape, np.uint8), mask, rows


def train(texts: list[str], labels: np.ndarray, n_labels: int, steps: int = STEPS, seed: int = 7) -> BiGRU:
    """Fit to labelled texts; every language has the same share of each batch."""
    parts = [windows(data, offsets) for _, _, data, offsets in text_slices(pa.array(texts, pa.large_string()), 1 << 60)]
    x, mask, rows = parts[0]
    of = labels[rows]
    groups = [np.flatnonzero(of == k) for k in range(n_labels)]
    groups = [(k, g) for k, g in enumerate(groups) if len(g)]
    net, rng = BiGRU(n_labels, seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    s = {k: np.zeros_like(v) for k, v in net.p.items()}
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(g, max(1, BATCH // len(groups))) for _, g in groups])
        _, grads = net.gradients(np.ascontiguousarray(x[pick].T), np.ascontiguousarray(mask[pick].T), of[pick])
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            g = np.clip(g, -1, 1)
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.99 * s[k] + 0.01 * g * g
            update = (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-8)
            net.p[k] = (net.p[k] - rate * update).astype(np.float32)
    return net


def pooled(net: BiGRU, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row: mean probability of each label over all bytes, and bytes labelled with each."""
    n, k = len(offsets) - 1, len(net.p["c"])
    total, labelled = np.zeros((n, k)), np.zeros((n, k), np.int64)
    x, mask, rows = windows(data, offsets)
    for i in range(0, len(rows), SIDE_BY_SIDE):
        part = slice(i, i + SIDE_BY_SIDE)
        own, of = np.ascontiguousarray(mask[part].T), rows[part]
        prob = net.probabilities(np.ascontiguousarray(x[part].T), own)
        best = prob.argmax(axis=2)
        prob *= own[:, :, None]
        np.add.at(total, of, prob.sum(axis=0))
        for j in range(k):
            np.add.at(labelled[:, j], of, ((best == j) & own).sum(axis=0))
    return total / np.maximum(np.diff(offsets), 1)[:, None], labelled


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[BiGRU | None, list[str]]:
    """The network and its labels from a bounded, hash-drawn sample of the labelled documents."""
    known = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & (F.octet_length("text") > 0) & ~held_out()
    )
    counts = small(known.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")))
    labels = sorted(r["lang"] for r in counts.select("lang").collect())
    if not labels:
        return None, labels
    most = max(1, min(per_language, SAMPLE // len(labels)))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    # Some more than are taken; the smallest draws of every language are among them.
    share = F.least(F.lit(2.0 * most + 20) / F.col("_n"), F.lit(1.0)) * (1 << 30)
    place = F.pmod(F.xxhash64("doc_id", "text"), F.greatest(F.char_length("text") - PIECE, F.lit(0)) + 1)
    piece = F.substr("text", (place + 1).cast("int"), F.lit(PIECE)).alias("text")
    drawn = lookup(known, counts, ["lang"]).filter(draw < share).select("lang", draw.alias("_d"), "doc_id", piece)
    order = Window.partitionBy("lang").orderBy("_d", "doc_id", "text")
    rows = drawn.withColumn("_i", F.row_number().over(order)).filter(F.col("_i") <= most).collect()
    of = {x: i for i, x in enumerate(labels)}
    rows.sort(key=lambda r: (of[r["lang"]], r["_i"]))
    texts, own = [r["text"] for r in rows], np.array([of[r["lang"]] for r in rows], np.int64)
    return (train(texts, own, len(labels)) if texts else None), labels


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score, and the share of bytes that are labelled lang_pred."""
    text_batches(docs.sparkSession)
    net, labels = fit(docs, per_language)
    own = docs.select(
        F.col("doc_id").cast("long"),
        held_out().alias("held_out"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
        "text",
    )

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = batch.column(2).to_numpy(zero_copy_only=False)
            names, scores, shares = [], [], []
            for first, last, data, offsets in text_slices(batch.column(3)):
                if net is None:
                    mean, labelled = np.zeros((last - first, 1)), np.zeros((last - first, 1))
                else:
                    mean, labelled = pooled(net, data, offsets)
                best = mean.argmax(axis=1)
                at = np.arange(len(best))
                sure = letters[first:last].astype(bool) & (net is not None)
                names += [labels[b] if s else UNKNOWN for b, s in zip(best, sure)]
                scores.append(np.where(sure, np.clip(mean[at, best], 0, 1), 0.0))
                shares.append(np.where(sure, labelled[at, best] / np.maximum(np.diff(offsets), 1), 0.0))
            if names:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(names, pa.string()),
                        pa.array(np.concatenate(scores)),
                        pa.array(np.concatenate(shares)),
                    ],
                    ["doc_id", "held_out", "lang_pred", "score", "byte_share"],
                )

    return own.mapInArrow(
        predict, "doc_id bigint, held_out boolean, lang_pred string, score double, byte_share double"
    )
