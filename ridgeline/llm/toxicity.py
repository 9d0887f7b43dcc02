"""Toxicity by a bidirectional gated recurrent network over characters and words.

A word is its characters (UTF-8 bytes of the lower-cased word, read in both
directions by a small GRU) and a hashed word vector. A second GRU reads a window of words
in both directions, attention pools its states, and a linear unit scores the
window. All windows of a text are scored; they overlap by half, and the text has
the score of its worst window.

The network is fitted in numpy on a bounded sample of labelled rows
(``sample_rows`` of each class): first every window has its text's label, then, for
toxic texts, only windows that already score high. Scoring reads whole texts in
batches, without state between them, and works on each distinct word of a batch once.

Null texts are empty; a text without words scores 0. Labels other than 0 and 1 and
rows without a label are not used for fitting, and without rows of both classes
every score is 0. A null doc_id counts as held out. Repeated rows give repeated rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import CHUNK_BYTES, LOWER, Rolling, U64, arrow_map, documents, joined

WINDOW, STEP = 32, 16
#: Longer words are read in pieces of this many bytes.
LONGEST = 32
BUCKETS, WORD, CHAR, HIDDEN = 1 << 13, 8, 8, 8
_WORD_BYTES = np.zeros(256, bool)
_WORD_BYTES[0x30:0x3A] = _WORD_BYTES[0x61:0x7B] = _WORD_BYTES[0x80:] = True


class Text:
    """Words of some texts: distinct ones with their bytes, and the distinct word at each place."""

    def __init__(self, texts: list[str | None]):
        parts, k = [], 0
        while k < len(texts) or not parts:
            end, size = k + 1, len(texts[k] or "") if texts else 0
            while end < len(texts) and size + len(texts[end] or "") <= CHUNK_BYTES // 2:
                size += len(texts[end] or "")
                end += 1
            parts.append(self._part(texts[k:end]))
            k = end
        hashes, words, starts, sizes, letters = zip(*parts, strict=True)
        self.hashes, at, place = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        first = np.cumsum([0, *(len(h) for h in hashes)])
        self.word = place[np.concatenate([f + w for f, w in zip(first, words, strict=False)])]
        before = np.cumsum([0, *(len(w) for w in words)])
        self.starts = np.concatenate([[0], *(b + s[1:] for b, s in zip(before, starts, strict=False))])
        self.size, self.bytes = np.concatenate(sizes)[at], np.concatenate(letters)[at]

    @staticmethod
    def _part(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct words of a few texts, the word at each place, starts of texts, and size and bytes of each distinct word."""
        data, starts = joined(texts)
        data = LOWER[data]
        edge = np.diff(_WORD_BYTES[data].astype(np.int8), prepend=0)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        pieces = -(-(last - first) // LONGEST)
        step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first, end = np.repeat(first, pieces) + step * LONGEST, np.repeat(last, pieces)
        last = np.minimum(first + LONGEST, end)
        hashes = Rolling(data).of(first, last) if len(first) else np.zeros(0, U64)
        distinct, at, word = np.unique(hashes, return_index=True, return_inverse=True)
        size = (last - first)[at]
        letters = np.zeros((len(at), LONGEST), np.uint8)
        inside = np.arange(LONGEST) < size[:, None]
        letters[inside] = data[(first[at][:, None] + np.arange(LONGEST))[inside]]
        return distinct, word, np.searchsorted(first, starts), size, letters

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """First word of every window and the text it belongs to; a window ends with its text."""
        n = np.diff(self.starts)
        count = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STEP)), 0)
        text = np.repeat(np.arange(len(n)), count)
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return self.starts[text] + STEP * step, text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Gru:
    """One direction. Inputs are (time, batch, inputs) with a mask (time, batch); states after masked steps stay."""

    @staticmethod
    def make(rng: np.random.Generator, inputs: int, hidden: int) -> dict[str, np.ndarray]:
        return {
            "W": rng.normal(0, (1 / inputs) ** 0.5, (inputs, 3 * hidden)).astype(np.float32),
            "U": rng.normal(0, (1 / hidden) ** 0.5, (hidden, 3 * hidden)).astype(np.float32), "b": np.zeros(3 * hidden, np.float32),
        }

    @staticmethod
    def run(p: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray | None, keep: bool = False) -> tuple[np.ndarray, list]:
        """States after each step of projected inputs (time, batch, 3 * hidden), and what ``back`` needs."""
        hidden = len(p["U"])
        h, out, kept = np.zeros((x.shape[1], hidden), np.float32), np.empty((*x.shape[:2], hidden), np.float32), []
        for t in range(len(x)):
            u = h @ p["U"]
            gates = _sigmoid(x[t, :, : 2 * hidden] + u[:, : 2 * hidden])
            z, r = gates[:, :hidden], gates[:, hidden:]
            n = np.tanh(x[t, :, 2 * hidden :] + r * u[:, 2 * hidden :])
            new = n + z * (h - n)
            if mask is not None:
                new = np.where(mask[t][:, None], new, h)
            if keep:
                kept.append((h, z, r, n, u[:, 2 * hidden :]))
            h = out[t] = new
        return out, kept

    @staticmethod
    def back(p: dict[str, np.ndarray], kept: list, mask: np.ndarray, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the projected inputs and of U."""
        hidden = len(p["U"])
        dx, du, dh = np.zeros((*d_out.shape[:2], 3 * hidden), np.float32), np.zeros_like(p["U"]), np.zeros(d_out.shape[1:], np.float32)
        for t in range(len(kept) - 1, -1, -1):
            h, z, r, n, un = kept[t]
            m = mask[t][:, None]
            d = dh + d_out[t]
            dn = d * (1 - z) * (1 - n * n)
            dz, dr = d * (h - n) * z * (1 - z), dn * un * r * (1 - r)
            gate = np.concatenate([dz, dr, dn], axis=1) * m
            dx[t] = gate
            rec = np.concatenate([dz, dr, dn * r], axis=1) * m
            du += h.T @ rec
            dh = np.where(m, d * z + rec @ p["U"].T, d)
        return dx, du


class Network:
    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.p: dict[str, np.ndarray] = {
            "chars": rng.normal(0, 0.5, (256, CHAR)).astype(np.float32), "words": rng.normal(0, 0.1, (BUCKETS, WORD)).astype(np.float32),
            "pool": rng.normal(0, 0.3, 2 * HIDDEN).astype(np.float32), "out": rng.normal(0, 0.3, 2 * HIDDEN).astype(np.float32), "bias": np.zeros(1, np.float32),
        }
        for name, inputs in (("cf", CHAR), ("cb", CHAR), ("wf", 2 * HIDDEN + WORD), ("wb", 2 * HIDDEN + WORD)):
            self.p |= {f"{name}.{k}": v for k, v in Gru.make(rng, inputs, HIDDEN).items()}

    def gru(self, name: str) -> dict[str, np.ndarray]:
        return {k: self.p[f"{name}.{k}"] for k in "WUb"}

    # Words: the last states of both character directions, and the word's vector.
    def word_inputs(self, t: Text, pick: np.ndarray, keep: bool = False, strip: int = 512) -> tuple[np.ndarray, tuple]:
        out = np.empty((len(pick), 2 * HIDDEN + WORD), np.float32)
        bucket = (t.hashes[pick] % U64(BUCKETS)).astype(np.int64)
        out[:, 2 * HIDDEN :] = self.p["words"][bucket]
        kept, order = [], np.argsort(t.size[pick], kind="stable")
        strip = strip if keep else 4096  # words of about one length together
        for s in range(0, len(order), strip):
            own = order[s : s + strip]
            longest = int(t.size[pick[own]].max())
            letters, mask = t.bytes[pick[own], :longest].T, np.arange(longest)[:, None] < t.size[pick[own]]
            parts = []
            for k, name in enumerate(("cf", "cb")):
                g, turn = self.gru(name), slice(None, None, 1 - 2 * k)
                table = self.p["chars"] @ g["W"] + g["b"]
                states, memory = Gru.run(g, table[letters[turn]], mask[turn], keep)
                out[own, k * HIDDEN : (k + 1) * HIDDEN] = states[-1]
                parts.append(memory)
            kept.append((own, letters, mask, parts))
        return out, (bucket, kept)

    def window_logits(self, projected: list[np.ndarray], index: np.ndarray, mask: np.ndarray | None, keep: bool = False) -> tuple[np.ndarray, tuple]:
        """Logits of windows (time, batch) of words whose projections are given for both directions."""
        states, memories = [], []
        for k, name in enumerate(("wf", "wb")):
            turn = slice(None, None, 1 - 2 * k)
            out, memory = Gru.run(self.gru(name), projected[k][index[turn]], None if mask is None else mask[turn], keep)
            states.append(out[turn])
            memories.append(memory)
        h = np.concatenate(states, axis=2)
        e = h @ self.p["pool"]
        if mask is not None:
            e = np.where(mask, e, np.float32(-1e9))
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", a, h)
        return pooled @ self.p["out"] + self.p["bias"][0], (memories, h, a, pooled)

    def gradient(self, t: Text, index: np.ndarray, mask: np.ndarray, label: np.ndarray, rng: np.random.Generator, strip: int = 512) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy of windows (time, batch) and its gradient; half of the word vectors are left out at random."""
        used, place = np.unique(index, return_inverse=True)
        place = place.reshape(index.shape)
        x, (bucket, kept) = self.word_inputs(t, used, True, strip)
        drop = (rng.random((len(used), 1)) < 0.5).astype(np.float32)
        x[:, 2 * HIDDEN :] *= drop * 2
        projected = [x @ self.p[f"{n}.W"] + self.p[f"{n}.b"] for n in ("wf", "wb")]
        logit, (memories, h, a, pooled) = self.window_logits(projected, place, mask, True)
        p = _sigmoid(logit)
        loss = float(-np.mean(label * np.log(p + 1e-7) + (1 - label) * np.log(1 - p + 1e-7)))
        d = ((p - label) / len(label)).astype(np.float32)
        g: dict[str, np.ndarray] = {"bias": np.array([d.sum()], np.float32), "out": pooled.T @ d}
        d_pooled = d[:, None] * self.p["out"]
        d_a = np.einsum("tbh,bh->tb", h, d_pooled)
        d_e = a * (d_a - (a * d_a).sum(axis=0))
        g["pool"] = np.einsum("tb,tbh->h", d_e, h)
        d_h = a[:, :, None] * d_pooled + d_e[:, :, None] * self.p["pool"]
        d_x = np.zeros_like(x)
        for k, name in enumerate(("wf", "wb")):
            turn = slice(None, None, 1 - 2 * k)
            dp, g[f"{name}.U"] = Gru.back(self.gru(name), memories[k], mask[turn], d_h[turn][:, :, k * HIDDEN : (k + 1) * HIDDEN])
            flat = np.zeros_like(projected[k])
            np.add.at(flat, place[turn].ravel(), dp.reshape(-1, dp.shape[2]))
            g[f"{name}.W"], g[f"{name}.b"] = x.T @ flat, flat.sum(axis=0)
            d_x += flat @ self.p[f"{name}.W"].T
        g["words"] = np.zeros_like(self.p["words"])
        np.add.at(g["words"], bucket, d_x[:, 2 * HIDDEN :] * drop * 2)
        g |= {k: np.zeros_like(v) for k, v in self.p.items() if k[:2] in ("ch", "cf", "cb")}
        for own, letters, seen, parts in kept:
            for k, name in enumerate(("cf", "cb")):
                turn, gru = slice(None, None, 1 - 2 * k), self.gru(name)
                d_out = np.zeros((len(letters), len(own), HIDDEN), np.float32)
                d_out[-1] = d_x[own, k * HIDDEN : (k + 1) * HIDDEN]
                dp, du = Gru.back(gru, parts[k], seen[turn], d_out)
                flat = np.zeros((256, 3 * HIDDEN), np.float32)
                np.add.at(flat, letters[turn].ravel(), dp.reshape(-1, 3 * HIDDEN))
                g[f"{name}.U"] += du
                g[f"{name}.W"] += self.p["chars"].T @ flat
                g[f"{name}.b"] += flat.sum(axis=0)
                g["chars"] += flat @ gru["W"].T
        return loss, g

    def logits(self, t: Text, first: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Logits of the windows that begin at ``first`` and end with their text at the latest."""
        x, _ = self.word_inputs(t, np.arange(len(t.hashes)))
        projected = [x @ self.p[f"{n}.W"] + self.p[f"{n}.b"] for n in ("wf", "wb")]
        out = np.zeros(len(first), np.float32)
        full = first + WINDOW <= ends
        for some, masked in ((np.flatnonzero(full), False), (np.flatnonzero(~full), True)):
            for s in range(0, len(some), 2048):
                own = some[s : s + 2048]
                index, mask = window_index(t, first[own], ends[own])
                out[own] = self.window_logits(projected, index, mask if masked else None)[0]
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """0 to 1 for each text: its worst window; 0 without words."""
        t = Text(texts)
        first, text = t.windows()
        worst = np.full(len(texts), -np.inf)
        if len(first):
            np.maximum.at(worst, text, self.logits(t, first, t.starts[text + 1]).astype(float))
        return np.where(np.isfinite(worst), _sigmoid(np.clip(worst, -30, 30)), 0.0)


def window_index(t: Text, first: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words (time, batch) of windows and which are inside; those outside repeat the last one."""
    place = first + np.arange(WINDOW)[:, None]
    return t.word[np.minimum(place, ends - 1)], place < ends


def stand_out(net: Network, t: Text, first: np.ndarray, ends: np.ndarray, text: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Those of the windows ``bad`` that score above one half, and the worst of each text."""
    logit = net.logits(t, first[bad], ends[bad])
    top = np.full(len(t.starts) - 1, -np.inf)
    np.maximum.at(top, text[bad], logit)
    return bad[(logit > 0) | (logit >= top[text[bad]])]


def fit(texts: list[str], labels: list[int], steps: int = 260, batch: int = 192, seed: int = 11) -> Network | None:
    """A network for the given texts, None without both classes.

    At least ``steps`` steps, and as many as it takes to draw as many windows of each class as there are.
    """
    y = np.array(labels)
    if not (y == 1).any() or not (y == 0).any():
        return None
    net, rng, t = Network(seed), np.random.default_rng(seed), Text(texts)
    first, text = t.windows()
    ends, known = t.starts[text + 1], y[text]
    # A quarter of the texts of each class is kept for the cut.
    kept = np.zeros(len(y), bool)
    for c in (0, 1):
        kept[np.flatnonzero(y == c)[3::4]] = True
    bad, good = (np.flatnonzero((known == c) & ~kept[text]) for c in (1, 0))
    if not len(bad) or not len(good):
        return None
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(w) for k, w in net.p.items()}
    steps = max(steps, -(-len(bad) // (batch // 3)), -(-len(good) // (batch - batch // 3)))
    half = steps // 2
    for step in range(1, steps + 1):
        if step in (half, half + steps // 4):
            # From here on only windows of toxic texts that stand out, at least the worst of each text.
            bad_now = stand_out(net, t, first, ends, text, bad)
        pick_bad = bad if step < half else bad_now
        pick = np.concatenate([rng.choice(pick_bad, batch // 3), rng.choice(good, batch - batch // 3)])
        index, mask = window_index(t, first[pick], ends[pick])
        _, g = net.gradient(t, index, mask, known[pick].astype(np.float32), rng)
        rate = 0.02 * min(1.0, step / 20) * (0.1 if step > 0.85 * steps else 1.0)
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        for k, x in g.items():
            x = x * min(1.0, 1.0 / (norm + 1e-9))
            m[k] += 0.1 * (x - m[k])
            v[k] += 0.01 * (x * x - v[k])
            net.p[k] *= 1 - 0.05 * rate
            net.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    # The bias moves to the best cut between the texts kept for it.
    logit = net.logits(t, first, ends).astype(float)
    worst = np.full(len(y), -np.inf)
    np.maximum.at(worst, text, logit)
    seen = np.isfinite(worst)
    if len({*y[seen & kept].tolist()}) == 2:
        seen &= kept
    order = np.argsort(worst[seen])
    value, label = worst[seen][order], y[seen][order]
    wrong = np.concatenate([[0], np.cumsum(label == 1)]) / max(1, (label == 1).sum()) + np.concatenate([[(label == 0).sum()], (label == 0).sum() - np.cumsum(label == 0)]) / max(1, (label == 0).sum())
    cut = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    edges = np.concatenate([[value[0] - 1], (value[1:] + value[:-1]) / 2, [value[-1] + 1]])
    net.p["bias"] = net.p["bias"] - np.float32(edges[cut[len(cut) // 2]])
    return net


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 1500) -> Network | None:
    """A network fitted on at most ``sample_rows`` labelled rows of each class that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    known = known.filter(~held_out())
    # Bounded by the parameter, whatever the size of the tables.
    some = [known.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows * (2 - c)) for c in (0, 1)]
    picked = some[0].union(some[1]).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = documents(docs).join(F.broadcast(picked), "doc_id").collect()
    rows = sorted((r["doc_id"], r["text"], r["toxic"]) for r in rows)
    return fit([r[1] for r in rows], [r[2] for r in rows])


def score(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text."""

    def each(batch: pa.RecordBatch) -> dict[str, object]:
        texts = batch.column(1).to_pylist()
        scores = np.zeros(len(texts)) if net is None else net.scores(texts)
        return {"doc_id": batch.column(0), "held_out": batch.column(2), "score": scores, "predicted": (scores >= 0.5).astype(np.int32)}

    return arrow_map(documents(docs, held_out().alias("held_out")), each, "doc_id long, held_out boolean, score double, predicted int", most=CHUNK_BYTES)


def keep_clean(docs: DataFrame, net: Network | None) -> DataFrame:
    """The rows that score below one half, with all their columns."""
    if net is None:
        return docs

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        # About a chunk of text at a time, so that arrays stay small next to the batch.
        part = np.cumsum([len(t) for t in texts]) // CHUNK_BYTES
        return pd.Series(np.concatenate([np.zeros(0), *(net.scores(x.tolist()) for _, x in texts.groupby(part))]))

    return docs.filter(scored(F.coalesce("text", F.lit(""))) < 0.5)
