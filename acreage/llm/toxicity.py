"""Toxicity by a recurrent network (operator 8).

A bidirectional gated recurrent network reads overlapping windows of words. A word's input is the sum of a hashed word
embedding and the mean of its hashed character 4-grams; attention pools the states of a window into one logit, and a
document's score comes from its highest window. The network is trained with numpy on a bounded sample of labelled rows,
each round on the window of each document that scores highest so far; embeddings start from smoothed log odds.
Scoring is one pass over the whole texts where they are read; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.llm.shared import cut_lineage, small_batches
from acreage.llm.words import ALPHANUMERIC, Texts, find_words, gathered, mix, range_hashes, slices, texts_of

#: Most labelled rows of each class that train the network by all windows of their whole texts, chosen by a hash.
ROWS_BY_CLASS = 2_000
WINDOW, STRIDE = 32, 24
WORD_BUCKETS = CHAR_BUCKETS = 1 << 17
SIZE, HIDDEN = 16, 8
ROUNDS, STEPS, BATCH = 5, 30, 256
#: Embeddings move slowly, lest they learn single documents by their rare words.
RATE, EMBEDDING_RATE = 0.01, 0.0002
#: Added to the rates of a bucket before their log odds are taken.
RARE = 0.003
#: One training row in so many sets the threshold instead.
CHECKED = 5
#: Lengths in bytes of the beginnings of a word that are character inputs; a shorter word has the first one whole.
BEGINNINGS = (3, 5, 6, 7, 8)
#: Windows that are scored at once, and bytes of text whose windows are made at once.
CHUNK, TEXT_BYTES = 2_048, 1 << 18
SEED = 8


@dataclass
class Inputs:
    """Windows of some texts: word numbers (window by place), lengths, owner; and the features of each distinct word."""

    places: np.ndarray
    lengths: np.ndarray
    owner: np.ndarray
    words: np.ndarray
    chars: np.ndarray
    char_bounds: np.ndarray

    def of(self, windows: np.ndarray | slice) -> Inputs:
        """Some windows, with only their words."""
        places = self.places[windows]
        used, local = np.unique(places, return_inverse=True)
        sizes = np.diff(self.char_bounds)[used]
        chars = self.chars[gathered(self.char_bounds[used], sizes)]
        return Inputs(
            local.reshape(places.shape).astype(np.int32), self.lengths[windows], self.owner[windows], self.words[used], chars,
            np.concatenate([[0], np.cumsum(sizes)]),
        )


def inputs_of(column: pa.Array) -> Inputs:
    """All windows of an Arrow column's texts, worked on in slices so that memory follows what is kept."""
    parts, rows, words = [], 0, 0
    for _, high, texts in slices(column, TEXT_BYTES):
        x = _inputs(texts)
        x.places += words
        x.owner += rows
        parts.append(x)
        rows, words = high, words + len(x.words)
    if not parts:
        return _inputs(texts_of(column))
    chars = np.cumsum([0, *(len(x.chars) for x in parts)])
    bounds = [x.char_bounds[1:] + n for x, n in zip(parts, chars[:-1].tolist(), strict=True)]
    return Inputs(
        *(np.concatenate([getattr(x, name) for x in parts]) for name in ("places", "lengths", "owner", "words", "chars")),
        np.concatenate([[0], *bounds]),
    )


def _inputs(texts: Texts) -> Inputs:
    """All windows of the texts; every word is in some window, and a text without words has none."""
    words = find_words(texts, ALPHANUMERIC)
    hashes, where, number = np.unique(words.hash, return_index=True, return_inverse=True)
    windows = np.where(words.count > 0, 1 + np.maximum(0, -(-(words.count - WINDOW) // STRIDE)), 0)
    owner = np.repeat(np.arange(len(texts)), windows)
    step = gathered(np.zeros(len(windows), dtype=np.int64), windows) * STRIDE
    starts = words.first[owner] + step
    lengths = np.minimum(words.count[owner] - step, WINDOW)
    places = np.minimum(starts[:, None] + np.arange(WINDOW), max(len(words.start) - 1, 0))
    places = (number[places] if len(number) else places).astype(np.int32)
    start, end = words.start[where], words.end[where]
    # Character 4-grams anywhere in a word, and its beginnings and end, which are told apart from them.
    inner = np.maximum(end - start - 3, 0)
    number_of = np.arange(len(start))
    first = gathered(start, inner)
    low, high, of, side = [first], [first + 4], [np.repeat(number_of, inner)], [np.zeros(len(first), dtype=np.uint64)]
    for size in BEGINNINGS:
        long = number_of if size == BEGINNINGS[0] else np.flatnonzero(end - start >= size)
        low.append(start[long])
        high.append(np.minimum(start[long] + size, end[long]))
        of.append(long)
        side.append(np.full(len(long), size, dtype=np.uint64))
    low.append(np.maximum(end - 3, start))
    high.append(end)
    of.append(number_of)
    side.append(np.ones(len(start), dtype=np.uint64))
    low, high, of, side = (np.concatenate(x) for x in (low, high, of, side))
    order = np.argsort(of, kind="stable")
    chars = (mix(range_hashes(texts, low, high) + side) % np.uint64(CHAR_BUCKETS)).astype(np.int32)[order]
    return Inputs(
        places, lengths, owner, (hashes % np.uint64(WORD_BUCKETS)).astype(np.int32), chars,
        np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(start)))]),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters: word and char embeddings, input weights of both directions, recurrent weights, attention, output."""

    def __init__(self, seed: int = SEED):
        draw = np.random.default_rng(seed)
        h = HIDDEN
        self.p = {
            "word": 0.05 * draw.standard_normal((WORD_BUCKETS, SIZE)), "char": 0.05 * draw.standard_normal((CHAR_BUCKETS, SIZE)),
            "w": draw.standard_normal((SIZE, 6 * h)) / np.sqrt(SIZE), "b": np.zeros(6 * h),
            "u": draw.standard_normal((2, h, 3 * h)) / np.sqrt(h), "v": 0.1 * draw.standard_normal(2 * h),
            "o": draw.standard_normal(2 * h) / np.sqrt(2 * h), "c": np.zeros(1),
        }
        self.p = {k: x.astype(np.float32) for k, x in self.p.items()}

    def word_inputs(self, x: Inputs) -> np.ndarray:
        """Word embedding plus mean character embedding of each distinct word."""
        if not len(x.words):
            return np.zeros((0, SIZE), dtype=np.float32)
        out = self.p["word"][x.words]
        for low in range(0, len(out), CHUNK):
            bounds = x.char_bounds[low : low + CHUNK + 1]
            chars = x.chars[bounds[0] : bounds[-1]]
            out[low : low + CHUNK] += np.add.reduceat(self.p["char"][chars], bounds[:-1] - bounds[0], axis=0) / np.diff(bounds)[:, None].astype(np.float32)
        return out

    def forward(self, gates: np.ndarray, places: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """Logits of windows; ``gates`` holds the input part of the gates of each distinct word."""
        n, h = len(places), HIDDEN
        mask = np.arange(WINDOW) < lengths[:, None]
        states = np.zeros((2, WINDOW, n, h), dtype=np.float32)
        held: list = [[None] * WINDOW, [None] * WINDOW]
        for side in (0, 1):
            state = np.zeros((n, h), dtype=np.float32)
            part = gates[:, 3 * h * side : 3 * h * (side + 1)]
            for t in range(WINDOW) if side == 0 else range(WINDOW - 1, -1, -1):
                here, back = part[places[:, t]], state @ self.p["u"][side]
                zr = _sigmoid(here[:, : 2 * h] + back[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                new = np.tanh(here[:, 2 * h :] + r * back[:, 2 * h :])
                if keep:
                    held[side][t] = (state, z, r, new, back[:, 2 * h :])
                state = np.where(mask[:, t, None], new + z * (state - new), state)
                states[side, t] = state
        both = np.concatenate([states[0], states[1]], axis=2)
        scores = np.where(mask.T, both @ self.p["v"], np.float32(-1e9))
        weights = np.exp(scores - scores.max(axis=0))
        weights /= weights.sum(axis=0)
        pooled = np.einsum("tn,tnk->nk", weights, both)
        logits = pooled @ self.p["o"] + self.p["c"][0]
        return (logits, (mask, held, both, weights, pooled)) if keep else logits

    def scores(self, x: Inputs) -> np.ndarray:
        """Logits of all windows, of some windows and their words at a time."""
        out = [np.zeros(0, dtype=np.float32)]
        for low in range(0, len(x.places), CHUNK):
            part = x.of(slice(low, low + CHUNK))
            out.append(self.forward(self.word_inputs(part) @ self.p["w"] + self.p["b"], part.places, part.lengths))
        return np.concatenate(out)

    def gradients(self, x: Inputs, chosen: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy of the chosen windows, and its gradient by parameter."""
        h = HIDDEN
        part = x.of(chosen)
        local, lengths, sizes = part.places, part.lengths, np.diff(part.char_bounds)
        embedded = self.word_inputs(part)
        logits, (mask, held, both, weights, pooled) = self.forward(embedded @ self.p["w"] + self.p["b"], local, lengths, True)
        loss = float(np.mean(np.maximum(logits, 0) - logits * target + np.log1p(np.exp(-np.abs(logits)))))
        d_logit = ((_sigmoid(logits) - target) / len(target)).astype(np.float32)
        g = {"o": d_logit @ pooled, "c": d_logit.sum(keepdims=True)}
        d_pool = d_logit[:, None] * self.p["o"]
        d_weight = np.einsum("nk,tnk->tn", d_pool, both)
        d_score = weights * (d_weight - (weights * d_weight).sum(axis=0))
        g["v"] = np.einsum("tn,tnk->k", d_score, both)
        d_both = weights[:, :, None] * d_pool + d_score[:, :, None] * self.p["v"]
        d_gates = np.zeros((len(part.words), 6 * h), dtype=np.float32)
        g["u"] = np.zeros_like(self.p["u"])
        for side in (0, 1):
            d_state = np.zeros((len(target), h), dtype=np.float32)
            for t in range(WINDOW - 1, -1, -1) if side == 0 else range(WINDOW):
                d_state = d_state + d_both[t, :, side * h : (side + 1) * h]
                state, z, r, new, back = held[side][t]
                on = mask[:, t, None]
                d_out = np.where(on, d_state, 0)
                d_new = d_out * (1 - z) * (1 - new * new)
                d_z = d_out * (state - new) * z * (1 - z)
                d_r = d_new * back * r * (1 - r)
                d_here = np.concatenate([d_z, d_r, d_new], axis=1)
                d_back = np.concatenate([d_z, d_r, d_new * r], axis=1)
                g["u"][side] += state.T @ d_back
                np.add.at(d_gates[:, 3 * h * side : 3 * h * (side + 1)], local[:, t], d_here)
                d_state = np.where(on, d_out * z + d_back @ self.p["u"][side].T, d_state)
        g["b"] = d_gates.sum(axis=0)
        g["w"] = embedded.T @ d_gates
        d_embedded = d_gates @ self.p["w"].T
        g["word"] = _by_row(part.words, d_embedded)
        g["char"] = _by_row(part.chars, np.repeat(d_embedded / sizes[:, None].astype(np.float32), sizes, axis=0))
        return loss, g


def _by_row(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the values of each row of a table, for the rows that have any."""
    order = np.argsort(rows, kind="stable")
    first = np.flatnonzero(np.diff(rows[order], prepend=-1))
    return rows[order][first], np.add.reduceat(values[order], first, axis=0)


def _log_odds(x: Inputs, toxic: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed log odds of each word and char bucket's presence in toxic and other texts; some windows at a time."""
    found = [np.zeros((2, size)) for size in (WORD_BUCKETS, CHAR_BUCKETS)]
    edges = np.flatnonzero(np.diff(x.owner, prepend=-1, append=-1))  # where a text's windows begin
    sizes = np.diff(x.char_bounds)
    step = 64
    for k in range(0, len(edges) - 1, step):
        rows = slice(edges[k], edges[min(k + step, len(edges) - 1)])
        valid = np.arange(WINDOW) < x.lengths[rows, None]
        owner = np.broadcast_to(x.owner[rows, None], valid.shape)[valid].astype(np.int64)
        pairs = np.unique(owner * len(x.words) + x.places[rows][valid])
        owner, number = pairs // len(x.words), pairs % len(x.words)
        chars = x.chars[gathered(x.char_bounds[number], sizes[number])]
        for counts, buckets, of in ((found[0], x.words[number], owner), (found[1], chars, np.repeat(owner, sizes[number]))):
            size = counts.shape[1]
            seen = np.unique(of * size + buckets)
            for row, flags in enumerate((toxic, others)):
                counts[row] += np.bincount(seen % size, weights=flags[seen // size], minlength=size)
    a, b = max(toxic.sum(), 1), max(others.sum(), 1)
    return tuple(np.log((bad / a + RARE) / (good / b + RARE)) for bad, good in found)


def best_edge(values: np.ndarray, toxic: np.ndarray, share: float) -> float:
    """The edge from which values count as toxic with the least expected error, if ``share`` of all rows is toxic."""
    order = np.argsort(values, kind="stable")
    values, toxic = values[order], toxic[order]
    missed = np.concatenate([[0.0], np.cumsum(toxic / max(toxic.sum(), 1))])
    alarms = np.concatenate([np.cumsum((~toxic / max((~toxic).sum(), 1))[::-1])[::-1], [0.0]])
    wrong = share * missed + (1 - share) * alarms
    lowest = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    ends = np.concatenate([[values[0] - 2], values, [values[-1] + 2]])
    return float((ends[lowest[0]] + ends[lowest[-1] + 1]) / 2)


def train(texts: list[str], toxic: np.ndarray, share: float = 0.1, seed: int = SEED, rounds: int = ROUNDS, steps: int = STEPS) -> Network:
    """A network fitted to whole labelled texts; without both classes it answers with the one there is, or 0."""
    network = Network(seed)
    toxic = np.asarray(toxic, dtype=bool)
    x = inputs_of(pa.array(texts, pa.large_string()))
    known = np.unique(x.owner)
    learning = np.arange(len(texts)) % CHECKED != 0
    fitted = known[learning[known]]
    if not len(fitted) or toxic[fitted].all() or not toxic[fitted].any():
        network.p["o"][:] = 0
        network.p["c"][:] = 20.0 if len(fitted) and toxic[fitted].all() else -20.0
        return network
    others = ~toxic & learning
    by_word, by_char = _log_odds(x, toxic & learning, others)
    network.p["word"][:, 0] += 0.5 * by_word
    network.p["char"][:, 1] += by_char
    # At first a window is told by its most conspicuous word.
    start = network.word_inputs(x)[:, :2].sum(axis=1)
    first = np.where(np.arange(WINDOW) < x.lengths[:, None], start[x.places], -np.inf).max(axis=1)
    draw = np.random.default_rng(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}
    bounds = np.searchsorted(x.owner, np.arange(len(texts) + 1))
    any_clean = np.flatnonzero(others[x.owner])
    done = 0
    for number in range(rounds):
        logits = first if number == 0 else network.scores(x)
        best = np.array([bounds[i] + np.argmax(logits[bounds[i] : bounds[i + 1]]) for i in fitted.tolist()])
        bad, good = best[toxic[fitted]], best[~toxic[fitted]]
        for _ in range(steps):
            half, quarter = BATCH // 2, BATCH // 4
            chosen = np.concatenate([draw.choice(bad, half), draw.choice(good, quarter), draw.choice(any_clean, quarter)])
            _, g = network.gradients(x, chosen, toxic[x.owner[chosen]].astype(np.float32))
            done += 1
            for k, value in network.p.items():
                rows, change = g[k] if k in ("word", "char") else (slice(None), g[k])
                rate = EMBEDDING_RATE if k in ("word", "char") else RATE
                m, v = moments[k]
                m[rows] += 0.1 * (change - m[rows])
                v[rows] += 0.01 * (change * change - v[rows])
                value[rows] -= rate * (m[rows] / (1 - 0.9**done)) / (np.sqrt(v[rows] / (1 - 0.99**done)) + 1e-7)
    # The output is shifted so that rows it has not learned from are told best by their highest window.
    highest = np.maximum.reduceat(network.scores(x), bounds[known])
    checked = known[~learning[known]]
    told = checked if toxic[checked].any() and not toxic[checked].all() else known
    network.p["c"] -= np.float32(best_edge(highest[np.isin(known, told)], toxic[told], share))
    return network


def _trained(sample: DataFrame, share: float, seed: int) -> Network:
    """The network of a bounded sample (doc_id, text, toxic), trained in one task that is run again if it is lost."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        found = train([text for _, text, _ in rows], np.array([toxic == 1 for _, _, toxic in rows], dtype=bool), share, seed)
        names = sorted(found.p)
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([found.p[k].astype("<f4").tobytes() for k in names], pa.binary())], names=["name", "value"])

    network = Network(seed)
    got = sample.repartition(1).mapInArrow(fit, "name string, value binary").collect()
    if not got:
        return train([], np.zeros(0, dtype=bool), share, seed)
    for name, value in got:
        network.p[name] = np.frombuffer(value, dtype="<f4").reshape(network.p[name].shape)
    return network


def toxicity(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_id: str = "doc_id", label_column: str = "toxic", rows_by_class: int = ROWS_BY_CLASS, seed: int = SEED) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_words, n_windows) of every row.

    Learns from labelled rows whose crc32(id) mod 5 is not 0, at most ``rows_by_class`` of each class. Null and empty
    texts score 0. A null id is not held out and has no label; a null label is left out, and of several labels of one id
    the largest counts. Repeated rows get equal scores. Without labels of both classes, all documents get the class there
    is, or 0. Very long texts are scored whole. Only the named columns are read. No rows give no rows. Training runs in
    one task while the result is built, on a sample whose size does not grow with the table.
    """
    fold = F.crc32(F.col(id_column).cast("bigint").cast("string")) % 5
    rows = small_batches(docs).select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"), F.coalesce(fold == 0, F.lit(False)).alias("held_out"))
    known = labels.where(F.col(label_id).isNotNull() & F.col(label_column).isNotNull()).groupBy(F.col(label_id).cast("bigint").alias("label_of")).agg(
        F.max(F.col(label_column).cast("int")).alias("toxic")
    ).where(F.crc32(F.col("label_of").cast("string")) % 5 != 0)
    order = F.xxhash64("label_of", F.lit(seed))
    classes = [known.where(F.col("toxic") == k if k else F.col("toxic") != 1).orderBy(order, "label_of").limit(rows_by_class) for k in (0, 1)]
    chosen = cut_lineage(classes[0].union(classes[1]))
    counts = dict(known.groupBy((F.col("toxic") == 1).cast("int").alias("toxic")).count().collect())
    share = counts.get(1, 0) / max(1, counts.get(0, 0) + counts.get(1, 0))
    sample = rows.where("text is not null").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_of"))
    # Rows that repeat a chosen id do not enlarge the sample.
    sample = sample.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"))
    network = _trained(sample, share, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in slices(batch.column(1), 2 * TEXT_BYTES):
                x = _inputs(texts)
                highest = np.full(high - low, -np.inf)
                np.maximum.at(highest, x.owner, network.scores(x))
                score = np.where(np.isfinite(highest), 0.5 * np.tanh(0.5 * highest) + 0.5, 0.0)
                n_words = np.bincount(x.owner, weights=np.minimum(x.lengths, STRIDE), minlength=high - low)
                last = np.flatnonzero(np.append(x.owner[1:] != x.owner[:-1], True)) if len(x.owner) else x.owner
                n_words[x.owner[last]] += np.maximum(x.lengths[last] - STRIDE, 0)
                columns = [
                    batch.column(0)[low:high], batch.column(2)[low:high], pa.array(score), pa.array((score >= 0.5).astype(np.int32)),
                    pa.array(n_words.astype(np.int64)), pa.array(np.bincount(x.owner, minlength=high - low).astype(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted", "n_words", "n_windows"])

    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int, n_words bigint, n_windows bigint")
