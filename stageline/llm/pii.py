"""Personal data: fixed patterns, and a character BiLSTM with CRF transitions on top.

The patterns give base spans. A bounded sample of windows with their labelled spans
trains the tagger in numpy on the driver. Each task cuts the places that hold a digit or
an @ (every span has one) into overlapping windows, scores them, joins the scores so that
each character takes those of the window it is most central in, and decodes each joined
stretch as a whole. Decoded spans that hold up to the kind's rule are added; base spans stay.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stageline.llm.common import slices, text_rows

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
TRIGGER = re.compile(r"[0-9@]")

#: window and step in code points, hidden units, windows that training may see
WINDOW, STRIDE, HIDDEN, TRAIN_WINDOWS = 64, 32, 12, 600
EPOCHS, BATCH, RATE, SEED = 18, 50, 0.02, 7
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
#: characters with a class of their own; then lower, upper, digit, space, other, padding
SINGLES = "@.-+()_%,:;/|\"'#"
PAD = len(SINGLES) + 5
CODES = np.full(0x110000, len(SINGLES) + 4, np.uint8)
CODES[ord("a") : ord("z") + 1] = len(SINGLES)
CODES[ord("A") : ord("Z") + 1] = len(SINGLES) + 1
CODES[ord("0") : ord("9") + 1] = len(SINGLES) + 2
CODES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = len(SINGLES) + 3
CODES[[ord(c) for c in SINGLES]] = np.arange(len(SINGLES))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:3] or 0) <= 255 for p in text.split("."))


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by start and kind; leftmost, not overlapping within a kind."""
    out = []
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((0, start, done := found.end()))
        at = text.find("@", at + 1)
    out += [(1, *m.span()) for m in IP.finditer(text) if _is_ip(m.group())]
    out += [(2, *m.span()) for m in CARD.finditer(text) if _is_card(m.group())]
    if "+" in text:
        out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], s[0]))


def codes(text: str) -> np.ndarray:
    return CODES[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def windows_of(text: str) -> np.ndarray:
    """Starts of the windows on the step grid that hold a digit or an @, neighbours included."""
    at = np.array([m.start() for m in TRIGGER.finditer(text)], np.int64)
    if not len(at):
        return at
    cell = np.unique(at // STRIDE)
    cell = np.unique(np.concatenate((cell - 1, cell, np.maximum(cell - 2, 0))))
    return np.maximum(cell, 0)[np.append(True, np.diff(np.maximum(cell, 0)) > 0)] * STRIDE


def cut(text_codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    padded = np.concatenate((text_codes, np.full(WINDOW, PAD, np.uint8)))
    return padded[np.minimum(starts[:, None] + np.arange(WINDOW), len(padded) - 1)]


def tags_of(spans: list[tuple[int, int, int]], n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    for kind, start, end in spans:
        if not out[start:end].any():
            out[start:end] = 2 + 2 * kind
            out[start] = 1 + 2 * kind
    return out


class Tagger:
    """The network: one LSTM per direction, a linear layer, transition scores."""

    def __init__(self, seed: int = SEED, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.p = {}
        for side in "fb":
            self.p["x" + side] = rng.normal(0, 0.3, (PAD + 1, 4 * hidden))
            self.p["h" + side] = rng.normal(0, 0.3 / hidden**0.5, (hidden, 4 * hidden))
            self.p["x" + side][:, hidden : 2 * hidden] += 1  # remember by default
        self.p["out"] = rng.normal(0, 0.3, (2 * hidden, TAGS))
        self.p["bias"] = np.zeros(TAGS)
        self.p["move"] = np.zeros((TAGS, TAGS))

    def _lstm(self, x: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        n, h, kept = self.hidden, np.zeros((len(x), self.hidden)), []
        c, out = h, np.zeros((*x.shape, self.hidden))
        for t in range(x.shape[1]):
            z = self.p["x" + side][x[:, t]] + h @ self.p["h" + side]
            gates = 1 / (1 + np.exp(-z[:, : 3 * n]))
            i, f, o, g = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :], np.tanh(z[:, 3 * n :])
            before, c = (h, c), f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            kept.append((i, f, o, g, *before, tc))
            out[:, t] = h
        return out, kept

    def _lstm_back(self, x: np.ndarray, side: str, kept: list, dout: np.ndarray, grads: dict) -> None:
        n = self.hidden
        dh = dc = np.zeros((len(x), n))
        gx, gh = grads["x" + side], grads["h" + side]
        for t in range(x.shape[1] - 1, -1, -1):
            i, f, o, g, h0, c0, tc = kept[t]
            dh = dh + dout[:, t]
            dc = dc + dh * o * (1 - tc**2)
            dz = np.hstack((dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g**2)))
            np.add.at(gx, x[:, t], dz)
            gh += h0.T @ dz
            dh, dc = dz @ self.p["h" + side].T, dc * f

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Scores of the tags at each place of each window."""
        forth, back = self._lstm(x, "f")[0], self._lstm(x[:, ::-1], "b")[0][:, ::-1]
        return np.concatenate((forth, back), 2) @ self.p["out"] + self.p["bias"]

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of the tags, and its gradients."""
        (forth, kf), (back, kb) = self._lstm(x, "f"), self._lstm(x[:, ::-1], "b")
        both = np.concatenate((forth, back[:, ::-1]), 2)
        e, move = both @ self.p["out"] + self.p["bias"], self.p["move"]
        b, t_all, _ = e.shape
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for t in range(1, t_all):
            alpha[:, t] = e[:, t] + _logsum(alpha[:, t - 1][:, :, None] + move, 1)
        for t in range(t_all - 2, -1, -1):
            beta[:, t] = _logsum(move + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        total = _logsum(alpha[:, -1], 1)
        rows = np.arange(b)[:, None]
        gold = e[rows, np.arange(t_all), y].sum(1) + move[y[:, :-1], y[:, 1:]].sum(1)
        de = np.exp(alpha + beta - total[:, None, None])
        de[rows, np.arange(t_all), y] -= 1
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        for t in range(1, t_all):
            joint = alpha[:, t - 1][:, :, None] + move + (e[:, t] + beta[:, t])[:, None, :] - total[:, None, None]
            grads["move"] += np.exp(joint).sum(0) / b
        np.add.at(grads["move"], (y[:, :-1], y[:, 1:]), -1 / b)
        de /= b
        grads["out"] += np.einsum("bth,btk->hk", both, de)
        grads["bias"] += de.sum((0, 1))
        dh, n = de @ self.p["out"].T, self.hidden
        self._lstm_back(x, "f", kf, dh[:, :, :n], grads)
        self._lstm_back(x[:, ::-1], "b", kb, dh[:, ::-1, n:], grads)
        return float((total - gold).mean()), grads

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS) -> Tagger:
        rng = np.random.default_rng(SEED)
        mean, square = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                own = order[at : at + BATCH]
                _, grads = self.loss(x[own], y[own])
                step += 1
                for k, g in grads.items():
                    g = np.clip(g, -5, 5)
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.99 * square[k] + 0.01 * g * g
                    self.p[k] -= RATE * mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def decode(self, e: np.ndarray) -> np.ndarray:
        """The best tag sequence of one stretch."""
        back, best = np.zeros(e.shape, np.int64), e[0]
        for t in range(1, len(e)):
            step = best[:, None] + self.p["move"]
            back[t] = step.argmax(0)
            best = step.max(0) + e[t]
        out = np.zeros(len(e), np.int64)
        out[-1] = best.argmax()
        for t in range(len(e) - 1, 0, -1):
            out[t - 1] = back[t, out[t]]
        return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)


def spans_of(tags: np.ndarray) -> list[tuple[int, int, int]]:
    out: list[list[int]] = []
    for i, tag in enumerate(tags.tolist()):
        if not tag:
            continue
        kind = (tag - 1) // 2
        if out and out[-1][2] == i and out[-1][0] == kind and tag % 2 == 0:
            out[-1][2] = i + 1
        else:
            out.append([kind, i, i + 1])
    return [tuple(s) for s in out]


def plausible(kind: int, text: str) -> bool:
    """What a decoded span must hold, so that noise in clean documents adds nothing."""
    digits = _digits(text)
    if kind == 0:
        local, _, domain = text.partition("@")
        return bool(local and re.fullmatch(r"[A-Za-z0-9-]+(?:\s?\.\s?[A-Za-z0-9-]+)+", domain.strip()))
    if kind == 1:
        parts = re.split(r"\s?[.,]\s?", text)
        return len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts) and _is_ip(".".join(parts))
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits) and bool(re.fullmatch(r"[0-9](?:[ .\-/]{0,2}[0-9])+", text))
    return 9 <= len(digits) <= 15 and bool(re.fullmatch(r"[+(0][0-9 ().\-/]*[0-9]", text)) and not text.isdigit()


def added_spans(texts: list[str], starts: list[np.ndarray], tagger: Tagger) -> list[list[tuple[int, int, int]]]:
    """Decoded spans of each text, from the joined scores of its windows."""
    coded = [codes(t) for t in texts]
    counts = [len(s) for s in starts]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not sum(counts):
        return out
    stack = np.concatenate([cut(c, s) for c, s in zip(coded, starts, strict=True) if len(s)])
    score = np.concatenate([tagger.scores(stack[i : i + 1024]) for i in range(0, len(stack), 1024)])
    at = 0
    edge = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])
    for k, own in enumerate(starts):
        part, at = score[at : at + len(own)], at + len(own)
        breaks = np.flatnonzero(np.diff(own) > WINDOW) + 1
        for group in np.split(np.arange(len(own)), breaks) if len(own) else []:
            low, high = int(own[group[0]]), min(int(own[group[-1]]) + WINDOW, len(coded[k]))
            joined, central = np.zeros((high - low, TAGS)), np.full(high - low, -1)
            for w in group:
                a = int(own[w]) - low
                n = min(WINDOW, high - low - a)
                better = edge[:n] > central[a : a + n]
                joined[a : a + n][better] = part[w][:n][better]
                central[a : a + n][better] = edge[:n][better]
            if high > low:
                out[k] += [(kind, s + low, e + low) for kind, s, e in spans_of(tagger.decode(joined))]
    return out


def merged(text: str, base: list[tuple[int, int, int]], decoded: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Base spans, and those decoded ones that touch none of them and are plausible."""
    out = list(base)
    for kind, start, end in decoded:
        while start < end and text[start].isspace():
            start += 1
        while end > start and text[end - 1].isspace():
            end -= 1
        if end > start and all(e <= start or s >= end for _, s, e in base) and plausible(kind, text[start:end]):
            out.append((kind, start, end))
    return sorted(set(out), key=lambda s: (s[1], s[0]))


def written_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def training_windows(docs: DataFrame, limit: int = TRAIN_WINDOWS) -> tuple[np.ndarray, np.ndarray]:
    """At most ``limit`` different labelled windows, chosen by hash among all: half with a span."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x, y = [], []
            for text in batch.column("text").to_pylist():
                starts = windows_of(text)
                if len(starts):
                    coded, tags = codes(text), tags_of(base_spans(text), len(text))
                    x += [bytes(w) for w in cut(coded, starts)]
                    tags = np.concatenate((tags, np.zeros(WINDOW, np.int64)))
                    y += [bytes(tags[s : s + WINDOW].astype(np.uint8)) for s in np.minimum(starts, len(text)).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), pa.array(y, pa.binary())], names=["x", "y"])

    found = docs.mapInArrow(emit, "x binary, y binary")
    nothing = F.lit(bytes(WINDOW))
    rows = []
    for some in (F.col("y") != nothing, F.col("y") == nothing):
        rows += found.where(some).distinct().orderBy(F.xxhash64("x"), "x", "y").limit(limit // 2).collect()
    x = np.array([list(r["x"]) for r in rows], np.int64).reshape(-1, WINDOW)
    return x, np.array([list(r["y"]) for r in rows], np.int64).reshape(-1, WINDOW)


OUT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, found array<struct<kind:string,start:long,end:long,base:boolean>>"


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of base spans, their digest, all spans as text and rows.

    Spans are in code points, the end exclusive. Null text is empty and holds none; rows
    that repeat a document are answered row by row; without any labelled window nothing
    is added. Other columns are not read; an empty table gives no rows.
    """
    rows = text_rows(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    x, y = training_windows(rows.select("text"))
    tagger = Tagger().train(x, y) if len(x) else None

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            base = [base_spans(t) if TRIGGER.search(t) else [] for t in texts]
            own = [k for k, t in enumerate(texts) if tagger and TRIGGER.search(t)]
            decoded = dict(zip(own, added_spans([texts[k] for k in own], [windows_of(texts[k]) for k in own], tagger), strict=True)) if own else {}
            out = []
            for k, text in enumerate(texts):
                spans = merged(text, base[k], decoded.get(k, []))
                counts = [sum(s[0] == kind for s in base[k]) for kind in range(len(KINDS))]
                digest = hashlib.sha256(written_spans(base[k]).encode()).hexdigest()
                found = [{"kind": KINDS[s[0]], "start": s[1], "end": s[2], "base": s in base[k]} for s in spans]
                out.append((*counts, digest, written_spans(spans), found))
            kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.list_(kind)]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            names = [c.split()[0] for c in OUT.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=names)

    return rows.mapInArrow(scan, OUT)
