"""Personal data in texts: fixed patterns, and a character-level bidirectional LSTM with CRF transitions for forms that the patterns miss.

The patterns give the base spans. They also label the training rows: a bounded sample of windows around base spans (``WINDOWS`` a kind, those with the least hash) and of windows
around digits that belong to none. Labelled spans are also written in other ways (``rewrite``: spelled-out at signs and dots, phone numbers without a plus, spaced or bracketed
addresses, other separators in card numbers), so that the model learns forms beyond the patterns. Network and training are plain numpy, with a fixed seed.

Every text is searched as a whole. A span holds a digit, an at sign or the word "at" or "dot", so stretches further than ``REACH`` characters from all of these have nothing to decode; all
others are cut into windows of ``WIDTH`` characters that overlap by half. Each window is decoded by Viterbi; a span's weight is the least posterior of its characters, less what a nearby window edge takes.
The spans of all windows of a document are reconciled together: equal ones count once with their best weight, and of overlapping ones the set of most weight stays
(weighted interval scheduling over the whole document). A span is added if its posterior is at least ``SURE``, it overlaps no base span, and its digits or parts satisfy the numeric rule of its kind.

Defined results: a null or empty text has no spans. Repeated rows are judged alike. Text lengths are unbounded; each step is linear in the text. Without any base
span in the input no model is trained and the base spans are all. Columns of the input other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.shared import load, session

KINDS = ("email", "ip", "card", "phone")
WIDTH, REACH = 64, 24
WINDOWS = 600  # labelled windows of each kind, and of none
SURE = 0.7
HIDDEN, EMBED, STEPS, BATCH, RATE = 16, 12, 350, 48, 0.01
SEED = 11
NONE, LABELS = 0, 1 + 2 * len(KINDS)  # label 0 outside, 1 + 2k begins kind k, 2 + 2k goes on

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")  # matches wherever a digit stands, so no start is tried twice
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
GATE = re.compile(r"[0-9@]+|\b(?:at|dot)\b", re.I)


def luhn(digits: str) -> bool:
    """Whether 13 to 19 digits pass the check sum."""
    if not 13 <= len(digits) <= 19:
        return False
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the address pattern from left to right, found at their at signs so that long runs cost once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four dotted numbers; of a longer chain each next four."""
    for chain in CHAIN.finditer(text):
        parts = list(re.finditer("[0-9]+", chain.group()))
        for k in range(0, len(parts) - 3, 4):
            if all(len(x := p.group().lstrip("0")) <= 3 and int(x or "0") <= 255 for p in parts[k : k + 4]):
                yield chain.start() + parts[k].start(), chain.start() + parts[k + 3].end()


def digits_of(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind and start."""
    out = [(0, *m) for m in emails(text)] if "@" in text else []
    if any(c in text for c in "0123456789"):
        out += [(1, *m) for m in addresses(text)]
        out += [(2, *m.span()) for m in CARD.finditer(text) if luhn(digits_of(m.group()))]
        if "+" in text:
            out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return out


def plausible(kind: int, span: str) -> bool:
    """The numeric rule of a kind, whatever its separators."""
    digits = digits_of(span)
    if kind == 0:
        at = re.search(r"@|\bat\b", span, re.I)
        return bool(at and at.start() > 0 and re.search(r"\w.*(\.|\bdot\b).*\w", span[at.end() :], re.I | re.S))
    if kind == 1:
        parts = re.findall("[0-9]+", span)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts) and not re.search("[A-Za-z]", re.sub(r"(?i)\bdot\b", "", span))
    if re.search(r"[^\W\d_]", span):
        return False
    return luhn(digits) if kind == 2 else 9 <= len(digits) <= 15


# ---- characters and labels


def codes(text: str) -> np.ndarray:
    """A class for each character: ASCII as it is, other letters, other digits, other marks; 0 is padding."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = points.astype(np.int64)
    wide = np.nonzero(points >= 127)[0]
    for i in wide:
        c = text[i]
        out[i] = 127 if c.isalpha() else 128 if c.isdigit() else 129
    return np.where(out < 1, 129, out)


CLASSES = 130


def labelled(length: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    out = np.zeros(length, dtype=np.int64)
    for kind, lo, hi in spans:
        out[max(lo, 0) : hi] = 2 + 2 * kind
        if lo >= 0:
            out[lo] = 1 + 2 * kind
    return out


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of the text within reach of a digit, an at sign, or an at or a dot that is spelled out: whatever is ``plausible`` has one."""
    out: list[list[int]] = []
    for m in GATE.finditer(text):
        lo, hi = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and lo <= out[-1][1]:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def windows(text: str) -> list[tuple[int, int]]:
    """Overlapping windows over the stretches."""
    out = []
    for lo, hi in stretches(text):
        start = lo
        while True:
            out.append((start, min(start + WIDTH, hi)))
            if start + WIDTH >= hi:
                break
            start += WIDTH // 2
    return out


# ---- labelled windows, written in other ways too


def rewrite(rng: random.Random, kind: int, span: str) -> str:
    """A span in another form, mostly one that the patterns miss."""
    if kind == 0:
        at = rng.choice([" at ", " (at) ", " [at] ", "(at)", "[at]", " @ ", "@"])
        dot = rng.choice([" dot ", " (dot) ", "[dot]", "(dot)", "."]) if at != "@" else rng.choice([" dot ", "[.]", "(dot)"])
        name, _, domain = span.partition("@")
        return name + at + domain.replace(".", dot)
    if kind == 1:
        return span.replace(".", rng.choice(["[.]", " . ", "(.)", " dot ", "[dot]"]))
    digits = digits_of(span)
    if kind == 2:
        mark = rng.choice([".", "/", "_", "  ", " - ", ""])
        return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    lead = rng.choice(["", "", "001 ", "00" + digits[0] + " "])
    rest = digits[1:] if len(digits) > 9 else digits
    form = rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}", "({}){}-{}", "{}/{}-{}"])
    return lead + form.format(rest[:3], rest[3:6], rest[6:])


def sample_windows(docs: DataFrame, size: int = WINDOWS) -> DataFrame:
    """(kind, text, spans) of at most ``size`` windows a kind, and of as many without spans twice over; chosen by hash."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                if not text:
                    continue
                spans = base_spans(text)
                for kind, lo, hi in spans:
                    if hi - lo <= WIDTH - 16:
                        h = int.from_bytes(hashlib.sha256(f"{lo} {text[max(0, lo - 99):hi + 99]}".encode("utf-8", "surrogatepass")).digest()[:7], "little")
                        start = max(0, lo - h % (WIDTH - 8 - (hi - lo)))
                        rows.append((kind, h, start, text, spans))
                taken = sorted((lo, hi) for _, lo, hi in spans)
                k = 0
                for n, (lo, hi) in enumerate(windows(text)):
                    while k < len(taken) and taken[k][1] <= lo:
                        k += 1
                    if k == len(taken) or taken[k][0] >= hi:
                        h = int.from_bytes(hashlib.sha256(f"{n} {text[lo:hi]}".encode("utf-8", "surrogatepass")).digest()[:7], "little")
                        rows.append((-1, h, lo, text, []))
                h = int.from_bytes(hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()[:7], "little")
                start = h % len(text)
                if not any(lo < start + WIDTH and hi > start for _, lo, hi in spans):
                    rows.append((-2, h, start, text, []))  # anywhere
            best: dict[int, list] = {}
            for row in rows:
                best.setdefault(row[0], []).append(row)
            out = []
            for kind, found in best.items():  # no more than can be chosen
                for _, h, start, text, spans in sorted(found, key=lambda r: r[1])[:size]:
                    piece = text[start : start + WIDTH]
                    inside = [(k, lo - start, hi - start) for k, lo, hi in spans if lo < start + WIDTH and hi > start]
                    out.append((kind, h, piece, ";".join(f"{k}:{lo}:{hi}" for k, lo, hi in inside)))
            yield pd.DataFrame(out, columns=["kind", "h", "piece", "spans"]).astype({"kind": "int32", "h": "int64"})

    found = docs.select("text").mapInPandas(cut, "kind int, h long, piece string, spans string")
    for keys in (["kind", F.pmod("h", F.lit(64))], ["kind"]):  # first within parts of a kind, so that no task gets what all tasks chose
        order = Window.partitionBy(*keys).orderBy("h", "piece", "spans")
        found = found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= size).drop("n")
    return found


def examples(rows: list[tuple], seed: int = SEED) -> list[tuple[str, list]]:
    """Training windows: the sample as it is, and its spans written in other ways, shifted to where they stand then."""
    rng, out = random.Random(seed), []
    for kind, piece, spans in rows:
        out.append((piece, spans))
        whole = [s for s in spans if s[1] >= 0 and s[2] <= len(piece)]
        if kind < 0 or len(whole) != len(spans):
            continue
        for _ in range(2):
            text, moved, last = "", [], 0
            for k, lo, hi in sorted(spans, key=lambda s: s[1]):
                if lo < last:
                    break
                text += piece[last:lo]
                new = rewrite(rng, k, piece[lo:hi])
                moved.append((k, len(text), len(text) + len(new)))
                text, last = text + new, hi
            else:
                text += piece[last:]
                lead = max(0, moved[-1][2] - WIDTH + rng.randrange(1, 12))
                out.append((text[lead : lead + WIDTH], [(k, lo - lead, min(hi - lead, WIDTH)) for k, lo, hi in moved if hi > lead and lo - lead < WIDTH]))
    return out


# ---- the network


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return (most + np.log(np.exp(x - most).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Embedding, LSTMs in both directions, a linear layer and CRF transitions; parameters by name, in float32."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        normal = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"E": (rng.standard_normal((CLASSES, EMBED)) * 0.5).astype(np.float32)}
        for d in "fb":
            self.p |= {f"X{d}": normal(EMBED, 4 * HIDDEN), f"H{d}": normal(HIDDEN, 4 * HIDDEN), f"c{d}": np.zeros(4 * HIDDEN, np.float32)}
            self.p[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1  # remember at first
        self.p |= {"O": normal(2 * HIDDEN, LABELS), "o": np.zeros(LABELS, np.float32), "T": np.zeros((LABELS, LABELS), np.float32)}

    def lstm(self, e: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        n, t, _ = e.shape
        inner = e @ self.p[f"X{d}"] + self.p[f"c{d}"]
        h = c = np.zeros((n, HIDDEN), np.float32)
        out = np.empty((n, t, HIDDEN), np.float32)
        for s in range(t) if d == "f" else range(t - 1, -1, -1):
            z = inner[:, s] + h @ self.p[f"H{d}"]
            ifo, g = sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
            i, f, o = ifo[:, :HIDDEN], ifo[:, HIDDEN : 2 * HIDDEN], ifo[:, 2 * HIDDEN :]
            before, c = c, f * c + i * g
            squashed = np.tanh(c)
            if keep is not None:
                keep.append((s, i, f, o, g, before, squashed, h))
            h = o * squashed
            out[:, s] = h
        return out

    def emissions(self, x: np.ndarray, keep: dict | None = None) -> np.ndarray:
        e = self.p["E"][x]
        steps = {"f": [], "b": []} if keep is not None else {"f": None, "b": None}
        both = np.concatenate([self.lstm(e, d, steps[d]) for d in "fb"], axis=2)
        if keep is not None:
            keep |= {"e": e, "both": both, "steps": steps}
        return both @ self.p["O"] + self.p["o"]

    def marginals(self, em: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Posteriors of labels, expected transitions, log of the sum over all paths."""
        n, t, k = em.shape
        trans = self.p["T"]
        alpha, beta = np.empty_like(em), np.zeros_like(em)
        alpha[:, 0] = em[:, 0]
        for s in range(1, t):
            alpha[:, s] = em[:, s] + logsumexp(alpha[:, s - 1, :, None] + trans, 1)
        for s in range(t - 2, -1, -1):
            beta[:, s] = logsumexp(trans + (em[:, s + 1] + beta[:, s + 1])[:, None, :], 2)
        z = logsumexp(alpha[:, -1], 1)
        post = np.exp(alpha + beta - z[:, None, None])
        moves = np.zeros((k, k), np.float64)
        for s in range(1, t):
            moves += np.exp(alpha[:, s - 1, :, None] + trans + (em[:, s] + beta[:, s])[:, None, :] - z[:, None, None]).sum(axis=0)
        return post, moves.astype(np.float32), z

    def viterbi(self, em: np.ndarray) -> np.ndarray:
        n, t, k = em.shape
        best, back = em[:, 0], np.empty((n, t, k), np.int16)
        for s in range(1, t):
            each = best[:, :, None] + self.p["T"]
            back[:, s] = each.argmax(axis=1)
            best = each.max(axis=1) + em[:, s]
        path = np.empty((n, t), np.int64)
        path[:, -1] = best.argmax(axis=1)
        for s in range(t - 1, 0, -1):
            path[:, s - 1] = back[np.arange(n), s, path[:, s]]
        return path

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the label paths, and its gradients."""
        keep: dict = {}
        em = self.emissions(x, keep)
        n, t, _ = em.shape
        post, moves, z = self.marginals(em)
        rows, cols = np.arange(n)[:, None], np.arange(t)[None, :]
        seen = np.zeros_like(moves)
        np.add.at(seen, (y[:, :-1], y[:, 1:]), 1)
        loss = float((z - em[rows, cols, y].sum(axis=1) - self.p["T"][y[:, :-1], y[:, 1:]].sum(axis=1)).mean())
        post[rows, cols, y] -= 1
        d_em = post / n
        g = {"T": (moves - seen) / n, "O": np.einsum("nth,ntk->hk", keep["both"], d_em), "o": d_em.sum(axis=(0, 1))}
        d_both = d_em @ self.p["O"].T
        d_e = np.zeros_like(keep["e"])
        for d, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
            d_inner = np.zeros((n, t, 4 * HIDDEN), np.float32)
            d_h = d_c = np.zeros((n, HIDDEN), np.float32)
            g_h = np.zeros_like(self.p[f"H{d}"])
            for s, i, f, o, gate, before, squashed, h_before in reversed(keep["steps"][d]):
                d_out = d_both[:, s, part] + d_h
                d_c = d_c + d_out * o * (1 - squashed**2)
                d_z = np.concatenate([d_c * gate * i * (1 - i), d_c * before * f * (1 - f), d_out * squashed * o * (1 - o), d_c * i * (1 - gate**2)], axis=1)
                d_c = d_c * f
                d_h = d_z @ self.p[f"H{d}"].T
                g_h += h_before.T @ d_z
                d_inner[:, s] = d_z
            g |= {f"H{d}": g_h, f"X{d}": np.einsum("nte,ntz->ez", keep["e"], d_inner), f"c{d}": d_inner.sum(axis=(0, 1))}
            d_e += d_inner @ self.p[f"X{d}"].T
        g["E"] = np.zeros_like(self.p["E"])
        np.add.at(g["E"], x, d_e)
        return loss, g

    def fit(self, data: list[tuple[str, list]], steps: int = STEPS, seed: int = SEED) -> Tagger:
        """Adam over random batches, with the rate falling to zero."""
        x, y = padded([codes(t) for t, _ in data]), padded([labelled(len(t), s) for t, s in data])
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            some = rng.integers(0, len(x), BATCH)
            _, g = self.gradients(x[some], y[some])
            norm = np.sqrt(sum(float((a.astype(np.float64) ** 2).sum()) for a in g.values()))
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, a in g.items():
                a = a * min(1.0, 5 / max(norm, 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * a
                v2[k] = 0.99 * v2[k] + 0.01 * a * a
                self.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self

    def tag(self, pieces: list[str]) -> list[list[tuple[int, int, int, float]]]:
        """(kind, start, end, posterior) of the decoded spans of each window."""
        out: list = []
        for lo in range(0, len(pieces), 512):
            some = pieces[lo : lo + 512]
            em = self.emissions(padded([codes(t) for t in some]))
            path, post = self.viterbi(em), self.marginals(em)[0]
            sure = np.take_along_axis(post, path[:, :, None], axis=2)[:, :, 0]
            for row, p, t in zip(path, sure, some, strict=True):
                out.append(spans_of(row[: len(t)], p))
        return out


def spans_of(path: np.ndarray, sure: np.ndarray) -> list[tuple[int, int, int, float]]:
    out, at = [], 0
    while at < len(path):
        if path[at] == NONE:
            at += 1
            continue
        kind, end = (int(path[at]) - 1) // 2, at + 1
        while end < len(path) and path[end] == 2 + 2 * kind:
            end += 1
        if path[at] % 2:  # a span has a beginning
            out.append((kind, at, end, float(sure[at:end].min())))
        at = end
    return out


def padded(rows: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(rows), WIDTH), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r[:WIDTH]
    return out


# ---- whole documents


def reconciled(found: list[tuple[int, int, int, float, float]]) -> list[tuple[int, int, int, float]]:
    """Of the spans (kind, start, end, posterior, weight) of all windows of a document the set without overlaps that weighs most."""
    best: dict[tuple, tuple[float, float]] = {}
    for kind, lo, hi, sure, weight in found:
        best[kind, lo, hi] = max(best.get((kind, lo, hi), (0.0, 0.0)), (weight, sure))
    spans = sorted(((hi, lo, kind, *w) for (kind, lo, hi), w in best.items()))
    ends = [s[0] for s in spans]
    total, taken = [0.0], []
    for n, (_, lo, _, weight, _) in enumerate(spans):
        j = int(np.searchsorted(ends[:n], lo, side="right")) if n else 0
        use = total[j] + weight > total[n]
        total.append(total[j] + weight if use else total[n])
        taken.append(j if use else -1)
    out, n = [], len(spans)
    while n:
        if taken[n - 1] >= 0:
            hi, lo, kind, _, sure = spans[n - 1]
            out.append((kind, lo, hi, sure))
            n = taken[n - 1]
        else:
            n -= 1
    return out[::-1]


def added_spans(texts: list[str], bases: list[list], model: Tagger, sure: float = SURE) -> list[list[tuple[int, int, int]]]:
    """The model's spans beside the base spans of each text."""
    places = [(d, lo, hi) for d, text in enumerate(texts) for lo, hi in windows(text)]
    tagged = model.tag([texts[d][lo:hi] for d, lo, hi in places]) if places else []
    found: list[list] = [[] for _ in texts]
    for (d, lo, hi), spans in zip(places, tagged, strict=True):
        for kind, a, b, p in spans:
            # next to an edge that is no end of the text the window may not see the whole span
            cut = (a < 2 and lo > 0) + (b > hi - lo - 2 and hi < len(texts[d]))
            found[d].append((kind, lo + a, lo + b, p, p * (1.0, 0.3, 0.1)[cut]))
    out = []
    for text, base, spans in zip(texts, bases, found, strict=True):
        good = []
        for kind, lo, hi, p in reconciled(spans):
            while lo < hi and text[lo] in " \t\n\r.,;:":
                lo += 1
            while lo < hi and text[hi - 1] in " \t\n\r.,;:(":
                hi -= 1
            if p >= sure and lo < hi and plausible(kind, text[lo:hi]) and not any(lo < b and hi > a for _, a, b in base):
                good.append((kind, lo, hi))
        out.append(good)
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{lo}:{hi}" for k, lo, hi in sorted(spans, key=lambda s: (s[0], s[1])))


def train(docs: DataFrame, size: int = WINDOWS, steps: int = STEPS) -> Tagger | None:
    """A model from the labelled windows of the documents; at most ``size`` windows of each kind come to the driver."""
    found = sample_windows(docs, size).orderBy("kind", "h", "piece", "spans").collect()
    rows = [(r.kind, r.piece, [tuple(map(int, s.split(":"))) for s in r.spans.split(";") if s]) for r in found]
    if not any(kind >= 0 for kind, _, _ in rows):
        return None
    return Tagger().fit(examples(rows), steps)


def find(docs: DataFrame, model: Tagger | None) -> DataFrame:
    """Counts and digest of the base spans and all spans of every document."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            bases = [base_spans(t) for t in texts]
            more = added_spans(texts, bases, model) if model else [[] for _ in texts]
            counts = {f"n_{k}": pa.array([sum(s[0] == n for s in b) for b in bases], pa.int64()) for n, k in enumerate(KINDS)}
            shas = [hashlib.sha256(joined(b).encode()).hexdigest() for b in bases]
            spans = [joined(b + m) for b, m in zip(bases, more, strict=True)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **counts, "base_sha256": pa.array(shas, pa.string()), "spans": pa.array(spans, pa.string())})

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(mark, schema)  # ids stay whole beside null ones


def op12_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    session(spark)
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return find(docs, train(docs))
