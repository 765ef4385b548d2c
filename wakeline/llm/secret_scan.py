"""Secret scans: base patterns, and a character convolutional network for the rest.

The base patterns give findings of the kinds ``assign``, ``access`` and ``hex``;
these always stay.  Every other token of 16 or more characters out of letters,
digits and ``+/_=.-`` that has a letter and a digit is a candidate too; of a
token that a base finding touches, so is each part that the findings leave.  The
network reads each candidate with the characters around it and gives a
probability; candidates at or above the threshold become spans of the kind
``cnn``.  A candidate that is longer than what the network reads is read by its
two ends, in windows that overlap by half, and by its pieces between ``/``,
``.`` and ``=``; its probability is the largest of these.

Training.  The labelled findings are the base findings (1) and the other
candidates (0) of about ``SAMPLE`` documents, drawn by the hash of the id, of
at most ``SAMPLE_CHARS`` characters, and strings of known kinds written into passages of
these documents: keys and tokens (1), or addresses, account numbers, paths,
dates and identifiers (0).  One fifth is held out: there the logits are
calibrated (Platt) and the threshold is the largest probability that still
finds ``RECALL`` of the held-out secrets.  The sample and the network are of a
fixed size, so is what the driver holds and broadcasts.  The seed is fixed.

Cases: a null text is empty and has no spans.  Repeated rows are scanned alike.
On an empty table the network learns from the written strings alone, without
passages.  Texts are scanned whole.  ``redact`` puts ``MASK`` in place of each
span, sets n_chars, if there, to the new length, and keeps all other columns.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, field, hash_sample, packed, unpacked

KINDS = ("assign", "access", "hex", "cnn")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Every access and hex finding lies in one of these.
TOKEN = re.compile(r"[A-Za-z0-9+/_=.-]{16,}")
KEYWORDS = ("passw", "secret", "token", "api")
#: Of a long candidate.
PIECE = re.compile(r"[^/.=]{16,}")

SAMPLE = 3000
SAMPLE_CHARS = 20_000
PASSAGES = 1500
RECALL = 0.98
MASK = "[SECRET]"

#: What the network reads: characters before, of the candidate, after.
BEFORE, INSIDE, AFTER = 24, 40, 12
ALPHABET = 97  # printable ASCII, any other character, nothing
EMBED, WIDTH, FILTERS = 10, 5, 24

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the base findings, by start, then kind."""
    return _tokens(text)[0]


def _mixed(token: str) -> bool:
    return len(token) >= 16 and bool(re.search("[A-Za-z]", token) and re.search("[0-9]", token))


def _tokens(text: str) -> tuple[list[Span], list[tuple[int, int]], list[tuple[int, int]]]:
    """Base findings, the other candidates, and the parts that findings leave of the tokens they touch."""
    spans, runs = [], []
    if "=" in text or ":" in text:
        low = text.lower()
        if any(k in low for k in KEYWORDS):
            spans = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    for run in TOKEN.finditer(text):
        a, b = run.span()
        if b - a >= 20:
            spans += [(*m.span(), "access") for m in ACCESS.finditer(text, a, b)]
            spans += [(*m.span(), "hex") for m in HEX.finditer(text, a, b)]
        token = run[0].rstrip(".=-")
        if _mixed(token):
            runs.append((a, a + len(token)))
    spans.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    others, parts, k = [], [], 0
    covered: list[list[int]] = []  # the findings without overlap
    for s, e, _ in spans:
        if covered and s <= covered[-1][1]:
            covered[-1][1] = max(e, covered[-1][1])
        else:
            covered.append([s, e])
    for a, b in runs:
        while k < len(covered) and covered[k][1] <= a:
            k += 1
        at, j = a, k
        while j < len(covered) and covered[j][0] < b:
            parts.append((at, covered[j][0]))
            at, j = covered[j][1], j + 1
        if j > k:
            parts.append((at, b))
        else:
            others.append((a, b))
    left = []
    for a, b in parts:
        part = text[a:b].rstrip("/.=-")
        token = part.lstrip("/.=-")
        if _mixed(token):
            left.append((a + len(part) - len(token), a + len(part)))
    return spans, others, left


def _window(text: str, start: int, end: int) -> tuple[str, str, str]:
    inside = text[start:end]
    if len(inside) > INSIDE:
        inside = inside[:INSIDE // 2] + inside[-INSIDE // 2:]
    return text[max(0, start - BEFORE):start], inside, text[end:end + AFTER]


def _windows(text: str, start: int, end: int) -> list[tuple[str, str, str]]:
    """What the network reads of a candidate: all of it."""
    windows = [_window(text, start, end)]
    if end - start > INSIDE:
        windows += [_window(text, a, a + INSIDE) for a in [*range(start, end - INSIDE, INSIDE // 2), end - INSIDE]]
        windows += [_window(text, *m.span()) for m in PIECE.finditer(text, start, end) if _mixed(m[0])]
    return windows


def encode(windows: list[tuple[str, str, str]]) -> np.ndarray:
    """Windows as character numbers, doubled for those inside the candidate."""
    out = np.full((len(windows), BEFORE + INSIDE + AFTER), ALPHABET - 1, np.int64)
    for row, (before, inside, after) in zip(out, windows):
        for at, part, shift in ((BEFORE - len(before), before, 0), (BEFORE, inside, ALPHABET), (BEFORE + INSIDE, after, 0)):
            codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            row[at:at + len(codes)] = np.where((codes >= 32) & (codes < 127), codes - 32, 95) + shift
    return out


class CharCnn:
    """Embedding, one convolution, maximum and mean over places, logistic output."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.w = {"embed": r.normal(0, 0.3, (2 * ALPHABET, EMBED)), "conv": r.normal(0, 0.15, (WIDTH * EMBED, FILTERS)),
                  "bias": np.zeros(FILTERS), "out": r.normal(0, 0.2, 2 * FILTERS), "off": np.zeros(1)}
        self.scale, self.shift, self.threshold = 1.0, 0.0, 0.5

    def _forward(self, x: np.ndarray) -> tuple:
        e = self.w["embed"][x]
        n, length, _ = e.shape
        places = length - WIDTH + 1
        cols = np.concatenate([e[:, k:k + places] for k in range(WIDTH)], axis=2)
        z = cols.reshape(-1, WIDTH * EMBED) @ self.w["conv"] + self.w["bias"]
        a = np.maximum(z, 0).reshape(n, places, FILTERS)
        top = a.argmax(axis=1)
        pooled = np.concatenate([a.max(axis=1), a.mean(axis=1)], axis=1)
        return cols, a, top, pooled, pooled @ self.w["out"] + self.w["off"][0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[i:i + 512])[-1] for i in range(0, len(x), 512)] or [np.zeros(0)])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(x) + self.shift, -50, 50)))

    def _gradient(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        cols, a, top, pooled, logit = self._forward(x)
        n, places, _ = a.shape
        d = (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - y) / n
        g = {"out": pooled.T @ d, "off": np.array([d.sum()])}
        back = d[:, None] * self.w["out"]
        da = np.repeat(back[:, None, FILTERS:] / places, places, axis=1)
        rows, filters = np.indices(top.shape)
        da[rows, top, filters] += back[:, :FILTERS]
        dz = (da * (a > 0)).reshape(-1, FILTERS)
        g["conv"], g["bias"] = cols.reshape(len(dz), -1).T @ dz, dz.sum(axis=0)
        dcols = (dz @ self.w["conv"].T).reshape(n, places, WIDTH, EMBED)
        g["embed"] = np.zeros_like(self.w["embed"])
        for k in range(WIDTH):
            np.add.at(g["embed"], x[:, k:k + places], dcols[:, :, k])
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.004) -> CharCnn:
        """Adam; every fifth row is held out for calibration and threshold."""
        r = np.random.default_rng(11)
        held = np.arange(len(x)) % 5 == 4
        train = np.flatnonzero(~held)
        m, v = ({k: np.zeros_like(w) for k, w in self.w.items()} for _ in range(2))
        t = 0
        for _ in range(epochs):
            r.shuffle(train)
            for i in range(0, len(train), batch):
                part, t = train[i:i + batch], t + 1
                for k, g in self._gradient(x[part], y[part]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.w[k] = self.w[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        self._calibrate(self.logits(x[held]), y[held])
        return self

    def _calibrate(self, logit: np.ndarray, y: np.ndarray) -> None:
        pos, neg = y.sum(), len(y) - y.sum()
        goal = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))  # Platt's targets
        for _ in range(2000):
            d = 1 / (1 + np.exp(-np.clip(self.scale * logit + self.shift, -50, 50))) - goal
            self.scale -= 0.05 * float((d * logit).mean())
            self.shift -= 0.05 * float(d.mean())
        p = np.sort(1 / (1 + np.exp(-np.clip(self.scale * logit[y == 1] + self.shift, -50, 50))))
        if len(p):
            self.threshold = float(p[int((1 - RECALL) * len(p))])


def _made(r: random.Random) -> tuple[str, str, str, int]:
    """A string of a known kind with what stands before and after it, and its label."""
    def of(chars: str, n: int) -> str:
        return "".join(r.choice(chars) for _ in range(n))

    letters, digits = string.ascii_lowercase, string.digits
    mixed, b64 = string.ascii_letters + digits, string.ascii_letters + digits + "+/"
    word = lambda: of(letters, r.randint(3, 10))
    secret = [
        lambda: ("", of(mixed, r.choice([20, 24, 32, 40, 48])), ""),
        lambda: ("", of(b64, r.choice([32, 40, 44, 64, 88])), ""),
        lambda: (r.choice(["key: ", "auth = ", "credential=", "Authorization: Bearer ", "private key "]), of(mixed + "-_", r.randint(20, 60)), r.choice(["", '"', ";"])),
        lambda: ("", r.choice(["ghp_", "gho_", "xoxb-", "sk_live_", "pk_test_", "glpat-", "npm_", "SG."]) + of(mixed, r.randint(20, 40)), ""),
        lambda: ("Bearer ", "eyJ" + of(mixed, 20) + "." + of(mixed + "-_", 40) + "." + of(mixed + "-_", 30), ""),
        lambda: ("", of("0123456789abcdef", r.choice([32, 40, 64])), ""),
        lambda: ("", "AKIA" + of(string.ascii_uppercase + digits, 16), ""),
        lambda: ("", "AIza" + of(mixed + "-_", 35), ""),
    ]
    plain = [
        lambda: ("@", word() + of(digits, r.randint(1, 3)) + "." + r.choice(["example.com", "mail.example.org", "example.net"]), ""),
        lambda: ("", word() + "." + word() + of(digits, 2) + "-" + word() + "." + word(), r.choice(["", "@"])),
        lambda: ("", of(string.ascii_uppercase, 2) + of(digits, r.randint(16, 22)), ""),
        lambda: ("", "/".join([word(), word(), word() + of(digits, 2), word() + ".html"]), ""),
        lambda: ("", f"20{of(digits, 2)}-{r.randint(10, 12)}-{r.randint(10, 28)}T{r.randint(10, 23)}", ":30:00Z"),
        lambda: ("", "_".join([word(), word(), word(), "v" + of(digits, 2)]), ""),
        lambda: ("", "-".join(of("0123456789abcdef", n) for n in (8, 4, 4, 4, 12)), ""),
        lambda: ("", "".join(word().capitalize() for _ in range(3)) + of(digits, r.randint(1, 4)), ""),
        lambda: ("", word() + "-" + of(digits, 1) + "." + of(digits, 2) + "." + of(digits, 1) + "-" + word() + ".tar.gz", ""),
        lambda: ("://", "www." + word() + ".example.com/" + word() + "/" + of(digits, 5), ""),
        lambda: ("", word() + "---" + word() + of(digits, r.randint(1, 3)) + "..." + word(), ""),
    ]
    label = r.randint(0, 1)
    return *r.choice(secret if label else plain)(), label


def labelled_findings(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows and labels: what the texts hold, and written strings."""
    windows, labels = [], []
    for t in texts:
        spans, others, _ = _tokens(t)
        for found, label in (([s[:2] for s in spans], 1), (others[:4], 0)):  # four of a text's other candidates are enough here
            windows += [_window(t, a, b) for a, b in found]
            labels += [label] * len(found)
    r = random.Random(5)
    for k in range(2 * PASSAGES):
        before, made, after, label = _made(r)
        t = texts[k % len(texts)] if texts else ""
        gaps = [m.start() for m in re.finditer(" ", t[:4000])]
        at = r.choice(gaps) + 1 if gaps else 0
        written = t[max(0, at - 60):at] + before
        windows.append(_window(written + made + after + " " + t[at:at + 40], len(written), len(written) + len(made)))
        labels.append(label)
    order = np.random.default_rng(3).permutation(len(windows))
    return encode([windows[i] for i in order]), np.array(labels, float)[order]


def fit_network(docs: DataFrame) -> CharCnn:
    sample = (hash_sample(docs.select("doc_id", "text"), SAMPLE, "doc_id")
              .where(F.length("text") <= SAMPLE_CHARS).select("text").limit(2 * SAMPLE).collect())
    return CharCnn().fit(*labelled_findings(sorted(r["text"] for r in sample)))


def scan(texts: list[str | None], network: CharCnn) -> list[list[Span]]:
    """All spans of each text, by start, then kind."""
    found, windows, places = [], [], []
    hits: set[tuple[int, int, int]] = set()

    def read() -> None:
        for i in range(0, len(windows), 4096):
            p = network.probability(encode(windows[i:i + 4096]))
            hits.update(places[i + j] for j in np.flatnonzero(p >= network.threshold))
        windows.clear()
        places.clear()

    for k, t in enumerate(texts):
        spans, others, parts = _tokens(t or "")
        found.append(spans)
        for a, b in others + parts:
            new = _windows(t, a, b)
            windows += new
            places += [(k, a, b)] * len(new)
        if len(windows) > 4096:
            read()
    read()
    for k, a, b in hits:
        found[k].append((a, b, "cnn"))
    for k in {k for k, _, _ in hits}:
        found[k].sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return found


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def _masked(text: str | None, spans: list[Span]) -> str | None:
    if not spans:
        return text
    parts, at = [], 0
    for a, b, _ in spans:
        if b <= at:
            continue
        if a >= at:  # else it goes on where the last one ends
            parts += [text[at:a], MASK]
        at = b
    return "".join([*parts, text[at:]])


def _scanner(docs: DataFrame) -> Callable:
    network = docs.sparkSession.sparkContext.broadcast(fit_network(docs))

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def scanned(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for spans in scan(list(texts), network.value):
            base = [s for s in spans if s[2] != "cnn"]
            n = {k: sum(s[2] == k for s in base) for k in KINDS}
            rows.append((n["assign"], n["access"], n["hex"], hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return scanned


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id with the counts, the digest of the base spans and all spans."""
    found = _scanner(docs)
    return docs.select("doc_id", found("text").alias("_found")).select("doc_id", "_found.*")


def redact(docs: DataFrame) -> DataFrame:
    """The documents with their secrets masked."""
    network = docs.sparkSession.sparkContext.broadcast(fit_network(docs))

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        every = list(texts)
        return pd.Series([_masked(t, s) for t, s in zip(every, scan(every, network.value))], dtype="object")

    clean = packed(docs).withColumn("_clean", masked(field("text")))
    row = F.col(ROW).withField("text", F.col("_clean"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.when(F.col("_clean") == field("text"), field("n_chars")).otherwise(F.length("_clean").cast(kind)))
    return unpacked(clean.select(row.alias(ROW)))
