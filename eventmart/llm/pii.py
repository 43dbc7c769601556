"""Operator 4: personal data by patterns and a character-level bidirectional LSTM with CRF transitions.

Base spans come from patterns (email, ip, card, phone). The model adds spans of the kinds that it was trained for,
also in spellings that the patterns miss (keys and passwords, national phone numbers, dotted card numbers, IPv6,
spelled-out emails, identity numbers). It is written and trained in numpy, from seeded labelled spans in generated
carrier text, once per process.

The model reads every character of every text, in windows of ``READ`` characters that overlap. The windows' emissions
fade into each other, and one Viterbi path over the text (over each block of ``SEGMENT`` characters and its margins, if
it is longer) reconciles them. A path's span is added if it is likely enough, passes its kind's check and touches no base
span and no earlier added one.

Edge cases: a null text is an empty one and has no spans; offsets are code points, ends exclusive; texts of any length
are read whole, in windows; equal spans are reported once per document row; an empty table gives no rows; other
columns are ignored by `find` and kept by `redact`.
"""

from __future__ import annotations

import functools
import hashlib
import ipaddress
import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "secret", "id")
BASE = KINDS[:4]
WIDTH, HIDDEN, EMBEDDING = 80, 8, 8
#: Characters of a window when reading, and how many of them the next window reads again.
READ, OVERLAP = 960, WIDTH // 2
#: A text is read in blocks of so many characters, with so many more on both sides; a span belongs to the block it starts in.
SEGMENT, MARGIN = 1 << 19, 2000
LIKELY = 0.85

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_AT = re.compile(r" ?(?:@|[\[(]at[\])]) ?| at ", re.IGNORECASE)
_DOT = re.compile(r" ?(?:[\[(]dot[\])]|\.) ?| dot ", re.IGNORECASE)
_HOST = re.compile(rf"\S*?(?:(?:{_DOT.pattern})\S+?)*(?!\S)|\S*", re.IGNORECASE)
#: What names a secret and leads up to it.
_KEYED = re.compile(r"""(?:pass(?:word|wd|phrase)|pwd|token|secret|api[ _-]?key|auth)\w{0,12}["']?\s{0,3}(?:[=:]\s{0,3}|\sis\s)["']?""",
                    re.IGNORECASE)
#: An address spelled in words: a user, one "at", a host with at least one "dot".
_SPELLED = re.compile(r"[^\s@]{1,64}(?: at | ?[\[(]at[\])] ?)[^\s@.]{1,64}+(?:(?: dot | ?[\[(]dot[\])] ?|\.)[^\s@.,;|]{1,64}+)++"
                      r"(?! at | ?[\[(]at[\])])", re.IGNORECASE)
_ISSUED = re.compile(r"AKIA|sk_live_|ghp_|xoxb-")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their @, so that long runs cost no retries."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Spans of the four base kinds, by kind, then start."""
    spans: list[tuple[str, int, int]] = []
    if not text:
        return spans
    if "@" in text:
        spans += [("email", a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        # Zeros in front don't change a part's value.
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans.append(("phone", m.start(), m.end()))
    return spans


# ---------------------------------------------------------------- labelled spans to learn from

def _labelled(rng: np.random.Generator, n: int) -> tuple[list[str], np.ndarray]:
    """``n`` texts of WIDTH characters and a label for each character (0: none, else 1 + place in KINDS)."""
    pick = lambda s: s[int(rng.integers(len(s)))]
    some = lambda chars, lo, hi: "".join(pick(chars) for _ in range(int(rng.integers(lo, hi + 1))))
    number = lambda lo, hi: str(int(rng.integers(lo, hi + 1)))
    lower, upper, digits, hexes = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"

    def card() -> str:
        body = pick("3456") + some(digits, 14, 14)
        body += next(c for c in digits if luhn(body + c))
        sep = pick(["", "", " ", "-", "."])
        return sep.join(body[i:i + 4] for i in range(0, 16, 4))

    def email() -> str:
        user = some(lower, 2, 9) + pick(["", pick(["", ".", "_", "-"]) + some(lower + digits, 1, 5)])
        a, dot = pick([("@", "."), ("@", "."), ("@", "."), (" (at) ", " (dot) "), (" [at] ", " [dot] "), (" [at] ", "."),
                       (" at ", " dot "), (" at ", " dot "), (" at ", " dot "), (pick([" (at) ", "(at)", " [at] "]), "")])
        if rng.random() < 0.3:
            a, dot = a.upper(), dot.upper()
        ending = pick(["com", "org", "net", "de", "example.com", "co.uk"]).replace(".", dot)
        return user + a + some(pick([lower, lower + digits]), 3, 8) + (dot and dot + ending)

    def phone() -> str:
        a, b, c = number(200, 999), number(200, 999), some(digits, 4, 4)
        return pick([f"+{number(1, 99)} ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{number(1, 99)} {a} {b} {c}",
                     f"00{number(20, 99)} {a} {some(digits, 5, 7)}", f"+{number(1, 99)}.{a}.{b}.{c}"])

    def ip() -> str:
        groups = lambda lo, hi: ":".join(some(hexes, 1, 4) for _ in range(int(rng.integers(lo, hi + 1))))
        return pick([".".join(number(0, 255) for _ in range(4)), ":".join(some(hexes, 4, 4) for _ in range(8)),
                     ":".join(some(hexes, 1, 4) for _ in range(8)), f"{groups(1, 4)}::{groups(1, 3)}", f"{groups(2, 4)}::"])

    def secret() -> str:
        word = pick(["password", "token", "secret", "api_key", "passwd", "auth", "passphrase"])
        word = pick([word, word, word.upper(), word.capitalize()])
        body = pick([some(hexes, 16, 40), some(lower + upper + digits, 14, 32), some(letters, 4, 28), some(letters, 4, 28),
                     some(lower, 3, 10) + some(digits, 1, 4), some(lower + upper, 5, 32)])
        quoted = pick([body, body, " ".join(some(letters, 2, 8) for _ in range(int(rng.integers(2, 5))))])
        shown = some(lower, 3, 8) + some(digits, 1, 4)
        return pick([f"{word}={body}", f'{word} = "{quoted}"', f'{word} = "{body}"', f"{word}: {body}", f"{word} = {body}",
                     f"{word}: {body}", f"{word} is {shown}",
                     "AKIA" + some(upper + digits, 16, 16),
                     pick(["sk_live_", "ghp_", "xoxb-"]) + some(lower + upper + digits, 20, 32)])

    def identity() -> str:
        return f"{number(100, 899)}-{number(10, 99)}-{number(1000, 9999)}"

    def harmless() -> str:
        return pick([number(0, 99999), "$" + number(1, 999) + "." + some(digits, 2, 2), number(1900, 2030),
                     f"{number(0, 23)}:{number(10, 59)}", f"20{number(10, 30)}-0{number(1, 9)}-{number(10, 28)}",
                     f"{number(1, 99)}%", f"v{number(0, 9)}.{number(0, 20)}.{number(0, 20)}", some(digits, 5, 12),
                     f"{number(1, 9)}.{some(digits, 1, 4)}", f"{number(1, 12)}/{number(1, 28)}/{number(1990, 2030)}",
                     f"{number(1, 9)},{some(digits, 3, 3)},{some(digits, 3, 3)}", some(lower, 2, 6) + number(1, 99),
                     f"{number(1, 99)}-{number(100, 200)}", "@" + some(lower, 3, 9), "(" + number(1, 30) + ")",
                     pick(["password", "token", "secret", "auth", "Password", "passphrase"]) + pick([" ", ", ", ". "]) + some(letters, 2, 9),
                     "at " + pick(["", "the "]) + some(letters, 2, 9), pick(["me at", "us at", "mail at", "reach me at", "write to me at"]),
                     pick(["password", "token", "passwd"]) + " is " + some(letters, 2, 9), pick(["at", "dot", "AT", "dot " + some(letters, 2, 9)]),
                     "at the dot " + some(letters, 2, 9), some(letters, 2, 9) + " at " + some(letters, 2, 9) + " " + some(letters, 2, 9),
                     some(letters, 2, 10) + pick([": ", "=", " = "]) + some(letters, 2, 12)])

    makers = (email, ip, card, phone, secret, identity)
    letters = lower + "aeiounrst" + "aeiounrst" + "éèçüöäßñóí"
    texts, labels = [], np.zeros((n, WIDTH), np.int64)
    for k in range(n):
        text, marks = "", []
        while len(text) < 3 * WIDTH:
            word = some(letters, 1, 10)
            shape = rng.random()
            word = word.capitalize() if shape < 0.15 else word.upper() if shape < 0.2 else word
            kind, part = 0, word + pick(["", "", "", "", ",", ".", "***", "|", "!!", "%%%"])
            chance = rng.random()
            if chance < 0.12:
                # Spellings in letters only take more examples than digits do.
                kind = int(rng.choice([1, 1, 1, 1, 2, 3, 4, 5, 5, 5, 5, 6]))
                part = makers[kind - 1]()
            elif chance < 0.2:
                part = harmless()
            text += part
            marks += [kind] * len(part)
            gap = pick([" ", " ", " ", " ", "\n", " | ", ", "])
            text += gap
            marks += [0] * len(gap)
        at = int(rng.integers(0, len(text) - WIDTH))
        texts.append(text[at:at + WIDTH])
        labels[k] = marks[at:at + WIDTH]
    return texts, labels


# ---------------------------------------------------------------- the model

_SIZE = 100  # 0: beyond the text, 1: other characters, 2: digits, 3 and 4: blank and line end, then ASCII
_CODES = np.ones(0x250, np.int64)
_CODES[33:127] = np.arange(33, 127) - 28
_CODES[48:58] = 2
_CODES[[32, 9, 160]] = 3
_CODES[[10, 13]] = 4


def encode(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(points < len(_CODES), _CODES[np.minimum(points, len(_CODES) - 1)], 1)


#: Gates are piecewise linear sigmoids, SLOPE * z + 1/2 within 0 and 1.
SLOPE = 0.2


def _gate(z: np.ndarray) -> np.ndarray:
    return np.clip(SLOPE * z + 0.5, 0, 1)


def _gate_slope(s: np.ndarray) -> np.ndarray:
    return SLOPE * ((s > 0) & (s < 1))


class Tagger:
    """Bidirectional LSTM over character codes, linear emissions, CRF transitions."""

    def __init__(self, seed: int = 4):
        rng = np.random.default_rng(seed)
        k = len(KINDS) + 1
        init = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"E": init(_SIZE, EMBEDDING) * 5, "T": np.zeros((k, k), np.float32),
                  "O": init(2 * HIDDEN, k), "o": np.zeros(k, np.float32)}
        for d in "fb":
            self.p |= {f"X{d}": init(EMBEDDING, 4 * HIDDEN), f"H{d}": init(HIDDEN, 4 * HIDDEN),
                       f"c{d}": np.zeros(4 * HIDDEN, np.float32)}
            self.p[f"c{d}"][HIDDEN:2 * HIDDEN] = 1  # remember by default

    def _both(self, name: str) -> np.ndarray:
        return np.stack([self.p[f"{name}f"], self.p[f"{name}b"]])

    def _states(self, x: np.ndarray):
        """Hidden states (2, time, batch, HIDDEN) of inputs (2, time, batch, EMBEDDING), and what the way back needs."""
        _, steps, n, _ = x.shape
        gates = x @ self._both("X")[:, None] + self._both("c")[:, None, None]
        weights = self._both("H")
        h, c = np.zeros((2, n, HIDDEN), np.float32), np.zeros((2, n, HIDDEN), np.float32)
        states, trace = np.empty((2, steps, n, HIDDEN), np.float32), []
        for t in range(steps):
            z = gates[:, t] + h @ weights
            s = _gate(z[..., :3 * HIDDEN])
            i, f, o, g = s[..., :HIDDEN], s[..., HIDDEN:2 * HIDDEN], s[..., 2 * HIDDEN:], np.tanh(z[..., 3 * HIDDEN:])
            before, h_before = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            states[:, t] = h
            trace.append((i, f, o, g, before, tc, h_before))
        return states, trace

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        """(batch, time, labels) from (batch, time) codes."""
        return self._read(list(codes)).transpose(0, 2, 1)

    def _read(self, windows: list[np.ndarray]) -> np.ndarray:
        """Emissions (window, label, time) of windows of codes, the longest first. Features go by rows, and at each time only
        the windows that are long enough take part."""
        n, sizes = len(windows), np.array([len(w) for w in windows])
        steps, k = int(sizes[0]), len(self.p["o"])
        codes = np.zeros((n, steps), np.int64)
        for row, w in enumerate(windows):
            codes[row, :len(w)] = w
        live = np.searchsorted(-sizes, -np.arange(steps), side="left").tolist()
        zero, one = np.float32(0), np.float32(1)
        x = np.take(self.p["E"].astype(np.float32).T, codes.T, axis=1, mode="clip")  # (feature, time, window)
        read = np.empty((steps, k, n), np.float32)
        read[:] = self.p["o"][:, None]
        slope = np.repeat([SLOPE, 1], [3 * HIDDEN, HIDDEN])[:, None]
        for d, weights in (("f", self.p["O"][:HIDDEN]), ("b", self.p["O"][HIDDEN:])):
            full = slope * np.concatenate([self.p[f"H{d}"], self.p[f"X{d}"], self.p[f"c{d}"][None]]).T
            full[:3 * HIDDEN, -1] += 0.5
            full, weights = full.astype(np.float32), np.ascontiguousarray(weights.T, np.float32)
            emitted = np.empty((k, n), np.float32)
            states, cells, sums = np.ones((HIDDEN + EMBEDDING + 1, n), np.float32), np.zeros((HIDDEN, n), np.float32), \
                np.empty((4 * HIDDEN, n), np.float32)
            states[:HIDDEN] = 0
            m = 0
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                if live[t] != m:
                    m = live[t]
                    state, c, z = states[:, :m], cells[:, :m], sums[:, :m]
                    h, gates, i, f, o, g = (state[:HIDDEN], z[:3 * HIDDEN], z[:HIDDEN], z[HIDDEN:2 * HIDDEN],
                                            z[2 * HIDDEN:3 * HIDDEN], z[3 * HIDDEN:])
                    e = emitted[:, :m]
                state[HIDDEN:-1] = x[:, t, :m]
                np.matmul(full, state, out=z)
                np.maximum(gates, zero, out=gates)
                np.minimum(gates, one, out=gates)
                np.tanh(g, out=g)
                c *= f
                g *= i
                c += g
                np.multiply(o, np.tanh(c, out=h), out=h)
                read[t, :, :m] += np.matmul(weights, h, out=e)
        lines = np.empty((n, k, steps), np.float32)
        for t in range(0, steps, 32):  # a few steps at a time stay in the cache
            lines[..., t:t + 32] = read[t:t + 32].transpose(2, 1, 0)
        return lines

    def _crf(self, e: np.ndarray, y: np.ndarray):
        """Mean negative log-likelihood and its gradients for emissions (time, batch, labels), labels (time, batch)."""
        steps, n, k = e.shape
        trans = self.p["T"].astype(np.float64)
        lse = lambda v, axis: (m := v.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(
            np.exp(v - m).sum(axis=axis))
        alpha, beta = np.empty((steps, n, k)), np.zeros((steps, n, k))
        alpha[0] = e[0]
        for t in range(1, steps):
            alpha[t] = e[t] + lse(alpha[t - 1][:, :, None] + trans, 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = lse(trans + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        log_z = lse(alpha[-1], 1)
        rows = np.arange(n)
        gold = sum(e[t, rows, y[t]] for t in range(steps)) + sum(trans[y[t - 1], y[t]] for t in range(1, steps))
        de = np.exp(alpha + beta - log_z[None, :, None])
        dt = np.zeros((k, k))
        for t in range(1, steps):
            dt += np.exp(alpha[t - 1][:, :, None] + trans + (e[t] + beta[t])[:, None, :]
                         - log_z[:, None, None]).sum(axis=0)
            np.add.at(dt, (y[t - 1], y[t]), -1)
        for t in range(steps):
            de[t, rows, y[t]] -= 1
        return float((log_z - gold).mean()), (de / n).astype(np.float32), (dt / n).astype(np.float32)

    def _back(self, dh_all: np.ndarray, x: np.ndarray, trace: list, grads: dict) -> np.ndarray:
        weights = self._both("H")
        _, steps, n, _ = x.shape
        dz_all, d_weights = np.empty((2, steps, n, 4 * HIDDEN), np.float32), np.zeros_like(weights)
        dh, dc = np.zeros_like(dh_all[:, 0]), np.zeros_like(dh_all[:, 0])
        for t in range(steps - 1, -1, -1):
            i, f, o, g, before, tc, h_before = trace[t]
            dh = dh + dh_all[:, t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * _gate_slope(i), dc * before * _gate_slope(f), dh * tc * _gate_slope(o),
                                 dc * i * (1 - g * g)], axis=2).astype(np.float32)
            dz_all[:, t] = dz
            d_weights += h_before.transpose(0, 2, 1) @ dz
            dh, dc = dz @ weights.transpose(0, 2, 1), dc * f
        flat = dz_all.reshape(2, -1, 4 * HIDDEN)
        d_inputs = x.reshape(2, -1, EMBEDDING).transpose(0, 2, 1) @ flat
        for k, d in enumerate("fb"):
            grads[f"H{d}"], grads[f"X{d}"], grads[f"c{d}"] = d_weights[k], d_inputs[k], flat[k].sum(axis=0)
        return dz_all @ self._both("X").transpose(0, 2, 1)[:, None]

    def step(self, codes: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        codes, y = codes.T, y.T
        x = self.p["E"][codes]
        x = np.stack([x, x[::-1]])
        states, trace = self._states(x)
        both = np.concatenate([states[0], states[1, ::-1]], axis=2)
        loss, de, dt = self._crf((both @ self.p["O"] + self.p["o"]).astype(np.float64), y)
        grads = {"E": np.zeros_like(self.p["E"]), "T": dt, "O": both.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, de.shape[2]),
                 "o": de.sum(axis=(0, 1))}
        d_both = de @ self.p["O"].T
        dx = self._back(np.stack([d_both[:, :, :HIDDEN], d_both[::-1, :, HIDDEN:]]), x, trace, grads)
        np.add.at(grads["E"], codes, dx[0] + dx[1, ::-1])
        return loss, grads

    def train(self, codes: np.ndarray, y: np.ndarray, epochs: int, batch: int = 64, rate: float = 0.02,
              seed: int = 5) -> list[float]:
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses, done, total = [], 0, epochs * (len(codes) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(codes))
            for at in range(0, len(order) - batch + 1, batch):
                rows = order[at:at + batch]
                loss, grads = self.step(codes[rows], y[rows])
                losses.append(loss)
                done += 1
                size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                shrink = min(1.0, 5.0 / max(size, 1e-9))
                now = rate * (1 - 0.95 * done / total)
                for k, g in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g * shrink
                    second[k] = 0.98 * second[k] + 0.02 * (g * shrink) ** 2
                    self.p[k] = (self.p[k] - now * (first[k] / (1 - 0.9 ** done)) / (
                        np.sqrt(second[k] / (1 - 0.98 ** done)) + 1e-6)).astype(np.float32)
        return losses

    def paths(self, emissions: list[np.ndarray]) -> list[np.ndarray]:
        """Viterbi path of each stretch (time, labels), stretches of like length step by step together."""
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(emissions)
        trans = self.p["T"].astype(np.float64)[:, :, None]
        for i, e in enumerate(emissions):
            if len(e) > 4 * PIECE:
                out[i] = self._long_path(e)
        for rows, padded, sizes, live in _alike([e if len(e) <= 4 * PIECE else e[:0] for e in emissions]):
            none = padded[:, 0].sum(axis=0, dtype=np.float64) + (sizes - 1) * float(self.p["T"][0, 0])
            # Most stretches are "none" throughout: only those where another path is worth more are followed back.
            won = np.flatnonzero(self._best_scores(padded, live) > none + 1e-9)
            for j, i in enumerate(rows):
                out[i] = np.zeros(sizes[j], np.int64)
            if len(won):
                padded, sizes = padded[:sizes[won[0]], :, won].astype(np.float64), sizes[won]
                path = self._followed(padded, sizes)
                for j, at in enumerate(won):
                    out[rows[at]] = path[:sizes[j], j]
        return out

    def _best_scores(self, padded: np.ndarray, live: list[int]) -> np.ndarray:
        """The score of each stretch's best path."""
        trans = self.p["T"].astype(np.float64)[:, :, None]
        score = padded[0].astype(np.float64)
        for t in range(1, len(padded)):
            m = live[t]
            score[:, :m] = padded[t, :, :m] + (score[:, None, :m] + trans).max(axis=0)
        return score.max(axis=0)

    def _followed(self, padded: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The best paths (time, stretch)."""
        steps, k, n = padded.shape
        live = np.searchsorted(-sizes, -np.arange(steps), side="left").tolist()
        trans = self.p["T"].astype(np.float64)[:, :, None]
        back = np.empty((steps, k, n), np.int8)
        score = padded[0].copy()
        for t in range(1, steps):
            m = live[t]
            reach = score[:, None, :m] + trans
            back[t, :, :m] = reach.argmax(axis=0)
            score[:, :m] = padded[t, :, :m] + reach.max(axis=0)
        path = np.empty((steps, n), np.int64)
        label, every = score.argmax(axis=0), np.arange(n)
        for t in range(steps - 1, -1, -1):
            m = live[t]
            path[t, :m] = label[:m]
            if t:
                label[:m] = back[t, label[:m], every[:m]]
        return path

    def _long_path(self, e: np.ndarray) -> np.ndarray:
        """The Viterbi path of one long stretch: its pieces side by side, from every first label, then piece after piece."""
        trans = self.p["T"].astype(np.float64)
        k, pieces = e.shape[1], len(e) // PIECE
        cut = e[:pieces * PIECE].astype(np.float64).reshape(pieces, PIECE, k).transpose(1, 2, 0)  # (time, label, piece)
        score = np.where(np.eye(k, dtype=bool)[:, :, None], cut[0][:, None], -np.inf)  # (first label, last label, piece)
        back = np.empty((PIECE, k, k, pieces), np.int8)
        for t in range(1, PIECE):
            reach = score[:, :, None] + trans[None, :, :, None]
            back[t] = reach.argmax(axis=1)
            score = cut[t] + reach.max(axis=1)
        best, came = score[:, :, 0].max(axis=0), [(None, score[:, :, 0].argmax(axis=0))]
        for piece in range(1, pieces):
            enter = best[:, None] + trans  # (label before, first label)
            reach = enter.max(axis=0)[:, None] + score[:, :, piece]
            came.append((enter.argmax(axis=0), reach.argmax(axis=0)))
            best = reach.max(axis=0)
        rest, tail = e[pieces * PIECE:], []
        for now in rest:
            enter = best[:, None] + trans
            tail.append(enter.argmax(axis=0))
            best = now + enter.max(axis=0)
        path = np.empty(len(e), np.int64)
        label, at = int(best.argmax()), len(e) - 1
        for pointers in reversed(tail):
            path[at] = label
            label, at = int(pointers[label]), at - 1
        for piece in range(pieces - 1, -1, -1):
            before, firsts = came[piece]
            first = int(firsts[label])
            for t in range(PIECE - 1, -1, -1):
                path[at] = label
                at -= 1
                if t:
                    label = int(back[t, first, label, piece])
            if before is not None:
                label = int(before[first])
        return path


def _alike(parts: list[np.ndarray]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, list[int]]]:
    """Stretches (time, labels) in groups of like length: their places, (time, labels, stretch) filled up, their sizes, falling,
    and how many reach each time."""
    groups: dict[int, list[int]] = {}
    for i, e in enumerate(parts):
        if len(e):
            groups.setdefault(len(e).bit_length(), []).append(i)
    for _, rows in sorted(groups.items()):
        rows.sort(key=lambda i: -len(parts[i]))
        for at in range(0, len(rows), ROUND):
            some = rows[at:at + ROUND]
            sizes = np.array([len(parts[i]) for i in some])
            padded = np.zeros((sizes[0], parts[some[0]].shape[1], len(some)), parts[some[0]].dtype)
            for j, i in enumerate(some):
                padded[:sizes[j], :, j] = parts[i]
            yield some, padded, sizes, np.searchsorted(-sizes, -np.arange(sizes[0]), side="left").tolist()


@functools.lru_cache(maxsize=1)
def trained(examples: int = 14_000, epochs: int = 12) -> Tagger:
    """The model, trained once per process from seeded labelled spans; one text in six ends within its window."""
    rng = np.random.default_rng(3)
    texts, labels = _labelled(rng, examples)
    codes = np.stack([encode(t) for t in texts])
    ends = np.where(rng.random(examples) < 1 / 6, rng.integers(8, WIDTH, examples), WIDTH)
    beyond = np.arange(WIDTH) >= ends[:, None]
    codes[beyond], labels[beyond] = 0, 0
    tagger = Tagger()
    tagger.train(codes, labels, epochs)
    return tagger


# ---------------------------------------------------------------- reading texts

#: Windows that the model reads at once, and characters of the texts that are held as emissions at once.
ROUND, HELD = 1024, 1 << 21
#: Places of a piece of a long path, and on each side of a span those whose paths its probability considers.
PIECE, AROUND = 256, 80


def _blended(tagger: Tagger, parts: list[np.ndarray]) -> list[np.ndarray]:
    """Emissions (time, labels) of each text: its windows, each fading into the next where they overlap."""
    starts = np.cumsum([0, *map(len, parts)])
    whole = np.zeros((len(KINDS) + 1, starts[-1]), np.float32)
    step = READ - OVERLAP
    places = [(min(READ, len(codes) - at), row, at) for row, codes in enumerate(parts)
              for at in range(0, max(len(codes) - OVERLAP, min(len(codes), 1)), step)]
    places.sort(reverse=True)
    fade = ((np.arange(OVERLAP) + 0.5) / OVERLAP).astype(np.float32)
    for first in range(0, len(places), ROUND):
        some = places[first:first + ROUND]
        for (size, row, at), e in zip(some, tagger._read([parts[row][at:at + size] for size, row, at in some]), strict=True):
            if at:
                e[:, :OVERLAP] *= fade
            if at + step < len(parts[row]) - OVERLAP:
                e[:, step:READ] *= fade[::-1]
            whole[:, starts[row] + at:starts[row] + at + size] += e[:, :size]
    return [whole[:, a:b].T for a, b in zip(starts, starts[1:], strict=False)]


def _whole_paths(tagger: Tagger, emissions: list[np.ndarray]) -> list[tuple[np.ndarray, list[tuple[int, int]]]]:
    """`Tagger.paths` of whole texts, sooner, and the parts of each that were not "none" at first sight.

    A run of labels is worth at most what its places gain over "none", its entry and its exit. Where no run that holds
    a place is worth anything, every best path has "none" there, and the parts between are solved alone.
    """
    trans = tagger.p["T"].astype(np.float64)
    within, enter, leave = trans[1:, 1:].max(axis=0), trans[0, 1:], trans[1:, 0]
    ends = (enter - within).max() + (leave - trans[0, 0]).max()
    gain = (within - trans[0, 0]).astype(np.float32)[:, None]
    parts, owners = [], []
    out: list[tuple[np.ndarray, list[tuple[int, int]]]] = []
    for k, e in enumerate(emissions):
        out.append((np.zeros(len(e), np.int64), []))
        if not len(e):
            continue
        by_label = e.T
        worth = ((by_label[1:] + gain).max(axis=0) - by_label[0]).astype(np.float64)
        # A text's first place is not entered, its last one not left.
        worth[0] += max(0.0, (trans[0, 0] - enter).max())
        worth[-1] += max(0.0, (trans[0, 0] - leave).max())
        until = np.cumsum(worth)
        before = np.minimum.accumulate(until - worth)
        after = np.maximum.accumulate(until[::-1])[::-1]
        open_ = np.flatnonzero(after - before + ends > -1e-2)
        for run in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1) if len(open_) else ():
            a, b = max(0, int(run[0]) - 1), min(len(e), int(run[-1]) + 2)
            part = e[a:b].copy()
            for place in (a, b - 1):
                if not run[0] <= place <= run[-1]:
                    part[place - a, 1:] = -1e6
            parts.append(part)
            owners.append((k, a, b))
    for (k, a, b), path in zip(owners, tagger.paths(parts), strict=True):
        if path.any():
            out[k][0][a:b] = path
            out[k][1].append((a, b))
    return out


def _posteriors(tagger: Tagger, parts: list[np.ndarray]) -> list[np.ndarray]:
    """Probability of each label at each place (time, labels) of each stretch, all of its paths considered."""
    trans = tagger.p["T"].astype(np.float64)
    lse = lambda v, axis: (m := v.max(axis=axis)) + np.log(np.exp(v - np.expand_dims(m, axis)).sum(axis=axis))
    out: list[np.ndarray] = [np.empty((0, len(KINDS) + 1))] * len(parts)
    for rows, padded, sizes, live in _alike(parts):
        alpha, beta = padded.astype(np.float64), np.zeros(padded.shape)
        for t in range(1, len(alpha)):
            m = live[t]
            alpha[t, :, :m] += lse(alpha[t - 1, :, None, :m] + trans[:, :, None], 0)
        for t in range(len(alpha) - 2, -1, -1):
            m = live[t + 1]
            beta[t, :, :m] = lse(trans[:, :, None] + (padded[t + 1] + beta[t + 1])[None, :, :m], 1)
        both = alpha + beta
        both = np.exp(both - both.max(axis=1, keepdims=True))
        both /= both.sum(axis=1, keepdims=True)
        for j, i in enumerate(rows):
            out[i] = both[:sizes[j], :, j]
    return out


def _plausible(kind: str, text: str, left: int, right: int) -> bool:
    """The exact check of an added span of a text."""
    span = text[left:right]
    digits = "".join(c for c in span if c.isdigit())
    if kind == "email":
        # A spelled-out @ in brackets tells an address even of a host without a dot.
        user, *hosts = _AT.split(span)
        names = [*_DOT.split(hosts[0])] if len(hosts) == 1 else []
        bracketed = bool(re.search(r"[\[(]at[\])]", span, re.IGNORECASE))
        if " at " in span.lower() and re.search(r"\.\s|\s\.", span):
            return False  # a sentence's end
        return len(names) > (not bracketed) and all(re.fullmatch(r"\S+", part) for part in [user, *names])
    if kind == "ip":
        try:
            return ":" in span and len(digits) > 0 and bool(ipaddress.IPv6Address(span)) and span.count(":") + span.count("::") > 2
        except ValueError:
            return False
    if kind == "card":
        return bool(re.fullmatch(r"[0-9 .-]+", span)) and 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return bool(re.fullmatch(r"[+(]?[0-9][0-9 ().-]+[0-9]", span)) and 9 <= len(digits) <= 15 and len(digits) < len(span)
    if kind == "id":
        return bool(re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", span))
    before = text[max(0, left - 40):left]
    lead = _KEYED.match(span)
    lead = lead or next((m for m in _KEYED.finditer(before) if m.end() == len(before)), None)
    if lead:
        body = span[lead.end():] if lead.string == span else span
        # "The password is required" holds none.
        return bool(re.search(r"[0-9]" if re.search(r"\sis\s", lead[0]) else r"[^\s\"']", body))
    body = re.split(r"[=:\"' ]+", span.strip("\"'"))[-1]
    return len(body) >= 14 and bool(digits or _ISSUED.match(body)) and bool(re.search(r"[A-Za-z]", body))


def added_spans(tagger: Tagger, texts: list[str], base: list[list[tuple[str, int, int]]]) -> list[list[tuple[str, int, int]]]:
    """What the model adds to each text's base spans. Equal texts are read once, and texts in blocks, so that none is held
    whole as emissions."""
    first = {text: i for i, text in reversed(list(enumerate(texts)))}
    blocks = [(i, at) for text, i in first.items() for at in range(0, len(text), SEGMENT)]
    taken = [_Taken((a, b) for _, a, b in spans) for spans in base]
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    held: list[tuple[int, int]] = []
    size = 0
    for block in [*blocks, None]:
        if held and (block is None or size >= HELD):
            _add(tagger, texts, held, taken, out)
            held, size = [], 0
        if block:
            held.append(block)
            size += min(SEGMENT, len(texts[block[0]]) - block[1])
    return [sorted(out[first[text]], key=lambda s: (KINDS.index(s[0]), s[1])) for text in texts]


class _Taken:
    """Stretches of a text that spans hold, joined where they overlap, in order."""

    def __init__(self, spans):
        self.joined: list[tuple[int, int]] = []
        for a, b in sorted(spans):
            if self.joined and a < self.joined[-1][1]:
                a, last = self.joined.pop()
                b = max(b, last)
            self.joined.append((a, b))

    def touches(self, left: int, right: int) -> bool:
        k = bisect_left(self.joined, (right, -1)) - 1
        return k >= 0 and self.joined[k][1] > left

    def add(self, left: int, right: int) -> None:
        insort(self.joined, (left, right))


def _add(tagger: Tagger, texts: list[str], blocks: list[tuple[int, int]], taken: list[_Taken],
         out: list[list[tuple[str, int, int]]]) -> None:
    """Read blocks (text, start) and append the spans that are plausible and likely and touch no other."""
    froms = [max(0, at - MARGIN) for _, at in blocks]
    emissions = _blended(tagger, [encode(texts[i][start:at + SEGMENT + MARGIN])
                                  for (i, at), start in zip(blocks, froms, strict=True)])
    found, parts = [], []
    for (i, at), start, e, (path, runs) in zip(blocks, froms, emissions, _whole_paths(tagger, emissions), strict=True):
        for a, b in runs:
            spans = [s for s in _path_spans(texts[i], start + a, path[a:b])
                     if at <= s[1] < at + SEGMENT and not taken[i].touches(s[1], s[2]) and _plausible(s[0], texts[i], s[1], s[2])]
            for kind, left, right, label, first, last in spans:
                low = max(a, a + first - AROUND)
                found.append((i, kind, left, right, label, max(a + first, left - start) - low, min(a + last, right - start) - low))
                parts.append(e[low:min(b, a + last + AROUND)])
    for (i, kind, left, right, label, first, last), p in zip(found, _posteriors(tagger, parts), strict=True):
        if p[first:last, label].mean() >= LIKELY and not taken[i].touches(left, right):
            taken[i].add(left, right)
            out[i].append((kind, left, right))


def _path_spans(text: str, start: int, path: np.ndarray) -> Iterator[tuple[str, int, int, int, int, int]]:
    """(kind, left, right, label, a, b): the spans of a path from ``start`` on, fitted to words, and their places in the path."""
    cuts = np.flatnonzero(np.diff(path, prepend=-1, append=-1))
    for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
        label = int(path[a])
        if not label:
            continue
        left, right = start + a, start + b
        while left < right and (text[left].isspace() or text[left] in ",;|"):
            left += 1
        while right > left and (text[right - 1].isspace() or text[right - 1] in ",;|.!"):
            right -= 1
        while left > 0 and text[left - 1].isalnum() and left < right and text[left].isalnum():
            left -= 1
        while right < len(text) and text[right].isalnum() and left < right and text[right - 1].isalnum():
            right += 1
        kind = KINDS[label - 1]
        at = _AT.search(text, left, right) if kind == "email" else None
        if at:
            # Spelled-out addresses are made of words: the neighbours' are left out. Of several "at", the one before a host counts.
            spelled = next((m for m in _SPELLED.finditer(text, max(0, left - 40), right + 60)
                            if m.start() < right and left < m.end()), None)
            if spelled and "@" not in text[left:right]:
                left, right = spelled.span()
            else:
                left = max(left, 1 + max(text.rfind(c, left, at.start()) for c in " \n\t"))
                right = at.end() + len(_HOST.match(text[at.end():right])[0])
        if right > left and min(b, right - start) > max(a, left - start):
            yield kind, left, right, label, a, b


def spans_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


FOUND = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
         "n_added long")


def find(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """Counts, digest of the base spans and all spans of each row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger or trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            added = added_spans(shared.value, texts, base)
            counts = [pa.array([sum(s[0] == k for s in spans) for spans in base], pa.int64()) for k in BASE]
            digests = [hashlib.sha256(spans_text(spans).encode()).hexdigest() for spans in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *counts, pa.array(digests, pa.string()),
                 pa.array([spans_text(a + b) for a, b in zip(base, added, strict=True)], pa.string()),
                 pa.array([len(a) for a in added], pa.int64())],
                names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "n_added"])

    return docs.select("doc_id", "text").mapInArrow(run, FOUND)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind; of overlapping spans the joint stretch takes the first's kind."""
    out, done, until = [], 0, 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= until:
            out += [text[done:a], f"<{kind.upper()}>"]
        until = max(until, b)
        done = until
    return "".join(out) + text[done:]


def redact(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """``docs`` with all spans in ``text`` replaced by their kinds; ``n_chars``, if there, follows. Null stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger or trained())

    @F.pandas_udf("string")
    def clean(series: pd.Series) -> pd.Series:
        texts = [t or "" for t in series]
        base = [base_spans(t) for t in texts]
        added = added_spans(shared.value, texts, base)
        return pd.Series([None if t is None else masked(t, a + b) for t, a, b in zip(series, base, added, strict=True)],
                         dtype=object)

    columns = docs.columns
    docs = docs.withColumn("text", clean("text"))
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        docs = docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                               .otherwise(F.length("text")).cast(kind))
    return docs
