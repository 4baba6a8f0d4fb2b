"""Personal data: exact patterns, and a character BiLSTM with CRF transitions that adds what they miss.

Four kinds (email, ip, card, phone) have exact patterns; those spans always stand.  The tagger learns from them:
windows of text around pattern matches, also with other letters and digits in their place and rewritten into forms that
the patterns don't cover (:func:`rewritten`: ``ann (at) mail dot org``, a card number grouped by dots, a phone number
without its country code), are labelled spans for a bidirectional LSTM over characters (cases of ASCII letters and all
digits alike) with a linear-chain CRF, trained here in numpy.

Tagging: every stretch of a text near what each kind needs (a digit, ``@`` or the word ``at``) is covered by overlapping
windows; each window is decoded (Viterbi), each character's tag comes from the window in which it lies deepest, and
tags become spans over the whole text.  Spans go that overlap a pattern's span, lack what all of their kind hold (digits
of a valid card, four numbers up to 255, ...), or whose posterior is below their kind's threshold, which windows held out of
training decide.

Fitting reads a bounded, documented sample (``FIT_WINDOWS`` windows, an equal share for each kind and for windows
without any, by hash); tagging reads every text once where it lies, without a shuffle.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from itertools import accumulate, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

KINDS = ["email", "ip", "card", "phone"]
WINDOW, STRIDE, REACH = 96, 64, 32
HIDDEN = 16
FIT_WINDOWS = 4_500
STEPS = 500
BATCH = 48
FORMS = 4             # rewritten windows of each span
PRECISION = 0.98      # of added spans on held-out windows
THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98)
TAGS = 1 + 2 * len(KINDS)     # outside, then begin and inside of each kind

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match always begins at the first digit of a run, as every part takes whole runs
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NEAR = re.compile(r"[0-9@]|\b[Aa][Tt]\b")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def patterns(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the exact patterns, in order of start, then kind."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:      # the local part is the run of its characters before the sign
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            # no number of over 3 digits, leading zeros aside, is at most 255
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGIT.findall(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def _classes() -> np.ndarray:
    """Class of each code point below 128; all others share one class."""
    out = np.zeros(128, dtype=np.int64)
    names: dict[str, int] = {}
    for c in range(128):
        ch = chr(c)
        name = "digit" if ch.isdigit() else ch.lower() if ch.isalpha() else "space" if ch.isspace() else ch if ch.isprintable() else "other"
        out[c] = names.setdefault(name, len(names))
    return out


CLASS = _classes()
N_CLASSES = int(CLASS.max()) + 3      # one for other characters, one for padding
OTHER, PAD = N_CLASSES - 2, N_CLASSES - 1


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = np.full(len(points), OTHER, dtype=np.int64)
    ascii_ = points < 128
    out[ascii_] = CLASS[points[ascii_]]
    return out


def _sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * x))


class Tagger:
    """BiLSTM (input gates are looked up by character class) with a linear-chain CRF on top."""

    def __init__(self, seed: int = 5):
        r, h = np.random.default_rng(seed), HIDDEN
        self.p: dict[str, np.ndarray] = {}
        for d in "fb":
            self.p[f"x{d}"] = r.normal(0, 0.3, (N_CLASSES, 4 * h))
            self.p[f"x{d}"][:, h:2 * h] += 1.0     # forget gates begin open
            self.p[f"u{d}"] = r.normal(0, 0.3, (h, 4 * h))
        self.p["o"] = r.normal(0, 0.3, (2 * h, TAGS))
        self.p["c"] = np.zeros(TAGS)
        self.p["t"] = np.zeros((TAGS, TAGS))
        self.threshold = [THRESHOLDS[-1]] * len(KINDS)

    def _run(self, d: str, x: np.ndarray, keep: bool):
        """Hidden states (length, n, HIDDEN) of one direction, and what its gradient needs."""
        n, length = x.shape
        h, c, size = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN)), HIDDEN
        states, saved = np.zeros((length, n, size)), []
        for t in (range(length) if d == "f" else range(length - 1, -1, -1)):
            gates = self.p[f"x{d}"][x[:, t]] + h @ self.p[f"u{d}"]
            i, f, o = (_sigmoid(gates[:, k * size:(k + 1) * size]) for k in range(3))
            g = np.tanh(gates[:, 3 * size:])
            before, c_new = (h, c), f * c + i * g
            tc = np.tanh(c_new)
            h, c = o * tc, c_new
            states[t] = h
            if keep:
                saved.append((t, i, f, o, g, tc, *before))
        return states, saved

    def emissions(self, x: np.ndarray, keep: bool = False):
        (hf, sf), (hb, sb) = self._run("f", x, keep), self._run("b", x, keep)
        both = np.concatenate([hf, hb], axis=2)
        return both @ self.p["o"] + self.p["c"], (both, sf, sb)

    def marginals(self, e: np.ndarray, mask: np.ndarray):
        """Forward and backward sums and the log partition.  mask: (length, n)."""
        length, n, _ = e.shape
        t = self.p["t"]
        a, b = np.zeros_like(e), np.zeros_like(e)
        a[0] = e[0]
        for k in range(1, length):
            s = a[k - 1][:, :, None] + t
            top = s.max(1)
            new = top + np.log(np.exp(s - top[:, None]).sum(1)) + e[k]
            a[k] = np.where(mask[k][:, None], new, a[k - 1])
        for k in range(length - 2, -1, -1):
            s = t + (e[k + 1] + b[k + 1])[:, None, :]
            top = s.max(2)
            new = top + np.log(np.exp(s - top[:, :, None]).sum(2))
            b[k] = np.where(mask[k + 1][:, None], new, b[k + 1])
        top = a[-1].max(1)
        z = top + np.log(np.exp(a[-1] - top[:, None]).sum(1))
        return a, b, z

    def decode(self, x: np.ndarray, lengths: np.ndarray):
        """Best tags and the posterior of each, for windows (n, WINDOW) with their own lengths."""
        e, _ = self.emissions(x)
        mask = np.arange(x.shape[1])[:, None] < lengths
        a, b, z = self.marginals(e, mask)
        n = x.shape[0]
        best, back = e[0], np.zeros(e.shape, dtype=np.int8)
        for k in range(1, len(e)):
            s = best[:, :, None] + self.p["t"]
            back[k] = np.where(mask[k][:, None], s.argmax(1), np.arange(TAGS))
            best = np.where(mask[k][:, None], s.max(1) + e[k], best)
        tags = np.zeros((n, len(e)), dtype=np.int64)
        tags[:, -1] = best.argmax(1)
        for k in range(len(e) - 1, 0, -1):
            tags[:, k - 1] = back[k][np.arange(n), tags[:, k]]
        post = np.exp(np.clip(a + b - z[:, None], -50, 0)).transpose(1, 0, 2)
        return tags, np.take_along_axis(post, tags[:, :, None], 2)[:, :, 0]

    def gradient(self, x: np.ndarray, y: np.ndarray, lengths: np.ndarray):
        e, (both, sf, sb) = self.emissions(x, keep=True)
        length, n, _ = e.shape
        mask = np.arange(length)[:, None] < lengths
        a, b, z = self.marginals(e, mask)
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        de = np.exp(a + b - z[:, None]) * mask[:, :, None]
        rows = np.arange(n)
        for k in range(length):
            de[k][rows[mask[k]], y[mask[k], k]] -= 1.0
            if k:
                m = mask[k]
                pair = np.exp((a[k - 1][:, :, None] + self.p["t"] + (e[k] + b[k])[:, None, :] - z[:, None, None])[m])
                grad["t"] += pair.sum(0)
                grad["t"] -= np.bincount(y[m, k - 1] * TAGS + y[m, k], minlength=TAGS * TAGS).reshape(TAGS, TAGS)
        grad["o"] = np.einsum("lnh,lnt->ht", both, de)
        grad["c"] = de.sum((0, 1))
        dh_all = de @ self.p["o"].T
        for d, saved, part in (("f", sf, dh_all[:, :, :HIDDEN]), ("b", sb, dh_all[:, :, HIDDEN:])):
            dh, dc = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
            steps = np.zeros((length, n, 4 * HIDDEN))
            for t, i, f, o, g, tc, h0, c0 in reversed(saved):
                dh = dh + part[t]
                dc = dc + dh * o * (1 - tc * tc)
                dg = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o),
                                     dc * i * (1 - g * g)], axis=1)
                steps[t] = dg
                grad[f"u{d}"] += h0.T @ dg
                dh, dc = dg @ self.p[f"u{d}"].T, dc * f
            which = np.eye(N_CLASSES)[x.T.ravel()]
            grad[f"x{d}"] = which.T @ steps.reshape(length * n, -1)
        return grad

    def fit(self, x: np.ndarray, y: np.ndarray, lengths: np.ndarray, steps: int = STEPS, seed: int = 6) -> None:
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        for step in range(1, steps + 1):
            at = r.integers(0, len(x), BATCH)
            grad = self.gradient(x[at], y[at], lengths[at])
            rate = 0.04 * (1.0 - step / (steps + 1)) ** 0.5
            for k, g in grad.items():
                g = g / BATCH
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6)


class Overlaps:
    """Does a stretch touch one of many spans?  Two lookups, however many there are."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        spans = sorted(spans)
        self.starts = [s for s, _, _ in spans]
        self.ends = list(accumulate((e for _, _, e in spans), max, initial=0))

    def touch(self, start: int, end: int) -> bool:
        return self.ends[bisect_left(self.starts, end)] > start


def varied(kind: int, value: str, r: random.Random) -> str:
    """Another value of a span's kind: an address of other words, a number with other digits in the same places."""
    if kind == 0:
        word = lambda low, high: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(low, high)))
        number = lambda: str(r.randrange(10 ** r.randint(1, 3))) if r.random() < 0.5 else ""
        user = r.choice(["", word(1, 8) + r.choice("._-+")]) + word(1, 9) + r.choice(["", r.choice("._")]) + number()
        host = word(2, 9) + number() + r.choice(["", "-" + word(2, 6), "." + word(2, 8), "." + word(2, 8)])
        return f"{user.rstrip('._')}@{host}.{r.choice(['com', 'org', 'net', 'edu', 'de', 'fr', 'io', word(2, 3)])}"
    if kind == 1:
        return ".".join(str(r.randrange(256)) for _ in range(4))
    out = "".join(r.choice("0123456789") if c.isdigit() else c for c in value)
    if kind == 2:       # the last digit is the check digit
        head = out[:-1]
        digits = re.sub(r"[^0-9]", "", head)
        out = head + next(d for d in "0123456789" if luhn(digits + d))
    return out


def rewritten(kind: int, value: str, r: random.Random) -> str:
    """A span's value in one of the forms that the patterns don't cover."""
    if kind == 0:
        user, _, host = value.partition("@")
        at = r.choice([" (at) ", " [at] ", "(at)", "[at]", " at ", " AT ", " @ ", " {at} "])
        dot = r.choice([" dot ", " (dot) ", "[dot]", " DOT ", " . "] + ["."] * (at not in (" at ", " AT ")))
        return user + at + host.replace(".", dot)
    if kind == 1:
        return r.choice([" . ", "[.]", "-", "(.)", " dot ", ","]).join(value.split("."))
    digits = re.sub(r"[^0-9]", "", value)
    if kind == 2:
        return r.choice([".", "/", "_", "  ", " - "]).join(digits[i:i + 4] for i in range(0, len(digits), 4))
    own = digits[-10:]
    return r.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}", "({}){}-{}", "{}/{}-{}"]).format(own[:3], own[3:6], own[6:])


def plain_number(r: random.Random) -> str:
    """A number, a date or words with ``at`` that are no personal data."""
    n = r.randrange
    return r.choice([f"{n(1990, 2040)}-{n(1, 13):02d}-{n(1, 29):02d}", f"{n(24)}:{n(60):02d}:{n(60):02d}", f"{n(10)}.{n(30)}.{n(9)}",
                     f"{n(1, 999)},{n(1000):03d},{n(1000):03d}", str(n(10 ** n(1, 13))), f"{n(1000)}.{n(100):02d}",
                     f"{n(1990, 2030)}-{n(2030, 2060)}", f"at {n(13)}.{n(60):02d}", "at home", "look at that dot", "at last. then",
                     f"{n(1, 29):02d}.{n(1, 13):02d}.{n(1990, 2040)} {n(24)}:{n(60):02d}", f"v{n(10)}.{n(10)}.{n(10)}-{n(100)}"])


def examples(text: str, turn: int) -> list[tuple[int, str, str]]:
    """Labelled windows (kind, text, tags as letters) around a text's pattern spans: each as it is, and with varied values
    in their own and in rewritten forms; and windows (kind ``len(KINDS)``) without personal data."""
    r = random.Random(turn)
    spans = patterns(text)
    ends = list(accumulate((e for _, _, e in spans), max, initial=0))
    plain = [(s, kind, e) for i, (s, kind, e) in enumerate(spans)
             if ends[i] <= s and (i + 1 == len(spans) or spans[i + 1][0] >= e)]
    out = []

    def window(kind: int, left: str, form: str, right: str) -> None:
        left, right = left[r.randrange(len(left) + 1) // 2:], right[:len(right) - r.randrange(len(right) + 1) // 2]
        if form and len(left) + len(form) + len(right) <= WINDOW:
            inner = str(1 + 2 * kind) + str(2 + 2 * kind) * (len(form) - 1) if kind < len(KINDS) else "0" * len(form)
            out.append((kind, left + form + right, "0" * len(left) + inner + "0" * len(right)))

    far = Overlaps([(s - WINDOW, kind, e + WINDOW) for s, kind, e in spans])
    for k, (s, kind, e) in enumerate(plain):
        value, left, right = text[s:e], text[max(0, s - REACH):s], text[e:e + REACH]
        if (k and plain[k - 1][2] > s - REACH) or (k + 1 < len(plain) and plain[k + 1][0] < e + REACH):
            left = right = " "      # a neighbour would be cut in its middle
        window(kind, left, value, right)
        for _ in range(FORMS * (1 + 2 * (kind == 0))):      # addresses have the most forms
            window(kind, left, rewritten(kind, varied(kind, value, r), r), right)
        window(kind, left, varied(kind, value, r), right)
        for _ in range(2):
            window(len(KINDS), left, plain_number(r), right)
    # windows as tagging meets them, around what could be personal data and is not
    for m in islice((m for m in _NEAR.finditer(text) if not far.touch(m.start(), m.end())), 4):
        window(len(KINDS), text[max(0, m.start() - REACH):m.start()], m.group(), text[m.end():m.end() + REACH])
    return out


def _windows(batches):
    for pdf in batches:
        rows = []
        for at, text in zip(pdf["at"], pdf["text"], strict=True):
            for k, (kind, part, tags) in enumerate(examples(text, at)):
                rows.append((int.from_bytes(hashlib.blake2b(f"{at}:{k}".encode(), digest_size=7).digest()), kind, part, tags))
        yield pd.DataFrame(rows, columns=["at", "kind", "part", "tags"]).astype({"at": "int64", "kind": "int32"})


def _train(batches):
    rows = sorted(r for pdf in batches for r in pdf.itertuples(index=False, name=None))
    if not rows:
        return
    x = np.full((len(rows), WINDOW), PAD, dtype=np.int64)
    y = np.zeros((len(rows), WINDOW), dtype=np.int64)
    lengths = np.array([len(part) for _, part, _ in rows])
    for i, (_, part, tags) in enumerate(rows):
        x[i, :len(part)] = codes(part)
        y[i, :len(part)] = [int(t) for t in tags]
    model = Tagger()
    held = np.arange(len(rows)) % 5 == 0        # rows are in order of a hash
    model.fit(x[~held] if len(rows) >= 5 else x, y[~held] if len(rows) >= 5 else y, lengths[~held] if len(rows) >= 5 else lengths)
    model.p["threshold"] = np.array(thresholds(model, [(part, tags) for (_, part, tags), h in zip(rows, held) if h]))
    yield pd.DataFrame([(k, list(v.shape), v.astype(np.float32).tobytes()) for k, v in model.p.items()],
                       columns=["name", "shape", "value"])


def thresholds(model: Tagger, held: list[tuple[str, str]]) -> list[float]:
    """For each kind the smallest posterior at which added spans of held-out windows are right often enough: of the
    labelled kind, and more than half of them and of the labelled span in common."""
    found: list[list[tuple[float, bool]]] = [[] for _ in KINDS]
    for (_, tags), spans in zip(held, proposed(model, [p for p, _ in held]), strict=True):
        first, last = next((i for i, t in enumerate(tags) if t != "0"), 0), len(tags.rstrip("0"))
        for s, kind, e, sure in spans:
            right = last > first and kind == (int(tags[first]) - 1) // 2 and 2 * (min(e, last) - max(s, first)) > max(e - s, last - first)
            found[kind].append((sure, right))

    def enough(kind: int, at: float) -> bool:
        right = [ok for sure, ok in found[kind] if sure >= at]
        return sum(right) >= PRECISION * len(right)

    return [next((at for at in THRESHOLDS if enough(kind, at)), THRESHOLDS[-1]) for kind in range(len(KINDS))]


def fit(docs: DataFrame, text: str = "text", fit_windows: int = FIT_WINDOWS) -> Tagger | None:
    """A tagger from at most ``fit_windows`` windows; None if no text holds a labelled span.

    Windows of one text are spread by hash, and equal texts give one window set: distinct windows only.
    """
    found = (docs.where(F.col(text).rlike(_NEAR.pattern))
             .select(F.xxhash64(F.lit(11), text).alias("at"), F.col(text).alias("text"))
             .mapInPandas(_windows, "at bigint, kind int, part string, tags string"))
    # equal texts give equal windows; the share of each kind is cut in every task first
    place = F.row_number().over(W.partitionBy("kind").orderBy("at"))
    sample = (found.dropDuplicates(["at"]).withColumn("place", place)
              .where(F.col("place") <= fit_windows // (len(KINDS) + 1)).select("at", "part", "tags"))
    if not sample.where(F.col("tags").rlike("[1-9]")).head(1):
        return None
    rows = sample.repartition(1).mapInPandas(_train, "name string, shape array<int>, value binary").collect()
    if not rows:
        return None
    model = Tagger()
    model.p = {r.name: np.frombuffer(r.value, dtype=np.float32).reshape(r["shape"]).astype(float) for r in rows}
    model.threshold = model.p.pop("threshold").tolist()
    return model


def cover(text: str) -> list[tuple[int, int]]:
    """Overlapping windows over every stretch of the text near a digit, ``@`` or the word ``at``."""
    stretches: list[list[int]] = []
    for m in _NEAR.finditer(text):
        s, e = max(0, m.start() - REACH), min(len(text), m.start() + REACH)
        if stretches and s <= stretches[-1][1]:
            stretches[-1][1] = e
        else:
            stretches.append([s, e])
    out = []
    for s, e in stretches:
        while True:
            out.append((s, min(e, s + WINDOW)))
            if s + WINDOW >= e:
                break
            s += STRIDE
    return out


def reconcile(windows, tags, posts) -> list[tuple[int, int, int, float]]:
    """Spans (start, kind, end, confidence) over the whole text: each character's tag comes from the window in which
    it lies deepest, so a span cut by one window's edge is read from its neighbours."""
    deep: dict[int, tuple[int, int, float]] = {}
    for (s, e), tag, post in zip(windows, tags, posts, strict=True):
        for i in range(e - s):
            d = min(i, e - s - 1 - i)
            if s + i not in deep or d > deep[s + i][0]:
                deep[s + i] = (d, int(tag[i]), float(post[i]))
    out, now = [], None
    for at in sorted(deep):
        _, tag, post = deep[at]
        kind = (tag - 1) // 2
        if now and now[2] == at and tag and tag % 2 == 0 and kind == now[1]:
            now[2], now[3] = at + 1, min(now[3], post)
            continue
        if now:
            out.append(tuple(now))
        now = [at, kind, at + 1, post] if tag % 2 == 1 else None
    if now:
        out.append(tuple(now))
    return out


_DOT = re.compile(r"[.]|\bdot\b", re.IGNORECASE)
_AT = re.compile(r"@|\bat\b", re.IGNORECASE)
_NUMBER = re.compile(r"[0-9]+")


def _likely(kind: int, part: str) -> bool:
    """What every span of a kind holds; a tagger's span without it is noise."""
    numbers = _NUMBER.findall(part)
    digits = "".join(numbers)
    if kind == 0:
        return bool(_AT.search(part) and _DOT.search(part)) and part[0].isalnum() and part[-1].isalnum()
    if kind == 1:
        return len(numbers) == 4 and all(len(n) <= 3 and int(n) <= 255 for n in numbers)
    return 14 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 10 <= len(digits) <= 15


def proposed(model: Tagger, texts: list[str | None], batch: int = 256) -> list[list[tuple[int, int, int, float]]]:
    """Spans (start, kind, end, confidence) that the tagger sees in each text, of any confidence."""
    places = [(k, w) for k, t in enumerate(texts) if t for w in cover(t)]
    read: dict[int, list] = {}
    for at in range(0, len(places), batch):
        part = places[at:at + batch]
        x = np.full((len(part), WINDOW), PAD, dtype=np.int64)
        for i, (k, (s, e)) in enumerate(part):
            x[i, :e - s] = codes(texts[k][s:e])
        tags, posts = model.decode(x, np.array([e - s for _, (s, e) in part]))
        for i, (k, w) in enumerate(part):
            # a window without a tag still outvotes its neighbours' edges
            read.setdefault(k, []).append((w, tags[i], posts[i]))
    out: list[list] = [[] for _ in texts]
    for k, seen in read.items():
        if any(t.any() for _, t, _ in seen):
            out[k] = [x for x in reconcile(*zip(*seen, strict=True)) if _likely(x[1], texts[k][x[0]:x[2]])]
    return out


def tag(model: Tagger | None, texts: list[str | None], batch: int = 256) -> list[tuple[list, list]]:
    """(pattern spans, added spans) of each text."""
    base = [patterns(t) if t else [] for t in texts]
    if model is None:
        return [(b, []) for b in base]
    out = []
    for spans, found in zip(base, proposed(model, texts, batch), strict=True):
        known = Overlaps(spans)
        out.append((spans, [(s, kind, e) for s, kind, e, sure in found if sure >= model.threshold[kind] and not known.touch(s, e)]))
    return out


def _find(model):
    def run(batches):
        for pdf in batches:
            rows = []
            for base, added in tag(model, list(pdf["text"])):
                counts = [sum(k == kind for _, k, _ in base) for kind in range(len(KINDS))]
                rows.append((*counts, len(added), hashlib.sha256(listed(base).encode()).hexdigest(),
                             listed(base + added)))
            found = pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "n_added", "base_sha256",
                                                "spans"])
            yield pd.concat([pdf[["key"]], found], axis=1)
    return run


def find(docs: DataFrame, model: Tagger | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_email, n_ip, n_card, n_phone (pattern spans), n_added (the tagger's), base_sha256, spans.

    A null or empty text has no spans (and the hash of an empty list); repeated rows and null ids stay.  Offsets are
    code points, ends exclusive.
    """
    kind = dict(docs.dtypes)[key]
    out = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInPandas(
        _find(model), "key string, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, n_added bigint, "
        "base_sha256 string, spans string")
    return out.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one, under the first's kind."""
    out, at = [], 0
    for s, kind, e in sorted(spans):
        if s >= at:
            out += [text[at:s], f"[{KINDS[kind].upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def redactor(model: Tagger | None):
    """Column function: the text with personal data replaced (null stays null)."""
    @F.pandas_udf("string")
    def redact(texts: pd.Series) -> pd.Series:
        found = tag(model, list(texts))
        return pd.Series([t if not t else redacted(t, a + b) for t, (a, b) in zip(texts, found, strict=True)])

    return redact
