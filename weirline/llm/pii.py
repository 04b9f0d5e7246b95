"""Personal data: fixed patterns, and a linear-chain CRF over word shapes that adds spans.

The CRF is trained here from a small labelled table and decoded by Viterbi over padded numpy batches
of lines. Only words with a digit or an at sign may carry a label, so a line without either is
unlabelled whatever the weights, and needs no decoding.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pii_labels
from .common import saved

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)
HELD_WORDS, PADDED = 100_000, 200_000
BLOCK_ROWS, BLOCK_BYTES = 1000, 2 << 20

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin where a run of digits begins: the one before it ended with its own run
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[^0-9]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOLD = re.compile(r"[0-9@]")


def _emails(text: str):
    """Matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, found from their at signs."""
    end, at = 0, text.find("@")
    while at >= 0:
        m = DOMAIN.match(text, at + 1)
        if m:
            start = at
            while start > end and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                end = m.end()
                yield start, end
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind and start; code points, end exclusive."""
    if not text or not TOLD.search(text):
        return []
    out = [("email", a, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            d = DIGITS.sub("", m[0])
            if 16 <= len(d) <= 19 and luhn(d):
                out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= len(DIGITS.sub("", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def shape(word: str) -> str:
    """The word with letters as x or X, digits as 9, runs of the same cut to four; other characters stay."""
    kinds = re.sub(r"[^\W\d_]", lambda m: "X" if m[0].isupper() else "x", word)
    return re.sub(r"(.)\1{3,}", r"\1\1\1\1", re.sub(r"[0-9]", "9", kinds))


def features(word: str) -> list[str]:
    d = sum("0" <= c <= "9" for c in word)
    bare = word.strip("\"'.,;:!?()[]{}<>|*#$%&")
    return [
        "s=" + shape(word),
        "b=" + re.sub(r"(.)\1+", r"\1", shape(bare)),
        f"d={min(d, 20)}",
        f"n={min(len(bare), 20) if d or '@' in word else 0}",
        f"at={'@' in bare},{bare.count('.')}",
        f"w={bare.lower()}" if bare.isalpha() and len(bare) < 9 else "w=",
        f"plus={word[:1] == '+'},{'(' in word},{'-' in word}",
        f"sum={d >= 12 and bare.isascii() and bare.isdigit() and luhn(bare)}",
    ]


class Crf:
    """Weights of a linear chain: word features of the word and its neighbours, and label transitions."""

    def __init__(self, names: dict, weights: np.ndarray, moves: np.ndarray):
        self.names, self.weights, self.moves = names, weights, moves
        self.held: dict[str, np.ndarray] = {}

    def scores(self, word: str) -> np.ndarray:
        """What the word adds to the labels of the next word, its own and the one before; kept for words seen lately."""
        found = self.held.get(word)
        if found is None:
            if len(self.held) >= HELD_WORDS:
                self.held.clear()
            f = features(word)
            own = [[self.names[o, x] for x in f if (o, x) in self.names] for o in (-1, 0, 1)]
            found = self.held[word] = np.array([self.weights[i].sum(axis=0) for i in own])
        return found

    def indices(self, words: list[str]) -> list[list[int]]:
        """Feature numbers of each word; unknown features have none."""
        each = []
        for w in words:
            f = features(w)
            each.append([[self.names.get((o, x), -1) for x in f] for o in (-1, 0, 1)])
        edge = [[self.names.get((o, "edge"), -1)] for o in (-1, 0, 1)]
        out = []
        for k in range(len(words)):
            left = each[k - 1][0] if k else edge[0]
            right = each[k + 1][2] if k + 1 < len(words) else edge[2]
            out.append([i for i in left + each[k][1] + right if i >= 0])
        return out

    def emissions(self, words: list[str]) -> np.ndarray:
        each = np.array([self.scores(w) for w in words])
        e = each[:, 1].copy()
        e[1:] += each[:-1, 0]
        e[:-1] += each[1:, 2]
        e[0] += self.weights[self.names[-1, "edge"]]
        e[-1] += self.weights[self.names[1, "edge"]]
        e[[not TOLD.search(w) for w in words], 1:] = -np.inf
        return e

    def viterbi(self, lines: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of each line. Lines of like length are padded and decoded together, PADDED words at a time."""
        out: list = [None] * len(lines)
        order = sorted(range(len(lines)), key=lambda k: len(lines[k]))
        while order:
            take = max(1, PADDED // len(lines[order[-1]]))
            part, order = order[-take:], order[:-take]
            for k, labels in zip(part, self._decoded([lines[k] for k in part])):
                out[k] = labels
        return out

    def _decoded(self, lines: list[np.ndarray]) -> list[np.ndarray]:
        n = np.array([len(x) for x in lines])
        e = np.zeros((len(lines), n.max(), len(LABELS)))
        for k, x in enumerate(lines):
            e[k, : len(x)] = x
        best, back = e[:, 0], np.zeros(e.shape, np.int8)
        last = best.copy()
        for t in range(1, n.max()):
            paths = best[:, :, None] + self.moves[None]
            back[:, t] = paths.argmax(axis=1)
            best = paths.max(axis=1) + e[:, t]
            last = np.where((n > t)[:, None], best, last)
        # backwards over all lines at once; a line starts at its own end
        labels, now = np.zeros(e.shape[:2], np.int8), last.argmax(axis=1)
        rows = np.arange(len(lines))
        for t in range(n.max() - 1, -1, -1):
            labels[:, t] = now
            now = np.where((t < n) & (t > 0), back[rows, t, now], now)
        return [labels[k, : n[k]] for k in rows]


def _log_sum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(rows: list[tuple[list[str], list[int]]], steps: int = 40, rate: float = 0.3, decay: float = 1e-3) -> Crf:
    """Maximum likelihood by Adam; gradients from the forward-backward algorithm. The same rows give the same weights."""
    names: dict = {(-1, "edge"): 0, (0, "edge"): 1, (1, "edge"): 2}
    for words, _ in rows:
        for w in words:
            for f in features(w):
                for o in (-1, 0, 1):
                    names.setdefault((o, f), len(names))
    crf = Crf(names, np.zeros((len(names), len(LABELS))), np.zeros((len(LABELS), len(LABELS))))
    indexed = [(crf.indices(words), np.array(labels)) for words, labels in rows]
    m = [np.zeros_like(crf.weights), np.zeros_like(crf.moves)]
    v = [np.zeros_like(crf.weights), np.zeros_like(crf.moves)]
    for step in range(1, steps + 1):
        g = [-decay * crf.weights, -decay * crf.moves]
        for indices, labels in indexed:
            e = np.array([crf.weights[i].sum(axis=0) for i in indices])
            n = len(e)
            a, b = e.copy(), np.zeros_like(e)
            for t in range(1, n):
                a[t] += _log_sum(a[t - 1][:, None] + crf.moves, 0)
            for t in range(n - 2, -1, -1):
                b[t] = _log_sum(crf.moves + (e[t + 1] + b[t + 1])[None], 1)
            z = _log_sum(a[-1], 0)
            p = np.exp(a + b - z)
            target = -p
            target[np.arange(n), labels] += 1
            for t, i in enumerate(indices):
                g[0][i] += target[t]
            for t in range(1, n):
                both = np.exp(a[t - 1][:, None] + crf.moves + (e[t] + b[t])[None] - z)
                g[1] -= both
                g[1][labels[t - 1], labels[t]] += 1
        for k, w in enumerate((crf.weights, crf.moves)):
            x = g[k] / len(rows)
            m[k] = 0.9 * m[k] + 0.1 * x
            v[k] = 0.99 * v[k] + 0.01 * x * x
            w += rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return crf


def labelled_table(spark: SparkSession, rows: int = 100, seed: int = 7) -> DataFrame:
    """A small labelled table (words, labels): the lines of pii_labels, and invented ones with each kind in a few forms among
    plain words, and numbers that are nobody's data: years, amounts, versions, hashes, times, codes."""
    rng = np.random.default_rng(seed)

    def digits(n):
        return "".join(map(str, rng.integers(0, 10, n)))

    def word():
        return "".join(rng.choice(list("abcdefghilmnoprstuvé"), rng.integers(2, 10)))

    def card():
        d = digits(rng.choice([14, 15, 15, 15]))
        return next(d + c for c in "0123456789" if luhn(d + c))

    def bad():
        d = digits(15)
        return next(d + c for c in "0123456789" if not luhn(d + c))

    def one(kind):
        if kind == "email":
            dot = rng.choice([".", "_", ""])
            return [f"{word()}{dot}{digits(2)}@{word()}{rng.choice(['', digits(1)])}.{rng.choice(['com', 'org', 'example.com', 'net'])}"]
        if kind == "ip":
            return [".".join(str(x) for x in rng.integers(0, 256, 4))]
        if kind == "card":
            c = card()
            return [c] if rng.random() < 0.5 else [c[k : k + 4] for k in range(0, len(c), 4)]
        forms = [
            [f"+{rng.integers(1, 99)}", f"({digits(3)})", f"{digits(3)}-{digits(4)}"],
            [f"({digits(3)})", f"{digits(3)}-{digits(4)}"],
            [f"+{rng.integers(1, 99)}-{digits(3)}-{digits(3)}-{digits(4)}"],
        ]
        return forms[rng.integers(len(forms))]

    def other():
        hexes = hashlib.sha1(digits(6).encode()).hexdigest()
        forms = [
            ["token", "=", f'"{hexes}"'], [f"{rng.integers(1800, 2030)}"], [f"v{digits(1)}.{digits(1)}.{digits(1)}"],
            [f"${digits(3)}.{digits(2)}"], [f"{digits(2)}:{digits(2)}"], [f"20{digits(2)}-{digits(2)}-{digits(2)}"],
            [hexes[:12]], ["Version", "2.0."], [digits(6)], [f"#{digits(4)}"], [f"@{word()}"], [f"{digits(20)}"], [f"{digits(2)}%"],
            [bad()], [bad()], [f"{digits(1)}.{digits(2)}"], ["page", digits(3)], [f"{digits(2)}-{digits(2)}"], [f"{word()}{digits(2)}"],
        ]
        return forms[rng.integers(len(forms))]

    out = pii_labels.labelled(pii_labels.lines(), KINDS)
    for _ in range(rows):
        words, labels = [], []
        for _ in range(rng.integers(1, 4)):
            for _ in range(rng.integers(0, 5)):
                words.append(word() if rng.random() < 0.8 else word().capitalize() + rng.choice([".", ","]))
                labels.append(0)
            kind = rng.choice([*KINDS, "other", "other"])
            part = other() if kind == "other" else one(kind)
            end = rng.choice(["", "", ".", ",", "|", "!!", "***"])
            part = [*part[:-1], part[-1] + end]
            words += part
            labels += [LABELS.index(kind) if kind != "other" else 0] * len(part)
        out.append((words, labels))
    return spark.createDataFrame(out, "words array<string>, labels array<int>")


#: A part of an address: ASCII digits, of which four at most count. Other digits, such as superscripts, are none.
PART = re.compile("0*[0-9]{1,4}")


def _holds(kind: str, found: str) -> bool:
    """Whether what the CRF found can be of its kind at all."""
    d = DIGITS.sub("", found)
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 7 <= len(d) <= 15
    if kind == "email":
        return 0 < found.find("@") < len(found) - 1
    parts = found.split(".")
    return len(parts) == 4 and all(PART.fullmatch(p) and int(p[-4:]) <= 255 for p in parts)


MARKS = "\"'.,;:!?[]{}<>|*#$%&"


def _added(texts: list, bases: list, crf: Crf) -> list[list[tuple[str, int, int]]]:
    """For each text the spans that the CRF finds and no base span overlaps: runs of one label within a line, trimmed of
    outer marks. The lines of all the texts are decoded together."""
    lines = []
    for k, text in enumerate(texts):
        at = 0
        for line in text.split("\n") if text and TOLD.search(text) else ():
            if TOLD.search(line):
                lines.append((k, [(m.start() + at, m.end() + at) for m in WORD.finditer(line)]))
            at += len(line) + 1
    out: list = [[] for _ in texts]
    best = crf.viterbi([crf.emissions([texts[k][a:b] for a, b in found]) for k, found in lines])
    for (k, found), labels in zip(lines, best):
        told = np.flatnonzero(labels)
        for run in np.split(told, np.flatnonzero((np.diff(told) > 1) | (np.diff(labels[told]) != 0)) + 1):
            if len(run):
                a, b, kind = found[run[0]][0], found[run[-1]][1], LABELS[labels[run[0]]]
                inner = texts[k][a:b]
                a += len(inner) - len(inner.lstrip(MARKS))
                b -= len(inner) - len(inner.rstrip(MARKS + "("))
                if a < b and _holds(kind, texts[k][a:b]) and not any(a < y and x < b for _, x, y in bases[k]):
                    out[k].append((kind, a, b))
    return out


def _text(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(
    docs: DataFrame, labelled: DataFrame | None = None, most_labelled: int = 2000, id_col="doc_id", text_col="text"
) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for each row of ``docs``.

    The counts and the digest are of the base patterns; ``spans`` holds those and what the CRF adds
    where no base span lies, as kind:start:end in code points by kind and start. The CRF is fitted on at
    most ``most_labelled`` rows of ``labelled`` (words, labels), of more the first by a hash. Null and empty texts have no
    spans. Rows that repeat an id are read one by one; other columns are not read. An empty table
    gives no rows.
    """
    labelled = labelled_table(docs.sparkSession) if labelled is None else labelled
    some = labelled.select("words", "labels")
    if len(some.take(most_labelled + 1)) > most_labelled:  # the same ones each time
        some = some.orderBy(F.xxhash64("words"), "words", "labels").limit(most_labelled)
    rows = [(list(r[0]), list(r[1])) for r in some.collect()]
    held = docs.sparkSession.sparkContext.broadcast(train([r for r in rows if r[0]]))

    def run(batches):
        crf = held.value
        for whole in batches:
            step = max(1, min(BLOCK_ROWS, int(len(whole) * BLOCK_BYTES / max(1, whole.column(1).nbytes))))
            for at in range(0, len(whole), step):
                b = whole.slice(at, step)
                texts = b.column(1).to_pylist()
                bases = [base_spans(t) for t in texts]
                out = []
                for base, added in zip(bases, _added(texts, bases, crf)):
                    count = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                    both = sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
                    out.append((*count, hashlib.sha256(_text(base).encode()).hexdigest(), _text(both)))
                c = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), *(pa.array(x, pa.int64()) for x in c[:4]), *(pa.array(x, pa.string()) for x in c[4:])],
                    names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
                )

    found = docs.select(F.col(id_col).cast("long"), F.col(text_col).alias("text")).mapInArrow(
        run,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string",
    )
    return saved(found, "personal_data")
