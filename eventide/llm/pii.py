"""Personal data: fixed patterns, extended by a skip-chain conditional random field.

``base_spans`` finds the four base kinds, leftmost and non-overlapping per kind:

    email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
    ip     [0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+), parts at most 255
    card   [0-9]([ -]?[0-9])+, 13 to 19 digits passing Luhn
    phone  \\+[0-9][ ().0-9-]+[0-9], 9 to 15 digits

The field (Sutton and McCallum, 2004) labels *mentions*: runs of digits with
separators (at least ``MIN_DIGITS`` digits) and tokens with an @ or a spelled
one.  Linear edges join neighbouring mentions; skip edges join all mentions with
one key, however distant: an address's letters and digits in lower case, or the
last ``SUFFIX`` digits of a number (all, if it has fewer), so that a number
meets its forms with other prefixes.  A key's mentions all share an edge with
one of them, an observed one if there is any, so that evidence reaches each in
two steps.  Shape, length and the word before give the node potentials.
Mentions that a base pattern covers are observed.  Damped loopy sum-product
messages, sent until they no longer change (at most ``SWEEPS`` times), make the
labels of similar mentions agree; a free mention whose marginal for a kind
reaches ``CERTAIN`` becomes a span of that kind, whether or not the text has a
base span.  Documents without any free mention are not looked at further.

``fit`` learns node, edge and skip weights by maximum pseudo-likelihood with the
base patterns as labels, from a bounded sample: the first ``PART_CHARS`` characters
around the mentions of the ``SAMPLE`` documents with the smallest hash of id and text.
The learned skip weights get a fixed ``AGREE`` for equal labels on top: patterns label
every repeat alike, so the sample can't teach how strongly similar mentions agree.
Labelling itself (``report``, ``redact``) reads every whole text.

Defined cases: null is an empty text with no spans; positions are code points,
ends exclusive; equal texts get equal spans; a field with nothing to learn
adds nothing.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .staging import free_name

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)  # the label of a mention that is no personal data
MIN_DIGITS, SUFFIX, CERTAIN, SWEEPS = 7, 9, 0.9, 200
SAMPLE, PART_CHARS, AGREE = 2000, 4000, 6.0

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# the look-behinds change nothing but the time: a match can't begin inside a run of digits
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, from each @ outwards: linear in the text."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_SET:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[Span]:
    out: list[Span] = []
    if "@" in text:
        out += [(0, a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                    out.append((1, *m.span()))
        for m in _CARD.finditer(text):
            d = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(d) <= 19 and luhn(d):
                out.append((2, *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                    out.append((3, *m.span()))
    return out


# ---- the field ----

_NUMBER = re.compile(r"(?<![0-9+(])[+(]{0,2}[0-9](?:[ ().,/_-]{0,2}[0-9])+")
_ADDRESS = re.compile(r"(?:\(at\)|\[at\])", re.I)
_RUN = re.compile(r"\S*")
_EDGE = " \t\r\n,;:!?\"'()[]{}<>."
N_FEATURES = 64


class Mentions:
    """The field of one text: spans, keys, features, observed labels, skip edges."""

    def __init__(self, text: str, base: list[Span]):
        spans = [m.span() for m in _NUMBER.finditer(text) if len(_DIGIT.findall(m.group())) >= MIN_DIGITS] \
            if _DIGIT.search(text) else []
        marks = {m.start() for m in _ADDRESS.finditer(text)} if "at" in text.lower() else set()
        at = text.find("@")
        while at >= 0:
            marks.add(at)
            at = text.find("@", at + 1)
        marks, end = sorted(marks), 0
        for i, p in enumerate(marks):
            if p < end:  # in the run of the mark before: each run is walked once
                continue
            a = p
            while a > end and not text[a - 1].isspace():
                a -= 1
            b = end = _RUN.match(text, p).end()
            while a < b and text[a] in _EDGE:
                a += 1
            while b > a and text[b - 1] in _EDGE:
                b -= 1
            j = bisect_left(marks, a)
            if j < len(marks) and marks[j] < b:
                spans.append((a, b))
        self.spans = sorted(set(spans))
        base = sorted((a, b, k) for k, a, b in base)
        self.observed, i = [], 0
        for a, b in self.spans:
            while i < len(base) and base[i][1] <= a:
                i += 1
            label = -1
            if i < len(base) and base[i][0] < b and a < base[i][1]:
                label = base[i][2]
            self.observed.append(label)
        self.keys = [key(text[a:b]) for a, b in self.spans]
        self.features = [features(text, a, b) for a, b in self.spans]
        alike: dict[str, list[int]] = {}
        self.skips = []
        for j, k in enumerate(self.keys):
            if k:
                alike.setdefault(k, []).append(j)
        for same in alike.values():
            hub = next((j for j in same if self.observed[j] >= 0), same[0])
            self.skips += [(min(j, hub), max(j, hub)) for j in same if j != hub]


def key(mention: str) -> str:
    """What makes two mentions alike: an address's letters and digits, or a number's last digits."""
    low = _ADDRESS.sub("@", mention.lower())
    if "@" in low:
        return "".join(c for c in low if c.isalnum())
    return "".join(_DIGIT.findall(mention))[-SUFFIX:]


def features(text: str, a: int, b: int) -> list[int]:
    """Indices of a mention's features: shape, digits, and the word before it, hashed."""
    s = text[a:b]
    digits = len(_DIGIT.findall(s))
    shape = [0, 1 + min(digits, 20)]
    shape += [22 + i for i, c in enumerate("@+-. (/") if c in s]
    if digits and "@" not in s and 13 <= digits <= 19 and luhn("".join(_DIGIT.findall(s))):
        shape.append(30)
    before = text[max(0, a - 40):a].split()
    word = before[-1].strip(_EDGE).lower() if before else ""
    shape.append(32 + int.from_bytes(hashlib.blake2b(word.encode(), digest_size=2).digest(), "big") % 32)
    return shape


class Weights:
    """node: features x labels; edge and skip: labels x labels (symmetric log potentials)."""

    def __init__(self, node: np.ndarray, edge: np.ndarray, skip: np.ndarray):
        self.node, self.edge, self.skip = node, edge, skip


def marginals(m: Mentions, w: Weights, sweeps: int = SWEEPS) -> np.ndarray:
    """Loopy sum-product: mentions x labels."""
    n, k = len(m.spans), NONE + 1
    unary = np.array([w.node[f].sum(axis=0) for f in m.features])
    for i, o in enumerate(m.observed):
        if o >= 0:
            unary[i] = -1e3
            unary[i, o] = 0.0
    links = [(i, i + 1, w.edge) for i in range(n - 1)] + [(a, b, w.skip) for a, b in m.skips]
    if not links:
        return _softmax(unary)
    a = np.array([x[0] for x in links] + [x[1] for x in links])
    b = np.array([x[1] for x in links] + [x[0] for x in links])
    pot = np.array([x[2] for x in links] + [x[2].T for x in links])
    back = np.concatenate((np.arange(len(links), 2 * len(links)), np.arange(len(links))))
    msg = np.zeros((len(a), k))
    belief = unary.copy()
    for _ in range(sweeps):
        out = belief[a] - msg[back]
        top = (out[:, :, None] + pot)
        high = top.max(axis=1)
        new = high + np.log(np.exp(top - high[:, None, :]).sum(axis=1))
        new -= new.max(axis=1, keepdims=True)
        done = np.abs(new - msg).max() < 1e-4
        msg = (msg + new) / 2
        belief = unary.copy()
        np.add.at(belief, b, msg)
        if done:
            break
    return _softmax(belief)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def learn(fields: list[Mentions], steps: int = 200, rate: float = 0.5, ridge: float = 0.01) -> Weights:
    """Maximum pseudo-likelihood: each mention's label given its features and its neighbours' labels."""
    k = NONE + 1
    x, left, skip, y = [], [], [], []
    for m in fields:
        label = [o if o >= 0 else NONE for o in m.observed]
        around: list[np.ndarray] = [np.zeros(k) for _ in label]
        for a, b in m.skips:
            around[a][label[b]] += 1
            around[b][label[a]] += 1
        for i, f in enumerate(m.features):
            row = np.zeros(N_FEATURES)
            row[f] = 1
            near = np.zeros(k)
            for j in (i - 1, i + 1):
                if 0 <= j < len(label):
                    near[label[j]] += 1
            x.append(row)
            left.append(near)
            skip.append(around[i])
            y.append(label[i])
    if not x:
        return Weights(np.zeros((N_FEATURES, k)), np.zeros((k, k)), np.zeros((k, k)))
    x, left, skip = np.array(x), np.array(left), np.array(skip)
    target = np.eye(k)[y]
    node, edge, far = np.zeros((N_FEATURES, k)), np.zeros((k, k)), np.zeros((k, k))
    n = len(y)
    for _ in range(steps):
        g = target - _softmax(x @ node + left @ edge + skip @ far)
        node += rate * (x.T @ g / n - ridge * node / 10)
        ge, gf = left.T @ g / n, skip.T @ g / n
        edge += rate * ((ge + ge.T) / 2 - ridge * edge)
        far += rate * ((gf + gf.T) / 2 - ridge * far)
    return Weights(node, edge, far + AGREE * np.eye(k))


def added_spans(text: str, base: list[Span], w: Weights) -> list[Span]:
    """Spans that the field adds to the base ones: every free mention whose marginal reaches ``CERTAIN``."""
    m = Mentions(text, base)
    if all(o >= 0 for o in m.observed):
        return []
    p = marginals(m, w)
    out = []
    for i, (a, b) in enumerate(m.spans):
        best = int(p[i].argmax())
        if m.observed[i] < 0 and best != NONE and p[i, best] >= CERTAIN:
            out.append((best, a, b))
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Weights:
    """Weights from at most ``sample`` documents that hold a mention."""
    d = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")) \
            .filter(F.col("t").rlike(r"[0-9][0-9 ().,/_-]{5,}[0-9]|@"))
    d = d.withColumn("h", F.xxhash64("i", "t"))
    # the hashes alone choose the documents; what reaches the driver are the parts around their mentions
    least = d.select("h").orderBy("h").limit(sample).collect()
    part = F.udf(training_parts, "string")
    chosen = d.filter(F.col("h") <= (least[-1]["h"] if least else 0))
    rows = chosen.select("h", part("t").alias("p")).orderBy("h", "p").limit(sample).collect()
    return learn([Mentions(r["p"], base_spans(r["p"])) for r in rows])


def training_parts(text: str, reach: int = 60, most: int = PART_CHARS) -> str:
    """The neighbourhoods of a text's mentions, at most ``most`` characters: a bounded training row."""
    m = Mentions(text, [])
    out, end = [], 0
    for a, b in m.spans:
        out.append(text[max(end, a - reach):b])
        end = b
        if sum(map(len, out)) > most:
            break
    return " ".join(out)[:most + 1000]


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans count as one."""
    out, end = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if a >= end:
            out += [text[end:a], f"[{KINDS[k].upper()}]"]
        end = max(end, b)
    return "".join(out) + text[end:]


def _all(text: str | None, w: Weights) -> tuple[list[Span], list[Span]]:
    if not text:
        return [], []
    base = base_spans(text)
    return base, added_spans(text, base, w)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the counts and digest of the base spans, and all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, id_col, text_col))
    schema = T.StructType([docs.schema[id_col], *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
                           T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
                           T.StructField("n_added", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(len(KINDS) + 3)]
            for t in b.column(1):
                base, more = _all(t.as_py(), shared.value)
                for k in range(len(KINDS)):
                    out[k].append(sum(s[0] == k for s in base))
                out[-3].append(hashlib.sha256(spelled(base).encode()).hexdigest())
                out[-2].append(spelled(base + more))
                out[-1].append(len(more))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in out[:-3]), pa.array(out[-3], pa.string()),
                 pa.array(out[-2], pa.string()), pa.array(out[-1], pa.int64())], names=schema.fieldNames())

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """All documents, the spans in their texts replaced; ``length_col``, if there is one, follows a changed text."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, id_col, text_col))
    names = docs.columns
    new, at = free_name(docs, "new_text"), names.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(new, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b.column(at):
                t = t.as_py()
                base, more = _all(t, shared.value)
                out.append(redacted(t, base + more) if base or more else None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=schema.fieldNames())

    done = docs.mapInArrow(run, schema)
    cols = []
    for c in names:
        if c == text_col:
            cols.append(F.coalesce(F.col(new), F.col(c)).alias(c))
        elif c == length_col:
            cols.append(F.when(F.col(new).isNotNull(), F.length(new)).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c))
        else:
            cols.append(F.col(c))
    return done.select(*cols)
