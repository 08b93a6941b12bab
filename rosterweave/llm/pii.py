"""Personal information inside free text, by a skip-chain conditional random field.

A text is a chain of tokens (words, marks, and stretches of the form of a contact, number or
address) with one label each. The field has weights for what a token and its neighbours look
like, for labels in a row, and for skip edges between distant tokens that repeat or begin
alike. The chain weights are trained on weak labels of a bounded sample of texts; the skip
weight comes from how often the ends of skip edges have the same label there. Marginals come
from loopy message passing: forward-backward along the chain, then messages over the skip
edges, round by round, for every text as a whole.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rosterweave.llm.pii_tokens import KINDS, NAME_WORD, SHAPES, hashed, tokens_of

LABELS = ("O", "B-NAME", "I-NAME", "EMAIL", "PHONE", "ID", "ADDRESS")
O, B, I, EMAIL, PHONE, ID, ADDRESS = range(len(LABELS))
TYPES = {EMAIL: "EMAIL", PHONE: "PHONE", ID: "ID", ADDRESS: "ADDRESS"}
KIND_NUMBER = {k: i for i, k in enumerate((*KINDS, *SHAPES, "line", "edge"))}
SPANS = "array<struct<span_start:int,span_end:int,pii_type:string>>"

_ONLY = {"email": (EMAIL,), "address": (ADDRESS,), "id_four": (ID, PHONE), "id_pan": (ID,), "id_nino": (ID,), "id_passport": (ID,), "id_ssn": (ID, PHONE), "phone_wide": (PHONE, ID), "phone": (PHONE, ID), "phone_bare": (PHONE, ID)}
NEVER = -1e4
ALLOWED = np.full((len(KIND_NUMBER), len(LABELS)), NEVER)
ALLOWED[:, O] = 0
for _k, _ls in _ONLY.items():
    ALLOWED[KIND_NUMBER[_k], list(_ls)] = 0
for _k in ("initial", "capital", "capitals", "one"):
    ALLOWED[KIND_NUMBER[_k], [B, I]] = 0
ALLOWED[KIND_NUMBER["mark"], I] = 0
STEP = np.zeros((len(LABELS), len(LABELS)))
STEP[[k for k in range(len(LABELS)) if k not in (B, I)], I] = NEVER

# Phrases beside which weak labels take a name or refuse a number.
_PART = rf"(?:{NAME_WORD}|[^\W\d_a-z]\.|[^\W\d_a-z](?=\s))"
_NAME = rf"(?P<name>{_PART}(?:,?\s{_PART}){{0,3}})"
_CUES = [
    rf"(?:Spoke with|spoke with) {_NAME} (?:about|on|regarding)", rf"Reports to {_NAME}(?=\.|\s|$)", rf"(?:line )?manager {_NAME} can", rf"asked {_NAME} to", rf"(?:Referee|Reference): {_NAME},",
    rf"Contact\s?[-:\n]*\s{_NAME}\s*(?:-|\n)", rf"{_NAME} signed off", rf"{_NAME} \((?:[^()]|\([^()]*\))*\) sent", rf"Hired by {_NAME}(?= and )", rf"Hired by (?:[^.\n]|(?<=[A-Z])\.)*? and {_NAME}(?=\.|\s|$)",
    rf"Llamar a {_NAME},", rf"Joindre {_NAME} au", rf"Rückruf bei {_NAME} unter", rf"Emergency contact {_NAME}(?= \(?[+\d])", rf"Parcel for {_NAME},", rf"keys with {_NAME}\)", rf"-- {_NAME}(?=\s*(?:\n|$|-))",
]
CUES = [re.compile(c) for c in _CUES]
REFUSED = re.compile(r"(?:SKU|[Ii]nvoice|no\.|No\.|[Bb]atch|[Aa]ccount|[Bb]uild|[Vv]ersion|[Oo]rder|REQ|Ref|Job ID|[Cc]ode)\s*$")

WIDTH = 1 << 14
SLOTS = ("kind", "word", "before", "after", "before2", "after2", "kind_before", "kind_after", "kinds", "around")


class Field:
    """Weights of the field: one row of label weights for each hashed feature."""

    def __init__(self) -> None:
        self.w = np.zeros((len(SLOTS) * WIDTH, len(LABELS)), np.float32)
        self.step = np.zeros_like(STEP)
        self.skip = 0.0


def features(kinds: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Feature numbers ``(tokens, slots)`` of texts written one after the other with two edges
    before and behind each; the rows of the edges are of no use. The words of capitals are
    not looked at, so that a name is known by its surroundings and its form, not by heart."""
    k = np.concatenate([[0, 0], kinds, [0, 0]])
    w = np.concatenate([[0, 0], words, [0, 0]])
    n = len(kinds)
    s = lambda x, d: x[2 + d : n + 2 + d]
    k0, w0, kb, ka, wb, wa = s(k, 0), s(w, 0), s(k, -1), s(k, 1), s(w, -1), s(w, 1)
    raw = (k0, w0, wb, wa, s(w, -2) * 31 + wb, s(w, 2) * 31 + wa, kb * 64 + k0, ka * 64 + k0, (kb * 64 + k0) * 64 + ka, wb * 131 + wa * 17 + k0)
    out = np.empty((n, len(SLOTS)), np.int64)
    for i, r in enumerate(raw):
        np.bitwise_and(r, WIDTH - 1, out=out[:, i])
        out[:, i] += i * WIDTH
    return out


EDGES = (np.array([KIND_NUMBER["edge"]] * 2, np.int64), np.array([1, 1], np.int64), np.array([2, 2], np.int64))


def joined(docs: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kinds and words of texts in one row with their edges, and where each text begins."""
    kinds, words, starts, at = [], [], [], 2
    for d in docs:
        kinds += [EDGES[0], d[1], EDGES[0]]
        words += [EDGES[1], d[2], EDGES[2]]
        starts.append(at)
        at += len(d[1]) + 4
    return np.concatenate(kinds), np.concatenate(words), np.array(starts)


class Reader:
    """Turns texts into arrays; remembers the hashes of words."""

    def __init__(self) -> None:
        self.known: dict[tuple[str, str], tuple[int, int]] = {}

    def word(self, key: tuple[str, str]) -> tuple[int, int]:
        kind, word = key
        if kind == "capital":
            h = hashed(word) if word in CAPITAL_WORDS else hashed("Capital")
        elif kind == "capitals" and len(word) > 4:
            h = hashed("capitals")
        else:
            h = hashed(word)
        self.known[key] = (KIND_NUMBER[kind], h)
        return self.known[key]

    def __call__(self, text: str) -> tuple[list, np.ndarray, np.ndarray]:
        toks = tokens_of(text)
        known, word = self.known, self.word
        both = np.array([known.get((k, w)) or word((k, w)) for k, _, _, w in toks], np.int64).reshape(-1, 2)
        return toks, np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


# Capitalised words of ordinary sentences, which say where a name may stand.
CAPITAL_WORDS = frozenset(
    "Spoke Reports My Referee Reference Contact Hired Llamar Joindre Rückruf Emergency Parcel Call Lives Home Moved Mail Correo Copy Best SSN ID NI Invoice Account SKU Job Ref Server Room Build May Will Uses Worked Wrote Hat Spricht "
    "Wants Not Prefers Available Certified Trained Led Drove Has Built Ran Cut Beat Grew Scored Uptime Migrated Managed Keen Handled Mentioned Interview Salary Holds Ratio Strong Quiere Disponible Main Baker Wall Street HQ The A An I In On At For And Or Of "
    "Ltd Inc Corp GmbH Pvt Partners Sons Limited Co June January February March April July August September October November December".split()
)


def skip_edges(toks: list, most_gap: int = 100_000) -> list[tuple[int, int]]:
    """Edges from each capitalised word to the next one that repeats it or begins like it."""
    last: dict[str, int] = {}
    edges = []
    for i, (kind, _, _, word) in enumerate(toks):
        if kind in ("capital", "capitals") and len(word) > 2 and word not in CAPITAL_WORDS:
            key = word.lower()[:5]
            if key in last and i - last[key] > 1 and i - last[key] <= most_gap:
                edges.append((last[key], i))
            last[key] = i
    return edges


def _pad(docs: list, field: Field) -> np.ndarray:
    """Log potentials ``(texts, positions, labels)``; padding is O."""
    kinds, words, starts = joined(docs)
    score = field.w[features(kinds, words)].sum(axis=1) + ALLOWED[kinds]
    lengths = np.array([len(d[1]) for d in docs])
    size = int(lengths.max())
    at = np.arange(size)[None, :]
    inside = at < lengths[:, None]
    unary = np.full((len(docs), size, len(LABELS)), NEVER, np.float32)
    unary[:, :, O] = 0
    unary[inside] = score[(starts[:, None] + at)[inside]]
    return unary


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def marginals(unary: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Beliefs of chains, the potentials scaled, and the scaled forward and backward messages.
    Padding labels are O, which any label may precede, so a chain ends where its padding begins."""
    n, size, k = unary.shape
    u = np.exp(unary - unary.max(axis=2, keepdims=True))
    u[:, 0, I] = 0
    p = np.exp(step).astype(u.dtype)
    alpha, beta = np.empty_like(u), np.ones_like(u)
    a = u[:, 0]
    alpha[:, 0] = a
    for t in range(1, size):
        a = (a @ p) * u[:, t]
        a /= a.sum(axis=1, keepdims=True)
        alpha[:, t] = a
    b = beta[:, size - 1]
    for t in range(size - 2, -1, -1):
        b = (u[:, t + 1] * b) @ p.T
        b /= b.sum(axis=1, keepdims=True)
        beta[:, t] = b
    belief = alpha * beta
    belief /= belief.sum(axis=2, keepdims=True)
    return belief, u, alpha, beta


def weak_labels(text: str, toks: list) -> np.ndarray:
    """Labels by rule: forms of contacts, numbers and addresses unless a phrase refuses them,
    and names beside the phrases that announce them."""
    y = np.zeros(len(toks), int)
    for i, (kind, a, _, _) in enumerate(toks):
        if kind in _ONLY and not REFUSED.search(text[max(0, a - 12) : a]):
            y[i] = _ONLY[kind][0]
    for cue in CUES:
        for m in cue.finditer(text):
            a, b = m.span("name")
            inside = [i for i, t in enumerate(toks) if a <= t[1] and t[2] <= b]
            if inside and all(toks[i][0] in ("initial", "capital", "capitals", "one") or toks[i][3] == "," for i in inside):
                y[inside] = I
                y[inside[0]] = B
    return y


def train(texts: list[str], epochs: int = 3, rate: float = 0.3, batch: int = 64, decay: float = 1e-5, seed: int = 5) -> Field:
    """Maximum likelihood of the weak labels under the chain, by stochastic gradients."""
    field, reader = Field(), Reader()
    docs = []
    agree = apart = 1.0
    for text in texts:
        toks, kinds, words = reader(text)
        if len(toks):
            y = weak_labels(text, toks)
            docs.append((toks, kinds, words, y))
            for i, j in skip_edges(toks):
                same = (y[i] in (B, I)) == (y[j] in (B, I))
                agree, apart = agree + same, apart + (not same)
    field.skip = float(np.clip(0.5 * np.log(agree / apart), 0.0, 3.0))
    rng = np.random.default_rng(seed)
    power, power_step = np.full(field.w.shape, 1e-6, np.float32), np.full(STEP.shape, 1e-6)
    for _ in range(epochs if docs else 0):
        order = rng.permutation(len(docs))
        order = order[np.argsort([len(docs[i][0]) // 16 for i in order], kind="stable")]
        chunks = [order[i : i + batch] for i in range(0, len(order), batch)]
        for c in rng.permutation(len(chunks)):
            part = [docs[i] for i in chunks[c]]
            step = field.step + STEP
            unary = _pad(part, field)
            p, u, alpha, beta = marginals(unary, step)
            lengths = np.array([len(d[0]) for d in part])
            move = np.exp(step)
            grad_step = np.zeros_like(STEP)
            for d in part:
                np.add.at(grad_step, (d[3][:-1], d[3][1:]), 1.0)
            for t in range(1, unary.shape[1]):
                both = alpha[:, t - 1][:, :, None] * move[None] * (u[:, t] * beta[:, t])[:, None, :]
                both /= both.sum(axis=(1, 2), keepdims=True)
                grad_step -= both[lengths > t].sum(axis=0)
            kinds, words, starts = joined(part)
            rows = features(kinds, words)[np.concatenate([np.arange(s, s + n) for s, n in zip(starts, lengths, strict=True)])]
            flat = -np.concatenate([p[i, :n] for i, n in enumerate(lengths)])
            flat[np.arange(len(flat)), np.concatenate([d[3] for d in part])] += 1
            used, back = np.unique(rows, return_inverse=True)
            total = np.stack([np.bincount(back.reshape(-1), np.repeat(flat[:, k], rows.shape[1]), len(used)) for k in range(len(LABELS))], axis=1).astype(np.float32)
            total -= decay * field.w[used]
            power[used] += total**2
            field.w[used] += rate * total / np.sqrt(power[used])
            power_step += grad_step**2
            field.step += np.where(STEP < 0, 0, rate * grad_step / np.sqrt(power_step))
    return field


def infer(docs: list, field: Field, edges: list[list[tuple[int, int]]], rounds: int = 200, tolerance: float = 1e-3) -> list[np.ndarray]:
    """Labels of greatest marginal, with loopy messages over the skip edges of each text. They
    go round until none moves by ``tolerance``, halved in their moves from the twentieth round
    on; a warning says if they do not settle in ``rounds``."""
    unary = _pad(docs, field)
    step = field.step + STEP
    belief = marginals(unary, step)[0]
    flat = [(d, i, j) for d, es in enumerate(edges) for i, j in es]
    if flat and field.skip > 0:
        d, i, j = np.array(flat).T
        names = np.isin(np.arange(len(LABELS)), (B, I))
        bond = np.where(names[:, None] == names[None, :], field.skip, 0.0)
        to_j, to_i = np.zeros((len(d), len(LABELS))), np.zeros((len(d), len(LABELS)))
        rows, dd = np.unique(d, return_inverse=True)
        for turn in range(rounds):
            b = np.log(belief[rows] + 1e-30)
            was_j, was_i = to_j, to_i
            to_j, to_i = _lse((b[dd, i] - to_i)[:, :, None] + bond[None], 1), _lse((b[dd, j] - to_j)[:, :, None] + bond[None], 1)
            to_j -= _lse(to_j, 1)[:, None]
            to_i -= _lse(to_i, 1)[:, None]
            if turn >= 20:
                to_j, to_i = (to_j + was_j) / 2, (to_i + was_i) / 2
            if turn and max(np.abs(to_j - was_j).max(), np.abs(to_i - was_i).max()) < tolerance:
                break
            more = unary[rows].astype(float)
            np.add.at(more, (dd, j), to_j)
            np.add.at(more, (dd, i), to_i)
            belief[rows] = marginals(more, step)[0]
        else:
            warnings.warn(f"messages between tokens did not settle in {rounds} rounds", stacklevel=2)
    best = belief.argmax(axis=2)
    return [best[n, : len(doc[1])] for n, doc in enumerate(docs)]


def spans_of(toks: list, y: np.ndarray) -> list[tuple[int, int, str]]:
    out: list[tuple[int, int, str]] = []
    marked = np.flatnonzero(y)
    if not len(marked):
        return out
    at, y = int(marked[0]), y.tolist()
    while at < len(toks):
        label = y[at]
        if label in TYPES:
            out.append((toks[at][1], toks[at][2], TYPES[label]))
        elif label in (B, I):
            end = at + 1
            while end < len(toks) and y[end] == I:
                end += 1
            last = end
            while last > at and toks[last - 1][0] == "mark":
                last -= 1
            if last > at and any(t[0] in ("capital", "capitals") for t in toks[at:last]):
                out.append((toks[at][1], toks[last - 1][2], "NAME"))
            at = end
            continue
        at += 1
    return out


def _runs(texts: list[str], field: Field, budget: int = 40_000) -> Iterator[tuple[int, list]]:
    """Spans of each text. Texts that look alike to the field are inferred once, in groups of
    like length that keep the arrays small."""
    reader = Reader()
    alike: dict[tuple, list[int]] = {}
    read = []
    for n, t in enumerate(texts):
        toks, kinds, words = reader(t)
        read.append(toks)
        if toks:
            edges = skip_edges(toks)
            alike.setdefault((kinds.tobytes(), words.tobytes(), tuple(edges)), []).append(n)
        else:
            yield n, []
    forms = sorted(alike.items(), key=lambda x: len(x[0][0]))
    at = 0
    while at < len(forms):
        end = at
        while end < len(forms) and (end - at + 1) * len(forms[end][0][0]) // 8 <= budget:
            end += 1
        group = forms[at : max(end, at + 1)]
        docs = [(None, np.frombuffer(k, np.int64), np.frombuffer(w, np.int64)) for (k, w, _), _ in group]
        for (_, members), y in zip(group, infer(docs, field, [key[2] for key, _ in group]), strict=True):
            for n in members:
                yield n, spans_of(read[n], y)
        at += len(group)


def train_on(texts: DataFrame, train_texts: int = 16_000, labelled: int = 3000, plain: int = 1500) -> Field:
    """A field trained on a bounded sample: of ``train_texts`` texts, taken by a hash of their
    content, the first ``labelled`` with a weak label and the first ``plain`` without one."""
    usable = texts.select("text").where("text is not null and text <> '' and length(text) <= 2000")
    part = min(1.0, 1.2 * train_texts / max(1, usable.count()))
    low = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(part * (1 << 20))
    rows = sorted({r.text for r in usable.where(low).select("text").limit(2 * train_texts).collect()})[:train_texts]
    rows.sort(key=hashed)
    reader, some, none = Reader(), [], []
    for text in rows:
        if len(some) < labelled and weak_labels(text, reader(text)[0]).any():
            some.append(text)
        elif len(none) < plain:
            none.append(text)
    return train(some + none)


def find_pii(texts: DataFrame, field: Field, *keep: str) -> DataFrame:
    """``(*keep, spans, redacted)`` for every text of ``texts(*keep, text)``.

    ``spans`` has start and end in characters from 0 and the type; ``redacted`` is the text with each
    span replaced by its type in square brackets. Null texts give null and no spans; empty texts
    and texts without personal information come back as they are.
    """
    spark = texts.sparkSession
    # the arrays are some megabytes, fixed by WIDTH
    shared = spark.sparkContext.broadcast((field.w, field.step, field.skip))
    columns = list(keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = Field()
        f.w, f.step, f.skip = shared.value
        for batch in batches:
            out = batch[columns].copy()
            texts = batch["text"].tolist()
            spans: list = [[]] * len(texts)
            for i, found in _runs([t or "" for t in texts], f):
                spans[i] = found
            out["spans"] = [[{"span_start": a, "span_end": b, "pii_type": t} for a, b, t in s] for s in spans]
            out["redacted"] = [_redact(t, s) for t, s in zip(texts, spans, strict=True)]
            yield out

    types = dict(texts.dtypes)
    return texts.select(*columns, "text").mapInPandas(run, ", ".join(f"`{c}` {types[c]}" for c in columns) + f", spans {SPANS}, redacted string")


def _redact(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    if text is None:
        return None
    parts, at = [], 0
    for a, b, kind in spans:
        parts += [text[at:a], f"[{kind}]"]
        at = b
    return "".join([*parts, text[at:]])
