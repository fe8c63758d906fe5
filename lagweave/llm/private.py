"""Personal data: patterns with checks, and a bidirectional character LSTM with a CRF that adds what they miss."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import rows, table

KINDS = ("email", "ip", "card", "phone")
#: Hidden numbers of a direction, characters of a window, and those that it shares with the next one.
HIDDEN, WINDOW, SHARED = 16, 64, 32
#: Documents that training windows come from (an expected size of a draw by a hash) and windows that are kept: the documented bound of the fit.
SAMPLE, WINDOWS = 20_000, 1500
STEPS, BATCH, RATE, SEED = 260, 96, 0.02, 12
#: Least posterior of every character of a span that the model adds.
LEAST_P = 0.9

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What every span of the model holds: a digit, an at sign, or a written-out one in brackets.
_ANCHOR = re.compile(r"[0-9@]|[\[(]at[\])]")
_TAGS = 1 + 2 * len(KINDS)  # O, then B and I of each kind
_FORBIDDEN = np.array([[j and j % 2 == 0 and i not in (j - 1, j) for j in range(_TAGS)] for i in range(_TAGS)])


def luhn(digits: str) -> bool:
    return sum(sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by the patterns, leftmost and non-overlapping in each kind, by start and then kind; in time linear in the text."""
    out, low, at = [], 0, text.find("@")
    while at >= 0:  # a run of local characters ends at its own @
        start = low + len(text[low:at].rstrip(_LOCAL))
        low = at + 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((0, start, m.end()))
            low = m.end()
        at = text.find("@", low)
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15]
    return [(KINDS[k], a, b) for k, a, b in sorted(out, key=lambda x: (x[1], x[0]))]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


class Model(NamedTuple):
    """Input weights of each character by direction, recurrent weights, output weights and bias, transitions between tags."""

    e: np.ndarray
    w: np.ndarray
    o: np.ndarray
    b: np.ndarray
    t: np.ndarray


def codes(text: str) -> np.ndarray:
    """1 to 128 for ASCII, 129 for other letters, 130 for all else; 0 is what fills a window."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    out = np.where(points < 128, points + 1, 130)
    for k in np.flatnonzero(points >= 128):
        out[k] = 129 if text[k].isalpha() else 130
    return out


def new_model(draw: np.random.Generator) -> Model:
    h = HIDDEN
    e = draw.normal(0, 0.3, (2, 131, 4 * h))
    e[:, :, h : 2 * h] += 1.0  # open forget gates
    return Model(*(x.astype(np.float32) for x in (e, draw.normal(0, 0.25, (2, h, 4 * h)), draw.normal(0, 0.25, (2 * h, _TAGS)), np.array([1.0] + [0.0] * (_TAGS - 1)), np.zeros((_TAGS, _TAGS)))))


def run_lstm(model: Model, ids: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """(hidden numbers of both directions by time and window, what the gradient needs): ids has a row for each window."""
    n, length, h = *ids.shape, HIDDEN
    hidden, cell = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
    out, kept = np.zeros((length, n, 2 * h), np.float32), []
    for t in range(length):
        z = np.stack([model.e[0][ids[:, t]], model.e[1][ids[:, length - 1 - t]]]) + hidden @ model.w
        gates = 1 / (1 + np.exp(-z[:, :, : 3 * h]))
        new = np.tanh(z[:, :, 3 * h :])
        before, was = cell, hidden
        cell = gates[:, :, h : 2 * h] * cell + gates[:, :, :h] * new
        squashed = np.tanh(cell)
        hidden = gates[:, :, 2 * h :] * squashed
        out[t, :, :h], out[length - 1 - t, :, h:] = hidden
        if keep:
            kept.append((gates, new, before, was, squashed))
    return out, kept


def marginals(model: Model, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posterior of each tag by time and window, summed posterior of each pair of neighbouring tags, log of the sum over all paths)."""
    length = len(scores)
    a = np.where(_FORBIDDEN, 0, np.exp(model.t)).astype(np.float64)
    top = scores.max(axis=2, keepdims=True)
    local = np.exp((scores - top).astype(np.float64))
    start = np.array([0.0 if k and k % 2 == 0 else 1.0 for k in range(_TAGS)])
    alpha, c = np.zeros_like(local), np.zeros(local.shape[:2])
    for t in range(length):
        alpha[t] = local[t] * (alpha[t - 1] @ a if t else start)
        c[t] = alpha[t].sum(1)
        alpha[t] /= c[t][:, None]
    beta, pairs = np.ones_like(local[0]), np.zeros_like(a)
    post = alpha.copy()
    for t in range(length - 1, 0, -1):
        later = local[t] * beta / c[t][:, None]
        pairs += a * (alpha[t - 1].T @ later)
        beta = later @ a.T
        post[t - 1] *= beta
    return post, pairs, np.log(c).sum(0) + top[:, :, 0].sum(0)


def best_path(model: Model, scores: np.ndarray) -> np.ndarray:
    """The tags of the best path of each window (Viterbi)."""
    trans = np.where(_FORBIDDEN, -1e6, model.t)
    now = scores[0] + np.array([-1e6 if k and k % 2 == 0 else 0.0 for k in range(_TAGS)])
    back = []
    for s in scores[1:]:
        both = now[:, :, None] + trans
        back.append(both.argmax(1))
        now = both.max(1) + s
    path = [now.argmax(1)]
    for b in reversed(back):
        path.append(b[np.arange(len(b)), path[-1]])
    return np.array(path[::-1]).T


def gradient(model: Model, ids: np.ndarray, tags: np.ndarray) -> tuple[float, Model]:
    """Mean negative log-likelihood of the tags of a batch of windows, and its gradient, through the CRF and both directions in time."""
    n, length, h = *ids.shape, HIDDEN
    hidden, kept = run_lstm(model, ids, True)
    scores = hidden @ model.o + model.b
    post, pairs, total = marginals(model, scores)
    one = np.eye(_TAGS)[tags.T]
    paid = (scores * one).sum((0, 2)) + model.t[tags[:, :-1], tags[:, 1:]].sum(1)
    np.subtract.at(pairs, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1.0)
    ds = ((post - one) / n).astype(np.float32)
    dh = ds @ model.o.T
    de, dw, carry, dcell = np.zeros_like(model.e), np.zeros_like(model.w), np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
    for t in range(length - 1, -1, -1):
        gates, new, before, was, squashed = kept[t]
        i, f, o = gates[:, :, :h], gates[:, :, h : 2 * h], gates[:, :, 2 * h :]
        g = carry + np.stack([dh[t, :, :h], dh[length - 1 - t, :, h:]])
        dcell = dcell + g * o * (1 - squashed**2)
        dz = np.concatenate([dcell * new * i * (1 - i), dcell * before * f * (1 - f), g * squashed * o * (1 - o), dcell * i * (1 - new**2)], axis=2)
        dw += was.transpose(0, 2, 1) @ dz
        for d, at in ((0, t), (1, length - 1 - t)):
            np.add.at(de[d], ids[:, at], dz[d])
        carry, dcell = dz @ model.w.transpose(0, 2, 1), dcell * f
    do = np.tensordot(hidden, ds, axes=((0, 1), (0, 1)))
    return float((total - paid).mean()), Model(de, dw, do, ds.sum((0, 1)), (np.where(_FORBIDDEN, 0, pairs) / n).astype(np.float32))


def train(windows: list[str], steps: int = STEPS, seed: int = SEED) -> Model:
    """The model fitted to windows of the corpus, with the spans of base_spans as labels, half of them with a written variant or a look-alike planted in them."""
    draw = np.random.default_rng(seed)
    model = new_model(draw)
    mean, square = [np.zeros_like(x) for x in model], [np.zeros_like(x) for x in model]
    for step in range(1, steps + 1):
        ids, tags = np.zeros((BATCH, WINDOW), np.int64), np.zeros((BATCH, WINDOW), np.int64)
        for k in range(BATCH):
            text, spans = planted(windows[draw.integers(len(windows))], draw) if k % 2 else cut(windows[draw.integers(len(windows))], draw)
            ids[k, : len(text)] = codes(text)
            for kind, a, b in spans:
                tags[k, a:b] = 2 + 2 * KINDS.index(kind)
                tags[k, a] -= 1
        grad = gradient(model, ids, tags)[1]
        size = np.sqrt(sum(float((g**2).sum()) for g in grad))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, (x, g) in enumerate(zip(model, grad, strict=True)):
            g = g * min(1.0, 5.0 / max(size, 1e-9))
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            x -= (rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return model


def cut(text: str, draw: np.random.Generator) -> tuple[str, list[tuple[str, int, int]]]:
    """A window of the text, with the base spans that lie in it; no span is cut in two."""
    start = int(draw.integers(max(1, len(text) - WINDOW + 1)))
    spans = base_spans(text)
    for _, a, b in spans:
        if a < start < b:
            start = a
    end = min([len(text), start + WINDOW, *(a for _, a, b in spans if a < start + WINDOW < b)])
    return text[start:end], [(k, a - start, b - start) for k, a, b in first_each(spans) if start <= a and b <= end]


def first_each(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The spans without those that begin inside an earlier one."""
    out: list[tuple[str, int, int]] = []
    for s in spans:
        if not out or s[1] >= out[-1][2]:
            out.append(s)
    return out


def planted(text: str, draw: np.random.Generator) -> tuple[str, list[tuple[str, int, int]]]:
    """A window with an invented span of one kind, or a look-alike, between words of the text."""
    number = lambda n: "".join(map(str, draw.integers(0, 10, n)))
    word = lambda: "".join(chr(97 + c) for c in draw.integers(0, 26, int(draw.integers(3, 8))))
    pick = lambda *x: x[int(draw.integers(len(x)))]
    kind = pick(*KINDS, *KINDS, None, None, None)
    if kind == "email":
        new = pick(word(), word() + number(2), word() + "." + word()) + pick("@", "[at]", "(at)", " @ ") + pick("", "mail" + number(1) + ".") + word() + pick(".com", ".org", ".net")
    elif kind == "ip":
        new = pick(".", "[.]", "(.)").join(str(x) for x in draw.integers(0, 256, 4))
    elif kind == "card":
        new = pick("", " ", "-", ".", "/", "_").join(number(4) for _ in range(4))
    elif kind == "phone":
        new = pick("", "+1 ", "+44 ", "001 ") + pick("({0}) {1}-{2}", "{0}-{1}-{2}", "{0}.{1}.{2}", "{0} {1} {2}").format(number(3), number(3), number(4))
    else:
        new = pick(number(2), number(4), number(6), f"{number(1)}.{number(1)}", f"{number(1)}.{number(2)}.{number(1)}", f"20{number(2)}-{number(2)}-{number(2)}", f"{number(2)}:{number(2)}:{number(2)}", f"{number(1)},{number(3)},{number(3)}.{number(2)}", hashlib.sha1(word().encode()).hexdigest(), f"{number(2)}/{number(2)}/{number(4)}", word() + number(1), f"${number(3)}", "@" + word())
    before = re.sub(_ANCHOR, "", text)[: int(draw.integers(0, max(1, WINDOW - len(new) - 2)))]
    before = before + pick(" ", " ", " (", ": ") if before else ""
    after = pick(" ", " ", ". ", ", ", "*** ", "!! ") + re.sub(_ANCHOR, "", text)[len(before) :]
    return (before + new + after)[:WINDOW], [(kind, len(before), len(before) + len(new))] if kind and len(before) + len(new) <= WINDOW else []


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches of the text around all anchors, SHARED characters to both sides."""
    out: list[list[int]] = []
    for m in _ANCHOR.finditer(text):
        a, b = max(0, m.start() - SHARED), min(len(text), m.end() + SHARED)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def windows_of(text: str) -> list[tuple[int, int]]:
    """Overlapping windows over all regions."""
    return [(at, min(b, at + WINDOW)) for a, b in regions(text) for at in range(a, max(a + 1, b - SHARED), WINDOW - SHARED)]


def decoded(model: Model, texts: list[str], places: list[tuple[int, int, int]]) -> list[list[tuple[float, str, int, int, bool]]]:
    """For each text, spans of its windows (text, start, end): score, kind, start, end, whether a window's end cuts it."""
    out: list[list] = [[] for _ in texts]
    for k in range(0, len(places), 1024):
        part = places[k : k + 1024]
        ids = np.zeros((len(part), WINDOW), np.int64)
        for row, (d, a, b) in enumerate(part):
            ids[row, : b - a] = codes(texts[d][a:b])
        scores = run_lstm(model, ids)[0] @ model.o + model.b
        post, path = marginals(model, scores)[0], best_path(model, scores)
        for row in np.flatnonzero((path > 0).any(1)).tolist():
            d, a, b = part[row]
            tags, t = path[row, : b - a].tolist(), 0
            while t < len(tags):
                if not tags[t]:
                    t += 1
                    continue
                kind, s = (tags[t] - 1) // 2, t
                t += 1
                while t < len(tags) and tags[t] == 2 + 2 * kind:
                    t += 1
                sure = post[s:t, row, 1 + 2 * kind : 3 + 2 * kind].sum(1)
                if sure.min() >= LEAST_P:
                    edge = (s == 0 and a > 0) or (t == b - a and b < len(texts[d]))
                    out[d].append((float(sure.sum()), KINDS[kind], a + s, a + t, edge))
    return out


def reconciled(found: list[tuple[float, str, int, int, bool]], base: list[tuple[str, int, int]], text: str) -> list[tuple[str, int, int]]:
    """The spans that the model adds to a text: pieces that windows' ends cut join with what they overlap, and of spans that overlap those of the greatest total score stay.

    Spans that touch a base span, or hold no anchor, go."""
    parts: list[list] = []
    for score, kind, a, b, edge in sorted(found, key=lambda x: (x[1], x[2], x[3])):
        last = parts[-1] if parts else None
        if last and last[1] == kind and a < last[3] and (edge or last[4]):
            last[:] = [max(score, last[0]), kind, last[2], max(b, last[3]), edge if b >= last[3] else last[4]]
        elif last and last[1:4] == [kind, a, b]:
            last[0] = max(score, last[0])
        else:
            parts.append([score, kind, a, b, edge])
    taken, k, free = sorted((a, b) for _, a, b in base), 0, []
    for p in sorted(parts, key=lambda x: (x[2], x[3])):
        while k < len(taken) and taken[k][1] <= p[2]:
            k += 1
        if not any(a < p[3] and p[2] < b for a, b in taken[k : k + 8]) and _ANCHOR.search(text, p[2], p[3]):
            free.append(p)
    free.sort(key=lambda x: (x[3], x[2], x[1]))
    ends, best = [p[3] for p in free], [(0.0, None)]
    for j, p in enumerate(free):
        before = int(np.searchsorted(ends[:j], p[2], side="right"))
        with_it = best[before][0] + p[0]
        best.append((with_it, before) if with_it > best[-1][0] else (best[-1][0], None))
    out, j = [], len(free)
    while j:
        if best[j][1] is None:
            j -= 1
        else:
            out.append(tuple(free[j - 1][1:4]))
            j = best[j][1]
    return out[::-1]


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of two windows around every anchor region, with a digest that orders them."""
    for b in rows(batches):
        out = {x[max(0, a - SHARED) : a + 2 * WINDOW] for x in b.column("text").to_pylist() for a, _ in regions(x)}
        keyed = sorted((hashlib.sha1(x.encode("utf-8", "replace")).hexdigest(), x) for x in out)[:WINDOWS]
        yield pa.record_batch([pa.array([k for k, _ in keyed], pa.string()), pa.array([x for _, x in keyed], pa.string())], names=["key", "text"])


def fit(docs: DataFrame) -> Model | None:
    """The model of docs (doc_id, text); None where they hold no digit and no at sign.

    Fitted to WINDOWS distinct pieces at most of about SAMPLE documents, or of all if they are fewer, drawn by hashes, so that reruns agree."""
    known = docs.filter(F.col("text").isNotNull()).select("text")
    share = min(1.0, SAMPLE / max(1, known.count()))
    drawn = known.filter(F.pmod(F.xxhash64("text", F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30)))
    got = drawn.mapInArrow(_sample, "key string, text string").groupBy("key").agg(F.min("text").alias("text")).orderBy("key").limit(WINDOWS).collect()
    return train([r.text for r in got]) if got else None


def find(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per document: doc_id, counts of base spans by kind, base (all base spans), added (spans of the model), as arrays of kind, start and end.

    Places are code points, end exclusive. Whole texts are searched, in time linear in their length: the patterns everywhere, the model in overlapping windows around
    every digit and at sign, which each of its spans has to hold. Null and empty texts have no spans. Rows are judged by themselves, so null ids, repeated rows
    and other columns need no rule; of no rows come none. No shuffle; the model is some thousand numbers."""
    given = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    names = [f"n_{k}" for k in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches):
            texts = [x or "" for x in b.column("text").to_pylist()]
            base = [base_spans(x) for x in texts]
            places = [(d, *w) for d, x in enumerate(texts) for w in windows_of(x)]
            found = decoded(given.value, texts, places) if given.value else [[] for _ in texts]
            added = [reconciled(f, s, x) for f, s, x in zip(found, base, texts, strict=True)]
            spans = lambda all_: pa.array([[{"kind": k, "start": a, "end": z} for k, a, z in x] for x in all_], kind)
            counts = [pa.array([sum(s[0] == k for s in x) for x in base], pa.int64()) for k in KINDS]
            yield pa.record_batch([b.column("doc_id"), *counts, spans(base), spans(added)], names=["doc_id", *names, "base", "added"])

    array = "array<struct<kind:string,start:int,end:int>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, {', '.join(n + ' long' for n in names)}, base {array}, added {array}")


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find(docs, fit(docs))
    order = F.transform(F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("k"), s["end"].alias("end"), s["kind"].alias("kind")))), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2(F.encode(text(F.col("base")), "UTF-8"), 256).alias("base_sha256"), F.array_join(order, ",").alias("spans"))
