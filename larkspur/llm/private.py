"""Personal data by weak supervision.

Strict patterns with their checks find the base spans, which always stay. Loose patterns propose more
candidates: obfuscated addresses, local phone numbers, IPv6 and shorter card numbers, and the numbers
inside of a strict match that failed its check, as when a card follows a phone number. Four labelers
vote on every candidate (yes, no, abstain): the strict pattern with its check, gazetteers of mail and
top-level domains, calling codes and issuer digits, cue words before it, and what touches it.

Votes are counted over all texts. Expectation-maximisation on these counts estimates how reliable each
labeler is and how likely each vote pattern is personal data; a logistic span classifier is trained on
that, with features of the span's form. A loose candidate is added where the classifier says yes and a
labeler had a reason to. Only the counts by pattern, whose number is bounded, reach the driver.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import slices

KINDS = ("email", "ip", "card", "phone")

# Fixed patterns and checks of the base spans.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

# Loose patterns.
AT = r"\s?(?:\[at\]|\(at\)|\{at\}|\sat\s)\s?"
DOT = r"\s?(?:\[dot\]|\(dot\)|\{dot\}|\sdot\s)\s?"
HIDDEN_AT = re.compile(AT, re.IGNORECASE)
HIDDEN_DOMAIN = re.compile(rf"[A-Za-z0-9-]+(?:(?:\.|{DOT})[A-Za-z0-9-]+)+", re.IGNORECASE)
#: The run before the mark, read backwards.
HIDDEN_LOCAL = re.compile(r"[A-Za-z0-9_%+-]+(?:(?:\.|\s?(?:\]tod\[|\)tod\(|\}tod\{|\stod\s)\s?)[A-Za-z0-9_%+-]+)*", re.IGNORECASE)
HIDING = re.compile(r"[\[({]at[\])}]|[\[({]dot[\])}]|\sdot\s", re.IGNORECASE)
LOCAL_PHONE = re.compile(r"(?<![0-9+(.-])(?:\([0-9]{2,5}\) ?|00?[1-9][0-9]{1,3}[ /-])?[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9.-])")
IPV6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")

# Gazetteers and cue words; fixed values.
#: Besides these, every name of two letters is a country's.
TOP_LEVEL = set(
    "com org net edu gov mil int arpa info biz name pro aero coop museum jobs mobi travel tel cat asia post xxx app dev page web site online "
    "store shop blog cloud tech xyz top club live news media email work world group agency company digital network solutions services "
    "systems software academy university school institute foundation health care bank finance law legal consulting design studio art "
    "music film games sport example test invalid localhost".split()
)
ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "22", "23", "24", "25", "26", "27", "35", "36", "38", "60", "62", "64", "65")
#: Calling codes of one and two digits, and the first two digits of those of three.
CALLING = set("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
CALLING_ZONES = set("21 22 23 24 25 26 29 35 37 38 42 50 59 67 68 69 80 85 87 88 96 97 99".split())
CUES = {
    "email": r"e-?mail|mail|contact|reach|write|correo|courriel|kontakt|contacto",
    "ip": r"\bip\b|ipv6|host|server|address|adresse|client|from",
    "card": r"card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta|payment",
    "phone": r"phone|\btel\b|tel\.|call|mobile|cell|fax|telefon|téléphone|teléfono|móvil|handy|whatsapp|dial",
}
CUE = {kind: re.compile(pattern, re.IGNORECASE) for kind, pattern in CUES.items()}
OTHER_CUE = re.compile(r"order|invoice|isbn|issn|version|build|\bno\.|#|sku|part|doi|page|year|serial|\bref|id\b|\$|€|£|total|release", re.IGNORECASE)
NEAR = 40
#: Candidates of loose patterns are added from this probability on.
LEAST = 0.5
LABELERS = 4
PASSES = 100

FORMS = ("strict", "failed", "loose", "part")


class Candidate(NamedTuple):
    kind: int
    start: int
    end: int
    form: int  # of FORMS
    votes: tuple[int, ...]
    size: int  # a bucket of the number of digits

    @property
    def pattern(self) -> tuple[int, ...]:
        return (self.kind, self.form, self.size, *self.votes)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _digits(value: str) -> str:
    return "".join(c for c in value if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local@domain: from each @, the domain after it and the run before it."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        after = DOMAIN.match(text, at + 1)
        if after:
            left = at
            while left > done and text[left - 1] in LOCAL:
                left -= 1
            if left < at:
                found.append((left, after.end()))
                done = after.end()
                at = text.find("@", done)
                continue
        at = text.find("@", at + 1)
    return found


def strict_spans(text: str) -> list[tuple[int, int, int, bool]]:
    """Kind, start, end and whether the check passed, for all strict matches."""
    found = [(0, a, b, True) for a, b in emails(text)] if "@" in text else []
    first = DIGIT.search(text)
    if not first:
        return found
    at = first.start()
    if text.find(".", at) >= 0:
        for m in IP.finditer(text, at):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            found.append((1, m.start(), m.end(), all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)))
    for m in CARD.finditer(text, at):
        if m.end() - m.start() >= 13:
            digits = _digits(m[0])
            found.append((2, m.start(), m.end(), 16 <= len(digits) <= 19 and luhn(digits)))
    if "+" in text:
        for m in PHONE.finditer(text):
            found.append((3, m.start(), m.end(), 8 <= len(_digits(m[0])) <= 15))
    return found


def parts_of(text: str, kind: int, start: int, end: int) -> list[tuple[int, int, int]]:
    """Cards and phone numbers within a strict match that failed: whole groups of its digits."""
    groups = [(m.start(), m.end()) for m in re.compile(r"[0-9]+").finditer(text, start, end)]
    found = []
    if kind == 2:
        i = 0
        while i < len(groups):
            digits, best = "", -1
            for j in range(i, len(groups)):
                digits += text[slice(*groups[j])]
                if len(digits) > 19:
                    break
                # One group, or groups as cards are printed; others are chance.
                printed = j == i or j - i >= 2 and all(3 <= b - a <= 7 for a, b in groups[i : j + 1])
                if len(digits) >= 13 and printed and luhn(digits):
                    best = j
            if best >= 0:
                found.append((2, groups[i][0], groups[best][1]))
                i = best
            i += 1
    elif kind == 3:
        count, to = 0, -1
        for a, b in groups:
            count += b - a
            if count > 15 or b - a > 12:
                break
            if count >= 8:
                to = b
        if to > 0:
            found.append((3, start, to))
    return found


def hidden_emails(line: str) -> list[tuple[int, int]]:
    """Obfuscated addresses of a line: from each mark, the domain after it and the run before it."""
    found, done, back, size = [], 0, line[::-1], len(line)
    mark = HIDDEN_AT.search(line)
    while mark:
        at = mark.start() + 1
        after = HIDDEN_DOMAIN.match(line, mark.end())
        before = HIDDEN_LOCAL.match(back, size - mark.start(), size - done) if after else None
        if before and HIDING.search(line, size - before.end(), after.end()):
            found.append((size - before.end(), after.end()))
            at = done = after.end()
        mark = HIDDEN_AT.search(line, at)
    return found


def loose_spans(text: str) -> list[tuple[int, int, int]]:
    found = []
    if HIDING.search(text):
        for line in re.finditer(r"[^\n]+", text):
            found += [(0, line.start() + a, line.start() + b) for a, b in hidden_emails(line[0])]
    if DIGIT.search(text):
        if text.count(":") >= 7:
            found += [(1, m.start(), m.end()) for m in IPV6.finditer(text)]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(digits := _digits(m[0])) <= 15 and luhn(digits):
                found.append((2, m.start(), m.end()))
        for m in LOCAL_PHONE.finditer(text):
            if 7 <= len(_digits(m[0])) <= 12:
                found.append((3, m.start(), m.end()))
    return found


def _gazetteer(kind: int, value: str) -> int:
    if kind == 0:
        last = re.split(r"[^A-Za-z]+", value.lower())[-1]
        return 1 if len(last) == 2 or last in TOP_LEVEL else 0
    if kind == 1:
        return 0 if value.startswith(("0.", "255.")) else 1
    digits = _digits(value)
    if kind == 2:
        return 1 if digits.startswith(ISSUERS) else -1
    if value.startswith("+"):
        return 1 if digits[:1] in CALLING or digits[:2] in CALLING | CALLING_ZONES else -1
    return 0


def votes(text: str, kind: int, start: int, end: int, form: int) -> tuple[int, ...]:
    """Of the strict pattern, the gazetteer, the cue words and the neighbouring characters."""
    before = text[max(0, start - NEAR) : start]
    cue = 1 if CUE[KINDS[kind]].search(before) else -1 if OTHER_CUE.search(before) else 0
    left, right = text[start - 1 : start], text[end : end + 1]
    touched = left.isalnum() or right.isalnum() or left in ("=", "_", "/", ".") and left != "" or right in ("_", "/", "=") and right != ""
    return ((1, -1, 0, 1)[form], _gazetteer(kind, text[start:end]), cue, -1 if touched else 1)


class Taken:
    """Spans, of which some may overlap each other, to be asked whether another one meets them.

    They are held in sorted runs of touching spans, so a question costs a binary search.
    """

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        i = bisect_left(self.starts, b)
        return i > 0 and self.ends[i - 1] > a

    def add(self, a: int, b: int) -> None:
        """Add a span that meets none."""
        i = bisect_left(self.starts, a)
        self.starts.insert(i, a)
        self.ends.insert(i, b)


def candidates(text: str) -> list[Candidate]:
    strict = strict_spans(text)
    found = [(kind, a, b, 0 if good else 1) for kind, a, b, good in strict]
    taken = Taken((a, b) for _, a, b, good in strict if good)
    for kind, a, b in loose_spans(text):
        if not taken.meets(a, b):
            found.append((kind, a, b, 2))
    for kind, a, b, good in strict:
        if not good and kind > 1:
            found += [(k, x, y, 3) for k, x, y in parts_of(text, kind, a, b)]
    out = []
    for kind, a, b, form in found:
        size = min(4, sum("0" <= c <= "9" for c in text[a:b]) // 4)
        out.append(Candidate(kind, a, b, form, votes(text, kind, a, b, form), size))
    return out


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in slices(batches, "text"):
        for value in batch.column(0):
            counts.update(c.pattern for c in candidates(value.as_py() or ""))
    rows = sorted(counts.items())
    yield pa.RecordBatch.from_arrays([pa.array([list(p) for p, _ in rows], pa.list_(pa.int32())), pa.array([n for _, n in rows], pa.int64())], names=["pattern", "n"])


def reliabilities(patterns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each vote pattern, and P(vote | truth) by labeler, truth and vote + 1.

    The labelers are taken as independent given the truth; kinds have their own prior.
    """
    cast = patterns[:, 3:] + 1
    kinds = patterns[:, 0]
    posterior = 1 / (1 + np.exp(-2.0 * patterns[:, 3:].sum(1)))
    tables = np.zeros((LABELERS, 2, 3))
    for _ in range(PASSES):
        weight = np.stack((counts * (1 - posterior), counts * posterior))
        for j in range(LABELERS):
            for y in (0, 1):
                seen = np.bincount(cast[:, j], weight[y], 3) + np.array([1.0, 1.0, 1.0]) + (np.array([0, 0, 1.0]) if y else np.array([1.0, 0, 0]))
                tables[j, y] = seen / seen.sum()
        prior = (np.bincount(kinds, weight[1], len(KINDS)) + 1) / (np.bincount(kinds, weight.sum(0), len(KINDS)) + 2)
        logit = np.log(prior[kinds]) - np.log(1 - prior[kinds])
        for j in range(LABELERS):
            logit = logit + np.log(tables[j, 1, cast[:, j]]) - np.log(tables[j, 0, cast[:, j]])
        fresh = 1 / (1 + np.exp(-logit))
        if np.abs(fresh - posterior).max(initial=0) < 1e-9:
            break
        posterior = fresh
    return posterior, tables


def _features(patterns: np.ndarray) -> np.ndarray:
    columns = [np.ones(len(patterns))]
    columns += [patterns[:, 0] == k for k in range(len(KINDS))]
    columns += [patterns[:, 1] == f for f in range(len(FORMS))]
    columns += [patterns[:, 2] == s for s in range(5)]
    columns += [patterns[:, 3 + j] == v for j in range(LABELERS) for v in (-1, 1)]
    return np.stack(columns, 1).astype(float)


def train(patterns: np.ndarray, counts: np.ndarray, posterior: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights of a logistic classifier for soft labels, by Newton's method."""
    x = _features(patterns)
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (counts * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w)), x.T @ (counts * (posterior - p)) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, *, text: str = "text") -> list[float]:
    """The span classifier's weights, from the votes on all candidates of all texts.

    Without any candidate the weights are 0: nothing is added then.
    """
    chosen = docs.select(F.col(text).cast("string").alias("text"))
    found = chosen.mapInArrow(_counted, "pattern array<int>, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    if not found:
        return [0.0] * _features(np.zeros((1, 3 + LABELERS), int)).shape[1]
    rows = sorted((tuple(r["pattern"]), r["n"]) for r in found)
    patterns, counts = np.array([p for p, _ in rows]), np.array([n for _, n in rows], float)
    posterior, _ = reliabilities(patterns, counts)
    return train(patterns, counts, posterior).tolist()


def spans_of(text: str, weights: np.ndarray, least: float = LEAST) -> list[tuple[int, int, int, bool]]:
    """Kind, start, end and whether it is a base span; by kind, then start."""
    found = candidates(text)
    kept = [(c.kind, c.start, c.end, True) for c in found if c.form == 0]
    loose = [c for c in found if c.form >= 2 and max(c.votes[1:3]) > 0 and min(c.votes[2:]) >= 0]
    if loose:
        taken = Taken((a, b) for _, a, b, _ in kept)
        score = 1 / (1 + np.exp(-np.clip(_features(np.array([c.pattern for c in loose])) @ weights, -30, 30)))
        for i in np.argsort(-score, kind="stable"):
            c = loose[i]
            if score[i] > least and not taken.meets(c.start, c.end):
                taken.add(c.start, c.end)
                kept.append((c.kind, c.start, c.end, False))
    return sorted(kept)


def _joined(spans: Iterable[tuple[int, int, int, bool]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b, _ in spans)


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])


def _found(weights: list[float], least: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.array(weights)
        for batch in slices(batches, "text"):
            spans = [[{"kind": KINDS[k], "start": a, "end": b, "base": base} for k, a, b, base in spans_of(v.as_py() or "", w, least)] for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(SPAN))], names=["doc_id", "spans"])

    return run


def find_private(docs: DataFrame, weights: list[float], *, doc_id: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """doc_id and spans (kind, start, end, base), a row for each row of ``docs``.

    Places are code points, end exclusive; spans are ordered by kind, then start. A NULL or empty text
    has none. Whole texts are read. Repeated rows are judged alike; other columns are not read.
    """
    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return chosen.mapInArrow(_found(weights, least), "doc_id long, spans array<struct<kind: string, start: long, end: long, base: boolean>>")


def masked(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its kind in brackets."""
    parts, at = [], 0
    for k, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            parts += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, weights: list[float], *, text: str = "text", n_chars: str | None = "n_chars", least: float = LEAST) -> DataFrame:
    """``docs`` with all its columns, found spans masked in ``text`` and their count of characters anew.

    A NULL text stays NULL. Columns are told apart by name; ``n_chars`` is left out if absent.
    """
    names = docs.columns
    at = names.index(text)
    sized = names.index(n_chars) if n_chars in names else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.array(weights)
        for batch in slices(batches, text):
            whole = batch.column(at).to_pylist()
            spans = [spans_of(t, w, least) if t else [] for t in whole]
            columns = list(batch.columns)
            if any(spans):
                changed = [masked(t, s) if s else t for t, s in zip(whole, spans, strict=True)]
                columns[at] = pa.array(changed, batch.schema.field(at).type)
                if sized is not None:
                    kind = batch.schema.field(sized).type
                    old = columns[sized].to_pylist()
                    columns[sized] = pa.array([len(t) if s else n for t, s, n in zip(changed, spans, old, strict=True)], kind)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            every = [(KINDS.index(s["kind"]), s["start"], s["end"], s["base"]) for s in spans]
            base = [s for s in every if s[3]]
            counts = [sum(s[0] == k for s in base) for k in range(len(KINDS))]
            rows.append((doc, *counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every)))
        names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
        kinds = [pa.int64()] * (1 + len(KINDS)) + [pa.string()] * 2
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def digests(found: DataFrame) -> DataFrame:
    """Counts of the base spans by kind, the digest of their list, and the list of all spans."""
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return found.select("doc_id", "spans").mapInArrow(_digests, f"doc_id long, {counts}, base_sha256 string, spans string")
