"""Personal data by weak supervision: labelers vote, reliabilities are estimated, a classifier decides.

``candidates`` finds, in vector passes over the bytes, the four plain kinds (e-mail, IP address,
card, phone) by fixed patterns and, with wider nets, what looks like them: addresses spelled with
"(at)" and "dot", bracketed and IPv6 addresses, cards with odd separators, numbers without "+".

1. Seven labelers vote yes, no or nothing on each candidate: two on the pattern and its checks, a
   gazetteer (top-level domains, card issuers, calling codes), two on words around, two on borders
   and grouping.
2. Votes are counted by kind and pattern over all documents; there are at most 4 * 3^7 patterns, so
   the driver gets a table of bounded size. Expectation-maximisation (a Dawid-Skene model in which
   silence is a vote too, with weak priors) estimates each labeler's reliability and the share of
   true spans by kind.
3. Its posteriors label at most ``max_fit_spans`` candidates (smallest hashes, the same at every run).
   A logistic classifier over votes, shape and neighbouring words starts from the model's log-odds
   and is fitted on them, once with all votes and once with half of them hidden, so that shape
   and words learn to stand in for missing votes.
4. In a second pass plain matches stay, whatever their score, and candidates that score ``ADD`` or
   more and overlap nothing better are added.

All steps are linear in the text: runs of digits, letters or "@" are never scanned twice. Nothing
is shuffled but vote counts.

Defined cases: a null or empty text has no spans; of equal scores the first span stays; repeated
rows are treated alike; on a table without candidates the priors decide; positions are code
points, ends exclusive. An address has at most 64 characters before and 300 behind its "at" where
it is spelled out; plain ones are not limited. Columns of the documents pass through, ``spans``
is replaced.
"""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from .store import stored

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
ADD = 0.9
MAX_FIT_SPANS = 20_000
LABELERS = ("pattern", "check", "gazetteer", "cue", "contrary", "border", "layout")
YES, NO, SILENT = 1, 0, 2
WORD_BUCKETS = 32

# Gazetteers and cue words.
DOMAINS = frozenset(
    b"com org net edu gov mil int info biz name pro io ai app dev co me tv eu de fr es it uk us ca nl be ch at pl cz sk hu ro bg "
    b"se no dk fi is ie pt gr tr ru ua br mx ar cl pe co jp cn kr tw hk sg in id my th vn ph au nz za eg ma ke ng il ae sa".split()
)
CALLING_CODES = frozenset(
    b"1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 "
    b"93 94 95 98 212 213 216 218 233 234 254 255 351 352 353 354 355 356 357 358 359 370 371 372 380 381 385 386 420 421 852 886 "
    b"961 962 965 966 968 971 972 974".split()
)
CUES = {
    EMAIL: frozenset(b"email mail e contact write reach address adresse correo courriel kontakt an to from send".split()),
    IP: frozenset(b"ip ipv host server address adresse client gateway router ping connect login from".split()),
    CARD: frozenset(b"card visa mastercard amex credit debit pay payment karte kreditkarte carte tarjeta cc pan".split()),
    PHONE: frozenset(b"phone tel telephone call mobile cell fax number telefon handy telefono llama appelez text whatsapp dial".split()),
}
CONTRARY = frozenset(
    b"version v isbn issn order invoice page pages figure section chapter serial ref reference id part model sku price total token key "
    b"license licence doi rfc build release rechnung seite article art password hash".split()
)

_DIGIT = A.byte_class([*range(48, 58)])
_CONTINUATION = A.byte_class([*range(0x80, 0xC0)])
_WORD = A.byte_class([*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)])
_LOCAL = A.byte_class([*range(48, 58), *range(65, 91), *range(97, 123), *b"._%+-"])
_HEX = A.byte_class([*range(48, 58), *range(65, 71), *range(97, 103), 58])
_GAP = A.byte_class(b" ().-/_")
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
_DOT = rb"(?:\.| ?[\[({<] ?(?:dot|\.) ?[\])}>] ?| dot )"
_SPELLED_AT = re.compile(rb"(?i) ?[\[({<] ?(?:at|@) ?[\])}>] ?| at (?=[a-z0-9-]+(?:\.[a-z]| dot | ?[\[({<] ?dot))| ?@ ?")
_SPELLED_DOMAIN = re.compile(rb"(?i)[a-z0-9-]{1,63}(?:" + _DOT + rb"[a-z0-9-]{1,63})+")
_LOCAL_END = re.compile(rb"(?i)[a-z0-9_%+-]+(?:" + _DOT + rb"[a-z0-9_%+-]+)*$")
_SPELLED_DOT = frozenset([b"[.]", b"(.)", b"{.}", b" . ", b" dot ", b"[dot]", b"(dot)", b" [dot] ", b" (dot) "])
_DATE = re.compile(rb"(?:19|20)[0-9]{2}[-/. ][01]?[0-9][-/. ][0-3]?[0-9]|[0-3]?[0-9][-/.][01]?[0-9][-/.](?:19|20)[0-9]{2}")
_WORDS = re.compile(rb"[a-z]+")


@dataclass
class Span:
    """One candidate: bytes [a, b) of the text from ``at`` to ``past``."""

    row: int
    kind: int
    a: int
    b: int
    base: bool
    matched: bool  # the plain pattern matched, passed its check or not
    at: int
    past: int


def luhn(digits: bytes) -> bool:
    """Whether the digits pass the Luhn check."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = c - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _small(part: bytes) -> bool:
    part = part.lstrip(b"0")
    return len(part) <= 3 and int(part or b"0") <= 255


def _chains(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, past) of the runs of entries in which each is linked to the next."""
    head = np.flatnonzero(np.append(True, ~linked))
    return head, np.append(head[1:], len(linked) + 1)


class Texts:
    """Some texts as bytes, and what is found in them."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.raw, self.offsets = raw, offsets
        self.data = raw.tobytes()
        self.spans: list[Span] = []
        self.digits = A.spans(_DIGIT[raw], offsets)

    def _add(self, row: int, kind: int, a: int, b: int, base: bool, matched: bool) -> None:
        self.spans.append(Span(row, kind, int(a), int(b), base, matched, int(self.offsets[row]), int(self.offsets[row + 1])))

    def _rows(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, places, side="right") - 1

    def emails(self) -> None:
        """Runs of letters of an address around each "@"; a run is cut where the last match ended."""
        signs = np.flatnonzero(self.raw == 64)
        if not len(signs):
            return
        start, end, _ = A.spans(_LOCAL[self.raw], self.offsets)
        place = np.searchsorted(end, signs, side="left")
        rows = self._rows(signs)
        done = 0
        for at, row, i in zip(signs.tolist(), rows.tolist(), place.tolist()):
            if i < len(end) and end[i] == at and self.offsets[row] <= start[i]:
                a = max(done, int(start[i]))
                found = _DOMAIN.match(self.data, at + 1, int(self.offsets[row + 1])) if a < at else None
                if found:
                    done = found.end()
                    self._add(row, EMAIL, a, done, True, True)

    def addresses(self) -> None:
        """Four numbers of one dotted sequence at a time."""
        start, end, row = self.digits
        if len(start) < 4:
            return
        dotted = (start[1:] - end[:-1] == 1) & (row[1:] == row[:-1]) & (self.raw[end[:-1]] == 46)
        first, past = _chains(dotted)
        for i, j in zip(first.tolist(), past.tolist()):
            for k in range(i, j - 3, 4):
                fine = all(_small(self.data[start[m] : end[m]]) for m in range(k, k + 4))
                self._add(int(row[k]), IP, start[k], end[k + 3], fine, True)

    def cards(self) -> None:
        """Digits with at most one blank or hyphen between them."""
        start, end, row = self.digits
        if not len(start):
            return
        gap = self.raw[end[:-1]]
        joined = (start[1:] - end[:-1] == 1) & (row[1:] == row[:-1]) & ((gap == 32) | (gap == 45))
        first, past = _chains(joined)
        size = np.concatenate([[0], np.cumsum(end - start)])
        n = size[past] - size[first]
        for i, j in zip(first[(n >= 16) & (n <= 19)].tolist(), past[(n >= 16) & (n <= 19)].tolist()):
            number = b"".join(self.data[start[m] : end[m]] for m in range(i, j))
            self._add(int(row[i]), CARD, start[i], end[j - 1], luhn(number), True)

    def phones(self) -> None:
        """From each "+" before a digit to the last digit of what may stand in a number."""
        signs = np.flatnonzero(self.raw == 43)
        for at, row in zip(signs.tolist(), self._rows(signs).tolist()):
            found = _PHONE.match(self.data, at, int(self.offsets[row + 1]))
            if found:
                digits = sum(48 <= c < 58 for c in found.group())
                self._add(row, PHONE, at, found.end(), 8 <= digits <= 15, True)

    def wider(self) -> None:
        """Candidates that the plain patterns miss."""
        start, end, row = self.digits
        if len(start):
            gaps = np.concatenate([[0], np.cumsum(_GAP[self.raw], dtype=np.int64)])
            wide = start[1:] - end[:-1]
            joined = (wide <= 3) & (row[1:] == row[:-1]) & (gaps[start[1:]] - gaps[end[:-1]] == wide)
            first, past = _chains(joined)
            size = np.concatenate([[0], np.cumsum(end - start)])
            n = size[past] - size[first]
            some = (n >= 7) & (n <= 19)
            for i, j, digits in zip(first[some].tolist(), past[some].tolist(), n[some].tolist()):
                a, r = int(start[i]), int(row[i])
                if a > self.offsets[r] and self.data[a - 1] in b"+(":
                    a -= 1
                if digits >= 13:
                    self._add(r, CARD, start[i], end[j - 1], False, False)
                if digits <= 15:
                    self._add(r, PHONE, a, end[j - 1], False, False)
            near = (wide >= 3) & (wide <= 7) & (row[1:] == row[:-1])
            for i in np.flatnonzero(near[:-2] & near[1:-1] & near[2:]).tolist():
                if all(self.data[end[m] : start[m + 1]].lower() in _SPELLED_DOT for m in range(i, i + 3)):
                    self._add(int(row[i]), IP, start[i], end[i + 3], False, False)
        colons = np.concatenate([[0], np.cumsum(self.raw == 58, dtype=np.int64)])
        start, end, row = A.spans(_HEX[self.raw], self.offsets)
        many = colons[end] - colons[start] >= 2
        for a, b, r in zip(start[many].tolist(), end[many].tolist(), row[many].tolist()):
            text = self.data[a:b]
            if text.endswith(b":") and not text.endswith(b"::"):
                b -= 1
            if b - a <= 39:
                self._add(r, IP, a, b, False, False)
        for found in _SPELLED_AT.finditer(self.data):
            a, b = found.span()
            r = int(np.searchsorted(self.offsets, a, side="right")) - 1
            if found.group() != b"@" and b <= self.offsets[r + 1]:
                before = _LOCAL_END.search(self.data[max(int(self.offsets[r]), a - 64) : a])
                behind = _SPELLED_DOMAIN.match(self.data, b, min(int(self.offsets[r + 1]), b + 300))
                if before and behind:
                    self._add(r, EMAIL, a - len(before.group()), behind.end(), False, False)

    def candidates(self) -> list[Span]:
        """All candidates; those that touch a plain match of a kind are left out unless they are one."""
        for find in (self.emails, self.addresses, self.cards, self.phones):
            find()
        plain = sorted((s for s in self.spans if s.base), key=lambda s: s.a)
        failed = [s for s in self.spans if not s.base]
        self.spans = []
        self.wider()
        more = {(s.row, s.kind, s.a, s.b): s for s in self.spans} | {(s.row, s.kind, s.a, s.b): s for s in failed}
        begins = np.array([s.a for s in plain], dtype=np.int64)
        reach = np.maximum.accumulate(np.array([s.b for s in plain], dtype=np.int64)) if plain else begins
        out = list(plain)
        for s in more.values():
            i = int(np.searchsorted(begins, s.b, side="left")) - 1
            if i < 0 or reach[i] <= s.a:
                out.append(s)
        return out

    def around(self, s: Span) -> tuple[list[bytes], list[bytes]]:
        """The last four words before a span and the first two behind it, lower-cased."""
        before = _WORDS.findall(self.data[max(s.at, s.a - 60) : s.a].lower())[-4:]
        return before, _WORDS.findall(self.data[s.b : min(s.past, s.b + 40)].lower())[:2]

    def votes(self, s: Span) -> list[int]:
        """What each labeler says."""
        text = self.data[s.a : s.b]
        numbers = re.findall(rb"[0-9]+", text)
        digits = b"".join(numbers)
        groups = [len(x) for x in numbers]
        before, behind = self.around(s)
        yes = lambda x: YES if x else NO
        prior = self.data[s.a - 1] if s.a > s.at else 32
        after = self.data[s.b] if s.b < s.past else 32
        border = yes(not _WORD[prior] and not _WORD[after] and prior not in b"=/#:.-&" and after not in b"=/#&")
        if s.kind == EMAIL:
            labels = re.split(_DOT, re.split(rb"(?i) ?[\[({<] ?(?:at|@) ?[\])}>] ?| at | ?@ ?", text.lower())[-1])
            check = yes(all(x and x[:1] != b"-" and x[-1:] != b"-" for x in labels) and labels[-1].isalpha() and 2 <= len(labels[-1]) <= 24)
            gazetteer = YES if labels[-1] in DOMAINS else SILENT
            signed = b"@" in text or re.search(rb"(?i)[\[({<] ?at", text)
            layout = YES if signed else (SILENT if re.search(rb"(?i)dot", text) else NO)
        elif s.kind == IP:
            six = b":" in text
            try:
                known = ipaddress.ip_address(text.decode()) if six else None
            except ValueError:
                known = None
            check = yes(known if six else all(map(_small, numbers)))
            gazetteer = yes(known and (known.is_global or known.is_private) and len(digits) > 1 if six else 1 <= int(numbers[0][:4]) <= 223)
            layout = yes(six or max(groups) <= 3)
        elif s.kind == CARD:
            check = yes(13 <= len(digits) <= 19 and luhn(digits) and len(set(digits)) > 1)
            gazetteer = yes(_issued(digits))
            layout = yes(groups in ([len(digits)], [4, 6, 5], [4, 6, 4]) or (set(groups[:-1]) == {4} and groups[-1] <= 4))
        else:
            dated = _DATE.search(text) or digits[:3] in (b"978", b"979") and len(digits) == 13
            check = NO if dated or len(digits) > 15 or len(digits) < 7 else (YES if len(digits) >= 9 else SILENT)
            abroad = digits[2:] if digits[:2] == b"00" else digits if text[:1] == b"+" else b""
            national = groups in ([3, 3, 4], [3, 4], [5, 5, 1], [4, 3, 3], [1, 3, 3, 4]) or text[:1] == b"("
            gazetteer = YES if national or any(abroad[:k] in CALLING_CODES for k in (1, 2, 3)) else SILENT
            layout = YES if text[:1] == b"+" else yes(len(groups) > 1 and min(groups) >= 2 and max(groups) <= 7)
        pattern = YES if s.base else NO if s.matched else SILENT
        cue = YES if CUES[s.kind].intersection(before + behind) else SILENT
        contrary = NO if CONTRARY.intersection(before[-2:]) else SILENT
        return [pattern, check, gazetteer, cue, contrary, border, layout]

    def shape(self, s: Span) -> list[float]:
        """Size, digits, groups and separators of a span, and buckets of the words around it."""
        text = self.data[s.a : s.b]
        numbers = re.findall(rb"[0-9]+", text)
        out = [min(len(text), 64) / 32, min(sum(map(len, numbers)), 32) / 16, min(len(numbers), 8) / 4]
        out += [float(c in text) for c in b" -.(+"]
        words = [0.0] * WORD_BUCKETS
        before, behind = self.around(s)
        for word in before[-2:] + behind[:1]:
            words[xxhash.xxh32_intdigest(word) % WORD_BUCKETS] = 1.0
        return out + words


def _issued(digits: bytes) -> bool:
    """Whether number and length belong to a card issuer."""
    n, two, four = len(digits), int(digits[:2]), int(digits[:4])
    return bool(
        (digits[:1] == b"4" and n in (13, 16, 19))
        or ((51 <= two <= 55 or 2221 <= four <= 2720) and n == 16)
        or (two in (34, 37) and n == 15)
        or ((four == 6011 or two in (62, 64, 65)) and 16 <= n <= 19)
        or (two == 35 and n == 16)
        or (two in (30, 36, 38) and n == 14)
    )


SHAPES = 8 + WORD_BUCKETS


@dataclass
class Model:
    """Share of true spans and vote probabilities [labeler, truth, vote] by kind; the classifier's weights by kind."""

    share: np.ndarray
    votes: np.ndarray
    weights: np.ndarray

    def posterior(self, kind: np.ndarray, votes: np.ndarray) -> np.ndarray:
        """The probability that a span is true, from its votes alone."""
        return _posterior(self.share[kind], self.votes[kind], votes)

    def score(self, kind: np.ndarray, votes: np.ndarray, shape: np.ndarray) -> np.ndarray:
        """The classifier's probability."""
        return _sigmoid((_inputs(votes, shape) * self.weights[kind]).sum(axis=1))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _posterior(share: np.ndarray, tables: np.ndarray, votes: np.ndarray) -> np.ndarray:
    """``share`` and ``tables`` are one, or one a row."""
    log = np.log(np.broadcast_to(tables, (len(votes), *tables.shape[-3:])))
    log = np.take_along_axis(log, votes[:, :, None, None], axis=3)[..., 0].sum(axis=1)
    return _sigmoid(np.log(share) - np.log1p(-share) + log[:, 1] - log[:, 0])


def _prior(strength: float) -> np.ndarray:
    """Vote counts [labeler, truth, vote] before any data: right four times of five when not silent."""
    right, wrong, silent = 0.48, 0.12, 0.4
    return strength * np.broadcast_to(np.array([[right, wrong, silent], [wrong, right, silent]]), (len(LABELERS), 2, 3))


def estimate(votes: np.ndarray, n: np.ndarray, rounds: int = 60, strength: float = 20.0) -> tuple[float, np.ndarray]:
    """(share of true spans, vote probabilities) of one kind from its vote patterns and their counts."""
    prior = _prior(strength)
    tables = prior / prior.sum(axis=2, keepdims=True)
    share = 0.5
    hot = np.stack([votes == v for v in range(3)], axis=2).astype(float)
    for _ in range(rounds):
        true = _posterior(np.float64(share), tables, votes) if len(votes) else np.zeros(0)
        held = np.stack([(1 - true) * n, true * n])
        share = (held[1].sum() + strength / 2) / (held.sum() + strength)
        tables = prior + np.einsum("cp,plv->lcv", held, hot)
        tables = tables / tables.sum(axis=2, keepdims=True)
    return float(share), tables


def _inputs(votes: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """One, two flags a labeler, shape."""
    return np.concatenate([np.ones((len(votes), 1)), votes == NO, votes == YES, shape], axis=1).astype(float)


def _start(share: float, tables: np.ndarray) -> np.ndarray:
    """The model's log-odds as weights of the classifier."""
    ratio = np.log(tables[:, 1]) - np.log(tables[:, 0])
    bias = np.log(share / (1 - share)) + ratio[:, SILENT].sum()
    return np.concatenate([[bias], ratio[:, NO] - ratio[:, SILENT], ratio[:, YES] - ratio[:, SILENT], np.zeros(SHAPES)])


def _classifier(start: np.ndarray, x: np.ndarray, y: np.ndarray, ridge: float = 5.0) -> np.ndarray:
    """Weights near ``start`` that fit the soft labels, by Newton steps."""
    w = start.copy()
    for _ in range(25 if len(y) else 0):
        p = _sigmoid(x @ w)
        slope = x.T @ (p - y) + ridge * (w - start)
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _packed(votes: list[int]) -> int:
    return sum(v * 3**i for i, v in enumerate(votes))


def _unpacked(codes: np.ndarray) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(len(LABELERS)) % 3


def fit(docs: DataFrame, max_fit_spans: int = MAX_FIT_SPANS) -> Model:
    """Reliabilities from the votes on all candidates, and a classifier fitted on at most ``max_fit_spans`` of them."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            raw, offsets = A.text_bytes(batch.column("text"))
            for a, b in A.chunks(offsets):
                texts = Texts(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for s in texts.candidates():
                    pick = xxhash.xxh3_64_intdigest(texts.data[max(s.at, s.a - 40) : min(s.past, s.b + 20)]) >> 1
                    rows.append((s.kind, _packed(texts.votes(s)), pick, np.array(texts.shape(s), np.float32).tobytes()))
            columns = list(zip(*rows)) or [(), (), (), ()]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["kind", "votes", "pick", "shape"])

    found = stored(docs.select("text").mapInArrow(find, "kind int, votes int, pick long, shape binary"), "candidates")
    counts = found.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values(["kind", "votes"])
    chosen = found.orderBy("pick", "kind", "votes", "shape").limit(max_fit_spans).toPandas()
    share, tables, weights = [], [], []
    for kind in range(len(KINDS)):
        own = counts[counts["kind"] == kind]
        s, t = estimate(_unpacked(own["votes"].to_numpy(np.int64)), own["n"].to_numpy(float))
        rows = chosen[chosen["kind"] == kind]
        votes = _unpacked(rows["votes"].to_numpy(np.int64))
        shape = np.array([np.frombuffer(x, np.float32) for x in rows["shape"]]).reshape(len(rows), SHAPES)
        truth = _posterior(np.float64(s), t, votes) if len(votes) else np.zeros(0)
        hidden = (rows["pick"].to_numpy(np.int64)[:, None] >> np.arange(len(LABELERS))) & 1
        x = np.concatenate([_inputs(votes, shape), _inputs(np.where(hidden == 1, SILENT, votes), shape)])
        share.append(s)
        tables.append(t)
        weights.append(_classifier(_start(s, t), x, np.concatenate([truth, truth])))
    return Model(np.array(share), np.array(tables), np.array(weights))


def _decided(texts: Texts, model: Model, add: float) -> list[tuple[Span, float]]:
    """The spans that stay, with their scores: plain ones, then others by score that overlap none before."""
    spans = texts.candidates()
    if not spans:
        return []
    kind = np.array([s.kind for s in spans])
    votes = np.array([texts.votes(s) for s in spans])
    score = model.score(kind, votes, np.array([texts.shape(s) for s in spans]))
    out = [(s, p) for s, p in zip(spans, score.tolist()) if s.base]
    taken: dict[int, list[tuple[int, int]]] = {}
    better = [(s, p) for s, p in zip(spans, score.tolist()) if not s.base and p >= add]
    for s, p in sorted(better, key=lambda x: (-x[1], x[0].a, x[0].kind, -x[0].b)):
        held = taken.setdefault(s.row, [])
        if all(s.b <= a or b <= s.a for a, b in held):
            held.append((s.a, s.b))
            out.append((s, p))
    return sorted(out, key=lambda x: (x[0].row, x[0].kind, x[0].a))


def find_private(docs: DataFrame, model: Model | None = None, add: float = ADD) -> DataFrame:
    """``docs`` with ``spans``: kind, start, end, base and score of each span, by kind, then start."""
    model = fit(docs) if model is None else model
    span = T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
         T.StructField("base", T.BooleanType()), T.StructField("score", T.DoubleType())]
    )
    rest = [f for f in docs.schema.fields if f.name != "spans"]
    shape = T.StructType([*rest, T.StructField("spans", T.ArrayType(span))])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = A.text_bytes(batch.column("text"))
            counts = np.zeros(batch.num_rows, np.int32)
            found: list[tuple] = []
            for a, b in A.chunks(offsets):
                part = raw[offsets[a] : offsets[b]]
                texts = Texts(part, offsets[a : b + 1] - offsets[a])
                spans = _decided(texts, model, add)
                if spans:
                    points = np.concatenate([[0], np.cumsum(~_CONTINUATION[part], dtype=np.int64)])
                    for s, p in spans:
                        counts[a + s.row] += 1
                        zero = points[s.at]
                        found.append((KINDS[s.kind], int(points[s.a] - zero), int(points[s.b] - zero), s.base, p))
            columns = list(zip(*found)) or [()] * 5
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.float64())
            items = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], span.names)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), items)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), lists], shape.names)

    return docs.mapInArrow(find, shape)


def mask(docs: DataFrame, model: Model | None = None, add: float = ADD) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; of spans that overlap the first one names it."""
    found = find_private(docs, model, add)
    ordered = "array_sort(spans, (x, y) -> if(x.start != y.start, cast(sign(x.start - y.start) as int), cast(sign(y.end - x.end) as int)))"
    cut = F.expr(
        f"aggregate({ordered}, named_struct('done', cast('' as string), 'at', 0L), (s, x) -> named_struct("
        "'done', if(x.start < s.at, s.done, concat(s.done, substring(text, cast(s.at + 1 as int), cast(x.start - s.at as int)), '<', x.kind, '>')), "
        "'at', greatest(s.at, x.end)), s -> concat(s.done, substring(text, cast(s.at + 1 as int))))"
    )
    masked = found.withColumn("text", F.when(F.size("spans") > 0, cut).otherwise(F.col("text")))
    return masked.select(*[F.col(f"`{c}`") for c in docs.columns])


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain matches by kind, their digest, and all spans of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_private(docs)
    joined = lambda spans: f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    return found.select(
        "doc_id",
        *(F.expr(f"cast(size(filter(spans, s -> s.base and s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.expr(joined("filter(spans, s -> s.base)")).cast("binary"), 256).alias("base_sha256"),
        F.expr(joined("spans")).alias("spans"),
    )
